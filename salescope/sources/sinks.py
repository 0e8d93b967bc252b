"""Sinks: valid rows, quarantine, clean table, JSON reports.

All writes are distributed (one file per partition, no driver collection).  Text
sinks keep the order of the records: the rows are dealt by ranges of the record
number, so the parts follow each other by name, and the heading stands once, at
the top of the first part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.operators.clean import raw_names

# The heading of the quarantine file.
QUARANTINE_HEADING = ["REGISTRO DE TRANSACCIONES DESCARTADAS", "=================================="]


def csv_field(c: Column, sep: str = ";") -> Column:
    """A field as a CSV writer puts it: quoted where it holds a separator, a quote or a line end; NULL is empty."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike(f'[{sep}"\\r\\n]'), quoted).otherwise(text)


def write_ordered_lines(lines: DataFrame, path: str, order_by: str, heading: list[str] = (), line_col: str = "line",
                        mode: str = "overwrite", render=None, compression: str = "none", parts: int | None = None) -> None:
    """Text files in the order of ``order_by`` (lines of one number in the order of their text), the ``heading`` lines first.

    ``render(rows, keep)`` makes the lines from their rows, once and behind the exchange: the
    exchange reads its input twice (a sample for the ranges, then the rows) and moves the rows only.
    Without ``parts``, the number of files, Spark chooses it by the bytes it exchanges.
    """
    # The number comes first: a sort compares its first column without a look at the rows.  It is null for the heading.
    order = ["_at", "_part"]
    keep = (*order, "_heading")
    rows = lines.select(F.col(order_by).cast("long").alias("_at"), F.lit(0).alias("_part"),
                        F.lit(None).cast("string").alias("_heading"), "*")
    top = lines.sparkSession.createDataFrame([(None, i - len(heading), text) for i, text in enumerate(heading)],
                                             "_at long, _part int, _heading string")
    placed = rows.unionByName(top, allowMissingColumns=True)
    placed = placed.repartitionByRange(parts, *order) if parts else placed.repartitionByRange(*order)
    placed = render(placed, keep) if render else placed
    value = F.when(F.col("_part") < 0, F.col("_heading")).otherwise(F.col(line_col))
    (placed.select(*order, value.alias("value")).sortWithinPartitions(*order, "value")
     .select("value").write.mode(mode).option("compression", compression).text(path))


def write_dealt_lines(lines: DataFrame, path: str, by: str, keys: list, heading: str, line_col: str = "line",
                      compression: str = "none") -> None:
    """Text files with the ``heading`` on top, in a folder for each of the ``keys`` of column ``by``: one a task and key.

    Nothing is exchanged: the first row of a task brings a heading for each of its files.
    """
    row = lambda text, key, at: F.struct(text.alias("line"), key.cast("string").alias(by), F.lit(at).alias("_at"))
    own = row(F.col(line_col), F.col(by), 1)
    first = F.monotonically_increasing_id() % (1 << 33) == 0
    (lines.select(line_col, by, first.alias("_first"))
     .select(F.inline(F.when(F.col("_first"), F.array(*(row(F.lit(heading), F.lit(k), 0) for k in keys), own)).otherwise(F.array(own))))
     .sortWithinPartitions(by, "_at").select("line", by)
     .write.partitionBy(by).option("compression", compression).text(path))


def write_rows(df: DataFrame, path: str, order_by: str | None = None, public_names: bool = True,
               mode: str = "overwrite", partition_by: str | None = None) -> None:
    """Parquet when the path ends in ``.parquet``, otherwise ``;``-separated CSV with a heading.

    With ``order_by``, a column that is not written itself, rows are in its order.
    """
    public = raw_names(df) if public_names else df
    columns = [c for c in public.columns if c != order_by]
    if path.lower().rstrip("/").endswith(".parquet"):
        out = public
        if order_by:
            out = public.repartitionByRange(order_by).sortWithinPartitions(order_by)
        writer = out.select(*(f"`{c}`" for c in columns)).write.mode(mode)
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
        return
    line = F.concat_ws(";", *(csv_field(F.col(f"`{c}`")) for c in columns)).alias("line")
    at = F.col(order_by) if order_by else F.lit(0)
    write_ordered_lines(public.select(at.alias("_order"), line), path, "_order", [";".join(columns)], mode=mode)


def write_quarantine(lines: DataFrame, path: str, line_col: str = "line", order_by: str = "record_no",
                     mode: str = "overwrite") -> None:
    """Quarantine lines ``<record>:<field>:<rule>:<value>`` as text files in record order, below their heading."""
    write_ordered_lines(lines, path, order_by, QUARANTINE_HEADING, line_col, mode)


def write_json_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per report row (full double precision)."""
    df.write.mode(mode).json(path)


def json_lines(df: DataFrame) -> DataFrame:
    """The report as JSON text rows (``to_json(struct(*))``)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))
