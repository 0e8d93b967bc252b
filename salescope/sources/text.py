r"""Delimited text files as numbered records.

``spark.read.csv`` loses the record number and skips blank lines, while the
validation rules need both (a blank line is a record with the wrong field
count).  So files are read as lines, and records are made from them as the
usual CSV reader does: a quote opens a field only at the field's start, inside a
quoted field a doubled quote is a quote and a line end is a character, and
whatever follows the closing quote up to the separator belongs to the field.

Where a line stands comes from the scan itself: file, start of the input split
(``_metadata``) and place within it.  Whether a line starts inside a quoted
field depends on all lines before it.  Every line is a function of that state
with two outcomes, so functions are composed, first within each split, then
over the splits of a file (one row a split), and each split learns the state it
starts in: files are read in parallel, and records may cross splits.

* Splits that start outside a quoted field and have no line that opens one (all
  of them, in most files) need no shuffle: a record is a line, numbered by the
  rows of the splits before it and its place.
* In the others the state runs through the lines of a split (a window a split),
  and only lines of records with several lines are grouped.

The table of splits has one row per input split and is broadcast.  A path may be
a file or a folder; the files of a folder follow each other by name and no record
goes on in the next file.  A quote that is never closed makes the rest of its
file one record, as in the original.  Lines end in ``\n`` or ``\r\n``; inside a
quoted field either stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salescope.operators.validate import split_fields
from salescope.schema import SNAKE
from salescope.session import written

BOM = "﻿"
_FILE = ["file"]
_SPLIT = ["file", "block"]


def scan_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, block, at, line)``: ``at`` grows with the lines of a split."""
    return located(spark.read.option("lineSep", "\n").text(path)
                   .select("_metadata.file_path", "_metadata.file_block_start", "value"))


def located(lines: DataFrame) -> DataFrame:
    """The same from rows (``file_path``, ``file_block_start``, ``value``) as a scan gives them."""
    return lines.select(F.col("file_path").alias("file"), F.col("file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))


def _ends_inside(line: Column, sep: str) -> Column:
    """Whether a line that starts a record ends within a quoted field."""
    # Whole fields with their separators, then a field whose quote is not closed.  All runs
    # are possessive, so a line is read once.
    whole = rf'(?:"[^"]*+(?:""[^"]*+)*+"(?:[^"{sep}][^{sep}]*+)?+{sep}|(?:[^"{sep}][^{sep}]*+)?+{sep})*+'
    return line.rlike(rf'^{whole}"[^"]*+(?:""[^"]*+)*+\z')


def _states(rows: DataFrame, by: list[str], order: list[str], begin: Column) -> DataFrame:
    """Adds ``inside``, the state before each row, from the rows' functions (``if_out``, ``if_in``) and ``begin``.

    A row with two equal outcomes sets the state; one that turns both around swaps it.
    """
    before = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    constant, swap = F.col("if_out") == F.col("if_in"), F.col("if_out") & ~F.col("if_in")
    swaps = F.count_if(swap).over(before)  # before this row
    rows = rows.withColumn("_swaps", F.coalesce(swaps, F.lit(0)))
    last = F.last(F.when(constant, F.struct(F.col("if_out").alias("to"), (F.col("_swaps")).alias("swaps"))),
                  ignorenulls=True).over(before)
    rows = rows.withColumn("_last", last)
    since = F.col("_swaps") - F.coalesce(F.col("_last.swaps"), F.lit(0))
    start = F.coalesce(F.col("_last.to"), begin)
    return rows.withColumn("inside", start != (since % 2 == 1)).drop("_swaps", "_last")


def _splits(lines: DataFrame, sep: str) -> DataFrame:
    """One row a split: lines, first place, whether any line opens a field, and the split as a function of the state."""
    # Lines without a quote keep the state, so those with one say all of a split's function.
    line, quote = F.col("line"), F.col("line").contains('"')
    rows = lines.select(*_SPLIT, "at", F.when(quote, _ends_inside(line, sep)).otherwise(F.lit(False)).alias("if_out"),
                        F.when(quote, _ends_inside(F.concat(F.lit('"'), line), sep)).otherwise(F.lit(True)).alias("if_in"))
    constant, swap = F.col("if_out") == F.col("if_in"), F.col("if_out") & ~F.col("if_in")
    # One pass over the text.  ``set``: place and outcome of the last line that sets the state, as one number.
    found = written(rows.groupBy(*_SPLIT).agg(
        F.count(F.lit(1)).alias("n"), F.min("at").alias("first"), F.count_if("if_out").alias("opens"), F.count_if(swap).alias("swaps"),
        F.max(F.when(constant, F.col("at") * 2 + F.col("if_out").cast("long"))).alias("set")), "split-states")
    if not found.where("swaps > 0 AND set IS NOT NULL").isEmpty():  # which swaps come behind the last setting line
        after = (rows.where(swap).join(F.broadcast(found.select(*_SPLIT, "set")), _SPLIT)
                 .where(F.col("set").isNull() | (F.col("at") * 2 > F.col("set")))
                 .groupBy(*_SPLIT).agg(F.count(F.lit(1)).alias("swaps")))
        found = found.drop("swaps").join(after, _SPLIT, "left")
    odd = F.coalesce(F.col("swaps"), F.lit(0)) % 2 == 1
    to = F.col("set") % 2 == 1
    return found.select(*_SPLIT, "n", "first", (F.col("opens") > 0).alias("opens"),
                        (F.coalesce(to, F.lit(False)) != odd).alias("if_out"),
                        (F.coalesce(to, F.lit(True)) != odd).alias("if_in"))


def _unended(text) -> Column:
    """The line without a carriage return at its end."""
    return F.when(F.endswith(F.col(text), F.lit("\r")), F.left(F.col(text), F.char_length(text) - 1)).otherwise(F.col(text))


def _offsets(starts: DataFrame) -> DataFrame:
    """``starts`` (records that begin in each split) with the records and files before each split.

    All splits in one task: one row each.
    """
    order = Window.partitionBy(F.lit(0)).orderBy(*_SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    return written(starts.withColumn("before", F.coalesce(F.sum("starts").over(order), F.lit(0)))
                   .withColumn("files_before", F.dense_rank().over(Window.partitionBy(F.lit(0)).orderBy("file")) - 1),
                   "split-offsets").drop("starts")


def csv_records(lines: DataFrame, sep: str = ";") -> DataFrame:
    """``(file, files_before, before, place, text)`` of every record of ``lines``.

    ``before`` counts the records of all files and splits before the record's own
    split, ``files_before`` the files; ``place`` counts from 0 behind those.
    """
    splits = _states(_splits(lines, sep), _FILE, ["block"], F.lit(False))
    plain = ~F.col("opens") & ~F.col("inside")
    splits = written(splits.select(*_SPLIT, "n", "first", "inside", plain.alias("plain")), "splits")
    of = F.broadcast(splits)
    place = (F.col("at") - F.col("first")).alias("place")
    if splits.where("NOT plain").isEmpty():
        offsets = _offsets(splits.select(*_SPLIT, "first", F.col("n").alias("starts")))
        return lines.join(F.broadcast(offsets), _SPLIT).select("file", "files_before", "before", place, _unended("line").alias("text"))
    single = lines.join(of.where("plain"), _SPLIT).select(*_SPLIT, place, _unended("line").alias("text"))
    starts = splits.where("plain").select(*_SPLIT, F.col("n").alias("starts"))
    text = F.col("line")
    mixed = lines.join(of.where("NOT plain"), _SPLIT).select(
        *_SPLIT, "at", "line", F.col("inside").alias("begin"), _ends_inside(text, sep).alias("if_out"),
        _ends_inside(F.concat(F.lit('"'), text), sep).alias("if_in"))
    mixed = _states(mixed, _SPLIT, ["at"], F.col("begin")).withColumn(
        "goes_on", F.when(F.col("inside"), F.col("if_in")).otherwise(F.col("if_out")))
    upto = Window.partitionBy(*_SPLIT).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    # Place -1: the record began in an earlier split.
    mixed = written(mixed.select(*_SPLIT, "at", "line", "inside", "goes_on",
                                 (F.count_if(~F.col("inside")).over(upto) - 1).alias("place")), "mixed-lines")
    starts = starts.unionByName(mixed.groupBy(*_SPLIT).agg(F.count_if(~F.col("inside")).alias("starts")))
    found = single.unionByName(mixed.where(~F.col("inside") & ~F.col("goes_on"))
                               .select(*_SPLIT, "place", _unended("line").alias("text")))
    offsets = _offsets(starts)
    found = found.join(F.broadcast(offsets), _SPLIT).select("file", "files_before", "before", "place", "text")
    parts = (mixed.where("inside OR goes_on").join(F.broadcast(offsets), _SPLIT)
             .groupBy("file", "files_before", (F.col("before") + F.col("place")).alias("record"))
             .agg(F.array_join(F.sort_array(F.collect_list(F.struct("block", "at", "line")))["line"], "\n").alias("text")))
    found = found.unionByName(parts.select("file", "files_before", F.col("record").alias("before"),
                                           F.lit(0).cast("long").alias("place"),
                                           F.regexp_replace("text", r"\r\z", "").alias("text")))
    return found


def numbered_records(lines: DataFrame, sep: str = ";") -> DataFrame:
    """``(file, files_before, ordinal, text)``: ordinals from 0 over all files."""
    return csv_records(lines, sep).select("file", "files_before", (F.col("before") + F.col("place")).alias("ordinal"), "text")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(ordinal long, line string)`` of every physical line; ordinal 0 is the first line of the first file."""
    lines = scan_lines(spark, path)
    splits = lines.groupBy(*_SPLIT).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    order = Window.partitionBy(F.lit(0)).orderBy(*_SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))
    return lines.join(F.broadcast(splits), _SPLIT).select(
        (F.col("before") + F.col("at") - F.col("first")).alias("ordinal"), F.regexp_replace("line", r"\r\z", "").alias("line"))


def header_fields(text: str, sep: str = ";") -> list[str]:
    """Field names of a heading, without byte-order mark and blanks around them."""
    return [h.strip() for h in text.lstrip(BOM).split(sep)]


def read_delimited(spark: SparkSession, path: str | list[str], sep: str = ";",
                   header_per_file: bool = False) -> tuple[list[str], DataFrame]:
    """Header and ``(record_no, line)`` of the data records.

    ``record_no`` is 1-based over all files, without headings, as in the original
    quarantine file.  The first record of the first file is the heading; with
    ``header_per_file`` that of each file is one.  An empty input is an error.
    """
    records = numbered_records(scan_lines(spark, path), sep)
    head = records.filter(F.col("ordinal") == 0).select("text").take(1)
    if not head:
        raise ValueError(f"input file is empty: {path}")
    return header_fields(head[0][0], sep), data_records(records, header_per_file).select("record_no", "line")


def read_rows(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """A table of valid rows, Parquet or CSV by suffix, as text columns with snake_case names: input of the clean stage."""
    if path.lower().rstrip("/").endswith(".parquet"):
        rows = spark.read.parquet(path)
        return rows.toDF(*(SNAKE.get(c.strip(), c.strip()) for c in rows.columns))
    header, records = read_delimited(spark, path, sep)
    return split_fields(records, header).drop("record_no", "n_fields")


def data_records(records: DataFrame, header_per_file: bool = True, numbers_per_file: bool = False) -> DataFrame:
    """Numbered records without headings: ``(file, record_no, line)``; numbers go over all files or start in each."""
    if not header_per_file:
        return records.where(F.col("ordinal") > 0).select("file", F.col("ordinal").alias("record_no"), F.col("text").alias("line"))
    # One row a file.
    first = records.groupBy("file").agg(F.min("ordinal").alias("_first"))
    records = records.join(F.broadcast(first), "file").where(F.col("ordinal") > F.col("_first"))
    skipped = F.col("_first") if numbers_per_file else F.col("files_before")
    return records.select("file", (F.col("ordinal") - skipped).alias("record_no"), F.col("text").alias("line"))


def head_n(records: DataFrame, n: int) -> DataFrame:
    """The first ``n`` records."""
    return records.where(F.col("record_no") <= n)


def volume_profile(records: DataFrame, chunk_size: int = 100_000, header: list[str] | None = None) -> DataFrame:
    """Rows per logical chunk of ``chunk_size`` consecutive records (last one may be partial).

    With the ``header``, also the number of its fields and the total of all chunks.
    """
    chunk = F.floor((F.col("record_no") - 1) / F.lit(chunk_size)).cast("bigint")
    out = records.groupBy(chunk.alias("chunk_index")).agg(F.count(F.lit(1)).alias("rows"))
    if header is None:
        return out
    return out.select("chunk_index", "rows", F.sum("rows").over(Window.partitionBy(F.lit(0))).alias("total"),
                      F.lit(";".join(header)).alias("header"))
