"""Named frames shared by the registered queries.

The cleaned table is what every analysis reads.  As in the original pipeline
(which writes the clean table once and reads it in every later stage), it is
written once per data directory as Parquet into the shared checkpoint folder
and read back; a lost executor then costs a re-read, not a re-run of the
cleaning plan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from salescope.operators import clean as C
from salescope.operators import validate as V
from salescope.operators import profile as PR
from salescope.schema import RAW_FIELDS
from salescope.session import checkpoint_dir, shuffle_by_size, written
from salescope.sources.sales import quoted_lines, raw_text_of, sales_rows, sales_view
from salescope.sources.sinks import write_ordered_lines, write_quarantine
from salescope.sources.tables import table
from salescope.sources.text import read_delimited

#: Line items to a text file, about: what a task sorts stays the same as the tables grow.
LINES_A_FILE = 500_000

_WRITTEN: dict[tuple, DataFrame | str] = {}


def data_version(spark: SparkSession, data_dir: str) -> tuple:
    """Names, sizes and times of the files the sales view reads, so that changed data is read anew."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    out = []
    for t in ("lineitem", "orders"):
        path = hadoop(f"{data_dir.rstrip('/')}/{t}.parquet")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        out += sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(path))
    return tuple(out)


def sized(spark: SparkSession, data_dir: str) -> SparkSession:
    """The session with shuffles that begin in as many partitions as the sales tables ask for."""
    shuffle_by_size(spark, sum(size for _, size, _ in data_version(spark, data_dir)))
    return spark


def written_table(spark: SparkSession, name: str, data_dir: str, build, partition_by: str | None = None) -> DataFrame:
    """``build()`` written once per application, data directory and version of its files, then read back."""
    key = (spark.sparkContext.applicationId, data_dir, name, data_version(spark, data_dir))
    if key not in _WRITTEN:
        _WRITTEN[key] = written(build(), name, partition_by)
    return _WRITTEN[key]


def sales(spark: SparkSession, data_dir: str) -> DataFrame:
    """Typed sales rows (``lineitem ⋈ orders``), with synthetic gaps in discount and birth date."""
    return sales_view(spark, data_dir)


def clean_sales(spark: SparkSession, data_dir: str, by_month: bool = False) -> DataFrame:
    """The typed sales rows after the cleaning stage (the frame every analysis reads).

    Stored by month; with ``by_month`` the partition column is there too, which
    lets ``profile.period`` read the months it needs only.
    """
    def build():
        typed = sales_view(spark, data_dir).drop("product", "first_names", "last_names")
        return PR.with_month(C.clean(typed, with_zscores=True, cut_lineage=True))
    df = written_table(spark, "clean_sales", data_dir, build, PR.MONTH)
    return df if by_month else df.drop(PR.MONTH)


def text_parts(spark: SparkSession, data_dir: str) -> int:
    """Files of ``LINES_A_FILE`` lines that a text of the sales asks for."""
    return max(1, -(-table(spark, data_dir, "lineitem", ["l_linenumber"]).count() // LINES_A_FILE))


def written_text(spark: SparkSession, name: str, data_dir: str, lines, heading: list[str], render=None) -> str:
    """Path of ``lines()`` (``record_no``, ``line``) written as packed text in record order, once per version of the data.

    ``render`` makes the lines from the rows, see ``write_ordered_lines``.
    """
    key = (spark.sparkContext.applicationId, data_dir, f"{name}-text", data_version(spark, data_dir))
    if key not in _WRITTEN:
        path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
        n = table(spark, data_dir, "lineitem", ["l_linenumber"]).count()
        few = min(spark.sparkContext.defaultParallelism, n // 20_000)  # small tables: tasks for all cores
        write_ordered_lines(lines(), path, "record_no", heading, render=render, compression="lz4",
                            parts=max(few, text_parts(spark, data_dir)))
        _WRITTEN[key] = path
    return _WRITTEN[key]


def raw_file(spark: SparkSession, data_dir: str) -> str:
    """Path of the raw ``;`` text with its heading (the validation job's input)."""
    return written_text(spark, "raw-file", data_dir, lambda: sales_rows(spark, data_dir), [";".join(RAW_FIELDS)],
                        render=raw_text_of)


def quoted_file(spark: SparkSession, data_dir: str) -> str:
    """Path of a ``;`` text of four fields, the third one with separators, quotes and line ends inside."""
    return written_text(spark, "quoted-file", data_dir, lambda: quoted_lines(spark, data_dir), ["key;channel;product;units"])


def raw_text(spark: SparkSession, data_dir: str) -> DataFrame:
    """Numbered records of the raw text file, read from the file itself: where its splits begin is found once.

    The rule chain is row-wise and CPU-bound, so it scales with the number of
    files, as many as the text has parts: its rows are not dealt out once more.
    """
    key = (spark.sparkContext.applicationId, data_dir, "raw-records", data_version(spark, data_dir))
    if key not in _WRITTEN:
        _WRITTEN[key] = read_delimited(spark, raw_file(spark, data_dir))[1]
    return _WRITTEN[key]


def quarantine_file(spark: SparkSession, data_dir: str) -> str:
    """Path of the quarantine file, with its heading."""
    key = (spark.sparkContext.applicationId, data_dir, "quarantine-file", data_version(spark, data_dir))
    if key not in _WRITTEN:
        path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{spark.sparkContext.applicationId}/quarantine-{uuid.uuid4().hex[:12]}"
        write_quarantine(V.quarantine_lines(checked_lines(spark, data_dir)), path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def checked_lines(spark: SparkSession, data_dir: str) -> DataFrame:
    """Raw delimited lines with their first failing rule (NULL = valid), written once.

    Valid rows, quarantine and totals are three consumers of one validation
    pass; writing its result keeps the rule chain from being re-evaluated (or
    inlined into pushed-down filters) by each of them.
    """
    return written_table(spark, "checked_lines", data_dir,
                         lambda: V.first_failure(raw_text(spark, data_dir)))


def discarded_lines(spark: SparkSession, data_dir: str) -> DataFrame:
    """``record_no`` and reason of the lines of ``checked_lines`` that fail a rule, written once: without it, all valid rows
    would be written for a query that asks for discards only."""
    key = (spark.sparkContext.applicationId, data_dir, "checked_lines", data_version(spark, data_dir))
    if key in _WRITTEN:
        return _WRITTEN[key].where("fail_field IS NOT NULL").select("record_no", "fail_field", "fail_rule", "fail_value")
    return written_table(spark, "discarded_lines", data_dir, lambda: V.discarded(raw_text(spark, data_dir)))
