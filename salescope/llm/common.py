"""Helpers shared by the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from salescope.session import checkpoint_dir

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The white space of the line rules: space and \x09-\x0D.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder, never used twice."""
    app = spark.sparkContext.applicationId
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{app}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: lineage ends here."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only.  Pure ASCII values take the fast built-in."""
    return (F.when(F.octet_length(c) == F.char_length(c), F.lower(c))
            .otherwise(F.translate(c, _UPPER, _UPPER.lower())))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def others(df: DataFrame, *outputs: str) -> list[Column]:
    """The columns of ``df`` that do not have the name of an output column, in either case."""
    taken = {c.lower() for c in outputs}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]


#: Bytes of text that a task works on at a time.
SLICE_BYTES = 4 << 20


def slices(sizes: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes, one row at least."""
    upto, start = np.cumsum(sizes), 0
    while start < len(sizes):
        done = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, done + most, "right")))
        yield start, end
        start = end


def map_texts(rows: DataFrame, make: Callable[[], Callable], columns: dict[str, T.DataType],
              with_id: bool = True, most: int = SLICE_BYTES) -> DataFrame:
    """Runs Python over the texts of ``rows`` (``_id``, ``_text`` and others), slice by slice.

    ``make()`` is called once a task and gives a function of the texts of a slice
    and the slice itself.  That returns the output columns, and in ``_row`` the
    rows of the slice they belong to (left out: one output row a row); ids are
    taken over as they are.  A task holds one Arrow batch and one slice of about
    ``most`` bytes.
    """
    fields = [T.StructField(k, v) for k, v in columns.items()]
    schema = T.StructType([rows.schema["_id"], *fields] if with_id else fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("_text")), 0).to_numpy(zero_copy_only=False)
            for start, end in slices(sizes, most):
                part = batch.slice(start, end - start)
                out = work(part.column("_text").to_pylist(), part)
                at = out.pop("_row", None)
                found = [pa.array(out[k], type=arrow.field(k).type) for k in columns]
                if with_id:
                    ids = part.column("_id") if at is None else part.column("_id").take(pa.array(at, type=pa.int64()))
                    found = [ids.cast(arrow.field("_id").type), *found]
                yield pa.RecordBatch.from_arrays(found, schema=arrow)

    return rows.mapInArrow(run, schema)
