"""Row numbers within groups without a task that holds a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescope.llm.common import stored


def numbered(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``df`` with ``_rank`` (from 0 in each group, nulls first) and ``_n``, the rows of the group.

    The rows are dealt by ranges of (group, order), so a group of any size is
    spread over as many tasks as its rows need; a number is the place within the
    range plus the rows of the group in earlier ranges.  Ties in ``order`` take
    any order among themselves.  ``df`` should be a stored table, as it is read
    twice: once for the bounds of the ranges.
    """
    keys = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    at = stored(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                .withColumn("_at", F.monotonically_increasing_id()), name)
    mine = [F.col(c).alias(f"_group{k}") for k, c in enumerate(group)] or [F.lit(0).alias("_group0")]
    runs = at.groupBy(*mine, F.shiftright("_at", 33).alias("_range")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_count"))
    # One row a group and range: the window of a group holds as many rows as there are ranges.
    names = [c for c in runs.columns if c.startswith("_group")]
    w = Window.partitionBy(*names)
    before = F.sum("_count").over(w.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(*names, "_range", "_first", F.coalesce(before, F.lit(0)).alias("_before"),
                       F.sum("_count").over(w).alias("_n"))
    same = F.shiftright(at["_at"], 33) == runs["_range"]
    for k, c in enumerate(group):
        same &= at[c].eqNullSafe(runs[f"_group{k}"])
    return at.join(runs, same).select(
        *(at[c] for c in df.columns),
        (F.col("_at") - F.col("_first") + F.col("_before")).alias("_rank"), "_n")
