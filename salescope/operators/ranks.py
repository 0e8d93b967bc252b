"""Distributed ranks and exact quantiles.

A global ``Window.orderBy(x)`` pulls every row into one task, and Spark's exact
``percentile`` merges one value→count map per group in one task.  Both break
when a column has billions of distinct values.  Instead:

1. ``value_counts``: ``groupBy(group, x).count()`` (map-side combine; a value
   held by a third of all rows becomes one row);
2. the distinct values are cut into ``buckets`` ranges by approximate
   quantiles (one tiny aggregate, broadcast as a single row); the number of
   ranges does not depend on the shuffle partitions;
3. running counts inside each (group, bucket) come from a window partitioned
   by (group, bucket), so each window task sorts ~1/buckets of the values;
4. bucket totals (groups × buckets rows) give each bucket its offset.

The result, for every distinct value: ``cnt`` (rows with that value),
``cum_lo`` (rows strictly below it in its group) and ``n`` (rows in the group).
Average rank with ties = ``cum_lo + (cnt + 1) / 2``; the value at 0-based
position ``i`` is the one with ``cum_lo <= i < cum_lo + cnt``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Ranges into which the distinct values are cut, whatever the number of shuffle partitions.
BUCKETS = 1024


def value_counts(df: DataFrame, value: str, groups: Sequence[str] = ()) -> DataFrame:
    """``groups..., value, cnt`` over rows where value (and groups) are present; NaN is missing."""
    v = F.col(value)
    keep = v.isNotNull()
    if dict(df.dtypes)[value] in ("double", "float"):
        keep = keep & ~F.isnan(v)
    for g in groups:
        keep = keep & F.col(g).isNotNull()
    return df.filter(keep).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("cnt"))


def _below(x, bound, lo: int, hi: int):
    """How many of the sorted ``bound(lo) .. bound(hi - 1)`` are below ``x``, plus ``lo``: a binary search.

    A nested ``CASE``: compiled into the generated code, unlike a lambda over an
    array (higher-order functions are interpreted).
    """
    if lo >= hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(bound(mid) < x, _below(x, bound, mid + 1, hi)).otherwise(_below(x, bound, lo, mid))


def _with_bucket(vc: DataFrame, x, n_bounds: int) -> DataFrame:
    """Adds ``_bk``, the number of ``_bounds`` below ``x``, by a search in two levels.

    The upper level looks at every ``step``-th bound, the lower one at those in
    between, so the expression has about ``2 * sqrt(buckets)`` nodes.
    """
    step = max(1, int(n_bounds ** 0.5))
    top = n_bounds // step
    vc = vc.withColumn("_top", _below(x, lambda k: F.get("_bounds", F.lit((k + 1) * step - 1)), 0, top))
    # Past the last bound ``get`` gives NULL, which is not below ``x``.
    inner = _below(x, lambda k: F.get("_bounds", F.col("_top") * step + k), 0, step)
    return vc.withColumn("_bk", F.col("_top") * step + inner).drop("_top", "_bounds")


def with_bucket(vc: DataFrame, value: str, buckets: int = BUCKETS) -> DataFrame:
    """Adds ``_bk``, the range of ``value`` that a row falls in, of about ``buckets`` ranges with as many rows of ``vc``."""
    if buckets <= 1:
        return vc.withColumn("_bk", F.lit(0))
    x = F.col(value).cast("double")
    # Counts are positive: the filter drops no row, but keeps the column, so that the bounds and the rows
    # that look for theirs read one and the same shuffle of the counts.
    bounds = (vc.filter(F.col("cnt") > 0) if "cnt" in vc.columns else vc).agg(F.percentile_approx(x, [i / buckets for i in range(1, buckets)], 10000).alias("_bounds"))
    return _with_bucket(vc.crossJoin(F.broadcast(bounds)), x, buckets - 1)  # one row


def cumulative_counts(vc: DataFrame, value: str, groups: Sequence[str] = (),
                      buckets: int | None = None) -> DataFrame:
    """Adds ``cum_lo`` and ``n`` to a value-count frame (see module doc)."""
    groups = list(groups)
    vcb = with_bucket(vc, value, buckets or BUCKETS)
    w_in = Window.partitionBy(*groups, "_bk").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    vcb = vcb.withColumn("_cum_in", F.sum("cnt").over(w_in))
    tot = vcb.groupBy(*groups, "_bk").agg(F.sum("cnt").alias("_bt"))
    w_off = (Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))).orderBy("_bk")
    off = tot.select(*groups, "_bk",
                     F.coalesce(F.sum("_bt").over(w_off.rowsBetween(Window.unboundedPreceding, -1)),
                                F.lit(0)).alias("_off"),
                     F.sum("_bt").over(Window.partitionBy(*groups) if groups
                                       else Window.partitionBy(F.lit(0))).alias("n"))
    if not groups:
        off = F.broadcast(off)  # one row per bucket: bounded by ``buckets``
    out = vcb.join(off, [*groups, "_bk"])
    return out.select(*groups, value, "cnt",
                      (F.col("_off") + F.col("_cum_in") - F.col("cnt")).alias("cum_lo"), "n")


def average_ranks(df: DataFrame, value: str, groups: Sequence[str] = (),
                  buckets: int | None = None) -> DataFrame:
    """``groups..., value, cnt, rank``: average rank (ties share the mean position), 1-based."""
    cc = cumulative_counts(value_counts(df, value, groups), value, groups, buckets)
    return cc.select(*groups, value, "cnt", "n",
                     (F.col("cum_lo") + (F.col("cnt") + 1) / 2.0).alias("rank"))


def quantiles(df: DataFrame, value: str, probs: Sequence[float], groups: Sequence[str] = (),
              buckets: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation: ``groups..., q, quantile``.

    Same definition as numpy/pandas ``linear`` and DuckDB ``quantile_cont``:
    position ``(n-1)·q`` between the two neighbouring order statistics.
    """
    return quantiles_of_counts(value_counts(df, value, groups), value, probs, groups, buckets)


def quantiles_of_counts(counts: DataFrame, value: str, probs: Sequence[float], groups: Sequence[str] = (),
                        buckets: int | None = None) -> DataFrame:
    """The same from a value-count frame."""
    cc = cumulative_counts(counts, value, groups, buckets)
    spark = counts.sparkSession
    qs = spark.createDataFrame([(float(p),) for p in probs], "q double")
    pos = (F.col("n") - 1) * F.col("q")
    lo, hi = F.floor(pos), F.ceil(pos)
    covers = lambda i: (F.col("cum_lo") <= i) & (i < F.col("cum_lo") + F.col("cnt"))
    x = F.col(value).cast("double")
    t = (cc.crossJoin(F.broadcast(qs))
         .filter(covers(lo) | covers(hi))
         .groupBy(*groups, "q")
         .agg(F.max(F.when(covers(lo), x)).alias("_a"), F.max(F.when(covers(hi), x)).alias("_b"),
              F.first(pos - lo).alias("_t")))
    return t.select(*groups, "q", (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_t")).alias("quantile"))


def quantile_row(df: DataFrame, value: str, probs: Sequence[float], names: Sequence[str],
                 buckets: int | None = None) -> DataFrame:
    """One row with one column per requested quantile (for broadcasting onto rows)."""
    q = quantiles(df, value, probs, (), buckets)
    return q.agg(*[F.max(F.when(F.col("q") == float(p), F.col("quantile"))).alias(n)
                   for p, n in zip(probs, names)])
