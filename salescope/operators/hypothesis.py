"""Statistical tests, each one distributed aggregation plus a closed-form p-value.

Rank tests never go back to rows: they aggregate ``(group, value)`` counts,
rank the pooled distinct values with the distributed rank operator and sum
``count × rank`` per group.  Moment tests use per-group n / mean / M2.
Statistics are plain columns (SQL-checkable); p-values are added by the
vectorised tail functions in ``functions.dist``.

A test that cannot be made (too few rows or groups, no variation) gives its row
with a NULL statistic and, in ``note``, why; nothing divides by zero.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.functions.dist import mw_exact_udf, sf_chi2_udf, sf_f_udf, sf_norm_udf, sf_t_udf
from salescope.operators.ranks import BUCKETS, cumulative_counts, with_bucket
from salescope.session import written


# Notes of tests that cannot be made.
NO_VARIATION = "No evaluable: una o ambas variables no tienen variacion suficiente."
FEW_GROUPS = "No evaluable: se requieren al menos 2 grupos con mas de un registro."
FEW_ROWS = "No evaluable: no existen suficientes registros."
#: Values with at least 1 / HOT of a column's rows, at most so many a column, are joined by broadcast.
HOT = 1000


def _note(enough, statistic, why: str) -> Column:
    return F.when(~enough, F.lit(why)).when(statistic.isNull(), F.lit(NO_VARIATION))


def _present(df: DataFrame, *cols: str) -> DataFrame:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
        if dict(df.dtypes).get(c) in ("double", "float"):
            cond = cond & ~F.isnan(c)
    return df.filter(cond)


# ----------------------------------------------------------------------------- chi-square

def chi_square(df: DataFrame, a: str, b: str, label: str | None = None) -> DataFrame:
    """Pearson chi-square of independence on the contingency table of ``a`` × ``b``.

    Sums ``(o − e)²/e`` over the observed cells; the empty ones add their
    expected total, so the full category grid is never built.  Yates'
    correction is applied only when dof = 1 (2×2): there |o − e| is the same in
    all four cells and Σ 1/e over the four cells is n³ / (Π row sums · Π column sums).
    Needs at least 2 rows and 2 columns; otherwise statistic NULL with a note.
    """
    label = label or f"{a} vs {b}"
    obs = _present(df, a, b).groupBy(a, b).agg(F.count(F.lit(1)).alias("_o"))
    ra = obs.groupBy(a).agg(F.sum("_o").alias("_ra"))
    cb = obs.groupBy(b).agg(F.sum("_o").alias("_cb"))
    tot = obs.agg(F.sum("_o").alias("_n"), F.count_distinct(a).alias("_nr"), F.count_distinct(b).alias("_nc"))
    margins = ra.agg(F.product("_ra").alias("_pra")).crossJoin(cb.agg(F.product("_cb").alias("_pcb")))
    e = F.col("_ra") * F.col("_cb") / F.col("_n")
    s = (obs.join(ra, a).join(cb, b).crossJoin(F.broadcast(tot))
         .agg(F.sum(F.pow(F.col("_o") - e, 2) / e).alias("_s"), F.sum(e).alias("_se"),
              F.max(F.abs(F.col("_o") - e)).alias("_d"))
         .crossJoin(F.broadcast(margins)).crossJoin(F.broadcast(tot)))
    dof = (F.col("_nr") - 1) * (F.col("_nc") - 1)
    # Empty cells: each adds its expected count, n less that of the observed cells in all.
    plain = F.col("_s") + F.greatest(F.col("_n") - F.col("_se"), F.lit(0.0))
    d = F.col("_d")
    inv_e = F.try_divide(F.pow(F.col("_n").cast("double"), 3), F.col("_pra") * F.col("_pcb"))
    yates = F.pow(F.greatest(d - F.least(F.lit(0.5), d), F.lit(0.0)), 2) * inv_e
    ok = (F.col("_nr") >= 2) & (F.col("_nc") >= 2)
    stat = F.when(~ok, None).when(dof == 1, yates).otherwise(plain)
    return s.select(F.lit("Chi-cuadrado").alias("test"), F.lit(label).alias("variables"),
                    stat.alias("statistic"), F.when(ok, dof).cast("bigint").alias("dof"),
                    F.when(~ok, F.lit("No evaluable: se requieren al menos 2 filas y 2 columnas."))
                    .alias("note"))


# ----------------------------------------------------------------------------- group moments

def anova(df: DataFrame, group: str, value: str, label: str | None = None) -> DataFrame:
    """One-way ANOVA over groups with more than one row: F, dfs (needs ≥ 2 groups)."""
    g = (_present(df, group, value).groupBy(group)
         .agg(F.count(F.lit(1)).alias("_ng"), F.avg(value).alias("_m"), F.var_pop(value).alias("_vp"))
         .filter(F.col("_ng") > 1))
    tot = g.agg(F.sum("_ng").alias("_tn"), F.count(F.lit(1)).alias("_k"),
                (F.sum(F.col("_ng") * F.col("_m")) / F.sum("_ng")).alias("_gm"))
    s = (g.crossJoin(F.broadcast(tot)).groupBy("_tn", "_k")
         .agg(F.sum(F.col("_ng") * F.pow(F.col("_m") - F.col("_gm"), 2)).alias("_ssb"),
              F.sum(F.col("_ng") * F.col("_vp")).alias("_ssw")))
    # A single group (or none) still yields one row: statistic NULL.
    s = tot.select("_tn", "_k").join(s, ["_tn", "_k"], "left")
    ok = F.col("_k") >= 2
    f = F.try_divide(F.col("_ssb") / F.nullif(F.col("_k") - 1, F.lit(0)),
                     F.try_divide(F.col("_ssw"), F.col("_tn") - F.col("_k")))
    f = F.when(ok, f)
    return s.select(F.lit("ANOVA").alias("test"), F.lit(label or f"{value} por {group}").alias("variables"),
                    f.alias("statistic"),
                    F.when(ok, F.col("_k") - 1).cast("bigint").alias("df1"),
                    F.when(ok, F.col("_tn") - F.col("_k")).cast("bigint").alias("df2"),
                    _note(ok, f, FEW_GROUPS).alias("note"))


def welch_t(df: DataFrame, group: str, value: str, g1, g2, label: str | None = None) -> DataFrame:
    """Welch's t for group ``g1`` minus ``g2``: t and Satterthwaite df (needs > 1 row per side)."""
    x = _present(df, group, value)
    s = x.agg(*[F.count_if(F.col(group) == g).alias(f"n{i}") for i, g in ((1, g1), (2, g2))],
              *[F.avg(F.when(F.col(group) == g, F.col(value))).alias(f"m{i}") for i, g in ((1, g1), (2, g2))],
              *[F.var_samp(F.when(F.col(group) == g, F.col(value))).alias(f"v{i}") for i, g in ((1, g1), (2, g2))])
    a, b = F.try_divide("v1", "n1"), F.try_divide("v2", "n2")
    ok = (F.col("n1") > 1) & (F.col("n2") > 1)
    t = F.when(ok, F.try_divide(F.col("m1") - F.col("m2"), F.sqrt(a + b)))
    dof = F.try_divide(F.pow(a + b, 2), F.try_divide(F.pow(a, 2), F.col("n1") - 1)
                       + F.try_divide(F.pow(b, 2), F.col("n2") - 1))
    return s.select(F.lit(label or f"{value}: {g1} vs {g2}").alias("variables"), "n1", "n2",
                    t.alias("statistic"), F.when(ok, dof).alias("dof"), _note(ok, t, FEW_ROWS).alias("note"))


def with_t_pvalues(t: DataFrame, stat: str = "statistic", dof: str = "dof") -> DataFrame:
    """Adds two-sided and one-sided ('greater') p-values for a t statistic."""
    tail = sf_t_udf(F.abs(F.col(stat)), F.col(dof))
    two = F.when(tail.isNotNull(), F.least(F.lit(1.0), 2.0 * tail))  # ``least`` skips NULL
    one = F.when(F.col(stat) > 0, two / 2).otherwise(1 - two / 2)
    return t.withColumn("p_value", two).withColumn("p_greater", one)


# ----------------------------------------------------------------------------- rank tests

def _group_ranks(df: DataFrame, tests: Sequence[str], group: str, value: str, buckets=None,
                 min_rows: int = 1) -> DataFrame:
    """(tests, group, value, cnt, t, rank): ranks over the pooled values of each test.

    Everything comes from the counts per (group, value); groups with fewer than
    ``min_rows`` rows are left out of them.  ``t`` is the rows sharing a value.
    """
    keys = [*tests, group]
    gv = _present(df, group, value).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("cnt"))
    if min_rows > 1:
        sizes = gv.groupBy(*keys).agg(F.sum("cnt").alias("_ng")).filter(F.col("_ng") >= min_rows).drop("_ng")
        gv = gv.join(sizes, keys, "left_semi")
    return _ranked_counts(gv, tests, value, buckets)


def _ranked_counts(gv: DataFrame, tests: Sequence[str], value: str, buckets=None) -> DataFrame:
    pooled = gv.groupBy(*tests, value).agg(F.sum("cnt").alias("cnt"))
    ranks = cumulative_counts(pooled, value, tests, buckets).select(
        *tests, value, F.col("cnt").alias("t"), (F.col("cum_lo") + (F.col("cnt") + 1) / 2.0).alias("rank"))
    return gv.join(ranks, [*tests, value])


def _tie_sum(t) -> Column:
    """``Σ (t³ − t)`` over distinct values, from rows that each hold ``cnt`` of the ``t`` rows of a value."""
    t = t.cast("double")
    return F.sum(F.col("cnt") * (t * t - 1.0))


def kruskal(df: DataFrame, group: str, value: str, label: str | None = None, buckets=None) -> DataFrame:
    """Kruskal-Wallis H with tie correction over groups with more than one row."""
    gr = _group_ranks(df, [], group, value, buckets, min_rows=2)
    per = gr.groupBy(group).agg(F.sum("cnt").alias("ng"), F.sum(F.col("cnt") * F.col("rank")).alias("rs"),
                                _tie_sum(F.col("t")).alias("tg"))
    return _kruskal(per, label or f"{value} por {group}")


def _kruskal(per: DataFrame, label: str) -> DataFrame:
    """H from rows ``ng``, rank sum ``rs`` and tie sum ``tg`` of each group."""
    s = per.agg(F.sum("ng").alias("N"), F.count(F.lit(1)).alias("k"), F.sum("tg").alias("tt"),
                F.sum(F.pow(F.col("rs"), 2) / F.col("ng")).alias("q"))
    n = F.col("N").cast("double")
    h = F.lit(12.0) / (n * (n + 1)) * F.col("q") - 3 * (n + 1)
    c = 1 - F.try_divide(F.col("tt"), F.pow(n, 3) - n)
    ok = F.col("k") >= 2
    stat = F.when(ok & (c > 0), F.try_divide(h, c))
    return s.select(F.lit("Kruskal-Wallis").alias("test"),
                    F.lit(label).alias("variables"),
                    stat.alias("statistic"), F.when(ok, F.col("k") - 1).cast("bigint").alias("dof"),
                    _note(ok, stat, FEW_GROUPS).alias("note"))


def mann_whitney(df: DataFrame, group: str, value: str, g1, g2, label: str | None = None,
                 buckets=None) -> DataFrame:
    """Mann-Whitney U of ``g1`` (first sample) against ``g2``; tie-corrected normal approximation.

    Columns: U1, mu, sigma, the z values used for the two-sided and the
    'greater' alternatives with 0.5 continuity correction, and whether there are
    ``ties`` (without, p-values of small groups are exact: ``with_mw_pvalues``).
    """
    out = mann_whitney_by(df, [], group, value, g1, g2, buckets)
    return out.select(F.lit(label or f"{value}: {g1} vs {g2}").alias("variables"), "*")


def mann_whitney_by(df: DataFrame, tests: Sequence[str], group: str, value: str, g1, g2,
                    buckets=None) -> DataFrame:
    """Many Mann-Whitney tests in one pass: one test per distinct value of the ``tests`` columns.

    ``df`` is long (e.g. several variables stacked as ``(test..., group, value)``);
    values are ranked within each test by the grouped distributed rank operator,
    so k tests cost one scan and one set of shuffles instead of k.  Output
    columns as in ``mann_whitney`` (without ``variables``), keyed by ``tests``.
    """
    both = _present(df.filter((F.col(group) == g1) | (F.col(group) == g2)), group, value)
    return mann_whitney_of_counts(both.groupBy(*tests, group, value).agg(F.count(F.lit(1)).alias("cnt")), tests, group, value, g1, buckets)


def mann_whitney_of_counts(counts: DataFrame, tests: Sequence[str], group: str, value: str, g1, buckets=None) -> DataFrame:
    """The same from counts (tests, group, value, ``cnt``) of the two groups."""
    tests = list(tests)
    gr = _ranked_counts(counts, tests, value, buckets)
    first = F.col(group) == g1
    s = gr.groupBy(*tests).agg(
        F.coalesce(F.sum(F.when(first, F.col("cnt"))), F.lit(0)).alias("n1"),
        F.coalesce(F.sum(F.when(~first, F.col("cnt"))), F.lit(0)).alias("n2"),
        F.sum(F.when(first, F.col("cnt") * F.col("rank"))).alias("r1"), _tie_sum(F.col("t")).alias("tt"))
    return _mann_whitney(s, tests)


def _mann_whitney(s: DataFrame, tests: list[str]) -> DataFrame:
    """U and z from rows ``n1``, ``n2``, first group's rank sum ``r1`` and tie sum ``tt`` of each test."""
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n = n1 + n2
    ok = (n1 > 0) & (n2 > 0)
    u1 = F.when(ok, F.col("r1") - n1 * (n1 + 1) / 2)
    mu = n1 * n2 / 2
    spread = F.sqrt(F.greatest(n1 * n2 / 12 * ((n + 1) - F.try_divide(F.col("tt"), n * (n - 1))), F.lit(0.0)))
    sigma = F.when(ok, spread)
    u2 = n1 * n2 - u1
    z = F.try_divide(F.greatest(u1, u2) - mu - 0.5, sigma)
    return s.select(*tests, "n1", "n2", u1.alias("statistic"), mu.alias("mu"), sigma.alias("sigma"),
                    z.alias("z_two_sided"), F.try_divide(u1 - mu - 0.5, sigma).alias("z_greater"),
                    (F.col("tt") > 0).alias("ties"), _note(ok, z, FEW_ROWS).alias("note"))


def shared_ranks(df: DataFrame, value: str, groups: Sequence[str],
                 two_groups: Sequence[tuple[str, object, object]] = ()) -> DataFrame:
    """Everything rank tests of one ``value`` need, from one ranking of its counts by ``groups``.

    A row of the result is a (groups, value) with its rows ``cnt``.  Test i ranks
    its own rows only: the first ``len(groups)`` tests those whose group has more
    than one row (Kruskal-Wallis), the others those of two groups
    ``(group, g1, g2)`` (Mann-Whitney).  ``_in<i>`` says whether a row belongs to
    test i, ``_t<i>`` how many of its rows share the value, and ``_r<i>`` is the
    average rank among them.  The value is sorted once: running counts of all
    tests come from one window, and their offsets from one table of buckets.
    """
    base = _present(df.select(*groups, value), value).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("cnt"))
    base = written(base, "group-value-counts")
    for i, g in enumerate(groups):
        sizes = base.where(F.col(g).isNotNull()).groupBy(F.col(g).alias(f"_g{i}")).agg(F.sum("cnt").alias(f"_s{i}"))
        base = base.join(sizes, F.col(g) == F.col(f"_g{i}"), "left").withColumn(
            f"_in{i}", F.coalesce(F.col(f"_s{i}") > 1, F.lit(False))).drop(f"_g{i}", f"_s{i}")
    for i, (g, g1, g2) in enumerate(two_groups, len(groups)):
        base = base.withColumn(f"_in{i}", F.coalesce((F.col(g) == g1) | (F.col(g) == g2), F.lit(False)))
    tests = range(len(groups) + len(two_groups))
    base = with_bucket(base, value, BUCKETS)
    # Equal values share a bucket; a range frame takes all rows of a value together.
    upto = Window.partitionBy("_bk").orderBy(value).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ties = Window.partitionBy("_bk", value)
    mine = {i: F.when(F.col(f"_in{i}"), F.col("cnt")).otherwise(F.lit(0)) for i in tests}
    base = base.select("*", *[F.sum(mine[i]).over(upto).alias(f"_c{i}") for i in tests],
                       *[F.sum(mine[i]).over(ties).alias(f"_t{i}") for i in tests])
    totals = base.groupBy("_bk").agg(*[F.sum(mine[i]).alias(f"_b{i}") for i in tests])
    earlier = Window.partitionBy(F.lit(0)).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_bk", *[F.coalesce(F.sum(f"_b{i}").over(earlier), F.lit(0)).alias(f"_o{i}") for i in tests])
    ranked = base.join(F.broadcast(offsets), "_bk")  # one row a bucket
    return written(ranked.select(*groups, value, "cnt", *[c for i in tests for c in (
        f"_in{i}", f"_t{i}", (F.col(f"_o{i}") + F.col(f"_c{i}") - (F.col(f"_t{i}") - 1) / 2.0).alias(f"_r{i}"))]), "shared-ranks")


def kruskal_of_ranks(ranks: DataFrame, i: int, group: str, value: str) -> DataFrame:
    """Test ``i`` of ``shared_ranks`` as Kruskal-Wallis over ``group``."""
    per = ranks.where(f"_in{i}").groupBy(group).agg(
        F.sum("cnt").alias("ng"), F.sum(F.col("cnt") * F.col(f"_r{i}")).alias("rs"), _tie_sum(F.col(f"_t{i}")).alias("tg"))
    return _kruskal(per, f"{value} por {group}")


def mann_whitney_of_ranks(ranks: DataFrame, i: int, group: str, g1, label: str) -> DataFrame:
    """Test ``i`` of ``shared_ranks`` as Mann-Whitney of ``g1`` against the other group."""
    first = F.col(group) == g1
    s = ranks.where(f"_in{i}").agg(
        F.coalesce(F.sum(F.when(first, F.col("cnt"))), F.lit(0)).alias("n1"),
        F.coalesce(F.sum(F.when(~first, F.col("cnt"))), F.lit(0)).alias("n2"),
        F.sum(F.when(first, F.col("cnt") * F.col(f"_r{i}"))).alias("r1"), _tie_sum(F.col(f"_t{i}")).alias("tt"))
    return _mann_whitney(s, []).select(F.lit(label).alias("variables"), "*")


def with_mw_pvalues(mw: DataFrame) -> DataFrame:
    """Adds ``p_value`` (two-sided) and ``p_greater``: exact where a group has at most 8 rows and no two are equal."""
    normal = sf_norm_udf(F.col("z_two_sided"))
    exact = mw_exact_udf(F.col("statistic"), F.col("n1").cast("double"), F.col("n2").cast("double"), F.col("ties"))
    out = mw.withColumn("_exact", exact).withColumn("_normal", normal)
    two = F.when(F.col("_normal").isNotNull(), F.least(F.lit(1.0), 2.0 * F.col("_normal")))
    return (out.withColumn("p_value", F.coalesce(F.col("_exact")["two_sided"], two))
            .withColumn("p_greater", F.coalesce(F.col("_exact")["greater"], sf_norm_udf(F.col("z_greater"))))
            .drop("_exact", "_normal"))


def spearman_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]], buckets=None, weight: str | None = None) -> DataFrame:
    """Spearman ρ for each pair, pairwise-complete (pandas semantics); a row stands for ``weight`` equal ones.

    Columns without a missing value are ranked once each, whatever the number of
    pairs; the ranks are attached to the rows column by column (a column of few
    values by broadcast, decided at run time) and all cross-products are summed in
    one aggregate over the rows.  A pair with a missing value on either side
    needs ranks of its own: those pairs go through their value counts
    (``_pairs_with_gaps``).  Constant side → NULL.
    """
    cols = sorted({c for p in pairs for c in p})
    miss = df.agg(*[F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(c)
                    for c in cols]).first().asDict()
    whole = [p for p in pairs if not miss[p[0]] and not miss[p[1]]]
    gaps = [p for p in pairs if miss[p[0]] or miss[p[1]]]
    df = df.select(*cols, (F.lit(1).cast("long") if weight is None else F.col(weight)).alias("_w"))
    out = [f(df, ps, buckets) for f, ps in ((_pairs_without_gaps, whole), (_pairs_with_gaps, gaps)) if ps]
    return out[0] if len(out) == 1 else out[0].unionByName(out[1])


def with_ranks(df: DataFrame, cols: Sequence[str], buckets=None) -> DataFrame:
    """``cols`` of ``df`` as doubles ``_v<i>``, each with its centred average rank ``_r<i>`` over all rows, ``_w`` and ``_n``."""
    stack = ", ".join(f"{i}, CAST(`{c}` AS DOUBLE)" for i, c in enumerate(cols))
    counts = df.selectExpr("_w", f"stack({len(cols)}, {stack}) AS (k, v)").groupBy("k", "v").agg(F.sum("_w").alias("cnt"))
    ranks = written(cumulative_counts(counts, "v", ["k"], buckets).select(
        "k", "v", (F.col("cum_lo") + (F.col("cnt") + 1) / 2.0 - (F.col("n") + 1) / 2.0).alias("r"), "n"), "column-ranks", "k")
    out = df.select("_w", *(F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(cols)))
    for i in range(len(cols)):
        mine = ranks.where(F.col("k") == i).select(F.col("v").alias(f"_v{i}"), F.col("r").alias(f"_r{i}"),
                                                   *([F.col("n").alias("_n")] if i == 0 else []))
        out = out.join(mine, f"_v{i}")
    return out


def _pairs_without_gaps(df: DataFrame, pairs: Sequence[tuple[str, str]], buckets=None) -> DataFrame:
    cols = sorted({c for p in pairs for c in p})
    at = {c: i for i, c in enumerate(cols)}
    r = [F.col(f"_r{i}") for i in range(len(cols))]
    # Two columns may be one pair twice, or in both orders: sums go by position.
    sums = with_ranks(df, cols, buckets).agg(
        F.max("_n").alias("n"), *[F.sum(F.col("_w") * r[i] * r[i]).alias(f"s{i}") for i in range(len(cols))],
        *[F.sum(F.col("_w") * r[at[a]] * r[at[b]]).alias(f"p{k}") for k, (a, b) in enumerate(pairs)])
    rows = ", ".join(f"'{a}', '{b}', p{k}, s{at[a]}, s{at[b]}" for k, (a, b) in enumerate(pairs))
    long = sums.selectExpr("n", f"stack({len(pairs)}, {rows}) AS (var_a, var_b, sab, saa, sbb)")
    rho = F.when((F.col("saa") > 0) & (F.col("sbb") > 0), F.col("sab") / F.sqrt(F.col("saa") * F.col("sbb")))
    return long.select("var_a", "var_b", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), rho.alias("rho"))


def _pairs_with_gaps(df: DataFrame, pairs: Sequence[tuple[str, str]], buckets=None) -> DataFrame:
    """The same over the complete rows of each pair, in one job.

    Rows are stacked to (pair, a, b) and pre-aggregated to pair-value counts; ρ
    is the count-weighted Pearson correlation of centred ranks.  Both joins to
    the ranks are keyed by a side's value; a value that fills more than
    ``1 / HOT`` of a side goes by broadcast (at most ``HOT`` of them a side).
    """
    keys = {i: (f"#{i}a", f"#{i}b") for i in range(len(pairs))}
    stack = ", ".join(f"{i}, CAST(`{a}` AS DOUBLE), CAST(`{b}` AS DOUBLE)" for i, (a, b) in enumerate(pairs))
    long = (df.selectExpr("_w", f"stack({len(pairs)}, {stack}) AS (pair, a, b)")
            .filter(F.col("a").isNotNull() & F.col("b").isNotNull() & ~F.isnan("a") & ~F.isnan("b")))
    pc = long.groupBy("pair", "a", "b").agg(F.sum("_w").alias("cnt"))

    def key_of(side: int):
        expr = F.lit(None).cast("string")
        for i, k in keys.items():
            expr = F.when(F.col("pair") == i, F.lit(k[side])).otherwise(expr)
        return expr

    pc = pc.withColumn("ka", key_of(0)).withColumn("kb", key_of(1))
    margs = [pc.groupBy(F.col(key).alias("k"), F.col(side).alias("v")).agg(F.sum("cnt").alias("cnt"))
             for side, key in (("a", "ka"), ("b", "kb"))]
    marg = margs[0]
    for m in margs[1:]:
        marg = marg.unionByName(m)
    ranks = cumulative_counts(marg, "v", ["k"], buckets).select(
        "k", "v", "cnt", (F.col("cum_lo") + (F.col("cnt") + 1) / 2.0).alias("r"), "n")
    j = _ranked(_ranked(pc, ranks, "ka", "a", "ra"), ranks, "kb", "b", "rb")
    mid = (F.col("_n_ra") + 1) / 2.0
    da, db = F.col("ra") - mid, F.col("rb") - mid
    s = j.groupBy("pair", F.col("_n_ra").alias("n")).agg(F.sum(F.col("cnt") * da * db).alias("sab"),
                                                         F.sum(F.col("cnt") * da * da).alias("saa"),
                                                         F.sum(F.col("cnt") * db * db).alias("sbb"))
    names = df.sparkSession.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)],
                                            "pair int, var_a string, var_b string")
    rho = F.when((F.col("saa") > 0) & (F.col("sbb") > 0), F.col("sab") / F.sqrt(F.col("saa") * F.col("sbb")))
    return (names.join(s, "pair", "left")
            .select("var_a", "var_b", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), rho.alias("rho")))


def _ranked(rows: DataFrame, ranks: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Adds the rank of ``value`` in the column ``key`` names, and that column's rows (``_n_<out>``)."""
    side = ranks.select(F.col("k").alias(key), F.col("v").alias(value), F.col("r").alias(out),
                        F.col("n").alias(f"_n_{out}"), "cnt", F.col("n").alias("_all"))
    common = F.col("cnt") * HOT >= F.col("_all")
    hot = side.filter(common).select(key, value, F.col(out).alias("_hot"), F.col(f"_n_{out}").alias("_hot_n"))
    rest = side.filter(~common).drop("cnt", "_all")
    tagged = rows.join(F.broadcast(hot), [key, value], "left")
    by_key = tagged.filter(F.col("_hot").isNull()).drop("_hot", "_hot_n").join(rest, [key, value])
    by_broadcast = (tagged.filter(F.col("_hot").isNotNull())
                    .withColumnRenamed("_hot", out).withColumnRenamed("_hot_n", f"_n_{out}"))
    return by_key.unionByName(by_broadcast)


def with_spearman_pvalues(sp: DataFrame) -> DataFrame:
    """t = ρ√((n−2)/(1−ρ²)); p = 2·P(T_{n−2} > |t|)."""
    r = F.col("rho")
    t = r * F.sqrt(F.try_divide(F.greatest(F.col("n") - 2, F.lit(0)), F.greatest(1 - r * r, F.lit(0.0))))
    p = F.when(F.abs(r) >= 1, F.lit(0.0)).otherwise(2.0 * sf_t_udf(F.abs(t), (F.col("n") - 2).cast("double")))
    return sp.withColumn("p_value", F.when(r.isNotNull() & (F.col("n") > 2), p))


def with_f_pvalue(df: DataFrame) -> DataFrame:
    return df.withColumn("p_value", sf_f_udf(F.col("statistic"), F.col("df1").cast("double"),
                                             F.col("df2").cast("double")))


def with_chi2_pvalue(df: DataFrame) -> DataFrame:
    return df.withColumn("p_value", sf_chi2_udf(F.col("statistic"), F.col("dof").cast("double")))


# ----------------------------------------------------------------------------- regression / residuals

def simple_ols(df: DataFrame, y: str, x: str) -> DataFrame:
    """y = a + b·x: slope, intercept, R², n and the slope's t statistic (df n−2)."""
    d = _present(df, y, x)
    s = d.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
              F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n"),
              F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("syy"), F.regr_sxy(y, x).alias("sxy"),
              ((F.min(x) < F.max(x)) & (F.min(y) < F.max(y))).alias("varies"))
    sse = F.greatest(F.col("syy") - F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx")), F.lit(0.0))
    se = F.sqrt(F.try_divide(F.try_divide(sse, F.nullif(F.greatest(F.col("n") - 2, F.lit(0)), F.lit(0))), F.col("sxx")))
    t = F.when(F.col("varies"), F.try_divide(F.col("slope"), se))
    return s.select("slope", "intercept", "r2", "n", t.alias("t_slope"), _note(F.col("n") > 2, t, FEW_ROWS).alias("note"))


def jarque_bera(df: DataFrame, value: str) -> DataFrame:
    """JB = n/6·(S² + K²/4) with population skewness S and excess kurtosis K; χ²(2)."""
    d = _present(df, value)
    s = d.agg(F.count(F.lit(1)).alias("n"), F.skewness(value).alias("s"), F.kurtosis(value).alias("k"))
    return s.select("n", (F.col("n") / 6.0 * (F.pow("s", 2) + F.pow("k", 2) / 4.0)).alias("statistic"))
