"""Ranks, quantiles, tests and series against brute force on small frames."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescope.functions import dist as D
from salescope.operators import hypothesis as H
from salescope.operators import profile as PR
from salescope.operators import timeseries as TS
from salescope.operators.ranks import average_ranks, quantiles


def _frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_golden_tails():
    assert math.isclose(D.chi2_sf(89.33391098876254, 5), 9.273253463459305e-18, rel_tol=1e-8)
    assert math.isclose(D.f_sf(17.877424051435252, 5, 139994), 9.158976271431795e-18, rel_tol=1e-6)
    assert math.isclose(D.f_sf(150.36316176947395, 3, 3239989), 1.9230113712067684e-97, rel_tol=1e-6)
    assert math.isclose(D.norm_ppf(0.975), 1.959963984540054, rel_tol=1e-12)


def test_shapiro_and_ks_golden():
    from salescope.plans.reports import shapiro_p
    assert math.isclose(shapiro_p(0.9781382429498547, 5000), 4.600643362398074e-27, rel_tol=1e-4)
    assert math.isclose(D.kolmogorov_sf(0.1947538545, 5000), 1.289321991e-166, rel_tol=1e-5)
    # Exact values (n = 10 and 100) of the finite-sample distribution.
    assert math.isclose(D.kolmogorov_sf(0.5, 10), 0.007777409999999763, rel_tol=0.01)
    assert math.isclose(D.kolmogorov_sf(0.1, 100), 0.2526927570063904, rel_tol=1e-4)


def _shapiro_direct(x):
    """W with the whole weight vector."""
    x, n = np.sort(x), len(x)
    m = np.array([D.norm_ppf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    mm, u = float(m @ m), 1 / math.sqrt(n)
    a1 = np.polyval([-2.706056, 4.434685, -2.071190, -0.147981, 0.221157, m[-1] / math.sqrt(mm)], u)
    a2 = np.polyval([-3.582633, 5.682633, -1.752461, -0.293762, 0.042981, m[-2] / math.sqrt(mm)], u)
    if n <= 5:
        w = m / math.sqrt((mm - 2 * m[-1] ** 2) / (1 - 2 * a1 ** 2))
    else:
        w = m / math.sqrt((mm - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * a1 ** 2 - 2 * a2 ** 2))
        w[1], w[-2] = -a2, a2
    w[0], w[-1] = -a1, a1
    return float((w @ x) ** 2 / np.sum((x - x.mean()) ** 2))


def test_normality_reads_all_rows(spark):
    from salescope.plans.reports import normality
    rng = np.random.default_rng(11)
    data = {"a": rng.normal(size=7000), "b": np.round(rng.exponential(3, 7000)), "c": np.full(7000, 2.0)}
    df = _frame(spark, list(zip(*(v.tolist() for v in data.values()))), "a double, b double, c double")
    got = {r["variable"]: r for r in normality(df, ["a", "b", "c"]).collect()}
    for c in ("a", "b"):
        x = np.sort(data[c])
        assert got[c]["n"] == 7000 and math.isclose(got[c]["shapiro_stat"], _shapiro_direct(x), rel_tol=1e-6)
        cdf = np.array([1 - D.norm_sf(v) for v in (x - x.mean()) / x.std(ddof=1)])
        i = np.arange(1, 7001)
        assert math.isclose(got[c]["ks_stat"], max((i / 7000 - cdf).max(), (cdf - (i - 1) / 7000).max()), rel_tol=1e-9)
    assert got["c"]["shapiro_stat"] is None and got["c"]["note"]
    for n in (2, 3, 5, 8, 11):
        r = normality(df.limit(n), ["a"]).first()
        if n < 3:
            assert r["note"]
        else:
            x = np.array([v["a"] for v in df.limit(n).collect()])
            want = (x.max() - x.min()) ** 2 / 2 / np.sum((x - x.mean()) ** 2) if n == 3 else _shapiro_direct(x)
            assert math.isclose(r["shapiro_stat"], want, rel_tol=1e-9) and 0 <= r["shapiro_p"] <= 1


def test_nothing_to_test_gives_a_note(spark):
    """Constant, tied, single-group, tiny and empty input: a row with a note, never an error."""
    schema = "g string, x double, y double"
    frames = [[("a", 1.0, float(i)) for i in range(4)] + [("b", 1.0, float(i)) for i in range(4)],
              [("a", 1.0, 1.0), ("b", 2.0, 2.0)], []]
    for rows in frames:
        df = _frame(spark, rows, schema)
        for test in (H.anova(df, "g", "x"), H.kruskal(df, "g", "x"), H.welch_t(df, "g", "x", "a", "b"),
                     H.simple_ols(df, "y", "x"), H.simple_ols(df, "x", "y")):
            r = test.first()
            stat = r["statistic"] if "statistic" in test.columns else r["t_slope"]
            assert stat is not None or r["note"], (rows, r)
        mw = H.with_mw_pvalues(H.mann_whitney(df, "g", "x", "a", "b")).first()
        assert mw["z_two_sided"] is not None or mw["note"]
        c = H.chi_square(df, "g", "x").collect()
        assert len(c) == 1 and (c[0]["statistic"] is not None or c[0]["note"])
        sp = H.with_spearman_pvalues(H.spearman_pairs(df, [("x", "y")])).first()
        assert sp["rho"] is None or abs(sp["rho"]) <= 1 + 1e-12
        assert PR.density_histogram(df, "x", 5).count() == (0 if not rows else 1 if len({r[1] for r in rows}) == 1 else 5)
        PR.kde_curve(df, "x", 10).collect()
        PR.box_stats(df, "g", "x").collect()


def test_suite_with_constant_units(spark):
    from salescope.plans.reports import hypothesis_suite
    rows = [(c, 1, round(0.01 * (i % 9), 2), 100.0 + i, 20.0 + i % 50, 1 + i % 2) for i in range(60) for c in ("APP", "WEB")]
    df = _frame(spark, rows, "channel string, units long, discount double, amount double, age double, gender int")
    suite = hypothesis_suite(df).collect()
    assert len(suite) == 9
    by = {(r["name"], r["test"]): r for r in suite}
    row = by["H0_DESCUENTO_UNIDADES", "Regresion lineal simple"]
    assert row["decision"] == "No evaluable" and row["note"]
    few = hypothesis_suite(df.filter("channel = 'APP' AND gender = 1")).collect()
    assert len(few) == 9 and all(r["note"] for r in few if r["name"] in ("H0_APP_WEB", "H4", "H1"))


def _few(spark, n, channels=5, varied=True):
    return spark.range(n).selectExpr(
        "id AS record_no", "timestamp_ntz'2024-05-01 10:00:00' + make_dt_interval(id) AS ts", "100.0D + id * id AS amount",
        f"concat('c', id % {channels}) AS channel", f"{'id % 7' if varied else '1'} AS store",
        f"{'1 + id % 3' if varied else '1'} AS units", f"{'0.01D * (id % 4)' if varied else '0.1D'} AS discount",
        "30.0D + id AS age", "id % 2 AS gender", "id % 3 AS purchase_frequency", "id AS sku")


@pytest.mark.parametrize("n", [0, 1, 4, 5, 9, 10, 12, 40])
@pytest.mark.parametrize("varied", [True, False])
def test_models_on_few_rows_and_constant_predictors(spark, n, varied):
    from salescope.plans.reports import boosted_metrics, linear_diagnostics, linear_report
    report = linear_report(spark, linear_diagnostics(_few(spark, n, 5 if varied else 1, varied))).collect()
    if n < 40 or not varied:
        assert len(report) == 1 and report[0]["note"] and report[0]["value"] == n
    else:
        assert {r["section"] for r in report} >= {"coeficiente", "vif", "breusch_pagan", "extrapolabilidad"}
    row = boosted_metrics(_few(spark, n, 5, varied), iters=3).first()
    assert (row["note"] is not None) == (n < 4)
    if n >= 4:
        assert row["train"] + row["n"] == n and row["n"] == math.ceil((0.3 if n >= 10 else 0.5) * n) and row["mae"] is not None


def test_residual_tests_and_vif_in_one_pass(spark):
    from salescope.operators import model as M
    rng = np.random.default_rng(9)
    x = rng.normal(size=(200, 3)) + [5, 0, -2]
    y = 1 + x @ [2, -1, 0.5] + rng.normal(size=200) * (1 + 0.3 * np.abs(x[:, 0]))
    df = _frame(spark, [tuple(map(float, (*r, t))) for r, t in zip(x, y, strict=True)], "a double, b double, c double, y double")
    fit = M.ols(df, "y", ["a", "b", "c"])
    res = M.residuals(df, fit, "y")
    got, want = M.residual_tests(res, fit), M.breusch_pagan(res, ["a", "b", "c"])
    for k in want:
        assert math.isclose(got[k], want[k], rel_tol=1e-8)
    assert math.isclose(got["jb_stat"], H.jarque_bera(res, "resid").first()["statistic"], rel_tol=1e-8)
    for (c, v), (c2, v2) in zip(M.vif_of_fit(fit), M.vif(df, ["a", "b", "c"]), strict=True):
        assert c == c2 and math.isclose(v, v2, rel_tol=1e-8)


def test_ols_refuses_fewer_rows_than_coefficients(spark):
    from salescope.operators import model as M
    with pytest.raises(ValueError):
        M.ols(_few(spark, 2), "amount", ["store", "units"])


def test_ols_keeps_digits_of_large_codes(spark):
    from salescope.operators import model as M
    rng = np.random.default_rng(5)
    x1, x2 = 9e8 + rng.integers(0, 1000, 400).astype(float), rng.normal(size=400)
    y = 3 + 0.5 * (x1 - 9e8) - 2 * x2 + rng.normal(size=400)
    df = _frame(spark, [tuple(map(float, r)) for r in zip(x1, x2, y)], "x1 double, x2 double, y double")
    fit = M.ols(df, "y", ["x1", "x2"])
    a = np.column_stack([np.ones(400), x1 - x1.mean(), x2 - x2.mean()])
    b, sse = np.linalg.lstsq(a, y, rcond=None)[:2]
    assert np.allclose(fit["beta"][1:], b[1:], rtol=1e-9)
    assert math.isclose(fit["r2"], 1 - sse[0] / ((y - y.mean()) ** 2).sum(), rel_tol=1e-9)
    bp = M.breusch_pagan(M.residuals(df, fit, "y"), ["x1", "x2"])
    assert 0 <= bp["lm_p_value"] <= 1
    v = dict(M.vif(df, ["x1", "x2"]))
    xx = np.column_stack([x1, x2])
    assert np.allclose([v["x1"], v["x2"]], np.diag(np.linalg.inv(xx.T @ xx)) * np.diag(xx.T @ xx), rtol=1e-6)


def test_sample_and_split_sizes(spark):
    from salescope.operators import model as M
    df = spark.range(1000).withColumnRenamed("id", "k")
    for n in (0, 1, 137, 1000, 5000):
        assert M.seeded_sample(df, n, ["k"]).count() == min(n, 1000)
    assert M.seeded_sample(df.withColumn("k", F.lit(1)), 300, ["k"]).count() == 300
    s = {r["split"]: r["count"] for r in M.train_test_split(df, ["k"], 0.25).groupBy("split").count().collect()}
    assert s == {"test": 250, "train": 750}
    assert set(M.one_hot(df.limit(3), "k").columns) == {"k_1", "k_2"}
    with pytest.raises(ValueError):
        M.one_hot(spark.range(1500).withColumnRenamed("id", "k"), "k")


def test_a_heavy_customer_is_joined_by_broadcast(spark):
    from salescope.operators import clean as C
    rows = [("big" if i % 10 < 7 else f"c{i}" if i % 10 < 9 else None, i) for i in range(3000)]
    df = _frame(spark, rows, "customer_id string, n int")
    out = C.purchase_frequency(df)
    want = {}
    for c, _ in rows:
        want[c] = want.get(c, 0) + 1
    got = {(r["n"], r["customer_id"]): r["purchase_frequency"] for r in out.collect()}
    assert len(got) == 3000 and all(f == (want[c] if c else None) for (_, c), f in got.items())


def test_rank_buckets_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(3)
    vals = np.round(rng.normal(size=3000), 2).tolist()
    df = _frame(spark, [(v,) for v in vals], "x double")
    want = dict(zip(vals, _ranks(vals)))
    for buckets in (None, 2, 10, 37, 200):
        assert all(math.isclose(r["rank"], want[r["x"]]) for r in average_ranks(df, "x", buckets=buckets).collect())


@pytest.mark.parametrize("buckets", [1, 3, 7])
def test_quantiles_match_numpy(spark, buckets):
    rng = np.random.default_rng(1)
    vals = np.round(rng.exponential(10, 500), 1).tolist() + [5.0] * 200
    df = _frame(spark, [(float(v), i % 3) for i, v in enumerate(vals)], "x double, g int")
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r["q"]: r["quantile"] for r in quantiles(df, "x", probs, buckets=buckets).collect()}
    for p in probs:
        assert math.isclose(got[p], float(np.quantile(vals, p)), rel_tol=1e-12, abs_tol=1e-12)
    gq = {(r["g"], r["q"]): r["quantile"] for r in quantiles(df, "x", [0.5], ["g"], buckets).collect()}
    for g in range(3):
        sub = [v for i, v in enumerate(vals) if i % 3 == g]
        assert math.isclose(gq[(g, 0.5)], float(np.median(sub)), rel_tol=1e-12)


def test_average_ranks_sum(spark):
    vals = [3.0, 1.0, 3.0, 2.0, 3.0, 5.0, 1.0]
    df = _frame(spark, [(v,) for v in vals], "x double")
    r = {row["x"]: row["rank"] for row in average_ranks(df, "x", buckets=2).collect()}
    assert r == {1.0: 1.5, 2.0: 3.0, 3.0: 5.0, 5.0: 7.0}
    assert sum(r[v] for v in vals) == len(vals) * (len(vals) + 1) / 2


def _ranks(a):
    a = np.asarray(a, dtype=float)
    order = a.argsort(kind="mergesort")
    r = np.empty(len(a))
    r[order] = np.arange(1, len(a) + 1)
    for v in np.unique(a):
        m = a == v
        r[m] = r[m].mean()
    return r


def test_spearman_pairwise(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 5, 300).astype(float)
    y = (x + rng.integers(0, 3, 300)).astype(float)
    z = rng.normal(size=300)
    rows = [(float(a), float(b), None if i % 10 == 0 else float(c)) for i, (a, b, c) in enumerate(zip(x, y, z))]
    df = _frame(spark, rows, "x double, y double, z double")
    got = {(r["var_a"], r["var_b"]): r["rho"] for r in H.spearman_pairs(df, [("x", "y"), ("x", "z")]).collect()}
    assert math.isclose(got[("x", "y")], np.corrcoef(_ranks(x), _ranks(y))[0, 1], rel_tol=1e-9)
    keep = [i for i in range(300) if i % 10 != 0]
    exp = np.corrcoef(_ranks(x[keep]), _ranks(z[keep]))[0, 1]
    assert math.isclose(got[("x", "z")], exp, rel_tol=1e-9)


def test_chi_square_yates_and_plain(spark):
    # 2x2 table [[10, 20], [30, 5]]: Yates-corrected statistic.
    rows = [("a", "u")] * 10 + [("a", "v")] * 20 + [("b", "u")] * 30 + [("b", "v")] * 5
    df = _frame(spark, rows, "r string, c string")
    got = H.chi_square(df, "r", "c").first()
    o = np.array([[10, 20], [30, 5]], float)
    e = o.sum(1, keepdims=True) * o.sum(0, keepdims=True) / o.sum()
    d = np.abs(o - e)
    exp = (((d - np.minimum(0.5, d)) ** 2) / e).sum()
    assert got["dof"] == 1 and math.isclose(got["statistic"], exp, rel_tol=1e-12)
    # 2x3 with a zero cell: plain statistic over the full grid.
    rows = [("a", "u")] * 7 + [("a", "v")] * 3 + [("b", "v")] * 4 + [("b", "w")] * 6
    got = H.chi_square(_frame(spark, rows, "r string, c string"), "r", "c").first()
    o = np.array([[7, 3, 0], [0, 4, 6]], float)
    e = o.sum(1, keepdims=True) * o.sum(0, keepdims=True) / o.sum()
    assert got["dof"] == 2 and math.isclose(got["statistic"], ((o - e) ** 2 / e).sum(), rel_tol=1e-12)
    one = H.chi_square(_frame(spark, [("a", "u"), ("a", "v")], "r string, c string"), "r", "c").first()
    assert one["statistic"] is None and one["note"]


def test_kruskal_and_mann_whitney(spark):
    a = [1.0, 2.0, 2.0, 5.0, 7.0]
    b = [2.0, 3.0, 8.0, 9.0]
    c = [4.0]  # single-row group is dropped by Kruskal
    rows = [("a", v) for v in a] + [("b", v) for v in b] + [("c", v) for v in c]
    df = _frame(spark, rows, "g string, x double")
    k = H.kruskal(df, "g", "x").first()
    allv = np.array(a + b)
    r = _ranks(allv)
    n = len(allv)
    h = 12 / (n * (n + 1)) * (r[:5].sum() ** 2 / 5 + r[5:].sum() ** 2 / 4) - 3 * (n + 1)
    t = np.unique(allv, return_counts=True)[1]
    h /= 1 - (t ** 3 - t).sum() / (n ** 3 - n)
    assert math.isclose(k["statistic"], h, rel_tol=1e-12) and k["dof"] == 1
    mw = H.mann_whitney(df, "g", "x", "a", "b").first()
    assert math.isclose(mw["statistic"], r[:5].sum() - 5 * 6 / 2, rel_tol=1e-12)


def test_anova_and_welch(spark):
    a = [1.0, 2.0, 4.0, 7.0]
    b = [3.0, 5.0, 6.0, 9.0, 10.0]
    df = _frame(spark, [("a", v) for v in a] + [("b", v) for v in b], "g string, x double")
    f = H.anova(df, "g", "x").first()
    gm = np.mean(a + b)
    ssb = 4 * (np.mean(a) - gm) ** 2 + 5 * (np.mean(b) - gm) ** 2
    ssw = ((np.array(a) - np.mean(a)) ** 2).sum() + ((np.array(b) - np.mean(b)) ** 2).sum()
    assert math.isclose(f["statistic"], ssb / (ssw / 7), rel_tol=1e-12)
    w = H.welch_t(df, "g", "x", "a", "b").first()
    va, vb = np.var(a, ddof=1) / 4, np.var(b, ddof=1) / 5
    assert math.isclose(w["statistic"], (np.mean(a) - np.mean(b)) / math.sqrt(va + vb), rel_tol=1e-12)


def test_descriptive_constant_column(spark):
    df = _frame(spark, [(1.0, float(i)) for i in range(10)], "c double, v double")
    r = {x["variable"]: x for x in PR.descriptive_stats(df, ["c", "v"]).collect()}
    assert r["c"]["skewness"] == 0.0 and r["c"]["kurtosis"] == 0.0 and r["c"]["median"] == 1.0
    assert math.isclose(r["v"]["median"], 4.5) and math.isclose(r["v"]["sd"], np.std(range(10), ddof=1))


def test_series(spark):
    import datetime as dt
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(30) if i != 12]
    vals = [float((i * 7) % 11 + (i % 7)) for i in range(30) if i != 12]
    daily = _frame(spark, list(zip(days, vals)), "day date, amount double")
    filled = TS.fill_days(daily)
    assert filled.count() == 30
    dec = TS.seasonal_decompose(daily).toPandas()
    seas = dec.dropna(subset=["seasonal"]).groupby(
        dec["day"].map(lambda d: (d - dt.date(2024, 1, 1)).days % 7))["seasonal"].first()
    assert abs(seas.sum()) < 1e-9
    a = TS.acf(daily).toPandas().set_index("lag")["acf"]
    assert a.loc[0] == 1.0 and a.index.max() == min(30, len(vals) // 2 - 1)
    x = np.array(vals) - np.mean(vals)
    assert math.isclose(a.loc[1], (x[:-1] * x[1:]).sum() / (x * x).sum(), rel_tol=1e-12)
    p = TS.pacf(TS.acf(daily)).toPandas().set_index("lag")["pacf"]
    assert math.isclose(p.loc[1], a.loc[1], rel_tol=1e-12)


def test_density_histogram(spark):
    vals = [0.0, 1.0, 2.0, 3.0, 4.0, 10.0]
    h = PR.density_histogram(_frame(spark, [(v,) for v in vals], "x double"), "x", 5).collect()
    counts = {r["bin"]: r["n"] for r in h}
    exp, _ = np.histogram(vals, bins=5)
    assert [counts.get(i, 0) for i in range(5)] == exp.tolist()
    assert math.isclose(sum(r["density"] * (r["right"] - r["left"]) for r in h), 1.0)


def test_period_filter(spark):
    import datetime as dt
    rows = [(dt.datetime(2024, 1, 1, 0, 0, 0),), (dt.datetime(2024, 1, 2, 23, 59, 59),),
            (dt.datetime(2024, 1, 3, 0, 0, 0),)]
    df = _frame(spark, rows, "ts timestamp_ntz")
    assert PR.period(df, "2024-01-01", "2024-01-02").count() == 2
    assert PR.period(df, "2024-01-02", "2024-01-02").count() == 1
    with pytest.raises(ValueError):
        PR.period(df, "2024-01-03", "2024-01-01")
    with pytest.raises(ValueError):
        PR.period(df, "2023-12-01", "2024-01-02", bounds=("2024-01-01", "2024-01-03"))
    assert F is not None


def test_iqr_flags_fence_and_nulls(spark):
    from salescope.operators.clean import iqr_flags
    # a: quartiles 2 and 4 → fences −1 and 7; 7 is on the fence (kept), 8 is out.
    rows = [(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (4.0, 5.0), (5.0, 5.0), (7.0, 5.0), (8.0, 5.0), (None, 5.0)]
    df = _frame(spark, rows, "a double, c double")
    vals = sorted([r for r in rows if r[0] is not None])
    q1, q3 = np.quantile([v[0] for v in vals], [0.25, 0.75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    out = iqr_flags(df, [("a", "fa"), ("c", "fc")]).collect()
    for r in out:
        exp = 0 if r["a"] is None else int(r["a"] < lo or r["a"] > hi)
        assert r["fa"] == exp and r["fc"] == 0


def test_mann_whitney_by_matches_one_test_at_a_time(spark):
    rng = np.random.default_rng(7)
    rows = []
    for t in ("t1", "t2", "t3"):
        for _ in range(60):
            g = bool(rng.integers(0, 2))
            rows.append((t, g, float(rng.integers(0, 12)) + (0.5 if g and t == "t2" else 0.0)))
    rows.append(("t1", True, None))
    df = _frame(spark, rows, "test string, g boolean, x double")
    many = {r["test"]: r for r in H.mann_whitney_by(df, ["test"], "g", "x", True, False, buckets=3).collect()}
    assert set(many) == {"t1", "t2", "t3"}
    for t in ("t1", "t2", "t3"):
        one = H.mann_whitney(df.filter(F.col("test") == t), "g", "x", True, False).first()
        for c in ("n1", "n2", "statistic", "mu", "sigma", "z_two_sided", "z_greater"):
            assert math.isclose(float(many[t][c]), float(one[c]), rel_tol=1e-12), (t, c)


def test_exact_mann_whitney_equals_enumeration(spark):
    from itertools import combinations

    from salescope.functions.dist import mann_whitney_counts, mann_whitney_exact
    for n1 in range(1, 9):
        for n2 in range(1, 9):
            us = [sum(c) - n1 * (n1 + 1) // 2 for c in combinations(range(1, n1 + n2 + 1), n1)]
            assert mann_whitney_counts(n1, n2) == [us.count(u) for u in range(n1 * n2 + 1)]
            for u in (0, n1 * n2 // 3, n1 * n2):
                two, greater = mann_whitney_exact(u, n1, n2)
                assert math.isclose(greater, sum(x >= u for x in us) / len(us))
                assert math.isclose(two, min(1, 2 * sum(x >= max(u, n1 * n2 - u) for x in us) / len(us)))
    # The distribution is used without ties and with a small group only.
    rows = [("a", float(v)) for v in (1, 4, 6)] + [("b", float(v)) for v in (2, 3, 5, 7, 8)]
    p = H.with_mw_pvalues(H.mann_whitney(_frame(spark, rows, "g string, x double"), "g", "x", "a", "b")).first()
    assert math.isclose(p["p_value"], mann_whitney_exact(p["statistic"], 3, 5)[0])
    tied = H.with_mw_pvalues(H.mann_whitney(_frame(spark, rows + [("a", 8.0)], "g string, x double"), "g", "x", "a", "b")).first()
    big = [("a", float(2 * i)) for i in range(9)] + [("b", float(3 * i) + 0.5) for i in range(9)]
    wide = H.with_mw_pvalues(H.mann_whitney(_frame(spark, big, "g string, x double"), "g", "x", "a", "b")).first()
    for r in (tied, wide):
        assert math.isclose(r["p_value"], min(1, math.erfc(r["z_two_sided"] / math.sqrt(2))), rel_tol=1e-12)


def test_shared_ranks_equal_the_single_tests(spark):
    rng = np.random.default_rng(12)
    rows = [(["a", "b", "c", None][rng.integers(0, 4)], int(rng.integers(0, 40)) if rng.random() < 0.9 else None,
             float(rng.integers(0, 30)) if rng.random() < 0.95 else None) for _ in range(600)] + [("lone", 99, 3.0)]
    df = _frame(spark, rows, "g string, h long, x double")
    ranks = H.shared_ranks(df, "x", ["g", "h"], [("g", "a", "b"), ("g", "a", "none")])
    for i, g in enumerate(("g", "h")):
        got, want = H.kruskal_of_ranks(ranks, i, g, "x").first(), H.kruskal(df, g, "x").first()
        assert got["dof"] == want["dof"] and math.isclose(got["statistic"], want["statistic"], rel_tol=1e-12)
    for i, other in ((2, "b"), (3, "none")):
        got, want = H.mann_whitney_of_ranks(ranks, i, "g", "a", "l").first(), H.mann_whitney(df, "g", "x", "a", other, "l").first()
        assert got["n1"] == want["n1"] and got["n2"] == want["n2"] and got["note"] == want["note"]
        assert got["statistic"] == want["statistic"] and got["sigma"] == want["sigma"]


def test_spearman_ranks_each_column_once(spark):
    rng = np.random.default_rng(6)
    df = _frame(spark, [tuple(map(float, r)) for r in rng.integers(0, 9, (400, 4))], "a double, b double, c double, d double")
    pairs = [(x, y) for i, x in enumerate("abcd") for y in "abcd"[i + 1:]]
    sp = H.spearman_pairs(df, pairs + [("b", "a"), ("a", "a")])
    pdf = df.toPandas()
    want = {(x, y): np.corrcoef(_ranks(pdf[x].to_numpy()), _ranks(pdf[y].to_numpy()))[0, 1] for x, y in pairs}
    got = {(r["var_a"], r["var_b"]): r["rho"] for r in sp.collect()}
    assert all(math.isclose(got[p], want[p], rel_tol=1e-9, abs_tol=1e-12) for p in pairs)
    assert math.isclose(got["b", "a"], want["a", "b"], rel_tol=1e-9) and math.isclose(got["a", "a"], 1.0)
    assert "Expand" not in sp._jdf.queryExecution().optimizedPlan().toString()
    assert H.spearman_pairs(df.limit(0), [("a", "b")]).first()["rho"] is None


def test_compiled_normal_functions(spark):
    from salescope.functions import normal as ND
    zs = [0.0, -0.0, 1e-9, *np.linspace(-36.5, 36.5, 4001)]
    rows = ND.with_sf(spark.createDataFrame([(float(z),) for z in zs], "z double"), F.col("z"), "s").collect()
    for r in rows:
        assert math.isclose(r["s"], 0.5 * math.erfc(r["z"] / math.sqrt(2)), rel_tol=1e-11, abs_tol=1e-300)
    ps = [0.5, 0.5 + 1e-12, *np.linspace(1e-4, 1 - 1e-4, 3001), *np.logspace(-296, -4, 500), 1 - 1e-9, 1 - 1e-15]
    rows = ND.with_ppf(spark.createDataFrame([(float(p),) for p in ps], "p double"), F.col("p"), "z").collect()
    for r in rows:
        assert math.isclose(r["z"], D.norm_ppf(r["p"]), rel_tol=1e-9, abs_tol=1e-11)


def test_sums_of_scores(spark):
    from salescope.plans import reports as RP
    for n in (3, 10, 129, 1000, 20_000):
        scores = [RP.normal_score(i, n) for i in range(1, n + 1)]
        upto = np.concatenate([[0], np.cumsum(scores)])
        ks = sorted({0, 1, 2, n // 3, n // 2, n - 1, n, min(n, 64), min(n, 65), min(n, 200), max(0, n - 66)})
        runs = [(float(a), float(b)) for a in ks for b in ks if a < b]
        df = spark.createDataFrame([(a, b, RP.first_scores(n), RP.behind_ends(n)) for a, b in runs],
                                   "low double, high double, _ends array<double>, _edge double")
        got = RP.with_score_sums(df, F.col("low"), F.col("high"), F.lit(float(n)), "s").collect()
        assert all(abs(r["s"] - (upto[int(r["high"])] - upto[int(r["low"])])) < 1e-6 for r in got)


def test_normality_and_qq_run_without_python(spark):
    from salescope.plans import reports as RP
    df = _frame(spark, [(float(i % 50), float(i * i)) for i in range(300)], "a double, b double")
    plan = RP.qq_points(df, "a")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    got = {r["variable"]: r for r in RP.normality(df, ["a", "b"]).collect()}
    assert 0.9 < got["a"]["shapiro_stat"] < 0.97 and got["b"]["shapiro_p"] < 1e-8


def test_cleaning_in_two_writes_gives_the_rows_of_the_lazy_plan(spark):
    import datetime as dt
    from salescope.operators import clean as C
    from salescope.schema import CLEAN_REQUIRED
    row = {c: "x" for c in CLEAN_REQUIRED}
    rows = [{**row, "ts": dt.datetime(2020, 1 + i % 5, 1), "channel": "A", "sku": i, "units": 1 + i % 4, "discount": None if i % 3 else i / 100,
             "amount": 10.0 + (i * 37 % 23), "receipt": i, "store": 1, "customer_id": None if i % 11 == 0 else f"c{i * i % 7}",
             "birth_date": dt.date(1990, 1, 1) if i % 4 else None if i % 8 else dt.date(1850, 1, 1), "gender": 1} for i in range(60)]
    types = {"ts": "timestamp", "sku": "long", "units": "long", "discount": "double", "amount": "double", "receipt": "long", "store": "long",
             "birth_date": "date", "gender": "int"}
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` {types.get(c, 'string')}" for c in row))
    plain = lambda d: sorted(tuple(round(v, 9) if isinstance(v, float) else str(v) for v in r) for r in d.collect())
    lazy, cut = C.clean(df), C.clean(df, cut_lineage=True)
    assert lazy.columns == cut.columns and len(plain(cut)) > 40 and plain(lazy) == plain(cut)
    counts = C.customer_counts(df)
    want = C.moments(C.purchase_frequency(df), ["purchase_frequency"]).first()
    assert C.frequency_moments(counts).first() == pytest.approx(tuple(want))
    same = C.frequency_moments(counts.withColumn("purchase_frequency", F.lit(3).cast("long"))).first()
    assert same[1] == 0.0


def test_a_split_orders_one_range_of_hashes_only(spark):
    from salescope.operators import model as M
    df = spark.range(3000).select((F.col("id") % 900).alias("k"))  # keys come more than once
    h = df.withColumn("_h", M.hash_key(["k"]))
    ordered = sorted(r["_h"] for r in h.collect())
    for rows in (1, 2, 900, 2999, 3000, 9999):
        cut = M._cut(h, F.lit(rows))
        want = ordered[min(rows, 3000) - 1]
        assert tuple(cut.first()) == (want, ordered.index(want))
    assert M._cut(h, F.lit(0)).first()["_cut"] is None and M._cut(h.limit(0), F.lit(5)).first()["_cut"] is None
    assert "percentile_approx" not in cut._jdf.queryExecution().optimizedPlan().toString()


def test_bounds_and_rows_read_one_shuffle_of_the_counts(spark):
    from salescope.operators.ranks import quantile_row
    row = quantile_row(spark.range(2000).select((F.col("id") % 700).cast("double").alias("x")), "x", [0.5], ["m"])
    assert row.first()["m"] == 333.0
    row.collect()
    assert "ReusedExchange" in row._jdf.queryExecution().executedPlan().toString()


def test_tables_keep_coefficients_that_are_zero():
    from salescope.functions import normal as ND
    assert len(ND._table(lambda x: 0.0, 0.0, 1.0, 3)) == 3 * (ND._DEGREE + 1)
    assert len(ND._TAIL) == 48 * (ND._DEGREE + 1) and len(ND._QUANTILE) == 96 * (ND._DEGREE + 1)
