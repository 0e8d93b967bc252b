"""Report builders: test suites, normality, linear diagnostics, model metrics.

Each report is a small DataFrame assembled from the distributed operators;
the only driver-side values are per-test scalars (k×k matrices for OLS with k
predictors), never rows of the table.  Reports read all rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.functions import normal as ND
from salescope.functions.dist import chi2_sf, kolmogorov_sf, norm_ppf, norm_sf
from salescope.functions.numeric import verdict
from salescope.operators import boosting as B
from salescope.operators import hypothesis as H
from salescope.operators import model as M
from salescope.operators.ranks import cumulative_counts
from salescope.schema import NUMERIC
from salescope.session import written

SUITE_SCHEMA = ("name string, question string, h0 string, h1 string, test string, statistic double, "
                "p_value double, decision string, note string")


# ----------------------------------------------------------------------------- normality

def normal_score(i, n):
    """Blom's score of the ``i``-th of ``n`` ordered values: the normal quantile at (i − 3/8)/(n + 1/4)."""
    return norm_ppf((i - 0.375) / (n + 0.25))


#: Positions at each end whose scores are summed one by one.
RUN_ENDS = 64


def first_scores(n: int) -> list[float]:
    """Sums of the first 0, 1, 2, ... scores of ``n`` positions, up to ``RUN_ENDS`` and the middle."""
    out = [0.0]
    for i in range(1, min(RUN_ENDS, n // 2) + 1):
        out.append(out[-1] + normal_score(i, n))
    return out


def behind_ends(n: int) -> float:
    """Normal density at the quantile where the summed ends stop."""
    return math.exp(-norm_ppf((min(RUN_ENDS, n / 2) + 0.125) / (n + 0.25)) ** 2 / 2) / math.sqrt(2 * math.pi)


def with_score_sums(rows: DataFrame, low, high, n, out: str = "_m") -> DataFrame:
    """``rows`` with the sum of the normal scores of the positions ``low + 1 .. high`` of ``n``.

    The columns ``_ends`` and ``_edge`` hold ``first_scores(n)`` and ``behind_ends(n)``.
    A sum is the difference of the sums of the first ``high`` and ``low`` scores.
    Scores are symmetric, so such a sum is that of the shorter side; behind the
    ends it is the integral of the quantile function, which is minus the normal
    density at the quantile, with the first correction of the midpoint rule.  A
    single position has its own quantile.
    """
    single = high - low == 1
    rows = (rows.withColumn("_low", F.least(low, n - low)).withColumn("_high", F.least(high, n - high))
            .withColumn("_single", single))
    rows = ND.with_ppf(rows, (F.when(F.col("_single"), low + 0.625).otherwise(F.col("_low") + 0.125)) / (n + 0.25), "_z1")
    rows = ND.with_ppf(rows, (F.col("_high") + 0.125) / (n + 0.25), "_z2")
    rows = rows.withColumn("_d1", ND.density(F.col("_z1"))).withColumn("_d2", ND.density(F.col("_z2")))

    def upto(few: str, d: str):
        inner = ((n + 0.25) * (F.col("_edge") - F.col(d)) - (1 / F.col(d) - 1 / F.col("_edge")) / (24 * (n + 0.25)))
        return F.when(F.col(few) <= RUN_ENDS, F.get("_ends", F.col(few).cast("int"))).otherwise(
            F.get("_ends", F.lit(RUN_ENDS)) + inner)

    return rows.withColumn(out, F.when(F.col("_single"), F.col("_z1")).otherwise(upto("_high", "_d2") - upto("_low", "_d1"))).drop(
        "_low", "_high", "_single", "_z1", "_z2", "_d1", "_d2")


def shapiro_p(w: float, n: int) -> float:
    """Royston's approximation of the p-value of ``w`` (3 values at least)."""
    if n < 3 or math.isnan(w):
        return float("nan")
    if w >= 1:
        return 1.0
    if n == 3:
        return max(0.0, 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))
    # Royston (1995) polynomials, for 4 to 11 and for 12 or more values.
    if n <= 11:
        edge = 0.459 * n - 2.273
        if math.log(1 - w) >= edge:
            return 0.0
        mu = 0.5440 - 0.39978 * n + 0.025054 * n ** 2 - 0.0006714 * n ** 3
        sigma = math.exp(1.3822 - 0.77857 * n + 0.062767 * n ** 2 - 0.0020322 * n ** 3)
        return norm_sf((-math.log(edge - math.log(1 - w)) - mu) / sigma)
    ln = math.log(n)
    mu = 0.0038915 * ln ** 3 - 0.083751 * ln ** 2 - 0.31082 * ln - 1.5861
    sigma = math.exp(0.0030302 * ln ** 2 - 0.082676 * ln - 0.4803)
    return norm_sf((math.log(1 - w) - mu) / sigma)


def shapiro_w(n: int, sums: dict) -> float:
    """W from sums over the ordered values.

    ``mx``: Σ m·x and ``mm``: Σ m² over all positions (m: normal scores); the two
    smallest and largest values ``x1 x2 y2 y1``; ``ss``: Σ (x − mean)².
    """
    if n < 3 or not sums["ss"]:
        return float("nan")
    if n == 3:
        return (sums["y1"] - sums["x1"]) ** 2 / 2 / sums["ss"]
    m1, m2 = normal_score(n, n), normal_score(n - 1, n)
    mm, u = sums["mm"], 1 / math.sqrt(n)
    c1, c2 = m1 / math.sqrt(mm), m2 / math.sqrt(mm)
    # Royston (1995) polynomials of the two extreme weights.
    a1 = c1 + 0.221157 * u - 0.147981 * u ** 2 - 2.071190 * u ** 3 + 4.434685 * u ** 4 - 2.706056 * u ** 5
    a2 = c2 + 0.042981 * u - 0.293762 * u ** 2 - 1.752461 * u ** 3 + 5.682633 * u ** 4 - 3.582633 * u ** 5
    if n <= 5:
        phi = (mm - 2 * m1 ** 2) / (1 - 2 * a1 ** 2)
        inner = sums["mx"] - m1 * (sums["y1"] - sums["x1"])
        top = a1 * (sums["y1"] - sums["x1"]) + inner / math.sqrt(phi)
    else:
        phi = (mm - 2 * m1 ** 2 - 2 * m2 ** 2) / (1 - 2 * a1 ** 2 - 2 * a2 ** 2)
        inner = sums["mx"] - m1 * (sums["y1"] - sums["x1"]) - m2 * (sums["y2"] - sums["x2"])
        top = a1 * (sums["y1"] - sums["x1"]) + a2 * (sums["y2"] - sums["x2"]) + inner / math.sqrt(phi)
    return min(1.0, top ** 2 / sums["ss"])


def score_square_sum(n: int) -> float:
    """Σ m² of ``n`` normal scores: one by one at the ends, by its integral in between."""
    def square(i):
        return normal_score(i, n) ** 2

    if n <= 4096:
        return sum(square(i) for i in range(1, n + 1))

    def integral(position):  # of the squared quantile: Φ(z) − z·φ(z)
        z = norm_ppf((position - 0.375) / (n + 0.25))
        return (1 - norm_sf(z)) - z * math.exp(-z * z / 2) / math.sqrt(2 * math.pi)

    ends = 2 * sum(square(i) for i in range(1, 1025))
    return ends + (n + 0.25) * (integral(n - 1024 + 0.5) - integral(1024.5))


def normality(df: DataFrame, cols=NUMERIC) -> DataFrame:
    """Per variable, over all rows: Shapiro-Wilk (Royston) and Kolmogorov-Smirnov against N(mean, sd).

    Both come from the distinct values with their ranks: the KS distance is a
    maximum over them, W needs Σ score·value, where a run of equal values adds
    the sum of its positions' scores.  All of it is compiled expressions; a few
    sums a variable reach the driver.
    """
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    # ``variable`` is never NULL; saying so keeps the readers of the counts on one shuffle (the join below asks for it).
    long = (df.selectExpr(f"stack({len(cols)}, {stack}) AS (variable, value)")
            .filter(F.col("variable").isNotNull() & F.col("value").isNotNull() & ~F.isnan("value")))
    vc = long.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("cnt"))
    moments = long.groupBy("variable").agg(F.count(F.lit(1)).alias("_n"), F.avg("value").alias("_mean"), F.stddev_samp("value").alias("_sd"),
                                           F.var_pop("value").alias("_vp"))
    found = moments.collect()  # one row a variable
    sides = df.sparkSession.createDataFrame(
        [(r["variable"], r["_mean"], r["_sd"], r["_vp"], first_scores(r["_n"]), behind_ends(r["_n"])) for r in found],
        "variable string, _mean double, _sd double, _vp double, _ends array<double>, _edge double")
    ranked = cumulative_counts(vc, "value", ["variable"]).join(F.broadcast(sides), "variable")
    z = F.try_divide(F.col("value") - F.col("_mean"), F.nullif("_sd", F.lit(0.0)))
    n, low, count = F.col("n").cast("double"), F.col("cum_lo").cast("double"), F.col("cnt").cast("double")
    scored = with_score_sums(ND.with_sf(ranked, z, "_above"), low, low + count, n).withColumn("_cdf", 1 - F.col("_above"))
    high = F.col("cum_lo") + F.col("cnt")

    def at(position):  # the value at a 1-based position
        return F.max(F.when((F.col("cum_lo") < position) & (high >= position), F.col("value")))

    sums = scored.groupBy("variable").agg(
        F.max("n").alias("n"), F.max("_vp").alias("_vp"), F.sum(F.col("_m") * F.col("value")).alias("mx"),
        F.max(F.greatest(high / n - F.col("_cdf"), F.col("_cdf") - F.col("cum_lo") / n)).alias("d"),
        at(F.lit(1)).alias("x1"), at(F.lit(2)).alias("x2"), at(F.col("n") - 1).alias("y2"), at(F.col("n")).alias("y1"))
    rows = []
    for r in sums.collect():  # one row a variable
        flat = not r["_vp"]
        values = {**r.asDict(), "ss": (r["_vp"] or 0.0) * r["n"], "mm": score_square_sum(r["n"])}
        w = float("nan") if flat else shapiro_w(r["n"], values)
        d = float("nan") if flat or r["d"] is None else r["d"]
        nothing = H.NO_VARIATION if flat else H.FEW_ROWS if r["n"] < 3 else None
        rows.append((r["variable"], r["n"], *(None if math.isnan(v) else float(v) for v in
                                              (w, shapiro_p(w, r["n"]), d, kolmogorov_sf(d, r["n"]))), nothing))
    return df.sparkSession.createDataFrame(rows, "variable string, n long, shapiro_stat double, shapiro_p double, "
                                                 "ks_stat double, ks_p double, note string")


def qq_points(values: DataFrame, col: str) -> DataFrame:
    """Normal Q-Q table over all rows: each distinct value (``ordered``) with its rows and normal quantile.

    Filliben's plotting positions; equal values stand at their mean position.
    """
    x = values.filter(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("ordered"))
    cc = cumulative_counts(x.groupBy("ordered").agg(F.count(F.lit(1)).alias("cnt")), "ordered")
    n = F.col("n").cast("double")
    rank = F.col("cum_lo") + (F.col("cnt") + 1) / 2.0
    last = F.pow(F.lit(0.5), 1 / n)
    p = (F.when(rank == n, last).when(rank == 1, 1 - last).otherwise((rank - 0.3175) / (n + 0.365)))
    return ND.with_ppf(cc, p, "theoretical").select("ordered", "cnt", rank.alias("rank"), "theoretical")


# ----------------------------------------------------------------------------- suites

def _suite_rows(stats: DataFrame, name, question, h0, h1, test, stat_col, p_col, why=None) -> DataFrame:
    """A row of the suite; ``why`` (default: the test's own note) where it could not be made."""
    p = F.col(p_col).cast("double")
    made = F.col(stat_col).isNotNull() & p.isNotNull()
    note = F.col("note") if "note" in stats.columns else F.lit(None).cast("string")
    note = F.when(~made, F.coalesce(F.lit(why), note, F.lit(H.NO_VARIATION)))
    return stats.select(F.lit(name).alias("name"), F.lit(question).alias("question"), F.lit(h0).alias("h0"),
                        F.lit(h1).alias("h1"), F.lit(test).alias("test"),
                        F.col(stat_col).cast("double").alias("statistic"), p.alias("p_value"),
                        verdict(p).alias("decision"), note.alias("note"))


def hypothesis_suite(cl: DataFrame, channel_a: str = "APP", channel_b: str = "WEB") -> DataFrame:
    """The six hypotheses of the original report, one row per test.

    A test that cannot be made keeps its row: statistic NULL, decision 'No
    evaluable', the reason in ``note``.
    """
    found = [r[0] for r in cl.select("gender").filter(F.col("gender").isNotNull()).distinct()
             .orderBy("gender").limit(2).collect()]
    g1, g2 = [*found, None, None][:2]
    out = []
    # All rank tests read one ranking of the amount: by channel, by gender, channel A against B, gender 1 against 2.
    ranks = H.shared_ranks(cl.select("channel", "gender", "amount"), "amount", ["channel", "gender"], [("channel", channel_a, channel_b), ("gender", F.lit(g1), F.lit(g2))])
    # H0_APP_WEB: ticket of channel A greater than channel B (Welch one-sided + Mann-Whitney 'greater').
    missing = f"No evaluable: no existen suficientes registros en {channel_a} y {channel_b}."
    w = H.with_t_pvalues(H.welch_t(cl, "channel", "amount", channel_a, channel_b))
    out.append(_suite_rows(w, "H0_APP_WEB", f"El ticket promedio en {channel_a} es mayor que en {channel_b}.",
                           f"Ticket promedio {channel_a} <= {channel_b}.", f"Ticket promedio {channel_a} > {channel_b}.",
                           "Welch t-test unilateral", "statistic", "p_greater", missing))
    mw = H.with_mw_pvalues(H.mann_whitney_of_ranks(ranks, 2, "channel", channel_a, "amount"))
    out.append(_suite_rows(mw, "H0_APP_WEB", "", "", "", "Mann-Whitney unilateral", "statistic", "p_greater", missing))
    # H0_DESCUENTO_UNIDADES: simple OLS units ~ discount.
    o = H.simple_ols(cl, "units", "discount").withColumn("n_d", F.col("n").cast("double"))
    o = H.with_t_pvalues(o.withColumn("statistic", F.col("t_slope")).withColumn("dof", F.col("n_d") - 2))
    out.append(_suite_rows(o, "H0_DESCUENTO_UNIDADES", "El porcentaje de descuento afecta las unidades vendidas.",
                           "Coeficiente de descuento = 0.", "Coeficiente de descuento != 0.",
                           "Regresion lineal simple", "slope", "p_value"))
    # H1: amount differs between channels (ANOVA + Kruskal-Wallis).
    a = H.with_f_pvalue(H.anova(cl, "channel", "amount"))
    out.append(_suite_rows(a, "H1", "El monto promedio difiere entre canales.", "No difiere.", "Algun canal difiere.",
                           "ANOVA", "statistic", "p_value"))
    k = H.with_chi2_pvalue(H.kruskal_of_ranks(ranks, 0, "channel", "amount"))
    out.append(_suite_rows(k, "H1", "", "", "", "Kruskal-Wallis", "statistic", "p_value"))
    # H2 / H3: Spearman discount~amount, age~amount, from one call (amount is ranked once).
    sp = H.with_spearman_pvalues(H.spearman_pairs(cl, [("discount", "amount"), ("age", "amount")]))
    for name, a_, q in (("H2", "discount", "El descuento se asocia con el monto."),
                        ("H3", "age", "La edad se asocia con el monto.")):
        out.append(_suite_rows(sp.filter(F.col("var_a") == a_), name, q, "Sin asociacion monotona.",
                               "Asociacion monotona.", "Spearman", "rho", "p_value"))
    # H4: gender, first two sorted values (Welch two-sided + Mann-Whitney two-sided).
    few = "No evaluable: se requieren al menos dos generos." if g2 is None else None
    w = H.with_t_pvalues(H.welch_t(cl, "gender", "amount", F.lit(g1), F.lit(g2)))
    out.append(_suite_rows(w, "H4", "El monto difiere segun genero.", "No difiere.", "Difiere.",
                           "Welch t-test", "statistic", "p_value", few))
    mw = H.with_mw_pvalues(H.mann_whitney_of_ranks(ranks, 3, "gender", F.lit(g1), "amount"))
    out.append(_suite_rows(mw, "H4", "", "", "", "Mann-Whitney", "statistic", "p_value", few))
    res = out[0]
    for o_ in out[1:]:
        res = res.unionByName(o_)
    return res


def association_suite(cl: DataFrame) -> DataFrame:
    """Chi-square channel×store and channel×gender, three Spearman pairs, ANOVA/Kruskal by channel and by store."""
    columns = ["test", "variables", "statistic", "dof", "p_value", "note"]
    parts = [H.with_chi2_pvalue(H.chi_square(cl, "channel", "store")).select(*columns)]
    sp = H.with_spearman_pvalues(H.spearman_pairs(cl, [("units", "amount"), ("units", "discount"),
                                                       ("amount", "discount")]))
    parts.append(sp.select(F.lit("Spearman").alias("test"), F.concat_ws(" vs ", "var_a", "var_b").alias("variables"),
                           F.col("rho").alias("statistic"), F.lit(None).cast("bigint").alias("dof"), "p_value",
                           F.when(F.col("rho").isNull(), F.lit(H.NO_VARIATION)).alias("note")))
    ranks = H.shared_ranks(cl, "amount", ["channel", "store"])
    for i, g in enumerate(("channel", "store")):
        a = H.with_f_pvalue(H.anova(cl, g, "amount"))
        parts.append(a.select("test", "variables", "statistic", F.col("df1").alias("dof"), "p_value", "note"))
        parts.append(H.with_chi2_pvalue(H.kruskal_of_ranks(ranks, i, g, "amount")).select(*columns))
    parts.append(H.with_chi2_pvalue(H.chi_square(cl, "channel", "gender")).select(*columns))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ----------------------------------------------------------------------------- linear diagnostics

# The limits of the linear model, and the reasons not to train one.
LINEAR_CONCLUSION = "Limitada fuera de los rangos observados."
LINEAR_LIMITS = [
    "No extrapola de forma confiable a canales o locales no observados.",
    "UNIDADES no aporta informacion si permanece constante.",
    "Faltan variables externas como stock, campanas, feriados y promociones.",
    "La muestra usada controla tiempo de ejecucion; puede subrepresentar casos raros.",
]
NO_PREDICTORS = "No hay predictores con variacion suficiente."


def linear_diagnostics(cl: DataFrame, seed: int = 42) -> dict:
    """OLS of log1p(amount) on channel dummies, store, units, discount (train split), with diagnostics.

    The split rows are written once; the fit takes two passes over them (means,
    cross-products), the tests of its residuals a third, the ranked residuals
    and the test rows one each.  Where nothing can be trained (fewer than
    ``MIN_LINEAR_ROWS`` complete rows, no predictor that varies, no more training
    rows than coefficients) the result only has ``n`` and ``note``.
    """
    base = cl.select("record_no", "amount", "channel", "store", "units", "discount").dropna()
    levels = sorted(r[0] for r in base.groupBy("channel").count().limit(M.MAX_LEVELS + 1).collect())
    frame = M.one_hot(base.withColumn("y", F.log1p("amount")), "channel", levels=levels)
    split = written(M.train_test_split(frame, ["record_no", "amount", "store"], 0.3, seed), "linear-split")
    xs = [c for c in frame.columns if c.startswith("channel_")] + ["store", "units", "discount"]
    seen = split.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("split") == "train").alias("train"),
                     *[(F.min(c) != F.max(c)).alias(c) for c in xs]).first()
    if seen["n"] < M.MIN_LINEAR_ROWS:
        return {"n": seen["n"], "note": f"No entrenado: se requieren al menos {M.MIN_LINEAR_ROWS} registros completos."}
    xs = [c for c in xs if seen[c]]
    if not xs:
        return {"n": seen["n"], "note": f"No entrenado: {NO_PREDICTORS}"}
    if seen["train"] <= len(xs) + 1:
        return {"n": seen["n"], "note": f"No entrenado: {seen['train']} filas de entrenamiento no bastan para "
                                        f"{len(xs) + 1} coeficientes."}
    train = split.filter(F.col("split") == "train")
    test = split.filter(F.col("split") == "test")
    fit = M.ols(train, "y", xs)
    res = M.residuals(train, fit, "y")
    tests = M.residual_tests(res, fit)
    shapiro = normality(res, ["resid"]).first()
    scored = M.residuals(test, fit, "y").select(
        F.col("amount").alias("actual"), F.greatest(F.expm1("fitted"), F.lit(0.0)).alias("predicted"))
    metrics = M.regression_metrics(scored).first()
    return {"n": seen["n"], "note": None, "fit": fit, "xs": xs, "vif": M.vif_of_fit(fit), "bp": tests,
            "jb": (tests["jb_stat"], tests["jb_p_value"]), "metrics": metrics, "res": res,
            "shapiro": (shapiro["shapiro_stat"], shapiro["shapiro_p"]), "scored": scored, "split": split}


def linear_report(spark: SparkSession, diag: dict) -> DataFrame:
    """Long table (section, name, value, p_value, low, high, note)."""
    schema = ("section string, name string, value double, p_value double, low double, high double, note string")
    if diag["note"]:
        return spark.createDataFrame([("tamanos", "filas", float(diag["n"]), None, None, None, diag["note"])], schema)
    fit, bp, m = diag["fit"], diag["bp"], diag["metrics"]
    rows = [("tamanos", "filas", float(diag["n"]), None, None, None),
            ("tamanos", "entrenamiento", float(fit["n"]), None, None, None),
            ("tamanos", "prueba", float(m["n"]), None, None, None)]
    rows += [("coeficiente", name, b, p, lo, hi) for name, b, se, t, p, lo, hi in fit["coefficients"]]
    rows += [("ajuste", "r2_train", fit["r2"], None, None, None),
             ("ajuste", "r2_ajustado_train", fit["r2_adj"], None, None, None)]
    rows += [("vif", c, v, None, None, None) for c, v in diag["vif"]]
    rows += [("breusch_pagan", "lm", bp["lm_stat"], bp["lm_p_value"], None, None),
             ("breusch_pagan", "f", bp["f_stat"], bp["f_p_value"], None, None),
             ("jarque_bera", "jb", diag["jb"][0], diag["jb"][1], None, None),
             ("shapiro", "w", *diag["shapiro"], None, None)]
    rows += [("test_original_scale", k, float(m[k]) if m[k] is not None else None, None, None, None)
             for k in ("mae", "rmse", "r2")]
    rows = [(*(None if isinstance(v, float) and math.isnan(v) else v for v in r), None) for r in rows]
    rows.append(("extrapolabilidad", "conclusion", None, None, None, None, LINEAR_CONCLUSION))
    rows += [("extrapolabilidad", f"limitacion_{i}", None, None, None, None, text) for i, text in enumerate(LINEAR_LIMITS, 1)]
    return spark.createDataFrame(rows, schema)


def boosted_model(cl: DataFrame, iters: int = 180, minimum: int = M.MIN_BOOSTED_ROWS, **params) -> dict:
    """Boosted trees on log1p(amount): ``n``, ``note``, and, if trained, the model, train rows and scored test rows.

    With fewer than ``minimum`` complete rows, or no predictor, nothing is trained.
    """
    mf = M.model_frame(cl)
    n = mf.count()
    if n < minimum:
        return {"n": n, "note": f"No entrenado: se requieren al menos {minimum} registros completos."}
    feats = [c for c in mf.columns if c not in ("record_no", "amount")]
    if not feats:
        return {"n": n, "note": "No entrenado: no hay predictores disponibles."}
    key = [c for c in ("record_no", "amount", "sku") if c in mf.columns]
    split = written(M.train_test_split(mf, key, M.test_share(n)), "model-split")
    train = split.filter(F.col("split") == "train")
    model = B.fit(train, feats, F.log1p("amount"), iters, **params)
    scored = B.predict(split.filter(F.col("split") == "test"), model).select(
        F.col("amount").alias("actual"), F.greatest(F.expm1("prediction"), F.lit(0.0)).alias("predicted"))
    return {"n": n, "note": None, "model": model, "train": train.count(), "scored": scored}


def boosted_metrics(cl: DataFrame, iters: int = 180, minimum: int = M.MIN_BOOSTED_ROWS, **params) -> DataFrame:
    """Held-out error of the boosted trees; a note instead where nothing is trained."""
    found = boosted_model(cl, iters, minimum, **params)
    if found["note"]:
        return cl.sparkSession.createDataFrame(
            [(found["n"], None, None, None, None, None, found["note"])],
            "n long, mae double, rmse double, r2 double, train long, trees int, note string")
    return M.regression_metrics(found["scored"]).select(
        "*", F.lit(found["train"]).cast("long").alias("train"), F.lit(len(found["model"].trees)).alias("trees"),
        F.lit(None).cast("string").alias("note"))
