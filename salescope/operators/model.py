"""Model frame, exact seeded samples and splits, OLS with diagnostics, error metrics.

Samples and splits order rows by ``md5(key || seed)`` — sizes that do not depend
on partitioning, and the same rows in any engine.  The rank operator finds the
one hash value at which the cut falls, and a filter does the rest: no row is
sorted or joined.  The OLS normal equations come from two distributed
aggregates (means, then centred cross-products): the k×k matrix (k =
predictors) is the only thing that reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescope.functions.dist import chi2_sf, f_sf, t_ppf, t_sf

# Predictors of the original model frames.
MODEL_REQUIRED = ["amount", "units", "discount", "age", "purchase_frequency"]
MODEL_OPTIONAL = ["sku", "channel", "gender", "store", "month", "weekday", "hour"]
#: Levels that a categorical column may have as dummy columns.
MAX_LEVELS = 1000
# Fewest complete rows for which the original trains.
MIN_LINEAR_ROWS, MIN_BOOSTED_ROWS, MIN_PERIOD_ROWS = 10, 4, 10
LINEAR_COLUMNS = ["amount", "channel", "store", "units", "discount"]


def hash_key(key_cols: Sequence[str], seed: int = 42):
    """Deterministic pseudo-random order: md5 of the key and the seed, as a 60-bit number."""
    h = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols], F.lit(str(seed))))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")


#: Hashes have 60 bits; the first 16 say which of 65 536 ranges one is in.
RANGE_SHIFT = 44


def _cut(hashes: DataFrame, rows) -> DataFrame:
    """One row: ``_cut``, the hash of the ``rows``-th row in hash order, and ``_before``, the rows below it.

    Rows are counted by range of the hash first; only the range in which the cut
    falls, one row in 65 536, is then ordered.
    """
    top, one = F.shiftright("_h", RANGE_SHIFT), Window.partitionBy(F.lit(0))
    below = lambda order: F.coalesce(
        F.sum("cnt").over(one.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = hashes.groupBy(top.alias("_top")).agg(F.count(F.lit(1)).alias("cnt"))
    ranges = ranges.select("_top", below("_top").alias("_off"), F.sum("cnt").over(one).alias("n"))
    at = ranges.filter(F.col("_off") < rows).agg(F.max(F.struct("_top", "_off", "n")).alias("_at")).select("_at.*")
    inside = (hashes.select("_h").join(F.broadcast(at), top == F.col("_top"))
              .groupBy("_h", "_off", "n").agg(F.count(F.lit(1)).alias("cnt")))
    cc = inside.withColumn("cum_lo", F.col("_off") + below("_h"))
    return cc.filter(F.col("cum_lo") < rows).agg(F.max("_h").alias("_cut"), F.max("cum_lo").alias("_before"))


def seeded_sample(df: DataFrame, n: int, key_cols: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows chosen by the hash order of their key.

    Rows repeated with the key at the cut are taken in any order.
    """
    h = df.withColumn("_h", hash_key(key_cols, seed))
    cut = _cut(h, F.lit(n)).first()
    if n <= 0 or cut["_cut"] is None:
        return df.limit(0)
    return (h.filter(F.col("_h") < cut["_cut"])
            .unionByName(h.filter(F.col("_h") == cut["_cut"]).limit(n - cut["_before"])).drop("_h"))


def train_test_split(df: DataFrame, key_cols: Sequence[str], test_share: float = 0.3, seed: int = 42) -> DataFrame:
    """Adds ``split`` ('train'/'test'): test = first ceil(test_share·n) rows in hash order.

    Rows repeated with one key share a side.
    """
    h = df.withColumn("_h", hash_key(key_cols, seed))
    cut = _cut(h, F.ceil(F.lit(test_share) * F.col("n"))).select("_cut")
    return (h.crossJoin(F.broadcast(cut))
            .withColumn("split", F.when(F.col("_h") <= F.col("_cut"), F.lit("test")).otherwise(F.lit("train")))
            .drop("_h", "_cut"))


def test_share(n: int) -> float:
    """Share of ``n`` complete rows that is kept for testing: half of very few, so that both sides have some."""
    return 0.3 if n >= 10 else 0.5


def trainable(df: DataFrame, groups: Sequence[str], required: Sequence[str], minimum: int) -> DataFrame:
    """Per group: complete rows ``n`` and, where there are fewer than ``minimum``, the note of a model not trained."""
    n = F.count_if(F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in required)))
    return (df.groupBy(*groups).agg(n.alias("n"))
            .withColumn("note", F.when(F.col("n") < minimum,
                                       F.lit(f"No entrenado: se requieren al menos {minimum} registros completos."))))


def calendar_features(df: DataFrame, ts: str = "ts") -> DataFrame:
    """month 1-12, weekday Monday=0, hour."""
    return (df.withColumn("month", F.month(ts)).withColumn("weekday", F.weekday(ts))
            .withColumn("hour", F.hour(ts)))


def one_hot(df: DataFrame, col: str, drop_first: bool = True, levels: Sequence | None = None) -> DataFrame:
    """Dummy columns ``<col>_<value>`` (1.0/0.0) for the sorted distinct values, first one dropped.

    The level list, at most ``MAX_LEVELS`` (more is an error), is fetched once to
    name the output columns.
    """
    if levels is None:
        found = df.select(col).filter(F.col(col).isNotNull()).distinct().limit(MAX_LEVELS + 1).collect()
        if len(found) > MAX_LEVELS:
            raise ValueError(f"{col} has more than {MAX_LEVELS} levels; it is not a categorical column")
        levels = sorted(r[0] for r in found)
    keep = list(levels)[1:] if drop_first else list(levels)
    rest = [F.col(c) for c in df.columns if c != col]
    return df.select(*rest, *[(F.col(col) == F.lit(v)).cast("double").alias(f"{col}_{v}") for v in keep])


def varying_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Columns that are not all NULL and have more than one distinct value (one pass)."""
    row = df.agg(*[(F.min(c) != F.max(c)).alias(c) for c in cols]).first()
    return [c for c in cols if row[c]]


def model_frame(df: DataFrame) -> DataFrame:
    """Required + optional predictors present, listwise complete, calendar features, channel dummies."""
    m = calendar_features(df) if "ts" in df.columns else df
    cols = [c for c in MODEL_REQUIRED + MODEL_OPTIONAL if c in m.columns]
    keep = [c for c in ["record_no"] if c in m.columns]
    m = m.select(*keep, *cols).dropna(subset=cols)
    if "channel" in cols:
        m = one_hot(m, "channel")
    return m


def ols(df: DataFrame, y: str, xs: Sequence[str]) -> dict:
    """OLS with constant; returns coefficients, se, t, p, CI, R².

    One aggregate for the means, one for the cross-products of the centred
    columns, so large codes and many rows lose no digits.  Needs more rows than
    coefficients.
    """
    d = df.select(*[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(xs)],
                  F.col(y).cast("double").alias("_y"))
    k = len(xs)
    cols = [*(f"_x{i}" for i in range(k)), "_y"]
    first = d.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in cols]).first()
    n = first["n"]
    if n <= k + 1:
        raise ValueError(f"OLS on {k} predictors needs more than {k + 1} rows, there are {n}")
    means = np.array([first[c] for c in cols])
    centred = [F.col(c) - F.lit(float(m)) for c, m in zip(cols, means, strict=True)]
    r = d.agg(*[F.sum(centred[i] * centred[j]).alias(f"c{i}_{j}")
                for i in range(k + 1) for j in range(i, k + 1)]).first()
    c = np.zeros((k + 1, k + 1))
    for i in range(k + 1):
        for j in range(i, k + 1):
            c[i, j] = c[j, i] = r[f"c{i}_{j}"]
    sxx, sxy, sst = c[:k, :k], c[:k, k], c[k, k]
    inv = np.linalg.pinv(sxx) if k else sxx
    slopes = inv @ sxy
    sse = max(float(sst - slopes @ sxy), 0.0)
    beta = np.concatenate([[means[k] - slopes @ means[:k]], slopes])
    dof = n - k - 1
    s2 = sse / dof
    unscaled = np.concatenate([[1.0 / n + means[:k] @ inv @ means[:k]], np.diag(inv)])
    se = np.sqrt(np.maximum(unscaled * s2, 0))
    tcrit = t_ppf(0.975, dof)
    rows = []
    for i, name in enumerate(["const", *xs]):
        t = beta[i] / se[i] if se[i] > 0 else float("nan")
        p = min(1.0, 2 * t_sf(abs(t), dof)) if not math.isnan(t) else float("nan")
        rows.append((name, float(beta[i]), float(se[i]), float(t), float(p),
                     float(beta[i] - tcrit * se[i]), float(beta[i] + tcrit * se[i])))
    r2 = 1 - sse / sst if sst > 0 else float("nan")
    r2a = 1 - (1 - r2) * (n - 1) / dof
    return {"n": n, "k": k, "r2": float(r2), "r2_adj": float(r2a), "coefficients": rows,
            "beta": beta, "names": ["const", *xs], "means": means[:k], "sxx": sxx}


def vif_of_fit(fit: dict) -> list[tuple[str, float | None]]:
    """VIF without a constant from the sums of a fit, X'X being the centred cross-products plus n times the means'."""
    m = fit["sxx"] + fit["n"] * np.outer(fit["means"], fit["means"])
    try:
        inv = np.linalg.inv(m)
    except np.linalg.LinAlgError:
        return [(c, None) for c in fit["names"][1:]]
    return [(c, float(inv[i, i] * m[i, i])) for i, c in enumerate(fit["names"][1:])]


def residual_tests(resid_df: DataFrame, fit: dict, resid: str = "resid") -> dict:
    """Breusch-Pagan and Jarque-Bera of the residuals of ``fit`` on its own rows, in one pass.

    Breusch-Pagan regresses e² on the design, whose cross-products the fit has:
    LM = n·R² ~ χ²(k), F = (R²/k)/((1−R²)/(n−k−1)).
    """
    e, xs, n, k = F.col(resid), fit["names"][1:], fit["n"], fit["k"]
    sums = resid_df.agg(*[F.sum(F.pow(e, j)).alias(f"e{j}") for j in (1, 2, 3, 4)], *[
        F.sum((F.col(x).cast("double") - F.lit(float(m))) * e * e).alias(f"x{i}")
        for i, (x, m) in enumerate(zip(xs, fit["means"], strict=True))]).first()
    s = np.array([sums[f"x{i}"] for i in range(k)], dtype=float)
    # A perfect fit leaves rounding errors only: nothing to test.
    sst = sums["e4"] - sums["e2"] ** 2 / n
    r2 = float(s @ np.linalg.pinv(fit["sxx"]) @ s / sst) if k and sst > 0 else float("nan")
    f = (r2 / k) / ((1 - r2) / (n - k - 1)) if k and r2 < 1 else float("nan")
    m1, m2, m3, m4 = (sums[f"e{j}"] / n for j in (1, 2, 3, 4))
    var = m2 - m1 ** 2
    skew = (m3 - 3 * m1 * m2 + 2 * m1 ** 3) / var ** 1.5 if var > 0 else float("nan")
    kurt = (m4 - 4 * m1 * m3 + 6 * m1 ** 2 * m2 - 3 * m1 ** 4) / var ** 2 if var > 0 else float("nan")
    jb = n / 6 * (skew ** 2 + (kurt - 3) ** 2 / 4)

    def tail(fn, value, *args):
        return float("nan") if math.isnan(value) else fn(value, *args)

    return {"lm_stat": n * r2, "lm_p_value": tail(chi2_sf, n * r2, k), "f_stat": f, "f_p_value": tail(f_sf, f, k, n - k - 1),
            "jb_stat": jb, "jb_p_value": tail(chi2_sf, jb, 2)}


def vif(df: DataFrame, xs: Sequence[str]) -> list[tuple[str, float | None]]:
    """VIF without a constant (uncentred): VIF_j = [(X'X)⁻¹]_jj · (X'X)_jj."""
    d = df.select(*[F.col(c).cast("double").alias(c) for c in xs])
    aggs = [F.sum(F.col(a) * F.col(xs[j])).alias(f"xx{i}_{j}") for i, a in enumerate(xs) for j in range(i, len(xs))]
    r = d.agg(*aggs).first()
    k = len(xs)
    m = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            m[i, j] = m[j, i] = r[f"xx{i}_{j}"]
    try:
        inv = np.linalg.inv(m)
        return [(c, float(inv[i, i] * m[i, i])) for i, c in enumerate(xs)]
    except np.linalg.LinAlgError:
        return [(c, None) for c in xs]


def residuals(df: DataFrame, fit: dict, y: str, out: str = "resid") -> DataFrame:
    pred = F.lit(float(fit["beta"][0]))
    for b, name in zip(fit["beta"][1:], fit["names"][1:]):
        pred = pred + F.lit(float(b)) * F.col(name).cast("double")
    return df.withColumn("fitted", pred).withColumn(out, F.col(y).cast("double") - pred)


def breusch_pagan(resid_df: DataFrame, xs: Sequence[str], resid: str = "resid") -> dict:
    """Regress e² on the design: LM = n·R² ~ χ²(k); F = (R²/k)/((1−R²)/(n−k−1))."""
    d = resid_df.withColumn("_e2", F.col(resid) * F.col(resid))
    fit = ols(d, "_e2", xs)
    n, k, r2 = fit["n"], fit["k"], fit["r2"]
    lm = n * r2
    f = (r2 / k) / ((1 - r2) / (n - k - 1)) if k and r2 < 1 else float("nan")
    return {"lm_stat": lm, "lm_p_value": chi2_sf(lm, k), "f_stat": f, "f_p_value": f_sf(f, k, n - k - 1)}


def regression_metrics(scored: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """MAE, RMSE and R² on the original scale in one pass (R² NULL for ≤ 1 row or a constant target)."""
    e = F.col(actual) - F.col(predicted)
    s = scored.agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"),
                   F.sqrt(F.avg(e * e)).alias("rmse"), F.sum(e * e).alias("_sse"),
                   F.var_pop(actual).alias("_vp"))
    r2 = F.when(F.col("n") > 1, 1 - F.try_divide(F.col("_sse"), F.col("_vp") * F.col("n")))
    return s.select("n", "mae", "rmse", r2.alias("r2"))
