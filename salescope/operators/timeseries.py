"""Daily series analyses: gap filling, weekly decomposition, ACF/PACF, status.

The input is the daily aggregate (one row per day), so its size is the number
of days, not the number of sales; windows ordered by day over it are cheap.
The aggregate itself (``profile.daily_sales``) is a distributed group-by.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MIN_DAYS_DECOMPOSE = 14
MIN_DAYS_ACF = 10
MAX_LAGS = 30


def fill_days(daily: DataFrame, day: str = "day", value: str = "amount") -> DataFrame:
    """Every calendar day between the first and last one; missing days get 0.0."""
    bounds = daily.agg(F.min(day).alias("_a"), F.max(day).alias("_b"))
    cal = bounds.select(F.explode(F.sequence("_a", "_b")).alias(day))
    return (cal.join(daily, day, "left")
            .select(day, F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias(value)))


def seasonal_decompose(daily: DataFrame, period: int = 7, day: str = "day", value: str = "amount") -> DataFrame:
    """Additive decomposition on the gap-filled series (centred moving average trend).

    trend: centred mean of ``period`` days (NULL where the window is incomplete);
    seasonal: mean detrended value per position ``t mod period`` (t = days since
    the first day), centred to sum 0; resid = observed − trend − seasonal.
    """
    filled = fill_days(daily, day, value)
    first = filled.agg(F.min(day).alias("_d0"))
    s = filled.crossJoin(F.broadcast(first)).withColumn("_t", F.datediff(day, "_d0"))
    half = period // 2
    w = Window.orderBy("_t").rowsBetween(-half, half)
    if period % 2 == 1:
        trend = F.when(F.count(value).over(w) == period, F.avg(value).over(w))
    else:
        w2 = Window.orderBy("_t").rowsBetween(-half, half)
        lead, lag = F.lead(value, half).over(Window.orderBy("_t")), F.lag(value, half).over(Window.orderBy("_t"))
        tot = F.sum(value).over(w2)
        trend = F.when(F.count(value).over(w2) == period + 1, (tot - 0.5 * lead - 0.5 * lag) / period)
    s = s.withColumn("trend", trend).withColumn("_pos", F.pmod("_t", F.lit(period)))
    pm = (s.filter(F.col("trend").isNotNull())
          .groupBy("_pos").agg(F.avg(F.col(value) - F.col("trend")).alias("_pm")))
    centre = pm.agg(F.avg("_pm").alias("_c"))
    seas = pm.crossJoin(centre).select("_pos", (F.col("_pm") - F.col("_c")).alias("seasonal"))
    out = s.join(F.broadcast(seas), "_pos", "left")
    return out.select(day, F.col(value).alias("observed"), "trend", "seasonal",
                      (F.col(value) - F.col("trend") - F.col("seasonal")).alias("resid"))


def acf(daily: DataFrame, day: str = "day", value: str = "amount", max_lags: int = MAX_LAGS,
        lags: int | None = None) -> DataFrame:
    """Autocorrelation of the observed days (gaps are not filled), lags 0..L.

    L = min(max_lags, max(1, n // 2 − 1)); acf(k) = Σ (x_t − x̄)(x_{t+k} − x̄) / Σ (x_t − x̄)².
    Also returns the 95 % Bartlett band half-width for each lag.  A constant
    series has acf and band NULL.
    """
    s = daily.select(day, F.col(value).cast("double").alias("x"))
    s = s.withColumn("_t", F.row_number().over(Window.orderBy(day)) - 1)
    st = s.agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"))
    if lags is None:
        nlag = F.least(F.lit(max_lags), F.greatest(F.lit(1), F.floor(F.col("n") / 2) - 1))
    else:
        nlag = F.lit(lags)
    lag_tab = st.select("n", "mean", F.explode(F.sequence(F.lit(0), nlag.cast("int"))).alias("lag"))
    c = s.crossJoin(F.broadcast(st.select("mean"))).select("_t", (F.col("x") - F.col("mean")).alias("d"))
    pairs = (c.alias("u").join(F.broadcast(lag_tab.select("lag")), how="cross")
             .join(c.alias("v"), F.col("v._t") == F.col("u._t") + F.col("lag")))
    cov = pairs.groupBy("lag").agg(F.sum(F.col("u.d") * F.col("v.d")).alias("num"))
    c0 = cov.filter(F.col("lag") == 0).select(F.col("num").alias("den"))
    r = lag_tab.join(cov, "lag", "left").crossJoin(c0).select(
        "lag", "n", F.try_divide(F.coalesce("num", F.lit(0.0)), F.col("den")).alias("acf"))
    # Bartlett: se(k) = sqrt((1 + 2·Σ_{j<k} acf(j)²) / n) for k ≥ 1.
    w = Window.orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)
    sq = F.sum(F.when(F.col("lag") > 0, F.col("acf") * F.col("acf")).otherwise(F.lit(0.0))).over(w)
    return r.select("lag", "acf",
                    F.when((F.col("lag") > 0) & F.col("acf").isNotNull(), 1.959963984540054 * F.sqrt(F.try_divide(1 + 2 * F.coalesce(sq, F.lit(0.0)), F.col("n"))))
                    .alias("band"))


def _durbin_levinson(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("lag")
    r = pdf["acf"].to_numpy(dtype=float)
    m = len(r) - 1
    out = np.zeros(m + 1)
    out[0] = 1.0
    phi = np.zeros(m + 1)
    prev = np.zeros(m + 1)
    v = 1.0
    for k in range(1, m + 1):
        num = r[k] - np.dot(prev[1:k], r[1:k][::-1])
        a = num / v if v != 0 else np.nan
        phi[:] = 0
        phi[k] = a
        phi[1:k] = prev[1:k] - a * prev[1:k][::-1]
        v = v * (1 - a * a)
        out[k] = a
        prev = phi.copy()
    key = pdf["series"].iloc[0]
    return pd.DataFrame({"series": key, "lag": np.arange(m + 1), "pacf": out})


def pacf(acf_table: DataFrame, series: str | None = None) -> DataFrame:
    """PACF from the ACF (Yule-Walker through Durbin-Levinson), one small group per series."""
    t = acf_table.withColumn("series", F.lit(series or "serie") if "series" not in acf_table.columns
                             else F.col("series"))
    return t.select("series", "lag", "acf").groupBy("series").applyInPandas(
        _durbin_levinson, "series string, lag int, pacf double")


def temporal_status(daily: DataFrame) -> DataFrame:
    """Days observed and whether decomposition (≥ 14 days) and ACF/PACF (≥ 10 days) are possible."""
    n = daily.agg(F.count(F.lit(1)).alias("days_observed"))
    return n.select(
        "days_observed",
        F.when(F.col("days_observed") >= MIN_DAYS_DECOMPOSE, F.lit("generada"))
        .otherwise(F.lit("no_generada: se requieren al menos 14 dias")).alias("decomposition"),
        F.when(F.col("days_observed") >= MIN_DAYS_ACF, F.lit("generada"))
        .otherwise(F.lit("no_generada: se requieren al menos 10 dias")).alias("acf_pacf"))
