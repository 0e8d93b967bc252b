"""Exploratory aggregates: series, counts, KPIs, descriptive statistics, plot tables.

Every function is one or two aggregations over the whole input; wide reports
compute all columns in a single pass and reshape the one-row result with
``stack`` (no row blow-up before the shuffle).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.functions.numeric import kurt_corrected, skew_corrected
from salescope.operators.ranks import quantiles
from salescope.schema import NUMERIC

# Columns the period view loads (pruned scan).
PERIOD_COLUMNS = ["ts", "channel", "sku", "units", "discount", "amount", "store", "gender", "age",
                  "purchase_frequency", "outlier_amount", "outlier_units"]


#: Groups whose quartiles are broadcast.
MAX_BOXES = 50_000


def pruned_scan(df: DataFrame, columns: Sequence[str] = PERIOD_COLUMNS) -> DataFrame:
    """Only the needed columns, rows without timestamp or amount dropped."""
    return df.select(*[c for c in columns if c in df.columns]).dropna(subset=["ts", "amount"])


#: Partition column of stored sales: ``yyyy-MM``.
MONTH = "sale_month"


def with_month(df: DataFrame) -> DataFrame:
    """Adds the partition column; rows without a time get month ``none``."""
    return df.withColumn(MONTH, F.coalesce(F.date_format("ts", "yyyy-MM"), F.lit("none")))


def period(df: DataFrame, start: str | None = None, end: str | None = None,
           bounds: tuple[str, str] | None = None) -> DataFrame:
    """Rows with ``start 00:00:00 <= ts <= end 23:59:59`` (inclusive days).

    ``bounds`` (first and last available day) makes the check of the original
    view: start must not be after end, and both must lie inside the data.
    Unset ends mean the full range.  If the month column is there, a filter on it
    lets the scan skip the partitions of other months.
    """
    if start is not None and end is not None and start > end:
        raise ValueError("La fecha inicial no puede ser mayor que la final.")
    if bounds is not None:
        if (start is not None and start < bounds[0]) or (end is not None and end > bounds[1]):
            raise ValueError(f"Selecciona fechas entre {bounds[0]} y {bounds[1]}.")
    cond = F.lit(True)
    if MONTH in df.columns:
        if start is not None:
            cond = cond & (F.col(MONTH) >= start[:7])
        if end is not None:
            cond = cond & (F.col(MONTH) <= end[:7])
    if start is not None:
        cond = cond & (F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        last = _dt.datetime.fromisoformat(end) + _dt.timedelta(days=1) - _dt.timedelta(seconds=1)
        cond = cond & (F.col("ts") <= F.lit(last.isoformat(sep=" ")).cast("timestamp_ntz"))
    return df.filter(cond)


def daily_sales(df: DataFrame, ts: str = "ts", value: str = "amount") -> DataFrame:
    """Amount summed per calendar day: ``day, amount`` (sort on output if needed)."""
    return (df.filter(F.col(ts).isNotNull())
            .groupBy(F.to_date(ts).alias("day"))
            .agg(F.sum(value).alias("amount")))


def channel_counts(df: DataFrame, key: str = "channel") -> DataFrame:
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def channel_amount(df: DataFrame, key: str = "channel", value: str = "amount") -> DataFrame:
    return df.groupBy(key).agg(F.sum(value).alias("amount"))


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Long contingency table ``a, b, n`` (rows with a NULL in either are left out)."""
    return (df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
            .groupBy(a, b).agg(F.count(F.lit(1)).alias("n")))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull()).select(col).distinct()


def distinct_days(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.filter(F.col(ts).isNotNull()).select(F.to_date(ts).alias("day")).distinct()


def missing_report(df: DataFrame, treatments: dict[str, tuple] | None = None) -> DataFrame:
    """Per column: missing count, percent, treatment (action, method, reason, limitation).

    One aggregate over all columns, then ``stack`` on the one-row result.
    """
    treatments = treatments or MISSING_TREATMENTS
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        miss = F.col(c).isNull()
        if dict(df.dtypes)[c] in ("double", "float"):
            miss = miss | F.isnan(c)
        aggs.append(F.count_if(miss).alias(f"_m{i}"))
    one = df.agg(*aggs)
    default = ("sin imputacion", "no aplica", None, None)
    parts = []
    for i, c in enumerate(cols):
        texts = ["CAST(NULL AS STRING)" if x is None else f"'{x}'" for x in (*treatments.get(c, default), None)[:4]]
        parts.append(f"'{c}', `_m{i}`, {', '.join(texts)}")
    st = one.selectExpr("_rows", f"stack({len(cols)}, {', '.join(parts)}) AS (column_name, missing, action, method, reason, limitation)")
    pct = F.when(F.col("_rows") > 0, F.col("missing") * 100.0 / F.col("_rows")).otherwise(F.lit(0.0))
    return st.select("column_name", F.col("missing").cast("bigint").alias("missing"), pct.alias("percent"),
                     "action", "method", "reason", "limitation")


# Documented treatments of the original missing-value report.
MISSING_TREATMENTS = {
    "discount": ("imputacion", "mediana", "La mediana es robusta frente a descuentos extremos.", None),
    "birth_date": ("imputacion", "fecha fija 2000-01-01",
                   "Respaldo trazable para permitir calcular EDAD cuando la fecha viene ausente o invalida.",
                   "Puede sesgar la edad; se declara como imputacion simple y debe revisarse si aparecen faltantes relevantes."),
}


def clean_summary(df: DataFrame) -> DataFrame:
    """Rows, outlier sums and, per column still missing values, the count (long form)."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum("outlier_amount"), F.lit(0)).cast("bigint").alias("outliers_amount"),
            F.coalesce(F.sum("outlier_units"), F.lit(0)).cast("bigint").alias("outliers_units")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    missing = F.filter(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_m{i}").alias("missing"))
                                 for i, c in enumerate(cols)]), lambda s: s["missing"] > 0)
    return one.select("rows", "outliers_amount", "outliers_units",
                      F.to_json(F.map_from_entries(missing)).alias("missing_json"))


def _long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(variable, value double) for the listed columns, NULL/NaN values left out."""
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    return (df.selectExpr(f"stack({len(cols)}, {stack}) AS (variable, value)")
            .filter(F.col("value").isNotNull() & ~F.isnan("value")))


def descriptive_stats(df: DataFrame, cols: Sequence[str] = NUMERIC) -> DataFrame:
    """n, mean, median, sd and variance (sample), min, max, skewness and kurtosis (bias-corrected).

    Moments are one single-pass aggregate per variable; medians come from the
    distributed quantile operator (value counts), never from an in-task buffer.
    A constant column gets skewness and kurtosis 0.0.
    """
    cols = [c for c in cols if c in df.columns]
    names = ("n", "mean", "sd", "variance", "min", "max", "_g1", "_g2", "_vp")
    aggs = []
    for i, c in enumerate(cols):
        x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        values = (F.count(x), F.avg(x), F.stddev_samp(x), F.var_samp(x), F.min(x), F.max(x), F.skewness(x),
                  F.kurtosis(x), F.var_pop(x))
        aggs += [v.alias(f"{n}{i}") for v, n in zip(values, names)]
    stack = ", ".join(f"'{c}', " + ", ".join(f"`{n}{i}`" for n in names) for i, c in enumerate(cols))
    mom = df.agg(*aggs).selectExpr(f"stack({len(cols)}, {stack}) AS (variable, {', '.join(names)})").filter("n > 0")
    med = quantiles(_long(df, cols), "value", [0.5], ["variable"]).select("variable",
                                                                         F.col("quantile").alias("median"))
    flat = F.col("_vp") == 0
    return (mom.join(med, "variable", "left")
            .select("variable", "n", "mean", "median", "sd", "variance", "min", "max",
                    F.when(flat & (F.col("n") >= 3), F.lit(0.0)).otherwise(skew_corrected("_g1", "n")).alias("skewness"),
                    F.when(flat & (F.col("n") >= 4), F.lit(0.0)).otherwise(kurt_corrected("_g2", "n")).alias("kurtosis")))


def quantile_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``variable, q, quantile`` for several columns in one distributed job."""
    return quantiles(_long(df, cols), "value", probs, ["variable"])


def period_kpis(df: DataFrame, discards: DataFrame | None = None) -> DataFrame:
    """Rows, total, mean, median, active channels and stores, outliers; plus global discards.

    Zeros (not NULL) when the period is empty.
    """
    med = quantiles(df, "amount", [0.5]).select(F.col("quantile").alias("median_amount"))
    k = df.agg(F.count(F.lit(1)).alias("rows"),
               F.coalesce(F.sum("amount"), F.lit(0.0)).alias("total_amount"),
               F.coalesce(F.avg("amount"), F.lit(0.0)).alias("mean_amount"),
               F.count_distinct("channel").alias("channels"),
               F.count_distinct("store").alias("stores"),
               F.coalesce(F.sum("outlier_amount"), F.lit(0)).cast("bigint").alias("outliers_amount"))
    k = k.crossJoin(F.broadcast(med.agg(F.max("median_amount").alias("median_amount"))))
    k = k.withColumn("median_amount", F.coalesce("median_amount", F.lit(0.0)))
    if discards is not None:
        d = discards.agg(F.count(F.lit(1)).alias("discarded"),
                         F.count_if(F.col("field") == "EDAD").alias("discarded_age"))
        k = k.crossJoin(F.broadcast(d))
    return k


def box_stats(df: DataFrame, group: str = "channel", value: str = "amount", whis: float = 1.5) -> DataFrame:
    """Per group: q1, median, q3 and the whiskers (last data point within ``whis``·IQR).

    The quartiles, one row a group, go to the rows by broadcast as long as there
    are at most ``MAX_BOXES`` groups, so the rows of a large group are aggregated
    where they are; more groups than that are joined by a shuffle.
    """
    q = quantiles(df, value, [0.25, 0.5, 0.75], [group])
    qw = q.groupBy(group).agg(*[F.max(F.when(F.col("q") == p, F.col("quantile"))).alias(n)
                                for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    few = df.agg(F.approx_count_distinct(group)).first()[0] <= MAX_BOXES
    qw = F.broadcast(qw) if few else qw
    x = F.col(value)
    span = whis * (F.col("q3") - F.col("q1"))
    ends = (df.filter(x.isNotNull() & F.col(group).isNotNull()).select(group, value)
            .join(qw, group)
            .groupBy(group, "q1", "median", "q3")
            .agg(F.min(F.when(x >= F.col("q1") - span, x)).alias("whisker_low"),
                 F.max(F.when(x <= F.col("q3") + span, x)).alias("whisker_high")))
    return ends


def density_histogram(df: DataFrame, value: str, bins: int = 40) -> DataFrame:
    """Equal-width bins between min and max, empty ones too: ``bin, left, right, n, density``.

    The maximum falls in the last bin (numpy convention); density = n / (N ·
    width).  A constant column has one bin of width 1; no values give no bins.
    """
    x = F.col(value).cast("double")
    data = df.filter(x.isNotNull() & ~F.isnan(x)).select(x.alias("_x"))
    mm = data.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    width = F.when(F.col("_hi") == F.col("_lo"), F.lit(1.0)).otherwise((F.col("_hi") - F.col("_lo")) / bins)
    at = F.least(F.floor((F.col("_x") - F.col("_lo")) / width), F.lit(bins - 1)).cast("int")
    counted = data.crossJoin(F.broadcast(mm)).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("_c"))
    last = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(F.lit(bins - 1))
    grid = (mm.filter(F.col("_n") > 0).withColumn("_w", width)
            .select("*", F.explode(F.sequence(F.lit(0), last)).alias("bin")))
    n = F.coalesce("_c", F.lit(0))
    return (grid.join(counted, "bin", "left")
            .select("bin", (F.col("_lo") + F.col("bin") * F.col("_w")).alias("left"),
                    (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("right"), n.alias("n"),
                    (n / (F.col("_n") * F.col("_w"))).alias("density")))


def kde_curve(df: DataFrame, value: str, points: int = 200) -> DataFrame:
    """Gaussian KDE with Scott's bandwidth on a grid of ``points`` between min and max.

    One aggregate with a sum for each grid point over the value counts: no row
    is multiplied.  Without variation (or with one value) the density is NULL.
    """
    x = F.col(value).cast("double")
    data = df.filter(x.isNotNull() & ~F.isnan(x)).select(x.alias("_x"))
    st = data.agg(F.count(F.lit(1)).alias("_n"), F.stddev_samp("_x").alias("_sd"),
                  F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    h = F.nullif(F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2)), F.lit(0.0))
    vc = data.groupBy("_x").agg(F.count(F.lit(1)).alias("_c")).crossJoin(F.broadcast(st)).withColumn("_h", h)

    def grid(k):
        return F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.lit(k) / F.lit(max(points - 1, 1))

    sums = vc.agg(*[F.sum(F.col("_c") * F.exp(-0.5 * F.pow((grid(k) - F.col("_x")) / F.col("_h"), 2))).alias(f"_s{k}")
                    for k in range(points)])
    one = st.filter(F.col("_n") > 0).withColumn("_h", h).crossJoin(F.broadcast(sums))
    rows = one.select("_n", "_h", "_lo", "_hi", F.posexplode(F.array(*[f"_s{k}" for k in range(points)]))
                      .alias("point", "_s"))
    return rows.select("point", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("point")
                                 / F.lit(max(points - 1, 1))).alias("grid_x"),
                       (F.col("_s") / (F.col("_n") * F.col("_h") * F.lit((2 * 3.141592653589793) ** 0.5)))
                       .alias("density"))


def top_k_groups(df: DataFrame, key: str = "store", k: int = 200) -> DataFrame:
    """The ``k`` groups with most rows (ties broken by key), with their counts."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), F.col(key)).limit(k)
