"""Cleaning: typing, essential-field filter, imputation, derived columns, flags, z-scores.

Scalars computed over the whole table (median, quartiles, mean/sd) are one-row
aggregates cross-joined onto the rows as a broadcast (one row: bounded).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.functions import parse as P
from salescope.functions.numeric import nan_to_null
from salescope.operators.ranks import quantile_row, quantiles
from salescope.schema import CLEAN_REQUIRED, ESSENTIAL, MAX_VALID_AGE, NUMERIC, RAW_OF
from salescope.session import written

# Imputation constants of the original pipeline.
BIRTH_DATE_FILL = "2000-01-01"
IQR_FACTOR = 1.5


def require_columns(df: DataFrame, required: Sequence[str] = CLEAN_REQUIRED) -> None:
    """Raise before any job runs if required columns are missing (names listed sorted)."""
    missing = sorted(set(required) - {c.strip() for c in df.columns})
    if missing:
        raise ValueError("Faltan columnas requeridas: " + ", ".join(missing))


#: Heavy customers are at most so many.
HEAVY = 10_000


def strip_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def coerce_types(text_rows: DataFrame) -> DataFrame:
    """Validated text rows → typed columns; unparsable values become NULL (NaN → NULL)."""
    df = strip_column_names(text_rows)
    require_columns(df)
    typed = {
        "ts": P.parse_iso_timestamp("ts"),
        "sku": P.parse_int("sku").cast("bigint"),
        "units": P.parse_int("units").cast("bigint"),
        "discount": nan_to_null(P.parse_float("discount")),
        "amount": nan_to_null(P.parse_float("amount")),
        "receipt": P.parse_int("receipt").cast("bigint"),
        "store": P.parse_int("store").cast("bigint"),
        "birth_date": P.parse_ymd_date("birth_date"),
        "gender": P.parse_int("gender").cast("int"),
    }
    return df.select(*[typed[c].alias(c) if c in typed else F.col(c) for c in df.columns])


def drop_incomplete(df: DataFrame, essential: Sequence[str] = ESSENTIAL) -> DataFrame:
    return df.dropna(subset=list(essential))


def impute_median(df: DataFrame, col: str) -> DataFrame:
    """Fill NULLs of ``col`` with its exact median (computed distributed)."""
    med = quantile_row(df, col, [0.5], ["_median"])
    return (df.crossJoin(F.broadcast(med))
            .withColumn(col, F.coalesce(F.col(col), F.col("_median")))
            .drop("_median"))


def impute_constant(df: DataFrame, col: str, value) -> DataFrame:
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(value).cast(dict(df.dtypes)[col])))


def amount_per_unit(df: DataFrame) -> DataFrame:
    return df.withColumn("amount_per_unit", F.col("amount") / F.nullif(F.col("units"), F.lit(0)))


def age_years(df: DataFrame) -> DataFrame:
    """Whole days between birth and sale / 365.25, clipped at 0 (NULL stays NULL)."""
    age = F.datediff(F.to_date("ts"), F.col("birth_date")) / 365.25
    return df.withColumn("age", F.when(age.isNotNull(), F.greatest(age, F.lit(0.0))))


def age_backstop(df: DataFrame, max_age: int = MAX_VALID_AGE) -> DataFrame:
    """Keep rows with age <= max_age (a NULL age is dropped too)."""
    return df.filter(F.col("age") <= max_age)


def customer_counts(df: DataFrame, key: str = "customer_id", out: str = "purchase_frequency") -> DataFrame:
    """Rows of each customer."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def purchase_frequency(df: DataFrame, key: str = "customer_id", out: str = "purchase_frequency",
                       counts: DataFrame | None = None) -> DataFrame:
    """Rows per customer on every row.

    Customers with at least ``1 / HEAVY`` of all rows (so at most ``HEAVY`` of
    them) are joined by broadcast: their rows stay where they are.  All others
    join their count on the key.  Rows without a key get NULL.  ``counts``: the
    ``customer_counts`` of ``df``, if they are at hand.
    """
    counts = customer_counts(df, key, out) if counts is None else counts
    total = counts.agg((F.sum(out) / HEAVY).alias("_least"))
    heavy = (counts.crossJoin(F.broadcast(total)).filter(F.col(out) >= F.col("_least"))
             .select(F.col(key), F.col(out).alias("_heavy")))
    tagged = df.join(F.broadcast(heavy), key, "left")
    light = tagged.filter(F.col("_heavy").isNull()).drop("_heavy").join(counts, key, "left")
    return light.unionByName(tagged.filter(F.col("_heavy").isNotNull()).withColumnRenamed("_heavy", out))


def iqr_flags(df: DataFrame, specs: Sequence[tuple[str, str]], factor: float = IQR_FACTOR,
              values: DataFrame | None = None) -> DataFrame:
    """For each (column, flag): 1 when value < Q1 − f·IQR or > Q3 + f·IQR (strict), else 0.

    The quartiles of all listed columns come from one distributed quantile job
    (columns stacked as (variable, value)); the result is one broadcast row.
    ``values``: the same rows as a frame that is cheaper to read.
    """
    cols = [c for c, _ in specs]
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    long = ((df if values is None else values).selectExpr(f"stack({len(cols)}, {stack}) AS (variable, value)")
            .filter(F.col("value").isNotNull() & ~F.isnan("value")))
    q = quantiles(long, "value", [0.25, 0.75], ["variable"])
    row = q.agg(*[F.max(F.when((F.col("variable") == c) & (F.col("q") == p), F.col("quantile"))).alias(f"_{n}_{c}")
                  for c in cols for p, n in ((0.25, "q1"), (0.75, "q3"))])
    out = df.crossJoin(F.broadcast(row))
    for col, flag in specs:
        q1, q3 = F.col(f"_q1_{col}"), F.col(f"_q3_{col}")
        iqr = q3 - q1
        x = F.col(col)
        out = out.withColumn(flag, F.coalesce(((x < q1 - factor * iqr) | (x > q3 + factor * iqr)).cast("int"),
                                              F.lit(0)))
    return out.drop(*[f"_{n}_{c}" for c in cols for n in ("q1", "q3")])


def zscore_params(df: DataFrame, cols: Sequence[str] = NUMERIC) -> DataFrame:
    """``variable, mean, sd (population), generated_column`` in column order."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    one = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `m_{c}`, `s_{c}`, '{c}_z'" for c in cols)
    return one.selectExpr(f"stack({len(cols)}, {stack}) AS (variable, mean, sd, generated_column)")


def moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: mean ``_m_<c>`` and population sd ``_s_<c>`` of every column."""
    return df.agg(*[a for c in cols for a in (F.avg(c).alias(f"_m_{c}"), F.stddev_pop(c).alias(f"_s_{c}"))])


def frequency_moments(counts: DataFrame, key: str = "customer_id", out: str = "purchase_frequency") -> DataFrame:
    """``moments`` of ``purchase_frequency`` over the rows: a customer of k rows counts k times; no row is joined."""
    k = F.col(out).cast("double")
    known = counts.filter(F.col(key).isNotNull())
    mean = known.agg((F.sum(k * k) / F.sum(k)).alias(f"_m_{out}"))
    off = k - F.col(f"_m_{out}")
    sd = known.crossJoin(F.broadcast(mean)).agg(F.sqrt(F.sum(k * off * off) / F.sum(k)).alias(f"_s_{out}"))
    return mean.crossJoin(sd)


def zscores(df: DataFrame, cols: Sequence[str] = NUMERIC, params: DataFrame | None = None) -> DataFrame:
    """``<c>_z = (c − mean) / sd_pop``; 0.0 when sd is 0.  ``params``: the ``moments`` of ``df``, if they are at hand."""
    params = moments(df, cols) if params is None else params
    out = df.crossJoin(F.broadcast(params))
    for c in cols:
        m, s = F.col(f"_m_{c}"), F.col(f"_s_{c}")
        out = out.withColumn(f"{c}_z", F.when(s.isNull() | (s != 0), (F.col(c) - m) / s).otherwise(F.lit(0.0)))
    return out.drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])


def clean(typed: DataFrame, with_zscores: bool = True, cut_lineage: bool = False) -> DataFrame:
    """The cleaning stage in the original order.

    With ``cut_lineage`` the typed rows and the rows of each customer are written
    as Parquet to the shared folder before the whole-table scalars are computed: the
    median, the quartiles and the moments then read just their columns of them
    instead of re-running the upstream joins, and the rows are dealt out by customer
    and completed once, behind all scalars.
    """
    df = strip_column_names(typed)
    require_columns(df)
    df = drop_incomplete(df)
    if cut_lineage:
        df = written(df, "typed")
    df = impute_median(df, "discount")
    df = impute_constant(df, "birth_date", BIRTH_DATE_FILL)
    df = amount_per_unit(df)
    df = age_years(df)
    df = age_backstop(df)
    flags = [("amount", "outlier_amount"), ("units", "outlier_units")]
    if not cut_lineage:
        df = iqr_flags(purchase_frequency(df), flags)
        return zscores(df) if with_zscores else df
    counts = written(customer_counts(df), "customer-counts")
    full = iqr_flags(purchase_frequency(df, counts=counts), flags, values=df)
    if with_zscores:
        own = [c for c in NUMERIC if c != "purchase_frequency"]
        full = zscores(full, params=moments(df, own).crossJoin(frequency_moments(counts)))
    return full


def raw_names(df: DataFrame) -> DataFrame:
    """Rename snake_case columns to the public names (for files written for others)."""
    return df.toDF(*[RAW_OF.get(c, c) for c in df.columns])
