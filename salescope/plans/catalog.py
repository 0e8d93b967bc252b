"""Registered queries (Spark) and their oracle SQL (DuckDB), by key.

Keys follow the operator inventory.  Float outputs pass through ``sig`` on
both sides so that summation order does not change the compared values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.functions.numeric import sig
from salescope.operators import daycells as DC
from salescope.operators import missing as MI
from salescope.operators import profile as PR
from salescope.plans import oracle as O
from salescope.plans.views import clean_sales

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


# --------------------------------------------------------------------------- series and counts

@register("daily_sales", O.with_clean(f"""
SELECT CAST(ts AS DATE) AS day, {O.sig('sum(amount)')} AS amount
FROM cl WHERE ts IS NOT NULL GROUP BY 1"""))
def q_daily_sales(spark, d):
    return PR.daily_sales(clean_sales(spark, d)).select("day", sig("amount").alias("amount"))


@register("channel_counts", O.with_clean("""
SELECT channel, count(*) AS n FROM cl WHERE channel IS NOT NULL GROUP BY channel"""))
def q_channel_counts(spark, d):
    return PR.channel_counts(clean_sales(spark, d))


@register("channel_amount", O.with_clean(f"""
SELECT channel, {O.sig('sum(amount)')} AS amount FROM cl GROUP BY channel"""))
def q_channel_amount(spark, d):
    return PR.channel_amount(clean_sales(spark, d)).select("channel", sig("amount").alias("amount"))


@register("crosstab", O.with_clean("""
SELECT channel, gender, count(*) AS n FROM cl
WHERE channel IS NOT NULL AND gender IS NOT NULL GROUP BY channel, gender"""))
def q_crosstab(spark, d):
    return PR.crosstab(clean_sales(spark, d), "channel", "gender")


@register("distinct_days", O.with_clean("""
SELECT DISTINCT CAST(ts AS DATE) AS day FROM cl WHERE ts IS NOT NULL"""))
def q_distinct_days(spark, d):
    return PR.distinct_days(clean_sales(spark, d))


@register("pruned_scan", O.with_clean("""
SELECT ts, channel, sku, units, discount, amount, store, gender, age, purchase_frequency,
       outlier_amount, outlier_units FROM cl WHERE ts IS NOT NULL AND amount IS NOT NULL"""))
def q_pruned_scan(spark, d):
    return PR.pruned_scan(clean_sales(spark, d))


# --------------------------------------------------------------------------- sources and validation

from salescope.operators import validate as V  # noqa: E402
from salescope.plans.views import checked_lines, data_version, discarded_lines, quarantine_file, quoted_file, raw_file, text_parts, written_table  # noqa: E402
from salescope.plans.views import raw_text as raw_lines  # noqa: E402
from salescope.schema import RAW_FIELDS  # noqa: E402
from salescope.sources import text as TX  # noqa: E402
from salescope.sources.sinks import write_dealt_lines  # noqa: E402

HEAD_N = 8000
CHUNK = 10_000


def _failing(spark, d, fails, *columns):
    return V.failing(V.split_fields(raw_lines(spark, d)), fails, ["record_no", *columns])


@register("head_n", O.with_raw(f"SELECT record_no, line FROM raw WHERE record_no <= {HEAD_N}"))
def q_head_n(spark, d):
    """The first records of the raw text files."""
    return TX.head_n(TX.read_delimited(spark, raw_file(spark, d))[1], HEAD_N)


@register("volume_profile", O.with_raw(f"""
SELECT CAST(floor((record_no - 1) / {CHUNK}) AS BIGINT) AS chunk_index, count(*) AS rows,
  CAST(sum(count(*)) OVER () AS BIGINT) AS total, '{";".join(RAW_FIELDS)}' AS header FROM raw GROUP BY 1"""))
def q_volume_profile(spark, d):
    header, records = TX.read_delimited(spark, raw_file(spark, d))
    return TX.volume_profile(records, CHUNK, header)


@register("csv_records", O.with_sales("""
SELECT row_number() OVER (ORDER BY record_no, product, CAST(units AS VARCHAR)) AS record_no, CAST(4 AS INTEGER) AS n_fields, CAST(record_no AS VARCHAR) AS key, channel,
  CASE record_no % 7 WHEN 3 THEN 'CAJA "A"; ' || product || chr(10) || ';fin'
    WHEN 5 THEN product || chr(10) || chr(10) || '" otra linea' ELSE product || ' 5"' END AS product,
  CAST(units AS VARCHAR) AS units FROM sv"""))
def q_csv_records(spark, d):
    """Fields of text records that hold separators, quotes and line ends."""
    header, records = TX.read_delimited(spark, quoted_file(spark, d))
    return V.split_fields(records, header)


@register("rule_arity", O.with_checked("SELECT record_no, n_fields FROM rc2 WHERE fails_arity"))
def q_rule_arity(spark, d):
    return _failing(spark, d, F.col("fails_arity"), "n_fields")


@register("rule_required", O.with_checked(
    "SELECT record_no, empty_field FROM rc2 WHERE NOT fails_arity AND empty_field IS NOT NULL"))
def q_rule_required(spark, d):
    return _failing(spark, d, ~F.col("fails_arity") & F.col("empty_field").isNotNull(), "empty_field")


def _rule_query(key: str, flag: str, extra_spark=(), extra_sql=""):
    sql = O.with_checked(f"SELECT record_no{extra_sql} FROM rc2 WHERE NOT fails_arity AND {flag}")

    @register(key, sql)
    def q(spark, d):
        return _failing(spark, d, ~F.col("fails_arity") & F.col(flag), *extra_spark)
    return q


_rule_query("rule_integer", "fails_integer")
_rule_query("rule_positive", "fails_positive")
_rule_query("rule_decimal", "fails_decimal")
_rule_query("rule_range", "fails_range")
_rule_query("rule_check_digit", "fails_check_digit", ["national_id"], ", national_id")
_rule_query("rule_uuid", "fails_uuid", ["customer_id"], ", customer_id")
_rule_query("rule_timestamp", "fails_timestamp", ["ts"], ", ts")
_rule_query("rule_birth_date", "fails_birth_date", ["birth_date"], ", birth_date")
_rule_query("rule_gender", "fails_gender", ["gender"], ", gender")


@register("rule_age", O.with_checked(f"""
SELECT record_no, {O.sig('age_at_sale')} AS age_at_sale FROM rc2 WHERE NOT fails_arity AND fails_age"""))
def q_rule_age(spark, d):
    return _failing(spark, d, ~F.col("fails_arity") & F.col("fails_age"), sig("age_at_sale").alias("age_at_sale"))


@register("first_failure", O.with_checked("SELECT record_no, fail_field, fail_rule, fail_value FROM chk"))
def q_first_failure(spark, d):
    return checked_lines(spark, d).select("record_no", "fail_field", "fail_rule", "fail_value")


@register("valid_rows", O.with_checked(
    "SELECT * EXCLUDE (fail_field, fail_rule, fail_value) FROM chk WHERE fail_field IS NULL"))
def q_valid_rows(spark, d):
    return V.valid_rows(checked_lines(spark, d))


@register("quarantine_lines", O.with_checked("""
SELECT record_no, concat_ws(':', CAST(record_no AS VARCHAR), fail_field, fail_rule, fail_value) AS line
FROM chk WHERE fail_field IS NOT NULL"""))
def q_quarantine_lines(spark, d):
    return V.quarantine_lines(checked_lines(spark, d))


@register("validation_totals", O.with_checked("""
SELECT count(*) AS read, count(*) FILTER (WHERE fail_field IS NULL) AS valid,
       count(*) FILTER (WHERE fail_field IS NOT NULL) AS discarded,
       count(*) FILTER (WHERE fail_field = 'EDAD') AS discarded_age FROM chk"""))
def q_validation_totals(spark, d):
    return V.validation_totals(checked_lines(spark, d))


@register("chunk_totals", O.with_checked(f"""
SELECT CAST(floor((record_no - 1) / {CHUNK}) AS BIGINT) AS chunk_index, count(*) AS read,
       count(*) FILTER (WHERE fail_field IS NULL) AS valid,
       count(*) FILTER (WHERE fail_field IS NOT NULL) AS discarded,
       count(*) FILTER (WHERE fail_field = 'EDAD') AS discarded_age FROM chk GROUP BY 1"""))
def q_chunk_totals(spark, d):
    return V.chunk_totals(checked_lines(spark, d), CHUNK)


@register("discard_reasons", O.with_checked("""
SELECT fail_field AS field, count(*) AS n FROM chk WHERE fail_field IS NOT NULL GROUP BY 1"""))
def q_discard_reasons(spark, d):
    return V.discard_reasons(checked_lines(spark, d))


@register("discard_summary", O.with_checked("""
SELECT coalesce(reason, 'total') AS reason, count(*) AS n FROM
  (SELECT fail_field AS reason FROM chk WHERE fail_field IS NOT NULL) GROUP BY ROLLUP (reason)"""))
def q_discard_summary(spark, d):
    return V.discard_summary(spark.read.text(quarantine_file(spark, d)), "value")


# --------------------------------------------------------------------------- cleaning

from salescope.functions.numeric import nan_to_null, verdict  # noqa: E402
from salescope.operators import clean as C  # noqa: E402
from salescope.operators import model as M  # noqa: E402
from salescope.operators.ranks import quantile_row  # noqa: E402
from salescope.plans.views import sales  # noqa: E402
from salescope.schema import ESSENTIAL, NUMERIC  # noqa: E402

_S = O._strip


def _sql_coerce() -> str:
    return f"""SELECT record_no,
  {O._parse_ts(_S('ts'))} AS ts, channel,
  CAST({O._parse_int(_S('sku'))} AS BIGINT) AS sku, product,
  CAST({O._parse_int(_S('units'))} AS BIGINT) AS units,
  (CASE WHEN isnan({O._parse_float(_S('discount'))}) THEN NULL ELSE {O._parse_float(_S('discount'))} END) AS discount,
  (CASE WHEN isnan({O._parse_float(_S('amount'))}) THEN NULL ELSE {O._parse_float(_S('amount'))} END) AS amount,
  CAST({O._parse_int(_S('receipt'))} AS BIGINT) AS receipt,
  CAST({O._parse_int(_S('store'))} AS BIGINT) AS store,
  customer_id, national_id, first_names, last_names,
  {O._parse_date(_S('birth_date'))} AS birth_date,
  CAST({O._parse_int(_S('gender'))} AS INTEGER) AS gender
FROM chk WHERE fail_field IS NULL"""


def _coerced(spark, d):
    return C.coerce_types(V.valid_rows(checked_lines(spark, d)))


@register("coerce_types", O.with_checked(f"""
SELECT record_no, ts, channel, sku, units, {O.sig('discount')} AS discount, {O.sig('amount')} AS amount,
       receipt, store, customer_id, national_id, birth_date, gender FROM ({_sql_coerce()})"""))
def q_coerce_types(spark, d):
    c = _coerced(spark, d)
    return c.select("record_no", "ts", "channel", "sku", "units", sig("discount").alias("discount"),
                    sig("amount").alias("amount"), "receipt", "store", "customer_id", "national_id",
                    "birth_date", "gender")


_ESS_SQL = " AND ".join(f"{c} IS NOT NULL" for c in ESSENTIAL)


@register("drop_incomplete", O.with_checked(f"""
SELECT count(*) AS rows_before, count(*) FILTER (WHERE {_ESS_SQL}) AS rows_after FROM ({_sql_coerce()})"""))
def q_drop_incomplete(spark, d):
    c = _coerced(spark, d)
    kept = F.col("ts").isNotNull()
    for e in ESSENTIAL[1:]:
        kept = kept & F.col(e).isNotNull()
    return c.agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(kept).alias("rows_after"))


@register("impute_median", O.with_sales(f"""
SELECT {O.sig('quantile_cont(discount, 0.5)')} AS median_discount,
       count(*) FILTER (WHERE discount IS NULL) AS imputed FROM sv"""))
def q_impute_median(spark, d):
    s = C.drop_incomplete(sales(spark, d))
    med = quantile_row(s, "discount", [0.5], ["median_discount"])
    n = s.agg(F.count_if(F.col("discount").isNull()).alias("imputed"))
    return med.select(sig("median_discount").alias("median_discount")).crossJoin(n)


@register("impute_constant", O.with_sales("""
SELECT count(*) FILTER (WHERE birth_date IS NULL) AS imputed,
       min(coalesce(birth_date, DATE '2000-01-01')) AS birth_min,
       max(coalesce(birth_date, DATE '2000-01-01')) AS birth_max FROM sv"""))
def q_impute_constant(spark, d):
    s = sales(spark, d)
    imp = C.impute_constant(s, "birth_date", C.BIRTH_DATE_FILL)
    return s.agg(F.count_if(F.col("birth_date").isNull()).alias("imputed")).crossJoin(
        imp.agg(F.min("birth_date").alias("birth_min"), F.max("birth_date").alias("birth_max")))


@register("amount_per_unit", O.with_clean(f"SELECT record_no, {O.sig('amount_per_unit')} AS amount_per_unit FROM cl"))
def q_amount_per_unit(spark, d):
    return clean_sales(spark, d).select("record_no", sig("amount_per_unit").alias("amount_per_unit"))


@register("age_years", O.with_clean(f"SELECT record_no, {O.sig('age')} AS age FROM cl"))
def q_age_years(spark, d):
    return clean_sales(spark, d).select("record_no", sig("age").alias("age"))


@register("age_backstop", O.with_clean("""
SELECT (SELECT count(*) FROM c1) AS rows_before, (SELECT count(*) FROM c2) AS rows_after"""))
def q_age_backstop(spark, d):
    s = C.age_years(C.impute_constant(C.drop_incomplete(sales(spark, d)), "birth_date", C.BIRTH_DATE_FILL))
    return s.agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(F.col("age") <= 110).alias("rows_after"))


@register("purchase_frequency", O.with_clean("SELECT DISTINCT customer_id, purchase_frequency FROM cl"))
def q_purchase_frequency(spark, d):
    return clean_sales(spark, d).select("customer_id", "purchase_frequency").distinct()


def _iqr_sql(col: str) -> str:
    return f"""SELECT '{col}' AS variable, {O.sig('q1')} AS q1, {O.sig('q3')} AS q3,
  {O.sig('q1 - 1.5 * (q3 - q1)')} AS lower, {O.sig('q3 + 1.5 * (q3 - q1)')} AS upper,
  (SELECT count(*) FROM c3 WHERE {col} < q1 - 1.5 * (q3 - q1) OR {col} > q3 + 1.5 * (q3 - q1)) AS outliers
FROM (SELECT quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.75) AS q3 FROM c3)"""


@register("iqr_outliers", O.with_clean(_iqr_sql("amount") + "\nUNION ALL\n" + _iqr_sql("units")))
def q_iqr_outliers(spark, d):
    cl = clean_sales(spark, d)
    parts = []
    for col, flag in (("amount", "outlier_amount"), ("units", "outlier_units")):
        q = quantile_row(cl, col, [0.25, 0.75], ["q1", "q3"])
        iqr = F.col("q3") - F.col("q1")
        n = cl.agg(F.sum(flag).cast("bigint").alias("outliers"))
        parts.append(q.crossJoin(n).select(
            F.lit(col).alias("variable"), sig("q1").alias("q1"), sig("q3").alias("q3"),
            sig(F.col("q1") - 1.5 * iqr).alias("lower"), sig(F.col("q3") + 1.5 * iqr).alias("upper"), "outliers"))
    return parts[0].unionByName(parts[1])


_ZSQL_PARAMS = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in NUMERIC)


@register("zscore", O.with_clean(f"""
SELECT record_no, {', '.join(f'round(CASE WHEN s_{c} IS NULL OR s_{c} <> 0 THEN ({c} - m_{c}) / s_{c} ELSE 0.0 END, 8)' + f' AS {c}_z' for c in NUMERIC)}
FROM cl, (SELECT {_ZSQL_PARAMS} FROM cl)"""))
def q_zscore(spark, d):
    cl = clean_sales(spark, d)
    return cl.select("record_no", *[F.round(f"{c}_z", 8).alias(f"{c}_z") for c in NUMERIC])


@register("zscore_params", O.with_clean(" UNION ALL ".join(
    f"SELECT '{c}' AS variable, {O.sig(f'avg({c})')} AS mean, {O.sig(f'stddev_pop({c})')} AS sd, "
    f"'{c}_z' AS generated_column FROM cl" for c in NUMERIC)))
def q_zscore_params(spark, d):
    p = C.zscore_params(clean_sales(spark, d))
    return p.select("variable", sig("mean").alias("mean"), sig("sd").alias("sd"), "generated_column")


@register("calendar_features", O.with_clean("""
SELECT record_no, CAST(month(ts) AS INTEGER) AS month, CAST(isodow(ts) - 1 AS INTEGER) AS weekday,
       CAST(hour(ts) AS INTEGER) AS hour FROM cl"""))
def q_calendar_features(spark, d):
    return M.calendar_features(clean_sales(spark, d)).select("record_no", "month", "weekday", "hour")


@register("log_target", O.with_clean(f"""
SELECT record_no, {O.sig('ln(1 + amount)')} AS log_amount,
       {O.sig('greatest(exp(ln(1 + amount)) - 1, 0.0)')} AS back_transformed FROM cl"""))
def q_log_target(spark, d):
    cl = clean_sales(spark, d)
    lg = F.log1p("amount")
    return cl.select("record_no", sig(lg).alias("log_amount"),
                     sig(F.greatest(F.expm1(lg), F.lit(0.0))).alias("back_transformed"))


_LEVELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register("one_hot", O.with_clean("SELECT record_no, " + ", ".join(
    f"CAST(CASE WHEN channel = '{v}' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS \"channel_{v}\"" for v in _LEVELS[1:]) + " FROM cl"))
def q_one_hot(spark, d):
    return M.one_hot(clean_sales(spark, d).select("record_no", "channel"), "channel")


_PRED = ["units", "discount", "age", "purchase_frequency", "sku", "gender", "store", "month", "weekday", "hour"]


@register("drop_constant", O.with_clean(" UNION ALL ".join(
    f"SELECT '{c}' AS predictor FROM (SELECT min({e}) <> max({e}) AS v FROM cl) WHERE v"
    for c, e in [(c, {"month": "month(ts)", "weekday": "isodow(ts)", "hour": "hour(ts)"}.get(c, c)) for c in _PRED])))
def q_drop_constant(spark, d):
    m = M.calendar_features(clean_sales(spark, d))
    keep = M.varying_columns(m, _PRED)
    return spark.createDataFrame([(c,) for c in keep], "predictor string")


@register("verdict", O.with_clean("""
SELECT DISTINCT discount, CASE WHEN discount IS NULL OR isnan(discount) THEN 'No evaluable'
  WHEN discount < 0.05 THEN 'Se rechaza H0' ELSE 'No se rechaza H0' END AS decision FROM cl"""))
def q_verdict(spark, d):
    return clean_sales(spark, d).select("discount", verdict("discount").alias("decision")).distinct()


_SV_COLS = ["ts", "channel", "sku", "product", "units", "discount", "amount", "receipt", "store",
            "customer_id", "national_id", "first_names", "last_names", "birth_date", "gender"]


def _missing_sql() -> str:
    parts = []
    for c in _SV_COLS:
        act, met, *texts = PR.MISSING_TREATMENTS.get(c, ("sin imputacion", "no aplica", None, None))
        why_sql, limit_sql = ("CAST(NULL AS VARCHAR)" if x is None else O._q(x) for x in texts)
        miss = f"count(*) FILTER (WHERE {c} IS NULL{' OR isnan(' + c + ')' if c in ('discount', 'amount') else ''})"
        parts.append(f"SELECT '{c}' AS column_name, {miss} AS missing, "
                     f"{O.sig(f'CASE WHEN count(*) > 0 THEN {miss} * 100.0 / count(*) ELSE 0.0 END')} AS percent, "
                     f"'{act}' AS action, {O._q(met)} AS method, {why_sql} AS reason, {limit_sql} AS limitation FROM sv")
    return " UNION ALL ".join(parts)


@register("missing_report", O.with_sales(_missing_sql()))
def q_missing_report(spark, d):
    r = PR.missing_report(sales(spark, d).select(*_SV_COLS))
    return r.select("column_name", "missing", sig("percent").alias("percent"), "action", "method", "reason", "limitation")


_GAPS = [f"count(*) FILTER (WHERE {c} IS NULL{' OR isnan(' + c + ')' if c in ('discount', 'amount') else ''})" for c in _SV_COLS]


@register("missing_summary", O.with_sales(f"""
SELECT count(*) AS rows, CAST({' + '.join(_GAPS)} AS BIGINT) AS total_missing,
  CAST({' + '.join(f'CAST({g} > 0 AS INTEGER)' for g in _GAPS)} AS INTEGER) AS columns_with_gaps, {O._q(MI.MCAR_NOTE)} AS note FROM sv"""))
def q_missing_summary(spark, d):
    return MI.missing_summary(sales(spark, d).select(*_SV_COLS))


_CL_COLS = ["record_no", "ts", "channel", "sku", "units", "discount", "amount", "receipt", "store", "customer_id",
            "national_id", "birth_date", "gender", "amount_per_unit", "age", "purchase_frequency",
            "outlier_amount", "outlier_units"]


@register("clean_summary", O.with_clean(f"""
SELECT count(*) AS rows, CAST(coalesce(sum(outlier_amount), 0) AS BIGINT) AS outliers_amount,
       CAST(coalesce(sum(outlier_units), 0) AS BIGINT) AS outliers_units,
       (SELECT '{{' || coalesce(string_agg('"' || c || '":' || CAST(m AS VARCHAR), ',' ORDER BY pos), '') || '}}'
        FROM (SELECT * FROM (VALUES {', '.join(f"({i}, '{c}', (SELECT count(*) FILTER (WHERE {c} IS NULL) FROM cl))" for i, c in enumerate(_CL_COLS))}) t(pos, c, m) WHERE m > 0)) AS missing_json
FROM cl"""))
def q_clean_summary(spark, d):
    return PR.clean_summary(clean_sales(spark, d).select(*_CL_COLS))


# --------------------------------------------------------------------------- descriptive and plot tables

from salescope.operators import hypothesis as H  # noqa: E402
from salescope.operators import timeseries as TS  # noqa: E402
from salescope.operators.ranks import average_ranks  # noqa: E402

PERIOD = ("1996-01-01", "1996-03-31")
_PERIOD_SQL = "ts >= TIMESTAMP '1996-01-01 00:00:00' AND ts <= TIMESTAMP '1996-03-31 23:59:59'"


def _desc_sql(c: str) -> str:
    return (f"SELECT '{c}' AS variable, count({c}) AS n, {O.sig(f'avg({c})')} AS mean, "
            f"{O.sig(f'quantile_cont({c}, 0.5)')} AS median, {O.sig(f'stddev_samp({c})')} AS sd, "
            f"{O.sig(f'var_samp({c})')} AS variance, {O.sig(f'min({c})')} AS min, {O.sig(f'max({c})')} AS max, "
            f"{O.sig(f'CASE WHEN var_pop({c}) = 0 AND count({c}) >= 3 THEN 0.0 ELSE skewness({c}) END')} AS skewness, "
            f"{O.sig(f'CASE WHEN var_pop({c}) = 0 AND count({c}) >= 4 THEN 0.0 ELSE kurtosis({c}) END')} AS kurtosis "
            f"FROM cl")


@register("descriptive_stats", O.with_clean(" UNION ALL ".join(_desc_sql(c) for c in NUMERIC)))
def q_descriptive_stats(spark, d):
    r = PR.descriptive_stats(clean_sales(spark, d))
    return r.select("variable", "n", *[sig(c).alias(c) for c in
                                        ("mean", "median", "sd", "variance", "min", "max", "skewness", "kurtosis")])


@register("quantiles", O.with_clean(" UNION ALL ".join(
    f"SELECT '{c}' AS variable, CAST({q} AS DOUBLE) AS q, {O.sig(f'quantile_cont({c}, {q})')} AS quantile FROM cl"
    for c in NUMERIC for q in (0.25, 0.5, 0.75))))
def q_quantiles(spark, d):
    r = PR.quantile_table(clean_sales(spark, d), NUMERIC)
    return r.select("variable", "q", sig("quantile").alias("quantile"))


@register("period_filter", O.with_clean(f"SELECT record_no, ts, amount FROM cl WHERE {_PERIOD_SQL}"))
def q_period_filter(spark, d):
    return PR.period(clean_sales(spark, d, by_month=True), *PERIOD).select("record_no", "ts", "amount")


@register("period_kpis", O.with_clean(f"""
SELECT count(*) AS rows, {O.sig('coalesce(sum(amount), 0.0)')} AS total_amount,
       {O.sig('coalesce(avg(amount), 0.0)')} AS mean_amount, count(DISTINCT channel) AS channels,
       count(DISTINCT store) AS stores, CAST(coalesce(sum(outlier_amount), 0) AS BIGINT) AS outliers_amount,
       {O.sig('coalesce(quantile_cont(amount, 0.5), 0.0)')} AS median_amount
FROM cl WHERE {_PERIOD_SQL}"""))
def q_period_kpis(spark, d):
    k = PR.period_kpis(PR.period(clean_sales(spark, d, by_month=True), *PERIOD))
    return k.select("rows", sig("total_amount").alias("total_amount"), sig("mean_amount").alias("mean_amount"),
                    "channels", "stores", "outliers_amount", sig("median_amount").alias("median_amount"))


def _day_cells(spark, d, *names):
    """Day cells of the clean sales; those of the ``names`` a query asks are stored by month, once per version of the data."""
    cells = DC.day_cells(clean_sales(spark, d, by_month=True))
    return cells.stored(lambda name, frame: written_table(spark, f"day-{name}", d, lambda: frame, PR.MONTH) if name in names else frame)


@register("cells_kpis", O.with_checked_and_clean(f"""
SELECT k.*, d.* FROM (
  SELECT count(*) AS rows, {O.sig('coalesce(sum(amount), 0.0)')} AS total_amount,
    {O.sig('coalesce(avg(amount), 0.0)')} AS mean_amount, count(DISTINCT channel) AS channels, count(DISTINCT store) AS stores,
    CAST(coalesce(sum(outlier_amount), 0) AS BIGINT) AS outliers_amount,
    {O.sig('coalesce(quantile_cont(amount, 0.5), 0.0)')} AS median_amount FROM cl WHERE {_PERIOD_SQL}) k,
  (SELECT count(*) AS discarded, count(*) FILTER (WHERE fail_field = 'EDAD') AS discarded_age FROM chk WHERE fail_field IS NOT NULL) d"""))
def q_cells_kpis(spark, d):
    """Indicators of a period from day cells, with the discards of the validation."""
    k = _day_cells(spark, d, "moments", "members", "values").between(*PERIOD).kpis(V.quarantine(discarded_lines(spark, d)))
    return k.select("rows", sig("total_amount").alias("total_amount"), sig("mean_amount").alias("mean_amount"), "channels",
                    "stores", "outliers_amount", sig("median_amount").alias("median_amount"), "discarded", "discarded_age")


@register("cells_quantiles", O.with_clean(" UNION ALL ".join(
    f"SELECT '{c}' AS variable, CAST({q} AS DOUBLE) AS q, {O.sig(f'quantile_cont({c}, {q})')} AS quantile FROM cl WHERE {_PERIOD_SQL}"
    for c in NUMERIC for q in (0.25, 0.5, 0.75))))
def q_cells_quantiles(spark, d):
    q = _day_cells(spark, d, "values").between(*PERIOD).quantiles()
    return q.select("variable", "q", sig("quantile").alias("quantile"))


@register("box_stats", O.with_clean(f"""
WITH q AS (SELECT channel, quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.5) AS median,
                  quantile_cont(amount, 0.75) AS q3 FROM cl WHERE channel IS NOT NULL AND amount IS NOT NULL GROUP BY channel)
SELECT q.channel, {O.sig('q1')} AS q1, {O.sig('median')} AS median, {O.sig('q3')} AS q3,
       {O.sig('min(CASE WHEN amount >= q1 - 1.5 * (q3 - q1) THEN amount END)')} AS whisker_low,
       {O.sig('max(CASE WHEN amount <= q3 + 1.5 * (q3 - q1) THEN amount END)')} AS whisker_high
FROM cl JOIN q ON cl.channel = q.channel GROUP BY q.channel, q1, median, q3"""))
def q_box_stats(spark, d):
    b = PR.box_stats(clean_sales(spark, d))
    return b.select("channel", *[sig(c).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")])


@register("density_histogram", O.with_clean(f"""
WITH mm AS (SELECT min(amount) AS lo, max(amount) AS hi, count(*) AS n FROM cl WHERE amount IS NOT NULL),
b AS (SELECT CAST(least(floor((amount - lo) / ((hi - lo) / 40)), 39) AS INTEGER) AS bin, count(*) AS c
      FROM cl, mm WHERE amount IS NOT NULL GROUP BY 1)
SELECT CAST(g AS INTEGER) AS bin, {O.sig('lo + g * (hi - lo) / 40')} AS "left",
       {O.sig('lo + (g + 1) * (hi - lo) / 40')} AS "right",
       coalesce(c, 0) AS n, {O.sig('coalesce(c, 0) / (mm.n * ((hi - lo) / 40))')} AS density
FROM mm CROSS JOIN range(40) r(g) LEFT JOIN b ON b.bin = g"""))
def q_density_histogram(spark, d):
    h = PR.density_histogram(clean_sales(spark, d), "amount", 40)
    return h.select("bin", sig("left").alias("left"), sig("right").alias("right"), "n", sig("density").alias("density"))


@register("kde_curve", O.with_clean(f"""
WITH st AS (SELECT count(*) AS n, stddev_samp(amount) AS sd, min(amount) AS lo, max(amount) AS hi FROM cl WHERE amount IS NOT NULL),
g AS (SELECT CAST(p AS INTEGER) AS point, lo + (hi - lo) * p / 199 AS grid_x, n, sd * pow(CAST(n AS DOUBLE), -0.2) AS h
      FROM st, range(200) r(p)),
vc AS (SELECT amount AS x, count(*) AS c FROM cl WHERE amount IS NOT NULL GROUP BY amount)
SELECT point, {O.sig('grid_x')} AS grid_x,
       {O.sig('sum(c * exp(-0.5 * ((grid_x - x) / h) * ((grid_x - x) / h))) / (n * h * sqrt(2 * pi()))', 8)} AS density
FROM g, vc GROUP BY point, grid_x, n, h"""))
def q_kde_curve(spark, d):
    k = PR.kde_curve(clean_sales(spark, d), "amount", 200)
    return k.select("point", sig("grid_x").alias("grid_x"), sig("density", 8).alias("density"))


@register("guard_notes", O.with_clean("""
SELECT store, count(*) AS n, CASE WHEN count(*) < 2 OR coalesce(stddev_samp(amount), 0) = 0
  THEN 'No evaluable: grupo sin filas o variacion suficiente.' END AS note
FROM cl WHERE store IS NOT NULL AND amount IS NOT NULL GROUP BY store"""))
def q_guard_notes(spark, d):
    cl = clean_sales(spark, d)
    g = (cl.filter(F.col("store").isNotNull() & F.col("amount").isNotNull()).groupBy("store")
         .agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("amount").alias("_sd")))
    return g.select("store", "n", F.when((F.col("n") < 2) | (F.coalesce("_sd", F.lit(0.0)) == 0),
                                         F.lit("No evaluable: grupo sin filas o variacion suficiente.")).alias("note"))


@register("top_k_groups", O.with_clean("""
SELECT store, count(*) AS n FROM cl WHERE store IS NOT NULL GROUP BY store ORDER BY n DESC, store LIMIT 200"""))
def q_top_k_groups(spark, d):
    return PR.top_k_groups(clean_sales(spark, d), "store", 200)


def _hash_sql(key: str, seed: int = 42) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', CAST({key} AS VARCHAR), '{seed}')), 1, 15) AS BIGINT)"


@register("seeded_sample", f"""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY {_hash_sql('o_orderkey')}, o_orderkey LIMIT 5000""")
def q_seeded_sample(spark, d):
    from salescope.sources.tables import table
    o = table(spark, d, "orders", ["o_orderkey", "o_totalprice"])
    return M.seeded_sample(o, 5000, ["o_orderkey"])


@register("train_test_split", f"""
SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY {_hash_sql('o_orderkey')}, o_orderkey)
  <= ceil(0.3 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
FROM orders""")
def q_train_test_split(spark, d):
    from salescope.sources.tables import table
    o = table(spark, d, "orders", ["o_orderkey"])
    return M.train_test_split(o, ["o_orderkey"]).select("o_orderkey", "split")


# --------------------------------------------------------------------------- ranks and tests

@register("avg_rank", O.with_clean("""
SELECT amount, count(*) AS cnt,
       sum(count(*)) OVER (ORDER BY amount ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - count(*) + (count(*) + 1) / 2.0 AS rank
FROM cl WHERE amount IS NOT NULL GROUP BY amount"""))
def q_avg_rank(spark, d):
    return average_ranks(clean_sales(spark, d), "amount").select("amount", "cnt", "rank")


def _spearman_sql(pairs, where: str = "TRUE") -> str:
    parts = []
    for a, b in pairs:
        parts.append(f"""SELECT '{a}' AS var_a, '{b}' AS var_b, count(*) AS n,
  {O.sig('corr(ra, rb)')} AS rho FROM (
   SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0 AS ra,
          rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0 AS rb
   FROM cl WHERE {a} IS NOT NULL AND {b} IS NOT NULL AND {where})""")
    return " UNION ALL ".join(parts)


_PAIRS = [(NUMERIC[i], NUMERIC[j]) for i in range(len(NUMERIC)) for j in range(i + 1, len(NUMERIC))]
_PERIOD_VARS = ["discount", "amount", "age", "purchase_frequency"]
_PERIOD_PAIRS = [(_PERIOD_VARS[i], _PERIOD_VARS[j]) for i in range(4) for j in range(i + 1, 4)]
_TARGET_PAIRS = [("units", "amount"), ("units", "discount"), ("amount", "discount")]


def _spearman_spark(df, pairs):
    return H.spearman_pairs(df, pairs).select("var_a", "var_b", "n", sig("rho").alias("rho"))


@register("spearman_matrix", O.with_clean(_spearman_sql(_PAIRS)))
def q_spearman_matrix(spark, d):
    return _spearman_spark(clean_sales(spark, d), _PAIRS)


@register("period_spearman", O.with_clean(_spearman_sql(_PERIOD_PAIRS, _PERIOD_SQL)))
def q_period_spearman(spark, d):
    return _spearman_spark(PR.period(clean_sales(spark, d, by_month=True), *PERIOD), _PERIOD_PAIRS)


@register("cells_spearman", O.with_clean(_spearman_sql(_PERIOD_PAIRS, _PERIOD_SQL)))
def q_cells_spearman(spark, d):
    """The period's Spearman matrix from day cells."""
    s = _day_cells(spark, d, "tuples").between(*PERIOD).spearman(_PERIOD_PAIRS)
    return s.select("var_a", "var_b", "n", sig("rho").alias("rho"))


@register("spearman_pair", O.with_clean(_spearman_sql(_TARGET_PAIRS)))
def q_spearman_pair(spark, d):
    return _spearman_spark(clean_sales(spark, d), _TARGET_PAIRS)


def _chi_sql(a: str, b: str) -> str:
    w = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    return f"""SELECT 'Chi-cuadrado' AS test, '{a} vs {b}' AS variables,
  {O.sig('CASE WHEN r < 2 OR c < 2 THEN NULL WHEN (r - 1) * (c - 1) = 1 THEN ych ELSE s - n END')} AS statistic,
  CAST(CASE WHEN r >= 2 AND c >= 2 THEN (r - 1) * (c - 1) END AS BIGINT) AS dof,
  CASE WHEN r < 2 OR c < 2 THEN 'No evaluable: se requieren al menos 2 filas y 2 columnas.' END AS note
FROM (
  SELECT sum(o * o / e) AS s, max(n) AS n, max(r) AS r, max(c) AS c,
         sum(pow(greatest(abs(o - e) - 0.5, 0), 2) / e) AS ych
  FROM (
    SELECT coalesce(obs.o, 0) AS o, ra.ra * cb.cb / t.n AS e, t.n, t.r, t.c
    FROM (SELECT DISTINCT {a} AS a FROM cl WHERE {w}) ga
    CROSS JOIN (SELECT DISTINCT {b} AS b FROM cl WHERE {w}) gb
    LEFT JOIN (SELECT {a} AS a, {b} AS b, count(*) AS o FROM cl WHERE {w} GROUP BY 1, 2) obs
      ON obs.a = ga.a AND obs.b = gb.b
    JOIN (SELECT {a} AS a, count(*) AS ra FROM cl WHERE {w} GROUP BY 1) ra ON ra.a = ga.a
    JOIN (SELECT {b} AS b, count(*) AS cb FROM cl WHERE {w} GROUP BY 1) cb ON cb.b = gb.b
    CROSS JOIN (SELECT count(*) AS n, count(DISTINCT {a}) AS r, count(DISTINCT {b}) AS c FROM cl WHERE {w}) t))"""


@register("chi_square", O.with_clean(_chi_sql("channel", "store") + " UNION ALL " + _chi_sql("channel", "gender")))
def q_chi_square(spark, d):
    cl = clean_sales(spark, d)
    r = H.chi_square(cl, "channel", "store").unionByName(H.chi_square(cl, "channel", "gender"))
    return r.select("test", "variables", sig("statistic").alias("statistic"), "dof", "note")


def _anova_sql(group: str, where: str = "TRUE") -> str:
    return f"""SELECT 'ANOVA' AS test, 'amount por {group}' AS variables,
  {O.sig('CASE WHEN k >= 2 THEN (ssb / (k - 1)) / (ssw / (N - k)) END')} AS statistic,
  CAST(CASE WHEN k >= 2 THEN k - 1 END AS BIGINT) AS df1, CAST(CASE WHEN k >= 2 THEN N - k END AS BIGINT) AS df2
FROM (SELECT sum(n * pow(m - gm, 2)) AS ssb, sum(n * vp) AS ssw, max(NN) AS N, max(k) AS k
      FROM (SELECT {group}, count(*) AS n, avg(amount) AS m, var_pop(amount) AS vp FROM cl
            WHERE {group} IS NOT NULL AND amount IS NOT NULL AND {where} GROUP BY {group} HAVING count(*) > 1) g,
           (SELECT sum(n) AS NN, count(*) AS k, sum(n * m) / sum(n) AS gm FROM
             (SELECT count(*) AS n, avg(amount) AS m FROM cl WHERE {group} IS NOT NULL AND amount IS NOT NULL AND {where}
              GROUP BY {group} HAVING count(*) > 1)) t)"""


def _kruskal_sql(group: str, where: str = "TRUE") -> str:
    return f"""SELECT 'Kruskal-Wallis' AS test, 'amount por {group}' AS variables,
  {O.sig('CASE WHEN k >= 2 THEN (12.0 / (N * (N + 1)) * q - 3 * (N + 1)) / (1 - tt / (pow(N, 3) - N)) END')} AS statistic,
  CAST(CASE WHEN k >= 2 THEN k - 1 END AS BIGINT) AS dof
FROM (
  WITH x AS (SELECT {group} AS g, amount AS v FROM cl WHERE {group} IS NOT NULL AND amount IS NOT NULL AND {where}
             AND {group} IN (SELECT {group} FROM cl WHERE {group} IS NOT NULL AND amount IS NOT NULL AND {where}
                             GROUP BY {group} HAVING count(*) > 1)),
  r AS (SELECT g, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS rk FROM x),
  per AS (SELECT g, count(*) AS ng, sum(rk) AS rs FROM r GROUP BY g)
  SELECT CAST(sum(ng) AS DOUBLE) AS N, count(*) AS k, sum(rs * rs / ng) AS q,
         (SELECT sum(pow(t, 3) - t) FROM (SELECT CAST(count(*) AS DOUBLE) AS t FROM x GROUP BY v)) AS tt FROM per)"""


@register("anova", O.with_clean(_anova_sql("channel") + " UNION ALL " + _anova_sql("store")))
def q_anova(spark, d):
    cl = clean_sales(spark, d)
    r = H.anova(cl, "channel", "amount").unionByName(H.anova(cl, "store", "amount"))
    return r.select("test", "variables", sig("statistic").alias("statistic"), "df1", "df2")


@register("kruskal", O.with_clean(_kruskal_sql("channel") + " UNION ALL " + _kruskal_sql("store")))
def q_kruskal(spark, d):
    cl = clean_sales(spark, d)
    r = H.kruskal(cl, "channel", "amount").unionByName(H.kruskal(cl, "store", "amount"))
    return r.select("test", "variables", sig("statistic").alias("statistic"), "dof")


def _welch_sql(group: str, g1: str, g2: str) -> str:
    a, b = "(v1 / n1)", "(v2 / n2)"
    return f"""SELECT 'amount: {g1.strip("'")} vs {g2.strip("'")}' AS variables, n1, n2,
  {O.sig(f'CASE WHEN n1 > 1 AND n2 > 1 THEN (m1 - m2) / sqrt({a} + {b}) END')} AS statistic,
  {O.sig(f'CASE WHEN n1 > 1 AND n2 > 1 THEN pow({a} + {b}, 2) / (pow({a}, 2) / (n1 - 1) + pow({b}, 2) / (n2 - 1)) END')} AS dof
FROM (SELECT count(*) FILTER (WHERE {group} = {g1}) AS n1, count(*) FILTER (WHERE {group} = {g2}) AS n2,
             avg(amount) FILTER (WHERE {group} = {g1}) AS m1, avg(amount) FILTER (WHERE {group} = {g2}) AS m2,
             var_samp(amount) FILTER (WHERE {group} = {g1}) AS v1, var_samp(amount) FILTER (WHERE {group} = {g2}) AS v2
      FROM cl WHERE amount IS NOT NULL)"""


def _welch_spark(cl, group, g1, g2):
    w = H.welch_t(cl, group, "amount", g1, g2)
    return w.select("variables", "n1", "n2", sig("statistic").alias("statistic"), sig("dof").alias("dof"))


@register("welch_t", O.with_clean(_welch_sql("gender", "1", "2")))
def q_welch_t(spark, d):
    return _welch_spark(clean_sales(spark, d), "gender", 1, 2)


@register("welch_t_greater", O.with_clean(_welch_sql("channel", "'1-URGENT'", "'2-HIGH'")))
def q_welch_t_greater(spark, d):
    return _welch_spark(clean_sales(spark, d), "channel", "1-URGENT", "2-HIGH")


def _mw_sql(group: str, g1: str, g2: str, label: str, src: str = "cl", value: str = "amount") -> str:
    return f"""SELECT '{label}' AS variables, n1, n2, {O.sig('u1')} AS statistic, {O.sig('mu')} AS mu,
  {O.sig('sigma')} AS sigma, {O.sig('(greatest(u1, n1 * n2 - u1) - mu - 0.5) / sigma')} AS z_two_sided,
  {O.sig('(u1 - mu - 0.5) / sigma')} AS z_greater
FROM (SELECT n1, n2, r1 - n1 * (n1 + 1) / 2.0 AS u1, n1 * n2 / 2.0 AS mu,
             sqrt(n1 * n2 / 12.0 * ((n1 + n2 + 1) - tt / ((n1 + n2) * (n1 + n2 - 1)))) AS sigma
      FROM (
        WITH x AS (SELECT {group} AS g, {value} AS v FROM {src} WHERE {value} IS NOT NULL AND {group} IN ({g1}, {g2})),
        r AS (SELECT g, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS rk FROM x)
        SELECT CAST(count(*) FILTER (WHERE g = {g1}) AS DOUBLE) AS n1, CAST(count(*) FILTER (WHERE g = {g2}) AS DOUBLE) AS n2,
               sum(rk) FILTER (WHERE g = {g1}) AS r1,
               (SELECT sum(pow(t, 3) - t) FROM (SELECT CAST(count(*) AS DOUBLE) AS t FROM x GROUP BY v)) AS tt
        FROM r))"""


def _mw_spark(df, group, g1, g2, label, value="amount"):
    m = H.mann_whitney(df, group, value, g1, g2, label)
    return m.select("variables", F.col("n1").cast("double").alias("n1"), F.col("n2").cast("double").alias("n2"),
                    *[sig(c).alias(c) for c in ("statistic", "mu", "sigma", "z_two_sided", "z_greater")])


@register("mann_whitney", O.with_clean(_mw_sql("gender", "1", "2", "amount: 1 vs 2") + " UNION ALL " +
                                       _mw_sql("channel", "'1-URGENT'", "'2-HIGH'", "amount: 1-URGENT vs 2-HIGH")))
def q_mann_whitney(spark, d):
    cl = clean_sales(spark, d)
    return (_mw_spark(cl, "gender", 1, 2, "amount: 1 vs 2")
            .unionByName(_mw_spark(cl, "channel", "1-URGENT", "2-HIGH", "amount: 1-URGENT vs 2-HIGH")))


@register("jarque_bera", O.with_clean(f"""
SELECT n, {O.sig('n / 6.0 * (pow(m3 / pow(m2, 1.5), 2) + pow(m4 / pow(m2, 2) - 3, 2) / 4.0)')} AS statistic
FROM (SELECT count(*) AS n, avg(pow(amount - mu, 2)) AS m2, avg(pow(amount - mu, 3)) AS m3, avg(pow(amount - mu, 4)) AS m4
      FROM cl, (SELECT avg(amount) AS mu FROM cl WHERE amount IS NOT NULL) WHERE amount IS NOT NULL)"""))
def q_jarque_bera(spark, d):
    j = H.jarque_bera(clean_sales(spark, d), "amount")
    return j.select("n", sig("statistic").alias("statistic"))


@register("simple_ols", O.with_clean(f"""
SELECT {O.sig('regr_slope(units, discount)')} AS slope, {O.sig('regr_intercept(units, discount)')} AS intercept,
       {O.sig('regr_r2(units, discount)')} AS r2, regr_count(units, discount) AS n,
       {O.sig('regr_slope(units, discount) / sqrt((regr_syy(units, discount) - pow(regr_sxy(units, discount), 2) / regr_sxx(units, discount)) / (regr_count(units, discount) - 2) / regr_sxx(units, discount))')} AS t_slope
FROM cl"""))
def q_simple_ols(spark, d):
    o = H.simple_ols(clean_sales(spark, d), "units", "discount")
    return o.select(sig("slope").alias("slope"), sig("intercept").alias("intercept"), sig("r2").alias("r2"),
                    "n", sig("t_slope").alias("t_slope"))


def _missing_pattern_sql() -> str:
    parts = []
    for col in ("discount", "birth_date"):
        src = f"(SELECT *, {col} IS NULL AS miss FROM sv)"
        for v in [c for c in MI.NUMERIC if c != col]:
            parts.append(f"SELECT '{col}' AS column_name, '{v}' AS observed_variable, 'Mann-Whitney' AS test, "
                         f"statistic, CAST(NULL AS BIGINT) AS dof FROM ({_mw_sql('miss', 'true', 'false', 'x', src, v)}) "
                         f"WHERE n1 >= 3 AND n2 >= 3")
        chi = _chi_sql("miss", "channel").replace("FROM cl", f"FROM {src}")
        parts.append(f"SELECT '{col}' AS column_name, 'channel' AS observed_variable, 'Chi-cuadrado' AS test, "
                     f"statistic, dof FROM ({chi})")
    return " UNION ALL ".join(parts)


@register("missing_pattern", O.with_sales(_missing_pattern_sql()))
def q_missing_pattern(spark, d):
    found = MI.missing_patterns(sales(spark, d).select(*_SV_COLS))
    return found.select("column_name", "observed_variable", "test", sig("statistic").alias("statistic"), "dof")


# --------------------------------------------------------------------------- time series

_DAILY_SQL = "SELECT CAST(ts AS DATE) AS day, sum(amount) AS amount FROM cl WHERE ts IS NOT NULL GROUP BY 1"


def _daily(spark, d):
    return PR.daily_sales(clean_sales(spark, d))


@register("daily_filled", O.with_clean(f"""
SELECT CAST(g.day AS DATE) AS day, {O.sig('coalesce(s.amount, 0.0)')} AS amount
FROM (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS day FROM ({_DAILY_SQL})) g
LEFT JOIN ({_DAILY_SQL}) s ON s.day = CAST(g.day AS DATE)"""))
def q_daily_filled(spark, d):
    return TS.fill_days(_daily(spark, d)).select("day", sig("amount").alias("amount"))


@register("seasonal_decompose", O.with_clean(f"""
WITH f AS (SELECT CAST(g.day AS DATE) AS day, coalesce(s.amount, 0.0) AS x
           FROM (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS day FROM ({_DAILY_SQL})) g
           LEFT JOIN ({_DAILY_SQL}) s ON s.day = CAST(g.day AS DATE)),
t AS (SELECT day, x, datediff('day', (SELECT min(day) FROM f), day) AS t,
             CASE WHEN count(x) OVER w = 7 THEN avg(x) OVER w END AS trend
      FROM f WINDOW w AS (ORDER BY day ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
pm AS (SELECT t % 7 AS pos, avg(x - trend) AS pm FROM t WHERE trend IS NOT NULL GROUP BY 1),
se AS (SELECT pos, pm - (SELECT avg(pm) FROM pm) AS seasonal FROM pm)
SELECT day, {O.sig('x')} AS observed, {O.sig('trend')} AS trend, {O.sig('seasonal', 9)} AS seasonal,
       {O.sig('x - trend - seasonal', 9)} AS resid
FROM t LEFT JOIN se ON se.pos = t.t % 7"""))
def q_seasonal_decompose(spark, d):
    s = TS.seasonal_decompose(_daily(spark, d))
    return s.select("day", sig("observed").alias("observed"), sig("trend").alias("trend"),
                    sig("seasonal", 9).alias("seasonal"), sig("resid", 9).alias("resid"))


@register("acf", O.with_clean(f"""
WITH s AS (SELECT day, amount AS x, row_number() OVER (ORDER BY day) - 1 AS t FROM ({_DAILY_SQL})),
st AS (SELECT count(*) AS n, avg(x) AS mu FROM s),
lags AS (SELECT unnest(range(0, CAST(least(30, greatest(1, n // 2 - 1)) AS BIGINT) + 1)) AS lag FROM st),
c AS (SELECT t, x - mu AS d FROM s, st),
cov AS (SELECT lag, sum(u.d * v.d) AS num FROM lags, c u JOIN c v ON v.t = u.t + lag GROUP BY lag),
a AS (SELECT lag, num / (SELECT num FROM cov WHERE lag = 0) AS acf FROM cov)
SELECT lag, {O.sig('acf', 9)} AS acf,
  {O.sig('CASE WHEN lag > 0 THEN 1.959963984540054 * sqrt((1 + 2 * coalesce(sum(CASE WHEN lag > 0 THEN acf * acf ELSE 0.0 END) OVER (ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) / (SELECT n FROM st)) END', 9)} AS band
FROM a"""))
def q_acf(spark, d):
    a = TS.acf(_daily(spark, d))
    return a.select(F.col("lag").cast("bigint").alias("lag"), sig("acf", 9).alias("acf"), sig("band", 9).alias("band"))


@register("temporal_status", O.with_clean(f"""
SELECT count(*) AS days_observed,
  CASE WHEN count(*) >= 14 THEN 'generada' ELSE 'no_generada: se requieren al menos 14 dias' END AS decomposition,
  CASE WHEN count(*) >= 10 THEN 'generada' ELSE 'no_generada: se requieren al menos 10 dias' END AS acf_pacf
FROM ({_DAILY_SQL})"""))
def q_temporal_status(spark, d):
    return TS.temporal_status(_daily(spark, d))


@register("pacf")
def q_pacf(spark, d):
    return TS.pacf(TS.acf(_daily(spark, d)))


# --------------------------------------------------------------------------- reports, models, stream (rows-only)

from salescope.plans import reports as RP  # noqa: E402
from salescope.session import checkpoint_dir  # noqa: E402

# Boosting rounds of the original (whole-table model; per-period model).
GBT_ITERS_QUERY = 180
GBT_ITERS_PERIOD = 100
_DIAG: dict = {}


def _diag(spark, d):
    key = (spark.sparkContext.applicationId, d, data_version(spark, d))
    if key not in _DIAG:
        _DIAG[key] = RP.linear_diagnostics(clean_sales(spark, d))
    return _DIAG[key]


@register("spearman_pvalues")
def q_spearman_pvalues(spark, d):
    return H.with_spearman_pvalues(H.spearman_pairs(clean_sales(spark, d), _PAIRS))


@register("normality")
def q_normality(spark, d):
    return RP.normality(clean_sales(spark, d))


@register("qq_points")
def q_qq_points(spark, d):
    return RP.qq_points(_diag(spark, d)["res"], "resid")


@register("ols_summary")
def q_ols_summary(spark, d):
    fit = _diag(spark, d)["fit"]
    return spark.createDataFrame(fit["coefficients"], "variable string, coefficient double, std_error double, "
                                                      "t double, p_value double, ci_low double, ci_high double")


@register("vif")
def q_vif(spark, d):
    return spark.createDataFrame(_diag(spark, d)["vif"], "variable string, vif double")


@register("breusch_pagan")
def q_breusch_pagan(spark, d):
    bp = _diag(spark, d)["bp"]
    return spark.createDataFrame([(bp["lm_stat"], bp["lm_p_value"], bp["f_stat"], bp["f_p_value"])],
                                 "lm_stat double, lm_p_value double, f_stat double, f_p_value double")


@register("linear_report")
def q_linear_report(spark, d):
    return RP.linear_report(spark, _diag(spark, d))


@register("regression_metrics")
def q_regression_metrics(spark, d):
    return M.regression_metrics(_diag(spark, d)["scored"])


@register("residual_table")
def q_residual_table(spark, d):
    s = _diag(spark, d)["scored"]
    return s.withColumn("residual", F.col("actual") - F.col("predicted"))


@register("gbt_metrics")
def q_gbt_metrics(spark, d):
    return RP.boosted_metrics(clean_sales(spark, d), GBT_ITERS_QUERY, M.MIN_BOOSTED_ROWS) \
        .withColumn("model", F.lit("HistGradientBoostingRegressor"))


@register("period_model")
def q_period_model(spark, d):
    cl = PR.period(clean_sales(spark, d, by_month=True), *PERIOD).drop(PR.MONTH)
    return RP.boosted_metrics(cl, GBT_ITERS_PERIOD, M.MIN_PERIOD_ROWS)


_REQUIRED_SQL = " AND ".join(f"{c} IS NOT NULL" for c in M.MODEL_REQUIRED)


@register("not_trained", O.with_clean(f"""
SELECT store, CAST(ts AS DATE) AS day, count(*) FILTER (WHERE {_REQUIRED_SQL}) AS n,
  CASE WHEN count(*) FILTER (WHERE {_REQUIRED_SQL}) < {M.MIN_PERIOD_ROWS}
    THEN 'No entrenado: se requieren al menos {M.MIN_PERIOD_ROWS} registros completos.' END AS note
FROM cl GROUP BY 1, 2"""))
def q_not_trained(spark, d):
    cl = clean_sales(spark, d).withColumn("day", F.to_date("ts"))
    return M.trainable(cl, ["store", "day"], M.MODEL_REQUIRED, M.MIN_PERIOD_ROWS)


@register("hypothesis_suite")
def q_hypothesis_suite(spark, d):
    return RP.hypothesis_suite(clean_sales(spark, d), "1-URGENT", "2-HIGH")


@register("association_suite")
def q_association_suite(spark, d):
    return RP.association_suite(clean_sales(spark, d))


def _part(sql: str, columns: str) -> str:
    return f"SELECT {columns} FROM ({sql})"


_SUITE_COLS = "test, variables, statistic"


@register("association_statistics", O.with_clean(" UNION ALL ".join([
    _part(_chi_sql("channel", "store"), f"{_SUITE_COLS}, dof"), _part(_chi_sql("channel", "gender"), f"{_SUITE_COLS}, dof"),
    _part(_spearman_sql(_TARGET_PAIRS), "'Spearman', var_a || ' vs ' || var_b, rho, NULL"),
    *(_part(_anova_sql(g), f"{_SUITE_COLS}, df1") for g in ("channel", "store")),
    *(_part(_kruskal_sql(g), f"{_SUITE_COLS}, dof") for g in ("channel", "store"))])))
def q_association_statistics(spark, d):
    a = RP.association_suite(clean_sales(spark, d))
    return a.select("test", "variables", sig("statistic").alias("statistic"), "dof")


def _suite_part(name: str, test: str, sql: str, column: str = "statistic") -> str:
    return f"SELECT '{name}' AS name, '{test}' AS test, {column} AS statistic FROM ({sql})"


@register("hypothesis_statistics", O.with_clean(" UNION ALL ".join([
    _suite_part("H0_APP_WEB", "Welch t-test unilateral", _welch_sql("channel", "'1-URGENT'", "'2-HIGH'")),
    _suite_part("H0_APP_WEB", "Mann-Whitney unilateral", _mw_sql("channel", "'1-URGENT'", "'2-HIGH'", "x")),
    _suite_part("H0_DESCUENTO_UNIDADES", "Regresion lineal simple",
                f"SELECT {O.sig('regr_slope(units, discount)')} AS statistic FROM cl"),
    _suite_part("H1", "ANOVA", _anova_sql("channel")), _suite_part("H1", "Kruskal-Wallis", _kruskal_sql("channel")),
    _suite_part("H2", "Spearman", _spearman_sql([("discount", "amount")]), "rho"),
    _suite_part("H3", "Spearman", _spearman_sql([("age", "amount")]), "rho"),
    _suite_part("H4", "Welch t-test", _welch_sql("gender", "1", "2")),
    _suite_part("H4", "Mann-Whitney", _mw_sql("gender", "1", "2", "x"))])))
def q_hypothesis_statistics(spark, d):
    h = RP.hypothesis_suite(clean_sales(spark, d), "1-URGENT", "2-HIGH")
    return h.select("name", "test", sig("statistic").alias("statistic"))


_MF_COLS = ["record_no", "amount", "units", "discount", "age", "purchase_frequency", "sku", "gender", "store"]


@register("model_frame", O.with_clean("SELECT " + ", ".join(
    [c if c not in ("discount", "age", "amount") else f"{O.sig(c)} AS {c}" for c in _MF_COLS] +
    ["CAST(month(ts) AS INTEGER) AS month", "CAST(isodow(ts) - 1 AS INTEGER) AS weekday", "CAST(hour(ts) AS INTEGER) AS hour"] +
    [f"CAST(CASE WHEN channel = '{v}' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS \"channel_{v}\"" for v in _LEVELS[1:]]) + " FROM cl"))
def q_model_frame(spark, d):
    mf = M.model_frame(clean_sales(spark, d))
    return mf.select(*[sig(c).alias(c) if c in ("discount", "age", "amount") else F.col(c) for c in mf.columns])


@register("json_report")
def q_json_report(spark, d):
    r = PR.descriptive_stats(clean_sales(spark, d))
    return r.select(F.to_json(F.struct(*r.columns)).alias("json"))


@register("stream_validate")
def q_stream_validate(spark, d):
    """Text files of the raw lines, each with its heading, through the stream, a few files a batch."""
    from salescope.streaming.validate_stream import validate_stream
    import uuid
    base = f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex[:8]}"
    lines = raw_lines(spark, d).select("line", F.pmod("record_no", F.lit(4)).alias("file"))
    # Four files of a small table, four for each file of the raw text of a large one; half of them are a batch.
    parts = text_parts(spark, d)
    write_dealt_lines(lines.coalesce(parts), f"{base}/in", "file", [*range(4)], ";".join(RAW_FIELDS), compression="lz4")
    return validate_stream(spark, f"{base}/in/*", f"{base}/out", f"{base}/chk", max_files_per_trigger=2 * parts)


@register("stream_totals", ORACLE["validation_totals"])
def q_stream_totals(spark, d):
    """The totals of all batches of the stream: those of the batch validation."""
    columns = ("read", "valid", "discarded", "discarded_age")
    return q_stream_validate(spark, d).agg(*[F.sum(c).cast("bigint").alias(c) for c in columns])
