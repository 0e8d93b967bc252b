"""Missing values: totals, and tests of whether gaps go with what was observed.

For every column with gaps, each numeric variable is compared between rows with
and without the gap (Mann-Whitney) and each category is tested for independence
of it (chi-square).  The table is read once: a row becomes one count per
observed variable, keyed by its value and by the list of columns missing in the
row, and all tests of all columns are derived from these counts together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.functions.dist import sf_chi2_udf
from salescope.operators.hypothesis import mann_whitney_of_counts, with_mw_pvalues
from salescope.session import written

# The observed variables of the original report, and its note.
NUMERIC = ["units", "discount", "amount", "store", "gender"]
CATEGORIES = ["channel"]
MCAR_NOTE = ("Se reportan pruebas simples de asociacion entre indicadores de ausencia y variables observadas. "
             "No corresponde a Little MCAR completo, pero entrega evidencia objetiva para justificar imputaciones.")
#: Rows that either side of a comparison needs.
MIN_ROWS = 3
_TESTS = ["column_name", "observed_variable"]
_OUT = "column_name string, observed_variable string, test string, statistic double, dof long, p_value double"


def is_missing(df: DataFrame, col: str) -> Column:
    gap = F.col(f"`{col}`").isNull()
    return gap | F.isnan(f"`{col}`") if dict(df.dtypes)[col] in ("double", "float") else gap


def missing_summary(df: DataFrame) -> DataFrame:
    """One row: rows, missing values of all columns, columns with gaps, and the note on the tests' limits."""
    found = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(is_missing(df, c)).alias(f"_m{i}") for i, c in enumerate(df.columns)])
    counts = [F.col(f"_m{i}") for i in range(len(df.columns))]
    return found.select("rows", sum(counts, F.lit(0)).cast("long").alias("total_missing"),
                        sum([(c > 0).cast("int") for c in counts], F.lit(0)).cast("int").alias("columns_with_gaps"),
                        F.lit(MCAR_NOTE).alias("note"))


def _counts(df: DataFrame, variables: Sequence[str], gaps: Sequence[str], kind: str) -> DataFrame:
    """(column_name, observed_variable, miss, value, cnt) of every column with gaps and every other variable."""
    stack = ", ".join(f"'{v}', CAST(`{v}` AS {kind})" for v in variables)
    missing = F.array_compact(F.array(*[F.when(is_missing(df, c), F.lit(c)) for c in gaps]))
    long = (df.withColumn("_gaps", missing).selectExpr("_gaps", f"stack({len(variables)}, {stack}) AS (observed_variable, value)")
            .where("value IS NOT NULL" + (" AND NOT isnan(value)" if kind == "DOUBLE" else "")))
    rows = long.groupBy("observed_variable", "value", "_gaps").agg(F.count(F.lit(1)).alias("cnt"))
    return (rows.withColumn("column_name", F.explode(F.array(*map(F.lit, gaps))))
            .where(F.col("column_name") != F.col("observed_variable"))
            .groupBy(*_TESTS, F.array_contains("_gaps", F.col("column_name")).alias("miss"), "value")
            .agg(F.sum("cnt").alias("cnt")))


def chi_square_of_counts(counts: DataFrame, tests: Sequence[str], a: str, b: str) -> DataFrame:
    """One chi-square test of ``a`` and ``b`` for each value of ``tests``, from cells with ``cnt`` rows.

    Needs two values of either; with two of each (one degree of freedom) the
    statistic has Yates' correction.
    """
    tests = list(tests)
    cells = counts.groupBy(*tests, a, b).agg(F.sum("cnt").alias("_o"))
    ra = cells.groupBy(*tests, a).agg(F.sum("_o").alias("_ra"))
    cb = cells.groupBy(*tests, b).agg(F.sum("_o").alias("_cb"))
    one = (ra.groupBy(*tests).agg(F.sum("_ra").alias("_n"), F.count(F.lit(1)).alias("_nr"), F.product("_ra").alias("_pr"))
           .join(cb.groupBy(*tests).agg(F.count(F.lit(1)).alias("_nc"), F.product("_cb").alias("_pc")), tests))
    e = F.col("_ra") * F.col("_cb") / F.col("_n")
    s = (cells.join(ra, [*tests, a]).join(cb, [*tests, b]).join(one, tests).groupBy(*tests, "_n", "_nr", "_nc", "_pr", "_pc")
         .agg(F.sum(F.pow(F.col("_o") - e, 2) / e).alias("_s"), F.sum(e).alias("_se"), F.max(F.abs(F.col("_o") - e)).alias("_d")))
    dof = (F.col("_nr") - 1) * (F.col("_nc") - 1)
    plain = F.col("_s") + F.greatest(F.col("_n") - F.col("_se"), F.lit(0.0))  # empty cells add their expectation
    yates = F.pow(F.greatest(F.col("_d") - 0.5, F.lit(0.0)), 2) * F.try_divide(F.pow(F.col("_n").cast("double"), 3),
                                                                               F.col("_pr") * F.col("_pc"))
    return s.where("_nr >= 2 AND _nc >= 2").select(
        *tests, F.when(dof == 1, yates).otherwise(plain).alias("statistic"), dof.cast("long").alias("dof"))


def missing_patterns(df: DataFrame, numeric: Sequence[str] = NUMERIC, categories: Sequence[str] = CATEGORIES,
                     columns: Sequence[str] | None = None) -> DataFrame:
    """One row a test that can be made: column with gaps, observed variable, test, statistic, dof, p-value.

    Columns without a gap, or without any value, have no tests.  A comparison
    needs ``MIN_ROWS`` rows on either side, and some variety on one of them.
    """
    columns = list(columns or df.columns)
    seen = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(is_missing(df, c)).alias(f"_m{i}") for i, c in enumerate(columns)]).first()
    gaps = [c for i, c in enumerate(columns) if 0 < seen[f"_m{i}"] < seen["n"]]
    numeric = [v for v in numeric if v in df.columns]
    categories = [v for v in categories if v in df.columns]
    out = df.sparkSession.createDataFrame([], _OUT)
    if not gaps:
        return out
    if numeric:
        counts = written(_counts(df, numeric, gaps, "DOUBLE"), "gap-counts")
        varied = (counts.groupBy(*_TESTS).agg(
            *[F.sum(F.when(F.col("miss") == side, F.col("cnt"))).alias(f"_n{side}") for side in (True, False)],
            *[F.count_if(F.col("miss") == side).alias(f"_d{side}") for side in (True, False)])
            .where(f"_nTrue >= {MIN_ROWS} AND _nFalse >= {MIN_ROWS} AND (_dTrue > 1 OR _dFalse > 1)").select(*_TESTS))
        mw = with_mw_pvalues(mann_whitney_of_counts(counts.join(varied, _TESTS, "left_semi"), _TESTS, "miss", "value", True))
        out = out.unionByName(mw.where("statistic IS NOT NULL").select(
            *_TESTS, F.lit("Mann-Whitney").alias("test"), "statistic", F.lit(None).cast("long").alias("dof"), "p_value"))
    if categories:
        chi = chi_square_of_counts(_counts(df, categories, gaps, "STRING"), _TESTS, "miss", "value")
        out = out.unionByName(chi.withColumn("test", F.lit("Chi-cuadrado"))
                              .withColumn("p_value", sf_chi2_udf("statistic", F.col("dof").cast("double"))))
    return out
