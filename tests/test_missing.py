"""Patterns of missing values against one test at a time."""

import math

import numpy as np
from pyspark.sql import functions as F

from salescope.operators import hypothesis as H
from salescope.operators import missing as MI

SCHEMA = "units long, discount double, amount double, store long, gender int, channel string, other string, flat double"


def frame(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        late = bool(rng.random() < 0.3)
        rows.append((int(rng.integers(1, 9)), None if late else float(rng.integers(0, 5)) / 10, float(rng.random() * (2 if late else 1)),
                     None if rng.random() < 0.1 else int(rng.integers(1, 4)), int(rng.integers(1, 3)), ["A", "B", "C"][rng.integers(0, 3)],
                     None if i in (5, 6) else "x", float("nan") if i % 7 == 0 else 1.0))
    return spark.createDataFrame(rows, SCHEMA)


def test_patterns_equal_single_tests(spark):
    df = frame(spark)
    got = {(r["column_name"], r["observed_variable"]): r for r in MI.missing_patterns(df).collect()}
    assert {c for c, _ in got} == {"discount", "store", "other", "flat"}
    # Two rows miss ``other``: too few for a comparison, enough for the table of channels.
    assert [v for c, v in got if c == "other"] == ["channel"]
    for (col, var), r in got.items():
        marked = df.withColumn("_gap", MI.is_missing(df, col))
        if var == "channel":
            want = H.with_chi2_pvalue(H.chi_square(marked, "_gap", "channel")).first()
            assert r["test"] == "Chi-cuadrado" and r["dof"] == want["dof"]
        else:
            want = H.with_mw_pvalues(H.mann_whitney(marked, "_gap", var, True, False)).first()
            assert r["test"] == "Mann-Whitney" and r["dof"] is None
        assert math.isclose(r["statistic"], want["statistic"], rel_tol=1e-10)
        assert math.isclose(r["p_value"], want["p_value"], rel_tol=1e-8)


def test_summary(spark):
    df = frame(spark)
    pdf = df.toPandas()
    r = MI.missing_summary(df).first()
    assert r["rows"] == 400 and r["total_missing"] == int(pdf.isna().sum().sum()) and r["columns_with_gaps"] == 4 and r["note"]


def test_guards(spark):
    df = frame(spark)
    assert MI.missing_patterns(df.select("units", "amount", "channel")).count() == 0
    assert MI.missing_patterns(df.limit(0)).count() == 0
    # Nothing varies on either side: no comparison; one channel only: no table.
    flat = df.withColumn("units", F.lit(3)).withColumn("channel", F.lit("A"))
    found = {(r["column_name"], r["observed_variable"]) for r in MI.missing_patterns(flat).collect()}
    assert not any(v in ("units", "channel") for _, v in found) and ("discount", "amount") in found
    every = df.withColumn("discount", F.lit(None).cast("double"))
    assert not any(r["column_name"] == "discount" for r in MI.missing_patterns(every).collect())


def test_yates_for_two_by_two(spark):
    rows = [(None, "u")] * 10 + [(None, "v")] * 20 + [(1.0, "u")] * 30 + [(1.0, "v")] * 5
    df = spark.createDataFrame(rows, "discount double, channel string")
    got = MI.missing_patterns(df).first()
    want = H.chi_square(df.withColumn("g", F.col("discount").isNull()), "g", "channel").first()
    assert got["dof"] == 1 and math.isclose(got["statistic"], want["statistic"], rel_tol=1e-12)
