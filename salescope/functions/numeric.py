"""Small numeric Column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """pandas treats NaN as missing; Spark does not.  Map NaN → NULL."""
    c = _col(c)
    return F.when(~F.isnan(c), c)


def sig(c, digits: int = 11) -> Column:
    """Round to ``digits`` significant digits (report/oracle stability).

    Sums computed in a different order differ in the last bits; rounding to a
    fixed number of significant digits makes results comparable across engines.
    """
    c = _col(c).cast("double")
    scale = F.lit(digits - 1) - F.floor(F.log10(F.abs(c)))
    p = F.pow(F.lit(10.0), scale)
    return (F.when(c.isNull() | F.isnan(c) | (c == 0) | (F.abs(c) == float("inf")), c)
            .otherwise(F.round(c * p) / p))


def skew_corrected(g1, n) -> Column:
    """Bias-corrected sample skewness G1 from the population value g1 (pandas ``skew``)."""
    n = _col(n).cast("double")
    return F.when(n >= 3, _col(g1) * F.sqrt(n * (n - 1)) / (n - 2))


def kurt_corrected(g2, n) -> Column:
    """Bias-corrected excess kurtosis G2 from the population excess g2 (pandas ``kurt``)."""
    n = _col(n).cast("double")
    return F.when(n >= 4, ((n + 1) * _col(g2) + 6) * (n - 1) / ((n - 2) * (n - 3)))


def verdict(p, alpha: float = 0.05) -> Column:
    """Decision text: NULL → not evaluable; p < alpha → reject H0; else do not reject."""
    p = _col(p)
    return (F.when(p.isNull() | F.isnan(p), F.lit("No evaluable"))
            .when(p < alpha, F.lit("Se rechaza H0"))
            .otherwise(F.lit("No se rechaza H0")))
