"""The normal distribution and its inverse as compiled expressions.

Spark has no error function, and a Python function per value is too slow for a
value per row.  Both functions are smooth after a change of variable, so each is
a table of short polynomials over equal pieces of that variable, made here from
the scalar functions of ``dist``; an expression picks the piece and evaluates its
polynomial inside the generated code.  The steps are columns of their own, so that none is computed twice.
Relative errors are below 1e-11.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.functions.dist import norm_ppf

_DEGREE = 9


def _table(fn, low: float, high: float, pieces: int) -> list[float]:
    """Coefficients of the interpolating polynomials of ``fn``, by piece and power of the place in it (-1 to 1)."""
    nodes = np.cos(np.pi * (np.arange(_DEGREE + 1) + 0.5) / (_DEGREE + 1))
    width, out = (high - low) / pieces, []
    for k in range(pieces):
        values = [fn(low + width * (k + (u + 1) / 2)) for u in nodes]
        powers = np.polynomial.chebyshev.cheb2poly(np.polynomial.chebyshev.chebfit(nodes, values, _DEGREE)).tolist()
        out += powers + [0.0] * (_DEGREE + 1 - len(powers))  # numpy leaves out last coefficients that are exactly 0
    return out


def _evaluated(df: DataFrame, x: Column, table: list[float], low: float, high: float, out: str) -> DataFrame:
    """``df`` with the table's function of ``x`` as column ``out``."""
    pieces = len(table) // (_DEGREE + 1)
    # One constant array a power: folded into the generated code's references.
    powers = [F.expr("array(" + ", ".join(f"{c!r}D" for c in table[k::_DEGREE + 1]) + ")") for k in range(_DEGREE + 1)]
    df = df.withColumn("_x", (x - low) * (pieces / (high - low)))
    df = df.withColumn("_piece", F.least(F.greatest(F.floor("_x"), F.lit(0)), F.lit(pieces - 1)).cast("int"))
    df = df.withColumn("_place", (F.col("_x") - F.col("_piece")) * 2 - 1)
    value = F.get(powers[-1], F.col("_piece"))
    for c in powers[-2::-1]:
        value = value * F.col("_place") + F.get(c, F.col("_piece"))
    return df.withColumn(out, value).drop("_x", "_piece", "_place")


def _scaled_tail(t: float) -> float:
    """P(Z > z) / exp(-z**2 / 2) at z = 2 / t - 2."""
    if t <= 0:
        return 0.0
    z = 2 / t - 2
    if z < 5:
        return 0.5 * math.erfc(z / math.sqrt(2)) * math.exp(z * z / 2)
    fraction = z
    for k in range(200, 0, -1):
        fraction = z + k / fraction
    return 1 / fraction / math.sqrt(2 * math.pi)


#: The ranges of the two variables: tails down to 1e-297.
_LEAST_T, _MOST_S, _LEAST_S = 0.04, 37.0, math.sqrt(2 * math.log(2))
_TAIL = _table(_scaled_tail, _LEAST_T, 1.0, 48)
_QUANTILE = _table(lambda s: norm_ppf(math.exp(-s * s / 2)), _LEAST_S, _MOST_S, 96)


def with_sf(df: DataFrame, z: Column, out: str) -> DataFrame:
    """``df`` with P(Z > z)."""
    df = df.withColumn("_z", z).withColumn("_size", F.least(F.abs("_z"), F.lit(38.4)))
    df = _evaluated(df, 2.0 / (F.col("_size") + 2.0), _TAIL, _LEAST_T, 1.0, "_tail")
    tail = F.exp(-F.col("_size") * F.col("_size") / 2) * F.col("_tail")
    return df.withColumn("_tail", tail).withColumn(
        out, F.when(F.col("_z") < 0, 1 - F.col("_tail")).otherwise(F.col("_tail"))).drop("_z", "_size", "_tail")


def with_ppf(df: DataFrame, p: Column, out: str) -> DataFrame:
    """``df`` with the quantile at ``p``, 0 < p < 1."""
    df = df.withColumn("_p", p)
    df = _evaluated(df, F.sqrt(-2.0 * F.ln(F.least(F.col("_p"), 1 - F.col("_p")))), _QUANTILE, _LEAST_S, _MOST_S, "_q")
    return df.withColumn(out, F.when(F.col("_p") < 0.5, F.col("_q")).when(F.col("_p") > 0.5, -F.col("_q"))
                         .otherwise(F.when(F.col("_p").isNotNull(), F.lit(0.0)))).drop("_p", "_q")


def density(z: Column) -> Column:
    return F.exp(-z * z / 2) / math.sqrt(2 * math.pi)
