"""UDF1: tail probabilities Spark SQL lacks (Student t, standard normal).

They are applied to one-row statistics (the aggregates of ST1/ST2), so the
Arrow-batched pandas UDF sees a handful of values; the heavy work (sums,
ranks) is done by Spark aggregates before it.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Degrees of freedom from which Wallace's transform to a normal tail is used.
LARGE_DOF = 1e6


def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction for the regularized incomplete beta (modified Lentz)."""
    tiny, eps = 1e-300, 3e-16
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        de = d * c
        h *= de
        if abs(de - 1.0) < eps:
            return h
    raise ArithmeticError(f"incomplete beta did not converge at a={a}, b={b}, x={x}")


def betainc(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    bt = math.exp(lbt)
    if x < (a + 1.0) / (a + b + 2.0):
        return bt * _betacf(a, b, x) / a
    return 1.0 - bt * _betacf(b, a, 1.0 - x) / b


def t_two_sided(t: float, dof: float) -> float:
    """P(|T| >= |t|) for Student t with ``dof`` degrees of freedom."""
    if t is None or dof is None or math.isnan(t) or dof <= 0:
        return float("nan")
    if math.isinf(t):
        return 0.0
    if dof >= LARGE_DOF:  # the gamma terms would cancel; here this is off by less than 1 / dof**2
        return math.erfc((8 * dof + 1) / (8 * dof + 3) * math.sqrt(dof * math.log1p(t * t / dof) / 2))
    return betainc(dof / 2.0, 0.5, dof / (dof + t * t))


def normal_two_sided(z: float) -> float:
    if z is None or math.isnan(z):
        return float("nan")
    return math.erfc(abs(z) / math.sqrt(2.0))


@F.pandas_udf(T.DoubleType())
def t_pvalue(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided(a, b) for a, b in zip(t.astype(float), dof.astype(float))], dtype=np.float64)


@F.pandas_udf(T.DoubleType())
def normal_pvalue(z: pd.Series) -> pd.Series:
    return pd.Series([normal_two_sided(a) for a in z.astype(float)], dtype=np.float64)
