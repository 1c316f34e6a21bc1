"""Column-expression helpers: pandas-compatible null/NaN/inf handling,
clipping, binning, and bias-corrected moments. All are built-in JVM
expressions (whole-stage codegen); no Python runs per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """pandas has one missing value (NaN); Spark has two. Normalise to null."""
    c = col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def finite_or(c, default=0.0) -> Column:
    """null / NaN / +-inf -> default (pandas ``fillna(d).replace([inf,-inf], d)``)."""
    c = col(c)
    return F.when(c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(INF)), F.lit(default)).otherwise(c)


def clip(c, lo: float, hi: float) -> Column:
    """``np.clip``; null stays null."""
    c = col(c)
    return F.when(c.isNull(), c).otherwise(F.greatest(F.lit(lo), F.least(F.lit(hi), c)))



def flag(cond: Column) -> Column:
    """Boolean condition as 0/1 with null -> 0 (pandas comparison semantics)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def right_closed_bins(c, edges: list[float], labels: list[str], default=None) -> Column:
    """``pd.cut(c, bins=edges, labels=labels)`` (right-closed, lowest excluded):
    values outside every bin (and null) get ``default``."""
    c = col(c)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (c > F.lit(lo)) & (c <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr.otherwise(F.lit(default))


def skew_unbiased(c) -> Column:
    """pandas ``Series.skew()`` (adjusted Fisher-Pearson), from Spark's
    population skewness: g1 * sqrt(n(n-1)) / (n-2); n < 3 -> null."""
    c = col(c)
    n = F.count(c).cast("double")
    return F.when(n >= 3, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def kurt_unbiased(c) -> Column:
    """pandas ``Series.kurtosis()`` (bias-corrected excess kurtosis) from
    Spark's population excess kurtosis g2: (n-1)/((n-2)(n-3)) * ((n+1) g2 + 6)."""
    c = col(c)
    n = F.count(c).cast("double")
    return F.when(n >= 4, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(c) + 6))


def nunique_with_null(c) -> Column:
    """``len(series.unique())``: distinct values with null counted once."""
    c = col(c)
    return F.count_distinct(c) + F.max(F.when(c.isNull(), 1).otherwise(0))


# Coefficients of the published rational approximations to the
# normal quantile (Applied Statistics algorithm AS 241, 16 digits), constant term
# first: numerator and denominator in the middle, in the tails and far out.
QUANTILE_MIDDLE = ((3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
                    4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
                   (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
                    2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3))
QUANTILE_TAIL = ((1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
                  1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
                 (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
                  1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9))
QUANTILE_FAR = ((6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
                 2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
                (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
                 7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15))


def polynomial(x: Column, coefficients: tuple[float, ...]) -> Column:
    """Horner's rule, constant term first."""
    out = F.lit(coefficients[-1])
    for c in coefficients[-2::-1]:
        out = out * x + F.lit(c)
    return out


def normal_quantile(p: Column) -> Column:
    """Inverse of the standard normal distribution function; null outside (0, 1)."""
    q = p - 0.5
    ratio = lambda x, pair: polynomial(x, pair[0]) / polynomial(x, pair[1])
    r = F.sqrt(-F.log(F.least(p, 1 - p)))
    tail = F.when(r <= 5, ratio(r - 1.6, QUANTILE_TAIL)).otherwise(ratio(r - 5, QUANTILE_FAR))
    middle = q * ratio(0.180625 - q * q, QUANTILE_MIDDLE)
    return F.when((p > 0) & (p < 1), F.when(F.abs(q) <= 0.425, middle).otherwise(F.signum(q) * tail))
