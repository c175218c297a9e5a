"""Statistical expressions: scalar columns, aggregates and window forms, all built in."""

from __future__ import annotations

import math

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def share(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def pct(part: Column, whole: Column) -> Column:
    return share(part, whole) * 100


def quantile(x: str, q: float, accuracy: int | None = None) -> Column:
    """Linear interpolation between order statistics; with an accuracy, an approximation of bounded memory."""
    return F.percentile(x, q) if accuracy is None else F.percentile_approx(x, q, accuracy).cast("double")


def iqr(x: str, accuracy: int | None = None) -> Column:
    return quantile(x, 0.75, accuracy) - quantile(x, 0.25, accuracy)


def skewness(x: str) -> Column:
    """Mean cubed z-score with the sample standard deviation; null for fewer than 3 values or no spread."""
    n = F.count(x)
    return F.when((n >= 3) & (F.stddev_samp(x) > 0), F.skewness(x) * F.pow((n - 1) / n, F.lit(1.5)))


def kurtosis(x: str) -> Column:
    """Mean fourth power of the z-score with the sample standard deviation, less 3; null for fewer than 4 values or no spread."""
    n = F.count(x)
    return F.when((n >= 4) & (F.stddev_samp(x) > 0), (F.kurtosis(x) + 3) * F.pow((n - 1) / n, F.lit(2.0)) - 3)


def entropy_of_shares(p: str) -> Column:
    """Aggregate over one row per level: entropy over its maximum; one level has 0, none null."""
    levels = F.count(p)
    return F.when(levels == 1, 0.0).when(levels > 1, F.sum(-F.col(p) * F.ln(p)) / F.ln(levels))


def normalise(x: Column, over: WindowSpec) -> Column:
    """Min-max to [0, 1]: 1 where all that are known are equal, for nulls among them too; 0 where all are null; else a null stays null."""
    low, high = F.min(x).over(over), F.max(x).over(over)
    return F.when(low.isNull(), 0.0).when(high == low, 1.0).otherwise((x - low) / (high - low))


def middle_rank(over_order: WindowSpec, over_peers: WindowSpec) -> Column:
    """Rank with ties averaged. over_peers: partitioned by the ranked value as well."""
    return F.rank().over(over_order) + (F.count(F.lit(1)).over(over_peers) - 1) / 2


def benjamini_hochberg(p: str, *partition: str) -> Column:
    """Adjusted p-values; nulls stay null and don't count."""
    down = Window.partitionBy(*partition).orderBy(F.col(p).desc_nulls_last())
    whole = Window.partitionBy(*partition)
    m = F.count(p).over(whole)
    rank = m - F.row_number().over(down) + 1
    return F.when(F.col(p).isNotNull(), F.least(F.lit(1.0), F.min(F.when(F.col(p).isNotNull(), F.col(p) * m / rank)).over(down.rowsBetween(Window.unboundedPreceding, 0))))


def pairs_of(n: Column) -> Column:
    return n * (n - 1) / 2


def squish(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def duration_text(seconds: Column) -> Column:
    """Seconds, minutes or hours with one digit, such as 1.5 min; null stays null."""
    told = lambda per, unit: F.format_string(f"%.1f {unit}", seconds.cast("double") / per)
    return F.when(seconds < 60, told(1, "s")).when(seconds < 3600, told(60, "min")).when(seconds.isNotNull(), told(3600, "h"))


def _continued_fraction(a: float, b: float, x: float) -> float:
    """Of the incomplete beta function, by Lentz's method."""
    tiny, c, d = 1e-300, 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + num * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + num / (c if abs(c) > tiny else tiny)
            h *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return h


def incomplete_beta(a: float, b: float, x: float) -> float:
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * _continued_fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * _continued_fraction(b, a, 1 - x) / b


def f_tail(f: float, d1: float, d2: float) -> float:
    """P(F > f)."""
    return 1.0 if f <= 0 else incomplete_beta(d2 / 2, d1 / 2, d2 / (d2 + d1 * f))


def chi_square_tail(x: float, df: float) -> float:
    """P(X > x), by the series of the incomplete gamma function below its mean and the continued fraction above."""
    a, x = df / 2, x / 2
    if x <= 0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        for n in range(1, 2000):
            term *= x / (a + n)
            total += term
            if term < total * 1e-16:
                break
        return 1 - front * total
    b, c = x + 1 - a, 1e300
    d = 1 / b
    h = d
    for i in range(1, 2000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or 1e-300)
        c = b + an / c or 1e-300
        h *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return front * h
