"""Row-level expressions. Everything here stays inside whole-stage code generation."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86400
DAY_MICROS = 86_400_000_000


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: Column | str, den: Column | str) -> Column:
    """Division that yields NULL for a zero divisor."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def ratio_or_zero(num: Column | str, den: Column | str) -> Column:
    return F.coalesce(ratio(num, den), F.lit(0.0))


def divisor_or_one(c: Column | str) -> Column:
    """Replace a zero divisor with one."""
    c = col(c)
    return F.when(c == 0, F.lit(1.0)).otherwise(c.cast("double"))


def clip(c: Column | str, lo: Column | float | None = None, hi: Column | float | None = None) -> Column:
    """Bound a value on either side; NULL stays NULL."""
    value = col(c)
    out = value
    if hi is not None:
        hi = hi if isinstance(hi, Column) else F.lit(hi)
        out = F.least(out, hi)
    if lo is not None:
        lo = lo if isinstance(lo, Column) else F.lit(lo)
        out = F.greatest(out, lo)
    return F.when(value.isNotNull(), out)


def whole_days(later: Column | str, earlier: Column | str) -> Column:
    """Completed 24-hour days between two instants (a time difference's day part, not a date difference)."""
    seconds = F.unix_micros(col(later)) - F.unix_micros(col(earlier))
    return F.floor(seconds / F.lit(DAY_MICROS)).cast("bigint")


def hours_between(later: Column | str, earlier: Column | str) -> Column:
    return (F.unix_micros(col(later)) - F.unix_micros(col(earlier))) / F.lit(3_600_000_000.0)


def signed_log(c: Column | str) -> Column:
    value = col(c)
    return F.log1p(F.abs(value)) * F.signum(value)


def logistic(c: Column | str) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col(c)))


def bands(c: Column | str, steps: list[tuple[float, object]], otherwise: object, *, closed: str = "right") -> Column:
    """Step function: first ``(limit, label)`` whose limit is not below the value wins.

    ``closed='right'`` tests ``value <= limit``; ``closed='left'`` tests ``value < limit``.
    """
    value = col(c)
    out = None
    for limit, label in steps:
        test = value <= F.lit(limit) if closed == "right" else value < F.lit(limit)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return F.when(value.isNotNull(), out.otherwise(F.lit(otherwise)))


def cut_left_open(c: Column | str, edges: list[float], labels: list[str]) -> Column:
    """Fixed bins ``(a, b]``; values outside every bin get NULL."""
    value = col(c)
    out = F.lit(None).cast("string")
    for lo, hi, label in reversed(list(zip(edges[:-1], edges[1:], labels))):
        test = value > F.lit(float(lo))
        if hi != float("inf"):
            test = test & (value <= F.lit(float(hi)))
        out = F.when(test, F.lit(label)).otherwise(out)
    return out


def equal_width_bin(c: Column | str, lo: Column, hi: Column, n: int) -> Column:
    """1-based index among ``n`` equal bins; the maximum falls in the last one."""
    value = col(c).cast("double")
    pos = F.floor(F.try_divide(value - lo, hi - lo) * F.lit(float(n))) + 1
    return F.when(value.isNotNull(), F.coalesce(F.least(pos, F.lit(n)), F.lit(1))).cast("int")


def portable_bucket(key: Column | str) -> Column:
    """0..2^32-1 number from the MD5 of a key; equal in every engine, used for splits and samples."""
    digest = F.md5(col(key).cast("string"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


# --- time parts -------------------------------------------------------------------------------

def time_of_day(hour: Column | str) -> Column:
    h = col(hour)
    return (
        F.when((h >= 5) & (h < 12), "morning")
        .when((h >= 12) & (h < 17), "afternoon")
        .when((h >= 17) & (h < 21), "evening")
        .otherwise("night")
    )


def season(month: Column | str) -> Column:
    m = col(month)
    return (
        F.when(m.isin(12, 1, 2), "winter")
        .when(m.isin(3, 4, 5), "spring")
        .when(m.isin(6, 7, 8), "summer")
        .otherwise("fall")
    )


def weekend(ts: Column | str) -> Column:
    return (F.weekday(col(ts)) >= 5).cast("int")


def business_hours(ts: Column | str) -> Column:
    return F.hour(col(ts)).between(9, 17).cast("int")


# --- moments ----------------------------------------------------------------------------------

def adjusted_skew(c: Column | str) -> Column:
    """Bias-adjusted skewness aggregate: NULL below three values, 0 without spread."""
    x = col(c).cast("double")
    n = F.count(x).cast("double")
    g1 = F.skewness(x)
    factor = F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    return F.when(F.count(x) < 3, F.lit(None)).when(F.min(x) == F.max(x), F.lit(0.0)).otherwise(factor * g1)


def adjusted_kurtosis(c: Column | str) -> Column:
    """Bias-adjusted excess kurtosis aggregate: NULL below four values, 0 without spread."""
    x = col(c).cast("double")
    n = F.count(x).cast("double")
    g2 = F.kurtosis(x)
    scaled = F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * g2 + 6)
    return F.when(F.count(x) < 4, F.lit(None)).when(F.min(x) == F.max(x), F.lit(0.0)).otherwise(scaled)


def corr(a: Column | str, b: Column | str) -> Column:
    """Pearson correlation over rows where both sides are present; NULL without spread."""
    x, y = col(a).cast("double"), col(b).cast("double")
    sx = F.stddev_pop(F.when(y.isNotNull(), x))
    sy = F.stddev_pop(F.when(x.isNotNull(), y))
    return F.try_divide(F.covar_pop(x, y), sx * sy)


def normal_p(z: Column | str) -> Column:
    """Two-sided tail of the standard normal law beyond ``|z|``.

    A series of positive terms near the middle, a continued fraction from its far end in the tail.
    """
    x = F.abs(col(z)) / F.lit(math.sqrt(2.0))
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(60)),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")),
        lambda s, k: F.struct((s["term"] * x * x * 2.0 / (k * 2.0 + 1.0)).alias("term"), (s["total"] + s["term"] * x * x * 2.0 / (k * 2.0 + 1.0)).alias("total")),
        lambda s: s["total"],
    )
    near = 1.0 - terms * x * F.exp(-x * x) * F.lit(2.0 / math.sqrt(math.pi))
    fraction = F.aggregate(F.sequence(F.lit(60), F.lit(1)), x, lambda f, k: x + k / 2.0 / f)
    far = F.exp(-x * x) / (fraction * F.lit(math.sqrt(math.pi)))
    return F.when(x < 2.0, near).otherwise(far)


#: Degrees of freedom from which Student's law is read as a normal one of a transformed value.
MANY_DEGREES = 20_000


def correlation_p(r: Column | str, n: Column | str) -> Column:
    """Two-sided p-value of a correlation ``r`` of ``n`` pairs under Student's law with ``n - 2`` degrees of freedom.

    It is the regularised incomplete beta function at 1 - r**2 with parameters (n - 2) / 2 and 1 / 2, by its continued
    fraction on the side where that converges. NULL below three pairs.
    """
    v, degrees = col(r), (col(n) - 2).cast("double")
    a = degrees / 2.0
    rr = F.least(v * v, F.lit(1.0))
    x = 1.0 - rr
    # gamma(a + 1/2) / gamma(a), from its series 16 places further up
    up = a + 16.0
    step = F.sqrt(up) * (1.0 - 1.0 / (up * 8.0) + 1.0 / (up * up * 128.0) + 5.0 / (up * up * up * 1024.0) - 21.0 / (up * up * up * up * 32768.0))
    gammas = F.aggregate(F.sequence(F.lit(0), F.lit(15)), step, lambda g, k: g * (a + k) / (a + k + 0.5))
    front = F.pow(x, a) * F.sqrt(rr) * gammas / F.lit(math.sqrt(math.pi))
    left = x < (a + 1.0) / (a + 2.5)
    p, q, at = F.when(left, a).otherwise(0.5), F.when(left, 0.5).otherwise(a), F.when(left, x).otherwise(rr)
    tail = front * _beta_fraction(p, q, at) / p
    # for many degrees: the square of the normal value is the logarithm of the likelihood ratio, with a small correction
    z = F.sqrt(-F.log(x) * degrees) * (degrees * 8.0 + 1.0) / (degrees * 8.0 + 3.0)
    exact = F.when(left, tail).otherwise(1.0 - tail)
    known = F.when(degrees >= MANY_DEGREES, F.when(x > 0, normal_p(z)).otherwise(0.0)).otherwise(F.when(rr == 0, 1.0).when(x == 0, 0.0).otherwise(exact))
    return F.when((degrees >= 1) & v.isNotNull(), F.least(F.greatest(known, F.lit(0.0)), F.lit(1.0)))


def _beta_fraction(a: Column, b: Column, x: Column, steps: int = 300) -> Column:
    """Continued fraction of the incomplete beta function, two terms a step."""
    tiny = F.lit(1e-300)
    safe = lambda v: F.when(F.abs(v) < tiny, tiny).otherwise(v)
    d0 = 1.0 / safe(1.0 - (a + b) * x / (a + 1.0))
    start = F.struct(F.lit(1.0).alias("c"), d0.alias("d"), d0.alias("h"), F.lit(False).alias("done"))

    def half(s: Column, term: Column) -> Column:
        d = 1.0 / safe(1.0 + term * s["d"])
        c = safe(1.0 + term / s["c"])
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * d * c).alias("h"), (F.abs(d * c - 1.0) < 1e-15).alias("done"))

    def even(s: Column, m: Column) -> Column:
        return F.when(s["done"], s).otherwise(half(s, m * (b - m) * x / ((a + m * 2.0 - 1.0) * (a + m * 2.0))))

    def odd(s: Column, m: Column) -> Column:
        return F.when(s["done"], s).otherwise(half(s, -(a + m) * (a + b + m) * x / ((a + m * 2.0) * (a + m * 2.0 + 1.0))))

    # whole steps are odd entries of the list, half steps even ones
    both = F.transform(F.sequence(F.lit(2), F.lit(2 * steps + 1)), lambda i: F.struct((i % 2 == 0).alias("even"), F.floor(i / 2).cast("double").alias("m")))
    return F.aggregate(both, start, lambda s, i: F.when(i["even"], even(s, i["m"])).otherwise(odd(s, i["m"])), lambda s: s["h"])
