"""Scalar column expressions; all stay in the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rounded(x: Column | str, digits: int | None) -> Column:
    """``round_arith``, or ``x`` unchanged when ``digits`` is None."""
    return as_col(x) if digits is None else round_arith(x, digits)


def round_arith(x: Column | str, digits: int) -> Column:
    """Half-up rounding by arithmetic on the binary value, equal in every engine."""
    x, scale = as_col(x), F.lit(float(10**digits))
    return F.signum(x) * F.floor(F.abs(x) * scale + F.lit(0.5)) / scale


def safe_div(n: Column | str, d: Column | str, when_zero: Column | None = None) -> Column:
    """``n / d``; where ``d`` is 0 the result is ``when_zero`` (NULL if not given)."""
    n, d = as_col(n), as_col(d)
    out = F.when(d != 0, n / d)
    return out if when_zero is None else out.when(d == 0, when_zero)


def clamp_min(x: Column | str, low: float) -> Column:
    """``max(low, x)`` that keeps NULL as NULL."""
    x = as_col(x)
    return F.when(x.isNotNull(), F.greatest(F.lit(low), x))


def map_lookup(x: Column | str, table: Mapping, default=None) -> Column:
    """Value of ``x`` in a constant table, else ``default`` (NULL if None)."""
    entries = [F.lit(item) for pair in table.items() for item in pair]
    found = F.try_element_at(F.create_map(*entries), as_col(x))
    return found if default is None else F.coalesce(found, F.lit(default))


def encode_class(x: Column | str, classes: Sequence[str]) -> Column:
    """Position of ``x`` in the persisted class list (alphabetical codes from 0)."""
    return map_lookup(x, {c: i for i, c in enumerate(sorted(classes))})


def jan_first(year: Column | str) -> Column:
    return F.make_date(as_col(year), F.lit(1), F.lit(1))


def mid_season(year: Column | str) -> Column:
    return F.make_date(as_col(year), F.lit(7), F.lit(1))


def year_starts(first: Column | str, periods: int) -> Column:
    """Array of ``periods`` January firsts from year ``first``."""
    start = jan_first(first)
    return F.sequence(start, F.add_months(start, 12 * (periods - 1)), F.expr("interval 1 year"))


def iso_date(x: Column | str) -> Column:
    return F.date_format(as_col(x), "yyyy-MM-dd")


def parse_iso_date(x: Column | str) -> Column:
    return F.try_to_date(as_col(x), "yyyy-MM-dd") if hasattr(F, "try_to_date") else F.to_date(as_col(x), "yyyy-MM-dd")


def millis_to_timestamp(x: Column | str) -> Column:
    return F.timestamp_millis(as_col(x))


def sanitize_key(x: Column | str) -> Column:
    """Key usable as a file name: blank and slash become ``_``, commas go."""
    return F.translate(as_col(x), " /,", "__")


def metric_key(x: Column | str) -> Column:
    """Key usable in a metric name: blank becomes ``_``, commas go, slashes stay."""
    return F.translate(as_col(x), " ,", "_")


def entity_label(id_: Column | str, name: Column | str, kind: Column | str, place: Column | str) -> Column:
    """``id — name (kind, place)``; missing parts become empty."""
    parts = [F.coalesce(as_col(c).cast("string"), F.lit("")) for c in (id_, name, kind, place)]
    return F.format_string("%s — %s (%s, %s)", *parts)


def short_name(x: Column | str, length: int = 22, drop: str = ", mainland") -> Column:
    return F.substring(F.replace(as_col(x), F.lit(drop), F.lit("")), 1, length)


def capitalised(x: Column | str) -> Column:
    """First letter upper, the rest lower."""
    x = as_col(x)
    return F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 1 << 30)))


def text_hash(seed: int, *parts: Column) -> Column:
    """A number below 2 ** 60: the first 15 hex digits of the MD5 of ``seed|part|...``, with NULL as empty text.

    Every engine can compute it, and it does not depend on the partitioning.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def hashed_uniform(key: Column | str, seed: int) -> Column:
    """Uniform in (0, 1) from a key, the same for every partitioning."""
    bits = F.shiftrightunsigned(text_hash(seed, as_col(key)), 8)  # 52 of the 60 bits
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def hashed_normal(key: Column | str, seed: int) -> Column:
    """Standard normal from a key (Box-Muller on two hashed uniforms)."""
    radius = F.sqrt(F.lit(-2.0) * F.log(hashed_uniform(key, seed)))
    return radius * F.cos(F.lit(6.283185307179586) * hashed_uniform(key, seed + 1))


def hashed_choice(key: Column | str, seed: int, options: Sequence) -> Column:
    """One of ``options`` from a key, each about equally often."""
    pick = F.floor(hashed_uniform(key, seed) * F.lit(float(len(options)))).cast("int") + 1
    return F.element_at(F.array(*[F.lit(o) for o in options]), pick)


# Wichura's PPND16 rational approximation of the normal quantile
# (Applied Statistics 37, 1988, algorithm AS 241), highest power first.
_CENTRAL = (
    (2.5090809287301226727e3, 3.3430575583588128105e4, 6.7265770927008700853e4, 4.5921953931549871457e4,
     1.3731693765509461125e4, 1.9715909503065514427e3, 1.3314166789178437745e2, 3.3871328727963666080e0),
    (5.2264952788528545610e3, 2.8729085735721942674e4, 3.9307895800092710610e4, 2.1213794301586595867e4,
     5.3941960214247511077e3, 6.8718700749205790830e2, 4.2313330701600911252e1, 1.0),
)
_MIDDLE = (
    (7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258e0,
     3.64784832476320460504e0, 5.76949722146069140550e0, 4.63033784615654529590e0, 1.42343711074968357734e0),
    (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1,
     6.89767334985100004550e-1, 1.67638483018380384940e0, 2.05319162663775882187e0, 1.0),
)
_TAIL = (
    (2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2,
     2.96560571828504891230e-1, 1.78482653991729133580e0, 5.46378491116411436990e0, 6.65790464350110377720e0),
    (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4,
     1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0),
)


def _horner(coefficients: Sequence[float], r: Column) -> Column:
    total = F.lit(coefficients[0])
    for c in coefficients[1:]:
        total = total * r + F.lit(c)
    return total


def _ratio(pair, r: Column) -> Column:
    return _horner(pair[0], r) / _horner(pair[1], r)


def with_normal_quantile(df: DataFrame, p: Column, name: str) -> DataFrame:
    """Add the inverse of the standard normal distribution function, NULL outside (0, 1).

    The arguments of the polynomials are columns of their own, so each is computed once.
    """
    at, q, r = F.col("_p"), F.col("_q"), F.col("_r")
    arguments = df.withColumn("_p", F.when((p > 0) & (p < 1), p)).withColumn("_q", at - F.lit(0.5))
    tail = F.sqrt(-F.log(F.when(q < 0, at).otherwise(F.lit(1.0) - at)))
    wide = arguments.withColumn("_r", F.when(F.abs(q) <= 0.425, F.lit(0.180625) - q * q).otherwise(tail))
    outer = F.when(r <= 5.0, _ratio(_MIDDLE, r - F.lit(1.6))).otherwise(_ratio(_TAIL, r - F.lit(5.0)))
    value = F.when(F.abs(q) <= 0.425, q * _ratio(_CENTRAL, r)).otherwise(F.signum(q) * outer)
    return wide.withColumn(name, value).drop("_p", "_q", "_r")


def normal_pdf(x: Column | str, mu: Column | str, sigma: Column | str) -> Column:
    x, mu, sigma = as_col(x), as_col(mu), as_col(sigma)
    z = safe_div(x - mu, sigma)
    return F.exp(F.lit(-0.5) * z * z) / (sigma * F.lit(2.5066282746310002))
