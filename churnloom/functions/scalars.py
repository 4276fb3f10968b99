"""Column expressions shared by the operators. All stay inside Catalyst."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from churnloom import fixed


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_from_int(c: Column | str) -> Column:
    """Integer ``yyyyMMdd`` to date; an impossible day gives null, not a failed job.

    Integer arithmetic: no text is built and parsed per row. The number is named as few
    times as possible: a filter on the day is pushed down to where the number is computed,
    with its whole expression in each place, and generated code that gets too long for the
    JVM's compiler is interpreted, many times slower.
    """
    number = _col(c)
    parts = (F.floor(number / 10000), F.floor(number / 100) % 100, number % 100)
    at = F.try_make_timestamp_ntz(*[p.cast("int") for p in parts], F.lit(0), F.lit(0), F.lit(0))
    return F.when(number.between(10000101, 99991231), at.cast("date"))


def day_from_text(c: Column | str) -> Column:
    """Date from the ISO day at the start of a text."""
    return F.try_to_date(F.left(_col(c), F.lit(10)), "yyyy-MM-dd")


def day_start(c: Column | str) -> Column:
    """UTC start of a day as a zone-free timestamp."""
    return _col(c).cast("timestamp_ntz")


def utc_instant(c: Column | str) -> Column:
    """Instant of a zone-free UTC wall time, under any session time zone."""
    local = F.convert_timezone(F.lit("UTC"), F.current_timezone(), _col(c))
    return local.cast("timestamp")


def utc_wall_time(c: Column | str) -> Column:
    """Zone-free UTC wall time of an instant."""
    local = _col(c).cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)


def valid_age(c: Column | str) -> Column:
    """Age kept only inside 1..100."""
    age = _col(c)
    return F.when(age.between(1, 100), age)


def number_or_null(c: Column | str) -> Column:
    """NaN read as null."""
    return F.nanvl(_col(c), F.lit(None).cast("double"))


#: Money and seconds while they are added up: sums do not depend on the order.
EXACT = "decimal(28,9)"
EXACT_TOTAL = "decimal(38,9)"


def exact(c: Column | str) -> Column:
    """A number with nine decimal places; null beyond 10**19 and for NaN."""
    return _col(c).try_cast(EXACT)


def zero_if_null(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(0))


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """Quotient as double, null where the denominator is 0 or null."""
    return F.try_divide(_col(top).cast("double"), _col(bottom).cast("double"))


def gender_code(c: Column | str) -> Column:
    codes = F.create_map(*[F.lit(x) for pair in fixed.GENDER_CODES.items() for x in pair])
    named = F.coalesce(_col(c), F.lit("unknown"))
    return F.coalesce(codes[named], F.lit(fixed.OTHER_GENDER_CODE))


def churn_flag(p: Column | str, threshold: float = fixed.CHURN_THRESHOLD) -> Column:
    """1 from the threshold (inclusive) upwards."""
    return (_col(p) >= F.lit(threshold)).cast("int")


def psi_level(psi: Column | str) -> Column:
    value = _col(psi)
    return (
        F.when(value.isNull(), "pending")
        .when(value < fixed.PSI_WARNING, "stable")
        .when(value < fixed.PSI_CRITICAL, "warning")
        .otherwise("critical")
    )


def percent_text(c: Column | str, digits: int = 1) -> Column:
    return F.format_string(f"%.{digits}f%%", _col(c) * 100)


def short_id(c: Column | str) -> Column:
    """Ids over 22 characters as first ten, ellipsis, last six."""
    text = _col(c)
    return F.when(
        F.length(text) > 22, F.concat(F.left(text, F.lit(10)), F.lit("…"), F.right(text, F.lit(6)))
    ).otherwise(text)


def score_bin(p: Column | str, bins: int) -> Column:
    """Index of the equal-width bin of a score in [0, 1]; 1.0 falls in the last."""
    score = _col(p)
    # ``least`` skips nulls, so an unknown score would land in the last bin.
    return F.when(score.isNotNull(), F.least(F.floor(score * bins), F.lit(bins - 1)))


def event_time_or_now(c: Column | str) -> Column:
    now = F.date_format(F.convert_timezone(None, F.lit("UTC"), F.localtimestamp()), "yyyy-MM-dd HH:mm:ss")
    given = F.nullif(_col(c), F.lit(""))
    return F.coalesce(given, F.concat(now, F.lit(" UTC")))


def ks_pvalue(stat: Column | str, n: Column | str, m: Column | str, terms: int = 100) -> Column:
    """Asymptotic two-sample Kolmogorov-Smirnov p-value.

    ``2 * sum((-1)^(k-1) * exp(-2 k^2 x^2))`` with ``x = D * sqrt(nm/(n+m))``.
    The cut-off alternating sum is unreliable near 0, where the value is 1.
    """
    n, m = _col(n).cast("double"), _col(m).cast("double")
    x = _col(stat) * F.sqrt(n * m / (n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * x * x),
    )
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * series))
    return F.when(x < 0.2, F.lit(1.0)).when(x >= 0.2, clamped)
