"""Scalar column expressions (all JVM-side, codegen-friendly).

Each helper returns a ``Column``; nothing here touches data. They are the
building blocks of the operators in ``txrisk.operators``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from txrisk.params import ScoringParams

# Alert reasons, severities, risk levels and recommended actions.
REASON_HIGH_AMOUNT = "High amount"
REASON_RISKY_COUNTRY = "Risky country"
REASON_MODEL_FLAG = "Model flag"
SEVERITY_HIGH = "HIGH"
SEVERITY_MEDIUM = "MEDIUM"
SEVERITY_LOW = "LOW"
LEVEL_HIGH = "HIGH"
LEVEL_MODERATE = "MODERATE"
LEVEL_LOW = "LOW"
ACTION_BLOCK = "BLOCK_AND_INVESTIGATE"
ACTION_REVIEW = "MANUAL_REVIEW"
ACTION_MONITOR = "STANDARD_MONITORING"

# ISO-8601 text of an event time, as the transaction producer writes it
ISO_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(text: str | Column, fmt: str | None = None) -> Column:
    """String -> TIMESTAMP_NTZ (UTC wall clock); malformed text -> NULL.

    ``try_to_timestamp`` never raises under ANSI mode. The result is
    converted to NTZ with the session zone pinned to UTC, which matches how
    the tables store event time.
    """
    parsed = F.try_to_timestamp(col(text), F.lit(fmt)) if fmt else F.try_to_timestamp(col(text))
    return parsed.cast("timestamp_ntz")


def format_ts(ts: str | Column) -> Column:
    """TIMESTAMP_NTZ -> ISO-8601 text with microseconds and a UTC offset."""
    return F.date_format(col(ts).cast("timestamp"), ISO_TS_FORMAT)


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since 1970-01-01 of an NTZ timestamp (no zone involved)."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), col(ts))


def minute_floor(ts: str | Column) -> Column:
    """Truncate to the minute, keeping TIMESTAMP_NTZ."""
    return F.date_trunc("minute", col(ts)).cast("timestamp_ntz")


def hour_of_day(ts: str | Column) -> Column:
    return F.hour(col(ts)).cast("int")


def foreign_flag(country: str | Column, home: str) -> Column:
    """1 when the country differs from home; a NULL country counts as 0."""
    return F.coalesce((col(country) != F.lit(home)).cast("int"), F.lit(0))


def log_amount(amount: str | Column) -> Column:
    """ln(1 + amount)."""
    return F.log1p(col(amount))


def round_to(x: str | Column, digits: int = 6) -> Column:
    """Round half away from zero at ``digits`` places: ``round(x·10^d) / 10^d``.

    The scaling is done in binary first and the integer rounding decides a
    tie on the binary value, so every engine that evaluates the same IEEE
    operations gets the same double (``round(x, d)`` rounds the decimal text
    of ``x`` instead, which can differ at exact ties).
    """
    scale = float(10 ** digits)
    return F.round(col(x) * F.lit(scale)) / F.lit(scale)


def linear_score(
    amount: str | Column,
    tx_count: str | Column,
    is_foreign: str | Column,
    category: str | Column,
    p: ScoringParams,
) -> Column:
    """Logistic score of the fixed oracle coefficients, rounded."""
    z = (
        F.lit(p.intercept)
        + F.lit(p.coef_amount) * col(amount)
        + F.lit(p.coef_tx_count) * col(tx_count)
        + F.lit(p.coef_foreign) * col(is_foreign)
        + F.when(col(category) == F.lit(p.special_category), F.lit(p.coef_special_category)).otherwise(F.lit(0.0))
    )
    return round_to(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), p.score_digits)


def is_flagged(score: str | Column, threshold: float | Column) -> Column:
    """score >= threshold; NaN and NULL are never flagged.

    Spark orders NaN above every number, so a bare ``>=`` would flag it.
    """
    s = col(score)
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.coalesce((s >= t) & ~F.isnan(s), F.lit(False))


def alert_reason(amount: str | Column, country: str | Column, p: ScoringParams) -> Column:
    """High amount, else risky country, else model flag (order matters)."""
    return (
        F.when(col(amount) > F.lit(p.high_amount), F.lit(REASON_HIGH_AMOUNT))
        .when(col(country).isin(*p.risky_countries), F.lit(REASON_RISKY_COUNTRY))
        .otherwise(F.lit(REASON_MODEL_FLAG))
    )


def severity(score: str | Column, p: ScoringParams) -> Column:
    return (
        F.when(col(score) >= F.lit(p.high_severity), F.lit(SEVERITY_HIGH))
        .when(col(score) >= F.lit(p.medium_severity), F.lit(SEVERITY_MEDIUM))
        .otherwise(F.lit(SEVERITY_LOW))
    )


def rule_label(amount: str | Column, country: str | Column, tx_count: str | Column,
               category: str | Column, p: ScoringParams) -> Column:
    """Ground-truth rule: big amount, or risky country with high frequency,
    or the special category above its cut-off. NULL inputs give 0."""
    cond = (
        (col(amount) > F.lit(p.high_amount))
        | (col(country).isin(*p.risky_countries) & (col(tx_count) >= F.lit(p.risky_count)))
        | ((col(category) == F.lit(p.special_category)) & (col(amount) > F.lit(p.special_amount)))
    )
    return F.coalesce(cond, F.lit(False)).cast("int")


def risk_level(rate_pct: str | Column, high_pct: float, moderate_pct: float) -> Column:
    return (
        F.when(col(rate_pct) >= F.lit(high_pct), F.lit(LEVEL_HIGH))
        .when(col(rate_pct) >= F.lit(moderate_pct), F.lit(LEVEL_MODERATE))
        .otherwise(F.lit(LEVEL_LOW))
    )


def clip01(x: str | Column) -> Column:
    """Bound to [0, 1]; NULL stays NULL (greatest/least skip NULLs)."""
    c = col(x)
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0)))


def at_least(x: str | Column, floor: float) -> Column:
    """max(x, floor) as a double, for divisors."""
    return F.greatest(col(x).cast("double"), F.lit(float(floor)))


def in_lists(filters: Iterable[tuple[str, Iterable[str]]]) -> Column:
    """Conjunction of IN-lists; an empty list imposes no restriction."""
    cond = F.lit(True)
    for name, values in filters:
        values = list(values)
        if values:
            cond = cond & F.col(name).isin(*values)
    return cond


def recommended_action(n_high: str | Column, n_mid: str | Column) -> Column:
    return (
        F.when(col(n_high) > 0, F.lit(ACTION_BLOCK))
        .when(col(n_mid) > 0, F.lit(ACTION_REVIEW))
        .otherwise(F.lit(ACTION_MONITOR))
    )
