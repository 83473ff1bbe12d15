"""Column expressions (scalar functions of SURVEY 2.H and the single-row
rules that become columns over a table).  All are built-in Spark
expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values that must equal the reference's ---------------------------
# On-demand scan price, USD per TiB, and the per-query billing minimum.
USD_PER_TIB = 6.25
MIN_BILLED_BYTES = 10 * 1024 * 1024
TIB = 2 ** 40
# Cloud Logging severities and their ordinal values (public LogSeverity enum).
SEVERITY_ORDER = {
    "DEFAULT": 0, "DEBUG": 100, "INFO": 200, "NOTICE": 300, "WARNING": 400,
    "ERROR": 500, "CRITICAL": 600, "ALERT": 700, "EMERGENCY": 800,
}
# Per-query billing minimum appears as 10,485,760 bytes in the sample output.


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cents(x) -> Column:
    """Money as integer cents (per-row rounding, half away from zero)."""
    return F.round(col(x) * 100).cast("bigint")


def sum_money(x) -> Column:
    """Order-independent money sum: integer cents summed, then scaled.  A
    plain double ``sum`` depends on the order partial sums are combined."""
    return (F.sum(cents(x)) / F.lit(100.0)).cast("double")


def safe_divide(a, b) -> Column:
    """SAFE_DIVIDE: NULL when the divisor is 0 or NULL."""
    return F.try_divide(col(a), F.nullif(col(b), F.lit(0)))


def severity_rank(c) -> Column:
    m = F.create_map(*[x for k, v in SEVERITY_ORDER.items() for x in (F.lit(k), F.lit(v))])
    return m[F.upper(col(c))]


def at_least_severity(c, level: str) -> Column:
    return severity_rank(c) >= F.lit(SEVERITY_ORDER[level.upper()])


def label_value(labels, key: str) -> Column:
    """Value of ``key`` in an ARRAY<STRUCT<key,value>>; NULL when absent."""
    return F.try_element_at(F.filter(col(labels), lambda l: l["key"] == F.lit(key)), F.lit(1))["value"]


def credits_total(credits) -> Column:
    """Sum of ``credits[].amount``; an empty or NULL array counts as 0."""
    return F.coalesce(
        F.aggregate(col(credits), F.lit(0.0).cast("double"), lambda acc, c: acc + F.coalesce(c["amount"], F.lit(0.0))),
        F.lit(0.0))


def billed_bytes(processed) -> Column:
    """Bytes billed: rounded up to the 10 MB per-query minimum."""
    return F.greatest(col(processed), F.lit(MIN_BILLED_BYTES).cast("bigint"))


def on_demand_usd(bytes_billed) -> Column:
    return col(bytes_billed) / F.lit(float(TIB)) * F.lit(USD_PER_TIB)


def nearest_rank(p: float, n) -> Column:
    """1-based rank the reference picks for percentile ``p`` (0-100) of ``n``
    sorted values: ``clamp(round_half_even(p/100*n + 0.5), 1, n)``."""
    r = F.bround(F.lit(p / 100.0) * col(n) + F.lit(0.5), 0).cast("bigint")
    return F.greatest(F.lit(1).cast("bigint"), F.least(col(n).cast("bigint"), r))


def range_bucket(c, start: int, end: int, step: int) -> Column:
    """RANGE_BUCKET-style integer-range partition label: bucket index as
    text, ``__NULL__`` for NULL, ``__UNPARTITIONED__`` outside [start, end)."""
    x = col(c)
    return (F.when(x.isNull(), F.lit("__NULL__"))
            .when((x < start) | (x >= end), F.lit("__UNPARTITIONED__"))
            .otherwise(F.floor((x - F.lit(start)) / F.lit(step)).cast("bigint").cast("string")))


def _ts(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, _dt.datetime):
        return F.lit(v)
    if isinstance(v, _dt.date):
        return F.lit(_dt.datetime(v.year, v.month, v.day))
    return F.to_timestamp_ntz(F.lit(str(v)))


def ts_range(c, lo, hi) -> Column:
    """Half-open ``lo <= c < hi`` (sargable)."""
    return (col(c) >= _ts(lo)) & (col(c) < _ts(hi))


def year_range(c, year: int) -> Column:
    """Sargable form of ``EXTRACT(YEAR FROM c) = year``."""
    return ts_range(c, _dt.datetime(year, 1, 1), _dt.datetime(year + 1, 1, 1))


def date_equals(c, day) -> Column:
    """Sargable form of ``DATE(c) = day``."""
    d = _dt.date.fromisoformat(day) if isinstance(day, str) else day
    return ts_range(c, d, d + _dt.timedelta(days=1))


def between_inclusive(c, lo, hi) -> Column:
    """``BETWEEN lo AND hi`` on a timestamp: closed at the top, so midnight of
    ``hi`` is included (the pitfall the reference points out)."""
    return (col(c) >= _ts(lo)) & (col(c) <= _ts(hi))


def trunc_partition(c, unit: str) -> Column:
    """Partition value for DAY / HOUR / MONTH / YEAR granularity."""
    u = unit.upper()
    if u == "DAY":
        return col(c).cast("date")
    if u in ("MONTH", "YEAR"):
        return F.trunc(col(c).cast("date"), u)
    if u == "HOUR":
        return F.date_trunc("hour", col(c))
    raise ValueError(unit)
