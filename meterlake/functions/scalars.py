"""Casting, keys, time buckets and domain arithmetic as Column -> Column functions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
POWER_FACTOR = 0.95
EPOCH_MILLIS_ABOVE = 10_000_000_000
HOUR_PERIOD_PATTERN = "yyyy-MM-dd'T'HH"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_of(value: object, kind: T.DataType) -> Column:
    """A value fetched from a column of type ``kind`` as a literal of that type.

    Zone-free timestamps go through text: a plain datetime literal would be shifted by the session time zone.
    """
    if isinstance(value, datetime) and isinstance(kind, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast(kind)
    return F.lit(value).cast(kind)


def safe_number(c: Column | str, kind: str = "double") -> Column:
    """Text that is not a number becomes NULL instead of failing the job."""
    return _col(c).try_cast(kind)


def safe_timestamp(c: Column | str, pattern: str | None = None) -> Column:
    """Wall-clock timestamp (no zone); unparseable text becomes NULL."""
    if pattern is None:
        return _col(c).try_cast("timestamp_ntz")
    return F.try_to_timestamp(_col(c), F.lit(pattern)).cast("timestamp_ntz")


def business_key(*columns: Column | str, sep: str = "_") -> Column:
    """Parts joined by ``sep``; NULL as soon as one part is NULL."""
    parts: list[Column] = []
    for c in columns:
        if parts:
            parts.append(F.lit(sep))
        parts.append(_col(c))
    return F.concat(*parts)


def padded_id(prefix: str, key: Column | str, width: int = 6) -> Column:
    """``prefix`` + zero-padded key.  Keys longer than ``width`` keep all their digits, so ids never collide."""
    digits = _col(key).cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0")))


def date_key(c: Column | str) -> Column:
    """yyyyMMdd as INT, by integer arithmetic instead of text formatting."""
    day = _col(c)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_start(c: Column | str) -> Column:
    """First day of the month: the cheap grouping form of a period, formatted only after the aggregation."""
    return F.trunc(F.to_date(_col(c)), "month").alias("month_start")


def month_period(c: Column | str) -> Column:
    """yyyy-MM text."""
    return F.date_format(F.to_date(_col(c)), "yyyy-MM")


def floor_minutes(c: Column | str, minutes: int = 30) -> Column:
    """Start of the ``minutes``-long slot (a divisor of 60) holding a wall-clock timestamp."""
    ts = _col(c).cast("timestamp_ntz")
    seconds = F.date_part(F.lit("SECOND"), ts)
    return ts - F.make_dt_interval(F.lit(0), F.lit(0), F.pmod(F.minute(ts), F.lit(minutes)), seconds)


def epoch_to_timestamp(c: Column | str) -> Column:
    """Epoch seconds or milliseconds, told apart by magnitude, to a UTC timestamp."""
    value = _col(c).cast("double")
    micros = F.when(value > EPOCH_MILLIS_ABOVE, value * 1e3).otherwise(value * 1e6)
    return F.timestamp_micros(F.round(micros).cast("bigint"))


def shift_days_back(c: Column | str, days: Column | str) -> Column:
    """Timestamp minus a per-row number of days."""
    return _col(c) - F.make_interval(days=_col(days).cast("int"))


def pick(choices: list[str], position: Column) -> Column:
    """Categorical pick: 1-based ``position`` into a fixed list."""
    return F.element_at(F.array(*[F.lit(v) for v in choices]), position.cast("int"))


def active_power(voltage: Column | str, current: Column | str) -> Column:
    """Active power in kW at the fixed power factor, to three decimals."""
    return F.round(_col(voltage) * _col(current) * POWER_FACTOR / 1000.0, 3)


def api_start(watermark: Column | str, unit: str = "hour") -> Column:
    """Watermark as the start parameter a source expects: hour grain or day grain."""
    pattern = {"hour": HOUR_PERIOD_PATTERN, "day": "yyyy-MM-dd"}[unit]
    return F.date_format(_col(watermark), pattern)


def portable_hash(*columns: Column | str) -> Column:
    """A 32-bit hash any SQL engine with md5 can reproduce; non-negative BIGINT."""
    text = F.concat_ws("|", *[_col(c).cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
