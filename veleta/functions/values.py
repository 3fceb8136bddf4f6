"""Numbers, times and JSON text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def dirty_double(c: Column) -> Column:
    """Keep digits, dots and minus signs and read the rest as a double; failures give 0."""
    kept = F.regexp_replace(c.cast("string"), r"[^0-9.-]", "")
    return F.coalesce(kept.try_cast("double"), F.lit(0.0))


def dirty_bigint(c: Column) -> Column:
    """Keep digits and minus signs and read the rest as a bigint; failures give 0."""
    kept = F.regexp_replace(c.cast("string"), r"[^0-9-]", "")
    return F.coalesce(kept.try_cast("bigint"), F.lit(0).cast("bigint"))


def epoch_timestamp(c: Column) -> Column:
    """Seconds since 1970 (number or numeric text) as a UTC timestamp, null when unreadable."""
    return F.timestamp_seconds(c.try_cast("double"))


def iso_timestamp(c: Column) -> Column:
    """ISO-8601 text as a timestamp, null when unreadable."""
    return F.try_to_timestamp(c)


def month_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def day_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def day_path(ts: Column) -> Column:
    return F.date_format(ts, "yyyy/MM/dd")


def iso_seconds(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def iso_weekday(ts: Column) -> Column:
    """Monday = 1 … Sunday = 7."""
    return F.weekday(ts) + F.lit(1)


def equal_width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based bin over [low, high]; the top edge belongs to the last bin."""
    share = (value - low) / F.nullif(high - low, F.lit(0.0))
    return F.least(F.floor(F.coalesce(share, F.lit(0.0)) * bins), F.lit(bins - 1)).cast("bigint")


def ratio(top: Column, bottom: Column) -> Column:
    """Division with 0 for an empty denominator, as in classification reports."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))
