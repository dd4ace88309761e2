"""Time expressions (X10-X16). Sessions run in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Numbers above this are milliseconds (page attributes; calendar code).
MILLIS_PAGE, MILLIS_CALENDAR = 10_000_000_000, 1_000_000_000_000


def epoch_seconds(x: Column, millis_above: int) -> Column:
    n = x.cast("double")
    return F.when(n > millis_above, n / 1000).otherwise(n)


def parse_timestamp(x: Column) -> Column:
    """ISO 8601 with Z, +00:00 or +0000, or digits (seconds or milliseconds); NULL if none of these."""
    raw = F.regexp_replace(x, r"(?U)^\s+|\s+$", "")
    iso = F.regexp_replace(F.regexp_replace(raw, "Z$", "+00:00"), r"([+-])(\d{2})(\d{2})$", "$1$2:$3")
    digits = raw.rlike(r"^\d+$")
    number = epoch_seconds(F.when(digits, raw).try_cast("double"), MILLIS_PAGE)
    return F.when(digits, F.timestamp_micros((number * 1_000_000).cast("long"))).otherwise(iso.try_cast("timestamp"))


def parse_utc(x: Column) -> Column:
    """X11: tolerant; NULL on failure."""
    return F.nullif(x, F.lit("")).try_cast("timestamp")


def utc_day(unix: Column) -> Column:
    """X12."""
    return F.to_date(F.timestamp_micros((epoch_seconds(unix, MILLIS_CALENDAR) * 1_000_000).cast("long")))


def day_range(a: Column, b: Column) -> Column:
    """Inclusive days between two dates, whichever comes first."""
    return F.sequence(F.least(a, b), F.greatest(a, b), F.expr("interval 1 day"))


def scan_cap(days: Column) -> Column:
    """X13."""
    return F.least(F.lit(4000), F.greatest(F.lit(300), days * 80))


def window_label(hours: Column) -> Column:
    """48h, 7d, unbounded."""
    whole = (hours >= 24) & (hours % 24 == 0) & (hours != 48)
    number = lambda x: F.regexp_replace(x.cast("string"), r"\.0$", "")
    return F.when(hours.isNull(), "unbounded").when(whole, F.concat(number(hours / 24), F.lit("d"))).otherwise(F.concat(number(hours), F.lit("h")))


def local_to_unix(x: Column) -> Column:
    """`2026-08-15 14:30 Asia/Manila` -> Unix seconds; NULL for anything else or an unknown zone. A time that a zone's clock skips counts as the hour before the change."""
    shape = r"^\s*(\d{4}-\d{2}-\d{2} \d{1,2}:\d{2})\s+(\S+)\s*$"
    local = F.try_to_timestamp(F.nullif(F.regexp_extract(x, shape, 1), F.lit("")), F.lit("yyyy-MM-dd H:mm"))
    zone = F.regexp_extract(x, shape, 2)
    known = zone.rlike(r"^(?:[A-Z][A-Za-z]+(?:/[A-Za-z_+\-0-9]+)+|UTC|GMT)$")
    return F.when(known & local.isNotNull(), F.unix_seconds(F.to_utc_timestamp(local, F.when(known, zone).otherwise("UTC"))))


def month_key(created_utc: Column) -> Column:
    """X15."""
    return F.substring(created_utc, 1, 7)


def retry_after(header: Column, default: float, most: float) -> Column:
    """Seconds of a Retry-After header, a default if it holds no number, bounded."""
    return F.least(F.greatest(F.coalesce(F.regexp_extract(F.coalesce(header, F.lit("")), r"^\s*(\d+(?:\.\d+)?)\s*$", 1).try_cast("double"), F.lit(default)), F.lit(0.0)), F.lit(most))


def log_line(level: Column, at: Column, event: Column, fields: Column) -> Column:
    """`LEVEL time event k=v k=v`, keys in order; `fields` is a map of strings."""
    pairs = F.transform(F.array_sort(F.map_entries(fields)), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.concat_ws(" ", F.rpad(level, 7, " "), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"), event, F.nullif(F.array_join(pairs, " "), F.lit("")))
