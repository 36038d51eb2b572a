"""Timestamp rules as column expressions. The session time zone is UTC."""

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_HOUR = 3_600_000_000.0
MICROS_PER_DAY = 86_400_000_000.0


def parse_utc(c: Column | str) -> Column:
    """ISO text to timestamp; empty or malformed text gives null instead of failing the job."""
    return F.try_to_timestamp(F.nullif(F.col(c) if isinstance(c, str) else c, F.lit("")))


def whole_hours(start: Column | str, end: Column | str) -> Column:
    """Hours between two timestamps at whole-second resolution; negative values are kept."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(3600)


def _micros(start: Column | str, end: Column | str) -> Column:
    return F.unix_micros(end) - F.unix_micros(start)


def exact_hours(start: Column | str, end: Column | str) -> Column:
    return _micros(start, end) / F.lit(MICROS_PER_HOUR)


def exact_days(start: Column | str, end: Column | str) -> Column:
    return _micros(start, end) / F.lit(MICROS_PER_DAY)


def iso_zone(c: Column | str) -> Column:
    """ISO-8601 with a numeric zone, e.g. ``2024-01-02T03:04:05+00:00``; micros only if present."""
    plain = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ssxxx")
    fine = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.when(F.unix_micros(c) % 1_000_000 == 0, plain).otherwise(fine)


def iso_z(c: Column | str) -> Column:
    return F.replace(iso_zone(c), F.lit("+00:00"), F.lit("Z"))


def step_back(iso: Column | str, seconds: int) -> Column:
    """Move an ISO cursor back by ``max(0, seconds)``; text that is no timestamp stays as it is."""
    c = F.col(iso) if isinstance(iso, str) else iso
    back = parse_utc(c) - F.make_dt_interval(secs=F.lit(max(0, seconds)))
    return F.coalesce(iso_z(back), c)


def run_stamp(c: Column | str) -> Column:
    return F.date_format(c, "yyyyMMdd_HHmmss")


def month_of(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM")
