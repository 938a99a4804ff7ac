"""Instants, business days and deadlines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import REPORTS, TIME_ZONE

_INSTANT = r"\A\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?(?:Z|[+-]\d{2}:\d{2})\z"
_DATE = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"


def parse_instant(text: Column) -> Column:
    """An ISO-8601 instant with an explicit offset; anything else is null."""
    return F.when(F.rlike(text, F.lit(_INSTANT)), F.try_to_timestamp(text))


def has_offset(text: Column) -> Column:
    return F.rlike(text, F.lit(r"(?:Z|[+-]\d{2}:?\d{2})\z"))


def parse_date(text: Column) -> Column:
    """A canonical YYYY-MM-DD date; anything else is null."""
    return F.when(F.rlike(text, F.lit(_DATE)), text.try_cast("date"))


def local_to_utc(day: Column, hour: Column, zone: str = TIME_ZONE) -> Column:
    """The instant of a local hour on a day; in a gap the later reading, in an overlap the earlier."""
    local = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "), F.lpad(hour.cast("string"), 2, "0"), F.lit(":00:00"))
    return F.to_utc_timestamp(local.cast("timestamp"), zone)


def deadline(report: Column, day: Column) -> Column:
    """When a report for a business day is due: a fixed local hour on the next day."""
    hour = F.create_map(*[F.lit(x) for r, (_, _, h) in REPORTS.items() for x in (r, h)])[report]
    return local_to_utc(F.date_add(day, 1), hour)


def business_date(instant: Column, zone: str = TIME_ZONE) -> Column:
    return F.to_date(F.from_utc_timestamp(instant, zone))


def business_day_bounds(day: Column) -> tuple[Column, Column]:
    """The half-open instants of a business day: 23 or 25 hours when clocks change."""
    return local_to_utc(day, F.lit(0)), local_to_utc(F.date_add(day, 1), F.lit(0))


def delay_seconds(received: Column, watermark: Column) -> Column:
    """Whole seconds that something arrived after the watermark; 0 if before."""
    return F.greatest(
        F.lit(0), F.floor(F.unix_micros(received) / 1_000_000 - F.unix_micros(watermark) / 1_000_000)
    ).cast("long")
