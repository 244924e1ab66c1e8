"""Time parsing, zone conversion and time display (stored times are UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DISPLAY_ZONE = "Europe/Madrid"
# Offset in minutes -> abbreviation, for the display zone.
ZONE_LABELS = {60: "CET", 120: "CEST"}
NO_DATE = "Date unavailable"


def utc_timestamp(text: Column, tolerant: bool = False) -> Column:
    """ISO-8601 text to a UTC timestamp; tolerant gives NULL for malformed text."""
    return F.try_to_timestamp(text) if tolerant else F.to_timestamp(text)


def local_time(ts: Column, zone: str = DISPLAY_ZONE) -> Column:
    return F.from_utc_timestamp(ts, zone)


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)


def zone_label(ts: Column, zone: str = DISPLAY_ZONE) -> Column:
    """Abbreviation for the zone's offset at that moment (true offset, never a constant)."""
    minutes = ((F.unix_micros(local_time(ts, zone)) - F.unix_micros(ts)) / F.lit(60e6)).cast("int")
    size = F.abs(minutes)
    label = F.format_string(
        "UTC%s%02d:%02d", F.when(minutes < 0, "-").otherwise("+"), (size / 60).cast("int"), size % 60
    )
    for offset, name in ZONE_LABELS.items():
        label = F.when(minutes == offset, F.lit(name)).otherwise(label)
    return label


def local_date(ts: Column, zone: str = DISPLAY_ZONE) -> Column:
    """31 Aug 2026"""
    return F.date_format(local_time(ts, zone), "dd MMM yyyy")


def kickoff_label(ts: Column, zone: str = DISPLAY_ZONE, year: bool = True) -> Column:
    """31 Aug 2026 • 21:00 CEST, or a fixed text when there is no date."""
    pattern = "dd MMM yyyy • HH:mm" if year else "dd MMM • HH:mm"
    text = F.concat(F.date_format(local_time(ts, zone), pattern), F.lit(" "), zone_label(ts, zone))
    return F.coalesce(text, F.lit(NO_DATE))


def utc_label(ts: Column, year: bool = True) -> Column:
    """31 Aug 2026 • 19:00 UTC"""
    pattern = "dd MMM yyyy • HH:mm" if year else "dd MMM • HH:mm"
    return F.concat(F.date_format(ts, pattern), F.lit(" UTC"))
