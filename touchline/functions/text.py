"""Keys, fallbacks and tolerant casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING_TEXT = "—"


def surrogate_key(*parts: Column) -> Column:
    """Dash-joined key; a NULL part contributes an empty string."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit("-"))
        pieces.append(F.coalesce(part.cast("string"), F.lit("")))
    return F.concat(*pieces)


def text_or(value: Column, fallback: str = MISSING_TEXT) -> Column:
    return F.coalesce(value.cast("string"), F.lit(fallback))


def same_text(left: Column, right: Column) -> Column:
    """Case-insensitive equality."""
    return F.lower(left) == F.lower(right)


def to_integer(value: Column, tolerant: bool = False) -> Column:
    """Text to bigint: raises on malformed text, or gives NULL when tolerant."""
    return value.try_cast("bigint") if tolerant else value.cast("bigint")
