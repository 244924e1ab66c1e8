"""Scalar functions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from touchline.functions import clock, numbers, outcomes, text


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def ts(literal):
    return F.lit(literal).cast("timestamp")


@pytest.mark.parametrize(
    ("utc", "label"),
    [
        ("2026-08-31 19:00:00", "31 Aug 2026 • 21:00 CEST"),
        ("2026-12-31 23:30:00", "01 Jan 2027 • 00:30 CET"),
        ("2026-03-29 00:59:00", "29 Mar 2026 • 01:59 CET"),
        ("2026-03-29 01:00:00", "29 Mar 2026 • 03:00 CEST"),
    ],
)
def test_kickoff_label(spark, utc, label):
    assert value(spark, clock.kickoff_label(ts(utc))) == label


def test_clock(spark):
    assert value(spark, clock.kickoff_label(F.lit(None).cast("timestamp"))) == "Date unavailable"
    assert value(spark, clock.zone_label(ts("2026-01-01 00:00:00"), "Asia/Kolkata")) == "UTC+05:30"
    assert value(spark, clock.utc_label(ts("2026-08-31 19:05:00"))) == "31 Aug 2026 • 19:05 UTC"
    parsed = clock.utc_timestamp(F.lit("2026-08-31T18:12:10+02:00"))
    assert str(value(spark, parsed)) == "2026-08-31 16:12:10"
    assert value(spark, clock.utc_timestamp(F.lit("soon"), tolerant=True)) is None
    gap = clock.seconds_between(ts("2026-01-01 00:00:00"), ts("2026-01-01 00:01:30.5"))
    assert value(spark, gap) == 90.5


@pytest.mark.parametrize(
    ("number", "shown"), [(1.125, "1.12"), (1.015, "1.01"), (2.675, "2.67"), (1.0, "1.00"), (0.005, "0.01")]
)
def test_fixed_matches_exact_binary_rounding(spark, number, shown):
    assert shown == f"{number:.2f}"
    assert value(spark, numbers.fixed(F.lit(number), 2)) == shown


def test_numbers(spark):
    assert [value(spark, numbers.signed(F.lit(n))) for n in (3, -2, 0)] == ["+3", "-2", "+0"]
    assert value(spark, numbers.record(F.lit(10), F.lit(3), F.lit(2))) == "10-3-2"
    assert value(spark, numbers.ratio(F.lit(1), F.lit(0))) is None
    assert value(spark, numbers.percentage(F.lit(0), F.lit(0))) == 0.0
    assert value(spark, numbers.percentage(F.lit(1), F.lit(4))) == 25.0
    assert value(spark, numbers.round_to(F.lit(5.0) / 3, 3)) == 1.667
    assert value(spark, numbers.clamp(F.lit(9), F.lit(1), F.lit(7))) == 7


def test_text(spark):
    key = text.surrogate_key(F.lit("PD"), F.lit(None).cast("string"), F.lit(5))
    assert value(spark, key) == "PD--5"
    assert value(spark, text.text_or(F.lit(None).cast("string"))) == "—"
    assert value(spark, text.same_text(F.lit("Spain"), F.lit("SPAIN"))) is True
    assert value(spark, text.to_integer(F.lit("x1"), tolerant=True)) is None
    assert value(spark, text.to_integer(F.lit("17"))) == 17
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        value(spark, text.to_integer(F.lit("x1")))


def test_outcomes(spark):
    codes = [value(spark, outcomes.winner_code(F.lit(w).cast("string"))) for w in ("HOME_TEAM", "AWAY_TEAM", "DRAW", "X", None)]
    assert codes == ["H", "A", "D", None, None]
    assert [value(spark, outcomes.points_for(F.lit(r).cast("string"))) for r in ("W", "D", "L", None)] == [3, 1, 0, None]
    assert value(spark, outcomes.score_result(F.lit(1), F.lit(None).cast("int"))) is None
