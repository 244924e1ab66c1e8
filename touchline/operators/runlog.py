"""Run log: append-only events folded to one row per run."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.clock import seconds_between, utc_label

# Event kinds and the values the folded log shows.
START, STAGE, SUCCESS, FAILED, RUNNING = "START", "STAGE", "SUCCESS", "FAILED", "RUNNING"


def fold_runs(events: DataFrame) -> DataFrame:
    """Current state of every run.

    A run exists from its first START. Later events overwrite what they set: a stage the
    current stage; success and failure the end, status and duration; failure also the failed
    stage and message. All of it is one aggregate of min/max_by, combined before the exchange,
    so no list of events is formed per run. An event before the START changes nothing: the newest event of a kind
    is after the START whenever any event of that kind is.
    """
    at = F.struct("event_ts", "event_id")

    def newest(*kinds: str) -> Column:
        row = F.struct("event_ts", "event_id", "event", "stage", "error_message")
        return F.max_by(row, F.when(F.col("event").isin(*kinds), at))

    folded = events.groupBy("run_id").agg(
        F.min_by(
            F.struct("event_ts", "event_id", "competition_code"),
            F.when(F.col("event") == START, at),
        ).alias("first"),
        newest(STAGE, SUCCESS, FAILED).alias("step"),
        newest(SUCCESS, FAILED).alias("end"),
        newest(FAILED).alias("failure"),
    )

    return _states(folded)


# Event times count in microseconds, times a number above the span of event ids.
ID_SPAN = Decimal(20_000_000_000_000_000_000)


def deciding_events(events: DataFrame) -> DataFrame:
    """The events that a run's state rests on: its first START and its newest step, end and failure.

    These are at most four of a run, and themselves a log: folding them with later events gives
    what folding all events gives, in any grouping, and an event folded twice changes nothing.
    Places in time are one number each, so they are found by hashed aggregates; the events are
    then picked by a join on the run. Event ids are unique within a log.
    """
    micros = F.coalesce(F.unix_micros("event_ts"), F.lit(-5 * 10**17).cast("long")).cast("decimal(18,0)")
    place = micros * F.lit(ID_SPAN) + F.coalesce("event_id", F.lit(-(2**63)).cast("long")).cast("decimal(19,0)")
    placed = events.withColumn("_place", place.cast("decimal(38,0)"))

    def kind(*kinds: str) -> Column:
        return F.when(F.col("event").isin(*kinds), F.col("_place"))

    ends = {"_first": F.min(kind(START)), "_step": F.max(kind(STAGE, SUCCESS, FAILED)),
            "_end": F.max(kind(SUCCESS, FAILED)), "_failure": F.max(kind(FAILED))}
    marks = placed.groupBy(F.col("run_id").alias("_run")).agg(*[v.alias(k) for k, v in ends.items()])
    wanted = (
        (F.col("event").isin(START) & (F.col("_place") == F.col("_first")))
        | (F.col("event").isin(STAGE, SUCCESS, FAILED) & (F.col("_place") == F.col("_step")))
        | (F.col("event").isin(SUCCESS, FAILED) & (F.col("_place") == F.col("_end")))
        | (F.col("event").isin(FAILED) & (F.col("_place") == F.col("_failure")))
    )
    return placed.join(marks, F.col("run_id").eqNullSafe(F.col("_run"))).filter(wanted).select(*events.columns).distinct()


def fold_deciding(events: DataFrame) -> DataFrame:
    """State of every run from its deciding events: a list of at most four rows a run."""
    row = F.struct("event_ts", "event_id", "event", "stage", "error_message", "competition_code")
    rows = events.groupBy("run_id").agg(F.collect_list(row).alias("rows"))

    def of(*kinds: str) -> Column:
        return F.filter("rows", lambda r: r["event"].isin(*kinds))

    return _states(
        rows.select(
            "run_id",
            F.array_min(of(START)).alias("first"),
            F.array_max(of(STAGE, SUCCESS, FAILED)).alias("step"),
            F.array_max(of(SUCCESS, FAILED)).alias("end"),
            F.array_max(of(FAILED)).alias("failure"),
        )
    )


def _states(folded: DataFrame) -> DataFrame:
    """The shown row of each run from its first START and its newest step, end and failure."""

    def after_start(name: str) -> Column:
        event = F.struct(F.col(f"{name}.event_ts"), F.col(f"{name}.event_id"))
        start = F.struct(F.col("first.event_ts"), F.col("first.event_id"))
        return F.when(F.col(name).isNotNull() & (event > start), F.col(name))

    step, end, failure = F.col("step"), F.col("end"), F.col("failure")
    return (
        folded.filter(F.col("first").isNotNull())
        .withColumns({name: after_start(name) for name in ("step", "end", "failure")})
        .select(
            "run_id",
            F.col("first.competition_code").alias("competition_code"),
            F.col("first.event_ts").alias("started_at"),
            end["event_ts"].alias("finished_at"),
            F.coalesce(end["event"], F.lit(RUNNING)).alias("status"),
            F.when(step.isNull(), F.lit("STARTING"))
            .when(step["event"] == SUCCESS, F.lit("COMPLETE"))
            .when(step["event"] == FAILED, F.lit("FAILED"))
            .otherwise(step["stage"])
            .alias("current_stage"),
            failure["stage"].alias("failed_stage"),
            seconds_between(F.col("first.event_ts"), end["event_ts"]).alias("duration_seconds"),
            failure["error_message"].alias("error_message"),
        )
    )


def latest_runs(runs: DataFrame, limit: int = 10) -> DataFrame:
    return runs.orderBy(F.col("started_at").desc_nulls_last(), "run_id").limit(limit)


def run_history(runs: DataFrame, limit: int = 10) -> DataFrame:
    """Display rows of the newest runs."""
    return latest_runs(runs, limit).select(
        "run_id",
        utc_label(F.col("started_at")).alias("started"),
        "status",
        F.col("current_stage").alias("stage"),
        "failed_stage",
        F.round("duration_seconds", 2).alias("duration_s"),
        F.col("error_message").alias("error"),
    )


def latest_run_line(runs: DataFrame) -> DataFrame:
    """Status text of the newest run."""
    return latest_runs(runs, 1).select(
        "run_id",
        "status",
        utc_label(F.col("started_at"), year=False).alias("started"),
        F.when(F.col("status") == SUCCESS, F.lit("The latest run completed successfully."))
        .when(F.col("status") == RUNNING, F.lit("The latest run is still running."))
        .otherwise(
            F.concat(
                F.lit("Latest run failed during "),
                F.coalesce("failed_stage", F.lit("None")),
                F.lit("."),
            )
        )
        .alias("message"),
    )
