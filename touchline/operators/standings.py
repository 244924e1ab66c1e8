"""Official table: latest snapshot, reconciliation, current standings and its views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.functions.numbers import count_where, percentage
from touchline.functions.text import surrogate_key
from touchline.operators import LEAGUE
from touchline.operators.performance import derived_totals

# Table zones and race presets: (label, first position, last position). Fixed values.
ZONES = [("UCL", 1, 4), ("Europe", 5, 7), ("Relegation", 18, 20)]
RACES = [("Title Race", 1, 4), ("European Race", 4, 8), ("Relegation Battle", 16, 20)]
NO_ZONE = "—"
SYNCED = "✓ Synced"
PENDING = "⚠ Pending"

PAIRED = ["played", "won", "drawn", "lost", "points", "goals_for", "goals_against"]
COMPARED = ["played", "points", "goals_for", "goals_against"]

RECONCILIATION_COLUMNS = [
    "competition_id", "competition_code", "season_id", "snapshot_date", "snapshot_matchday",
    "team_id",
    *[f"{source}_{name}" for name in PAIRED for source in ("official", "derived")],
    *[f"{name}_delta" for name in COMPARED],
    "is_reconciled",
]


def latest_per_league(snapshots: DataFrame, keys: list[str] = LEAGUE) -> DataFrame:
    """Rows of each league's newest snapshot.

    ``rank() = 1`` lets Spark drop older snapshots on the map side (window group limit),
    so only the newest rows of a league are exchanged, however long its history is.
    """
    newest = W.partitionBy(*keys).orderBy(F.col("snapshot_date").desc())
    return (
        snapshots.filter(F.col("snapshot_date").isNotNull())
        .withColumn("_rank", F.rank().over(newest))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def reconcile(
    official: DataFrame,
    derived: DataFrame,
    keys: list[str],
    paired: list[str],
    compared: list[str],
) -> DataFrame:
    """Official rows next to derived totals, with deltas and an agreement flag.

    A missing derived row counts as zero. A NULL official value gives a NULL delta and
    ``is_reconciled = false``. All official columns are kept.
    """
    right = derived.selectExpr(*keys, *[f"{c} AS _derived_{c}" for c in paired])
    found = {c: f"bigint(coalesce(_derived_{c}, 0))" for c in paired}
    agree = " AND ".join(f"{c} = {found[c]}" for c in compared)
    return official.join(right, keys, "left").selectExpr(
        *official.columns,
        *[f"{c} AS official_{c}" for c in paired],
        *[f"{found[c]} AS derived_{c}" for c in paired],
        *[f"{c} - {found[c]} AS {c}_delta" for c in compared],
        f"CASE WHEN {agree} THEN true ELSE false END AS is_reconciled",
    )


def _reconciled_latest(standings: DataFrame, results: DataFrame) -> DataFrame:
    return reconcile(
        latest_per_league(standings), derived_totals(results), LEAGUE + ["team_id"], PAIRED, COMPARED
    )


def reconcile_official(official: DataFrame, derived: DataFrame) -> DataFrame:
    """One official row per club against derived totals; where both lie by league and club, nothing moves."""
    return reconcile(official, derived, LEAGUE + ["team_id"], PAIRED, COMPARED).select(*RECONCILIATION_COLUMNS)


def competition_reconciliation(reconciliation: DataFrame) -> DataFrame:
    """Agreement over all seasons of a competition, and the newest season with a disagreement.

    Rows first become one per league, so a competition with many seasons adds few rows here."""
    agrees = F.coalesce(F.col("is_reconciled"), F.lit(False))
    seasons = reconciliation.groupBy(*LEAGUE).agg(
        F.count(F.lit(1)).alias("teams"), F.count_if(agrees).alias("reconciled"), F.max("snapshot_date").alias("newest")
    )
    whole = F.col("teams") == F.col("reconciled")
    return seasons.groupBy("competition_code").agg(
        F.count(F.lit(1)).alias("seasons"),
        F.count_if(whole).alias("reconciled_seasons"),
        F.sum("teams").alias("teams"),
        F.sum("reconciled").alias("reconciled_teams"),
        F.max(F.when(~whole, F.col("season_id"))).alias("last_unreconciled_season"),
        F.max("newest").alias("newest_snapshot"),
    )


def standings_reconciliation(standings: DataFrame, results: DataFrame) -> DataFrame:
    """Official latest snapshot against totals rebuilt from finished matches."""
    return _reconciled_latest(standings, results).select(*RECONCILIATION_COLUMNS)


def current_standings(standings: DataFrame, results: DataFrame, teams: DataFrame) -> DataFrame:
    """Current official table with club names and reconciliation columns.

    Reconciliation rows are exactly the latest snapshot rows, so they are carried along
    instead of joining the snapshot table to itself.
    """
    clubs = teams.select(
        "competition_code", "team_id", "team_name", "short_name", "tla", "sportsdb_badge_url"
    )
    key = surrogate_key(
        F.col("competition_code"), F.col("season_id"), F.col("team_id"), F.col("snapshot_date")
    )
    return (
        _reconciled_latest(standings, results)
        .join(clubs, ["competition_code", "team_id"])
        .select(
            key.alias("standings_key"),
            "competition_id", *LEAGUE, "snapshot_date", "snapshot_matchday", "team_id",
            "team_name", "short_name", "tla", "sportsdb_badge_url",
            "position", "played", "won", "drawn", "lost", "goals_for", "goals_against",
            "goal_difference", "points", "form",
            "is_reconciled", *[f"{c}_delta" for c in COMPARED],
        )
    )


def table_order(current: DataFrame) -> DataFrame:
    """League by league, by position then club name."""
    return current.orderBy(
        *LEAGUE, F.col("position").asc_nulls_last(), F.col("short_name").asc_nulls_last(), "team_id"
    )


# --- labels --------------------------------------------------------------------


def zone_label(position: Column) -> Column:
    label = F.lit(NO_ZONE)
    for name, first, last in ZONES:
        label = F.when(position.between(first, last), F.lit(name)).otherwise(label)
    return label


def races_of(position: Column) -> Column:
    """Array of the race presets a position belongs to (the ranges overlap)."""
    return F.filter(
        F.array(*[F.when(position.between(lo, hi), F.lit(name)) for name, lo, hi in RACES]),
        lambda name: name.isNotNull(),
    )


def league_table(current: DataFrame) -> DataFrame:
    """Display table: short headings, zone and data status."""
    status = F.when(F.col("is_reconciled"), F.lit(SYNCED)).when(
        ~F.col("is_reconciled"), F.lit(PENDING)
    )
    return table_order(current).select(
        *LEAGUE,
        F.col("position").alias("pos"),
        F.col("sportsdb_badge_url").alias("crest"),
        F.col("short_name").alias("team"),
        F.col("played").alias("p"),
        F.col("won").alias("w"),
        F.col("drawn").alias("d"),
        F.col("lost").alias("l"),
        F.col("goals_for").alias("gf"),
        F.col("goals_against").alias("ga"),
        F.col("goal_difference").alias("gd"),
        F.col("points").alias("pts"),
        zone_label(F.col("position")).alias("zone"),
        status.alias("data"),
    )


# --- reconciliation reports ------------------------------------------------------


def reconciliation_summary(current: DataFrame) -> DataFrame:
    """Teams in total, agreeing and disagreeing; a NULL flag counts only in the total."""
    total = F.count(F.lit(1))
    agreeing = count_where(F.col("is_reconciled"))
    return current.agg(
        total.alias("total_teams"),
        agreeing.alias("reconciled_teams"),
        count_where(~F.col("is_reconciled")).alias("unreconciled_teams"),
        percentage(agreeing, total).alias("reconciliation_rate"),
    )


def reconciliation_detail(current: DataFrame) -> DataFrame:
    return table_order(current).select(
        *LEAGUE, "position", "team_id", "short_name", "played", "points", "is_reconciled",
        *[f"{c}_delta" for c in COMPARED],
    )


def unreconciled(current: DataFrame) -> DataFrame:
    """Clubs whose official totals differ from the finished matches (NULL flags excluded)."""
    return reconciliation_detail(current.filter(~F.col("is_reconciled")))


def snapshot_freshness(standings: DataFrame) -> DataFrame:
    """Per league: number of snapshots, newest snapshot, newest load, highest round.

    Snapshots first collapse to one row each with a hash aggregate; the distinct count and
    the text maximum then see only those.
    """
    snapshots = standings.groupBy(*LEAGUE, "snapshot_date").agg(
        F.max("loaded_at").alias("loaded_at"), F.max("snapshot_matchday").alias("snapshot_matchday")
    )
    return snapshots.groupBy(*LEAGUE).agg(
        F.count("snapshot_date").alias("snapshots"),
        F.max("snapshot_date").alias("latest_snapshot"),
        F.max("loaded_at").alias("latest_load"),
        F.max("snapshot_matchday").alias("latest_matchday"),
    )


# --- highlights and rankings -----------------------------------------------------


def league_highlights(current: DataFrame) -> DataFrame:
    """Leader, best attack and best defence of every league, in one aggregate."""
    club = F.struct("team_id", "short_name", "sportsdb_badge_url", "points", "goals_for", "goals_against")
    last = F.lit(2**31 - 1)

    def low(name: str) -> Column:
        return F.coalesce(F.col(name), last)

    def high(name: str) -> Column:
        return F.coalesce(-F.col(name), last)

    picks = current.groupBy(*LEAGUE).agg(
        F.min_by(club, F.struct(low("position"), "short_name", "team_id")).alias("leader"),
        F.min_by(club, F.struct(high("goals_for"), high("goal_difference"), F.col("team_id"))).alias("attack"),
        F.min_by(club, F.struct(low("goals_against"), high("goal_difference"), F.col("team_id"))).alias("defence"),
    )

    def card(label: str, pick: str, measure: str, unit: str) -> Column:
        value = F.col(f"{pick}.{measure}")
        return F.struct(
            F.lit(label).alias("highlight"),
            F.col(f"{pick}.team_id").alias("team_id"),
            F.col(f"{pick}.short_name").alias("short_name"),
            F.col(f"{pick}.sportsdb_badge_url").alias("sportsdb_badge_url"),
            value.cast("bigint").alias("value"),
            F.concat(value.cast("string"), F.lit(f" {unit}")).alias("value_text"),
        )

    cards = F.array(
        card("League Leader", "leader", "points", "points"),
        card("Best Attack", "attack", "goals_for", "goals"),
        card("Best Defence", "defence", "goals_against", "conceded"),
    )
    return picks.select(*LEAGUE, F.explode(cards).alias("card")).select(*LEAGUE, "card.*")


def first_n(rows: DataFrame, keys: list[str], order: list, n: int, rank_name: str) -> DataFrame:
    """The first n rows per key. The order must end in a unique column.

    The ``<= n`` filter is applied on the map side too (window group limit), so a hot key
    sends at most n rows per input partition.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    return rows.withColumn(rank_name, F.row_number().over(window)).filter(F.col(rank_name) <= n)


def top_of_table(current: DataFrame, n: int = 10) -> DataFrame:
    order = [F.col("position").asc_nulls_last(), F.col("short_name").asc_nulls_last(), F.col("team_id")]
    return first_n(current, LEAGUE, order, n, "row_no").select(
        *LEAGUE, "row_no", "position", "team_id", "short_name", "sportsdb_badge_url",
        "played", "won", "drawn", "lost", "goal_difference", "points",
    )


def top_by_points_per_game(performance: DataFrame, n: int = 10) -> DataFrame:
    order = [F.col("points_per_game").desc_nulls_last(), F.col("team_id")]
    return first_n(performance, LEAGUE, order, n, "row_no").select(
        *LEAGUE, "row_no", "team_id", "short_name", "points_per_game"
    )


def points_race(current: DataFrame) -> DataFrame:
    """Bar-chart orders of the table: points race, goal difference, goals scored (ascending)."""
    league = W.partitionBy(*LEAGUE)
    points, difference, scored = (
        F.col(c).asc_nulls_last() for c in ("points", "goal_difference", "goals_for")
    )
    return current.select(
        *LEAGUE, "team_id", "short_name", "points", "goal_difference", "goals_for",
        F.row_number().over(league.orderBy(points, difference, scored, "team_id")).alias("points_order"),
        F.row_number().over(league.orderBy(difference, "team_id")).alias("goal_difference_order"),
        F.row_number().over(league.orderBy(scored, "team_id")).alias("goals_for_order"),
    )
