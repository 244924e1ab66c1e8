"""Season view: the home x away fixture matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.outcomes import match_state
from touchline.functions.text import MISSING_TEXT
from touchline.operators import LEAGUE

BLANK_CELL = "·"
SELF_CELL = MISSING_TEXT


def cell_text(state: Column, home: Column, away: Column) -> Column:
    """Finished ``2–1``, live ``2–1*``, anything else blank."""
    score = F.concat(home.cast("string"), F.lit("–"), away.cast("string"))
    return (
        F.when((state == "Finished") & score.isNotNull(), score)
        .when((state == "Live") & score.isNotNull(), F.concat(score, F.lit("*")))
        .otherwise(F.lit(BLANK_CELL))
    )


def cell_outcome(state: Column, home: Column, away: Column) -> Column:
    """Colour class of a cell, from the numbers rather than the cell text."""
    shown = state.isin("Finished", "Live")
    return (
        F.when(shown & (home > away), F.lit("home win"))
        .when(shown & (home < away), F.lit("away win"))
        .when(shown & (home == away), F.lit("draw"))
        .otherwise(F.lit("blank"))
    )


def fixture_matrix(matches: DataFrame, current: DataFrame) -> DataFrame:
    """One row per home/away pairing that has a fixture, for clubs of the current table.

    Repeated pairings collapse to the latest one in the map-side combine, before the club
    names are joined. (The structs make that combine sort; numbers packed for a hashed one
    took longer when measured.) Pairings without a fixture are not materialised; the wide form fills
    them in as blanks.
    """
    latest = F.struct("utc_date", "match_id")
    fixture = F.struct("status", "home_score", "away_score", "match_id")
    pairs = matches.groupBy(*LEAGUE, "home_team_id", "away_team_id").agg(
        F.max_by(fixture, latest).alias("last")
    )

    def club(side: str) -> DataFrame:
        # The same columns in both roles, so Spark computes the current table once.
        return current.select(
            *LEAGUE,
            F.col("team_id").alias(f"{side}_team_id"),
            F.col("short_name").alias(f"{side}_team"),
            F.col("tla").alias(f"{side}_tla"),
        )

    state = match_state(F.col("last.status"))
    goals = F.col("last.home_score"), F.col("last.away_score")
    return (
        pairs.join(club("home"), [*LEAGUE, "home_team_id"])
        .join(club("away"), [*LEAGUE, "away_team_id"])
        .select(
            *LEAGUE, "home_team_id", "away_team_id", "home_team", "home_tla", "away_team", "away_tla",
            F.col("last.match_id").alias("match_id"),
            cell_text(state, *goals).alias("cell"),
            cell_outcome(state, *goals).alias("outcome"),
        )
    )


def fixture_matrix_slots(matches: DataFrame, current: DataFrame) -> DataFrame:
    """The matrix as one row per home club with its league's cells in an array.

    The clubs of a league have numbered places, by label and then id; ``columns`` names them and
    ``cells`` follows them. A row is as wide as its own league, whatever other leagues there are,
    and no club comes to the driver. Fixtures are blank or marked as in the wide form.
    """
    label = F.coalesce("tla", "short_name", F.col("team_id").cast("string"))
    place = F.row_number().over(Window.partitionBy(*LEAGUE).orderBy("label", "team_id"))
    clubs = current.select(*LEAGUE, "team_id", "short_name", label.alias("label")).withColumn("slot", place)
    named = F.sort_array(F.collect_list(F.struct("slot", "label")))
    columns = clubs.groupBy(*LEAGUE).agg(F.transform(named, lambda c: c["label"]).alias("columns"))
    away = clubs.select(*LEAGUE, F.col("team_id").alias("away_team_id"), "slot")
    cells = (
        fixture_matrix(matches, current)
        .join(away, [*LEAGUE, "away_team_id"])
        .groupBy(*LEAGUE, "home_team_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("slot", "cell"))).alias("known"))
    )
    home = clubs.select(*LEAGUE, F.col("team_id").alias("home_team_id"), F.col("short_name").alias("home_team"), "slot")

    def cell(slot: Column) -> Column:
        return F.coalesce(
            F.try_element_at("known", slot), F.when(slot == F.col("slot"), F.lit(SELF_CELL)).otherwise(F.lit(BLANK_CELL))
        )

    return (
        home.join(columns, LEAGUE)
        .join(cells, [*LEAGUE, "home_team_id"], "left")
        .select(
            *LEAGUE, "home_team_id", "home_team", "slot", "columns",
            F.transform(F.sequence(F.lit(1), F.size("columns")), cell).alias("cells"),
        )
    )


def matrix_columns(current: DataFrame) -> dict[int, str]:
    """Away columns of the wide matrix: club id -> label, by label.

    The label is the code, or else the short name or the id; clubs sharing a label get their
    id added. One row per club comes to the driver: it is the width of the table asked for.
    """
    label = F.coalesce("tla", "short_name", F.col("team_id").cast("string"))
    rows = current.groupBy("team_id").agg(F.min(label).alias("label")).orderBy("label", "team_id").collect()
    shared = {row["label"] for row, after in zip(rows, rows[1:]) if row["label"] == after["label"]}
    return {
        row["team_id"]: f"{row['label']} ({row['team_id']})" if row["label"] in shared else row["label"] for row in rows
    }


def fixture_matrix_wide(matches: DataFrame, current: DataFrame, columns: dict[int, str]) -> DataFrame:
    """The matrix as a table: one row per home club, one column per away club.

    Columns are clubs, by id; codes are labels only, so clubs without a code or with the same
    code keep their results. Every club of the table has a row; cells without a fixture are
    blank and a club against itself is marked.
    """
    cells = (
        fixture_matrix(matches, current)
        .groupBy(*LEAGUE, "home_team_id")
        .pivot("away_team_id", list(columns))
        .agg(F.first("cell"))
    )
    clubs = current.select(
        *LEAGUE, F.col("team_id").alias("home_team_id"), F.col("short_name").alias("home_team")
    )
    shown = [
        F.coalesce(
            F.col(f"`{club}`"),
            F.when(F.col("home_team_id") == club, F.lit(SELF_CELL)).otherwise(F.lit(BLANK_CELL)),
        ).alias(label)
        for club, label in columns.items()
    ]
    return clubs.join(cells, [*LEAGUE, "home_team_id"], "left").select(
        *LEAGUE, "home_team_id", "home_team", *shown
    )
