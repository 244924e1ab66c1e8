"""Direct forms of two operators, to compare results and times with the registered forms.

``python tests/direct_forms.py <table folder>`` prints the median of five warm runs of each.
"""

from __future__ import annotations

import statistics
import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parent.parent)]

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from touchline.operators.performance import team_performance  # noqa: E402
from touchline.operators.rounds import round_status  # noqa: E402

LEAGUE = ["competition_code", "season_id"]


def union_results(matches: DataFrame) -> DataFrame:
    """Participant rows as a union of a home and an away branch (two scans)."""

    def side(venue: str, team: str, other: str, scored: str, conceded: str, won: str, lost: str) -> DataFrame:
        return matches.filter("status = 'FINISHED'").selectExpr(
            f"concat(match_id, '-', {team}_team_id) AS team_match_key",
            "match_id", "competition_id", *LEAGUE, "matchday", "utc_date",
            f"{team}_team_id AS team_id", f"{other}_team_id AS opponent_team_id", f"'{venue}' AS venue",
            f"{scored}_score AS goals_for", f"{conceded}_score AS goals_against",
            f"CASE result WHEN '{won}' THEN 'W' WHEN 'D' THEN 'D' WHEN '{lost}' THEN 'L' END AS team_result",
            f"CASE result WHEN '{won}' THEN 3 WHEN 'D' THEN 1 WHEN '{lost}' THEN 0 END AS points_earned",
            "source_snapshot_date", "loaded_at",
        )

    return side("HOME", "home", "away", "home", "away", "H", "A").unionByName(
        side("AWAY", "away", "home", "away", "home", "A", "H")
    )


def range_join_history(current: DataFrame, matches: DataFrame, results: DataFrame) -> DataFrame:
    """Position history by anti join and equi-plus-range join, without running windows."""
    status = round_status(matches)
    earlier = status.filter("total_matches <> finished_matches").selectExpr(
        "competition_code AS e_code", "season_id AS e_season", "matchday AS e_matchday"
    )
    rounds = (
        status.filter("total_matches = finished_matches")
        .join(
            earlier,
            F.expr("e_code = competition_code AND e_season = season_id AND e_matchday < matchday"),
            "left_anti",
        )
        .select(*LEAGUE, "matchday")
    )
    clubs = current.select(*LEAGUE, "team_id", "short_name", "tla", "sportsdb_badge_url")
    rows = results.selectExpr(
        "competition_code AS r_code", "season_id AS r_season", "team_id AS r_team", "matchday AS r_matchday",
        "match_id", "points_earned", "goals_for AS scored", "goals_against AS conceded",
    )
    totals = (
        rounds.join(clubs, LEAGUE)
        .join(
            rows,
            F.expr(
                "r_code = competition_code AND r_season = season_id AND r_team = team_id AND r_matchday <= matchday"
            ),
            "left",
        )
        .groupBy(*LEAGUE, "matchday", "team_id", "short_name", "tla", "sportsdb_badge_url")
        .agg(
            F.expr("count(match_id) AS played"),
            F.expr("coalesce(sum(points_earned), 0) AS points"),
            F.expr("coalesce(sum(scored), 0) AS goals_for"),
            F.expr("coalesce(sum(conceded), 0) AS goals_against"),
        )
    )
    return totals.selectExpr(
        *LEAGUE, "matchday", "team_id", "short_name", "tla", "sportsdb_badge_url",
        """rank() OVER (PARTITION BY competition_code, season_id, matchday
             ORDER BY points DESC, goals_for - goals_against DESC, goals_for DESC) AS derived_position""",
        "played", "points", "goals_for", "goals_against", "goals_for - goals_against AS goal_difference",
    )


def main(sf_dir: str) -> None:
    import __spark_entry__ as entry
    from touchline.operators.history import position_history
    from touchline.operators.participants import team_match_results
    from touchline.operators.season import fixture_matrix
    from touchline.operators.standings import standings_reconciliation
    from touchline.session import local_session

    spark = local_session()

    def on(build, *names):
        return lambda m: build(*[m[n] for n in names])

    forms = {
        "team_performance, one scan": on(
            lambda m, t: team_performance(team_match_results(m), t), "stg_matches", "stg_teams"
        ),
        "team_performance, two-branch union": on(
            lambda m, t: team_performance(union_results(m), t), "stg_matches", "stg_teams"
        ),
        "position_history, running windows": on(
            position_history, "mart_current_standings", "stg_matches", "int_team_match_results"
        ),
        "position_history, range and anti join": on(
            range_join_history, "mart_current_standings", "stg_matches", "int_team_match_results"
        ),
        "reconciliation": on(standings_reconciliation, "stg_standings", "int_team_match_results"),
        "fixture_matrix": on(fixture_matrix, "stg_matches", "mart_current_standings"),
    }
    for name, build in forms.items():
        times = []
        for _ in range(6):
            start = time.perf_counter()
            build(entry.models(spark, sf_dir)).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        print(f"{name}: {statistics.median(times[1:]):.2f} s", flush=True)


if __name__ == "__main__":
    main(sys.argv[1])
