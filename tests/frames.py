"""Small hand-made league tables."""

from __future__ import annotations

from touchline.schemas import DIM_TEAM, FACT_MATCH, FACT_STANDING_SNAPSHOT, column_names


def _rows(ddl: str, rows: list[dict], defaults: dict) -> list[tuple]:
    return [tuple({**defaults, **row}.get(c) for c in column_names(ddl)) for row in rows]


def matches(spark, rows: list[dict]):
    defaults = {"competition_id": 1, "competition_code": "PD", "season_id": 1, "stage": "REGULAR_SEASON"}
    return spark.createDataFrame(_rows(FACT_MATCH, rows, defaults), FACT_MATCH)


def match(number, matchday, home, away, score=None, status="FINISHED", result="auto", **more):
    """A match row; ``score`` is a pair or None."""
    h, a = score if score else (None, None)
    if result == "auto":
        result = None
        if status == "FINISHED" and score:
            result = "H" if h > a else "A" if h < a else "D"
    return {
        "match_id": number, "matchday": matchday, "home_team_id": home, "away_team_id": away,
        "home_score": h, "away_score": a, "status": status, "result": result, **more,
    }


def teams(spark, ids, competition="PD"):
    rows = [
        {
            "team_id": i, "team_name": f"Club {i}", "short_name": f"C{i}", "tla": f"T{i}",
            "sportsdb_team_id": str(1000 + i), "sportsdb_team_name": f"Club {i}",
            "sportsdb_badge_url": f"b{i}", "sportsdb_source": "TheSportsDB",
            "sportsdb_resolution_method": "ID_OVERRIDE",
        }
        for i in ids
    ]
    return spark.createDataFrame(_rows(DIM_TEAM, rows, {"competition_code": competition}), DIM_TEAM)


def standing(team, position, played=0, won=0, drawn=0, lost=0, gf=0, ga=0, points=0, date="2026-08-31", **more):
    return {
        "team_id": team, "position": position, "played": played, "won": won, "drawn": drawn, "lost": lost,
        "goals_for": gf, "goals_against": ga, "goal_difference": gf - ga if None not in (gf, ga) else None,
        "points": points, "snapshot_date": date, **more,
    }


def standings(spark, rows: list[dict]):
    defaults = {"competition_id": 1, "competition_code": "PD", "season_id": 1, "snapshot_matchday": 3}
    return spark.createDataFrame(
        _rows(FACT_STANDING_SNAPSHOT, rows, defaults), FACT_STANDING_SNAPSHOT
    )
