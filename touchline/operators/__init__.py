"""DataFrame operators: DataFrames in, one lazy DataFrame out."""

LEAGUE = ["competition_code", "season_id"]
