"""League analytics as lazy PySpark DataFrame operators.

Everything is keyed by ``(competition_code, season_id)`` so one job serves any
number of competitions and seasons.
"""
