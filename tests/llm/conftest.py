from __future__ import annotations

import pytest
from pyspark.sql import DataFrame

from touchline.llm.common import prepare

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows, with a clashing column."""
    prepare(spark)

    def make(rows) -> DataFrame:
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x") for r in rows]
        extra = "score string" if not rows or len(rows[0]) < 4 else f"{rows[0][3]} string"
        return spark.createDataFrame(full, f"{DOCS}, {extra}")

    return make


@pytest.fixture(scope="session")
def words():
    """Pseudo-random words."""
    import random

    def make(n: int, seed: int, letters: str = "abcdefghijklmnopqrstuvwxyz") -> list[str]:
        rng = random.Random(seed)
        return ["".join(rng.choice(letters) for _ in range(rng.randint(3, 9))) for _ in range(n)]

    return make
