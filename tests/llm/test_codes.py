"""Vector codes against plain Lloyd rounds in Python integers."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from touchline.llm import codes
from touchline.llm.common import prepare

SCHEMA = "vec_id long, embedding array<float>, label int, code string, x int"


@pytest.fixture(scope="module")
def vectors_of(spark):
    prepare(spark)
    return lambda rows: spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def brute(rows, parts=16, entries=64, rounds=2):
    rows = [r for r in rows if r[1] and all(v is not None and math.isfinite(v) for v in r[1])]
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0], r[1]))
    width = len(rows[0][1]) // parts
    vectors = [[[math.floor(256 * v) for v in r[1][p * width : (p + 1) * width]] for p in range(parts)] for r in rows]
    books = [[v[p] for v in vectors[:entries]] for p in range(parts)]

    def assigned():
        return [
            [min((sum((a - b) ** 2 for a, b in zip(v[p], e)), k) for k, e in enumerate(books[p])) for p in range(parts)]
            for v in vectors
        ]

    for _ in range(rounds):
        found = assigned()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [v[p] for v, f in zip(vectors, found) if f[p][1] == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    found = assigned()
    errors, total = [sum(d for d, _ in f) for f in found], Counter()
    for r, e in zip(rows, errors):
        total[r[2]] += e
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return [(r[0], "".join(f"{k:02x}" for _, k in f), e, total[r[2]], sha) for r, f, e in zip(rows, found, errors)]


def vectors(n, seed, spread=1.0, length=32):
    """Vectors around few centres, many equal, so that entries stay fixed and ties are common."""
    rng = random.Random(seed)
    centres = [[rng.choice([-spread, 0.0, spread / 2, spread]) for _ in range(length)] for _ in range(9)]
    out = []
    for i in range(n):
        v = [float(np.float32(c + (rng.random() - 0.5) / 40 * (i % 3))) for c in rng.choice(centres)]
        out.append((i, v, rng.choice([None, 1, 2])))
    return out


@pytest.mark.parametrize("spread", [1.0, 3e5])
def test_digest_equals_brute_force(vectors_of, spread):
    rows = vectors(300, 1, spread)
    rows += [(500, None, 1), (501, [], 1), (502, [1.0] * 31 + [float("nan")], 1), (503, [float("inf")] + [0.0] * 31, 1)]
    rows += [(504, [None] + [0.0] * 31, 2), (7, rows[8][1], 3), (7, rows[8][1], 3), (None, [0.5] * 32, None)]
    got = codes.digest(vectors_of(rows))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(rows), key=repr)


def test_few_and_no_vectors(vectors_of):
    rows = vectors(5, 2, length=16)
    assert sorted(map(tuple, codes.digest(vectors_of(rows)).collect())) == sorted(brute(rows))
    assert codes.digest(vectors_of([])).collect() == []
    assert codes.digest(vectors_of([(1, None, 1)])).columns == codes.digest(vectors_of(rows)).columns
    uneven = [(0, [1.0] * 18, 1), (1, [1.0] * 18, 1), (2, [2.0] * 17, 1)]
    assert [(r["vec_id"], r["error"]) for r in codes.digest(vectors_of(uneven)).orderBy("vec_id").collect()] == [(0, 0), (1, 0)]
    huge = [(0, [3e38] * 16, 1), (1, [-3e38] * 16, 1), (2, [0.0] * 16, 1)]
    assert codes.digest(vectors_of(huge)).count() == 3


def test_only_moved_entries_are_compared():
    rng = np.random.default_rng(4)
    for _ in range(30):
        x = rng.integers(-6, 6, (200, 3, 2))
        before = rng.integers(-6, 6, (3, 20, 2))
        after, moved = before.copy(), rng.random((3, 20)) < 0.2
        after[moved] += rng.integers(-2, 3, (int(moved.sum()), 2))
        moved = (after != before).any(axis=2)
        code, held, computed = codes.renewed(x, *codes.nearest(x, before), after, moved)
        want, dist = codes.nearest(x, after)
        assert (code == want).all() and (held == dist).all()
        first = codes.nearest(x, before)[0]
        # Every part meets the moved entries; only those whose entry moved meet the others too.
        rescans = sum(int(m[c].sum()) * int((~m).sum()) for m, c in zip(moved, first.T))
        assert computed == len(x) * int(moved.sum()) + rescans


def test_distances_are_exact():
    rng = np.random.default_rng(5)
    for most in (10, 1 << 27):
        x, e = rng.integers(-most, most, (50, 4)), rng.integers(-most, most, (9, 4))
        want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, s)) for s in e] for r in x]
        assert codes.distances(x, e).tolist() == want
    for length in (1, 2, 16, 64, 1000, 4096):
        assert length * (2 * codes.limit(length)) ** 2 < 1 << 63
