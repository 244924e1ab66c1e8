"""Compare every registered query with its SQL: ``python tests/run_oracle.py <table folder> [names]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

import compare  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from touchline.session import local_session  # noqa: E402


def main(sf_dir: str, names: list[str]) -> int:
    spark = local_session()
    con = compare.connect(sf_dir)
    sql = entry.oracle_sql()
    wrong = 0
    for name, query in entry.queries().items():
        if names and name not in names or name not in sql:
            continue
        start = time.time()
        got = compare.spark_rows(query(spark, sf_dir))
        seconds = time.time() - start
        want = compare.duckdb_rows(con, sql[name])
        same = got == want
        wrong += not same
        print(f"{'ok ' if same else 'BAD'} {name} {len(got[1])} rows {seconds:.2f} s", flush=True)
        if not same:
            print("  columns", set(got[0]) ^ set(want[0]))
            print("  spark only", sorted(set(got[1]) - set(want[1]), key=repr)[:2])
            print("  sql only", sorted(set(want[1]) - set(got[1]), key=repr)[:2])
    print(f"{wrong} wrong")
    return wrong


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
