"""Tables of a warehouse folder that change together, by numbered commits.

    data/<table>/attempt=<id>/part=<key values>/...   rows, written once and never changed
    manifests/<id>/...                                which attempt holds each part of each table
    commits/<number>.json                             the manifest that is current from then on

A commit writes its parts into an attempt of its own, checks them, writes a manifest of all parts
that are then current, and last creates the next commit file, which must not exist yet. Readers
take the newest commit file and see all of its tables or none of them: a run that fails before
that file leaves them what they had, and parts that no commit names behind, which
``remove_unnamed`` deletes later.

Two writers at once both try to create the next file, and one does. The other looks at what the
first one changed. If their parts differ it tries again on top of that; if they share a part, or
one that the inputs came from (``uses``), it raises ``Conflict``, and the caller starts anew.

A part is the rows with equal values of the table's part keys, such as one league. Commits
replace whole parts; others stay where they are and are not copied. Parts written anew with the
rows they had, but for the time of writing, stay as well, so what differs between two commits is
what has changed. The driver handles the name of a manifest and the attempts that are still
read; parts stay rows of manifests.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchline.operators.contracts import Observed, Rule, failures, gate, gate_counts
from touchline.session import create_once, delete, exists, folders_of, read_text, write_text

MANIFEST = "table_name string, part string, attempt string, row_count bigint, checksum string"
MISSING = "-"
VOLATILE = {"loaded_at"}  # columns that say when a row was written, not what it is


class Conflict(RuntimeError):
    """Another writer has changed what this commit replaces or was computed from."""


@dataclass(frozen=True)
class Commit:
    number: int
    manifest: str
    version: str
    base: int | None = None  # number of the commit, in another folder, that this one follows


def part_of(keys: Iterable[str]) -> Column:
    """A row's part: its key values, a missing one marked, with a sign before each that keeps an
    empty one apart."""
    named = [F.coalesce(F.concat(F.lit("="), F.url_encode(F.col(k).cast("string"))), F.lit(MISSING)) for k in keys]
    return F.concat_ws("/", *named)


def key_value(part: Column, position: int) -> Column:
    """The value of one key, as text, read back from a part."""
    named = F.get(F.split(part, "/"), F.lit(position))
    return F.when(named != MISSING, F.url_decode(F.substring(named, 2, 1 << 30)))


class Store:
    """Tables of one folder, by name: their schemas and the keys of their parts."""

    def __init__(self, spark: SparkSession, root: str, tables: Mapping[str, tuple[StructType | str, list[str]]]):
        self.spark, self.root, self.tables = spark, root, dict(tables)

    # --- reading ------------------------------------------------------------------------

    def _file(self, number: int) -> str:
        return f"{self.root}/commits/{number:012d}.json"

    def newest(self) -> Commit | None:
        """The newest commit. A hint says where to look, the files after it are tried."""
        hint = f"{self.root}/commits/_hint"
        number = int(read_text(self.spark, hint) or 0) if exists(self.spark, hint) else 0
        while exists(self.spark, self._file(number + 1)):
            number += 1
        return self.commit_of(number) if number else None

    def commit_of(self, number: int) -> Commit:
        return Commit(number=number, **json.loads(read_text(self.spark, self._file(number))))

    def manifest(self, commit: Commit | None) -> DataFrame:
        """(table_name, part, attempt, row_count, checksum) of every current part."""
        if commit is None:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifests/{commit.manifest}")

    def parts(self, name: str, commit: Commit | None) -> DataFrame:
        """(part, attempt, row_count, checksum) of one table."""
        return self.manifest(commit).filter(F.col("table_name") == name).drop("table_name")

    def newest_parts(self, name: str, commit: Commit, by: list[str], newest: str) -> DataFrame:
        """For each value of some part keys the part with the greatest value of another one,
        found among the parts' names: no row of the table is read."""
        keys = self.tables[name][1]
        found = self.parts(name, commit).withColumn("age", key_value(F.col("part"), keys.index(newest)))
        groups = [key_value(F.col("part"), keys.index(k)).alias(k) for k in by]
        last = found.filter("age IS NOT NULL").groupBy(*groups).agg(F.max_by("part", "age").alias("part"))
        return found.join(last.select("part"), "part", "left_semi").select("part", "attempt", "row_count")

    def read(self, name: str, commit: Commit | None = None, parts: DataFrame | None = None) -> DataFrame:
        """Rows of a table as of a commit, or of some of its parts.

        Folders are listed for the attempts that hold a wanted part. Within them, parts that the
        commit does not name are pruned while the query runs, by a join on the folder columns.
        """
        commit = commit or self.newest()
        if commit is None:
            raise FileNotFoundError(f"nothing committed under {self.root}")
        wanted = (self.parts(name, commit) if parts is None else parts).filter(F.col("part").isNotNull())
        schema, _ = self.tables[name]
        columns = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).names
        attempts = sorted(r[0] for r in wanted.select("attempt").distinct().collect())
        if not attempts:
            return self.spark.createDataFrame([], schema)
        full = StructType.fromDDL(schema) if isinstance(schema, str) else StructType(list(schema.fields))
        rows = (
            self.spark.read.schema(full.add("attempt", "string").add("part", "string"))
            .option("basePath", f"{self.root}/data/{name}")
            .parquet(*[f"{self.root}/data/{name}/attempt={a}" for a in attempts])
        )
        return rows.join(wanted.select("attempt", "part"), ["attempt", "part"], "left_semi").select(*columns)

    def changed(self, before: Commit | None, after: Commit) -> DataFrame:
        """(table_name, part): parts added, replaced or dropped between two commits."""
        columns = ("table_name", "part", "attempt")
        old, new = (self.manifest(commit).select(*columns) for commit in (before, after))
        return old.exceptAll(new).unionByName(new.exceptAll(old)).select("table_name", "part").distinct()

    # --- writing ------------------------------------------------------------------------

    def _write(self, name: str, rows: DataFrame, attempt: str, rules: list[Rule]) -> tuple[Observed, DataFrame]:
        """Write rows as an attempt, counting broken rules on the way; returns its parts."""
        path = f"{self.root}/data/{name}/attempt={attempt}"
        observed = Observed([r for r in rules if r.model == name])
        parted = observed.watch(rows).withColumn("part", part_of(self.tables[name][1]))
        parted.hint("rebalance", "part").write.partitionBy("part").parquet(path)
        schema, _ = self.tables[name]
        full = StructType.fromDDL(schema) if isinstance(schema, str) else StructType(list(schema.fields))
        written = self.spark.read.schema(full.add("part", "string")).parquet(path)
        # Row counts and sums of row hashes, which do not depend on the order of rows.
        told = F.xxhash64(*[c for c in written.columns if c not in VOLATILE]).cast("decimal(20,0)")
        listed = written.groupBy("part").agg(
            F.count(F.lit(1)).alias("row_count"), F.sum(told).cast("string").alias("checksum")
        )
        return observed, listed.select(
            F.lit(name).alias("table_name"), "part", F.lit(attempt).alias("attempt"), "row_count", "checksum"
        )

    def commit(
        self,
        tables: Mapping[str, DataFrame],
        version: str,
        rules: Iterable[Rule] = (),
        seen: Commit | None = None,
        replaced: DataFrame | None = None,
        uses: DataFrame | None = None,
        context: Mapping[str, DataFrame] | None = None,
        base: int | None = None,
    ) -> Commit:
        """Replace parts of some tables together, if all rules hold.

        The parts of the new rows are replaced, and those listed as ``replaced`` (table_name,
        part), which may end up without rows. ``seen`` is the commit that the inputs were read
        from, ``uses`` (table_name, part) what they depend on besides. Rules on single rows and
        whole tables are counted by the write itself; rules on keys read what was written.
        """
        rules, context = list(rules), context or {}
        fresh, counts, written = [], [], {}
        for name, rows in tables.items():
            attempt = uuid4().hex
            observed, parts = self._write(name, rows, attempt, rules)
            counts += observed.counts()
            fresh.append(parts)
            schema, _ = self.tables[name]
            written[name] = self.spark.read.schema(schema).parquet(f"{self.root}/data/{name}/attempt={attempt}")
        gate_counts(counts)
        rest = [r for r in rules if r.model not in tables or r.kind not in Observed.KINDS]
        if rest:
            gate(failures({**context, **written}, rest))
        return self.note(reduce(DataFrame.unionByName, fresh), version, seen, replaced, uses, base)

    def note(
        self,
        parts: DataFrame,
        version: str,
        seen: Commit | None = None,
        replaced: DataFrame | None = None,
        uses: DataFrame | None = None,
        base: int | None = None,
        forced: bool = False,
    ) -> Commit:
        """Make parts (rows of a manifest) current; their data lie where they say. A ``forced``
        note replaces its parts whoever changed them since."""
        listing = f"{self.root}/manifests/new-{uuid4().hex}"
        parts.select(*StructType.fromDDL(MANIFEST).names).write.parquet(listing)
        new = self.spark.read.schema(MANIFEST).parquet(listing)
        ours = new.select("table_name", "part")
        ours = ours if replaced is None else ours.unionByName(replaced.select("table_name", "part")).distinct()
        guarded = ours if uses is None else ours.unionByName(uses.select("table_name", "part")).distinct()
        while True:
            now = self.newest()
            if now != seen and not forced:
                lost = self.changed(seen, now).join(guarded, ["table_name", "part"], "left_semi").limit(5).collect()
                if lost:
                    names = ", ".join(f"{r['table_name']} {r['part']}" for r in lost)
                    raise Conflict(f"commit {now.number} ({now.version}) changed {names}")
                seen = now
            current = self.manifest(now)
            same = ["table_name", "part", "row_count", "checksum"]
            alike = current.filter(F.col("checksum").isNotNull()).join(new.select(*same), same, "left_semi")
            kept = current.join(ours, ["table_name", "part"], "left_anti").unionByName(alike)
            changed = new.join(alike.select("table_name", "part"), ["table_name", "part"], "left_anti")
            manifest = uuid4().hex
            kept.unionByName(changed).coalesce(1).write.parquet(f"{self.root}/manifests/{manifest}")
            number = now.number + 1 if now else 1
            body = {"manifest": manifest, "version": version, "base": base}
            if create_once(self.spark, self._file(number), json.dumps(body)):
                write_text(self.spark, f"{self.root}/commits/_hint", str(number))
                return Commit(number=number, **body)

    # --- removing -----------------------------------------------------------------------

    def remove_unnamed(self, keep: int = 10, age_seconds: float = 86_400.0) -> list[str]:
        """Delete attempts that none of the newest ``keep`` commits names, and listings that failed
        or finished runs left; returns the deleted folders.

        A run writes its attempt before a commit names it, so folders younger than
        ``age_seconds`` stay: choose it longer than any run. Manifests are small and all kept, so
        commits can still be compared; the rows of older ones may be gone.
        """
        now = self.newest()
        if now is None or keep < 1:
            return []
        kept = [self.commit_of(n) for n in range(max(1, now.number - keep + 1), now.number + 1)]
        paths = [f"{self.root}/manifests/{c.manifest}" for c in kept]
        rows = self.spark.read.schema(MANIFEST).parquet(*paths).select("table_name", "attempt").distinct()
        named = {(r["table_name"], f"attempt={r['attempt']}") for r in rows.collect()}
        gone = []
        for name in self.tables:
            folder = f"{self.root}/data/{name}"
            gone += [f"{folder}/{a}" for a in folders_of(self.spark, folder, age_seconds) if (name, a) not in named]
        listings = f"{self.root}/manifests"
        gone += [f"{listings}/{a}" for a in folders_of(self.spark, listings, age_seconds) if a.startswith("new-")]
        for path in gone:
            delete(self.spark, path)
        return gone
