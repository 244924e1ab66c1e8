"""Secret scan with corpus-wide ownership of every candidate, in DataFrame functions only.

Candidates are found in every whole text: assignments, access keys and long hex runs (base),
and long runs of mixed characters that may be credentials. Their hashes are counted over the
whole corpus by distinct repositories and owners. A value that many owners carry, or few in very
many repositories, is a copied example; a mixed run held by few owners in few repositories looks
live and is added as a span of kind ``live``.

Spans are code point offsets, end exclusive. Null texts have no span; a null owner or
repository counts as one of its own; repeated rows are scanned and returned one by one; an
empty table gives an empty result. The work on one text grows with its length and its number of
spans. Nothing is collected per value: counts combine on the map
side, and verdicts are joined on (value, salt), so a value found in a third of all rows is
spread over ``salts`` tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import staged, text_or_empty

# Fixed patterns of the base kinds, in listed order: kind, pattern, value group, least length.
BASE_KINDS = [
    (
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]
# Cheap patterns telling whether a text can hold a span of the kind at all.
HINTS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]""",
    "access": r"AKIA[A-Z0-9]{16}",
    "hex": r"[0-9a-f]{24}",
    "live": r"[A-Za-z0-9+/_=-]{20}",
}
LIVE = ("live", r"[A-Za-z0-9+/_=-]{20,}", 0, 20)
LIVE_DISTINCT = 10  # distinct characters of a live-looking value, at least
MAX_OWNERS = 2  # owners of a live-looking value, at most
MAX_REPOSITORIES = 50  # repositories of a live-looking value, at most
SALTS = 16
CHUNK = 64  # matches of a text placed by one fold
CUT = 4096  # code points looked through for the ends of a gap between spans
PLACEHOLDER = "[secret]"
Step = Callable[[Column, Column], Column]
SPAN = "array<struct<start:int,rank:int,kind:string,end:int,value:string>>"


def running(rows: Column, forward: Step, emit: Step, kind: str) -> Column:
    """``emit(at, row)`` of every row in order, where ``at`` is ``forward`` folded over the rows before it, from 0.

    Appending to an array copies it, so rows are taken in chunks: one fold finds where each chunk
    begins, and then each chunk's elements (an array of type ``kind``) are made apart.
    """

    def over(every: Column) -> Column:
        def part(n: Column) -> Column:
            return F.slice(every, n * CHUNK + 1, F.lit(CHUNK))

        def enter(state: Column, n: Column) -> Column:
            here = F.struct(n.alias("n"), state["at"].alias("at"))
            after = F.aggregate(part(n), state["at"], forward)
            return F.struct(after.alias("at"), F.concat(state["found"], F.array(here)).alias("found"))

        def made(entry: Column) -> Column:
            def step(state: Column, row: Column) -> Column:
                grown = F.concat(state["found"], F.array(emit(state["at"], row)))
                return F.struct(forward(state["at"], row).alias("at"), grown.alias("found"))

            zero = F.struct(entry["at"].alias("at"), F.array().cast(kind).alias("found"))
            return F.aggregate(part(entry["n"]), zero, step)["found"]

        none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<n:int,at:int>>").alias("found"))
        numbers = F.sequence(F.lit(0), (F.size(every) / CHUNK).cast("int"))
        return F.flatten(F.transform(F.aggregate(numbers, none, enter)["found"], made))

    # An array of one, so that the rows are made once and not for every chunk.
    return F.transform(F.array(rows), over)[0]


def _spans(text: Column, rank: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """Matches of a pattern with their places: text between matches, matches and values run
    side by side, and their lengths add up."""
    between = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole

    def forward(at: Column, x: Column) -> Column:
        return at + F.length(x["between"]) + F.length(x["whole"])

    def emit(at: Column, x: Column) -> Column:
        return F.struct(
            (at + F.length(x["between"])).alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
            forward(at, x).alias("end"), F.coalesce(x["value"], F.lit("")).alias("value"),
        )

    rows = F.arrays_zip(
        F.slice(between, F.lit(1), F.size(whole)).alias("between"), whole.alias("whole"), value.alias("value")
    )
    found = F.filter(running(rows, forward, emit, SPAN), lambda s: F.length(s["value"]) >= least)
    return F.when(text.rlike(HINTS[kind]), found).otherwise(F.array().cast(SPAN))


def _live_looking(span: Column) -> Column:
    value = span["value"]
    return (
        value.rlike("[0-9]")
        & value.rlike("[A-Za-z]")
        & (F.size(F.array_distinct(F.split(value, ""))) >= LIVE_DISTINCT)
    )


def candidates(text: Column) -> Column:
    """All candidate spans of a text, base kinds first; unordered."""
    found = [_spans(text, rank, *kind) for rank, kind in enumerate(BASE_KINDS)]
    live = F.filter(_spans(text, len(BASE_KINDS), *LIVE), _live_looking)
    return F.concat(*found, live)


def ownership(found: DataFrame) -> DataFrame:
    """Rows (value_hash, owner, repository) -> value_hash, n_found, n_repositories, n_owners."""
    each = found.groupBy("value_hash", "owner", "repository").agg(F.count("*").alias("n"))
    owners = each.groupBy("value_hash", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("n_repositories"))
    return owners.groupBy("value_hash").agg(
        F.sum("n").alias("n_found"),
        F.sum("n_repositories").alias("n_repositories"),
        F.count("*").alias("n_owners"),
    )


def judged(found: DataFrame, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """``found`` (row_id, owner, repository, span) with the verdict on each span's value: specific
    if few owners hold it, and these in few repositories."""
    few = (F.col("n_owners") <= max_owners) & (F.col("n_repositories") <= max_repositories)
    hashed = found.withColumn("value_hash", F.sha2(F.col("span.value"), 256)).withColumn(
        "salt", F.pmod(F.xxhash64("row_id"), F.lit(SALTS))
    )
    verdicts = (
        ownership(hashed)
        .select("value_hash", "n_repositories", "n_owners", few.alias("specific"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    )
    return hashed.join(verdicts, ["value_hash", "salt"])


def _rows(docs: DataFrame, text: str, owner: str, repository: str, carry: Column | None) -> DataFrame:
    cells = {
        "owner": F.col(owner).cast("string"),
        "repository": F.col(repository).cast("string"),
        "spans": candidates(text_or_empty(F.col(text))),
    }
    if carry is not None:
        cells["carry"] = carry
    return docs.select(*[value.alias(name) for name, value in cells.items()])


def _decided(rows: DataFrame, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """row_id, spans (base and live) by start, then kind, and counts of verdicts."""
    found = rows.filter(F.size("spans") > 0).select(
        "row_id", "owner", "repository", F.explode("spans").alias("span")
    )
    base = F.col("span.rank") < len(BASE_KINDS)
    return (
        judged(found, max_owners, max_repositories)
        .groupBy("row_id")
        .agg(
            F.sort_array(
                F.collect_list(F.when(base | F.col("specific"), F.struct("span.start", "span.rank", "span.kind", "span.end")))
            ).alias("spans"),
            F.count_if(base & F.col("specific")).alias("n_specific"),
            F.count_if(base & ~F.col("specific")).alias("n_copied"),
            F.max("n_owners").alias("most_owners"),
            F.max("n_repositories").alias("most_repositories"),
        )
    )


def scan(
    docs: DataFrame,
    text: str = "text",
    owner: str = "source",
    repository: str = "doc_id",
    keep: tuple[str, ...] = ("doc_id",),
    max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """One row per document: ``keep`` columns (as struct ``kept``), spans and verdict counts."""
    rows = staged(
        _rows(docs, text, owner, repository, F.struct(*keep)).withColumn("row_id", F.monotonically_increasing_id())
    )
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")
    zero = F.lit(0).cast("long")
    return rows.select("row_id", F.col("carry").alias("kept")).join(_decided(rows, max_owners, max_repositories), "row_id", "left").select(
        "kept",
        F.coalesce("spans", none).alias("spans"),
        F.coalesce("n_specific", zero).alias("n_specific"),
        F.coalesce("n_copied", zero).alias("n_copied"),
        F.coalesce("most_owners", zero).alias("most_owners"),
        F.coalesce("most_repositories", zero).alias("most_repositories"),
    )


def replaced(text: Column, spans: Column) -> Column:
    """The text with a placeholder for each run of overlapping spans, which are sorted by start.

    Gaps are cut out of equal pieces of the text, not counted off from its beginning each time.
    """

    def gap(pieces: Column, start: Column, end: Column) -> Column:
        first, last = F.floor(start / CUT).cast("int"), F.floor(end / CUT).cast("int")
        near = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
        return F.substring(near, start - first * CUT + 1, end - start)

    def forward(at: Column, span: Column) -> Column:
        return F.greatest(at, span["end"])

    def over(pieces: Column) -> Column:
        def emit(at: Column, span: Column) -> Column:
            fresh = F.concat(gap(pieces, at, span["start"]), F.lit(PLACEHOLDER))
            return F.when(span["start"] >= at, fresh).otherwise("")

        past = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(running(spans, forward, emit, "array<string>"), ""), gap(pieces, past, F.length(text)))

    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))
    return F.transform(F.array(pieces), over)[0]


def redact(docs: DataFrame, text: str = "text", owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """The documents with every base and live span replaced by a placeholder.

    Only documents with a candidate take part in the joins; the others pass as they are.
    """
    columns = docs.columns
    body = text_or_empty(F.col(text))
    hinted = body.rlike(HINTS["live"]) | body.rlike(HINTS["assign"])  # the other kinds imply the first
    clean = docs.filter(~hinted)
    rows = staged(
        _rows(docs.filter(hinted), text, owner, repository, F.struct("*")).withColumn(
            "row_id", F.monotonically_increasing_id()
        )
    )
    joined = rows.select("row_id", "carry").join(_decided(rows), "row_id", "left")
    old = F.col("carry").getField(text)
    new = F.when(F.size("spans") > 0, replaced(old, F.col("spans"))).otherwise(old)
    cells = joined.withColumn("redacted", new)
    changed = {text: F.col("redacted")}
    if "n_chars" in columns:
        changed["n_chars"] = F.when(F.size("spans") > 0, F.length("redacted").cast(docs.schema["n_chars"].dataType)).otherwise(
            F.col("carry.n_chars")
        )
    out = cells.select(*[changed.get(c, F.col("carry").getField(c)).alias(c) for c in columns])
    return clean.unionByName(out)


def digest(scanned: DataFrame) -> DataFrame:
    """The counted columns of ``scan``: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    base = F.filter("spans", lambda s: s["rank"] < len(BASE_KINDS))

    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind, *_ in BASE_KINDS]
    return scanned.select(
        F.col("kept.doc_id").alias("doc_id"),
        *counts,
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        "n_specific",
        "n_copied",
        "most_owners",
        "most_repositories",
    )
