"""Near duplicates: b-bit MinHash signatures and a multi-index Hamming join, confirmed on sets.

A document's set is its distinct shingles of ``width`` words. Documents with equal sets form a
class, represented once. Each class gets ``POSITIONS`` minimum hashes of 16 bits. The number of
positions in which two signatures may differ is set four standard deviations above what the
threshold implies; by the pigeonhole principle a pair within that distance has, among
distance / 2 chunks of the signature, one chunk with at most one error. Each chunk is therefore
indexed once per position left out, and a pair within the distance always shares a key.

Buckets never emit all pairs. First every member is paired with the bucket's smallest and
largest member; confirmed links give components. Then only pairs across components are left:
within a bucket, members outside its most frequent component meet the members of other
components, unless shingles that no other member has rule a link out. Buckets with many such
pairs are checked in blocks of members, without a row per pair. A pair inside one component
needs no check, so no component is lost, and each link used has been confirmed on full sets.

Texts that are null or without words have no set and are linked with nothing. Texts with fewer
words than ``width`` have one shingle. Repeated rows fall into one class and are returned one
by one; a null id is never a component's id unless all its ids are null; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from touchline.llm.common import fresh, staged
from touchline.llm.components import components
from touchline.llm.words import WHITE, mix64, word_column

POSITIONS = 64
DOC_BITS = 12  # documents of one slice; the other bits of a sort key hold the shingle
SLICE = 1 << DOC_BITS
BLOCK = 1 << 16
WIDTH, PERCENT = 5, 80
SALTS = (0x51ED270B, 0xB5297A4D)  # of the two hashes that identify a set
FIRST_KEYS = 4  # of a signature's keys, in the first search across components
DENSE = 1024  # pairs across components in a bucket, above which they are checked in blocks
BLOCK_MEMBERS = 256
BLOCK_SHINGLES = 4096  # of a set, above which blocks have fewer members

# Keys in an order that spreads over the chunks.
POSITION_ORDER = np.arange(POSITIONS) * 29 % POSITIONS

_FACTORS = np.random.default_rng(7).integers(0, 1 << 63, POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass(frozen=True)
class Plan:
    """Allowed signature distance for a threshold, and the chunks that guarantee it."""

    percent: int

    @property
    def distance(self) -> int:
        miss = 1 - self.percent / 100
        return min(POSITIONS, math.ceil(POSITIONS * miss + 4 * math.sqrt(POSITIONS * miss * (1 - miss))))

    @property
    def chunks(self) -> list[np.ndarray]:
        return np.array_split(np.arange(POSITIONS), (self.distance + 2) // 2)


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of at most SLICE texts, and where each text's begin."""
    words, doc = word_column(texts, WHITE)
    n = len(texts)
    first = np.searchsorted(doc, np.arange(n + 1))
    many = np.diff(first)
    rows, values = [], []
    for length in range(1, width + 1):
        if length < width:
            at = first[:-1][many == length]
        else:
            at = np.flatnonzero(doc[: len(doc) - width + 1] == doc[width - 1 :]) if len(doc) >= width else np.zeros(0, np.int64)
        if len(at):
            h = np.full(len(at), length, np.uint64)
            for k in range(length):
                h = mix64(h * np.uint64(0xC2B2AE3D27D4EB4F) + words[at + k])
            rows.append(doc[at])
            values.append(h)
    if not rows:
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    keys = np.concatenate(rows).astype(np.uint64) << np.uint64(64 - DOC_BITS)
    keys |= np.concatenate(values) >> np.uint64(DOC_BITS)
    keys.sort()
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    owner = (keys >> np.uint64(64 - DOC_BITS)).astype(np.int64)
    return keys & np.uint64((1 << (64 - DOC_BITS)) - 1), np.searchsorted(owner, np.arange(n + 1))


def signatures(shingles: np.ndarray, places: np.ndarray) -> np.ndarray:
    """16-bit minimum hashes of non-empty sets: one row per set."""
    n = len(places) - 1
    out = np.empty((n, POSITIONS), np.uint16)
    mixed = mix64(shingles + np.uint64(1))
    at = 0
    while at < n:  # as many sets as fit the cache
        to = max(at + 1, int(np.searchsorted(places, places[at] + BLOCK, "right")) - 1)
        part, starts = mixed[places[at] : places[to]], places[at:to] - places[at]
        for k, factor in enumerate(_FACTORS):
            least = np.minimum.reduceat((part * factor) >> np.uint64(32), starts)
            out[at:to, k] = mix64(least + np.uint64(k << 32)).astype(np.uint16)
        at = to
    return out


def _sums(values: np.ndarray, places: np.ndarray, salt: int) -> np.ndarray:
    return np.add.reduceat(mix64(values ^ np.uint64(salt)), places).view(np.int64)


def _binary(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _signed(width: int):
    """(doc_id, body, text) -> (doc_id, body, n, h1, h2, signature)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, SLICE):
                batch = whole.slice(begin, SLICE)
                values, places = shingle_sets(batch["text"], width)
                n = np.diff(places)
                full = np.flatnonzero(n)
                h1, h2 = np.zeros((2, len(n)), np.int64)
                rows = np.zeros((len(n), POSITIONS), np.uint16)
                if len(full):
                    h1[full], h2[full] = (_sums(values, places[full], salt) for salt in SALTS)
                    rows[full] = signatures(values, np.append(places[full], len(values)))
                columns = [batch["doc_id"], batch["body"], pa.array(n), pa.array(h1), pa.array(h2), _binary(rows)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "body", "n", "h1", "h2", "signature"])

    return run


def keys_of(rows: np.ndarray, plan: Plan) -> np.ndarray:
    """The keys of signatures, one per position left out of its chunk, in search order."""
    out = np.empty((len(rows), POSITIONS), np.uint64)
    for chunk in plan.chunks:
        for left_out in chunk:
            key = np.full(len(rows), int(left_out) + 1, np.uint64)
            for k in chunk[chunk != left_out]:
                key = mix64(key * np.uint64(0xC2B2AE3D27D4EB4F) + rows[:, k].astype(np.uint64))
            out[:, POSITION_ORDER[left_out]] = key
    return out


def _keyed(plan: Plan):
    """(cid, signature) -> (number, key, cid), one per key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = keys_of(_matrix(batch["signature"]), plan).view(np.int64)
            for number in range(POSITIONS):
                columns = [pa.array(np.full(len(keys), number, np.int32)), pa.array(keys[:, number].copy()), batch["cid"]]
                yield pa.RecordBatch.from_arrays(columns, ["number", "key", "cid"])

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, POSITIONS)


def _differences(a: pa.Array, b: pa.Array) -> pa.Array:
    if not len(a):
        return pa.array([], pa.int32())
    return pa.array((_matrix(a) != _matrix(b)).sum(axis=1).astype(np.int32))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, and where each list begins."""
    places = column.offsets.to_numpy()
    return column.values.to_numpy(), places


def _shared(a: pa.Array, b: pa.Array) -> pa.Array:
    """Size of the intersection of two sorted sets, row by row."""
    (x, at), (y, by) = _lists(a), _lists(b)
    out = np.zeros(len(a), np.int64)
    for i in range(len(a)):
        both = np.concatenate([x[at[i] : at[i + 1]], y[by[i] : by[i + 1]]])
        both.sort()
        out[i] = np.count_nonzero(both[1:] == both[:-1])
    return pa.array(out)


_differences.__annotations__ = _shared.__annotations__ = {"a": pa.Array, "b": pa.Array, "return": pa.Array}


def _set_column(width: int):
    """(cid, h1, h2, text) -> (cid, shingles), for the rows whose text has the class's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, SLICE):
                batch = whole.slice(begin, SLICE)
                values, places = shingle_sets(batch["text"], width)
                h1, h2 = np.zeros((2, batch.num_rows), np.int64)
                full = np.flatnonzero(np.diff(places))
                if len(full):
                    h1[full], h2[full] = (_sums(values, places[full], salt) for salt in SALTS)
                same = (h1 == batch["h1"].to_numpy()) & (h2 == batch["h2"].to_numpy())
                sets = pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), pa.array(values.view(np.int64)))
                at = pa.array(np.flatnonzero(same))
                yield pa.RecordBatch.from_arrays([batch["cid"].take(at), sets.take(at)], ["cid", "shingles"])

    return run


def _sets(members: DataFrame, classes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(cid) -> (cid, shingles), computed anew from one document of each class."""
    whose = classes.join(members, "cid").select("cid", F.col("doc_id").alias("rep"), "h1", "h2")
    texts = docs.join(whose, docs["doc_id"].eqNullSafe(whose["rep"])).select("cid", "h1", "h2", "text")
    return texts.mapInArrow(_set_column(width), "cid long, shingles array<long>")


def confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame, plan: Plan) -> DataFrame:
    """Pairs (u, v) of classes that are within the signature distance and, on full sets, linked."""
    side = classes.select("cid", "n", "signature")
    u, v = (side.toDF(name, f"n_{name}", f"s_{name}") for name in ("u", "v"))
    percent = plan.percent
    sizes = 100 * F.least("n_u", "n_v") >= percent * F.greatest("n_u", "n_v")
    near = F.arrow_udf(_differences, "int")(F.col("s_u"), F.col("s_v")) <= plan.distance
    close = pairs.join(u, "u").join(v, "v").filter(sizes).filter(near).select("u", "v", "n_u", "n_v")
    a, b = (sets.toDF(name, f"set_{name}") for name in ("u", "v"))
    shared = F.arrow_udf(_shared, "long")(F.col("set_u"), F.col("set_v"))
    linked = close.join(a, "u").join(b, "v").select("u", "v", (F.col("n_u") + F.col("n_v")).alias("n"), shared.alias("shared"))
    return linked.filter(100 * F.col("shared") >= percent * (F.col("n") - F.col("shared"))).select("u", "v")


def _mixed(buckets: DataFrame, stars: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components: number, key, cid, comp, ``most``
    (the component with most members), the bucket's size, how ``few`` members are not of that
    component, and if it has many pairs to check."""
    marked = buckets.join(stars.withColumnRenamed("node", "cid"), "cid", "left").select(
        "number", "key", "cid", F.coalesce("root", "cid").alias("comp")
    )
    counts = marked.groupBy("key", "comp").agg(F.count("*").alias("n"))
    # The size above the id, in one number, which unlike a struct needs no sort.
    id_range = F.lit("1" + "0" * 19).cast("decimal(20,0)")
    ranked = F.col("n").cast("decimal(18,0)") * id_range + F.col("comp")
    largest = counts.groupBy("key").agg(
        (F.max(ranked) % id_range).cast("long").alias("most"),
        F.sum("n").alias("size"),
        (F.sum("n") - F.max("n")).alias("few"),
        (F.sum("n") * (F.sum("n") - F.max("n")) > DENSE).alias("dense"),
        F.count("*").alias("comps"),
    )
    return marked.join(largest.filter(F.col("comps") > 1).drop("comps"), "key")


def _own(cids: DataFrame, sets: DataFrame) -> DataFrame:
    """(cid) -> (cid, own): how many of its shingles no other of them has."""
    each = sets.join(cids, "cid").select("cid", F.explode("shingles").alias("shingle"))
    alone = each.groupBy("shingle").agg(F.count("*").alias("n"), F.min("cid").alias("cid")).filter("n = 1")
    return alone.groupBy("cid").agg(F.count("*").alias("own"))


def _possible(n: Column, sharable: Column, other_n: Column, other_sharable: Column, percent: int) -> Column:
    """Whether a pair can reach the threshold: shingles no other member has are not shared."""
    common = F.least(sharable, other_sharable)
    return 100 * common >= percent * (n + other_n - common)


def _across(mixed: DataFrame, facts: DataFrame, tested: DataFrame, plan: Plan) -> DataFrame:
    """Pairs of bucket members in different components that may be linked, and are not tested."""
    known = mixed.join(facts.select("cid", "n", "sharable"), "cid")
    few = known.filter(F.col("comp") != F.col("most")).select(
        "key", F.col("cid").alias("x"), F.col("comp").alias("cx"), F.col("n").alias("nx"), F.col("sharable").alias("mx")
    )
    every = known.select(
        "key", "most", F.col("cid").alias("y"), F.col("comp").alias("cy"), F.col("n").alias("ny"), F.col("sharable").alias("my")
    )
    # Of two members outside the largest component, the smaller id leads.
    once = (F.col("cy") == F.col("most")) | (F.col("x") < F.col("y"))
    possible = _possible(F.col("nx"), F.col("mx"), F.col("ny"), F.col("my"), plan.percent)
    pairs = few.join(every, "key").filter((F.col("cx") != F.col("cy")) & once & possible)
    pairs = pairs.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct()
    return pairs.join(tested, ["u", "v"], "left_anti")


class _Block:
    """Members of a block row as arrays."""

    def __init__(self, column: pa.Array, row: int):
        rows = column.values.slice(column.offsets[row].as_py(), column.offsets[row + 1].as_py() - column.offsets[row].as_py())
        self.cid, self.comp, self.n, self.sharable = (
            rows.field(i).to_numpy() for i in range(4)
        )
        self.signatures = _matrix(rows.field(4))
        self.values, self.places = _lists(rows.field(5))

    def shingles(self, i: int) -> np.ndarray:
        return self.values[self.places[i] : self.places[i + 1]]


def _block_links(number: int, most: int, one: _Block, two: _Block, plan: Plan) -> list[dict]:
    """Links between components, found by checking every candidate pair of two blocks.

    Of two members outside the largest component, the smaller id leads. A pair is checked in the
    bucket of its first shared key only, and not if links found before join its components.
    """
    a, b = one.n[:, None], two.n[None, :]
    common = np.minimum(one.sharable[:, None], two.sharable[None, :])
    wanted = (one.comp[:, None] != two.comp[None, :]) & (100 * common >= plan.percent * (a + b - common))
    wanted &= (two.comp[None, :] == most) | (one.cid[:, None] < two.cid[None, :])
    i, j = np.nonzero(wanted)
    near = (one.signatures[i] != two.signatures[j]).sum(axis=1) <= plan.distance
    i, j = i[near], j[near]
    keys, others = keys_of(one.signatures, plan), keys_of(two.signatures, plan)
    first = (keys[i, : number + 1] == others[j, : number + 1]).argmax(axis=1) == number
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while x in parent:
            x = parent[x]
        return x

    links = []
    for p, q in zip(i[first], j[first]):
        r, t = root(int(one.comp[p])), root(int(two.comp[q]))
        if r == t:
            continue
        both = np.concatenate([one.shingles(p), two.shingles(q)])
        both.sort()
        shared = np.count_nonzero(both[1:] == both[:-1])
        if 100 * shared >= plan.percent * (len(both) - shared):
            parent[max(r, t)] = min(r, t)
            links.append({"u": int(one.cid[p]), "v": int(two.cid[q])})
    return links


def _dense(mixed: DataFrame, facts: DataFrame, sets: DataFrame, plan: Plan) -> DataFrame:
    """Links across components in buckets with many pairs to check.

    Members outside a bucket's most frequent component are gathered in blocks, and so are all
    its members; a block of the one kind and one of the other are one row, whose pairs are
    checked in place, so a large bucket makes blocks but no row per pair. Blocks hold about
    BLOCK_MEMBERS members, fewer where sets are large. Rows are dealt by bucket and block, so a
    bucket is no single task's group.
    """
    # Sets of a size class are at most twice as large as its smallest; linked ones are at most
    # ``reach`` classes apart.
    size_class = F.floor(F.log2(F.greatest(F.col("n") / BLOCK_SHINGLES, F.lit(1.0))))
    reach = math.ceil(math.log2(100 / plan.percent))
    cells = F.struct("cid", "comp", "n", "sharable", "signature", "shingles")
    held = mixed.join(facts, "cid").join(sets, "cid").withColumn("class", size_class)

    def count(members: str, of: str) -> Column:
        return F.ceil(F.col(members) * F.pow(F.lit(2), F.col(of)) / BLOCK_MEMBERS)

    def gathered(rows: DataFrame, members: str, name: str) -> DataFrame:
        block = F.pmod(F.xxhash64("cid"), count(members, "class")).alias("block")
        named = rows.select("number", "key", "most", "size", "class", block, cells.alias("cell"))
        return named.groupBy("number", "key", "most", "size", "class", "block").agg(F.collect_list("cell").alias(name))

    near = F.sequence(F.greatest(F.lit(0), F.col("class") - reach), F.col("class") + reach)
    few = gathered(held.filter(F.col("comp") != F.col("most")), "few", "one")
    few = few.withColumn("class", F.explode(near)).withColumn("block", F.explode(F.sequence(F.lit(0), count("size", "class") - 1)))
    pairs = few.drop("number", "most", "size").join(gathered(held, "size", "two"), ["key", "class", "block"])

    def check(number: pa.Array, most: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
        found = [
            _block_links(number[r].as_py(), most[r].as_py(), _Block(one, r), _Block(two, r), plan) for r in range(len(number))
        ]
        return pa.array(found, pa.list_(pa.struct([("u", pa.int64()), ("v", pa.int64())])))

    check.__annotations__ = {"number": pa.Array, "most": pa.Array, "one": pa.Array, "two": pa.Array, "return": pa.Array}
    links = F.arrow_udf(check, "array<struct<u:long,v:long>>")("number", "most", "one", "two")
    return pairs.select(F.explode(links).alias("link")).select("link.u", "link.v")


def _body(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def labelled(
    docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """One row per document: doc_id, body (hash of its text), n (shingles) and component_id."""
    plan = Plan(percent)
    docs = docs.select(F.col(key).alias("doc_id"), _body(F.col(text)).alias("body"), F.col(text).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, body long, n long, h1 long, h2 long, signature binary"
    signed = docs.mapInArrow(_signed(width), schema)
    rows = staged(signed.withColumn("row_id", F.monotonically_increasing_id()))
    groups = rows.filter(F.col("n") > 0).groupBy("h1", "h2").agg(F.min("row_id").alias("cid"), F.min("doc_id").alias("least"))
    classes = staged(
        groups.select("cid", "least").join(rows.withColumnRenamed("row_id", "cid"), "cid")
        .select("cid", "least", "doc_id", "n", "h1", "h2", "signature")
    )
    keys = classes.select("cid", "signature").mapInArrow(_keyed(plan), "number int, key long, cid long")
    ends = keys.groupBy("key").agg(F.min("cid").alias("low"), F.max("cid").alias("high")).filter("low < high")
    buckets = staged(keys.join(ends, "key"))
    sets = staged(_sets(buckets.select("cid").distinct(), classes, docs, width))
    star = buckets.select("cid", F.explode(F.array("low", "high")).alias("hub")).filter("cid <> hub")
    tested = staged(star.select(F.least("cid", "hub").alias("u"), F.greatest("cid", "hub").alias("v")).distinct())
    stars = components(confirmed(tested, classes, sets, plan))
    # A linked pair shares about half of its keys: a few keys find most links across components,
    # and the search over all keys then meets few components that are still apart.
    members = buckets.select("number", "key", "cid")
    apart = staged(_mixed(members, stars).select("cid").distinct())
    # What shares too few shingles with the others is linked with none of them, and leaves the
    # buckets before their pairs are counted.
    facts = staged(
        classes.join(apart, "cid").join(_own(apart, sets), "cid", "left")
        .select("cid", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("sharable"), "signature")
        .filter(100 * F.col("sharable") >= percent * F.col("n"))
    )
    left = facts.select("cid")
    sets = sets.join(left, "cid")

    def searched(mixed: DataFrame, dense: int, rest: DataFrame) -> DataFrame:
        found = confirmed(rest, classes, sets, plan)
        if dense:
            found = found.unionByName(_dense(mixed.filter("dense"), facts, sets, plan))
        return components(stars.toDF("u", "v").unionByName(found))

    early = F.col("number") < FIRST_KEYS
    mixed, counts = _counted(_mixed(members.join(left, "cid"), stars), dense=early & F.col("dense"))
    if not counts["n"]:
        return _named(rows, classes, stars)
    first, later = mixed.filter(early), mixed.filter(~early)
    rest = staged(_across(first.filter(~F.col("dense")), facts, tested, plan))
    stars = searched(first, counts["dense"], rest)
    later, counts = _counted(_mixed(later.select("number", "key", "cid"), stars), dense=F.col("dense"))
    if counts["n"]:
        rest = _across(later.filter(~F.col("dense")), facts, tested.unionByName(rest), plan)
        stars = searched(later, counts["dense"], rest)
    return _named(rows, classes, stars)


def _counted(frame: DataFrame, **conditions: Column) -> tuple[DataFrame, dict[str, int]]:
    """A staged frame, how many rows it has (``n``), and how many meet each condition."""
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("n"), *(F.count_if(c).alias(name) for name, c in conditions.items())]
    return staged(frame.observe(seen, *metrics)), seen.get


def _named(rows: DataFrame, classes: DataFrame, stars: DataFrame) -> DataFrame:
    """Documents with the least id of their class's component."""
    rooted = classes.join(stars.withColumnRenamed("node", "cid"), "cid", "left").select(
        "h1", "h2", "least", F.coalesce("root", "cid").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component"))
    found = rooted.join(named, "root").select("h1", "h2", "component")
    # Rows without words have no class: left out of the join, they are no hot key of it.
    full, empty = rows.filter(F.col("n") > 0), rows.filter(F.col("n") == 0)
    return (
        full.join(found, ["h1", "h2"]).select("doc_id", "body", "n", F.col("component").alias("component_id"))
        .unionByName(empty.select("doc_id", "body", "n", F.col("doc_id").alias("component_id")))
    )


def groups(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept."""
    return labelled(docs, width=width, percent=percent).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def dedupe(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The documents, one of each group: the row with the group's id. Rows that repeat an id
    with an equal text stay once. Null ids cannot stand for a group and stay as they are."""
    found = labelled(docs, text, key, width, percent)
    gone = found.filter(F.col("doc_id") != F.col("component_id")).select(
        F.col("doc_id").alias("gone_id"), F.col("body").alias("gone_body")
    )
    same = (docs[key] == gone["gone_id"]) & (_body(docs[text]) == gone["gone_body"])
    once = Window.partitionBy(key, _body(F.col(text))).orderBy(F.lit(1))
    named = docs.filter(docs[key].isNotNull()).join(gone.distinct(), same, "left_anti")
    times = fresh("times", docs.columns)
    named = named.withColumn(times, F.row_number().over(once)).filter(F.col(times) == 1).select(*docs.columns)
    return named.unionByName(docs.filter(docs[key].isNull()))
