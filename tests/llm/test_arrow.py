"""Word hashing, tokens, near duplicates, phrases, leaks and the random fields."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from touchline.llm import components, crf, langid, leaks, mixing, neardup, phrases, tokens, toxicity
from touchline.llm import words as w


@pytest.mark.parametrize("piece", [16, 64, 1 << 20])
def test_words_are_found_in_any_piece_size(monkeypatch, piece):
    monkeypatch.setattr(w, "PIECE", piece)
    rng = random.Random(piece)
    texts = ["", None, " a", "a ", "É" * 40, "one two", "one", "x" * 200 + " y"]
    texts += ["".join(rng.choice("aB \n\té\0") for _ in range(rng.randint(0, 90))) for _ in range(200)]
    column = pa.array(["skipped", *texts])[1:]
    hashes, doc = w.word_column(column, w.WHITE)
    names: dict[str, int] = {}
    found = [(i, x) for i, t in enumerate(texts) for x in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))]
    assert [i for i, _ in found] == doc.tolist()
    for (_, word), h in zip(found, hashes.tolist()):
        assert names.setdefault(word, h) == h
    assert len(set(names.values())) == len(names)


def test_latin_letters_fold():
    a, b = (w.word_column(pa.array([t]), w.LETTERS)[0].tolist() for t in ("Ünder ÉTÉ×1", "ünder été×1"))
    assert a == b


def test_tokens_equal_the_library(docs_of):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [None, "", " ", "a<|endoftext|>b", "tabs\t and  spaces \n\n x", "word " * 60000, "é😀 日本" * 30000, "x" * 3000, "don't we'll"]
    texts.append("".join(random.Random(1).choice("ab é<|>\n'1") for _ in range(200000)))
    rows = tokens.count(docs_of(list(enumerate(texts)) + [(3, texts[3])])).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        text = texts[r["doc_id"]] or ""
        n = len(library.encode(text, add_special_tokens=False))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 512)
    assert len(list(tokens.parts("word " * 60000))) > 3
    assert tokens.count(docs_of([])).count() == 0
    sizes = [sum(len(p.encode()) for p in group) for _, group in tokens.batches(["語" * 100 + " a"] * 50, 1000)]
    assert sum(sizes) == 50 * 302 and all(1000 <= s <= 1302 for s in sizes[:-1])


def brute_components(rows, width, percent):
    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        if len(words) < width:
            return frozenset([tuple(words)] if words else [])
        return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))

    sets = [(i, shingles(t)) for i, t, *_ in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and 100 * len(x & y) >= percent * len(x | y):
                parent[root(a)] = root(b)
    least = {}
    for a, (i, s) in enumerate(sets):
        if i is not None and s:
            least[root(a)] = min(least.get(root(a), i), i)
    return [(i, len(s), least.get(root(a), i) if s else i) for a, (i, s) in enumerate(sets)]


def edited(base, n, seed):
    rng, out = random.Random(seed), list(base)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"z{rng.random()}"
    return " ".join(out)


@pytest.fixture(scope="module")
def copies(words):
    rows = [(i, " ".join(words(60, i))) for i in range(30)]
    base = words(120, 99)
    rows += [(100 + i, edited(base, i % 9, i)) for i in range(150)]  # one large group of near copies
    rows += [(300 + i, " ".join(base)) for i in range(40)]  # exact copies
    rows += [(400, None), (401, ""), (402, "a"), (403, "A"), (404, "a b"), (405, "b a"), (5, rows[5][1]), (None, rows[6][1])]
    rows += [(500, "same " * 4000), (501, "same " * 3000)]
    return rows


@pytest.mark.parametrize("dense", [1 << 40, 8])
@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicates_against_brute_force(docs_of, copies, monkeypatch, dense, width, percent):
    monkeypatch.setattr(neardup, "DENSE", dense)
    monkeypatch.setattr(neardup, "BLOCK_MEMBERS", 16)
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 50)
    got = neardup.groups(docs_of(copies), width=width, percent=percent).collect()
    want = brute_components(copies, width, percent)
    key = lambda r: str(r)
    assert sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got], key=key) == sorted(want, key=key)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_one_document_of_each_group_stays(docs_of, copies):
    out = neardup.dedupe(docs_of(copies), width=3, percent=85)
    left = sorted((r["doc_id"] for r in out.collect()), key=str)
    want = {c for i, n, c in brute_components(copies, 3, 85) if i is not None}
    assert left == sorted([*want, None], key=str)
    assert neardup.dedupe(docs_of([])).count() == 0


def test_added_names_never_clash(docs_of):
    docs = docs_of([(1, "a b c", "s", "Times"), (2, "a b c", "s", "Times"), (3, "d e", "s", "Times")])
    kept = neardup.dedupe(docs)
    assert kept.columns == docs.columns and {(r["doc_id"], r["Times"]) for r in kept.collect()} == {(1, "x"), (3, "x")}
    mixed = mixing.mix(docs.withColumnRenamed("Times", "mix_position_").withColumn("MIX_position", F.lit(1)))
    assert mixed.columns[-3:] == ["mix_copy", "mix_words", "mix_position__"] and mixed.count() > 0


def test_index_finds_every_pair_within_the_distance():
    rng = np.random.default_rng(3)
    for percent in (80, 85):
        plan = neardup.Plan(percent)
        for _ in range(300):
            a = rng.integers(0, 1 << 16, (1, neardup.POSITIONS)).astype(np.uint16)
            b = a.copy()
            b[0, rng.choice(neardup.POSITIONS, plan.distance, replace=False)] ^= 1
            assert (neardup.keys_of(a, plan) == neardup.keys_of(b, plan)).any()


def brute_phrases(text):
    found, rest = [], ""
    for c in text:
        rest += c
        if rest not in found:
            found.append(rest)
            rest = ""
    return found


def test_phrases(docs_of, words):
    texts = ["", None, "abc", "a" * 9000, "aababcabcdabcde" * 9, "é😀x" * 30] + [" ".join(words(40, i % 9)) for i in range(30)]
    rows = [(3 * i, t) for i, t in enumerate(texts)] + [(9, texts[3]), (None, "first text")]
    got = phrases.neighbours(docs_of(rows)).collect()
    assert len(got) == len(rows)
    from collections import Counter

    order = sorted(((i if i is not None else -1, t or "") for i, t in rows), key=lambda r: r[0])
    by_text = {}
    assert Counter(r["n_chars"] for r in got) == Counter(len(t) for _, t in order)
    ids = Counter(i for i, _ in order)
    following = {i: order[(k + 1) % len(order)][1] for k, (i, _) in enumerate(order)}
    text_of = dict(order)
    for r in got:
        i = r["doc_id"] if r["doc_id"] is not None else -1
        if ids[i] > 1:
            continue
        text, put = text_of[i], following[i]
        n = len(text)
        new = text[: n - n // 4] + put[: n // 4]
        assert r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        for name, body in (("fingerprint", text), ("edited_fingerprint", new)):
            assert by_text.setdefault(body, r[name]) == r[name]
            assert len(r[name]) == 8 * min(phrases.SIZE, len(brute_phrases(body)))
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if new == text:
            assert r["near_edited"] == 1
    assert phrases.neighbours(docs_of([])).count() == 0


def test_likeness_estimates_the_overlap():
    rng = np.random.default_rng(1)
    pool = w.mix64(np.arange(3000, dtype=np.uint64))
    for share in (200, 1000, 1800):
        a, b = pool[:2000], np.concatenate([pool[2000 - share : 2000], w.mix64(rng.integers(1 << 40, 1 << 41, 2000 - share).astype(np.uint64))])
        assert abs(phrases.likeness(phrases.smallest(a), phrases.smallest(b)) - share / (4000 - share)) < 0.2


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_longest_common_subsequence():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = (rng.integers(0, 6, rng.integers(1, 40)).astype(np.uint64) for _ in range(2))
        assert leaks.common_words(a, b) == brute_lcs(a.tolist(), b.tolist())


def test_leaks(spark, docs_of, words):
    items = [(i, " ".join(words(20 + i, 1000 + i))) for i in range(20)] + [(90, None), (91, ""), (92, "?!")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    clean = [(i, " ".join(words(150, i))) for i in range(60)] + [(60, None), (61, "")]
    rows, want = list(clean), set()
    for i in range(20):
        text, fill = items[i][1], words(200, 5000 + i)
        rows.append((100 + i, " ".join(fill[: 7 * i] + text.upper().split() + fill)))
        parts = [p + "!!" for p in text.split()]
        parts[3] = "changed"  # a paraphrase of one word, decorated
        rows.append((200 + i, " ".join(fill[:50] + parts)))
        want |= {(100 + i, i), (200 + i, i)}
    rows += [(100, rows[62][1]), (300, " ".join(words(20000, 77) + items[4][1].split()))]
    want.add((300, 4))
    docs = docs_of(rows)
    assert {(r["doc_id"], r["item_id"]) for r in leaks.hits(docs, bench).collect()} == want
    kept = {r["doc_id"] for r in leaks.clean(docs, bench).collect()}
    assert kept == {i for i, _ in rows} - {i for i, _ in want}
    assert leaks.hits(docs, bench.limit(0)).count() == 0 and leaks.hits(docs.limit(0), bench).count() == 0


def test_every_round_compares_all_its_passages(spark, docs_of, words, monkeypatch):
    """An item is found at any offset, wherever the rounds of the search begin."""
    item = words(18, 1000)
    bench = spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")
    (index,) = leaks.build(docs_of([(i, " ".join(words(100, i))) for i in range(30)]), bench)
    fill = words(150, 5000)
    texts = pa.array([" ".join(fill[:n] + item + fill[n:]) for n in range(100)])
    monkeypatch.setattr(leaks, "ROWS", 1 << 20)
    whole = sorted(leaks.search(texts, index))
    assert [t for t, *_ in whole] == list(range(100))
    for rows in (1, 2, 3, 5, 8):
        monkeypatch.setattr(leaks, "ROWS", rows)
        assert np.allclose(sorted(leaks.search(texts, index)), whole)


def test_leak_recall_against_exact_matching(spark, sf_dir):
    """Every item that stands word for word in a document is found, and little else."""
    from touchline.llm.common import table

    norm = lambda t: re.findall(r"[^\W_]+", t.lower())
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    bodies = {r["doc_id"]: f" {' '.join(norm(r['text'] or ''))} " for r in docs.collect()}
    true = {(d, b["item_id"]) for b in bench.collect() for d, t in bodies.items() if f" {' '.join(norm(b['text']))} " in t}
    got = {(r["doc_id"], r["item_id"]) for r in leaks.hits(docs, bench).collect()}
    assert len(true & got) >= 0.9 * len(true) and len(got - true) <= max(2, 0.2 * len(true))


@pytest.mark.parametrize("times", [1, 10])
def test_paraphrases_are_candidates_at_any_corpus_size(spark, sf_dir, times):
    """Items with 10 to 40 % of their words replaced, against the longest common subsequence."""
    from touchline.llm.common import table

    rng = random.Random(4)
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    items = [(r["item_id"], r["text"].split()) for r in bench.orderBy("item_id").limit(100).collect()]
    hosts = [r["text"].split() for r in docs.filter("length(text) between 300 and 3000").orderBy("doc_id").limit(60).collect()]
    corpus = docs
    for _ in range(times - 1):
        corpus = corpus.unionByName(docs)
    (index,) = leaks.build(corpus, bench)
    number, planted = {i: k for k, i in enumerate(index.ids)}, []
    for inside in (False, True):
        pool = sorted({w for _, words in items for w in words}) if inside else [f"qz{n}x" for n in range(500)]
        for share in (0.1, 0.2, 0.3, 0.4):
            for i, words in items:
                body, host = list(words), hosts[rng.randrange(len(hosts))]
                for at in rng.sample(range(len(body)), int(share * len(body))):
                    body[at] = rng.choice(pool)
                cut = rng.randrange(len(host) + 1)
                planted.append((inside, number[i], body, " ".join(host[:cut] + body + host[cut:])))
    found = {(t, i) for t, i, *_ in leaks.search(pa.array([p[3] for p in planted]), index)}
    tried, missed = [0, 0], [0, 0]
    for t, (inside, i, body, _) in enumerate(planted):
        text, _ = w.word_column(pa.array([" ".join(body)]), w.LETTERS)
        share = brute_lcs(index.items[i].tolist(), text.tolist()) / len(index.items[i])
        answer = brute_lcs(index.answers[i].tolist(), text.tolist()) / len(index.answers[i])
        if share >= leaks.NEARLY or (share >= leaks.LCS and answer >= leaks.ANSWER):
            tried[inside] += 1
            missed[inside] += (t, i) not in found
    assert min(tried) > 100 and missed[False] == 0 and missed[True] <= 0.02 * tried[True]


def brute_marginals(field, scores, begins):
    """By summing over all label paths of each sequence."""
    from itertools import product

    n, labels = scores.shape
    out = np.zeros((n, labels))
    cuts = [i for i in range(n) if begins[i] or i == 0] + [n]
    for a, b in zip(cuts, cuts[1:]):
        total = 0.0
        for path in product(range(labels), repeat=b - a):
            weight = field.first[path[0]] + sum(scores[a + t, y] for t, y in enumerate(path))
            weight = np.exp(weight + sum(field.moves[x, y] for x, y in zip(path, path[1:])))
            total += weight
            for t, y in enumerate(path):
                out[a + t, y] += weight
        out[a:b] /= total
    return out


@pytest.mark.parametrize("block", [2, 3, 128])
def test_forward_backward_is_exact(monkeypatch, block):
    monkeypatch.setattr(crf, "BLOCK", block)
    rng = np.random.default_rng(block)
    field = crf.Crf(rng.normal(size=2), rng.normal(size=3), rng.normal(size=(3, 3)), rng.normal(size=3))
    scores, begins = rng.normal(size=(14, 3)), np.zeros(14, bool)
    begins[[0, 6, 7]] = True
    assert np.allclose(crf.marginals(field, scores, begins), brute_marginals(field, scores, begins))


def test_field_learns():
    rng = np.random.default_rng(0)
    gold = (np.cumsum(rng.random(4000) < 0.05) % 2).astype(int)
    x = np.zeros((4000, 1, 2))
    x[:, 0, 1] = gold * 2 - 1 + rng.normal(size=4000) * 1.5
    begins = np.zeros(4000, bool)
    begins[0] = True
    field = crf.train(crf.Crf.blank(1, 2), x, gold, begins)
    each = crf.marginals(field, field.scores(x), begins).argmax(1)
    assert (each == gold).mean() > ((x[:, 0, 1] > 0) == gold).mean() + 0.1


def test_language_held_out_accuracy(spark):
    from touchline.llm.queries import op8_langid

    folder = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = [r for r in op8_langid(spark, folder).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in rows) >= 0.97 * len(rows) > 100


def test_language_edges(spark, docs_of, words):
    rows = [(i, " ".join(words(40, i, "abcdefg" if i % 2 else "uvwxyz"))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "123 !!!"), (103, "abba"), (None, "gabe abc"), (104, "abc fed " * 30000)]
    docs = spark.createDataFrame([(i, t, ["xx", "yy"][(i or 0) % 2] if i is None or i < 100 else None, 1) for i, t in rows],
                                 "doc_id long, text string, lang string, score int")
    got = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (100, 101, 102))
    assert got[104]["lang_pred"] == "yy" and 0 <= got[104]["score"] <= 1
    assert langid.identify(docs.limit(0)).count() == 0
    from pyspark.sql import functions as F

    nothing = langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert len(nothing) == len(rows) and {r["lang_pred"] for r in nothing} == {"und"}


def test_toxicity_held_out(spark):
    from touchline.llm.queries import op9_toxicity

    folder = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in op9_toxicity(spark, folder).collect() if r["held_out"] and truth.get(r["doc_id"]) is not None]
    caught = [r["predicted"] for r in rows if truth[r["doc_id"]] == 1]
    clean = [r["predicted"] for r in rows if truth[r["doc_id"]] == 0]
    assert np.mean(caught) > 0.8 and np.mean(clean) < 0.02


def test_toxic_spans_and_edges(spark, docs_of, words):
    rng, rows, labels = random.Random(5), [], []
    for i in range(900):
        body = words(40, i % 37)
        bad = i % 5 == 0
        for _ in range(3 if bad else 0):
            body.insert(rng.randrange(40), rng.choice(["Vileword!", "fouléword"]))
        rows.append((i, " ".join(body)))
        labels.append((i, int(bad)))
    rows += [(2000, None), (2001, ""), (2002, "ééé fouléword xx fouléword, vileword"), (0, rows[0][1])]
    docs = docs_of(rows)
    marks = spark.createDataFrame(labels + [(0, 1), (5000, None), (None, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(docs, marks).collect()}
    wrong = [i for i, y in labels if got[i]["predicted"] != y]
    assert len(wrong) <= 9
    assert got[2000]["predicted"] == got[2001]["predicted"] == 0 and 0 <= got[2000]["score"] <= 1
    assert got[2002]["predicted"] == 1
    model = toxicity.fit(docs, marks)
    text = rows[902][1]
    found = sorted((r["start"], r["end"]) for r in toxicity.spans(docs, model).collect() if r["doc_id"] == 2002)
    assert [text[a:b] for a, b in found] == ["fouléword", "fouléword", "vileword"]
    assert toxicity.score(docs.limit(0), marks).count() == 0
    assert {r["score"] for r in toxicity.score(docs, marks.limit(0)).collect()} == {0.0}


def test_held_out_and_unmatched_labels_teach_nothing(spark, docs_of, words):
    from zlib import crc32

    docs = docs_of([(i, " ".join([*words(30, i % 37), *["vileword"] * (i % 5 == 0)])) for i in range(400)])
    held = [i for i in range(400) if crc32(str(i).encode()) % toxicity.FOLDS == toxicity.HELD_OUT]
    rows = [(i, int(i % 5 == 0)) for i in range(400)]
    other = [(i, 1 - y if i in held else y) for i, y in rows] + [(i, 1) for i in range(1000, 1200)]
    other += [r for r in rows if r[0] not in held and r[1]]  # a repeated label counts once
    a, b = (toxicity.fit(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (rows, other))
    assert np.array_equal(a.evidence, b.evidence)
    assert np.allclose(a.field.flat(), b.field.flat()) and np.allclose(a.judge, b.judge)


def test_a_text_in_pieces_counts_once(monkeypatch, words):
    from types import SimpleNamespace

    pool, rng = words(40, 3), random.Random(3)
    texts = [" ".join(rng.choices(pool, k=k)) for k in (3, 400, 5, 0, 900, 1, 300)] + [None, "lonely"]
    rows = pa.record_batch({"toxic": pa.array([i % 2 for i in range(len(texts))]), "text": pa.array(texts)})
    shared = SimpleNamespace(value=leaks.Vocabulary.of(w.word_column(pa.array([" ".join(pool[:30])]), w.LETTERS)[0]))
    found = []
    for piece in (1 << 20, 64, 300):
        monkeypatch.setattr(w, "PIECE", piece)
        found.append([b.to_pydict() for run in (leaks._counted(shared), toxicity._counted) for b in run(iter([rows, rows]))])
    assert found[0] == found[1] == found[2]
    assert max(found[0][0]["n"]) == 2 * len(texts)


@pytest.mark.parametrize("one_task", [0, 1 << 20])
@pytest.mark.parametrize("held", [3, 1 << 20])
def test_components_of_both_ways(spark, monkeypatch, one_task, held):
    monkeypatch.setattr(components, "HELD", held)
    rng = random.Random(held)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(100 + i, 101 + i) for i in range(30)] + [(7, 7)]
    frame = spark.createDataFrame(edges, "u long, v long").repartition(3)
    least = {x: x for e in edges for x in e}
    for _ in least:
        for u, v in edges:
            least[u] = least[v] = min(least[u], least[v])
    got = {r["node"]: r["root"] for r in components.components(frame, one_task).collect()}
    assert got == {x: r for x, r in least.items() if x != r}
    assert components.components(frame.limit(0), one_task).count() == 0


def brute_phrases(text):
    """The smallest upper halves of the phrases' hashes, by integers."""
    known, rest, values, limit = set(), "", set(), (1 << 64) - 1

    def mixed(h):
        for _ in range(2):
            h = (h ^ (h >> 32)) * 0xD6E8FEB86659FD93 & limit
        return h ^ (h >> 32)

    for char in text:
        rest += char
        if rest not in known:
            known.add(rest)
            h = sum((b + 1) * pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k, b in enumerate(rest.encode())) & limit
            values.add(mixed(h) >> 32)
            rest = ""
    return sorted(values)[: phrases.SIZE]


def brute_likeness(a, b):
    both = sorted({*a, *b})[: phrases.SIZE]
    return sum(v in a and v in b for v in both) / len(both) if a and b else float(len(a) == len(b))


def test_fingerprints_against_brute_force(docs_of, words):
    texts = ["", None, "a", "ab" * 40, "é日本😀" * 30, *(" ".join(words(n, n)) for n in (3, 40, 41, 200, 300)), " ".join(words(200, 200))]
    rows = list(enumerate(texts))
    got = {r["doc_id"]: r for r in phrases.neighbours(docs_of(rows)).collect()}
    shown = lambda values: "".join(f"{v:08x}" for v in values)
    for i, text in rows:
        text, following = text or "", texts[(i + 1) % len(texts)] or ""
        edited = text[: len(text) - len(text) // 4] + following[: len(text) // 4]
        own, other, beside = brute_phrases(text), brute_phrases(edited), brute_phrases(following)
        r = got[i]
        assert (r["fingerprint"], r["edited_fingerprint"]) == (shown(own), shown(other))
        assert (r["near_edited"], r["near_next"]) == (brute_likeness(own, other), brute_likeness(own, beside))


def test_long_phrases_share_the_hash_of_short_ones(words):
    text = " ".join(words(400, 5))
    long = "z" * 9_000_000  # its last phrases have over 4,096 bytes
    one, two = phrases.Parsed(1, text), phrases.Parsed(2, text + long)
    assert 0 < phrases.likeness(one.values, two.values) < 1
    assert len(phrases.hashes(["z" * 4097, "z"])) == 2 and phrases.hashes(["z" * 4097, "z"])[1] == phrases.hashes(["z"])[0]
    # The edited text is, as a whole text of another document, the same text.
    edited = phrases.Parsed(3, "z" * 8_000_000 + text).row(phrases.Parsed(4, long))
    whole = ("z" * 8_000_000 + text)[: len(text) + 8_000_000 - (len(text) + 8_000_000) // 4]
    again = phrases.Parsed(5, whole + long[: (len(text) + 8_000_000) // 4])
    assert edited[4] == phrases.encoded(again.values)


def test_words_of_code_switched_texts(spark, docs_of):
    """Texts spliced from documents of several languages: runs name the language of nearly every word."""
    import regex

    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("lang IS NOT NULL AND text IS NOT NULL")
    model = langid.fit(table.select("doc_id", "lang", "text"))
    by_lang: dict[str, list[str]] = {}
    for r in table.orderBy("doc_id").collect():
        by_lang.setdefault(r["lang"], []).append(r["text"])
    rows, gold = [], {}
    for n in range(40):
        parts, truth = [], []
        for k, lang in enumerate(sorted(by_lang)):
            picked = by_lang[lang][(n + k) % len(by_lang[lang])].split()[: 12 + n % 7]
            parts.append(" ".join(picked) + " 😀 ")
            truth += [lang] * len(parts[-1])
        rows.append((n, "".join(parts)))
        gold[n] = truth
    rows += [(100, None), (101, ""), (102, "1 2 !!"), (103, rows[0][1] * 2000)]
    docs = docs_of(rows)
    text = dict(rows)
    found: dict[int, list] = {}
    for r in langid.words(docs, model).collect():
        found.setdefault(r["doc_id"], []).append(r)
    assert not {100, 101, 102} & set(found) and 103 in found
    right = total = 0
    for n in range(40):
        runs = sorted(found[n], key=lambda r: r["start"])
        assert all(a["end"] <= b["start"] and a["lang"] != b["lang"] for a, b in zip(runs, runs[1:]))
        for r in runs:
            assert 0 < r["marginal"] <= 1 and r["start"] < r["end"] <= len(text[n])
            for w in regex.finditer(r"\p{L}+", text[n][r["start"] : r["end"]]):
                total += 1
                right += gold[n][r["start"] + w.start()] == r["lang"]
        assert sum(r["n_words"] for r in runs) >= len(sorted(by_lang)) * 10
    assert right >= 0.95 * total
    assert langid.words(docs, (model[0], model[1], [])).count() == 0 and langid.words(docs.limit(0), model).count() == 0


def test_toxic_training_goes_block_by_block():
    """Any block size covers every word once, and cuts no sequence without marking its beginning."""
    import numpy as np
    import pyarrow as pa

    from touchline.llm import crf, toxicity

    class Held:
        value = np.linspace(-2, 6, int(toxicity.PLACES[-1]), dtype=np.float32)

    texts = ["one two three", None, "four " * 50, "", "five six " * 20]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 0, 1, 0, 0]), pa.array(texts)], ["toxic", "text"])
    field = crf.Crf.blank(toxicity.K, 2)
    words = sum(len((t or "").split()) for t in texts)
    for block in (1, 40, 1 << 17):
        rows = [r for out in toxicity._trained(Held, field, block)(iter([batch] * 3)) for r in out.to_pylist()]
        assert sum(r["n"] for r in rows) == 3 * words and (len(rows) == 1) == (block > 3 * words)
        assert all(np.isfinite(r["parameters"]).all() for r in rows)
    assert not list(toxicity._trained(Held, field)(iter([])))


def test_every_text_shapes_the_latent_space(docs_of, monkeypatch, words):
    """The space is that of all passages, not of a sample of about CORPUS_DOCS documents."""
    monkeypatch.setattr(leaks, "RANK", 4)
    monkeypatch.setattr(leaks, "SPARE", 20)
    pool, rng = words(24, 5), np.random.default_rng(2)
    texts = [" ".join(rng.choice(pool[6 * (i % 3) : 6 * (i % 3) + 12], 30)) for i in range(leaks.CORPUS_DOCS + 60)]
    texts[-40:] = [" ".join(rng.choice(pool[20:], 200)) for _ in range(40)]
    item = " ".join(pool)
    bench = docs_of([]).sparkSession.createDataFrame([(1, item)], "item_id long, text string")
    (index,) = leaks.build(docs_of(list(enumerate(texts))).repartition(3), bench)
    weights = index.weights[:-1].astype(float)
    total = np.zeros((len(weights), len(weights)))
    for text, weight in [(item, leaks.ITEM_WEIGHT**2), *((t, leaks.CORPUS_DOCS / len(texts)) for t in texts)]:
        numbers = index.vocabulary.numbers(w.word_column(pa.array([text]), w.LETTERS)[0])
        for at in range(0, max(1, len(numbers) - leaks.STEP), leaks.STEP):
            counts = np.bincount(numbers[at : at + 2 * leaks.STEP], minlength=len(weights))
            row = counts * weights
            total += weight * np.outer(row, row) / (counts * weights**2).sum()
    top = np.linalg.eigh(total)[1][:, -4:]
    basis = index.vectors[:-1] / weights[:, None]
    assert np.abs(basis @ basis.T - top @ top.T).max() < 1e-3


def test_products_of_rounds_are_those_of_the_whole(monkeypatch, words):
    texts = pa.array([" ".join(words(n, n)) for n in (5, 12, 13, 200, 31)] + [None, ""])
    known = leaks.Vocabulary.of(w.word_column(texts, w.LETTERS)[0][::2])
    size = len(known.words)
    vectors = np.append(np.random.default_rng(1).standard_normal((size, 3)), np.zeros((1, 3)), axis=0).astype(np.float32)
    squares, found = np.append(np.linspace(1, 2, size), 0), []
    for rounds in (1 << 20, 1, 2, 3, 7):
        monkeypatch.setattr(leaks, "ROWS", rounds)
        found.append(np.zeros((size, 3)))
        leaks._add_product(texts, known, squares, vectors, found[-1])
    assert np.abs(found[0]).max() > 0 and all(np.allclose(found[0], x, atol=1e-5) for x in found)


def leak_case(spark, docs_of, words):
    """An index whose items are half common words, texts of common words, and of altered items."""
    rng = random.Random(6)
    common, items = words(12, 1), []
    for i in range(30):
        body = words(rng.randint(3, 40), 100 + i)
        body += [rng.choice(common) for _ in body]
        rng.shuffle(body)
        items.append(body)
    bench = spark.createDataFrame([(i, " ".join(b)) for i, b in enumerate(items)], "item_id long, text string")
    plain = [" ".join(rng.choices(common, k=300)) for _ in range(40)]
    altered = []
    for body in items * 3:
        other = [rng.choice(common) if rng.random() < 0.25 else x for x in body]
        altered.append(" ".join(rng.choices(common, k=rng.randint(0, 60)) + other + rng.choices(common, k=rng.randint(0, 60))))
    (index,) = leaks.build(docs_of([(i, " ".join(words(50, 900 + i))) for i in range(40)]), bench)
    return index, plain, altered


def test_regions_of_common_words_are_not_read(spark, docs_of, words, monkeypatch):
    """Of candidates, only those with rare words of the item are looked at word by word."""
    index, plain, altered = leak_case(spark, docs_of, words)
    read, enough = [], leaks._enough
    monkeypatch.setattr(leaks, "_enough", lambda numbers, begins, *rest: read.append(len(begins)) or enough(numbers, begins, *rest))
    assert not leaks.search(pa.array(plain), index) and sum(read) == 0
    assert leaks.search(pa.array(["?!", None]), index) == []
    assert leaks.search(pa.array(plain + altered[:1]), index) and sum(read) < 100


def test_the_screen_loses_no_hit(spark, docs_of, words, monkeypatch):
    index, plain, altered = leak_case(spark, docs_of, words)
    texts = pa.array([x for pair in zip(altered, [*plain, None, "", *plain, *plain]) for x in pair])

    def found():
        return {(t, i) for t, i, *_ in leaks.search(texts, index)}

    sizes = [("ITEMS", 7), ("MARGIN", 7), ("MARGIN", 1), ("ROWS", 3), ("COMMON", 0), ("COMMON", 1 << 20)]
    with monkeypatch.context() as all_pass:
        all_pass.setattr(leaks.Screen, "passed", lambda self, low, run, p: np.ones(len(run), bool))
        want = found()
    assert len(want) > 30 and found() == want
    for name, size in sizes:
        with monkeypatch.context() as other:
            other.setattr(leaks, name, size)
            assert found() == want, (name, size)


def test_sums_of_groups_and_words_of_full_slots(monkeypatch):
    rng = np.random.default_rng(3)
    rows, number = rng.integers(0, 9, (20, 5)).astype(np.float32), rng.integers(-1, 20, 400)
    begin = np.sort(rng.choice(400, 80, replace=False))
    begin = np.unique(np.concatenate([[0], begin, np.arange(0, 400, leaks.STEP)]))
    want = [sum((rows[x] for x in part if x >= 0), np.zeros(5)) for part in np.split(number, begin[1:])]
    for block in (1, 7, 1024):
        monkeypatch.setattr(leaks, "BLOCK", block)
        assert np.array_equal(leaks.run_sums(number, begin, rows), want)
    assert leaks.run_sums(np.full(3, -1), np.array([0]), rows).tolist() == [[0] * 5]
    low = np.arange(49, dtype=np.uint64)
    low[40:] |= np.uint64(1 << 63)  # two slots
    known = leaks.Vocabulary.of(low[::2])
    assert known.words[known.numbers(low)[::2]].tolist() == low[::2].tolist()
    assert (known.numbers(low)[1::2] == -1).all() and (known.numbers(~low) == -1).all()
    assert leaks.Vocabulary.of(low[:0]).numbers(low).tolist() == [-1] * len(low)


def test_words_are_not_encoded_again(monkeypatch):
    seen = []

    def encoded(texts):
        seen.extend(texts)
        return np.array([len(t) for t in texts])

    texts = ["some words that come again and again in every text"] * 50
    assert tokens.Words(encoded).counts(texts).tolist() == [len(texts[0])] * 50
    assert sum(map(len, seen)) < 10 * len(texts[0])
    odd = ["", " ", "a", " a", "a ", "a  b c", "\n a b\n", "x " * 9, "y" * 200 + " z y " + "y" * 200, "a\tb \tc d"] * 3
    for held in (1 << 18, 2):
        monkeypatch.setattr(tokens, "HELD", held)
        assert tokens.Words(encoded).counts(odd).tolist() == [len(t) for t in odd]


def test_toxicity_scores_texts_in_slices(monkeypatch, words):
    pool = words(50, 4)
    texts = pa.array([" ".join(pool[i % 7 :]) if i % 5 else None for i in range(60)])
    table = np.random.default_rng(1).standard_normal(int(toxicity.PLACES[-1])).astype(np.float32)
    field = toxicity.crf.Crf.blank(toxicity.K, 2)
    whole, sizes, tagged = toxicity.summary(texts, table, field), [], toxicity._tagged
    monkeypatch.setattr(toxicity, "SLICE", 1000)
    monkeypatch.setattr(toxicity, "_tagged", lambda part, *rest: (sizes.append(len(part)), tagged(part, *rest))[1])
    assert np.allclose(toxicity.summary(texts, table, field), whole)
    assert len(sizes) > 10 and sum(sizes) == 60
