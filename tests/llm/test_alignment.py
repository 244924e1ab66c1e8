"""Alignment of two tokenizers against a plain merge of their ends."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from touchline.llm import alignment as al

FIELDS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def library():
    """Encoders of whole texts -> ids and ends, from the vocabularies' own libraries."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path(al.BYTE_FILE))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(al.PIECE_FILE))
    letters = al.byte_letters()

    def piece(i):
        text = b.id_to_piece(i)
        byte = re.fullmatch("<0x([0-9A-F]{2})>", text)
        return bytes.fromhex(byte[1]) if byte else text.replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return [], [], [], []
        ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        spelt = [[bytes(letters[c] for c in a.id_to_token(i)) for i in ids[0]], [piece(i) for i in ids[1]]]
        if any(b"".join(s) != (" " + text).encode() for s in spelt):
            return [], [], [], []
        return (*ids, *(np.cumsum([len(x) for x in s]).tolist() for s in spelt))

    return tokens


def brute(texts, library):
    groups, links, out = [], [], []
    for text in texts:
        a, b, at, by = library(text)
        ends = sorted(set(at) & set(by))
        past_a, past_b = ({e: k + 1 for k, e in enumerate(x)} for x in (at, by))
        cut_a, cut_b = [0, *(past_a[e] for e in ends)], [0, *(past_b[e] for e in ends)]
        groups.append([(a[cut_a[k] : cut_a[k + 1]], b[cut_b[k] : cut_b[k + 1]]) for k in range(len(ends))])
        links.append([(x[-1], y[-1]) for x, y in groups[-1]])
        out.append([len(a), len(b)])
    count = Counter(link for each in links for link in each)
    highest = {}
    for (_, y), n in count.items():
        highest[y] = max(n, highest.get(y, 0))
    for row, found, pairs in zip(out, groups, links):
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in found)
        best = sum(count[p] == highest[p[1]] for p in pairs)
        row += [len(found), len(pairs), best, sum(count[p] for p in pairs), hashlib.sha256(shown.encode()).hexdigest() if found else ""]
    return out, groups


@pytest.mark.parametrize("work", [1, 2, 3, 7, 1000])
def test_pieces_and_borders_find_every_shared_end(work):
    rng = random.Random(work)
    for n in (0, 1, 2, 30, 200):
        a, b = (np.array(sorted(rng.sample(range(400), rng.randint(0, n))), np.int64) for _ in range(2))
        i, j = al.shared_ends(a, b, work)
        want = sorted(set(a.tolist()) & set(b.tolist()))
        assert a[i].tolist() == b[j].tolist() == want
        x, y = al.cuts(a, b, work)
        assert ((x + y) == np.minimum(np.arange(len(x)) * work, len(a) + len(b))).all()
        merged = sorted([(v, 0) for v in a.tolist()] + [(v, 1) for v in b.tolist()])
        assert [sum(side == 0 for _, side in merged[: p + q]) for p, q in zip(x, y)] == x.tolist()


def test_digest_equals_brute_force(docs_of, library):
    rng = random.Random(3)
    texts = [None, "", " ", "a", "  two  spaces\t\n", "<|endoftext|> <s> </s> <unk> <0x41>", "▁ lower one eighth", "naïve Ünder 日本語 😀",
             "a b", "\x00 nul", "don't we'll 12345 67", "x" * 3000, "the same", "the same", "é" * 500]
    texts += ["".join(rng.choice("ab dé<\n_▁1") for _ in range(rng.randint(1, 300))) for _ in range(60)]
    texts.append(" ".join("".join(rng.choice("etaoins") for _ in range(rng.randint(1, 9))) for _ in range(40_000)))
    rows = list(enumerate(texts)) + [(None, "a null id"), (12, texts[12])]
    want, groups = brute([t for _, t in rows], library)
    docs = docs_of([(i, t, "s", "n_links") for i, t in rows])
    found = al.digest(docs)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = sorted(([r["doc_id"], *(r[f] for f in FIELDS)] for r in found.collect()), key=repr)
    assert got == sorted(([i, *w] for (i, _), w in zip(rows, want)), key=repr)
    shown = {r["doc_id"]: r for r in al.tokens_of(docs).collect()}
    for (i, _), each in zip(rows, groups):
        r = shown[i]
        assert [len(x) for x, _ in each] == np.diff([-1, *r["ends_a"]]).tolist()
        assert (r["a"], r["b"]) == (sum((x for x, _ in each), []), sum((y for _, y in each), []))
    assert al.digest(docs_of([])).count() == 0


def test_pairs_stay_within_their_bound(docs_of, words):
    a, b = al.byte_tokenizer(al.BYTE_FILE)[1], al.piece_tokenizer(al.PIECE_FILE)[1]
    assert al.pair_bound(a, b) < 2_000_000
    spell = {tuple(e.data[s : s + n].tolist()) for e in (a, b) for s, n in zip(e.start.tolist(), e.size.tolist())}
    assert (32, 116, 104, 101) in spell


def test_a_text_that_a_vocabulary_cannot_spell_has_no_tokens(monkeypatch, docs_of):
    right = al._spells
    monkeypatch.setattr(al, "_spells", lambda *given: right(*given) & np.array([t != b" two" for t in given[3]]))
    found = al.align([[" one"], [" two"], [], [" one two"]], al.BYTE_FILE, al.PIECE_FILE)
    assert np.diff(found.a_places).tolist() == [1, 0, 0, 2]
    assert [bool(t) for t in al.written(found)] == [True, False, False, True]
