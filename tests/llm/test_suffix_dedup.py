"""Repeated strings against brute force over all windows; loser tree against sorting; hot pieces split."""

import hashlib
import random
from collections import Counter

from stresscast.llm import suffix_dedup


def brute(texts, length):
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans, at = [], 0
        while at < len(t):
            end = at
            while end < len(t) and gone[end] == gone[at]:
                end += 1
            if gone[at]:
                spans.append([at, end])
            at = end
        out.append((len(t), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return out


def corpus(rng):
    letters = "abcdeé"
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [text(n) for n in (19, 20, 21, 30, 45, 120)]
    docs = []
    for _ in range(60):
        docs.append("".join(rng.choice([text(rng.randrange(30)), rng.choice(shared)]) for _ in range(rng.randrange(5))))
    docs += ["ab" * 100, "ab" * 60 + "c", "", None, text(19), docs[3], docs[3], shared[2], "z" * 500, shared[5] + "é" + shared[5]]
    return docs


def test_against_brute_force(make_docs):
    rng = random.Random(4)
    docs = corpus(rng)
    rows = [(i, t) for i, t in enumerate(docs)] + [(3, docs[3]), (None, docs[5])]
    want = brute([(t or "").encode() for _, t in rows], 20)
    expected = sorted((-1 if i is None else i, *map(str, w)) for (i, _), w in zip(rows, want))
    for options in ({}, {"max_group": 3}, {"max_group": 1}):
        got = suffix_dedup.repeated_bytes(make_docs(rows), length=20, piece=6, **options).collect()
        assert sorted((-1 if r.doc_id is None else r.doc_id, str(r.n_bytes), str([list(s) for s in r.spans]), r.kept_sha256)
                      for r in got) == expected, options


def test_long_texts_are_hashed_in_pieces(make_docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUFFER", 64)
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh") for _ in range(300))
    rows = [(1, "x" * 50 + passage + "y" * 70), (2, passage[20:280] + "tail"), (3, "head" + passage[100:])]
    want = brute([t.encode() for _, t in rows], 40)
    got = {r.doc_id: (r.n_bytes, [list(s) for s in r.spans], r.kept_sha256)
           for r in suffix_dedup.repeated_bytes(make_docs(rows), length=40, piece=10).collect()}
    assert [got[i] for i, _ in rows] == want


def test_empty_table(make_docs):
    assert suffix_dedup.repeated_bytes(make_docs([(1, "x")]).where("doc_id < 0")).count() == 0


def test_loser_tree_merges_front_coded_runs():
    rng = random.Random(6)
    for k in (1, 2, 3, 5, 8):
        rows = [(bytes(rng.choice(b"ab") for _ in range(rng.randrange(12))), bytes(rng.choice(b"xy") for _ in range(rng.randrange(3))),
                 rng.randbytes(16), rng.randrange(5)) for _ in range(200)]
        runs = [suffix_dedup.front_coded(sorted(rows[i::k])) for i in range(k)]
        got = list(suffix_dedup.merged(runs))
        assert [g[1] for g in got] == sorted(r[0] for r in rows)
        assert Counter(g[1:] for g in got) == Counter(rows)
        last = b""
        for g in got:
            n = 0
            while n < min(len(last), len(g[1])) and last[n] == g[1][n]:
                n += 1
            assert g[0] == n
            last = g[1]


def test_anchors_are_chosen_by_content():
    rng = random.Random(7)
    shared = bytes(rng.choice(b"abcd") for _ in range(90))
    a, b = b"q" * 33 + shared + b"r", bytes(rng.choice(b"wxyz") for _ in range(51)) + shared
    powers = suffix_dedup._powers(1000)
    doc, at, _ = suffix_dedup.anchors_of([a, b], powers, 30, 8)
    for start in range(len(shared) - 30 + 1):
        mine = [set(p - base - start for p in at[doc == d] if start <= p - base <= start + 22) for d, base in ((0, 33), (1, 51))]
        assert mine[0] & mine[1], start
