"""Occurrences against naive search over words; shards; the contamination rule."""

import random
import re

import pytest
from pyspark.sql import functions as F

from stresscast.llm import wu_manber


def words(t):
    t = re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", t)


def naive(docs, items, size):
    wins = {}
    for i, t in items:
        w = words(t)
        m = min(size, len(w))
        for k in range(len(w) - m + 1 if m else 0):
            wins.setdefault(tuple(w[k:k + m]), set()).add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for m in {len(x) for x in wins}:
            for k in range(len(w) - m + 1):
                if ids := wins.get(tuple(w[k:k + m])):
                    hit |= set(range(k, k + m))
                    found |= ids
        out.append((d, len(w), len(hit), tuple(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("shard_bytes", [1 << 20, 400])
def test_against_naive_search(spark, make_docs, shard_bytes):
    rng = random.Random(10)
    vocab = ["a", "b", "c", "Ä", "x1", "don't"]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate((0, 1, 2, 3, 4, 5, 6, 9, 9, 12))] + [(1, "q w"), (None, "zz top"), (77, None), (77, "!!")]
    items = [x for x in items if x[1] not in ("a", "b", "c")]
    docs = [(i, text(rng.randrange(40))) for i in range(80)] + [(500, None), (501, ""), (502, "ZZ, top! " + text(400)), (3, "zz-top"),
                                                            (3, "zz-top"), (None, items[7][1]), (503, "\x00 \x7f")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("window", F.lit(1))
    got = wu_manber.contamination(make_docs(docs), bench, size=4, shard_bytes=shard_bytes)
    rows = [(r.row.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in got.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(rows, key=key) == sorted(naive(docs, items, 4), key=key)


def test_empty_tables(spark, make_docs):
    bench = spark.createDataFrame([(1, "some text")], "item_id long, text string")
    docs = make_docs([(1, "some text of it")])
    assert wu_manber.contamination(docs.where("doc_id < 0"), bench).count() == 0
    row = wu_manber.contamination(docs, bench.where("item_id < 0")).first()
    assert (row.n_words, row.n_hit, row["items"], row.contaminated) == (4, 0, [], False)


def test_shift_table_skips():
    m = wu_manber.Machine(5, {b"a b c d e": ["1"], b"b c d e f": ["2"]})
    assert m.shift[(b"d", b"e")] == 0 and m.shift[(b"a", b"b")] == 3
    assert [(s, i) for s, i in m.search("x a b c d e f x".encode().split())] == [(1, ["1"]), (2, ["2"])]
