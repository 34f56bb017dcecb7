"""Targets and apportionment against plain Python; the mix keeps its promises; reruns agree."""

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stresscast.llm import mixing


def targets(sizes):
    """Water level by repeated sharing."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, out, free = 1.5 * sum(sizes.values()), {}, set(order)
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not full:
            out |= {s: weight[s] * level for s in free}
            break
        out |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        free -= full
    return out


def highest_quotients(votes, seats):
    got = {k: 0 for k in votes}
    for _ in range(seats):
        best = min((k for k in votes if votes[k] > 0), key=lambda k: (-votes[k] / (2 * got[k] + 1), k))
        got[best] += 1
    return got


def corpus(rng):
    rows = []
    for i in range(400):
        source = rng.choice(["hot"] * 6 + ["a", "b", "B", "é", "zz", "", None])
        rows.append((i, rng.choice(["w " * rng.randrange(60), " \t ", "", None, "one\ntwo\x0bthree four"]), source))
    return rows + [rows[3], rows[3], (7, "other version", "hot"), (None, "no id here", "a"), (999, "long " * 20_000, "zz")]


@pytest.mark.parametrize("options", [{}, {"n_blocks": 50, "shard_rows": 7}, {"n_blocks": 3}])
def test_mix(make_docs, options):
    rows = corpus(random.Random(16))
    docs = make_docs(rows)
    out = [tuple(r) for r in mixing.mix(docs, **options).collect()]
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    per = defaultdict(int)
    for _, t, s in rows:
        per[s] += count(t)
    want = targets(dict(per))
    assert len(out) == len(rows)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    expected = sorted(((i, count(t), per[s], want[s]) for i, t, s in rows), key=key)
    for got, (i, size, source_size, target) in zip(sorted(out, key=key), expected):
        assert got[:3] == (i, size, source_size) and got[3] == pytest.approx(target) and 0 <= got[4] <= 2 * size
    taken = defaultdict(int)
    for _, _, size, target, n in out:
        taken[size, round(target, 6)] += n
    block = max(1, -(-int(sum(per.values()) * 1.5) // options.get("n_blocks", mixing.N_BLOCKS)))
    shards = 400 // options.get("shard_rows", mixing.SHARD_ROWS) + 2
    for s in per:
        assert abs(taken[per[s], round(want[s], 6)] - want[s]) <= block * shards, s
    again = mixing.mix(docs.repartition(5, F.rand(3)), **options)
    assert sorted(map(repr, out)) == sorted(repr(tuple(r)) for r in again.collect())


def test_sainte_lague(spark):
    rng = random.Random(17)
    rows, want = [], {}
    for g in range(40):
        votes = {k: rng.choice([0, 1, 3, 10, rng.randrange(1000)]) for k in range(rng.randrange(1, 9))}
        seats = rng.choice([0, 1, 5, 17, 400]) if any(votes.values()) else 0
        want |= {(g, k): n for k, n in highest_quotients(votes, seats).items()}
        rows += [(g, k, v, seats) for k, v in votes.items()]
    df = spark.createDataFrame(rows, "g int, k int, v long, seats long")
    got = {(r.g, r.k): r.out for r in mixing.sainte_lague(df, ["g"], "k", "v", "seats", "out").collect()}
    assert got == want


def test_empty_and_blank(make_docs):
    docs = make_docs([(1, " "), (2, None, None)])
    assert {tuple(r) for r in mixing.mix(docs).collect()} == {(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)}
    assert mixing.mix(docs.where("doc_id < 0")).count() == 0


@pytest.mark.parametrize("shard_rows", [7, 4096])
def test_sources_far_below_a_block(make_docs, shard_rows):
    texts = [("huge", 600, 100), ("a", 1, 100), ("b", 10, 10), ("tiny", 1, 1), ("blank", 3, 0), (None, 4, 2)]
    rows = [(i * 1000 + k, "w " * n, s) for i, (s, docs, n) in enumerate(texts) for k in range(docs)]
    size = {s: docs * n for s, docs, n in texts}
    want = targets(size)
    by_id = {i: s for i, _, s in rows}
    # A block of 1805 and of 5 words: the small sources are full at 1 to 200 words, and no document may lose them.
    for n_blocks in (50, 20_000):
        taken = defaultdict(int)
        for r in mixing.mix(make_docs(rows), n_blocks=n_blocks, shard_rows=shard_rows).collect():
            taken[by_id[r.doc_id]] += r.taken
            assert 0 <= r.taken <= 2 * r.size and (r.source_size > 100 or r.taken == 2 * r.size)
        assert all(abs(taken[s] - want[s]) <= 1 for s in size if s != "huge"), (taken, want)
        assert abs(taken["huge"] - want["huge"]) <= 1 + 2 * (90_000 // n_blocks + 1) * (n_blocks > 50)


def test_capped_source_fills_its_shards(make_docs):
    rng = random.Random(18)
    rows = [(k, "w " * rng.randrange(1, 9), "a") for k in range(300)]
    rows += [(1000 + k, "w " * 50, "b") for k in range(300)]
    want = 2 * sum(len(t) // 2 for _, t, s in rows if s == "a")
    for n_blocks in (100, 1000, 3000):  # blocks of 250, 25 and 9 words; shards of about 15
        out = mixing.mix(make_docs(rows), n_blocks=n_blocks, shard_rows=3).where("doc_id < 1000").agg(F.sum("taken")).first()[0]
        block = -(-int(1.5 * (want // 2 + 15_000)) // n_blocks)
        assert want - block * (n_blocks > 1000) <= out <= want
