"""Fingerprints against the definition; components against all pairs; hot blocks; the pipeline's choice."""

import random

import numpy as np
import xxhash

from pyspark.sql import functions as F

from stresscast.llm import components, simhash


def fingerprint(text, k=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(fps, bits=4):
    """Smallest member of each connected class of (id, fingerprint)."""
    ids = list(fps)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a in ids:
        for b in ids:
            if bin(fps[a] ^ fps[b]).count("1") <= bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_documents(make_docs):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(50)] + ["Ünï", "A-B"]
    base = [" ".join(rng.choice(words) for _ in range(n)) for n in (0, 1, 3, 4, 5, 60, 200, 400)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, t.upper() if i % 2 else t.replace(" ", "\t\n ")) for i, t in enumerate(base)]
    for i in range(20):
        w = base[-1].split()
        w[rng.randrange(len(w))] = "changed"
        rows.append((200 + i, " ".join(w)))
    rows += [(300, None), (301, ""), (302, " \n "), (5, base[5]), (400, "x" * 50_000 + " " + "y " * 5000)]
    got = [(r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(make_docs(rows)).collect()]
    assert len(got) == len(rows)
    want = {i: fingerprint(t) for i, t in rows}
    assert all(fp % (1 << 64) == want[i] for i, fp, _ in got)
    cls = classes(want)
    assert {(i, c) for i, _, c in got} == {(i, cls[i]) for i, _ in rows}


def test_hot_keys_in_small_blocks(spark):
    """A dense ball of fingerprints, compared in tiny blocks and over many partitions, loses no link."""
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    fps = {0, (1 << 64) - 1, centre}
    for n in (1, 1, 2, 2, 3, 4, 5, 6):
        for _ in range(25):
            x = centre
            for b in rng.sample(range(64), n):
                x ^= 1 << b
            fps.add(x)
    fps |= {rng.getrandbits(64) for _ in range(100)}
    numbered = dict(enumerate(sorted(fps)))
    df = spark.createDataFrame([(simhash._signed(x),) for x in numbered.values()], "fp long").repartition(7)
    links = simhash.similar_links(df, short_run=2, block=3).collect()
    assert all(bin((r.a ^ r.b) % (1 << 64)).count("1") <= 4 for r in links)
    at = {x: i for i, x in numbered.items()}
    roots = components.connected_components(spark.createDataFrame(
        [(at[r.a % (1 << 64)], at[r.b % (1 << 64)]) for r in links], "a long, b long")).collect()
    got = {i: i for i in numbered} | {r.node: r.root for r in roots}
    assert got == classes(numbered)


def test_variants_cover_four_bits():
    """Every pair within four bits passes under exactly one of the shared keys; others pass under none."""
    rng = np.random.default_rng(3)
    masks = [m & ~(1 << bit) for m, (s, n) in zip(simhash.MASKS, simhash.SEGMENTS) for bit in range(s, s + n)] + simhash.MASKS
    for bits in (1, 2, 3, 4, 5):
        for _ in range(200):
            x = sum(1 << int(b) for b in rng.choice(64, bits, replace=False))
            met = [v for v, m in enumerate(masks) if x & m == 0]
            ok = [v for v in met if simhash._linked(np.array([v]), np.array([x], np.uint64), 4)[0]]
            assert len(ok) == (1 if bits <= 4 else 0)


def test_components_of_a_chain_and_empty(spark):
    chain = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(7, 7), (3, 4), (None, 1)], "a long, b long")
    got = components.connected_components(chain).collect()
    assert {(r.node, r.root) for r in got} == {(i, 0) for i in range(201)}
    assert components.connected_components(chain.where("a < 0")).count() == 0


def test_one_document_of_each_group(make_docs):
    t = " ".join(f"word{i}" for i in range(80))
    rows = [(3, t), (1, t), (1, t), (2, "other text here now"), (9, None), (8, ""), (None, t), (None, "lonely words of no id")]
    docs = make_docs(rows)
    kept = simhash.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id, r.text) for r in kept.collect()) == [
        (False, 1, t), (False, 2, "other text here now"), (False, 8, ""), (True, None, "lonely words of no id")]


def test_empty_table(make_docs):
    empty = make_docs([(1, "x")]).where("doc_id < 0")
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.one_of_each_group(empty).count() == 0


def test_fingerprint_is_the_native_hash(spark):
    t = "one two three four"
    native = spark.range(1).select(F.xxhash64(F.lit(t)).alias("h")).first().h % (1 << 64)
    assert simhash.simhash64(t.encode(), 4) == native
