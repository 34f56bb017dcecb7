"""Filter audit: the matrix, every count of the table against documents one by one, and edge rows."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from stresscast.llm import filter_audit
from stresscast.llm.filter_audit import FILTERS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fails_of(texts):
    """Set of failed filters per document, by definition."""
    out = []
    for d, text in texts:
        text = text or ""
        words = WORD.findall(text)
        f = set()
        if len(words) < 200:
            f.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            f.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text):
            f.add("C")
        if re.search(r"[#$%&*|]", text):
            f.add("D")
        if d is not None and any(o is not None and o < d and (t or "") == text for o, t in texts):
            f.add("E")
        out.append(f)
    return out


def table_of(texts, parts, labels):
    """The audit, document by document."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    failed, out = fails_of(texts), {}
    for part in {p or "" for p in parts}:
        docs = [(d, f) for (d, _), p, f in zip(texts, parts, failed) if (p or "") == part]
        shapley = dict.fromkeys(FILTERS, 0)
        for order in itertools.permutations(FILTERS):
            left = docs
            for step, name in enumerate(order, 1):
                removed = [x for x in left if name in x[1]]
                left = [x for x in left if name not in x[1]]
                shapley[name] += len(removed)
                out[part, "".join(order), step] = [
                    len(left), len(removed), sum(name in f for _, f in docs) - len(removed),
                    sum(f == {name} for _, f in docs), sum(d in good for d, _ in removed),
                    sum(d in toxic for d, _ in removed)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audit(spark, texts, parts, labels):
    docs = spark.createDataFrame([(d, t, p, i) for i, ((d, t), p) in enumerate(zip(texts, parts))],
                                 "doc_id long, text string, lang string, mask int")
    for name in ("n", "hash", "part", "flags", "shard", "quality"):  # names the operator uses itself
        docs = docs.withColumn(name, F.lit("clash"))
    rows = filter_audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
                              .withColumn("mask", F.lit(1))).collect()
    assert len({(r["part"], r["filter_order"], r["step"]) for r in rows}) == len(rows)
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in COLUMNS] for r in rows}


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)] + ["Big", "SHOUT", "a|b", "#", "100%", "é", "字"]
    texts, parts = [], []
    for d in range(n):
        few = rng.random() < 0.3
        text = rng.choice([" ", "\n", "\t\x0b "]).join(rng.choices(words[:20 if few else 400], k=rng.choice([0, 1, 199, 200, 260])))
        if rng.random() < 0.3:
            text += " " + " ".join(rng.choices(words[400:], k=rng.randint(1, 30)))
        texts.append((d, text))
        if rng.random() < 0.2:
            texts.append((rng.choice([d, n + d, None]), text))
        if rng.random() < 0.1:
            texts.append((2 * n + d, texts[0][1]))
    texts += [(None, None), (5000, None), (5001, ""), (5002, " "), (5003, "A" * 4 + "x" * 96), (5004, "AAA" + "x" * 97),
              (5005, "\x1c \x1d"), (5006, "字" * 100 + "AAA"), (5007, "b" * 100000 + " " + "c" * 300000)]
    for _ in texts:
        parts.append(rng.choice(["en", "de", "", None]))
    labels = [(d, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for d, _ in texts for _ in range(rng.randint(0, 2))]
    return texts, parts, labels


def test_table_against_documents_one_by_one(spark, monkeypatch):
    texts, parts, labels = corpus(150, 3)
    want = table_of(texts, parts, labels)
    assert audit(spark, texts, parts, labels) == want
    monkeypatch.setattr(filter_audit, "SHARD_BYTES", 3000)
    monkeypatch.setattr(filter_audit, "BUCKET_BYTES", 20_000)
    assert audit(spark, texts, parts, labels) == want


def test_empty_tables(spark):
    assert audit(spark, [], [], []) == {}
    assert audit(spark, [(1, "a")], [None], []) == table_of([(1, "a")], [None], [])


def test_matrix_is_the_documents_words(spark, monkeypatch):
    """Every entry: decoded by the global dictionary, a row is the word counts of its document."""
    monkeypatch.setattr(filter_audit, "SHARD_BYTES", 2000)
    monkeypatch.setattr(filter_audit, "BUCKET_BYTES", 3000)
    texts, _, _ = corpus(40, 4)
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string")
    shards = filter_audit.local_shards(docs.withColumn("lang", F.lit("en")))
    words = filter_audit.dictionary(shards)
    name = {r["word_id"]: r["word"] for r in words.collect()}
    assert words.count() == len(name) == len(set(name.values())) and len({i >> 32 for i in name}) > 3
    matrix = filter_audit.term_matrix(shards).collect()
    assert len(matrix) > 4
    seen = {}
    for m in matrix:
        ends = np.cumsum(m["row_size"])
        for d, size, end in zip(m["doc_id"], m["row_size"], ends):
            columns = m["indices"][end - size:end]
            assert columns == sorted(set(columns))
            seen[d] = {name[c]: k for c, k in zip(columns, m["counts"][end - size:end])}
    for i, (_, text) in enumerate(texts):
        found = WORD.findall(text or "")
        assert seen[i] == {w: found.count(w) for w in set(found)}


def test_texts_never_cross_the_network(spark, make_docs):
    """After the matrix is written only words, shards and flags are exchanged."""
    plan = filter_audit.failures(make_docs([(1, "a b"), (2, "c")]))._jdf.queryExecution().toString()
    assert "text#" not in plan.split("Physical Plan")[1]


def test_rows_of_the_matrix_are_blocks(spark, monkeypatch):
    """However much one task writes: no row holds a shard, no row group a task's rows, and no task gathers a shard in one row."""
    monkeypatch.setattr(filter_audit, "SHARD_BYTES", 20_000)
    monkeypatch.setattr(filter_audit, "BLOCK_BYTES", 1000, raising=False)
    monkeypatch.setattr(filter_audit, "BUCKET_BYTES", 5000)
    texts = [(d, " ".join(f"w{d * k % 977}" for k in range(100))) for d in range(400)] + [(d, "") for d in range(400, 700)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("lang", F.lit("en")).coalesce(1)
    shards = filter_audit.local_shards(docs)
    rows = shards.collect()
    assert sorted(d for r in rows for d in r["doc_id"]) == [d for d, _ in texts]
    assert max(len(r["doc_id"]) for r in rows) < 20 and max(len(r["indices"]) for r in rows) < 3000
    assert len(rows) > 4 * len({r["shard"] for r in rows}) > 8
    assert all(r["n_words"] == sum(w["n"] for w in r["words"]) for r in rows)
    assert len({(r["shard"], w["bucket"]) for r in rows for w in r["words"]}) == sum(len(r["words"]) for r in rows)
    files = ds.dataset([f.removeprefix("file://") for f in shards.inputFiles()]).files
    groups = [m.row_group(g).num_rows for m in map(pq.read_metadata, files) for g in range(m.num_row_groups)]
    assert sum(groups) == len(rows) and max(groups) <= 64 < len(rows)
    totals = filter_audit.row_totals(shards)
    assert "collect_list" not in totals._jdf.queryExecution().toString()
    assert {r["doc_id"]: (r["n_words"], r["n_distinct"]) for r in totals.collect()} == {
        d: (len(t.split()), len(set(t.split()))) for d, t in texts}


def test_shards_meet_their_ids_once(spark, make_docs):
    """Rows with and without an id are counted from one run of the steps before."""
    docs = make_docs([(1, "a b"), (2, "c"), (None, "c")])
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    cells = filter_audit.failure_counts(filter_audit.failures(docs), labels)
    rows = cells.collect()
    assert sorted((r["mask"] & 16, r["n"], r["good"], r["toxic"]) for r in rows) == [(0, 3, 1, 0)]
    plan = cells._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    steps = Counter(re.findall(r"(\w+InArrow) ", plan))
    assert steps and max(steps.values()) == 1


def test_packed_integers():
    for values in ([], [0], [0, 0, 0], [255, 0], [256], [1 << 16, 3], [(1 << 32) - 1, 0, 7]):
        raw = filter_audit._pack(np.array(values, np.int64))
        assert filter_audit._unpack(raw).tolist() == values
    assert len(filter_audit._pack(np.arange(200))) == 201
