"""The five stages one after the other against brute force on a small corpus, and the registered queries."""

import random

import numpy as np
import pytest

from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from stresscast.llm import pu_quality

from .test_mixing import targets
from .test_pu_quality import documents
from .test_secret_scan import base
from .test_simhash import classes, fingerprint
from .test_wu_manber import naive

QUERIES = [f"op{n}_" for n in range(1, 11)]


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    rng = random.Random(23)
    rows, labels = documents(250, 24)
    passage = " ".join(f"bench{i}" for i in range(14))
    text = dict(rows)
    for i in range(0, 250, 10):
        text[i] += f" {passage}"
    for i in range(5, 250, 25):
        text[i] += f" token = '{''.join(rng.choice('0123456789abcdef') for _ in range(40))}' tail"
    for i in range(3, 60, 7):
        text[300 + i] = text[i]
        words = text[i].split()
        words[rng.randrange(len(words))] = "other"
        text[400 + i] = " ".join(words)
    full = [(i, t, "en", f"src{i % 4}", len(t)) for i, t in text.items()] + [(900, None, None, None, 0), (901, "", "en", "src0", 0)]
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").selectExpr("*", "0 as toxic").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, passage), (2, "short item")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, full


def test_stages_against_brute_force(spark, small):
    d, full = small
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns = docs.columns
    got = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, d)
        assert k == 4 or out.columns == columns
        path = f"{d}/stage{k}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        got.append({r.doc_id: r for r in docs.collect()})

    known = spark.read.parquet(f"{d}/labels.parquet")
    model = pu_quality.fit(pu_quality.feature_table(spark.read.parquet(f"{d}/documents.parquet")), pu_quality.learnable(known))
    scores = model.scores(np.array([pu_quality.text_features((t or "").encode()) for _, t, *_ in full]))
    one = {i: t for (i, t, *_), s in zip(full, scores) if s >= 0.5}
    assert got[0].keys() == one.keys() and len(one) < len(full)

    cls = classes({i: fingerprint(t) for i, t in one.items()})
    two = {i: one[i] for i in one if cls[i] == i}
    assert {i: r.text for i, r in got[1].items()} == two and len(two) < len(one)

    bad = {r[0] for r in naive(list(two.items()), [(1, " ".join(f"bench{i}" for i in range(14))), (2, "short item")], 13) if r[4]}
    assert bad and got[2].keys() == two.keys() - bad

    for i, r in got[3].items():
        spans, t = base(two[i]), two[i]
        assert (r.text != t) == bool(spans)
        if not spans:
            continue
        assert "[secret]" in r.text and not any(t[s:e] in r.text for s, _, e in spans) and r.n_chars == len(r.text)
    assert got[3].keys() == got[2].keys()

    sizes = {}
    for r in got[3].values():
        sizes[r.source] = sizes.get(r.source, 0) + len((r.text or "").split())
    want = targets(sizes)
    taken = {}
    for i, r in got[4].items():
        assert 0 < r.taken <= 2 * r["size"] and r["size"] == len(got[3][i].text.split())
        taken[got[3][i].source] = taken.get(got[3][i].source, 0) + r.taken
    assert all(abs(taken.get(s, 0) - want[s]) <= 4 for s in want)

    whole = corpus_pipeline.run(spark, d)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, got[4].values()))


def test_stages_on_empty_documents(spark, small):
    d, _ = small
    docs = spark.read.parquet(f"{d}/documents.parquet").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, d)
        assert docs.count() == 0


def test_extra_columns_and_repeats_pass_through(spark, small):
    d, _ = small
    docs = spark.read.parquet(f"{d}/documents.parquet").withColumns({c: F.lit(1) for c in ("row", "t", "fp", "spans", "score", "base", "rank")})
    docs = docs.unionByName(docs.where("doc_id = 7"))
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, docs, d).columns == docs.columns


def test_registered():
    names = list(entry.queries())
    for prefix in QUERIES:
        assert sum(n.startswith(prefix) for n in names) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)
