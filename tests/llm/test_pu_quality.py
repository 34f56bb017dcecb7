"""Held-out accuracy on planted junk; risk and gradient against direct computation; edge cases."""

import random
import zlib

import numpy as np
import pytest

from stresscast.llm import pu_quality


def documents(n, seed=21):
    rng = random.Random(seed)
    vocab = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.randrange(30, 150))]
        bad = rng.random() < 0.2
        if bad:
            words = rng.choice(([w + "***" for w in words], [w.upper() + "!!" for w in words], [w for w in words[:20] for _ in range(6)]))
        rows.append((i, " ".join(words)))
        if rng.random() < 0.6:
            labels.append((i, 0 if bad else 1))
    return rows, labels


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_accuracy(spark, make_docs):
    rows, labels = documents(700)
    rows += [(9000, None), (9001, ""), (9002, "word " * 30_000), (5, rows[5][1]), (None, "no id")]
    lab = spark.createDataFrame(labels + [(3, None), (None, 1)], "doc_id long, quality int")
    got = pu_quality.quality(make_docs(rows), lab).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(by[i].held_out == held(i) for i, _ in rows if i is not None) and by[None].held_out is False
    out = [(by[i].predicted, q) for i, q in labels if held(i)]
    assert np.mean([p == q for p, q in out]) > 0.97


def test_held_out_labels_change_nothing(spark, make_docs):
    rows, labels = documents(150)
    docs = make_docs(rows)
    turned = [(i, 1 - q if held(i) else q) for i, q in labels]
    a, b = ({r.doc_id: r.score for r in pu_quality.quality(docs, spark.createDataFrame(x, "doc_id long, quality int")).collect()}
            for x in (labels, turned))
    assert a == pytest.approx(b, abs=1e-9)


def test_sums_against_direct(spark):
    rng = np.random.default_rng(22)
    x, positive, w = rng.normal(size=(50, 3)), rng.random(50) < 0.4, rng.normal(size=(2, 4))
    df = spark.createDataFrame([(a.tolist(), bool(p)) for a, p in zip(x, positive)], "x array<double>, positive boolean").repartition(5)
    got = pu_quality._sums(df, w, (0.0,) * 3, (1.0,) * 3)
    full = np.concatenate((x, np.ones((50, 1))), axis=1)
    for j in range(2):
        for c, rows in enumerate((full, full[positive])):
            f = rows @ w[j]
            s = 1 / (1 + np.exp(-f))
            want = np.concatenate(([len(rows), np.log1p(np.exp(f)).sum(), f.sum()], rows.sum(0), s @ rows,
                                   (rows.T * (s * (1 - s)) @ rows).ravel()))
            assert got[j, c] == pytest.approx(want)


def test_nothing_to_learn_from(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in pu_quality.quality(make_docs([(1, "x"), (2, None)]), none).collect()} == {0.5}
    assert pu_quality.quality(make_docs([(1, "x")]).where("doc_id < 0"), none).count() == 0


def test_column_form_agrees(spark, make_docs):
    rows, labels = documents(60)
    docs = make_docs(rows + [(500, None)])
    features = pu_quality.feature_table(docs)
    model = pu_quality.fit(features, pu_quality.learnable(spark.createDataFrame(labels, "doc_id long, quality int")))
    a = {r.doc_id: r.score for r in pu_quality.scored(features, model).collect()}
    b = {r.doc_id: r.s for r in docs.select("doc_id", pu_quality.score_column(model, docs["text"]).alias("s")).collect()}
    assert a == pytest.approx(b)
