"""Text statistics by definition; the list learns planted rules and keeps clean documents."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from stresscast.llm import decision_list


def statistics(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    count = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    inside = {k for i in range(len(w) - 2) if count[tuple(w[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    n = len(inside)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, n, len(w) < 50 or 100 * n > 50 * len(w))


def test_statistics(make_docs):
    rng = random.Random(11)
    texts = ["", None, " \n\t ", "a", "a b", "a b c", "a b c d", "a a a a", "x y z x y z", "one\none\n\n \none", "l1 a\nl1 a\r\nl1 a",
             "𝒳 é # * $ % & | < >", "a b " * 4000, "nb space", "ends\n"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(30))) for _ in range(60)]
    texts += ["\n".join(rng.choice(["x y", "x  y", "", " "]) for _ in range(8)) for _ in range(20)]
    rows = list(enumerate(texts)) + [(5, texts[5]), (None, "q r s")]
    got = [(r.doc_id, *r[1:7]) for r in decision_list.text_statistics(make_docs(rows)).collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted([(i, *statistics(t)) for i, t in rows], key=key)


def documents(rng, n):
    vocab = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.randrange(60, 200))]
        kind = i % 5
        if kind == 0:
            words = [w + rng.choice(("***", "$$$", "###")) for w in words]
        elif kind == 1:
            words = [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, int(kind > 1)))
    return rows, labels


def test_learns_planted_rules(spark, make_docs):
    rows, labels = documents(random.Random(12), 300)
    lab = spark.createDataFrame(labels[:200] + [(7, None), (None, 0), (3, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in decision_list.judged(make_docs(rows), lab).collect()}
    want = {i: q for i, q in labels}
    assert sum(got[i].kept == bool(want[i]) for i in want) >= 297
    assert all(got[i].kept for i in want if want[i])
    assert all(got[i].rule for i in want if not want[i] and not got[i].base_failed)


def test_learns_rare_kinds(spark):
    rng = random.Random(23)
    rows = []
    for i in range(10_000):
        rates = {r: rng.random() * 0.4 for r in decision_list.RATES}
        rates["dup_line_rate"] = rng.random() * 0.3 if i % 100 == 1 else 0.0  # mostly constant
        kind = "upper" if i % 100 == 0 else "dup" if i % 120 == 7 else "symbol" if i % 10 == 5 else None
        if kind == "upper":
            rates["upper_rate"] = 0.5 + rng.random() / 2
        elif kind == "dup":
            rates["dup_line_rate"] = 0.31 + rng.random() / 2
        elif kind == "symbol":
            rates["symbol_rate"] = 0.6 + rng.random() / 3
        rows.append((i, kind, *[rates[r] for r in decision_list.RATES]))
    df = spark.createDataFrame(rows, "doc_id long, kind string, " + ", ".join(f"{r} double" for r in decision_list.RATES))
    labels = df.selectExpr("doc_id", "int(kind is null) as quality")
    rules = decision_list.learn(df, labels)
    caught = df.withColumn("rule", decision_list.decision(rules))
    share = {r.kind: r.share for r in caught.groupBy("kind").agg(F.avg(F.col("rule").isNotNull().cast("int")).alias("share")).collect()}
    assert share[None] <= 0.001 and all(share[k] >= 0.95 for k in ("upper", "dup", "symbol")), (share, list(map(str, rules)))


def test_no_labels_and_empty(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows, _ = documents(random.Random(13), 10)
    assert all(r.kept and r.rule is None for r in decision_list.judged(make_docs(rows), none).collect())
    assert decision_list.judged(make_docs(rows).where("doc_id < 0"), none).count() == 0


def test_list_is_ordered(spark):
    a = decision_list.Rule((decision_list.Condition("x", True, 1.0),), 1, 0)
    b = decision_list.Rule((decision_list.Condition("x", True, 0.0), decision_list.Condition("y", False, 5.0)), 1, 0)
    df = spark.createDataFrame([(2.0, 1.0), (0.5, 1.0), (0.5, 9.0), (None, 1.0)], "x double, y double")
    assert [r[0] for r in df.select(decision_list.decision([a, b])).collect()] == [1, 2, None, None]
    assert str(b) == "x > 0 and y <= 5"
    assert df.select(F.coalesce(decision_list.decision([]), F.lit(0)).alias("r")).agg(F.sum("r")).first()[0] == 0
