"""Snapshots against pairwise comparison."""

import random

from pyspark.sql import functions as F

from stresscast.llm import chat_snapshots


def expected(rows):
    chats = {}
    for c, n, role, text in set(rows):
        chats.setdefault(c, set()).add((n, role, text))
    none_first = lambda t: tuple((v is not None, v if v is not None else "") for v in (t[1], t[2]))
    turns = {c: [(r, x) for _, r, x in sorted(v, key=lambda t: (t[0] is not None, t[0] or 0, none_first(t)))] for c, v in chats.items()}
    out = {}
    for c, t in turns.items():
        if any(len(u) > len(t) and u[:len(t)] == t for u in turns.values()):
            continue
        same = [d for d, u in turns.items() if u == t]
        if c == min(same, key=lambda d: (d is None, d or 0)):
            text = "".join(f"<|{r if r is not None else 'unknown'}|>\n{x or ''}\n<|end|>\n" for r, x in t)
            out[c] = (len(t), len(same), text)
    return out


def test_against_pairs(spark):
    rng = random.Random(18)
    rows = []
    for c in range(150):
        n = rng.randrange(1, 6)
        rows += [(c, k, ("user", "assistant")[k % 2], rng.choice(["hi", "ho", ""])) for k in range(n)]
    rows += [(200, 0, None, "hi"), (201, 0, None, "hi"), (201, 1, "user", None), (202, 0, "user", None), (203, 0, "user", ""),
             (None, 0, "user", "alone with no id"), (204, 5, "user", "long " * 20_000), (205, -3, "user", "x"), (205, -3, "user", "x"),
             (206, 0, "user", 'a"}'), (206, 1, "user", "b")]
    rows += [(300 + i, k, "user", f"t{k}") for i in range(30) for k in range(i + 1)]  # one log, 30 snapshots
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("hash", F.lit(1))
    got = {r.conv_id: (r.n_turns, r.n_equal, r.text) for r in chat_snapshots.render_conversations(df).collect()}
    assert got == expected(rows)
    assert chat_snapshots.render_conversations(df.where("turn > 99")).count() == 0
