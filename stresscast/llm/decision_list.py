"""Quality rules: a learned decision list over text statistics, applied as Spark conditional expressions.

Sequential covering (as in IREP and RIPPER): a rule against the bad documents is grown condition by condition by
the gain in purity on one part of the labelled documents, pruned from its end on the other part, and kept if it is
right there often enough; the documents it covers leave, and the next rule is grown. The list is ordered: the first
rule that holds decides, and documents under no rule are kept.

Scale and style: only DataFrame functions touch rows. The statistics of a text are array expressions within
its row, so nothing is shuffled for them. Learning works on a table of bin numbers of the labelled documents that no rule
has taken yet, with new thresholds for every rule: every growing step is one map-side combined count per (feature, bin,
label), one or two thousand rows for any input.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stresscast.llm.common import docs_with, staged, words_of

#: Statistics that rules may test; all are rates, so they mean the same for short and long texts.
RATES = ("symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate", "shout_rate", "word_length", "echo_rate")
#: Candidate thresholds per statistic: so many quantiles of the labelled documents and of their values above 0, four times
#: as many of the bad documents, and both tails down to ``LEAST_TAIL``.
N_CUTS = 32
LEAST_TAIL = 1 / 8192
#: Thresholds that a value's bin is sought among at a time.
STEP = 16


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and rates of each whole text, one row per document row (null text: no words).

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols`` (characters of ``#*$%&|<>``), ``n_dup_lines``
    (lines with a word that equal an earlier line), ``n_repeat_words`` (words inside 3-word windows found twice or
    more, the first included), ``base_failed`` (fewer than 50 words, or more than half of them repeated).
    """
    text = F.coalesce(F.col("_t"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    # Windows as (words, place) in order: equal neighbours are windows found again.
    windows = F.sort_array(F.transform(F.sequence(F.lit(1), F.size("_w") - 2), lambda i: F.struct(
        F.concat_ws(" ", F.slice("_w", i, 3)).alias("s"), i.alias("i"))))
    again = F.filter("_v", lambda x, k: (x["s"] == F.get("_v", k - 1)["s"]) | (x["s"] == F.get("_v", k + 1)["s"]))
    places = F.sort_array(F.transform(again, lambda x: x["i"]))
    covered = F.aggregate("_p", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda acc, i: F.struct(
        (acc["n"] + F.least(F.lit(3), i + 3 - acc["end"])).alias("n"), (i + 3).alias("end")), lambda acc: acc["n"])
    n = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    none = F.array().cast("array<struct<s:string,i:int>>")
    out = (docs_with(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_t"))
           .withColumn("_w", words_of(F.col("_t"))).withColumn("_l", lines)
           .withColumn("n_words", F.size("_w").cast("long"))
           .withColumn("word_chars", F.length(F.array_join("_w", "")).cast("long"))
           .withColumn("n_symbols", F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"))
           .withColumn("n_upper", F.length(F.regexp_replace(text, r"\P{Lu}+", "")).cast("long"))
           .withColumn("n_shouts", F.length(F.regexp_replace(text, "[^!]+", "")).cast("long"))
           .withColumn("n_echoes", F.size(F.filter("_w", lambda x, i: x == F.get("_w", i - 1))).cast("long"))
           .withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"))
           .withColumn("n_lines", F.size("_l").cast("long"))
           .withColumn("_v", F.when(F.size("_w") > 3, windows).otherwise(none))
           .withColumn("_p", places)
           .withColumn("n_repeat_words", covered.cast("long"))
           .drop("_t", "_w", "_l", "_v", "_p"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
        (F.col("n_symbols") / chars).alias("symbol_rate"),
        (F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("dup_line_rate"),
        (F.col("n_repeat_words") / n).alias("repeat_rate"), (F.col("n_upper") / chars).alias("upper_rate"),
        (F.col("n_shouts") / n).alias("shout_rate"), (F.col("word_chars") / n).alias("word_length"),
        (F.col("n_echoes") / n).alias("echo_rate"))


@dataclass(frozen=True)
class Condition:
    """``feature <= threshold`` or ``feature > threshold``."""

    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        c = F.col(self.feature)
        return c > F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)


@dataclass(frozen=True)
class Rule:
    """A conjunction that rejects, with the labelled documents it covered on the pruning part."""

    conditions: tuple[Condition, ...]
    bad: int
    good: int

    def column(self) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.column()
        return out

    def __str__(self) -> str:
        return " and ".join(f"{c.feature} {'>' if c.above else '<='} {c.threshold:.6g}" for c in self.conditions)


def _cuts(table: DataFrame, n_cuts: int) -> dict[str, list[float]]:
    """Candidate thresholds: distinct quantiles of each statistic over the labelled documents and over parts of them."""
    def shares(n: int) -> Column:
        tails = [2.0 ** -k for k in range(1, 64) if LEAST_TAIL <= 2.0 ** -k < 1 / n]
        return F.array(*map(F.lit, [i / n for i in range(n + 1)] + tails + [1 - t for t in tails]))

    def among(rate: str, part: Column | None, n: int) -> Column:
        return F.percentile_approx(F.col(rate) if part is None else F.when(part, F.col(rate)), shares(n), 10_000)

    found = table.agg(*[among(r, part, n).alias(f"{r}_{i}") for r in RATES for i, (part, n) in enumerate((
        (None, n_cuts), (F.col(r) > 0, n_cuts), (F.col("bad"), 4 * n_cuts), (F.col("bad") & (F.col(r) > 0), 4 * n_cuts)))]).first()
    return {r: sorted({x for i in range(4) for x in found[f"{r}_{i}"] or []}) for r in RATES}


def _binned(table: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """Bin number of each statistic: how many thresholds it is above (first every ``STEP``-th, then those between two)."""
    def below(rate: str, among: Column) -> Column:
        return F.size(F.filter(among, lambda c: c < F.col(rate)))

    def above(rate: str) -> Column:
        if not cuts[rate]:
            return F.lit(0)
        every = F.array(*map(F.lit, cuts[rate][STEP - 1::STEP])).cast("array<double>")
        return below(rate, every) * STEP

    out = table.select("bad", "grow", *RATES, *[above(r).alias(f"_{r}") for r in RATES])
    return out.select("bad", "grow", *[(F.col(f"_{r}") + below(r, F.slice(
        F.array(*map(F.lit, cuts[r])).cast("array<double>"), F.col(f"_{r}") + 1, STEP))).alias(r) for r in RATES])


def _where(conditions: list[tuple[str, bool, int]]) -> Column:
    """Conditions on bins: above threshold k means a bin beyond k."""
    out = F.lit(True)
    for rate, above, k in conditions:
        out = out & ((F.col(rate) > k) if above else (F.col(rate) <= k))
    return out


def _profile(rows: DataFrame) -> dict[str, list[tuple[int, int, int]]]:
    """Per statistic: (bin, bad, good) counts."""
    each = rows.select("bad", F.explode(F.map_from_arrays(
        F.array(*map(F.lit, RATES)), F.array(*[F.col(r) for r in RATES]))).alias("rate", "bin"))
    out: dict[str, list[tuple[int, int, int]]] = {r: [] for r in RATES}
    for r in each.groupBy("rate", "bin").agg(F.sum(F.col("bad").cast("int")).alias("bad"), F.count("*").alias("n")).collect():
        out[r["rate"]].append((r["bin"], r["bad"], r["n"] - r["bad"]))
    return {k: sorted(v) for k, v in out.items()}


def _best(profile: dict[str, list[tuple[int, int, int]]], conditions: list) -> tuple[float, tuple[str, bool, int] | None]:
    """The condition of most information gain for the bad documents; ties go to the first statistic and threshold."""
    best: tuple[float, tuple[str, bool, int] | None] = (0.0, None)
    for rate in RATES:
        bins = profile[rate]
        bad, good = sum(b[1] for b in bins), sum(b[2] for b in bins)
        if not bad:
            continue
        start = math.log2(bad / (bad + good))
        low_bad = low_good = 0
        for k, b, g in bins[:-1]:
            low_bad, low_good = low_bad + b, low_good + g
            for above, p, n in ((True, bad - low_bad, good - low_good), (False, low_bad, low_good)):
                if p and (gain := p * (math.log2(p / (p + n)) - start)) > best[0] + 1e-9 and (rate, above, k) not in conditions:
                    best = gain, (rate, above, k)
    return best


def _centred(table: DataFrame, c: Condition) -> Condition:
    """The same condition with its threshold half-way to the next value that occurs."""
    x = F.col(c.feature)
    low, high = table.agg(F.max(F.when(x <= c.threshold, x)), F.min(F.when(x > c.threshold, x))).first()
    return c if low is None or high is None else Condition(c.feature, c.above, (low + high) / 2)


def learn(statistics: DataFrame, labels: DataFrame, max_rules: int = 16, max_conditions: int = 4,
          least_precision: float = 0.9, n_cuts: int = N_CUTS) -> list[Rule]:
    """Rules that reject documents labelled bad, from statistics and ``labels (doc_id, quality)``.

    A document with several labels is bad if any says 0; null labels and ids are none. Two thirds of the
    labelled documents grow rules, one third (by crc32 of the id) prunes them. A rule is kept if
    it is right for ``least_precision`` of the pruning documents it covers. No labels: no rules.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        (F.min("quality") == 0).alias("bad"))
    table = staged(statistics.join(known, "doc_id").select(
        "bad", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 0).alias("grow"), *RATES), "labelled")
    left, rules = table, []
    for _ in range(max_rules):
        cuts = _cuts(left, n_cuts)
        rows = staged(_binned(left, cuts), "binned")
        conditions: list[tuple[str, bool, int]] = []
        while len(conditions) < max_conditions:
            profile = _profile(rows.where(F.col("grow") & _where(conditions)))
            if not sum(b[2] for b in profile[RATES[0]]) and conditions:
                break
            gain, found = _best(profile, conditions)
            if found is None:
                break
            conditions.append(found)
        if not conditions:
            break
        # Prune from the end: the prefix that is best on the other part, by (bad - good) / (bad + good).
        steps = [F.sum((_where(conditions[:k]) & (F.col("bad") == flag)).cast("int")).alias(f"{name}{k}")
                 for k in range(1, len(conditions) + 1) for name, flag in (("bad", True), ("good", False))]
        tried = rows.where(~F.col("grow")).agg(*steps).first()
        worth = [((tried[f"bad{k}"] or 0) - (tried[f"good{k}"] or 0)) / (((tried[f"bad{k}"] or 0) + (tried[f"good{k}"] or 0)) or 1)
                 for k in range(1, len(conditions) + 1)]
        k = worth.index(max(worth)) + 1
        bad, good = tried[f"bad{k}"] or 0, tried[f"good{k}"] or 0
        if not bad or bad < least_precision * (bad + good):
            break
        rules.append(Rule(tuple(_centred(table, Condition(r, a, cuts[r][i])) for r, a, i in conditions[:k]), bad, good))
        left = left.where(~rules[-1].column())
    return rules


def decision(rules: list[Rule]) -> Column:
    """The list as one ordered conditional expression: number of the rule that rejects, null if none does."""
    out = None
    for i, rule in enumerate(rules, 1):
        out = F.when(rule.column(), F.lit(i)) if out is None else out.when(rule.column(), F.lit(i))
    return F.lit(None).cast("int") if out is None else out


def judged(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Statistics, ``rule`` (the rejecting rule's number) and ``kept`` per document row; texts are read once."""
    statistics = staged(text_statistics(docs), "statistics")
    rules = learn(statistics, labels.select("doc_id", "quality"), **options)
    return statistics.withColumn("rule", decision(rules)).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
