"""Secret scans: three known shapes, and a battery of randomness tests for secrets of no known shape.

Every long run of token characters is a candidate. '=' ends it as padding or separates a name from its value. A run
that mixes + or / with - or _ fits no encoding and gives its longest parts without the ones and without the others. A
candidate's encoding is inferred from its characters, and within
that alphabet three tests ask whether the characters look drawn at random: chi-squared uniformity, the runs
test about the middle of the alphabet, and the lag-1 serial correlation, combined by Fisher's method. A short
word passes such tests for want of power, so a second p-value asks the opposite: how likely is a chi-squared
this small for *text* of this length, whose letters repeat with the index of coincidence of written language
(non-central chi-squared, so the evidence grows with length). These are held to a false-discovery
rate within each class of lengths (Benjamini-Hochberg). A candidate counts as a secret if it is a discovery and
looks random.

Scale and style: only column expressions touch rows. Positions come from the pieces between matches, within the
row. The false-discovery thresholds need the counts of p-values per length class and bin of their logarithm, a few
hundred rows for any corpus; texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stresscast.llm.common import docs_with, staged

#: Fixed values of the result contract: kinds in order, their patterns, and the least length of a match.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
LEAST_VALUE = 8
#: Candidates for the battery: whole runs of token characters. '=' belongs to one only as padding at its end.
LEAST_RUN = 20
CANDIDATE = r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{20,}(?:=+(?![A-Za-z0-9+/_=-]))?|[A-Za-z0-9+/_-]{2,19}=+(?![A-Za-z0-9+/_=-]))"
#: Parts of a run of mixed alphabets that fit base64 and base64url.
PARTS = (r"[A-Za-z0-9+/]{20,}=*|[A-Za-z0-9+/]{2,19}=+", r"[A-Za-z0-9_-]{20,}=*|[A-Za-z0-9_-]{2,19}=+")
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Encodings in the order they are tried: name, characters a token must be made of, alphabet in code order.
ENCODINGS = (
    ("decimal", r"[0-9]+", DIGITS),
    ("hex", r"[0-9a-f]+", DIGITS + "abcdef"),
    ("hex_upper", r"[0-9A-F]+", DIGITS + "ABCDEF"),
    ("lower", r"[a-z]+", LOWER),
    ("upper", r"[A-Z]+", UPPER),
    ("base32", r"[A-Z2-7]+", UPPER + "234567"),
    ("base36", r"[a-z0-9]+", DIGITS + LOWER),
    ("base36_upper", r"[A-Z0-9]+", DIGITS + UPPER),
    ("letters", r"[A-Za-z]+", UPPER + LOWER),
    ("base62", r"[A-Za-z0-9]+", DIGITS + UPPER + LOWER),
    ("base64url", r"[A-Za-z0-9_-]+", UPPER + LOWER + DIGITS + "-_"),
    ("base64", r"[A-Za-z0-9+/]+", UPPER + LOWER + DIGITS + "+/"),
)
#: Chance that two letters of a text are equal, for languages in Latin script.
COINCIDENCE = 0.065
#: Bins of -log10 p for the false-discovery counts.
BIN, LAST_BIN = 0.1, 400


def _spans(text: Column, pattern: str) -> Column:
    """Array of (start, end, match) of the leftmost non-overlapping matches, in code points, end exclusive."""
    found = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    none = F.array().cast("array<struct<start:int,end:int,m:string>>")

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["m"])
        one = F.array(F.struct(start.alias("start"), end.alias("end"), x["m"].alias("m")))
        return F.struct(end.alias("at"), F.concat(acc["out"], one).alias("out"))

    walked = F.aggregate(F.filter(found, lambda x: x["m"].isNotNull()),
                         F.struct(F.lit(0).alias("at"), none.alias("out")), add, lambda acc: acc["out"])
    return F.when(text.rlike(pattern), walked).otherwise(none)


def _candidates(text: Column) -> Column:
    """Spans of the runs to test; a run of mixed alphabets gives its parts, which may overlap."""
    def long(spans: Column) -> Column:
        return F.filter(spans, lambda s: F.length(s["m"]) >= LEAST_RUN)

    def parts(run: Column, pattern: str) -> Column:
        return F.transform(long(_spans(run["m"], pattern)), lambda p: F.struct(
            (run["start"] + p["start"]).alias("start"), (run["start"] + p["end"]).alias("end"), p["m"].alias("m")))

    def fitting(run: Column) -> Column:
        mixed = run["m"].rlike("[+/]") & run["m"].rlike("[_-]")
        return F.when(mixed, F.array_distinct(F.concat(*[parts(run, p) for p in PARTS]))).otherwise(F.array(run))

    return F.flatten(F.transform(long(_spans(text, CANDIDATE)), fitting))


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the normal distribution; a continued fraction keeps its relative accuracy far out."""
    x = F.abs(z)
    density = F.exp(-x * x / 2) * F.lit(0.3989422804014327)
    t = 1 / (1 + x * F.lit(0.2316419))
    near = density * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    far = density / (x + 1 / (x + 2 / (x + 3 / (x + 4 / (x + 5 / (x + 6 / (x + 0.65)))))))
    tail = F.when(x < 2, near).otherwise(far)
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _tested(spans: Column) -> Column:
    """The battery on each candidate: (start, end, n, encoding, p_random, p_text)."""
    def first_fitting(m: Column) -> Column:
        number = F
        for i, (_, pattern, _letters) in enumerate(ENCODINGS):
            number = number.when(m.rlike(f"^{pattern}=*$"), F.lit(i))
        return number

    # every step is a struct of its own: a column used twice in one expression is planned (and computed) twice
    numbered = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.regexp_replace(s["m"], "=+$", "").alias("body"),
        first_fitting(s["m"]).alias("number")))
    names, alphabets = (F.array(*[F.lit(e[j]) for e in ENCODINGS]) for j in (0, 2))
    named = F.transform(numbered, lambda s: F.struct(
        *[s[c].alias(c) for c in ("start", "end", "body")], F.get(names, s["number"]).alias("encoding"),
        F.get(alphabets, s["number"]).alias("letters")))
    known = F.filter(named, lambda s: s["encoding"].isNotNull() & (s["encoding"] != "decimal"))
    coded = F.transform(known, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["encoding"].alias("encoding"),
        F.length(s["letters"]).cast("double").alias("a"), F.length(s["body"]).cast("double").alias("n"),
        F.aggregate(F.regexp_extract_all(s["letters"], F.lit("(?s)."), F.lit(0)), F.lit(0.0), lambda acc, c: acc + F.pow(
            (F.length(s["body"]) - F.length(F.replace(s["body"], c, F.lit("")))).cast("double"), F.lit(2.0))).alias("squares"),
        F.transform(F.regexp_extract_all(s["body"], F.lit("(?s)."), F.lit(0)),
                    lambda c: F.position(c, s["letters"]).cast("double") - 1).alias("x")))
    with_mean = F.transform(coded, lambda s: F.struct(
        *[s[c].alias(c) for c in ("start", "end", "encoding", "a", "n", "x")],
        (s["squares"] * s["a"] / s["n"] - s["n"]).alias("chi"),
        (F.aggregate(s["x"], F.lit(0.0), lambda acc, v: acc + v) / s["n"]).alias("mean"),
        F.size(F.filter(s["x"], lambda v: 2 * v >= s["a"])).cast("double").alias("high"),
        (F.size(F.filter(s["x"], lambda v, i: (i > 0) & ((2 * v >= s["a"]) != (2 * F.get(s["x"], i - 1) >= s["a"])))) + 1)
        .cast("double").alias("runs")))
    moments = F.transform(with_mean, lambda s: F.struct(
        *[s[c].alias(c) for c in ("start", "end", "encoding", "a", "n", "chi", "high", "runs")],
        F.aggregate(s["x"], F.lit(0.0), lambda acc, v: acc + (v - s["mean"]) * (v - s["mean"])).alias("spread"),
        F.aggregate(F.transform(s["x"], lambda v, i: F.when(i > 0, (v - s["mean"]) * (F.get(s["x"], i - 1) - s["mean"]))
                                .otherwise(F.lit(0.0))), F.lit(0.0), lambda acc, v: acc + v).alias("lagged")))

    def scores(s: Column) -> Column:
        """Normal scores of the tests; NULL where a test cannot be passed."""
        n, df = s["n"], s["a"] - 1
        uniform = (F.pow(s["chi"] / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        expected = 2 * s["high"] * (n - s["high"]) / n + 1
        deviation = F.sqrt(F.greatest((expected - 1) * (expected - 2) / (n - 1), F.lit(1e-9)))
        runs = F.when((s["high"] != 0) & (s["high"] != n), F.abs(s["runs"] - expected) / deviation)
        serial = F.when(s["spread"] > 0, F.abs(s["lagged"] / F.greatest(s["spread"], F.lit(1e-9)) + 1 / n) * F.sqrt(n))
        # Text has no digits: among the six letters of hex two are equal at least every sixth time.
        equal = F.when(s["encoding"].isin("hex", "hex_upper"), F.lit(1 / 6)).otherwise(F.lit(COINCIDENCE))
        excess = n * (s["a"] * equal - 1)
        as_text = -(s["chi"] - df - excess) / F.sqrt(2 * (df + 2 * excess))
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), n.cast("int").alias("n"), s["encoding"].alias("encoding"),
                        F.transform(F.array(uniform, runs, serial, as_text), _upper_tail).alias("p"))

    def fisher(s: Column) -> Column:
        half = F.lit(0.0)
        for p in (s["p"][0], F.coalesce(2 * s["p"][1], F.lit(0.0)), F.coalesce(2 * s["p"][2], F.lit(0.0))):
            half = half - F.log(F.greatest(p, F.lit(1e-300)))
        return F.struct(*[s[c].alias(c) for c in ("start", "end", "n", "encoding")], half.alias("half"), s["p"][3].alias("p_text"))

    return F.transform(F.transform(F.transform(moments, scores), fisher), lambda s: F.struct(
        *[s[c].alias(c) for c in ("start", "end", "n", "encoding")],
        (F.exp(-s["half"]) * (1 + s["half"] + s["half"] * s["half"] / 2)).alias("p_random"), s["p_text"].alias("p_text")))


def _base(text: Column) -> Column:
    """Spans of the three known shapes as (start, kind number, end)."""
    def of(kind: int, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))

    value = F.regexp_extract
    assign = F.filter(_spans(text, ASSIGN), lambda s: F.length(value(s["m"], ASSIGN, 2)) >= LEAST_VALUE)
    return F.array_sort(F.concat(of(0, assign), of(1, _spans(text, ACCESS)), of(2, _spans(text, HEX))))


def _length_class(n: Column) -> Column:
    """Lengths within a factor of the square root of two form a class."""
    return F.floor(2 * F.log2(n.cast("double"))).cast("int")


def thresholds(tested: DataFrame, rate: float) -> dict[int, float]:
    """Largest p_text that is a discovery, per length class, for a column ``tests`` of candidates."""
    c = tested.select(F.explode("tests").alias("c")).select(
        _length_class(F.col("c.n")).alias("k"),
        F.least(F.lit(LAST_BIN), F.floor(-F.log10(F.greatest(F.col("c.p_text"), F.lit(1e-300))) / BIN)).cast("int").alias("bin"))
    counts: dict[int, dict[int, int]] = {}
    for k, b, n in c.groupBy("k", "bin").count().collect():
        counts.setdefault(k, {})[b] = n
    out = {}
    for k, bins in counts.items():
        total, below, best = sum(bins.values()), 0, 0.0
        for b in sorted(bins, reverse=True):
            below += bins[b]
            upper = 10 ** (-b * BIN)  # a bin counts at its largest p
            if upper <= rate * below / total:
                best = upper
        out[k] = best
    return out


def _found(limits: dict[int, float], least_random: float) -> Column:
    """Spans of all kinds by start, from the columns ``base`` and ``tests``."""
    table = F.create_map(*[F.lit(v) for kp in limits.items() for v in kp]) if limits else None

    def at(n: Column) -> Column:
        return F.lit(0.0) if table is None else F.coalesce(F.try_element_at(table, _length_class(n)), F.lit(0.0))

    new = F.filter("tests", lambda c: (c["p_random"] >= least_random) & (c["p_text"] <= at(c["n"]))
                   & ~F.exists("base", lambda b: (b["start"] <= c["start"]) & (b["end"] >= c["end"])))
    return F.array_sort(F.concat("base", F.transform(new, lambda c: F.struct(
        c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end")))))


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = 0.01,
         least_random: float = 0.01) -> DataFrame:
    """``(doc_id, base, tests, spans)`` per document row: known shapes, tested candidates, and all secrets.

    Spans are (start, kind number, end) in code points, by start. A candidate inside a known span adds none. A
    null text is an empty one and has no spans. Empty table: no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = staged(docs_with(docs, id_col, text_col).select(
        F.col(id_col).cast("long").alias("doc_id"), _base(text).alias("base"), _tested(_candidates(text)).alias("tests")), "scan")
    return found.withColumn("spans", _found(thresholds(found, rate), least_random))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[secret]", rate: float = 0.01,
           least_random: float = 0.01) -> DataFrame:
    """The documents with every secret replaced by ``mark``; other columns stay as they are, null texts too."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    tests = _tested(_candidates(text))
    limits = thresholds(docs.select(tests.alias("tests")), rate)
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    marked = docs.select(row, _base(text).alias("base"), tests.alias("tests"), text.alias("text"))
    spans = marked.select("row", "text", _found(limits, least_random).alias("spans"))
    walked = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), lambda acc, s: F.when(
        s["end"] <= acc["at"], acc).otherwise(F.struct(
            s["end"].alias("at"), F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(
                acc["out"], F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).alias("out"))),
        lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    new = F.when(F.size("spans") > 0, walked).otherwise(F.col("row")[text_col])
    return spans.select(*[new.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
