"""Exact removal of repeated byte strings by a distributed merge sort of suffixes.

A byte goes if a string of ``length`` (200) bytes covers it that also starts anywhere else in the corpus.

1. **Anchors.** Sorting every suffix of a corpus moves it many times over. A set of suffixes that is chosen
   by content alone is enough: in every window of 200 bytes the 50-byte piece of least hash is its anchor, so
   equal windows have their anchors at the same offset. About one suffix in 75 is an anchor.
2. **Candidates.** Pieces are counted by hash; anchors whose piece occurs once cannot lie in a repeated window.
3. **Runs.** Each task sorts the suffixes at its anchors (200 bytes, and the 150 bytes before them as payload) and
   sends them on as *front-coded runs*: every suffix as the length shared with the one before it and the rest.
4. **Merge.** A task merges the runs of its partition by a *loser tree* that keeps, for every run, the length its
   head shares with the last output: heads with different lengths are ordered without a comparison, equal
   ones are compared from that length on. The output comes with its common prefixes.
5. **Repeats.** With r bytes shared to the right of an anchor and l to the left, windows at offsets 200 - r to l before
   it are repeated. A group of suffixes with one 50-byte prefix is resolved by their common prefixes on both
   sides for every offset at once. The windows of one anchor cover one interval.

Scale: copies of a whole text are found by digest first and enter once. Equal contexts are merged before they
are sent. A piece that is shared by more than ``max_group`` different contexts is sent under longer pieces instead
(each window contains one of them), level by level down to the window itself, where a count is enough; so no task
holds an unbounded group, and no case is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stresscast.llm.common import docs_with, staged

LENGTH = 200
PIECE = 50
#: Different contexts of one piece that a task may resolve together.
MAX_GROUP = 50_000
#: Bytes that are hashed at once; longer texts are hashed in overlapping pieces of this size.
BUFFER = 1 << 20
#: Rows of a run, and rows that a merging task is meant to get.
RUN_ROWS = 50_000
MERGE_ROWS = 20_000
_BASE = 0x9E3779B97F4A7C15
_PLACE = np.uint64((1 << 24) - 1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64."""
    base, inverse = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
    return tuple(np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n, b)))) for b in (base, inverse))


def anchors_of(texts: list[bytes], powers, length: int = LENGTH, piece: int = PIECE):
    """Text number, place and piece hash of the anchors of every window of some texts of ``length`` bytes or more."""
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(texts), np.uint8)
    up, down = powers
    total = np.concatenate(([np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)])))
    h = (total[piece:] - total[:-piece]) * down[:len(data) - piece + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    # Least hash of each window, leftmost first: the place rides in the low bits.
    key = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    span, wide = length - piece + 1, 1
    while 2 * wide <= span:
        key = np.minimum(key[:-wide], key[wide:])
        wide *= 2
    if span > wide:
        key = np.minimum(key[:wide - span], key[span - wide:])
    inside = np.ones(len(key), bool)
    for e in ends[:-1].tolist():
        inside[max(0, e - length + 1):e] = False
    key = key[inside]
    key = key[np.concatenate(([True], key[1:] != key[:-1]))]
    at = np.unique((key & _PLACE).astype(np.int64))
    doc = np.searchsorted(ends, at, "right")
    return doc, at - (ends - sizes)[doc], h[at]


def _lcp(a: bytes, b: bytes, known: int) -> int:
    """Common prefix of two strings that are equal up to ``known``."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    step = 16
    while a[known:known + step] == b[known:known + step]:
        known += step
    while a[known] == b[known]:
        known += 1
    return known


def front_coded(rows: list[tuple[bytes, bytes, bytes, int]]) -> bytes:
    """A sorted run of (suffix, bytes before it, context id, copies): lengths shared with the row before, and rests."""
    parts, last = [], b""
    for suffix, before, ctx, copies in rows:
        shared = _lcp(last, suffix, 0)
        parts.append(b"".join((shared.to_bytes(2, "little"), (len(suffix) - shared).to_bytes(2, "little"),
                               len(before).to_bytes(2, "little"), copies.to_bytes(8, "little"), ctx,
                               suffix[shared:], before)))
        last = suffix
    return b"".join(parts)


def read_run(run: bytes) -> Iterator[tuple[int, bytes, bytes, bytes, int]]:
    """(length shared with the row before, suffix, bytes before it, context id, copies) of a front-coded run."""
    at, last = 0, b""
    while at < len(run):
        shared, rest, n = (int.from_bytes(run[at + i:at + i + 2], "little") for i in (0, 2, 4))
        copies, ctx = int.from_bytes(run[at + 6:at + 14], "little"), run[at + 14:at + 30]
        at += 30
        last = last[:shared] + run[at:at + rest]
        yield shared, last, run[at + rest:at + rest + n], ctx, copies
        at += rest + n


def merged(runs: list[bytes]) -> Iterator[tuple[int, bytes, bytes, bytes, int]]:
    """Merge sorted runs by a loser tree over common prefixes; rows come with the length shared with the row before.

    A head's length is what it shares with the last output. Of two heads the longer one is the smaller; only
    equal lengths need a comparison, from that length on, which gives the loser's length against the winner.
    """
    k = 1
    while k < len(runs):
        k *= 2
    streams = [read_run(r) for r in runs] + [iter(())] * (k - len(runs))
    heads: list = [next(s, None) for s in streams]
    lengths = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two runs; sets the loser's length."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if lengths[a] != lengths[b]:
            return (a, b) if lengths[a] > lengths[b] else (b, a)
        s, t = x[1], y[1]
        n = _lcp(s, t, lengths[a])
        if n == len(s) or n < len(t) and s[n] < t[n]:
            lengths[b] = n
            return a, b
        lengths[a] = n
        return b, a

    losers = [0] * k
    level = list(range(k))
    node = k
    while len(level) > 1:
        node //= 2
        up = []
        for i in range(0, len(level), 2):
            w, losers[node + i // 2] = play(level[i], level[i + 1])
            up.append(w)
        level = up
    win = level[0]
    while heads[win] is not None:
        yield lengths[win], *heads[win][1:]
        head = heads[win] = next(streams[win], None)
        lengths[win] = head[0] if head else 0
        node = (win + k) // 2
        while node:
            win, losers[node] = play(win, losers[node])
            node //= 2


def repeated_offsets(shared: np.ndarray, sizes: np.ndarray, before: list[bytes], copies: np.ndarray,
                     length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest offset of a repeated window at each of some sorted suffixes; -1: none.

    ``shared`` is the length shared with the suffix before in order, ``sizes`` are the suffixes' lengths. The window
    at offset o takes the last o bytes of ``before`` and length - o bytes of the suffix; it is repeated if
    another row has the same, or if the row stands for several ``copies``.
    """
    n = len(before)
    least, most = np.full(n, -1), np.full(n, -1)
    if not n:
        return least, most
    back = [b[::-1] for b in before]
    order = np.array(sorted(range(n), key=back.__getitem__))
    shared_back = np.array([0] + [_lcp(back[i], back[j], 0) for i, j in zip(order, order[1:])])
    sizes_back = np.array([len(b) for b in back])
    alone = copies < 2
    for o in range(int(sizes_back.max()) + 1):
        fits = np.flatnonzero((sizes_back >= o) & (sizes >= length - o))
        if not len(fits):
            continue
        right = np.cumsum(shared < length - o)
        left = np.empty(n, np.int64)
        left[order] = np.cumsum(shared_back < o)
        key = (right * (n + 1) + left)[fits]
        rank = np.argsort(key, kind="stable")
        same = key[rank][1:] == key[rank][:-1]
        again = np.zeros(len(fits), bool)
        again[rank[1:]] |= same
        again[rank[:-1]] |= same
        hit = fits[again | ~alone[fits]]
        least[hit] = np.where(least[hit] < 0, o, least[hit])
        most[hit] = o
    return least, most


def _text_key(text):
    """Two longs that identify a text: half of its SHA-256."""
    digest = F.sha2(text, 256)
    return [F.conv(F.substring(digest, 1 + 16 * i, 16), 16, -10).cast("long").alias(f"k{i + 1}") for i in (0, 1)]


def _anchor_rows(texts: DataFrame, length: int, piece: int) -> DataFrame:
    """``(k1, k2, at, hash)`` arrays of the anchors of each text row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _powers(2 * BUFFER + length)
        for b in batches:
            at: list[list[np.ndarray]] = [[] for _ in range(b.num_rows)]
            hashes: list[list[np.ndarray]] = [[] for _ in range(b.num_rows)]
            held: list[tuple[int, int, bytes]] = []

            def flush() -> None:
                doc, place, h = anchors_of([x[2] for x in held], powers, length, piece)
                cut = np.searchsorted(doc, np.arange(len(held) + 1))
                for i, (row, base, _) in enumerate(held):
                    at[row].append(place[cut[i]:cut[i + 1]] + base)
                    hashes[row].append(h[cut[i]:cut[i + 1]])
                held.clear()

            size = 0
            for row, text in enumerate(b.column(2)):
                text = text.as_py()
                for base in range(0, max(len(text) - length + 1, 0), BUFFER):
                    part = text[base:base + BUFFER + length - 1]
                    if size + len(part) > 2 * BUFFER:
                        flush()
                        size = 0
                    held.append((row, base, part))
                    size += len(part)
            if held:
                flush()
            places, values = [], []
            for a, h in zip(at, hashes):
                a, h = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, h))
                a, first = np.unique(a, return_index=True)
                places.append(a)
                values.append(h[first].astype(np.uint64).view(np.int64))
            offsets = pa.array(np.concatenate(([0], np.cumsum([len(a) for a in places]))).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x).astype(np.int64)))
                                             for x in (places, values))], ["k1", "k2", "at", "hash"])

    return texts.mapInArrow(run, "k1 long, k2 long, at array<long>, hash array<long>")


_CONTEXT = "k1 long, k2 long, at long, ctx binary, suffix binary, before binary"


def _context_id(suffix: bytes, before: bytes, low: int) -> bytes:
    """Identity of a context among those that start ``low`` bytes before their anchors."""
    head = low.to_bytes(2, "little") + len(before).to_bytes(2, "little")
    return hashlib.sha256(head + before + suffix).digest()[:16]


def _contexts(texts: DataFrame, length: int, piece: int) -> DataFrame:
    """The bytes around each place of ``(k1, k2, t, places)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k1, k2, t, places in zip(*(b.column(i) for i in range(4))):
                k1, k2, t = k1.as_py(), k2.as_py(), t.as_py()
                places = np.asarray(places.values)
                for lo in range(0, len(places), 4096):
                    at = places[lo:lo + 4096].tolist()
                    suffix = [t[a:a + length] for a in at]
                    before = [t[max(0, a - length + piece):a] for a in at]
                    ctx = [_context_id(*x, 0) for x in zip(suffix, before)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k1] * len(at), pa.int64()), pa.array([k2] * len(at), pa.int64()), pa.array(at, pa.int64()),
                         *(pa.array(x, pa.binary()) for x in (ctx, suffix, before))],
                        ["k1", "k2", "at", "ctx", "suffix", "before"])

    return texts.mapInArrow(run, _CONTEXT)


def _resolved(contexts: DataFrame, parts: int, length: int) -> DataFrame:
    """``(ctx, least, most)`` of contexts ``(ctx, low, suffix, before, copies, core)`` with a repeated window.

    Only contexts of the same ``low`` meet: one place may be met under two of them, and is no repeat of itself.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, bytes, bytes, int, int]] = []

        def flush() -> pa.RecordBatch:
            by_part: dict[int, list] = {}
            for *row, part in sorted(held):
                by_part.setdefault(part, []).append(row)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(by_part), pa.int64()), pa.array(
                [front_coded(r) for r in by_part.values()], pa.binary())], ["part", "run"])

        for b in batches:
            held += zip(*(b.column(i).to_pylist() for i in range(5)))
            if len(held) >= RUN_ROWS:
                yield flush()
        if held:
            yield flush()

    def merge(table: pa.Table) -> pa.Table:
        rows = list(merged(table.column("run").to_pylist()))
        ctx = [r[3] for r in rows]
        least, most = repeated_offsets(
            np.array([r[0] for r in rows]), np.array([len(r[1]) for r in rows]), [r[2] for r in rows],
            np.array([r[4] for r in rows]), length)
        found = np.flatnonzero(most >= 0)
        return pa.table({"ctx": pa.array([ctx[i] for i in found], pa.binary()), "least": pa.array(least[found], pa.int64()),
                         "most": pa.array(most[found], pa.int64())})

    return (contexts.select("suffix", "before", "ctx", "copies", (F.pmod("core", F.lit(parts)) * 1000 + F.col("low")).alias("part"))
            .mapInArrow(runs, "part long, run binary").groupBy("part").applyInArrow(merge, "ctx binary, least long, most long"))


def _halves(groups: DataFrame, length: int) -> DataFrame:
    """Contexts under the two longer pieces that cover the windows of a context between them.

    The first starts where it did, for the nearer half of the offsets; the second starts as far before as the
    further half begins.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for ctx, low, span, suffix, before, copies in zip(*(x.to_pylist() for x in b.columns)):
                half = span // 2
                out.append((ctx, low, half, suffix, before[len(before) - min(half, len(before)):], copies))
                if len(before) > half:
                    cut = len(before) - half - 1
                    out.append((ctx, low + half + 1, span - half - 1, (before[cut:] + suffix)[:length], before[:cut], copies))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.binary()), pa.array([_context_id(r[3], r[4], r[1]) for r in out], pa.binary()),
                 *(pa.array([r[i] for r in out], t) for i, t in
                   ((1, pa.int64()), (2, pa.int64()), (3, pa.binary()), (4, pa.binary()), (5, pa.int64())))],
                ["parent", "ctx", "low", "span", "suffix", "before", "copies"])

    return groups.select("ctx", "low", "span", "suffix", "before", "copies").mapInArrow(
        run, "parent binary, ctx binary, low long, span long, suffix binary, before binary, copies long")


def _repeated_contexts(contexts: DataFrame, length: int, piece: int, max_group: int) -> DataFrame:
    """``(ctx, least, most)`` for contexts ``(ctx, suffix, before, copies)``, hot pieces replaced by longer ones."""
    level = contexts.withColumns({"low": F.lit(0).cast("long"), "span": F.lit(length - piece).cast("long")})
    links = None  # (ctx, root, low) of the level's contexts
    found = []
    while True:
        core = F.xxhash64("low", F.expr(f"substring(suffix, 1, cast({length} - span as int))"))
        level = level.withColumn("core", core)
        sizes = level.groupBy("core").agg(F.count("*").alias("n"), F.sum("copies").alias("places")).where("places > 1")
        level = staged(level.join(sizes, "core"), "contexts")
        n, hot = level.agg(F.count("*"), F.sum(F.when((F.col("n") > max_group) & (F.col("span") > 0), 1).otherwise(0))).first()
        again = (F.col("n") > max_group) & (F.col("span") > 0)
        done = _resolved(level.where(~again), n // MERGE_ROWS + 1, length)
        if links is not None:
            done = done.join(links, "ctx").select(F.col("root").alias("ctx"), (F.col("least") + F.col("low")).alias("least"),
                                                  (F.col("most") + F.col("low")).alias("most"))
        found.append(done)
        if not hot:
            break
        halves = staged(_halves(level.where(again), length), "halves")
        down = halves.select("ctx", "parent", "low").distinct()
        if links is None:
            links = down.withColumnRenamed("parent", "root")
        else:
            above = links.select(F.col("ctx").alias("parent"), "root")
            links = staged(down.join(above, "parent").select("ctx", "root", "low"), "links")
        level = halves.groupBy("ctx").agg(*[F.first(c).alias(c) for c in ("suffix", "before", "low", "span")],
                                          F.sum("copies").alias("copies"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.groupBy("ctx").agg(F.min("least").alias("least"), F.max("most").alias("most"))


def _cut(length: int):
    """Remaining bytes and spans of texts ``(k1, k2, t, found)`` with found intervals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for k1, k2, t, found in zip(*(x.to_pylist() for x in b.columns)):
                spans: list[list[int]] = []
                for s, e in sorted((f["s"], f["e"]) for f in found):
                    if spans and s <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], e)
                    else:
                        spans.append([s, e])
                kept = hashlib.sha256()
                at = 0
                for s, e in [*spans, [len(t), len(t)]]:
                    kept.update(t[at:s])
                    at = e
                out.append((k1, k2, spans, kept.hexdigest()))
            k1, k2, spans, kept = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                 pa.array(kept, pa.string())], ["k1", "k2", "spans", "kept"])

    return run


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   piece: int = PIECE, max_group: int = MAX_GROUP) -> DataFrame:
    """``(doc_id, n_bytes, spans, kept_sha256)`` per document row; ``spans`` are the removed byte intervals.

    A null text is an empty one. Rows with equal texts (repeated rows too) are repeats of each other as far
    as the text has ``length`` bytes. Strings are judged on the input; matches never cross documents.
    """
    rows = docs_with(docs, id_col, text_col).select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("t"))
    own = staged(rows.select("doc_id", *_text_key(F.col("t")), F.length("t").cast("long").alias("n_bytes"),
                             F.sha2("t", 256).alias("whole")), "texts")
    texts = own.groupBy("k1", "k2").agg(F.count("*").alias("same"), F.min("doc_id").alias("doc_id"))

    long_rows = rows.where(F.length("t") >= length).select("doc_id", *_text_key(F.col("t")), "t")
    anchors = staged(_anchor_rows(long_rows.select("k1", "k2", "t"), length, piece), "anchors")
    each = anchors.select("k1", "k2", F.explode(F.arrays_zip("at", "hash")).alias("x")).select("k1", "k2", "x.at", "x.hash")
    place = F.xxhash64("k1", "k2", "at")
    # Written, so that the join below is one of two plain exchanges and a hot piece can be split.
    shared = staged(each.groupBy("hash").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b")
                    .select("hash"), "shared")
    places = (each.join(shared, "hash").groupBy("k1", "k2").agg(F.collect_set("at").alias("places"))
              .join(texts, ["k1", "k2"]))
    # One row of each text: that of its smallest id (a fully repeated row comes twice and is counted once below).
    mine = places.select("k1", "k2", F.coalesce("doc_id", F.lit(-1)).alias("first"), "places", "same")
    cand = staged(long_rows.withColumn("first", F.coalesce("doc_id", F.lit(-1))).join(mine, ["k1", "k2", "first"])
                  .select("k1", "k2", "t", "places", "same"), "candidates")

    around = _contexts(cand.select("k1", "k2", "t", "places"), length, piece)
    # The bytes are cut out of the candidates again rather than written: they are many times the texts.
    members = staged(around.select("k1", "k2", "at", "ctx").distinct(), "members")
    payload = around.groupBy("ctx").agg(F.first("suffix").alias("suffix"), F.first("before").alias("before"))
    contexts = payload.join(members.groupBy("ctx").agg(F.count("*").alias("copies")), "ctx")
    repeats = staged(_repeated_contexts(contexts, length, piece, max_group), "repeats")

    spans = (members.join(repeats, "ctx").groupBy("k1", "k2").agg(F.collect_list(F.struct(
        (F.col("at") - F.col("most")).alias("s"), (F.col("at") - F.col("least") + length).alias("e"))).alias("found")))
    cut = (cand.where("same = 1").select("k1", "k2", "t").join(spans, ["k1", "k2"]).select("k1", "k2", "t", "found")
           .mapInArrow(_cut(length), "k1 long, k2 long, spans array<array<long>>, kept string"))
    whole = F.array(F.array(F.lit(0).cast("long"), F.col("n_bytes")))
    full = (F.col("same") > 1) & (F.col("n_bytes") >= length)
    return (own.join(texts.select("k1", "k2", "same"), ["k1", "k2"]).join(cut, ["k1", "k2"], "left")
            .select("doc_id", "n_bytes",
                    F.when(full, whole).otherwise(F.coalesce("spans", F.array().cast("array<array<long>>"))).alias("spans"),
                    F.when(full, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", "whole")).alias("kept_sha256")))
