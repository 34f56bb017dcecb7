"""SimHash near-duplicates by deletion-variant signatures.

With at most four differing bits, one of three segments of the 64-bit fingerprint (22, 21 and 21
bits) differs in at most one bit. Every distinct fingerprint is therefore indexed under its three
segments as they are and under each segment with one bit blanked: 67 keys. Linked fingerprints
share a key; an equality join on the keys finds them and the bit distance verifies them.

Scale: equal fingerprints are merged first, so copies cost one fingerprint. Keys are dealt out by
*range* on (key, fingerprint), so a hot key spreads over as many tasks as it fills. Inside a task
short key runs are compared pair by pair; a long run, or one that may go on in the next task, is
linked block by block by a spanning forest (at most one link a fingerprint, never all pairs), and
blocks of one key are joined with each other by key in a second pass. No link between different
fingerprints is lost: every pair that shares a key is compared, and pairs left out are already
joined within their key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stresscast.llm.common import docs_with, staged
from stresscast.llm.components import connected_components

SEGMENTS = ((0, 22), (22, 21), (43, 21))
MASKS = [((1 << n) - 1) << s for s, n in SEGMENTS]
#: Runs of one key up to this length are compared pair by pair.
SHORT_RUN = 32
#: Longest block of one key that is held and compared at once.
BLOCK = 4096


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def simhash64(text: bytes | None, shingle: int) -> int:
    """Fingerprint of a UTF-8 text: bits set in over half the XXH64 values (seed 42) of its word shingles."""
    import xxhash
    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(line, 42)], dtype="<u8")
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-1]))[: len(words) - shingle + 1].tolist()
        stops = (ends[shingle - 1:] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(line[s:e], 42) for s, e in zip(starts, stops)), "<u8", len(starts))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """``(doc_id, fp)`` with the fingerprint as a signed long, one row per document row.

    Words are ASCII-lower-cased runs of anything but ASCII white space. Null, empty and blank texts
    have fingerprint zero; a text of fewer words than a shingle is one shingle.
    """
    rows = docs_with(docs, id_col, text_col).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((simhash64(x.as_py(), shingle) for x in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return rows.mapInArrow(run, "doc_id long, fp long")


def _indexed(fps: DataFrame) -> DataFrame:
    """Each fingerprint under its 64 one-bit-blanked segment keys and its three whole segments."""
    masks = [m & ~(1 << bit) for m, (s, n) in zip(MASKS, SEGMENTS) for bit in range(s, s + n)] + MASKS
    table = F.array(*[F.lit(_signed(m)).cast("long") for m in masks])
    return (fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(len(masks) - 1))).alias("v"))
            .select("v", F.col("fp").bitwiseAND(F.element_at(table, F.col("v") + 1)).alias("m"), "fp"))


def _linked(v: np.ndarray, x: np.ndarray, max_bits: int) -> np.ndarray:
    """For pairs that share key ``v`` and differ by ``x``: linked, and found under no earlier key.

    A blanked bit must differ (pairs equal in the segment meet under the whole segment), and no
    earlier segment may differ in one bit at most.
    """
    v = np.broadcast_to(v, x.shape)
    blank = v < 64
    bit = (x >> np.where(blank, v, 0).astype(np.uint64)) & np.uint64(1)
    ok = (np.bitwise_count(x) <= max_bits) & (~blank | (bit == 1))
    segment = np.where(blank, (v >= 22).astype(np.int8) + (v >= 43), v - 64)
    for s in (0, 1):
        ok &= (segment <= s) | (np.bitwise_count(x & np.uint64(MASKS[s])) > 1)
    return ok


def _forest(v: int, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Spanning forest of one block: component number of each fingerprint, and its links."""
    comp = np.full(len(fps), -1)
    links: list[tuple[int, int]] = []
    left = np.arange(len(fps))
    c = 0
    while len(left):
        todo, left = [left[0]], left[1:]
        comp[todo[0]] = c
        while todo and len(left):
            at = todo.pop()
            near = _linked(np.int64(v), fps[left] ^ fps[at], max_bits)
            found = left[near]
            if len(found):
                comp[found] = c
                links += [(int(fps[at]), int(f)) for f in fps[found]]
                todo += found.tolist()
                left = left[~near]
        c += 1
    return comp, links


def _across(v: int, a: np.ndarray, b: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that join the forests of two blocks of one key."""
    ca, cb = _forest(v, a, max_bits)[0], _forest(v, b, max_bits)[0]
    group = np.concatenate((np.arange(ca.max() + 1), np.arange(cb.max() + 1) + ca.max() + 1))
    own = group[cb + ca.max() + 1]
    links: list[tuple[int, int]] = []
    for i in range(len(a)):
        while True:
            other = own != group[ca[i]]
            if not other.any():
                break
            near = np.flatnonzero(other)[_linked(np.int64(v), b[other] ^ a[i], max_bits)]
            if not len(near):
                break
            links.append((int(a[i]), int(b[near[0]])))
            group[group == own[near[0]]] = group[ca[i]]
            own = group[cb + ca.max() + 1]
    return links


_SCHEMA = "kind int, v int, m long, part long, a long, b long, block binary"


def _out(kind: int, v, m, part, a, b, block) -> pa.RecordBatch:
    as_long = lambda x: pa.array(np.asarray(x, np.uint64).view(np.int64))
    n = len(a)
    return pa.RecordBatch.from_arrays(
        [pa.array([kind] * n, pa.int32()), pa.array(v, pa.int32()), pa.array(m, pa.int64()), pa.array(part, pa.int64()),
         as_long(a), as_long(b), pa.array(block, pa.binary())], ["kind", "v", "m", "part", "a", "b", "block"])


def _pairs_out(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    n = len(pairs)
    return _out(0, [0] * n, [0] * n, [0] * n, [p[0] for p in pairs], [p[1] for p in pairs], [None] * n)


def _compare(max_bits: int, short_run: int, block: int):
    """Compare within key runs of sorted rows (v, m, fp); give links (kind 0) and blocks to join (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # the last, maybe unfinished run
        long_run, first = False, True

        def blocks(v, m, fps) -> Iterator[pa.RecordBatch]:
            nonlocal seq
            for at in range(0, len(fps), block):
                piece = fps[at:at + block]
                links = _forest(v, piece, max_bits)[1]
                if links:
                    yield _pairs_out(links)
                yield _out(1, [v], [m], [(part << 32) + seq], [0], [0], [piece.tobytes()])
                seq += 1

        def short(v, m, x) -> Iterator[pa.RecordBatch]:
            """All pairs of runs of up to short_run rows, shift by shift."""
            at = np.arange(len(x))
            for d in range(1, short_run):
                at = at[at + d < len(x)]
                at = at[(v[at] == v[at + d]) & (m[at] == m[at + d])]
                if not len(at):
                    return
                ok = at[_linked(v[at], x[at] ^ x[at + d], max_bits)]
                if len(ok):
                    n = len(ok)
                    yield _out(0, [0] * n, [0] * n, [0] * n, x[ok], x[ok + d], [None] * n)

        for b in batches:
            if not b.num_rows:
                continue
            v, m = b.column(0).to_numpy(), b.column(1).to_numpy()
            x = b.column(2).to_numpy().view(np.uint64)
            if held:
                hv, hm, hx = held.pop()
                v, m, x = np.concatenate((hv, v)), np.concatenate((hm, m)), np.concatenate((hx, x))
            cut = np.flatnonzero((v[1:] != v[:-1]) | (m[1:] != m[:-1])) + 1
            starts = np.concatenate(([0], cut))
            last = starts[-1]
            if first and len(starts) > 1:
                # The first run of a partition may go on from the one before.
                yield from blocks(int(v[0]), int(m[0]), x[:starts[1]])
                first = False
                starts = starts[1:]
            elif long_run and len(starts) > 1:
                yield from blocks(int(v[0]), int(m[0]), x[:starts[1]])
                long_run = False
                starts = starts[1:]
            if len(starts) > 1:
                size = np.diff(starts)
                for s, n in zip(starts[:-1][size > short_run], size[size > short_run]):
                    if n > block:
                        yield from blocks(int(v[s]), int(m[s]), x[s:s + n])
                    elif links := _forest(int(v[s]), x[s:s + n], max_bits)[1]:
                        yield _pairs_out(links)
                keep = np.repeat((size > 1) & (size <= short_run), size)
                at = starts[0] + np.flatnonzero(keep)
                if len(at):
                    yield from short(v[at], m[at], x[at])
            if len(x) - last >= block:  # never hold more than a block of one key
                whole = (len(x) - last) // block * block
                yield from blocks(int(v[last]), int(m[last]), x[last:last + whole])
                last, long_run = last + whole, True
                first = False
            if last < len(x):
                held.append((v[last:].copy(), m[last:].copy(), x[last:].copy()))
        if held:
            hv, hm, hx = held.pop()
            yield from blocks(int(hv[0]), int(hm[0]), hx)

    return run


def similar_links(fps: DataFrame, max_bits: int = 4, short_run: int = SHORT_RUN, block: int = BLOCK) -> DataFrame:
    """Distinct fingerprints ``(fp)`` to links ``(a, b)`` that join all pairs within ``max_bits`` (4 at most).

    Every two fingerprints within the distance are linked directly or by a path of links that each
    keep the distance.
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("three segments with one free bit each cover at most four differing bits")
    spark = fps.sparkSession
    keys = _indexed(fps)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    found = (keys.repartitionByRange(n, "v", "m", "fp").sortWithinPartitions("v", "m", "fp")
             .mapInArrow(_compare(max_bits, short_run, block), _SCHEMA))
    found = staged(found, "simhash")
    links = found.where("kind = 0").select("a", "b")
    blocks = found.where("kind = 1").select("v", "m", "part", "block")
    left = blocks.select("v", "m", F.col("part").alias("p1"), F.col("block").alias("b1"))
    right = blocks.select("v", "m", F.col("part").alias("p2"), F.col("block").alias("b2"))
    met = left.join(right, ["v", "m"]).where("p1 < p2").select("v", "b1", "b2")

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = []
            for v, x, y in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                pairs += _across(v, np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), max_bits)
            a, c = (np.array([p[i] for p in pairs], np.uint64).view(np.int64) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(c)], ["a", "b"])

    return links.unionByName(met.mapInArrow(across, "a long, b long")).distinct()


def fingerprint_groups(fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """``(fp, root, component_id)`` of each distinct fingerprint of ``(doc_id, fp)``.

    ``root`` names the component by a fingerprint, ``component_id`` is the smallest ``doc_id`` in it (null if all are).
    """
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = connected_components(similar_links(least.select("fp"), max_bits))
    rooted = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.select("fp", "root").join(named, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``(doc_id, fp, component_id)`` per document row; documents whose fingerprints link share a component.

    ``component_id`` is the smallest ``doc_id`` reachable over links, the document itself included.
    Repeated rows each get their row; a null ``doc_id`` is no candidate for the smallest id, and its
    component is null if no other document is in it. Empty table: no rows.
    """
    own = staged(fingerprints(docs, shingle=shingle), "fingerprints")
    return own.join(fingerprint_groups(own, max_bits), "fp").select("doc_id", "fp", "component_id")


def one_of_each_group(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The document of the smallest id of each group of near-duplicates, all columns as they are.

    Of several rows with that id (a repeated row, another version) one stays, by the hash of its text.
    """
    own = staged(fingerprints(docs, shingle=shingle), "fingerprints")
    groups = fingerprint_groups(own, max_bits).withColumnRenamed("fp", "group_fp")

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([_signed(simhash64(t, shingle)) for t in texts], dtype="int64")

    # Else the optimizer evaluates it twice, once for a filter on non-null join keys.
    fp = fp.asNondeterministic()
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    marked = docs.select(row, fp(docs["text"].cast("binary")).alias("fp"))
    first = marked.join(groups, (F.col("fp") == F.col("group_fp")) & F.col("row.doc_id").eqNullSafe(F.col("component_id")))
    rank = F.row_number().over(Window.partitionBy("root").orderBy(F.sha2(F.col("row.text").cast("binary"), 256)))
    return first.withColumn("rank", rank).where("rank = 1").select("row.*")
