"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Every benchmark item gives windows of 13 consecutive words (a shorter item is one window). Windows of
one length form a machine: a shift table over blocks of two words says how many text words can be
skipped because no window ends there, blocks that do end a window lead to a bucket of candidate
windows, and each candidate is compared word by word.

The machines travel to the tasks in shards of bounded size (``shard_bytes`` of window text), so any
benchmark size works: each shard is one pass over the documents that adds to the hits of the passes before it.
Documents are never shuffled.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stresscast.llm.common import docs_with, small_batches, staged

#: Window text that one broadcast machine may hold.
SHARD_BYTES = 16 << 20

#: Bytes outside words become blanks, A-Z become a-z; bytes of non-ASCII characters stay.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def fold_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words: runs of digits, ASCII letters and non-ASCII characters."""
    return (text or b"").translate(_FOLD).split()


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = 13) -> DataFrame:
    """Distinct ``(item, window, m)``: ids as strings (null: empty string), windows as blank-joined words."""
    rows = docs_with(benchmark, id_col, text_col).select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, text in zip(b.column(0).to_pylist(), b.column(1)):
                words = fold_words(text.as_py())
                m = min(size, len(words))
                for lo in range(0, len(words) - m + 1 if m else 0, 4096):
                    wins = [b" ".join(words[i:i + m]) for i in range(lo, min(lo + 4096, len(words) - m + 1))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(wins)), pa.array(wins, pa.binary()), pa.array([m] * len(wins), pa.int32())],
                        ["item", "window", "m"])

    return rows.mapInArrow(run, "item string, window binary, m int").distinct()


class Machine:
    """Shift table and suffix buckets for windows of ``m`` words."""

    def __init__(self, m: int, windows: dict[bytes, list[str]]) -> None:
        self.m, self.block = m, min(2, m)
        self.furthest = m - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.bucket: dict[tuple[bytes, ...], list[tuple[list[bytes], list[str]]]] = defaultdict(list)
        for window, items in windows.items():
            words = window.split(b" ")
            for end in range(self.block, m + 1):
                key = tuple(words[end - self.block:end])
                self.shift[key] = min(self.shift.get(key, self.furthest), m - end)
            self.bucket[tuple(words[m - self.block:])].append((words, items))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        """Start and items of every occurrence."""
        m, block, furthest, shift, n = self.m, self.block, self.furthest, self.shift.get, len(words)
        end = m
        while end <= n:
            key = (words[end - 2], words[end - 1]) if block == 2 else (words[end - 1],)
            step = shift(key, furthest)
            if step:
                end += step
                continue
            found = words[end - m:end]
            for window, items in self.bucket[key]:
                if window == found:
                    yield end - m, items
            end += 1


def _scan(rows: DataFrame, shard) -> DataFrame:
    """Adds the hits of one broadcast shard (list of item, window, m) to ``(row, t, n_words, starts, lengths, items)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length: dict[int, dict[bytes, list[str]]] = defaultdict(lambda: defaultdict(list))
        for item, window, m in shard.value:
            by_length[m][window].append(item)
        machines = [Machine(m, windows) for m, windows in sorted(by_length.items())]
        for b in batches:
            n_words, columns = [], ([], [], [])
            for text, *known in zip(b.column(1), *(b.column(i).to_pylist() for i in (3, 4, 5))):
                words = fold_words(text.as_py())
                found = [(at, k.m, ids) for k in machines for at, ids in k.search(words)]
                n_words.append(len(words))
                columns[0].append(known[0] + [f[0] for f in found])
                columns[1].append(known[1] + [f[1] for f in found])
                columns[2].append(sorted({*known[2], *(i for f in found for i in f[2])}))
            types = (pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n_words, pa.int64()),
                                              *map(pa.array, columns, types)], b.schema.names)

    return rows.mapInArrow(run, rows.schema)


def find_windows(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", size: int = 13,
                 shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``(row, n_words, starts, lengths, items)`` per document row: every occurrence of a benchmark window.

    ``row`` holds the document's columns. ``starts`` and ``lengths`` are word positions, ``items`` the sorted ids (as
    strings) of the items whose windows occur. Null and empty texts have no words; items without words have no
    windows; repeated items and repeated document rows are allowed. An empty benchmark leaves empty lists.
    """
    spark = docs.sparkSession
    windows = staged(item_windows(benchmark, size=size), "windows")
    total = windows.agg(F.sum(F.length("window") + F.length("item") + 64)).first()[0] or 0
    n = total // shard_bytes + 1
    windows = windows.withColumn("shard", F.pmod(F.xxhash64("window", "m"), F.lit(n)))
    longs = F.array().cast("array<long>")
    small_batches(docs)
    found = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text_col].cast("binary").alias("t"),
                        F.lit(0).cast("long").alias("n_words"), longs.alias("starts"), longs.alias("lengths"),
                        F.array().cast("array<string>").alias("items"))
    for k in range(n):
        shard = spark.sparkContext.broadcast([(r.item, bytes(r.window), r.m) for r in
                                              windows.where(F.col("shard") == k).toLocalIterator()])
        found = _scan(staged(found, "hits") if k else found, shard)
    return found.drop("t")


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Adds ``n_hit`` (words inside occurrences) and ``contaminated`` (a twentieth of the words or more are hit)."""
    def covered(s, n):
        return F.transform(s, lambda x, i: F.struct(x.alias("s"), (x + n[i]).alias("e")))

    spans = F.array_sort(covered(F.col("starts"), F.col("lengths")))
    union = F.aggregate(
        spans, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda acc, x: F.struct((acc["n"] + F.greatest(x["e"] - F.greatest(x["s"], acc["end"]), F.lit(0))).alias("n"),
                                F.greatest(acc["end"], x["e"]).alias("end")), lambda acc: acc["n"])
    return (find_windows(docs, benchmark, **options).withColumn("n_hit", union.cast("long"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))))


def item_digest(items: list[str]) -> str:
    """The contract's digest of sorted item ids, for tests."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
