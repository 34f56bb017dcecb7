"""How text filters interact: what each removes, alone and after others, in every order of application.

Two of the five filters read a sparse document-term matrix. It is built in shards: a task encodes the words of a run
of documents by a dictionary of its own and writes one shard in compressed-sparse-row form with that dictionary, whose
words are dealt into buckets by a hash. The tasks of the second step each number the distinct words of one bucket over all
shards; a word's global id is its bucket and its number in it. Each shard is then rewritten to the global ids. So a word
crosses the network once a shard, however often it occurs, and in one row with the others of its bucket. Row sums
of the matrix are the numbers of words, the non-zeros of a row the numbers of distinct words.

The number of buckets follows the bytes of text, so a bucket's dictionary stays in the megabytes at any size. A shard is
several rows, one for each block of its documents, and its global ids are a row for each bucket; they meet in the task that
rewrites the shard. So no row is larger than a block, and a task holds a few rows of the table of shards at a time, not
those of its whole split.

The other flags are made in the same pass over the texts. What is left of a document is its id, part, text hash and
flags; copies are found by hash without any pair, and the documents are counted by part, failures and labels. All orders
are then read off these counts, at most 32 rows a part.

Null texts are empty texts, null parts are the empty string. Empty texts: no words, not below half distinct, under 200.
Rows without an id are never copies and have no labels; repeated rows of one id count each, and none of them is a
copy of the other, as its id is not smaller. Of several label rows of an id, one with the value 1 is enough. Labels
without an id are ignored. Extra columns do not matter. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stresscast.llm.common import docs_with, staged

#: UTF-8 bytes of text in a shard before it is closed (a longer text is a shard of its own length).
SHARD_BYTES = 4 << 20
#: UTF-8 bytes of text in a block of a shard, which is one row (a longer text is a block of its own length).
BLOCK_BYTES = 256 << 10
#: What a document adds to both besides its text: its id, part, hash and numbers.
DOC_BYTES = 64
#: Rows of a row group of the table of shards. A page is not closed before its 100th row by its size, nor a group, so
#: without this the writer and the readers hold what a whole task has written.
GROUP_ROWS = 64
#: UTF-8 bytes of text for each bucket of the dictionary.
BUCKET_BYTES = 4 << 20
#: The filters in the order of their bits.
FILTERS = "ABCDE"
#: Characters of filter D (fixed by the result contract).
SYMBOLS = b"#$%&*|"
UPPER = bytes(range(65, 91))


def _pack(values: np.ndarray) -> bytes:
    """Unsigned integers below 2^32, byte plane by byte plane: first the number of planes, the high ones of zeros are left out."""
    planes = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([planes]) + values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :planes].T.tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8)[1:].reshape(raw[0], -1)
    values = np.zeros((planes.shape[1], 4), np.uint8)
    values[:, :raw[0]] = planes.T
    return values.view("<u4").ravel().astype(np.int64)


def _list(values: pa.Array, ends=None) -> pa.ListArray:
    """One row that holds all values, or the rows that begin and end at ``ends``."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)] if ends is None else ends, pa.int32()), values)


def local_shards(docs: DataFrame) -> DataFrame:
    """Rows of the matrix in shards, each with the words of its own columns: written once, in the shared folder.

    A shard is a row for each block of its documents: ``shard``, the arrays ``doc_id``, ``part``, ``text_hash``, ``flags``
    (bits of C and D) and ``row_size`` (non-zeros of each row), ``indices`` and ``counts`` (packed integers). Its words are dealt
    over these rows, ``words``: by bucket, in the order of the columns, each bucket's as one text with a line feed between
    words (no word holds one); ``n_words``: how many these are.
    """
    docs = docs_with(docs, "doc_id", "text", "lang")
    id_type = docs.schema["doc_id"].dataType
    text = F.coalesce("text", F.lit(""))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n_buckets = max(1, -(-size // BUCKET_BYTES))
    source = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"),
                         F.unhex(F.sha2(text, 256)).alias("text_hash"))
    array = lambda t: T.ArrayType(t)
    bucket = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("n", T.IntegerType()),
                           T.StructField("joined", T.StringType())])
    schema = T.StructType([T.StructField(n, t) for n, t in (
        ("shard", T.LongType()), ("doc_id", array(id_type)), ("part", array(T.StringType())),
        ("text_hash", array(T.BinaryType())), ("flags", array(T.IntegerType())), ("row_size", array(T.LongType())),
        ("indices", T.BinaryType()), ("counts", T.BinaryType()), ("words", array(bucket)), ("n_words", T.LongType()))])

    def encode(batches):
        from pyspark import TaskContext
        shard = TaskContext.get().partitionId() << 33
        kept, codes, bits, sizes, index, counts, held, ends, in_block = [], {}, [], [], [], [], 0, [0], 0

        def close():
            if ends[-1] < len(bits):
                ends.append(len(bits))
            blocks = list(zip(ends, ends[1:]))
            rows = pa.Table.from_batches(kept).combine_chunks()
            flat = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.uint32)
            words = list(codes)
            deal = np.fromiter((zlib.crc32(w) % n_buckets for w in words), np.int64, len(words))
            order = np.argsort(deal, kind="stable")
            column = np.empty(len(words), np.uint32)
            column[order] = np.arange(len(words), dtype=np.uint32)
            numbers, starts, ns = np.unique(deal[order], return_index=True, return_counts=True)
            texts = [b"\n".join(words[k] for k in order[a:a + n]).decode() for a, n in zip(starts, ns)]
            by_bucket = pa.StructArray.from_arrays(
                [pa.array(numbers, pa.int64()), pa.array(ns, pa.int32()), pa.array(texts, pa.string())], ["bucket", "n", "joined"])
            deals = np.arange(len(ends)) * len(numbers) // len(blocks)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard] * len(blocks)), *(_list(rows[c].combine_chunks(), ends) for c in ("doc_id", "part", "text_hash")),
                 _list(pa.array(bits, pa.int32()), ends), _list(pa.array(sizes, pa.int64()), ends),
                 pa.array([_pack(column[flat(index[a:b])]) for a, b in blocks], pa.binary()),
                 pa.array([_pack(flat(counts[a:b])) for a, b in blocks], pa.binary()), _list(by_bucket, deals),
                 pa.array([int(ns[a:b].sum()) for a, b in zip(deals, deals[1:])], pa.int64())], names=schema.names)

        for batch in batches:
            done = 0
            for i, text in enumerate(batch.column("text")):
                text = text.as_py()
                raw = text.encode()
                found = Counter(raw.split())  # bytes split at the contract's white space exactly
                upper = len(raw) - len(raw.translate(None, UPPER))
                bits.append((100 * upper > 3 * len(text)) << 2 | (len(raw) > len(raw.translate(None, SYMBOLS))) << 3)
                sizes.append(len(found))
                index.append(np.fromiter((codes.setdefault(w, len(codes)) for w in found), np.uint32, len(found)))
                counts.append(np.fromiter(found.values(), np.uint32, len(found)))
                held += len(raw) + DOC_BYTES
                in_block += len(raw) + DOC_BYTES
                if in_block >= BLOCK_BYTES:
                    ends.append(len(bits))
                    in_block = 0
                if held >= SHARD_BYTES or i == batch.num_rows - 1:
                    kept.append(batch.select(["doc_id", "part", "text_hash"]).slice(done, i + 1 - done))
                    done = i + 1
                if held >= SHARD_BYTES:
                    yield close()
                    shard += 1
                    kept, codes, bits, sizes, index, counts, held, ends, in_block = [], {}, [], [], [], [], 0, [0], 0
        if kept:
            yield close()

    return staged(source.mapInArrow(encode, schema), "matrix", options={"parquet.block.row.count.limit": GROUP_ROWS})


def _by_bucket(shards: DataFrame) -> DataFrame:
    return shards.select("shard", F.inline("words")).groupBy("bucket")


def _numbered(rows: pa.Table):
    """Numbers of the words of one bucket, in the order in which they first occur: per shard its numbers, and the dictionary."""
    rows, known = rows.sort_by("shard"), {}
    numbers = [np.fromiter((known.setdefault(w, len(known)) for w in text.as_py().split("\n")), np.uint32, n.as_py())
               for text, n in zip(rows["joined"], rows["n"])]
    return rows, numbers, known


def dictionary(shards: DataFrame) -> DataFrame:
    """Every distinct word of all shards once, with its global id: ``word``, ``word_id``."""
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("word_id", T.LongType())])

    def words(key, rows):
        known = _numbered(rows)[2]
        first = key[0].as_py() << 32
        return pa.table([pa.array(list(known), pa.string()), pa.array(np.arange(first, first + len(known)))], names=schema.names)

    return _by_bucket(shards).applyInArrow(words, schema)


def _in_global_ids(shards: DataFrame, rewrite, schema: T.StructType) -> DataFrame:
    """The shards after ``rewrite``, a function of one shard's rows and the global ids of its words by bucket."""
    numbered = T.StructType([T.StructField("shard", T.LongType()), T.StructField("bucket", T.LongType()),
                             T.StructField("ids", T.BinaryType())])

    def number(key, rows):
        rows, numbers, _ = _numbered(rows)
        return pa.table([rows["shard"], rows["bucket"], pa.array([_pack(n) for n in numbers], pa.binary())], names=numbered.names)

    ids = _by_bucket(shards).applyInArrow(number, numbered)
    return shards.drop("words").groupBy("shard").cogroup(ids.groupBy("shard")).applyInArrow(rewrite, schema)


def _entries(blocks: pa.Table, numbers: pa.Table):
    """The rows of one shard in global ids: batch and place, non-zeros of each document, column ids and counts of all entries."""
    numbers = numbers.sort_by("bucket")
    ids = np.concatenate([np.zeros(0, np.int64), *((bucket << 32) + _unpack(raw) for bucket, raw in zip(
        numbers["bucket"].to_pylist(), numbers["ids"].to_pylist()))])
    if len(ids) != sum(blocks["n_words"].to_pylist()) or len(np.unique(ids)) != len(ids):
        raise ValueError("the words of a shard have no global ids of their own")
    for batch in blocks.to_batches():
        get = lambda c, row: batch.column(c)[row]
        for row in range(batch.num_rows):
            yield (batch, row, np.asarray(get("row_size", row).values, np.int64),
                   ids[_unpack(get("indices", row).as_py())], _unpack(get("counts", row).as_py()))


def term_matrix(shards: DataFrame) -> DataFrame:
    """The blocks of the shards in global word ids: rows sorted by ``indices`` (array of word ids), ``counts`` beside them."""
    kept = ["shard", "doc_id", "part", "text_hash", "flags", "row_size"]
    schema = T.StructType([*(shards.schema[c] for c in kept), T.StructField("indices", T.ArrayType(T.LongType())),
                           T.StructField("counts", T.ArrayType(T.LongType()))])

    def rewrite(blocks, numbers):
        out = []
        for batch, row, sizes, columns, counts in _entries(blocks, numbers):
            order = np.lexsort((columns, np.repeat(np.arange(len(sizes)), sizes)))
            out.append(pa.RecordBatch.from_arrays([*(batch.column(c).slice(row, 1) for c in kept),
                                                   *(_list(pa.array(v[order])) for v in (columns, counts))], names=schema.names))
        return pa.Table.from_batches(out)

    return _in_global_ids(shards, rewrite, schema)


def row_totals(shards: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, ``part``, ``text_hash``, ``flags``, ``n_words`` (row sum), ``n_distinct`` (non-zeros).

    The totals are taken where the shard gets its global ids, so the entries do not travel back and forth.
    """
    element = lambda c: shards.schema[c].dataType.elementType
    kept = ["doc_id", "part", "text_hash", "flags"]
    schema = T.StructType([*(T.StructField(c, element(c)) for c in kept), T.StructField("n_words", T.LongType()),
                           T.StructField("n_distinct", T.LongType())])

    def total(blocks, numbers):
        out = []
        for batch, row, sizes, _, counts in _entries(blocks, numbers):  # the columns of a row are different ones
            ends = np.cumsum(sizes)
            sums, nonzero = (np.concatenate([[0], np.cumsum(v)]) for v in (counts, counts > 0))
            out.append(pa.RecordBatch.from_arrays(
                [*(batch.column(c)[row].values for c in kept), pa.array(sums[ends] - sums[ends - sizes]),
                 pa.array(nonzero[ends] - nonzero[ends - sizes])], names=schema.names))
        return pa.Table.from_batches(out)

    return _in_global_ids(shards, total, schema)


def failures(docs: DataFrame, min_words: int = 200, min_distinct: int = 50) -> DataFrame:
    """Per document its failures of A to D as bits of ``mask``: ``doc_id``, ``part``, ``text_hash``, ``mask``.

    A: fewer than ``min_words`` words. B: fewer than ``min_distinct`` distinct words of a hundred.
    """
    shards = local_shards(docs)
    rows = row_totals(shards)
    few = (F.col("n_words") < min_words).cast("int")
    same = (100 * F.col("n_distinct") < min_distinct * F.col("n_words")).cast("int") * 2
    return rows.select("doc_id", "part", "text_hash", (F.col("flags") + few + same).alias("mask"))


def failure_counts(found: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by part and failures, copies (bit of E) included: ``part``, ``mask``, ``n``, ``good``, ``toxic``."""
    is_one = lambda c: F.max(F.coalesce(labels[c] == 1, F.lit(False)).cast("int")).alias(c)
    marks = labels.where(labels["doc_id"].isNotNull()).groupBy(labels["doc_id"]).agg(is_one("quality"), is_one("toxic"))
    # rows with an id are told by a count: a condition on the id would go below the exchange, and all before it run twice
    rows = found.groupBy("doc_id", "part", "text_hash", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.count("doc_id").alias("n_named"))
    named = rows.where("n_named > 0").join(marks, "doc_id", "left").fillna(0, ["quality", "toxic"])
    # one row for each text, part and label: its documents, its smallest id and the rows of that id
    texts = named.groupBy("text_hash", "part", "mask", "quality", "toxic").agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("first"), F.min_by("n", "doc_id").alias("n_first"))
    first = F.min("first").over(Window.partitionBy("text_hash"))
    split = texts.withColumn("originals", F.when(F.col("first") == first, F.col("n_first")).otherwise(0))
    cells = split.select("part", "quality", "toxic", F.inline(F.array(
        F.struct(F.col("mask").alias("mask"), F.col("originals").alias("n")),
        F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("originals")).alias("n")))))
    nameless = rows.where("n_named = 0").select("part", F.lit(0).alias("quality"), F.lit(0).alias("toxic"), "mask", "n")
    return cells.unionByName(nameless).where("n > 0").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("quality")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def orders(cells: DataFrame) -> DataFrame:
    """Every order of the filters, read off the counts: one row per part, order and step."""
    all_orders = ["".join(p) for p in permutations(FILTERS)]
    bit = {f: 1 << k for k, f in enumerate(FILTERS)}
    before = [sum(bit[f] for f in o[:k]) for o in all_orders for k in range(len(FILTERS))]
    here = [bit[f] for o in all_orders for f in o]
    pick = lambda values, k: F.element_at(F.lit(values), k + 1)
    k = F.col("k")
    steps = (cells.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(len(here) - 1))))
             .withColumn("here", pick(here, k)).withColumn("before", pick(before, k)))
    fails, out = F.col("mask").bitwiseAND(F.col("here")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0
    total = lambda condition, c="n": F.sum(F.when(condition, F.col(c)).otherwise(0)).cast("long")
    found = steps.groupBy("part", "k", "here").agg(
        total(~fails & ~out).alias("kept"), total(fails & ~out).alias("removed"), total(fails & out).alias("redundant"),
        total(F.col("mask") == F.col("here")).alias("unique_fails"), total(fails & ~out, "good").alias("good_lost"),
        total(fails & ~out, "toxic").alias("toxic_lost"))
    of_filter = Window.partitionBy("part", "here")  # 120 rows
    return found.select(
        "part", pick(all_orders, F.floor(k / len(FILTERS)).cast("int")).alias("filter_order"),
        (k % len(FILTERS) + 1).cast("int").alias("step"), "kept", "removed", "redundant", "unique_fails", "good_lost",
        "toxic_lost", F.sum("removed").over(of_filter).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The interaction table of the five filters over ``docs``, with what of ``labels`` they remove."""
    return orders(failure_counts(failures(docs), labels))
