"""Best-fit decreasing packing of tokenized documents into windows.

A document is its token ids and one end mark. What fills whole windows is cut off at once; only the rests, all shorter
than a window, are packed. They are dealt by a hash into shards of about ``shard_rows`` rests, and each shard packs its
own: the rests go in by falling length, each into the tightest open window that holds it. A segment tree over the
remaining capacities finds that window in ``log2(window)`` steps, so a shard costs ``rows * log(window)`` whatever the
number of its windows.

Best fit leaves gaps when lengths do not match (copies of one long document, say). Cuts are free, so the emptiest
windows of a shard are then dissolved into the gaps of the others. Gaps of less than ``least_cut`` tokens stay padding,
as do no others: a window filled to a power of two needs no padding, and the last window of a shard is cut into such.
The padding is therefore below ``least_cut / window`` of all tokens whatever the lengths are.

Texts never travel: they are tokenized where they are read, and a rest carries its ids (two bytes each for vocabularies
up to 65,536) so that a cut piece gets its checksum. The token table is written once in the shared folder; a lost
executor repeats single tasks. A task holds one batch of texts or one shard.

Null texts are empty texts: one piece, the end mark. Null, repeated or clashing ids and columns do not matter, every
row is packed on its own; equal lengths go in by their row number. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stresscast.llm.common import docs_with, process_cache, staged

#: Characters that reach the tokenizer's library in one call; longer texts are cut where no token can cross.
CHUNK = 1 << 20
#: Distinct pieces of text in each of a worker's two generations.
REMEMBERED = 300_000
#: Characters that every Unicode version since 6.0 classes alike: Latin, Greek, Cyrillic, punctuation, kana, Han.
COMMON = "\t\n\r\x20-\x7E\xA0-\u024F\u0391-\u03A1\u03A3-\u03FF\u0400-\u0481\u048A-\u0523\u2010-\u2027\u3041-\u3096\u30A1-\u30FA\u4E00-\u9FA5"


def piece_pattern() -> re.Pattern:
    """The tokenizer's split into pieces that are merged on their own, for texts of common characters only.

    A short ending after an apostrophe; or letters, digits or other signs, with the space before them; or white space,
    of which the last character is left to what follows.
    """
    import unicodedata
    common = re.compile(f"[{COMMON}]")
    of = {"L": [], "N": [], "blank": [], "other": []}
    for c in map(chr, range(0xA000)):
        if common.match(c):
            kind = unicodedata.category(c)[0]
            of[kind if kind in "LN" else "blank" if c.isspace() else "other"].append(re.escape(c))
    letter, digit, blank, other = ("".join(of[k]) for k in ("L", "N", "blank", "other"))
    endings = "|".join("'" + e for e in ("s", "t", "re", "ve", "m", "ll", "d"))  # fixed values of the tokenizer
    return re.compile(f"{endings}| ?[{letter}]+| ?[{digit}]+| ?[{other}]+|[{blank}]+(?![^{blank}])|[{blank}]+")


def byte_letters() -> dict[int, str]:
    """What the byte-level vocabulary writes for each byte: visible Latin-1 characters as they are, the others in order from U+0100."""
    shown = {b for first, last in (("!", "~"), ("¡", "¬"), ("®", "ÿ")) for b in range(ord(first), ord(last) + 1)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(256 + hidden.index(b)) if b in hidden else chr(b) for b in range(256)}


class ByteTokens:
    """Ids by the ``tokenizers`` library: its model merges each distinct piece once, equal pieces are looked up.

    A text with a special token's string or a character that two Unicode versions may class differently goes to the
    library as it is. Pieces are kept in two generations; when the young one is full the old one is forgotten, so pieces in
    use stay known.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.pieces = piece_pattern()
        self.common = re.compile(f"[{COMMON}]*")
        self.break_at = re.compile(r"(?<=\S) (?=\S)")
        self.letters = byte_letters()
        self.young, self.old = {}, {}

    def chunks(self, text: str):
        """The text in parts; a part ends only before a single space between two other characters."""
        at = 0
        while len(text) - at > CHUNK:
            found = self.break_at.search(text, at + CHUNK)
            if found is None:
                break
            yield text[at:found.start()]
            at = found.start()
        yield text[at:] if at else text

    def learn(self, pieces: set) -> None:
        """Makes every piece a young one: an old one moves, a new one is merged by the library's model."""
        if len(self.young) + len(pieces) > REMEMBERED:
            self.young, self.old = {}, self.young
        new = pieces.difference(self.young)
        merge = self.library.model.tokenize
        for piece in new:
            ids = self.old.get(piece)
            if ids is None:
                ids = array("I", [t.id for t in merge(piece.encode().decode("latin-1").translate(self.letters))]).tobytes()
            self.young[piece] = ids

    def ids(self, text: str) -> np.ndarray:
        parts = []
        for part in self.chunks(text):
            if not self.common.fullmatch(part) or any(s in part for s in self.specials):
                parts.append(np.array(self.library.encode(part, add_special_tokens=False).ids, "<u4"))
            else:
                pieces = self.pieces.findall(part)
                distinct = set(pieces)
                if not distinct <= self.young.keys():
                    self.learn(distinct)
                parts.append(np.frombuffer(b"".join(map(self.young.__getitem__, pieces)), "<u4"))
        return np.concatenate(parts)


def _tokenizer(path: str) -> ByteTokens:
    cache = process_cache()
    if ("byte tokens", path) not in cache:
        cache["byte tokens", path] = ByteTokens(path)
    return cache["byte tokens", path]


def token_table(docs: DataFrame, tokenizer: str, window: int = 1024, end_id: int = 0) -> DataFrame:
    """Pieces of every document: whole windows, and the rest with its ids (``ids`` is null for whole windows).

    Columns: ``row`` (number of the document's row), ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``seq`` (number of a whole window) and ``ids``.
    """
    from tokenizers import Tokenizer
    narrow = Tokenizer.from_file(tokenizer).get_vocab_size() <= 1 << 16 and end_id < 1 << 16
    store = "<u2" if narrow else "<u4"
    docs = docs_with(docs, "doc_id", "text")
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("row", T.LongType()), T.StructField("doc_id", id_type), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("seq", T.LongType()),
        T.StructField("ids", T.BinaryType())])

    def tokenize(batches):
        from pyspark import TaskContext
        tokens = _tokenizer(tokenizer)
        first = TaskContext.get().partitionId() << 33
        row = seq = 0
        for batch in batches:
            picked, out = [], {k: [] for k in ("row", "start", "length", "ids_crc32", "doc_tokens", "seq", "ids")}

            def emit(start, length, crc, n, number, ids):
                picked.append(i)
                for k, v in zip(out, (first + row, start, length, crc, n, number, ids)):
                    out[k].append(v)
            for i, text in enumerate(batch.column("text")):
                ids = np.append(tokens.ids(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                whole = len(ids) // window * window
                for start in range(0, whole, window):
                    emit(start, window, zlib.crc32(ids[start:start + window].tobytes()), len(ids), first + seq, None)
                    seq += 1
                if whole < len(ids):
                    rest = ids[whole:]
                    emit(whole, len(rest), zlib.crc32(rest.tobytes()), len(ids), None, rest.astype(store).tobytes())
                row += 1
            cols = {k: pa.array(v, pa.binary() if k == "ids" else pa.int64()) for k, v in out.items()}
            cols["doc_id"] = batch.column("doc_id").take(pa.array(picked, pa.int64()))
            yield pa.RecordBatch.from_arrays([cols[f] for f in schema.names], names=schema.names)

    return docs.mapInArrow(tokenize, schema)


class CapacityTree:
    """Segment tree over remaining capacities 0 to ``window``; a leaf is the open windows with that much room."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open = [[] for _ in range(window + 1)]

    def add(self, room: int, window: int) -> None:
        self.open[room].append(window)
        at = room + self.leaves
        while at:
            self.count[at] += 1
            at >>= 1

    def take_tightest(self, need: int):
        """Room and number of the open window with the least room that is at least ``need``; None if there is none."""
        count, at = self.count, need + self.leaves
        while not count[at]:
            while at & 1:  # what follows a right child hangs on an ancestor's right sibling; the root has none
                at >>= 1
            if at == 0:
                return None
            at += 1
        while at < self.leaves:
            at = 2 * at if count[2 * at] else 2 * at + 1
        room = at - self.leaves
        while at:
            count[at] -= 1
            at >>= 1
        return room, self.open[room].pop()


def best_fit_decreasing(lengths, window: int) -> list[list[int]]:
    """Windows as lists of positions in ``lengths``, which must fall and not exceed ``window``."""
    tree, windows = CapacityTree(window), []
    for i, length in enumerate(lengths):
        found = tree.take_tightest(length)
        if found is None:
            found = window, len(windows)
            windows.append([])
        room, number = found
        windows[number].append(i)
        if room > length:
            tree.add(room - length, number)
    return windows


def fill_gaps(windows: list[list[tuple[int, int, int]]], window: int, least_cut: int):
    """Windows of (item, start, length) without gaps of ``least_cut`` or more, but for lengths of a power of two.

    The fullest windows take cuts of the emptiest; the one that remains is cut into powers of two.
    """
    filled = [sum(p[2] for p in w) for w in windows]
    gapped = [k for k, n in enumerate(filled) if window - n >= least_cut and n & (n - 1)]
    gapped.sort(key=lambda k: (-filled[k], k))
    low, high = 0, len(gapped) - 1
    while low < high:
        to, of = windows[gapped[low]], windows[gapped[high]]
        room = window - filled[gapped[low]]
        item, start, length = of.pop()
        moved = min(room, length)
        if moved < length:
            of.append((item, start, length - moved))
        to.append((item, start + length - moved, moved))
        filled[gapped[low]] += moved
        filled[gapped[high]] -= moved
        if moved == room:
            low += 1
        if not of:
            high -= 1
    out = [w for k, w in enumerate(windows) if w and not (low == high and k == gapped[low])]
    if low == high and windows[gapped[low]]:
        last = windows[gapped[low]]
        if window - filled[gapped[low]] < least_cut:
            return [*out, last]
        left = filled[gapped[low]]
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            short = []
            while size:
                item, start, length = last.pop(0)
                moved = min(size, length)
                if moved < length:
                    last.insert(0, (item, start + moved, length - moved))
                short.append((item, start, moved))
                size -= moved
            out.append(short)
    return out


def pack(docs: DataFrame, tokenizer: str, window: int = 1024, end_id: int = 0, shard_rows: int = 4096,
         least_cut: int = 8) -> DataFrame:
    """Pieces of all documents with their place: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset``."""
    table = staged(token_table(docs, tokenizer, window, end_id), "tokens")
    rests = table.where("ids is not null").drop("seq")
    n_shards = max(1, -(-rests.count() // shard_rows))
    wide = T.StructType([*(table.schema[c] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")),
                         T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def pack_shard(key, rows):
        rows = rows.sort_by([("length", "descending"), ("row", "ascending")])
        lengths = rows["length"].to_pylist()
        windows = [[(i, 0, lengths[i]) for i in w] for w in best_fit_decreasing(lengths, window)]
        places, first = [], key[0].as_py() << 33
        for number, pieces in enumerate(fill_gaps(windows, window, least_cut)):
            offset = 0
            for item, start, length in pieces:
                places.append((item, start, length, 2 * (first + number) + 1, offset))
                offset += length
        item, start, length, sequence, offset = (np.array(c, np.int64) for c in zip(*places))
        out = rows.select(["doc_id", "start", "ids_crc32", "doc_tokens"]).take(pa.array(item))
        crc = out["ids_crc32"].to_numpy().copy()
        for k in np.flatnonzero(length != np.array(lengths)[item]):  # cut pieces
            raw = rows["ids"][int(item[k])].as_py()
            ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * lengths[item[k]] else "<u4")
            crc[k] = zlib.crc32(ids[start[k]:start[k] + length[k]].astype("<u4").tobytes())
        cols = {"doc_id": out["doc_id"], "start": pa.array(out["start"].to_numpy() + start), "length": pa.array(length),
                "ids_crc32": pa.array(crc), "doc_tokens": out["doc_tokens"], "sequence_id": pa.array(sequence),
                "offset": pa.array(offset)}
        return pa.table([cols[c] for c in wide.names], names=wide.names)

    packed = (rests.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(n_shards)).cast("long"))
              .groupBy("shard").applyInArrow(pack_shard, wide))
    whole = table.where("ids is null").select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                              (F.col("seq") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return whole.unionByName(packed)
