"""Token counts by a tokenizer compiled to a finite-state transducer.

The tokenizer (word-level splitting, then byte pair encoding with word-end symbols) becomes a
deterministic transducer over bytes whose transitions carry the change of the token count:

* The encoding of every prefix of a word ends in exactly one last token, and a sequence of tokens is an
  encoding exactly if its neighbouring pairs are. So a state is the longest suffix of the word that some
  token starts with, with the last token and the relative count at each place inside it. Reading a byte
  finds the one token that ends there and fits the last token before it; the count changes by the
  difference. A state also knows the change if the word ends here (word-end symbols differ).
* The splitting pattern is a small automaton around it: runs of letters, single numbers, runs of other
  characters, English contractions after an apostrophe that starts a run.
* States are determinised when first reached and kept for the later tasks of the worker. Beyond
  ``max_states`` the table is started afresh, which costs time and changes no count.

Texts are cut into equal chunks without regard to words or documents. A chunk's state map is constant
from its first white space on, so all chunks run in lockstep (numpy, one gather a byte); the scan over
the maps gives each chunk its entry state, and the heads of the chunks up to their first white
space run in a second pass. Chunks without any white space hand their exit state on in further rounds.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stresscast.llm.common import docs_with, process_cache

LETTER, NUMBER, SPACE, OTHER = range(4)
#: Symbols: ASCII bytes, continuation bytes, lead bytes by class, then marks for a special token and the end.
CONTINUED, LEADS, N_LEADS = 128, 192, 51
SPECIAL = LEADS + 4 * N_LEADS
END = SPECIAL + 1
N_SYMBOLS = END + 1
#: Fixed values of the splitting pattern: letters that end a contraction at once, and those that need one more.
CONTRACTED = "stmd"
CONTRACTED_TWO = {"r": "e", "v": "e", "l": "l"}
#: White space as Unicode defines it.
WHITE_SPACE = (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
#: Where Unicode 16 added letters and numbers (Python's own tables may be older).
UNICODE_16 = ((0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D85),
              (0x10EC2, 0x10EC4), (0x11380, 0x113D3), (0x116D0, 0x116E3), (0x11BC0, 0x11BF9), (0x13460, 0x143FA),
              (0x16100, 0x16139), (0x16D40, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5D0, 0x1E5FA))
#: Letters that are lower-cased other than by str.lower (a final sigma is a sigma like others).
LOWER_CASED = (("\u03a3", "\u03c3"), ("\ua7cb", "\u0264"), ("\ua7dc", "\u019b"))
HOLD, CLEAR = 0, 1


def byte_alphabet() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    names = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [names[b] for b in range(256)]


def character_classes() -> np.ndarray:
    """LETTER, NUMBER, SPACE or OTHER for every code point, as of Unicode 16 (the tokenizers library's tables)."""
    import regex
    table = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for run in regex.findall(pattern, every):
            table[[ord(c) for c in run]] = kind
    late = np.fromiter((unicodedata.category(chr(c)) == "Cn" for c in range(0x110000)), bool, 0x110000)
    for first, last in UNICODE_16:
        late[first:last + 1] = False
    table[late] = OTHER
    table[list(WHITE_SPACE)] = SPACE
    return table


class WordEncoder:
    """The byte pair encoder as a lazily built automaton over the bytes of one word."""

    def __init__(self, merges: list[list[str]], suffix: str) -> None:
        self.rank = {tuple(m): i for i, m in enumerate(merges)}
        self.suffix, self.names = suffix, byte_alphabet()
        open_tokens = {a + b for a, b in self.rank if not b.endswith(suffix)} | set(self.names)
        end_tokens = {a + b for a, b in self.rank if b.endswith(suffix)} | {c + suffix for c in self.names}
        self.tokens = open_tokens | end_tokens
        self.starts = {t[:n] for t in (*open_tokens, *(e[:-len(suffix)] for e in end_tokens)) for n in range(1, len(t) + 1)}
        self.split: dict[str, tuple[str, str]] = {}
        for m in self.rank:
            self.split.setdefault("".join(m), m)
        self.spines: dict[tuple[str, bool], list[tuple[str, int]] | None] = {}
        self.fits: dict[tuple[str, str], bool] = {}
        # A state: (suffix of the word, last token at each place in it, count there relative to the end, end change).
        self.states: list[tuple] = [("", (None,), (0,), 0)]
        self.ids = {self.states[0]: 0}
        self.steps: dict[tuple[int, int], tuple[int, int]] = {}

    def symbols(self, token: str) -> list[str]:
        if token.endswith(self.suffix) and len(token) > len(self.suffix):
            body = token[:-len(self.suffix)]
            return [*body[:-1], body[-1] + self.suffix]
        return list(token)

    def encode(self, symbols: list[str]) -> list[str]:
        """Plain byte pair encoding: merge the leftmost pair of least rank until none is left."""
        while len(symbols) > 1:
            ranks = [self.rank.get(p, 1 << 60) for p in zip(symbols, symbols[1:])]
            best = min(ranks)
            if best == 1 << 60:
                break
            i = ranks.index(best)
            symbols = [*symbols[:i], symbols[i] + symbols[i + 1], *symbols[i + 2:]]
        return symbols

    def spine(self, token: str, right: bool) -> list[tuple[str, int]] | None:
        """The symbols at one end of ``token`` as it is built, each with the rank of the merge that absorbs it.

        None if the token does not encode itself and so never occurs.
        """
        known = self.spines.get((token, right), 0)
        if known == 0:
            split = self.split.get(token)
            if split is None:
                known = [(token, 1 << 60)]
            elif self.encode(self.symbols(token)) != [token]:
                known = None
            else:
                inner = self.spine(split[right], right)
                known = inner and [*inner[:-1], (inner[-1][0], self.rank[split]), (token, 1 << 60)]
            self.spines[token, right] = known
        return known

    def follows(self, last: str | None, token: str) -> bool:
        """``token`` encodes itself, and ``last`` then ``token`` is an encoding.

        Both tokens are built at the same time, in order of rank. The pair holds unless the symbols that
        meet at the border merge before either is absorbed (of equal pairs the left one merges first).
        """
        right = self.spine(token, False)
        if right is None or last is None:
            return right is not None
        fit = self.fits.get((last, token))
        if fit is None:
            left = self.spine(last, True)
            i = j = 0
            fit = left is not None
            while fit:
                (x, r1), (y, r2) = left[i], right[j]
                if self.rank.get((x, y), 1 << 60) < r1 and self.rank.get((x, y), 1 << 60) <= r2:
                    fit = False
                elif r1 == r2 == 1 << 60:
                    break
                elif r1 <= r2:
                    i += 1
                else:
                    j += 1
            self.fits[last, token] = fit
        return fit

    def step(self, state: int, byte: int) -> tuple[int, int]:
        """Next state and change of the count on reading a byte of the word."""
        known = self.steps.get((state, byte))
        if known:
            return known
        tail, lasts, counts, _ = self.states[state]
        tail += self.names[byte]

        def ending(mark: str) -> tuple[str, int]:
            for at in range(len(tail)):
                if (token := tail[at:] + mark) in self.tokens and self.follows(lasts[at], token):
                    return token, counts[at] + 1
            raise AssertionError("every word has an encoding")

        last, delta = ending("")
        end = ending(self.suffix)[1] - delta
        lasts, counts = (*lasts, last), tuple(c - delta for c in (*counts, delta))
        cut = 0
        while tail[cut:] not in self.starts:
            cut += 1
        tail, lasts, counts = tail[cut:], lasts[cut:], counts[cut:]
        # Places that no token can start from any more say nothing about the rest of the word.
        live = [tail[i:] in self.starts for i in range(len(tail))] + [True]
        new = (tail, tuple(t if on else "" for t, on in zip(lasts, live)),
               tuple(c if on else 0 for c, on in zip(counts, live)), end)
        at = self.ids.get(new)
        if at is None:
            at = self.ids[new] = len(self.states)
            self.states.append(new)
        self.steps[state, byte] = at, delta
        return at, delta

    def count(self, word: bytes) -> int:
        """Tokens of a whole word."""
        state = total = 0
        for b in word:
            state, d = self.step(state, b)
            total += d
        return total + self.states[state][3]


class Transducer:
    """Splitting automaton and word encoder in one dense table of next states and count changes."""

    def __init__(self, spec: dict, max_states: int = 1 << 17) -> None:
        self.spec, self.max_states = spec, max_states
        self.classes = character_classes()
        self.special = [t["content"] for t in spec["added_tokens"]]
        self._fresh()

    def _fresh(self) -> None:
        self.words = WordEncoder(self.spec["model"]["merges"], self.spec["model"]["end_of_word_suffix"])
        self.modes: list[tuple[str, int]] = [("hold", 0), ("clear", 0)]
        self.ids = {m: i for i, m in enumerate(self.modes)}
        self.column = np.full(N_SYMBOLS, -1, np.int32)
        self.columns: list[int] = []
        self.next = np.full((1 << 10, 16), -1, np.int32)
        self.emit = np.zeros((1 << 10, 16), np.int16)

    def _id(self, mode: str, state: int) -> int:
        at = self.ids.get((mode, state))
        if at is None:
            at = self.ids[mode, state] = len(self.modes)
            self.modes.append((mode, state))
            if at >= len(self.next):
                self.next = np.concatenate((self.next, np.full_like(self.next, -1)))
                self.emit = np.concatenate((self.emit, np.zeros_like(self.emit)))
        return at

    def _closed(self, mode: str, state: int) -> int:
        """Count change when the word in progress ends."""
        if mode in ("L", "N", "O"):
            return self.words.states[state][3]
        if mode == "'":
            return self.words.count(b"'")
        if mode in CONTRACTED_TWO:
            return self.words.count(b"'") + self.words.count(mode.encode())
        return 0

    def transition(self, mode: str, state: int, symbol: int) -> tuple[str, int, int]:
        """Next mode and word state, and the change of the count."""
        if symbol >= SPECIAL:
            return "clear", 0, self._closed(mode, state) + (symbol == SPECIAL)
        if CONTINUED <= symbol < LEADS:
            if mode in ("L", "N", "O"):
                s, d = self.words.step(state, symbol)
                return mode, s, d
            return "clear", 0, 0
        if symbol < CONTINUED:
            kind, byte = int(self.classes[symbol]), symbol
        else:
            kind, byte = (symbol - LEADS) // N_LEADS, 0xC2 + (symbol - LEADS) % N_LEADS
        char = chr(symbol) if symbol < CONTINUED else ""
        done = 0
        if mode == "'":
            if char and char in CONTRACTED:
                return "clear", 0, self.words.count(b"'" + char.encode())
            if char in CONTRACTED_TWO:
                return char, 0, 0
            if kind == OTHER:
                s, d = self.words.step(0, ord("'"))
                mode, state, done = "O", s, d
        elif mode in CONTRACTED_TWO:
            if char == CONTRACTED_TWO[mode]:
                return "clear", 0, self.words.count(f"'{mode}{char}".encode())
            s, d = self.words.step(0, ord(mode))
            mode, state, done = "L", s, self.words.count(b"'") + d
        if (mode, kind) in (("L", LETTER), ("O", OTHER)):
            s, d = self.words.step(state, byte)
            return mode, s, done + d
        done += self._closed(mode, state)
        if kind == SPACE:
            return "clear", 0, done
        if char == "'":
            return "'", 0, done
        s, d = self.words.step(0, byte)
        return "LN O"[kind], s, done + d

    def _resolve(self, state: int, column: int) -> None:
        symbol = self.columns[column]
        if state == HOLD:
            to, change = (CLEAR if symbol >= SPECIAL or symbol < CONTINUED and self.classes[symbol] == SPACE else HOLD), 0
        else:
            mode, word, change = self.transition(*self.modes[state], symbol)
            to = self._id(mode, word)
        self.next[state, column], self.emit[state, column] = to, change

    def _step(self, states: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width = self.next.shape[1]
        at = states * width + columns
        to = self.next.ravel().take(at)
        if (to < 0).any():
            for k in np.unique(at[to < 0]).tolist():
                self._resolve(*divmod(k, width))
            to = self.next.ravel().take(at)
        return to, self.emit.ravel().take(at)

    def normalized(self, text: bytes) -> bytes:
        """Composed and lower-cased text, special tokens as one byte that no text holds."""
        if text.isascii():
            parts = [text]
            if b"<|" in text:
                for s in self.special:
                    parts = [x for p in parts for x in p.split(s.encode())]
            return b"\xfe".join(p.lower() for p in parts)
        parts = [text.decode("utf-8", "replace")]
        if b"<|" in text:
            for s in self.special:
                parts = [x for p in parts for x in p.split(s)]
        out = []
        for p in parts:
            p = unicodedata.normalize("NFC", p)
            for upper, lower in LOWER_CASED:
                p = p.replace(upper, lower)
            out.append(p.lower().encode())
        return b"\xfe".join(out)

    def _symbols(self, buffer: np.ndarray) -> np.ndarray:
        table = np.arange(256, dtype=np.int32)
        table[0x80:0xC0] = np.arange(CONTINUED, LEADS)
        table[0xFE], table[0xFF] = SPECIAL, END
        out = table[buffer]
        leads = np.flatnonzero((buffer >= 0xC2) & (buffer < 0xFE))
        if len(leads):
            b = buffer[leads].astype(np.int64)
            more = [buffer[np.minimum(leads + i, len(buffer) - 1)].astype(np.int64) & 0x3F for i in (1, 2, 3)]
            code = np.select([b < 0xE0, b < 0xF0], [(b & 0x1F) << 6 | more[0], (b & 0xF) << 12 | more[0] << 6 | more[1]],
                             (b & 7) << 18 | more[0] << 12 | more[1] << 6 | more[2])
            out[leads] = LEADS + self.classes[code].astype(np.int64) * N_LEADS + b - 0xC2
        used = np.unique(out)
        for s in used[self.column[used] < 0].tolist():
            self.column[s] = len(self.columns)
            self.columns.append(s)
        if len(self.columns) > self.next.shape[1]:
            wide = 16 * -(-len(self.columns) // 16)
            more = ((0, 0), (0, wide - self.next.shape[1]))
            self.next, self.emit = np.pad(self.next, more, constant_values=-1), np.pad(self.emit, more)
        return self.column[out]

    def counts(self, texts: list[bytes], chunk: int = 1024) -> np.ndarray:
        """Tokens of each text."""
        if not texts:
            return np.zeros(0, np.int64)
        if len(self.modes) > self.max_states:
            self._fresh()
        parts = [self.normalized(t) for t in texts]
        buffer = np.frombuffer(b"\xff".join([*parts, b""]), np.uint8)
        chunk = max(16, min(chunk, int(len(buffer) ** 0.5)))
        n = -(-len(buffer) // chunk)
        buffer = np.concatenate((buffer, np.full(n * chunk - len(buffer), 0xFF, np.uint8)))
        by_step = np.ascontiguousarray(self._symbols(buffer).reshape(n, chunk).T)
        changes = np.zeros((chunk, n), np.int16)
        # Every chunk from its first white space on.
        state = np.full(n, HOLD, np.int64)
        state[0] = CLEAR
        for i in range(chunk):
            state, changes[i] = self._step(state, by_step[i])
        # The scan over the state maps: entry states, then the heads that depend on them.
        exits, settled = state, state != HOLD
        ready = np.flatnonzero(settled[:-1]) + 1
        while len(ready):
            lane, entry = ready, exits[ready - 1].copy()
            held = np.full(len(lane), HOLD, np.int64)
            for i in range(chunk):
                held, _ = self._step(held, by_step[i, lane])
                entry, changes[i, lane] = self._step(entry, by_step[i, lane])
                on = held == HOLD
                if not on.any():
                    lane, entry = lane[:0], entry[:0]
                    break
                lane, held, entry = lane[on], held[on], entry[on]
            exits[lane] = entry
            ready = lane[lane + 1 < n] + 1
        ends = np.cumsum([len(p) + 1 for p in parts])
        flat = changes.T.ravel()[:ends[-1]]
        return np.add.reduceat(flat, np.concatenate(([0], ends[:-1])), dtype=np.int64)


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 batch_bytes: int = 4 << 20) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)`` per document row, whole texts, no special tokens added.

    Null and empty texts have no tokens. The tokenizer file (a ``tokenizers`` JSON of a byte-level BPE with
    word-end suffix) is read on the driver and broadcast; it has a fixed size.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = json.load(f)
    slim = {"added_tokens": spec["added_tokens"], "model": {k: spec["model"][k] for k in ("merges", "end_of_word_suffix")}}
    shared = docs.sparkSession.sparkContext.broadcast(slim)
    rows = docs_with(docs, id_col, text_col).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = process_cache()
        key = ("transducer", tokenizer_path)
        if key not in cache:
            cache[key] = Transducer(shared.value)
        machine = cache[key]
        for b in batches:
            texts = [x.as_py() or b"" for x in b.column(1)]
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            group = np.cumsum(sizes + 1) // batch_bytes
            found = [machine.counts([texts[i] for i in at]) for at in
                     np.split(np.arange(len(texts)), np.flatnonzero(np.diff(group)) + 1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes), pa.array(np.concatenate(found))],
                                             ["doc_id", "n_bytes", "n_tokens"])

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
