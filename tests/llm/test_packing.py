"""Packing: pieces tile every document, windows are full, best fit is best fit, ids are the library's."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from stresscast.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
POWERS = {1 << k for k in range(11)}


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, texts, library, window=1024):
    """Every id is in one piece, checksums hold, offsets have no gaps. Returns tokens and padding."""
    want = sorted((d, *ids_of(library, t)) for d, t in texts if d is not None)
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    if len({d for d, _ in texts}) == len(texts):
        for d, *ids in want:
            at = 0
            for r in sorted(by_doc[d], key=lambda r: r["start"]):
                part = ids[at:at + r["length"]]
                assert (r["start"], r["doc_tokens"], len(part)) == (at, len(ids), r["length"])
                assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
                at += r["length"]
            assert at == len(ids)
    assert sum(r["length"] for r in rows) == sum(len(ids_of(library, t)) for _, t in texts)
    padding = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= window
        padding += 0 if at in POWERS else window - at
    return sum(r["length"] for r in rows), padding


def run(docs, **more):
    return [r.asDict() for r in packing.pack(docs, PATH, **more).collect()]


def test_tightest_window_against_a_scan():
    rng = random.Random(5)
    for window in (1, 7, 64, 100):
        tree, held = packing.CapacityTree(window), {}
        for n in range(400):
            room = rng.randint(0, window)
            tree.add(room, n)
            held.setdefault(room, []).append(n)
            need = rng.randint(1, window)
            fit = min((r for r in held if r >= need and held[r]), default=None)
            got = tree.take_tightest(need)
            assert (got and got[0]) == fit
            if got:
                held[fit].remove(got[1])


def naive_best_fit(lengths, window):
    room, out = [], []
    for i, n in enumerate(lengths):
        fit = [r for r in room if r >= n]
        if fit:
            k = room.index(min(fit))
        else:
            k = len(room)
            room.append(window)
            out.append([])
        room[k] -= n
        out[k].append(i)
    return out, sorted(room)


def test_best_fit_decreasing_against_a_scan():
    rng = random.Random(6)
    for window in (16, 50, 1024):
        lengths = sorted((rng.randint(1, window) for _ in range(300)), reverse=True)
        got = packing.best_fit_decreasing(lengths, window)
        want, room = naive_best_fit(lengths, window)
        assert sorted(i for w in got for i in w) == list(range(300))
        assert sorted(window - sum(lengths[i] for i in w) for w in got) == room and len(got) == len(want)


def test_gaps_are_filled_for_any_lengths():
    rng = random.Random(7)
    for lengths in ([600] * 500, [1023] * 50, [513] * 33 + [7] * 3, [1], [], [1024] * 4, [512] * 5,
                    sorted((rng.randint(1, 1024) for _ in range(700)), reverse=True)):
        windows = [[(i, 0, lengths[i]) for i in w] for w in packing.best_fit_decreasing(lengths, 1024)]
        out = packing.fill_gaps(windows, 1024, 8)
        tokens = [(i, s + k) for w in out for i, s, n in w for k in range(n)]
        assert sorted(tokens) == [(i, k) for i, n in enumerate(lengths) for k in range(n)]
        for w in out:
            n = sum(p[2] for p in w)
            assert n in POWERS or 1024 - 8 < n <= 1024


def test_hand_made_documents(make_docs, library):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9)))
    texts = [(1, None), (2, ""), (3, "a"), (4, " \n\t "), (5, "x<|endoftext|>y 's it's"), (6, "ᲐŒ ﷺ 𝔘 é½²"),
             (7, " ".join(word() for _ in range(9000))), (8, "z" * 30000), (9, "你好" * 2000)]
    texts += [(10 + k, "same text of a group, " * 70) for k in range(60)]
    texts += [(100 + k, " ".join(word() for _ in range(rng.randint(0, 700)))) for k in range(80)]
    tokens, padding = check(run(make_docs(texts)), texts, library)
    assert padding < 0.01 * tokens
    small = run(make_docs(texts), shard_rows=16)
    tokens, padding = check(small, texts, library)
    assert padding < 0.01 * tokens and len({r["sequence_id"] >> 34 for r in small}) > 3


def test_repeated_rows_null_ids_and_empty_table(make_docs, library):
    texts = [(5, "a b c"), (5, "a b c"), (None, "d"), (None, "d"), (2**53 + 1, "e"), (None, None)]
    rows = run(make_docs(texts))
    check(rows, texts, library)
    assert sorted((r["doc_id"] or 0, r["doc_tokens"]) for r in rows) == [
        (0, 1), (0, 2), (0, 2), (5, 4), (5, 4), (2**53 + 1, 2)]
    assert run(make_docs([])) == []


def test_ids_are_the_librarys_for_every_character(library):
    """Each character beside letters, digits, marks and blanks; cut texts give the ids of the whole."""
    tokens = packing.ByteTokens(PATH)
    bases = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000] + [chr(c) for c in range(0x3100, 0x30000, 97)
                                                                           if not 0xD800 <= c < 0xE000]
    for at in range(0, len(bases), 500):
        text = "".join(f"a{c}1{c}{c} {c}b {c} .{c}-\n{c}" for c in bases[at:at + 500])
        assert tokens.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids
    for c in bases:  # one at a time, so that a rare character does not send the others to the library
        if tokens.common.fullmatch(c):
            text = f"a{c}1{c}{c} {c}b {c} .{c}-\n{c}"
            assert tokens.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_long_texts_in_chunks(library, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK", 50)
    tokens, rng = packing.ByteTokens(PATH), random.Random(9)
    for _ in range(200):
        text = "".join(rng.choice(["a", "It's", " ", "  ", "\n", "12", "é", "!", " the", "long", " x"]) for _ in range(150))
        assert tokens.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids
        assert "".join(tokens.chunks(text)) == text
