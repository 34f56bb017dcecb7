"""Token counts against the tokenizers library, character by character and over mixed texts."""

import json
import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from stresscast.llm import token_transducer as tt  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in tok.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def machine():
    with open(PATH, encoding="utf-8") as f:
        return tt.Transducer(json.load(f))


HARD = ["", " ", "a", "don't stop", "we're you've they'll I'd 'tis ''s 's's x'", "'rest 'veal 'll 'l 'r' 'v1 '", "hello 123 4５6 ²",
        "<|endoftext|>x<|startoftext|> <|endoftext|", "<|endoftext|><|endoftext|>", "ΟΔΟΣ Σίσυφος İstanbul ǅ ﬀ", "é Å",
        "日本語テキスト", "a b　c\u0085d​q", "!!!???''''re'", "\x00\x1c\x1f\x7f", "supercalifragilistic" * 400,
        "\U0001F600\U0001F468‍\U0001F469", "x" * 5000, "1" * 3000, "word " * 3000]


def test_hard_texts(library, machine):
    assert machine.counts([t.encode() for t in HARD]).tolist() == library(HARD)
    for chunk in (16, 50):
        assert machine.counts([t.encode() for t in HARD], chunk).tolist() == library(HARD)


def test_random_texts(library, machine):
    rng = random.Random(8)
    texts = ["".join(rng.choice("abetrs'lvdm !.1\n<|") for _ in range(rng.randrange(80))) for _ in range(2000)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x500), rng.randrange(0x500, 0xD7FF)]))
                      for _ in range(rng.randrange(30))) for _ in range(1000)]
    assert machine.counts([t.encode() for t in texts]).tolist() == library(texts)


def test_every_character_class(library, machine):
    points = [c for c in range(0x3000) if not 0xD800 <= c < 0xE000] + list(range(0xA640, 0xAB70)) + list(range(0x13430, 0x14400, 7))
    texts = [f"a{chr(c)}b {chr(c)}1{chr(c)}" for c in points]
    assert machine.counts([t.encode() for t in texts]).tolist() == library(texts)


def test_full_table_starts_afresh(library):
    with open(PATH, encoding="utf-8") as f:
        small = tt.Transducer(json.load(f), max_states=50)
    rng = random.Random(9)
    for _ in range(5):
        texts = ["".join(rng.choice("abcdefgh ") for _ in range(60)) for _ in range(20)]
        assert small.counts([t.encode() for t in texts]).tolist() == library(texts)


def test_documents(make_docs, library):
    rows = [(i, t) for i, t in enumerate(HARD)] + [(100, None), (1, HARD[1]), (None, "no id")]
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens)
                 for r in tt.token_counts(make_docs(rows), PATH, batch_bytes=300).collect())
    want = sorted((-1 if i is None else i, len((t or "").encode()), n)
                  for (i, t), n in zip(rows, library([t or "" for _, t in rows])))
    assert got == want
    assert tt.token_counts(make_docs(rows).where("doc_id < 0"), PATH).count() == 0
