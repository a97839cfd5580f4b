"""BPE against the tokenizers library."""

import random

import numpy as np
import pytest
import tokenizers

from chatlog.llm import bpe
from chatlog.llm.queries import VOCABULARY
from fixtures import docs


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def own():
    with open(VOCABULARY, encoding="utf-8") as file:
        return bpe.Codec(file.read())


def check(library, own, text):
    ids = own.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert own.decode(ids) == library.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)


def test_random_texts(library, own):
    rng = random.Random(1)
    parts = ["a", "B", " ", "  ", "\n", "\t", "'s", "'LL", "1", "é", "ß", "漢", "🙂", "<|endoftext|>", "<|endo", "\x85", "\x1c", "　", " ", "--", "the", "ing", "́", "\x00"]
    for _ in range(2000):
        check(library, own, "".join(rng.choices(parts, k=rng.randrange(0, 30))))


def test_every_kind_of_code_point(library, own):
    for cp in [*range(0, 0x3000), *range(0x3000, 0x110000, 97)]:
        if not 0xD800 <= cp < 0xE000:
            check(library, own, f"a1 {chr(cp)}b{chr(cp)}2 {chr(cp)}")


def test_long_pieces(library, own):
    for text in ("a" * 60000, " " * 20000 + "x", "é" * 20000, "ab1" * 20000, "!" * 30000):
        check(library, own, text)


def test_documents(spark, library):
    text = "One text, twice. <|endoftext|> Ünï"
    rows = [(1, text), (1, text), (None, text), (2, None), (3, ""), (4, "word " * 100_000)]
    got = bpe.digests(bpe.encode_decode(docs(spark, rows, extra=True), VOCABULARY)).collect()
    n = len(library.encode(text, add_special_tokens=False).ids)
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in got) == [(0, n), (1, n), (1, n), (2, 0), (3, 0), (4, 100_001)]
    assert bpe.encode_decode(docs(spark, []), VOCABULARY).count() == 0
