"""Token counts against the library on whole texts."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillroll.llm import tokens

PATH = public_tokenizers.path(tokens.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(4)
    words = ["isn't", "Hello", "wörld", "42", "x1y2", "<|endoftext|>", "a<|startoftext|>b", "...!",
             "日本語", "é", "́", "don't", "İ", "Σας", " ", "\x1c", "\xa0", "　a"]
    made = ["", " ", "\n\t", "a", "a" * 3000, "é" * 900, "日" * 700, "<|endoftext|>" * 50]
    for n in (5, 100, 900):
        for gap in (" ", "\n", "", "  \t "):
            made.append(gap.join(rng.choices(words, k=n)))
    return made


def test_long_texts_by_small_chunks(library):
    counter = tokens.Counter(PATH, chunk=64, overlap=8, agree=4)
    for text in texts():
        assert counter.long(text) == len(library.encode(text, add_special_tokens=False)), text[:80]
    assert counter.widened  # overlaps without a stable boundary were met


def test_columns_and_odd_rows(spark, library):
    rows = [(i, t, "x", 5) for i, t in enumerate(texts())] + [(3, None, "y", 6), (None, "a b", "z", 7)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, data string, n_tokens_ int")
    for chunk in (50, 100_000):
        made = tokens.with_tokens(frame, chunk=chunk, overlap=8)
        assert made.columns == [*frame.columns, "n_tokens"]
    got = sorted((tuple(r) for r in tokens.token_counts(frame, limit=20).collect()), key=repr)
    want = []
    for i, t, _, _ in rows:
        n = len(library.encode(t or "", add_special_tokens=False))
        want.append((i, len((t or "").encode()), n, n > 20))
    assert got == sorted(want, key=repr)
    assert tokens.token_counts(frame.limit(0)).count() == 0


def test_vocabularies_without_parted_words(spark):
    """Whether words may be counted one by one is read from the vocabulary."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    other = Tokenizer.from_file(path)
    assert tokens.Counter(PATH).by_word and not tokens.Counter(path).by_word
    rows = [(i, t) for i, t in enumerate(texts())]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for chunk in (200, 100_000):
        got = tokens.with_tokens(frame, vocabulary=path, chunk=chunk, overlap=16).collect()
        assert {r.doc_id: r.n_tokens for r in got} == {
            i: len(other.encode(t, add_special_tokens=False)) for i, t in rows}


def test_what_parts_words():
    plain = {"pre_tokenizer": {"type": "WhitespaceSplit"}, "normalizer": None, "added_tokens": []}
    assert tokens.counts_by_word(plain)
    for change in ({"pre_tokenizer": None}, {"pre_tokenizer": {"type": "ByteLevel"}},
                   {"normalizer": {"type": "Replace", "pattern": {"String": " "}, "content": "_"}},
                   {"added_tokens": [{"content": "<a b>"}]},
                   {"pre_tokenizer": {"type": "Split", "behavior": "Removed", "invert": True,
                                      "pattern": {"Regex": r" ?\p{L}+|\S"}}}):
        assert not tokens.counts_by_word({**plain, **change}), change
