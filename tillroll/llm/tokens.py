"""Operator 4: token counts of whole texts, huge ones by overlap resynchronisation.

A text of up to ``chunk`` characters is counted at once.  Where white space always
parts tokens (the vocabulary's splitter drops it, and
neither composition, lower-casing nor a special string reaches across it),
the count of such a text is the sum over its words, and the library encodes
each different word once.  The vocabulary is looked at for that; with any other one the
library encodes the text as a whole.

A longer text is encoded in chunks that overlap, with offsets.  Two
neighbouring encodings are spliced at a boundary in their overlap that is shown
to be stable: a white-space character over which neither encoding has a token,
with the same tokens (ids and places) in both for ``agree`` tokens or up to
the overlap's end on the left, and on the right up to there.  If none is found,
the overlap is doubled, and doubled again, until one is found or the text ends.
No more than a chunk and its overlap are encoded at a time, but for a stretch
without any white space, which can only be encoded as a whole.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import bounded, unused, utf8

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
CHUNK = 32_768
OVERLAP = 512
AGREE = 8
# Words whose counts a worker remembers at a time, and texts counted together.
MEMO_WORDS = 400_000
_TOGETHER = 64


# Splitters that drop white space, and normalisers that work within words.
_SPLITTERS = frozenset(["Whitespace", "WhitespaceSplit", "BertPreTokenizer"])
_WITHIN_WORDS = frozenset(
    ["NFC", "NFD", "NFKC", "NFKD", "Lowercase", "StripAccents", "BertNormalizer"])
# Texts on which a pattern shows whether its matches reach over white space.
_PROBES = [f"{a}{gap}{b}" for gap in (" ", "  ", "\t", "\n", "\r\n") for a in ("a", "7", "!", "'s", "é", "")
           for b in ("b", "8", "?", "'ll", "日", "")]


def _drops_space(step: dict) -> bool:
    """Whether a splitter drops white space and parts the text there."""
    if step["type"] != "Split":
        return step["type"] in _SPLITTERS
    pattern = step["pattern"].get("Regex")
    return (step["behavior"] == "Removed" and step["invert"] and pattern is not None
            and not any(c.isspace() for text in _PROBES
                        for m in regex.finditer(pattern, text) for c in m[0]))


def _within_words(step: dict) -> bool:
    """Whether a normaliser changes words one by one, and white space only to white space."""
    if step["type"] == "Replace":
        return step["pattern"] == {"Regex": r"\s+"} and step["content"].isspace()
    return step["type"] in _WITHIN_WORDS


def counts_by_word(spec: dict) -> bool:
    """Whether a text has as many tokens as its words, told by a tokenizers file's content."""

    def steps(part: dict | None, inner: str) -> list[dict]:
        if part is None:
            return []
        return [s for p in part[inner] for s in steps(p, inner)] if part["type"] == "Sequence" else [part]

    splitters = steps(spec.get("pre_tokenizer"), "pretokenizers")
    return (bool(splitters) and _drops_space(splitters[0])
            and all(map(_within_words, steps(spec.get("normalizer"), "normalizers")))
            and not any(c.isspace() for t in spec.get("added_tokens") or () for c in t["content"]))


class Counter:
    """Counts tokens with one vocabulary."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP,
                 agree: int = AGREE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.by_word = counts_by_word(json.loads(self.library.to_str()))
        self.chunk, self.overlap, self.agree = chunk, overlap, agree
        self.memo: dict[bytes, int] = {}
        self.widened = 0

    def short(self, texts: list[bytes]) -> list[int]:
        """Counts of texts of at most a chunk."""
        if not self.by_word:
            return [len(found) for found in self.library.encode_batch_fast(
                [t.decode() for t in texts], add_special_tokens=False)]
        words = [t.split() for t in texts]
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        memo = self.memo
        new = list({w for each in words for w in each if w not in memo})
        for word, found in zip(new, self.library.encode_batch_fast(
                [w.decode() for w in new], add_special_tokens=False), strict=True):
            memo[word] = len(found)
        return [sum(map(memo.__getitem__, each)) for each in words]

    def _encode(self, text: str) -> tuple[list[int], list[tuple[int, int]]]:
        found = self.library.encode(text, add_special_tokens=False)
        return found.ids, found.offsets

    def _boundary(self, text: str, left, right, low: int, high: int) -> tuple[int, int] | None:
        """Tokens of ``left`` before, and of ``right`` before, a stable boundary.

        ``left`` and ``right`` are (start, ids, offsets) of neighbouring chunks
        that share text[low:high].
        """

        def inside(part) -> list[tuple[int, int, int, int]]:
            start, ids, offsets = part
            return [(start + a, start + b, token, i)
                    for i, ((a, b), token) in enumerate(zip(offsets, ids, strict=True))
                    if start + b > low and start + a < high]

        ours, theirs = inside(left), inside(right)
        places = {(a, b, token): k for k, (a, b, token, _) in enumerate(ours)}
        best = None
        for k, (a, b, token, i) in enumerate(theirs):
            other = places.get((a, b, token))
            if other is None or a <= low or not text[a - 1].isspace():
                continue
            before = min(self.agree, k, other)
            same = all(ours[other - n][:3] == theirs[k - n][:3] for n in range(1, before + 1))
            after = min(self.agree, len(theirs) - k, len(ours) - other)
            same = same and all(
                ours[other + n][:3] == theirs[k + n][:3] for n in range(after))
            # The first and last tokens of the overlap may be cut: some must agree.
            if same and before + after >= self.agree and before and after > 1:
                middle = abs(a - (low + high) / 2)
                if best is None or middle < best[0]:
                    best = (middle, ours[other][3], i)
        return best and best[1:]

    def long(self, text: str) -> int:
        """The count of a text of any length, at most a chunk and overlap at a time."""
        end = min(len(text), self.chunk)
        left = (0, *self._encode(text[:end]))
        skipped = total = 0
        overlap = self.overlap
        while end < len(text):
            low = max(left[0], end - overlap)
            stop = min(len(text), low + self.chunk + overlap)
            right = (low, *self._encode(text[low:stop]))
            found = self._boundary(text, left, right, low, end)
            if found is None:
                self.widened += 1
                if low > left[0]:
                    overlap *= 2
                    continue
                # The whole left chunk is no overlap enough: take it up whole.
                stop = min(len(text), end + (end - left[0]))
                left, end = (left[0], *self._encode(text[left[0]:stop])), stop
                continue
            total += found[0] - skipped
            left, end, skipped, overlap = right, stop, found[1], self.overlap
        return total + len(left[1]) - skipped


def with_tokens(df: DataFrame, text: str = "text", name: str = "n_tokens",
                vocabulary: str | None = None, chunk: int = CHUNK,
                overlap: int = OVERLAP) -> DataFrame:
    """``df`` with the token counts of its texts; a null text has none.

    The count is the library's for the whole text, without added special
    tokens, truncation or padding; special strings inside a text count as the
    library takes them.  ``vocabulary`` is the path of a tokenizers file.
    """
    bounded(df.sparkSession)
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    (data,) = unused(df, "data")
    schema = df.withColumn(name, F.lit(0).cast("bigint")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path, chunk, overlap)
        for batch in batches:
            at = batch.schema.get_field_index(data)
            texts, made = batch.column(at), []
            for first in range(0, len(texts), _TOGETHER):
                some = [t.as_py() for t in texts[first:first + _TOGETHER]]
                short = iter(counter.short([t for t in some if len(t) <= chunk]))
                made += [next(short) if len(t) <= chunk else counter.long(t.decode())
                         for t in some]
            rest = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in rest] + [pa.array(made, pa.int64())],
                names=[batch.schema.names[i] for i in rest] + [name])

    return df.withColumn(data, utf8(text)).mapInArrow(run, schema)


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """Per document its bytes, tokens and whether it has more tokens than ``limit``.

    Null and empty texts count zero; repeated rows stay; other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length(utf8("text")).cast("bigint"))
    return with_tokens(rows).selectExpr(
        "doc_id", "n_bytes", "n_tokens", f"n_tokens > {int(limit)} AS over_limit")
