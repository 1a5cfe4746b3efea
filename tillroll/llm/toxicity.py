"""Operator 10: severity grades of toxic text by cumulative-link regression.

The grades 0 (clean) to ``TOP`` are ordered: P(grade <= k) = s(t_k - w x) with
one weight vector w for all thresholds t_0 < t_1 < ...  The features x are
sparse: for each term that tells toxic from clean documents, its count beyond what clean
text of that length has.  The result is the expected severity, the sum of k * P(grade = k).

Terms are words, and the beginnings of longer words, so that other forms of a word tell as
well.  They are tested over all rows and within each language, since a word of a
language with few rows tells little over all of them.  A row counts once with its
near copies, so a few copied documents make no term.

Labels say toxic or not.  The grades of the toxic ones come from how often
they use telling terms: the thirds of these counts are grades 1, 2 and 3, and a
toxic row without any has grade 1.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.workspace import stored
from tillroll.llm.common import bounded, unused, utf8, word_blocks
from tillroll.llm.simhash import shingle_hashes

TOP = 3
# Labelled rows of each kind that the model is fitted on at most, by id hash.
FIT_TOXIC = 3_000
FIT_CLEAN = 6_000
# Telling terms at most.
TERMS = 1_000
# A term tells if its log-likelihood ratio against the clean rows is this high (by
# chance in one of two thousand) and it is in so many toxic rows that are no near copies.
MIN_RATIO = 12.0
MIN_ROWS = 3
# Characters of a word's beginning, and the count of a term that tells most.
BEGINNING = 5
MOST = 8.0
# Words of a shingle by which copies are told.
COPY_SHINGLE = 5
# Rejected from this probability of any severity on: labels miss some toxic rows.
REJECT = 0.35
_EDGES = b".,;:!?\"'()[]{}<>*#$%&|-_"
# Terms whose weights a worker remembers at a time.
_MEMO = 500_000


def terms_of(word: bytes) -> tuple[bytes, ...]:
    """The terms of a word of a lower-cased text: itself without marks at its edges, and its
    beginning if it is longer.  A byte that no text has tells beginnings from words."""
    term = word.strip(_EDGES)
    if not term:
        return ()
    letters = term.decode()
    if len(letters) <= BEGINNING:
        return (term,)
    return term, b"\xff" + letters[:BEGINNING].encode()


def lowered(data: bytes) -> bytes:
    return data.decode().lower().encode()


def term_counts(data: bytes) -> tuple[dict[bytes, int], int]:
    """The terms of a text with their counts, and the number of its words."""
    counts: Counter[bytes] = Counter()
    for words in word_blocks(lowered(data)):
        counts.update(words)
    terms: dict[bytes, int] = {}
    for word, n in counts.items():
        for term in terms_of(word):
            terms[term] = terms.get(term, 0) + n
    return terms, sum(counts.values())


def copy_key(data: bytes) -> int:
    """The least shingle hash: mostly the same for near copies, always for copies."""
    low = min((int(h.min()) for h in shingle_hashes(data.lower(), COPY_SHINGLE)), default=0)
    return low - (1 << 64) if low >> 63 else low


def feature(count: int, words: int, share: float) -> float:
    """A term's count beyond the one that a clean text of so many words has."""
    return min(MOST, max(0.0, count - words * share))


@dataclass
class Severity:
    """Terms with their weights and their share of the words of clean texts, and the
    ordered thresholds."""

    weights: dict[bytes, float]
    shares: dict[bytes, float]
    thresholds: np.ndarray

    def score(self, counts: dict[bytes, int], words: int) -> float:
        """Weighted sum of the features of a text's telling terms."""
        return sum(self.weights[t] * feature(n, words, self.shares[t])
                   for t, n in sorted(counts.items()))

    def grades(self, scores: np.ndarray) -> np.ndarray:
        """Probability of each grade (columns) for each score (rows)."""
        below = 1 / (1 + np.exp(np.clip(scores[:, None] - self.thresholds[None, :], -50, 50)))
        full = np.hstack([np.zeros((len(scores), 1)), below, np.ones((len(scores), 1))])
        return np.diff(full, axis=1)


def telling_terms(bags: DataFrame) -> list[bytes]:
    """Terms of stored rows (toxic, copy, lang, terms) found in clearly more toxic than
    clean rows, by the G test over all rows and within each language.

    At most ``TERMS`` of them reach the driver: the best of each language, then
    the second ones and so on.
    """
    scoped = bags.selectExpr(
        "copy", "toxic > 0 AS bad", "terms",
        "explode(IF(lang IS NULL, array(''), array('', concat('=', lang)))) AS scope")
    sizes = scoped.groupBy("scope").agg(
        F.expr("count(DISTINCT IF(bad, copy, NULL))").alias("n_toxic"),
        F.expr("count(DISTINCT IF(bad, NULL, copy))").alias("n_clean"),
    ).where("n_toxic > 0 AND n_clean > 0")
    share = "((a + c) / CAST(n_toxic + n_clean AS double))"

    def part(count: str, expected: str) -> str:
        return f"IF({count} > 0, {count} * ln({count} / ({expected})), 0D)"

    ratio = " + ".join([
        part("a", f"n_toxic * {share}"), part("c", f"n_clean * {share}"),
        part("(n_toxic - a)", f"n_toxic * (1 - {share})"),
        part("(n_clean - c)", f"n_clean * (1 - {share})")])
    best = Window.partitionBy("scope").orderBy(F.desc("ratio"), "term")
    found = (
        scoped.selectExpr("scope", "copy", "bad", "explode(terms) AS term").distinct()
        .groupBy("scope", "term")
        .agg(F.expr("count_if(bad) AS a"), F.expr("count_if(NOT bad) AS c"))
        .where(f"a >= {MIN_ROWS}").join(sizes, "scope").where("a * n_clean > c * n_toxic")
        .selectExpr("scope", "term", f"2 * ({ratio}) AS ratio").where(f"ratio >= {MIN_RATIO}")
        .withColumn("place", F.row_number().over(best))
        .groupBy("term").agg(F.min("place").alias("place"), F.max("ratio").alias("ratio"))
        .orderBy("place", F.desc("ratio"), "term").limit(TERMS).collect())
    return sorted(bytes(r.term) for r in found)


def fit_ordinal(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grade: np.ndarray,
                width: int, n_grades: int, ridge: float = 1.0, steps: int = 800,
                rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of the proportional-odds model.

    ``rows, columns, values`` hold the sparse features.  Adam on the mean
    negative log likelihood; the thresholds are a first one plus exponentials,
    so they stay in order.
    """
    n = len(grade)
    parameters = np.zeros(width + n_grades - 1)
    share = np.clip((grade == 0).mean(), 0.01, 0.99)
    parameters[width] = np.log(share / (1 - share))
    first = np.zeros_like(parameters)
    second = np.zeros_like(parameters)
    for step in range(1, steps + 1):
        w, free = parameters[:width], parameters[width:]
        gaps = np.exp(np.clip(free[1:], -8, 5))
        cut = np.concatenate([[free[0]], free[0] + np.cumsum(gaps)])
        score = np.bincount(rows, values * w[columns], n)
        edges = np.concatenate([[-np.inf], cut, [np.inf]])
        upper = 1 / (1 + np.exp(-np.clip(edges[grade + 1] - score, -30, 30)))
        lower = 1 / (1 + np.exp(-np.clip(edges[grade] - score, -30, 30)))
        upper[grade == n_grades - 1], lower[grade == 0] = 1.0, 0.0
        p = np.maximum(upper - lower, 1e-9)
        du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p
        g_w = np.bincount(columns, values * (du - dl)[rows], width) / n + ridge * w / n
        g_cut = np.array([-(du[grade == k].sum() - dl[grade == k + 1].sum())
                          for k in range(n_grades - 1)]) / n
        tail = np.cumsum(g_cut[::-1])[::-1]
        gradient = np.concatenate([g_w, [tail[0]], tail[1:] * gaps])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient ** 2
        parameters -= rate * (first / (1 - 0.9 ** step)) / (
            np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    free = parameters[width:]
    cut = np.concatenate([[free[0]], free[0] + np.cumsum(np.exp(np.clip(free[1:], -8, 5)))])
    return parameters[:width], cut


def fit(rows: list[tuple[dict[bytes, int], int, str | None, bool]], terms: list[bytes],
        top: int = TOP) -> Severity | None:
    """The model from (counts of telling terms, words, language, toxic) rows; None if no
    toxic row has any.

    A term's share of clean words is that of the language where it is largest.
    """
    clean: Counter[str | None] = Counter()
    held: Counter[tuple[bytes, str | None]] = Counter()
    for counts, words, lang, toxic in rows:
        if not toxic:
            clean[lang] += words
            held.update({(t, lang): n for t, n in counts.items()})
    shares = {t: max((held[t, lang] / max(1, n) for lang, n in clean.items()), default=0.0)
              for t in terms}
    place = {t: i for i, t in enumerate(terms)}
    at, column, value = [], [], []
    used = np.zeros(len(rows))
    for i, (counts, words, _, _) in enumerate(rows):
        for term, n in sorted(counts.items()):
            if (x := feature(n, words, shares[term])) > 0:
                at.append(i)
                column.append(place[term])
                value.append(x)
                used[i] += x
    toxic = np.array([r[3] for r in rows], dtype=bool)
    if not (toxic & (used > 0)).any():
        return None
    cuts = np.quantile(used[toxic & (used > 0)], np.arange(1, top) / top)
    grade = np.where(toxic, 1 + np.searchsorted(cuts, used, side="left"), 0)
    weights, thresholds = fit_ordinal(np.array(at), np.array(column), np.array(value), grade,
                                      len(terms), top + 1)
    return Severity(dict(zip(terms, weights.tolist(), strict=True)), shares, thresholds)


def fit_on_labels(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id",
                  text: str = "text", lang: str = "lang") -> Severity | None:
    """The model from at most ``FIT_TOXIC`` + ``FIT_CLEAN`` labelled documents.

    Those of the smallest id hash of each kind are taken; of several labels of
    a document the highest counts.  The chosen ids, of which there are at most
    that many, are broadcast, so texts are not shuffled.  Without a column ``lang``
    all rows count as one language.
    """
    bounded(docs.sparkSession)
    known = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id")
             .agg(F.max("toxic").alias("toxic")).withColumn("h", F.xxhash64("doc_id")))
    # Only labels of documents at hand: their ids are read, not their texts.
    known = known.join(docs.select(F.col(doc_id).alias("doc_id")).distinct(), "doc_id")
    chosen = [known.where(c).orderBy("h", "doc_id").limit(n).select("doc_id", "toxic")
              for c, n in (("toxic > 0", FIT_TOXIC), ("toxic <= 0", FIT_CLEAN))]
    language = F.col(lang).cast("string") if lang in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col(doc_id).alias("doc_id"), language.alias("lang"),
                       utf8(text).alias("data")).join(
        F.broadcast(chosen[0].union(chosen[1])), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.as_py() for x in batch.column("data")]
            made = [term_counts(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"),
                 pa.array([copy_key(t) for t in texts], pa.int64()), batch.column("lang"),
                 pa.array([n for _, n in made], pa.int64()),
                 pa.array([list(m) for m, _ in made], pa.list_(pa.binary())),
                 pa.array([list(m.values()) for m, _ in made], pa.list_(pa.int32()))],
                names=["doc_id", "toxic", "copy", "lang", "words", "terms", "counts"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    toxic_type = rows.schema["toxic"].dataType.simpleString()
    schema = (f"doc_id {id_type}, toxic {toxic_type}, lang string, words bigint, "
              "terms array<binary>, counts array<int>")
    told = schema.replace("lang", "copy bigint, lang", 1)
    bags = stored(rows.mapInArrow(run, told).dropDuplicates(["doc_id"]), "bags")
    terms = telling_terms(bags)
    wanted = frozenset(terms)

    def telling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[(t, n) for t, n in zip(terms, counts, strict=True) if t in wanted]
                    for terms, counts in zip(batch.column("terms").to_pylist(),
                                             batch.column("counts").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "toxic", "lang", "words")),
                 pa.array([[t for t, _ in r] for r in rows], pa.list_(pa.binary())),
                 pa.array([[n for _, n in r] for r in rows], pa.list_(pa.int32()))],
                names=["doc_id", "toxic", "lang", "words", "terms", "counts"])

    sample = [({bytes(t): n for t, n in zip(r.terms, r.counts, strict=True)}, r.words, r.lang,
               r.toxic > 0)
              for r in bags.mapInArrow(telling, schema).orderBy("doc_id").collect()]
    return fit(sample, terms)


def with_severity(df: DataFrame, model: Severity | None, text: str = "text",
                  severity: str = "expected_severity", toxic: str = "toxic") -> DataFrame:
    """``df`` with the expected severity and whether P(grade >= 1) >= ``REJECT``.

    Null and empty texts have no terms and get the score of a text without any
    telling term.  Without a model every severity is 0.
    """
    bounded(df.sparkSession)
    (data,) = unused(df, "data")
    schema = (df.withColumn(severity, F.lit(0.0)).withColumn(toxic, F.lit(False))).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.weights if model else {}
        memo: dict[bytes, tuple[bytes, ...]] = {}

        def score(text: bytes) -> float:
            counts: dict[bytes, int] = {}
            total = 0
            for words in word_blocks(lowered(text)):
                total += len(words)
                for word in words:
                    try:
                        found = memo[word]
                    except KeyError:
                        if len(memo) >= _MEMO:
                            memo.clear()
                        found = memo[word] = tuple(t for t in terms_of(word) if t in weights)
                    for term in found:
                        counts[term] = counts.get(term, 0) + 1
            return model.score(counts, total)

        for batch in batches:
            at = batch.schema.get_field_index(data)
            if model:
                p = model.grades(np.array([score(x.as_py()) for x in batch.column(at)], float))
                expected = p @ np.arange(p.shape[1])
                is_toxic = 1 - p[:, 0] >= REJECT
            else:
                expected = np.zeros(batch.num_rows)
                is_toxic = np.zeros(batch.num_rows, dtype=bool)
            rest = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in rest] + [pa.array(expected), pa.array(is_toxic)],
                names=[batch.schema.names[i] for i in rest] + [severity, toxic])

    return df.withColumn(data, utf8(text)).mapInArrow(run, schema)


def severities(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id",
               text: str = "text") -> DataFrame:
    """Per document its expected severity and verdict.

    Null and empty texts have the severity of a text without telling terms; repeated rows
    stay and are judged alike; texts are read whole, at any length; without labels of both
    kinds nothing is toxic; an empty table stays empty.  Of documents with one id, and of terms
    that tell equally, the order of ids and terms decides.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    scored = with_severity(rows, fit_on_labels(docs, labels, doc_id, text))
    return scored.select("doc_id", "expected_severity", "toxic")


def without_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """The documents that are not rejected, with all their columns; odd rows as in
    ``severities``."""
    severity, toxic = unused(docs, "severity", "toxic")
    model = fit_on_labels(docs, labels, doc_id, text)
    scored = with_severity(docs, model, text, severity, toxic)
    return scored.where(f"NOT `{toxic}`").select(*[F.col(f"`{c}`") for c in docs.columns])
