r"""Operator 12: URL filters by rules and by a ratio of character language models.

Rules of host and path decide where one fits, the longest first.  All other URLs are judged
by two variable-order Markov models over bytes, of the URLs that rules accept and of those
that they reject.  A symbol's probability is blended from the empty context up to the
longest context that the model has seen, ``ORDER`` bytes at most:

    p_k = (count(context_k symbol) + BLEND * p_(k-1)) / (count(context_k) + BLEND)

The score is the difference of the two log-likelihoods for each symbol.  The limit is
calibrated on scores that are not of the model's own rows: hosts are dealt to two halves, each
scored by the models of the other, and the limit is the bin edge with the least balanced error.

Counts are over all ruled URLs, and all of them are used.  What is broadcast are the sequences
that make up at least one in ``SENT`` of all URLs' symbols, so at most (``ORDER`` + 1) * ``SENT``
of them at any size of the input.  The counts of rarer sequences are joined to the URLs that
hold them, none of which is held by more than that share.  A caller may set ``KEPT`` to leave
sequences below one in ``KEPT`` of the ruled symbols to their shorter contexts; None leaves none.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.workspace import stored
from tillroll.llm.common import bounded, unused, utf8

# Action, host and path of the rules.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
ORDER = 5
BLEND = 1.0
KEPT: int | None = None
SENT = 1 << 18
# Bins of the scores for each unit, and bins on each side of zero.
BINS = 256
SIDE = 2048

# A URL is read as a start, its bytes and an end: 258 symbols, 9 bits each.
_START, _END, _SHIFT, _BITS = 0, 1, 2, 9
_SYMBOLS = 257
# Kinds of URLs: accepted ones of either half, rejected ones of either half, those without a rule.
_KINDS = 5
_UNRULED = 4
# Symbols that are looked at together, and counted sequences that a task holds, about.
_PIECE = 1 << 16
_HELD = 1 << 21

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: str | Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` and for null."""
    url = F.col(url) if isinstance(url, str) else url
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return (F.coalesce(F.translate(host, _UPPER, _UPPER.lower()), F.lit("")),
            F.coalesce(path, F.lit("")))


def first_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits, null without one.

    Of rules of equal length the one with the longer host wins, then the one listed first.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1])))
    found = None
    for action, where, start in ordered:
        fits = ((host == where) | host.endswith(f".{where}")) & path.startswith(start)
        value = F.struct(F.lit(where + start).alias("rule"), F.lit(action).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return F.lit(None).cast("struct<rule: string, verdict: string>") if found is None else found


def _laid_out(urls: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All symbols in a row, the place of each in its URL, and the URLs' first symbols."""
    first = np.cumsum([0, *(len(u) + 2 for u in urls)])
    seq = np.empty(first[-1], dtype=np.uint16)
    seq[first[:-1]], seq[first[1:] - 1] = _START, _END
    inner = np.ones(len(seq), dtype=bool)
    inner[first[:-1]] = inner[first[1:] - 1] = False
    seq[inner] = np.frombuffer(b"".join(urls).lower(), dtype=np.uint8).astype(np.uint16) + _SHIFT
    place = np.arange(len(seq)) - np.repeat(first[:-1], np.diff(first))
    return seq, place, first[:-1]


def _pieces(urls: Sequence[bytes]) -> Iterator[tuple[list[np.ndarray], np.ndarray, int, int]]:
    """Codes of the sequences of 1, 2, ... symbols that end at each place, a bounded piece at a
    time: (codes, places, symbols at the front that belong to the piece before, first symbol)."""
    seq, place, _ = _laid_out(urls)
    for low in range(0, len(seq), _PIECE):
        start = max(0, low - ORDER)
        some = seq[start:low + _PIECE].astype(np.int64)
        codes, code = [], np.zeros(len(some), dtype=np.int64)
        for n in range(min(ORDER + 1, len(some))):
            code[n:] += some[:len(some) - n] << (_BITS * n)
            codes.append(code + ((n + 1) << (_BITS * (ORDER + 1))))
        yield codes, place[start:low + _PIECE], low - start, low


def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(code, kind, n): how often each sequence ends somewhere in the URLs (data, kind) of a task.

    Sequences are folded as they come; a task that holds many passes them on early.
    """
    held, size = [], 0

    def fold() -> list[tuple[np.ndarray, np.ndarray]]:
        keys = np.concatenate([k for k, _ in held])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], np.concatenate([c for _, c in held])[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        return [(keys[first], np.add.reduceat(counts, first))]

    def rows() -> pa.RecordBatch:
        keys, counts = held[0]
        return pa.RecordBatch.from_arrays(
            [pa.array(keys >> 3), pa.array((keys & 7).astype(np.int32)), pa.array(counts)],
            names=["code", "kind", "n"])

    for batch in batches:
        kinds = batch.column("kind").to_numpy(zero_copy_only=False)
        urls = batch.column("data").to_pylist()
        for kind in range(_KINDS):
            for codes, place, skip, _ in _pieces([urls[i] for i in np.flatnonzero(kinds == kind)]):
                for n, code in enumerate(codes):
                    keys, counts = np.unique(code[skip:][place[skip:] >= n], return_counts=True)
                    held.append((keys << 3 | kind, counts.astype(np.int64)))
                    size += len(keys)
            if size > _HELD:
                held = fold()
                size = len(held[0][0])
                if size > _HELD // 2:
                    yield rows()
                    held, size = [], 0
    if held:
        held = fold()
        yield rows()


class Models(NamedTuple):
    """Sorted codes of frequent sequences, and for each its counts by kind: accepted URLs of either
    half, rejected ones of either half; the number of symbols of each kind; and the other sequences
    as rows (code, n0, n1, n2, n3)."""

    codes: np.ndarray
    counts: np.ndarray
    totals: np.ndarray
    rest: DataFrame | None = None

    def scores(self, urls: Sequence[bytes], halves: Sequence[int], others: Models) -> np.ndarray:
        """Difference of the log-likelihoods by the models of these halves, for each symbol.
        ``others`` has those of the other sequences that the URLs hold."""
        seq, _, first = _laid_out(urls)
        made = np.zeros(len(seq))
        for codes, place, skip, low in _pieces(urls):
            found = [self._found(c) + others._found(c) for c in codes]
            logs = [self._logs([f[:, kinds].sum(axis=1) for f in found],
                               float(self.totals[kinds].sum()), place)
                    for kinds in ([h for h in halves], [2 + h for h in halves])]
            made[low:low + len(place) - skip] = (logs[0] - logs[1])[skip:]
        sums = np.add.reduceat(made, first) if len(first) else np.empty(0)
        # The start is given, not predicted.
        return sums / np.array([len(u) + 1 for u in urls])

    def missing(self, urls: Sequence[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places of URLs, codes) of the URLs' sequences that are not among these codes, once
        for each URL and piece."""
        owner = np.repeat(np.arange(len(urls)), [len(u) + 2 for u in urls])
        for codes, place, skip, low in _pieces(urls):
            own = owner[low:low + len(place) - skip]
            found = []
            for n, code in enumerate(codes):
                code = code[skip:]
                at = (place[skip:] >= n) & ~self._known(code)
                found.append(np.stack([own[at], code[at]]))
            pairs = np.concatenate(found, axis=1)
            pairs = pairs[:, np.lexsort(pairs)]
            twice = np.append(False, (pairs[:, 1:] == pairs[:, :-1]).all(axis=0))
            pairs = pairs[:, ~twice[:pairs.shape[1]]]
            yield pairs[0], pairs[1]

    def _known(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return np.zeros(len(codes), dtype=bool)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return self.codes[at] == codes

    def _found(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return np.zeros((len(codes), 4))
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return self.counts[at] * (self.codes[at] == codes)[:, None]

    @staticmethod
    def _logs(counts: list[np.ndarray], total: float, place: np.ndarray) -> np.ndarray:
        p = (counts[0] + BLEND / _SYMBOLS) / (total + BLEND)
        for n in range(1, len(counts)):
            before = np.concatenate([[0], counts[n - 1][:-1]])
            p = np.where(place >= n, (counts[n] + BLEND * p) / (before + BLEND), p)
        return np.where(place > 0, np.log(p), 0.0)


def models(urls: DataFrame) -> Models:
    """The models of all rows (data, kind); what of them is not ``rest`` is bounded, see above."""
    found = urls.mapInArrow(sequences, "code bigint, kind int, n bigint").groupBy("code").agg(
        F.sum("n").alias("n"),
        *[F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"n{k}")
          for k in range(4)])
    found = stored(found, "sequences")
    single = found.where(f"code DIV {1 << _BITS * (ORDER + 1)} = 1 AND "
                         f"code % {1 << _BITS} <> {_START}")
    symbols, *totals = single.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c)
                                    for c in found.columns[1:]]).first()
    if KEPT is not None:
        found = found.where(f"(n0 + n1 + n2 + n3) * {KEPT} >= {sum(totals)}")
    table = found.where(f"n * {SENT} >= {symbols}").drop("n").orderBy("code").toArrow()
    # Of the others only those that a rule's URL has: the rest count nothing anyway.
    rest = found.where(f"n * {SENT} < {symbols} AND n0 + n1 + n2 + n3 > 0").drop("n")
    return Models(*_columns(table), np.array(totals, dtype=np.int64), rest)


def _columns(table: pa.Table | pa.StructArray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts by kind of columns or fields (code, n0, n1, n2, n3)."""
    column = table.field if isinstance(table, pa.StructArray) else table.column
    return (np.array(column("code"), dtype=np.int64),
            np.stack([np.array(column(f"n{k}"), dtype=np.int64) for k in range(4)], axis=1))


def limit_of(bins: dict[tuple[bool, int], int]) -> float:
    """The edge of a bin with the least balanced error, of equal ones that next to zero, then
    the lower; zero where one class is missing.  ``bins``: rows by class and bin."""
    sides = [np.zeros(2 * SIDE + 1, dtype=object) for _ in range(2)]
    for (good, place), n in bins.items():
        sides[good][place + SIDE] += n
    bad, good = (s.cumsum() - s for s in sides)  # Rows below each edge.
    all_bad, all_good = sides[0].sum(), sides[1].sum()
    if not all_bad or not all_good:
        return 0.0
    right = (all_good - good) * all_bad + bad * all_good
    return min(range(len(right)), key=lambda i: (-right[i], abs(i - SIDE), i)) / BINS - SIDE / BINS


def _scored(urls: DataFrame, both: Models) -> DataFrame:
    """``urls`` (data, kind, n), no row twice, with the score of each: of a ruled URL by the
    other half's models, else by all."""
    held = urls.sparkSession.sparkContext.broadcast(both._replace(rest=None))

    def missing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("key").to_numpy()
            for at, codes in held.value.missing(batch.column("data").to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[at]), pa.array(codes)], names=["key", "code"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls = batch.column("data").to_pylist()
            kinds = batch.column("kind").to_numpy()
            codes, counts = _columns(batch.column("others").flatten())
            codes, first = np.unique(codes, return_index=True)
            others = Models(codes, counts[first], held.value.totals)
            made = np.empty(len(urls))
            for own, used in (((0, 2), [1]), ((1, 3), [0]), ((_UNRULED,), [0, 1])):
                at = np.flatnonzero(np.isin(kinds, own))
                made[at] = held.value.scores([urls[i] for i in at], used, others)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("data", "kind", "n")), pa.array(made)],
                names=["data", "kind", "n", "score"])

    # URLs of the same key share what they hold, which changes no score.
    urls = urls.withColumn("key", F.xxhash64("data"))
    asked = urls.select("key", "data").mapInArrow(missing, "key bigint, code bigint")
    # Both sides grow with the input: neither is broadcast.
    others = asked.join(both.rest.hint("merge"), "code").groupBy("key").agg(F.collect_list(
        F.struct("code", "n0", "n1", "n2", "n3")).alias("others"))
    return urls.join(others.hint("merge"), "key", "left").select(
        "data", "kind", "n", "others").mapInArrow(
        run, "data binary, kind int, n bigint, score double")


def with_verdict(df: DataFrame, url: str = "url",
                 rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule``, ``verdict`` and ``score`` of its URLs.

    Underscores are added to a name that ``df`` has already.  ``score`` is null where a rule
    decides.  Null is judged like the empty URL.  Without URLs of both classes the
    limit is zero, and without any every score is, so nothing is blocked but by rules.
    Repeated rows count and are judged alike; a score on the limit is allowed; URLs are read
    whole, at any length; an empty table stays empty.  ``df`` is read three times, and its rows are
    dealt by their URL.
    """
    bounded(df.sparkSession)
    data, kind, found, *made = unused(
        df, "data", "kind", "found", "host", "path", "rule", "verdict", "score")
    host, path, rule, verdict, score = made
    where, start = host_and_path(url)
    judged = df.withColumns({host: where, path: start})
    judged = judged.withColumn(found, first_rule(F.col(host), F.col(path), rules))
    judged = judged.select(*[F.col(f"`{c}`") for c in df.columns], host, path,
                           F.col(found)["rule"].alias(rule), F.col(found)["verdict"].alias(verdict))
    # Half a host belongs to: whether the first digit of its hash is odd.
    odd = F.conv(F.substring(F.md5(host), 1, 1), 16, 10).cast("int") % 2
    judged = judged.withColumns({data: utf8(url), kind: F.when(F.col(rule).isNull(), _UNRULED).otherwise(
        odd + F.when(F.col(verdict) == "allow", 0).otherwise(2))})
    urls = judged.select(F.col(data).alias("data"), F.col(kind).alias("kind"))
    both = models(urls)

    # Of ruled URLs only those whose other half has rows of both classes.
    usable = [h for h in (0, 1) if both.totals[1 - h] and both.totals[3 - h]]
    urls = urls.where(F.col("kind").isin(_UNRULED, *usable, *[h + 2 for h in usable]))
    urls = stored(urls.groupBy("data", "kind").agg(F.count("*").alias("n")), "urls")
    scored = stored(_scored(urls, both), "scores")
    bins = scored.where(f"kind <> {_UNRULED}").selectExpr(
        "kind < 2 AS good", f"CAST(greatest(-{SIDE}, least({SIDE}, floor(score * {BINS}))) AS int) AS bin",
        "n")
    limit = limit_of({(r.good, r.bin): r.n
                      for r in bins.groupBy("good", "bin").agg(F.sum("n").alias("n")).collect()})

    free = scored.where(f"kind = {_UNRULED}").select(
        F.col("data").alias(data), F.col("kind").alias(kind), F.col("score").alias(score))
    whole = judged.join(free.hint("merge"), [data, kind], "left").drop(data, kind)
    return whole.withColumn(verdict, F.coalesce(
        verdict, F.when(F.col(score) >= limit, "allow").otherwise("block")))


def url_verdicts(pages: DataFrame, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """Per page its host, path, rule, verdict and score.  Other columns are not read."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    return with_verdict(rows).select(
        "page_id", "host", "path", "rule", "verdict", F.round("score", 6).alias("score"))


def _blended(side: str) -> str:
    """SQL for the probability of a symbol, from the counts g1 to g6 and those one place before."""
    first = f"((g1{side} + 1.0 / 257) / (n{side} + 1.0))"
    return reduce(lambda p, n: f"(CASE WHEN i >= {n} THEN (g{n + 1}{side} + {p}) / (b{n}{side} + 1.0) "
                               f"ELSE {p} END)", range(1, 6), first)


ORACLE = rf"""
WITH r AS (
  SELECT page_id, coalesce(url, '') AS url, row_number() OVER () AS uid,
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
h AS (
  SELECT *, lower(regexp_extract(rest, '^[^/?#]*')) AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM r),
j AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM h),
u AS MATERIALIZED (
  SELECT *, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 1
      WHEN rule IS NOT NULL THEN 0 END AS good,
    CASE WHEN substr(md5(host), 1, 1) IN ('1', '3', '5', '7', '9', 'b', 'd', 'f') THEN 1 ELSE 0 END AS half,
    chr(2) || lower(url) || chr(3) AS s, length(url) + 1 AS n
  FROM j),
g AS MATERIALIZED (
  SELECT uid, good, half, i, l, substr(s, i - l + 2, l) AS seq
  FROM (SELECT uid, good, half, s, unnest(generate_series(0, n)) AS i FROM u) p
  CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5, 6]) AS l) o WHERE i >= l - 1),
t AS (
  SELECT coalesce(sum(n) FILTER (good = 1 AND half = 0), 0) AS a0,
    coalesce(sum(n) FILTER (good = 1 AND half = 1), 0) AS a1,
    coalesce(sum(n) FILTER (good = 0 AND half = 0), 0) AS r0,
    coalesce(sum(n) FILTER (good = 0 AND half = 1), 0) AS r1 FROM u),
c AS MATERIALIZED (
  SELECT seq, count(*) FILTER (good = 1 AND half = 0) AS a0, count(*) FILTER (good = 1 AND half = 1) AS a1,
    count(*) FILTER (good = 0 AND half = 0) AS r0, count(*) FILTER (good = 0 AND half = 1) AS r1
  FROM g WHERE good IS NOT NULL GROUP BY seq
  HAVING count(*) * 131072 >= (SELECT a0 + a1 + r0 + r1 FROM t)),
e AS (
  SELECT uid, i, l, CASE WHEN good IS NULL THEN a0 + a1 WHEN half = 0 THEN a1 ELSE a0 END AS a,
    CASE WHEN good IS NULL THEN r0 + r1 WHEN half = 0 THEN r1 ELSE r0 END AS r
  FROM g JOIN c USING (seq)),
w AS MATERIALIZED (
  SELECT uid, i, {", ".join(f"coalesce(max({s}) FILTER (l = {n}), 0) AS g{n}{s}" for n in range(1, 7) for s in "ar")}
  FROM (SELECT uid, i, l, a, r FROM e UNION ALL SELECT uid, i, 0, 0, 0 FROM g WHERE l = 1)
  GROUP BY uid, i),
q AS (
  SELECT w.*, u.n, u.good, u.half,
    {", ".join(f"b.g{n}{s} AS b{n}{s}" for n in range(1, 6) for s in "ar")},
    CASE WHEN good IS NULL THEN t.a0 + t.a1 WHEN half = 0 THEN t.a1 ELSE t.a0 END AS na,
    CASE WHEN good IS NULL THEN t.r0 + t.r1 WHEN half = 0 THEN t.r1 ELSE t.r0 END AS nr
  FROM w JOIN w b ON b.uid = w.uid AND b.i = w.i - 1 JOIN u ON u.uid = w.uid, t),
x AS MATERIALIZED (
  SELECT uid, any_value(good) AS good, bool_and(na > 0 AND nr > 0) AS usable,
    sum(ln({_blended("a")}) - ln({_blended("r")})) / any_value(n) AS score
  FROM q GROUP BY uid),
b AS (
  SELECT good, greatest(-2048, least(2048, floor(score * 256))) AS bin
  FROM x WHERE good IS NOT NULL AND usable),
m AS (
  SELECT edge, count(*) FILTER (good = 1) AS all_good, count(*) FILTER (good = 0) AS all_bad,
    count(*) FILTER (good = 1 AND bin >= edge) AS good_kept,
    count(*) FILTER (good = 0 AND bin < edge) AS bad_out
  FROM b, (SELECT unnest(generate_series(-2048, 2048)) AS edge) GROUP BY edge),
k AS (
  SELECT coalesce((SELECT edge / 256.0 FROM m WHERE all_good > 0 AND all_bad > 0
    ORDER BY good_kept * all_bad + bad_out * all_good DESC, abs(edge), edge LIMIT 1), 0.0) AS cut)
SELECT page_id, host, path, rule,
  CASE WHEN u.good = 1 THEN 'allow' WHEN u.good = 0 THEN 'block'
    WHEN score >= cut THEN 'allow' ELSE 'block' END AS verdict,
  CASE WHEN rule IS NULL THEN round(score, 6) END AS score
FROM u JOIN x USING (uid), k
"""
