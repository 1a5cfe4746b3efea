"""Operator 1: near-duplicates by SimHash and a trie self-join.

A fingerprint has one bit for each of 64 positions: set if it is set in over
half of the hashes of the text's word shingles.  Two documents are linked if
their fingerprints differ in at most ``MAX_DIFF`` bits; a component is what can
be reached over links.

The self-join runs over *distinct* fingerprints in tries: 32 bits
at once, then four levels of a byte each.  A node is a
prefix; a pair of nodes is followed to pairs of their children, the differing
bits add up, and the pair is given up as soon as they exceed the budget.  From
a single root nearly all pairs of the first levels would stay within the budget
(the join would cost n log² n), so the trie is kept in six bit orders, one for
each choice of two of the four 16-bit blocks.  At most two differing bits leave
at least two blocks equal, so in one of the orders the pair descends through the first 32 bits
without a difference: there only pairs of a node with itself are followed.  Below, pairs of
unlike nodes are followed as well.  Each level is a join of node pairs with the
nodes' children.  A node has at most 256 children a level and a fingerprint at
most 2080 others within two bits, so no group grows with the data, however many
copies a text has.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.workspace import stored
from tillroll.llm.common import bounded, unused, utf8, word_blocks

MAX_DIFF = 2
SHINGLE = 3
SEED = 42
_LEVELS = 4
_ORDERS = list(combinations(range(4), 2))


def shingle_hashes(data: bytes, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """Hashes of the word shingles of a lower-cased text, in blocks.

    Fewer words than ``width`` make one shingle of them all; none, no shingle.
    """
    carry: list[bytes] = []
    made = False
    for words in word_blocks(data):
        words = carry + words
        if len(words) >= width:
            joined = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words]) - 1
            starts = [0, *(ends[:-1] + 1).tolist()]
            digest = xxhash.xxh64_intdigest
            yield np.fromiter(
                (digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1:].tolist())),
                dtype=np.uint64, count=len(words) - width + 1)
            made = True
            carry = words[len(words) - width + 1:]
        else:
            carry = words
    if carry and not made:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(carry), SEED)], dtype=np.uint64)


def fingerprint(data: bytes) -> int:
    """The 64-bit fingerprint as a signed number; 0 for a text without words."""
    counts, total = np.zeros(64, dtype=np.int64), 0
    for hashes in shingle_hashes(data.lower()):
        for part in np.array_split(hashes, len(hashes) // 65536 + 1):
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.int64)[0])


def with_fingerprint(df: DataFrame, text: str = "text", name: str = "fp") -> DataFrame:
    """``df`` with its texts' fingerprints as a bigint column ``name``."""
    bounded(df.sparkSession)
    (data,) = unused(df, "data")
    schema = df.withColumn(name, F.lit(0).cast("bigint")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(data)
            made = pa.array([fingerprint(x.as_py()) for x in batch.column(at)], pa.int64())
            rest = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in rest] + [made],
                names=[batch.schema.names[i] for i in rest] + [name])

    return df.withColumn(data, utf8(text)).mapInArrow(run, schema)


def _trie(prints: DataFrame) -> DataFrame:
    """Leaves (o, head, tail, fp): each fingerprint in six bit orders, where
    another one has the same first 32 bits; alone below a node there is no pair."""

    def block(i: int) -> str:
        return f"(shiftrightunsigned(fp, {48 - 16 * i}) & 65535)"

    def half(blocks: tuple[int, ...]) -> str:
        return f"(shiftleft({block(blocks[0])}, 16) | {block(blocks[1])})"

    orders = []
    for n, first in enumerate(_ORDERS):
        rest = tuple(i for i in range(4) if i not in first)
        orders.append(f"struct({n} AS o, {half(first)} AS head, {half(rest)} AS tail)")
    leaves = prints.selectExpr("fp", f"explode(array({', '.join(orders)})) AS at")
    leaves = leaves.selectExpr("at.o AS o", "at.head AS head", "at.tail AS tail", "fp")
    shared = leaves.groupBy("o", "head").count().where("count > 1").select("o", "head")
    return leaves.join(shared, ["o", "head"])


def links(prints: DataFrame) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints ``fp`` within ``MAX_DIFF`` bits, each once."""
    leaves = stored(_trie(prints), "trie")
    pairs = leaves.select("o", "head").distinct().selectExpr(
        "o", "head", "0L AS pa", "0L AS pb", "0 AS diff")
    for level in range(1, _LEVELS + 1):
        last = level == _LEVELS
        shift = 32 - 8 * level
        nodes = leaves.selectExpr("o", "head", f"shiftright(tail, {shift}) AS path",
                                  *(["fp"] if last else []))
        nodes = nodes if last else nodes.distinct()
        kept = ["fp"] if last else []
        left = nodes.selectExpr("o", "head", "shiftright(path, 8) AS pa", "path AS ca",
                                *(f"{c} AS a_{c}" for c in kept))
        right = nodes.selectExpr("o", "head", "shiftright(path, 8) AS pb", "path AS cb",
                                 *(f"{c} AS b_{c}" for c in kept))
        pairs = (
            pairs.join(left, ["o", "head", "pa"]).join(right, ["o", "head", "pb"])
            .where("pa < pb OR ca <= cb")
            .withColumn("diff", F.expr("diff + bit_count((ca ^ cb) & 255)"))
            .where(f"diff <= {MAX_DIFF}")
            .selectExpr("o", "head", "ca AS pa", "cb AS pb", "diff",
                        *(f"{s}_{c}" for c in kept for s in "ab"))
        )
    return (pairs.where("pa < pb")
            .selectExpr("least(a_fp, b_fp) AS a", "greatest(a_fp, b_fp) AS b").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the edges (a, b); root: the least node reached.

    Alternates large-star and small-star steps until the edges stay the same.
    Each round is written to the shared folder, so lineage stays short.
    """
    edges = stored(edges.selectExpr("greatest(a, b) AS u", "least(a, b) AS v")
                   .where("u <> v").distinct(), "edges")
    mark = None
    while True:
        both = edges.union(edges.selectExpr("v AS u", "u AS v"))
        # The least neighbours are written before they are joined, so both sides of a join come
        # from an exchange of their own and adaptive execution can split a node of many edges.
        low = stored(both.groupBy("u").agg(F.min("v").alias("m"))
                     .selectExpr("u", "least(u, m) AS m"), "least")
        large = stored(both.join(low, "u").where("v > u").selectExpr("v AS u", "m AS v")
                       .where("u <> v").distinct(), "large")
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = (large.join(low, "u").where("v <> m").selectExpr("v AS u", "m AS v")
                 .union(low.selectExpr("u", "m AS v")).distinct())
        edges = stored(small, "edges")
        now = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if now == mark:
            break
        mark = now
    return (edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
            .union(edges.selectExpr("v AS node", "v AS root").distinct()))


def clusters(prints: DataFrame) -> DataFrame:
    """(fp, root) for fingerprints that have a link; all others stand alone."""
    return components(links(prints.select("fp").distinct())).withColumnRenamed("node", "fp")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, fingerprint and component.

    Null and empty texts have fingerprint zero and are linked like any other
    document.  ``component_id`` is the smallest id in the component; nulls are
    passed over, and it is null where all ids are null.  Repeated rows stay as
    they are.  Columns other than the two named are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = stored(with_fingerprint(rows).select("doc_id", "fp"), "fingerprints")
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    named = prints.join(clusters(prints), "fp", "left").withColumn(
        "root", F.expr("coalesce(root, fp)"))
    named = stored(named, "roots")
    lowest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rows.join(named.join(lowest, "root").select("fp", "component_id"), "fp").selectExpr(
        "doc_id", "lpad(lower(hex(fp)), 16, '0') AS fingerprint", "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, one of each component, with all columns.

    The row with the smallest id stays, nulls last; of equal ids the one with the smaller
    text hash, and one of rows that are alike in both.  Null and empty texts have
    fingerprint zero and are linked like any other.  An empty table stays empty.

    Rows are numbered while their fingerprints are written, so a row is found again by its
    number: no group of copies comes together, only the best number of each fingerprint.
    """
    fp, uid, node = unused(docs, "fp", "uid", "node")
    rows = docs.withColumns({uid: F.monotonically_increasing_id(), node: F.md5(utf8(text))})
    rows = stored(with_fingerprint(rows, text, fp), "fingerprints")
    rank = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("doc_id"),
                    F.col(node).alias("node"), F.col(uid).alias("uid"))
    firsts = stored(rows.groupBy(F.col(fp).alias("fp")).agg(F.min(rank).alias("rank")), "firsts")
    best = (firsts.join(clusters(firsts), "fp", "left")
            .groupBy(F.expr("coalesce(root, fp)").alias("root")).agg(F.min("rank").alias("rank")))
    kept = stored(best.select(F.col("rank.uid").alias(uid)), "kept")
    return rows.join(kept, uid, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
