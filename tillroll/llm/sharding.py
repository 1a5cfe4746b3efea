"""Operator 6: shards of equal size by balanced label propagation.

Linked documents start spread evenly over the shards.  In each round a document
looks at the shards of those it is linked with and asks to move to one it would
rather be in: one with more of them, ties by a hash that all of them share and
that changes with the round, so that a full shard does not block them for good.
Shards swap documents one for one, and each takes as many more as its quota has
room for.  Documents without links have no wish; they fill the shards up at the
end, so the counts are at most one apart.

Links are given as groups (a document is linked with all others of its group),
so a group of any size is one row per shard here, never its pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.workspace import stored
from tillroll.llm.common import unused, utf8
from tillroll.llm.prefix import random_key, with_prefix

SHARDS = 8
ROUNDS = 10


def quotas(n: int, shards: int) -> list[int]:
    return [n // shards + (s < n % shards) for s in range(shards)]


def _with_liked(rows: DataFrame, turn: int) -> DataFrame:
    """Adds ``liked``: the shards that a row would rather be in, best first."""
    counts = rows.groupBy("grp", "shard").agg(F.count("*").alias("n"))
    # One row per group, with at most one entry per shard.
    order = counts.groupBy("grp").agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("n")).alias("n"), F.xxhash64("grp", "shard", F.lit(turn)).alias("h"),
        F.col("shard").alias("shard")))).alias("ranked"))
    # Written first, so that both sides of the join come from an exchange of their own and
    # adaptive execution can split a large group.
    order = stored(order.selectExpr("grp", "ranked.shard AS ranked"), "ranked")
    return rows.join(order, "grp").selectExpr(
        "uid", "key", "grp", "shard",
        "slice(ranked, 1, CAST(array_position(ranked, shard) - 1 AS int)) AS liked")


def propagate(linked: DataFrame, room: list[int], rounds: int = ROUNDS) -> DataFrame:
    """Shards for the rows (uid, key, grp) of a stored table, at most ``room`` in each.

    Every round is written to the shared folder.  It ends early when nobody moves.
    Only counts per shard and per pair of shards reach the driver.
    """
    shards = len(room)
    rows = stored(with_prefix(linked, [], "key", F.lit(1), "place").selectExpr(
        "uid", "key", "grp", f"CAST(place % {shards} AS int) AS shard"), "labels")
    for turn in range(rounds):
        held = {r["shard"]: r["count"] for r in rows.groupBy("shard").count().collect()}
        free = [room[s] - held.get(s, 0) for s in range(shards)]
        opened = ", ".join(str(s) for s in range(shards) if free[s] > 0) or "-1"
        # The best liked shard with room, or else the best at all, for a swap.
        asked = stored(_with_liked(rows, turn).selectExpr(
            "uid", "key", "grp", "shard",
            f"coalesce(get(filter(liked, s -> s IN ({opened})), 0), get(liked, 0)) AS goal"), "wishes")
        wanting = asked.where("goal IS NOT NULL")
        flow = {(r["shard"], r["goal"]): r["count"]
                for r in wanting.groupBy("shard", "goal").count().collect()}
        granted = {(a, b): min(n, flow.get((b, a), 0)) for (a, b), n in flow.items()}
        for (a, b), n in sorted(flow.items()):
            more = min(n - granted[a, b], free[b])
            granted[a, b] += more
            free[b] -= more
            free[a] += more
        if not any(granted.values()):
            break
        limit = " ".join(f"WHEN shard = {a} AND goal = {b} THEN {n}"
                         for (a, b), n in sorted(granted.items()))
        moved = with_prefix(wanting, ["shard", "goal"], "key", F.lit(1), "place").selectExpr(
            "uid", "key", "grp",
            f"IF(place < CASE {limit} ELSE 0 END, goal, shard) AS shard")
        rows = stored(asked.where("goal IS NULL").select("uid", "key", "grp", "shard")
                      .unionByName(moved), "labels")
    return rows


def assign(rows: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(uid, key, shard, slot) for the rows (uid, key, grp) of a stored table.

    The counts of the shards are at most one apart; slots run from 0 in each.
    """
    room = quotas(rows.count(), shards)
    sizes = stored(rows.groupBy("grp").agg(F.count("*").alias("members"))
                   .where("members > 1"), "sizes")
    known = stored(rows.select("uid", "key", "grp").join(sizes, "grp", "left"), "groups")
    linked = known.where("members IS NOT NULL").select("uid", "key", "grp")
    linked = propagate(linked, room, rounds).select("uid", "key", "shard")
    held = {r["shard"]: r["count"] for r in linked.groupBy("shard").count().collect()}
    end, ends = 0, []
    for s in range(shards):
        end += room[s] - held.get(s, 0)
        ends.append(f"WHEN place < {end} THEN {s}")
    alone = with_prefix(known.where("members IS NULL").select("uid", "key"), [], "key",
                        F.lit(1), "place")
    filled = alone.selectExpr(
        "uid", "key", f"CASE {' '.join(ends)} END AS shard")
    both = stored(linked.union(filled), "shards")
    return with_prefix(both, ["shard"], "key", F.lit(1), "slot").selectExpr(
        "uid", "key", "shard", "CAST(slot AS bigint) AS slot")


def cut(rows: DataFrame, groups: list[str], shard: str = "shard") -> DataFrame:
    """One row (linked, apart): documents of groups of two or more, and how many of them are
    not in the shard that holds most of their group.

    It tells what ``ROUNDS`` rounds have left; counts are folded in each task, and a group is
    one row for each shard.
    """
    here = rows.groupBy(*groups, shard).agg(F.count("*").alias("n"))
    whole = here.groupBy(*groups).agg(F.sum("n").alias("members"), F.max("n").alias("most"))
    return whole.where("members > 1").agg(
        F.coalesce(F.sum("members"), F.lit(0)).alias("linked"),
        F.coalesce(F.sum(F.expr("members - most")), F.lit(0)).alias("apart"))


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    # The numbers are fixed by writing them; null texts are one group.
    return stored(docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(doc_id).alias("doc_id"),
        (F.octet_length(utf8(text)) + 1).cast("bigint").alias("size"),
        F.crc32(utf8(text)).alias("text_crc32"),
        F.coalesce(F.md5(F.col(text)), F.lit("")).alias("grp"),
        random_key(doc_id, text).alias("key")), "rows")


def shards_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
              shards: int = SHARDS) -> DataFrame:
    """Per document its size, text checksum, shard and slot, under the law ``rows``.

    Documents with equal texts are linked (null texts with each other).
    Repeated rows count each; other columns are not read.
    """
    rows = _rows(docs, doc_id, text)
    placed = assign(rows.select("uid", "key", "grp"), shards)
    return rows.drop("key", "grp").join(placed.drop("key"), "uid").selectExpr(
        "doc_id", "size", "text_crc32", "'rows' AS law", "shard", "slot",
        "CAST(NULL AS int) AS grown_shard")


def with_shard(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
               shards: int = SHARDS) -> DataFrame:
    """``docs`` with the columns ``shard`` and ``slot``.

    Equal texts are linked, null texts with each other; repeated rows get a slot each; an
    empty table stays empty.  Rows are numbered while they are written, so each is found
    again by its number, and rows of one id and text never come together.
    """
    uid, key, grp, shard, slot = unused(docs, "uid", "key", "grp", "shard", "slot")
    held = stored(docs.withColumns({
        uid: F.monotonically_increasing_id(), grp: F.coalesce(F.md5(F.col(text)), F.lit("")),
        key: random_key(doc_id, text)}), "numbered")
    placed = assign(held.selectExpr(f"{uid} AS uid", f"{key} AS key", f"{grp} AS grp"), shards)
    placed = placed.selectExpr(f"uid AS {uid}", f"shard AS {shard}", f"slot AS {slot}")
    return held.join(placed, uid).select(*[F.col(f"`{c}`") for c in docs.columns], shard, slot)
