"""SimHash components against all pairs, with odd rows."""

import random
import re

import xxhash

from tillroll.llm import simhash

FIELDS = "doc_id long, text string, fp string, root long, tail string"


def plain_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
    if words and not shingles:
        shingles = [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64)
               if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in root:
        for b in root:
            if bin(a ^ b).count("1") <= 2:
                root[find(a)] = find(b)
    return {p: find(p) for p in root}


def texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    made = [None, "", " \t\n", "one", "Two words", "ÄÖ ünï", "one", "a b c d"]
    for _ in range(30):
        base = rng.choices(words, k=rng.choice([4, 60, 300]))
        made.append(" ".join(base))
        for _ in range(3):
            copy = list(base)
            copy[rng.randrange(len(copy))] = "changed"
            made.append(" ".join(copy).upper() if rng.random() < .3 else " ".join(copy))
    made.append(" ".join(rng.choices(words, k=200_000)))
    return made


def expected(rows):
    prints = {i: plain_print(t) for i, (_, t) in enumerate(rows)}
    root = plain_components(set(prints.values()))
    lowest = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            r = root[prints[i]]
            lowest[r] = min(lowest.get(r, doc), doc)
    return sorted(((doc, f"{prints[i]:016x}", lowest.get(root[prints[i]]))
                   for i, (doc, _) in enumerate(rows)), key=repr), prints, root


def test_components_equal_all_pairs(spark):
    rows = list(enumerate(texts())) + [(3, "one"), (None, "one"), (None, "no id at all here")]
    frame = spark.createDataFrame([(d, t, "x", 1, "y") for d, t in rows], FIELDS)
    got = sorted((tuple(r) for r in simhash.near_duplicates(frame).collect()), key=repr)
    assert got == expected(rows)[0]


def test_links_of_bit_neighbours(spark):
    rng = random.Random(1)
    prints = {0}
    for _ in range(40):
        p = rng.getrandbits(64)
        prints |= {p, p ^ 1 << rng.randrange(64), p ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64)}
        prints.add(p ^ 1 << 63 ^ 1 << 0)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = {(r.a, r.b) for r in simhash.links(frame).collect()}
    want = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) % (1 << 64)).count("1") <= 2}
    assert got == want


def test_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(60)] + [(100, 101)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_one_of_each_keeps_columns_and_one_row(spark):
    rows = [(d, t) for d, t in enumerate(texts()[:60])] + [(3, "one"), (3, "one"), (None, "one")]
    frame = spark.createDataFrame([(d, t, "x", 1, "y") for d, t in rows], FIELDS)
    kept = simhash.one_of_each(frame)
    assert kept.schema.fieldNames() == ["doc_id", "text", "fp", "root", "tail"]
    _, prints, root = expected(rows)
    group = {i: root[prints[i]] for i in range(len(rows))}
    lowest = {}
    for i, (doc, _) in enumerate(rows):
        lowest[group[i]] = min(lowest.get(group[i], (True, 0)), (doc is None, doc or 0))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for _, d in lowest.values())


def test_large_groups_of_copies_and_many_unlike_texts(spark):
    """Thousands of copies, and texts of one template: no pairs within a group are made."""
    rng = random.Random(7)
    base = [f"w{rng.randrange(3000)}" for _ in range(200)]
    rows = [(9000, "another text altogether " * 3)] + [(i, " ".join(base)) for i in range(3000)]
    for i in range(400):
        own = [f"x{rng.random()}" for _ in range(200)]
        rows.append((20000 + i, " ".join(base[:100] + own)))
    frame = spark.createDataFrame([(d, t, "x", 1, "y") for d, t in rows], FIELDS)
    _, prints, root = expected(rows)
    lowest = {}
    for i, (doc, _) in enumerate(rows):
        lowest[root[prints[i]]] = min(lowest.get(root[prints[i]], doc), doc)
    assert sorted(r.doc_id for r in simhash.one_of_each(frame).collect()) == sorted(lowest.values())


def test_both_sides_of_the_component_joins_are_exchanges(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edges = spark.createDataFrame([(0, i) for i in range(1, 500)], "a long, b long")
        plan = simhash.components(edges)._jdf.queryExecution().toString()
        assert {r.root for r in simhash.components(edges).collect()} == {0}
        assert "Join" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty_table(spark):
    frame = spark.createDataFrame([], FIELDS)
    assert simhash.near_duplicates(frame).count() == 0
    assert simhash.one_of_each(frame).count() == 0
