"""Archives against the pages they hold."""

import gzip
import hashlib
import random
from pathlib import Path

import pytest

from tillroll.llm import warc

FIELDS = "page_id long, url string, html string, digest string, data int"


def pages():
    rng = random.Random(6)
    rows = [(1, "http://a/ b\r\nX: y", "<p>x</p>"), (2, None, None), (3, "http://c", ""),
            (4, "http://d", "é" * 499), (5, "http://e", "é" * 499), (6, "u", "é" * 500),
            (7, "u", "é" * 500), (8, "v", "é" * 500), (None, "w", "é" * 500), (8, "v", "é" * 500),
            (None, "q", "\r\n\r\n"), (9, "big", "".join(rng.choices("ab <>\r\né", k=200_000))),
            (10, "none", "z" * 1000), (-4, "low", "WARC/1.1\r\n\r\n" * 100)]
    return [(*r, "x", 1) for r in rows]


def expected(rows):
    payload = [(p, (h or "").encode()) for p, _, h, _, _ in rows]
    top = {}
    for p, data in payload:
        if len(data) >= 1000 and p is not None:
            top[data] = max(top.get(data, p), p)
    out = []
    for p, data in payload:
        to = top.get(data) if p is None or p < top.get(data, p) else None
        out.append((p, len(data), hashlib.sha1(data).hexdigest(),
                    "response" if to is None else "revisit", to))
    return sorted(out, key=repr)


def test_round_trip(spark, tmp_path):
    frame = spark.createDataFrame(pages(), FIELDS)
    got = warc.round_trip(frame, folder=f"file://{tmp_path}")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(pages())
    archives = list(Path(tmp_path).glob("*.warc.gz"))
    records = b"".join(gzip.decompress(a.read_bytes()) for a in archives)
    assert records.count(b"WARC/1.1\r\nWARC-Type: ") == len(pages())


def test_chunks_carry_digests_and_bytes(spark, tmp_path):
    frame = spark.createDataFrame(pages(), FIELDS).repartition(2)
    index = warc.write_archives(warc.record_chunks(frame, chunk=1000), str(tmp_path))
    assert {r.page_id for r in warc.read_archives(spark, index).collect()} >= {9}
    rows = [r for r in warc.read_archives(spark, index, chunk=700).collect() if r.page_id == 9]
    rows.sort(key=lambda r: r.chunk_no)
    want = next(r[2] for r in pages() if r[0] == 9).encode()
    assert max(len(r.data) for r in rows) <= 700 and len(rows) > 100
    assert b"".join(bytes(r.data) for r in rows) == want
    for r in rows:
        assert r.chunk_start == 700 * r.chunk_no
        assert r.digest == hashlib.sha1(want[:r.chunk_start + len(r.data)]).hexdigest()
    assert [r.last for r in rows] == [False] * (len(rows) - 1) + [True]


def test_damage_is_found(spark, tmp_path):
    frame = spark.createDataFrame([(1, "u", "a" * 5000, "x", 1)], FIELDS)
    index = warc.write_archives(warc.record_chunks(frame), str(tmp_path))
    (archive,) = Path(tmp_path).glob("*.warc.gz")
    plain = gzip.decompress(archive.read_bytes()).replace(b"aaaa\r\n", b"aaab\r\n")
    archive.write_bytes(gzip.compress(plain))
    row = index.first()
    changed = spark.createDataFrame([(row.path, 0, archive.stat().st_size, 1)], index.schema)
    with pytest.raises(Exception, match="another digest"):
        warc.read_archives(spark, changed).collect()


def test_no_pages(spark, tmp_path):
    frame = spark.createDataFrame([], FIELDS)
    assert warc.round_trip(frame, folder=str(tmp_path)).count() == 0


def test_empty_and_equal_pages_are_spread(spark, tmp_path):
    """Ten thousand empty pages stay where they are read; equal large ones can be split."""
    rows = [(i, "u", "" if i % 2 else None, "x", 1) for i in range(10_000)]
    rows += [(20_000 + i, "v", "same " * 300, "x", 1) for i in range(500)]
    frame = spark.createDataFrame(rows, FIELDS).repartition(4)
    index = warc.write_archives(warc.record_chunks(frame), str(tmp_path))
    by_archive = {}
    for r in index.collect():
        by_archive[r.path] = by_archive.get(r.path, 0) + r.records
    assert sum(by_archive.values()) == len(rows)
    assert len(by_archive) >= 4 and max(by_archive.values()) < 0.5 * len(rows)


def test_both_sides_of_the_digest_join_are_exchanges(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = spark.createDataFrame(pages(), FIELDS)
        plan = warc.record_chunks(frame)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(payload_digest") == 2
        assert "HashAggregate" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
