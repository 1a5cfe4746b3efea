"""The stages against a plain version on a small folder, and the entry points."""

import random
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def folder_of(spark, path):
    rng = random.Random(9)
    vocabulary = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(4000)]

    def prose(n):
        return " ".join(rng.choices(vocabulary, k=n))

    items = [prose(30) for _ in range(4)]
    kinds, texts = {}, []
    for i in range(260):
        text, kind = prose(rng.choice([40, 120, 400])), "clean"
        if i % 6 == 0:
            at = text.split(" ")
            for word in rng.choices(["vile", "awful", "nasty"], k=4):
                at.insert(rng.randrange(len(at)), word)
            text, kind = " ".join(at), "toxic"
        elif i % 11 == 0:
            text, kind = f"{prose(20)} {rng.choice(items)} {prose(20)}", "leak"
        elif i % 7 == 0:
            copied = rng.choice([t for t, k in texts if k == "clean"])
            at = copied.split(" ")
            if len(at) > 100:
                at = [w.upper() if rng.random() < .3 else w for w in at]
            text, kind = " ".join(at), "copy"
        texts.append((text, kind))
        kinds[i] = kind
    rows = [(i, t, "en", f"src{i % 3}", len(t)) for i, (t, _) in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(k == "toxic")) for i, k in kinds.items() if k != "copy"],
                          "doc_id long, quality int, toxic int").write.parquet(
        f"{path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(
        f"{path}/benchmark.parquet")
    return kinds


def test_stages(spark, tmp_path):
    kinds = folder_of(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, left = docs.columns, set(kinds)
    for (name, stage), gone in zip(corpus_pipeline.STAGES[:3], ("toxic", "copy", "leak")):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns
        left = {i for i in left if kinds[i] != gone}
        assert sorted(r.doc_id for r in docs.collect()) == sorted(left), name
    texts = {r.doc_id: r.text for r in docs.collect()}

    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in rows} <= left
    assert all(texts[r.doc_id] == r.text for r in rows)
    assert max(Counter(r.doc_id for r in rows).values()) <= 2
    total = sum(len(t.split()) for t in texts.values())
    assert total * 1.4 < sum(len(r.text.split()) for r in rows) < total * 1.6
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert len(slots) == 8
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


@pytest.mark.parametrize("empty", ["documents", "labels", "benchmark"])
def test_empty_tables(spark, tmp_path, empty):
    folder_of(spark, tmp_path / "full")
    for name in ("documents", "labels", "benchmark"):
        frame = spark.read.parquet(f"{tmp_path}/full/{name}.parquet").limit(40)
        (frame.limit(0) if name == empty else frame).write.parquet(f"{tmp_path}/{name}.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert bool(rows) == (empty != "documents")


def test_registered():
    names = list(entry_points.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
    assert {"op3_warc_round_trip", "op8_source_mix", "op11_fill_in_middle", "op12_url_verdicts",
            "op13_centroid_clusters"} <= set(entry_points.oracle_sql())
