"""Ordinal regression, held-out toxic rows, and odd rows."""

import random
from pathlib import Path

import numpy as np
import pytest

from tillroll.llm import toxicity

SMALL = Path("/root/testdata/sf0.01")


def rows_of(n, seed):
    rng = random.Random(seed)
    plain = [f"word{i}" for i in range(200)]
    bad = ["vile", "awful", "nasty"]
    for i in range(n):
        toxic = i % 5 == 0
        words = rng.choices(plain, k=40) + (rng.choices(bad, k=rng.randrange(1, 9)) if toxic else [])
        rng.shuffle(words)
        yield i, " ".join(words).capitalize() + ".", toxic


def test_thresholds_are_ordered_and_severity_grows(spark):
    rows = list(rows_of(600, 1))
    model = toxicity.fit_on_labels(
        spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string"),
        spark.createDataFrame([(i, int(x)) for i, _, x in rows], "doc_id long, toxic int"))
    assert {t for t, w in model.weights.items() if w > 0.3} == {b"vile", b"awful", b"nasty"}
    assert (np.diff(model.thresholds) > 0).all()
    p = model.grades(np.linspace(-5, 30, 50))
    assert np.allclose(p.sum(axis=1), 1) and (p >= 0).all()
    assert (np.diff(p @ np.arange(p.shape[1])) >= 0).all()


def test_fit_equals_numeric_gradient_optimum():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 3, (400, 2)).astype(float)
    grade = np.clip((x @ [1.0, 0.5] + rng.logistic(size=400)).round().astype(int), 0, 2)
    rows, columns = np.nonzero(x)
    w, cut = toxicity.fit_ordinal(rows, columns, x[rows, columns], grade, 2, 3, steps=3000, rate=0.02)

    def loss(w, cut):
        s = lambda z: 1 / (1 + np.exp(-z))
        edges = np.concatenate([[-50], cut, [50]])
        score = x @ w
        return -np.log(s(edges[grade + 1] - score) - s(edges[grade] - score)).mean() + (
            w @ w) / 2 / len(x)

    best = loss(w, cut)
    for step in (0.05, -0.05):
        for i in range(2):
            assert loss(w + step * np.eye(2)[i], cut) > best
            assert loss(w, cut + step * np.eye(2)[i]) > best


def test_rows_and_columns(spark):
    known = list(rows_of(400, 2))
    rows = [(i, t, "s", 1) for i, t, _ in known]
    rows += [(None, "vile nasty awful vile", "s", 2), (1000, None, "s", 3), (1001, "", "s", 4),
             (1002, "ok " * 200_000 + "vile vile awful", "s", 5), (0, rows[0][1], "s", 6)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic string, data int")
    labels = spark.createDataFrame(
        [(i, int(x)) for i, _, x in known] + [(None, 1), (3, None), (0, 0)], "doc_id long, toxic int")
    got = {}
    for r in toxicity.severities(frame, labels).collect():
        got.setdefault(r.doc_id, []).append(r.toxic)
    assert all(got[i][0] == x for i, _, x in known)
    assert got[None] == [True] and got[1000] == [False] and got[1001] == [False]
    assert got[1002] == [True] and got[0] == [True, True]
    kept = toxicity.without_toxic(frame, labels)
    assert kept.columns == frame.columns
    assert {r.data for r in kept.collect()} == {1, 3, 4}
    none = labels.limit(0)
    assert toxicity.without_toxic(frame, none).count() == len(rows)
    assert toxicity.severities(frame.limit(0), labels).count() == 0


@pytest.mark.skipif(not SMALL.is_dir(), reason="test tables not present")
def test_held_out_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = toxicity.severities(docs, labels.where("doc_id % 3 > 0")).withColumnRenamed(
        "toxic", "found").join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    assert not [r.doc_id for r in rows if r.found and not r.toxic]
    # Some languages have two or three toxic rows to learn from here.
    assert sum(r.found for r in rows) >= 0.6 * sum(r.toxic for r in rows)


@pytest.mark.skipif(not SMALL.is_dir(), reason="test tables not present")
def test_fitted_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = toxicity.severities(docs, labels).withColumnRenamed("toxic", "found").join(
        labels, "doc_id").collect()
    assert not [r.doc_id for r in rows if r.found and not r.toxic]
    assert sum(r.found for r in rows) >= 0.9 * sum(r.toxic for r in rows)


@pytest.mark.skipif(not Path("/root/testdata/sf0.1").is_dir(), reason="test tables not present")
def test_held_out_rows_of_each_language(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = toxicity.severities(docs, labels.where("doc_id % 3 > 0")).withColumnRenamed(
        "toxic", "found").join(labels.where("doc_id % 3 = 0"), "doc_id").join(
        docs.select("doc_id", "lang"), "doc_id").collect()
    for lang in ("en", "fr", "de", "es"):
        toxic = [r.found for r in rows if r.lang == lang and r.toxic]
        clean = [r.found for r in rows if r.lang == lang and not r.toxic]
        assert sum(toxic) >= 0.9 * len(toxic), lang
        assert sum(clean) <= 0.02 * len(clean), lang
    everywhere = [r.found for r in rows if not r.toxic]
    assert sum(everywhere) <= 0.01 * len(everywhere)


def test_copies_make_no_term_and_small_languages_keep_theirs(spark):
    rng = random.Random(4)
    rows = []
    for i, text, toxic in rows_of(600, 3):
        rows.append((i, text, "en", int(toxic)))
    once = " ".join(f"word{rng.randrange(200)}" for _ in range(40)) + " copied"
    rows += [(1000 + i, once, "en", 1) for i in range(12)]
    for i in range(60):
        toxic = i % 5 == 0
        words = [f"mot{rng.randrange(80)}" for _ in range(30)] + ["vilain"] * toxic
        rows.append((2000 + i, " ".join(words), "fr", int(toxic)))
    frame = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    model = toxicity.fit_on_labels(frame, labels)
    assert set(model.weights) == {b"vile", b"awful", b"nasty", b"vilain", b"\xffvilai"}
    assert b"copied" not in model.weights


def test_terms_and_features():
    assert toxicity.terms_of(b'"idiots,') == (b"idiots", b"\xffidiot")
    assert toxicity.terms_of("réeux".encode()) == ("réeux".encode(),)
    assert toxicity.terms_of("réeuxment".encode())[1] == b"\xff" + "réeux".encode()
    assert toxicity.terms_of(b"***") == ()
    assert toxicity.term_counts("Ärger ärger, X x".encode()) == (
        {"ärger".encode(): 2, b"x": 2}, 4)
    assert [toxicity.feature(*x) for x in ((3, 100, 0.01), (1, 500, 0.01), (90, 10, 0.0))] == [2.0, 0.0, 8.0]


def test_telling_terms_equal_plain_counts(spark):
    rng = random.Random(9)
    rows = []
    for i in range(160):
        toxic, lang = i % 4 == 0, rng.choice(["en", "fr", None])
        words = {f"w{rng.randrange(30)}".encode() for _ in range(8)}
        words |= {rng.choice([b"bad", b"mal"])} if toxic and rng.random() < .8 else set()
        rows.append((int(toxic), rng.randrange(100), lang, sorted(words)))
    frame = spark.createDataFrame(rows, "toxic int, copy long, lang string, terms array<binary>")
    want = set()
    for scope in (..., "en", "fr"):
        some = [r for r in rows if scope is ... or r[2] == scope]
        bad, good = ({r[1] for r in some if bool(r[0]) == kind} for kind in (True, False))
        for term in {t for r in some for t in r[3]}:
            a, c = (len({r[1] for r in some if bool(r[0]) == kind and term in r[3]})
                    for kind in (True, False))
            share = (a + c) / (len(bad) + len(good))
            cells = [(a, len(bad) * share), (c, len(good) * share),
                     (len(bad) - a, len(bad) * (1 - share)), (len(good) - c, len(good) * (1 - share))]
            ratio = 2 * sum(n * np.log(n / e) for n, e in cells if n)
            if a >= toxicity.MIN_ROWS and a * len(good) > c * len(bad) and ratio >= toxicity.MIN_RATIO:
                want.add(term)
    assert want and toxicity.telling_terms(frame) == sorted(want)


def test_severities_equal_plain_sums(spark):
    """Scores term by term, and grades from the definition of the cumulative link."""
    shares = {b"vile": 0.01, b"\xffnasti": 0.0, b"nasties": 0.0}
    model = toxicity.Severity({b"vile": 0.9, b"\xffnasti": 0.7, b"nasties": 0.2}, shares,
                              np.array([1.0, 2.5, 4.0]))
    texts = ["vile vile words", "Nasties! nastier, nastiest", "clean " * 300 + "vile", "", None,
             "vile " * 40]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.expected_severity, r.toxic)
           for r in toxicity.with_severity(frame, model).collect()}
    for i, text in enumerate(texts):
        words = [w.strip("!,").lower() for w in (text or "").split()]
        counts = {b"vile": words.count("vile"), b"nasties": words.count("nasties"),
                  b"\xffnasti": sum(w.startswith("nasti") and len(w) > 5 for w in words)}
        score = sum(model.weights[t] * min(8.0, max(0.0, n - len(words) * shares[t]))
                    for t, n in counts.items() if n)
        below = [1 / (1 + np.exp(score - t)) for t in model.thresholds]
        assert got[i][0] == pytest.approx(sum(1 - b for b in below), abs=1e-9)
        assert got[i][1] == (1 - below[0] >= toxicity.REJECT)
