"""Overlaps with items: replaced words, odd rows, and clean texts."""

import itertools
import random

import numpy as np

from tillroll.llm import decontamination as d

DOCS = "doc_id long, text string, item_id string, data int, key int"
ITEMS = "item_id long, text string, data int"


def words(rng, n):
    return ["".join(rng.choices("abcdefgh", k=6)) for _ in range(n)]


def test_two_replaced_words_of_thirteen_leave_a_seed():
    places = [{o + p for p in m} for m in d.MASKS for o in range(13 - d.SPAN + 1)]
    for replaced in itertools.combinations(range(13), 2):
        assert any(not p & set(replaced) for p in places), replaced


def test_a_fifth_replaced_leaves_a_seed():
    for n in range(d.SHORTEST, 21):
        places = [{o + p for p in mask} for mask, at in d.seeds_of(n) for o in at]
        assert all(max(p) < n for p in places)
        for replaced in itertools.combinations(range(n), n // 5):
            assert any(not p & set(replaced) for p in places), (n, replaced)
    for n in range(d.SEGMENTED + 1, 1000):
        assert 3 * (n // 13) > n // 5


def test_short_items_with_replaced_words():
    rng = random.Random(3)
    for n in range(d.SHORTEST, 16):
        item = words(rng, n)
        hashed = d.Words()
        held = hashed(" ".join(item).encode())
        for replaced in itertools.combinations(range(n), n // 5):
            text = ["other" if i in replaced else w for i, w in enumerate(item)]
            text = " ".join(words(rng, 5) + text + words(rng, 5))
            assert d.overlap(hashed(text.encode()), held)[2] == 5, (n, replaced)


def test_items_under_eight_words_are_found_as_they_are(spark):
    rng = random.Random(4)
    known = [words(rng, n) for n in range(1, 8)]
    rows = []
    for item in known:
        rows.append((" ".join(words(rng, 9) + item + words(rng, 3)), item))
        if len(item) > 1:
            rows.append((" ".join(words(rng, 9) + item[:-1] + ["other"] + words(rng, 3)), None))
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    items = spark.createDataFrame([(len(i), " ".join(i).upper()) for i in known], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.equal_words, r.first_word, r.item_share)
           for r in d.overlaps(docs, items).collect()}
    assert got == {(i, len(item), len(item), 9, 1.0) for i, (_, item) in enumerate(rows) if item}
    # Only whole items of five words or more are evidence against a document.
    kept = {r.doc_id for r in d.without_leaks(docs, items).collect()}
    assert kept == {i for i, (_, item) in enumerate(rows) if not item or len(item) < 5}


def plain_overlaps(words_, item):
    """Any offset that gives a verified overlap, without seeds."""
    for offset in range(-len(item) + 1, len(words_)):
        same = [words_[i + offset] == w for i, w in enumerate(item) if 0 <= i + offset < len(words_)]
        if sum(same) >= (0.8 if len(item) >= 8 else 1) * len(item):
            return True
        for low in range(len(same)):
            for high in range(low + 13, len(same) + 1):
                equal = sum(same[low:high])
                # At most two replaced words in each 13 of it, which the masks promise to find.
                if equal >= 13 and all(sum(same[i:i + 13]) >= 11 for i in range(low, high - 12)):
                    return True
    return False


def test_equals_all_offsets_without_seeds(spark):
    rng = random.Random(12)
    items = [words(rng, n) for n in (3, 6, 8, 11, 14, 25, 40)]
    rows = []
    for _ in range(70):
        item = list(rng.choice(items))
        low = rng.randrange(len(item) // 2 + 1) if rng.random() < .4 else 0
        item = item[low:]
        for _ in range(rng.randrange(1 + len(item) // 4)):
            item[rng.randrange(len(item))] = "other"
        rows.append(words(rng, rng.randrange(12)) + item + words(rng, rng.randrange(12)))
    docs = spark.createDataFrame([(i, " ".join(r)) for i, r in enumerate(rows)], "doc_id long, text string")
    known = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in d.overlaps(docs, known).collect()}
    want = {(i, k) for i, r in enumerate(rows) for k, t in enumerate(items) if plain_overlaps(r, t)}
    assert want <= got
    # What else is found is an overlap by its own figures.
    assert all(r.equal_words >= 13 and r.equal_words >= 0.8 * r.words or r.item_share >= 0.8
               for r in d.overlaps(docs, known).collect())


def test_filter_keeps_every_seed():
    rng = np.random.default_rng(2)
    made = rng.integers(0, 1 << 63, 3000).astype(np.uint64) * np.uint64(2)
    held = np.zeros(d.FILTER_BITS // 64, dtype=np.uint64)
    for shift in d._shifts(d.FILTER_BITS):
        place = (made >> np.uint64(shift)) & np.uint64(d.FILTER_BITS - 1)
        np.bitwise_or.at(held, place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63)))
    known = d.Filter(held)
    assert (known.places(made) == np.arange(len(made))).all()
    assert len(known.places(rng.integers(0, 1 << 63, 100_000).astype(np.uint64))) < 5


def test_seeds_end_with_their_text(monkeypatch):
    """Texts that are looked at together have the seeds they have alone."""
    rng = random.Random(5)
    hashed = d.Words()
    texts = [hashed(" ".join(words(rng, n)).encode()) for n in (0, 3, 12, 40, 1, 11, 90)]
    masks = [*d.MASKS, (0, 1, 2), tuple(range(7))]
    everything = d.Filter(np.full(16, ~np.uint64(0)))
    for part in (1 << 20, 13):
        monkeypatch.setattr(d, "_PART", part)
        got = d.candidates(texts, masks, everything)
        for i, text in enumerate(texts):
            want = np.unique(np.concatenate([d.seeds(text, m) for m in masks]))
            assert (got.get(i, np.empty(0, np.uint64)) == want).all()


def test_repeated_words_make_no_pairs_of_places():
    hashed = d.Words()
    text, item = hashed(b"x " * 60_000), hashed(b"x " * 200)
    assert d.overlap(text, item)[:2] == (200, 200)


def corpus():
    rng = random.Random(8)
    items = [words(rng, n) for n in (15, 30, 57, 13, 9, 8, 400)] + [words(rng, 5)]
    rows, leaks = [], {}
    for n in range(60):
        rows.append((n, " ".join(words(rng, rng.choice([0, 3, 20, 200])))))
    for k, item in enumerate(items):
        for changed in range(3):
            text = list(item)
            for i in rng.sample(range(len(text)), changed if len(text) >= 13 else 0):
                text[i] = "replaced"
            shown = [w.upper() + rng.choice(["", ",", ".", '"']) for w in text]
            rows.append((len(rows), " ".join(words(rng, 30)) + "\n" + " \t".join(shown) + " "
                         + " ".join(words(rng, 30))))
            leaks.setdefault(rows[-1][0], set()).add(k)
    # Thirteen words of a long item are an overlap, twelve are not.
    rows.append((500, " ".join(words(rng, 9) + items[6][200:213] + words(rng, 9))))
    leaks[500] = {6}
    rows.append((501, " ".join(words(rng, 9) + items[6][200:212] + words(rng, 9))))
    # Half of the words replaced is no overlap.
    rows.append((502, " ".join(w if i % 2 else "other" for i, w in enumerate(items[2]))))
    rows += [(503, None), (504, ""), (None, " ".join(items[1])), (505, "x " * 150_000 + " ".join(items[0]))]
    leaks[None], leaks[505] = {1}, {0}
    return [" ".join(i) for i in items], rows, leaks


def frames(spark):
    items, rows, leaks = corpus()
    docs = spark.createDataFrame([(*r, "i", 1, 2) for r in rows], DOCS)
    known = [(i, t, 1) for i, t in enumerate(items)] + [(90, None, 1), (91, "", 1), (None, "a b", 1)]
    return docs, spark.createDataFrame(known, ITEMS), leaks, rows


def test_overlaps(spark, monkeypatch):
    docs, items, leaks, _ = frames(spark)
    for bits in (d.FILTER_BITS, 1 << 12):
        # A filter that is full lets all pass and loses nothing.
        monkeypatch.setattr(d, "FILTER_BITS", bits)
        got = {}
        for r in d.overlaps(docs, items).collect():
            assert r.equal_words >= 0.8 * r.words and (r.equal_words >= 13 or r.item_share >= 0.8)
            got.setdefault(r.doc_id, set()).add(r.item_id)
        assert got == leaks


def test_clean_documents_stay_whole(spark):
    docs, items, leaks, rows = frames(spark)
    kept = d.without_leaks(docs, items)
    assert kept.columns == docs.columns
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == sorted(
        ((*r, "i", 1, 2) for r in rows if r[0] not in leaks), key=repr)
    assert d.without_leaks(docs.limit(0), items).count() == 0
    assert d.without_leaks(docs, items.limit(0)).count() == len(rows)
    assert d.overlaps(docs, items.limit(0)).count() == 0
