"""Fill-in-middle cuts against a plain version, and round trips."""

import hashlib
import random
import re

import numpy as np
import pytest

from tillroll.llm import fill_middle

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
FIELDS = "doc_id long, text string, n string, form int, data string, output long"


def plain(doc, text):
    text = text or ""
    units = UNITS.findall(text)
    assert "".join(units) == text
    digits = hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[8 * i:8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return len(units), "plain", None, None, text
    if h4 % 100 < 80:
        return len(units), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(units), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def texts():
    rng = random.Random(11)
    pieces = ["a", "word", "é", "日本", "\U0001f600x", " ", "  ", "\n", "\t\x0b\f\r", " ", "<",
              "<P", "M>", "\x85", "\\1", "$0"]
    made = [None, "", " ", "\n\t ", "one", " one", "one ", "<P>", "a <S> b", "x<M>", "<P <S M>"]
    for n in (3, 40, 4000, 60_000):
        made += ["".join(rng.choices(pieces, k=n)) for _ in range(30 if n < 4000 else 3)]
    # Units, and characters, longer than a block, and a text of more than one stride.
    made += ["é" * 9001, " " * 5000 + "x" + " " * 5000, "wörd " * 260_000]
    return made


@pytest.fixture(scope="module")
def rows():
    made = [(i, t) for i, t in enumerate(texts())]
    # Texts under many ids, so that each form takes each kind of text.
    made += [(1000 + i, t) for i, t in enumerate(t for t in texts()[:40] for _ in range(8))]
    return made + [(3, "\n\t "), (3, "\n\t "), (None, "no id at all"), (None, None)]


def frame_of(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, "y", 2) for d, t in rows], FIELDS)


def test_equals_plain_version_and_keeps_columns(spark, rows):
    frame = fill_middle.with_middle(frame_of(spark, rows).repartition(3))
    assert frame.columns == ["doc_id", "text", "n", "form", "data", "output", "n_", "form_",
                             "prefix_chars", "middle_chars", "output_"]
    got = sorted((tuple(r) for r in frame.collect()), key=repr)
    want = sorted(((d, t, "x", 1, "y", 2, *plain(d, t)) for d, t in rows), key=repr)
    assert got == want
    assert {w[7] for w in want} == {"plain", "spm", "psm"}


def test_digests_and_restored_texts(spark, rows):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    got = sorted((tuple(r) for r in fill_middle.fill_middle(frame_of(spark, rows)).collect()), key=repr)
    want = []
    for d, t in rows:
        *head, output = plain(d, t)
        want.append((d, *head, sha(output), sha(t or "")))
    assert got == sorted(want, key=repr)


def test_cuts_do_not_depend_on_the_block(rows):
    for d, t in rows[:60]:
        data = (t or "").encode()
        want = fill_middle.transformed(data, str(d))
        for block in (1, 2, 7, 64):
            if len(data) < 20_000:
                assert fill_middle.transformed(data, str(d), block=block) == want


def test_every_cut_of_a_text():
    for text in [t for t in texts() if t and len(t) < 4000]:
        units = UNITS.findall(text)
        tree = fill_middle.Units(text.encode(), block=5, stride=20)
        assert (tree.n, tree.points) == (len(units), len(text))
        for k in range(len(units) + 1):
            head = "".join(units[:k])
            assert tree.cut(k) == (len(head.encode()), len(head))


def test_tree_sums_and_descent():
    rng = np.random.default_rng(3)
    for n in [1, 2, 3, 7, 8, 9, 100]:
        counts = rng.integers(0, 4, (n, 2))
        tree = fill_middle.Fenwick(counts)
        for i in range(n + 1):
            assert tree.before(i).tolist() == counts[:i].sum(axis=0).tolist()
        reached = np.cumsum(counts[:, 0])
        for wanted in range(1, int(reached[-1]) + 1):
            row = int(np.searchsorted(reached, wanted))
            assert tree.find(wanted) == (row, int(reached[row] - counts[row, 0]))


def test_empty_table(spark):
    assert fill_middle.fill_middle(spark.createDataFrame([], FIELDS)).count() == 0
