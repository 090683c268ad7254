"""Cut ranks by skip list against plain slicing, forms against a brute-force version, and exact round trips."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabwright.llm.fill_middle import Settings, SkipList, fill_in_middle, restore, skip_list
from tests.llm.cases import TEXTS, documents, empty, messy, rows_of


def brute(i, text, seed=1):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    n = len(text)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return i, n, "plain", None, None, text, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if h[3] % 100 < 20:
        return i, n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}", text
    return i, n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}", text


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=3000))
def test_every_rank_is_reached(widths):
    lanes = SkipList(np.array(widths, np.int64))
    assert len(lanes) == len(widths)
    for rank in {0, 1, 31, 32, 33, 1023, 1024, 1025, len(widths) // 2, len(widths)}:
        if rank <= len(widths):
            assert lanes.points_before(rank) == sum(widths[:rank])


def test_descent_is_short():
    class Counted(np.ndarray):
        reads = 0

        def __getitem__(self, k):
            Counted.reads += 1
            return super().__getitem__(k)

    lanes = SkipList(np.ones(1_000_000, np.int64))
    lanes.lanes = [(np.asarray(u).view(Counted), w) for u, w in lanes.lanes]
    assert lanes.points_before(999_999) == 999_999
    assert Counted.reads < 32 * 2 * 5


def test_units_by_pattern():
    text = "  one two  three"
    lanes = skip_list(text, re.compile(r"\w+"))
    assert len(lanes) == 3 and [lanes.points_before(r) for r in range(4)] == [0, 6, 11, 16]
    assert len(skip_list("...", re.compile(r"\w+"))) == 1 and len(skip_list("", re.compile(r"\w+"))) == 0


def test_messy_rows(spark):
    rows = [*TEXTS, (70, "<P>"), (71, "a<S>b"), (72, "<M"), (73, "<<P"), (74, "🙂" * 40), (75, "é́\r\n"), (76, "<S" * 30)]
    found = restore(fill_in_middle(messy(spark, rows)))
    assert rows_of(found) == sorted((brute(i, t) for i, t in rows), key=repr)
    assert restore(fill_in_middle(empty(spark))).collect() == []


def test_marks_across_the_cuts_are_told_apart(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choices("<PSM>", k=rng.randint(1, 12)))) for i in range(2000)]
    found = restore(fill_in_middle(messy(spark, rows))).collect()
    assert all(r.restored == t for r, (_, t) in zip(sorted(found, key=lambda r: r.id), rows))
    assert {r.form for r in found} == {"plain", "spm", "psm"}


def test_very_long_text(spark):
    rows = [(i, ("ab🙂é " * 400_000) + str(i)) for i in range(3)]
    assert rows_of(restore(fill_in_middle(messy(spark, rows)))) == sorted((brute(i, t) for i, t in rows), key=repr)


def test_documents(spark, sf_dir):
    found = restore(fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    assert rows_of(found) == sorted((brute(i, t) for i, t in documents(spark, sf_dir)), key=repr)


def test_words_as_units(spark):
    own = Settings(seed=5, plain=0, spm=50, units=r"\w+")
    for r in restore(fill_in_middle(messy(spark), own), own).collect():
        if r.form != "plain":
            text = r.restored if r.id in (9, None) else dict(TEXTS)[r.id]  # ids of several texts
            assert r.restored == text
            starts = {0, len(text), *(m.start() for m in re.finditer(r"\w+", text))}
            assert r.prefix_chars in starts and r.prefix_chars + r.middle_chars in starts


def test_marks_must_differ(spark):
    with pytest.raises(ValueError):
        fill_in_middle(empty(spark), Settings(prefix="<S>"))
