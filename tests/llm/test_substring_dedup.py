"""Repeated strings against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm.substring_dedup import Settings, _pieces_of, _shared, anchors, drop_repeated_strings, first_owners
from tests.llm.cases import PASSAGE, TEXTS, documents, empty, messy, rows_of


def brute(rows, length=50):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    first, out = {}, []
    texts = [(i, (t or "").encode()) for i, t in order]
    for i, raw in texts:
        key = (i is None, i or 0)
        for k in range(len(raw) - length + 1):
            first.setdefault(raw[k : k + length], key)
    for i, raw in texts:
        key, gone = (i is None, i or 0), np.zeros(len(raw), bool)
        for k in range(len(raw) - length + 1):
            if first[raw[k : k + length]] < key:
                gone[k : k + length] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(raw) else 0
        kept = bytearray(b for b, g in zip(raw, gone) if not g)
        out.append((i, len(raw), int(gone.sum()), spans, kept))
    return sorted(out, key=repr)


def test_anchors_are_the_same_for_equal_strings():
    rng = random.Random(2)
    for _ in range(100):
        s = Settings(length=rng.choice([20, 50]), gram=rng.choice([8, 12]))
        texts = [bytes(rng.choices(rng.choice([b"a", b"ab", b"abcdefgh"]), k=rng.randint(0, 200))) for _ in range(4)]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        whole = b"".join(texts)
        seen, covered = {}, {k: [] for k in range(4)}
        for x, place, a, b, k in zip(*anchors(np.frombuffer(whole, np.uint8), offsets, s)):
            covered[k] += range(a - offsets[k], b - offsets[k] + 1)
            for i in range(a, b + 1):
                assert i <= place <= i + s.length - s.gram
                assert seen.setdefault(whole[i : i + s.length], (place - i, x)) == (place - i, x)
        assert all(covered[k] == list(range(len(t) - s.length + 1)) for k, t in enumerate(texts))


def test_first_owners_of_groups():
    rng = random.Random(3)
    for _ in range(60):
        length = rng.choice([8, 9, 50])
        base = bytes(rng.choices(rng.choice([b"ab", b"abcdefgh\x00\xff"]), k=200))
        groups, strings = [], []
        for g in range(rng.randint(1, 6)):
            for _ in range(rng.randint(1, 5)):
                a = rng.randint(0, 150)
                strings.append(base[a : a + rng.randint(0, 60 + length)])
                groups.append(g)
        low = np.array([rng.randint(0, 50) for _ in strings])
        found = first_owners(strings, low, np.array(groups), length)
        for k, x in enumerate(strings):
            want = [
                min(low[j] for j, y in enumerate(strings) if groups[j] == groups[k] and x[i : i + length] in y)
                for i in range(max(len(x) - length + 1, 0))
            ]
            assert found[k].tolist() == want


def test_messy_rows(spark):
    assert rows_of(drop_repeated_strings(messy(spark))) == brute(TEXTS)
    assert drop_repeated_strings(empty(spark)).collect() == []


@pytest.mark.parametrize("parts, crowd, together", [(64, 256, 48), (64, 256, 1), (3, 256, 2), (64, 2, 48), (0, 0, 48)])
def test_frequent_passages_in_changing_surroundings(spark, parts, crowd, together):
    """Small parts, so that passages cross them, and low bounds, so that some fingerprints are frequent."""
    rng = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(60):
        own = " ".join(rng.choices(words, k=rng.randint(5, 40)))
        cut = rng.randint(0, 30)
        rows.append((i, f"{own} {PASSAGE[cut:]} {own[::-1]}" if i % 3 else f"{PASSAGE}{i % 7}{PASSAGE[: 60 + cut]}"))
    s = Settings(part_bytes=2000, part_rows=7, parts=parts, crowd=crowd, together=together)
    assert rows_of(drop_repeated_strings(messy(spark, rows), s)) == brute(rows)


@pytest.mark.parametrize("crowd, ends", [(256, False), (4, True)])
def test_a_passage_in_all_parts_travels_in_pieces(spark, crowd, ends):
    """All its pieces are the same in every part but for the ends, which count as frequent when there are many."""
    rng = random.Random(6)
    rows = [(i, f"{rng.random()} {PASSAGE} {rng.random()}") for i in range(60)]
    s = Settings(part_bytes=2000, part_rows=7, parts=3, crowd=crowd)
    docs = spark.createDataFrame(rows, "id long, text string").withColumn("row", F.xxhash64("text"))
    found = [np.frombuffer(x.shared, np.uint64) >> np.uint64(63) for x in _shared(docs, s, 4).collect()]
    assert len(found) == 60
    assert all((x == 0).any() and (x == 1).any() == ends for x in found)
    frame = docs.select(F.col("id").alias("doc_id"), "text")
    assert rows_of(drop_repeated_strings(frame, s)) == brute(rows)


def test_different_pieces_are_counted():
    keys = np.array([3, 3, 5, 7, 7, 7, 7], np.uint64)
    kinds = np.array([9, 9, 4, 1, 2, 2, 8], np.uint16)
    assert _pieces_of(keys, kinds).tolist() == [9, 4, 0x8000 + 3]
    assert _pieces_of(keys[:0], kinds[:0]).tolist() == []


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert rows_of(drop_repeated_strings(docs)) == brute(documents(spark, sf_dir))


def test_settings_are_checked(spark):
    with pytest.raises(ValueError):
        drop_repeated_strings(messy(spark), Settings(length=10, gram=12))
