"""Packing: every id once, sequences without gaps or padding, ids as the library gives them."""

import random
import struct
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer

from tabwright.llm.packing import WordIds, difference, fill, near_equal, pack
from tests.llm.cases import TEXTS, documents, empty, messy
from tests.llm.test_tokens import ALPHABET

WORDS = path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def check(found, want, capacity=2048, cut=True):
    """``want`` is a list of (id, ids); rows with one id are told apart by their ids."""
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in found:
        assert len(r.ids) == 4 * r.length > 0
        sequences[r.sequence_id].append((r.offset, r.length))
        documents[r.id].append((r.start, struct.unpack(f"<{r.length}I", r.ids), r.doc_tokens))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity and (not cut or at == capacity or at & (at - 1) == 0)
    by_id = defaultdict(list)
    for i, ids in want:
        by_id[i].append(ids)
    assert set(documents) == set(by_id)
    for i, pieces in documents.items():
        if len(by_id[i]) == 1:
            whole = by_id[i][0]
            pieces.sort()
            assert [p[0] for p in pieces] == [sum(len(x[1]) for x in pieces[:k]) for k in range(len(pieces))]
            assert [t for p in pieces for t in p[1]] == whole and {p[2] for p in pieces} == {len(whole)}
        else:  # each token of each row once, at its place
            have = sorted((start + k, t) for start, ids, _ in pieces for k, t in enumerate(ids))
            assert have == sorted((k, t) for ids in by_id[i] for k, t in enumerate(ids))
    return sequences


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 2047), max_size=120))
def test_near_equal(sizes):
    dealt = near_equal(sizes, 2048)
    assert sorted(i for w in dealt for i in w) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in w) <= 2048 for w in dealt)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 2047), max_size=120))
def test_fill(sizes):
    windows = fill(sizes)
    held = defaultdict(list)
    for w in windows:
        total = sum(p.length for p in w)
        assert total == 2048 or (total < 2048 and total & (total - 1) == 0)
        for p in w:
            held[p.item].append((p.start, p.length))
    for item, size in enumerate(sizes):
        at = 0
        for start, length in sorted(held[item]):
            assert start == at and length > 0
            at += length
        assert at == size
    assert sum(sum(p.length for p in w) == 2048 for w in windows) == sum(sizes) // 2048


def test_differencing_balances():
    rng = random.Random(4)
    for windows in (2, 5, 64):
        sizes = [rng.randint(1, 2047) for _ in range(windows * 6)]
        sums = [0] * windows
        for size, w in zip(sizes, difference(sizes, windows).tolist()):
            sums[w] += size
        assert max(sums) - min(sums) < 300
    # the textbook case: differencing of 8, 7, 6, 5, 4 leaves a difference of two
    place = difference([8, 7, 6, 5, 4], 2).tolist()
    assert abs(sum(s if w else -s for s, w in zip([8, 7, 6, 5, 4], place))) == 2


def test_windows_rise_when_one_is_over():
    # three of 1,200 in two windows of 2,048 cannot be: the third window comes
    assert len(near_equal([1200, 1200, 1200], 2048)) == 3
    assert [sum(p.length for p in w) for w in fill([1200, 1200, 1200], 2048)] == [2048, 1024, 512, 16]


def test_ids_are_those_of_the_library(library):
    rng = random.Random(8)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 60))) for _ in range(3000)]
    texts += [f"\u00d4{chr(c)} a{chr(c)}1" for c in (0x558, 0x10940, 0x10D50, 0x3D000)]
    with open(WORDS, "rb") as f:
        coder = WordIds(f.read(), limit=1 << 16)  # a small table: it turns over again and again
    for text in texts * 2:
        ids = coder.encode(text)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == ids_of(library, text)[:-1], repr(text)
        assert coder.words.size <= (1 << 15) + 1000 and coder.pieces.size <= (1 << 15) + 1000


def test_messy_rows(spark, library):
    found = pack(messy(spark), WORDS).collect()
    check(found, [(i, ids_of(library, t)) for i, t in TEXTS])
    assert pack(empty(spark), WORDS).collect() == []


def test_whole_documents_stay_whole(spark, library):
    found = pack(messy(spark), WORDS, capacity=64, cut=False).collect()
    check(found, [(i, ids_of(library, t)) for i, t in TEXTS], 64, cut=False)
    assert all(r.length == r.doc_tokens for r in found if r.doc_tokens < 64)


def test_very_long_and_many_tiny_texts(spark, library):
    rows = [(1, "the quick brown fox " * 200_000), (2, "x" * 300_000), *((k, "a") for k in range(3, 5000))]
    found = pack(messy(spark, rows), WORDS).collect()
    check(found, [(i, ids_of(library, t)) for i, t in rows])


def test_documents(spark, sf_dir, library):
    found = pack(spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(4), WORDS).collect()
    sequences = check(found, [(i, ids_of(library, t)) for i, t in documents(spark, sf_dir)])
    assert len(found) < 2.5 * len({r.id for r in found}) + len(sequences)
