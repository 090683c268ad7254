"""Features, weights and ranks against a brute-force version that counts and multiplies plainly."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tabwright.llm.importance import Gains, Settings, features, importance_resample, planes
from tests.llm.cases import TEXTS, documents, empty, messy, rows_of

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def buckets_of(text, buckets=10_000):
    words = _WORD.findall(lower(text))
    runs = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]


def brute(rows, target, buckets=10_000, percent=25, least=20, seed=7):
    made = [(i, *buckets_of(t, buckets)) for i, t in rows]
    source, wanted = Counter(b for _, _, f in made for b in f), Counter(b for t in target for b in buckets_of(t, buckets)[1])
    s_all, t_all = sum(source.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s_all + buckets) / ((source[b] + 1) * (t_all + buckets)))) for b in range(buckets)]
    out = []
    for i, n, f in made:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    asked = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, r in enumerate(asked[: percent * len(asked) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, out), key=repr)


def packed(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"aAbZ09 .\n\x7f@[`{é日🙂", "x" * 70])).map("".join), max_size=6))
def test_features_of_any_text(texts):
    document, bucket, n_words = features(*packed(texts), 10_000)
    for k, text in enumerate(texts):
        n, want = buckets_of(text)
        assert n_words[k] == n and Counter(bucket[document == k].tolist()) == Counter(want)


def test_planes_give_exact_sums():
    rng = np.random.default_rng(2)
    counts = np.where(rng.random((50, 999)) < 0.1, rng.integers(0, 1 << 20, (50, 999)), 0)
    gain = rng.integers(-30_000, 30_000, 999)
    assert (Gains(gain).sums(counts) == counts @ gain).all()
    assert (Gains(gain * 0).sums(counts) == 0).all() and planes(np.zeros((2, 9), np.int64)) == []


def test_messy_rows(spark):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(50)]
    rows = [*TEXTS, *((100 + k, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for k in range(200)), (None, "q " * 30), (120, "q " * 30), (120, "q " * 30)]
    target = spark.createDataFrame([("w1 w2 w3",), (None,), ("",), (PASSAGE,)], "text string")
    found = importance_resample(messy(spark, rows), target)
    assert rows_of(found) == brute(rows, ["w1 w2 w3", "", "", PASSAGE])
    assert importance_resample(empty(spark), target).collect() == []


PASSAGE = TEXTS[0][1]


def test_equal_texts_and_equal_scores(spark):
    own = Settings(buckets=7, percent=50, least_words=1, seed=1)
    # ids that draw the same noise do not exist among so few: repeat them instead
    rows = [(k % 40, "same words here") for k in range(400)]
    found = importance_resample(messy(spark, rows), messy(spark), own)
    assert rows_of(found) == brute(rows, [t for _, t in TEXTS], 7, 50, 1, 1)
    assert sorted(r.rank for r in found.collect() if r.rank) == list(range(1, 201))


def test_nothing_is_drawn_from_short_texts(spark):
    found = importance_resample(messy(spark, [(1, "a b c"), (2, None)]), empty(spark)).collect()
    assert [r.rank for r in found] == [None, None]


def test_very_long_text(spark):
    rows = [(1, "alpha beta " * 300_000), (2, "z" * 3_000_000), (3, "é" * 50 + " " + "tail " * 30)]
    assert rows_of(importance_resample(messy(spark, rows), messy(spark))) == brute(rows, [t for _, t in TEXTS])


def test_documents(spark, sf_dir):
    docs, target = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    found = importance_resample(docs, target)
    assert rows_of(found) == brute(documents(spark, sf_dir), [r.text for r in target.collect()])
