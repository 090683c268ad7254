"""Near-duplicates against exact components."""

import random
import re

import numpy as np

from tabwright.llm.components import components
from tabwright.llm.near_dedup import Settings, _common, drop_near_duplicates, near_duplicates
from tests.llm.cases import TEXTS, documents, empty, messy


def shingles(text, n):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) or frozenset([tuple(words)])


def brute(rows, n=2, percent=80):
    """Number of shingles and component per row, in the order of rows, by comparing all pairs that share a shingle."""
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = {}
    for k, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(k)
    for k, s in enumerate(sets):
        others = {j for x in s for j in holders[x] if j < k}
        for j in others:
            if root(j) != root(k):
                both = len(s & sets[j])
                if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                    parent[root(j)] = root(k)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None and sets[k]:
            low[root(k)] = min(low.get(root(k), i), i)
    return [(i, len(sets[k]), low.get(root(k), i) if sets[k] else i) for k, (i, _) in enumerate(rows)]


def compare(found, rows, **options):
    want = [(i, n, c, i == c) for i, n, c in brute(rows, **options)]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


def test_messy_rows(spark):
    compare(near_duplicates(messy(spark)), TEXTS)
    assert near_duplicates(empty(spark)).collect() == []


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    compare(near_duplicates(docs), documents(spark, sf_dir))
    compare(near_duplicates(docs, Settings(words=5)), documents(spark, sf_dir), n=5)


def near_copies(rng, n, words, changes):
    base = [f"word{rng.randint(0, 5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, changes)):
            copy[rng.randrange(words)] = f"new{rng.randint(0, 10**6)}"
        out.append(" ".join(copy))
    return out


def test_large_group_of_near_copies(spark):
    """More members than neighbours are looked at, some of them only just similar enough."""
    rng = random.Random(8)
    texts = near_copies(rng, 400, 60, 4) + near_copies(rng, 30, 25, 2) + near_copies(rng, 200, 8, 1)
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    compare(near_duplicates(messy(spark, rows)), rows)


def test_star_of_copies(spark):
    """Copies that are similar to the original only, far more than neighbours are looked at."""
    rng = random.Random(5)
    base = [f"word{k}" for k in range(201)]
    texts = [" ".join(base)]
    for c in range(4000):
        copy = list(base)
        for at in rng.sample(range(0, 200, 2), 9):  # two shingles of 200 for each word
            copy[at] = f"new{c}x{at}"
        texts.append(" ".join(copy))
    rng.shuffle(texts)
    found = near_duplicates(messy(spark, list(enumerate(texts)))).collect()
    assert {r.component_id for r in found} == {0} and len(found) == 4001


def test_sizes_of_intersections():
    """Frequent and rare members, more columns than one table has, empty overlap."""
    rng = np.random.default_rng(3)
    for most, size in ((60, 40), (9000, 3000), (10**9, 50)):
        left, right = ([np.unique(rng.integers(0, most, size).astype(np.uint64)) for _ in range(k)] for k in (70, 90))
        want = [[len(np.intersect1d(x, y)) for y in right] for x in left]
        assert (_common(left, right) == want).all()


def test_chains_reach_the_smallest_id(spark):
    """Neighbours are similar, ends are not: links carry the id along."""
    words = [f"w{i}" for i in range(140)]
    rows = [(100 - k, " ".join(words[k * 3 : k * 3 + 60])) for k in range(20)]
    compare(near_duplicates(messy(spark, rows)), rows)


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(k, k + 1) for k in range(1000, 1100)] + [(2000, k) for k in range(2001, 2100)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[root(a)] = root(b)
    groups, mine = {}, {}
    for x in parent:
        groups.setdefault(root(x), set()).add(x)
    for x, r in found.items():
        mine.setdefault(r, set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))
    assert all(r in members for r, members in mine.items())


def test_one_row_of_each_component_stays(spark):
    kept = drop_near_duplicates(messy(spark))
    assert kept.columns == messy(spark).columns
    ids = sorted((r.doc_id is not None, r.doc_id or 0) for r in kept.collect())
    # 2 equals 1; 3 and 12 are near 1; one "word" stays, under the null id; one "two words"; texts without words all stay
    assert ids == sorted([(True, i) for i in (1, 4, 5, 6, 9, 9, 11, 13, 14, 15, 16)] + [(False, 0)] * 2)
    assert drop_near_duplicates(empty(spark)).collect() == []
