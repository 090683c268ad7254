"""String tiling against its definition; contaminated documents on a planted corpus."""

import random

from tabwright.llm.decontaminate import contaminated, drop_contaminated, overlaps, tiles
from tests.llm.cases import CLASHING, PASSAGE, TEXTS, empty, messy


def greedy(left, right, shortest):
    """Covered words by the definition: the longest common run of unmarked words, again and again."""
    free_left, free_right, covered = [True] * len(left), [True] * len(right), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(left)):
            for j in range(len(right)):
                k = 0
                while (
                    i + k < len(left) and j + k < len(right) and free_left[i + k] and free_right[j + k] and left[i + k] == right[j + k]
                ):
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        k, i, j = best
        if k < shortest:
            return covered
        covered += k
        for x in range(k):
            free_left[i + x] = free_right[j + x] = False


def test_tiles_cover_what_the_definition_covers():
    rng = random.Random(6)
    for _ in range(300):
        right = [rng.randint(1, 30) for _ in range(rng.randint(0, 40))]
        cut = rng.randint(0, len(right))
        left = [rng.randint(1, 30) for _ in range(5)] + right[cut:] + [99] + right[:cut]
        found = tiles(left, right, 4)
        assert sum(n for *_, n in found) == greedy(left, right, 4)
        used_left = [x for i, _, n in found for x in range(i, i + n)]
        used_right = [x for _, j, n in found for x in range(j, j + n)]
        assert len(set(used_left)) == len(used_left) and len(set(used_right)) == len(used_right)
        assert all(n >= 4 and left[i : i + n] == right[j : j + n] for i, j, n in found)


def test_borders_match_nothing():
    assert tiles([0] * 10, [0] * 10, 3) == []
    assert tiles([1, 2, 3, 0, 4, 5, 6], [1, 2, 3, 4, 5, 6], 5) == []
    assert tiles([1] * 50, [1] * 50, 5) == [(0, 0, 50)]
    assert tiles([], [1, 2, 3], 2) == []


def bench(spark, rows):
    extra = ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(*r, *["q"] * len(CLASHING)) for r in rows], f"item_id long, text string, {extra}")


def test_planted_passages(spark):
    rng = random.Random(7)
    filler = [f"f{k}" for k in range(500)]

    def words(n):
        return " ".join(rng.choices(filler, k=n))

    items = [(k, " ".join(f"q{rng.randint(0, 400)}" for _ in range(30))) for k in range(5)]
    w = items[0][1].split()
    rows = [
        (1, f"{words(50)} {items[0][1]} {words(50)}"),
        (2, f"{words(20)} {' '.join(w[15:])} {words(3)} {' '.join(w[:15])}"),  # in another order
        (3, f"{words(9)} {' '.join(w[:10])} {words(9)}"),  # a third of the item
        (4, f"{words(9)} {items[3][1].upper().replace(' ', ', ')}! {words(9)} {items[4][1]}"),
        (5, words(200)),
        (6, " ".join(x for k in range(0, 30, 4) for x in (*w[k : k + 4], "zz"))),  # no run is long enough
    ]
    found = {r.id: (r.n_items, r.item, r.covered_share) for r in contaminated(messy(spark, rows), bench(spark, items)).collect()}
    assert found == {1: (1, 0, 1.0), 2: (1, 0, 1.0), 4: (2, 4, 1.0)}
    assert [r.doc_id for r in drop_contaminated(messy(spark, rows), bench(spark, items)).orderBy("doc_id").collect()] == [3, 5, 6]


def test_all_pairs_of_the_documents(spark, sf_dir):
    """Every pair that the definition covers enough is found, and no other."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    found = {(r.id, r.item): (r.n_words, r.covered) for r in overlaps(docs, items).collect()}

    def words(text):
        return "".join(c if (c.isascii() and c.isalnum()) or not c.isascii() else " " for c in text).translate(
            {k: k + 32 for k in range(65, 91)}
        ).split()

    texts = {r.item_id: words(r.text) for r in items.collect()}
    grams = {}
    for i, w in texts.items():
        for k in range(len(w) - 4):
            grams.setdefault(tuple(w[k : k + 5]), set()).add(i)
    want = {}
    for r in docs.collect():
        w = words(r.text)
        shared = {}
        for k in range(len(w) - 4):
            for i in grams.get(tuple(w[k : k + 5]), ()):
                shared[i] = shared.get(i, 0) + 1
        for i in shared:
            if 5 * shared[i] >= 0.6 * len(texts[i]):
                covered = greedy(w, texts[i], 5)
                if covered >= 0.6 * len(texts[i]):
                    want[(r.doc_id, i)] = (len(texts[i]), covered)
    assert found == want and want


def test_messy_rows(spark):
    items = bench(spark, [(1, PASSAGE), (1, PASSAGE), (2, None), (3, ""), (4, "too few words"), (None, "naïve café ünïcödé 日本語 " + PASSAGE)])
    found = sorted({(r.id, r.item) for r in overlaps(messy(spark), items).collect()}, key=repr)
    assert found == sorted([(i, x) for i in (1, 2, 3, 12, 13) for x in (1, None)], key=repr)
    assert overlaps(empty(spark), items).collect() == []
    assert overlaps(messy(spark), items.limit(0)).collect() == []
    kept = drop_contaminated(messy(spark), items)
    assert kept.columns == messy(spark).columns
    assert kept.count() == len([1 for i, _ in TEXTS if i not in (1, 2, 3, 12, 13)])
