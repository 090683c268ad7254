"""Benchmark decontamination by greedy string tiling.

Seeds that a document shares with a benchmark item are joined; for each pair that can
reach the threshold, the longest common runs of words are marked again and again so
that no word is marked twice. Passages in another order are covered as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.rows import BITMAP, MARK_BITS, id_and_text, join_same, marks, slices, text_buffer, with_mark
from tabwright.llm.words import SIGNS, grams, word_hashes
from tabwright.session import materialize

#: Words of the shortest run that counts, and share of an item's words from which a document is contaminated.
MIN_MATCH, SHARE = 5, 0.6


def tiles(left: list[int], right: list[int], shortest: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (start in left, start in right, length), longest first, no word in two tiles.

    A search length starts long and shrinks. Runs of that length are found by a running
    (Karp-Rabin) hash of the unmarked words and verified; a match far longer than the
    search length restarts the search at its length, others are marked in order of
    length. Zeros are borders that match nothing.
    """
    if min(len(left), len(right)) < shortest:
        return []
    mod, base = (1 << 61) - 1, 1_000_003
    free_left, free_right = [w != 0 for w in left], [w != 0 for w in right]
    found = []

    def windows(words: list[int], free: list[bool], size: int) -> Iterator[tuple[int, int]]:
        top, h, run = pow(base, size - 1, mod), 0, 0
        for i, w in enumerate(words):
            if not free[i]:
                h = run = 0
                continue
            if run == size:
                h -= words[i - size] * top
                run -= 1
            h = (h * base + w) % mod
            run += 1
            if run == size:
                yield i - size + 1, h

    size = max(shortest, min(20, len(left), len(right)))
    while True:
        places: dict[int, list[int]] = {}
        for j, h in windows(right, free_right, size):
            places.setdefault(h, []).append(j)
        longest, matches = 0, []
        for i, h in windows(left, free_left, size) if places else ():
            for j in places.get(h, ()):
                k = 0
                while (
                    i + k < len(left) and j + k < len(right)
                    and free_left[i + k] and free_right[j + k] and left[i + k] == right[j + k]
                ):
                    k += 1
                if k >= size:
                    matches.append((-k, i, j))
                    longest = max(longest, k)
        if longest > 2 * size:
            size = longest
            continue
        for k, i, j in sorted(matches):
            if all(free_left[i : i - k]) and all(free_right[j : j - k]):
                found.append((i, j, -k))
                for x in range(-k):
                    free_left[i + x] = free_right[j + x] = False
        # a match that met a marked word may leave a part that is long enough
        if size == shortest:
            if not _left_over(matches, free_left, free_right, shortest):
                return found
        else:
            size = max(shortest, size // 2)


def _left_over(matches, free_left, free_right, shortest) -> bool:
    """Whether some match still has a run of ``shortest`` words unmarked on both sides."""
    for k, i, j in matches:
        run = 0
        for x in range(-k):
            run = run + 1 if free_left[i + x] and free_right[j + x] else 0
            if run >= shortest:
                return True
    return False


def _seeds(part: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    words, first = word_hashes(*text_buffer(part.column("text")), SIGNS)
    runs, at = grams(words, first, n)
    return words, first, runs, at


def _items(benchmark: DataFrame, n: int) -> DataFrame:
    """``id, words, seeds`` of every item, hashes as longs."""
    schema = f"id {benchmark.schema['id'].dataType.simpleString()}, words array<long>, seeds array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words, first, seeds, at = _seeds(part, n)
                columns = [pa.array([x[a:b].view(np.int64) for a, b in zip(f[:-1], f[1:], strict=True)], pa.list_(pa.int64()))
                           for x, f in ((words, first), (seeds, at))]
                yield pa.RecordBatch.from_arrays([part.column("id"), *columns], ["id", "words", "seeds"])

    return benchmark.mapInArrow(run, schema)


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    min_match: int = MIN_MATCH,
    share: float = SHARE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``id, item, n_words, covered``: items of which a document covers at least ``share`` of the words.

    Words are runs of letters and digits, A-Z as a-z. ``covered`` counts the item's words
    in tiles of at least ``min_match`` words that greedy string tiling finds between item
    and document. Items of fewer words match nothing, and neither do null or empty texts.
    Rows that share an id are documents of their own here and give a row each where they
    differ; items that repeat an id are told apart in the same way. Empty tables give an
    empty result.

    Documents are read once. A table of fixed size marks the benchmark's seeds, so only
    documents with a marked seed go on, with no more than their runs of such words. Seeds
    then join the benchmark's exactly (a wrong mark ends here); a pair goes on only if its
    shared seeds could cover enough, which no tiling can exceed. Pairs are spread over
    tasks one by one, however frequent a passage is.
    """
    spark = docs.sparkSession
    items = materialize(_items(id_and_text(benchmark, item_col, item_text), min_match), "bench-items")
    items = items.select(F.col("id").alias("item"), F.xxhash64("words").alias("item_row"), "words", "seeds").distinct()
    seeds = items.select("item", "item_row", F.size("words").alias("n_words"), F.explode("seeds").alias("seed"))
    table = np.zeros((MARK_BITS // BITMAP, BITMAP // 8), np.uint8)
    for r in marks(seeds, "seed").collect():  # at most 256 rows of 4 KB
        table[r["_mark_bucket"]] = np.frombuffer(bytes(r["_mark_bits"]), np.uint8)
    sent = spark.sparkContext.broadcast(np.unpackbits(table.reshape(-1), bitorder="little").astype(bool))
    frame = id_and_text(docs, id_col, text_col)
    kind = frame.schema["id"].dataType.simpleString()

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = sent.value
        for batch in batches:
            for part in slices(batch):
                words, first, runs, at = _seeds(part, min_match)
                hit = marked[(runs.view(np.int64) % MARK_BITS)]
                rows, kept, found = [], [], []
                per_text = np.diff(np.concatenate([[0], np.cumsum(hit)])[at])
                for k in np.flatnonzero(per_text):
                    place = np.flatnonzero(hit[at[k] : at[k + 1]])
                    text = words[first[k] : first[k + 1]]
                    use = np.zeros(len(text) + 1, bool)
                    for x in range(min_match):
                        use[place + x] = True
                    # runs of words that some marked seed covers, a zero after each
                    line = np.where(use, np.append(text, np.uint64(0)), np.uint64(0))
                    line = line[use | np.concatenate([[False], use[:-1]])]
                    rows.append(k)
                    kept.append(line.view(np.int64))
                    found.append(np.unique(runs[at[k] : at[k + 1]][place]).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(rows, pa.int64())), pa.array(kept, pa.list_(pa.int64())),
                     pa.array(found, pa.list_(pa.int64()))], ["id", "line", "found"]
                )

    hits = materialize(
        frame.mapInArrow(shared, f"id {kind}, line array<long>, found array<long>").withColumn("row", F.xxhash64("line")),
        "bench-hits",
    )
    pairs = (
        hits.select("id", "row", F.explode("found").alias("seed"))
        .distinct()
        .join(seeds, "seed")
        .groupBy("id", "row", "item", "item_row", "n_words")
        .agg(F.count(F.lit(1)).alias("n"))
        # n places of seeds lie in tiles of at most n * min_match words
        .where(F.col("n") * min_match >= F.col("n_words") * share)
        .select("id", "row", "item", "item_row", "n_words")
    )
    lines = hits.select("id", "row", "line").dropDuplicates(["id", "row"])
    both = join_same(pairs, lines, ["id", "row"])
    both = join_same(both, items.select("item", "item_row", "words"), ["item", "item_row"])
    item_kind = items.schema["item"].dataType.simpleString()

    def tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            covered = [
                sum(n for _, _, n in tiles(a, b, min_match))
                for a, b in zip(batch.column("line").to_pylist(), batch.column("words").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("item"), batch.column("n_words"), pa.array(covered, pa.int32())],
                ["id", "item", "n_words", "covered"],
            )

    out = both.select("id", "item", "n_words", "line", "words").mapInArrow(
        tiled, f"id {kind}, item {item_kind}, n_words int, covered int"
    )
    return out.where(F.col("covered") >= F.col("n_words") * share)


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``id, n_items, item, covered_share`` of every id with a contaminated row: its items and the best covered one."""
    found = overlaps(docs, benchmark, **options)
    best = F.max(F.struct((F.col("covered") / F.col("n_words")).alias("share"), "item"))
    return (
        found.groupBy("id")
        .agg(F.count_distinct(F.struct("item")).alias("n_items"), best.alias("best"))
        .select("id", "n_items", F.col("best.item").alias("item"), F.col("best.share").alias("covered_share"))
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose id :func:`contaminated` finds; rows with a null id are told by each other."""
    found = materialize(contaminated(docs, benchmark, id_col=id_col, text_col=text_col, **options).select("id"), "bench-found")
    id_ = docs[f"`{id_col}`"]
    whole = docs.select(F.struct(*docs.columns).alias("whole"), id_.alias("id"), F.xxhash64(id_).alias("key"))
    whole = with_mark(whole, "key", marks(found.select(F.xxhash64("id").alias("key")), "key"))
    gone = found.select(F.col("id").alias("gone"))
    asked = whole.where("marked").join(gone, F.col("id").eqNullSafe(F.col("gone")), "left_anti")
    return whole.where("NOT marked").select("whole.*").union(asked.select("whole.*"))
