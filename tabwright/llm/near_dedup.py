"""Near-duplicates by an LSH forest: sorted signature orders, neighbours as candidates, whole crowded regions in tiles."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.components import components
from tabwright.llm.rows import id_and_text, keep_decided, marks, slices, text_buffer, with_mark
from tabwright.llm.words import grams, mix, word_hashes
from tabwright.session import materialize


@dataclass(frozen=True)
class Settings:
    """``words`` of a shingle and least similarity in percent; ``trees`` signature orders of ``depth`` values.

    Two sets are candidates where they share the first ``least_depth`` values of an
    order. At similarity 0.8 a pair shares three values in one of 16 orders but for 1 of
    100,000. Those within ``near`` places of each other are found by a pass over the
    sorted order; in wider regions all others are compared in tiles of about ``tile``
    sets. Both numbers decide how the work is cut, not what is compared.
    """

    words: int = 2
    percent: int = 80
    trees: int = 16
    depth: int = 6
    least_depth: int = 3
    near: int = 4
    tile: int = 512


_MAX = np.uint32(0xFFFFFFFF)


def _permutations(settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * settings.trees * settings.depth + 1, dtype=np.uint64))
    factor, shift = seeds[::2], seeds[1::2]
    return (factor >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (shift >> np.uint64(32)).astype(np.uint32)


def shingle_sets(part: pa.RecordBatch, words: int, column: str = "text") -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; of fewer words, the hash of them all; of none, nothing."""
    h, first = word_hashes(*text_buffer(part.column(column)))
    runs, at = grams(h, first, words)
    out = []
    for k in range(len(first) - 1):
        if at[k + 1] > at[k]:
            out.append(np.unique(runs[at[k] : at[k + 1]]))
        else:
            few = h[first[k] : first[k + 1]]
            out.append(grams(few, np.array([0, len(few)]), len(few))[0] if len(few) else few)
    return out


def signature(shingles: np.ndarray, factor: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """The smallest of each permutation over a set; memory is bound whatever the set's size."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(factor), _MAX)
    for i in range(0, len(short), 256):
        low = np.minimum(low, (short[i : i + 256, None] * factor + shift).min(axis=0))
    return low


def set_prints(docs: DataFrame, settings: Settings) -> DataFrame:
    """``id, row, n, print, signature`` per row of ``docs(id, text)``: size of the shingle set, a 128-bit
    print that equal sets share, big-endian minima in the order of trees (both null for the empty set)."""
    kind = docs.schema["id"].dataType.simpleString()
    frame = docs.withColumn("row", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor, shift = _permutations(settings)
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(part, settings.words)
                prints, signs = [], []
                for s in sets:
                    both = np.array([s.sum(), mix(s).sum()], np.uint64) + np.uint64(len(s))
                    prints.append(mix(both).tobytes() if len(s) else None)
                    signs.append(signature(s, factor, shift).astype(">u4").tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("row"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(prints, pa.binary()), pa.array(signs, pa.binary())],
                    ["id", "row", "n", "print", "signature"],
                )

    return frame.mapInArrow(run, f"id {kind}, row long, n long, print binary, signature binary")


def _orders(sets: DataFrame, s: Settings) -> DataFrame:
    """``tree, prefix, print, n``: each set once in every order."""
    width = 4 * s.depth
    prefix = F.substring(F.col("signature"), F.col("tree") * width + 1, F.lit(width)).alias("prefix")
    return sets.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(s.trees - 1)))).select("tree", prefix, "print", "n")


def _walk(s: Settings, edges: bool):
    """A pass over sorted rows that yields neighbour pairs, and alone (without ``b``) the rows of regions that go on
    beyond what is looked at: of two rows of a region that are further apart, both.

    With ``edges`` the first and last rows of the part come out as well, so that pairs
    across the borders of parts are found among them.
    """
    near, least, width = s.near, s.least_depth, s.depth
    names = ["a", "b", "tree", "prefix", "print", "n"]

    def rows_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        none = pa.nulls(batch.num_rows, pa.binary())
        return pa.RecordBatch.from_arrays([none, none, *[batch.column(c) for c in names[2:]]], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail, head = None, 0
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                if edges and head < near:
                    yield rows_of(batch.slice(0, near - head))
                    head += min(near - head, batch.num_rows)
                table = batch if tail is None else pa.Table.from_batches([tail, batch]).combine_chunks().to_batches()[0]
                old = 0 if tail is None else tail.num_rows
                tree = table.column("tree").to_numpy(zero_copy_only=False)
                prefix = np.frombuffer(b"".join(table.column("prefix").to_pylist()), np.uint8).reshape(len(tree), 4 * width)[:, : 4 * least]
                size = table.column("n").to_numpy(zero_copy_only=False)
                prints = table.column("print")
                for step in range(1, min(near, len(tree) - 1) + 1):
                    i = np.arange(max(old - step, 0), len(tree) - step)
                    i = i[(tree[i] == tree[i + step]) & (prefix[i] == prefix[i + step]).all(axis=1)]
                    j = i + step
                    if step == near and len(i):
                        at_both = pa.array(np.union1d(i, j))
                        none = [pa.nulls(len(at_both), t) for t in (pa.binary(), pa.int64())]
                        crowded = [table.column(c).take(at_both) for c in ("print", "tree", "prefix")]
                        yield pa.RecordBatch.from_arrays([crowded[0], none[0], *crowded[1:], *none], names)
                    ok = 100 * np.minimum(size[i], size[j]) >= s.percent * np.maximum(size[i], size[j])
                    i, j = i[ok], j[ok]
                    if len(i):
                        none = [pa.nulls(len(i), table.schema.field(c).type) for c in names[2:]]
                        yield pa.RecordBatch.from_arrays([prints.take(pa.array(i)), prints.take(pa.array(j)), *none], names)
                tail = table.slice(max(table.num_rows - near, 0))
        if edges and tail is not None:
            yield rows_of(tail)

    return run


def _candidates(orders: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs ``a < b`` of prints that stand near each other in some order and in how many they do; rows
    (tree, region, print) of regions that are wider than what was looked at."""
    kind = "a binary, b binary, tree int, prefix binary, print binary, n long"
    key = ["tree", "prefix", "print"]
    # equal keys differ in the print, so any region can be cut into as many parts as its size needs
    ordered = orders.repartitionByRange(*key).sortWithinPartitions(*key)
    found = materialize(ordered.mapInArrow(_walk(s, True), kind), "forest-found")
    border = found.where("a IS NULL").drop("a", "b").dropDuplicates(["tree", "print"])
    border = border.repartition("tree").sortWithinPartitions(*key)  # 2 * near rows for each part
    found = found.where("a IS NOT NULL").union(materialize(border.mapInArrow(_walk(s, False), kind), "forest-border"))
    pairs = found.where("b IS NOT NULL").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    region = F.substring("prefix", 1, 4 * s.least_depth).alias("region")
    crowded = found.where("b IS NULL").select("tree", region, F.col("a").alias("print")).distinct()
    return materialize(pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("orders")), "near-candidates"), materialize(crowded, "near-crowded")


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of one list with all of another."""
    out = np.zeros((len(left), len(right)))
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
    sides = []
    for sets in (left, right):
        owner, values = np.repeat(np.arange(len(sets)), [len(x) for x in sets]), np.concatenate(sets)
        column = np.minimum(np.searchsorted(shared, values), max(len(shared) - 1, 0))
        held = shared[column] == values if len(shared) else np.zeros(len(values), bool)
        order = np.argsort(column[held], kind="stable")
        sides.append((owner[held][order], column[held][order]))
    (one, c), (two, d) = sides
    first, many = np.searchsorted(d, np.arange(len(shared))), np.bincount(d, minlength=len(shared))
    # what few sets hold is counted by pairs, the rest as a product of 0/1 tables, some columns at a time
    rare = np.bincount(c, minlength=len(shared)) * many < 1024
    few = np.flatnonzero(rare[c])
    for at in range(0, len(few), 4096):
        k = few[at : at + 4096]
        n = many[c[k]]
        place = np.repeat(first[c[k]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        out += np.bincount(np.repeat(one[k], n) * len(right) + two[place], minlength=out.size).reshape(out.shape)
    number = np.cumsum(~rare) - 1
    one, c, two, d = one[~rare[c]], number[c[~rare[c]]], two[~rare[d]], number[d[~rare[d]]]
    for at in range(0, int((~rare).sum()), 2048):
        tables = []
        for owner, column, rows in ((one, c, len(left)), (two, d, len(right))):
            own = slice(*np.searchsorted(column, [at, at + 2048]))
            table = np.zeros((rows, 2048), np.float32)
            table[owner[own], column[own] - at] = 1
            tables.append(table)
        out += tables[0] @ tables[1].T
    return out


def _tile_links(percent: int):
    """Links between the sets of two tiles (or of one with itself), as many as join their classes."""

    def run(table: pa.Table) -> pa.Table:
        second = np.array(table.column("second").to_pylist(), bool)
        prints, names = table.column("print").to_pylist(), table.column("class").to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        left = np.flatnonzero(~second)
        right = np.flatnonzero(second) if second.any() else left
        if not len(left):  # no set of the other tile fell here
            left = right = left[:0]
        group = np.unique(np.array([x.hex() for x in names]), return_inverse=True)[1]
        a = b = np.zeros(0, int)
        if len(left):
            both = _common([sets[k] for k in left], [sets[k] for k in right])
            n = np.array([len(x) for x in sets])
            linked = 100 * both >= percent * (n[left][:, None] + n[right] - both)
            a, b = np.nonzero(linked & (group[left][:, None] != group[right]))
            a, b = left[a], right[b]
        new = np.unique(np.minimum(group[a], group[b]) * len(group) + np.maximum(group[a], group[b]), return_index=True)[1]
        parent, out = list(range(len(group))), []
        for k in new.tolist():
            roots = []
            for x in (group[a[k]], group[b[k]]):
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                roots.append(x)
            if roots[0] != roots[1]:
                parent[roots[0]] = roots[1]
                out.append((prints[a[k]], prints[b[k]]))
        return pa.table([pa.array([x[i] for x in out], pa.binary()) for i in (0, 1)], ["a", "b"])

    return run


#: Parts in which the rows of one region are looked up.
_SALTS = 32
#: Shingles of a tile.
_TILE_SHINGLES = 1 << 20


def _region_links(crowded: DataFrame, classes: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """Links ``a, b`` between different classes within regions ``crowded(tree, region, print, n)``.

    All pairs of sets of a region are compared by their full sets, but for pairs of one
    class. The largest class of a region, often nearly all of it, is one side only, so it
    is not compared with itself; what is left is cut into tiles, and every two tiles meet
    in a group of bounded size. A group gives no more links than it joins classes.
    """
    rows = crowded.join(classes, "print", "left").withColumn("class", F.coalesce("class", "print"))
    rows = materialize(rows, "region-rows")
    counts = rows.groupBy("tree", "region", "class").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("n"))
    heads = counts.groupBy("tree", "region").agg(
        F.max(F.struct("sets", "n", "class")).alias("most"), F.sum("sets").alias("sets"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")
    )

    def tiles(sets, n):
        return F.greatest(F.ceil(sets / s.tile), F.ceil(n / _TILE_SHINGLES)).cast("int")

    heads = materialize(
        heads.where("kinds > 1").select(
            "tree", "region", F.col("most.class").alias("most"),
            tiles(F.col("most.sets"), F.col("most.n")).alias("most_tiles"),
            tiles(F.col("sets") - F.col("most.sets"), F.col("n") - F.col("most.n")).alias("tiles"),
        ),
        "region-heads",
    )
    salt = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("print"), F.lit(_SALTS)).cast("int"))
    rows = rows.join(heads.select("*", salt), ["tree", "region", "salt"])
    draw = F.xxhash64("print", F.lit(1))
    is_most = F.col("class") == F.col("most")
    own = F.when(is_most, F.pmod(draw, F.col("most_tiles"))).otherwise(F.pmod(draw, F.col("tiles"))).cast("int")
    meets = F.expr(
        """CASE WHEN class = most
                THEN transform(sequence(0, tiles - 1), t -> struct(t AS i, own AS j, true AS of_most, true AS second))
                ELSE concat(
                  transform(sequence(0, tiles - 1), t -> struct(least(own, t) AS i, greatest(own, t) AS j, false AS of_most, own > t AS second)),
                  transform(sequence(0, most_tiles - 1), t -> struct(own AS i, t AS j, true AS of_most, false AS second))) END"""
    )
    rows = rows.withColumn("own", own).select("tree", "region", "print", "class", F.explode(meets).alias("at"))
    rows = materialize(rows.select("tree", "region", "print", "class", "at.*"), "region-tiles")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = pa.array([x.tobytes() for x in shingle_sets(part, s.words)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("print"), found], ["print", "shingles"])

    asked = texts.join(rows.select("print").distinct(), "print").select("print", "text")
    asked = materialize(asked.mapInArrow(sets, "print binary, shingles binary"), "region-sets")
    groups = rows.join(asked, "print").groupBy("tree", "region", "i", "j", "of_most")
    return materialize(groups.applyInArrow(_tile_links(s.percent), "a binary, b binary"), "region-links")


def _confirmed(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """``a, b, linked`` of all pairs, compared by their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, np.zeros(0, np.uint64)
        for batch in batches:
            for part in slices(batch, "text_b"):
                out = []
                rights = shingle_sets(part, settings.words, "text_b")
                for a, text, right in zip(part.column("a").to_pylist(), part.column("text_a"), rights, strict=True):
                    if a != last:
                        one = pa.RecordBatch.from_arrays([pa.array([text.as_py()], pa.string())], ["text"])
                        last, left = a, shingle_sets(one, settings.words)[0]
                    both = len(np.intersect1d(left, right, assume_unique=True))
                    out.append(100 * both >= settings.percent * (len(left) + len(right) - both))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(out)], ["a", "b", "linked"])

    one, two = (texts.select(F.col("print").alias(n), F.col("text").alias(f"text_{n}")) for n in ("a", "b"))
    both = pairs.select("a", "b").join(two, "b").join(one, "a").select("a", "b", "text_a", "text_b")
    return materialize(both.mapInArrow(run, "a binary, b binary, linked boolean"), "forest-links")


def _merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``print, class`` after joining the classes (of prints that are no class of their own) along new links."""
    a, b = (classes.select(F.col("print").alias(n), F.col("class").alias(f"{n}_class")) for n in ("a", "b"))
    edges = links.join(a, "a", "left").join(b, "b", "left")
    edges = edges.select(F.coalesce("a_class", "a").alias("a"), F.coalesce("b_class", "b").alias("b"))
    roots = components(edges).withColumnsRenamed({"node": "class", "root": "to"})
    nodes = classes.join(roots, "class", "left").select("print", F.coalesce("to", "class").alias("class"))
    fresh = roots.select(F.col("class").alias("print"), F.col("to").alias("class"))
    # a node that had no class yet is in `fresh` under its own print
    fresh = fresh.join(classes.select("print"), "print", "left_anti")
    return materialize(nodes.union(fresh), "forest-classes")


def _classes(docs: DataFrame, settings: Settings | None, id_col: str, text_col: str) -> DataFrame:
    """``id, row, n, class`` of every row; the class of the empty set is null."""
    s = settings or Settings()
    frame = id_and_text(docs, id_col, text_col)
    rows = materialize(set_prints(frame, s), "near-prints")
    reps = materialize(
        rows.where("n > 0").groupBy("print").agg(F.first("n").alias("n"), F.first("signature").alias("signature"), F.min(F.struct("row", "id")).alias("one")),
        "near-sets",
    )
    pairs, crowded = _candidates(_orders(reps, s), s)
    nodes = pairs.select(F.col("a").alias("print")).union(pairs.select("b")).distinct()
    asked = nodes.union(crowded.select("print")).distinct()
    wanted = materialize(reps.join(asked, "print").select("print", "one.row", "one.id"), "near-wanted")
    hashed = frame.withColumn("row", F.xxhash64("text"))
    texts = with_mark(hashed, "row", marks(wanted, "row")).where("marked").drop("marked")
    same = texts["row"].eqNullSafe(wanted["row"]) & texts["id"].eqNullSafe(wanted["id"])
    texts = materialize(texts.join(wanted, same).select("print", "text").dropDuplicates(["print"]), "near-texts")
    # the pair of each set that most orders name
    side = F.struct("orders", F.col("b").alias("other"))
    best = (
        pairs.select("a", "b", "orders").union(pairs.select("b", "a", "orders"))
        .groupBy("a").agg(F.max(side).alias("best"))
        .select(F.least("a", "best.other").alias("a"), F.greatest("a", "best.other").alias("b")).distinct()
    )
    tested = _confirmed(best, texts, s)
    classes = _merged(nodes.limit(0).withColumn("class", F.col("print")), tested.where("linked"))
    a, b = (classes.select(F.col("print").alias(n), F.col("class").alias(f"{n}_class")) for n in ("a", "b"))
    apart = ~F.coalesce("a_class", "a").eqNullSafe(F.coalesce("b_class", "b"))
    rest = pairs.select("a", "b").join(tested.select("a", "b"), ["a", "b"], "left_anti")
    rest = materialize(rest.join(a, "a", "left").join(b, "b", "left").where(apart).select("a", "b"), "near-rest")
    classes = _merged(classes, _confirmed(rest, texts, s).where("linked"))
    crowded = crowded.join(reps.select("print", "n"), "print")
    # a few orders join most of a large group, so that the others have little left to compare
    for trees in (F.col("tree") < 4, F.col("tree") >= 4):
        classes = _merged(classes, _region_links(crowded.where(trees), classes, texts, s))
    known = rows.join(classes, "print", "left").withColumn("class", F.coalesce("class", "print"))
    return known.select("id", "row", "n", "class")


def near_duplicates(
    docs: DataFrame, settings: Settings | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, n_shingles, component_id, kept`` for every row of ``docs``.

    Words are runs of bytes other than blank, tab and line ends, A-Z as a-z; a document's
    set holds its distinct runs of ``settings.words`` words, or all its words as one run
    when it has fewer. Documents are linked when the sets' intersection is at least
    ``settings.percent`` hundredths of their union, checked on the full sets.
    ``component_id`` is the smallest id that links reach. Null texts and texts without
    words have the empty set and are linked with nothing; repeated rows and equal sets
    are linked; a null id is reached by links but is no smallest id unless all are null;
    an empty table gives none, other columns play no part.

    Equal sets become one print first, combined before the shuffle. Each print stands in
    every signature order; orders are cut into sorted parts at any place, also inside a
    region of equal prefixes, and rows at the borders are compared in a second, small
    pass. Of the candidates, each set's most promising one is confirmed first; what then
    lies in one class needs no further test, so a large group of near copies costs about
    a test per member and not one per pair. Regions wider than the neighbourhood that
    still hold several classes are compared whole, see :func:`_region_links`. Only texts
    of candidates and of crowded regions are shuffled.
    """
    known = _classes(docs, settings, id_col, text_col)
    lowest = known.where("class IS NOT NULL").groupBy("class").agg(F.min("id").alias("component_id"))
    out = known.join(lowest, "class", "left").withColumn("component_id", F.coalesce("component_id", "id"))
    kept = F.col("id").eqNullSafe(F.col("component_id"))
    return out.select("id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


def drop_near_duplicates(
    docs: DataFrame, settings: Settings | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id (a null id is the smallest here).

    Texts without words, null ones as well, are linked with nothing and stay; of rows equal
    in id and text one stays. An empty table gives none, and columns of any name come back
    as they are.
    """
    known = _classes(docs, settings, id_col, text_col).where("class IS NOT NULL")
    groups = known.groupBy("class").agg(F.min(F.struct("id", "row")).alias("keep"), F.count(F.lit(1)).alias("size"))
    decided = known.join(groups.where("size > 1"), "class")
    stays = F.struct("id", "row").eqNullSafe(F.col("keep"))
    return keep_decided(docs, materialize(decided.select("id", "row", stays.alias("stays")), "near-decided"), id_col, text_col)
