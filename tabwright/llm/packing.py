"""Packing documents into sequences of a fixed number of tokens.

Every task packs the documents it reads, in groups of bounded size, so nothing is
shuffled. Whole windows are cut off long documents; what is left over is dealt to windows
by Karmarkar-Karp multiway differencing, which merges partial partitions so that the
fullest window of one meets the emptiest of the other.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import count
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tabwright.llm.bpe import byte_letters, newer
from tabwright.llm.rows import id_and_text, slices
from tabwright.llm.token_counts import _PIECE as PIECE
from tabwright.llm.token_counts import words_of

CAPACITY, END = 2048, 1
#: A group is closed at so many windows of tokens or so many documents.
GROUP_WINDOWS, GROUP_ITEMS = 64, 2048
#: Bytes of a worker's table of words already encoded, about, and of that of their pieces.
TABLE_BYTES = 96 << 20
#: Bytes of an entry beside its key and value.
ENTRY_BYTES = 200


class _Kept(dict):
    """Results by key; a full table becomes the old one, and what is asked for again moves over.

    ``compute`` gives a result and whether it is worth keeping.
    """

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit, self.size, self.old = compute, limit // 2, 0, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value, worth = self.compute(key)
            if not worth:
                return value
        if self.size < self.limit:  # a full table waits for its turn
            self[key] = value
            self.size += len(key) + len(value) + ENTRY_BYTES
        return value

    def turned(self) -> _Kept:
        """The table to go on with."""
        if self.size < self.limit:
            return self
        fresh = _Kept(self.compute, 2 * self.limit)
        fresh.old, self.old = self, {}
        return fresh


class WordIds:
    """Packed ids of texts by a vocabulary that drops white space, word by word.

    Words not met before are cut into pieces, pieces not met before are encoded by the
    library's model. Tables of both are bounded; a word is kept when its pieces were known,
    so that words which come once take no place.
    """

    def __init__(self, spec: bytes, limit: int = TABLE_BYTES):
        parsed = json.loads(spec)
        self.library = Tokenizer.from_str(spec.decode())
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        special = [t["content"] for t in parsed["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special)) or "$.")
        top = max([*parsed["model"]["vocab"].values(), *(t["id"] for t in parsed["added_tokens"])])
        self.packed = [i.to_bytes(4, "little") for i in range(top + 1)]
        self.letters = dict(enumerate(byte_letters()))
        self.words, self.pieces = _Kept(self._word, limit), _Kept(self._piece, limit)
        self.signs = {c: self._piece(c)[0] for c in ".,;:!?"}

    def _piece(self, piece: str) -> tuple[bytes, bool]:
        if not (piece.isascii() and piece.isprintable()):  # others stand for themselves
            piece = piece.encode().decode("latin-1").translate(self.letters)
        packed = self.packed
        return b"".join([packed[t.id] for t in self.model.tokenize(piece)]), True

    def _word(self, word: str) -> tuple[bytes, bool]:
        if word.isascii():  # most new words are letters, perhaps with a sign behind them
            piece, sign = (word, b"") if word.isalpha() else (word[:-1], self.signs.get(word[-1]))
            if sign is not None and piece.isalpha():
                piece = piece.lower()
                ids = self.pieces.get(piece)
                return (self.pieces[piece] if ids is None else ids) + sign, ids is not None
        if self.special.search(word) or newer(word):
            return b"".join([self.packed[i] for i in self.library.encode(word, add_special_tokens=False).ids]), True
        if not word.isascii():
            word = unicodedata.normalize("NFC", word)
        # the form of a capital sigma depends on its neighbours in Python, not in the library
        word = word.lower() if "\u03a3" not in word else "".join([c.lower() for c in word])
        return b"".join(map(self.pieces.__getitem__, PIECE.findall(word))), True

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        self.words, self.pieces = self.words.turned(), self.pieces.turned()
        return b"".join(map(self.words.__getitem__, words_of(text)))


@lru_cache(1)
def _word_ids(spec: bytes) -> WordIds:
    return WordIds(spec)


def difference(sizes: list[int], windows: int) -> np.ndarray:
    """The window of each item, with nearly equal sums, by multiway differencing.

    A partial partition is its windows' sums less the smallest, in ascending order. The
    two with the widest spread are merged, the fullest window of one with the emptiest of
    the other, until one is left; then places are handed down to the items.
    """
    if windows == 1 or not sizes:
        return np.zeros(len(sizes), np.int64)
    tick = count()
    heap = []
    for item, size in enumerate(sizes):
        sums = np.zeros(windows, np.int64)
        sums[-1] = size
        heapq.heappush(heap, (-size, next(tick), sums, item))
    merges: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        _, _, a, left = heapq.heappop(heap)
        _, _, b, right = heapq.heappop(heap)
        sums = a + b[::-1]
        order = np.argsort(sums, kind="stable")
        sums = sums[order]
        sums -= sums[0]
        merges.append((left, right, order))
        heapq.heappush(heap, (-int(sums[-1]), next(tick), sums, len(sizes) + len(merges) - 1))
    places = {heap[0][3]: np.arange(windows)}
    for node in range(len(sizes) + len(merges) - 1, len(sizes) - 1, -1):
        left, right, order = merges[node - len(sizes)]
        own = places.pop(node)
        for child, slots in ((left, order), (right, windows - 1 - order)):
            places[child] = np.empty(windows, np.int64)
            places[child][slots] = own
    return np.array([places[item][-1] for item in range(len(sizes))])


class Part(NamedTuple):
    """So many tokens of an item from a place on."""

    item: int
    start: int
    length: int


def near_equal(sizes: list[int], capacity: int) -> list[list[int]]:
    """Items dealt to windows none of which is over ``capacity``; no item may be.

    The number of windows rises from the least possible until differencing keeps to it.
    """
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        place = difference(sizes, windows)
        sums = np.bincount(place, weights=sizes, minlength=windows)
        if sums.max() <= capacity:
            found: list[list[int]] = [[] for _ in range(windows)]
            for item, w in enumerate(place.tolist()):
                found[w].append(item)
            return found
        windows += 1


def fill(sizes: list[int], capacity: int = CAPACITY, cut: bool = True) -> list[list[Part]]:
    """Windows of parts that hold every token of every item once, none over ``capacity``.

    Without ``cut`` they are those of :func:`near_equal`. With it as many windows as can be
    full are kept, the fullest, and items of the others are cut to fill them up; fewer
    tokens than one window are left, which go into windows of powers of two.
    """
    dealt = near_equal(sizes, capacity)
    dealt.sort(key=lambda items: -sum(sizes[i] for i in items))
    whole = len(dealt) if not cut else sum(sizes) // capacity
    out = [[Part(i, 0, sizes[i]) for i in items] for items in dealt[:whole]]
    spare = [Part(i, 0, sizes[i]) for items in dealt[whole:] for i in items][::-1]

    def take(window: list[Part], room: int) -> None:
        while room and spare:
            part = spare.pop()
            used = min(room, part.length)
            window.append(Part(part.item, part.start, used))
            if used < part.length:
                spare.append(Part(part.item, part.start + used, part.length - used))
            room -= used

    for window in out:
        take(window, capacity - sum(p.length for p in window))
    left = sum(p.length for p in spare)
    while left:
        power = 1 << (left.bit_length() - 1)
        out.append([])
        take(out[-1], power)
        left -= power
    return out


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end: int = END,
    cut: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id, start, length, ids, doc_tokens, sequence_id, offset`` of every piece.

    A document is the ids of its text by the tokenizer file and the id ``end``; each of
    its ids lies in one piece, at ``start`` of the document and ``offset`` of the
    sequence, packed little-endian in ``ids``. With ``cut`` sequences are full but for
    those whose length is a power of two, so padding to ``capacity`` or a power of two
    adds nothing; without it only documents over ``capacity`` are cut.

    A null or empty text is the id ``end`` alone, a null id stays null, rows are packed
    one by one, so repeated rows are packed each, and an empty table gives nothing. Other
    columns play no part. Sequence ids are made of the task's number and a count; one
    task holds one step of texts and one group of pieces (about a MB) at a time. Work
    that is repeated packs the same rows again, so pieces written by one job fit together;
    to use them twice, write them once.
    """
    spec = Path(tokenizer).read_bytes()
    frame = id_and_text(docs, id_col, text_col)
    kind = frame.schema["id"].dataType.simpleString()
    names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    last = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _word_ids(spec)
        fresh = count(TaskContext.get().partitionId() << 33)
        id_type = None
        rows: list[tuple] = []
        group: list[tuple] = []  # id, start, packed ids, tokens of the document
        held = 0

        def place(window: list[tuple]) -> None:
            sequence, offset = next(fresh), 0
            for key, start, ids, total in window:
                rows.append((key, start, len(ids) // 4, ids, total, sequence, offset))
                offset += len(ids) // 4

        def close() -> None:
            nonlocal held
            for window in fill([len(g[2]) // 4 for g in group], capacity, cut):
                place([
                    (group[p.item][0], group[p.item][1] + p.start, group[p.item][2][4 * p.start : 4 * (p.start + p.length)], group[p.item][3])
                    for p in window
                ])
            group.clear()
            held = 0

        def ready() -> pa.RecordBatch:
            kinds = (id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
            rows.clear()
            return made

        for batch in batches:
            id_type = batch.schema.field("id").type
            for part in slices(batch):
                for key, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                    ids = coder.encode(text) + last
                    total = len(ids) // 4
                    whole = total - total % capacity
                    for start in range(0, whole, capacity):
                        place([(key, start, ids[4 * start : 4 * (start + capacity)], total)])
                    if whole < total:
                        group.append((key, whole, ids[4 * whole :], total))
                        held += total - whole
                    if held >= GROUP_WINDOWS * capacity or len(group) >= GROUP_ITEMS:
                        close()
                    if len(rows) >= 4096:
                        yield ready()
                if rows:
                    yield ready()
        if group:
            close()
        if rows:
            yield ready()

    return frame.mapInArrow(run, f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
