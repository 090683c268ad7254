"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

The last token of the encoding of a prefix is unique: it is the one token that ends
there and is compatible with the last token of the prefix before it. So one pass over
a piece stores a last token per prefix, and back-pointers give the ids.
"""

from __future__ import annotations

import gc
import json
import re
import struct
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache
from itertools import chain
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabwright.llm.rows import id_and_text, slices

#: Bytes of a worker's table of pieces already encoded, about, and of an entry beside its key.
TABLE_BYTES, ENTRY_BYTES = 64 << 20, 200
#: Pairs of tokens whose test is remembered.
PAIRS = 1 << 18
#: White space of the tokenizers' patterns, without the separators 1C-1F that Python adds.
SPACES = "\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Stretches between which a border of pieces always lies.
_STRETCH = re.compile(rf" ?[^{SPACES}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]")


@lru_cache(1)
def unassigned() -> re.Pattern:
    """Code points that have no meaning in Python's tables; other libraries' newer ones may call them letters."""
    unknown = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Cn"]
    ends = [c for c, after in zip(unknown, [*unknown[1:], -1]) if after != c + 1]
    starts = [c for c, before in zip(unknown, [-2, *unknown]) if before != c - 1]
    return re.compile("[" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in zip(starts, ends)) + "]")


def newer(text: str) -> bool:
    """Whether a text may hold letters that only the library knows."""
    return not text.isprintable() and unassigned().search(text) is not None


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class PrefixCoder:
    """Encodes pieces, given as strings with one letter per base symbol."""

    def __init__(self, vocabulary: dict[str, int], merges: Iterable[tuple[str, str]]):
        size = max(vocabulary.values()) + 1
        self.shift = size.bit_length()
        self.rank: dict[int, int] = {}  # by both ids in one number
        # the parts of a token and the rank at which they are merged; base symbols are their own parts
        self.left, self.right = list(range(size)), list(range(size))
        self.made = [float("inf")] * size
        for rank, (a, b) in enumerate(merges):
            x, y, token = vocabulary[a], vocabulary[b], vocabulary[a + b]
            self.rank[x << self.shift | y] = rank
            self.left[token], self.right[token], self.made[token] = x, y, rank
        self.matches = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.length = [0] * size
        for word, i in vocabulary.items():
            if len(word) == 1 or self.left[i] != i:
                self.matches.add_word(word, i)
                self.length[i] = len(word)
        self.matches.make_automaton()
        self.tested: dict[int, bool] = {}

    def _compatible(self, a: int, b: int) -> bool:
        """Whether ``a`` followed by ``b`` encodes to just these two tokens.

        It does unless some merge across the border comes while both its symbols are
        there. Of equal merges the leftmost comes first, so on a tie the right end of
        ``a`` is used up before the border, the left end of ``b`` after it. The symbols at
        the border are those that ``a`` ends with and ``b`` begins with as they grow, each
        used up at the rank at which it becomes part of the next.
        """
        get, shift, left, right, made = self.rank.get, self.shift, self.left, self.right, self.made
        used_x = float("inf")
        while True:
            y, used_y = b, float("inf")
            while True:
                rank = get(a << shift | y)
                if rank is not None and rank < used_x and rank <= used_y:
                    return False
                if left[y] == y:
                    break
                y, used_y = left[y], made[y]
            if right[a] == a:
                return True
            a, used_x = right[a], made[a]

    def encode(self, piece: str) -> list[int]:
        if not piece:
            return []
        last = [-1] * (len(piece) + 1)
        lengths, tested, shift = self.length, self.tested, self.shift
        if len(tested) > PAIRS:
            tested.clear()
        for end, token in self.matches.iter(piece):
            end += 1
            if last[end] >= 0:
                continue
            start = end - lengths[token]
            if start:
                before = last[start]
                if before < 0:
                    continue
                pair = before << shift | token
                fits = tested.get(pair)
                if fits is None:
                    fits = tested[pair] = self._compatible(before, token)
                if not fits:
                    continue
            last[end] = token
        out, at = [], len(piece)
        while at:
            out.append(last[at])
            at -= lengths[last[at]]
        return out[::-1]


class _Table(dict):
    """Stretch to result; unknown ones are computed and kept while there is room.

    A full table becomes the old one and a new one is begun (:meth:`turned`, between
    texts); what is asked for again moves over, so frequent stretches stay. Both together
    hold about ``limit`` bytes.
    """

    def __init__(self, compute, limit: int = TABLE_BYTES):
        super().__init__()
        self.compute, self.limit, self.size, self.old = compute, limit // 2, 0, {}

    def __missing__(self, key: str):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if self.size < self.limit and len(key) <= 256:
            self[key] = value
            self.size += ENTRY_BYTES + 2 * len(key)  # a value has at most four bytes for each letter, mostly one
        return value

    def turned(self) -> _Table:
        """The table to go on with; the entries themselves are not copied."""
        if self.size < self.limit:
            return self
        fresh = _Table(self.compute, 2 * self.limit)
        fresh.old, self.old = self, {}
        return fresh

    def forget(self) -> None:
        """Give up the old entries, so that an idle worker holds half as much."""
        self.old = {}


def _special(spec: dict) -> dict[str, int]:
    return {t["content"]: t["id"] for t in spec["added_tokens"]}


class ByteCoder:
    """Encodes texts by a byte-level tokenizer file."""

    def __init__(self, spec: bytes):
        parsed = json.loads(spec)
        self.spec = spec
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in parsed["model"]["merges"]]
        self.coder = PrefixCoder(parsed["model"]["vocab"], merges)
        self.letters = dict(enumerate(byte_letters()))
        special = _special(parsed)
        self.special = {text: struct.pack("<I", i) for text, i in special.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")
        self.packed = [i.to_bytes(4, "little") for i in range(max(parsed["model"]["vocab"].values()) + 1)]
        self.table = _Table(self._stretch)

    @cached_property
    def library(self) -> Tokenizer:
        """The library's tokenizer, made when a text asks for it."""
        return Tokenizer.from_str(self.spec.decode())

    def _stretch(self, stretch: str) -> bytes:
        """Ids of a stretch; its pieces are stretches themselves, kept in the same table."""
        body = stretch[1:] if stretch[0] == " " else stretch
        if body.isascii():  # most new ones are a word, perhaps with a sign behind it
            if body.isalpha():
                return self._ids(body if len(body) == len(stretch) else self.letters[32] + body)
            if body[:-1].isalpha():
                return self.table[stretch[:-1]] + self.table[body[-1]]
        elif newer(stretch):  # cut as the library's own tables say
            pieces = self.library.pre_tokenizer.pre_tokenize_str(stretch)
            return b"".join([self._ids(letters) for letters, _ in pieces])
        pieces = _PIECE.findall(stretch)
        if len(pieces) > 1:
            return b"".join(map(self.table.__getitem__, pieces))
        return self._ids(stretch.encode().decode("latin-1").translate(self.letters))

    def _ids(self, piece: str) -> bytes:
        packed = self.packed
        return b"".join([packed[i] for i in self.coder.encode(piece)])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        self.table = self.table.turned()
        get = self.table.__getitem__
        if not any(s in text for s in self.special):
            return b"".join(map(get, _STRETCH.findall(text)))
        return b"".join(
            chain.from_iterable(
                (self.special[part],) if part in self.special else map(get, _STRETCH.findall(part))
                for part in self.cut.split(text)
            )
        )


class ByteDecoder:
    """The bytes behind the ids of a byte-level tokenizer file."""

    def __init__(self, spec: bytes):
        parsed = json.loads(spec)
        vocabulary, special = parsed["model"]["vocab"], _special(parsed)
        back = {c: b for b, c in enumerate(byte_letters())}
        self.bytes_of = [b""] * (max([*vocabulary.values(), *special.values()]) + 1)
        for word, i in vocabulary.items():
            self.bytes_of[i] = bytes(back[c] for c in word)
        for text, i in special.items():
            self.bytes_of[i] = text.encode()

    def decode(self, ids: bytes) -> str:
        found = map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())
        return b"".join(found).decode("utf-8", "replace")


def _released() -> None:
    """Gives the memory that Arrow keeps for later back, once a task has let go of its tables.

    A worker outlives its task, and may wait beside those of other steps; so coders, made
    in a fraction of a second, belong to a task.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()


def bpe_encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ids`` of every row: the ids of its text, packed as little-endian unsigned 32-bit integers.

    ``tokenizer`` is the path of a byte-level tokenizer file, read on the driver (a few
    MB at most) and sent with the function. Strings of special tokens in a text become
    their ids, none are added, nothing is cut. A null or empty text gives no ids, a null
    id stays null; rows are independent, so repeated rows give repeated results and an
    empty table none. Other columns play no part, whatever their names.
    """
    spec = Path(tokenizer).read_bytes()
    frame = id_and_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ByteCoder(spec)
        for batch in batches:
            for part in slices(batch):
                ids = [coder.encode(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(ids, pa.binary())], ["id", "ids"])
        del coder
        _released()

    return frame.mapInArrow(run, f"id {frame.schema['id'].dataType.simpleString()}, ids binary")


def bpe_round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ids, text`` of every row: its text encoded as by :func:`bpe_encode`, and the ids decoded again.

    Both happen in one worker, so texts travel once.
    """
    spec = Path(tokenizer).read_bytes()
    frame = id_and_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, decoder = ByteCoder(spec), ByteDecoder(spec)
        for batch in batches:
            for part in slices(batch):
                ids = [coder.encode(t) for t in part.column("text").to_pylist()]
                texts = [decoder.decode(i) for i in ids]
                columns = [part.column("id"), pa.array(ids, pa.binary()), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "ids", "text"])
        del coder, decoder
        _released()

    return frame.mapInArrow(run, f"id {frame.schema['id'].dataType.simpleString()}, ids binary, text string")


def bpe_decode(encoded: DataFrame, tokenizer: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """``id, ids, text`` of every row: the text that its packed ids stand for; null ids give the empty text."""
    spec = Path(tokenizer).read_bytes()
    frame = encoded.select(
        encoded[f"`{id_col}`"].alias("id"), F.coalesce(encoded[f"`{ids_col}`"], F.lit(b"")).alias("ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ByteDecoder(spec)
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                texts = [coder.decode(i) for i in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], ["id", "ids", "text"])

    return frame.mapInArrow(run, f"id {frame.schema['id'].dataType.simpleString()}, ids binary, text string")
