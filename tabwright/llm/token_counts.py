"""Token counts by a two-tier lookup on the map side.

Tier one is a compact table of the token counts of frequent words, sent to every
worker; tier two encodes what is missing there and keeps it in the worker. Only the
counted words of the sample that finds the frequent ones are shuffled.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cached_property, lru_cache
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabwright.llm.bpe import SPACES, TABLE_BYTES, PrefixCoder, _Table, byte_letters, newer
from tabwright.llm.rows import id_and_text, slices

#: Texts looked at for the frequent words, about, words taken from each of them, and words in the table sent out.
SAMPLE_TEXTS, SAMPLE_WORDS, FREQUENT = 2_000, 2_000, 20_000
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_GAP = re.compile(rf"[{SPACES}]+")
_ODD = re.compile("[\x1c-\x1f]")
_END = "</w>"


def words_of(text: str) -> list[str]:
    """The stretches between white space."""
    return [w for w in _GAP.split(text) if w] if _ODD.search(text) else text.split()


class WordCounter:
    """Counts the tokens of a stretch without white space, by a vocabulary with word ends."""

    def __init__(self, spec: bytes):
        spec_json = json.loads(spec)
        self.spec = spec
        model = spec_json["model"]
        # a letter and its form at a word's end are one symbol each
        single = {w: chr(0xF0000 + ord(w[0])) for w in model["vocab"] if len(w) == 1 + len(_END) and w.endswith(_END)}

        def symbols(word: str) -> str:
            if word.endswith(_END) and len(word) > len(_END):
                head = word[: -len(_END)]
                return head[:-1] + single[head[-1] + _END]
            return word

        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.coder = PrefixCoder(
            {symbols(w): i for w, i in model["vocab"].items()}, [(symbols(a), symbols(b)) for a, b in merges]
        )
        self.single, self.letters = single, dict(enumerate(byte_letters()))
        self.pieces, self.words = _Table(self._piece, TABLE_BYTES // 2), _Table(self.count)
        special = [t["content"] for t in spec_json["added_tokens"]]
        self.special = frozenset(special)
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")

    @cached_property
    def library(self) -> Tokenizer:
        """The library's tokenizer, made when a text asks for it."""
        return Tokenizer.from_str(self.spec.decode())

    def turn(self) -> None:
        """Begin new tables where they are full; between texts."""
        self.pieces, self.words = self.pieces.turned(), self.words.turned()

    def _piece(self, piece: str) -> int:
        return self._letters(piece.encode().decode("latin-1").translate(self.letters))

    def _letters(self, letters: str) -> int:
        return len(self.coder.encode(letters[:-1] + self.single[letters[-1] + _END]))

    def count(self, word: str) -> int:
        """Ids of a stretch, strings of special tokens in it as one each."""
        if word.isascii():  # most new ones are letters, perhaps with a sign behind them
            if word.isalpha():
                return self.pieces[word.lower()]
            if word[:-1].isalpha():
                return self.pieces[word[:-1].lower()] + self.pieces[word[-1]]
        total = 0
        for part in self.cut.split(word):
            if part in self.special:
                total += 1
                continue
            if newer(part):  # as the library's own tables say
                known = self.library.normalizer.normalize_str(part)
                total += sum(self._letters(p) for p, _ in self.library.pre_tokenizer.pre_tokenize_str(known))
                continue
            # letter by letter, as the tokenizer does: no form depends on its neighbours
            text = "".join([c.lower() for c in unicodedata.normalize("NFC", part)])
            for piece in _PIECE.findall(text):
                total += self.pieces[piece]
        return total


@lru_cache(2)
def _counter(spec: bytes) -> WordCounter:
    return WordCounter(spec)


def frequent_counts(docs: DataFrame, spec: bytes) -> dict[str, int]:
    """Token counts of the most frequent words of a bounded sample of texts.

    The table decides only how fast a count is found, never its value; it has at most
    ``FREQUENT`` words of at most 32 letters, so at most about 2 MB whatever the input.
    The sample is told by a hash of the text, and each task of it sends its most frequent
    words only.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts.update(w for w in words_of(text)[:SAMPLE_WORDS] if len(w) <= 32)
        found = counts.most_common(FREQUENT)
        words, numbers = pa.array([w for w, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())
        yield pa.RecordBatch.from_arrays([words, numbers], ["word", "n"])

    share = min(1.0, SAMPLE_TEXTS / max(docs.count(), 1))
    picked = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    sample = docs.select("text").where(picked).mapInArrow(tally, "word string, n long")
    top = sample.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(FREQUENT)
    count = WordCounter(spec).count
    return {r.word: count(r.word) for r in top.select("word").collect()}


def count_tokens(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048
) -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    Counts are those of the tokenizer file (a vocabulary with word ends) without added
    tokens; strings of special tokens in a text count one each. A null or empty text
    has none. Rows are independent: repeated rows give repeated results, an empty table
    gives none, other columns play no part. ``over_limit`` is ``n_tokens > limit``.
    """
    spec = Path(tokenizer).read_bytes()
    frame = id_and_text(docs, id_col, text_col)
    known = frame.sparkSession.sparkContext.broadcast(frequent_counts(frame, spec))
    schema = frame.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, first = _counter(spec), known.value.get

        def all_of(text: str) -> int:
            counter.turn()
            rest = counter.words
            total = 0
            for word in words_of(text):
                n = first(word)
                total += rest[word] if n is None else n
            return total

        for batch in batches:
            for part in slices(batch):
                totals = [all_of(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("n_bytes"), pa.array(totals, pa.int64())], ["id", "n_bytes", "n_tokens"]
                )
        counter.words.forget()
        counter.pieces.forget()

    counted = frame.withColumn("n_bytes", F.octet_length("text").cast("long")).mapInArrow(
        run, f"id {schema}, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
