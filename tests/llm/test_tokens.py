"""Encoding, decoding and counting against the tokenizers library."""

import gc
import random
import struct

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer

from tabwright.llm.bpe import ByteCoder, ByteDecoder, _Table, bpe_decode, bpe_encode, bpe_round_trip
from tabwright.llm.token_counts import WordCounter, count_tokens, words_of
from tests.llm.cases import TEXTS, documents, empty, messy, rows_of

BYTES, WORDS = path("byte_bpe_50k.json"), path("word_bpe_49k.json")
ALPHABET = [*"aaabbeeth  '’sStT\n\t\r\x1c\x85\xa0 　éÉßΣσςİi̇日🙂1234²Ⅷ._,-+<|>", "<|endoftext|>", "<|startoftext|>", "'s", " ing", "tion"]


class Both(ByteCoder, ByteDecoder):
    def __init__(self, spec):
        ByteCoder.__init__(self, spec)
        ByteDecoder.__init__(self, spec)


@pytest.fixture(scope="module")
def coders():
    with open(BYTES, "rb") as a, open(WORDS, "rb") as b:
        spec = a.read()
        return Both(spec), WordCounter(b.read()), Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)


def ids(packed):
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


def test_random_texts(coders):
    code, count, byte_library, word_library = coders
    rng = random.Random(1)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 60))) for _ in range(5000)]
    texts += ["a" * 5000, "ab" * 3000, " " * 1000, "the" * 1000, "\n" * 50 + "a", ""]
    for text in texts:
        want = byte_library.encode(text, add_special_tokens=False).ids
        assert ids(code.encode(text)) == want, repr(text)
        assert code.decode(code.encode(text)) == byte_library.decode(want, skip_special_tokens=False)
        assert sum(map(count.count, words_of(text))) == len(word_library.encode(text, add_special_tokens=False).ids), repr(text)


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_any_text(coders, text):
    code, count, byte_library, word_library = coders
    assert ids(code.encode(text)) == byte_library.encode(text, add_special_tokens=False).ids
    assert code.decode(code.encode(text)) == text
    assert sum(map(count.count, words_of(text))) == len(word_library.encode(text, add_special_tokens=False).ids)


def test_letters_newer_than_pythons_tables(coders):
    code, count, byte_library, word_library = coders
    for c in (0x558, 0x88F, 0x10940, 0x10D50, 0x11DB0, 0x1E6C0, 0x3D000, 0x10FFFF, 0xE000):
        for text in (f"a{chr(c)}a 1{chr(c)}", f"\u00d4{chr(c)}", f" {chr(c)}x<|endoftext|>{chr(c)} ,"):
            assert ids(code.encode(text)) == byte_library.encode(text, add_special_tokens=False).ids
            assert sum(map(count.count, words_of(text))) == len(word_library.encode(text, add_special_tokens=False).ids)


def test_every_token_of_the_vocabulary_is_reached(coders):
    code, _, library, _ = coders
    for word, i in library.get_vocab(with_added_tokens=False).items():
        raw = code.bytes_of[i]
        if code.coder.encode(word) != [i]:
            # the library does not give it either
            assert raw.decode("utf-8", "ignore").encode() != raw or library.encode(raw.decode(), add_special_tokens=False).ids != [i]


def test_decode_of_broken_bytes(coders):
    code, _, library, _ = coders
    some = [i for i, raw in enumerate(code.bytes_of) if raw and raw[0] >= 0x80][:50]
    for i in some:
        assert code.decode(struct.pack("<2I", i, 65)) == library.decode([i, 65], skip_special_tokens=False)


def test_tables_are_bounded():
    asked = []
    table = _Table(lambda x: asked.append(x) or len(x), limit=2000)
    for k in range(50):
        table = table.turned()
        assert table["often"] == 5 and table["x" * (k + 6)] == k + 6
        assert table.size <= 1000 + 400 and not table.old or not table.old.old
    assert asked.count("often") == 1
    assert table["e" * 300] == 300 and "e" * 300 not in table
    table.forget()
    assert not table.old


def test_results_do_not_depend_on_tables(coders, sf_dir, spark):
    """Tables that turn over all the time, and pairs that are forgotten, give the same ids."""
    with open(BYTES, "rb") as f:
        small = ByteCoder(f.read())
    small.table = _Table(small._stretch, 3000)
    for _, text in documents(spark, sf_dir)[:60]:
        assert small.encode(text) == coders[0].encode(text)
        small.coder.tested.clear()


def test_round_trip_of_rows(spark, coders):
    library = coders[2]
    found = rows_of(bpe_decode(bpe_encode(messy(spark), BYTES), BYTES))
    want = sorted(
        ((i, struct.pack(f"<{len(x)}I", *x), t or "") for i, t in TEXTS for x in [library.encode(t or "", add_special_tokens=False).ids]), key=repr
    )
    assert [(i, bytes(p), t) for i, p, t in found] == sorted(want, key=lambda r: repr((r[0], bytearray(r[1]), r[2])))
    assert bpe_decode(bpe_encode(empty(spark), BYTES), BYTES).collect() == []
    assert rows_of(bpe_round_trip(messy(spark), BYTES)) == found
    assert bpe_round_trip(empty(spark), BYTES).collect() == []


def test_counts_of_rows(spark, coders):
    library = coders[3]
    found = rows_of(count_tokens(messy(spark), WORDS, limit=20))
    n = [(i, t, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in TEXTS]
    assert found == sorted(((i, len((t or "").encode()), k, k > 20) for i, t, k in n), key=repr)
    assert count_tokens(empty(spark), WORDS).collect() == []


def test_documents(spark, sf_dir, coders):
    _, _, byte_library, word_library = coders
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = dict(documents(spark, sf_dir))
    for r in bpe_encode(docs, BYTES).collect():
        assert ids(r.ids) == byte_library.encode(texts[r.id], add_special_tokens=False).ids
    for r in count_tokens(docs, WORDS).collect():
        assert r.n_tokens == len(word_library.encode(texts[r.id], add_special_tokens=False).ids)


def test_a_worker_keeps_no_coder_after_its_task(spark):
    def left(batches):
        for _ in batches:
            held = sum(isinstance(x, (ByteCoder, ByteDecoder)) for x in gc.get_objects())
            yield pa.RecordBatch.from_arrays([pa.array([held])], ["held"])

    docs = spark.range(64, numPartitions=16).selectExpr("id AS doc_id", "concat('word ', id) AS text")
    encoded = bpe_round_trip(docs, BYTES)
    assert encoded.where("text NOT LIKE 'word %'").count() == 0
    assert bpe_decode(bpe_encode(docs, BYTES), BYTES).count() == 64
    assert spark.range(16, numPartitions=16).mapInArrow(left, "held long").where("held > 0").count() == 0
