"""Line dedup by winnowing: fingerprints of line hashes, joined and extended to whole repeated runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.rows import id_and_text, slices, text_buffer
from tabwright.llm.words import _BYTE_CODES, grams, mix, span_hashes, spans
from tabwright.session import materialize

#: Lines of the shortest repeated run that is deleted, or words of a line that is a run of its own; every such run is found.
MIN_LINES, LONG_WORDS = 2, 50
_LINE_END = np.zeros(256, bool)
_LINE_END[10] = True


def line_hashes(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the lines that are not blank, their numbers in the text, each text's first one, and the words of each.

    Blanks, tabs and returns at either end of a line play no part.
    """
    data, offsets = text_buffer(part.column("text"))
    starts, ends, first_word = spans(data, offsets)
    breaks = np.concatenate([[0], np.cumsum(_LINE_END[data])])
    line = breaks[starts]  # line breaks before each word, over the whole batch
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first_word))
    new = np.ones(len(starts), bool)
    new[1:] = (line[1:] != line[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(starts)) - 1 if len(head) else head
    hashes = span_hashes(_BYTE_CODES, data, starts[head], ends[tail])
    number = line[head] - breaks[offsets[:-1]][text[head]]
    return hashes, number, np.searchsorted(text[head], np.arange(len(offsets))), tail - head + 1


def _selected(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` hashes the place of its smallest, the last one of equals."""
    view = np.lib.stride_tricks.sliding_window_view(hashes, width)
    return np.arange(len(view)) + width - 1 - np.argmin(view[:, ::-1], axis=1)


def repeated_runs(
    docs: DataFrame, min_lines: int = MIN_LINES, id_col: str = "doc_id", text_col: str = "text", long_words: int = LONG_WORDS
) -> DataFrame:
    """``id, row, runs`` of documents with repeated lines: maximal runs (first, last) of line numbers to delete.

    A run goes when its lines, at least ``min_lines`` that are not blank or one of at least
    ``long_words`` words, stand in the same order at an earlier place: in a document before it (smaller id; a null id is
    the smallest), or further up in the same one. Blank lines are not counted; those
    inside a run go with it. ``row`` is a hash of the text: rows that share id and text
    are one document, other rows of an id are ordered by it. Null and empty texts and
    empty tables give nothing.

    A long line is a window of its own and its own fingerprint. Each window of ``min_lines`` lines selects its smallest line hash, so equal windows
    select the same line: these fingerprints are counted first, combined before the
    shuffle, and only shared ones go on. Each is then extended both ways to the windows
    that selected it; the earliest place of every window is again a combined minimum.
    Windows found at an earlier place join into maximal runs. A line that a third of all
    documents have is one row per task in both counts; the joins that bring the counts
    back are of the kind that adaptive execution splits.
    """
    frame = id_and_text(docs, id_col, text_col).withColumn("row", F.xxhash64("text"))
    window = T.StructType([T.StructField(n, t) for n, t in (("run", T.LongType()), ("first", T.IntegerType()), ("last", T.IntegerType()))])
    schema = T.StructType(
        [frame.schema["id"], frame.schema["row"], T.StructField("print", T.LongType()), T.StructField("windows", T.ArrayType(window))]
    )

    def single_lines(part: pa.RecordBatch, hashes: np.ndarray, number: np.ndarray, owner: np.ndarray) -> pa.RecordBatch:
        rows, place = pa.array(owner), pa.array(number.astype(np.int32))
        lines = pa.StructArray.from_arrays([pa.array(mix(hashes).view(np.int64)), place, place], ["run", "first", "last"])
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(owner) + 1, dtype=np.int32)), lines)
        return pa.RecordBatch.from_arrays(
            [part.column("id").take(rows), part.column("row").take(rows), pa.array(hashes.view(np.int64)), lists],
            ["id", "row", "print", "windows"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                hashes, number, first, words = line_hashes(part)
                if len(long := np.flatnonzero(words >= long_words)):
                    yield single_lines(part, hashes[long], number[long], np.searchsorted(first, long, "right") - 1)
                runs, at = grams(hashes, first, min_lines)
                owner, prints, begin, values = [], [], [], []
                for k in np.flatnonzero(np.diff(at)):
                    own = slice(first[k], first[k + 1])
                    chosen = _selected(hashes[own], min_lines)
                    new = np.flatnonzero(np.append(True, chosen[1:] != chosen[:-1]))
                    owner.append(np.full(len(new), k))
                    prints.append(hashes[own][chosen[new]].view(np.int64))
                    begin.append(at[k] + new)
                    values.append((number[own][: len(chosen)], number[own][min_lines - 1 :]))
                if not owner:
                    continue
                rows = pa.array(np.concatenate(owner))
                ends = pa.array(np.append(np.concatenate(begin), len(runs)).astype(np.int32))
                lists = pa.ListArray.from_arrays(
                    ends,
                    pa.StructArray.from_arrays(
                        [pa.array(runs.view(np.int64)), *[pa.array(np.concatenate([v[i] for v in values]).astype(np.int32)) for i in (0, 1)]],
                        ["run", "first", "last"],
                    ),
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(rows), part.column("row").take(rows), pa.array(np.concatenate(prints)), lists],
                    ["id", "row", "print", "windows"],
                )

    prints = materialize(frame.mapInArrow(run, schema), "line-prints")
    shared = prints.groupBy("print").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("print")
    places = prints.join(shared, "print", "left_semi").select("id", "row", F.explode("windows").alias("w")).select("id", "row", "w.*")
    places = materialize(places, "line-windows")
    earliest = (
        places.groupBy("run")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "row", "first")).alias("source"))
        .where("n > 1")
        .select("run", "source")
    )
    later = places.join(earliest, "run").where(F.struct("id", "row", "first") > F.col("source"))
    ranges = F.array_sort(F.collect_set(F.struct("first", "last")))
    # within one document: a range that begins before the last one ends belongs to it
    empty = "cast(array() as array<struct<first:int,last:int>>)"
    merged = F.expr(
        f"""aggregate(ranges, {empty}, (runs, r) ->
              CASE WHEN size(runs) > 0 AND r.first <= element_at(runs, -1).last + 1
                   THEN concat(slice(runs, 1, size(runs) - 1), array(named_struct(
                          'first', element_at(runs, -1).first, 'last', greatest(element_at(runs, -1).last, r.last))))
                   ELSE concat(runs, array(r)) END)"""
    )
    return later.groupBy("id", "row").agg(ranges.alias("ranges")).select("id", "row", merged.alias("runs"))


def drop_repeated_lines(
    docs: DataFrame, min_lines: int = MIN_LINES, id_col: str = "doc_id", text_col: str = "text", long_words: int = LONG_WORDS
) -> DataFrame:
    """``id, text, n_lines, n_removed`` for every row of ``docs``: the text without its repeated runs.

    What is repeated is told by :func:`repeated_runs`. A null text counts as empty; an
    empty text has one blank line. Lines that stay keep their bytes and their breaks.
    """
    frame = id_and_text(docs, id_col, text_col).withColumn("row", F.xxhash64("text"))
    runs = repeated_runs(docs, min_lines, id_col, text_col, long_words)
    both = frame.join(runs.withColumnsRenamed({"id": "run_id", "row": "run_row"}), F.col("row").eqNullSafe(F.col("run_row")) & F.col("id").eqNullSafe(F.col("run_id")), "left")
    lines = F.split("text", "\n", -1)
    kept = F.expr("filter(lines, (x, i) -> NOT exists(runs, r -> i BETWEEN r.first AND r.last))")
    return (
        both.withColumn("lines", lines)
        .withColumn("kept", F.when(F.col("runs").isNull(), F.col("lines")).otherwise(kept))
        .select(
            "id",
            F.when(F.col("runs").isNull(), F.col("text")).otherwise(F.array_join("kept", "\n")).alias("text"),
            F.size("lines").alias("n_lines"),
            (F.size("lines") - F.size("kept")).alias("n_removed"),
        )
    )
