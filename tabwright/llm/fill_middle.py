"""Fill-in-the-middle: a text is cut at two drawn ranks of its units and put together in another order.

The ranks are reached in an indexable skip list: every link of every lane carries how many
units and how many code points it spans, and a descent adds up both until the rank is met.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.rows import id_and_text, slices

#: Links of a lane that one link of the lane above spans.
STRIDE = 32


@dataclass(frozen=True)
class Settings:
    """How texts are cut and drawn; shares are in percent, ``spm`` of what is not plain.

    ``units`` is a regular expression whose matches, found from left to right, begin the
    units (what stands before the first belongs to it); None makes every code point one.
    """

    seed: int = 1
    plain: int = 10
    spm: int = 20
    units: str | None = None
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


class SkipList:
    """Units in order under express lanes; ``widths`` are their code points.

    Lanes are regular, so a lane is two arrays, the widths of its links in units and in
    code points, and the links below a link follow from its place.
    """

    def __init__(self, widths: np.ndarray):
        self.lanes = [(np.broadcast_to(np.int64(1), len(widths)), widths)]
        while len(self.lanes[-1][0]) > STRIDE:
            units, points = self.lanes[-1]
            first = np.arange(0, len(units), STRIDE)
            self.lanes.append((np.add.reduceat(units, first), np.add.reduceat(points, first)))

    def __len__(self) -> int:
        return int(self.lanes[-1][0].sum())

    def points_before(self, rank: int) -> int:
        """Code points before the unit of that rank; all of them for the number of units."""
        passed = points = link = 0
        for units, widths in reversed(self.lanes):
            while link < len(units) and passed + units[link] <= rank:
                passed += int(units[link])
                points += int(widths[link])
                link += 1
            link *= STRIDE
        return points


def skip_list(text: str, units: re.Pattern | None = None) -> SkipList:
    """The skip list of a text, with a unit per code point or per match."""
    if units is None or not text:
        return SkipList(np.broadcast_to(np.int64(1), len(text)))
    starts = np.fromiter((m.start() for m in units.finditer(text)), np.int64)
    return SkipList(np.diff(starts[1:], prepend=0, append=len(text)))


def rearrange(text: str, draws: tuple[int, int, int, int], settings: Settings, units: re.Pattern | None = None) -> tuple:
    """``n, form, prefix_chars, middle_chars, output`` of one text under four drawn numbers."""
    lanes = skip_list(text, units)
    n = len(lanes)
    if not text or any(mark in text for mark in settings.marks) or draws[2] % 100 >= 100 - settings.plain:
        return n, "plain", None, None, text
    low, high = sorted(draw % (n + 1) for draw in draws[:2])
    a, b = lanes.points_before(low), lanes.points_before(high)
    prefix, suffix = settings.prefix + text[:a], settings.suffix + text[b:]
    form = "spm" if draws[3] % 100 < settings.spm else "psm"
    parts = (suffix, prefix) if form == "spm" else (prefix, suffix)
    return n, form, a, b - a, "".join((*parts, settings.middle, text[a:b]))


def fill_in_middle(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, n, form, prefix_chars, middle_chars, output`` of every row.

    The first four groups of eight hex digits of the SHA-256 of ``<seed>:<id>`` are the
    draws: two cut ranks among ``n + 1``, plain or not, ``spm`` or ``psm``. A text that is
    empty or holds a mark stays plain; plain rows have null lengths. A null text counts as
    empty and a null id is drawn as the empty text; rows are independent, so rows with the
    same id and text give the same result and an empty table none. Texts are taken whole,
    other columns play no part.
    """
    if not all(settings.marks) or len(set(settings.marks)) < 3:
        raise ValueError("three different marks are needed")
    frame = id_and_text(docs, id_col, text_col)
    key = F.concat(F.lit(f"{settings.seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    drawn = frame.withColumn("draw", F.substring(F.sha2(key, 256), 1, 32))
    schema = f"id {frame.schema['id'].dataType.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = re.compile(settings.units) if settings.units else None
        for batch in batches:
            for part in slices(batch):
                made = [
                    rearrange(text, tuple(int(draw[i : i + 8], 16) for i in (0, 8, 16, 24)), settings, units)
                    for text, draw in zip(part.column("text").to_pylist(), part.column("draw").to_pylist())
                ]
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                columns = [pa.array(values, kind) for values, kind in zip(zip(*made), kinds)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *columns], ["id", "n", "form", "prefix_chars", "middle_chars", "output"]
                )

    return drawn.mapInArrow(run, schema)


def restore(made: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``made`` with ``restored``: the text told from ``form`` and ``output`` alone.

    Texts in another order hold each mark once, in front of its part. Columns of
    ``made`` of that name are replaced; a null output gives null.
    """
    output = F.col("output")

    def after(text, mark):
        return F.substring(text, F.instr(text, mark) + len(mark), F.length(text))

    def before(text, mark):
        return F.substring_index(text, mark, 1)

    prefix, suffix, middle = settings.marks
    tail = after(output, middle)
    psm = F.concat(before(after(output, prefix), suffix), tail, before(after(output, suffix), middle))
    spm = F.concat(before(after(output, prefix), middle), tail, before(after(output, suffix), prefix))
    return made.withColumn("restored", F.when(F.col("form") == "plain", output).when(F.col("form") == "spm", spm).otherwise(psm))
