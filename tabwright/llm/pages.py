"""Text of web pages by layout-aware rendering."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tabwright.llm.render import render
from tabwright.llm.rows import id_and_text, slices


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``id, text`` of every row of ``pages``: what :func:`render` shows of the whole page.

    A null or empty page, and one with nothing to see, has the empty text. Rows are
    independent: repeated rows give repeated results, an empty table none; other columns
    play no part, whatever their names.
    """
    frame = id_and_text(pages, id_col, html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = [render(page) for page in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    return frame.mapInArrow(run, f"id {frame.schema['id'].dataType.simpleString()}, text string")
