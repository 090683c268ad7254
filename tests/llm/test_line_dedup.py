"""Repeated lines against brute force; whole documents against SQL in the queries."""

import random
import re

import numpy as np
import pytest

from tabwright.llm.line_dedup import _selected, drop_repeated_lines
from tests.llm.cases import TEXTS, empty, messy, rows_of


def brute(rows, need=2, words=50):
    distinct = sorted({(i is not None, i or 0, t or "") for i, t in rows}, key=lambda r: r[:2])
    seen, seen_alone, removed = set(), set(), {}
    for known, i, t in distinct:
        lines = t.split("\n")
        full = [(k, x.strip(" \t\x0b\x0c\r")) for k, x in enumerate(lines) if x.strip(" \t\x0b\x0c\r")]
        gone = set()
        for s in range(len(full) - need + 1):
            run = tuple(x for _, x in full[s : s + need])
            if run in seen:
                gone |= set(range(full[s][0], full[s + need - 1][0] + 1))
            seen.add(run)
        for k, x in full:
            if len(re.findall(r"[^\x20\x09-\x0D]+", x)) >= words:
                gone |= {k} if (x,) in seen_alone else set()
                seen_alone.add((x,))
        removed[(known, i, t)] = gone
    out = []
    for i, t in rows:
        lines, gone = (t or "").split("\n"), removed[(i is not None, i or 0, t or "")]
        out.append((i, "\n".join(x for k, x in enumerate(lines) if k not in gone), len(lines), len(gone)))
    return sorted(out, key=repr)


def test_messy_rows(spark):
    assert rows_of(drop_repeated_lines(messy(spark))) == brute(TEXTS)
    assert drop_repeated_lines(empty(spark)).collect() == []


@pytest.mark.parametrize("need", [1, 2, 4])
def test_random_lines(spark, need):
    rng = random.Random(need)
    pool = ["", " ", *"abcdef", " a", "b\t", "\rc"]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(0, 25)))) for i in range(40)]
    assert rows_of(drop_repeated_lines(messy(spark, rows), need)) == brute(rows, need)


def test_long_lines_are_runs_of_their_own(spark):
    long, short = " ".join(f"w{i}" for i in range(50)), " ".join(f"w{i}" for i in range(49))
    rows = [(i, f"before {i}\n {long} \nafter {i}\n{short}\nend {i}") for i in range(4)] + [(8, long), (9, short), (10, f"{long}\n{long}"), (11, None)]
    found = drop_repeated_lines(messy(spark, rows))
    assert rows_of(found) == brute(rows)
    kept = {r.id: r.text for r in found.collect()}
    assert long in kept[0] and kept[1] == f"before 1\nafter 1\n{short}\nend 1" and kept[8] == "" and kept[9] == short


def test_random_long_lines(spark):
    rng = random.Random(9)
    pool = ["a", "b", "", "a b c", "a  b c", "d e f", " d\te f", "g h i j"]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(0, 9)))) for i in range(60)]
    assert rows_of(drop_repeated_lines(messy(spark, rows), long_words=3)) == brute(rows, 2, 3)


def test_very_long_text(spark):
    line = "x " * 200_000
    rows = [(1, f"{line}\nown one"), (2, f"own two\n{line}"), (3, "y" * 2_000_000)]
    assert rows_of(drop_repeated_lines(messy(spark, rows))) == brute(rows)


def test_frequent_line(spark):
    rows = [(i, f"own {i}\nthe same footer\nand its end") for i in range(500)]
    found = {r.id: r.text for r in drop_repeated_lines(messy(spark, rows)).collect()}
    assert found[0] == rows[0][1] and all(found[i] == f"own {i}" for i in range(1, 500))


def test_every_window_has_a_selected_line():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 5, 200).astype(np.uint64)
    for width in (1, 2, 7):
        chosen = _selected(h, width)
        for i, place in enumerate(chosen):
            window = h[i : i + width]
            assert i <= place < i + width and h[place] == window.min()
            assert not (window[place - i + 1 :] == window.min()).any()
