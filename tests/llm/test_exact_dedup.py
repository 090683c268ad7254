"""Exact duplicates by brute force, and that nothing but DataFrame functions runs."""

import hashlib
import re

from tabwright.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from tests.llm.cases import TEXTS, documents, empty, messy, rows_of


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for i, t in rows:
        ids = groups[norm(t)]
        keep = min((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_messy_rows(spark):
    assert rows_of(exact_duplicates(messy(spark), digest=True)) == brute(TEXTS)
    assert exact_duplicates(empty(spark)).collect() == []


def test_same_length_and_prefix_are_no_copies(spark):
    rows = [(i, "a" * 100 + x) for i, x in enumerate("bcbd")] + [(9, " " * 3), (8, "\n")]
    assert rows_of(exact_duplicates(messy(spark, rows), digest=True)) == brute(rows)


def test_large_group_of_copies(spark):
    rows = [(i, "the very same text") for i in range(2000)] + [(5000, "other")]
    found = {r.id: (r.keep_id, r.group_size, r.kept) for r in exact_duplicates(messy(spark, rows)).collect()}
    assert found[0] == (0, 2000, True) and found[1999] == (0, 2000, False) and found[5000] == (5000, 1, True)


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert rows_of(exact_duplicates(docs, digest=True)) == brute(documents(spark, sf_dir))


def test_stays_inside_spark(spark, sf_dir):
    plan = exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest=True)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_one_row_of_each_group_stays(spark):
    kept = drop_exact_duplicates(messy(spark))
    assert kept.columns == messy(spark).columns
    texts = [(r.doc_id, norm(r.text)) for r in kept.collect()]
    assert sorted(t for _, t in texts) == sorted({norm(t) for _, t in TEXTS})
    assert (1, norm(TEXTS[0][1])) in texts and (9, "two words") in texts
    assert drop_exact_duplicates(empty(spark)).collect() == []
