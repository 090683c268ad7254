"""Personal data: fixed patterns, and identifiers found by bootstrapped contexts.

Entities of the fixed patterns are seeds. The words around a seed are a lexical
pattern; what else stands in such places is a candidate. Patterns and candidates
score each other over their graph, round by round, and what confident patterns hold
is added as further spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.rows import id_and_text, join_same, slices
from tabwright.session import materialize

#: Kinds in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")
_MAIL = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SIGN = re.compile(r"[0-9@]")
#: Digits in groups, also in parentheses, with single blanks between; a group that ends in a dot ends the run.
_RUN = re.compile(r"[+(]*+[0-9][0-9().-]*+(?:(?<=[0-9)]) \(*+[0-9][0-9().-]*+)*+")
_EDGE = ".,;:!?\"'()[]{}<>|="
#: Longest candidate and how far its neighbours are looked for, in code points.
_LONGEST, _NEAR = 64, 80


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (1 + place % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _mails(text: str) -> list[tuple[int, int]]:
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _MAIL.match(text, start) if start < at else None
        if m:
            found.append(m.span())
            done = m.end()
        else:
            done = at + 1  # nothing that starts up to here can match
        at = text.find("@", done)
    return found


def _addresses(text: str) -> list[tuple[int, int]]:
    found = []
    for m in _DOTTED.finditer(text):
        run = m.group()
        if run.count(".") < 3:
            continue
        parts, start = run.split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in four):
                found.append((start, end))
            start = end + 1
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Entities of the fixed patterns as (kind, start, end) in code points, by kind and start.

    Leftmost matches that do not overlap within a kind; a match that fails its check is
    dropped and not tried again. Time is linear in the text.
    """
    out = [("email", *s) for s in _mails(text)] if "@" in text else []
    if _SIGN.search(text) is None:
        return out
    out += [("ip", *s) for s in _addresses(text)]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", *m.span()))
    return out


def _contexts(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns of a place: two words before; one before and one after; the one before and the one after alone."""
    before = [w.strip(_EDGE).lower() for w in text[max(0, start - _NEAR) : start].split()][-2:]
    after = [w.strip(_EDGE).lower() for w in text[end : end + _NEAR].split()][:1]
    out = []
    if len(before) == 2 and all(before):
        out.append(f"{before[0]} {before[1]} _")
    if before and after and before[-1] and after[0]:
        out.append(f"{before[-1]} _ {after[0]}")
    if before and before[-1]:
        out.append(f"{before[-1]} _")
    if after and after[0]:
        out.append(f"_ {after[0]}")
    return out


def _run(text: str, start: int, limit: int) -> tuple[int, int, int]:
    """Start and end of the run of digit groups that begins here, empty where there are not two of them or they are
    too long for a candidate, and the place up to which no other begins."""
    m = _RUN.match(text, start, limit)
    if m is None:
        return start, start, start
    past = end = m.end()
    if end - start < 2 * _LONGEST:
        if end < len(text) and not text[end].isspace() and text[end] not in _EDGE:
            end = max(text.rfind(" ", start, end), start)  # the last group goes on as something else
        run = text[start:end].rstrip(_EDGE + "-")
        end = start + len(run)
        opened = run.count("(") - run.count(")")
        while opened > 0 and text[start] == "(":
            start, opened = start + 1, opened - 1
        if " " in run and end - start < _LONGEST:
            return start, end, past
    return start, start, past


def mentions(text: str) -> list[dict]:
    """Base entities, and outside of them runs of digit groups and tokens with a digit or an at sign, with their patterns."""
    base = base_spans(text)
    out = [
        {"kind": k, "start": s, "end": e, "value": text[s:e].lower(), "patterns": _contexts(text, s, e)} for k, s, e in base
    ]
    covered = sorted((s, e) for _, s, e in base)
    next_base, free, tried = 0, 0, 0
    for m in _SIGN.finditer(text):
        at = m.start()
        if at < free:
            continue
        while next_base < len(covered) and covered[next_base][1] <= at:
            next_base += 1
        if next_base < len(covered) and covered[next_base][0] <= at:
            free = covered[next_base][1]
            continue
        start, end = at, at + 1
        while start > max(free, at - _LONGEST) and not text[start - 1].isspace():
            start -= 1
        if start >= tried and at - start < _LONGEST:
            head = start + len(text[start:at]) - len(text[start:at].lstrip(_EDGE.replace("(", "")))
            limit = covered[next_base][0] if next_base < len(covered) else len(text)
            first, last, tried = _run(text, head, limit)  # the groups of a run that is too long stand alone
            if last > first:
                out.append({"kind": None, "start": first, "end": last, "value": text[first:last].lower(), "patterns": _contexts(text, first, last)})
                free = last
                continue
        while end < min(len(text), at + _LONGEST) and not text[end].isspace():
            end += 1
        free = end
        if end - start >= _LONGEST or any(s < end and e > start for s, e in covered[max(0, next_base - 1) : next_base + 1]):
            continue
        token = text[start:end]
        start += len(token) - len(token.lstrip(_EDGE))
        token = token.strip(_EDGE)
        if token:
            found = _contexts(text, start, start + len(token))
            out.append({"kind": None, "start": start, "end": start + len(token), "value": token.lower(), "patterns": found})
    return out


_MENTIONS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("value", T.StringType()),
            T.StructField("patterns", T.ArrayType(T.StringType())),
        ]
    )
)


@dataclass(frozen=True)
class Settings:
    """``support``: different seeds that a pattern needs; ``confidence``: share of a kind from which
    patterns and candidates count; ``rounds``: times that both sides score each other."""

    support: int = 3
    confidence: float = 0.75
    rounds: int = 3


def find_mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, row, mentions`` per row of ``docs``; ``row`` is a hash of the text and tells rows of one id apart."""
    frame = id_and_text(docs, id_col, text_col).withColumn("row", F.xxhash64("text"))
    schema = T.StructType([frame.schema["id"], frame.schema["row"], T.StructField("mentions", _MENTIONS)])
    kind = pa.list_(
        pa.struct(
            [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]
            + [("patterns", pa.list_(pa.string()))]
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [mentions(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("row"), pa.array(found, kind)], ["id", "row", "mentions"]
                )

    return frame.mapInArrow(run, schema)


def _scored(edges: DataFrame, seeds: DataFrame, contexts: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Confident patterns per kind, and confident instances per kind, after all rounds.

    A pattern's confidence in a kind is the mean belief in its different instances: 1 for
    seeds of the kind, 0 for those of another, for the rest what the last round gave. A
    candidate's belief is the mean over all its places, each counting with the surest of
    the patterns it stands in (0 where none has enough seeds), so a number that mostly
    stands elsewhere is refused though one of its places looks right. Edges are distinct,
    places with the same patterns are counted first, and sums are combined before the
    shuffle, so neither a frequent pattern nor a frequent number is a large group.
    """
    beliefs = seeds.withColumn("belief", F.lit(1.0))
    at = contexts.select("value", "context", "n", F.explode("patterns").alias("pattern"))
    everywhere = contexts.groupBy("value").agg(F.sum("n").alias("places"))
    patterns = None
    for step in range(settings.rounds):
        totals = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("instances"))
        held = edges.join(beliefs, "value").groupBy("pattern", "kind").agg(
            F.sum("belief").alias("mass"), F.sum(F.when(F.col("seed"), 1).otherwise(0)).alias("seeds")
        )
        patterns = materialize(
            held.join(totals, "pattern")
            .where(F.col("seeds") >= settings.support)
            .select("pattern", "kind", (F.col("mass") / F.col("instances")).alias("confidence")),
            f"pii-patterns-{step}",
        )
        surest = at.join(patterns, "pattern").groupBy("value", "context", "kind").agg(F.max(F.col("confidence") * F.col("n")).alias("mass"))
        new = (
            surest.groupBy("value", "kind")
            .agg(F.sum("mass").alias("mass"))
            .join(everywhere, "value")
            .select("value", "kind", (F.col("mass") / F.col("places")).alias("belief"))
            .where(F.col("belief") >= settings.confidence)
        )
        beliefs = materialize(
            seeds.withColumn("belief", F.lit(1.0)).unionByName(new.withColumn("seed", F.lit(False)).select("value", "kind", "seed", "belief")),
            f"pii-beliefs-{step}",
        )
    return patterns.where(F.col("confidence") >= settings.confidence), beliefs.where(~F.col("seed"))


def personal_data(
    docs: DataFrame, settings: Settings | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, spans`` for every row of ``docs``; ``spans`` is an array of (kind, start, end, added).

    Spans are in code points, the end exclusive, ordered by kind and start. Base entities
    always stay (``added`` false). A candidate is a token with a digit or an at sign, or
    a run of digit groups with single blanks, dashes, dots or parentheses between, up
    to 63 code points, that no base entity touches; it is added under the kind of the
    pattern it stands in when pattern and candidate both reach the confidence (the
    first kind in order when several do), see :func:`_scored`. Null and empty texts have no spans, repeated
    rows get the same spans, an empty table gives none; other columns play no part.

    Texts are read once; what is shuffled are mentions, a few per text.
    """
    s = settings or Settings()
    found = materialize(find_mentions(docs, id_col, text_col), "pii-mentions")
    places = found.select("id", "row", F.explode("mentions").alias("m")).select("id", "row", "m.*")
    edges = materialize(
        places.select("value", "kind", F.explode("patterns").alias("pattern")).distinct(), "pii-edges"
    )
    seeds = edges.where("kind IS NOT NULL").select("value", "kind").distinct().withColumn("seed", F.lit(True))
    contexts = materialize(
        places.where("kind IS NULL")
        .groupBy("value", "patterns")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(seeds.select("value").distinct(), "value", "left_anti")
        .withColumn("context", F.xxhash64("patterns")),
        "pii-contexts",
    )
    patterns, instances = _scored(edges.select("value", "pattern").distinct(), seeds, contexts, s)
    order = F.create_map(*[x for k, name in enumerate(KINDS) for x in (F.lit(name), F.lit(k))])
    added = (
        places.where("kind IS NULL")
        .drop("kind")
        .withColumn("pattern", F.explode("patterns"))
        .join(patterns.select("pattern", "kind"), "pattern")
        .join(instances.select("value", "kind"), ["value", "kind"])
        .groupBy("id", "row", "start", "end")
        .agg(F.min(order[F.col("kind")]).alias("place"))
        .groupBy("id", "row")
        .agg(F.collect_list(F.struct("place", "start", "end", F.lit(True).alias("added"))).alias("more"))
    )
    kept = F.filter("mentions", lambda m: m["kind"].isNotNull())
    base = F.transform(
        kept,
        lambda m: F.struct(
            order[m["kind"]].alias("place"), m["start"].alias("start"), m["end"].alias("end"), F.lit(False).alias("added")
        ),
    )
    none = F.array().cast("array<struct<place:int,start:int,end:int,added:boolean>>")
    merged = F.array_sort(F.concat(F.col("base"), F.coalesce("more", none)))
    names = F.array(*map(F.lit, KINDS))
    rows = found.select("id", "row", base.alias("base"))
    return join_same(rows, added, ["id", "row"], "left").select(
        "id",
        F.transform(
            merged,
            lambda m: F.struct(
                F.get(names, m["place"]).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["added"].alias("added")
            ),
        ).alias("spans"),
    )


def spans_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda m: F.concat_ws(":", m["kind"], m["start"].cast("string"), m["end"].cast("string"))), ","
    )
