"""Repeated byte strings across documents, by suffix arrays of the places that can repeat.

Every string of the threshold length holds a guaranteed fingerprint (the smallest hash
among its short substrings), so only strings around fingerprints that several
documents have can repeat. These are gathered by fingerprint, suffix-sorted in small
groups, and equal neighbours in the order tell the first document of each string.

Documents are worked on in parts of some megabytes. A part sends each different thing
once, to the bucket of its hash, and gets an answer for itself; it alone knows how often
and where it holds it. So what a frequent string costs grows with the parts, not with
the documents, and no group of documents meets in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.rows import id_and_text, marks, slices, text_buffer, with_mark
from tabwright.llm.suffix_groups import suffix_arrays
from tabwright.llm.words import _BYTE_CODES, _powers, mix
from tabwright.session import materialize


@dataclass(frozen=True)
class Settings:
    """``length`` of the strings in bytes; ``gram`` bytes under a fingerprint; bytes and rows of a part
    of the input that travels as one. The piece of a fingerprint is the text of all strings that select
    it there. A fingerprint with more than ``crowd`` different pieces in one part, or ``parts * crowd``
    in more than ``parts`` parts, is frequent: its strings travel by their content, each by itself. At
    most ``together`` different pieces are sorted as one text."""

    length: int = 50
    gram: int = 18
    part_bytes: int = 32 << 20
    part_rows: int = 60_000
    parts: int = 64
    crowd: int = 256
    together: int = 48


_STEP = 1 << 18  # bytes of text whose fingerprints are taken together: its arrays are small enough for a processor's cache
_KNOWN = 0xFFFF  # in place of a row number: the part itself has it in several documents
_SEVERAL = 0x8000  # in place of a piece's short hash: how many different pieces the part has
_FREQUENT = np.uint64(1 << 63)


def _slide(h: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every window of ``width`` values, by doubling."""
    out, span = h, 1
    while span * 2 <= width:
        out = pick(out[: len(out) - span], out[span:])
        span *= 2
    rest = width - span
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def _prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    power, inverse = _powers(max(len(data) + 1, 2).bit_length())
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * power[: len(data)], out=sums[1:])
    return sums, inverse


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.cumsum(counts)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(starts - total + counts, counts)


def _cuts(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal values."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return at, np.append(at[1:], len(values))


def anchors(
    data: np.ndarray, offsets: np.ndarray, s: Settings, prefix: tuple[np.ndarray, np.ndarray] | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints of texts that lie one after another: hash, place, the first and last string start that selects
    it, and the text's number. Places and starts count from the first text's start.
    ``prefix`` are the prefix sums of ``data``, where they are known.

    The string that starts at ``i`` selects the smallest hash of its grams, the first of
    equals. Equal strings so select equal hashes at equal offsets.
    """
    none = np.zeros(0, np.int64)
    size = np.diff(offsets)
    starts = np.maximum(size - s.length + 1, 0)  # strings per text
    if not starts.sum():
        return none.astype(np.uint64), none, none, none, none
    sums, inverse = prefix or _prefix_sums(data)
    grams = mix((sums[s.gram :] - sums[: -s.gram]) * inverse[: len(data) - s.gram + 1])
    grams[grams == 0] = 1
    width = s.length - s.gram + 1
    low = _slide(grams, width, np.minimum)
    start = _spread(offsets[:-1], starts)  # of the strings that end inside their text
    low_of = np.zeros(len(low), np.uint64)
    low_of[start] = low[start]
    value = np.concatenate([np.zeros(width - 1, np.uint64), low_of, np.zeros(width - 1, np.uint64)])
    place = np.flatnonzero(_slide(value, width, np.maximum) == grams)
    # the first place of the minimum: walk on where a place is selected by other strings only
    at = place[np.searchsorted(place, start)]
    wrong = np.flatnonzero(grams[at] != low[start])
    while len(wrong):
        at[wrong] = place[np.searchsorted(place, at[wrong] + 1)]
        wrong = wrong[grams[at[wrong]] != low[start[wrong]]]
    text = np.repeat(np.arange(len(size)), starts)
    new = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (text[1:] != text[:-1])))
    last = np.append(new[1:], len(at)) - 1
    return grams[at[new]], at[new], start[new], start[last], text[new]


def _split_print(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    return (h % np.uint64(buckets)).astype(np.int64), (h >> np.uint64(32)).astype(np.uint32)


def _pieces_of(keys: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """For each different one of the sorted ``keys`` the short hash of its piece, or how many different ones it has."""
    lead, _ = _cuts(keys)
    if not len(lead):
        return kinds
    out = kinds[lead]
    several = np.minimum.reduceat(kinds, lead) != np.maximum.reduceat(kinds, lead)
    no = np.repeat(np.arange(len(lead)), np.diff(np.append(lead, len(keys))))
    mixed = several[no]
    times = np.bincount(np.unique((no[mixed] << 16) | kinds[mixed]) >> 16, minlength=len(lead))
    out[several] = np.minimum(times[several], _SEVERAL - 1) | _SEVERAL
    return out


def _name(ids: list, rows: list) -> int:
    """A number for a part, from what it holds."""
    both = np.array([*rows, *ids], np.int64).view(np.uint64) + np.arange(2 * len(rows), dtype=np.uint64)
    return int(np.bitwise_xor.reduce(mix(both)) >> np.uint64(2))


def _packed(frame: DataFrame, keep: str) -> DataFrame:
    """``frame`` (id, row, text, ``keep``) with the text compressed for a shuffle, as ``packed``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                data, offsets = text_buffer(piece.column("text"))
                packed = [zlib.compress(data[a:b].tobytes(), 1) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), piece.column("row"), piece.column(keep), pa.array(packed, pa.binary())], ["id", "row", keep, "packed"]
                )

    return frame.select("id", "row", "text", keep).mapInArrow(run, f"id long, row long, {keep} {frame.schema[keep].dataType.simpleString()}, packed binary")


def _shared(frame: DataFrame, s: Settings, buckets: int) -> DataFrame:
    """``id, row, shared`` of documents with fingerprints that others have: sorted 64-bit numbers of bucket and
    short hash, the top bit set for frequent ones.

    What a part has in several documents it need not be told to be shared, so it sends
    such a fingerprint without a document. Each bucket answers which of a part's others
    came from elsewhere too, and which are frequent. A passage that stands in all parts
    is not: but for its ends all its pieces are the same.
    """
    columns = ["part", "bucket", "prints", "owners", "kinds", "ids", "rows"]
    lists = [pa.list_(pa.int64())] * 2

    def part_rows(h: np.ndarray, own: np.ndarray, kinds: np.ndarray, ids: list, rows: list) -> Iterator[pa.RecordBatch]:
        bucket, short = _split_print(h, buckets)
        key = (bucket.astype(np.uint64) << np.uint64(32)) | short
        o = np.argsort(key, kind="stable")  # the owners of each stay in order
        bucket, short, own, key = bucket[o], short[o], own[o], key[o]
        kinds = _pieces_of(key, kinds[o])
        # several times in one document counts once
        once = np.append(True, (own[1:] != own[:-1]) | (key[1:] != key[:-1])) if len(o) else np.zeros(0, bool)
        bucket, short, own, key = bucket[once], short[once], own[once], key[once]
        first = np.ones(len(own), bool)
        first[1:] = key[1:] != key[:-1]
        no = np.cumsum(first) - 1
        times = np.bincount(no)[no] if len(no) else no
        many = times > 1
        known = np.stack([bucket[many].astype(np.uint32), short[many], own[many].astype(np.uint32)], axis=1)
        to = np.where(many, _KNOWN, own).astype(np.uint16)[first]
        bucket, short = bucket[first], short[first]
        name, (at, end) = _name(ids, rows), _cuts(bucket)
        n = len(at)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * (n + 1), pa.int64()),
             pa.array([*bucket[at].tolist(), -1 - name], pa.int64()),
             pa.array([*[short[a:b].tobytes() for a, b in zip(at, end, strict=True)], known.tobytes()], pa.binary()),
             pa.array([*[to[a:b].tobytes() for a, b in zip(at, end, strict=True)], None], pa.binary()),
             pa.array([*[kinds[a:b].tobytes() for a, b in zip(at, end, strict=True)], None], pa.binary()),
             pa.array([*[None] * n, ids], lists[0]), pa.array([*[None] * n, rows], lists[1])],
            columns,
        )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, owners, kinds, ids, rows, volume = [], [], [], [], [], 0
        for batch in batches:
            for piece in slices(batch, size=_STEP):
                data, offsets = text_buffer(piece.column("text"))
                if ids and (volume >= s.part_bytes or len(ids) + piece.num_rows > s.part_rows):
                    yield from part_rows(np.concatenate(held), np.concatenate(owners), np.concatenate(kinds), ids, rows)
                    held, owners, kinds, ids, rows, volume = [], [], [], [], [], 0
                sums, inverse = _prefix_sums(data)
                h, at, first, last, text = anchors(data, offsets, s, (sums, inverse))
                content = (sums[last + s.length] - sums[first]) * inverse[first]
                held.append(h)
                owners.append((text + len(ids)).astype(np.uint16))
                kinds.append((mix(mix(content) + ((at - first) << 16 | last - first).astype(np.uint64)) >> np.uint64(49)).astype(np.uint16))
                ids += piece.column("id").to_pylist()
                rows += piece.column("row").to_pylist()
                volume += len(data)
        if ids:
            yield from part_rows(np.concatenate(held), np.concatenate(owners), np.concatenate(kinds), ids, rows)

    def compare(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        if bucket < 0:  # a part's own row
            return table.select(["part", "prints", "ids", "rows"]).rename_columns(["part", "found", "ids", "rows"])
        prints = [np.frombuffer(x, np.uint32) for x in table.column("prints").to_pylist()]
        owners = [np.frombuffer(x, np.uint16) for x in table.column("owners").to_pylist()]
        kinds = np.concatenate([np.frombuffer(x, np.uint16) for x in table.column("kinds").to_pylist()]).astype(np.int64)
        values, no, times = np.unique(np.concatenate(prints), return_inverse=True, return_counts=True)
        several = kinds >= _SEVERAL
        count = np.where(several, kinds - _SEVERAL, 1)
        crowded = np.zeros(len(values), bool)
        crowded[no[count > s.crowd]] = True
        # in so many parts, equal single pieces count once
        look = (times > s.parts)[no]
        once = np.unique((no[look & ~several] << 16) | kinds[look & ~several]) >> 16
        different = np.bincount(once, minlength=len(values))
        different += np.bincount(no[look & several], count[look & several], len(values)).astype(np.int64)
        frequent = (crowded | (different > s.parts * s.crowd))[no]
        shared = (times > 1)[no]
        out, at = [], 0
        for p, w in zip(prints, owners, strict=True):
            here = slice(at, at + len(p))
            use = np.where(w == _KNOWN, frequent[here], shared[here])
            owner = w[use].astype(np.uint32) | (frequent[here][use].astype(np.uint32) << np.uint32(31))
            out.append(np.stack([np.full(len(owner), bucket, np.uint32), p[use], owner], axis=1).tobytes())
            at += len(p)
        return pa.table(
            {"part": table.column("part"), "found": pa.array(out, pa.binary()), "ids": pa.nulls(len(out), lists[0]), "rows": pa.nulls(len(out), lists[1])}
        )

    def deal(table: pa.Table) -> pa.Table:
        every = list(zip(table.column("found").to_pylist(), table.column("ids").to_pylist(), table.column("rows").to_pylist(), strict=True))
        known, ids, rows = next(x for x in every if x[1] is not None)
        known = np.frombuffer(known, "<u4").reshape(-1, 3)
        told = np.concatenate([np.zeros((0, 3), np.uint32), *[np.frombuffer(x, "<u4").reshape(-1, 3) for x, i, _ in every if i is None]])

        def keys(found: np.ndarray) -> np.ndarray:
            return (found[:, 0].astype(np.uint64) << np.uint64(32)) | found[:, 1]

        frequent, owner = (told[:, 2] >> np.uint32(31)) == 1, told[:, 2] & np.uint32(_KNOWN)
        general = owner == _KNOWN
        mine = np.isin(keys(known), keys(told[general & frequent]))
        key = np.concatenate([keys(known) | np.where(mine, _FREQUENT, np.uint64(0)),
                              keys(told[~general]) | np.where(frequent[~general], _FREQUENT, np.uint64(0))])
        own = np.concatenate([known[:, 2], owner[~general]])
        o = np.lexsort((key, own))
        key, own = key[o], own[o]
        at, end = _cuts(own)
        return pa.table(
            {"id": pa.array([ids[k] for k in own[at]], pa.int64()), "row": pa.array([rows[k] for k in own[at]], pa.int64()),
             "shared": pa.array([key[a:b].tobytes() for a, b in zip(at, end, strict=True)], pa.binary())}
        )

    parts = frame.mapInArrow(send, "part long, bucket long, prints binary, owners binary, kinds binary, ids array<long>, rows array<long>")
    replies = parts.groupBy("bucket").applyInArrow(compare, "part long, found binary, ids array<long>, rows array<long>")
    return replies.groupBy("part").applyInArrow(deal, "id long, row long, shared binary")


def _strings(data: np.ndarray, offsets: np.ndarray, shared: np.ndarray, s: Settings, buckets: int) -> tuple[np.ndarray, ...]:
    """Group, name, text number, start, end and distance to the fingerprint of the strings around shared ones.

    A group holds what can be equal somewhere: the strings that select one fingerprint
    lie in one piece of text; of a frequent one each string is a piece and a group.
    """
    sums, inverse = _prefix_sums(data)
    h, at, first, last, text = anchors(data, offsets, s, (sums, inverse))
    bucket, short = _split_print(h, buckets)
    key = (bucket.astype(np.uint64) << np.uint64(32)) | short
    plain, often = np.isin(key, shared), np.isin(key | _FREQUENT, shared)
    count = (last - first + 1)[often]
    start = np.concatenate([first[plain], _spread(first[often], count)])
    end = np.concatenate([last[plain], _spread(first[often], count)]) + s.length
    content = mix((sums[end] - sums[start]) * inverse[start])
    name = mix(content + (end - start).astype(np.uint64))
    own = int(plain.sum())
    group = np.concatenate([h[plain], mix(name[own:] + np.uint64(1))])
    name[:own] = mix(name[:own] + group[:own])
    left = np.concatenate([(at - first)[plain], np.zeros(len(start) - own, np.int64)])
    return group, name, np.concatenate([text[plain], np.repeat(text[often], count)]), start, end, left


def _repeats(texts: DataFrame, s: Settings, buckets: int) -> DataFrame:
    """``id, row, ranges`` of ``texts(id, row, packed, shared)``: maximal byte ranges whose strings an earlier document
    has, packed as pairs of 64-bit numbers."""
    columns = ["part", "bucket", "block", "ids", "rows"]
    lists = [pa.list_(pa.int64())] * 2

    def part_rows(held: list, raws: list, ids: list, rows: list) -> Iterator[pa.RecordBatch]:
        group, name, doc, start, end, left, blob, begin = (np.concatenate([x[k] for x in held]) for k in range(8))
        order_of = np.array(ids, np.int64)
        bucket = (mix(group) % np.uint64(buckets)).astype(np.int64)
        o = np.lexsort((order_of[doc], name, group, bucket))
        doc, group, name, start, end, left, blob, begin, bucket = (x[o] for x in (doc, group, name, start, end, left, blob, begin, bucket))
        first = np.ones(len(o), bool)
        first[1:] = (name[1:] != name[:-1]) | (group[1:] != group[:-1])
        entry = np.cumsum(first) - 1
        lead = np.flatnonzero(first)
        size, lefts = (end - start)[lead].astype(np.uint16), left[lead].astype(np.uint16)
        lowest = order_of[doc[lead]]
        pieces = [raws[d][a:b] for d, a, b in zip(blob[lead].tolist(), start[lead].tolist(), end[lead].tolist(), strict=True)]
        short = (group[lead] >> np.uint64(32)).astype(np.uint32)
        part, (at, stop) = _name(ids, rows), _cuts(bucket[lead])
        blocks = [
            zlib.compress(np.int64(b - a).tobytes() + short[a:b].tobytes() + size[a:b].tobytes() + lefts[a:b].tobytes() + lowest[a:b].tobytes() + b"".join(pieces[a:b]), 1)
            for a, b in zip(at.tolist(), stop.tolist(), strict=True)
        ]
        own = [np.int64(len(doc)).tobytes(), entry.astype(np.uint32).tobytes(), doc.astype(np.uint16).tobytes(), (start - begin).astype(np.int64).tobytes(), (end - start).astype(np.uint16).tobytes()]
        n = len(at)
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * (n + 1), pa.int64()), pa.array([*bucket[lead][at].tolist(), -1 - part], pa.int64()),
             pa.array([*blocks, zlib.compress(b"".join(own), 1)], pa.binary()),
             pa.array([*[None] * n, ids], lists[0]), pa.array([*[None] * n, rows], lists[1])],
            columns,
        )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, raws, ids, rows, volume = [], [], [], [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                texts, size = [], 0
                while at + len(texts) < batch.num_rows and size < _STEP:
                    texts.append(zlib.decompress(batch.column("packed")[at + len(texts)].as_py()))
                    size += len(texts[-1])
                piece = batch.slice(at, len(texts))
                at += len(texts)
                if ids and (volume >= s.part_bytes // 2 or len(ids) + len(texts) > s.part_rows):
                    yield from part_rows(held, raws, ids, rows)
                    held, raws, ids, rows, volume = [], [], [], [], 0
                raw = b"".join(texts)
                offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
                # a fingerprint that one of these texts shares is shared by all of them that have it
                shared = np.unique(np.frombuffer(b"".join(piece.column("shared").to_pylist()), np.uint64))
                group, name, text, start, end, left = _strings(np.frombuffer(raw, np.uint8), offsets, shared, s, buckets)
                held.append((group, name, text + len(ids), start, end, left, np.full(len(text), len(raws)), offsets[text]))
                raws.append(raw)
                ids += piece.column("id").to_pylist()
                rows += piece.column("row").to_pylist()
                volume += len(raw)
        if ids:
            yield from part_rows(held, raws, ids, rows)

    def opened(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        raw = zlib.decompress(block)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        short = np.frombuffer(raw, np.uint32, n, 8)
        size, left = np.frombuffer(raw, np.uint16, n, 8 + 4 * n), np.frombuffer(raw, np.uint16, n, 8 + 6 * n)
        lowest = np.frombuffer(raw, np.uint8, 8 * n, 8 + 8 * n).copy().view(np.int64)
        at = 8 + 16 * n
        ends = (np.cumsum(size, dtype=np.int64) + at).tolist()
        return short, left, lowest, [raw[a:b] for a, b in zip([at, *ends[:-1]], ends, strict=True)]

    def solve(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:
            return table
        blocks = [opened(x) for x in table.column("block").to_pylist()]
        number: dict[tuple[int, int, bytes], int] = {}
        places = []
        for short, left, _, pieces in blocks:
            every = zip(short.tolist(), left.tolist(), pieces, strict=True)
            places.append(np.array([number.setdefault(k, len(number)) for k in every], np.int64))
        least = np.full(len(number), np.iinfo(np.int64).max)
        for at, (_, _, lowest, _) in zip(places, blocks, strict=True):
            np.minimum.at(least, at, lowest)
        runs = _earlier(list(number), least, s)
        out = []
        for at, (_, _, lowest, _) in zip(places, blocks, strict=True):
            flags = (lowest > least[at]).astype(np.uint8)
            inside = []
            for k in np.flatnonzero(flags == 0).tolist():
                run = runs.get(int(at[k]))
                if run:
                    flags[k] = 2
                    inside += [len(run) // 2, *run]
            out.append(zlib.compress(np.int64(len(flags)).tobytes() + flags.tobytes() + np.array(inside, np.uint16).tobytes(), 1))
        return table.set_column(2, "block", pa.array(out, pa.binary()))

    def apply(table: pa.Table) -> pa.Table:
        rows_of = sorted(zip(*[table.column(c).to_pylist() for c in ("bucket", "block", "ids", "rows")], strict=True), key=lambda r: r[0])
        raw = zlib.decompress(rows_of[0][1])
        ids, rows = rows_of[0][2:]
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        entry = np.frombuffer(raw, np.uint32, n, 8)
        doc = np.frombuffer(raw, np.uint16, n, 8 + 4 * n)
        start = np.frombuffer(raw, np.uint8, 8 * n, 8 + 6 * n).copy().view(np.int64)
        size = np.frombuffer(raw, np.uint16, n, 8 + 14 * n).astype(np.int64)
        flags, inside = [], []
        for _, block, _, _ in (r for r in rows_of if r[0] >= 0):
            answer = zlib.decompress(block)
            k = int(np.frombuffer(answer, np.int64, 1)[0])
            flags.append(np.frombuffer(answer, np.uint8, k, 8))
            inside.append(np.frombuffer(answer[8 + k :], np.uint16).astype(np.int64))
        flag, inside = np.concatenate(flags), np.concatenate(inside)
        order_of = np.array(ids, np.int64)
        lead = np.flatnonzero(np.append(True, entry[1:] != entry[:-1]))
        later = order_of[doc] > order_of[doc[lead]][entry]
        whole = later | (flag[entry] == 1)
        d, a, b = [doc[whole].astype(np.int64)], [start[whole]], [(start + size)[whole]]
        at, begin, stop = 0, np.append(lead, n), {}
        for e in np.flatnonzero(flag == 2).tolist():
            k = int(inside[at])
            stop[e] = inside[at + 1 : at + 1 + 2 * k].reshape(-1, 2)
            at += 1 + 2 * k
            for x in range(begin[e], begin[e + 1]):
                if not later[x]:
                    d.append(np.full(k, doc[x], np.int64))
                    a.append(start[x] + stop[e][:, 0])
                    b.append(start[x] + stop[e][:, 1] + s.length)
        d, a, b = np.concatenate(d), np.concatenate(a), np.concatenate(b)
        o = np.lexsort((a, d))
        d, a, b = d[o], a[o], b[o]
        far = np.int64(1) << np.int64(40)  # longer than any text
        reach = np.maximum.accumulate(b + d * far) if len(d) else b
        new = np.ones(len(d), bool)
        new[1:] = a[1:] + d[1:] * far > reach[:-1]
        head = np.flatnonzero(new)
        last = np.append(head[1:], len(d)) - 1 if len(head) else head
        pairs = np.stack([a[head], reach[last] - d[head] * far], axis=1) if len(head) else np.zeros((0, 2), np.int64)
        cut, end = _cuts(d[head])
        return pa.table(
            {"id": pa.array([ids[k] for k in d[head][cut]], pa.int64()), "row": pa.array([rows[k] for k in d[head][cut]], pa.int64()),
             "ranges": pa.array([pairs[x:y].tobytes() for x, y in zip(cut, end, strict=True)], pa.binary())}
        )

    kind = "part long, bucket long, block binary, ids array<long>, rows array<long>"
    answers = texts.mapInArrow(send, kind).groupBy("bucket").applyInArrow(solve, kind)
    return answers.groupBy("part").applyInArrow(apply, "id long, row long, ranges binary")


def _small_groups(members: list[int], pieces: list[tuple[int, int, bytes]], s: Settings) -> Iterator[list[tuple[int, int, bytes]]]:
    """The pieces (number, shift, bytes) of one group in groups of at most ``s.together`` different ones.

    A crowded group is cut in two by the distance from a string's start to the
    fingerprint, and each half by the bytes that all its strings share; what is equal so
    stays together. A half of a single distance holds a single string.
    """
    work = [(0, s.length - s.gram, [(k, 0, pieces[k][1], pieces[k][2]) for k in members])]
    while work:
        low, high, held = work.pop()
        if len(held) <= s.together or low == high or len({x[3] for x in held}) <= s.together:
            yield [(k, shift, text) for k, shift, _, text in held]
            continue
        middle = (low + high) // 2
        for a, b in ((low, middle), (middle + 1, high)):
            parts: dict[bytes, list] = {}
            for k, shift, left, text in held:
                near, far = max(a, left - len(text) + s.length), min(b, left)
                if near <= far:
                    part = (k, shift + left - far, far, text[left - far : left - near + s.length])
                    parts.setdefault(text[left - a : left - b + s.length], []).append(part)
            work += [(a, b, part) for part in parts.values() if len(part) > 1]


def _earlier(pieces: list[tuple[int, int, bytes]], least: np.ndarray, s: Settings) -> dict[int, list[int]]:
    """First and last start of the runs of strings that an earlier document than a piece's own has, by piece.

    ``pieces`` are (group, distance to the fingerprint, bytes), ``least`` their first documents.
    """
    before: dict[int, np.ndarray] = {}

    def sort(step: list[list[tuple[int, int, bytes]]]) -> None:
        flat = [x for group in step for x in group]
        own = least[[k for k, _, _ in flat]]
        # equal texts of a group are sorted once
        number: dict[tuple[int, bytes], int] = {}
        at = np.array([number.setdefault((no, text), len(number)) for no, group in enumerate(step) for _, _, text in group], np.int64)
        lowest = np.full(len(number), np.iinfo(np.int64).max)
        np.minimum.at(lowest, at, own)
        found = first_owners([text for _, text in number], lowest, np.array([no for no, _ in number], np.int64), s.length)
        for (k, shift, _), mine, no in zip(flat, own.tolist(), at.tolist(), strict=True):
            gone = found[no] < mine
            if gone.any():
                all_of_it = before.setdefault(k, np.zeros(len(pieces[k][2]) - s.length + 1, bool))
                all_of_it[shift : shift + len(gone)] |= gone

    order = sorted(range(len(pieces)), key=lambda k: pieces[k][0])
    groups = np.array([pieces[k][0] for k in order], np.int64)
    small = [group for at, end in zip(*_cuts(groups), strict=True) if end - at > 1 for group in _small_groups(order[at:end], pieces, s)]
    # texts of like length are sorted side by side
    step, volume = [], 0
    for group in sorted(small, key=len):
        step.append(group)
        volume += sum(len(x[2]) for x in group)
        if volume >= 1 << 20:
            sort(step)
            step, volume = [], 0
    if step:
        sort(step)
    out = {}
    for k, gone in before.items():
        edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
        out[k] = np.stack([edge[::2], edge[1::2] - 1], axis=1).ravel().tolist()
    return out


def first_owners(strings: list[bytes], lowest: np.ndarray, groups: np.ndarray, length: int) -> list[np.ndarray]:
    """For each start of a ``length``-byte string in ``strings``: the smallest ``lowest`` of a string of the same
    group that holds the same bytes somewhere. ``groups`` must not fall."""
    sizes = np.array([len(x) for x in strings])
    out: list[np.ndarray] = [np.full(max(n - length + 1, 0), m) for n, m in zip(sizes, lowest, strict=True)]
    cuts = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
    alone = np.diff(np.append(cuts, len(groups))) == 1
    sort = np.flatnonzero(~np.repeat(alone, np.diff(np.append(cuts, len(groups)))))
    if not len(sort):
        return out
    body = b"".join(strings[k] + b"\0" for k in sort)
    n = sizes[sort] + 1
    ends = np.cumsum(n)
    text = np.frombuffer(body, np.uint8).astype(np.int32) + 2
    text[ends - 1] = 1  # between strings
    same = groups[sort]
    last = np.append(same[1:] != same[:-1], True)
    text[ends[last] - 1] = 0  # the end of a block
    block_ends = ends[last]
    bounds = np.concatenate([[0], block_ends])
    valid = np.zeros(len(text), bool)  # starts of whole strings
    start = ends - n
    windows = np.maximum(sizes[sort] - length + 1, 0)
    total = np.cumsum(windows)
    at = np.arange(total[-1]) + np.repeat(start - total + windows, windows)
    valid[at] = True
    owner = np.repeat(lowest[sort], n)
    order = suffix_arrays(text, bounds)
    order = order[valid[order]]
    if not len(order):
        return out
    # eight letters at a time, the last eight overlapping
    raw = np.frombuffer(body, np.uint8).astype(np.uint64)
    eight = np.zeros(len(raw), np.uint64)
    for k in range(8):
        eight[: len(raw) - k] |= raw[k:] << np.uint64(8 * k)
    equal = np.ones(len(order) - 1, bool)
    for k in [*range(0, length - 8, 8), length - 8]:
        equal &= eight[order[1:] + k] == eight[order[:-1] + k]
    block = np.searchsorted(bounds, order, "right")
    equal &= block[1:] == block[:-1]
    run = np.concatenate([[0], np.cumsum(~equal)])
    heads = np.flatnonzero(np.append(True, ~equal))
    least = np.minimum.reduceat(owner[order], heads)[run]
    found = np.empty(len(text), lowest.dtype)
    found[order] = least
    for k, a, w in zip(sort, start, windows, strict=True):
        out[k] = found[a : a + w]
    return out


_LAST = (1 << 63) - 1


def drop_repeated_strings(
    docs: DataFrame, settings: Settings | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept`` for every row of ``docs``.

    ``kept`` holds the UTF-8 bytes of the text (empty for null) without every byte that a
    string of ``settings.length`` bytes covers which also starts in a document with a
    smaller id. Strings never cross documents and are judged on the input. ``n_spans``
    counts the maximal removed ranges. Ids must be integers; a null id counts as larger
    than all others. Rows that repeat an id are no earlier documents to each other. Texts
    shorter than a string lose nothing; an empty table gives none.

    Equal texts are found by two 64-bit hashes first: all but the one with the smallest
    id are covered in full. Documents are compared by fingerprints, about one per 17
    bytes of text at 8 bytes each, a part of the input at a time. Only strings around
    shared fingerprints are gathered, each different piece once per part. Groups that are
    suffix-sorted have about ``settings.parts * settings.crowd`` different pieces at most
    (told by hashes of 15 bits); the strings of fingerprints with more are compared by
    content, each in a group of its own.
    """
    s = settings or Settings()
    if not 8 <= s.gram <= s.length:
        raise ValueError("a gram has at least 8 bytes and no more than a string")
    spark = docs.sparkSession
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    frame = id_and_text(docs, id_col, text_col).select(F.coalesce(F.col("id").cast("long"), F.lit(_LAST)).alias("id"), "text")
    frame = frame.withColumn("row", F.xxhash64("text"))
    check = F.xxhash64(F.lit("check"), "text")
    copies = materialize(
        frame.select("id", "row", check.alias("check")).groupBy("row", "check").agg(F.min("id").alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1").select("row", "check", "keep"),
        "repeat-copies",
    )
    seen = with_mark(frame, "row", marks(copies, "row"))
    again = seen.where("marked").withColumn("check", check).join(copies, ["row", "check"], "left")
    first = seen.where("NOT marked").select("id", "text", "row").union(
        again.where("keep IS NULL OR id = keep").select("id", "text", "row")
    )
    shared = materialize(_shared(first, s, buckets).dropDuplicates(["id", "row"]), "repeat-shared")
    seen = with_mark(frame, "row", marks(shared, "row")).where("marked").withColumn("none", F.lit(None).cast("int"))
    texts = _packed(seen, "none").drop("none").join(shared, ["id", "row"])
    found = materialize(_repeats(texts, s, buckets).dropDuplicates(["id", "row"]), "repeat-ranges")

    touched = copies.select("row").union(found.select("row"))
    seen = with_mark(frame, "row", marks(touched, "row"))
    plain = seen.where("NOT marked")
    size = F.octet_length("text").cast("long")
    # what was found for a text hash: copies by the second hash, ranges by document
    told = copies.select("row", F.struct("check", "keep").alias("copy"), F.lit(None).cast("struct<id:bigint,ranges:binary>").alias("cut"))
    told = told.union(found.select("row", F.lit(None).cast(told.schema["copy"].dataType), F.struct("id", "ranges")))
    told = told.groupBy("row").agg(F.collect_list("copy").alias("same"), F.collect_list("cut").alias("cuts"))
    rest = _packed(seen.where("marked").withColumn("about", F.struct(check.alias("check"), size.alias("size"))), "about").join(told, "row", "left")
    keep = F.expr("get(filter(same, c -> c.check = about.check), 0).keep")
    whole = F.coalesce((F.col("id") > keep) & (F.col("about.size") >= s.length), F.lit(False))
    rest = rest.select(
        "id", F.col("about.size").alias("size"), whole.alias("whole"), F.expr("get(filter(cuts, c -> c.id = id), 0).ranges").alias("ranges"),
        F.when(~whole, F.col("packed")).alias("packed"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                removed, spans, kept = [], [], []
                for size, packed, ranges in zip(*[piece.column(c).to_pylist() for c in ("size", "packed", "ranges")], strict=True):
                    if packed is None:  # a copy
                        removed.append(size)
                        spans.append(1)
                        kept.append(b"")
                        continue
                    text = zlib.decompress(packed)
                    pairs = np.frombuffer(ranges or b"", np.int64).reshape(-1, 2)
                    edge = [0, *pairs.ravel().tolist(), len(text)]
                    kept.append(b"".join([text[a:b] for a, b in zip(edge[::2], edge[1::2], strict=True)]))
                    removed.append(len(text) - len(kept[-1]))
                    spans.append(len(pairs))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), piece.column("size"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                    ["id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    zero = F.lit(0).cast("long")
    untouched = plain.select("id", size.alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.col("text").cast("binary").alias("kept"))
    out = untouched.union(rest.mapInArrow(cut, "id long, n_bytes long, n_removed long, n_spans long, kept binary"))
    return out.withColumn("id", F.nullif(F.col("id"), F.lit(_LAST)))
