"""Records of a stream that wait for their labels inside the stream, for a bounded time."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Records travel and wait as text, to the microsecond.
_FORMAT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


#: Waiting records of one entry of the state.
_CHUNK = 1024


class _Waiting(StatefulProcessor):
    """Per part of the keys the records without a label, each with its key and the time it is due, and the labels known.

    A call of the state costs far more than a row, so the keys of a part share their
    calls: records wait in chunks, labels in one value, which also has the time of the
    part's next timer.
    """

    def __init__(self, timeout_ms: int, keep: bool):
        self.timeout_ms, self.keep = timeout_ms, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", "rows string")
        self.about = handle.getValueState("about", "labels string, due bigint")

    def _waiting(self) -> Iterator[list]:
        for (text,) in self.pending.get():
            yield from json.loads(text)

    def _chunks(self, rows: list) -> list[tuple]:
        return [(json.dumps(rows[i : i + _CHUNK]),) for i in range(0, len(rows), _CHUNK)]

    def _replace(self, rows: list) -> None:
        if rows:
            self.pending.put(self._chunks(rows))
        else:
            self.pending.clear()

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        about = self.about.get()
        known, timer = (json.loads(about[0]), about[1]) if about is not None else ({}, None)
        fresh, asked, dues, told = set(), [], [], False
        for r in rows:
            name, due = r["key"], r["at_ms"] + self.timeout_ms
            if r["record"] is not None:
                asked.append((name, r["record"], due))
                continue
            told = True
            dues.append(due)
            best = known.get(name)
            if best is None:
                fresh.add(name)
                known[name] = [r["label"], r["rank"], due]
                continue
            if (r["rank"], r["label"]) < (best[1], best[0]):
                best[:2] = r["label"], r["rank"]
            best[2] = max(best[2], due)
        waits = [w for w in asked if w[0] not in known]
        dues += [due for _, _, due in waits]
        soonest = min(dues, default=None)
        sooner = soonest is not None and (timer is None or soonest < timer)
        if sooner:
            self.handle.registerTimer(soonest)
        if told or sooner:
            self.about.update((json.dumps(known), soonest if sooner else timer))
        for name, record, _ in asked:
            if name in known:
                yield Row(record=record, label=known[name][0])
        rest, found = [], False
        if fresh and about is not None:
            for w in self._waiting():
                if w[0] in fresh:
                    found = True
                    yield Row(record=w[1], label=known[w[0]][0])
                else:
                    rest.append(w)
        if found:
            self._replace(rest + waits)
        elif waits:
            self.pending.appendList(self._chunks(waits))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        about = self.about.get()
        if about is None or about[1] > now:  # an earlier timer of this batch did it
            return
        known = {name: best for name, best in json.loads(about[0]).items() if best[2] > now}
        rest, gone = [], False
        for w in self._waiting():
            if w[2] > now:
                rest.append(w)
                continue
            gone = True
            if self.keep:
                yield Row(record=w[1], label=None)
        if gone:
            self._replace(rest)
        dues = [best[2] for best in known.values()] + [due for _, _, due in rest]
        if not dues:
            self.about.clear()
            return
        self.handle.registerTimer(min(dues))
        self.about.update((json.dumps(known), min(dues)))


def label_in_stream(
    records: DataFrame,
    labels: DataFrame,
    key: str,
    label: str,
    labelled_at: str,
    timeout: str = "7 days",
    lateness: str = "1 hour",
    timestamp: str = "timestamp",
    prediction: str = "prediction",
    identity: tuple[str, ...] = ("request_id", "position"),
    keep_unlabelled: bool = False,
    spread: int = 1,
    parts: int = 4096,
) -> DataFrame:
    """Streaming ``records`` with ``label``, each as soon as its label comes on the stream ``labels``.

    ``labels`` holds the key, the label, the time ``labelled_at`` and perhaps a ``rank``:
    of several labels that a key has got the lowest rank counts, then the smallest label.
    A record waits in the state until the watermark passes its time by ``timeout``; then it
    is dropped, or given a null label with ``keep_unlabelled``. A label waits as long for
    records that come after it. So the state holds what the timeout spans, and no more.
    Repeated records are dropped within ``lateness``; records without prediction are
    dropped, those with a null key as well, as no label can come for them.

    ``spread`` deals the records of a key to so many groups, with a copy of each label, for
    keys that hold a large part of the stream. The keys are hashed to ``parts`` that share
    their calls of the state; what waits in a part is read when a label comes for it or a
    row is due, so some hundred waiting records a part are a good size. Needs the RocksDB
    state store; ``parts`` stays as it is for the life of a checkpoint.
    """
    timed = records.withColumn(prediction, F.col(prediction).cast("int"))
    timed = timed.where(F.col(prediction).isNotNull() & F.col(key).isNotNull()).withWatermark(timestamp, lateness)
    once = timed.dropDuplicatesWithinWatermark(list(identity))
    text = F.to_json(F.struct(*once.columns), _FORMAT)
    salt = F.pmod(F.xxhash64(*identity), F.lit(spread)).cast("int")
    asking = once.select(
        F.col(key).cast("string").alias("key"), salt.alias("salt"), text.alias("record"),
        F.lit(None).cast("int").alias("label"), F.lit(None).cast("int").alias("rank"), F.col(timestamp).alias("at"),
    )
    rank = F.col("rank").cast("int") if "rank" in labels.columns else F.lit(0)
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).withColumn("_at", F.col(labelled_at).cast("timestamp"))
    telling = known.withWatermark("_at", lateness).select(
        F.col(key).cast("string").alias("key"), F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("salt"),
        F.lit(None).cast("string").alias("record"), F.col(label).cast("int").alias("label"), rank.alias("rank"), F.col("_at").alias("at"),
    )
    both = asking.union(telling).withColumn("at_ms", F.unix_millis("at"))
    both = both.withColumn("part", F.pmod(F.xxhash64("key", "salt"), F.lit(parts)).cast("int")).drop("salt")
    millis = _milliseconds(records, timeout)
    found = both.groupBy("part").transformWithState(_Waiting(millis, keep_unlabelled), "record string, label int", "Append", "EventTime")
    parsed = found.select(F.from_json("record", once.schema, _FORMAT).alias("r"), F.col("label").alias("_label"))
    return parsed.select("r.*", F.col("_label").alias(label))


def _milliseconds(df: DataFrame, interval: str) -> int:
    epoch = F.lit("1970-01-01 00:00:00+00:00").cast("timestamp")
    return df.sparkSession.range(1).select(F.unix_millis(epoch + F.expr(f"INTERVAL {interval}"))).first()[0]
