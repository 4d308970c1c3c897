"""Repeated and changed mails of a stream: each content of a message once.

A mailbox that is synchronised again and again brings the same messages many times, and some
of them changed. What was seen of a message is state: the contents by their fingerprint, how many
there were and until when they are known. Once the watermark is a ``horizon`` past the last of
them, the message is forgotten.

A call to the state costs far more than a row, so messages are dealt to buckets by hash, and a
bucket's state is read and added to as a whole, a few calls for each bucket and micro-batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import (
    DoubleType,
    FloatType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from postmill.session import ship_package

DELAY = "10 minutes"
HORIZON_SECONDS = 3600
BUCKETS = 2_048  # of messages, by hash; fixed by the state of a stream that has begun
SWEEPS = 4  # in a horizon
PORTION = 10_000  # entries of a state row
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Versions(StatefulProcessor):
    """State of a bucket: a list of portions (message, fingerprint, until), the latest ``until`` of a
    message holds for all its fingerprints; and about the bucket the time of its timer (0: none), the
    watermark up to which messages are forgotten, and the one at which they were last taken out.

    The timer is never later than the first message to forget. When it fires, the watermark is noted,
    and messages are taken out at most ``SWEEPS`` times in a horizon.
    """

    def __init__(self, message: str, millis: str, horizon_ms: int, columns: list[str]) -> None:
        self.message, self.millis, self.horizon_ms, self.columns = message, millis, horizon_ms, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getListState(
            "seen", "message array<string>, fingerprint array<string>, until array<bigint>"
        )
        self.about = handle.getValueState("about", "due bigint, forgotten bigint, swept bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        due, forgotten, swept = self.about.get() or (0, 0, 0)
        known, until, written, dead = self._known(forgotten)
        latest: dict[str, int] = {}
        # Of each content that is new, the time, row and place of the earliest row.
        first: dict[tuple[str, str], tuple[int, pd.DataFrame, int]] = {}
        for batch in rows:
            columns = (batch[self.message].tolist(), batch["fingerprint"].tolist(), batch[self.millis].tolist())
            picked = {}
            for number, (message, content, time) in enumerate(zip(*columns, strict=True)):
                if time > latest.get(message, time - 1):
                    latest[message] = time
                if content in known.get(message, ()):
                    continue
                pair = (message, content)
                best = picked.get(pair)
                if best is None:
                    best = first.get(pair)
                    if best is None or time < best[0]:
                        picked[pair] = (time, number)
                elif time < best[0]:
                    picked[pair] = (time, number)
            # Only the rows that may go out are held.
            held = batch.iloc[[number for _, number in picked.values()]]
            for place, (pair, (time, _)) in enumerate(picked.items()):
                first[pair] = (time, held, place)
        added = [(m, c) for m, c in sorted(first, key=lambda pair: first[pair][0])]
        yield from self._out(added, first, known)
        fresh = set()
        for message, content in added:
            known.setdefault(message, {})[content] = None
            fresh.add(message)
        moved = []
        for message, time in latest.items():
            if time + self.horizon_ms > until.get(message, 0):
                until[message] = time + self.horizon_ms
                if message not in fresh:
                    moved.append((message, None))
        contents = sum(map(len, known.values()))
        if dead or written > 2 * contents:
            self._put(known, until)
        elif added or moved:
            for portion in _portions([(m, c, until[m]) for m, c in added + moved]):
                self.seen.appendValue(portion)
        least = min(until[message] for message in latest)
        if not due or least < due:
            if due:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(least)
            due = least
        self.about.update((due, forgotten, swept))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        _, _, swept = self.about.get()
        if now - swept < self.horizon_ms // SWEEPS:
            # Whenever the watermark moves on, so that it is known up to where messages are forgotten.
            due = now + 1
        else:
            known, until, _, _ = self._known(now)
            if not known:
                self.seen.clear()
                self.about.clear()
                return iter([])
            self._put(known, until)
            due, swept = min(until.values()), now
        self.handle.registerTimer(due)
        self.about.update((due, now, swept))
        return iter([])

    def _known(self, forgotten: int) -> tuple[dict[str, dict[str, None]], dict[str, int], int, bool]:
        """Contents and end of the messages that are not forgotten, the number of entries, and whether
        some are to be taken out."""
        known: dict[str, dict[str, None]] = {}
        until: dict[str, int] = {}
        written = 0
        for portion in self.seen.get():
            for message, content, end in zip(*portion, strict=True):
                written += 1
                contents = known.setdefault(message, {})
                if content is not None:
                    contents[content] = None
                if end > until.get(message, end - 1):
                    until[message] = end
        gone = [message for message, end in until.items() if end <= forgotten]
        for message in gone:
            del known[message], until[message]
        return known, until, written, bool(gone)

    def _put(self, known: dict[str, dict[str, None]], until: dict[str, int]) -> None:
        self.seen.put(_portions([(m, c, until[m]) for m, contents in known.items() for c in contents]))

    def _out(self, added, first, known) -> Iterator[pd.DataFrame]:
        count = {message: len(known.get(message, ())) for message, _ in added}
        places: dict[int, tuple[pd.DataFrame, list[int], list[int]]] = {}
        for pair in added:
            count[pair[0]] += 1
            _, held, place = first[pair]
            _, numbers, versions = places.setdefault(id(held), (held, [], []))
            numbers.append(place)
            versions.append(count[pair[0]])
        for held, numbers, versions in places.values():
            found = held.iloc[numbers].copy()
            found["version"] = versions
            found["kind"] = ["new" if v == 1 else "changed" for v in versions]
            yield found[self.columns]

    def close(self) -> None:
        pass


def _portions(entries: list[tuple[str, str | None, int]]) -> list[tuple[list, list, list]]:
    parts = (entries[start : start + PORTION] for start in range(0, len(entries), PORTION))
    return [tuple(map(list, zip(*part, strict=True))) for part in parts]


def _text(mails: DataFrame, key: str) -> Column:
    """The key as a string, equal where keys are equal."""
    column, kind = F.col(f"`{key}`"), mails.schema[key].dataType
    if isinstance(kind, StringType):
        return column
    if isinstance(kind, TimestampType):
        return F.unix_micros(column).cast("string")
    if isinstance(kind, DoubleType | FloatType):
        column = column + F.lit(0).cast(kind)  # one zero, not two
    return F.to_json(F.struct(column), {"ignoreNullFields": "false"})


def mail_versions(
    mails: DataFrame,
    key: str,
    at: str,
    content: list[str],
    delay: str = DELAY,
    horizon_seconds: int = HORIZON_SECONDS,
) -> DataFrame:
    """The rows of a stream whose ``content`` columns were not seen yet under their ``key``.

    Added are ``fingerprint`` (of the content), ``version`` (from 1, in the order of arrival, and
    within a micro-batch of the time ``at``) and ``kind``: ``new`` for the first version, else ``changed``.
    Rows that are later than ``delay`` behind the latest are dropped. A message that was not seen
    again is forgotten ``horizon_seconds`` after its last time, by the watermark; if it comes
    again after that, it is new. Rows without a key or time are left out.

    Rows are dealt by a hash of the key to ``BUCKETS`` buckets; state is bounded by the messages within
    the horizon, not by the stream. A micro-batch reads the state of the buckets that it has rows for.
    """
    spark = mails.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    print_ = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in content]), {"ignoreNullFields": "false"}), 256)
    names = []
    for name in ("millis", "message", "bucket"):
        while name in (*mails.columns, "fingerprint"):
            name += "_"
        names.append(name)
    millis, message, bucket = names
    marked = (
        mails.where(F.col(f"`{key}`").isNotNull() & F.col(f"`{at}`").isNotNull())
        .withWatermark(at, delay)
        .withColumn("fingerprint", print_)
    )
    fields = marked.schema.fields
    marked = marked.withColumn(millis, F.unix_millis(F.col(f"`{at}`"))).withColumn(message, _text(mails, key))
    marked = marked.withColumn(bucket, F.pmod(F.xxhash64(message), F.lit(BUCKETS)).cast("int"))
    schema = StructType(
        [
            *fields,
            StructField("version", IntegerType()),
            StructField("kind", StringType()),
        ]
    )
    return marked.groupBy(bucket).transformWithStateInPandas(
        statefulProcessor=_Versions(message, millis, horizon_seconds * 1000, schema.names),
        outputStructType=schema,
        outputMode="append",
        timeMode="eventTime",
    )
