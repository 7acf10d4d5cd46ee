"""Flags that nobody closed, emitted at their own deadline by keyed state with event-time timers.

The one place outside the corpus operators that runs Python in its tasks: built-in streaming
operators either wait for a whole slot or pair every flag with every closer of its window.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from openloop.functions.clock import DAY_US

# Instants in the text of a carried row keep their microseconds.
_INSTANTS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
OUT = "us long, row string"
# Kinds of chunks in a state.
WAITING, CLOSING = 0, 1
# Entries of a chunk at most, so that no chunk grows with its key.
CHUNK = 1024
# Groups that keys and their shards are dealt out to. It is kept for life with the checkpoint.
GROUPS = 1 << 14


class Deadlines(StatefulProcessor):
    """State of one group of keys: flags that wait, in chunks of one key, and the closing instants
    that a flag still to come may need, in chunks of all keys of the group; a chunk is found by
    its key, first and last instant. Both are let go as the watermark passes them.

    Each call of the state goes to the JVM and back, and so does each group. So a batch lists the
    chunks of a group once, writes what it adds as whole chunks, reads only those it has to
    compare with, and registers one timer, for the earliest deadline; a timer that fires
    registers the next one.
    """

    def __init__(self, width_us: int) -> None:
        self.width = width_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getMapState(
            "held",
            "kind int, key string, first long, last long, number long",
            "us binary, texts array<string>",
        )

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        flags, closing = {}, {}
        for frame in rows:
            columns = (frame[c].tolist() for c in ("key", "us", "opens", "row"))
            for owner, us, opens, row in zip(*columns):
                if opens:
                    flags.setdefault(owner, []).append((us, row))
                else:
                    closing.setdefault(owner, set()).add(us)
        waiting, closers = self._listed()
        known = self._known(closers, [us for came in flags.values() for us, _ in came], closing)
        for owner, came in closing.items():
            new = sorted(came)
            for chunk in waiting.get(owner, []):
                if self._reached(chunk[2], chunk[3], new):
                    entries = self._entries_of(chunk)
                    self.held.removeKey(chunk)
                    self._add(WAITING, owner, [x for x in entries if not self._closed(x[0], new)])
        firsts = []
        for owner, came in flags.items():
            at = sorted(known.get(owner, set()) | closing.get(owner, set()))
            left = sorted(x for x in came if not self._closed(x[0], at))
            self._add(WAITING, owner, left)
            firsts += [us for us, _ in left[:1]]
        self._wake(firsts)
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        # Flags of the next batch are no older than the watermark of this one.
        kept = [
            (us, owner)
            for owner, came in closing.items()
            for us in came
            if us >= passed and us not in known.get(owner, ())
        ]
        self._add(CLOSING, "", sorted(kept))
        self._let_go(closers, passed)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting, closers = self._listed()
        self._let_go(closers, passed)
        due, firsts = [], []
        for owner, chunks in waiting.items():
            for chunk in chunks:
                if chunk[2] + self.width >= passed:
                    firsts.append(chunk[2])
                    continue
                entries = self._entries_of(chunk)
                rest = [x for x in entries if x[0] + self.width >= passed]
                due += entries[: len(entries) - len(rest)]
                self.held.removeKey(chunk)
                self._add(WAITING, owner, rest)
                firsts += [us for us, _ in rest[:1]]
                if len(due) >= CHUNK:
                    yield _frame(due)
                    due = []
        if due:
            yield _frame(due)
        self._wake(firsts)

    def close(self) -> None:
        pass

    def _listed(self) -> tuple[dict[str, list[tuple]], list[tuple]]:
        """The chunks of flags, by key, and those of closing instants."""
        waiting, closers, self.number = {}, [], 0
        for chunk in self.held.keys():
            if chunk[0] == WAITING:
                waiting.setdefault(chunk[1], []).append(chunk)
            else:
                closers.append(chunk)
            self.number = max(self.number, chunk[4] + 1)
        return waiting, closers

    def _known(
        self, closers: list[tuple], flags: list[int], closing: dict[str, set[int]]
    ) -> dict[str, set[int]]:
        """Stored closing instants by key, from the chunks that may close one of ``flags`` or
        repeat one of ``closing``."""
        spans = [(min(flags), max(flags) + self.width)] if flags else []
        if closing:
            spans.append((min(map(min, closing.values())), max(map(max, closing.values()))))
        found = {}
        for chunk in closers:
            if any(chunk[2] <= high and chunk[3] >= low for low, high in spans):
                for us, owner in self._entries_of(chunk):
                    found.setdefault(owner, set()).add(us)
        return found

    def _entries_of(self, chunk: tuple) -> list[tuple[int, str]]:
        packed, texts = self.held.getValue(chunk)
        us = array("q")
        us.frombytes(bytes(packed))
        return list(zip(us, texts))

    def _add(self, kind: int, owner: str, entries: list[tuple[int, str]]) -> None:
        """Stores entries, which ascend."""
        for start in range(0, len(entries), CHUNK):
            us, texts = zip(*entries[start : start + CHUNK])
            chunk = (kind, owner, us[0], us[-1], self.number)
            self.held.updateValue(chunk, (array("q", us).tobytes(), list(texts)))
            self.number += 1

    def _let_go(self, closers: list[tuple], passed: int) -> None:
        for chunk in closers:
            if chunk[3] < passed:
                self.held.removeKey(chunk)

    def _wake(self, firsts: list[int]) -> None:
        if firsts:
            self.handle.registerTimer((min(firsts) + self.width) // 1000 + 1)

    def _reached(self, first: int, last: int, closers: list[int]) -> bool:
        place = bisect_left(closers, first)
        return place < len(closers) and closers[place] <= last + self.width

    def _closed(self, us: int, closers: list[int]) -> bool:
        return self._reached(us, us, closers)


def _frame(flags: list[tuple[int, str]]) -> pd.DataFrame:
    return pd.DataFrame({"us": [us for us, _ in flags], "row": [row for _, row in flags]})


def never_closed_live(
    findings: DataFrame,
    keys: list[str],
    opens: Column,
    closes: Column,
    days: int = 2,
    lateness_hours: int = 1,
    spread: int = 8,
    groups: int = GROUPS,
) -> DataFrame:
    """Flags with no closer of the same keys in [t, t + days], each emitted once, as soon as the
    watermark (the newest event less ``lateness_hours``) has passed t + days.

    Each flag is due at a deadline of its own. A closing instant takes off the flags that wait for
    it and is kept, once however often it occurs, while a late flag may still need it. ``spread``
    divides the flags of one key over that many states; closing instants go to each of them.
    The keys of all shards are dealt out to ``groups`` states, since a state costs a batch more
    than a row does. A closer later than ``lateness_hours`` cannot take back an emitted flag; the batch report over
    the stored findings reconciles those. The query needs a state store with column families, see
    :data:`STATE_STORE`.
    """
    width = days * DAY_US
    # Null keys never meet a closer, as in a join; their flags wait for the deadline only.
    known = F.col("event_time").isNotNull()
    for key in keys:
        known = known & F.col(key).isNotNull()
    us = F.unix_micros("event_time")
    shard = F.pmod(F.xxhash64(us), F.lit(spread)).cast("int")
    # Other events go no further but move the watermark: a filter would be put before it, which
    # this choice, since it looks at the event time, is not.
    shards = F.when(opens & F.col("event_time").isNotNull(), F.array(shard))
    shards = shards.when(closes & known, F.sequence(F.lit(0), F.lit(spread - 1)))
    row = F.to_json(F.struct(*findings.columns), {**_INSTANTS, "ignoreNullFields": "false"})
    # As text, since a key column with nulls reaches Python as another type.
    key = F.to_json(F.struct(*keys), {**_INSTANTS, "ignoreNullFields": "false"})
    marks = (
        findings.withWatermark("event_time", f"{lateness_hours} hours")
        .select(
            key.alias("key"),
            F.explode(shards).alias("shard"),
            "event_time",
            us.alias("us"),
            opens.alias("opens"),
            F.when(opens, row).otherwise("").alias("row"),
        )
    )
    dealt = F.pmod(F.xxhash64("key", "shard"), F.lit(groups)).cast("int")
    found = marks.withColumn("dealt", dealt).drop("shard").groupBy("dealt").transformWithStateInPandas(
        Deadlines(width), OUT, "append", "EventTime"
    )
    parsed = F.from_json("row", findings.schema, _INSTANTS).alias("r")
    return found.select(parsed).select("r.*").select(*findings.columns)


# Fixed value: the state store that holds several states and timers of one operator.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
