"""Per-key processing in event-time order on an unordered stream.

Events wait in keyed state until the watermark has passed their slot of event
time. What arrives for a key in one trigger is sorted and written in runs, and the
key has one timer, that of its first slot; it hands on the events of all slots the
watermark has passed, in (time, sequence) order. So a key costs a few calls to the
state store a trigger and one per run, not some per event or slot. Only a run across
the watermark is written again. What a step remembers is a short head and a tape:
items in numbered blocks of map state, of which a trigger reads and writes only
those it touches.

The last events of an exhausted source leave once a closing event far ahead moves
the watermark past them. Rows later than the watermark never reach a step; they
can be counted per key and trigger. A stream without late rows gives exactly what
a batch over the same input gives.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from heapq import heappop, heappush, heapreplace
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BLOCK = 256  # items of a tape in one entry of the state store
RUN = 256  # waiting events in one entry
ROWS_OUT = 10_000  # rows that leave at once


class Tape:
    """Items numbered from ``low`` to ``high``: added and taken at the end, forgotten from the start."""

    def __init__(self, blocks: Any, low: int, high: int):
        self.blocks, self.low, self.high = blocks, low, high
        self.held: dict[int, list] = {}
        self.changed: set[int] = set()

    def _block(self, number: int) -> list:
        if number not in self.held:
            found = self.blocks.getValue((number,)) if self.blocks.containsKey((number,)) else None
            self.held[number] = pickle.loads(found[0]) if found else []
        return self.held[number]

    def __len__(self) -> int:
        return self.high - self.low

    def __getitem__(self, place: int) -> Any:
        return self._block(place // BLOCK)[place % BLOCK]

    def append(self, item: Any) -> None:
        block = self._block(self.high // BLOCK)
        del block[self.high % BLOCK:]
        block.append(item)
        self.changed.add(self.high // BLOCK)
        self.high += 1

    def pop(self) -> Any:
        self.high -= 1
        return self[self.high]

    def forget_before(self, place: int) -> None:
        for number in range(self.low // BLOCK, place // BLOCK):
            self._drop(number)
        self.low = place

    def _drop(self, number: int) -> None:
        if self.blocks.containsKey((number,)):
            self.blocks.removeKey((number,))
        self.held.pop(number, None)
        self.changed.discard(number)

    def save(self) -> None:
        if not len(self):
            for number in range(self.low // BLOCK, max([self.high // BLOCK, *self.changed]) + 1):
                self._drop(number)
        for number in sorted(self.changed):
            if self.low // BLOCK <= number <= max(self.high - 1, self.low) // BLOCK:
                self.blocks.updateValue((number,), (pickle.dumps(self.held[number]),))
            else:
                self._drop(number)
        self.changed.clear()


# step(head, tape, event) -> (head, rows); a falsy head with an empty tape is nothing to remember.
Step = Callable[[Any, Tape, tuple], tuple[Any, list[tuple]]]


class _Ordered(StatefulProcessor):
    def __init__(self, step: Step, names: list[str], slot_us: int, late: str | None, stamp: str | None):
        self.step, self.names, self.slot_us, self.late, self.stamp = step, names, slot_us, late, stamp

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.index = handle.getValueState("index", "runs binary, timer long")
        self.waiting = handle.getMapState("waiting", "number long", "rows binary")
        self.head = handle.getValueState("head", "low long, high long, head binary")
        self.blocks = handle.getMapState("tape", "number long", "items binary")

    def _timer(self, us: int) -> int:
        """The timer of the slot of an event; it fires once the watermark is beyond the slot."""
        return (us // self.slot_us + 1) * self.slot_us // 1000 - 1

    def _wait(self, runs: list[tuple[int, int]], events: list[tuple]) -> None:
        """Write sorted events as runs of up to RUN events; ``runs`` holds the first time and the number of each."""
        number = 1 + max((n for _, n in runs), default=-1)
        for start in range(0, len(events), RUN):
            self.waiting.updateValue((number,), (pickle.dumps(events[start:start + RUN]),))
            runs.append((events[start][0], number))
            number += 1

    def _due(self, runs: list[tuple[int, int]], later: list[tuple[int, int]], fired: int) -> Iterator[tuple]:
        """Events of the slots up to ``fired``, in order; a run is read when its first event is next. The others go to ``later``."""
        open_runs: list[tuple] = []
        for first, number in [*sorted(runs), (None, None)]:
            while open_runs and (first is None or open_runs[0][0][0] < first):
                _, own, place, run = open_runs[0]
                yield run[place]
                if place + 1 < len(run):
                    heapreplace(open_runs, (run[place + 1][:2], own, place + 1, run))
                else:
                    heappop(open_runs)
            if first is None:
                break
            if self._timer(first) > fired:
                later.append((first, number))
                continue
            run = pickle.loads(self.waiting.getValue((number,))[0])
            due = next((i for i, e in enumerate(run) if self._timer(e[0]) > fired), len(run))
            if due < len(run):
                self.waiting.updateValue((number,), (pickle.dumps(run[due:]),))
                later.append((run[due][0], number))
            else:
                self.waiting.removeKey((number,))
            heappush(open_runs, (run[0][:2], number, 0, run[:due]))

    def _await(self, runs: list[tuple[int, int]], timer: int | None) -> None:
        """Remember the runs; the key's one timer (``timer``, if it stands) is that of the first slot that waits."""
        if not runs:
            self.index.clear()
            return
        due = self._timer(min(runs)[0])
        if due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)
        self.index.update((pickle.dumps(runs), due))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        late, held, runs = 0, None, []
        for batch in rows:
            if batch.empty:  # has no columns
                continue
            # By place: Spark does not keep the name of a computed column. The key comes first, the time last.
            seq, *columns, us = (batch.iloc[:, k].tolist() for k in range(1, batch.shape[1]))
            arrived = [row for row in zip(us, seq, *columns) if row[0] > mark]
            late += len(us) - len(arrived)  # behind the watermark
            if arrived:
                if not runs and (held := self.index.get()):
                    runs = pickle.loads(held[0])
                self._wait(runs, sorted(arrived, key=lambda e: e[:2]))
        if runs:
            self._await(runs, held[1] if held else None)
        if late and self.late:
            blank = dict.fromkeys(self.names)
            blank[self.names[0]], blank[self.late] = key[0], late
            if self.stamp:
                blank[self.stamp] = pd.Timestamp(mark + 1000, unit="us", tz="UTC")  # the first that is not late itself
            yield pd.DataFrame([blank], columns=self.names).astype({self.late: "int64"})

    def handleExpiredTimer(self, key: tuple, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        fired = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)
        later: list[tuple[int, int]] = []
        held = self.head.get()
        low, high, head = held or (0, 0, None)
        head, tape = pickle.loads(head) if head else None, Tape(self.blocks, low, high)
        out: list[tuple] = []
        for event in self._due(pickle.loads(self.index.get()[0]), later, fired):
            head, made = self.step(head, tape, event)
            end = (pd.Timestamp((event[0] // self.slot_us + 1) * self.slot_us - 1, unit="us", tz="UTC"),) if self.stamp and made else ()
            out += [(*key, *row, *((None,) if self.late else ()), *end) for row in made]
            if len(out) >= ROWS_OUT:
                yield pd.DataFrame(out, columns=self.names)
                out = []
        self._await(later, None)
        tape.save()
        if head or len(tape):
            self.head.update((tape.low, tape.high, pickle.dumps(head)))
        elif held:  # nothing to remember: the key leaves the state store
            self.head.clear()
        if out:
            yield pd.DataFrame(out, columns=self.names)

    def close(self) -> None:
        pass


def in_order(
    events: DataFrame,
    key: str,
    ts: str,
    seq: str,
    columns: list[str],
    step: Step,
    output: str,
    *,
    delay: str = "1 hour",
    slot_s: int = 900,
    late: str | None = None,
    stamp: str | None = None,
) -> DataFrame:
    """Run ``step(head, tape, event) -> (head, rows)`` per key over ordered events.

    ``event`` is (time in micros, seq, *columns). ``output`` is the row schema
    without the key, which is added as the first column. ``ts`` must be a
    TIMESTAMP column, as watermarks require. Rows leave when the watermark has
    passed their slot of ``slot_s`` seconds.

    ``late`` names a column that counts late rows: one row per key and trigger
    that has some, null elsewhere. ``stamp`` names a column with the last
    microsecond of the event's slot, the event time for windows further on.
    """
    spark = events.sparkSession
    spark.conf.set(PROVIDER, ROCKSDB)  # the only provider with map state and timers
    fields = f"{key} {dict(events.dtypes)[key]}, {output}"
    fields += f", {late} long" if late else ""
    fields += f", {stamp} timestamp" if stamp else ""
    schema = StructType.fromDDL(fields)
    # Epoch micros travel as a number: pandas would shift timestamps to the session zone. Without the time column
    # itself Spark drops no late row before it is counted.
    rows = events.withWatermark(ts, delay).select(key, seq, *columns, F.unix_micros(ts))
    return rows.groupBy(key).transformWithStateInPandas(
        _Ordered(step, schema.names, slot_s * 1_000_000, late, stamp), schema, "Append", "EventTime",
        eventTimeColumnName=stamp or "")


def as_event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need TIMESTAMP; wall-clock columns convert in the session zone."""
    return df.withColumn(column, F.col(column).cast("timestamp"))
