"""Span pairing and velocity: brute force, batch and stream agree."""

import random
from datetime import datetime, timedelta
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegate.functions import clock
from tidegate.operators import spans as J
from tidegate.sources.readers import read_event_lines
from tidegate.streaming.jobs import pair_spans_stream, phase_rollup_stream, velocity_stream
from tidegate.streaming.ordered import Tape, _Ordered, as_event_time

T0 = datetime(2026, 1, 1)


@pytest.fixture(scope="module")
def events():
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.6 else f"u{rng.randrange(4)}", T0 + timedelta(minutes=rng.randrange(3000)), i, rng.choice(["start", "end"]))
            for i in range(240)]
    return sorted(rows, key=lambda r: (r[1], r[2]))


def brute(events):
    stacks, pairs, lost = {}, set(), {}
    for u, at, i, kind in events:
        if kind == "start":
            stacks.setdefault(u, []).append(i)
        elif stacks.get(u):
            pairs.add((u, stacks[u].pop(), i))
        else:
            lost[u] = lost.get(u, 0) + 1
    return pairs, {u: len(s) for u, s in stacks.items() if s}, lost


@pytest.mark.parametrize("width", [10 * clock.MINUTE, 300 * clock.DAY])
def test_pairing(spark, events, width):
    df = spark.createDataFrame(events, "u string, ts timestamp_ntz, i long, kind string")
    pairs, open_, lost = brute(events)
    assert {(r.u, r.start_seq, r.end_seq) for r in J.pair_spans(df, "u", "ts", "i", width=width).collect()} == pairs
    counts = {r.u: (r.unmatched_start_count, r.unmatched_end_count) for r in J.unmatched_counts(df, "u", "ts", "i", width=width).collect()}
    assert all(counts[u] == (open_.get(u, 0), lost.get(u, 0)) for u in counts)


def test_uncovered_time(spark):
    t = lambda m: T0 + timedelta(minutes=m)
    spans = spark.createDataFrame([("a", t(1), t(3)), ("a", t(2), t(5)), ("a", t(7), t(30)), ("a", t(-9), t(0))], "k string, start_ts timestamp_ntz, end_ts timestamp_ntz")
    bounds = spark.createDataFrame([("a", t(0), t(10)), ("b", t(0), t(2))], "k string, first_ts timestamp_ntz, last_ts timestamp_ntz")
    got = {r.k: (r.total_s, r.unattributed_s) for r in J.uncovered_time(spans, bounds, "k").collect()}
    assert got == {"a": (600.0, 180.0), "b": (120.0, 120.0)}


def drain(spark, rows, schema, tmp_path, build, files=4):
    """Feed the rows as several files, in time order, then one far-future row to move the watermark."""
    place, step = tmp_path / "in", -(-len(rows) // files)
    late = [("zzz", rows[-1][1] + timedelta(days=60), 10**9, *rows[-1][3:])]
    for n, part in enumerate([*(rows[i:i + step] for i in range(0, len(rows), step)), late]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(place / f"f{n}"))
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{place}/*")
    q = build(as_event_time(source, "ts")).writeStream.format("parquet").option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(tmp_path / "out"))
    q.awaitTermination()
    return spark.read.parquet(str(tmp_path / "out"))


def test_stream_pairing_equals_batch(spark, events, tmp_path):
    # Files may be read out of order, so the allowed delay covers the whole range.
    out = drain(spark, events, "u string, ts timestamp_ntz, i long, kind string", tmp_path,
                lambda df: pair_spans_stream(df, "u", "ts", "i", delay="50 days"))
    pairs, _, lost = brute(events)
    assert {(r.u, r.start_seq, r.end_seq) for r in out.filter("outcome = 'span'").collect()} == pairs
    assert out.filter("outcome = 'unmatched_end' AND u <> 'zzz'").count() == sum(lost.values())


def test_stream_velocity_equals_brute_force(spark, events, tmp_path):
    rows = [(u, at, i, float(i)) for u, at, i, _ in events]
    out = drain(spark, rows, "u string, ts timestamp_ntz, i long, v double", tmp_path,
                lambda df: velocity_stream(df, "u", "ts", "i", bands={"6h": 6 * clock.HOUR}, delay="50 days", columns=["v"], column_types=["double"]))
    got = {r.i: (r.prior_events_6h, r.prior_events_lifetime, r.v) for r in out.filter("u <> 'zzz'").collect()}
    for u, at, i, v in rows:
        prior = [s for uu, s, _, _ in rows if uu == u and s < at]
        assert got[i] == (sum(s >= at - timedelta(hours=6) for s in prior), len(prior), v)


def in_turn(spark, batches, schema, tmp_path, build):
    """Each batch becomes one trigger, in the given order."""
    place = tmp_path / "turns"
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(place))
        source = spark.readStream.schema(schema).parquet(str(place))
        build(as_event_time(source, "ts")).writeStream.format("parquet").option(
            "checkpointLocation", str(tmp_path / "turns_cp")).trigger(availableNow=True).start(str(tmp_path / "turns_out")).awaitTermination()
    return spark.read.parquet(str(tmp_path / "turns_out"))


def test_late_rows_are_counted_and_the_rest_rolled_up(spark, tmp_path):
    t = lambda m: T0 + timedelta(minutes=m)
    batches = [[("a", t(0), 1, "start", "x"), ("a", t(20), 2, "end", "x"), ("b", t(5), 3, "start", "")],
               [("a", t(400), 4, "start", "y"), ("b", t(401), 5, "end", "y")],
               [("a", t(10), 6, "start", "x"), ("a", t(11), 7, "end", "x"), ("b", t(12), 8, "end", "x"), ("a", t(430), 9, "end", "y")],
               [("zzz", t(9000), 10, "none", "y")]]
    schema = "u string, ts timestamp_ntz, i long, kind string, phase string"
    spans = in_turn(spark, batches, schema, tmp_path / "spans",
                    lambda df: pair_spans_stream(df, "u", "ts", "i", delay="30 minutes", late="late_rows")).cache()
    assert {(r.u, r.late_rows) for r in spans.filter("late_rows IS NOT NULL").collect()} == {("a", 2), ("b", 1)}
    assert {(r.u, r.start_seq, r.end_seq, r.outcome) for r in spans.filter("late_rows IS NULL").collect()} == {
        ("a", 1, 2, "span"), ("b", 3, 5, "span"), ("a", 4, 9, "span")}
    rolled = in_turn(spark, batches, schema, tmp_path / "rolled",
                     lambda df: phase_rollup_stream(df, "u", "ts", "i", "phase", delay="30 minutes"))
    got = {(r.phase, r.duration_s, r.n_spans) for r in rolled.filter("n_spans > 0").collect()}
    assert got == {("x", 1200.0, 1), ("unknown", 396 * 60.0, 1), ("y", 1800.0, 1)}
    assert rolled.selectExpr("sum(late_rows)").first()[0] == 3


class Entries(dict):
    """Map state without a store."""
    containsKey, getValue, updateValue = dict.__contains__, dict.__getitem__, dict.__setitem__
    removeKey = dict.pop


def test_tape_equals_a_list_and_touches_few_blocks():
    rng, entries, want, low = random.Random(5), Entries(), [], 0
    tape = Tape(entries, 0, 0)
    for turn in range(3000):
        for _ in range(rng.randrange(3)):
            tape.append(turn), want.append(turn)
        if want and rng.random() < 0.3:
            assert tape.pop() == want.pop()
        if want and rng.random() < 0.1:
            cut = rng.randrange(min(len(want), 40))
            tape.forget_before(tape.low + cut)
            want = want[cut:]
        if rng.random() < 0.05:
            tape.save()
            tape = Tape(entries, tape.low, tape.high)
        assert len(tape) == len(want) and (not want or tape[tape.low] == want[0] and tape[tape.high - 1] == want[-1])
    while want:
        assert tape.pop() == want.pop()
    tape.save()
    assert not entries
    for n in range(10_000):
        tape.append(n)
    tape.save()
    tape = Tape(entries, tape.low, tape.high)
    tape.append(-1)
    assert len(tape.held) == 1


def test_event_lines_skip_blanks_and_non_objects(spark, tmp_path):
    (tmp_path / "e.jsonl").write_text('{"event": "start", "agent_id": "a", "time_s": 1.5}\n\n   \n[1]\n3\n{"event": "end"}\n')
    assert [(r.event, r.agent_id, r.time_s) for r in read_event_lines(spark, str(tmp_path)).collect()] == [
        ("start", "a", 1.5), ("end", None, None)]


class Value:
    """Value state and handle without a store; ``calls`` counts what would go to it."""
    calls = 0

    def __init__(self):
        self.kept, self.maps, self.timers = None, {}, set()

    def get(self):
        Value.calls += 1
        return self.kept

    def update(self, value):
        Value.calls += 1
        self.kept = value

    def clear(self):
        self.kept = None

    def getValueState(self, name, schema):
        return self.maps.setdefault(name, Value())

    def getMapState(self, name, key, value):
        return self.maps.setdefault(name, Entries())

    def registerTimer(self, at):
        Value.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def test_events_wait_in_runs_behind_one_timer():
    rng, handle, out = random.Random(8), Value(), []
    step = lambda head, tape, e: (None, [e])
    made = _Ordered(step, ["k", "us", "seq"], 900_000_000, None, None)
    made.init(handle)
    times = lambda mark: SimpleNamespace(getCurrentWatermarkInMs=lambda: mark)
    sent, day, mark, timers = [], 86_400_000_000, 0, 0
    for turn in range(6):  # 700 events a turn, each in a slot of its own about, over two days; the watermark follows
        new = [(turn * day + rng.randrange(1, 2 * day), turn * 1000 + i) for i in range(700)]
        new = [e for e in new if e[0] > mark * 1000]
        sent += new
        list(made.handleInputRows(("a",), iter([pd.DataFrame([("a", seq, us) for us, seq in new])]), times(mark)))
        mark = turn * day // 1000 + 40_000_000 if turn < 5 else 100 * day
        while due := sorted(t for t in handle.timers if t < mark):
            timers += 1
            for frame in made.handleExpiredTimer(("a",), times(mark), SimpleNamespace(getExpiryTimeInMs=lambda: due[0])):
                out += [tuple(r)[1:] for r in frame.itertuples(index=False)]
            handle.timers.discard(due[0])
        assert len(handle.timers) <= 1
    assert out == sorted(sent) and len(sent) > 3000
    assert timers <= 6 and Value.calls < 60
    assert not handle.timers and not handle.maps["waiting"] and handle.maps["index"].kept is None
