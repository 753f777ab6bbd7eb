"""Streaming span pairing, phase rollup and velocity alerts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tidegate.plans.rules import Rule, with_flags
from tidegate.streaming.ordered import Tape, in_order


def pair_spans_stream(events: DataFrame, key: str, ts: str, seq: str, *, delay: str = "1 hour", max_open_s: float | None = None,
                      phase: str | None = None, slot_s: int = 900, late: str | None = None, stamp: str | None = None) -> DataFrame:
    """Stack pairing per key; ``kind`` is start or end.

    Emits closed spans, ends with nothing to close (no start) and, when
    ``max_open_s`` is given, starts still open that long before a later event of
    the key (no end), which also bounds the state of a key. A span carries its
    start's text column ``phase``, if one is named.
    """
    def step(head, stack, event):
        now, seq_no, kind, *more = event
        rows = []
        while max_open_s is not None and len(stack) and now - stack[stack.low][0] > max_open_s * 1e6:  # oldest first
            _, start_no, *held = stack[stack.low]
            rows.append((start_no, None, "unmatched_start", None, *held))
            stack.forget_before(stack.low + 1)
        if kind == "start":
            stack.append((now, int(seq_no), *more))
        elif kind == "end":
            if len(stack):
                began, start_no, *held = stack.pop()
                rows.append((start_no, int(seq_no), "span", max(0.0, (now - began) / 1e6), *held))
            else:
                rows.append((None, int(seq_no), "unmatched_end", None, *more))
        return head, rows

    return in_order(events, key, ts, seq, ["kind", *([phase] if phase else [])], step,
                    "start_seq long, end_seq long, outcome string, duration_s double" + (f", {phase} string" if phase else ""),
                    delay=delay, slot_s=slot_s, late=late, stamp=stamp)


def phase_rollup_stream(events: DataFrame, key: str, ts: str, seq: str, phase: str, *, window_s: int = 3600,
                        delay: str = "1 hour", slot_s: int = 900) -> DataFrame:
    """Spans paired on the stream, then seconds (half-up to 5 decimals, from whole micros) and spans per phase and tumbling window of the span's end.

    Two stateful operators in a row. A window holds whole slots, so a span's slot
    falls into the same window as its end. ``late_rows`` counts, in the window the
    watermark stood in, events that came too late; they have no phase.
    """
    if window_s % slot_s:
        raise ValueError("a window holds whole slots")
    spans = pair_spans_stream(events, key, ts, seq, delay=delay, phase=phase, slot_s=slot_s, late="late_rows", stamp="slot_ts")
    named = F.when(F.col("late_rows").isNull(), F.expr(f"coalesce(nullif({phase}, ''), 'unknown')")).alias("phase")
    return spans.filter("outcome = 'span' OR late_rows IS NOT NULL").groupBy(F.window("slot_ts", f"{window_s} seconds"), named).agg(
        F.expr("sum(CAST(round(duration_s * 1e6) AS BIGINT))").alias("us"), F.expr("count_if(outcome = 'span')").alias("n_spans"),
        F.expr("coalesce(sum(late_rows), 0L)").alias("late_rows"),
    ).selectExpr("window.start AS window_start", "phase", "((us + 5) div 10) / 1e5D AS duration_s", "n_spans", "late_rows")


def velocity_stream(events: DataFrame, key: str, ts: str, seq: str, *, bands: Mapping[str, int],
                    prefix: str = "prior_events", delay: str = "1 hour", columns: Sequence[str] = (),
                    column_types: Sequence[str] = (), slot_s: int = 900, late: str | None = None) -> DataFrame:
    """Strictly earlier events of the key per band (micros) and over all time.

    State per key is the tape of times within the widest band, one place on it
    per band and a counter; equal times do not see each other.
    """
    names = [f"{prefix}_{b}" for b in bands]

    def step(head, times, event):
        now, seq_no, *rest = event
        # Times ascend: per band the place of its first time; the place of the last time's first event; all events before that.
        starts, here, before = head or ([0] * len(bands), 0, 0)
        if len(times) and times[times.high - 1] < now:
            before, here = before + times.high - here, times.high
        starts = [_forward(times, start, here, now - size) for start, size in zip(starts, bands.values())]
        times.forget_before(min(starts))
        times.append(now)
        return (starts, here, before), [(int(seq_no), *rest, *(here - start for start in starts), before)]

    extra = "".join(f"{c} {t}, " for c, t in zip(columns, column_types))
    return in_order(events, key, ts, seq, list(columns), step,
                    f"{seq} long, {extra}" + ", ".join(f"{n} long" for n in names) + f", {prefix}_lifetime long",
                    delay=delay, slot_s=slot_s, late=late)


def _forward(times: Tape, place: int, end: int, since: int) -> int:
    """The first place from ``place`` to ``end`` whose time is not before ``since``."""
    while place < end and times[place] < since:
        place += 1
    return place


def alerts(velocity: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows of a velocity stream that some rule matches, with the flags - the same rules as in batch."""
    return with_flags(velocity, rules).filter("scenario_any")
