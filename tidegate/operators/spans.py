"""Pairing start/end events and measuring uncovered time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidegate.functions import clock
from tidegate.operators.prefix import DEFAULT_WIDTH, POS, Fold, fold_until


def _levels(events: DataFrame, key: str, ts: str, seq: str, width: int) -> DataFrame:
    """Nesting level of each start and matched end; unmatched ends are marked.

    With +1 per start and -1 per end, the depth is the running sum above its
    running minimum (an end that reaches a new minimum had nothing to pop). Both
    run inside (key, time bucket) and are carried along the buckets of the key.
    """
    rows = events.selectExpr(
        "*", "IF(kind = 'start', 1L, -1L) AS __step", f"{clock.floor_div(clock.wall_micros(ts), width)} AS __b")
    inside = f"OVER (PARTITION BY {key}, __b ORDER BY {ts}, {seq} ROWS BETWEEN UNBOUNDED PRECEDING AND "
    local = rows.selectExpr("*", f"sum(__step) {inside}CURRENT ROW) AS __s").selectExpr(
        "*", f"min(__s) {inside}CURRENT ROW) AS __m", f"min(__s) {inside}1 PRECEDING) AS __mp")
    along = f"OVER (PARTITION BY {key} ORDER BY __b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    carry = local.groupBy(key, "__b").agg(F.sum("__step").alias("t"), F.min("__m").alias("low")).selectExpr(
        key, "__b", "low", f"coalesce(sum(t) {along}, 0L) AS __cs").selectExpr(
        key, "__b", "__cs", f"coalesce(min(__cs + low) {along}, 0L) AS __cm")
    floor = "least(0L, __cm, __cs + coalesce({}, 0L))"
    return local.join(carry, [key, "__b"]).selectExpr(
        *events.columns, f"__cs + __s - {floor.format('__m')} AS __depth",
        f"kind = 'end' AND __cs + __s < {floor.format('__mp')} AS unmatched_end",
    ).withColumn("level", F.expr("IF(kind = 'start', __depth, __depth + 1)")).drop("__depth")


def pair_spans(events: DataFrame, key: str, ts: str, seq: str, *, carry: Sequence[str] = (), width: int = DEFAULT_WIDTH) -> DataFrame:
    """Each ``end`` closes the latest open ``start`` of its key.

    ``events`` has ``kind`` in start/end; order is (ts, seq). Returns key, both
    sequence numbers and times, the start's ``carry`` columns and the duration
    in seconds. A matched end pops the last start of its own nesting level, so
    pairing is an as-of maximum over (key, level).
    """
    rows = _levels(events.filter("kind IN ('start', 'end')"), key, ts, seq, width)
    pos = f"struct({ts} AS t, {seq} AS s) AS {POS}"
    starts = rows.filter("kind = 'start'").selectExpr(
        key, "level", pos, f"struct({', '.join([ts, seq, *carry])}) AS __open")
    ends = rows.filter("kind = 'end' AND NOT unmatched_end").selectExpr(
        key, "level", pos, f"{ts} AS end_ts", f"{seq} AS end_seq")
    opened = fold_until(starts, ends.select(key, "level", POS), [key, "level"], [Fold("__open", "max")],
                        bucket=clock.floor_div(clock.wall_micros(f"{POS}.t"), width))
    return ends.join(opened, [key, "level", POS]).selectExpr(
        key, f"__open.{seq} AS start_seq", "end_seq", f"__open.{ts} AS start_ts", "end_ts",
        *[f"__open.{c} AS {c}" for c in carry],
        f"greatest(0D, ({clock.wall_micros('end_ts')} - {clock.wall_micros(f'__open.{ts}')}) / 1e6D) AS duration_s")


def unmatched_counts(events: DataFrame, key: str, ts: str, seq: str, *, width: int = DEFAULT_WIDTH) -> DataFrame:
    """Per key: starts never closed and ends with nothing to close."""
    rows = _levels(events.filter("kind IN ('start', 'end')"), key, ts, seq, width)
    return rows.groupBy(key).agg(
        F.expr("count_if(kind = 'start')").alias("starts"), F.expr("count_if(kind = 'end')").alias("ends"),
        F.expr("count_if(unmatched_end)").alias("unmatched_end_count"),
    ).selectExpr(key, "starts - (ends - unmatched_end_count) AS unmatched_start_count", "unmatched_end_count")


def phase_rollup(spans: DataFrame, phase: str, duration: str = "duration_s", uses: str | None = None) -> DataFrame:
    """Seconds (half-up to 5 decimals), spans and tool uses per phase."""
    aggs = [F.expr(f"round(sum({duration}), 5)").alias("duration_s"), F.count("*").alias("n_spans")]
    if uses:
        aggs.append(F.expr(f"coalesce(sum({uses}), 0L)").alias("tool_uses"))
    return spans.groupBy(F.expr(f"coalesce(nullif(CAST({phase} AS STRING), ''), 'unknown')").alias("phase")).agg(*aggs)


def uncovered_time(spans: DataFrame, bounds: DataFrame, key: str, *, width: int = DEFAULT_WIDTH) -> DataFrame:
    """Seconds between the key's first and last event that no span covers.

    ``spans(key, start_ts, end_ts)``; ``bounds(key, first_ts, last_ts)``. New
    cover at a start is what its spans add beyond the furthest end of all
    earlier starts: the as-of maximum with and without the start itself.
    """
    m = clock.wall_micros
    clipped = spans.join(bounds, key).selectExpr(
        key, f"greatest({m('start_ts')}, {m('first_ts')}) AS {POS}", f"least({m('end_ts')}, {m('last_ts')}) AS __end",
    ).filter(f"__end > {POS}")
    changes = clipped.selectExpr(key, f"stack(2, {POS}, __end, CAST(NULL AS BIGINT), {POS} + 1, NULL, __end) AS ({POS}, __upto, __far)")
    ends = fold_until(changes, clipped.select(key, POS), [key], [Fold("__upto", "max"), Fold("__far", "max")], width=width)
    covered = ends.groupBy(key).agg(
        F.expr(f"sum(greatest(0L, __upto - greatest({POS}, coalesce(__far, {POS}))))").alias("__covered"))
    return bounds.join(covered, key, "left").selectExpr(
        key, f"({m('last_ts')} - {m('first_ts')}) / 1e6D AS total_s",
        f"greatest(0L, {m('last_ts')} - {m('first_ts')} - coalesce(__covered, 0L)) / 1e6D AS unattributed_s")
