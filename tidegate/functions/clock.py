"""Time arithmetic as SQL text, independent of the session time zone.

Wall-clock columns may be TIMESTAMP_NTZ or TIMESTAMP. Positions on a time axis
are microseconds, so "strictly before t" is simply "at or before t - 1". Each
helper takes column names or SQL fragments and returns one SQL expression.
"""

from __future__ import annotations

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR


def wall_micros(ts: str) -> str:
    """Microseconds since 1970-01-01 of the wall clock shown by ``ts``."""
    return (
        f"(unix_date(cast({ts} as date)) * {DAY}L + hour({ts}) * {HOUR}L + minute({ts}) * {MINUTE}L"
        f" + cast(extract(SECOND FROM {ts}) * {SECOND} as bigint))"
    )


def micros_to_wall(micros: str) -> str:
    """Inverse of :func:`wall_micros`, as TIMESTAMP_NTZ."""
    seconds = f"cast(cast({micros} as decimal(20, 0)) / {SECOND} as decimal(18, 6))"
    return f"(timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds}))"


def floor_div(value: str, width: int) -> str:
    """Integer floor division that also holds left of zero."""
    return f"(({value} - pmod({value}, {width}L)) div {width}L)"


def boundaries_between(start: str, end: str, unit_micros: int) -> str:
    """Whole-unit boundaries crossed from ``start`` to ``end`` (both micros)."""
    return f"({floor_div(end, unit_micros)} - {floor_div(start, unit_micros)})"


def day_boundaries(start: str, end: str) -> str:
    """Midnights crossed from ``start`` to ``end``."""
    return f"cast(datediff(cast({end} as date), cast({start} as date)) as bigint)"


def hour_boundaries(start: str, end: str) -> str:
    """Full hours on the clock crossed from ``start`` to ``end``."""
    return f"({day_boundaries(start, end)} * 24 + (hour({end}) - hour({start})))"


def hours_between(later: str, earlier: str) -> str:
    """Elapsed fractional hours; null when either side is null."""
    return f"(({wall_micros(later)} - {wall_micros(earlier)}) / {float(HOUR)}D)"


def iso_weekday(ts: str) -> str:
    """Monday = 1 .. Sunday = 7."""
    return f"cast(weekday(cast({ts} as date)) + 1 as bigint)"
