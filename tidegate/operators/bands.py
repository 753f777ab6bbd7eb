"""Banded as-of counts over a shared key, without a self-join.

A source row that counts for every anchor time in ``[from, to]`` becomes +1 at
``from`` and -1 just after ``to``. The running sum at the anchor is the banded
count, so any number of bands costs one pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tidegate.functions import clock
from tidegate.operators.prefix import DEFAULT_WIDTH, POS, AsOf, Fold, fold_until

# Amounts are summed as fixed-point longs so that leaving a band subtracts exactly.
MONEY_SCALE = 10_000

USER_BANDS = {"72h": 72 * clock.HOUR, "7d": 7 * clock.DAY, "30d": 30 * clock.DAY, "90d": 90 * clock.DAY}
SHORT_BANDS = {b: USER_BANDS[b] for b in ("72h", "7d", "30d")}
PRIOR_BANDS = {"24h": 24 * clock.HOUR, "72h": 72 * clock.HOUR, "7d": 7 * clock.DAY, "30d": 30 * clock.DAY}


def _changes(source: DataFrame, key: str, names: Sequence[str], steps: Sequence[tuple[str, Mapping[str, str]]]) -> DataFrame:
    """One row per (source row, step): the step's position and the values it changes."""
    cells = [c for pos, values in steps for c in (pos, *[values.get(n, "CAST(NULL AS BIGINT)") for n in names])]
    return source.selectExpr(
        key, f"stack({len(steps)}, {', '.join(cells)}) AS ({', '.join([POS, *names])})"
    ).filter(f"{POS} IS NOT NULL")


def shared_users(
    links: DataFrame,
    key: str,
    *,
    link_ts: str | None,
    identity_ts: str,
    bands: Mapping[str, int],
    prefix: str,
    lifetime: str | None = None,
    span: bool = False,
) -> AsOf:
    """Users on the anchor's ``key`` whose identity is younger than each band.

    ``links`` holds one row per (key, user). A link counts from the later of
    link and identity creation; it leaves a band when the identity is older
    than the band (both band ends inclusive). Optional outputs are the lifetime
    count and the first/latest identity times with their span in days.
    """
    born = clock.wall_micros(identity_ts)
    seen = born if link_ts is None else f"greatest({born}, {clock.wall_micros(link_ts)})"
    known = [f"{key} IS NOT NULL", f"{identity_ts} IS NOT NULL"] + ([f"{link_ts} IS NOT NULL"] if link_ts else [])
    source = links.filter(" AND ".join(known)).selectExpr(key, f"{born} AS __born", f"{seen} AS __seen")
    enter, steps, folds, outputs = {}, [], [], []
    for band, size in bands.items():
        name = f"{prefix}_{band}"
        enter[name] = f"IF(__seen <= __born + {size}L, 1L, NULL)"
        steps.append((f"IF(__seen <= __born + {size}L, __born + {size + 1}L, NULL)", {name: "-1L"}))
        folds.append(Fold(name))
        outputs.append(name)
    if lifetime:
        enter[lifetime] = "1L"
        folds.append(Fold(lifetime))
        outputs.append(lifetime)
    if span:
        enter["__first_born"] = enter["__last_born"] = "__born"
        folds += [Fold("__first_born", "min"), Fold("__last_born", "max")]
        outputs += [
            f"{clock.micros_to_wall('__first_born')} AS first_identity_created_on_account_asof",
            f"{clock.micros_to_wall('__last_born')} AS latest_identity_created_on_account_asof",
            f"{clock.boundaries_between('__first_born', '__last_born', clock.DAY)} AS user_creation_days_span_asof",
        ]
    changes = _changes(source, key, list(enter), [("__seen", enter), *steps])
    return AsOf(changes, tuple(folds), tuple(outputs))


def prior_events(
    events: DataFrame,
    key: str,
    *,
    event_ts: str,
    amounts: Mapping[str, str] | None = None,
    bands: Mapping[str, int] = PRIOR_BANDS,
    amount_band: str = "30d",
    prefix: str = "prior_advances_on_bank_account",
) -> AsOf:
    """Strictly earlier events on the key, per band and over all time.

    ``events`` holds one row per (key, event). An event at ``s`` counts for
    anchors in ``(s, s + band]``. ``amounts`` maps an output stem to a column
    summed over ``amount_band`` to 4 decimals. Also outputs the previous event
    time, the first-to-last span and the derived rates.
    """
    amounts = dict(amounts or {})
    source = events.filter(f"{key} IS NOT NULL AND {event_ts} IS NOT NULL").selectExpr(
        key, f"{clock.wall_micros(event_ts)} AS __at",
        *[f"CAST(ROUND({c} * {MONEY_SCALE}) AS BIGINT) AS __amt_{n}" for n, c in amounts.items()])
    life = f"{prefix}_lifetime"
    enter = {life: "1L", **{f"{prefix}_{b}": "1L" for b in bands}}
    outputs = list(enter)
    leave_amounts = {}
    for n in amounts:
        enter[f"__sum_{n}"], leave_amounts[f"__sum_{n}"] = f"__amt_{n}", f"-__amt_{n}"
        enter[f"__cnt_{n}"] = f"IF(__amt_{n} IS NULL, 0L, 1L)"
        leave_amounts[f"__cnt_{n}"] = f"IF(__amt_{n} IS NULL, 0L, -1L)"
        total = f"__sum_{n} / {MONEY_SCALE}.0D"
        outputs.append(f"{total} AS prior_{n}_sum_{amount_band}")
        outputs.append(f"{total} / nullif(__cnt_{n}, 0) AS prior_{n}_avg_{amount_band}")
    folds = [Fold(n) for n in enter] + [Fold("__first_at", "min"), Fold("__last_at", "max")]
    enter["__first_at"] = enter["__last_at"] = "__at"
    steps = [("__at + 1", enter)]
    for band, size in bands.items():
        leave = {f"{prefix}_{band}": "-1L"}
        if band == amount_band:
            leave.update(leave_amounts)
        steps.append((f"__at + {size + 1}L", leave))
    days = clock.boundaries_between("__first_at", "__last_at", clock.DAY)
    outputs += [
        f"{clock.micros_to_wall('__last_at')} AS previous_advance_on_account_ts",
        f"{clock.boundaries_between('__last_at', POS, clock.HOUR)} AS hours_since_previous_advance_on_account",
        f"{days} AS prior_advance_days_span",
        f"ROUND({life} / nullif({days}, 0), 4) AS avg_prior_advances_per_day",
        f"ROUND({life} / nullif({days} / 30.0D, 0), 2) AS avg_prior_advances_per_month",
    ]
    return AsOf(_changes(source, key, list(enter), steps), tuple(folds), tuple(outputs))


def min_gap(events: DataFrame, key: str, *, event_ts: str, width: int = DEFAULT_WIDTH) -> AsOf:
    """Smallest gap in clock hours between consecutive events at or before the anchor.

    Events sharing a timestamp have gap 0. The previous distinct timestamp of
    each event time is itself an as-of fold, so no per-key window is needed.
    """
    name = "prior_min_hours_between_advances_on_account"
    at = (
        events.filter(f"{key} IS NOT NULL AND {event_ts} IS NOT NULL")
        .groupBy(key, F.expr(clock.wall_micros(event_ts)).alias(POS)).agg(F.count("*").alias("__n"))
    )
    moves = at.selectExpr(key, f"{POS} + 1 AS {POS}", f"{POS} AS __prev")
    previous = fold_until(moves, at.select(key, POS), [key], [Fold("__prev", "max")], width=width)
    gaps = at.join(previous, [key, POS]).selectExpr(
        key, POS, f"IF(__n > 1, 0L, {clock.boundaries_between('__prev', POS, clock.HOUR)}) AS {name}")
    return AsOf(gaps, (Fold(name, "min"),), (name,))


def owned_links(links: DataFrame, key: str, *, link_ts: str, name: str) -> AsOf:
    """Links of the key created at or before the anchor (one row per link)."""
    changes = links.filter(f"{key} IS NOT NULL AND {link_ts} IS NOT NULL").selectExpr(
        key, f"{clock.wall_micros(link_ts)} AS {POS}", f"1L AS {name}")
    return AsOf(changes, (Fold(name),), (name,))


def sharing_flags(users_72h: str, users_ever: str) -> list[str]:
    return [
        f"CAST({users_72h} >= 3 AS BIGINT) AS flag_3_users_on_bank_account_72h",
        f"CAST({users_ever} >= 5 AS BIGINT) AS flag_5_users_on_bank_account_ever_asof",
        f"CAST({users_ever} >= 10 AS BIGINT) AS flag_10_users_on_bank_account_ever_asof",
    ]


def creation_rates(users_ever: str, span_days: str) -> list[str]:
    """Users per day and per 30 days over the observed span; null on a zero span."""
    return [
        f"ROUND({users_ever} / nullif({span_days}, 0), 4) AS avg_users_created_per_day_asof",
        f"ROUND({users_ever} / nullif({span_days} / 30.0D, 0), 2) AS avg_users_created_per_month_asof",
    ]
