"""Network score, heuristic score and band."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidegate.functions.hashing import letters_from_hash

BANDS = ("LOW", "POSSIBLE", "LIKELY", "EXTREMELY_LIKELY")
NO_NETWORK = "QQQ"
NETWORK_THRESHOLD = 15

# Points per signal, highest threshold that holds wins.
SCORE_POINTS = {
    "users_72h": ((4, 25), (3, 15)),
    "users_lifetime": ((10, 25), (5, 15), (3, 5)),
    "users_per_month": ((10, 15), (3, 8)),
    "network_score": ((15, 15),),
}
RECENT_72H = (2, 20)
RECENT_7D = (2, 10)
BAND_CEILINGS = (("LOW", 15), ("POSSIBLE", 35), ("LIKELY", 60))


def network_score(users: Column, accounts: Column) -> Column:
    zero = F.lit(0).cast("long")
    return F.coalesce(users, zero) * F.greatest(F.coalesce(accounts, zero), F.lit(1).cast("long"))


def network_label(score: Column, key: Column) -> Column:
    return F.when(score >= NETWORK_THRESHOLD, letters_from_hash(key)).otherwise(F.lit(NO_NETWORK))


def _points(value: Column, steps: tuple[tuple[int, int], ...]) -> Column:
    out = None
    for threshold, points in steps:
        hit = F.coalesce(value, F.lit(0)) >= threshold
        out = F.when(hit, points) if out is None else out.when(hit, points)
    return out.otherwise(0)


def heuristic_score(users_72h: Column, users_lifetime: Column, users_per_month: Column,
                    prior_72h: Column, prior_7d: Column, score: Column) -> Column:
    signals = {"users_72h": users_72h, "users_lifetime": users_lifetime,
               "users_per_month": users_per_month, "network_score": score}
    total = sum((_points(signals[n], steps) for n, steps in SCORE_POINTS.items()), F.lit(0))
    recent = (
        F.when(F.coalesce(prior_72h, F.lit(0)) >= RECENT_72H[0], RECENT_72H[1])
        .when(F.coalesce(prior_7d, F.lit(0)) >= RECENT_7D[0], RECENT_7D[1])
        .otherwise(0)
    )
    return F.least(F.lit(100), total + recent).cast("long")


def score_band(score: Column) -> Column:
    out = None
    for band, ceiling in BAND_CEILINGS:
        out = F.when(score <= ceiling, band) if out is None else out.when(score <= ceiling, band)
    return out.otherwise(BANDS[-1])
