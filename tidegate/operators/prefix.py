"""Running aggregates per key, split by position so that a hot key spreads out.

Every as-of feature in this library is "fold all changes of my key up to my
position". A window over the key alone would send one hot key to one task, and
a range join would emit every pair inside it. Here the axis is cut into
buckets:

1. changes and read points are dealt by (key, bucket) as they are;
2. one small row per (key, bucket) is folded along the key (the carry);
3. positions are folded inside each (key, bucket), which is the unit of work of
   a task, and the carry of the earlier buckets is added.

Cost is linear in changes + reads whatever the size of a key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidegate.functions import clock

POS = "__pos"
BUCKET = "__bucket"
READ = "__read"

# One bucket per clock hour: even a key with billions of rows a year stays at
# thousands of buckets with a task-sized number of distinct positions in each.
DEFAULT_WIDTH = clock.HOUR


@dataclass(frozen=True)
class Fold:
    """One running aggregate: ``how`` is sum, min or max of column ``name``.

    Nulls are neutral, so rows that change only some folds leave the rest null.
    """

    name: str
    how: str = "sum"

    @property
    def aggregate(self) -> str:
        return f"{self.how}(`{self.name}`)"

    def combine(self, carry: str, local: str) -> str:
        if self.how == "sum":
            return f"coalesce({carry}, 0L) + coalesce({local}, 0L)"
        return f"{ {'min': 'least', 'max': 'greatest'}[self.how] }({carry}, {local})"


@dataclass(frozen=True)
class AsOf:
    """Changes of one feature family, their folds and the columns derived from them."""

    changes: DataFrame
    folds: tuple[Fold, ...]
    outputs: tuple[str, ...]


def read_points(anchors: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """(keys, position) of each anchor; rows with a null key or time never match."""
    return anchors.selectExpr(*keys, f"{clock.wall_micros(ts)} AS {POS}").dropna()


def fold_until(
    changes: DataFrame,
    reads: DataFrame,
    keys: Sequence[str],
    folds: Sequence[Fold],
    *,
    bucket: str | None = None,
    width: int = DEFAULT_WIDTH,
) -> DataFrame:
    """Fold ``changes`` at or before each read position of the same key.

    Both inputs carry ``keys`` and a position column ``__pos`` (micros by
    default; any ordered type when ``bucket`` gives its bucket expression).
    Returns one row per distinct (keys, __pos) of ``reads``.
    """
    keys = list(keys)
    bucket = bucket or clock.floor_div(POS, width)
    group = ", ".join([*keys, BUCKET])
    both = changes.selectExpr(*keys, POS, *[f.name for f in folds], f"0 AS {READ}").unionByName(
        reads.selectExpr(*keys, POS, f"1 AS {READ}"), allowMissingColumns=True)
    present = " AND ".join(f"{c} IS NOT NULL" for c in [*keys, BUCKET])
    # One shuffle of the rows as they are: positions are nearly distinct, so aggregating them before it
    # would only hold a scan's whole split in memory. The carry and the local fold read this same shuffle:
    # both keep every column and no branch-specific null filter, so Spark plans it once.
    points = both.selectExpr("*", f"{bucket} AS {BUCKET}").filter(present).repartition(*keys, BUCKET)
    aggs = [f"{f.aggregate} AS {f.name}" for f in folds]
    along = f"OVER (PARTITION BY {', '.join(keys)} ORDER BY {BUCKET} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    carry = (
        _grouped(points, [*keys, BUCKET], [*aggs, f"max({READ}) AS {READ}", f"max({POS}) AS __last"])
        .selectExpr(*keys, BUCKET, READ, "__last", *[f"{f.aggregate} {along} AS __carry_{f.name}" for f in folds])
        .filter(f"{READ} = 1 AND __last IS NOT NULL").drop(READ, "__last")
    )
    # Rows of one position are peers: each sees the changes of all, and the first of its reads stands for them.
    ordered = f"OVER (PARTITION BY {group} ORDER BY {POS}"
    local = points.selectExpr(
        *keys, BUCKET, POS, READ,
        *[f"{f.aggregate} {ordered} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {f.name}" for f in folds],
    ).filter(f"{READ} = 1").selectExpr("*", f"lag({POS}) {ordered}) AS __earlier").filter(
        f"__earlier IS NULL OR __earlier <> {POS}").drop("__earlier")
    return local.join(carry, [*keys, BUCKET], "inner").selectExpr(
        *keys, POS, *[f"{f.combine('__carry_' + f.name, f.name)} AS {f.name}" for f in folds])


def _grouped(df: DataFrame, keys: Sequence[str], aggs: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.expr(a) for a in aggs])


def asof_features(
    anchors: DataFrame, key: str, ts: str, families: Sequence[AsOf], *, width: int = DEFAULT_WIDTH,
) -> DataFrame:
    """Evaluate feature families that share a key in a single fold.

    Returns one row per distinct (key, anchor position) with every family's
    output columns.
    """
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.changes for f in families])
    folds = [fold for f in families for fold in f.folds]
    out = fold_until(merged, read_points(anchors, [key], ts), [key], folds, width=width)
    return out.selectExpr(key, POS, *[o for f in families for o in f.outputs])


def attach(anchors: DataFrame, features: DataFrame, key: str, ts: str, fill: Sequence[str] = ()) -> DataFrame:
    """Left-join (key, position) features back to anchors; ``fill`` columns become 0 when absent."""
    joined = anchors.selectExpr("*", f"{clock.wall_micros(ts)} AS {POS}").join(features, [key, POS], "left").drop(POS)
    return joined.fillna(0, list(fill)) if fill else joined
