"""Latest-row and as-of joins built from mergeable aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidegate.functions import clock
from tidegate.operators.prefix import POS, AsOf, Fold


def best_row(
    df: DataFrame,
    keys: Sequence[str],
    preference: Sequence[str],
    extra: Mapping[str, str] | None = None,
) -> DataFrame:
    """One whole row per key: the one whose preference tuple is largest.

    Preferences are SQL expressions that read "larger is better, null is worst"
    (negate an ascending one). ``max_by`` merges partial results before the
    shuffle, so a hot key never gathers in one task. ``extra`` maps names to
    aggregates over the same group.
    """
    rest = [c for c in df.columns if c not in keys]
    extra = dict(extra or {})
    order = ", ".join(f"{p} AS p{i}" for i, p in enumerate(preference))
    picked = F.expr(f"max_by(struct({', '.join(rest)}), struct({order}))").alias("__best")
    return df.groupBy(*keys).agg(picked, *[F.expr(e).alias(n) for n, e in extra.items()]).select(
        *keys, "__best.*", *extra)


def first_in_group(df: DataFrame, keys: Sequence[str], order: Sequence, n: int = 1) -> DataFrame:
    """First ``n`` rows of each group under an explicit sort order.

    Groups with a bounded ``n`` are cut per partition before the shuffle
    (Spark's window group limit).
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def latest_rows(
    history: DataFrame, key: str, *, history_ts: str, ties: Sequence[str] = (), values: Sequence[str] = (),
    as_name: str = "__row", outputs: Sequence[str] | None = None,
) -> AsOf:
    """Most recent history row at or before the anchor.

    Later ``history_ts`` wins, then larger ``ties`` (null is smallest). "Latest"
    is a running maximum of an ordered struct, so the many-to-many join never
    materialises; anchors without history get nulls.
    """
    columns = [history_ts, *ties, *[c for c in values if c not in ties and c != history_ts]]
    changes = history.filter(f"{key} IS NOT NULL AND {history_ts} IS NOT NULL").selectExpr(
        key, f"{clock.wall_micros(history_ts)} AS {POS}", f"struct({', '.join(columns)}) AS {as_name}")
    shown = outputs if outputs is not None else [f"{as_name}.{c} AS {c}" for c in columns]
    return AsOf(changes, (Fold(as_name, "max"),), tuple(shown))


def account_candidates(
    advances: DataFrame,
    links: DataFrame,
    *,
    user: str = "user_id",
    advance_ts: str = "feature_as_of_ts",
    link_ts: str = "link_created_at",
    advance_account: tuple[str, str] = ("adv_routing", "adv_account"),
    link_account: tuple[str, str] = ("routing_number", "account_number"),
) -> DataFrame:
    """Accounts of the user known at the advance time.

    An advance that names its account joins on (user, routing, account); one
    that names neither part takes all the user's accounts; one that names only
    one part matches nothing. Splitting the two cases keeps the common one on a
    selective equi-key instead of a user-wide join with an OR.
    """
    (ar, aa), (lr, la) = advance_account, link_account
    other = links.withColumnRenamed(user, "__user")
    known = f"{user} = __user AND {link_ts} <= {advance_ts}"
    named = advances.filter(f"{ar} IS NOT NULL AND {aa} IS NOT NULL").join(
        other, F.expr(f"{known} AND {ar} = {lr} AND {aa} = {la}"))
    openly = advances.filter(f"{ar} IS NULL AND {aa} IS NULL").join(other, F.expr(known))
    return named.unionByName(openly).drop("__user")
