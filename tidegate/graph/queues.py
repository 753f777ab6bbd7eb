"""Discovery queues and user-level outcome checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidegate.functions import clock
from tidegate.graph.components import user_census
from tidegate.graph.store import DEFAULT_LAYERS, ENTITY, TS, view
from tidegate.graph.traverse import entity_stats, incidences, near_flagged, project_users
from tidegate.operators.quantiles import exact_quantiles
from tidegate.plans.rules import Rule, any_flag


def residual_ring_members(membership: DataFrame, rings: DataFrame, flags: DataFrame, flag: str,
                          min_users: int = 3, min_types: int = 2) -> DataFrame:
    """Users without the flag in components of several users and entity types, most flagged components first."""
    kept = rings.filter(f"n_users >= {min_users} AND n_types >= {min_types}")
    known = flags.filter(f"CAST({flag} AS INT) = 1").selectExpr("concat('user:', CAST(user_id AS STRING)) AS vertex")
    members = membership.filter("kind = 'user'").join(known, "vertex", "left_anti")
    return members.join(kept, "comp_id").selectExpr(
        "substring(vertex, 6) AS user_id", "comp_id", "n_users AS ring_users", "n_types AS ring_types",
        "n_flagged AS ring_flagged", "entity_types",
    ).orderBy(F.desc("ring_flagged"), F.desc("ring_types"), F.desc("ring_users"), "user_id")


def bad_neighbours(edges: DataFrame, flags: DataFrame, names: Sequence[str] = ("scenario_any", "is_fraud"),
                   max_hops: int = 2) -> DataFrame:
    """Users that carry none of the flags within ``max_hops`` of one that does; hops per flag."""
    pairs = incidences(edges)
    per_flag = [
        near_flagged(edges, flags.filter(f"CAST({n} AS INT) = 1").select("user_id"), max_hops, pairs=pairs)
        .selectExpr("user_id", f"hops AS hops_to_{n}") for n in names]
    merged = reduce(lambda a, b: a.join(b, "user_id", "full"), per_flag)
    known = flags.filter(" OR ".join(f"CAST({n} AS INT) = 1" for n in names)).selectExpr(
        "CAST(user_id AS STRING) AS user_id")
    closest = F.least(*[F.col(f"hops_to_{n}") for n in names]) if len(names) > 1 else F.col(f"hops_to_{names[0]}")
    return merged.join(known, "user_id", "left_anti").orderBy(closest, "user_id")


def emerging_farms(edges: DataFrame, flags: DataFrame, flag: str, *, min_users: int = 5, top_n: int = 50,
                   layers: Sequence[str] = DEFAULT_LAYERS) -> DataFrame:
    """The ``top_n`` entities by daily intake of users times the share of their users without the flag.

    Every entity of at least ``min_users`` users is scored; only the report is cut.
    """
    hubs = entity_stats(edges, layers).filter(f"n_users >= {min_users}")
    marks = flags.selectExpr("user_id", f"coalesce(CAST({flag} AS INT), 0) AS flagged")
    flagged = edges.select(*ENTITY, "user_id").distinct().join(marks, "user_id", "left").groupBy(*ENTITY).agg(
        F.expr("avg(coalesce(flagged, 0))").alias("flagged_coverage"))
    scored = hubs.join(flagged, list(ENTITY)).withColumn("score", F.expr("users_per_day * (1 - flagged_coverage)"))
    return scored.orderBy(F.desc("score"), "entity_value", "entity_type").limit(top_n)


def multi_witness_pairs(edges: DataFrame, flags: DataFrame, flag: str, *, degree_cap: int | None, min_types: int = 2,
                        layers: Sequence[str] = DEFAULT_LAYERS) -> DataFrame:
    """User pairs without the flag that share entities of at least ``min_types`` types."""
    known = flags.filter(f"CAST({flag} AS INT) = 1").select("user_id")
    pairs = project_users(edges, layers=layers, degree_cap=degree_cap).filter(f"n_types >= {min_types}")
    for side in ("user_a", "user_b"):
        pairs = pairs.join(known.withColumnRenamed("user_id", side), side, "left_anti")
    return pairs.orderBy(F.desc("n_types"), F.desc("n_shared"), "user_a", "user_b")


def fresh_rings(edges: DataFrame, users: DataFrame, flags: DataFrame, flag: str = "is_fraud", *, days: int = 7,
                min_users: int = 2, layers: Sequence[str] = DEFAULT_LAYERS, degree_cap: int | None = None) -> DataFrame:
    """Rings formed by the edges of the last ``days`` before the newest edge."""
    bounds = edges.agg(F.max("ts").alias("hi")).selectExpr(
        f"CAST(hi - INTERVAL {days} DAYS AS STRING) AS lo", "CAST(hi AS STRING) AS hi").first()
    recent = view(edges, layers=layers, degree_cap=degree_cap, window=(bounds.lo, bounds.hi))
    rings = user_census(recent, users, flags, flag)[1].filter(f"n_users >= {min_users}")
    return rings.selectExpr("*", f"timestamp_ntz'{bounds.lo}' AS window_start", f"timestamp_ntz'{bounds.hi}' AS window_end").orderBy(
        F.desc("n_types"), F.desc("n_users"), "comp_id")


def user_truth(advances: DataFrame, rules: Sequence[Rule], *, start: str | None = None, mature_only: bool = True) -> DataFrame:
    """User-level outcomes over pooled advances: max of labels and flags, first time seen."""
    rows = advances.filter("label_mature_d45 = 1") if mature_only else advances
    if start:
        rows = rows.filter(f"{TS} >= timestamp_ntz'{start}'")
    return rows.withColumn("__scen", any_flag(rules)).groupBy("user_id").agg(
        F.max("is_fraud").alias("is_fraud"), F.max("label_gross_dpd45").alias("dpd45"),
        F.max("__scen").alias("scen"), F.min(TS).alias("first_ts"))


def pooled_rates(truth: DataFrame, members: DataFrame | None = None, groups: Mapping[str, str] | None = None) -> DataFrame:
    """Users and outcome rates for the pool, its early and late halves (by median first time) and the unflagged cut."""
    timed = truth.withColumn("__m", F.expr(clock.wall_micros("first_ts")))
    middle = exact_quantiles(timed, ["__m"], [0.5])["__m"][0]
    rows = timed.withColumn("mid", F.lit(middle))
    if members is not None:
        rows = rows.join(members.select("user_id").distinct(), "user_id", "left_semi")
    groups = groups or {"pool": "true", "early": "__m <= mid", "late": "__m > mid", "residual": "NOT scen"}
    # One aggregate for all scopes, then one line per scope.
    rates = {"fraud_rate": "is_fraud", "dpd45_rate": "dpd45", "flagged_rate": "CAST(scen AS INT)"}
    cells = [F.expr(f"count_if({w})").alias(f"n{i}") for i, w in enumerate(groups.values())]
    cells += [F.expr(f"avg(IF({w}, {e}, NULL))").alias(f"{n}{i}") for i, w in enumerate(groups.values()) for n, e in rates.items()]
    lines = ", ".join(f"'{name}', n{i}, " + ", ".join(f"{n}{i}" for n in rates) for i, name in enumerate(groups))
    return rows.agg(*cells).selectExpr(f"stack({len(groups)}, {lines}) AS (scope, n_users, {', '.join(rates)})")


def rings_spanned(members: DataFrame, users: DataFrame) -> DataFrame:
    """Distinct components the given users lie in."""
    return members.join(users.select("user_id"), "user_id", "left_semi").select("comp_id").distinct().agg(
        F.count("*").alias("n_components"))


def outcome_check(queue: DataFrame, truth: DataFrame) -> DataFrame:
    """Outcome rates of the queued users that have known truth."""
    known = truth.withColumn("user_id", F.col("user_id").cast("string"))
    return known.join(queue.select(F.col("user_id").cast("string").alias("user_id")).distinct(), "user_id", "left_semi").agg(
        F.count("*").alias("n_users"), F.expr("avg(dpd45)").alias("dpd45_rate"), F.expr("avg(is_fraud)").alias("fraud_rate"))
