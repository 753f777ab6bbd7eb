"""Hops, ego rings, projection and hub reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidegate.graph.store import DEFAULT_LAYERS, ENTITY, ENTITY_COLUMNS, TS, check_layers, entities_of_several, user_pairs, view
from tidegate.session import stored

BLOCK_USERS = 1000  # users of an entity that meet under one key


def incidences(edges: DataFrame) -> DataFrame:
    """Distinct (user, entity) pairs of edges, whose rows may repeat, written once for several traversals."""
    return stored(user_pairs(edges).select("user_id", "entity"), "pairs")


def reach(edges: DataFrame, seeds: DataFrame, max_hops: int, *, pairs: DataFrame | None = None) -> DataFrame:
    """Users within ``max_hops`` user-hops of the seeds: (user_id, hops, nearest); ``pairs`` are the edges' ``incidences``.

    One frontier step is users -> entities -> users. An entity expands once, so
    the total work is linear in the edges. Ties go to the smallest seed id. Frontiers
    are written as tables, whose size Spark knows: a small one is broadcast and moves no pairs.
    """
    pairs = incidences(edges) if pairs is None else pairs
    frontier = seeds.selectExpr("CAST(user_id AS STRING) AS user_id").distinct().selectExpr(
        "user_id", "0 AS hops", "user_id AS nearest")
    seen = stored(frontier, "frontier")
    frontier, opened = seen, None
    for hop in range(1, max_hops + 1):
        touched = pairs.join(frontier.select("user_id", "nearest"), "user_id").groupBy("entity").agg(
            F.min("nearest").alias("nearest"))
        if opened is not None:
            touched = touched.join(opened, "entity", "left_anti")
        touched = stored(touched, "touched")
        frontier = stored(
            pairs.join(touched, "entity").groupBy("user_id").agg(F.min("nearest").alias("nearest"))
            .join(seen.select("user_id"), "user_id", "left_anti").selectExpr("user_id", f"{hop} AS hops", "nearest"), "frontier")
        opened = touched.select("entity") if opened is None else opened.unionByName(touched.select("entity"))
        seen = seen.unionByName(frontier)
    return seen


def near_flagged(edges: DataFrame, flagged: DataFrame, max_hops: int = 3, *, pairs: DataFrame | None = None) -> DataFrame:
    """Unflagged users near a flagged one, with the hop count and the nearest flagged user."""
    return reach(edges, flagged, max_hops, pairs=pairs).filter("hops >= 1").selectExpr(
        "user_id", "hops", "nearest AS nearest_flagged")


def ring(edges: DataFrame, user_id: str, hops: int = 2) -> DataFrame:
    """Edges of the subgraph induced by everything within ``hops`` user-hops of one user.

    The last step reaches users, so an edge belongs when its user is in reach and
    its entity touches a user one hop closer (or the same entity was opened).
    """
    center = edges.filter(F.col("user_id").cast("string") == str(user_id)).select("user_id").distinct()
    # A ring is small beside its graph: the graph's incidences stay as they are instead of being made distinct and written.
    around = reach(edges, center, hops, pairs=edges.selectExpr("CAST(user_id AS STRING) AS user_id", "concat(entity_type, ':', entity_value) AS entity"))
    inner = around.filter(F.col("hops") < hops).select("user_id")
    entities = stored(edges.join(inner.withColumn("user_id", F.col("user_id").cast(dict(edges.dtypes)["user_id"])),
                                 "user_id", "left_semi").select(*ENTITY).distinct(), "entities")
    return edges.join(entities, list(ENTITY), "left_semi")


def project_users(edges: DataFrame, *, degree_cap: int | None, layers: Sequence[str] = DEFAULT_LAYERS,
                  as_of: str | None = None, block_users: int = BLOCK_USERS) -> DataFrame:
    """User pairs sharing entities: how many, and of how many types (user_a < user_b).

    Without a cap the result holds every pair of a hub. The users of an entity
    above ``block_users`` are dealt to blocks, and every two blocks meet under a
    key of their own, so a key never emits more than ``block_users`` squared pairs
    (about: blocks are dealt by hash) however large its entity is. Edges may repeat.
    """
    # An entity of one user makes no pair, and most are: only the others take part, and are made distinct.
    rows = view(edges, layers=layers, as_of=as_of).select("user_id", *ENTITY).filter("user_id IS NOT NULL")
    met = stored(rows.join(entities_of_several(rows, "user_id"), list(ENTITY), "left_semi").distinct(), "met")
    pairs = view(met, layers=layers, degree_cap=degree_cap)
    hubs = pairs.groupBy(*ENTITY).agg(F.count("*").alias("n")).filter(F.col("n") > block_users) \
        .select(*ENTITY, F.ceil(F.col("n") / block_users).cast("int").alias("blocks"))
    dealt = pairs.join(hubs, list(ENTITY), "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))) \
        .withColumn("own", F.pmod(F.xxhash64("user_id"), F.col("blocks")).cast("int"))
    # The left user's block is the first of the key, the right user's the second; a user stands once per other block.
    first = dealt.select(*ENTITY, F.col("user_id").alias("u"), F.col("own").alias("i"),
                         F.explode(F.sequence("own", F.col("blocks") - 1)).alias("j"))
    second = dealt.select(*ENTITY, F.col("user_id").alias("v"), F.explode(F.sequence(F.lit(0), "own")).alias("i"), F.col("own").alias("j"))
    met = first.join(second, [*ENTITY, "i", "j"]).filter("u <> v AND (i < j OR u < v)")
    per_type = met.groupBy(F.least("u", "v").alias("user_a"), F.greatest("u", "v").alias("user_b"), "entity_type").agg(F.count("*").alias("n"))
    return per_type.groupBy("user_a", "user_b").agg(F.sum("n").alias("n_shared"), F.count("*").alias("n_types"))


def entity_stats(edges: DataFrame, layers: Sequence[str] = tuple(ENTITY_COLUMNS)) -> DataFrame:
    """Per entity: distinct users, edges, days between first and last edge, users per day."""
    check_layers(layers)
    kept = edges.filter(F.col("entity_type").isin(*layers))
    # One line per (entity, user) first: a hot entity arrives already collapsed.
    per_user = kept.groupBy(*ENTITY, "user_id").agg(
        F.count("*").alias("n"), F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    return per_user.groupBy(*ENTITY).agg(
        F.count("*").alias("n_users"), F.sum("n").alias("n_edges"),
        F.expr("CAST(datediff(CAST(max(hi) AS DATE), CAST(min(lo) AS DATE)) AS BIGINT)").alias("span_days"),
    ).withColumn("users_per_day", F.expr("round(n_users / greatest(span_days, 1L), 3)"))


def hub_report(edges: DataFrame, advances: DataFrame, top_n: int = 20,
               layers: Sequence[str] = tuple(ENTITY_COLUMNS), label: str = "is_fraud") -> DataFrame:
    """Largest entities without any cap, with speed and flagged share of their users.

    Only the top entities are looked up again for their users' labels.
    """
    top = entity_stats(edges, layers).orderBy(F.desc("n_users"), "entity_value", "entity_type").limit(top_n)
    labels = advances.groupBy("user_id").agg(F.max(label).alias(label))
    users = edges.join(F.broadcast(top.select(*ENTITY)), list(ENTITY), "left_semi").select(
        *ENTITY, "user_id").distinct().join(labels, "user_id")
    rate = users.groupBy(*ENTITY).agg(F.round(F.avg(label), 3).alias("fraud_user_rate"))
    return top.join(rate, list(ENTITY)).orderBy(F.desc("n_users"), "entity_value")
