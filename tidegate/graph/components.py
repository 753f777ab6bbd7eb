"""Connected components by hooking to the smallest neighbour and contraction."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidegate.graph.store import ENTITY, rows_of
from tidegate.session import cut_lineage, stored

REST = 200_000  # links (3 MB) that one task may finish


def contract(links: DataFrame) -> DataFrame:
    """(vertex, component) of ``links(a, b)`` over long ids; component is the smallest reachable vertex.

    Each round every vertex points at its smallest neighbour, pointers are halved
    twice, and the links are rewritten between the roots, so the graph shrinks by
    a constant factor at least; hubs only meet a minimum, which merges before the
    shuffle. A round writes its pointers and its links once; the pointers
    are composed at the end. At most ``REST`` links are finished as one group.
    Vertices without links are absent.
    """
    edges = stored(links.selectExpr("least(a, b) AS a", "greatest(a, b) AS b").filter("a < b").distinct(), "links")
    rounds = []  # vertex -> its root among the vertices of the next round
    while edges.limit(REST + 1).count() > REST:
        both = edges.unionByName(edges.selectExpr("b AS a", "a AS b"))
        root = both.groupBy("a").agg(F.min("b").alias("low")).selectExpr("a AS v", "least(a, low) AS r")
        for _ in range(2):
            up = root.selectExpr("v AS r", "r AS top")
            root = root.join(up, "r").selectExpr("v", "top AS r")
        root = stored(root, "roots")  # read three times
        rounds.append(root)
        low, high = root.selectExpr("v AS a", "r AS ra"), root.selectExpr("v AS b", "r AS rb")
        edges = stored(edges.join(low, "a").join(high, "b").selectExpr("least(ra, rb) AS a", "greatest(ra, rb) AS b")
                       .filter("a < b").distinct(), "links")
    names = cut_lineage(edges.groupBy(F.lit("all").alias("g")).applyInPandas(_finish, "v long, r long"))
    for root in reversed(rounds):
        names = root.join(names.selectExpr("v AS r", "r AS top"), "r", "left").selectExpr("v", "coalesce(top, r) AS r")
    return names.selectExpr("v AS vertex", "r AS component")


def _finish(links: pd.DataFrame) -> pd.DataFrame:
    """Components of a bounded graph: labels sink to their minimum along links and pointers."""
    ids, ends = np.unique(links[["a", "b"]].to_numpy(), return_inverse=True)
    a, b = ends.reshape(-1, 2).T
    low = np.arange(len(ids))
    while True:
        least = np.minimum(low[a], low[b])
        lower = low.copy()
        for end in (a, b, low[a], low[b]):
            np.minimum.at(lower, end, least)
        lower = lower[lower]
        if (lower == low).all():
            return pd.DataFrame({"v": ids, "r": ids[low]})
        low = lower


def label_components(links: DataFrame) -> DataFrame:
    """(vertex, comp) for every vertex of ``links(src, dst)``; comp is the smallest vertex name.

    Names become 64-bit hashes once, so rounds shuffle numbers only; names come
    back at the end, with one minimum per component. Links may repeat: they are
    made distinct as pairs of hashes, which are smaller. Names are written as
    Parquet, which packs them; a checkpoint would not.
    """
    links = stored(links.select("src", "dst"), "links")
    names = links.selectExpr("explode(array(src, dst)) AS vertex").distinct().withColumn("id", F.xxhash64("vertex"))
    roots = contract(links.selectExpr("xxhash64(src) AS a", "xxhash64(dst) AS b")).selectExpr("vertex AS id", "component")
    placed = stored(names.join(roots, "id", "left").selectExpr("vertex", "coalesce(component, id) AS root"), "placed")
    least = placed.groupBy("root").agg(F.min("vertex").alias("comp"))
    return placed.join(least, "root").select("vertex", "comp")


def vertex_components(edges: DataFrame, users: DataFrame) -> DataFrame:
    """(vertex, kind, comp) of a bipartite view, whose rows may repeat; users without edges are their own component."""
    labels = label_components(edges.selectExpr("concat('user:', CAST(user_id AS STRING)) AS src", "concat(entity_type, ':', entity_value) AS dst"))
    alone = users.selectExpr("concat('user:', CAST(user_id AS STRING)) AS vertex").distinct()
    every = labels.join(alone, "vertex", "full").selectExpr("vertex", "coalesce(comp, vertex) AS comp")
    return every.selectExpr("vertex", "substring_index(vertex, ':', 1) AS kind", "comp AS comp_id")


def census(membership: DataFrame, flags: DataFrame, flag: str, *, with_users: bool = False) -> DataFrame:
    """Per component: users, entities, entity types and flagged users.

    The member list as text is optional; by default members stay in the
    ``membership`` table.
    """
    flagged = flags.selectExpr("concat('user:', CAST(user_id AS STRING)) AS vertex", f"CAST({flag} AS INT) AS flagged")
    rows = membership.join(flagged, "vertex", "left")
    per_kind = rows.groupBy("comp_id", "kind").agg(
        F.count("*").alias("n"), F.expr("sum(coalesce(flagged, 0))").alias("hits"))
    # At most one line per entity type and component reaches this collect.
    out = per_kind.groupBy("comp_id").agg(
        F.expr("coalesce(sum(IF(kind = 'user', n, 0L)), 0L)").alias("n_users"),
        F.expr("coalesce(sum(IF(kind <> 'user', n, 0L)), 0L)").alias("n_entities"),
        F.expr("array_join(array_sort(collect_list(IF(kind <> 'user', kind, NULL))), ',')").alias("entity_types"),
        F.expr("count_if(kind <> 'user')").alias("n_types"),
        F.expr("sum(IF(kind = 'user', hits, 0L))").alias("n_flagged"))
    if with_users:
        names = membership.filter("kind = 'user'").groupBy("comp_id").agg(F.expr(
            "array_join(array_sort(collect_list(substring(vertex, 6))), ',')").alias("user_ids"))
        out = out.join(names, "comp_id", "left")
    return out


def user_census(edges: DataFrame, users: DataFrame, flags: DataFrame, flag: str) -> tuple[DataFrame, DataFrame]:
    """Members, users only, and ``census`` of the components of a bipartite view, whose rows may repeat.

    An entity of one row joins nobody and most have one: it is only counted and
    named at its user, where the rows of an advance merge before the shuffle. The rows
    of the others link their users, and are taken off where they count an entity again.
    """
    cells = stored(edges.filter("user_id IS NOT NULL AND entity_value IS NOT NULL").select("user_id", *ENTITY), "cells")
    met = stored(rows_of(cells, "count(*) > 1"), "met")
    spread = stored(met.groupBy(*ENTITY).agg(F.min("user_id").alias("low"), F.count("*").alias("n")), "spread")
    name = "xxhash64(CAST({} AS STRING))"
    roots = contract(met.join(spread.select(*ENTITY, "low"), list(ENTITY)).selectExpr(
        f"{name.format('low')} AS a", f"{name.format('user_id')} AS b"))
    own = stored(cells.groupBy("user_id", "entity_type").agg(F.count("*").alias("n"), F.min("entity_value").alias("least")), "own")
    every = own.selectExpr("CAST(user_id AS STRING) AS user_id", "concat(entity_type, ':', least) AS least").unionByName(
        users.filter("user_id IS NOT NULL").selectExpr("CAST(user_id AS STRING) AS user_id", "CAST(NULL AS STRING) AS least"))
    people = every.groupBy("user_id").agg(F.min("least").alias("least")).withColumn("vertex", F.xxhash64("user_id"))
    people = stored(people.join(roots, "vertex", "left").selectExpr(
        "user_id", "coalesce(component, vertex) AS root", "least(least, concat('user:', user_id)) AS least"), "people")
    marks = flags.selectExpr("CAST(user_id AS STRING) AS user_id", f"CAST({flag} AS INT) AS flagged")
    heads = people.join(marks, "user_id", "left").groupBy("root").agg(
        F.min("least").alias("comp_id"), F.count("*").alias("n_users"), F.expr("sum(coalesce(flagged, 0))").alias("n_flagged"))
    counts = own.selectExpr("CAST(user_id AS STRING) AS user_id", "entity_type", "n").unionByName(
        spread.selectExpr("CAST(low AS STRING) AS user_id", "entity_type", "1 - n AS n"))
    kinds = counts.join(people.select("user_id", "root"), "user_id").groupBy("root", "entity_type").agg(F.sum("n").alias("n")).groupBy("root").agg(
        F.sum("n").alias("n_entities"), F.expr("array_join(array_sort(collect_list(entity_type)), ',')").alias("entity_types"),
        F.count("*").alias("n_types"))
    rings = stored(heads.join(kinds, "root", "left").selectExpr(
        "root", "comp_id", "n_users", "coalesce(n_entities, 0L) AS n_entities", "coalesce(entity_types, '') AS entity_types",
        "coalesce(n_types, 0L) AS n_types", "n_flagged"), "rings")
    members = people.join(rings.select("root", "comp_id"), "root").selectExpr("concat('user:', user_id) AS vertex", "'user' AS kind", "comp_id")
    return members, rings.drop("root")
