"""Leak-free graph features: what each advance could know at its own moment.

Events are ordered by (time, read before seed, advance id). An advance reads the
graph, then adds its edges; a bad outcome seeds its user when it becomes known.
A read depends on the state before it, so the work is cut twice, both exactly:

* state never crosses a final connected component, so components are
  independent units;
* a unit that is still too large is halved in time. The later half starts from
  the earlier one by contracting each component the earlier edges formed into
  one vertex that carries its user, seed and type totals. All halves of a level
  are processed together and then fall apart into components again.

Only units of bounded size reach a task as a group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidegate.functions import clock
from tidegate.graph.components import contract
from tidegate.graph.store import DEFAULT_LAYERS, ENTITY, ENTITY_COLUMNS, TS, degrees, rows_of, view
from tidegate.operators.prefix import POS, Fold, fold_until
from tidegate.session import cut_lineage, stored

# Rows (event x entity that links users) a single task replays at once; larger units are halved.
UNIT_ROWS = 500_000
PACK_ROWS = 50_000
HUB_SEEDS = 100  # seeded users of an entity up to which a read meets each of them
_BASE = -1  # position of rows that carry the state a unit starts from
# Vertices and units are hashes; an ``ent_v`` equal to ``user_v`` links nothing.
_COLUMNS = ("unit", "o", "is_read", "user_v", "ent_v", "bit", "adds", "du", "ds")
_RESULT = "o long, comp_users long, comp_types int, nb_comp long"


def _touched(per_advance: DataFrame, edges: DataFrame, layers: Sequence[str], degree_cap: int | None) -> tuple[DataFrame, DataFrame]:
    """(advance_id, bits) of the entity types an advance touches, and (advance_id, ent_v) of the entities that can link users.

    An entity of one user, as most are, links nobody: all it does is show its type.
    """
    kept = view(edges, layers=layers).filter("entity_value IS NOT NULL")
    if degree_cap is not None and degree_cap < 1:
        kept = kept.filter("false")  # every entity has a user
    cells = stored(kept.select("advance_id", "user_id", *ENTITY), "cells")
    # An advance of several users acts for the first of them, which its edges need not name.
    odd = stored(per_advance.filter("mixed").selectExpr("advance_id", "1 AS odd"), "odd")
    met = stored(rows_of(cells.join(odd, "advance_id", "left"),
                         "min(user_id) < max(user_id) OR bool_or(user_id IS NULL OR odd IS NOT NULL)").drop("odd"), "met")
    if degree_cap is not None:
        hubs = stored(degrees(met).filter(F.col("n_users") > degree_cap).select(*ENTITY), "hubs")
        cells, met = (df.join(hubs, list(ENTITY), "left_anti") for df in (cells, met))
    bit = "CASE entity_type " + " ".join(f"WHEN '{t}' THEN {1 << i}" for i, t in enumerate(ENTITY_COLUMNS)) + " END"
    bits = cells.groupBy("advance_id").agg(F.expr(f"bit_or(CAST({bit} AS INT))").alias("bit"))
    return bits, stored(met.selectExpr("advance_id", "concat(entity_type, ':', entity_value) AS ent_v").distinct(), "touched")


def _ordered_events(per_advance: DataFrame, bits: DataFrame) -> DataFrame:
    """Reads and seeds with a dense order-preserving position ``o``."""
    events = per_advance.filter("user_id IS NOT NULL").join(bits, "advance_id", "left").selectExpr(
        "advance_id", "user_id", "ts", "coalesce(bit, 0) AS bit",
        f"inline(array(named_struct('m', {clock.wall_micros('ts')}, 'kind', 0), "
        f"named_struct('m', IF(CAST(seed AS INT) = 1, {clock.wall_micros('seed_ts')}, NULL), 'kind', 1)))",
    ).filter("m IS NOT NULL")
    # A global range sort; the id grows along it. Written here so positions are fixed.
    return stored(events.orderBy("m", "kind", F.col("advance_id").cast("string"))
                  .withColumn("o", F.monotonically_increasing_id()).drop("m"), "events")


def leakfree_features(
    advances: DataFrame,
    edges: DataFrame,
    *,
    layers: Sequence[str] = DEFAULT_LAYERS,
    degree_cap: int | None,
    seed_label: str = "label_gross_dpd45",
    seed_activation: str = "expected_dpd45_date",
    unit_rows: int = UNIT_ROWS,
    hub_seeds: int = HUB_SEEDS,
) -> DataFrame:
    """Per advance: users and entity types of its component, other seeded users there and at distance one.

    A null activation never seeds. Ties at one instant go by advance id. No cap is needed; with one, hubs link nobody.
    Edges may repeat.
    """
    per_advance = stored(advances.groupBy("advance_id").agg(
        F.min("user_id").alias("user_id"), F.expr("min(user_id) < max(user_id) OR count(user_id) < count(*)").alias("mixed"),
        F.min(TS).alias("ts"), F.max(seed_label).alias("seed"), F.min(seed_activation).alias("seed_ts")), "advances")
    bits, touched = _touched(per_advance, edges, layers, degree_cap)
    events = _ordered_events(per_advance, bits)
    firsts = events.groupBy("user_id").agg(
        F.min("o").alias("first_o"), F.min(F.expr("IF(kind = 1, o, NULL)")).alias("seed_o"))
    # "first" and "seeded" marks per event; reads carry what their own user had done.
    marked = stored(events.join(firsts, "user_id").selectExpr(
        "o", "kind = 0 AS is_read", "advance_id", "user_id", "ts", "bit",
        "kind = 0 OR o = first_o AS adds", "o = first_o AS is_first", "coalesce(o = seed_o, false) AS is_seed",
        "o > first_o AS was_present", "coalesce(o > seed_o, false) AS was_seeded"), "marked") \
        .withColumn("user_v", F.expr("xxhash64('user', CAST(user_id AS STRING))"))
    meets = stored(marked.select("o", "is_read", "adds", "advance_id", "user_v").join(touched, "advance_id").drop("advance_id"), "meets")
    # One row per event, which carries its marks and types, and one per entity it links.
    linking = meets.filter("adds").selectExpr(
        "0L AS unit", "o", "is_read", "user_v", "xxhash64(ent_v) AS ent_v", "0 AS bit", "adds", "0L AS du", "0L AS ds")
    rows = marked.selectExpr("0L AS unit", "o", "is_read", "user_v", "user_v AS ent_v", "bit", "adds", "CAST(is_first AS BIGINT) AS du",
                             "CAST(is_seed AS BIGINT) AS ds").unionByName(linking)
    counted = _replay_units(stored(_into_units(rows, _labels(linking)), "replay"), unit_rows)
    direct = stored(_direct_seeds(meets, hub_seeds), "direct")
    reads = marked.filter("is_read AND advance_id IS NOT NULL").select("o", "advance_id", "user_id", "ts", "was_present", "was_seeded")
    return reads.join(counted, "o", "left").join(direct, "o", "left").selectExpr(
        "CAST(advance_id AS STRING) AS advance_id", "CAST(user_id AS STRING) AS user_id", "ts",
        "comp_users + IF(was_present, 0L, 1L) AS comp_users", "comp_types",
        "nb_comp - IF(was_seeded, 1L, 0L) AS nb_comp", "coalesce(nb_d1, 0L) AS nb_d1")


def _direct_seeds(meets: DataFrame, hub_seeds: int) -> DataFrame:
    """Other seeded users that share an entity directly, per read.

    An entity of at most ``hub_seeds`` seeded users is met user by user, so a read
    makes a bounded number of pairs. Larger ones, the hubs, are only counted; see
    ``_hub_seeds``. A user met both ways counts with the hubs.
    """
    seeds = cut_lineage(meets.filter("NOT is_read").groupBy("ent_v", "user_v").agg(F.min("o").alias("seed_o")))
    reads = meets.filter("is_read").select("o", "user_v", "ent_v")
    hubs = cut_lineage(seeds.groupBy("ent_v").agg(F.count("*").alias("n")).filter(F.col("n") > hub_seeds))
    met = reads.join(seeds.join(hubs, "ent_v", "left_anti").withColumnRenamed("user_v", "seed_user"), "ent_v").filter(
        "seed_o < o AND seed_user <> user_v").select("o", "seed_user").distinct()
    if hubs.isEmpty():
        return met.groupBy("o").agg(F.count("*").alias("nb_d1"))
    at_hubs = cut_lineage(reads.join(hubs.select("ent_v"), "ent_v", "left_semi"))
    hub_users = seeds.join(hubs.select("ent_v"), "ent_v", "left_semi").withColumnRenamed("user_v", "seed_user")
    twice = met.join(at_hubs.select("o", "ent_v"), "o").join(hub_users, ["ent_v", "seed_user"]).filter("seed_o < o") \
        .select("o", "seed_user").distinct()
    few = met.join(twice, ["o", "seed_user"], "left_anti").groupBy("o").agg(F.count("*").alias("few"))
    return few.join(_hub_seeds(at_hubs, hub_users, hubs), "o", "full").selectExpr(
        "o", "coalesce(few, 0L) + coalesce(users, 0L) AS nb_d1")


def _hub_seeds(reads: DataFrame, seeds: DataFrame, sizes: DataFrame) -> DataFrame:
    """(o, users): other seeded users of the read hubs, without their pairs.

    Users are counted by inclusion and exclusion over the few hubs of an advance:
    for every set of them, a running count of the users that touched all of the
    set. Of a set, only the users of its smallest hub are looked up in the others;
    a set is looked up once, however many advances read it.
    """
    whole = reads.groupBy("o").agg(F.sort_array(F.collect_set("ent_v")).alias("ents"))
    chosen = F.expr("filter(ents, (e, i) -> (shiftright(mask, i) & 1) = 1)")
    asked = cut_lineage(whole.withColumn("mask", F.explode(F.expr("sequence(1, shiftleft(1, size(ents)) - 1)")))
                        .select("o", chosen.alias("ents")).withColumn("grp", F.md5(F.array_join("ents", "\n"))))
    rarest = asked.filter("size(ents) > 1").select("grp", "ents").distinct().select("grp", "ents", F.explode("ents").alias("ent_v")) \
        .join(sizes, "ent_v").groupBy("grp").agg(F.min(F.struct("n", "ent_v")).alias("rare"), F.first("ents").alias("ents"))
    others = rarest.select("grp", "ents", F.col("rare.ent_v").alias("ent_v")).join(seeds, "ent_v") \
        .select("grp", "seed_user", "seed_o", F.size("ents").alias("k"), F.explode(F.array_except("ents", F.array("ent_v"))).alias("ent_v"))
    both = others.join(seeds.withColumnRenamed("seed_o", "other_o"), ["ent_v", "seed_user"]).groupBy("grp", "seed_user").agg(
        F.count("*").alias("met"), F.max("k").alias("k"), F.max(F.greatest("seed_o", "other_o")).alias("seed_o")).filter("met = k - 1")
    changes = seeds.select(F.md5("ent_v").alias("grp"), F.col("seed_o").alias(POS), F.lit(1).cast("bigint").alias("seeded")).unionByName(
        both.select("grp", F.col("seed_o").alias(POS), F.lit(1).cast("bigint").alias("seeded")))
    counts = fold_until(changes, asked.select("grp", F.col("o").alias(POS)), ["grp"], [Fold("seeded")], bucket=f"shiftright({POS}, 20)")
    total = asked.join(counts.withColumnRenamed(POS, "o"), ["grp", "o"]).groupBy("o").agg(
        F.sum(F.when(F.size("ents") % 2 == 1, F.col("seeded")).otherwise(-F.col("seeded"))).alias("users"))
    itself = reads.join(seeds.withColumnRenamed("seed_user", "user_v"), ["ent_v", "user_v"]) \
        .filter("seed_o < o").select("o").distinct().withColumn("own", F.lit(1))
    return total.join(itself, "o", "left").selectExpr("o", "users - coalesce(own, 0) AS users")


def _links(rows: DataFrame) -> DataFrame:
    return rows.filter("adds AND ent_v <> user_v").selectExpr("xxhash64(unit, user_v) AS a", "xxhash64(unit, ent_v) AS b")


def _labels(rows: DataFrame) -> DataFrame:
    return stored(contract(_links(rows)), "labels")


def _into_units(rows: DataFrame, labels: DataFrame, half: int = 0) -> DataFrame:
    """Split each unit into the components its own edges form; the later half has names of its own."""
    named = rows.withColumn("vertex", F.expr("xxhash64(unit, user_v)")).join(labels, "vertex", "left")
    return named.selectExpr(f"xxhash64(coalesce(component, vertex), {half}) AS unit", *[c for c in _COLUMNS if c != "unit"])


def _replay_units(rows: DataFrame, unit_rows: int) -> DataFrame:
    """Halve oversized units until all fit a task, then replay every unit."""
    done = []
    while True:
        large = stored(rows.groupBy("unit").agg(F.count("*").alias("n")).filter(F.col("n") > unit_rows).select("unit"), "large")
        big = stored(rows.filter(f"o > {_BASE}").join(large, "unit").groupBy("unit").agg(
            F.min("o").alias("lo"), F.max("o").alias("hi"), F.expr("percentile_approx(o, 0.5, 1000)").alias("mid"))
            .filter("hi > lo").selectExpr("unit", "IF(mid >= hi, hi - 1, mid) AS cut"), "big")
        if big.isEmpty():
            done.append(rows)
            break
        done.append(rows.join(big.select("unit"), "unit", "left_anti"))
        rows = _halve(rows.join(big, "unit"))
    whole = reduce(DataFrame.unionByName, done)
    # Most units are tiny: whole units are packed together so that a task call
    # replays about PACK_ROWS rows, never more than a few units' worth beyond it.
    packs = max(1, -(-whole.count() // PACK_ROWS))
    packed = whole.withColumn("pack", F.pmod(F.xxhash64("unit"), F.lit(packs)))
    return packed.groupBy("pack").applyInPandas(_replay_pack, _RESULT)


def _halve(rows: DataFrame) -> DataFrame:
    rows = stored(rows, "replay")
    early = rows.filter("o <= cut")
    labels = _labels(early)  # they name the units of the earlier half as well

    def renamed(df: DataFrame, column: str) -> DataFrame:
        return df.withColumn("vertex", F.expr(f"xxhash64(unit, {column})")).join(labels, "vertex", "left").withColumn(
            column, F.coalesce("component", column)).drop("vertex", "component")

    late = renamed(renamed(rows.filter("o > cut"), "user_v"), "ent_v")
    # State at the cut: marks once per event, type bits of every event that added edges, earlier base rows.
    marks = early.groupBy("unit", "o", "user_v").agg(
        F.max("du").alias("du"), F.max("ds").alias("ds"), F.expr("bit_or(IF(adds, bit, 0))").alias("bit"))
    base = renamed(marks, "user_v").groupBy("unit", "user_v").agg(
        F.sum("du").alias("du"), F.sum("ds").alias("ds"), F.expr("bit_or(bit)").alias("bit"))
    # Only vertices a later event touches can matter.
    live = late.selectExpr("unit", "explode(array(user_v, ent_v)) AS user_v").distinct()
    start = base.join(live, ["unit", "user_v"], "left_semi").selectExpr(
        "unit", f"CAST({_BASE} AS BIGINT) AS o", "false AS is_read", "user_v", "user_v AS ent_v", "bit", "true AS adds", "du", "ds")
    later = stored(late.selectExpr(*_COLUMNS).unionByName(start.selectExpr(*_COLUMNS)), "replay")
    return stored(_into_units(early.selectExpr(*_COLUMNS), labels).unionByName(_into_units(later, _labels(later), 1)), "replay")


def _replay_pack(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["unit", "o"], kind="stable")
    unit = rows["unit"].to_numpy()
    starts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
    lines = list(rows[list(_COLUMNS)].itertuples(index=False))
    results = []
    for a, b in zip(starts, [*starts[1:], len(lines)]):
        results += _replay(lines[a:b])
    return pd.DataFrame(results, columns=["o", "comp_users", "comp_types", "nb_comp"])


def _replay(lines: list) -> list[tuple]:
    """Walk one unit's events in order over a disjoint-set forest."""
    parent: dict[int, int] = {}
    totals: dict[int, list[int]] = {}  # root -> [users, seeds, type bits]

    def root(v: int) -> int:
        if v not in parent:
            parent[v], totals[v] = v, [0, 0, 0]
        path = []
        while parent[v] != v:
            path.append(v)
            v = parent[v]
        for p in path:
            parent[p] = v
        return v

    def join(a: int, b: int) -> None:
        a, b = root(a), root(b)
        if a != b:
            if totals[a][0] < totals[b][0]:
                a, b = b, a
            parent[b] = a
            ta, tb = totals[a], totals.pop(b)
            totals[a] = [ta[0] + tb[0], ta[1] + tb[1], ta[2] | tb[2]]

    results = []
    for o, group in groupby(lines, key=lambda r: r.o):
        event = list(group)
        if o == _BASE:
            for r in event:
                t = totals[root(r.user_v)]
                t[0] += r.du
                t[1] += r.ds
                t[2] |= r.bit
            continue
        first = event[0]
        user, ents, bits = first.user_v, [r.ent_v for r in event if r.ent_v != r.user_v], 0
        for r in event:
            bits |= r.bit
        if first.is_read:
            roots = {root(v) for v in (user, *ents)}
            kinds = bits
            for r in roots:
                kinds |= totals[r][2]
            results.append((o, sum(totals[r][0] for r in roots), kinds.bit_count(), sum(totals[r][1] for r in roots)))
        if first.adds:
            for e in ents:
                root(e)
                join(user, e)
        t = totals[root(user)]
        if first.adds:
            t[2] |= bits
        t[0] += max(r.du for r in event)
        t[1] += max(r.ds for r in event)
    return results
