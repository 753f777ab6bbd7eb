"""Edge store built from a wide advance table, and filtered views of it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.plans.rules import Rule, with_flags
from tidegate.session import stored

# Entity type -> column, and text that is not an identity.
ENTITY_COLUMNS = {
    "device": "device_id", "bank": "bank_account_key", "persistent": "persistent_account_id",
    "phone": "phone_key", "address": "address_key", "email": "email_key", "ip": "ip_address",
}
SENTINELS = ("", "none", "nan", "null", "nat", "0", "0-0", "none-none")
DEFAULT_LAYERS = ("device", "bank", "persistent", "phone", "address")
RING_CAP = 20
TS = "feature_as_of_ts"
ENTITY = ("entity_type", "entity_value")


def _tall(advances: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """(advance, user, type, value, ts) per non-null entity cell: one scan for all types."""
    have = {t: c for t, c in columns.items() if c in advances.columns}
    cells = ", ".join(f"'{t}', CAST({c} AS STRING)" for t, c in have.items())
    return advances.selectExpr(
        "advance_id", "user_id", f"{TS} AS ts", f"stack({len(have)}, {cells}) AS (entity_type, entity_value)",
    ).filter("entity_value IS NOT NULL")


_SCREENED = "lower(trim(entity_value)) IN (" + ", ".join(f"'{s}'" for s in SENTINELS) + ")"


def edge_rows(advances: DataFrame, columns: Mapping[str, str] = ENTITY_COLUMNS) -> DataFrame:
    """Edges with screened values left out, as often as they occur: for readers that make their own pairs distinct."""
    return _tall(advances, columns).filter(f"NOT ({_SCREENED})").select("advance_id", "user_id", *ENTITY, "ts")


def build_edges(advances: DataFrame, columns: Mapping[str, str] = ENTITY_COLUMNS) -> DataFrame:
    """Distinct edges with screened values left out; never capped."""
    return edge_rows(advances, columns).distinct()


def build_users(advances: DataFrame) -> DataFrame:
    return advances.groupBy("user_id").agg(
        F.count_distinct("advance_id").alias("n_advances"), F.min(TS).alias("first_seen_ts"),
        F.max(TS).alias("last_seen_ts"))


def entities_of_several(rows: DataFrame, *columns: str) -> DataFrame:
    """Entities that show more than one value of any of the columns, written once.

    Most entities show one: two extremes tell, and merge before the shuffle whatever the size of a hub.
    """
    spread = rows.groupBy(*ENTITY).agg(*[F.expr(f"min({c}) < max({c})").alias(f"__{c}") for c in columns])
    return stored(spread.filter(" OR ".join(f"__{c}" for c in columns)).select(*ENTITY), "several")


def rows_of(cells: DataFrame, which: str) -> DataFrame:
    """Rows of the entities of which the aggregate ``which`` holds, and of few others.

    Entities meet as hashes, which are smaller than names; an entity that shares its hash with a chosen
    one comes along. The hashes are written once: where they are few Spark knows it, and moves no rows.
    """
    cells = cells.withColumn("__entity", F.xxhash64(*ENTITY))
    chosen = stored(cells.groupBy("__entity").agg(F.expr(which).alias("__chosen")).filter("__chosen").select("__entity"), "chosen")
    return cells.join(chosen, "__entity", "left_semi").drop("__entity")


def build_entities(edges: DataFrame) -> DataFrame:
    """Per entity: distinct users and advances, first and last time; edges may repeat."""
    once = edges.groupBy(*ENTITY).agg(
        *[F.expr(f"{how}({c})").alias(f"__{how}_{c}") for c in ("user_id", "advance_id") for how in ("min", "max")],
        F.min("ts").alias("first_seen_ts"), F.max("ts").alias("last_seen_ts"))
    # An extreme equal to the other is the only value (none: no value), so only the rest is counted.
    once = stored(once.selectExpr(
        *ENTITY, "IF(__min_user_id < __max_user_id, NULL, nvl2(__min_user_id, 1L, 0L)) AS n_users",
        "IF(__min_advance_id < __max_advance_id, NULL, nvl2(__min_advance_id, 1L, 0L)) AS n_advances",
        "first_seen_ts", "last_seen_ts"), "entities")
    single = once.filter("n_users IS NOT NULL AND n_advances IS NOT NULL")
    several = stored(once.filter("n_users IS NULL OR n_advances IS NULL"), "several")
    some = edges.join(several.select(*ENTITY), list(ENTITY), "left_semi")
    # Two distinct counts of one group would expand every edge; counting each on
    # its own deduplicated pairs lets partial aggregation shrink hot entities.
    count = lambda c, name: some.filter(f"{c} IS NOT NULL").select(*ENTITY, c).distinct().groupBy(*ENTITY).agg(F.count("*").alias(name))
    counted = several.select(*ENTITY, "first_seen_ts", "last_seen_ts") \
        .join(count("user_id", "n_users"), list(ENTITY), "left").join(count("advance_id", "n_advances"), list(ENTITY), "left")
    return single.unionByName(counted.fillna(0, ["n_users", "n_advances"])).select(
        *ENTITY, "n_users", "n_advances", "first_seen_ts", "last_seen_ts")


def build_counts(advances: DataFrame, edges: DataFrame | None = None, columns: Mapping[str, str] = ENTITY_COLUMNS) -> DataFrame:
    """Per entity type: kept edges and screened source rows; without ready edges both in one pass over the cells."""
    if edges is None:
        # A screened cell needs no value, so those of an advance meet in one row.
        cells = _tall(advances, columns).selectExpr(
            "advance_id", "user_id", "ts", "entity_type", f"IF({_SCREENED}, NULL, entity_value) AS entity_value")
        return cells.groupBy(*cells.columns).agg(F.count("*").alias("n")).groupBy("entity_type").agg(
            F.expr("count(entity_value)").alias("edges"), F.expr("sum(IF(entity_value IS NULL, n, 0L))").alias("screened"))
    screened = _tall(advances, columns).groupBy("entity_type").agg(F.expr(f"count_if({_SCREENED})").alias("screened"))
    kept = edges.groupBy("entity_type").agg(F.count("*").alias("edges"))
    return kept.join(screened, "entity_type", "full").selectExpr(
        "entity_type", "coalesce(edges, 0L) AS edges", "coalesce(screened, 0L) AS screened")


@dataclass(frozen=True)
class Store:
    advances: DataFrame
    edges: DataFrame
    users: DataFrame
    entities: DataFrame
    counts: DataFrame


def build_store(advances: DataFrame, folder: str, columns: Mapping[str, str] = ENTITY_COLUMNS) -> Store:
    """Write the five tables (full rebuild, same input gives the same store)."""
    spark = advances.sparkSession
    write = lambda df, name: df.write.mode("overwrite").parquet(f"{folder}/{name}")
    write(advances, "advances")
    advances = spark.read.parquet(f"{folder}/advances")
    write(build_edges(advances, columns), "edges")
    edges = spark.read.parquet(f"{folder}/edges")
    write(build_users(advances), "users")
    write(build_entities(edges), "entities")
    write(build_counts(advances, edges, columns), "counts")
    return open_store(spark, folder)


def open_store(spark: SparkSession, folder: str) -> Store:
    return Store(*(spark.read.parquet(f"{folder}/{n}") for n in ("advances", "edges", "users", "entities", "counts")))


def check_layers(layers: Sequence[str], columns: Mapping[str, str] = ENTITY_COLUMNS) -> None:
    if not layers:
        raise ValueError("name at least one entity type")
    unknown = sorted(set(layers) - set(columns))
    if unknown:
        raise ValueError(f"unknown layers {unknown}; known: {sorted(columns)}")


def degrees(edges: DataFrame) -> DataFrame:
    """Distinct users per entity of the given edges."""
    return edges.select(*ENTITY, "user_id").distinct().groupBy(*ENTITY).agg(F.count("*").alias("n_users"))


def view(edges: DataFrame, *, layers: Sequence[str] = DEFAULT_LAYERS, degree_cap: int | None = None,
         as_of: str | None = None, window: tuple[str, str] | None = None) -> DataFrame:
    """Edges of the layers up to ``as_of`` or inside a closed ``window``, hubs beyond the cap left out.

    The cap counts distinct users within the view. Over-cap entities are few, so
    they are anti-joined away and the edges themselves need no shuffle when that
    list is small enough for Spark to broadcast it.
    """
    check_layers(layers)
    out = edges.filter(F.col("entity_type").isin(*layers))
    if as_of is not None:
        out = out.filter(f"ts <= timestamp_ntz'{as_of}'")
    if window is not None:
        out = out.filter(f"ts >= timestamp_ntz'{window[0]}' AND ts <= timestamp_ntz'{window[1]}'")
    if degree_cap is None:
        return out
    return out.join(degrees(out).filter(F.col("n_users") > degree_cap).select(*ENTITY), list(ENTITY), "left_anti")


def user_attributes(advances: DataFrame, attrs: Sequence[str] = (), rules: Sequence[Rule] | None = None) -> DataFrame:
    """Per user the maximum of each label column and of each rule flag; nulls become 0 / false."""
    missing = sorted(set(attrs) - set(advances.columns))
    if missing:
        raise ValueError(f"attributes {missing} are not in the advance table")
    flagged = with_flags(advances, rules) if rules is not None else advances
    flags = [*[r.flag_name for r in rules], "scenario_any"] if rules is not None else []
    out = flagged.groupBy("user_id").agg(*[F.max(c).alias(c) for c in (*attrs, *flags)])
    return out.fillna(0, list(attrs)).fillna(False, flags)


def user_pairs(edges: DataFrame) -> DataFrame:
    """Distinct (user, entity) incidences, the entity as one string key."""
    return edges.selectExpr("CAST(user_id AS STRING) AS user_id", "entity_type",
                            "concat(entity_type, ':', entity_value) AS entity").distinct()
