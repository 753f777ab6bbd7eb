"""Dataset lifecycle: ingest, filter, split, fingerprint, version, verify, slice."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidegate.functions.predicates import Predicate, default_splits
from tidegate.operators import keys as K, profile, schema
from tidegate.session import share
from tidegate.sources import writers
from tidegate.sources.readers import Source


def schema_hash(df: DataFrame) -> str:
    """Sensitive to column order, names and types."""
    return hashlib.sha256(json.dumps(df.dtypes).encode()).hexdigest()[:16]


def _content_sums(df: DataFrame, where: Column | None = None, suffix: str = "") -> list[Column]:
    """Aggregates: row count and two independent order-free sums of 64-bit row hashes, over the rows where ``where`` holds."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    # A null hashes like nothing, so null positions are hashed as well.
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    inside = F.lit(True) if where is None else where
    sums = {"sum_hash": F.xxhash64(nulls, *cols), "sum_hash_2": F.xxhash64(F.lit("second"), nulls, *cols)}
    return [F.count_if(inside).alias(f"n_rows{suffix}"), *[
        F.coalesce(F.sum(F.when(inside, h.cast("decimal(28,0)"))).cast("string"), F.lit("0")).alias(f"{name}{suffix}")
        for name, h in sums.items()]]


def content_parts(df: DataFrame) -> DataFrame:
    """Row count and content sums in one aggregate.

    Duplicates add up, order does not matter, and partial sums merge before the
    shuffle, so no sort of row hashes is needed.
    """
    return df.agg(*_content_sums(df))


def content_hash(df: DataFrame) -> str:
    row = content_parts(df).first()
    return hashlib.sha256(json.dumps([schema_hash(df), row.n_rows, row.sum_hash, row.sum_hash_2]).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class DataSpec:
    source: Source
    target: str | None = None
    exclude_cols: tuple[str, ...] = ()
    metadata_cols: tuple[str, ...] = ()
    null_drop_threshold: float = 0.99
    constant_drop_threshold: float = 1.0
    dry_run_rows: int = 10_001
    bucket: str = "md5"


@dataclass(frozen=True)
class Dataset:
    """A written version: record beside parquet."""

    id: str
    folder: str
    record: Mapping[str, Any] = field(default_factory=dict)

    def load(self, spark: SparkSession, *, split: str | None = None, predicate: Predicate | None = None,
             splits: Mapping[str, Predicate] | None = None, verify: bool = False) -> DataFrame:
        """The table or a slice of it; the slice condition reaches the scan, and prunes folders where the table is partitioned."""
        df = _read(spark, f"{self.folder}/data", self.record)
        if verify:
            verify_dataset(df, self.record)
        return load_slice(df, split=split, predicate=predicate, splits=splits)


def load_slice(df: DataFrame, *, split: str | None = None, predicate: Predicate | None = None,
               splits: Mapping[str, Predicate] | None = None) -> DataFrame:
    if split is not None and predicate is not None:
        raise ValueError("name a split or give a predicate, not both")
    if split is not None:
        known = splits if splits is not None else default_splits()
        if split not in known:
            raise KeyError(f"unknown split {split!r}; known: {sorted(known)}")
        predicate = known[split]
    return predicate.filter(df) if predicate is not None else df


def load_nonempty(df: DataFrame, predicate: Predicate | None = None) -> DataFrame:
    """An evaluation slice; an empty one is an error."""
    out = load_slice(df, predicate=predicate)
    if out.isEmpty():
        raise ValueError("evaluation slice is empty")
    return out


def prepare(spec: DataSpec, spark: SparkSession, *, dry_run: bool = False) -> DataFrame:
    """Source to checked frame: clean names, split bucket, quality filters, unique key."""
    raw = spec.source.load(spark, spec.dry_run_rows if dry_run else None)
    provided = any(c.lower() == K.SPLIT.lower() for c in raw.columns)
    df, original = schema.standardise(raw, None if provided else K.SPLIT)
    back = {old: new for new, old in original.items()}
    name = lambda c: back.get(c, schema.standard_name(c))
    unique = [name(c) for c in K.normal_key(spec.source.unique_key)]
    group = [name(c) for c in K.normal_key(spec.source.split_group_key or spec.source.unique_key)]
    df = K.adopt_split(df) if provided else K.add_split(df, group, how=spec.bucket)
    df = share(df.drop(*[name(c) for c in spec.exclude_cols]))
    protected = {K.SPLIT, *unique, *group, *map(name, spec.metadata_cols), *([name(spec.target)] if spec.target else [])}
    df = profile.drop_poor_columns(df, protected=sorted(protected), null_threshold=spec.null_drop_threshold,
                                   constant_threshold=spec.constant_drop_threshold)
    K.check_unique_key(df, unique)
    K.check_split(df)
    return df


def write_version(df: DataFrame, root: str, *, recipe: Mapping[str, Any] | None = None,
                  registry: DataFrame | None = None, partition: str | None = None) -> tuple[Dataset, bool]:
    """Write ``v{n}_{hash8}`` unless the same content is already there; True when new.

    ``partition`` names the column whose values become folders, the split bucket for slices by split.
    """
    spark = df.sparkSession
    fingerprint = content_hash(df)
    versions = [n for n in writers.list_names(spark, root) if n.startswith("v") and "_" in n]
    for n in versions:
        record = writers.read_record(spark, f"{root}/{n}")
        if record["content_hash"] == fingerprint:
            return Dataset(n, f"{root}/{n}", record), False
    number = max((int(n[1:].split("_")[0]) for n in versions), default=0) + 1
    version = f"v{number}_{fingerprint[:8]}"
    folder = f"{root}/{version}"
    writers.write_dataset(df, folder, partition)
    if registry is not None:
        registry.coalesce(1).write.parquet(f"{folder}/registry")  # one row per column
    schema_fields = {"schema": df.schema.jsonValue()} if partition else {}
    written = _read(spark, f"{folder}/data", schema_fields)
    record = {**schema_fields, "id": version, "content_hash": fingerprint, "schema_hash": schema_hash(df),
              "n_rows": written.count(), "n_columns": len(df.columns), "recipe": dict(recipe or {})}
    writers.write_record(spark, folder, record)
    return Dataset(version, folder, record), True


def _read(spark: SparkSession, folder: str, record: Mapping[str, Any]) -> DataFrame:
    """A written table; a partitioned one gets its columns and types back from the record."""
    if "schema" not in record:
        return spark.read.parquet(folder)
    kind = StructType.fromJson(dict(record["schema"]))
    return spark.read.schema(kind).parquet(folder).select(*kind.names)


def verify_dataset(df: DataFrame, record: Mapping[str, Any]) -> None:
    """Row count, columns, schema and content must match the record."""
    parts = content_parts(df).first()
    found = {"n_rows": parts.n_rows, "n_columns": len(df.columns), "schema_hash": schema_hash(df),
             "content_hash": hashlib.sha256(json.dumps(
                 [schema_hash(df), parts.n_rows, parts.sum_hash, parts.sum_hash_2]).encode()).hexdigest()[:16]}
    wrong = {k: (v, record[k]) for k, v in found.items() if k in record and record[k] != v}
    if wrong:
        raise ValueError(f"dataset does not match its record (found, recorded): {wrong}")


def slice_contract(df: DataFrame, splits: Mapping[str, Predicate]) -> DataFrame:
    """Per split: its predicate, row count and content sums; one scan for all splits."""
    sums = [c for i, p in enumerate(splits.values()) for c in _content_sums(df, p.flag(df), str(i))]
    lines = F.array(*[F.struct(F.lit(n).alias("split"), F.lit(json.dumps(p.to_record())).alias("predicate"), F.col(f"n_rows{i}").alias("n_rows"),
                               F.col(f"sum_hash{i}").alias("sum_hash"), F.col(f"sum_hash_2{i}").alias("sum_hash_2"))
                      for i, (n, p) in enumerate(splits.items())])
    return df.agg(*sums).select(F.explode(lines).alias("line")).select("line.*")


def verify_slices(df: DataFrame, contract: Sequence[Mapping[str, Any]]) -> None:
    """Replay a stored contract; any difference names the split."""
    splits = {c["split"]: Predicate.from_record(json.loads(c["predicate"])) for c in contract}
    now = {r.split: r.asDict() for r in slice_contract(df, splits).collect()}
    wrong = [c["split"] for c in contract if now[c["split"]] != dict(c)]
    if wrong:
        raise ValueError(f"slices changed since the contract was taken: {wrong}")


def two_class_fixture(ids: DataFrame, column: str = "id") -> DataFrame:
    """Alternating target, a trend and a small repeating noise for each row number."""
    return ids.selectExpr(f"{column} % 2 AS target", f"{column} AS value", f"({column} * 7) % 5 AS noise")
