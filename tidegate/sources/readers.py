"""Sources: CSV, parquet, managed tables over SQL, JSON lines."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from pathlib import Path
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidegate.functions.hashing import BUCKETS
from tidegate.operators.keys import SPLIT, normal_key, split_mismatches
from tidegate.operators.schema import decimals_to_doubles, nan_to_null


class Source(Protocol):
    """Anything that yields a frame; ``nrows`` asks for a small development sample."""

    unique_key: tuple[str, ...]
    split_group_key: tuple[str, ...]

    def load(self, spark: SparkSession, nrows: int | None = None) -> DataFrame: ...


def _ingested(df: DataFrame, nrows: int | None) -> DataFrame:
    return nan_to_null(decimals_to_doubles(df if nrows is None else _about(df, nrows)))


def _about(df: DataFrame, nrows: int) -> DataFrame:
    """About ``nrows`` rows chosen by a hash of their values: the same ones in every run, from every part of the source."""
    total = df.count()
    if total <= nrows:
        return df
    return df.filter(F.pmod(F.xxhash64(*df.columns), F.lit(1 << 30)) < int(nrows / total * (1 << 30)))


@dataclass(frozen=True)
class CsvSource:
    """Header CSV. Relative paths resolve on ``base``; give ``schema`` to skip the inference scan."""

    path: str
    unique_key: tuple[str, ...] = ()
    split_group_key: tuple[str, ...] = ()
    base: str = "."
    schema: StructType | str | None = None

    def location(self) -> str:
        return self.path if "://" in self.path or self.path.startswith("/") else str(Path(self.base) / self.path)

    def load(self, spark: SparkSession, nrows: int | None = None) -> DataFrame:
        reader = spark.read.option("header", True)
        reader = reader.schema(self.schema) if self.schema else reader.option("inferSchema", True)
        return _ingested(reader.csv(self.location()), nrows)


@dataclass(frozen=True)
class ParquetSource:
    """Parquet at any Hadoop-readable URI."""

    uri: str
    unique_key: tuple[str, ...] = ()
    split_group_key: tuple[str, ...] = ()

    def load(self, spark: SparkSession, nrows: int | None = None) -> DataFrame:
        return _ingested(spark.read.parquet(self.uri), nrows)


@dataclass(frozen=True)
class ManagedTableSource:
    """A catalog table built once from a SELECT, carrying its split bucket.

    ``base_sql`` fills ``table``; ``training_sql`` (default: the table) is what
    loads. The stored bucket is verified against the key on each load.
    """

    table: str
    base_sql: str
    unique_key: tuple[str, ...]
    split_group_key: tuple[str, ...]
    training_sql: str = ""
    bucket: str = "md5"

    def ensure(self, spark: SparkSession, rebuild: bool = False) -> bool:
        """Build the table when missing or asked; True when it was built."""
        if spark.catalog.tableExists(self.table) and not rebuild:
            return False
        rows = spark.sql(self.base_sql)
        keyed = rows.withColumn(SPLIT, BUCKETS[self.bucket]([F.col(c) for c in normal_key(self.split_group_key)], 100))
        keyed.write.mode("overwrite").saveAsTable(self.table)
        return True

    def load(self, spark: SparkSession, nrows: int | None = None) -> DataFrame:
        self.ensure(spark)
        bad = split_mismatches(spark.table(self.table), self.split_group_key, how=self.bucket).limit(1).count()
        if bad:
            raise ValueError(f"{self.table}: stored {SPLIT} differs from its key's bucket; rebuild the table")
        df = spark.sql(self.training_sql) if self.training_sql else spark.table(self.table)
        if nrows is not None:
            df = dry_run_sample(df, self.unique_key, nrows, how=self.bucket)
        return _ingested(df, None)


def dry_run_sample(df: DataFrame, unique_key: Sequence[str], nrows: int, *, how: str = "md5") -> DataFrame:
    """About ``nrows`` rows as whole buckets of the unique key, the same ones every run.

    The hash is over the unique key, not the split bucket, so every split is
    represented.
    """
    total = df.count()
    buckets = max(1, min(100, round(100 * nrows / total))) if total else 100
    return df.filter(BUCKETS[how]([F.col(c) for c in normal_key(unique_key)], 100) < buckets)


def stratified_downsample(df: DataFrame, band: str, key: str, *, keep_per_10000: int = 875) -> DataFrame:
    """All rows outside the LOW band and a fixed share of LOW ones, chosen by key hash."""
    sampled = BUCKETS["md5"]([F.col(key)], 10_000) < keep_per_10000
    return df.filter((F.col(band) != "LOW") | sampled)


def trailing_window(df: DataFrame, ts: str, as_of: str, months: int = 6) -> DataFrame:
    """Rows from ``months`` before an explicit as-of date on."""
    return df.filter(f"{ts} >= CAST(add_months(DATE'{as_of}', -{months}) AS TIMESTAMP_NTZ)")


EVENT_SCHEMA = (
    "event string, agent_id string, agent_type string, phase string, time_s double, session_id string, "
    "tool_uses bigint, step string, duration_s double, start_s double, exit_code int"
)


def read_event_lines(spark: SparkSession, path: str, schema: str = EVENT_SCHEMA) -> DataFrame:
    """JSON-lines events; blank lines and lines that are not objects are dropped."""
    lines = spark.read.text(path).filter("trim(value) LIKE '{%'")
    return lines.select(F.from_json("value", schema).alias("e")).select("e.*")


def stream_event_lines(spark: SparkSession, path: str, schema: str = EVENT_SCHEMA) -> DataFrame:
    """The same source as a file stream."""
    lines = spark.readStream.text(path).filter("trim(value) LIKE '{%'")
    return lines.select(F.from_json("value", schema).alias("e")).select("e.*")
