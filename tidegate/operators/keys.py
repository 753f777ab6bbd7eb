"""Unique keys and split buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidegate.functions.hashing import BUCKETS

SPLIT = "SPLIT_PCT"


def normal_key(key: str | Sequence[str]) -> tuple[str, ...]:
    """A key as a sorted tuple without blanks or repeats."""
    parts = (key,) if isinstance(key, str) else tuple(key)
    if not parts or any(not str(p).strip() for p in parts):
        raise ValueError(f"key has blank parts: {parts!r}")
    if len(set(parts)) != len(parts):
        raise ValueError(f"key repeats a column: {parts!r}")
    return tuple(sorted(parts))


def _present(df: DataFrame, key: Sequence[str]) -> tuple[str, ...]:
    key = normal_key(key)
    missing = [c for c in key if c not in df.columns]
    if missing:
        raise KeyError(f"key columns {missing} not in {df.columns}")
    return key


def null_key_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    key = _present(df, key)
    return df.filter(" OR ".join(f"`{c}` IS NULL" for c in key)).select(*key)


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their row count."""
    key = _present(df, key)
    return df.groupBy(*key).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def check_unique_key(df: DataFrame, key: str | Sequence[str]) -> tuple[str, ...]:
    """Raise with five examples when a key part is null or a key repeats."""
    key = normal_key(key)
    for what, rows in (("null key parts", null_key_rows(df, key)), ("duplicate keys", duplicate_keys(df, key))):
        examples = [r.asDict() for r in rows.limit(5).collect()]
        if examples:
            raise ValueError(f"unique key {key}: {what}, e.g. {examples}")
    return key


def add_split(df: DataFrame, group_key: Sequence[str], *, how: str = "md5", column: str = SPLIT) -> DataFrame:
    """Bucket 0..99 from the group key, so a group never straddles two splits."""
    key = _present(df, group_key)
    return df.withColumn(column, BUCKETS[how]([F.col(c) for c in key], 100))


def split_problems(df: DataFrame, column: str = SPLIT) -> DataFrame:
    """Counts of null, fractional and out-of-range bucket values, in one pass."""
    c = f"CAST(`{column}` AS DOUBLE)"
    return df.agg(
        F.count("*").alias("n_rows"), F.expr(f"count_if(`{column}` IS NULL)").alias("n_null"),
        F.expr(f"count_if({c} <> floor({c}))").alias("n_fractional"),
        F.expr(f"count_if({c} < 0 OR {c} > 99)").alias("n_out_of_range"))


def check_split(df: DataFrame, column: str = SPLIT) -> None:
    if column not in df.columns:
        raise KeyError(f"split column {column!r} is missing")
    bad = {k: v for k, v in split_problems(df, column).first().asDict().items() if k != "n_rows" and v}
    if bad:
        raise ValueError(f"split column {column!r} must hold integers 0..99: {bad}")


def split_report(df: DataFrame, column: str = SPLIT) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n_rows")).orderBy(column)


def split_mismatches(df: DataFrame, group_key: Sequence[str], *, how: str = "md5", column: str = SPLIT) -> DataFrame:
    """Rows whose stored bucket differs from the recomputed one, null-safe."""
    key = _present(df, group_key)
    return df.filter(~F.col(column).eqNullSafe(BUCKETS[how]([F.col(c) for c in key], 100)))


def adopt_split(df: DataFrame, column: str = SPLIT) -> DataFrame:
    """Give a lower-cased source split column its canonical name and an integer type.

    Integral doubles and decimals become integers; anything else is an error.
    """
    lowered = column.lower()
    if lowered not in df.columns:
        raise KeyError(f"source provides no {column} column")
    out = df.withColumnRenamed(lowered, column)
    if dict(out.dtypes)[column] not in ("tinyint", "smallint", "int", "bigint"):
        value = f"try_cast(`{column}` AS DOUBLE)"
        bad = out.filter(f"{value} IS NULL OR {value} <> floor({value})").limit(1).count()
        if bad:
            raise ValueError(f"{column} holds values that are not whole numbers")
        out = out.withColumn(column, F.expr(f"CAST({value} AS INT)"))
    return out
