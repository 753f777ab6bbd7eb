"""Deterministic buckets and row fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

_SEPARATOR = "\x1f"


def _joined(keys: Sequence[Column]) -> Column:
    parts = [F.coalesce(k.cast("string"), F.lit("\x00")) for k in keys]
    return parts[0] if len(parts) == 1 else F.concat_ws(_SEPARATOR, *parts)


def md5_bucket(keys: Sequence[Column], buckets: int = 100) -> Column:
    """Bucket any SQL engine can recompute: first 32 bits of an md5, modulo."""
    head = F.substring(F.md5(_joined(keys)), 1, 8)
    return (F.conv(head, 16, 10).cast("long") % F.lit(buckets)).cast("int")


def fast_bucket(keys: Sequence[Column], buckets: int = 100) -> Column:
    """Cheaper bucket for Spark-only datasets."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


BUCKETS = {"md5": md5_bucket, "xxhash64": fast_bucket}


def letters_from_hash(key: Column) -> Column:
    """Three letters A-Z derived from a hash of ``key`` (base 26 digits)."""
    number = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long")
    return F.concat(*[
        F.chr(F.lit(65) + F.pmod(F.floor(number / F.lit(26**i)).cast("long"), F.lit(26)))
        for i in range(3)
    ])
