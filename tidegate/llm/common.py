"""Helpers the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate.session import cut_lineage

# The characters that separate words, and the word pattern over them.
SPACES = b" \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % F.lit(folds)


def bounded_sample(df: DataFrame, key: str, bound: int) -> DataFrame:
    """All rows if there are at most ``bound``, else about ``bound`` of them, chosen by the hash of their key."""
    n = df.count()
    if n <= bound:
        return df
    return df.filter(F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 30)) < int(bound / n * (1 << 30)))


def text_slices(batches: Iterable[pa.RecordBatch], column: str, size: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of the batches holding about ``size`` bytes of ``column``, with that column as Python values."""
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        lengths = values.fill_null("" if pa.types.is_string(values.type) else b"")
        start, held = 0, 0
        for i, n in enumerate(map(len, lengths.to_pylist()) if batch.num_rows else ()):
            held += n
            if held >= size:
                yield batch.slice(start, i + 1 - start), values.slice(start, i + 1 - start).to_pylist()
                start, held = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start), values.slice(start).to_pylist()


def spare(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened where ``df`` has columns called so."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def settle(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """``df`` on reliable storage, read in one part per ``rows`` rows at most.

    Small intermediate frames then cost a few tasks and shuffle files instead of
    one per shuffle partition; larger ones keep as many parts as they need.
    """
    held = cut_lineage(df)
    parts = -(-held.count() // rows) or 1
    return held.coalesce(parts)


def components(links: DataFrame) -> DataFrame:
    """(vertex, component) of ``links(a, b)`` over long ids; component is the smallest reachable vertex.

    Each round every vertex points at its smallest neighbour, pointers are halved
    twice, and the links are rewritten between the roots, so the graph shrinks by
    a constant factor at least; hubs only meet a minimum, which merges before the
    shuffle. Rounds are checkpointed. Vertices without links are absent.
    """
    edges = settle(links.selectExpr("least(a, b) AS a", "greatest(a, b) AS b").filter("a < b").distinct())
    names = None  # vertex -> its current root
    while not edges.isEmpty():
        both = edges.unionByName(edges.selectExpr("b AS a", "a AS b"))
        root = both.groupBy("a").agg(F.min("b").alias("low")).selectExpr("a AS v", "least(a, low) AS r")
        for _ in range(2):
            up = root.selectExpr("v AS r", "r AS top")
            root = root.join(up, "r").selectExpr("v", "top AS r")
        root = settle(root)
        low, high = root.selectExpr("v AS a", "r AS ra"), root.selectExpr("v AS b", "r AS rb")
        edges = settle(edges.join(low, "a").join(high, "b").selectExpr("least(ra, rb) AS a", "greatest(ra, rb) AS b")
                            .filter("a < b").distinct())
        if names is None:
            names = root
        else:  # vertices met before move on to their root's root
            names = settle(names.join(root.selectExpr("v AS r", "r AS top"), "r", "left")
                                .selectExpr("v", "coalesce(top, r) AS r"))
    if names is None:
        return edges.selectExpr("a AS vertex", "b AS component")
    return names.selectExpr("v AS vertex", "r AS component")
