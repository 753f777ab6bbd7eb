"""Exact quantiles that do not gather a column in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidegate.session import cut_lineage


def exact_quantiles(df: DataFrame, columns: Sequence[str], points: Sequence[float]) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles per column, all columns in one tall pass.

    Distinct (column, value) pairs are counted before anything moves, split into
    ranges, and numbered with one offset per column and range; a handful of values
    per column reaches the driver.
    """
    columns = list(columns)
    if not columns:
        return {}
    cells = ", ".join(f"{i}, CAST(`{c}` AS DOUBLE)" for i, c in enumerate(columns))
    counts = df.selectExpr(f"stack({len(columns)}, {cells}) AS (c, v)").filter("v IS NOT NULL").groupBy("c", "v").agg(F.count("*").alias("n"))
    # Stored, so that totals and numbers refer to the same split.
    laid = cut_lineage(counts.repartitionByRange("c", "v").withColumn("part", F.spark_partition_id()))
    sizes = laid.groupBy("c", "part").agg(F.sum("n").alias("size"))
    earlier = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("start", F.coalesce(F.sum("size").over(earlier), F.lit(0))).select("c", "part", "start", "size")
    totals = {r.c: r.total for r in sizes.groupBy("c").agg(F.sum("size").alias("total")).collect()}
    spots = {c: [p * (totals[c] - 1) for p in points] for c in totals}
    wanted = df.sparkSession.createDataFrame(
        [(c, r) for c, places in spots.items() for r in sorted({f(s) for s in places for f in (math.floor, math.ceil)})], "c int, r long")
    inside = Window.partitionBy("c", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = laid.join(F.broadcast(starts.drop("size")), ["c", "part"]).withColumn("upto", F.col("start") + F.sum("n").over(inside))
    found = {(x.c, x.r): x.v for x in ranked.join(F.broadcast(wanted), "c").filter("r >= upto - n AND r < upto").select("c", "r", "v").collect()}
    between = lambda c, s: found[c, math.floor(s)] + (s - math.floor(s)) * (found[c, math.ceil(s)] - found[c, math.floor(s)])
    return {name: [between(i, s) for s in spots[i]] if i in spots else [None] * len(points) for i, name in enumerate(columns)}


def most_common(df: DataFrame, column: str):
    """Commonest non-null value, the smallest one on a tie."""
    row = df.filter(f"`{column}` IS NOT NULL").groupBy(column).agg(F.count("*").alias("__n")).orderBy(
        F.desc("__n"), column).first()
    return row[0] if row else None
