"""Exact ranking of scored rows without a global sort of the rows.

Rows collapse to one line per distinct score first (map-side combine), so a
score shared by a third of all rows is one line. Cumulative counts along the
scores are then folded per range of scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window, functions as F

from tidegate.session import cut_lineage, share

SCORE_RANGES = 512


def score_groups(df: DataFrame, score: str, positive: str, by: Sequence[str] = ()) -> DataFrame:
    """(score, n, pos) per distinct non-null score, optionally split by more columns."""
    return df.filter(f"{score} IS NOT NULL").groupBy(F.col(score).cast("double").alias("score"), *by).agg(
        F.count("*").alias("n"), F.expr(f"count_if({positive})").alias("pos"))


def score_curve(groups: DataFrame) -> DataFrame:
    """Add counts at or above each score (``cum_n``, ``cum_pos``) and totals.

    Scores are cut into ranges at approximate quantiles; range totals (one row per
    range) give the offsets, so any split is exact.
    """
    groups = share(groups)
    cuts = sorted(set(groups.approxQuantile(
        "score", [i / SCORE_RANGES for i in range(1, SCORE_RANGES)], 1.0 / (4 * SCORE_RANGES))))
    inner = [c for c in cuts if c not in (float("-inf"), float("inf"))]
    if inner:
        ranged = Bucketizer(splits=[float("-inf"), *inner, float("inf")], inputCol="score", outputCol="part").transform(groups)
    else:  # no finite score at all
        ranged = groups.withColumn("part", F.lit(0.0))
    # One row per range: at most SCORE_RANGES rows, a fixed bound for the broadcast.
    offsets = ranged.groupBy("part").agg(F.sum("n").alias("pn"), F.sum("pos").alias("pp")).selectExpr(
        "part",
        "coalesce(sum(pn) OVER (ORDER BY part DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off_n",
        "coalesce(sum(pp) OVER (ORDER BY part DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off_pos",
        "sum(pn) OVER () AS total_n", "sum(pp) OVER () AS total_pos")
    inside = "OVER (PARTITION BY part ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return ranged.selectExpr("*", f"sum(n) {inside} AS in_n", f"sum(pos) {inside} AS in_pos").join(
        F.broadcast(offsets), "part").selectExpr(
        "score", "n", "pos", "off_n + in_n AS cum_n", "off_pos + in_pos AS cum_pos", "total_n", "total_pos")


def auc(curve: DataFrame) -> DataFrame:
    """Area under the ROC curve; ties count half. Null when one class is missing."""
    below = "(total_n - total_pos) - (cum_n - cum_pos)"
    wins = f"sum(CAST(pos AS DOUBLE) * ({below} + (n - pos) / 2.0D))"
    return curve.agg(F.expr(
        f"{wins} / nullif(max(CAST(total_pos AS DOUBLE) * (total_n - total_pos)), 0D)").alias("auc"))


def average_precision(curve: DataFrame) -> DataFrame:
    """Step-wise average precision over distinct thresholds; null without positives."""
    return curve.agg(F.expr(
        "sum(CAST(pos AS DOUBLE) / nullif(total_pos, 0) * cum_pos / cum_n)").alias("average_precision"))


def top_cuts(curve: DataFrame, df: DataFrame, score: str, key: str, counts: Sequence[int]) -> list[str]:
    """SQL conditions that select exactly the top ``k`` rows, for each k.

    Order is score descending, then key ascending. The score of the k-th row
    comes from the curve (one row per k reaches the driver); inside the tied
    group the cut is the m-th smallest key.
    """
    wanted = curve.sparkSession.createDataFrame([(k,) for k in sorted(set(counts))], "k long")
    found = {r.k: r for r in curve.join(F.broadcast(wanted), F.expr("cum_n - n < k AND k <= cum_n"))
             .select("k", "score", "n", "cum_n").collect()}
    out = []
    for k in counts:
        row = found.get(k)
        if row is None:  # fewer rows than k
            out.append(f"{score} IS NOT NULL")
            continue
        need = k - (row.cum_n - row.n)
        same = f"CAST({score} AS DOUBLE) = {_double(row.score)}"
        above = f"CAST({score} AS DOUBLE) > {_double(row.score)}"
        if need == row.n:
            out.append(f"({above} OR {same})")
            continue
        cut = nth_smallest(df.filter(same), key, need)
        out.append(f"({above} OR ({same} AND {key} <= {_literal(cut, dict(df.dtypes)[key])}))")
    return out


def _double(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def _literal(value, kind: str) -> str:
    """A SQL literal of a key of any type that can be ordered."""
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"CAST('{text}' AS {kind})"


def nth_smallest(df: DataFrame, key: str, n: int):
    """Exact n-th smallest value of a unique key of any type that can be ordered.

    Keys are split into ranges; the counts of the ranges tell which one holds the
    n-th, and only that range is numbered.
    """
    # Stored, so that the counts and the numbering refer to the same split.
    laid = cut_lineage(df.select(F.col(key).alias("k")).repartitionByRange("k").withColumn("part", F.spark_partition_id()))
    for part, size in sorted(tuple(r) for r in laid.groupBy("part").count().collect()):
        if n <= size:
            place = F.row_number().over(Window.partitionBy("part").orderBy("k"))
            return laid.filter(F.col("part") == part).withColumn("at", place).filter(F.col("at") == n).first()["k"]
        n -= size
    raise ValueError("fewer keys than asked for")


def rank_percentiles(curve: DataFrame) -> DataFrame:
    """Average-rank percentile (0..100, ascending) of each score."""
    return curve.selectExpr("score", "100.0D * ((total_n - cum_n) + (n + 1) / 2.0D) / total_n AS percentile")
