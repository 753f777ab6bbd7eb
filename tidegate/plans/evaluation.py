"""Metrics over a scored table, side-table joins and prediction bundles."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidegate.functions.risk import BANDS
from tidegate.operators import ranking
from tidegate.operators.keys import check_unique_key
from tidegate.plans.rules import Rule, residual
from tidegate.session import share
from tidegate.sources import writers

DEPTHS = (0.005, 0.01, 0.05)
EPSILON = 2.220446049250313e-16  # double precision machine epsilon
MATURE = "label_mature_d45 = 1"
DPD45 = "label_gross_dpd45 = 1"
NEVER_PAID = "label_gross_dpd45 = 1 AND label_repaid_current_snapshot = 0"


def checked_depths(depths: Sequence[float]) -> tuple[float, ...]:
    out = tuple(float(d) for d in depths)
    if not out or any(not 0 < d <= 1 for d in out):
        raise ValueError(f"depths are fractions in (0, 1], at least one: {out}")
    return out


def auc(df: DataFrame, score: str, positive: str) -> DataFrame:
    return ranking.auc(ranking.score_curve(ranking.score_groups(df, score, positive)))


def average_precision(df: DataFrame, score: str, positive: str) -> DataFrame:
    return ranking.average_precision(ranking.score_curve(ranking.score_groups(df, score, positive)))


def outcome_average_precision(df: DataFrame, score: str, outcome: str = DPD45, scope: str = MATURE) -> DataFrame:
    """Average precision against an observed outcome on mature rows; 0 without positives."""
    found = average_precision(df.filter(scope), score, outcome)
    return found.selectExpr("coalesce(average_precision, 0D) AS average_precision")


def log_loss(df: DataFrame, score: str, positive: str) -> DataFrame:
    p = f"greatest(CAST('{EPSILON!r}' AS DOUBLE), least(CAST('{1 - EPSILON!r}' AS DOUBLE), CAST({score} AS DOUBLE)))"
    return df.agg(F.expr(f"-avg(IF({positive}, ln({p}), ln(1D - {p})))").alias("log_loss"))


def threshold_sweep(df: DataFrame, score: str, positive: str, thresholds: Sequence[float]) -> DataFrame:
    """Precision and recall at ``score >= t``; an empty denominator gives 0. One aggregate for all."""
    if not thresholds:
        raise ValueError("give at least one threshold")
    aggs = [F.expr(f"count_if({positive})").alias("pos")]
    for i, t in enumerate(thresholds):
        aggs += [F.expr(f"count_if({score} >= {float(t)!r}D)").alias(f"hit{i}"),
                 F.expr(f"count_if({score} >= {float(t)!r}D AND {positive})").alias(f"tp{i}")]
    cells = ", ".join(f"{float(t)!r}D, hit{i}, tp{i}" for i, t in enumerate(thresholds))
    return df.agg(*aggs).selectExpr("pos", f"stack({len(thresholds)}, {cells}) AS (threshold, hit, tp)").selectExpr(
        "threshold", "coalesce(tp / nullif(hit, 0), 0D) AS precision", "coalesce(tp / nullif(pos, 0), 0D) AS recall")


def review_count(n_rows: int, depth: float) -> int:
    """Rows reviewed at a depth: half-even rounding, never zero."""
    return max(1, round(n_rows * depth))


@dataclass(frozen=True)
class DepthCuts:
    """Exact top-k conditions of one scored frame, reusable by every depth metric."""

    curve: DataFrame
    n_rows: int
    depths: tuple[float, ...]
    counts: tuple[int, ...]
    conditions: tuple[str, ...]


def depth_cuts(df: DataFrame, score: str, positive: str, key: str, depths: Sequence[float]) -> DepthCuts:
    depths = checked_depths(depths)
    curve = ranking.score_curve(ranking.score_groups(df, score, positive))
    n = curve.agg(F.sum("n")).first()[0] or 0
    counts = tuple(review_count(n, d) for d in depths)
    return DepthCuts(curve, n, depths, counts, tuple(ranking.top_cuts(curve, df, score, key, counts)))


def depth_records(df: DataFrame, score: str, positive: str, key: str, depths: Sequence[float] = DEPTHS,
                  scope: str = "true") -> DataFrame:
    """Precision, recall and false positives per hit in the top fraction of rows."""
    # Read several times below, so only the three columns that matter are kept.
    df = share(df.filter(scope).selectExpr(key, score, f"({positive}) AS __positive"))
    positive = "__positive"
    cuts = depth_cuts(df, score, positive, key, depths)
    aggs = [F.expr(f"count_if({positive})").alias("pos"), F.expr("count(1)").alias("n_rows")]
    for i, cond in enumerate(cuts.conditions):
        aggs += [F.expr(f"count_if({cond})").alias(f"n{i}"), F.expr(f"count_if({cond} AND ({positive}))").alias(f"tp{i}")]
    cells = ", ".join(f"{d!r}D, n{i}, tp{i}" for i, d in enumerate(cuts.depths))
    return df.agg(*aggs).selectExpr(
        "pos", "n_rows", f"stack({len(cuts.depths)}, {cells}) AS (depth, n_reviewed, true_positives)"
    ).filter("n_rows > 0").selectExpr(
        "depth", "n_reviewed", "true_positives", "true_positives / nullif(n_reviewed, 0) AS precision",
        "true_positives / nullif(pos, 0) AS recall",
        "(n_reviewed - true_positives) / nullif(true_positives, 0) AS fp_per_tp",
        "pos / n_rows AS base_rate",
        "(true_positives / nullif(n_reviewed, 0)) / nullif(pos / n_rows, 0D) AS lift")


def early_default_capture(df: DataFrame, score: str, key: str, depths: Sequence[float] = DEPTHS) -> DataFrame:
    """Depth records against early default, on mature rows only."""
    return depth_records(df, score, DPD45, key, depths, scope=MATURE)


def band_report(df: DataFrame, score: str, band: str, key: str, depths: Sequence[float] = DEPTHS) -> DataFrame:
    """Per band: rows, mean score percentile, rows and share inside each top fraction."""
    df = share(df.selectExpr(key, score, f"CAST({band} AS STRING) AS {band}"))
    cuts = depth_cuts(df, score, "true", key, depths)
    named = band
    by_score = ranking.score_groups(df, score, "true", by=[F.expr(named).alias("band")])
    mean = by_score.join(ranking.rank_percentiles(cuts.curve), "score").groupBy("band").agg(
        F.expr("sum(n * percentile) / sum(n)").alias("mean_score_percentile"))
    tops = [F.expr(f"count_if({c})").alias(f"n_in_top_{d}") for d, c in zip(cuts.depths, cuts.conditions)]
    counts = df.groupBy(F.expr(named).alias("band")).agg(F.count("*").alias("n"), *tops)
    fixed = df.sparkSession.createDataFrame([(b, i) for i, b in enumerate(BANDS)], "band string, place int")
    rows = counts.join(mean, "band", "left").join(F.broadcast(fixed), "band", "full")
    zero = [f"coalesce(`n_in_top_{d}`, 0L) AS `n_in_top_{d}`" for d in cuts.depths]
    shares = [f"`n_in_top_{d}` / nullif(n, 0) AS `capture_at_{d}`" for d in cuts.depths]
    return rows.orderBy(F.coalesce("place", F.lit(len(BANDS))), "band").selectExpr(
        "band", "coalesce(n, 0L) AS n", "mean_score_percentile", *zero, *shares)


def projected_revenue(df: DataFrame, score: str, amount: str, cost: str) -> DataFrame:
    return df.agg(F.expr(f"avg({score} * {amount} - {cost})").alias("projected_revenue"))


def on_residual(metric: Callable[..., DataFrame], rules: Sequence[Rule]) -> Callable[..., DataFrame]:
    """The same metric as if rule-matched rows had never been scored."""
    def wrapped(df: DataFrame, *args, **kwargs) -> DataFrame:
        return metric(residual(df, rules), *args, **kwargs)
    return wrapped


# ---- evaluation of one scored table -----------------------------------------

@dataclass(frozen=True)
class Metric:
    """A named metric: ``compute(scored) -> DataFrame`` of records, first column read as its value."""

    name: str
    compute: Callable[[DataFrame], DataFrame]
    required_columns: tuple[str, ...] = ()


@dataclass(frozen=True)
class EvalSpec:
    metrics: tuple[Metric, ...]
    primary: str = ""
    augmentations: Mapping[str, DataFrame] = field(default_factory=dict)
    key: tuple[str, ...] = ()

    def evaluate(self, scored: DataFrame) -> dict[str, list[dict]]:
        """Metric name -> records. Records are reports of a fixed few rows, not data."""
        for side in self.augmentations.values():
            scored = join_augmentation(scored, side, list(self.key))
        for m in self.metrics:
            missing = [c for c in m.required_columns if c not in scored.columns]
            if missing:
                raise ValueError(f"metric {m.name!r} needs missing columns {missing}")
        out = {m.name: [r.asDict() for r in m.compute(scored).collect()] for m in self.metrics}
        if self.primary:
            value = next(iter(out[self.primary][0].values()), None)
            if value is None or not math.isfinite(value):
                raise ValueError(f"primary metric {self.primary!r} is not finite: {value}")
        return out


# ---- side tables --------------------------------------------------------------

def join_augmentation(base: DataFrame, side: DataFrame, key: Sequence[str], *, check: bool = True) -> DataFrame:
    """Left one-to-one join of extra columns; overlapping value columns are an error."""
    key = list(key)
    overlap = sorted((set(side.columns) & set(base.columns)) - set(key))
    if overlap:
        raise ValueError(f"augmentation repeats columns {overlap}")
    if check:
        check_unique_key(side, key)
    return base.join(side, key, "left")


def admit_augmentation(base: DataFrame, side: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``side`` whose key is not in the evaluation rows; admission requires none."""
    overlap = sorted((set(side.columns) & set(base.columns)) - set(key))
    if overlap:
        raise ValueError(f"augmentation repeats columns {overlap}")
    return side.join(base.select(*key), list(key), "left_anti")


def prediction_bundle(predictions: Mapping[str, DataFrame], augmentations: Sequence[DataFrame],
                      key: Sequence[str]) -> DataFrame:
    """All prediction sets stacked with their label, each row carrying its side columns."""
    stacked = reduce(DataFrame.unionByName,
                     [p.withColumn("prediction_set", F.lit(n)) for n, p in predictions.items()])
    return reduce(lambda df, side: df.join(side, list(key), "left"), augmentations, stacked)


def score_parity(left: DataFrame, right: DataFrame, key: Sequence[str], score: str = "y_pred",
                 tolerance: float = 1e-10) -> DataFrame:
    """Row counts and largest score difference of two scorings of the same rows."""
    both = left.selectExpr(*key, f"{score} AS a", "true AS in_left").join(
        right.selectExpr(*key, f"{score} AS b", "true AS in_right"), list(key), "full")
    return both.agg(
        F.count("in_left").alias("n_left"), F.count("in_right").alias("n_right"),
        F.expr("max(abs(a - b))").alias("max_abs_diff"),
    ).selectExpr("*", f"n_left = n_right AND coalesce(max_abs_diff, 0D) <= {tolerance!r}D AS matches")


def text_parity(df: DataFrame, score: Callable[[DataFrame], DataFrame], key: Sequence[str], folder: str, **how) -> DataFrame:
    """``score_parity`` of rows scored as they are and after a trip through text files where every value is text.

    Text gets its types back by name; a column that is missing, new or not text fails. Null and empty text stay apart.
    """
    df.select([F.col(f.name).cast("string").alias(f.name) for f in df.schema]).write.option("header", True).option(
        "nullValue", "\\N").option("escape", '"').csv(folder)
    text = df.sparkSession.read.option("header", True).option("nullValue", "\\N").option("escape", '"').option("multiLine", True).csv(folder)
    if text.columns != df.columns or any(kind != "string" for _, kind in text.dtypes):
        raise ValueError(f"text columns {text.dtypes} are not those of the input as text: {df.columns}")
    typed = text.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in df.schema])
    return score_parity(score(df), score(typed), key, **how)


# ---- batch evaluation -----------------------------------------------------------

def evaluate(df: DataFrame, score: Callable[[DataFrame], DataFrame], spec: EvalSpec, folder: str, key: Sequence[str],
             label: str) -> dict[str, list[dict]]:
    """Score, write the predictions, compute the metrics, record them under ``label``.

    A label already evaluated in ``folder`` is read back instead of recomputed.
    Metrics read the written predictions, so scoring runs once.
    """
    spark, key = df.sparkSession, list(key)
    place = f"{folder}/{label}"
    if writers.exists(spark, f"{place}/{writers.RECORD}") and writers.exists(spark, f"{place}/metrics/{writers.RECORD}"):
        return writers.read_record(spark, f"{place}/metrics")
    writers.write_predictions(score(df), place, key, label)
    predictions, _ = writers.load_predictions(spark, place)
    metrics = spec.evaluate(share(df.drop("y_pred").join(predictions, key)))
    writers.write_record(spark, f"{place}/metrics", metrics)
    return metrics
