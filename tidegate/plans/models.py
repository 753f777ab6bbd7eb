"""Encoders, fitted models and batch scoring."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from tidegate.operators import schema
from tidegate.operators.quantiles import exact_quantiles, most_common
from tidegate.session import cut_lineage, share

MISSING = "__missing__"

Score = Callable[[DataFrame], DataFrame]  # adds or replaces column y_pred


# ---- weight of evidence ----------------------------------------------------------

def _logit(rate: str) -> str:
    clipped = f"least(greatest({rate}, 1e-6D), 1D - 1e-6D)"
    return f"ln({clipped} / (1D - {clipped}))"


def fit_woe(df: DataFrame, column: str, positive: str, smoothing: float = 0.5) -> DataFrame:
    """(category, woe, fallback): smoothed log-odds per category; nulls are a category of their own."""
    counts = share(df.groupBy(F.expr(f"coalesce(CAST({column} AS STRING), '{MISSING}')").alias("category")).agg(
        F.count("*").alias("n"), F.expr(f"count_if({positive})").alias("pos")))
    rate = lambda pos, n: f"(({pos} + {smoothing}D) / ({n} + {2 * smoothing}D))"
    overall = counts.agg(F.expr(_logit(rate("sum(pos)", "sum(n)")))).first()[0]
    return counts.selectExpr("category", f"{_logit(rate('pos', 'n'))} AS woe").withColumn("fallback", F.lit(overall))


def apply_woe(df: DataFrame, fitted: DataFrame, column: str, output: str = "woe") -> DataFrame:
    """Unseen categories take the overall log-odds. Spark broadcasts the mapping when it is small."""
    fallback = fitted.select("fallback").first()[0]
    mapping = fitted.selectExpr("category AS __category", "woe AS __woe")
    keyed = df.withColumn("__category", F.expr(f"coalesce(CAST({column} AS STRING), '{MISSING}')"))
    return keyed.join(mapping, "__category", "left").withColumn(
        output, F.coalesce("__woe", F.lit(fallback))).drop("__category", "__woe")


# ---- fitted models -----------------------------------------------------------------

def _assembled(features: Sequence[str]) -> list:
    filled = [f"{c}__filled" for c in features]
    return [Imputer(inputCols=list(features), outputCols=filled, strategy="mean"),
            VectorAssembler(inputCols=filled, outputCol="__raw")]


def _doubles(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in features})


def fit_baseline(train: DataFrame, features: Sequence[str], label: str) -> Score:
    """Mean-impute, standardise, logistic regression."""
    model = Pipeline(stages=[
        *_assembled(features), StandardScaler(inputCol="__raw", outputCol="__x", withMean=True),
        LogisticRegression(featuresCol="__x", labelCol=label, regParam=1e-4, maxIter=50),
    ]).fit(_doubles(train, features))
    return _probability(model, features)


def fit_boosted(train: DataFrame, features: Sequence[str], label: str, *, iterations: int = 20, depth: int = 4) -> Score:
    """Gradient-boosted trees on imputed features."""
    model = Pipeline(stages=[
        *_assembled(features),
        GBTClassifier(featuresCol="__raw", labelCol=label, maxIter=iterations, maxDepth=depth, stepSize=0.1, seed=0),
    ]).fit(_doubles(train, features))
    return _probability(model, features)


def _probability(model, features: Sequence[str]) -> Score:
    def score(df: DataFrame) -> DataFrame:
        keep = df.columns
        out = model.transform(_doubles(df, features)).withColumn("y_pred", vector_to_array("probability")[1])
        return out.select(*[F.col(c) for c in keep if c != "y_pred"], "y_pred")
    return score


def batch_score(df: DataFrame, score: Score, types: Mapping[str, str], features: Sequence[str]) -> DataFrame:
    """Cast to the registered types, check the model columns, score."""
    missing = sorted(set(features) - set(df.columns))
    if missing:
        raise KeyError(f"model columns {missing} are missing")
    return score(schema.cast_columns(df, types))


def _log_parts(points: np.ndarray, weights: np.ndarray, means: np.ndarray, variances: np.ndarray) -> np.ndarray:
    """Log of weight times density, per point and component; components have diagonal covariance."""
    gap = points[:, None, :] - means[None]
    shape = -0.5 * ((gap * gap / variances[None]).sum(axis=2) + np.log(2 * math.pi * variances).sum(axis=1)[None])
    return shape + np.log(np.maximum(weights, 1e-300))[None]


def fit_mixture(train: DataFrame, features: Sequence[str], key: str, *, components: int = 8, iterations: int = 40,
                floor: float = 1e-6) -> Score:
    """Gaussian mixture of diagonal components on standardised features; y_pred is the negative log-likelihood.

    Starts from k-means and repeats expectation and maximisation over all rows: a
    pass returns one line of sums per task, added up by Spark. ``key`` names rows only.
    """
    train = _doubles(train, features)
    prepare = Pipeline(stages=[*_assembled(features), StandardScaler(inputCol="__raw", outputCol="__x", withMean=True)]).fit(train)
    points = cut_lineage(prepare.transform(train).select("__x", vector_to_array("__x").alias("x")))
    width = len(features)
    means = np.array(KMeans(featuresCol="__x", k=components, seed=0, maxIter=10).fit(points).clusterCenters())
    weights, variances = np.full(len(means), 1 / len(means)), np.ones_like(means)
    last = -math.inf
    for _ in range(iterations):
        state = (weights, means, variances)

        def sums(frames: Iterator[pd.DataFrame], state=state) -> Iterator[pd.DataFrame]:
            total = np.zeros((len(state[0]), 2 * width + 2))
            for frame in frames:
                if len(frame):
                    x = np.vstack(frame["x"].to_numpy())
                    parts = _log_parts(x, *state)
                    top = parts.max(axis=1, keepdims=True)
                    likely = top[:, 0] + np.log(np.exp(parts - top).sum(axis=1))
                    share_of = np.exp(parts - likely[:, None])
                    total[:, 0] += share_of.sum(axis=0)
                    total[:, 1:width + 1] += share_of.T @ x
                    total[:, width + 1:-1] += share_of.T @ (x * x)
                    total[0, -1] += likely.sum()
            yield pd.DataFrame({"cell": np.arange(total.size), "v": total.ravel()})
        got = points.select("x").mapInPandas(sums, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).toPandas()
        table = np.zeros(len(means) * (2 * width + 2))
        table[got["cell"]] = got["v"]
        table = table.reshape(len(means), -1)
        n = np.maximum(table[:, 0], 1e-10)
        weights, means = n / n.sum(), table[:, 1:width + 1] / n[:, None]
        variances = np.maximum(table[:, width + 1:-1] / n[:, None] - means ** 2, 0) + floor
        if table[0, -1] - last < 1e-3 * n.sum():
            break
        last = table[0, -1]
    fitted = (weights, means, variances)

    @F.pandas_udf("double")
    def surprise(x: pd.Series) -> pd.Series:
        parts = _log_parts(np.vstack(x.to_numpy()), *fitted)
        top = parts.max(axis=1)
        return pd.Series(-(top + np.log(np.exp(parts - top[:, None]).sum(axis=1))))

    def score(df: DataFrame) -> DataFrame:
        out = prepare.transform(_doubles(df, features)).withColumn("y_pred", surprise(vector_to_array("__x")))
        return out.select(*df.columns, "y_pred")
    return score


# ---- isolation forest ----------------------------------------------------------------

_NODES = "tree int, node int, feature int, threshold double, left int, right int, path double"


def _average_path(n: int) -> float:
    if n <= 1:
        return 0.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n if n > 2 else 1.0


def _grow(tree: int, x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    nodes: list[list] = []

    def build(rows: np.ndarray, depth: int) -> int:
        here = len(nodes)
        nodes.append([tree, here, -1, 0.0, -1, -1, depth + _average_path(len(rows))])
        spread = rows.max(axis=0) - rows.min(axis=0) if len(rows) else np.zeros(0)
        usable = np.flatnonzero(spread > 0)
        if depth < limit and len(rows) > 1 and len(usable):
            f = int(rng.choice(usable))
            cut = float(rng.uniform(rows[:, f].min(), rows[:, f].max()))
            below = rows[:, f] < cut
            nodes[here][2:4] = [f, cut]
            nodes[here][4] = build(rows[below], depth + 1)
            nodes[here][5] = build(rows[~below], depth + 1)
        return here

    build(x, 0)
    return [tuple(n) for n in nodes]


def fit_isolation_forest(train: DataFrame, features: Sequence[str], key: str, *, trees: int = 300,
                         sample: int = 256, seed: int = 0) -> Score:
    """Isolation forest: each tree grows in its own task from its own sample.

    Rows join trees by key hash, so samples are the same on every run. Only the
    sampled rows move; the forest (trees x at most 2 x sample nodes) is the one
    thing every scoring task receives.
    """
    features = list(features)
    medians = {c: v[0] or 0.0 for c, v in exact_quantiles(train, features, [0.5]).items()}
    filled = train.selectExpr(
        key, *[f"coalesce(nanvl(CAST(`{c}` AS DOUBLE), NULL), {medians[c]!r}D) AS `{c}`" for c in features])
    total = train.count()
    need = trees * sample * 2  # twice the sample, so nearly every tree fills up
    copies, rate = (1, need / total) if need < total else (math.ceil(need / max(total, 1)), 1.0)
    drawn = filled.selectExpr("*", f"explode(sequence(1, {copies})) AS __copy").withColumn(
        "__h", F.xxhash64(F.lit(seed), key, "__copy")).filter(
        F.pmod(F.col("__h"), F.lit(1_000_003)) < max(1, int(1_000_003 * rate)))
    members = drawn.withColumn("tree", F.pmod(F.shiftrightunsigned("__h", 20), F.lit(trees)).cast("int"))
    limit = math.ceil(math.log2(sample))

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(rows["tree"].iloc[0])
        # A key is used once per tree, then the first `sample` by hash.
        picked = rows.drop_duplicates(key).nsmallest(sample, "__h")[features].to_numpy(float)
        return pd.DataFrame(_grow(tree, picked, np.random.default_rng([seed, tree]), limit),
                            columns=["tree", "node", "feature", "threshold", "left", "right", "path"])

    forest = members.groupBy("tree").applyInPandas(grow, _NODES).toPandas().sort_values(["tree", "node"])
    shapes = [tuple(g[c].to_numpy() for c in ("feature", "threshold", "left", "right", "path"))
              for _, g in forest.groupby("tree")]
    shared = train.sparkSession.sparkContext.broadcast(shapes)
    norm = _average_path(min(sample, total))

    def score_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[features].apply(pd.to_numeric, errors="coerce").fillna(medians).to_numpy(float)
            depth = np.zeros(len(x))
            for feature, threshold, left, right, path in shared.value:
                at = np.zeros(len(x), dtype=int)
                while True:
                    f = feature[at]
                    inner = f >= 0
                    if not inner.any():
                        break
                    go_left = x[np.arange(len(x)), np.maximum(f, 0)] < threshold[at]
                    at = np.where(inner, np.where(go_left, left[at], right[at]), at)
                depth += path[at]
            yield batch.assign(y_pred=np.power(2.0, -depth / len(shared.value) / norm))

    def score(df: DataFrame) -> DataFrame:
        fields = ", ".join(f"`{n}` {t}" for n, t in df.dtypes)
        return df.mapInPandas(score_batches, f"{fields}, y_pred double")
    return score


# ---- neutralising and attribution ------------------------------------------------------

def neutral_values(train: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Training median (numbers, all in one pass) or commonest value (the rest) of the columns that exist."""
    present = [c for c in dict.fromkeys(columns) if c in train.columns]
    numeric = [c for c in present if schema.logical_type(train.schema[c].dataType) == schema.NUM]
    medians = exact_quantiles(train, numeric, [0.5])
    return {c: medians[c][0] if c in medians else most_common(train, c) for c in present}


def neutralise(df: DataFrame, train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace columns with their neutral values."""
    fills = {c: v for c, v in neutral_values(train, columns).items() if c in df.columns}
    return df.withColumns({c: F.lit(v) for c, v in fills.items()}) if fills else df


def attribution(df: DataFrame, train: DataFrame, score: Score, families: Mapping[str, Sequence[str]], key: str) -> DataFrame:
    """Score drop per family when it is neutralised, and the family that drops it most (or none).

    Each row is stacked once as it is and once per family with that family's columns
    neutral; one scoring pass and one aggregate by key give all drops.
    """
    fills = {c: v for c, v in neutral_values(train, [c for own in families.values() for c in own]).items() if c in df.columns}
    stacked = df.withColumn("__family", F.explode(F.array(F.lit(""), *map(F.lit, families))))
    touched = {c: [n for n, own in families.items() if c in own] for c in fills}
    swapped = stacked.withColumns({c: F.when(F.col("__family").isin(touched[c]), F.lit(v)).otherwise(F.col(c)) for c, v in fills.items()})
    of = lambda n: F.max(F.when(F.col("__family") == n, F.col("y_pred")))
    whole = of("")
    out = score(swapped).groupBy(key).agg(whole.alias("score"), *[(whole - of(n)).alias(f"drop_{n}") for n in families])
    drops = [f"drop_{n}" for n in families]
    best = F.greatest(*drops) if len(drops) > 1 else F.col(drops[0])
    label = F.when(best <= 0, "none")
    for n in families:
        label = label.when(F.col(f"drop_{n}") == best, n)
    return out.withColumn("dominant_family", label.otherwise("none"))
