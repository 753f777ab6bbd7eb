"""Residual queues, surrogate rules, subgroup search and cohort reports."""

from __future__ import annotations

import math
import statistics
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, functions as F

from tidegate.operators import ranking
from tidegate.operators.quantiles import exact_quantiles
from tidegate.plans.evaluation import MATURE, NEVER_PAID, review_count
from tidegate.session import share


def top_rows(df: DataFrame, score: str, key: str, k: int) -> DataFrame:
    """Exactly the top ``k`` rows by score, ties by key; a filter, not a global sort."""
    curve = ranking.score_curve(ranking.score_groups(df, score, "false"))
    return df.filter(ranking.top_cuts(curve, df, score, key, [k])[0])


def residual_queue(neutral_scored: DataFrame, key: str, top_fraction: float = 0.005, score: str = "y_pred") -> DataFrame:
    """Most anomalous rows once the circular family is neutralised."""
    k = max(1, int(neutral_scored.count() * top_fraction))
    return top_rows(neutral_scored, score, key, k)


# ---- surrogate rules -----------------------------------------------------------------

@dataclass(frozen=True)
class SurrogateRule:
    conditions: tuple[str, ...]
    n: int
    mean_score: float

    @property
    def where(self) -> str:
        return " AND ".join(self.conditions) or "true"


def _leaf_boxes(tree, features: Sequence[str]) -> list[tuple[str, ...]]:
    """The threshold conditions of each leaf of a fitted tree, from a queue of open nodes."""
    boxes, queue = [], [(tree._call_java("rootNode"), ())]
    while queue:
        node, box = queue.pop(0)
        if node.numDescendants() == 0:
            boxes.append(box)
            continue
        column, cut = features[node.split().featureIndex()], node.split().threshold()
        queue += [(child, (*box, f"{column} {side} {cut!r}D")) for side, child in (("<=", node.leftChild()), (">", node.rightChild()))]
    return boxes


def surrogate_rules(df: DataFrame, features: Sequence[str], score: str, *, max_depth: int = 3, min_leaf: int = 50) -> list[SurrogateRule]:
    """Threshold rules that mimic a score: leaves of a shallow regression tree, highest mean first."""
    medians = exact_quantiles(df, features, [0.5])
    filled = share(df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(medians[c][0] or 0.0)).alias(c) for c in features],
                             F.col(score).cast("double").alias("__y")))
    gather = VectorAssembler(inputCols=list(features), outputCol="__x")
    tree = DecisionTreeRegressor(featuresCol="__x", labelCol="__y", maxDepth=max_depth, minInstancesPerNode=min_leaf,
                                 maxBins=64, seed=0).fit(gather.transform(filled))
    boxes = _leaf_boxes(tree, features)
    # Leaves do not overlap: a row has one leaf number, and one grouped pass gives all supports and means.
    number = F.expr("CASE " + " ".join(f"WHEN {' AND '.join(box) or 'true'} THEN {i}" for i, box in enumerate(boxes)) + " END")
    held = filled.groupBy(number.alias("leaf")).agg(F.count("*").alias("n"), F.avg("__y").alias("mean")).collect()
    filled.unpersist()
    rules = [SurrogateRule(boxes[r.leaf], r.n, r["mean"]) for r in held if r.leaf is not None]
    return sorted(rules, key=lambda r: (-r.mean_score, r.conditions))


def rule_enrichment(df: DataFrame, rules: Mapping[str, str], band: str = "heuristic_fraud_band") -> DataFrame:
    """Support, mature outcome rate, base, lift and band counts of each rule condition, in one scan."""
    bad = f"{MATURE} AND {NEVER_PAID}"
    aggs = [F.expr(f"count_if({MATURE})").alias("base_n"), F.expr(f"count_if({bad})").alias("base_bad")]
    for i, w in enumerate(rules.values()):
        aggs += [F.expr(f"count_if({w})").alias(f"n{i}"), F.expr(f"count_if(({w}) AND {MATURE})").alias(f"m{i}"),
                 F.expr(f"count_if(({w}) AND {bad})").alias(f"b{i}"),
                 F.expr(f"count_if(({w}) AND {band} = 'LOW')").alias(f"l{i}")]
    cells = ", ".join(f"'{n}', n{i}, m{i}, b{i}, l{i}" for i, n in enumerate(rules))
    return df.agg(*aggs).selectExpr(
        "base_bad / nullif(base_n, 0) AS outcome_base",
        f"stack({len(rules)}, {cells}) AS (rule, n, n_mature, n_bad, n_low)").selectExpr(
        "rule", "n", "n_mature", "n_bad / nullif(n_mature, 0) AS outcome_rate", "outcome_base",
        "(n_bad / nullif(n_mature, 0)) / nullif(outcome_base, 0D) AS lift", "n_low")


# ---- subgroup search ------------------------------------------------------------------

# The cut points of selectors.
SELECTOR_QUANTILES = (0.33, 0.5, 0.67)
SELECTOR_COUNTS = (2, 3)


@dataclass(frozen=True, order=True)
class Selector:
    """One comparison of a column with a number; rows with a null fail it."""

    column: str
    op: str
    value: float

    @property
    def name(self) -> str:
        return f"{self.column} {'==' if self.op == '=' else self.op} {self.value:.4g}"

    @property
    def sql(self) -> str:
        number = f"{self.value!r}D" if isinstance(self.value, float) else str(self.value)
        return f"coalesce({self.column} {self.op} {number}, false)"


def selectors_for(df: DataFrame, counts: Sequence[str] = (), continuous: Sequence[str] = (), binary: Sequence[str] = ()) -> list[Selector]:
    """Selectors of three kinds of columns: counts from the fixed sizes up, both sides of the quantiles, and ones."""
    cuts = exact_quantiles(df, list(continuous), SELECTOR_QUANTILES) if continuous else {}
    sides = [Selector(c, op, q) for c in continuous for q in sorted({round(v, 4) for v in cuts[c] if v is not None}) for op in ("<=", ">")]
    return [Selector(c, ">=", n) for c in counts for n in SELECTOR_COUNTS] + sides + [Selector(c, "=", 1) for c in binary]


def build_selectors(df: DataFrame, *columns: Sequence[str], **kinds: Sequence[str]) -> list[tuple[str, str]]:
    """:func:`selectors_for` as (name, SQL condition) pairs, the form the search takes."""
    return [(x.name, x.sql) for x in selectors_for(df, *columns, **kinds)]


# ``mark`` adds up a hash per pattern of test rows, so that equal sums name equal sets of test rows.
_COUNTS = ("n_tr", "pos_tr", "n_te", "pos_te", "alt_te", "mark")


@dataclass(frozen=True)
class Subgroup:
    conditions: tuple[str, ...]
    n_train: int
    train_rate: float
    n_test: int
    test_rate: float
    alt_test_rate: float
    lift: float
    p_value: float


def selector_patterns(df: DataFrame, selectors: Sequence[tuple[str, str]], outcome: str, alternative: str, is_train: str) -> DataFrame:
    """Counts per distinct combination of selectors: rows with the same pattern are one line."""
    words = []
    for w in range(0, len(selectors), 62):
        bits = [f"IF({cond}, {1 << i}L, 0L)" for i, (_, cond) in enumerate(selectors[w:w + 62])]
        words.append(f"{' | '.join(bits)} AS w{w // 62}")
    names = [f"w{i}" for i in range(len(words))]
    return df.selectExpr(*words, f"({is_train}) AS tr", f"({outcome}) AS y", f"({alternative}) AS alt").groupBy(*names).agg(
        F.expr("count_if(tr)").alias("n_tr"), F.expr("count_if(tr AND y)").alias("pos_tr"),
        F.expr("count_if(NOT tr)").alias("n_te"), F.expr("count_if(NOT tr AND y)").alias("pos_te"),
        F.expr("count_if(NOT tr AND alt)").alias("alt_te")).withColumn(
        "mark", F.when(F.col("n_te") > 0, F.shiftrightunsigned(F.xxhash64(*names), 24)).otherwise(F.lit(0)))


def _count_candidates(patterns: DataFrame, candidates: Sequence[frozenset[int]]) -> np.ndarray:
    """Totals of each candidate conjunction: partial sums per task, then one sum per candidate."""
    width = len([c for c in patterns.columns if c.startswith("w")])
    masks = np.zeros((len(candidates), width), dtype=np.int64)
    for j, cand in enumerate(candidates):
        for i in cand:
            masks[j, i // 62] |= np.int64(1) << np.int64(i % 62)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((len(masks), len(_COUNTS)), dtype=np.int64)
        for batch in batches:
            words = batch[[f"w{i}" for i in range(width)]].to_numpy(np.int64)
            counts = batch[list(_COUNTS)].to_numpy(np.int64)
            for a in range(0, len(masks), 256):
                block = masks[a:a + 256]
                hit = np.ones((len(words), len(block)), dtype=bool)
                for w in range(width):
                    hit &= (words[:, w:w + 1] & block[None, :, w]) == block[None, :, w]
                sums[a:a + 256] += hit.T.astype(np.int64) @ counts
        yield pd.DataFrame(sums, columns=list(_COUNTS)).assign(cand=np.arange(len(masks)))

    # At most beam x selectors lines come back.
    rows = patterns.mapInPandas(partial, ", ".join(f"{c} long" for c in _COUNTS) + ", cand long").groupBy("cand").agg(
        *[F.sum(c).alias(c) for c in _COUNTS]).toPandas().set_index("cand").reindex(range(len(candidates)), fill_value=0)
    return rows[list(_COUNTS)].to_numpy(np.int64)


def subgroup_search(df: DataFrame, selectors: Sequence[tuple[str, str]], *, outcome: str, is_train: str,
                    alternative: str = "false", depth: int = 3, beam: int = 80, min_support: int = 80,
                    min_test: int = 30) -> list[Subgroup]:
    """Beam search for conjunctions with a high training rate, validated on the test rows.

    Data passes: one to build the pattern table, one small pass per depth.
    """
    names = [n for n, _ in selectors]
    patterns = share(selector_patterns(df, selectors, outcome, alternative, is_train))
    totals = patterns.agg(*[F.sum(c).alias(c) for c in _COUNTS]).first()
    found: dict[frozenset[int], np.ndarray] = {}
    seen: set[frozenset[int]] = set()
    candidates = [frozenset([i]) for i in range(len(names))]
    for _ in range(depth):
        if not candidates:
            break
        counts = _count_candidates(patterns, candidates)
        kept = [(c, row) for c, row in zip(candidates, counts) if row[0] >= min_support]
        # Highest training rate first; names settle ties.
        kept.sort(key=lambda t: (-(t[1][1] / t[1][0]), sorted(names[i] for i in t[0])))
        found.update(kept if len(next(iter(candidates))) > 1 else kept[:beam])
        seen.update(c for c, _ in kept)
        candidates = sorted({c | {i} for c, _ in kept[:beam] for i in range(len(names)) if i not in c} - seen,
                            key=lambda c: sorted(names[i] for i in c))
    base = totals.pos_te / totals.n_te if totals.n_te else 0.0
    # Conjunctions that pick the same test rows are one subgroup, named by the shortest.
    by_rows: dict[tuple[int, int], tuple[tuple[str, ...], np.ndarray]] = {}
    for candidate, row in found.items():
        label = tuple(sorted(names[i] for i in candidate))
        n_test, mark = int(row[2]), int(row[5])
        if n_test < max(min_test, 1):
            continue
        held = by_rows.get((n_test, mark))
        if held is None or (len(label), label) < (len(held[0]), held[0]):
            by_rows[n_test, mark] = (label, row)
    groups = []
    for label, (n_tr, pos_tr, n_te, pos_te, alt_te, _) in by_rows.values():
        rate = float(pos_te / n_te)
        groups.append(Subgroup(label, int(n_tr), float(pos_tr / n_tr), int(n_te), rate, float(alt_te / n_te),
                               rate / base if base else math.nan, upper_tail(int(pos_te), int(n_te), base)))
    return sorted(groups, key=lambda g: (-g.test_rate, g.conditions))


def upper_tail(k: int, n: int, p: float) -> float:
    """Chance of ``k`` hits or more in ``n`` draws of rate ``p``.

    Fixed values: the normal curve stands in for the binomial, with half a hit of
    continuity correction; without draws or with a sure rate the chance is 1.
    """
    if not n or not 0 < p < 1:
        return 1.0
    spread = statistics.NormalDist(n * p, math.sqrt(n * p * (1 - p)))
    return spread.cdf(2 * n * p - (k - 0.5))  # the mirrored lower tail, which keeps small chances exact


# ---- cohort report ----------------------------------------------------------------------

def cohort_report(df: DataFrame, score: str, key: str, fractions: Sequence[float], indicators: Mapping[str, str],
                  drivers: Sequence[str], *, outcome: str = NEVER_PAID, band: str = "heuristic_fraud_band") -> DataFrame:
    """Per top fraction: outcome rate against base, LOW slice, indicator prevalence ratio, driver medians.

    Long form (cohort, measure, value, base); all counts of all cohorts come from one scan.
    """
    df = share(df)
    curve = ranking.score_curve(ranking.score_groups(df, score, "false"))
    n = curve.agg(F.max("total_n")).first()[0] or 0
    counts = [review_count(n, q) for q in fractions]
    cuts = ranking.top_cuts(curve, df, score, key, counts)
    cohorts = {"all": "true", **{f"top_{q}": c for q, c in zip(fractions, cuts)}}
    measures = {"n": "true", "outcome": outcome, "low": f"{band} = 'LOW'", "low_outcome": f"{band} = 'LOW' AND {outcome}",
                **{f"share_{i}": w for i, w in indicators.items()}}
    aggs = [F.expr(f"count_if(({c}) AND ({m}))").alias(f"{i}_{j}")
            for i, c in enumerate(cohorts.values()) for j, m in enumerate(measures.values())]
    row = df.agg(*aggs).first()
    total = {name: [row[f"{i}_{j}"] for j in range(len(measures))] for i, name in enumerate(cohorts)}
    ratio = lambda a, b: a / b if b else None
    rows = []
    for name in list(cohorts)[1:]:
        mine, base = dict(zip(measures, total[name])), dict(zip(measures, total["all"]))
        rows.append((name, "n", float(mine["n"]), float(base["n"])))
        rows.append((name, "outcome_rate", ratio(mine["outcome"], mine["n"]), ratio(base["outcome"], base["n"])))
        rows.append((name, "low_share", ratio(mine["low"], mine["n"]), ratio(base["low"], base["n"])))
        rows.append((name, "low_outcome_rate", ratio(mine["low_outcome"], mine["low"]), ratio(base["low_outcome"], base["low"])))
        rows += [(name, f"share_{i}", ratio(mine[f"share_{i}"], mine["n"]), ratio(base[f"share_{i}"], base["n"])) for i in indicators]
    if drivers:
        overall = exact_quantiles(df, drivers, [0.5])
        for name, cond in list(cohorts.items())[1:]:
            inside = exact_quantiles(df.filter(cond), drivers, [0.5])
            rows += [(name, f"median_{d}", inside[d][0], overall[d][0]) for d in drivers]
    return df.sparkSession.createDataFrame(rows, "cohort string, measure string, value double, base double")
