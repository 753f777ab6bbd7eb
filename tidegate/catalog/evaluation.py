"""Metric, side-table and run-table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.catalog import rules as RC
from tidegate.catalog import standins as S
from tidegate.catalog.registry import query
from tidegate.session import scratch_folder
from tidegate.functions.predicates import where
from tidegate.operators.latest import first_in_group
from tidegate.plans import evaluation as E, rules as R
from tidegate.plans.dataset import load_nonempty

KEY = "o_orderkey"
FRAUD = "is_fraud = 1"
DEPTHS = (0.005, 0.01, 0.05)
SCORED = S.ctes(S.SCORED_SQL)


@query("f1_roc_auc", SCORED + """,
g AS (SELECT score, count(*) AS n, count(*) FILTER (WHERE is_fraud = 1) AS pos FROM scored GROUP BY 1),
c AS (SELECT *, coalesce(sum(n - pos) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
SELECT sum(pos * (below + (n - pos) / 2.0)::DOUBLE) / (sum(pos) * sum(n - pos))::DOUBLE AS auc FROM c""")
def f1(spark, sf):
    return E.auc(S.scored_orders(spark, sf), "score", FRAUD)


_AP = """,
g AS (SELECT score, count(*) AS n, count(*) FILTER (WHERE {y}) AS pos FROM scored WHERE {w} GROUP BY 1),
c AS (SELECT pos, sum(n) OVER (ORDER BY score DESC) AS cn, sum(pos) OVER (ORDER BY score DESC) AS cp, sum(pos) OVER () AS total FROM g)
SELECT round(sum(pos::DOUBLE / total * cp / cn), 9) AS average_precision FROM c"""


@query("f2_average_precision", SCORED + _AP.format(y=FRAUD, w="true"))
def f2(spark, sf):
    return _round(E.average_precision(S.scored_orders(spark, sf), "score", FRAUD), "average_precision")


def _round(df, column):
    """Sums of doubles depend on their order in the last bits; compare nine decimals."""
    return df.withColumn(column, F.round(column, 9))


@query("f3_log_loss", SCORED + """
SELECT round(-avg(CASE WHEN is_fraud = 1 THEN ln(p) ELSE ln(1 - p) END), 9) AS log_loss
FROM (SELECT is_fraud, greatest(2.220446049250313e-16, least(1 - 2.220446049250313e-16, score)) AS p FROM scored)""")
def f3(spark, sf):
    return _round(E.log_loss(S.scored_orders(spark, sf), "score", FRAUD), "log_loss")


@query("f4_threshold_sweep", SCORED + """
SELECT t::DOUBLE AS threshold,
  coalesce(count(*) FILTER (WHERE score >= t AND is_fraud = 1) / nullif(count(*) FILTER (WHERE score >= t), 0)::DOUBLE, 0) AS precision,
  coalesce(count(*) FILTER (WHERE score >= t AND is_fraud = 1) / nullif(count(*) FILTER (WHERE is_fraud = 1), 0)::DOUBLE, 0) AS recall
FROM scored CROSS JOIN (SELECT unnest([0.1, 0.5, 0.9, 2.0]::DOUBLE[]) AS t) GROUP BY 1""")
def f4(spark, sf):
    return E.threshold_sweep(S.scored_orders(spark, sf), "score", FRAUD, (0.1, 0.5, 0.9, 2.0))


RANKED = """
g AS (SELECT s AS score, count(*) AS n, count(*) FILTER (WHERE is_fraud = 1) AS pos FROM ranked GROUP BY 1),
c AS (SELECT *, coalesce(sum(n - pos) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
  sum(n) OVER (ORDER BY score DESC) AS cn, sum(pos) OVER (ORDER BY score DESC) AS cp, sum(pos) OVER () AS total FROM g)
SELECT 'auc' AS metric, round(sum(pos * (below + (n - pos) / 2.0)::DOUBLE) / (sum(pos) * sum(n - pos))::DOUBLE, 9) AS value FROM c
UNION ALL SELECT 'average_precision', round(sum(pos::DOUBLE / total * cp / cn), 9) FROM c"""


@query("f6_multi_metric_evaluation", SCORED + ", ranked AS (SELECT score AS s, is_fraud FROM scored)," + RANKED + """
UNION ALL SELECT 'log_loss', round(-avg(CASE WHEN is_fraud = 1 THEN ln(p) ELSE ln(1 - p) END), 9)
FROM (SELECT is_fraud, greatest(2.220446049250313e-16, least(1 - 2.220446049250313e-16, score)) AS p FROM scored)""")
def f6(spark, sf):
    scored = S.scored_orders(spark, sf).cache()
    spec = E.EvalSpec((
        E.Metric("auc", lambda d: E.auc(d, "score", FRAUD), ("score", "is_fraud")),
        E.Metric("average_precision", lambda d: E.average_precision(d, "score", FRAUD), ("score", "is_fraud")),
        E.Metric("log_loss", lambda d: E.log_loss(d, "score", FRAUD), ("score", "is_fraud")),
    ), primary="auc")
    rows = [(n, round(float(next(iter(r[0].values()))), 9)) for n, r in spec.evaluate(scored).items()]
    return spark.createDataFrame(rows, "metric string, value double")


def _side(spark, sf):
    return S.table(spark, sf, "orders").filter("o_orderkey % 3 <> 0").selectExpr(
        "o_orderkey", "o_totalprice * 2 AS doubled_price")


@query("f7_augmentation_join", SCORED + """
SELECT s.o_orderkey, s.score, a.doubled_price FROM scored s
LEFT JOIN (SELECT o_orderkey, o_totalprice * 2 AS doubled_price FROM orders WHERE o_orderkey % 3 <> 0) a USING (o_orderkey)""")
def f7(spark, sf):
    return E.join_augmentation(S.scored_orders(spark, sf), _side(spark, sf), [KEY]).select(
        KEY, "score", "doubled_price")


@query("f8_augmentation_admission", SCORED + """
SELECT a.o_orderkey, a.doubled_price FROM (SELECT o_orderkey, o_totalprice * 2 AS doubled_price FROM orders WHERE o_orderkey % 3 <> 0) a
WHERE NOT EXISTS (SELECT 1 FROM scored s WHERE s.o_orderkey = a.o_orderkey AND s.label_mature_d45 = 1)""")
def f8(spark, sf):
    return E.admit_augmentation(S.scored_orders(spark, sf).filter("label_mature_d45 = 1"), _side(spark, sf), [KEY])


@query("f11_evaluation_slice", SCORED + "SELECT o_orderkey, score FROM scored WHERE label_mature_d45 = 1 AND score >= 0.5")
def f11(spark, sf):
    return load_nonempty(S.scored_orders(spark, sf), (where("label_mature_d45") == 1) & (where("score") >= 0.5)).select(
        KEY, "score")


def _depth_sql(y, w="true", depths=DEPTHS, source="scored", key=KEY):
    parts = " UNION ALL ".join(
        f"""SELECT {d}::DOUBLE AS depth, k AS n_reviewed, tp AS true_positives, tp / k::DOUBLE AS precision,
          tp / nullif(pos, 0)::DOUBLE AS recall, (k - tp) / nullif(tp, 0)::DOUBLE AS fp_per_tp, pos / n::DOUBLE AS base_rate,
          (tp / k::DOUBLE) / nullif(pos / n::DOUBLE, 0) AS lift FROM (
          SELECT count(*) AS n, count(*) FILTER (WHERE y) AS pos, greatest(1, round_even(count(*) * {d}, 0))::BIGINT AS k,
                 count(*) FILTER (WHERE y AND rn <= greatest(1, round_even(t * {d}, 0))) AS tp FROM r)""" for d in depths)
    return f""",
r AS (SELECT ({y}) AS y, row_number() OVER (ORDER BY score DESC, {key}) AS rn, count(*) OVER () AS t FROM {source} WHERE {w}) {parts}"""


@query("f12_depth_metrics", SCORED + _depth_sql(FRAUD))
def f12(spark, sf):
    return E.depth_records(S.scored_orders(spark, sf), "score", FRAUD, KEY, DEPTHS)


@query("f13_band_report", SCORED + """,
r AS (SELECT *, row_number() OVER (ORDER BY score DESC, o_orderkey) AS rn, count(*) OVER () AS t,
             rank() OVER (ORDER BY score) AS lo, count(*) OVER (PARTITION BY score) AS ties FROM scored)
SELECT b AS band, count(heuristic_fraud_band) AS n, round(avg(100.0::DOUBLE * (lo + (ties - 1) / 2.0::DOUBLE) / t), 9) AS mean_score_percentile,
""" + ", ".join(
    f"""count(*) FILTER (WHERE rn <= greatest(1, round_even(t * {d}, 0))) AS "n_in_top_{d}",
  count(*) FILTER (WHERE rn <= greatest(1, round_even(t * {d}, 0))) / nullif(count(heuristic_fraud_band), 0)::DOUBLE AS "capture_at_{d}" """
    for d in DEPTHS) + """
FROM (SELECT unnest(['LOW', 'POSSIBLE', 'LIKELY', 'EXTREMELY_LIKELY', 'ODD']) AS b) LEFT JOIN r ON heuristic_fraud_band = b GROUP BY b""")
def f13(spark, sf):
    return _round(E.band_report(S.scored_orders(spark, sf), "score", "heuristic_fraud_band", KEY, DEPTHS),
                  "mean_score_percentile")


@query("f14_early_default_capture", SCORED + _depth_sql("label_gross_dpd45 = 1", "label_mature_d45 = 1"))
def f14(spark, sf):
    return E.early_default_capture(S.scored_orders(spark, sf), "score", KEY, DEPTHS)


@query("f15_outcome_average_precision", SCORED + f""",
a AS ({SCORED}{_AP.format(y='label_gross_dpd45 = 1', w='label_mature_d45 = 1')}),
b AS ({SCORED}{_AP.format(y='label_gross_dpd45 = 1 AND label_repaid_current_snapshot = 0', w='label_mature_d45 = 1')})
SELECT 'gross_dpd45' AS outcome, coalesce(average_precision, 0) AS average_precision FROM a
UNION ALL SELECT 'never_paid', coalesce(average_precision, 0) FROM b""")
def f15(spark, sf):
    scored = S.scored_orders(spark, sf)
    return _round(E.outcome_average_precision(scored, "score", E.DPD45).withColumn("outcome", F.lit("gross_dpd45")).unionByName(
        E.outcome_average_precision(scored, "score", E.NEVER_PAID).withColumn("outcome", F.lit("never_paid"))), "average_precision")


@query("f16_residual_only_depth", RC.WITH_FLAGS + _depth_sql(FRAUD, "NOT scenario_any", source="flagged"))
def f16(spark, sf):
    metric = E.on_residual(E.depth_records, RC.ORDER_RULES)
    return metric(RC.order_features(spark, sf), "score", FRAUD, KEY, DEPTHS)


@query("f17_rule_outcome_report", S.ctes(RC.STATS_SQL) + " UNION ALL ".join(
    f"""SELECT '{r}' AS scenario, count(*) FILTER (WHERE scenario_{r}) AS n, count(*) FILTER (WHERE scenario_{r} AND mature) AS n_mature,
      count(*) FILTER (WHERE scenario_{r} AND mature AND never) AS n_never_paid,
      count(*) FILTER (WHERE scenario_{r} AND mature AND never) / nullif(count(*) FILTER (WHERE scenario_{r} AND mature), 0)::DOUBLE AS never_paid_rate
      FROM s""" for r in RC.RULE_NAMES))
def f17(spark, sf):
    return R.identified_report(RC.order_features(spark, sf), RC.ORDER_RULES)


@query("f18_projected_revenue", SCORED + "SELECT round(avg(score * loan_amount - 25.0), 4) AS projected_revenue FROM scored")
def f18(spark, sf):
    return E.projected_revenue(S.scored_orders(spark, sf).withColumn("fee", F.lit(25.0)), "score", "loan_amount", "fee").select(
        F.round("projected_revenue", 4).alias("projected_revenue"))


@query("f20_prediction_bundle", SCORED + """,
p AS (SELECT o_orderkey, score AS y_pred, 'train' AS prediction_set FROM scored WHERE o_orderkey % 5 <> 0
      UNION ALL SELECT o_orderkey, score * score, 'test' FROM scored WHERE o_orderkey % 5 = 0)
SELECT p.*, a.doubled_price, b.o_orderpriority FROM p
LEFT JOIN (SELECT o_orderkey, o_totalprice * 2 AS doubled_price FROM orders WHERE o_orderkey % 3 <> 0) a USING (o_orderkey)
LEFT JOIN (SELECT o_orderkey, o_orderpriority FROM orders) b USING (o_orderkey)""")
def f20(spark, sf):
    s = S.scored_orders(spark, sf)
    sets = {"train": s.filter("o_orderkey % 5 <> 0").selectExpr(KEY, "score AS y_pred"),
            "test": s.filter("o_orderkey % 5 = 0").selectExpr(KEY, "score * score AS y_pred")}
    return E.prediction_bundle(sets, [_side(spark, sf), s.select(KEY, "o_orderpriority")], [KEY])


@query("f21_first_rows_per_class", """
SELECT o_orderstatus, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS rn FROM orders) WHERE rn <= 5""")
def f21(spark, sf):
    return first_in_group(S.table(spark, sf, "orders"), ["o_orderstatus"], [F.col("o_orderkey")], 5).select(
        "o_orderstatus", "o_orderkey")


@query("f22_score_parity", SCORED + """
SELECT count(a.score) AS n_left, count(b.score) AS n_right, max(abs(a.score - b.score)) AS max_abs_diff,
       count(a.score) = count(b.score) AND max(abs(a.score - b.score)) <= 1e-10 AS matches
FROM scored a FULL JOIN (SELECT o_orderkey, score + CASE WHEN o_orderkey % 100 = 0 THEN 1e-6 ELSE 0 END AS score FROM scored) b USING (o_orderkey)""")
def f22(spark, sf):
    a = S.scored_orders(spark, sf).selectExpr(KEY, "score AS y_pred")
    b = a.selectExpr(KEY, "y_pred + IF(o_orderkey % 100 = 0, 1e-6D, 0D) AS y_pred")
    return E.score_parity(a, b, [KEY])


@query("f22_score_parity_text", SCORED + """
SELECT count(*) AS n_left, count(*) AS n_right, 0.0::DOUBLE AS max_abs_diff, true AS matches FROM scored""")
def f22_text(spark, sf):
    rows = S.scored_orders(spark, sf).select(KEY, "loan_amount", "feature_as_of_ts", "o_orderpriority", "label_mature_d45", "score")
    weigh = lambda df: df.selectExpr(
        KEY, "score / 3 + ln(loan_amount) * IF(o_orderpriority = '1-URGENT', 0.7D, 0.1D) + year(feature_as_of_ts) * label_mature_d45 / 7 AS y_pred")
    return E.text_parity(rows, weigh, [KEY], scratch_folder(spark, "text"))
