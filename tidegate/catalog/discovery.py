"""Model, discovery, event-order and run-table queries."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tidegate.catalog import standins as S
from tidegate.catalog.evaluation import RANKED, _depth_sql
from tidegate.catalog.registry import query
from tidegate.functions import clock
from tidegate.operators import spans as J
from tidegate.plans import discovery as D, evaluation as E, models as M, runs as R
from tidegate.plans.rules import Rule, residual
from tidegate.session import scratch_folder, share
from tidegate.streaming.jobs import alerts, pair_spans_stream, phase_rollup_stream, velocity_stream
from tidegate.streaming.ordered import as_event_time

FEATURES = ("loan_amount", "c_acctbal", "score", "weekday")


def modelling(spark, sf):
    """Scored orders with customer columns; every seventh balance is missing."""
    customers = S.table(spark, sf, "customer").selectExpr(
        "c_custkey", "IF(c_custkey % 7 = 0, NULL, c_acctbal) AS c_acctbal", "c_mktsegment")
    return S.scored_orders(spark, sf).join(customers, F.expr("o_custkey = c_custkey")).selectExpr(
        "*", "weekday(feature_as_of_ts) AS weekday", f"CAST({S._spark_bucket('o_custkey', 100)} AS INT) AS SPLIT_PCT")


MODEL_SQL = S.SCORED_SQL + f""",
m AS (SELECT s.*, CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS c_acctbal, c_mktsegment,
             isodow(feature_as_of_ts) - 1 AS weekday, {S.bucket_sql('o_custkey')} AS split FROM scored s JOIN customer ON o_custkey = c_custkey)"""
MODEL = S.ctes(MODEL_SQL)


def train_test(spark, sf):
    df = share(modelling(spark, sf))
    return df.filter("SPLIT_PCT < 80"), df.filter("SPLIT_PCT >= 80")


_LOGIT = "ln(least(greatest({r}, 1e-6), 1 - 1e-6) / (1 - least(greatest({r}, 1e-6), 1 - 1e-6)))"


@query("i1_weight_of_evidence", MODEL + f""",
t AS (SELECT coalesce(CASE WHEN o_custkey % 11 <> 0 THEN o_orderpriority END, '__missing__') AS c, is_fraud, split, o_orderkey FROM m),
g AS (SELECT c, {_LOGIT.format(r='((sum(is_fraud) + 0.5) / (count(*) + 1.0))::DOUBLE')} AS woe FROM t WHERE split < 80 AND c <> '5-LOW' GROUP BY 1),
o AS (SELECT {_LOGIT.format(r='((sum(is_fraud) + 0.5) / (count(*) + 1.0))::DOUBLE')} AS fallback FROM t WHERE split < 80 AND c <> '5-LOW')
SELECT o_orderkey, round(coalesce(woe, fallback), 9) AS woe FROM t LEFT JOIN g USING (c), o""")
def i1(spark, sf):
    df = modelling(spark, sf).withColumn("cat", F.expr("IF(o_custkey % 11 <> 0, o_orderpriority, NULL)"))
    fitted = M.fit_woe(df.filter("SPLIT_PCT < 80 AND coalesce(cat, '') <> '5-LOW'"), "cat", "is_fraud = 1")
    return M.apply_woe(df, fitted, "cat").select("o_orderkey", F.round("woe", 9).alias("woe"))


@query("i2_logistic_baseline")
def i2(spark, sf):
    train, test = train_test(spark, sf)
    return M.fit_baseline(train, FEATURES, "is_fraud")(test).select("o_orderkey", "y_pred")


@query("i3_batch_scoring")
def i3(spark, sf):
    train, test = train_test(spark, sf)
    text = test.withColumn("loan_amount", F.expr("IF(o_orderkey % 20 = 0, 'nan', CAST(loan_amount AS STRING))"))
    return M.batch_score(text, M.fit_baseline(train, FEATURES, "is_fraud"), {"loan_amount": "num"}, FEATURES).select(
        "o_orderkey", "y_pred")


def formula(df):
    """A fixed score with a known answer, in place of a fitted model."""
    return df.withColumn("y_pred", F.expr(
        "loan_amount / 100000D + coalesce(c_acctbal, 0D) / 1000D + IF(c_mktsegment = 'BUILDING', 1D, 0D) + score"))


FAMILIES = {"amount": ["loan_amount"], "account": ["c_acctbal"], "segment": ["c_mktsegment", "score"]}
_F = "loan_amount / 100000.0::DOUBLE + coalesce(c_acctbal, 0) / 1000.0::DOUBLE + CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END + score"
NEUTRAL_SQL = MODEL + f""",
med AS (SELECT quantile_cont(loan_amount, 0.5) AS ma, quantile_cont(c_acctbal, 0.5) AS mb, quantile_cont(score, 0.5) AS ms FROM m WHERE split < 80),
mode AS (SELECT c_mktsegment AS seg FROM m WHERE split < 80 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
d AS (SELECT o_orderkey, {_F} AS score,
   ({_F}) - ({_F.replace('loan_amount', 'ma')}) AS drop_amount, ({_F}) - ({_F.replace('coalesce(c_acctbal, 0)', 'mb')}) AS drop_account,
   ({_F}) - ({_F.replace('c_mktsegment', 'seg').replace('+ score', '+ ms')}) AS drop_segment FROM m, med, mode WHERE split >= 80)"""


@query("i4_neutralised_score", NEUTRAL_SQL + "SELECT o_orderkey, round(score - drop_account, 8) AS y_pred FROM d")
def i4(spark, sf):
    train, test = train_test(spark, sf)
    return formula(M.neutralise(test, train, ["c_acctbal", "not_there"])).select("o_orderkey", F.round("y_pred", 8).alias("y_pred"))


@query("i5_attribution", NEUTRAL_SQL + """
SELECT o_orderkey, round(score, 9) AS score, round(drop_amount, 9) AS drop_amount, round(drop_account, 9) AS drop_account,
  round(drop_segment, 9) AS drop_segment, CASE WHEN greatest(drop_amount, drop_account, drop_segment) <= 0 THEN 'none'
  WHEN drop_amount >= greatest(drop_account, drop_segment) THEN 'amount' WHEN drop_account >= drop_segment THEN 'account' ELSE 'segment' END AS dominant_family FROM d""")
def i5(spark, sf):
    train, test = train_test(spark, sf)
    out = M.attribution(test, train, formula, FAMILIES, "o_orderkey")
    return out.select("o_orderkey", *[F.round(c, 9).alias(c) for c in ("score", "drop_amount", "drop_account", "drop_segment")],
                      "dominant_family")


@query("i6_residual_queue", NEUTRAL_SQL + """
SELECT o_orderkey FROM d ORDER BY round(score - drop_amount, 9) DESC, o_orderkey
LIMIT (SELECT greatest(1, floor(count(*) * 0.05))::BIGINT FROM d)""")
def i6(spark, sf):
    train, test = train_test(spark, sf)
    scored = share(formula(M.neutralise(test, train, ["loan_amount"])).withColumn("y_pred", F.round("y_pred", 9)))
    return D.residual_queue(scored, "o_orderkey", 0.05).select("o_orderkey")


@query("i7_surrogate_rules")
def i7(spark, sf):
    rules = D.surrogate_rules(formula(modelling(spark, sf)), FEATURES, "y_pred")
    return spark.createDataFrame([(r.where, r.n, r.mean_score) for r in rules], "rule string, n long, mean_score double")


_RULES = {"big": "loan_amount > 300000", "big_weekend": "loan_amount > 300000 AND weekday >= 5"}


@query("i8_rule_enrichment", MODEL + ",b AS (SELECT avg((label_gross_dpd45 = 1 AND label_repaid_current_snapshot = 0)::INT) AS base FROM m WHERE label_mature_d45 = 1) " + " UNION ALL ".join(
    f"""SELECT '{n}' AS rule, count(*) AS n, count(*) FILTER (WHERE label_mature_d45 = 1) AS n_mature,
    avg((label_gross_dpd45 = 1 AND label_repaid_current_snapshot = 0)::INT) FILTER (WHERE label_mature_d45 = 1) AS outcome_rate, max(base) AS outcome_base,
    avg((label_gross_dpd45 = 1 AND label_repaid_current_snapshot = 0)::INT) FILTER (WHERE label_mature_d45 = 1) / max(base) AS lift,
    count(*) FILTER (WHERE heuristic_fraud_band = 'LOW') AS n_low FROM m, b WHERE {w}""" for n, w in _RULES.items()))
def i8(spark, sf):
    return D.rule_enrichment(modelling(spark, sf), _RULES)


@query("i9_selector_cuts", MODEL + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(quantile_cont({c}, {q}), 4) AS cut FROM m""" for c in ("loan_amount", "c_acctbal") for q in (0.33, 0.5, 0.67)))
def i9(spark, sf):
    names = ["loan_amount", "c_acctbal"]
    below = [x for x in D.selectors_for(modelling(spark, sf), continuous=names) if x.op == "<="]
    return spark.createDataFrame([(x.column, x.value) for x in below], "column string, cut double")


@query("i10_subgroup_search")
def i10(spark, sf):
    df = share(modelling(spark, sf).filter("label_mature_d45 = 1"))
    selectors = D.build_selectors(df, ["weekday"], ["loan_amount", "c_acctbal", "score"], ["label_repaid_current_snapshot"])
    found = D.subgroup_search(df, selectors, outcome=E.NEVER_PAID, alternative="label_gross_dpd45 = 1", is_train="SPLIT_PCT < 80")
    return spark.createDataFrame([(" AND ".join(g.conditions), g.n_train, g.train_rate, g.n_test, g.test_rate, g.lift, g.p_value)
                                  for g in found], "conditions string, n_train long, train_rate double, n_test long, test_rate double, lift double, p_value double")


_CHECK = {"urgent": "o_orderpriority = '1-URGENT'", "big": "loan_amount > 300000", "weekend": "weekday >= 5"}


@query("i11_held_out_validation", MODEL + ",y AS (SELECT *, (label_gross_dpd45 = 1 AND label_repaid_current_snapshot = 0)::INT AS y FROM m WHERE label_mature_d45 = 1) " + " UNION ALL ".join(
    f"""SELECT '{n}' AS rule, count(*) FILTER (WHERE split >= 80) AS n_test, avg(y) FILTER (WHERE split >= 80) AS test_rate,
    avg(y) FILTER (WHERE split < 80) AS train_rate, avg(y) FILTER (WHERE split >= 80) / (SELECT avg(y) FROM y WHERE split >= 80) AS lift FROM y WHERE {w}""" for n, w in _CHECK.items()))
def i11(spark, sf):
    df = modelling(spark, sf).filter("label_mature_d45 = 1")
    found = D.subgroup_search(df, [(n, f"coalesce({w}, false)") for n, w in _CHECK.items()], outcome=E.NEVER_PAID,
                              is_train="SPLIT_PCT < 80", depth=1, min_support=1, min_test=1)
    return spark.createDataFrame([(g.conditions[0], g.n_test, g.test_rate, g.train_rate, g.lift) for g in found],
                                 "rule string, n_test long, test_rate double, train_rate double, lift double")


LARGE_ORDERS = (Rule("large_order", "review", "draft", "2026-01-01", "A very large order.",
                       ({"column": "loan_amount", "op": ">", "value": 440000},)),)


@query("i13_boosted_lens")
def i13(spark, sf):
    train, test = train_test(spark, sf)
    # The lens learns from mature rows that no rule has caught.
    gated = residual(train, LARGE_ORDERS).filter(E.MATURE)
    return M.fit_boosted(gated, FEATURES, "label_gross_dpd45")(test).select("o_orderkey", "y_pred")


@query("i14_isolation_forest")
def i14(spark, sf):
    train, test = train_test(spark, sf)
    return M.fit_isolation_forest(train, FEATURES, "o_orderkey", trees=300)(test.select("o_orderkey", *FEATURES)).select(
        "o_orderkey", "y_pred")


@query("i15_gaussian_mixture")
def i15(spark, sf):
    train, test = train_test(spark, sf)
    return M.fit_mixture(train, FEATURES, "o_orderkey", components=8)(test).select("o_orderkey", "y_pred")


@query("i16_depth_table_with_lift", MODEL + _depth_sql("is_fraud = 1", "label_mature_d45 = 1", (0.01, 0.05, 0.1), source="m"))
def i16(spark, sf):
    return E.depth_records(modelling(spark, sf), "score", "is_fraud = 1", "o_orderkey", (0.01, 0.05, 0.1), "label_mature_d45 = 1")


_NP = "label_gross_dpd45 = 1 AND label_repaid_current_snapshot = 0"
_COHORT = """,
r AS (SELECT *, row_number() OVER (ORDER BY score DESC, o_orderkey) AS rn, count(*) OVER () AS t FROM m),
a AS (SELECT *, rn <= greatest(1, round_even(t * 0.05, 0)) AS top FROM r),
x AS (SELECT count(*) FILTER (WHERE top)::DOUBLE AS n, count(*)::DOUBLE AS bn, """ + ", ".join(
    f"count(*) FILTER (WHERE top AND {w}) / (count(*) FILTER (WHERE top AND {d}))::DOUBLE AS {n}, count(*) FILTER (WHERE {w}) / (count(*) FILTER (WHERE {d}))::DOUBLE AS b{n}"
    for n, w, d in (("outcome_rate", _NP, "true"), ("low_share", "heuristic_fraud_band = 'LOW'", "true"),
                    ("low_outcome_rate", f"heuristic_fraud_band = 'LOW' AND {_NP}", "heuristic_fraud_band = 'LOW'"),
                    ("share_big", "loan_amount > 300000", "true"))) + """,
  quantile_cont(loan_amount, 0.5) FILTER (WHERE top) AS median_loan_amount, quantile_cont(loan_amount, 0.5) AS bmedian_loan_amount FROM a)
""" + " UNION ALL ".join(f"SELECT 'top_0.05' AS cohort, '{m}' AS measure, {m} AS value, b{m} AS base FROM x" for m in (
    "n", "outcome_rate", "low_share", "low_outcome_rate", "share_big", "median_loan_amount"))


@query("i17_cohort_report", MODEL + _COHORT)
def i17(spark, sf):
    return D.cohort_report(modelling(spark, sf), "score", "o_orderkey", [0.05], {"big": "loan_amount > 300000"}, ["loan_amount"])


@query("f19_batch_evaluation", MODEL + f", ranked AS (SELECT {_F} AS s, is_fraud FROM m WHERE split >= 80)," + RANKED)
def f19(spark, sf):
    train, test = train_test(spark, sf)
    spec = E.EvalSpec((E.Metric("auc", lambda d: E.auc(d, "y_pred", "is_fraud = 1")),
                       E.Metric("average_precision", lambda d: E.average_precision(d, "y_pred", "is_fraud = 1"))), primary="auc")
    found = E.evaluate(test, formula, spec, scratch_folder(spark, "evaluation"), ["o_orderkey"], "holdout")
    return spark.createDataFrame([(n, round(float(next(iter(r[0].values()))), 9)) for n, r in found.items()], "metric string, value double")


# ---- event order --------------------------------------------------------------------

def span_events(spark, sf):
    return S.events(spark, sf).filter("event_type IN ('view', 'click')").selectExpr(
        "user_id", "ts", "event_id", "IF(event_type = 'view', 'start', 'end') AS kind", f"{S.K} % 4 AS phase")


_PAIR = """WITH e AS (SELECT user_id, ts, event_id, CASE WHEN event_type = 'view' THEN 1 ELSE -1 END AS step,
  CAST(json_extract_string(props, '$.k') AS BIGINT) % 4 AS phase FROM events WHERE event_type IN ('view', 'click')),
s AS (SELECT *, sum(step) OVER w AS s FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
m AS (SELECT *, least(0, min(s) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS m,
             least(0, coalesce(min(s) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS mp FROM s),
l AS (SELECT *, step = -1 AND s < mp AS lost, CASE WHEN step = 1 THEN s - m ELSE s - m + 1 END AS lvl FROM m),
o AS (SELECT *, max(CASE WHEN step = 1 THEN struct_pack(ts := ts, id := event_id, phase := phase) END)
        OVER (PARTITION BY user_id, lvl ORDER BY ts, event_id) AS opened FROM l WHERE NOT lost),
spans AS (SELECT user_id, opened.id AS start_seq, event_id AS end_seq, opened.ts AS start_ts, ts AS end_ts, opened.phase AS phase,
  (epoch_us(ts) - epoch_us(opened.ts)) / 1e6 AS duration_s FROM o WHERE step = -1)"""


@query("j1_span_pairing", _PAIR + "SELECT * FROM spans")
def j1(spark, sf):
    return J.pair_spans(span_events(spark, sf), "user_id", "ts", "event_id", carry=["phase"])


@query("j1_unmatched_counts", _PAIR + """
SELECT user_id, count(*) FILTER (WHERE step = 1) - count(*) FILTER (WHERE step = -1 AND NOT lost) AS unmatched_start_count,
       count(*) FILTER (WHERE lost) AS unmatched_end_count FROM l GROUP BY 1""")
def j1u(spark, sf):
    return J.unmatched_counts(span_events(spark, sf), "user_id", "ts", "event_id")


@query("j2_phase_rollup", _PAIR + """
SELECT phase::VARCHAR AS phase, round(sum(duration_s), 5) AS duration_s, count(*) AS n_spans FROM spans GROUP BY 1""")
def j2(spark, sf):
    out = J.phase_rollup(J.pair_spans(span_events(spark, sf), "user_id", "ts", "event_id", carry=["phase"]), "phase")
    return out.withColumn("duration_s", F.round("duration_s", 5))


@query("j3_uncovered_time", """
WITH e AS (SELECT user_id, ts AS start_ts, ts + (CAST(json_extract_string(props, '$.k') AS BIGINT) * INTERVAL 10 MINUTE) AS end_ts FROM events),
b AS (SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY 1),
c AS (SELECT user_id, epoch_us(start_ts) AS s, least(epoch_us(end_ts), epoch_us(last_ts)) AS e, epoch_us(last_ts) - epoch_us(first_ts) AS total FROM e JOIN b USING (user_id)),
g AS (SELECT *, max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM c)
SELECT user_id, max(total) / 1e6 AS total_s, (max(total) - sum(greatest(0, e - greatest(s, coalesce(far, s))))) / 1e6 AS unattributed_s FROM g GROUP BY 1""")
def j3(spark, sf):
    events = S.events(spark, sf)
    spans = events.selectExpr("user_id", "ts AS start_ts", f"ts + make_dt_interval(0, 0, CAST({S.K} * 10 AS INT)) AS end_ts")
    bounds = events.groupBy("user_id").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return J.uncovered_time(spans, bounds, "user_id")


STREAM_DELAY_S = 3600


def drained(spark, sf, build, name):
    """Run a stream over the event file to exhaustion and read what it wrote.

    A closing event of no user, far ahead of the others, moves the watermark past the last rows.
    """
    events = S.events(spark, sf)
    folder = scratch_folder(spark, name)
    ahead = events.agg(F.max("ts")).first()[0] + datetime.timedelta(days=400)
    closing = events.limit(1).withColumns({"user_id": F.lit(-1), "event_id": F.lit(-1), "value": F.lit(0.0), "ts": F.lit(ahead)})
    kinds = closing.drop("event_type").withColumn("event_type", F.explode(F.array(F.lit("view"), F.lit("purchase"))))
    kinds.select(*[F.col(f.name).cast(f.dataType) for f in events.schema]).write.parquet(f"{folder}/closing")
    source = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    source = source.unionByName(spark.readStream.schema(events.schema).parquet(f"{folder}/closing"))
    started = build(as_event_time(source, "ts")).writeStream.format("parquet").option(
        "checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start(f"{folder}/out")
    started.awaitTermination()
    return spark.read.parquet(f"{folder}/out")


@query("j1_span_pairing_stream", _PAIR + "SELECT user_id, start_seq, end_seq, duration_s FROM spans")
def j1s(spark, sf):
    build = lambda ev: pair_spans_stream(
        ev.filter("event_type IN ('view', 'click')").withColumn("kind", F.expr("IF(event_type = 'view', 'start', 'end')")),
        "user_id", "ts", "event_id", delay=f"{STREAM_DELAY_S} seconds")
    return drained(spark, sf, build, "spans").filter("outcome = 'span'").select("user_id", "start_seq", "end_seq", "duration_s")


@query("j2_phase_rollup_stream", _PAIR + """
SELECT time_bucket(INTERVAL 1 HOUR, end_ts) AS window_start, phase::VARCHAR AS phase,
       ((sum(epoch_us(end_ts) - epoch_us(start_ts))::BIGINT + 5) // 10) / 1e5 AS duration_s, count(*) AS n_spans, 0::BIGINT AS late_rows FROM spans GROUP BY 1, 2""")
def j2s(spark, sf):
    build = lambda ev: phase_rollup_stream(
        ev.filter("event_type IN ('view', 'click')").withColumns(
            {"kind": F.expr("IF(event_type = 'view', 'start', 'end')"), "phase": F.expr(f"CAST({S.K} % 4 AS STRING)")}),
        "user_id", "ts", "event_id", "phase", delay=f"{STREAM_DELAY_S} seconds")
    return drained(spark, sf, build, "phases").selectExpr(
        "CAST(window_start AS TIMESTAMP_NTZ) AS window_start", "phase", "duration_s", "n_spans", "late_rows")


@query("j5_velocity_alert_stream", """
WITH p AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase'),
v AS (SELECT a.user_id, a.event_id, a.value, a.ts, count(b.event_id) FILTER (WHERE b.ts >= a.ts - INTERVAL 24 HOUR) AS prior_events_24h,
  count(b.event_id) FILTER (WHERE b.ts >= a.ts - INTERVAL 7 DAY) AS prior_events_7d, count(b.event_id) AS prior_events_lifetime
  FROM p a LEFT JOIN p b ON a.user_id = b.user_id AND b.ts < a.ts GROUP BY ALL)
SELECT user_id, event_id, value, prior_events_24h, prior_events_7d, prior_events_lifetime, true AS scenario_busy_day, true AS scenario_any
FROM v WHERE prior_events_24h >= 1 AND value > 20""")
def j5(spark, sf):
    rule = Rule("busy_day", "review", "draft", "2026-01-01", "A second sizable purchase within a day.",
                ({"column": "prior_events_24h", "op": ">=", "value": 1}, {"column": "value", "op": ">", "value": 20}))
    build = lambda ev: alerts(velocity_stream(
        ev.filter("event_type = 'purchase'"), "user_id", "ts", "event_id", delay=f"{STREAM_DELAY_S} seconds",
        bands={"24h": 24 * clock.HOUR, "7d": 7 * clock.DAY}, columns=["value"], column_types=["double"]), [rule])
    return drained(spark, sf, build, "velocity")


# ---- run table ------------------------------------------------------------------------

def runs(spark, sf):
    return S.table(spark, sf, "orders").selectExpr(
        "o_orderkey AS run_id", "o_custkey % 5 AS experiment_id", "o_orderkey AS run_number", "o_custkey AS trial_id",
        "CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'FINISHED' ELSE 'RUNNING' END AS status",
        "o_orderpriority AS strategy", "IF(o_orderkey % 7 = 0, NULL, o_totalprice) AS auc", "o_orderdate AS started_at",
        "IF(o_orderkey % 3 = 0, 'dry_run', 'full') AS training_origin", "o_custkey % 9 AS dataset_id")


RUNS = """WITH runs AS (SELECT o_orderkey AS run_id, o_custkey % 5 AS experiment_id, o_orderkey AS run_number, o_custkey AS trial_id,
  CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'FINISHED' ELSE 'RUNNING' END AS status, o_orderpriority AS strategy,
  CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS auc, o_orderdate AS started_at,
  CASE WHEN o_orderkey % 3 = 0 THEN 'dry_run' ELSE 'full' END AS training_origin, o_custkey % 9 AS dataset_id FROM orders) """


@query("f23_leaderboard", RUNS + "SELECT run_id, auc FROM runs WHERE auc IS NOT NULL AND training_origin = 'full' ORDER BY auc DESC, run_id LIMIT 10")
def f23(spark, sf):
    return R.leaderboard(runs(spark, sf), "auc", origin="full").select("run_id", "auc")


@query("f23_unscored_runs", RUNS + "SELECT count(*) FILTER (WHERE auc IS NULL) AS n_unscored, count(*) AS n_runs FROM runs WHERE training_origin = 'full'")
def f23u(spark, sf):
    return R.unscored(runs(spark, sf), "auc", "full")


@query("f24_run_comparison", """
WITH m AS (SELECT l_orderkey % 100 AS run_id, l_returnflag || l_linestatus || (l_quantity::INT % 9)::VARCHAR AS metric, sum(l_linenumber)::DOUBLE AS value FROM lineitem GROUP BY 1, 2),
a AS (SELECT metric, value AS a FROM m WHERE run_id = 3), b AS (SELECT metric, value AS b FROM m WHERE run_id = 8)
SELECT metric, a, b, b - a AS delta FROM a FULL JOIN b USING (metric)""")
def f24(spark, sf):
    metrics = S.table(spark, sf, "lineitem").groupBy(
        F.expr("l_orderkey % 100").alias("run_id"),
        F.expr("l_returnflag || l_linestatus || CAST(CAST(l_quantity AS INT) % 9 AS STRING)").alias("metric"),
    ).agg(F.sum("l_linenumber").cast("double").alias("value"))
    return R.compare_runs(metrics, 3, 8)


@query("f25_run_summary", RUNS + """
SELECT experiment_id, count(*) AS n_runs, count(*) FILTER (WHERE status = 'FINISHED') AS n_finished, count(*) FILTER (WHERE status = 'FAILED') AS n_failed,
  max(run_number) + 1 AS next_number, max(auc) AS best_value,
  (SELECT run_id FROM runs r WHERE r.experiment_id = x.experiment_id AND auc IS NOT NULL ORDER BY auc DESC, run_id LIMIT 1) AS best_run_id FROM runs x GROUP BY 1""")
def f25(spark, sf):
    return R.experiment_summary(runs(spark, sf), "auc")


@query("f25_strategy_counts", RUNS + "SELECT strategy, count(*) AS n_runs FROM runs GROUP BY 1")
def f25s(spark, sf):
    return R.strategy_counts(runs(spark, sf))


@query("f25_recent_failures", RUNS + "SELECT run_id, started_at FROM runs WHERE status = 'FAILED' ORDER BY started_at DESC, run_id DESC LIMIT 3")
def f25f(spark, sf):
    return R.recent_failures(runs(spark, sf)).select("run_id", "started_at")


@query("f25_latest_run_per_trial", RUNS + """
SELECT trial_id, run_id, started_at FROM (SELECT *, row_number() OVER (PARTITION BY trial_id ORDER BY started_at DESC, run_id DESC) AS rn FROM runs) WHERE rn = 1""")
def f25l(spark, sf):
    return R.latest_run_per_trial(runs(spark, sf))


@query("f25_dataset_usage", RUNS + "SELECT dataset_id, count(*) AS n_runs, max(started_at) AS last_used FROM runs GROUP BY 1")
def f25d(spark, sf):
    return R.dataset_usage(runs(spark, sf))
