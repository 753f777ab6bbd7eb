"""Rule, validation and backtest queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.catalog import features as FC
from tidegate.catalog import standins as S
from tidegate.catalog.registry import query
from tidegate.functions import clock
from tidegate.functions.predicates import compare_flag
from tidegate.operators import bands
from tidegate.operators.prefix import asof_features, attach
from tidegate.plans import backtest, rules as R
from tidegate.session import share

# Rules over the order book: repeat buying soon after a previous order.
ORDER_RULES = (
    R.Rule("fast_repeat", "review", "draft", "2026-01-01", "A large order within 30 days of the previous one.",
           ({"column": "prior_orders_30d", "op": ">", "value": 0}, {"column": "loan_amount", "op": ">", "value": 150000}),
           ({"column": "o_orderpriority", "op": "==", "value": "5-LOW"},)),
    R.Rule("busy_quarter", "review", "draft", "2026-01-01", "Several orders within 90 days.",
           ({"column": "prior_orders_90d", "op": ">=", "value": 2},)),
    R.Rule("quick_second", "block", "draft", "2026-01-01", "The second order follows the first within 60 days.",
           ({"hours_between": ["feature_as_of_ts", "first_order_ts"], "op": "<=", "value": 1440},
            {"column": "prior_orders_lifetime", "op": ">", "value": 0})),
)
ORDER_BANDS = {"30d": 30 * clock.DAY, "90d": 90 * clock.DAY}


def order_features(spark, sf):
    """Scored orders with the customer's strictly earlier orders per band."""
    orders = S.scored_orders(spark, sf)
    family = bands.prior_events(orders, "o_custkey", event_ts="feature_as_of_ts", bands=ORDER_BANDS, prefix="prior_orders")
    # Dates years apart: a month-wide bucket keeps the carry table short.
    prior = asof_features(orders, "o_custkey", "feature_as_of_ts", [family], width=30 * clock.DAY).select(
        "o_custkey", "__pos", "prior_orders_30d", "prior_orders_90d", "prior_orders_lifetime")
    first = orders.groupBy("o_custkey").agg(F.min("feature_as_of_ts").alias("first_order_ts"))
    return attach(orders, prior, "o_custkey", "feature_as_of_ts").join(first, "o_custkey")


ORDER_FEATURES_SQL = S.SCORED_SQL + """,
orders_f AS (
  SELECT a.*, f.first_order_ts,
         (SELECT count(*) FROM scored p WHERE p.o_custkey = a.o_custkey AND p.feature_as_of_ts < a.feature_as_of_ts
            AND p.feature_as_of_ts >= a.feature_as_of_ts - INTERVAL 30 DAY) AS prior_orders_30d,
         (SELECT count(*) FROM scored p WHERE p.o_custkey = a.o_custkey AND p.feature_as_of_ts < a.feature_as_of_ts
            AND p.feature_as_of_ts >= a.feature_as_of_ts - INTERVAL 90 DAY) AS prior_orders_90d,
         (SELECT count(*) FROM scored p WHERE p.o_custkey = a.o_custkey AND p.feature_as_of_ts < a.feature_as_of_ts) AS prior_orders_lifetime
  FROM scored a JOIN (SELECT o_custkey, min(feature_as_of_ts) AS first_order_ts FROM scored GROUP BY 1) f USING (o_custkey)),
flagged AS (
  SELECT *, scenario_fast_repeat OR scenario_busy_quarter OR scenario_quick_second AS scenario_any FROM (
    SELECT *, prior_orders_30d > 0 AND loan_amount > 150000 AND NOT o_orderpriority = '5-LOW' AS scenario_fast_repeat,
           prior_orders_90d >= 2 AS scenario_busy_quarter,
           (epoch_us(feature_as_of_ts) - epoch_us(first_order_ts)) / 3.6e9 <= 1440 AND prior_orders_lifetime > 0 AS scenario_quick_second
    FROM orders_f))"""
WITH_FLAGS = S.ctes(ORDER_FEATURES_SQL)
RULE_NAMES = tuple(r.name for r in ORDER_RULES)


@query("e2_rule_conditions", """
SELECT o_orderkey, coalesce(v = 3, false) AS eq, v IS DISTINCT FROM 3 AS ne, coalesce(v < 3, false) AS lt,
       coalesce(v IN (1, 2), false) AS is_in, NOT coalesce(v IN (1, 2), false) AS not_in, v IS NULL AS is_null, v IS NOT NULL AS not_null
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 6 <> 0 THEN o_orderkey % 5 END AS v FROM orders)""")
def e2(spark, sf):
    df = S.table(spark, sf, "orders").selectExpr("o_orderkey", "IF(o_orderkey % 6 <> 0, o_orderkey % 5, NULL) AS v")
    v = F.col("v")
    cases = {"eq": ("==", 3), "ne": ("!=", 3), "lt": ("<", 3), "is_in": ("isin", [1, 2]), "not_in": ("notin", [1, 2]),
             "is_null": ("is_null", None), "not_null": ("not_null", None)}
    return df.select("o_orderkey", *[compare_flag(v, op, arg).alias(n) for n, (op, arg) in cases.items()])


@query("e3_hours_between", S.ctes(S.ADVANCES_SQL, S.IDENTITY_ROWS_SQL, S.IDENTITIES_SQL) + """
SELECT advance_id, (epoch_us(feature_as_of_ts) - epoch_us(identity_created_time)) / 3.6e9 AS hours
FROM advances LEFT JOIN identities USING (user_id)""")
def e3(spark, sf):
    return S.advances(spark, sf).join(FC.identities(spark, sf), "user_id", "left").selectExpr(
        "advance_id", f"{clock.hours_between('feature_as_of_ts', 'identity_created_time')} AS hours")


@query("e4_trigger_and_release", WITH_FLAGS + "SELECT o_orderkey, scenario_fast_repeat AS matched FROM flagged")
def e4(spark, sf):
    return order_features(spark, sf).select("o_orderkey", ORDER_RULES[0].flag().alias("matched"))


@query("e5_rule_flags", WITH_FLAGS + """
SELECT o_orderkey, scenario_fast_repeat, scenario_busy_quarter, scenario_quick_second, scenario_any FROM flagged""")
def e5(spark, sf):
    return R.with_flags(order_features(spark, sf), ORDER_RULES).select(
        "o_orderkey", *[r.flag_name for r in ORDER_RULES], "scenario_any")


@query("e6_residual_gate", WITH_FLAGS + "SELECT o_orderkey, loan_amount FROM flagged WHERE NOT scenario_any")
def e6(spark, sf):
    return R.residual(order_features(spark, sf), ORDER_RULES).select("o_orderkey", "loan_amount")


@query("e8_registered_rules", FC.STAR_SQL + """,
star AS (
  SELECT s.advance_id, s.feature_as_of_ts, s.identity_created_time, s.loan_amount, s.prior_advances_on_bank_account_7d,
         s.users_on_bank_account_72h, p.users_on_persistent_account_id_72h, s.is_joint,
         coalesce(d.users_on_device_id_72h, 0) AS users_on_device_id_72h
  FROM one_per_advance s LEFT JOIN persistent_users p USING (advance_id, bank_account_key) LEFT JOIN device_users d USING (advance_id))
SELECT advance_id, r1 AS scenario_ring_account_reuse, r2 AS scenario_ring_identity_burst,
       r3 AS scenario_ring_shared_persistent_account, r4 AS scenario_ring_device_burst, r1 OR r2 OR r3 OR r4 AS scenario_any
FROM (SELECT advance_id,
    (epoch_us(feature_as_of_ts) - epoch_us(identity_created_time)) / 3.6e9 <= 24 AND loan_amount > 100 AND prior_advances_on_bank_account_7d > 0 AS r1,
    users_on_bank_account_72h >= 3 AS r2, users_on_persistent_account_id_72h >= 2 AND NOT is_joint AS r3, users_on_device_id_72h >= 3 AS r4
  FROM star)""")
def e8(spark, sf):
    from tidegate.plans import features as P
    return R.with_flags(P.build_features(FC.inputs(spark, sf)), R.REGISTERED).select(
        "advance_id", *[r.flag_name for r in R.REGISTERED], "scenario_any")


_BLOCK = """count(*) FILTER (WHERE {w}) AS n, count(*) FILTER (WHERE {w}) / nullif(count(*), 0)::DOUBLE AS share,
  count(*) FILTER (WHERE {w} AND mature) AS n_mature, count(*) FILTER (WHERE {w} AND mature AND never) AS n_never_paid,
  count(*) FILTER (WHERE {w} AND resolved) AS n_resolved,
  count(*) FILTER (WHERE {w} AND mature AND never) / nullif(count(*) FILTER (WHERE {w} AND resolved), 0)::DOUBLE AS never_paid_rate"""
STATS_SQL = ORDER_FEATURES_SQL + """,
s AS (SELECT *, label_mature_d45 = 1 AS mature, label_gross_dpd45 = 1 AS dpd, heuristic_fraud_band AS band,
             label_gross_dpd45 = 1 AND label_repaid_current_snapshot = 0 AS never,
             label_repaid_current_snapshot = 1 OR (label_mature_d45 = 1 AND label_gross_dpd45 = 1) AS resolved,
             scenario_fast_repeat::INT + scenario_busy_quarter::INT + scenario_quick_second::INT AS fired FROM flagged)"""


def order_cube(spark, sf):
    return share(R.outcome_cube(order_features(spark, sf), ORDER_RULES))


@query("e9_outcome_blocks", S.ctes(STATS_SQL) + " UNION ALL ".join(
    f"SELECT '{n}' AS scope, {_BLOCK.format(w=w)} FROM s" for n, w in (
        ("union", "scenario_any"), ("discovery", "scenario_any AND band = 'LOW'"), ("residual", "NOT scenario_any"))))
def e9(spark, sf):
    return R.overall_stats(order_cube(spark, sf))


_BANDS_SQL = """, count(*) FILTER (WHERE {w} AND mature AND dpd) / nullif(count(*) FILTER (WHERE {w} AND mature), 0)::DOUBLE AS dpd45_rate,
  count(*) FILTER (WHERE {w} AND NOT scenario_any) AS n_left, count(*) FILTER (WHERE {w} AND scenario_any) / nullif(count(*) FILTER (WHERE {w}), 0)::DOUBLE AS coverage"""


@query("e10_band_baselines", S.ctes(STATS_SQL) + " UNION ALL ".join(
    f"SELECT '{b}' AS band, {(_BLOCK + _BANDS_SQL).format(w=w)} FROM s" for b, w in (
        ("*", "true"), ("LOW", "band = 'LOW'"), ("POSSIBLE", "band = 'POSSIBLE'"), ("LIKELY", "band = 'LIKELY'"),
        ("ODD", "band = 'ODD'"))))
def e10(spark, sf):
    return R.band_stats(order_cube(spark, sf))


@query("e11_rule_validation", S.ctes(STATS_SQL) + " UNION ALL ".join(
    f"""SELECT '{r}' AS scenario, {_BLOCK.format(w=f'scenario_{r}')},
      count(*) FILTER (WHERE scenario_{r} AND mature AND dpd) AS n_dpd45,
      count(*) FILTER (WHERE scenario_{r} AND mature AND dpd) / nullif(count(*) FILTER (WHERE scenario_{r} AND mature), 0)::DOUBLE AS dpd45_rate,
      (count(*) FILTER (WHERE scenario_{r} AND mature AND never) / nullif(count(*) FILTER (WHERE scenario_{r} AND resolved), 0)::DOUBLE)
        / nullif(count(*) FILTER (WHERE mature AND never) / nullif(count(*) FILTER (WHERE resolved), 0)::DOUBLE, 0) AS lift_vs_base,
      count(*) FILTER (WHERE scenario_{r} AND fired = 1) AS unique_n,
      count(*) FILTER (WHERE scenario_{r} AND fired = 1 AND mature AND never)
        / nullif(count(*) FILTER (WHERE scenario_{r} AND fired = 1 AND resolved), 0)::DOUBLE AS unique_never_paid_rate FROM s"""
    for r in RULE_NAMES))
def e11(spark, sf):
    return R.rule_stats(order_cube(spark, sf), ORDER_RULES)


@query("e11_rule_band_distribution", S.ctes(STATS_SQL) + " UNION ALL ".join(
    f"SELECT '{r}' AS scenario, band, count(*) AS n FROM s WHERE scenario_{r} GROUP BY band" for r in RULE_NAMES))
def e11b(spark, sf):
    return R.rule_bands(order_cube(spark, sf), ORDER_RULES)


@query("e12_rule_overlap", S.ctes(STATS_SQL) + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a} & {b}' AS pair, count(*) AS n FROM s WHERE scenario_{a} AND scenario_{b}"
    for i, a in enumerate(RULE_NAMES) for b in RULE_NAMES[i + 1:]) +
    " UNION ALL SELECT '*', count(*) FROM s WHERE fired > 1) WHERE n > 0")
def e12(spark, sf):
    return R.rule_overlaps(order_cube(spark, sf), ORDER_RULES)


BACKTEST_SQL = S.ctes(*S.BASE, S.OUTCOMES_SQL, """
hist AS (SELECT * FROM candidates WHERE feature_as_of_ts >= TIMESTAMP '2024-01-02' AND feature_as_of_ts < TIMESTAMP '2024-01-28'),
anchor AS (SELECT * FROM hist WHERE feature_as_of_ts >= TIMESTAMP '2024-01-10'),
u AS (SELECT a.advance_id, a.bank_account_key, count(DISTINCT o.user_id) AS users_on_bank_account_72h
      FROM anchor a LEFT JOIN links o ON a.bank_account_key = o.bank_account_key AND o.link_created_at <= a.feature_as_of_ts
       AND o.identity_created_time <= a.feature_as_of_ts AND o.identity_created_time >= a.feature_as_of_ts - INTERVAL 72 HOUR GROUP BY 1, 2),
v AS (SELECT a.advance_id, a.bank_account_key, count(DISTINCT p.advance_id) AS prior_advances_on_bank_account_7d
      FROM anchor a LEFT JOIN hist p ON a.bank_account_key = p.bank_account_key AND p.feature_as_of_ts < a.feature_as_of_ts
       AND p.feature_as_of_ts >= a.feature_as_of_ts - INTERVAL 7 DAY GROUP BY 1, 2),
level AS (SELECT * FROM (
      SELECT a.*, u.users_on_bank_account_72h, v.prior_advances_on_bank_account_7d,
             row_number() OVER (PARTITION BY advance_id ORDER BY users_on_bank_account_72h DESC NULLS LAST,
                prior_advances_on_bank_account_7d DESC NULLS LAST, link_created_at DESC NULLS LAST, bank_account_key DESC) AS rn
      FROM anchor a LEFT JOIN u USING (advance_id, bank_account_key) LEFT JOIN v USING (advance_id, bank_account_key)) WHERE rn = 1)""")


def backtest_level(spark, sf):
    return backtest.backtest_rows(
        S.advances(spark, sf), S.identity_rows(spark, sf), S.link_rows(spark, sf),
        start="2024-01-10", end="2024-01-28", identity_tie="identity_seq")


@query("e14_backtest_rows", BACKTEST_SQL + """
SELECT advance_id, bank_account_key, users_on_bank_account_72h, prior_advances_on_bank_account_7d, identity_created_time FROM level""")
def e14(spark, sf):
    return backtest_level(spark, sf).select(
        "advance_id", "bank_account_key", "users_on_bank_account_72h", "prior_advances_on_bank_account_7d",
        "identity_created_time")


def _report_sql(flag, name, source):
    never = "label_mature_d45 = 1 AND label_gross_dpd45 = 1 AND label_repaid_current_snapshot <> 1"
    resolved = "(label_repaid_current_snapshot = 1 OR (label_mature_d45 = 1 AND label_gross_dpd45 = 1))"
    matured = "label_mature_d45 = 1"
    dpd = "label_mature_d45 = 1 AND label_gross_dpd45 = 1"
    c = lambda w: f"count(*) FILTER (WHERE {w})"
    rate = lambda a, b: f"{c(a)} / nullif({c(b)}, 0)::DOUBLE"
    return f"""SELECT date_trunc('month', feature_as_of_ts)::DATE AS advance_month, '{name}' AS scenario, count(*) AS n_advances,
      {c(flag)} AS n_scenario, {c(flag)} / count(*)::DOUBLE AS scenario_rate, round(sum(loan_amount), 2) AS total_loan_disbursed,
      round(sum(CASE WHEN {flag} THEN loan_amount ELSE 0 END), 2) AS scenario_loan_disbursed,
      {c(f'{flag} AND {matured}')} AS n_matured, {c(f'{flag} AND {dpd}')} AS n_dpd45,
      {rate(f'{flag} AND {dpd}', f'{flag} AND {matured}')} AS dpd45_rate, {rate(dpd, matured)} AS baseline_dpd45_rate,
      {rate(f'{flag} AND {never}', f'{flag} AND {resolved}')} AS scenario_never_paid_rate, {rate(never, resolved)} AS baseline_never_paid_rate,
      round(sum(CASE WHEN {flag} AND {never} THEN loan_amount ELSE 0 END), 2) AS scenario_never_paid_principal,
      round(sum(CASE WHEN {never} THEN loan_amount ELSE 0 END), 2) AS baseline_never_paid_principal
    FROM {source} GROUP BY 1"""


_MONEY = ("total_loan_disbursed", "scenario_loan_disbursed", "scenario_never_paid_principal", "baseline_never_paid_principal")


def rounded(df):
    return df.withColumns({c: F.round(c, 2) for c in _MONEY})


@query("e14_backtest_report", BACKTEST_SQL + """,
joined AS (SELECT * FROM level JOIN outcomes USING (advance_id)),
fl AS (SELECT *, (epoch_us(feature_as_of_ts) - epoch_us(identity_created_time)) / 3.6e9 <= 24 AND loan_amount > 100 AND prior_advances_on_bank_account_7d > 0 AS a,
              users_on_bank_account_72h >= 3 AS b FROM joined)
""" + " UNION ALL ".join(_report_sql(f, n, "fl") for f, n in (
    ("a", "ring_account_reuse"), ("b", "ring_identity_burst"), ("(a OR b)", "scenario_any"))))
def e14r(spark, sf):
    rows = backtest_level(spark, sf).join(S.outcomes(spark, sf), "advance_id")
    return rounded(backtest.monthly_rule_report(rows, R.REGISTERED[:2]))


@query("e15_monthly_rule_report", WITH_FLAGS + " UNION ALL ".join(
    _report_sql(f"scenario_{n}" if n != "scenario_any" else n, n, "flagged") for n in (*RULE_NAMES, "scenario_any")))
def e15(spark, sf):
    return rounded(backtest.monthly_rule_report(order_features(spark, sf), ORDER_RULES))


_E16 = _report_sql("heuristic_fraud_band = b", "x", "scored CROSS JOIN (SELECT unnest(['LOW', 'POSSIBLE', 'LIKELY', 'ODD']) AS b)").replace(
    "'x' AS scenario", "b AS scenario").replace("GROUP BY 1", "GROUP BY 1, 2 HAVING count(*) FILTER (WHERE heuristic_fraud_band = b) > 0")


@query("e16_band_by_month", S.ctes(S.SCORED_SQL) + _E16)
def e16(spark, sf):
    return rounded(backtest.band_by_month(S.scored_orders(spark, sf)))
