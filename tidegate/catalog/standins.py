"""Views of the supplied tables in the shape the operators expect.

Each view exists twice: as a DataFrame and as a DuckDB CTE, so that every
registered query and its SQL twin start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.functions import clock
from tidegate.functions.hashing import md5_bucket
from tidegate.operators.prefix import POS, Fold, fold_until


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


K = "CAST(get_json_object(props, '$.k') AS BIGINT)"


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


def advances(spark: SparkSession, sf: str) -> DataFrame:
    """Purchases; the account is named, absent or half named by event_id % 3."""
    return events(spark, sf).filter("event_type = 'purchase'").selectExpr(
        "event_id AS advance_id", "user_id", "ts AS feature_as_of_ts", "value AS loan_amount", "value + 2.5D AS total_disbursed",
        f"IF(event_id % 3 <> 0, {K} % 7, NULL) AS adv_routing",
        f"IF(event_id % 3 = 1, {K}, NULL) AS adv_account")


def link_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Account link history: one row per click."""
    return events(spark, sf).filter("event_type = 'click'").selectExpr(
        "user_id", f"{K} % 7 AS routing_number", f"{K} AS account_number", "ts AS link_created_at",
        f"IF(event_id % 4 <> 0, {K} % 50, NULL) AS persistent_account_id",
        "event_id % 11 = 0 AS is_joint", "event_id AS incrementing_id")


def identity_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Identity history: one row per signup, every fifth one deleted."""
    return events(spark, sf).filter("event_type = 'signup'").selectExpr(
        "user_id", "ts AS created_time", "event_id % 5 = 0 AS is_deleted",
        f"' User' || CAST({K} % 20 AS STRING) || IF({K} % 9 = 0, '@example.com ', '@Mail.test ') AS email",
        f"'+1 (' || lpad(CAST({K} % 30 AS STRING), 3, '2') || ') 555-0' || lpad(CAST({K} % 10 AS STRING), 3, '0') AS phone_number",
        f"IF({K} % 13 = 0, 'Please Update', CAST({K} % 25 AS STRING) || ' Main st ') AS street",
        f"lpad(CAST({K} % 4 AS STRING), 5, '0') AS zip_code", "event_id AS identity_seq",
        f"' Annabel' || CAST({K} % 3 AS STRING) AS first_name", f"'annabell' || CAST({K} % 5 AS STRING) AS matched_first_name")


def kyc_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Identity checks: errors."""
    return events(spark, sf).filter("event_type = 'error'").selectExpr(
        "user_id", "ts AS kyc_created_at", "event_id AS kyc_id", f"IF({K} % 2 = 0, 'ACCEPT', 'REJECT') AS kyc_decision")


def user_rows(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).groupBy("user_id").agg(F.min("event_id").alias("e")).selectExpr(
        "user_id", "'c' || CAST(e % 5 AS STRING) AS acquisition_channel", "'10.0.0.' || CAST(user_id % 40 AS STRING) AS signup_ip")


def metadata_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Client metadata history: views; some rows lack a device."""
    return events(spark, sf).filter("event_type = 'view'").selectExpr(
        "user_id", "ts AS valid_from", f"IF(event_id % 10 <> 0, 'd' || CAST({K} AS STRING), NULL) AS device_id",
        f"'10.0.0.' || CAST({K} % 40 AS STRING) AS ip_address")


def outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Labels per advance: an error (default) or purchase (repaid) within a day after it.

    Looking forward is a running minimum on the mirrored time axis, so a busy
    user costs no self-join.
    """
    ev = events(spark, sf).filter("event_type IN ('purchase', 'error')").selectExpr(
        "event_id", "user_id", "event_type", f"{clock.wall_micros('ts')} AS m")
    changes = ev.selectExpr(
        "user_id", f"1 - m AS {POS}", "IF(event_type = 'error', m, NULL) AS next_error",
        "IF(event_type = 'purchase', m, NULL) AS next_purchase")
    bought = ev.filter("event_type = 'purchase'").selectExpr("event_id", "user_id", "m", f"-m AS {POS}")
    ahead = fold_until(changes, bought.select("user_id", POS), ["user_id"],
                       [Fold("next_error", "min"), Fold("next_purchase", "min")])
    last = ev.agg(F.max("m")).first()[0]
    near = "coalesce({} <= m + " + f"{clock.DAY}L, false)"
    return bought.join(ahead, ["user_id", POS], "left").selectExpr(
        "event_id AS advance_id",
        f"CAST({near.format('next_error')} AS INT) AS label_gross_dpd45",
        f"CAST({near.format('next_purchase')} AS INT) AS label_repaid_current_snapshot",
        f"CAST(m <= {last - 3 * clock.DAY}L AS INT) AS label_mature_d45",
        f"IF({near.format('next_error')}, {clock.micros_to_wall('next_error')}, NULL) AS expected_dpd45_date")


ADVANCES_SQL = """
ev AS (SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
advances AS (
  SELECT event_id AS advance_id, user_id, ts AS feature_as_of_ts, value AS loan_amount, value + 2.5::DOUBLE AS total_disbursed,
         CASE WHEN event_id % 3 <> 0 THEN k % 7 END AS adv_routing,
         CASE WHEN event_id % 3 = 1 THEN k END AS adv_account
  FROM ev WHERE event_type = 'purchase')"""

LINK_ROWS_SQL = """
link_rows AS (
  SELECT user_id, k % 7 AS routing_number, k AS account_number, ts AS link_created_at,
         CASE WHEN event_id % 4 <> 0 THEN k % 50 END AS persistent_account_id,
         event_id % 11 = 0 AS is_joint, event_id AS incrementing_id
  FROM ev WHERE event_type = 'click')"""

IDENTITY_ROWS_SQL = """
identity_rows AS (
  SELECT user_id, ts AS created_time, event_id % 5 = 0 AS is_deleted,
         ' User' || (k % 20)::VARCHAR || CASE WHEN k % 9 = 0 THEN '@example.com ' ELSE '@Mail.test ' END AS email,
         '+1 (' || lpad((k % 30)::VARCHAR, 3, '2') || ') 555-0' || lpad((k % 10)::VARCHAR, 3, '0') AS phone_number,
         CASE WHEN k % 13 = 0 THEN 'Please Update' ELSE (k % 25)::VARCHAR || ' Main st ' END AS street,
         lpad((k % 4)::VARCHAR, 5, '0') AS zip_code, event_id AS identity_seq,
         ' Annabel' || (k % 3)::VARCHAR AS first_name, 'annabell' || (k % 5)::VARCHAR AS matched_first_name
  FROM ev WHERE event_type = 'signup')"""

IDENTITIES_SQL = """
identities AS (
  SELECT user_id, created_time AS identity_created_time, is_deleted, email, phone_number, street, zip_code, first_name, matched_first_name
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY is_deleted ASC, created_time DESC, identity_seq DESC) AS rn
        FROM identity_rows) WHERE rn = 1)"""

LINKS_SQL = """
links AS (
  SELECT l.user_id, l.routing_number, l.account_number,
         l.routing_number::VARCHAR || '-' || l.account_number::VARCHAR AS bank_account_key,
         l.link_created_at, l.is_joint, l.pmax AS persistent_account_id, i.identity_created_time, i.first_name, i.matched_first_name
  FROM (SELECT *, max(persistent_account_id) OVER (PARTITION BY user_id, routing_number, account_number) AS pmax,
               row_number() OVER (PARTITION BY user_id, routing_number, account_number ORDER BY incrementing_id DESC) AS rn
        FROM link_rows) l
  JOIN identities i ON l.user_id = i.user_id
  WHERE l.rn = 1)"""

CANDIDATES_SQL = """
candidates AS (
  SELECT a.*, b.bank_account_key, b.routing_number, b.account_number, b.link_created_at, b.is_joint,
         b.persistent_account_id, b.identity_created_time, b.first_name, b.matched_first_name
  FROM advances a JOIN links b ON a.user_id = b.user_id AND b.link_created_at <= a.feature_as_of_ts
   AND ((a.adv_routing = b.routing_number AND a.adv_account = b.account_number)
        OR (a.adv_routing IS NULL AND a.adv_account IS NULL)))"""

METADATA_SQL = """
metadata AS (
  SELECT user_id, ts AS valid_from, CASE WHEN event_id % 10 <> 0 THEN 'd' || k::VARCHAR END AS device_id,
         '10.0.0.' || (k % 40)::VARCHAR AS ip_address
  FROM ev WHERE event_type = 'view')"""

OUTCOMES_SQL = """
outcomes AS (
  SELECT p.event_id AS advance_id,
         CASE WHEN min(CASE WHEN o.event_type = 'error' THEN o.ts END) IS NOT NULL THEN 1 ELSE 0 END AS label_gross_dpd45,
         CASE WHEN min(CASE WHEN o.event_type = 'purchase' THEN o.ts END) IS NOT NULL THEN 1 ELSE 0 END AS label_repaid_current_snapshot,
         CASE WHEN p.ts <= (SELECT max(ts) FROM ev WHERE event_type IN ('purchase', 'error')) - INTERVAL 3 DAY THEN 1 ELSE 0 END AS label_mature_d45,
         min(CASE WHEN o.event_type = 'error' THEN o.ts END) AS expected_dpd45_date
  FROM (SELECT * FROM ev WHERE event_type = 'purchase') p
  LEFT JOIN ev o ON o.user_id = p.user_id AND o.ts > p.ts AND o.ts <= p.ts + INTERVAL 24 HOUR
       AND o.event_type IN ('purchase', 'error')
  GROUP BY p.event_id, p.ts)"""


def ctes(*parts: str) -> str:
    return "WITH " + ",".join(parts)


BASE = (ADVANCES_SQL, LINK_ROWS_SQL, IDENTITY_ROWS_SQL, IDENTITIES_SQL, LINKS_SQL, CANDIDATES_SQL)


def bucket_sql(expr: str, buckets: int = 100) -> str:
    """The md5 bucket as DuckDB SQL."""
    return f"(('0x' || substr(md5(CAST({expr} AS VARCHAR)), 1, 8))::BIGINT % {buckets})"


def bucket(expr: F.Column, buckets: int = 100) -> F.Column:
    return md5_bucket([expr], buckets).cast("long")


# ---- batch star table and scored table over orders ----------------------------

BAND_CASE = "CASE WHEN {b} < 60 THEN 'LOW' WHEN {b} < 80 THEN 'POSSIBLE' WHEN {b} < 95 THEN 'LIKELY' ELSE 'ODD' END"


def _spark_bucket(expr: str, buckets: int) -> str:
    return f"(CAST(conv(substring(md5(CAST({expr} AS STRING)), 1, 8), 16, 10) AS BIGINT) % {buckets})"


def scored_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a scored table: tied scores, bands, outcome and maturity labels."""
    band = BAND_CASE.format(b=_spark_bucket("'band' || CAST(o_orderkey AS STRING)", 100))
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_custkey", "o_totalprice AS loan_amount", "o_orderdate AS feature_as_of_ts", "o_orderpriority",
        "IF(o_orderstatus = 'F', 1, 0) AS is_fraud", f"{_spark_bucket('o_orderkey', 1000)} / 1000.0D AS score",
        f"{band} AS heuristic_fraud_band", "IF(o_orderpriority IN ('1-URGENT', '2-HIGH'), 1, 0) AS label_gross_dpd45",
        "IF(o_orderstatus = 'O', 1, 0) AS label_repaid_current_snapshot",
        "IF(o_orderkey % 10 <> 0, 1, 0) AS label_mature_d45")


SCORED_SQL = f"""
scored AS (
  SELECT o_orderkey, o_custkey, o_totalprice AS loan_amount, o_orderdate AS feature_as_of_ts, o_orderpriority,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_fraud, {bucket_sql('o_orderkey', 1000)} / 1000.0::DOUBLE AS score,
         {BAND_CASE.format(b=bucket_sql("'band' || CAST(o_orderkey AS VARCHAR)", 100))} AS heuristic_fraud_band,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS label_gross_dpd45,
         CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS label_repaid_current_snapshot,
         CASE WHEN o_orderkey % 10 <> 0 THEN 1 ELSE 0 END AS label_mature_d45
  FROM orders)"""
