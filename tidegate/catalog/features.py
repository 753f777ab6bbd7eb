"""As-of feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.catalog import standins as S
from tidegate.catalog.registry import query
from tidegate.functions import clock, risk, text
from tidegate.operators import bands
from tidegate.operators.latest import account_candidates, latest_rows
from tidegate.operators.prefix import asof_features, attach
from tidegate.plans import features as P
from tidegate.session import share

TS = "feature_as_of_ts"


def inputs(spark, sf):
    return P.Inputs(S.advances(spark, sf), S.identity_rows(spark, sf), S.link_rows(spark, sf),
                    S.metadata_rows(spark, sf), S.kyc_rows(spark, sf), S.user_rows(spark, sf), identity_tie="identity_seq")


def identities(spark, sf):
    return share(P.one_identity_per_user(S.identity_rows(spark, sf), "identity_seq"))


def links(spark, sf):
    return share(P.account_links(S.link_rows(spark, sf), identities(spark, sf)))


def candidates(spark, sf):
    return share(account_candidates(S.advances(spark, sf), links(spark, sf)))


KEYS = ("advance_id", "bank_account_key")


def on_account(spark, sf, families):
    """Candidates with account-keyed feature families attached."""
    c = candidates(spark, sf)
    return attach(c.select(*KEYS, TS), asof_features(c, "bank_account_key", TS, families(c)), "bank_account_key", TS)


@query("d1_history_window", S.ctes(S.ADVANCES_SQL) + """
SELECT advance_id, user_id, feature_as_of_ts, loan_amount FROM advances
WHERE feature_as_of_ts >= TIMESTAMP '2024-01-10 00:00:00' AND feature_as_of_ts < TIMESTAMP '2024-01-20 00:00:00'""")
def d1(spark, sf):
    return S.advances(spark, sf).filter(
        f"{TS} >= timestamp_ntz'2024-01-10 00:00:00' AND {TS} < timestamp_ntz'2024-01-20 00:00:00'"
    ).select("advance_id", "user_id", TS, "loan_amount")


@query("d2_label_projection", """
SELECT o_orderkey AS advance_id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label_gross,
       CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS label_repaid,
       coalesce(CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 2.5 END, 0.0)::DOUBLE AS fee,
       o_totalprice + coalesce(CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 2.5 END, 0.0)::DOUBLE AS total_disbursed
FROM orders""")
def d2(spark, sf):
    return S.table(spark, sf, "orders").selectExpr(
        "o_orderkey AS advance_id", "IF(o_orderstatus = 'F', 1, 0) AS label_gross",
        "IF(o_orderstatus = 'O', 1, 0) AS label_repaid",
        "coalesce(IF(o_orderkey % 4 = 0, NULL, 2.5D), 0D) AS fee",
        "o_totalprice + coalesce(IF(o_orderkey % 4 = 0, NULL, 2.5D), 0D) AS total_disbursed")


@query("d3_latest_identity", S.ctes(S.ADVANCES_SQL, S.IDENTITY_ROWS_SQL, S.IDENTITIES_SQL) + """
SELECT user_id, identity_created_time, is_deleted, email FROM identities""")
def d3(spark, sf):
    return identities(spark, sf).select("user_id", "identity_created_time", "is_deleted", "email")


@query("d4_latest_account_link", S.ctes(*S.BASE) + """
SELECT user_id, bank_account_key, link_created_at, is_joint, persistent_account_id, identity_created_time FROM links""")
def d4(spark, sf):
    return links(spark, sf).select("user_id", "bank_account_key", "link_created_at", "is_joint",
                                   "persistent_account_id", "identity_created_time")


@query("d5_account_candidates", S.ctes(*S.BASE) + """
SELECT advance_id, user_id, feature_as_of_ts, bank_account_key, link_created_at FROM candidates""")
def d5(spark, sf):
    return candidates(spark, sf).select("advance_id", "user_id", TS, "bank_account_key", "link_created_at")


@query("d6_accounts_per_user_asof", S.ctes(*S.BASE) + """
SELECT a.advance_id, count(DISTINCT o.bank_account_key) AS bank_accounts_per_user_asof
FROM candidates a LEFT JOIN links o ON a.user_id = o.user_id AND o.link_created_at <= a.feature_as_of_ts GROUP BY 1""")
def d6(spark, sf):
    owned = bands.owned_links(links(spark, sf), "user_id", link_ts="link_created_at", name="bank_accounts_per_user_asof")
    rows = candidates(spark, sf).select("advance_id", "user_id", TS).distinct()
    return attach(rows, asof_features(rows, "user_id", TS, [owned]), "user_id", TS).select(
        "advance_id", "bank_accounts_per_user_asof")


def _band_sql(stem, bands_, anchor="a.feature_as_of_ts", ident="o.identity_created_time"):
    return ", ".join(
        f"count(DISTINCT CASE WHEN {ident} >= {anchor} - INTERVAL {n} HOUR AND {ident} <= {anchor} "
        f"THEN o.user_id END) AS {stem}_{b}" for b, n in bands_)


ALL_BANDS = (("72h", 72), ("7d", 168), ("30d", 720), ("90d", 2160))

ACCOUNT_USERS_SQL = f"""
account_users AS (
  SELECT a.advance_id, a.bank_account_key, count(DISTINCT o.user_id) AS users_on_bank_account_lifetime_asof,
         {_band_sql('users_on_bank_account', ALL_BANDS)},
         min(o.identity_created_time) AS first_identity_created_on_account_asof,
         max(o.identity_created_time) AS latest_identity_created_on_account_asof,
         date_diff('day', min(o.identity_created_time), max(o.identity_created_time)) AS user_creation_days_span_asof
  FROM candidates a LEFT JOIN links o ON a.bank_account_key = o.bank_account_key
   AND o.link_created_at <= a.feature_as_of_ts AND o.identity_created_time <= a.feature_as_of_ts
  GROUP BY 1, 2)"""


@query("d7_shared_account_user_bands", S.ctes(*S.BASE, ACCOUNT_USERS_SQL) + "SELECT * FROM account_users")
def d7(spark, sf):
    return on_account(spark, sf, lambda c: [bands.shared_users(
        links(spark, sf), "bank_account_key", link_ts="link_created_at", identity_ts="identity_created_time",
        bands=bands.USER_BANDS, prefix="users_on_bank_account", lifetime="users_on_bank_account_lifetime_asof",
        span=True)]).drop(TS)


ACCOUNT_USERS_FINAL_SQL = ACCOUNT_USERS_SQL + """,
account_users_final AS (
  SELECT *, CASE WHEN users_on_bank_account_72h >= 3 THEN 1 ELSE 0 END::BIGINT AS flag_3_users_on_bank_account_72h,
         CASE WHEN users_on_bank_account_lifetime_asof >= 5 THEN 1 ELSE 0 END::BIGINT AS flag_5_users_on_bank_account_ever_asof,
         CASE WHEN users_on_bank_account_lifetime_asof >= 10 THEN 1 ELSE 0 END::BIGINT AS flag_10_users_on_bank_account_ever_asof,
         round(users_on_bank_account_lifetime_asof::DOUBLE / nullif(user_creation_days_span_asof, 0), 4) AS avg_users_created_per_day_asof,
         round(users_on_bank_account_lifetime_asof::DOUBLE / nullif(user_creation_days_span_asof / 30.0::DOUBLE, 0), 2) AS avg_users_created_per_month_asof
  FROM account_users)"""


@query("d8_threshold_flags_and_rates", S.ctes(*S.BASE, ACCOUNT_USERS_FINAL_SQL) + """
SELECT advance_id, bank_account_key, flag_3_users_on_bank_account_72h, flag_5_users_on_bank_account_ever_asof,
       flag_10_users_on_bank_account_ever_asof, avg_users_created_per_day_asof, avg_users_created_per_month_asof
FROM account_users_final""")
def d8(spark, sf):
    return on_account(spark, sf, lambda c: [P.account_users(links(spark, sf))]).select(
        *KEYS, "flag_3_users_on_bank_account_72h", "flag_5_users_on_bank_account_ever_asof",
        "flag_10_users_on_bank_account_ever_asof", "avg_users_created_per_day_asof",
        "avg_users_created_per_month_asof")


_PRIOR = "p.feature_as_of_ts >= a.feature_as_of_ts - INTERVAL {} HOUR"
PRIOR_SQL = """
prior_velocity AS (
  SELECT a.advance_id, a.bank_account_key,
         count(DISTINCT p.advance_id) AS prior_advances_on_bank_account_lifetime,
         """ + ", ".join(
    f"count(DISTINCT CASE WHEN {_PRIOR.format(n)} THEN p.advance_id END) AS prior_advances_on_bank_account_{b}"
    for b, n in (("24h", 24), ("72h", 72), ("7d", 168), ("30d", 720))) + f""",
         sum(CASE WHEN {_PRIOR.format(720)} THEN p.loan_amount::DECIMAL(18,4) ELSE 0 END)::DOUBLE AS prior_loan_amount_sum_30d,
         sum(CASE WHEN {_PRIOR.format(720)} THEN p.loan_amount::DECIMAL(18,4) END)::DOUBLE / nullif(count(CASE WHEN {_PRIOR.format(720)} THEN p.loan_amount END), 0) AS prior_loan_amount_avg_30d,
         sum(CASE WHEN {_PRIOR.format(720)} THEN p.total_disbursed::DECIMAL(18,4) ELSE 0 END)::DOUBLE AS prior_total_disbursed_sum_30d,
         max(p.feature_as_of_ts) AS previous_advance_on_account_ts,
         date_diff('hour', max(p.feature_as_of_ts), a.feature_as_of_ts) AS hours_since_previous_advance_on_account,
         date_diff('day', min(p.feature_as_of_ts), max(p.feature_as_of_ts)) AS prior_advance_days_span,
         round(count(DISTINCT p.advance_id)::DOUBLE / nullif(date_diff('day', min(p.feature_as_of_ts), max(p.feature_as_of_ts)), 0), 4) AS avg_prior_advances_per_day,
         round(count(DISTINCT p.advance_id)::DOUBLE / nullif(date_diff('day', min(p.feature_as_of_ts), max(p.feature_as_of_ts)) / 30.0::DOUBLE, 0), 2) AS avg_prior_advances_per_month
  FROM candidates a LEFT JOIN candidates p ON a.bank_account_key = p.bank_account_key AND p.feature_as_of_ts < a.feature_as_of_ts
  GROUP BY a.advance_id, a.bank_account_key, a.feature_as_of_ts)"""


@query("d9_prior_event_velocity", S.ctes(*S.BASE, PRIOR_SQL) + "SELECT * FROM prior_velocity")
def d9(spark, sf):
    return on_account(spark, sf, lambda c: [bands.prior_events(
        c, "bank_account_key", event_ts=TS,
        amounts={"loan_amount": "loan_amount", "total_disbursed": "total_disbursed"})]).drop(
        TS, "prior_total_disbursed_avg_30d")


GAP_SQL = """
gaps AS (
  SELECT advance_id, bank_account_key, feature_as_of_ts, abs(date_diff('hour', feature_as_of_ts,
         lag(feature_as_of_ts) OVER (PARTITION BY bank_account_key ORDER BY feature_as_of_ts, advance_id))) AS hours_to_prev
  FROM candidates),
min_gap AS (
  SELECT a.advance_id, a.bank_account_key, min(g.hours_to_prev) AS prior_min_hours_between_advances_on_account
  FROM candidates a LEFT JOIN gaps g ON a.bank_account_key = g.bank_account_key
   AND g.feature_as_of_ts <= a.feature_as_of_ts AND g.hours_to_prev IS NOT NULL GROUP BY 1, 2)"""


@query("d10_prior_min_gap", S.ctes(*S.BASE, GAP_SQL) + "SELECT * FROM min_gap")
def d10(spark, sf):
    return on_account(spark, sf, lambda c: [bands.min_gap(c, "bank_account_key", event_ts=TS)]).drop(TS)


SHORT = ALL_BANDS[:3]
PERSISTENT_SQL = f"""
persistent_users AS (
  SELECT a.advance_id, a.bank_account_key, {_band_sql('users_on_persistent_account_id', SHORT)}
  FROM candidates a LEFT JOIN links o ON a.persistent_account_id = o.persistent_account_id
   AND o.link_created_at <= a.feature_as_of_ts AND o.identity_created_time <= a.feature_as_of_ts
  GROUP BY 1, 2)"""


@query("d11_persistent_account_bands", S.ctes(*S.BASE, PERSISTENT_SQL) + "SELECT * FROM persistent_users")
def d11(spark, sf):
    c, stem, key = candidates(spark, sf), "users_on_persistent_account_id", "persistent_account_id"
    family = bands.shared_users(
        P.earliest_per_user(links(spark, sf), key), key, link_ts="link_created_at",
        identity_ts="identity_created_time", bands=bands.SHORT_BANDS, prefix=stem)
    return attach(c.select(*KEYS, key, TS), asof_features(c, key, TS, [family]), key, TS,
                  [f"{stem}_{b}" for b in bands.SHORT_BANDS]).drop(TS, key)


ATTRIBUTES_SQL = """
attributes AS (
  SELECT user_id, identity_created_time,
    CASE WHEN email IS NULL OR trim(email) = '' OR lower(trim(email)) LIKE 'test@%' OR lower(trim(email)) LIKE 'noreply@%'
      OR lower(trim(email)) LIKE 'no-reply@%' OR lower(trim(email)) LIKE '%@example.com' OR lower(trim(email)) LIKE '%@test.com'
      THEN NULL ELSE lower(trim(email)) END AS email_norm,
    CASE WHEN length(regexp_replace(phone_number, '[^0-9]', '', 'g')) < 10 THEN NULL
      WHEN right(regexp_replace(phone_number, '[^0-9]', '', 'g'), 10) IN ('0000000000','1111111111','2222222222','3333333333',
        '4444444444','5555555555','6666666666','7777777777','8888888888','9999999999','1234567890','0123456789') THEN NULL
      ELSE right(regexp_replace(phone_number, '[^0-9]', '', 'g'), 10) END AS phone_norm,
    CASE WHEN street IS NULL OR trim(street) = '' OR zip_code IS NULL OR trim(zip_code) = '' THEN NULL
      WHEN trim(zip_code) IN ('00000', '00003') OR upper(trim(street)) IN ('MAIL RETURN', 'PLEASE UPDATE') THEN NULL
      ELSE upper(trim(street)) || '|' || trim(zip_code) END AS address_key
  FROM identities)"""


@query("d12_identity_normalisers", S.ctes(*S.BASE, ATTRIBUTES_SQL) + "SELECT * FROM attributes")
def d12(spark, sf):
    return P.identity_attributes(identities(spark, sf))


def _sharing_sql(column, stem):
    return f"""
{stem}_f AS (
  SELECT a.advance_id, {_band_sql(stem, SHORT)}
  FROM (SELECT x.advance_id, x.feature_as_of_ts, t.{column} FROM advances x JOIN attributes t ON x.user_id = t.user_id) a
  JOIN attributes o ON a.{column} = o.{column} AND o.identity_created_time <= a.feature_as_of_ts
  WHERE a.{column} IS NOT NULL GROUP BY 1)"""


SHARING_SQL = ",".join(_sharing_sql(c, s) for c, s in (
    ("email_norm", "users_on_email"), ("phone_norm", "users_on_phone"), ("address_key", "users_on_address")))


@query("d13_identity_sharing_counts", S.ctes(*S.BASE, ATTRIBUTES_SQL, SHARING_SQL) + """
SELECT a.advance_id, """ + ", ".join(
    f"coalesce({s}_{b}, 0) AS {s}_{b}" for s in ("users_on_email", "users_on_phone", "users_on_address")
    for b in ("72h", "7d", "30d")) + """
FROM advances a LEFT JOIN users_on_email_f USING (advance_id) LEFT JOIN users_on_phone_f USING (advance_id)
LEFT JOIN users_on_address_f USING (advance_id)""")
def d13(spark, sf):
    anchors = S.advances(spark, sf).select("advance_id", "user_id", TS)
    counts = P.shared_attributes(anchors, P.identity_attributes(identities(spark, sf)))
    return anchors.select("advance_id").join(counts, "advance_id", "left").fillna(0)


DEVICE_LINKS_SQL = S.METADATA_SQL + """,
device_links AS (
  SELECT m.user_id, m.device_id, min(m.valid_from) AS device_valid_from, max(i.identity_created_time) AS identity_created_time
  FROM metadata m JOIN identities i ON m.user_id = i.user_id WHERE m.device_id IS NOT NULL GROUP BY 1, 2)"""


@query("d14_device_history_collapse", S.ctes(*S.BASE, DEVICE_LINKS_SQL) + "SELECT * FROM device_links")
def d14(spark, sf):
    return P.device_links(S.metadata_rows(spark, sf), identities(spark, sf))


ANCHOR_DEVICE_SQL = DEVICE_LINKS_SQL + """,
anchor_device AS (
  SELECT advance_id, user_id, feature_as_of_ts, device_id FROM (
    SELECT a.*, m.device_id, row_number() OVER (PARTITION BY a.advance_id ORDER BY m.valid_from DESC NULLS LAST, m.device_id DESC NULLS LAST) AS rn
    FROM advances a LEFT JOIN metadata m ON a.user_id = m.user_id AND m.valid_from <= a.feature_as_of_ts AND m.device_id IS NOT NULL)
  WHERE rn = 1)"""


@query("d15_latest_asof_join", S.ctes(*S.BASE, S.METADATA_SQL) + """
SELECT advance_id, valid_from, device_id, ip_address FROM (
  SELECT a.advance_id, m.valid_from, m.device_id, m.ip_address, row_number() OVER (PARTITION BY a.advance_id
    ORDER BY m.valid_from DESC NULLS LAST, m.device_id DESC NULLS LAST, m.ip_address DESC NULLS LAST) AS rn
  FROM advances a LEFT JOIN metadata m ON a.user_id = m.user_id AND m.valid_from <= a.feature_as_of_ts) WHERE rn = 1""")
def d15(spark, sf):
    a = S.advances(spark, sf).select("advance_id", "user_id", TS)
    latest = latest_rows(S.metadata_rows(spark, sf), "user_id", history_ts="valid_from", ties=["device_id", "ip_address"])
    return attach(a, asof_features(a, "user_id", TS, [latest]), "user_id", TS).select(
        "advance_id", "valid_from", "device_id", "ip_address")


DEVICE_USERS_SQL = ANCHOR_DEVICE_SQL + f""",
device_users AS (
  SELECT a.advance_id, {_band_sql('users_on_device_id', SHORT)}
  FROM anchor_device a JOIN device_links o ON a.device_id = o.device_id AND o.device_valid_from <= a.feature_as_of_ts
   AND o.identity_created_time <= a.feature_as_of_ts WHERE a.device_id IS NOT NULL GROUP BY 1)"""


@query("d16_device_sharing_counts", S.ctes(*S.BASE, DEVICE_USERS_SQL) + """
SELECT advance_id, device_id, coalesce(users_on_device_id_72h, 0) AS users_on_device_id_72h,
       coalesce(users_on_device_id_7d, 0) AS users_on_device_id_7d, coalesce(users_on_device_id_30d, 0) AS users_on_device_id_30d
FROM anchor_device LEFT JOIN device_users USING (advance_id)""")
def d16(spark, sf):
    a = S.advances(spark, sf).select("advance_id", "user_id", TS)
    metadata = S.metadata_rows(spark, sf)
    on = share(attach(a, asof_features(a, "user_id", TS, [P.known_device(metadata)]), "user_id", TS))
    family = bands.shared_users(
        P.device_links(metadata, identities(spark, sf)), "device_id", link_ts="device_valid_from",
        identity_ts="identity_created_time", bands=bands.SHORT_BANDS, prefix="users_on_device_id")
    return attach(on, asof_features(on, "device_id", TS, [family]), "device_id", TS,
                  [f"users_on_device_id_{b}" for b in bands.SHORT_BANDS]).drop("user_id", TS)


_LETTER = "chr((65 + floor(h / {}) % 26)::INTEGER)"
NETWORK_SQL = """
owned AS (
  SELECT a.advance_id, count(DISTINCT o.bank_account_key) AS bank_accounts_per_user_asof
  FROM candidates a LEFT JOIN links o ON a.user_id = o.user_id AND o.link_created_at <= a.feature_as_of_ts GROUP BY 1),
network AS (
  SELECT advance_id, bank_account_key, network_score_asof,
         CASE WHEN network_score_asof >= 15 THEN """ + " || ".join(_LETTER.format(26**i) for i in range(3)) + """ ELSE 'QQQ' END AS network_label
  FROM (SELECT a.advance_id, a.bank_account_key,
               coalesce(b.users_on_bank_account_lifetime_asof, 0) * greatest(coalesce(o.bank_accounts_per_user_asof, 0), 1) AS network_score_asof,
               ('0x' || substr(md5(a.bank_account_key), 1, 8))::BIGINT AS h
        FROM candidates a LEFT JOIN account_users_final b USING (advance_id, bank_account_key) LEFT JOIN owned o USING (advance_id)))"""


@query("d17_network_score_label", S.ctes(*S.BASE, ACCOUNT_USERS_FINAL_SQL, NETWORK_SQL) + "SELECT * FROM network")
def d17(spark, sf):
    t = _with_network(spark, sf, lambda c: [P.account_users(links(spark, sf))])
    return t.select(*KEYS, "network_score_asof",
                    risk.network_label(F.col("network_score_asof"), F.col("bank_account_key")).alias("network_label"))


def _with_network(spark, sf, families):
    c = candidates(spark, sf)
    owned = asof_features(c, "user_id", TS, [bands.owned_links(
        links(spark, sf), "user_id", link_ts="link_created_at", name="n_accounts")])
    t = attach(c.select(*KEYS, "user_id", TS), asof_features(c, "bank_account_key", TS, families(c)),
               "bank_account_key", TS)
    t = attach(t, owned, "user_id", TS)
    return t.withColumn("network_score_asof", risk.network_score(
        F.col("users_on_bank_account_lifetime_asof"), F.col("n_accounts")))


@query("d19_date_parts_and_boundaries", S.ctes(S.ADVANCES_SQL, S.IDENTITY_ROWS_SQL, S.IDENTITIES_SQL) + """
SELECT a.advance_id, date_part('hour', a.feature_as_of_ts) AS origination_hour,
       isodow(a.feature_as_of_ts) AS origination_day_of_week,
       CASE WHEN isodow(a.feature_as_of_ts) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend,
       date_diff('day', i.identity_created_time, a.feature_as_of_ts) AS days_since_identity_created,
       date_diff('hour', i.identity_created_time, a.feature_as_of_ts) AS hours_since_identity_created
FROM advances a JOIN identities i USING (user_id)""")
def d19(spark, sf):
    born = "identity_created_time"
    return S.advances(spark, sf).join(identities(spark, sf), "user_id").selectExpr(
        "advance_id", f"CAST(hour({TS}) AS BIGINT) AS origination_hour",
        f"{clock.iso_weekday(TS)} AS origination_day_of_week",
        f"CAST({clock.iso_weekday(TS)} >= 6 AS INT) AS is_weekend",
        f"{clock.day_boundaries(born, TS)} AS days_since_identity_created",
        f"{clock.hour_boundaries(born, TS)} AS hours_since_identity_created")


@query("d20_name_similarity", """
SELECT c_custkey, round(jaro_winkler_similarity(upper(trim(c_name)), upper(trim(' ' || c_mktsegment || (c_custkey % 97)::VARCHAR))) * 100, 6) AS name_match_segment,
       round(jaro_winkler_similarity(upper(trim(c_name)), upper(trim('customer#0000' || (c_custkey % 1009)::VARCHAR))) * 100, 6) AS name_match_name
FROM customer""")
def d20(spark, sf):
    key = F.col("c_custkey")
    segment = F.concat(F.lit(" "), F.col("c_mktsegment"), (key % 97).cast("string"))
    name = F.concat(F.lit("customer#0000"), (key % 1009).cast("string"))
    return S.table(spark, sf, "customer").select(
        "c_custkey", F.round(text.name_similarity(F.col("c_name"), segment), 6).alias("name_match_segment"),
        F.round(text.name_similarity(F.col("c_name"), name), 6).alias("name_match_name"))


@query("d21_node_keys", S.ctes(*S.BASE, ATTRIBUTES_SQL) + """
SELECT user_id, sha256(email_norm) AS email_key, sha256(phone_norm) AS phone_key, sha256(address_key) AS address_key FROM attributes""")
def d21(spark, sf):
    a = P.identity_attributes(identities(spark, sf))
    return a.select("user_id", text.node_key(F.col("email_norm")).alias("email_key"),
                    text.node_key(F.col("phone_norm")).alias("phone_key"),
                    text.node_key(F.col("address_key")).alias("address_key"))


SCORE_SQL = """
scored AS (
  SELECT c.*, p.prior_total_disbursed_sum_30d, b.users_on_bank_account_lifetime_asof, b.users_on_bank_account_72h, p.prior_advances_on_bank_account_30d,
         p.prior_advances_on_bank_account_7d, p.prior_advances_on_bank_account_lifetime, n.network_score_asof, n.network_label,
         date_diff('day', c.link_created_at, c.feature_as_of_ts) AS days_since_link_created,
         least(100,
           CASE WHEN coalesce(users_on_bank_account_72h, 0) >= 4 THEN 25 WHEN coalesce(users_on_bank_account_72h, 0) >= 3 THEN 15 ELSE 0 END
         + CASE WHEN coalesce(users_on_bank_account_lifetime_asof, 0) >= 10 THEN 25 WHEN coalesce(users_on_bank_account_lifetime_asof, 0) >= 5 THEN 15
                WHEN coalesce(users_on_bank_account_lifetime_asof, 0) >= 3 THEN 5 ELSE 0 END
         + CASE WHEN coalesce(avg_users_created_per_month_asof, 0) >= 10 THEN 15 WHEN coalesce(avg_users_created_per_month_asof, 0) >= 3 THEN 8 ELSE 0 END
         + CASE WHEN coalesce(prior_advances_on_bank_account_72h, 0) >= 2 THEN 20 WHEN coalesce(prior_advances_on_bank_account_7d, 0) >= 2 THEN 10 ELSE 0 END
         + CASE WHEN coalesce(network_score_asof, 0) >= 15 THEN 15 ELSE 0 END)::BIGINT AS heuristic_fraud_score
  FROM candidates c JOIN account_users_final b USING (advance_id, bank_account_key)
  JOIN prior_velocity p USING (advance_id, bank_account_key) JOIN network n USING (advance_id, bank_account_key)),
banded AS (
  SELECT *, CASE WHEN heuristic_fraud_score <= 15 THEN 'LOW' WHEN heuristic_fraud_score <= 35 THEN 'POSSIBLE'
                 WHEN heuristic_fraud_score <= 60 THEN 'LIKELY' ELSE 'EXTREMELY_LIKELY' END AS heuristic_fraud_band FROM scored),
one_per_advance AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY advance_id ORDER BY users_on_bank_account_lifetime_asof DESC NULLS LAST,
      users_on_bank_account_72h DESC NULLS LAST, prior_advances_on_bank_account_30d DESC NULLS LAST, heuristic_fraud_score DESC NULLS LAST,
      days_since_link_created ASC NULLS LAST, link_created_at DESC NULLS LAST, bank_account_key DESC) AS rn FROM banded) WHERE rn = 1)"""

FEATURE_CTES = (*S.BASE, ACCOUNT_USERS_FINAL_SQL, PRIOR_SQL, NETWORK_SQL, SCORE_SQL)


@query("d22_heuristic_score_band", S.ctes(*FEATURE_CTES) + """
SELECT advance_id, bank_account_key, heuristic_fraud_score, heuristic_fraud_band FROM banded""")
def d22(spark, sf):
    t = _with_network(spark, sf, lambda c: [
        P.account_users(links(spark, sf)), bands.prior_events(c, "bank_account_key", event_ts=TS)])
    score = risk.heuristic_score(
        F.col("users_on_bank_account_72h"), F.col("users_on_bank_account_lifetime_asof"),
        F.col("avg_users_created_per_month_asof"), F.col("prior_advances_on_bank_account_72h"),
        F.col("prior_advances_on_bank_account_7d"), F.col("network_score_asof"))
    return t.select(*KEYS, score.alias("heuristic_fraud_score"), risk.score_band(score).alias("heuristic_fraud_band"))


@query("d23_presence_and_match_flags", S.ctes(*S.BASE, S.METADATA_SQL) + """
SELECT m.user_id, m.valid_from, CASE WHEN device_id IS NOT NULL THEN 1 ELSE 0 END AS has_device_id,
       CASE WHEN device_id IS NOT NULL AND device_id = 'd' || substr(ip_address, 8) THEN 1 ELSE 0 END AS device_matches_ip
FROM metadata m""")
def d23(spark, sf):
    return S.metadata_rows(spark, sf).selectExpr(
        "user_id", "valid_from", "CAST(device_id IS NOT NULL AS INT) AS has_device_id",
        "CAST(coalesce(device_id = 'd' || substr(ip_address, 8), false) AS INT) AS device_matches_ip")


STAR_COLUMNS = (
    "advance_id", "user_id", TS, "bank_account_key", "loan_amount", "bank_accounts_per_user_asof",
    "users_on_bank_account_lifetime_asof", "users_on_bank_account_72h", "users_on_persistent_account_id_72h",
    "users_on_email_72h", "users_on_phone_7d", "users_on_address_30d", "users_on_device_id_72h",
    "prior_advances_on_bank_account_7d", "prior_advances_on_bank_account_lifetime",
    "prior_min_hours_between_advances_on_account", "network_score_asof", "network_label", "heuristic_fraud_score",
    "heuristic_fraud_band", "device_id", "ip_address", "days_since_link_created", "total_disbursed",
    "prior_total_disbursed_sum_30d", "kyc_id", "kyc_decision", "has_kyc", "hours_since_kyc_created", "acquisition_channel",
    "signup_ip_matches_latest_ip", "name_match_first", "days_between_identity_and_link_creation", "origination_hour", "is_joint",
)

STAR_SQL = S.ctes(*FEATURE_CTES, GAP_SQL, PERSISTENT_SQL, ATTRIBUTES_SQL, SHARING_SQL, DEVICE_USERS_SQL, """
latest_meta AS (
  SELECT * FROM (SELECT a.advance_id, m.device_id, m.ip_address, row_number() OVER (PARTITION BY a.advance_id
    ORDER BY m.valid_from DESC NULLS LAST, m.device_id DESC NULLS LAST, m.ip_address DESC NULLS LAST) AS rn
  FROM advances a LEFT JOIN metadata m ON a.user_id = m.user_id AND m.valid_from <= a.feature_as_of_ts) WHERE rn = 1)""", """
latest_kyc AS (
  SELECT * FROM (SELECT a.advance_id, e.event_id AS kyc_id, e.ts AS kyc_created_at, CASE WHEN e.k % 2 = 0 THEN 'ACCEPT' WHEN e.k IS NOT NULL THEN 'REJECT' END AS kyc_decision,
    row_number() OVER (PARTITION BY a.advance_id ORDER BY e.ts DESC NULLS LAST, e.event_id DESC NULLS LAST) AS rn
  FROM advances a LEFT JOIN (SELECT * FROM ev WHERE event_type = 'error') e ON a.user_id = e.user_id AND e.ts <= a.feature_as_of_ts) WHERE rn = 1),
user_dims AS (SELECT user_id, 'c' || (min(event_id) % 5)::VARCHAR AS acquisition_channel, '10.0.0.' || (user_id % 40)::VARCHAR AS signup_ip FROM ev GROUP BY 1)""")


@query("d18_star_assembly", STAR_SQL + """
SELECT s.advance_id, s.user_id, s.feature_as_of_ts, s.bank_account_key, s.loan_amount, o.bank_accounts_per_user_asof,
       s.users_on_bank_account_lifetime_asof, s.users_on_bank_account_72h, p.users_on_persistent_account_id_72h,
       coalesce(e.users_on_email_72h, 0) AS users_on_email_72h, coalesce(f.users_on_phone_7d, 0) AS users_on_phone_7d,
       coalesce(g.users_on_address_30d, 0) AS users_on_address_30d, coalesce(d.users_on_device_id_72h, 0) AS users_on_device_id_72h,
       s.prior_advances_on_bank_account_7d, s.prior_advances_on_bank_account_lifetime,
       m.prior_min_hours_between_advances_on_account, s.network_score_asof, s.network_label, s.heuristic_fraud_score,
       s.heuristic_fraud_band, l.device_id, l.ip_address, s.days_since_link_created, s.total_disbursed, s.prior_total_disbursed_sum_30d,
       q.kyc_id, q.kyc_decision, CASE WHEN q.kyc_id IS NOT NULL THEN 1 ELSE 0 END::BIGINT AS has_kyc,
       date_diff('hour', q.kyc_created_at, s.feature_as_of_ts) AS hours_since_kyc_created, y.acquisition_channel,
       CASE WHEN y.signup_ip = l.ip_address THEN 1 ELSE 0 END::BIGINT AS signup_ip_matches_latest_ip,
       round(jaro_winkler_similarity(upper(trim(s.first_name)), upper(trim(s.matched_first_name))) * 100, 6) AS name_match_first,
       date_diff('day', s.identity_created_time, s.link_created_at) AS days_between_identity_and_link_creation,
       date_part('hour', s.feature_as_of_ts) AS origination_hour, s.is_joint::BIGINT AS is_joint
FROM one_per_advance s LEFT JOIN owned o USING (advance_id) LEFT JOIN persistent_users p USING (advance_id, bank_account_key)
LEFT JOIN min_gap m USING (advance_id, bank_account_key) LEFT JOIN users_on_email_f e USING (advance_id)
LEFT JOIN users_on_phone_f f USING (advance_id) LEFT JOIN users_on_address_f g USING (advance_id)
LEFT JOIN device_users d USING (advance_id) LEFT JOIN latest_meta l USING (advance_id)
LEFT JOIN latest_kyc q USING (advance_id) LEFT JOIN user_dims y USING (user_id)""")
def d18(spark, sf):
    return P.build_features(inputs(spark, sf)).select(*STAR_COLUMNS).withColumn(
        "name_match_first", F.round("name_match_first", 6))


@query("d24_one_row_per_advance", S.ctes(*FEATURE_CTES) + """
SELECT advance_id, bank_account_key, users_on_bank_account_lifetime_asof, heuristic_fraud_score FROM one_per_advance""")
def d24(spark, sf):
    return P.build_features(inputs(spark, sf)).select(
        "advance_id", "bank_account_key", "users_on_bank_account_lifetime_asof", "heuristic_fraud_score")


@query("d25_fan_out_screen", S.ctes(*S.BASE, ATTRIBUTES_SQL, S.METADATA_SQL) + """,
shared AS (SELECT user_id, 'email' AS kind, email_norm AS value FROM attributes UNION ALL SELECT user_id, 'phone', phone_norm FROM attributes
           UNION ALL SELECT user_id, 'address', address_key FROM attributes UNION ALL SELECT user_id, 'device', device_id::VARCHAR FROM metadata),
counted AS (SELECT kind, value, count(DISTINCT user_id) AS n_users FROM shared WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT kind, value, n_users FROM counted QUALIFY row_number() OVER (PARTITION BY kind ORDER BY n_users DESC, value) <= 100""")
def d25(spark, sf):
    return P.fan_out_screen(P.identity_attributes(identities(spark, sf)), S.metadata_rows(spark, sf))
