"""Entity-graph queries over orders and line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.catalog import standins as S
from tidegate.catalog.registry import query
from tidegate.graph import components as C, queues as Q, replay, store as G, traverse as T
from tidegate.plans.rules import Rule
from tidegate.session import scratch_folder, share

CAP = 20
BIG = (Rule("big_loan", "review", "draft", "2026-01-01", "A large order.", ({"column": "loan_amount", "op": ">", "value": 440000},)),)


# Fine keys share an entity between a few users, so that components stay small; coarse keys make hubs.
KEYS = {"fine": ("l_partkey {0} '-' {0} {1}", "l_partkey {0} '-' {0} l_suppkey {0} '-' {0} {2}"),
        "coarse": ("l_suppkey {0} '-' {0} {1}", "l_partkey {0} '-' {0} {2}")}


def advances(spark, sf, keys="fine"):
    """Every order line as an advance with a device and a bank account."""
    dev, bank = (k.format("||", "date_format(l_shipdate, 'yyyyMMdd')", "date_format(l_shipdate, 'yyyyMM')") for k in KEYS[keys])
    # Names are made after the join: the numbers they consist of are half as large in its shuffle.
    return S.table(spark, sf, "lineitem").join(S.table(spark, sf, "orders"), F.expr("l_orderkey = o_orderkey")).selectExpr(
        "o_orderkey AS advance_id", "o_custkey AS user_id", "o_orderdate AS feature_as_of_ts", "o_totalprice AS loan_amount",
        f"IF(l_linenumber = 7, ' None', {dev}) AS device_id", f"{bank} AS bank_account_key", "IF(o_custkey % 13 = 0, 1, 0) AS is_fraud", "IF(o_orderkey % 5 = 0, 1, 0) AS label_gross_dpd45",
        "IF(o_orderkey % 10 <> 0, 1, 0) AS label_mature_d45",
        "IF(o_orderkey % 5 = 0, o_orderdate + INTERVAL 10 DAYS, NULL) AS expected_dpd45_date")


def _sql(keys):
    dev, bank = (k.format("||", "strftime(l_shipdate, '%Y%m%d')", "strftime(l_shipdate, '%Y%m')") for k in KEYS[keys])
    return f"""WITH RECURSIVE
adv AS (SELECT o_orderkey AS advance_id, o_custkey AS user_id, o_orderdate AS feature_as_of_ts, o_totalprice AS loan_amount,
  CASE WHEN l_linenumber = 7 THEN ' None' ELSE {dev} END AS device_id, {bank} AS bank_account_key,
  CASE WHEN o_custkey % 13 = 0 THEN 1 ELSE 0 END AS is_fraud, CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS label_gross_dpd45,
  CASE WHEN o_orderkey % 10 <> 0 THEN 1 ELSE 0 END AS label_mature_d45
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
cells AS (SELECT advance_id, user_id, 'device' AS entity_type, device_id AS entity_value, feature_as_of_ts AS ts FROM adv WHERE device_id IS NOT NULL
          UNION ALL SELECT advance_id, user_id, 'bank', bank_account_key, feature_as_of_ts FROM adv WHERE bank_account_key IS NOT NULL),
edges AS (SELECT DISTINCT * FROM cells WHERE lower(trim(entity_value)) NOT IN ('', 'none', 'nan', 'null', 'nat', '0', '0-0', 'none-none')),
flags AS (SELECT user_id, max(is_fraud) AS is_fraud, max(loan_amount > 440000) AS scenario_any FROM adv GROUP BY 1),
deg AS (SELECT entity_type, entity_value, count(DISTINCT user_id) AS n FROM edges GROUP BY 1, 2),
capped AS (SELECT e.* FROM edges e JOIN deg USING (entity_type, entity_value) WHERE n <= {CAP})"""


BASE, COARSE = _sql("fine"), _sql("coarse")


def edges(spark, sf, keys="fine"):
    return share(G.build_edges(advances(spark, sf, keys)))


def rows(spark, sf, keys="fine"):
    """The edges before they are made distinct, for queries that only ask who shares what."""
    return G.edge_rows(advances(spark, sf, keys))


def flags(spark, sf):
    return share(G.user_attributes(advances(spark, sf), ("is_fraud",), BIG))


def users(spark, sf):
    return advances(spark, sf).select("user_id").distinct()


@query("h1_edge_extraction", BASE + "SELECT * FROM edges")
def h1(spark, sf):
    return edges(spark, sf)


@query("h2_users_table", BASE + """
SELECT user_id, count(DISTINCT advance_id) AS n_advances, min(feature_as_of_ts) AS first_seen_ts, max(feature_as_of_ts) AS last_seen_ts FROM adv GROUP BY 1""")
def h2(spark, sf):
    return G.build_users(advances(spark, sf))


@query("h3_entities_table", BASE + """
SELECT entity_type, entity_value, count(DISTINCT user_id) AS n_users, count(DISTINCT advance_id) AS n_advances,
       min(ts) AS first_seen_ts, max(ts) AS last_seen_ts FROM edges GROUP BY 1, 2""")
def h3(spark, sf):
    return G.build_entities(rows(spark, sf))


@query("h4_build_counts", BASE + """
SELECT c.entity_type, (SELECT count(*) FROM edges e WHERE e.entity_type = c.entity_type) AS edges,
       count(*) FILTER (WHERE lower(trim(entity_value)) IN ('', 'none', 'nan', 'null', 'nat', '0', '0-0', 'none-none')) AS screened
FROM cells c GROUP BY 1""")
def h4(spark, sf):
    return G.build_counts(advances(spark, sf))


@query("a13_graph_store_sink", BASE + "SELECT * FROM edges")
def a13(spark, sf):
    return G.build_store(advances(spark, sf), scratch_folder(spark, "store")).edges


@query("h5_filtered_view", BASE + """
SELECT * FROM edges WHERE entity_type = 'device' AND ts >= TIMESTAMP '1996-01-01' AND ts <= TIMESTAMP '1996-12-31'""")
def h5(spark, sf):
    return G.view(edges(spark, sf), layers=("device",), window=("1996-01-01 00:00:00", "1996-12-31 00:00:00"))


@query("h6_degree_cap", BASE + "SELECT e.* FROM edges e JOIN deg USING (entity_type, entity_value) WHERE n <= 3")
def h6(spark, sf):
    return G.view(edges(spark, sf), degree_cap=3)


@query("h7_user_attributes", BASE + "SELECT user_id, is_fraud, scenario_any AS scenario_big_loan, scenario_any FROM flags")
def h7(spark, sf):
    return G.user_attributes(advances(spark, sf), ("is_fraud",), BIG)


_NEAR = """,
p{f} AS (SELECT DISTINCT user_id, entity_type || ':' || entity_value AS e FROM {src}),
s{f} AS (SELECT user_id FROM flags WHERE {flag}),
a{f} AS (SELECT b.user_id, min(x.user_id::VARCHAR) AS seed FROM s{f} x JOIN p{f} a ON a.user_id = x.user_id JOIN p{f} b ON a.e = b.e
         WHERE b.user_id NOT IN (SELECT user_id FROM s{f}) GROUP BY 1),
b{f} AS (SELECT b.user_id, min(x.seed) AS seed FROM a{f} x JOIN p{f} a ON a.user_id = x.user_id JOIN p{f} b ON a.e = b.e
         WHERE b.user_id NOT IN (SELECT user_id FROM s{f}) AND b.user_id NOT IN (SELECT user_id FROM a{f}) GROUP BY 1),
near{f} AS (SELECT user_id::VARCHAR AS user_id, 1 AS hops, seed AS nearest_flagged FROM a{f} UNION ALL SELECT user_id::VARCHAR, 2, seed FROM b{f})"""


@query("h8_near_flagged", BASE + _NEAR.format(f=1, flag="is_fraud = 1", src="edges") + "SELECT * FROM near1")
def h8(spark, sf):
    return T.near_flagged(rows(spark, sf), flags(spark, sf).filter("is_fraud = 1"), 2)


def _comp_sql(src):
    return f""",
pairs AS (SELECT DISTINCT 'user:' || user_id::VARCHAR AS u, entity_type || ':' || entity_value AS e, entity_type FROM {src}),
met AS (SELECT DISTINCT a.u AS a, b.u AS b FROM pairs a JOIN pairs b ON a.e = b.e WHERE a.u <> b.u),
walk(u, c) AS (SELECT DISTINCT 'user:' || user_id::VARCHAR AS u, 'user:' || user_id::VARCHAR AS c FROM adv
               UNION SELECT m.b, w.c FROM walk w JOIN met m ON w.u = m.a),
root AS (SELECT u, min(c) AS r FROM walk GROUP BY 1),
member AS (SELECT u AS v, 'user' AS kind, r FROM root UNION ALL SELECT DISTINCT e, entity_type, r FROM pairs JOIN root USING (u)),
named AS (SELECT r, min(v) AS comp_id FROM member GROUP BY 1),
comp AS MATERIALIZED (SELECT v, kind, comp_id FROM member JOIN named USING (r)),
fl AS (SELECT 'user:' || user_id::VARCHAR AS v, is_fraud, scenario_any::INT AS scen FROM flags),
cc AS (SELECT comp_id, count(*) FILTER (WHERE kind = 'user') AS n_users, count(*) FILTER (WHERE kind <> 'user') AS n_entities,
  coalesce(string_agg(DISTINCT kind, ',' ORDER BY kind) FILTER (WHERE kind <> 'user'), '') AS entity_types,
  count(DISTINCT kind) FILTER (WHERE kind <> 'user') AS n_types, coalesce(sum(is_fraud), 0)::BIGINT AS n_flagged
  FROM comp LEFT JOIN fl USING (v) GROUP BY 1)"""


@query("h9_component_census", BASE + _comp_sql("edges") + "SELECT * FROM cc")
def h9(spark, sf):
    f = flags(spark, sf)  # has every user
    return C.user_census(rows(spark, sf), f, f, "is_fraud")[1]


@query("h10_ego_ring", BASE + """,
hot AS (SELECT user_id FROM edges GROUP BY 1 ORDER BY count(*) DESC, user_id LIMIT 1),
e1 AS (SELECT DISTINCT entity_type, entity_value FROM edges WHERE user_id IN (SELECT user_id FROM hot)),
u1 AS (SELECT DISTINCT user_id FROM edges JOIN e1 USING (entity_type, entity_value)),
e2 AS (SELECT DISTINCT entity_type, entity_value FROM edges WHERE user_id IN (SELECT user_id FROM u1))
SELECT edges.* FROM edges JOIN e2 USING (entity_type, entity_value)""")
def h10(spark, sf):
    e = edges(spark, sf)
    hot = e.groupBy("user_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "user_id").first()
    return T.ring(e, str(hot.user_id), 2)


_PROJ = """,
up AS (SELECT DISTINCT user_id, entity_type, entity_value FROM capped),
proj AS (SELECT a.user_id AS user_a, b.user_id AS user_b, count(*) AS n_shared, count(DISTINCT a.entity_type) AS n_types
  FROM up a JOIN up b USING (entity_type, entity_value) WHERE a.user_id < b.user_id GROUP BY 1, 2)"""


@query("h11_user_projection", BASE + _PROJ + "SELECT * FROM proj")
def h11(spark, sf):
    return T.project_users(rows(spark, sf), degree_cap=CAP)


_PROJ_ALL = _PROJ.replace("FROM capped", "FROM edges")


@query("h11_user_projection_uncapped", COARSE + _PROJ_ALL + "SELECT * FROM proj")
def h11_all(spark, sf):
    return T.project_users(rows(spark, sf, "coarse"), degree_cap=None)


_HUBS = """,
stats AS (SELECT entity_type, entity_value, count(DISTINCT user_id) AS n_users, count(*) AS n_edges, date_diff('day', min(ts), max(ts)) AS span_days,
  round(count(DISTINCT user_id) / greatest(date_diff('day', min(ts), max(ts)), 1)::DOUBLE, 3) AS users_per_day FROM edges GROUP BY 1, 2)"""


@query("h12_hub_report", COARSE + _HUBS + """
SELECT s.*, round(avg(f.is_fraud), 3) AS fraud_user_rate FROM (SELECT * FROM stats ORDER BY n_users DESC, entity_value, entity_type LIMIT 20) s
JOIN (SELECT DISTINCT user_id, entity_type, entity_value FROM edges) p USING (entity_type, entity_value) JOIN flags f USING (user_id)
GROUP BY ALL""")
def h12(spark, sf):
    return T.hub_report(edges(spark, sf, "coarse"), advances(spark, sf, "coarse"))


@query("h13_residual_ring_members", BASE + _comp_sql("edges") + """
SELECT substr(v, 6) AS user_id, comp_id, n_users AS ring_users, n_types AS ring_types, n_flagged AS ring_flagged, entity_types
FROM comp JOIN cc USING (comp_id) LEFT JOIN fl USING (v) WHERE kind = 'user' AND n_users >= 3 AND n_types >= 2 AND coalesce(is_fraud, 0) = 0""")
def h13(spark, sf):
    f = flags(spark, sf)
    return Q.residual_ring_members(*C.user_census(rows(spark, sf), f, f, "is_fraud"), f, "is_fraud")


@query("h14_bad_neighbours", BASE + _NEAR.format(f=1, flag="is_fraud = 1", src="edges") + _NEAR.format(f=2, flag="scenario_any", src="edges") + """
SELECT coalesce(a.user_id, b.user_id) AS user_id, b.hops AS hops_to_scenario_any, a.hops AS hops_to_is_fraud
FROM near1 a FULL JOIN near2 b ON a.user_id = b.user_id
WHERE coalesce(a.user_id, b.user_id) NOT IN (SELECT user_id::VARCHAR FROM flags WHERE is_fraud = 1 OR scenario_any)""")
def h14(spark, sf):
    return Q.bad_neighbours(rows(spark, sf), flags(spark, sf), max_hops=2)


@query("h15_emerging_farms", COARSE + _HUBS + """,
cov AS (SELECT entity_type, entity_value, avg(is_fraud) AS flagged_coverage FROM (SELECT DISTINCT user_id, entity_type, entity_value FROM edges)
        JOIN flags USING (user_id) GROUP BY 1, 2)
SELECT stats.*, flagged_coverage, users_per_day * (1 - flagged_coverage) AS score FROM stats JOIN cov USING (entity_type, entity_value)
WHERE n_users >= 5 ORDER BY score DESC, entity_value, entity_type LIMIT 50""")
def h15(spark, sf):
    return Q.emerging_farms(edges(spark, sf, "coarse"), flags(spark, sf), "is_fraud")


@query("h16_multi_witness_pairs", COARSE + _PROJ + """
SELECT * FROM proj WHERE n_types >= 2 AND user_a NOT IN (SELECT user_id FROM flags WHERE is_fraud = 1)
AND user_b NOT IN (SELECT user_id FROM flags WHERE is_fraud = 1)""")
def h16(spark, sf):
    return Q.multi_witness_pairs(rows(spark, sf, "coarse"), flags(spark, sf), "is_fraud", degree_cap=CAP)


@query("h16_multi_witness_pairs_uncapped", COARSE + _PROJ_ALL + """
SELECT * FROM proj WHERE n_types >= 2 AND user_a NOT IN (SELECT user_id FROM flags WHERE is_fraud = 1)
AND user_b NOT IN (SELECT user_id FROM flags WHERE is_fraud = 1)""")
def h16_all(spark, sf):
    return Q.multi_witness_pairs(rows(spark, sf, "coarse"), flags(spark, sf), "is_fraud", degree_cap=None)


@query("h17_fresh_rings", BASE + """,
recent AS (SELECT * FROM edges WHERE ts >= (SELECT max(ts) FROM edges) - INTERVAL 200 DAY)""" + _comp_sql("recent") + """
SELECT cc.*, (SELECT max(ts) FROM edges) - INTERVAL 200 DAY AS window_start, (SELECT max(ts) FROM edges) AS window_end FROM cc WHERE n_users >= 2""")
def h17(spark, sf):
    return Q.fresh_rings(edges(spark, sf), users(spark, sf), flags(spark, sf), days=200)


# Each advance walks over the users that were linked before its own place in the order of events.
_REPLAY = """,
per AS (SELECT advance_id::VARCHAR AS advance_id, min(user_id)::VARCHAR AS user_id, min(feature_as_of_ts) AS ts, max(label_gross_dpd45) AS seed,
  min(CASE WHEN advance_id % 5 = 0 THEN feature_as_of_ts + INTERVAL 10 DAY END) AS seed_ts FROM adv GROUP BY 1),
ev AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY m, kind, advance_id) AS o FROM (
  SELECT advance_id, user_id, ts, ts AS m, 0 AS kind FROM per UNION ALL
  SELECT advance_id, user_id, ts, seed_ts, 1 FROM per WHERE seed = 1 AND seed_ts IS NOT NULL)),
firsts AS (SELECT user_id, min(o) AS first_o, min(o) FILTER (WHERE kind = 1) AS seed_o FROM ev GROUP BY 1),
touched AS (SELECT DISTINCT advance_id::VARCHAR AS advance_id, entity_type, entity_type || ':' || entity_value AS e FROM capped),
link AS MATERIALIZED (SELECT ev.user_id AS u, e, entity_type, min(o) AS add_o FROM ev JOIN firsts USING (user_id) JOIN touched USING (advance_id)
  WHERE kind = 0 OR o = first_o GROUP BY 1, 2, 3),
rd AS MATERIALIZED (SELECT advance_id, user_id, ts, o FROM ev WHERE kind = 0),
walk(a, o, u) AS (
  SELECT * FROM (SELECT advance_id, o, user_id FROM rd
    UNION SELECT rd.advance_id, rd.o, link.u FROM rd JOIN touched USING (advance_id) JOIN link USING (e) WHERE add_o < rd.o)
  UNION SELECT w.a, w.o, y.u FROM walk w JOIN link x ON x.u = w.u AND x.add_o < w.o JOIN link y ON y.e = x.e AND y.add_o < w.o),
met AS (SELECT w.a, count(*) FILTER (WHERE first_o < w.o OR w.u = rd.user_id) AS comp_users,
    count(*) FILTER (WHERE seed_o < w.o AND w.u <> rd.user_id) AS nb_comp
  FROM walk w JOIN rd ON rd.advance_id = w.a LEFT JOIN firsts f ON f.user_id = w.u GROUP BY 1),
kinds AS (SELECT a, count(DISTINCT entity_type) AS comp_types FROM (
  SELECT w.a, entity_type FROM walk w JOIN link ON link.u = w.u AND add_o < w.o UNION ALL SELECT advance_id, entity_type FROM touched) GROUP BY 1),
sown AS (SELECT e, ev.user_id AS u, min(o) AS o FROM ev JOIN touched USING (advance_id) WHERE kind = 1 GROUP BY 1, 2),
near AS (SELECT rd.advance_id AS a, count(DISTINCT sown.u) AS nb_d1 FROM rd JOIN touched USING (advance_id) JOIN sown ON sown.e = touched.e
  WHERE sown.o < rd.o AND sown.u <> rd.user_id GROUP BY 1)
SELECT rd.advance_id, rd.user_id, rd.ts, comp_users, coalesce(comp_types, 0)::INTEGER AS comp_types, nb_comp, coalesce(nb_d1, 0) AS nb_d1
FROM rd JOIN met ON met.a = rd.advance_id LEFT JOIN kinds ON kinds.a = rd.advance_id LEFT JOIN near ON near.a = rd.advance_id"""


@query("h18_leakfree_replay", BASE + _REPLAY)
def h18(spark, sf):
    return replay.leakfree_features(advances(spark, sf), rows(spark, sf), degree_cap=CAP)


_TRUTH = """,
truth AS (SELECT user_id, max(is_fraud) AS is_fraud, max(label_gross_dpd45) AS dpd45, max(loan_amount > 440000) AS scen, min(feature_as_of_ts) AS first_ts
  FROM adv WHERE label_mature_d45 = 1 AND feature_as_of_ts >= TIMESTAMP '1996-01-01' GROUP BY 1),
mid AS (SELECT quantile_cont(epoch_us(first_ts)::DOUBLE, 0.5) AS m FROM truth)"""


@query("h19_user_truth_rates", BASE + _TRUTH + " UNION ALL ".join(
    f"""SELECT '{n}' AS scope, count(*) AS n_users, avg(is_fraud) AS fraud_rate, avg(dpd45) AS dpd45_rate, avg(scen::INT) AS flagged_rate
    FROM truth, mid WHERE {w}""" for n, w in (
        ("pool", "true"), ("early", "epoch_us(first_ts) <= m"), ("late", "epoch_us(first_ts) > m"), ("residual", "NOT scen"))))
def h19(spark, sf):
    return Q.pooled_rates(Q.user_truth(advances(spark, sf), BIG, start="1996-01-01 00:00:00"))


@query("h20_queue_outcome_check", BASE + _TRUTH + _NEAR.format(f=1, flag="is_fraud = 1", src="edges") + """
SELECT count(*) AS n_users, avg(dpd45) AS dpd45_rate, avg(is_fraud) AS fraud_rate FROM truth
WHERE user_id::VARCHAR IN (SELECT user_id FROM near1 WHERE hops = 1)""")
def h20(spark, sf):
    near = T.near_flagged(rows(spark, sf), flags(spark, sf).filter("is_fraud = 1"), 1)
    return Q.outcome_check(near, Q.user_truth(advances(spark, sf), BIG, start="1996-01-01 00:00:00"))
