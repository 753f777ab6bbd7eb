"""Source, sink, schema, key, split and profile queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidegate.catalog import standins as S
from tidegate.catalog.registry import query
from tidegate.functions import clock
from tidegate.functions.predicates import Predicate, default_splits, where
from tidegate.operators import keys as K, profile as G, schema as B
from tidegate.plans import dataset as D
from tidegate.session import scratch_folder
from tidegate.sources import readers, writers


def messy(spark, sf):
    """Orders with nulls, sentinels, a constant and a decimal column."""
    return S.table(spark, sf, "orders").selectExpr(
        "o_orderkey", "IF(o_orderkey % 7 = 0, NULL, o_custkey) AS cust", "IF(o_orderkey % 300 <> 0, NULL, o_orderstatus) AS mostly_null",
        "'x' AS constant", "IF(o_orderkey % 400 = 0, 'b', 'a') AS nearly", "o_orderstatus AS target",
        "CASE o_orderkey % 5 WHEN 0 THEN 'nan' WHEN 1 THEN 'None' WHEN 2 THEN ' ' ELSE CAST(o_totalprice AS STRING) END AS price_text",
        "CASE o_orderkey % 4 WHEN 0 THEN 'True' WHEN 1 THEN 'false' WHEN 2 THEN '1' ELSE 'maybe' END AS flag_text",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS price_decimal", "o_orderpriority AS priority",
        "o_totalprice AS price", "IF(o_orderstatus = 'F' AND o_orderkey % 2 = 0, NULL, o_orderkey % 11) AS half_missing",
        "IF(o_orderkey % 50 = 0, 'not a date', CAST(o_orderdate AS STRING)) AS order_date_text", "o_orderdate")


MESSY_SQL = """
messy AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS cust,
  CASE WHEN o_orderkey % 300 = 0 THEN o_orderstatus END AS mostly_null, 'x' AS constant,
  CASE WHEN o_orderkey % 400 = 0 THEN 'b' ELSE 'a' END AS nearly, o_orderstatus AS target,
  CASE o_orderkey % 5 WHEN 0 THEN 'nan' WHEN 1 THEN 'None' WHEN 2 THEN ' ' ELSE o_totalprice::VARCHAR END AS price_text,
  CASE o_orderkey % 4 WHEN 0 THEN 'True' WHEN 1 THEN 'false' WHEN 2 THEN '1' ELSE 'maybe' END AS flag_text,
  o_totalprice::DECIMAL(18,2) AS price_decimal, o_orderpriority AS priority, o_totalprice AS price,
  CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN NULL ELSE o_orderkey % 11 END AS half_missing,
  CASE WHEN o_orderkey % 50 = 0 THEN 'not a date' ELSE o_orderdate::VARCHAR END AS order_date_text, o_orderdate FROM orders)"""
MESSY = "WITH " + MESSY_SQL
FREE = ("cust", "mostly_null", "constant", "nearly", "price_text", "flag_text", "priority", "half_missing", "order_date_text", "target")


def stats_sql(columns=FREE, source="messy"):
    """Long (column, value) statistics as one SQL query over ``source``."""
    tall = " UNION ALL ".join(f"SELECT '{c}' AS col, {c}::VARCHAR AS v FROM {source}" for c in columns)
    return f""",
tall AS ({tall}), vc AS (SELECT col, v, count(*) AS n FROM tall GROUP BY 1, 2),
stats AS (SELECT col AS "column", sum(n)::BIGINT AS n_rows, coalesce(sum(n) FILTER (WHERE v IS NULL), 0) / sum(n)::DOUBLE AS null_pct,
                 count(v) AS nunique, max(n) / sum(n)::DOUBLE AS dominance_pct FROM vc GROUP BY 1)"""


# ---- sources and sinks ---------------------------------------------------------

@query("a1_csv_source", "SELECT p_partkey::INTEGER AS p_partkey, p_name, p_size, p_retailprice FROM part")
def a1(spark, sf):
    folder = scratch_folder(spark, "csv")
    S.table(spark, sf, "part").select("p_partkey", "p_name", "p_size", "p_retailprice").write.option("header", True).csv(folder)
    return readers.CsvSource(folder).load(spark)


@query("a2_parquet_source", "SELECT * FROM orders")
def a2(spark, sf):
    return readers.ParquetSource(f"{sf}/orders.parquet").load(spark)


@query("a3_managed_table_select", f"""
SELECT o_orderkey, o_custkey, o_totalprice, {S.bucket_sql('o_custkey')}::INTEGER AS "SPLIT_PCT" FROM orders WHERE o_totalprice > 50000""")
def a3(spark, sf):
    # Built from its SELECT once, loaded again from the catalog, and refused once a stored bucket is not its key's.
    name = f"managed_{uuid.uuid4().hex}"
    built = readers.ManagedTableSource(name, f"SELECT o_orderkey, o_custkey, o_totalprice FROM parquet.`{sf}/orders.parquet`", ("o_orderkey",),
                                       ("o_custkey",), f"SELECT * FROM {name} WHERE o_totalprice > 50000")
    if not built.ensure(spark) or built.ensure(spark):
        raise RuntimeError("the table is built when it is missing, and only then")
    spark.table(name).withColumn(K.SPLIT, F.expr(f"IF(o_orderkey % 50 = 0, 99 - {K.SPLIT}, {K.SPLIT})")).write.saveAsTable(f"{name}_tampered")
    try:
        readers.ManagedTableSource(f"{name}_tampered", "", ("o_orderkey",), ("o_custkey",)).load(spark)
    except ValueError:
        spark.sql(f"DROP TABLE {name}_tampered")
        return built.load(spark)
    raise RuntimeError("a tampered bucket went unnoticed")


@query("a5_split_invariant", f"""
SELECT o_orderkey, stored AS "SPLIT_PCT" FROM (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE {S.bucket_sql('o_custkey')} END::INTEGER AS stored FROM orders)
WHERE stored IS DISTINCT FROM {S.bucket_sql('o_custkey')}""")
def a5(spark, sf):
    orders = K.add_split(S.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ["o_custkey"])
    stored = orders.withColumn(K.SPLIT, F.expr(f"IF(o_orderkey % 50 = 0, NULL, {K.SPLIT})"))
    return K.split_mismatches(stored, ["o_custkey"]).select("o_orderkey", K.SPLIT)


@query("a6_dry_run_sample", f"""
SELECT o_orderkey, o_custkey FROM orders
WHERE {S.bucket_sql('o_orderkey')} < (SELECT greatest(1, least(100, round_even(100 * 3000 / count(*), 0))) FROM orders)""")
def a6(spark, sf):
    return readers.dry_run_sample(S.table(spark, sf, "orders"), ["o_orderkey"], 3000).select("o_orderkey", "o_custkey")


@query("a7_decimals_to_doubles", MESSY + "SELECT o_orderkey, price_decimal::DOUBLE AS price_decimal FROM messy")
def a7(spark, sf):
    return B.decimals_to_doubles(messy(spark, sf).select("o_orderkey", "price_decimal"))


@query("a9_dataset_sink", "SELECT * FROM orders")
def a9(spark, sf):
    folder = scratch_folder(spark, "dataset")
    writers.write_dataset(S.table(spark, sf, "orders"), folder)
    return spark.read.parquet(f"{folder}/data")


@query("a11_predictions_sink", f"SELECT o_orderkey, {S.bucket_sql('o_orderkey', 1000)} / 1000.0::DOUBLE AS y_pred FROM orders")
def a11(spark, sf):
    folder = scratch_folder(spark, "predictions")
    writers.write_predictions(S.scored_orders(spark, sf).withColumnRenamed("score", "y_pred"), folder, ["o_orderkey"])
    return writers.load_predictions(spark, folder)[0]


@query("a12_side_table_sink", "SELECT o_orderkey, o_totalprice * 2 AS doubled_price FROM orders")
def a12(spark, sf):
    folder = scratch_folder(spark, "side")
    side = S.table(spark, sf, "orders").selectExpr("o_orderkey", "o_totalprice * 2 AS doubled_price")
    writers.write_side_table(side, folder, {"name": "doubled"})
    assert writers.write_side_table(side, folder, {"name": "doubled"}) == "reused"
    return spark.read.parquet(f"{folder}/data")


@query("a14_csv_to_parquet", "SELECT c_custkey::INTEGER AS c_custkey, c_name, c_acctbal FROM customer")
def a14(spark, sf):
    folder = scratch_folder(spark, "convert")
    S.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal").write.option("header", True).csv(f"{folder}/csv")
    return writers.csv_to_parquet(spark, f"{folder}/csv", f"{folder}/parquet")


@query("a15_stratified_downsample", S.ctes(S.SCORED_SQL) + f"""
SELECT o_orderkey, heuristic_fraud_band FROM scored WHERE heuristic_fraud_band <> 'LOW' OR {S.bucket_sql('o_orderkey', 10000)} < 875""")
def a15(spark, sf):
    return readers.stratified_downsample(S.scored_orders(spark, sf), "heuristic_fraud_band", "o_orderkey").select(
        "o_orderkey", "heuristic_fraud_band")


@query("a16_trailing_window", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1999-08-31' - INTERVAL 6 MONTH")
def a16(spark, sf):
    return readers.trailing_window(S.table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", "1999-08-31")


@query("a17_json_lines_events", """
SELECT event_type AS event, user_id::VARCHAR AS agent_id, epoch_us(ts) / 1e6 AS time_s FROM events""")
def a17(spark, sf):
    folder = scratch_folder(spark, "lines")
    lines = S.events(spark, sf).selectExpr(
        "to_json(named_struct('event', event_type, 'agent_id', CAST(user_id AS STRING), 'time_s', "
        f"{clock.wall_micros('ts')} / 1e6D)) AS value")
    noise = spark.createDataFrame([("",), ("   ",), ("[1, 2]",), ("7",)], "value string")
    lines.unionByName(noise).write.text(folder)
    return readers.read_event_lines(spark, folder).select("event", "agent_id", "time_s")


# ---- schema, cleaning, identity ---------------------------------------------------

@query("b1_standardise_columns", "SELECT o_orderkey AS order_key, o_custkey AS order_key_2, o_totalprice AS total_price_usd FROM orders")
def b1(spark, sf):
    raw = S.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias(" Order  Key"), F.col("o_custkey").alias("order-key!"),
        F.col("o_totalprice").alias("Total__Price ($USD)"))
    return B.standardise(raw, K.SPLIT)[0]


@query("b3_adopt_provided_split", 'SELECT o_orderkey, (o_orderkey % 100)::INTEGER AS "SPLIT_PCT" FROM orders')
def b3(spark, sf):
    return K.adopt_split(S.table(spark, sf, "orders").selectExpr("o_orderkey", "CAST(o_orderkey % 100 AS DOUBLE) AS split_pct"))


@query("b4_quality_filters", MESSY + "SELECT o_orderkey, cust, nearly, target, priority, constant FROM messy")
def b4(spark, sf):
    df = messy(spark, sf).select("o_orderkey", "cust", "mostly_null", "constant", "nearly", "target", "priority",
                                 F.lit(1).alias("one"))
    return G.drop_poor_columns(df, protected=["o_orderkey", "target", "constant"])


@query("b5_dominance_share", MESSY + stats_sql() + 'SELECT "column", dominance_pct FROM stats')
def b5(spark, sf):
    return G.column_stats(messy(spark, sf), FREE).select("column", "dominance_pct")


_TYPES = {"o_orderkey": "num", "cust": "num", "half_missing": "num"}


@query("b8_column_registry", MESSY + stats_sql((*FREE, "o_orderkey")) + """
SELECT "column", CASE WHEN "column" IN ('o_orderkey', 'cust', 'half_missing') THEN 'num' ELSE 'cat' END AS dtype, true AS available,
  "column" NOT IN ('target', 'o_orderkey', 'priority') AS feature, "column" NOT IN ('target', 'o_orderkey', 'priority') AS model,
  "column" = 'target' AS target, false AS derived, null_pct, nunique, dominance_pct FROM stats""")
def b8(spark, sf):
    return G.registry(messy(spark, sf).select("o_orderkey", *FREE), target="target", metadata=["o_orderkey"], excluded=["priority"])


@query("b11_project_by_flag", MESSY + "SELECT cust, nearly, priority FROM messy")
def b11(spark, sf):
    return B.project(messy(spark, sf), ["priority", "cust", "nearly"])


@query("b12_cast_by_type", MESSY + """
SELECT o_orderkey, TRY_CAST(CASE WHEN price_text IN ('nan', 'None', ' ') THEN NULL ELSE price_text END AS DOUBLE) AS price_text,
  CASE WHEN flag_text = 'True' THEN 1.0 WHEN flag_text = 'false' THEN 0.0 ELSE TRY_CAST(flag_text AS DOUBLE) END::DOUBLE AS flag_text,
  cust::VARCHAR AS cust FROM messy""")
def b12(spark, sf):
    df = messy(spark, sf).select("o_orderkey", "price_text", "flag_text", "cust")
    return B.cast_columns(df, {"price_text": "num", "flag_text": "bool", "cust": "cat"})


@query("b16_content_hash", "SELECT count(*) AS n_rows, true AS order_free, true AS sees_a_missing_row, true AS sees_a_repeated_row FROM orders")
def b16(spark, sf):
    """The sums themselves depend on Spark's hash; what they promise does not."""
    orders = S.table(spark, sf, "orders")
    one = orders.orderBy("o_orderkey").limit(1)
    first, shuffled, fewer, more = (D.content_parts(f).first() for f in (
        orders, orders.repartition(3), orders.join(one.select("o_orderkey"), "o_orderkey", "left_anti").select(*orders.columns), orders.unionByName(one)))
    return spark.createDataFrame([(first.n_rows, first == shuffled, first.sum_hash != fewer.sum_hash, first.sum_hash != more.sum_hash)],
                                 "n_rows long, order_free boolean, sees_a_missing_row boolean, sees_a_repeated_row boolean")


@query("b17_versioned_write", """
SELECT 0 AS step, 'v1' AS version, true AS written, (SELECT count(*) FROM orders) AS n_rows
UNION ALL SELECT 1, 'v1', false, (SELECT count(*) FROM orders) UNION ALL SELECT 2, 'v2', true, (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P')""")
def b17(spark, sf):
    root, orders = scratch_folder(spark, "versions"), S.table(spark, sf, "orders")
    steps = [D.write_version(orders, root), D.write_version(orders.repartition(3), root),
             D.write_version(orders.filter("o_orderstatus <> 'P'"), root)]
    return spark.createDataFrame([(i, d.id.split("_")[0], new, d.record["n_rows"]) for i, (d, new) in enumerate(steps)],
                                 "step int, version string, written boolean, n_rows long")


@query("b21_verified_load", "SELECT o_orderkey, o_totalprice FROM orders")
def b21(spark, sf):
    written, _ = D.write_version(S.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), scratch_folder(spark, "verify"))
    return written.load(spark, verify=True)


@query("b22_two_class_fixture", "SELECT o_orderkey % 2 AS target, o_orderkey AS value, (o_orderkey * 7) % 5 AS noise FROM orders")
def b22(spark, sf):
    return D.two_class_fixture(S.table(spark, sf, "orders"), "o_orderkey")


# ---- keys, splits, predicates ------------------------------------------------------

@query("c2_unique_key_check", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def c2(spark, sf):
    return K.duplicate_keys(S.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("c3_split_bucket", f'SELECT o_orderkey, o_custkey, {S.bucket_sql("o_custkey")}::INTEGER AS "SPLIT_PCT" FROM orders')
def c3(spark, sf):
    return K.add_split(S.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ["o_custkey"])


@query("c4_split_validation", """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE s IS NULL) AS n_null, count(*) FILTER (WHERE s <> floor(s)) AS n_fractional,
       count(*) FILTER (WHERE s < 0 OR s > 99) AS n_out_of_range
FROM (SELECT CASE WHEN o_orderkey % 9 <> 0 THEN o_orderkey % 104 / 2.0 END AS s FROM orders)""")
def c4(spark, sf):
    df = S.table(spark, sf, "orders").selectExpr("IF(o_orderkey % 9 <> 0, o_orderkey % 104 / 2.0D, NULL) AS SPLIT_PCT")
    return K.split_problems(df)


@query("c5_split_report", f'SELECT {S.bucket_sql("o_custkey")}::INTEGER AS "SPLIT_PCT", count(*) AS n_rows FROM orders GROUP BY 1')
def c5(spark, sf):
    return K.split_report(K.add_split(S.table(spark, sf, "orders"), ["o_custkey"]))


CMP = MESSY + "SELECT o_orderkey FROM messy WHERE {}"


@query("c6_comparison_predicates", MESSY + """
SELECT o_orderkey, coalesce(cust < 500, false) AS lt, coalesce(cust >= 500, false) AS ge, coalesce(cust = 7, false) AS eq,
       cust IS DISTINCT FROM 7 AS ne FROM messy""")
def c6(spark, sf):
    df, c = messy(spark, sf), where("CUST")
    return df.select("o_orderkey", *[p.flag(df).alias(n) for n, p in {
        "lt": c < 500, "ge": c >= 500, "eq": c == 7, "ne": c != 7}.items()])


@query("c6_comparison_filter", CMP.format("cust < 500 AND cust IS DISTINCT FROM 7"))
def c6f(spark, sf):
    return ((where("cust") < 500) & (where("cust") != 7)).filter(messy(spark, sf)).select("o_orderkey")


@query("c7_membership_predicates", MESSY + """
SELECT o_orderkey, coalesce(cust IN (1, 2, 3), false) AS is_in, NOT coalesce(cust IN (1, 2, 3), false) AS not_in,
       cust IS NULL AS in_none, coalesce(cust IN (1), false) OR cust IS NULL AS in_one_or_none FROM messy""")
def c7(spark, sf):
    df, c = messy(spark, sf), where("cust")
    return df.select("o_orderkey", *[p.flag(df).alias(n) for n, p in {
        "is_in": c.isin([1, 2, 3]), "not_in": c.notin([1, 2, 3]), "in_none": c.isin([None]),
        "in_one_or_none": c.isin([1, None])}.items()])


@query("c8_null_tests", MESSY + "SELECT o_orderkey, cust IS NULL AS is_null, mostly_null IS NOT NULL AS not_null FROM messy")
def c8(spark, sf):
    df = messy(spark, sf)
    return df.select("o_orderkey", where("cust").is_null().flag(df).alias("is_null"),
                     where("mostly_null").not_null().flag(df).alias("not_null"))


@query("c9_boolean_composition", CMP.format("NOT (coalesce(cust < 500, false) OR coalesce(half_missing = 3, false))"))
def c9(spark, sf):
    p = ~((where("cust") < 500) | (where("half_missing") == 3))
    return Predicate.from_record(p.to_record()).filter(messy(spark, sf)).select("o_orderkey")


@query("c12_named_splits", f"""
SELECT CASE WHEN {S.bucket_sql('o_custkey')} < 80 THEN 'train' ELSE 'test' END AS split, count(*) AS n_rows, sum(o_orderkey)::BIGINT AS key_sum
FROM orders GROUP BY 1""")
def c12(spark, sf):
    orders = K.add_split(S.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ["o_custkey"])
    written, _ = D.write_version(orders, scratch_folder(spark, "splits"), partition=K.SPLIT)
    parts = [written.load(spark, split=n).agg(F.count("*").alias("n_rows"), F.sum("o_orderkey").alias("key_sum")).withColumn(
        "split", F.lit(n)) for n in default_splits()]
    return parts[0].unionByName(parts[1])


@query("c13_time_split", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'")
def c13(spark, sf):
    rolling = (where("o_orderdate") >= "1997-01-01") & (where("o_orderdate") < "1998-01-01")
    return D.load_slice(S.table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), predicate=rolling)


@query("c14_slice_contract", f"""
SELECT CASE WHEN {S.bucket_sql('o_custkey')} < 80 THEN 'train' ELSE 'test' END AS split, count(*) AS n_rows, true AS replayed FROM orders GROUP BY 1""")
def c14(spark, sf):
    df = K.add_split(S.table(spark, sf, "orders"), ["o_custkey"])
    contract = D.slice_contract(df, default_splits())
    D.verify_slices(df, [r.asDict() for r in contract.collect()])  # raises where a slice differs
    return contract.select("split", "n_rows", F.lit(True).alias("replayed"))


# ---- profile ------------------------------------------------------------------------

@query("g1_data_card", MESSY + stats_sql() + f"""
SELECT "column", CASE WHEN "column" IN ('cust', 'half_missing') THEN 'bigint' ELSE 'string' END AS dtype, n_rows, {len(FREE)} AS n_columns, null_pct, nunique FROM stats""")
def g1(spark, sf):
    return G.data_card(messy(spark, sf).select(*FREE))


@query("g2_observations", MESSY + """
SELECT 'majority_share' AS kind, max(n) / sum(n)::DOUBLE AS value FROM (SELECT count(*) AS n FROM messy GROUP BY target)
UNION ALL SELECT 'columns_over_half_missing', ((SELECT avg((mostly_null IS NULL)::INT) FROM messy) > 0.5)::INT::DOUBLE""")
def g2(spark, sf):
    return G.observations(messy(spark, sf), "target")


@query("g3_key_cardinality", """
SELECT count(*) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS n_distinct, count(*) = count(DISTINCT (l_orderkey, l_linenumber)) AS one_to_one FROM lineitem""")
def g3(spark, sf):
    return G.key_cardinality(S.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("g5_label_distribution", "SELECT o_orderstatus, count(*) AS n_rows FROM orders GROUP BY 1")
def g5(spark, sf):
    return G.label_distribution(S.table(spark, sf, "orders"), "o_orderstatus")


@query("g5_top_missingness", MESSY + stats_sql() + 'SELECT "column", null_pct FROM stats ORDER BY null_pct DESC, "column" LIMIT 5')
def g5m(spark, sf):
    return G.top_missing(messy(spark, sf).select(*FREE), 5)


@query("g6_duplicate_rows", """
SELECT coalesce(sum(n) FILTER (WHERE n > 1), 0)::BIGINT AS duplicate_rows, coalesce(sum(n) FILTER (WHERE n > 1), 0) / sum(n)::DOUBLE AS duplicate_rate
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber, l_quantity)""")
def g6(spark, sf):
    return G.duplicate_rows(S.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"))


@query("g7_bucket_histogram", f"""
SELECT b AS bucket, count(o_orderkey) AS n_rows FROM (SELECT unnest(range(100)) AS b)
LEFT JOIN (SELECT o_orderkey, {S.bucket_sql('o_custkey', 90)} AS s FROM orders) ON s = b GROUP BY 1""")
def g7(spark, sf):
    return G.bucket_histogram(S.table(spark, sf, "orders").withColumn("s", S.bucket(F.col("o_custkey"), 90)), "s")


@query("g8_missing_targets", MESSY + "SELECT o_orderkey FROM messy WHERE half_missing IS NULL")
def g8(spark, sf):
    return G.missing_targets(messy(spark, sf), "half_missing").select("o_orderkey")


@query("g9_missing_by_target", MESSY + """
, r AS (SELECT target, avg((half_missing IS NULL)::INT) AS h, avg((cust IS NULL)::INT) AS c FROM messy GROUP BY 1)
SELECT 'half_missing' AS "column", min(h) AS min_null_rate, max(h) AS max_null_rate FROM r HAVING max(h) - min(h) >= 0.25
UNION ALL SELECT 'cust', min(c), max(c) FROM r HAVING max(c) - min(c) >= 0.25""")
def g9(spark, sf):
    return G.missing_by_target(messy(spark, sf), "target")


@query("g10_rare_categories", MESSY + stats_sql(("nearly", "priority", "mostly_null", "order_date_text")) + """
, t AS (SELECT col, v, n FROM vc WHERE n <= greatest(2, 0.005 * (SELECT count(*) FROM messy))),
  k AS (SELECT *, row_number() OVER (PARTITION BY col ORDER BY n, v NULLS FIRST) AS i FROM t)
SELECT col AS "column", count(*) AS rare_category_count, list(v ORDER BY i) FILTER (WHERE i <= 5) AS examples FROM k GROUP BY 1""")
def g10(spark, sf):
    return G.rare_categories(messy(spark, sf), ["nearly", "priority", "mostly_null", "order_date_text"])


@query("g11_high_cardinality", MESSY + stats_sql() + """SELECT "column", nunique AS cardinality FROM stats
WHERE nunique > 50 AND "column" NOT IN ('cust', 'half_missing')""")
def g11(spark, sf):
    return G.high_cardinality(messy(spark, sf))


@query("g12_near_constant", MESSY + stats_sql() + 'SELECT "column", dominance_pct AS dominant_share FROM stats WHERE dominance_pct >= 0.995')
def g12(spark, sf):
    return G.near_constant(messy(spark, sf).select(*FREE))


@query("g13_datetime_review", MESSY + """
SELECT 'order_date_text' AS "column", 1 - count(TRY_CAST(order_date_text AS TIMESTAMP)) / count(*)::DOUBLE AS parse_failure_rate,
  min(TRY_CAST(order_date_text AS TIMESTAMP)) AS min_value, max(TRY_CAST(order_date_text AS TIMESTAMP)) AS max_value,
  count(*) FILTER (WHERE TRY_CAST(order_date_text AS TIMESTAMP) > TIMESTAMP '1999-01-01') AS future_rows FROM messy
UNION ALL SELECT 'o_orderdate', 0.0, min(o_orderdate), max(o_orderdate), count(*) FILTER (WHERE o_orderdate > TIMESTAMP '1999-01-01') FROM messy""")
def g13(spark, sf):
    return G.datetime_review(messy(spark, sf).select("order_date_text", "o_orderdate", "price"), "1999-01-01 00:00:00")


_QS = {f"q{str(q).replace('.', '_')}": q for q in G.QUANTILES}


@query("g14_outlier_scan", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", " + ", ".join(f"quantile_cont({c}::DOUBLE, {q}) AS {n}" for n, q in _QS.items()) + " FROM lineitem"
    for c in ("l_quantity", "l_extendedprice", "l_discount")))
def g14(spark, sf):
    return G.outlier_scan(S.table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


@query("g17_profile_diff", MESSY + stats_sql(("cust", "nearly", "priority")) + """
, tall2 AS (SELECT 'cust' AS col, cust::VARCHAR AS v FROM messy WHERE target = 'F' UNION ALL SELECT 'constant', constant FROM messy WHERE target = 'F'
            UNION ALL SELECT 'priority', priority FROM messy WHERE target = 'F'),
  s2 AS (SELECT col AS "column", avg((v IS NULL)::INT) AS null_pct, count(DISTINCT v) AS nunique FROM tall2 GROUP BY 1)
SELECT "column", CASE WHEN stats.nunique IS NULL THEN 'added' WHEN s2.nunique IS NULL THEN 'removed' ELSE 'kept' END AS change,
  stats.null_pct AS old_null_pct, s2.null_pct AS new_null_pct, stats.nunique AS old_nunique, s2.nunique AS new_nunique,
  coalesce(s2.nunique <= 1, false) AS constant_now FROM stats FULL JOIN s2 USING ("column")""")
def g17(spark, sf):
    df = messy(spark, sf)
    return G.profile_diff(df.select("cust", "nearly", "priority"), df.filter("target = 'F'").select("cust", "constant", "priority"))
