"""Predicates, keys, splits, schema and dataset lifecycle."""

import pytest
from pyspark.sql import functions as F

from tidegate.functions.predicates import Predicate, default_splits, where
from tidegate.operators import keys as K, profile as G, schema as B
from tidegate.plans import dataset as D, evaluation as E
from tidegate.sources import readers, writers


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(1, 10, "a"), (2, None, "b"), (3, 30, None)], "id int, x int, name string")


def kept(p, df):
    flagged = {r.id for r in df.filter(p.flag(df)).collect()}
    assert flagged == {r.id for r in p.filter(df).collect()}
    return flagged


def test_predicate_null_rules(frame):
    x = where("x")
    assert kept(x < 20, frame) == {1}
    assert kept(x != 10, frame) == {2, 3}
    assert kept(~(x == 10), frame) == {2, 3}
    assert kept(~(x < 20), frame) == {2, 3}
    assert kept(x.notin([10]), frame) == {2, 3}
    assert kept(x.isin([None]), frame) == {2}
    assert kept(x.isin([]), frame) == set()
    assert kept((x == 10) | where("name").is_null(), frame) == {1, 3}


def test_predicate_names_and_records(frame):
    assert kept(where("X") >= 30, frame) == {3}
    with pytest.raises(KeyError, match="missing"):
        (where("nope") == 1).flag(frame)
    twice = frame.select(F.col("x").alias("AB"), F.col("id").alias("Ab"))
    with pytest.raises(KeyError, match="ambiguous"):
        (where("ab") == 1).flag(twice)
    with pytest.raises(TypeError):
        where("x") == None  # noqa: E711
    p = ~((where("x") < 3) & where("name").isin(["a", None]))
    assert Predicate.from_record(p.to_record()) == p
    for bad in ({"op": "and", "items": []}, {"op": "~"}, {"op": "==", "value": 1}):
        with pytest.raises(ValueError):
            Predicate.from_record(bad)


def test_plain_comparisons_reach_the_scan(spark, tmp_path, frame):
    frame.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = ((where("x") < 20) & (where("x") != 5)).filter(df)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(x,20)" in plan


def test_keys(spark):
    assert K.normal_key(["b", "a"]) == ("a", "b")
    for bad in ([], ["a", "a"], [" "]):
        with pytest.raises(ValueError):
            K.normal_key(bad)
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "a int, b string")
    with pytest.raises(ValueError, match="null"):
        K.check_unique_key(df, ["a", "b"])
    with pytest.raises(ValueError, match="duplicate"):
        K.check_unique_key(df, "a")
    with pytest.raises(KeyError):
        K.check_unique_key(df, "nope")


@pytest.mark.parametrize("how", ["md5", "xxhash64"])
def test_split_groups_stay_together(spark, how):
    df = K.add_split(spark.range(2000).withColumn("g", F.expr("id % 300")), ["g"], how=how)
    assert df.groupBy("g").agg(F.count_distinct(K.SPLIT).alias("n")).filter("n > 1").count() == 0
    K.check_split(df)
    assert K.split_mismatches(df, ["g"], how=how).count() == 0
    with pytest.raises(ValueError):
        K.check_split(df.withColumn(K.SPLIT, F.lit(100)))
    with pytest.raises(ValueError):
        K.adopt_split(spark.createDataFrame([(0.5,)], "split_pct double"))


def test_standardise_and_cast(spark):
    out, original = B.standardise(spark.createDataFrame([(1, 2, 3)], "`A b` int, `a-B` int, `__c$` int"))
    assert out.columns == ["a_b", "a_b_2", "c"] and original["a_b_2"] == "a-B"
    with pytest.raises(ValueError):
        B.standardise(spark.createDataFrame([(1,)], "`$$` int"))
    with pytest.raises(ValueError):
        B.standardise(spark.createDataFrame([(1,)], "Split_Pct int"), K.SPLIT)
    df = spark.createDataFrame([("1.5", "True", 1), ("nan", "no", None), ("x", "0", 3)], "n string, b string, c int")
    rows = [tuple(r) for r in B.cast_columns(df, {"n": "num", "b": "bool", "c": "cat"}).collect()]
    assert rows == [(1.5, 1.0, "1"), (None, None, None), (None, 0.0, "3")]
    nan = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert B.nan_to_null(nan).filter("v is null").count() == 1


def test_content_hash_invariants(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", "z"), (2, "b", "z")], "x int, y string, z string")
    h = D.content_hash(df)
    assert h == D.content_hash(df.orderBy(F.desc("x")).repartition(3))
    assert h != D.content_hash(df.distinct())
    assert h != D.content_hash(df.select("y", "x", "z"))
    assert h != D.content_hash(df.withColumn("x", F.col("x").cast("long")))
    swapped = spark.createDataFrame([(1, "a"), (1, None)], "x int, y string"), spark.createDataFrame(
        [(1, None), (1, "a")], "x int, z string").toDF("x", "y")
    assert D.content_hash(swapped[0]) == D.content_hash(swapped[1])
    moved = spark.createDataFrame([(None, 5)], "a int, b int"), spark.createDataFrame([(5, None)], "a int, b int")
    assert D.content_hash(moved[0]) != D.content_hash(moved[1])


def test_prepare_version_verify_and_slices(spark, tmp_path):
    rows = [(i, i // 2, "k", None if i % 3 else "v", i % 2) for i in range(200)]
    spark.createDataFrame(rows, "`Row Id` int, grp int, fixed string, holey string, Target int").write.option(
        "header", True).csv(str(tmp_path / "in"))
    spec = D.DataSpec(readers.CsvSource("in", ("Row Id",), ("grp",), base=str(tmp_path)), target="Target", null_drop_threshold=0.5)
    df = D.prepare(spec, spark)
    assert df.columns == ["row_id", "grp", "target", K.SPLIT]
    first, new = D.write_version(df, str(tmp_path / "v"), registry=G.registry(df, target="target", split=K.SPLIT))
    again, second = D.write_version(df.repartition(2), str(tmp_path / "v"))
    third, _ = D.write_version(df.filter("row_id < 100"), str(tmp_path / "v"))
    assert new and not second and first.id == again.id and third.id.startswith("v2_")
    train = first.load(spark, split="train", verify=True)
    test = first.load(spark, split="test")
    assert train.count() + test.count() == 200 and train.join(test, "grp").count() == 0
    with pytest.raises(ValueError):
        first.load(spark, split="train", predicate=where("grp") == 1)
    with pytest.raises(KeyError):
        first.load(spark, split="nope")
    contract = [r.asDict() for r in D.slice_contract(df, default_splits()).collect()]
    D.verify_slices(df, contract)
    with pytest.raises(ValueError):
        D.verify_slices(df.filter("row_id <> 7"), contract)
    with pytest.raises(ValueError):
        D.verify_dataset(df.filter("row_id <> 7"), first.record)
    with pytest.raises(ValueError):
        D.load_nonempty(df, where("grp") == -1)
    with pytest.raises(Exception):
        writers.write_dataset(df, first.folder)


def test_broken_side_table_is_noticed(spark, tmp_path):
    df = spark.range(5)
    assert writers.write_side_table(df, str(tmp_path / "a"), {}) == "written"
    assert writers.write_side_table(df, str(tmp_path / "a"), {}) == "reused"
    df.write.parquet(str(tmp_path / "b" / "data"))
    with pytest.raises(ValueError, match="broke off"):
        writers.write_side_table(df, str(tmp_path / "b"), {})


def test_managed_table_builds_once_and_checks_its_split(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tide LOCATION '{tmp_path / 'db'}'")
    spark.range(1000).createOrReplaceTempView("raw_rows")
    source = readers.ManagedTableSource("tide.base", "SELECT id, id % 50 AS g FROM raw_rows", ("id",), ("g",))
    assert source.ensure(spark) and not source.ensure(spark)
    assert source.load(spark).count() == 1000
    sample = source.load(spark, nrows=100)
    assert 0 < sample.count() < 300 and {r.id for r in sample.collect()} == {r.id for r in source.load(spark, nrows=100).collect()}
    spark.table("tide.base").withColumn(K.SPLIT, F.expr("IF(id = 3, 99 - SPLIT_PCT, SPLIT_PCT)")).write.saveAsTable("tide.bad")
    with pytest.raises(ValueError, match="rebuild"):
        readers.ManagedTableSource("tide.bad", "", ("id",), ("g",)).load(spark)
    spark.sql("DROP DATABASE tide CASCADE")


def test_approximate_profile_is_close(spark):
    df = spark.range(5000).selectExpr("id", "id % 7 AS d", "IF(id % 2 = 0, NULL, 'x') AS s")
    exact = {r.column: r for r in G.column_stats(df).collect()}
    close = {r.column: r for r in G.column_stats(df, approximate=True).collect()}
    assert all(exact[c].null_pct == close[c].null_pct for c in exact)
    assert abs(close["id"].nunique - 5000) < 500 and exact["id"].nunique == 5000


def test_slices_prune_the_folders_of_a_partitioned_dataset(spark, tmp_path):
    df = K.add_split(spark.range(3000).selectExpr("id", "CAST(id % 7 AS STRING) AS v"), ["id"]).select("v", K.SPLIT, "id")
    plain, _ = D.write_version(df, str(tmp_path / "plain"))
    parted, new = D.write_version(df, str(tmp_path / "parted"), partition=K.SPLIT)
    assert new and parted.record["content_hash"] == plain.record["content_hash"]
    assert parted.load(spark, verify=True).dtypes == df.dtypes
    for split in ("train", "test"):
        a, b = (d.load(spark, split=split) for d in (plain, parted))
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) and 0 < b.count() < 3000
    plan = parted.load(spark, split="test")._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({K.SPLIT}" in plan


@pytest.mark.parametrize("limit", [0.995, 0.5, 0.3, 0.02])
def test_dominant_values_are_exact(spark, limit):
    df = spark.range(4000).selectExpr("id", "IF(id % 3 = 0, NULL, id) AS third", "IF(id % 100 < 51, 'a', CAST(id AS STRING)) AS half",
                                      "IF(id < 3990, 'x', 'y') AS nearly", "'c' AS one", "id % 40 AS even", "CAST(NULL AS STRING) AS nothing")
    want = {r.column: r for r in G.column_stats(df).collect()}
    got = G.dominant_values(df.repartition(7), share_of_rows=limit)
    for c, (n, nulls, top) in got.items():
        assert n == 4000 and nulls / n == want[c].null_pct
        assert (top / n if top else 0) == (want[c].dominance_pct if want[c].dominance_pct >= limit else 0), c
    plan = G.near_constant(df)
    assert {r.column for r in plan.collect()} == {"nearly", "one", "nothing"}
    assert G.near_constant(df.filter("false")).count() == 0


def test_text_parity_sees_what_text_changes(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.1, 'a,"b"'), (2, None, ""), (3, 1e-17, None), (4, 2.5, "x\ny")], "id long, v double, t string")
    score = lambda d: d.selectExpr("id", "coalesce(v, -1D) + CASE WHEN t IS NULL THEN 10 WHEN t = '' THEN 20 ELSE length(t) END AS y_pred")
    assert tuple(E.text_parity(df, score, ["id"], str(tmp_path / "a")).first()) == (4, 4, 0.0, True)
