"""Rules, validation statistics, metrics, ranking and encoders with hand-checked numbers."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidegate.operators import quantiles, ranking
from tidegate.plans import backtest, discovery as D, evaluation as E, models as M, rules as R

RULE_FRAME = ("advance_id string, feature_as_of_ts string, identity_created_time string, loan_amount double, prior_advances_on_bank_account_7d int, "
              "users_on_bank_account_72h int, users_on_persistent_account_id_72h int, is_joint int, users_on_device_id_72h int")


def rule_row(spark, **change):
    base = dict(advance_id="a0", feature_as_of_ts="2026-01-15 12:00:00", identity_created_time="2026-01-15 00:00:00", loan_amount=150.0,
                prior_advances_on_bank_account_7d=2, users_on_bank_account_72h=0, users_on_persistent_account_id_72h=0, is_joint=0,
                users_on_device_id_72h=0)
    return spark.createDataFrame([tuple({**base, **change}.values())], RULE_FRAME)


@pytest.mark.parametrize("change,fired", [
    ({}, ["ring_account_reuse"]),
    ({"identity_created_time": "2026-01-14 12:00:00"}, ["ring_account_reuse"]),
    ({"identity_created_time": "2026-01-14 11:59:59"}, []),
    ({"identity_created_time": None}, []),
    ({"loan_amount": 100.0}, []),
    ({"loan_amount": None}, []),
    ({"prior_advances_on_bank_account_7d": 0, "users_on_bank_account_72h": 3}, ["ring_identity_burst"]),
    ({"loan_amount": 1.0, "users_on_persistent_account_id_72h": 2}, ["ring_shared_persistent_account"]),
    ({"loan_amount": 1.0, "users_on_persistent_account_id_72h": 2, "is_joint": 1}, []),
    ({"loan_amount": 1.0, "users_on_persistent_account_id_72h": 2, "is_joint": None}, ["ring_shared_persistent_account"]),
    ({"loan_amount": 1.0, "users_on_device_id_72h": 3}, ["ring_device_burst"]),
])
def test_registered_rules(spark, change, fired):
    row = R.with_flags(rule_row(spark, **change), R.REGISTERED).first()
    assert [r.name for r in R.REGISTERED if row[r.flag_name]] == fired
    assert row.scenario_any == bool(fired)


def test_rule_documents():
    good = {"name": "r", "tier": "review", "status": "draft", "entry_date": "2026-01-01", "theory": "t",
            "trigger": [{"column": "x", "op": ">", "value": 1}]}
    version, rules = R.parse_rules({"version": "1", "scenarios": [good]})
    assert version == "1" and rules[0].columns == ("x",)
    assert R.parse_rules({"version": "1"}) == ("1", ())
    with pytest.raises(ValueError, match="version"):
        R.parse_rules({"scenarios": [good]})
    with pytest.raises(ValueError, match="theory"):
        R.parse_rules({"version": "1", "scenarios": [{**good, "theory": ""}]})
    for spec in ({"column": "x", "op": "~", "value": 1}, {"column": "x", "op": ">"}, {"column": "x", "op": "is_null", "value": 1},
                 {"op": ">", "value": 1}, {"hours_between": ["a"], "op": "<", "value": 1}):
        with pytest.raises(ValueError):
            R.parse_rules({"version": "1", "scenarios": [{**good, "trigger": [spec]}]})[1][0].flag()


def test_not_equal_keeps_nulls_and_no_rules_match_nothing(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    rule = R.Rule("ne", "t", "s", "d", "t", ({"column": "x", "op": "!=", "value": 1},))
    assert [r.scenario_ne for r in R.with_flags(df, [rule]).collect()] == [False, True]
    assert R.with_flags(df, []).filter("scenario_any").count() == 0 and R.residual(df, []).count() == 2


def test_validation_statistics(spark):
    rows = [(1, 1, "LOW", 1, 0, 1), (1, 0, "LIKELY", 1, 1, 1), (0, 1, "LOW", 0, 1, 1), (0, 0, "ODD", 0, None, 0)]
    df = spark.createDataFrame(rows, "a int, b int, heuristic_fraud_band string, label_gross_dpd45 int, label_repaid_current_snapshot int, label_mature_d45 int")
    rules = [R.Rule(n, "t", "s", "d", "t", ({"column": n, "op": "==", "value": 1},)) for n in ("a", "b")]
    cube = R.outcome_cube(df, rules)
    a = R.rule_stats(cube, rules).filter("scenario = 'a'").first()
    assert (a.n, a.share, a.n_mature, a.n_never_paid, a.n_resolved, a.never_paid_rate, a.n_dpd45) == (2, 0.5, 2, 1, 2, 0.5, 2)
    assert (a.unique_n, a.unique_never_paid_rate) == (1, 0.0) and a.lift_vs_base == pytest.approx(0.5 / (1 / 3))
    assert {(r.pair, r.n) for r in R.rule_overlaps(cube, rules).collect()} == {("a & b", 1), ("*", 1)}
    assert {r.band: r.n_left for r in R.band_stats(cube).collect()} == {"*": 1, "LOW": 0, "LIKELY": 0, "ODD": 1}
    report = backtest.band_by_month(df.withColumn("feature_as_of_ts", F.lit("2026-01-05").cast("timestamp_ntz")).withColumn("loan_amount", F.lit(10.0)))
    assert [r.scenario for r in report.collect()] == ["LIKELY", "LOW", "ODD"]


BANDS = ["EXTREMELY_LIKELY", "LOW", "LIKELY", "POSSIBLE", *["LOW"] * 6]


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(i, [1, 0, 1, *[0] * 7][i], BANDS[i], [1, 1, *[0] * 7, 1][i], [*[1] * 9, 0][i], 0.0 if i else 0.0,
             [.95, .9, .8, .7, .6, .5, .4, .3, .2, .1][i]) for i in range(10)]
    return spark.createDataFrame(rows, "id int, is_fraud int, heuristic_fraud_band string, label_gross_dpd45 int, label_mature_d45 int, "
                                       "label_repaid_current_snapshot double, score double")


def test_depth_band_and_outcome_metrics(scored):
    d = E.depth_records(scored, "score", "is_fraud = 1", "id", (0.2,)).first()
    assert (d.n_reviewed, d.true_positives, d.precision, d.recall, d.fp_per_tp) == (2, 1, 0.5, 0.5, 1.0)
    report = {r.band: r for r in E.band_report(scored, "score", "heuristic_fraud_band", "id", (0.2,)).collect()}
    assert list(report) == ["LOW", "POSSIBLE", "LIKELY", "EXTREMELY_LIKELY"]
    assert report["LOW"].n == 7 and report["LOW"]["n_in_top_0.2"] == 1 and report["EXTREMELY_LIKELY"].mean_score_percentile == 100.0
    early = E.early_default_capture(scored, "score", "id", (0.2,)).first()
    assert (early.n_reviewed, early.true_positives) == (2, 2)
    assert E.outcome_average_precision(scored, "score").first()[0] == pytest.approx(1.0)
    assert E.outcome_average_precision(scored.withColumn("label_gross_dpd45", F.lit(0)), "score").first()[0] == 0.0
    assert E.early_default_capture(scored.withColumn("label_mature_d45", F.lit(0)), "score", "id").count() == 0
    with pytest.raises(ValueError):
        E.depth_records(scored, "score", "is_fraud = 1", "id", (0.0,))


def test_curve_is_exact_across_score_ranges(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, round(rng.random(), 2), int(rng.random() < 0.3)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, s double, y int")
    pos, neg = [s for _, s, y in rows if y], [s for _, s, y in rows if not y]
    want = sum((p > q) + (p == q) / 2 for p in pos for q in neg) / len(pos) / len(neg)
    assert E.auc(df, "s", "y = 1").first()[0] == pytest.approx(want)
    monkeypatch.setattr(ranking, "SCORE_RANGES", 16)
    assert E.auc(df, "s", "y = 1").first()[0] == pytest.approx(want)
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    for k in (1, 37, 250, 500, 900):
        got = {r.id for r in D.top_rows(df, "s", "id", k).collect()}
        assert got == {r[0] for r in order[:k]}
    # Keys of text, with cuts inside ties: ties fall by the order of the text.
    named = df.selectExpr("concat('adv_', id) AS id", "round(s, 1) AS s")
    lines = named.collect()
    order = sorted(((r.id, r.s) for r in lines), key=lambda r: (-r[1], r[0]))
    for k in (1, 37, 250, 499):
        assert {r.id for r in D.top_rows(named, "s", "id", k).collect()} == {r[0] for r in order[:k]}
    sample = sorted(s for _, s, _ in rows)
    spot = 0.37 * 499
    want = sample[int(spot)] + (spot - int(spot)) * (sample[int(spot) + 1] - sample[int(spot)])
    assert quantiles.exact_quantiles(df, ["s"], [0.37, 1.0])["s"] == pytest.approx([want, sample[-1]])


def test_one_class_has_no_auc_and_specs_check_their_inputs(scored):
    assert E.auc(scored, "score", "false").first()[0] is None
    spec = E.EvalSpec((E.Metric("auc", lambda d: E.auc(d, "score", "false")),), primary="auc")
    with pytest.raises(ValueError, match="finite"):
        spec.evaluate(scored)
    with pytest.raises(ValueError, match="missing"):
        E.EvalSpec((E.Metric("m", lambda d: d, ("nope",)),)).evaluate(scored)
    side = scored.selectExpr("id", "score * 2 AS extra")
    assert E.join_augmentation(scored, side, ["id"]).filter("extra is null").count() == 0
    with pytest.raises(ValueError, match="repeats"):
        E.join_augmentation(scored, scored, ["id"])
    with pytest.raises(ValueError, match="duplicate"):
        E.join_augmentation(scored, side.unionByName(side), ["id"])


def test_batch_evaluation_reuses_a_label(scored, tmp_path):
    calls = []

    def model(df):
        calls.append(1)
        return df.withColumn("y_pred", F.col("score"))

    spec = E.EvalSpec((E.Metric("auc", lambda d: E.auc(d, "y_pred", "is_fraud = 1")),), primary="auc")
    first = E.evaluate(scored, model, spec, str(tmp_path), ["id"], "holdout")
    assert first == E.evaluate(scored, model, spec, str(tmp_path), ["id"], "holdout") and len(calls) == 1
    assert first["auc"][0]["auc"] == pytest.approx(15 / 16)


def test_woe_values(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 0), (None, 1)], "c string, y int")
    fitted = M.fit_woe(df, "c", "y = 1")
    got = {r.c: r.woe for r in M.apply_woe(spark.createDataFrame([("a",), ("b",), (None,), ("new",)], "c string"), fitted, "c").collect()}
    logit = lambda p: math.log(p / (1 - p))
    assert got["a"] == pytest.approx(logit(0.5)) and got["b"] == pytest.approx(logit(0.25))
    assert got[None] == pytest.approx(logit(0.75)) and got["new"] == pytest.approx(logit(2.5 / 5))


def test_subgroup_search_matches_brute_force(spark):
    rng = random.Random(5)
    rows = [tuple(int(rng.random() < 0.5) for _ in range(4)) + (int(rng.random() < 0.3), int(rng.random() < 0.7)) for _ in range(400)]
    df = spark.createDataFrame(rows, "a int, b int, c int, d int, y int, tr int")
    got = {g.conditions: g for g in D.subgroup_search(df, D.build_selectors(df, binary=["a", "b", "c", "d"]), outcome="y = 1", is_train="tr = 1",
                                                      depth=2, min_support=10, min_test=5)}
    for conds, g in got.items():
        at = ["abcd".index(c[0]) for c in conds]
        hit = [r for r in rows if all(r[i] for i in at)]
        train, test = [r[4] for r in hit if r[5]], [r[4] for r in hit if not r[5]]
        assert (g.n_train, g.n_test) == (len(train), len(test)) and g.test_rate == pytest.approx(sum(test) / len(test))
    assert len(got) == 10


def test_isolation_forest_ranks_outliers_first_and_repeats(spark):
    rng = random.Random(6)
    rows = [(i, rng.gauss(0, 1), None if i % 50 == 3 else rng.gauss(0, 1)) for i in range(600)] + [(1000 + i, 9.0 + i, -9.0) for i in range(3)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    score = M.fit_isolation_forest(df, ["x", "y"], "id", trees=40)
    got = {r.id: r.y_pred for r in score(df).collect()}
    assert set(sorted(got, key=got.get, reverse=True)[:3]) == {1000, 1001, 1002}
    again = {r.id: r.y_pred for r in M.fit_isolation_forest(df.repartition(3), ["x", "y"], "id", trees=40)(df).collect()}
    assert got == again
