"""As-of folds, bands and latest joins against brute force, with one hot key."""

import random
from datetime import datetime, timedelta

import pytest

from tidegate.functions import clock
from tidegate.operators import bands
from tidegate.operators.latest import account_candidates, best_row, latest_rows
from tidegate.operators.prefix import POS, Fold, asof_features, attach, fold_until

T0 = datetime(2026, 1, 1)


def stamp(rng, hours=400):
    return T0 + timedelta(minutes=rng.randrange(hours * 60))


@pytest.mark.parametrize("width", [clock.MINUTE, clock.HOUR, 400 * clock.DAY])
def test_fold_is_the_same_for_any_bucket_width(spark, width):
    rng = random.Random(1)
    changes = [(rng.choice("aaab"), rng.randrange(10**10), rng.randrange(50)) for _ in range(300)]
    reads = [(rng.choice("aabc"), rng.randrange(10**10)) for _ in range(80)]
    c = spark.createDataFrame(changes, f"k string, {POS} long, v long").selectExpr("k", POS, "v AS total", "v AS low", "v AS high")
    r = spark.createDataFrame(reads, f"k string, {POS} long")
    got = {(x.k, x[POS]): (x.total, x.low, x.high) for x in fold_until(
        c, r, ["k"], [Fold("total"), Fold("low", "min"), Fold("high", "max")], width=width).collect()}
    for k, p in reads:
        seen = [v for kk, pp, v in changes if kk == k and pp <= p]
        assert got[(k, p)] == (sum(seen), min(seen, default=None), max(seen, default=None))
    assert len(got) == len(set(reads))


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(2)
    links = {}
    for u in range(60):
        born = stamp(rng)
        for _ in range(rng.randrange(1, 3)):
            links[("hot" if rng.random() < 0.5 else f"k{rng.randrange(5)}", u)] = (stamp(rng), born)
    link_rows = [(k, u, at, born) for (k, u), (at, born) in links.items()]
    anchors = [(i, rng.choice(["hot", "k0", "k1", "k9"]), stamp(rng), round(rng.random() * 300, 2)) for i in range(150)]
    anchors += [(900 + i, "hot", anchors[0][2], 1.0) for i in range(3)]  # equal times
    return (link_rows, anchors,
            spark.createDataFrame(link_rows, "k string, user_id int, linked timestamp_ntz, born timestamp_ntz"),
            spark.createDataFrame(anchors, "id int, k string, ts timestamp_ntz, amount double"))


def test_shared_users(world):
    link_rows, anchors, links, df = world
    family = bands.shared_users(links, "k", link_ts="linked", identity_ts="born", bands=bands.USER_BANDS, prefix="u", lifetime="ever")
    got = {r.id: r for r in attach(df, asof_features(df, "k", "ts", [family]), "k", "ts").collect()}
    for i, k, t, _ in anchors:
        on = [(u, born) for kk, u, at, born in link_rows if kk == k and at <= t and born <= t]
        assert got[i].ever == len(on)
        for name, size in (("72h", 72), ("7d", 168), ("30d", 720)):
            assert got[i][f"u_{name}"] == sum(born >= t - timedelta(hours=size) for _, born in on)


def test_prior_events_and_gap(world):
    _, anchors, _, df = world
    families = [bands.prior_events(df, "k", event_ts="ts", amounts={"amt": "amount"}, bands={"24h": clock.DAY, "30d": 30 * clock.DAY}, prefix="p"),
                bands.min_gap(df, "k", event_ts="ts")]
    got = {r.id: r for r in attach(df, asof_features(df, "k", "ts", families), "k", "ts").collect()}
    for i, k, t, _ in anchors:
        prior = [(s, a) for _, kk, s, a in anchors if kk == k and s < t]
        assert got[i].p_lifetime == len(prior)
        assert got[i].p_24h == sum(s >= t - timedelta(days=1) for s, _ in prior)
        month = [a for s, a in prior if s >= t - timedelta(days=30)]
        assert got[i].prior_amt_sum_30d == pytest.approx(sum(month))
        times = sorted(s for _, kk, s, _ in anchors if kk == k and s <= t)
        gaps = [int(b.timestamp() // 3600 - a.timestamp() // 3600) for a, b in zip(times, times[1:])]
        assert got[i].prior_min_hours_between_advances_on_account == (min(gaps) if gaps else None)


def test_band_edges_are_inclusive_for_identities_and_half_open_for_events(spark):
    t = datetime(2026, 1, 10, 12)
    anchor = spark.createDataFrame([(1, "k", t)], "id int, k string, ts timestamp_ntz")
    links = spark.createDataFrame(
        [("k", 1, t, t), ("k", 2, t - timedelta(hours=72), t - timedelta(hours=72)),
         ("k", 3, t, t - timedelta(hours=72, microseconds=1)), ("k", 4, t + timedelta(microseconds=1), t)],
        "k string, user_id int, linked timestamp_ntz, born timestamp_ntz")
    family = bands.shared_users(links, "k", link_ts="linked", identity_ts="born", bands={"72h": 72 * clock.HOUR}, prefix="u", lifetime="ever")
    row = asof_features(anchor, "k", "ts", [family]).first()
    assert (row.u_72h, row.ever) == (2, 3)
    events = spark.createDataFrame([("k", t), ("k", t - timedelta(hours=24)), ("k", t - timedelta(hours=24, microseconds=1))], "k string, ts timestamp_ntz")
    row = asof_features(anchor, "k", "ts", [bands.prior_events(events, "k", event_ts="ts", bands={"24h": clock.DAY}, prefix="p")]).first()
    assert (row.p_24h, row.p_lifetime) == (1, 2)


def test_latest_and_candidates(spark):
    t = lambda h: T0 + timedelta(hours=h)
    history = spark.createDataFrame([("u", t(1), "a"), ("u", t(3), "b"), ("u", t(3), None), ("u", t(9), "z")], "u string, at timestamp_ntz, d string")
    anchors = spark.createDataFrame([(1, "u", t(0)), (2, "u", t(3)), (3, "u", t(5)), (4, "w", t(5))], "id int, u string, ts timestamp_ntz")
    got = attach(anchors, asof_features(anchors, "u", "ts", [latest_rows(history, "u", history_ts="at", ties=["d"])]), "u", "ts")
    assert {r.id: r.d for r in got.collect()} == {1: None, 2: "b", 3: "b", 4: None}
    best = best_row(history, ["u"], ["at", "d"]).first()
    assert (best.at, best.d) == (t(9), "z")
    advances = spark.createDataFrame([(1, "u", t(5), 1, 2), (2, "u", t(5), None, None), (3, "u", t(5), 1, None), (4, "u", t(0), None, None)],
                                     "id int, user_id string, feature_as_of_ts timestamp_ntz, adv_routing int, adv_account int")
    links = spark.createDataFrame([("u", 1, 2, t(1)), ("u", 3, 4, t(1)), ("u", 5, 6, t(8))],
                                  "user_id string, routing_number int, account_number int, link_created_at timestamp_ntz")
    pairs = {(r.id, r.routing_number) for r in account_candidates(advances, links).collect()}
    assert pairs == {(1, 1), (2, 1), (2, 3)}


def test_hour_boundaries_count_crossings(spark):
    row = spark.sql(f"SELECT {clock.hour_boundaries('a', 'b')} AS h, {clock.day_boundaries('a', 'b')} AS d, "
                    f"{clock.wall_micros('a')} AS m, {clock.micros_to_wall(clock.wall_micros('a'))} = a AS same FROM "
                    "(SELECT timestamp_ntz'1969-12-31 23:50:00.000001' AS a, timestamp_ntz'1970-01-01 00:10:00' AS b)").first()
    assert (row.h, row.d, row.m, row.same) == (1, 1, -599_999_999, True)


def test_fold_shuffles_rows_once_as_they_are(spark):
    """No aggregate keyed by position stands before the shuffle; repeated changes and reads of one position give one row."""
    from tidegate.operators.prefix import Fold, fold_until
    changes = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("a", 11, 4), ("a", 12, 8), ("b", 1, 16)], "k string, __pos long, n long")
    reads = spark.createDataFrame([("a", 1), ("a", 1), ("a", 11), ("a", 25), ("b", 0)], "k string, __pos long")
    out = fold_until(changes, reads, ["k"], [Fold("n")], width=10)
    assert sorted(tuple(r) for r in out.collect()) == [("a", 1, 3), ("a", 11, 7), ("a", 25, 15), ("b", 0, 0)]
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert not any("HashAggregate(keys=[k#" in line and "__pos#" in line.split("functions=")[0] for line in plan.splitlines())


def test_uncovered_time_keeps_spans_as_they_are(spark):
    from tidegate.operators.spans import uncovered_time
    at = lambda s: datetime(2026, 1, 1) + timedelta(seconds=s)
    spans = [("a", 0, 5), ("a", 0, 7), ("a", 2, 6), ("a", 7, 8), ("a", 20, 90), ("a", 20, 21), ("a", 9, 9), ("c", -5, 1)]
    spans = spark.createDataFrame([(k, at(s), at(e)) for k, s, e in spans], "k string, start_ts timestamp_ntz, end_ts timestamp_ntz")
    bounds = spark.createDataFrame([("a", at(0), at(30)), ("b", at(0), at(4)), ("c", at(0), at(2))], "k string, first_ts timestamp_ntz, last_ts timestamp_ntz")
    out = uncovered_time(spans, bounds, "k")
    assert sorted(tuple(r) for r in out.collect()) == [("a", 30.0, 12.0), ("b", 4.0, 4.0), ("c", 2.0, 1.0)]
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert not any("HashAggregate(keys=[k#" in line and "__pos#" in line.split("functions=")[0] for line in plan.splitlines())
