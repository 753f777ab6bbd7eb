"""Toy entity world with hand-checked numbers, and brute-force twins of the replay."""

import random
from datetime import datetime, timedelta

import pytest

from tidegate.graph import components as C, queues as Q, replay, store as S, traverse as T
from tidegate.graph.store import user_pairs
from tidegate.plans.rules import Rule
from tidegate.session import cut_lineage, stored

SCHEMA = ("advance_id string, user_id string, feature_as_of_ts timestamp_ntz, device_id string, bank_account_key string, "
          "loan_amount double, is_fraud int, label_gross_dpd45 int, label_mature_d45 int, expected_dpd45_date timestamp_ntz")


def row(a, u, ts, device=None, bank=None, loan=50.0, fraud=0):
    at = datetime.fromisoformat(ts)
    return (a, u, at, device, bank, loan, fraud, fraud, 1, at + timedelta(days=10) if fraud else None)


WORLD = [
    row("a01", "u1", "2026-01-01T10:00", "d1", fraud=1), row("a02", "u2", "2026-01-02T10:00", "d1", loan=150.0),
    row("a02", "u2", "2026-01-02T10:00", "d1", loan=150.0), row("a03", "u2", "2026-01-03T10:00", None, "b1", loan=150.0),
    row("a04", "u3", "2026-02-01T10:00", None, "b1"), row("a05", "u4", "2026-01-04T10:00", "d4"),
    *[row(f"a{6 + i:02d}", f"u{5 + i}", f"2026-01-{5 + i:02d}T10:00", "dH") for i in range(5)],
    row("a11", "u1", "2026-01-06T11:00", "d1"), row("a12", "u1", "2026-01-07T11:00", "none"),
]
BIG_LOAN = (Rule("big_loan", "review", "draft", "2026-01-01", "toy", ({"column": "loan_amount", "op": ">", "value": 100},)),)


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    return S.build_store(spark.createDataFrame(WORLD, SCHEMA), str(tmp_path_factory.mktemp("store")))


def test_store_counts(world):
    counts = {r.entity_type: (r.edges, r.screened) for r in world.counts.collect()}
    assert counts == {"device": (9, 1), "bank": (2, 0)}
    assert world.edges.count() == 11 and world.users.count() == 9
    hub = world.entities.filter("entity_value = 'dH'").first()
    assert (hub.n_users, hub.n_advances) == (5, 5)


def test_views(world):
    assert S.view(world.edges, degree_cap=4).filter("entity_value = 'dH'").count() == 0
    assert S.view(world.edges, as_of="2026-01-03 10:00:00").count() == 3
    assert S.view(world.edges, window=("2026-01-03 10:00:00", "2026-01-04 10:00:00")).count() == 2
    with pytest.raises(ValueError):
        S.view(world.edges, layers=())
    with pytest.raises(ValueError):
        S.view(world.edges, layers=("nope",))
    with pytest.raises(ValueError):
        S.user_attributes(world.advances, ("nope",))


def test_hops_ring_and_census(world):
    flags = S.user_attributes(world.advances, ("is_fraud",), BIG_LOAN)
    near = T.near_flagged(world.edges, flags.filter("is_fraud = 1"))
    assert {(r.user_id, r.hops, r.nearest_flagged) for r in near.collect()} == {("u2", 1, "u1"), ("u3", 2, "u1")}
    assert T.ring(world.edges, "u1", 1).select("user_id").distinct().count() == 2
    members = C.vertex_components(S.view(world.edges), world.users)
    found = {(r.n_users, r.n_types, r.n_flagged, r.user_ids) for r in C.census(
        members, flags, "is_fraud", with_users=True).collect()}
    assert found == {(5, 1, 0, "u5,u6,u7,u8,u9"), (3, 2, 1, "u1,u2,u3"), (1, 1, 0, "u4")}
    rings = C.census(members, flags, "is_fraud")
    queue = Q.residual_ring_members(members, rings, flags, "is_fraud")
    assert [r.user_id for r in queue.collect()] == ["u2", "u3"]
    both = Q.bad_neighbours(world.edges, flags)
    assert [(r.user_id, r.hops_to_scenario_any, r.hops_to_is_fraud) for r in both.collect()] == [("u3", 1, 2)]


@pytest.mark.parametrize("unit_rows", [500_000, 2])
def test_replay_toy_numbers(world, unit_rows):
    out = {r.advance_id: (r.comp_users, r.comp_types, r.nb_comp, r.nb_d1) for r in replay.leakfree_features(
        world.advances, world.edges, degree_cap=20, unit_rows=unit_rows).collect()}
    assert out["a02"] == (2, 1, 0, 0) and out["a04"] == (3, 2, 1, 0)
    capped = {r.advance_id: (r.comp_users, r.comp_types) for r in replay.leakfree_features(
        world.advances, world.edges, degree_cap=4, unit_rows=unit_rows).collect()}
    assert capped["a07"] == (1, 0)


def test_own_default_is_excluded(spark):
    rows = [row("x1", "uA", "2026-01-01T10:00", "dZ", fraud=1), row("x2", "uA", "2026-01-20T10:00", "dZ"),
            row("x3", "uB", "2026-01-20T11:00", "dZ")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r.advance_id: (r.nb_comp, r.nb_d1) for r in replay.leakfree_features(df, S.build_edges(df), degree_cap=None).collect()}
    assert out["x2"] == (0, 0) and out["x3"] == (1, 1)


def brute_replay(rows):
    """Rebuild the whole graph before every read."""
    seen, out = {}, {}
    for r in rows:
        a = seen.setdefault(r[0], {"user": r[1], "ts": r[2], "ents": set(), "seed": 0, "at": None})
        a["ents"] |= {(t, v) for t, v in (("device", r[3]), ("bank", r[4])) if v}
        a["seed"] = max(a["seed"], r[7])
        a["at"] = min(filter(None, (a["at"], r[9])), default=None)
    events = sorted([(a["ts"], 0, k) for k, a in seen.items()] +
                    [(a["at"], 1, k) for k, a in seen.items() if a["seed"] and a["at"]])
    edges, present, seeded, touch = set(), set(), set(), {}
    for _, kind, k in events:
        a, u = seen[k], seen[k]["user"]
        if kind == 0:
            comp = {("user", u), *a["ents"]}
            while True:
                grown = comp | {x for e in edges for x in e if set(e) & comp}
                if grown == comp:
                    break
                comp = grown
            users = {x[1] for x in comp if x[0] == "user" and x[1] in present}
            types = {x[0] for x in comp if x[0] != "user" and any(x in e for e in edges)} | {t for t, _ in a["ents"]}
            direct = set().union(*[touch.get(e, set()) for e in a["ents"]]) - {u}
            out[k] = (len(users | {u}), len(types), len((users & seeded) - {u}), len(direct))
        if kind == 0 or u not in present:
            edges |= {(("user", u), e) for e in a["ents"]}
            present.add(u)
        if kind == 1:
            seeded.add(u)
            for e in a["ents"]:
                touch.setdefault(e, set()).add(u)
    return out


@pytest.mark.parametrize("unit_rows", [500_000, 12])
def test_replay_matches_brute_force(spark, unit_rows):
    rng = random.Random(7)
    t0 = datetime(2026, 1, 1)
    rows = []
    for i in range(60):
        at = t0 + timedelta(hours=rng.randrange(60))
        bad = rng.random() < 0.4
        seed_at = at + timedelta(hours=rng.randrange(-5, 30)) if rng.random() < 0.9 else None
        rows.append((f"a{i:03d}", f"u{rng.randrange(22)}", at, rng.choice([None, *[f"d{j}" for j in range(9)]]),
                     rng.choice([None, None, *[f"b{j}" for j in range(7)]]), 1.0, int(bad), int(bad), 1, seed_at if bad else None))
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.advance_id: (r.comp_users, r.comp_types, r.nb_comp, r.nb_d1) for r in replay.leakfree_features(
        df, S.build_edges(df), degree_cap=None, unit_rows=unit_rows).collect()}
    assert got == brute_replay(rows)


def test_components_by_rounds_and_by_one_task(spark, monkeypatch):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(190)] + [(1000 + i, 1001 + i) for i in range(60)]
    root = {v: v for link in links for v in link if link[0] != link[1]}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v
    for a, b in links:
        if a != b:
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    want = {v: top(v) for v in root}
    frame = spark.createDataFrame(links, "a long, b long")
    for rest in (200_000, 5, 0):
        monkeypatch.setattr(C, "REST", rest)
        assert {r.vertex: r.component for r in C.contract(frame).collect()} == want
    assert C.contract(frame.filter("false")).count() == 0


def test_projection_of_hubs_in_blocks(spark):
    """A hub dealt to blocks gives every pair once, equal to the plain join; the cap only leaves hubs out."""
    rng = random.Random(2)
    rows = [("device", "hub", u) for u in range(60)] + [("bank", f"b{rng.randrange(12)}", rng.randrange(60)) for _ in range(90)]
    edges = spark.createDataFrame(sorted({(*r, datetime(2026, 1, 1)) for r in rows}), "entity_type string, entity_value string, user_id long, ts timestamp_ntz")
    users = {}
    for t, e, u in set(rows):
        users.setdefault((t, e), set()).add(u)
    want = {}
    for (t, _), us in users.items():
        for a in us:
            for b in us:
                if a < b:
                    n, kinds = want.get((a, b), (0, set()))
                    want[a, b] = (n + 1, kinds | {t})
    want = {k: (n, len(kinds)) for k, (n, kinds) in want.items()}
    for size in (7, 1, 1000):
        got = T.project_users(edges, degree_cap=None, layers=("device", "bank"), block_users=size).collect()
        assert len(got) == len(want) and {(r.user_a, r.user_b): (r.n_shared, r.n_types) for r in got} == want
    capped = T.project_users(edges, degree_cap=20, layers=("device", "bank"), block_users=3)
    assert {(r.user_a, r.user_b) for r in capped.collect()} == {
        (a, b) for us in users.values() if len(us) <= 20 for a in us for b in us if a < b}


def test_direct_seeds_of_advances_with_many_entities(spark):
    """Users met through several entities, by one advance or by several, count once."""
    rng = random.Random(11)
    t0 = datetime(2026, 1, 1)
    kinds = ("device_id", "bank_account_key", "phone_key", "address_key", "persistent_account_id")
    rows = []
    for i in range(150):
        at, bad = t0 + timedelta(hours=rng.randrange(400)), rng.random() < 0.4
        rows.append((f"a{i:03d}", f"u{rng.randrange(30)}", at, *[rng.choice([None, "hub", *[f"x{j}" for j in range(6)]]) for _ in kinds],
                     int(bad), at + timedelta(hours=rng.randrange(1, 90)) if bad else None))
    df = spark.createDataFrame(rows, "advance_id string, user_id string, feature_as_of_ts timestamp_ntz, "
                               + ", ".join(f"{k} string" for k in kinds) + ", label_gross_dpd45 int, expected_dpd45_date timestamp_ntz")
    names = ("device", "bank", "phone", "address", "persistent")
    ents = {r[0]: {(t, v) for t, v in zip(names, r[3:8]) if v} for r in rows}
    want = {r[0]: len({s[1] for s in rows if s[8] and s[9] < r[2] and s[1] != r[1] and ents[s[0]] & ents[r[0]]}) for r in rows}
    for hub_seeds in (0, 8, 100):
        got = replay.leakfree_features(df, S.build_edges(df), degree_cap=None, hub_seeds=hub_seeds)
        assert {r.advance_id: r.nb_d1 for r in got.collect()} == want


def test_large_frames_are_not_checkpointed_as_text(spark, monkeypatch):
    kinds = []
    monkeypatch.setattr(C, "cut_lineage", lambda df: kinds.extend(k for _, k in df.dtypes) or cut_lineage(df))
    rows = spark.createDataFrame([(1, "device", "x"), (1, "device", "x"), (2, "device", "x"), (3, "bank", "y")],
                                 "user_id long, entity_type string, entity_value string")  # rows may repeat
    users = spark.range(1, 5).withColumnRenamed("id", "user_id")
    for rest in (C.REST, 0):  # finished by one task, and in rounds only
        monkeypatch.setattr(C, "REST", rest)
        got = {r.vertex: r.comp_id for r in C.vertex_components(rows, users).collect()}
        assert got == {"user:1": "device:x", "user:2": "device:x", "device:x": "device:x", "user:3": "bank:y", "bank:y": "bank:y", "user:4": "user:4"}
    assert set(kinds) <= {"bigint"}


def test_neighbours_of_several_flags_read_one_set_of_pairs(spark, monkeypatch):
    made = []
    monkeypatch.setattr(T, "user_pairs", lambda edges: made.append(1) or user_pairs(edges))
    rows = spark.createDataFrame([(1, "device", "x"), (2, "device", "x"), (2, "bank", "y"), (3, "bank", "y")], "user_id long, entity_type string, entity_value string")
    flags = spark.createDataFrame([(1, 1, False), (2, 0, False), (3, 0, False)], "user_id long, is_fraud int, scenario_any boolean")
    got = {(r.user_id, r.hops_to_is_fraud, r.hops_to_scenario_any) for r in Q.bad_neighbours(rows, flags).collect()}
    assert got == {("2", 1, None), ("3", 2, None)} and len(made) == 1


def test_replay_rows_are_not_checkpointed(spark, monkeypatch):
    seen = set()
    monkeypatch.setattr(replay, "cut_lineage", lambda df: seen.update(df.columns) or cut_lineage(df))
    adv = spark.createDataFrame(WORLD, SCHEMA)
    assert replay.leakfree_features(adv, S.build_edges(adv), degree_cap=None).count() == len({r[0] for r in WORLD})
    assert seen and not seen & {"bit", "was_seeded"}  # units to halve are listed, not copied


def test_projection_starts_from_entities_of_several_users(spark, monkeypatch):
    """Rows may repeat; entities of one user, however many rows they have, are not written or made distinct."""
    kept = []
    monkeypatch.setattr(T, "stored", lambda df, name: kept.append((name, df.count())) or df, raising=False)
    rows = [("device", "x", 1), ("device", "x", 2), ("device", "x", 2), ("bank", "y", 1), ("bank", "y", 1), ("bank", "z", 3), ("bank", "x", None), ("bank", "x", 4)]
    edges = spark.createDataFrame(rows, "entity_type string, entity_value string, user_id long")
    for cap in (None, 2):
        assert [tuple(r) for r in T.project_users(edges, degree_cap=cap).collect()] == [(1, 2, 1, 1)]
    assert T.project_users(edges, degree_cap=1).count() == 0
    assert kept == [("met", 2)] * 3


def test_entities_and_counts_from_repeated_rows(spark):
    """Nulls are no user and no advance, as in count(DISTINCT); counts need no ready edges."""
    at = [datetime(2026, 1, 1 + i) for i in range(4)]
    rows = [("a1", "u1", "device", "x", at[0]), ("a1", "u1", "device", "x", at[0]), ("a2", "u1", "device", "x", at[1]), ("a2", "u2", "bank", "x", at[1]),
            ("a2", "u3", "bank", "x", at[2]), (None, "u3", "bank", "x", at[3]), ("a3", None, "bank", "y", at[3]), ("a3", "u1", "bank", "y", at[3])]
    edges = spark.createDataFrame(rows, "advance_id string, user_id string, entity_type string, entity_value string, ts timestamp_ntz")
    got = {(r.entity_type, r.entity_value): tuple(r)[2:] for r in S.build_entities(edges).collect()}
    assert got == {("device", "x"): (1, 2, at[0], at[1]), ("bank", "x"): (2, 1, at[1], at[3]), ("bank", "y"): (1, 1, at[3], at[3])}
    adv = spark.createDataFrame(WORLD, SCHEMA)
    assert {tuple(r) for r in S.build_counts(adv).collect()} == {tuple(r) for r in S.build_counts(adv, S.build_edges(adv)).collect()}


def test_ring_leaves_the_graph_as_it_is(world, monkeypatch):
    """Only what the ring reaches is made distinct and written, not the incidences of the whole graph."""
    def whole(edges):
        raise AssertionError("incidences of the whole graph")
    monkeypatch.setattr(T, "user_pairs", whole)
    assert {r.entity_value for r in T.ring(world.edges, "u1", 2).collect()} == {"d1", "b1"}


def test_user_census_equals_the_census_of_all_vertices(spark, monkeypatch):
    """Rows may repeat, by one user or by several; only entities of more than one row are met."""
    rng = random.Random(3)
    rows = [(rng.randrange(60), kind, f"{kind}{rng.randrange(size)}") for kind, size in (("device", 40), ("bank", 300), ("ip", 9)) for _ in range(45)]
    rows = [r for r in rows if r[1] != "ip" or r[0] < 4] + rows[:30] + [(70, "phone", "own"), (70, "phone", "own"), (71, "phone", "alone")]
    edges = spark.createDataFrame(rows, "user_id long, entity_type string, entity_value string")
    flags = spark.createDataFrame([(u, u % 3) for u in range(0, 75, 2)], "user_id long, is_fraud int").selectExpr("user_id", "IF(is_fraud = 1, 1, 0) AS is_fraud")
    users = spark.range(75).withColumnRenamed("id", "user_id")
    linked = []
    contract = C.contract
    monkeypatch.setattr(C, "contract", lambda links: linked.append(links.count()) or contract(links))
    nobody = edges.filter("false")
    for some in (edges, nobody):
        members, rings = C.user_census(some, users, flags, "is_fraud")
        whole = C.vertex_components(some, users)
        want = C.census(whole, flags, "is_fraud")
        assert rings.columns == want.columns and rings.dtypes == want.dtypes
        assert sorted(map(tuple, rings.collect())) == sorted(map(tuple, want.collect()))
        assert sorted(map(tuple, members.select("vertex", "kind", "comp_id").collect())) == sorted(
            map(tuple, whole.filter("kind = 'user'").select("vertex", "kind", "comp_id").collect()))
    seen = [r[1:] for r in rows]
    assert linked[0] == sum(seen.count(e) > 1 for e in seen)


def test_component_queries_link_only_entities_that_meet(spark, monkeypatch):
    """The bulk of the entities has one row: it is counted, not linked."""
    from tidegate import catalog
    from tidegate.catalog import graphs
    sf = "/root/testdata/sf0.001"
    rows = graphs.rows(spark, sf)
    several = rows.groupBy("entity_type", "entity_value").count().filter("count > 1").agg({"count": "sum"}).first()[0] or 0
    linked = []
    contract = C.contract
    monkeypatch.setattr(C, "contract", lambda links: linked.append(links.count()) or contract(links))
    for name in ("h9_component_census", "h13_residual_ring_members"):
        catalog.queries()[name](spark, sf).count()
        spark.catalog.clearCache()
    assert linked == [several] * 2 and several < rows.count() / 10


def test_replay_rows_are_events_and_the_entities_that_link(spark, monkeypatch):
    """An entity of one user is a type of its event, not a row; an advance of several users acts for the first of them."""
    made = []
    monkeypatch.setattr(replay, "stored", lambda df, name: made.append((name, df.count())) or stored(df, name))
    rows = [row("a1", "u1", "2026-01-01T10:00", "d1", "b1"), row("a2", "u2", "2026-01-02T10:00", "d1", "b2"), row("a2", "u2", "2026-01-02T10:00", "d1", "b2"),
            row("a3", "u3", "2026-01-03T10:00", "d3"), row("a4", "u3", "2026-01-04T10:00", "d3", "b3"), row("a5", "u4", "2026-01-05T10:00", "d5")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.advance_id: (r.comp_users, r.comp_types) for r in replay.leakfree_features(df, S.edge_rows(df), degree_cap=20).collect()}
    assert got == {"a1": (1, 2), "a2": (2, 2), "a3": (1, 1), "a4": (1, 2), "a5": (1, 1)}
    assert [n for name, n in made if name == "replay"] == [5 + 2]
    mixed = spark.createDataFrame([row("a1", "u1", "2026-01-01T10:00", fraud=1), row("a1", "u2", "2026-01-01T10:00", "d1", fraud=1),
                                   row("a2", "u2", "2026-01-20T10:00", "d1"), row("a3", None, "2026-01-21T10:00", "d1")], SCHEMA)
    for cap, want in ((None, (2, 1, 1, 1)), (2, (2, 1, 1, 1)), (1, (1, 0, 0, 0)), (0, (1, 0, 0, 0))):  # d1 counts u2 and a missing user
        out = {r.advance_id: tuple(r)[3:] for r in replay.leakfree_features(mixed, S.edge_rows(mixed), degree_cap=cap).collect()}
        assert out["a2"] == want and set(out) == {"a1", "a2"}
