"""As-of feature table: one row per advance, nothing newer than the advance."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from tidegate.functions import clock, risk, text
from tidegate.operators import bands
from tidegate.operators.latest import account_candidates, best_row, latest_rows
from tidegate.operators.prefix import POS, AsOf, asof_features, attach
from tidegate.session import cut_lineage

TS = "feature_as_of_ts"
BANK = "bank_account_key"
SHORT = tuple(bands.SHORT_BANDS)


def one_identity_per_user(rows: DataFrame, tie: str | None = None) -> DataFrame:
    """Live rows before deleted ones, then the newest."""
    order = ["-CAST(is_deleted AS INT)", "created_time"] + ([tie] if tie else [])
    return best_row(rows, ["user_id"], order).withColumnRenamed("created_time", "identity_created_time")


def account_links(rows: DataFrame, identities: DataFrame, institutions: DataFrame | None = None) -> DataFrame:
    """Newest link per (user, routing, account) with the group's persistent id and the institution's name."""
    newest = best_row(
        rows.filter("routing_number IS NOT NULL AND account_number IS NOT NULL"),
        ["user_id", "routing_number", "account_number"], ["incrementing_id"],
        extra={"__persistent": "max(persistent_account_id)"})
    key = f"concat(CAST(routing_number AS STRING), '-', CAST(account_number AS STRING)) AS {BANK}"
    keep = [c for c in newest.columns if c not in ("persistent_account_id", "__persistent")]
    links = newest.selectExpr(*keep, "__persistent AS persistent_account_id", key).join(identities, "user_id")
    return links if institutions is None else links.join(institutions, "institution_id", "left")


def identity_attributes(identities: DataFrame) -> DataFrame:
    return identities.select(
        "user_id", "identity_created_time",
        text.email_norm(F.col("email")).alias("email_norm"),
        text.phone_norm(F.col("phone_number")).alias("phone_norm"),
        text.address_key(F.col("street"), F.col("zip_code")).alias("address_key"),
    )


def device_links(metadata: DataFrame, identities: DataFrame) -> DataFrame:
    """History collapsed to (user, device) with the first time the pair was seen."""
    first = metadata.filter("device_id IS NOT NULL").groupBy("user_id", "device_id").agg(
        F.min("valid_from").alias("device_valid_from"))
    return first.join(identities.select("user_id", "identity_created_time"), "user_id")


def known_device(metadata: DataFrame, name: str = "device_id") -> AsOf:
    """The device each anchor was on: latest non-null one at the anchor time."""
    return latest_rows(metadata.filter("device_id IS NOT NULL"), "user_id", history_ts="valid_from",
                       ties=["device_id"], as_name="__device", outputs=[f"__device.device_id AS {name}"])


def latest_kyc(kyc: DataFrame) -> AsOf:
    rest = [c for c in kyc.columns if c not in ("user_id", "kyc_created_at", "kyc_id")]
    return latest_rows(kyc, "user_id", history_ts="kyc_created_at", ties=["kyc_id"], values=rest, as_name="__kyc")


def account_users(links: DataFrame) -> AsOf:
    """Sharing of the bank account with its threshold flags and rates."""
    stem, ever = "users_on_bank_account", "users_on_bank_account_lifetime_asof"
    family = bands.shared_users(
        links, BANK, link_ts="link_created_at", identity_ts="identity_created_time",
        bands=bands.USER_BANDS, prefix=stem, lifetime=ever, span=True)
    span = clock.boundaries_between("__first_born", "__last_born", clock.DAY)
    return AsOf(family.changes, family.folds, (
        *family.outputs, *bands.sharing_flags(f"{stem}_72h", ever), *bands.creation_rates(ever, span)))


def earliest_per_user(links: DataFrame, key: str) -> DataFrame:
    """A user counts on ``key`` from the first of their accounts that shows it."""
    return links.filter(f"{key} IS NOT NULL").groupBy(key, "user_id").agg(
        F.min("link_created_at").alias("link_created_at"),
        F.min("identity_created_time").alias("identity_created_time"))


def shared_attributes(anchors: DataFrame, attributes: DataFrame) -> DataFrame:
    """Email, phone and address sharing per anchor, all three in one fold.

    Each attribute becomes rows of one (kind, value) key, so the three shared
    keys cost one shuffle instead of three; counts pivot back by kind.
    """
    kinds = {"email": "email_norm", "phone": "phone_norm", "address": "address_key"}
    tall = "stack(3, " + ", ".join(f"'{k}', concat('{k}:', {c})" for k, c in kinds.items()) + ") AS (kind, value)"
    known = attributes.selectExpr("user_id", "identity_created_time", tall).filter("value IS NOT NULL")
    mine = anchors.select("advance_id", "user_id", TS).join(
        known.select("user_id", "kind", "value"), "user_id")
    family = bands.shared_users(known, "value", link_ts=None, identity_ts="identity_created_time",
                                bands=bands.SHORT_BANDS, prefix="users")
    counted = attach(mine, asof_features(mine, "value", TS, [family]), "value", TS)
    return counted.groupBy("advance_id").agg(*[
        F.expr(f"coalesce(max(IF(kind = '{k}', users_{b}, NULL)), 0L)").alias(f"users_on_{k}_{b}")
        for k in kinds for b in SHORT])


def fan_out_screen(attributes: DataFrame, metadata: DataFrame, top_n: int = 100) -> DataFrame:
    """Per kind (email, phone, address, device) the ``top_n`` values that most users share: (kind, value, n_users).

    All kinds are one tall table: users are counted once per value, and each
    part of a kind ranks its own values before the few that remain meet.
    """
    cells = "stack(3, 'email', email_norm, 'phone', phone_norm, 'address', address_key) AS (kind, value)"
    tall = attributes.selectExpr("user_id", cells).unionByName(
        metadata.selectExpr("user_id", "'device' AS kind", "CAST(device_id AS STRING) AS value"))
    # Distinct pairs first: a value that a third of all rows hold merges before its users meet.
    users = tall.filter("value IS NOT NULL AND user_id IS NOT NULL").distinct().groupBy("kind", "value").agg(F.count("*").alias("n_users"))
    order = (F.desc("n_users"), F.asc("value"))
    dealt = users.withColumn("part", F.pmod(F.xxhash64("value"), F.lit(64)))
    for keys in (["kind", "part"], ["kind"]):
        dealt = dealt.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("place") <= top_n)
    return dealt.select("kind", "value", "n_users")


@dataclass(frozen=True)
class Inputs:
    """Source tables of the feature job.

    ``kyc(user_id, kyc_created_at, kyc_id, ...)``, ``users(user_id, ...)`` with
    one row per user and ``institutions(institution_id, institution_name)`` are
    optional.
    """

    advances: DataFrame
    identity_rows: DataFrame
    link_rows: DataFrame
    metadata: DataFrame
    kyc: DataFrame | None = None
    users: DataFrame | None = None
    institutions: DataFrame | None = None
    identity_tie: str | None = None


def build_features(inputs: Inputs, *, output_start: str | None = None) -> DataFrame:
    """The full as-of feature table, deduplicated to one row per advance.

    Families that share a key are folded together on distinct (key, time) read
    points and joined back; nothing joins anchors to history rows. The frames
    every family reads are written once, which also keeps the remaining plan small.
    """
    identities = cut_lineage(one_identity_per_user(inputs.identity_rows, inputs.identity_tie))
    links = cut_lineage(account_links(inputs.link_rows, identities, inputs.institutions))
    advances, metadata = inputs.advances, inputs.metadata
    amounts = {c: c for c in ("loan_amount", "total_disbursed") if c in advances.columns}
    history = cut_lineage(account_candidates(advances, links))
    anchors, candidates = advances, history
    if output_start is not None:
        start = f"{TS} >= timestamp_ntz'{output_start}'"
        anchors, candidates = anchors.filter(start), candidates.filter(start)

    stem = "users_on_persistent_account_id"
    account = asof_features(candidates, BANK, TS, [
        account_users(links),
        bands.prior_events(history, BANK, event_ts=TS, amounts=amounts),
        bands.min_gap(history, BANK, event_ts=TS),
    ])
    persistent = asof_features(candidates, "persistent_account_id", TS, [bands.shared_users(
        earliest_per_user(links, "persistent_account_id"), "persistent_account_id",
        link_ts="link_created_at", identity_ts="identity_created_time", bands=bands.SHORT_BANDS, prefix=stem)])
    user = asof_features(anchors, "user_id", TS, [
        bands.owned_links(links, "user_id", link_ts="link_created_at", name="bank_accounts_per_user_asof"),
        latest_rows(metadata, "user_id", history_ts="valid_from", ties=["device_id", "ip_address"],
                    outputs=["__row.device_id AS device_id", "__row.ip_address AS ip_address"]),
        known_device(metadata, "known_device_id"),
        *([] if inputs.kyc is None else [latest_kyc(inputs.kyc)]),
    ])
    attributes = identity_attributes(identities)

    # Advance grain first (narrow, one row per advance), then the candidate grain.
    per_advance = cut_lineage(attach(anchors.select("advance_id", "user_id", TS), user, "user_id", TS))
    on_device = asof_features(per_advance, "known_device_id", TS, [bands.shared_users(
        device_links(metadata, identities).withColumnRenamed("device_id", "known_device_id"), "known_device_id",
        link_ts="device_valid_from", identity_ts="identity_created_time", bands=bands.SHORT_BANDS,
        prefix="users_on_device_id")])
    per_advance = attach(per_advance, on_device, "known_device_id", TS,
                         [f"users_on_device_id_{b}" for b in SHORT]).drop("known_device_id", "user_id", TS)
    sharing = shared_attributes(anchors, attributes)
    zero = [f"users_on_{k}_{b}" for k in ("email", "phone", "address") for b in SHORT]

    table = attach(candidates, account, BANK, TS)
    table = attach(table, persistent, "persistent_account_id", TS, [f"{stem}_{b}" for b in SHORT])
    table = _scored(table.join(per_advance, "advance_id", "left"))
    # Dedup before the remaining one-to-one joins: they do not affect the choice.
    kept = one_row_per_advance(table)
    kept = kept.join(sharing, "advance_id", "left").fillna(0, zero)
    kept = kept.join(attributes.drop("identity_created_time"), "user_id", "left")
    if inputs.users is not None:
        kept = kept.join(inputs.users, "user_id", "left")
    return _described(kept)


def _scored(t: DataFrame) -> DataFrame:
    c = F.col
    net = risk.network_score(c("users_on_bank_account_lifetime_asof"), c("bank_accounts_per_user_asof"))
    t = t.withColumn("network_score_asof", net)
    score = risk.heuristic_score(
        c("users_on_bank_account_72h"), c("users_on_bank_account_lifetime_asof"),
        c("avg_users_created_per_month_asof"), c("prior_advances_on_bank_account_72h"),
        c("prior_advances_on_bank_account_7d"), c("network_score_asof"))
    return t.withColumns({
        "heuristic_fraud_score": score,
        "days_since_link_created": F.expr(clock.day_boundaries("link_created_at", TS)),
    })


def _described(t: DataFrame) -> DataFrame:
    weekday = clock.iso_weekday(TS)
    derived = {
        "origination_hour": f"CAST(hour({TS}) AS BIGINT)",
        "origination_day_of_week": weekday,
        "is_weekend_origination": f"CAST({weekday} >= 6 AS BIGINT)",
        "has_persistent_account_id": "CAST(persistent_account_id IS NOT NULL AS BIGINT)",
        "is_joint": "coalesce(CAST(is_joint AS BIGINT), 0L)",
        "days_since_identity_created": clock.day_boundaries("identity_created_time", TS),
        "days_between_identity_and_link_creation": clock.day_boundaries("identity_created_time", "link_created_at"),
        "hours_since_identity_created": clock.hour_boundaries("identity_created_time", TS),
        "network_user_count_asof": "coalesce(users_on_bank_account_lifetime_asof, 0L)",
        "network_account_count_asof": "coalesce(bank_accounts_per_user_asof, 0L)",
        "email_key": "sha2(email_norm, 256)",
        "phone_key": "sha2(phone_norm, 256)",
        "address_node_key": "sha2(address_key, 256)",
        "has_device_id": "CAST(device_id IS NOT NULL AS BIGINT)",
        "has_ip_address": "CAST(ip_address IS NOT NULL AS BIGINT)",
    }
    if "kyc_id" in t.columns:
        derived["has_kyc"] = "CAST(kyc_id IS NOT NULL AS BIGINT)"
        derived["hours_since_kyc_created"] = clock.hour_boundaries("kyc_created_at", TS)
    if "signup_ip" in t.columns:
        derived["signup_ip_matches_latest_ip"] = "coalesce(CAST(signup_ip = ip_address AS BIGINT), 0L)"
    t = t.withColumns({n: F.expr(e) for n, e in derived.items()})
    names = {f"name_match_{p}": text.name_similarity(F.col(f"{p}_name"), F.col(f"matched_{p}_name"))
             for p in ("first", "last") if {f"{p}_name", f"matched_{p}_name"} <= set(t.columns)}
    t = t.withColumns(names) if names else t
    return t.withColumns({
        "network_label": risk.network_label(F.col("network_score_asof"), F.col(BANK)),
        "heuristic_fraud_band": risk.score_band(F.col("heuristic_fraud_score")),
    })


def one_row_per_advance(t: DataFrame) -> DataFrame:
    """Keep the riskiest candidate account of each advance."""
    return best_row(t, ["advance_id"], [
        "users_on_bank_account_lifetime_asof", "users_on_bank_account_72h",
        "prior_advances_on_bank_account_30d", "heuristic_fraud_score",
        "-days_since_link_created", "link_created_at", BANK,
    ])
