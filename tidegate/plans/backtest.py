"""Monthly rule backtest and band-by-month report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidegate.functions import clock
from tidegate.operators import bands
from tidegate.operators.latest import account_candidates, best_row
from tidegate.operators.prefix import asof_features, attach
from tidegate.plans.features import BANK, TS, account_links, one_identity_per_user
from tidegate.plans.rules import Rule, with_flags
from tidegate.session import share

REPORT_BANDS = ("EXTREMELY_LIKELY", "LIKELY", "POSSIBLE", "LOW")
MATURED, DPD, REPAID = "label_mature_d45 = 1", "label_gross_dpd45 = 1", "label_repaid_current_snapshot = 1"
NEVER = f"{MATURED} AND {DPD} AND NOT ({REPAID})"
RESOLVED = f"{REPAID} OR ({MATURED} AND {DPD})"


def _measures(stem: str, when: str) -> list[str]:
    return [
        f"count_if({when}) AS {stem}_n",
        f"sum(IF({when}, loan_amount, 0D)) AS {stem}_loan",
        f"count_if({when} AND {MATURED}) AS {stem}_matured",
        f"count_if({when} AND {MATURED} AND {DPD}) AS {stem}_dpd",
        f"count_if({when} AND {NEVER}) AS {stem}_never",
        f"count_if({when} AND ({RESOLVED})) AS {stem}_resolved",
        f"sum(IF({when} AND {NEVER}, loan_amount, 0D)) AS {stem}_principal",
    ]


_FIELDS = ("n", "loan", "matured", "dpd", "never", "resolved", "principal")

_REPORT = (
    "advance_month", "scenario", "b_n AS n_advances", "s_n AS n_scenario", "s_n / nullif(b_n, 0) AS scenario_rate",
    "b_loan AS total_loan_disbursed", "s_loan AS scenario_loan_disbursed", "s_matured AS n_matured",
    "s_dpd AS n_dpd45", "s_dpd / nullif(s_matured, 0) AS dpd45_rate",
    "b_dpd / nullif(b_matured, 0) AS baseline_dpd45_rate",
    "s_never / nullif(s_resolved, 0) AS scenario_never_paid_rate",
    "b_never / nullif(b_resolved, 0) AS baseline_never_paid_rate",
    "s_principal AS scenario_never_paid_principal", "b_principal AS baseline_never_paid_principal",
)


def monthly_rule_report(df: DataFrame, rules: Sequence[Rule], ts: str = TS) -> DataFrame:
    """Long month x rule report with month-wide baselines.

    One scan and one aggregate per month with conditional measures per rule; only
    the month rows are then stacked to the long form.
    """
    names = [*[r.flag_name for r in rules], "scenario_any"]
    flagged = with_flags(df, rules).withColumn("advance_month", F.expr(f"trunc(CAST({ts} AS DATE), 'MM')"))
    # A release or trigger flag is never null, so conditional measures need no guard.
    wide = flagged.groupBy("advance_month").agg(
        *[F.expr(m) for m in _measures("b", "true")],
        *[F.expr(m) for i, n in enumerate(names) for m in _measures(f"s{i}", n)])
    labels = [n.removeprefix("scenario_") if n != "scenario_any" else n for n in names]
    cells = [c for i, label in enumerate(labels) for c in (f"'{label}'", *[f"s{i}_{f}" for f in _FIELDS])]
    return wide.selectExpr(
        "advance_month", *[f"b_{f}" for f in _FIELDS],
        f"stack({len(names)}, {', '.join(cells)}) AS (scenario, {', '.join('s_' + f for f in _FIELDS)})",
    ).selectExpr(*_REPORT).orderBy("advance_month", "scenario")


def band_by_month(df: DataFrame, ts: str = TS) -> DataFrame:
    """The same report with heuristic bands in place of rules; baselines are window totals."""
    per_band = df.groupBy(
        F.expr(f"trunc(CAST({ts} AS DATE), 'MM')").alias("advance_month"),
        F.col("heuristic_fraud_band").alias("scenario"),
    ).agg(*[F.expr(m) for m in _measures("s", "true")])
    totals = [f"sum(s_{f}) OVER (PARTITION BY advance_month) AS b_{f}" for f in _FIELDS]
    order = F.array_position(F.array(*map(F.lit, REPORT_BANDS)), F.col("scenario"))
    rank = F.when(order > 0, order).otherwise(len(REPORT_BANDS) + 1)
    return per_band.selectExpr("*", *totals).selectExpr(*_REPORT).orderBy("advance_month", rank)


def backtest_rows(
    advances: DataFrame,
    identity_rows: DataFrame,
    link_rows: DataFrame,
    *,
    start: str,
    end: str,
    buffer_days: int = 8,
    identity_tie: str | None = None,
) -> DataFrame:
    """Advances of ``[start, end)`` with the two windowed features the monthly rules read.

    Work shrinks before it grows: accounts touched by users in the buffered
    window are found first, link and identity history is semi-joined to them,
    and only then deduplicated and folded.
    """
    history = share(advances.filter(
        f"{TS} >= timestamp_ntz'{start}' - INTERVAL {buffer_days} DAYS AND {TS} < timestamp_ntz'{end}'"))
    account = ["routing_number", "account_number"]
    named = link_rows.filter(" AND ".join(f"{c} IS NOT NULL" for c in account))
    touched = named.join(history.select("user_id").distinct(), "user_id", "left_semi").select(*account).distinct()
    scoped = share(named.join(touched, account, "left_semi"))
    identities = one_identity_per_user(
        identity_rows.join(scoped.select("user_id").distinct(), "user_id", "left_semi"), identity_tie)
    links = share(account_links(scoped, identities.select("user_id", "identity_created_time")))
    mapped = share(account_candidates(history, links))
    anchors = mapped.filter(f"{TS} >= timestamp_ntz'{start}'")
    families = [
        bands.shared_users(links, BANK, link_ts="link_created_at", identity_ts="identity_created_time",
                           bands={"72h": 72 * clock.HOUR}, prefix="users_on_bank_account"),
        bands.prior_events(mapped, BANK, event_ts=TS, bands={"7d": 7 * clock.DAY}),
    ]
    features = asof_features(anchors, BANK, TS, families).select(
        BANK, "__pos", "users_on_bank_account_72h", "prior_advances_on_bank_account_7d")
    return best_row(attach(anchors, features, BANK, TS), ["advance_id"], [
        "users_on_bank_account_72h", "prior_advances_on_bank_account_7d", "link_created_at", BANK])
