"""Declarative rules ("scenarios") compiled to boolean columns, and their statistics."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.functions import clock
from tidegate.functions.predicates import OPERATORS, SPELLINGS, compare_flag

# What a condition can test: the columns it reads, and the expression over them.
# Text timestamps are read like real ones; unreadable text is null.
SUBJECTS = {
    "column": lambda named: ((named,), F.col(named)),
    "hours_between": lambda named: (tuple(named), F.expr(clock.hours_between(*(f"try_cast({c} AS TIMESTAMP_NTZ)" for c in named)))),
}
# The operator spellings of rule documents.
RULE_OPS = ("==", "!=", "<", "<=", ">", ">=", "isin", "notin", "is_null", "not_null")


@dataclass(frozen=True)
class Condition:
    """One line of a rule: a subject, an operator and its operand."""

    subject: str
    of: Any
    op: str
    value: Any = None

    @classmethod
    def read(cls, line: Mapping[str, Any]) -> Condition:
        """The condition a document line states; every fault of the line is reported at once."""
        subjects = [k for k in SUBJECTS if k in line]
        op = line.get("op")
        takes = OPERATORS[SPELLINGS.get(op, op)].takes if op in RULE_OPS else None
        faults = {
            "one subject, column or hours_between": len(subjects) != 1,
            "two columns for hours_between": subjects == ["hours_between"] and (
                isinstance(line["hours_between"], str) or len(list(line["hours_between"])) != 2),
            f"an operator of {', '.join(RULE_OPS)}": takes is None,
            "a value": takes in ("scalar", "list") and "value" not in line,
            "no value": takes == "nothing" and "value" in line,
        }
        wanted = [text for text, fault in faults.items() if fault]
        if wanted:
            raise ValueError(f"condition {dict(line)} should have: {'; '.join(wanted)}")
        of = line[subjects[0]]
        return cls(subjects[0], of if isinstance(of, str) else tuple(of), op, line.get("value"))

    @property
    def columns(self) -> tuple[str, ...]:
        return SUBJECTS[self.subject](self.of)[0] if self.subject != "column" else (self.of,)

    def flag(self) -> Column:
        return compare_flag(SUBJECTS[self.subject](self.of)[1], self.op, self.value)


@dataclass(frozen=True)
class Rule:
    """A trigger (all conditions hold) with optional releases (any one lets the row go)."""

    name: str
    tier: str
    status: str
    entry_date: str
    theory: str
    trigger: tuple[Mapping[str, Any], ...]
    disqualifiers: tuple[Mapping[str, Any], ...] = ()
    title: str = ""
    typology: str = ""

    def __post_init__(self) -> None:
        if not self.trigger:
            raise ValueError(f"{self.name} has an empty trigger")

    @property
    def flag_name(self) -> str:
        return f"scenario_{self.name}"

    def _conditions(self, lines: Sequence[Mapping[str, Any]]) -> list[Condition]:
        return [Condition.read(line) for line in lines]

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(c for x in self._conditions([*self.trigger, *self.disqualifiers]) for c in x.columns))

    def flag(self) -> Column:
        """All of the trigger and none of the releases."""
        held = [c.flag() for c in self._conditions(self.trigger)] + [~c.flag() for c in self._conditions(self.disqualifiers)]
        return reduce(lambda a, b: a & b, held)


# How a rule document's entries become the fields of a rule: (needed, reader).
ENTRIES = {
    "name": (True, str), "tier": (True, str), "status": (True, str), "entry_date": (True, str), "theory": (True, lambda v: str(v).strip()),
    "trigger": (True, tuple), "disqualifiers": (False, tuple), "title": (False, str), "typology": (False, str),
}


def parse_rules(document: Mapping[str, Any]) -> tuple[str, tuple[Rule, ...]]:
    """(version, rules) of a rule document whose entries and conditions are complete."""
    if not document.get("version"):
        raise ValueError("a rule document states its version")
    rules = []
    for entry in document.get("scenarios") or ():
        given = {k: read(entry[k]) for k, (_, read) in ENTRIES.items() if entry.get(k)}
        absent = sorted(k for k, (needed, _) in ENTRIES.items() if needed and k not in given)
        if absent:
            raise ValueError(f"rule {entry.get('name')!r} lacks {', '.join(absent)}")
        rule = Rule(**{"title": given["name"], **given})
        rule.columns  # reads, and so checks, every condition
        rules.append(rule)
    return str(document["version"]), tuple(rules)


def load_rules(path: str | Path) -> tuple[str, tuple[Rule, ...]]:
    """Rules from a JSON file, or the first document of a YAML file where PyYAML is installed."""
    body = Path(path).read_text()
    if str(path).endswith(".json"):
        return parse_rules(json.loads(body))
    import yaml
    return parse_rules(next(iter(yaml.safe_load_all(body)), None) or {})


# The registered rules.
REGISTERED_VERSION = "2026-06-08.2"
REGISTERED = (
    Rule(
        "ring_account_reuse", "block", "draft", "2026-06-06",
        "A day-old identity takes a sizable advance on an account others drew through within a week.",
        ({"hours_between": ["feature_as_of_ts", "identity_created_time"], "op": "<=", "value": 24},
         {"column": "loan_amount", "op": ">", "value": 100},
         {"column": "prior_advances_on_bank_account_7d", "op": ">", "value": 0})),
    Rule(
        "ring_identity_burst", "block", "draft", "2026-06-06",
        "Three identities created within 72 hours point at the same account.",
        ({"column": "users_on_bank_account_72h", "op": ">=", "value": 3},)),
    Rule(
        "ring_shared_persistent_account", "block", "draft", "2026-06-08",
        "Two fresh identities draw on one real account within 72 hours.",
        ({"column": "users_on_persistent_account_id_72h", "op": ">=", "value": 2},),
        ({"column": "is_joint", "op": "==", "value": 1},)),
    Rule(
        "ring_device_burst", "block", "draft", "2026-06-08",
        "One device enrols three identities created within 72 hours.",
        ({"column": "users_on_device_id_72h", "op": ">=", "value": 3},)),
)


def any_flag(rules: Sequence[Rule]) -> Column:
    return reduce(lambda a, b: a | b, [r.flag() for r in rules]) if rules else F.lit(False)


def with_flags(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``scenario_<name>`` per rule and ``scenario_any``."""
    flagged = df.select("*", *[r.flag().alias(r.flag_name) for r in rules])
    names = [r.flag_name for r in rules]
    return flagged.withColumn("scenario_any", F.expr(" OR ".join(names)) if names else F.lit(False))


def residual(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows no rule matched."""
    return df.filter(~any_flag(rules))


# ---- validation statistics -------------------------------------------------

OUTCOMES = {
    "n": "1",
    "n_mature": "mature",
    "n_dpd45": "mature AND dpd45",
    "n_never_paid": "mature AND dpd45 AND not_repaid",
    "n_resolved": "repaid OR (mature AND dpd45)",
}


def outcome_cube(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Outcome counts per (band, combination of fired rules).

    At most bands x 2^rules rows whatever the size of the input: one scan with
    map-side combine, and every statistic below is a sum over this table.
    """
    labels = {
        "mature": "coalesce(label_mature_d45 = 1, false)",
        "dpd45": "coalesce(label_gross_dpd45 = 1, false)",
        "not_repaid": "coalesce(label_repaid_current_snapshot = 0, false)",
        "repaid": "coalesce(label_repaid_current_snapshot = 1, false)",
    }
    flags = [r.flag_name for r in rules]
    rows = with_flags(df, rules).selectExpr(
        "CAST(heuristic_fraud_band AS STRING) AS band", *flags, "scenario_any",
        *[f"{e} AS {n}" for n, e in labels.items()])
    counts = [F.expr("count(1)" if e == "1" else f"count_if({e})").alias(n) for n, e in OUTCOMES.items()]
    cube = rows.groupBy("band", *flags, "scenario_any").agg(*counts)
    fired = " + ".join(f"CAST({f} AS INT)" for f in flags) or "0"
    return cube.withColumn("n_fired", F.expr(fired))


def _block(where: str = "true") -> list[Column]:
    return [F.expr(f"coalesce(sum(IF({where}, {n}, 0L)), 0L)").alias(n) for n in OUTCOMES]


_RATES = ("n_never_paid / nullif(n_resolved, 0) AS never_paid_rate",)


def overall_stats(cube: DataFrame) -> DataFrame:
    """Outcome block of the union, the LOW-band discovery slice and the residual."""
    scopes = {"union": "scenario_any", "discovery": "scenario_any AND band = 'LOW'", "residual": "NOT scenario_any"}
    blocks = [cube.agg(*_block(w), F.sum("n").alias("n_rows")).withColumn("scope", F.lit(s)) for s, w in scopes.items()]
    return reduce(DataFrame.unionByName, blocks).selectExpr(
        "scope", "n", "n / nullif(n_rows, 0) AS share", "n_mature", "n_never_paid", "n_resolved", *_RATES)


def band_stats(cube: DataFrame) -> DataFrame:
    """Baseline block per band, with the rows rules left behind and their coverage; '*' is all bands."""
    keyed = cube.withColumn("band", F.explode(F.array("band", F.lit("*"))))
    per_band = keyed.groupBy("band").agg(*_block(), F.expr("sum(IF(scenario_any, n, 0L))").alias("captured"))
    # One line per band; the '*' line holds the row total.
    return per_band.withColumn("n_rows", F.expr("max(IF(band = '*', n, NULL)) OVER ()")).selectExpr(
        "band", "n", "n / nullif(n_rows, 0) AS share", "n_mature", "n_never_paid", "n_resolved", *_RATES,
        "n_dpd45 / nullif(n_mature, 0) AS dpd45_rate", "n - captured AS n_left",
        "captured / nullif(n, 0) AS coverage")


def rule_stats(cube: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Per rule: gross and unique capture, outcome rates and lift over the baseline."""
    parts = []
    for rule in rules:
        unique = f"{rule.flag_name} AND n_fired = 1"
        parts.append(cube.agg(
            *_block(rule.flag_name),
            F.expr(f"coalesce(sum(IF({unique}, n, 0L)), 0L)").alias("unique_n"),
            F.expr(f"sum(IF({unique}, n_never_paid, 0L)) / nullif(sum(IF({unique}, n_resolved, 0L)), 0)")
            .alias("unique_never_paid_rate"),
            F.sum("n").alias("n_rows"),
            F.expr("sum(n_never_paid) / nullif(sum(n_resolved), 0)").alias("base_rate"),
        ).withColumn("scenario", F.lit(rule.name)))
    return reduce(DataFrame.unionByName, parts).selectExpr(
        "scenario", "n", "n / nullif(n_rows, 0) AS share", "n_mature", "n_never_paid", "n_resolved", *_RATES,
        "n_dpd45", "n_dpd45 / nullif(n_mature, 0) AS dpd45_rate",
        "(n_never_paid / nullif(n_resolved, 0)) / nullif(base_rate, 0D) AS lift_vs_base",
        "unique_n", "unique_never_paid_rate")


def rule_bands(cube: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows per (rule, band), non-empty cells only."""
    stacked = ", ".join(f"'{r.name}', {r.flag_name}" for r in rules)
    return cube.selectExpr("band", "n", f"stack({len(rules)}, {stacked}) AS (scenario, fired)").filter(
        "fired").groupBy("scenario", "band").agg(F.sum("n").alias("n"))


def rule_overlaps(cube: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows matched by both rules of each pair (non-zero pairs) and by more than one rule ('*')."""
    pairs = [(a, b) for i, a in enumerate(rules) for b in rules[i + 1:]]
    cells = [f"'{a.name} & {b.name}', {a.flag_name} AND {b.flag_name}" for a, b in pairs] + ["'*', n_fired > 1"]
    return cube.selectExpr("n", f"stack({len(cells)}, {', '.join(cells)}) AS (pair, both)").filter("both").groupBy(
        "pair").agg(F.sum("n").alias("n"))


def identified_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rule outcomes over *mature* rows (a different denominator from :func:`rule_stats`)."""
    return rule_stats(outcome_cube(df, rules), rules).selectExpr(
        "scenario", "n", "n_mature", "n_never_paid", "n_never_paid / nullif(n_mature, 0) AS never_paid_rate")
