"""Quality rules: word statistics of whole texts and a decision list learned from labels.

``text_statistics`` measures every text once. ``learn_list`` grows threshold
conjunctions by sequential covering (each condition maximises the information
gain over two thirds of the labelled rows), prunes each on the remaining third,
and keeps it while it is precise. ``as_column`` turns the list into an ordered
Spark conditional, so applying it needs no Python.

The list is fitted on a sample of at most ``FIT_ROWS`` labelled rows; statistics
and verdicts cover all rows.

Defined cases. A null, empty or blank text has no words: all its statistics are 0
and it fails the word minimum. Null labels and labels without a document are
ignored. With labels of one class only, or none, the list is empty and only the
fixed limits reject. Repeated rows are judged alike; null ids are kept as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm.common import SPACES, bounded_sample, text_slices
from tidegate.session import cut_lineage

FIT_ROWS = 20_000
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Rates only: a count or a type-token ratio would tie the learned cuts to text length.
TRAITS = ("symbol_rate", "upper_rate", "digit_rate", "mark_rate", "dup_line_rate", "repeat_rate", "pipe_rate")
_UPPER, _DIGIT = bytes(range(65, 91)), b"0123456789"
_MARKS = b"!?;:\"'()[]{}=+/\\_~^@`"


def _repeated(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    pair = np.unique(code[:-1] * np.int64(len(ids)) + code[1:], return_inverse=True)[1]
    window = pair[:-1].astype(np.int64) * np.int64(len(ids)) + code[2:]
    _, place, count = np.unique(window, return_inverse=True, return_counts=True)
    hit = count[place] > 1
    inside = np.zeros(n, bool)
    for k in range(3):
        inside[k:n - 2 + k] |= hit
    return int(inside.sum())


def describe(text: bytes | None) -> tuple:
    """COUNTS and TRAITS of one text."""
    text = text or b""
    words = text.split()
    n = len(words)
    solid = np.frombuffer(text.translate(None, SPACES), np.uint8)
    chars = int(np.count_nonzero((solid & 0xC0) != 0x80))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    seen, dup, lines = set(), 0, 0
    for line in text.split(b"\n"):
        if line.strip(SPACES):
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    repeat = _repeated(words)
    c, w = max(chars, 1), max(n, 1)
    share = lambda chosen: (len(text) - len(text.translate(None, chosen))) / c
    return (n, chars, symbols, dup, repeat, symbols / w, share(_UPPER), share(_DIGIT), share(_MARKS),
            dup / max(lines, 1), repeat / w, text.count(b"|") / w)


def _statistics(batches):
    for part, texts in text_slices(batches, "text"):
        columns = list(zip(*map(describe, texts)))
        arrays = [pa.array(columns[i], pa.int64() if i < len(COUNTS) else pa.float64()) for i in range(len(columns))]
        yield pa.RecordBatch.from_arrays([part.column(i) for i in range(part.num_columns - 1)] + arrays,
                                         names=[*part.schema.names[:-1], *COUNTS, *TRAITS])


def text_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, COUNTS, TRAITS) of every row."""
    kind = dict(docs.dtypes)[key]
    fields = ", ".join([f"`{key}` {kind}", *[f"{c} long" for c in COUNTS], *[f"{c} double" for c in TRAITS]])
    return docs.select(key, F.col(text).cast("binary").alias("text")).mapInArrow(_statistics, fields)


@dataclass(frozen=True)
class Test:
    trait: str
    above: bool
    cut: float

    def column(self) -> Column:
        return F.col(self.trait) > self.cut if self.above else F.col(self.trait) <= self.cut

    def mask(self, x: np.ndarray, names: tuple[str, ...]) -> np.ndarray:
        v = x[:, names.index(self.trait)]
        return v > self.cut if self.above else v <= self.cut


Rule = tuple[Test, ...]


def _covers(rule: Rule, x: np.ndarray, names: tuple[str, ...]) -> np.ndarray:
    hit = np.ones(len(x), bool)
    for test in rule:
        hit &= test.mask(x, names)
    return hit


def _best_test(x: np.ndarray, bad: np.ndarray, names: tuple[str, ...]) -> tuple[float, Test | None]:
    """The single condition with the largest information gain for the bad rows."""
    p0, n0 = bad.sum(), (~bad).sum()
    base = np.log2(p0 / (p0 + n0))
    best, test = 1e-9, None
    for j, name in enumerate(names):
        order = np.argsort(x[:, j], kind="stable")
        v, b = x[order, j], bad[order]
        edges = np.flatnonzero(v[1:] != v[:-1]) + 1  # rows below each possible cut
        if not len(edges):
            continue
        below_p = np.cumsum(b)[edges - 1]
        below_n = edges - below_p
        cuts = (v[edges - 1] + v[edges]) / 2
        for above, p, n in ((False, below_p, below_n), (True, p0 - below_p, n0 - below_n)):
            gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1e-9) / (p + n)) - base), -1)
            k = int(gain.argmax())
            if gain[k] > best:
                best, test = gain[k], Test(name, above, float(cuts[k]))
    return best, test


def learn_list(x: np.ndarray, bad: np.ndarray, names: tuple[str, ...], *, max_rules: int = 12, max_tests: int = 4,
               precision: float = 0.9) -> list[Rule]:
    """Ordered rules for the bad rows; a row no rule covers is good."""
    grow_part = np.arange(len(x)) % 3 != 0
    rules: list[Rule] = []
    open_ = np.ones(len(x), bool)
    while len(rules) < max_rules and bad[open_ & grow_part].any():
        at = open_ & grow_part
        rule: Rule = ()
        inside = at.copy()
        while len(rule) < max_tests and bad[inside].any() and not bad[inside].all():
            _, test = _best_test(x[inside], bad[inside], names)
            if test is None:
                break
            rule += (test,)
            inside &= test.mask(x, names)
        if not rule:
            break
        held = open_ & ~grow_part
        worth = lambda r: (lambda h: (bad[h].sum() - (~bad[h]).sum()) / max(1, h.sum()))(held & _covers(r, x, names))
        rule = max((rule[:k] for k in range(len(rule), 0, -1)), key=worth)
        hit = open_ & _covers(rule, x, names)
        if bad[hit].sum() < max(3, precision * hit.sum()):
            break
        rules.append(tuple(t for i, t in enumerate(rule)  # a later cut on the same side is the tighter one
                           if not any((t.trait, t.above) == (u.trait, u.above) for u in rule[i + 1:])))
        open_ &= ~hit
    return rules


def fit(stats: DataFrame, labels: DataFrame, *, key: str = "doc_id", label: str = "quality", rows: int = FIT_ROWS) -> list[Rule]:
    """Learn the list from a bounded sample of labelled rows (label 0 is bad)."""
    known = labels.select(F.col(key), F.col(label).cast("int").alias("__label")).filter(f"`{key}` IS NOT NULL AND __label IS NOT NULL")
    sample = bounded_sample(known, key, rows)
    pulled = stats.join(F.broadcast(sample), key).select(key, "__label", *TRAITS).toPandas().sort_values(key, kind="stable")
    bad = (pulled["__label"] == 0).to_numpy()
    if not bad.any() or bad.all():
        return []
    return learn_list(pulled[list(TRAITS)].to_numpy(np.float64), bad, TRAITS)


def as_column(rules: list[Rule]) -> Column:
    """The number (from 1) of the first rule that a row meets, null if none."""
    chain = None
    for i, rule in enumerate(rules):
        met = rule[0].column()
        for test in rule[1:]:
            met = met & test.column()
        chain = F.when(met, F.lit(i + 1)) if chain is None else chain.when(met, F.lit(i + 1))
    return chain if chain is not None else F.lit(None).cast("int")


def as_text(rules: list[Rule]) -> list[str]:
    return [" AND ".join(f"{t.trait} {'>' if t.above else '<='} {t.cut:.6g}" for t in r) for r in rules]


def judge(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality",
          rows: int = FIT_ROWS) -> DataFrame:
    """(key, COUNTS, TRAITS, base_failed, rule, kept) of every row."""
    stats = cut_lineage(text_statistics(docs, key, text))
    rules = fit(stats, labels, key=key, label=label, rows=rows)
    return stats.withColumn("base_failed", base_failed()).withColumn("rule", as_column(rules)) \
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def keep(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality",
         rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` that the fixed limits and the learned list keep; no row moves between tasks."""
    known = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull())
    sample = bounded_sample(known, key, rows).select(key, label)
    shown = docs.select(key, text).join(F.broadcast(sample.select(key)), key, "left_semi")
    rules = fit(text_statistics(shown, key, text), sample, key=key, label=label, rows=2 * rows)
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).cast("binary").alias("text"))
    fields = ", ".join([f"row {whole.schema['row'].dataType.simpleString()}", *[f"{c} long" for c in COUNTS], *[f"{c} double" for c in TRAITS]])
    judged = whole.mapInArrow(_statistics, fields)
    return judged.filter(~base_failed() & as_column(rules).isNull()).select("row.*")


def base_failed() -> Column:
    """The fixed limits: too few words, or more than half of them in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
