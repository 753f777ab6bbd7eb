"""Personal data: fixed formats as seeds, and bootstrapped contextual extraction.

Seeds are the spans of four fixed formats (email, ip, card, phone). Their
neighbouring words become lexical patterns ("the word before", "the word after",
per kind). Identifier-like stretches that no format accepts are the unseen
instances. Spark holds the bipartite graph of patterns and instances and scores
it in rounds: a pattern is as sure as the share of all occurrences of its word in
the corpus that stand by known instances; an unseen instance is as sure as its
patterns together (one minus the product of their doubts). Instances of high
confidence, next to patterns that enough different seeds support, are added.

A pattern's denominator counts its word over the whole corpus, so a common word
such as an article never becomes a pattern, however often it precedes an address.

Scanning is linear in the text: addresses are grown from each ``@``, and the
number formats start only where a run starts. Of a stretch of numbers every run of
whole tokens that could be an identifier is offered, beside formats too. Nothing is shared between texts
except word counts and graph rows, which are aggregated before they are joined.

Defined cases. A null text is empty and has no spans. Spans may overlap,
also those of one kind; all are reported. A null id is kept as it is. Repeated rows get the same
spans, and count once as instances, since instances are distinct strings.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm.common import spare, text_slices
from tidegate.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
SUPPORT = 3  # different seeds a pattern needs
SURE = 0.8  # confidence an unseen instance needs

# The four formats. A number format starts where its run of digits starts.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
# Identifier-like stretches: addresses, and digits with separators.
_ADDRESS = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+")
_LOOSE = re.compile(r"[(]?[0-9][0-9().\-/ ]*")
_TOKEN = re.compile(r"[(]?[0-9](?:[^ ]*[0-9])?")
_GAP = re.compile(r"[ \t\n\x0b\f\r]")
_WORD = re.compile(r"[^ \t\n\x0b\f\r]+")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed formats, sorted."""
    out = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    if not _DIGITS.search(text):
        return out
    if "." in text:
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _guess(value: str) -> int | None:
    """The kind that an identifier-like stretch could be of."""
    if "@" in value:
        return 0
    digits = sum(c.isdigit() for c in value)
    if value.count(".") == 3 and digits >= 4 and not set(value) - set("0123456789."):
        return 1
    if 12 <= digits <= 19:
        return 2
    return 3 if 7 <= digits <= 15 else None


def _hash(side: str, word: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{side}{word.lower()}".encode()) - (1 << 63)


def _numbers(text: str, start: int, end: int):
    """Runs of whole tokens, split at spaces, within a stretch of digits and separators; tokens have a digit, so runs are short."""
    tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text, start, end)]
    digits = [sum(c.isdigit() for c in text[s:e]) for s, e in tokens]
    for i, (s, _) in enumerate(tokens):
        total = 0
        for (_, e), n in zip(tokens[i:i + 19], digits[i:i + 19]):
            total += n
            if total > 19:
                break
            if total >= 4:
                yield s, e


def loose_spans(text: str, taken: list[tuple[int, int]]):
    """(start, kind, end) of identifier-like stretches outside the sorted spans ``taken``."""
    found = list(taken)
    edge = 0
    for m in _ADDRESS.finditer(text) if "@" in text else ():
        while edge < len(taken) and taken[edge][1] <= m.start():
            edge += 1
        if edge == len(taken) or taken[edge][0] >= m.end():
            yield m.start(), 0, m.end()
            found.append(m.span())
    found.sort()
    edge = 0
    for m in _LOOSE.finditer(text):
        at = m.start()
        while edge < len(found) and found[edge][1] <= at:
            edge += 1
        k, pieces = edge, []
        while k < len(found) and found[k][0] < m.end():  # what stands beside a format is still offered
            pieces.append((at, found[k][0]))
            at = max(at, found[k][1])
            k += 1
        for a, b in (*pieces, (at, m.end())):
            for s, e in _numbers(text, a, b) if a < b else ():
                kind = _guess(text[s:e])
                if kind is not None:
                    yield s, kind, e


class _Around:
    """Patterns of the spans of a text, asked in order of their starts: left and right neighbour words, read once."""

    def __init__(self, text: str):
        self.text, self.at, self.before = text, 0, None
        self.word, self.empty = xxhash.xxh3_64(b"<"), True

    def read(self, start: int, end: int) -> list[int]:
        if start > self.at:
            first, *others = _GAP.split(self.text[self.at:start])
            self._grow(first)
            for piece in others:
                if not self.empty:
                    self.before = self.word.intdigest() - (1 << 63)
                    self.word, self.empty = xxhash.xxh3_64(b"<"), True
                self._grow(piece)
            self.at = start
        left = self.before if self.empty else self.word.intdigest() - (1 << 63)
        out = [] if left is None else [left]
        if _GAP.match(self.text, end):
            right = _WORD.search(self.text, end)
            if right:
                out.append(_hash(">", right[0]))
        return out

    def _grow(self, piece: str):
        if piece:
            self.word.update(piece.lower().encode())
            self.empty = False


def _scan(batches):
    """Base spans, and (kind, start, end, instance, pattern, seed) of every neighbourhood."""
    for part, texts in text_slices(batches, "text"):
        spans, marks = [], []
        for text in texts:
            text = text or ""
            found = base_spans(text)
            spans.append([{"start": s, "kind": k, "end": e} for s, k, e in found])
            own = []
            if found or _DIGITS.search(text) or "@" in text:
                seeds = [(s, k, e, True) for s, k, e in found]
                seeds += [(*c, False) for c in loose_spans(text, sorted((s, e) for s, _, e in found))]
                around = _Around(text)
                for s, k, e, seed in sorted(seeds):
                    name = _hash("=", text[s:e])
                    own += [{"kind": k, "start": s, "end": e, "instance": name, "pattern": p, "seed": seed} for p in around.read(s, e)]
            marks.append(own)
        yield pa.RecordBatch.from_arrays(
            [part.column(i) for i in range(part.num_columns - 1)]
            + [pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))),
               pa.array(marks, pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()),
                                                   ("instance", pa.int64()), ("pattern", pa.int64()), ("seed", pa.bool_())])))],
            names=[*part.schema.names[:-1], "base", "marks"])


def _word_counts(batches):
    """Occurrences of every word, as a left and as a right neighbour."""
    for _, texts in text_slices(batches, "text", 16 << 20):
        seen = Counter()
        for text in texts:
            seen.update((text or b"").split())
        flat = Counter()
        for w, n in seen.items():
            flat[w.decode("utf-8", "replace").lower()] += n
        n = np.fromiter(flat.values(), np.int64, len(flat))
        for side in "<>":
            keys = np.fromiter((_hash(side, w) for w in flat), np.int64, len(flat))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["pattern", "n"])


def discover(scanned: DataFrame, docs: DataFrame, *, rounds: int = ROUNDS, support: int = SUPPORT, sure: float = SURE) -> DataFrame:
    """(kind, instance, pattern) edges of unseen instances that the pattern graph is sure of."""
    marks = scanned.select(F.explode("marks").alias("m")).select("m.*")
    edges = cut_lineage(marks.groupBy("kind", "pattern", "instance").agg(F.count("*").alias("n"), F.max("seed").alias("seed")))
    # Only patterns that seeds support and that also stand by unseen instances can add anything.
    backed = edges.groupBy("kind", "pattern").agg(F.count_if("seed").alias("seeds"), F.count_if(~F.col("seed")).alias("open")) \
        .filter((F.col("seeds") >= support) & (F.col("open") > 0)).select("kind", "pattern")
    graph = cut_lineage(edges.join(backed, ["kind", "pattern"], "left_semi"))
    nothing = graph.filter("false").select("kind", "instance", "pattern")
    if graph.isEmpty():
        return nothing
    counts = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(_word_counts, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("total"))
    totals = cut_lineage(counts.join(graph.select("pattern").distinct(), "pattern", "left_semi"))
    score = graph.select("kind", "instance", "seed").distinct().withColumn("belief", F.col("seed").cast("double"))
    for _ in range(rounds):
        weighed = graph.select("kind", "pattern", "instance", "n").join(score, ["kind", "instance"])
        # The word may be counted less often than the pattern where punctuation touches it; never trust above the seen share.
        sureness = weighed.groupBy("kind", "pattern").agg(F.sum(F.col("n") * F.col("belief")).alias("hit"), F.sum("n").alias("seen")) \
            .join(totals, "pattern", "left") \
            .select("kind", "pattern", (F.col("hit") / (F.greatest(F.coalesce("total", "seen"), "seen") + 1)).alias("conf"))
        belief = F.when(F.max("seed"), F.lit(1.0)).otherwise(1 - F.exp(F.sum(F.log1p(-F.least(F.col("conf"), F.lit(0.999))))))
        score = cut_lineage(graph.join(sureness, ["kind", "pattern"]).groupBy("kind", "instance")
                            .agg(F.max("seed").alias("seed"), belief.alias("belief")))
    chosen = score.filter(~F.col("seed") & (F.col("belief") >= sure)).select("kind", "instance")
    return cut_lineage(graph.filter(~F.col("seed")).join(chosen, ["kind", "instance"], "left_semi").select("kind", "instance", "pattern"))


def find(docs: DataFrame, *, keys: tuple[str, ...] = ("doc_id",), text: str = "text", **how) -> DataFrame:
    """(keys, base, spans) of every row: arrays of (start, kind number, end), code points, sorted."""
    types = dict(docs.dtypes)
    source = docs.select(*keys, F.col(text).alias("text"))
    fields = ", ".join(f"`{k}` {types[k]}" for k in keys)
    span = "array<struct<start: int, kind: int, end: int>>"
    scanned = cut_lineage(source.mapInArrow(
        _scan, f"{fields}, base {span}, marks array<struct<kind: int, start: int, end: int, instance: long, pattern: long, seed: boolean>>")
        .withColumn("__at", F.monotonically_increasing_id()))
    added = discover(scanned, source, **how)
    if added.isEmpty():
        return scanned.select(*keys, "base", F.col("base").alias("spans"))
    extra = scanned.filter("exists(marks, m -> NOT m.seed)").select("__at", F.explode("marks").alias("m")).filter("NOT m.seed") \
        .select("__at", "m.*").join(added, ["kind", "instance", "pattern"], "left_semi") \
        .groupBy("__at").agg(F.collect_set(F.struct("start", "kind", "end")).alias("more"))  # at most a text's own stretches
    joined = scanned.join(extra, "__at", "left")
    return joined.select(*keys, "base", F.expr("array_sort(concat(base, coalesce(more, array())))").alias("spans"))


def listing(spans: str) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    name = "element_at(array('" + "','".join(KINDS) + "'), s.kind + 1)"
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', {name}, s.start, s.end)), ',')")


def redact(docs: DataFrame, *, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` with every span found replaced by its kind in brackets; columns stay as they are."""
    held = docs.columns
    row, own = spare(docs, "__row", "__spans")
    named = docs.withColumn(row, F.xxhash64(F.lit("pii"), F.col(key), F.col(text)))
    found = find(named.select(F.col(row).alias("__row"), F.col(text).alias("text")), keys=("__row",), **how)
    spans = found.filter(F.size("spans") > 0).select(F.col("__row").alias(row), F.col("spans").alias(own)).dropDuplicates([row])

    @F.pandas_udf("string")
    def mask(texts: pd.Series, found: pd.Series) -> pd.Series:
        out = []
        for t, own in zip(texts, found):
            pieces, at = [], 0
            for s in own:
                if s["start"] >= at:
                    pieces += [t[at:s["start"]], f"[{KINDS[s['kind']].upper()}]"]
                at = max(at, s["end"])
            out.append("".join([*pieces, t[at:]]))
        return pd.Series(out, dtype=object)
    marked = named.join(spans, row, "left").withColumn(own, F.coalesce(own, F.array()))
    return marked.withColumn(text, F.when(F.size(own) > 0, mask(F.coalesce(text, F.lit("")), own)).otherwise(F.col(text))).select(*held)
