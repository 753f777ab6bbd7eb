"""Language-model scores from a class-based bigram model; classes come from exchange clustering.

Words are lower-cased (A-Z) runs of other characters than ASCII white space; one
end follows every text. The model is P(word | class) * P(class | class before),
both smoothed, learned from the training rows.

Classes. Each word that makes up at least one in ``1 / ITEM_SHARE`` training tokens
is an item of its own; by counting, there are at most ``1 / ITEM_SHARE`` of them.
The other words are grouped by length and ending into ``BINS`` items, so that every
word belongs to an item. Exchange clustering moves items between classes while
the mutual information of neighbouring classes grows: each sweep offers one half
of the items at a time the best class, given the present class counts.

Work. Counts and neighbour counts are aggregated per task before they are
shuffled. Sweeps only map over one row of neighbours per item, whose length is
bounded by the number of items; the class matrix has a fixed size. Words of at
least one in ``1 / LOCAL_SHARE`` tokens are looked up in a table of proven bound;
the counts of rarer words are joined by word, which no common word can skew. Words
are named by 64-bit hashes.

Defined cases. A null or empty text is its end alone. Null ids hash as empty text
and are scored. Without training rows the model is uniform and nothing is known.
Repeated rows are trained on and scored one by one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidegate.llm.common import fold, text_slices
from tidegate.session import cut_lineage

FOLDS, HELD = 7, 2
ITEM_SHARE, LOCAL_SHARE = 1e-5, 1e-6
BINS, CLASSES, SWEEPS = 256, 64, 3
SUMS, RETRIES = 16, 3  # groups that add up class matrices; halvings of a half-sweep that lowers the objective
ALPHA = 0.2  # added to every word count of a class


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)


def _bin(word: bytes) -> int:
    """The group of a rare word: its length and its last letters."""
    return (word[-1] * 31 + word[-2:][0]) % (BINS // 8) * 8 + min(len(word) // 2, 7)


def _count(batches):
    """(word, bin, n) of a slice of training texts."""
    for _, texts in text_slices(batches, "text", 6 << 20):
        seen: dict[bytes, int] = {}
        for text in texts:
            for w in (text or b"").lower().split():
                seen[w] = seen.get(w, 0) + 1
        words = list(seen)
        yield pa.RecordBatch.from_arrays([pa.array(_hashes(words)), pa.array([_bin(w) for w in words], pa.int32()),
                                          pa.array(list(seen.values()), pa.int64())], names=["word", "bin", "n"])


class Lookup:
    """Common words: hash, count and item; others by their bin. The last item is the end."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, items: np.ndarray, own: int):
        order = np.argsort(words)
        self.words, self.counts, self.items = words[order], counts[order], items[order]
        self.own, self.end = own, own + BINS
        self.size = own + BINS + 1

    def read(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(item, count or -1, hash, text number) of all tokens of the texts, ends included."""
        tokens, doc = [], []
        for i, text in enumerate(texts):
            own = text.lower().split() if text else []
            tokens += own
            doc.append(len(own) + 1)
        h = _hashes(tokens)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
            hit = self.words[at] == h
            item, count = np.where(hit, self.items[at], -1), np.where(hit, self.counts[at], -1)
        else:
            item, count = np.full(len(h), -1), np.full(len(h), -1)
        for i in np.flatnonzero(item < 0):
            item[i] = self.own + _bin(tokens[i])
        length = np.array(doc)
        ends = np.cumsum(length) - 1
        place = np.ones(length.sum(), bool)
        place[ends] = False
        full = [np.full(length.sum(), x, np.int64) for x in (self.end, 0, 0)]
        for out, values in zip(full, (item, count, h)):
            out[place] = values
        return (*full, np.repeat(np.arange(len(texts)), length))


def _before(item: np.ndarray, end: int) -> np.ndarray:
    """The item before each token; every text closes with an end, so the next one starts after it."""
    return np.concatenate([[end], item[:-1]])


def _g(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def objective(n: np.ndarray) -> float:
    """The part of the classes' mutual information that moves can change."""
    return float(_g(n).sum() - _g(n.sum(1)).sum() - _g(n.sum(0)).sum())


def best_class(n: np.ndarray, now: int, right: np.ndarray, left: np.ndarray, own: float) -> int:
    """The class among all but the last in which an item with these neighbour counts raises the objective most."""
    r, l = right.copy(), left.copy()  # noqa: E741
    r[now] -= own
    l[now] -= own
    rest = n.copy()
    rest[now, :] -= r
    rest[:, now] -= l
    rest[now, now] -= own
    np.maximum(rest, 0, out=rest)
    flat = _g(rest)
    rows = _g(rest + r[None, :]) - flat
    cols = _g(rest + l[:, None]) - flat
    diag = np.diag(rest)
    gain = rows.sum(1) - np.diag(rows) + cols.sum(0) - np.diag(cols) + _g(diag + r + l + own) - _g(diag)
    row, col = rest.sum(1), rest.sum(0)
    gain -= _g(row + right.sum()) - _g(row) + _g(col + left.sum()) - _g(col)
    k = int(gain[:-1].argmax())
    return k if gain[k] > gain[now] + 1e-9 else now


def _matrix(neighbours: DataFrame, classes: np.ndarray) -> np.ndarray:
    """Class bigram counts."""
    held = neighbours.sparkSession.sparkContext.broadcast(classes)

    def run(frames):
        cls, total = held.value, np.zeros(CLASSES * CLASSES)
        for pdf in frames:
            for item, js, ns in zip(pdf["item"], pdf["rj"], pdf["rn"]):
                if js is not None:
                    total[cls[item] * CLASSES:(cls[item] + 1) * CLASSES] += np.bincount(cls[js], ns, CLASSES)
        yield pd.DataFrame({"total": [total]})

    def added(frame):
        return pd.DataFrame({"total": [np.sum(np.stack(frame["total"].to_numpy()), axis=0)]})
    # One vector a task, added in a few groups whatever the number of tasks.
    vectors = neighbours.select("item", "rj", "rn").mapInPandas(run, "total array<double>")
    sums = vectors.withColumn("part", F.spark_partition_id() % SUMS).groupBy("part").applyInPandas(added, "total array<double>").toPandas()
    return sum((np.asarray(x) for x in sums["total"]), np.zeros(CLASSES * CLASSES)).reshape(CLASSES, CLASSES)


def cluster(neighbours: DataFrame, classes: np.ndarray, sweeps: int = SWEEPS) -> tuple[np.ndarray, np.ndarray]:
    """(classes, class matrix) after exchange sweeps; ``neighbours(item, rj, rn, lj, ln)``; the last item keeps its class."""
    context = neighbours.sparkSession.sparkContext
    n = _matrix(neighbours, classes)
    for turn in range(2 * sweeps):
        state = context.broadcast((classes, n))

        def move(frames, state=state, turn=turn):
            cls, table = state.value
            for pdf in frames:
                out = []
                for item, rj, rn, lj, ln in zip(pdf["item"], pdf["rj"], pdf["rn"], pdf["lj"], pdf["ln"]):
                    rj, rn, lj, ln = ([] if x is None else x for x in (rj, rn, lj, ln))
                    right = np.bincount(cls[np.asarray(rj, int)], rn, CLASSES).astype(float)
                    left = np.bincount(cls[np.asarray(lj, int)], ln, CLASSES).astype(float)
                    own = float(np.sum(np.asarray(rn)[np.asarray(rj, int) == item]))
                    to = best_class(table, int(cls[item]), right, left, own)
                    if to != cls[item]:
                        out.append((item, to))
                yield pd.DataFrame(out, columns=["item", "to"])
        last = len(classes) - 1
        offered = neighbours.filter((F.col("item") != last) & (F.pmod(F.xxhash64("item"), F.lit(2)) == turn % 2))
        moved = offered.mapInPandas(move, "item int, to int").toPandas()  # one row per item at most
        if not len(moved):
            continue
        for part in range(RETRIES + 1):  # moves made at once can cancel each other: then half of them are tried
            some = moved[moved["item"].to_numpy() // 2 % (1 << part) == 0]
            tried = classes.copy()
            tried[some["item"]] = some["to"]
            m = _matrix(neighbours, tried)
            if objective(m) > objective(n):
                classes, n = tried, m
                break
    return classes, n


def score(docs: DataFrame, *, key: str = "doc_id", text: str = "text", folds: int = FOLDS, held: int = HELD,
          item_share: float = ITEM_SHARE, local_share: float = LOCAL_SHARE, sweeps: int = SWEEPS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every row."""
    spark = docs.sparkSession
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("binary").alias("text"), (fold(F.col(key), folds) == held).alias("held_out"))
    train = source.filter(~F.col("held_out")).select("text")
    counts = cut_lineage(train.mapInArrow(_count, "word long, bin int, n long").groupBy("word").agg(F.first("bin").alias("bin"), F.sum("n").alias("n")))
    size = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    ends = train.count()
    total, types = size["n"] + ends, size["v"] + (ends > 0)

    # Words common enough for the local table: at most 1 / local_share of them, whatever the corpus.
    common = counts.filter(F.col("n") >= max(1, local_share * total)).toPandas()
    itself = common["n"].to_numpy() >= max(2, item_share * total)
    rank = np.full(len(common), -1)
    by_count = common[itself].sort_values(["n", "word"], ascending=[False, True]).index.to_numpy()
    rank[by_count] = np.arange(len(by_count))
    own = len(by_count)
    items = np.where(rank >= 0, rank, own + common["bin"].to_numpy())
    lookup = Lookup(common["word"].to_numpy(np.int64), common["n"].to_numpy(np.int64), items.astype(np.int64), own)
    shared = spark.sparkContext.broadcast(lookup)

    def neighbours_of(batches):
        look = shared.value
        for _, texts in text_slices(batches, "text", 6 << 20):
            item = look.read(texts)[0]
            code, n = np.unique(_before(item, look.end) * look.size + item, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(code, pa.int64()), pa.array(n, pa.int64())], names=["code", "n"])
    codes = train.mapInArrow(neighbours_of, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")) \
        .select(F.expr(f"CAST(code DIV {lookup.size} AS INT)").alias("a"), F.expr(f"CAST(code % {lookup.size} AS INT)").alias("b"), "n")
    # One row per item and direction; an item has at most as many neighbours as there are items.
    both = codes.select(F.explode(F.array(F.struct(F.col("a").alias("item"), F.lit(0).alias("d"), F.col("b").alias("j"), "n"),
                                          F.struct(F.col("b").alias("item"), F.lit(1).alias("d"), F.col("a").alias("j"), "n"))).alias("e")).select("e.*")
    listed = both.groupBy("item").agg(*[F.collect_list(F.when(F.col("d") == d, F.col(c))).alias(name)
                                        for d, c, name in ((0, "j", "rj"), (0, "n", "rn"), (1, "j", "lj"), (1, "n", "ln"))])
    neighbours = cut_lineage(listed)
    classes = np.arange(lookup.size) % (CLASSES - 1)
    classes[lookup.end] = CLASSES - 1
    classes, n = cluster(neighbours, classes, sweeps)

    # Types per class: common words here, rarer ones counted by bin.
    rare = counts.filter(F.col("n") < max(1, local_share * total)).groupBy("bin").agg(F.count("*").alias("types")).toPandas()
    class_types = np.bincount(classes[lookup.items], minlength=CLASSES).astype(float)
    np.add.at(class_types, classes[own + rare["bin"].to_numpy(int)], rare["types"].to_numpy(float))
    tokens = n.sum(axis=0)
    share = (tokens + 1) / (tokens.sum() + CLASSES)
    step = np.log10((n + CLASSES * share[None, :]) / (n.sum(axis=1, keepdims=True) + CLASSES))
    spread = np.log10(tokens + ALPHA * (class_types + 1))
    model = spark.sparkContext.broadcast((classes, step, spread))
    base_floor = np.log10(total + 1 * (types + 1))

    def judge(batches):
        look = shared.value
        cls, table, room = model.value
        for part, texts in text_slices(batches, "text"):
            item, count, word, doc = look.read(texts)
            is_end, unknown = item == look.end, count < 0
            count = np.where(is_end, ends, count)
            c = cls[item]
            moved = table[cls[_before(item, look.end)], c]
            emitted = np.where(is_end, 0.0, np.log10(np.maximum(count, 0) + ALPHA) * ~unknown - room[c])
            base = np.where(unknown, 0.0, np.log10(np.maximum(count, 0) + 1)) - base_floor
            sums = [np.bincount(doc, x, len(texts)) for x in (moved + emitted, base)]
            known = np.bincount(doc, (count > 0).astype(float), len(texts)).astype(np.int64)
            # Distinct rare words of each text, with their numbers.
            at = np.flatnonzero(unknown)
            order = at[np.lexsort((word[at], doc[at]))]
            d, w = doc[order], word[order]
            start = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (w[1:] != w[:-1])])) if len(d) else np.empty(0, int)
            many = np.diff(np.append(start, len(d)))
            edges = np.searchsorted(d[start], np.arange(len(texts) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(np.bincount(doc, minlength=len(texts)).astype(np.int64)), pa.array(known),
                 pa.array(sums[1]), pa.array(sums[0]), pa.ListArray.from_arrays(pa.array(edges), pa.array(w[start])),
                 pa.ListArray.from_arrays(pa.array(edges), pa.array(many.astype(np.int32)))],
                names=["doc_id", "held_out", "n_tokens", "known", "base", "model", "rare", "times"])
    kind = dict(source.dtypes)["doc_id"]
    local = cut_lineage(source.mapInArrow(
        judge, f"doc_id {kind}, held_out boolean, n_tokens long, known long, base double, model double, rare array<long>, times array<int>")
        .withColumn("__at", F.monotonically_increasing_id()))
    asked = local.filter("size(rare) > 0").select("__at", F.explode(F.arrays_zip("rare", "times")).alias("r")) \
        .select("__at", F.col("r.rare").alias("word"), F.col("r.times").alias("k"))
    told = asked.join(counts.select("word", "n"), "word", "left").withColumn("n", F.coalesce("n", F.lit(0))) \
        .groupBy("__at").agg(F.sum(F.col("k") * F.log10(F.col("n") + 1.0)).alias("more_base"),
                             F.sum(F.col("k") * F.log10(F.col("n") + ALPHA)).alias("more_model"),
                             F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("more_known"))
    out = local.drop("rare", "times").join(told, "__at", "left")
    zero = F.lit(0.0)
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"),
        (F.col("model") + F.coalesce("more_model", zero)).alias("score")) \
        .withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
