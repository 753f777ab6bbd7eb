"""Collocations counted in quotient filters.

Words are counted per language first. A word's id is its place among the hashes
of the words frequent enough to be part of a candidate; other words end a piece,
which loses no candidate, since a phrase is at most as frequent as each of its
words. If those words are more than DENSE (the bound of what is broadcast, 16 MB
of hashes), the 64-bit hash is the id itself and keys take three limbs. The hash
covers language and word, and its seed is raised until no two words of the corpus
share one, so ids are exact.

Each task packs its word pairs and triples into keys, counts them in a quotient
filter, and writes it in parts by the first bits of the quotient; filters of a
part are merged, and keys counted often enough are unpacked. Keys are permuted,
so parts are even however frequent a phrase or large a language is, and a phrase
costs one entry per filter. A task's filter is written out at SPILL entries, so
its memory is bounded; the number of parts follows the number of words.

Null text is empty, a null language counts as ``und``, repeated rows count each
time, an empty table gives an empty result, and other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegate.llm.common import settle
from tidegate.llm.quotient import WIDE, QuotientFilter

# The marks that end a piece, and words between them.
TOKEN = r"[.,;:!?\x0A-\x0D]|[^\x20\x09.,;:!?\x0A-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MARKS = (".", ",", ";", ":", "!", "?", "\n", "\x0b", "\x0c", "\r")
NO_LANG = "und"
MIN_COUNT, COVERED, TOP = 10, 50, 2000
DENSE = (1 << 21) - 1  # frequent words up to which ids are dense; three of them fit into 63 bits
BUFFER, SPILL = 1 << 20, 1 << 21  # tokens packed at once; entries of a task's filter
PART = 1 << 20  # keys a part receives at most on average
SALTS = 32


def _tokens(docs: DataFrame) -> DataFrame:
    """(lang, tokens): words in order and the marks that end pieces."""
    return docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"),
                       F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TOKEN), F.lit(0)).alias("tokens"))


def _hash(seed: int, bits: int, lang: Column, word: Column) -> Column:
    h = F.xxhash64(F.lit(seed), lang, word)
    return h if bits == 64 else F.pmod(h, F.lit(1 << bits))


def vocabulary(docs: DataFrame, hash_bits: int = 64) -> tuple[DataFrame, int]:
    """(lang, word, n, h) of all words, and the seed under which every h belongs to one word. h is never 0."""
    counted = settle(_tokens(docs).select("lang", F.explode("tokens").alias("word")).filter(~F.col("word").isin(*MARKS))
                     .groupBy("lang", "word").agg(F.count("*").alias("n")))
    seed = 0
    while True:
        named = counted.withColumn("h", _hash(seed, hash_bits, F.col("lang"), F.col("word")))
        if named.groupBy("h").agg(F.count("*").alias("words")).filter("words > 1 OR h = 0").isEmpty():
            return named, seed
        seed += 1


class Packing:
    """Word ids to keys and back; ``hashes`` are those of the frequent words in order, None if ids are the hashes."""

    def __init__(self, hashes: np.ndarray | None):
        self.hashes = hashes
        self.word_bits = WIDE if hashes is None else max(1, len(hashes).bit_length())
        self.limbs = 3 if hashes is None else 1
        self.bits = WIDE if hashes is None else max(4, 3 * self.word_bits)

    def ids(self, h: np.ndarray) -> np.ndarray:
        """0 for what ends a piece."""
        if self.hashes is None:
            return h.view(np.uint64)
        if not len(self.hashes):
            return np.zeros(len(h), np.uint64)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, at + 1, 0).astype(np.uint64)

    def keys(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        if self.limbs == 3:
            return np.stack([a, b, c], axis=1)
        w = np.uint64(self.word_bits)
        return ((((a << w) | b) << w) | c)[:, None]

    def words(self, keys: np.ndarray) -> list[np.ndarray]:
        """The hashes of the three words of each key; the third is 0 for pairs."""
        if self.limbs == 3:
            return [keys[:, i].view(np.int64) for i in range(3)]
        w, mask = np.uint64(self.word_bits), np.uint64((1 << self.word_bits) - 1)
        places = [((keys[:, 0] >> (w * np.uint64(2 - i))) & mask).astype(np.int64) for i in range(3)]
        return [np.where(p > 0, self.hashes[p - 1], 0) if len(p) else p for p in places]


def _phrases(packing: Packing, ids: np.ndarray, starts: int) -> np.ndarray:
    """Keys of all pairs and triples of neighbouring words that begin at one of the first ``starts`` ids."""
    a, b, c = (np.r_[ids, np.zeros(2, np.uint64)][k:k + min(starts, len(ids))] for k in range(3))
    pair = (a > 0) & (b > 0)
    triple = pair & (c > 0)
    return np.concatenate([packing.keys(a[pair], b[pair], np.zeros(int(pair.sum()), np.uint64)), packing.keys(a[triple], b[triple], c[triple])])


def _shards(batches: Iterable[pa.RecordBatch], packing: Packing, part_bits: int) -> Iterator[pa.RecordBatch]:
    """A task's filters in parts: (part, filter)."""
    def written(held: QuotientFilter) -> pa.RecordBatch:
        parts = list(held.parts(part_bits))
        return pa.record_batch({"part": pa.array([k for k, _ in parts], pa.int64()), "filter": pa.array([f.to_bytes() for _, f in parts], pa.binary())})
    held = QuotientFilter.merged(packing.bits, [], packing.limbs)
    for batch in batches:
        values = batch.column(0).flatten().to_numpy(zero_copy_only=False)
        for start in range(0, len(values), BUFFER):  # two more tokens end the last phrases that begin here
            keys = _phrases(packing, packing.ids(values[start:start + BUFFER + 2]), BUFFER)
            held = QuotientFilter.merged(packing.bits, [held, QuotientFilter.of(packing.bits, keys)], packing.limbs)
            if len(held) > SPILL:
                yield written(held)
                held = QuotientFilter.merged(packing.bits, [], packing.limbs)
    if len(held):
        yield written(held)


def count_phrases(docs: DataFrame, words: DataFrame, seed: int, hash_bits: int = 64, dense: int = DENSE) -> DataFrame:
    """(h1, h2, h3, a) of the pairs (h3 = 0) and triples that occur MIN_COUNT times or more; ``words`` is the vocabulary."""
    spark = docs.sparkSession
    frequent = words.filter(F.col("n") >= MIN_COUNT)
    size = frequent.agg(F.count("*").alias("k"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    few = size.k <= dense
    hashes = np.sort(np.array([r.h for r in frequent.select("h").toLocalIterator()], np.int64)) if few else None
    total = size.n if few else words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    packing = spark.sparkContext.broadcast(Packing(hashes))
    part_bits = min(packing.value.bits - 1, max(4, (2 * total // PART).bit_length()))
    end = F.lit(0).cast("bigint")
    hashed = F.transform("tokens", lambda t: F.when(t.isin(*MARKS), end).otherwise(_hash(seed, hash_bits, F.col("lang"), t)))
    ids = _tokens(docs).select(F.concat(F.coalesce(hashed, F.array().cast("array<bigint>")), F.array(end)).alias("ids"))

    def merged(table: pa.Table) -> pa.Table:
        p = packing.value
        whole = QuotientFilter.merged(p.bits, (QuotientFilter.from_bytes(p.bits, b) for b in table.column("filter").to_pylist()), p.limbs)
        keys, counts = whole.at_least(MIN_COUNT)
        return pa.table(dict(zip(("h1", "h2", "h3", "a"), [pa.array(x, pa.int64()) for x in (*p.words(keys), counts)])))
    shards = ids.mapInArrow(lambda batches: _shards(batches, packing.value, part_bits), "part bigint, filter binary")
    return shards.groupBy("part").applyInArrow(merged, "h1 bigint, h2 bigint, h3 bigint, a bigint")


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (l r)) in decimals, exact for counts below 10^15."""
    d = "CAST({} AS DECIMAL(15, 0))".format
    return F.expr(f"(CAST(1000000 AS DECIMAL(7, 0)) * ({d(a)} * {d(a)})) div ({d(left)} * {d(right)})")


def collocations(docs: DataFrame, *, hash_bits: int = 64, dense: int = DENSE) -> DataFrame:
    """Per language the first TOP phrases: lang, rank, phrase, a, l, r, n, score."""
    docs = docs.select("lang", "text")
    words, seed = vocabulary(docs, hash_bits)
    counted = settle(count_phrases(docs, words, seed, hash_bits, dense))
    names = words.filter(F.col("n") >= MIN_COUNT).select("h", "lang", "word", "n")
    first, second = (names.select(F.col("h").alias(f"h{i}"), *([F.col("lang")] if i == 1 else []), F.col("word").alias(f"w{i}"),
                                  F.col("n").alias(f"n{i}")) for i in (1, 2))
    pairs = settle(counted.filter("h3 = 0").drop("h3").join(first, "h1").join(second, "h2"))
    triples = settle(counted.filter("h3 <> 0")
                     .join(pairs.select("h1", "h2", "lang", "w1", "w2", "n1", F.col("a").alias("a12")), ["h1", "h2"])
                     .join(pairs.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("w2").alias("w3"), F.col("n2").alias("n3"),
                                        F.col("a").alias("a23")), ["h2", "h3"])
                     .withColumn("s1", _score("a", "n1", "a23")).withColumn("s2", _score("a", "a12", "n3")))
    longer = (triples.select(F.explode(F.array(F.struct("h1", "h2", "a"), F.struct(F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a"))).alias("p"))
              .groupBy(F.col("p.h1").alias("h1"), F.col("p.h2").alias("h2")).agg(F.max("p.a").alias("covering")))
    kept = pairs.join(longer, ["h1", "h2"], "left").filter(f"covering IS NULL OR 100 * covering < {COVERED} * a")
    early = F.col("s1") <= F.col("s2")
    found = kept.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("n1").alias("l"), F.col("n2").alias("r"),
                        _score("a", "n1", "n2").alias("score")).unionByName(
        triples.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.when(early, F.col("n1")).otherwise(F.col("a12")).alias("l"),
                       F.when(early, F.col("a23")).otherwise(F.col("n3")).alias("r"), F.least("s1", "s2").alias("score")))
    best = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    salted = found.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    near_top = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).filter(F.col("rank") <= TOP)
    top = near_top.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("bigint")).filter(F.col("rank") <= TOP)
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return top.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
