"""Near-duplicate documents by circulant MinHash.

One permutation scrambles the shingle hashes once; a second permutation, read at
circularly shifted positions, gives every signature coordinate. Coordinates are
banded, and candidate pairs are confirmed on their full shingle sets.

Rows and sets. Texts of one shingle set form a class, named by its smallest id.
Classes, not documents, are banded, compared and linked; copies cost one
aggregate and one join. Buckets compare every member with a pivot first. Large
buckets that still hold unlinked parts then try their best linked members as
pivots, which finds the original of a group of near copies. At last members of
different parts meet: pairwise in small buckets, and in large ones at their
rarest shingles, a few of which any two similar sets must share. So no pair that
shares a bucket is left undecided, yet a large linked group, and loose variants
around it, do not meet in pairs.

Recall. With 40 bands of 5 coordinates a pair of similarity 0.75 misses every
band with probability 2e-5. Candidates are skipped when their 192-bit sketches agree in
fewer than 138 bits; a pair of similarity 0.75 agrees in 168 on average, with a
deviation of 4.6, so 138 is more than six deviations away. Precision is exact up to collisions of 64-bit shingle hashes.

Defined cases. A null or empty text, or one without words, has an empty set and
links with nothing. A text with fewer words than a shingle is one shingle. A row
with a null id links with nothing, has a null component and is kept. Rows that
repeat an id share its component and fate.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from tidegate.llm.common import components, settle, spare, text_slices
from tidegate.session import cut_lineage

BANDS, ROWS = 40, 5
SKETCH, SKETCH_MIN = 192, 138
PIVOT_TURNS, LARGE_BUCKET = 2, 16
_M64 = np.uint64(0x9E3779B97F4A7C15)


def _mix64(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit integers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _mix32(x: np.ndarray) -> np.ndarray:
    """A permutation of the 32-bit integers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def shingle_set(text: bytes | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; ASCII letters are lower-cased."""
    tokens = text.lower().split() if text else []
    if not tokens:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    width = min(words, len(h))
    n = len(h) - width + 1
    with np.errstate(over="ignore"):
        acc = np.full(n, width, np.uint64)
        for k in range(width):
            acc = _mix64(acc * _M64 + h[k:k + n])
    return np.unique(acc)


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """Circulant MinHash: coordinate k is the minimum of the second permutation at positions shifted by k."""
    first = _mix64(shingles ^ np.uint64(0xC0FFEE)).astype(np.uint32)
    out = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    shifts = np.arange(coordinates, dtype=np.uint32)[:, None] * np.uint32(0x9E3779B1)
    for start in range(0, len(first), 256):  # blocks stay in the cache
        block = first[None, start:start + 256] + shifts
        np.minimum(out, _mix32(block).min(axis=1), out=out)
    return out


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _describe(words: int, bands: int, rows: int):
    """Batches of (id, text) -> set size, set name (two hashes), band keys and sketch."""
    def run(batches):
        for part, texts in text_slices(batches, "text"):
            size, one, two, keys, bits = [], [], [], [], []
            for text in texts:
                s = shingle_set(text, words)
                size.append(len(s))
                if not len(s):
                    one.append(None), two.append(None), keys.append(None), bits.append([None] * 3)
                    continue
                with np.errstate(over="ignore"):
                    one.append(int(s.sum().view(np.int64)))
                    two.append(int(_mix64(s).sum().view(np.int64)))
                sig = signature(s, max(bands * rows, SKETCH))
                with np.errstate(over="ignore"):
                    acc = np.arange(1, bands + 1, dtype=np.uint64)
                    for k in range(rows):
                        acc = _mix64(acc * _M64 + sig[k:bands * rows:rows].astype(np.uint64))
                keys.append(_signed(acc))
                bits.append(np.packbits(_mix32(sig[:SKETCH].copy()) & np.uint32(1)).view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index("id")), pa.array(size, pa.int64()), pa.array(one, pa.int64()),
                 pa.array(two, pa.int64()), pa.array(keys, pa.list_(pa.int64())), *[pa.array([x[k] for x in bits], pa.int64()) for k in range(3)]],
                names=["id", "n", "h1", "h2", "bands", "s1", "s2", "s3"])
    return run


def _pack(batches):
    """Compress texts before they travel."""
    packer = zstandard.ZstdCompressor(level=1)
    for part, texts in text_slices(batches, "text"):
        yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("id")),
                                          pa.array([packer.compress(t or b"") for t in texts], pa.binary())], names=["id", "body"])


def _measure(words: int, percent: int):
    """Groups (hub, its text first, then the texts compared with it) -> whether each pair is near, and its distance."""
    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        hub, held = None, None
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out = []
            for i in range(batch.num_rows):
                own = shingle_set(unpack.decompress(batch.column(2)[i].as_py()), words)
                if a[i] == b[i]:  # the hub's own row precedes its partners
                    hub, held = a[i], own
                    continue
                assert a[i] == hub, "partners must follow their hub"
                both = np.intersect1d(held, own, assume_unique=True).size
                union = len(held) + len(own) - both
                out.append((a[i], b[i], 100 * both >= percent * union, 1 - both / max(union, 1)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in
                                              enumerate((pa.int64(), pa.int64(), pa.bool_(), pa.float64()))], names=["a", "b", "near", "dist"])
    return run


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 75,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``docs``; see the module text."""
    source = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("binary").alias("text"))
    described = cut_lineage(source.mapInArrow(
        _describe(words, bands, rows), "id long, n long, h1 long, h2 long, bands array<long>, s1 long, s2 long, s3 long"))
    sets = described.filter("n > 0 AND id IS NOT NULL")
    # One class per shingle set. The bands are a function of the set, so any copy's will do.
    classes = cut_lineage(sets.groupBy("n", "h1", "h2").agg(F.min("id").alias("rep")))
    reps = cut_lineage(sets.join(classes.withColumnRenamed("rep", "id"), ["n", "h1", "h2", "id"], "left_semi")
                       .dropDuplicates(["id"]).select("id", "n", "s1", "s2", "s3", "bands"))
    members = reps.select("id", F.explode("bands").alias("bucket"))
    buckets = members.groupBy("bucket").agg(F.min("id").alias("pivot"), F.count("*").alias("size")).filter("size > 1")
    shared = cut_lineage(members.join(buckets, "bucket").select("bucket", "id", "pivot"))

    fits = f"100 * least(n, m) >= {percent} * greatest(n, m)"  # set sizes this far apart cannot be similar enough
    agree = f"{SKETCH} - bit_count(s1 ^ t1) - bit_count(s2 ^ t2) - bit_count(s3 ^ t3) >= {SKETCH_MIN}"
    mine = reps.select("id", "n", "s1", "s2", "s3")
    packed = source.filter("id IS NOT NULL").mapInArrow(_pack, "id long, body binary")
    bodies = cut_lineage(packed.join(shared.select("id").distinct(), "id", "left_semi").dropDuplicates(["id"]))

    def with_pivots(members: DataFrame) -> DataFrame:
        """Pairs of members (id, pivot) that may be similar enough."""
        theirs = mine.toDF("pivot", "m", "t1", "t2", "t3")
        return members.select("id", "pivot").distinct().join(mine, "id").join(theirs, "pivot").filter(fits).filter(agree) \
            .selectExpr("least(id, pivot) AS a", "greatest(id, pivot) AS b").distinct()

    measured = _measured(settle(with_pivots(shared.filter("id <> pivot"))), bodies, words, percent)
    used = shared.select("bucket", "pivot").distinct()
    for turn in range(PIVOT_TURNS + 1):
        parts = components(measured.filter("near"))
        side = shared.select("bucket", "id").join(parts.withColumnRenamed("vertex", "id"), "id", "left") \
            .selectExpr("bucket", "id", "coalesce(component, id) AS part")
        split = side.groupBy("bucket").agg(F.min("part").alias("p"), F.max("part").alias("q"), F.count("*").alias("size")) \
            .filter("p < q AND size > 2").select("bucket", "size")
        side = settle(side.join(split, "bucket"))
        large = side.filter(F.col("size") >= LARGE_BUCKET)
        last = turn == PIVOT_TURNS or large.isEmpty()
        if last:  # every pair of members in different parts
            rivals = large.select("id", "part").distinct()
            fresh = _across(side.filter(F.col("size") < LARGE_BUCKET).join(mine, "id"), fits, agree).unionByName(
                _meeting(rivals, mine, bodies, words, fits, agree, percent)).distinct()
        else:  # large buckets try their best linked member next: the original of a group of near copies
            degree = measured.filter("near").selectExpr("explode(array(a, b)) AS id").groupBy("id").agg(F.count("*").alias("k"))
            rank = F.struct(F.coalesce("k", F.lit(0)).alias("k"), (-F.col("id")).alias("low"))
            best = settle(
                large.join(used.withColumnRenamed("pivot", "id"), ["bucket", "id"], "left_anti").join(degree, "id", "left")
                .groupBy("bucket").agg(F.max_by("id", rank).alias("pivot")))
            used = used.unionByName(best)
            fresh = with_pivots(large.join(best, "bucket").filter("id <> pivot"))
        fresh = settle(fresh.join(measured, ["a", "b"], "left_anti"))
        if not fresh.isEmpty():
            measured = measured.unionByName(_measured(fresh, bodies, words, percent))
            parts = components(measured.filter("near")) if last else parts
        if last:
            break

    rep_of = classes.join(parts.withColumnRenamed("vertex", "rep"), "rep", "left") \
        .selectExpr("n", "h1", "h2", "coalesce(component, rep) AS comp")
    placed = described.select("id", "n", "h1", "h2").join(rep_of, ["n", "h1", "h2"], "left")
    return placed.selectExpr("id AS doc_id", "n AS n_shingles", "IF(id IS NULL, NULL, coalesce(comp, id)) AS component_id") \
        .selectExpr("doc_id", "n_shingles", "component_id", "coalesce(doc_id = component_id, true) AS kept")


def _shingle_rows(words: int):
    """(id, part, shingle) of packed texts."""
    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            sets = [shingle_set(unpack.decompress(b), words) for b in batch.column(2).to_pylist()]
            size = np.array([len(x) for x in sets], np.int64)
            ids, parts = (np.repeat(batch.column(k).to_numpy(), size) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(parts, pa.int64()),
                                              pa.array(np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64))],
                                             names=["id", "part", "shingle"])
    return run


def _meeting(rivals: DataFrame, mine: DataFrame, bodies: DataFrame, words: int, fits: str, agree: str, percent: int) -> DataFrame:
    """Pairs (a, b) of ``rivals(id, part)`` in different parts that meet at one of their rarest shingles.

    Sets of n and m shingles that are similar enough share at least
    ``need`` = percent (n + m) / (100 + percent) of them. In any common order of
    shingles the first n - need + 1 of the one and the first m - need + 1 of the
    other then hold a common shingle, so nothing else has to meet. The order is
    by frequency: variants of one text that are too far from it to be linked have
    shingles of their own first, and meet at what their edits have in common.
    A shingle of one part joins nothing, and members of a shingle's largest part
    are not joined with each other.
    """
    rows = cut_lineage(rivals.join(bodies, "id").select("id", "part", "body").mapInArrow(_shingle_rows(words), "id long, part long, shingle long"))
    held = rows.groupBy("shingle", "part").agg(F.count("*").alias("k")).groupBy("shingle").agg(
        F.sum("k").alias("k"), F.count("*").alias("parts"), F.max_by("part", F.struct("k", "part")).alias("main"))
    order = Window.partitionBy("id").orderBy("k", "shingle")
    longest = f"n - (n * {percent} + 99) div 100 + 1"  # with the smallest set that may still be similar enough
    first = rows.join(held, "shingle").withColumn("pos", F.row_number().over(order)).join(mine, "id") \
        .filter(f"parts > 1 AND pos <= {longest}").select("shingle", "main", "id", "part", "pos", "n", "s1", "s2", "s3")
    first = settle(first)
    one, other = first.filter("part <> main"), first.drop("main").toDF("shingle", "id2", "part2", "pos2", "m", "t1", "t2", "t3")
    need = f"((n + m) * {percent} + {99 + percent}) div {100 + percent}"
    return one.join(other, "shingle").filter(
        f"part <> part2 AND (id < id2 OR part2 = main) AND pos <= n - {need} + 1 AND pos2 <= m - {need} + 1 AND {fits} AND {agree}") \
        .selectExpr("least(id, id2) AS a", "greatest(id, id2) AS b").distinct()


def _across(side: DataFrame, fits: str, agree: str) -> DataFrame:
    """Pairs of members of small buckets in different parts that sizes and sketches leave possible."""
    other = side.selectExpr("bucket", "id AS id2", "n AS m", "s1 AS t1", "s2 AS t2", "s3 AS t3", "part AS part2")
    return side.join(other, "bucket").filter(f"id < id2 AND part <> part2 AND {fits} AND {agree}") \
        .selectExpr("id AS a", "id2 AS b").distinct()


def _measured(pairs: DataFrame, bodies: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b, near, dist) of the pairs, on their full sets.

    Partners travel to their hub, the end with more pairs; a hub with many is
    dealt to several groups, each with a copy of the hub's text, so no group
    holds more than 64 texts or so.
    """
    ends = pairs.selectExpr("explode(array(a, b)) AS v").groupBy("v").agg(F.count("*").alias("k"))
    aimed = settle(
        pairs.join(ends.selectExpr("v AS a", "k AS ka"), "a").join(ends.selectExpr("v AS b", "k AS kb"), "b")
        .selectExpr("IF(ka >= kb, a, b) AS a", "IF(ka >= kb, b, a) AS b"))
    many = aimed.groupBy("a").agg(F.count("*").alias("k")).withColumn("salts", F.ceil(F.col("k") / 64).cast("int"))
    dealt = aimed.join(many, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"))
    hubs = many.select("a", F.col("a").alias("b"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    rows = dealt.unionByName(hubs).join(bodies.withColumnRenamed("id", "b"), "b").select("a", "b", "body", "salt")
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = rows.repartition(parts, "a", "salt").sortWithinPartitions("a", "salt", F.col("a") != F.col("b"), "b")
    out = ordered.select("a", "b", "body").mapInArrow(_measure(words, percent), "a long, b long, near boolean, dist double")
    return settle(out.selectExpr("least(a, b) AS a", "greatest(a, b) AS b", "near", "dist"))


def keep_one(docs: DataFrame, *, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs``, one of each group of near duplicates, the least by id and text.

    Where ids repeat, rows are numbered along (id, text) first, so that different
    texts of one id are judged one by one; a row without an id stays.
    """
    held = docs.columns
    if docs.filter(F.col(key).isNotNull()).groupBy(key).count().filter(F.col("count") > 1).isEmpty():
        dropped = near_duplicates(docs, key=key, text=text, **how).filter("NOT kept").select(F.col("doc_id").alias(key)).distinct()
        return docs.join(dropped, key, "left_anti").select(*held)
    (row,) = spare(docs, "__row")
    along = docs.repartitionByRange(F.col(key), F.col(text)).sortWithinPartitions(key, text)
    numbered = cut_lineage(along.withColumn(row, F.when(F.col(key).isNotNull(), F.monotonically_increasing_id())))
    dropped = near_duplicates(numbered, key=row, text=text, **how).filter("NOT kept").select(F.col("doc_id").alias(row))
    return numbered.join(dropped, row, "left_anti").select(*held)
