"""Near-duplicate vectors by a forest of random-projection trees.

Every tree splits its nodes at the mean of one random projection per level; a
vector within the overlap of the split goes to both sides. The upper levels are
fitted on a sample of at most ``SAMPLE_ROWS`` vectors and applied to all; nodes
that still hold many rows are split by statistics of all their rows. Vectors are
compared within leaves, in double precision, and linked when their cosine is high
enough.

Labels are the roots of the trees, so only vectors of one label meet. Equal
vectors of a label form a class that is placed and compared once and counts with
its size. A pair that shares several leaves is counted in the first of them: each
vector carries the leaves it is in.

Nothing larger than a block is held by a task. A leaf that no split can divide (a
dense group) is dealt in pairs of blocks; each task gives, per vector, a count of
links and one link into each cluster of the block, never the pairs themselves.

Recall. For cosine 0.98 the projections of a pair differ by about 0.2 / sqrt(d);
the overlap is of that size on both sides, so a split parts a pair only if it
differs by more than twice that, and then only if the cut lies between. A pair is
lost if that happens in each of the trees.

Defined cases. Vectors that are null, empty, zero, or hold null or non-finite
components, and rows with a null label or id, link with nothing. Vectors of
different lengths do not meet. Rows that repeat an id count as different vectors
and share a component. A row with a null id has a null component and is kept.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidegate.llm.common import bounded_sample, components
from tidegate.session import cut_lineage

TREES, LEVELS, LEAF, BLOCK = 5, 30, 400, 1_500
SAMPLE_ROWS = 40_000
THRESHOLD = 0.98


def _directions(trees: int, levels: int, dims: int, seed: int) -> np.ndarray:
    d = np.random.default_rng([seed, dims]).normal(size=(trees, levels, dims))
    return d / np.linalg.norm(d, axis=2, keepdims=True)


def _units(vectors) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    # A power of two is taken out first, which is exact and keeps the squares of any finite vector within range.
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _place(label, dims: int, tree: int, path: str) -> int:
    """The number of a node: the same for every task."""
    return xxhash.xxh3_64_intdigest(f"{label}|{dims}|{tree}|{path}".encode()) - (1 << 63)


def _grow(sample: pd.DataFrame, trees: int, levels: int, leaf: float, overlap: float, seed: int) -> dict[int, float]:
    """Node -> split value of the trees fitted to a sample; nodes that are not in it are leaves."""
    cuts: dict[int, float] = {}
    for (label, dims), rows in sample.groupby(["label", sample["vec"].map(len)]):
        units = _units(rows["vec"])
        for tree in range(trees):
            values = units @ _directions(trees, levels, dims, seed)[tree].T
            stack = [("", np.arange(len(units)))]
            while stack:
                path, at = stack.pop()
                if len(at) <= leaf or len(path) >= levels:
                    continue
                x = values[at, len(path)]
                cut = float(x.mean())
                sides = at[x < cut + overlap], at[x >= cut - overlap]
                if max(map(len, sides)) > 0.97 * len(at):
                    continue  # dense along this direction: left to the splits of all rows
                cuts[_place(label, dims, tree, path)] = cut
                stack += [(path + str(side), own) for side, own in enumerate(sides)]
    return cuts


def _route(cuts, trees: int, levels: int, overlap: float, seed: int):
    """(rep, tree, level, node) of every vector: the leaves it falls into, in every tree."""
    def run(frames):
        for pdf in frames:
            out = []
            for (label, dims), rows in pdf.groupby(["label", pdf["vec"].map(len)]):
                units, reps = _units(rows["vec"]), rows["rep"].to_numpy()
                for tree in range(trees):
                    values = units @ _directions(trees, levels, dims, seed)[tree].T
                    stack = [("", np.arange(len(units)))]
                    while stack:
                        path, at = stack.pop()
                        if not len(at):
                            continue
                        node = _place(label, dims, tree, path)
                        cut = cuts.value.get(node)
                        if cut is None:
                            out.append(pd.DataFrame({"rep": reps[at], "tree": tree, "level": len(path), "node": node}))
                        else:
                            x = values[at, len(path)]
                            stack += [(path + "0", at[x < cut + overlap]), (path + "1", at[x >= cut - overlap])]
            yield pd.concat(out) if out else pd.DataFrame({"rep": [], "tree": [], "level": [], "node": []})
    return run


def _project(trees: int, levels: int, seed: int):
    """Adds to (rep, tree, level, node, before, vec) the projection ``x`` of the row's tree and level."""
    def run(frames):
        for pdf in frames:
            x = np.zeros(len(pdf))
            for (dims, tree, level), at in pdf.groupby([pdf["vec"].map(len), "tree", "level"]).indices.items():
                x[at] = _units(pdf["vec"].iloc[at]) @ _directions(trees, levels, dims, seed)[tree, level]
            yield pdf[["rep", "tree", "level", "node", "before"]].assign(x=x)
    return run


def _held(leaves, index: dict[int, int]) -> np.ndarray:
    """Which of the indexed leaves each vector is in, as 0 and 1."""
    out = np.zeros((len(leaves), max(1, len(index))), np.float32)
    for row, own in enumerate(leaves):
        for x in own:
            if x in index:
                out[row, index[x]] = 1
    return out


def _compare(threshold: float):
    """One pair of blocks of a leaf -> per vector, its links that this leaf counts, and one link into its cluster."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        leaf = key[0]
        left, right = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        same = key[1] == key[2]
        rows, cols = left, (left if same else right)
        if not len(rows) or not len(cols):
            return pd.DataFrame({"rep": [], "n": [], "other": []})
        near = _units(rows["vec"]) @ _units(cols["vec"]).T >= threshold
        if same:
            near = np.triu(near, 1)
        a, b = rows["rep"].to_numpy(), cols["rep"].to_numpy()
        # A pair counts here only if no earlier leaf holds both of its vectors.
        early = {x: k for k, x in enumerate(sorted({x for h in rows["leaves"] for x in h if x < leaf}))}
        held_a, held_b = _held(rows["leaves"], early), _held(cols["leaves"], early)
        first = near & (held_a @ held_b.T < 0.5)
        n_a, n_b = first @ cols["size"].to_numpy(np.float64), first.T @ rows["size"].to_numpy(np.float64)
        # Clusters of the block: labels sink to the smallest that links reach.
        low_a, low_b = a.copy(), b.copy()
        top = np.iinfo(np.int64).max
        while True:
            to_b = np.minimum(low_b, np.where(near, low_a[:, None], top).min(axis=0))
            to_a = np.minimum(low_a, np.where(near, to_b[None, :], top).min(axis=1))
            if same:
                to_a = to_b = np.minimum(to_a, to_b)
            if (to_a == low_a).all() and (to_b == low_b).all():
                break
            low_a, low_b = to_a, to_b
        out = pd.DataFrame({"rep": np.concatenate([a, b]), "n": np.concatenate([n_a, n_b]).astype(np.int64),
                            "other": np.concatenate([low_a, low_b])})
        return out[(out["n"] > 0) | (out["rep"] != out["other"])]
    return run


def _leaves(reps: DataFrame, trees: int, levels: int, leaf: int, overlap: float, seed: int, sample_rows: int) -> DataFrame:
    """(rep, leaf): the leaves of every vector of ``reps(rep, label, vec)``.

    The upper levels are fitted on a bounded sample and every vector is sent down
    them in one pass. Nodes that still hold many rows are split further from
    statistics of all their rows, level by level.
    """
    total = reps.count()
    sample = bounded_sample(reps, "rep", sample_rows).select("rep", "label", "vec").toPandas().sort_values("rep")
    size = max(16.0, leaf * min(1.0, len(sample) / max(1, total)))
    cuts = reps.sparkSession.sparkContext.broadcast(_grow(sample, trees, levels, size, overlap, seed))
    nodes = cut_lineage(reps.select("rep", "label", "vec").mapInPandas(
        _route(cuts, trees, levels, overlap, seed), "rep long, tree int, level int, node long").withColumn("before", F.lit(1 << 60).cast("long")))
    done = None
    while True:
        stats = nodes.groupBy("node").agg(F.count("*").alias("k"))
        sized = nodes.join(stats, "node")
        # Hardly smaller than its parent: dense along several directions, left to pairs of blocks.
        ended = (F.col("k") <= 4 * leaf) | (F.col("k") > 0.97 * F.col("before")) | (F.col("level") >= levels)
        closed = sized.filter(ended).select("rep", F.col("node").alias("leaf"))
        done = closed if done is None else done.unionByName(closed)
        open_ = cut_lineage(sized.filter(~ended).drop("before").withColumnRenamed("k", "before"))
        if open_.isEmpty():
            return cut_lineage(done)
        x = cut_lineage(open_.join(reps.select("rep", "vec"), "rep").mapInPandas(
            _project(trees, levels, seed), "rep long, tree int, level int, node long, before long, x double"))
        means = x.groupBy("node").agg(F.avg("x").alias("mean"))
        sides = F.array_compact(F.array(F.when(F.col("x") < F.col("mean") + overlap, F.lit(0)), F.when(F.col("x") >= F.col("mean") - overlap, F.lit(1))))
        nodes = cut_lineage(x.join(means, "node").select("rep", "tree", (F.col("level") + 1).alias("level"), "node", "before", F.explode(sides).alias("side"))
                            .withColumn("node", F.xxhash64("node", "side")).drop("side"))


def near_duplicates(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                    threshold: float = THRESHOLD, trees: int = TREES, levels: int = LEVELS, leaf: int = LEAF, block: int = BLOCK,
                    overlap: float | None = None, sample_rows: int = SAMPLE_ROWS, seed: int = 11) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    base = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"), F.col(label).alias("label"))
    finite = "size(vec) > 0 AND forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(vec, x -> x <> 0)"
    able = F.expr(f"coalesce(id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL AND ({finite}), false)")
    rows = cut_lineage(base.withColumn("name", F.when(able, F.md5(F.to_json(F.struct("label", "vec"))))).withColumn("vec", F.when(able, F.col("vec"))))
    good = rows.filter("name IS NOT NULL")
    classes = cut_lineage(good.groupBy("name").agg(F.min("id").alias("rep"), F.count("*").alias("size")))
    reps = cut_lineage(good.join(classes, (good["name"] == classes["name"]) & (good["id"] == classes["rep"])).drop(classes["name"])
                       .select("rep", "size", "label", "vec", "name").dropDuplicates(["name"]))
    # A class number stands for (label, vector) even where ids repeat.
    reps = reps.withColumn("cls", F.xxhash64("name"))
    dims = reps.agg(F.max(F.size("vec"))).first()[0] or 1
    margin = overlap if overlap is not None else math.sqrt(2 - 2 * threshold) / math.sqrt(dims)
    homes = _leaves(reps.select(F.col("cls").alias("rep"), "label", "vec"), trees, levels, leaf, margin, seed, sample_rows)
    mine = homes.groupBy("rep").agg(F.array_sort(F.collect_set("leaf")).alias("leaves"))  # some leaves per tree
    load = homes.groupBy("leaf").agg(F.count("*").alias("k")).filter("k > 1").withColumn("parts", F.ceil(F.col("k") / block).cast("int"))
    cut = homes.join(load, "leaf").select("leaf", "rep", "parts", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int").alias("b"))
    # Block b meets every block: it is the left side with those after it, the right side with those before it.
    cells = cut.select("leaf", "rep", F.explode(F.expr(
        "transform(sequence(0, parts - 1), o -> struct(least(b, o) AS i, greatest(b, o) AS j, IF(b <= o, 0, 1) AS side))")).alias("c")) \
        .select("leaf", "rep", "c.*")
    body = reps.select(F.col("cls").alias("rep"), "vec", "size").join(mine, "rep")
    found = cut_lineage(cells.join(body, "rep").groupBy("leaf", "i", "j").applyInPandas(_compare(threshold), "rep long, n long, other long"))
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    names = reps.select(F.col("cls"), F.col("rep").alias("id"))
    pairs = found.filter("rep <> other").select("rep", "other").distinct() \
        .join(names.toDF("rep", "a"), "rep").join(names.toDF("other", "b"), "other").select("a", "b")
    parts = components(pairs)
    per_class = reps.select("name", "cls", F.col("rep").alias("id"), "size").join(counts.withColumnRenamed("rep", "cls"), "cls", "left") \
        .join(parts.withColumnRenamed("vertex", "id"), "id", "left") \
        .selectExpr("name", "coalesce(n, 0) + size - 1 AS links", "coalesce(component, id) AS comp")
    placed = rows.select("id", "name").join(per_class, "name", "left")
    return placed.selectExpr("id AS vec_id", "coalesce(links, 0L) AS n_links", "coalesce(comp, id) AS component_id",
                             "coalesce(id = coalesce(comp, id), true) AS kept")
