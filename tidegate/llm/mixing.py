"""Mix sources to target weights by systematic sampling; DataFrame operations only.

Sources in code point order, null last, take the given weights in turn and share
all words by weight. A target stops at ``cap`` times its source's size; the excess
is shared again by weight until no target is above.

Every document of a source expects ``target / source size`` copies. The running
sum of expected copies starts at one random offset per source (a hash of its
name, so that reruns agree), and a document is taken once for each integer the
sum crosses. Documents are taken in order of size: prefix errors are below one
copy, so the words taken differ from the target by less than twice the size of
the source's largest document, and no document is taken more than ``cap`` times.

Because the expectation is the same within a source, the running sum is a rank.
Ranks come from a range partitioning by (source, size, id) with one offset per
partition and source, so a source holding a third of all rows spreads over many tasks.

Defined cases. A null text has size 0. Documents of size 0 take part and may be
copied, adding no words. A source without words has target 0 and takes nothing.
Null and empty source names are two sources. Rows that repeat another row are
ranked one after the other; rows with null ids come first among their size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegate.llm.common import WORD, spare
from tidegate.session import cut_lineage

WEIGHTS = (5, 2, 1)
CAP = 3


def _ranked(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``df`` with ``rank``: 1, 2, ... within ``group`` in the given order, without gathering a group in one task."""
    keys = [F.col(group).asc_nulls_last(), *[F.col(c).asc_nulls_first() for c in order]]
    # The part and the place in it are stored, so that counts and ranks refer to the same split.
    laid = cut_lineage(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                       .withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id()))
    sizes = laid.groupBy(group, "__part").agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col(group).alias("__group"), F.col("__part").alias("__p"), "__first",
                          F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    joined = laid.join(starts, F.col(group).eqNullSafe(F.col("__group")) & (F.col("__part") == F.col("__p")))
    return joined.withColumn("rank", F.col("__base") + F.col("__at") - F.col("__first") + 1) \
        .drop("__part", "__at", "__group", "__p", "__first", "__base")


def targets(sources: DataFrame, weights: Sequence[int], cap: int) -> DataFrame:
    """(source, source_size, target) of ``sources(source, source_size)``; all sums are exact integers."""
    place = _ranked(sources.withColumn("__all", F.lit(0)), "__all", ["__absent", "source"])
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int")).cast("long")
    table = cut_lineage(place.select("source", "source_size", w.alias("weight")))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    full, rest, share = "false", total, None
    while True:
        open_ = table.filter(f"NOT ({full})").agg(F.sum("weight").alias("w")).first()
        capped = table.filter(full).agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * cap
        rest, share = total - capped, open_["w"]
        if not share:
            break
        # Above the cap: rest * weight / share > cap * size, in integers.
        above = f"CAST({rest} AS DECIMAL(38,0)) * weight > CAST({cap * share} AS DECIMAL(38,0)) * source_size"
        fresh = table.filter(f"NOT ({full}) AND ({above})").limit(1).count()
        if not fresh:
            break
        full = f"({full}) OR ({above})"
    cap_to = F.col("source_size").cast("double") * cap
    part = F.lit(float(rest)) * F.col("weight") / F.lit(float(share or 1))
    return table.select("source", "source_size", F.when(F.expr(full), cap_to).otherwise(part).alias("target"))


def word_count(text: Column) -> Column:
    """Words of a text: starts of runs of other characters than ASCII white space; null has none."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def mix(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) for every row; ``copies`` is how often the mix takes it."""
    sized = cut_lineage(docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")))
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("__absent", F.col("source").isNull())
    goal = targets(sums, weights, cap).withColumnRenamed("source", "__source")
    placed = _ranked(sized, "source", ["size", "doc_id"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    head = F.substring(F.md5(F.concat(F.lit("offset:"), F.coalesce(F.col("source"), F.lit("null"))).cast("binary")), 1, 8)
    offset = F.conv(head, 16, 10).cast("long") / F.lit(float(1 << 32))
    upto = F.floor(F.col("rank") * F.col("rate") + F.col("u"))
    past = F.floor((F.col("rank") - 1) * F.col("rate") + F.col("u"))
    return (placed.join(goal, F.col("source").eqNullSafe(F.col("__source")))
            .withColumn("rate", rate).withColumn("u", offset)
            .select("doc_id", "source", "size", "source_size", "target", (upto - past).alias("copies")))




def repeat(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    Rows are matched by a hash of all their columns; equal rows add up their copies.
    """
    held = docs.columns
    row, copies, copy = spare(docs, "__row", "__copies", "__copy")
    cells = [F.to_json(F.struct(f.name)) if "map" in f.dataType.simpleString() else F.struct(f.name, F.col(f.name).isNull()) for f in docs.schema]
    named = docs.withColumn(row, F.xxhash64(F.lit("mix"), *cells))
    taken = mix(named, key=row, text=text, source=source, **how).groupBy("doc_id").agg(F.sum("copies").alias(copies)) \
        .filter(F.col(copies) > 0).withColumnRenamed("doc_id", row)
    return named.dropDuplicates([row]).join(taken, row) \
        .withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))).select(*held)
