"""Column statistics and data-quality tables.

Wide aggregates cover what needs one pass (null counts); value frequencies come
from one unpivot to (column, value) with map-side combine, so neither a column
with one dominant value nor a unique column gathers rows in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import NumericType, StringType

from tidegate.operators.quantiles import exact_quantiles
from tidegate.operators.schema import logical_type
from tidegate.session import share

QUANTILES = (0.0, 0.001, 0.01, 0.5, 0.99, 0.999, 1.0)


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, value, n) for every distinct value, nulls included as a value."""
    columns = list(columns or df.columns)
    cells = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in columns)
    return df.selectExpr(f"stack({len(columns)}, {cells}) AS (column, value)").groupBy("column", "value").agg(
        F.count("*").alias("n"))


def column_stats(df: DataFrame, columns: Sequence[str] | None = None, *, approximate: bool = False) -> DataFrame:
    """Per column: rows, null share, distinct non-null values and share of the commonest value.

    ``approximate`` swaps exact distinct counts and the dominance pass for
    HyperLogLog (dominance is then null) on very wide or very large tables.
    """
    columns = list(columns or df.columns)
    if approximate:
        wide = df.agg(F.count("*").alias("n"), *[e for i, c in enumerate(columns) for e in (
            F.expr(f"count_if(`{c}` IS NULL)").alias(f"null{i}"), F.approx_count_distinct(c).alias(f"uniq{i}"))])
        cells = ", ".join(f"'{c}', null{i}, uniq{i}" for i, c in enumerate(columns))
        return wide.selectExpr("n", f"stack({len(columns)}, {cells}) AS (column, n_null, nunique)").selectExpr(
            "column", "n AS n_rows", "n_null / nullif(n, 0) AS null_pct", "nunique",
            "CAST(NULL AS DOUBLE) AS dominance_pct")
    per_column = value_counts(df, columns).groupBy("column").agg(
        F.sum("n").alias("n_rows"), F.expr("sum(IF(value IS NULL, n, 0L))").alias("n_null"),
        F.count("value").alias("nunique"), F.max("n").alias("top"))
    return per_column.selectExpr("column", "n_rows", "n_null / n_rows AS null_pct", "nunique",
                                 "top / n_rows AS dominance_pct")


def registry(df: DataFrame, *, target: str | None = None, metadata: Sequence[str] = (),
             excluded: Sequence[str] = (), split: str | None = None) -> DataFrame:
    """One row per column: logical type, statistics and role flags."""
    types = [(f.name, logical_type(f.dataType)) for f in df.schema]
    roles = df.sparkSession.createDataFrame(
        [(c, t, c == target, c not in {target, split, *metadata, *excluded}) for c, t in types],
        "column string, dtype string, target boolean, feature boolean")
    return roles.join(column_stats(df), "column").selectExpr(
        "column", "dtype", "true AS available", "feature", "feature AS model", "target", "false AS derived",
        "null_pct", "nunique", "dominance_pct")


def null_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or df.columns)
    wide = df.agg(F.count("*").alias("n"), *[F.expr(f"count_if(`{c}` IS NULL)").alias(f"n{i}")
                                             for i, c in enumerate(columns)])
    cells = ", ".join(f"'{c}', n{i}" for i, c in enumerate(columns))
    return wide.selectExpr("n AS n_rows", f"stack({len(columns)}, {cells}) AS (column, n_null)").selectExpr(
        "column", "n_rows", "n_null / nullif(n_rows, 0) AS null_pct")


def dominant_values(df: DataFrame, columns: Sequence[str] | None = None, share_of_rows: float = 0.5) -> dict[str, tuple[int, int, int]]:
    """Per column (rows, nulls, rows of the commonest value if it holds ``share_of_rows`` or more, else 0), nulls a value too.

    No distinct value is shuffled: mergeable frequent-item sketches name the few
    values that can hold such a share, and a second pass counts those exactly.
    """
    columns = list(columns or df.columns)
    most = max(1, int(1 / share_of_rows))  # so many values can hold the share at once
    # The sketch overrates by less than a tenth of the share, so twice as many items hold all that reach it.
    tracked = max(64, 1 << (40 * most - 1).bit_length())
    cells = [f"CAST(`{c}` AS STRING)" for c in columns]
    first = df.agg(F.count("*").alias("n"), *[e for i, v in enumerate(cells) for e in (
        F.expr(f"count_if({v} IS NULL)").alias(f"null{i}"), F.expr(f"approx_top_k({v}, {2 * most}, {tracked})").alias(f"top{i}"))]).first()
    found = [[x["item"] for x in first[f"top{i}"] if x["item"] is not None] for i in range(len(columns))]
    exact = df.agg(F.count("*").alias("n"), *[F.count_if(F.expr(v) == F.lit(x)).alias(f"c{i}_{k}")
                                              for i, (v, items) in enumerate(zip(cells, found)) for k, x in enumerate(items)]).first()
    out = {}
    for i, c in enumerate(columns):
        top = max([first[f"null{i}"], *(exact[f"c{i}_{k}"] for k in range(len(found[i])))])
        out[c] = (first["n"], first[f"null{i}"], top if first["n"] and top >= share_of_rows * first["n"] else 0)
    return out


def quality_columns(df: DataFrame, *, protected: Sequence[str] = (), null_threshold: float = 0.99,
                    constant_threshold: float = 1.0) -> list[str]:
    """Columns worth keeping: not too null, not too constant, or protected."""
    free = [c for c in df.columns if c not in set(protected)]
    stats = dominant_values(df, free, min(constant_threshold, 1.0)) if free else {}
    if any(not n for n, _, _ in stats.values()):
        raise ValueError("the source has no rows")
    drop = {c for c, (n, nulls, top) in stats.items() if nulls / n > null_threshold or top / n >= constant_threshold}
    return [c for c in df.columns if c not in drop]


def drop_poor_columns(df: DataFrame, **thresholds) -> DataFrame:
    return df.select(*quality_columns(df, **thresholds))


def data_card(df: DataFrame) -> DataFrame:
    """Rows, columns and per-column type, null share and distinct count."""
    types = df.sparkSession.createDataFrame(df.dtypes, "column string, dtype string")
    return column_stats(df).join(F.broadcast(types), "column").selectExpr(
        "column", "dtype", "n_rows", f"{len(df.columns)} AS n_columns", "null_pct", "nunique")


def observations(df: DataFrame, target: str) -> DataFrame:
    """Majority target share and the number of columns more than half missing."""
    majority = df.groupBy(target).agg(F.count("*").alias("n")).agg(
        F.expr("max(n) / sum(n)").alias("value")).withColumn("kind", F.lit("majority_share"))
    missing = null_rates(df).agg(F.expr("CAST(count_if(null_pct > 0.5) AS DOUBLE)").alias("value")).withColumn(
        "kind", F.lit("columns_over_half_missing"))
    return majority.unionByName(missing).select("kind", "value")


def key_cardinality(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and whether they match; counted via grouping so a hot key merges early."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("n_distinct")).selectExpr(
        "n_rows", "n_distinct", "n_rows = n_distinct AS one_to_one")


def label_distribution(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy(target).agg(F.count("*").alias("n_rows"))


def top_missing(df: DataFrame, n: int = 20) -> DataFrame:
    return null_rates(df).orderBy(F.desc("null_pct"), "column").limit(n).select("column", "null_pct")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that appear more than once (every member counts) and their share."""
    return df.groupBy(*df.columns).agg(F.count("*").alias("__n")).agg(
        F.expr("coalesce(sum(IF(__n > 1, __n, 0L)), 0L)").alias("duplicate_rows"),
        F.expr("coalesce(sum(IF(__n > 1, __n, 0L)), 0L) / nullif(sum(__n), 0)").alias("duplicate_rate"))


def bucket_histogram(df: DataFrame, column: str, buckets: int = 100) -> DataFrame:
    """Rows per bucket with empty buckets shown as 0."""
    counts = df.groupBy(F.col(column).cast("long").alias("bucket")).agg(F.count("*").alias("n_rows"))
    return df.sparkSession.range(buckets).withColumnRenamed("id", "bucket").join(counts, "bucket", "left").fillna(0)


def missing_targets(df: DataFrame, target: str) -> DataFrame:
    return df.filter(F.col(target).isNull())


def missing_by_target(df: DataFrame, target: str, min_spread: float = 0.25, max_classes: int | None = None) -> DataFrame:
    """Columns whose null share differs between target classes by ``min_spread`` or more.

    With ``max_classes``, empty for a target of more classes.
    """
    columns = [c for c in df.columns if c != target]
    rates = df.groupBy(target).agg(*[F.expr(f"avg(IF(`{c}` IS NULL, 1D, 0D))").alias(f"r{i}")
                                     for i, c in enumerate(columns)])
    cells = ", ".join(f"'{c}', r{i}" for i, c in enumerate(columns))
    tall = rates.selectExpr(f"`{target}`", f"stack({len(columns)}, {cells}) AS (column, rate)")
    return tall.groupBy("column").agg(
        F.min("rate").alias("min_null_rate"), F.max("rate").alias("max_null_rate"), F.count("*").alias("k"),
        F.count(target).alias("classes"),
    ).filter(f"k > 1 AND classes <= {max_classes if max_classes is not None else 'classes'} AND max_null_rate - min_null_rate >= {min_spread}").select(
        "column", "min_null_rate", "max_null_rate")


def categorical(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, StringType)]


def rare_categories(df: DataFrame, columns: Sequence[str] | None = None, share_of_rows: float = 0.005) -> DataFrame:
    """Per categorical column, values held by at most max(2, 0.5%) rows, with up to five examples.

    Examples are the smallest by (count, value); only five per column are kept
    while merging, never the whole list.
    """
    counts = share(value_counts(df, columns or categorical(df)))
    totals = counts.groupBy("column").agg(F.sum("n").alias("rows"))
    tiny = counts.join(F.broadcast(totals), "column").filter(f"n <= greatest(2, rows * {share_of_rows})")
    nth = F.row_number().over(Window.partitionBy("column").orderBy("n", F.col("value").asc_nulls_first()))
    shown = tiny.withColumn("k", nth).filter("k <= 5").groupBy("column").agg(
        F.expr("transform(array_sort(collect_list(struct(k, value))), x -> x.value)").alias("examples"))
    return tiny.groupBy("column").agg(F.count("*").alias("rare_category_count")).join(shown, "column")


def high_cardinality(df: DataFrame, columns: Sequence[str] | None = None, above: int = 50) -> DataFrame:
    return column_stats(df, columns or categorical(df)).filter(f"nunique > {above}").selectExpr(
        "column", "nunique AS cardinality")


def near_constant(df: DataFrame, share_of_rows: float = 0.995) -> DataFrame:
    """Columns with one value, or one value on at least 99.5% of rows."""
    stats = dominant_values(df, share_of_rows=min(share_of_rows, 1.0))
    # One row per column of the input.
    return df.sparkSession.createDataFrame([(c, top / n) for c, (n, _, top) in stats.items() if top], "column string, dominant_share double")


def datetime_review(df: DataFrame, as_of: str) -> DataFrame:
    """Parse failures, range and future rows of every DATE/TIME-named column, in one pass."""
    named = [c for c in df.columns if "DATE" in c.upper() or "TIME" in c.upper()]
    aggs = [F.count("*").alias("n")]
    for i, c in enumerate(named):
        parsed = f"try_cast(`{c}` AS TIMESTAMP_NTZ)"
        aggs += [F.expr(f"count({parsed})").alias(f"ok{i}"), F.expr(f"min({parsed})").alias(f"lo{i}"),
                 F.expr(f"max({parsed})").alias(f"hi{i}"),
                 F.expr(f"count_if({parsed} > timestamp_ntz'{as_of}')").alias(f"fut{i}")]
    cells = ", ".join(f"'{c}', ok{i}, lo{i}, hi{i}, fut{i}" for i, c in enumerate(named))
    return df.agg(*aggs).selectExpr(
        "n", f"stack({len(named)}, {cells}) AS (column, ok, min_value, max_value, future_rows)").selectExpr(
        "column", "1 - ok / n AS parse_failure_rate", "min_value", "max_value", "future_rows")


def outlier_scan(df: DataFrame, columns: Sequence[str] | None = None, *, approximate: bool = False) -> DataFrame:
    """Quantiles of each numeric column: exact with linear interpolation, or sketched on request."""
    columns = list(columns or [f.name for f in df.schema if isinstance(f.dataType, NumericType)])
    if approximate:
        points = ", ".join(str(q) for q in QUANTILES)
        row = df.agg(*[F.expr(f"percentile_approx(CAST(`{c}` AS DOUBLE), array({points}), 100000)") for c in columns]).first()
        found = {c: list(row[i] or [None] * len(QUANTILES)) for i, c in enumerate(columns)}
    else:
        found = exact_quantiles(df, columns, QUANTILES)
    names = [f"q{str(q).replace('.', '_')}" for q in QUANTILES]
    # One row per column of the input.
    return df.sparkSession.createDataFrame(
        [(c, *found[c]) for c in columns], "column string, " + ", ".join(f"{n} double" for n in names))


def profile_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Column-level comparison of two versions from their statistics tables."""
    a, b = column_stats(old), column_stats(new)
    sides = a.selectExpr("column", "null_pct AS old_null_pct", "nunique AS old_nunique").join(
        b.selectExpr("column", "null_pct AS new_null_pct", "nunique AS new_nunique"), "column", "full")
    return sides.selectExpr(
        "column", "CASE WHEN old_nunique IS NULL THEN 'added' WHEN new_nunique IS NULL THEN 'removed' ELSE 'kept' END AS change",
        "old_null_pct", "new_null_pct", "old_nunique", "new_nunique", "coalesce(new_nunique <= 1, false) AS constant_now")
