"""URL filter: host and path rules, and gradient-boosted trees for the rest; DataFrame operations only.

Rules are a short list of (verdict, host, path); the longest that fits a URL
decides. URLs that a rule decides are the labelled ones: trees boosted on their
lexical features judge the URLs no rule fits. Features are read from the texts of
URLs alone: lengths, depth, digit ratio, entropy, parameter counts, and statistics
of the suffix (its length, how many URLs have it, their mean length). Labels are
no part of a feature.

The trees are fitted on at most ``FIT_ROWS`` labelled URLs, chosen by the hash of
their text; features, rules and verdicts cover all rows.

Defined cases. A null URL, or one without ``://``, has an empty host and path and
fits no rule; it is judged like any other, by the features of an empty text. With
labels of one class only, or none, URLs without a rule are allowed. Null ids and
repeated rows are passed through row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tidegate.llm.common import bounded_sample
from tidegate.session import cut_lineage

FIT_ROWS = 20_000
FEATURES = ("url_len", "host_len", "path_len", "depth", "host_parts", "digits", "digit_ratio", "entropy", "n_params", "query_len",
            "hyphens", "suffix_len", "suffix_count", "suffix_mean_len")
Rule = tuple[str, str, str]  # verdict, host, path


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://`` up to ``/``, ``?``, ``#``; then up to ``?``, ``#``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def rule_columns(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits; of equally long ones, the first."""
    name = verdict = None
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        text = rule_host + rule_path
        name = F.when(fits, text) if name is None else name.when(fits, text)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    if name is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return name, verdict


def _entropy(text: Column) -> Column:
    """Bits per character of the characters of a text."""
    letters = F.filter(F.split(text, ""), lambda c: c != "")
    total = F.greatest(F.size(letters), F.lit(1)).cast("double")

    def part(c):
        share = F.size(F.filter(letters, lambda d: d == c)) / total
        return -share * F.log2(share)
    return F.aggregate(F.transform(F.array_distinct(letters), part), F.lit(0.0), lambda a, b: a + b)


def lexical(df: DataFrame) -> DataFrame:
    """Adds the lexical features of ``url``, ``host`` and ``path``."""
    url = F.coalesce("url", F.lit(""))
    query = F.when(F.instr(url, "?") > 0, F.substring_index(F.substring_index(url, "#", 1), "?", -1)).otherwise("")
    digits = F.length(url) - F.length(F.translate(url, "0123456789", ""))
    depth = F.size(F.filter(F.split("path", "/"), lambda p: p != ""))
    return (df.withColumn("url_len", F.length(url)).withColumn("host_len", F.length("host")).withColumn("path_len", F.length("path"))
            .withColumn("depth", depth).withColumn("host_parts", F.size(F.split("host", r"\.")))
            .withColumn("digits", digits).withColumn("digit_ratio", digits / F.greatest(F.length(url), F.lit(1)))
            .withColumn("entropy", _entropy(F.col("host"))).withColumn("query_len", F.length(query))
            .withColumn("n_params", F.size(F.filter(F.split(query, "&"), lambda p: p != "")))
            .withColumn("hyphens", F.length(url) - F.length(F.translate(url, "-", "")))
            .withColumn("suffix", F.substring_index("host", ".", -1)).withColumn("suffix_len", F.length("suffix")))


def judge(pages: DataFrame, rules: Sequence[Rule], *, key: str = "page_id", url: str = "url", rows: int = FIT_ROWS,
          rounds: int = 15, depth: int = 4) -> DataFrame:
    """(key, url, host, path, rule, verdict, block_probability) of every row."""
    base = pages.select(F.col(key).alias("key"), F.col(url).alias("url"))
    host, path = parts(F.col("url"))
    split = base.withColumn("host", host).withColumn("path", path)
    name, verdict = rule_columns(rules, F.col("host"), F.col("path"))
    ruled = split.withColumn("rule", name).withColumn("by_rule", verdict)
    # One row per suffix, aggregated before anything moves.
    suffixes = ruled.groupBy(F.substring_index("host", ".", -1).alias("suffix")).agg(
        F.avg(F.length(F.coalesce("url", F.lit("")))).alias("suffix_mean_len"), F.log2(F.count("*") + 1.0).alias("suffix_count"))
    featured = cut_lineage(lexical(ruled).join(suffixes, "suffix", "left"))
    labelled = featured.filter("by_rule IS NOT NULL").withColumn("label", (F.col("by_rule") == "block").cast("double"))
    kinds = {r[0] for r in labelled.select("label").distinct().collect()}
    out = featured.select("key", "url", "host", "path", "rule", "by_rule", *FEATURES)
    if len(kinds) < 2:
        judged = out.withColumn("block_probability", F.lit(0.0))
    else:
        # In a fixed order and few parts, so that sums, and hence trees, agree between runs.
        sample = bounded_sample(labelled, "url", rows).select("url", "label", *FEATURES).repartitionByRange(4, "url").sortWithinPartitions("url")
        gather = VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep")
        sample = cut_lineage(sample)
        share = sample.agg(F.avg("label")).first()[0]  # both classes weigh the same: the rules say little of how common each is
        weighed = sample.withColumn("weight", F.when(F.col("label") == 1, F.lit(1 - share)).otherwise(F.lit(share)))
        trees = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.2, seed=7, maxBins=64, weightCol="weight").fit(gather.transform(weighed))
        judged = trees.transform(gather.transform(out)).withColumn("block_probability", vector_to_array("probability")[1])
    verdict = F.coalesce("by_rule", F.when(F.col("block_probability") >= 0.5, "block").otherwise("allow"))
    return judged.select(F.col("key").alias(key), "url", "host", "path", "rule", verdict.alias("verdict"), "block_probability")
