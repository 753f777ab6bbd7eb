"""The registered queries of this package, each over its whole table, and their SQL twins where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.llm import (bpe, brown, chat, cnn, embeddings, minhash, mixing, phrases, pii, rules, urls,
                          variants, wrappers)
from tidegate.llm.common import fold, table


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


OP2_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS BIGINT) AS w
  FROM sums),
-- Fill by rising cap per weight: the sources before a place are at their cap, the others share the rest.
filled AS (
  SELECT *, (SELECT sum(source_size) FROM weighed) AS total,
         sum(w) OVER o AS w_here,
         coalesce(sum(3 * source_size) OVER (ORDER BY 3.0 * source_size / w, source NULLS LAST
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped_before
  FROM weighed WINDOW o AS (ORDER BY 3.0 * source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
marked AS (SELECT *, (total - capped_before) * w > 3 * source_size * w_here AS over FROM filled),
goal AS (
  SELECT source, source_size,
         CASE WHEN over THEN 3.0::DOUBLE * source_size
              ELSE CAST(total - (SELECT coalesce(sum(3 * source_size), 0) FROM marked WHERE over) AS DOUBLE) * w
                   / CAST((SELECT sum(w) FROM marked WHERE NOT over) AS DOUBLE) END AS target,
         CAST('0x' || substr(md5('offset:' || coalesce(source, 'null')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u
  FROM marked),
placed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, g.u,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0::DOUBLE END AS rate,
         row_number() OVER (PARTITION BY s.source ORDER BY s.size NULLS FIRST, s.doc_id NULLS FIRST) AS rank
  FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rank * rate + u) - floor((rank - 1) * rate + u)) AS BIGINT) AS taken
FROM placed
"""


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = cnn.fit(docs, table(spark, sf_dir, "labels"))
    return cnn.score(docs, net).select("doc_id", (fold(F.col("doc_id"), cnn.FOLDS) == 0).alias("held_out"), "score",
                                       F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = {i})) AS BIGINT) AS n_{kind}") for i, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.listing("base"), 256).alias("base_sha256"), pii.listing("spans").alias("spans"))


# The rules of the contract.
URL_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *rules.COUNTS, "base_failed", "kept")


def op7_brown_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score(table(spark, sf_dir, "documents"))


def op8_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    coded = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = wrappers.extract(table(spark, sf_dir, "pages"))
    return text.withColumn("n_chars", F.length("text").cast("long"))


# The conversation the contract adds.
ADDED = "INLINE(ARRAY(STRUCT(-7L, 0L, 'user', '</s>[INST] ok [/INST]'), STRUCT(-7L, 1L, 'assistant', '</s>[INST] ok [/INST]')))"


def op11_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.range(1).selectExpr(ADDED).toDF("conv_id", "turn", "role", "text")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat.digests(chat.format_chats(turns))


OP11_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
-- The rendered length: two marks of 3 and 4 characters, a tag and its end, role names only in the tag of other roles.
sized AS (
  SELECT *, 7 + 5 + 2 * CASE role WHEN 'system' THEN 3 WHEN 'user' THEN 4 WHEN 'assistant' THEN 3 ELSE 4 END
         + CASE WHEN role IN ('system', 'user', 'assistant') THEN 0
                ELSE length(regexp_replace(role, '(<)(\\*)(/?s>)|(\[)(\\*)(/?(?:SYS|INST|OUT|ROLE)\])', '\1\4\\\2\5\3\6', 'g')) END
         + length(regexp_replace(text, '(<)(\\*)(/?s>)|(\[)(\\*)(/?(?:SYS|INST|OUT|ROLE)\])', '\1\4\\\2\5\3\6', 'g')) AS chars
  FROM turns),
joined AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text) AS listing,
         coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '') AS learned,
         CAST(sum(chars) AS BIGINT) AS formatted_chars
  FROM sized GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(listing) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256, formatted_chars
FROM joined
"""


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH RECURSIVE
steps AS (  -- the table of the checksum: eight halvings of each byte
  SELECT i AS byte, i::BIGINT AS c, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT byte, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY byte) AS t FROM steps WHERE k = 8),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS d, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                  '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM documents),
long_runs AS (SELECT d, run, count(*) AS k FROM runs WHERE length(run) >= 6 GROUP BY d, run),
hashed AS (
  SELECT run, k, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, strlen(d || ':' || run)),
                         lambda i: ('0x' || substr(hex(encode(d || ':' || run)), 2 * i + 1, 2))::BIGINT)),
                         lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS h
  FROM long_runs, crc),
words AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
         CAST(sum(k) AS BIGINT) AS n FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(k) >= 5),
-- Near words share what is left when one letter is deleted, from either at the same place or from one of them.
cuts AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
holes AS (SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM cuts),
near AS (
  SELECT x.word, y.word AS other, y.n FROM holes x JOIN holes y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, w.word, w.n FROM holes x JOIN words w ON w.word = x.a || x.b
  UNION SELECT w.word, x.word, x.n FROM holes x JOIN words w ON w.word = x.a || x.b),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS form, max(n) AS form_n FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.form_n >= 5 * w.n THEN b.form END AS form,
         CASE WHEN b.form_n >= 5 * w.n THEN b.form_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)),
climb AS (
  SELECT word, word AS root, 0 AS k FROM forms
  UNION ALL SELECT c.word, f.form, k + 1 FROM climb c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL),
tops AS (SELECT word, arg_max(root, k) AS root FROM climb GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN tops USING (word)
"""


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS g
  FROM lists, (VALUES (1), (2), (3)) ks(k) WHERE len(w) >= k),
counts AS MATERIALIZED (SELECT lang, k, g, lang || chr(9) || g AS key, count(*) AS f FROM grams GROUP BY ALL),
sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
-- Each candidate once per cut, with both parts.
cand AS MATERIALIZED (
  SELECT lang, g, f AS a, k, 1 AS cut, split_part(g, ' ', 1) AS x, array_to_string(string_split(g, ' ')[2:], ' ') AS y FROM counts WHERE k >= 2 AND f >= 10
  UNION ALL SELECT lang, g, f, k, 2, array_to_string(string_split(g, ' ')[:2], ' '), split_part(g, ' ', 3) FROM counts WHERE k = 3 AND f >= 10),
covers AS (
  SELECT lang, g, max(a) AS covering FROM (
    SELECT lang, y AS g, a FROM cand WHERE k = 3 AND cut = 1 UNION ALL SELECT lang, x, a FROM cand WHERE k = 3 AND cut = 2)
  GROUP BY ALL),
cuts AS (
  SELECT c.lang, c.g, c.a, c.cut, x.f AS l, y.f AS r, CAST(1000000::HUGEINT * c.a * c.a // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cand c JOIN counts x ON x.key = c.lang || chr(9) || c.x JOIN counts y ON y.key = c.lang || chr(9) || c.y),
lowest AS (
  SELECT * FROM cuts LEFT JOIN covers USING (lang, g) WHERE covering IS NULL OR 100 * covering < 50 * a
  QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
  FROM (SELECT *, g AS phrase FROM lowest))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""


QUERIES = {f.__name__: f for f in (op1_embedding_near_dedup, op2_source_mixing, op3_quality_classifier, op4_personal_data, op5_url_filter, op6_quality_rules, op7_brown_lm_scores, op8_byte_level_bpe, op9_minhash_near_dedup, op10_html_wrappers,
                                  op11_chat_formatting, op12_spelling_variants, op13_phrase_collocations)}
SQL: dict[str, str] = {"op2_source_mixing": OP2_SQL, "op11_chat_formatting": OP11_SQL, "op12_spelling_variants": OP12_SQL,
                       "op13_phrase_collocations": OP13_SQL}
