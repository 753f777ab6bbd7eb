"""Spelling variants by permuterm rotations.

A word and a terminator are written in a ring and read from every place; with all
rotations sorted, words that differ in one code point stand together. Of a
rotation that ends in a letter, that letter is the edited one: what stands before
it is a prefix. Rotations of one prefix and different last letters are words that
differ by a replaced letter, and a rotation equal to the prefix itself is the word
in which that letter is missing. So one scan of the rotations by prefix meets
every near pair; each pair differs at one place only, so it is met once (of equal
letters in a row only the first may be deleted).

A group holds at most one word per letter of the alphabet and one without, so it
is bounded by the alphabet (91 rows for the letters read here) however frequent
its words are. A member leaves the scan as one row, its number of neighbours and
the best of them; no pairs are written. Words are counted before any shuffle by
key, so a word that is a third of all text is one row per task.

Null texts hold no words, a null doc_id is written as empty text in the hash,
repeated rows count each time, an empty table gives an empty result, and columns
other than doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.session import cut_lineage

# The letters, the rule that drops a letter from some occurrences, and the bounds of a word.
RUN = r"[a-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DROP_EVERY = 199
MIN_CHARS, MIN_COUNT, FORM_FACTOR = 6, 5, 5
TERMINATOR = "$"  # no letter


def words(docs: DataFrame) -> DataFrame:
    """(word, n) of all texts: words of at least MIN_CHARS code points that occur MIN_COUNT times or more."""
    runs = (docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"),
                        F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run"))
            .filter(F.length("run") >= MIN_CHARS)
            .withColumn("h", F.crc32(F.concat("d", F.lit(":"), "run").cast("binary"))))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    dropped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % DROP_EVERY == 0, dropped).otherwise(F.col("run"))
    return (runs.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
            .filter((F.length("word") >= MIN_CHARS) & (F.col("n") >= MIN_COUNT)))


def rotations(counted: DataFrame) -> DataFrame:
    """(prefix, letter, first, n): every rotation as its own prefix (letter empty), and by what stands before its last letter.

    first marks the letter that may be deleted: of equal letters in a row, the first.
    """
    def entries(i: Column) -> Column:
        head, tail = F.substring("word", F.lit(1), i), F.substring("word", i + 1, F.length("word"))
        whole = F.struct(F.concat(tail, F.lit(TERMINATOR), head).alias("prefix"), F.lit("").alias("letter"), F.lit(False).alias("first"))
        letter = F.substring("word", i, F.lit(1))
        cut = F.struct(F.concat(tail, F.lit(TERMINATOR), F.substring("word", F.lit(1), i - 1)).alias("prefix"), letter.alias("letter"),
                       ((i == 1) | (letter != F.substring("word", i - 1, F.lit(1)))).alias("first"))
        return F.when(i == 0, F.array(whole)).otherwise(F.array(whole, cut))
    places = F.flatten(F.transform(F.sequence(F.lit(0), F.length("word")), entries))
    return counted.select("n", F.explode(places).alias("r")).select("r.prefix", "r.letter", "r.first", "n")


def near(counted: DataFrame) -> DataFrame:
    """(word, n_near, best): words with a near word, how many they have, and the most frequent (least on ties) as (n, word)."""
    def word(letter: Column) -> Column:
        return F.concat(F.substring_index("prefix", TERMINATOR, -1), letter, F.substring_index("prefix", TERMINATOR, 1))

    # The member without a letter is near those whose letter may be deleted, any other member near all that have another letter.
    def neighbours(m: Column) -> Column:
        return F.filter("members", lambda o: (o["letter"] != m["letter"]) & ((m["letter"] != "") | o["first"]) & ((o["letter"] != "") | m["first"]))

    def found(m: Column) -> Column:
        others = neighbours(m)
        return F.struct(word(m["letter"]).alias("word"), F.size(others).cast("bigint").alias("n_near"),
                        F.array_min(F.transform(others, lambda o: F.struct((-o["n"]).alias("minus"), word(o["letter"]).alias("near")))).alias("best"))
    groups = (rotations(counted).groupBy("prefix").agg(F.collect_list(F.struct("letter", "first", "n")).alias("members"))
              .filter(F.size("members") > 1))
    each = groups.select(F.explode(F.transform("members", found)).alias("m")).select("m.*").filter("n_near > 0")
    best = each.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    return best.select("word", "n_near", F.struct((-F.col("best.minus")).alias("n"), F.col("best.near").alias("word")).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each chain of (word, form). A form is more frequent than its word, so chains end."""
    held = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        up = held.select(F.col("word").alias("root"), F.col("root").alias("top"))
        moved = cut_lineage(held.join(up, "root", "left").select("word", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")))
        held = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return held


def group_variants(docs: DataFrame) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    counted = cut_lineage(words(docs.select("doc_id", "text")))
    best = (near(counted).join(counted, "word", "right")
            .withColumn("form", F.when(F.col("best.n") >= FORM_FACTOR * F.col("n"), F.col("best"))))
    held = cut_lineage(best.select("word", F.col("form.word").alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                              F.col("form.n").alias("form_n")))
    return (held.join(roots(held.filter("form IS NOT NULL")), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
