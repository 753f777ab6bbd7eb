"""Chat formatting by a grammar round trip.

A conversation becomes one text of marked turns::

    <s>[SYS]...[/SYS]</s>   <s>[INST]...[/INST]</s>   <s>[OUT]...[/OUT]</s>   <s>[ROLE]name[/ROLE]...</s>

for system, user, assistant and any other role. The reader is deterministic: it
cuts the text at every control string, then takes four control strings a turn,
which must be `<s>`, a tag, the same tag's end and `</s>`; a control string in
any other place is an error. A conversation is rendered as it is and read again;
if the turns read differ from the source, the content in conflict is escaped (one
backslash more after the first character of each control string, however many it
has already) and the result read again. A reader always takes one backslash away,
so text that looks escaped is itself in conflict. The second reading cannot
differ; if it did, the job would fail. DataFrame functions only.

Turns are ordered by turn (null last), equal ones by role and text, so repeated
rows stay and reruns agree. Null text and null roles count as empty; rows without
a conv_id are one conversation whose id is null; an empty table gives an empty
result; extra columns are ignored. A conversation is one row of the output and so
has to fit into one: it is the only thing gathered, in time linear in its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The tags of the known roles, the tag of all others, and the marks of a turn.
TAGS = {"system": "SYS", "user": "INST", "assistant": "OUT"}
OTHER = "ROLE"
BEGIN, END = "<s>", "</s>"
LEARNED = "assistant"  # the role whose texts are under the loss mask

_NAMES = "|".join([*TAGS.values(), OTHER])
CONTROL = rf"</?s>|\[/?(?:{_NAMES})\]"
# A control string with any number of backslashes after its first character, in three groups.
_ESCAPABLE = rf"(<)(\\*)(/?s>)|(\[)(\\*)(/?(?:{_NAMES})\])"
_ESCAPED = rf"(<)\\(\\*/?s>)|(\[)\\(\\*/?(?:{_NAMES})\])"
BLOCK = 1024  # turns whose offsets are summed one after the other


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPABLE, r"$1$4\\$2$5$3$6")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$3$2$4")


def _rendered(turns: Column, form) -> Column:
    def one(t: Column) -> Column:
        tag = F.element_at(F.create_map(*(F.lit(x) for pair in TAGS.items() for x in pair)), t["role"])
        named = F.concat(F.lit(f"{BEGIN}[{OTHER}]"), form(t["role"]), F.lit(f"[/{OTHER}]"), form(t["text"]), F.lit(END))
        known = F.concat(F.lit(f"{BEGIN}["), tag, F.lit("]"), form(t["text"]), F.lit("[/"), tag, F.lit(f"]{END}"))
        return F.coalesce(known, named)
    return F.array_join(F.transform(turns, one), "")


def read(df: DataFrame, column: str = "formatted") -> DataFrame:
    """``df`` with ``parsed``: the turns (role, text, start, stop) of ``column``, null where it is not of the grammar.

    start and stop are the code points of the text as written, before unescaping.
    """
    # One column a step: what later steps read several times is then worked out once.
    cut = df.withColumns({"__pieces": F.split(column, CONTROL, -1), "__marks": F.regexp_extract_all(column, F.lit(CONTROL), F.lit(0))})
    rows = cut.withColumn("__rows", _turns(F.col("__pieces"), F.col("__marks"))).drop("__pieces", "__marks")
    sized = rows.withColumn("__lengths", F.transform("__rows", lambda t: t["whole"]))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size("__lengths") - 1) / BLOCK).cast("int")),
                         lambda b: _running(F.slice("__lengths", b * BLOCK + 1, BLOCK)))
    spread = F.transform(F.arrays_zip(F.col("__blocks").alias("r"), _running(F.transform("__blocks", lambda r: r["sum"]))["before"].alias("o")),
                         lambda z: F.transform(z["r"]["before"], lambda x: x + z["o"]))
    placed = (sized.withColumn("__blocks", F.when(F.size("__lengths") > 0, blocks)).withColumn("__at", F.flatten(spread))
              .drop("__blocks", "__lengths"))
    turns = F.transform(F.arrays_zip(F.col("__rows").alias("t"), F.col("__at").alias("at")), lambda z: F.struct(
        z["t"]["role"].alias("role"), z["t"]["text"].alias("text"), (z["at"] + z["t"]["lead"]).alias("start"),
        (z["at"] + z["t"]["lead"] + z["t"]["chars"]).alias("stop")))
    nothing = F.array().cast("array<struct<role:string,text:string,start:bigint,stop:bigint>>")
    return placed.withColumn("parsed", F.when(F.size("__rows") == 0, nothing).otherwise(turns)).drop("__rows", "__at")


def _running(values: Column) -> Column:
    """The sum of the values, and the sum before each of them."""
    start = F.struct(F.lit(0).cast("bigint").alias("sum"), F.array().cast("array<bigint>").alias("before"))
    return F.aggregate(values, start, lambda acc, x: F.struct(
        (acc["sum"] + x).alias("sum"), F.concat(acc["before"], F.array(acc["sum"])).alias("before")))


def _turns(pieces: Column, marks: Column) -> Column:
    """The turns with their lengths; null if a mark is missing or out of place."""
    tag_of = F.create_map(*(F.lit(x) for role, tag in TAGS.items() for x in (f"[{tag}]", role)))

    def one(i: Column) -> Column:
        p, m = (lambda k: F.get(pieces, i * 4 + k)), (lambda k: F.get(marks, i * 4 + k))
        other = m(1) == f"[{OTHER}]"
        sound = ((m(0) == BEGIN) & (m(3) == END) & (p(0) == "") & (p(1) == "") & ~m(1).startswith("[/") & m(1).startswith("[")
                 & (m(2) == F.concat(F.lit("[/"), F.substring(m(1), 2, 99))) & (other | (p(3) == "")))
        lead = F.length(m(0)) + F.length(m(1)) + F.when(other, F.length(p(2)) + F.length(m(2))).otherwise(0)
        whole = sum((F.length(p(k)) + F.length(m(k)) for k in range(4)), F.lit(0).cast("bigint"))
        body = F.when(other, p(3)).otherwise(p(2))
        turn = F.struct(F.when(other, unescape(p(2))).otherwise(F.element_at(tag_of, m(1))).alias("role"),
                        unescape(body).alias("text"), lead.alias("lead"), F.length(body).alias("chars"), whole.alias("whole"))
        return F.when(sound, turn)
    complete = (F.size(marks) % 4 == 0) & (F.element_at(pieces, -1) == "")
    found = F.transform(F.slice(F.sequence(F.lit(0), F.floor(F.size(marks) / 4).cast("int")), F.lit(1), F.floor(F.size(marks) / 4).cast("int")), one)
    return F.when(complete, F.when(F.exists(found, lambda t: t.isNull()), None).otherwise(found))


def _same(parsed: Column, turns: Column) -> Column:
    return F.transform(parsed, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).eqNullSafe(turns)


def format_chats(conversations: DataFrame) -> DataFrame:
    """Per conversation: conv_id, formatted, and mask, the (start, stop) code points of formatted that are learned."""
    rows = conversations.select("conv_id", F.col("turn").isNull().alias("late"), "turn", F.coalesce("role", F.lit("")).alias("role"),
                                F.coalesce("text", F.lit("")).alias("text"))
    gathered = (rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("late", "turn", "role", "text"))).alias("turns"))
                .withColumn("turns", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))))
    plain = read(gathered.withColumn("formatted", _rendered(F.col("turns"), lambda text: text)))
    settled = plain.withColumn("formatted", F.when(_same(F.col("parsed"), F.col("turns")), F.col("formatted"))
                               .otherwise(_rendered(F.col("turns"), escape))).drop("parsed")
    checked = read(settled).withColumn("formatted", F.when(_same(F.col("parsed"), F.col("turns")), F.col("formatted"))
                                       .otherwise(F.raise_error(F.lit("a conversation does not read back"))))
    mask = F.transform(F.filter("parsed", lambda t: t["role"] == LEARNED), lambda t: F.struct(t["start"].alias("start"), t["stop"].alias("stop")))
    return checked.select("conv_id", "formatted", mask.alias("mask"))


def masked_text(parsed: Column) -> Column:
    """All text under the loss mask, unescaped, without anything between."""
    return F.array_join(F.transform(F.filter(parsed, lambda t: t["role"] == LEARNED), lambda t: t["text"]), "")


def digests(formatted: DataFrame) -> DataFrame:
    """Per row of ``format_chats``, read back from its text: turns, their digest, and the text under the mask."""
    back = read(formatted.select("conv_id", "formatted")).withColumn("learned", masked_text(F.col("parsed")))
    listing = F.array_join(F.transform("parsed", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("parsed").cast("long").alias("n_turns"), F.sha2(listing, 256).alias("turns_sha256"),
                       F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
