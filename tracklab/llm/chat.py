"""Chat formatting by quotation linking, in DataFrame functions only.

Lines of a message carry a quote level, the number of leading ``>``.  Runs of lines of one
level are passages.  A quoted passage is normalised and hashed, and joined to the earliest
message of its conversation that holds the same passage as its own text.  A message replies
to the latest message that its quotes lead to; conversations are then ordered by replies, and
their messages hold no quotes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tracklab.llm.common import sheltered
from tracklab.sources.staging import stage

# Lines with fewer normalised characters decide only where nothing wider is found.
LINE_CHARS = 12
# Ends of the line that announces a quote.
ANNOUNCES = r"(?:wrote|writes|said|schrieb|a écrit|écrit|escribió) ?:$"
QUOTED = r"(?:^|\n)[ \t]*>"


def normal(text: Column) -> Column:
    """Lower case, white space as single blanks, trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), r"[\s\x0B]+", " "))


def _lines(messages: DataFrame) -> DataFrame:
    """(conv, turn, msg, pos, level, line): the lines of messages with their quote levels."""
    lines = messages.select("conv", "turn", "msg", F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    prefix = F.regexp_extract("raw", r"^[ \t]*>[ \t>]*", 0)
    return lines.select(
        "conv", "turn", "msg", "pos",
        (F.length(prefix) - F.length(F.replace(prefix, F.lit(">"), F.lit("")))).alias("level"),
        F.substring("raw", F.length(prefix) + 1, F.length("raw")).alias("line"))


def _passages(lines: DataFrame) -> DataFrame:
    """(conv, turn, msg, first, level, text): runs of lines of one level, in order within a message."""
    w = W.partitionBy("conv", "turn", "msg").orderBy("pos")
    starts = F.coalesce(F.lag("level").over(w) != F.col("level"), F.lit(True)).cast("int")
    runs = lines.withColumn("starts", starts).withColumn("run", F.sum("starts").over(w))
    grouped = runs.groupBy("conv", "turn", "msg", "level", "run").agg(
        F.min("pos").alias("first"), F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("all"))
    return grouped.select("conv", "turn", "msg", "first", "level",
                          F.array_join(F.transform("all", lambda x: x["line"]), "\n").alias("text"))


def _units(passages: DataFrame) -> DataFrame:
    """A row per unit of a passage, as a hash, and its ``kind``: 0 the whole, 1 its paragraphs, 2 pairs of lines, 3 lines, 4 short lines."""
    lines = F.transform(F.split("text", "\n"), normal)
    pairs = F.flatten(F.transform(F.array(lines), lambda n: F.zip_with(
        n, F.slice(n, 2, F.size(n)), lambda a, b: F.when((a != "") & (b != ""), F.concat_ws(" ", a, b)))))
    of_kind = lambda texts, kind: F.transform(texts, lambda x: F.struct(kind(x).cast("int").alias("kind"), x.alias("text")))
    units = F.concat(
        of_kind(F.array(normal(F.col("text"))), lambda x: F.lit(0)),
        of_kind(F.transform(F.split("text", r"\n[ \t]*\n"), normal), lambda x: F.lit(1)),
        of_kind(pairs, lambda x: F.lit(2)),
        of_kind(lines, lambda x: F.when(F.length(x) >= LINE_CHARS, 3).otherwise(4)))
    hashes = F.transform(F.filter(units, lambda u: u["text"] != ""), lambda u: F.struct(u["kind"], F.sha2(u["text"], 256).alias("unit")))
    return passages.withColumn("_u", F.explode(F.array_distinct(hashes))).select("*", "_u.kind", "_u.unit").drop("_u")


def _without_quotes(text: Column) -> Column:
    """The text without quoted lines and the lines that announce them, trimmed."""
    lines = F.split(text, "\n")
    kept = F.filter(F.transform(lines, lambda x, i: F.struct(x.alias("x"), F.get(lines, i + 1).alias("next"))), lambda s: ~(
        F.rlike(s["x"], F.lit(r"^[ \t]*>"))
        | (F.rlike(F.coalesce(s["next"], F.lit("")), F.lit(r"^[ \t]*>")) & F.rlike(F.trim(s["x"]), F.lit(ANNOUNCES)))))
    joined = F.array_join(F.transform(kept, lambda s: s["x"]), "\n")
    return F.regexp_replace(joined, r"^[\s\x0B]+|[\s\x0B]+$", "")


def links(messages: DataFrame) -> DataFrame:
    """(conv, turn, msg, level, first, original): quoted passages and the turn that first said them.

    Only conversations with a quote are read for originals.  Of a passage's units the widest
    that is found decides; ``original`` is null for passages found nowhere before the turn.
    """
    quoting = messages.filter(F.rlike("text", F.lit(QUOTED)))
    passages = stage(_passages(_lines(quoting)), "chat-passages")
    quotes = _units(passages.filter("level > 0"))
    own_text = messages.join(quotes.select(F.col("conv").alias("_c")).distinct(), F.col("conv").eqNullSafe(F.col("_c")), "left_semi")
    # A message's own text without quotes is whole; its unquoted runs are passages of their own.
    own = own_text.select("conv", "turn", _without_quotes(F.col("text")).alias("text"))
    runs = passages.filter("level = 0").select("conv", "turn", "text")
    said = _units(own.unionAll(runs)).groupBy(F.col("conv").alias("_c"), F.col("unit").alias("_u")).agg(F.min("turn").alias("said"))
    found = quotes.join(said, F.col("conv").eqNullSafe(F.col("_c")) & (F.col("unit") == F.col("_u")) & (F.col("said") < F.col("turn")), "left")
    # Units of a passage are copies of what one message said; the latest origin of the widest kind is the quoted message.
    widest = F.min(F.when(F.col("said").isNotNull(), F.struct("kind", (-F.col("said")).alias("back"))))
    return found.groupBy("conv", "turn", "msg", "level", "first").agg((-widest["back"]).alias("original"))


@sheltered("_m", "_c", "_t", "_r", "_pc", "_pt")
def linked(df: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """``df`` with the text free of quotes, and ``n_quotes``, ``n_linked``, ``max_level``, ``reply_to``, ``path``.

    ``reply_to`` is the turn that a message answers: the latest original of its outermost
    quotes, null if none is found.  ``path`` lists the turns from the first message of the
    thread to the message; ordering by conversation and path puts every reply after what it
    answers, threads in the order of their first turn.  Messages with equal conversation and
    turn are answered as one; a null text has no quotes and stays null; a null conversation
    is one conversation; messages without a turn answer nothing and are answered by nothing.
    """
    new = ("n_quotes", "n_linked", "max_level", "reply_to", "path")
    base = df.drop(*[c for c in df.columns if c.lower() in new])
    msg = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    plain = base.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), msg.alias("msg"),
                        F.col(text).alias("text")).filter("text is not null")
    found = stage(links(plain.distinct()), "chat-links")
    replies = found.groupBy("conv", "turn", "msg").agg(
        F.count(F.lit(1)).alias("n_quotes"), F.count("original").alias("n_linked"), F.max("level").alias("max_level"),
        F.max(F.when(F.col("level") == 1, F.col("original"))).alias("outer"), F.max("original").alias("any"),
    ).select("conv", "turn", "msg", "n_quotes", "n_linked", "max_level", F.coalesce("outer", "any").alias("reply_to"))
    replies = stage(replies, "chat-replies")
    paths = _paths(replies)
    out = base.withColumn("_m", msg)
    r = replies.select(F.col("conv").alias("_c"), F.col("turn").alias("_t"), F.col("msg").alias("_r"), "n_quotes", "n_linked", "max_level", "reply_to")
    out = out.join(r, F.col(conv).eqNullSafe(F.col("_c")) & (F.col(turn) == F.col("_t")) & (F.col("_m") == F.col("_r")), "left")
    p = paths.select(F.col("conv").alias("_pc"), F.col("turn").alias("_pt"), "path")
    out = out.join(p, F.col(conv).eqNullSafe(F.col("_pc")) & (F.col(turn) == F.col("_pt")), "left")
    quoted = F.rlike(F.col(text), F.lit(QUOTED))
    columns = [F.when(quoted, _without_quotes(F.col(text))).otherwise(F.col(text)).alias(c) if c == text else F.col(f"`{c}`") for c in base.columns]
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("n_quotes", "n_linked", "max_level")]
    own = F.array(F.col(turn).cast("long"))
    return out.select(*columns, *zero, "reply_to", F.coalesce("path", own).alias("path"))


def _paths(replies: DataFrame) -> DataFrame:
    """(conv, turn, path) of the turns that answer another: from the thread's first turn to the turn.

    Paths double in length every round, so rounds grow with the logarithm of the longest thread.
    """
    up = replies.filter("reply_to is not null").groupBy("conv", "turn").agg(F.max("reply_to").alias("up"))
    state = stage(up.select("conv", "turn", "up", F.array("up", "turn").alias("path")), "chat-paths")
    while not state.filter("up is not null").isEmpty():
        above = state.select(F.col("conv").alias("_c"), F.col("turn").alias("_t"), F.col("up").alias("_up"), F.col("path").alias("_path"))
        joined = state.join(above, F.col("conv").eqNullSafe(F.col("_c")) & (F.col("up") == F.col("_t")), "left")
        # the path above ends with the turn with which this one begins
        longer = F.when(F.col("_path").isNotNull(), F.concat(
            "_path", F.slice("path", F.lit(2), F.size("path")))).otherwise(F.col("path"))
        state = stage(joined.select("conv", "turn", F.col("_up").alias("up"), longer.alias("path")), "chat-paths")
    return state.select("conv", "turn", "path")


def conversations(df: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """``linked`` messages in reply order; equal places are ordered by the text.

    The order is a range sort on conversation and path, so a conversation of any size is
    spread over as many tasks as it needs.
    """
    out = linked(df, conv, turn, text)
    return out.orderBy(F.col(conv), F.col("path"), F.col(text))
