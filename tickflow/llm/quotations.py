"""Quotation linking for chats and mails, with DataFrame functions only.

A line's quote level is the number of ``>`` marks in front of it.  The lines
of one level of a message are a passage: normalised (marks off, white space
collapsed, lower case) and hashed as runs of five words (a shorter passage
whole), so other line breaks or a cut inside a line do not matter, and line by
line, which also finds short lines.  The hashes are joined to those of earlier
messages' own words in the same conversation.  A message replies to the
nearest earlier message with most hits at the outermost linked level.  Every
hash votes for its nearest earlier holder, and all hits are counted for the
eight messages with most votes; the most of them is a bound.  A message with
as many hits holds one of any hashes that are too many to miss, so all holders
of the message's rarest hashes, just enough of them, are counted too: no
message that could win is left out.

Reply chains are resolved to their first message by pointer jumping, and the
messages of a conversation are ordered thread by thread, each thread in the
order of its turns (a reply always comes after the message it quotes).  The
text of a message is what remains without quoted lines and without the line
that announces them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickflow.llm.common import stored
from tickflow.operators.ordinal import ordinal

MARKS = r"^[ \t]*(?:>[ \t]?)+"
# A line that announces a quotation, when a quoted line follows.
ANNOUNCES = r"(?i)^(?:on .{1,300} wrote|.{1,100} (?:wrote|said|schrieb|a écrit|escribió)) ?:[ \t\r]*$"


def marks(line: Column) -> Column:
    return F.regexp_extract(line, MARKS, 0)


def level(line: Column) -> Column:
    """Quote level of a line: 0 for its author's own words."""
    front = marks(line)
    return F.length(front) - F.length(F.replace(front, F.lit(">"), F.lit("")))


def normal(line: Column) -> Column:
    """What is compared of a line."""
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(line, MARKS, ""), r"[ \t\x0b\f\r]+", " ")))


# Words of a run that is hashed, and messages whose hits give the bound.
RUN_WORDS, CANDIDATES = 5, 8


def hashed_units(lines: DataFrame) -> DataFrame:
    """(rid, conv, turn, level, h, ats) of every line and every run of words
    within one level of a message; ``ats``: the lines it lies in."""
    keys = ["rid", "conv", "turn", "level"]
    whole = lines.select(*keys, F.md5(F.concat(F.lit("line "), "norm")).alias("h"), F.array("at").alias("ats"))
    said = lines.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("at", "norm"))).alias("said"))
    said = said.select(
        *keys, F.flatten(F.transform("said", lambda x: F.split(x["norm"], " "))).alias("w"),
        F.flatten(F.transform("said", lambda x: F.transform(F.split(x["norm"], " "), lambda _: x["at"]))).alias("at"))
    said = stored(said, "passages")
    runs = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("w") - (RUN_WORDS - 1), F.lit(1))), lambda i: F.struct(
            F.md5(F.concat(F.lit("run "), F.array_join(F.slice("w", i, RUN_WORDS), " "))).alias("h"),
            F.array_distinct(F.slice("at", i, RUN_WORDS)).alias("ats")))
    return whole.unionByName(said.select(*keys, F.explode(runs).alias("r")).select(*keys, "r.h", "r.ats"))


def own_words(text: Column) -> Column:
    """The text without quoted lines and the lines that announce them, and
    without blank lines at its ends."""
    lines = F.split(text, "\n")

    def own(x, i):
        quoted_next = (i + 1 < F.size(lines)) & (level(F.coalesce(F.get(lines, i + 1), F.lit(""))) > 0)
        return (level(x) == 0) & ~(x.rlike(ANNOUNCES) & quoted_next)

    bare = F.array_join(F.filter(lines, own), "\n")
    return F.when(F.contains(text, F.lit(">")), F.regexp_replace(bare, r"^(?:[ \t\r]*\n)+|(?:\n[ \t\r]*)+$", "")) \
        .otherwise(text)


def thread_roots(replies: DataFrame) -> DataFrame:
    """(conv, turn, root) of the messages that reply to one (conv, turn, up):
    the first message of their thread, by pointer jumping."""
    now = stored(replies.select("conv", "turn", F.col("up").alias("root")), "reply-roots")
    while True:
        above = now.select(F.col("conv").alias("c2"), F.col("turn").alias("t2"), F.col("root").alias("r2"))
        step = now.join(above, (F.col("conv") == F.col("c2")) & (F.col("root") == F.col("t2")), "left")
        new = stored(step.select("conv", "turn", F.col("root").alias("was"),
                                 F.coalesce("r2", "root").alias("root")), "reply-roots")
        moved = new.where("was <> root").limit(1).count()
        now = new.select("conv", "turn", "root")
        if not moved:
            return now


def counted_hits(asked: DataFrame, sources: DataFrame, said: DataFrame) -> DataFrame:
    """(rid, source, hits): hashes ``asked`` for that the earlier messages of ``sources`` hold."""
    return (asked.join(sources, "rid").join(said, ["conv", "h", "source"])
            .groupBy("rid", "source").agg(F.sum("times").alias("hits")))


def link_quotations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                    role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per input row: conversation, turn, role, ``text`` (own words),
    ``n_quoted`` (quoted lines with words), ``max_level``, ``n_linked`` (quoted
    lines found in earlier messages, whole or in part), ``reply_to`` (turn, or null),
    ``thread_root`` (turn) and ``pos`` (0-based place in the conversation).

    A null text stays null and an empty one empty, with nothing quoted.  Rows
    with a null conversation or turn are kept, in order, but quote nothing and are not
    quoted.  Rows repeated with the same conversation and turn are links to
    the same place; each keeps its own row.  A line that is blank once its
    marks are off is not linked.  Other columns are not read.
    """
    m = messages.select(messages[conv_col].alias("conv"), messages[turn_col].cast("long").alias("turn"),
                        messages[role_col].cast("string").alias("role"),
                        messages[text_col].cast("string").alias("text"))
    m = stored(m.withColumn("rid", F.monotonically_increasing_id()), "messages")
    lines = (m.select("rid", "conv", "turn", F.posexplode(F.split("text", "\n")).alias("at", "line"))
             .select("rid", "conv", "turn", "at", level(F.col("line")).alias("level"), normal(F.col("line")).alias("norm"))
             .where("norm <> ''"))
    quoted = lines.where("level > 0")
    counted = quoted.groupBy("rid").agg(F.count(F.lit(1)).alias("n_quoted"), F.max("level").alias("max_level"))
    # only conversations with quotations are hashed, and only what is quoted is looked up
    placed = lines.where("conv is not null and turn is not null")
    units = stored(hashed_units(placed.join(quoted.select("conv").distinct(), "conv", "left_semi")), "quote-units")
    asked = units.where("level > 0")
    said = (units.where("level = 0").select("conv", "h", F.col("turn").alias("source")).distinct()
            .join(asked.select("conv", "h").distinct(), ["conv", "h"], "left_semi"))
    said = stored(said, "quote-sources")
    asking = (asked.groupBy("rid", "conv", "turn", "level", "h").agg(F.count(F.lit(1)).alias("times"))
              .withColumn("source", F.lit(None).cast("long")))
    both = asking.unionByName(said.withColumn("turn", F.col("source")), allowMissingColumns=True)
    # at equal turns the asking rows come first, so only earlier messages are found
    before = (Window.partitionBy("conv", "h").orderBy("turn", F.col("source").isNotNull())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = stored(both.withColumn("near", F.last("source", ignorenulls=True).over(before))
                   .where("rid is not null and near is not null").drop("source"), "quotes-found")
    most = Window.partitionBy("rid").orderBy("level", F.desc("votes"), F.desc("near"))
    chosen = (found.groupBy("rid", "level", "near").agg(F.sum("times").alias("votes"))
              .withColumn("place", F.row_number().over(most))
              .withColumn("outer", F.min("level").over(Window.partitionBy("rid")))
              .where((F.col("level") == F.col("outer")) & (F.col("place") <= CANDIDATES))
              .select("rid", "level", F.col("near").alias("source")))
    outer = found.join(chosen.select("rid", "level").distinct(), ["rid", "level"])
    hits = stored(counted_hits(outer, chosen.select("rid", "source"), said), "quote-hits")
    best = hits.groupBy("rid").agg(F.max("hits").alias("bound"))
    # the rarest hashes of a message whose bound is not all it asks for, until those left weigh less than the bound
    holders = said.groupBy("conv", "h").agg(F.count(F.lit(1)).alias("holders"))
    rare = Window.partitionBy("rid").orderBy("holders", "h")
    weigh = (outer.join(holders, ["conv", "h"]).join(best, "rid")
             .withColumn("all", F.sum("times").over(Window.partitionBy("rid")))
             .withColumn("before", F.coalesce(F.sum("times").over(rare.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
             .where((F.col("bound") < F.col("all")) & (F.col("all") - F.col("before") >= F.col("bound"))))
    others = (weigh.select("rid", "conv", "h", "turn").join(said, ["conv", "h"]).where("source < turn")
              .select("rid", "source").distinct().join(hits, ["rid", "source"], "left_anti"))
    hits = hits.unionByName(counted_hits(outer, others, said))
    replies_to = hits.groupBy("rid").agg(F.max_by("source", F.struct("hits", "source")).alias("reply_to"))
    touched = (asked.join(found.select("rid", "level", "h"), ["rid", "level", "h"])
               .select("rid", F.explode("ats").alias("at")).distinct()
               .groupBy("rid").agg(F.count(F.lit(1)).alias("n_linked")))
    chosen = replies_to.join(touched, "rid")
    linked = stored(m.select("rid", "conv", "turn").join(counted, "rid").join(chosen, "rid", "left"), "quotations")
    replies = (linked.where("reply_to is not null").groupBy("conv", "turn").agg(F.min("reply_to").alias("up")))
    roots = thread_roots(replies).select(F.col("conv").alias("rc"), F.col("turn").alias("rt"), "root")
    out = (m.join(linked.drop("conv", "turn"), "rid", "left")
           .join(roots, (F.col("conv") == F.col("rc")) & (F.col("turn") == F.col("rt")), "left")
           .select("rid", "conv", "turn", "role", own_words(F.col("text")).alias("text"),
                   F.coalesce("n_quoted", F.lit(0)).cast("long").alias("n_quoted"),
                   F.coalesce("max_level", F.lit(0)).cast("int").alias("max_level"),
                   F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "reply_to",
                   F.coalesce("root", "turn").alias("thread_root")))
    placed = ordinal(out, ["conv"], ["thread_root", "turn", "rid"], "pos").drop("rid")
    return placed.select(F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col),
                         F.col("text").alias(text_col), "n_quoted", "max_level", "n_linked", "reply_to",
                         "thread_root", F.col("pos").cast("long").alias("pos"))
