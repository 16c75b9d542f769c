"""Line-first cleaning with DataFrame functions only.

Every ``\\n``-split line with a word is held against three rules:

* punctuation: symbol characters outnumber a fifth of its words, or every
  letter is upper case, or it neither ends in terminal punctuation nor has
  at least ``SHORT_WORDS`` words;
* navigation: it is cut into many fields by ``|`` or other menu marks;
* boilerplate: it holds one of the stock phrases and has under
  ``FURNITURE_CHARS`` characters (a longer line is a paragraph that mentions
  one), or it equals an earlier line.

Failing lines are removed.  A document is rejected when it fails the base
rule, or when the removed lines held more than ``MAX_LOSS_PERCENT`` of its word
characters.  All of it happens inside the row: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import WORD_SPACE, words

SYMBOLS = "#*$%&|<>"
TERMINAL = ".!?…。！？:;\"'”’»)]"
SHORT_WORDS = 6
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOSS_PERCENT = 40
FURNITURE_CHARS = 400
# Stock phrases of site furniture, lower case.
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy",
    "accept cookies", "use of cookies", "enable javascript", "lorem ipsum", "click here",
    "sign up for our newsletter", "subscribe to our", "skip to content", "back to top", "share this",
)


def solid(text: Column) -> Column:
    """The text without its white space."""
    return F.translate(text, WORD_SPACE, "")


def symbols(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, SYMBOLS, ""))


def spaced_words(line: Column) -> Column:
    return F.size(words(line))


def line_facts(line: Column) -> Column:
    """What the rules look at of a line, each made once."""
    return F.struct(line.alias("line"), F.lower(line).alias("small"), F.length(line).alias("n"),
                    (F.length(line) - F.length(solid(line)) + 1).alias("white"), symbols(line).alias("symbols"))


def punctuation_fails(f: Column) -> Column:
    line = f["line"]
    end = F.right(F.rtrim(F.translate(line, "\t\x0b\x0c\r", " " * 4)), F.lit(1))
    open_end = F.instr(F.lit(TERMINAL), end) == 0
    shouted = (f["n"] > 20) & (f["small"] != line) & (F.upper(line) == line)
    return ((f["symbols"] > 2) & (f["symbols"] * 5 > f["white"])) | shouted | (open_end & (spaced_words(line) < SHORT_WORDS))


def navigation_fails(f: Column) -> Column:
    marks = f["n"] - F.length(F.translate(f["line"], "|»›•·", ""))
    return (marks > 2) & (marks * 5 > f["white"])


def boilerplate_fails(f: Column) -> Column:
    found = F.lit(False)
    for phrase in BOILERPLATE:
        found = found | F.contains(f["small"], F.lit(phrase))
    return (f["n"] < FURNITURE_CHARS) & found


def line_fails(f: Column) -> Column:
    return navigation_fails(f) | punctuation_fails(f) | boilerplate_fails(f)


def repeat_words(docs: DataFrame, word_col: str, out: str) -> DataFrame:
    """Adds ``out``: words covered by a 3-word window that occurs twice or
    more in the row's words.  The windows are sorted, so that equal ones are
    neighbours: n log n in the words of a text.  They are sorted by hash."""
    w, hashed = F.col(word_col), F.col("__hashed")
    docs = docs.withColumn("__hashed", F.transform(w, lambda x: F.xxhash64(x)))
    docs = docs.withColumn("__marks", F.when(F.size(w) > 3, F.transform(
        F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(hashed[i], hashed[i + 1], hashed[i + 2]))))
    # only texts in which a window's hash comes twice have windows to sort
    marks = F.col("__marks")
    repeated = F.size(F.array_distinct(marks)) < F.size(marks)
    docs = docs.withColumn("__windows", F.when(repeated, F.sort_array(
        F.transform(marks, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    s = F.col("__windows")

    def same(x, y):
        # words are compared where the hashes agree
        return (x["h"] == y["h"]) & (w[x["i"]] == w[y["i"]]) & (w[x["i"] + 1] == w[y["i"] + 1]) & (w[x["i"] + 2] == w[y["i"] + 2])

    again = F.filter(s, lambda x, k: ((k > 0) & same(x, F.get(s, k - 1)))
                     | ((k < F.size(s) - 1) & same(x, F.get(s, k + 1))))
    docs = docs.withColumn("__again", F.sort_array(F.transform(again, lambda x: x["i"])))
    # a window at p covers p, p+1, p+2; what the next window covers anew is counted there
    covered = F.aggregate(F.col("__again"), F.struct(F.lit(0).alias("n"), F.lit(-3).alias("end")),
                          lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["end"])).alias("n"),
                                                  p.alias("end")),
                          lambda acc: acc["n"])
    return docs.withColumn(out, F.coalesce(covered, F.lit(0)).cast("long")).drop("__windows", "__again", "__hashed", "__marks")


def line_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               max_loss_percent: int = MAX_LOSS_PERCENT) -> DataFrame:
    """One row per input row: id, ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``kept``,
    ``n_lines``, ``n_failed_lines``, ``kept_chars`` and ``clean_text``.

    ``clean_text`` is the text itself where no line fails, else its passing
    lines (blank ones and repeats left out) joined by ``\\n``.  A null or empty
    text has no words, so it fails the base rule; a null id stays null;
    repeated rows give repeated results; other columns are not read.
    """
    df = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    return _judge(df, max_loss_percent).select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_lines", "n_failed_lines", "kept_chars", "clean_text")


def clean_documents(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars",
                    max_loss_percent: int = MAX_LOSS_PERCENT) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns; the text is the
    clean text, and ``chars_col``, where there is one, its length."""
    df = _judge(docs.select(F.struct("*").alias("row"),
                            F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")), max_loss_percent)
    row = F.col("row").withField(f"`{text_col}`", F.col("clean_text"))
    if chars_col in docs.columns:
        row = row.withField(f"`{chars_col}`", F.length("clean_text").cast(docs.schema[chars_col].dataType))
    # A filter on the verdict alone would be pushed below the steps it is made by and evaluate them
    # many times over; one that needs the partition's number stays above them.
    held = df.select(row.alias("row"), "kept", F.spark_partition_id().alias("part"))
    return held.where("kept and part >= 0").select("row.*")


def _judge(df: DataFrame, max_loss_percent: int) -> DataFrame:
    df = df.withColumn("__words", words(F.col("text")))
    df = repeat_words(df, "__words", "n_repeat_words")
    df = df.withColumn("n_words", F.size("__words").cast("long")).drop("__words")
    df = df.withColumn("__lines", F.filter(F.split("text", "\n"), lambda x: solid(x) != ""))
    df = df.withColumn("__distinct", F.array_distinct("__lines"))
    facts = F.filter(F.transform("__distinct", line_facts), lambda f: ~line_fails(f))
    df = df.withColumn("__passed", F.transform(facts, lambda f: f["line"]))
    lost_none = F.size("__passed") == F.size("__lines")
    df = (df.withColumn("n_lines", F.size("__lines").cast("long"))
          .withColumn("n_dup_lines", (F.size("__lines") - F.size("__distinct")).cast("long"))
          .withColumn("n_failed_lines", (F.size("__lines") - F.size("__passed")).cast("long"))
          .withColumn("word_chars", F.length(solid(F.col("text"))).cast("long"))
          .withColumn("n_symbols", symbols(F.col("text")).cast("long"))
          .withColumn("clean_text", F.when(lost_none, F.col("text")).otherwise(F.array_join("__passed", "\n"))))
    df = df.withColumn("kept_chars", F.length(solid(F.col("clean_text"))).cast("long"))
    df = df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                       | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    lost = 100 * (F.col("word_chars") - F.col("kept_chars")) > max_loss_percent * F.col("word_chars")
    return df.withColumn("kept", ~F.col("base_failed") & ~lost)
