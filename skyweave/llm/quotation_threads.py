"""Operator 8, chat formatting: quotation linking, by DataFrame functions only.

A line's quote level is the number of ``>`` it begins with (spaces or tabs between them); what follows them is its text.
Consecutive lines of one level make a passage. Quoted text is compared after ``normal``: A-Z lower-cased, runs of white
space made one space, ends trimmed; blank lines count for nothing. A message's own lines are those of level 0, without
"... wrote:" lines that stand right before a quote.

A quoted line of level 1 is linked, by its hash and then its text, to the own lines of the other messages of its
conversation that come before it. The message with most linked lines is the one replied to (of several, the latest).
Deeper levels show what that message quoted itself; they are counted and dropped like all quotes.

Reply order: a message follows the one it replies to, before anything that came later; messages without a linked quote
stand where they stood. The order is that of ``path``, the turns from the first message of a thread down to this one,
built by doubling: each round is a table in the shared folder, and joins paths to paths, so chains of n replies take
log2(n) rounds. ``position`` counts from 0 within the conversation; it is made of counts per bucket of threads and of replies,
and row numbers within buckets, so that a conversation, or a thread, with a third of all messages is no task of its own.

The content is the message's text without quotes and their introductions; ``formatted`` puts its role before it. Null
texts are empty, null roles are "unknown"; null conversations are each a conversation of their own and null turns come
first; several rows of one conversation and turn stay, ordered by role and text, and a link to that turn is to all of
them. Empty quotes link to nothing. Extra columns are left out of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .shared import SPACE, saved

MARKS = r"^(?:[\x20\t]*>)+"
BUCKET = 1024


def normal(line: Column) -> Column:
    lower = F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.btrim(F.regexp_replace(lower, f"[{SPACE}]+", " "), F.lit(" "))


def parsed(text: Column) -> Column:
    """Array of the lines: level, body (without marks), n (normalised), intro (introduces the quote after it)."""
    lines = F.transform(
        F.split(F.coalesce(text, F.lit("")), r"\r?\n", -1),
        lambda x: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 0), "[^>]+", "")).alias("level"),
            F.regexp_replace(x, MARKS + r"\x20?", "").alias("body"),
        ),
    )
    return F.get(
        F.transform(
            F.array(lines),
            lambda all_: F.transform(
                all_,
                lambda x, i: F.struct(
                    x["level"].alias("level"),
                    x["body"].alias("body"),
                    normal(x["body"]).alias("n"),
                    ((x["level"] == 0) & x["body"].rlike(r"wrote:[\x20\t]*$") & (F.coalesce(F.get(all_, i + 1)["level"], F.lit(0)) > 0)).alias("intro"),
                ),
            ),
        ),
        0,
    )


def messages(chats: DataFrame) -> DataFrame:
    """One row per message: conv (a key that is never null), conv_id, turn, at (turn, never null), role, lines, content."""
    rows = chats.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    conv = F.when(F.col("conv_id").isNotNull(), F.col("conv_id").cast("string")).otherwise(F.concat(F.lit("?"), F.xxhash64("turn", "role", "text").cast("string")))
    rows = rows.select(conv.alias("conv"), "*", F.coalesce("turn", F.lit(-(1 << 62))).alias("at"), F.explode(F.array(parsed(F.col("text")))).alias("lines"))
    own = F.filter("lines", lambda x: (x["level"] == 0) & ~x["intro"])
    content = F.btrim(F.array_join(F.transform(own, lambda x: x["body"]), "\n"), F.lit(" \t\n\r"))
    levels = F.coalesce(F.array_max(F.transform("lines", lambda x: x["level"])), F.lit(0))
    return rows.select("conv", "conv_id", "turn", "at", "role", "lines", content.alias("content"), levels.alias("quote_levels"))


def links(rows: DataFrame) -> DataFrame:
    """(conv, at, parent, n_linked): the message that each quoting message replies to. One row per message with a link.

    Own lines are reduced to one row per conversation, line and turn, and only lines that some message quotes are joined.
    """
    line = rows.select("conv", "at", F.explode("lines").alias("x")).where("x.n != ''")
    quoted = line.where("x.level = 1").select("conv", "at", F.xxhash64("x.n").alias("h"), F.col("x.n").alias("n")).distinct()
    wanted = quoted.select("conv", "h", "n").distinct()
    own = line.where("x.level = 0 and not x.intro").select("conv", F.col("at").alias("parent"), F.xxhash64("x.n").alias("h"), F.col("x.n").alias("n"))
    own = own.join(wanted, ["conv", "h", "n"], "left_semi").distinct()
    met = quoted.join(own, ["conv", "h", "n"]).where("parent < at")
    votes = met.groupBy("conv", "at", "parent").agg(F.count("*").alias("n_linked"))
    best = votes.groupBy("conv", "at").agg(F.max(F.struct("n_linked", "parent")).alias("best"))
    return best.select("conv", "at", "best.parent", "best.n_linked")


def paths(linked: DataFrame) -> DataFrame:
    """(conv, at, path) for each linked message: the turns from its thread's first message down to its own."""
    now = saved(linked.select("conv", "at", F.col("parent").alias("top"), F.array("at").alias("path")))
    while True:
        up = now.select("conv", F.col("at").alias("top"), F.col("top").alias("higher"), F.col("path").alias("above"))
        met = now.join(up, ["conv", "top"], "left")
        longer = saved(met.select("conv", "at", F.coalesce("higher", "top").alias("top"), F.when(F.col("above").isNull(), F.col("path")).otherwise(F.concat("above", "path")).alias("path"), F.col("above").isNotNull().alias("grew")))
        if longer.where("grew").isEmpty():
            return longer.select("conv", "at", F.concat(F.array("top"), "path").alias("path"))
        now = longer.drop("grew")


def threads(chats: DataFrame) -> DataFrame:
    """Per message: conv_id, turn, position, reply_to (turn or null), depth, n_linked, quote_levels, role, content, formatted."""
    rows = saved(messages(chats))
    linked = saved(links(rows))
    placed = rows.drop("lines").join(linked, ["conv", "at"], "left").join(paths(linked), ["conv", "at"], "left")
    placed = placed.withColumn("path", F.coalesce("path", F.array("at")))
    first, second = F.get("path", F.lit(0)), F.get("path", F.lit(1))
    placed = placed.withColumns({"a": F.floor(first / BUCKET), "b": first, "c": F.coalesce(F.floor(second / BUCKET), F.lit(-(1 << 62)))})
    placed = saved(placed)

    def running(counts: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
        earlier = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
        return counts.withColumn(name, F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")

    fine = saved(placed.groupBy("conv", "a", "b", "c").agg(F.count("*").alias("n")))
    coarse = running(fine.groupBy("conv", "a").agg(F.sum("n").alias("n")), ["conv"], ["a"], "before_a")
    fine = running(fine, ["conv", "a"], ["b", "c"], "before_c").join(coarse, ["conv", "a"])
    number = F.row_number().over(W.partitionBy("conv", "a", "b", "c").orderBy("path", "role", "content")) - 1
    out = placed.withColumn("number", number).join(fine, ["conv", "a", "b", "c"])
    out = out.withColumn("before", F.col("before_a") + F.col("before_c"))
    return out.select(
        "conv_id",
        "turn",
        (F.col("before") + F.col("number")).alias("position"),
        F.col("parent").alias("reply_to"),
        (F.size("path") - 1).cast("long").alias("depth"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.col("quote_levels").cast("long").alias("quote_levels"),
        "role",
        "content",
        F.concat(F.lit("<|"), "role", F.lit("|>\n"), "content", F.lit("\n")).alias("formatted"),
    )


def op8_quotation_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threads(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
