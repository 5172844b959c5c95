"""Conversations from messages that quote each other.

A message is parsed into its own lines and, by the number of leading ``>``, its quoted passages.
Passages are hashed after white space is evened out and joined to the messages whose own text has
that hash; where several have it, the one whose own first quotation is the message's second, and
then the earliest one, is the original. A partial quotation goes to the message that shares most of
its lines. Links only lead to earlier messages, so following them ends at the first message of a
conversation; the distance to it is the reply order.

Originals are one row per hash before they are joined, so a text that many messages share costs
one row, and no two messages are ever paired up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import let, settle

_MARKS = "^((?:[ \\t]{0,3}>)+)"
#: A line that introduces a quotation is not the author's text.
_INTRODUCES = "^[ \\t]*(?:On|Am|Le|El) .{1,200}(?:wrote|schrieb|a écrit|escribió)[ \\t]*:[ \\t]*$"
#: Shorter lines are too common to tell a partial quotation by.
_TELLING = 20


def _normal(text: Column) -> Column:
    """White space evened out; null for what is then empty."""
    even = F.trim(F.regexp_replace(text, "\\s+", " "))
    return F.when(even != "", even)


def parse(messages: DataFrame, key: str = "id", sent: str = "sent", text: str = "text") -> DataFrame:
    """(id, sent, own, passages): own text without quotations, and the passage of each level.

    ``passages`` holds the lines quoted once, then those quoted twice, and so on; a level that
    is skipped is an empty text. A null text is an empty one.
    """
    lines = F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "\n")

    def level(line: Column) -> Column:
        return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 1), "[^>]", ""))

    leveled = F.transform(
        lines, lambda x: F.struct(level(x).alias("level"), F.regexp_replace(x, _MARKS + "[ \\t]?", "").alias("line"))
    )

    def at(all_lines: Column, k) -> Column:
        return F.array_join(F.transform(F.filter(all_lines, lambda x: x["level"] == k), lambda x: x["line"]), "\n")

    def parts(found: Column) -> Column:
        real = F.filter(found, lambda x: (x["level"] > 0) | ~x["line"].rlike(_INTRODUCES))
        deepest = F.array_max(F.transform(found, lambda x: x["level"]))
        passages = F.when(deepest > 0, F.transform(F.sequence(F.lit(1), F.greatest(deepest, F.lit(1))), lambda k: at(real, k)))
        return F.struct(
            F.trim(at(real, 0), F.lit("\n")).alias("own"),
            F.coalesce(passages, F.array().cast("array<string>")).alias("passages"),
        )

    return messages.select(F.col(key).alias("id"), F.col(sent).alias("sent"), let(leveled, parts).alias("p")).select("id", "sent", "p.*")


def links(parsed: DataFrame) -> DataFrame:
    """(id, parent): the original of each message's first quotation, null where there is none."""

    def digest(text: Column) -> Column:
        return F.sha2(_normal(text), 256)

    place = F.struct(F.col("sent"), F.col("id"))
    once = parsed.where(F.col("id").isNotNull()).groupBy("id").agg(F.min(F.struct("sent", "own", "passages")).alias("m")).select("id", "m.*")
    once = settle(
        once.withColumns(
            {
                "own_hash": digest(F.col("own")),
                "first": digest(F.get("passages", F.lit(0))),
                "second": digest(F.get("passages", F.lit(1))),
            }
        ),
        "messages",
    )
    originals = once.where("own_hash is not null")
    chain = originals.groupBy(F.concat_ws(" ", "own_hash", F.coalesce("first", F.lit("-"))).alias("chain")).agg(F.min(place).alias("by_chain"))
    whole = originals.groupBy(F.col("own_hash").alias("first")).agg(F.min(place).alias("by_text"))
    asking = once.where("first is not null").select(
        "id", "sent", "first", "passages", F.concat_ws(" ", "first", F.coalesce("second", F.lit("-"))).alias("chain")
    )
    found = asking.join(chain, "chain", "left").join(whole, "first", "left").withColumn("place", F.coalesce("by_chain", "by_text"))
    direct = found.where("place is not null").select("id", place.alias("mine"), "place")
    # partial quotations: every telling line votes for the earliest message that has it
    def telling(text: Column) -> Column:
        return F.filter(F.transform(F.split(text, "\n"), _normal), lambda x: F.length(x) >= _TELLING)

    index = originals.select(F.explode(telling(F.col("own"))).alias("line"), place.alias("place")).groupBy("line").agg(F.min("place").alias("place"))
    votes = (
        found.where("place is null")
        .select("id", "sent", F.explode(F.array_distinct(telling(F.get("passages", F.lit(0))))).alias("line"))
        .join(index, "line")
        .groupBy("id", "sent", "place")
        .agg(F.count("*").alias("n"))
        .groupBy("id", "sent")
        .agg(F.max_by("place", F.struct("n", F.lit(0) - F.col("place.sent").cast("double"), F.col("place.id").cast("string"))).alias("place"))
        .select("id", F.struct("sent", "id").alias("mine"), "place")
    )
    linked = direct.unionByName(votes).where("place < mine").select("id", F.col("place.id").alias("parent"))
    return once.select("id").join(linked, "id", "left")


def threads(parents: DataFrame) -> DataFrame:
    """(id, thread, depth): the first message that replies lead back to, and how many steps away.

    Each round doubles the reach of the pointers that have not come to a first message yet; the
    others are put aside.
    """
    known = parents.select(
        "id",
        F.coalesce("parent", "id").alias("top"),
        F.col("parent").isNotNull().cast("long").alias("depth"),
        F.col("parent").isNull().alias("first"),
    )
    known = settle(known, "threads")
    done, moving = known.where("first"), known.where("not first")
    while not moving.isEmpty():
        every = done.unionByName(moving)
        up = every.select(F.col("id").alias("top"), F.col("top").alias("next"), F.col("depth").alias("more"), F.col("first").alias("there"))
        moved = settle(
            moving.join(up, "top").select(
                "id", F.col("next").alias("top"), (F.col("depth") + F.col("more")).alias("depth"), F.col("there").alias("first")
            ),
            "threads",
        )
        done, moving = done.unionByName(moved.where("first")), moved.where("not first")
    return done.select("id", F.col("top").alias("thread"), "depth")


def conversations(messages: DataFrame, key: str = "id", sent: str = "sent", text: str = "text") -> DataFrame:
    """(id, thread, parent, depth, n_levels, own): every message in its place, without quotations.

    Ordered by thread and depth the rows read as conversations in the order of replies. A message
    without a known original starts a thread; so does one without an id, whose thread is null.
    Rows that repeat an id are one message: each gets its row, and the first by time and text gives
    the links. A message that only quotes has an empty own text. Other columns are ignored, an
    empty table gives an empty result.
    """
    parsed = settle(parse(messages, key, sent, text), "parsed")
    parents = settle(links(parsed), "parents")
    found = threads(parents).join(parents, "id")
    rows = parsed.select("id", F.size("passages").cast("long").alias("n_levels"), "own")
    return rows.join(found, "id", "left").select("id", "thread", "parent", F.coalesce("depth", F.lit(0).cast("long")).alias("depth"), "n_levels", "own")


def chats(found: DataFrame) -> DataFrame:
    """(id, turns): for each message that nobody replied to, the own texts from the first one to it.

    ``found`` comes from ``conversations``. A chat is as long as its message is deep.
    """
    message = found.where("id is not null").groupBy("id").agg(F.min(F.struct("parent", "own")).alias("m")).select("id", "m.*")
    message = settle(message, "turns")
    replied = message.where("parent is not null").select(F.col("parent").alias("id")).distinct()
    open_ends = message.join(replied, "id", "left_anti").select("id", F.col("parent").alias("next"), F.array("own").alias("turns"))
    done = open_ends.where("next is null").select("id", "turns")
    while not (open_ends := settle(open_ends.where("next is not null"), "open-chats")).isEmpty():
        up = message.select(F.col("id").alias("next"), F.col("parent").alias("further"), "own")
        open_ends = open_ends.join(up, "next").select("id", F.col("further").alias("next"), F.concat(F.array("own"), "turns").alias("turns"))
        done = done.unionByName(open_ends.where("next is null").select("id", "turns"))
    return done


def quoted_mail(turns: DataFrame, levels: int = 2) -> DataFrame:
    """Messages as a mailing list would hold them, from the turns of conversations.

    Each message quotes the turn before it, and that one's quotation in turn, ``levels`` deep.
    Columns: conv_id, turn, id (conv_id/turn), sent (turn), text.
    """
    before = Window.partitionBy("conv_id").orderBy("turn", "text")
    rows = turns.select("conv_id", "turn", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    body = F.col("text")
    for k in range(1, levels + 1):
        quoted = F.regexp_replace(F.lag("text", k).over(before), "(?m)^", "> " * k)
        body = F.concat(body, F.coalesce(F.concat(F.lit("\n\n" if k == 1 else "\n"), quoted), F.lit("")))
    return rows.withColumn("mail", body).select(
        "conv_id", "turn", F.concat_ws("/", "conv_id", "turn").alias("id"), F.col("turn").alias("sent"), F.col("mail").alias("text")
    )
