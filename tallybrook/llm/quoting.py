"""Quoted passages linked to the messages they come from, and replies put in order.

DataFrame operations only. A quote meets its original by the hash of its normalised text, so
each side is shuffled once by that hash; an original is the first message of a conversation
that wrote the text itself, one row however often it is repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import let, stored, unused
from tallybrook.llm.components import components

# A single line of a quoted passage is looked up too, in case the passage was put together anew.
# Shorter ones ("Thanks.") say little about where they come from; whole passages may be as short.
MIN_LINE_CHARS = 12
# A line that introduces a quote, which is not the writer's text.
INTRODUCES = r"(?i)^\s*(on|am|le|el)\b.*\b(wrote|schrieb.*|a écrit|escribió)\s*:\s*$"
_MARK = r"^((?:[ \t]*>)+)[ \t]?"


def lines_of(text: Column) -> Column:
    """An array of ``level, body``: how often a line is quoted, and the line without marks."""
    return F.transform(
        F.split(F.coalesce(text, F.lit("")), "\r?\n", -1),
        lambda line: F.struct(
            F.length(F.translate(F.regexp_extract(line, _MARK, 1), " \t", "")).alias("level"),
            F.regexp_replace(line, _MARK, "").alias("body"),
        ),
    )


def normalised(text: Column) -> Column:
    """Letters and digits in lower case, one space for everything between."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _passages(lines: Column) -> Column:
    """Lines of one level that follow each other without an empty one, joined by spaces."""
    starts = F.filter(
        F.sequence(F.lit(0), F.size(lines) - 1),
        lambda i: (i == 0)
        | (F.get(lines, i)["level"] != F.get(lines, i - 1)["level"])
        | (F.trim(F.get(lines, i - 1)["body"]) == ""),
    )

    def cut(at: Column) -> Column:
        return F.transform(
            at,
            lambda s, j: F.struct(
                F.get(lines, s)["level"].alias("level"),
                F.array_join(
                    F.transform(
                        F.slice(lines, s + 1, F.coalesce(F.get(at, j + 1), F.size(lines)) - s),
                        lambda x: x["body"],
                    ),
                    " ",
                ).alias("body"),
            ),
        )

    return let(starts, cut)


def parsed(text: Column) -> Column:
    """A struct: ``own`` (text without quotes), ``said`` and ``quoted`` (what can be looked up).

    ``said`` has the normalised own text, its passages and lines; ``quoted`` an array of
    ``level, body`` of quoted passages and their lines. Lines that introduce a quote are left out.
    """

    def by_lines(lines: Column) -> Column:
        own = F.filter(lines, lambda x, i: (x["level"] == 0) & ~(
            x["body"].rlike(INTRODUCES) & (F.coalesce(F.get(lines, i + 1)["level"], F.lit(0)) > 0)
        ))
        passages = let(lines, _passages)
        long_lines = F.filter(lines, lambda x: F.length(normalised(x["body"])) >= MIN_LINE_CHARS)
        quoted = F.filter(F.array_distinct(F.concat(passages, long_lines)), lambda x: x["level"] > 0)
        own_text = F.array_join(F.transform(own, lambda x: x["body"]), "\n")
        said = F.concat(
            F.array(own_text),
            F.transform(F.filter(passages, lambda x: x["level"] == 0), lambda x: x["body"]),
            F.transform(own, lambda x: x["body"]),
        )
        return F.struct(
            F.regexp_replace(own_text, r"^\s+|\s+$", "").alias("own"),
            F.array_remove(F.array_distinct(F.transform(said, normalised)), "").alias("said"),
            F.filter(
                F.array_distinct(
                    F.transform(
                        quoted,
                        lambda x: F.struct(x["level"].alias("level"), normalised(x["body"]).alias("body")),
                    )
                ),
                lambda x: x["body"] != "",
            ).alias("quoted"),
            F.size(F.filter(passages, lambda x: (x["level"] > 0) & (F.trim(x["body"]) != "")))
            .cast("long")
            .alias("n_quotes"),
        )

    return let(lines_of(text), by_lines)


def linked(
    messages: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text"
) -> DataFrame:
    """``messages`` without quotes, each with the message it answers; one row per row.

    ``text`` loses quoted lines and lines that introduce them. Added: ``n_quotes`` (quoted
    passages), ``n_linked`` (quoted texts found in an earlier message), ``parent_turn`` (the message
    that the longest text quoted at the first level comes from, the latest on ties; null if none) and
    ``thread_turn`` (the first message that its replies lead back to, else its own). In the order of
    conversation, ``thread_turn`` and turn every reply comes after what it answers, and result is
    range-sorted that way. Rows of one conversation and turn are one message. Rows where either is
    null are cleaned but not linked; a null text is an empty one. No rows give no rows. A name added
    that ``messages`` has already gets underscores before it.
    """
    c, t, p = (unused(messages, n) for n in ("conv", "turn_no", "parsed"))
    rows = messages.withColumns({c: F.col(f"`{conv}`"), t: F.col(f"`{turn}`")})
    rows = stored(
        rows.select("*", F.explode(F.array(parsed(F.col(f"`{text}`")))).alias(p)), "parsed"
    )
    known = rows.where(f"`{c}` is not null and `{t}` is not null")
    said = (
        known.select(F.col(c).alias("c"), F.col(t).alias("t"), F.explode(f"{p}.said").alias("body"))
        .groupBy("c", F.xxhash64("body").alias("h"), "body")
        .agg(F.min("t").alias("origin"))
        .drop("body")
    )
    quotes = known.select(
        F.col(c).alias("c"), F.col(t).alias("t"), F.explode(f"{p}.quoted").alias("q")
    ).select("c", "t", "q.level", F.xxhash64("q.body").alias("h"), F.length("q.body").alias("size"))
    found = (
        quotes.join(said, ["c", "h"])
        .where("origin < t")
        .groupBy("c", "t")
        .agg(
            F.count("*").alias("n_linked"),
            F.max(F.when(F.col("level") == 1, F.struct("size", "origin"))).alias("best"),
        )
    )
    found = stored(found.select("c", "t", "n_linked", F.col("best.origin").alias("parent_turn")), "links")
    edges = found.where("parent_turn is not null").select(
        F.struct("c", "t").alias("a"), F.struct("c", F.col("parent_turn").alias("t")).alias("b")
    )
    roots = components(edges, "a", "b").select("node.c", "node.t", F.col("root.t").alias("thread_turn"))
    names = ("c", "t", "n_linked", "parent_turn", "thread_turn")
    inner = {x: unused(rows, f"about_{x}") for x in names}
    about = found.join(roots, ["c", "t"], "full").select(*[F.col(x).alias(inner[x]) for x in names])
    same = (F.col(c) == F.col(inner["c"])) & (F.col(t) == F.col(inner["t"]))
    added = {
        "n_quotes": F.col(f"{p}.n_quotes"),
        "n_linked": F.coalesce(inner["n_linked"], F.lit(0).cast("long")),
        "parent_turn": F.col(inner["parent_turn"]),
        "thread_turn": F.coalesce(inner["thread_turn"], t),
    }
    added = {unused(messages, x): value for x, value in added.items()}
    order = [F.col(f"`{conv}`"), F.col(list(added)[-1]), F.col(f"`{turn}`")]
    n = int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        rows.join(about, same, "left")
        .select(
            *[F.col(f"{p}.own").alias(x) if x == text else F.col(f"`{x}`") for x in messages.columns],
            *[value.alias(x) for x, value in added.items()],
        )
        .repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
    )
