"""Line-first quality rules: clean line by line, then judge what is left.

Everything is a column expression over one row, so a document costs no shuffle, and no
step is worse than ``n log n`` in its words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import SPACE, let, unused

SYMBOLS = "#*$%&|<>"
# A line without a mark from this list at its end and with few words is a heading or a menu entry.
SENTENCE_END = r"""[.!?:;,…。！？؟।"'”’»)\]]\s*$"""
MENU_MARK = "[|»›•·→]"
# Phrases begin and end at the edges of words.
_EDGES = (r"(?i)(?:^|[^\p{L}\p{N}])(?:", r")(?:$|[^\p{L}\p{N}])")
# What only notices say.
NOTICE = (
    r"all rights reserved|privacy policy|terms of (?:use|service)|"
    r"(?:licensed|released) under (?:cc|[^.]{0,60}licen[cs]e)|"
    r"(?:uses?|accept|accept all) cookies|cookie (?:policy|settings|consent)|"
    r"(?:enable|requires?) javascript|javascript is (?:disabled|required)"
).join(_EDGES)
# What buttons and links say, and sentences too: these count in lines of little else.
PROMPT = r"click here|read more|sign (?:in|up)|log ?in|share (?:this|on)|subscribe|powered by".join(_EDGES)
WORDS_A_PROMPT = 6
SHORT_LINE = 5
BOILERPLATE_WORDS = 30
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST_PERCENT = 50


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def _marks(line: Column, pattern: str) -> Column:
    return F.regexp_count(line, F.lit(pattern))


def line_fails(line: Column) -> Column:
    """Whether a line breaks a rule; lines without a word break none.

    Punctuation: fewer than ``SHORT_LINE`` words and no end of a sentence, or as many symbols
    or doubled exclamation marks as half the words. Navigation: three menu marks or more, one
    to every four words. Boilerplate, in lines of at most ``BOILERPLATE_WORDS``: a phrase of notices,
    or one of prompts to every ``WORDS_A_PROMPT`` words in a line that is no sentence.
    """

    def rules(n: Column) -> Column:
        menu, loud = _marks(line, MENU_MARK), _marks(line, r"[#*$%&<>]+|!!+")
        return (n > 0) & (
            ((n < SHORT_LINE) & ~line.rlike(SENTENCE_END))
            | ((loud >= 3) & (loud * 2 >= n))
            | ((menu >= 3) & (menu * 4 >= n))
            | ((n <= BOILERPLATE_WORDS) & line.rlike(NOTICE))
            | (
                (n <= BOILERPLATE_WORDS)
                & (_marks(line, PROMPT) * WORDS_A_PROMPT >= n)
                & ~line.rlike(SENTENCE_END)
            )
        )

    return let(F.size(_words(line)), rules)


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more; windows compare by 64-bit hash."""

    def covered(hashes: Column) -> Column:
        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(at: Column) -> Column:
            again = F.filter(
                at,
                lambda e, j: e["h"].eqNullSafe(F.get(at, j - 1)["h"])
                | e["h"].eqNullSafe(F.get(at, j + 1)["h"]),
            )
            return F.array_sort(F.transform(again, lambda e: e["i"]))

        def total(begin: Column) -> Column:
            gaps = F.transform(
                begin, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(begin, j + 1) - p, F.lit(3)))
            )
            return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)

        return let(let(ordered, starts), total)

    hashes = F.when(
        F.size(words) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    return let(
        hashes,
        lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0)).otherwise(covered(hs)),
    )


def verdict(text: Column, max_lost_percent: int = MAX_LOST_PERCENT) -> Column:
    """A struct of what the rules say about ``text``; a null text is an empty one.

    Fields: ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed``, ``n_failed_lines``, ``lost_chars``, ``cleaned`` and ``kept``. ``cleaned``
    is the text without the lines that fail. A document is kept if the base rules pass and the
    lines removed hold at most ``max_lost_percent`` of the characters of all lines.
    """

    def judged(t: Column) -> Column:
        def by_words(words: Column) -> Column:
            return F.struct(
                F.size(words).cast("long").alias("n_words"),
                _repeat_words(words).cast("long").alias("n_repeat_words"),
            )

        def by_lines(lines: Column) -> Column:
            worded = F.filter(lines, lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
            good = F.filter(lines, lambda line: ~line_fails(line))
            return let(
                good,
                lambda g: F.struct(
                    let(worded, lambda w: F.size(w) - F.size(F.array_distinct(w)))
                    .cast("long")
                    .alias("n_dup_lines"),
                    (F.size(lines) - F.size(g)).cast("long").alias("n_failed_lines"),
                    F.array_join(g, "\n").alias("cleaned"),
                    (F.length(t) - F.length(F.array_join(g, "\n"))).cast("long").alias("lost_chars"),
                ),
            )

        def together(w: Column, li: Column) -> Column:
            base = (w["n_words"] < MIN_WORDS) | (
                w["n_repeat_words"] * 100 > w["n_words"] * MAX_REPEAT_PERCENT
            )
            return F.struct(
                w["n_words"].alias("n_words"),
                _without(t, " \t\n\x0b\f\r").cast("long").alias("word_chars"),
                (F.length(t) - _without(t, SYMBOLS)).cast("long").alias("n_symbols"),
                li["n_dup_lines"].alias("n_dup_lines"),
                w["n_repeat_words"].alias("n_repeat_words"),
                base.alias("base_failed"),
                li["n_failed_lines"].alias("n_failed_lines"),
                li["lost_chars"].alias("lost_chars"),
                li["cleaned"].alias("cleaned"),
                (~base & (li["lost_chars"] * 100 <= F.length(t) * max_lost_percent)).alias("kept"),
            )

        return let(
            let(_words(t), by_words),
            lambda w: let(let(F.split(t, "\n", -1), by_lines), lambda li: together(w, li)),
        )

    return let(F.coalesce(text, F.lit("")), judged)


def judge(docs: DataFrame, text: str = "text", as_column: str = "quality") -> DataFrame:
    """All columns of ``docs`` and the verdict, one row per row; ``as_column`` must be unused.

    The verdict comes from a generator, so that a filter on it does not compute it again.
    """
    return docs.select("*", F.explode(F.array(verdict(F.col(f"`{text}`")))).alias(as_column))


def kept_documents(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The documents that the rules keep, with cleaned text and, where there, its length.

    Columns are those of ``docs``. Null and empty texts fail the base rules. Repeated rows are
    judged one by one; extra columns may have any name.
    """
    name = unused(docs, "quality")
    out = {
        text: F.col(f"{name}.cleaned"),
        n_chars: F.length(f"{name}.cleaned").cast(
            docs.schema[n_chars].dataType if n_chars in docs.columns else "long"
        ),
    }
    columns = [out[c].alias(c) if c in out else F.col(f"`{c}`") for c in docs.columns]
    return judge(docs, text, name).where(f"{name}.kept").select(*columns)
