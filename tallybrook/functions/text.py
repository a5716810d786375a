"""Search terms of texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# A term is a run of letters and digits; every Han character is a term by itself.
_BREAK = r"[^\p{L}\p{N}]+"
_HAN = r"(\p{IsHan})"
_WORD_CHARACTER = r"[\p{L}\p{N}&&[^\p{IsHan}]]"


def terms(text: Column) -> Column:
    """Lower-case search terms of a whole text, in order."""
    spaced = F.regexp_replace(F.lower(text), _HAN, " $1 ")
    return F.filter(F.split(spaced, _BREAK), lambda t: t != "")


def query_terms(spark: SparkSession, query: str) -> dict[str, bool]:
    """The distinct terms of a query, and whether each is a Han character."""
    one = spark.createDataFrame([(query,)], "q STRING")
    found = one.select(F.explode(F.array_distinct(terms(F.col("q")))).alias("t"))
    return {r.t: r.han for r in found.select("t", F.col("t").rlike(_HAN).alias("han")).collect()}


def mentions_any(text: Column, words: dict[str, bool]) -> Column:
    """Whether a whole text holds at least one term; stops at the first it meets.

    One pattern finds the terms in place, without cutting the text into an array. Texts
    that hold no term even as part of a word are settled without it.
    """
    if not words:
        return F.lit(False)
    bounded = rf"(?<!{_WORD_CHARACTER})(?:%s)(?!{_WORD_CHARACTER})"
    plain = [w for w, han in words.items() if not han]
    patterns = [w for w, han in words.items() if han]
    if plain:
        patterns.append(bounded % "|".join(plain))
    lower = F.lower(text)
    present = reduce(lambda a, b: a | b, [lower.contains(w) for w in words])
    return present & lower.rlike("|".join(patterns))
