"""Text match over a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.text import mentions_any, query_terms


def match_search(
    df: DataFrame, text: str, query: str, sort_by: list[str], size: int | None = 10
) -> DataFrame:
    """Rows whose text holds any term of ``query``, lowest ``sort_by`` first.

    A result page has ``size`` rows; ``None`` gives all matches.
    """
    words = query_terms(df.sparkSession, query)
    hits = df.where(mentions_any(F.col(text), words)).orderBy(*sort_by)
    return hits if size is None else hits.limit(size)
