"""The user dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.functions import labels


def label_users(users: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Add ``age_group`` and ``gender_name``; ages count to ``as_of``, today if not given."""
    day = F.current_date() if as_of is None else as_of
    return users.withColumns(
        {
            "age_group": labels.age_group(labels.age(F.col("birthday"), day)),
            "gender_name": labels.gender_name(F.col("gender")),
        }
    )
