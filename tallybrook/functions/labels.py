"""User labels derived from birthday and gender."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label texts stored in the user dimension.
AGE_UP_TO_20 = "20岁及以下"
AGE_21_TO_30 = "21岁到30岁"
AGE_OVER_30 = "30岁以上"
GENDER_MALE = "男"
GENDER_FEMALE = "女"


def age(birthday: Column, as_of: Column) -> Column:
    """Whole years of 365 days from ``birthday`` to ``as_of``, cut toward zero."""
    return F.call_function("div", F.datediff(as_of, birthday), F.lit(365))


def age_group(years: Column) -> Column:
    """Age label; an unknown age has none."""
    return (
        F.when(years < 20, AGE_UP_TO_20)
        .when(years > 30, AGE_OVER_30)
        .when(years.isNotNull(), AGE_21_TO_30)
    )


def gender_name(gender: Column) -> Column:
    """``M`` is male; everything else, null included, is female."""
    return F.when(gender == "M", GENDER_MALE).otherwise(GENDER_FEMALE)
