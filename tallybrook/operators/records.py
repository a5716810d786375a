"""JSON text to typed records and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType, StructField, StructType

# Wide enough for any 64-bit integer; read from JSON numbers and from quoted ones.
_ANY_INTEGER = DecimalType(20, 0)


def parse_json(
    df: DataFrame, schema: str, value: str = "value", keep: list[str] | None = None
) -> DataFrame:
    """Read ``value`` as a record of ``schema``; ``keep`` names other columns to carry.

    Integers and decimals may be quoted, as some change-capture tools write them.
    Text that is no JSON object gives a row of nulls. The record is unfolded by a
    generator, which later filters and projections are not merged into: otherwise
    Spark would parse the text again for every field they name.
    """
    fields = StructType.fromDDL(schema).fields
    whole = {f.name for f in fields if isinstance(f.dataType, IntegralType)}
    lenient = StructType(
        [StructField(f.name, _ANY_INTEGER if f.name in whole else f.dataType) for f in fields]
    )
    record = F.from_json(F.col(value), lenient)
    unfolded = df.select(*(keep or []), F.inline_outer(F.array(record)))
    typed = [
        F.col(f.name).try_cast(f.dataType).alias(f.name) if f.name in whole else F.col(f.name)
        for f in fields
    ]
    return unfolded.select(*(keep or []), *typed)


def to_json(df: DataFrame, columns: list[str] | None = None) -> Column:
    """The record as JSON text; null fields are left out."""
    return F.to_json(F.struct(*(columns or df.columns)))


def topic_rows(df: DataFrame, topic: Column | str, key: Column | None = None) -> DataFrame:
    """Shape records as ``topic, key, value`` rows for a topic sink."""
    name = F.lit(topic) if isinstance(topic, str) else topic
    k = F.lit(None) if key is None else key
    return df.select(
        name.alias("topic"), k.cast("string").alias("key"), to_json(df).alias("value")
    )
