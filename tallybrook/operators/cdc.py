"""Routing change-capture envelopes to one topic per source table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Topic name prefix and the tables the router lets through.
TOPIC_PREFIX = "ODS_T_"
INSERT_ONLY_TABLES = ("order_info",)
ROUTED_TABLES = (
    "base_province",
    "user_info",
    "spu_info",
    "sku_info",
    "base_category3",
    "base_trademark",
    "order_detail",
)


# Where envelopes go that cannot be read or name no table.
DEAD_LETTER_TOPIC = "ODS_DEAD_LETTER"


def _topic(table: Column) -> Column:
    return F.concat(F.lit(TOPIC_PREFIX), F.upper(table))


def _field(value: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(value, path, kind)


def _key(table: Column, row: Column, key_fields: dict[str, str] | None) -> Column:
    """The message key: field ``id``, or the field a table names in ``key_fields``."""
    key = _field(row, "$.id")
    for name, field in (key_fields or {}).items():
        key = F.when(table == name, _field(row, f"$.{field}")).otherwise(key)
    return key


def _unfolded(
    df: DataFrame, value: str, keep: list[str], rows: Callable[[Column], Column]
) -> DataFrame:
    """``keep``, the envelope's ``table`` and ``type``, and one ``row`` per element of ``rows``.

    The envelope is parsed once, into a variant, which keeps numbers as they are written. A
    generator stands between it and the filters to come: otherwise Spark would parse the text
    for each of them. ``raw`` holds the text of envelopes that cannot be routed.
    """
    parsed = df.select(
        *keep, value, F.explode(F.array(F.try_parse_json(F.col(value)))).alias("_envelope")
    )
    table, kind = _field(F.col("_envelope"), "$.table"), _field(F.col("_envelope"), "$.type")
    named = parsed.select(
        *keep,
        table.alias("table"),
        kind.alias("type"),
        F.when(table.isNull(), F.col(value)).alias("raw"),
        F.when(table.isNotNull(), rows(F.col("_envelope"))).alias("_rows"),
    )
    return named.select(*keep, "table", "type", "raw", F.explode_outer("_rows").alias("row"))


def _routed(
    rows: DataFrame,
    keep: list[str],
    kept: Column,
    key_fields: dict[str, str] | None,
    dead_letter: str | None,
    more: list[str],
    tombstones: bool,
    record: str | None,
) -> DataFrame:
    """Topic rows of ``rows`` where ``kept``, and of unreadable ones if they have a topic.

    With ``tombstones`` a deleted row is a message without a value.
    """
    gone = F.lower("type") == "delete" if tombstones else F.lit(False)
    lost = F.col("raw").isNotNull()
    wanted = kept if dead_letter is None else kept | lost
    if record is None:
        text = F.when(gone, F.lit(None)).otherwise(F.to_json("row"))
        out = [F.coalesce("raw", text).alias("value")]
    else:
        # No second text is written and parsed: fields come from the parsed envelope.
        fields = StructType.fromDDL(record).fields
        out = [_field(F.col("row"), f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in fields]
    return rows.where(F.coalesce(wanted, F.lit(False))).select(
        *keep,
        F.when(lost, F.lit(dead_letter)).otherwise(_topic(F.col("table"))).alias("topic"),
        _key(F.col("table"), F.col("row"), key_fields).alias("key"),
        *out,
        *more,
    )


def route_canal(
    df: DataFrame,
    value: str = "value",
    keep: list[str] | None = None,
    key_fields: dict[str, str] | None = None,
    dead_letter: str | None = None,
    tombstones: bool = False,
    record: str | None = None,
) -> DataFrame:
    """Array envelopes to ``topic, key, value``, one row per element of ``data``.

    Every statement type passes; with ``tombstones`` rows of deletes pass as a key without a
    value, else as any other row. With ``record`` its fields take the place of ``value``, as
    ``records.parse_json`` would read them from it. Envelopes without rows give none. Those that are no JSON
    object or name no table go to the topic ``dead_letter`` as they are, or nowhere.
    """
    if record is not None and dead_letter is not None:
        raise ValueError("unreadable envelopes have no fields: give record or dead_letter")
    keep = keep or []
    rows = _unfolded(df, value, keep, lambda e: _field(e, "$.data", "array<variant>"))
    # The array may hold JSON nulls, which are no rows.
    present = F.col("row").isNotNull() & ~F.is_variant_null("row")
    return _routed(rows, keep, present, key_fields, dead_letter, [], tombstones, record)


def route_maxwell(
    df: DataFrame,
    value: str = "value",
    keep: list[str] | None = None,
    routed: tuple[str, ...] = ROUTED_TABLES,
    insert_only: tuple[str, ...] = INSERT_ONLY_TABLES,
    key_fields: dict[str, str] | None = None,
    dead_letter: str | None = None,
    tombstones: bool = False,
) -> DataFrame:
    """Object envelopes to ``topic, key, value, type``.

    Kept are rows with a non-empty ``data`` object that are no deletes, from a
    routed table, or inserts from an insert-only table. With ``tombstones`` deletes from routed
    tables pass as a key without a value. Names are case-sensitive. Envelopes
    that are no JSON object or name no table go to the topic ``dead_letter``, or nowhere.
    """
    keep = keep or []
    rows = _unfolded(df, value, keep, lambda e: F.array(_field(e, "$.data", "variant")))
    table, kind = F.col("table"), F.col("type")
    kept = (
        F.col("row").isNotNull()
        & ~F.is_variant_null("row")
        & (F.schema_of_variant("row") != "OBJECT<>")
        & (kind.isNotNull() if tombstones else kind != "delete")
        & (table.isin(*routed) | (table.isin(*insert_only) & (kind == "insert")))
    )
    return _routed(rows, keep, kept, key_fields, dead_letter, ["type"], tombstones, None)
