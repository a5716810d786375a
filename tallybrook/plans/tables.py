"""The test tables read as the warehouse's records.

Ids of spus and categories are the first 60 bits of a hash of their names, the
same in any engine. Dimension rows left out on purpose exercise unknown keys.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.functions.money import cents, money
from tallybrook.operators.lookup import enrich_sku
from tallybrook.operators.running import (
    chunked_running_totals,
    cut_into_ranges,
    running_totals,
)
from tallybrook.operators.skew import hot_keys
from tallybrook.operators.users import label_users

AS_OF = "2020-05-12"
STAT_TIME = "2020-05-12 00:00:00"
STATE_CUTOFF = "1995-07-01"
NO_PROVINCE_REGION = 4
NO_SKU_SIZE = 1
NO_TRADEMARK = "Brand#13"
NO_CATEGORY = "LARGE"
NO_SPU_SUFFIX = "bolt"

# Lines are numbered in this order within their order.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
# Line ids are order ids and line numbers side by side, for orders of fewer lines than this.
MOST_LINES = 1 << 32


def name_id(name: Column) -> Column:
    """A BIGINT id made from a name."""
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("bigint")


def _brand_id(column: str) -> Column:
    return F.split_part(column, F.lit("#"), F.lit(2)).cast("bigint")


@dataclass
class Tables:
    spark: SparkSession
    folder: str
    _read: dict[str, DataFrame | None] = field(default_factory=dict)

    def read(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]

    def orders(self) -> DataFrame:
        """Order facts without the fields the tables cannot supply."""
        return self.read("orders").select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderstatus").alias("order_status"),
            money(F.col("o_totalprice")).alias("final_total_amount"),
            F.col("o_orderdate").alias("create_time"),
        )

    def homes(self) -> DataFrame:
        return self.read("customer").select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_nationkey").cast("bigint").alias("province_id"),
        )

    def orders_with_province_id(self) -> DataFrame:
        return self.orders().join(self.homes(), "user_id", "left")

    def province(self) -> DataFrame:
        known = self.read("nation").where(F.col("n_regionkey") != NO_PROVINCE_REGION)
        return known.select(
            F.col("n_nationkey").cast("bigint").alias("id"),
            F.col("n_name").alias("name"),
            F.col("n_regionkey").cast("string").alias("region_id"),
            F.concat(F.lit("A"), F.col("n_nationkey")).alias("area_code"),
        )

    def users(self) -> DataFrame:
        """The user dimension; birthday and gender follow from the id."""
        c = self.read("customer")
        rows = c.select(
            F.col("c_custkey").alias("id"),
            F.col("c_mktsegment").alias("user_level"),
            F.date_add(
                F.lit("1960-01-01").cast("date"), (F.col("c_custkey") * 37 % 18000).cast("int")
            ).alias("birthday"),
            F.when(F.col("c_custkey") % 3 == 0, "M")
            .when(F.col("c_custkey") % 3 == 1, "F")
            .alias("gender"),
        )
        return label_users(rows, F.lit(AS_OF).cast("date"))

    def plain_skus(self) -> DataFrame:
        """Skus as their source table has them."""
        return self.read("part").select(
            F.col("p_partkey").alias("id"),
            name_id(F.col("p_name")).alias("spu_id"),
            money(F.col("p_retailprice")).alias("price"),
            F.col("p_name").alias("sku_name"),
            _brand_id("p_brand").alias("tm_id"),
            name_id(F.col("p_type")).alias("category3_id"),
            F.col("p_size"),
        )

    def categories(self) -> DataFrame:
        names = self.read("part").select(F.col("p_type").alias("name")).distinct()
        known = names.where(F.col("name") != NO_CATEGORY)
        return known.withColumn("id", name_id(F.col("name")))

    def trademarks(self) -> DataFrame:
        names = self.read("part").select(F.col("p_brand").alias("tm_name")).distinct()
        known = names.where(F.col("tm_name") != NO_TRADEMARK)
        return known.withColumn("id", _brand_id("tm_name"))

    def spus(self) -> DataFrame:
        names = self.read("part").select(F.col("p_name").alias("spu_name")).distinct()
        known = names.where(~F.col("spu_name").endswith(NO_SPU_SUFFIX))
        return known.withColumn("id", name_id(F.col("spu_name")))

    def skus(self) -> DataFrame:
        """The sku dimension with frozen names."""
        return enrich_sku(self.plain_skus(), self.categories(), self.trademarks(), self.spus())

    def stored_skus(self, skus: DataFrame | None = None) -> DataFrame:
        """The sku dimension as facts see it, some skus missing."""
        every = self.skus() if skus is None else skus
        return every.where(F.col("p_size") != NO_SKU_SIZE).drop("p_size")

    def lines(self) -> DataFrame:
        """Order lines, not yet numbered."""
        return self.read("lineitem").select(
            F.col("l_orderkey").alias("order_id"), *LINE_ORDER
        )

    def hot_orders(self) -> DataFrame | None:
        if "hot" not in self._read:
            self._read["hot"] = hot_keys(self.lines(), "order_id")
        return self._read["hot"]

    def prices(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_partkey").alias("l_partkey"),
            money(F.col("p_retailprice")).alias("order_price"),
            F.col("p_name").alias("sku_name"),
        )


def number_lines(lines: DataFrame, split: bool = False, priced: bool = False) -> DataFrame:
    """Add ``seq``, the line's number within its order.

    ``priced`` lines also get ``original_cents``, price times number summed over
    the order. With ``split`` the lines of one order are spread over tasks by ranges of
    the whole line order; equal lines are interchangeable and may be cut anywhere.
    """
    one = {"seq": F.lit(1).cast("bigint")}
    price = F.coalesce(cents(F.col("order_price")), F.lit(0).cast("bigint"))
    amount = price * F.col("l_quantity").cast("bigint")
    total = {"original_cents": amount} if priced else None
    if not split:
        return running_totals(lines, "order_id", LINE_ORDER, one, total)
    ranges, order = cut_into_ranges(lines, "order_id", LINE_ORDER)
    numbered = chunked_running_totals(ranges, "order_id", order, one, F.col("_chunk"), total)
    return numbered.select(*lines.columns, "seq", *(total or {}))


def as_details(numbered: DataFrame) -> DataFrame:
    """Numbered lines as order details; other columns are carried along."""
    rest = [c for c in numbered.columns if c not in {*LINE_ORDER, "order_id", "seq"}]
    return numbered.select(
        (F.col("order_id") * MOST_LINES + F.col("seq")).alias("id"),
        "order_id",
        F.col("l_partkey").alias("sku_id"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        *rest,
    )
