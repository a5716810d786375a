"""Sharing out the amount paid for an order over its lines, exact to the cent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.money import cents, from_cents, proportion
from tallybrook.operators.running import chunked_running_totals, cut_into_ranges, running_totals
from tallybrook.operators.skew import HOT_ROWS, by_heat, hot_keys

# Lines per chunk of a hot order: ids are unique within an order, so a chunk of
# this many consecutive ids never holds more rows.
CHUNK_IDS = 1 << 20


def allocate_cents(
    lines: DataFrame,
    order: list[str],
    chunk: Column | None = None,
    out: str = "final_detail_cents",
    carried: bool = False,
) -> DataFrame:
    """Add each line's share of ``final_cents``.

    Needs ``order_id, amount_cents`` (price times number), ``original_cents`` (sum of
    all lines) and ``final_cents`` (paid), non-negative. In the order of ``order`` a
    line gets its proportional part rounded half up; the line that completes
    ``original_cents`` gets what is left, and lines of amount zero after it get zero.
    Lines of value in an order whose original total is zero get null. With ``chunk``
    the lines of one order are spread over tasks, see ``chunked_running_totals``.

    With ``carried`` the lines follow others of their order: ``carried_lines``,
    ``carried_cents`` and ``carried_given`` say how many there were, their amounts and what
    they were given.
    """
    amount, whole = F.col("amount_cents"), F.col("original_cents")
    rows = lines.withColumn("_part", proportion(F.col("final_cents"), amount, whole))
    totals = {
        "_line": F.lit(1).cast("bigint"),
        "_reached": amount,
        "_given": F.coalesce(F.col("_part"), F.lit(0)),
    }
    if chunk is None:
        rows = running_totals(rows, "order_id", order, totals)
    else:
        rows = chunked_running_totals(rows, "order_id", order, totals, chunk)
    earlier = {c: F.col(f"carried_{c}") if carried else F.lit(0) for c in ("lines", "cents", "given")}
    complete = F.col("_reached") + earlier["cents"] == whole
    # Amounts are non-negative: the total is first reached by a line of value, or
    # by the very first line when there is nothing to reach.
    closing = complete & ((amount > 0) | (F.col("_line") + earlier["lines"] == 1))
    given_before = F.col("_given") - F.coalesce(F.col("_part"), F.lit(0)) + earlier["given"]
    share = (
        F.when(closing, F.col("final_cents") - given_before)
        .when(complete, F.lit(0))
        .otherwise(F.col("_part"))
    )
    return rows.select(*lines.columns, share.cast("bigint").alias(out))


def allocate_batch(
    wide: DataFrame, sums: DataFrame, order: str = "order_detail_id", hot_rows: int = HOT_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Shares of a batch of wide rows whose orders may have had lines in earlier batches.

    ``sums`` has what earlier lines of an order left: ``order_id, lines, cents, given``. Returns
    the rows with ``final_detail_amount`` and the new sums of their orders. The lines of a batch
    go in the order of ``order``, however they arrived, so a batch tried again shares the same.
    Orders of ``hot_rows`` lines or more are cut into ranges of that order. ``wide`` is read
    several times and should be persisted.
    """
    work = ("amount_cents", "original_cents", "final_cents")
    before = sums.select(F.col("order_id").alias("_order"), "lines", "cents", "given")
    known = [
        F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(f"carried_{c}")
        for c in ("lines", "cents", "given")
    ]
    rows = (
        wide.withColumns(dict(zip(work, wide_cents(), strict=True)))
        .join(before, F.col("order_id") == F.col("_order"), "left")
        .select(*wide.columns, *work, *known)
    )

    def split(part: DataFrame) -> DataFrame:
        ranges, full = cut_into_ranges(part, "order_id", [order])
        shared = allocate_cents(ranges, full, F.col("_chunk"), carried=True)
        return shared.select(*rows.columns, "final_detail_cents")

    hot = hot_keys(wide, "order_id", hot_rows)
    shared = by_heat(rows, "order_id", hot, lambda r: allocate_cents(r, [order], carried=True), split)
    kept = [F.col(c) for c in wide.columns if c != "final_detail_amount"]
    amount = from_cents(F.col("final_detail_cents")).alias("final_detail_amount")
    done = shared.select(*kept, amount)
    return done, sums_after(done, sums)


def sums_after(
    shared: DataFrame, sums: DataFrame, also: dict[str, Column] | None = None
) -> DataFrame:
    """What the orders of rows with ``final_detail_amount`` amount to, added to ``sums`` from before.

    Who uses the rows more than once should store them and take the sums from there. ``also`` has
    more aggregates of an order's rows, for which ``sums`` has nothing.
    """
    here = {
        "lines": F.count("*"),
        "cents": F.sum(wide_cents()[0]),
        "given": F.sum(F.coalesce(cents(F.col("final_detail_amount")), F.lit(0).cast("bigint"))),
    }
    also = also or {}
    own = shared.groupBy("order_id").agg(
        *[v.alias(f"_{c}") for c, v in here.items()], *[v.alias(c) for c, v in also.items()]
    )
    before = sums.select(F.col("order_id").alias("_order"), *here)
    joined = own.join(before, F.col("order_id") == F.col("_order"), "left")
    return joined.select(
        "order_id",
        *[(F.col(f"_{c}") + F.coalesce(c, F.lit(0).cast("bigint"))).alias(c) for c in here],
        *also,
    )


def wide_cents() -> tuple[Column, Column, Column]:
    """Amount, original total and paid total of a wide row in cents; unset ones are 0."""

    def known(value: Column) -> Column:
        return F.coalesce(value, F.lit(0).cast("bigint"))

    return (
        known(cents(F.col("sku_price")) * F.col("sku_num")),
        known(cents(F.col("original_total_amount"))),
        known(cents(F.col("final_total_amount"))),
    )
