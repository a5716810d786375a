"""Mixing sources to target weights along a time-varying curriculum."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import WORD, stored, unused

WEIGHTS = (5, 2, 1)
# Each weight's schedule: its relative density at the times of TIMES, linear in between.
TIMES = (0.0, 0.5, 1.0)
SCHEDULES = ((1.4, 1.0, 0.6), (1.0, 1.0, 1.0), (0.4, 0.8, 2.0))
# The mix holds 3/2 of all words, and no source more than twice its own.
SHARE = (3, 2)
MOST = 2
# A source is summed in stretches of about this many documents, so that none meets in one task.
STRETCH = 500
_HEX = 7


def sized(docs: DataFrame, id_column: str, text: str, source: str) -> DataFrame:
    """``docs`` with ``_size`` (words), ``_key`` (a repeatable random order) and ``_source``.

    ``_source`` is never null and sorts by code point, null sources last. The key hashes id and
    text; rows equal in both are interchangeable.
    """
    words = F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0))
    own = F.concat(
        F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")),
        F.lit(" "),
        F.coalesce(f"`{text}`", F.lit("")),
    )
    name = F.col(f"`{source}`")
    return docs.withColumns(
        {
            "_size": words.cast("long"),
            "_key": F.md5(own),
            "_source": F.when(name.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), name)),
        }
    )


def ranked(df: DataFrame, order: str) -> DataFrame:
    """``df`` with ``_rank`` from 0 in the order of a column, without gathering it in one task."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = df.repartitionByRange(n, order).withColumn("_part", F.spark_partition_id())
    ranges = stored(ranges, "ranges")
    counts = sorted((r["_part"], r["count"]) for r in ranges.groupBy("_part").count().collect())
    before, total = [], 0
    for part, count in counts:  # at most one row per range
        before.append((part, total))
        total += count
    first = F.create_map(*[F.lit(x).cast("long") for pair in before for x in pair] or [F.lit(0)] * 2)
    at = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    return ranges.withColumn("_rank", at + first[F.col("_part").cast("long")]).drop("_part")


def targets(sources: DataFrame) -> DataFrame:
    """``sources`` (``_source, _words``) with ``_target``: the words each source should give.

    Sources in order weigh ``WEIGHTS``, repeating. Shares follow the weights; a share above
    ``MOST`` times its source's words stops there, and the excess goes to the others by weight,
    again and again until none is above. Sums are whole numbers, so the result is exact.
    """
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    kind = (F.col("_rank") % len(WEIGHTS)).cast("int")
    table = stored(
        ranked(sources, "_source")
        .withColumn("_kind", kind)
        .withColumn("_weight", F.get(weights, F.col("_kind")).cast("long")),
        "sources",
    )
    num, den = 0, 1
    most = F.col("_words") * MOST
    while True:
        full = F.col("_weight") * num >= most * den if num else F.lit(False)
        row = table.agg(
            F.coalesce(F.sum("_words"), F.lit(0)).alias("words"),
            F.coalesce(F.sum(F.when(full, most)), F.lit(0)).alias("capped"),
            F.coalesce(F.sum(F.when(~full, F.col("_weight"))), F.lit(0)).alias("weight"),
        ).first()
        left = SHARE[0] * row["words"] - SHARE[1] * row["capped"]
        new = (left, SHARE[1] * row["weight"]) if row["weight"] else (num, den)
        if new[0] * den == num * new[1]:
            break
        num, den = new
    share = F.col("_weight") * F.lit(float(num)) / F.lit(float(den))
    return table.withColumn("_target", F.least(most.cast("double"), share))


def _integral(schedule: Column) -> list[Column]:
    """The schedule's integral up to each time of ``TIMES``."""
    total, out = F.lit(0.0), [F.lit(0.0)]
    for i in range(len(TIMES) - 1):
        width = TIMES[i + 1] - TIMES[i]
        total = total + (schedule[i] + schedule[i + 1]) * F.lit(width / 2)
        out.append(total)
    return out


def time_of(share: Column, schedule: Column) -> Column:
    """When a source has given ``share`` (0 to 1) of its words: its integral inverted."""
    sums = _integral(schedule)
    want = share * sums[-1]
    cases = None
    for i in range(len(TIMES) - 1):
        width = TIMES[i + 1] - TIMES[i]
        need = want - sums[i]
        slope = (schedule[i + 1] - schedule[i]) / F.lit(width)
        root = F.sqrt(F.greatest(schedule[i] * schedule[i] + slope * need * 2, F.lit(0.0)))
        reached = F.lit(TIMES[i]) + need * 2 / (schedule[i] + root)
        cases = F.when(want < sums[i + 1], reached) if cases is None else cases.when(want < sums[i + 1], reached)
    return F.least(cases.otherwise(F.lit(1.0)), F.lit(1.0))


def _demand(table: DataFrame, at: Column) -> Column:
    """Words that all sources together have given by the time ``at``."""
    kinds = {r["_kind"]: r["words"] for r in table.groupBy("_kind").agg(F.sum("_need").alias("words")).collect()}
    total = F.lit(0.0)
    for kind, words in sorted(kinds.items()):
        schedule = F.array(*[F.lit(x) for x in SCHEDULES[kind]])
        sums, done = _integral(schedule), F.lit(0.0)
        for i in range(len(TIMES) - 1):
            width = TIMES[i + 1] - TIMES[i]
            into = F.greatest(F.least(at, F.lit(TIMES[i + 1])) - TIMES[i], F.lit(0.0))
            slope = (schedule[i + 1] - schedule[i]) / F.lit(width)
            done = done + into * schedule[i] + into * into * slope / 2
        total = total + done / sums[-1] * F.lit(float(words))
    return total


def planned(rows: DataFrame, whole: DataFrame | None = None) -> DataFrame:
    """``rows`` of ``sized`` with what the mix takes of each.

    Adds ``_words`` (of its source), ``_target`` (its source's), ``_taken`` and ``_passes``: an array
    of ``position, words``, one for each time that the mix uses the row, where ``position`` is the
    number of words the whole mix has demanded by then. A source's documents follow each other by
    key, again and again until its target is met, so one use in each source is partial. Rows
    without words are taken with no words as often as their neighbours. ``rows`` is read three
    times and should be stored. What is known of them can be given to ``whole``, the same rows
    with more columns: those are then moved once, to the stretches, and not stored.
    """
    per_source = rows.groupBy("_source").agg(F.sum("_size").alias("_words"))
    table = stored(targets(per_source).withColumn("_need", F.round("_target").cast("long")), "targets")
    n = max(1, -(-rows.count() // STRETCH))
    stretch = F.shiftright(F.conv(F.substring("_key", 1, _HEX), 16, 10).cast("long") * n, 4 * _HEX)
    cut = rows.withColumn("_stretch", stretch)
    wide = cut if whole is None else whole.withColumn("_stretch", stretch)
    sums = cut.groupBy("_source", "_stretch").agg(F.sum("_size").alias("_sum"))
    earlier = Window.partitionBy("_source").orderBy("_stretch").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = (
        sums.withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
        .drop("_sum")
        .join(table.drop("_rank", "_weight"), "_source")
    )
    inside = Window.partitionBy("_source", "_stretch").orderBy("_key", "_size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    start = F.col("_before") + F.coalesce(F.sum("_size").over(inside), F.lit(0))
    placed = wide.join(before, ["_source", "_stretch"]).withColumn("_start", start)
    kinds = F.array(*[F.array(*[F.lit(x) for x in s]) for s in SCHEDULES])
    schedule = F.get(kinds, F.col("_kind"))

    def use(k: int) -> Column:
        at = F.col("_start") + F.col("_words") * k
        words = F.greatest(F.least(F.col("_need") - at, F.col("_size")), F.lit(0))
        time = time_of(at / F.col("_need"), schedule)
        position = F.floor(_demand_at(time)).cast("long")
        return F.when(at < F.col("_need"), F.struct(position.alias("position"), words.alias("words")))

    def _demand_at(time: Column) -> Column:
        return _demand(table, time)

    passes = F.array_compact(F.array(*[use(k) for k in range(MOST)]))
    taken = F.aggregate(F.transform("_passes", lambda p: p["words"]), F.lit(0).cast("long"), lambda a, w: a + w)
    return placed.withColumn("_passes", passes).withColumn("_taken", taken)


def in_order(uses: DataFrame, words: int) -> DataFrame:
    """``uses`` range-sorted by ``_at``, their position, with the number of the range as ``_range``.

    Positions count words, so ranges of equal width hold equally many; none need be sampled.
    ``words`` are those of all sources.
    """
    n = int(uses.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = max(1.0, words * SHARE[0] / SHARE[1] / n)
    part = F.least(F.floor(F.col("_at") / F.lit(width)), F.lit(n - 1)).cast("int")
    dealt = uses.withColumn("_range", part).repartitionById(n, F.col("_range"))
    return dealt.sortWithinPartitions("_at", "_key")


def scheduled(uses: DataFrame, words: int) -> DataFrame:
    """``uses`` (``_at, _key, _source, _pass, _row, _take``) with ``_start``: the words before each.

    They are range-sorted and stored in that order; words are summed inside a range and over ranges.
    """
    mix = stored(in_order(uses, words), "mix")
    sums = {r["_range"]: r["words"] for r in mix.groupBy("_range").agg(F.sum("_take").alias("words")).collect()}
    before, total = [], 0
    for part in sorted(sums):  # at most one per range
        before.append((part, total))
        total += sums[part]
    first = F.create_map(*[F.lit(x).cast("long") for pair in before for x in pair] or [F.lit(0)] * 2)
    own = Window.partitionBy("_range").orderBy("_at", "_key", "_source", "_pass", "_row")
    inside = F.coalesce(F.sum("_take").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return mix.withColumn("_start", first[F.col("_range").cast("long")] + inside)


def mixed(docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``id_column, size, source_size, target, taken, position, uses``, one row per row of ``docs``.

    All uses of all rows are range-sorted by position into the mix. ``uses`` is an array of
    ``position, start, words``, where ``start`` is the number of words before it in the mix as
    sorted; ``taken`` are their words. ``position`` is that of the first use, null for rows the mix
    doesn't take. A null text has no words, null sources are one source; repeated rows count each
    time, extra columns are ignored. No rows give no rows.
    """
    narrow = sized(docs.select(id_column, text, source), id_column, text, source)
    kept = narrow.select(F.col(id_column).alias("_id"), "_size", "_key", "_source")
    rows = stored(kept.withColumn("_row", F.monotonically_increasing_id()), "sizes")
    words = rows.agg(F.sum("_size")).first()[0] or 0
    # Which of two equal rows comes first is settled once.
    plan = stored(planned(rows).select(*rows.columns, "_words", "_target", "_passes"), "plan")
    each = plan.select("_row", "_key", "_source", F.posexplode("_passes").alias("_pass", "_use"))
    uses = each.select(
        "_row", "_key", "_source", "_pass", F.col("_use.position").alias("_at"), F.col("_use.words").alias("_take")
    )
    found = F.collect_list(F.struct("_pass", F.col("_at").alias("position"), F.col("_start").alias("start"),
                                    F.col("_take").alias("words")))
    places = scheduled(uses, words).groupBy(F.col("_row").alias("_of")).agg(
        F.sum("_take").alias("_taken"), F.min("_at").alias("_first"), F.sort_array(found).alias("_uses")
    )
    plain = F.transform("_uses", lambda u: F.struct(u["position"], u["start"], u["words"]))
    return plan.join(places, F.col("_row") == F.col("_of"), "left").select(
        F.col("_id").alias(id_column),
        F.col("_size").alias("size"),
        F.col("_words").alias("source_size"),
        F.col("_target").alias("target"),
        F.coalesce("_taken", F.lit(0)).alias("taken"),
        F.col("_first").alias("position"),
        F.coalesce(plain, F.array().cast("array<struct<position: bigint, start: bigint, words: bigint>>")).alias("uses"),
    )


def training_order(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    n_chars: str = "n_chars",
) -> DataFrame:
    """The mix itself: the rows of ``docs`` once per use, range-sorted by training position.

    Columns are those of ``docs``. The one partial use of a source holds the text up to its last
    word taken, with ``n_chars`` to match. Uses without words are left out.
    """
    given = docs.columns
    inner = {c: f"c{i}" for i, c in enumerate(given)}
    plain = docs.toDF(*inner.values())
    whole = sized(plain, inner[id_column], inner[text], inner[source])
    rows = stored(whole.select("_size", "_key", "_source"), "sizes")
    used = planned(rows, whole).withColumn("_use", F.explode("_passes")).where("_use.words > 0")
    body = F.col(inner[text])
    # The words wanted, each with the white space before it.
    part = F.array_join(
        F.slice(F.regexp_extract_all(body, F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1)), F.lit(1), F.col("_use.words").cast("int")),
        "",
    )
    cut = F.col("_use.words") < F.col("_size")
    used = used.withColumn("_text", F.when(cut, part).otherwise(body))
    out = {text: F.col("_text")}
    if n_chars in given:
        kind = docs.schema[n_chars].dataType
        out[n_chars] = F.when(cut, F.length("_text").cast(kind)).otherwise(F.col(inner[n_chars]))
    words = rows.agg(F.sum("_size")).first()[0] or 0
    return in_order(used.withColumn("_at", F.col("_use.position")), words).select(
        *[out.get(c, F.col(inner[c])).alias(c) for c in given]
    )


def with_rank(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with columns that give the order in which they were written, and the names of these.

    A mix written by ``training_order`` lies in files named by range, each sorted, so file name and
    row tell its order. Rows that don't come from files have no order: they get any numbers.
    """
    file, row = unused(docs, "file"), unused(docs, "at")
    try:
        return docs.withColumns({file: F.col("_metadata.file_name"), row: F.col("_metadata.row_index")}), [file, row]
    except AnalysisException:
        return docs.withColumns({file: F.lit(""), row: F.monotonically_increasing_id()}), [file, row]
