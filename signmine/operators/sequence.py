"""Dense numbers for crops, in order of where they come from, up to a target."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signmine.functions.naming import store_key
from signmine.sources.files import cut, drop

#: Of monotonically_increasing_id(), those that count within a partition.
PLACE_BITS = 33


def dense_numbers(rows: DataFrame, order: list[str], base: int = 0, name: str = "seq") -> DataFrame:
    """rows with numbers base + 1, base + 2, ... in the given order, without a window over all rows.

    The rows are dealt into ranges of the order and each range is sorted; its number and a row's place in it are written with the row, and the counts of earlier ranges summed (a row for each range).
    Rows with equal keys must not matter in their order: let the order be unique. rows are written first, as finding the ranges' bounds would compute them a second time.
    """
    once = cut(rows)
    dealt = cut(once.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))  # written, so that a range's rows and numbers can't part again
    drop(once)
    part, place = F.shiftright("__at", PLACE_BITS).cast("int"), F.col("__at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    counts = dealt.groupBy(part.alias("__part")).agg(F.count("*").alias("__n")).orderBy("__part").collect()  # one row for each partition
    offsets, total = {}, base
    for number, n in counts:
        offsets[number], total = total, total + n
    known = dealt.sparkSession.createDataFrame([(p, o) for p, o in offsets.items()] or [(0, base)], "__part int, __offset long")
    return dealt.withColumn("__part", part).join(F.broadcast(known), "__part").withColumn(name, F.col("__offset") + place + 1).drop("__part", "__offset", "__at")


def numbered(rows: DataFrame, order: list[str], base: int = 0, name: str = "seq") -> DataFrame:
    """The same with one window, for inputs that are small (a micro-batch)."""
    return rows.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long") + base)


def up_to(rows: DataFrame, target: int, name: str = "seq") -> DataFrame:
    """Rows whose number is within the target; 0: all."""
    return rows if target <= 0 else rows.where(F.col(name) <= target)


def with_keys(rows: DataFrame, name: str = "seq") -> DataFrame:
    return rows.withColumn("key", store_key(F.col(name)))


def ordinals(rows: DataFrame, by: list[str], order: str = "keep_pos") -> DataFrame:
    """rows with c: 0, 1, ... within an image."""
    return rows.withColumn("c", F.row_number().over(Window.partitionBy(*by).orderBy(order)) - 1)
