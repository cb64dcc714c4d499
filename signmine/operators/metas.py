"""Work items of the crop step: indexed rows less what is done."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signmine.functions.naming import in_machine_share


def rows_of_index(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Rows whose shard and place are in the index."""
    return rows.join(index.select("shard", "row"), ["shard", "row"], "left_semi")


def with_url(rows: DataFrame) -> DataFrame:
    return rows.where("url is not null and url <> ''")


def not_done(rows: DataFrame, done: DataFrame) -> DataFrame:
    return rows.join(done.select("shard").distinct(), "shard", "left_anti")


def after_progress(rows: DataFrame, progress: DataFrame) -> DataFrame:
    """Rows beyond the highest row that progress (shard, max_row) has for their shard; all rows of shards that it doesn't have."""
    return rows.join(progress.select("shard", "max_row"), "shard", "left").where(F.col("max_row").isNull() | (F.col("row") > F.col("max_row"))).drop("max_row")


def machine_share(rows: DataFrame, mod: int, rem: int) -> DataFrame:
    return rows.where(in_machine_share(F.col("shard"), mod, rem))


def work_items(index: DataFrame, done: DataFrame | None = None, progress: DataFrame | None = None, mod: int = 1, rem: int = 0, max_shards: int = 0) -> DataFrame:
    """(shard, row, url): this machine's share, shards that aren't done, the first max_shards of them (0: all), rows beyond progress, with a URL."""
    rows = machine_share(index, mod, rem) if mod > 1 else index
    rows = not_done(rows, done) if done is not None else rows
    if max_shards > 0:
        first = rows.select("shard").distinct().orderBy("shard").limit(max_shards)
        rows = rows.join(first, "shard", "left_semi")
    rows = after_progress(rows, progress) if progress is not None else rows
    return with_url(rows).select("shard", "row", "url")


def by_row_group(index: DataFrame, size: int) -> DataFrame:
    """(shard, row_group, first, last, hits) of the row groups of `size` rows that hold indexed rows: groups without any needn't be read.

    Groups of one size make the range join of rows and groups an equi-join on row / size.
    """
    return index.groupBy("shard", F.floor(F.col("row") / size).cast("long").alias("row_group")).agg(F.min("row").alias("first"), F.max("row").alias("last"), F.count("*").alias("hits"))


def in_row_groups(index: DataFrame, groups: DataFrame) -> DataFrame:
    """As by_row_group(), for groups (shard, row_group, start) of any sizes, as files have them: (shard, row_group, first, last, hits).

    A shard's starts are one sorted array, as many as its file has row groups; a row's group is the last that starts at or before it. So the range join is an equi-join on the shard.
    """
    starts = groups.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("start", "row_group"))).alias("__groups"))
    place = F.size(F.filter("__groups", lambda s: s["start"] <= F.col("row"))) - 1
    found = index.join(starts, "shard").withColumn("row_group", F.get("__groups", place)["row_group"]).where("row_group is not null")
    return found.groupBy("shard", "row_group").agg(F.min("row").alias("first"), F.max("row").alias("last"), F.count("*").alias("hits"))


def progress_of(rows: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """(shard, max_row): the highest row by shard, with what was known before."""
    new = rows.groupBy("shard").agg(F.max("row").alias("max_row"))
    return new if before is None else new.unionByName(before.select("shard", "max_row")).groupBy("shard").agg(F.max("max_row").alias("max_row"))


def finished_shards(done: DataFrame, more: DataFrame) -> DataFrame:
    return done.select("shard").unionByName(more.select("shard")).distinct()


#: Places of a sequence that transitions() looks at together.
RANGE = 10_000


def transitions(items: DataFrame, order: str = "n") -> DataFrame:
    """(order, shard, previous): where the shard of a sequence of items changes; previous is null at the first. Items of one place are in order of their shards.

    `order` is a number. The sequence is cut into ranges of RANGE places; the first item's previous is the last of the range before. One window goes over the ranges, a row each.
    """
    ranges = items.select(order, "shard", F.floor(F.col(order) / RANGE).alias("__range"))
    ends = ranges.groupBy("__range").agg(F.max(F.struct(order, "shard")).alias("end"))
    before = ends.select("__range", F.lag("end.shard").over(Window.orderBy("__range")).alias("__before")).withColumnRenamed("__range", "__of")
    own = Window.partitionBy("__range").orderBy(order, "shard")
    previous = F.when(F.row_number().over(own) == 1, F.col("__before")).otherwise(F.lag("shard").over(own))
    found = ranges.join(before, F.col("__range").eqNullSafe(F.col("__of"))).select(order, "shard", previous.alias("previous"))
    return found.where("previous is null or previous <> shard")


def capped(items: DataFrame, cap: int) -> DataFrame:
    """The first cap items in order of shard and row."""
    return items.orderBy("shard", "row").limit(cap)
