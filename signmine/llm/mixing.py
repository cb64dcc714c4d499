"""Operator 6: mixing sources to target weights along a time-varying curriculum. DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signmine.llm.common import WORD, cut, id_text

#: Weights of the sources in order of their names' code points, repeating.
WEIGHTS = (5, 2, 1)
#: How each source's share changes over training, in the same order: the weight at the end over the weight at the start.
#: A source's density over training time t in [0, 1] is linear, so its integral is a square that can be inverted in closed form.
RAMPS = (0.5, 1.0, 2.0)
#: No source, and so no document, is taken more often than this.
MOST_REPEATS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _cycle(values: Sequence[float], place: Column, kind: str) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), (F.pmod(place - 1, F.lit(len(values))) + 1).cast("int"))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, ramps: Sequence[float] = RAMPS, most: int = MOST_REPEATS) -> DataFrame:
    """Words each source gives: (source, source_size) to the same with target and ramp.

    The share of all words by weight; a share over most times the source's own size stops there, and the excess is shared again by
    weight until none is above. In order of cap over weight the stopped sources come first, so prefix sums find the level at once:
    source i stops if, with all before it stopped, the level that is left, rest / weights left, reaches cap_i / w_i.
    The input has one row for each source and no more, so the window over all of them is small whatever the corpus is.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("place", F.row_number().over(by_name))
    ranked = ranked.select("source", "source_size", _cycle(weights, F.col("place"), "double").alias("w"), _cycle(ramps, F.col("place"), "double").alias("ramp"))
    ranked = ranked.withColumn("cap", (F.col("source_size") * most).cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    upto, whole = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole).cast("double") - F.coalesce(F.sum("cap").over(upto), F.lit(0.0))) / (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(upto), F.lit(0.0)))
    stopped = ranked.withColumn("level", level).withColumn("stops", F.col("level") * F.col("w") >= F.col("cap"))
    # The level of those that don't stop is that of the first of them.
    final = F.first(F.when(~F.col("stops"), F.col("level")), ignorenulls=True).over(whole)
    return stopped.select("source", "source_size", "ramp", F.when(F.col("stops"), F.col("cap")).otherwise(final * F.col("w")).alias("target"))


def when_taken(share: Column, ramp: Column) -> Column:
    """Training time at which a source has given this share of its words, if its density goes linearly from 1 to ramp (scaled to integral 1).

    The integral is F(t) = (2 t + (ramp - 1) t^2) / (1 + ramp); the inverse below has no cancellation and holds for ramp 1 also.
    """
    demand = share * (ramp + 1.0)
    return demand / (F.sqrt((ramp - 1.0) * demand + 1.0) + 1.0)


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, ramps: Sequence[float] = RAMPS, most: int = MOST_REPEATS, keep: Sequence[str] = ()) -> DataFrame:
    """A row for each document, in order of its first training position: doc_id, size, source, source_size, target, taken, position, last_position, and the columns of keep.

    A source's documents stand in the order of md5(doc_id:text), which no rerun changes, and are read from the start again when they end.
    The mix takes the first `target` words of that sequence (rounded down; the last document gives a part of its words), so each
    source's taken words equal its target and no document gives over `most` times its size. The share of the source's words that stand before a copy
    gives its position in [0, 1] by inverting the source's cumulative demand; range-sorting by position makes the curriculum.

    Prefix sums are made in three levels (two of 1,024 buckets of the md5, then rows of a bucket), so no source meets in one task.
    Null text: size 0, taken 0. Null source: a source of its own, last in order. Null doc_id counts as the empty text. Repeated rows each count
    and share their words' places. Empty table: no rows. Documents that give nothing have null positions and come last. Other columns play no part.
    """
    kept = [c for c in keep if c not in ("doc_id", "source")]
    rows = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("__n"),
        F.md5(F.concat(id_text("doc_id"), F.lit(":"), F.coalesce("text", F.lit("")))).alias("__key"),
        *[F.col(f"`{c}`").alias(f"__keep_{c}") for c in kept],
    )
    hexed = lambda a: F.conv(F.substring("__key", a, 5), 16, 10).cast("long")
    rows = rows.withColumn("__b", hexed(1)).withColumns({"__b1": F.shiftright("__b", 10), "__b2": F.col("__b").bitwiseAND(1023)})
    if not kept:  # a few numbers for each document: the text is read once
        rows = cut(rows)
    # An explicit null marker: a join doesn't match null sources otherwise.
    rows = rows.withColumn("__s", F.concat(F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.lit("s")), F.coalesce("source", F.lit(""))))
    small = cut(rows.groupBy("__s", "__b1", "__b2").agg(F.sum("__n").alias("__n"), F.first("source").alias("source")))
    large = small.groupBy("__s", "__b1").agg(F.sum("__n").alias("__n"), F.first("source").alias("source"))
    total = large.groupBy("__s").agg(F.sum("__n").alias("source_size"), F.first("source").alias("source"))
    goal = targets(total.select("source", "source_size"), weights, ramps, most)
    goal = goal.withColumn("__s", F.concat(F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.lit("s")), F.coalesce("source", F.lit("")))).drop("source")
    before = lambda part, order: F.coalesce(F.sum("__n").over(Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    large = large.select("__s", "__b1", before(["__s"], ["__b1"]).alias("__at1")).join(goal, "__s")
    small = small.select("__s", "__b1", "__b2", before(["__s", "__b1"], ["__b2"]).alias("__at2")).join(large, ["__s", "__b1"])
    rows = rows.withColumn("__at0", before(["__s", "__b1", "__b2"], ["__key"])).join(small, ["__s", "__b1", "__b2"])
    at = F.col("__at1") + F.col("__at2") + F.col("__at0")
    whole = F.floor("target").cast("long")
    part = lambda p: F.greatest(F.lit(0).cast("long"), F.least(F.col("__n"), F.col("__whole") - F.col("__at") - F.col("source_size") * p))
    rows = rows.withColumns({"__at": at, "__whole": whole})
    taken = sum((part(p) for p in range(1, most)), part(0))
    rows = rows.withColumn("taken", taken)
    copies = sum((F.when(part(p) > 0, 1).otherwise(0) for p in range(1, most)), F.when(part(0) > 0, 1).otherwise(0))
    place = lambda p: F.round(when_taken((F.col("__at") + F.col("source_size") * p) / F.col("target"), F.col("ramp")), 9)
    some = F.col("taken") > 0
    return rows.select(
        "doc_id", F.col("__n").alias("size"), "source", "source_size", "target", "taken",
        F.when(some, place(F.lit(0))).alias("position"), F.when(some, place(copies - 1)).alias("last_position"), *[F.col(f"`__keep_{c}`").alias(c) for c in kept],
    ).orderBy(F.col("position").asc_nulls_last(), "doc_id")
