"""From the detectors' polygons to the boxes that are cropped. Boxes of an image stay one array: suppression needs no shuffle beyond the one that gathers them."""

from __future__ import annotations

import hashlib
import random

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signmine.functions import geometry

KEPT = "array<struct<place:double,det:int,q:long,x1:double,y1:double,x2:double,y2:double,score:double>>"


def normalized(detections: DataFrame) -> DataFrame:
    """(image, det, q, poly, score) with what detectors leave out supplied: a missing score is 1.0, a missing polygon the box's (x1, y1, x2, y2) corners."""
    has = set(detections.columns)
    poly = F.col("poly") if "poly" in has else F.lit(None)
    if {"x1", "y1", "x2", "y2"} <= has:
        poly = F.coalesce(poly, geometry.box_polygon(*map(F.col, ("x1", "y1", "x2", "y2"))))
    return detections.select("image", "det", "q", poly.alias("poly"), F.coalesce(F.col("score") if "score" in has else F.lit(None), F.lit(1.0)).cast("double").alias("score"))


def union_of(*detectors: DataFrame) -> DataFrame:
    """A bag union of the detectors' rows, each numbered by det in the order given."""
    out = None
    for number, rows in enumerate(detectors):
        one = rows.withColumn("det", F.lit(number))
        out = one if out is None else out.unionByName(one)
    return out


def confident(detections: DataFrame, threshold: float = 0.3) -> DataFrame:
    return detections.where(F.col("score") >= threshold)


def boxes(detections: DataFrame) -> DataFrame:
    """(image, det, q, x1, y1, x2, y2, score): bounding boxes of polygons, without degenerate ones."""
    box = geometry.bounding_box(F.col("poly"))
    return detections.select("image", "det", "q", box.alias("b"), "score").where("b is not null").select("image", "det", "q", "b.*", "score")


def _sorted(rows: DataFrame, ties: tuple[str, ...]) -> DataFrame:
    """(image, boxes): by score from the highest; equal scores in order of det, q and the further columns named."""
    fields = [(-F.col("score")).alias("place"), F.col("det").cast("int").alias("det"), F.col("q").cast("long").alias("q"), *[F.col(c).alias(f"t_{c}") for c in ties]]
    body = [F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2", "score")]
    gathered = rows.groupBy("image").agg(F.sort_array(F.collect_list(F.struct(*fields, *body))).alias("boxes"))
    return gathered.select("image", F.transform("boxes", lambda b: F.struct(*[b[c].alias(c) for c in ("place", "det", "q", "x1", "y1", "x2", "y2", "score")])).alias("boxes"))


def suppressed(rows: DataFrame, threshold: float = 0.5, ties: tuple[str, ...] = ()) -> DataFrame:
    """(image, keep_pos, det, q, x1, y1, x2, y2, score): the boxes that greedy suppression leaves, from the best on. An image's boxes are bounded by what detectors give for one image."""
    kept = geometry.suppress(F.col("boxes"), KEPT, threshold)
    return _sorted(rows, ties).select("image", F.posexplode(kept).alias("keep_pos", "b")).select("image", "keep_pos", "b.det", "b.q", "b.x1", "b.y1", "b.x2", "b.y2", "b.score")


def overlapping_pairs(rows: DataFrame, threshold: float = 0.5, key: tuple[str, ...] = ("det", "q")) -> DataFrame:
    """Pairs of one image's boxes with an IoU above the threshold: (image, a_*, b_*, iou), each pair once. For reports: suppression doesn't need it.

    Areas come along, so that what is computed for each pair stays short: the code that Spark makes of longer conditions is too long for the JVM to compile.
    """
    corners = ("x1", "y1", "x2", "y2")
    known = rows.select("image", *key, *corners, geometry.area({c: F.col(c) for c in corners}).alias("area"))
    side = lambda s: known.select("image", *[F.col(c).alias(f"{s}_{c}") for c in (*key, *corners, "area")])
    box = lambda s: {c: F.col(f"{s}_{c}") for c in corners}
    order = lambda s: F.struct(*[F.col(f"{s}_{c}").alias(c) for c in key])
    iou = geometry.iou(box("a"), box("b"), (F.col("a_area"), F.col("b_area")))
    pairs = side("a").join(side("b"), "image").where(iou > threshold).where(order("a") < order("b"))
    return pairs.select("image", *[f"{s}_{c}" for s in "ab" for c in key], iou.alias("iou"))


def capped(kept: DataFrame, most: int, seed: int = 0, image_key: Column | None = None) -> DataFrame:
    """At most `most` boxes of an image (0: all), drawn by the md5 of seed, image and position: no matter in which order tasks run, the same ones.

    A draw and not the best, so that crops aren't biased towards high scores.
    """
    if most <= 0:
        return kept
    image = F.col("image").cast("string") if image_key is None else image_key
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), image, F.col("keep_pos").cast("string")))
    return kept.withColumn("__rank", F.row_number().over(Window.partitionBy("image").orderBy(draw, "keep_pos"))).where(F.col("__rank") <= most).drop("__rank")


def drawn_places(seed: int, image: str, n: int, most: int) -> list[int]:
    """Which of n boxes the seeded generator draws, in its order: a Mersenne Twister seeded with eight bytes of BLAKE2b of "seed:image"; image is "shard:row"."""
    if most <= 0 or n <= most:
        return list(range(n))
    return random.Random(int.from_bytes(hashlib.blake2b(f"{seed}:{image}".encode(), digest_size=8).digest(), "big")).sample(range(n), most)


def capped_by_generator(kept: DataFrame, most: int, seed: int = 0) -> DataFrame:
    """As capped(), with the generator's draw and its order: keep_pos becomes the place in the draw."""
    counted = kept.groupBy("image").agg(F.count("*").alias("n"))

    @F.pandas_udf("array<int>")
    def draw(images: pd.Series, sizes: pd.Series) -> pd.Series:
        return pd.Series([drawn_places(seed, str(i), int(n), most) for i, n in zip(images, sizes, strict=True)])

    drawn = counted.select("image", F.posexplode(draw(F.col("image").cast("string"), F.col("n"))).alias("place", "keep_pos"))
    return kept.join(drawn, ["image", "keep_pos"]).drop("keep_pos").withColumnRenamed("place", "keep_pos")


def crop_rectangles(kept: DataFrame, width: Column, height: Column) -> DataFrame:
    """kept with left, top, right, bottom in whole pixels, without those of which nothing is inside the image."""
    rect = geometry.crop_rectangle(F.struct("x1", "y1", "x2", "y2"), width, height)
    return kept.withColumn("__rect", rect).where("__rect is not null").select(*kept.columns, "__rect.*")


def rectangles(images: DataFrame, score_thr: float = 0.3, iou_thr: float = 0.5, max_keep: int = 100, seed: int = 0) -> DataFrame:
    """Images (shard, row, width, height, found ...) with kept, the boxes that stay (keep_pos, x1, y1, x2, y2, score), and rects (c, left, top, right, bottom, score) cut to the image.

    As confident(), boxes(), suppressed(), capped() and crop_rectangles() have it, image by image in arrays: an image's boxes never meet others', so there is no shuffle.
    """
    strong = F.filter("found", lambda f: f["score"] >= score_thr)
    boxed = F.filter(F.transform(strong, lambda f: F.struct(f["det"].alias("det"), f["q"].alias("q"), geometry.bounding_box(f["poly"]).alias("b"), f["score"].alias("score"))), lambda f: f["b"].isNotNull())
    flat = lambda f: F.struct((-f["score"]).alias("place"), f["det"].alias("det"), f["q"].cast("long").alias("q"), *[f["b"][c].alias(c) for c in ("x1", "y1", "x2", "y2")], f["score"].alias("score"))
    alone = geometry.suppress(F.sort_array(F.transform(boxed, flat)), KEPT, iou_thr)
    draw = lambda b, i: F.md5(F.concat_ws(":", F.lit(str(seed)), "shard", F.col("row").cast("string"), i.cast("string")))
    drawn = F.transform(alone, lambda b, i: F.struct((draw(b, i) if max_keep > 0 else F.lit("")).alias("draw"), i.alias("keep_pos"), *[b[c].alias(c) for c in ("x1", "y1", "x2", "y2", "score")]))
    some = F.slice(F.sort_array(drawn), 1, max_keep) if max_keep > 0 else drawn
    kept = F.sort_array(F.transform(some, lambda b: F.struct(*[b[c].alias(c) for c in ("keep_pos", "x1", "y1", "x2", "y2", "score")])))
    cut = F.transform("kept", lambda b: F.struct(geometry.crop_rectangle(b, F.col("width"), F.col("height")).alias("r"), b["score"].alias("score")))
    inside = F.filter(cut, lambda x: x["r"].isNotNull())
    rects = F.transform(inside, lambda x, i: F.struct(i.alias("c"), *[x["r"][c].alias(c) for c in ("left", "top", "right", "bottom")], x["score"].alias("score")))
    return images.withColumn("kept", kept).withColumn("rects", rects)
