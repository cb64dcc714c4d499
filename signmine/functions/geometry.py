"""Polygons, boxes and greedy suppression, as Column expressions over arrays: no shuffle, no Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT = "struct<x:float,y:float>"
BOX = "struct<x1:double,y1:double,x2:double,y2:double>"


def reshape(flat: Column) -> Column:
    """[x0, y0, x1, y1, ...] to an array of points (x, y) of floats. An odd last number is left out; an empty array stays empty."""
    places = F.filter(F.sequence(F.lit(0), F.greatest(F.size(flat), F.lit(1)) - 1), lambda i: (i % 2 == 0) & (i + 1 < F.size(flat)))
    return F.transform(places, lambda i: F.struct(F.get(flat, i).cast("float").alias("x"), F.get(flat, i + 1).cast("float").alias("y")))


def bounding_box(points: Column) -> Column:
    """Axis-aligned box of a polygon, in double; null for fewer than three points and for boxes without area."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    side = lambda a, name: a.cast("double").alias(name)
    box = F.struct(side(F.array_min(xs), "x1"), side(F.array_min(ys), "y1"), side(F.array_max(xs), "x2"), side(F.array_max(ys), "y2"))
    return F.when((F.size(points) >= 3) & (box["x2"] > box["x1"]) & (box["y2"] > box["y1"]), box)


def box_polygon(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Corners of a box: top left, top right, bottom right, bottom left."""
    point = lambda x, y: F.struct(x.cast("float").alias("x"), y.cast("float").alias("y"))
    return F.array(point(x1, y1), point(x2, y1), point(x2, y2), point(x1, y2))


def area(box: Column) -> Column:
    return (box["x2"] - box["x1"]) * (box["y2"] - box["y1"])


def iou(a: Column, b: Column, areas: tuple[Column, Column] | None = None) -> Column:
    """Intersection over union of two boxes; 0 where they don't overlap or have no area. areas: those of a and b, where they are known already."""
    w = F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])
    h = F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"])
    of_a, of_b = areas or (area(a), area(b))
    union = of_a + of_b - w * h
    return F.when((w > 0) & (h > 0) & (union > 0), F.try_divide(w * h, union)).otherwise(F.lit(0.0))


def overlaps(a: Column, b: Column, threshold: float) -> Column:
    """Whether iou(a, b) is above the threshold, in fewer steps (they are interpreted in lambdas); null for false where a corner is missing. Boxes that overlap have areas, so their union is above 0."""
    if threshold < 0:
        return iou(a, b) > threshold
    w = F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])
    h = F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"])
    return (w > 0) & (h > 0) & (F.try_divide(w * h, area(a) + area(b) - w * h) > threshold)


def suppress(boxes: Column, kind: str, threshold: float) -> Column:
    """Greedy suppression of sorted boxes (best first): a box stays unless its IoU with one that stays is above the threshold. kind: the array's DDL type."""
    empty = F.expr(f"cast(array() as {kind})")
    return F.aggregate(boxes, empty, lambda kept, b: F.when(F.exists(kept, lambda k: overlaps(k, b, threshold)), kept).otherwise(F.concat(kept, F.array(b))))


def crop_rectangle(box: Column, width: Column, height: Column) -> Column:
    """Whole pixels that hold the box, inside the image; null if nothing is left. Casts to integers cut towards zero."""
    rect = F.struct(
        F.greatest(F.lit(0), box["x1"].cast("int")).alias("left"), F.greatest(F.lit(0), box["y1"].cast("int")).alias("top"),
        F.least(width.cast("int"), F.ceil(box["x2"]).cast("int")).alias("right"), F.least(height.cast("int"), F.ceil(box["y2"]).cast("int")).alias("bottom"),
    )
    return F.when((rect["right"] > rect["left"]) & (rect["bottom"] > rect["top"]), rect)
