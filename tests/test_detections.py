import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from signmine.functions import geometry
from signmine.operators import detections as det
from signmine.operators import edges, sequence, stats
from signmine.plans import catalogue


def iou(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    if w <= 0 or h <= 0:
        return 0.0
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h
    return w * h / union if union > 0 else 0.0


def greedy(rows, thr):
    kept = []
    for r in sorted(rows, key=lambda r: (-r[6], r[0], r[1])):
        if all(iou(k[2:6], r[2:6]) <= thr for k in kept):
            kept.append(r)
    return kept


def test_suppression_is_greedy(spark):
    rng = random.Random(4)
    rows = []
    for image in range(40):
        for q in range(rng.randint(1, 25)):
            x, y = rng.randint(-5, 30), rng.randint(-5, 30)
            rows.append((image, q % 2, q, float(x), float(y), float(x + rng.randint(0, 20)), float(y + rng.randint(0, 20)), rng.choice((0.3, 0.5, 0.9))))
    df = spark.createDataFrame(rows, "image int, det int, q long, x1 double, y1 double, x2 double, y2 double, score double")
    found = {}
    for r in det.suppressed(df, 0.5).orderBy("image", "keep_pos").collect():
        found.setdefault(r["image"], []).append((r["det"], r["q"]))
    for image in range(40):
        assert found[image] == [r[:2] for r in greedy([r[1:] for r in rows if r[0] == image], 0.5)]


def test_threshold_is_strict_and_edges_do_not_overlap(spark):
    # IoU of the first two is exactly 0.5: both stay. The third touches only.
    rows = [("i", 0, 0, 0.0, 0.0, 3.0, 1.0, 0.9), ("i", 0, 1, 1.0, 0.0, 4.0, 1.0, 0.8), ("i", 0, 2, 4.0, 0.0, 5.0, 1.0, 0.7)]
    df = spark.createDataFrame(rows, "image string, det int, q long, x1 double, y1 double, x2 double, y2 double, score double")
    assert det.suppressed(df, 0.5).count() == 3 and det.suppressed(df, 0.49).count() == 2


def test_caps(spark):
    df = spark.createDataFrame([("s:1", p, 0.5) for p in range(10)], "image string, keep_pos int, score double")
    assert det.capped(df, 0).count() == 10 and det.capped(df, 10).count() == 10 and det.capped(df, 4).count() == 4
    again = lambda n: sorted(r["keep_pos"] for r in det.capped(df.repartition(n), 4, 3).collect())
    assert again(1) == again(5)
    drawn = det.capped_by_generator(df.withColumn("old", F.col("keep_pos")), 4, 3).orderBy("keep_pos").collect()
    assert [r["old"] for r in drawn] == det.drawn_places(3, "s:1", 10, 4)


def test_polygons(spark):
    rows = spark.createDataFrame([(1, [0.0, 0.0, 2.0, 0.0, 1.0, 3.0]), (2, [0.0, 0.0, 1.0, 1.0]), (3, []), (4, [0.0, 1.0, 2.0, 1.0, 3.0, 1.0])], "n int, flat array<float>")
    found = {r["n"]: r["b"] for r in rows.select("n", geometry.bounding_box(geometry.reshape(F.col("flat"))).alias("b")).collect()}
    assert tuple(found[1]) == (0.0, 0.0, 2.0, 3.0) and found[2] is found[3] is found[4] is None


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=20), st.integers(1, 3))
def test_bisected_gives_every_item_its_answer(batch, room):
    def run(part):
        if len(part) > room:
            raise MemoryError
        return [x * 2 for x in part]

    assert edges.bisected(run, batch) == [x * 2 for x in batch]


def test_bisected_gives_none_for_what_never_fits():
    def run(part):
        if 3 in part:
            raise MemoryError
        return list(part)

    assert edges.bisected(run, [1, 3, 2]) == [1, None, 2]


def test_dense_numbers_hold_for_any_partitioning(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"))
    for n in (1, 7):
        found = sequence.dense_numbers(df.repartition(n), ["x"], 50).collect()
        assert sorted((r["x"], r["seq"]) for r in found) == [(i, i + 51) for i in range(1000)]
    assert sequence.dense_numbers(df.where("x < 0"), ["x"]).count() == 0


def test_zero_streaks_and_cumulative(spark):
    chunks = spark.createDataFrame([(i, m) for i, m in enumerate([1, 0, 0, 0, 2, 0, 0, 3, 0, 0, 0, 0])], "chunk int, made int")
    assert sorted(tuple(r) for r in stats.zero_streaks(chunks).collect()) == [(1, 3, 3), (8, 11, 4)]
    runs = spark.createDataFrame([(1, 5, None), (2, None, 9)], "run_no int, crops int, target int")
    assert tuple(stats.cumulative(runs, ("crops",), ("target",)).first()) == (5, 9)


def test_overlapping_pairs_against_plain_loops(spark):
    rng, rows = random.Random(9), []
    for image in (*range(90), None):
        for _ in range(rng.randint(1, 12)):
            x, y = rng.randint(0, 8), rng.randint(0, 8)
            # Some keys are equal, some null, some boxes without area, some corners missing.
            rows.append((image, rng.randint(0, 1), rng.choice([*range(6), None]), float(x), float(y), float(x + rng.randint(0, 6)), rng.choice([float(y + rng.randint(1, 6)), None]) if rng.random() < 0.2 else float(y + rng.randint(0, 6))))
    df = spark.createDataFrame(rows, "image int, det int, q long, x1 double, y1 double, x2 double, y2 double")
    first = lambda r: (r[1], -1 if r[2] is None else r[2])
    for thr in (0.0, 0.4):
        want = [(a[0], *a[1:3], *b[1:3], iou(a[3:], b[3:])) for a in rows for b in rows if a[0] is not None and a[0] == b[0] and first(a) < first(b) and None not in (a[6], b[6]) and iou(a[3:], b[3:]) > thr]
        assert sorted(map(repr, map(tuple, det.overlapping_pairs(df, thr).collect()))) == sorted(map(repr, want)) and len(want) > 5


def test_what_is_computed_for_each_pair_can_be_compiled(spark, small, capsys):
    """The JVM doesn't compile methods of more than 8,000 bytes: a join whose code is longer takes seven times as long."""
    was = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        catalogue.QUERIES["iou_pairs"](spark, small).explain("codegen")
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    found = capsys.readouterr().out
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", found)]
    assert "SortMergeJoin" in found and max(sizes) < 6000


def test_overlaps_are_those_of_iou(spark):
    rng = random.Random(2)
    ends = (0.0, 1.0, 2.0, 3.0, 4.0, -0.0, 1e-200, float("inf"), float("nan"), None)
    some = lambda: [rng.choice(ends if rng.random() < 0.2 else ends[:5]) for _ in range(4)]
    df = spark.createDataFrame([(some(), some()) for _ in range(2000)], "a array<double>, b array<double>")
    box = lambda s: {c: F.get(s, i) for i, c in enumerate(("x1", "y1", "x2", "y2"))}
    for thr in (-1.0, 0.0, 1 / 3, 0.5):
        both = df.select(F.coalesce(geometry.overlaps(box("a"), box("b"), thr), F.lit(False)).alias("short"), (geometry.iou(box("a"), box("b")) > thr).alias("long"))
        assert both.where("short <> long").count() == 0 and both.where("short").count() > 20


def test_dense_numbers_compute_rows_once(spark):
    rows = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            rows.add(len(batch))
            yield batch

    found = sequence.dense_numbers(spark.range(500).mapInPandas(count, "id long"), ["id"])
    assert [r["seq"] - r["id"] for r in found.collect()] == [1] * 500
    # Neither the bounds of ranges nor the numbers take a second pass over what made the rows, and numbers take no further sort.
    assert rows.value == 500 and "Window" not in found._jdf.queryExecution().optimizedPlan().toString()
