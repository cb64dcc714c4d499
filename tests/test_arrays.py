import re
import time

import pytest
from pyspark.sql import functions as F

from signmine.functions import arrays
from signmine.functions import captions as cap


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 1000])
def test_scan_gives_what_a_loop_gives(spark, n):
    sums = arrays.scan(F.col("v"), F.lit(0), lambda s, x: (s + x, s * 10 + x), "int")
    row = spark.createDataFrame([([i % 7 for i in range(n)],), (None,)], "v array<int>").select(sums.alias("s")).collect()
    want, at = [], 0
    for i in range(n):
        want.append(at * 10 + i % 7)
        at += i % 7
    assert row[0]["s"] == want and row[1]["s"] == []


def test_spans_are_those_of_re_and_take_time_in_proportion(spark):
    texts = ["", "no hit", "a1b22c333", "\U0001f6001é22", "7" * 5, "x1" * 3000]
    found = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string").select("t", arrays.spans(F.col("t"), "[0-9]+").alias("s")).collect()
    for r in found:
        assert [tuple(x) for x in r["s"]] == [(m.start(), m.end(), m[0]) for m in re.finditer("[0-9]+", r["t"] or "")]
    took = []
    for n in (20_000, 80_000):
        one = spark.range(1).select(F.repeat(F.lit("word 'x' "), n).alias("t")).select(F.size(cap.without_overlaps(F.concat(cap.quoted_spans(F.col("t")), cap.word_spans(F.col("t"))))).alias("n"))
        began = time.perf_counter()
        assert one.first()["n"] == 2 * n
        took.append(time.perf_counter() - began)
    assert took[1] < 10 * took[0] + 2
