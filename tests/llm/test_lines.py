"""Rows without an id, and rows that share one, in both line operators."""

import pytest
from pyspark.sql import functions as F

from signmine.llm import line_dedup

BLOCK = "\n".join(f"line {i} of the block" for i in range(12))


@pytest.mark.parametrize("operator", [line_dedup.dedup_lines, line_dedup.dedup_blocks])
def test_each_row_without_an_id_is_a_document(spark, operator):
    rows = [(None, BLOCK), (None, BLOCK), (None, BLOCK), (None, "one\ntwo\n" + BLOCK), (None, None), (None, "")]
    texts = sorted(len(r["text"]) for r in operator(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect() if r["text"] is not None)
    with_ids = sorted(len(r["text"]) for r in operator(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")).collect() if r["text"] is not None)
    assert len(texts) == 5 and sum(x >= len(BLOCK) for x in texts) == 1 and sum(texts) <= sum(with_ids) + 8 + len(BLOCK) // 2
    # A document with an id comes first, whatever stands in rows without one.
    found = operator(spark.createDataFrame([*rows, (7, BLOCK)], "doc_id long, text string").withColumn("n_chars", F.lit(0).cast("long"))).collect()
    assert [r["text"] for r in found if r["doc_id"] == 7] == [BLOCK] and all(len(r["text"]) < len(BLOCK) for r in found if r["doc_id"] is None and r["text"] is not None)
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in found)


@pytest.mark.parametrize("operator", [line_dedup.dedup_lines, line_dedup.dedup_blocks])
def test_rows_of_one_id_are_one_document(spark, operator):
    found = operator(spark.createDataFrame([(1, BLOCK), (1, BLOCK), (2, BLOCK)], "doc_id long, text string")).collect()
    assert [r["text"] for r in found if r["doc_id"] == 1] == [BLOCK, BLOCK] and len(next(r["text"] for r in found if r["doc_id"] == 2)) < len(BLOCK) // 2
