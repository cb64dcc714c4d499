"""Nulls in any column, empty and very long texts, ties and repeated rows, empty tables, extra columns with clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from signmine.llm import decontaminate, html, langid, line_dedup, mixing, quality, secrets, simhash, substring_dedup, topk

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = {"size": "x", "fp": "y", "component_id": "z", "key": 1, "at": 2, "node": 3, "class_id": 4, "taken": 5, "chunk": 6, "body": 7, "band": 8, "item_id": 9, "score": 10, "root": 11, "first": 12, "target": 13, "base": 14, "n": 15}
PASSAGE = " ".join(f"w{i}" for i in range(60))
ODD = [
    (1, "", "en", "a", 0), (2, None, None, None, None), (None, "some plain words", "en", None, 3), (3, "   \n\t ", "de", "a", 6), (4, "long word " * 40_000, "en", "b", 1), (5, "the same line here\nand another\nthird one", "en", "a", 2),
    (5, "the same line here\nand another\nthird one", "en", "a", 2), (6, "the same line here\nand another\nthird one", None, "a", 2), (7, PASSAGE, "fr", "", 4), (8, "before it " + PASSAGE + " after it", "fr", "c", 5), (9, "1234 5678 !!", "de", "c", 1), (10, "\U0001f600 été İ", "fr", "c", 1),
    (None, None, None, None, None), (11, "x", "en", "d", 1), (5, "other text with that id", "en", "a", 1),
]


def docs_of(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns({k: F.lit(v) for k, v in CLASHING.items()})


@pytest.fixture(scope="module")
def odd(spark):
    return docs_of(spark, ODD).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return docs_of(spark, []).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (5, 0, 0), (5, 1, 0), (7, 1, 1), (99, 1, 1), (8, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, PASSAGE, "x"), (2, None, "x"), (3, "", "x"), (None, "some plain words", "x"), (4, "other text", "x")], "item_id long, text string, doc_id string")


def test_quality(odd, empty, labels):
    rows = quality.classify(odd, quality.grade(labels)).collect()
    assert len(rows) == len(ODD) and all(0 <= r["expected_grade"] <= 2 and r["p_at_least_1"] >= r["p_at_least_2"] for r in rows)
    assert not any(r["selected"] for r in rows if r["doc_id"] in (1, 2, 3))
    assert quality.classify(empty, quality.grade(labels)).count() == 0 and quality.classify(odd, quality.grade(labels.where("false"))).count() == len(ODD)
    assert {tuple(r) for r in quality.grade(labels).collect()} == {(1, 2), (5, 1), (7, 0), (99, 0)}


def test_line_dedup(odd, empty):
    out = line_dedup.dedup_lines(odd)
    assert out.columns == odd.columns and out.count() == len(ODD) and line_dedup.dedup_lines(empty).count() == 0
    texts = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert (2, None) in texts and (1, "") in texts and (4, "long word " * 40_000) in texts
    assert (5, ODD[5][1]) in texts and len(next(t for i, t in texts if i == 6)) < len(ODD[5][1])


def test_topk(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (100, [0.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, [0.5, 9.0], 1), (3, None, 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [None, 1.0], 1), (7, [1.0], 1), (None, [1.0, 1.0], 1), (2, [0.5, 9.0], 1), (8, [], 1), (200, [], 1)]
    df = topk.quantized(spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int"))
    found = sorted(tuple(r) for r in topk.top_k(df, df.where("vec_id % 100 = 0"), 3).collect())
    assert found == [(0, 1, 1, 512 * 1024), (0, 2, 2, 512 * 1024), (0, 3, 2, 512 * 1024), (100, 1, 0, 0), (100, 2, 1, 0), (100, 3, 2, 0), (200, 1, 8, 0)]
    assert topk.top_k(df.where("false"), df, 3).count() == 0 and topk.top_k(df, df.where("false"), 3).count() == 0


@pytest.mark.parametrize("most", [decontaminate.MOST_WORDS, 0])
def test_contamination(odd, empty, benchmark, most):
    found = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.contamination(odd, benchmark, most_words=most).collect())
    assert found == [(5, 4), (7, 1), (8, 1)]
    out = decontaminate.decontaminate(odd, benchmark, most_words=most)
    assert out.columns == odd.columns and {7, 8} & {r["doc_id"] for r in out.collect()} == set() and decontaminate.decontaminate(empty, benchmark, most_words=most).count() == 0
    assert decontaminate.decontaminate(odd, benchmark.where("false"), most_words=most).count() == len(ODD)


def test_secrets(odd, empty):
    rows = secrets.digest(secrets.find_secrets(odd)).collect()
    assert len(rows) == len(ODD) and all(r["spans"] == "" and r["n_hex"] == 0 for r in rows) and {r["base_sha256"][:8] for r in rows} == {"e3b0c442"}
    assert secrets.find_secrets(empty).count() == 0


def test_mixing(odd, empty):
    rows = mixing.mix(odd, keep=["text"]).collect()
    assert len(rows) == len(ODD) and mixing.mix(empty).count() == 0
    assert {r["taken"] for r in rows if r["text"] is None} == {0} and all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    places = [r["position"] for r in rows if r["position"] is not None]
    assert places == sorted(places)


def test_substring_dedup(odd, empty):
    found = {(r["doc_id"], r["class_id"], r["keep"]) for r in substring_dedup.repeated_passages(odd).collect()}
    assert found == {(7, 7, True), (8, 7, False)} and substring_dedup.repeated_passages(empty).count() == 0


def test_html(spark):
    rows = [(1, "u", None, "x"), (2, "u", "", "x"), (3, None, "<article><p>a &amp; b<br> c<p>d &lt; e</article><footer>f", "x"), (None, "u", "<p", "x"), (5, "u", "<div " * 5000, "x"), (6, "u", "<article><h1>t</h1>" + "<p>word</p>" * 20_000, "x"), (3, None, "<article><p>a &amp; b<br> c<p>d &lt; e</article><footer>f", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = html.main_text(pages).collect()
    assert [r["text"] for r in found if r["page_id"] == 3] == ["a & b c\nd < e"] * 2 and [r["text"] for r in found if r["page_id"] in (1, 2)] == ["", ""]
    assert next(r["n_chars"] for r in found if r["page_id"] == 6) == 100_001 and html.main_text(pages.where("false")).count() == 0


def test_language(odd, empty):
    rows = langid.identify(odd).collect()
    assert len(rows) == len(ODD) and {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3, 9)} == {"und"} and all(0 <= r["score"] <= 1 for r in rows)
    assert langid.identify(empty).count() == 0 and {r["lang_pred"] for r in langid.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    out = langid.known_language(odd)
    assert out.columns == odd.columns and not {1, 2, 3, 9} & {r["doc_id"] for r in out.collect()}


def test_simhash(odd, empty):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == len(ODD) and {r["component_id"] for r in rows if r["fp"] == 0} == {1} and {r["doc_id"] for r in rows if r["fp"] == 0} == {1, 2, 3, None}
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.one_of_each(odd)
    texts = [r["text"] for r in kept.collect()]
    assert kept.columns == odd.columns and texts.count(ODD[5][1]) == 1 and "some plain words" in texts and "other text with that id" in texts and simhash.one_of_each(empty).count() == 0


def test_pipeline_stages(spark, odd, empty, tmp_path):
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (odd, empty):
        docs = rows
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == rows.columns, name
            docs.write.mode("overwrite").parquet(f"{tmp_path}/{name.split()[0]}-{rows is odd}")
            docs = spark.read.parquet(f"{tmp_path}/{name.split()[0]}-{rows is odd}")
        last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
        assert (last.count() > 0) == (rows is odd) and not {7, 8} & {r["doc_id"] for r in last.collect()}
