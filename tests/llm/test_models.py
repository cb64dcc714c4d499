"""Trained models against plain fits; search with repeated ids; buckets of paragraphs and runs of words against brute force."""

import random

import numpy as np
import pytest
from test_operators import Sets, text

from signmine.llm import langid, quality, substring_dedup, topk

# --- 9: language ID -----------------------------------------------------------------------------


def test_ftrl_is_that_of_plain_loops(monkeypatch):
    monkeypatch.setattr(langid, "BUCKETS", 40)
    rng = np.random.default_rng(3)
    rows = [(np.sort(rng.choice(40, 6, replace=False)), rng.random(6)) for _ in range(50)]
    labels = np.array([int(at[0] < 4) + int(at[-1] > 36) for at, _ in rows])
    model = langid.Model(["a", "b", "c"], np.ones(40), np.zeros((40, 3)), np.zeros(3))
    alpha, beta, l1, l2 = 0.5, 1.0, 0.05, 0.1
    langid._ftrl(model, rows, labels, 2, alpha, beta, l1, l2)
    z, n = [[0.0] * 3 for _ in range(41)], [[0.0] * 3 for _ in range(41)]

    def weight(i, k):
        less = 0.0 if i == 40 else l1
        if abs(z[i][k]) <= less:
            return 0.0
        return -(z[i][k] - np.sign(z[i][k]) * less) / ((beta + n[i][k] ** 0.5) / alpha + l2)

    order = np.random.default_rng(17)
    for _ in range(2):
        for r in order.permutation(len(rows)):
            x = [*zip(rows[r][0].tolist(), rows[r][1].tolist(), strict=True), (40, 1.0)]
            w = {(i, k): weight(i, k) for i, _ in x for k in range(3)}
            logit = [sum(v * w[i, k] for i, v in x) for k in range(3)]
            p = np.exp(logit) / np.exp(logit).sum()
            for i, v in x:
                for k in range(3):
                    g = v * (p[k] - (labels[r] == k))
                    z[i][k] += g - ((n[i][k] + g * g) ** 0.5 - n[i][k] ** 0.5) / alpha * w[i, k]
                    n[i][k] += g * g
    want = np.array([[weight(i, k) for k in range(3)] for i in range(41)])
    assert model.weights == pytest.approx(want[:40]) and model.bias == pytest.approx(want[40]) and (model.weights == 0).any() and (model.weights != 0).any()


def test_temperature_is_inside_and_calibrates_short_texts(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    model = langid.train(docs.where(~langid.held_out()))
    assert 1.01 / langid.WIDEST < model.temperature < 0.99 * langid.WIDEST and model.temperature != 1
    logits, labels = [], []
    for r in docs.where(langid.held_out()).orderBy("doc_id").collect():
        for part in langid.snippets(r["text"] or "", r["doc_id"]):
            if r["lang"] and (found := langid.features(part)) is not None:
                logits.append(model.logits(found))
                labels.append(model.langs.index(r["lang"]))
    logits, labels = np.array(logits), np.array(labels)
    before, after = langid.log_loss(logits, labels), langid.log_loss(logits, labels, model.temperature)
    p = langid._softmax(logits / model.temperature)
    right = p.argmax(axis=1) == labels
    print(f"temperature {model.temperature:.3f}, log loss {before:.3f} to {after:.3f} on {len(labels)} snippets, right {right.mean():.3f}, mean score {p.max(axis=1).mean():.3f}")
    assert after < before and abs(p.max(axis=1).mean() - right.mean()) < 0.05 and len(labels) > 500


def test_language_model_does_not_depend_on_the_order_of_rows(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("text", "lang")
    copies = docs.unionByName(docs.limit(1)).unionByName(docs.limit(1))
    one, two = langid.train(docs.repartition(7)), langid.train(docs.orderBy("text").coalesce(1))
    assert (one.weights == two.weights).all() and one.temperature == two.temperature
    assert langid.train(copies, sample=10).langs == one.langs


def test_scores_without_doubt_or_rows():
    assert langid._temperature(np.zeros((0, 2)), np.zeros(0, int)) == 1 and langid._temperature(np.array([[2.0, 0.0]]), np.array([0])) == 1
    logits = np.array([[2.0, 0.0]] * 8 + [[0.0, 2.0]] * 2)  # four fifths right where 2 / T says so
    assert langid._temperature(logits, np.zeros(10, int)) == pytest.approx(2 / np.log(4), rel=1e-3)


# --- 1: quality ---------------------------------------------------------------------------------


def loss(w, theta, rows, grades):
    s = np.array([w[at].sum() * quality.scale(at) for at in rows])
    a = np.where(grades < 2, 1 / (1 + np.exp(-(theta[np.minimum(grades, 1)] - s))), 1.0)
    b = np.where(grades > 0, 1 / (1 + np.exp(-(theta[np.maximum(grades - 1, 0)] - s))), 0.0)
    return -np.log(np.maximum(a - b, 1e-12)).mean()


def test_fit_comes_near_the_plain_cumulative_link_fit(monkeypatch):
    monkeypatch.setattr(quality, "BUCKETS", 30)
    rng = np.random.default_rng(5)
    truth = rng.normal(size=30) * 2
    rows = [np.sort(rng.choice(30, rng.integers(3, 9), replace=False)) for _ in range(500)]
    score = np.array([truth[at].sum() * quality.scale(at) for at in rows]) + rng.logistic(size=500)
    grades = (score > -1.5).astype(int) + (score > 1.5).astype(int)
    model = quality.fit(rows, grades, epochs=60)
    w, theta, step = np.zeros(30), np.array([-1.0, 1.0]), 1e-5
    for _ in range(150):  # gradients by differences, downhill
        base = loss(w, theta, rows, grades)
        gw = np.array([(loss(w + step * (np.arange(30) == i), theta, rows, grades) - base) / step for i in range(30)])
        gt = np.array([(loss(w, theta + step * (np.arange(2) == i), rows, grades) - base) / step for i in range(2)])
        w, theta = w - 8 * gw, theta - 3 * gt
    best, found, null = loss(w, theta, rows, grades), loss(model.weights, model.thresholds, rows, grades), loss(np.zeros(30), np.array([-0.8, 0.8]), rows, grades)
    assert best < found + 1e-9 and found - best < 0.1 * (null - best) and np.corrcoef(w, model.weights)[0, 1] > 0.97


def test_tails_and_grade_are_those_of_the_formula():
    model = quality.Model(thresholds=np.array([-0.5, 0.7]))
    model.weights[quality.features("good words here")] = 0.3
    model.used[:] = True
    at = quality.features("good words there")
    s = sum(model.weights[i] for i in at) / len(at) ** 0.25
    assert model.tails("good words there") == pytest.approx([1 - 1 / (1 + np.exp(-(t - s))) for t in (-0.5, 0.7)])


def test_quality_model_does_not_depend_on_the_order_of_rows(spark, small):
    docs, ratings = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text"), quality.grade(spark.read.parquet(f"{small}/labels.parquet"))
    one, two = quality.train(docs.repartition(7), ratings.repartition(3)), quality.train(docs.orderBy("text").coalesce(1), ratings)
    assert (one.weights == two.weights).all() and (one.thresholds == two.thresholds).all() and one.weights.any()


# --- 3: top-k with repeated ids -----------------------------------------------------------------


@pytest.mark.parametrize("chunk", [topk.QUERY_CHUNK, 2])
def test_only_the_querys_own_row_is_left_out(spark, chunk):
    rows = [(0, [1.0, 0.0]), (0, [2.0, 0.0]), (0, [2.0, 0.0]), (1, [1.0, 1.0]), (100, [0.5, 3.0]), (7, [1.0, 5.0])]
    df = topk.quantized(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3))
    found = sorted(tuple(r) for r in topk.top_k(df, df.where("vec_id % 100 = 0"), 3, chunk).collect())
    want = []
    for q, (qid, qv) in enumerate(rows):
        if qid % 100 == 0:
            best = sorted((-sum(int(1024 * a) * int(1024 * b) for a, b in zip(qv, v, strict=True)), i) for c, (i, v) in enumerate(rows) if c != q)[:3]
            want += [(qid, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert found == sorted(want)


def test_products_that_do_not_fit_are_an_error(spark):
    df = topk.quantized(spark.createDataFrame([(0, [1e30, 1.0]), (1, [1.0, 1e30])], "vec_id long, embedding array<double>"))
    with pytest.raises(Exception, match="64 bits"):
        topk.top_k(df, df).collect()


# --- 7: buckets and runs ------------------------------------------------------------------------


@pytest.mark.parametrize("hot", [substring_dedup.HOT_BUCKET, 2])
def test_buckets_join_what_all_pairs_join(spark, monkeypatch, hot):
    rng = random.Random(4)
    base = [rng.getrandbits(31) for _ in range(60)]
    rows = []
    for node in range(120):
        some = sorted(set(rng.sample(base, rng.randint(30, 60))) | {rng.getrandbits(31) for _ in range(rng.randint(0, 2))})
        rows.append((node, np.array(some if node % 10 else sorted(base)[:50], np.uint32)))
    want = Sets()
    for i, a in rows:
        for j, b in rows:
            both = len(np.intersect1d(a, b))
            if i < j and both >= 0.8 * (len(a) + len(b) - both):
                want.join(i, j)
    # All in one bucket.
    bands = np.zeros(substring_dedup.BANDS, np.int64).tobytes()
    places = spark.createDataFrame([(i, i, 0, bytearray(bands)) for i, _ in rows], "node long, doc_id long, at int, bands binary")
    lines = spark.createDataFrame([(i, i, 0, bytearray(x.tobytes())) for i, x in rows], "h1 long, doc_id long, at int, shingles binary")
    have = Sets()
    for a, b in substring_dedup.near_paragraphs(places, lines, hot).collect():
        if a != b:
            have.join(a, b)
    assert {i: have.root(i) for i, _ in rows} == {i: want.root(i) for i, _ in rows} and len({want.root(i) for i, _ in rows}) > 3


def test_runs_of_fifty_words_against_brute_force(spark):
    rng = random.Random(21)
    shared = [text(rng, n, 9000).split() for n in (50, 50, 57, 80, 120, 200)]
    docs = []
    for i in range(60):
        words = text(rng, rng.randint(0, 60), 9000).split()
        for passage in rng.sample(shared, rng.randint(0, 2)):
            cut = rng.randint(0, max(0, len(passage) - 50))
            words += passage[cut : cut + rng.randint(50, 200)] + text(rng, rng.randint(0, 60), 9000).split()
        docs.append((i, "".join(w + rng.choice((" ", " ", "\n")) for w in words)))
    runs = {}
    for i, t in docs:
        w = t.split()
        for at in range(len(w) - 49):
            runs.setdefault(tuple(w[at : at + 50]), set()).add((i, at))
    allowed, shared_runs = set(), [place for places in runs.values() if len({i for i, _ in places}) > 1 for place in places]
    grams = {}
    for i, t in docs:
        w = t.split()
        for at in range(len(w) - 20):
            grams.setdefault(tuple(w[at : at + 21]), set()).add((i, at))
    for places in grams.values():
        if len({i for i, _ in places}) > 1:
            allowed |= {(i, at + k) for i, at in places for k in range(21)}
    found = set()
    for r in substring_dedup.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).where("kind = 'passage'").collect():
        found |= {(r["doc_id"], r["start_word"] + k) for k in range(r["n_words"])}
    assert len(shared_runs) > 500 and all(any((i, at + k) in found for k in range(50)) for i, at in shared_runs) and found <= allowed
