"""Operator 1: a quality classifier by ordinal cumulative-link regression on hashed text."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 18
#: Rated documents that the model is fitted on, at most, on average (drawn by hash).
SAMPLE = 16_000
#: Hashed features that fewer of these hold have no weight (all may have one where fewer than 40 times as many are rated).
LEAST_HOLDERS = 20
#: A document is selected if its chance of the top grade is as large.
SELECT = 0.5

_RUN = re.compile(r"[^\W\d_]+|\d+")


def grade(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 toxic, 1 of low quality, 2 good; of several labels of one document the lowest grade, and null labels count as none."""
    rated = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return labels.select("doc_id", rated.alias("grade")).where("grade is not null and doc_id is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))


def features(text: str | None) -> np.ndarray:
    """Buckets of the whole text's words, of the shapes of what isn't letters in them, and of how far words repeat; all hashed text, each once."""
    words = (text or "").split()
    distinct = set(words)
    tokens = {w.lower() for w in distinct}
    tokens |= {"#" + _RUN.sub("a", w) for w in distinct}
    if words:
        tokens.add(f"#distinct {int(8 * len(distinct) / len(words))} {min(6, len(words).bit_length() // 2)}")
        tokens.add(f"#upper {int(8 * sum(w.isupper() for w in distinct) / len(distinct))}")
        tokens.add(f"#next {int(8 * sum(a == b for a, b in zip(words, words[1:], strict=False)) / len(words))}")
    return np.unique(np.fromiter((zlib.crc32(t.encode("utf-8", "replace")) for t in tokens), np.int64, len(tokens)) % BUCKETS)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def scale(at: np.ndarray) -> float:
    """Value of each feature of a text: between 1 and 1 / sqrt(n), so that a few telling words count in long texts also."""
    return max(1, len(at)) ** -0.25


@dataclass
class Model:
    """P(grade <= k) = sigmoid(thresholds[k] - weights . x): one weight vector for all grades."""

    grades: int = 3
    weights: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, np.float32))
    used: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, bool))
    thresholds: np.ndarray = field(default_factory=lambda: np.array([-1.0, 1.0]))

    def tails(self, text: str | None) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ..."""
        return 1 - _sigmoid(self.thresholds - self.score(features(text)))

    def score(self, at: np.ndarray) -> float:
        at = at[self.used[at]]
        return float(self.weights[at].sum() * scale(at))


def fit(rows: list[np.ndarray], grades: np.ndarray, epochs: int = 12, rate: float = 0.2, l2: float = 1e-6) -> Model:
    """Stochastic gradients with AdaGrad rates on the cumulative-link log loss; thresholds are kept in order with a gap of 0.05."""
    model = Model()
    if not len(rows):
        return model
    model.used = np.bincount(np.concatenate(rows), minlength=BUCKETS) >= min(LEAST_HOLDERS, max(1, len(rows) // 40))
    rows = [at[model.used[at]] for at in rows]
    w, seen = np.zeros(BUCKETS), np.full(BUCKETS, 1e-3)
    theta, theta_seen = model.thresholds.copy(), np.full(2, 1.0)
    order = np.random.default_rng(3)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, y = rows[i], grades[i]
            x = scale(at)
            s = w[at].sum() * x
            a = _sigmoid(theta[y] - s) if y < 2 else 1.0
            b = _sigmoid(theta[y - 1] - s) if y else 0.0
            g = (1 - a - b) * x + l2 * w[at]
            seen[at] += g * g
            w[at] -= rate * g / np.sqrt(seen[at])
            p = max(a - b, 1e-9)
            for k, d in ((y, -a * (1 - a) / p), (y - 1, b * (1 - b) / p)):
                if 0 <= k < 2:
                    theta_seen[k] += d * d
                    theta[k] -= rate * d / np.sqrt(theta_seen[k])
            if theta[1] < theta[0] + 0.05:
                theta[:] = theta.mean() + np.array([-0.025, 0.025])
    model.weights, model.thresholds = w.astype(np.float32), theta
    return model


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if len(batch):  # Arrow makes no plain array of an empty binary column
            yield pd.DataFrame({"key": batch["key"], "grade": batch["grade"].astype("int32"), "buckets": [features(x if isinstance(x, str) else None).astype(np.int32).tobytes() for x in batch["text"]]})


def train(docs: DataFrame, ratings: DataFrame, sample: int = SAMPLE) -> Model:
    """From docs (doc_id, text) and ratings (doc_id, grade 0 to 2, one row for each doc_id): about `sample` of them, drawn by hash of doc_id and taken in its order.

    Of several rows of one doc_id the one whose text has the least hash counts, null last: the same rows give the same model, however they are dealt out.
    """
    total = ratings.count()
    if not total:
        return Model()
    key = F.xxhash64("doc_id")
    drawn = ratings.where(F.pmod(key, F.lit(1 << 20)) < (1 << 20) * min(1.0, sample / total)).orderBy(key, "doc_id").limit(2 * sample)
    # The drawn ratings number 2 * sample at most: a broadcast of proven size.
    found = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    one = found.groupBy("doc_id").agg(F.first("grade").alias("grade"), F.min(F.struct(F.col("text").isNull().alias("none"), F.xxhash64("text").alias("h"), "text")).alias("x"))
    rows = one.select(F.xxhash64("doc_id").alias("key"), "grade", "x.text").mapInPandas(_rows, "key long, grade int, buckets binary").toPandas()
    rows = rows.sort_values(["key", "grade", "buckets"], kind="stable")
    return fit([np.frombuffer(b, np.int32).astype(np.int64) for b in rows["buckets"]], rows["grade"].to_numpy(int))


def tails_udf(model: Model):
    @F.pandas_udf("at_least_1 double, at_least_2 double")
    def tails(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.tails(x if isinstance(x, str) else None) for x in texts], columns=["at_least_1", "at_least_2"])

    return tails


def classify(docs: DataFrame, ratings: DataFrame, select: float = SELECT) -> DataFrame:
    """A row for each row of docs: doc_id, expected_grade (0 to 2), p_at_least_1 and p_at_least_2 (tail probabilities), selected.

    Null and empty texts have no features but the thresholds' own odds, and are never selected. Without ratings the odds are those of thresholds -1 and 1.
    Ratings of documents that aren't there, null ratings and other columns play no part; repeated rows count each. An empty table gives no rows.
    """
    model = train(docs, ratings)
    found = docs.select("doc_id", F.coalesce(F.length(F.trim("text")), F.lit(0)).alias("n"), tails_udf(model)(F.col("text")).alias("p"))
    return found.select(
        "doc_id", (F.col("p.at_least_1") + F.col("p.at_least_2")).alias("expected_grade"), F.col("p.at_least_1").alias("p_at_least_1"), F.col("p.at_least_2").alias("p_at_least_2"),
        ((F.col("p.at_least_2") >= select) & (F.col("n") > 0)).alias("selected"),
    )
