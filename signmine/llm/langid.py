"""Operator 9: language identification by sparse multinomial logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signmine.llm.common import id_text

#: Hashed n-grams. The model has so many weights for each language.
BUCKETS = 1 << 16
#: Documents of each language that the weights are fitted on, at most, on average (drawn by hash). Document frequencies are counted over all that may be learnt from.
SAMPLE = 700
#: A fifth of the sample is kept from the weights for the temperature: of each text of it, SNIPPETS runs of at most SNIPPET_WORDS words. Whole texts leave no doubt of their language, so they can't tell how far doubt is right.
SNIPPETS, SNIPPET_WORDS = 4, 3
#: The temperature is searched within a factor of this.
WIDEST = 1e4
UNKNOWN = "und"

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_SHIFT = np.uint64(64 - 16)
_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.array([chr(c).isalpha() if not 0xD800 <= c < 0xE000 else False for c in range(0x110000)])
    return _letters


def features(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """(buckets, 1 + log counts) of the whole text's 1- to 3-grams of lower-cased letters, where anything between words counts as one space. None without a letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _is_letter()[codes]
    if not letter.any():
        return None
    codes = np.where(letter, codes, 32)
    stays = letter.copy()
    stays[1:] |= letter[:-1]  # of white space, the first
    codes = np.concatenate([[32], codes[stays], [32]]).astype(np.uint64)
    rolled, found = np.zeros(len(codes), np.uint64), []
    for n in range(3):
        rolled = (rolled[: len(codes) - n] if not n else rolled[:-1]) * np.uint64(0x100000001B3) + codes[n:]
        mixed = (rolled + np.uint64(n + 1)) * _FACTORS[n]
        mixed ^= mixed >> np.uint64(29)
        found.append((mixed * _FACTORS[0] >> _SHIFT).astype(np.int64))
        if len(rolled) < 2:
            break
    flat = np.concatenate(found)
    if len(flat) < BUCKETS // 4:
        at, counts = np.unique(flat, return_counts=True)
        return at, 1 + np.log(counts)
    counts = np.bincount(flat, minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, 1 + np.log(counts[at])


def snippets(text: str, key: int) -> list[str]:
    """Runs of one to SNIPPET_WORDS of the text's words, drawn by key."""
    words, draw = text.split(), np.random.default_rng(key & (1 << 63) - 1)
    starts, sizes = draw.integers(0, max(1, len(words)), SNIPPETS), draw.integers(1, SNIPPET_WORDS + 1, SNIPPETS)
    return [" ".join(words[a : a + n]) for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)]


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray  # bucket x language
    bias: np.ndarray
    temperature: float = 1.0

    def vector(self, found: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        at, tf = found
        x = tf * self.idf[at]
        return at, x / max(np.sqrt(x @ x), 1e-12)

    def logits(self, found: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        at, x = self.vector(found)
        return x @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        found = features(text)
        if found is None or not self.langs:
            return UNKNOWN, 0.0
        p = _softmax(self.logits(found) / self.temperature)
        best = int(p.argmax())
        return self.langs[best], float(p[best])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _ftrl(model: Model, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int, alpha: float, beta: float, l1: float, l2: float) -> None:
    """Follow-the-proximally-regularised-leader with one rate for each weight, and the elastic net: |z| <= l1 gives a weight of 0."""
    k = len(model.langs)
    z, n = np.zeros((BUCKETS + 1, k)), np.zeros((BUCKETS + 1, k))  # the last row is the bias, which isn't penalised by l1
    order = np.random.default_rng(17)

    def solve(at: np.ndarray) -> np.ndarray:
        part = z[at]
        less = np.where((at == BUCKETS)[:, None], 0.0, l1)
        return np.where(np.abs(part) <= less, 0.0, -(part - np.sign(part) * less) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, x = rows[i]
            at, x = np.append(at, BUCKETS), np.append(x, 1.0)
            w = solve(at)
            error = _softmax(x @ w)
            error[labels[i]] -= 1
            g = x[:, None] * error
            more = n[at] + g * g
            z[at] += g - (np.sqrt(more) - np.sqrt(n[at])) / alpha * w
            n[at] = more
    everything = solve(np.arange(BUCKETS + 1))
    model.weights, model.bias = everything[:-1], everything[-1]


def log_loss(logits: np.ndarray, labels: np.ndarray, temperature: float = 1.0) -> float:
    p = _softmax(logits / temperature)
    return float(-np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-300)).mean())


def _temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss on rows that the weights weren't fitted on, by golden-section search over its logarithm.

    The loss is convex in 1 / temperature. Where all rows are right the least lies at the end of the search, and where there are none, 1 is as good as any: then nothing is calibrated.
    """
    if not len(labels) or (logits.argmax(axis=1) == labels).all():
        return 1.0
    loss = lambda log_t: log_loss(logits, labels, np.exp(log_t))
    a, b, ratio = -np.log(WIDEST), np.log(WIDEST), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def _frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for text in batch["text"]:
            if (found := features(text)) is not None:
                counts[found[0]] += 1
    at = np.flatnonzero(counts)
    yield pd.DataFrame({"bucket": at, "n": counts[at]})


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(key, lang, apart, buckets, tf): of a text for the weights its own features, of one that is kept apart those of its snippets."""
    for batch in batches:
        rows = []
        for key, lang, text in zip(batch["key"], batch["lang"], batch["text"], strict=True):
            apart = key % 5 == 0
            for part in snippets(text, key) if apart else [text]:
                if (found := features(part)) is not None:
                    rows.append((key, lang, apart, found[0].astype(np.int32).tobytes(), found[1].astype(np.float32).tobytes()))
        if rows:  # Arrow makes no plain array of an empty binary column
            yield pd.DataFrame(rows, columns=["key", "lang", "apart", "buckets", "tf"])


def train(labelled: DataFrame, sample: int = SAMPLE, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.05, l2: float = 0.1) -> Model:
    """A model of (text, lang). Document frequencies come from all rows with both; weights and temperature from about `sample` different texts of each language at most,
    drawn by a hash of the text and taken in its order, a fifth of them for the temperature alone: the same rows give the same model, however they are dealt out, and copies of a text count once.
    No such rows: a model without languages, which answers "und"."""
    rows = labelled.select("text", "lang").where("text is not null and lang is not null")
    sizes = {row["lang"]: row["n"] for row in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    model = Model(langs, np.zeros(BUCKETS), np.zeros((BUCKETS, len(langs))), np.zeros(len(langs)))
    if not langs:
        return model
    df = np.zeros(BUCKETS)
    for bucket, n in rows.select("text").mapInPandas(_frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        df[bucket] = n
    model.idf = np.log((1 + sum(sizes.values())) / (1 + df)) + 1
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample / n))).otherwise(share)
    key = F.xxhash64("text")
    draw = F.pmod(key, F.lit(1 << 20)) < share * (1 << 20)
    # What is drawn is small; copies of one text are counted together, and no language has more than twice its share.
    drawn = rows.where(draw).groupBy("lang", "text").agg(F.min(key).alias("key"))
    drawn = drawn.withColumn("no", F.row_number().over(Window.partitionBy("lang").orderBy("key", "text"))).where(F.col("no") <= 2 * sample)
    drawn = drawn.select("key", "lang", "text").mapInPandas(_rows, "key long, lang string, apart boolean, buckets binary, tf binary").toPandas()
    drawn = drawn.sort_values(["key", "lang", "buckets"], kind="stable")
    found = [model.vector((np.frombuffer(a, np.int32).astype(np.int64), np.frombuffer(b, np.float32).astype(float))) for a, b in zip(drawn["buckets"], drawn["tf"], strict=True)]
    labels, apart = np.array([langs.index(x) for x in drawn["lang"]], int), drawn["apart"].to_numpy(bool)
    if len(set(labels[~apart].tolist())) < len(langs):  # hardly any rows
        apart[:] = False
    _ftrl(model, [x for x, a in zip(found, apart, strict=True) if not a], labels[~apart], epochs, alpha, beta, l1, l2)
    held = [x @ model.weights[at] + model.bias for (at, x), a in zip(found, apart, strict=True) if a]
    model.temperature = _temperature(np.array(held).reshape(-1, len(langs)), labels[apart])
    model.weights = model.weights.astype(np.float32)
    return model


def predict_udf(model: Model):
    @F.pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(x if isinstance(x, str) else None) for x in texts], columns=["lang", "score"])

    return predict


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from learning: crc32 of its id as text is 2 modulo 4. A null id counts as the empty text, which isn't."""
    return F.crc32(id_text(doc_id)) % 4 == 2


def identify(docs: DataFrame) -> DataFrame:
    """A row for each row of docs: doc_id, held_out, lang_pred, score (0 to 1, the probability, calibrated on short texts).

    Learns from text and lang of the rows that aren't held out; predictions see the whole text and nothing else. Null text, empty text and
    text without a letter: lang_pred "und", score 0. Without any labelled row every prediction is that. Null lang: not learnt from. Repeated rows count each;
    ties go to the language that sorts first. An empty table gives no rows. Other columns play no part.
    """
    model = train(docs.where(~held_out()))
    return docs.select("doc_id", held_out().alias("held_out"), predict_udf(model)(F.col("text")).alias("p")).select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def known_language(docs: DataFrame, least: float = 0.4) -> DataFrame:
    """docs without those that identify() rejects: no letters, or no language with a probability of `least` or more. Columns stay as they are."""
    model = train(docs.where(~held_out()))
    found = docs.withColumn("__language", predict_udf(model)(F.col("text")))
    return found.where((F.col("__language.lang") != UNKNOWN) & (F.col("__language.score") >= least)).select(*[F.col(f"`{c}`") for c in docs.columns])
