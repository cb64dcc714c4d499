"""Operator 7: repeated passages, by paragraph MinHash banding, exact verification and components."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signmine.llm.common import components, cut

#: Words of a shingle; least Jaccard similarity of two paragraphs' shingle sets.
SHINGLE, SIMILARITY = 5, 0.8
#: Shorter paragraphs have no shingle.
LEAST_WORDS = SHINGLE
#: Words of a cut, as below.
CUT_WORDS = 21
#: Passages inside longer paragraphs: cut out from each word that a hash of its shingle chooses in some window of ANCHOR_WINDOW places.
#: A run of CUT_WORDS + ANCHOR_WINDOW - 1 = 50 words that two documents share has such a cut in common, wherever it stands.
ANCHOR_WINDOW = 30
#: Recall at SIMILARITY that the bands must reach, and hashes they may take.
RECALL, MOST_HASHES = 0.995, 24
#: A bucket with more paragraphs is dealt out by their sizes.
HOT_BUCKET = 4096
#: Words that are hashed at a time, and shingles whose MinHashes are computed at a time.
WORDS_BLOCK, BANDS_BLOCK = 1 << 15, 1 << 10

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)


def tune(similarity: float = SIMILARITY, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band may have (the fewest chance collisions) so that `recall` is reached within `most` hashes."""
    for rows in range(most, 0, -1):
        miss = 1 - similarity**rows
        bands = ceil(np.log(1 - recall) / np.log(miss))
        if bands * rows <= most:
            return bands, rows
    raise ValueError("no bands reach this recall")


BANDS, ROWS = tune()
_draw = np.random.default_rng(29)
_A = _draw.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _draw.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def _shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of all runs of SHINGLE word hashes; of the whole if it is shorter."""
    n = len(words) - SHINGLE + 1
    if n < 1:
        return _mixed(words.cumsum(dtype=np.uint64)[-1:])
    out = np.zeros(n, np.uint64)
    for i in range(SHINGLE):
        out = out * np.uint64(_BASE) + words[i : i + n]
    return _mixed(out)


def bands_of(shingles: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A row of bands for each run [start, end) of shingles; the runs are in order and none is empty. Shingles are mixed, so linear hashes of them do."""
    low = np.full((len(starts), BANDS * ROWS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), BANDS_BLOCK):
        first, last = np.searchsorted(ends, at, "right"), np.searchsorted(starts, at + BANDS_BLOCK)
        if first < last:  # runs that reach into this block
            x = shingles[at : at + BANDS_BLOCK, None] * _A
            x += _B
            edges = np.stack([np.maximum(starts[first:last] - at, 0), np.minimum(ends[first:last] - at, len(x))], axis=1).ravel()
            found = np.minimum.reduceat(x, edges[:-1] if edges[-1] == len(x) else edges, axis=0)[::2]
            np.minimum(low[first:last], found, out=low[first:last])
    low = low.reshape(len(starts), BANDS, ROWS)
    out = np.tile(np.arange(BANDS, dtype=np.uint64), (len(starts), 1))
    for i in range(ROWS):
        out = _mixed(out * np.uint64(_BASE) + low[:, :, i])
    return out.view(np.int64)


def anchors(shingles: np.ndarray, window: int = ANCHOR_WINDOW) -> np.ndarray:
    """Places that are the (rightmost) least in some window of so many shingles: winnowing."""
    if len(shingles) < window:
        return np.zeros(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(shingles, window)
    return np.unique(np.arange(len(windows)) + window - 1 - windows[:, ::-1].argmin(axis=1))


def _powers(n: int, kept: dict[str, np.ndarray] = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006  a memo
    if len(kept.get("up", ())) < n:
        size = 1 << max(12, n.bit_length())
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            kept[name] = np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]).cumprod(dtype=np.uint64)
    return kept["up"], kept["down"]


#: The code points that str.split() parts words at; the last place stands for all that follow.
_SPACE = np.array([chr(c).isspace() for c in range(0x3001)] + [False])


def word_hashes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words, and the number of words before each line and at the end.

    A word's hash is a polynomial in its mixed code points, taken from prefix sums over a block of words.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    inside = np.concatenate([[False], ~_SPACE[np.minimum(points, len(_SPACE) - 1)], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    lines = np.concatenate([[0], np.searchsorted(starts, np.flatnonzero(points == 10)), [len(starts)]])
    hashes = np.zeros(len(starts), np.uint64)
    for at in range(0, len(starts), WORDS_BLOCK):
        a, b = starts[at : at + WORDS_BLOCK], ends[at : at + WORDS_BLOCK]
        body = _mixed((points[a[0] : b[-1]].astype(np.uint64) + np.uint64(1)) * np.uint64(_BASE))
        up, down = _powers(len(body) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), (body * up[: len(body)]).cumsum(dtype=np.uint64)])
        hashes[at : at + WORDS_BLOCK] = _mixed((total[b - a[0]] - total[a - a[0]]) * down[a - a[0]])
    return hashes, lines


def passages(words: np.ndarray, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, first signature, second signature) of the CUT_WORDS words from each anchor on."""
    starts = anchors(shingles) if len(words) >= CUT_WORDS + ANCHOR_WINDOW - 1 else np.zeros(0, np.int64)
    starts = starts[starts + CUT_WORDS <= len(words)]
    up, down = _powers(len(words) + 1)
    signatures = []
    for body in (words, _mixed(words + np.uint64(1))):
        total = np.concatenate([np.zeros(1, np.uint64), (body * up[: len(words)]).cumsum(dtype=np.uint64)])
        signatures.append(_mixed((total[starts + CUT_WORDS] - total[starts]) * down[starts]).view(np.int64))
    return starts, signatures[0], (signatures[1] >> 32).astype(np.int32)


def _paragraphs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each document the paragraphs of LEAST_WORDS words or more, with bands and shingles, and its passages."""
    for batch in batches:
        rows: list[tuple] = []
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            words, lines = word_hashes(text)
            if len(words) < LEAST_WORDS:
                continue
            shingles = _shingles(words)
            long = np.flatnonzero(np.diff(lines) >= LEAST_WORDS)
            first, last = lines[long], lines[long + 1]
            bands = bands_of(shingles, first, last - SHINGLE + 1)
            for a, b, keys in zip(first.tolist(), last.tolist(), bands, strict=True):
                whole = xxhash.xxh3_128_digest(words[a:b].tobytes())
                distinct = np.unique(shingles[a : b - SHINGLE + 1].astype(np.uint32))
                rows.append((doc_id, a, b - a, *np.frombuffer(whole, np.int64).tolist(), keys.tobytes(), distinct.tobytes(), None))
            starts, one, two = passages(words, shingles)
            if len(starts):
                cuts = np.empty(len(starts), [("at", "<i4"), ("one", "<i8"), ("two", "<i4")])
                cuts["at"], cuts["one"], cuts["two"] = starts, one, two
                rows.append((doc_id, 0, 0, 0, 0, None, None, cuts.tobytes()))
            if len(rows) > 5000:
                yield pd.DataFrame(rows, columns=_COLUMNS)
                rows = []
        if rows:  # Arrow makes no plain array of an empty binary column
            yield pd.DataFrame(rows, columns=_COLUMNS)


_COLUMNS = ["doc_id", "at", "n_words", "h1", "h2", "bands", "shingles", "cuts"]


def _cuts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    kind = np.dtype([("at", "<i4"), ("one", "<i8"), ("two", "<i4")])
    for batch in batches:
        found = [np.frombuffer(x, kind) for x in batch["cuts"]]
        if found:
            flat = np.concatenate(found)
            yield pd.DataFrame({"doc_id": np.repeat(batch["doc_id"].to_numpy(), [len(x) for x in found]), "at": flat["at"], "h1": flat["one"], "h2": flat["two"]})


def _explode_bands(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if len(batch):
            keys = np.concatenate([np.frombuffer(x, np.int64) for x in batch["bands"]])  # the band's number is mixed into its key
            yield pd.DataFrame({"node": np.repeat(batch["node"].to_numpy(), BANDS), "key": keys})


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    least, most = sorted((len(a), len(b)))
    if least < SIMILARITY * most:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= SIMILARITY * (len(a) + len(b) - both)


class _Bucket:
    """Paragraphs of one bucket in clusters. A new one is compared with a cluster's members until one is similar, the newest first, and then with those of the clusters that it isn't in yet."""

    def __init__(self):
        self.clusters: list[list[tuple[int, np.ndarray]]] = []
        self.same: dict[bytes, int] = {}

    def add(self, node: int, shingles: bytes) -> list[tuple[int, int]]:
        """Links that join it to the clusters it belongs to. One with the same shingles as another needs no more than a link to that."""
        if (other := self.same.setdefault(shingles, node)) != node:
            return [(node, other)]
        mine, links, apart, own = np.frombuffer(shingles, np.uint32), [], [], []
        for cluster in self.clusters:
            found = next((other for other, theirs in reversed(cluster) if _similar(mine, theirs)), None)
            if found is None:
                apart.append(cluster)
                continue
            links.append((node, found))
            own, cluster = (own, cluster) if len(own) > len(cluster) else (cluster, own)
            own += cluster
        own.append((node, mine))
        self.clusters = [*apart, own]
        return links


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links among rows that come sorted by (key, part): of each bucket, exact similarity of its pairs, but for pairs that are already joined through others. A bucket's paragraphs are held as long as it lasts."""
    now, bucket = None, _Bucket()
    for batch in batches:
        links = []
        for key, part, node, shingles in zip(batch["key"], batch["part"], batch["node"], batch["shingles"], strict=True):
            if now != (key, part):
                now, bucket = (key, part), _Bucket()
            links += bucket.add(node, bytes(shingles))
        yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def near_paragraphs(paragraphs: DataFrame, lines: DataFrame, hot: int = HOT_BUCKET) -> DataFrame:
    """Links (a, b) between different paragraphs of SIMILARITY or more, as many as join their components.

    paragraphs has (node, doc_id, at, bands), a node once with one place where it stands; lines has (h1, doc_id, at, shingles).
    Only paragraphs that share a bucket with another get their shingles and are compared. A bucket of more than `hot` is dealt out by size: each paragraph goes to its own class of sizes
    and to the next, and sizes of similar ones are no more than a class apart.
    """
    keys = paragraphs.select("node", "bands").mapInPandas(_explode_bands, "node long, key long")
    bucket = Window.partitionBy("key")
    shared = cut(keys.withColumns({"least": F.min("node").over(bucket), "most": F.max("node").over(bucket), "n": F.count("*").over(bucket)}).where("least < most").select("key", "node", (F.col("n") > hot).alias("hot")))
    places = paragraphs.join(shared.select("node").distinct(), "node", "left_semi").select("node", F.col("doc_id").alias("__doc"), F.col("at").alias("__at"))
    held = lines.join(places, (F.col("h1") == F.col("node")) & (F.col("doc_id") == F.col("__doc")) & (F.col("at") == F.col("__at"))).select("node", "shingles")
    # Several rows of one doc_id may hold a place each, with the same shingles: links of a node to itself do no harm.
    size = F.floor(F.log(F.octet_length("shingles") / 4) / F.log(F.lit(1 / SIMILARITY)) + 1e-9).cast("int")
    rows = shared.join(held, "node").select("key", F.explode(F.when(F.col("hot"), F.array(size, size + 1)).otherwise(F.array(F.lit(-1)))).alias("part"), "node", "shingles")
    rows = rows.repartition("key", "part").sortWithinPartitions("key", "part", "node")
    return rows.mapInPandas(_verify, "a long, b long")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """Passages that stand in more than one document: doc_id, kind, start_word, n_words, class_id, keep.

    kind "paragraph": a line of LEAST_WORDS words or more. Lines of the same words are one class; lines whose sets of five-word shingles have a Jaccard
    similarity of 0.8 or more are linked (MinHash bands tuned for a recall of 0.995 at 0.8, then exact similarity), and components of links are classes.
    kind "passage": words that another document has word for word, wherever they stand, line ends included: neighbouring cuts of CUT_WORDS words, of
    which one at least lies in every run of 50 words that two documents share. Words are parted by white space and lower-cased.
    class_id is the least doc_id of the class, start_word the place of the passage's first word in its document. keep is true for the class's documents of that
    id alone: what the others repeat can be removed. Rows of one doc_id are one document; classes that one document has to itself are left out.
    Texts and shingles are compared by hashes of 128 and 32 bits, a paragraph and a band's bucket are named by 64 bits, and a cut by 96.
    Null and empty texts and null doc_ids take no part. An empty table gives no rows; other columns play no part.
    """
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_id}, at int, n_words int, h1 long, h2 long, bands binary, shingles binary, cuts binary"
    units = cut(docs.select("doc_id", "text").where("doc_id is not null and text is not null and text <> ''").mapInPandas(_paragraphs, schema))

    lines = units.where("cuts is null")
    # Copies meet first: from now on each text stands once, named by its first hash, with its first place.
    distinct = cut(lines.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.max("doc_id").alias("most"), F.first("bands").alias("bands")).withColumn("node", F.col("h1")))
    found = components(near_paragraphs(distinct.select("node", "first.doc_id", "first.at", "bands"), lines))
    classed = distinct.select("h1", "h2", F.col("first.doc_id").alias("least"), "most", "node").join(found, "node", "left").select("h1", "h2", "least", "most", F.coalesce("root", "node").alias("root"))
    of = classed.groupBy("root").agg(F.min("least").alias("class_id"), F.max("most").alias("most")).where("class_id < most")
    names = classed.join(of.select("root", "class_id"), "root").select("h1", "h2", "class_id")
    whole = lines.select("doc_id", "at", "n_words", "h1", "h2").join(names, ["h1", "h2"]).select("doc_id", F.lit("paragraph").alias("kind"), F.col("at").alias("start_word"), "n_words", "class_id")

    cuts = units.where("cuts is not null").select("doc_id", "cuts").mapInPandas(_cuts, f"doc_id {doc_id}, at int, h1 long, h2 int")
    # Written, so that the join below has an exchange of its own, whose large partitions adaptive execution splits: a passage may stand in very many documents.
    several = cut(cuts.groupBy("h1").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("h1"))
    again = cut(cuts.join(several, "h1", "left_semi"))  # few: all that follows is over these
    shared = cut(again.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("h1", "h2"))  # for the same reason
    parts = _runs(again.join(shared, ["h1", "h2"]).select("doc_id", "at", F.col("h1").alias("node")).distinct()).select("doc_id", F.lit("passage").alias("kind"), "start_word", "n_words", "class_id")
    return whole.unionByName(parts).withColumn("keep", F.col("doc_id") == F.col("class_id"))


def _runs(cuts: DataFrame) -> DataFrame:
    """(doc_id, class_id, start_word, n_words): neighbouring cuts of one document and class put together.

    Which cuts are chosen near a passage's ends depends on what stands about it. So cuts are linked that overlap in some document, or that stand within a window
    of each other in the same way in two documents; components of cuts are the classes: a passage's cuts have one class wherever it stands.
    """
    cuts = cut(cuts)
    order = Window.partitionBy("doc_id").orderBy("at", "node")
    pairs = cuts.select("doc_id", F.col("node").alias("a"), F.lag("node").over(order).alias("b"), (F.col("at") - F.lag("at").over(order)).alias("gap")).where(F.col("gap") <= ANCHOR_WINDOW)
    alike = pairs.groupBy("a", "b", "gap").agg((F.min("doc_id") < F.max("doc_id")).alias("alike"))
    found = components(alike.where((F.col("gap") <= CUT_WORDS) | F.col("alike")).select("a", "b").distinct())
    named = cuts.join(found, "node", "left").select("doc_id", "at", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    own = Window.partitionBy("doc_id", "root").orderBy("at")
    new = F.coalesce(F.col("at") > F.lag("at").over(own) + ANCHOR_WINDOW, F.lit(True)).cast("int")
    runs = named.withColumn("new", new).withColumn("run", F.sum("new").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    spans = runs.groupBy("doc_id", "root", "run").agg(F.min("at").alias("start_word"), (F.max("at") + CUT_WORDS - F.min("at")).alias("n_words"))
    return spans.join(least, "root").select("doc_id", "class_id", "start_word", "n_words")
