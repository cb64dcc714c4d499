"""Operator 4: benchmark decontamination by greedy string tiling."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signmine.llm.common import cut

#: The shortest tile; the share of an item's words that must be in tiles. Seeds are as long as the shortest tile, so that every pair that tiles can cover so far shares some.
LEAST_TILE, COVERAGE = 3, 0.8
SEED = LEAST_TILE
#: Benchmarks of up to so many words, and bytes, are sent to every task; beyond, seeds are joined by shuffling.
MOST_WORDS, MOST_BYTES = 300_000, 8_000_000
#: Bits of the filter of a large benchmark's seeds that documents' seeds go through before they are shuffled: 8 MB, whatever the benchmark's size.
FILTER_BITS = 1 << 26

_WORDS = re.compile(r"\w+")
#: Base of the rolling hash, modulo 2^64, and what spreads a word's number over it.
_BASE, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xC2B2AE3D27D4EB4F)


def words(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


def _powers(n: int, kept: dict[str, np.ndarray] = {}) -> np.ndarray:  # noqa: B006  a memo
    if len(kept.get("up", ())) < n:
        kept["up"] = np.concatenate([np.ones(1, np.uint64), np.full((1 << max(10, n.bit_length())) - 1, _BASE, np.uint64)]).cumprod(dtype=np.uint64)
    return kept["up"]


def _rolling(tokens: np.ndarray) -> np.ndarray:
    """Running Karp-Rabin sums of the tokens before each place; the hash of a window is the difference of two, brought to one power."""
    mixed = (tokens.astype(np.uint64) + np.uint64(1)) * _MIX
    mixed ^= mixed >> np.uint64(29)
    return np.concatenate([np.zeros(1, np.uint64), (mixed * _powers(len(tokens))[: len(tokens)]).cumsum(dtype=np.uint64)])


def _windows(sums: np.ndarray, room: np.ndarray, size: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, starts) of the windows of `size` free tokens. room: how many free tokens stand from each place on; top: no place is beyond it."""
    at = np.flatnonzero(room >= size)
    return (sums[at + size] - sums[at]) * _powers(top + 1)[top - at], at


def _room(free: np.ndarray) -> np.ndarray:
    """The length of the run of free places that goes on from each place."""
    n = len(free)
    taken = np.flatnonzero(~free)
    following = np.append(taken, n)[np.searchsorted(taken, np.arange(n))]
    return following - np.arange(n)


def _tile(p: np.ndarray, t: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """tile() of word numbers; -1 in t is a word that p doesn't have.

    In each round the greatest length at which a free window of p has the hash of one of t is found by halving; all matches of that length are marked in order, and what is left is shorter.
    A round takes time linear in both but for logarithms, whatever repeats in them, and there are no more rounds than different lengths of tiles.
    """
    free_p, free_t = np.ones(len(p), bool), t >= 0
    keep = np.flatnonzero(_room(free_t) >= least)
    if not len(p) or not len(keep):
        return []
    near = np.unique((keep[:, None] + np.arange(least)).ravel())  # places that a match can touch; others only part them
    parts = np.append(np.flatnonzero(np.diff(near) > 1) + 1, len(near))
    order = np.insert(near, parts, -1)
    short = np.where(order >= 0, t[order], -1)
    free_t = order >= 0
    sums_p, sums_t = _rolling(p), _rolling(short)
    tiles: list[tuple[int, int, int]] = []
    most, top = min(len(p), len(short)), max(len(p), len(short))
    while most >= least:
        room_p, room_t = _room(free_p), _room(free_t)

        low, high = least - 1, min(most, int(room_p.max(initial=0)), int(room_t.max(initial=0)))
        while low < high:
            size = (low + high + 1) // 2
            found = np.isin(_windows(sums_t, room_t, size, top)[0], _windows(sums_p, room_p, size, top)[0]).any()
            low, high = (size, high) if found else (low, size - 1)
        if low < least:
            return tiles
        (a, i), (b, j) = _windows(sums_p, room_p, low, top), _windows(sums_t, room_t, low, top)
        hit = np.isin(b, a)
        places: dict[int, list[int]] = {}
        for value, at in zip(b[hit].tolist(), j[hit].tolist(), strict=True):
            places.setdefault(value, []).append(at)
        following = dict.fromkeys(places, 0)
        for value, start in zip(a.tolist(), i.tolist(), strict=True):
            if value not in places or not free_p[start : start + low].all():
                continue
            mine, k = places[value], following[value]
            while k < len(mine) and not free_t[mine[k] : mine[k] + low].all():
                k += 1
            following[value] = k
            if k < len(mine) and (p[start : start + low] == short[mine[k] : mine[k] + low]).all():
                tiles.append((start, int(order[mine[k]]), low))
                free_p[start : start + low] = free_t[mine[k] : mine[k] + low] = False
        most = low - 1
    return tiles


def tile(item: list[str], text: list[str], least: int = LEAST_TILE) -> list[tuple[int, int, int]]:
    """Greedy string tiling (running Karp-Rabin): non-overlapping tiles (item start, text start, length), the longest first, each `least` or longer; of equal ones the first in the item, then in the text.

    Passages of an item that stand in the text in another order are tiles of their own, so their order doesn't matter.
    """
    number = {w: i for i, w in enumerate(dict.fromkeys(item))}
    return _tile(np.array([number[w] for w in item], int), np.array([number.get(w, -1) for w in text], int), least)


def seeds_of(tokens: list[str], seed: int = SEED) -> list[tuple[str, ...]]:
    """All runs of `seed` words; a shorter text is one seed."""
    return list(zip(*(tokens[i:] for i in range(seed)), strict=False)) if len(tokens) >= seed else [tuple(tokens)] if tokens else []


def needed(n: int, coverage: float) -> int:
    """Words of n that must be in tiles."""
    return max(1, int(np.ceil(coverage * n - 1e-9)))


class Index:
    """A benchmark's seeds, for one task's memory. Words are numbered, and a seed is the number that its words' numbers make."""

    def __init__(self, items: list[tuple[int, str]], least: int, coverage: float):
        found = [(i, w) for i, w in ((i, words(text)) for i, text in items) if w]
        self.ids, self.least = [i for i, _ in found], least
        self.vocabulary: dict[str, int] = {}
        self.words = [np.array([self.vocabulary.setdefault(x, len(self.vocabulary)) for x in w], np.int64) for _, w in found]
        self.sizes = np.array([len(w) for w in self.words], int)
        self.need = np.array([needed(n, coverage) for n in self.sizes.tolist()], int)
        self.item_of = np.repeat(np.arange(len(found)), self.sizes)
        starts = np.cumsum(self.sizes) - self.sizes
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in sorted({min(least, x) for x in self.sizes.tolist()}):
            mine = [k for k in range(len(found)) if (self.sizes[k] >= least if n == least else self.sizes[k] == n)]
            codes = np.concatenate([self._codes(self.words[k], n)[0] for k in mine])
            at = np.concatenate([starts[k] + np.arange(self.sizes[k] - n + 1) for k in mine])
            by_code = np.argsort(codes, kind="stable")
            self.by_length[n] = codes[by_code], at[by_code]

    def _codes(self, numbers: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(codes, starts) of the runs of n words that are all in the vocabulary. _small() lets no vocabulary through whose cube is more than a long."""
        size = len(numbers) - n + 1
        if size < 1:
            return np.zeros(0, np.int64), np.zeros(0, int)
        code, known = np.zeros(size, np.int64), np.ones(size, bool)
        for i in range(n):
            code = code * len(self.vocabulary) + numbers[i : i + size]
            known &= numbers[i : i + size] >= 0
        at = np.flatnonzero(known)
        return code[at], at

    def search(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item_id, words, covered words, tiles) of the items of which tiles cover enough. Tiled are those of which enough words lie in seeds that the text has, which no tiling exceeds."""
        tokens = words(text)
        numbers = np.fromiter((self.vocabulary.get(w, -1) for w in tokens), np.int64, len(tokens))
        hit: list[np.ndarray] = []
        for n, (codes, places) in self.by_length.items():
            mine = np.unique(self._codes(numbers, n)[0])
            low, high = np.searchsorted(codes, mine, "left"), np.searchsorted(codes, mine, "right")
            sizes = high - low
            total = int(sizes.sum())
            if not total:
                continue
            at = places[np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)]
            hit.append(np.unique((at[:, None] + np.arange(n)).ravel()))
        if not hit:
            return []
        coverable = np.bincount(self.item_of[np.unique(np.concatenate(hit))], minlength=len(self.ids))
        out = []
        for k in np.flatnonzero(coverable >= self.need).tolist():
            tiles = _tile(self.words[k], numbers, min(self.least, int(self.sizes[k])))
            if (covered := sum(x[2] for x in tiles)) >= self.need[k]:
                out.append((self.ids[k], int(self.sizes[k]), covered, len(tiles)))
        return out


_HITS = "array<struct<item_id:bigint,n_words:int,covered:int,tiles:int>>"


def _search_udf(index: Index):
    @F.pandas_udf(_HITS)
    def search(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("item_id", "n_words", "covered", "tiles"), x, strict=True)) for x in index.search(t if isinstance(t, str) else None)] for t in texts], dtype=object)

    return search


@F.pandas_udf(T.LongType())
def _n_words(texts: pd.Series) -> pd.Series:
    return pd.Series([len(words(t if isinstance(t, str) else None)) for t in texts], dtype="int64")


def _small(benchmark: DataFrame, most: int) -> bool:
    """Whether the benchmark may be sent to every task: by its words as words() has them, and by its bytes."""
    n, size = benchmark.select(_n_words("text").alias("n"), F.octet_length("text").alias("size")).agg(F.sum("n"), F.sum("size")).first()
    return (n or 0) <= min(most, 2_000_000) and (size or 0) <= MOST_BYTES


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.where("item_id is not null and text is not null").select("item_id", F.col("text").alias("item")).distinct()


def _index(benchmark: DataFrame, coverage: float) -> Index:
    rows = _items(benchmark).collect()  # bounded by _small()
    return Index(sorted((r["item_id"], r["item"]) for r in rows), LEAST_TILE, coverage)


def _hash(run: tuple[str, ...]) -> int:
    return xxhash.xxh64_intdigest(" ".join(run).encode("utf-8", "replace"))


def _item_seeds(coverage: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Of each item its seeds, place by place, and how many of its places must stand in a text that tiles cover it from: a tile of n words has n - 2 of them."""
        for batch in batches:
            rows = []
            for key, text in zip(batch["item_key"], batch["item"], strict=True):
                tokens = words(text)
                seeds = seeds_of(tokens)
                least = -(-needed(len(tokens), coverage) // LEAST_TILE) if len(tokens) >= SEED else 1
                rows += [(key, at, np.uint64(_hash(s)).astype(np.int64).item(), len(seeds) - least + 1) for at, s in enumerate(seeds)]
            if rows:
                yield pd.DataFrame(rows, columns=["item_key", "at", "seed", "probes"])

    return run


def _text_seeds(lengths: list[int], bits: np.ndarray, counted: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Distinct seeds of each text that the filter lets through, with its key; with counted, in how many texts of a batch each stands."""
        for batch in batches:
            keys, seeds = [], []
            for key, text in zip(batch["key"], batch["text"], strict=True):
                tokens = words(text)
                found = {s for n in lengths for s in zip(*(tokens[i:] for i in range(n)), strict=False)}
                mine = np.fromiter(map(_hash, found), np.uint64, len(found))
                mine = mine[(bits[(mine % np.uint64(FILTER_BITS)) >> np.uint64(3)] >> (mine & np.uint64(7)).astype(np.uint8)) & 1 > 0]
                seeds.append(mine.view(np.int64))
                keys += [key] * (0 if counted else len(mine))
            flat = np.concatenate(seeds) if seeds else np.zeros(0, np.int64)
            if counted:
                flat, n = np.unique(flat, return_counts=True)
                yield pd.DataFrame({"seed": flat, "n": n.astype("int64")})
            elif len(flat):
                yield pd.DataFrame({"key": keys, "seed": flat})

    return run


def _filter(seeds: DataFrame) -> np.ndarray:
    """The seeds' bits of FILTER_BITS, gathered as words of 64 bits that have any: 16 MB at most come to the driver."""
    place = F.pmod("seed", F.lit(FILTER_BITS))
    rows = seeds.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(seed, {FILTER_BITS}) & 63 as int))")).alias("bits")).toPandas()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return out.view(np.uint8)


@F.pandas_udf(T.StructType([T.StructField(c, T.IntegerType()) for c in ("n_words", "covered", "tiles")]))
def _tile_udf(items: pd.Series, texts: pd.Series) -> pd.DataFrame:
    out = []
    for a, b in zip(items, texts, strict=True):
        a = words(a)
        found = tile(a, words(b), min(LEAST_TILE, max(1, len(a))))
        out.append((len(a), sum(x[2] for x in found), len(found)))
    return pd.DataFrame(out, columns=["n_words", "covered", "tiles"]).astype("int32")


def _by_shuffle(docs: DataFrame, benchmark: DataFrame, coverage: float) -> DataFrame:
    """All pairs of which tiles may cover enough, tiled, for benchmarks of any size: doc_id, key, item_id, n_words, covered, tiles.

    A document is known by its text's md5, key, and an item by its id and its own: so rows without a doc_id, or of the same one, are as any other.
    An item's seeds are ordered by the number of documents that have them. If so many of its places must be shared, one of the rest and one more is: those that fewest
    documents have are joined, and seeds that very many documents and items share are left out wherever an item has enough others. Documents' seeds pass a filter of
    the items' before they are counted, and of the joined ones' before they are shuffled.
    """
    items = cut(_items(benchmark).withColumn("item_key", F.md5("item")))
    places = cut(items.select("item_key", "item").distinct().mapInPandas(_item_seeds(coverage), "item_key string, at int, seed long, probes int"))
    texts = docs.select("doc_id", "text").where("text is not null").withColumn("key", F.md5("text"))
    lengths = sorted(r[0] for r in items.select(F.least(F.lit(SEED).cast("long"), _n_words("item")).alias("n")).distinct().collect() if r[0])  # SEED numbers at most
    if not lengths:
        lengths = [SEED]
    counts = texts.select("key", "text").mapInPandas(_text_seeds(lengths, _filter(places), True), "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n"))
    # A row for each place of an item's text: items are single texts, so a window over one is as long as a text.
    rare = Window.partitionBy("item_key").orderBy(F.col("n"), F.col("at"))
    probes = cut(places.join(counts, "seed").withColumn("rank", F.row_number().over(rare)).join(places.groupBy("item_key").agg(F.count("*").alias("size")), "item_key"))
    # Places that no document has come first of all, though they need no join.
    absent = F.col("size") - F.count("*").over(Window.partitionBy("item_key"))
    probes = cut(probes.withColumn("absent", absent).where(F.col("rank") + F.col("absent") <= F.col("probes")).select("item_key", "seed").distinct())
    left = texts.select("key", "text").mapInPandas(_text_seeds(lengths, _filter(probes), False), "key string, seed long")
    pairs = left.join(probes, "seed").select("key", "item_key").distinct()
    both = pairs.join(items, "item_key").join(texts, "key")
    return both.select("doc_id", "key", "item_id", _tile_udf(F.col("item"), F.col("text")).alias("x")).select("doc_id", "key", "item_id", "x.*")


def contamination(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, most_words: int = MOST_WORDS) -> DataFrame:
    """Leaks: a row for each row of docs and item of which `coverage` (over 0) or more of the words lie in tiles: doc_id, item_id, n_words, covered, tiles, coverage.

    Words are runs of letters, digits and _, lower-cased. Tiles have LEAST_TILE words or more (of an item of fewer words: the whole item). No pair that the tiles cover so far is left out: a
    pair is tiled if enough of the item's words lie in runs of LEAST_TILE words that the text has too. Null and empty texts on
    either side never match. Repeated rows of docs give their rows each, and those without a doc_id too; of the benchmark, repeated rows count once, and different texts of
    one item_id are items of their own. Empty tables give no rows. Other columns play no part. Beyond most_words, or MOST_BYTES, seeds are joined by shuffling and not sent to every task;
    the rows are the same.
    """
    if _small(benchmark, most_words):
        index = _index(benchmark, coverage)
        found = docs.select("doc_id", F.explode(_search_udf(index)(F.col("text"))).alias("x")).select("doc_id", "x.*")
    else:
        found = _by_shuffle(docs, benchmark, coverage)
    return found.select("doc_id", "item_id", "n_words", "covered", "tiles", (F.col("covered") / F.col("n_words")).alias("coverage")).where(F.col("coverage") >= coverage)


def decontaminate(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, most_words: int = MOST_WORDS) -> DataFrame:
    """docs without the documents that contamination() finds; columns stay as they are, and so do documents with null text. Each row goes or stays by its own text."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if _small(benchmark, most_words):
        hits = _search_udf(_index(benchmark, coverage))(F.col("text"))
        return docs.withColumn("__hits", hits).where(F.size("__hits") == 0).select(*columns)
    gone = _by_shuffle(docs, benchmark, coverage).where(F.col("covered") / F.col("n_words") >= coverage).select(F.col("key").alias("__gone")).distinct()
    return docs.join(gone, F.md5(docs["text"]) == gone["__gone"], "left_anti").select(*columns)
