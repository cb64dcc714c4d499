"""Operator 10: SimHash near-duplicates, joined by the generalised pigeonhole principle."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from itertools import combinations
from math import acos, comb, log2, pi

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signmine.llm.common import components, cut

BITS, DISTANCE, SHINGLE = 64, 3, 3
#: Partitions of the fingerprint's bits that are tried.
PARTS = (2, 3, 4)
#: A bucket with more distinct fingerprints is dealt out by four further groups of bits.
HOT_BUCKET = 20_000
#: Within a task, buckets up to this size are compared all at once, larger ones after further splits.
SMALL, DENSE = 48, 1500
#: Cost of sending one probe row, against that of comparing one pair.
PROBE_COST = 20.0

#: Bits of a signature, which is a fingerprint of several words; a bucket of signatures has so many, about; a larger one than HOT_BUCKET is dealt out by pairs of parts.
WIDE, WIDE_BUCKET = 256, 1024
#: Chance that a pair of the least similarity shares a group, and that it lies within the distance.
WIDE_RECALL, WITHIN = 0.999, 0.9995

_draw = np.random.default_rng(31)
_LANES = _draw.integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _draw.integers(0, 1 << 63, 16, dtype=np.uint64)

_hash = partial(xxhash.xxh64_intdigest, seed=42)
_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_WEIGHTS = np.uint64(1) << np.arange(BITS, dtype=np.uint64)


def fingerprint(text: str | None) -> int:
    """Unsigned. Only ASCII letters are lower-cased and only ASCII white space parts words, as bytes.lower() and bytes.split() do."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False)) if len(words) >= SHINGLE else [b" ".join(words)]
    n = max(1, len(words) - SHINGLE + 1)
    octets = np.fromiter(map(_hash, shingles), np.uint64, n).view(np.uint8).reshape(n, 8)
    ones = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BYTE_BITS for i in range(8)])
    return int(_WEIGHTS[2 * ones > n].sum(dtype=np.uint64))


def signature(hashes: np.ndarray) -> np.ndarray:
    """WIDE bits, as uint64, of a set of mixed 64-bit hashes: a bit is 1 if set in over half of them."""
    ones, lanes = np.zeros(WIDE, np.int64), WIDE // BITS
    for at in range(0, len(hashes), 1 << 13):
        x = hashes[at : at + (1 << 13), None] * _LANES[:lanes] + _SHIFTS[:lanes]
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        ones += np.unpackbits(x.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)


@F.pandas_udf(T.LongType())
def fingerprint_udf(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(x if isinstance(x, str) else None) for x in texts], np.uint64).view(np.int64))


def _bit_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    both = np.zeros((BITS, BITS))
    for batch in batches:
        for at in range(0, len(batch), 100_000):
            bits = np.unpackbits(batch["fp"].to_numpy(np.int64)[at : at + 100_000].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            both += bits.T @ bits
    i, j = np.indices(both.shape)
    yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "n": both.ravel()})


def group_bits(both: np.ndarray, total: int, parts: int) -> list[list[int]]:
    """Bits in `parts` groups of about the same size, correlated ones together: each group takes, time and again, the bit most correlated with it."""
    mean = both.diagonal() / max(total, 1)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
    close = np.abs(both / max(total, 1) - np.outer(mean, mean)) / np.outer(spread, spread)
    left, groups = set(range(BITS)), []
    for g in range(parts):
        size = len(left) // (parts - g)
        rest = sorted(left)
        group = [max(rest, key=lambda b: (close[b, rest].sum() - close[b, b], -b))]
        while len(group) < size:
            rest = sorted(left - set(group))
            group.append(max(rest, key=lambda b: (close[b, group].sum(), -b)))
        left -= set(group)
        groups.append(sorted(group))
    return groups


def allocate(costs: np.ndarray, budget: int) -> tuple[float, list[int]]:
    """Thresholds of least total cost that sum to the budget. costs[i, t + 1] is that of threshold t of partition i, t from -1 (not probed).

    Dynamic programming over partitions and what is left of the budget.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        new: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t, more in enumerate(row, -1):
                if (spent + t not in new) or cost + more < new[spent + t][0]:
                    new[spent + t] = (cost + more, [*chosen, t])
        best = new
    return best[budget]


def plan(fps: DataFrame, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """Groups of bits with a threshold each, for fps of one column fp without repeats. Two fingerprints within `distance` are, in one group at least,
    within its threshold: the thresholds sum to distance - groups + 1.

    Bit counts and colliding pairs are counted over all fingerprints; what comes to the driver are 64 x 64 counts and nine numbers.
    """
    total = fps.count()
    both = np.zeros((BITS, BITS))
    for i, j, n in fps.mapInPandas(_bit_counts, "i int, j int, n double").groupBy("i", "j").agg(F.sum("n")).collect():
        both[i, j] = n
    mean = both.diagonal() / max(total, 1)
    differ = 2 * mean * (1 - mean)
    choices = {m: group_bits(both, total, m) for m in PARTS}
    tried = [(m, g) for m in PARTS for g in range(m)]
    keys = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(mask(choices[m][g]))).alias("v")) for k, (m, g) in enumerate(tried)]))
    sizes = fps.select(keys.alias("x")).groupBy("x.k", "x.v").agg(F.count("*").alias("n"))
    pairs = dict(sizes.groupBy("k").agg(F.sum(F.col("n").cast("double") * (F.col("n") - 1) / 2)).collect())
    found = []
    for m in PARTS:
        costs = np.full((m, distance + 2), np.inf)
        for g in range(m):
            p = differ[choices[m][g]]
            odds = np.ones(1)
            for x in p:  # chances of 0, 1, ... differing bits, against those of none
                odds = np.convolve(odds, [1.0, x / max(1 - x, 1e-9)])
            base = pairs.get(tried.index((m, g)), 0.0)
            costs[g, 0] = 0.0
            for t in range(distance + 1):
                probes = sum(len(list(combinations(range(len(p)), e))) if e < 3 else len(p) ** 3 / 6 for e in range(t + 1))
                costs[g, t + 1] = PROBE_COST * total * probes + 2 * base * odds[: t + 1].sum()
        cost, thresholds = allocate(costs, distance - m + 1)
        found.append((cost, [(bits, t) for bits, t in zip(choices[m], thresholds, strict=True) if t >= 0]))
    return min(found, key=lambda x: x[0])[1]


def mask(bits: list[int]) -> int:
    return int(np.array([sum(1 << b for b in bits)], np.uint64).view(np.int64)[0])


class Forest:
    """Disjoint sets; join() tells whether two were apart."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (parent := up.setdefault(x, x)) != x:
            up[x] = x = up[parent]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _within(found: np.ndarray, forest: Forest, free: list[int], distance: int, out: list[tuple[int, int]]) -> None:
    """Adds to out links that join all of found (distinct, uint64) that are within distance. free: bits in which they may differ."""
    n = len(found)
    if n < 2:
        return
    if n <= DENSE or len(free) < 8:
        for at in range(0, n, 1024):
            a, b = np.nonzero(np.bitwise_count(found[at : at + 1024, None] ^ found[None, :]) <= distance)
            for x, y in zip(found[a + at].tolist(), found[b].tolist(), strict=True):
                if x < y and forest.join(x, y):
                    out.append((x, y))
        return
    for g in range(distance + 1):  # plain pigeonhole on the bits that are free
        mine = free[g :: distance + 1]
        key = found & np.uint64(sum(1 << b for b in mine))
        order = np.argsort(key, kind="stable")
        edges = np.flatnonzero(np.diff(key[order])) + 1
        for part in np.split(order, edges):
            if len(part) > 1:
                _within(found[part], forest, [b for b in free if b not in mine], distance, out)


def _compare(distance: int, groups: list[list[int]]):
    """Links among rows that come sorted by (k, v, sub): of each bucket, a forest that has the components of all its links."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list[pd.DataFrame] = []  # of the bucket that the last batch ended in, put together once it has ended

        def links(rows: pd.DataFrame) -> pd.DataFrame:
            fp = rows["fp"].to_numpy(np.int64).view(np.uint64)
            new = np.ones(len(rows), bool)
            new[1:] = (rows[["k", "v", "sub", "sv"]].to_numpy()[1:] != rows[["k", "v", "sub", "sv"]].to_numpy()[:-1]).any(axis=1)
            bucket = np.cumsum(new) - 1
            starts = np.flatnonzero(new)
            sizes = np.diff(np.append(starts, len(rows)))
            forest, out = Forest(), []
            small = sizes[bucket] <= SMALL
            for step in range(1, min(SMALL, len(rows))):
                a = np.flatnonzero((bucket[step:] == bucket[:-step]) & small[step:])
                if not len(a):
                    break
                a = a[np.bitwise_count(fp[a] ^ fp[a + step]) <= distance]
                for x, y in zip(fp[a].tolist(), fp[a + step].tolist(), strict=True):
                    if x != y and forest.join(x, y):
                        out.append((x, y))
            for b in np.flatnonzero(sizes > SMALL):
                at = slice(starts[b], starts[b] + sizes[b])
                k, sub = int(rows["k"].iloc[starts[b]]), int(rows["sub"].iloc[starts[b]])
                fixed = set(groups[k]) if sub < 0 else set(groups[k]) | set(free_bits(groups[k], sub))
                free = [x for x in range(BITS) if x not in fixed] if rows["exact"].iloc[at].all() else list(range(BITS))
                _within(np.unique(fp[at]), forest, free, distance, out)
            flat = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
            return pd.DataFrame({"a": flat[:, 0], "b": flat[:, 1]})

        bucket = ["k", "v", "sub", "sv"]
        for batch in batches:
            if not len(batch):
                continue
            same = (batch[bucket] == batch[bucket].iloc[-1]).all(axis=1).to_numpy()
            goes_on = bool(rest) and bool((rest[0][bucket].iloc[-1] == batch[bucket].iloc[-1]).all())
            if goes_on and same.all():
                rest.append(batch)
                continue
            yield links(pd.concat([*rest, batch[~same]], ignore_index=True))
            rest = [batch[same]]
        if rest:
            yield links(pd.concat(rest, ignore_index=True))

    return run


def free_bits(bits: list[int], sub: int) -> list[int]:
    """Of the bits that are not in a group, every fourth from `sub`."""
    return [b for b in range(BITS) if b not in bits][sub :: DISTANCE + 1]


def near_links(fps: DataFrame, distance: int = DISTANCE, hot: int = HOT_BUCKET) -> DataFrame:
    """Links (a, b) that have the same components as all pairs of fps (a column fp without repeats) within distance.

    Each fingerprint goes to the bucket of its value in each group of bits and, as a probe, to those of values within the group's threshold.
    A bucket gives no more links than it has rows, whatever the number of its pairs. Buckets with more than `hot` members are
    dealt out again by four further groups of bits, of which a pair within distance must agree in one.
    """
    chosen = plan(fps, distance)
    groups = [bits for bits, _ in chosen]

    def probes(k: int) -> Column:
        bits, threshold = chosen[k]
        flips = [0, *(mask(list(c)) for e in range(1, threshold + 1) for c in combinations(bits, e))]
        own = F.col("fp").bitwiseAND(F.lit(mask(bits)))
        if len(flips) == 1:
            return F.array(F.struct(F.lit(k).alias("k"), own.alias("v"), F.lit(True).alias("exact")))
        return F.transform(F.array(*map(F.lit, flips)), lambda x: F.struct(F.lit(k).alias("k"), own.bitwiseXOR(x).alias("v"), (x == 0).alias("exact")))

    rows = fps.select("fp", F.explode(F.concat(*map(probes, range(len(chosen))))).alias("x")).select("fp", "x.*")
    large = cut(rows.groupBy("k", "v").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("k", "v", F.lit(True).alias("hot")))
    if large.isEmpty():
        dealt = rows.withColumns({"sub": F.lit(-1), "sv": F.lit(0).cast("long")})
    else:
        subs = F.lit(None)
        for k, bits in enumerate(groups):
            own = [F.struct(F.lit(s).alias("sub"), F.col("fp").bitwiseAND(F.lit(mask(free_bits(bits, s)))).alias("sv")) for s in range(DISTANCE + 1)]
            subs = F.when((F.col("k") == k) & F.col("hot") & F.lit(chosen[k][1] == 0), F.array(*own)).otherwise(subs) if k else F.when((F.col("k") == k) & F.col("hot") & F.lit(chosen[k][1] == 0), F.array(*own))
        plain = F.array(F.struct(F.lit(-1).alias("sub"), F.lit(0).cast("long").alias("sv")))
        dealt = rows.join(large, ["k", "v"], "left").withColumn("s", F.explode(F.coalesce(subs, plain))).select("fp", "k", "v", "exact", "s.sub", "s.sv")
    dealt = dealt.repartition("k", "v", "sub", "sv").sortWithinPartitions("k", "v", "sub", "sv", "fp")
    return dealt.select("fp", "k", "v", "sub", "sv", "exact").mapInPandas(_compare(distance, groups), "a long, b long")


def wide_plan(total: int, similarity: float, recall: float = WIDE_RECALL) -> tuple[int, list[list[int]]]:
    """For `total` signatures of sets: the greatest distance that is taken as near, and groups of bits of which near ones share one.

    A Jaccard similarity J of sets of one size is a cosine of 2 J / (1 + J), and a bit differs with the chance of its angle over pi. 64 bits or more that far apart are beyond the pigeonhole of any
    few groups; but m groups of threshold 0, whose sum is that of the generalised pigeonhole for m - 1 differing bits, have one in common far more often than it warrants: as many are taken as reach `recall` at
    that similarity, and buckets hold about WIDE_BUCKET. Groups go through all bits in one order, and in further ones where there are more.
    """
    differ = acos(2 * similarity / (1 + similarity)) / pi
    chances = np.array([comb(WIDE, d) * differ**d * (1 - differ) ** (WIDE - d) for d in range(WIDE + 1)])
    distance = int(np.searchsorted(chances.cumsum(), WITHIN))
    size = max(4, round(log2(max(total, 2) / WIDE_BUCKET) + 0.5))
    apart = 1 - (1 - differ) ** size
    n = int(np.ceil(np.log(1 - recall) / np.log(apart)))
    if n * size > WIDE:  # bits recur: chances given the number of differing bits
        shared = np.maximum(0.0, np.prod([(WIDE - np.arange(WIDE + 1) - i) / (WIDE - i) for i in range(size)], axis=0))
        shared[WIDE - size + 1 :] = 0.0
        while chances @ (1 - shared) ** n > 1 - recall:
            n += 1
    draw, groups = np.random.default_rng(37), []
    while len(groups) < n:
        order = draw.permutation(WIDE)
        groups += [sorted(order[at : at + size].tolist()) for at in range(0, WIDE - size + 1, size)]
    return distance, groups[:n]


def _forest(lanes: list[np.ndarray], distance: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links (places) that join what all pairs of signatures within distance join: what is in a component already is compared with the rest only."""
    n = len(lanes[0])
    differing = lambda a, b: sum(np.bitwise_count(x[a][:, None] ^ x[b][None, :]).astype(np.uint16) for x in lanes)
    left, out, known = np.arange(n), [], None
    if n <= 2048:
        rows = [differing(np.arange(at, min(at + 256, n)), left) <= distance for at in range(0, n, 256)]
        known = np.concatenate(rows)
        left = np.flatnonzero(known.sum(axis=1) > 1)
    while len(left) > 1:
        frontier, left = left[:1], left[1:]
        while len(frontier) and len(left):
            now, frontier = frontier[:64], frontier[64:]
            hit = known[np.ix_(now, left)] if known is not None else differing(now, left) <= distance
            found = hit.any(axis=0)
            if found.any():
                new = left[found]
                out.append((now[hit[:, found].argmax(axis=0)], new))
                left, frontier = left[~found], np.concatenate([frontier, new])
    return out


def _compare_wide(distance: int, columns: list[str]):
    """Links among rows that come sorted by (key, tile)."""

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        key, tile, node = (rows[c].to_numpy(np.int64) for c in ("key", "tile", "node"))
        lanes = [rows[c].to_numpy(np.int64).view(np.uint64) for c in columns]
        edges = np.flatnonzero((key[1:] != key[:-1]) | (tile[1:] != tile[:-1])) + 1
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(rows)], strict=True):
            if end - start > 1:
                mine = node[start:end]
                for x, y in _forest([lane[start:end] for lane in lanes], distance):
                    a.append(mine[x])
                    b.append(mine[y])
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list[pd.DataFrame] = []  # of the bucket that the last batch ended in
        for batch in batches:
            if not len(batch):
                continue
            last = batch[["key", "tile"]].iloc[-1]
            same = ((batch["key"] == last["key"]) & (batch["tile"] == last["tile"])).to_numpy()
            if rest and same.all() and (rest[0][["key", "tile"]].iloc[-1] == last).all():
                rest.append(batch)
                continue
            if rest or not same.all():
                yield links(pd.concat([*rest, batch[~same]], ignore_index=True))
            rest = [batch[same]]
        if rest:
            yield links(pd.concat(rest, ignore_index=True))

    return run


def wide_links(signatures: DataFrame, similarity: float, hot: int = HOT_BUCKET) -> DataFrame:
    """Links (a, b) of signatures (node, f0, f1, ...: WIDE bits) that join those that share a group of bits and lie within the distance of wide_plan(): nearly all pairs of sets of
    that Jaccard similarity, and some of less. For candidates, whose sets are compared then.

    Each signature goes to a bucket in each group. A bucket gives fewer links than it has rows. One of more than `hot` rows is dealt out in parts, and each pair of parts compared by itself.
    """
    columns = [f"f{i}" for i in range(WIDE // BITS)]
    distance, groups = wide_plan(signatures.count(), similarity)

    def named(g: int) -> Column:
        masks = [mask([b - BITS * i for b in groups[g] if b // BITS == i]) for i in range(len(columns))]
        return F.xxhash64(F.lit(g), *[F.col(c).bitwiseAND(F.lit(m)) for c, m in zip(columns, masks, strict=True)])

    rows = signatures.select("node", *columns, F.explode(F.array(*map(named, range(len(groups))))).alias("key"))
    large = cut(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("key", F.ceil(F.col("n") / hot).alias("parts")))
    if large.isEmpty():
        dealt = rows.withColumn("tile", F.lit(0).cast("long"))
    else:
        mine = F.pmod(F.xxhash64("node"), F.col("parts"))
        tiles = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda other: F.least(mine, other) * F.col("parts") + F.greatest(mine, other))
        dealt = rows.join(large, "key", "left").withColumn("tile", F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0).cast("long"))).otherwise(tiles))).drop("parts")
    dealt = dealt.select("key", "tile", "node", *columns).repartition("key", "tile").sortWithinPartitions("key", "tile")
    return dealt.mapInPandas(_compare_wide(distance, columns), "a long, b long")


def near_duplicates(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """A row for each row of docs: doc_id, fp (the fingerprint, as a signed long), root (of its component, a fingerprint too), component_id.

    component_id is the least doc_id of the fingerprint's component: rows with the same fingerprint are linked, and fingerprints that differ in
    `distance` bits or fewer. Null text, empty text and white space have fingerprint 0 and are linked like any other. A null doc_id is never least; a
    component without any doc_id has a null component_id. Repeated rows each give a row. An empty table gives no rows. Other columns play no part.
    """
    rows = cut(docs.select("doc_id", fingerprint_udf(F.col("text")).alias("fp")))
    # Copies meet here, before anything is compared: from now on each fingerprint stands once.
    distinct = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(near_links(distinct.select("fp"), distance))
    named = distinct.join(found, distinct["fp"] == found["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of = named.join(least, "root").select("fp", "root", "component_id")
    return rows.join(of, "fp").select("doc_id", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """docs without near-duplicates: of each component of near_duplicates() the document of the least doc_id stays; columns stay as they are.

    Where several rows have that doc_id, or a component has no doc_id at all, one of its rows stays.
    """
    return keep_one(docs, near_duplicates(docs, distance), fingerprint_udf)


def keep_one(docs: DataFrame, found: DataFrame, name: Callable[[Column], Column]) -> DataFrame:
    """Of each component of found, which has the columns of near_duplicates(), one row of docs; name(text) is found's fp."""
    found = cut(found)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows, ids = found.agg(F.count("*"), F.countDistinct("doc_id")).first()
    if rows == ids:
        kept = found.where("doc_id = component_id").select(F.col("doc_id").alias("__id"))
        return docs.join(kept, docs["doc_id"] == kept["__id"], "left_semi").select(*columns)
    # Repeated or missing ids don't name a row: rows are told apart by the components of what name(text) gives.
    of = found.select(F.col("fp").alias("__fp"), F.col("root").alias("__root"), F.col("component_id").alias("__component")).distinct()
    named = docs.withColumn("__fp", name(F.col("text"))).join(of, "__fp")
    return named.where(F.col("doc_id").eqNullSafe(F.col("__component"))).dropDuplicates(["__root"]).select(*columns)
