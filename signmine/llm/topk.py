"""Operator 3: exact top-k search by inner product, with Fagin's threshold algorithm."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signmine.llm.common import cut

#: Queries held by every task at a time, about. With 64 dimensions a chunk has 2 MB.
QUERY_CHUNK = 4096
#: Sorted access goes so deep at first, and twice as deep in each round.
FIRST_DEPTH = 16


def quantized(vectors: DataFrame, scale: float = 1024.0) -> DataFrame:
    """(vec_id, v, place): floor(scale * x) of each component, as array<long>, and a number of each row. Vectors that are null, hold null or non-finite components, or have no vec_id are left out.

    They are written, so that a row has its number wherever it is read.
    """
    good = F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    most = F.lit(float(2**62))
    whole = lambda x: F.floor(F.greatest(-most, F.least(most, x.cast("double") * scale))).cast("long")  # noqa: E731  beyond that, no product can be told
    return cut(vectors.where(good).select("vec_id", F.transform("embedding", whole).alias("v"), F.monotonically_increasing_id().alias("place")))


class Lists:
    """A block of candidates with, for each dimension, their places in order of the component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, places: np.ndarray | None = None):
        by_id = np.argsort(ids, kind="stable")  # so that place order is id order, and ties go to the smaller id
        self.ids, self.vectors = ids[by_id], vectors[by_id]
        self.places = self.ids if places is None else places[by_id]  # what tells a query's own row
        self.most = np.abs(self.vectors.astype(float)).max(axis=0, initial=0)
        self.up = np.argsort(self.vectors, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(self.vectors, self.up.T, axis=0).T.copy()

    def search(self, query: np.ndarray, own: int, k: int, best: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """best, as (-score, id) in order, with this block's candidates but the query's own row merged in: k at most."""
        if np.abs(query.astype(float)) @ self.most >= 2.0**62:
            raise OverflowError("products of these components don't fit in 64 bits")
        n, used = len(self.ids), np.flatnonzero(query)
        seen, depth, last = np.zeros(n, bool), 0, FIRST_DEPTH
        q, down = query[used], query[used] > 0
        while True:
            last = min(last, n)
            if len(used):  # sorted access: each list from its end of large products
                places = np.where(down[:, None], self.up[used, n - last : n - depth], self.up[used, depth:last])
                new = np.zeros(n, bool)
                new[places.ravel()] = True
                new &= ~seen
            else:  # a zero query has no lists; every candidate has the same score
                new = ~seen
            seen |= new
            at = np.flatnonzero(new)
            at = at[self.places[at] != own]
            if len(at):  # random access: whole scores of what has come up
                scores = self.vectors[at] @ query
                if len(best) == k:
                    better = scores >= -best[-1][0]
                    at, scores = at[better], scores[better]
                if len(at) > k:
                    top = np.lexsort((self.ids[at], -scores))[:k]
                    at, scores = at[top], scores[top]
                best = sorted(best + list(zip((-scores).tolist(), self.ids[at].tolist(), strict=True)))[:k]
            if last == n or not len(used):
                return best
            bound = int(q @ np.where(down, self.sorted[used, n - last], self.sorted[used, last - 1]))
            if len(best) == k and bound < -best[-1][0]:  # on a tie a smaller id may still come
                return best
            depth, last = last, 2 * last


def _search_all(queries: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[int, list[tuple[int, int]]] = {}
        for batch in batches:
            sizes = batch["v"].map(len).to_numpy()
            for size in set(sizes) & set(queries):
                mine = batch[sizes == size]
                block = Lists(mine["vec_id"].to_numpy(np.int64), np.stack(mine["v"].to_numpy()).astype(np.int64).reshape(len(mine), size), mine["place"].to_numpy(np.int64))
                for number, own, query in zip(*queries[size], strict=True):
                    best[number] = block.search(query, own, k, best.get(number, []))
        flat = [(number, i, -s) for number, found in best.items() for s, i in found]
        yield pd.DataFrame(flat, columns=["query", "vec_id", "score"]).astype("int64")

    return run


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 10, chunk: int = QUERY_CHUNK) -> DataFrame:
    """The k highest integer inner products of each query: query_id, rank (from 1), vec_id, score. Ties go to the smaller vec_id.

    Both inputs are as quantized() gives. The candidates stay where they are, in blocks of one Arrow batch with a sorted list for each dimension;
    the queries go round in chunks of bounded size, each against all candidates, and every task hands on k rows for each query. In each block the
    threshold algorithm goes down the lists together, scores what comes up, and stops as soon as the bound (the product with
    the components reached) is under the k-th score so far, also that of earlier blocks.
    Only the query's own row is left out, known by its place: another row of its vec_id is a candidate, and so may several rows of one vec_id be among the results. Those of another
    length are left out; fewer than k candidates give fewer rows. Each query row gives its rows. No queries or no candidates: no rows. Components so large that
    a product might not fit in 64 bits raise an error. Of the queries, no more than a chunk is in the driver: each chunk's result is written before the next.
    """
    spark = candidates.sparkSession
    total = queries.count()
    parts = max(1, -(-total // chunk))
    out = None
    for part in range(parts):
        # No more than a chunk, about, comes to the driver at a time, to be sent to the tasks.
        mine = queries if parts == 1 else queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == part)
        mine = mine.toPandas()
        by_size: dict[int, tuple] = {}
        sizes = mine["v"].map(len)
        for size in sizes.unique():
            rows = mine[sizes == size]
            by_size[int(size)] = (rows.index.to_numpy(np.int64), rows["place"].to_numpy(np.int64), np.stack(rows["v"].to_numpy()).astype(np.int64).reshape(len(rows), size))
        ids = spark.createDataFrame(pd.DataFrame({"query": mine.index.to_numpy(np.int64), "query_id": mine["vec_id"].to_numpy(np.int64)}), "query long, query_id long")
        found = candidates.mapInPandas(_search_all(by_size, k), "query long, vec_id long, score long")
        ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id"))).where(F.col("rank") <= k)
        ranked = ranked.join(F.broadcast(ids), "query").select("query_id", "rank", "vec_id", "score")
        ranked = ranked if parts == 1 else cut(ranked)
        out = ranked if out is None else out.unionByName(ranked)
    return out
