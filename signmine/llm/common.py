"""What the operators of this subpackage share: tables, lineage cuts, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signmine.sources.files import cut, drop, shared_dir

__all__ = ["WORD", "components", "cut", "drop", "id_text", "shared_dir", "table"]

#: A word, as the contracts have it: a maximal run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(doc_id: str) -> Column:
    return F.coalesce(F.col(doc_id).cast("string"), F.lit(""))


def _summary(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of edges (a, b), of any one orderable type: a row (node, root) for each node that has an edge to another node; root is the component's least node.

    Alternates the large-star and small-star steps, which end in O(log n) rounds. Each takes aggregates and equi-joins only, and each
    round's edges are written to the shared folder, and those before deleted. A node with very many neighbours meets them in the join on its one minimum,
    whose large partitions adaptive execution splits. Null ends and loops are left out.
    """
    edges = cut(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .distinct()
    )
    state = _summary(edges)
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = joined.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        before, edges = edges, cut(small)
        drop(before)  # a round's edges are there as long as the next are made
        new = _summary(edges)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError("components() did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
