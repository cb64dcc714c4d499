"""The caption filter: an index of matching rows by shard, its manifest and its summary."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signmine.functions.captions import QUOTED_RE, WORD_RE, speaks_of_text

#: Part of the manifest, so that an index made by another predicate isn't taken for current.
PREDICATE = hashlib.md5(f"{WORD_RE}\n{QUOTED_RE}".encode()).hexdigest()

MANIFEST_SCHEMA = "shard string, rows long, matched long, predicate string, made timestamp"


def build_index(rows: DataFrame) -> DataFrame:
    """(shard, row, url) of the rows whose caption speaks of text. Carrying the URL spares the next step a second scan of the captions."""
    return rows.where(speaks_of_text(F.col("re_caption"))).select("shard", "row", "url")


def write_index(index: DataFrame, path: str, mode: str = "overwrite") -> None:
    index.write.mode(mode).partitionBy("shard").parquet(path)


def read_index(spark, path: str) -> DataFrame:
    return spark.read.schema("row long, url string, shard string").option("pathGlobFilter", "*.parquet").parquet(path)


def manifest(rows: DataFrame) -> DataFrame:
    """For each shard how many rows it has and how many match, and by which predicate: (shard, rows, matched, predicate, made)."""
    return rows.groupBy("shard").agg(F.count("*").alias("rows"), F.count_if(speaks_of_text(F.col("re_caption"))).alias("matched")).withColumns({"predicate": F.lit(PREDICATE), "made": F.current_timestamp()})


def counted_manifest(rows: DataFrame, index: DataFrame) -> DataFrame:
    """As manifest(), where the index of rows is written already: rows are counted without any of their columns, and matches from the index, whose shards are its folders."""
    matched = index.groupBy("shard").agg(F.count("*").alias("matched"))
    counted = rows.groupBy("shard").agg(F.count("*").alias("rows")).join(matched, "shard", "left")
    return counted.select("shard", "rows", F.coalesce("matched", F.lit(0)).cast("long").alias("matched"), F.lit(PREDICATE).alias("predicate"), F.current_timestamp().alias("made"))


def latest(manifest: DataFrame) -> DataFrame:
    """The last entry of each shard."""
    return manifest.groupBy("shard").agg(*[F.max_by(c, "made").alias(c) for c in ("rows", "matched", "predicate")], F.max("made").alias("made"))


def summary(manifest: DataFrame, cached: DataFrame | None = None) -> DataFrame:
    """One row: shards, shards_cached, rows, matched, match_rate (null without rows). Cached shards' rows count like fresh ones, so the rate is that of all."""
    flagged = manifest.withColumn("__cached", F.lit(0)) if cached is None else manifest.join(cached.select("shard").distinct().withColumn("__cached", F.lit(1)), "shard", "left")
    return flagged.agg(
        F.count("*").alias("shards"), F.coalesce(F.sum("__cached"), F.lit(0)).cast("long").alias("shards_cached"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("matched"), F.lit(0)).alias("matched"), F.try_divide(F.sum("matched"), F.sum("rows")).alias("match_rate"),
    )


def not_cached(rows: DataFrame, manifest: DataFrame, force: bool = False) -> DataFrame:
    """Rows of shards that have no current entry in the manifest; all with force."""
    return rows if force else rows.join(manifest.where(F.col("predicate") == PREDICATE).select("shard"), "shard", "left_anti")


def indexed_shards(shards: DataFrame, index: DataFrame) -> DataFrame:
    return shards.join(index.select("shard").distinct(), "shard", "left_semi")


def shards_without_index(shards: DataFrame, index: DataFrame) -> DataFrame:
    return shards.join(index.select("shard").distinct(), "shard", "left_anti")
