"""Caption datasets: sharded Parquet whose rows are known by shard and place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signmine.functions.naming import shard_name

CAPTION_COLUMNS = ("url", "re_caption", "org_caption")


def read(spark: SparkSession, path: str, columns: tuple[str, ...] = CAPTION_COLUMNS, only: list[str] | None = None) -> DataFrame:
    """(shard, row, columns): the shard is the file's name, the row its place in the file, from 0, whatever is filtered or split. Only the named columns are read; with only, of these shards."""
    meta = [shard_name(F.col("_metadata.file_name")).alias("shard"), F.col("_metadata.row_index").alias("row")]
    if only is None:
        return spark.read.option("pathGlobFilter", "*.parquet").parquet(path).select(*meta, *columns)
    if not only:
        return spark.createDataFrame([], ", ".join(["shard string", "row long", *(f"{c} string" for c in columns)]))
    schema = ", ".join(f"{c} string" for c in columns)
    return spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{s}.parquet" for s in only]).select(*meta, *columns)


def readable_shards(spark: SparkSession, path: str) -> list[str]:
    """Names of the files that have a footer and rows, in order; no column is read."""
    return sorted(r["shard"] for r in shards(read_readable(spark, path)).collect())


def read_readable(spark: SparkSession, path: str, columns: tuple[str, ...] = CAPTION_COLUMNS) -> DataFrame:
    """As read(), but files that can't be read are passed over."""
    meta = [shard_name(F.col("_metadata.file_name")).alias("shard"), F.col("_metadata.row_index").alias("row")]
    schema = ", ".join(f"{c} string" for c in columns)
    return spark.read.schema(schema).option("ignoreCorruptFiles", "true").option("pathGlobFilter", "*.parquet").parquet(path).select(*meta, *columns)


def shards(rows: DataFrame) -> DataFrame:
    return rows.select("shard").distinct()


def first_shards(rows: DataFrame, n: int) -> DataFrame:
    """Rows of the first n shards by name; 0: all. The names, n at most, are sent to all tasks."""
    if n <= 0:
        return rows
    first = shards(rows).orderBy("shard").limit(n)
    return rows.join(F.broadcast(first), "shard", "left_semi") if n <= 100_000 else rows.join(first, "shard", "left_semi")


def captions_from_parts(part: DataFrame) -> DataFrame:
    """A caption dataset made from table `part`, for tests and the catalogue: four shards, six kinds of captions, some URLs null or empty."""
    n, name, quote = F.col("p_partkey"), F.col("p_name"), F.lit("'")
    kinds: list[Column] = [
        F.concat(F.lit("A photo of a "), name), F.concat(F.lit('A sign that reads "'), name, F.lit('"')), F.concat(F.lit("A box labeled "), F.col("p_brand")),
        F.concat(F.lit("the shop"), quote, F.lit("s "), name), F.concat(F.lit("A poster "), quote, name, quote, F.lit(" on a wall")), F.concat(F.lit("A contextual view of "), F.col("p_type")),
    ]
    caption = kinds[-1]
    for i, kind in enumerate(kinds[:-1]):
        caption = F.when(n % 6 == i, kind).otherwise(caption)
    url = F.when(n % 17 == 0, F.lit(None)).when(n % 19 == 0, F.lit("")).otherwise(F.concat(F.lit("http://img.example.com/"), n.cast("string"), F.lit(".jpg")))
    return part.select(
        F.concat(F.lit("train-"), F.lpad((n % 4).cast("string"), 5, "0"), F.lit("-of-00004")).alias("shard"), F.floor(n / 4).cast("long").alias("row"),
        url.alias("url"), caption.alias("re_caption"), F.col("p_type").alias("org_caption"),
    )
