"""Run statistics: fetches, phases, throughput, and sums over runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Counters that are summed over runs, and those of which the last run's value holds.
CROP_COUNTERS = (
    "urls_tried", "urls_decoded", "decoded_not_processed", "gpu_imgs", "crops", "target_crops_written", "batches", "fetch_sum", "gpu_sum", "crop_sum", "write_sum", "parquet_sum",
    "fetch_wall", "gpu_wall", "crop_wall", "write_wall", "parquet_wall", "pipeline_wall", "wall",
)
FILTER_COUNTERS = ("wall", "scan_wall", "rows", "matched")
SNAPSHOTS = ("target_crops", "target_crops_total", "target_crops_met")


def _per(total: Column, n: Column, scale: float = 1.0) -> Column:
    return F.coalesce(F.try_divide(total * scale, n), F.lit(0.0))


def fetch_stats(log: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Of fetches (ok, seconds): tried, decoded, ok_rate, and average milliseconds of all, of good and of failed ones (0 where there are none)."""
    seconds = F.col("seconds")
    good, bad = F.sum(F.when(F.col("ok"), seconds)), F.sum(F.when(~F.col("ok"), seconds))
    n_ok, n_bad = F.count_if(F.col("ok")), F.count_if(~F.col("ok"))
    made = [F.count("*").alias("tried"), n_ok.alias("decoded"), _per(n_ok.cast("double"), F.count("*")).alias("ok_rate"), _per(F.sum(seconds), F.count("*"), 1000.0).alias("avg_ms"), _per(good, n_ok, 1000.0).alias("avg_ok_ms"), _per(bad, n_bad, 1000.0).alias("avg_fail_ms")]
    return (log.groupBy(*by) if by else log.groupBy()).agg(*made)


def phase_envelopes(log: DataFrame) -> DataFrame:
    """Of spans (phase, start, end in seconds): first, last, wall = last - first, and busy, the sum of the spans."""
    return log.groupBy("phase").agg(F.min("start").alias("first"), F.max("end").alias("last"), F.coalesce(F.max("end") - F.min("start"), F.lit(0.0)).alias("wall"), F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0.0)).alias("busy"))


def throughput(envelopes: DataFrame, images: int, workers: int) -> DataFrame:
    """For each phase: utilisation of its workers while it ran, seconds an image, images a second at full use."""
    wall, cost = F.greatest(F.col("wall") * workers, F.lit(1e-9)), F.col("busy") / max(images, 1)
    return envelopes.select("phase", (F.col("busy") / wall).alias("util"), cost.alias("seconds_an_image"), (F.lit(float(workers)) / F.greatest(cost, F.lit(1e-9))).alias("images_a_second"))


def bottleneck(fetch_wall: Column, detect_wall: Column) -> Column:
    return F.when(fetch_wall >= detect_wall - 1, F.lit("fetch")).otherwise(F.lit("gpu"))


def cumulative(runs: DataFrame, summed: tuple[str, ...], latest: tuple[str, ...] = (), order: str = "run_no") -> DataFrame:
    """One row over all runs: sums of counters (missing ones count 0), and the last run's snapshots."""
    return runs.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in summed], *[F.max_by(c, order).alias(c) for c in latest])


def crop_outcome(totals: DataFrame, target_crops: int, target_images: int) -> DataFrame:
    """totals (crops_total, crops, images) with crops_per_image, target_met and target_missed: missed only if the stop wasn't the image target's."""
    met = F.lit(target_crops <= 0) | (F.col("crops_total") >= target_crops)
    stopped = F.lit(target_images > 0) & (F.col("images") >= target_images)
    return totals.withColumns({"crops_per_image": F.col("crops") / F.greatest(F.col("images"), F.lit(1)), "target_met": met, "target_missed": F.lit(target_crops > 0) & ~met & ~stopped})


def zero_streaks(chunks: DataFrame, least: int = 3, order: str = "chunk", made: str = "made", by: list[str] | None = None) -> DataFrame:
    """Runs of `least` or more chunks in a row that made nothing: (by, first, last, length). At the first of them a run stops."""
    by = by or []
    marked = chunks.withColumn("__good", F.sum((F.col(made) > 0).cast("int")).over(Window.partitionBy(*by).orderBy(order)))
    return marked.where(F.col(made) == 0).groupBy(*by, "__good").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("length")).where(F.col("length") >= least).drop("__good")
