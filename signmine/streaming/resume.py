"""Resumable runs: work items stream through a step, and each micro-batch is written under its own number.

A batch's progress is committed after it is written and not when its items are handed out: a run that is stopped never passes over unwritten rows, and a batch that is run again replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from signmine.operators.sequence import numbered, up_to, with_keys
from signmine.sources.sinks import CropStore

ITEM_SCHEMA = "row long, url string, shard string"


def by_shard(spark: SparkSession, index_path: str, files_per_batch: int = 1) -> DataFrame:
    """The index as a stream of its files."""
    return spark.readStream.schema(ITEM_SCHEMA).option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", "*.parquet").parquet(index_path).select("shard", "row", "url")


def by_row(spark: SparkSession, index_path: str, rows_per_batch: int) -> DataFrame:
    """The index as a stream that stops and goes on at any row."""
    from signmine.sources.row_stream import IndexStream

    spark.dataSource.register(IndexStream)
    return spark.readStream.format("signmine_index").option("path", index_path).option("rows_per_batch", str(rows_per_batch)).load()


class Stop(Exception):
    """Raised in a batch to end a run before the batch is committed."""


def run(items: DataFrame, step: Callable[[DataFrame], DataFrame], store: CropStore, checkpoint: str, target: int = 0, zero_batches: int = 3) -> dict:
    """Sends items through step (which gives rows with shard, row, c) into the store, until the items end, the store holds `target` crops (0: no target), or
    `zero_batches` batches in a row give nothing. Numbers go on from what the store holds. What it did: {batches, crops, met, stopped}."""
    seen = {"batches": 0, "crops": 0, "zeros": 0, "stopped": "", "base": None}

    def write(batch: DataFrame, number: int) -> None:
        if seen["stopped"]:
            raise Stop(seen["stopped"])
        if seen["base"] is None:  # footers of the earlier batches are read once in a run
            seen["base"] = store.size(before_batch=number)
        base = seen["base"]
        if target and base >= target:
            seen["stopped"] = "target"
            raise Stop("target")
        rows = with_keys(up_to(numbered(step(batch), ["shard", "row", "c"], base), target))
        made = store.write(rows, number)
        seen["base"] = base + made
        seen["batches"] += 1
        seen["crops"] += made
        seen["zeros"] = 0 if made else seen["zeros"] + 1
        if seen["zeros"] >= zero_batches:
            seen["stopped"] = "nothing came"

    query = items.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    except Exception:
        if not seen["stopped"]:
            raise
    total = store.size()
    return {"batches": seen["batches"], "crops": seen["crops"], "total": total, "met": not target or total >= target, "stopped": seen["stopped"]}
