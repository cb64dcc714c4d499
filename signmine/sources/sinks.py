"""Sinks: the crop store, loose files, summaries."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signmine.operators.stats import CROP_COUNTERS, FILTER_COUNTERS
from signmine.sources import files


class CropStore:
    """An ordered store of crops as Parquet, a folder for each batch: writing a batch again replaces it, so a retried batch leaves no duplicates.

    Rows are (key, seq, shard, row, c, jpeg ...); seq counts from 1 without gaps, so the number of crops is the number of rows, which Parquet's footers know.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def size(self, before_batch: int | None = None) -> int:
        """Crops in the store; with before_batch those of earlier batches only, so that a batch that is written again gets the numbers it had."""
        if not files.names(self.spark, self.path):
            return 0
        rows = self.read()
        return (rows if before_batch is None else rows.where(F.col("batch") < before_batch)).count()

    def write(self, crops: DataFrame, batch: int) -> int:
        """How many rows it has written."""
        path = f"{self.path}/batch={batch}"
        crops.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(crops.schema).parquet(path).count()

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path)


def write_files(crops: DataFrame, folder: str, name: str = "name", data: str = "jpeg") -> None:
    """A file for each crop in a folder that all executors share, written under another name first, so that none is ever half there. Folders may be URLs of file systems that pyarrow knows."""

    def write(rows) -> None:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), str(Path(folder).absolute()))
        system.create_dir(root, recursive=True)
        for row in rows:
            part = f"{root}/.{row[name]}.part"
            with system.open_output_stream(part) as out:
                out.write(bytes(row[data]))
            system.move(part, f"{root}/{row[name]}.jpg")

    crops.select(name, data).foreachPartition(write)


def read_json(spark: SparkSession, path: str) -> dict:
    """A file that isn't there or can't be read counts as empty."""
    try:
        found = json.loads(files.read_text(spark, path) or "{}")
    except ValueError:
        return {}
    return found if isinstance(found, dict) else {}


def add_run(spark: SparkSession, path: str, record: dict) -> dict:
    """Appends a run to the summary file and renews its sums; a file that isn't there or can't be read counts as empty, and one of a single run is taken over as the first."""
    before = read_json(spark, path)
    runs = list(before.get("runs", [before] if before else []))
    runs.append(record)
    total = {"total_wall_seconds": round(sum(r.get("total_wall_seconds") or 0 for r in runs), 1)}
    for step, counters in (("crop", CROP_COUNTERS), ("filter", FILTER_COUNTERS)):
        parts = [(r.get("steps") or {}).get(step) or {} for r in runs]
        total[step] = {c: sum(p.get(c) or 0 for p in parts) for c in counters}
    last = (record.get("steps") or {}).get("crop") or {}
    total["crop"] |= {"target_crops": last.get("target_crops", 0), "target_crops_total": last.get("target_crops_total", 0), "target_crops_met": last.get("target_crops_met", False)}
    out = {"dataset": record.get("dataset"), "total_runs": len(runs), "cumulative": total, "runs": runs}
    files.write(spark, path, json.dumps(out, indent=2))
    return out
