"""A stream over an index that can stop and go on at any row: its offsets are places, so what a batch has not committed is read again."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow.dataset as ds
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader


class IndexStream(DataSource):
    """format("signmine_index"): options path (folder of an index that all executors can read), rows_per_batch, and schema shard, row, url.

    An offset is the number of rows taken, in order of shard, file and place. A batch's rows, rows_per_batch at most, go through the driver; for more
    at a time stream the index's files (signmine.streaming.resume.by_shard), which resumes by shard.
    """

    @classmethod
    def name(cls) -> str:
        return "signmine_index"

    def schema(self) -> str:
        return "shard string, row long, url string"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:  # noqa: N802
        return IndexReader(self.options)


class IndexReader(SimpleDataSourceStreamReader):
    """Rows in order of shard, file and place. The files' row counts come from their footers, once; a batch reads the row groups that it has rows of, and no others."""

    def __init__(self, options: dict):
        self.path, self.size = options["path"], int(options.get("rows_per_batch", 1000))
        self.files: list[tuple[str, ds.ParquetFileFragment, int]] | None = None

    def _files(self) -> list[tuple[str, ds.ParquetFileFragment, int]]:
        """(shard, file, rows), kept while the stream runs: an index is complete before it is streamed."""
        if self.files is None:
            data = ds.dataset(self.path, format="parquet", partitioning="hive", exclude_invalid_files=True)
            found = [(ds.get_partition_keys(f.partition_expression)["shard"], f) for f in data.get_fragments()]
            self.files = [(str(shard), f, f.metadata.num_rows) for shard, f in sorted(found, key=lambda x: (str(x[0]), x[1].path))]
        return self.files

    def _slice(self, start: int, end: int) -> list[tuple[str, int, str | None]]:
        out, at = [], 0
        for shard, file, n in self._files():
            if at < end and at + n > start:
                place = at
                for group in file.split_by_row_group():
                    size = group.row_groups[0].num_rows
                    if place < end and place + size > start:
                        first, last = max(0, start - place), min(size, end - place)
                        part = group.to_table(columns=["row", "url"]).slice(first, last - first)
                        out += zip([shard] * (last - first), part["row"].to_pylist(), part["url"].to_pylist(), strict=True)
                    place += size
            at += n
        return out

    def initialOffset(self) -> dict:  # noqa: N802
        return {"taken": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows = self._slice(start["taken"], start["taken"] + self.size)
        return iter(rows), {"taken": start["taken"] + len(rows)}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        return iter(self._slice(start["taken"], end["taken"]))
