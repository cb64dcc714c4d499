"""The two steps as plans, and a command line over them."""

from __future__ import annotations

import argparse
import base64
import json
import logging
import time
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signmine.functions import planning
from signmine.functions.naming import run_suffix, timeout_pair
from signmine.operators import codecs, detections, edges, index, metas, preview, sequence, stats
from signmine.sources import captions, files, sinks

log = logging.getLogger("signmine")


@dataclass
class Config:
    """Names and defaults of a run's options. 0 mostly means: no limit."""

    dataset: str = ""
    out_root: str = "./out"
    steps: tuple[str, ...] = ("filter", "crop")
    full: bool = False
    fresh: bool = False
    force: bool = False
    max_shards: int | None = None
    workers: int = 8  # Spark's own parallelism takes its place
    debug: bool = False
    filter_preview_n: int = 10
    filter_preview_threads: int = 32
    max_attempts: int = 200
    seed: int = 0
    score_thr: float = 0.3
    iou_thr: float = 0.5
    max_keep: int = 100
    num_gpus: int = 0  # by Spark's resources of executors and tasks
    jpeg_quality: int = 90
    batch_size: int = 2
    fetch_threads: int = 128
    queue_size: int = 512
    timeout: str = "3,5"
    target: int | None = None
    target_crops: int = 0
    expected_yield: float | None = None
    expected_decode_rate: float = 0.5
    fetch_safety: float = 2.5
    chunk_crops: int | None = None
    shard_mod: int = 1
    shard_rem: int = 0
    crop_preview_n: int = 20
    save_preview_images: bool = False
    save_crops: bool = False
    lmdb_map_size: int = 1 << 40  # the store is Parquet, which has no such size
    shards_at_once: int = 16
    detectors: str = ""
    fp16: bool = False
    suffix: str = field(default="", init=False)

    def resolved(self) -> Config:
        """Defaults that depend on other options, filled in."""
        self.out_root, self.dataset = files.expanded(self.out_root), files.expanded(self.dataset)
        if self.debug:
            self.out_root = f"./DEBUG/{self.out_root.rstrip('/').rsplit('/', 1)[-1]}"
            self.debug = False
        names = {"1": "filter", "index": "filter", "2": "crop"}
        self.steps = tuple(names.get(s, s) for s in self.steps)
        if bad := set(self.steps) - {"filter", "crop"}:
            raise ValueError(f"no such steps: {sorted(bad)}")
        timeout_pair(self.timeout)
        if self.expected_yield is None:
            self.expected_yield = planning.expected_yield(self.max_keep)
        if self.target is None:
            self.target = 0 if self.target_crops > 0 else 100
        if self.full:
            self.max_shards, self.target = 0, 0
        self.suffix = run_suffix(self.target_crops, self.max_keep, self.shard_mod, self.shard_rem, self.fp16)
        return self

    def planned(self, spark: SparkSession) -> Config:
        """Shards and chunks for the target of crops."""
        if self.max_shards is None or self.chunk_crops is None:
            target = F.lit(max(self.target_crops, 1))
            args = (self.expected_yield, self.expected_decode_rate, self.fetch_safety)
            row = spark.range(1).select(planning.shards_needed(target, *args).alias("shards"), planning.chunk_size(target).alias("chunk")).first()
            if self.max_shards is None:
                self.max_shards = row["shards"] if self.target_crops > 0 else 1
            if self.chunk_crops is None:
                self.chunk_crops = row["chunk"] if self.target_crops > 0 else 0
        return self


def filter_step(spark: SparkSession, config: Config, fetcher: edges.Fetcher | None = None) -> dict:
    """Captions to the index, its manifest and a preview. Shards that the manifest has are not read again; files that can't be read are passed over, named in the log and in the summary.

    The captions are read once: rows are counted from the files' footers, and matches from the index.
    """
    began = time.time()
    where, known = f"{config.out_root}/index", f"{config.out_root}/manifest"
    listed = [x.removesuffix(".parquet") for x in files.names(spark, config.dataset, ".parquet")]
    listed = listed[: config.max_shards] if config.max_shards else listed
    readable = set(captions.readable_shards(spark, config.dataset))
    # Files without a footer are passed over; what goes wrong later in a file that has one fails the step, and no shard is known by half.
    rows, cached = captions.read(spark, config.dataset, only=[s for s in listed if s in readable]), None
    if files.exists(spark, known) and not config.force:
        cached = spark.createDataFrame(index.latest(spark.read.parquet(known)).collect(), index.MANIFEST_SCHEMA)  # a row for each shard; kept apart from what is written next
        rows = index.not_cached(rows, cached)
    scan = time.time()
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    index.write_index(index.build_index(rows), where)
    scan_wall = time.time() - scan
    fresh = index.counted_manifest(rows, index.read_index(spark, where))
    fresh.write.mode("append").parquet(known)  # after the index: a shard is only known once its rows are there
    latest = index.latest(spark.read.parquet(known))
    failed = [s for s in listed if s not in readable]
    for shard in failed:
        log.warning("shard %s has no rows or can't be read; it is tried again in the next run", shard)
    out = index.summary(latest, cached).first().asDict() | {"dataset": config.dataset, "shards_failed": failed, "scan_wall": scan_wall}
    out["previews"] = write_filter_preview(spark, config, fetcher) if config.filter_preview_n > 0 and fetcher is not None and out["matched"] else 0
    out["wall"] = time.time() - began
    files.write(spark, f"{where}/SUMMARY.json", json.dumps(out, indent=2))
    return out


def crops_of(items: DataFrame, config: Config, fetcher: edges.Fetcher, codec: edges.Codec, detectors: Callable[[], Sequence[edges.Detector]], shown: Sequence[str] = ()) -> DataFrame:
    """Work items (shard, row, url) to a row for each, with its crops and how long they took: fetch, detect, drop low scores, suppress, cap, cut. No shuffle after the items are dealt out in order."""
    parts = max(1, items.sparkSession.sparkContext.defaultParallelism)
    dealt = items.repartitionByRange(parts, "shard", "row").sortWithinPartitions("shard", "row")
    images = edges.detected(edges.fetched(dealt, fetcher, config.fetch_threads, config.queue_size), codec, detectors, config.batch_size)
    return edges.cropped(detections.rectangles(images, config.score_thr, config.iou_thr, config.max_keep, config.seed), codec, shown)


class Progress:
    """What is done: the highest row by shard, finished shards, and how many batches and crops are in the store. One file, replaced as a whole after what it speaks of is written."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        found = sinks.read_json(spark, path)
        self.rows, self.done = dict(found.get("rows", {})), set(found.get("done", []))
        self.batches, self.crops = found.get("batches", 0), found.get("crops", 0)

    def save(self) -> None:
        files.write(self.spark, self.path, json.dumps({"rows": self.rows, "done": sorted(self.done), "batches": self.batches, "crops": self.crops}))

    def left_of(self, items: DataFrame) -> DataFrame:
        known = self.spark.createDataFrame([*self.rows.items()], "shard string, max_row long")  # a row for each shard
        return metas.after_progress(items, known) if self.rows else items


def _fetch_cap(config: Config, crops: int | None, images: int | None) -> int | None:
    """Items to try for so many crops and images more; None: all."""
    caps = []
    if crops is not None:
        caps.append(planning.fetch_cap_of(crops, config.expected_yield, config.expected_decode_rate, config.fetch_safety))
    if images is not None:
        caps.append(int(images / max(config.expected_decode_rate, planning.LEAST_DECODE)) + 1)
    return min(caps) if caps else None


#: So many batches that give nothing end a run.
ZERO_BATCHES = 3


def crop_step(spark: SparkSession, config: Config, fetcher: edges.Fetcher, codec: edges.Codec, detectors: Callable[[], Sequence[edges.Detector]]) -> dict:
    """Indexed rows to the crop store, in order, batch by batch: of the first max_shards shards that aren't done, shards_at_once at a time, and of them as many items as the targets need.

    A batch's images are written before they are numbered, so nothing is fetched again; then its crops, in order and exactly up to the targets; then the progress, up to the last image that was used.
    Whatever stops a run, the next goes on with the first image that isn't in the store, and a batch that is run again replaces itself.
    target (images) counts over this run; target_crops over the store.
    """
    began, sfx = time.time(), config.suffix
    store, progress = sinks.CropStore(spark, f"{config.out_root}/crops{sfx}"), Progress(spark, f"{config.out_root}/_progress{sfx}")
    indexed = index.read_index(spark, f"{config.out_root}/index")
    shards = [r["shard"] for r in metas.machine_share(indexed.select("shard").distinct(), config.shard_mod, config.shard_rem).orderBy("shard").collect()]  # names of files
    todo = [s for s in shards if s not in progress.done]
    todo = todo[: config.max_shards] if config.max_shards else todo
    did = dict.fromkeys(stats.CROP_COUNTERS, 0) | {"stopped": ""}
    spans: dict[str, list[float]] = {}
    start_crops, zeros, shown = progress.crops, 0, []

    def span(phase: str, first: float | None, last: float | None) -> None:
        if first is not None:
            old = spans.get(phase, [first, last])
            spans[phase] = [min(old[0], first), max(old[1], last)]

    for at in range(0, len(todo), config.shards_at_once):
        group = todo[at : at + config.shards_at_once]
        while not did["stopped"]:
            crops_left = config.target_crops - progress.crops if config.target_crops else None
            images_left = config.target - did["gpu_imgs"] if config.target else None
            if (crops_left is not None and crops_left <= 0) or (images_left is not None and images_left <= 0):
                did["stopped"] = "target"
                break
            chunk = planning.chunk_target(config.chunk_crops or 0, crops_left)
            cap = _fetch_cap(config, chunk, images_left)
            reading = time.time()
            items = metas.with_url(progress.left_of(indexed.where(F.col("shard").isin(group)))).select("shard", "row", "url")
            items = files.cut(metas.capped(items, cap) if cap is not None else items)
            did["parquet_sum"] += time.time() - reading
            span("parquet", reading, time.time())
            if config.crop_preview_n and not shown:
                shown = [f"{r['shard']}:{r['row']}" for r in items.orderBy("shard", "row").limit(5 * config.crop_preview_n).collect()]
            made = files.cut(crops_of(items, config, fetcher, codec, detectors, shown))
            tried = _batch(spark, config, store, progress, made, crops_left, images_left, did, span, bool(shown) and hasattr(codec, "overlay"))
            files.drop(items)
            files.drop(made)
            if not tried:
                break
            zeros = 0 if did["crops"] > did["_before"] else zeros + 1
            if zeros >= ZERO_BATCHES:
                did["stopped"] = "nothing came"
        if did["stopped"]:
            break
        progress.done.update(group)
        progress.save()
    did.pop("_before", None)
    if config.save_crops and progress.crops > start_crops:
        sinks.write_files(store.read(), f"{config.out_root}/files{sfx}")
    previews = write_crops_preview(spark, config, store) if config.crop_preview_n and progress.crops else 0
    for phase in ("fetch", "gpu", "crop", "write", "parquet"):
        first, last = spans.get(phase, (0.0, 0.0))
        did[f"{phase}_wall"] = last - first
    met = not config.target_crops or progress.crops >= config.target_crops
    by_images = bool(config.target) and did["gpu_imgs"] >= config.target
    rates = {f"avg_{k}_ms": 1000 * did[f"{k}_sum"] / max(1, did[n]) for k, n in (("fetch", "urls_tried"), ("gpu", "batches"))} | {"crops_per_image": did["crops"] / max(1, did["gpu_imgs"])}
    slow = "fetch" if did["fetch_wall"] >= did["gpu_wall"] - 1 else "gpu"
    wall = time.time() - began
    return did | rates | {
        "bottleneck": slow, "total": progress.crops, "target_crops": config.target_crops, "target_crops_total": progress.crops, "target_crops_met": met, "target_crops_missed": not met and not by_images,
        "target_crops_written": progress.crops - start_crops, "previews": previews, "pipeline_wall": wall, "wall": wall,
    }


def _batch(spark: SparkSession, config: Config, store: sinks.CropStore, progress: Progress, made: DataFrame, crops_left: int | None, images_left: int | None, did: dict, span: Callable, overlays: bool) -> int:
    """Numbers and writes what a batch has made, up to the targets, and renews progress and counts; how many items it tried."""
    n = F.size("crops")
    ends = lambda a, b: (F.min(a), F.max(F.col(a) + F.col(b)))
    parts = made.groupBy("part").agg(F.count("*").alias("tried"), F.count("width").alias("images"), F.sum(n).alias("crops")).orderBy("part").collect()  # a row for each partition
    tried = sum(p["tried"] for p in parts)
    did["_before"] = did["crops"]
    if not tried:
        return 0
    offsets, images, crops = [], 0, progress.crops
    for p in parts:
        offsets.append((p["part"], images, crops))
        images, crops = images + p["images"], crops + p["crops"]
    placed = made.join(F.broadcast(spark.createDataFrame(offsets, "part int, images_at long, crops_at long")), "part")
    placed = placed.withColumns({"image_no": F.col("images_at") + F.col("images_before"), "crops_no": F.col("crops_at") + F.col("crops_before")})
    used = F.lit(True)  # up to the last image that the targets need
    if images_left is not None and images >= images_left:
        used = used & (F.col("image_no") < images_left)
    if crops_left is not None and crops >= config.target_crops:
        used = used & (F.col("crops_no") < config.target_crops)
    placed = placed.where(used)
    rows = placed.select("shard", "row", "crops_no", F.posexplode("crops").alias("i", "crop")).select("shard", "row", (F.col("crops_no") + F.col("i") + 1).alias("seq"), "crop.*")
    rows = sequence.with_keys(sequence.up_to(rows, config.target_crops)).withColumn("name", F.format_string("%s__r%08d__c%02d", "shard", "row", "c"))
    writing = time.time()
    written = store.write(rows, progress.batches)
    if overlays:
        _overlays(spark, config, placed)
    did["write_sum"] += time.time() - writing
    span("write", writing, time.time())
    got = placed.agg(
        F.count("*").alias("tried"), F.count_if("ok").alias("decoded"), F.count("width").alias("images"), F.coalesce(F.sum("batches"), F.lit(0)).alias("batches"),
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("fetch_seconds", "detect_seconds", "crop_seconds")],
        *[c.alias(f"{k}_{e}") for k, a in (("fetch", "fetch"), ("gpu", "detect"), ("crop", "crop")) for e, c in zip(("first", "last"), ends(f"{a}_began", f"{a}_seconds"), strict=True)],
    ).first()
    for phase in ("fetch", "gpu", "crop"):
        span(phase, got[f"{phase}_first"], got[f"{phase}_last"])
    for name, value in (("urls_tried", got["tried"]), ("urls_decoded", got["images"]), ("decoded_not_processed", images - got["images"]), ("gpu_imgs", got["images"]), ("crops", written), ("batches", got["batches"]), ("fetch_sum", got["fetch_seconds"]), ("gpu_sum", got["detect_seconds"]), ("crop_sum", got["crop_seconds"])):
        did[name] += value
    for r in metas.progress_of(placed).collect():  # a row for each shard of the batch
        progress.rows[r["shard"]] = max(r["max_row"], progress.rows.get(r["shard"], -1))
    progress.crops += written
    progress.batches += 1
    progress.save()
    return tried


def _overlays(spark: SparkSession, config: Config, placed: DataFrame) -> None:
    """Keeps the overlays of the first images for the preview, crop_preview_n at most."""
    some = placed.where("overlay is not null").select(F.concat_ws("__", "shard", F.format_string("r%08d", "row")).alias("name"), "overlay").orderBy("name").limit(config.crop_preview_n).collect()
    for r in some:
        files.write(spark, f"{config.out_root}/crops_preview{config.suffix}/{r['name']}.jpg", bytes(r["overlay"]))


def _shown(spark: SparkSession, config: Config, folder: str, name: str, data: bytes) -> str:
    """Where a page finds an image: a file beside it with save_preview_images, else in the page itself."""
    if not config.save_preview_images:
        return f"data:image/jpeg;base64,{base64.b64encode(data).decode()}"
    files.write(spark, f"{config.out_root}/{folder}/{name}.jpg", data)
    return f"{folder}/{name}.jpg"


def write_crops_preview(spark: SparkSession, config: Config, store: sinks.CropStore) -> int:
    """A page of the first crop_preview_n images by name, each with its crops and scores; how many."""
    rows = store.read()
    first = preview.first_by_name(rows.select("shard", "row", F.substring_index("name", "__c", 1).alias("image")).distinct(), config.crop_preview_n, "image")
    some = rows.join(F.broadcast(first), ["shard", "row"]).orderBy("image", "c").collect()  # crop_preview_n images, max_keep crops each
    items, page = {}, f"crops_preview{config.suffix}"
    for r in some:
        body = f'<img src="{_shown(spark, config, page, r["name"], bytes(r["jpeg"]))}" alt="crop {r["c"]}"> {r["score"]:.2f} '
        items[r["image"]] = items.get(r["image"], "") + body
    drawn = set(files.names(spark, f"{config.out_root}/{page}"))
    files.write(spark, f"{config.out_root}/{page}.html", preview.page("Crops", [{"image": f"{page}/{k}.jpg" if f"{k}.jpg" in drawn else "", "heading": k, "body": v} for k, v in items.items()]))
    return len(items)


def write_filter_preview(spark: SparkSession, config: Config, fetcher: edges.Fetcher) -> int:
    """Fetches the seeded candidates and writes a page of the first good ones; how many. Candidates number max_attempts at most."""
    found = index.read_index(spark, f"{config.out_root}/index")
    shards = [r["shard"] for r in found.select("shard").distinct().orderBy("shard").collect()]  # names of files
    rows = metas.rows_of_index(captions.read(spark, config.dataset, only=shards), found)
    some = files.cut(preview.highlighted(preview.candidates(rows, config.seed, config.max_attempts)))
    threads = planning.preview_workers(config.filter_preview_threads, config.filter_preview_n, config.max_attempts)
    good = preview.first_good(edges.fetched(some, fetcher, threads).where("ok"), config.filter_preview_n, config.seed)
    shown = good.join(some.drop("url"), ["shard", "row"]).orderBy(*preview.seeded_order(config.seed)).collect()
    files.drop(some)
    items = [{"image": _shown(spark, config, "filter_preview", f"recap_{i:05d}", bytes(r["data"])), "heading": f"{r['shard']} {r['row']}", "body": r["caption_html"]} for i, r in enumerate(shown)]
    files.write(spark, f"{config.out_root}/filter_preview.html", preview.page("Filter preview", items))
    return len(items)


def fresh_start(spark: SparkSession, config: Config) -> list[str]:
    """Deletes the outputs of the steps that will run, of this suffix only; which."""
    suffix = config.suffix
    names = {"filter": ["index", "manifest", "filter_preview", "filter_preview.html"], "crop": [f"crops{suffix}", f"files{suffix}", f"_progress{suffix}", f"crops_preview{suffix}.html", f"crops_preview{suffix}"]}
    return [n for n in dict.fromkeys(n for step in config.steps for n in names[step]) if files.delete(spark, f"{config.out_root}/{n}")]


def run(spark: SparkSession, config: Config, fetcher: edges.Fetcher | None = None, codec: edges.Codec | None = None, detectors: Callable[[], Sequence[edges.Detector]] | None = None) -> dict:
    """Runs the steps in the order given and adds the run to the summary file."""
    config, began = config.resolved().planned(spark), time.time()
    codec = codec or codecs.installed(config.jpeg_quality)
    if detectors is None and config.detectors:
        module, _, name = config.detectors.partition(":")
        detectors = getattr(import_module(module), name)
    if "crop" in config.steps and (codec is None or detectors is None):
        raise RuntimeError("the crop step needs a codec and detectors")
    if config.fresh:
        fresh_start(spark, config)
    done, fetcher = {}, fetcher or edges.http_fetcher(timeout_pair(config.timeout))
    for step in config.steps:
        done[step] = filter_step(spark, config, fetcher) if step == "filter" else crop_step(spark, config, fetcher, codec, detectors)
    record = {"dataset": config.dataset, "finished_at_utc": datetime.now(UTC).isoformat(), "steps_requested": list(config.steps), "total_wall_seconds": round(time.time() - began, 1), "args": asdict(config), "steps": done}
    return sinks.add_run(spark, f"{config.out_root}/SUMMARY{config.suffix}.json", record)


def main(arguments: Sequence[str] | None = None) -> int:
    """Command line: --detectors module:function, which gives the detectors, --dataset, --out_root and the other options of Config; 1 if a target of crops was missed, 2 if the crop step has no detectors here."""
    parser = argparse.ArgumentParser(description=__doc__)
    defaults = Config()
    for name, value in asdict(defaults).items():
        if name == "suffix":
            continue
        if isinstance(value, bool):
            parser.add_argument(f"--{name}", action="store_true")
        elif name == "steps":
            parser.add_argument("--steps", type=lambda s: tuple(s.split(",")), default=value)
        else:
            kind = {"expected_yield": float, "max_shards": int, "target": int, "chunk_crops": int}.get(name, type(value))
            parser.add_argument(f"--{name}", type=kind, default=value)
    config = Config(**vars(parser.parse_args(arguments)))
    spark = SparkSession.builder.appName("signmine").getOrCreate()
    try:
        out = run(spark, config)
    except RuntimeError as error:
        print(error)
        return 2
    print(json.dumps(out["cumulative"], indent=2))
    last = out["runs"][-1]["steps"].get("crop", {})
    return 1 if last.get("target_crops_missed") else 0


if __name__ == "__main__":
    raise SystemExit(main())
