"""Where Spark meets the network, the detectors and the image codec: Arrow batches through objects that are handed in.

A run is given its own fetcher, codec and detectors; tests use deterministic ones. Codecs for libraries that may be installed are in signmine.operators.codecs.
An image is one row from its URL to its crops, so nothing is shuffled, decoded or inferred twice between.
"""

from __future__ import annotations

import time
import urllib.request
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cache
from http.client import HTTPConnection, HTTPSConnection
from typing import Any, Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Codec(Protocol):
    """May also have overlay(image, polygons of each detector, boxes as (x1, y1, x2, y2, score)) to bytes, for previews."""

    def decode(self, data: bytes) -> Any | None:
        """An image, or None if it is none."""

    def size(self, image: Any) -> tuple[int, int]:
        """Width and height."""

    def crop(self, image: Any, left: int, top: int, right: int, bottom: int) -> bytes | None:
        """An encoded part of the image."""


#: (url) to bytes, or None. It may raise.
Fetcher = Callable[[str], bytes | None]
#: Images to, for each, a list of (polygon as [(x, y), ...], score or None).
Detector = Callable[[Sequence[Any]], Sequence[Sequence[tuple[Sequence[tuple[float, float]], float | None]]]]

FETCHED = "shard string, row long, url string, ok boolean, began double, seconds double, data binary"
DETECTED = "shard string, row long, ok boolean, fetch_began double, fetch_seconds double, data binary, width int, height int, detect_began double, detect_seconds double, batches int, found array<struct<det:int,q:int,poly:array<struct<x:float,y:float>>,score:double>>"
CROPS = "array<struct<c:int,left:int,top:int,right:int,bottom:int,score:double,jpeg:binary>>"


@cache
def _opener(connect: float):
    """Plain HTTP with a time to connect; the time to read is set on each answer."""

    def timed(kind):
        class Timed(kind):
            def connect(self):
                read, self.timeout = self.timeout, connect
                super().connect()
                self.sock.settimeout(read)

        return Timed

    class Http(urllib.request.HTTPHandler):
        def http_open(self, request):
            return self.do_open(timed(HTTPConnection), request)

    class Https(urllib.request.HTTPSHandler):
        def https_open(self, request):
            return self.do_open(timed(HTTPSConnection), request, context=self._context)

    return urllib.request.build_opener(Http, Https)


def http_fetcher(timeout: float | tuple[float, float] = 5.0) -> Fetcher:
    """Plain HTTP by the standard library: no retries; whatever goes wrong gives None. Only answers that look like images are read. timeout: seconds, or those to connect and those to read."""
    from signmine.functions.naming import IMAGE_EXTENSIONS

    connect, read = timeout if isinstance(timeout, tuple) else (timeout, timeout)

    def fetch(url: str) -> bytes | None:
        with _opener(connect).open(url, timeout=read) as answer:
            kind = (answer.headers.get("Content-Type") or "").lower()
            path = url.split("?")[0].lower()
            return answer.read() if "image" in kind or path.endswith(tuple(f".{x}" for x in IMAGE_EXTENSIONS)) else None

    return fetch


def bisected(run: Callable[[Sequence[Any]], Sequence[Any]], batch: Sequence[Any], retry: tuple[type[BaseException], ...] = (MemoryError,)) -> list[Any]:
    """run(batch); if memory runs out, its halves, and None for an item that doesn't fit alone. Other errors are passed on."""
    try:
        return list(run(batch))
    except retry:
        if len(batch) < 2:
            return [None] * len(batch)
        half = len(batch) // 2
        return [*bisected(run, batch[:half], retry), *bisected(run, batch[half:], retry)]


# What detectors may call their polygons, in the order in which one is taken.
POLYGON_FIELDS = ("polygons", "ctrl_points", "pred_polys")
BOX_FIELD, SCORE_FIELD = "pred_boxes", "scores"


def prediction(found: Any) -> list[tuple[list[tuple[float, float]], float]]:
    """What a detector gives for one image, as (polygon, score) pairs.

    found: such pairs already; or fields, of a mapping or an object, perhaps under "instances". The first field of POLYGON_FIELDS that is there counts, else the corners of the boxes in
    BOX_FIELD. A polygon is any nesting of x, y, x, y, ...; those of fewer than three points are left out with their scores; missing scores are 1. None and empty: none.
    """
    if found is None:
        return []
    if isinstance(found, dict) and "instances" in found:
        return prediction(found["instances"])
    if isinstance(found, (list, tuple)):
        return [(list(map(tuple, p)), 1.0 if s is None else float(s)) for p, s in found]
    get = found.get if isinstance(found, dict) else lambda name: getattr(found, name, None)
    flat = lambda x: np.asarray(x, np.float32).reshape(-1, 2)
    shapes = next((x for x in map(get, POLYGON_FIELDS) if x is not None), None)
    if shapes is not None:
        polygons = [flat(p) for p in shapes]
    else:
        boxes = get(BOX_FIELD)
        boxes = getattr(boxes, "tensor", boxes)
        corners = np.asarray([] if boxes is None else boxes, np.float32).reshape(-1, 4)
        polygons = [flat([x1, y1, x2, y1, x2, y2, x1, y2]) for x1, y1, x2, y2 in corners.tolist()]
    scores = get(SCORE_FIELD)
    scores = [1.0] * len(polygons) if scores is None else np.asarray(scores, float).tolist()
    return [([tuple(x) for x in p.tolist()], s) for p, s in zip(polygons, scores, strict=False) if len(p) >= 3]


def fetched(items: DataFrame, fetcher: Fetcher, threads: int = 32, at_once: int = 512) -> DataFrame:
    """items (shard, row, url) with ok, began, seconds and data. Requests run side by side, `at_once` of a task's items at a time: so many images are held in memory."""

    def one(url: str) -> tuple[bytes | None, float, float]:
        began, clock = time.time(), time.perf_counter()
        try:
            data = fetcher(url)
        except Exception:
            data = None
        return data, began, time.perf_counter() - clock

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                for at in range(0, len(batch), at_once):
                    part = batch.iloc[at : at + at_once]
                    found = list(pool.map(one, part["url"]))
                    yield part.assign(ok=[d is not None for d, _, _ in found], began=[b for _, b, _ in found], seconds=[s for _, _, s in found], data=[d for d, _, _ in found])

    return items.select("shard", "row", "url").mapInPandas(run, FETCHED)


def detected(images: DataFrame, codec: Codec, detectors: Callable[[], Sequence[Detector]], batch_size: int = 2) -> DataFrame:
    """fetched() images with width, height and found, the polygons of all detectors; a row for each image, without width where there is none or it can't be decoded.

    `detectors` is called once in a task, to load the models there. Each batch of images goes through each detector once; the first image of a batch counts it in `batches`.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models = list(detectors())
        for rows in batches:
            decoded = [codec.decode(bytes(d)) if ok and d is not None else None for ok, d in zip(rows["ok"], rows["data"], strict=True)]
            there = [i for i, x in enumerate(decoded) if x is not None]
            more: list[tuple] = [(None, None, None, 0.0, 0, [])] * len(rows)
            for at in range(0, len(there), batch_size):
                part = there[at : at + batch_size]
                began, clock = time.time(), time.perf_counter()
                answers = [bisected(model, [decoded[i] for i in part]) for model in models]
                seconds = time.perf_counter() - clock
                for k, i in enumerate(part):
                    found = [
                        {"det": det, "q": q, "poly": [{"x": float(x), "y": float(y)} for x, y in poly], "score": score}
                        for det, answer in enumerate(answers) for q, (poly, score) in enumerate(prediction(answer[k]))
                    ]
                    more[i] = (*codec.size(decoded[i]), began, seconds / len(part), int(k == 0), found)
            extra = dict(zip(("width", "height", "detect_began", "detect_seconds", "batches", "found"), zip(*more, strict=True), strict=True))
            out = rows[["shard", "row", "ok"]].assign(fetch_began=rows["began"], fetch_seconds=rows["seconds"], data=rows["data"], **{k: list(v) for k, v in extra.items()})
            yield out.astype({"width": "Int32", "height": "Int32"})

    return images.select("shard", "row", "ok", "began", "seconds", "data").mapInPandas(run, DETECTED)


def cropped(images: DataFrame, codec: Codec, shown: Iterable[str] = ()) -> DataFrame:
    """Images with rects (c, left, top, right, bottom, score) to the same with crops and without data: each image is decoded once and all its parts cut out; parts that can't be encoded are left out.

    images_before and crops_before count what stands before a row in its partition, part, whose rows come in order. shown: names (shard:row) of images that get an overlay, if the codec draws one.
    """
    names = frozenset(shown) if hasattr(codec, "overlay") else frozenset()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n_images = n_crops = 0
        for rows in batches:
            out = []
            for x in rows.itertuples():
                began, clock, crops, drawn = time.time(), time.perf_counter(), [], None
                wanted = f"{x.shard}:{x.row}" in names and pd.notna(x.width)
                if len(x.rects) or wanted:
                    image = codec.decode(bytes(x.data))
                    for r in x.rects if image is not None else ():
                        jpeg = codec.crop(image, r["left"], r["top"], r["right"], r["bottom"])
                        if jpeg is not None:
                            crops.append({**{k: r[k] for k in ("c", "left", "top", "right", "bottom", "score")}, "jpeg": jpeg})
                    if wanted and image is not None:
                        found = [[[(p["x"], p["y"]) for p in f["poly"]] for f in x.found if f["det"] == det] for det in sorted({f["det"] for f in x.found})]
                        drawn = codec.overlay(image, found, [tuple(b[k] for k in ("x1", "y1", "x2", "y2", "score")) for b in x.kept])
                out.append((n_images, n_crops, began if crops else None, time.perf_counter() - clock, crops, drawn))
                n_images += bool(pd.notna(x.width))
                n_crops += len(crops)
            more = dict(zip(("images_before", "crops_before", "crop_began", "crop_seconds", "crops", "overlay"), zip(*out, strict=True) if out else [[]] * 6, strict=True))
            yield rows.drop(columns=["data", "rects", "found", "kept"]).assign(**{k: list(v) for k, v in more.items()}).assign(part=0)

    kept = [c for c in images.columns if c not in ("data", "rects", "found", "kept")]
    schema = ", ".join(f"{c} {images.schema[c].dataType.simpleString()}" for c in kept)
    made = images.select(*kept, "data", "rects", "found", "kept").mapInPandas(run, f"{schema}, images_before long, crops_before long, crop_began double, crop_seconds double, crops {CROPS}, overlay binary, part int")
    return made.withColumn("part", F.spark_partition_id())
