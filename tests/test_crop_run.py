"""The crop run: targets, chunks, shards, resumption, statistics, previews; codecs, predictions and the fetcher."""

import http.server
import json
import threading
import time
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_pipeline import FakeCodec, dataset, fake_detectors, fake_fetcher  # noqa: F401  a fixture

from signmine.operators import codecs, edges, index
from signmine.plans import pipeline
from signmine.sources import captions, files
from signmine.sources.sinks import CropStore


@pytest.fixture(scope="module")
def indexed(spark, dataset, tmp_path_factory):  # noqa: F811
    """(dataset, a folder with its index, rows of the index that can be decoded, in order)."""
    root = tmp_path_factory.mktemp("indexed")
    pipeline.run(spark, pipeline.Config(dataset=dataset, out_root=str(root), max_shards=0, steps=("filter",), filter_preview_n=0))
    good = []
    for r in index.read_index(spark, f"{root}/index").orderBy("shard", "row").collect():
        n = int("".join(c for c in r["url"] or "" if c.isdigit()) or 0)
        if r["url"] and n % 5 and n % 7:
            good.append((r["shard"], r["row"]))
    return dataset, root, good


def run(spark, indexed, where, detectors=fake_detectors, **options):
    dataset, root, _ = indexed  # noqa: F811
    if not Path(where, "index").exists():
        Path(where).mkdir(exist_ok=True)
        Path(where, "index").symlink_to(root / "index")
    options = {"max_shards": 0, "target": 0} | options
    return pipeline.run(spark, pipeline.Config(dataset=dataset, out_root=str(where), steps=("crop",), **options), fake_fetcher, FakeCodec(), detectors)["runs"][-1]["steps"]["crop"]


def images(spark, where, suffix=""):
    rows = CropStore(spark, f"{where}/crops{suffix}").read().orderBy("seq").collect()
    assert [r["seq"] for r in rows] == list(range(1, len(rows) + 1))
    assert [(r["shard"], r["row"], r["c"]) for r in rows] == sorted((r["shard"], r["row"], r["c"]) for r in rows)
    return list(dict.fromkeys((r["shard"], r["row"]) for r in rows))


def test_target_of_images_holds_over_shards_and_runs_go_on(spark, indexed, tmp_path):
    good, taken = indexed[2], 0
    assert len(good) > 30
    while taken < len(good):
        did = run(spark, indexed, tmp_path, target=17)
        assert did["gpu_imgs"] == min(17, len(good) - taken) and did["stopped"] == ("target" if len(good) - taken >= 17 else "")
        taken += did["gpu_imgs"]
        assert images(spark, tmp_path) == good[:taken]
    assert run(spark, indexed, tmp_path, target=17)["urls_tried"] == 0


def test_max_shards_takes_the_first_that_are_not_done(spark, indexed, tmp_path):
    shards = sorted({s for s, _ in indexed[2]})
    for n in (1, 2, 3):
        run(spark, indexed, tmp_path, max_shards=1)
        assert {s for s, _ in images(spark, tmp_path)} == set(shards[:n])


def test_chunks(spark, indexed, tmp_path):
    did = run(spark, indexed, tmp_path, target_crops=30, chunk_crops=8, expected_yield=2.0, fetch_safety=1.0)
    store = CropStore(spark, f"{tmp_path}/crops_t30")
    assert did["total"] == 30 and did["target_crops_met"] and store.read().select("batch").distinct().count() > 2 and images(spark, tmp_path, "_t30") == indexed[2][:15]


def test_a_run_that_finds_nothing_stops(spark, indexed, tmp_path):
    nothing = lambda: [lambda batch: [[] for _ in batch]]
    did = run(spark, indexed, tmp_path, nothing, target_crops=5, expected_yield=12.0, fetch_safety=1.0)
    assert did["stopped"] == "nothing came" and did["target_crops_missed"] and did["total"] == 0


def test_statistics_and_previews(spark, indexed, tmp_path):
    did = run(spark, indexed, tmp_path, crop_preview_n=3)
    tried = index.read_index(spark, f"{tmp_path}/index").where("url is not null and url <> ''").count()
    assert did["urls_tried"] == tried and did["urls_decoded"] == did["gpu_imgs"] == len(indexed[2]) and did["crops"] == did["target_crops_written"] == 2 * len(indexed[2]) and did["crops_per_image"] == 2
    assert did["batches"] >= len(indexed[2]) / 2 and did["bottleneck"] in ("fetch", "gpu") and all(did[k] > 0 for k in ("fetch_sum", "gpu_sum", "crop_sum", "write_sum", "parquet_sum", "fetch_wall", "gpu_wall", "crop_wall", "write_wall", "pipeline_wall", "wall"))
    saved = json.loads(Path(tmp_path, "SUMMARY.json").read_text())
    assert saved["cumulative"]["crop"]["crops"] == did["crops"] and saved["cumulative"]["crop"]["gpu_sum"] == did["gpu_sum"]
    page = Path(tmp_path, "crops_preview.html").read_text()
    assert did["previews"] == 3 and page.count("data:image/jpeg;base64,") == 6 and [f"{s}__r{r:08d}" in page for s, r in indexed[2][:4]] == [True, True, True, False]


def test_overlays_are_kept_for_the_first_images(spark, indexed, tmp_path):
    codec, (dataset, root, good) = codecs.PixmapCodec(), indexed  # noqa: F811
    Path(tmp_path, "index").symlink_to(root / "index")
    pixmap = codec.encode(np.zeros((30, 40, 3), np.uint8))
    pipeline.run(spark, pipeline.Config(dataset=dataset, out_root=str(tmp_path), steps=("crop",), max_shards=1, target=4, crop_preview_n=2), lambda url: pixmap if fake_fetcher(url)[:1].isdigit() else b"", codec, fake_detectors)
    names = [f"{s}__r{r:08d}.jpg" for s, r in good[:2]]
    assert sorted(p.name for p in Path(tmp_path, "crops_preview").iterdir() if p.suffix == ".jpg") == names
    drawn = codec.decode(Path(tmp_path, "crops_preview", names[0]).read_bytes())
    assert tuple(drawn[2, 10]) == codecs.BOX_COLOUR and all(n in Path(tmp_path, "crops_preview.html").read_text() for n in names)


def test_an_image_goes_through_each_edge_once(spark, indexed):
    items = index.read_index(spark, f"{indexed[1]}/index").select("shard", "row", "url")
    plan = pipeline.crops_of(items, pipeline.Config().resolved(), fake_fetcher, FakeCodec(), fake_detectors)._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("MapInPandas") == 3 and final.count("Exchange") == final.count("rangepartitioning") == 1 and "Join" not in final


def test_loose_files_and_a_url_as_root(spark, indexed, tmp_path):
    (tmp_path / "x").mkdir()
    run(spark, indexed, tmp_path / "x")
    root = f"file://{tmp_path}/y"
    Path(tmp_path, "y").mkdir()
    Path(tmp_path, "y", "index").symlink_to(indexed[1] / "index")
    out = pipeline.run(spark, pipeline.Config(dataset=indexed[0], out_root=root, steps=("crop",), max_shards=1, target=2, save_crops=True), fake_fetcher, FakeCodec(), fake_detectors)
    assert out["runs"][0]["steps"]["crop"]["gpu_imgs"] == 2 and sorted(p.name for p in Path(tmp_path, "y/files").iterdir()) == [f"{s}__r{r:08d}__c{c:02d}.jpg" for s, r in indexed[2][:2] for c in (0, 1)]
    assert set(pipeline.fresh_start(spark, pipeline.Config(out_root=root, steps=("crop",)).resolved())) == {"crops", "files", "_progress", "crops_preview.html"}


def test_unreadable_shards_are_passed_over(spark, dataset, tmp_path, caplog):  # noqa: F811
    import shutil

    shutil.copytree(dataset, tmp_path / "data")
    Path(tmp_path, "data", "train-00009-of-00004.parquet").write_bytes(b"no parquet")
    did = pipeline.run(spark, pipeline.Config(dataset=f"{tmp_path}/data", out_root=str(tmp_path), max_shards=0, steps=("filter",), filter_preview_n=0), fake_fetcher)["runs"][0]["steps"]["filter"]
    assert did["shards_failed"] == ["train-00009-of-00004"] and did["shards"] == 4 and did["rows"] == 200 and did["matched"] == 100 and "train-00009" in caplog.text


def test_paths_are_expanded(monkeypatch):
    monkeypatch.setenv("HOME", "/home/me")
    config = pipeline.Config(dataset="~/data", out_root="~/out").resolved()
    assert (config.dataset, config.out_root) == ("/home/me/data", "/home/me/out") and files.expanded("s3a://x/~y") == "s3a://x/~y"
    assert pipeline.Config(out_root="/a/run1/", debug=True).resolved().out_root == "./DEBUG/run1"


def test_pixmaps_and_overlays():
    codec = codecs.PixmapCodec()
    image = np.arange(10 * 12 * 3, dtype=np.uint8).reshape(10, 12, 3)
    data = codec.encode(image)
    assert (codec.decode(data) == image).all() and codec.size(image) == (12, 10) and codec.decode(b"P6\n# a comment\n2 1\n255\n" + bytes(6)).shape == (1, 2, 3)
    assert codec.decode(b"JFIF") is None and codec.decode(data[:-1]) is None and codec.crop(image, 3, 3, 3, 5) is None
    assert (codec.decode(codec.crop(image, 2, 1, 5, 4)) == image[1:4, 2:5]).all()
    drawn = codec.decode(codec.overlay(np.zeros((20, 20, 3), np.uint8), [[[(1, 1), (5, 1), (5, 4)]], [[(1, 15), (4, 15), (4, 18)]]], [(8, 8, 14, 12, 0.5), (18, 18, 30, 30, 0.1)]))
    assert tuple(drawn[1, 3]) == codecs.DETECTOR_COLOURS[0] and tuple(drawn[15, 2]) == codecs.DETECTOR_COLOURS[1] and tuple(drawn[8, 10]) == tuple(drawn[9, 10]) == codecs.BOX_COLOUR and tuple(drawn[10, 11]) == (0, 0, 0)


def test_predictions_by_precedence():
    square = [[0, 0], [4, 0], [4, 4]]
    want = [([(0.0, 0.0), (4.0, 0.0), (4.0, 4.0)], 0.5)]
    assert edges.prediction({"instances": SimpleNamespace(polygons=[np.array(square).ravel()], ctrl_points=[square, square], scores=np.array([0.5]))}) == want
    assert edges.prediction(SimpleNamespace(ctrl_points=np.array([square, square]), scores=[0.5, 0.6], pred_boxes=[[1, 1, 2, 2]]))[:1] == want
    assert edges.prediction({"pred_polys": [square, [[1, 1], [2, 2]]], "scores": [0.5, 0.9]}) == want
    assert edges.prediction({"pred_boxes": SimpleNamespace(tensor=np.array([[1, 2, 3, 4]]))}) == [([(1.0, 2.0), (3.0, 2.0), (3.0, 4.0), (1.0, 4.0)], 1.0)]
    assert edges.prediction(None) == edges.prediction({}) == edges.prediction([]) == [] and edges.prediction([(square, None)]) == [([(0, 0), (4, 0), (4, 4)], 1.0)]


def test_fetcher_reads_images_only_and_gives_up_in_time():
    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            if "slow" in self.path:
                time.sleep(2)
            self.send_response(404 if "none" in self.path else 200)
            self.send_header("Content-Type", "image/png" if "image" in self.path else "text/html")
            self.end_headers()
            self.wfile.write(b"data")

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    fetch, at = edges.http_fetcher((1.0, 0.5)), f"http://127.0.0.1:{server.server_port}"
    assert fetch(f"{at}/image") == fetch(f"{at}/x.JPG?y") == b"data" and fetch(f"{at}/page") is None
    for path in ("/none", "/slow"):
        began = time.perf_counter()
        with pytest.raises(OSError):
            fetch(at + path)
        assert time.perf_counter() - began < 1.5
    server.shutdown()


def test_rows_of_a_real_dataset(spark, dataset):  # noqa: F811
    rows = captions.read(spark, dataset, ("url",))
    assert rows.groupBy("shard").agg(F.min("row").alias("a"), F.max("row").alias("b"), F.count("*").alias("n")).where("a <> 0 or b <> n - 1").count() == 0
