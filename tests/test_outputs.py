"""Writers and small scans: each is run, and what it leaves is read back."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from mosaicflow.functions import grids, radiometry
from mosaicflow.operators import regions, runs
from mosaicflow.operators.tables import ranked
from mosaicflow.sources import files, remote, sinks
from mosaicflow.streaming import streams

RING = [[[0.0, 0.0], [2.0, 0.0], [2.0, 1.0], [0.0, 1.0], [0.0, 0.0]]]


def test_features_by_line_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", "u", [RING]), ("b", "", [RING, RING]), ("c", "x", None)], "name string, url string, geom array<array<array<array<double>>>>")
    sinks.write_features(df, str(tmp_path / "f"), ["name", "url"])
    got = {r.name: r for r in files.read_catalogue(spark, str(tmp_path / "f"), lines=True).collect()}
    assert (got["a"].url, got["a"].geom, len(got["b"].geom), got["c"].geom) == ("u", [RING], 2, None)


def test_tiles_and_regions(spark, tmp_path):
    features = [{"type": "Feature", "properties": {"name": n, "kind": "latlon", "height": 6, "bw": {"40": 2}}, "geometry": {"type": "Polygon", "coordinates": RING}} for n in ("t1", "t2", "t3")]
    (tmp_path / "t.geojson").write_text(json.dumps({"features": features}))
    path = str(tmp_path / "t.geojson")
    assert [r.name for r in files.read_tiles(spark, path, include=["t1", "t2"], exclude=["t2"]).collect()] == ["t1"]
    assert files.read_tiles(spark, path).first().bw == {"40": 2}
    region = files.read_regions(spark, path).first()
    assert (region.name, region.bounds.x1) == ("t1", 2.0)


def test_logs_counters_and_pictures(spark, tmp_path):
    (tmp_path / "a.log").write_text("one\r\n\ntwo\n")
    assert [(r.run, r.n, r.line) for r in files.read_log(spark, str(tmp_path / "a.log")).collect()] == [("a.log", 0, "one"), ("a.log", 2, "two")]
    (tmp_path / "dev").write_text("Inter-| Receive\n  eth0: 10 1 0 0 0 0 0 0 20 2\n    lo:5 0 0 0 0 0 0 0 6 0\n")
    assert sorted(map(tuple, files.read_counters(spark, str(tmp_path / "dev")).collect())) == [("eth0", 10, 20), ("lo", 5, 6)]
    pixels = spark.createDataFrame([(0, 0, 250, 3, 2), (1, 3, 9, 9, 9)], "row int, col int, r int, g int, b int")
    near = files.colour_cells(pixels, (252, 2, 1))
    lon, lat = files.picture_place(F.col("row"), F.col("col"), 2, 4, (-180.0, -90.0, 180.0, 90.0))
    assert [tuple(r) for r in near.select(lon, lat).collect()] == [(-135.0, 45.0)]
    layers = spark.createDataFrame([("f", "a", 2, 2_000_000, "float32", 9), ("f", "b", 2, 3_000_000, "complex64", 99), ("f", "c", 1, 9_000_000, "float32", 999), ("f", "d", 2, 5, "float32", 9)], "file string, layer string, dims int, cells long, dtype string, stored long")
    assert [r.layer for r in files.big_layers(layers).collect()] == ["b", "a"]


def test_class_raster(tmp_path):
    np.savez(tmp_path / "c.npz", np.array([[0, 2], [1, 0]]))
    assert list(remote.class_rows(str(tmp_path / "c.npz"))) == [(0, 1, 2), (1, 0, 1)]


def test_headers_views_and_documents(spark):
    grid = F.struct(F.lit(4326).alias("epsg"), *[F.lit(v).alias(n) for n, v in (("x0", 10.0), ("y0", 20.0), ("dx", 0.5), ("dy", -0.5))], F.lit(4).alias("nx"), F.lit(6).alias("ny"))
    text = spark.range(1).select(sinks.job_header(grid).alias("t")).first().t
    assert text.split("\n")[0].split() == ["10.250000000", "19.750000000", "2.000000000", "-3.000000000", "0.500000000000", "-0.500000000000"]
    outputs = spark.createDataFrame([("T1", "latlon", "A", "a.tif", 6.0), ("T1", "latlon", "B", "b.tif", 6.0), ("P1", "ps", "A", "p.tif", 60.0), ("E1", "ease", "A", "e.tif", 0.0)], "tile string, kind string, freq string, path string, lat0 double")
    members = {tuple(r) for r in sinks.view_members(outputs).collect()}
    assert members == {("tile_T1", "a.tif", 1), ("tile_T1", "b.tif", 0), ("tile_P1", "p.tif", 1), ("tile_E1", "e.tif", 1), ("band_+06", "tile_T1", 0), ("cap_P1", "tile_P1", 0), ("ease", "tile_E1", 0), ("global", "band_+06", 0)}
    arrays = spark.createDataFrame([("g", "https://x/g.h5", "/a/b", 4, 6, 10.0, 20.0, 0.5, -0.5, 4326)], "name string, url string, layer string, nx int, ny int, x0 double, y0 double, dx double, dy double, epsg int")
    document = sinks.array_manifest(arrays).first().document
    assert 'rasterXSize="4" rasterYSize="6"' in document and 'HDF5:"/vsicurl/https://x/g.h5":///a/b' in document
    top = sinks.top_document("A & B", ["x", "y"])
    assert "A &amp; B" in top and top.count("<NetworkLink>") == 2


def test_tables_and_records(spark, tmp_path):
    hist = spark.createDataFrame([("land", 0, 2.04), ("land", 0, 1.0), ("sea", 399, 5.0)], "region string, bin int, area double")
    rows = sinks.histogram_table(hist, ["land", "sea"]).collect()
    assert len(rows) == 400 and tuple(rows[0]) == ("-29.95", "3.0", "0.0") and tuple(rows[-1]) == ("9.95", "0.0", "5.0")
    totals = spark.createDataFrame([("x", 3)], "name string, n int")
    assert sinks.report_lines(totals, "%s has %d", "name", "n").first().value == "x has 3"
    sinks.write_csv(totals, str(tmp_path / "csv"))
    assert [tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "csv")).collect()] == [("x", "3")]
    sinks.run_record(spark, {"b": 1, "a": None}, str(tmp_path / "run"))
    assert json.loads(spark.read.text(str(tmp_path / "run")).first().value) == {"a": None, "b": 1}


def test_ranks_over_a_whole_table(spark):
    df = spark.range(0, 1000, 1, 7).selectExpr("id", "id * 37 % 101 as v")
    got = {r.id: r.place for r in ranked(df, "place", F.desc("v"), "id").collect()}
    assert got == {i: n + 1 for n, i in enumerate(sorted(range(1000), key=lambda i: (-(i * 37 % 101), i)))}
    plan = ranked(df, "place", "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") <= 1  # one row a partition
    assert ranked(df.limit(0), "place", "id").count() == 0


def test_rates_regions_and_savings(spark):
    done = spark.createDataFrame([("r", 30, 100, 60.0), ("s", 0, 5, 0.0)], "run string, done int, jobs int, minutes double")
    assert sorted(tuple(r)[4:] for r in runs.remaining(done, "run", "jobs", "minutes").filter("done > 0").collect()) == [(30.0, 140.0)]
    assert runs.remaining(done, "run", "jobs", "minutes").filter("done = 0").first().minutes_left is None
    areas = spark.createDataFrame([("a", 1.0), ("b", 5.0), ("c", 3.0), ("d", 5.0)], "region string, area double")
    assert [r.region for r in regions.largest_first(areas, "area", 2.0, 2).collect()] == ["b", "d"]
    ratio, saved = radiometry.saved_share(F.lit(200), F.lit(50))
    assert tuple(spark.range(1).select(ratio, saved).first()) == (0.25, 0.75)


def test_streams_of_results_and_counters(spark, tmp_path):
    rows = [("eth0", n, c) for n, c in enumerate([5, 9, 9, 4, 20])]
    spark.createDataFrame(rows, "device string, n long, counter long").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("device string, n long, counter long").parquet(str(tmp_path / "in"))
    seen = []
    q = streams.counter_totals(stream).writeStream.outputMode("update").foreachBatch(lambda df, n: seen.extend(df.collect())).option("checkpointLocation", str(tmp_path / "cp1")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [tuple(r) for r in seen] == [("eth0", 20, 16, 5)]
    got = []
    streams.on_results(stream, lambda df, n: got.extend(df.collect()), str(tmp_path / "cp2"), once=True).awaitTermination(120)
    assert len(got) == 5


def test_rebuilding_and_filling(spark):
    wanted = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "tile string, fp string")
    built = spark.createDataFrame([("a", "1"), ("b", "9")], "tile string, fp string")
    assert sorted(r.tile for r in streams.rebuild(wanted, built, "tile", lambda df: df).collect()) == ["b", "c"]
    cells = spark.range(6)
    plan = lambda gaps: (cells if gaps is None else gaps).orderBy("id").limit(2)
    picks = streams.fill_gaps(plan, lambda p: cells.join(p, "id", "left_anti"), rounds=2)
    assert sorted(r.id for r in picks.collect()) == [0, 1, 2, 3, 4, 5]


@pytest.mark.parametrize("number", [1])
def test_upserts_rewrite_only_their_buckets(spark, tmp_path, number):
    write = streams.upsert_sink("v", ["k"], str(tmp_path))
    write(spark.range(200).selectExpr("id as k", "0 as v"), 0)
    write(spark.createDataFrame([(7, 5)], "k long, v int"), number)
    have = streams.versions(spark, str(tmp_path))
    assert len(have) > 20 and sum(number in v for v in have.values()) == 1
    assert {r.k: r.v for r in streams.latest_version(spark, str(tmp_path)).collect()} == {k: 5 * (k == 7) for k in range(200)}


def test_polar_grid(spark):
    g = spark.range(1).select(grids.polar_grid(F.lit(3413), F.lit(1_000_100.0), 500.0, 1.0).alias("g")).first().g
    assert (g.epsg, g.x0, g.y0, g.nx, g.ny) == (3413, -1_001_500.0, -1_001_500.0, 4006, 4006)
