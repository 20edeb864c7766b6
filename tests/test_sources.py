"""Round trips of readers and writers, range files, settings and streams."""

import io
import json
import sys
import urllib.error

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from mosaicflow.plans.config import RunConfig
from mosaicflow.sources import files, kml, remote, sinks
from mosaicflow.streaming import streams


def feature(props, coords, kind="Polygon"):
    return {"type": "Feature", "properties": props, "geometry": None if coords is None else {"type": kind, "coordinates": coords}}


RING = [[[0, 0], [2, 0], [2, 1], [0, 1], [0, 0]]]


def test_catalogue_and_footprints(spark, tmp_path):
    (tmp_path / "c.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [feature({"name": "a", "url": "u"}, RING), feature({"name": "b"}, [RING], "MultiPolygon")]}, indent=1))
    rows = files.read_catalogue(spark, str(tmp_path / "c.geojson")).withColumn("b", files.bounds(F.col("geom"))).orderBy("ordinal").collect()
    assert [(r.name, r.url, len(r.geom), r.b.x1, r.b.y1) for r in rows] == [("a", "u", 1, 2.0, 1.0), ("b", "", 1, 2.0, 1.0)]
    for n, frac in (("v1", 0.2), ("v2", 0.9)):
        (tmp_path / f"{n}.geojson").write_text(json.dumps({"features": [feature({"name": "a", "validFrac": frac}, RING if n == "v1" else None)]}))
    v = files.read_valid_footprints(spark, [str(tmp_path / "v1.geojson"), str(tmp_path / "v2.geojson")]).collect()
    assert [(x.name, x.valid_frac, x.geom) for x in v] == [("a", 0.9, None)]


def test_picks_and_jobs_round_trip(spark, tmp_path):
    rows = [("T1", i, f"g{i}", "u", "A", "DH" if i % 2 else "SV", 40, "A", i == 3, 10 - i) for i in range(5)]
    picks = spark.createDataFrame(rows, "tile string, seq int, name string, url string, freq string, pol string, bw int, direction string, mixed boolean, new_cells int")
    sinks.write_picks(picks, str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out/picks"))
    assert back.count() == 5 and set(back.columns) >= {"name", "bwMHz", "newCells", "tile"}
    jobs = {r.names[0]: r for r in files.read_jobs(spark, str(tmp_path / "out/jobs/*")).collect()}
    assert jobs["g0"].names == ["g0", "g2", "g4"] and "polarization: VV" in jobs["g0"].settings
    one = tmp_path / "csv"
    one.mkdir()
    (one / "N00E000_6x6.csv").write_text("name,url,freq,pol,bwMHz,direction,mixed,newCells\nx,u,A,SH,20,A,0,7\ny,u,B,SV,5,D,1,0\n")
    got = files.read_picks(spark, str(one)).orderBy("seq").collect()
    assert [(r.tile, r.seq, r.name, r.bwMHz, r.mixed) for r in got] == [("N00E000_6x6", 0, "x", 20, False), ("N00E000_6x6", 1, "y", 5, True)]


def test_features_and_documents(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), ("b", None)], "name string, area double").withColumn("geom", F.when(F.col("name") == "a", sinks.box_polygon(F.lit(0), F.lit(0), F.lit(2), F.lit(1))))
    got = [json.loads(r.v) for r in df.select(sinks.feature(["name", "area"], F.col("geom")).alias("v")).collect()]
    assert got[0]["geometry"] == {"type": "Polygon", "coordinates": RING} and got[1]["geometry"] is None and got[1]["properties"] == {"name": "b", "area": None}
    levels = spark.createDataFrame([(1, 0, 0), (2, 0, 1), (2, 1, 0)], "z int, x long, y long")
    docs = {r.path: r.text for r in sinks.superoverlay(levels, "A & B").collect()}
    assert docs["1/0/0.kml"].count("NetworkLink>") == 4 and "A &amp; B" in docs["1/0/0.kml"]
    (tmp_path / "1.kml").write_text("<kml><name>x</name><name>y</name>\n<GroundOverlay><drawOrder>3</drawOrder><href>1.png</href><north>2</north><south>1</south><east>4</east><west>3</west></GroundOverlay></kml>")
    o = kml.read_overlays(spark, str(tmp_path / "1.kml")).collect()
    assert (o[0].href, o[0].north, o[0].draw_order) == ("1.png", 2.0, 3)
    text = spark.read.text(str(tmp_path / "1.kml"), wholetext=True).select(kml.retitle(F.col("value"), "new").alias("t")).first().t
    assert "<name>new</name><name>y</name>" in text
    lifted = kml.lift(kml.read_overlays(spark, str(tmp_path / "1.kml")).withColumn("kind", F.lit("split"))).first().text
    assert lifted.count("<GroundOverlay>") == 2 and lifted.count("<altitude>") == 1 and "1.sea.png" in lifted
    tiles = kml.read_overlays(spark, str(tmp_path / "1.kml")).withColumn("kind", F.lit("split"))
    plain = kml.lift(tiles.withColumn("kind", F.lit("land"))).first().text
    assert kml.unlift(kml.lift(tiles)).first().text == plain and "altitude" not in plain


def test_remote_file_reads_runs_of_blocks():
    data, asked = bytes(range(256)) * 40, []

    def get(url, first, last):
        asked.append((url, first, last))
        if len(asked) == 1:
            raise OSError("try again")
        if url != "u?2":
            raise urllib.error.HTTPError(url, 403, "expired", None, None)
        return data[first : last + 1]

    signs = iter("12")
    store = remote.BlockStore("u", len(data), get, sign=lambda u: f"{u}?{next(signs)}", block=100, per_request=3, workers=1)
    store.need([(0, 100), (120, 100), (900, 10), (-0, 0)])
    assert [x[1:] for x in asked] == [(0, 299)] * 3 + [(900, 999)] and sorted(store.have) == [0, 1, 2, 9]
    f = remote.RemoteFile(store)
    f.seek(90)
    assert io.BufferedReader(f, 16).read(60) == data[90:150] and len(asked) == 4
    f.seek(-5, 2)
    assert f.read(99) == data[-5:] and f.read(1) == b""
    f.seek(300)
    assert f.read(1000) == data[300:1300] and [x[1:] for x in asked[5:]] == [(300, 599), (600, 899), (1000, 1299)]
    assert remote.window_blocks((1000, 1000), 512, (500, 600, 0, 10)) == [(0, 512, 0, 512), (512, 1000, 0, 512)]


class StandIn:
    """What the reader uses of an HDF5 file: one chunked float dataset whose rows of chunks follow a header."""

    HEADER, HIGH, WIDE, SHAPE = 1000, 4, 8, (10, 16)

    def __init__(self, f):
        self.f, self.shape, self.chunks, self.id = f, self.SHAPE, (self.HIGH, self.WIDE), self

    def __enter__(self):
        return self

    def __exit__(self, *_):
        return None

    def get_chunk_info_by_coord(self, at):
        import types

        return types.SimpleNamespace(byte_offset=self.HEADER + (at[0] // self.HIGH * 2 + at[1] // self.WIDE) * self.HIGH * self.WIDE * 4, size=self.HIGH * self.WIDE * 4)

    @classmethod
    def write(cls, array):
        full = np.zeros((12, 16), dtype=np.float32)
        full[:10] = array
        return b"h" * cls.HEADER + b"".join(full[i : i + 4, j : j + 8].tobytes() for i in (0, 4, 8) for j in (0, 8))

    def __getitem__(self, key):
        if isinstance(key, str):
            return self
        full = np.zeros((12, 16), dtype=np.float32)
        rows, cols = key
        for i in range(rows.start // 4 * 4, rows.stop, 4):
            for j in range(cols.start // 8 * 8, cols.stop, 8):
                info = self.get_chunk_info_by_coord((i, j))
                self.f.seek(info.byte_offset)
                full[i : i + 4, j : j + 8] = np.frombuffer(self.f.read(info.size), dtype=np.float32).reshape(4, 8)
        return full[:10][key]


def test_array_blocks_over_ranges(monkeypatch):
    array = np.arange(160, dtype=np.float32).reshape(10, 16)
    array[3, 3] = np.nan
    data, sent = StandIn.write(array), []

    def get(url, first, last):
        sent.append(last - first + 1)
        return data[first : last + 1]

    def cells(**options):
        reader = remote._ArrayReader({"files": "https://x/a.h5", "layers": "v", **{k: str(v) for k, v in options.items()}}, StandIn, lambda u: len(data), get)
        out = {}
        for batch in reader.read(reader.partitions()[0]):
            (r,) = batch.to_pylist()
            at = lambda k, step: -(-k // step) * step
            stride = options.get("stride", 1)
            for n, v in enumerate(r["values"]):
                out[at(r["row0"], stride) + n // r["cols"] * stride, at(r["col0"], stride) + n % r["cols"] * stride] = v
        return out

    plain = lambda rows, cols: {(i, j): None if np.isnan(array[i, j]) else array[i, j] for i in rows for j in cols}
    monkeypatch.setattr(remote.BlockStore.__init__, "__defaults__", (remote.http_bytes, None, 64, 64, 8, 4))
    assert cells(block=5) == plain(range(10), range(16))
    assert cells(block=5, stride=3) == plain(range(0, 10, 3), range(0, 16, 3))
    sent.clear()
    assert cells(block=4, r0=4, r1=8, c0=0, c1=4) == plain(range(4, 8), range(4))
    assert sum(sent) <= 128 + 2 * 64  # one chunk of six, in whole blocks


def test_array_blocks_of_local_files(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(StandIn.write(np.arange(160).reshape(10, 16)))

    class Local(remote.ArrayBlocks):
        opener = staticmethod(lambda path: StandIn(open(path, "rb", buffering=0)))

    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import this file
    spark.dataSource.register(Local)
    got = spark.read.format("array-blocks").option("files", str(tmp_path / "a.bin")).option("layers", "v").option("block", 8).load()
    assert sorted((r.row0, r.col0, r.rows, r.cols) for r in got.collect()) == [(0, 0, 8, 8), (0, 8, 8, 8), (8, 0, 2, 8), (8, 8, 2, 8)]
    assert got.selectExpr("sum(aggregate(values, 0D, (s, x) -> s + x))").first()[0] == 159 * 80
    both = f"{tmp_path / 'a.bin'},{tmp_path / 'gone.bin'}"
    rows = spark.read.format("array-blocks").option("files", both).option("layers", "v").option("errors", "column").load().collect()
    assert [(r.file, r.rows, r.cols) for r in rows if not r.error] == [(str(tmp_path / "a.bin"), 10, 16)]
    assert [(r.file, r.error.split(":")[0]) for r in rows if r.error] == [(str(tmp_path / "gone.bin"), "FileNotFoundError")]


def test_search_reads_its_cache(spark, tmp_path):
    (tmp_path / "cycle031.json").write_text(json.dumps({"features": [feature({"name": "n", "url": "u"}, RING)]}))
    remote.register(spark)
    got = spark.read.format("catalogue-search").option("cycles", "31").option("cache", str(tmp_path)).option("endpoint", "none").load().collect()
    assert [(r.cycle, r.name, r.url) for r in got] == [(31, "n", "u")]


def test_settings():
    c = RunConfig.resolve({"res": 0.5, "title": "a"}, {"title": "b"})
    assert (c.res, c.title, c.record()["tile_size"]) == (0.5, "b", 512)
    with pytest.raises(ValueError, match="colour"):
        RunConfig.resolve({"colour": 1})


def test_streams(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    rows = [(1, 0, "01-01 00:00:00 5 tiles (5 jobs)"), (1, 1, "01-01 00:01:00 T1.AHH: 1.0 min FAILED"), (1, 2, "01-01 00:02:00 T1.AHH: 1.0 min OK"), (1, 3, "01-01 00:03:00 T2.BVV: 2.0 min FAILED")]
    spark.createDataFrame(rows, "run long, n long, line string").coalesce(1).write.parquet(str(source))
    stream = spark.readStream.schema("run long, n long, line string").parquet(str(source))
    seen = []
    query = streams.job_states(stream).writeStream.outputMode("update").foreachBatch(lambda df, n: seen.extend(df.collect())).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert {(r.tile, r.status) for r in seen} == {("T1", "OK"), ("T2", "FAILED")}
    write = streams.upsert_sink("v", ["k"], str(out))
    for n, values in enumerate([[("a", 1), ("b", 2)], [("a", 3)], [("a", 3)]]):
        write(spark.createDataFrame(values, "k string, v int"), min(n, 1))
    assert sorted((r.k, r.v) for r in streams.latest_version(spark, str(out)).collect()) == [("a", 3), ("b", 2)]


def test_cycle_windows_meet_late_rows(spark, tmp_path):
    rows = [("2024-01-01", "f", 1), ("2024-01-05", "f", 2), ("2024-01-20", "f", 4)]
    df = spark.createDataFrame(rows, "d string, frame string, v int").select(F.to_timestamp("d").alias("t"), "frame", "v")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    got = []
    q = streams.cycle_windows(stream, "t", ["frame"], "v").writeStream.outputMode("update").foreachBatch(lambda b, n: got.extend(b.collect())).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sum(r.total for r in got) == 7 and max(r.n for r in got) == 2
