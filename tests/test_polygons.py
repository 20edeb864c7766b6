"""Polygon operators against plain loops."""

import math
import random

import pytest

from mosaicflow.__main__ import main
from mosaicflow.operators import polygons, regions, spatial
from mosaicflow.sources.files import read_bands

SHAPE = "id int, rings array<array<struct<x:double,y:double>>>"


def ring(points):
    return [{"x": float(x), "y": float(y)} for x, y in [*points, points[0]]]


def star(r, middle, most, n):
    """A ring that sees its middle; none of it is nearer than a quarter of `most`."""
    corners = [((k + r.uniform(-0.1, 0.1)) * 2 * math.pi / n, most * r.uniform(0.5, 1)) for k in range(n)]
    return [(middle[0] + d * math.cos(t), middle[1] + d * math.sin(t)) for t, d in corners]


def inside(shape, x, y):
    odd = False
    for points in shape:
        for (ax, ay), (bx, by) in zip(points, points[1:] + points[:1], strict=True):
            if (ay > y) != (by > y) and x < ax + (bx - ax) * (y - ay) / (by - ay):
                odd = not odd
    return odd


def passes(a, b, x, y):
    """Whether a segment goes through the inside of the unit square at (x, y): clipped by its four sides, some is left."""
    low, high = 0.0, 1.0
    for start, step, edge in ((a[0], b[0] - a[0], x), (a[1], b[1] - a[1], y)):
        if step == 0:
            if not edge < start < edge + 1:
                return False
            continue
        ends = sorted(((edge - start) / step, (edge + 1 - start) / step))
        low, high = max(low, ends[0]), min(high, ends[1])
    return low < high


def shapes():
    r = random.Random(7)
    out = {}
    for i in range(12):
        middle = (r.uniform(-9, 9), r.uniform(-9, 9))
        out[i] = [star(r, middle, 8, r.randint(4, 9))] + ([star(r, middle, 1.5, 4)] if i % 2 else [])
    out[12] = [[(0, 0), (4, 0), (4, 4), (0, 4)], [(1, 1), (3, 1), (3, 3), (1, 3)]]  # sides on the lattice
    out[13] = [[(0.5, 0.5), (3.5, 0.5), (3.5, 2.5), (0.5, 2.5)]]  # sides through centres
    out[14] = [[(0.1, 0.1), (0.2, 0.1), (0.2, 0.2)]]  # within a cell, without its centre
    return out


@pytest.mark.parametrize("touched", [False, True])
def test_cells_of_polygons(spark, touched):
    data = shapes()
    df = spark.createDataFrame([(i, [ring(p) for p in s]) for i, s in data.items()] + [(90, None), (91, [])], SHAPE)
    got = [(r.id, r.cx, r.cy) for r in polygons.polygon_cells(df, ["id"], 1.0, touched).collect()]
    want = set()
    for i, s in data.items():
        for x in range(-20, 20):
            for y in range(-20, 20):
                sides = [(a, b) for p in s for a, b in zip(p, p[1:] + p[:1], strict=True)]
                if inside(s, x + 0.5, y + 0.5) or touched and any(passes(a, b, x, y) for a, b in sides):
                    want.add((i, x, y))
    assert len(got) == len(set(got)) and set(got) == want
    assert any(i == 14 for i, _, _ in got) == touched


def test_boxes_as_polygons_give_the_cells_of_boxes(spark):
    r = random.Random(3)
    boxes = [(i, x, y, x + r.choice([0.5, 2.0, 3.25]), y + r.choice([0.5, 1.0, 2.75])) for i in range(30) for x, y in [(r.randint(-8, 8) / 4, r.randint(-8, 8) / 4)]]
    b = spark.createDataFrame(boxes, "id int, x0 double, y0 double, x1 double, y1 double")
    p = spark.createDataFrame([(i, [ring([(x0, y0), (x1, y0), (x1, y1), (x0, y1)])]) for i, x0, y0, x1, y1 in boxes], SHAPE)
    for touched in (True, False):
        want = {(x.id, x.cx, x.cy) for x in spatial.box_cells(b, 1.0, touched).collect()}
        assert {(x.id, x.cx, x.cy) for x in polygons.polygon_cells(p, ["id"], 1.0, touched).collect()} == want


def test_split_keeps_area_and_holes(spark):
    shifted = lambda s, d: [[(x + d, y) for x, y in p] for p in s]
    wrapped = lambda s: [[(x - 360 if x > 180 else x, y) for x, y in p] for p in s]
    base = {i: s for i, s in shapes().items() if i < 12}
    run_past = {i: shifted(s, 180) for i, s in base.items()}
    rows = [(i, [ring(p) for p in s]) for i, s in run_past.items()] + [(100 + i, [ring(p) for p in wrapped(s)]) for i, s in run_past.items()]
    rows += [(200, None), (201, []), (202, [ring([(-170, 0), (170, 0), (170, 5), (-170, 5)])]), (203, [ring([(-100, 0), (0, 0), (100, 0), (100, 5), (-100, 5)])])]
    df = spark.createDataFrame(rows, SHAPE)
    pieces = polygons.split_polygons(df).select("id", polygons.polygon_area("rings").alias("a"), polygons.extent(polygons.F.flatten("rings")).alias("e")).collect()
    assert all(-180 <= p.e.west < p.e.east <= 180 for p in pieces)
    area = lambda i: sum(p.a for p in pieces if p.id == i)
    plain = lambda p: abs(sum(ax * by - bx * ay for (ax, ay), (bx, by) in zip(p, p[1:] + p[:1], strict=True))) / 2
    for i, s in base.items():
        want = plain(s[0]) - sum(plain(p) for p in s[1:])
        assert area(i) == pytest.approx(want) and area(100 + i) == pytest.approx(want)
    assert not [p for p in pieces if p.id in (200, 201)]
    assert [area(202), area(203)] == [100, 1000]  # the short way round, unless that is wide too


def test_inner_points_and_centroids(spark):
    data = shapes()
    df = spark.createDataFrame([(i, [ring(p) for p in s]) for i, s in data.items()] + [(91, []), (92, [ring([(1, 1), (2, 2), (3, 3)])])], SHAPE)
    got = {r.id: r for r in df.select("id", polygons.inner_point(polygons.F.col("rings")).alias("p"), polygons.centroid(polygons.F.col("rings")).alias("c")).collect()}
    assert all(inside(s, got[i].p.x, got[i].p.y) for i, s in data.items())
    assert (got[12].c.x, got[12].c.y) == (2, 2)
    assert got[91].p is None and got[91].c is None and got[92].c is None


@pytest.mark.parametrize("seed", range(4))
def test_outlines_enclose_their_cells(spark, seed):
    r = random.Random(seed)
    cells = {(i, j) for i in range(14) for j in range(14) if r.random() < 0.55}
    df = spark.createDataFrame([("a", i, j) for i, j in cells] * 2, "k string, row long, col long")
    labelled = regions.regions(df, "k", eight=False, block=5)
    out = polygons.outlines_of_cells(labelled, ["k", "region"])
    assert out.count() == labelled.select("region").distinct().count()
    back = polygons.polygon_cells(out, ["region"], 1.0, touched=False).collect()
    assert {(x.region, x.cy, x.cx) for x in back} == {(x.region, x.row, x.col) for x in labelled.collect()}
    signed = lambda p: sum(a.x * b.y - b.x * a.y for a, b in zip(p, p[1:], strict=False))
    for x in out.collect():
        assert [signed(p) > 0 for p in x.rings] == [True] + [False] * (len(x.rings) - 1)
    assert polygons.outlines_of_cells(df.filter("false"), ["k"]).count() == 0


def test_nearest_box_by_plain_loop(spark):
    r = random.Random(5)
    boxes = [(i, f"b{i}", float(x), float(y), x + r.choice([0.0, 3.0, 20.0]), y + r.choice([0.0, 5.0])) for i in range(25) for x, y in [(r.randint(-180, 150), r.randint(-80, 70))]]
    points = [(i, r.uniform(-180, 180), r.uniform(-90, 90)) for i in range(60)]
    got = spatial.nearest_box(spark.createDataFrame(points, "pid int, x double, y double"), spark.createDataFrame(boxes, "id int, name string, u0 double, v0 double, u1 double, v1 double"), 5.0, ["name"], "id").collect()
    away = lambda x, y, b: math.hypot(max(b[2] - x, x - b[4], 0), max(b[3] - y, y - b[5], 0))
    assert {g.pid: g.name for g in got} == {i: min(boxes, key=lambda b: (away(x, y, b), b[0]))[1] for i, x, y in points}


def test_band_tables(tmp_path):
    path = tmp_path / "bands.json"
    path.write_text("[[0, 10, 5, 20, 2], [-10, 0, 5, 10, 1]]")
    assert read_bands(str(path)) == [(-10, 0, 5, 10, 1), (0, 10, 5, 20, 2)]
    for bad in ("[[0, 10, 5, 7, 2]]", "[[0, 10, 3, 20, 2]]", "[[0, 10, 5, 20, 2], [5, 15, 5, 20, 2]]"):
        path.write_text(bad)
        with pytest.raises(ValueError, match="band"):
            read_bands(str(path))


def test_console(spark, tmp_path, capsys):
    assert main(["list"]) == 0 and "polygon_measures" in capsys.readouterr().out.split()
    assert main(["sql", "polygon_measures"]) == 0 and "diamonds" in capsys.readouterr().out
    assert main(["run", "polygon_measures", "/root/testdata/sf0.001", "--out", str(tmp_path / "o")]) == 0
    assert spark.read.parquet(str(tmp_path / "o")).count() == 25
    with pytest.raises(SystemExit):
        main(["run", "nothing", "x"])
