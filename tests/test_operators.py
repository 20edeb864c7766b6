"""Procedural operators against plain loops, and the invariants that hold whatever the data."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mosaicflow.functions import grids, names, radiometry
from mosaicflow.operators import catalogue, cover, raster, regions, runs, spatial, stats


def plain_cover(masks, fill, bw, mixed, forced, cells, share, target):
    """The rule in its words: forced picks first, as they come. Then tier by tier, main catalogues before fill-ins and wide
    bands before narrow ones: take whichever observation opens most cells, half a cell less for mixed ones, of equals the
    last with unmixed ones before mixed ones, until none opens enough (a share of all cells; four where gaps are filled)."""
    everything = set(range(cells))
    open_cells = everything | set().union(*masks)
    picks = []

    def take(k):
        picks.append((k, len(open_cells & masks[k])))
        open_cells.difference_update(masks[k])

    for k in forced:
        take(k)
    enough = 4 if target is not None else max(1, int(share * cells))
    if target is not None:
        open_cells.clear()
        open_cells.update(target)
    free = [k for k in range(len(masks)) if k not in forced]
    for tier in sorted({(fill[k], -bw[k]) for k in free}):
        own = [k for flag in (False, True) for k in free if (fill[k], -bw[k]) == tier and bool(mixed[k]) is flag]
        gain = lambda k: len(open_cells & masks[k]) - 0.5 * bool(mixed[k])
        while own and max(map(gain, own)) >= enough:
            best = max(map(gain, own))
            choice = next(k for k in reversed(own) if gain(k) == best)
            own.remove(choice)
            take(choice)
    return picks


@pytest.mark.parametrize("seed", range(30))
def test_greedy_cover(seed):
    r = random.Random(seed)
    n, cells = r.randint(1, 12), 60
    masks = [set(r.sample(range(cells), r.randint(0, 25))) for _ in range(n)]
    fill, bw, mixed = [r.randint(0, 1) for _ in range(n)], [r.choice([5, 20, 40]) for _ in range(n)], [r.random() < 0.3 for _ in range(n)]
    forced = r.sample(range(n), r.randint(0, min(2, n)))
    target = set(r.sample(range(cells), 20)) if seed % 3 == 0 else None
    dense = np.zeros((n, cells), dtype=bool)
    for k, m in enumerate(masks):
        dense[k, list(m)] = True
    flags = None if target is None else np.isin(np.arange(cells), list(target))
    got = cover.greedy(dense, np.array(fill), np.array(bw), np.array(mixed), forced, cells, 0.03, flags)
    assert got == plain_cover(masks, fill, bw, mixed, forced, cells, 0.03, target)
    if target is None and not forced:
        assert sum(c for _, c in got) == len(set().union(*[masks[k] for k, _ in got] or [set()]))


def test_greedy_cover_query_against_plain_loop(spark, tmp_path):
    from mosaicflow.plans.spatial_queries import greedy_cover

    keys = range(1, 400)
    spark.createDataFrame([(k, k) for k in keys], "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    got = {}
    for r in greedy_cover(spark, str(tmp_path)).collect():
        got.setdefault(r.tile, []).append((r.seq, r.name, r.new_cells))
    cells = {}
    for k in keys:
        left, low = k * 37 % 360 - 180, k * 53 % 150 - 75
        cells[k] = {((x + 360) % 720 - 360, y) for x in range(2 * left, 2 * (left + 3 + k % 4)) for y in range(2 * low, 2 * (low + 3 + k % 3))}
    want, places, small = {}, set(), 0
    for name, x0, y0, x1, y1, *_ in spatial.lonlat_tiles(spark).collect():
        inside = {k: {(x, y) for x, y in cells[k] if 2 * x0 <= x < 2 * x1 and 2 * y0 <= y < 2 * y1} for k in keys}
        masks = {k: m for k, m in inside.items() if m}
        ks = sorted(masks)
        fill, bw, mixed = [k % 2 for k in ks], [(77, 40, 20, 5)[k % 4] for k in ks], [k % 11 == 0 for k in ks]
        forced = [i for i, k in enumerate(ks) if k % 97 == 0]
        picks = plain_cover([masks[k] for k in ks], fill, bw, mixed, forced, 4 * (x1 - x0) * (y1 - y0), 0.001, None)
        if picks:
            want[name] = [(n, str(ks[i]), new) for n, (i, new) in enumerate(picks)]
            places |= {(x0, y0)}
            small += any(new < int(0.08 * (x1 - x0) * (y1 - y0)) for i, new in picks if i not in forced)
    assert {t: sorted(rows) for t, rows in got.items()} == want
    assert any(x < -60 or x >= 60 or y < -30 or y >= 30 for x, y in places)
    assert small


def test_cover_by_tile(spark):
    rows = [(t, f"g{k}", k, 0, 20 if k % 2 else 40, False, None, c, 100, None) for t in ("a", "b") for k in range(6) for c in range(k * 7, k * 7 + 10)]
    df = spark.createDataFrame(rows, "tile string, name string, ordinal int, fill int, bw int, mixed boolean, forced double, cell long, n_cells long, target boolean")
    got = cover.cover(df, 0.02).collect()
    assert {r.tile for r in got} == {"a", "b"}
    for t in ("a", "b"):
        assert sum(r.new_cells for r in got if r.tile == t) == 45
    assert cover.cover(df.limit(0)).count() == 0


def test_greedy_cover_query_with_equal_candidates(spark, tmp_path, monkeypatch):
    """More footprints of the same places and tiers bring the cover no more rows, and the picks are those of all candidates."""
    from mosaicflow.plans import adapters, spatial_queries

    keys = [base + 19800 * turn for base in range(200) for turn in range(1, 6)]  # one place, tier and mode a base
    spark.createDataFrame([(k, k) for k in keys], "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    given = []
    monkeypatch.setattr(spatial_queries.V, "cover", lambda c, f=cover.cover: (given.append(c), f(c))[1])
    got = sorted(map(tuple, spatial_queries.greedy_cover(spark, str(tmp_path)).collect()))
    f = spatial.split_antimeridian(adapters.footprints(spark, str(tmp_path))).selectExpr("k", "x0 as u0", "y0 as v0", "x1 as u1", "y1 as v1")
    pairs = spatial.box_join(spatial.lonlat_tiles(spark).withColumn("n_cells", F.expr("cast((x1 - x0) * (y1 - y0) * 4 as long)")), f, 6.0)
    box = pairs.select("name", "k", "n_cells", F.greatest("x0", "u0").alias("x0"), F.greatest("y0", "v0").alias("y0"), F.least("x1", "u1").alias("x1"), F.least("y1", "v1").alias("y1"))
    rows = spatial.box_cells(box, 0.5).selectExpr("name as tile", "cast(k as string) as name", "k as ordinal", "int(k % 2) as fill", "array(77, 40, 20, 5)[int(k % 4)] as bw", "k % 11 = 0 as mixed", "cast(if(k % 97 = 0, k, null) as double) as forced", "cx * 1000 + cy as cell", "n_cells", "cast(null as boolean) as target")
    assert got == sorted(map(tuple, cover.cover(rows).collect()))
    assert len(got) > 200 and {k for k in keys if k % 97 == 0} <= {int(r[2]) for r in got}
    candidates = {k for k in keys if k % 97 == 0} | {max(k for k in keys if k % 19800 == base and k % 97) for base in range(200)}
    assert given[0].select("name").distinct().count() == len(candidates) < len(keys) / 4
    assert given[0].count() == pairs.filter(F.col("k").isin(*candidates)).count()


@pytest.mark.parametrize("seed", range(3))
def test_cover_of_arrays_and_of_last_of_equals(spark, seed):
    """Arrays of cells stand for rows of cells, and candidates that equal a later one of their tier change no pick."""
    r = random.Random(seed)
    shapes = [sorted(r.sample(range(40), r.randint(1, 15))) for _ in range(6)]
    open_cells = set(r.sample(range(40), 25))
    rows = [(t, f"g{k}", k, r.randint(0, 1), r.choice([20, 40]), r.random() < 0.3, float(9 - k) if k in (3, 8) else None, r.choice(shapes), 60) for t in "ab" for k in range(30)]
    df = spark.createDataFrame(rows, "tile string, name string, ordinal long, fill int, bw int, mixed boolean, forced double, cell array<long>, n_cells long")
    for gaps in (False, True):
        flat = df.withColumn("cell", F.explode("cell")).withColumn("target", F.col("cell").isin(*open_cells) if gaps else F.lit(None).cast("boolean"))
        want = sorted(map(tuple, cover.cover(flat, 0.05).collect()))
        last = cover.last_of_equals(df, ["tile", "cell", "n_cells"]).withColumn("name", F.format_string("g%d", "ordinal"))
        assert last.count() < len(rows)
        arrays = lambda d, g=gaps: d.withColumn("target", F.lit(True)).withColumn("cell", F.array_intersect("cell", F.lit(sorted(open_cells)))).unionByName(d.withColumn("target", F.lit(False)).withColumn("cell", F.array_except("cell", F.lit(sorted(open_cells))))) if g else d.withColumn("target", F.lit(None).cast("boolean"))
        assert sorted(map(tuple, cover.cover(arrays(df), 0.05).collect())) == want
        assert sorted(map(tuple, cover.cover(arrays(last), 0.05).collect())) == want


@pytest.mark.parametrize("eight", [True, False])
def test_regions_across_blocks(spark, eight):
    r = np.random.default_rng(5)
    grid = r.random((40, 40)) < 0.5
    cells = [("t", int(i), int(j)) for i, j in zip(*np.nonzero(grid), strict=True)]
    got = {(x.row, x.col): x.region for x in regions.regions(spark.createDataFrame(cells, "tile string, row long, col long"), "tile", eight, block=7).collect()}
    want, seen = {}, set()
    for _, i, j in sorted(cells):
        if (i, j) in seen:
            continue
        todo, own = [(i, j)], []
        seen.add((i, j))
        while todo:
            a, b = todo.pop()
            own.append((a, b))
            for da in (-1, 0, 1):
                for db in (-1, 0, 1):
                    c = (a + da, b + db)
                    if (eight or da == 0 or db == 0) and c in got and c not in seen:
                        seen.add(c)
                        todo.append(c)
        for c in own:
            want[c] = min(a * (1 << 32) + b for a, b in own)
    assert got == want


def test_nearest_place_far_away(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 150.0, 60.0), (3, -179.0, 0.0)], "pid long, x double, y double")
    places = spark.createDataFrame([(9, "a", 3.0, 4.0), (4, "b", -3.0, 4.0), (7, "c", 170.0, 0.0)], "place_id long, place string, px double, py double")
    got = {r.pid: (r.place, r.d) for r in spatial.nearest(points, places, 2.0, ["place"]).collect()}
    assert got[1] == ("b", 5.0)
    assert got[2][0] == "c" and got[3][0] == "b"


def test_first_of_equal_versions(spark):
    names_ = ["NISAR_L2_PR_GCOV_030_001_A_001_2005_DHNA_N_s_t_P00005_N_F_J_001"] * 2 + ["NISAR_L2_PR_GCOV_030_001_A_001_2005_DHNA_N_s_t_X00009_N_F_J_001"]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names_)], "name string, k long")
    assert [r.k for r in catalogue.best_versions(df, "k").collect()] == [0]


def test_pair_names(spark):
    n = "NISAR_L2_PR_GUNW_030_134_A_142_031_4000_SH_a_b_c_d_P05023_N_P_J_001"
    df = spark.createDataFrame([(n,), ("x_y",)], "name string")
    row = names.parse_name(df).select("*", names.frame_key(F.col("name")).alias("fk"), names.scene_key(F.col("name")).alias("s")).collect()
    assert len(row) == 1 and (row[0].bw, row[0].freq, row[0].mixed, row[0].fk) == (40, "A", False, "134_142_4000")
    assert row[0].s == "_".join(n.split("_")[:15])
    assert df.select(names.is_partial(F.col("name")).alias("p")).collect()[1].p is False


def test_one_cycle_has_no_spread(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 1, 13), ("b", 1, 4), ("b", 2, 8), ("b", 3, 12)], "k string, c int, v long")
    got = {r.k: r for r in stats.temporal_statistics(df, ["k"], "c", "v", min_count=1).collect()}
    assert (got["a"].n, got["a"].sigma, got["a"].mean) == (1, 0.0, 1150.0)
    assert got["b"].sigma == pytest.approx(400.0) and got["b"].cv == pytest.approx(0.5)
    assert stats.temporal_statistics(df, ["k"], "c", "v").filter("k = 'a'").first().mean is None


def test_rounding_is_to_even(spark):
    df = spark.createDataFrame([(0.005,), (0.015,), (None,), (-0.025,)], "v double")
    got = [r.x for r in df.select(radiometry.from_db(F.col("v")).alias("x")).collect()]
    assert got == [0, 2, radiometry.NO_DATA, -2]


def test_mean_of_means_by_counts(spark):
    r = random.Random(1)
    df = spark.createDataFrame([(i, j, r.choice([None, r.randint(0, 99)])) for i in range(16) for j in range(16)], "row long, col long, v long")
    two = raster.block_mean(df, 2, [], ["v"])
    four = {(x.row, x.col): x.v for x in raster.block_mean(df, 4, [], ["v"]).collect()}
    up = two.groupBy((F.floor(F.col("row") / 2)).alias("row"), F.floor(F.col("col") / 2).alias("col")).agg((F.sum("v_sum") / F.sum("v_n")).alias("v")).collect()
    assert {(x.row, x.col): pytest.approx(x.v) for x in up} == four


def test_projections(spark):
    df = spark.createDataFrame([(0.0, 0.0), (45.0, 70.0), (-45.0, 70.0), (180.0, 0.0)], "lon double, lat double")
    lon, lat = F.col("lon"), F.col("lat")
    got = df.select(grids.polar_equal_area(lon, lat).alias("n"), grids.cylindrical_equal_area(lon, lat).alias("g"), grids.polar_stereographic(lon, lat, 70, -45, True).alias("s"), grids.equal_earth(lon, lat).alias("e")).collect()
    assert abs(got[0].n.y + 9009964.76) < 0.01 and got[0].n.x == 0
    assert abs(got[3].g.x - 17367530.45) < 0.01
    assert abs(got[2].s.x) < 1e-6 and got[2].s.y < -2_000_000
    assert 17_200_000 < got[3].e.x < 17_300_000


def test_antimeridian(spark):
    df = spark.createDataFrame([(1, 177.0, 181.0), (2, 178.0, -179.0), (3, -10.0, 10.0), (4, -181.0, -178.0)], "k int, x0 double, x1 double")
    got = sorted((r.k, r.x0, r.x1) for r in spatial.split_antimeridian(df).collect())
    assert got == [(1, -180.0, -179.0), (1, 177.0, 180.0), (2, -180.0, -179.0), (2, 178.0, 180.0), (3, -10.0, 10.0), (4, -180.0, -178.0), (4, 179.0, 180.0)]


def test_ranges_stop_at_the_largest_piece(spark):
    df = spark.createDataFrame([("f", 0, 10), ("f", 15, 10), ("f", 24, 90), ("f", 400, 5)], "file string, offset long, size long")
    got = sorted((r.start, r.stop) for r in runs.merge_ranges(df, "file", gap=20, piece=60).collect())
    assert got == [(0, 25), (24, 114), (400, 405)]


def test_dilate_and_erode(spark):
    square = spark.createDataFrame([("t", i, j) for i in range(3) for j in range(3) if (i, j) != (1, 1)], "t string, row long, col long")
    assert raster.close(square, ["t"]).count() == 9
    assert raster.erode(square, ["t"]).count() == 0


def test_painting_layers_is_painting_their_stack(spark):
    r = random.Random(1)
    layers = [[(i, j, None if r.random() < 0.3 else r.randint(0, 99)) for i in range(5) for j in range(5) if r.random() < 0.6] for _ in range(3)]
    want = {}
    for rows in layers:
        want |= {(i, j): v for i, j, v in rows if v is not None}
    frames = [spark.createDataFrame(rows, "row int, col int, v int") for rows in layers]
    stack = spark.createDataFrame([(i, j, v, z) for z, rows in enumerate(layers) for i, j, v in rows], "row int, col int, v int, z int")
    for got in (raster.paint(frames, []), raster.paint_stack(stack, [], "z")):
        assert {(x.row, x.col): x.v for x in got.collect()} == want


def test_erosion_by_plain_loop(spark):
    r = random.Random(2)
    cells = {(i, j) for i in range(12) for j in range(12) if r.random() < 0.85}
    df = spark.createDataFrame([("a", i, j) for i, j in cells], "t string, row int, col int")
    for eight in (True, False):
        near = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if eight or not a or not b]
        grown = {(i + a, j + b) for i, j in cells for a, b in near}
        left = {(i, j) for i, j in cells if all((i + a, j + b) in cells for a, b in near)}
        assert left and {(x.row, x.col) for x in raster.erode(df, ["t"], eight).collect()} == left
        assert {(x.row, x.col) for x in raster.dilate(df, ["t"], eight).collect()} == grown
