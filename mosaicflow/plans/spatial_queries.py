"""Tiles, boxes, coverage, gaps, places, projections and the greedy cover over orders, nation, supplier and customer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import grids as G
from ..operators import cover as V
from ..operators import raster as X
from ..operators import spatial as S
from . import adapters as A
from .registry import query

TILES = """bands as (select * from (values (-84, -78, 6, 60, 6), (-78, -72, 6, 24, 4), (-72, -66, 6, 18, 3), (-66, -60, 6, 12, 2), (-60, 60, 6, 6, 1), (60, 66, 6, 12, 2), (66, 72, 6, 18, 3), (72, 78, 6, 24, 4), (78, 84, 6, 60, 6)) t(lat0, lat1, h, w, m)),
lats as (select *, unnest(range(lat0, lat1, h)) as lat from bands), cells as (select *, unnest(range(-180, 180, w)) as lon from lats),
tiles as (select printf('%s%02d%s%03d_%dx%d', case when lat >= 0 then 'N' else 'S' end, abs(lat), case when lon >= 0 then 'E' else 'W' end, abs(lon), h, w) as name, lon as x0, lat as y0, lon + w as x1, lat + h as y1, m as lon_mult from cells)"""


@query(f"with {TILES} select name, cast(x0 as int) as x0, cast(greatest(y0, -80) as int) as y0, cast(x1 as int) as x1, cast(least(y1, 77) as int) as y1, lon_mult from tiles where x1 > -170 and x0 < 175 and y1 > -80 and y0 < 77")
def lonlat_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.lonlat_tiles(spark, (-170, -80, 175, 77))


@query("with i as (select unnest(range(-15, 15)) as i), b as (select i.i, j.i as j from i, i as j) select i, j, printf('X%+03dY%+03d', i, j) as name from b where sqrt(pow(least(abs(i * 600000.0), abs((i + 1) * 600000.0)), 2) + pow(least(abs(j * 600000.0), abs((j + 1) * 600000.0)), 2)) <= 9009964.76")
def polar_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.polar_tiles(spark, 9_000_000.0, 600_000.0).select(F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), "name")


@query("with i as (select unnest(range(-29, 29)) as i), j as (select unnest(range(-16, 16)) as j) select printf('X%+03dY%+03d', i, j) as name, i * 600000.0::double as x0, j * 600000.0::double as y0 from i, j")
def world_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.square_tiles(spark, 17_012_000.0, 9_218_000.0, 600_000.0).select("name", "x0", "y0")


GRID = """select name, 1 / 128.0::double * lon_mult as dx, px, py, cast(round_even((x1 - x0) / (1 / 128.0::double * lon_mult), 0) + 2 * px as bigint) as nx,
  cast(round_even((least(y1 + py / 128.0::double, 90.0) - greatest(y0 - py / 128.0::double, -90.0)) * 128, 0) as bigint) as ny from (
  select *, cast(ceil(1.0 / 111.32::double * 128) as bigint) as py, cast(ceil(1.0 / (111.32::double * greatest(cos(radians((y0 + y1) * 0.5)), 0.05)) / (1 / 128.0::double * lon_mult)) as bigint) as px from tiles)"""


@query(f"with {TILES} {GRID}")
def tile_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = S.lonlat_tiles(spark)
    d = {c: F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1")}
    g = t.withColumn("g", G.lonlat_grid(d["x0"], d["y0"], d["x1"], d["y1"], 1 / 128.0, F.col("lon_mult"), 1.0))
    return g.select("name", "g.dx", F.bround((F.col("x0") - F.col("g.x0")) / F.col("g.dx")).cast("long").alias("px"), F.bround((F.col("y0") - F.col("g.y0")) * 128).cast("long").alias("py"), "g.nx", "g.ny")


@query("select o_orderkey as k, floor(x / 100.0::double) * 100 - 3000 as x0, cast(round_even((600000 + o_orderkey % 77) / 100.0::double, 0) + 60 as bigint) as nx, 30::bigint as fl, floor(x / 100.0::double) * 100 - 3000 + 50 as centre from (select o_orderkey, cast(o_orderkey * 977 % 900000 - 450000 as double) as x from orders)")
def projected_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = A.table(spark, sf_dir, "orders").selectExpr("o_orderkey as k", "cast(o_orderkey * 977 % 900000 - 450000 as double) as x")
    g = G.projected_grid(F.lit(6931), F.col("x"), F.col("x"), F.col("x") + 600000 + F.col("k") % 77, F.col("x") + 600000, 100.0, 3.0)
    return o.withColumn("g", g).select("k", "g.x0", "g.nx", "g.fl", G.pixel_centre(F.col("g.x0"), F.col("g.dx")).alias("centre"))


@query(f"with {TILES}, {A.FOOTPRINTS}, {A.PIECES} select name, k from tiles t join pieces p on t.x0 < p.x1 and p.x0 < t.x1 and t.y0 < p.y1 and p.y0 < t.y1 group by name, k")
def tile_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = S.split_antimeridian(A.footprints(spark, sf_dir)).selectExpr("k", "x0 as u0", "y0 as v0", "x1 as u1", "y1 as v1")
    return S.box_join(S.lonlat_tiles(spark), pieces, 6.0).select("name", "k").distinct()


@query(f"with {A.FOOTPRINTS}, {A.PIECES} select k, x0, x1, y0, y1 from pieces")
def antimeridian_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.split_antimeridian(A.footprints(spark, sf_dir)).select("k", "x0", "x1", "y0", "y1")


@query(f"with {A.FOOTPRINTS} select k, y1 > 0 as north, y0 < 0 as south from footprints")
def hemispheres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each footprint which hemispheres' catalogues have it."""
    f = A.footprints(spark, sf_dir)
    both = S.hemisphere(f, True).select("k", F.lit("north").alias("side")).union(S.hemisphere(f, False).select("k", F.lit("south")))
    return both.groupBy("k").agg(F.bool_or(F.col("side") == "north").alias("north"), F.bool_or(F.col("side") == "south").alias("south"))


CELLS = "pc as (select k, c, unnest(range(cast(floor(x0 / 2) as bigint), cast(ceil(x1 / 2) as bigint))) as cx, y0, y1 from pieces), cells as (select k, c, cx, unnest(range(cast(floor(y0 / 2) as bigint), cast(ceil(y1 / 2) as bigint))) as cy from pc)"


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.box_cells(S.split_antimeridian(A.footprints(spark, sf_dir)), 2.0).select("k", "c", "cx", "cy")


@query(f"with {A.FOOTPRINTS}, {A.PIECES}, {CELLS} select c % 100 as grp, count(distinct cx * 1000 + cy) as covered, 16200::bigint as cells, count(distinct cx * 1000 + cy) / 16200.0::double as fraction from cells group by 1")
def coverage_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cells(spark, sf_dir).withColumn("grp", F.col("c") % 100)
    return S.coverage(c, ["grp"], F.max(F.lit(16200).cast("long")))


@query(f"with {A.FOOTPRINTS}, {A.PIECES}, {CELLS}, f as (select c % 100 as grp, cx, cy, min(k) as k from cells group by all), n as (select grp, k, count(*) as n from f group by all) select a.grp, a.k, coalesce(n, 0) as new_cells from (select distinct c % 100 as grp, k from cells) a left join n using (grp, k)")
def new_cells_by_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.new_cells(cells(spark, sf_dir).withColumn("grp", F.col("c") % 100), "grp", "k")


@query(f"with {A.FOOTPRINTS}, {A.PIECES}, {CELLS}, e as (select distinct cx, cy from cells where k % 3 = 0), p as (select distinct cx, cy from cells where k % 3 = 1) select cx, cy from e where not exists (select 1 from p where p.cx = e.cx and p.cy = e.cy)")
def gap_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cells(spark, sf_dir)
    return S.minus(c.filter("k % 3 = 0").select("cx", "cy").distinct(), c.filter("k % 3 = 1"), ["cx", "cy"])


@query(f"with {A.FOOTPRINTS}, {A.PIECES}, {CELLS}, u as (select cx, cy, max((k % 3 = 0)::int) as e, max((k % 3 = 1)::int) as p from cells group by all) select sum(e)::bigint * 4 as expected, sum((e = 1 and p = 1)::int)::bigint * 4 as in_product, sum((e = 1 and p = 0)::int)::bigint * 4 as gap, sum((e = 0 and p = 1)::int)::bigint * 4 as outside from u")
def gap_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = cells(spark, sf_dir).groupBy("cx", "cy").agg(F.bool_or(F.col("k") % 3 == 0).alias("e"), F.bool_or(F.col("k") % 3 == 1).alias("p"))
    e, p = F.col("e"), F.col("p")
    return u.agg(*[(F.count_if(c) * 4).alias(n) for n, c in (("expected", e), ("in_product", e & p), ("gap", e & ~p), ("outside", ~e & p))])


@query(f"with {TILES}, {A.POINTS}, o as (select *, row_number() over (order by y0, x0) as ord from tiles) select pid, x, y, (select arg_min(name, ord) from o where x between x0 and x1 and y between y0 and y1) as name from points")
def point_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = S.lonlat_tiles(spark).selectExpr("name", "y0 * 1000 + x0 as ord", "x0 as u0", "y0 as v0", "x1 as u1", "y1 as v1")
    return S.point_in_box(A.points(spark, sf_dir), t, 6.0, "ord", "name").select("pid", "x", "y", "name")


@query(f"with {A.POINTS}, {A.PLACES}, d as (select pid, place, place_id, sqrt(pow(x - px, 2) + pow(y - py, 2)) as d from points, places), r as (select *, row_number() over (partition by pid order by d, place_id) as rn from d) select pid, place, round(d * 111.32, 6) as km from r where rn = 1")
def nearest_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = S.nearest(A.points(spark, sf_dir), A.places(spark, sf_dir), 6.0, ["place"])
    return n.select("pid", "place", F.round(F.col("d") * G.KM_PER_DEGREE, 6).alias("km"))


@query(f"with {A.FOOTPRINTS}, {A.PIECES}, {A.NATIONS} select k, string_agg(distinct name, ', ' order by name) as countries from pieces f join nations n on f.x0 < n.u1 and n.u0 < f.x1 and f.y0 < n.v1 and n.v0 < f.y1 group by k")
def countries_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = S.box_join(S.split_antimeridian(A.footprints(spark, sf_dir)), A.boxes_of_nations(spark, sf_dir), 10.0)
    return j.groupBy("k").agg(F.array_join(F.sort_array(F.collect_set("name")), ", ").alias("countries"))


@query(f"with {A.POINTS}, {A.PLACES}, cls as (select cast(floor((px + 180) / 5) as bigint) as ci, cast(floor((py + 90) / 5) as bigint) as cj, max(1 + place_id % 2) as cls from places group by all) select pid, coalesce(cls, 0) as cls from points left join cls on ci = floor((x + 180) / 5) and cj = floor((y + 90) / 5)")
def class_of_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = A.places(spark, sf_dir).selectExpr("cast(floor((px + 180) / 5) as bigint) as ci", "cast(floor((py + 90) / 5) as bigint) as cj", "1 + place_id % 2 as cls")
    return X.class_lookup(A.points(spark, sf_dir), c, -180.0, -90.0, 5.0).select("pid", "cls")


@query(f"with {TILES} select name from tiles where x0 < 40 and x1 > 10 and y0 < 62 and y1 > 35")
def tiles_for_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.lonlat_tiles(spark).filter("x0 < 40 and x1 > 10 and y0 < 62 and y1 > 35").select("name")


@query(f"with {A.NATIONS}, {A.FOOTPRINTS}, {A.PIECES}, nc as (select id, name, unnest(range(cast(floor(u0) as bigint), cast(ceil(u1) as bigint))) as cx, v0, v1 from nations), n as (select id, name, cx, unnest(range(cast(floor(v0) as bigint), cast(ceil(v1) as bigint))) as cy from nc), fc as (select unnest(range(cast(floor(x0) as bigint), cast(ceil(x1) as bigint))) as cx, y0, y1 from pieces), f as (select distinct cx, unnest(range(cast(floor(y0) as bigint), cast(ceil(y1) as bigint))) as cy from fc) select name, count(*) as cells, count(f.cx) as covered, count(*) - count(f.cx) as missing from n left join f using (cx, cy) group by name")
def region_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = S.box_cells(A.boxes_of_nations(spark, sf_dir), 1.0, True, "u0", "v0", "u1", "v1").select("name", "cx", "cy")
    f = S.box_cells(S.split_antimeridian(A.footprints(spark, sf_dir)), 1.0).select("cx", "cy").distinct().withColumn("hit", F.lit(1))
    return n.join(f, ["cx", "cy"], "left").groupBy("name").agg(F.count("*").alias("cells"), F.count("hit").alias("covered"), (F.count("*") - F.count("hit")).alias("missing"))


@query(f"with {A.NATIONS} select name, cast((u1 - u0) * (v1 - v0) as double) as area, cast((u0 + u1) / 2 as double) as cx, 49 as vertices from nations")
def outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = S.outline(A.boxes_of_nations(spark, sf_dir).selectExpr("name", "u0 as x0", "v0 as y0", "u1 as x1", "v1 as y1"), 12)
    return o.select("name", F.round(G.shoelace(F.col("ring")), 9).alias("area"), ((F.col("x0") + F.col("x1")) / 2).alias("cx"), F.size("ring").alias("vertices"))


@query(f"with {A.POINTS}, w as (select pid, x, y, 0.9063077870366::double * sin(radians(y)) as st, radians(x) as lam from points), d as (select *, sqrt(2 / (1 + sqrt(1 - st * st) * cos(lam / 3))) as d from w) select pid, cast(floor(2.66723 * 6378137.0 * sqrt(1 - st * st) * sin(lam / 3) * d + 0.5) as bigint) as wx, cast(floor(1.24104 * 6378137.0 * st * d + 0.5) as bigint) as wy, round(x, 6) as lon, round(y, 6) as lat from d")
def world_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = A.points(spark, sf_dir).withColumn("w", G.wagner7_forward(F.col("x"), F.col("y")))
    back = G.wagner7_inverse(F.col("w.x"), F.col("w.y"))
    return p.select("pid", F.floor(F.col("w.x") + 0.5).alias("wx"), F.floor(F.col("w.y") + 0.5).alias("wy"), F.round(back["lon"], 6).alias("lon"), F.round(back["lat"], 6).alias("lat"))


@query(f"with {A.POINTS} select pid, 4 as z, cast(floor((x + 180) / 22.5) as bigint) as qx, cast(floor((y + 90) / 22.5) as bigint) as qy from points")
def quad_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.points(spark, sf_dir).withColumn("q", G.quad_address(F.col("x"), F.col("y"), 4)).select("pid", "q.z", F.col("q.x").alias("qx"), F.col("q.y").alias("qy"))


@query(f"with {A.POINTS} select pid from points where abs(x - 10.013) / 60 + abs(y + 5.017) / 40 < 1")
def points_in_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    ring = F.array(*[F.struct(F.lit(x).cast("double").alias("x"), F.lit(y).cast("double").alias("y")) for x, y in ((-49.987, -5.017), (10.013, -45.017), (70.013, -5.017), (10.013, 34.983), (-49.987, -5.017))])
    p = A.points(spark, sf_dir)
    return p.filter(S.in_polygon(F.col("x"), F.col("y"), ring)).select("pid")


@query()
def greedy_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows only: each pick depends on all before it. tests/ hold it against a plain loop."""
    f = A.footprints(spark, sf_dir).selectExpr("x0", "y0", "x1", "y1", "k", "int(k % 2) as fill", "array(77, 40, 20, 5)[int(k % 4)] as bw", "k % 11 = 0 as mixed", "cast(if(k % 97 = 0, k, null) as double) as forced")
    f = S.split_antimeridian(V.last_of_equals(f, ["x0", "y0", "x1", "y1"], "k")).withColumnsRenamed({"x0": "u0", "y0": "v0", "x1": "u1", "y1": "v1"})
    tiles = S.lonlat_tiles(spark).withColumn("n_cells", F.expr("cast((x1 - x0) * 2 * ((y1 - y0) * 2) as long)"))
    pairs = S.box_join(tiles, f, 6.0).withColumns({"x0": F.greatest("x0", "u0"), "y0": F.greatest("y0", "v0"), "x1": F.least("x1", "u1"), "y1": F.least("y1", "v1")})
    return V.cover(pairs.select(F.col("name").alias("tile"), F.col("k").cast("string").alias("name"), F.col("k").alias("ordinal"), "fill", "bw", "mixed", "forced", S.cell_array(0.5).alias("cell"), "n_cells", F.lit(None).cast("boolean").alias("target")))
