"""Polygons, outlines, projected selection, regions and the overview over nation, orders, customer and lineitem.

A nation's box stands in for a country: a diamond with a diamond hole beside its middle, corners off the lattice, some
of them past 180.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import grids as G
from ..operators import polygons as P
from ..operators import raster as X
from ..operators import spatial as S
from . import adapters as A
from .registry import query
from .spatial_queries import TILES

#: Middles (mx, my) and half diagonals (rx, ry); the hole's middle is rx / 4 further east, its diagonals are a quarter.
DIAMONDS = "diamonds as (select name, (u0 + u1) / 2 + 40.013::double as mx, (v0 + v1) / 2 + 0.017::double as my, (u1 - u0) / 2 as rx, (v1 - v0) / 2 as ry from nations)"
LATTICE = """dx as (select *, unnest(range(cast(floor(mx - rx) as bigint), cast(ceil(mx + rx) as bigint))) as ux from diamonds),
lattice as (select *, unnest(range(cast(floor(my - ry) as bigint), cast(ceil(my + ry) as bigint))) as cy from dx)"""


def diamonds(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = A.boxes_of_nations(spark, sf_dir).selectExpr("name", "(u0 + u1) / 2 + double(40.013) as mx", "(v0 + v1) / 2 + double(0.017) as my", "(u1 - u0) / 2 as rx", "(v1 - v0) / 2 as ry")

    def ring(east: float, share: float) -> Column:
        corners = [(F.col("mx") + (east + a * share) * F.col("rx"), F.col("my") + b * share * F.col("ry")) for a, b in ((1, 0), (0, 1), (-1, 0), (0, -1), (1, 0))]
        return F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in corners])

    return d.withColumn("rings", F.array(ring(0.0, 1.0), ring(0.25, 0.25)))


@query(f"with {A.NATIONS}, {DIAMONDS}, {LATTICE} select name, case when ux >= 180 then ux - 360 else ux end as cx, cy from lattice where abs(ux + 0.5 - mx) / rx + abs(cy + 0.5 - my) / ry < 1 and abs(ux + 0.5 - mx - rx / 4) / (rx / 4) + abs(cy + 0.5 - my) / (ry / 4) >= 1")
def cells_by_centre(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells whose centre lies in a country, cut at the antimeridian first."""
    return P.polygon_cells(P.split_polygons(diamonds(spark, sf_dir)), ["name"], 1.0, touched=False)


@query(f"with {A.NATIONS}, {DIAMONDS}, {LATTICE} select name, case when ux >= 180 then ux - 360 else ux end as cx, cy from lattice where greatest(ux - mx, mx - ux - 1, 0) / rx + greatest(cy - my, my - cy - 1, 0) / ry < 1 and greatest(abs(ux - mx - rx / 4), abs(ux + 1 - mx - rx / 4)) / (rx / 4) + greatest(abs(cy - my), abs(cy + 1 - my)) / (ry / 4) > 1")
def cells_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that a country meets: some of it lies in them."""
    return P.polygon_cells(P.split_polygons(diamonds(spark, sf_dir)), ["name"], 1.0)


@query(f"with {A.NATIONS}, {DIAMONDS} select name, round(2 * rx * ry * 15 / 16, 6) as area, round(mx - rx / 60, 6) as cx, round(my, 6) as cy, round(mx - rx / 2, 6) as inner_x, round(my, 6) as inner_y, round(mx + rx, 6) as east from diamonds")
def polygon_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = F.col("rings")
    d = diamonds(spark, sf_dir).select("name", P.polygon_area(r).alias("area"), P.centroid(r).alias("c"), P.inner_point(r).alias("p"), P.extent(F.flatten(r)).alias("e"))
    six = lambda c, n: F.round(c, 6).alias(n)
    return d.select("name", six("area", "area"), six("c.x", "cx"), six("c.y", "cy"), six("p.x", "inner_x"), six("p.y", "inner_y"), six("e.east", "east"))


@query(f"""with {A.PIXELS}, c as (select tile, row, col from pixels where like100 > -100), s as (select unnest([0, 1]) as d),
v as (select tile, row + a.d as vr, col + b.d as vc, sum(1 << (2 * a.d + b.d)) as m from c, s a, s b group by all),
n as (select tile, sum(case when m in (6, 9) then 2 when m in (1, 2, 4, 8, 7, 11, 13, 14) then 1 else 0 end)::bigint as corners from v group by tile),
b as (select tile, sum(n % 2)::bigint as perimeter from (select tile, k, r, q, count(*) as n from (select tile, 'h' as k, row + d as r, col as q from c, s union all select tile, 'v', row, col + d from c, s) group by all) group by tile)
select tile, cast(count(*) as double) as area, max(perimeter)::double as perimeter, max(corners)::bigint as corners from c join n using (tile) join b using (tile) group by tile""")
def cell_outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlines of each tile's bright cells: what they enclose is the cells, how long they are, how many corners they have."""
    out = P.outlines_of_cells(A.pixels(spark, sf_dir).filter("like100 > -100"), ["tile"])
    length = lambda r: P.total(P.sides(r, lambda a, b: F.abs(b["x"] - a["x"]) + F.abs(b["y"] - a["y"])))
    each = lambda f: P.total(F.transform("rings", f))
    return out.select("tile", each(G.shoelace).alias("area"), each(length).alias("perimeter"), each(lambda r: (F.size(r) - 1).cast("double")).cast("long").alias("corners"))


#: Polar stereographic, true at 70 north, about 45 west, written out from the published formulas.
CAP = """ring as (select k, x0 + (x1 - x0) * i.i / 4.0::double as lon, radians(y0 + (y1 - y0) * j.j / 4.0::double) as p, 0.0818191908426215::double as e from footprints, (select unnest(range(5)) as i) i, (select unnest(range(5)) as j) j where y1 > 50 and (i.i in (0, 4) or j.j in (0, 4))),
r as (select k, radians(lon + 45) as lam, 6378137.0::double * cos(radians(70)) / sqrt(1 - pow(e * sin(radians(70)), 2)) / (tan(pi() / 4 - radians(35)) / pow((1 - e * sin(radians(70))) / (1 + e * sin(radians(70))), e / 2)) * tan(pi() / 4 - p / 2) / pow((1 - e * sin(p)) / (1 + e * sin(p)), e / 2) as rho from ring),
capped as (select k, floor(min(rho * sin(lam)) + 0.5) as u0, floor(min(-rho * cos(lam)) + 0.5) as v0, floor(max(rho * sin(lam)) + 0.5) as u1, floor(max(-rho * cos(lam)) + 0.5) as v1 from r group by k)"""


@query(f"with {A.FOOTPRINTS}, {CAP}, i as (select unnest(range(-7, 7)) as i), b as (select i.i, j.i as j from i, i as j) select printf('X%+03dY%+03d', i, j) as name, k from b join capped on i * 600000 < u1 and u0 < (i + 1) * 600000 and j * 600000 < v1 and v0 < (j + 1) * 600000")
def cap_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Northern footprints by the squares of the cap's map that their projected outlines' bounds meet."""
    f = S.hemisphere(A.footprints(spark, sf_dir), True).filter("y1 > 50")
    b = P.projected_bounds(f, lambda x, y: G.polar_stereographic(x, y, 70.0, -45.0, True), 4).select("k", "u0", "v0", "u1", "v1")
    return S.box_join(S.square_tiles(spark, 4_200_000.0, 4_200_000.0, 600_000.0), b, 600_000.0).select("name", "k")


@query(f"with {A.FOOTPRINTS}, {A.PIECES}, {A.NATIONS}, hit as (select k, string_agg(distinct name, ', ' order by name) as name from pieces f join nations n on f.x0 < n.u1 and n.u0 < f.x1 and f.y0 < n.v1 and n.v0 < f.y1 group by k), mid as (select k, min(x) as x, any_value(y) as y from (select k, (x0 + x1) / 2 as x, (y0 + y1) / 2 as y from pieces where k not in (select k from hit)) group by k), near as (select k, arg_min(name, (sqrt(pow(greatest(u0 - x, x - u1, 0), 2) + pow(greatest(v0 - y, y - v1, 0), 2)), id)) as name from mid, nations group by k) select k, name from hit union all select k, name from near")
def country_or_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = S.split_antimeridian(A.footprints(spark, sf_dir)).withColumns({"x": F.expr("(x0 + x1) / 2"), "y": F.expr("(y0 + y1) / 2")})
    return S.touched_or_nearest(pieces, "k", A.boxes_of_nations(spark, sf_dir), "id", "name", 10.0)


@query(f"with {TILES}, {A.POINTS}, tx as (select *, unnest(range(x0 // 3, x1 // 3)) as cx from tiles), t as (select cx, unnest(range(y0 // 3, y1 // 3)) as cy, x0 % 24 = 0 as failed from tx), p as (select cx, cy, bool_or(failed) as failed from t group by all), g as (select cast(floor(x / 3) as bigint) as cx, cast(floor(y / 3) as bigint) as cy, cast(floor(avg(pid % 256)) as int) as grey from points group by all) select cx, cy, coalesce(grey, case when failed then 220 else 170 end) as r, coalesce(grey, case when failed then 40 else 200 end) as g, coalesce(grey, case when failed then 40 else 235 end) as b from p full join g using (cx, cy)")
def run_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = S.lonlat_tiles(spark).withColumn("failed", F.expr("x0 % 24 = 0"))
    return X.overview(tiles, A.points(spark, sf_dir).withColumn("grey", F.col("pid") % 256), 3.0)


@query(f"with {A.NATIONS}, c as (select name, cast(continent as varchar) as continent, unnest(range(cast(ceil(u0 / 2 - 0.5) as bigint), cast(ceil(u1 / 2 - 0.5) as bigint))) as cx, v0, v1 from nations), l as (select name, continent, cx, unnest(range(cast(ceil(v0 / 2 - 0.5) as bigint), cast(ceil(v1 / 2 - 0.5) as bigint))) as cy from c), land as (select distinct cx, cy from l), zones as (select case when cy < 0 then 'ocean S of 60S' else 'ocean N of 50N' end as region, cx, cy from (select unnest(range(-90, 90)) as cx), (select unnest(range(-45, -30) || range(25, 45)) as cy)), r as (select distinct case when name = 'CANADA' then name else continent end as region, cx, cy from l union all select 'land', cx, cy from land union all select region, cx, cy from zones where not exists (select 1 from land where land.cx = zones.cx and land.cy = zones.cy)) select region, count(*) as cells from r group by region")
def region_geometries(spark: SparkSession, sf_dir: str) -> DataFrame:
    land = A.boxes_of_nations(spark, sf_dir).selectExpr("name as country", "cast(continent as string) as continent", "u0 as x0", "v0 as y0", "u1 as x1", "v1 as y1")
    return S.region_cells(S.region_boxes(land, apart=("CANADA",), north_ice=50.0), 2.0).groupBy("region").agg(F.count("*").alias("cells"))
