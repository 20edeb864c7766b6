"""Tiles, box joins, cells and coverage.

Range predicates alone plan as nested loops, so every spatial join here deals both sides to buckets of a fixed size,
equi-joins on the bucket and then tests exactly; a pair that shares several buckets is kept in the first of them only,
so nothing has to be made distinct. Boxes that cross the antimeridian are split before they meet anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import grids as G
from ..functions import names as N
from .tables import stored

#: South, north, tile height, tile width, longitude factor of each band of tiles; the two polar caps.
BANDS = [(-84, -78, 6, 60, 6), (-78, -72, 6, 24, 4), (-72, -66, 6, 18, 3), (-66, -60, 6, 12, 2), (-60, 60, 6, 6, 1), (60, 66, 6, 12, 2), (66, 72, 6, 18, 3), (72, 78, 6, 24, 4), (78, 84, 6, 60, 6)]
CAPS = [("S84PS3031", -1, 3031), ("N84PS3413", 1, 3413)]


def lonlat_tiles(spark: SparkSession, bbox: tuple[float, float, float, float] = (-180, -84, 180, 84), bands: list[tuple] = BANDS) -> DataFrame:
    """name, x0, y0, x1, y1, lon_mult: tiles of the band table in bbox; boxes are clipped to it, names are not."""
    w, s, e, n = bbox
    table = spark.createDataFrame(bands, "lat0 int, lat1 int, h int, w int, mult int")
    lat = table.withColumn("lat", F.explode(F.sequence("lat0", F.col("lat1") - 1, "h"))).withColumn("top", F.least(F.col("lat") + F.col("h"), "lat1"))
    cells = lat.withColumn("lon", F.explode(F.sequence(F.lit(-180), F.lit(179), "w")))
    cells = cells.filter((F.col("top") > s) & (F.col("lat") < n) & (F.col("lon") + F.col("w") > w) & (F.col("lon") < e))
    return cells.select(
        N.tile_name(F.col("lon"), F.col("lat"), F.col("top") - F.col("lat"), F.col("w")).alias("name"), F.col("lon").alias("x0"),
        F.greatest(F.col("lat"), F.lit(s)).alias("y0"), (F.col("lon") + F.col("w")).alias("x1"), F.least("top", F.lit(n)).alias("y1"), F.col("mult").alias("lon_mult"),
    )


def square_tiles(spark: SparkSession, half_x: float, half_y: float, tile: float) -> DataFrame:
    """name, x0, y0, x1, y1 of squares over a whole map rectangle."""
    nx, ny = -int(-half_x // tile), -int(-half_y // tile)
    i = spark.range(-nx, nx).select(F.col("id").cast("int").alias("i"))
    out = i.select("i", F.explode(F.sequence(F.lit(-ny), F.lit(ny - 1))).alias("j"))
    return out.select("i", "j", N.box_name(F.col("i"), F.col("j")).alias("name"), (F.col("i") * tile).alias("x0"), (F.col("j") * tile).alias("y0"), ((F.col("i") + 1) * tile).alias("x1"), ((F.col("j") + 1) * tile).alias("y1"))


def polar_tiles(spark: SparkSession, extent: float, tile: float, disc: float = G.EQUATOR_M) -> DataFrame:
    """Squares about the pole of which a corner lies inside the equator's disc."""
    near_x, near_y = F.least(F.abs("x0"), F.abs("x1")), F.least(F.abs("y0"), F.abs("y1"))
    return square_tiles(spark, extent, extent, tile).filter(F.sqrt(near_x * near_x + near_y * near_y) <= disc)


def split_antimeridian(df: DataFrame, x0: str = "x0", x1: str = "x1") -> DataFrame:
    """Boxes with longitudes inside -180..180: one that is given wrapped (x1 < x0) or runs past 180 becomes two."""
    a, b = F.col(x0), F.when(F.col(x1) < F.col(x0), F.col(x1) + 360).otherwise(F.col(x1))
    pieces = F.filter(
        F.array(*[F.struct(F.greatest(a + s, F.lit(-180)).alias("a"), F.least(b + s, F.lit(180)).alias("b")) for s in (0, -360, 360)]), lambda p: p["a"] < p["b"]
    )
    return df.withColumn("piece__", F.explode(pieces)).withColumn(x0, F.col("piece__.a")).withColumn(x1, F.col("piece__.b")).drop("piece__")


def hemisphere(df: DataFrame, north: bool, y0: str = "y0", y1: str = "y1") -> DataFrame:
    """Boxes of which some part lies in this hemisphere; one over the equator lies in both."""
    return df.filter(F.col(y1) > 0) if north else df.filter(F.col(y0) < 0)


def box_join(left: DataFrame, right: DataFrame, bucket: float, closed: bool = False) -> DataFrame:
    """Pairs of boxes (x0, y0, x1, y1 on the left; u0, v0, u1, v1 on the right) that overlap, each pair once.

    closed: touching edges count too.
    """
    span = lambda a, b: F.sequence(F.floor(F.col(a) / bucket), F.floor(F.col(b) / bucket))
    both = lambda df, a, b, c, d: df.withColumn("bx__", F.explode(span(a, c))).withColumn("by__", F.explode(span(b, d)))
    joined = both(left, "x0", "y0", "x1", "y1").join(both(right, "u0", "v0", "u1", "v1"), ["bx__", "by__"])
    lo_x, hi_x, lo_y, hi_y = F.greatest("x0", "u0"), F.least("x1", "u1"), F.greatest("y0", "v0"), F.least("y1", "v1")
    meets = (lo_x <= hi_x) & (lo_y <= hi_y) if closed else (lo_x < hi_x) & (lo_y < hi_y)
    first = (F.col("bx__") == F.floor(lo_x / bucket)) & (F.col("by__") == F.floor(lo_y / bucket))
    return joined.filter(meets & first).drop("bx__", "by__")


def box_cells(df: DataFrame, cell: float, touched: bool = True, x0: str = "x0", y0: str = "y0", x1: str = "x1", y1: str = "y1") -> DataFrame:
    """df exploded to the cells (cx, cy) of each box: all that it touches, or those whose centre lies in it."""
    shift = 0.0 if touched else 0.5
    lo = lambda c: F.ceil(F.col(c) / cell - shift) if not touched else F.floor(F.col(c) / cell)
    hi = lambda c: F.ceil(F.col(c) / cell - shift) - 1
    out = df.filter((lo(x0) <= hi(x1)) & (lo(y0) <= hi(y1)))
    return out.withColumn("cx", F.explode(F.sequence(lo(x0), hi(x1)))).withColumn("cy", F.explode(F.sequence(lo(y0), hi(y1))))


def cell_array(cell: float, x0: str = "x0", y0: str = "y0", x1: str = "x1", y1: str = "y1") -> Column:
    """The cells that a box of some extent touches, cx * 1000 + cy each; degrees at 0.5 a cell and coarser keep them apart."""
    span = lambda a, b: F.sequence(F.floor(F.col(a) / cell), F.ceil(F.col(b) / cell) - 1)
    return F.flatten(F.transform(span(x0, x1), lambda x: F.transform(span(y0, y1), lambda y: x * 1000 + y)))


def coverage(cells: DataFrame, keys: list[str], total: Column) -> DataFrame:
    """Distinct cells of each group and their share of `total` (an aggregate expression)."""
    return cells.groupBy(*keys).agg(F.countDistinct("cx", "cy").alias("covered"), total.alias("cells")).withColumn("fraction", F.col("covered") / F.col("cells"))


def new_cells(cells: DataFrame, group: str, seq: str) -> DataFrame:
    """group, seq, new_cells: cells that no earlier pick of the group has."""
    first = cells.groupBy(group, "cx", "cy").agg(F.min(seq).alias(seq))
    counts = first.groupBy(group, seq).agg(F.count("*").alias("new_cells"))
    return cells.select(group, seq).distinct().join(counts, [group, seq], "left").select(group, seq, F.coalesce("new_cells", F.lit(0)).alias("new_cells"))


def minus(cells: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    return cells.join(others.select(*keys).distinct(), keys, "left_anti")


def point_in_box(points: DataFrame, boxes: DataFrame, bucket: float, ordinal: str, keep: str) -> DataFrame:
    """points (pid, x, y) with `keep` of the first box, by ordinal, whose closed extent has them; null if none."""
    p = points.withColumns({"x0": F.col("x"), "y0": F.col("y"), "x1": F.col("x"), "y1": F.col("y")})
    hit = box_join(p, boxes, bucket, closed=True).groupBy("pid").agg(F.min_by(keep, ordinal).alias(keep))
    return points.join(hit, "pid", "left")


def in_polygon(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd rule for a closed ring, an array of struct(x, y)."""
    sides = F.zip_with(F.slice(ring, F.lit(1), F.size(ring) - 1), F.slice(ring, F.lit(2), F.size(ring) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    crosses = lambda s: ((s["a"]["y"] > y) != (s["b"]["y"] > y)) & (x < (s["b"]["x"] - s["a"]["x"]) * (y - s["a"]["y"]) / F.nullif(s["b"]["y"] - s["a"]["y"], F.lit(0.0)) + s["a"]["x"])
    return F.size(F.filter(sides, lambda s: F.coalesce(crosses(s), F.lit(False)))) % 2 == 1


def nearest_box(points: DataFrame, boxes: DataFrame, reach: float, columns: list[str], ident: str, widest: float = 500.0) -> DataFrame:
    """pid, d, ident and columns of the nearest box (ident, u0, v0, u1, v1) of each point (pid, x, y); ties by ident.

    The distance is 0 inside a box. Squares about points are searched: a box no further than the square's half width is
    nearest for certain. Points without one go on, from a written table, with squares three times as wide; the last round
    takes what it finds. No pair of a point and a far box is built before that, and most points end in the first round.
    """
    out, left = None, points.select("pid", "x", "y")
    away = lambda p, lo, hi: F.greatest(F.col(lo) - F.col(p), F.col(p) - F.col(hi), F.lit(0.0))
    while True:
        last = reach >= widest
        p = left.withColumns({"x0": F.col("x") - reach, "y0": F.col("y") - reach, "x1": F.col("x") + reach, "y1": F.col("y") + reach})
        near = box_join(p, boxes, reach, closed=True).withColumn("d", F.sqrt(F.pow(away("x", "u0", "u1"), 2) + F.pow(away("y", "v0", "v1"), 2)))
        best = near.groupBy("pid").agg(F.min_by(F.struct("d", ident, *columns), F.struct("d", ident)).alias("b"))
        found = stored((best if last else best.filter(F.col("b.d") <= reach)).select("pid", "b.*"))
        out = found if out is None else out.unionByName(found)
        left = stored(left.join(found.select("pid"), "pid", "left_anti"))
        if last or left.limit(1).count() == 0:
            return out
        reach *= 3


def nearest(points: DataFrame, places: DataFrame, reach: float, place_columns: list[str], widest: float = 500.0) -> DataFrame:
    """The same of the nearest place (place_id, px, py): a place is a box without extent."""
    boxes = places.withColumns({"u0": F.col("px"), "v0": F.col("py"), "u1": F.col("px"), "v1": F.col("py")})
    return nearest_box(points, boxes, reach, place_columns, "place_id", widest)


def touched_or_nearest(df: DataFrame, key: str, boxes: DataFrame, ident: str, label: str, bucket: float) -> DataFrame:
    """key and the sorted labels, comma-joined, of the boxes that each row of df (key, x0, y0, x1, y1 and a point x, y in
    it) overlaps; where there are none, the label of the box nearest to the point. Rows of df are split already."""
    hit = box_join(df, boxes, bucket).groupBy(key).agg(F.array_join(F.sort_array(F.collect_set(label)), ", ").alias(label))
    hit = stored(hit)
    rest = df.join(hit.select(key), key, "left_anti").groupBy(key).agg(F.min_by(F.struct("x", "y"), F.struct("x", "y")).alias("p"))
    near = nearest_box(rest.select(F.col(key).alias("pid"), "p.x", "p.y"), boxes, bucket, [label], ident)
    return hit.unionByName(near.select(F.col("pid").alias(key), label))


def outline(df: DataFrame, segments: int = 12) -> DataFrame:
    """df with ring: the box's outline, each side in so many pieces, closed."""
    t = F.sequence(F.lit(0), F.lit(segments - 1))
    side = lambda ax, ay, bx, by: F.transform(t, lambda k: F.struct((F.col(ax) + (F.col(bx) - F.col(ax)) * k / segments).cast("double").alias("x"), (F.col(ay) + (F.col(by) - F.col(ay)) * k / segments).cast("double").alias("y")))
    ring = F.concat(side("x0", "y0", "x1", "y0"), side("x1", "y0", "x1", "y1"), side("x1", "y1", "x0", "y1"), side("x0", "y1", "x0", "y0"))
    return df.withColumn("ring", F.concat(ring, F.slice(ring, F.lit(1), F.lit(1))))


def region_boxes(land: DataFrame, shelves: DataFrame | None = None, apart: tuple[str, ...] = ("Greenland",), south_ice: float = 60.0, north_ice: float = 60.0, mask: DataFrame | None = None) -> DataFrame:
    """region and box (x0, y0, x1, y1) of what histograms are split by: continents, countries that stand apart, all land,
    and the sea ice zone, which is the mask's boxes or, without one, the ocean poleward of two latitudes.

    land: country, continent and box. Ice shelves belong to Antarctica and to land.
    """
    box = ["x0", "y0", "x1", "y1"]
    own = land.select(F.when(F.col("country").isin(*apart), F.col("country")).otherwise(F.col("continent")).alias("region"), *box)
    out = own.unionByName(land.select(F.lit("land").alias("region"), *box))
    if shelves is not None:
        out = out.unionByName(shelves.select(F.explode(F.array(F.lit("Antarctica"), F.lit("land"))).alias("region"), *box))
    if mask is not None:
        return out.unionByName(mask.select(F.lit("sea ice (mask)").alias("region"), *box))
    zones = [(f"ocean S of {south_ice:g}S", -180.0, -90.0, 180.0, -south_ice), (f"ocean N of {north_ice:g}N", -180.0, north_ice, 180.0, 90.0)]
    return out.unionByName(land.sparkSession.createDataFrame(zones, "region string, x0 double, y0 double, x1 double, y1 double"))


def region_cells(regions: DataFrame, cell: float) -> DataFrame:
    """region, cx, cy by the centre rule, each cell once a region; ice and ocean regions leave out the cells of land."""
    cells = box_cells(split_antimeridian(regions), cell, touched=False).select("region", "cx", "cy").distinct()
    land = cells.filter("region = 'land'").select("cx", "cy", F.lit(True).alias("on_land"))
    joined = cells.join(land, ["cx", "cy"], "left")
    wet = F.col("region").startswith("ocean ") | F.col("region").startswith("sea ice")
    return joined.filter(~(wet & F.coalesce("on_land", F.lit(False)))).select("region", "cx", "cy")
