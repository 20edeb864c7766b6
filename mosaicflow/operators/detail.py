"""Resampling, source levels of a pyramid, blocks of arrays, and the joins that turn tiles into jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import raster as X


def resample(df: DataFrame, keys: list[str], place: Callable[[Column, Column], Column], cell: float, value: str) -> DataFrame:
    """keys, row, col, mean: pixel centres (x, y) projected forward by `place` to struct(x, y) and averaged per cell.

    Only forward formulas are needed; a cell no larger than a pixel may stay empty, so choose it larger.
    """
    at = df.withColumn("p__", place(F.col("x"), F.col("y")))
    cells = at.groupBy(*keys, F.floor(F.col("p__.y") / cell).alias("row"), F.floor(F.col("p__.x") / cell).alias("col"))
    return cells.agg((F.sum(value) / F.count(value)).alias("mean"), F.count(value).alias("n")).filter("n > 0")


def edge_window(boxes: DataFrame, place: Callable[[Column, Column], Column], pixel: float, points: int = 21, pad: int = 2) -> DataFrame:
    """boxes (x0, y0, x1, y1) with c0, c1, r0, r1: pixels of another grid that hold the box, by points along its edges."""
    t = F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda k: k / float(points - 1))
    along = lambda a, b: lambda k: F.col(a) + (F.col(b) - F.col(a)) * k
    side = lambda fx, fy: F.transform(t, lambda k: place(fx(k), fy(k)))
    fixed = lambda c: lambda k: F.col(c) + k * 0
    ring = F.concat(side(along("x0", "x1"), fixed("y0")), side(along("x0", "x1"), fixed("y1")), side(fixed("x0"), along("y0", "y1")), side(fixed("x1"), along("y0", "y1")))
    out = boxes.withColumn("e__", ring)
    lo, hi = lambda c: F.array_min(F.transform("e__", lambda p: p[c])), lambda c: F.array_max(F.transform("e__", lambda p: p[c]))
    return out.withColumns({"c0": F.floor(lo("x") / pixel) - pad, "c1": F.ceil(hi("x") / pixel) + pad, "r0": F.floor(lo("y") / pixel) - pad, "r1": F.ceil(hi("y") / pixel) + pad}).drop("e__")


def map_boundary(spark, place: Callable[[Column, Column], Column], n_lat: int = 721, n_lon: int = 1441) -> DataFrame:  # noqa: ANN001
    """seq, x, y: the edge of a whole-world map, east side up, top, west side down, bottom; forward formulas only."""
    n = 2 * (n_lat + n_lon)
    k = F.col("id")
    lat = lambda i: -90.0 + i * (180.0 / (n_lat - 1))
    lon = lambda i: -180.0 + i * (360.0 / (n_lon - 1))
    a, b, c = n_lat, n_lat + n_lon, 2 * n_lat + n_lon
    x = F.when(k < a, 180.0).when(k < b, lon(n_lon - 1 - (k - a))).when(k < c, -180.0).otherwise(lon(k - c))
    y = F.when(k < a, lat(k)).when(k < b, 90.0).when(k < c, lat(n_lat - 1 - (k - b))).otherwise(-90.0)
    return spark.range(n).select(k.alias("seq"), place(x, y).alias("p")).select("seq", "p.x", "p.y")


def level_of_detail(df: DataFrame, keys: list[str], smooth: int, height: int, width: int) -> tuple[DataFrame, DataFrame]:
    """(land, full) sources of a pyramid from a full grid (keys, row, col, v, land, detail, ice).

    land: 2 x 2 means of all data, smoothed. full: cells at full resolution with source, which is detail for those of the
    detail set, without ice-sheet interiors (ice 2) and with their margins (ice 1) on land, and rest for the other land
    cells, no interiors. Both full sources come from one scan.
    """
    half = X.block_mean(df, 2, keys, ["v"], height, width)
    land = X.smooth(half, keys, smooth).select(*keys, "row", "col", "v", "smooth") if smooth > 1 else half.select(*keys, "row", "col", "v")
    inner = F.col("ice") == 2
    source = F.when((F.col("detail") & ~inner) | ((F.col("ice") == 1) & F.col("land")), "detail").when(F.col("land") & ~inner, "rest")
    full = df.filter(F.col("v").isNotNull()).select(*keys, "row", "col", "v", source.alias("source")).filter(F.col("source").isNotNull())
    return land, full


def to_blocks(df: DataFrame, keys: list[str], size: int, value: str = "v") -> DataFrame:
    """keys, by, bx, values: square blocks as arrays in row order, null where a cell is absent; for storage and scans."""
    by, bx = F.floor(F.col("row") / size), F.floor(F.col("col") / size)
    place = (F.pmod("row", F.lit(size)) * size + F.pmod("col", F.lit(size))).cast("int")
    g = df.groupBy(*keys, by.alias("by"), bx.alias("bx")).agg(F.map_from_entries(F.collect_list(F.struct(place, value))).alias("m__"))
    return g.select(*keys, "by", "bx", F.transform(F.sequence(F.lit(0), F.lit(size * size - 1)), lambda i: F.try_element_at("m__", i)).alias("values"))


def from_blocks(blocks: DataFrame, keys: list[str], size: int) -> DataFrame:
    rows = blocks.select(*keys, "by", "bx", F.posexplode("values").alias("i", "v")).filter("v is not null")
    return rows.select(*keys, F.expr(f"by * {size} + i div {size}").alias("row"), (F.col("bx") * size + F.col("i") % size).alias("col"), "v")


def tile_frames(picks: DataFrame, outputs: DataFrame) -> DataFrame:
    """tile, frames: distinct frames of each tile whose output exists; tiles without any go."""
    have = picks.select("tile", "frame_key").distinct().join(outputs.select("frame_key").distinct(), "frame_key", "left_semi")
    return have.groupBy("tile").agg(F.array_sort(F.collect_list("frame_key")).alias("frames"))


def jobs_of(tiles: DataFrame, groups: DataFrame) -> DataFrame:
    """One row a tile and job group, with the tile's columns."""
    return tiles.join(groups, "tile").withColumn("job", F.concat_ws(".", "tile", F.concat("freq", "term")))


def normalise(df: DataFrame, keys: list[str], value: str, share: float = 0.99, scale: float = 0.1) -> DataFrame:
    """Values over the group's percentile, times a scale."""
    top = df.groupBy(*keys).agg(F.percentile(value, F.lit(share)).alias("top__"))
    return df.join(top, keys).withColumn("normal", F.col(value) / F.col("top__") * scale).drop("top__")


def pixel_index(v: Column, size: Column, how: str) -> Column:
    """Pixel of a place: cut towards zero, down, or to the nearest (halves to even); they differ below zero."""
    q = v / size
    return {"cut": q.cast("long"), "floor": F.floor(q).cast("long"), "round": F.bround(q).cast("long")}[how]
