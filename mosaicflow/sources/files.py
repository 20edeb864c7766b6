"""Scans of catalogues, footprints, picks, jobs, tiles, logs and class rasters; each has a declared schema.

Sentinels and NaN become NULL here. Nothing but Spark's readers touches a path, so any store that Spark has will do.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RING = "array<array<double>>"
#: A polygon is an array of rings; a multi-polygon's coordinates come as text and are read by polygons().
FEATURES = "features array<struct<properties: {properties}, geometry: struct<type: string, coordinates: string>>>"


def _features(spark: SparkSession, paths: str | list[str], properties: str) -> DataFrame:
    schema = FEATURES.format(properties=properties)
    docs = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(paths)
    return docs.select(F.col("_metadata.file_name").alias("file"), F.posexplode("features").alias("ordinal", "f"))


def polygons(kind: Column, coordinates: Column) -> Column:
    """array of polygons, each an array of rings, each an array of [x, y]; null without a geometry."""
    multi = F.from_json(coordinates, f"array<array<{RING}>>")
    single = F.from_json(coordinates, f"array<{RING}>")
    return F.when(kind == "MultiPolygon", multi).when(kind == "Polygon", F.array(single))


def bounds(polygons_: Column) -> Column:
    """struct(x0, y0, x1, y1) of all vertices."""
    points = F.flatten(F.flatten(polygons_))
    x, y = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    return F.struct(F.array_min(x).alias("x0"), F.array_min(y).alias("y0"), F.array_max(x).alias("x1"), F.array_max(y).alias("y1"))


def _shaped(rows: DataFrame) -> DataFrame:
    return rows.withColumn("geom", polygons(F.col("f.geometry.type"), F.col("f.geometry.coordinates")))


def read_catalogue(spark: SparkSession, paths: str | list[str], lines: bool = False) -> DataFrame:
    """name, url ('' where absent), geom and ordinal of each feature of a catalogue.

    A catalogue is one document, which one task reads. With lines it has a feature a line, as write_features leaves it,
    and is split over tasks; ordinal is then the line's byte order by file part (increasing, with gaps).
    """
    if lines:
        rows = spark.read.schema("properties struct<name: string, url: string>, geometry struct<type: string, coordinates: string>").option("mode", "FAILFAST").json(paths)
        rows = rows.select(F.struct("properties", "geometry").alias("f"), F.monotonically_increasing_id().alias("ordinal"))
        return _shaped(rows).select("f.properties.name", F.coalesce("f.properties.url", F.lit("")).alias("url"), "geom", "ordinal")
    return _shaped(_features(spark, paths, "struct<name: string, url: string>")).select("f.properties.name", F.coalesce("f.properties.url", F.lit("")).alias("url"), "geom", "ordinal")


def read_valid_footprints(spark: SparkSession, paths: list[str]) -> DataFrame:
    """name, valid_frac, geom (nullable); of files that have one name the later one wins."""
    parts = [_shaped(_features(spark, p, "struct<name: string, validFrac: double>")).select("f.properties.name", F.col("f.properties.validFrac").alias("valid_frac"), "geom", F.lit(i).alias("file_no"), "ordinal") for i, p in enumerate(paths)]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.groupBy("name").agg(F.max_by(F.struct("valid_frac", "geom"), F.struct("file_no", "ordinal")).alias("v")).select("name", "v.*")


def read_tiles(spark: SparkSession, path: str, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    """Tiles of all three kinds in one schema: name, kind and the nullable columns of each kind, bandwidth counts, geom."""
    properties = "struct<name: string, kind: string, epsg: int, wkt: string, lonMult: double, height: double, width: double, halfWidthM: double, xMin: double, yMin: double, xMax: double, yMax: double, available: int, selected: int, coverage: double, unionFrac: double, bw: map<string, int>>"
    rows = _shaped(_features(spark, path, properties)).select("f.properties.*", "geom", "ordinal")
    if include:
        rows = rows.filter(F.col("name").isin(include))
    return rows.filter(~F.col("name").isin(exclude)) if exclude else rows


PICK = "name string, url string, freq string, pol string, bwMHz int, direction string, mixed int, newCells int"


def read_picks(spark: SparkSession, path: str) -> DataFrame:
    """tile (from the file's name), seq (its row, which is pick order) and the pick's columns.

    Files are read whole, for a row's place is its meaning; each is a tile's, a few kilobytes.
    """
    text = spark.read.text(path, wholetext=True).select(F.regexp_extract("_metadata.file_name", r"^(.*)\.csv$", 1).alias("tile"), F.split(F.regexp_replace("value", r"[\r\n]+$", ""), r"\r?\n").alias("lines"))
    rows = text.select("tile", F.posexplode("lines").alias("seq", "line")).filter("seq > 0").withColumn("seq", F.col("seq") - 1)
    return rows.select("tile", "seq", F.from_csv("line", PICK).alias("p")).select("tile", "seq", "p.*").withColumn("mixed", F.col("mixed") == 1)


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    """file, names (sorted) and settings of each job document; comments and blank lines do not count."""
    whole = F.regexp_extract("_metadata.file_path", r"/file=([^/]+)/", 1)  # as write_picks lays them out
    file = F.when(whole != "", whole).otherwise(F.col("_metadata.file_name"))
    lines = spark.read.text(path).select(file.alias("file"), F.trim("value").alias("s")).filter("s <> '' and not startswith(s, '#')")
    item = F.col("s").startswith("- ")
    name = F.when(item, F.regexp_replace(F.substring_index(F.substring("s", 3, 10_000), "/", -1), r"\.h5.*$", ""))
    return lines.groupBy("file").agg(F.array_sort(F.collect_list(name)).alias("names"), F.array_sort(F.collect_list(F.when(~item, F.col("s")))).alias("settings"))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """run (the file), n (the line's place) and line; a run's log is read as one document, for order is its meaning."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("run"), F.posexplode(F.split("value", r"\r?\n")).alias("n", "line")).filter("line <> ''")


def read_regions(spark: SparkSession, path: str, name: str = "name") -> DataFrame:
    """name, geom and bounds of polygons with a name property: land, lakes, shelves, glaciers or countries."""
    rows = _shaped(_features(spark, path, "map<string, string>"))
    return rows.select(F.col("f.properties")[name].alias("name"), "geom").withColumn("bounds", bounds(F.col("geom")))


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """device, received, sent of /proc/net/dev-like text."""
    lines = spark.read.text(path).filter(F.contains("value", F.lit(":")))
    parts = F.split(F.trim(F.substring_index("value", ":", -1)), r"\s+")
    return lines.select(F.trim(F.substring_index("value", ":", 1)).alias("device"), parts[0].cast("long").alias("received"), parts[8].cast("long").alias("sent"))


def colour_cells(pixels: DataFrame, colour: tuple[int, int, int], within: int = 6) -> DataFrame:
    """Pixels (r, g, b) no further than `within` from a colour, by the sum of differences."""
    far = sum((F.abs(F.col(c) - v) for c, v in zip("rgb", colour, strict=True)), F.lit(0))
    return pixels.filter(far <= within)


def picture_place(row: Column, col: Column, height: int, width: int, extent: tuple[float, float, float, float]) -> tuple[Column, Column]:
    """Longitude and latitude of a pixel's centre in a picture of a lon/lat extent (w, s, e, n)."""
    w, s, e, n = extent
    return F.lit(w) + (col + 0.5) * (e - w) / width, F.lit(n) - (row + 0.5) * (n - s) / height


def big_layers(layers: DataFrame, least_cells: int = 1_000_000) -> DataFrame:
    """Of a file's layers (file, layer, dims, cells, dtype, stored) the 2-D real or complex ones of some size, largest on disk first."""
    return layers.filter((F.col("dims") == 2) & (F.col("cells") >= least_cells) & F.col("dtype").rlike("^(float|complex)")).orderBy(F.desc("stored"))


def read_bands(path: str) -> list[tuple[int, int, int, int, int]]:
    """Rows of a band table for lonlat_tiles, from a JSON array of (south, north, height, width, longitude factor).

    Bands must not overlap, and a band's height and 360 must be whole numbers of its tiles.
    """
    with open(path, encoding="utf-8") as f:
        bands = sorted(tuple(int(v) for v in row) for row in json.load(f))
    for lat0, lat1, high, wide, factor in bands:
        if not (-90 <= lat0 < lat1 <= 90 and high > 0 and wide > 0 and factor > 0 and (lat1 - lat0) % high == 0 and 360 % wide == 0):
            raise ValueError(f"not a band of tiles: {(lat0, lat1, high, wide, factor)}")
    for below, above in zip(bands, bands[1:], strict=False):
        if above[0] < below[1]:
            raise ValueError(f"bands overlap: {below} and {above}")
    return bands
