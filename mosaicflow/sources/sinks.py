"""Writers: picks and jobs, features, job headers, histograms, reports, view hierarchies, superoverlays, run records.

All go through Spark's committers, so a file is there whole or not at all.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import resolve_path, term


def write_picks(picks: DataFrame, folder: str, cross: bool = False) -> None:
    """folder/picks/tile=<tile>/*.csv in pick order and folder/jobs/file=<tile>.<F><PP>.yaml/*.txt."""
    rows = picks.select("tile", "seq", "name", "url", "freq", "pol", F.col("bw").alias("bwMHz"), "direction", F.col("mixed").cast("int").alias("mixed"), F.col("new_cells").alias("newCells"))
    rows.repartition("tile").sortWithinPartitions("tile", "seq").drop("seq").write.partitionBy("tile").option("header", True).csv(f"{folder}/picks")
    job_documents(picks, cross).repartition("file").write.partitionBy("file").text(f"{folder}/jobs")


def job_documents(picks: DataFrame, cross: bool = False) -> DataFrame:
    """file, value: one job document a tile, channel and term."""
    g = picks.withColumn("term", term(F.col("pol"), cross)).groupBy("tile", "freq", "term").agg(F.array_sort(F.collect_list(F.struct("seq", "name"))).alias("x"))
    files = F.array_join(F.transform("x", lambda x: F.concat(F.lit("  - "), x["name"], F.lit(".h5\n"))), "")
    head = F.format_string("# %s: %d granules, frequency %s\npolarization: %s\nfrequency: %s\nuseMask: true\nfiles:\n", "tile", F.size("x"), "freq", "term", "freq")
    return g.select(F.format_string("%s.%s%s.yaml", "tile", "freq", "term").alias("file"), F.concat(head, files).alias("value"))


def feature(properties: list[str], polygons: Column) -> Column:
    """GeoJSON text of a row with polygons (array of polygons of rings of [x, y])."""
    one = F.size(polygons) == 1
    geometry = F.when(one, F.concat(F.lit('{"type":"Polygon","coordinates":'), F.to_json(polygons[0]), F.lit("}"))).when(polygons.isNotNull(), F.concat(F.lit('{"type":"MultiPolygon","coordinates":'), F.to_json(polygons), F.lit("}"))).otherwise("null")
    return F.concat(F.lit('{"type":"Feature","properties":'), F.to_json(F.struct(*properties), {"ignoreNullFields": "false"}), F.lit(',"geometry":'), geometry, F.lit("}"))


def write_features(df: DataFrame, path: str, properties: list[str], geom: str = "geom") -> None:
    """One feature a line (newline-delimited GeoJSON), written in parallel."""
    df.select(feature(properties, F.col(geom)).alias("value")).write.text(path)


def box_polygon(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    p = lambda x, y: F.array(x.cast("double"), y.cast("double"))
    return F.array(F.array(F.array(p(x0, y0), p(x1, y0), p(x1, y1), p(x0, y1), p(x0, y0))))


def job_header(grid: Column) -> Column:
    """Text of a job's grid: first pixel's centre, size and spacing (degrees, or kilometres of a projected grid), no inputs."""
    unit = F.when(grid["epsg"] == 4326, 1.0).otherwise(1000.0)
    centre = lambda o, d: (grid[o] + grid[d] / 2) / unit
    return F.format_string(
        "%.9f %.9f %.9f %.9f %.12f %.12f\n;\n0\n;\n", centre("x0", "dx"), centre("y0", "dy"), grid["nx"] * grid["dx"] / unit, grid["ny"] * grid["dy"] / unit, grid["dx"] / unit, grid["dy"] / unit,
    )


def resolved_jobs(groups: DataFrame, urls: DataFrame, spec: str, https: str = "https://", bucket: str = "") -> DataFrame:
    """tile, freq, term, paths: a job's files as they are reached, in pick order; a file without an address has ''."""
    named = groups.select("tile", "freq", "term", F.posexplode("files").alias("i", "file")).withColumn("name", F.regexp_replace("file", r"\.h5$", ""))
    known = named.join(urls.select("name", "url").dropDuplicates(["name"]), "name", "left").withColumn("url", F.coalesce("url", F.lit("")))
    path = resolve_path(spec, F.col("name"), F.col("url"), https, bucket)
    return known.groupBy("tile", "freq", "term").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", path.alias("p")))), lambda x: x["p"]).alias("paths"))


def histogram_table(hist: DataFrame, regions: list[str], bins: int = 400) -> DataFrame:
    """dB and one column of km2 a region, all bins; a pivot over a given list needs no pass to find it."""
    every = hist.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    wide = hist.groupBy("bin").pivot("region", regions).agg(F.sum("area"))
    out = every.join(wide, "bin", "left").orderBy("bin")
    return out.select(F.format_string("%.2f", (F.lit(-3000) + F.col("bin") * 10 + 5) / 100.0).alias("dB"), *[F.format_string("%.1f", F.coalesce(F.col(f"`{r}`"), F.lit(0)).cast("double")).alias(f"{r} (km2)") for r in regions])


def report_lines(totals: DataFrame, template: str, *columns: str) -> DataFrame:
    """value: a printf template filled from each row."""
    return totals.select(F.format_string(template, *columns).alias("value"))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def view_members(outputs: DataFrame) -> DataFrame:
    """view, member, z: tiles into their band's view, bands into the global one, caps and projected tiles into theirs.

    outputs: tile, kind, freq, path, lat0. Channel B is painted before A, so A lies on top; z is the paint order.
    """
    z = F.when(F.col("freq") == "A", 1).otherwise(0)
    band = F.when(F.col("kind") == "latlon", F.format_string("band_%+03d", F.col("lat0").cast("int"))).when(F.col("kind") == "ps", F.concat(F.lit("cap_"), "tile")).otherwise(F.lit("ease"))
    tiles = outputs.select(F.concat(F.lit("tile_"), "tile").alias("view"), F.col("path").alias("member"), z.alias("z"))
    bands = outputs.select(band.alias("view"), F.concat(F.lit("tile_"), "tile").alias("member"), F.lit(0).alias("z")).distinct()
    world = outputs.filter("kind = 'latlon'").select(F.lit("global").alias("view"), band.alias("member"), F.lit(0).alias("z")).distinct()
    return tiles.unionByName(bands).unionByName(world)


def array_manifest(arrays: DataFrame) -> DataFrame:
    """name, document: a virtual raster over a remote array (url, layer, nx, ny, x0, y0, dx, dy, epsg), no pixel copied."""
    xml = F.format_string(
        '<VRTDataset rasterXSize="%d" rasterYSize="%d"><SRS>EPSG:%d</SRS><GeoTransform>%.12f, %.12f, 0, %.12f, 0, %.12f</GeoTransform><VRTRasterBand dataType="Float32" band="1"><NoDataValue>nan</NoDataValue><SimpleSource><SourceFilename>HDF5:"/vsicurl/%s"://%s</SourceFilename><SourceBand>1</SourceBand></SimpleSource></VRTRasterBand></VRTDataset>',
        "nx", "ny", "epsg", "x0", "dx", "y0", "dy", "url", "layer",
    )
    return arrays.select("name", xml.alias("document"))


def top_document(title: str, layers: list[str]) -> str:
    """A document that links layers that are there already."""
    from html import escape

    links = "".join(f"<NetworkLink><name>{escape(x, quote=False)}</name><Link><href>{escape(x)}/doc.kml</href></Link></NetworkLink>" for x in layers)
    return f'<?xml version="1.0" encoding="UTF-8"?><kml xmlns="http://www.opengis.net/kml/2.2"><Document><name>{escape(title, quote=False)}</name>{links}</Document></kml>'


def superoverlay(levels: DataFrame, title: str) -> DataFrame:
    """path, text: one document a pyramid tile (z, x, y), linking the up to four tiles of the next level that exist."""
    from html import escape

    child = levels.select((F.col("z") - 1).alias("z"), F.shiftright("x", 1).alias("x"), F.shiftright("y", 1).alias("y"), F.format_string("%d/%d/%d", "z", "x", "y").alias("c"))
    kids = child.groupBy("z", "x", "y").agg(F.array_sort(F.collect_set("c")).alias("kids"))
    size = F.lit(360.0) / F.pow(F.lit(2.0), F.col("z"))
    rows = levels.join(kids, ["z", "x", "y"], "left").withColumn("w", F.col("x") * size - 180).withColumn("s", F.col("y") * size - 90)
    link = lambda c: F.concat(F.lit("<NetworkLink><Link><href>../../"), c, F.lit(".kml</href></Link></NetworkLink>"))
    links = F.coalesce(F.array_join(F.transform("kids", link), ""), F.lit(""))
    head = F.format_string('<kml><Document><name>%s</name><Region><LatLonAltBox><north>%.14f</north><south>%.14f</south><east>%.14f</east><west>%.14f</west></LatLonAltBox></Region><GroundOverlay><Icon><href>%d.png</href></Icon></GroundOverlay>', F.lit(escape(title, quote=False)), F.col("s") + size, "s", F.col("w") + size, "w", "y")
    return rows.select(F.format_string("%d/%d/%d.kml", "z", "x", "y").alias("path"), F.concat(head, links, F.lit("</Document></kml>")).alias("text"))


def run_record(spark, config: dict, path: str) -> None:  # noqa: ANN001
    """The settings that a run was started with."""
    spark.createDataFrame([(json.dumps(config, sort_keys=True),)], "value string").coalesce(1).write.text(path)
