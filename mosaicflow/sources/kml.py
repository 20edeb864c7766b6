"""Tile documents of a superoverlay as text: elements, titles, overlays with and without altitude."""

from __future__ import annotations

import re
from html import escape

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MARK = "<altitudeMode>absolute</altitudeMode>"


def element(text: Column, tag: str) -> Column:
    """Content of the first such element; an empty string without one."""
    return F.regexp_extract(text, f"<{re.escape(tag)}>(.*?)</{re.escape(tag)}>", 1)


def retitle(text: Column, title: str, tag: str = "name") -> Column:
    """The first such element's content replaced, escaped; regexp_replace alone would replace all."""
    new = escape(title, quote=False)
    pattern = f"(?s)^(.*?)<{re.escape(tag)}>.*?</{re.escape(tag)}>(.*)$"
    head, tail = F.regexp_extract(text, pattern, 1), F.regexp_extract(text, pattern, 2)
    return F.when(text.rlike(f"(?s)<{re.escape(tag)}>.*?</{re.escape(tag)}>"), F.concat(head, F.lit(f"<{tag}>{new}</{tag}>"), tail)).otherwise(text)


def read_overlays(spark: SparkSession, path: str) -> DataFrame:
    """file, href, north, south, east, west, draw_order of each ground overlay under path."""
    docs = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.explode(F.regexp_extract_all("value", F.lit("(?s)<GroundOverlay>(.*?)</GroundOverlay>"), 1)).alias("o"))
    box = {t: F.expr(f"try_cast(regexp_extract(o, '<{t}>(.*?)</{t}>', 1) as double)") for t in ("north", "south", "east", "west")}
    return docs.select("file", element(F.col("o"), "href").alias("href"), *[c.alias(t) for t, c in box.items()], F.expr("try_cast(regexp_extract(o, '<drawOrder>(.*?)</drawOrder>', 1) as int)").alias("draw_order"))


def overlay(href: Column, north: Column, south: Column, east: Column, west: Column, draw_order: Column, altitude: float | None = None) -> Column:
    """Text of one ground overlay, lifted to an altitude over sea."""
    up = "" if altitude is None else f"<altitude>{altitude:g}</altitude>{MARK}"
    return F.concat(
        F.lit("<GroundOverlay><drawOrder>"), draw_order.cast("string"), F.lit("</drawOrder><Icon><href>"), href, F.lit(f"</href></Icon>{up}<LatLonBox><north>"),
        F.format_string("%.14f", north), F.lit("</north><south>"), F.format_string("%.14f", south), F.lit("</south><east>"), F.format_string("%.14f", east), F.lit("</east><west>"), F.format_string("%.14f", west), F.lit("</west></LatLonBox></GroundOverlay>"),
    )


def lift(tiles: DataFrame, altitude: float = 10.0) -> DataFrame:
    """tiles (href, north, south, east, west, draw_order, kind) with their overlays' text: sea is lifted, split tiles get two."""
    o = lambda href, alt: overlay(href, *[F.col(c) for c in ("north", "south", "east", "west", "draw_order")], alt)
    base = F.regexp_replace("href", r"\.[^.]*$", "")
    both = F.concat(o(F.concat(base, F.lit(".land.png")), None), o(F.concat(base, F.lit(".sea.png")), altitude))
    return tiles.withColumn("text", F.when(F.col("kind") == "sea", o(F.col("href"), altitude)).when(F.col("kind") == "split", both).otherwise(o(F.col("href"), None)))


def unlift(tiles: DataFrame) -> DataFrame:
    """What lift has changed as it was: each tile's one overlay on the ground, whatever its kind."""
    return tiles.withColumn("text", overlay(F.col("href"), *[F.col(c) for c in ("north", "south", "east", "west", "draw_order")], None))
