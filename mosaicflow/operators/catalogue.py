"""Catalogue operators: best versions, filters, priorities, forced picks. All are one shuffle or none."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import names as N
from .tables import ranked


def best_versions(df: DataFrame, ordinal: str, name: str = "name") -> DataFrame:
    """One row a scene: production first, then the highest release, then the highest counter; the first of equals.

    An aggregate rather than a ranking, so versions are combined before the shuffle and no scene is sorted.
    """
    rank = N.version_rank(F.col(name))
    best = F.max_by(F.struct(*df.columns), F.struct(rank, -F.col(ordinal)))
    return df.groupBy(N.scene_key(F.col(name)).alias("scene__")).agg(best.alias("row__")).select("row__.*")


def union_catalogues(main: DataFrame, *fills: DataFrame) -> DataFrame:
    """Bag union with fill = 0 for the main catalogue, 1.. for the others; equal scenes of two catalogues both stay."""
    parts = [c.withColumn("fill", F.lit(i)) for i, c in enumerate((main, *fills))]
    return reduce(lambda a, b: a.unionByName(b), parts)


def filter_direction(df: DataFrame, direction: str) -> DataFrame:
    return df if direction == "both" else df.filter(F.col("direction") == direction)


def apply_footprints(df: DataFrame, valid: DataFrame, least: float, required: bool) -> DataFrame:
    """Override geometry by the valid footprint of the same name; drop null geometries and fractions under `least`.

    A row without a footprint stays. With `required` a footprint without a fraction is dropped, else it counts as 1.
    """
    v = valid.select(F.col("name").alias("name__"), F.col("geom").alias("geom__"), F.col("valid_frac").alias("frac__"), F.lit(True).alias("has__"))
    frac = F.col("frac__") if required else F.coalesce("frac__", F.lit(1.0))
    out = df.join(v, F.col("name") == F.col("name__"), "left")
    out = out.filter(F.col("has__").isNull() | (F.col("geom__").isNotNull() & (frac >= least)))
    return out.withColumn("geom", F.coalesce("geom__", "geom")).drop("name__", "geom__", "frac__", "has__")


def drop_narrow_ocean(df: DataFrame, land: Column, area: Column, lat: Column, bw: int = 5, most_lat: float = 60.0, least_land: float = 0.05) -> DataFrame:
    """Rows of the narrowest band over open mid-latitude ocean go."""
    return df.filter(~((F.col("bw") == bw) & (F.abs(lat) < most_lat) & (land / area < least_land)))


def by_priority(layers: list[DataFrame], key: str, value: str) -> DataFrame:
    """key, value: of several tables, later ones override earlier ones."""
    rows = reduce(lambda a, b: a.unionByName(b), [t.select(key, value, F.lit(i).alias("p__")) for i, t in enumerate(layers)])
    return rows.groupBy(key).agg(F.max_by(value, "p__").alias(value))


def first_by_priority(layers: list[DataFrame], key: str, value: str) -> DataFrame:
    """key, value: earlier tables win, later ones fill in what is missing."""
    return by_priority(layers[::-1], key, value)


def forced_picks(keep: DataFrame, candidates: DataFrame, everything: DataFrame, keep_columns: list[str]) -> DataFrame:
    """Picks that a tile must keep, in their order: as a candidate, else as loaded at all, else as the pick list has it.

    keep: tile, seq, name and keep_columns; candidates: tile, name, *; everything: name, *. Adds source 1, 2 or 3.
    """
    a = candidates.select("tile", "name", *[F.col(c).alias(f"a_{c}") for c in keep_columns], F.lit(1).alias("in_a"))
    b = everything.select("name", *[F.col(c).alias(f"b_{c}") for c in keep_columns], F.lit(2).alias("in_b"))
    out = keep.join(a, ["tile", "name"], "left").join(b, "name", "left")
    value = lambda c: F.when(F.col("in_a").isNotNull(), F.col(f"a_{c}")).when(F.col("in_b").isNotNull(), F.col(f"b_{c}")).otherwise(F.col(c))
    return out.select("tile", "seq", "name", *[value(c).alias(c) for c in keep_columns], F.coalesce("in_a", "in_b", F.lit(3)).alias("source"))


def drop_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row: how many rows each rule drops, each rule judging what those before it left."""
    kept, out = F.lit(True), [F.count("*").alias("loaded")]
    for name, bad in rules.items():
        bad = F.coalesce(bad, F.lit(False))
        out.append(F.count_if(kept & bad).alias(name))
        kept = kept & ~bad
    return df.agg(*out, F.count_if(kept).alias("usable"))


def job_groups(picks: DataFrame, cross: bool = False) -> DataFrame:
    """tile, freq, term, files: the picks of one job, in pick order."""
    rows = picks.withColumn("term", N.term(F.col("pol"), cross))
    files = F.transform(F.array_sort(F.collect_list(F.struct("seq", "name"))), lambda x: F.concat(x["name"], F.lit(".h5")))
    return rows.groupBy("tile", "freq", "term").agg(files.alias("files"))


def longest_first(jobs: DataFrame, size: Column, *ties: str) -> DataFrame:
    """Jobs with their start order: most work first."""
    return ranked(jobs.withColumn("work", size), "rank", F.desc("work"), *ties)


def last_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The last n rows of each group."""
    return df.withColumn("n__", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("n__") <= n).drop("n__")


def stack_frames(tiling: DataFrame, catalogue: DataFrame) -> DataFrame:
    """frame, cycle and the observations of a frame's time series: tiling frames meet all cycles' catalogues."""
    frames = tiling.select("frame_key", "direction").distinct()
    return catalogue.join(frames, ["frame_key", "direction"]).groupBy("frame_key", "direction", "cycle").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("name")).alias("names"))
