"""Rasters in long form (keys, row, col, v): block means, smoothing, painting, alignment, pyramids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .spatial import box_cells


def block_mean(df: DataFrame, k: int, keys: list[str], values: list[str], height: int | None = None, width: int | None = None) -> DataFrame:
    """Means of k x k blocks over cells with data; ragged blocks at the far edges are left out when sizes are given.

    Sums and counts stay beside the means, so that roll-ups of roll-ups weigh cells alike.
    """
    r, c = F.floor(F.col("row") / k), F.floor(F.col("col") / k)
    if height is not None:
        df = df.filter(F.col("row") < height // k * k)
    if width is not None:
        df = df.filter(F.col("col") < width // k * k)
    aggs = [a for v in values for a in (F.sum(v).alias(f"{v}_sum"), F.count(v).alias(f"{v}_n"), (F.sum(v) / F.count(v)).alias(v))]
    return df.groupBy(*keys, r.cast("long").alias("row"), c.cast("long").alias("col")).agg(*aggs)


def decimate(df: DataFrame, k: int) -> DataFrame:
    """Every k-th row and column, renumbered: a filter that reaches the scan, never a sample."""
    return df.filter((F.col("row") % k == 0) & (F.col("col") % k == 0)).withColumns({"row": F.expr(f"row div {k}"), "col": F.expr(f"col div {k}")})


def smooth(df: DataFrame, keys: list[str], n: int, value: str = "v") -> DataFrame:
    """Mean over the n x n box (n odd) about each cell, over cells with data only; df has every cell, null without data.

    Separable: sums and counts along rows, then of those along columns; beyond the grid there is nothing to add.
    """
    r = n // 2
    along = Window.partitionBy(*keys, "row").orderBy("col").rangeBetween(-r, r)
    down = Window.partitionBy(*keys, "col").orderBy("row").rangeBetween(-r, r)
    rows = df.withColumns({"s__": F.sum(value).over(along), "n__": F.count(value).over(along)})
    both = rows.withColumns({"s2__": F.sum("s__").over(down), "n2__": F.sum("n__").over(down)})
    return both.withColumn("smooth", F.when(F.col("n2__") > 0, F.col("s2__") / F.col("n2__"))).drop("s__", "n__", "s2__", "n2__")


def paint(layers: list[DataFrame], keys: list[str], value: str = "v") -> DataFrame:
    """Painter's union: at each cell the value of the last layer with data there. One aggregate, no chain of joins."""
    rows = reduce(lambda a, b: a.unionByName(b), [t.select(*keys, "row", "col", value, F.lit(i).alias("z")) for i, t in enumerate(layers)])
    return paint_stack(rows, keys, "z", value)


def paint_stack(rows: DataFrame, keys: list[str], z: str, value: str = "v") -> DataFrame:
    """The same of layers that lie in one table, by their place in a column: one scan, however many there are."""
    return rows.filter(F.col(value).isNotNull()).groupBy(*keys, "row", "col").agg(F.max_by(value, z).alias(value))


def align(reference: DataFrame, other: DataFrame, keys: list[str], d_row: int, d_col: int, value: str) -> DataFrame:
    """The reference grid's cells with the other raster's value, its rows and columns moved by a whole offset."""
    moved = other.select(*keys, (F.col("row") + d_row).alias("row"), (F.col("col") + d_col).alias("col"), value)
    return reference.join(moved, [*keys, "row", "col"], "left")


def crop(df: DataFrame, r0: int, r1: int, c0: int, c1: int) -> DataFrame:
    return df.filter(F.col("row").between(r0, r1 - 1) & F.col("col").between(c0, c1 - 1)).withColumns({"row": F.col("row") - r0, "col": F.col("col") - c0})


def feather_blend(df: DataFrame, keys: list[str], value: str, edge: str, feather: int, erode: int = 0) -> DataFrame:
    """Overlapping inputs averaged in linear power with weights that rise from an input's edge over `feather` cells."""
    w = F.least(F.col(edge) - erode, F.lit(feather)).cast("double") / feather
    rows = df.withColumn("w__", w).filter((F.col("w__") > 0) & F.col(value).isNotNull())
    return rows.groupBy(*keys, "row", "col").agg((F.sum(F.col(value) * F.col("w__")) / F.sum("w__")).alias(value), F.count("*").alias("inputs"))


def pyramid(tiles: DataFrame, top: int, low: int) -> DataFrame:
    """z, x, y, area of all levels from `top` down to `low`: each level is rolled up from the finest by its address."""
    levels = tiles.withColumn("z", F.explode(F.sequence(F.lit(low), F.lit(top))))
    return levels.groupBy("z", F.expr(f"shiftright(x, {top} - z)").alias("x"), F.expr(f"shiftright(y, {top} - z)").alias("y")).agg(F.sum("area").alias("area"), F.count("*").alias("tiles"))


def strip_coarse(levels: DataFrame) -> DataFrame:
    """Payload stays at the finest level only; the others keep their index rows."""
    finest = levels.agg(F.max("z")).scalar()
    return levels.withColumn("area", F.when(F.col("z") == finest, F.col("area")))


def ocean_kind(cells: DataFrame, keys: list[str]) -> DataFrame:
    """land, sea, split or empty: whether a tile's cells with data lie on land, off it, or both."""
    agg = cells.groupBy(*keys).agg(F.bool_or(F.col("data") & F.col("land")).alias("on"), F.bool_or(F.col("data") & ~F.col("land")).alias("off"))
    return agg.select(*keys, F.when(F.col("on") & F.col("off"), "split").when(F.col("off"), "sea").when(F.col("on"), "land").otherwise("empty").alias("kind"))


def class_lookup(points: DataFrame, classes: DataFrame, x0: float, y0: float, size: float) -> DataFrame:
    """Class of each point's cell, the highest of several rasters; 0 outside all."""
    at = points.withColumns({"ci": F.floor((F.col("x") - x0) / size).cast("long"), "cj": F.floor((F.col("y") - y0) / size).cast("long")})
    best = classes.groupBy("ci", "cj").agg(F.max("cls").alias("cls"))
    return at.join(best, ["ci", "cj"], "left").withColumn("cls", F.coalesce("cls", F.lit(0)))


def around(cells: DataFrame, keys: list[str], eight: bool) -> DataFrame:
    """keys, row, col, own: each cell and its neighbours; own marks the cell itself."""
    steps = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if eight or a == 0 or b == 0]
    at = F.array(*[F.struct((F.col("row") + a).alias("row"), (F.col("col") + b).alias("col"), F.lit((a, b) == (0, 0)).alias("own")) for a, b in steps])
    return cells.select(*keys, F.explode(at).alias("c")).select(*keys, "c.row", "c.col", "c.own")


def dilate(cells: DataFrame, keys: list[str], eight: bool = True) -> DataFrame:
    """Cells and their neighbours."""
    return around(cells, keys, eight).select(*keys, "row", "col").distinct()


def erode(cells: DataFrame, keys: list[str], eight: bool = True) -> DataFrame:
    """Cells all of whose neighbours are cells: those named by themselves and by all about them. Cells are distinct."""
    votes = around(cells, keys, eight).groupBy(*keys, "row", "col").agg(F.count("*").alias("votes"), F.bool_or("own").alias("own"))
    return votes.filter(F.col("own") & (F.col("votes") == (9 if eight else 5))).select(*keys, "row", "col")


def close(cells: DataFrame, keys: list[str], rounds: int = 1) -> DataFrame:
    """Fill pinholes: dilate, then erode."""
    for _ in range(rounds):
        cells = dilate(cells, keys)
    for _ in range(rounds):
        cells = erode(cells, keys)
    return cells


#: Colours of planned and failed tiles in the overview.
PLANNED, FAILED = (170, 200, 235), (220, 40, 40)


def overview(tiles: DataFrame, data: DataFrame, size: float) -> DataFrame:
    """cx, cy, r, g, b of a run's overview, in cells of `size` degrees: planned tiles pale, failed ones red, data grey.

    tiles: x0, y0, x1, y1, failed. data: x, y, grey of samples; a cell's grey is their mean, and data lies over tiles.
    """
    planned = box_cells(tiles, size, touched=False).groupBy("cx", "cy").agg(F.bool_or("failed").alias("failed"))
    grey = data.groupBy(F.floor(F.col("x") / size).alias("cx"), F.floor(F.col("y") / size).alias("cy")).agg(F.floor(F.avg("grey")).cast("int").alias("grey"))
    both = planned.join(grey, ["cx", "cy"], "full")
    return both.select("cx", "cy", *[F.coalesce("grey", F.when(F.col("failed"), FAILED[i]).otherwise(PLANNED[i])).alias(c) for i, c in enumerate("rgb")])
