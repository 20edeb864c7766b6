"""Polygons as columns: an array of closed rings, each an array of struct(x, y); the first is the outer ring, others are holes.

All of it but the tracing of outlines is column expressions. Rasterising goes by sides, not by polygons, so that a
coastline of a million sides is spread over tasks and only what crosses one row of cells meets in a group.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.grids import shoelace
from .spatial import outline

RING = "array<struct<x:double,y:double>>"


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with value worked out once, however often f names it."""
    return F.transform(F.array(value), f)[0]


def outer(rings: Column) -> Column:
    """The first; null if there is none."""
    return F.get(rings, F.lit(0))


def sides(ring: Column, f: Callable[[Column, Column], Column]) -> Column:
    """f(start, end) of each side of a closed ring."""
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.zip_with(F.slice(ring, F.lit(1), n), F.slice(ring, F.lit(2), n), f)


def extent(points: Column) -> Column:
    """struct(west, south, east, north) of an array of points."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("west"), F.array_min(ys).alias("south"), F.array_max(xs).alias("east"), F.array_max(ys).alias("north"))


def moved(rings: Column, f: Callable[[Column], Column]) -> Column:
    """rings with each longitude put through f."""
    return F.transform(rings, lambda r: F.transform(r, lambda p: F.struct(f(p["x"]).cast("double").alias("x"), p["y"].cast("double").alias("y"))))


def unwrapped(rings: Column, narrow: bool = True) -> Column:
    """A polygon over 180 degrees wide, for its longitudes change sign at the antimeridian, on one range of 0 to 360.

    narrow: only if it is under 180 degrees wide then; one that is wide both ways stays as it is.
    """
    wide = lambda r: let(extent(outer(r)), lambda e: e["east"] - e["west"])
    east = moved(rings, lambda x: F.when(x < 0, x + 360).otherwise(x))
    return let(east, lambda e: F.when((wide(rings) > 180) & ((wide(e) < 180) if narrow else F.lit(True)), e).otherwise(moved(rings, lambda x: x)))


def clipped(rings: Column, at: float, above: bool) -> Column:
    """What of a polygon lies on one side of a meridian; no rings where nothing does. Rings without area go."""
    inside = lambda p: (p["x"] >= at) if above else (p["x"] <= at)
    cut = lambda a, b: F.struct(F.lit(float(at)).alias("x"), (a["y"] + (b["y"] - a["y"]) * (F.lit(float(at)) - a["x"]) / (b["x"] - a["x"])).alias("y"))
    none = F.array().cast(RING)
    step = lambda a, b: F.when(inside(a) & inside(b), F.array(b)).when(inside(a), F.array(cut(a, b))).when(inside(b), F.array(cut(a, b), b)).otherwise(none)
    closed = lambda r: let(F.flatten(sides(r, step)), lambda c: F.concat(c, F.slice(c, 1, 1)))
    return F.filter(F.transform(rings, closed), lambda r: (F.size(r) >= 4) & (F.abs(shoelace(r)) > 0))


def split_polygons(df: DataFrame, rings: str = "rings", narrow: bool = True) -> DataFrame:
    """Polygons with longitudes in -180..180: one that crosses the antimeridian, wrapped or run past it, becomes two.

    Null and empty polygons have no pieces.
    """
    turned = df.withColumn(rings, F.explode(F.array(unwrapped(F.col(rings), narrow))))
    shifts = F.array(F.lit(0.0), F.lit(-360.0), F.lit(360.0))
    pieces = F.transform(shifts, lambda s: clipped(clipped(moved(F.col(rings), lambda x: x + s), -180, True), 180, False))
    return turned.withColumn(rings, F.explode(F.filter(pieces, lambda p: F.size(p) > 0)))


def polygon_cells(df: DataFrame, keys: list[str], cell: float, touched: bool = True, rings: str = "rings") -> DataFrame:
    """keys, cx, cy of the cells of each polygon: those whose centre lies in it, with `touched` all whose inside it meets.

    Holes are left out by the even-odd rule. Rows of one key are one shape and must not overlap. Boxes give the cells
    of box_cells under either rule.
    """
    end = lambda p: F.struct((p["x"] / cell).alias("x"), (p["y"] / cell).alias("y"))
    s = df.select(*keys, F.explode(rings).alias("r")).select(*keys, F.explode(sides(F.col("r"), lambda a, b: F.struct(end(a).alias("a"), end(b).alias("b")))).alias("s"))
    s = s.select(*keys, *[F.col(f"s.{e}.{c}").alias(f"{c}{e}") for e in "ab" for c in "xy"]).withColumns({"lo": F.least("ya", "yb"), "hi": F.greatest("ya", "yb")})
    # a side along a row's edge is in no row
    rows = s.filter(F.floor("lo") <= F.ceil("hi") - 1).withColumn("cy", F.explode(F.sequence(F.floor("lo"), F.ceil("hi") - 1)))
    x_at = lambda y: F.when(y == F.col("ya"), F.col("xa")).when(y == F.col("yb"), F.col("xb")).otherwise(F.col("xa") + (F.col("xb") - F.col("xa")) * (y - F.col("ya")) / (F.col("yb") - F.col("ya")))
    level, middle = F.col("ya") == F.col("yb"), F.col("cy") + 0.5
    low, high = F.greatest(F.col("lo"), F.col("cy").cast("double")), F.least(F.col("hi"), (F.col("cy") + 1).cast("double"))
    first, last = F.when(level, F.col("xa")).otherwise(x_at(low)), F.when(level, F.col("xb")).otherwise(x_at(high))
    run = lambda a, b: F.struct(a.alias("from"), b.alias("to"))
    passes = run(F.floor(F.least(first, last)), F.ceil(F.greatest(first, last)) - 1)
    per = rows.select(*keys, "cy", F.when((F.col("lo") <= middle) & (middle < F.col("hi")), x_at(middle)).alias("x"), (passes if touched else F.lit(None)).alias("p"))
    per = per.groupBy(*keys, "cy").agg(F.sort_array(F.collect_list("x")).alias("xs"), *([F.collect_set("p").alias("ps")] if touched else []))
    pairs = F.when(F.size("xs") < 2, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.size("xs") - 2, F.lit(2)))
    runs = F.transform(pairs, lambda i: run(F.ceil(F.get(F.col("xs"), i) - 0.5), F.ceil(F.get(F.col("xs"), i + 1) - 0.5) - 1))
    runs = F.concat(runs, F.col("ps")) if touched else runs
    full = F.filter(runs, lambda r: r["from"] <= r["to"])
    return per.select(*keys, F.explode(F.array_distinct(F.flatten(F.transform(full, lambda r: F.sequence(r["from"], r["to"]))))).alias("cx"), "cy")


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)


def polygon_area(rings: Column) -> Column:
    """The outer ring's area less the holes'."""
    size = F.transform(rings, lambda r: F.abs(shoelace(r)))
    return let(size, lambda a: 2 * outer(a) - total(a))


def centroid(rings: Column) -> Column:
    """struct(x, y), weighted by area; null for a polygon without any."""
    moment = lambda r, c: total(sides(r, lambda a, b: (a[c] + b[c]) * (a["x"] * b["y"] - b["x"] * a["y"]))) / 6 * F.signum(shoelace(r))
    sums = F.transform(rings, lambda r: F.struct(moment(r, "x").alias("x"), moment(r, "y").alias("y")))
    area = F.nullif(polygon_area(rings), F.lit(0.0))
    whole = lambda m, c: 2 * outer(m)[c] - total(F.transform(m, lambda v: v[c]))
    return let(F.struct(sums.alias("m"), area.alias("a")), lambda v: F.when(v["a"].isNotNull(), F.struct((whole(v["m"], "x") / v["a"]).alias("x"), (whole(v["m"], "y") / v["a"]).alias("y"))))


def inner_point(rings: Column) -> Column:
    """struct(x, y) that lies in the polygon: the middle of its widest span half way up, the leftmost of equals."""
    middle = let(extent(outer(rings)), lambda e: (e["south"] + e["north"]) / 2)

    def at(y: Column) -> Column:
        crossing = lambda a, b: F.when((a["y"] > y) != (b["y"] > y), a["x"] + (b["x"] - a["x"]) * (y - a["y"]) / (b["y"] - a["y"]))
        xs = F.sort_array(F.filter(F.flatten(F.transform(rings, lambda r: sides(r, crossing))), lambda x: x.isNotNull()))
        spans = lambda s: F.transform(F.sequence(F.lit(0), F.size(s) - 2, F.lit(2)), lambda i: F.struct((F.get(s, i + 1) - F.get(s, i)).alias("w"), (-(F.get(s, i) + F.get(s, i + 1)) / 2).alias("back")))
        widest = let(xs, lambda s: F.when(F.size(s) >= 2, F.array_max(spans(s))))
        return let(widest, lambda w: F.when(w.isNotNull(), F.struct((-w["back"]).alias("x"), y.alias("y"))))

    return let(middle, at)


def projected_bounds(boxes: DataFrame, project: Callable[[Column, Column], Column], segments: int = 12) -> DataFrame:
    """boxes (x0, y0, x1, y1 in degrees) with u0, v0, u1, v1: the bounds, in whole metres, of their projected outlines.

    An outline with a point that cannot be projected is dropped.
    """
    at = lambda p: project(p["x"], p["y"])
    out = outline(boxes, segments).withColumn("ring", F.explode(F.array(F.transform("ring", at))))
    bad = F.exists("ring", lambda p: p["x"].isNull() | p["y"].isNull() | F.isnan(p["x"]) | F.isnan(p["y"]))
    out = out.filter(~bad).withColumn("e__", F.explode(F.array(extent(F.col("ring")))))
    metre = lambda c: F.floor(F.col(f"e__.{c}") + 0.5).cast("double")
    return out.withColumns({"u0": metre("west"), "v0": metre("south"), "u1": metre("east"), "v1": metre("north")}).drop("ring", "e__")


#: Direction of a side by where it ends from where it starts.
_AHEAD = {(1, 0): 0, (0, 1): 1, (-1, 0): 2, (0, -1): 3}


def trace(starts: list[tuple[int, int]], ends: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Closed rings of unit sides that have their cells on the left: corners only, from each ring's lowest, leftmost one.

    Where two cells meet in a corner only, a ring turns left and stays with its own cell.
    """
    way = lambda a, b: _AHEAD[(b[0] - a[0], b[1] - a[1])]
    leaving: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for a, b in sorted(zip(starts, ends, strict=True)):
        leaving.setdefault(a, []).append(b)
    rings = []
    for first in sorted(leaving, key=lambda p: (p[1], p[0])):
        while leaving[first]:
            at, to, corners = first, leaving[first].pop(), []
            begun = came = way(at, to)
            while to != first:
                at, options = to, leaving[to]
                # a left turn first, then straight on, then right
                to = min(options, key=lambda b: ((came + 1 - way(at, b)) % 4))
                options.remove(to)
                if way(at, to) != came:
                    corners.append(at)
                came = way(at, to)
            if came != begun:
                corners.insert(0, first)
            rings.append([*corners, corners[0]])
    return rings


def outlines_of_cells(cells: DataFrame, keys: list[str]) -> DataFrame:
    """keys and rings of the area that each key's cells (row, col) fill, one cell being one unit, x along columns.

    Outer rings run counterclockwise, holes clockwise; with a region's label among the keys (of regions(eight=False))
    there is one outer ring and it stands first. Sides inside an area cancel out in an aggregate; only the rest of one
    key, which is a row of the result, meets in a task.
    """
    x, y = F.col("col").cast("long"), F.col("row").cast("long")
    side = lambda across, i, j, back: F.struct(F.lit(across).alias("across"), i.alias("i"), j.alias("j"), F.lit(back).alias("back"))
    around = F.array(side(True, x, y, False), side(False, x + 1, y, False), side(True, x, y + 1, True), side(False, x, y, True))
    single = cells.select(*keys, "row", "col").distinct().select(*keys, F.explode(around).alias("s")).select(*keys, "s.*")
    single = single.groupBy(*keys, "across", "i", "j").agg(F.count("*").alias("n"), F.first("back").alias("back")).filter("n = 1").drop("n")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in single.select(*keys).schema) + f", rings array<{RING}>"

    def run(t: pa.Table) -> pa.Table:
        starts, ends = [], []
        for across, i, j, back in zip(*[t.column(c).to_pylist() for c in ("across", "i", "j", "back")], strict=True):
            a, b = (i, j), ((i + 1, j) if across else (i, j + 1))
            starts.append(b if back else a)
            ends.append(a if back else b)
        area = lambda r: sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(r, r[1:], strict=False))
        rings = sorted(trace(starts, ends), key=lambda r: area(r) < 0)
        points = pa.array([[[{"x": float(px), "y": float(py)} for px, py in r] for r in rings]], pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))
        return pa.table({**{k: t.column(k).combine_chunks()[:1] for k in keys}, "rings": points})

    return single.groupBy(*keys).applyInArrow(run, schema)
