"""Connected regions of raster cells, by blocks.

Cells of one block are labelled inside a task (a block is BLOCK x BLOCK cells at most), then labels that touch across
block edges are joined as a graph of block labels, which is smaller than the raster by about a block's side. Its
components come from rounds of least labels with path halving, each written out; no round sees a cell.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored

BLOCK = 256


def label_block(row: np.ndarray, col: np.ndarray, eight: bool) -> np.ndarray:
    """For each cell the place of its region's first cell in row order."""
    order = np.lexsort((col, row))
    r, c = row[order], col[order]
    height, width = int(r.max() - r.min()) + 3, int(c.max() - c.min()) + 3
    grid = np.full((height, width), -1, dtype=np.int64)
    rr, cc = r - r.min() + 1, c - c.min() + 1
    grid[rr, cc] = np.arange(len(r))
    steps = [(-1, 0), (0, -1)] + ([(-1, -1), (-1, 1)] if eight else [])
    label = np.arange(len(r))
    pairs = []
    for a, b in steps:
        other = grid[rr + a, cc + b]
        hit = other >= 0
        pairs.append(np.stack([np.flatnonzero(hit), other[hit]], axis=1))
    edges = np.concatenate(pairs)
    while True:
        low = np.minimum(label[edges[:, 0]], label[edges[:, 1]])
        new = label.copy()
        np.minimum.at(new, label[edges[:, 0]], low)
        np.minimum.at(new, label[edges[:, 1]], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    out = np.empty(len(r), dtype=np.int64)
    out[order] = order[label]
    return out


def regions(cells: DataFrame, key: str, eight: bool = True, block: int = BLOCK) -> DataFrame:
    """key, row, col, region of each distinct cell: region is the smallest cell number (row * 2**32 + col) of its region.

    Neighbours share an edge, with `eight` a corner too. key is a string column; regions never cross keys.
    """
    cells = cells.select(F.col(key).cast("string").alias("k"), F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col")).distinct()
    blocked = cells.withColumns({"br": F.floor(F.col("row") / block), "bc": F.floor(F.col("col") / block)})

    def run(t: pa.Table) -> pa.Table:
        row, col = t.column("row").to_numpy(), t.column("col").to_numpy()
        first = label_block(row, col, eight)
        return pa.table({"k": t.column("k"), "row": t.column("row"), "col": t.column("col"), "part": pa.array(row[first] * (1 << 32) + col[first])})

    parts = stored(blocked.groupBy("k", "br", "bc").applyInArrow(run, "k string, row long, col long, part long"))
    edge = parts.filter((F.pmod("row", F.lit(block)).isin(0, block - 1)) | (F.pmod("col", F.lit(block)).isin(0, block - 1)))
    steps = [(1, 0), (0, 1)] + ([(1, 1), (1, -1)] if eight else [])
    moved = edge.withColumn("s", F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in steps])))
    moved = moved.select("k", (F.col("row") + F.col("s.a")).alias("row"), (F.col("col") + F.col("s.b")).alias("col"), F.col("part").alias("other"))
    links = edge.join(moved, ["k", "row", "col"]).filter("part <> other").select("k", F.col("part").alias("a"), F.col("other").alias("b")).distinct()
    both = stored(links.unionByName(links.select("k", F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = stored(both.groupBy("k", "a").agg(F.min("b").alias("m")).select("k", F.col("a").alias("part"), F.least("a", "m").alias("region")))
    while True:
        known = labels.select("k", F.col("part").alias("b"), F.col("region").alias("l"))
        near = both.join(known, ["k", "b"]).groupBy("k", F.col("a").alias("part")).agg(F.min("l").alias("near"))
        lower = labels.join(near, ["k", "part"]).select("k", "part", F.least("region", "near").alias("to"), F.col("region").alias("was"))
        up = labels.select("k", F.col("part").alias("to"), F.col("region").alias("top"))
        new = stored(lower.join(up, ["k", "to"]).select("k", "part", F.least("to", "top").alias("region"), "was"))
        moving = new.filter("region <> was").limit(1).count()
        labels = new.drop("was")
        if not moving:
            break
    out = parts.join(labels, ["k", "part"], "left")
    return out.select(F.col("k").alias(key), "row", "col", F.coalesce("region", "part").alias("region"))


def region_summary(labelled: DataFrame, key: str, area: str | None = None, least: float = 0) -> DataFrame:
    """One row a region: cells, area, its rectangle; regions under `least` go."""
    size = F.count("*").cast("double") if area is None else F.sum(area)
    out = labelled.groupBy(key, "region").agg(F.count("*").alias("cells"), size.alias("area"), F.min("row").alias("r0"), F.max("row").alias("r1"), F.min("col").alias("c0"), F.max("col").alias("c1"))
    return out.filter(F.col("area") >= least)


def largest_first(regions_: DataFrame, area: str, least: float, top: int) -> DataFrame:
    """The `top` largest regions of at least this area; a top-k, so each task keeps no more than `top`."""
    return regions_.filter(F.col(area) >= least).orderBy(F.desc(area), *[c for c in regions_.columns if c != area]).limit(top)
