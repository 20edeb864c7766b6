"""Greedy tiered set cover: which observations a tile needs, in order.

State depends on every pick before, so a tile is one group of Arrow batches; it holds one byte a candidate and cell.
Candidates that can never be picked beside an equal one are dropped before, by an aggregate.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The penalty of a mixed-mode candidate, in cells, and the least gain when only gaps are open.
MIXED_PENALTY, GAP_LEAST = 0.5, 4


def greedy(masks: np.ndarray, fill: np.ndarray, bw: np.ndarray, mixed: np.ndarray, forced: list[int], cells: int, least_share: float, target: np.ndarray | None) -> list[tuple[int, int]]:
    """(candidate, new cells) in pick order. masks: candidates x cells.

    Forced ones come first in their order. Tiers ascend by catalogue and then descend by bandwidth; in a tier
    unmixed candidates stand before mixed ones, of equal gains the last in the list wins, and a tier ends when the best
    gain is too small. With a target only its cells are open, whatever was forced before.
    """
    covered, picks = np.zeros(masks.shape[1], dtype=bool), []
    for k in forced:
        picks.append((k, int((masks[k] & ~covered).sum())))
        covered |= masks[k]
    least = max(int(least_share * cells), 1)
    if target is not None:
        covered, least = ~target, GAP_LEAST
    free = [k for k in range(len(masks)) if k not in set(forced)]
    for tier in sorted({(fill[k], -bw[k]) for k in free}):
        ranked = sorted((k for k in free if (fill[k], -bw[k]) == tier), key=lambda k: bool(mixed[k]))
        while ranked:
            gains = (masks[ranked] & ~covered).sum(axis=1)
            scores = gains - MIXED_PENALTY * mixed[ranked]
            best = len(ranked) - 1 - int(np.argmax(scores[::-1]))
            if scores[best] < least:
                break
            k = ranked.pop(best)
            picks.append((k, int(gains[best])))
            covered |= masks[k]
    return picks


def last_of_equals(candidates: DataFrame, extent: list[str], ordinal: str = "ordinal") -> DataFrame:
    """extent, fill, bw, mixed, forced, ordinal: of free candidates of one tier and one extent the last, and all forced ones.

    No pick is lost: of equal gains the last wins, and what it opened leaves its equals no gain, while a pick needs one cell
    at least. The extent is all that a candidate covers, so one of several boxes must come with all of them in it. Forced
    places are one a candidate.
    """
    return candidates.groupBy(*extent, "fill", "bw", "mixed", "forced").agg(F.max(ordinal).alias(ordinal))


def cover(cells: DataFrame, least_share: float = 0.001) -> DataFrame:
    """tile, seq, name, new_cells of cells (tile, name, ordinal, fill, bw, mixed, forced, cell, n_cells, target).

    One row a candidate and cell, or a candidate and an array of cells; forced is the place among forced picks or null;
    target is null, or the flag of the row's cells when only gaps are open. Candidates stand in order of ordinal. The share
    is of the tile's n_cells.
    """

    def run(t: pa.Table) -> pa.Table:
        cell, d = t["cell"].combine_chunks(), t.drop_columns(["cell"]).to_pandas()
        row = np.arange(len(d))
        if pa.types.is_nested(cell.type):
            row, cell = pc.list_parent_indices(cell).to_numpy(), pc.list_flatten(cell)
        names = d.drop_duplicates("name").sort_values("ordinal")
        at = {n: i for i, n in enumerate(names["name"])}
        ids, where = np.unique(cell.to_numpy(), return_inverse=True)
        masks = np.zeros((len(names), len(ids)), dtype=bool)
        masks[d["name"].map(at).to_numpy()[row], where] = True
        target = None
        if d["target"].notna().any():
            target = np.zeros(len(ids), dtype=bool)
            target[where[d["target"].fillna(False).astype(bool).to_numpy()[row]]] = True
        kept = names[names["forced"].notna()].sort_values("forced")
        picks = greedy(masks, names["fill"].to_numpy(), names["bw"].to_numpy(), names["mixed"].to_numpy(), [at[n] for n in kept["name"]], int(d["n_cells"].iloc[0]), least_share, target)
        order = names["name"].tolist()
        return pa.table({"tile": pa.array([d["tile"].iloc[0]] * len(picks), pa.string()), "seq": pa.array(range(len(picks)), pa.int64()), "name": pa.array([order[k] for k, _ in picks], pa.string()), "new_cells": pa.array([n for _, n in picks], pa.int64())})

    columns = cells.select("tile", "name", "ordinal", "fill", "bw", "mixed", "forced", "cell", "n_cells", "target")
    dealt = columns.repartition(int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions")), "tile")  # few bytes, much work: not to be coalesced
    return dealt.groupBy("tile").applyInArrow(run, "tile string, seq long, name string, new_cells long")
