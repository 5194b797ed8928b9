"""Watershed of a raster of any size: tiles are flooded on their own and again where what stands beside them is another thing.

A cell is reached at a height, the least that any way to it from a marker must climb, and after a number of steps on that height.
It takes the label of the neighbour from which that way comes; of several, of the one that is itself reached first, then of the
smallest label. So a cell's label follows from its neighbours' states alone, whatever the tiles are, and as ways climb with every
step, no two sets of states agree with themselves.

Tiles are first flooded with the cells within HALO of them. Where the cells beside a tile then have the states in their own tiles
that they had in its flood, it is done: most tiles are, where ways are short. A round floods the others, from their markers and from
the border cells beside them, anew; rounds end when no border cell changes. Border cells alone pass between tiles, and a task holds
one tile at a time.

With compactness the distance to the marker's cell, times it, adds to a cell's height. Then a better way to a cell may be a worse
one to the next, so states may have to be taken back: each border cell names the cell beside the tile from which its way came, with
that cell's state, and is passed on only while the two agree. Ways climb with every step, so none can support itself.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnfield.operators.components import settled

#: Cells of a tile's side.
STEP = 512
#: Cells around a tile with which it is first flooded.
HALO = 16
MAX_ROUNDS = 10_000
TILE = ["tile_row", "tile_col"]
STATE = "row long, col long, height double, steps long, label long, from_row long, from_col long"
NAMES = [c.split()[0] for c in STATE.split(", ")]
#: A border cell's state, and that of the cell beside the tile by which its way came in; nulls where it began in the tile.
BORDER = ", ".join([STATE, *(f"in_{c}" for c in STATE.split(", "))])
BORDER_NAMES = [c.split()[0] for c in BORDER.split(", ")]
#: What a tile's flood gives: its border cells, the cells beside it as it saw them (seen), and a row of arrays of all its cells' labels.
FLOODED = f"tile_row long, tile_col long, kind string, {BORDER}, rows array<long>, cols array<long>, labels array<long>"
FLOODED_NAMES = [c.split()[0] for c in FLOODED.split(", ")]


def reached(surface: np.ndarray, markers: np.ndarray, mask: np.ndarray, compactness: float = 0.0, corner: tuple[int, int] = (0, 0), offers: Iterable[tuple] = (), own: np.ndarray | None = None) -> dict[tuple[int, int], tuple]:
    """{(row, col): (height, steps, label, from_row, from_col, the cell beside the tile it came by, or None)} of the cells that are reached.

    The first cell is the corner; places are those of the whole raster. offers: rows as STATE says of cells beside those that are
    given. own: the tile's cells among those given; all, if it is None. A cell is settled when it is taken off the heap, as no
    later way to it is lower or shorter; of the ways to it only those are put there that are better than all before.
    """
    top, left = corner
    rows, cols = mask.shape
    wide = cols + 2  # a frame of cells that are not held is around the grid
    heights = np.pad(surface, 1).ravel().tolist()
    free = bytearray(np.pad(mask, 1).astype(np.uint8).tobytes())
    inside = bytearray(np.pad(mask if own is None else own, 1).astype(np.uint8).tobytes())
    best: list[tuple | None] = [None] * len(free)
    heap: list[tuple] = []

    def offer(q: int, i: int, k: int, state: tuple, entry: tuple | None) -> None:
        height, steps, label, r0, c0 = state
        at = heights[q] + compactness * math.hypot(i - r0, k - c0) if compactness else heights[q]
        way = (height, steps + 1, *state) if at <= height else (at, 1, *state)
        if best[q] is None or way < best[q]:
            best[q] = way
            heapq.heappush(heap, (*way, q, entry))

    for a, b in zip(*np.nonzero(markers * mask), strict=True):
        i, k, q = int(a) + top, int(b) + left, (int(a) + 1) * wide + int(b) + 1
        best[q] = (heights[q], 0, -math.inf, 0, int(markers[a, b]), i, k)
        heapq.heappush(heap, (*best[q], q, None))
    for row, col, *state in offers:
        entry = (int(row), int(col), *state)
        for i, k in ((row - 1, col), (row + 1, col), (row, col - 1), (row, col + 1)):
            a, b = int(i) - top, int(k) - left
            if 0 <= a < rows and 0 <= b < cols and mask[a, b]:
                offer((a + 1) * wide + b + 1, int(i), int(k), tuple(state), entry)
    out: dict[tuple[int, int], tuple] = {}
    while heap:
        height, steps, _, _, label, r0, c0, p, entry = heapq.heappop(heap)
        if not free[p]:
            continue
        free[p] = 0
        i, k = p // wide - 1 + top, p % wide - 1 + left
        state = (height, steps, label, r0, c0)
        out[i, k] = (*state, entry)
        for q, x, y in ((p - wide, i - 1, k), (p + wide, i + 1, k), (p - 1, i, k - 1), (p + 1, i, k + 1)):
            if free[q]:
                offer(q, x, y, state, entry if inside[p] else (i, k, *state) if inside[q] else None)
    return out


def flood(surface: np.ndarray, markers: np.ndarray, mask: np.ndarray, compactness: float = 0.0) -> np.ndarray:
    """Labels of a raster that is one tile; 0 where no marker reaches."""
    out = np.zeros(mask.shape, np.int64)
    for place, state in reached(surface, markers, mask, compactness).items():
        out[place] = state[2]
    return out


def _flooded(cells: DataFrame, beside: DataFrame, step: int, compactness: float) -> DataFrame:
    """FLOODED of tiles (tile_row, tile_col, row, col, value, marker), whose cells may be others' too, with the states beside them."""

    def one(given: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        if given.empty:
            return pd.DataFrame(columns=FLOODED_NAMES)
        tile = tuple(int(given[c].iloc[0]) for c in TILE)
        row, col = given["row"].to_numpy(), given["col"].to_numpy()
        own = (row // step == tile[0]) & (col // step == tile[1])
        if not own.any():
            return pd.DataFrame(columns=FLOODED_NAMES)
        corner = (int(row.min()), int(col.min()))
        r, c = row - corner[0], col - corner[1]
        grid = (int(r.max()) + 1, int(c.max()) + 1)
        surface, markers, mask, held = np.zeros(grid), np.zeros(grid, np.int64), np.zeros(grid, bool), np.zeros(grid, bool)
        surface[r, c], markers[r, c], mask[r, c], held[r, c] = given["value"], given["marker"], True, own
        found = reached(surface, markers, mask, compactness, corner, near[NAMES].itertuples(index=False, name=None), held)
        top, left = tile[0] * step, tile[1] * step
        none, no_cells = (None,) * len(NAMES), (None,) * 3
        rows = []
        for place, state in found.items():
            a, b = place[0] - top, place[1] - left
            down, across = 0 <= a < step, 0 <= b < step
            if down and across:
                if a in (0, step - 1) or b in (0, step - 1):
                    rows.append((*tile, "border", *place, *state[:5], *(state[5] or none), *no_cells))
            elif (down and b in (-1, step)) or (across and a in (-1, step)):
                rows.append((*tile, "seen", *place, *state[:5], *none, *no_cells))
        at = list(zip(row[own].tolist(), col[own].tolist(), strict=True))
        labels = np.array([found[p][2] if p in found else 0 for p in at], np.int64)
        rows.append((*tile, "labels", *none, *none, row[own], col[own], labels))
        return pd.DataFrame(rows, columns=FLOODED_NAMES, dtype=object)

    return cells.groupBy(*TILE).cogroup(beside.groupBy(*TILE)).applyInPandas(one, FLOODED)


def _tile(step: int) -> list:
    return [F.expr(f"floor({c} / {step})").cast("long").alias(f"tile_{c}") for c in ("row", "col")]


def _beside(states: DataFrame, step: int) -> DataFrame:
    """states once for each tile but their own in which they have a neighbour, as (tile_row, tile_col, ..)."""
    near = F.array(*[F.struct(F.floor((F.col("row") + i) / step).alias("tile_row"), F.floor((F.col("col") + k) / step).alias("tile_col")) for i, k in ((-1, 0), (1, 0), (0, -1), (0, 1))])
    own = F.struct(*_tile(step))
    return states.select("*", F.inline(F.filter(near, lambda t: t != own)))


def _with_halo(cells: DataFrame, step: int, halo: int) -> DataFrame:
    """cells once for each tile, of those between the first and the last, from which they are no farther than the halo."""
    ends = cells.agg(*[f(c).alias(f"{n}_{c}") for c in TILE for n, f in (("min", F.min), ("max", F.max))]).first()
    if ends["min_tile_row"] is None:
        return cells
    for c in ("row", "col"):
        low, high = (F.floor((F.col(c) + d) / step).cast("long") for d in (-halo, halo))
        near = F.sequence(F.greatest(low, F.lit(ends[f"min_tile_{c}"])), F.least(high, F.lit(ends[f"max_tile_{c}"])))
        cells = cells.withColumn(f"tile_{c}", F.explode(near))
    return cells


def _agreed(states: DataFrame) -> DataFrame:
    """The border cells of BORDER whose way came by no cell, or by one that still has the state it had then."""
    known = states.select(*[F.col(n).alias(f"at_{n}") for n in NAMES])
    same = [F.col(f"in_{n}") == F.col(f"at_{n}") for n in NAMES]
    return states.where("in_row is null").union(states.join(known, same, "left_semi"))


def watershed(cells: DataFrame, step: int = STEP, compactness: float = 0.0) -> DataFrame:
    """(row, col, label) of cells (row, col, value, marker); label 0 stands for cells that no marker reaches.

    step: cells of a side of the tiles that tasks flood; it changes no label. A null marker or 0 is none; a cell's value must
    be there.
    """
    held = cells.select(F.col("row").cast("long"), F.col("col").cast("long"), F.col("value").cast("double"), F.coalesce(F.col("marker").cast("long"), F.lit(0)).alias("marker"))
    held = settled(held.select(*_tile(step), "*"))
    none = held.sparkSession.createDataFrame([], BORDER)
    first = settled(_flooded(_with_halo(held, step, HALO), _beside(none, step), step, compactness))
    known = first.where("kind = 'labels'")
    there, states = known.select(TILE), first.where("kind = 'border'").select(BORDER_NAMES)
    seen = first.where("kind = 'seen'").select(*TILE, *NAMES)
    flooded_again = there.limit(0)
    for _ in range(MAX_ROUNDS):
        offered = settled(_agreed(states)) if compactness else states
        # cells at the raster's own edge have no tile beside them
        beside = settled(_beside(offered.select(NAMES), step).join(there.hint("merge"), TILE, "left_semi").select(*TILE, *NAMES))
        again = settled(beside.exceptAll(seen).union(seen.exceptAll(beside)).select(TILE).distinct())
        if again.isEmpty():
            break
        now = _flooded(held.join(again, TILE, "left_semi"), beside.join(again, TILE, "left_semi"), step, compactness)
        rest = states.select("*", *_tile(step)).join(again, TILE, "left_anti")
        states = settled(rest.drop(*TILE).union(now.where("kind = 'border'").select(BORDER_NAMES)))
        flooded_again, seen = settled(flooded_again.union(again).distinct()), beside
    else:
        raise RuntimeError("borders did not settle")
    last = _flooded(held.join(flooded_again, TILE, "left_semi"), beside.join(flooded_again, TILE, "left_semi"), step, compactness)
    labels = known.join(flooded_again, TILE, "left_anti").union(last.where("kind = 'labels'").select(known.columns))
    return labels.select(F.inline(F.arrays_zip(F.col("rows").alias("row"), F.col("cols").alias("col"), F.col("labels").alias("label"))))
