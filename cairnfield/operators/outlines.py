"""Traced outlines of objects: rings of corners, with holes given to the part that they lie in.

The sides of cells that face another object, or none, are boundary. They run with their cell on the left hand, so that outer rings
go counterclockwise and holes clockwise where rows go down. Sides in one line are one segment; a segment's successor starts where
it ends. Rings are then ranked by pointer doubling: each segment knows the least segment among its next 1, 2, 4, .. and how many
steps it is away, so that the rounds are as many as the logarithm of the longest ring's corners, and no ring is walked by one task.

Rings are made for each 4-connected part of an object. Where two cells of one part meet at a corner alone, a ring stays with the gap
between them, and otherwise with the cell, so no ring touches itself and parts are valid polygons; objects joined by corners alone
are polygons that touch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairnfield.operators.cells import components
from cairnfield.operators.components import MAX_ROUNDS, settled

#: Directions in counterclockwise order.
EAST, NORTH, WEST, SOUTH = range(4)


def segments(labels: DataFrame, cols: int) -> DataFrame:
    """(id, label, part, row, col, to_row, to_col, dir): boundary segments between corners of cells (row, col, label)."""
    parts = components(labels.select("row", "col", "label"), cols, by="label")
    own = parts.select("row", "col", F.col("by").alias("label"), F.col("label").alias("part"))
    # the side of a cell at (row, col): flat ones lie over it or under it, others left or right of it
    side = lambda flat, row, col, way: F.struct(F.lit(flat).alias("flat"), row.alias("line"), col.alias("at"), F.lit(way).alias("dir"))
    r, c = F.col("row").cast("long"), F.col("col").cast("long")
    four = F.array(side(True, r, c, WEST), side(True, r + 1, c, EAST), side(False, c, r, SOUTH), side(False, c + 1, r, NORTH))
    sides = own.select("label", "part", F.explode(four).alias("s")).select("label", "part", "s.*")
    edge = sides.groupBy("label", "part", "flat", "line", "at").agg(F.count("*").alias("n"), F.min("dir").alias("dir")).where("n = 1")
    w = Window.partitionBy("part", "dir", "line").orderBy("at")
    runs = edge.withColumn("island", F.col("at") - F.row_number().over(w))
    runs = runs.groupBy("label", "part", "dir", "flat", "line", "island").agg(F.min("at").alias("a"), (F.max("at") + 1).alias("b"))
    up = F.col("dir").isin(EAST, SOUTH)  # from the lesser place to the greater
    first, last = F.when(up, F.col("a")).otherwise(F.col("b")), F.when(up, F.col("b")).otherwise(F.col("a"))
    place = lambda at: (F.when(F.col("flat"), F.col("line")).otherwise(at), F.when(F.col("flat"), at).otherwise(F.col("line")))
    (row, col), (to_row, to_col) = place(first), place(last)
    out = runs.select("label", "part", row.alias("row"), col.alias("col"), to_row.alias("to_row"), to_col.alias("to_col"), "dir")
    return out.select(((F.col("row") * (cols + 1) + F.col("col")) * 4 + F.col("dir")).alias("id"), "*")


def successors(edges: DataFrame) -> DataFrame:
    """(id, next): of the segments that start where one ends, that to the right if there are two."""
    ends = edges.select("id", "part", F.col("to_row").alias("row"), F.col("to_col").alias("col"), "dir")
    starts = edges.select(F.col("id").alias("next"), "part", "row", "col", F.col("dir").alias("way"))
    both = ends.join(starts, ["part", "row", "col"]).withColumn("turn", F.pmod(F.col("way") - F.col("dir"), F.lit(4)))
    return both.where("turn in (1, 3)").groupBy("id").agg(F.max_by("next", "turn").alias("next"))


def ranked(following: DataFrame) -> DataFrame:
    """(id, ring, away) of (id, next), each id being the next of one: the least id of its ring, and the steps to it."""
    state = settled(following.select("id", "next", F.when(F.col("next") < F.col("id"), F.col("next")).otherwise(F.col("id")).alias("ring"), F.when(F.col("next") < F.col("id"), F.lit(1)).otherwise(F.lit(0)).cast("long").alias("away")))
    # away counts from the segment, ring is the least of its first `reach` successors and itself
    reach = 1
    for _ in range(MAX_ROUNDS):
        ahead = state.select(F.col("id").alias("next"), F.col("next").alias("then"), F.col("ring").alias("far"), F.col("away").alias("steps"))
        less = F.col("far") < F.col("ring")
        moved = state.join(ahead, "next").select("id", F.col("then").alias("next"), F.when(less, F.col("far")).otherwise(F.col("ring")).alias("ring"), F.when(less, F.col("steps") + reach).otherwise(F.col("away")).alias("away"), less.alias("changed"))
        state = settled(moved)
        if state.where("changed").isEmpty():
            return state.select("id", "ring", "away")
        reach *= 2
    raise RuntimeError("rings did not close")


def rings(labels: DataFrame, cols: int) -> DataFrame:
    """(label, part, ring, hole, area, points): closed rings of the corners (row, col), from the least segment on.

    area is that within the ring, in cells, negative for holes.
    """
    edges = settled(segments(labels, cols))
    held = edges.join(ranked(successors(edges)), "id")
    # the sum over segments of x dy - y dx, y going up, so that counterclockwise rings are positive
    twice = F.sum(F.col("col") * -F.col("to_row") + F.col("row") * F.col("to_col"))
    order = F.when(F.col("away") == 0, F.lit(None).cast("long")).otherwise(-F.col("away"))  # nulls first, then falling
    points = F.sort_array(F.collect_list(F.struct(order.alias("k"), "row", "col")))
    out = held.groupBy("label", "part", "ring").agg((twice / 2).alias("area"), points.alias("p"))
    corners = F.transform("p", lambda p: F.struct(p["row"].alias("row"), p["col"].alias("col")))
    return out.select("label", "part", "ring", (F.col("area") < 0).alias("hole"), "area", F.concat(corners, F.slice(corners, 1, 1)).alias("points"))


def outlines(labels: DataFrame, cols: int, x: float = 0.0, y: float = 0.0, size: float = 1.0) -> DataFrame:
    """(label, geometry): each object of cells (row, col, label) as a GeoJSON MultiPolygon, a polygon a 4-connected part.

    (x, y) is the outer corner of cell (0, 0) and size the side of a cell; rows go down. A polygon's first ring is its outer one,
    its holes follow. Nulls in row, col or label are left out.
    """
    known = labels.select("row", "col", "label").dropna()
    position = lambda p: F.array(F.lit(x) + p["col"] * size, F.lit(y) - p["row"] * size)
    ring = F.struct("hole", F.col("ring").alias("k"), F.transform("points", position).alias("positions"))
    parts = rings(known, cols).groupBy("label", "part").agg(F.sort_array(F.collect_list(ring)).alias("r"))
    polygon = F.struct("part", F.transform("r", lambda r: r["positions"]).alias("rings"))
    out = parts.groupBy("label").agg(F.sort_array(F.collect_list(polygon)).alias("p"))
    return out.select("label", F.struct(F.lit("MultiPolygon").alias("type"), F.transform("p", lambda p: p["rings"]).alias("coordinates")).alias("geometry"))


def signed_area(geometry: Column) -> Column:
    """The area of a MultiPolygon's outer rings less that of its holes."""
    lines = F.flatten("geometry.coordinates") if isinstance(geometry, str) else F.flatten(geometry["coordinates"])
    ends = lambda r: F.zip_with(F.slice(r, 1, F.size(r) - 1), F.slice(r, 2, F.size(r) - 1), lambda a, b: a[0] * b[1] - a[1] * b[0])
    add = lambda values: F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
    return add(F.transform(lines, lambda r: add(ends(r)))) / 2
