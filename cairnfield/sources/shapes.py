"""Shapes and their attributes in shape files: ranges of the index file's records are dealt over tasks, which read their bytes alone.

Rows are as features.features gives those of GeoJSON, so both are used alike. Heights and measures are not read. Attributes are
texts without blanks at their ends, empty ones null; records marked as deleted have no row, nor have files that cannot be read.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from cairnfield.sources.tiff import ranges, uri

#: What kinds of shapes are called; kinds with heights or measures are 10 and 20 above.
EMPTY, POINT, LINE, POLYGON, POINTS = 0, 1, 3, 5, 8
HEADER, ENTRY, DELETED = 100, 8, b"*"
#: Records that a task takes.
RECORDS = 10_000
BROKEN = (ValueError, KeyError, IndexError, struct.error, OSError, UnicodeDecodeError)
PARTS = "path string, first long, last long"
ROWS = "path string, record long, properties map<string, string>, kind string, coordinates string, xmin double, xmax double, ymin double, ymax double"


def _area(ring: np.ndarray) -> float:
    """Twice the signed area, above 0 where the ring turns left."""
    x, y = (ring - ring[0]).T
    return float(np.sum(x[:-1] * y[1:] - x[1:] * y[:-1]))


def _holds(ring: np.ndarray, place: np.ndarray) -> bool:
    (x0, y0), (x1, y1) = ring[:-1].T, ring[1:].T
    cut = (y0 > place[1]) != (y1 > place[1])
    at = x0[cut] + (place[1] - y0[cut]) / (y1[cut] - y0[cut]) * (x1[cut] - x0[cut])
    return bool((at > place[0]).sum() % 2)


def polygons(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Rings by polygon: those that turn right are outer ones, a hole goes to the smallest of them that holds its first place.

    A hole that no outer ring holds is a polygon of its own.
    """
    outer = [[r] for r in rings if _area(r) <= 0]
    for hole in (r for r in rings if _area(r) > 0):
        holders = [p for p in outer if _holds(p[0], hole[0])]
        if holders:
            min(holders, key=lambda p: abs(_area(p[0]))).append(hole)
        else:
            outer.append([hole])
    return outer


def geometry(raw: bytes) -> tuple[str | None, list | None]:
    """(kind, coordinates) of a record's content, as GeoJSON has them."""
    kind = struct.unpack_from("<i", raw)[0] % 10
    if kind == EMPTY:
        return None, None
    if kind == POINT:
        return "Point", list(struct.unpack_from("<2d", raw, 4))
    if kind == POINTS:
        (n,) = struct.unpack_from("<i", raw, 36)
        return "MultiPoint", np.frombuffer(raw, "<f8", 2 * n, 40).reshape(-1, 2).tolist()
    if kind not in (LINE, POLYGON):
        raise ValueError("unknown kind of shape")
    parts, n = struct.unpack_from("<2i", raw, 36)
    cuts = [*np.frombuffer(raw, "<i4", parts, 44).tolist(), n]
    places = np.frombuffer(raw, "<f8", 2 * n, 44 + 4 * parts).reshape(-1, 2)
    lines = [places[a:b] for a, b in zip(cuts, cuts[1:], strict=False) if b > a]
    if not lines:
        return None, None
    if kind == LINE:
        return ("LineString", lines[0].tolist()) if len(lines) == 1 else ("MultiLineString", [p.tolist() for p in lines])
    found = [[r.tolist() for r in p] for p in polygons(lines)]
    return ("Polygon", found[0]) if len(found) == 1 else ("MultiPolygon", found)


def _size(path: str) -> int:
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(uri(path))
    size = system.get_file_info(place).size
    if size is None:
        raise FileNotFoundError(path)
    return size


def attributes(read: Callable[[int, int], bytes], first: int, last: int, encoding: str) -> list[dict | None]:
    """The attributes of records first to last of a table's file, None where they are deleted."""
    head = read(0, 32)
    total, start, width = struct.unpack_from("<IHH", head, 4)
    names, described = [], read(32, start - 32)
    for k in range(0, len(described) - 31, 32):
        if described[k] == 13:  # ends the list
            break
        names.append((described[k : k + 11].split(b"\0")[0].decode(encoding), described[k + 16]))
    if last > total:
        raise ValueError("fewer attributes than shapes")
    raw, out = read(start + first * width, (last - first) * width), []
    for k in range(0, len(raw), width):
        at, row = k + 1, {}
        for name, size in names:
            row[name] = raw[at : at + size].strip(b" \0").decode(encoding) or None
            at += size
        out.append(None if raw[k : k + 1] == DELETED else row)
    return out


def read_shapes(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """ROWS of the .shp files of a folder or a glob; the .shx and .dbf files beside them are needed."""

    def parts(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for p in batch.column(0).to_pylist():
                try:
                    count = (_size(p[:-4] + ".shx") - HEADER) // ENTRY
                except BROKEN:
                    continue
                first = np.arange(0, count, RECORDS)
                yield pa.record_batch([pa.array([p] * len(first), pa.string()), pa.array(first), pa.array(np.minimum(first + RECORDS, count))], names=["path", "first", "last"])

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.string(), pa.int64(), pa.map_(pa.string(), pa.string()), pa.string(), pa.string(), *[pa.float64()] * 4]
        for batch in batches:
            for r in batch.to_pylist():
                try:
                    stem, first, last = r["path"][:-4], r["first"], r["last"]
                    index = np.frombuffer(ranges(stem + ".shx")(HEADER + first * ENTRY, (last - first) * ENTRY), ">i4").reshape(-1, 2).astype(np.int64) * 2
                    low, high = int(index[:, 0].min()), int((index.sum(1) + 8).max())
                    raw, held = ranges(r["path"])(low, high - low), attributes(ranges(stem + ".dbf"), first, last, encoding)
                    out = []
                    for k, (at, size) in enumerate((index - [low, 0]).tolist()):
                        if held[k] is not None:
                            kind, places = geometry(raw[at + 8 : at + 8 + size])
                            flat = np.array(_flat(places)).reshape(-1, 2) if kind else None
                            ends = [None] * 4 if kind is None or not len(flat) else [f(flat[:, a]).item() for a in (0, 1) for f in (np.min, np.max)]
                            out.append((r["path"], first + k, list(held[k].items()), kind, json.dumps(places) if kind else None, *ends))
                except BROKEN:
                    continue
                if out:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["path", "record", "properties", "kind", "coordinates", "xmin", "xmax", "ymin", "ymax"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.shp").load(path).select("path")
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return files.mapInArrow(parts, PARTS).repartition(tasks, "path", "first").mapInArrow(rows, ROWS)


def _flat(places: list) -> list:
    return places if not isinstance(places[0], list) else [v for p in places for v in _flat(p)]
