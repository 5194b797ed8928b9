"""Georeferenced rasters in TIFF files, decoded by Arrow batches: whole files of any store, or windows by ranges of bytes.

Classic and big files are read (32 and 64-bit offsets): strips or tiles, one or several bands, chunky or planar, uncompressed, LZW
or deflate, whole numbers or floats, with or without differences between neighbours; plus the tags of cell size, tie point,
coordinate system and nodata. Files that cannot be decoded have null headers and no cells; empty ones Spark does not list.

`headers` and `cells` take files through Spark's binary file source, so they may lie in any store that it reads; a file is one
task's, and spark.sql.sources.binaryFile.maxLength bounds its size. `windowed` lists a file's strips or tiles from its directory
alone, deals those that meet the window over tasks, and reads only their bytes, so that one large file is read by many tasks; its
files must lie in a store that pyarrow's file systems open (local, hdfs, s3, gs).
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tags, and bytes and codes of field types.
WIDTH, LENGTH, BITS, COMPRESSION, STRIPS, SAMPLES, STRIP_ROWS, STRIP_BYTES, PLANAR = 256, 257, 258, 259, 273, 277, 278, 279, 284
PREDICTOR, TILE_WIDTH, TILE_LENGTH, TILES, TILE_BYTES, FORMAT = 317, 322, 323, 324, 325, 339
CELL_SIZE, TIE_POINT, GEO_KEYS, NODATA = 33550, 33922, 34735, 42113
PROJECTED, GEOGRAPHIC = 3072, 2048
FIELDS = {1: (1, "B"), 2: (1, "s"), 3: (2, "H"), 4: (4, "I"), 6: (1, "b"), 8: (2, "h"), 9: (4, "i"), 11: (4, "f"), 12: (8, "d"), 13: (4, "I"), 16: (8, "Q"), 17: (8, "q"), 18: (8, "Q")}
KINDS = {1: "u", 2: "i", 3: "f"}
PLAIN, LZW, DEFLATE = (1,), (5,), (8, 32946)
#: Codes of LZW: start anew, end; the widest code has so many bits.
CLEAR, END, WIDEST = 256, 257, 12

HEADER = "path string, bands int, rows int, cols int, x double, y double, cell_width double, cell_height double, epsg int, nodata double"
CELLS = "path string, row long, col long, x double, y double, b array<double>"
#: Cells that leave a task in one Arrow batch; cells of blocks that a task of a windowed read takes, unless one block has more.
BATCH_CELLS = 100_000
TASK_CELLS = 4_000_000
#: What decoding fails with where a file is broken.
BROKEN = (ValueError, KeyError, IndexError, TypeError, struct.error, zlib.error, OSError)
BLOCKS = "path string, layout string, row long, col long, high long, wide long, starts array<long>, sizes array<long>"


@dataclass
class Raster:
    """A decoded file: values (band, row, col), the outer corner (x, y) of its first cell, and the sizes of a cell."""

    values: np.ndarray
    x: float
    y: float
    cell_width: float
    cell_height: float
    epsg: int | None
    nodata: float | None


@dataclass
class Layout:
    """What a file's directory says of its raster, but for the places of its blocks."""

    order: str
    kind: str
    bands: int
    rows: int
    cols: int
    high: int
    wide: int
    tiled: bool
    planar: bool
    packing: int
    predictor: int
    x: float
    y: float
    cell_width: float
    cell_height: float
    epsg: int | None
    nodata: float | None

    @property
    def dtype(self) -> np.dtype:
        return np.dtype(self.order + self.kind)


def tags(read: Callable[[int, int], bytes]) -> tuple[str, dict[int, tuple]]:
    """(byte order, {tag: values}) of the first directory of a file, of which read(place, size) gives bytes."""
    head = read(0, 16)
    order = {b"II": "<", b"MM": ">"}[head[:2]]
    (magic,) = struct.unpack_from(f"{order}H", head, 2)
    if magic not in (42, 43):
        raise ValueError("no TIFF file")
    big = magic == 43
    count, place = ("Q", "Q") if big else ("H", "I")
    (at,) = struct.unpack_from(f"{order}{place}", head, 8 if big else 4)
    first, inline = struct.calcsize(f"={count}"), struct.calcsize(f"={place}")
    each = 4 + 2 * inline
    (n,) = struct.unpack(f"{order}{count}", read(at, first))
    entries = read(at + first, n * each)
    out = {}
    for k in range(0, len(entries) - each + 1, each):
        tag, kind, items = struct.unpack_from(f"{order}HH{place}", entries, k)
        if kind in FIELDS:
            size, code = FIELDS[kind]
            value = entries[k + 4 + inline : k + each]
            if size * items > inline:
                value = read(struct.unpack(f"{order}{place}", value)[0], size * items)
            out[tag] = struct.unpack_from(f"{order}{items}{code}", value)
    return order, out


def layout(order: str, tag: dict[int, tuple]) -> Layout:
    rows, cols, bands = tag[LENGTH][0], tag[WIDTH][0], tag.get(SAMPLES, (1,))[0]
    packing, predictor = tag.get(COMPRESSION, PLAIN)[0], tag.get(PREDICTOR, (1,))[0]
    if packing not in PLAIN + LZW + DEFLATE or predictor not in (1, 2, 3):
        raise ValueError(f"compression {packing}, predictor {predictor}")
    keys = tag.get(GEO_KEYS, ())
    codes = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i + 1] == 0}
    nodata = b"".join(tag[NODATA]).rstrip(b"\0 ") if NODATA in tag else b""
    size, tie = tag.get(CELL_SIZE, (1.0, 1.0)), tag.get(TIE_POINT, (0.0,) * 6)
    tiled = TILES in tag
    high, wide = (tag[TILE_LENGTH][0], tag[TILE_WIDTH][0]) if tiled else (min(rows, tag.get(STRIP_ROWS, (rows,))[0]), cols)
    kind = f"{KINDS[tag.get(FORMAT, (1,))[0]]}{tag[BITS][0] // 8}"
    return Layout(
        order, kind, bands, rows, cols, high, wide, tiled, tag.get(PLANAR, (1,))[0] == 2, packing, predictor,
        tie[3] - tie[0] * size[0], tie[4] + tie[1] * size[1], size[0], size[1], codes.get(PROJECTED, codes.get(GEOGRAPHIC)), float(nodata) if nodata else None,
    )


def blocks(form: Layout, tag: dict[int, tuple]) -> Iterator[tuple[int, int, list[int], list[int]]]:
    """(first row, first col, starts, sizes) of each strip or tile: one place in the file, or one for each band of planar files."""
    starts, sizes = (tag[TILES], tag[TILE_BYTES]) if form.tiled else (tag[STRIPS], tag[STRIP_BYTES])
    across = -(-form.cols // form.wide)
    each = -(-form.rows // form.high) * across
    if len(starts) != len(sizes) or len(starts) < each * (form.bands if form.planar else 1):
        raise ValueError("blocks are missing")
    for k in range(each):
        at = range(k, each * form.bands, each) if form.planar else (k,)
        yield k // across * form.high, k % across * form.wide, [starts[i] for i in at], [sizes[i] for i in at]


def unpacked_lzw(raw: bytes) -> bytes:
    """Codes of 9 to 12 bits, highest bit first, that name a sequence of bytes each; widths change one code early."""
    single = [bytes([k]) for k in range(256)] + [b"", b""]
    words, out, last = list(single), [], b""
    bits = held = 0
    width = 9
    for byte in raw:
        held = (held << 8 | byte) & 0xFFFFFF
        bits += 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits & (1 << width) - 1
        if code == END:
            break
        if code == CLEAR:
            words, last, width = list(single), b"", 9
            continue
        if code < len(words):
            word = words[code]
        elif code == len(words) and last:
            word = last + last[:1]
        else:
            raise ValueError("a code before its word")
        out.append(word)
        if last:
            words.append(last + word[:1])
        last = word
        width = min(WIDEST, max(9, (len(words) + 1).bit_length())) if last else 9
    return b"".join(out)


def block_values(form: Layout, raw: bytes, lines: int) -> np.ndarray:
    """The values (line, col, band) of one strip or tile as it is stored."""
    depth = 1 if form.planar else form.bands
    shape, kind = (lines, form.wide, depth), form.dtype
    data = unpacked_lzw(raw) if form.packing in LZW else zlib.decompress(raw) if form.packing in DEFLATE else raw
    if form.predictor == 3:  # differences of bytes, of which the highest of a line's values stand first
        planes = np.frombuffer(data, np.uint8, lines * form.wide * depth * kind.itemsize).reshape(lines, -1, depth)
        planes = np.cumsum(planes, 1, dtype=np.uint8).reshape(lines, kind.itemsize, form.wide * depth)
        return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(kind.newbyteorder(">")).reshape(shape).astype(kind.newbyteorder("="))
    values = np.frombuffer(data, kind, lines * form.wide * depth).reshape(shape)
    return np.cumsum(values, 1, dtype=kind.newbyteorder("=")) if form.predictor == 2 else values.astype(kind.newbyteorder("="))


def block(form: Layout, read: Callable[[int, int], bytes], row: int, col: int, starts: list[int], sizes: list[int]) -> np.ndarray:
    """The values (band, row, col) of the cells of one place that lie in the raster. One without bytes is all nodata, or 0."""
    high, wide = min(form.high, form.rows - row), min(form.wide, form.cols - col)
    lines = form.high if form.tiled else high
    parts = []
    for start, size in zip(starts, sizes, strict=True):
        depth = 1 if form.planar else form.bands
        part = block_values(form, read(start, size), lines) if size else np.full((lines, form.wide, depth), form.nodata or 0, form.dtype.newbyteorder("="))
        parts.append(part[:high, :wide].transpose(2, 0, 1))
    return np.concatenate(parts) if len(parts) > 1 else parts[0]


def decoded(content: bytes, values: bool = True) -> Raster:
    """A file's raster; without values, its header alone with an array that takes no memory."""
    read = lambda at, size: content[at : at + size]
    order, tag = tags(read)
    form = layout(order, tag)
    shape = (form.bands, form.rows, form.cols)
    grid = np.broadcast_to(form.dtype.type(0), shape)
    if values:
        grid = np.zeros(shape, form.dtype.newbyteorder("="))
        for row, col, starts, sizes in blocks(form, tag):
            part = block(form, read, row, col, starts, sizes)
            grid[:, row : row + part.shape[1], col : col + part.shape[2]] = part
    return Raster(grid, form.x, form.y, form.cell_width, form.cell_height, form.epsg, form.nodata)


def cell_batches(name: str, values: np.ndarray, top: int, left: int, form: Raster | Layout, factor: float, nodata: float | None, window: tuple[int, int, int, int] | None = None) -> Iterator:
    """Arrow batches as CELLS says of values (band, row, col) whose first cell is (top, left), cut to a window of the raster."""
    import pyarrow as pa

    if window:
        r0, r1, c0, c1 = window
        values = values[:, max(0, r0 - top) : max(0, r1 - top), max(0, c0 - left) : max(0, c1 - left)]
        top, left = max(top, r0), max(left, c0)
    none = form.nodata if nodata is None else nodata
    bands, rows, cols = values.shape
    step = max(1, BATCH_CELLS // max(1, cols))
    for first in range(0, rows, step):
        part = values[:, first : first + step].reshape(bands, -1).T.astype(float)
        missing = np.isnan(part) if none is None else np.isnan(part) | (part == none)
        held = np.flatnonzero(~missing.all(1))
        row, col = top + first + held // cols, left + held % cols
        flat = pa.array((part[held] / factor).reshape(-1), mask=missing[held].reshape(-1))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(held) + 1) * bands, pa.int32()), flat)
        x, y = form.x + (col + 0.5) * form.cell_width, form.y - (row + 0.5) * form.cell_height
        yield pa.record_batch([pa.array([name] * len(held), pa.string()), pa.array(row), pa.array(col), pa.array(x), pa.array(y), lists], names=[c.split()[0] for c in CELLS.split(", ")])


def _files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row a file, as HEADER says: x and y are the outer corner of the first cell. Nulls where it cannot be opened."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = []
            for name, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    r = decoded(content, values=False)
                    rows.append((name, *r.values.shape, r.x, r.y, r.cell_width, r.cell_height, r.epsg, r.nodata))
                except BROKEN:
                    rows.append((name, *[None] * 9))
            kinds = [pa.string(), *[pa.int32()] * 3, *[pa.float64()] * 4, pa.int32(), pa.float64()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[x.split()[0] for x in HEADER.split(", ")])

    return _files(spark, path).mapInArrow(run, HEADER)


def cells(spark: SparkSession, path: str | list[str], factor: float = 1.0, nodata: float | None = None) -> DataFrame:
    """Cells as CELLS says: b is divided by factor, x and y are the cell's centre. Unreadable files are left out.

    A band that holds nodata (the file's own where none is given) or NaN is null; cells without any band are left out.
    """

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                try:
                    r = decoded(content.as_py())
                except BROKEN:
                    continue
                yield from cell_batches(name, r.values, 0, 0, r, factor, nodata)

    return _files(spark, path).mapInArrow(run, CELLS)


def uri(path: str) -> str:
    """A path as Spark writes it, as pyarrow's file systems take it."""
    if path.startswith("file:"):
        return "file:///" + path.removeprefix("file:").lstrip("/")
    return path if "://" not in path else "s3" + path[3:] if path.startswith(("s3a:", "s3n:")) else path


def ranges(path: str) -> Callable[[int, int], bytes]:
    """read(place, size) of a file; it opens the file once and reads the bytes asked for alone."""
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(uri(path))
    file = system.open_input_file(place)

    def read(at: int, size: int) -> bytes:
        return file.read_at(size, at)

    return read


def places(spark: SparkSession, path: str | list[str], window: tuple[int, int, int, int] | None = None) -> DataFrame:
    """BLOCKS: the strips or tiles of files that meet the window (first row, row after the last, first col, col after the last).

    Files' directories are read in tasks; contents are not. Files that cannot be opened are left out.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.string(), pa.string(), *[pa.int64()] * 4, *[pa.list_(pa.int64())] * 2]
        for batch in batches:
            for name in batch.column(0).to_pylist():
                try:
                    order, tag = tags(ranges(name))
                    form = layout(order, tag)
                    found = [(name, json.dumps(asdict(form)), r, c, min(form.high, form.rows - r), min(form.wide, form.cols - c), s, n) for r, c, s, n in blocks(form, tag)]
                except BROKEN:
                    continue
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names=[c.split()[0] for c in BLOCKS.split(", ")])

    out = spark.read.format("binaryFile").load(path).select("path").mapInArrow(run, BLOCKS)
    if window:
        r0, r1, c0, c1 = window
        out = out.where((F.col("row") < r1) & (F.col("row") + F.col("high") > r0) & (F.col("col") < c1) & (F.col("col") + F.col("wide") > c0))
    return out


def windowed(spark: SparkSession, path: str | list[str], window: tuple[int, int, int, int] | None = None, factor: float = 1.0, nodata: float | None = None) -> DataFrame:
    """Cells as cells() gives them, of a window of each file or of all of it; blocks that cannot be decoded are left out.

    The blocks found are counted first, so that as many tasks read them as their cells need.
    """
    found = places(spark, path, window)
    cells = found.agg(F.sum(F.col("high") * F.col("wide"))).first()[0] or 0
    tasks = max(1, -(-cells // TASK_CELLS), min(spark.sparkContext.defaultParallelism, -(-cells // BATCH_CELLS)))

    def run(batches: Iterator) -> Iterator:
        opened, read, form = None, None, None
        for batch in batches:
            for r in batch.to_pylist():
                try:
                    if r["path"] != opened:
                        opened, read, form = r["path"], ranges(r["path"]), Layout(**json.loads(r["layout"]))
                    values = block(form, read, r["row"], r["col"], r["starts"], r["sizes"])
                except BROKEN:
                    continue
                yield from cell_batches(r["path"], values, r["row"], r["col"], form, factor, nodata, window)

    return found.repartition(tasks, "path", "row", "col").sortWithinPartitions("path", "row", "col").mapInArrow(run, CELLS)
