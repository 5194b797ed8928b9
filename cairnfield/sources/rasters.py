"""A Python data source that writes layers of cells as georeferenced TIFF files, one file a square tile.

    write_rasters(cells, "file:///data/trend", ["slp", "ict"], Georeference(500000.0, 7000000.0, 30.0, epsg=32608))

Each task encodes the tiles that it holds, one at a time, into a staging folder beside the target. The commit moves the files of
the attempts that succeeded to their places; an abort deletes the staging folder, so that a failed write leaves no file. The folder
lies in any store that pyarrow's file systems write to, and that the driver and all executors share.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from cairnfield.sources import tiff

TILE_STEP = 250
#: Cells of a side of the blocks within a file.
BLOCK = 64
#: Photometric interpretation "black is 0", and the key of the raster type with "area".
PHOTOMETRIC, RASTER_TYPE, AREA = 262, 1025, 1
MODEL_TYPE, IS_PROJECTED, IS_GEOGRAPHIC = 1024, 1, 2
CODES = {"H": 3, "I": 4, "d": 12, "s": 2, "Q": 16}


@dataclass(frozen=True)
class Georeference:
    """The outer corner of cell (0, 0) of the whole raster, the sides of a cell, and the coordinate system if it is known."""

    x: float = 0.0
    y: float = 0.0
    size: float = 1.0
    epsg: int | None = None

    def moved(self, row: int, col: int) -> Georeference:
        return Georeference(self.x + col * self.size, self.y - row * self.size, self.size, self.epsg)


def encoded(values: np.ndarray, place: Georeference, nodata: float | None = None, side: int = BLOCK, big: bool = False) -> bytes:
    """A file of values (band, row, col): deflated tiles, bands side by side, 64-bit offsets if big."""
    bands, rows, cols = values.shape
    kind = values.dtype.newbyteorder("<")
    down, across = -(-rows // side), -(-cols // side)
    padded = np.zeros((down * side, across * side, bands), kind)
    padded[:rows, :cols] = values.transpose(1, 2, 0)
    packed = [zlib.compress(padded[r * side : (r + 1) * side, c * side : (c + 1) * side].tobytes()) for r in range(down) for c in range(across)]
    sizes = [len(b) for b in packed]
    geographic = place.epsg is not None and 4000 <= place.epsg < 5000
    keys = [(MODEL_TYPE, IS_GEOGRAPHIC if geographic else IS_PROJECTED), (RASTER_TYPE, AREA)]
    if place.epsg is not None:
        keys.append((tiff.GEOGRAPHIC if geographic else tiff.PROJECTED, place.epsg))
    form = {"u": 1, "i": 2, "f": 3}[kind.kind]
    offset = "Q" if big else "I"
    fields = {
        tiff.WIDTH: ("I", [cols]), tiff.LENGTH: ("I", [rows]), tiff.BITS: ("H", [8 * kind.itemsize] * bands), tiff.COMPRESSION: ("H", [tiff.DEFLATE[0]]),
        PHOTOMETRIC: ("H", [1]), tiff.SAMPLES: ("H", [bands]), tiff.PLANAR: ("H", [1]), tiff.TILE_WIDTH: ("I", [side]), tiff.TILE_LENGTH: ("I", [side]),
        tiff.TILES: (offset, [0] * len(sizes)), tiff.TILE_BYTES: (offset, sizes), tiff.FORMAT: ("H", [form] * bands),
        tiff.CELL_SIZE: ("d", [place.size, place.size, 0.0]), tiff.TIE_POINT: ("d", [0.0, 0.0, 0.0, place.x, place.y, 0.0]),
        tiff.GEO_KEYS: ("H", [1, 1, 0, len(keys), *(v for key, value in keys for v in (key, 0, 1, value))]),
    }
    if nodata is not None:
        fields[tiff.NODATA] = ("s", (repr(float(nodata)) + "\0").encode())
    head, count, inline = (16, "Q", 8) if big else (8, "H", 4)
    start = head + struct.calcsize(f"={count}") + len(fields) * (4 + 2 * inline) + inline
    raw = {t: (v if c == "s" else struct.pack(f"<{len(v)}{c}", *v)) for t, (c, v) in fields.items()}
    outside, at = {}, start
    for t in sorted(raw):
        if len(raw[t]) > inline:
            outside[t] = at
            at += len(raw[t]) + len(raw[t]) % 2
    offsets = (at + np.cumsum(sizes) - sizes).tolist()
    raw[tiff.TILES] = struct.pack(f"<{len(sizes)}{offset}", *offsets)
    entries = b"".join(
        struct.pack(f"<HH{offset}", t, CODES[c], len(v)) + (struct.pack(f"<{offset}", outside[t]) if t in outside else raw[t].ljust(inline, b"\0")) for t, (c, v) in sorted(fields.items())
    )
    first = struct.pack("<2sHHHQ", b"II", 43, 8, 0, head) if big else struct.pack("<2sHI", b"II", 42, head)
    rest = b"".join(raw[t] + b"\0" * (len(raw[t]) % 2) for t in sorted(outside))
    return first + struct.pack(f"<{count}", len(fields)) + entries + struct.pack(f"<{offset}", 0) + rest + b"".join(packed)


@dataclass
class Written(WriterCommitMessage):
    """The files of one task: where they lie in the staging folder."""

    files: list[str]


class RasterWriter(DataSourceArrowWriter):
    """Rows (tile_row, tile_col, row, col, a column a band); those of one tile lie together in one task."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.place = Georeference(**json.loads(options.get("place", "{}")))
        self.step, self.kind = int(options.get("step", TILE_STEP)), options.get("kind", "float32")
        self.nodata = float(options["nodata"]) if "nodata" in options else None
        self.staging = f"{self.path}/_staging-{uuid.uuid4().hex}"

    def system(self) -> tuple:
        """(file system, the target's path there, the staging folder's)."""
        from pyarrow import fs

        if "://" not in self.path and not self.path.startswith("file:"):
            return fs.LocalFileSystem(), self.path, self.staging
        system, place = fs.FileSystem.from_uri(tiff.uri(self.path))
        return system, place, place + self.staging[len(self.path) :]

    def write(self, iterator: Iterator) -> Written:
        system, _, staging = self.system()
        folder, key, held, files = f"{staging}/{uuid.uuid4().hex}", None, [], []

        def flush() -> None:
            if not held:
                return
            tile_row, tile_col = key
            row, col = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            bands = [np.concatenate([h[k] for h in held]) for k in range(2, len(held[0]))]
            top, left = tile_row * self.step, tile_col * self.step
            grid = np.full((len(bands), int(row.max()) - top + 1, int(col.max()) - left + 1), 0 if self.nodata is None else self.nodata, self.kind)
            for k, b in enumerate(bands):
                known = ~np.isnan(b)
                grid[k, row[known] - top, col[known] - left] = b[known]
            if not files:
                system.create_dir(folder, recursive=True)
            files.append(f"{folder}/tile_{tile_row}_{tile_col}.tif")
            with system.open_output_stream(files[-1]) as out:
                out.write(encoded(grid, self.place.moved(top, left), self.nodata))
            held.clear()

        for batch in iterator:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            tiles = np.stack(columns[:2], 1)
            cuts = [0, *(np.flatnonzero((tiles[1:] != tiles[:-1]).any(1)) + 1).tolist(), len(tiles)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a < b:
                    if tuple(tiles[a].tolist()) != key:
                        flush()
                        key = tuple(tiles[a].tolist())
                    held.append([columns[2][a:b].astype(np.int64), columns[3][a:b].astype(np.int64), *(c[a:b].astype(float) for c in columns[4:])])
        flush()
        return Written(files)

    def commit(self, messages: list) -> None:
        system, path, staging = self.system()
        from pyarrow import fs

        files = [f for m in messages if m for f in m.files]
        names = [f.rsplit("/", 1)[1] for f in files]
        if len(set(names)) < len(names):
            self.abort(messages)
            raise ValueError("rows of one tile lie in more than one task: deal them by tile_row and tile_col, sorted")
        system.create_dir(path, recursive=True)
        if self.overwrite:
            for old in system.get_file_info(fs.FileSelector(path)):
                if old.type == fs.FileType.File and old.base_name.startswith("tile_") and old.extension == "tif":
                    system.delete_file(old.path)
        for f, name in zip(files, names, strict=True):
            system.move(f, f"{path}/{name}")
        self._clear(system, staging)

    def abort(self, messages: list) -> None:
        system, _, staging = self.system()
        self._clear(system, staging)

    @staticmethod
    def _clear(system, folder: str) -> None:  # noqa: ANN001
        from pyarrow import fs

        if system.get_file_info(folder).type != fs.FileType.NotFound:
            system.delete_dir(folder)


class RasterSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "raster"

    def schema(self) -> str:
        return "tile_row long, tile_col long, row long, col long, value double"

    def writer(self, schema, overwrite: bool) -> RasterWriter:  # noqa: ANN001
        return RasterWriter(self.options, overwrite)


def write_rasters(cells: DataFrame, path: str, bands: list[str], place: Georeference, kind: str = "float32", nodata: float | None = None, step: int = TILE_STEP, mode: str = "append") -> None:
    """Writes columns of cells (row, col, ..) as the bands of one file a tile, <path>/tile_<row>_<col>.tif, null as nodata (0 if none).

    kind is the files' type as NumPy names it. A tile's file ends at the last row and col that it holds. append adds tiles and
    replaces those of the same place, overwrite replaces all.
    """
    cells.sparkSession.dataSource.register(RasterSink)
    tiled = cells.select(F.expr(f"row div {step}").alias("tile_row"), F.expr(f"col div {step}").alias("tile_col"), F.col("row").cast("long"), F.col("col").cast("long"), *[F.col(b).cast("double") for b in bands])
    writer = tiled.repartition("tile_row", "tile_col").sortWithinPartitions("tile_row", "tile_col").write.format("raster").mode(mode)
    writer = writer.option("path", path).option("place", json.dumps(asdict(place))).option("step", step).option("kind", kind)
    (writer if nodata is None else writer.option("nodata", repr(float(nodata)))).save()
