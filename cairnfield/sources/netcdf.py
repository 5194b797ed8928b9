"""Cubes of time, latitude and longitude in netCDF files of the classic formats (32 and 64-bit offsets).

Headers are read in tasks, the times of a file are dealt over tasks in slabs, and a task reads the bytes of its slab alone, by
pyarrow's file systems (local, hdfs, s3, gs). Files that cannot be read, or lack a variable, are left out.
"""

from __future__ import annotations

import datetime
import re
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from cairnfield.sources.tiff import ranges

#: Tags of the header's lists, and the types of values by their code.
DIMENSIONS, VARIABLES, ATTRIBUTES = 10, 11, 12
KINDS = {1: ">i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8"}
SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
SINCE = re.compile(r"\s*(second|minute|hour|day)s?\s+since\s+(\d+)-(\d+)-(\d+)(?:[ T]+(\d+):(\d+)(?::(\d+))?)?")
#: Cells of a slab, unless one time has more; bytes read first of a header.
SLAB_CELLS = 1_000_000
HEAD = 1 << 16
BROKEN = (ValueError, KeyError, IndexError, struct.error, OSError, OverflowError, UnicodeDecodeError)
SLABS = "path string, first long, last long"


@dataclass
class Variable:
    dimensions: list[str]
    shape: list[int]
    kind: np.dtype
    begin: int
    attributes: dict
    record: bool

    @property
    def each(self) -> int:
        """Bytes of one record, or of one place of the first dimension."""
        return int(np.prod(self.shape[1:], dtype=np.int64)) * self.kind.itemsize


@dataclass
class Header:
    variables: dict[str, Variable] = field(default_factory=dict)
    stride: int = 0

    def values(self, read: Callable[[int, int], bytes], name: str, first: int = 0, last: int | None = None) -> np.ndarray:
        """Places first to last of a variable's first dimension as doubles, unpacked, NaN where there is no value."""
        v = self.variables[name]
        last = v.shape[0] if last is None else last
        if v.record:
            raw = b"".join(read(v.begin + k * self.stride, v.each) for k in range(first, last))
        else:
            raw = read(v.begin + first * v.each, (last - first) * v.each)
        found = np.frombuffer(raw, v.kind).reshape(last - first, *v.shape[1:]).astype(float)
        for name in ("_FillValue", "missing_value"):
            if name in v.attributes:
                found[found == v.attributes[name]] = np.nan
        return found * v.attributes.get("scale_factor", 1.0) + v.attributes.get("add_offset", 0.0)


def parsed(raw: bytes) -> Header:
    """The header that a file starts with; struct.error where it goes on beyond raw."""
    at = 4
    if raw[:3] != b"CDF" or raw[3] not in (1, 2):
        raise ValueError("no classic netCDF file")

    def number(code: str = ">I") -> int:
        nonlocal at
        (n,) = struct.unpack_from(code, raw, at)
        at += struct.calcsize(code)
        return n

    def taken(size: int) -> bytes:
        nonlocal at
        if at + size > len(raw):
            raise struct.error("header is longer")
        at += -(-size // 4) * 4
        return raw[at - -(-size // 4) * 4 :][:size]

    def listed(tag: int) -> range:
        found, count = number(), number()
        if count and found != tag:
            raise ValueError("broken header")
        return range(count)

    def attributes() -> dict:
        out = {}
        for _ in listed(ATTRIBUTES):
            name, kind, count = taken(number()).decode(), np.dtype(KINDS[number()]), number()
            held = taken(count * kind.itemsize)
            out[name] = held.decode() if kind.kind == "S" else float(np.frombuffer(held, kind)[0]) if count else None
        return out

    records = number()
    dimensions = [(taken(number()).decode(), number()) for _ in listed(DIMENSIONS)]
    attributes()
    header = Header()
    for _ in listed(VARIABLES):
        name = taken(number()).decode()
        own = [dimensions[number()] for _ in range(number())]
        held, kind, _, begin = attributes(), np.dtype(KINDS[number()]), number(), number(">I" if raw[3] == 1 else ">Q")
        record = bool(own) and own[0][1] == 0
        header.variables[name] = Variable([d for d, _ in own], [n or records for _, n in own], kind, begin, held, record)
    moving = [v.each for v in header.variables.values() if v.record]
    # one record variable alone is not padded
    header.stride = moving[0] if len(moving) == 1 else sum(-(-n // 4) * 4 for n in moving)
    return header


def header(read: Callable[[int, int], bytes]) -> Header:
    size, raw = HEAD, read(0, HEAD)
    while True:
        try:
            return parsed(raw)
        except struct.error:
            if len(raw) < size:
                raise
            size *= 4
            raw = read(0, size)


def moments(values: np.ndarray, units: str) -> np.ndarray:
    """Times of numbers since a moment, in microseconds since 1970."""
    unit, *parts = SINCE.match(units).groups()
    start = datetime.datetime(*[int(p or 0) for p in parts])
    return np.round(values * SECONDS[unit] * 1e6).astype(np.int64) + (start - datetime.datetime(1970, 1, 1)) // datetime.timedelta(microseconds=1)


def cube(spark: SparkSession, path: str | list[str], names: list[str], time: str = "time", lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """(path, i, time, row, col, lat, lon, a column a name) of the cells of variables over (time, lat, lon), i being the time's number.

    Coordinates are the variables of the dimensions' names; a cell where all names have no value has no row.
    """

    def form(read: Callable) -> Header:
        found = header(read)
        for n in names:
            if found.variables[n].dimensions != [time, lat, lon]:
                raise ValueError(f"{n} is no variable over time, latitude and longitude")
        return found

    def slabs(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for p in batch.column(0).to_pylist():
                try:
                    shape = form(ranges(p)).variables[names[0]].shape
                except BROKEN:
                    continue
                step = max(1, SLAB_CELLS // max(1, shape[1] * shape[2]))
                first = np.arange(0, shape[0], step)
                yield pa.record_batch([pa.array([p] * len(first), pa.string()), pa.array(first), pa.array(np.minimum(first + step, shape[0]))], names=["path", "first", "last"])

    def cells(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for r in batch.to_pylist():
                try:
                    read = ranges(r["path"])
                    h = form(read)
                    at = moments(h.values(read, time, r["first"], r["last"]), h.variables[time].attributes["units"])
                    y, x = h.values(read, lat), h.values(read, lon)
                    held = [h.values(read, n, r["first"], r["last"]) for n in names]
                except (*BROKEN, AttributeError):
                    continue
                i, row, col = np.nonzero(~np.all([np.isnan(v) for v in held], axis=0))
                columns = [pa.array([r["path"]] * len(i), pa.string()), pa.array(i + r["first"]), pa.array(at[i], pa.timestamp("us")), pa.array(row), pa.array(col), pa.array(y[row]), pa.array(x[col])]
                columns += [pa.array(v[i, row, col], from_pandas=True) for v in held]
                yield pa.record_batch(columns, names=["path", "i", "time", "row", "col", "lat", "lon", *names])

    found = spark.read.format("binaryFile").load(path).select("path").mapInArrow(slabs, SLABS)
    dealt = found.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), "path", "first")
    return dealt.mapInArrow(cells, "path string, i long, time timestamp_ntz, row long, col long, lat double, lon double, " + ", ".join(f"`{n}` double" for n in names))
