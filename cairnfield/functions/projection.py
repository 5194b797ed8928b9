"""Universal transverse Mercator coordinates by Krueger's series to the third order: as column expressions, or with ops=numpy over arrays."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The WGS84 ellipsoid and the projection's scale and false origin.
AXIS, FLATTENING = 6378137.0, 1 / 298.257223563
SCALE, EAST, NORTH_OF_SOUTH = 0.9996, 500000.0, 10000000.0

N = FLATTENING / (2 - FLATTENING)
RADIUS = SCALE * AXIS / (1 + N) * (1 + N**2 / 4 + N**4 / 64)
ALPHA = (N / 2 - 2 * N**2 / 3 + 5 * N**3 / 16, 13 * N**2 / 48 - 3 * N**3 / 5, 61 * N**3 / 240)
BETA = (N / 2 - 2 * N**2 / 3 + 37 * N**3 / 96, N**2 / 48 + N**3 / 15, 17 * N**3 / 480)
DELTA = (2 * N - 2 * N**2 / 3 - 2 * N**3, 7 * N**2 / 3 - 8 * N**3 / 5, 56 * N**3 / 15)
ROOT = 2 * math.sqrt(N) / (1 + N)


def central_meridian(zone: int) -> float:
    return zone * 6.0 - 183.0


def to_utm(lon: Column, lat: Column, zone: int, south: bool = False, ops=F) -> tuple[Column, Column]:
    """(easting, northing) in metres of degrees."""
    sine, turn = ops.sin(ops.radians(lat)), ops.radians(lon - central_meridian(zone))
    t = ops.sinh(ops.atanh(sine) - ROOT * ops.atanh(ROOT * sine))
    xi, eta = ops.atan2(t, ops.cos(turn)), ops.atanh(ops.sin(turn) / ops.sqrt(1 + t * t))
    east, north = eta, xi
    for j, a in enumerate(ALPHA, 1):
        east = east + a * ops.cos(2 * j * xi) * ops.sinh(2 * j * eta)
        north = north + a * ops.sin(2 * j * xi) * ops.cosh(2 * j * eta)
    return EAST + RADIUS * east, (NORTH_OF_SOUTH if south else 0.0) + RADIUS * north


def from_utm(easting: Column, northing: Column, zone: int, south: bool = False, ops=F) -> tuple[Column, Column]:
    """(lon, lat) in degrees of metres."""
    xi, eta = (northing - (NORTH_OF_SOUTH if south else 0.0)) / RADIUS, (easting - EAST) / RADIUS
    north, east = xi, eta
    for j, b in enumerate(BETA, 1):
        north = north - b * ops.sin(2 * j * xi) * ops.cosh(2 * j * eta)
        east = east - b * ops.cos(2 * j * xi) * ops.sinh(2 * j * eta)
    chi = ops.asin(ops.sin(north) / ops.cosh(east))
    lat = chi
    for j, d in enumerate(DELTA, 1):
        lat = lat + d * ops.sin(2 * j * chi)
    return ops.degrees(ops.atan2(ops.sinh(east), ops.cos(north))) + central_meridian(zone), ops.degrees(lat)


def cell_centres(row: Column, col: Column, x0: float, y0: float, size: float) -> tuple[Column, Column]:
    """(x, y) of the middle of cells whose raster starts at the upper left corner (x0, y0)."""
    return x0 + (col + 0.5) * size, y0 - (row + 0.5) * size
