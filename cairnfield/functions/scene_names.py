"""Facts that file names carry: dates, sensors, tiles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Sensor by prefix of the scene id, for ids of 16 and of 22 characters.
SENSORS = {16: {"LT4": "TM", "LT5": "TM", "LE7": "ETM", "LC8": "OLI"}, 22: {"LT04": "TM", "LT05": "TM", "LE07": "ETM", "LC08": "OLI"}}
TOKENS = 5


def scene_id(basename: Column) -> Column:
    return F.split(basename, "_")[0]


def naming_version(basename: Column) -> Column:
    """'v1', 'v2', or null for names that are neither."""
    size = F.length(scene_id(basename))
    fits = F.size(F.split(basename, "_")) == TOKENS
    return F.when(fits & (size == 16), "v1").when(fits & (size == 22), "v2")


def scene_date(basename: Column) -> Column:
    """Year and day of the year in v1 names, year, month and day in v2 names; null if there is no such date."""
    s = scene_id(basename)
    first = F.try_to_date(F.substring(s, 10, 7), "yyyyDDD")
    second = F.try_to_date(F.substring(s, 11, 8), "yyyyMMdd")
    version = naming_version(basename)
    return F.when(version == "v1", first).when(version == "v2", second)


def sensor_of(basename: Column) -> Column:
    s = scene_id(basename)
    out = F.lit(None).cast("string")
    for size, known in SENSORS.items():
        for prefix, sensor in known.items():
            out = F.when((F.length(s) == size) & s.startswith(prefix), sensor).otherwise(out)
    return out


def path_row(basename: Column) -> tuple[Column, Column]:
    """Path and row (two digits) as integers, for either naming version."""
    s = scene_id(basename)
    old = F.length(s) == 16
    path = F.when(old, F.substring(s, 4, 3)).otherwise(F.substring(s, 5, 3))
    row = F.when(old, F.substring(s, 8, 2)).otherwise(F.substring(s, 9, 2))
    return path.try_cast("int"), row.try_cast("int")


def ordinal_day(date: Column) -> Column:
    """Days since 0000-12-31, so that 0001-01-01 is 1."""
    return F.datediff(date, F.lit("1970-01-01").cast("date")) + 719163


def day_of_year_text(iso_date: Column) -> Column:
    """'2013-07-11' as '192', padded to three digits."""
    return F.date_format(F.to_date(iso_date), "DDD")


def without_last_token(basename: Column) -> Column:
    tokens = F.split(basename, "_")
    return F.array_join(F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0))), "_")


def tile_key(row: Column, path: Column) -> Column:
    return F.concat_ws("_", row.cast("string"), path.cast("string"))


def tile_key_parts(key: Column) -> tuple[Column, Column]:
    parts = F.split(key, "_")
    return parts[0].try_cast("int"), parts[1].try_cast("int")


def tile_parts(basename: Column) -> dict[str, Column]:
    """period, site, lat and lon of '<kind>_<period>_<site>_<lat>_<lon>.tif'; trailing and leading dashes go."""
    t = F.split(basename, "_")
    return {
        "period": t[1],
        "site": F.regexp_replace(t[2], "-+$", ""),
        "lat": F.regexp_replace(t[3], "^-+", ""),
        "lon": F.regexp_replace(t[4], r"\.tif$", ""),
    }


def is_input_tile(basename: Column) -> Column:
    return basename.endswith(".tif") & ~basename.contains("grid")


def class_period(period: Column) -> tuple[Column, Column, Column]:
    """'2000-2020' as start, end and number of years."""
    t = F.split(period, "-")
    start, end = t[0].try_cast("int"), t[1].try_cast("int")
    return start, end, end - start


def hours_since_1900(hours: Column) -> Column:
    return F.timestamp_seconds(hours.cast("long") * 3600 - 2208988800)


def point_wkt(x: Column, y: Column) -> Column:
    return F.format_string("POINT (%s %s)", x.cast("string"), y.cast("string"))


def box_wkt(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    a, b, c, d = (v.cast("string") for v in (xmin, ymin, xmax, ymax))
    return F.format_string("POLYGON ((%s %s, %s %s, %s %s, %s %s, %s %s))", a, b, c, b, c, d, a, d, a, b)


def ring_corners(geojson: Column) -> tuple[Column, ...]:
    """Corners 0 and 2 of a polygon's first ring: ulx, uly, lrx, lry."""
    ring = F.from_json(geojson, "coordinates array<array<array<double>>>")["coordinates"][0]
    return ring[0][0], ring[0][1], ring[2][0], ring[2][1]
