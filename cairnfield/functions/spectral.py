"""Band arithmetic on observations: b is ARRAY<DOUBLE> of blue, green, red, near, short-wave 1 and short-wave 2."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tasseled-cap coefficients after Crist (1985), Huang et al. (2002) and Baig et al. (2014).
TASSELED_CAP = {
    "TM": {
        "brightness": (0.2043, 0.4158, 0.5524, 0.5741, 0.3124, 0.2303),
        "greenness": (-0.1603, -0.2819, -0.4934, 0.7940, -0.0002, -0.1446),
        "wetness": (0.0315, 0.2021, 0.3102, 0.1594, -0.6806, -0.6109),
    },
    "ETM": {
        "brightness": (0.3561, 0.3972, 0.3904, 0.6966, 0.2286, 0.1596),
        "greenness": (-0.3344, -0.3544, -0.4556, 0.6966, -0.0242, -0.2630),
        "wetness": (0.2626, 0.2141, 0.0926, 0.0656, -0.7629, -0.5388),
    },
    "OLI": {
        "brightness": (0.3029, 0.2786, 0.4733, 0.5599, 0.508, 0.1872),
        "greenness": (-0.2941, -0.243, -0.5424, 0.7276, 0.0713, -0.1608),
        "wetness": (0.1511, 0.1973, 0.3283, 0.3407, -0.7117, -0.4559),
    },
}
SENSOR_ALIAS = {"OLI_TIRS": "OLI"}
#: Band pairs (0-based) of the normalised differences.
NORMALISED = {"ndvi": (3, 2), "ndwi": (1, 3), "ndmi": (3, 4), "ndbr": (3, 5)}
#: Mean solar irradiance by sensor and band.
ESUN = {
    "TM": {1: 1983.0, 2: 1796.0, 3: 1536.0, 4: 1031.0, 5: 220.0, 7: 83.49},
    "ETM": {1: 1997.0, 2: 1812.0, 3: 1533.0, 4: 1039.0, 5: 230.8, 7: 84.90, 8: 1362.0},
}


def masked(value: Column, nodata: float = 0.0) -> Column:
    """The value, or null where it is the nodata value."""
    return F.nullif(value, F.lit(nodata))


def scaled(bands: Column, factor: float = 10000.0) -> Column:
    """Stored integers as reflectance; 0 is nodata and becomes null."""
    return F.transform(bands, lambda x: masked(x) / factor)


def any_band_missing(bands: Column) -> Column:
    return F.exists(bands, lambda x: x.isNull() | (x == 0))


def six_bands(bands: Column) -> Column:
    """Scenes of seven bands lose their first."""
    return F.when(F.size(bands) == 7, F.slice(bands, 2, 6)).otherwise(bands)


def _dot(bands: Column, factors: tuple[float, ...]) -> Column:
    total = F.lit(0.0)
    for k, f in enumerate(factors):
        total = total + F.lit(f) * bands[k]
    return total


def tasseled_cap(bands: Column, component: str, sensor: Column | str) -> Column:
    """brightness, greenness or wetness; a fixed sensor as text, or a column for each scene's own; unknown ones give null."""
    sensor = F.lit(sensor) if isinstance(sensor, str) else sensor
    out = F.lit(None).cast("double")
    for name, parts in TASSELED_CAP.items():
        names = [name, *(a for a, n in SENSOR_ALIAS.items() if n == name)]
        out = F.when(sensor.isin(names), _dot(bands, parts[component])).otherwise(out)
    return F.when(bands[0].isNotNull(), out)


def normalised_difference(bands: Column, index: str | tuple[int, int], zero_is_nodata: bool = True) -> Column:
    """(a - b) / (a + b), null where the bands add up to 0 and, unless told otherwise, where the result is 0."""
    i, k = NORMALISED[index] if isinstance(index, str) else index
    value = F.try_divide(bands[i] - bands[k], bands[i] + bands[k])
    return F.nullif(value, F.lit(0.0)) if zero_is_nodata else value


def burned_area(bands: Column, near: int = 3, red: int = 2, squared: bool = False) -> Column:
    """1 / ((0.1 - red)^2 + (0.06 - near)); squared=True squares the second term too, as the published index does."""
    second = F.lit(0.06) - bands[near]
    first = F.lit(0.1) - bands[red]
    return F.try_divide(F.lit(1.0), first * first + (second * second if squared else second))


def dn_to_radiance(dn: Column, low: Column, high: Column, q_low: Column, q_high: Column) -> Column:
    """Linear rescale of digital numbers; 0 stays 0."""
    return F.when(dn != 0, (high - low) / (q_high - q_low) * (dn - q_low) + low).otherwise(0.0)


def gain_to_radiance(dn: Column, gain: float, offset: float) -> Column:
    return F.when(dn != 0, F.lit(gain) * dn + F.lit(offset)).otherwise(0.0)


def gain_to_reflectance(dn: Column, elevation: Column, gain: float = 2e-5, offset: float = -0.1) -> Column:
    """Reflectance at the top of the atmosphere, corrected for the sun's elevation in degrees."""
    return F.when(dn != 0, (F.lit(gain) * dn + F.lit(offset)) / F.sin(F.radians(elevation))).otherwise(0.0)


def radiance_to_reflectance(radiance: Column, elevation: Column, esun: Column | float, distance: Column | float = 1.0) -> Column:
    esun, distance = (x if isinstance(x, Column) else F.lit(x) for x in (esun, distance))
    value = F.lit(3.141592653589793) * radiance * distance * distance / (esun * F.sin(F.radians(elevation)))
    return F.when(radiance != 0, value).otherwise(0.0)


def qa_bit(qa: Column, bit: int) -> Column:
    """Bit 0..7 of the low byte, the least significant first."""
    return F.shiftright(qa.bitwiseAND(F.lit(255)), bit).bitwiseAND(F.lit(1))


def qa_valid(qa: Column) -> Column:
    return qa.bitwiseAND(F.lit(6)) != 0


def cfmask_valid(mask: Column) -> Column:
    return mask.isin(0, 1)


def to_byte_range(value: Column, low: float = -0.12, high: float = 0.12) -> Column:
    """Linear scale of low..high to 1..255, clamped to a byte."""
    return F.least(F.greatest(F.rint((value - low) / (high - low) * 254 + 1), F.lit(0.0)), F.lit(255.0)).cast("int")


def masked_byte(value: Column, mask: Column) -> Column:
    """0 becomes 1 within the mask; everything outside is 0."""
    return F.when(mask > 0, F.greatest(value, F.lit(1))).otherwise(F.lit(0))


def aligned(value: Column, size: int = 30) -> Column:
    """The coordinate moved to the pixel grid; the remainder has the divisor's sign."""
    return value - (F.pmod(value, F.lit(size)) - size // 2)
