"""Column expressions on pixels and coordinates. All are null-safe and stay in generated code.

Density counts are whole numbers from 0 to 255; missing input is null, never NaN.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the product: clear above WARM kelvin, thickest cloud below COLD, display gamma.
WARM, COLD, GAMMA = 285.0, 200.0, 0.45
# Fixed values of the polar fill: degrees where it begins, width of its feather, overlap band of the match.
POLAR, FEATHER, OVERLAP = 60.0, 2.0, (55.0, 65.0)


def _byte(x: Column) -> Column:
    return F.floor(F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0)) * 255).cast("int")


def no_nan(x: Column) -> Column:
    """NaN becomes null; call it where data come in, because NaN sorts above every number."""
    return F.when(~F.isnan(x), x)


def density(bt: Column, phase: Column | None = None, warm: float = WARM, cold: float = COLD) -> Column:
    """Cloud density of a brightness temperature, truncated; 0 where it is missing, or where a given phase is missing or below 1 (clear)."""
    clear = bt.isNull() if phase is None else bt.isNull() | (F.coalesce(phase, F.lit(0)) < 1)
    return F.when(clear, 0).otherwise(_byte((warm - bt) / (warm - cold)))


def density_with_fill(bt: Column, fill: float, warm: float = WARM, cold: float = COLD) -> Column:
    """As ``density``, for sources that mark missing pixels by a value: anything up to ``fill`` + 1 is missing."""
    return F.when(bt.isNull() | (bt <= fill + 1), 0).otherwise(_byte((warm - bt) / (warm - cold)))


def prescaled(v: Column) -> Column:
    """Counts that are density already: clipped and truncated; missing is 0."""
    return F.coalesce(F.floor(F.least(F.greatest(v, F.lit(0)), F.lit(255))).cast("int"), F.lit(0))


def gamma(d: Column, exponent: float = GAMMA) -> Column:
    return F.when(d > 0, F.floor(255.0 * F.pow(d / 255.0, F.lit(exponent))).cast("int")).otherwise(0)


def threshold(d: Column, least: int) -> Column:
    return F.when(d < least, 0).otherwise(d)


def stretch(d: Column, low: Column, high: Column, n: Column) -> Column:
    """[low, high] onto [0, 255], truncated; as it is if there are fewer than two values or all are equal. The lowest value becomes 0."""
    return F.when((n > 1) & (high > low), _byte((d - low) / (high - low))).otherwise(d)


def latitude(r: Column, height: Column | int) -> Column:
    """Latitude of a row of a grid whose first and last rows lie on the poles."""
    return 90.0 - r * 180.0 / (height - 1)


def axis(i: Column, first: float, last: float, n: Column | int) -> Column:
    """Value i of n evenly spaced ones, both ends included."""
    return first + i * (last - first) / (n - 1)


def feather_weight(abs_lat: Column, begin: float = POLAR, width: float = FEATHER) -> Column:
    """Cosine ramp from 0 at ``begin`` to 1 at ``begin + width``."""
    return (1.0 - F.cos((abs_lat - begin) / width * math.pi)) / 2.0


def mercator_y(lat: Column, size: Column | int) -> Column:
    """Row (fractional) of a latitude on a square Web Mercator plane."""
    return (1.0 - F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2.0)) / math.pi) / 2.0 * size


def cell(lat: Column, lng: Column, degrees: float = 1.0) -> Column:
    return F.struct(F.floor(lat / degrees).alias("cell_lat"), F.floor(lng / degrees).alias("cell_lng"))


def coordinate(x: Column, digits: int = 4) -> Column:
    """Rounded half to even, as single-precision coordinates need."""
    return F.bround(x.cast("double"), digits)


# The faces in order, and for each of x, y and z its factors of 1, u and v.
FACES = {
    "px": ((1, 0, 0), (0, 0, -1), (0, -1, 0)),
    "nx": ((-1, 0, 0), (0, 0, -1), (0, 1, 0)),
    "py": ((0, 1, 0), (1, 0, 0), (0, 0, 1)),
    "ny": ((0, 1, 0), (-1, 0, 0), (0, 0, -1)),
    "pz": ((0, 1, 0), (0, 0, -1), (1, 0, 0)),
    "nz": ((0, -1, 0), (0, 0, -1), (-1, 0, 0)),
}


def face_direction(face: Column, u: Column, v: Column) -> Column:
    """Unit vector struct(x, y, z) of a cube face's coordinates; null for an unknown face."""
    length = F.sqrt(u * u + v * v + 1.0)
    # a table of six rows of nine factors: a choice between six sums would be written out for every use, in methods too long to be compiled
    table = F.create_map(*[x for name, parts in FACES.items() for x in (F.lit(name), F.array(*[F.lit(float(f)) for part in parts for f in part]))])
    of = F.try_element_at(table, face)
    return F.when(of.isNotNull(), F.struct(*[((F.get(of, F.lit(3 * i)) + F.get(of, F.lit(3 * i + 1)) * u + F.get(of, F.lit(3 * i + 2)) * v) / length).alias(k) for i, k in enumerate("xyz")]))


def source_pixel(d: Column, face: Column, width: Column | int, height: Column | int, offset: float = 0.0) -> Column:
    """struct(ix, iy): where a direction (z up) falls on an equirectangular grid; x wraps, y is clamped.

    The south pole pixel of the face ``nz`` has no longitude of its own and takes -180 degrees.
    """
    pole = (d["x"] == 0) & (d["y"] == 0) & (face == "nz")
    lon = F.when(pole, F.lit(-math.pi)).otherwise(F.atan2(d["y"], d["x"])) + math.radians(offset)
    lat = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), d["z"])))
    x = F.pmod((lon / (2 * math.pi) + 0.5) * width, width * 1.0 if isinstance(width, Column) else F.lit(float(width)))
    y = F.greatest(F.lit(0.0), F.least((F.lit(0.5) - lat / math.pi) * height, height - F.lit(1.0)))
    return F.struct(x.alias("ix"), y.alias("iy"))
