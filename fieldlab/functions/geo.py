"""Coordinates: parsing, hemisphere signs, distance and UTM, all as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldlab.functions.numbers import as_column, to_number
from fieldlab.functions.text import digit_count

# Equatorial radius (m) used by the distance formula, and the WGS84 flattening.
RADIUS = 6378137.0
FLATTENING = 1 / 298.257223563

# Lake reference point, degrees.
LAKE_LAT, LAKE_LON = 49.067898710337715, -121.97819734971488

# UTM constants: scale on the central meridian, false easting, central meridian of zone 10.
_SCALE, _EAST0, _ZONE10 = 0.9996, 500000.0, -123.0
_N = FLATTENING / (2 - FLATTENING)
_ARC = RADIUS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
# Krueger series coefficients to fourth order in the third flattening.
_ALPHA = [
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
]
_BETA = [
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
]
_DELTA = [
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35,
    4279 * _N**4 / 630,
]
_ECC = 2 * _N**0.5 / (1 + _N)


def ddm_to_degrees(c: Column | str) -> Column:
    """``49 04.123 N`` style degrees and decimal minutes to signed degrees."""
    text = as_column(c)
    degrees = to_number(F.regexp_extract(text, r"^([0-9]+)", 1))
    minutes = to_number(F.regexp_extract(text, r"([0-9]+\.[0-9]+)", 1))
    side = F.regexp_extract(text, r"([NSEW])", 1)
    value = degrees + minutes / 60
    return F.when(side.isin("S", "W"), -value).otherwise(value)


def west_negative(c: Column | str) -> Column:
    return -F.abs(as_column(c))


def haversine_km(
    lat: Column | str, lon: Column | str, to_lat: float = LAKE_LAT, to_lon: float = LAKE_LON
) -> Column:
    """Great-circle distance to a fixed point in km."""
    phi, lam = F.radians(as_column(lat)), F.radians(as_column(lon))
    phi0, lam0 = F.radians(F.lit(to_lat)), F.radians(F.lit(to_lon))
    half = F.pow(F.sin((phi - phi0) / 2), 2) + F.cos(phi) * F.cos(phi0) * F.pow(
        F.sin((lam - lam0) / 2), 2
    )
    return F.asin(F.least(F.lit(1.0), F.sqrt(half))) * (2 * RADIUS / 1000)


def coordinate_kind(lat_text: Column | str) -> Column:
    """``degrees`` for decimal degrees, ``utm`` for metres, ``blank`` when missing."""
    text = as_column(lat_text)
    return (
        F.when(text.isNull() | (F.trim(text) == ""), "blank")
        .when(text.rlike(r"[0-9]{2}\."), "degrees")
        .otherwise("utm")
    )


def ordered_utm(first: Column | str, second: Column | str) -> tuple[Column, Column]:
    """(easting, northing): a northing has seven digits, an easting six, whichever came first."""
    a, b = as_column(first), as_column(second)
    northing = F.when(digit_count(a) == 7, a).otherwise(b)
    easting = F.when(digit_count(b) == 6, b).otherwise(a)
    return to_number(easting), to_number(northing)


def split_pair(c: Column | str) -> tuple[Column, Column]:
    """(lat, lon) magnitudes from ``49.05N 121.98W``."""
    parts = F.split(as_column(c), r"\s+")
    strip = lambda x: to_number(F.regexp_replace(x, "[NSEWnsew]", ""))
    return strip(F.get(parts, F.lit(0))), strip(F.get(parts, F.lit(1)))


def lonlat_to_utm(lon: Column | str, lat: Column | str, meridian: float = _ZONE10):
    """(easting, northing) in metres of a northern UTM zone, by default zone 10."""
    sin_phi = F.sin(F.radians(as_column(lat)))
    lam = F.radians(as_column(lon) - meridian)
    t = F.sinh(F.atanh(sin_phi) - _ECC * F.atanh(_ECC * sin_phi))
    xi = F.atan2(t, F.cos(lam))
    eta = F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, a in enumerate(_ALPHA, start=1):
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return _EAST0 + _SCALE * _ARC * east, _SCALE * _ARC * north


def utm_to_lonlat(easting: Column | str, northing: Column | str, meridian: float = _ZONE10):
    """(lon, lat) in degrees from a northern UTM zone, by default zone 10."""
    xi = as_column(northing) / (_SCALE * _ARC)
    eta = (as_column(easting) - _EAST0) / (_SCALE * _ARC)
    xi1, eta1 = xi, eta
    for j, b in enumerate(_BETA, start=1):
        xi1 = xi1 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta1 = eta1 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi1) / F.cosh(eta1))
    phi = chi
    for j, d in enumerate(_DELTA, start=1):
        phi = phi + d * F.sin(2 * j * chi)
    lam = F.atan2(F.sinh(eta1), F.cos(xi1))
    return meridian + F.degrees(lam), F.degrees(phi)


def padded_box(x: str, y: str, metres: float = 1000.0) -> list[Column]:
    """Aggregates for a bounding box in projected metres, widened on every side."""
    return [
        (F.min(x) - metres).alias("xmin"),
        (F.min(y) - metres).alias("ymin"),
        (F.max(x) + metres).alias("xmax"),
        (F.max(y) + metres).alias("ymax"),
    ]
