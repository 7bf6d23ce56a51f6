"""Transverse Mercator on the WGS84 ellipsoid, forward and inverse, as column expressions.

The series in the third flattening (Krueger) to the fourth order: errors stay below a tenth of a millimetre within a
zone and its neighbours.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Semi-major axis and flattening of WGS84, scale on the central meridian, false easting and northing.
AXIS, FLATTENING, SCALE, EASTING, NORTHING = 6_378_137.0, 1 / 298.257223563, 0.9996, 500_000.0, 10_000_000.0
N = FLATTENING / (2 - FLATTENING)
ECCENTRICITY = math.sqrt(FLATTENING * (2 - FLATTENING))
RADIUS = AXIS / (1 + N) * (1 + N**2 / 4 + N**4 / 64)
FORWARD = (N / 2 - 2 * N**2 / 3 + 5 * N**3 / 16 + 41 * N**4 / 180, 13 * N**2 / 48 - 3 * N**3 / 5 + 557 * N**4 / 1440, 61 * N**3 / 240 - 103 * N**4 / 140, 49561 * N**4 / 161280)
INVERSE = (N / 2 - 2 * N**2 / 3 + 37 * N**3 / 96 - N**4 / 360, N**2 / 48 + N**3 / 15 - 437 * N**4 / 1440, 17 * N**3 / 480 - 37 * N**4 / 840, 4397 * N**4 / 161280)
LATITUDE = (2 * N - 2 * N**2 / 3 - 2 * N**3 + 116 * N**4 / 45, 7 * N**2 / 3 - 8 * N**3 / 5 - 227 * N**4 / 45, 56 * N**3 / 15 - 136 * N**4 / 35, 4279 * N**4 / 630)


def zone_of(lon: Column) -> Column:
    """The UTM zone of a longitude, without the exceptions around Norway and Svalbard."""
    return F.pmod(F.floor((lon + 180) / 6), F.lit(60)).cast("int") + 1


def meridian(zone: int) -> float:
    return zone * 6.0 - 183.0


def projected(lon: Column, lat: Column, zone: int, south: bool = False) -> tuple[Column, Column]:
    """Easting and northing in metres of degrees."""
    across, sine = F.radians(lon - meridian(zone)), F.sin(F.radians(lat))
    t = F.sinh(F.atanh(sine) - ECCENTRICITY * F.atanh(ECCENTRICITY * sine))
    xi, eta = F.atan2(t, F.cos(across)), F.atanh(F.sin(across) / F.sqrt(1 + t * t))
    north, east = xi, eta
    for j, a in enumerate(FORWARD, 1):
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    return EASTING + SCALE * RADIUS * east, (NORTHING if south else 0.0) + SCALE * RADIUS * north


def geographic(easting: Column, northing: Column, zone: int, south: bool = False) -> tuple[Column, Column]:
    """Longitude and latitude in degrees of metres."""
    xi0, eta0 = (northing - (NORTHING if south else 0.0)) / (SCALE * RADIUS), (easting - EASTING) / (SCALE * RADIUS)
    xi, eta = xi0, eta0
    for j, b in enumerate(INVERSE, 1):
        xi = xi - b * F.sin(2 * j * xi0) * F.cosh(2 * j * eta0)
        eta = eta - b * F.cos(2 * j * xi0) * F.sinh(2 * j * eta0)
    conformal = F.asin(F.sin(xi) / F.cosh(eta))
    lat = conformal
    for j, d in enumerate(LATITUDE, 1):
        lat = lat + d * F.sin(2 * j * conformal)
    return meridian(zone) + F.degrees(F.atan2(F.sinh(eta), F.cos(xi))), F.degrees(lat)
