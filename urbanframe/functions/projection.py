"""Forward and inverse UTM on WGS84, and the planar helpers around them, as column expressions.

The series are those of Snyder, "Map Projections: A Working Manual" (USGS Professional Paper 1395). Each function takes
the module of its elementary functions, so that the same formula also gives SQL text (``urbanframe.plans.sqltext``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from urbanframe.functions.geometry import area, let, vertex_mean

#: WGS84 and UTM.
SEMI_MAJOR, FLATTENING = 6378137.0, 1 / 298.257223563
SCALE, FALSE_EASTING, FALSE_NORTHING = 0.9996, 500000.0, 10000000.0
#: Metres of a degree along a meridian or the equator, and the rounded value of distances measured in degrees.
DEGREE_M, DEGREE_M_ROUND = 111319.9, 111319.0
#: Kilometres of a degree for boxes around a centre.
DEGREE_KM = 111.32

E2 = FLATTENING * (2 - FLATTENING)
EP2 = E2 / (1 - E2)
#: Meridian arc: coefficients of phi and of the sines of its even multiples.
ARC = (
    1 - E2 / 4 - 3 * E2**2 / 64 - 5 * E2**3 / 256,
    -(3 * E2 / 8 + 3 * E2**2 / 32 + 45 * E2**3 / 1024),
    15 * E2**2 / 256 + 45 * E2**3 / 1024,
    -35 * E2**3 / 3072,
)
E1 = (1 - math.sqrt(1 - E2)) / (1 + math.sqrt(1 - E2))
#: Footpoint latitude: coefficients of the sines of the even multiples.
FOOT = (3 * E1 / 2 - 27 * E1**3 / 32, 21 * E1**2 / 16 - 55 * E1**4 / 32, 151 * E1**3 / 96, 1097 * E1**4 / 512)


def zone_number(lon, m=F):
    """1 to 60 by whole sixths of a degree, cut towards zero; 61 at 180 degrees, without the exceptions of the north."""
    return ((lon + 180) / 6).cast("int") + 1


def central_meridian(zone):
    return zone * 6 - 183.0


def to_utm(lon, lat, zone, m=F) -> tuple:
    """(easting, northing) of degrees in a given zone, a number or an expression; southern latitudes get the false northing."""
    meridian = math.radians(central_meridian(zone)) if isinstance(zone, int) else m.radians(central_meridian(zone))
    phi = m.radians(lat)
    sin, cos, tan = m.sin(phi), m.cos(phi), m.tan(phi)
    n = SEMI_MAJOR / m.sqrt(1 - E2 * sin * sin)
    t, c = tan * tan, EP2 * cos * cos
    a = (m.radians(lon) - meridian) * cos
    a2 = a * a
    arc = SEMI_MAJOR * (ARC[0] * phi + ARC[1] * m.sin(2 * phi) + ARC[2] * m.sin(4 * phi) + ARC[3] * m.sin(6 * phi))
    east = SCALE * n * a * (1 + a2 * ((1 - t + c) / 6 + a2 * (5 - 18 * t + t * t + 72 * c - 58 * EP2) / 120)) + FALSE_EASTING
    up = a2 * (0.5 + a2 * ((5 - t + 9 * c + 4 * c * c) / 24 + a2 * (61 - 58 * t + t * t + 600 * c - 330 * EP2) / 720))
    north = SCALE * (arc + n * tan * up)
    return east, m.when(lat < 0, north + FALSE_NORTHING).otherwise(north)


def from_utm(easting, northing, zone: int, northern: bool = True, m=F) -> tuple:
    """(lon, lat) in degrees of a zone's easting and northing."""
    mu = (northing if northern else northing - FALSE_NORTHING) / SCALE / (SEMI_MAJOR * ARC[0])
    phi = mu + FOOT[0] * m.sin(2 * mu) + FOOT[1] * m.sin(4 * mu) + FOOT[2] * m.sin(6 * mu) + FOOT[3] * m.sin(8 * mu)
    sin, cos, tan = m.sin(phi), m.cos(phi), m.tan(phi)
    w = 1 - E2 * sin * sin
    n, r = SEMI_MAJOR / m.sqrt(w), SEMI_MAJOR * (1 - E2) / (w * m.sqrt(w))
    t, c = tan * tan, EP2 * cos * cos
    d = (easting - FALSE_EASTING) / (n * SCALE)
    d2 = d * d
    drop = d2 * (0.5 - d2 * ((5 + 3 * t + 10 * c - 4 * c * c - 9 * EP2) / 24 - d2 * (61 + 90 * t + 298 * c + 45 * t * t - 252 * EP2 - 3 * c * c) / 720))
    turn = d * (1 - d2 * ((1 + 2 * t + c) / 6 - d2 * (5 - 2 * c + 28 * t - 3 * c * c + 8 * EP2 + 24 * t * t) / 120)) / cos
    return m.degrees(turn) + central_meridian(zone), m.degrees(phi - n * tan / r * drop)


def ring_square_m(ring: Column) -> Column:
    """Square metres of an open ring of struct<x,y> in degrees, in the UTM zone of its vertex mean; 0 for fewer than 3 points.

    Both sides of the equator are measured from it. Null rings, and rings with a null coordinate, give null.
    """

    def at(p: Column, zone: Column) -> Column:
        east, north = to_utm(p["x"], p["y"], zone)
        return F.struct(east.alias("x"), (north - F.when(p["y"] < 0, FALSE_NORTHING).otherwise(0.0)).alias("y"))

    in_zone = lambda r: let(zone_number(vertex_mean(r)["x"]), lambda z: area(F.transform(r, lambda p: at(p, z))))
    return let(ring, lambda r: F.when(F.size(r) < 3, 0.0).when(F.size(r) >= 3, in_zone(r)))


class Projector:
    """Local metres (x east, z north) around an origin, in the UTM zone of the origin; scenes have z to the south."""

    def __init__(self, lon: float, lat: float):
        self.lon, self.lat = lon, lat
        self.zone = int((lon + 180) / 6) + 1
        self.east, self.north = to_utm(lon, lat, self.zone, _Plain)

    def local(self, lon, lat, m=F) -> tuple:
        east, north = to_utm(lon, lat, self.zone, m)
        return east - self.east, north - self.north

    def scene(self, lon, lat, m=F) -> tuple:
        x, z = self.local(lon, lat, m)
        return x, -z


class _Plain:
    """The elementary functions on plain numbers."""

    sin, cos, tan, sqrt, radians, degrees = map(staticmethod, (math.sin, math.cos, math.tan, math.sqrt, math.radians, math.degrees))

    class _Case:
        def __init__(self, value):
            self.value = value

        def otherwise(self, other):
            return other if self.value is None else self.value

    @classmethod
    def when(cls, condition, value):
        return cls._Case(value if condition else None)


PLAIN = _Plain


def box_size(west, south, east, north, m=F) -> tuple:
    """(width, height) of a box in metres, at its middle latitude."""
    return (east - west) * DEGREE_M * m.cos(m.radians((south + north) / 2)), (north - south) * DEGREE_M


def box_around(lon, lat, radius_km, m=F) -> tuple:
    """west, south, east and north of a box that reaches radius_km from a centre."""
    up, side = radius_km / DEGREE_KM, radius_km / (DEGREE_KM * m.cos(m.radians(lat)))
    return lon - side, lat - up, lon + side, lat + up


def zoom_radius_km(zoom, m=F):
    """Kilometres around the centre of a map at a zoom level: 1 at 15, doubling outwards, from 1 to 10."""
    return m.greatest(m.lit(1.0), m.least(m.lit(10.0), m.pow(m.lit(2.0), 15 - zoom)))
