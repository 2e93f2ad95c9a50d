"""Spatial predicates and the inverse projection as column expressions.

A geometry is an array of polygons, a polygon an array of rings, a ring an array of [lon, lat] points;
a point is a polygon of one ring of one point. Inside is decided by the even-odd rule over all rings of
a polygon, so holes count as outside.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

RINGS = "array<array<array<array<double>>>>"


def parse_geojson(geojson: Column | str) -> Column:
    """Polygons of a Point, MultiPoint, Polygon or MultiPolygon; null for anything else or malformed text."""
    g = F.col(geojson) if isinstance(geojson, str) else geojson
    kind, at = F.get_json_object(g, "$.type"), F.get_json_object(g, "$.coordinates")
    point = F.from_json(at, "array<double>")
    points = F.from_json(at, "array<array<double>>")
    polygon = F.from_json(at, "array<array<array<double>>>")
    multi = F.from_json(at, RINGS)
    out = (
        F.when(kind == "Point", F.array(F.array(F.array(point))))
        .when(kind == "MultiPoint", F.transform(points, lambda p: F.array(F.array(p))))
        .when(kind == "Polygon", F.array(polygon))
        .when(kind == "MultiPolygon", multi)
    )
    good = F.forall(out, lambda p: F.coalesce(F.forall(p, lambda r: F.coalesce(F.forall(r, lambda c: F.coalesce((F.size(c) >= 2) & c[0].isNotNull() & c[1].isNotNull(), F.lit(False))), F.lit(False))), F.lit(False)))
    return F.when(F.coalesce(good & (F.size(F.flatten(F.flatten(out))) > 0), F.lit(False)), out)


def ring_fault(geometry: Column) -> Column:
    """The first fault of a geometry's rings as areas in degrees, null if it has none."""
    rings = F.flatten(geometry)
    short = F.exists(rings, lambda r: F.size(r) < 4)
    opened = F.exists(rings, lambda r: F.get(r, F.lit(0)) != F.get(r, F.size(r) - 1))
    outside = F.exists(F.flatten(rings), lambda p: ~(p[0].between(-180, 180) & p[1].between(-90, 90)))
    crossing = F.exists(rings, lambda r: F.exists(edges(r), lambda e: F.exists(edges(r), lambda f: _crossing(e, f))))
    return (
        F.when(geometry.isNull(), "missing_geometry").when(short, "invalid_ring").when(opened, "unclosed_ring")
        .when(outside, "coordinate_out_of_bounds").when(crossing, "self_intersecting_ring")
    )


def _crossing(e: Column, f: Column) -> Column:
    """Whether two segments cross within both of them."""
    a, b, c, d = e["a"], e["b"], f["a"], f["b"]
    return (_side(a, b, c) * _side(a, b, d) < 0) & (_side(c, d, a) * _side(c, d, b) < 0)


def edges(ring: Column) -> Column:
    """Pairs of neighbouring points, closed."""
    n = F.size(ring)
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(ring[i].alias("a"), ring[(i + 1) % n].alias("b")))


def _crosses(x: Column, y: Column, a: Column, b: Column) -> Column:
    """Whether the ray from (x, y) to the east meets the edge; half open, so a shared corner counts once."""
    above = (a[1] > y) != (b[1] > y)
    return above & (x < a[0] + (y - a[1]) * (b[0] - a[0]) / F.when(above, b[1] - a[1]).otherwise(F.lit(1.0)))


def in_rings(x: Column, y: Column, rings: Column) -> Column:
    """Even-odd, half open: of two areas that share an edge, one holds its points."""
    crossed = F.aggregate(rings, F.lit(0), lambda n, ring: n + F.size(F.filter(edges(ring), lambda e: _crosses(x, y, e["a"], e["b"]))))
    return crossed % 2 == 1


def _side(a: Column, b: Column, p: Column) -> Column:
    return F.signum((b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0]))


def _on(a: Column, b: Column, p: Column) -> Column:
    inside = (p[0] >= F.least(a[0], b[0])) & (p[0] <= F.greatest(a[0], b[0])) & (p[1] >= F.least(a[1], b[1])) & (p[1] <= F.greatest(a[1], b[1]))
    return (_side(a, b, p) == 0) & inside


def _meet(e: Column, f: Column) -> Column:
    """Whether two segments share a point, ends included; a segment of one point is a point."""
    a, b, c, d = e["a"], e["b"], f["a"], f["b"]
    return _crossing(e, f) | _on(a, b, c) | _on(a, b, d) | _on(c, d, a) | _on(c, d, b)


def _polygons_meet(p: Column, q: Column) -> Column:
    touching = F.exists(p, lambda r: F.exists(edges(r), lambda e: F.exists(q, lambda s: F.exists(edges(s), lambda f: _meet(e, f)))))
    return touching | in_rings(p[0][0][0], p[0][0][1], q) | in_rings(q[0][0][0], q[0][0][1], p)


def intersects(a: Column, b: Column) -> Column:
    """Whether two geometries share a point: borders touch or cross, or one holds a point of the other."""
    return F.exists(a, lambda p: F.exists(b, lambda q: _polygons_meet(p, q)))


class ConicIndia:
    """Lambert conformal conic with two parallels, EPSG:7755 on WGS 84, metres to degrees."""

    # Fixed values of the projection.
    A, FLATTENING = 6378137.0, 1 / 298.257223563
    LAT0, LON0, LAT1, LAT2 = 24.0, 80.0, 12.472955, 35.1728044444444
    EAST, NORTH = 4_000_000.0, 4_000_000.0

    def __init__(self) -> None:
        self.e = math.sqrt(self.FLATTENING * (2 - self.FLATTENING))
        phi0, phi1, phi2 = map(math.radians, (self.LAT0, self.LAT1, self.LAT2))

        def scale(phi: float) -> float:
            return math.cos(phi) / math.sqrt(1 - (self.e * math.sin(phi)) ** 2)

        def conformal(phi: float) -> float:
            s = self.e * math.sin(phi)
            return math.tan(math.pi / 4 - phi / 2) * ((1 + s) / (1 - s)) ** (self.e / 2)

        self.n = math.log(scale(phi1) / scale(phi2)) / math.log(conformal(phi1) / conformal(phi2))
        self.reach = self.A * scale(phi1) / (self.n * conformal(phi1) ** self.n)
        self.rho0 = self.reach * conformal(phi0) ** self.n

    def inverse(self, easting: Column, northing: Column) -> Column:
        """struct(lon, lat); null for non-finite input. Latitude by twelve fixed-point steps."""
        dx, dy = easting - self.EAST, self.rho0 - northing + self.NORTH
        t = F.pow(F.sqrt(dx * dx + dy * dy) / self.reach, F.lit(1 / self.n))

        def step(phi: Column, _: Column) -> Column:
            s = self.e * F.sin(phi)
            return F.lit(math.pi / 2) - 2 * F.atan(t * F.pow((1 - s) / (1 + s), F.lit(self.e / 2)))

        phi = F.aggregate(F.sequence(F.lit(1), F.lit(12)), F.lit(math.pi / 2) - 2 * F.atan(t), step)
        lon = F.lit(self.LON0) + F.degrees(F.atan2(dx, dy) / self.n)
        finite = ~F.isnan(easting) & ~F.isnan(northing) & (F.abs(easting) < float("inf")) & (F.abs(northing) < float("inf"))
        return F.when(finite, F.struct(lon.alias("lon"), F.degrees(phi).alias("lat")))

    def rings(self, geometry: Column) -> Column:
        """A geometry in degrees from one in metres."""

        def place(p: Column) -> Column:
            at = self.inverse(p[0], p[1])
            return F.array(at["lon"], at["lat"])

        return F.transform(geometry, lambda polygon: F.transform(polygon, lambda ring: F.transform(ring, place)))
