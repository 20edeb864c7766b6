"""Grids, areas and projections in closed form."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Kilometres of a degree; the sphere and factors of Wagner VII.
KM_PER_DEGREE = 111.32
W7_R, W7_KX, W7_KY, W7_SIN65 = 6378137.0, 2.66723, 1.24104, 0.9063077870366
EQUATOR_M = 9009964.76


def cell_area_deg(lat: Column, size: float) -> Column:
    """km2 of a square of `size` degrees at a latitude."""
    return F.lit((size * KM_PER_DEGREE) ** 2) * F.cos(F.radians(lat))


def lon_margin(lat: Column, km: float, floor: float = 0.02, most: float | None = 30.0) -> Column:
    out = F.lit(km) / (KM_PER_DEGREE * F.greatest(F.cos(F.radians(lat)), F.lit(floor)))
    return out if most is None else F.least(out, F.lit(most))


def lonlat_grid(w: Column, s: Column, e: Column, n: Column, res: float, lon_mult: Column, feather_km: float) -> Column:
    """struct(epsg, dx, dy, x0, y0, nx, ny, fl) of a lat/lon tile with its feather margin."""
    dx, dy = F.lit(res) * lon_mult, F.lit(res)
    pad_y = F.ceil(F.lit(feather_km) / KM_PER_DEGREE / dy)
    pad_x = F.when(e - w >= 360, F.lit(0)).otherwise(F.ceil(lon_margin((s + n) * 0.5, feather_km, 0.05, None) / dx))
    y0 = F.greatest(s - pad_y * dy, F.lit(-90.0))
    return F.struct(
        F.lit(4326).alias("epsg"), dx.alias("dx"), dy.alias("dy"), (w - pad_x * dx).alias("x0"), y0.alias("y0"),
        (F.bround((e - w) / dx) + 2 * pad_x).cast("long").alias("nx"), F.bround((F.least(n + pad_y * dy, F.lit(90.0)) - y0) / dy).cast("long").alias("ny"),
        F.bround(F.lit(feather_km / (res * KM_PER_DEGREE))).cast("long").alias("fl"),
    )


def projected_grid(epsg: Column, x_min: Column, y_min: Column, x_max: Column, y_max: Column, res_m: float, feather_km: float) -> Column:
    """The same of a projected square; origins snap down to the pixel lattice."""
    pad = math.ceil(feather_km * 1000.0 / res_m)
    return F.struct(
        epsg.alias("epsg"), F.lit(res_m).alias("dx"), F.lit(res_m).alias("dy"),
        (F.floor(x_min / res_m) * res_m - pad * res_m).alias("x0"), (F.floor(y_min / res_m) * res_m - pad * res_m).alias("y0"),
        (F.bround((x_max - x_min) / res_m) + 2 * pad).cast("long").alias("nx"), (F.bround((y_max - y_min) / res_m) + 2 * pad).cast("long").alias("ny"),
        F.lit(round(feather_km * 1000.0 / res_m)).cast("long").alias("fl"),
    )


def polar_grid(epsg: Column, half_m: Column, res_m: float, feather_km: float) -> Column:
    half = F.ceil(half_m / res_m) * res_m
    return projected_grid(epsg, -half, -half, half, half, res_m, feather_km)


def pixel_centre(origin: Column, step: Column) -> Column:
    """Headers name the first pixel's centre, grids its edge."""
    return origin + step / 2


def wagner7_forward(lon: Column, lat: Column) -> Column:
    lam, st = F.radians(lon), F.lit(W7_SIN65) * F.sin(F.radians(lat))
    ct = F.sqrt(1 - st * st)
    d = F.sqrt(2 / (1 + ct * F.cos(lam / 3)))
    return F.struct((F.lit(W7_R * W7_KX) * ct * F.sin(lam / 3) * d).alias("x"), (F.lit(W7_R * W7_KY) * st * d).alias("y"))


def wagner7_inverse(x: Column, y: Column, lon0: float = 0.0) -> Column:
    """Longitudes beyond the map's edge are clamped to it, never wrapped."""
    u, v = x / (W7_R * W7_KX), y / (W7_R * W7_KY)
    rho = F.sqrt(u * u + v * v)
    c = 2 * F.asin(F.least(rho / 2, F.lit(1.0)))
    st = F.when(rho > 0, v * F.sin(c) / rho / W7_SIN65).otherwise(0.0)
    lam = F.when(rho > 0, F.atan2(u * F.sin(c), rho * F.cos(c))).otherwise(0.0)
    lon = F.lit(lon0) + 3 * F.degrees(lam)
    return F.struct(F.least(F.greatest(lon, F.lit(lon0 - 180.0)), F.lit(lon0 + 180.0)).alias("lon"), F.degrees(F.asin(F.least(F.greatest(st, F.lit(-1.0)), F.lit(1.0)))).alias("lat"))


#: WGS 84.
_A, _F = 6378137.0, 1 / 298.257223563
_E = math.sqrt(2 * _F - _F * _F)


def _authalic(sin: Column) -> Column:
    return (1 - _E**2) * (sin / (1 - _E**2 * sin * sin) - F.lit(1 / (2 * _E)) * F.log((1 - _E * sin) / (1 + _E * sin)))


def _q_pole() -> float:
    return (1 - _E**2) * (1 / (1 - _E**2) - 1 / (2 * _E) * math.log((1 - _E) / (1 + _E)))


def polar_equal_area(lon: Column, lat: Column, north: bool = True) -> Column:
    """Lambert azimuthal equal area about a pole (EASE-Grid 2.0 north and south)."""
    sign = 1 if north else -1
    rho = F.lit(_A) * F.sqrt(F.lit(_q_pole()) - sign * _authalic(F.sin(F.radians(lat))))
    return F.struct((rho * F.sin(F.radians(lon))).alias("x"), (-sign * rho * F.cos(F.radians(lon))).alias("y"))


def cylindrical_equal_area(lon: Column, lat: Column, lat_ts: float = 30.0) -> Column:
    """EASE-Grid 2.0 global."""
    k = math.cos(math.radians(lat_ts)) / math.sqrt(1 - (_E * math.sin(math.radians(lat_ts))) ** 2)
    return F.struct((F.lit(_A * k) * F.radians(lon)).alias("x"), (F.lit(_A / (2 * k)) * _authalic(F.sin(F.radians(lat)))).alias("y"))


def polar_stereographic(lon: Column, lat: Column, lat_ts: float, lon0: float, north: bool) -> Column:
    """Ellipsoidal polar stereographic (3413: 70, -45, north; 3031: -71, 0, south)."""
    sign = 1.0 if north else -1.0

    def t(p: Column) -> Column:
        s = F.sin(p)
        return F.tan(F.lit(math.pi / 4) - p / 2) / F.pow((1 - _E * s) / (1 + _E * s), F.lit(_E / 2))

    ts = abs(math.radians(lat_ts))
    tc = math.tan(math.pi / 4 - ts / 2) / ((1 - _E * math.sin(ts)) / (1 + _E * math.sin(ts))) ** (_E / 2)
    mc = math.cos(ts) / math.sqrt(1 - (_E * math.sin(ts)) ** 2)
    rho = F.lit(_A * mc / tc) * t(sign * F.radians(lat))
    lam = sign * F.radians(lon - lon0)
    return F.struct((sign * rho * F.sin(lam)).alias("x"), (-sign * rho * F.cos(lam)).alias("y"))


def equal_earth(lon: Column, lat: Column) -> Column:
    """Equal Earth on the authalic sphere's formulas (published polynomial)."""
    a1, a2, a3, a4 = 1.340264, -0.081106, 0.000893, 0.003796
    th = F.asin(F.lit(math.sqrt(3) / 2) * F.sin(F.radians(lat)))
    t2 = th * th
    t6 = t2 * t2 * t2
    x = 2 * math.sqrt(3) * F.radians(lon) * F.cos(th) / (3 * (9 * a4 * t6 * t2 + 7 * a3 * t6 + 3 * a2 * t2 + a1))
    return F.struct((F.lit(W7_R) * x).alias("x"), (F.lit(W7_R) * th * (a4 * t6 * t2 + a3 * t6 + a2 * t2 + a1)).alias("y"))


def quad_address(lon: Column, lat: Column, z: int) -> Column:
    """Column and row of the geodetic quadtree's level z: squares of 360 / 2**z degrees."""
    size = 360.0 / (1 << z)
    return F.struct(F.lit(z).alias("z"), F.floor((lon + 180) / size).alias("x"), F.floor((lat + 90) / size).alias("y"))


def shoelace(ring: Column) -> Column:
    """Signed area of a closed ring, an array of struct(x, y)."""
    return F.aggregate(
        F.zip_with(F.slice(ring, F.lit(1), F.size(ring) - 1), F.slice(ring, F.lit(2), F.size(ring) - 1), lambda a, b: a["x"] * b["y"] - b["x"] * a["y"]),
        F.lit(0.0), lambda s, v: s + v,
    ) / 2
