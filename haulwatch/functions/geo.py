"""Geometry on plain longitude/latitude columns, built from JVM expressions only."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371000.0

# Fixed values of the GCJ-02 / BD-09 transformations (public constants).
GCJ_A = 6378245.0
GCJ_EE = 0.00669342162296594323
PI = 3.14159265358979324
BD_STEP = PI * 3000.0 / 180.0
BD_DLNG = 0.0065
BD_DLAT = 0.006

METRES_PER_DEGREE = math.pi * EARTH_RADIUS_M / 180.0


def distance_m(lng1: Column, lat1: Column, lng2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres on a sphere (haversine)."""
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlng = F.radians(lng2 - lng1) / 2
    h = F.sin(half_dlat) * F.sin(half_dlat) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.sin(half_dlng) * F.sin(half_dlng)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def _wave(amplitudes: list[tuple[float, Column]]) -> Column:
    total = None
    for amplitude, angle in amplitudes:
        term = F.lit(amplitude) * F.sin(angle)
        total = term if total is None else total + term
    return total * 2.0 / 3.0


def wgs_to_gcj(lng: Column, lat: Column) -> tuple[Column, Column]:
    """WGS-84 to GCJ-02, as (lng, lat)."""
    x, y = lng - 105.0, lat - 35.0
    ripple = _wave([(20.0, x * 6.0 * PI), (20.0, x * 2.0 * PI)])
    shift_lat = (
        F.lit(-100.0) + x * 2.0 + y * 3.0 + y * y * 0.2 + x * y * 0.1 + F.sqrt(F.abs(x)) * 0.2
        + ripple
        + _wave([(20.0, y * PI), (40.0, y / 3.0 * PI)])
        + _wave([(160.0, y / 12.0 * PI), (320.0, y * PI / 30.0)])
    )
    shift_lng = (
        F.lit(300.0) + x + y * 2.0 + x * x * 0.1 + x * y * 0.1 + F.sqrt(F.abs(x)) * 0.1
        + ripple
        + _wave([(20.0, x * PI), (40.0, x / 3.0 * PI)])
        + _wave([(150.0, x / 12.0 * PI), (300.0, x / 30.0 * PI)])
    )
    phi = lat / 180.0 * PI
    w = F.lit(1.0) - F.sin(phi) * F.sin(phi) * GCJ_EE
    meridian = F.lit(GCJ_A * (1 - GCJ_EE)) / (w * F.sqrt(w))
    prime_vertical = F.lit(GCJ_A) / F.sqrt(w)
    out_lat = lat + shift_lat * 180.0 / (meridian * PI)
    out_lng = lng + shift_lng * 180.0 / (prime_vertical * F.cos(phi) * PI)
    return out_lng, out_lat


def gcj_to_bd(lng: Column, lat: Column) -> tuple[Column, Column]:
    """GCJ-02 to BD-09, as (lng, lat)."""
    r = F.sqrt(lng * lng + lat * lat) + F.sin(lat * BD_STEP) * 0.00002
    angle = F.atan2(lat, lng) + F.cos(lng * BD_STEP) * 0.000003
    return r * F.cos(angle) + BD_DLNG, r * F.sin(angle) + BD_DLAT


def bd_to_gcj(lng: Column, lat: Column) -> tuple[Column, Column]:
    """BD-09 to GCJ-02, as (lng, lat)."""
    x, y = lng - BD_DLNG, lat - BD_DLAT
    r = F.sqrt(x * x + y * y) - F.sin(y * BD_STEP) * 0.00002
    angle = F.atan2(y, x) - F.cos(x * BD_STEP) * 0.000003
    return r * F.cos(angle), r * F.sin(angle)


def polygon_from_text(text: Column) -> Column:
    """'lon,lat;lon,lat;...' to array<struct<x,y>>; empty parts, as behind a last ';', are none, and
    vertices that are no numbers become null."""
    def vertex(part: Column) -> Column:
        xy = F.split(part, ",")
        return F.struct(
            F.get(xy, F.lit(0)).try_cast("double").alias("x"),
            F.get(xy, F.lit(1)).try_cast("double").alias("y"),
        )

    return F.transform(F.filter(F.split(text, ";"), lambda part: F.trim(part) != ""), vertex)


def polygon_from_json(text: Column) -> Column:
    """'[[lon,lat],...]' to array<struct<x,y>>."""
    return F.transform(
        F.from_json(text, "array<array<double>>"),
        lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")),
    )


def polygon_edges(ring: Column) -> Column:
    """Closed ring to array<struct<x,y,px,py>>: every vertex with the one before it."""
    def edge(p: Column, i: Column) -> Column:
        prev = F.element_at(ring, F.when(i == 0, F.size(ring)).otherwise(i))
        return F.struct(
            p["x"].alias("x"), p["y"].alias("y"), prev["x"].alias("px"), prev["y"].alias("py")
        )

    return F.transform(ring, edge)


def in_polygon(lng: Column, lat: Column, edges: Column, odd: Column | int = 0) -> Column:
    """Even-odd test against edges made by :func:`polygon_edges`; ``odd`` is 1 if an odd number of edges
    that are crossed anyhow was left out."""
    def crossed(e: Column) -> Column:
        cut = F.try_divide((e["py"] - e["y"]) * (lng - e["x"]), e["px"] - e["x"]) + e["y"]
        return ((e["x"] > lng) != (e["px"] > lng)) & (lat < cut)

    return (F.size(F.filter(edges, crossed)) + odd) % 2 == 1


def route_vertices(coords: Column) -> Column:
    """Routes of all permits ('|' between permits) to array<struct<x,y>> of their vertices."""
    per_card = F.transform(
        F.split(coords, r"\|"),
        lambda card: F.flatten(F.from_json(card, "array<array<array<double>>>")),
    )
    return F.transform(
        F.flatten(F.filter(per_card, lambda card: card.isNotNull())),
        lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")),
    )


def off_route(lng: Column, lat: Column, vertices: Column, radius_m: float = 500.0) -> Column:
    """True unless some route vertex lies within ``radius_m``."""
    return ~F.exists(vertices, lambda v: distance_m(lng, lat, v["x"], v["y"]) <= radius_m)


def cell(coord: Column, size_deg: float) -> Column:
    """Index of the grid line band a coordinate falls in."""
    return F.floor(coord / size_deg).cast("long")
