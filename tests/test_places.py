"""Joins by place against testing all pairs, with crowded cells and sites in the way."""

import math
import random

from pyspark.sql import functions as F

from haulwatch.functions import geo
from haulwatch.operators import alarms, enrich, proximity


def metres(a, b):
    p, q = math.radians(a[1]), math.radians(b[1])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[0] - a[0]) / 2) ** 2
    return 2 * 6371000.0 * math.asin(math.sqrt(h))


def made(seed):
    rng = random.Random(seed)
    spots = [(113.6 + rng.random() * 0.03, 34.7 + rng.random() * 0.03) for _ in range(400)]
    spots += [(113.61 + rng.random() * 0.002, 34.71 + rng.random() * 0.002) for _ in range(300)]
    sites = [(1 + i % 2, i, 1 + i % 3 // 2, x, y, 0) for i, (x, y) in enumerate(spots)]
    points = [(i, 1 + i % 2, 113.59 + rng.random() * 0.05, 34.69 + rng.random() * 0.05) for i in range(400)]
    return sites, points


SITES = "dept_id int, site_id long, site_flag int, lng double, lat double, is_delete int"
POINTS = "event_id long, dept_id int, lng double, lat double"


def test_first_site_and_all_sites(spark):
    sites, points = made(5)
    s, p = spark.createDataFrame(sites, SITES), spark.createDataFrame(points, POINTS)
    near = {
        q[0]: sorted((t[2], t[1]) for t in sites if t[0] == q[1] and metres(q[2:4], t[3:5]) <= 500) for q in points
    }
    first = {r.event_id: (r.site_flag, r.site_id) if r.site_id is not None else None for r in proximity.with_site(p, s).collect()}
    assert first == {k: (v[0] if v else None) for k, v in near.items()}
    every = sorted((r.event_id, r.site_id) for r in proximity.near_sites(p, s).collect())
    assert every == sorted((k, i) for k, v in near.items() for _, i in v)
    ids = {r.event_id: sorted(r.near) for r in proximity.with_near_ids(p, s).collect()}
    assert ids == {k: sorted(i for _, i in v) for k, v in near.items()}


def test_clipped_polygons(spark):
    """Cells of any size, many-cornered polygons, positions on corners and cell rims."""
    rng = random.Random(3)
    rings = [[(rng.uniform(0, 3), rng.uniform(0, 3)) for _ in range(rng.randrange(3, 40))] for _ in range(12)]
    rings += [[(0, 0), (0, 2), (2, 2), (2, 0)], [(0.5, 0.5), (0.5, 2.5), (2.5, 0.5)]]
    spots = [(rng.uniform(-0.2, 3.2), rng.uniform(-0.2, 3.2)) for _ in range(250)]
    spots += [(x / 2, y / 2) for x in range(7) for y in range(7)]

    def inside(x, y, ring):
        odd = False
        for (ax, ay), (bx, by) in zip(ring, [ring[-1], *ring[:-1]]):
            if (ax > x) != (bx > x) and y < (by - ay) * (x - ax) / (bx - ax) + ay:
                odd = not odd
        return odd

    areas = spark.createDataFrame(
        [(d, d, f"a{d}", 1, ";".join(f"{x},{y}" for x, y in ring)) for d, ring in enumerate(rings)],
        "dept_id int, id int, city_name string, state int, coords string")
    points = spark.createDataFrame(
        [(d * 1000 + i, d, x, y) for d in range(len(rings)) for i, (x, y) in enumerate(spots)], POINTS)
    want = {d * 1000 + i for d, ring in enumerate(rings) for i, (x, y) in enumerate(spots) if inside(x, y, ring)}
    for size in (0.05, 0.5, 10.0):
        got = proximity.with_region(points, areas, size).where("region_id is not null")
        assert {r.event_id for r in got.collect()} == want, size


def test_a_country(spark):
    """A ring of 20,000 vertices that spans 40 by 25 degrees, with a district inside: cells where edges pass, blocks
    of cells within, and nothing for the rest of the box."""
    rng = random.Random(11)
    n = 20_000
    ring = []
    for i in range(n):
        turn = 2 * math.pi * i / n
        reach = 1 + 0.2 * math.sin(7 * turn) + 0.05 * math.sin(90 * turn)
        ring.append((100 + 16 * reach * math.cos(turn), 35 + 10 * reach * math.sin(turn)))
    small = [(100.01, 35.01), (100.01, 35.09), (100.08, 35.05)]
    areas = spark.createDataFrame(
        [(1, 1, "country", 1, ";".join(f"{x},{y}" for x, y in ring)),
         (1, 0, "district", 1, ";".join(f"{x},{y}" for x, y in small))],
        "dept_id int, id int, city_name string, state int, coords string")

    def inside(x, y, ring):
        odd = False
        for (ax, ay), (bx, by) in zip(ring, [ring[-1], *ring[:-1]]):
            if (ax > x) != (bx > x) and y < (by - ay) * (x - ax) / (bx - ax) + ay:
                odd = not odd
        return odd

    spots = [(rng.uniform(78, 122), rng.uniform(20, 50)) for _ in range(150)]
    spots += [(x + rng.uniform(-0.1, 0.1), y + rng.uniform(-0.1, 0.1)) for x, y in rng.sample(ring, 100)]
    spots += [(rng.uniform(100, 100.1), rng.uniform(35, 35.1)) for _ in range(50)]
    points = spark.createDataFrame([(i, 1, x, y) for i, (x, y) in enumerate(spots)], POINTS)
    want = {i: "district" if inside(x, y, small) else "country" if inside(x, y, ring) else None for i, (x, y) in enumerate(spots)}
    got = {r.event_id: r.region_name for r in proximity.with_region(points, areas).collect()}
    assert got == want and set(want.values()) == {"district", "country", None}
    dim = areas.withColumn("_ring", geo.polygon_from_text(F.col("coords"))).drop("coords")
    cells = proximity._covering_cells(dim, "_ring", 0.05).select("level", F.size("edges").alias("n")).toPandas()
    box = (max(x for x, _ in ring) - min(x for x, _ in ring)) / 0.05 * (max(y for _, y in ring) - min(y for _, y in ring)) / 0.05
    assert len(cells) < box / 8 and cells["n"].sum() < 30 * n and (cells["level"] > 0).sum() > 100


def test_off_route_by_cells_and_by_text(spark):
    """The grid of vertices gives what the text of the routes gives, position by position."""
    rng = random.Random(8)

    def route(n):
        return "[" + ",".join("[[%f,%f],[%f,%f]]" % tuple(v for _ in range(2) for v in (
            113.6 + rng.random() * 0.1, 34.7 + rng.random() * 0.1)) for _ in range(n)) + "]"

    cards = spark.createDataFrame(
        [(1, v, v * 10 + i, 0, coords) for v in range(6) for i, coords in enumerate(
            [route(4), route(2)] if v < 3 else [["[]", None, "[[[113.6],[113.65,34.75]]]"][v - 3]])] + [(1, 7, 1, 1, route(1))],
        "dept_id int, vehicle_id long, card_id long, state int, coords string")
    tracks = spark.createDataFrame(
        [(i, 1, i % 9, 113.6 + rng.random() * 0.1, 34.7 + rng.random() * 0.1) for i in range(900)] + [(901, 1, 1, None, None)],
        "event_id long, dept_id int, vehicle_id long, lng double, lat double")
    by_text = alarms.off_route_points(enrich.with_register_card(tracks, cards))
    by_cell = alarms.off_route_points(tracks, cards)
    rows = lambda df: sorted((r.event_id, r.off_route) for r in df.collect())
    got, want = rows(by_cell), rows(by_text)
    assert got == want and {True, False} == {off for _, off in want}
    plan = by_cell._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("route_vertices") == 0 and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_poles_and_the_date_line(spark):
    sites = [(1, 1, 1, 179.9995, 10.0, 0), (1, 2, 1, -179.9995, 10.0, 0), (1, 3, 1, 0.0, 89.9999, 0), (1, 4, 1, 30.0, 89.0, 0)]
    points = [(1, 1, 179.9999, 10.0), (2, 1, -179.9999, 10.0), (3, 1, 180.0, 10.0), (4, 1, 170.0, 89.9998), (5, 1, -95.0, 89.9999),
              (6, 1, 30.2, 89.0), (7, 1, 0.0, 10.0)]
    s, p = spark.createDataFrame(sites, SITES), spark.createDataFrame(points, POINTS)
    want = sorted((q[0], t[1]) for q in points for t in sites if metres(q[2:4], t[3:5]) < 500)
    assert sorted((r.event_id, r.site_id) for r in proximity.near_sites(p, s).collect()) == want
    first = {r.event_id: r.site_id for r in proximity.with_site(p, s).collect()}
    assert first == {q[0]: min((i for e, i in want if e == q[0]), default=None) for q in points}


def test_areas_with_odd_texts(spark):
    areas = spark.createDataFrame(
        [(1, 1, "plain", 1, "0,0;0,2;2,2;2,0"), (2, 2, "closed", 1, "0,0;0,2;2,2;2,0;"), (3, 3, "bad", 1, "0,0;0,x;2,2"),
         (4, 4, "none", 1, None)], "dept_id int, id int, city_name string, state int, coords string")
    points = spark.createDataFrame([(i, i, 1.0, 1.0) for i in (1, 2, 3, 4)] + [(5, 1, None, None)], POINTS)
    got = {r.event_id: r.region_name for r in proximity.with_region(points, areas).collect()}
    assert got == {1: "plain", 2: "closed", 3: None, 4: None, 5: None}
    assert sorted(r.id for r in proximity.bad_areas(areas).collect()) == [3, 4]


def test_a_site_that_covers_a_cell_ends_its_list(spark):
    sites, _ = made(9)
    size, live = proximity.FIRST_SITE_CELL_DEG, spark.createDataFrame(sites, SITES)
    pairs = [tuple(r) for r in proximity._near_cells(live, 500.0, size).select(
        "dept_id", "_cx", "_cy", "site_flag", "site_id", "lng", "lat").collect()]
    kept = {}
    for r in proximity._possible_firsts(live, 500.0, size).collect():
        kept.setdefault((r.dept_id, r._cx, r._cy), set()).add((r.site_flag, r.site_id))
    by_cell = {}
    for d, cx, cy, flag, site, lng, lat in pairs:
        far = max(metres((lng, lat), ((cx + i) * size - 180.0, (cy + j) * size)) for i in (0, 1) for j in (0, 1))
        by_cell.setdefault((d, cx, cy), []).append(((flag, site), far <= 499.0))
    for cell, found in by_cell.items():
        stop = min((rank for rank, covers in found if covers), default=(99, 0))
        assert kept[cell] == {rank for rank, _ in found if rank <= stop}
    assert sum(map(len, kept.values())) < len(pairs) / 2


def test_pairs_of_sites_at_one_place(spark):
    """Sites at one place, one of them listed twice, give a row each; a position meets their place once."""
    sites = [(1, s, 2, 113.6, 34.7, 0) for s in (1, 2, 2, 3)] + [(1, 4, 2, 113.7, 34.7, 0)]
    s, p = spark.createDataFrame(sites, SITES), spark.createDataFrame([(7, 1, 113.6, 34.7)], POINTS)
    pairs = proximity.near_sites(p, s)
    assert sorted((r.event_id, r.site_id) for r in pairs.collect()) == [(7, 1), (7, 2), (7, 2), (7, 3)]
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode(_sites") < plan.index("Join Inner")


def test_first_forbidden_site_of_a_place(spark):
    """The smallest id without a permit, of sites at one place and of one that has two, whatever the permits."""
    sites = [(5, 0, "A"), (6, 0, "A"), (8, 0, "A"), (3, 0, "B"), (9, 0, "A"), (9, 0, "B"), (5, 1, "A"), (6, 1, "A")]
    at = {"A": (113.6, 34.7), "B": (113.7, 34.7)}
    s = spark.createDataFrame([(i, f"s{i}", d, 2, 0, "1", *at[p]) for i, d, p in sites],
                              "site_id long, site_name string, dept_id int, site_flag int, is_delete int, audit_state string, lng double, lat double")
    permits = {1: [], 2: [5], 3: [5, 6], 4: [6, 8], 5: [5, 6, 8, 9], 6: [9, 3], 7: [3, 5, 6, 8, 9]}
    cards = spark.createDataFrame([(v, i, 0) for v, ids in permits.items() for i in ids], "vehicle_id long, disposal_site_id long, state int")
    rows = [(d, v, 10 * v + n + 100 * d, 1_000 * n, *at[p]) for d in (0, 1) for v in permits for n, p in enumerate("AB")]
    tracks = spark.createDataFrame(rows, "dept_id int, vehicle_id long, event_id long, t_sec long, lng double, lat double")
    points = alarms.illegal_disposal_points(tracks, s, cards)
    want = []
    for d, v, event, _, x, y in rows:
        free = [i for i, sd, p in sites if sd == d and at[p] == (x, y) and i not in permits[v]]
        want += [(event, min(free))] if free else []
    assert sorted((r.start_event_id, r.site_id) for r in points.collect()) == sorted(want)
    joined = points._jdf.queryExecution().optimizedPlan().toString()
    assert "_firsts" in joined
