"""Joins by place: points with nearby sites, with regions and with fences.

All of them meet on an equi-join key, the department and a grid cell, instead of testing all
pairs. The small side is turned into one row per (department, cell) that lists its candidates
in match order; positions keep their partitioning and are never multiplied, and the first
match needs no shuffle by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwatch.functions import geo, timefn

SITE_RADIUS_M = 500.0
SITE_CELL_DEG = 0.01
# Small enough that a site near the middle of a cell has all of the cell within 500 m.
FIRST_SITE_CELL_DEG = 0.004
AREA_CELL_DEG = 0.05

# Alarm code of a violated rule by fence flag.
FENCE_CODES = {1: "0110", 2: "0115", 3: "0116", 4: "0114", 5: "0119"}


def all_sites(build: DataFrame, disposal: DataFrame) -> DataFrame:
    """Live building (flag 1) and disposal (flag 2) sites in one table."""
    live = F.col("is_delete") == 0
    return build.where(live).withColumn("site_flag", F.lit(1)).unionByName(
        disposal.where(live).withColumn("site_flag", F.lit(2)), allowMissingColumns=True
    )


def audited_disposal(sites: DataFrame) -> DataFrame:
    """Disposal sites that passed the audit; only these permit anything and are visited."""
    return sites.where((F.col("site_flag") == 2) & (F.col("audit_state") == "1"))


def _column(lng: Column, size: float) -> Column:
    """Band of longitude, counted from -180 degrees and not yet taken round the globe."""
    return geo.cell(lng + 180.0, size)


def _round_globe(column: Column, size: float) -> Column:
    return F.pmod(column, F.lit(round(360.0 / size)))


def _near_cells(sites: DataFrame, radius_m: float, size: float = SITE_CELL_DEG) -> DataFrame:
    """Sites repeated for every cell that a point within the radius can lie in. A degree of
    longitude shrinks towards the poles, so the reach in x grows with 1/cos(lat), up to the whole
    circle where the pole itself is in reach; cells go on across 180 degrees."""
    reach_y = radius_m / geo.METRES_PER_DEGREE * 1.001
    top = F.abs(F.col("lat")) + reach_y
    reach_x = F.when(top < 89.999, F.least(F.lit(reach_y) / F.cos(F.radians(top)), F.lit(180.0))).otherwise(180.0)
    columns = F.sequence(_column(F.col("lng") - reach_x, size), _column(F.col("lng") + reach_x, size))
    columns = F.array_distinct(F.transform(columns, lambda c: _round_globe(c, size)))
    rows = F.sequence(geo.cell(F.col("lat") - reach_y, size), geo.cell(F.col("lat") + reach_y, size))
    return sites.withColumn("_cx", F.explode(columns)).withColumn("_cy", F.explode(rows))


def _site_cells(df: DataFrame, size: float) -> DataFrame:
    return df.withColumns({
        "_cx": _round_globe(_column(F.col("lng"), size), size), "_cy": geo.cell(F.col("lat"), size)})


def _point_cells(df: DataFrame, size: float) -> DataFrame:
    return df.withColumns({"_cx": geo.cell(F.col("lng"), size), "_cy": geo.cell(F.col("lat"), size)})


def _close_to(site: Column, radius_m: float, strict: bool) -> Column:
    d = geo.distance_m(F.col("lng"), F.col("lat"), site["lng"], site["lat"])
    return (d < radius_m) if strict else (d <= radius_m)


def _first_at_place(sites: DataFrame, order: list[str]) -> DataFrame:
    """Of several sites at exactly the same place only the first can be a first match."""
    rest = [c for c in sites.columns if c not in ("dept_id", "lng", "lat")]
    return sites.groupBy("dept_id", "lng", "lat").agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_s")
    ).select("dept_id", "lng", "lat", "_s.*")


def _possible_firsts(sites: DataFrame, radius_m: float, size: float) -> DataFrame:
    """(site, cell) pairs in which the site can be some position's first match. A site within
    the radius of the whole cell ends the list of that cell: all positions in it match there at
    the latest. Cells amid a crowd of sites so get short lists; a cell at the rim of one, which no
    site has within its radius as a whole, keeps all sites that reach into it."""
    pairs = _near_cells(sites, radius_m, size)
    corners = [
        geo.distance_m(F.col("lng"), F.col("lat"), (F.col("_cx") + dx) * size - 180.0, (F.col("_cy") + dy) * size)
        for dx in (0, 1) for dy in (0, 1)
    ]
    rank = F.struct("site_flag", "site_id")
    cell_key = ["dept_id", "_cx", "_cy"]
    # One metre of slack keeps rounding at the corners on the safe side.
    whole = pairs.where(F.greatest(*corners) <= radius_m - 1.0)
    stops = whole.groupBy(*cell_key).agg(F.min(rank).alias("_stop"))
    kept = pairs.join(stops, cell_key, "left")
    return kept.where(F.col("_stop").isNull() | (rank <= F.col("_stop"))).drop("_stop")


def with_site(df: DataFrame, sites: DataFrame, radius_m: float = SITE_RADIUS_M) -> DataFrame:
    """Adds the first site, by (flag, id), within the radius in the same department; null
    columns when there is none. The radius is a parameter, sites' own radius is not used."""
    attrs = [c for c in sites.columns if c not in ("dept_id", "is_delete")]
    live = sites.where(F.col("lng").isNotNull() & F.col("lat").isNotNull())
    if "is_delete" in sites.columns:
        live = live.where(F.col("is_delete") == 0)
    live = _first_at_place(live.select("dept_id", *attrs), ["site_flag", "site_id"])
    lead = ["site_flag", "site_id"]
    entry = F.struct(*lead, *[a for a in attrs if a not in lead])
    cells = _possible_firsts(live, radius_m, FIRST_SITE_CELL_DEG).groupBy("dept_id", "_cx", "_cy").agg(
        F.array_sort(F.collect_list(entry)).alias("_near")
    )
    joined = _site_cells(df, FIRST_SITE_CELL_DEG).join(cells, ["dept_id", "_cx", "_cy"], "left")
    first = F.get(F.filter("_near", lambda s: _close_to(s, radius_m, False)), F.lit(0))
    out = joined.withColumn("_site", first)
    named = {a: a if a.startswith("site_") else "site_" + a for a in attrs}
    return out.select(*df.columns, *[F.col("_site")[a].alias(n) for a, n in named.items()])


def near_sites(df: DataFrame, sites: DataFrame, radius_m: float = SITE_RADIUS_M) -> DataFrame:
    """All sites strictly within the radius, one row per (position, site); positions without
    a site give no row. Only pairs in neighbouring cells meet."""
    live = sites.where(F.col("lng").isNotNull() & F.col("lat").isNotNull())
    if "is_delete" in sites.columns:
        live = live.where(F.col("is_delete") == 0)
    # sites at one place are met, and measured, as one; their ids follow
    places = live.groupBy("dept_id", "lng", "lat").agg(F.collect_list(F.struct("site_id")).alias("_sites"))
    dim = _near_cells(places, radius_m).select(
        "dept_id", "_cx", "_cy", "_sites", F.col("lng").alias("_slng"), F.col("lat").alias("_slat")
    )
    pairs = _site_cells(df, SITE_CELL_DEG).join(dim, ["dept_id", "_cx", "_cy"], "inner")
    d = geo.distance_m(F.col("lng"), F.col("lat"), F.col("_slng"), F.col("_slat"))
    near = pairs.where(d < radius_m).select(*df.columns, F.explode("_sites").alias("_s"))
    return near.select(*df.columns, F.col("_s.site_id").alias("site_id"))


def together(sites: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Live sites whose places are the same, which every position is near to or not at once: the places of each such
    group, named by its smallest id in the department, and its members (``group_id``, ``site_id``)."""
    live = sites.where(F.col("site_id").isNotNull() & F.col("lng").isNotNull() & F.col("lat").isNotNull())
    if "is_delete" in sites.columns:
        live = live.where(F.col("is_delete") == 0)
    located = live.groupBy("dept_id", "site_id").agg(
        F.array_sort(F.collect_set(F.struct("lng", "lat"))).alias("_places"))
    groups = located.groupBy("dept_id", "_places").agg(
        F.min("site_id").alias("group_id"), F.collect_list("site_id").alias("_members"))
    places = groups.select("dept_id", F.col("group_id").alias("site_id"), F.explode("_places").alias("_p")).select(
        "dept_id", "site_id", "_p.*")
    return places, groups.select("dept_id", "group_id", F.explode("_members").alias("site_id"))


def with_near_ids(df: DataFrame, sites: DataFrame, radius_m: float = SITE_RADIUS_M) -> DataFrame:
    """Adds ``near``: the ids of all sites strictly within the radius, empty when there is none.
    Like :func:`near_sites`, but one row per position, as a stream needs it."""
    live = sites.where(F.col("lng").isNotNull() & F.col("lat").isNotNull())
    if "is_delete" in sites.columns:
        live = live.where(F.col("is_delete") == 0)
    entry = F.struct("site_id", "lng", "lat")
    cells = _near_cells(live.select("dept_id", "site_id", "lng", "lat"), radius_m).groupBy(
        "dept_id", "_cx", "_cy"
    ).agg(F.collect_list(entry).alias("_near"))
    joined = _site_cells(df, SITE_CELL_DEG).join(cells, ["dept_id", "_cx", "_cy"], "left")
    hits = F.filter(F.coalesce("_near", F.array()), lambda s: _close_to(s, radius_m, True))
    return joined.select(*df.columns, F.transform(hits, lambda s: s["site_id"]).alias("near"))


# Positions within this many degrees of a cell's rim count as inside it when edges are left out.
RIM_DEG = 1e-9
# Cells that lie in a polygon as a whole are kept in blocks of 2^4 by 2^4.
BLOCK_LEVEL = 4
# Polygons begin with cells of at most 2^12 by 2^12.
TOP_LEVEL = 12


def _half(cell: Column, times: Column) -> Column:
    """The cell of the level so many times up."""
    return F.call_function("shiftright", cell, times)


def _width(level: Column) -> Column:
    """Cells of level 0 along the side of one."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), level)


def _covering_cells(dim: DataFrame, ring: str, size: float) -> DataFrame:
    """Polygons in the cells that cover them, as a quadtree finds them: a cell that edges pass through is split into
    four, down to cells of ``size``, and hands its edges down to those of the four that they can matter to; a cell
    without edges is inside or outside as a whole. So the work follows the number of edges times the depth, and not
    the number of cells times the number of edges.

    Columns: ``level``, 0 for a cell of ``size`` with the ``edges`` that a position in it can have above it or not, and
    ``odd``, whether an odd number of others is above every position of it; or BLOCK_LEVEL for a block of cells that lie
    in the polygon. ``_cx``, ``_cy`` count cells of that level."""
    def extent(name: str) -> tuple[Column, Column]:
        values = F.transform(F.col(ring), lambda p: p[name])
        return geo.cell(F.array_min(values), size), geo.cell(F.array_max(values), size)

    (west, east), (south, north) = extent("x"), extent("y")
    dim = dim.withColumns({"_w": west, "_e": east, "_s": south, "_n": north, "_edges": geo.polygon_edges(F.col(ring))})
    span = F.greatest(F.col("_e") - F.col("_w"), F.col("_n") - F.col("_s")) + 1
    dim = dim.withColumn("_top", F.least(F.ceil(F.log2(span)), F.lit(TOP_LEVEL)).cast("int"))

    def sides(cx: Column, cy: Column, level: Column) -> tuple[Column, Column, Column, Column]:
        wide = _width(level) * size
        left, low = cx * wide - RIM_DEG, cy * wide - RIM_DEG
        return left, left + (wide + 2 * RIM_DEG), low, low + (wide + 2 * RIM_DEG)

    def height(e: Column, x: Column) -> Column:
        return F.try_divide((e["py"] - e["y"]) * (x - e["x"]), e["px"] - e["x"]) + e["y"]

    def clipped(cx: Column, cy: Column, level: Column, edges: Column, odd: Column) -> Column:
        left, right, low, high = sides(cx, cy, level)

        def spans(e: Column) -> Column:
            return (F.least(e["x"], e["px"]) <= left) & (F.greatest(e["x"], e["px"]) >= right)

        def above(e: Column) -> Column:
            return F.coalesce(spans(e) & (F.least(height(e, left), height(e, right)) > high), F.lit(False))

        def matters(e: Column) -> Column:
            beside = (F.greatest(e["x"], e["px"]) < left) | (F.least(e["x"], e["px"]) > right)
            below = (F.greatest(e["y"], e["py"]) < low) | F.coalesce(
                spans(e) & (F.greatest(height(e, left), height(e, right)) < low), F.lit(False))
            return ~beside & ~below & ~above(e)

        # Without an edge in the cell an odd number of edges is above all of it or above none of it, so that one place
        # tells; with one, what is above may begin or end where that edge leaves the cell.
        middle = left + (right - left) / 2

        def cell(near: Column) -> Column:
            touched = F.exists(near, lambda e: F.least(e["y"], e["py"]) <= high)
            over = F.size(F.filter(near, lambda e: (e["x"] > middle) != (e["px"] > middle)))
            return F.struct(
                level.alias("level"), cx.alias("cx"), cy.alias("cy"),
                F.when(touched, near).otherwise(F.filter(near, lambda e: F.lit(False))).alias("edges"),
                ((odd + F.size(F.filter(edges, above)) + F.when(touched, 0).otherwise(over)) % 2).cast("int").alias("odd"))

        return F.transform(F.array(F.filter(edges, matters)), cell)[0]

    def kept(cells: Column) -> Column:
        return F.filter(cells, lambda c: (F.size(c["edges"]) > 0) | (c["odd"] == 1))

    def split(cells: Column) -> Column:
        def parts(c: Column) -> Column:
            quarter = F.transform(F.array(*[F.lit(q).cast("long") for q in range(4)]), lambda q: clipped(
                c["cx"] * 2 + q % 2, c["cy"] * 2 + F.shiftright(q, 1), c["level"] - 1, c["edges"], c["odd"]))
            return F.when((c["level"] > 0) & (F.size(c["edges"]) > 0), kept(quarter)).otherwise(F.array(c))

        return F.flatten(F.transform(cells, parts))

    top = F.col("_top")
    whole = F.flatten(F.transform(
        F.sequence(_half(F.col("_w"), top), _half(F.col("_e"), top)), lambda cx: F.transform(
            F.sequence(_half(F.col("_s"), top), _half(F.col("_n"), top)),
            lambda cy: clipped(cx, cy, top, F.col("_edges"), F.lit(0)))))
    steps = F.when(top > 0, F.sequence(F.lit(1), top)).otherwise(F.array().cast("array<int>"))
    cells = dim.withColumn("_cell", F.explode(F.aggregate(steps, kept(whole), lambda found, _: split(found))))
    # a cell without edges becomes blocks, or, where it is smaller than one, cells
    level = F.when(F.col("_cell.level") >= BLOCK_LEVEL, BLOCK_LEVEL).otherwise(0)
    cells = cells.withColumns({"level": level, "edges": F.col("_cell.edges"), "odd": F.col("_cell.odd")})
    times = _width(F.col("_cell.level") - F.col("level"))
    for axis in ("cx", "cy"):
        first = F.col(f"_cell.{axis}") * times
        cells = cells.withColumn(f"_{axis}", F.explode(F.sequence(first, first + times - 1)))
    return cells.drop("_cell", "_w", "_e", "_s", "_n", "_top", "_edges")


def _with_polygons(df: DataFrame, cells: DataFrame, entry: Column, size: float, found: str) -> DataFrame:
    """Adds ``found``: the entries of the polygons whose cell or block a position is in, or null."""
    out = _point_cells(df, size)
    listed = cells.select("dept_id", "level", "_cx", "_cy", entry.alias("_x"))
    for level, name in ((0, "_near"), (BLOCK_LEVEL, "_amid")):
        own = listed.where(F.col("level") == level).groupBy("dept_id", "_cx", "_cy").agg(
            F.array_sort(F.collect_list("_x")).alias(name))
        if level:
            out = out.withColumns({c: F.shiftright(c, level) for c in ("_cx", "_cy")})
        out = out.join(own, ["dept_id", "_cx", "_cy"], "left")
    both = F.when(F.col("_amid").isNull(), F.col("_near")).when(F.col("_near").isNull(), F.col("_amid"))
    return out.withColumn(found, both.otherwise(F.array_sort(F.concat("_near", "_amid")))).drop("_near", "_amid")


def _bad_ring(ring: str) -> Column:
    return F.coalesce(F.exists(ring, lambda p: p["x"].isNull() | p["y"].isNull()), F.lit(True))


def bad_areas(areas: DataFrame) -> DataFrame:
    """Active areas with a vertex that is no number, or without a polygon: no position can be in them.
    For a reject table."""
    rings = areas.where(F.col("state") == 1).withColumn("_ring", geo.polygon_from_text(F.col("coords")))
    return rings.where(_bad_ring("_ring")).drop("_ring")


def with_region(df: DataFrame, areas: DataFrame, cell_deg: float = AREA_CELL_DEG) -> DataFrame:
    """Adds region_id and region_name of the first active area, by id, of the department
    that contains the position. Areas of :func:`bad_areas` contain none."""
    active = areas.where(F.col("state") == 1).groupBy("dept_id", "coords").agg(
        F.min(F.struct("id", "city_name")).alias("_a")
    )
    dim = active.select(
        "dept_id", "_a.*", geo.polygon_from_text(F.col("coords")).alias("_ring")
    ).where(~_bad_ring("_ring"))
    entry = F.struct("id", "city_name", "edges", "odd")
    joined = _with_polygons(df, _covering_cells(dim, "_ring", cell_deg), entry, cell_deg, "_areas")
    hit = F.filter("_areas", lambda a: geo.in_polygon(F.col("lng"), F.col("lat"), a["edges"], a["odd"]))
    return joined.withColumn("_hit", F.get(hit, F.lit(0))).select(
        *df.columns, F.col("_hit.id").alias("region_id"), F.col("_hit.city_name").alias("region_name")
    )


def fence_rules(rules: dict[int, DataFrame], boundaries: DataFrame) -> DataFrame:
    """The five rule tables, tagged with their flag, in one table with their polygon."""
    parts = []
    for flag, table in sorted(rules.items()):
        typed = table.where(F.col("state") == 0).drop("state").withColumn("fence_flag", F.lit(flag))
        parts.append(typed)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    for name, dtype in (("speed", "double"), ("start_date", "string"), ("end_date", "string")):
        if name not in whole.columns:
            whole = whole.withColumn(name, F.lit(None).cast(dtype))
    bounds = boundaries.select(F.col("id").alias("condition_id"), "name", "coords", "area_id")
    return whole.join(bounds, "condition_id", "inner")


def _violated(rule: Column) -> Column:
    speed, sec = F.col("speed"), F.col("t_sec")
    return (
        F.when(rule["fence_flag"] == 1, speed > rule["speed"])
        .when(rule["fence_flag"].isin(2, 4), speed > 0)
        .when(rule["fence_flag"] == 3, ~timefn.in_time_range(sec, rule["start_date"], rule["end_date"]))
        .when(rule["fence_flag"] == 5, timefn.in_effective_date(sec, rule["start_date"], rule["end_date"]))
    )


def with_violations(df: DataFrame, rules: DataFrame, cell_deg: float = AREA_CELL_DEG) -> DataFrame:
    """Adds ``violations``: the rules of the department, by (flag, id), whose fence contains
    the position and whose condition it breaks. Empty when there is none."""
    code = F.create_map(*[F.lit(v) for pair in FENCE_CODES.items() for v in pair])
    dim = rules.withColumn("_ring", geo.polygon_from_json(F.col("coords"))).where(F.size("_ring") > 2)
    entry = F.struct(
        "fence_flag", F.col("condition_id").alias("fence_id"), F.col("name").alias("fence_name"),
        F.col("area_id").alias("fence_area_id"), code[F.col("fence_flag")].alias("illegal_type_code"), "speed", "start_date", "end_date",
        "edges", "odd",
    )
    joined = _with_polygons(df, _covering_cells(dim, "_ring", cell_deg), entry, cell_deg, "_rules")
    broken = F.filter(
        F.col("_rules"),
        lambda r: geo.in_polygon(F.col("lng"), F.col("lat"), r["edges"], r["odd"]) & F.coalesce(_violated(r), F.lit(False)),
    )
    slim = F.transform(
        broken,
        lambda r: F.struct(
            r["fence_flag"].alias("fence_flag"), r["fence_id"].alias("fence_id"),
            r["fence_name"].alias("fence_name"), r["fence_area_id"].alias("fence_area_id"),
            r["illegal_type_code"].alias("illegal_type_code"),
        ),
    )
    none = F.expr(
        "cast(array() as array<struct<fence_flag:int,fence_id:int,fence_name:string,fence_area_id:string,illegal_type_code:string>>)"
    )
    return joined.withColumn("violations", F.coalesce(slim, none)).select(*df.columns, "violations")


def fence_violations(df: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per broken rule; a position that breaks none gives one plain row."""
    marked = with_violations(df, rules).withColumn("_v", F.explode_outer("violations"))
    return marked.select(*df.columns, "_v.*")



def off_route(df: DataFrame, routes: DataFrame, radius_m: float = SITE_RADIUS_M) -> DataFrame:
    """Adds ``off_route``: no vertex of a route of the vehicle's permits is within the radius. A vertex that is no place
    is near nothing, and nothing is near a position without a place. ``routes`` has ``coords`` per vehicle, routes of
    several permits with '|' between them.

    Vertices are laid out on grid cells, per vehicle; a position meets the one row of its (vehicle, cell), which lists
    the vertices that can be near. Positions carry no routes and are not multiplied."""
    key = ["dept_id", "vehicle_id"]
    places = routes.select(*key, F.explode(geo.route_vertices(F.col("coords"))).alias("_v")).select(
        *key, F.col("_v.x").alias("lng"), F.col("_v.y").alias("lat")).dropna().distinct()
    cell_key = [*key, "_cx", "_cy"]
    cells = _near_cells(places, radius_m).groupBy(*cell_key).agg(F.collect_list(F.struct("lng", "lat")).alias("_near"))
    out = _site_cells(df, SITE_CELL_DEG).join(cells, cell_key, "left")
    near = F.coalesce(F.exists("_near", lambda v: _close_to(v, radius_m, False)), F.lit(False))
    return out.withColumn("off_route", ~near).select(*df.columns, "off_route")
