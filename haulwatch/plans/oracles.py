"""DuckDB SQL with the expected result of each registered query.

Sequential operators are written as a recursive walk over the positions of a vehicle, one by
one, which is how they are defined and not how they are computed on Spark.
"""

from __future__ import annotations

import re

from haulwatch.sources.derived import VIEWS, duckdb_text

ORACLES: dict[str, str] = {}

R = 6371000.0
KEYS = "dept_id, vehicle_id"


def _views_in(text: str) -> list[str]:
    return [name for name in VIEWS if re.search(rf"\b{name}\b", text)]


def oracle(name: str, body: str, ctes: dict[str, str] | None = None, recursive: bool = False) -> None:
    """Registers ``body`` with the derived inputs it mentions put in front."""
    parts = dict(ctes or {})
    everything = " ".join([body, *parts.values()])
    inputs = {v: duckdb_text(v) for v in _views_in(everything)}
    whole = [f"{n} AS ({t})" for n, t in {**inputs, **parts}.items()]
    head = ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(whole) + "\n" if whole else ""
    ORACLES[name] = head + body


def dist(lng1: str, lat1: str, lng2: str, lat2: str) -> str:
    return (
        f"(2 * {R} * asin(least(1.0, sqrt(power(sin(radians({lat2} - {lat1}) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * power(sin(radians({lng2} - {lng1}) / 2), 2)))))"
    )


CLOCK = "(t_sec % 86400)"
ADMITTED = "SELECT * FROM v_track WHERE manage_state = '1' AND audit_state = '1'"
BOX = "lat > 20 AND lat < 40 AND lng > 100 AND lng < 120 AND speed >= 0 AND speed < 100"
CLEANED = f"{ADMITTED} AND {BOX}"
TIMED = "t_sec IS NOT NULL"
STAMP = "strftime(make_timestamp({0} * 1000000), '%Y-%m-%d %H:%M:%S')"

# ---- sources and sinks
oracle("src_bus_json", "SELECT event_id, vehicle_id, dept_id, t_sec, speed, round(lat, 6) AS lat, round(lng, 6) AS lng, audit_state FROM v_track")
oracle("bus_to_json", "SELECT concat(dept_id, '-', vehicle_id) AS key, CAST(json_object('event_id', event_id, 'vehicle_id', vehicle_id, 'dept_id', dept_id, 't_sec', t_sec, 'manage_state', manage_state, 'audit_state', audit_state) AS VARCHAR) AS value FROM v_track")
oracle("dim_scan", "SELECT vehicle_id, terminal_id, car_card_number, dept_id FROM v_vehicle")
oracle("partition_scan", "SELECT event_id, vehicle_id, round(speed, 6) AS speed, '2024-01' AS month_id, '14' AS day_id FROM v_track WHERE CAST(ts AS DATE) = DATE '2024-01-14'")
oracle("bus_docs", "SELECT event_id, vehicle_id, t_sec, speed, audit_state FROM v_track")
oracle("bus_partitioned", "SELECT strftime(ts, '%Y-%m') AS month_id, CAST(day(ts) AS VARCHAR) AS day_id, CAST(hour(ts) AS VARCHAR) AS hour_id, count(*) AS positions FROM v_track GROUP BY 1, 2, 3")

# ---- frames
GOOD = "SELECT * FROM v_frame_body WHERE event_id % 40 NOT IN (1, 2, 3, 4, 5)"
oracle(
    "decode_frames",
    f"""SELECT event_id, CASE WHEN user_id = 0 THEN '00000000000' ELSE lpad(CAST(user_id AS VARCHAR), 11, '0') END AS devid,
 CASE WHEN event_id % 31 <> 0 THEN {STAMP.format('t_sec')} END AS time, round(lat6 / 1e6, 6) AS lat, round(lng6 / 1e6, 6) AS lng,
 concat(CAST(lat6 / 1e6 AS VARCHAR), ',', CAST(lng6 / 1e6 AS VARCHAR)) AS point, speed10 / 10 AS speed, CAST(direction AS INT) AS pos,
 CAST((state_word >> 1) & 1 AS INT) AS gpsflag, CAST(state_word & 1 AS INT) AS accflag, 0 AS auxiliaryflag, 66 AS altitude,
 format('{{:.2f}}', mileage10 / 10) AS gpsdistance, CASE WHEN event_id % 3 = 0 THEN CAST(fuel10 / 10 AS VARCHAR) END AS mainoilper,
 CAST((alarm_word >> 15) & 1 AS INT) AS sharpturn, CAST((alarm_word >> 17) & 1 AS INT) AS brake FROM good""",
    {"good": GOOD},
)
oracle(
    "frame_header",
    """SELECT event_id, 512 AS msg_id, CAST(length(body) // 2 AS INT) AS body_length, 0 AS encryption, event_id % 40 = 6 AS has_sub_package, 0 AS reserved,
 lpad(CAST(user_id AS VARCHAR), 11, '0') AS terminal_phone, CAST(event_id % 65536 AS INT) AS flow_id, CASE WHEN event_id % 40 = 6 THEN 3 END AS sub_package_total, CASE WHEN event_id % 40 = 6 THEN CAST(event_id % 3 + 1 AS INT) END AS sub_package_seq FROM v_frame_body WHERE event_id % 40 NOT IN (1, 2, 4, 5)""",
)
oracle(
    "frame_checksum",
    """SELECT event_id, CAST(CASE WHEN event_id % 23 = 0 THEN 90 ELSE x END AS INT) AS checksum, event_id % 23 <> 0 OR x = 90 AS checksum_ok FROM
 (SELECT event_id, list_reduce(list_transform(range(0, length(whole) // 2 - 1), lambda i: CAST(concat('0x', substr(whole, 2 * i + 1, 2)) AS INT)), lambda a, b: xor(a, b)) AS x
 FROM (SELECT event_id, frame AS whole FROM v_frame WHERE event_id % 40 NOT IN (1, 2, 3, 4, 5)) f) g""",
)
_STATE = {"acc": 0, "located": 1, "south": 2, "west": 3, "not_operating": 4, "encrypted": 5, "oil_cut": 10, "circuit_cut": 11, "door_locked": 12}
_ALARM = {
    "emergency": 0, "overspeed": 1, "fatigue": 2, "early_warning": 3, "gnss_fault": 4, "gnss_antenna": 5, "gnss_short": 6,
    "undervoltage": 7, "power_down": 8, "lcd_fault": 9, "tts_fault": 10, "camera_fault": 11, "sharp_turn": 15, "hard_brake": 17,
    "driving_timeout": 18, "parking_timeout": 19, "area_in_out": 20, "route_in_out": 21, "travel_time": 22, "route_deviation": 23,
    "vss_fault": 24, "oil_fault": 25, "stolen": 26, "illegal_ignition": 28, "illegal_move": 29,
}
oracle("frame_state_bits", "SELECT event_id, " + ", ".join(f"CAST((state_word >> {b}) & 1 AS INT) AS {n}" for n, b in _STATE.items()) + " FROM good", {"good": GOOD})
oracle("frame_alarm_bits", "SELECT event_id, " + ", ".join(f"CAST((alarm_word >> {b}) & 1 AS INT) AS {n}" for n, b in _ALARM.items()) + " FROM good", {"good": GOOD})
oracle(
    "frame_tlv",
    """SELECT event_id, 1 AS item_id, lpad(lower(to_hex(mileage10)), 8, '0') AS payload FROM good
 UNION ALL SELECT event_id, 2, lpad(lower(to_hex(fuel10)), 4, '0') FROM good WHERE event_id % 3 = 0
 UNION ALL SELECT event_id, 49, '19' FROM good WHERE event_id % 5 = 1""",
    {"good": GOOD},
)
oracle("decode_rejects", "SELECT event_id, CASE event_id % 40 WHEN 1 THEN 'not_hex' WHEN 2 THEN 'not_hex' WHEN 3 THEN 'short_frame' ELSE 'empty' END AS reject_reason FROM v_frame_body WHERE event_id % 40 IN (1, 2, 3, 4, 5)")

# ---- cleaning
oracle("admitted_tracks", "SELECT event_id, vehicle_id, dept_id, t_sec, speed FROM a", {"a": ADMITTED})
PLAUSIBLE = "SELECT * FROM v_track WHERE lat > 20 AND lat < 40 AND lng > 100 AND lng < 120 AND speed >= 0 AND speed < 100"
oracle("plausible_tracks", "SELECT event_id, round(lat, 6) AS lat, round(lng, 6) AS lng, round(speed, 6) AS speed FROM p", {"p": PLAUSIBLE})
oracle("today_tracks", "SELECT event_id, vehicle_id, t_sec FROM v_track WHERE CAST(ts AS DATE) = DATE '2024-01-15'")
_PI = "3.14159265358979324"
_RIPPLE = f"(20.0 * sin(6.0 * x * {_PI}) + 20.0 * sin(2.0 * x * {_PI})) * 2.0 / 3.0"
oracle(
    "tracks_bd09",
    f"""SELECT event_id, round(z * sin(th) + 0.006, 6) AS lat, round(z * cos(th) + 0.0065, 6) AS lng FROM (
 SELECT event_id, sqrt(gx * gx + gy * gy) + 0.00002 * sin(gy * {_PI} * 3000.0 / 180.0) AS z, atan2(gy, gx) + 0.000003 * cos(gx * {_PI} * 3000.0 / 180.0) AS th FROM (
 SELECT event_id, lat + dlat * 180.0 / ((6378245.0 * (1 - 0.00669342162296594323)) / (m * sqrt(m)) * {_PI}) AS gy, lng + dlng * 180.0 / (6378245.0 / sqrt(m) * cos(lat / 180.0 * {_PI}) * {_PI}) AS gx FROM (
 SELECT event_id, lat, lng, 1 - 0.00669342162296594323 * power(sin(lat / 180.0 * {_PI}), 2) AS m,
  -100.0 + 2.0 * x + 3.0 * y + 0.2 * y * y + 0.1 * x * y + 0.2 * sqrt(abs(x)) + {_RIPPLE} + (20.0 * sin(y * {_PI}) + 40.0 * sin(y / 3.0 * {_PI})) * 2.0 / 3.0 + (160.0 * sin(y / 12.0 * {_PI}) + 320 * sin(y * {_PI} / 30.0)) * 2.0 / 3.0 AS dlat,
  300.0 + x + 2.0 * y + 0.1 * x * x + 0.1 * x * y + 0.1 * sqrt(abs(x)) + {_RIPPLE} + (20.0 * sin(x * {_PI}) + 40.0 * sin(x / 3.0 * {_PI})) * 2.0 / 3.0 + (150.0 * sin(x / 12.0 * {_PI}) + 300.0 * sin(x / 30.0 * {_PI})) * 2.0 / 3.0 AS dlng
 FROM (SELECT *, lng - 105.0 AS x, lat - 35.0 AS y FROM p) a) b) c) d""",
    {"p": PLAUSIBLE},
)
oracle(
    "tracks_bd2gcj",
    f"""SELECT event_id, round(z * sin(th), 6) AS lat, round(z * cos(th), 6) AS lng FROM (
 SELECT event_id, sqrt(x * x + y * y) - 0.00002 * sin(y * {_PI} * 3000.0 / 180.0) AS z, atan2(y, x) - 0.000003 * cos(x * {_PI} * 3000.0 / 180.0) AS th
 FROM (SELECT event_id, lng - 0.0065 AS x, lat - 0.006 AS y FROM v_track) a) b""",
)
oracle("partition_cols", "SELECT event_id, strftime(ts, '%Y-%m') AS month_id, CAST(day(ts) AS VARCHAR) AS day_id, CAST(hour(ts) AS VARCHAR) AS hour_id FROM v_track")
LOAD = "CASE WHEN vehicle_model_id IN ('0', '16') THEN 19.32 WHEN vehicle_model_id = '17' THEN 14.90 ELSE 0.0 END"
oracle("trip_load", f"SELECT vehicle_id, CAST({LOAD} AS DOUBLE) AS load FROM v_vehicle")

# ---- lookups
oracle("dim_dedup", "SELECT vehicle_id, version, car_card_number, enterprise_id FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY version DESC) AS rn FROM v_vehicle_history) h WHERE rn = 1")
oracle("join_vehicle_by_terminal", "SELECT event_id, devid, v.vehicle_id, car_card_number, vehicle_model_id, driver_id, enterprise_id, dept_id, round(speed, 6) AS speed FROM v_raw_track r JOIN v_vehicle v ON r.devid = v.terminal_id")
oracle("join_vehicle_by_plate", "SELECT event_id, terminal_id AS devid, v.vehicle_id, car_card_number, enterprise_id, dept_id, round(speed, 6) AS speed FROM v_raw_track r JOIN v_vehicle v ON r.plate = v.car_card_number")
RAW = "SELECT r.event_id, r.t_sec, r.speed, r.lat, r.lng, v.* FROM v_raw_track r JOIN v_vehicle v ON r.devid = v.terminal_id WHERE r.lat > 20 AND r.lat < 40 AND r.lng > 100 AND r.lng < 120 AND r.speed >= 0 AND r.speed < 100"
oracle("semi_service_fee", "SELECT event_id, dept_id, vehicle_id, 1 AS service_state FROM v_track t WHERE EXISTS (SELECT 1 FROM v_service_fee s WHERE s.state = 0 AND s.dept_id = t.dept_id AND s.vehicle_id = t.vehicle_id)")
oracle("join_driver", "SELECT event_id, b.dept_id, vehicle_id, b.driver_id, driver_card_number, driver_name FROM b LEFT JOIN v_driver d ON d.dept_id = b.dept_id AND d.driver_id = b.driver_id", {"b": RAW})
oracle("join_enterprise", "SELECT event_id, b.dept_id, vehicle_id, b.enterprise_id, enterprise_name, province_id FROM b JOIN v_enterprise d ON d.dept_id = b.dept_id AND d.enterprise_id = b.enterprise_id", {"b": RAW})
CARDS = "SELECT dept_id, vehicle_id, string_agg(coords, '|' ORDER BY card_id) AS coords FROM v_register_card WHERE state = 0 GROUP BY 1, 2"
oracle("join_register_card", "SELECT event_id, t.dept_id, t.vehicle_id, CASE WHEN c.vehicle_id IS NULL THEN 0 ELSE 1 END AS register_card_state, coords FROM v_track t LEFT JOIN cards c ON c.dept_id = t.dept_id AND c.vehicle_id = t.vehicle_id", {"cards": CARDS})
oracle("join_transport_card", "SELECT event_id, t.dept_id, t.vehicle_id, CASE WHEN c.vehicle_id IS NULL THEN 0 ELSE 1 END AS transport_card_state FROM v_track t LEFT JOIN v_transport_card c ON c.state = 1 AND c.dept_id = t.dept_id AND c.vehicle_id = t.vehicle_id")


def _inside(points: str, polygons: str, edges: str) -> str:
    """(event_id, id) pairs of points inside polygons, by counting crossed edges."""
    return (
        f"SELECT p.event_id, e.id FROM {points} p JOIN {edges} e ON e.dept_id = p.dept_id"
        " AND (e.x > p.lng) <> (e.px > p.lng) AND p.lat < (e.py - e.y) * (p.lng - e.x) / (e.px - e.x) + e.y"
        " GROUP BY 1, 2 HAVING count(*) % 2 = 1"
    )


def _edges(source: str, ident: str, vertices: str, pair_sep: str) -> str:
    return (
        f"SELECT id, dept_id, x, y, lag(x) OVER w AS px0, lag(y) OVER w AS py0, last_value(x) OVER f AS lx, last_value(y) OVER f AS ly FROM ("
        f"SELECT {ident} AS id, dept_id, i, CAST(split_part(v, '{pair_sep}', 1) AS DOUBLE) AS x, CAST(split_part(v, '{pair_sep}', 2) AS DOUBLE) AS y FROM ("
        f"SELECT {ident}, dept_id, unnest({vertices}) AS v, generate_subscripts({vertices}, 1) AS i FROM {source}) a) b"
        " WINDOW w AS (PARTITION BY id ORDER BY i), f AS (PARTITION BY id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    )


def _closed(raw: str) -> str:
    return f"SELECT id, dept_id, x, y, coalesce(px0, lx) AS px, coalesce(py0, ly) AS py FROM ({raw}) r"


AREA_EDGES = _closed(_edges("(SELECT * FROM v_area WHERE state = 1) s", "id", "list_filter(string_split(coords, ';'), lambda v: v <> '')", ","))
FENCE_EDGES = _closed(_edges("v_fence_rule", "condition_id", "string_split(replace(replace(coords, '[[', ''), ']]', ''), '],[')", ","))
REGION = {
    "area_edges": AREA_EDGES,
    "region": "SELECT event_id, min(id) AS id FROM (" + _inside("pts", "v_area", "area_edges") + ") h GROUP BY 1",
}
oracle(
    "join_region",
    "SELECT p.event_id, a.id AS region_id, a.city_name AS region_name FROM pts p LEFT JOIN region r ON r.event_id = p.event_id LEFT JOIN v_area a ON a.id = r.id",
    {"pts": ADMITTED, **REGION},
)
oracle(
    "data_bus",
    """SELECT p.event_id, p.vehicle_id, p.dept_id, driver_name, e.enterprise_name, CASE WHEN c.vehicle_id IS NULL THEN 0 ELSE 1 END AS register_card_state,
 CASE WHEN t.vehicle_id IS NULL THEN 0 ELSE 1 END AS transport_card_state, 1 AS service_state, a.id AS region_id, a.city_name AS region_name, round(p.speed, 6) AS speed
 FROM pts p JOIN v_service_fee f ON f.state = 0 AND f.dept_id = p.dept_id AND f.vehicle_id = p.vehicle_id
 LEFT JOIN v_driver d ON d.dept_id = p.dept_id AND d.driver_id = p.driver_id
 JOIN v_enterprise e ON e.dept_id = p.dept_id AND e.enterprise_id = p.enterprise_id
 LEFT JOIN cards c ON c.dept_id = p.dept_id AND c.vehicle_id = p.vehicle_id
 LEFT JOIN v_transport_card t ON t.state = 1 AND t.dept_id = p.dept_id AND t.vehicle_id = p.vehicle_id
 LEFT JOIN region r ON r.event_id = p.event_id LEFT JOIN v_area a ON a.id = r.id""",
    {"pts": RAW, "cards": CARDS, **REGION},
)
oracle("all_sites", "SELECT site_id, site_name, dept_id, round(lng, 6) AS lng, round(lat, 6) AS lat, site_flag, audit_state, province_id, city_id, area_id FROM v_site WHERE is_delete = 0")
NEAR = (
    "SELECT p.event_id, s.site_id, s.site_flag, s.audit_state FROM {pts} p JOIN v_site s ON s.dept_id = p.dept_id AND s.is_delete = 0 AND "
    + dist("p.lng", "p.lat", "s.lng", "s.lat") + " {cmp}"
)
SITED = {
    "pts": ADMITTED,
    "first_site": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY site_flag, site_id) AS k FROM (" + NEAR.format(pts="pts", cmp="<= 500") + ") n) m WHERE k = 1",
}
oracle(
    "join_site_500m",
    "SELECT p.event_id, s.site_id, s.site_name, s.site_flag, round(s.lng, 6) AS site_lng, round(s.lat, 6) AS site_lat FROM pts p LEFT JOIN first_site f ON f.event_id = p.event_id LEFT JOIN v_site s ON s.site_id = f.site_id",
    SITED,
)
oracle("fence_rules", """SELECT condition_id, t.dept_id, fence_flag, speed, start_date, end_date, name, coords, area_id FROM (
 SELECT condition_id, dept_id, 1 AS fence_flag, speed, NULL AS start_date, NULL AS end_date FROM v_rule_speed WHERE state = 0
 UNION ALL SELECT condition_id, dept_id, 2, NULL, NULL, NULL FROM v_rule_penalty WHERE state = 0
 UNION ALL SELECT condition_id, dept_id, 3, NULL, start_date, end_date FROM v_rule_work_time WHERE state = 0
 UNION ALL SELECT condition_id, dept_id, 4, NULL, NULL, NULL FROM v_rule_out WHERE state = 0
 UNION ALL SELECT condition_id, dept_id, 5, NULL, start_date, end_date FROM v_rule_document WHERE state = 0) t JOIN v_boundary b ON b.id = t.condition_id""")
FENCED = {
    "pts": ADMITTED,
    "fence_edges": FENCE_EDGES,
    "hits": _inside("pts", "v_fence_rule", "fence_edges"),
    "broken": f"""SELECT p.*, r.fence_flag, r.condition_id AS fence_id, r.name AS fence_name, r.area_id AS fence_area_id,
 CASE r.fence_flag WHEN 1 THEN '0110' WHEN 2 THEN '0115' WHEN 3 THEN '0116' WHEN 4 THEN '0114' ELSE '0119' END AS illegal_type_code
 FROM hits h JOIN pts p ON p.event_id = h.event_id JOIN v_fence_rule r ON r.condition_id = h.id
 WHERE CASE r.fence_flag WHEN 1 THEN p.speed > r.speed WHEN 2 THEN p.speed > 0 WHEN 4 THEN p.speed > 0
 WHEN 3 THEN NOT ({CLOCK} > 21600 AND {CLOCK} < 81000)
 ELSE t_sec // 60 BETWEEN epoch(TIMESTAMP '2024-01-10 00:00:00') // 60 AND epoch(TIMESTAMP '2024-01-20 12:00:00') // 60 END""",
}
oracle(
    "fence_violations",
    "SELECT p.event_id, b.fence_flag, b.fence_id, b.fence_name, b.fence_area_id, b.illegal_type_code FROM pts p LEFT JOIN broken b ON b.event_id = p.event_id",
    FENCED,
)
ALLOWED = "SELECT DISTINCT c.vehicle_id, c.disposal_site_id, s.site_name AS disposal_site_name, s.lng, s.lat FROM v_register_card c JOIN v_site s ON s.site_id = c.disposal_site_id WHERE c.state = 0 AND s.site_flag = 2 AND s.is_delete = 0 AND s.audit_state = '1'"
oracle("allowed_disposal_sites", "SELECT vehicle_id, disposal_site_id, disposal_site_name, round(lng, 6) AS lng, round(lat, 6) AS lat FROM allowed", {"allowed": ALLOWED})
oracle(
    "track_allowed_sites",
    "SELECT a.event_id, a.vehicle_id, s.sites FROM a LEFT JOIN (SELECT vehicle_id, string_agg(CAST(disposal_site_id AS VARCHAR), ',' ORDER BY disposal_site_id) AS sites FROM allowed GROUP BY 1) s ON s.vehicle_id = a.vehicle_id",
    {"a": ADMITTED, "allowed": ALLOWED},
)
oracle("inout_pairs", "SELECT n.event_id, p.vehicle_id, n.site_id FROM (" + NEAR.format(pts="pts", cmp="< 500") + ") n JOIN pts p ON p.event_id = n.event_id WHERE n.site_flag = 2 AND n.audit_state = '1'", {"pts": ADMITTED})

# ---- tonnage
_M = ["build_sum", "build_count", "disposal_sum", "disposal_count"]


def _site_sql(flags: str, p: str, own: str, other: str) -> str:
    return (
        f"SELECT {p}_site_province_id AS area_id1, {p}_site_city_id AS area_id2, {p}_site_area_id AS area_id3, CAST({p}_site_id AS VARCHAR) AS site_id,"
        f" {p}_site_name AS site_name, dept_id, sum(load) AS {own}_sum, count(load) AS {own}_count, sum(load) * 0 AS {other}_sum, CAST(0 AS BIGINT) AS {other}_count"
        f" FROM v_trip WHERE s_site_flag IN ({flags}) GROUP BY ALL"
    )


DAILY = {
    "build": _site_sql("1, 3", "s", "build", "disposal"),
    "disposal": _site_sql("2, 4", "e", "disposal", "build"),
    "daily": "SELECT * FROM build UNION ALL BY NAME SELECT * FROM disposal",
}
_MR = ", ".join(f"round({m}, 4) AS {m}" if m.endswith("sum") else m for m in _M)
_MS = ", ".join(f"CAST(sum({m}) AS {'DOUBLE' if m.endswith('sum') else 'BIGINT'}) AS {m}" for m in _M)
_SITE = "area_id1, area_id2, area_id3, site_id, site_name, dept_id"
oracle("build_stats", f"SELECT {_SITE}, {_MR} FROM build", {"build": DAILY["build"]})
oracle("disposal_stats", f"SELECT {_SITE}, {_MR} FROM disposal", {"disposal": DAILY["disposal"]})
oracle("build_disposal_daily", f"SELECT {_SITE}, {_MR} FROM daily", DAILY)
AREAS = {
    **DAILY,
    "areas": " UNION ALL ".join(
        f"SELECT {i} AS level, area_id{i} AS site_id, dept_id, {_MS} FROM daily WHERE area_id{i} IS NOT NULL AND area_id{i} <> '' GROUP BY 1, 2, 3" for i in (1, 2, 3)
    ),
    "named": "SELECT a.level, a.site_id, n.area_name AS site_name, a.dept_id, build_sum, build_count, disposal_sum, disposal_count FROM areas a LEFT JOIN v_area_name n ON n.id = a.site_id",
    "sites": f"SELECT site_id, site_name, dept_id, {_MS} FROM daily GROUP BY 1, 2, 3",
}
oracle("area_rollup", f"SELECT level, site_id, site_name, dept_id, {_MR} FROM named", AREAS)
oracle("site_totals", f"SELECT site_id, site_name, dept_id, {_MR} FROM sites", AREAS)
oracle(
    "cumulative_amount",
    f"SELECT site_id, site_name, dept_id, {_MR} FROM (SELECT site_id, site_name, dept_id, {_MS} FROM (SELECT * EXCLUDE (level) FROM named UNION ALL BY NAME SELECT * FROM sites UNION ALL BY NAME SELECT * FROM v_amount) u GROUP BY 1, 2, 3) t",
    AREAS,
)
oracle(
    "overwrite_partition",
    """SELECT '2024-01' AS month_id, '14' AS day_id, count(*) AS site_rows, round(sum(build_sum), 4) AS build_sum, round(sum(disposal_sum), 4) AS disposal_sum FROM daily
 UNION ALL SELECT '2024-01', '15', count(*), round(sum(build_sum), 4), round(sum(disposal_sum), 4) FROM daily WHERE build_count > 0""",
    DAILY,
)

# ---- violations
DETAIL = {"d": "SELECT *, enterprise_id AS transport_enterprise_id, illegal_type_short_desc AS illegal_name FROM v_illegal"}
oracle(
    "scoring_detail",
    "SELECT vehicle_id, car_card_number, enterprise_name, illegal_id, illegal_name, round(enterprise_final_score, 4) AS enterprise_final_score, round(vehicle_driver_final_score, 4) AS vehicle_driver_final_score, transport_enterprise_id, province_id, city_id, area_id, dept_id, strftime(create_time, '%Y-%m-%d %H:%M:%S') AS illegal_date FROM d",
    DETAIL,
)
_REG = "dept_id, province_id, city_id, area_id"
_ENT, _VEH, _TYP = "transport_enterprise_id, enterprise_name", "vehicle_id, car_card_number", "illegal_id, illegal_name"
_DV = "count(DISTINCT vehicle_id) AS illegal_vehicle_count"


def _rank(keys: str, distinct: bool, score: str) -> str:
    names = ", ".join([_REG, keys]) if keys else _REG
    extra = f"{_DV}, " if distinct else ""
    return f"SELECT {names}, {extra}count(*) AS illegal_count, round(sum({score}), 4) AS illegal_sum FROM d GROUP BY {names}"


VS, ES = "vehicle_driver_final_score", "enterprise_final_score"
_RANKS = {
    "rank_by_type": (_TYP, True, VS), "rank_by_enterprise": (_ENT, True, ES), "rank_by_enterprise_type": (f"{_ENT}, {_TYP}", False, ES),
    "rank_by_vehicle": (_VEH, False, VS), "rank_by_vehicle_type": (f"{_VEH}, {_TYP}", True, VS), "rank_total": ("", False, VS),
}
for _name, _args in _RANKS.items():
    oracle(_name, _rank(*_args), DETAIL)


def _pivot(keys: str, score: str) -> str:
    cols = {"alarm_speed": "0110", "alarm_out": "0108", "alarm_dump": "0121", "alarm_offline": "0107"}
    sums = {n: f"sum(CASE WHEN illegal_id = '{c}' THEN {score} ELSE 0 END)" for n, c in cols.items()}
    shown = ", ".join(f"round({s}, 4) AS {n}" for n, s in sums.items())
    return f"SELECT {keys}, {shown}, round({' + '.join(sums.values())}, 4) AS total_score FROM d GROUP BY {keys}"


oracle("score_pivot_region_vehicle", _pivot(_REG, VS), DETAIL)
oracle("score_pivot_vehicle", _pivot(f"{_REG}, {_VEH}, transport_enterprise_id", VS), DETAIL)
oracle("score_pivot_region_enterprise", _pivot(_REG, ES), DETAIL)
oracle("score_pivot_enterprise", _pivot(f"{_REG}, {_ENT}", ES), DETAIL)
_ALL = [c.strip() for c in f"{_REG}, {_ENT}, {_VEH}, {_TYP}".split(",")]
_LEVELS = {"type": (_TYP, VS), "enterprise": (_ENT, ES), "enterprise_type": (f"{_ENT}, {_TYP}", ES), "vehicle": (_VEH, VS), "vehicle_type": (f"{_VEH}, {_TYP}", VS), "total": ("", VS)}


def _level(name: str, keys: str, score: str) -> str:
    kept = [c.strip() for c in (f"{_REG}, {keys}" if keys else _REG).split(",")]
    cols = ", ".join(c if c in kept else f"NULL AS {c}" for c in _ALL)
    return f"SELECT '{name}' AS level, {cols}, {_DV}, count(*) AS illegal_count, round(sum({score}), 4) AS illegal_sum FROM d GROUP BY {', '.join(kept)}"


oracle("rank_grouping_sets", " UNION ALL ".join(_level(n, *a) for n, a in _LEVELS.items()), DETAIL)
oracle(
    "ranked_enterprises",
    f"SELECT * REPLACE (CAST(illegal_sum AS DOUBLE) AS illegal_sum), CAST(rank() OVER (PARTITION BY dept_id ORDER BY illegal_sum DESC NULLS LAST) AS INT) AS place FROM (SELECT {_REG}, {_ENT}, {_DV}, count(*) AS illegal_count, sum(CAST({ES} AS DECIMAL(18, 4))) AS illegal_sum FROM d GROUP BY {_REG}, {_ENT}) r",
    DETAIL,
)

# ---- functions
oracle("geo_distance", "SELECT event_id, round(" + dist("lng", "lat", "113.6", "34.7") + ", 4) AS metres FROM v_track")
oracle(
    "in_time_range",
    f"SELECT event_id, {CLOCK} > 21600 AND {CLOCK} < 81000 AS by_day, {CLOCK} < 21600 OR {CLOCK} > 79200 AS by_night FROM v_track",
)
oracle("in_effective_date", "SELECT event_id, CASE WHEN t_sec IS NOT NULL THEN date_trunc('minute', ts) END BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00' AS effective FROM v_track")
_SPENT = "(t_sec - CAST(epoch(TIMESTAMP '2024-01-15 12:00:00') AS BIGINT))"
oracle("elapsed", f"SELECT event_id, CAST(trunc({_SPENT} / 60) AS BIGINT) AS minutes, CAST(trunc({_SPENT} / 3600) AS BIGINT) AS hours FROM v_track")


def _interval(s: str, strict: bool) -> str:
    rest = f"{s} % 60" if strict else f"({s} // 60) % 60"
    return f"CASE WHEN {s} IS NULL THEN NULL WHEN {s} >= 3600 THEN concat({s} // 3600, '小时', {rest}, '分') ELSE concat({s} // 60, '分') END"


oracle("alarm_interval", f"SELECT event_id, {_interval('(t_sec % 20000)', False)} AS interval_time, {_interval('(t_sec % 20000)', True)} AS interval_strict FROM v_track")

# ---- alarms
ROUTED = {
    "cards": CARDS,
    "pts": "SELECT t.*, c.coords, CASE WHEN c.vehicle_id IS NULL THEN 0 ELSE 1 END AS has_card FROM (" + ADMITTED + ") t LEFT JOIN cards c ON c.dept_id = t.dept_id AND c.vehicle_id = t.vehicle_id",
    "vertices": """SELECT coords, CAST(split_part(v, ',', 1) AS DOUBLE) AS x, CAST(split_part(v, ',', 2) AS DOUBLE) AS y FROM (
 SELECT coords, unnest(regexp_extract_all(coords, '[0-9.]+,[0-9.]+')) AS v FROM (SELECT DISTINCT coords FROM cards) c) z""",
    "routed": "SELECT p.*, NOT EXISTS (SELECT 1 FROM vertices v WHERE v.coords = p.coords AND " + dist("p.lng", "p.lat", "v.x", "v.y") + " <= 500) AS off_route FROM pts p WHERE has_card = 1",
}
oracle("off_route_points", "SELECT event_id, vehicle_id, off_route FROM routed", ROUTED)


def _episodes(rows: str, bad: str, good: str) -> dict[str, str]:
    """Runs of bad rows numbered by the good rows before them, and the good row after each."""
    return {
        "marked": f"SELECT *, {bad} AS bad, count(*) FILTER (WHERE {good}) OVER (PARTITION BY {KEYS} ORDER BY t_sec, event_id ROWS UNBOUNDED PRECEDING) AS run FROM {rows} WHERE ({bad} OR {good}) AND {TIMED}",
        "closers": f"SELECT {KEYS}, run, t_sec, event_id, lng, lat FROM marked WHERE NOT bad",
    }


def _cands(code: str, openers: str, extra: str = "") -> str:
    more = "".join(f"o.{c}, " for c in extra.split())
    return (
        f"SELECT o.dept_id, o.vehicle_id, {code} AS illegal_type_code, {more}o.t_sec AS start_sec, o.event_id AS start_event_id, o.lng AS alarm_start_lng, o.lat AS alarm_start_lat,"
        " c.t_sec AS end_sec, c.lng AS alarm_end_lng, c.lat AS alarm_end_lat"
        f" FROM {openers} o JOIN closers c ON c.dept_id = o.dept_id AND c.vehicle_id = o.vehicle_id AND c.run = o.run + 1 WHERE (c.t_sec - o.t_sec) // 60 > 3"
    )


FIRST_BAD = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {KEYS}, run ORDER BY t_sec, event_id) AS k FROM marked WHERE bad) m WHERE k = 1"
# Alarm by alarm: keep it if none was kept yet, or the last kept one is far enough away.
THIN = {
    "numbered": f"SELECT *, row_number() OVER (PARTITION BY {KEYS}, illegal_type_code ORDER BY start_sec, start_event_id) AS rn FROM cand",
    "walk": f"""SELECT {KEYS}, illegal_type_code, rn, start_sec AS last_kept, true AS kept FROM numbered WHERE rn = 1
 UNION ALL SELECT n.dept_id, n.vehicle_id, n.illegal_type_code, n.rn, CASE WHEN ok THEN n.start_sec ELSE last_kept END, ok FROM (
  SELECT n.dept_id, n.vehicle_id, n.illegal_type_code, n.rn, n.start_sec, w.last_kept,
   CASE WHEN n.illegal_type_code = '0119' THEN n.start_sec // 86400 <> w.last_kept // 86400 ELSE (n.start_sec - w.last_kept) // 3600 >= 2 END AS ok
  FROM walk w JOIN numbered n ON n.dept_id = w.dept_id AND n.vehicle_id = w.vehicle_id AND n.illegal_type_code = w.illegal_type_code AND n.rn = w.rn + 1) n""",
    "thinned": "SELECT n.* EXCLUDE (rn) FROM numbered n JOIN walk w ON n.dept_id = w.dept_id AND n.vehicle_id = w.vehicle_id AND n.illegal_type_code = w.illegal_type_code AND n.rn = w.rn WHERE w.kept",
}
_POINTS = "round(alarm_start_lng, 6) AS alarm_start_lng, round(alarm_start_lat, 6) AS alarm_start_lat, end_sec, round(alarm_end_lng, 6) AS alarm_end_lng, round(alarm_end_lat, 6) AS alarm_end_lat"
_ALARM_ROW = f"SELECT {KEYS}, illegal_type_code, start_sec, start_event_id, {_POINTS} FROM thinned"
GPS = {
    "pts": CLEANED, **_episodes("pts", "speed = 0", "speed > 0"), "openers": FIRST_BAD,
    "cand": "SELECT * FROM (" + _cands("'0118'", "openers") + ") c WHERE " + dist("alarm_end_lng", "alarm_end_lat", "alarm_start_lng", "alarm_start_lat") + " > 2000",
    **THIN,
}
oracle("gps_incomplete_alarms", _ALARM_ROW, GPS, recursive=True)
OFF = {**ROUTED, "cleaned": f"SELECT * FROM routed WHERE {BOX}", **_episodes("cleaned", "off_route", "NOT off_route"), "openers": FIRST_BAD, "cand": _cands("'0112'", "openers"), **THIN}
oracle("off_route_alarms", _ALARM_ROW, OFF, recursive=True)
FENCE_ALARMS = {
    **FENCED, "pts": CLEANED,
    "plain": "SELECT * FROM pts p WHERE NOT EXISTS (SELECT 1 FROM broken b WHERE b.event_id = p.event_id)",
    "rows_": f"SELECT {KEYS}, t_sec, event_id, lng, lat, fence_flag, fence_id, fence_name, fence_area_id, illegal_type_code FROM broken UNION ALL SELECT {KEYS}, t_sec, event_id, lng, lat, NULL, NULL, NULL, NULL, NULL FROM plain",
    **_episodes("rows_", "illegal_type_code IS NOT NULL", "illegal_type_code IS NULL"),
    "openers": f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {KEYS}, run, illegal_type_code ORDER BY t_sec, event_id, fence_id) AS k FROM marked WHERE bad) m WHERE k = 1",
    "cand": _cands("o.illegal_type_code", "openers", "fence_flag fence_id fence_name fence_area_id"),
    **THIN,
}
oracle("fence_alarms", f"SELECT {KEYS}, illegal_type_code, fence_flag, fence_id, fence_name, fence_area_id, start_sec, start_event_id, {_POINTS} FROM thinned", FENCE_ALARMS, recursive=True)
oracle(
    "no_register_alarms",
    f"SELECT {KEYS}, '0111' AS illegal_type_code, t_sec AS start_sec, event_id AS start_event_id, round(lng, 6) AS alarm_start_lng, round(lat, 6) AS alarm_start_lat FROM (SELECT *, row_number() OVER (PARTITION BY {KEYS}, t_sec // 86400 ORDER BY t_sec, event_id) AS k FROM a WHERE register_card_state = 0 AND {TIMED}) r WHERE k = 1",
    {"a": ADMITTED},
)
oracle(
    "alarm_thinning",
    f"SELECT {KEYS}, illegal_type_code, start_sec, start_event_id FROM thinned",
    {"a": ADMITTED, "cand": f"SELECT {KEYS}, CASE WHEN event_id % 3 = 0 THEN '0119' ELSE '0110' END AS illegal_type_code, t_sec AS start_sec, event_id AS start_event_id FROM a WHERE {TIMED}", **THIN},
    recursive=True,
)
oracle(
    "alarm_scores",
    "SELECT t.event_id, t.dept_id, t.illegal_type_code, illegal_type_short_desc, enterprise_score, vehicle_score, driver_score FROM (SELECT event_id, dept_id, CASE WHEN event_id % 2 = 0 THEN '0118' ELSE '0115' END AS illegal_type_code FROM v_track) t LEFT JOIN v_score s ON s.dept_id = t.dept_id AND s.illegal_type_code = t.illegal_type_code",
)
oracle(
    "alarm_enriched",
    "SELECT t.dept_id, t.vehicle_id, t.illegal_type_code, start_sec, end_sec, " + _interval("(end_sec - start_sec)", False) + " AS interval_time, round("
    + dist("alarm_start_lng", "alarm_start_lat", "alarm_end_lng", "alarm_end_lat") + """, 4) AS interval_distance, illegal_type_short_desc, enterprise_score, vehicle_score, driver_score, 2024 AS scoring_year,
 sha256(concat_ws('|', t.dept_id, t.vehicle_id, t.illegal_type_code, start_sec, start_event_id)) AS uuid, '2024-01' AS month_id, '31' AS day_id, '7' AS hour_id
 FROM thinned t LEFT JOIN v_score s ON s.dept_id = t.dept_id AND s.illegal_type_code = t.illegal_type_code""",
    GPS, recursive=True,
)
oracle(
    "illegal_disposal",
    f"SELECT {KEYS}, illegal_type_code, site_id, start_sec, start_event_id, round(alarm_start_lng, 6) AS alarm_start_lng, round(alarm_start_lat, 6) AS alarm_start_lat FROM thinned",
    {
        "pts": f"{CLEANED} AND {TIMED}", "allowed": ALLOWED,
        "cand": "SELECT p.dept_id, p.vehicle_id, '0123' AS illegal_type_code, p.t_sec AS start_sec, p.event_id AS start_event_id, p.lng AS alarm_start_lng, p.lat AS alarm_start_lat, min(n.site_id) AS site_id FROM ("
        + NEAR.format(pts="pts", cmp="< 500") + ") n JOIN pts p ON p.event_id = n.event_id WHERE n.site_flag = 2 AND n.audit_state = '1' AND NOT EXISTS (SELECT 1 FROM allowed a WHERE a.vehicle_id = p.vehicle_id AND a.disposal_site_id = n.site_id) GROUP BY ALL",
        **THIN,
    },
    recursive=True,
)


# ---- movement
def _trip_walk(strict: bool) -> dict[str, str]:
    """Position by position: the open stay (row number, site, time, work, leave) and what it emits."""
    outside = (
        ("o.rn", "CAST(NULL AS BIGINT)", "o.t_sec", "CAST(NULL AS BIGINT)", "CAST(NULL AS BIGINT)")
        if strict else ("s_rn", "s_site", "s_t", "s_work", "coalesce(s_leave, o.t_sec)")
    )
    o_rn, o_site, o_t, o_work, o_leave = outside

    def nxt(opened: str, left: str, same: str, keep: str, none: str = "NULL") -> str:
        return f"CASE WHEN NOT open AND o.site_id IS NOT NULL THEN {opened} WHEN NOT open OR emit THEN {none} WHEN o.site_id IS NULL THEN {left} WHEN s_site = o.site_id AND o.t_sec - s_t < 360 THEN {same} ELSE {keep} END"

    return {
        **SITED, "pts": f"{CLEANED} AND {TIMED}",
        "ordered": f"SELECT p.*, f.site_id, row_number() OVER (PARTITION BY p.dept_id, p.vehicle_id ORDER BY p.t_sec, p.event_id) AS rn FROM pts p LEFT JOIN first_site f ON f.event_id = p.event_id",
        "steps": f"""SELECT {KEYS}, rn, site_id IS NOT NULL AS open, CASE WHEN site_id IS NOT NULL THEN rn END AS s_rn, site_id AS s_site, CASE WHEN site_id IS NOT NULL THEN t_sec END AS s_t,
  CAST(NULL AS BIGINT) AS s_work, CAST(NULL AS BIGINT) AS s_leave, false AS emit, CAST(NULL AS BIGINT) AS e_rn, CAST(NULL AS BIGINT) AS e_work, CAST(NULL AS BIGINT) AS e_leave FROM ordered WHERE rn = 1
 UNION ALL SELECT o.dept_id, o.vehicle_id, o.rn, {nxt('true', 'true', 'true', 'true', 'false')}, {nxt('o.rn', o_rn, 's_rn', 's_rn')}, {nxt('o.site_id', o_site, 's_site', 's_site')}, {nxt('o.t_sec', o_t, 's_t', 's_t')},
  {nxt('CAST(NULL AS BIGINT)', o_work, 'o.t_sec', 's_work')}, {nxt('CAST(NULL AS BIGINT)', o_leave, 's_leave', 's_leave')}, emit, CASE WHEN emit THEN s_rn END, CASE WHEN emit THEN s_work END, CASE WHEN emit THEN s_leave END
 FROM (SELECT s.open, s.s_rn, s.s_site, s.s_t, s.s_work, s.s_leave, o.*, s.open AND o.site_id IS NOT NULL AND (s.s_site IS NULL OR s.s_site <> o.site_id) AND (o.t_sec - s.s_t) // 60 > 5 AS emit
  FROM steps s JOIN ordered o ON o.dept_id = s.dept_id AND o.vehicle_id = s.vehicle_id AND o.rn = s.rn + 1) o""",
        "trip": f"""SELECT c.dept_id, c.vehicle_id, fs.site_id AS from_site_id, fs.site_name AS from_site_name, fs.site_flag AS from_site_flag, fs.lng AS from_site_lng, fs.lat AS from_site_lat, f.t_sec AS from_site_inter_sec, s.e_work AS from_site_work_sec, s.e_leave AS from_site_leave_sec,
  ts.site_id AS to_site_id, ts.site_name AS to_site_name, ts.site_flag AS to_site_flag, ts.lng AS to_site_lng, ts.lat AS to_site_lat, c.t_sec AS to_site_inter_sec, ts.province_id AS to_province, ts.city_id AS to_city, ts.area_id AS to_area, fs.province_id AS from_province, fs.city_id AS from_city, fs.area_id AS from_area,
  v.enterprise_id, v.car_card_number, e.enterprise_name, e.province_id, e.city_id, e.area_id, CAST({LOAD} AS DOUBLE) AS load, CASE WHEN fs.site_flag = 1 THEN 0 ELSE 1 END AS vehicle_empty
  FROM steps s JOIN ordered c ON c.dept_id = s.dept_id AND c.vehicle_id = s.vehicle_id AND c.rn = s.rn JOIN ordered f ON f.dept_id = s.dept_id AND f.vehicle_id = s.vehicle_id AND f.rn = s.e_rn
  JOIN v_site ts ON ts.site_id = c.site_id LEFT JOIN v_site fs ON fs.site_id = f.site_id LEFT JOIN v_vehicle v ON v.vehicle_id = c.vehicle_id AND v.dept_id = c.dept_id LEFT JOIN v_enterprise e ON e.dept_id = v.dept_id AND e.enterprise_id = v.enterprise_id WHERE s.emit""",
    }


_TRIP = "dept_id, vehicle_id, from_site_id, from_site_name, from_site_flag, from_site_inter_sec, from_site_work_sec, from_site_leave_sec, to_site_id, to_site_name, to_site_flag, to_site_inter_sec, load, vehicle_empty"
oracle("trips", f"SELECT {_TRIP} FROM trip", _trip_walk(False), recursive=True)
oracle("trips_strict", f"SELECT {_TRIP} FROM trip", _trip_walk(True), recursive=True)
oracle("valid_trips", f"SELECT {_TRIP} FROM trip WHERE from_site_lng IS NOT NULL AND from_site_lat IS NOT NULL AND to_site_lng IS NOT NULL AND to_site_lat IS NOT NULL", _trip_walk(True), recursive=True)
oracle("trips_partitioned", "SELECT '2024-01' AS month_id, '31' AS day_id, '7' AS hour_id, count(*) AS trips, round(sum(load), 4) AS tonnes FROM trip", _trip_walk(False), recursive=True)
_NULLS = (
    "device_id time gps_lng gps_lat speed pos gps_flag wire_flag power_flag acc_flag auxiliary_flag temperature door all_distance all_dist_fuel gps_distance gps_all_distance "
    "report_time zxcqi alarm_flag main_oil_per residual_oil vice_oil_per vice_residual_oil oil_difference sharp_turn brake e_site_address dev_id s_site_address"
).split()
oracle(
    "trips_table_row",
    "SELECT " + ", ".join(f"CAST(NULL AS VARCHAR) AS {n}" for n in _NULLS) + f""", {STAMP.format('to_site_inter_sec')} AS e_site_time, CAST(to_site_id AS VARCHAR) AS e_site_id, to_site_name AS e_site_name, round(to_site_lat, 6) AS e_site_lat, round(to_site_lng, 6) AS e_site_lng,
 coalesce(to_site_flag, -1) AS e_site_flag, 0 AS status, 0 AS dev_status, CAST(from_site_id AS VARCHAR) AS s_site_id, from_site_name AS s_site_name, coalesce(from_site_flag, -1) AS s_site_flag, round(from_site_lng, 6) AS s_site_lng, round(from_site_lat, 6) AS s_site_lat,
 {STAMP.format('from_site_inter_sec')} AS s_site_time, '2024-01-31 07:05:09' AS updatetime, dept_id, vehicle_id, round(load, 6) AS load, vehicle_empty, '2024-01' AS month_id, '31' AS day_id, '7' AS hour_id,
 to_province AS e_site_province_id, to_city AS e_site_city_id, to_area AS e_site_area_id, from_province AS s_site_province_id, from_city AS s_site_city_id, from_area AS s_site_area_id,
 CAST(enterprise_id AS VARCHAR) AS transport_enterprise_id, car_card_number, enterprise_name, province_id, city_id, area_id FROM trip""",
    _trip_walk(False), recursive=True,
)
ONLINE = {
    "a": f"{ADMITTED} AND {TIMED}",
    "ordered": f"SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY t_sec, event_id) AS rn FROM a",
    "steps": f"""SELECT {KEYS}, rn, t_sec AS last_t, CAST(0 AS BIGINT) AS total, CAST(0 AS BIGINT) AS shown FROM ordered WHERE rn = 1
 UNION ALL SELECT dept_id, vehicle_id, rn, CASE WHEN gap > 0 THEN t_sec ELSE last_t END, CASE WHEN gap <= 0 THEN total WHEN total + gap > t_sec % 86400 THEN 0 ELSE total + gap END,
  CASE WHEN gap <= 0 THEN 0 WHEN total + gap > t_sec % 86400 THEN 0 ELSE total + gap END
 FROM (SELECT o.dept_id, o.vehicle_id, o.rn, o.t_sec, s.last_t, s.total, o.t_sec - s.last_t AS gap FROM steps s JOIN ordered o ON o.dept_id = s.dept_id AND o.vehicle_id = s.vehicle_id AND o.rn = s.rn + 1) x""",
}
oracle("vehicle_online_time", "SELECT o.event_id, o.vehicle_id, o.t_sec, s.shown AS online_time, 0 AS vehicle_status, CASE WHEN o.speed > 0 THEN 1 ELSE 0 END AS online_status FROM ordered o JOIN steps s ON s.dept_id = o.dept_id AND s.vehicle_id = o.vehicle_id AND s.rn = o.rn", ONLINE, recursive=True)
oracle(
    "vehicle_current_state",
    """SELECT v.dept_id, v.vehicle_id, v.car_card_number, l.t_sec, round(l.lng, 6) AS lng, round(l.lat, 6) AS lat, round(l.speed, 6) AS speed, l.total AS online_time, CASE WHEN l.vehicle_id IS NOT NULL THEN 0 END AS vehicle_status,
 CASE WHEN l.speed > 0 THEN 1 WHEN l.vehicle_id IS NOT NULL THEN 0 END AS online_status FROM v_vehicle v LEFT JOIN
 (SELECT o.*, s.total, row_number() OVER (PARTITION BY o.dept_id, o.vehicle_id ORDER BY o.rn DESC) AS k FROM ordered o JOIN steps s ON s.dept_id = o.dept_id AND s.vehicle_id = o.vehicle_id AND s.rn = o.rn) l ON l.k = 1 AND l.dept_id = v.dept_id AND l.vehicle_id = v.vehicle_id""",
    ONLINE, recursive=True,
)


def _stops(gap: int) -> dict[str, str]:
    return {
        "pts": f"{CLEANED} AND {TIMED}",
        "ordered": f"SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY t_sec, event_id) AS rn FROM pts",
        "steps": f"""SELECT {KEYS}, rn, CASE WHEN speed = 0 THEN rn END AS s_rn, CASE WHEN speed = 0 THEN t_sec END AS seen, CAST(NULL AS BIGINT) AS e_rn FROM ordered WHERE rn = 1
 UNION ALL SELECT dept_id, vehicle_id, rn, CASE WHEN speed > 0 THEN NULL WHEN s_rn IS NULL OR t_sec - seen > {gap} THEN rn ELSE s_rn END, CASE WHEN speed > 0 THEN NULL ELSE t_sec END,
  CASE WHEN speed > 0 AND t_sec - seen < {gap} THEN s_rn END
 FROM (SELECT o.dept_id, o.vehicle_id, o.rn, o.t_sec, o.speed, s.s_rn, s.seen FROM steps s JOIN ordered o ON o.dept_id = s.dept_id AND o.vehicle_id = s.vehicle_id AND o.rn = s.rn + 1) x""",
    }


_STOP = """SELECT c.dept_id, c.vehicle_id, b.t_sec AS stop_sec, round(b.lng, 6) AS stop_lng, round(b.lat, 6) AS stop_lat, c.t_sec AS start_sec, round(c.lng, 6) AS start_lng, round(c.lat, 6) AS start_lat
 FROM steps s JOIN ordered c ON c.dept_id = s.dept_id AND c.vehicle_id = s.vehicle_id AND c.rn = s.rn JOIN ordered b ON b.dept_id = s.dept_id AND b.vehicle_id = s.vehicle_id AND b.rn = s.e_rn WHERE s.e_rn IS NOT NULL"""
oracle("stop_episodes", _STOP, _stops(3600), recursive=True)
oracle("stop_episodes_three_minutes", _STOP, _stops(180), recursive=True)
# Position by position per (vehicle, site): enter, exit, side and whether the enter is confirmed.
DWELL = {
    "pts": f"{CLEANED} AND {TIMED}",
    "pairs": "SELECT DISTINCT p.dept_id, p.vehicle_id, n.site_id FROM (" + NEAR.format(pts="pts", cmp="< 500") + ") n JOIN pts p ON p.event_id = n.event_id WHERE n.site_flag = 2 AND n.audit_state = '1'",
    "ordered": "SELECT p.dept_id, p.vehicle_id, q.site_id, p.t_sec, " + dist("p.lng", "p.lat", "s.lng", "s.lat") + " < 500 AS inside, row_number() OVER (PARTITION BY p.dept_id, p.vehicle_id, q.site_id ORDER BY p.t_sec, p.event_id) AS rn FROM pairs q JOIN pts p ON p.dept_id = q.dept_id AND p.vehicle_id = q.vehicle_id JOIN v_site s ON s.site_id = q.site_id",
    "steps": """SELECT dept_id, vehicle_id, site_id, rn, CASE WHEN inside THEN t_sec END AS enter_t, CAST(NULL AS BIGINT) AS exit_t, false AS locked, CAST(NULL AS BIGINT) AS e_enter, CAST(NULL AS BIGINT) AS e_exit FROM ordered WHERE rn = 1
 UNION ALL SELECT dept_id, vehicle_id, site_id, rn,
  CASE WHEN done THEN NULL WHEN inside AND enter_t IS NULL THEN t_sec ELSE enter_t END,
  CASE WHEN done OR inside OR NOT locked THEN NULL WHEN exit_t IS NULL THEN t_sec ELSE exit_t END,
  CASE WHEN done THEN false WHEN inside AND enter_t IS NOT NULL AND t_sec - enter_t > 180 THEN true ELSE locked END,
  CASE WHEN done THEN enter_t END, CASE WHEN done THEN exit_t END
 FROM (SELECT o.*, s.enter_t, s.exit_t, s.locked, coalesce(NOT o.inside AND s.locked AND o.t_sec - s.exit_t > 180, false) AS done FROM steps s JOIN ordered o ON o.dept_id = s.dept_id AND o.vehicle_id = s.vehicle_id AND o.site_id = s.site_id AND o.rn = s.rn + 1) x""",
}
oracle("inout_dwell", "SELECT dept_id, vehicle_id, site_id, e_enter AS enter_sec, e_exit AS exit_sec FROM steps WHERE e_enter IS NOT NULL", DWELL, recursive=True)
oracle("hourly_track_counts", "SELECT dept_id, CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS hour_sec, count(*) AS positions, round(sum(speed), 4) AS speed_sum FROM v_track WHERE t_sec IS NOT NULL GROUP BY 1, 2")


# ---- streams: which positions come before the watermark follows from the deliveries
ARRIVED = {
    "arr": ADMITTED.replace("v_track", "v_arrival"),
    "marks": "SELECT arrival, (SELECT max(t_sec) FROM arr a WHERE a.arrival < b.arrival) - 900 AS mark FROM (SELECT DISTINCT arrival FROM arr) b",
    "told": "SELECT a.*, coalesce(t_sec <= mark, false) AS late FROM arr a JOIN marks USING (arrival) WHERE t_sec IS NOT NULL",
    "pts": "SELECT * FROM told WHERE NOT late AND t_sec <= (SELECT max(t_sec) FROM arr) - 900",
}


def _arrived(ctes: dict[str, str]) -> dict[str, str]:
    return {**ARRIVED, **{name: text for name, text in ctes.items() if name not in ARRIVED}}


oracle(
    "late_rows",
    f"SELECT {KEYS}, 'late' AS reason, t_sec, event_id FROM told WHERE late UNION ALL SELECT {KEYS}, 'untimed', t_sec, event_id FROM arr WHERE t_sec IS NULL",
    {k: v for k, v in ARRIVED.items() if k != "pts"},
)
oracle("late_stops", _STOP, _arrived(_stops(3600)), recursive=True)
oracle("late_alarms", _ALARM_ROW, _arrived(GPS), recursive=True)
oracle(
    "late_trips",
    f"SELECT {KEYS}, from_site_id, from_site_flag, from_site_inter_sec, from_site_work_sec, from_site_leave_sec, to_site_id, to_site_flag, to_site_inter_sec, vehicle_empty FROM trip",
    _arrived(_trip_walk(False)), recursive=True,
)
oracle("late_dwell", "SELECT dept_id, vehicle_id, site_id, e_enter AS enter_sec, e_exit AS exit_sec FROM steps WHERE e_enter IS NOT NULL", _arrived(DWELL), recursive=True)
oracle(
    "checkpoint_restart",
    "SELECT o.event_id, o.vehicle_id, o.t_sec, s.shown AS online_time, CASE WHEN o.speed > 0 THEN 1 ELSE 0 END AS online_status FROM ordered o JOIN steps s ON s.dept_id = o.dept_id AND s.vehicle_id = o.vehicle_id AND s.rn = o.rn",
    {**ARRIVED, **ONLINE, "a": "SELECT * FROM pts"}, recursive=True,
)
oracle(
    "dim_refresh",
    """SELECT event_id, vehicle_id, t_sec, CASE WHEN held THEN valid_from END AS valid_from, CASE WHEN held THEN car_card_number END AS car_card_number, CASE WHEN held THEN enterprise_id END AS enterprise_id
 FROM (SELECT a.event_id, a.vehicle_id, a.t_sec, v.* EXCLUDE (vehicle_id), v.valid_to IS NULL OR a.t_sec < v.valid_to AS held FROM v_arrival a ASOF LEFT JOIN v_vehicle_versions v ON v.vehicle_id = a.vehicle_id AND v.valid_from <= a.t_sec) j""",
)
oracle(
    "vehicle_state_log",
    f"""SELECT v.dept_id, v.vehicle_id, v.car_card_number, l.t_sec, l.event_id, round(l.lng, 6) AS lng, round(l.lat, 6) AS lat, round(l.speed, 6) AS speed FROM v_vehicle v LEFT JOIN
 (SELECT *, row_number() OVER (PARTITION BY {KEYS} ORDER BY t_sec DESC, event_id DESC) AS k FROM a) l ON l.k = 1 AND l.dept_id = v.dept_id AND l.vehicle_id = v.vehicle_id""",
    {"a": ADMITTED.replace("v_track", "v_arrival") + f" AND {TIMED}"},
)
