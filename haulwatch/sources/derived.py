"""Fleet inputs derived from the generic star-schema tables.

Each text runs in Spark and, after :func:`duckdb_text`, in DuckDB. ``{SEC}`` stands for
whole seconds of ``ts`` and ``{HEX}`` for the hex function.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from haulwatch.sources.tables import read_parquet

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

SPARK_SEC = "timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"
DUCKDB_SEC = "CAST(floor(epoch(ts)) AS BIGINT)"

_LAT = (
    "CASE WHEN event_id % 97 = 0 THEN CAST(0.0 AS DOUBLE) ELSE CAST(34.70 AS DOUBLE)"
    " + CAST((event_id*104729) % 40 AS DOUBLE) * CAST(0.002 AS DOUBLE) END"
)
_LNG = (
    "CAST(113.60 AS DOUBLE) + CAST((event_id*7919) % 40 AS DOUBLE) * CAST(0.002 AS DOUBLE)"
)

# The five keys of ``region``, which stand for departments.
DEPARTMENTS = range(5)

VIEWS = {
    "v_track": f"""
SELECT event_id, user_id AS vehicle_id, CAST(user_id % 5 AS INT) AS dept_id, ts,
 CASE WHEN event_id % 89 = 5 THEN NULL ELSE {{SEC}} END AS t_sec,
 CASE WHEN event_type='error' THEN 0.0 ELSE value/4 END AS speed, {_LAT} AS lat, {_LNG} AS lng,
 CASE WHEN user_id % 11 = 0 THEN '0' ELSE '1' END AS manage_state,
 CASE WHEN user_id % 13 = 0 THEN NULL ELSE '1' END AS audit_state,
 CAST(CASE WHEN user_id % 3 = 0 THEN 0 ELSE 1 END AS INT) AS register_card_state
FROM {{events}}""",
    # Positions in three arrivals of ten days each: up to 15 minutes late, some of them several days.
    "v_arrival": f"""
SELECT *, CASE WHEN t_sec IS NULL THEN CAST(event_id % 3 AS INT) ELSE CAST(least(2, greatest(0, floor((t_sec + delay - 1704067200) / 864000.0))) AS INT) END AS arrival FROM (
 SELECT event_id, user_id AS vehicle_id, CAST(user_id % 5 AS INT) AS dept_id, CASE WHEN event_id % 89 = 5 THEN NULL ELSE {{SEC}} END AS t_sec,
  CASE WHEN event_type='error' THEN 0.0 ELSE value/4 END AS speed, {_LAT} AS lat, {_LNG} AS lng, CASE WHEN user_id % 11 = 0 THEN '0' ELSE '1' END AS manage_state,
  CASE WHEN user_id % 13 = 0 THEN NULL ELSE '1' END AS audit_state, CASE WHEN event_id % 41 = 7 THEN 200000 + (event_id % 5) * 150000 ELSE (event_id * 37) % 900 END AS delay FROM {{events}}) a""",
    # Positions before the vehicle is known: a device id and a plate only, for some of an unknown vehicle.
    "v_raw_track": f"""
SELECT event_id, concat(CASE WHEN user_id % 10 = 9 THEN 'U' ELSE 'T' END, CAST(user_id AS STRING)) AS devid,
 concat(CASE WHEN user_id % 10 = 9 THEN 'Unknown#' ELSE 'Customer#' END, lpad(CAST(user_id AS STRING), 9, '0')) AS plate, {{SEC}} AS t_sec,
 CASE WHEN event_type='error' THEN 0.0 ELSE value/4 END AS speed, {_LAT} AS lat, {_LNG} AS lng
FROM {{events}}""",
    "v_vehicle": """
SELECT c_custkey AS vehicle_id, concat('T', CAST(c_custkey AS STRING)) AS terminal_id, c_name AS car_card_number,
 CASE c_custkey % 4 WHEN 0 THEN '0' WHEN 1 THEN '16' WHEN 2 THEN '17' ELSE '99' END AS vehicle_model_id,
 CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey % 30 END AS driver_id, CASE WHEN c_custkey % 9 = 8 THEN 100 + c_nationkey ELSE c_nationkey END AS enterprise_id, CAST(c_custkey % 5 AS INT) AS dept_id,
 CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE '1' END AS audit_state,
 CASE WHEN c_custkey % 11 = 0 THEN '0' ELSE '1' END AS manage_state
FROM {customer}""",
    # Vehicle master with several versions of a row.
    "v_vehicle_history": """
SELECT c_custkey % 100 AS vehicle_id, c_custkey AS version, c_name AS car_card_number, c_nationkey AS enterprise_id
FROM {customer}""",
    # Versions of a vehicle by the time they hold: most vehicles have two, some a gap or a late beginning.
    "v_vehicle_versions": """
SELECT c_custkey AS vehicle_id, CAST(CASE WHEN c_custkey % 9 = 4 THEN 1704067200 + 864000 ELSE 0 END AS BIGINT) AS valid_from,
 CASE WHEN c_custkey % 7 = 2 THEN 1704067200 + 86400 * 16 END AS valid_to, c_name AS car_card_number, c_nationkey AS enterprise_id FROM {customer}
UNION ALL SELECT c_custkey, 1704067200 + 86400 * 16 + (c_custkey * 7919) % 864000, NULL, concat(c_name, '-2'), (c_nationkey + 7) % 25 FROM {customer} WHERE c_custkey % 4 <> 3""",
    "v_service_fee": """
SELECT CAST(c_custkey % 5 AS INT) AS dept_id, c_custkey AS vehicle_id, CAST(CASE WHEN c_custkey % 6 = 0 THEN 1 ELSE 0 END AS INT) AS state FROM {customer}""",
    "v_driver": " UNION ALL ".join(
        f"SELECT CAST({d} AS INT) AS dept_id, n_nationkey AS driver_id, concat('D', CAST(n_nationkey AS STRING), '-{d}') AS driver_card_number,"
        " concat('driver ', CAST(n_nationkey AS STRING)) AS driver_name FROM {nation}"
        for d in DEPARTMENTS
    ),
    "v_enterprise": " UNION ALL ".join(
        f"SELECT CAST({d} AS INT) AS dept_id, n_nationkey AS enterprise_id, n_name AS enterprise_name,"
        " CAST(n_regionkey AS STRING) AS province_id, concat('c', CAST(n_nationkey AS STRING)) AS city_id,"
        " concat('a', CAST(n_nationkey % 7 AS STRING)) AS area_id FROM {nation}"
        for d in DEPARTMENTS
    ),
    "v_register_card": """
SELECT dept_id, vehicle_id, card_id, disposal_site_id, state, coords FROM (
 SELECT CAST(c_custkey % 5 AS INT) AS dept_id, CASE WHEN c_custkey % 3 = 0 THEN 1000000000 + c_custkey ELSE c_custkey END AS vehicle_id, c_custkey*2 AS card_id, (c_custkey % 5) + 5 * (c_custkey % 2) AS disposal_site_id, CAST(CASE WHEN c_custkey % 8 = 0 THEN 1 ELSE 0 END AS INT) AS state, '[[[113.60,34.70],[113.62,34.72]]]' AS coords FROM {customer}
 UNION ALL SELECT CAST(c_custkey % 5 AS INT), c_custkey, c_custkey*2+1, c_custkey % 5, 0, '[[[113.64,34.74],[113.66,34.76]],[[113.67,34.77]]]' FROM {customer} WHERE c_custkey % 6 = 1) c""",
    "v_transport_card": """
SELECT CAST(c_custkey % 5 AS INT) AS dept_id, c_custkey AS vehicle_id, CAST(c_custkey % 4 AS INT) AS state FROM {customer}""",
    "v_site": """
SELECT s_suppkey AS site_id, s_name AS site_name, CAST(s_suppkey % 5 AS INT) AS dept_id, CAST(CASE WHEN (s_suppkey / 5) % 2 < 1 THEN 1 ELSE 2 END AS INT) AS site_flag,
 CAST(113.60 AS DOUBLE) + CAST((s_suppkey*31) % 40 AS DOUBLE) * CAST(0.002 AS DOUBLE) AS lng, CAST(34.70 AS DOUBLE) + CAST((s_suppkey*17) % 40 AS DOUBLE) * CAST(0.002 AS DOUBLE) AS lat, CAST(CASE WHEN s_suppkey % 17 = 16 THEN 1 ELSE 0 END AS INT) AS is_delete,
 CASE WHEN s_suppkey % 7 = 3 THEN '0' ELSE '1' END AS audit_state, CAST(s_nationkey % 5 AS STRING) AS province_id, concat('c', CAST(s_nationkey AS STRING)) AS city_id, concat('a', CAST(s_suppkey % 20 AS STRING)) AS area_id FROM {supplier}""",
    "v_area": """
SELECT r_regionkey AS dept_id, r_regionkey*10 + k AS id, concat(r_name, '-', CAST(k AS STRING)) AS city_name, CAST(CASE WHEN r_regionkey = 4 AND k = 1 THEN 0 ELSE 1 END AS INT) AS state,
 CASE k WHEN 0 THEN '113.599,34.699;113.599,34.739;113.639,34.739;113.639,34.699;' ELSE '113.621,34.721;113.621,34.785;113.685,34.753' END AS coords FROM (SELECT *, 0 AS k FROM {region} UNION ALL SELECT *, 1 AS k FROM {region}) z""",
    "v_boundary": """
SELECT n_nationkey AS id, concat('fence-', CAST(n_nationkey AS STRING)) AS name, concat('a', CAST(n_nationkey % 3 AS STRING)) AS area_id,
 CASE n_nationkey % 5 WHEN 0 THEN '[[113.599,34.699],[113.599,34.739],[113.639,34.739],[113.639,34.699]]' ELSE '[[113.621,34.721],[113.621,34.785],[113.685,34.753]]' END AS coords FROM {nation}""",
    "v_rule_speed": """
SELECT n_nationkey AS condition_id, n_nationkey % 5 AS dept_id, CAST(20.0 AS DOUBLE) AS speed, CAST(0 AS INT) AS state FROM {nation} WHERE n_nationkey < 5""",
    "v_rule_penalty": """
SELECT n_nationkey AS condition_id, n_nationkey % 5 AS dept_id, CAST(CASE WHEN n_nationkey = 9 THEN 1 ELSE 0 END AS INT) AS state FROM {nation} WHERE n_nationkey BETWEEN 5 AND 9""",
    "v_rule_work_time": """
SELECT n_nationkey AS condition_id, n_nationkey % 5 AS dept_id, '06:00' AS start_date, '22:30:00' AS end_date, CAST(0 AS INT) AS state FROM {nation} WHERE n_nationkey BETWEEN 10 AND 14""",
    "v_rule_out": """
SELECT n_nationkey AS condition_id, n_nationkey % 5 AS dept_id, CAST(0 AS INT) AS state FROM {nation} WHERE n_nationkey BETWEEN 15 AND 19""",
    "v_rule_document": """
SELECT n_nationkey AS condition_id, n_nationkey % 5 AS dept_id, '2024-01-10 00:00' AS start_date, '2024-01-20 12:00' AS end_date, CAST(0 AS INT) AS state FROM {nation} WHERE n_nationkey >= 20""",
    "v_fence_rule": """
SELECT condition_id, dept_id, fence_flag, CAST(CASE WHEN fence_flag = 1 THEN 20.0 END AS DOUBLE) AS speed,
 CASE fence_flag WHEN 3 THEN '06:00' WHEN 5 THEN '2024-01-10 00:00' END AS start_date, CASE fence_flag WHEN 3 THEN '22:30:00' WHEN 5 THEN '2024-01-20 12:00' END AS end_date,
 concat('fence-', CAST(condition_id AS STRING)) AS name, concat('a', CAST(condition_id % 3 AS STRING)) AS area_id,
 CASE dept_id WHEN 0 THEN '[[113.599,34.699],[113.599,34.739],[113.639,34.739],[113.639,34.699]]' ELSE '[[113.621,34.721],[113.621,34.785],[113.685,34.753]]' END AS coords
FROM (SELECT n_nationkey AS condition_id, n_nationkey % 5 AS dept_id, CAST(((n_nationkey - n_nationkey % 5) / 5) AS INT) + 1 AS fence_flag FROM {nation}) f""",
    "v_score": " UNION ALL ".join(
        f"SELECT CAST(CASE WHEN r_regionkey = 4 THEN 104 ELSE r_regionkey END AS INT) AS dept_id, '{code}' AS illegal_type_code, 'type {code}' AS illegal_type_short_desc,"
        f" CAST({w} AS DOUBLE) AS enterprise_score, CAST({w * 2} AS DOUBLE) AS vehicle_score, CAST({w} + r_regionkey AS DOUBLE) AS driver_score"
        " FROM {region}"
        for code, w in (("0118", 3), ("0110", 2), ("0115", 5), ("0112", 1))
    ),
    "v_area_name": """
SELECT id, area_name FROM (SELECT concat('c', CAST(n_nationkey AS STRING)) AS id, concat('city ', n_name) AS area_name FROM {nation}
 UNION ALL SELECT CAST(r_regionkey AS STRING), concat('province ', r_name) FROM {region}) z""",
    "v_trip": """
SELECT l_orderkey, l_linenumber, o_custkey AS vehicle_id, CAST(o_custkey % 5 AS INT) AS dept_id, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS load,
 CAST(1 + l_linenumber % 4 AS INT) AS s_site_flag, s.s_suppkey AS s_site_id, s.s_name AS s_site_name, CAST(n.n_regionkey AS STRING) AS s_site_province_id, concat('c', CAST(n.n_nationkey AS STRING)) AS s_site_city_id, CASE WHEN s.s_suppkey % 3 = 0 THEN '' WHEN s.s_suppkey % 3 = 1 THEN NULL ELSE concat('a', CAST(s.s_suppkey % 20 AS STRING)) END AS s_site_area_id,
 l_partkey % 50 AS e_site_id, concat('disposal-', CAST(l_partkey % 50 AS STRING)) AS e_site_name, CAST(l_partkey % 5 AS STRING) AS e_site_province_id, concat('c', CAST(l_partkey % 25 AS STRING)) AS e_site_city_id, concat('a', CAST(l_partkey % 10 AS STRING)) AS e_site_area_id
FROM {lineitem} l JOIN {orders} o ON l_orderkey = o_orderkey JOIN {supplier} s ON l_suppkey = s.s_suppkey JOIN {nation} n ON s.s_nationkey = n.n_nationkey""",
    "v_illegal": """
SELECT o_custkey AS vehicle_id, c_name AS car_card_number, l_suppkey AS enterprise_id, s_name AS enterprise_name, CASE l_linenumber % 5 WHEN 0 THEN '0110' WHEN 1 THEN '0108' WHEN 2 THEN '0121' WHEN 3 THEN '0107' ELSE '0111' END AS illegal_id, CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE concat('violation ', CAST(l_linenumber % 5 AS STRING)) END AS illegal_type_short_desc,
 CASE WHEN l_suppkey % 11 = 3 THEN NULL WHEN l_suppkey % 11 = 5 THEN l_tax * -100 ELSE l_tax * 100 END AS enterprise_final_score, l_discount * 100 AS vehicle_driver_final_score, CAST(n_regionkey AS STRING) AS province_id, CAST(n_nationkey AS STRING) AS city_id, CAST(o_custkey % 3 AS STRING) AS area_id, CAST(o_custkey % 5 AS INT) AS dept_id, o_orderdate AS create_time
FROM {lineitem} l JOIN {orders} o ON l_orderkey = o_orderkey JOIN {customer} c ON o_custkey = c_custkey JOIN {supplier} s ON l_suppkey = s_suppkey JOIN {nation} n ON c_nationkey = n_nationkey""",
    # Yesterday's running totals: one row per supplier as if it were a site.
    "v_amount": """
SELECT CAST(s_suppkey AS STRING) AS site_id, s_name AS site_name, CAST(s_suppkey % 5 AS INT) AS dept_id, CAST(s_suppkey * 10 AS DOUBLE) AS build_sum, s_suppkey AS build_count, CAST(0 AS DOUBLE) AS disposal_sum, CAST(0 AS BIGINT) AS disposal_count FROM {supplier}""",
    # One frame per event, without its checksum byte. The body has 28 fixed bytes, a mileage
    # item, for some events a fuel item, and for some an item whose length points past the end.
    "v_frame_body": """
SELECT event_id, {SEC} AS t_sec, user_id, CAST(floor(value * 10) AS BIGINT) AS speed10, event_id % 360 AS direction, (event_id * 31) % 65536 AS state_word, (event_id * 7919) % 1073741824 AS alarm_word,
 34700000 + (event_id*104729) % 40 * 2000 AS lat6, 113600000 + (event_id*7919) % 40 * 2000 AS lng6, event_id * 13 AS mileage10, event_id % 1000 AS fuel10,
 concat(lpad(lower({HEX}(CAST((event_id * 7919) % 1073741824 AS BIGINT))), 8, '0'), lpad(lower({HEX}(CAST((event_id * 31) % 65536 AS BIGINT))), 8, '0'),
  lpad(lower({HEX}(CAST(34700000 + (event_id*104729) % 40 * 2000 AS BIGINT))), 8, '0'), lpad(lower({HEX}(CAST(113600000 + (event_id*7919) % 40 * 2000 AS BIGINT))), 8, '0'),
  '0042', lpad(lower({HEX}(CAST(floor(value * 10) AS BIGINT))), 4, '0'), lpad(lower({HEX}(CAST(event_id % 360 AS BIGINT))), 4, '0'),
  CASE WHEN event_id % 31 = 0 THEN '2401ff000000' ELSE {BCDTIME} END,
  '0104', lpad(lower({HEX}(CAST(event_id * 13 AS BIGINT))), 8, '0'),
  CASE WHEN event_id % 3 = 0 THEN concat('0202', lpad(lower({HEX}(CAST(event_id % 1000 AS BIGINT))), 4, '0')) ELSE '' END,
  CASE WHEN event_id % 5 = 0 THEN '31ff' WHEN event_id % 5 = 1 THEN '310119' ELSE '' END) AS body
FROM {events}""",
}

# Whole frames on top of v_frame_body, some of them the part of a message of three: {XOR} is the XOR of the bytes of
# column ``bytes``.
VIEWS["v_frame"] = f"""
SELECT event_id, CASE event_id % 40 WHEN 1 THEN substr(whole, 1, length(whole) - 1) WHEN 2 THEN concat('zz', whole) WHEN 3 THEN substr(whole, 1, 60) WHEN 4 THEN '' WHEN 5 THEN NULL ELSE whole END AS frame
FROM (SELECT event_id, concat(bytes, CASE WHEN event_id % 23 = 0 THEN '5a' ELSE lpad(lower({{HEX}}(CAST({{XOR}} AS BIGINT))), 2, '0') END) AS whole
 FROM (SELECT event_id, concat('0200', lpad(lower({{HEX}}(CAST(length(body) / 2 + CASE WHEN event_id % 40 = 6 THEN 8192 ELSE 0 END AS BIGINT))), 4, '0'), lpad(CAST(user_id AS STRING), 12, '0'), lpad(lower({{HEX}}(CAST(event_id % 65536 AS BIGINT))), 4, '0'),
 CASE WHEN event_id % 40 = 6 THEN concat('0003', lpad(CAST(event_id % 3 + 1 AS STRING), 4, '0')) ELSE '' END, body) AS bytes FROM ({VIEWS["v_frame_body"]}) b) f) g"""

_SPARK = {
    "SEC": SPARK_SEC,
    "HEX": "hex",
    "BCDTIME": "date_format(ts, 'yyMMddHHmmss')",
    # seven bytes at a time, and the seven bytes of the outcome with each other
    "XOR": "transform(array(rpad(bytes, CAST(ceil(length(bytes) / 14) * 14 AS INT), '0')), b -> transform(array(aggregate(sequence(0, length(b) DIV 14 - 1), 0L, "
    "(a, i) -> a ^ CAST(conv(substring(b, 14 * i + 1, 14), 16, 10) AS BIGINT))), x -> (x ^ " + " ^ ".join(f"shiftright(x, {n})" for n in range(8, 56, 8)) + ") & 255)[0])[0]",
}
_DUCKDB = {
    "SEC": DUCKDB_SEC,
    "HEX": "to_hex",
    "BCDTIME": "strftime(ts, '%y%m%d%H%M%S')",
    "XOR": "list_reduce(list_transform(range(0, length(bytes) // 2), lambda i: CAST(concat('0x', substr(bytes, 2 * i + 1, 2)) AS INT)), lambda a, x: xor(a, x))",
}


def _fill(text: str, values: dict[str, str]) -> str:
    for key, value in values.items():
        text = text.replace("{" + key + "}", value)
    return text


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One derived input as a DataFrame over the tables in ``folder``."""
    text = _fill(VIEWS[name], _SPARK)
    used = [t for t in TABLES if "{" + t + "}" in text]
    return spark.sql(text, **{t: read_parquet(spark, folder, t) for t in used})


def duckdb_text(name: str) -> str:
    text = _fill(VIEWS[name], _DUCKDB)
    return re.sub(r"\{(\w+)\}", r"\1", text)
