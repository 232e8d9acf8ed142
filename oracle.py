"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark code, straight from the role mapping in
FIXTURES.md: each query is a ``WITH`` chain over the pre-registered TESTDATA
views. Decimals are compared as doubles, averages are exact sums divided by
counts, and every timestamp is a plain ``TIMESTAMP``.
"""

from __future__ import annotations

AS_OF_FIRST = "TIMESTAMP '2024-01-01 00:00:00'"
AS_OF_SECOND = "TIMESTAMP '2024-01-15 00:00:00'"
MART_FROM = "TIMESTAMP '2024-01-05 00:00:00'"
MART_TO = "TIMESTAMP '2024-01-20 00:00:00'"
SECOND_FROM = "TIMESTAMP '2024-01-10 00:00:00'"
SECOND_TO = "TIMESTAMP '2024-01-25 00:00:00'"
LOAD_TS = "TIMESTAMP '2024-02-01 00:00:00'"
LOAD_ID = "'batch_2024-02-01'"

# --- role views ---------------------------------------------------------------

ROUTES = """
routes AS (
  SELECT s_suppkey AS route_id, s_name AS name,
         CASE s_suppkey % 3 WHEN 0 THEN 'bus' WHEN 1 THEN 'tram' ELSE 'metro' END AS transport_type,
         CAST(s_acctbal AS DECIMAL(12,2)) AS base_fare
  FROM supplier)"""

DIM_ROUTE1 = f"""
dim_route1 AS (
  SELECT row_number() OVER (ORDER BY route_id) AS route_sk, route_id, name, transport_type,
         base_fare, TRUE AS active_flag, {AS_OF_FIRST} AS valid_from,
         CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current
  FROM routes)"""

ROUTES2 = """
routes2 AS (
  SELECT route_id,
         CASE WHEN route_id % 10 = 1 THEN NULL ELSE name END AS name,
         transport_type,
         CASE WHEN route_id % 10 = 0 THEN CAST(base_fare * 1.1 AS DECIMAL(12,2)) ELSE base_fare END AS base_fare
  FROM routes WHERE route_id % 10 <> 2
  UNION ALL
  SELECT route_id + 100000, name, transport_type, base_fare FROM routes WHERE route_id % 20 = 0)"""

# dim_route after the second batch: history + kept/closed + new versions.
DIM_ROUTE2 = f"""
r_cmp AS (
  SELECT c.*, i.route_id AS i_route_id, i.name AS i_name, i.transport_type AS i_type,
         i.base_fare AS i_fare,
         (i.route_id IS NOT NULL AND (c.name IS DISTINCT FROM i.name
            OR c.transport_type IS DISTINCT FROM i.transport_type
            OR c.base_fare IS DISTINCT FROM i.base_fare)) AS changed
  FROM dim_route1 c LEFT JOIN routes2 i ON c.route_id = i.route_id),
r_new AS (
  SELECT i_route_id AS route_id, i_name AS name, i_type AS transport_type, i_fare AS base_fare
  FROM r_cmp WHERE changed
  UNION ALL
  SELECT i.route_id, i.name, i.transport_type, i.base_fare
  FROM routes2 i WHERE i.route_id NOT IN (SELECT route_id FROM dim_route1)),
dim_route2 AS (
  SELECT route_sk, route_id, name, transport_type, base_fare, active_flag, valid_from,
         CASE WHEN changed THEN {AS_OF_SECOND} ELSE valid_to END AS valid_to,
         CASE WHEN changed THEN FALSE ELSE is_current END AS is_current,
         CASE WHEN changed THEN 'closed' ELSE 'unchanged' END AS change
  FROM r_cmp
  UNION ALL
  SELECT (SELECT max(route_sk) FROM dim_route1) + row_number() OVER (ORDER BY route_id),
         route_id, name, transport_type, base_fare, TRUE, {AS_OF_SECOND},
         CAST(NULL AS TIMESTAMP), TRUE, 'new'
  FROM r_new)"""

HTRIPS = """
htrips AS (
  SELECT event_id AS trip_id, user_id, user_id % 100 AS route_id, user_id AS vehicle_id,
         ts AS start_ts, ts + to_seconds(event_id % 3600) AS end_ts,
         CAST(event_id % 3600 AS INTEGER) AS duration_sec,
         CAST(CAST(value AS DECIMAL(12,2)) * 1000 AS DECIMAL(14,3)) AS distance_m,
         CAST(value AS DECIMAL(12,2)) AS fare
  FROM events WHERE event_type IN ('purchase', 'signup', 'error'))"""

POS = """
pos AS (
  SELECT ts AS event_ts, user_id AS vehicle_id, user_id % 100 AS route_id,
         CAST(55.75 + (event_id % 41 - 20) / 100.0 AS DECIMAL(10,7)) AS lat,
         CAST(37.61 + (event_id % 37 - 18) / 100.0 AS DECIMAL(10,7)) AS lon,
         CAST(value AS DECIMAL(10,3)) AS speed,
         CAST(event_id % 360 AS DECIMAL(6,2)) AS heading,
         ts AS provider_ts, props AS payload, event_id
  FROM events WHERE event_type IN ('view', 'click'))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def _mart(lo: str, hi: str, snap: str, suffix: str = "") -> str:
    """CTEs computing one mart run named ``mart{suffix}``."""
    return f"""
t{suffix} AS (
  SELECT h.trip_id, r.route_id, r.name, r.transport_type, h.start_ts, h.fare AS fare_amount,
         h.duration_sec, h.distance_m
  FROM htrips h JOIN dim_route1 r ON h.route_id = r.route_id
  WHERE h.start_ts >= {lo} AND h.start_ts < {hi}),
th{suffix} AS (
  SELECT route_id, name, transport_type, date_trunc('hour', start_ts) AS hour_bucket,
         COUNT(DISTINCT trip_id) AS trip_cnt,
         CAST(SUM(fare_amount) AS DOUBLE) / COUNT(fare_amount) AS avg_fare,
         CAST(SUM(CAST(duration_sec AS BIGINT)) AS DOUBLE) / COUNT(duration_sec) AS avg_duration_sec,
         CAST(SUM(distance_m) AS DOUBLE) AS sum_distance_m
  FROM t{suffix} GROUP BY 1, 2, 3, 4),
p{suffix} AS (
  SELECT r.route_id, p.event_ts, p.speed
  FROM pos p JOIN dim_route1 r ON p.route_id = r.route_id
  WHERE p.event_ts >= {lo} AND p.event_ts < {hi}),
sh{suffix} AS (
  SELECT route_id, date_trunc('hour', event_ts) AS hour_bucket,
         CAST(SUM(speed) AS DOUBLE) / COUNT(speed) AS avg_speed
  FROM p{suffix} GROUP BY 1, 2),
mart{suffix} AS (
  SELECT th.route_id, th.hour_bucket, th.name, th.transport_type, th.trip_cnt, th.avg_fare,
         th.avg_duration_sec, th.sum_distance_m, COALESCE(sh.avg_speed, 0.0) AS avg_speed,
         {snap} AS snapshot_ts
  FROM th{suffix} th LEFT JOIN sh{suffix} sh
    ON th.route_id = sh.route_id AND th.hour_bucket = sh.hour_bucket)"""


MART1 = _mart(MART_FROM, MART_TO, MART_TO)

SQL: dict[str, str] = {}

SQL["mart_route_hourly"] = with_(ROUTES, DIM_ROUTE1, HTRIPS, POS, MART1) + " SELECT * FROM mart"

SQL["trips_hourly"] = with_(ROUTES, HTRIPS) + """
SELECT h.route_id, r.name, r.transport_type, date_trunc('hour', h.start_ts) AS hour_bucket,
       COUNT(DISTINCT h.trip_id) AS trip_cnt,
       CAST(SUM(h.fare) AS DOUBLE) / COUNT(h.fare) AS avg_fare,
       CAST(SUM(CAST(h.duration_sec AS BIGINT)) AS DOUBLE) / COUNT(h.duration_sec) AS avg_duration_sec,
       CAST(SUM(h.distance_m) AS DOUBLE) AS sum_distance_m
FROM htrips h LEFT JOIN routes r ON h.route_id = r.route_id
GROUP BY 1, 2, 3, 4"""

SQL["speed_hourly"] = with_(POS) + """
SELECT route_id, date_trunc('hour', event_ts) AS hour_bucket,
       CAST(SUM(speed) AS DOUBLE) / COUNT(speed) AS avg_speed
FROM pos GROUP BY 1, 2"""

SQL["route_snapshot_hourly"] = with_(POS) + """
SELECT route_id, date_trunc('hour', event_ts) AS hour_bucket,
       COUNT(*) AS position_cnt, COUNT(DISTINCT vehicle_id) AS vehicle_cnt,
       CAST(SUM(speed) AS DOUBLE) / COUNT(speed) AS avg_speed,
       CAST(MAX(speed) AS DOUBLE) AS max_speed
FROM pos GROUP BY 1, 2"""

SQL["mart_latest_snapshot"] = with_(
    ROUTES, DIM_ROUTE1, HTRIPS, POS, MART1, _mart(SECOND_FROM, SECOND_TO, SECOND_TO, "2")
) + """,
both_runs AS (SELECT * FROM mart UNION ALL SELECT * FROM mart2)
SELECT route_id, hour_bucket, name, transport_type, trip_cnt, avg_fare, avg_duration_sec,
       sum_distance_m, avg_speed, snapshot_ts
FROM both_runs
QUALIFY row_number() OVER (PARTITION BY route_id, name, transport_type, hour_bucket
                           ORDER BY snapshot_ts DESC) = 1"""

SQL["route_popularity"] = with_(ROUTES, DIM_ROUTE1, HTRIPS, POS, MART1) + """
SELECT route_id, CAST(SUM(trip_cnt) AS BIGINT) AS trip_cnt
FROM mart GROUP BY route_id ORDER BY trip_cnt DESC, route_id LIMIT 10"""

SQL["mart_inspect"] = with_(ROUTES, DIM_ROUTE1, HTRIPS, POS, MART1) + """
SELECT * FROM mart ORDER BY route_id, hour_bucket LIMIT 10"""

SQL["eta_features"] = with_(HTRIPS, POS) + """,
sh AS (SELECT route_id, date_trunc('hour', event_ts) AS hour_bucket,
              CAST(SUM(speed) AS DOUBLE) / COUNT(speed) AS route_hour_avg_speed
       FROM pos GROUP BY 1, 2)
SELECT h.trip_id, h.route_id, CAST(hour(h.start_ts) AS INTEGER) AS hour_of_day,
       CAST(isodow(h.start_ts) - 1 AS INTEGER) AS weekday,
       CAST(h.distance_m AS DOUBLE) AS distance_m, sh.route_hour_avg_speed, h.duration_sec
FROM htrips h LEFT JOIN sh
  ON h.route_id = sh.route_id AND date_trunc('hour', h.start_ts) = sh.hour_bucket"""


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


# --- typing, stamp, dedupe, quality ------------------------------------------

LI_COLS_REST = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
]

LI_DEDUP = """
li_dedup AS (
  SELECT * FROM lineitem
  QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC NULLS LAST, """ + ", ".join(
    f"{c} DESC NULLS LAST" for c in LI_COLS_REST
) + """) = 1)"""


def _dtrips(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS trip_id,
         l.l_orderkey, l.l_linenumber, o.o_custkey AS user_id, l.l_suppkey AS route_id,
         l.l_partkey AS vehicle_id, o.o_orderdate AS start_ts, l.l_shipdate AS end_ts,
         l.l_suppkey % 25 AS start_stop_id, l.l_partkey % 25 AS end_stop_id,
         CAST(CAST(l.l_quantity AS DECIMAL(14,3)) * 1000 AS DECIMAL(14,3)) AS distance_m,
         CAST(l.l_extendedprice AS DECIMAL(12,2)) AS fare, l.l_linestatus AS status
  FROM {source} l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


DTRIPS = _dtrips("dtrips", "li_dedup")
DTRIPS_ALL = _dtrips("dtrips_all", "lineitem")

TRIP_RULES = [
    ("trip_id_null", "trip_id IS NULL"),
    ("user_id_null", "user_id IS NULL"),
    ("route_id_null", "route_id IS NULL"),
    ("start_ts_null", "start_ts IS NULL"),
    ("end_before_start", "end_ts < start_ts"),
    ("negative_distance", "distance_m < 0"),
    ("negative_fare", "fare < 0"),
]
POSITION_RULES = [
    ("event_ts_null", "event_ts IS NULL"),
    ("vehicle_id_null", "vehicle_id IS NULL"),
    ("route_id_null", "route_id IS NULL"),
    ("lat_out_of_range", "(lat < -90 OR lat > 90)"),
    ("lon_out_of_range", "(lon < -180 OR lon > 180)"),
    ("negative_speed", "speed < 0"),
]
PAYMENT_RULES = [
    ("payment_id_null", "payment_id IS NULL"),
    ("user_id_null", "user_id IS NULL"),
    ("negative_amount", "amount < 0"),
    ("trip_link_missing", "trip_id IS NULL"),
]


def _reasons(rules) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in rules) + ")"


TRIPS_TAGGED = f"""
trips_tagged AS (SELECT *, {_reasons(TRIP_RULES)} AS reasons FROM dtrips)"""

CLEAN_IDS = """
clean_ids AS (SELECT trip_id FROM trips_tagged WHERE reasons = '')"""

PAYMENTS = """
first_line AS (
  SELECT l_orderkey, min(l_linenumber) AS l_linenumber FROM lineitem GROUP BY l_orderkey),
first_route AS (
  SELECT l.l_orderkey, f.l_linenumber, min(l.l_suppkey) AS l_suppkey
  FROM lineitem l JOIN first_line f
    ON l.l_orderkey = f.l_orderkey AND l.l_linenumber = f.l_linenumber
  GROUP BY l.l_orderkey, f.l_linenumber),
payments AS (
  SELECT o.o_orderkey AS payment_id, o.o_custkey AS user_id, fr.l_suppkey AS route_id,
         CASE WHEN fr.l_linenumber IS NOT NULL
              THEN CAST(o.o_orderkey AS VARCHAR) || '-' || CAST(fr.l_linenumber AS VARCHAR) END AS trip_id,
         CAST(o.o_totalprice AS DECIMAL(12,2)) AS amount, CAST(NULL AS VARCHAR) AS currency,
         o.o_orderstatus AS status, o.o_orderpriority AS payment_method, o.o_orderdate AS paid_at
  FROM orders o LEFT JOIN first_route fr ON o.o_orderkey = fr.l_orderkey)"""

CONFORMED_PAYMENTS = """
SELECT CAST(o_orderkey AS VARCHAR) AS payment_id, CAST(o_custkey AS VARCHAR) AS user_id,
       CAST(NULL AS VARCHAR) AS route_id, CAST(NULL AS VARCHAR) AS trip_id,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS amount,
       CAST(NULL AS VARCHAR) AS currency, o_orderstatus AS status,
       o_orderpriority AS payment_method, o_orderdate AS paid_at"""

SQL["raw_conform"] = CONFORMED_PAYMENTS + " FROM orders"
SQL["staging_stamp"] = (
    CONFORMED_PAYMENTS + f", {LOAD_ID} AS load_id, {LOAD_TS} AS ingestion_ts FROM orders"
)
SQL["dedupe_trips"] = with_(LI_DEDUP) + " SELECT * FROM li_dedup"

TRIP_VIEW = """
SELECT trip_id, user_id, route_id, vehicle_id, start_ts, end_ts,
       CAST(date_diff('second', start_ts, end_ts) AS INTEGER) AS duration_sec,
       CAST(distance_m AS DOUBLE) AS distance_m, CAST(fare AS DOUBLE) AS fare"""

SQL["clean_trips"] = with_(LI_DEDUP, DTRIPS, TRIPS_TAGGED) + TRIP_VIEW + (
    " FROM trips_tagged WHERE reasons = ''"
)
SQL["reject_trips"] = with_(LI_DEDUP, DTRIPS, TRIPS_TAGGED) + (
    " SELECT trip_id, reasons FROM trips_tagged WHERE reasons <> ''"
)
SQL["reject_positions"] = with_(POS) + f"""
SELECT event_id, reasons FROM (SELECT event_id, {_reasons(POSITION_RULES)} AS reasons FROM pos)
WHERE reasons <> ''"""
SQL["reject_faulty_positions"] = with_(POS) + f""",
faulty AS (
  SELECT event_id, CASE WHEN event_id % 11 = 0 THEN lat * 2 ELSE lat END AS lat,
         CASE WHEN event_id % 13 = 0 THEN lon * -5 ELSE lon END AS lon,
         CASE WHEN event_id % 17 = 0 THEN -speed - 1 ELSE speed END AS speed,
         CASE WHEN event_id % 19 <> 0 THEN route_id END AS route_id,
         CASE WHEN event_id % 23 <> 0 THEN vehicle_id END AS vehicle_id,
         CASE WHEN event_id % 29 <> 0 THEN event_ts END AS event_ts
  FROM pos)
SELECT event_id, reasons FROM (SELECT event_id, {_reasons(POSITION_RULES)} AS reasons FROM faulty)
WHERE reasons <> ''"""
SQL["epoch_conform"] = """
SELECT event_id, ts, CASE WHEN event_id % 7 = 0 AND props IS NOT NULL THEN 'props' ELSE '' END AS rejected FROM events"""
SQL["dup_keys"] = with_(DTRIPS_ALL) + """
SELECT trip_id, COUNT(*) AS copies FROM dtrips_all GROUP BY trip_id HAVING COUNT(*) > 1"""

SQL["fk_orphans"] = with_(LI_DEDUP, DTRIPS, TRIPS_TAGGED, CLEAN_IDS, PAYMENTS, POS, ROUTES) + """
SELECT 'payments.fk_trip' AS fk, CAST(payment_id AS VARCHAR) AS orphan_key FROM payments
WHERE trip_id IS NOT NULL AND trip_id NOT IN (SELECT trip_id FROM clean_ids)
UNION ALL
SELECT 'positions.fk_vehicle', CAST(event_id AS VARCHAR) FROM pos
WHERE vehicle_id IS NOT NULL AND vehicle_id NOT IN (SELECT p_partkey FROM part)
UNION ALL
SELECT 'positions.fk_route', CAST(event_id AS VARCHAR) FROM pos
WHERE route_id IS NOT NULL AND route_id NOT IN (SELECT route_id FROM routes)"""


def _rule_counts(table: str, source: str, rules) -> str:
    parts = [
        f"SELECT '{table}.{n}' AS \"check\", CAST(SUM(CASE WHEN {c} THEN 1 ELSE 0 END) AS BIGINT) AS violations FROM {source}"
        for n, c in rules
    ]
    parts.append(
        f"SELECT '{table}.table_empty', CAST(CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END AS BIGINT) FROM {source}"
    )
    return "\nUNION ALL\n".join(parts)


SQL["dq_report"] = with_(LI_DEDUP, DTRIPS, DTRIPS_ALL, TRIPS_TAGGED, CLEAN_IDS, PAYMENTS, POS, ROUTES) + "\n" + "\nUNION ALL\n".join(
    [
        _rule_counts("trips", "dtrips_all", TRIP_RULES),
        _rule_counts("positions", "pos", POSITION_RULES),
        _rule_counts("payments", "payments", PAYMENT_RULES),
        "SELECT 'trips.duplicate_key', COUNT(*) FROM (SELECT trip_id FROM dtrips_all GROUP BY trip_id HAVING COUNT(*) > 1)",
        "SELECT 'payments.duplicate_key', COUNT(*) FROM (SELECT payment_id FROM payments GROUP BY payment_id HAVING COUNT(*) > 1)",
        "SELECT 'trips.fk_vehicle', COUNT(*) FROM dtrips_all WHERE vehicle_id IS NOT NULL AND vehicle_id NOT IN (SELECT p_partkey FROM part)",
        "SELECT 'trips.fk_route', COUNT(*) FROM dtrips_all WHERE route_id IS NOT NULL AND route_id NOT IN (SELECT s_suppkey FROM supplier)",
        "SELECT 'trips.fk_user', COUNT(*) FROM dtrips_all WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT c_custkey FROM customer)",
        "SELECT 'payments.fk_trip', COUNT(*) FROM payments WHERE trip_id IS NOT NULL AND trip_id NOT IN (SELECT trip_id FROM clean_ids)",
    ]
)


# --- calendars, keys, dimensions, lookups, facts --------------------------------

USERS = """
users AS (SELECT c_custkey AS user_id, CAST(c_nationkey AS VARCHAR) AS city, c_mktsegment AS lang
          FROM customer)"""

DIM_USER1 = f"""
dim_user1 AS (
  SELECT row_number() OVER (ORDER BY user_id) AS user_sk, user_id, city, lang,
         {AS_OF_FIRST} AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to,
         TRUE AS is_current
  FROM users)"""

USERS2 = """
users2 AS (
  SELECT user_id,
         CASE WHEN user_id % 10 = 0 THEN CAST((CAST(city AS INTEGER) + 1) % 25 AS VARCHAR) ELSE city END AS city,
         CASE WHEN user_id % 10 = 1 THEN NULL ELSE lang END AS lang
  FROM users WHERE user_id % 10 <> 2
  UNION ALL
  SELECT user_id + 1000000, city, lang FROM users WHERE user_id % 20 = 0)"""

DIM_USER2 = f"""
u_cmp AS (
  SELECT c.*, i.user_id AS i_user_id, i.city AS i_city, i.lang AS i_lang,
         (i.user_id IS NOT NULL AND (c.city IS DISTINCT FROM i.city
            OR c.lang IS DISTINCT FROM i.lang)) AS changed
  FROM dim_user1 c LEFT JOIN users2 i ON c.user_id = i.user_id),
u_new AS (
  SELECT i_user_id AS user_id, i_city AS city, i_lang AS lang FROM u_cmp WHERE changed
  UNION ALL
  SELECT user_id, city, lang FROM users2 WHERE user_id NOT IN (SELECT user_id FROM dim_user1)),
dim_user2 AS (
  SELECT user_sk, user_id, city, lang, effective_from,
         CASE WHEN changed THEN {AS_OF_SECOND} ELSE effective_to END AS effective_to,
         CASE WHEN changed THEN FALSE ELSE is_current END AS is_current
  FROM u_cmp
  UNION ALL
  SELECT (SELECT max(user_sk) FROM dim_user1) + row_number() OVER (ORDER BY user_id),
         user_id, city, lang, {AS_OF_SECOND}, CAST(NULL AS TIMESTAMP), TRUE
  FROM u_new)"""

VEHICLES = """
vehicles AS (SELECT p_partkey AS vehicle_id, p_type AS transport_type,
                    CAST(p_size AS INTEGER) AS capacity, p_brand AS vendor FROM part)"""

DIM_VEHICLE1 = """
dim_vehicle1 AS (
  SELECT row_number() OVER (ORDER BY vehicle_id) AS vehicle_sk, * FROM vehicles)"""

VEHICLES2 = """
vehicles2 AS (
  SELECT vehicle_id, transport_type,
         CAST(CASE WHEN vehicle_id % 10 = 0 THEN capacity + 10 ELSE capacity END AS INTEGER) AS capacity,
         vendor
  FROM vehicles
  UNION ALL
  SELECT vehicle_id + 1000000, transport_type, capacity, vendor FROM vehicles WHERE vehicle_id % 20 = 0)"""

DIM_STOP = """
stop_refs AS (
  SELECT DISTINCT stop_id FROM (
    SELECT start_stop_id AS stop_id FROM dtrips UNION ALL SELECT end_stop_id FROM dtrips)
  WHERE stop_id IS NOT NULL),
stop_inferred AS (SELECT row_number() OVER (ORDER BY stop_id) AS stop_sk, stop_id FROM stop_refs),
stop_feed AS (SELECT CAST(n_nationkey AS BIGINT) AS stop_id, n_name AS name FROM nation),
dim_stop AS (
  SELECT i.stop_sk, i.stop_id, f.name, CAST(NULL AS DOUBLE) AS lat, CAST(NULL AS DOUBLE) AS lon,
         CAST(NULL AS VARCHAR) AS city
  FROM stop_inferred i LEFT JOIN stop_feed f ON i.stop_id = f.stop_id
  UNION ALL
  SELECT (SELECT coalesce(max(stop_sk), 0) FROM stop_inferred) + row_number() OVER (ORDER BY f.stop_id),
         f.stop_id, f.name, NULL, NULL, NULL
  FROM stop_feed f WHERE f.stop_id NOT IN (SELECT stop_id FROM stop_inferred))"""

METHODS = """
methods AS (
  SELECT row_number() OVER (ORDER BY code) AS payment_method_sk, code FROM (
    SELECT code FROM (VALUES ('card'), ('wallet'), ('promo')) AS s(code)
    UNION SELECT o_orderpriority FROM orders))"""

FACT_TRIP = f"""
fact_trip AS (
  SELECT row_number() OVER (ORDER BY d.trip_id) AS trip_sk, d.trip_id, u.user_sk, r.route_sk,
         v.vehicle_sk, s1.stop_sk AS start_stop_sk, s2.stop_sk AS end_stop_sk, d.start_ts, d.end_ts,
         CAST(date_diff('second', d.start_ts, d.end_ts) AS INTEGER) AS duration_sec,
         CAST(d.distance_m AS DOUBLE) AS distance_m, CAST(d.fare AS DOUBLE) AS fare_amount,
         CAST(NULL AS INTEGER) AS delay_start_sec, CAST(NULL AS INTEGER) AS delay_end_sec,
         d.status, {LOAD_ID} AS load_id, {LOAD_TS} AS inserted_at
  FROM dtrips d
  LEFT JOIN dim_user1 u ON d.user_id = u.user_id
  LEFT JOIN dim_route1 r ON d.route_id = r.route_id
  LEFT JOIN dim_vehicle1 v ON d.vehicle_id = v.vehicle_id
  LEFT JOIN dim_stop s1 ON d.start_stop_id = s1.stop_id
  LEFT JOIN dim_stop s2 ON d.end_stop_id = s2.stop_id)"""

ROUTE_AS_OF = """
route_versions AS (
  SELECT route_id, route_sk,
         CASE WHEN valid_from = min(valid_from) OVER (PARTITION BY route_id) THEN NULL ELSE valid_from END AS vf,
         valid_to AS vt
  FROM dim_route2)"""

ROUTE_COLS = """route_sk, route_id, name, transport_type, CAST(base_fare AS DOUBLE) AS base_fare,
       active_flag, valid_from, valid_to, is_current"""

SQL["dim_date"] = """
WITH bounds AS (
  SELECT min(d) AS lo, max(d) AS hi FROM (
    SELECT CAST(o_orderdate AS DATE) AS d FROM orders
    UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem
    UNION ALL SELECT CAST(ts AS DATE) FROM events)),
days AS (SELECT CAST(g.generate_series AS DATE) AS d
         FROM bounds, generate_series(bounds.lo, bounds.hi, INTERVAL 1 DAY) AS g)
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, d AS full_date,
       CAST(day(d) AS SMALLINT) AS day, CAST(weekofyear(d) AS SMALLINT) AS week,
       CAST(month(d) AS SMALLINT) AS month, CAST(quarter(d) AS SMALLINT) AS quarter,
       CAST(year(d) AS INTEGER) AS year, isodow(d) >= 6 AS is_weekend
FROM days"""

SQL["dim_time"] = with_(POS) + """,
used AS (
  SELECT CAST(hour(event_ts) * 3600 + minute(event_ts) * 60 + second(event_ts) AS INTEGER) AS k, COUNT(*) AS n
  FROM pos GROUP BY 1)
SELECT CAST(d.k AS INTEGER) AS time_sk,
       lpad(CAST(d.k // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST((d.k % 3600) // 60 AS VARCHAR), 2, '0') AS hh24mi,
       CAST(d.k // 3600 AS SMALLINT) AS hour, CAST((d.k % 3600) // 60 AS SMALLINT) AS minute,
       CAST(d.k % 60 AS SMALLINT) AS second, COALESCE(u.n, 0) AS position_cnt
FROM range(86400) AS d(k) LEFT JOIN used u ON d.k = u.k"""

SQL["surrogate_keys"] = with_(USERS) + """
SELECT row_number() OVER (ORDER BY user_id) AS user_sk, user_id, city, lang FROM users"""

SQL["scd1_upsert"] = with_(VEHICLES, DIM_VEHICLE1, VEHICLES2) + """
SELECT c.vehicle_sk, i.vehicle_id, i.transport_type, i.capacity, i.vendor
FROM vehicles2 i JOIN dim_vehicle1 c ON i.vehicle_id = c.vehicle_id
UNION ALL
SELECT vehicle_sk, vehicle_id, transport_type, capacity, vendor FROM dim_vehicle1
WHERE vehicle_id NOT IN (SELECT vehicle_id FROM vehicles2)
UNION ALL
SELECT (SELECT max(vehicle_sk) FROM dim_vehicle1) + row_number() OVER (ORDER BY vehicle_id),
       vehicle_id, transport_type, capacity, vendor
FROM vehicles2 WHERE vehicle_id NOT IN (SELECT vehicle_id FROM dim_vehicle1)"""

SQL["insert_if_absent"] = """
WITH existing AS (
  SELECT row_number() OVER (ORDER BY o_orderkey) AS payment_sk, o_orderkey AS payment_id,
         'batch_1' AS load_id
  FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00')
SELECT * FROM existing
UNION ALL
SELECT (SELECT coalesce(max(payment_sk), 0) FROM existing) + row_number() OVER (ORDER BY o_orderkey),
       o_orderkey, 'batch_2'
FROM orders WHERE o_orderkey NOT IN (SELECT payment_id FROM existing)"""

SQL["inferred_stops"] = with_(LI_DEDUP, DTRIPS, DIM_STOP) + " SELECT * FROM dim_stop"

SQL["scd2_initial"] = with_(ROUTES, DIM_ROUTE1) + f" SELECT {ROUTE_COLS} FROM dim_route1"

SQL["scd2_merge"] = with_(ROUTES, DIM_ROUTE1, ROUTES2, DIM_ROUTE2) + f" SELECT {ROUTE_COLS} FROM dim_route2"

# The second date once more: +1 on the fare of keys ending in 0, 1 or 3. Keys
# ending in 0 or 1 opened their version on that date (corrected in place), so
# do the new ones; a version that was not opened then is closed.
SQL["scd2_same_date"] = with_(ROUTES, DIM_ROUTE1, ROUTES2, DIM_ROUTE2) + f""",
again AS (
  SELECT route_id, name, transport_type,
         CASE WHEN route_id % 10 < 4 THEN CAST(base_fare + 1 AS DECIMAL(12,2)) ELSE base_fare END AS base_fare
  FROM routes2),
cmp AS (
  SELECT c.*, i.base_fare AS new_fare, i.name AS new_name,
         c.is_current AND i.route_id IS NOT NULL AND (c.base_fare IS DISTINCT FROM i.base_fare
           OR c.name IS DISTINCT FROM i.name) AS differs
  FROM dim_route2 c LEFT JOIN again i ON c.route_id = i.route_id),
opened AS (
  SELECT route_id, new_name AS name, transport_type, new_fare AS base_fare FROM cmp
  WHERE differs AND valid_from <> {AS_OF_SECOND})
SELECT route_sk, route_id, name, transport_type,
       CAST(CASE WHEN differs AND valid_from = {AS_OF_SECOND} THEN new_fare ELSE base_fare END AS DOUBLE) AS base_fare,
       active_flag, valid_from,
       CASE WHEN differs AND valid_from <> {AS_OF_SECOND} THEN {AS_OF_SECOND} ELSE valid_to END AS valid_to,
       is_current AND NOT (differs AND valid_from <> {AS_OF_SECOND}) AS is_current
FROM cmp
UNION ALL
SELECT (SELECT max(route_sk) FROM dim_route2) + row_number() OVER (ORDER BY route_id),
       route_id, name, transport_type, CAST(base_fare AS DOUBLE), TRUE, {AS_OF_SECOND}, NULL, TRUE
FROM opened"""

SQL["scd2_changes"] = with_(ROUTES, DIM_ROUTE1, ROUTES2, DIM_ROUTE2) + f"""
SELECT {ROUTE_COLS}, change FROM dim_route2 WHERE change IN ('closed', 'new')"""

SQL["scd2_validity"] = with_(ROUTES, DIM_ROUTE1, ROUTES2, DIM_ROUTE2) + """,
d AS (SELECT route_id, valid_from AS vf, valid_to AS vt, is_current AS cur FROM dim_route2),
per_key AS (SELECT route_id, SUM(CASE WHEN vt IS NULL THEN 1 ELSE 0 END) AS opens,
                   max(vf) AS latest, max(CASE WHEN vt IS NULL THEN vf END) AS open_start
            FROM d GROUP BY route_id)
SELECT 'empty_interval' AS rule,
       CAST(COALESCE(SUM(CASE WHEN vt IS NOT NULL AND vt <= vf THEN 1 ELSE 0 END), 0) AS BIGINT) AS violations FROM d
UNION ALL SELECT 'flag_mismatch',
       CAST(COALESCE(SUM(CASE WHEN (vt IS NULL) <> COALESCE(cur, FALSE) THEN 1 ELSE 0 END), 0) AS BIGINT) FROM d
UNION ALL SELECT 'duplicate_start', CAST(COALESCE(SUM(CASE WHEN n > 1 THEN n END), 0) AS BIGINT)
       FROM (SELECT route_id, vf, COUNT(*) AS n FROM d GROUP BY route_id, vf)
UNION ALL SELECT 'duplicate_end', CAST(COALESCE(SUM(CASE WHEN n > 1 THEN n END), 0) AS BIGINT)
       FROM (SELECT route_id, vt, COUNT(*) AS n FROM d WHERE vt IS NOT NULL GROUP BY route_id, vt)
UNION ALL SELECT 'dangling_end', CAST(COUNT(*) AS BIGINT) FROM d e
       WHERE e.vt IS NOT NULL AND NOT EXISTS (SELECT 1 FROM d s WHERE s.route_id = e.route_id AND s.vf = e.vt)
UNION ALL SELECT 'open_count', CAST(COALESCE(SUM(CASE WHEN opens <> 1 THEN 1 END), 0) AS BIGINT) FROM per_key
UNION ALL SELECT 'open_not_latest',
       CAST(COALESCE(SUM(CASE WHEN opens >= 1 AND open_start IS DISTINCT FROM latest THEN 1 END), 0) AS BIGINT)
       FROM per_key"""

SQL["scd2_user"] = with_(USERS, DIM_USER1, USERS2, DIM_USER2) + " SELECT * FROM dim_user2"

EVENT_ROUTES = """
ev AS (SELECT event_id, user_id % 100 AS route_id, ts AS event_ts FROM events)"""

SQL["lookup_current"] = with_(ROUTES, DIM_ROUTE1, ROUTES2, DIM_ROUTE2, EVENT_ROUTES) + """
SELECT e.event_id, e.route_id, d.route_sk
FROM ev e LEFT JOIN (SELECT route_id, route_sk FROM dim_route2 WHERE is_current) d
  ON e.route_id = d.route_id"""

SQL["lookup_as_of"] = with_(ROUTES, DIM_ROUTE1, ROUTES2, DIM_ROUTE2, ROUTE_AS_OF, EVENT_ROUTES) + """
SELECT e.event_id, e.route_id, v.route_sk
FROM ev e LEFT JOIN route_versions v
  ON e.route_id = v.route_id AND (v.vf IS NULL OR e.event_ts >= v.vf)
 AND (v.vt IS NULL OR e.event_ts < v.vt)"""

SQL["payment_method_lookup"] = with_(METHODS) + """
SELECT o.o_orderkey AS payment_id, o.o_orderpriority AS payment_method, m.payment_method_sk
FROM orders o LEFT JOIN methods m ON o.o_orderpriority = m.code"""

SQL["payment_trip_link"] = with_(LI_DEDUP, DTRIPS, PAYMENTS) + """
SELECT p.payment_id, p.trip_id, t.trip_sk
FROM payments p LEFT JOIN (
  SELECT trip_id, row_number() OVER (ORDER BY trip_id) AS trip_sk FROM dtrips) t
  ON p.trip_id = t.trip_id"""

SQL["stop_lookup"] = with_(LI_DEDUP, DTRIPS, DIM_STOP) + """
SELECT d.trip_id, d.start_stop_id, d.end_stop_id, s1.stop_sk AS start_stop_sk, s2.stop_sk AS end_stop_sk
FROM dtrips d LEFT JOIN dim_stop s1 ON d.start_stop_id = s1.stop_id
LEFT JOIN dim_stop s2 ON d.end_stop_id = s2.stop_id"""

SQL["fact_trip"] = with_(
    LI_DEDUP, DTRIPS, USERS, DIM_USER1, ROUTES, DIM_ROUTE1, VEHICLES, DIM_VEHICLE1, DIM_STOP, FACT_TRIP
) + " SELECT * FROM fact_trip"

SQL["fact_payment"] = with_(
    LI_DEDUP, DTRIPS, USERS, DIM_USER1, ROUTES, DIM_ROUTE1, VEHICLES, DIM_VEHICLE1, DIM_STOP,
    FACT_TRIP, PAYMENTS, METHODS,
) + f"""
SELECT row_number() OVER (ORDER BY p.payment_id) AS payment_sk, p.payment_id, u.user_sk, r.route_sk,
       t.trip_sk, m.payment_method_sk, CAST(p.amount AS DOUBLE) AS amount, p.currency, p.status,
       p.paid_at, {LOAD_ID} AS load_id, {LOAD_TS} AS inserted_at
FROM payments p
LEFT JOIN dim_user1 u ON p.user_id = u.user_id
LEFT JOIN dim_route1 r ON p.route_id = r.route_id
LEFT JOIN methods m ON p.payment_method = m.code
LEFT JOIN fact_trip t ON p.trip_id = t.trip_id"""

SQL["fact_vehicle_position"] = with_(
    ROUTES, DIM_ROUTE1, ROUTES2, DIM_ROUTE2, ROUTE_AS_OF, VEHICLES, DIM_VEHICLE1, POS
) + f"""
SELECT p.event_ts, CAST(strftime(p.event_ts, '%Y%m%d') AS INTEGER) AS event_date_sk,
       CAST(hour(p.event_ts) * 3600 + minute(p.event_ts) * 60 + second(p.event_ts) AS INTEGER) AS event_time_sk,
       v.vehicle_sk, rv.route_sk, CAST(p.lat AS DOUBLE) AS lat, CAST(p.lon AS DOUBLE) AS lon,
       CAST(p.speed AS DOUBLE) AS speed, CAST(p.heading AS DOUBLE) AS heading, p.provider_ts,
       {LOAD_ID} AS load_id, {LOAD_TS} AS inserted_at
FROM pos p
LEFT JOIN route_versions rv ON p.route_id = rv.route_id AND (rv.vf IS NULL OR p.event_ts >= rv.vf)
 AND (rv.vt IS NULL OR p.event_ts < rv.vt)
LEFT JOIN dim_vehicle1 v ON p.vehicle_id = v.vehicle_id"""


# --- streaming -------------------------------------------------------------------

SQL["stream_route_speed"] = with_(POS) + """
SELECT route_id, date_trunc('hour', event_ts) AS window_start,
       date_trunc('hour', event_ts) + INTERVAL 1 HOUR AS window_end,
       CAST(SUM(speed) AS DOUBLE) / COUNT(speed) AS avg_speed, COUNT(*) AS position_cnt
FROM pos GROUP BY 1, 2, 3"""

SQL["stream_dedupe"] = with_(POS) + """
SELECT event_id, vehicle_id, route_id, event_ts, CAST(speed AS DOUBLE) AS speed FROM pos
QUALIFY row_number() OVER (PARTITION BY vehicle_id, event_ts ORDER BY event_id) = 1"""

SQL["stream_position_facts"] = SQL["fact_vehicle_position"]


# --- file round trips --------------------------------------------------------------

SQL["parquet_partition_roundtrip"] = with_(ROUTES, DIM_ROUTE1, HTRIPS, POS, MART1) + """
SELECT *, CAST(hour_bucket AS DATE) AS dt FROM mart
WHERE hour_bucket >= TIMESTAMP '2024-01-08 00:00:00' AND hour_bucket < TIMESTAMP '2024-01-12 00:00:00'"""

SQL["raw_landing_roundtrip"] = with_(POS) + """
SELECT event_ts, CAST(vehicle_id AS VARCHAR) AS vehicle_id, CAST(route_id AS VARCHAR) AS route_id,
       CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon, CAST(speed AS DOUBLE) AS speed,
       CAST(heading AS DOUBLE) AS heading, provider_ts, payload
FROM pos"""

SQL["staging_load"] = with_(PAYMENTS) + f"""
SELECT CAST(payment_id AS VARCHAR) AS payment_id, CAST(user_id AS VARCHAR) AS user_id,
       CAST(route_id AS VARCHAR) AS route_id, trip_id, CAST(amount AS DOUBLE) AS amount, currency,
       status, payment_method, paid_at, {LOAD_ID} AS load_id, {LOAD_TS} AS ingestion_ts,
       DATE '2024-02-01' AS load_dt
FROM payments"""


# --- JSON payload and set membership ----------------------------------------------

SQL["payload_fields"] = with_(POS) + """
SELECT event_id, json_extract_string(payload, '$.k') AS k_text,
       CAST(json_extract(payload, '$.k') AS INTEGER) AS k
FROM pos"""

SQL["changed_route_positions"] = with_(ROUTES, DIM_ROUTE1, ROUTES2, DIM_ROUTE2, POS) + """
SELECT event_id, route_id FROM pos
WHERE route_id IN (SELECT route_id FROM dim_route2 WHERE change = 'closed')"""


# --- the mart over route versions ---------------------------------------------------

SQL["mart_route_versions"] = with_(ROUTES, DIM_ROUTE1, ROUTES2, DIM_ROUTE2, ROUTE_AS_OF, HTRIPS, POS) + f""",
tv AS (
  SELECT h.trip_id, r.route_id, r.name, r.transport_type, h.start_ts, h.fare AS fare_amount,
         h.duration_sec, h.distance_m
  FROM htrips h
  JOIN route_versions v ON h.route_id = v.route_id AND (v.vf IS NULL OR h.start_ts >= v.vf)
   AND (v.vt IS NULL OR h.start_ts < v.vt)
  JOIN dim_route2 r ON v.route_sk = r.route_sk
  WHERE h.start_ts >= {MART_FROM} AND h.start_ts < {MART_TO}),
thv AS (
  SELECT route_id, name, transport_type, date_trunc('hour', start_ts) AS hour_bucket,
         COUNT(DISTINCT trip_id) AS trip_cnt,
         CAST(SUM(fare_amount) AS DOUBLE) / COUNT(fare_amount) AS avg_fare,
         CAST(SUM(CAST(duration_sec AS BIGINT)) AS DOUBLE) / COUNT(duration_sec) AS avg_duration_sec,
         CAST(SUM(distance_m) AS DOUBLE) AS sum_distance_m
  FROM tv GROUP BY 1, 2, 3, 4),
pv AS (
  SELECT r.route_id, p.event_ts, p.speed
  FROM pos p
  JOIN route_versions v ON p.route_id = v.route_id AND (v.vf IS NULL OR p.event_ts >= v.vf)
   AND (v.vt IS NULL OR p.event_ts < v.vt)
  JOIN dim_route2 r ON v.route_sk = r.route_sk
  WHERE p.event_ts >= {MART_FROM} AND p.event_ts < {MART_TO}),
shv AS (
  SELECT route_id, date_trunc('hour', event_ts) AS hour_bucket,
         CAST(SUM(speed) AS DOUBLE) / COUNT(speed) AS avg_speed
  FROM pv GROUP BY 1, 2)
SELECT th.route_id, th.hour_bucket, th.name, th.transport_type, th.trip_cnt, th.avg_fare,
       th.avg_duration_sec, th.sum_distance_m, COALESCE(sh.avg_speed, 0.0) AS avg_speed,
       {MART_TO} AS snapshot_ts
FROM thv th LEFT JOIN shv sh ON th.route_id = sh.route_id AND th.hour_bucket = sh.hour_bucket"""


SQL["mart_current_only"] = with_(ROUTES, DIM_ROUTE1, ROUTES2, DIM_ROUTE2, HTRIPS, POS) + f""",
cur AS (SELECT route_sk, route_id, name, transport_type FROM dim_route2 WHERE is_current),
tc AS (
  SELECT h.trip_id, c.route_id, c.name, c.transport_type, h.start_ts, h.fare AS fare_amount,
         h.duration_sec, h.distance_m
  FROM htrips h JOIN dim_route1 r1 ON h.route_id = r1.route_id
  JOIN cur c ON r1.route_sk = c.route_sk
  WHERE h.start_ts >= {MART_FROM} AND h.start_ts < {MART_TO}),
thc AS (
  SELECT route_id, name, transport_type, date_trunc('hour', start_ts) AS hour_bucket,
         COUNT(DISTINCT trip_id) AS trip_cnt,
         CAST(SUM(fare_amount) AS DOUBLE) / COUNT(fare_amount) AS avg_fare,
         CAST(SUM(CAST(duration_sec AS BIGINT)) AS DOUBLE) / COUNT(duration_sec) AS avg_duration_sec,
         CAST(SUM(distance_m) AS DOUBLE) AS sum_distance_m
  FROM tc GROUP BY 1, 2, 3, 4),
pc AS (
  SELECT c.route_id, p.event_ts, p.speed
  FROM pos p JOIN dim_route1 r1 ON p.route_id = r1.route_id
  JOIN cur c ON r1.route_sk = c.route_sk
  WHERE p.event_ts >= {MART_FROM} AND p.event_ts < {MART_TO}),
shc AS (
  SELECT route_id, date_trunc('hour', event_ts) AS hour_bucket,
         CAST(SUM(speed) AS DOUBLE) / COUNT(speed) AS avg_speed
  FROM pc GROUP BY 1, 2)
SELECT th.route_id, th.hour_bucket, th.name, th.transport_type, th.trip_cnt, th.avg_fare,
       th.avg_duration_sec, th.sum_distance_m, COALESCE(sh.avg_speed, 0.0) AS avg_speed,
       {MART_TO} AS snapshot_ts
FROM thc th LEFT JOIN shc sh ON th.route_id = sh.route_id AND th.hour_bucket = sh.hour_bucket"""


# --- the batch run over two dates -----------------------------------------------------

# Day 2 repeats every trip and payment, so a key loaded on day 1 stays as it
# was; rules come before the dedupe, so a key is there if one copy is clean.
# Payments: amounts of ids with remainder 3 by 25 do not cast on day 2.
SQL["batch_run"] = with_(ROUTES, DIM_ROUTE1, ROUTES2, DIM_ROUTE2, USERS, DIM_USER1, USERS2, DIM_USER2, VEHICLES,
                         VEHICLES2, DTRIPS_ALL, PAYMENTS, POS) + """,
sent_trips AS (
  SELECT 1 AS day, trip_id, user_id, route_id, start_ts, end_ts, distance_m, fare, start_stop_id, end_stop_id
  FROM dtrips_all WHERE start_ts < TIMESTAMP '1998-01-01'
  UNION ALL
  SELECT 2, trip_id, user_id, route_id, start_ts + INTERVAL 1 DAY, end_ts, distance_m, fare, start_stop_id, end_stop_id
  FROM dtrips_all),
tagged AS (SELECT *, """ + _reasons(TRIP_RULES) + """ AS reasons FROM sent_trips),
ok_trips AS (SELECT * FROM tagged WHERE reasons = ''),
first_loaded AS (SELECT trip_id, min(day) AS day FROM ok_trips GROUP BY 1),
trip_route AS (
  SELECT t.trip_id, max_by(t.route_id, t.end_ts) AS route_id
  FROM ok_trips t JOIN first_loaded f ON t.trip_id = f.trip_id AND t.day = f.day GROUP BY 1),
day1_pay AS (SELECT * FROM payments WHERE paid_at < TIMESTAMP '1998-01-01'),
day2_pay AS (SELECT * FROM payments WHERE payment_id % 25 <> 3),
paid AS (
  SELECT payment_id, trip_id, 1 AS day, paid_at, payment_method FROM day1_pay
  UNION ALL
  SELECT payment_id, trip_id, 2, CASE WHEN payment_id % 10 <> 0 THEN paid_at END, payment_method FROM day2_pay
  WHERE payment_id NOT IN (SELECT payment_id FROM day1_pay)),
codes AS (
  SELECT payment_method AS code FROM day1_pay UNION SELECT payment_method FROM day2_pay
  UNION SELECT unnest(['card', 'wallet', 'promo'])),
day_pos AS (SELECT DISTINCT vehicle_id, event_ts FROM pos),
clean2_pay AS (SELECT CASE WHEN payment_id % 10 <> 0 THEN paid_at END AS paid_at FROM day2_pay),
spans AS (
  SELECT min(d) AS lo, max(d) AS hi FROM (
    SELECT CAST(start_ts AS DATE) AS d FROM ok_trips WHERE day = 1
    UNION ALL SELECT CAST(paid_at AS DATE) FROM day1_pay
    UNION ALL SELECT CAST(event_ts AS DATE) FROM pos)
  UNION ALL
  SELECT min(d), max(d) FROM (
    SELECT CAST(start_ts AS DATE) AS d FROM ok_trips WHERE day = 2
    UNION ALL SELECT CAST(paid_at AS DATE) FROM clean2_pay)),
dates AS (SELECT DISTINCT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM spans),
stops AS (SELECT start_stop_id AS s FROM ok_trips UNION SELECT end_stop_id FROM ok_trips),
veh AS (SELECT vehicle_id FROM vehicles UNION SELECT vehicle_id FROM vehicles2)
SELECT 'dim_route' AS table_name, COUNT(*) AS row_cnt, COUNT(DISTINCT route_id) AS key_cnt,
       CAST(max(route_sk) AS BIGINT) AS top_sk, CAST(NULL AS BIGINT) AS linked_cnt FROM dim_route2
UNION ALL SELECT 'dim_user', COUNT(*), COUNT(DISTINCT user_id), max(user_sk), NULL FROM dim_user2
UNION ALL SELECT 'dim_vehicle', COUNT(*), COUNT(DISTINCT vehicle_id), COUNT(*), NULL FROM veh
UNION ALL SELECT 'dim_stop', COUNT(s), COUNT(DISTINCT s), COUNT(s), NULL FROM stops
UNION ALL SELECT 'dim_payment_method', COUNT(code), COUNT(code), COUNT(code), NULL FROM codes
UNION ALL SELECT 'dim_date', COUNT(d), COUNT(DISTINCT d), NULL, NULL FROM dates
UNION ALL SELECT 'dim_time', 86400, 86400, NULL, NULL
UNION ALL SELECT 'fact_trip', COUNT(*), COUNT(DISTINCT trip_id), COUNT(*), COUNT(r.route_id)
  FROM trip_route t LEFT JOIN routes r ON t.route_id = r.route_id
UNION ALL SELECT 'fact_payment', COUNT(*), COUNT(DISTINCT payment_id), COUNT(*), COUNT(f.trip_id)
  FROM paid p LEFT JOIN first_loaded f ON p.trip_id = f.trip_id AND f.day <= p.day
UNION ALL SELECT 'fact_vehicle_position', COUNT(*), COUNT(DISTINCT event_ts), NULL, COUNT(r.route_id)
  FROM day_pos p LEFT JOIN routes r ON p.vehicle_id % 100 = r.route_id
UNION ALL SELECT 'quarantine.payments', COUNT(*), COUNT(DISTINCT payment_id), NULL, NULL
  FROM payments WHERE payment_id % 25 = 3
UNION ALL SELECT 'quarantine_rules.routes', COUNT(*), 0, NULL, NULL FROM routes WHERE route_id % 50 = 0
UNION ALL SELECT 'quarantine_rules.trips', COUNT(*), COUNT(DISTINCT trip_id), NULL, NULL FROM tagged WHERE reasons <> ''
UNION ALL SELECT 'quarantine_rules.payments', COUNT(*), COUNT(DISTINCT trip_id), NULL, NULL
  FROM payments WHERE payment_id % 50 = 0"""

# --- stores: key index, segments, corrections, states ---------------------------

SQL["fact_key_index"] = with_(LI_DEDUP, DTRIPS, PAYMENTS) + """,
numbered AS (SELECT trip_id, row_number() OVER (ORDER BY trip_id) AS trip_sk FROM dtrips)
SELECT p.payment_id, p.paid_at >= TIMESTAMP '1998-01-01' AS inserted, n.trip_sk
FROM payments p LEFT JOIN numbered n ON p.trip_id = n.trip_id"""

SQL["scd2_segments"] = SQL["scd2_same_date"]
SQL["lookup_as_of_sweep"] = SQL["lookup_as_of"]
SQL["mart_incremental"] = SQL["mart_route_hourly"]

SQL["mart_daily"] = with_(ROUTES, DIM_ROUTE1, VEHICLES, HTRIPS, POS, MART1) + """,
rides AS (
  SELECT route_id, name, transport_type, CAST(start_ts AS DATE) AS day, COUNT(DISTINCT trip_id) AS trip_cnt,
         CAST(SUM(fare_amount) AS DOUBLE) / COUNT(fare_amount) AS avg_fare,
         CAST(SUM(CAST(duration_sec AS BIGINT)) AS DOUBLE) / COUNT(duration_sec) AS avg_duration_sec,
         CAST(SUM(distance_m) AS DOUBLE) AS sum_distance_m
  FROM t GROUP BY 1, 2, 3, 4),
moves AS (
  SELECT r.route_id, CAST(p.event_ts AS DATE) AS day, CAST(SUM(p.speed) AS DOUBLE) / COUNT(p.speed) AS avg_speed,
         COUNT(DISTINCT v.vehicle_id) AS vehicle_cnt
  FROM pos p JOIN dim_route1 r ON p.route_id = r.route_id LEFT JOIN vehicles v ON p.vehicle_id = v.vehicle_id
  WHERE p.event_ts >= """ + MART_FROM + " AND p.event_ts < " + MART_TO + """ GROUP BY 1, 2)
SELECT rides.*, coalesce(m.avg_speed, 0.0) AS avg_speed, coalesce(m.vehicle_cnt, 0) AS vehicle_cnt
FROM rides LEFT JOIN moves m ON rides.route_id = m.route_id AND rides.day = m.day"""

SQL["staging_dispositions"] = with_(DTRIPS_ALL) + """,
tagged AS (
  SELECT trip_id, CAST(route_id AS VARCHAR) AS route_id, CAST(fare AS DOUBLE) AS fare,
         CAST(split_part(trip_id, '-', 1) AS BIGINT) % 25 = 3 AS broken, """ + _reasons(TRIP_RULES) + """ AS reasons
  FROM dtrips_all)
SELECT trip_id, route_id, fare,
       CASE WHEN broken THEN 'uncastable' WHEN reasons <> '' THEN 'rejected' ELSE 'clean' END AS disposition,
       array_to_string(list_sort(list_filter(string_split(reasons, ','), lambda x: x <> '')), ',') AS reasons,
       CASE WHEN broken THEN 'distance_m' ELSE '' END AS lost
FROM tagged"""

# Corrected fares, deleted trips; a key stays with the load that brought it.
CORRECTED = HTRIPS.replace("htrips AS", "landed AS", 1) + """,
htrips AS (
  SELECT * REPLACE (CASE WHEN trip_id % 6 = 0 THEN CAST(fare + 1 AS DECIMAL(12,2)) ELSE fare END AS fare)
  FROM landed WHERE trip_id % 14 <> 0)"""

SQL["batch_corrections"] = with_(ROUTES, DIM_ROUTE1, CORRECTED, POS, MART1) + """
SELECT 'mart' AS fact, strftime(hour_bucket, '%Y-%m-%d %H') AS key, CAST(route_id AS VARCHAR) AS route_id,
       sum_distance_m AS amount, CAST(hour_bucket AS DATE) AS day, CAST(trip_cnt AS VARCHAR) AS linked, NULL AS load_id
FROM mart
UNION ALL
SELECT 'trip' AS fact, CAST(h.trip_id AS VARCHAR) AS key, CAST(r.route_id AS VARCHAR) AS route_id,
       CAST(h.fare AS DOUBLE) AS amount, CAST(h.start_ts AS DATE) AS day, CAST(NULL AS VARCHAR) AS linked,
       CASE WHEN h.trip_id % 2 = 0 THEN 'batch_2024-01-01' ELSE 'batch_2024-01-15' END AS load_id
FROM htrips h LEFT JOIN routes r ON h.route_id = r.route_id
UNION ALL
SELECT 'payment', CAST(l.trip_id AS VARCHAR), CAST(r.route_id AS VARCHAR), CAST(l.fare AS DOUBLE),
       CAST(l.end_ts AS DATE), CAST(h.trip_id AS VARCHAR), 'batch_2024-01-01'
FROM landed l LEFT JOIN routes r ON l.route_id = r.route_id LEFT JOIN htrips h ON l.trip_id = h.trip_id"""

SQL["batch_mart_run"] = SQL["mart_route_hourly"]

SQL["declared_landing"] = """
SELECT o_orderkey AS payment_id, CASE WHEN o_orderkey % 4 <> 1 THEN o_custkey END AS user_id,
       CAST(CASE WHEN o_orderkey % 4 = 1 THEN CAST(CAST(o_totalprice AS DECIMAL(11,1)) AS DECIMAL(12,2))
                 ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS DOUBLE) AS amount,
       CAST(o_orderdate AS TIMESTAMP) AS paid_at, CASE WHEN o_orderkey % 4 = 2 THEN o_orderstatus END AS note
FROM orders WHERE o_orderkey % 4 <> 3"""
