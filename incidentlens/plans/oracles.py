"""SQL equivalents of the registered queries, for DuckDB on the same tables.

Percentages are rounded with integer arithmetic, half away from zero, because
that is exact; see `pct`."""

from __future__ import annotations


def pct(part: str, whole: str, places: int = 2) -> str:
    """100*part/whole rounded half away from zero, for integers, whole > 0."""
    scale = 10**places
    top = f"CAST(abs(({part})) AS HUGEINT) * {200 * scale} + ({whole})"
    return f"(sign({part}) * (({top}) // (2 * ({whole}))) / {float(scale)}::DOUBLE)"


def count_if(p: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {p}) AS BIGINT)"


E_BASE = """
k AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
e AS (
  SELECT CAST(event_id AS VARCHAR) AS id, ts AS date, CAST(ts AS DATE) AS incident_date,
    'IC' || lpad(CAST(event_id AS VARCHAR), 9, '0') AS case_number,
    CASE WHEN k % 10 = 9 THEN 'OTHER OFFENSE'
         WHEN event_type = 'click' THEN 'THEFT' WHEN event_type = 'view' THEN 'BATTERY'
         WHEN event_type = 'purchase' THEN 'NARCOTICS' WHEN event_type = 'signup' THEN 'BURGLARY'
         WHEN event_type = 'error' THEN 'ASSAULT' END AS primary_type,
    event_type AS description,
    CASE event_id % 6 WHEN 0 THEN 'STREET' WHEN 1 THEN 'RESIDENCE' WHEN 2 THEN 'APARTMENT'
         WHEN 3 THEN 'RETAIL STORE' WHEN 4 THEN 'AIRPORT' END AS location_description,
    k % 4 = 0 AS arrest, k % 5 = 0 AS domestic,
    CAST(user_id AS VARCHAR) AS beat, lpad(CAST(user_id % 25 AS VARCHAR), 3, '0') AS district,
    CAST(user_id % 50 AS VARCHAR) AS ward, CAST(user_id % 77 AS VARCHAR) AS community_area,
    CASE WHEN event_id % 101 = 0 THEN NULL
         ELSE 41.65e0 + (user_id % 7) * 0.06e0 + ((event_id * 37) % 100) / 10000e0
              + CASE WHEN event_id % 97 = 0 THEN 1e0 ELSE 0e0 END END AS latitude,
    -87.85e0 + (user_id % 5) * 0.07e0 + ((event_id * 53) % 100) / 10000e0 AS longitude,
    event_id, user_id
  FROM k),
f AS (
  SELECT *, hour(date) AS hour, isodow(date) - 1 AS day_of_week,
    isodow(date) >= 6 AS is_weekend,
    CASE WHEN month(date) IN (12, 1, 2) THEN 'Winter' WHEN month(date) <= 5 THEN 'Spring'
         WHEN month(date) <= 8 THEN 'Summer' ELSE 'Fall' END AS season,
    CASE WHEN hour(date) <= 6 THEN 'Night' WHEN hour(date) <= 12 THEN 'Morning'
         WHEN hour(date) <= 18 THEN 'Afternoon' ELSE 'Evening' END AS time_period,
    CASE WHEN location_description IN ('RESIDENCE', 'APARTMENT') THEN 'Indoor'
         WHEN location_description = 'STREET' THEN 'Outdoor'
         WHEN location_description = 'RETAIL STORE' THEN 'Commercial' ELSE 'Other' END AS location_type,
    CASE WHEN primary_type IN ('BATTERY', 'ASSAULT') THEN 'Violent'
         WHEN primary_type IN ('THEFT', 'BURGLARY') THEN 'Property'
         WHEN primary_type = 'NARCOTICS' THEN 'Drug' ELSE 'Other' END AS crime_category,
    primary_type IN ('BATTERY', 'ASSAULT') AS is_violent_crime,
    primary_type IN ('THEFT', 'BURGLARY') AS is_property_crime,
    primary_type = 'NARCOTICS' AS is_drug_crime,
    latitude IS NOT NULL AND longitude IS NOT NULL AS has_coordinates,
    CAST(district AS DOUBLE) AS district_num, CAST(beat AS DOUBLE) AS beat_num,
    CAST(ward AS DOUBLE) AS ward_num, CAST(community_area AS DOUBLE) AS community_area_num,
    2 * 3959e0 * asin(sqrt(
      pow(sin((radians(41.8781e0) - radians(latitude)) / 2), 2)
      + cos(radians(latitude)) * cos(radians(41.8781e0))
        * pow(sin((radians(-87.6298e0) - radians(longitude)) / 2), 2))) AS distance_from_center
  FROM e),
located AS (
  SELECT * FROM f WHERE latitude BETWEEN 41.6e0 AND 42.1e0 AND longitude BETWEEN -87.9e0 AND -87.5e0)
"""

O_BASE = """
o AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderdate AS date, CAST(o_orderdate AS DATE) AS incident_date,
    CAST(year(o_orderdate) AS BIGINT) AS year, o_orderpriority AS primary_type,
    o_orderstatus = 'F' AS arrest, o_orderstatus = 'P' AS domestic
  FROM orders)
"""

GRID = """
b AS (SELECT min(latitude) AS lat0, max(latitude) AS lat1, min(longitude) AS lon0, max(longitude) AS lon1 FROM located),
binned AS (
  SELECT located.*,
    CASE WHEN latitude > lat0 THEN least(CAST(ceil((latitude - lat0) / ((lat1 - lat0) / 49)) AS BIGINT) - 1, 48) END AS lat_bin,
    CASE WHEN longitude > lon0 THEN least(CAST(ceil((longitude - lon0) / ((lon1 - lon0) / 49)) AS BIGINT) - 1, 48) END AS lon_bin
  FROM located, b),
per_cell AS (
  SELECT lat_bin, lon_bin, CAST(sum(n) AS BIGINT) AS grid_crime_count, max(n) AS crimes_same_location_24h
  FROM (SELECT lat_bin, lon_bin, incident_date, count(*) AS n FROM binned
        WHERE lat_bin IS NOT NULL AND lon_bin IS NOT NULL GROUP BY ALL) GROUP BY ALL),
gridded AS (
  SELECT binned.*, grid_crime_count, crimes_same_location_24h,
    sqrt(pow(latitude - 41.8781e0, 2) + pow(longitude + 87.6298e0, 2)) * 69 AS distance_to_hotspot_1,
    sqrt(pow(latitude - 41.8369e0, 2) + pow(longitude + 87.6847e0, 2)) * 69 AS distance_to_hotspot_2,
    sqrt(pow(latitude - 41.7687e0, 2) + pow(longitude + 87.6746e0, 2)) * 69 AS distance_to_hotspot_3
  FROM binned LEFT JOIN per_cell USING (lat_bin, lon_bin))
"""

BLOBS = """
blob AS (SELECT *, CAST((user_id % 7) * 5 + user_id % 5 AS BIGINT) AS cluster_id FROM gridded),
profile AS (
  SELECT cluster_id, count(*) AS size, avg(latitude) AS center_lat, avg(longitude) AS center_lon,
    stddev_samp(latitude) AS lat_std, stddev_samp(longitude) AS lon_std,
    avg(CAST(is_violent_crime AS DOUBLE)) AS violent_crime_ratio,
    avg(CAST(is_property_crime AS DOUBLE)) AS property_crime_ratio,
    avg(distance_from_center) AS avg_distance_from_center,
    avg(CAST(is_weekend AS DOUBLE)) AS weekend_ratio,
    mode() WITHIN GROUP (ORDER BY primary_type) AS top_crime_type,
    mode() WITHIN GROUP (ORDER BY hour) AS peak_hour,
    round(100 * (0.3e0 * least(count(*) / 100e0, 1e0)
      + 0.4e0 * 2 * avg(CAST(is_violent_crime AS DOUBLE))
      + 0.2e0 * (avg(grid_crime_count) / max(grid_crime_count))), 2) AS risk_score
  FROM blob GROUP BY cluster_id),
hot AS (
  SELECT cluster_id, CASE WHEN cluster_id % 2 = 0 THEN 'K-means' ELSE 'DBSCAN' END AS model_type,
    risk_score, size AS cluster_size, top_crime_type FROM profile)
"""

SERIES = """
daily AS (
  SELECT primary_type AS series_id, incident_date AS date, count(*) AS n FROM o GROUP BY ALL
  UNION ALL SELECT 'ALL', incident_date, count(*) FROM o GROUP BY ALL),
span AS (SELECT series_id, min(date) AS lo, max(date) AS hi FROM daily GROUP BY series_id),
spine AS (
  SELECT series_id, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
  FROM span),
series AS (
  SELECT series_id, date, CAST(coalesce(n, 0) AS DOUBLE) AS y FROM spine LEFT JOIN daily USING (series_id, date))
"""


def with_e(body: str, *more: str) -> str:
    return "WITH " + ", ".join([E_BASE, *more]) + body


def with_o(body: str, *more: str) -> str:
    return "WITH " + ", ".join([O_BASE, *more]) + body


DAILY_7 = "avg(daily_crime_count) OVER (ORDER BY incident_date ROWS 6 PRECEDING)"
DAILY_30 = "avg(daily_crime_count) OVER (ORDER BY incident_date ROWS 29 PRECEDING)"
LAGS = f"""
days AS (SELECT incident_date, count(*) AS daily_crime_count FROM e GROUP BY incident_date),
lags AS (SELECT *, {DAILY_7} AS a7, {DAILY_30} AS a30 FROM days)
"""

YEARS = """
yt AS (SELECT primary_type, year, count(*) AS n FROM o GROUP BY ALL),
latest AS (SELECT max(year) AS y FROM yt),
growth AS (
  SELECT primary_type,
    CAST(coalesce(sum(n) FILTER (WHERE year = y), 0) AS BIGINT) AS current_year_incidents,
    CAST(coalesce(sum(n) FILTER (WHERE year = y - 1), 0) AS BIGINT) AS prev_year_incidents,
    CAST(coalesce(sum(n) FILTER (WHERE year = y - 2), 0) AS BIGINT) AS two_years_ago_incidents
  FROM yt, latest
  WHERE year IN (SELECT DISTINCT year FROM yt ORDER BY year DESC LIMIT 3) GROUP BY primary_type),
""" + f"""
trend AS (
  SELECT *, {pct('current_year_incidents - prev_year_incidents', 'prev_year_incidents')} AS yoy_change_percent,
    CASE WHEN two_years_ago_incidents > 0 THEN
      {pct('current_year_incidents - two_years_ago_incidents', 'two_years_ago_incidents')} END AS two_year_change_percent,
    CASE WHEN (current_year_incidents - prev_year_incidents) / prev_year_incidents::DOUBLE > 0.1e0 THEN 'Growing'
         WHEN (current_year_incidents - prev_year_incidents) / prev_year_incidents::DOUBLE < -0.1e0 THEN 'Declining'
         ELSE 'Stable' END AS trend_category
  FROM growth WHERE prev_year_incidents > 0)
"""

VECTORS = """
v AS (SELECT latitude, longitude, count(*) AS n, min(event_id) AS ord FROM located GROUP BY ALL),
near AS (
  SELECT a.latitude AS lat, a.longitude AS lon, b.latitude AS lat2, b.longitude AS lon2, b.n AS n,
    sqrt((a.latitude - b.latitude) * (a.latitude - b.latitude) + (a.longitude - b.longitude) * (a.longitude - b.longitude)) AS dist
  FROM v a JOIN v b ON b.latitude BETWEEN a.latitude - {r} AND a.latitude + {r}
    AND b.longitude BETWEEN a.longitude - {r} AND a.longitude + {r})
"""

DBSCAN = VECTORS.replace("{r}", "0.02e0") + """,
core AS (SELECT lat, lon FROM near WHERE dist <= 0.02e0 GROUP BY ALL HAVING sum(n) >= 5),
link AS (
  SELECT near.* FROM near SEMI JOIN core USING (lat, lon)
  SEMI JOIN core c2 ON near.lat2 = c2.lat AND near.lon2 = c2.lon WHERE dist <= 0.02e0),
reach AS (
  SELECT lat, lon, lat AS rlat, lon AS rlon FROM core
  UNION
  SELECT l.lat2, l.lon2, r.rlat, r.rlon FROM reach r JOIN link l ON r.lat = l.lat AND r.lon = l.lon),
comp AS (SELECT lat, lon, min((rlat, rlon)) AS root FROM reach GROUP BY ALL),
numbered AS (
  SELECT root, row_number() OVER (ORDER BY min(v.ord)) - 1 AS cluster_id
  FROM comp JOIN v ON v.latitude = comp.lat AND v.longitude = comp.lon GROUP BY root),
core_label AS (SELECT lat, lon, cluster_id FROM comp JOIN numbered USING (root)),
labels AS (
  SELECT near.lat, near.lon, min(c.cluster_id) AS touched,
    min(c.cluster_id) FILTER (WHERE near.dist = 0 AND near.lat = c.lat AND near.lon = c.lon) AS own
  FROM near JOIN core_label c ON near.lat2 = c.lat AND near.lon2 = c.lon WHERE dist <= 0.02e0 GROUP BY ALL),
labelled AS (
  SELECT id, CAST(coalesce(own, touched, -1) AS BIGINT) AS cluster_id
  FROM located LEFT JOIN labels ON located.latitude = labels.lat AND located.longitude = labels.lon)
"""

KDIST = VECTORS.replace("{r}", "2e0") + """,
acc AS (SELECT lat, lon, dist, sum(n) OVER (PARTITION BY lat, lon ORDER BY dist) AS got FROM near),
kd AS (SELECT lat, lon, min(dist) AS kdist FROM acc WHERE got >= 5 GROUP BY ALL)
"""

METRICS = """lab AS ({rows}),
st AS (
  SELECT cluster_id, count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) + var_pop(y) AS v FROM lab GROUP BY 1),
mid AS (SELECT sum(n * mx) / sum(n) AS cx, sum(n * my) / sum(n) AS cy FROM st),
measured AS (
  SELECT count(*) AS k, CAST(sum(n) AS BIGINT) AS points, sum(n * v) AS inertia,
    (sum(n * ((mx - cx) ** 2 + (my - cy) ** 2)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))) AS ch
  FROM st, mid),
far AS (
  SELECT x, y, l.cluster_id AS own, s.cluster_id AS id, n, (x - mx) ** 2 + (y - my) ** 2 + v AS d,
  FROM (SELECT x, y, cluster_id, count(*) AS times FROM lab GROUP BY ALL) l, st s),
ab AS (
  SELECT x, y, own, max(d * n / (n - 1)) FILTER (WHERE id = own AND n > 1) AS a, min(d) FILTER (WHERE id <> own) AS b
  FROM far GROUP BY ALL),
sil AS (
  SELECT sum(times * CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END) / sum(times) AS s
  FROM ab JOIN (SELECT x, y, cluster_id, count(*) AS times FROM lab GROUP BY ALL) t ON t.x = ab.x AND t.y = ab.y AND t.cluster_id = own)
"""

PLACES = """
p AS (
  SELECT DISTINCT (k * 100000 + pk) * 10000 + l_suppkey AS id, 41.65e0 + (b % 7) * 0.06e0 + ((k * 48271 + pk * 16807) % 2147483647) % 100003 / 1e7 AS lat,
    -87.85e0 + (b // 7) * 0.07e0 + ((k * 69621 + pk * 40692) % 2147483399) % 100003 / 1e7 AS lon
  FROM (SELECT l_orderkey * 8 + l_linenumber AS k, l_partkey AS pk, l_suppkey,
    CASE WHEN l_partkey % 3 = 0 THEN 0 ELSE 1 + l_partkey % 34 END AS b FROM lineitem)),
near AS (
  SELECT a.id, c.id AS id2, sqrt((a.lat - c.lat) ** 2 + (a.lon - c.lon) ** 2) AS dist
  FROM (SELECT *, floor(lat / {r}) + unnest([-1, 0, 1]) AS bx FROM p) a
  JOIN (SELECT *, floor(lat / {r}) AS bx FROM p) c ON a.bx = c.bx AND abs(a.lon - c.lon) <= {r})
"""

ORACLES: dict[str, str] = {
    "repeated_load": """
SELECT CAST(ts AS DATE) AS day,
  CASE WHEN ts >= TIMESTAMP '2024-01-06' THEN 'batch_api_late' ELSE 'batch_api_early' END AS source,
  count(*) AS records, count(DISTINCT event_id) AS ids,
  round(sum(value + CASE WHEN ts >= TIMESTAMP '2024-01-06' AND event_id % 3 = 0 THEN 1000 ELSE 0 END), 4) AS total
FROM events GROUP BY ALL""",
    "keyed_append": with_e("""
, n AS (SELECT CAST(id AS BIGINT) AS k FROM located),
s AS (
  SELECT 'DBSCAN' AS model_type, CASE WHEN k % 2 = 0 THEN 0 ELSE 1 END AS cluster_id, k FROM n
  UNION ALL SELECT 'K-means', 1, k FROM n WHERE k % 2 = 1 OR k % 3 = 0)
SELECT model_type, CAST(cluster_id AS BIGINT) AS cluster_id, count(*) AS stored, count(DISTINCT k) AS ids, true AS refused FROM s GROUP BY ALL"""),
    "dbscan_dense": "WITH RECURSIVE" + PLACES.replace("{r}", "0.00020001e0") + """,
touch AS (SELECT id, id2 FROM near WHERE dist <= 0.0002e0),
core AS (SELECT id FROM touch GROUP BY id HAVING count(*) >= 5),
link AS (SELECT t.* FROM touch t SEMI JOIN core USING (id) SEMI JOIN core c ON c.id = t.id2),
cc(id, root) USING KEY (id) AS (
  SELECT id, id FROM core
  UNION
  SELECT l.id, min(r.root) FROM cc r JOIN link l ON l.id2 = r.id JOIN recurring.cc k ON k.id = l.id
  WHERE r.root < k.root GROUP BY l.id),
numbered AS (SELECT root, row_number() OVER (ORDER BY root) - 1 AS cluster_id FROM (SELECT DISTINCT root FROM cc)),
label AS (SELECT cc.id, cluster_id FROM cc JOIN numbered USING (root)),
border AS (SELECT t.id, min(l.cluster_id) AS cluster_id FROM touch t JOIN label l ON l.id = t.id2 GROUP BY t.id)
SELECT p.id, CAST(coalesce(l.cluster_id, b.cluster_id, -1) AS BIGINT) AS cluster_id
FROM p LEFT JOIN label l ON l.id = p.id LEFT JOIN border b ON b.id = p.id""",
    "kdistance_dense": "WITH" + PLACES.replace("{r}", "(SELECT 0.01e0 * sqrt(1948e0 / count(*)) FROM lineitem)") + """,
d AS (SELECT id, list(dist ORDER BY dist)[5] AS kdist FROM near GROUP BY id)
SELECT round(kdist * 1000, 3) AS kdist_milli, count(*) AS points FROM d GROUP BY 1""",
    "staged_incidents": with_e("""
SELECT id, incident_date, case_number, primary_type, description, location_description,
  CAST(arrest AS VARCHAR) AS arrest, CAST(domestic AS VARCHAR) AS domestic, beat, district, ward, community_area,
  CAST(year(date) AS VARCHAR) AS year, latitude, longitude, date AS loaded_at, 'events' AS source FROM e"""),
    "typed_incidents": with_e("""
SELECT id, date, case_number, primary_type, description, location_description, arrest, domestic, beat, district,
  ward, community_area, latitude, longitude, CAST(year(date) AS INTEGER) AS year, date AS loaded_at, 'events' AS source FROM e"""),
    "parse_quality": f"""
SELECT {count_if('event_id % 23 > 4')} AS parsed, {count_if('event_id % 23 <= 4')} AS dropped FROM events""",
    "rejected_records": """
WITH r AS (
  SELECT CASE event_id % 23 WHEN 0 THEN 'malformed' WHEN 1 THEN 'no payload' WHEN 2 THEN 'not an object' WHEN 3 THEN 'not an object'
    WHEN 4 THEN 'not an object' WHEN 5 THEN 'no id' WHEN 6 THEN 'no date' ELSE 'good' END AS reason FROM events)
SELECT reason, count(*) AS records, count(*) AS observed FROM r GROUP BY reason""",
    "rejected_lines": """
WITH f AS (SELECT event_id, event_id % 19 <= 2 AS rejected, form FROM events, (VALUES ('csv'), ('json')) t(form))
SELECT form, rejected, count(*) AS lines, CAST(CASE WHEN rejected THEN NULL ELSE sum(event_id) END AS BIGINT) AS ids FROM f GROUP BY form, rejected""",
    "streamed_counts": """
SELECT CAST(ts AS DATE) AS incident_date, event_type, count(*) AS records, round(sum(value), 4) AS total FROM events GROUP BY ALL""",
    "window_extract_day": """
SELECT CAST(event_id AS VARCHAR) AS id, ts AS date, 'events' AS source FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10'""",
    "window_extract_fallback": """
SELECT CAST(event_id AS VARCHAR) AS id, ts AS date, 'events' AS source FROM events WHERE CAST(ts AS DATE) = DATE '2024-04-10' - 90""",
    "window_extract_range": """
SELECT CAST(event_id AS VARCHAR) AS id, ts AS date, 'events' AS source FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-07'""",
    "window_extract_month": """
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderdate AS date, 'orders' AS source FROM orders
WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 12""",
    "window_extract_year": """
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderdate AS date, 'orders' AS source FROM orders WHERE year(o_orderdate) = 1998""",
    "raw_envelope_append": """
SELECT CAST(event_id AS VARCHAR) AS id, ts AS date, 'batch_api_2024' AS source, event_type, user_id, props FROM events""",
    "crime_type_analysis": with_e(f"""
SELECT primary_type, count(*) AS total_incidents, {count_if('arrest')} AS arrests_made,
  {count_if('domestic')} AS domestic_incidents,
  {pct(count_if('arrest'), 'count(*)')} AS arrest_rate_percent,
  {pct(count_if('domestic'), 'count(*)')} AS domestic_rate_percent,
  min(incident_date) AS earliest_incident, max(incident_date) AS latest_incident
FROM e WHERE primary_type IS NOT NULL GROUP BY primary_type"""),
    "daily_patterns": with_e(f"""
SELECT incident_date, count(*) AS total_incidents, count(DISTINCT primary_type) AS unique_crime_types,
  {count_if('arrest')} AS arrests_made, {count_if('domestic')} AS domestic_incidents,
  mode() WITHIN GROUP (ORDER BY primary_type) AS most_common_crime,
  count(DISTINCT district) AS districts_affected, count(DISTINCT ward) AS wards_affected
FROM e GROUP BY incident_date"""),
    "location_analysis": with_e(f"""
SELECT location_description, district, ward, count(*) AS total_incidents, {count_if('arrest')} AS arrests_made,
  {pct(count_if('arrest'), 'count(*)')} AS arrest_rate_percent,
  mode() WITHIN GROUP (ORDER BY primary_type) AS most_common_crime
FROM e WHERE location_description IS NOT NULL GROUP BY location_description, district, ward HAVING count(*) >= 2"""),
    "monthly_trends": with_o(f""",
m AS (
  SELECT CAST(date_trunc('month', incident_date) AS DATE) AS month, count(*) AS total_incidents,
    {count_if('arrest')} AS arrests_made, count(DISTINCT primary_type) AS unique_crime_types FROM o GROUP BY 1),
w AS (
  SELECT *, avg(total_incidents) OVER (ORDER BY month ROWS 2 PRECEDING) AS three_month_avg,
    lag(total_incidents, 12) OVER (ORDER BY month) AS same_month_prev_year FROM m)
SELECT month, CAST(year(month) AS BIGINT) AS year, CAST(month(month) AS BIGINT) AS month_num, total_incidents, arrests_made,
  unique_crime_types, {pct('arrests_made', 'total_incidents')} AS arrest_rate_percent, three_month_avg, same_month_prev_year,
  CASE WHEN same_month_prev_year > 0 THEN
    {pct('total_incidents - same_month_prev_year', 'same_month_prev_year')} END AS yoy_change_percent
FROM w"""),
    "yoy_by_type": with_o(f""",
y AS (
  SELECT year, primary_type, count(*) AS incidents, {count_if('arrest')} AS arrests,
    {pct(count_if('arrest'), 'count(*)')} AS arrest_rate FROM o GROUP BY ALL),
l AS (
  SELECT *, lag(incidents) OVER w AS prev_year_incidents, lag(arrests) OVER w AS prev_year_arrests,
    lag(arrest_rate) OVER w AS prev_year_arrest_rate FROM y WINDOW w AS (PARTITION BY primary_type ORDER BY year))
SELECT *, CASE WHEN prev_year_incidents > 0 THEN {pct('incidents - prev_year_incidents', 'prev_year_incidents')} END AS yoy_incident_change_percent,
  CASE WHEN prev_year_arrests > 0 THEN {pct('arrests - prev_year_arrests', 'prev_year_arrests')} END AS yoy_arrest_change_percent,
  incidents - prev_year_incidents AS incident_change_absolute, arrests - prev_year_arrests AS arrest_change_absolute,
  round(arrest_rate - prev_year_arrest_rate, 2) AS arrest_rate_change_points
FROM l WHERE prev_year_incidents IS NOT NULL"""),
    "seasonal_yoy": with_o(f""",
s AS (
  SELECT year, CASE WHEN month(date) IN (12, 1, 2) THEN 'Winter' WHEN month(date) <= 5 THEN 'Spring'
      WHEN month(date) <= 8 THEN 'Summer' ELSE 'Fall' END AS season,
    count(*) AS total_incidents, {count_if('arrest')} AS arrests_made, count(DISTINCT primary_type) AS unique_crime_types,
    mode() WITHIN GROUP (ORDER BY primary_type) AS most_common_crime FROM o GROUP BY 1, 2),
l AS (SELECT *, lag(total_incidents) OVER (PARTITION BY season ORDER BY year) AS prev_year_incidents FROM s)
SELECT *, {pct('arrests_made', 'total_incidents')} AS arrest_rate_percent,
  CASE WHEN prev_year_incidents > 0 THEN {pct('total_incidents - prev_year_incidents', 'prev_year_incidents')} END AS yoy_seasonal_change_percent
FROM l"""),
    "trend_classification": with_o(" SELECT * FROM trend", YEARS),
    "top_movers": with_o("""
(SELECT 'Top Growing Crime Types' AS analysis_type, primary_type, yoy_change_percent, current_year_incidents, prev_year_incidents
 FROM trend ORDER BY yoy_change_percent DESC, primary_type LIMIT 5)
UNION ALL
(SELECT 'Top Declining Crime Types', primary_type, yoy_change_percent, current_year_incidents, prev_year_incidents
 FROM trend ORDER BY yoy_change_percent, primary_type LIMIT 5)""", YEARS),
    "analytics_summary": with_e("""
SELECT 'Raw Data' AS table_name, count(*) AS record_count FROM events
UNION ALL SELECT 'Staging Data', count(*) FROM e
UNION ALL SELECT 'Crime Types', count(DISTINCT primary_type) FROM e
UNION ALL SELECT 'Daily Patterns', count(DISTINCT incident_date) FROM e
UNION ALL SELECT 'Location Analysis', count(*) FROM (
  SELECT 1 FROM e WHERE location_description IS NOT NULL GROUP BY location_description, district, ward HAVING count(*) >= 2)"""),
    "component_status": with_e("""
SELECT component, records, CASE WHEN records > 0 THEN 'COMPLETE' ELSE 'EMPTY' END AS status FROM (
  SELECT 'Raw Data' AS component, count(*) AS records FROM events
  UNION ALL SELECT 'Feature Engineering', count(*) FROM f
  UNION ALL SELECT 'Spatial Clustering', count(*) FROM located
  UNION ALL SELECT 'Unknown District', count(*) FROM f WHERE district_num > 24)"""),
    "component_health": with_e("""
SELECT CASE WHEN (SELECT count(*) FROM f WHERE district_num > 24) > 0 AND (SELECT count(*) FROM located) > 0
  THEN 'FULLY OPERATIONAL' ELSE 'PARTIALLY COMPLETE' END AS status"""),
    "freshness": """
SELECT 'Raw Data' AS component, max(ts) AS last_update FROM events
UNION ALL SELECT 'Features', max(ts) FROM events UNION ALL SELECT 'Orders', max(o_orderdate) FROM orders""",
    "temporal_features": with_e("""
SELECT id, CAST(hour AS BIGINT) AS hour, CAST(day_of_week AS BIGINT) AS day_of_week, CAST(day(date) AS BIGINT) AS day_of_month,
  CAST(month(date) AS BIGINT) AS month, CAST(quarter(date) AS BIGINT) AS quarter, CAST(weekofyear(date) AS BIGINT) AS week_of_year,
  is_weekend, false AS is_night, hour >= 22 OR hour <= 5 AS is_night_wrapped,
  hour BETWEEN 7 AND 9 OR hour BETWEEN 17 AND 19 AS is_rush_hour, season, time_period FROM f"""),
    "spatial_features": with_e("""
SELECT id, has_coordinates, district_num, beat_num, ward_num, community_area_num, location_type,
  round(distance_from_center, 6) AS distance_from_center FROM f"""),
    "crime_features": with_e("""
SELECT id, crime_category, is_violent_crime, is_property_crime, is_drug_crime, round(rate, 6) AS crime_type_arrest_rate
FROM f JOIN (SELECT primary_type, avg(CAST(arrest AS DOUBLE)) AS rate FROM e GROUP BY primary_type) USING (primary_type)"""),
    "lag_features": with_e("""
SELECT id, daily_crime_count, round(a7, 6) AS crimes_7day_avg, round(a30, 6) AS crimes_30day_avg
FROM e JOIN lags USING (incident_date)""", LAGS),
    "stored_features": with_e("""
SELECT id, date, case_number, primary_type, description, location_description, arrest, domestic, beat, district, ward,
  community_area, round(latitude, 8) AS latitude, round(longitude, 8) AS longitude, CAST(year(date) AS BIGINT) AS year,
  CAST(hour AS BIGINT) AS hour, CAST(day_of_week AS BIGINT) AS day_of_week, CAST(day(date) AS BIGINT) AS day_of_month,
  CAST(month(date) AS BIGINT) AS month, CAST(quarter(date) AS BIGINT) AS quarter, CAST(weekofyear(date) AS BIGINT) AS week_of_year,
  is_weekend, false AS is_night, hour BETWEEN 7 AND 9 OR hour BETWEEN 17 AND 19 AS is_rush_hour, season, time_period,
  has_coordinates, CAST(district_num AS BIGINT) AS district_num, CAST(beat_num AS BIGINT) AS beat_num,
  CAST(ward_num AS BIGINT) AS ward_num, CAST(community_area_num AS BIGINT) AS community_area_num, location_type,
  round(distance_from_center, 2) AS distance_from_center, crime_category, is_violent_crime, is_property_crime, is_drug_crime,
  round(rate, 4) AS crime_type_arrest_rate, daily_crime_count, round(a7, 2) AS crimes_7day_avg, round(a30, 2) AS crimes_30day_avg,
  date AS loaded_at, 'events' AS source
FROM f JOIN lags USING (incident_date)
  JOIN (SELECT primary_type, avg(CAST(arrest AS DOUBLE)) AS rate FROM e GROUP BY primary_type) USING (primary_type)""", LAGS),
    "overall_stats": with_e(f"""
SELECT count(*) AS total_records, count(DISTINCT primary_type) AS crime_types, count(DISTINCT incident_date) AS days_covered,
  min(date) AS start_date, max(date) AS end_date, {count_if('is_violent_crime')} AS violent_crimes,
  {count_if('is_property_crime')} AS property_crimes, {count_if('has_coordinates')} AS with_coordinates,
  round(avg(distance_from_center), 6) AS avg_distance_from_center FROM f"""),
    "type_share": with_e(f"""
SELECT primary_type, count(*) AS count, {pct('count(*)', '(SELECT count(*) FROM e)')} AS percentage FROM e GROUP BY primary_type"""),
    "top_types": with_e(f"""
SELECT primary_type, count(*) AS count, {pct('count(*)', '(SELECT count(*) FROM e)', 1)} AS percentage
FROM e GROUP BY primary_type ORDER BY count(*) DESC, primary_type LIMIT 10"""),
    "hourly_distribution": with_e(f"""
SELECT CAST(hour AS BIGINT) AS hour, count(*) AS crimes, {pct(count_if('is_violent_crime'), 'count(*)', 1)} AS violent_rate
FROM f GROUP BY 1"""),
    "peak_hours": with_e(f"""
SELECT CAST(hour AS BIGINT) AS hour, count(*) AS crimes, {pct(count_if('is_violent_crime'), 'count(*)', 1)} AS violent_rate
FROM f GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"""),
    "distance_bands": with_e(f"""
SELECT CASE WHEN distance_from_center < 5 THEN 'Downtown (0-5 mi)' WHEN distance_from_center < 10 THEN 'Inner City (5-10 mi)'
    WHEN distance_from_center < 15 THEN 'Outer City (10-15 mi)' ELSE 'Suburbs (15+ mi)' END AS area,
  count(*) AS crimes, {pct(count_if('is_violent_crime'), 'count(*)', 1)} AS violent_rate
FROM f WHERE distance_from_center IS NOT NULL GROUP BY 1"""),
    "feature_profile": with_e(f"""
SELECT count(*) AS records,
  min(date) AS min_date, max(date) AS max_date, CAST(min(hour) AS BIGINT) AS min_hour, CAST(max(hour) AS BIGINT) AS max_hour,
  CAST(min(day_of_week) AS BIGINT) AS min_day_of_week, CAST(max(day_of_week) AS BIGINT) AS max_day_of_week,
  round(min(latitude), 6) AS min_latitude, round(max(latitude), 6) AS max_latitude,
  round(min(longitude), 6) AS min_longitude, round(max(longitude), 6) AS max_longitude,
  round(min(distance_from_center), 6) AS min_distance, round(max(distance_from_center), 6) AS max_distance,
  min(daily_crime_count) AS min_daily_count, max(daily_crime_count) AS max_daily_count,
  round(min(a7), 6) AS min_avg_7day, round(max(a7), 6) AS max_avg_7day,
  {count_if('is_weekend')} AS weekend_crimes, round(avg(CAST(is_weekend AS DOUBLE)), 6) AS weekend_rate,
  {count_if('has_coordinates')} AS with_coordinates, round(avg(CAST(has_coordinates AS DOUBLE)), 6) AS coordinate_rate,
  {count_if('is_violent_crime')} AS violent_crimes, round(avg(CAST(is_violent_crime AS DOUBLE)), 6) AS violent_rate,
  {count_if('is_property_crime')} AS property_crimes, round(avg(CAST(is_property_crime AS DOUBLE)), 6) AS property_rate
FROM f JOIN lags USING (incident_date)""", LAGS),
    "category_counts": with_e(" SELECT crime_category, count(*) AS crimes FROM f GROUP BY 1"),
    "trend_first_last_week": with_e("""
, d AS (SELECT incident_date AS day, count(*) AS n FROM e GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY day) AS a, row_number() OVER (ORDER BY day DESC) AS z FROM d)
SELECT count(*) AS days, min(day) AS start_date, max(day) AS end_date, min(n) AS min_daily, max(n) AS max_daily,
  round(avg(n), 6) AS avg_daily, round(avg(n) FILTER (WHERE a <= 7), 6) AS first_week_avg,
  round(avg(n) FILTER (WHERE z <= 7), 6) AS last_week_avg,
  round((avg(n) FILTER (WHERE z <= 7) / avg(n) FILTER (WHERE a <= 7) - 1) * 100, 6) AS trend_percent FROM r"""),
    "series_stats": with_e("""
, d AS (SELECT primary_type, incident_date, count(*) AS n FROM e
  WHERE primary_type IN ('THEFT', 'BATTERY', 'CRIMINAL DAMAGE', 'NARCOTICS', 'ASSAULT') GROUP BY ALL)
SELECT primary_type, count(*) AS days, round(avg(n), 6) AS avg_per_day FROM d GROUP BY 1"""),
    "bbox_filtered": with_e(" SELECT id, date, primary_type, latitude, longitude, district_num FROM located"),
    "recent_window": with_e("""
SELECT id, date, primary_type, season FROM located WHERE primary_type = 'THEFT' AND date >= TIMESTAMP '2024-01-15'"""),
    "spatial_profile": with_e(f"""
SELECT count(*) AS records, min(latitude) AS min_latitude, max(latitude) AS max_latitude, min(longitude) AS min_longitude,
  max(longitude) AS max_longitude, round(min(distance_from_center), 6) AS min_distance,
  round(max(distance_from_center), 6) AS max_distance, round(avg(distance_from_center), 6) AS avg_distance,
  {count_if('is_violent_crime')} AS violent_crimes, round(avg(CAST(is_violent_crime AS DOUBLE)), 6) AS violent_rate FROM located"""),
    "spatial_bounds": with_e("""
SELECT count(*) AS total_records, min(date) AS start_date, max(date) AS end_date, min(latitude) AS lat_min,
  max(latitude) AS lat_max, min(longitude) AS lon_min, max(longitude) AS lon_max FROM located"""),
    "grid_profile_10x10": with_e("""
, s AS (SELECT min(latitude) AS lat0, max(latitude) AS lat1, min(longitude) AS lon0, max(longitude) AS lon1 FROM located),
c AS (
  SELECT greatest(least(CAST(ceil((latitude - lat0) / ((lat1 - lat0) / 10)) AS BIGINT) - 1, 9), 0) AS r,
    greatest(least(CAST(ceil((longitude - lon0) / ((lon1 - lon0) / 10)) AS BIGINT) - 1, 9), 0) AS c, count(*) AS n
  FROM located, s GROUP BY ALL)
SELECT count(*) AS non_empty_cells, max(n) AS max_per_cell, round(avg(n), 6) AS avg_per_cell FROM c"""),
    "grid_features": with_e("""
SELECT id, lat_bin, lon_bin, grid_crime_count, crimes_same_location_24h, round(distance_to_hotspot_1, 6) AS distance_to_hotspot_1,
  round(distance_to_hotspot_2, 6) AS distance_to_hotspot_2, round(distance_to_hotspot_3, 6) AS distance_to_hotspot_3 FROM gridded""", GRID),
    "scaled_features": with_e("SELECT id, " + ", ".join(
        f"round((coalesce({c}, (SELECT median({c}) FROM gridded)) - (SELECT avg(coalesce({c}, (SELECT median({c}) FROM gridded))) FROM gridded))"
        f" / (SELECT stddev_pop(coalesce({c}, (SELECT median({c}) FROM gridded))) FROM gridded), 6) AS z_{c}"
        for c in ("latitude", "longitude", "distance_from_center", "grid_crime_count", "crimes_same_location_24h",
                  "distance_to_hotspot_1", "distance_to_hotspot_2", "distance_to_hotspot_3")
    ) + " FROM gridded", GRID),
    "dashboard_filtered_counts": with_e("""
SELECT primary_type, count(*) AS count FROM f WHERE incident_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
  AND primary_type IN ('THEFT', 'BATTERY', 'ASSAULT') AND hour BETWEEN 18 AND 23
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""),
    "dashboard_hourly": with_e("""
SELECT CAST(hour AS BIGINT) AS hour, count(*) AS crimes FROM f
WHERE incident_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY 1"""),
    "district_top8": with_e("""
SELECT district_num, count(*) AS crimes FROM f GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 8"""),
    "season_counts": with_e(" SELECT season, count(*) AS crimes FROM f GROUP BY 1"),
    "weekend_split": with_e(" SELECT is_weekend, count(*) AS crimes FROM f GROUP BY 1"),
    "time_period_counts": with_e(" SELECT time_period, count(*) AS crimes FROM f GROUP BY 1"),
    "severity_share": with_e(f"""
SELECT mode() WITHIN GROUP (ORDER BY crime_category) AS peak,
  (SELECT max(n) FROM (SELECT count(*) AS n FROM f GROUP BY crime_category)) AS peak_count,
  {pct(count_if('is_violent_crime'), 'count(*)', 1)} AS violent_percent FROM f"""),
    "first_types": with_e("""
SELECT primary_type FROM (SELECT primary_type, row_number() OVER (PARTITION BY primary_type ORDER BY date, id) AS r, date, id FROM e)
WHERE r = 1 ORDER BY date, id LIMIT 5"""),
    "nearest_center": with_e("""
, c(cluster_id, lat, lon) AS (VALUES (0, 41.7e0, -87.8e0), (1, 41.7e0, -87.55e0), (2, 41.86e0, -87.7e0), (3, 42e0, -87.8e0), (4, 42e0, -87.55e0))
SELECT id, CAST(arg_min(cluster_id, ((latitude - lat) * (latitude - lat) + (longitude - lon) * (longitude - lon), cluster_id)) AS BIGINT) AS cluster_id
FROM located, c GROUP BY id"""),
    "dbscan_clusters": with_e(" SELECT id, cluster_id FROM labelled", DBSCAN).replace("WITH", "WITH RECURSIVE", 1),
    "dbscan_quality": with_e(f"""
, {METRICS.replace("{rows}", "SELECT l.cluster_id, latitude AS x, longitude AS y FROM labelled l JOIN located USING (id) WHERE l.cluster_id >= 0")}
SELECT count(DISTINCT cluster_id) FILTER (WHERE cluster_id >= 0) AS n_clusters, {count_if('cluster_id = -1')} AS n_noise_points,
  {count_if('cluster_id = -1')} / count(*) AS noise_ratio, (SELECT round(inertia, 6) FROM measured) AS inertia,
  (SELECT round(ch, 1) FROM measured) AS calinski_harabasz, (SELECT round(s, 6) FROM sil) AS silhouette_squared_euclidean
FROM labelled""", DBSCAN).replace("WITH", "WITH RECURSIVE", 1),
    "blob_metrics": with_e(f"""
, {METRICS.replace("{rows}", "SELECT (CAST(beat AS BIGINT) % 7) * 5 + CAST(beat AS BIGINT) % 5 AS cluster_id, latitude AS x, longitude AS y FROM located")}
SELECT k AS n_clusters, points AS n_points, round(inertia, 6) AS inertia, round(ch, 1) AS calinski_harabasz,
  (SELECT round(s, 6) FROM sil) AS silhouette_squared_euclidean FROM measured"""),
    "strip_sweep": with_e("""
, ends AS (SELECT min(latitude) AS lo, max(latitude) AS hi FROM located),
strips AS (
  SELECT k, least(floor((latitude - lo) / (hi - lo) * k), k - 1) AS strip, count(*) AS n, var_pop(latitude) + var_pop(longitude) AS v
  FROM located, ends, range(2, 16) t(k) GROUP BY ALL),
inertias AS (SELECT k, sum(n * v) AS inertia FROM strips GROUP BY k),
bends AS (
  SELECT k, inertia, lead(inertia, 2) OVER w - 2 * lead(inertia, 1) OVER w + inertia AS bend, lead(k, 2) OVER w AS elbow
  FROM inertias WINDOW w AS (ORDER BY k))
SELECT CAST(k AS INTEGER) AS k, round(inertia, 6) AS inertia,
  CAST((SELECT elbow FROM bends WHERE bend IS NOT NULL ORDER BY bend DESC, k LIMIT 1) AS INTEGER) AS elbow_k FROM bends"""),
    "kdistance_tuning": with_e("""
SELECT round(kdist, 6) AS kdist, CAST(sum(n) AS BIGINT) AS points FROM kd JOIN v ON kd.lat = v.latitude AND kd.lon = v.longitude GROUP BY 1""", KDIST),
    "kdistance_eps": with_e("""
, p AS (
  SELECT kdist, row_number() OVER (ORDER BY kdist) AS i FROM kd JOIN v ON kd.lat = v.latitude AND kd.lon = v.longitude
  CROSS JOIN range(v.n)),
g AS (
  SELECT kdist, i, CASE WHEN lag(kdist) OVER w IS NULL THEN lead(kdist) OVER w - kdist
    WHEN lead(kdist) OVER w IS NULL THEN kdist - lag(kdist) OVER w
    ELSE (lead(kdist) OVER w - lag(kdist) OVER w) / 2 END AS slope FROM p WINDOW w AS (ORDER BY i))
SELECT round(kdist, 6) AS eps FROM g ORDER BY slope DESC, i LIMIT 1""", KDIST),
    "hotspot_profile": with_e("""
SELECT cluster_id, size, round(center_lat, 6) AS center_lat, round(center_lon, 6) AS center_lon, round(lat_std, 6) AS lat_std,
  round(lon_std, 6) AS lon_std, round(violent_crime_ratio, 6) AS violent_crime_ratio,
  round(property_crime_ratio, 6) AS property_crime_ratio, round(avg_distance_from_center, 6) AS avg_distance_from_center,
  round(weekend_ratio, 6) AS weekend_ratio, top_crime_type, CAST(peak_hour AS BIGINT) AS peak_hour, districts, crime_types
FROM profile
JOIN (SELECT cluster_id, string_agg(CAST(d AS VARCHAR), ',' ORDER BY d) AS districts
      FROM (SELECT DISTINCT cluster_id, CAST(district_num AS BIGINT) AS d FROM blob) GROUP BY 1) USING (cluster_id)
JOIN (SELECT cluster_id, string_agg(primary_type || '=' || CAST(n AS VARCHAR), ';' ORDER BY primary_type) AS crime_types
      FROM (SELECT cluster_id, primary_type, count(*) AS n FROM blob GROUP BY ALL) GROUP BY 1) USING (cluster_id)""", GRID, BLOBS),
    "risk_score": with_e(" SELECT cluster_id, size, risk_score FROM profile", GRID, BLOBS),
    "hotspot_summary": with_e(f"""
SELECT count(*) AS total_hotspots, {count_if('risk_score > 70')} AS high_risk_hotspots,
  {count_if('risk_score BETWEEN 40 AND 70')} AS medium_risk_hotspots, {count_if('risk_score < 40')} AS low_risk_hotspots FROM profile""", GRID, BLOBS),
    "top_hotspots": with_e("""
SELECT cluster_id, printf('(%.4f, %.4f)', center_lat, center_lon) AS location, size, risk_score, top_crime_type,
  printf('%.1f%%', violent_crime_ratio * 100) AS violent_ratio FROM profile ORDER BY risk_score DESC, cluster_id LIMIT 5""", GRID, BLOBS),
    "risk_levels": with_e("""
SELECT CASE WHEN risk_score >= 80 THEN 'CRITICAL' WHEN risk_score >= 60 THEN 'HIGH' WHEN risk_score >= 40 THEN 'MODERATE'
  ELSE 'LOW' END AS risk_level, count(*) AS hotspots, max(risk_score) AS highest FROM profile GROUP BY 1""", GRID, BLOBS),
    "risk_band_filter": with_e(" SELECT cluster_id, risk_score FROM hot WHERE risk_score BETWEEN 40 AND 59", GRID, BLOBS),
    "hotspot_kpis": with_e(f"""
SELECT count(*) AS hotspots, {count_if('risk_score >= 80')} AS critical_zones, {count_if('risk_score >= 60')} AS high_zones,
  round(avg(risk_score), 1) AS average_risk, max(risk_score) AS highest_risk,
  arg_max(model_type, (risk_score, model_type)) AS highest_risk_model FROM hot""", GRID, BLOBS),
    "risk_histogram": with_e("""
, s AS (SELECT min(risk_score) AS lo, max(risk_score) AS hi FROM hot)
SELECT model_type, least(CAST(floor((risk_score - lo) / ((hi - lo) / 10)) AS BIGINT), 9) AS bin, count(*) AS hotspots
FROM hot, s GROUP BY 1, 2""", GRID, BLOBS),
    "risk_zone_table": with_e("""
SELECT CASE WHEN risk_score >= 80 THEN 'CRITICAL' WHEN risk_score >= 60 THEN 'HIGH' WHEN risk_score >= 40 THEN 'MODERATE'
  ELSE 'LOW' END AS "Risk Level", round(risk_score, 1) AS "Risk Score", cluster_size AS "Crime Count",
  top_crime_type AS "Primary Crime Type", model_type AS "Detection Model" FROM hot""", GRID, BLOBS),
    "clusters_per_model": with_e("""
SELECT CASE WHEN cluster_id % 2 = 0 THEN 'K-means' ELSE 'DBSCAN' END AS model_type,
  count(DISTINCT cluster_id) AS clusters, count(*) AS total_records FROM blob GROUP BY 1""", GRID, BLOBS),
    "daily_series_filled": with_o(" SELECT * FROM series", SERIES),
    "seasonal_decompose": with_o(""",
i AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date) - 1 AS i, count(*) OVER (PARTITION BY series_id) AS n FROM series),
t AS (
  SELECT *, CASE WHEN i BETWEEN 3 AND n - 4 THEN
    sum(y) OVER (PARTITION BY series_id ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) / 7 END AS trend FROM i),
ph AS (SELECT series_id, i % 7 AS phase, avg(y - trend) AS raw FROM t GROUP BY ALL),
ce AS (SELECT series_id, phase, raw - avg(raw) OVER (PARTITION BY series_id) AS seasonal FROM ph)
SELECT t.series_id, date, y, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal, round(y - trend - seasonal, 6) AS residual
FROM t JOIN ce ON t.series_id = ce.series_id AND t.i % 7 = ce.phase""", SERIES),
    "series_summary": with_o("""
SELECT series_id, count(*) AS total_observations, min(date) AS start_date, max(date) AS end_date,
  round(avg(y), 6) AS mean_daily, round(stddev_samp(y), 6) AS std_daily FROM series GROUP BY 1""", SERIES),
    "chronological_split": with_o(""",
i AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY date) AS i, count(*) OVER (PARTITION BY series_id) AS n FROM series)
SELECT series_id, i <= floor(n * 0.8e0) AS is_train, count(*) AS days, min(date) AS first_day, sum(y) AS incidents FROM i GROUP BY 1, 2""", SERIES),
}

_SCORED = """
l AS (SELECT *, lag(y, 7) OVER w AS one, lag(y, 14) OVER w AS two FROM series WINDOW w AS (PARTITION BY series_id ORDER BY date)),
sc AS (
  SELECT series_id, 'one' AS model_type, y, one AS yhat FROM l WHERE two IS NOT NULL
  UNION ALL SELECT series_id, 'two', y, two FROM l WHERE two IS NOT NULL),
me AS (
  SELECT series_id, model_type, avg(abs(y - yhat)) AS mae, sqrt(avg((y - yhat) * (y - yhat))) AS rmse,
    avg(abs((y - yhat) / y)) FILTER (WHERE y <> 0) * 100 AS mape, count(*) FILTER (WHERE y = 0) AS zero_days, count(*) AS test_days
  FROM sc GROUP BY ALL)
"""

ORACLES["forecast_metrics"] = with_o("""
SELECT series_id, model_type, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(mape, 6) AS mape, zero_days, test_days FROM me""", SERIES, _SCORED)
ORACLES["model_choice"] = with_o("""
SELECT series_id, arg_min(model_type, ((mae + rmse) / 2, CASE model_type WHEN 'two' THEN 0 ELSE 1 END)) AS best_model,
  round(min((mae + rmse) / 2), 6) AS best_score, count(*) AS models FROM me GROUP BY 1""", SERIES, _SCORED)
ORACLES["sampled_export"] = with_e("""
SELECT id, date, primary_type, latitude, longitude, district_num, is_violent_crime, is_property_crime, crime_category,
  round(distance_from_center, 6) AS distance_from_center, CAST(hour AS BIGINT) AS hour, CAST(day_of_week AS BIGINT) AS day_of_week,
  is_weekend, season, daily_crime_count, round(a7, 6) AS crimes_7day_avg
FROM f JOIN lags USING (incident_date) WHERE latitude IS NOT NULL AND longitude IS NOT NULL
ORDER BY md5('42:' || id), id LIMIT 5000""", LAGS)
ORACLES["summary_document"] = with_e(f"""
SELECT count(*) AS total_records, count(DISTINCT primary_type) AS crime_types, min(date) AS start_date, max(date) AS end_date,
  {count_if('is_violent_crime')} AS violent_crimes, {count_if('is_property_crime')} AS property_crimes,
  {count_if('has_coordinates')} AS with_coordinates, round(avg(distance_from_center), 6) AS avg_distance_from_center,
  (SELECT string_agg(primary_type || '=' || n, ';' ORDER BY n DESC, primary_type)
   FROM (SELECT primary_type, count(*) AS n FROM f GROUP BY 1)) AS crime_distribution,
  (SELECT string_agg(hour || '=' || n, ';' ORDER BY hour) FROM (SELECT hour, count(*) AS n FROM f GROUP BY 1)) AS hourly_distribution
FROM f""")
ORACLES["export_manifest"] = with_e("""
SELECT least(count(*) FILTER (WHERE has_coordinates), 500) || ' records (sample)' AS crime_features,
  (SELECT count(*) FROM hot) || ' hotspots' AS crime_hotspots,
  (SELECT count(*) FROM hot WHERE model_type = 'DBSCAN') || ' forecasts' AS crime_forecasts,
  'overall figures and model performance' AS summary_stats, count(*) AS total_original_records,
  min(date) || ' to ' || max(date) AS date_range, count(DISTINCT primary_type) AS crime_types,
  (SELECT count(*) FROM hot) AS hotspots_identified,
  (SELECT count(*) FROM hot WHERE model_type = 'DBSCAN') AS forecasts_generated FROM f""", GRID, BLOBS)
ORACLES["model_split"] = with_e("""
SELECT cluster_id, risk_score, cluster_size, top_crime_type FROM hot WHERE model_type = 'DBSCAN'
ORDER BY risk_score DESC, cluster_id LIMIT 5""", GRID, BLOBS)

_NAIVE = """
nf AS (
  SELECT series_id AS crime_type, 'one' AS model_type, date, one AS forecast FROM l WHERE two IS NOT NULL
  UNION ALL SELECT series_id, 'two', date, two FROM l WHERE two IS NOT NULL)
"""
ORACLES["forecast_summary"] = with_o("""
SELECT crime_type, model_type, count(*) AS forecast_days, min(date) AS start_date, max(date) AS end_date,
  round(avg(forecast), 1) AS avg_forecast FROM nf GROUP BY 1, 2""", SERIES, _SCORED, _NAIVE)
ORACLES["forecast_table"] = with_o("""
SELECT strftime(date, '%Y-%m-%d') AS date, round(forecast, 1) AS forecast, round(forecast / 3, 1) AS lower_ci,
  round(forecast * 2, 1) AS upper_ci FROM nf WHERE model_type = 'one'""", SERIES, _SCORED, _NAIVE)
ORACLES["metric_table"] = with_o(" " + " UNION ALL ".join(
    f"SELECT series_id, '{m}' AS metric, round(CAST(max({m}) FILTER (WHERE model_type = 'one') AS DOUBLE), 6) AS one, "
    f"round(CAST(max({m}) FILTER (WHERE model_type = 'two') AS DOUBLE), 6) AS two FROM me GROUP BY series_id"
    for m in ("mae", "rmse", "mape", "zero_days", "test_days")), SERIES, _SCORED)
ORACLES["ml_report"] = ("WITH " + ", ".join([E_BASE, GRID, BLOBS, O_BASE, SERIES, _SCORED, _NAIVE]) + """
SELECT (SELECT count(*) FROM e) AS feature_count, (SELECT count(*) FROM nf) AS forecast_count,
  (SELECT count(DISTINCT cluster_id) FROM blob) AS cluster_count, (SELECT count(*) FROM hot) AS hotspot_count""")
ORACLES["high_risk_hotspots"] = with_e("""
SELECT cluster_id, printf('(%.4f, %.4f)', center_lat, center_lon) AS location, size, risk_score, top_crime_type,
  printf('%.1f%%', violent_crime_ratio * 100) AS violent_ratio FROM profile WHERE risk_score > 70
ORDER BY risk_score DESC, cluster_id LIMIT 8""", GRID, BLOBS)
ORACLES["incremental_patterns"] = ORACLES["daily_patterns"]
ORACLES |= {
    "fitted_hotspots": with_e("""
SELECT cluster_id, 'DBSCAN' AS model_type, 'ALL' AS crime_type_filter, size AS cluster_size, risk_score, top_crime_type,
  CAST(peak_hour AS BIGINT) AS peak_hour FROM profile""", GRID, DBSCAN, BLOBS.replace(
        "CAST((user_id % 7) * 5 + user_id % 5 AS BIGINT) AS cluster_id FROM gridded",
        "FROM gridded JOIN labelled USING (id) WHERE cluster_id >= 0",
    ).replace("SELECT *, FROM", "SELECT * FROM")).replace("WITH", "WITH RECURSIVE", 1),
    "violent_clusters": with_e("""
SELECT id, cluster_id, 'DBSCAN' AS model_type, 'VIOLENT' AS crime_type_filter FROM labelled""", DBSCAN.replace(
        "FROM located GROUP BY ALL", "FROM located WHERE is_violent_crime GROUP BY ALL"
    ).replace(
        "FROM located LEFT JOIN labels", "FROM (FROM located WHERE is_violent_crime) located LEFT JOIN labels"
    )).replace("WITH", "WITH RECURSIVE", 1),
    "kmeans_partition": with_e("""
SELECT id, min(event_id) OVER (PARTITION BY user_id % 2, user_id // 2 % 2) AS cluster FROM located"""),
    "guarded_rows": with_e("""
SELECT 'recent month' AS rows_of, count(*) AS records, min(date) AS since FROM located WHERE date >= TIMESTAMP '2024-01-15'
UNION ALL SELECT 'all', count(*), min(date) FROM located"""),
    "stored_tables": with_e("""
SELECT 'K-means' AS model_type, 'ALL' AS crime_type_filter, count(*) AS records, count(*) AS stamped FROM located
UNION ALL SELECT 'staging', 'none', count(*), count(*) FROM e"""),
    "exported_hotspots": with_e("""
SELECT cluster_id, 'DBSCAN' AS model_type, risk_score, size AS cluster_size, top_crime_type, CAST(peak_hour AS BIGINT) AS peak_hour,
  round(center_lat, 6) AS lat, round(center_lon, 6) AS lon, round(violent_crime_ratio, 6) AS violent_crime_ratio,
  round(weekend_ratio, 6) AS weekend_ratio FROM profile""", GRID, BLOBS),
    "raw_or_nothing": "SELECT 'raw' AS folder, count(*) AS records FROM events UNION ALL SELECT 'absent', 0",
}
