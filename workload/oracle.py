"""SQL counterparts of the registered queries, for DuckDB on the same tables.

Written from the definitions, on other lines than the engine: runs come from the difference of two row numbers, payload
rows from joins without any JSON, dimension rows straight from the snapshots.
"""

from __future__ import annotations

SNAP = """
snap AS (
  SELECT event_id, ts AS captured_at,
         CAST(user_id % 4 AS INTEGER) AS park_id, 'Park ' || (user_id % 4) AS park_name,
         'Land ' || (user_id % 7) AS land_name,
         CAST(user_id AS INTEGER) AS ride_id, 'Ride ' || user_id AS ride_name,
         event_type NOT IN ('error', 'signup') AS is_open,
         CAST(CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS INTEGER) AS wait_time_minutes,
         CAST(ts AS VARCHAR) AS source_last_updated,
         CASE WHEN event_id % 5 = 0 THEN 'synthetic' ELSE 'queue-times-api' END AS data_source
  FROM events
)"""

DIRTY = (
    SNAP
    + """,
dirty AS (
  SELECT * REPLACE (
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE is_open END AS is_open,
    CASE WHEN event_id % 19 = 0 THEN 'New ' || ride_id ELSE ride_name END AS ride_name,
    CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'other' ELSE data_source END AS data_source)
  FROM snap
)"""
)

DIRTY_GROUPS = (
    DIRTY
    + """,
flagged AS (
  SELECT *, CASE WHEN lag(is_open) OVER w = is_open THEN 0 ELSE 1 END AS is_status_change
  FROM dirty WHERE date_part('hour', captured_at) BETWEEN 9 AND 21
  WINDOW w AS (PARTITION BY ride_id ORDER BY captured_at)
),
grouped AS (
  SELECT *, sum(is_status_change) OVER (PARTITION BY ride_id ORDER BY captured_at) AS status_group FROM flagged
)"""
)

STG = (
    SNAP
    + """,
stg AS (
  SELECT captured_at, CAST(captured_at AS DATE) AS captured_date, date_part('hour', captured_at) AS captured_hour,
         strftime(captured_at, '%A') AS day_name, isodow(captured_at) >= 6 AS is_weekend,
         park_id, park_name, land_name, ride_id, ride_name, is_open, data_source,
         if(is_open, ifnull(wait_time_minutes, 0), NULL) AS wait_time_minutes
  FROM snap
  WHERE date_part('hour', captured_at) BETWEEN 9 AND 21
)"""
)

RUNS = (
    STG
    + """,
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY ride_id ORDER BY captured_at)
            - row_number() OVER (PARTITION BY ride_id, is_open ORDER BY captured_at) AS gap
  FROM stg
),
runs AS (
  SELECT ride_id, is_open, gap, min(captured_at) AS first_at, max(captured_at) AS last_at,
         row_number() OVER (PARTITION BY ride_id ORDER BY min(captured_at)) AS run_no
  FROM numbered GROUP BY ride_id, is_open, gap
)"""
)


OUTAGES = """
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY ride_id ORDER BY captured_at)
            - row_number() OVER (PARTITION BY ride_id, is_open ORDER BY captured_at) AS gap
  FROM stg
),
outages AS (
  SELECT ride_id, ride_name, park_name, land_name, CAST(min(captured_at) AS DATE) AS downtime_date,
         min(captured_at) AS downtime_started_at, max(captured_at) AS last_observed_closed_at,
         count(*) AS closed_snapshot_count, 15 * count(*) AS downtime_minutes
  FROM numbered WHERE NOT is_open GROUP BY ride_id, ride_name, park_name, land_name, gap
)"""


def _fct(minimum: int = 15) -> str:
    return f"""{STG}, {OUTAGES},
fct AS (
  SELECT md5(concat(ride_id, '|', downtime_started_at)) AS downtime_event_id, *,
         round(downtime_minutes / 60, 2) AS downtime_hours,
         date_part('hour', downtime_started_at) AS started_hour,
         strftime(downtime_started_at, '%A') AS started_day_name,
         CASE WHEN downtime_minutes < 30 THEN 'Brief (<30m)' WHEN downtime_minutes < 60 THEN 'Moderate (30-60m)'
              WHEN downtime_minutes < 120 THEN 'Significant (1-2h)' ELSE 'Major (2h+)' END AS severity_band
  FROM outages WHERE downtime_minutes >= {minimum}
)"""


FCT = _fct()

DAY_BASE = """
day_base AS (
  SELECT captured_date, ride_id, max(ride_name) AS ride_name, max(park_name) AS park_name,
         max(land_name) AS land_name, bool_or(is_weekend) AS is_weekend, max(day_name) AS day_name,
         count(*) AS snapshots, count(*) FILTER (WHERE is_open) AS open_snapshots,
         count(*) FILTER (WHERE is_open IS NOT TRUE) AS closed_snapshots,
         round(avg(wait_time_minutes), 1) AS avg_wait_when_open, max(wait_time_minutes) AS peak_wait
  FROM stg GROUP BY captured_date, ride_id
)"""

DAY_OUTAGES = """
day_outages AS (
  SELECT downtime_date AS captured_date, ride_id, count(*) AS downtime_events,
         CAST(sum(downtime_minutes) AS BIGINT) AS downtime_minutes
  FROM fct GROUP BY downtime_date, ride_id
)"""

RIDE_DAILY = (
    FCT
    + ","
    + DAY_BASE
    + ","
    + DAY_OUTAGES
    + """,
ride_daily AS (
  SELECT captured_date, ride_id, ride_name, park_name, land_name, day_name, is_weekend,
         round(100 * open_snapshots / snapshots, 2) AS uptime_pct,
         ifnull(downtime_events, 0) AS downtime_events, ifnull(downtime_minutes, 0) AS downtime_minutes,
         avg_wait_when_open, peak_wait, snapshots, closed_snapshots
  FROM day_base LEFT JOIN day_outages USING (captured_date, ride_id)
)"""
)

PARK_DAILY = (
    RIDE_DAILY
    + """,
park_daily AS (
  SELECT captured_date, park_name, max(day_name) AS day_name, bool_or(is_weekend) AS is_weekend,
         count(DISTINCT ride_id) AS rides_tracked,
         round(100 * (sum(snapshots) - sum(closed_snapshots)) / sum(snapshots), 2) AS park_uptime_pct,
         CAST(sum(downtime_events) AS BIGINT) AS total_downtime_events,
         CAST(sum(downtime_minutes) AS BIGINT) AS total_downtime_minutes,
         round(sum(downtime_minutes) / 60, 1) AS total_downtime_hours,
         round(CAST(sum(CAST(avg_wait_when_open AS DECIMAL(18, 1))) AS DOUBLE) / count(avg_wait_when_open), 1)
           AS avg_wait_across_rides,
         max(peak_wait) AS peak_wait_in_park,
         count(DISTINCT ride_id) FILTER (WHERE downtime_events > 0) AS rides_with_downtime
  FROM ride_daily GROUP BY captured_date, park_name
)"""
)
RIDE_BASE = """
ride_base AS (
  SELECT ride_id, max(ride_name) AS ride_name, max(park_name) AS park_name, max(land_name) AS land_name,
         count(*) AS total_snapshots, count(*) FILTER (WHERE is_open) AS open_snapshots,
         round(avg(wait_time_minutes), 1) AS avg_wait_when_open, max(wait_time_minutes) AS peak_wait_observed,
         min(captured_at) AS first_observed_at, max(captured_at) AS last_observed_at
  FROM stg GROUP BY ride_id
)"""

RIDE_PROFILE = """
profile AS (
  SELECT ride_id, count(*) AS downtime_event_count, CAST(sum(downtime_minutes) AS BIGINT) AS total_downtime_minutes,
         round(avg(downtime_minutes), 1) AS avg_downtime_minutes, max(downtime_minutes) AS longest_downtime_minutes
  FROM fct GROUP BY ride_id
)"""

DIM = (
    FCT
    + ","
    + RIDE_BASE
    + ","
    + RIDE_PROFILE
    + """,
dim AS (
  SELECT ride_id, ride_name, park_name, land_name, round(100 * open_snapshots / total_snapshots, 2) AS uptime_pct,
         ifnull(downtime_event_count, 0) AS downtime_event_count,
         ifnull(total_downtime_minutes, 0) AS total_downtime_minutes,
         ifnull(avg_downtime_minutes, 0) AS avg_downtime_minutes,
         ifnull(longest_downtime_minutes, 0) AS longest_downtime_minutes,
         avg_wait_when_open, peak_wait_observed,
         round(ifnull(total_downtime_minutes * avg_wait_when_open / 60, 0), 0) AS guest_impact_score,
         total_snapshots, first_observed_at, last_observed_at
  FROM ride_base LEFT JOIN profile USING (ride_id)
)"""
)

PARKS = "park_name IN ('Park 0', 'Park 2')"
IN_RANGE = "BETWEEN DATE '2024-01-16' AND DATE '2024-01-30'"
SCOPE_DAY = f"{PARKS} AND captured_date {IN_RANGE}"
SCOPE_EVENT = f"{PARKS} AND downtime_date {IN_RANGE}"

RIDES = """
rides AS (
  SELECT TIMESTAMP '2024-01-31 12:00:00' AS captured_at, r_regionkey AS park_id, r_name AS park_name,
         if(s_suppkey % 7 = 0, 'Uncategorized', n_name) AS land_name,
         CAST(s_suppkey AS INTEGER) AS ride_id, s_name AS ride_name,
         s_suppkey % 11 <> 0 AND s_acctbal > 0 AS is_open,
         if(s_suppkey % 13 = 0, NULL, CAST(s_suppkey % 90 AS DOUBLE)) AS wait_time_minutes,
         '2024-01-31 12:00:00' AS source_last_updated, 'queue-times-api' AS data_source
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

_SNAP_COLUMNS = """captured_at, park_id, park_name, land_name, ride_id, ride_name, is_open, wait_time_minutes,
       source_last_updated, data_source"""


def _uptime(snapshots: str, closed: str) -> str:
    return f"100.0 * ({snapshots} - {closed}) / greatest({snapshots}, 1)"


def _heatmap() -> str:
    hours = ",\n       ".join(f"count(*) FILTER (WHERE started_hour = {h}) AS h{h}" for h in range(9, 22))
    return f"""WITH {FCT},
week AS (
  SELECT unnest(['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday']) AS started_day_name
),
hits AS (SELECT started_day_name, started_hour FROM fct WHERE {SCOPE_EVENT})
SELECT started_day_name, {hours}
FROM week LEFT JOIN hits USING (started_day_name) GROUP BY started_day_name"""


def _checks() -> str:
    def nulls(table: str, column: str) -> str:
        return f"(SELECT count(*) FROM {table} WHERE {column} IS NULL)"

    def repeats(table: str, column: str) -> str:
        return (
            f"(SELECT count(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL "
            f"GROUP BY {column} HAVING count(*) > 1))"
        )

    bands = "'Brief (<30m)', 'Moderate (30-60m)', 'Significant (1-2h)', 'Major (2h+)'"
    rows = [
        ("K1", "raw_snapshots", "captured_at", "not_null", nulls("snap", "captured_at")),
        ("K2", "raw_snapshots", "ride_id", "not_null", nulls("snap", "ride_id")),
        ("K3", "raw_snapshots", "is_open", "not_null", nulls("snap", "is_open")),
        ("K4", "stg_snapshots", "ride_id", "not_null", nulls("stg", "ride_id")),
        ("K5", "stg_snapshots", "captured_at", "not_null", nulls("stg", "captured_at")),
        ("K6", "stg_snapshots", "is_open", "not_null", nulls("stg", "is_open")),
        ("K7", "fct_downtime_events", "downtime_event_id", "unique", repeats("fct", "downtime_event_id")),
        ("K8", "fct_downtime_events", "downtime_event_id", "not_null", nulls("fct", "downtime_event_id")),
        ("K9", "fct_downtime_events", "ride_id", "not_null", nulls("fct", "ride_id")),
        ("K10", "fct_downtime_events", "downtime_minutes", "not_null", nulls("fct", "downtime_minutes")),
        (
            "K11",
            "fct_downtime_events",
            "severity_band",
            "accepted_values",
            f"(SELECT count(*) FROM fct WHERE severity_band NOT IN ({bands}))",
        ),
        ("K12", "dim_rides", "ride_id", "unique", repeats("dim", "ride_id")),
        ("K13", "dim_rides", "ride_id", "not_null", nulls("dim", "ride_id")),
        ("K14", "dim_rides", "uptime_pct", "not_null", nulls("dim", "uptime_pct")),
        ("K15", "agg_ride_daily", "uptime_pct", "not_null", nulls("ride_daily", "uptime_pct")),
        ("K16", "agg_park_daily", "park_uptime_pct", "not_null", nulls("park_daily", "park_uptime_pct")),
    ]
    selects = [
        f"""SELECT '{i}' AS check_id, '{t}' AS "table", '{c}' AS "column", '{k}' AS kind, {n} AS failing_rows"""
        for i, t, c, k, n in rows
    ]
    dim_only = DIM[len(FCT) :]
    return f"WITH {PARK_DAILY}{dim_only}\n" + "\nUNION ALL\n".join(selects)


ORACLE: dict[str, str] = {
    "raw_snapshots": f"WITH {SNAP} SELECT {_SNAP_COLUMNS} FROM snap",
    "raw_live_wins": f"""WITH {SNAP} SELECT {_SNAP_COLUMNS} FROM snap
WHERE data_source <> 'synthetic' OR NOT EXISTS (SELECT 1 FROM snap WHERE data_source <> 'synthetic')""",
    "raw_include_seed": f"WITH {SNAP} SELECT {_SNAP_COLUMNS} FROM snap",
    "load_audit_span": """SELECT count(*) AS row_count, min(ts) AS first_captured_at, max(ts) AS last_captured_at
FROM events""",
    "load_audit_sources": f"WITH {SNAP} SELECT data_source, count(*) AS n FROM snap GROUP BY data_source",
    "dataset_profile": f"""WITH {SNAP}
SELECT count(*) AS row_count, count(DISTINCT CAST(captured_at AS DATE)) AS partitions,
       count(DISTINCT ride_id) AS rides, avg(CAST(is_open AS INTEGER)) AS open_rate
FROM snap""",
    "flatten_rides": f"WITH {RIDES} SELECT * FROM rides",
    "capture_summary": f"""WITH {RIDES}
SELECT captured_at, park_name, count(*) AS rides, count(*) FILTER (WHERE is_open) AS open_rides
FROM rides GROUP BY captured_at, park_name""",
    "resolve_parks": """SELECT n_name AS park_name, n_nationkey AS park_id FROM nation
WHERE n_name IN ('NATION_1', 'NATION_7', 'NATION_13', 'NATION_99')""",
    "unresolved_parks": """SELECT park_name FROM (VALUES ('NATION_1'), ('NATION_7'), ('NATION_13'), ('NATION_99'))
AS wanted(park_name) WHERE park_name NOT IN (SELECT n_name FROM nation)""",
    "ingest_merge": f"""WITH {SNAP},
hourly AS (SELECT * REPLACE (date_trunc('hour', captured_at) AS captured_at) FROM snap)
SELECT {_SNAP_COLUMNS} FROM hourly
QUALIFY row_number() OVER (PARTITION BY captured_at, ride_id ORDER BY event_id % 2 DESC, event_id DESC) = 1""",
    "landed_stream": f"""WITH {SNAP},
hourly AS (SELECT * REPLACE (date_trunc('hour', captured_at) AS captured_at, 'queue-times-api' AS data_source) FROM snap)
SELECT {_SNAP_COLUMNS} FROM hourly
QUALIFY row_number() OVER (PARTITION BY captured_at, ride_id ORDER BY event_id % 2 DESC, event_id DESC) = 1""",
    "raw_sources_mixed": f"WITH {DIRTY} SELECT {_SNAP_COLUMNS} FROM dirty WHERE data_source IS DISTINCT FROM 'synthetic'",
    "islands_dirty": f"""WITH {DIRTY_GROUPS}
SELECT ride_id, ride_name, park_name, land_name, CAST(min(captured_at) AS DATE) AS downtime_date,
       min(captured_at) AS downtime_started_at, max(captured_at) AS last_observed_closed_at,
       count(*) AS closed_snapshot_count
FROM grouped WHERE NOT is_open GROUP BY ride_id, ride_name, park_name, land_name, status_group""",
    "status_groups_dirty": f"""WITH {DIRTY_GROUPS}
SELECT ride_id, ride_name, park_name, land_name, captured_at, CAST(captured_at AS DATE) AS captured_date, is_open,
       is_status_change, CAST(status_group AS BIGINT) AS status_group
FROM grouped""",
    "flatten_rides_dirty": f"""WITH {RIDES}
SELECT * REPLACE (CASE WHEN ride_id % 17 = 0 OR ride_id % 19 = 0 OR ride_id % 23 = 0 THEN NULL ELSE wait_time_minutes END
       AS wait_time_minutes)
FROM rides WHERE park_id <> 3 AND ride_id % 5 <> 0""",
    "bad_rides": f"""WITH {RIDES}
SELECT captured_at, park_id, park_name, 'x' || ride_id AS ride_id, ride_name FROM rides WHERE park_id <> 3 AND ride_id % 5 = 0""",
    "bad_payloads": """SELECT TIMESTAMP '2024-01-31 12:00:00' AS captured_at, CAST(r_regionkey AS INTEGER) AS park_id,
       r_name AS park_name, count(DISTINCT coalesce(s_suppkey // 500, 0)) AS answers
FROM region JOIN nation ON n_regionkey = r_regionkey LEFT JOIN supplier ON s_nationkey = n_nationkey
WHERE r_regionkey = 3 GROUP BY r_regionkey, r_name""",
    "merge_ties": f"""WITH {SNAP},
hourly AS (SELECT * REPLACE (date_trunc('hour', captured_at) AS captured_at) FROM snap)
SELECT {_SNAP_COLUMNS} FROM hourly
QUALIFY row_number() OVER (PARTITION BY captured_at, ride_id ORDER BY event_id % 2 DESC, event_id) = 1""",
    "stg_snapshots": f"WITH {STG} SELECT * FROM stg",
    "status_changes": f"""WITH {RUNS}
SELECT ride_id, ride_name, park_name, land_name, captured_at, captured_date, is_open,
       CAST(captured_at = first_at AS INTEGER) AS is_status_change
FROM numbered JOIN runs USING (ride_id, is_open, gap)""",
    "status_groups": f"""WITH {RUNS}
SELECT ride_id, ride_name, park_name, land_name, captured_at, captured_date, is_open,
       CAST(captured_at = first_at AS INTEGER) AS is_status_change, run_no AS status_group
FROM numbered JOIN runs USING (ride_id, is_open, gap)""",
    "downtime_islands": f"""WITH {STG}, {OUTAGES}
SELECT * EXCLUDE (downtime_minutes) FROM outages""",
    "fct_downtime_events": f"WITH {FCT} SELECT * FROM fct",
    "fct_min30": f"WITH {_fct(30)} SELECT * FROM fct",
    "ride_day_base": f"WITH {STG}, {DAY_BASE} SELECT * FROM day_base",
    "ride_day_outages": f"WITH {FCT}, {DAY_OUTAGES} SELECT * FROM day_outages",
    "agg_ride_daily": f"WITH {RIDE_DAILY} SELECT * FROM ride_daily",
    "ride_base": f"WITH {STG}, {RIDE_BASE} SELECT * FROM ride_base",
    "ride_downtime_profile": f"WITH {FCT}, {RIDE_PROFILE} SELECT * FROM profile",
    "dim_rides": f"WITH {DIM} SELECT * FROM dim",
    "agg_park_daily": f"WITH {PARK_DAILY} SELECT * FROM park_daily",
    "dash_default_range": f"""WITH {STG}
SELECT min(captured_date) AS min_date, max(captured_date) AS max_date,
       greatest(min(captured_date), max(captured_date) - 29) AS default_start
FROM stg""",
    "dash_filtered_parks": f"WITH {PARK_DAILY} SELECT * FROM park_daily WHERE {SCOPE_DAY}",
    "dash_filtered_rides": f"WITH {RIDE_DAILY} SELECT * FROM ride_daily WHERE {SCOPE_DAY}",
    "dash_filtered_events": f"WITH {FCT} SELECT * FROM fct WHERE {SCOPE_EVENT}",
    "kpi_fleet": f"""WITH {FCT},
days AS (
  SELECT count(*) AS total_snapshots, count(*) FILTER (WHERE is_open IS NOT TRUE) AS closed_snapshots
  FROM stg WHERE {SCOPE_DAY}
),
hits AS (
  SELECT count(*) AS downtime_events, CAST(sum(CAST(downtime_hours AS DECIMAL(18, 2))) AS DOUBLE) AS downtime_hours,
         avg(downtime_minutes) AS avg_outage_minutes
  FROM fct WHERE {SCOPE_EVENT}
)
SELECT total_snapshots, closed_snapshots, {_uptime("total_snapshots", "closed_snapshots")} AS fleet_uptime_pct,
       downtime_events, ifnull(downtime_hours, 0) AS downtime_hours, avg_outage_minutes
FROM days, hits""",
    "kpi_prior_delta": f"""WITH {STG},
now AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE NOT is_open) AS closed FROM stg WHERE {SCOPE_DAY}
),
prior AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE NOT is_open) AS closed
  FROM stg WHERE {PARKS} AND captured_date >= DATE '2024-01-01' AND captured_date < DATE '2024-01-16'
),
both_periods AS (
  SELECT {_uptime("now.n", "now.closed")} AS uptime_pct,
         if(prior.n > 0, {_uptime("prior.n", "prior.closed")}, NULL) AS prior_uptime_pct
  FROM now, prior
)
SELECT *, uptime_pct - prior_uptime_pct AS uptime_delta FROM both_periods""",
    "uptime_trend": f"""WITH {PARK_DAILY},
daily AS (
  SELECT captured_date, CAST(sum(CAST(park_uptime_pct AS DECIMAL(18, 2))) AS DOUBLE) / count(*) AS uptime_pct
  FROM park_daily WHERE {SCOPE_DAY} GROUP BY captured_date
),
back AS (
  SELECT *, lag(uptime_pct, 1, 0) OVER w AS b1, lag(uptime_pct, 2, 0) OVER w AS b2, lag(uptime_pct, 3, 0) OVER w AS b3,
         lag(uptime_pct, 4, 0) OVER w AS b4, lag(uptime_pct, 5, 0) OVER w AS b5, lag(uptime_pct, 6, 0) OVER w AS b6,
         least(row_number() OVER w, 7) AS n
  FROM daily WINDOW w AS (ORDER BY captured_date)
)
SELECT captured_date, uptime_pct, (b6 + b5 + b4 + b3 + b2 + b1 + uptime_pct) / n AS rolling_7d FROM back""",
    "park_scorecard": f"""WITH {PARK_DAILY}
SELECT park_name,
       round_even(CAST(sum(CAST(park_uptime_pct AS DECIMAL(18, 2))) AS DOUBLE) / count(*), 2) AS uptime_pct,
       CAST(sum(total_downtime_events) AS BIGINT) AS events,
       CAST(sum(CAST(total_downtime_hours AS DECIMAL(18, 1))) AS DOUBLE) AS hours
FROM park_daily WHERE {SCOPE_DAY} GROUP BY park_name""",
    "distinct_rides": f"""WITH {RIDE_DAILY}
SELECT park_name, count(DISTINCT ride_id) AS rides_tracked,
       count(DISTINCT ride_id) FILTER (WHERE downtime_events > 0) AS rides_with_downtime
FROM ride_daily WHERE {SCOPE_DAY} GROUP BY park_name""",
    "severity_mix": f"""WITH {FCT}
SELECT severity_band, count(*) AS "count" FROM fct WHERE {SCOPE_EVENT} GROUP BY severity_band""",
    "outage_day_hour": f"""WITH {FCT}
SELECT started_day_name, started_hour, count(*) AS events FROM fct WHERE {SCOPE_EVENT} GROUP BY ALL""",
    "outage_heatmap": _heatmap(),
    "park_list": f"WITH {STG} SELECT DISTINCT park_name FROM stg",
    "top_impact_rides": f"""WITH {DIM}
SELECT ride_id, ride_name, guest_impact_score, uptime_pct, downtime_event_count, avg_wait_when_open
FROM dim WHERE {PARKS} ORDER BY guest_impact_score DESC, ride_id LIMIT 12""",
    "ride_detail": f"""WITH {DIM}
SELECT ride_name, park_name, land_name, uptime_pct, downtime_event_count, avg_downtime_minutes,
       longest_downtime_minutes, avg_wait_when_open, guest_impact_score
FROM dim WHERE {PARKS}""",
    "dq_summary": _checks(),
}
