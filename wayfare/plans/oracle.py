"""SQL equivalents of the registered queries, for DuckDB over the same tables.

Amounts are added as DECIMAL and averaged once, durations are counted in whole seconds:
the plain-SQL way to a result that does not depend on the order of rows.
"""

from __future__ import annotations


def _trips(zone: str, name: str) -> str:
    return f"""{name} AS (
  SELECT event_id AS trip_id, ts AS pickup, ts + to_minutes(5 + k % 55) AS dropoff,
    nullif(event_id % 7, 0) AS passengers, k / 4.0 AS distance,
    CASE WHEN event_id % 97 <> 0 THEN CAST({zone} AS VARCHAR) END AS pickup_zone,
    CAST(k + 1 AS VARCHAR) AS dropoff_zone,
    CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3 END AS payment,
    value AS fare,
    CASE event_type WHEN 'error' THEN -value WHEN 'purchase' THEN value + k / 10.0 ELSE value END
      AS total,
    CASE event_type WHEN 'purchase' THEN k / 10.0 ELSE 0.0 END AS tip,
    date_diff('second', date_trunc('second', ts),
      date_trunc('second', ts + to_minutes(5 + k % 55))) AS seconds
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
)"""


TRIPS = _trips("user_id + 1", "trips")
BUSY = _trips("user_id % 20", "trips")

RAW = """trip_id, pickup AS tpep_pickup_datetime, dropoff AS tpep_dropoff_datetime,
  passengers AS passenger_count, distance AS trip_distance, pickup_zone, dropoff_zone,
  CAST(payment AS BIGINT) AS payment_type, fare AS fare_amount, total AS total_amount,
  tip AS tip_amount"""
RAW_NO_ID = RAW.removeprefix("trip_id, ")
MINUTES = "seconds / 60.0 AS duration_minutes"


def _sum(column: str) -> str:
    """Through text, since a wide decimal is rounded twice on its way to a double."""
    return f"CAST(CAST(SUM(CAST({column} AS DECIMAL(38, 12))) AS VARCHAR) AS DOUBLE)"


def _avg(column: str) -> str:
    return f"{_sum(column)} / nullif(COUNT({column}), 0)"


def _avg_rows(column: str) -> str:
    """Mean over all rows, a missing value being zero."""
    return f"coalesce({_sum(column)}, 0.0) / COUNT(*)"


AVG_MINUTES = "CAST(SUM(seconds) AS DOUBLE) / 60.0 / COUNT(seconds)"


def _count_if(condition: str) -> str:
    return f"CAST(COUNT(*) FILTER (WHERE {condition}) AS BIGINT)"


DAILY_MEASURES = f"""COUNT(*) AS total_trips, {_sum('total')} AS total_revenue,
  {_avg('fare')} AS avg_fare, {_avg('distance')} AS avg_distance,
  {AVG_MINUTES} AS avg_duration_minutes, {_avg('passengers')} AS avg_passengers,
  {_count_if('payment = 1')} AS credit_card_trips, {_count_if('payment = 2')} AS cash_trips,
  {_avg('tip')} AS avg_tip, MAX(total) AS max_fare,
  MIN(total) FILTER (WHERE total > 0) AS min_fare"""
HOURLY_MEASURES = f"""COUNT(*) AS trip_count, {_sum('total')} AS total_revenue,
  {_avg('fare')} AS avg_fare, {_avg('distance')} AS avg_distance,
  {AVG_MINUTES} AS avg_duration, {_avg('passengers')} AS avg_passengers"""
ROUTE_MEASURES = f"""COUNT(*) AS route_count, {_avg('fare')} AS avg_fare,
  {_avg('distance')} AS avg_distance, {AVG_MINUTES} AS avg_duration_minutes,
  {_sum('total')} AS total_revenue"""


def _daily(where: str = "true") -> str:
    return f"""SELECT CAST(pickup AS DATE) AS "date", {DAILY_MEASURES}
  FROM trips WHERE {where} GROUP BY 1"""


def _hourly(where: str = "true") -> str:
    return f"""SELECT CAST(pickup AS DATE) AS "date", CAST(hour(pickup) AS INTEGER) AS "hour",
  pickup_zone AS zone_id, {HOURLY_MEASURES} FROM trips WHERE {where} GROUP BY 1, 2, 3"""


def _routes(where: str = "true") -> str:
    return f"""SELECT pickup_zone, dropoff_zone, {ROUTE_MEASURES}
  FROM trips WHERE {where} GROUP BY 1, 2"""


def _bounds(width: str) -> str:
    return f"""time_bucket(INTERVAL '{width}', pickup) AS window_start,
  time_bucket(INTERVAL '{width}', pickup) + INTERVAL '{width}' AS window_end"""


KNOWN = "pickup_zone IS NOT NULL AND pickup_zone <> ''"


def _windows(width: str = "1 minute", cash: str = "payment = 2", credit: str = "payment = 1") -> str:
    return f"""SELECT pickup_zone AS zone_id, {_bounds(width)}, COUNT(*) AS trip_count,
  coalesce({_sum('total')}, 0.0) AS total_revenue, {_avg_rows('fare')} AS avg_fare,
  {_avg_rows('distance')} AS avg_distance, {_avg_rows('passengers')} AS avg_passengers,
  {_count_if(cash)} AS payment_cash_count, {_count_if(credit)} AS payment_credit_count
  FROM trips WHERE {KNOWN} GROUP BY 1, 2, 3"""


def _windows_nulls_skipped(width: str) -> str:
    return f"""SELECT pickup_zone AS zone_id, {_bounds(width)}, COUNT(*) AS trip_count,
  {_sum('total')} AS total_revenue, {_avg('fare')} AS avg_fare,
  {_avg('distance')} AS avg_distance, {_avg('passengers')} AS avg_passengers,
  {_count_if('payment = 2')} AS payment_cash_count,
  {_count_if('payment = 1')} AS payment_credit_count
  FROM trips WHERE {KNOWN} GROUP BY 1, 2, 3"""


def _global(width: str) -> str:
    return f"""SELECT {_bounds(width)}, COUNT(*) AS total_trips,
  coalesce({_sum('total')}, 0.0) AS total_revenue, {_avg_rows('fare')} AS avg_fare,
  {_avg_rows('distance')} AS avg_trip_distance, {_avg_rows('passengers')} AS avg_passengers
  FROM trips WHERE {KNOWN} GROUP BY 1, 2"""


def _ranked(windows: str, where: str = "true", k: int = 5) -> str:
    return f"""SELECT window_start AS update_time, zone_id, CAST(place AS INTEGER) AS zone_rank,
  trip_count, total_revenue
  FROM (SELECT *, row_number() OVER (
    PARTITION BY window_start ORDER BY trip_count DESC, zone_id) AS place FROM {windows})
  WHERE place <= {k} AND {where}"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


AS_OF = "TIMESTAMP '2024-01-30 00:00:00'"
DAY = "CAST(pickup AS DATE) = DATE '2024-01-05'"

# First rule a trip breaks; the order is the order of the rules.
REJECT_REASON = """CASE
  WHEN pickup IS NULL THEN 'missing_pickup_time'
  WHEN dropoff IS NULL THEN 'missing_dropoff_time'
  WHEN NOT coalesce(dropoff >= pickup, false) THEN 'dropoff_before_pickup'
  WHEN NOT coalesce(distance > 0, false) THEN 'distance_not_positive'
  WHEN NOT coalesce(fare > 0, false) THEN 'fare_not_positive'
  WHEN NOT coalesce(total > 0, false) THEN 'total_not_positive'
  WHEN NOT coalesce(passengers BETWEEN 1 AND 6, false) THEN 'passengers_out_of_range'
  WHEN NOT coalesce(CAST(pickup_zone AS INTEGER) BETWEEN 1 AND 265, false)
    THEN 'pickup_zone_out_of_range'
  WHEN NOT coalesce(CAST(dropoff_zone AS INTEGER) BETWEEN 1 AND 265, false)
    THEN 'dropoff_zone_out_of_range'
  END"""

# Payment payloads by trip id modulo six: 1, 2, "CREDIT", "cash", "1", 2.0.
JSON_CREDIT = "trip_id % 6 IN (0, 2)"
JSON_CASH = "trip_id % 6 IN (1, 3)"
JSON_OK = "trip_id % 101 <> 0"

OLD_DAYS = f"old AS ({_daily('pickup < TIMESTAMP ' + chr(39) + '2024-01-21' + chr(39))})"
NEW_DAYS = f"""new AS (SELECT * REPLACE (total_trips + 1000 AS total_trips,
    total_revenue * 2 AS total_revenue, avg_fare * 2 AS avg_fare, avg_tip * 2 AS avg_tip)
  FROM ({_daily('pickup >= TIMESTAMP ' + chr(39) + '2024-01-16' + chr(39))}))"""


def _half_up(units: str, count: str) -> str:
    """Mean of 1/10,000 units as DECIMAL with two digits, by whole-number division."""
    magnitude = f"(2 * abs({units}) + 100 * {count}) // (200 * {count})"
    return f"CAST(sign({units}) * {magnitude} AS BIGINT)"


def _cents(expression: str, type_name: str) -> str:
    return f"CAST(CAST({expression} AS DECIMAL(18, 0)) * 0.01 AS {type_name})"


def _units(column: str) -> str:
    return f"CAST(SUM(CAST({column} AS DECIMAL(18, 4))) * 10000 AS HUGEINT)"


ORACLE_SQL: dict[str, str] = {
    "trips_enriched": f"{_with(TRIPS)} SELECT {RAW}, {MINUTES} FROM trips",
    "trips_from_drifted_files": f"{_with(TRIPS)} SELECT {RAW_NO_ID}, {MINUTES} FROM trips",
    "trips_from_merged_files": f"""{_with(TRIPS)}
SELECT * REPLACE (CASE WHEN tpep_pickup_datetime >= TIMESTAMP '2024-01-16' THEN tip_amount END
  AS tip_amount) FROM (SELECT {RAW}, {MINUTES} FROM trips)""",
    "grid_zones": """WITH points AS (
  SELECT event_id, 40450000 + event_id * 37 % 620 * 1000 AS lat,
    -74350000 + event_id * 53 % 720 * 1000 AS lon FROM events)
SELECT event_id AS trip_id,
  CASE WHEN lat >= 40500000 AND lat < 41000000 AND lon >= -74300000 AND lon < -73700000
    THEN 'zone_' || ((lat - 40500000) // 10000) || '_' || ((lon + 74300000) // 10000) END
    AS pickup_zone
FROM points""",
    "valid_trips": f"{_with(TRIPS)} SELECT {RAW} FROM trips WHERE {REJECT_REASON} IS NULL",
    "rejected_by_reason": f"""{_with(TRIPS)} SELECT {REJECT_REASON} AS reject_reason,
  COUNT(*) AS trip_count FROM trips WHERE {REJECT_REASON} IS NOT NULL GROUP BY 1""",
    "json_trips": f"""{_with(BUSY)} SELECT trip_id, pickup AS tpep_pickup_datetime,
  dropoff AS tpep_dropoff_datetime, CAST(passengers AS INTEGER) AS passenger_count,
  distance AS trip_distance, {JSON_CREDIT} AS is_credit, {JSON_CASH} AS is_cash,
  fare AS fare_amount, tip AS tip_amount, total AS total_amount, pickup_zone, dropoff_zone
FROM trips WHERE {JSON_OK}""",
    "json_rejects": f"""{_with(BUSY)} SELECT '{{"payment_ty' AS value,
  'malformed_json' AS reject_reason FROM trips WHERE NOT ({JSON_OK})""",
    "payment_class_counts": f"""{_with(BUSY)} SELECT {JSON_CREDIT} AS is_credit,
  {JSON_CASH} AS is_cash, COUNT(*) AS trip_count FROM trips WHERE {JSON_OK} GROUP BY 1, 2""",
    "message_fates": _with(BUSY)
    + f"""SELECT CASE WHEN NOT ({JSON_OK}) THEN 'malformed_json'
    WHEN trip_id % 103 = 0 THEN 'bad_event_time'
    WHEN trip_id % 107 = 0 THEN 'missing_event_time'
    WHEN pickup_zone IS NULL THEN 'no_zone' ELSE 'in_window' END AS fate, COUNT(*) AS messages
FROM trips GROUP BY 1 UNION ALL SELECT 'all', COUNT(*) FROM trips""",
    "daily_summary": _with(TRIPS) + _daily(),
    "daily_summary_for_date": _with(TRIPS) + _daily(DAY),
    "hourly_zone_stats": _with(TRIPS) + _hourly(),
    "hourly_zone_stats_for_date": _with(TRIPS) + _hourly(DAY),
    "zone_window_1m": _with(BUSY) + _windows(),
    "zone_window_5m": _with(BUSY) + _windows("5 minutes"),
    "zone_window_nulls_skipped": _with(BUSY) + _windows_nulls_skipped("1 hour"),
    "zone_hour_from_minute_partials": _with(BUSY) + _windows("1 hour"),
    "global_window_1m": _with(TRIPS) + _global("1 minute"),
    "route_analysis": _with(TRIPS) + _routes(),
    "route_analysis_by_days": _with(TRIPS) + _routes(),
    "route_analysis_no_self": _with(TRIPS) + _routes("pickup_zone IS DISTINCT FROM dropoff_zone"),
    "daypart_profile": f"""{_with(BUSY, f'stats AS ({_hourly()})')}
SELECT zone_id,
  CASE WHEN "hour" BETWEEN 8 AND 9 OR "hour" BETWEEN 17 AND 19 THEN 'peak'
    WHEN "hour" BETWEEN 1 AND 5 THEN 'night' ELSE 'off_peak' END AS daypart,
  isodow("date") >= 6 AS is_weekend,
  CAST(SUM(trip_count) AS BIGINT) AS trip_count, {_sum('total_revenue')} AS total_revenue,
  {_sum('avg_fare * trip_count')} / SUM(trip_count) FILTER (WHERE avg_fare IS NOT NULL)
    AS avg_fare,
  {_sum('avg_distance * trip_count')} / SUM(trip_count) FILTER (WHERE avg_distance IS NOT NULL)
    AS avg_distance,
  CAST(SUM(CAST(round(avg_duration * trip_count * 60000) AS BIGINT)) AS DOUBLE) / 60000.0
    / SUM(trip_count) FILTER (WHERE avg_duration IS NOT NULL) AS avg_duration
FROM stats GROUP BY 1, 2, 3""",
    "top_routes": _with(TRIPS, f"routes AS ({_routes()})")
    + "SELECT * FROM routes ORDER BY route_count DESC, pickup_zone NULLS FIRST, dropoff_zone LIMIT 20",
    "top_active_zones": _with(BUSY, f"windows AS ({_windows('1 hour')})") + _ranked("windows"),
    "top_zones_total": _with(TRIPS)
    + f"""SELECT pickup_zone AS zone_id, COUNT(*) AS trip_count FROM trips WHERE {KNOWN}
  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "recent_windows_24h": _with(BUSY, f"windows AS ({_windows()})")
    + f"SELECT * FROM windows WHERE window_start >= {AS_OF} - INTERVAL 24 HOURS",
    "retained_windows_7d": _with(BUSY, f"windows AS ({_windows()})")
    + f"SELECT * FROM windows WHERE window_start >= {AS_OF} - INTERVAL 7 DAYS",
    "rebucket_5m_last_hour": _with(BUSY, f"windows AS ({_windows()})")
    + f"""SELECT time_bucket(INTERVAL '5 minutes', window_start) AS window_start,
  time_bucket(INTERVAL '5 minutes', window_start) + INTERVAL '5 minutes' AS window_end,
  CAST(SUM(trip_count) AS BIGINT) AS trip_count
FROM windows w WHERE w.window_start >= {AS_OF} - INTERVAL 1 HOUR AND w.window_start < {AS_OF}
GROUP BY 1, 2""",
    "revenue_series": _with(TRIPS, f"windows AS ({_windows()})")
    + f"SELECT window_start, {_sum('total_revenue')} AS total_revenue FROM windows GROUP BY 1",
    "latest_windows": _with(BUSY, f"windows AS ({_windows()})")
    + "SELECT * FROM windows ORDER BY window_start DESC, trip_count DESC, zone_id LIMIT 100",
    "busiest_windows": _with(BUSY, f"windows AS ({_windows('1 hour')})")
    + "SELECT * FROM windows ORDER BY trip_count DESC, window_start DESC, zone_id LIMIT 100",
    "latest_windows_ordered": _with(BUSY, f"windows AS ({_windows()})")
    + "SELECT * FROM windows ORDER BY window_start DESC, trip_count DESC, zone_id LIMIT 100",
    "busiest_windows_ordered": _with(BUSY, f"windows AS ({_windows('1 hour')})")
    + "SELECT * FROM windows ORDER BY trip_count DESC, window_start DESC, zone_id LIMIT 100",
    "table_inventory": _with(
        TRIPS,
        f"zones AS ({_windows()})",
        f"daily AS ({_daily()})",
        f"hourly AS ({_hourly()})",
        f"routes AS ({_routes()})",
    )
    + """SELECT 'real_time_zones' AS table_name, COUNT(*) AS record_count,
  CAST(MIN(window_start) AS VARCHAR) AS earliest_data,
  CAST(MAX(window_start) AS VARCHAR) AS latest_data FROM zones
UNION ALL SELECT 'daily_summary', COUNT(*), CAST(MIN("date") AS VARCHAR),
  CAST(MAX("date") AS VARCHAR) FROM daily
UNION ALL SELECT 'hourly_zone_stats', COUNT(*), CAST(MIN("date") AS VARCHAR),
  CAST(MAX("date") AS VARCHAR) FROM hourly
UNION ALL SELECT 'route_analysis', COUNT(*), 'N/A', 'N/A' FROM routes""",
    "table_counts": _with(TRIPS, f"daily AS ({_daily()})", f"routes AS ({_routes()})")
    + """SELECT 'daily_summary' AS table_name, COUNT(*) AS record_count FROM daily
UNION ALL SELECT 'route_analysis', COUNT(*) FROM routes ORDER BY table_name""",
    "dataset_profile": _with(TRIPS)
    + """SELECT COUNT(*) AS row_count, CAST(11 AS INTEGER) AS column_count,
  MIN(pickup) AS first_pickup, MAX(pickup) AS last_pickup FROM trips""",
    "view_last_24h": _with(BUSY, f"windows AS ({_windows()})")
    + f"SELECT * FROM windows WHERE window_start >= {AS_OF} - INTERVAL 24 HOURS",
    "stored_tables_sql": _with(
        BUSY,
        f"daily AS ({_daily()})",
        f"hourly AS ({_hourly()})",
        f"routes AS ({_routes()})",
        f"zones AS ({_windows()})",
        f"everywhere AS ({_global('1 minute')})",
        f"hours AS ({_windows('1 hour')})",
        f"active AS ({_ranked('hours', k=10)})",
    )
    + """SELECT 'daily_summary' AS table_name, COUNT(*) AS record_count,
  CAST(SUM(total_trips) AS BIGINT) AS trips FROM daily
UNION ALL SELECT 'hourly_zone_stats', COUNT(*), CAST(SUM(trip_count) AS BIGINT) FROM hourly
UNION ALL SELECT 'route_analysis', COUNT(*), CAST(SUM(route_count) AS BIGINT) FROM routes
UNION ALL SELECT 'real_time_zones', COUNT(*), CAST(SUM(trip_count) AS BIGINT) FROM zones
UNION ALL SELECT 'real_time_global', COUNT(*), CAST(SUM(total_trips) AS BIGINT) FROM everywhere
UNION ALL SELECT 'top_active_zones', COUNT(*), CAST(SUM(trip_count) AS BIGINT) FROM active""",
    "merge_insert_absent": _with(TRIPS, OLD_DAYS, NEW_DAYS)
    + """SELECT * FROM old UNION ALL BY NAME
SELECT * FROM new WHERE "date" NOT IN (SELECT "date" FROM old)""",
    "merge_insert_absent_repeated": _with(TRIPS, OLD_DAYS, NEW_DAYS)
    + """SELECT * FROM old UNION ALL BY NAME SELECT * REPLACE (total_trips + 1 AS total_trips)
FROM new WHERE "date" NOT IN (SELECT "date" FROM old)""",
    "merge_partial_repeated": _with(TRIPS, OLD_DAYS, NEW_DAYS)
    + """SELECT old.* REPLACE (coalesce(new.total_trips + 2, old.total_trips) AS total_trips,
  coalesce(new.total_revenue, old.total_revenue) AS total_revenue,
  coalesce(new.avg_fare, old.avg_fare) AS avg_fare)
FROM old LEFT JOIN new ON old."date" = new."date" UNION ALL BY NAME
SELECT * REPLACE (total_trips + 2 AS total_trips)
FROM new WHERE "date" NOT IN (SELECT "date" FROM old)""",
    "merge_replace": _with(TRIPS, OLD_DAYS, NEW_DAYS)
    + """SELECT * FROM old WHERE "date" NOT IN (SELECT "date" FROM new) UNION ALL BY NAME
SELECT * REPLACE (total_trips + 2 AS total_trips) FROM new""",
    "merge_partial": _with(TRIPS, OLD_DAYS, NEW_DAYS)
    + """SELECT old.* REPLACE (coalesce(new.total_trips, old.total_trips) AS total_trips,
  coalesce(new.total_revenue, old.total_revenue) AS total_revenue,
  coalesce(new.avg_fare, old.avg_fare) AS avg_fare)
FROM old LEFT JOIN new ON old."date" = new."date" UNION ALL BY NAME
SELECT * FROM new WHERE "date" NOT IN (SELECT "date" FROM old)""",
    "constraint_report": _with(TRIPS, f"stats AS ({_hourly()})")
    + """SELECT 'unique_key' AS rule, COUNT(*) AS violations
FROM (SELECT 1 FROM stats GROUP BY "date", "hour", zone_id HAVING COUNT(*) > 1)
UNION ALL SELECT 'date_not_null', COUNT(*) FILTER (WHERE "date" IS NULL) FROM stats
UNION ALL SELECT 'hour_not_null', COUNT(*) FILTER (WHERE "hour" IS NULL) FROM stats
UNION ALL SELECT 'zone_id_not_null', COUNT(*) FILTER (WHERE zone_id IS NULL) FROM stats
UNION ALL SELECT 'hour_between_0_and_23',
  COUNT(*) FILTER (WHERE NOT ("hour" >= 0 AND "hour" <= 23)) FROM stats
UNION ALL SELECT 'zone_id_at_most_50_characters',
  COUNT(*) FILTER (WHERE length(zone_id) > 50) FROM stats""",
    "duplicate_keys": _with(TRIPS, f"stats AS ({_hourly()})")
    + """SELECT "hour", zone_id, COUNT(*) AS "rows" FROM stats
GROUP BY 1, 2 HAVING COUNT(*) > 1""",
    "schema_migrated": _with(TRIPS, f"daily AS ({_daily()})")
    + """SELECT "date", total_trips, total_revenue, avg_fare, avg_distance, avg_duration_minutes,
  avg_passengers, CAST(0 AS BIGINT) AS credit_card_trips, CAST(0 AS BIGINT) AS cash_trips,
  CAST(0 AS DOUBLE) AS avg_tip, CAST(0 AS DOUBLE) AS max_fare, CAST(0 AS DOUBLE) AS min_fare
FROM daily""",
    "money_decimal_variant": _with(
        TRIPS,
        f"""sums AS (SELECT CAST(pickup AS DATE) AS "date", COUNT(*) AS total_trips,
  {_units('total')} AS revenue, {_units('fare')} AS fare, COUNT(fare) AS n_fare,
  {_units('distance')} AS distance, COUNT(distance) AS n_distance,
  {_units('passengers')} AS passengers, COUNT(passengers) AS n_passengers,
  CAST(SUM(seconds) AS HUGEINT) AS seconds, COUNT(seconds) AS n_seconds
  FROM trips GROUP BY 1)""",
    )
    + f"""SELECT "date", total_trips,
  {_cents(_half_up('revenue', '1'), 'DECIMAL(12, 2)')} AS total_revenue,
  {_cents(_half_up('fare', 'n_fare'), 'DECIMAL(8, 2)')} AS avg_fare,
  {_cents(_half_up('distance', 'n_distance'), 'DECIMAL(8, 2)')} AS avg_distance,
  {_cents('(200 * seconds + 60 * n_seconds) // (120 * n_seconds)', 'DECIMAL(8, 2)')}
    AS avg_duration_minutes,
  {_cents(_half_up('passengers', 'n_passengers'), 'DECIMAL(4, 2)')} AS avg_passengers
FROM sums""",
    "decimal_layouts": _with(
        BUSY,
        f"daily AS ({_daily()})",
        f"hourly AS ({_hourly()})",
        f"routes AS ({_routes()})",
        f"zones AS ({_windows()})",
        f"everywhere AS ({_global('1 minute')})",
        f"hours AS ({_windows('1 hour')})",
        f"active AS ({_ranked('hours', k=10)})",
    )
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, COUNT(*) AS record_count,
  CAST(SUM(CAST(total_revenue AS DECIMAL(12, 2))) AS DECIMAL(18, 2)) AS total_revenue FROM {rows}"""
        for name, rows in (
            ("real_time_zones", "zones"),
            ("real_time_global", "everywhere"),
            ("top_active_zones", "active"),
            ("daily_summary", "daily"),
            ("hourly_zone_stats", "hourly"),
            ("route_analysis", "routes"),
        )
    ),
    "partitioned_roundtrip": f"""{_with(TRIPS)}
SELECT {RAW}, CAST(pickup AS DATE) AS pickup_date FROM trips""",
    "monthly_windows_roundtrip": f"""{_with(BUSY, f'windows AS ({_windows()})')}
SELECT *, strftime(window_start, '%Y-%m') AS "month" FROM windows""",
    "trips_zero_filled": f"""{_with(TRIPS)} SELECT * REPLACE (
  coalesce(passenger_count, 0) AS passenger_count) FROM (SELECT {RAW} FROM trips)""",
    # Adding zero turns a negative zero, which is the same number, into the plain one.
    "trips_rounded": f"""{_with(TRIPS)} SELECT trip_id, round(distance / 7, 2) AS trip_distance,
  round(total / 7, 2) + 0.0 AS total_amount, round(seconds / 60.0 / 7, 2) AS duration_minutes
FROM trips""",
    "publish_keys": f"""{_with(BUSY)}
SELECT trip_id, pickup_zone, pickup_zone AS partition_key, true AS stamped FROM trips""",
    "merge_windows_keep_end": _with(
        BUSY,
        f"windows AS ({_windows('1 hour')})",
        "old AS (SELECT * FROM windows WHERE window_start < TIMESTAMP '2024-01-21')",
        """new AS (SELECT * REPLACE (trip_count + 1 AS trip_count,
    window_end + INTERVAL 1 DAY AS window_end)
  FROM windows WHERE window_start >= TIMESTAMP '2024-01-16')""",
    )
    + """SELECT new.* REPLACE (coalesce(old.window_end, new.window_end) AS window_end)
FROM new LEFT JOIN old USING (zone_id, window_start) UNION ALL BY NAME
SELECT * FROM old WHERE window_start < TIMESTAMP '2024-01-16'""",
    "replay_schedule": _with(TRIPS)
    + """, chosen AS (SELECT * FROM trips WHERE strftime(pickup, '%Y-%m') = '2024-01'
  AND pickup >= TIMESTAMP '2024-01-03 00:00:00')
SELECT trip_id, pickup AS tpep_pickup_datetime,
  date_diff('second', (SELECT date_trunc('second', MIN(pickup)) FROM chosen),
    date_trunc('second', pickup)) / 1000.0 AS due_seconds
FROM chosen""",
    "replay_schedule_limited": _with(TRIPS)
    + """, due AS (
  SELECT trip_id, pickup, CAST(round(date_diff('second', (SELECT date_trunc('second', MIN(pickup)) FROM trips),
    date_trunc('second', pickup)) * 1000000 / 100000.0) AS BIGINT) AS due_micros FROM trips),
queue AS (SELECT *, row_number() OVER (ORDER BY due_micros, trip_id % 64, trip_id) AS i FROM due)
SELECT trip_id, pickup AS tpep_pickup_datetime, due_micros, CAST((i * 1000000
  + MAX(due_micros * 40 - i * 1000000) OVER (ORDER BY i)) // 40 AS BIGINT) AS sent_micros
FROM queue""",
    "append_violations": f"""{_with(TRIPS, f'hours AS ({_hourly()})')}
SELECT date, hour, zone_id, CAST(2 AS BIGINT) AS rows FROM hours
WHERE date BETWEEN DATE '2024-01-18' AND DATE '2024-01-20'""",
    "rolled_up_hours": _with(BUSY) + _windows("1 hour"),
    "rolled_up_days": _with(BUSY) + _windows("1 day"),
    "stream_zone_window": _with(BUSY) + _windows(),
    "stream_zone_window_append": _with(BUSY) + _windows(),
    "stream_publish": _with(BUSY) + _windows(),
    "stream_global_window": _with(BUSY) + _global("5 minutes"),
    "stream_top_zones": _with(BUSY, f"windows AS ({_windows('1 hour')})") + _ranked("windows"),
    "stream_processing_time": _with(BUSY)
    + f"""SELECT pickup_zone AS zone_id, COUNT(*) AS trip_count FROM trips
WHERE {KNOWN} GROUP BY 1""",
    "stream_closed_by_clock": _with(BUSY)
    + f"""SELECT pickup_zone AS zone_id, COUNT(*) AS trip_count FROM trips
WHERE {KNOWN} GROUP BY 1""",
    "stream_messages": _with(
        BUSY.replace("trips AS (", "all_trips AS ("),
        f"trips AS (SELECT * FROM all_trips WHERE {JSON_OK})",
    )
    + _windows("5 minutes", JSON_CASH, JSON_CREDIT),
    "stream_rejects": f"""{_with(BUSY)} SELECT '{{"payment_ty' AS value,
  'malformed_json' AS reject_reason FROM trips WHERE NOT ({JSON_OK})""",
    "stream_replay": _with(TRIPS)
    + """SELECT trip_id, pickup AS tpep_pickup_datetime, pickup_zone, total AS total_amount
FROM trips WHERE strftime(pickup, '%Y-%m') = '2024-01'
  AND pickup >= TIMESTAMP '2024-01-03 00:00:00'""",
}
