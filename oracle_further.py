"""SQL of the queries in ``tripweave.plans.further``, for DuckDB over the same tables."""

from __future__ import annotations

from collections.abc import Callable

EVENTS = """, zone_events AS (
  SELECT CAST(least(user_id % 25, 12) AS INTEGER) AS zone, ts AS event_at, event_type, event_id
  FROM events
  QUALIFY row_number() OVER (PARTITION BY zone, ts ORDER BY event_type DESC, event_id DESC) = 1
)"""

STEPS = """, steps AS (
  SELECT PULocationID, tpep_pickup_datetime AS moment, 1 AS step FROM trips
  UNION ALL SELECT PULocationID, tpep_dropoff_datetime, -1 FROM trips
), by_zone AS (
  SELECT PULocationID, moment, CAST(sum(s) OVER (PARTITION BY PULocationID ORDER BY moment) AS BIGINT) AS under_way
  FROM (SELECT PULocationID, moment, sum(step) AS s FROM steps GROUP BY ALL)
), overall AS (
  SELECT moment, CAST(sum(s) OVER (ORDER BY moment) AS BIGINT) AS under_way
  FROM (SELECT moment, sum(step) AS s FROM steps GROUP BY ALL)
)"""
FIRST_AT = "arg_max(moment, (under_way, -epoch_us(moment))) AS first_at"

SESSIONS = """WITH held AS (
  SELECT *, ts + to_seconds(CASE WHEN event_type = 'purchase' THEN 172800 ELSE 86400 END) AS until
  FROM events
), opened AS (
  SELECT *, max(until) OVER (PARTITION BY user_id ORDER BY ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS open FROM held
), numbered AS (
  SELECT *, sum(CASE WHEN open IS NULL OR ts > open THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM opened
), found AS (
  SELECT user_id, min(ts) AS session_start, max(ts) AS last_at, max(until) AS session_end,
    count(*) AS n_rows, {total} AS total
  FROM numbered GROUP BY user_id, no
) """

DAYS = ", days AS (SELECT {keys}, trip_date, count(*) AS n FROM trips GROUP BY ALL)"

SNAPSHOTS = """, before AS (
  SELECT tpep_pickup_datetime, PULocationID, DOLocationID, passenger_count, payment_type, fare_amount FROM raw
), kept AS (
  SELECT * REPLACE (fare_amount + CASE WHEN passenger_count = 5 THEN 1e0 ELSE 0e0 END AS fare_amount)
  FROM before WHERE NOT coalesce(passenger_count = 3 AND payment_type = 2, FALSE)
), after AS (
  SELECT * FROM kept UNION ALL SELECT * FROM kept WHERE payment_type = 4
), folded AS (
  SELECT * EXCLUDE (o, n), sum(o) AS o, sum(n) AS n FROM (
    SELECT *, 1 AS o, 0 AS n FROM before UNION ALL SELECT *, 0, 1 FROM after) GROUP BY ALL
), keyed AS (
  SELECT tpep_pickup_datetime, PULocationID, sum(greatest(n - o, 0)) AS more, sum(greatest(o - n, 0)) AS less,
    sum(least(o, n)) AS kept, sum(greatest(n - 1, 0)) AS repeated
  FROM folded GROUP BY ALL
), changes AS (
  SELECT tpep_pickup_datetime, PULocationID, CAST(more - least(more, less) AS BIGINT) AS added,
    CAST(less - least(more, less) AS BIGINT) AS removed, CAST(least(more, less) AS BIGINT) AS changed,
    CAST(kept AS BIGINT) AS kept, CAST(repeated AS BIGINT) AS repeated FROM keyed
)"""

TEXTS = """WITH texts AS (
  SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL
    WHEN event_id % 7 = 0 THEN substr(props, 1, length(props) - 1) ELSE props END AS props FROM events
) """


def queries(trips: str, sharing: str, r: Callable[[str], str], features: list[str]) -> dict[str, str]:
    group = "time_window, PULocationID, DOLocationID, n_trips, total_passengers, first_pickup, last_pickup, " + ", ".join(
        f"{r(c)} AS {c}" for c in ("avg_km", "avg_fare", "avg_minutes", "spread_minutes")
    )
    sessions = SESSIONS.format(total=r("sum(value)"))
    last = "t.tpep_pickup_datetime, t.PULocationID, t.fare_amount, e.event_at, e.event_type, e.event_id"
    sums = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("added", "removed", "changed", "kept", "repeated"))
    scaled = ", ".join(
        r(f"({f} - avg({f}) OVER ()) / stddev_samp({f}) OVER ()") + f" AS scaled_{f}" for f in features
    )
    return {
        "stream_share_groups": (
            f"{trips}{sharing} SELECT {group} FROM groups WHERE (time_window + 1) * 300 <= "
            "epoch((SELECT max(tpep_pickup_datetime) FROM candidates)) - 3600"
        ),
        "user_sessions": f"{sessions}SELECT * FROM found",
        "stream_user_sessions": (
            f"{sessions}SELECT * FROM found WHERE session_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"
        ),
        "asof_last_event": (
            f"{trips}{EVENTS} SELECT {last} FROM trips t ASOF LEFT JOIN zone_events e "
            "ON t.PULocationID = e.zone AND t.tpep_pickup_datetime >= e.event_at"
        ),
        "asof_event_within_hour": (
            f"{trips}{EVENTS} SELECT {last} FROM trips t ASOF JOIN zone_events e "
            "ON t.PULocationID = e.zone AND t.tpep_pickup_datetime > e.event_at "
            "WHERE epoch_us(t.tpep_pickup_datetime) - epoch_us(e.event_at) <= 3600000000"
        ),
        "overlaps_by_route": (
            f"{trips}, numbered AS (SELECT *, row_number() OVER () AS id FROM trips), pairs AS ("
            "SELECT a.PULocationID, a.DOLocationID, abs(a.fare_amount - b.fare_amount) AS fare_gap, "
            "date_diff('second', b.tpep_pickup_datetime, least(a.tpep_dropoff_datetime, "
            "b.tpep_dropoff_datetime)) / 6e1 AS minutes FROM numbered a JOIN numbered b "
            "ON a.PULocationID = b.PULocationID AND a.DOLocationID = b.DOLocationID "
            "AND b.tpep_pickup_datetime < a.tpep_dropoff_datetime AND "
            "(a.tpep_pickup_datetime, a.tpep_dropoff_datetime, a.fare_amount, a.id) < "
            "(b.tpep_pickup_datetime, b.tpep_dropoff_datetime, b.fare_amount, b.id)) "
            f"SELECT PULocationID, DOLocationID, count(*) AS n_pairs, {r('avg(minutes)')} AS avg_overlap, "
            f"{r('max(minutes)')} AS max_overlap, {r('avg(fare_gap)')} AS avg_fare_gap FROM pairs GROUP BY ALL"
        ),
        "under_way_by_zone": f"{trips}{STEPS} SELECT * FROM by_zone",
        "under_way_zone_peaks": (
            f"{trips}{STEPS} SELECT PULocationID, max(under_way) AS most, {FIRST_AT} FROM by_zone GROUP BY ALL"
        ),
        "under_way_peak": f"{trips}{STEPS} SELECT max(under_way) AS most, {FIRST_AT} FROM overall",
        "sketched_weeks": (
            f"{trips} SELECT CAST(week(trip_date) AS INTEGER) AS week, count(*) AS n, count(*) AS n_trips, "
            "count(DISTINCT floor(fare_amount * 100)) AS exact_distinct, TRUE AS distinct_within, "
            "TRUE AS median_within FROM trips GROUP BY week"
        ),
        "fare_quantiles_by_zone": (
            f"{trips} SELECT PULocationID, count(*) AS n, {r('quantile_cont(fare_amount, 0.25)')} AS q25, "
            f"{r('quantile_cont(fare_amount, 0.5)')} AS q50, {r('quantile_cont(fare_amount, 0.9)')} AS q90 "
            "FROM trips GROUP BY ALL"
        ),
        "robust_fares_by_zone": (
            f"{trips}, figures AS (SELECT PULocationID AS zone, median(fare_amount) AS m, mad(fare_amount) AS d "
            f"FROM trips GROUP BY ALL) SELECT PULocationID, count(*) AS n, {r('any_value(m)')} AS median, "
            f"{r('any_value(d)')} AS mad, count(*) FILTER (WHERE d > 0 AND abs(6745e-4 * (fare_amount - m) / d) > 3.5e0) "
            "AS n_outliers FROM trips JOIN figures ON PULocationID IS NOT DISTINCT FROM zone GROUP BY PULocationID"
        ),
        "zone_longest_rises": (
            f"{trips}{DAYS.format(keys='PULocationID')}, marked AS (SELECT *, CASE WHEN "
            "trip_date - lag(trip_date) OVER w = 1 AND n > lag(n) OVER w THEN 0 ELSE 1 END AS broken "
            "FROM days WINDOW w AS (PARTITION BY PULocationID ORDER BY trip_date)), numbered AS ("
            "SELECT *, sum(broken) OVER (PARTITION BY PULocationID ORDER BY trip_date) AS run FROM marked) "
            "SELECT PULocationID, min(trip_date) AS first_day, max(trip_date) AS last_day, count(*) AS n_days, "
            "min(n) AS n_first, max(n) AS n_last FROM numbered GROUP BY PULocationID, run "
            "QUALIFY row_number() OVER (PARTITION BY PULocationID ORDER BY count(*) DESC, min(trip_date)) = 1"
        ),
        "route_gaps": (
            f"{trips}{DAYS.format(keys='PULocationID, DOLocationID')}, followed AS (SELECT *, lead(trip_date) OVER ("
            "PARTITION BY PULocationID, DOLocationID ORDER BY trip_date) AS next FROM days) "
            "SELECT PULocationID, DOLocationID, CAST(trip_date + 1 AS DATE) AS first_day, "
            "CAST(next - 1 AS DATE) AS last_day, CAST(next - trip_date - 1 AS BIGINT) AS n_days "
            "FROM followed WHERE next - trip_date > 1"
        ),
        "snapshot_changes": f"{trips}{SNAPSHOTS} SELECT * FROM changes",
        "snapshot_summary": (
            f"{trips}{SNAPSHOTS} SELECT count(*) AS n_keys, count(*) FILTER (WHERE added + removed + changed > 0) "
            f"AS n_keys_differing, {sums} FROM changes"
        ),
        "scaled_features": f"{trips} SELECT {scaled} FROM trips",
        "props_fields": (
            f"{TEXTS}SELECT event_id, props, CASE WHEN json_valid(props) THEN CAST(props ->> '$.k' AS INTEGER) END AS k, "
            "CASE WHEN json_valid(props) THEN props ->> '$.other' END AS other FROM texts"
        ),
        "props_report": (
            f"{TEXTS}SELECT count(*) AS n_rows, count(*) FILTER (WHERE props IS NULL) AS n_null, "
            "count(*) FILTER (WHERE NOT json_valid(props)) AS n_broken, 'OBJECT<k: BIGINT>' AS found_schema FROM texts"
        ),
    }
