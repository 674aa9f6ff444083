"""The registered queries once more, as SQL for DuckDB over the same tables.

Written by hand from the meaning of each query and sharing nothing with the Spark
code, so that a mistake in one does not hide in the other.
"""

from __future__ import annotations

import oracle_further


def r(value: str, digits: int = 6) -> str:
    """Settle a double at fixed digits, halves always upwards."""
    return f"floor(({value}) * 1e{digits} + 0.500001e0) / 1e{digits}"


def pct(part: str, whole: str) -> str:
    return r(f"CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) * 1e2")


N = "count(*) AS n"

TRIPS = """
WITH lines AS (
  SELECT *,
    CAST(CASE WHEN l_partkey % 37 = 0 THEN NULL ELSE l_linenumber % 2 + 1 END AS INTEGER) AS VendorID,
    TIMESTAMP '2024-01-01 00:00:00' + to_seconds(
      ((l_orderkey * 7919 + CAST(l_linenumber AS BIGINT) * 104729 + l_partkey * 31) % 2976) * 900
      + (l_orderkey * 13 + l_linenumber * 17) % 900) AS tpep_pickup_datetime,
    CAST(CASE WHEN l_partkey % 21 = 0 THEN NULL
         ELSE (l_partkey + l_linenumber) % 8 END AS BIGINT) AS passenger_count,
    CASE WHEN l_partkey % 103 = 0 THEN 10e0 ELSE 1e0 END
      * (l_quantity * l_quantity / 5e1 - 2e-2) AS trip_distance,
    CAST(CASE WHEN l_partkey % 29 = 0 THEN NULL ELSE l_partkey % 6 + 1 END AS BIGINT) AS RatecodeID,
    CASE WHEN l_partkey % 33 = 0 THEN '' WHEN l_partkey % 34 = 0 THEN NULL
         WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CAST(CASE WHEN (l_partkey * 7 + l_orderkey) % 23 < 13 THEN 1
              WHEN (l_partkey * 7 + l_orderkey) % 23 < 17 THEN 2
              ELSE ((l_partkey * 7 + l_orderkey) % 23 - 14) % 6 END AS BIGINT) AS payment_type,
    l_extendedprice / 1e3 * CASE WHEN l_partkey % 101 = 0 THEN 6e0
                                 WHEN l_partkey % 89 = 0 THEN -1e0 ELSE 1e0 END AS fare_amount,
    CASE WHEN l_linestatus = 'O' THEN 1e0 ELSE 0e0 END AS extra,
    CAST(CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE 2.5e0 END AS DOUBLE) AS congestion_surcharge,
    CAST(CASE WHEN l_partkey % 28 = 0 THEN NULL ELSE 0e0 END AS DOUBLE) AS Airport_fee
  FROM lineitem
), priced AS (
  SELECT *,
    tpep_pickup_datetime + to_seconds(
      CAST(floor(trip_distance * 150) AS BIGINT) + (l_partkey * 31 + l_suppkey * 17) % 900 - 60
      + CASE WHEN l_partkey % 97 = 0 THEN 20000 ELSE 0 END) AS tpep_dropoff_datetime,
    CASE WHEN payment_type = 1 THEN fare_amount * l_discount * 3e0 ELSE 0e0 END AS tip_amount
  FROM lines
), raw AS (
  SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count,
    trip_distance, RatecodeID, store_and_fwd_flag,
    CAST(CASE WHEN l_partkey % 43 = 0 THEN NULL WHEN l_partkey % 40 = 0 THEN 99 ELSE least(c_nationkey, 12) END AS INTEGER) AS PULocationID,
    CAST(CASE WHEN l_partkey % 47 = 0 THEN NULL WHEN l_partkey % 41 = 0 THEN 99 ELSE least(s_nationkey, 12) END AS INTEGER) AS DOLocationID,
    payment_type, fare_amount, extra, fare_amount * l_tax AS mta_tax, tip_amount,
    0e0 AS tolls_amount, 1e0 AS improvement_surcharge,
    fare_amount * (1e0 + l_tax) + 2.5e0 + tip_amount AS total_amount,
    congestion_surcharge, Airport_fee
  FROM priced
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
), measured AS (
  SELECT *,
    date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) / 6e1 AS trip_duration_minutes,
    trip_distance * 1.60934e0 AS trip_distance_km,
    CAST(hour(tpep_pickup_datetime) AS INTEGER) AS hour,
    CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS day_of_week,
    dayname(tpep_pickup_datetime) AS day_name,
    CAST(tpep_pickup_datetime AS DATE) AS trip_date,
    CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * 1e2 ELSE 0e0 END AS tip_percentage,
    CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge'
      WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' ELSE 'Voided' END AS payment_type_label
  FROM raw
), enriched AS (
  SELECT *,
    CASE WHEN trip_duration_minutes > 0 THEN trip_distance_km / trip_duration_minutes * 6e1
         ELSE 0e0 END AS average_speed_kmh,
    CASE WHEN hour BETWEEN 6 AND 11 THEN 'Morning (6h-11h)'
         WHEN hour BETWEEN 12 AND 17 THEN 'Afternoon (12h-17h)'
         WHEN hour BETWEEN 18 AND 22 THEN 'Evening (18h-22h)'
         ELSE 'Night (23h-5h)' END AS time_period,
    CASE WHEN trip_distance_km < 3 THEN 'Very short (< 3 km)'
         WHEN trip_distance_km < 10 THEN 'Short (3-10 km)'
         WHEN trip_distance_km < 20 THEN 'Medium (10-20 km)'
         WHEN trip_distance_km < 50 THEN 'Long (20-50 km)'
         ELSE 'Very long (> 50 km)' END AS trip_category,
    coalesce(trip_distance_km < 10, FALSE) AS is_short_trip,
    day_of_week IN (1, 7) AS is_weekend
  FROM measured
), valid AS (
  SELECT * FROM enriched
  WHERE trip_distance > 0 AND trip_distance < 200 AND fare_amount > 0 AND fare_amount < 500
    AND total_amount > 0 AND total_amount < 600 AND passenger_count > 0 AND passenger_count <= 6
    AND tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime > tpep_pickup_datetime
), trips AS (
  SELECT * FROM valid
  WHERE average_speed_kmh >= 0 AND average_speed_kmh <= 200
    AND trip_duration_minutes > 0 AND trip_duration_minutes < 300
), zones AS (
  SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone, 'Test zone' AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
), located AS (
  SELECT t.*, p.Borough AS pickup_borough, p.Zone AS pickup_zone,
    d.Borough AS dropoff_borough, d.Zone AS dropoff_zone
  FROM trips t LEFT JOIN zones p ON t.PULocationID = p.LocationID
  LEFT JOIN zones d ON t.DOLocationID = d.LocationID
)"""

SHARING = """, candidates AS (
  SELECT tpep_pickup_datetime, PULocationID, DOLocationID, trip_distance_km, fare_amount,
    trip_duration_minutes, passenger_count
  FROM trips
  WHERE is_short_trip AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL
), bucketed AS (
  SELECT *, CAST(floor(epoch(tpep_pickup_datetime) / 300) AS BIGINT) AS time_window,
    time_bucket(INTERVAL 5 MINUTE, tpep_pickup_datetime) AS window_start
  FROM candidates
), groups AS (
  SELECT time_window, PULocationID, DOLocationID, count(*) AS n_trips,
    avg(trip_distance_km) AS avg_km, avg(fare_amount) AS avg_fare,
    avg(trip_duration_minutes) AS avg_minutes,
    CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
    min(tpep_pickup_datetime) AS first_pickup, max(tpep_pickup_datetime) AS last_pickup,
    date_diff('second', min(tpep_pickup_datetime), max(tpep_pickup_datetime)) / 6e1 AS spread_minutes
  FROM bucketed GROUP BY ALL HAVING count(*) >= 2
), savings AS (
  SELECT *, individual_trips - shared_trips AS saved_trips,
    current_cost - shared_cost AS money_saved,
    (current_cost - shared_cost) / current_cost * 1e2 AS money_saved_pct,
    (individual_trips - shared_trips) * avg_minutes AS minutes_saved
  FROM (SELECT *, n_trips AS individual_trips, n_trips * avg_fare AS current_cost,
          CAST((n_trips + 1) // 2 AS INTEGER) AS shared_trips,
          ((n_trips + 1) // 2) * avg_fare * 1.1e0 AS shared_cost
        FROM groups)
)"""

ANOMALIES = """, base AS (
  SELECT avg(trip_distance_km) AS mean_dist, stddev_samp(trip_distance_km) AS std_dist,
    avg(fare_amount) AS mean_fare, stddev_samp(fare_amount) AS std_fare,
    avg(average_speed_kmh) AS mean_speed, stddev_samp(average_speed_kmh) AS std_speed
  FROM trips
), scored AS (
  SELECT *, z_dist > 3 OR z_fare > 3 OR z_speed > 3 AS is_anomaly
  FROM (SELECT trips.*, abs((trip_distance_km - mean_dist) / std_dist) AS z_dist,
          abs((fare_amount - mean_fare) / std_fare) AS z_fare,
          abs((average_speed_kmh - mean_speed) / std_speed) AS z_speed
        FROM trips, base)
)"""

RAW_COLUMNS = (
    "VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, "
    "RatecodeID, store_and_fwd_flag, PULocationID, DOLocationID, payment_type, fare_amount, "
    "extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount, "
    "congestion_surcharge, Airport_fee"
)

MEASURES = {
    "avg_fare": "avg(fare_amount)",
    "avg_total": "avg(total_amount)",
    "avg_tip": "avg(tip_amount)",
    "avg_tip_pct": "avg(tip_percentage)",
    "avg_km": "avg(trip_distance_km)",
    "avg_minutes": "avg(trip_duration_minutes)",
    "avg_speed": "avg(average_speed_kmh)",
    "avg_passengers": "avg(passenger_count)",
}


def means(names: str) -> str:
    return "".join(f", {r(MEASURES[n])} AS {n}" for n in names.split())


def by(keys: str, measured: str = "", source: str = "trips", share: str = "") -> str:
    """Counts and means per key; ``share`` names the table the percentage refers to."""
    portion = f", {pct('count(*)', f'(SELECT count(*) FROM {share})')} AS pct" if share else ""
    return f"SELECT {keys}, {N}{means(measured)}{portion} FROM {source} GROUP BY {keys}"


def described(source: str, columns: str) -> str:
    """Five statistics of each column, one row per column."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column, count({c}) AS count, {r(f'avg(CAST({c} AS DOUBLE))')} AS mean, "
        f"{r(f'stddev_samp(CAST({c} AS DOUBLE))')} AS stddev, "
        f"{r(f'CAST(min({c}) AS DOUBLE)')} AS min, {r(f'CAST(max({c}) AS DOUBLE)')} AS max "
        f"FROM {source}"
        for c in columns.split()
    )


def code_share(code: str, label: str = "") -> str:
    return (
        f"SELECT {code}, {N}, {pct('count(*)', '(SELECT count(*) FROM raw)')} AS pct{label} "
        f"FROM raw GROUP BY {code}"
    )


def top_zones(end: str, n: int, measured: str = "", where: str = "TRUE") -> str:
    return (
        f"SELECT {end}_borough, {end}_zone, {N}{means(measured)} FROM located "
        f"WHERE {end}_zone IS NOT NULL AND {where} GROUP BY ALL "
        f"ORDER BY n DESC, {end}_borough, {end}_zone LIMIT {n}"
    )


def borough(end: str) -> str:
    share = pct("count(*)", "(SELECT count(*) FROM trips)")
    return (
        f"SELECT {end}_borough, {N}, {r('avg(fare_amount)')} AS avg_fare, {share} AS pct "
        f"FROM located WHERE {end}_borough IS NOT NULL GROUP BY ALL"
    )


def bands(value: str, edges: list[int], unit: str) -> str:
    """Band label and its position as two CASE columns."""
    first = f"WHEN {value} < {edges[0]} THEN '< {edges[0]}{unit}'"
    inner = [
        f"WHEN {value} < {hi} THEN '{lo}-{hi}{unit}'" for lo, hi in zip(edges, edges[1:])
    ]
    label = f"CASE {first} {' '.join(inner)} ELSE '> {edges[-1]}{unit}' END"
    order = " + ".join(f"CASE WHEN {value} < {e} THEN 0 ELSE 1 END" for e in edges)
    return f"{label} AS band, CAST({order} AS INTEGER) AS band_order"


def missing() -> str:
    columns = RAW_COLUMNS.split(", ")
    parts = []
    for c in columns:
        null = f"{c} IS NULL OR {c} = ''" if c == "store_and_fwd_flag" else f"{c} IS NULL"
        count = f"count(*) FILTER (WHERE {null})"
        parts.append(
            f"SELECT '{c}' AS column, {count} AS nulls, {pct(count, 'count(*)')} AS pct FROM raw"
        )
    return " UNION ALL ".join(parts)


def schema() -> str:
    types = ("int timestamp_ntz timestamp_ntz bigint double bigint string int int bigint "
             "double double double double double double double double double").split()
    return " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column, '{t}' AS type, count({c}) AS n_values FROM raw"
        for i, (c, t) in enumerate(zip(RAW_COLUMNS.split(", "), types), 1)
    )


OUTLIERS = {
    "zero_distance_trips": "trip_distance <= 0",
    "negative_fare_trips": "fare_amount < 0",
    "zero_passenger_trips": "passenger_count <= 0",
    "negative_total_trips": "total_amount < 0",
}


def outliers() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {rule}) AS n, "
        f"{pct(f'count(*) FILTER (WHERE {rule})', 'count(*)')} AS pct FROM raw"
        for name, rule in OUTLIERS.items()
    )


def summary() -> str:
    shown = ["zero_distance_trips", "negative_fare_trips", "zero_passenger_trips"]
    parts = ["SELECT 'total_trips' AS metric, CAST(count(*) AS VARCHAR) AS value FROM raw"]
    parts += [
        f"SELECT '{m}', CAST(count(*) FILTER (WHERE {OUTLIERS[m]}) AS VARCHAR) FROM raw"
        for m in shown
    ]
    return " UNION ALL ".join(parts)


def sampled(fraction: float) -> str:
    """Rows with a small key hash."""
    keys = ", ".join(
        f"coalesce(CAST({k} AS VARCHAR), '')"
        for k in (
            "CAST(epoch(tpep_pickup_datetime) AS BIGINT)",
            "CAST(epoch(tpep_dropoff_datetime) AS BIGINT)",
            "PULocationID",
            "DOLocationID",
            "passenger_count",
            "payment_type",
        )
    )
    bound = f"{int(fraction * 16**8):08x}"
    return f"(SELECT * FROM trips WHERE substr(md5(concat_ws('|', {keys})), 1, 8) < '{bound}')"


GROUP_COLUMNS = (
    f"time_window, PULocationID, DOLocationID, n_trips, {r('avg_km')} AS avg_km, "
    f"{r('avg_fare')} AS avg_fare, {r('avg_minutes')} AS avg_minutes, total_passengers, "
    f"first_pickup, last_pickup, {r('spread_minutes')} AS spread_minutes"
)
SAVING_COLUMNS = (
    f"{GROUP_COLUMNS}, individual_trips, shared_trips, {r('current_cost')} AS current_cost, "
    f"saved_trips, {r('shared_cost')} AS shared_cost, {r('money_saved')} AS money_saved, "
    f"{r('money_saved_pct')} AS money_saved_pct, {r('minutes_saved')} AS minutes_saved"
)
SAVED = "CAST(sum(saved_trips) AS BIGINT)"
def shared_by(name: str, value: str, average: str = "") -> str:
    """Groups formed with the hour or day as a further key, then counted by it."""
    return (
        f"SELECT {name}, count(*) AS n_groups, CAST(sum(n) AS BIGINT) AS n_trips{average} FROM ("
        f"SELECT CAST({value} AS INTEGER) AS {name}, {N} FROM bucketed "
        "GROUP BY 1, time_window, PULocationID, DOLocationID HAVING count(*) >= 2) GROUP BY 1"
    )


BY_HOUR = shared_by("hour", "hour(tpep_pickup_datetime)", f", {r('avg(n)')} AS avg_trips")
BY_DAY = shared_by("day_of_week", "dayofweek(tpep_pickup_datetime) + 1")
HOURLY = by("hour", "avg_fare avg_speed")
DATE_RANGE = "trip_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'"
PAYMENT = by("payment_type, payment_type_label", "avg_total avg_tip", share="trips")
TOP15 = top_zones("pickup", 15, "avg_fare avg_km")

PROFILE = (
    "CASE WHEN trip_distance_km < 5 AND trip_duration_minutes < 15 THEN 'Short and fast' "
    "WHEN trip_distance_km < 5 THEN 'Short but slow' "
    "WHEN trip_distance_km >= 5 AND average_speed_kmh > 30 THEN 'Long and fluid' "
    "WHEN trip_distance_km >= 5 THEN 'Long and congested' ELSE 'Other' END AS trip_profile"
)
REVENUE = (
    "CASE WHEN fare_amount < 10 THEN 'Low revenue' WHEN fare_amount < 25 THEN 'Medium revenue' "
    "WHEN fare_amount < 50 THEN 'Good revenue' ELSE 'Excellent revenue' END AS revenue_category"
)
TIP = (
    "CASE WHEN tip_percentage < 10 THEN 'Low tip' WHEN tip_percentage < 20 THEN 'Standard tip' "
    "ELSE 'Generous tip' END AS tip_category"
)
EFFICIENT = (
    "(SELECT *, fare_amount / trip_distance_km AS revenue_per_km, "
    "fare_amount / trip_duration_minutes AS revenue_per_minute, "
    "fare_amount / (trip_distance_km + trip_duration_minutes / 1e1) AS efficiency_score FROM trips)"
)
FEATURES = (
    "trip_distance_km fare_amount tip_amount trip_duration_minutes average_speed_kmh passenger_count"
)


def correlations() -> str:
    known = " AND ".join(f"{f} IS NOT NULL" for f in FEATURES.split())
    return " UNION ALL ".join(
        f"SELECT '{a}' AS var_a, '{b}' AS var_b, "
        + ("1e0" if a == b else r(f"corr({a}, {b})"))
        + f" AS r FROM trips WHERE {known}"
        + (" GROUP BY ()" if a == b else "")
        for a in FEATURES.split()
        for b in FEATURES.split()
    )


def scenario(k: int) -> str:
    saved = f"(n_trips - (n_trips + {k - 1}) // {k})"
    return (
        f"SELECT CAST(sum({saved}) AS BIGINT) AS saved_trips, "
        f"{r(f'sum({saved} * avg_fare)', 2)} AS money_saved, "
        f"{r(f'avg({saved})')} AS avg_saved_trips, '{k} passengers/taxi' AS scenario FROM groups"
    )


def pivot() -> str:
    labels = ["Credit card", "Cash", "No charge", "Dispute", "Unknown", "Voided"]
    return (
        "SELECT trip_date, "
        + ", ".join(
            f"count(*) FILTER (WHERE payment_type_label = '{p}') AS \"{p}\"" for p in labels
        )
        + " FROM trips GROUP BY trip_date"
    )


def labelled_rates() -> str:
    names = ["Standard rate", "JFK", "Newark", "Nassau or Westchester", "Negotiated fare", "Group ride"]
    whens = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names, 1))
    return code_share("RatecodeID", f", CASE RatecodeID {whens} END AS rate_label")


def labelled_payments() -> str:
    names = ["Credit card", "Cash", "No charge", "Dispute", "Unknown", "Voided"]
    whens = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names, 1))
    return code_share("payment_type", f", CASE payment_type {whens} END AS payment_label")


def export_counts() -> str:
    results = {
        "hourly_distribution": HOURLY,
        "top_pickup_zones": TOP15,
        "payment_distribution": PAYMENT,
        "payment_by_date": by("trip_date, payment_type_label"),
        "ridesharing_hourly": BY_HOUR,
        "savings_summary": "SELECT * FROM savings LIMIT 20",
        "sample_data": f"SELECT * FROM {sampled(0.001)}",
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS result, count(*) AS n_rows FROM ({q})" for name, q in results.items()
    )


CATEGORIES = [
    "Very short (< 3 km)",
    "Short (3-10 km)",
    "Medium (10-20 km)",
    "Long (20-50 km)",
    "Very long (> 50 km)",
]
CATEGORY_ORDERED = (
    "SELECT band_order, trip_category, coalesce(n, 0) AS n, avg_fare, avg_km FROM (VALUES "
    + ", ".join(f"(CAST({i} AS INTEGER), '{c}')" for i, c in enumerate(CATEGORIES))
    + ") b(band_order, trip_category) LEFT JOIN ("
    + f"SELECT trip_category, count(VendorID) AS n{means('avg_fare avg_km')} "
    + "FROM trips GROUP BY trip_category"
    + ") USING (trip_category)"
)

TRIP_TOP = "tpep_pickup_datetime, trip_distance_km, fare_amount, average_speed_kmh, trip_duration_minutes"

PLAIN = {
    # sources, samples, round trips
    "scan_trips": "SELECT * FROM raw",
    "scan_zones": "SELECT * FROM zones",
    "cleaned_roundtrip": "SELECT * FROM trips",
    "sample_trips": f"SELECT * FROM {sampled(0.05)}",
    "sample_export_cols": (
        "SELECT trip_distance_km, trip_duration_minutes, average_speed_kmh, hour, day_name, "
        f"fare_amount, tip_percentage, payment_type_label, trip_category, time_period FROM {sampled(0.01)}"
    ),
    "export_sample_data": (
        "SELECT "
        + ", ".join(
            f"{r(c)} AS {c}"
            for c in (
                "trip_distance_km trip_duration_minutes average_speed_kmh fare_amount "
                "tip_percentage"
            ).split()
        )
        + ", hour, day_name, payment_type_label, trip_category, time_period "
        f"FROM {sampled(0.01)}"
    ),
    "preview_raw": f"SELECT {RAW_COLUMNS} FROM raw ORDER BY ALL NULLS FIRST LIMIT 10",
    "preview_zones": "SELECT * FROM zones ORDER BY ALL LIMIT 10",
    "preview_enriched": (
        "SELECT tpep_pickup_datetime, trip_distance_km, trip_duration_minutes, average_speed_kmh, "
        "hour, day_name, time_period, trip_category, fare_amount, tip_percentage FROM trips "
        "ORDER BY ALL LIMIT 10"
    ),
    "sink_csv_roundtrip": HOURLY,
    "export_hourly": HOURLY,
    "export_payment": PAYMENT,
    # profile
    "profile_row_count": f"SELECT {N} FROM raw",
    "profile_schema": schema(),
    "profile_period": (
        "SELECT min(tpep_pickup_datetime) AS first_pickup, max(tpep_pickup_datetime) AS last_pickup, "
        "CAST(date_diff('day', CAST(min(tpep_pickup_datetime) AS DATE), "
        "CAST(max(tpep_pickup_datetime) AS DATE)) AS INTEGER) AS days FROM raw"
    ),
    "profile_missing": missing(),
    "profile_outliers": outliers(),
    "profile_describe_raw": described("raw", "trip_distance fare_amount total_amount passenger_count"),
    "profile_payment_type": code_share("payment_type"),
    "profile_payment_labeled": labelled_payments(),
    "profile_ratecode": code_share("RatecodeID"),
    "profile_ratecode_labeled": labelled_rates(),
    "profile_summary": summary(),
    # cleaning and enrichment
    "clean_trips": f"SELECT {RAW_COLUMNS} FROM valid",
    "clean_report": (
        "SELECT n_raw, n_valid, n_final, n_raw - n_valid AS n_removed, "
        f"{pct('n_raw - n_valid', 'n_raw')} AS pct_removed FROM (SELECT "
        "(SELECT count(*) FROM raw) AS n_raw, (SELECT count(*) FROM valid) AS n_valid, "
        "(SELECT count(*) FROM trips) AS n_final)"
    ),
    "enrich_trips": "SELECT * FROM valid",
    "plausible_trips": "SELECT * FROM trips",
    "describe_distance": described("trips", "trip_distance_km"),
    "describe_duration": described("trips", "trip_duration_minutes"),
    "category_distribution": by("trip_category", share="trips"),
    "short_long_split": by("is_short_trip", share="trips"),
    "speed_by_hour": by("hour", "avg_speed"),
    "speed_by_day": by("day_name, day_of_week", "avg_speed"),
    "speed_by_period": by("time_period", "avg_speed"),
    "speed_by_weekend": by("is_weekend", "avg_speed"),
    "fare_by_category": by("trip_category", "avg_fare avg_total avg_tip_pct"),
    # zones and time
    "join_pickup_zone": (
        "SELECT * EXCLUDE (dropoff_borough, dropoff_zone) FROM located"
    ),
    "join_both_zones": "SELECT * FROM located",
    "zone_match_rate": (
        "SELECT n_trips, n_matched, " + pct("n_matched", "n_trips") + " AS pct_matched FROM ("
        "SELECT count(*) AS n_trips, count(*) FILTER (WHERE pickup_zone IS NOT NULL "
        "AND dropoff_zone IS NOT NULL) AS n_matched FROM located)"
    ),
    "top_pickup_zones": top_zones("pickup", 20, "avg_fare avg_km"),
    "top_dropoff_zones": top_zones("dropoff", 20, "avg_fare avg_km"),
    "pickup_borough_stats": borough("pickup"),
    "dropoff_borough_stats": borough("dropoff"),
    "hourly_distribution": HOURLY,
    "peak_hours": f"{HOURLY} ORDER BY n DESC, hour LIMIT 5",
    "daily_distribution": by("day_name, day_of_week", "avg_fare avg_km"),
    "period_distribution": by("time_period", "avg_fare avg_speed", share="trips"),
    "short_top_pickup": top_zones("pickup", 3, where="is_short_trip"),
    "short_top_dropoff": top_zones("dropoff", 3, where="is_short_trip"),
    "long_top_pickup": top_zones("pickup", 3, where="NOT is_short_trip"),
    "long_top_dropoff": top_zones("dropoff", 3, where="NOT is_short_trip"),
    "borough_flows": (
        f"SELECT pickup_borough, dropoff_borough, {N}{means('avg_fare avg_minutes')} FROM located "
        "WHERE pickup_borough IS NOT NULL AND dropoff_borough IS NOT NULL GROUP BY ALL "
        "ORDER BY n DESC, pickup_borough, dropoff_borough LIMIT 10"
    ),
    "day_hour_heatmap": by("day_name, day_of_week, hour"),
    # payments
    "payment_distribution": PAYMENT,
    "payment_short": by(
        "payment_type_label", "avg_total avg_tip_pct",
        "(SELECT * FROM trips WHERE is_short_trip)", "trips WHERE is_short_trip",
    ),
    "payment_long": by(
        "payment_type_label", "avg_total avg_tip_pct",
        "(SELECT * FROM trips WHERE NOT is_short_trip)", "trips WHERE NOT is_short_trip",
    ),
    "payment_by_date": by("trip_date, payment_type_label"),
    "payment_by_week": by(
        "week, payment_type_label", "avg_total",
        "(SELECT *, CAST(weekofyear(trip_date) AS INTEGER) AS week FROM trips)",
    ),
    "payment_by_day": by("day_name, day_of_week, payment_type_label", "avg_total"),
    "payment_by_hour": by(
        "hour, payment_type_label", source="(SELECT * FROM trips WHERE payment_type IN (1, 2))"
    ),
    "amount_stats": (
        f"SELECT payment_type_label, {N}, {r('min(total_amount)')} AS min_total, "
        f"{r('avg(total_amount)')} AS avg_total, {r('max(total_amount)')} AS max_total, "
        f"{r('stddev_samp(total_amount)')} AS std_total FROM trips GROUP BY ALL"
    ),
    "amount_bands": (
        f"SELECT band AS amount_band, band_order, payment_type_label, {N} FROM (SELECT *, "
        + bands("total_amount", [10, 20, 30, 50, 100], "$")
        + " FROM trips) GROUP BY ALL"
    ),
    "tip_stats": (
        f"SELECT payment_type_label, {N}{means('avg_tip avg_tip_pct')}, "
        "count(*) FILTER (WHERE tip_amount > 0) AS n_tipped, "
        f"{pct('count(*) FILTER (WHERE tip_amount > 0)', 'count(*)')} AS pct_tipped "
        "FROM trips WHERE payment_type IN (1, 2) GROUP BY ALL"
    ),
    "tip_bands": (
        f"SELECT band AS tip_band, band_order, {N}{means('avg_tip avg_tip_pct')} FROM (SELECT *, "
        + bands("tip_percentage", [10, 15, 20, 25], "%")
        + " FROM trips WHERE payment_type = 1 AND tip_amount > 0) GROUP BY ALL"
    ),
    "payment_weekend": by("is_weekend, payment_type_label", "avg_total avg_tip_pct"),
    "payment_period": by("time_period, payment_type_label", "avg_total"),
    "tip_by_fare_band": (
        f"SELECT band AS fare_band, band_order, {N}{means('avg_tip avg_tip_pct avg_fare')} "
        "FROM (SELECT *, "
        + bands("fare_amount", [10, 20, 30, 50], "$")
        + " FROM trips WHERE payment_type = 1) GROUP BY ALL"
    ),
    # trends, segments, efficiency, correlation
    "hourly_trends": by("day_name, day_of_week, hour", "avg_fare avg_km avg_speed avg_tip_pct"),
    "daily_trends": (
        f"SELECT trip_date, {N}{means('avg_fare avg_passengers')}, "
        f"{r('sum(total_amount)', 2)} AS sum_total FROM trips GROUP BY ALL"
    ),
    "categorized_trips": f"SELECT *, {PROFILE}, {REVENUE}, {TIP} FROM trips",
    "profile_distribution": by("trip_profile", "avg_fare avg_km", f"(SELECT *, {PROFILE} FROM trips)"),
    "revenue_distribution": (
        f"SELECT revenue_category, {N}, {r('sum(fare_amount)', 2)} AS sum_fare{means('avg_km')} "
        f"FROM (SELECT *, {REVENUE} FROM trips) GROUP BY ALL"
    ),
    "correlation_matrix": correlations(),
    "rush_vs_offpeak": (
        f"SELECT is_rush_hour, {N}{means('avg_fare avg_minutes avg_speed')}, "
        f"{r('sum(total_amount)', 2)} AS sum_total "
        "FROM (SELECT *, hour IN (7, 8, 9, 17, 18, 19) AS is_rush_hour FROM trips) GROUP BY ALL"
    ),
    "weekend_period": by("is_weekend, time_period", "avg_fare avg_speed avg_tip_pct"),
    "efficiency_trips": f"SELECT * FROM {EFFICIENT}",
    "efficiency_stats": described(EFFICIENT, "revenue_per_km revenue_per_minute efficiency_score"),
    "efficiency_top": (
        f"SELECT tpep_pickup_datetime, {r('trip_distance_km')} AS trip_distance_km, "
        f"{r('trip_duration_minutes')} AS trip_duration_minutes, {r('fare_amount')} AS fare_amount, "
        f"{r('revenue_per_km')} AS revenue_per_km, {r('revenue_per_minute')} AS revenue_per_minute, "
        f"{r('efficiency_score')} AS efficiency_score FROM (SELECT * FROM {EFFICIENT} "
        "ORDER BY efficiency_score DESC, tpep_pickup_datetime, trip_distance_km, "
        "trip_duration_minutes, fare_amount LIMIT 10)"
    ),
    # chart data
    "export_top15_zones": TOP15,
    "export_top_pickup_zones": TOP15,
    "export_payment_by_date": by("trip_date, payment_type_label"),
    "payment_by_date_range": by(
        "trip_date, payment_type_label", source=f"(SELECT * FROM trips WHERE {DATE_RANGE})"
    ),
    "top3_hours": f"{HOURLY} ORDER BY n DESC, hour LIMIT 3",
    "payment_pivot": pivot(),
    "hourly_peak_zone": (
        "SELECT hour, CAST(sum(stamped) AS BIGINT) AS n, "
        "coalesce(max(n) FILTER (WHERE PULocationID IS NOT NULL), 0) AS max_zone_n, "
        f"{r('sum(km) / sum(n)')} AS avg_km FROM (SELECT hour, PULocationID, {N}, "
        "count(VendorID) AS stamped, sum(trip_distance_km) AS km FROM trips GROUP BY ALL) "
        "GROUP BY hour"
    ),
    "sample_hourly": (
        f"SELECT hour, count(VendorID) AS n{means('avg_fare avg_speed')} "
        f"FROM {sampled(0.05)} GROUP BY hour"
    ),
    "sample_payment": (
        f"SELECT payment_type_label, count(VendorID) AS n{means('avg_total')} "
        f"FROM {sampled(0.05)} GROUP BY payment_type_label"
    ),
    "category_ordered": CATEGORY_ORDERED,
}

SHARED = {
    "share_candidates": "SELECT * FROM candidates",
    "share_candidate_rate": (
        "SELECT n_trips, n_candidates, " + pct("n_candidates", "n_trips") + " AS pct_candidates "
        "FROM (SELECT (SELECT count(*) FROM trips) AS n_trips, "
        "(SELECT count(*) FROM candidates) AS n_candidates)"
    ),
    "share_time_buckets": "SELECT * FROM bucketed",
    "share_groups": f"SELECT {GROUP_COLUMNS} FROM groups",
    "share_groups_7_minutes": (
        f"SELECT {GROUP_COLUMNS} FROM (SELECT CAST(floor(epoch(tpep_pickup_datetime) / 420) AS "
        "BIGINT) AS time_window, PULocationID, DOLocationID, count(*) AS n_trips, "
        "avg(trip_distance_km) AS avg_km, avg(fare_amount) AS avg_fare, "
        "avg(trip_duration_minutes) AS avg_minutes, "
        "CAST(sum(passenger_count) AS BIGINT) AS total_passengers, "
        "min(tpep_pickup_datetime) AS first_pickup, max(tpep_pickup_datetime) AS last_pickup, "
        "date_diff('second', min(tpep_pickup_datetime), max(tpep_pickup_datetime)) / 6e1 "
        "AS spread_minutes FROM candidates GROUP BY 1, 2, 3 HAVING count(*) >= 2)"
    ),
    "sink_parquet_roundtrip": f"SELECT {GROUP_COLUMNS} FROM groups",
    "share_group_stats": described("groups", "n_trips avg_km avg_fare avg_minutes spread_minutes"),
    "share_top_groups": (
        f"SELECT {GROUP_COLUMNS} FROM (SELECT * FROM groups "
        "ORDER BY n_trips DESC, time_window, PULocationID, DOLocationID LIMIT 20)"
    ),
    "share_top_origins": (
        "SELECT PULocationID, CAST(sum(n_trips) AS BIGINT) AS n_trips, count(*) AS n_groups, "
        f"{r('avg(n_trips)')} AS avg_trips FROM groups GROUP BY PULocationID "
        "ORDER BY n_trips DESC, PULocationID LIMIT 10"
    ),
    "share_savings": f"SELECT {SAVING_COLUMNS} FROM savings",
    "share_savings_total": (
        "SELECT count(*) AS n_groups, (SELECT count(*) FROM candidates) AS n_candidates, "
        f"{SAVED} AS saved_trips, {r('sum(money_saved)', 2)} AS money_saved, "
        f"{r('sum(minutes_saved)', 2)} AS minutes_saved, "
        f"{r('sum(minutes_saved) / 6e1', 2)} AS hours_saved, "
        f"{pct('sum(saved_trips)', '(SELECT count(*) FROM candidates)')} AS reduction_pct FROM savings"
    ),
    "share_top_savings": (
        "SELECT PULocationID, DOLocationID, n_trips, shared_trips, saved_trips, "
        f"{r('money_saved')} AS money_saved, {r('money_saved_pct')} AS money_saved_pct, "
        f"{r('minutes_saved')} AS minutes_saved FROM (SELECT * FROM savings ORDER BY "
        "money_saved DESC, PULocationID, DOLocationID, n_trips LIMIT 10)"
    ),
    "export_top20_savings": (
        f"SELECT {SAVING_COLUMNS} FROM (SELECT * FROM savings ORDER BY money_saved DESC, "
        "time_window, PULocationID, DOLocationID LIMIT 20)"
    ),
    "export_savings_summary": (
        f"SELECT {SAVING_COLUMNS} FROM (SELECT * FROM savings ORDER BY money_saved DESC, "
        "time_window, PULocationID, DOLocationID LIMIT 20)"
    ),
    "share_by_hour": BY_HOUR,
    "export_share_hourly": BY_HOUR,
    "share_by_day": BY_DAY,
    "share_scenarios": f"{scenario(2)} UNION ALL {scenario(3)}",
    "kpi_dashboard": (
        "SELECT (SELECT count(*) FROM trips) AS n_trips, count(*) AS n_share_groups, "
        f"{r('sum(money_saved)', 2)} AS money_saved, "
        f"{pct('sum(saved_trips)', '(SELECT count(*) FROM candidates)')} AS reduction_pct, "
        "(SELECT hour FROM trips GROUP BY hour ORDER BY count(*) DESC, hour LIMIT 1) AS peak_hour, "
        + r("(SELECT count(*) FILTER (WHERE payment_type = 1) / CAST(count(*) AS DOUBLE) * 1e2 FROM trips)")
        + " AS card_pct FROM savings"
    ),
    "export_results": export_counts(),
}

SCORED = {
    "anomaly_baseline": "SELECT "
    + ", ".join(
        f"{r(c)} AS {c}"
        for c in "mean_dist std_dist mean_fare std_fare mean_speed std_speed".split()
    )
    + " FROM base",
    "anomaly_scores": "SELECT * REPLACE ("
    + ", ".join(
        f"{r(c)} AS {c}"
        for c in (
            "trip_distance fare_amount extra mta_tax tip_amount tolls_amount improvement_surcharge "
            "total_amount congestion_surcharge Airport_fee trip_duration_minutes trip_distance_km "
            "average_speed_kmh tip_percentage z_dist z_fare z_speed"
        ).split()
    )
    + ") FROM scored",
    "anomaly_rate": (
        "SELECT count(*) AS n_trips, count(*) FILTER (WHERE is_anomaly) AS n_anomalies, "
        + pct("count(*) FILTER (WHERE is_anomaly)", "count(*)")
        + " AS pct_anomalies FROM scored"
    ),
    "anomaly_top": (
        "SELECT tpep_pickup_datetime, "
        + ", ".join(f"{r(c)} AS {c}" for c in TRIP_TOP.split(", ")[1:])
        + ", "
        + ", ".join(f"{r(c)} AS {c}" for c in "z_dist z_fare z_speed".split())
        + f" FROM (SELECT * FROM scored WHERE is_anomaly ORDER BY z_dist DESC, {TRIP_TOP} LIMIT 10)"
    ),
    "anomaly_types": (
        f"SELECT anomaly_type, {N}{means('avg_km avg_fare avg_speed')} FROM (SELECT *, "
        "CASE WHEN z_dist > 3 THEN 'Excessive distance' WHEN z_fare > 3 THEN 'Abnormal fare' "
        "WHEN z_speed > 3 THEN 'Abnormal speed' ELSE 'Other' END AS anomaly_type "
        "FROM scored WHERE is_anomaly) GROUP BY anomaly_type"
    ),
}

ORACLE: dict[str, str] = {
    name: f"{TRIPS}{extra}\n{body}"
    for extra, bodies in (("", PLAIN), (SHARING, SHARED), (ANOMALIES, SCORED))
    for name, body in bodies.items()
} | oracle_further.queries(TRIPS, SHARING, r, FEATURES.split())
