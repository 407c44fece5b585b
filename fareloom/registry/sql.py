"""SQL counterparts of the test-table mappings, as common table expressions."""

from __future__ import annotations

RAW = """
raw AS (
  SELECT l_orderkey, l_linenumber,
    CAST(l_linenumber % 2 + 1 AS BIGINT) AS VendorID,
    l_shipdate + to_minutes(CAST((l_orderkey * 37 + l_linenumber * 101) % 1440 AS INTEGER))
      AS tpep_pickup_datetime,
    l_shipdate + to_minutes(CAST((l_orderkey * 37 + l_linenumber * 101) % 1440
      + l_linenumber * 10 AS INTEGER)) AS tpep_dropoff_datetime,
    CASE WHEN l_linenumber <> 7 THEN CAST(l_linenumber AS DOUBLE) END AS passenger_count,
    (l_quantity - 3) / 4 AS trip_distance,
    CAST(l_linenumber % 6 + 1 AS DOUBLE) AS RatecodeID,
    CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    l_suppkey AS PULocationID,
    l_partkey % 265 AS DOLocationID,
    CAST(l_linenumber AS BIGINT) AS payment_type,
    CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 89 = 0 THEN 0.0::DOUBLE
         ELSE l_extendedprice / 180 - 20 END AS fare_amount,
    l_discount * 10 AS extra,
    0.5::DOUBLE AS mta_tax,
    l_extendedprice / 180 * l_discount AS tip_amount,
    l_tax * 50 AS tolls_amount,
    0.3::DOUBLE AS improvement_surcharge,
    l_extendedprice / 150 * (1 + l_tax) - 20 AS total_amount,
    CASE WHEN l_linenumber <= 3 THEN 2.5::DOUBLE ELSE 0.0::DOUBLE END AS congestion_surcharge,
    CAST(l_suppkey % 3 AS DOUBLE) AS airport_fee
  FROM lineitem
)"""

DISTANCE_BUCKET = (
    "CASE WHEN trip_distance < 1 THEN 'short' WHEN trip_distance <= 10 THEN 'medium' "
    "ELSE 'long' END"
)

DAY_PART = (
    "CASE WHEN hour(tpep_pickup_datetime) < 6 THEN 'overnight' "
    "WHEN hour(tpep_pickup_datetime) < 12 THEN 'morning' "
    "WHEN hour(tpep_pickup_datetime) < 18 THEN 'afternoon' "
    "WHEN hour(tpep_pickup_datetime) < 22 THEN 'evening' ELSE 'night' END"
)

CALENDAR = """
    CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
    CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
    CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS day_of_week"""

FLAGS = """
    CASE WHEN payment_type = 1 THEN 1 ELSE 0 END AS pay_credit_card,
    CASE WHEN payment_type = 2 THEN 1 ELSE 0 END AS pay_cash,
    CASE WHEN payment_type = 3 THEN 1 ELSE 0 END AS pay_no_charge"""

CLEAN = f"""{RAW},
capped AS (
  SELECT * REPLACE (
      coalesce(passenger_count, 1) AS passenger_count,
      least(fare_amount, 500.0::DOUBLE) AS fare_amount,
      least(total_amount, 600.0::DOUBLE) AS total_amount)
  FROM raw WHERE trip_distance > 0 AND fare_amount >= 0 AND total_amount >= 0
),
clean AS (
  SELECT *, {CALENDAR}, {FLAGS},
    {DISTANCE_BUCKET} AS distance_bucket,
    {DAY_PART} AS time_of_day,
    CAST(year(tpep_pickup_datetime) AS INTEGER) AS year,
    CAST(month(tpep_pickup_datetime) AS INTEGER) AS month
  FROM capped
)"""

NORMS = """
bounds AS (
  SELECT min(fare_amount) AS fare_low, max(fare_amount) - min(fare_amount) AS fare_spread,
         min(trip_distance) AS dist_low, max(trip_distance) - min(trip_distance) AS dist_spread
  FROM capped
),
scaled AS (
  SELECT clean.*,
    round((fare_amount - fare_low) / CASE WHEN fare_spread = 0 THEN 1 ELSE fare_spread END, 6)
      AS fare_norm,
    round((trip_distance - dist_low) / CASE WHEN dist_spread = 0 THEN 1 ELSE dist_spread END, 6)
      AS dist_norm
  FROM clean, bounds
)"""

WEATHER = """
weather AS (
  SELECT 'USW00094728' AS STATION, d AS DATE,
    CAST((day(d) * 7) % 5 * 10 - 10 AS INTEGER) AS PRCP,
    CASE WHEN month(d) IN (12, 1, 2) AND day(d) % 4 = 0 THEN 20 ELSE 0 END AS SNOW
  FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)
  WHERE day(d) <> 31
),
days AS (
  SELECT *, CASE WHEN SNOW > 0 THEN 'snow' WHEN PRCP > 0 THEN 'rain' ELSE 'clear' END
    AS weather_condition
  FROM weather
)"""

SUMMARY = """
summary AS (
  SELECT unnest(['94728', '14732']) AS STATION, d AS DATE,
    20.0::DOUBLE + (day(d) * 3 + month(d) * 5) % 70 AS TEMP,
    CASE day(d) % 5 WHEN 0 THEN 0.0::DOUBLE WHEN 1 THEN 0.05::DOUBLE WHEN 2 THEN 0.3::DOUBLE
      WHEN 3 THEN 0.8::DOUBLE ELSE 99.99::DOUBLE END AS PRCP,
    CASE WHEN day(d) % 7 = 0 THEN 999.9::DOUBLE ELSE day(d) / 2.0::DOUBLE END AS WDSP,
    CASE WHEN day(d) % 11 = 0 THEN 999.9::DOUBLE
      WHEN month(d) IN (12, 1, 2) AND day(d) % 4 = 0 THEN 3.0::DOUBLE
      ELSE 0.0::DOUBLE END AS SNDP
  FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)
),
measured AS (
  SELECT * REPLACE (CASE WHEN PRCP >= 99 THEN 0 ELSE PRCP END AS PRCP,
    CASE WHEN WDSP >= 999 THEN 0 ELSE WDSP END AS WDSP,
    CASE WHEN SNDP >= 999 THEN 0 ELSE SNDP END AS SNDP)
  FROM summary
),
banded AS (
  SELECT *,
    CASE WHEN TEMP < 32 THEN 'freezing' WHEN TEMP < 50 THEN 'cold' WHEN TEMP < 70 THEN 'mild'
      ELSE 'warm' END AS temp_bucket,
    CASE WHEN PRCP = 0 THEN 'dry' WHEN PRCP <= 0.1 THEN 'light_rain'
      WHEN PRCP <= 0.5 THEN 'moderate_rain' ELSE 'heavy_rain' END AS prcp_bucket
  FROM measured
)"""

JOINED = """
joined AS (
  SELECT * FROM clean JOIN banded ON pickup_date = DATE AND STATION = '94728'
)"""

ZONES = """
zones AS (
  SELECT s_suppkey AS LocationID, n_name AS Borough, s_name AS Zone
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
),
labels AS (
  SELECT Zone || ', ' || Borough AS label, CAST(LocationID AS INTEGER) AS LocationID FROM zones
)"""

REQUESTS = """
requests AS (
  SELECT event_id, user_id AS pu_location_id, event_id % 265 AS do_location_id,
    value / 20 AS trip_distance,
    CAST(hour(ts) AS INTEGER) AS pickup_hour,
    dayname(ts) AS day_name,
    CAST(event_id % 8 AS INTEGER) AS passenger_count,
    CASE WHEN event_type IN ('click', 'purchase') THEN 'Credit Card'
         WHEN event_type IN ('view', 'signup') THEN 'Cash' ELSE 'Other' END AS payment_method
  FROM events
),
screened AS (
  SELECT *, CASE
      WHEN NOT coalesce(trip_distance >= 0.1, FALSE) THEN 'distance'
      WHEN NOT coalesce(pickup_hour BETWEEN 0 AND 23, FALSE) THEN 'hour'
      WHEN NOT coalesce(passenger_count BETWEEN 1 AND 6, FALSE) THEN 'passengers'
      WHEN payment_method NOT IN ('Credit Card', 'Cash') THEN 'payment' END AS reject_reason
  FROM requests
)"""

HOURLY = """
hourly AS (
  SELECT pickup_hour, day_of_week, count(*) AS trip_count FROM clean GROUP BY ALL
)"""

REVENUE = """
revenue AS (
  SELECT PULocationID, round(sum(fare_amount), 2) AS total_revenue,
    round(avg(fare_amount), 2) AS avg_fare, count(*) AS trip_count
  FROM clean GROUP BY PULocationID
)"""

TIPPING = """
tipping AS (
  SELECT distance_bucket,
    round(avg(tip_amount / nullif(fare_amount, 0) * 100), 2) AS avg_tip_pct,
    round(avg(tip_amount), 2) AS avg_tip_amount, count(*) AS trip_count
  FROM clean GROUP BY distance_bucket
)"""

PRICE = """
price AS (
  SELECT distance_bucket,
    round(avg(fare_amount / trip_distance), 2) AS avg_fare_per_mile,
    round(avg(fare_amount), 2) AS avg_fare,
    round(avg(trip_distance), 2) AS avg_distance, count(*) AS trip_count
  FROM clean GROUP BY distance_bucket
)"""

BY_WEATHER = """
by_weather AS (
  SELECT weather_condition, count(*) AS trip_count,
    round(avg(fare_amount), 2) AS avg_fare, round(avg(trip_distance), 2) AS avg_distance
  FROM clean JOIN days ON pickup_date = DATE GROUP BY weather_condition
)"""

BUCKET = "(l_orderkey * 7919 + l_linenumber * 104729) % 100"

METRICS = f"""
predicted AS (
  SELECT total_amount AS y, 15 + 3 * trip_distance AS lr, fare_amount * 1.25 AS gbt,
    fare_amount + tip_amount AS rf
  FROM clean WHERE NOT ({BUCKET} < 80)
),
errors AS (
  SELECT avg((y - lr) * (y - lr)) AS lr, avg((y - gbt) * (y - gbt)) AS gbt,
    avg((y - rf) * (y - rf)) AS rf, var_pop(y) AS v
  FROM predicted
),
metrics AS (
  SELECT 0 AS position, 'lr' AS model, sqrt(lr) AS rmse, 1 - lr / v AS r2 FROM errors
  UNION ALL SELECT 1, 'gbt', sqrt(gbt), 1 - gbt / v FROM errors
  UNION ALL SELECT 2, 'rf', sqrt(rf), 1 - rf / v FROM errors
)"""


def ordered(table: str, *keys: str) -> str:
    """All of a table with each row's place in an order."""
    return f"SELECT *, row_number() OVER (ORDER BY {', '.join(keys)}) AS position FROM {table}"


def query(select: str, *tables: str) -> str:
    """A statement over the given common table expressions."""
    return f"WITH {', '.join(part.strip() for part in tables)} {select.strip()}"
