"""The same results in ANSI SQL over the source tables, for an independent engine.

Each statement starts from ``lineitem`` and repeats the derivation on integers;
nothing is shared with the Spark code but the fixed labels and centres.
"""

from __future__ import annotations

from farebox.functions import labels
from farebox.operators import silver as s
from farebox.plans import reports
from farebox.plans.catalog import EARLIER_FIT
from farebox.schema import FLEETS

# ----------------------------------------------------------------- building blocks


def _bands(col: str, bands, otherwise: str) -> str:
    cases = " ".join(f"WHEN {col} >= {lo} AND {col} <= {hi} THEN '{x}'" for lo, hi, x in bands)
    return f"(CASE {cases} ELSE '{otherwise}' END)"


def _above(col: str, limits, otherwise: str) -> str:
    cases = " ".join(f"WHEN {col} > {limit} THEN '{label}'" for limit, label in limits)
    return f"(CASE {cases} ELSE '{otherwise}' END)"


def _month(col: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(labels.MONTHS_PT, 1))
    return f"(CASE {col} {cases} END)"


def _area(col: str = "taxi_type") -> str:
    cases = " ".join(f"WHEN '{f.code}' THEN '{f.service_area}'" for f in FLEETS.values())
    return f"(CASE {col} {cases} ELSE 'Unknown' END)"


def _r(expr: str, digits: int) -> str:
    """Round half up on a decimal, as double."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(28,8)), {digits}) AS DOUBLE)"


def _mean(total: str, n: str, digits: int, scale: int = 0) -> str:
    whole = _r(f"CAST({total} AS DOUBLE) / CAST({n} AS DOUBLE)", digits - scale)
    return f"({whole} / CAST({10**scale} AS DOUBLE))"


def _pct(part: str, whole: str) -> str:
    return _r(f"CAST({part} AS DOUBLE) * 100.0::DOUBLE / NULLIF(CAST({whole} AS DOUBLE), 0)", 2)


PERIOD = _bands("pickup_hour", labels.PERIODS, labels.LATE)
PERIOD_PT = _bands("pickup_hour", labels.PERIODS_PT, labels.LATE_PT)
HOURS = (
    "(lpad(CAST(pickup_hour AS VARCHAR), 2, '0') || ':00 - ' || "
    "lpad(CAST(pickup_hour + 1 AS VARCHAR), 2, '0') || ':00')"
)

TRIPS = """
cents AS (
  SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS price_cents,
    CAST(CAST(l_tax AS DECIMAL(4,2)) * 100 AS BIGINT) AS tax_cents,
    CAST((l_orderkey * 37 + l_partkey * 11) % 1440 AS BIGINT) AS start_min,
    CAST((l_partkey * 7 + l_linenumber) % 1600 - 10 AS BIGINT) AS dur
  FROM lineitem
),
amounts AS (
  SELECT *, price_cents // 100 - 2000 AS total_cents,
    greatest(price_cents // 100 - 2000, 0) * tax_cents
      * (CASE WHEN l_linestatus = 'O' THEN 4 ELSE 3 END) // 100 AS tip_cents,
    CAST(l_linenumber % 3 * 100 AS BIGINT) AS tolls_cents
  FROM cents
),
trips AS (
  SELECT
    CASE WHEN l_linestatus = 'O' THEN 'yellow' ELSE 'green' END AS taxi_type,
    l_suppkey % 2 + 1 AS vendor_id,
    CAST(l_shipdate AS TIMESTAMP) + to_minutes(start_min) AS pickup_ts,
    CAST(l_shipdate AS TIMESTAMP) + to_minutes(start_min + dur) AS dropoff_ts,
    CAST(CAST(l_quantity AS INTEGER) % 8 AS BIGINT) AS pax,
    l_partkey % 300 AS dist_tenths,
    total_cents, tip_cents, tolls_cents, total_cents - tip_cents - tolls_cents AS fare_cents,
    dur,
    CAST(year(l_shipdate) AS INTEGER) AS source_year,
    CAST(month(l_shipdate) AS INTEGER) AS source_month,
    l_orderkey AS order_key,
    CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) || '|'
      || CAST(l_partkey AS VARCHAR) || '|' || CAST(l_suppkey AS VARCHAR) || '|'
      || CAST(price_cents AS VARCHAR) || '|' || strftime(l_shipdate, '%Y-%m-%d') AS record_key
  FROM amounts
),
keyed AS (
  SELECT *,
    CAST(hour(pickup_ts) AS INTEGER) AS pickup_hour,
    CAST(dayofweek(pickup_ts) + 1 AS INTEGER) AS pickup_dayofweek,
    CAST(pickup_ts AS DATE) AS pickup_date,
    CAST(vendor_id AS VARCHAR) || '_' || strftime(pickup_ts, '%Y%m%d%H%M%S') || '_'
      || md5(record_key) AS trip_id,
    taxi_type || '_tripdata_' || CAST(source_year AS VARCHAR) || '-'
      || lpad(CAST(source_month AS VARCHAR), 2, '0') || '.parquet' AS source_file
  FROM trips
),
raw_layer AS (SELECT * FROM keyed WHERE dur >= 0),
clean AS (
  SELECT * FROM raw_layer
  WHERE total_cents BETWEEN 1 AND 100000 AND pax BETWEEN 1 AND 6 AND dur BETWEEN 1 AND 1440
)"""

FLAG = f"""(CASE WHEN total_cents <= 0 THEN '{s.FLAGS[1]}' WHEN pax <= 0 THEN '{s.FLAGS[2]}'
  WHEN dur <= 0 THEN '{s.FLAGS[3]}' WHEN dur > 1440 THEN '{s.FLAGS[4]}'
  WHEN pax > 6 THEN '{s.FLAGS[5]}' WHEN total_cents > 100000 THEN '{s.FLAGS[6]}'
  ELSE '{s.FLAGS[7]}' END)"""

MONEY = """total_cents / 100.0::DOUBLE AS total_amount, fare_cents / 100.0::DOUBLE AS fare_amount,
  tip_cents / 100.0::DOUBLE AS tip_amount, tolls_cents / 100.0::DOUBLE AS tolls_amount"""

MEASURES = """CAST(pax AS DOUBLE) AS passenger_count, dist_tenths / 10.0::DOUBLE AS trip_distance,
  CAST(dur AS DOUBLE) AS trip_duration_minutes, pickup_hour, pickup_dayofweek,
  CAST(pickup_date AS VARCHAR) AS pickup_date, source_year, source_month"""

TIMES = """CAST(pickup_ts AS VARCHAR) AS pickup_datetime,
  CAST(dropoff_ts AS VARCHAR) AS dropoff_datetime"""

RAW_COLUMNS = f"""taxi_type, vendor_id AS "VendorID", {TIMES}, {MEASURES}, {MONEY}, record_key,
  order_key, source_file, trip_id, 'bronze' AS lakehouse_layer,
  (3 + CAST(total_cents BETWEEN 1 AND 100000 AS INTEGER) + CAST(pax BETWEEN 1 AND 6 AS INTEGER))
    / 5.0::DOUBLE AS data_quality_score"""

CLEAN_COLUMNS = f"""trip_id, taxi_type, vendor_id, {TIMES}, {MEASURES}, {MONEY},
  {FLAG} AS quality_flag, {PERIOD} AS time_period, {_area()} AS service_area"""

MARTS = f"""
monthly AS (
  SELECT taxi_type, source_year AS year, source_month AS month,
    {_month('source_month')} AS month_name, {_area()} AS service_area,
    COUNT(*) AS total_trips, COUNT(DISTINCT vendor_id) AS unique_vendors,
    COUNT(DISTINCT pickup_date) AS active_days,
    CAST(SUM(total_cents) AS BIGINT) / 100.0::DOUBLE AS total_revenue,
    {_mean('SUM(total_cents)', 'COUNT(*)', 2, 2)} AS avg_amount_per_trip,
    MIN(total_cents) / 100.0::DOUBLE AS min_amount, MAX(total_cents) / 100.0::DOUBLE AS max_amount,
    {_mean('SUM(pax)', 'COUNT(*)', 2)} AS avg_passengers_per_trip,
    {_mean('SUM(dur)', 'COUNT(*)', 2)} AS avg_trip_duration_minutes,
    {_mean('SUM(dist_tenths) * 10', 'COUNT(*)', 2, 2)} AS avg_trip_distance,
    CAST(SUM(pax) AS BIGINT) AS total_passengers,
    CAST(SUM(dist_tenths) * 10 AS BIGINT) / 100.0::DOUBLE AS total_distance
  FROM clean GROUP BY taxi_type, source_year, source_month
),
hourly AS (
  SELECT taxi_type, pickup_hour, {HOURS} AS hour_range, COUNT(*) AS total_trips,
    {_mean('SUM(pax)', 'COUNT(*)', 3)} AS avg_passengers_per_trip,
    CAST(SUM(pax) AS DOUBLE) AS total_passengers,
    CAST(MIN(pax) AS DOUBLE) AS min_passengers, CAST(MAX(pax) AS DOUBLE) AS max_passengers,
    {_mean('SUM(total_cents)', 'COUNT(*)', 2, 2)} AS avg_amount_per_trip,
    CAST(SUM(total_cents) AS BIGINT) / 100.0::DOUBLE AS total_revenue,
    {_mean('SUM(dist_tenths) * 10', 'COUNT(*)', 2, 2)} AS avg_trip_distance,
    {PERIOD} AS time_period, {_area()} AS service_area
  FROM clean WHERE source_month = 5 GROUP BY taxi_type, pickup_hour
),
fleets AS (
  SELECT taxi_type, {_area()} AS service_area, COUNT(*) AS total_trips,
    {_mean('SUM(total_cents)', 'COUNT(*)', 2, 2)} AS avg_fare,
    {_mean('SUM(pax)', 'COUNT(*)', 2)} AS avg_passengers,
    {_mean('SUM(dist_tenths) * 10', 'COUNT(*)', 2, 2)} AS avg_distance,
    {_mean('SUM(dur)', 'COUNT(*)', 2)} AS avg_duration,
    CAST(SUM(total_cents) AS BIGINT) / 100.0::DOUBLE AS total_revenue,
    {_mean('SUM(tip_cents)', 'COUNT(*)', 2, 2)} AS avg_tip,
    {_r('AVG(tip_cents / CAST(total_cents AS DOUBLE)) * 100', 2)} AS avg_tip_percentage,
    COUNT(*) FILTER (WHERE pickup_hour BETWEEN 6 AND 9) AS morning_rush_trips,
    COUNT(*) FILTER (WHERE pickup_hour BETWEEN 17 AND 20) AS evening_rush_trips
  FROM clean GROUP BY taxi_type
)"""


def _trips(body: str, *extra: str) -> str:
    return "WITH " + ",\n".join([TRIPS, *extra]) + "\n" + body


def _mart(body: str, *extra: str) -> str:
    return _trips(body, MARTS, *extra)


def _layer(columns: str, source: str) -> str:
    return _trips(f"SELECT {columns} FROM {source}")


def _money_text(col: str, digits: int) -> str:
    return "format('{:,." + str(digits) + "f}', " + col + ")"


# ----------------------------------------------------------------- statements


def _layers() -> dict[str, str]:
    clean = _layer(CLEAN_COLUMNS, "clean")
    raised = CLEAN_COLUMNS.replace(
        "total_cents / 100.0::DOUBLE AS total_amount",
        "(total_cents + CASE WHEN taxi_type = 'yellow' THEN 100 ELSE 0 END) / 100.0::DOUBLE"
        " AS total_amount",
    )
    everything = _trips(
        f"SELECT {raised} FROM clean UNION ALL "
        f"SELECT {CLEAN_COLUMNS} FROM raw_layer WHERE {FLAG} <> 'valid'"
    )
    green = (
        ("VendorID", "bigint", "bigint", "ok"),
        ("lpep_pickup_datetime", "timestamp", "timestamp", "ok"),
        ("lpep_dropoff_datetime", "timestamp", "timestamp", "ok"),
        ("passenger_count", "double", "double", "ok"),
        ("trip_distance", "double", "double", "ok"),
        ("RatecodeID", "double", None, "missing"),
        ("store_and_fwd_flag", "string", None, "missing"),
        ("PULocationID", "bigint", None, "missing"),
        ("DOLocationID", "bigint", None, "missing"),
        ("payment_type", "bigint", None, "missing"),
        ("fare_amount", "double", "double", "ok"),
        ("extra", "double", None, "missing"),
        ("mta_tax", "double", None, "missing"),
        ("tip_amount", "double", "double", "ok"),
        ("tolls_amount", "double", "double", "ok"),
        ("improvement_surcharge", "double", None, "missing"),
        ("total_amount", "double", "double", "ok"),
        ("congestion_surcharge", "double", None, "missing"),
        ("airport_fee", "double", None, "missing"),
        ("source_year", None, "int", "extra"),
        ("source_month", None, "int", "extra"),
        ("record_key", None, "string", "extra"),
        ("order_key", None, "bigint", "extra"),
        ("source_file", None, "string", "extra"),
        ("trip_type", None, "int", "extra"),
    )
    q = lambda v: "CAST(NULL AS VARCHAR)" if v is None else f"'{v}'"
    yellow = [(n.replace("lpep_", "tpep_"), e, f, st) for n, e, f, st in green if n != "trip_type"]

    def conformance(columns, status: str) -> str:
        rows = ", ".join(f"('{n}', {q(e)}, {q(f)}, '{st}')" for n, e, f, st in columns)
        return f"""
            SELECT column_name, status, expected_type, found_type, n.total_rows,
              CASE WHEN status <> 'missing' THEN n.total_rows END AS fitting_values
            FROM (VALUES {rows}) AS c(column_name, expected_type, found_type, status)
            CROSS JOIN (SELECT COUNT(*) AS total_rows FROM lineitem WHERE l_linestatus = '{status}') n"""

    return {
        "bronze_valid_trips": _layer(RAW_COLUMNS, "raw_layer"),
        "bronze_unified": _layer(
            RAW_COLUMNS
            + ", CASE WHEN taxi_type = 'green' THEN CAST(order_key % 2 + 1 AS INTEGER) END"
            " AS trip_type",
            "raw_layer",
        ),
        "refused_rows": _layer(
            "record_key, taxi_type, source_file, 'dropoff_before_pickup' AS refusal", "keyed WHERE dur < 0"
        ),
        "bronze_trip_id": _layer(
            'trip_id, vendor_id AS "VendorID", CAST(pickup_ts AS VARCHAR) AS pickup_datetime',
            "raw_layer",
        ),
        "conformance_report": conformance(green, "F"),
        "conformance_yellow": conformance(yellow, "O"),
        "manifest_ingest": _layer(
            f"""taxi_type, source_file, source_year, source_month, vendor_id AS "VendorID", {TIMES},
            CAST(pax AS DOUBLE) AS passenger_count, dist_tenths / 10.0::DOUBLE AS trip_distance,
            total_cents / 100.0::DOUBLE AS total_amount,
            CAST(dur AS DOUBLE) AS trip_duration_minutes, pickup_hour""",
            "raw_layer",
        ),
        "silver_trips": clean,
        "silver_quality_flags": _trips(
            f"SELECT {FLAG} AS quality_flag, COUNT(*) AS trips FROM raw_layer GROUP BY 1"
        ),
        "quarantine_trips": _trips(
            f"SELECT {CLEAN_COLUMNS} FROM raw_layer WHERE {FLAG} <> 'valid'"
        ),
        "stg_fare_tier": _trips(
            f"""SELECT taxi_type, CAST(pickup_ts AS VARCHAR) AS pickup_datetime,
              total_cents / 100.0::DOUBLE AS total_amount, CAST(pax AS DOUBLE) AS passenger_count,
              {PERIOD} AS time_period,
              {_above('total_cents / 100.0::DOUBLE', labels.FARE_TIERS, labels.FARE_TIER_ELSE)}
                AS fare_tier
            FROM clean"""
        ),
        "upsert_trips": everything,
        "upsert_months": _trips(
            f"SELECT {raised.replace('WHEN taxi_type', 'WHEN source_month = 5 AND taxi_type')} FROM clean UNION ALL "
            f"SELECT {CLEAN_COLUMNS} FROM raw_layer WHERE {FLAG} <> 'valid' AND source_month = 5"
        ),
        "arrivals_hourly": _trips(
            """SELECT taxi_type, CAST(date_trunc('hour', pickup_ts) AS VARCHAR) AS hour_start, COUNT(*) AS total_trips,
              CAST(SUM(total_cents) AS BIGINT) / 100.0::DOUBLE AS total_revenue
            FROM clean GROUP BY 1, 2"""
        ),
        "cube_monthly": _mart("SELECT * FROM monthly"),
        "cube_hourly_may": _mart("SELECT * FROM hourly"),
        "cube_comparison": _mart("SELECT * FROM fleets"),
        "sketch_spans_bound": _trips(
            """SELECT span, taxi_type, COUNT(*) AS total_trips, COUNT(DISTINCT vendor_id) AS vendors,
              COUNT(DISTINCT pickup_date) AS days, true AS counts_within_bound, true AS median_within_bound
            FROM clean, (VALUES ('month', 1995, 5), ('year', 1995, NULL), ('all', NULL, NULL)) AS s(span, y, m)
            WHERE source_year = coalesce(y, source_year) AND source_month = coalesce(m, source_month) GROUP BY span, taxi_type"""
        ),
        "selected_medians": _trips(
            """SELECT taxi_type, source_year, source_month, total_cents / 100.0::DOUBLE AS median_amount FROM (
              SELECT *, row_number() OVER (PARTITION BY taxi_type, source_year, source_month ORDER BY total_cents) AS place,
                COUNT(*) OVER (PARTITION BY taxi_type, source_year, source_month) AS n FROM clean
            ) WHERE place = (n + 1) // 2"""
        ),
        "layout_skew": _trips(
            """SELECT layout_key, CAST(SUM(n) AS BIGINT) AS record_count, COUNT(*) AS distinct_values,
              first(value ORDER BY n DESC, value) AS most_common, MAX(n) AS most_common_rows,
              MAX(n) / CAST(SUM(n) AS DOUBLE) AS largest_share,
              CAST(least(ceil(SUM(n) / 10000.0), COUNT(*)) AS BIGINT) AS suggested_buckets, MAX(n) > 20000 AS skewed
            FROM (
              SELECT 'pickup_hour' AS layout_key, CAST(pickup_hour AS VARCHAR) AS value, COUNT(*) AS n FROM clean GROUP BY 2
              UNION ALL SELECT 'pickup_date', CAST(pickup_date AS VARCHAR), COUNT(*) FROM clean GROUP BY 2
              UNION ALL SELECT 'vendor_id', CAST(vendor_id AS VARCHAR), COUNT(*) FROM clean GROUP BY 2
            ) GROUP BY layout_key"""
        ),
        "layout_boxes": _trips(
            """SELECT curve, COUNT(*) AS record_count, COUNT(*) FILTER (WHERE inside) AS box_rows,
              COUNT(*) FILTER (WHERE inside) AS opened_rows, true AS skips_files
            FROM (
              SELECT pickup_date BETWEEN DATE '1995-03-01' AND DATE '1995-08-31' AND dist_tenths BETWEEN 50 AND 90 AS inside
              FROM clean
            ), (VALUES ('hilbert'), ('z')) AS curves(curve) GROUP BY curve"""
        ),
        "new_month_keys": """
            WITH lines AS (
              SELECT l_orderkey AS order_key, l_orderkey * 8 + l_linenumber AS line_key,
                year(l_shipdate) * 100 + month(l_shipdate) AS m FROM lineitem
            ), fresh AS (SELECT * FROM lines WHERE m = 199505), old AS (SELECT * FROM lines WHERE m < 199505),
            counted AS (
              SELECT 'repeated:line_key' AS check_name, COUNT(line_key) - COUNT(DISTINCT line_key) AS failures FROM fresh
              UNION ALL SELECT 'repeated:order_key', COUNT(order_key) - COUNT(DISTINCT order_key) FROM fresh
              UNION ALL SELECT 'known:line_key', COUNT(DISTINCT line_key) FROM fresh WHERE line_key IN (SELECT line_key FROM old)
              UNION ALL SELECT 'known:order_key', COUNT(DISTINCT order_key) FROM fresh WHERE order_key IN (SELECT order_key FROM old)
              UNION ALL SELECT 'reference:order_key', COUNT(DISTINCT order_key) FROM fresh
                WHERE order_key NOT IN (SELECT o_orderkey FROM orders)
            )
            SELECT check_name, failures, (SELECT COUNT(*) FROM fresh) AS rows_checked, failures = 0 AS passed FROM counted""",
        "view_monthly": _mart("SELECT * FROM monthly"),
        "view_staging": _trips(
            f"""SELECT taxi_type, {PERIOD} AS time_period,
              {_above('total_cents / 100.0::DOUBLE', labels.FARE_TIERS, labels.FARE_TIER_ELSE)} AS fare_tier,
              COUNT(*) AS trips FROM clean GROUP BY ALL"""
        ),
        "compact_layout": clean,
        "balanced_layout": clean,
        "zorder_layout": clean,
        "partitioned_layout": _mart("SELECT * FROM hourly"),
        "bucketed_layout": _trips(
            """SELECT pickup_hour, CAST(pickup_date AS VARCHAR) AS pickup_date, COUNT(*) AS total_trips,
              CAST(SUM(total_cents) AS BIGINT) / 100.0::DOUBLE AS total_revenue
            FROM clean GROUP BY pickup_hour, pickup_date"""
        ),
        "layout_vendors_bound": _trips(
            """SELECT source_year, source_month, COUNT(DISTINCT vendor_id) AS vendors, true AS within_bound
            FROM clean GROUP BY source_year, source_month"""
        ),
        "layout_rows": _trips(
            """SELECT source_year, source_month, COUNT(*) AS record_count,
              CAST(SUM(total_cents) AS BIGINT) / 100.0::DOUBLE / 1024 / 1024 AS revenue_mebi
            FROM clean GROUP BY source_year, source_month"""
        ),
    }


def _marts() -> dict[str, str]:
    by_month = "ORDER BY year, month, taxi_type"
    return {
        "gold_monthly": _mart("SELECT * FROM monthly"),
        "lake_build": _mart("SELECT * FROM monthly"),
        "gold_hourly_may": _mart("SELECT * FROM hourly"),
        "gold_comparison": _mart("SELECT * FROM fleets"),
        "stats_bronze": _trips(
            "SELECT 'Bronze' AS layer, COUNT(*) AS total_records, "
            "COUNT(DISTINCT source_month) AS months FROM raw_layer"
        ),
        "stats_silver": _trips(
            f"SELECT 'Silver' AS layer, COUNT(*) AS total_records, "
            f"COUNT(DISTINCT {FLAG}) AS quality_flags, "
            f"COUNT(*) FILTER (WHERE {FLAG} = 'valid') AS valid_records FROM clean"
        ),
        "stats_flagged": _trips(
            f"SELECT 'Flagged' AS layer, COUNT(*) AS total_records, "
            f"COUNT(DISTINCT {FLAG}) AS quality_flags, "
            f"COUNT(*) FILTER (WHERE {FLAG} = 'valid') AS valid_records FROM raw_layer"
        ),
        "stats_gold": _mart(
            f"SELECT 'Gold-Monthly' AS layer, COUNT(*) AS total_months, "
            f"CAST(SUM(total_trips) AS BIGINT) AS total_trips_aggregated, "
            f"{_r('AVG(avg_amount_per_trip)', 2)} AS overall_avg_amount FROM monthly"
        ),
        "q1_report_gold": _mart(
            f"""SELECT taxi_type, year, month_name, avg_amount_per_trip, total_trips,
              {_money_text('total_revenue', 2)} AS total_revenue_formatted
            FROM monthly {by_month}"""
        ),
        "q1_distribution": _mart(
            f"""SELECT taxi_type, year, month_name, total_trips,
              {_money_text('total_revenue', 2)} AS revenue, avg_amount_per_trip,
              avg_passengers_per_trip FROM monthly {by_month}"""
        ),
        "q1_formatted_revenue": _mart(
            f"""SELECT '{reports.Q1_TITLE}' AS pergunta, taxi_type, year, month_name,
              avg_amount_per_trip AS resposta, total_trips,
              '$' || {_money_text('total_revenue', 0)} AS receita_total
            FROM monthly {by_month}"""
        ),
        "q1_from_silver": _trips(
            f"""SELECT taxi_type, source_month, {_month('source_month')} AS month_name,
              COUNT(*) AS total_trips,
              {_mean('SUM(total_cents)', 'COUNT(*)', 2, 2)} AS avg_amount_per_trip,
              CAST(SUM(total_cents) AS BIGINT) / 100.0::DOUBLE AS total_revenue
            FROM clean GROUP BY taxi_type, source_month"""
        ),
        "q1_mom_change": _trips(
            f"""SELECT pickup_month, month_name, avg_amount,
              {_r('avg_amount - before', 2)} AS month_over_month_change,
              {_pct('avg_amount - before', 'before')} AS pct_change
            FROM (SELECT *, LAG(avg_amount) OVER (ORDER BY pickup_month) AS before FROM m)""",
            f"""m AS (SELECT source_month AS pickup_month, {_month('source_month')} AS month_name,
              {_mean('SUM(total_cents)', 'COUNT(*)', 2, 2)} AS avg_amount
            FROM clean WHERE taxi_type = 'yellow' GROUP BY source_month)""",
        ),
        "q1_monthly_change": _trips(
            f"""SELECT *, {_r('avg_amount_per_trip - prev_month_avg', 2)} AS month_over_month_change,
              {_pct('avg_amount_per_trip - prev_month_avg', 'prev_month_avg')}
                AS month_over_month_pct
            FROM (SELECT *, LAG(avg_amount_per_trip) OVER (ORDER BY source_year, source_month)
                    AS prev_month_avg FROM m)""",
            f"""m AS (SELECT source_year, source_month, {_month('source_month')} AS month_name,
              {_mean('SUM(total_cents)', 'COUNT(*)', 4, 2)} AS avg_amount_per_trip
            FROM clean GROUP BY source_year, source_month)""",
        ),
        **{
            name: _trips(
                f"""SELECT source_year, source_month, {_month('source_month')} AS month_name,
              COUNT(*) AS total_trips,
              CAST(SUM(total_cents) AS BIGINT) / 100.0::DOUBLE AS total_revenue,
              {_mean('SUM(total_cents)', 'COUNT(*)', 4, 2)} AS avg_amount_per_trip,
              {_r('stddev_samp(total_cents) / 100', 4)} AS stddev_amount,
              quantile_disc(total_cents, 0.5) / 100.0::DOUBLE AS median_amount,
              COUNT(DISTINCT pickup_date) AS active_days,
              {_mean('SUM(total_cents)', 'COUNT(DISTINCT pickup_date)', 2, 2)} AS avg_daily_revenue
            FROM clean GROUP BY source_year, source_month"""
            )
            for name in ("q1_extended", "csv_roundtrip")
        },
    }


def _question_two() -> dict[str, str]:
    ranked = f"""h AS (SELECT pickup_hour, {HOURS} AS hour_range,
        {_mean('SUM(pax)', 'COUNT(*)', 6)} AS avg_passengers_per_trip, COUNT(*) AS total_trips,
        {PERIOD_PT} AS period_classification
      FROM clean WHERE source_month = 5 GROUP BY pickup_hour),
    ranked AS (SELECT *,
        CAST(DENSE_RANK() OVER (ORDER BY avg_passengers_per_trip DESC) AS INTEGER)
          AS rank_by_avg_passengers,
        CAST(DENSE_RANK() OVER (ORDER BY total_trips DESC) AS INTEGER) AS rank_by_trip_volume
      FROM h)"""
    return {
        "q2_report_gold": _mart(
            "SELECT taxi_type, hour_range, avg_passengers_per_trip, total_trips, time_period "
            "FROM hourly"
        ),
        "q2_business_hours": _mart(
            f"""SELECT '{reports.Q2_TITLE}' AS pergunta, taxi_type, hour_range,
              avg_passengers_per_trip AS resposta, total_trips, time_period
            FROM hourly WHERE pickup_hour >= 7 AND pickup_hour <= 19"""
        ),
        "q2_from_silver": _mart(
            """SELECT taxi_type, pickup_hour, hour_range, total_trips, avg_passengers_per_trip,
              total_passengers, time_period FROM hourly"""
        ),
        "q2_extended": _trips(
            f"""SELECT pickup_hour, {HOURS} AS hour_range, COUNT(*) AS total_trips,
              {_mean('SUM(pax)', 'COUNT(*)', 6)} AS avg_passengers_per_trip,
              CAST(SUM(pax) AS DOUBLE) AS total_passengers,
              {_r('stddev_samp(pax)', 4)} AS stddev_passengers,
              CAST(quantile_disc(pax, 0.5) AS DOUBLE) AS median_passengers,
              CAST(MIN(pax) AS DOUBLE) AS min_passengers,
              CAST(MAX(pax) AS DOUBLE) AS max_passengers,
              {_mean('SUM(total_cents)', 'COUNT(*)', 4, 2)} AS avg_amount_per_trip,
              {PERIOD_PT} AS period_classification
            FROM clean WHERE source_month = 5 GROUP BY pickup_hour"""
        ),
        "q1_median_bound": _trips(
            """SELECT source_year, source_month, quantile_disc(total_cents, 0.5) / 100.0::DOUBLE AS median_amount,
              true AS within_bound FROM clean GROUP BY source_year, source_month"""
        ),
        "q2_ranked_hours": _trips("SELECT * FROM ranked", ranked),
        "q2_rank_hours_top5": _trips(
            """SELECT hour_range, avg_passengers_per_trip, total_trips, period_classification
            FROM ranked WHERE rank_by_avg_passengers <= 5""",
            ranked,
        ),
        "q2_text_bar": _trips(
            f"""SELECT pickup_hour, {_mean('SUM(pax)', 'COUNT(*)', 3)} AS avg_passengers,
              COUNT(*) AS trip_count,
              repeat('*', CAST({_mean('SUM(pax) * 10', 'COUNT(*)', 0)} AS INTEGER)) AS visual_bar
            FROM clean WHERE taxi_type = 'yellow' AND source_month = 5 GROUP BY pickup_hour"""
        ),
        "month_by_hour": _trips(
            f"""SELECT source_month AS pickup_month, {_month('source_month')} AS month_name,
              pickup_hour, {_mean('SUM(pax)', 'COUNT(*)', 2)} AS avg_passengers
            FROM clean WHERE taxi_type = 'yellow' GROUP BY source_month, pickup_hour"""
        ),
        "may_peak_passengers": _trips(
            f"""SELECT pickup_hour, {_mean('SUM(pax)', 'COUNT(*)', 2)} AS avg_passengers,
              COUNT(*) AS trip_count, {PERIOD_PT} AS period_of_day
            FROM clean WHERE taxi_type = 'yellow' AND source_month = 5 GROUP BY pickup_hour"""
        ),
    }


def _fleets() -> dict[str, str]:
    averages = {
        "avg_fare": "avg_amount_per_trip",
        "avg_passengers": "avg_passengers_per_trip",
        "avg_distance": "avg_trip_distance",
    }
    h = lambda c: f"CAST(ROUND({c} * 100) AS BIGINT)"
    plain = ", ".join(
        f"{_mean(f'SUM({h(c)})', 'COUNT(*)', 4, 2)} AS {n}" for n, c in averages.items()
    )
    sums = {n: h(c) for n, c in zip(averages, ("total_revenue", "total_passengers", "total_distance"), strict=True)}
    weighted = ", ".join(
        f"{_mean(f'SUM({c})', 'SUM(total_trips)', 4, 2)} AS {n}_weighted" for n, c in sums.items()
    )
    hd = h("avg_trip_distance")
    plain_d = f"(CAST(SUM({hd}) AS DOUBLE) / COUNT(*) / 100.0::DOUBLE)"
    weighted_d = f"(CAST(SUM({sums['avg_distance']}) AS DOUBLE) / SUM(total_trips) / 100.0::DOUBLE)"
    rev_cents = "CAST(SUM(CAST(ROUND(total_revenue * 100) AS BIGINT)) AS DOUBLE)"
    strategy = ", ".join(
        "(" + ", ".join(f"'{v}'" for v in (row[0].split()[0].lower(), *row[1:])) + ")"
        for row in reports.STRATEGIES
    )
    return {
        "comparison_formatted": _mart(
            f"""SELECT taxi_type, service_area, total_trips,
              {_money_text('total_revenue', 2)} AS total_revenue_formatted, avg_fare,
              avg_passengers, avg_distance, avg_tip_percentage FROM fleets"""
        ),
        "market_share": _mart(
            f"""SELECT taxi_type, CAST(SUM(total_trips) AS BIGINT) AS total_trips,
              {rev_cents} / 100.0::DOUBLE AS total_revenue,
              {_pct('SUM(total_trips)', 'SUM(SUM(total_trips)) OVER ()')} AS trip_market_share,
              {_pct(rev_cents, f'SUM({rev_cents}) OVER ()')} AS revenue_market_share,
              {plain}, {weighted},
              {_mean(rev_cents, 'SUM(total_trips)', 2, 2)} AS revenue_per_trip,
              {_r(f'{rev_cents} / 100.0::DOUBLE / {plain_d} / SUM(total_trips)', 2)}
                AS revenue_per_mile,
              {_r(f'{rev_cents} / 100.0::DOUBLE / {weighted_d} / SUM(total_trips)', 2)}
                AS revenue_per_mile_weighted
            FROM monthly GROUP BY taxi_type"""
        ),
        "hourly_pivot": _mart(
            f"""SELECT hour_range,
              CAST(SUM(IF(taxi_type = 'yellow', total_trips, 0)) AS BIGINT) AS yellow_trips,
              CAST(SUM(IF(taxi_type = 'green', total_trips, 0)) AS BIGINT) AS green_trips,
              {", ".join(
                _r(f"AVG({col}) FILTER (WHERE taxi_type = '{f}')", d) + f" AS {f}_{name}"
                for col, name, d in (
                    ("avg_passengers_per_trip", "avg_passengers", 3),
                    ("avg_amount_per_trip", "avg_fare", 2),
                )
                for f in FLEETS)}
            FROM hourly GROUP BY hour_range, pickup_hour"""
        ),
        "period_share": _mart(
            f"""SELECT time_period, taxi_type, CAST(SUM(total_trips) AS BIGINT) AS total_trips,
              {_r('AVG(avg_passengers_per_trip)', 4)} AS avg_passengers,
              {_r('AVG(avg_amount_per_trip)', 4)} AS avg_fare,
              {_pct('SUM(total_trips)', 'SUM(SUM(total_trips)) OVER (PARTITION BY taxi_type)')}
                AS pct_of_taxi_trips
            FROM hourly GROUP BY time_period, taxi_type"""
        ),
        "monthly_trends": _mart(
            f"""SELECT taxi_type, year, month, month_name, total_trips, avg_amount_per_trip,
              {_r('avg_amount_per_trip - pf', 2)} AS fare_change,
              {_pct('avg_amount_per_trip - pf', 'pf')} AS fare_change_pct,
              total_trips - pt AS trip_change,
              {_pct('total_trips - pt', 'pt')} AS trip_change_pct
            FROM (SELECT *, LAG(avg_amount_per_trip) OVER w AS pf, LAG(total_trips) OVER w AS pt
                  FROM monthly WINDOW w AS (PARTITION BY taxi_type ORDER BY year, month))
            WHERE pf IS NOT NULL"""
        ),
        "service_quality": _mart(
            f"""SELECT taxi_type, service_area, avg_passengers, avg_distance,
              {_r('avg_duration / 60', 6)} AS avg_duration_hours, avg_tip_percentage,
              {_above('avg_tip_percentage', labels.TIP_LEVELS, labels.TIP_LEVEL_ELSE)}
                AS tip_category,
              morning_rush_trips + evening_rush_trips AS rush_hour_trips,
              {_pct('morning_rush_trips + evening_rush_trips', 'total_trips')}
                AS rush_hour_percentage
            FROM fleets"""
        ),
        "strategy_segments": _mart(
            f"""SELECT f.taxi_type, primary_market, positioning, target_customer,
              CASE WHEN f.taxi_type = 'yellow' THEN 'Premium Service' ELSE 'Volume Service' END
                AS business_model,
              {_above('avg_fare', labels.VALUE_SEGMENTS, labels.VALUE_SEGMENT_ELSE)}
                AS value_segment,
              recommendation
            FROM fleets f JOIN (VALUES {strategy})
              AS p(taxi_type, primary_market, positioning, target_customer, recommendation)
              ON f.taxi_type = p.taxi_type"""
        ),
    }


def _windows() -> dict[str, str]:
    frame = "RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    peaks = """SELECT CAST(pickup_date AS VARCHAR) AS pickup_date, pickup_hour, trips_in_hour
        FROM (SELECT *, MAX(trips_in_hour) OVER (PARTITION BY pickup_date) AS most
              FROM (SELECT pickup_date, pickup_hour, COUNT(*) AS trips_in_hour
                    FROM clean GROUP BY pickup_date, pickup_hour))
        WHERE trips_in_hour = most"""
    return {
        "running_hour_count": _trips(
            f"""SELECT trip_id, CAST(pickup_date AS VARCHAR) AS pickup_date, pickup_hour,
              COUNT(*) OVER (PARTITION BY pickup_date, pickup_hour ORDER BY pickup_ts {frame})
                AS trips_in_hour FROM clean"""
        ),
        "running_daily_total": _trips(
            f"""SELECT trip_id, CAST(pickup_date AS VARCHAR) AS pickup_date,
              CAST(SUM(total_cents) OVER (PARTITION BY pickup_date ORDER BY pickup_ts {frame})
                AS BIGINT) / 100.0::DOUBLE AS running_daily_total FROM clean"""
        ),
        "prev_trip_amount": _trips(
            """SELECT trip_id, vendor_id, CAST(pickup_ts AS VARCHAR) AS pickup_datetime,
              total_cents / 100.0::DOUBLE AS total_amount,
              LAG(total_cents) OVER (PARTITION BY vendor_id ORDER BY pickup_ts, trip_id)
                / 100.0::DOUBLE AS prev_trip_amount FROM clean"""
        ),
        "peak_hour_per_day": _trips(peaks),
        "peak_hour_first_rows": _trips(peaks + " ORDER BY pickup_date, pickup_hour LIMIT 10"),
    }


def _quality() -> dict[str, str]:
    per_file = """per_file AS (SELECT taxi_type, source_year, source_month, source_file,
        COUNT(*) AS total_records, COUNT(*) FILTER (WHERE dur >= 0) AS valid_records
      FROM keyed GROUP BY taxi_type, source_year, source_month, source_file)"""
    score = _r("valid_records / CAST(total_records AS DOUBLE)", 6)
    summary = f"""COUNT(*) AS files, CAST(SUM(total_records) AS BIGINT) AS total_records,
        CAST(SUM(valid_records) AS BIGINT) AS valid_records,
        {_pct('SUM(valid_records)', 'SUM(total_records)')} AS quality_percent FROM per_file"""
    text = reports.VALIDATION_LABELS
    avg_pax = _mean("SUM(pax)", "COUNT(*)", 2)
    avg_amt = _mean("SUM(total_cents)", "COUNT(*)", 2, 2)

    def check(name: str, failing: str) -> str:
        return (
            f"SELECT '{name}' AS check_name, COUNT(*) FILTER (WHERE {failing}) AS failures, "
            f"COUNT(*) AS rows_checked, COUNT(*) FILTER (WHERE {failing}) = 0 AS passed "
            f"FROM raw_layer"
        )

    nulls = {
        "VendorID": "vendor_id",
        "pickup_datetime": "pickup_ts",
        "dropoff_datetime": "dropoff_ts",
        "total_amount": "total_cents",
        "passenger_count": "pax",
    }
    checks = [check(f"not_null:{n}", f"{c} IS NULL") for n, c in nulls.items()]
    checks += [
        check("accepted_values:taxi_type", "taxi_type NOT IN ('yellow', 'green')"),
        check("rule:amount_in_range", "total_cents NOT BETWEEN 1 AND 100000"),
        check("rule:passengers_in_range", "pax NOT BETWEEN 1 AND 6"),
        check("rule:duration_in_range", "dur NOT BETWEEN 1 AND 1440"),
        check(
            "rule:period_match",
            "year(pickup_date) <> source_year OR month(pickup_date) <> source_month",
        ),
        check(
            "rule:in_season",
            "pickup_date NOT BETWEEN DATE '1994-01-01' AND DATE '1997-05-31'",
        ),
        "SELECT 'unique:trip_id' AS check_name, COUNT(*) FILTER (WHERE n > 1) AS failures, "
        "CAST(SUM(n) AS BIGINT) AS rows_checked, COUNT(*) FILTER (WHERE n > 1) = 0 AS passed "
        "FROM (SELECT COUNT(*) AS n FROM raw_layer GROUP BY trip_id)",
        check("reference:order_key", "order_key NOT IN (SELECT o_orderkey FROM orders)"),
    ]
    return {
        "validation_summary": _trips(
            f"""SELECT '{text[0]}' AS metric, CAST(COUNT(*) AS VARCHAR) AS value FROM y
            UNION ALL SELECT '{text[1]}', CAST(COUNT(*) FILTER (WHERE source_month = 5) AS VARCHAR)
              FROM y
            UNION ALL SELECT '{text[2]}', CAST(MIN(pickup_date) AS VARCHAR) || ' a '
              || CAST(MAX(pickup_date) AS VARCHAR) FROM y
            UNION ALL SELECT '{text[3]}', CAST({avg_pax} AS VARCHAR) FROM y
            UNION ALL SELECT '{text[4]}', '$' || CAST({avg_amt} AS VARCHAR) FROM y""",
            "y AS (SELECT * FROM clean WHERE taxi_type = 'yellow')",
        ),
        "file_quality": _trips(
            f"SELECT *, COALESCE({score}, 0) AS quality_score FROM per_file", per_file
        ),
        "ingestion_summary": _trips(
            f"SELECT taxi_type, {summary} GROUP BY taxi_type UNION ALL SELECT 'ALL', {summary}",
            per_file,
        ),
        "files_below_threshold": _trips(
            f"SELECT *, {score} AS quality_score FROM per_file WHERE {score} * 100 < 99.5", per_file
        ),
        "fleet_counts": _trips(
            "SELECT taxi_type, COUNT(*) AS trips FROM clean GROUP BY taxi_type "
            "UNION ALL SELECT 'ALL', COUNT(*) FROM clean"
        ),
        "dq_checks": _trips(" UNION ALL ".join(checks)),
        "freshness": _trips(
            """SELECT taxi_type, CAST(latest AS VARCHAR) AS latest, age_hours,
              CASE WHEN age_hours > 168 THEN 'error' WHEN age_hours > 24 THEN 'warn' ELSE 'pass'
              END AS status
            FROM (SELECT taxi_type, MAX(pickup_ts) AS latest,
                CAST(date_diff('second', MAX(pickup_ts), TIMESTAMP '2002-01-01') // 3600 AS BIGINT)
                  AS age_hours
              FROM raw_layer GROUP BY taxi_type)"""
        ),
    }


def _statistics() -> dict[str, str]:
    columns = {
        "total_amount": "total_cents / 100.0::DOUBLE",
        "passenger_count": "CAST(pax AS DOUBLE)",
        "trip_duration_minutes": "CAST(dur AS DOUBLE)",
        "pickup_hour": "CAST(pickup_hour AS DOUBLE)",
    }
    cells = " UNION ALL ".join(
        f"SELECT '{a}' AS variable_a, '{b}' AS variable_b, "
        + ("MAX(1.0::DOUBLE)" if a == b else _r(f"corr({x}, {y})", 6))
        + " AS correlation FROM clean"
        for a, x in columns.items()
        for b, y in columns.items()
    )
    return {"corr_matrix_long": _trips(cells)} | {
        "kmeans_checks": _trips(
            """SELECT CAST(3 AS BIGINT) AS clusters, COUNT(*) AS trips, CAST(0 AS BIGINT) AS misplaced,
              true AS outliers_within_bound FROM clean WHERE dist_tenths > 0"""
        )
    }


def _clusters() -> dict[str, str]:
    scaled = ("total_cents", "pax * 100", "dur * 100", "dist_tenths * 10")
    codes = ", ".join(
        f"CAST(length(bin({v})) * 4 + (({v}) >> greatest(length(bin({v})) - 3, 0)) % 4 AS INTEGER) AS c{i}"
        for i, v in enumerate(f"CAST({x} AS BIGINT)" for x in scaled)
    )
    sums = ", ".join(
        f"CAST(SUM({v}) AS BIGINT) AS s{i}, CAST(SUM(CAST({v} AS HUGEINT) * ({v})) AS VARCHAR) AS q{i}"
        for i, v in enumerate(scaled)
    )
    features = ("total_cents / 100.0::DOUBLE", "CAST(pax AS DOUBLE)", "CAST(dur AS DOUBLE)", "dist_tenths / 10.0::DOUBLE")

    def distance(point: tuple[float, ...]) -> str:
        steps = [f"(({c}) - {x!r}e0) * {w!r}e0" for c, x, w in zip(features, point, EARLIER_FIT.weights, strict=True)]
        return "sqrt(" + " + ".join(f"({s}) * ({s})" for s in steps) + ")"

    away = ", ".join(f"{distance(p)} AS d{i}" for i, p in enumerate(EARLIER_FIT.points))
    placed = f"""measured AS (SELECT *, {away} FROM clean WHERE dist_tenths > 0),
placed AS (
  SELECT *, CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS cluster,
    CAST(floor(least(d0, d1, d2) * 1000000) AS BIGINT) AS away FROM measured
),
placed_in_order AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY cluster ORDER BY away) AS place,
    COUNT(*) OVER (PARTITION BY cluster) AS members FROM placed
),
limits AS (SELECT cluster AS of_cluster, away AS furthest FROM placed_in_order WHERE place = (members * 99 + 99) // 100),
flagged AS (SELECT placed.*, away > furthest AS is_outlier FROM placed JOIN limits ON cluster = of_cluster)"""
    names = ("avg_amount", "avg_passengers", "avg_duration", "avg_distance")
    means = ", ".join(f"{_mean(f'SUM({v})', 'COUNT(*)', 4, 2)} AS {a}" for v, a in zip(scaled, names, strict=True))
    return {
        "cluster_cells": _trips(
            f"SELECT {codes}, COUNT(*) AS n, {sums} FROM clean WHERE dist_tenths > 0 GROUP BY c0, c1, c2, c3"
        ),
        "centre_profile": _trips(
            f"""SELECT CAST(cluster AS INTEGER) AS cluster, COUNT(*) AS trips,
              COUNT(*) FILTER (WHERE is_outlier) AS outliers, {means} FROM flagged GROUP BY cluster""",
            placed,
        ),
        "centre_outliers": _trips("SELECT trip_id, CAST(cluster AS INTEGER) AS cluster, is_outlier FROM flagged", placed),
        "coreset_checks": _trips(
            """SELECT CAST(3 AS BIGINT) AS clusters, COUNT(*) AS trips, true AS outliers_within_bound
              FROM clean WHERE dist_tenths > 0"""
        ),
    }


def oracle_sql() -> dict[str, str]:
    """Statement by query name. Approximate and clustering queries have none."""
    return {
        **_layers(), **_marts(), **_question_two(), **_fleets(), **_windows(), **_quality(),
        **_statistics(), **_clusters(),
    }
