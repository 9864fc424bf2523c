"""For each registered query, SQL that computes the same rows straight from the given tables."""

from fareloom.schemas import RAW, UNENRICHED

_TRIPS = """
trips AS (
    SELECT l_orderkey,
           CAST(NULLIF(l_linenumber, 7) AS INT) AS VendorID,
           l_shipdate AS tpep_pickup_datetime,
           l_shipdate + to_minutes(CAST((l_quantity - 5) * 30 AS BIGINT)) AS tpep_dropoff_datetime,
           l_quantity AS passenger_count,
           l_extendedprice AS trip_distance,
           CAST(l_linenumber AS DOUBLE) AS RatecodeID,
           l_linestatus AS store_and_fwd_flag,
           CAST(l_suppkey % 27 AS INT) AS PULocationID,
           CAST(l_partkey % 27 AS INT) AS DOLocationID,
           CAST(l_linenumber AS BIGINT) AS payment_type,
           CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS fare_amount,
           l_tax AS extra,
           l_tax AS mta_tax,
           l_discount AS tip_amount,
           l_tax AS tolls_amount,
           l_discount AS improvement_surcharge,
           l_extendedprice AS total_amount,
           l_discount AS congestion_surcharge,
           l_tax AS Airport_fee
    FROM lineitem
)"""

_ENRICHED = (
    _TRIPS
    + """,
enriched AS (
    SELECT trips.*, p.n_name AS pickup_location, d.n_name AS drop_off_location
    FROM trips
    LEFT JOIN nation p ON p.n_nationkey = trips.PULocationID
    LEFT JOIN nation d ON d.n_nationkey = trips.DOLocationID
)"""
)

_SILVER = (
    _ENRICHED
    + """,
silver AS (
    SELECT VendorID AS vendor_id, tpep_pickup_datetime AS pickup_timestamp,
           tpep_dropoff_datetime AS drop_off_timestamp, passenger_count, payment_type, fare_amount,
           pickup_location, drop_off_location
    FROM enriched
)"""
)


def _weather(station: str) -> str:
    return f"""
weather AS (
    SELECT {station} AS name, strftime(o_orderdate, '%Y-%m-%d') AS datetime,
           CAST(CAST(max(o_totalprice) AS DECIMAL(18, 2)) AS VARCHAR) AS tempmax,
           CAST(CAST(min(o_totalprice) AS DECIMAL(18, 2)) AS VARCHAR) AS tempmin,
           CAST(o_orderdate AS DATE) AS date
    FROM orders
    GROUP BY ALL
)"""


_ONE_STATION = _weather("'NYC'")
_THREE_STATIONS = _weather("o_orderstatus")


def _gold(weather: str) -> str:
    return f"""WITH {_SILVER}, {weather}
SELECT CAST(vendor_id AS VARCHAR) AS vendor_id, pickup_timestamp, drop_off_timestamp, passenger_count, payment_type,
       fare_amount, pickup_location, drop_off_location, tempmax, tempmin
FROM silver JOIN weather ON CAST(drop_off_timestamp AS DATE) = date"""


# The rows after each of two runs; the first knows the weather of the days before.
_LATE_RUNS = f"""SELECT *, 1 AS run FROM ({_gold(_ONE_STATION)} AND date < DATE '1998-06-01')
UNION ALL
SELECT *, 2 AS run FROM ({_gold(_ONE_STATION)})"""


_PASSES = {
    "isComplete(vendor_id)": "VendorID IS NOT NULL",
    "isNonNegative(fare_amount)": "coalesce(fare_amount, 0) >= 0",
    "Drop-off timestamp should be later than pickup timestamp": "tpep_dropoff_datetime > tpep_pickup_datetime",
}
_PASSED = [f"count(*) FILTER (WHERE {predicate})" for predicate in _PASSES.values()]


def _passing(position: int) -> str:
    return f"WITH {_TRIPS} SELECT {_PASSED[position]} AS passed, count(*) AS total FROM trips"


_REPORT = (
    f"WITH {_TRIPS}, counted AS (\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{name}' AS name, {passed} AS passed, count(*) AS total FROM trips"
        for name, passed in zip(_PASSES, _PASSED)
    )
    + "\n)"
)
_ALL_PASS = " AND ".join(f"coalesce({predicate}, false)" for predicate in _PASSES.values())

_RAW_COLUMNS = ", ".join(RAW.fieldNames())
_CATALOG_COLUMNS = ", ".join(
    f"{name} AS {name.lower()}" for name in RAW.fieldNames() if name != "VendorID"
)
_BEFORE_NAMES = ", ".join(UNENRICHED.fieldNames())
_STREAM_SILVER = "CAST(vendor_id AS VARCHAR) AS vendor_id"

ORACLES: dict[str, str] = {
    "bronze_scan": f"WITH {_TRIPS} SELECT * FROM trips",
    "zones_csv": """
SELECT n_nationkey AS LocationID, CAST(n_regionkey AS VARCHAR) AS Borough,
       CASE WHEN n_nationkey < 22 THEN n_name END AS Zone, 'all' AS service_zone
FROM nation""",
    "enrich_pickup": f"WITH {_ENRICHED} SELECT * EXCLUDE (drop_off_location) FROM enriched",
    "enrich_dropoff": f"WITH {_ENRICHED} SELECT * EXCLUDE (pickup_location) FROM enriched",
    "enrich_zones": f"WITH {_ENRICHED} SELECT * FROM enriched",
    "enrich_roundtrip": f"WITH {_ENRICHED} SELECT {_RAW_COLUMNS} FROM enriched",
    "silver_rename": f"""WITH {_ENRICHED}
SELECT * RENAME (VendorID AS vendor_id, tpep_pickup_datetime AS pickup_timestamp,
                 tpep_dropoff_datetime AS drop_off_timestamp)
FROM enriched""",
    "silver_select": f"WITH {_SILVER} SELECT * FROM silver",
    "weather_day": f"WITH {_ONE_STATION} SELECT * FROM weather",
    "weather_day_stations": f"WITH {_THREE_STATIONS} SELECT * FROM weather",
    "trip_day": f"""WITH {_TRIPS}
SELECT l_orderkey, CAST(tpep_pickup_datetime AS DATE) AS pickup_day,
       CAST(tpep_dropoff_datetime AS DATE) AS drop_off_day
FROM trips""",
    "gold_join": _gold(_ONE_STATION),
    "gold_join_fanout": _gold(_THREE_STATIONS),
    "dq_complete": _passing(0),
    "dq_nonneg": _passing(1),
    "dq_order": _passing(2),
    "dq_report": f"""{_REPORT}
SELECT 'Data Validation Check' AS "check", 'Error' AS check_level,
       CASE WHEN bool_and(passed = total) OVER () THEN 'Success' ELSE 'Error' END AS check_status,
       name AS "constraint",
       CASE WHEN passed = total THEN 'Success' ELSE 'Failure' END AS constraint_status,
       CASE WHEN passed = total THEN '' ELSE passed || ' of ' || total || ' rows pass' END AS constraint_message
FROM counted""",
    "dq_gate": f"""{_REPORT}
SELECT count(*) AS failed_constraints, count(*) > 0 AS rejected FROM counted WHERE passed <> total""",
    "stream_bronze": f"WITH {_ENRICHED} SELECT {_RAW_COLUMNS} FROM enriched",
    "stream_bronze_batches": f"WITH {_ENRICHED} SELECT {_RAW_COLUMNS} FROM enriched",
    "stream_silver": f"WITH {_SILVER} SELECT * REPLACE ({_STREAM_SILVER}) FROM silver",
    "stream_report": f"""WITH {_TRIPS}
SELECT count(*) AS total, {", ".join(f"{p} AS passed_{i}" for i, p in enumerate(_PASSED))} FROM trips""",
    "stream_gate": f"""WITH {_TRIPS}
SELECT CASE WHEN bool_and({_ALL_PASS}) THEN count(*) ELSE 0 END AS rows_written,
       NOT bool_and({_ALL_PASS}) AS rejected
FROM trips""",
    "stream_gate_open": f"WITH {_SILVER} SELECT * REPLACE ({_STREAM_SILVER}) FROM silver",
    "silver_partition_read": f"""WITH {_SILVER}
SELECT {_STREAM_SILVER}, payment_type, fare_amount, pickup_location FROM silver""",
    "stream_gold": _gold(_ONE_STATION),
    "stream_gold_fanout": _gold(_THREE_STATIONS),
    "stream_gold_bounded": _gold(_ONE_STATION),
    "stream_gold_static": _gold(_ONE_STATION),
    "stream_gold_table": _gold(_ONE_STATION),
    "stream_gold_late_weather": _LATE_RUNS,
    "stream_gold_table_late_weather": _LATE_RUNS,
    "stream_gold_bounded_late": f"""WITH {_SILVER}, {_ONE_STATION},
batches AS (
    SELECT *, CASE WHEN CAST(drop_off_timestamp AS DATE) >= DATE '1996-01-01' THEN 0 ELSE 1 END AS batch_id
    FROM silver WHERE drop_off_timestamp IS NOT NULL
),
mark AS (
    SELECT least((SELECT max(drop_off_timestamp) FROM batches WHERE batch_id = 0),
                 (SELECT max(CAST(date AS TIMESTAMP)) FROM weather)) - INTERVAL 1200 DAY AS watermark
),
told AS (
    SELECT batch_id, batch_id = 1 AND drop_off_timestamp < watermark AS late,
           CAST(drop_off_timestamp AS DATE) IN (SELECT date FROM weather) AS joins
    FROM batches, mark
),
counted AS (
    SELECT batch_id, count(*) AS arrived, count(*) FILTER (WHERE NOT late) AS candidates,
           count(*) FILTER (WHERE late) AS late, count(*) FILTER (WHERE NOT late AND joins) AS more
    FROM told GROUP BY batch_id
)
SELECT CAST(batch_id AS BIGINT) AS batch_id, arrived, candidates, late,
       CAST(sum(more) OVER (ORDER BY batch_id) AS BIGINT) AS gold
FROM counted""",
    "stream_gold_table_batches": _gold(_ONE_STATION),
    "bronze_evolution": f"""WITH {_ENRICHED}
SELECT {_RAW_COLUMNS} FROM enriched
UNION ALL
SELECT {_BEFORE_NAMES}, NULL, NULL FROM enriched""",
    "catalog_bronze": f"WITH {_ENRICHED} SELECT {_CATALOG_COLUMNS}, CAST(VendorID AS VARCHAR) AS vendorid FROM enriched",
}
