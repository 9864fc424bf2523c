"""Table layouts. Every column is nullable and every list of names is taken from these."""

from pyspark.sql.types import StructType


def _layout(*columns: tuple[str, str]) -> StructType:
    schema = StructType()
    for name, data_type in columns:
        schema.add(name, data_type)
    return schema


# Column names and types of the input and output tables.
RAW = _layout(
    ("VendorID", "integer"),
    ("tpep_pickup_datetime", "timestamp"),
    ("tpep_dropoff_datetime", "timestamp"),
    ("passenger_count", "double"),
    ("trip_distance", "double"),
    ("RatecodeID", "double"),
    ("store_and_fwd_flag", "string"),
    ("PULocationID", "integer"),
    ("DOLocationID", "integer"),
    ("payment_type", "long"),
    ("fare_amount", "double"),
    ("extra", "double"),
    ("mta_tax", "double"),
    ("tip_amount", "double"),
    ("tolls_amount", "double"),
    ("improvement_surcharge", "double"),
    ("total_amount", "double"),
    ("congestion_surcharge", "double"),
    ("Airport_fee", "double"),
    ("pickup_location", "string"),
    ("drop_off_location", "string"),
)

SILVER = _layout(
    ("vendor_id", "string"),
    ("pickup_timestamp", "timestamp"),
    ("drop_off_timestamp", "timestamp"),
    ("passenger_count", "double"),
    ("payment_type", "long"),
    ("fare_amount", "double"),
    ("pickup_location", "string"),
    ("drop_off_location", "string"),
)

GOLD = StructType(list(SILVER.fields)).add("tempmax", "string").add("tempmin", "string")

# The weather file is positional, so the order matters.
WEATHER_COLUMNS = (
    "name", "datetime", "tempmax", "tempmin", "temp", "feelslikemax", "feelslikemin", "feelslike", "dew",
    "humidity", "precip", "precipprob", "precipcover", "preciptype", "snow", "snowdepth", "windgust",
    "windspeed", "winddir", "sealevelpressure", "cloudcover", "visibility", "solarradiation", "solarenergy",
    "uvindex", "severerisk", "sunrise", "sunset", "moonphase", "conditions", "description", "icon", "stations",
)
WEATHER = _layout(*((name, "string") for name in WEATHER_COLUMNS))

ZONES = _layout(
    ("LocationID", "integer"),
    ("Borough", "string"),
    ("Zone", "string"),
    ("service_zone", "string"),
)

ZONE_NAME_COLUMNS = ("pickup_location", "drop_off_location")

# The enrichment step adds the two zone names; its input has the other raw columns.
UNENRICHED = StructType([field for field in RAW if field.name not in ZONE_NAME_COLUMNS])
