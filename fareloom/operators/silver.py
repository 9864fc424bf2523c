"""Raw trips to silver trips."""

from pyspark.sql import DataFrame

from fareloom.schemas import SILVER

# The raw columns whose name changes; the other silver columns keep theirs.
RENAMES = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_timestamp",
    "tpep_dropoff_datetime": "drop_off_timestamp",
}


def rename_to_silver(raw: DataFrame) -> DataFrame:
    """Rename; a raw column that is missing is passed over."""
    return raw.withColumnsRenamed(RENAMES)


def select_silver(renamed: DataFrame) -> DataFrame:
    """Keep the eight silver columns in order; fails if one is missing."""
    return renamed.select(*SILVER.fieldNames())


def to_silver(raw: DataFrame) -> DataFrame:
    """Rename, then prune: one projection in the plan, and the scan reads eight columns."""
    return raw.transform(rename_to_silver).transform(select_silver)
