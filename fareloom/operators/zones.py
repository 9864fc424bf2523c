"""Zone names for the pickup and drop-off ids of a trip."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.operators.sizing import MAX_BROADCAST_BYTES, row_bytes
from fareloom.schemas import ZONE_NAME_COLUMNS
from fareloom.session import scratch_folder


def one_name_per_zone(zones: DataFrame) -> DataFrame:
    """``LocationID, Zone`` with each id once; the row that comes last in the file wins, even a null name.

    Rows of several files count in the order of the splits they are read in: larger files first.
    """
    return (
        zones.where(F.col("LocationID").isNotNull())
        .select("LocationID", F.struct("Zone").alias("name"), F.monotonically_increasing_id().alias("position"))
        .groupBy("LocationID")
        .agg(F.max_by("name", "position").alias("name"))
        .select("LocationID", "name.Zone")
    )


def _lookup(trips: DataFrame, names: DataFrame, id_column: str, name_column: str, broadcast: bool) -> DataFrame:
    side = names.select(F.col("LocationID").alias(id_column), F.col("Zone").alias(name_column))
    return trips.join(F.broadcast(side) if broadcast else side, id_column, "left")


def add_pickup_zone(trips: DataFrame, zones: DataFrame, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Append ``pickup_location``; every trip is kept, a miss gives null."""
    return _add(trips, zones, {"pickup_location": "PULocationID"}, max_broadcast_bytes)


def add_drop_off_zone(trips: DataFrame, zones: DataFrame, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Append ``drop_off_location``; every trip is kept, a miss gives null."""
    return _add(trips, zones, {"drop_off_location": "DOLocationID"}, max_broadcast_bytes)


def add_zone_names(trips: DataFrame, zones: DataFrame, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Append both names. One broadcast serves both roles and the trips are not shuffled.

    A dimension measured above the bound is joined by shuffle instead; the adaptive plan splits the
    partition of a hot (or null) id.
    """
    return _add(trips, zones, dict(zip(ZONE_NAME_COLUMNS, ("PULocationID", "DOLocationID"))), max_broadcast_bytes)


def _names(zones: DataFrame, max_broadcast_bytes: int, streaming: bool) -> tuple[DataFrame, bool]:
    """The dimension with each id once, so that no lookup can multiply trips, and whether to broadcast it.

    One small job looks at both. Ids that are unique already, the normal case, need no further step.
    """
    names = zones.where(F.col("LocationID").isNotNull()).select("LocationID", "Zone")
    seen = names.agg(
        F.coalesce(F.sum(row_bytes(names)), F.lit(0)).alias("bytes"),
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("LocationID").alias("ids"),
    ).first()
    if seen["rows"] == seen["ids"]:
        return names, seen["bytes"] <= max_broadcast_bytes
    unique = one_name_per_zone(zones)
    if streaming:
        # Row positions cannot be part of a streaming plan, so they are settled before it starts.
        folder = scratch_folder(zones.sparkSession, "zone-names")
        unique.write.parquet(folder)
        unique = zones.sparkSession.read.schema(unique.schema).parquet(folder)
    return unique, seen["bytes"] <= max_broadcast_bytes


def _add(trips: DataFrame, zones: DataFrame, roles: dict[str, str], max_broadcast_bytes: int) -> DataFrame:
    names, broadcast = _names(zones, max_broadcast_bytes, trips.isStreaming)
    kept = trips.drop(*roles)
    result = kept
    for name_column, id_column in roles.items():
        result = _lookup(result, names, id_column, name_column, broadcast)
    return result.select(*kept.columns, *roles)
