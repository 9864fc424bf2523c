"""Append-only, checkpointed table sinks."""

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

# Fixed value: how often the silver and gold jobs look for new files.
EVERY_100_SECONDS = {"processingTime": "100 seconds"}
ONCE_OVER_ALL_INPUT = {"availableNow": True}


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    *,
    fmt: str = "parquet",
    partition_by: str | None = None,
    trigger: dict[str, Any] | None = None,
    rebalance: bool = False,
    merge_schema: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Start appending ``df`` to the table at ``path``; no trigger means batches run back to back.

    Rows go from the task that has them straight into their partition folder, so a hot partition value stays
    spread over all tasks. ``rebalance`` adds a shuffle for fewer, fuller files; it splits hot values by size.
    ``merge_schema`` lets new columns into a Delta table; parquet files merge theirs when they are read.
    """
    if rebalance:
        df = df.hint("rebalance", *([partition_by] if partition_by else []))
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if merge_schema and fmt == "delta":
        writer = writer.option("mergeSchema", "true")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if trigger:
        writer = writer.trigger(**trigger)
    if name:
        writer = writer.queryName(name)
    return writer.start(path)
