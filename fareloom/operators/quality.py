"""Data checks on silver trips."""

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.session import write_text

# Fixed value: name of the check in reports.
CHECK_NAME = "Data Validation Check"
OBSERVATION_NAME = "trip_quality"
REPORT_SCHEMA = "batch_id long, constraint string, passed long, total long"


@dataclass(frozen=True)
class Constraint:
    """A predicate (SQL text) that all rows have to pass; null counts as not passing."""

    name: str
    predicate: str

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def is_complete(column: str) -> Constraint:
    return Constraint(f"isComplete({column})", f"`{column}` IS NOT NULL")


def is_non_negative(column: str) -> Constraint:
    """A null value passes."""
    return Constraint(f"isNonNegative({column})", f"coalesce(`{column}`, 0) >= 0")


def satisfies(predicate: str, name: str) -> Constraint:
    """A null result of the predicate fails."""
    return Constraint(name, predicate)


# The constraints on silver trips.
TRIP_CONSTRAINTS = (
    is_complete("vendor_id"),
    is_non_negative("fare_amount"),
    satisfies(
        "drop_off_timestamp > pickup_timestamp", "Drop-off timestamp should be later than pickup timestamp"
    ),
)


class QualityError(Exception):
    """Raised when a batch fails a constraint."""


def _counts(constraints: Sequence[Constraint]) -> list[Column]:
    passed = [F.count_if(c.passes()).alias(f"passed_{i}") for i, c in enumerate(constraints)]
    return [F.count(F.lit(1)).alias("total"), *passed]


def passing_rows(df: DataFrame, constraint: Constraint) -> DataFrame:
    """One row: how many rows pass, and how many there are."""
    return df.agg(*_counts([constraint])).select(F.col("passed_0").alias("passed"), "total")


def quality_report(
    df: DataFrame, constraints: Sequence[Constraint] = TRIP_CONSTRAINTS, check: str = CHECK_NAME
) -> DataFrame:
    """One row per constraint. All constraints are counted in a single pass over the data."""
    all_passed = F.lit(True)
    rows = []
    for i, constraint in enumerate(constraints):
        passed = F.col(f"passed_{i}")
        holds = passed == F.col("total")
        all_passed = all_passed & holds
        shortfall = F.concat(passed.cast("string"), F.lit(" of "), F.col("total").cast("string"), F.lit(" rows pass"))
        rows.append(
            F.struct(
                F.lit(constraint.name).alias("constraint"),
                F.when(holds, "Success").otherwise("Failure").alias("constraint_status"),
                F.when(holds, "").otherwise(shortfall).alias("constraint_message"),
            )
        )
    return (
        df.agg(*_counts(constraints))
        .select(
            F.lit(check).alias("check"),
            F.lit("Error").alias("check_level"),
            F.when(all_passed, "Success").otherwise("Error").alias("check_status"),
            F.inline(F.array(*rows)),
        )
    )


def failed_constraints(report: DataFrame) -> DataFrame:
    return report.where(F.col("constraint_status") != "Success")


def require_quality(df: DataFrame, constraints: Sequence[Constraint] = TRIP_CONSTRAINTS) -> DataFrame:
    """Check a static frame now and raise if a constraint fails; the frame itself comes back unchanged."""
    failed = failed_constraints(quality_report(df, constraints)).collect()  # one row per constraint at most
    if failed:
        details = "; ".join(f"{row['constraint']}: {row['constraint_message']}" for row in failed)
        raise QualityError(f"The data quality check has failed: {details}")
    return df


def guard_rows(df: DataFrame, constraints: Sequence[Constraint] = TRIP_CONSTRAINTS) -> DataFrame:
    """Stop the job at the first row that fails, naming all constraints that this row fails.

    Each constraint asks all rows to pass, so one bad row decides it. The check therefore rides along with
    the write in one pass, and a failed batch is never committed to the sink.
    """
    if not constraints:
        return df
    failed = F.concat_ws("; ", *(F.when(~c.passes(), F.lit(c.name)) for c in constraints))
    stop = F.raise_error(F.concat(F.lit("The data quality check has failed: "), failed)).cast("boolean")
    return df.where(F.when(failed == "", F.lit(True)).otherwise(stop))


def batch_counts(df: DataFrame, constraints: Sequence[Constraint] = TRIP_CONSTRAINTS) -> DataFrame:
    """One row per constraint, counted in one pass: ``constraint``, rows that pass, and all rows."""
    rows = [
        F.struct(F.lit(c.name).alias("constraint"), F.col(f"passed_{i}").alias("passed"), F.col("total").alias("total"))
        for i, c in enumerate(constraints)
    ]
    return df.agg(*_counts(constraints)).select(F.inline(F.array(*rows)))


def write_report(spark: SparkSession, folder: str, batch_id: int, rows: Sequence[tuple[str, int | None, int | None]]) -> None:
    """Keep (constraint, passed, total) as the counts of a batch; writing them again replaces them."""
    lines = (json.dumps(dict(zip(("constraint", "passed", "total"), row))) for row in rows)
    write_text(spark, f"{folder.rstrip('/')}/batch_id={batch_id}/counts.json", "\n".join(lines))


def keep_report(
    df: DataFrame, folder: str, batch_id: int, constraints: Sequence[Constraint] = TRIP_CONSTRAINTS
) -> None:
    """Count a static frame as batch ``batch_id`` of the report table."""
    rows = batch_counts(df, constraints).collect()  # one for each constraint
    write_report(df.sparkSession, folder, batch_id, [tuple(row) for row in rows])


def read_report(spark: SparkSession, folder: str) -> DataFrame:
    """``batch_id, constraint, passed, total`` and the batch's status for each constraint; ``Unknown`` where a batch was
    written and its counts were lost with the driver."""
    rows = spark.read.schema(REPORT_SCHEMA).json(folder)
    known = F.when(F.col("passed") == F.col("total"), "Success").otherwise("Failure")
    status = F.when(F.col("total").isNull(), "Unknown").otherwise(known)
    return rows.select("batch_id", "constraint", "passed", "total", status.alias("constraint_status"))


def observe_quality(df: DataFrame, constraints: Sequence[Constraint] = TRIP_CONSTRAINTS) -> DataFrame:
    """Count as the rows pass by; a stream shows the counts in its progress, with no second pass."""
    return df.observe(OBSERVATION_NAME, *_counts(constraints))


def validate(
    df: DataFrame, mode: str = "off", constraints: Sequence[Constraint] = TRIP_CONSTRAINTS
) -> DataFrame:
    """The validation step of the silver job: ``off`` (pass through), ``report`` or ``fail``."""
    if mode == "off":
        return df
    if mode == "report":
        return observe_quality(df, constraints)
    if mode == "fail":
        return guard_rows(df, constraints) if df.isStreaming else require_quality(df, constraints)
    raise ValueError(f"unknown validation mode: {mode!r}")
