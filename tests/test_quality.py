"""Checks, report, gate."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fareloom.operators.quality import (
    TRIP_CONSTRAINTS,
    QualityError,
    failed_constraints,
    is_complete,
    is_non_negative,
    passing_rows,
    quality_report,
    satisfies,
    validate,
)
from tests.conftest import at, plan_of, silver_trips

NOON, LATER = at("2024-01-01T12:00:00"), at("2024-01-01T12:30:00")
GOOD = {"vendor_id": "1", "pickup_timestamp": NOON, "drop_off_timestamp": LATER, "fare_amount": 5.0}


def _trips(spark, *changes):
    return silver_trips(spark, [{**GOOD, **change} for change in changes])


def _passed(df, constraint):
    return tuple(passing_rows(df, constraint).first())


def test_completeness(spark):
    assert _passed(_trips(spark, {}, {"vendor_id": None}), is_complete("vendor_id")) == (1, 2)


def test_non_negative_lets_null_and_zero_pass(spark):
    fares = _trips(spark, *({"fare_amount": fare} for fare in (-3.0, 0.0, None)))
    assert _passed(fares, is_non_negative("fare_amount")) == (2, 3)


def test_time_order_needs_a_later_drop_off(spark):
    ends = _trips(spark, {}, *({"drop_off_timestamp": end} for end in (None, NOON, at("2024-01-01T11:00:00"))))
    assert _passed(ends, TRIP_CONSTRAINTS[2]) == (1, 4)


def test_report_has_one_row_per_constraint(spark):
    report = quality_report(_trips(spark, {}, {"vendor_id": None}))
    assert report.columns == [
        "check",
        "check_level",
        "check_status",
        "constraint",
        "constraint_status",
        "constraint_message",
    ]
    rows = report.collect()
    assert [(r["check_status"], r["constraint_status"], r["constraint_message"]) for r in rows] == [
        ("Error", "Failure", "1 of 2 rows pass"),
        ("Error", "Success", ""),
        ("Error", "Success", ""),
    ]


def test_all_constraints_share_one_scan(spark, folder):
    _trips(spark, {}).write.parquet(folder("silver"))
    plan = plan_of(quality_report(spark.read.parquet(folder("silver"))))
    assert plan.count("FileScan") == 1
    assert "pickup_location" not in plan


def test_no_rows_pass(spark):
    assert failed_constraints(quality_report(_trips(spark))).count() == 0


def test_validation_modes_on_a_static_frame(spark):
    bad, good = _trips(spark, {"fare_amount": -1.0}), _trips(spark, {})
    assert validate(bad) is bad
    assert validate(bad, "report").collect() == bad.collect()
    assert validate(good, "fail") is good
    with pytest.raises(QualityError, match="isNonNegative.*0 of 1 rows pass"):
        validate(bad, "fail")
    with pytest.raises(ValueError):
        validate(good, "sometimes")


def test_own_constraints(spark):
    short = satisfies("passenger_count < 7", "few passengers")
    assert _passed(_trips(spark, {"passenger_count": 3.0}, {"passenger_count": None}), short) == (1, 2)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(
        st.tuples(
            st.none() | st.just("1"),
            st.none() | st.floats(-5, 5),
            st.none() | st.sampled_from([NOON, LATER]),
            st.none() | st.sampled_from([NOON, LATER]),
        ),
        max_size=12,
    )
)
def test_report_agrees_with_counting_row_by_row(spark, rows):
    names = ("vendor_id", "fare_amount", "pickup_timestamp", "drop_off_timestamp")
    report = quality_report(silver_trips(spark, [dict(zip(names, row)) for row in rows])).collect()
    expected = [
        all(vendor is not None for vendor, *_ in rows),
        all((fare or 0) >= 0 for _, fare, *_ in rows),
        all(start is not None and end is not None and end > start for *_, start, end in rows),
    ]
    assert [row["constraint_status"] == "Success" for row in report] == expected
