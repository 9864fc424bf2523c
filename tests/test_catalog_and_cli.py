"""The catalog table and the command line."""

from fareloom import catalog
from fareloom.__main__ import main
from fareloom.jobs import run_catalog
from fareloom.schemas import RAW, UNENRICHED, ZONES
from fareloom.sources.readers import read_bronze, read_gold, read_silver
from tests.conftest import at, frame, plan_of, raw_trips, rows_of, weather_rows

ROWS = [
    {
        "VendorID": vendor,
        "tpep_pickup_datetime": at("2024-01-01T10:00:00"),
        "tpep_dropoff_datetime": at("2024-01-01T10:10:00"),
        "PULocationID": 1,
        "DOLocationID": 2,
        "fare_amount": 3.0,
    }
    for vendor in (1, 2, 2, None)
]


def _update(spark, folder):
    return run_catalog(
        spark,
        folder("bronze"),
        folder("table"),
        folder("checkpoint"),
        "lake_test",
        "rows_" + folder("x").split("/")[-2].replace("-", "_"),
        database_location=folder("database"),
    )


def test_catalog_table(spark, folder):
    raw_trips(spark, ROWS).write.parquet(folder("bronze"))
    table = spark.table(_update(spark, folder))
    assert [f.name for f in table.schema] == [*catalog.DATA_COLUMNS.fieldNames(), "vendorid"]
    assert len(catalog.DATA_COLUMNS) == 20
    assert table.schema["vendorid"].dataType.simpleString() == "string"
    assert {r["vendorid"]: r["count"] for r in table.groupBy("vendorid").count().collect()} == {"1": 1, "2": 2, None: 1}
    assert "PartitionFilters: [isnotnull(vendorid" in plan_of(table.where("vendorid = '2'"))


def test_updating_the_table_takes_only_new_rows(spark, folder):
    raw_trips(spark, ROWS[:1]).write.parquet(folder("bronze"))
    assert spark.table(_update(spark, folder)).count() == 1
    raw_trips(spark, ROWS[1:]).write.mode("append").parquet(folder("bronze"))
    for _ in range(2):
        name = _update(spark, folder)
        spark.catalog.refreshTable(name)
        assert spark.table(name).count() == 4


def test_every_job_from_the_command_line(spark, folder):
    frame(spark, UNENRICHED, ROWS).write.parquet(folder("trips"))
    zones = frame(spark, ZONES, [{"LocationID": 1, "Zone": "A"}, {"LocationID": 2, "Zone": "B"}])
    zones.coalesce(1).write.option("header", True).csv(folder("zones"))
    weather = weather_rows(spark, [("NYC", "2024-01-01", "5.0", "1.0")])
    weather.coalesce(1).write.option("header", True).csv(folder("weather"))

    def run(job, source, output, *more):
        arguments = [job, "--input-path", folder(source), "--output-path", folder(output), *more]
        if job in ("bronze", "silver", "gold"):
            arguments += ["--checkpoint-location", folder(f"{output}-c"), "--once"]
        main(arguments)

    run("enrich", "trips", "raw", "--zones-path", folder("zones"))
    run("bronze", "raw", "bronze")
    bronze = read_bronze(spark, folder("bronze"))
    assert bronze.columns == RAW.fieldNames()
    assert {tuple(r) for r in bronze.select("pickup_location", "drop_off_location").collect()} == {("A", "B")}
    run("silver", "bronze", "silver", "--validation", "report")
    assert read_silver(spark, folder("silver")).count() == 4
    run("gold", "silver", "gold", "--input-path-weather", folder("weather"))
    run("gold", "silver", "gold-s", "--input-path-weather", folder("weather"), "--mode", "stream", "--salts", "2")
    gold = rows_of(read_gold(spark, folder("gold")))
    assert len(gold) == 4 and gold == rows_of(read_gold(spark, folder("gold-s")))
    names = ("--checkpoint-location", folder("table-c"), "--database", "lake_cli", "--table", "bronze_rows")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS lake_cli LOCATION '{folder('database')}'")
    run("catalog", "bronze", "table", *names)
    assert spark.table("lake_cli.bronze_rows").count() == 4
