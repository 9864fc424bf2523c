"""Command line: ``python -m fareloom <job> --input-path … --output-path … --checkpoint-location …``."""

import argparse
import sys

from fareloom import catalog, jobs
from fareloom.session import TIME_ZONE, get_session
from fareloom.sources.evolution import read_schema
from fareloom.sources.readers import archived_to
from fareloom.streaming.sinks import EVERY_100_SECONDS, ONCE_OVER_ALL_INPUT


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="fareloom", description=__doc__)
    parser.add_argument("--job-name", help="name of the Spark application")
    commands = parser.add_subparsers(dest="job", required=True)

    enrich = commands.add_parser("enrich", help="add zone names to raw trips (batch)")
    enrich.add_argument("--input-path", required=True)
    enrich.add_argument("--zones-path", required=True)
    enrich.add_argument("--output-path", required=True)
    enrich.add_argument("--mode", default="errorifexists", choices=("errorifexists", "append", "overwrite"))
    enrich.add_argument("--time-zone", default=TIME_ZONE, help="zone of times that name none")

    table = commands.add_parser("catalog", help="bring the bronze catalog table up to date")
    table.add_argument("--input-path", required=True)
    table.add_argument("--output-path", required=True)
    table.add_argument("--checkpoint-location", required=True)
    table.add_argument("--database", default=catalog.DATABASE)
    table.add_argument("--table", default=catalog.TABLE)

    table.add_argument("--max-bytes-per-trigger", type=int)
    table.add_argument("--max-file-age", help="skip files that are older than the newest by more (default: 100 years)")

    for name in ("bronze", "silver", "gold"):
        stream = commands.add_parser(name, help=f"{name} streaming job")
        stream.add_argument("--max-file-age", help="skip files that are older than the newest by more (default: 100 years)")
        stream.add_argument("--input-path", required=True)
        stream.add_argument("--output-path", required=True)
        stream.add_argument("--checkpoint-location", required=True)
        stream.add_argument("--format", default="parquet", choices=("parquet", "delta"))
        stream.add_argument("--max-bytes-per-trigger", type=int)
        stream.add_argument("--once", action="store_true", help="process what is there, then stop")
        if name in ("bronze", "silver"):
            stream.add_argument("--schema", help="file with the layout of bronze, as JSON or a column list; kept once given")
        if name == "bronze":
            stream.add_argument("--archive-path", help="folder that files move to once their batch is committed")
        if name == "silver":
            stream.add_argument("--validation", default="off", choices=("off", "report", "fail"))
            stream.add_argument("--report-path", help="folder of the table that keeps the counts of each batch")
            stream.add_argument("--rebalance", action="store_true", help="shuffle for fewer, fuller files")
        if name == "gold":
            stream.add_argument("--input-path-weather", required=True)
            stream.add_argument("--mode", default="table", choices=jobs.GOLD_MODES)
            stream.add_argument("--time-zone", default=TIME_ZONE, help="zone whose calendar days are joined")
            stream.add_argument("--salts", type=int, help="shares of a day in the stream and bounded modes")
            stream.add_argument("--trip-delay", default="10 minutes", help="watermark of the bounded mode")
            stream.add_argument("--weather-delay", default="1 day", help="watermark of the bounded mode")
    return parser


def main(arguments: list[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    spark = get_session(args.job_name or f"fareloom-{args.job}")
    if args.job == "enrich":
        return jobs.run_enrich(
            spark, args.input_path, args.zones_path, args.output_path, args.mode, args.time_zone
        )
    given = {"maxBytesPerTrigger": args.max_bytes_per_trigger, "maxFileAge": args.max_file_age}
    source_options = {name: value for name, value in given.items() if value} or None
    if args.job == "catalog":
        jobs.run_catalog(
            spark,
            args.input_path,
            args.output_path,
            args.checkpoint_location,
            args.database,
            args.table,
            source_options=source_options,
        )
        return None
    options = {"fmt": args.format, "source_options": source_options}
    if args.job in ("bronze", "silver") and args.schema:
        options["schema"] = read_schema(spark, args.schema)
    if args.job == "bronze":
        if args.archive_path:
            options["source_options"] = {**(source_options or {}), **archived_to(args.archive_path)}
        options["trigger"] = ONCE_OVER_ALL_INPUT if args.once else None
        jobs.run_bronze(spark, args.input_path, args.output_path, args.checkpoint_location, **options)
        return None
    options["trigger"] = ONCE_OVER_ALL_INPUT if args.once else EVERY_100_SECONDS
    if args.job == "silver":
        options.update(validation=args.validation, rebalance=args.rebalance, report=args.report_path)
        jobs.run_silver(spark, args.input_path, args.output_path, args.checkpoint_location, **options)
        return None
    options.update(
        mode=args.mode,
        salts=args.salts,
        trip_delay=args.trip_delay,
        weather_delay=args.weather_delay,
        time_zone=args.time_zone,
    )
    jobs.run_gold(
        spark, args.input_path, args.input_path_weather, args.output_path, args.checkpoint_location, **options
    )
    return None


if __name__ == "__main__":
    main(sys.argv[1:])
