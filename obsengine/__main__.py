"""Pipeline stages as commands, for ``spark-submit`` or ``python -m obsengine``."""

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from obsengine import schemas
from obsengine.plans import descriptive, etl, ml, publish
from obsengine.session import build_session
from obsengine.sources import catalog, jdbc, profiles, readers, writers

# Input of the enrichment -> its schema and its usual table name.
DIMENSIONS = {
    "cities": (schemas.CITIES, "cities"),
    "stations": (schemas.STATIONS, "stations"),
    "alerts": (schemas.ALERTS, "weather_alerts"),
}


def _dimension(spark: SparkSession, name: str, args: argparse.Namespace) -> DataFrame:
    schema, table = DIMENSIONS[name]
    if args.exports and not args.stamp:
        raise SystemExit("--exports needs the --stamp of one snapshot")
    if args.jdbc_url:
        return jdbc.read_jdbc(spark, args.jdbc_url, table, jdbc.connection_properties())
    return writers.read_snapshot(spark, args.exports, table, args.stamp, schema)


def run_etl(spark: SparkSession, args: argparse.Namespace) -> dict:
    observations = readers.read_observations(
        spark, args.observations, multi_line=not args.lines
    )
    if args.latest:
        observations = readers.latest_observations(observations)
    dimensions = (_dimension(spark, name, args) for name in DIMENSIONS)
    if args.merge:
        report = etl.merge_etl(observations, *dimensions, args.output)
    else:
        report = etl.run_etl(observations, *dimensions, args.output)
    if args.quarantine:
        bad = readers.quarantined_observations(spark, args.observations, multi_line=not args.lines)
        report["quarantined_records"] = writers.write_quarantine(bad, args.quarantine)
    return report


def run_ingest(spark: SparkSession, args: argparse.Namespace) -> dict:
    payloads = readers.read_payloads(spark, args.payloads, multi_line=not args.lines)
    rows = readers.unpivot_daily_payload(payloads)
    path = writers.land_batch(rows, args.output, args.stamp)
    return {"status": "success", "batch": path}


def run_snapshot(spark: SparkSession, args: argparse.Namespace) -> dict:
    tables = {name: spark.table(name) for name in args.tables}
    done = writers.snapshot_tables(spark, tables, args.output, args.stamp).collect()
    return {"status": "success", "tables": {row.table: row.records_count for row in done}}


def run_descriptive(spark: SparkSession, args: argparse.Namespace) -> dict:
    df = readers.read_non_empty(spark, args.input)
    tables = descriptive.descriptive_run(
        df, args.output, city=args.city, temperature=args.temperature
    )
    return descriptive.manifest(tables, args.output)._asdict()


def run_ml(spark: SparkSession, args: argparse.Namespace) -> dict:
    tables = ml.ml_run(readers.read_trusted(spark, args.input), args.seed, args.output)
    return {"status": "success", "tables": list(tables), "output_location": args.output}


def run_publish(spark: SparkSession, args: argparse.Namespace) -> dict:
    predictions = spark.read.parquet(args.predictions) if args.predictions else None
    trusted = readers.read_trusted(spark, args.input)
    names = publish.publish_results(
        spark, trusted, args.database, args.output, predictions, city=args.city
    )
    if args.drop_old:
        for name in names[:-1]:  # the last one is a view
            catalog.drop_versions(spark, args.database, name)
    left_out = publish.left_out_records(trusted, args.city)
    return {"status": "success", "tables": names, "left_out_records": left_out}


def run_profile(spark: SparkSession, args: argparse.Namespace) -> dict:
    rows = readers.read_non_empty(spark, args.input)
    profiles.add_to_profile(rows, args.output, args.stamp, city=args.city, temperature=args.temperature)
    return {"status": "success", "months": profiles.read_profile(spark, args.output).count()}


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="obsengine", description=__doc__)
    stages = root.add_subparsers(required=True, metavar="stage")

    def stage(name: str, action, text: str) -> argparse.ArgumentParser:
        command = stages.add_parser(name, help=text)
        command.set_defaults(action=action)
        command.add_argument("--output", required=True, help="folder to write")
        return command

    command = stage("ingest", run_ingest, "landed payloads to a raw batch")
    command.add_argument("--payloads", required=True, help="JSON payload files")
    command.add_argument("--lines", action="store_true", help="one JSON object per line")
    command.add_argument("--stamp", required=True, help="name of the batch")

    command = stage("snapshot", run_snapshot, "catalog tables to CSV snapshots")
    command.add_argument("--tables", required=True, nargs="+")
    command.add_argument("--stamp", required=True, help="name of the snapshot")

    command = stage("etl", run_etl, "raw inputs to trusted rows")
    command.add_argument("--observations", required=True, help="raw JSON files")
    command.add_argument("--lines", action="store_true", help="one JSON object per line")
    command.add_argument("--latest", action="store_true", help="keep the latest of repeated days")
    command.add_argument("--merge", action="store_true", help="replace only the places and days that were read")
    command.add_argument("--quarantine", help="folder for the records that can't be read")
    source = command.add_mutually_exclusive_group(required=True)
    source.add_argument("--jdbc-url", help="database; credentials from OBSENGINE_DB_* variables")
    source.add_argument("--exports", help="folder of CSV snapshots; needs --stamp")
    command.add_argument("--stamp", help="the snapshot to read, as in cities_<stamp>")

    command = stage("descriptive", run_descriptive, "descriptive tables and report")
    command.add_argument("--input", required=True)
    command.add_argument("--city", default="city_name")
    command.add_argument("--temperature", default="temp_avg")

    command = stage("profile", run_profile, "a batch of rows added to the stored monthly profile")
    command.add_argument("--input", required=True)
    command.add_argument("--stamp", required=True, help="name of the batch")
    command.add_argument("--city", default="city_name")
    command.add_argument("--temperature", default="temp_avg")

    command = stage("ml", run_ml, "models and their summary")
    command.add_argument("--input", required=True)
    command.add_argument("--seed", type=int, required=True)

    command = stage("publish", run_publish, "result tables in the catalog")
    command.add_argument("--input", required=True)
    command.add_argument("--database", required=True)
    command.add_argument("--city", default="city_name")
    command.add_argument("--predictions", help="scored rows of the temperature model")
    command.add_argument("--drop-old", action="store_true", help="delete the versions published before")
    return root


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    print(json.dumps(args.action(build_session("obsengine"), args)))


if __name__ == "__main__":
    main()
