"""The layout of a table of raw trips, kept in versions beside its rows.

A table that may get wider keeps its layout in ``_schema``, one small file a version. Jobs that write or read the table agree on the
newest: without a layout of their own they take it, and a wider one becomes the next version. A layout that lacks a known column,
or has it in a type that does not hold all its values, is refused before anything is written.
"""

import json

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from fareloom.session import matching_paths, read_text, write_text

FOLDER = "_schema"
# Types that parquet files of the first one can be read as.
WIDER = {("integer", "long"), ("integer", "double"), ("float", "double")}


def published_schema(spark: SparkSession, table: str) -> StructType | None:
    """The newest layout of the table, or none if it keeps none."""
    versions = _versions(spark, table)
    return StructType.fromJson(json.loads(read_text(spark, versions[-1]))) if versions else None


def agreed_schema(spark: SparkSession, table: str, given: StructType | None, default: StructType) -> StructType:
    """The layout to read the table with: the given one if it holds the published one, else an error.

    Without a given layout it is the published one, or ``default`` if there is none.
    """
    known = published_schema(spark, table)
    if given is None or known is None:
        return given or known or default
    _refuse_narrower(table, known, given)
    return given


def publish_schema(spark: SparkSession, table: str, given: StructType | None, default: StructType) -> StructType:
    """The layout to write the table with, as ``agreed_schema``; kept as the next version if it is new."""
    agreed = agreed_schema(spark, table, given, default)
    if agreed != published_schema(spark, table):
        version = len(_versions(spark, table)) + 1
        write_text(spark, f"{table.rstrip('/')}/{FOLDER}/{version:06d}.json", agreed.json())
    return agreed


def read_schema(spark: SparkSession, path: str) -> StructType:
    """A layout from a file that has it as JSON or as the column list of a ``CREATE TABLE``."""
    text = read_text(spark, path)
    if text is None:
        raise ValueError(f"no schema file: {path}")
    return StructType.fromJson(json.loads(text)) if text.lstrip().startswith("{") else StructType.fromDDL(text)


def _versions(spark: SparkSession, table: str) -> list[str]:
    return matching_paths(spark, f"{table.rstrip('/')}/{FOLDER}/*.json")


def _refuse_narrower(table: str, known: StructType, given: StructType) -> None:
    types = {field.name: field.dataType for field in given}
    for field in known:
        if field.name not in types:
            raise ValueError(f"the schema lacks {field.name}, which {table} has")
        pair = (field.dataType.typeName(), types[field.name].typeName())
        if field.dataType != types[field.name] and pair not in WIDER:
            raise ValueError(f"{field.name} is {pair[0]} in {table} and cannot become {pair[1]}")
