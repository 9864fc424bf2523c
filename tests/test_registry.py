"""Every registered query against its SQL in DuckDB, on the given tables."""

import math
from pathlib import Path

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from fareloom.plans import fixtures, registry
from fareloom.plans.oracles import ORACLES
from fareloom.plans.registry import QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not there")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _plain(value):
    if pd.isna(value):
        return None
    if isinstance(value, bool):
        return value
    if hasattr(value, "year"):
        return str(pd.Timestamp(value))
    if hasattr(value, "__float__") and not isinstance(value, str):
        assert not math.isinf(float(value))
        return float(value)
    return str(value)


def _multiset(df):
    columns = sorted(df.columns)
    rows = df[columns].astype(object).itertuples(index=False, name=None)
    return columns, sorted((tuple(map(_plain, row)) for row in rows), key=repr)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= contract.queries().items() and ORACLES.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, oracle, name):
    ours = QUERIES[name](spark, str(DATA)).toPandas()
    theirs = oracle.execute(ORACLES[name]).df()
    assert _multiset(ours) == _multiset(theirs)
    assert len(ours) > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_batches_of_staged_files_do_not_grow(spark):
    assert [fixtures.files_a_batch(files, 8) for files in (0, 1, 8, 9, 166)] == [1, 1, 1, 2, 21]


def test_staged_files_have_a_bounded_number_of_rows(spark, monkeypatch):
    """Files, and with them what a task reads and writes, stay as large as they are while the table grows."""
    monkeypatch.setattr(fixtures, "SMALLEST_FILE", 100)
    monkeypatch.setattr(fixtures, "LARGEST_FILE", 200)
    folder = fixtures.staged_trips.__wrapped__(spark, str(DATA))
    sizes = [r["count"] for r in spark.read.parquet(folder).groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) <= 200
    written = {}
    run = registry.run_bronze
    monkeypatch.setattr(registry, "run_bronze", lambda *a, **o: written.update(files=o["source_options"]["maxFilesPerTrigger"]) or run(*a, **o))
    assert registry.stream_bronze_batches(spark, str(DATA)).count() == sum(sizes)
    assert written["files"] == -(-sum(sizes) // (2 * registry.BATCHES * 200))


def test_bounded_late_writes_its_trips_once(spark, tmp_path, monkeypatch):
    """Its two batches are made from the tables: no table staged for other queries is written first and then again."""
    trip = lambda day, number, price=10.0: (None if day is None else pd.Timestamp(day), number, price)
    rows = [
        *(trip(f"1996-0{1 + n % 9}-0{1 + n % 7}", 1 + n % 7, float(n)) for n in range(20)),
        *[trip("1998-05-20", 3)] * 2,
        trip("1998-05-21", None),
        trip("1995-03-02", 2),
        *[trip("1995-11-02", 7)] * 3,
        trip("1992-01-03", 1),
        trip(None, 4),
    ]
    items = pd.DataFrame(rows, columns=["l_shipdate", "l_linenumber", "l_extendedprice"])
    items = items.astype({"l_shipdate": "datetime64[us]", "l_linenumber": "Int32"}).assign(
        l_orderkey=range(len(rows)), l_partkey=5, l_suppkey=[k % 30 for k in range(len(rows))], l_quantity=6.0,
        l_discount=0.1, l_tax=0.1, l_returnflag="R", l_linestatus="O",
    )
    days = pd.to_datetime(["1992-01-03", "1995-11-02", "1996-01-01", "1996-03-03", "1998-05-20"]).as_unit("us")
    weather = pd.DataFrame({"o_orderdate": days, "o_totalprice": 100.0, "o_orderstatus": "F"})
    nation = pd.DataFrame({"n_nationkey": range(25), "n_name": "N", "n_regionkey": 1}).astype({"n_nationkey": "int32"})
    connection = duckdb.connect()
    for name, table in {"lineitem": items, "orders": weather, "nation": nation}.items():
        connection.register("made", table)
        connection.execute(f"COPY (SELECT * FROM made) TO '{tmp_path}/{name}.parquet'")
        connection.unregister("made")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")

    def staged(*_):
        raise AssertionError("a table staged for other queries")

    for name in ("staged_trips", "staged_bronze", "staged_silver"):
        monkeypatch.setattr(fixtures, name, staged)
    ours = QUERIES["stream_gold_bounded_late"](spark, str(tmp_path)).toPandas()
    theirs = connection.execute(ORACLES["stream_gold_bounded_late"]).df()
    assert _multiset(ours) == _multiset(theirs)
    of_second = ours.set_index("batch_id").loc[1]
    assert (of_second["arrived"], of_second["candidates"], of_second["late"]) == (5, 4, 1)
