"""Queries against their SQL on DuckDB.  CHRONOLOOM_ALL=1 runs every one."""

import os
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check import TABLES, compare
from chronoloom.operators.index import index_by
from chronoloom.streaming.resample import index_by_stream

FOLDER = "/root/testdata/sf0.001"
QUICK = ["accuracy", "hilo", "fill_gaps", "filter_index", "index_by", "aggregate_key_mixed", "aggregate_functions", "anti_join", "right_join",
         "acf", "kpss", "ljung_box", "guerrero", "classical_decompose", "tslm", "glance", "ses", "croston", "bottom_up", "top_down",
         "bootstrap_forecast", "business_calendar_map", "row_number_index", "longest_flat_spot", "interpolate"]
NAMES = sorted(entry.oracle_sql()) if os.environ.get("CHRONOLOOM_ALL") else QUICK

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    verdict = compare(entry.queries()[name](spark, FOLDER).toPandas(), con.execute(entry.oracle_sql()[name]).df())
    assert verdict.startswith("ok"), verdict


def test_names_line_up():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_stream_equals_batch(spark):
    src = tempfile.mkdtemp(prefix="chronoloom-test-")
    events = spark.read.parquet(f"{FOLDER}/events.parquet").select("event_type", "ts", "value")
    events.repartition(3).write.mode("overwrite").parquet(src)
    aggs = [F.count("*").alias("n"), F.max("value").alias("top")]
    stream = index_by_stream(spark.readStream.schema(events.schema).parquet(src), ["event_type"], "ts", "day", aggs)
    q = stream.writeStream.format("memory").queryName("daily").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    batch = index_by(events, ["event_type"], "ts", "day", aggs).select("event_type", F.col("index").cast("timestamp_ntz").alias("index"), "n", "top")
    assert spark.table("daily").exceptAll(batch).count() == 0
    assert spark.table("daily").count() == batch.count()
