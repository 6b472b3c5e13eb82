"""Every registered query against its SQL, and the plans of those that must not regress."""

import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import check
from msgflow.plans import catalogue
from msgflow.plans.stream_queries import __name__ as STREAMS

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = catalogue.QUERIES, catalogue.ORACLE
STREAMING = {n for n, q in QUERIES.items() if q.__module__ == STREAMS}
BATCH = [n for n in QUERIES if n not in STREAMING]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", BATCH + ["stream_single", "commit_after_success"])
def test_query_equals_its_sql(spark, tables, name):
    df = QUERIES[name](spark, SF)
    result = tables.execute(ORACLE[name])
    expected = check.rows_of([d[0] for d in result.description], result.fetchall())
    assert check.rows_of(df.columns, df.collect()) == expected


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["partition", "offset", "route", "attempt", "original_topic", "delay_ms", "retry_at", "dead_payload"]
    assert df.count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_joins_row_udfs_or_single_tasks(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "Exchange SinglePartition"):
        assert bad not in text, f"{bad} in {name}"


def test_no_window_over_a_whole_log_partition(spark):
    """Ordered operators sort segments; only their summaries are sorted per key."""
    for name in ("batch_by_count", "failure_runs", "tail_batch", "commit_high_water_per_batch"):
        text = plan(QUERIES[name](spark, SF))
        windows = re.findall(r"Window \[(row_number.*?)\n", text)
        assert windows and all("_segment" in w for w in windows), name


def test_native_path_reads_only_what_it_needs(spark):
    text = plan(QUERIES["apply_handler"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in text
    assert "Exchange" not in text and "ArrowEvalPython" not in text


def test_failures_are_filtered_in_the_scan(spark):
    text = plan(QUERIES["route_failures"](spark, SF))
    assert "EqualTo(event_type,error)" in text and "Exchange" not in text


def test_log_filters_reach_the_files(spark, make):
    from msgflow.session import run_dir
    from msgflow.sources.topics import read_log

    path = run_dir(spark, "log")
    make([{}] * 5).write.parquet(path)
    text = plan(read_log(spark, path).filter(F.col("offset") >= 3).select("partition", "offset"))
    assert "GreaterThanOrEqual(offset,3)" in text and "ReadSchema: struct<partition:int,offset:bigint>" in text


def test_payloads_stay_out_of_python_folds(spark):
    text = plan(QUERIES["circuit_breaker"](spark, SF))
    assert "payload" not in text and "props" not in text
