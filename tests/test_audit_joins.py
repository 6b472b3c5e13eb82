import pytest
from pyspark.sql import functions as F

from msgflow.operators import audit, offsets
from msgflow.operators.joins import checked_join, salted_join
from msgflow.sources.topics import bounded_read


def test_tally(make):
    rows = [{"ok": o} for o in (True, False, True, True)]
    r = audit.outcome_summary(make(rows, "ok boolean")).first()
    assert (r.succeeded, r.failed, r.total) == (3, 1, 4)


def test_delivery_audit(make):
    produced = make([{"partition": i % 3, "offset": i // 3} for i in range(50)])
    lost = (F.col("partition") == 1) & (F.col("offset") == 4)
    received = produced.filter(~lost)
    received = received.unionByName(received.filter("partition = 0 AND offset < 2"))
    missing = audit.missing_messages(produced, received).collect()
    assert [(r.partition, r.offset) for r in missing] == [(1, 4)]
    twice = audit.duplicate_deliveries(received).orderBy("offset").collect()
    assert [(r.partition, r.offset, r.deliveries) for r in twice] == [(0, 0, 2), (0, 1, 2)]
    assert audit.missing_messages(produced, produced).count() == 0


@pytest.mark.parametrize("broadcast_rows", [0, 1000])
def test_resume(make, spark, broadcast_rows):
    log = make([{"partition": p, "offset": o} for p in range(3) for o in range(4)])
    commits = spark.createDataFrame(
        [("orders", 0, 2), ("orders", 0, 3), ("orders", 1, 4)], "topic string, partition int, next_offset long"
    )
    out = offsets.resume_from(log, commits, broadcast_rows=broadcast_rows)
    got = sorted((r.partition, r.offset) for r in out.collect())
    assert got == [(0, 3), (2, 0), (2, 1), (2, 2), (2, 3)]


def test_resume_latest(make, spark):
    log = make([{"partition": p, "offset": o} for p in range(2) for o in range(4)])
    commits = spark.createDataFrame([("orders", 0, 1)], "topic string, partition int, next_offset long")
    known = offsets.commit_positions(log.filter("offset < 2"))
    out = offsets.resume_from(log, commits, start="latest", known=known)
    assert sorted((r.partition, r.offset) for r in out.collect()) == [
        (0, 1), (0, 2), (0, 3), (1, 2), (1, 3),
    ]


def test_start_at_latest_reads_later_messages_only(make):
    before = make([{"offset": i} for i in range(3)])
    log = before.unionByName(make([{"offset": i} for i in range(3, 5)])).unionByName(
        make([{"partition": 9, "offset": 0}])
    )
    known = offsets.commit_positions(before)
    got = offsets.start_position(log, "latest", known).collect()
    assert sorted((r.partition, r.offset) for r in got) == [(0, 3), (0, 4), (9, 0)]
    assert offsets.start_position(log).count() == 6
    with pytest.raises(ValueError):
        offsets.start_position(log, "middle")


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (2, 0)], {(0, 3), (1, 2), (2, 1)}),
        ([(0, 5), (0, 10), (1, 3), (1, 7)], {(0, 11), (1, 8)}),
    ],
)
def test_commit_positions(make, rows, expected):
    out = offsets.commit_positions(make([{"partition": p, "offset": o} for p, o in rows]))
    assert {(r.partition, r.next_offset) for r in out.collect()} == expected


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_a_join(spark, how):
    # One key has most rows, many of them exact copies.
    big = spark.range(600).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 7).alias("k"), (F.col("id") % 5).alias("v")
    )
    unique = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (9, "d")], "k long, w string")
    plain = sorted(map(tuple, big.join(unique, ["k"], how).collect()), key=repr)
    salted = salted_join(big, unique, ["k"], how, hot_rows=50, salts=8)
    assert sorted(map(tuple, salted.select(*big.join(unique, ["k"], how).columns).collect()), key=repr) == plain


def test_salted_join_spreads_the_hot_key(spark):
    big = spark.range(0, 4000, 1, 8).select(F.lit(1).alias("k"), F.lit("copy").alias("v"))
    unique = spark.createDataFrame([(1, "a")], "k int, w string")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = salted_join(big, unique, ["k"], "inner", hot_rows=100, salts=16)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 4000 and max(sizes) < 3000 and len(sizes) > 2


def test_checked_join_falls_back_beyond_its_bound(make):
    df = make([{"partition": i % 5, "offset": i} for i in range(40)])
    small = df.groupBy("topic", "partition").agg(F.max("offset").alias("top"))
    near = checked_join(df, small, ["topic", "partition"])
    far = checked_join(df, small, ["topic", "partition"], broadcast_rows=2, hot_rows=5)
    assert "BroadcastHashJoin" in near._jdf.queryExecution().executedPlan().toString()
    columns = ["partition", "offset", "top"]
    assert sorted(near.select(*columns).collect()) == sorted(far.select(*columns).collect())


def test_lineage_with_a_hot_message(make, spark):
    source = make([{"offset": i} for i in range(5)])
    headers = [
        {"mq.original.topic": "orders", "mq.original.partition": "0", "mq.original.offset": str(o)}
        for o in [2] * 50 + [4, 99]
    ]
    failed = make([{"topic": "orders.retry", "offset": i, "headers": h} for i, h in enumerate(headers)])
    broken = make([{"headers": {"mq.original.topic": "orders", "mq.original.offset": "x"}}])
    out = audit.failure_lineage(failed.unionByName(broken), source, hot_rows=10).collect()
    assert sorted(r.source_offset for r in out) == [2] * 50 + [4]
    assert all(bytes(r.source_payload) == b"p%d" % r.source_offset for r in out)


def test_bounded_read(make):
    df = make([{"partition": p, "offset": o} for p in (1, 0) for o in range(5)]).repartition(4)
    assert [(r.partition, r.offset) for r in bounded_read(df, 7).collect()] == [
        (0, 0), (0, 1), (0, 2), (0, 3), (0, 4), (1, 0), (1, 1),
    ]
    with pytest.raises(ValueError):
        bounded_read(df, 0)


def test_hot_keys_come_from_a_sample(spark, monkeypatch):
    """A few rows of each key are counted; a key far over the bound is always found."""
    from msgflow.operators import joins

    monkeypatch.setattr(joins, "SAMPLED", 100)
    big = spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert [r.k for r in joins.hot_keys(big, ["k"], 10_000).collect()] == [-1]
    unique = spark.createDataFrame([(-1, "a"), (1, "b"), (2, "c")], "k long, w string")
    for few in (10, 0):  # the hot keys as rows of the driver, and as a table
        monkeypatch.setattr(joins, "FEW_KEYS", few)
        out = salted_join(big, unique, ["k"], "left", hot_rows=10_000, salts=8)
        assert out.count() == 60_000 and out.filter("w = 'a'").count() == 30_000 and out.filter("w = 'b'").count() == 1
