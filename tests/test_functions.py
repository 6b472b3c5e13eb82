import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from msgflow import RetryPolicy, to_messages
from msgflow.functions import backoff, headers as H, payload as P
from msgflow.operators import retry
from msgflow.sources.topics import read_dlq


def one(df, column):
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "text, attempt",
    [
        (None, 0), ("", 0), ("1", 1), ("3", 3), ("abc", 0), (" 5 ", 0), ("5\n", 0), ("+4", 4),
        ("-2", -2), ("5.0", 0), ("1e3", 0), ("99999999999999999999", 0), ("３", 0),
        ("9223372036854775807", 2**63 - 1),
    ],
)
def test_attempt_header(make, text, attempt):
    df = make([{"headers": {} if text is None else {"mq.retry.attempt": text}}])
    assert one(df, H.retry_attempt(F.col("headers"))) == attempt


@pytest.mark.parametrize("text, step", [("2", 2), ("x", 0), ("3000000000", 0), ("-1", -1)])
def test_step_header(make, text, step):
    df = make([{"headers": {"mq.retry.step": text}}])
    assert one(df, H.retry_step(F.col("headers"))) == step


@pytest.mark.parametrize(
    "text, moment",
    [
        ("2024-01-15T10:30:00Z", dt.datetime(2024, 1, 15, 10, 30)),
        ("2024-01-15T10:30:00+02:00", dt.datetime(2024, 1, 15, 8, 30)),
        ("2024-01-15T10:30:00.250Z", dt.datetime(2024, 1, 15, 10, 30, 0, 250000)),
        ("2024-01-15", None), ("2024-13-15T10:30:00Z", None), ("soon", None), ("", None),
        ("2024-01-15T10:30:00", None), ("2024-01-15T10:30:00Z\n", None),
    ],
)
def test_retry_time_header(make, text, moment):
    df = make([{"headers": {"mq.retry.time": text}}])
    text_of = F.date_format(H.retry_time(F.col("headers")), "yyyy-MM-dd HH:mm:ss.SSS")
    expected = moment and moment.strftime("%Y-%m-%d %H:%M:%S.%f")[:-3]
    assert one(df, text_of) == expected


def test_null_headers_read_as_absent(make):
    df = make([{"headers": None}])
    row = df.select(
        H.retry_attempt(F.col("headers")).alias("a"), H.retry_time(F.col("headers")).alias("t"),
        H.original_topic(F.col("headers"), F.col("topic")).alias("o"),
        H.strip_reserved(F.col("headers")).alias("s"),
    ).first()
    assert (row.a, row.t, row.o, row.s) == (0, None, "orders", {})


def built(make, row, policy=RetryPolicy("orders.retry", "orders.dlq"), error="boom"):
    df = make([row]).withColumn("error", F.lit(error))
    return retry.retry(df, policy)


def test_retry_headers_keep_application_headers(make):
    hop = {"partition": 3, "offset": 12345, "headers": {"trace": "t1", "mq.retry.attempt": "1", "mq.other": "kept"}}
    row = built(make, hop)[0].first()
    assert row.topic == "orders.retry" and row.key is None and bytes(row.value) == b"p0"
    assert row.headers == {
        "trace": "t1", "mq.other": "kept", "mq.retry.attempt": "2",
        "mq.retry.time": "2024-01-01T00:00:02Z", "mq.retry.step": "0",
        "mq.error.code": "HANDLER_ERROR", "mq.error.message": "boom",
        "mq.original.topic": "orders", "mq.original.partition": "3",
        "mq.original.offset": "12345", "mq.failed.at": "2024-01-01T00:00:00Z",
    }


def test_original_topic_survives_hops(make):
    row = built(make, {"topic": "orders.retry", "headers": {"mq.original.topic": "orders"}})[0].first()
    assert row.headers["mq.original.topic"] == "orders"
    empty = built(make, {"topic": "orders.retry", "headers": {"mq.original.topic": ""}})[0].first()
    assert empty.headers["mq.original.topic"] == "orders.retry"


def test_origin_first_keeps_source_position(make):
    headers = {"mq.original.partition": "7", "mq.original.offset": "70"}
    last = built(make, {"headers": headers})[0].first().headers
    assert (last["mq.original.partition"], last["mq.original.offset"]) == ("0", "0")
    policy = RetryPolicy("r", "d", origin="first")
    first = built(make, {"headers": headers}, policy)[0].first().headers
    assert (first["mq.original.partition"], first["mq.original.offset"]) == ("7", "70")


def test_first_failure_is_retried_and_third_is_dead(make):
    retries, dead = built(make, {})
    assert retries.first().headers["mq.retry.attempt"] == "1" and dead.count() == 0
    retries, dead = built(make, {"headers": {"mq.retry.attempt": "2"}})
    assert retries.count() == 0
    row = dead.first()
    envelope = json.loads(bytes(row.value))
    assert row.topic == "orders.dlq" and envelope["attemptCount"] == 3
    assert envelope["originalTopic"] == "orders"
    assert "mq.retry.time" not in row.headers and "mq.retry.step" not in row.headers
    assert len(row.headers) == 7


def test_largest_attempt_does_not_overflow(make):
    retries, dead = built(make, {"headers": {"mq.retry.attempt": str(2**63 - 1)}})
    assert retries.count() == 0 and json.loads(bytes(dead.first().value))["attemptCount"] == 2**63 - 1


def test_envelope_json(make):
    policy = RetryPolicy("r", "d", max_attempts=1)
    body = b'{"orderId":"ABC"}'
    value = built(make, {"partition": 2, "offset": 999, "payload": body}, policy)[1].first().value
    assert list(json.loads(bytes(value))) == [
        "attemptCount", "error", "originalOffset", "originalPartition", "originalTopic", "payload",
        "payloadEncoding", "timestamp",
    ]
    assert json.loads(bytes(value)) == {
        "attemptCount": 1, "error": "boom", "originalOffset": 999, "originalPartition": 2,
        "originalTopic": "orders", "payload": '{"orderId":"ABC"}', "payloadEncoding": "json",
        "timestamp": "2024-01-01T00:00:00Z",
    }


@pytest.mark.parametrize("body, text", [(b"\x00\xff\xfe", "AP/+"), (b"", ""), (None, "")])
def test_envelope_base64(make, body, text):
    policy = RetryPolicy("r", "d", max_attempts=1, payload_encoding="base64")
    envelope = json.loads(bytes(built(make, {"payload": body}, policy)[1].first().value))
    assert (envelope["payload"], envelope["payloadEncoding"]) == (text, "base64")


def test_long_base64_is_one_line(make):
    text = one(make([{"payload": bytes(range(100))}]), P.encode_payload(F.col("payload"), "base64"))
    assert len(text) == 136 and "\n" not in text and "\r" not in text


@pytest.mark.parametrize("encoding", ["json", "base64"])
def test_envelope_round_trip(make, encoding):
    policy = RetryPolicy("r", "d", max_attempts=1, payload_encoding=encoding)
    body = 'Grüße <&> "quoted" \\   \n end'.encode()
    rows = read_dlq(built(make, {"payload": body}, policy)[1])
    assert bytes(rows.first().payload) == body


@pytest.mark.parametrize(
    "kwargs, attempt, delay",
    [
        ({}, 1, 1000), ({}, 2, 2000), ({}, 3, 4000), ({}, 6, 30000), ({}, 5000, 30000),
        ({"multiplier": 10.0, "max_delay_ms": 5000}, 6, 5000), ({"multiplier": 1.0}, 9, 1000),
        ({"backoff": lambda a: a * 10_000}, 1, 10_000), ({"backoff": lambda a: a * 10_000}, 20, 200_000),
    ],
)
def test_backoff(spark, kwargs, attempt, delay):
    df = spark.range(1).select(F.lit(attempt).cast("bigint").alias("a"))
    assert one(df, backoff.backoff_delay(F.col("a"), RetryPolicy("r", "d", **kwargs))) == delay


def test_repeated_header_keys_keep_the_last_value(spark):
    df = spark.sql(
        """SELECT 't' AS topic, 1 AS partition, 5L AS offset, TIMESTAMP '2024-01-01' AS timestamp,
        from_json('[{"key":"a","value":"MQ=="},{"key":"b","value":"eA=="},{"key":"a","value":"Mg=="},
          {"key":"a","value":"Mw=="}]', 'array<struct<key:string,value:binary>>') AS headers,
        binary('body') AS value"""
    )
    row = to_messages(df).first()
    assert row.headers == {"a": "3", "b": "x"} and bytes(row.payload) == b"body"
    assert to_messages(df.withColumn("headers", F.lit(None).cast(df.schema["headers"].dataType))).first().headers == {}


def test_error_code(make):
    df = make([{"error": None, "code": None}, {"error": "x", "code": None}, {"error": "x", "code": "TIMEOUT"}],
              "error string, code string")
    codes = [r.c for r in df.select(H.error_code(F.col("error"), F.col("code")).alias("c")).collect()]
    assert codes == ["", "HANDLER_ERROR", "TIMEOUT"]
