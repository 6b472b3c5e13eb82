"""Queries over the event log: one per operator, each with its SQL equivalent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from msgflow.config import BatchPolicy, BreakerPolicy, RetryPolicy
from msgflow.functions import backoff, headers as H, payload as P
from msgflow.operators import audit, batching, breaker, offsets, retry, strategies
from msgflow.operators.handler import (
    HandlerFailure,
    Message,
    PayloadHandler,
    apply_batch_handler,
    apply_handler,
    capture_panic,
    column_handler,
    panics_of,
    split_outcomes,
    spread,
)
from msgflow.operators.segments import pick_span
from msgflow.plans.event_log import document_log, event_log, event_messages, redelivered, table
from msgflow.plans.registry import (
    BATCHES_SQL,
    BREAKER_SQL,
    LOG_SQL,
    NUMBERED_SQL,
    ROUTED_SQL,
    long_cooldown_sql,
    query,
    redelivered_sql,
)
from msgflow.schema import IDENTITY
from msgflow.session import materialize
from msgflow.sources.topics import bounded_read, read_dlq, to_messages

POLICY = RetryPolicy("events.retry", "events.dlq")
BATCH = BatchPolicy(size=5, timeout_ms=20 * 60 * 1000)
BREAKER = BreakerPolicy(threshold=2, cooldown_ms=30 * 60 * 1000, half_open_attempts=2)
BREAKER_RETRY = BreakerPolicy(2, 30 * 60 * 1000, 2, retry=POLICY)
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
SPLIT_TIME = "2024-01-15 00:00:00"


def time_text(column: str) -> Column:
    return F.date_format(column, TIME_FORMAT)


def bad_event() -> Column:
    return F.concat(F.lit("bad event "), F.col("offset").cast("string"))


def native_handler():
    """Fails events of type ``error``."""
    return column_handler(F.col("event_type") == "error", bad_event())


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_handler(event_log(spark, sf_dir), native_handler())


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes(spark, sf_dir).filter(~F.col("ok"))


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retry.route_failures(failures(spark, sf_dir), POLICY)


def delivered(log: DataFrame) -> DataFrame:
    """What a group received: every 97th message lost, every 10th delivered twice."""
    kept = log.filter(F.col("offset") % 97 != 0)
    copies = F.when(F.col("offset") % 10 == 0, F.sequence(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    return kept.withColumn("copy", F.explode(copies))


PART_OFF = 'part AS "partition", off AS "offset"'


# -- scans, sources, sinks -------------------------------------------------------


@query(
    "topic_scan",
    f"""WITH {LOG_SQL} SELECT topic, {PART_OFF}, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
    1 + (h_attempt IS NOT NULL)::INT + 2 * (h_topic IS NOT NULL)::INT AS headers,
    CAST(octet_length(payload) AS INTEGER) AS payload_bytes FROM log""",
)
def topic_scan(spark, sf_dir):
    log = to_messages(event_log(spark, sf_dir))
    return log.select(
        "topic", "partition", "offset", time_text("timestamp").alias("ts"),
        F.size("headers").alias("headers"), F.octet_length("payload").alias("payload_bytes"),
    )


@query(
    "normalize_message",
    f"""WITH {LOG_SQL} SELECT {PART_OFF}, 2 AS headers, event_type AS event_type_header,
    CAST(off AS VARCHAR) AS trace_header, hex(payload) AS payload_hex FROM log""",
)
def normalize_message(spark, sf_dir):
    def entry(key: str, value: Column) -> Column:
        return F.struct(F.lit(key).alias("key"), F.encode(value, "UTF-8").alias("value"))

    # The connector's layout: header array with a repeated key, payload as `value`.
    raw = event_log(spark, sf_dir).withColumn(
        "headers",
        F.array(
            entry("event-type", F.lit("stale")),
            entry("trace", F.col("offset").cast("string")),
            entry("event-type", F.col("event_type")),
        ),
    ).withColumnRenamed("payload", "value_bytes").drop("value").withColumnRenamed("value_bytes", "value")
    return to_messages(raw).select(
        "partition", "offset", F.size("headers").alias("headers"),
        F.col("headers")["event-type"].alias("event_type_header"),
        F.col("headers")["trace"].alias("trace_header"),
        F.hex("payload").alias("payload_hex"),
    )


@query(
    "start_position",
    f"""WITH {LOG_SQL}, ends AS (
      SELECT part, max(off) + 1 AS e FROM log WHERE ts < TIMESTAMP '{SPLIT_TIME}' GROUP BY part)
    SELECT log.part AS "partition", off AS "offset" FROM log LEFT JOIN ends ON ends.part = log.part
    WHERE e IS NULL OR off >= e""",
)
def start_position(spark, sf_dir):
    log = event_log(spark, sf_dir)
    at_start = log.filter(F.col("timestamp") < F.lit(SPLIT_TIME).cast("timestamp"))
    known = offsets.commit_positions(at_start)
    return offsets.start_position(log, "latest", known).select("partition", "offset")


@query(
    "retry_sink",
    f"""WITH {ROUTED_SQL} SELECT 'events.retry' AS topic, true AS key_is_null,
    hex(payload) AS value_hex, event_type AS event_type_header,
    CAST(attempt AS VARCHAR) AS attempt_header, orig_topic AS original_topic,
    CAST(off AS VARCHAR) AS original_offset FROM routed WHERE route = 'retry'""",
)
def retry_sink(spark, sf_dir):
    rows, _ = retry.retry(failures(spark, sf_dir), POLICY)
    h = F.col("headers")
    return rows.select(
        "topic", F.col("key").isNull().alias("key_is_null"), F.hex("value").alias("value_hex"),
        h["event-type"].alias("event_type_header"),
        H.header(h, H.RETRY_ATTEMPT).alias("attempt_header"),
        H.header(h, H.ORIGINAL_TOPIC).alias("original_topic"),
        H.header(h, H.ORIGINAL_OFFSET).alias("original_offset"),
    )


ENVELOPE_SQL = """
  attempt AS attempt_count, error, off AS original_offset, part AS original_partition,
  orig_topic AS original_topic, 'base64' AS payload_encoding,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS failed_at"""


@query(
    "dlq_sink",
    f"""WITH {ROUTED_SQL} SELECT 'events.dlq' AS topic, true AS key_is_null,
    CAST(attempt AS BIGINT) AS attempt_count, error, off AS original_offset,
    part AS original_partition, orig_topic AS original_topic,
    CASE WHEN off % 50 = 0 THEN '00EFBFBDEFBFBD' ELSE hex(payload) END AS payload_text_hex,
    'json' AS payload_encoding, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS failed_at,
    7 + 1 AS header_count
    FROM routed WHERE route = 'dlq'""",
)
def dlq_sink(spark, sf_dir):
    _, rows = retry.retry(failures(spark, sf_dir), POLICY)
    e = F.col("e")
    return rows.withColumn("e", P.parse_envelope(F.col("value"))).select(
        "topic", F.col("key").isNull().alias("key_is_null"),
        e["attemptCount"].alias("attempt_count"), e["error"].alias("error"),
        e["originalOffset"].alias("original_offset"),
        e["originalPartition"].alias("original_partition"),
        e["originalTopic"].alias("original_topic"),
        F.hex(F.encode(e["payload"], "UTF-8")).alias("payload_text_hex"),
        e["payloadEncoding"].alias("payload_encoding"), e["timestamp"].alias("failed_at"),
        F.size("headers").alias("header_count"),
    )


@query(
    "bounded_read",
    f"""WITH {LOG_SQL} SELECT {PART_OFF}, event_type FROM log ORDER BY topic, part, off LIMIT 50""",
)
def bounded(spark, sf_dir):
    return bounded_read(event_log(spark, sf_dir), 50).select("partition", "offset", "event_type")


@query(
    "dlq_read",
    f"""WITH {ROUTED_SQL} SELECT CAST(attempt AS BIGINT) AS attempt_count, error,
    off AS original_offset, part AS original_partition, orig_topic AS original_topic,
    'base64' AS payload_encoding, strftime(ts, '%Y-%m-%d %H:%M:%S') AS failed_at,
    hex(payload) AS payload_hex FROM routed WHERE route = 'dlq'""",
)
def dlq_read(spark, sf_dir):
    policy = RetryPolicy("events.retry", "events.dlq", payload_encoding="base64")
    _, rows = retry.retry(failures(spark, sf_dir), policy)
    return read_dlq(rows.select("value")).select(
        "attempt_count", "error", "original_offset", "original_partition", "original_topic",
        "payload_encoding", time_text("failed_at").alias("failed_at"),
        F.hex("payload").alias("payload_hex"),
    )


# -- projections and filters ---------------------------------------------------------


@query("apply_handler", f"WITH {LOG_SQL} SELECT {PART_OFF}, ok, error FROM log")
def apply_handler_query(spark, sf_dir):
    return outcomes(spark, sf_dir).select("partition", "offset", "ok", "error")


PANIC_SQL = """CASE WHEN event_type = 'signup' AND value > 100
    THEN 'handler panic: cannot sign up ' || off ELSE error END"""


@query(
    "capture_panic",
    f"""WITH {LOG_SQL} SELECT {PART_OFF}, {PANIC_SQL} IS NULL AS ok, {PANIC_SQL} AS error FROM log""",
)
def capture_panic_query(spark, sf_dir):
    panics = (F.col("event_type") == "signup") & (F.col("value") > 100)
    text = F.concat(F.lit("cannot sign up "), F.col("offset").cast("string"))
    return capture_panic(outcomes(spark, sf_dir), panics, text).select(
        "partition", "offset", "ok", "error"
    )


@query(
    "capture_panic_raised",
    f"""WITH {LOG_SQL} SELECT {PART_OFF}, ok AND off % 5 <> 0 AS ok,
    CASE WHEN off % 5 = 0 THEN 'handler panic: division by zero at ' || off ELSE error END AS error FROM log""",
)
def capture_panic_raised(spark, sf_dir):
    """A division that raises in every fifth row, each caught as that row's panic."""
    step = F.col("offset") % 5
    panics = panics_of(F.try_divide(F.col("value"), step), F.col("value"))
    text = F.concat(F.lit("division by zero at "), F.col("offset").cast("string"))
    return capture_panic(outcomes(spark, sf_dir), panics, text).select("partition", "offset", "ok", "error")


def _describe(message: Message):
    """Python handler that fails every message with what it knows about it."""
    seconds = message.timestamp.strftime("%Y-%m-%d %H:%M:%S")
    return (
        f"{message.topic}[{message.partition}]@{message.offset} {seconds} "
        f"{message.headers['event-type']} {message.headers.get('mq.original.topic')}"
    )


@query(
    "message_metadata",
    f"""WITH {LOG_SQL} SELECT {PART_OFF}, false AS ok,
    topic || '[' || part || ']@' || off || ' ' || strftime(ts, '%Y-%m-%d %H:%M:%S') || ' '
    || event_type || ' ' || coalesce(h_topic, 'None') AS error FROM log""",
)
def message_metadata(spark, sf_dir):
    return apply_handler(spread(event_log(spark, sf_dir)), _describe).select(
        "partition", "offset", "ok", "error"
    )


@query(
    "split_outcomes",
    f"""WITH {LOG_SQL} SELECT {PART_OFF}, CASE WHEN ok THEN 'succeeded' ELSE 'failed' END AS side,
    error FROM log""",
)
def split_outcomes_query(spark, sf_dir):
    good, bad = split_outcomes(outcomes(spark, sf_dir))
    columns = ["partition", "offset", "side", "error"]
    return good.withColumn("side", F.lit("succeeded")).select(*columns).unionByName(
        bad.withColumn("side", F.lit("failed")).select(*columns)
    )


@query(
    "route_failures",
    f"WITH {ROUTED_SQL} SELECT {PART_OFF}, CAST(attempt AS BIGINT) AS attempt, route FROM routed",
)
def route_failures_query(spark, sf_dir):
    return routed(spark, sf_dir).select("partition", "offset", "attempt", "route")


@query(
    "retry_due",
    f"""WITH {LOG_SQL} SELECT {PART_OFF}, h_time AS retry_time FROM log
    WHERE h_time IS NULL OR strptime(h_time, '%Y-%m-%dT%H:%M:%SZ') <= TIMESTAMP '{SPLIT_TIME}'""",
)
def retry_due_query(spark, sf_dir):
    due = retry.retry_due(event_log(spark, sf_dir), F.lit(SPLIT_TIME).cast("timestamp"))
    return due.select(
        "partition", "offset", H.header(F.col("headers"), H.RETRY_TIME).alias("retry_time")
    )


# -- functions ------------------------------------------------------------------------


@query(
    "retry_attempt",
    f"WITH {LOG_SQL} SELECT {PART_OFF}, CAST(attempts AS BIGINT) AS attempt FROM log",
)
def retry_attempt(spark, sf_dir):
    return event_log(spark, sf_dir).select(
        "partition", "offset", H.retry_attempt(F.col("headers")).alias("attempt")
    )


@query(
    "retry_time",
    f"""WITH {LOG_SQL} SELECT {PART_OFF},
    strftime(strptime(h_time, '%Y-%m-%dT%H:%M:%SZ'), '%Y-%m-%d %H:%M:%S') AS retry_time FROM log""",
)
def retry_time(spark, sf_dir):
    moment = H.retry_time(F.col("headers"))
    return event_log(spark, sf_dir).select(
        "partition", "offset", F.date_format(moment, TIME_FORMAT).alias("retry_time")
    )


def with_step_header(log: DataFrame) -> DataFrame:
    """Adds a retry.step header: good, signed, out of range, unreadable or none."""
    case = F.col("offset") % 6
    step = (
        F.when(case == 1, "1").when(case == 2, "3000000000").when(case == 3, "x")
        .when(case == 4, "-2").when(case == 5, "+4")
    )
    return log.withColumn(
        "headers",
        F.when(
            step.isNotNull(),
            F.map_concat("headers", F.create_map(F.lit("mq." + H.RETRY_STEP), step)),
        ).otherwise(F.col("headers")),
    )


STEP_SQL = "CASE off % 6 WHEN 1 THEN 1 WHEN 4 THEN -2 WHEN 5 THEN 4 ELSE 0 END"


@query("retry_step", f"WITH {LOG_SQL} SELECT {PART_OFF}, {STEP_SQL} AS step FROM log")
def retry_step(spark, sf_dir):
    return with_step_header(event_log(spark, sf_dir)).select(
        "partition", "offset", H.retry_step(F.col("headers")).alias("step")
    )


@query(
    "original_topic",
    f"WITH {LOG_SQL} SELECT {PART_OFF}, coalesce(h_topic, topic) AS original_topic FROM log",
)
def original_topic(spark, sf_dir):
    return event_log(spark, sf_dir).select(
        "partition", "offset",
        H.original_topic(F.col("headers"), F.col("topic")).alias("original_topic"),
    )


@query(
    "strip_reserved",
    f"""WITH {LOG_SQL} SELECT {PART_OFF}, 'event-type' AS keys, event_type AS event_type_header
    FROM log""",
)
def strip_reserved(spark, sf_dir):
    kept = H.strip_reserved(F.col("headers"))
    return event_log(spark, sf_dir).select(
        "partition", "offset",
        F.array_join(F.array_sort(F.map_keys(kept)), ",").alias("keys"),
        kept["event-type"].alias("event_type_header"),
    )


HEADER_NAMES = {
    "h_attempt": H.RETRY_ATTEMPT, "h_time": H.RETRY_TIME, "h_step": H.RETRY_STEP,
    "h_code": H.ERROR_CODE, "h_message": H.ERROR_MESSAGE, "h_topic": H.ORIGINAL_TOPIC,
    "h_partition": H.ORIGINAL_PARTITION, "h_offset": H.ORIGINAL_OFFSET, "h_failed_at": H.FAILED_AT,
}


def flat_headers(column: Column) -> list[Column]:
    return [H.header(column, name).alias(alias) for alias, name in HEADER_NAMES.items()]


@query(
    "retry_headers",
    f"""WITH {ROUTED_SQL} SELECT event_type AS event_type_header,
    CAST(attempt AS VARCHAR) AS h_attempt,
    strftime(ts + to_milliseconds(delay_ms), '%Y-%m-%dT%H:%M:%SZ') AS h_time, '0' AS h_step,
    'HANDLER_ERROR' AS h_code, error AS h_message, orig_topic AS h_topic,
    CAST(part AS VARCHAR) AS h_partition, CAST(off AS VARCHAR) AS h_offset,
    strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS h_failed_at FROM routed""",
)
def retry_headers(spark, sf_dir):
    attempt, when = F.col("attempt"), F.col("timestamp")
    built = H.retry_headers(
        F.col("headers"), F.col("topic"), F.col("partition"), F.col("offset"), attempt,
        backoff.retry_at(when, backoff.backoff_delay(attempt, POLICY)), F.col("error"), when,
    )
    return routed(spark, sf_dir).select(built.alias("h")).select(
        F.col("h")["event-type"].alias("event_type_header"), *flat_headers(F.col("h"))
    )


@query(
    "dlq_headers",
    f"""WITH {ROUTED_SQL} SELECT event_type AS event_type_header,
    CAST(attempt AS VARCHAR) AS h_attempt, CAST(NULL AS VARCHAR) AS h_time,
    CAST(NULL AS VARCHAR) AS h_step, 'HANDLER_ERROR' AS h_code, error AS h_message,
    orig_topic AS h_topic, CAST(part AS VARCHAR) AS h_partition, CAST(off AS VARCHAR) AS h_offset,
    strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS h_failed_at FROM routed""",
)
def dlq_headers(spark, sf_dir):
    built = H.dlq_headers(
        F.col("headers"), F.col("topic"), F.col("partition"), F.col("offset"), F.col("attempt"),
        F.col("error"), F.col("timestamp"),
    )
    return routed(spark, sf_dir).select(built.alias("h")).select(
        F.col("h")["event-type"].alias("event_type_header"), *flat_headers(F.col("h"))
    )


@query(
    "error_code",
    f"""WITH {LOG_SQL} SELECT {PART_OFF},
    CASE WHEN error IS NULL THEN '' ELSE 'HANDLER_ERROR' END AS error_code FROM log""",
)
def error_code(spark, sf_dir):
    return outcomes(spark, sf_dir).select(
        "partition", "offset", H.error_code(F.col("error")).alias("error_code")
    )


@query(
    "backoff_delay",
    f"""WITH {LOG_SQL} SELECT {PART_OFF}, CAST(off % 2000 + 1 AS BIGINT) AS attempt,
    CASE WHEN off % 2000 >= 5 THEN 30000 ELSE CAST(1000 * pow(2, off % 2000) AS BIGINT) END
    AS delay_ms FROM log""",
)
def backoff_delay(spark, sf_dir):
    # Attempts up to 2,000: far beyond where the power leaves the range of DOUBLE.
    attempt = F.col("offset") % 2000 + 1
    return event_log(spark, sf_dir).select(
        "partition", "offset", attempt.alias("attempt"),
        backoff.backoff_delay(attempt, POLICY).alias("delay_ms"),
    )


@query(
    "custom_backoff",
    f"""WITH {ROUTED_SQL} SELECT {PART_OFF}, CAST(attempt AS BIGINT) AS attempt,
    CAST(attempt * 10000 AS BIGINT) AS delay_ms FROM routed""",
)
def custom_backoff(spark, sf_dir):
    policy = RetryPolicy("r", "d", backoff=lambda attempt: attempt * 10_000)
    return routed(spark, sf_dir).select(
        "partition", "offset", "attempt",
        backoff.backoff_delay(F.col("attempt"), policy).alias("delay_ms"),
    )


@query(
    "retry_at",
    f"""WITH {ROUTED_SQL} SELECT {PART_OFF},
    strftime(ts + to_milliseconds(delay_ms), '%Y-%m-%dT%H:%M:%SZ') AS retry_at FROM routed""",
)
def retry_at(spark, sf_dir):
    delay = backoff.backoff_delay(F.col("attempt"), POLICY)
    return routed(spark, sf_dir).select(
        "partition", "offset", backoff.retry_at(F.col("timestamp"), delay).alias("retry_at")
    )


@query(
    "encode_payload",
    f"""WITH {LOG_SQL} SELECT {PART_OFF}, base64(payload) AS base64_text,
    CASE WHEN off % 50 = 0 THEN '00EFBFBDEFBFBD' ELSE hex(payload) END AS json_text_hex FROM log""",
)
def encode_payload(spark, sf_dir):
    return event_log(spark, sf_dir).select(
        "partition", "offset", P.encode_payload(F.col("payload"), "base64").alias("base64_text"),
        F.hex(F.encode(P.encode_payload(F.col("payload"), "json"), "UTF-8")).alias("json_text_hex"),
    )


@query(
    "encode_payload_documents",
    """SELECT CAST(doc_id % 3 AS INTEGER) AS "partition", doc_id AS "offset",
    md5(base64(encode(text))) AS base64_md5, md5(text) AS json_md5,
    CAST(length(base64(encode(text))) AS INTEGER) AS base64_chars FROM documents""",
)
def encode_payload_documents(spark, sf_dir):
    encoded = P.encode_payload(F.col("payload"), "base64")
    return document_log(spark, sf_dir).select(
        "partition", "offset", F.md5(encoded.cast("binary")).alias("base64_md5"),
        F.md5(P.encode_payload(F.col("payload"), "json").cast("binary")).alias("json_md5"),
        F.length(encoded).alias("base64_chars"),
    )


@query(
    "dlq_envelope",
    f"""WITH {ROUTED_SQL} SELECT {PART_OFF}, '{{"attemptCount":' || attempt || ',"error":"' || error
    || '","originalOffset":' || off || ',"originalPartition":' || part || ',"originalTopic":"'
    || orig_topic || '","payload":"' || base64(payload)
    || '","payloadEncoding":"base64","timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
    || '"}}' AS envelope FROM routed""",
)
def dlq_envelope(spark, sf_dir):
    envelope = P.dlq_envelope(
        F.col("headers"), F.col("topic"), F.col("partition"), F.col("offset"), F.col("payload"),
        F.col("attempt"), F.col("error"), F.col("timestamp"), "base64",
    )
    return routed(spark, sf_dir).select("partition", "offset", envelope.alias("envelope"))


@query(
    "dlq_documents",
    """SELECT doc_id AS original_offset, CAST(doc_id % 3 AS INTEGER) AS original_partition,
    md5(text) AS payload_md5, 'too long: ' || n_chars AS error,
    CAST(1 AS BIGINT) AS attempt_count
    FROM documents WHERE n_chars > 500""",
)
def dlq_documents(spark, sf_dir):
    """Round trip of whole document texts through JSON envelopes."""
    policy = RetryPolicy("documents.retry", "documents.dlq", max_attempts=1)
    log = document_log(spark, sf_dir).withColumn(
        "timestamp", F.lit(SPLIT_TIME).cast("timestamp")
    ).withColumn("n_chars", F.length(F.decode("payload", "UTF-8")))
    failed = apply_handler(
        log,
        column_handler(
            F.col("n_chars") > 500, F.concat(F.lit("too long: "), F.col("n_chars").cast("string"))
        ),
    ).filter(~F.col("ok"))
    _, rows = retry.retry(failed, policy)
    return read_dlq(rows.select("value")).select(
        "original_offset", "original_partition", F.md5("payload").alias("payload_md5"),
        "error", "attempt_count",
    )


# -- aggregates ------------------------------------------------------------------------


@query(
    "commit_high_water",
    f"""WITH {LOG_SQL} SELECT topic, part AS "partition", max(off) + 1 AS next_offset
    FROM log GROUP BY topic, part""",
)
def commit_high_water(spark, sf_dir):
    return offsets.commit_positions(event_log(spark, sf_dir))


@query(
    "commit_high_water_per_batch",
    f"""WITH {NUMBERED_SQL} SELECT topic, part AS "partition",
    CAST((rn - 1) // 100 AS BIGINT) AS batch_id, max(off) + 1 AS next_offset
    FROM numbered GROUP BY ALL""",
)
def commit_high_water_per_batch(spark, sf_dir):
    log = event_log(spark, sf_dir)
    return offsets.commit_positions(
        batching.batch_by_count(log, 100, span=pick_span(log)), by=["batch_id"]
    )


@query(
    "batch_payloads",
    f"""WITH {NUMBERED_SQL} SELECT part AS "partition", CAST((rn - 1) // 5 AS BIGINT) AS batch_id,
    CAST(count(*) AS INTEGER) AS n, string_agg(hex(payload), ',' ORDER BY off) AS payloads_hex
    FROM numbered GROUP BY 1, 2""",
)
def batch_payloads(spark, sf_dir):
    log = event_log(spark, sf_dir)
    batches = batching.batch_payloads(batching.batch_by_count(log, 5, span=pick_span(log)))
    return batches.select(
        "partition", "batch_id", F.size("payloads").alias("n"),
        F.array_join(F.transform("payloads", F.hex), ",").alias("payloads_hex"),
    )


BATCH_OUTCOME_SQL = f"""WITH {NUMBERED_SQL}, batched AS (
      SELECT *, CAST((rn - 1) // 5 AS BIGINT) AS batch_id FROM numbered),
    whole AS (SELECT part, batch_id, bool_and(ok) AS batch_ok,
              arg_min(error, off) FILTER (WHERE NOT ok) AS batch_error FROM batched GROUP BY 1, 2)"""


@query(
    "atomic_batch_outcome",
    f"""{BATCH_OUTCOME_SQL} SELECT b.part AS "partition", off AS "offset", b.batch_id,
    batch_ok AS ok, batch_error AS error
    FROM batched b JOIN whole w ON w.part = b.part AND w.batch_id = b.batch_id""",
)
def atomic_batch_outcome(spark, sf_dir):
    rows = outcomes(spark, sf_dir)
    batched = batching.batch_by_count(rows, 5, span=pick_span(rows))
    return batching.atomic_batch_outcome(batched).select(
        "partition", "offset", "batch_id", "ok", "error"
    )


@query(
    "outcome_summary",
    f"""WITH {LOG_SQL} SELECT topic,
    CASE WHEN ok THEN 'commit' WHEN attempts + 1 >= 3 THEN 'dlq' ELSE 'retry' END AS route,
    count(*) FILTER (WHERE ok) AS succeeded, count(*) FILTER (WHERE NOT ok) AS failed,
    count(*) AS total FROM log GROUP BY 1, 2""",
)
def outcome_summary(spark, sf_dir):
    rows = strategies.apply_strategy(outcomes(spark, sf_dir), strategies.Retry(POLICY))
    return audit.outcome_summary(rows, ["topic", "route"])


@query(
    "duplicate_deliveries",
    f"""WITH {LOG_SQL} SELECT topic, {PART_OFF}, CAST(2 AS BIGINT) AS deliveries FROM log
    WHERE off % 97 <> 0 AND off % 10 = 0""",
)
def duplicate_deliveries(spark, sf_dir):
    return audit.duplicate_deliveries(delivered(event_log(spark, sf_dir)))


# -- joins ---------------------------------------------------------------------------


@query(
    "resume_from",
    f"""WITH {LOG_SQL}, commits AS (
      SELECT part, max(off) + 1 AS next_offset FROM log
      WHERE part IN (0, 1) AND ts < TIMESTAMP '{SPLIT_TIME}' GROUP BY part)
    SELECT log.part AS "partition", off AS "offset" FROM log
    LEFT JOIN commits c ON c.part = log.part WHERE off >= coalesce(next_offset, 0)""",
)
def resume_from(spark, sf_dir):
    log = event_log(spark, sf_dir)
    commits = offsets.commit_positions(
        log.filter(F.col("partition").isin(0, 1) & (F.col("timestamp") < F.lit(SPLIT_TIME).cast("timestamp")))
    )
    return offsets.resume_from(log, commits).select("partition", "offset")


@query(
    "missing_messages",
    f"WITH {LOG_SQL} SELECT topic, {PART_OFF} FROM log WHERE off % 97 = 0",
)
def missing_messages(spark, sf_dir):
    log = event_log(spark, sf_dir)
    return audit.missing_messages(log, delivered(log)).select("topic", "partition", "offset")


@query(
    "failure_lineage",
    f"""WITH {LOG_SQL} SELECT topic AS source_topic, part AS source_partition, off AS source_offset,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS source_ts, hex(payload) AS source_payload_hex,
    '2' AS attempt_header, CAST(CASE WHEN off % 10 = 0 THEN 2 ELSE 1 END AS BIGINT) AS copies
    FROM log WHERE NOT ok AND off % 97 <> 0""",
)
def failure_lineage(spark, sf_dir):
    """Second-hop retry rows (some delivered twice) back to the message that first failed."""
    policy = RetryPolicy("events.retry", "events.dlq", origin="first")
    log = event_log(spark, sf_dir).withColumn("headers", H.strip_reserved(F.col("headers")))
    first, _ = retry.retry(apply_handler(delivered(log), native_handler()).filter(~F.col("ok")), policy)
    # The retry topic numbers its messages anew: other topic, partition and offset.
    offset = H.header(F.col("headers"), H.ORIGINAL_OFFSET).cast("bigint")
    hop = first.select(
        "topic", (offset % 2).cast("int").alias("partition"), (offset * 10).alias("offset"),
        F.lit(SPLIT_TIME).cast("timestamp").alias("timestamp"), "headers",
        F.col("value").alias("payload"), F.lit("again").alias("error"),
    )
    # Between two hops lies the retry topic: a written table, not one long expression.
    second, _ = retry.retry(materialize(hop), policy)
    lineage = audit.failure_lineage(second, log)
    return lineage.groupBy(
        "source_topic", "source_partition", "source_offset",
        time_text("source_timestamp").alias("source_ts"),
        F.hex("source_payload").alias("source_payload_hex"),
        H.header(F.col("headers"), H.RETRY_ATTEMPT).alias("attempt_header"),
    ).agg(F.count(F.lit(1)).alias("copies"))


# -- batches, strategies, breaker ----------------------------------------------------


@query(
    "batch_by_count",
    f"""WITH {NUMBERED_SQL} SELECT {PART_OFF}, CAST((rn - 1) // 5 AS BIGINT) AS batch_id
    FROM numbered""",
)
def batch_by_count(spark, sf_dir):
    log = event_log(spark, sf_dir)
    return batching.batch_by_count(log, 5, span=pick_span(log)).select(
        "partition", "offset", "batch_id"
    )


@query(
    "batch_by_count_dense",
    """SELECT event_id AS "offset",
    CAST((event_id - (SELECT min(event_id) FROM events)) // 100 AS BIGINT) AS batch_id FROM events""",
)
def batch_by_count_dense(spark, sf_dir):
    # One partition whose offsets have no gaps: batches follow from the offset alone.
    events = table(spark, sf_dir, "events").withColumn("user_id", F.col("user_id") * 0)
    log = event_messages(events)
    return batching.batch_by_count(log, 100, dense=True).select("offset", "batch_id")


@query(
    "batch_by_count_or_time",
    f"""WITH RECURSIVE {BATCHES_SQL} SELECT {PART_OFF}, batch_id FROM walk""",
)
def batch_by_count_or_time(spark, sf_dir):
    log = event_log(spark, sf_dir)
    return batching.assign_batches(log, BATCH, span=pick_span(log)).select(
        "partition", "offset", "batch_id"
    )


@query(
    "batch_across_partitions",
    """SELECT CAST(user_id % 3 AS INTEGER) AS "partition", event_id AS "offset",
    CAST((row_number() OVER (ORDER BY ts, user_id % 3, event_id) - 1) // 7 AS BIGINT) AS batch_id
    FROM events""",
)
def batch_across_partitions(spark, sf_dir):
    """One buffer for the whole topic, as a single consumer of all partitions has."""
    return batching.batch_by_count(event_log(spark, sf_dir), 7, by=["topic"]).select(
        "partition", "offset", "batch_id"
    )


@query(
    "batch_across_partitions_sparse_times",
    """SELECT CAST(user_id % 3 AS INTEGER) AS "partition", event_id AS "offset",
    CAST((row_number() OVER (ORDER BY CASE WHEN event_id % 7 <> 0 THEN ts END NULLS FIRST,
                             user_id % 3, event_id) - 1) // 7 AS BIGINT) AS batch_id
    FROM events""",
)
def batch_across_partitions_sparse_times(spark, sf_dir):
    """One buffer for the whole topic; rows without a time come first and are all kept."""
    log = event_log(spark, sf_dir).withColumn("timestamp", F.when(F.col("offset") % 7 != 0, F.col("timestamp")))
    return batching.batch_by_count(log, 7, by=["topic"]).select("partition", "offset", "batch_id")


@query(
    "batch_by_count_or_time_redelivered",
    f"""WITH RECURSIVE {redelivered_sql(BATCHES_SQL)} SELECT {PART_OFF}, batch_id FROM walk""",
)
def batch_by_count_or_time_redelivered(spark, sf_dir):
    """Every delivery is in one batch, second copies too."""
    log = redelivered(event_log(spark, sf_dir))
    return batching.assign_batches(log, BATCH, span=pick_span(log)).select("partition", "offset", "batch_id")


@query(
    "tail_batch",
    f"""WITH {NUMBERED_SQL}, totals AS (SELECT part, count(*) AS n FROM log GROUP BY part)
    SELECT m.part AS "partition", off AS "offset", CAST((rn - 1) // 7 AS BIGINT) AS batch_id,
    n % 7 <> 0 AND (rn - 1) // 7 = (n - 1) // 7 AS is_partial
    FROM numbered m JOIN totals t ON t.part = m.part""",
)
def tail_batch(spark, sf_dir):
    log = event_log(spark, sf_dir)
    batched = batching.batch_by_count(log, 7, span=pick_span(log))
    return batching.tail_batch(batched, 7, log=log).select("partition", "offset", "batch_id", "is_partial")


@query(
    "fail_fast_cut",
    f"""WITH {LOG_SQL}, stops AS (SELECT part, min(off) AS stop FROM log WHERE NOT ok GROUP BY part)
    SELECT log.part AS "partition", off AS "offset",
    CASE WHEN ok THEN 'commit' ELSE 'stop' END AS route,
    CASE WHEN NOT ok THEN 'fail-fast: handler error on topic=' || topic || ' partition=' || log.part
      || ' offset=' || off || ': ' || error END AS stop_error
    FROM log LEFT JOIN stops s ON s.part = log.part WHERE stop IS NULL OR off <= stop""",
)
def fail_fast_cut(spark, sf_dir):
    return strategies.fail_fast(outcomes(spark, sf_dir)).select(
        "partition", "offset", "route", "stop_error"
    )


@query(
    "skip_failures",
    f"""WITH {LOG_SQL} SELECT 'skip' AS strategy, topic, {PART_OFF}, error, 'commit' AS route
    FROM log WHERE NOT ok""",
)
def skip_failures(spark, sf_dir):
    skip = strategies.Skip()
    rows = strategies.apply_strategy(outcomes(spark, sf_dir), skip).filter(F.col("route") == "commit")
    return strategies.error_log(rows, skip.name).withColumn("route", F.lit("commit"))


@query(
    "failure_runs",
    f"""WITH {NUMBERED_SQL} SELECT {PART_OFF},
    CAST(rn - coalesce(max(CASE WHEN ok THEN rn END) OVER (PARTITION BY part ORDER BY off), 0)
    AS BIGINT) AS failure_run FROM numbered""",
)
def failure_runs(spark, sf_dir):
    rows = outcomes(spark, sf_dir)
    return breaker.failure_runs(rows, span=pick_span(rows)).select(
        "partition", "offset", "failure_run"
    )


BREAKER_COLUMNS = [
    "partition", "offset", "state_before", "state_after", "failure_count", "success_count",
    "action", "fatal",
]
BREAKER_SELECT = f"""{PART_OFF}, state_before, state_after, failures AS failure_count,
    CAST(successes AS BIGINT) AS success_count, action, fatal"""


@query("circuit_breaker", f"WITH RECURSIVE {BREAKER_SQL} SELECT {BREAKER_SELECT} FROM breaker_log")
def circuit_breaker(spark, sf_dir):
    rows = outcomes(spark, sf_dir)
    return breaker.circuit_breaker(rows, BREAKER, span=pick_span(rows)).select(*BREAKER_COLUMNS)


@query(
    "circuit_breaker_redelivered",
    f"WITH RECURSIVE {redelivered_sql(BREAKER_SQL)} SELECT {BREAKER_SELECT} FROM breaker_log",
)
def circuit_breaker_redelivered(spark, sf_dir):
    """Second copies count as further outcomes of their message."""
    rows = redelivered(outcomes(spark, sf_dir))
    return breaker.circuit_breaker(rows, BREAKER, span=pick_span(rows)).select(*BREAKER_COLUMNS)


@query(
    "held_again",
    f"""WITH RECURSIVE {BREAKER_SQL} SELECT {PART_OFF}, event_type FROM breaker_log WHERE fatal AND off % 2 = 1""",
)
def held_again(spark, sf_dir):
    """What a breaker held is read again; the even half is accepted then, the odd half is still held."""
    log = event_log(spark, sf_dir)
    first = apply_handler(log, native_handler())
    first = strategies.CircuitBreaker(BREAKER, span=pick_span(first)).apply(first).select(
        *IDENTITY, "route", "fatal", F.lit(0).alias("micro_batch")
    )
    first = materialize(first)
    again = strategies.Skip().apply(
        apply_handler(strategies.held_again(log, first), column_handler(F.col("offset") % 2 == 1, bad_event())).filter("ok")
    ).select(*IDENTITY, "route", F.lit(False).alias("fatal"), F.lit(1).alias("micro_batch"))
    return strategies.held_again(log, first.unionByName(again)).select("partition", "offset", "event_type")


LONG_COOLDOWN = BreakerPolicy(threshold=2, cooldown_ms=2 * 86_400_000, half_open_attempts=2)


@query(
    "circuit_breaker_long_cooldown",
    f"WITH RECURSIVE {long_cooldown_sql(BREAKER_SQL)} SELECT {BREAKER_SELECT} FROM breaker_log",
)
def circuit_breaker_long_cooldown(spark, sf_dir):
    """Most rows fail, and a cooldown outlasts segments full of failures."""
    rows = apply_handler(event_log(spark, sf_dir), column_handler(F.col("event_type") != "error", bad_event()))
    return breaker.circuit_breaker(rows, LONG_COOLDOWN, span=pick_span(rows)).select(*BREAKER_COLUMNS)


@query(
    "breaker_summary",
    f"""WITH RECURSIVE {BREAKER_SQL},
    spans AS (
      SELECT part, epoch_us(ts) AS opened,
             coalesce(lead(epoch_us(ts)) OVER (PARTITION BY part ORDER BY off), last_us) AS until,
             action
      FROM breaker_log
      JOIN (SELECT part AS p, max(epoch_us(ts)) AS last_us FROM log GROUP BY part) ON p = part
      WHERE action IN ('tripped', 'reopened', 'probe')),
    opens AS (SELECT part, sum(until - opened) FILTER (WHERE action <> 'probe') AS open_us
              FROM spans GROUP BY part)
    SELECT l.part AS "partition", count(*) FILTER (WHERE action = 'tripped') AS trips,
    count(*) FILTER (WHERE action = 'reopened') AS reopenings,
    count(*) FILTER (WHERE action = 'probe') AS probes,
    count(*) FILTER (WHERE action = 'closed') AS closings,
    count(*) FILTER (WHERE action = 'rejected') AS rejected,
    CAST(coalesce(any_value(open_us), 0) // 1000 AS BIGINT) AS open_ms
    FROM breaker_log l LEFT JOIN opens o ON o.part = l.part GROUP BY l.part""",
)
def breaker_summary(spark, sf_dir):
    rows = outcomes(spark, sf_dir)
    log = breaker.circuit_breaker(rows, BREAKER, span=pick_span(rows))
    return breaker.breaker_summary(log).drop("topic")


# -- order and routes ------------------------------------------------------------------


@query(
    "offset_order",
    f"""WITH {NUMBERED_SQL} SELECT {PART_OFF}, CAST(rn - 1 AS BIGINT) AS position FROM numbered""",
)
def offset_order(spark, sf_dir):
    log = event_log(spark, sf_dir)
    ordered = batching.in_log_order(log.select("topic", "partition", "offset"))
    # Positions prove the order: every range partition is one run of the log.
    return batching.with_position(ordered, span=pick_span(log)).select(
        "partition", "offset", "position"
    )


@query(
    "merge_routes",
    f"""WITH {LOG_SQL}, stops AS (SELECT part, min(off) AS stop FROM log WHERE NOT ok GROUP BY part)
    SELECT 'retry' AS strategy, {PART_OFF} FROM log
    UNION ALL
    SELECT 'fail-fast', log.part, off FROM log LEFT JOIN stops s ON s.part = log.part
    WHERE stop IS NULL OR off < stop""",
)
def merge_routes(spark, sf_dir):
    frames = []
    for strategy in (strategies.Retry(POLICY), strategies.FailFast()):
        accepted = strategies.merge_routes(strategy.apply(outcomes(spark, sf_dir)))
        frames.append(accepted.select(F.lit(strategy.name).alias("strategy"), "partition", "offset"))
    return frames[0].unionByName(frames[1])


# -- retry and strategies --------------------------------------------------------------


@query(
    "retry_rounds",
    f"""WITH {LOG_SQL}, need AS (
      SELECT *, CASE WHEN event_type = 'error' THEN (off // 5) % 6 ELSE 0 END AS need FROM log),
    rounds AS (SELECT *, unnest([0, 1, 2, 3]) AS r FROM need)
    SELECT {PART_OFF}, r AS round, CAST(attempts + r + 1 AS BIGINT) AS attempt,
    attempts + r >= need AS ok,
    CASE WHEN attempts + r >= need THEN 'commit' WHEN attempts + r + 1 >= 4 THEN 'dlq'
      ELSE 'retry' END AS route,
    strftime(ts + to_milliseconds(CAST(CASE WHEN r = 0 THEN 0 ELSE 1000 * pow(2, attempts) * (pow(2, r) - 1) END AS BIGINT)),
      '%Y-%m-%d %H:%M:%S') AS handled_at
    FROM rounds WHERE r = 0 OR (attempts + r - 1 < need AND attempts + r < 4)""",
)
def retry_rounds(spark, sf_dir):
    """A handler that succeeds after a number of attempts that depends on the message."""
    policy = RetryPolicy("events.retry", "events.dlq", max_attempts=4)
    need = F.when(F.col("event_type") == "error", F.expr("offset div 5") % 6).otherwise(F.lit(0))
    handler = column_handler(H.retry_attempt(F.col("headers")) < need, F.lit("not yet"))
    result = retry.run_with_retries(event_log(spark, sf_dir), handler, policy)
    return result.history.select(
        "partition", "offset", "round", "attempt", "ok", "route",
        time_text("timestamp").alias("handled_at"),
    )


@query(
    "retry_strategy",
    f"""WITH {ROUTED_SQL} SELECT {PART_OFF}, route, CAST(attempt AS BIGINT) AS attempt,
    orig_topic AS original_topic,
    CASE WHEN route = 'retry' THEN delay_ms END AS delay_ms,
    CASE WHEN route = 'retry'
      THEN strftime(ts + to_milliseconds(delay_ms), '%Y-%m-%dT%H:%M:%SZ') END AS retry_at,
    CASE WHEN route = 'dlq' THEN base64(payload) END AS dead_payload FROM routed""",
)
def retry_strategy(spark, sf_dir):
    """Route, attempt, delay and due time of every failed message, from the produced rows."""
    policy = RetryPolicy("events.retry", "events.dlq", payload_encoding="base64")
    retries, dead = retry.retry(failures(spark, sf_dir), policy)
    h = F.col("headers")
    attempt = H.retry_attempt(h)
    common = [
        H.header(h, H.ORIGINAL_PARTITION).cast("int").alias("partition"),
        H.header(h, H.ORIGINAL_OFFSET).cast("bigint").alias("offset"),
        F.when(F.col("topic") == policy.retry_target, "retry").otherwise("dlq").alias("route"),
        attempt.alias("attempt"),
        H.header(h, H.ORIGINAL_TOPIC).alias("original_topic"),
    ]
    again = retries.select(
        *common, backoff.backoff_delay(attempt, policy).alias("delay_ms"),
        H.header(h, H.RETRY_TIME).alias("retry_at"),
        F.lit(None).cast("string").alias("dead_payload"),
    )
    gone = dead.select(
        *common, F.lit(None).cast("bigint").alias("delay_ms"),
        F.lit(None).cast("string").alias("retry_at"),
        P.parse_envelope(F.col("value"))["payload"].alias("dead_payload"),
    )
    return again.unionByName(gone)


@query(
    "batch_retry",
    f"""{BATCH_OUTCOME_SQL} SELECT CAST(off AS VARCHAR) AS original_offset,
    CASE WHEN attempts + 1 >= 3 THEN 'events.dlq' ELSE 'events.retry' END AS target,
    CAST(attempts + 1 AS VARCHAR) AS attempt_header, batch_error AS error_header
    FROM batched b JOIN whole w ON w.part = b.part AND w.batch_id = b.batch_id WHERE NOT batch_ok""",
)
def batch_retry(spark, sf_dir):
    """A failed batch: every message of it is retried on its own attempts."""
    rows = outcomes(spark, sf_dir)
    batched = batching.batch_by_count(rows, 5, span=pick_span(rows))
    failed = batching.atomic_batch_outcome(batched).filter(~F.col("ok"))
    retries, dead = retry.retry(failed, POLICY)
    h = F.col("headers")
    columns = [
        H.header(h, H.ORIGINAL_OFFSET).alias("original_offset"), F.col("topic").alias("target"),
        H.header(h, H.RETRY_ATTEMPT).alias("attempt_header"),
        H.header(h, H.ERROR_MESSAGE).alias("error_header"),
    ]
    return retries.select(*columns).unionByName(dead.select(*columns))


@query(
    "breaker_with_retry",
    f"""WITH RECURSIVE {BREAKER_SQL}, b AS (
      SELECT *, action IN ('continue', 'tripped', 'reopened') AS retried FROM breaker_log)
    SELECT {PART_OFF}, action,
    CASE WHEN retried THEN CASE WHEN attempts + 1 >= 3 THEN 'dlq' ELSE 'retry' END
         WHEN action = 'rejected' THEN 'stop' ELSE 'commit' END AS route,
    CASE WHEN retried THEN CAST(attempts + 1 AS BIGINT) END AS attempt,
    action IN ('tripped', 'rejected') AS fatal,
    CASE action WHEN 'tripped' THEN 'circuit breaker opened after ' || failures || ' consecutive failures'
      WHEN 'rejected' THEN 'circuit breaker open' END AS stop_error
    FROM b""",
)
def breaker_with_retry(spark, sf_dir):
    rows = outcomes(spark, sf_dir)
    strategy = strategies.CircuitBreaker(BREAKER_RETRY, span=pick_span(rows))
    return strategies.apply_strategy(rows, strategy).select(
        "partition", "offset", "action", "route", "attempt", "fatal", "stop_error"
    )


class RetryPurchasesOnly:
    """A user's strategy: purchases of value are kept for a retry, the rest is dropped."""

    name = "retry-high-value"

    def apply(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(
            "route",
            F.when(F.col("ok"), "commit").when(F.col("value") > 50, "retry").otherwise("dlq"),
        )


@query(
    "custom_strategy",
    f"""WITH {LOG_SQL} SELECT {PART_OFF},
    CASE WHEN ok THEN 'commit' WHEN value > 50 THEN 'retry' ELSE 'dlq' END AS route FROM log""",
)
def custom_strategy(spark, sf_dir):
    return strategies.apply_strategy(outcomes(spark, sf_dir), RetryPurchasesOnly()).select(
        "partition", "offset", "route"
    )


# -- Python handlers -------------------------------------------------------------------


def _check_payload(payload):
    """Fails multiples of ten; raises on bytes that are not text."""
    import json

    number = json.loads(payload.decode("utf-8"))["k"]
    return f"bad k {number}" if number % 10 == 0 else None


UTF8_PANIC = (
    "handler panic: ''utf-8'' codec can''t decode byte 0xff in position 1: invalid start byte"
)


@query(
    "udf_handler",
    f"""WITH e AS (SELECT CAST(user_id % 3 AS INTEGER) AS part, event_id AS off,
      CASE WHEN event_id % 50 = 0 THEN '{UTF8_PANIC}'
           WHEN CAST(props->>'$.k' AS BIGINT) % 10 = 0 THEN 'bad k ' || (props->>'$.k') END AS error
      FROM events)
    SELECT {PART_OFF}, error IS NULL AS ok, error FROM e""",
)
def udf_handler(spark, sf_dir):
    log = spread(event_log(spark, sf_dir).select("topic", "partition", "offset", "payload"))
    return apply_handler(log, PayloadHandler(_check_payload)).select(
        "partition", "offset", "ok", "error"
    )


def _all_text(payloads: list):
    """Batch handler: one payload that is not text fails the batch."""
    bad = sum(1 for p in payloads if b"\xff" in p)
    return f"{bad} of {len(payloads)} payloads are not text" if bad else None


@query(
    "udf_batch_handler",
    f"""WITH {NUMBERED_SQL}, batched AS (
      SELECT *, CAST((rn - 1) // 20 AS BIGINT) AS batch_id FROM numbered),
    whole AS (SELECT part, batch_id, count(*) FILTER (WHERE off % 50 = 0) AS bad, count(*) AS n
              FROM batched GROUP BY 1, 2)
    SELECT b.part AS "partition", off AS "offset", b.batch_id, event_type AS event_type_header,
    bad = 0 AS ok,
    CASE WHEN bad > 0 THEN bad || ' of ' || n || ' payloads are not text' END AS error
    FROM batched b JOIN whole w ON w.part = b.part AND w.batch_id = b.batch_id""",
)
def udf_batch_handler(spark, sf_dir):
    log = to_messages(event_log(spark, sf_dir))
    batched = batching.batch_by_count(log, 20, span=pick_span(log))
    return apply_batch_handler(batched, _all_text).select(
        "partition", "offset", "batch_id", F.col("headers")["event-type"].alias("event_type_header"),
        "ok", "error",
    )


def _stepwise(message: Message):
    """Handler in steps: fails error events at the step it got to."""
    if message.headers["event-type"] == "error":
        step = message.retry_step()
        raise HandlerFailure(f"failed after step {step}", next_step=step + 1)


@query(
    "retry_step_handler",
    f"""WITH {LOG_SQL} SELECT CAST(off AS VARCHAR) AS original_offset,
    'failed after step ' || ({STEP_SQL}) AS error_header,
    CAST(({STEP_SQL}) + 1 AS VARCHAR) AS step_header
    FROM log WHERE NOT ok AND attempts + 1 < 3""",
)
def retry_step_handler(spark, sf_dir):
    log = with_step_header(spread(event_log(spark, sf_dir)))
    failed = apply_handler(log, _stepwise).filter(~F.col("ok"))
    retries, _ = retry.retry(failed, POLICY)
    h = F.col("headers")
    return retries.select(
        H.header(h, H.ORIGINAL_OFFSET).alias("original_offset"),
        H.header(h, H.ERROR_MESSAGE).alias("error_header"),
        H.header(h, H.RETRY_STEP).alias("step_header"),
    )
