import pytest

from msgflow import BatchPolicy, BreakerPolicy, PayloadEncoding, RetryPolicy, StreamPolicy, TopicConfig
from msgflow.sources.topics import connector_options, read_topic
from msgflow.streaming.runner import run_stream
from msgflow import CircuitBreaker


def topic(**over):
    return TopicConfig(**{"topic": "orders", "brokers": ("b:1",), "group": "g", **over})


@pytest.mark.parametrize(
    "build, text",
    [
        (lambda: topic(topic=""), "topic cannot be empty"),
        (lambda: topic(brokers=()), "at least one broker must be provided"),
        (lambda: topic(brokers=("a:1", "")), "broker address cannot be empty"),
        (lambda: topic(group=""), "consumer group cannot be empty"),
        (lambda: topic(kafka_options=None), "kafka config cannot be nil"),
        (lambda: BatchPolicy(size=0), "batch size must be positive"),
        (lambda: BatchPolicy(size=-1), "batch size must be positive"),
        (lambda: BatchPolicy(timeout_ms=0), "batch timeout must be positive"),
        (lambda: StreamPolicy(trigger_interval_ms=9), "poll timeout must be at least 10ms"),
        (lambda: StreamPolicy(shutdown_timeout_ms=0), "shutdown timeout must be positive"),
        (lambda: RetryPolicy("", "d"), "retry topic cannot be empty"),
        (lambda: RetryPolicy("r", ""), "DLQ topic cannot be empty"),
        (lambda: RetryPolicy(None, "d"), "retry topic is required"),
        (lambda: RetryPolicy("r", None), "DLQ topic is required"),
        (lambda: RetryPolicy("r", "d", max_attempts=0), "max attempts must be positive"),
        (lambda: RetryPolicy("r", "d", initial_delay_ms=0), "initial delay must be positive"),
        (lambda: RetryPolicy("r", "d", max_delay_ms=-1), "max delay must be positive"),
        (lambda: RetryPolicy("r", "d", multiplier=0.5), "backoff multiplier must be >= 1.0"),
        (lambda: RetryPolicy("r", "d", payload_encoding="xml"), "unsupported payload encoding: xml"),
        (lambda: BreakerPolicy(threshold=0), "failure threshold must be positive"),
        (lambda: BreakerPolicy(cooldown_ms=0), "cooldown period must be positive"),
        (lambda: BreakerPolicy(half_open_attempts=0), "half-open attempts must be positive"),
    ],
)
def test_bad_values_are_refused_when_built(build, text):
    with pytest.raises(ValueError, match=text):
        build()


def test_defaults():
    assert (BatchPolicy().size, BatchPolicy().timeout_ms) == (100, 5000)
    retry = RetryPolicy("r", "d")
    assert (retry.max_attempts, retry.initial_delay_ms, retry.max_delay_ms) == (3, 1000, 30000)
    assert retry.multiplier == 2.0 and retry.payload_encoding is PayloadEncoding.JSON
    breaker = BreakerPolicy()
    assert (breaker.threshold, breaker.cooldown_ms, breaker.half_open_attempts) == (10, 60000, 3)
    assert StreamPolicy().shutdown_timeout_ms == 30000


@pytest.mark.parametrize("key", ["bootstrap.servers", "group.id", "enable.auto.commit"])
def test_managed_keys_are_refused(key):
    with pytest.raises(ValueError, match="managed by the library"):
        topic(kafka_options={key: "x"})


def test_connector_options_pass_through():
    config = topic(
        brokers=("a:1", "b:2"),
        kafka_options={"session.timeout.ms": 6000, "auto.offset.reset": "latest", "check.crcs": True},
    )
    options = connector_options(config)
    assert options["kafka.bootstrap.servers"] == "a:1,b:2"
    assert options["kafka.group.id"] == "g" and options["subscribe"] == "orders"
    assert options["kafka.session.timeout.ms"] == "6000" and options["kafka.check.crcs"] == "true"
    assert options["startingOffsets"] == "latest" and options["includeHeaders"] == "true"
    assert options["kafka.reconnect.backoff.ms"] == "100"
    assert options["kafka.reconnect.backoff.max.ms"] == "10000"
    assert connector_options(topic())["startingOffsets"] == "earliest"
    replaced = connector_options(topic(kafka_options={"reconnect.backoff.ms": 5}))
    assert replaced["kafka.reconnect.backoff.ms"] == "5"


def test_batch_read_cannot_start_at_latest(spark):
    with pytest.raises(ValueError, match="earliest"):
        read_topic(spark, topic(), start="latest")


def test_exactly_one_handler(make):
    df = make([{}])
    with pytest.raises(ValueError, match="exactly one"):
        run_stream(df, "/unused")
    with pytest.raises(ValueError, match="only one"):
        run_stream(df, "/unused", handler=print, batch_handler=print)
    with pytest.raises(ValueError, match="single-message mode"):
        run_stream(df, "/unused", batch_handler=print, strategy=CircuitBreaker())


def test_the_package_can_be_shipped(spark):
    import sys
    import zipfile

    from msgflow.session import ship_package

    path = ship_package(spark)
    with zipfile.ZipFile(path.removeprefix("file:")) as archive:
        assert "msgflow/operators/handler.py" in archive.namelist()
    sys.path[:] = [p for p in sys.path if not p.endswith("/msgflow.zip")]


def test_sink_takes_connection_settings_and_source_its_own_options():
    from msgflow.config import TopicConfig
    from msgflow.sources.sinks import sink_options
    from msgflow.sources.topics import connector_options

    config = TopicConfig("t", ("b:1",), "g", {"security.protocol": "SSL", "fetch.min.bytes": 5})
    assert sink_options(config)["kafka.security.protocol"] == "SSL"
    assert "kafka.fetch.min.bytes" not in sink_options(config)
    options = connector_options(config, '{"t":{"0":5}}', {"minPartitions": "40"})
    assert options["minPartitions"] == "40" and options["startingOffsets"] == '{"t":{"0":5}}'
    with pytest.raises(ValueError, match="not options of the source"):
        connector_options(config, reader={"subscribe": "x"})


def test_positions_as_starting_offsets(spark):
    from msgflow.sources.topics import starting_offsets

    rows = [("t", 1, 7), ("t", 0, 3), ("t", 0, 5), ("u", 0, 9)]
    df = spark.createDataFrame(rows, "topic string, partition int, next_offset long")
    assert starting_offsets(df, "t") == '{"t": {"0": 5, "1": 7}}'
