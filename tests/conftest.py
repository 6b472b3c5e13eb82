import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from msgflow.schema import MESSAGE_SCHEMA  # noqa: E402

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("FATAL")
    yield session
    session.stop()


@pytest.fixture
def make(spark):
    """Messages from dicts; what is left out gets a default."""

    def build(rows, schema_extra=""):
        extra = [c.split()[0] for c in schema_extra.split(",") if c.strip()]
        full = []
        for i, row in enumerate(rows):
            full.append(
                (
                    row.get("topic", "orders"), row.get("partition", 0), row.get("offset", i),
                    row.get("timestamp", START + dt.timedelta(seconds=row.get("at", i))),
                    row.get("headers", {}), row.get("payload", b"p%d" % i),
                    *[row.get(c) for c in extra],
                )
            )
        names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in MESSAGE_SCHEMA)
        return spark.createDataFrame(full, names + (", " + schema_extra if schema_extra else ""))

    return build
