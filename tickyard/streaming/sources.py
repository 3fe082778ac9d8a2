"""Stream sources (S1): broker topic or JSON-line message files.

Both return the broker row shape ``key BINARY, value BINARY, timestamp
TIMESTAMP`` so parsing does not care where the messages came from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


# JSON-line message files written by a producer or ``plans.replay``.
MESSAGE_FILE_SCHEMA = "key STRING, value STRING, timestamp TIMESTAMP"


def kafka_options(servers: str, topic: str, starting_offsets: str = "latest",
                  max_offsets_per_trigger: int | None = None, fail_on_data_loss: bool = True) -> dict:
    """Options of the broker source (the connector jar must be on the classpath).

    Lost offsets stop the query unless ``fail_on_data_loss=False`` is chosen;
    there is no rate cap unless one is given."""
    cap = {"maxOffsetsPerTrigger": str(max_offsets_per_trigger)} if max_offsets_per_trigger else {}
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting_offsets,
            "failOnDataLoss": str(fail_on_data_loss).lower(), **cap}


def kafka_stream(spark: SparkSession, servers: str, topic: str, **kw) -> DataFrame:
    """Broker topic as a stream of (key, value, timestamp, topic, partition, offset)."""
    return (spark.readStream.format("kafka").options(**kafka_options(servers, topic, **kw)).load()
            .select("key", "value", "timestamp", "topic", "partition", "offset"))


def file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 without a broker: JSON-line message files in file modification order;
    ``max_files_per_trigger`` caps a micro-batch where a rate cap is wanted."""
    reader = spark.readStream.schema(MESSAGE_FILE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (reader.json(path)
            .select(F.col("key").cast("binary").alias("key"),
                    F.col("value").cast("binary").alias("value"), "timestamp"))
