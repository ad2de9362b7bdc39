"""Streaming sources. Both give ``value BINARY, timestamp TIMESTAMP``; Kafka also
where each message lies: ``topic``, ``partition``, ``offset``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BinaryType, StructField, StructType, TimestampType

MESSAGE = StructType(
    [StructField("value", BinaryType()), StructField("timestamp", TimestampType())]
)

# What names a message: the same place is the same message.
POSITION = ("topic", "partition", "offset")


def kafka_messages(
    spark: SparkSession, servers: str, topic: str, *, per_trigger: int | None = None
) -> DataFrame:
    """Topic from its earliest offset; offsets that expired are skipped."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "false")
    )
    if per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load().select("value", "timestamp", *POSITION)


def file_stream(
    spark: SparkSession, path: str, schema: StructType, *, files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files as they appear under ``path``.

    Without a limit everything there at the start is one micro-batch.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
