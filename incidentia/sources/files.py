"""Files: delimited text, stored tables, stored documents."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from incidentia.schemas import CLEAN, SNAPSHOT, STREAM_STORE
from incidentia.sinks.commits import CommittedTable
from incidentia.sinks.tables import newest_version


def _present(load, path: str, hint: str) -> DataFrame:
    """Run ``load``; a missing path fails now, with a hint what to do."""
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"{path} does not exist. {hint}") from error
        raise


def read_raw(
    spark: SparkSession, path: str, *, sep: str = ";", multi_line: bool = False
) -> DataFrame:
    """Delimited text with a header; every column, known or not, as text.

    A quoted cell with line breaks needs ``multi_line``, which reads each
    file in one task; without it large files are split. Files of one path
    must have the same header: another one raises when it is read.
    """
    options = {"sep": sep, "multiLine": multi_line}
    load = lambda: _same_headers(spark, path, **options)
    return _present(load, path, "Put the raw incident file there first.")


def _same_headers(spark: SparkSession, path: str, **options) -> DataFrame:
    reader = spark.read.options(header=True, encoding="UTF-8", escape='"', **options)
    first = reader.csv(path).schema
    return reader.option("enforceSchema", False).schema(first).csv(path)


def read_strings(spark: SparkSession, path: str, *, sep: str = ",") -> DataFrame:
    """Delimited text as string rows in which an empty cell is ``""``."""
    rows = _present(lambda: _same_headers(spark, path, sep=sep), path, "Write the clean table first.")
    return rows.fillna("")


def read_clean(
    spark: SparkSession, path: str, *, fmt: str = "parquet", schema: StructType = CLEAN
) -> DataFrame:
    """The clean table with its fixed types and column order.

    CSV files must have the columns in that order: another header raises.
    """
    if fmt == "parquet" and CommittedTable(spark, path).numbers():
        return CommittedTable(spark, path, schema).read().select(schema.fieldNames())
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.options(header=True, escape='"', enforceSchema=False)
    rows = _present(lambda: reader.load(path), path, "Write the clean table first.")
    return rows.select(schema.fieldNames())


def read_collection(spark: SparkSession, path: str, *, fmt: str = "parquet", **options) -> DataFrame:
    """A stored collection without the store's own ``_id``."""
    if fmt == "parquet" and CommittedTable(spark, path).numbers():
        return CommittedTable(spark, path).read().drop("_id")
    return spark.read.format(fmt).options(**options).load(path).drop("_id")


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest aggregates document."""
    return read_document(spark, path, SNAPSHOT)


def read_document(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The newest complete version of a document."""
    version = newest_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"{path} does not exist. Process a batch first.")
    return spark.read.schema(schema).json(f"{path}/version={version}")


def snapshot_list(snapshot: DataFrame, name: str) -> DataFrame:
    """One list of the document as rows."""
    return snapshot.where(F.col("lista") == name).select("clave", "zona", "total")


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The events that the stream has stored, each once, also while they are packed."""
    return CommittedTable(spark, path, STREAM_STORE).read()


def as_incidents(events: DataFrame) -> DataFrame:
    """Streamed events with hour and age as the clean table has them."""
    return events.withColumns({"hora": F.col("hora_num"), "edad": F.col("edad").try_cast("double")})


def read_incidents(spark: SparkSession, batch_path: str, stream_path: str) -> DataFrame:
    """Batch and stream tables under one schema; neither overwrites the other.

    What the stream does not carry is null there.
    """
    batch = read_collection(spark, batch_path).withColumn("origen", F.lit("batch"))
    shared = as_incidents(read_events(spark, stream_path)).withColumn("origen", F.lit("stream"))
    return batch.unionByName(shared, allowMissingColumns=True)
