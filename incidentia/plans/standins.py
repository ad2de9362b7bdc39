"""Incident tables derived from the generic tables of a data folder.

``events`` are the incidents: time, type, a number and a small JSON property
``k`` (0 to 99). ``customer`` gives the reporting user's area code and more
attributes. Some values are spoiled on purpose by their own content, so that
every cleaning rule has something to do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from incidentia.functions.dates import shift_of
from incidentia.functions.geo import Box
from incidentia.operators.clean import with_area
from incidentia.operators.joins import lookup
from incidentia.schemas import RAW, UNKNOWN_AREA
from incidentia.session import written
from incidentia.sources.stream import file_stream
from incidentia.streaming.jobs import finish

STANDIN_BOX = Box(10.0, 50.0, 20.0, 80.0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_schema(spark: SparkSession, sf_dir: str, name: str) -> StructType:
    return table(spark, sf_dir, name).schema


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a stream; one micro-batch, so no row can come late."""
    schema = table_schema(spark, sf_dir, "events")
    # A pattern, because the table may be one file or a folder of files.
    return file_stream(spark, f"{sf_dir}/{{events}}.parquet", schema)


# Micro-batches that a stand-in stream comes in.
PARTS = 3


def in_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with ``_part``, the micro-batch that an event arrives in.

    Time from the first to the last event is cut into equal parts. One event
    in 17 comes a part later than its time says, one in 101 in the last part.
    """
    events = table(spark, sf_dir, "events")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    seconds = lambda t: F.unix_micros(t.cast("timestamp"))
    length = F.greatest(seconds(F.lit(last)) - seconds(F.lit(first)), F.lit(1))
    own = F.least(F.floor((seconds(F.col("ts")) - seconds(F.lit(first))) * PARTS / length), F.lit(PARTS - 1))
    late = F.when(F.col("event_id") % 101 == 0, PARTS - 1).when(
        F.col("event_id") % 17 == 0, F.least(own + 1, F.lit(PARTS - 1))
    )
    return events.withColumn("_part", F.coalesce(late, own).cast("int"))


def replay(
    spark: SparkSession,
    rows: DataFrame,
    start: Callable[[DataFrame], StreamingQuery],
    *,
    path: str,
    part: str = "_part",
) -> None:
    """Stream ``rows`` part by part: the files of a part are added, the stream
    starts, takes them and ends; the next start goes on from its checkpoint."""
    stored = written(rows, "parts")
    for number in range(PARTS):
        stored.where(F.col(part) == number).drop(part).write.mode("append").parquet(path)
        finish(start(file_stream(spark, path, stored.drop(part).schema)))


def with_position(messages: DataFrame, number: Column) -> DataFrame:
    """Messages with the place that a broker would give the numbered one."""
    return messages.withColumns(
        {"topic": F.lit("incidents"), "partition": (number % 3).cast("int"), "offset": number}
    )


def with_k(events: DataFrame) -> DataFrame:
    """Add ``k``. It comes out of a generator, so the JSON is read once per
    row: filters on ``k`` are not pushed below it."""
    return events.select("*", F.inline(F.array(F.from_json("props", "k int"))))


def time_text(k: Column) -> Column:
    """Time as reported: three values of ``k`` stand for unreadable ones, one
    for two blanks before the hour."""
    return (
        F.when(k == 0, "sin fecha")
        .when(k == 1, F.date_format("ts", "yyyy-MM-dd HH:mm"))
        .when(k == 7, F.date_format("ts", "d/M/yyyy  H:mm"))
        .when(k == 8, F.date_format("ts", "d/M/yyyy 99:mm"))
        .otherwise(F.date_format("ts", "d/M/yyyy H:mm"))
    )


def _numbered(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), F.floor(number).cast("string"))


def raw_incidents(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Untyped incident rows; every ``error`` event is reported twice."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_nationkey", "c_name", "c_mktsegment", "c_acctbal"
    )
    source = table(spark, sf_dir, "events") if events is None else events
    # The property is read after the lookup, which may look at the keys first.
    sent = source.select("ts", "user_id", "event_type", "value", "props")
    k, value = F.col("k"), F.col("value")
    balance, segment = F.col("c_acctbal"), F.col("c_mktsegment")
    raw = with_k(lookup(sent, customers, "user_id")).select(
        time_text(k).alias("fecha_hecho"),
        F.col("c_nationkey").cast("string").alias("codigo_comuna"),
        F.col("c_name").alias("nombre_barrio"),
        F.when(k == 2, "abc")
        .otherwise(F.round(value * F.lit(1e8)).cast("bigint").cast("string"))
        .alias("latitud"),
        F.when(k != 3, (k.cast("bigint") * F.lit(100000000)).cast("string")).alias("longitud"),
        F.col("event_type").alias("modalidad"),
        F.when(value < 10, "Sin dato")
        .when(value < 40, "Arma blanca")
        .when(value < 90, "Arma de fuego")
        .otherwise("No")
        .alias("arma_medio"),
        F.when(k < 50, "Sin dato").otherwise("Mayor").alias("conducta_especial"),
        _numbered("Transporte ", k / 8).alias("medio_transporte"),
        F.when(value < 20, "Sin dato mercancías")
        .otherwise(_numbered("Objeto ", value / 20))
        .alias("bien"),
        _numbered("Categoría ", value / 100).alias("categoria_bien"),
        F.when(value < 100, "NA").otherwise("Grupo alto").alias("grupo_bien"),
        _numbered("Lugar ", k / 5).alias("lugar"),
        F.when(balance < 0, "Sin dato")
        .when(balance < 5000, "Mujer")
        .otherwise("Hombre")
        .alias("sexo"),
        F.when(k == 4, "None").otherwise(k.cast("string")).alias("edad"),
        F.when(segment == "BUILDING", "Sin dato").otherwise(segment).alias("estado_civil"),
        F.when(F.col("event_type") == "error", 2).otherwise(1).alias("_reports"),
    )
    reported = raw.withColumn("_report", F.explode(F.sequence(F.lit(1), F.col("_reports"))))
    return reported.select(RAW.fieldNames())


def user_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_id, comuna`` for every customer."""
    coded = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("codigo_comuna")
    )
    return with_area(coded).select("user_id", "comuna")


def _plain_columns() -> dict[str, Column]:
    hour = F.hour("ts")
    return {
        "event_id": F.col("event_id"),
        "user_id": F.col("user_id"),
        "fecha_dt": F.col("ts"),
        "hora": hour,
        "turno_dia": shift_of(hour),
        "modalidad": F.col("event_type"),
        "bien_hurtado": _numbered("Objeto ", F.col("value") / 20),
        "lat": F.col("value"),
    }


def _select(rows: DataFrame, columns: dict[str, Column], *more: str) -> DataFrame:
    return rows.select(*[column.alias(name) for name, column in columns.items()], *more)


def typed_events(events: DataFrame, *more: str) -> DataFrame:
    """Incident columns that follow from the plain columns of an event."""
    return _select(events, _plain_columns(), *more)


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_events(table(spark, sf_dir, "events"))


def detailed_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the columns taken from the JSON property as well: place, age, longitude."""
    k = F.col("k")
    details = {
        "lugar": _numbered("Lugar ", k / 5),
        "edad": k.cast("double"),
        "lon": k.cast("double"),
    }
    return _select(with_k(table(spark, sf_dir, "events")), _plain_columns() | details)


def incidents_in_areas(
    spark: SparkSession, sf_dir: str, events: DataFrame | None = None, *more: str
) -> DataFrame:
    """Typed incidents with the area of the reporting user; ``more`` names
    columns of the events that go along."""
    rows = incidents(spark, sf_dir) if events is None else typed_events(events, *more)
    return lookup(rows, user_areas(spark, sf_dir), "user_id").fillna({"comuna": UNKNOWN_AREA})


def event_messages(events: DataFrame, *more: str) -> DataFrame:
    """JSON messages as a producer sends them: all text, some of it broken.
    ``more`` names columns of the events that go along."""
    k = F.col("k")
    payload = F.to_json(
        F.struct(
            F.when(k == 6, "").otherwise(time_text(k)).alias("fecha_hecho"),
            F.col("user_id").cast("string").alias("comuna"),
            F.col("event_type").alias("modalidad"),
            F.when(k == 4, "").otherwise(k.cast("string")).alias("edad"),
            F.when(k == 2, "abc")
            .when(k == 3, "")
            .otherwise(F.col("value").cast("string"))
            .alias("lat"),
            k.cast("string").alias("lon"),
            F.concat(F.lit("EVT-"), F.col("event_id").cast("string")).alias("event_id"),
            F.hour("ts").alias("hora_hecho"),
            F.lit("events").alias("fuente"),
        )
    )
    broken = F.concat(F.lit("{broken "), F.col("event_id").cast("string"))
    return with_k(events).select(
        F.when(k == 5, broken).otherwise(payload).cast("binary").alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        *more,
    )
