"""JSON events: building, serialising, parsing. For batch and stream alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from incidentia.functions.dates import hour_from_text, iso_text, parse_event_time, shift_of
from incidentia.functions.values import blank_to_null, to_number
from incidentia.schemas import EVENT

_FIELD_MARK = "\u001f"


def event_id(columns: list[str]) -> Column:
    """Identity of an event from its fields.

    128 bits, because 64 would already collide at some billions of events.
    """
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.concat(F.lit("EVT-"), F.md5(F.concat_ws(_FIELD_MARK, *fields)))


def event_envelope(rows: DataFrame, source: str, ingested_at: Column | None = None) -> DataFrame:
    """String rows plus ingest time, shift, hour, event id and source.

    Hour and shift are null where the time text holds no hour.
    """
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    hour = hour_from_text(F.col("fecha_hecho"))
    return rows.withColumns(
        {
            "timestamp_ingesta": iso_text(stamp),
            "turno_dia": shift_of(hour),
            "hora_hecho": hour,
            "event_id": event_id(rows.columns),
            "fuente": F.lit(source),
        }
    )


def to_messages(events: DataFrame) -> DataFrame:
    """One UTF-8 JSON object per row, absent values as JSON null."""
    text = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return events.select(text.cast("binary").alias("value"))


def parse_events(messages: DataFrame) -> DataFrame:
    """Event fields, ``kafka_ts``, and ``_corrupt``: the text that was no JSON.

    The parsed struct goes through a generator so that later filters on its
    fields do not parse the text again.
    """
    shape = StructType(list(EVENT.fields)).add("_corrupt", StringType())
    read = F.from_json("json_str", shape, {"columnNameOfCorruptRecord": "_corrupt"})
    parsed = messages.selectExpr(
        "CAST(value AS STRING) AS json_str", "timestamp AS kafka_ts"
    ).select(F.inline(F.array(read)), "kafka_ts")
    filled = {c: blank_to_null(F.col(c)) for c in EVENT.fieldNames() if c not in ("lat", "lon")}
    numbers = {c: to_number(F.col(c)) for c in ("lat", "lon")}
    return parsed.withColumns({**filled, **numbers})


def with_stream_parts(events: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Event time, its parts and the processing time."""
    stamp = F.current_timestamp() if processed_at is None else processed_at
    timed = events.withColumn("fecha_dt", parse_event_time(F.col("fecha_hecho")))
    return timed.withColumns(
        {
            "anio": F.year("fecha_dt"),
            "mes": F.month("fecha_dt"),
            "hora_num": F.hour("fecha_dt"),
            "procesado_en": stamp,
        }
    )
