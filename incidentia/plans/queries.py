"""Registered queries: (spark, data folder) -> DataFrame."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from incidentia.functions import dates, values
from incidentia.operators import clean as cleaning
from incidentia.operators import counts, facets, joins, quality, risk, snapshot, trend
from incidentia.plans import jobs as pipeline
from incidentia.plans import standins
from incidentia.plans.standins import STANDIN_BOX, table
from incidentia.schemas import RAW, UNKNOWN_AREA
from incidentia.session import scratch_path
from incidentia.sinks import tables as sinks
from incidentia.sinks.commits import CommittedTable
from incidentia.sources import fallback, files
from incidentia.streaming import events as messages
from incidentia.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SOURCE_LABEL = "events"
DEFAULT_AREA = {"comuna": UNKNOWN_AREA}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(standins.raw_incidents(spark, sf_dir), box=STANDIN_BOX)


def _area_counts(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    rows = standins.incidents(spark, sf_dir).select("user_id", *more)
    areas = standins.user_areas(spark, sf_dir)
    return joins.counts_by_lookup(rows, areas, "user_id", ["comuna", *more], default=DEFAULT_AREA)


# ---- Counts and top-k ---------------------------------------------------------


@query
def by_area(spark, sf_dir):
    counted = _area_counts(spark, sf_dir).withColumnRenamed("total", "total_hurtos")
    return counts.by_count(counted, "total_hurtos", "comuna")


@query
def by_shift(spark, sf_dir):
    return counts.count_by(standins.incidents(spark, sf_dir), "turno_dia", key_as="turno")


@query
def by_category(spark, sf_dir):
    return counts.count_by(standins.incidents(spark, sf_dir), "modalidad")


@query
def by_hour(spark, sf_dir):
    return counts.count_by_in_key_order(standins.incidents(spark, sf_dir), "hora")


def _item_counts(spark, sf_dir, fact_key, dimension, name):
    """Rows of ``lineitem`` per value of one attribute of a dimension."""
    rows = table(spark, sf_dir, "lineitem").select(fact_key)
    counted = joins.counts_by_lookup(rows, dimension, fact_key, [name])
    return counted.where(F.col(name).isNotNull())


def _parts(spark, sf_dir, column, name):
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col(column).alias(name)
    )


@query
def top_goods(spark, sf_dir):
    counted = _item_counts(spark, sf_dir, "l_partkey", _parts(spark, sf_dir, "p_brand", "bien"), "bien")
    return counts.by_count(counted, "total", "bien", top=10)


@query
def by_weapon(spark, sf_dir):
    counted = _item_counts(spark, sf_dir, "l_partkey", _parts(spark, sf_dir, "p_type", "arma"), "arma")
    return counts.by_count(counted, "total", "arma")


@query
def top_places(spark, sf_dir):
    return counts.count_by(table(spark, sf_dir, "documents"), "source", key_as="lugar", top=8)


@query
def by_sex(spark, sf_dir):
    return counts.count_by(table(spark, sf_dir, "orders"), "o_orderstatus", key_as="sexo")


@query
def age_bands(spark, sf_dir):
    return counts.age_bands(standins.detailed_incidents(spark, sf_dir))


@query
def top_neighbourhoods(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("barrio")
    )
    counted = _item_counts(spark, sf_dir, "l_suppkey", suppliers, "barrio")
    return counts.by_count(counted, "total", "barrio", top=15)


@query
def top_areas_12(spark, sf_dir):
    counted = _area_counts(spark, sf_dir).toDF("Comuna", "Hurtos")
    return counts.by_count(counted, "Hurtos", "Comuna", top=12)


@query
def top_transport(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("Transporte")
    )
    suppliers = (
        table(spark, sf_dir, "supplier")
        .join(nations, "s_nationkey", "left")
        .select(F.col("s_suppkey").alias("l_suppkey"), "Transporte")
    )
    counted = _item_counts(spark, sf_dir, "l_suppkey", suppliers, "Transporte")
    return counts.by_count(counted.toDF("Transporte", "Total"), "Total", "Transporte", top=8)


@query
def multi_dim_counts(spark, sf_dir):
    keys = ["turno_dia", "modalidad", "hora", "bien_hurtado", "lugar"]
    return counts.multi_dim_counts(standins.detailed_incidents(spark, sf_dir), keys, with_all=True)


@query
def kpis(spark, sf_dir):
    """Areas are counted per user before they are looked up."""
    areas = _area_counts(spark, sf_dir).select(
        F.lit("comuna").alias("dimension"), F.col("comuna").alias("value"), "total"
    )
    keys = ["turno_dia", "bien_hurtado"]
    others = counts.multi_dim_counts(standins.incidents(spark, sf_dir), keys, with_all=True)
    return counts.modes_of(others.unionByName(areas), counts.KPI_NAMES, total_as="total_hurtos")


@query
def ingest_summary(spark, sf_dir):
    found = counts.summary(standins.incidents(spark, sf_dir), distinct=("bien_hurtado",))
    areas = _area_counts(spark, sf_dir).agg(F.count("comuna")).scalar()
    return found.withColumn("comuna_distintos", areas)


# ---- Risk, trend, concentration ----------------------------------------------


@query
def risk_zones(spark, sf_dir):
    return risk.risk_zones(_area_counts(spark, sf_dir), "comuna")


def _zoned(spark, sf_dir):
    rows = standins.incidents_in_areas(spark, sf_dir).select("event_id", "comuna")
    return risk.risk_rows(rows, "comuna")


@query
def risk_rows(spark, sf_dir):
    return _zoned(spark, sf_dir).select("event_id", "comuna", "zona_riesgo")


@query
def risk_table(spark, sf_dir):
    """All events of an area are in one zone, so the counts per area are enough."""
    return risk.captioned(risk.risk_zones(_area_counts(spark, sf_dir), "comuna"))


@query
def annual_trend(spark, sf_dir):
    return trend.annual_trend(table(spark, sf_dir, "orders"), "o_orderdate")


@query
def concentration_cube(spark, sf_dir):
    counted = _area_counts(spark, sf_dir, "turno_dia", "modalidad")
    return trend.concentration_cube(counted, ["comuna", "turno_dia", "modalidad"])


@query
def geo_grid(spark, sf_dir):
    return trend.geo_grid(standins.detailed_incidents(spark, sf_dir), 5.0)


# ---- Cleaning and quality ------------------------------------------------------


@query
def clean_incidents(spark, sf_dir):
    return _clean(spark, sf_dir)


@query
def date_parts(spark, sf_dir):
    texts = standins.with_k(table(spark, sf_dir, "events")).select(
        standins.time_text(F.col("k")).alias("fecha_hecho")
    )
    rows = cleaning.with_event_time(texts).where(F.col("fecha_dt").isNotNull())
    parts = rows.withColumns(dates.time_parts(F.col("fecha_dt"))).withColumn(
        "hora_texto", dates.hour_from_text(F.col("fecha_hecho"))
    )
    keys = ["anio", "mes", "hora", "dia_semana", "hora_texto"]
    return parts.groupBy(*keys).agg(F.count("*").alias("total"))


@query
def scalar_suite(spark, sf_dir):
    k = F.col("k")
    rows = standins.with_k(table(spark, sf_dir, "events")).select(
        "event_id", "ts", "event_type", "value", "k"
    )
    rows = rows.withColumn("texto", standins.time_text(k))
    hour = F.hour("ts")
    codes = cleaning.with_area(rows.withColumn("codigo_comuna", k.cast("string")))
    return codes.select(
        "event_id",
        "comuna",
        hour.alias("hora"),
        F.date_format("ts", "EEEE").alias("dia_semana"),
        dates.shift_of(hour).alias("turno_dia"),
        values.to_number(F.when(k == 2, "abc").otherwise(F.col("value").cast("string"))).alias(
            "numero"
        ),
        values.without_sentinel(
            F.when(k < 50, "Sin dato").otherwise(F.concat(F.lit("Sin dato "), "event_type"))
        ).alias("texto_normal"),
        values.age_band(k.cast("double")).alias("rango"),
        dates.hour_from_text(F.col("texto")).alias("hora_texto"),
        F.col("texto").contains(" ").alias("tiene_espacio"),
    )


@query
def geo_repair(spark, sf_dir):
    raw = standins.raw_incidents(spark, sf_dir).select("latitud", "longitud", "nombre_barrio")
    return cleaning.with_coordinates(raw, STANDIN_BOX).select(
        "nombre_barrio", "latitud", "longitud", "lat", "lon"
    )


@query
def dim_lookup(spark, sf_dir):
    coded = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("codigo_comuna")
    )
    return cleaning.with_area(coded)


@query
def dim_lookup_large(spark, sf_dir):
    """The way for dimensions too large to broadcast."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_name"
    )
    return joins.spread_join(rows, customers, "user_id")


@query
def dedupe(spark, sf_dir):
    return cleaning.dedupe(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"
        )
    )


@query
def dq_report(spark, sf_dir):
    return quality.dq_report(standins.raw_incidents(spark, sf_dir), STANDIN_BOX)


# ---- Filters and views ----------------------------------------------------------

SPEC = facets.FilterSpec(
    comuna=("Popular", "Robledo", "Belén", UNKNOWN_AREA),
    turno_dia=("Mañana", "Noche"),
    modalidad=("click", "error", "purchase"),
    hora=(7, 20),
)


@query
def facet_filter(spark, sf_dir):
    rows = standins.incidents_in_areas(spark, sf_dir)
    kept = facets.apply_filters(rows, SPEC)
    return kept.select("event_id", "comuna", "turno_dia", "modalidad", "hora")


@query
def facet_filter_semi(spark, sf_dir):
    rows = standins.incidents_in_areas(spark, sf_dir).select("event_id", "comuna")
    zones = risk.risk_zones(_area_counts(spark, sf_dir), "comuna")
    chosen = zones.where(F.col("zona_riesgo") == "ALTO")
    return facets.apply_selections(rows, {"comuna": chosen})


@query
def facet_values(spark, sf_dir):
    return facets.facet_values(standins.incidents_in_areas(spark, sf_dir), SPEC)


@query
def served_views(spark, sf_dir):
    """All counting views of the filtered rows, one below the other."""
    served = facets.views(standins.incidents_in_areas(spark, sf_dir), SPEC)
    out = None
    for name, view in served.items():
        if len(view.columns) == 2:
            listed = view.toDF("clave", "total").select(
                F.lit(name).alias("vista"), F.col("clave").cast("string"), "total"
            )
            out = listed if out is None else out.unionByName(listed)
    return out


@query
def map_points(spark, sf_dir):
    return facets.map_points(standins.detailed_incidents(spark, sf_dir), STANDIN_BOX)


# ---- Sources and sinks ----------------------------------------------------------


@query
def scan_clean(spark, sf_dir):
    path = scratch_path(spark, "clean")
    sinks.overwrite_table(_clean(spark, sf_dir), path)
    stored = files.read_clean(spark, path)
    return stored.agg(
        F.count("*").alias("filas"), *[F.count(c).alias(c) for c in stored.columns]
    )


@query
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "raw-csv")
    sinks.write_delimited(standins.raw_incidents(spark, sf_dir), path, sep=";")
    return cleaning.normalise_missing(files.read_raw(spark, path))


@query
def clean_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "clean-csv")
    sinks.write_delimited(_clean(spark, sf_dir), path)
    return files.read_clean(spark, path, fmt="csv")


@query
def pruned_box(spark, sf_dir):
    """Incidents within a small box, from a table laid out by place."""
    path = scratch_path(spark, "by-place")
    rows = standins.detailed_incidents(spark, sf_dir).select("event_id", "lat", "lon", "modalidad")
    sinks.write_by_place(rows, path, STANDIN_BOX, files=16)
    near = F.col("lat").between(20, 24) & F.col("lon").between(40, 48)
    return files.read_collection(spark, path).where(near)


@query
def pruned_scan(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("anio"),
        F.month("o_orderdate").alias("mes"),
        F.col("o_orderpriority").alias("comuna"),
        F.col("o_orderdate").alias("fecha_dt"),
        "o_orderkey",
    )
    path = scratch_path(spark, "by-month")
    sinks.write_clean_table(orders, path)
    stored = files.read_collection(spark, path)
    wanted = (F.col("anio") == 1997) & F.col("mes").between(3, 5) & (F.col("comuna") == "2-HIGH")
    return stored.where(wanted)


@query
def source_fallback(spark, sf_dir):
    rows = fallback.load_first(
        spark,
        [
            ("store", lambda: files.read_clean(spark, scratch_path(spark, "absent"))),
            ("files", lambda: standins.incidents(spark, sf_dir)),
        ],
    )
    return rows.select("event_id", "modalidad", "source")


@query
def snapshot_doc(spark, sf_dir):
    """The aggregates document, one row per list entry."""
    return snapshot.snapshot_doc(_clean(spark, sf_dir), SOURCE_LABEL).drop("procesado_en")


@query
def snapshot_read(spark, sf_dir):
    """The document stored, read back, and one served view taken from it."""
    path = scratch_path(spark, "snapshot")
    rows = _clean(spark, sf_dir)
    sinks.write_document(snapshot.snapshot_doc(rows, SOURCE_LABEL), path)
    stored = files.read_snapshot(spark, path)
    lists = [
        files.snapshot_list(stored, name).select(F.lit(name).alias("lista"), "clave", "zona", "total")
        for name in [*snapshot.LISTS, "zona_riesgo"]
    ]
    return functools.reduce(DataFrame.unionByName, lists)


@query
def served_view(spark, sf_dir):
    """A view without filters comes from the snapshot."""
    path = scratch_path(spark, "snapshot")
    rows = _clean(spark, sf_dir)
    sinks.write_document(snapshot.snapshot_doc(rows, SOURCE_LABEL), path)
    stored = files.read_snapshot(spark, path)
    return facets.served_counts(rows, facets.FilterSpec(), "barrios", stored)


@query
def run_log(spark, sf_dir):
    log = snapshot.run_log(_clean(spark, sf_dir), SOURCE_LABEL, "clean")
    return log.where("mapa IS NOT NULL").select(
        "mapa", "clave", "total", "total_registros", F.size("columnas").alias("columnas")
    )


def _ingested(spark, sf_dir):
    """Raw file to table and CSV by the job, as it is run; the paths."""
    raw, table_path, csv_path = (scratch_path(spark, n) for n in ("raw", "table", "csv"))
    sinks.write_delimited(standins.raw_incidents(spark, sf_dir), raw, sep=";")
    pipeline.ingest(
        spark, raw, table_path, scratch_path(spark, "log"), csv_path=csv_path, box=STANDIN_BOX
    )
    return table_path, csv_path


@query
def ingest_job(spark, sf_dir):
    """All columns of the table that the job stores, in order."""
    table_path, _ = _ingested(spark, sf_dir)
    return files.read_clean(spark, table_path)


@query
def served_from_csv(spark, sf_dir):
    """KPIs of the job's CSV branch."""
    _, csv_path = _ingested(spark, sf_dir)
    served = pipeline.serve(spark, scratch_path(spark, "absent"), csv_path, box=STANDIN_BOX)
    return served["kpis"].select("total_hurtos", "fuente")


def _batch_and_stream(spark, sf_dir):
    """The collection of the batch job and the store of the stream; the paths.

    The stream runs beside the batch job, as neither reads what the other writes:
    one takes the cores that short steps and last tasks of the other leave idle.
    """
    store, streamed = scratch_path(spark, "collection"), scratch_path(spark, "stream-events")
    sent = standins.event_messages(standins.event_stream(spark, sf_dir))
    stream = jobs.stream_etl(sent, streamed, scratch_path(spark, "checkpoint"), replay=True)
    try:
        table_path, _ = _ingested(spark, sf_dir)
        pipeline.process_batch(
            spark, table_path, SOURCE_LABEL, scratch_path(spark, "snapshot"), collection_path=store
        )
        jobs.finish(stream)
    finally:
        stream.stop()
    return store, streamed


@query
def incidents_union(spark, sf_dir):
    """Batch and stream events under one schema."""
    rows = files.read_incidents(spark, *_batch_and_stream(spark, sf_dir))
    return rows.groupBy("origen", "modalidad", "hora").agg(
        F.count("*").alias("total"), F.count("edad").alias("con_edad"), F.sum("edad").alias("edades")
    )


@query
def served_job(spark, sf_dir):
    """The views that the job serves over batch and stream, and the KPIs' source."""
    store, streamed = _batch_and_stream(spark, sf_dir)
    served = pipeline.serve(
        spark, store, scratch_path(spark, "absent"), stream_path=streamed, box=STANDIN_BOX
    )
    listed = served["modalidades"].toDF("clave", "total")
    label = served["kpis"].select(F.col("fuente").alias("clave"), F.col("total_hurtos").alias("total"))
    return listed.unionByName(label)


# ---- Events ---------------------------------------------------------------------


def _parsed(spark, sf_dir):
    sent = standins.event_messages(table(spark, sf_dir, "events"))
    return messages.parse_events(sent)


# Compared columns of stored events: all but the time of processing.
EVENT_COLUMNS = [
    "event_id", "fecha_hecho", "comuna", "modalidad", "edad", "lat", "lon",
    "anio", "mes", "hora_num", "fecha_dt",
]


@query
def json_events(spark, sf_dir):
    rows = messages.with_stream_parts(quality.accepted(_parsed(spark, sf_dir)))
    return rows.select(*EVENT_COLUMNS, F.col("kafka_ts").cast("timestamp_ntz").alias("kafka_ts"))


@query
def quarantine(spark, sf_dir):
    rejected = quality.quarantine(_parsed(spark, sf_dir))
    return rejected.select("event_id", "fecha_hecho", F.col("_corrupt").alias("texto"), "motivo")


@query
def acceptance_counts(spark, sf_dir):
    return quality.acceptance_counts(_parsed(spark, sf_dir))


@query
def event_envelope(spark, sf_dir):
    """Text rows to JSON messages, and the messages' fields again."""
    path = scratch_path(spark, "rows-csv")
    sinks.write_delimited(standins.raw_incidents(spark, sf_dir), path)
    rows = files.read_strings(spark, path)
    sent = messages.to_messages(messages.event_envelope(rows, SOURCE_LABEL))
    fields = [*RAW.fieldNames(), "turno_dia", "event_id", "fuente"]
    shape = StructType()
    for name in fields:
        shape = shape.add(name, StringType())
    shape = shape.add("hora_hecho", IntegerType())
    return sent.select(F.from_json(F.col("value").cast("string"), shape).alias("d")).select("d.*")


# ---- Streams ----------------------------------------------------------------------


def _streamed(spark, sf_dir, *, more=(), source=None, **options) -> str:
    """Messages to the event store in several micro-batches, each after a start
    from the checkpoint; the store's path."""
    path, checkpoint = scratch_path(spark, "stream-events"), scratch_path(spark, "checkpoint")
    sent = standins.event_messages(standins.in_parts(spark, sf_dir), "_part") if source is None else source
    standins.replay(
        spark,
        sent,
        lambda stream: jobs.stream_etl(stream, path, checkpoint, replay=True, **options),
        path=scratch_path(spark, "sent"),
    )
    return path


def _stored(events: DataFrame) -> DataFrame:
    return events.select(*EVENT_COLUMNS, F.col("kafka_ts").cast("timestamp_ntz").alias("kafka_ts"))


@query
def stream_etl(spark, sf_dir):
    """The events of several micro-batches, with a stop and a start between them."""
    return _stored(files.read_events(spark, _streamed(spark, sf_dir, pack_every=None)))


@query
def stream_restart(spark, sf_dir):
    """Events and rejected messages per micro-batch, when the last batch is run
    a second time after its parts were committed, as after a crash."""
    path = _streamed(spark, sf_dir, pack_every=None)
    again = standins.in_parts(spark, sf_dir).where(F.col("_part") == standins.PARTS - 1)
    rows = quality.with_rejection(messages.parse_events(standins.event_messages(again)))
    jobs.batch_writer(path)(rows, standins.PARTS - 1)
    events, aside = files.read_events(spark, path), jobs.read_rejected(spark, path)
    return jobs.read_counters(spark, path).withColumns(
        {
            "guardados": events.agg(F.count("*")).scalar(),
            "apartados": aside.agg(F.count("*")).scalar(),
        }
    )


@query
def stream_compacted(spark, sf_dir):
    """The events after packing, and those that a reader from before still finds."""
    path = _streamed(spark, sf_dir, pack_every=None)
    before = files.read_events(spark, path)
    store = jobs.EventStore(spark, path)
    files_before = sum(p.files for p in store.events.parts())
    store.pack(at_least=2)
    parts = store.events.parts()
    assert len(parts) == 1 and parts[0].files < files_before
    return _stored(files.read_events(spark, path)).unionByName(_stored(before))


@query
def stream_dedup(spark, sf_dir):
    """Messages sent again are stored once; equal reports at other places stay."""
    events = standins.in_parts(spark, sf_dir)
    places = events.withColumn("place", F.col("event_id"))
    resent = places.where(F.col("event_id") % 3 == 0).withColumn("_part", F.lit(standins.PARTS - 1))
    equal = places.where(F.col("event_id") % 5 == 0).withColumn("place", -1 - F.col("event_id"))
    sent = standins.event_messages(places.unionByName(resent).unionByName(equal), "_part", "place")
    placed = standins.with_position(sent, F.col("place")).drop("place")
    path = _streamed(spark, sf_dir, source=placed, resent_within="1 hour")
    return _stored(files.read_events(spark, path))


@query
def stream_counters(spark, sf_dir):
    """Messages stored and set aside, as the running job counted them."""
    return jobs.read_counters(spark, _streamed(spark, sf_dir, pack_every=2))


@query
def snapshot_incremental(spark, sf_dir):
    """The document from the counts that each micro-batch added."""
    counted = scratch_path(spark, "stream-counts")
    _streamed(spark, sf_dir, counts_path=counted, pack_every=3)
    counts = pipeline.stored_counts(spark, [counted])
    return snapshot.snapshot_of_counts(counts, SOURCE_LABEL).drop("procesado_en")


@query
def stream_lookup_large(spark, sf_dir):
    """Events by area, looked up per micro-batch in a dimension that is not broadcast."""
    path, checkpoint = scratch_path(spark, "stream-areas"), scratch_path(spark, "checkpoint")
    rows = standins.in_parts(spark, sf_dir).select("event_id", "user_id", "_part")
    areas = standins.user_areas(spark, sf_dir)
    standins.replay(
        spark,
        rows,
        lambda stream: jobs.stream_lookup(
            stream, areas, "user_id", path, checkpoint, replay=True, limit_bytes=0, slice_rows=20
        ),
        path=scratch_path(spark, "sent"),
    )
    found = CommittedTable(spark, path).read().fillna(DEFAULT_AREA)
    return counts.by_count(found.groupBy("comuna").agg(F.count("*").alias("total")), "total", "comuna")


@query
def stream_quarantine(spark, sf_dir):
    """What the stream sets aside."""
    rejected = jobs.read_rejected(spark, _streamed(spark, sf_dir, pack_every=None))
    return rejected.select("event_id", "fecha_hecho", F.col("_corrupt").alias("texto"), "motivo")


@query
def stream_clean(spark, sf_dir):
    path = scratch_path(spark, "stream-clean")
    raw = standins.raw_incidents(spark, sf_dir, standins.event_stream(spark, sf_dir))
    rows = cleaning.clean_stream(raw, box=STANDIN_BOX)
    jobs.finish(jobs.append_stream(rows, path, scratch_path(spark, "checkpoint"), replay=True))
    return spark.read.schema(rows.schema).parquet(path)


@query
def stream_hourly(spark, sf_dir):
    """Final hours of a stream in several micro-batches with late events."""
    path, checkpoint = scratch_path(spark, "stream-hourly"), scratch_path(spark, "checkpoint")
    rows = standins.in_parts(spark, sf_dir).select(
        F.col("ts").cast("timestamp").alias("instant"), F.col("event_type").alias("modalidad"), "_part"
    )
    standins.replay(
        spark,
        rows,
        lambda stream: jobs.stream_hourly(
            stream, path, checkpoint, time="instant", key="modalidad", replay=True
        ),
        path=scratch_path(spark, "sent"),
    )
    stored = spark.read.parquet(path)
    return stored.withColumn("desde", F.col("desde").cast("timestamp_ntz"))


@query
def stream_risk(spark, sf_dir):
    """Zones kept up to date over several micro-batches."""
    path, checkpoint = scratch_path(spark, "stream-risk"), scratch_path(spark, "checkpoint")
    rows = standins.incidents_in_areas(spark, sf_dir, standins.in_parts(spark, sf_dir), "_part")
    standins.replay(
        spark,
        rows.select("comuna", "_part"),
        lambda stream: jobs.stream_risk(stream, path, checkpoint, key="comuna", replay=True, pack_every=3),
        path=scratch_path(spark, "sent"),
    )
    return jobs.read_zones(spark, path)
