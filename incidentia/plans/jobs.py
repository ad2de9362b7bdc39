"""The four jobs end to end: ingest, publish, process (batch or stream), serve."""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from incidentia.functions.geo import CITY_BOX, Box
from incidentia.operators import snapshot
from incidentia.operators.clean import clean_copies, copies
from incidentia.operators.counts import modes_of
from incidentia.operators.facets import COUNT_VIEWS, FilterSpec, served_counts, views
from incidentia.operators.quality import dq_of_copies
from incidentia.schemas import CLEAN
from incidentia.session import written
from incidentia.sinks.commits import CommittedTable
from incidentia.sinks.tables import (
    Outcome,
    newest_version,
    overwrite_table,
    publish,
    write_clean_table,
    write_delimited,
    write_document,
    write_with_fallback,
)
from incidentia.sources.fallback import NO_DATA, load_first
from incidentia.sources.files import (
    read_clean,
    read_collection,
    read_incidents,
    read_raw,
    read_snapshot,
    read_strings,
)
from incidentia.sources.stream import kafka_messages
from incidentia.streaming.events import event_envelope, to_messages
from incidentia.streaming.jobs import stream_etl

# How long a store may take to give a first row before the next source is asked.
PROBE_SECONDS = 120.0
# How long the place of a message is remembered.
RESENT_WITHIN = "1 hour"


def ingest(
    spark: SparkSession,
    raw_path: str,
    table_path: str,
    log_path: str,
    *,
    csv_path: str | None = None,
    sep: str = ";",
    box: Box = CITY_BOX,
    dedupe_first: bool = False,
    multi_line: bool = False,
    quality_path: str | None = None,
) -> DataFrame:
    """Raw file to clean table and run log; a CSV copy and the quality counters
    on request. Returns the table."""
    raw = read_raw(spark, raw_path, sep=sep, multi_line=multi_line)
    counted = written(copies(raw), "copies")
    rows = clean_copies(counted, box=box, dedupe_first=dedupe_first)
    write_clean_table(rows, table_path)
    stored = read_clean(spark, table_path)
    if csv_path is not None:
        write_delimited(stored, csv_path)
    if quality_path is not None:
        write_document(dq_of_copies(counted, box), quality_path)
    write_document(snapshot.run_log(stored, raw_path, table_path), log_path)
    return stored


def messages_of(spark: SparkSession, csv_path: str, source: str) -> DataFrame:
    """Clean CSV rows as JSON messages."""
    return to_messages(event_envelope(read_strings(spark, csv_path), source))


def publish_events(
    spark: SparkSession, csv_path: str, source: str, servers: str, topic: str
) -> None:
    publish(messages_of(spark, csv_path, source), servers, topic)


def process_batch(
    spark: SparkSession,
    table_path: str,
    source: str,
    snapshot_path: str,
    *,
    store: Callable[[DataFrame], None] | None = None,
    collection_path: str | None = None,
    fallback_path: str | None = None,
    counts_path: str | None = None,
) -> Processed:
    """Clean table to raw collection and aggregates document.

    All groups of the document's lists are counted once. ``counts_path`` keeps
    them uncut, so that ``serve`` can add those of the stream. The leaders of
    the run (most frequent area, shift and so on) follow from them too.

    ``store`` writes the document to an outside store; if that fails it goes
    to ``fallback_path``. Says which of the two was used.
    """
    rows = snapshot.with_age_band(read_clean(spark, table_path))
    if collection_path is not None:
        overwrite_table(rows, collection_path)
    counts = written(snapshot.section_counts(rows), "counts")
    if counts_path is not None:
        CommittedTable(spark, counts_path, snapshot.COUNTS).overwrite(counts.coalesce(1))
    document = snapshot.snapshot_of_counts(counts, source)
    used = write_with_fallback(
        document,
        store or (lambda d: write_document(d, snapshot_path)),
        lambda d: write_document(d, fallback_path or snapshot_path),
    )
    result = Processed(used)
    result.cause = used.cause
    result.leaders = modes_of(counts, LEADERS)
    return result


class Processed(Outcome):
    """Which writer took the document, and the most frequent values of the run."""

    leaders: DataFrame


# Column counted -> name of the leader.
LEADERS = {
    "comuna": "comuna_lider",
    "turno_dia": "turno_lider",
    "modalidad": "modalidad_lider",
    "bien_hurtado": "bien_lider",
}


def stored_counts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The counts of several runs and streams, added up."""
    tables = [CommittedTable(spark, path, snapshot.COUNTS).read() for path in paths]
    return written(snapshot.added(functools.reduce(DataFrame.unionByName, tables)), "counts")


def process_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    store_path: str,
    checkpoint: str,
    *,
    quarantine_path: str | None = None,
    per_trigger: int | None = None,
    counts_path: str | None = None,
    resent_within: str | None = RESENT_WITHIN,
) -> StreamingQuery:
    """Topic to event store until stopped; wait with ``awaitTermination``.

    ``per_trigger`` bounds the messages of one micro-batch. Each adds its
    counters to the store (``read_counters``) and, with ``counts_path``, its
    counts to those that ``serve`` takes. A message that comes twice from one
    place of the topic is stored once.
    """
    messages = kafka_messages(spark, servers, topic, per_trigger=per_trigger)
    return stream_etl(
        messages, store_path, checkpoint, quarantine_path=quarantine_path,
        counts_path=counts_path, resent_within=resent_within,
    )


def load_served(
    spark: SparkSession, store_path: str, csv_path: str, stream_path: str | None = None
) -> DataFrame:
    """The stored collection, with the streamed events if ``stream_path`` is
    given, else the clean CSV, else nothing; see ``source``."""
    sources = [
        ("store", lambda: read_collection(spark, store_path)),
        ("csv", lambda: read_clean(spark, csv_path, fmt="csv")),
    ]
    if stream_path is not None:
        sources.insert(0, ("store+stream", lambda: read_incidents(spark, store_path, stream_path)))
    return load_first(spark, sources, CLEAN, seconds=PROBE_SECONDS)


def serve(
    spark: SparkSession,
    store_path: str,
    csv_path: str,
    spec: FilterSpec = FilterSpec(),
    *,
    stream_path: str | None = None,
    snapshot_path: str | None = None,
    counts_paths: Sequence[str] = (),
    box: Box = CITY_BOX,
) -> dict[str, DataFrame]:
    """Every served table for the selections in ``spec``; the KPIs name the source.

    Without selections, what was counted before is not counted again:
    ``counts_paths`` name the counts of the batch run and of the stream, which
    add up to those of both. Without them the snapshot serves, but not
    together with a stream, as it holds batch rows only.
    """
    rows = load_served(spark, store_path, csv_path, stream_path)
    counted, stored = None, None
    if spec.unfiltered and counts_paths:
        counted = stored_counts(spark, counts_paths)
    elif spec.unfiltered and snapshot_path is not None and stream_path is None:
        if newest_version(spark, snapshot_path) is not None:
            stored = read_snapshot(spark, snapshot_path)
    served = views(rows, spec, box, counted)
    # The label is the same in every row.
    label = rows.select("source").limit(1).agg(F.coalesce(F.max("source"), F.lit(NO_DATA)))
    served["kpis"] = served["kpis"].withColumn("fuente", label.scalar())
    if stored is not None:
        for name in COUNT_VIEWS:
            served[name] = served_counts(rows, spec, name, stored)
    return served
