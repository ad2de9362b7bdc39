"""Streaming jobs: event ETL, hourly counts, running risk zones."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState
from pyspark.sql.types import LongType, StringType, StructField, StructType

from incidentia.functions.values import risk_label
from incidentia.operators.joins import BROADCAST_BYTES, SLICE_ROWS, measured_bytes, spread_join
from incidentia.operators.quality import accepted, with_rejection
from incidentia.operators.snapshot import COUNTS, added, section_counts
from incidentia.schemas import HIGH_QUANTILE, MEDIUM_QUANTILE, STREAM_STORE
from incidentia.sinks.commits import CommittedTable
from incidentia.sources.files import as_incidents
from incidentia.sources.stream import POSITION
from incidentia.streaming.events import parse_events, with_stream_parts

TRIGGER = "10 seconds"
# Micro-batches between two packings: some ten minutes.
PACK_EVERY = 60
EVENT_LAYOUT = ("anio", "mes")
COUNTERS = StructType([StructField(n, LongType()) for n in ("lote", "enviados", "errores")])
SIZES = StructType([StructField(n, LongType()) for n in ("total", "groups")])


def _start(writer, checkpoint: str, replay: bool) -> StreamingQuery:
    timed = writer.trigger(availableNow=True) if replay else writer.trigger(processingTime=TRIGGER)
    return timed.option("checkpointLocation", checkpoint).start()


def finish(query: StreamingQuery, seconds: int | None = None) -> None:
    """Wait for a replay to end; raise if it failed. With ``seconds``, as tests
    use it, a replay that takes longer is stopped."""
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"stream still running after {seconds} s")


class EventStore:
    """What the event stream keeps: events, rejected messages, counters and,
    if asked for, the counts that the snapshot is made of.

    Each is a table kept by commits, so a micro-batch that is run again adds
    nothing, and small files are packed while others read.
    """

    def __init__(
        self, spark: SparkSession, path: str, quarantine_path: str | None = None, counts_path: str | None = None
    ):
        base = path.rstrip("/")
        self.events = CommittedTable(spark, base, STREAM_STORE)
        self.rejected = CommittedTable(spark, quarantine_path or f"{base}-quarantine")
        self.counters = CommittedTable(spark, f"{base}-counters", COUNTERS)
        self.counts = None if counts_path is None else CommittedTable(spark, counts_path, COUNTS)

    def add(self, batch: DataFrame, batch_id: int) -> tuple[int, int]:
        """Store one micro-batch; says how many events are good and rejected.

        Both numbers come with the jobs that write the rows. The batch is kept
        while its parts are written, so it is computed once.
        """
        batch.persist()
        try:
            good = with_stream_parts(batch.where("motivo IS NULL").drop("motivo", "_corrupt"))
            stored = self.events.append(good, batch_id, partition_by=EVENT_LAYOUT)
            rejected = self.rejected.append(batch.where("motivo IS NOT NULL"), batch_id)
            if self.counts is not None:
                self.counts.append(section_counts(as_incidents(good)), batch_id)
            if stored + rejected:
                row = [(batch_id, stored, rejected)]
                counted = batch.sparkSession.createDataFrame(row, COUNTERS)
                self.counters.append(counted.coalesce(1), batch_id)
            return stored, rejected
        finally:
            batch.unpersist()

    def pack(self, at_least: int) -> None:
        """Put small parts together, and delete those that no recent reader needs."""
        self.events.pack(at_least=at_least, partition_by=EVENT_LAYOUT)
        self.rejected.pack(at_least=at_least)
        self.counters.pack(lambda rows: rows.coalesce(1), at_least=at_least)
        if self.counts is not None:
            self.counts.pack(added, at_least=at_least)
        for table in (self.events, self.rejected, self.counters, self.counts):
            if table is not None and table.numbers():
                table.remove_old()


def batch_writer(
    path: str,
    quarantine_path: str | None = None,
    report: Callable[[int, int, int], None] | None = None,
    *,
    counts_path: str | None = None,
    pack_every: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """Write the good rows of each micro-batch to the event store in ``path``,
    by year and month, and the rejected ones (with ``motivo``) to the one in
    ``quarantine_path``.

    ``report`` gets batch id, good and rejected rows; ``read_counters`` gives
    the same for all batches so far. After every ``pack_every`` batches small
    files are packed.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        store = EventStore(batch.sparkSession, path, quarantine_path, counts_path)
        stored, rejected = store.add(batch, batch_id)
        if report is not None and stored + rejected:
            report(batch_id, stored, rejected)
        if pack_every is not None and batch_id % pack_every == pack_every - 1:
            store.pack(at_least=2)

    return write


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """``lote, enviados, errores`` of every micro-batch that had messages."""
    return EventStore(spark, path).counters.read()


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """The quarantine of the event store in ``path``."""
    return EventStore(spark, path).rejected.read()


def stream_events(messages: DataFrame) -> DataFrame:
    """Messages to stored event rows, rejected ones left out."""
    return with_stream_parts(accepted(parse_events(messages)))


def stream_etl(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    *,
    quarantine_path: str | None = None,
    replay: bool = False,
    report: Callable[[int, int, int], None] | None = None,
    counts_path: str | None = None,
    pack_every: int | None = PACK_EVERY,
    resent_within: str | None = None,
    position: tuple[str, ...] = POSITION,
) -> StreamingQuery:
    """Parse messages and append every micro-batch to the event store, what is
    rejected to the quarantine: each message is in one of the two.

    With ``resent_within`` a message whose ``position`` came before, so long
    ago at most, is left out.
    """
    sent = messages if resent_within is None else without_resent(messages, resent_within, position)
    rows = with_rejection(parse_events(sent))
    write = batch_writer(path, quarantine_path, report, counts_path=counts_path, pack_every=pack_every)
    return _start(rows.writeStream.foreachBatch(write), checkpoint, replay)


def append_stream(rows: DataFrame, path: str, checkpoint: str, *, replay: bool = False) -> StreamingQuery:
    """Append rows to parquet exactly once, by the file sink's own log."""
    writer = rows.writeStream.format("parquet").option("path", path).outputMode("append")
    return _start(writer, checkpoint, replay)


def without_repeats(events: DataFrame, time: str, delay: str) -> DataFrame:
    """Drop events seen before with the same id, remembering them for ``delay``."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(["event_id"])


def without_resent(
    messages: DataFrame, delay: str, position: tuple[str, ...] = POSITION
) -> DataFrame:
    """Drop messages whose place in the broker was seen before.

    Equal reports at different places are different events and stay. The state
    has one entry per message of the last ``delay``. That time is the one of
    processing, so nothing is dropped for being late, however far behind a
    partition of the topic is.
    """
    seen = messages.withColumn("_seen", F.current_timestamp()).withWatermark("_seen", delay)
    return seen.dropDuplicatesWithinWatermark(list(position)).drop("_seen")


def hourly_counts(events: DataFrame, time: str, key: str, *, delay: str = "1 hour") -> DataFrame:
    """Events per hour and key; an hour is final once ``delay`` has passed."""
    return (
        events.withWatermark(time, delay)
        .groupBy(F.window(time, "1 hour").alias("_hour"), key)
        .agg(F.count("*").alias("total"))
        .select(F.col("_hour.start").alias("desde"), key, "total")
    )


def stream_hourly(
    events: DataFrame,
    path: str,
    checkpoint: str,
    *,
    time: str,
    key: str,
    delay: str = "1 hour",
    replay: bool = False,
) -> StreamingQuery:
    counts = hourly_counts(events, time, key, delay=delay)
    return append_stream(counts, path, checkpoint, replay=replay)


class RunningZones:
    """Counts per group and a histogram of them, both kept by increments.

    A micro-batch adds the new counts of the groups that it changed, and moves
    each of them from its old size to its new one in the histogram, which has
    one row per distinct size: fewer than sqrt(2 N) for N events. The exact
    quantiles follow from the histogram alone.
    """

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.key = key
        shape = StructType([StructField(key, StringType()), StructField("total", LongType())])
        self.groups = CommittedTable(spark, f"{path}/groups", shape)
        self.sizes = CommittedTable(spark, f"{path}/sizes", SIZES)

    def add(self, changed: DataFrame, batch_id: int) -> None:
        """``changed`` has the old and new count of each group it names."""
        changed.persist()
        try:
            moves = F.array(
                F.struct(F.col("old").alias("total"), F.lit(-1).cast("bigint").alias("groups")),
                F.struct(F.col("new").alias("total"), F.lit(1).cast("bigint").alias("groups")),
            )
            moved = self._sizes(changed.select(F.inline(moves)).where("total > 0"))
            self.groups.append(changed.select(self.key, F.col("new").alias("total")), batch_id)
            self.sizes.append(moved, batch_id)
        finally:
            changed.unpersist()

    def _newest(self, rows: DataFrame) -> DataFrame:
        """Counts only grow, so the largest of a group is its newest."""
        return rows.groupBy(self.key).agg(F.max("total").alias("total"))

    @staticmethod
    def _sizes(rows: DataFrame) -> DataFrame:
        return rows.groupBy("total").agg(F.sum("groups").alias("groups")).where("groups <> 0")

    def pack(self, at_least: int) -> None:
        self.groups.pack(self._newest, at_least=at_least)
        self.sizes.pack(self._sizes, at_least=at_least)
        for table in (self.groups, self.sizes):
            if table.numbers():
                table.remove_old()

    def read(self) -> DataFrame:
        sizes = self._sizes(self.sizes.read())

        def cut(quantile: float) -> Column:
            return sizes.agg(F.percentile("total", quantile, F.col("groups"))).scalar()

        cuts = self._newest(self.groups.read()).withColumns(
            {"p75": cut(HIGH_QUANTILE), "p50": cut(MEDIUM_QUANTILE)}
        )
        return cuts.withColumn("zona_riesgo", risk_label(F.col("total"), F.col("p75"), F.col("p50")))


def _grown(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    old = state.get[0] if state.exists else 0
    new = old + sum(int(part["n"].sum()) for part in parts)
    state.update((new,))
    yield pd.DataFrame({"group": [key[0]], "old": [old], "new": [new]})


def _counted_in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counted = pc.value_counts(batch.column(0))
        yield pa.RecordBatch.from_arrays(counted.flatten(), names=["group", "n"])


def changed_counts(events: DataFrame, key: str) -> DataFrame:
    """``key, old, new``: the count of each group that a trigger changes, before
    and after it. Rows are counted in their tasks first, so a group with a
    third of all rows does not send them to one task."""
    named = events.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("group"))
    counted = named.mapInArrow(_counted_in_task, "group string, n bigint")
    changed = counted.groupBy("group").applyInPandasWithState(
        _grown, "group string, old bigint, new bigint", "total bigint", "update", "NoTimeout"
    )
    return changed.withColumnRenamed("group", key)


def stream_risk(
    events: DataFrame,
    path: str,
    checkpoint: str,
    *,
    key: str,
    replay: bool = False,
    pack_every: int = PACK_EVERY,
) -> StreamingQuery:
    """Keep the zone of every group up to date; read them with ``read_zones``.

    A trigger emits and writes only the groups that it changed.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        zones = RunningZones(batch.sparkSession, path, key)
        zones.add(batch, batch_id)
        if batch_id % pack_every == pack_every - 1:
            zones.pack(at_least=2)

    writer = changed_counts(events, key).writeStream.outputMode("update").foreachBatch(write)
    return _start(writer, checkpoint, replay)


def read_zones(spark: SparkSession, path: str, key: str = "comuna") -> DataFrame:
    """Count, quantiles and zone of every group so far."""
    return RunningZones(spark, path, key).read()


def lookup_writer(
    dimension: DataFrame,
    key: str,
    path: str,
    *,
    pack_every: int = PACK_EVERY,
    limit_bytes: int = BROADCAST_BYTES,
    slice_rows: int = SLICE_ROWS,
) -> Callable[[DataFrame, int], None]:
    """Join each micro-batch with ``dimension`` and append the rows to ``path``.

    A small dimension, measured once, is broadcast. For a large one the hot keys
    of each micro-batch, which is a finite table, are counted, and only their
    rows of the dimension are copied.
    """
    small = measured_bytes(dimension) <= limit_bytes

    def joined(batch: DataFrame) -> DataFrame:
        if small:
            return batch.join(F.broadcast(dimension), key, "left")
        return spread_join(batch, dimension, key, slice_rows=slice_rows)

    def write(batch: DataFrame, batch_id: int) -> None:
        table = CommittedTable(batch.sparkSession, path)
        batch.persist()
        try:
            table.append(joined(batch), batch_id)
        finally:
            batch.unpersist()
        if batch_id % pack_every == pack_every - 1:
            table.pack(at_least=2)
            table.remove_old()

    return write


def stream_lookup(
    rows: DataFrame,
    dimension: DataFrame,
    key: str,
    path: str,
    checkpoint: str,
    *,
    replay: bool = False,
    **limits: int,
) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(lookup_writer(dimension, key, path, **limits))
    return _start(writer, checkpoint, replay)
