from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from incidentia.operators import quality, snapshot
from incidentia.operators.clean import clean_stream
from incidentia.operators.risk import risk_zones
from incidentia.plans import standins
from incidentia.schemas import STREAM_STORE
from incidentia.session import scratch_path
from incidentia.sinks.commits import CommittedTable, Part
from incidentia.sources.files import as_incidents, read_events
from incidentia.sources.stream import MESSAGE, file_stream, kafka_messages
from incidentia.streaming import events, jobs

SMALL = "/root/testdata/sf0.001"
AT = dt.datetime(2024, 1, 1)


def messages(spark, *texts):
    return spark.createDataFrame([(bytearray(t, "utf-8"), AT) for t in texts], MESSAGE)


def event(**fields):
    base = {"fecha_hecho": "05/03/2019 07:05", "event_id": "EVT-1", "comuna": "Belén"}
    return json.dumps(base | fields, ensure_ascii=False)


def test_coordinates_quoted_plain_or_blank(spark):
    sent = messages(
        spark, event(lat="6.25"), event(lat=6.25), event(lat=""), event(lat=None, nueva="x"),
        event(lat="abc"), event(comuna=""),
    )
    found = events.parse_events(sent).select("lat", "comuna", "_corrupt")
    assert tuples(found) == [
        (6.25, "Belén", None), (6.25, "Belén", None), (None, "Belén", None),
        (None, "Belén", None), (None, "Belén", None), (None, None, None),
    ]


def test_rejected_events(spark):
    sent = messages(
        spark, event(), "{broken", event(fecha_hecho=""), event(fecha_hecho="sin fecha"),
        event(fecha_hecho="x"), event(fecha_hecho="2019-03-05T07:05"),
    )
    parsed = events.parse_events(sent)
    assert [r.motivo for r in quality.with_rejection(parsed).select("motivo").collect()] == [
        None, "unreadable_json", "no_time", "unreadable_hour", "unreadable_hour", None,
    ]
    assert tuples(quality.acceptance_counts(parsed)) == [(2, 4)]
    assert quality.quarantine(parsed).where("_corrupt = '{broken'").count() == 1
    assert "_corrupt" not in quality.accepted(parsed).columns


def test_envelope(spark):
    rows = spark.createDataFrame(
        [("05/03/2019 07:05", "ñ", ""), ("sin fecha", "", "old")],
        "fecha_hecho string, lugar string, turno_dia string",
    )
    at = F.lit("2024-01-02 03:04:05.000006").cast("timestamp")
    sent = [
        json.loads(bytes(r.value).decode("utf-8"))
        for r in events.to_messages(events.event_envelope(rows, "src", at)).collect()
    ]
    assert sent[0] | {"event_id": ""} == {
        "fecha_hecho": "05/03/2019 07:05", "lugar": "ñ", "turno_dia": "Mañana",
        "timestamp_ingesta": "2024-01-02T03:04:05.000006", "hora_hecho": 7,
        "event_id": "", "fuente": "src",
    }
    assert sent[1]["hora_hecho"] is None and sent[1]["turno_dia"] is None
    assert sent[0]["event_id"].startswith("EVT-") and sent[0]["event_id"] != sent[1]["event_id"]
    again = events.event_envelope(rows, "src").select("event_id").collect()
    assert [r.event_id for r in again] == [m["event_id"] for m in sent]


def stream_of(spark, schema, path, **options):
    return file_stream(spark, path, schema, **options)


def test_etl_stores_what_batch_computes_and_replays_add_nothing(spark):
    source, store = scratch_path(spark, "in"), scratch_path(spark, "out")
    sent = standins.event_messages(standins.table(spark, SMALL, "events"))
    sent.repartition(4).write.parquet(source)
    seen = {}

    def run(checkpoint):
        stream = stream_of(spark, MESSAGE, source, files_per_trigger=1)
        jobs.finish(
            jobs.stream_etl(
                stream, store, checkpoint, replay=True,
                report=lambda number, good, bad: seen.__setitem__(number, (good, bad)),
            ), 300,
        )
        return read_events(spark, store).drop("procesado_en")

    checkpoint = scratch_path(spark, "cp")
    first = run(checkpoint)
    batch = jobs.stream_events(sent).drop("procesado_en")
    assert first.count() == batch.count() == sum(good for good, _ in seen.values())
    aside = jobs.read_rejected(spark, store)
    assert aside.count() == sum(bad for _, bad in seen.values()) > 0
    assert first.count() + aside.count() == sent.count()
    assert len(seen) == 4
    assert first.select(batch.columns).exceptAll(batch).isEmpty()
    counters = sorted(tuples(jobs.read_counters(spark, store)))
    assert counters == sorted((number, good, bad) for number, (good, bad) in seen.items())
    assert sorted(spark.read.parquet(store).drop("commit_part").dtypes) == sorted(
        (f.name, f.dataType.simpleString()) for f in STREAM_STORE
    )
    # The same input again, from the start: the batches are known.
    assert run(scratch_path(spark, "cp")).count() == batch.count()
    # The same checkpoint: nothing is new.
    seen.clear()
    assert run(checkpoint).count() == batch.count() and not seen


def test_empty_batch_is_not_written(spark):
    store = scratch_path(spark, "out")
    reports = []
    nothing = quality.with_rejection(events.parse_events(standins.event_messages(standins.table(spark, SMALL, "events")))).limit(0)
    jobs.batch_writer(store, report=lambda *r: reports.append(r))(nothing, 0)
    assert not reports and read_events(spark, store).isEmpty()
    assert not list(Path(store.removeprefix("file:")).glob("commit_part=*"))


def test_late_events_are_left_out_of_final_hours(spark):
    source, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    schema = "instant timestamp, modalidad string"
    checkpoint = scratch_path(spark, "cp")
    for times in (["12:00", "12:40"], ["14:30"], ["12:10"], ["17:00"]):
        rows = [(f"2024-01-01 {t}:00", "x") for t in times]
        batch = spark.createDataFrame(rows, "t string, modalidad string").select(
            F.col("t").cast("timestamp").alias("instant"), "modalidad"
        )
        batch.coalesce(1).write.mode("append").parquet(source)
        stream = stream_of(spark, spark.createDataFrame([], schema).schema, source)
        jobs.finish(
            jobs.stream_hourly(
                stream, out, checkpoint, time="instant", key="modalidad", replay=True
            ), 300,
        )
    found = spark.read.parquet(out).orderBy("desde")
    assert [(r.desde.hour, r.total) for r in found.collect()] == [(12, 2), (14, 1)]


def test_repeated_ids_within_the_delay_are_dropped(spark):
    source, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    rows = spark.createDataFrame(
        [("a", "12:00"), ("a", "12:00"), ("b", "12:05")], "event_id string, t string"
    ).select("event_id", F.concat(F.lit("2024-01-01 "), "t").cast("timestamp").alias("instant"))
    rows.write.parquet(source)
    stream = jobs.without_repeats(stream_of(spark, rows.schema, source), "instant", "1 hour")
    jobs.finish(jobs.append_stream(stream, out, scratch_path(spark, "cp"), replay=True), 300)
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_messages_sent_again_are_dropped_and_equal_reports_stay(spark):
    source, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "cp"))
    schema = "value string, partition int, offset long"
    for rows in ([("a", 0, 1), ("a", 0, 2), ("b", 1, 1)], [("a", 0, 1), ("c", 0, 3)], [("b", 1, 1), ("c", 2, 3)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = stream_of(spark, spark.createDataFrame([], schema).schema, source)
        kept = jobs.without_resent(stream, "1 hour", ("partition", "offset"))
        jobs.finish(jobs.append_stream(kept, out, checkpoint, replay=True), 300)
    found = sorted(tuples(spark.read.parquet(out).select("value", "partition", "offset")))
    assert found == [("a", 0, 1), ("a", 0, 2), ("b", 1, 1), ("c", 0, 3), ("c", 2, 3)]


# ---- Tables kept by commits ------------------------------------------------------


def numbers_in(table, **options):
    return sorted(r.id for r in table.read(**options).collect())


def committed(spark):
    return CommittedTable(spark, scratch_path(spark, "table"), spark.range(0).schema)


def test_many_small_batches_become_one_part_and_readers_see_each_row_once(spark):
    table = committed(spark)
    assert numbers_in(table) == []
    for batch in range(40):
        assert table.append(spark.range(batch, batch + 1).coalesce(1), batch) == 1
    before = table.read()
    files = sum(p.files for p in table.parts())
    seen = []

    def merge(rows):
        # While a pack runs, a new reader finds what was committed before it.
        seen.append(numbers_in(table))
        assert table.append(spark.range(100, 101), 40) == 1
        return rows

    assert table.pack(merge, at_least=8) == 40
    assert seen == [list(range(40))]
    assert numbers_in(table) == [*range(40), 100]
    assert sorted(r.id for r in before.collect()) == list(range(40))
    assert sum(p.files for p in table.parts()) < files / 5
    assert table.pack(at_least=8) == 0
    # Batches that were packed are still known.
    assert table.append(spark.range(7), 3) == 0 and table.append(spark.range(3), 3, stream="other") == 3
    table.remove_old(keep=1)
    assert len(table.numbers()) == 1 and numbers_in(table) == sorted([*range(40), 100, 0, 1, 2])


def test_the_slower_writer_commits_on_top_of_the_faster_one(spark):
    table, other = committed(spark), None
    table.append(spark.range(1), 0)
    other = CommittedTable(spark, table.path, table.schema)
    write, lost = table._write_commit, []

    def slow(number, parts):
        if not lost:
            lost.append(number)
            other.append(spark.range(10, 11), 1)
        return write(number, parts)

    table._write_commit = slow
    table.append(spark.range(20, 21), 2)
    assert lost == [1] and table.numbers() == [0, 1, 2] and numbers_in(table) == [0, 10, 20]


def test_replacing_a_table_takes_one_step(spark):
    table = committed(spark)
    table.overwrite(spark.range(5))
    broken = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("gone"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="gone"):
        table.overwrite(broken)
    assert numbers_in(table) == list(range(5))
    first = table.numbers()[-1]
    table.overwrite(spark.range(2))
    assert numbers_in(table) == [0, 1] and numbers_in(table, number=first) == list(range(5))
    table.overwrite(spark.range(0))
    assert numbers_in(table) == []


def test_empty_parts_and_batches(spark):
    table = committed(spark)
    assert table.append(spark.range(0), 0) == 0 and table.parts() == []
    assert table.pack(at_least=0) == 0 or numbers_in(table) == []
    assert Part("x", (("s", 2, 4),)).holds("s", 3) and not Part("x", (("s", 2, 4),)).holds("t", 3)


def test_a_batch_that_stopped_half_way_is_finished_once(spark):
    path = scratch_path(spark, "store")
    sent = standins.event_messages(standins.table(spark, SMALL, "events"))
    rows = quality.with_rejection(events.parse_events(sent))
    good = rows.where("motivo IS NULL").count()
    store = jobs.EventStore(spark, path)
    store.rejected.append = lambda *a, **b: 1 / 0
    with pytest.raises(ZeroDivisionError):
        store.add(rows, 0)
    assert read_events(spark, path).count() == good and jobs.read_counters(spark, path).isEmpty()
    jobs.batch_writer(path)(rows, 0)
    assert read_events(spark, path).count() == good
    assert tuples(jobs.read_counters(spark, path)) == [(0, good, rows.count() - good)]


def test_counts_by_increments_equal_a_full_count(spark):
    path, counted = scratch_path(spark, "store"), scratch_path(spark, "counts")
    sent = standins.event_messages(standins.table(spark, SMALL, "events"))
    rows = quality.with_rejection(events.parse_events(sent))
    for number in range(3):
        part = rows.where(F.crc32("event_id") % 3 == number)
        for _ in range(2):  # each batch twice
            jobs.batch_writer(path, counts_path=counted, pack_every=2)(part, number)
    found = snapshot.added(CommittedTable(spark, counted, snapshot.COUNTS).read())
    whole = snapshot.section_counts(as_incidents(read_events(spark, path)))
    assert sorted(map(str, tuples(found))) == sorted(map(str, tuples(whole.select(found.columns))))


def test_zones_by_increments_over_batches_and_packing(spark):
    source, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "cp"))
    draw = [("a", 50), ("b", 20), ("c", 20), ("d", 1), (None, 9)]
    rows = [(k,) for k, n in draw for _ in range(n)]
    for number in range(4):
        more = [(f"n{number}",)] * (3 * number)
        table = spark.createDataFrame(rows[number::4] + more, "comuna string")
        table.write.mode("append").parquet(source)
        stream = stream_of(spark, table.schema, source)
        query = jobs.stream_risk(stream, out, checkpoint, key="comuna", replay=True, pack_every=3)
        jobs.finish(query, 300)
    whole = spark.read.parquet(source).where("comuna IS NOT NULL")
    batch = risk_zones(whole.groupBy("comuna").agg(F.count("*").alias("total")), "comuna")
    assert sorted(tuples(jobs.read_zones(spark, out))) == sorted(tuples(batch))
    zones = jobs.RunningZones(spark, out, "comuna")
    # The last batch wrote only the groups that it changed.
    last = spark.read.parquet(zones.groups._folder_of(zones.groups.parts()[-1].name))
    assert "n1" not in [r.comuna for r in last.collect()]


def test_stream_lookup_with_a_hot_key(spark):
    source, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    rows = spark.range(900).selectExpr("id", "IF(id % 3 = 0, 1, id) AS k", "IF(id = 5, NULL, 'x') AS note")
    rows.write.parquet(source)
    dimension = spark.range(700).selectExpr("id AS k", "concat('name ', id) AS name")
    stream = stream_of(spark, rows.schema, source)
    query = jobs.stream_lookup(
        stream, dimension, "k", out, scratch_path(spark, "cp"), replay=True, limit_bytes=0, slice_rows=50
    )
    jobs.finish(query, 300)
    found = CommittedTable(spark, out).read().select("id", "k", "note", "name")
    want = rows.join(dimension, "k", "left").select("id", "k", "note", "name")
    assert sorted(map(str, tuples(found))) == sorted(map(str, tuples(want)))


def test_running_risk_equals_batch_risk(spark):
    source, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    rows = spark.range(4000).selectExpr("CAST(sqrt(id) / 4 AS STRING) AS z").selectExpr(
        "substring(z, 1, 1) AS comuna"
    )
    rows.repartition(3).write.parquet(source)
    stream = stream_of(spark, rows.schema, source, files_per_trigger=1)
    jobs.finish(
        jobs.stream_risk(stream, out, scratch_path(spark, "cp"), key="comuna", replay=True), 300
    )
    batch = risk_zones(rows.groupBy("comuna").agg(F.count("*").alias("total")), "comuna")
    assert sorted(tuples(jobs.read_zones(spark, out))) == sorted(tuples(batch))


def test_cleaning_a_stream_equals_cleaning_a_batch(spark):
    source, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    raw = standins.raw_incidents(spark, SMALL)
    raw.write.parquet(source)
    stream = clean_stream(stream_of(spark, raw.schema, source), box=standins.STANDIN_BOX)
    jobs.finish(jobs.append_stream(stream, out, scratch_path(spark, "cp"), replay=True), 300)
    batch = clean_stream(raw, box=standins.STANDIN_BOX)
    found = spark.read.parquet(out).select(batch.columns)
    assert found.exceptAll(batch).isEmpty() and batch.exceptAll(found).isEmpty()


def test_failed_stream_raises(spark):
    source = scratch_path(spark, "in")
    spark.range(3).write.parquet(source)
    stream = stream_of(spark, spark.range(0).schema, source)

    def fail(batch, batch_id):
        raise ValueError("store is gone")

    query = (
        stream.writeStream.foreachBatch(fail).trigger(availableNow=True)
        .option("checkpointLocation", scratch_path(spark, "cp")).start()
    )
    with pytest.raises(Exception, match="store is gone"):
        jobs.finish(query, 300)


def test_kafka_source_needs_its_package(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_messages(spark, "localhost:9", "t", per_trigger=10)
