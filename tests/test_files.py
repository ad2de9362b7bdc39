"""Sources, sinks, documents and the jobs that connect them."""

from __future__ import annotations

import datetime as dt
import json
import time
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import tuples
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from incidentia.functions.geo import Box
from incidentia.operators import facets, snapshot
from incidentia.operators.clean import clean, normalise_missing
from incidentia.operators.counts import modes
from incidentia.plans import jobs
from incidentia.plans.standins import STANDIN_BOX, raw_incidents
from incidentia.schemas import CLEAN, RAW, RUN_LOG, SNAPSHOT
from incidentia.session import scratch_path, written
from incidentia.sinks import tables as sinks
from incidentia.sources import fallback, files

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return written(clean(raw_incidents(spark, SMALL), box=STANDIN_BOX), "test-clean")


def same(left, right):
    assert left.columns == right.columns
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_raw_file_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        "fecha_hecho;codigo_comuna;otra\n05/03/2019 07:05;10;\n;NA;x\n", encoding="utf-8-sig"
    )
    found = files.read_raw(spark, str(path))
    assert found.columns == ["fecha_hecho", "codigo_comuna", "otra"]
    assert {t for _, t in found.dtypes} == {"string"}
    assert tuples(normalise_missing(found)) == [
        ("05/03/2019 07:05", "10", None), (None, None, "x"),
    ]


def test_quoted_cells_with_line_breaks(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('fecha_hecho;lugar\n"a";"two\nlines"\n', encoding="utf-8-sig")
    assert tuples(files.read_raw(spark, str(path), multi_line=True)) == [("a", "two\nlines")]


@pytest.mark.parametrize("read", [files.read_raw, files.read_strings, files.read_clean])
def test_missing_file_fails_at_once_with_a_hint(spark, read):
    with pytest.raises(FileNotFoundError, match="does not exist"):
        read(spark, "/tmp/no-such-file-of-incidents")


def test_string_rows_have_blanks_for_empty_cells(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text('a,b\n1,\n,"x ""y"", z"\n')
    assert tuples(files.read_strings(spark, str(path))) == [("1", ""), ("", 'x "y", z')]


def test_clean_table_and_csv_roundtrip(spark, rows):
    table, csv = scratch_path(spark, "t"), scratch_path(spark, "c")
    sinks.write_clean_table(rows, table)
    sinks.write_delimited(rows, csv)
    same(rows, files.read_clean(spark, table))
    same(rows, files.read_clean(spark, csv, fmt="csv"))


def test_clean_table_prunes_folders_and_pushes_filters(spark, rows):
    path = scratch_path(spark, "t")
    sinks.write_clean_table(rows, path)
    wanted = files.read_clean(spark, path).where(
        "anio = 2024 AND mes = 1 AND comuna = 'Popular'"
    ).select("hora")
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(anio" in plan
    assert "EqualTo(comuna,Popular)" in plan
    assert "ReadSchema: struct<hora:int,comuna:string>" in plan


def test_collection_is_replaced_and_id_dropped(spark, table):
    path = scratch_path(spark, "coll")
    sinks.overwrite_table(table([("x", 1), ("y", 2)], "_id string, v int"), path)
    sinks.overwrite_table(table([("z", 3)], "_id string, v int"), path)
    assert tuples(files.read_collection(spark, path)) == [(3,)]


def test_fallback_order_and_label(spark, rows):
    absent = ("store", lambda: files.read_clean(spark, "/tmp/no-such-store"))
    empty = ("empty", lambda: rows.limit(0))
    good = ("files", lambda: rows)
    found = fallback.load_first(spark, [absent, empty, good])
    assert {r.source for r in found.select("source").collect()} == {"files"}
    nothing = fallback.load_first(spark, [absent, empty])
    assert nothing.count() == 0 and nothing.columns == [*CLEAN.fieldNames(), "source"]


def test_sink_falls_back_when_the_store_fails(spark, table):
    path = scratch_path(spark, "doc")
    document = table([(1,)], "v int")

    def absent_store(df):
        df.write.format("no-such-store").save()

    class StoreError(Exception):
        pass

    def broken_store(df):
        raise StoreError("no connection")

    for store in (absent_store, broken_store):
        used = sinks.write_with_fallback(document, store, lambda d: sinks.write_document(d, path))
        assert used == "fallback" and used.cause is not None
        assert tuples(files.read_document(spark, path, document.schema)) == [(1,)]
    found = fallback.load_first(
        spark, [("broken", lambda: broken_store(None)), ("files", lambda: document)]
    )
    assert found.first().source == "files"
    assert sinks.write_with_fallback(document, lambda d: None, absent_store) == "primary"


def test_snapshot_document(spark, rows):
    found = snapshot.snapshot_doc(rows, "test")
    assert [(f.name, f.dataType.simpleString()) for f in found.schema] == [
        (f.name, f.dataType.simpleString()) for f in SNAPSHOT
    ]
    entries = found.collect()
    assert {e.total_eventos for e in entries} == {rows.count()} and {e.fuente for e in entries} == {"test"}
    totals = {n: [e.total for e in entries if e.lista == n] for n in (*snapshot.LISTS, "zona_riesgo")}
    assert (len(totals["por_barrio"]), len(totals["por_lugar"]), len(totals["por_bien"])) == (15, 8, 10)
    for name in ("por_comuna", "por_turno", "por_modalidad", "por_arma", "por_hora", "zona_riesgo"):
        assert sum(totals[name]) == rows.count(), name


def test_snapshot_is_written_and_read_back(spark, rows):
    path = scratch_path(spark, "snap")
    made = written(snapshot.snapshot_doc(rows, "test"), "doc")
    sinks.write_document(made, path)
    same(made, files.read_snapshot(spark, path))
    assert files.snapshot_list(made, "por_turno").columns == ["clave", "zona", "total"]


def test_readers_always_find_a_complete_version(spark, rows):
    path = scratch_path(spark, "snap")
    made = written(snapshot.snapshot_doc(rows, "test"), "doc")
    for number in range(20):
        sinks.write_document(made.withColumn("fuente", F.lit(str(number))), path)
        reader = files.read_snapshot(spark, path)
        assert {r.fuente for r in reader.select("fuente").distinct().collect()} == {str(number)}
    assert sinks.versions(spark, path) == [18, 19]
    # An unfinished version is not read.
    Path(path.removeprefix("file:"), "version=20").mkdir()
    assert sinks.newest_version(spark, path) == 19


def test_snapshot_of_no_rows(spark):
    document = snapshot.snapshot_doc(spark.createDataFrame([], CLEAN), "test").collect()
    assert [(e.lista, e.total, e.total_eventos) for e in document] == [("por_edad", 0, 0)] * 6
    log = snapshot.run_log(spark.createDataFrame([], CLEAN), "in", "out").collect()
    assert [(e.mapa, e.total_registros) for e in log] == [(None, 0)]


def test_lists_have_no_longest_length(spark, rows):
    many = spark.range(200_000).select(F.concat(F.lit("a"), "id").alias("comuna"))
    wide = many.unionByName(rows.limit(0), allowMissingColumns=True).select(rows.columns)
    found = snapshot.snapshot_doc(wide, "test").where("lista = 'por_comuna'")
    assert found.count() == 200_000
    assert snapshot.run_log(wide, "in", "out").where("mapa = 'comunas'").count() == 200_000


def test_run_log(spark, rows):
    found = snapshot.run_log(rows, "in", "out")
    assert found.columns == RUN_LOG.fieldNames()
    log = found.collect()
    assert {e.total_registros for e in log} == {rows.count()}
    for name in ("comunas", "modalidades"):
        assert sum(e.total for e in log if e.mapa == name) == rows.count()
    assert log[0].columnas == CLEAN.fieldNames() and log[0].archivo_salida == "out"
    assert log[0].timestamp[10] == "T"


def test_quoted_cells_and_outer_blanks_survive(spark, table):
    path = scratch_path(spark, "cells")
    cells = [('Bar "El Sol"; centro', " a ", "back\\slash"), ("b", "c", None)]
    rows = table(cells, "x string, y string, z string")
    sinks.write_delimited(rows, path, sep=";")
    same(rows, files.read_raw(spark, path))


def test_doubled_quotes_in_a_raw_cell(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('lugar;modalidad\n"Bar ""El Sol""; centro";Atraco\n', encoding="utf-8-sig")
    assert tuples(files.read_raw(spark, str(path))) == [('Bar "El Sol"; centro', "Atraco")]


def test_another_header_order_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x;y\n1;2\n")
    (tmp_path / "b.csv").write_text("y;x\n3;4\n5;6\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_raw(spark, str(tmp_path)).collect()


def test_views_equal_their_single_queries(spark, rows):
    spec = facets.FilterSpec(turno_dia=("Mañana", "Tarde"), hora=(8, 16))
    served = facets.views(rows, spec, STANDIN_BOX)
    assert set(served) == {*facets.COUNT_VIEWS, "kpis", "horas", "riesgo", "mapa"}
    kept = facets.apply_filters(rows, spec)
    for name in facets.COUNT_VIEWS:
        assert tuples(served[name]) == tuples(facets.served_counts(rows, spec, name)), name
    assert served["kpis"].first() == facets.views(kept)["kpis"].first()
    assert [r.Hora for r in served["horas"].collect()] == list(range(8, 17))
    assert served["mapa"].count() == kept.where("lat IS NOT NULL").count()


def test_unfiltered_view_comes_from_the_snapshot(spark, rows):
    stored = written(snapshot.snapshot_doc(rows, "test"), "doc")
    for name in facets.COUNT_VIEWS:
        plain = facets.served_counts(rows, facets.FilterSpec(), name)
        assert tuples(facets.served_counts(rows, facets.FilterSpec(), name, stored)) == tuples(plain)


def test_filters(table):
    rows = table(
        [("A", "x", "7"), ("A", "y", None), ("B", "x", "12"), ("C", "x", "abc")],
        "comuna string, modalidad string, hora string",
    )
    found = lambda **spec: sorted(
        r.comuna for r in facets.apply_filters(rows, facets.FilterSpec(**spec)).collect()
    )
    assert found() == ["A", "B"]
    assert found(comuna=("A", "B")) == ["A", "B"]
    assert found(comuna=("A", "C"), modalidad=("x",)) == ["A"]
    assert found(hora=(8, 23)) == ["B"]
    assert found(sexo=("no such column",)) == ["A", "B"]


def test_facet_lists_follow_earlier_selections(table):
    rows = table(
        [("A", "t1", "x", "h"), ("A", "t2", "y", "m"), ("B", "t1", "z", None), (None, "t1", "w", "o")],
        "comuna string, turno_dia string, modalidad string, sexo string",
    )
    spec = facets.FilterSpec(comuna=("A",), turno_dia=("t1", "t2"), modalidad=("y",))
    assert tuples(facets.facet_values(rows, spec)) == [
        ("comuna", "A"), ("comuna", "B"), ("modalidad", "x"), ("modalidad", "y"), ("sexo", "m"),
    ]


def test_batch_and_stream_tables_share_a_schema(spark, rows, table):
    batch, stream = scratch_path(spark, "b"), scratch_path(spark, "s")
    sinks.overwrite_table(snapshot.with_age_band(rows), batch)
    event = "event_id string, comuna string, edad string, hora_num int, hora string, batch_id int"
    sinks.overwrite_table(table([("EVT-1", "Popular", "30", 5, "5", 0)], event), stream)
    both = files.read_incidents(spark, batch, stream)
    assert both.count() == rows.count() + 1
    assert both.where("origen = 'stream'").select("comuna", "edad", "hora").first() == ("Popular", 30.0, 5)


def test_jobs_end_to_end(spark, tmp_path):
    raw = scratch_path(spark, "raw")
    sinks.write_delimited(raw_incidents(spark, SMALL), raw, sep=";")
    at = {n: scratch_path(spark, n) for n in ("table", "log", "csv", "snap", "store")}
    stored = jobs.ingest(
        spark, raw, at["table"], at["log"], csv_path=at["csv"], box=STANDIN_BOX
    )
    same(clean(raw_incidents(spark, SMALL), box=STANDIN_BOX), stored)
    assert files.read_document(spark, at["log"], RUN_LOG).first().total_registros == stored.count()
    same(stored, files.read_clean(spark, at["csv"], fmt="csv"))

    counted = scratch_path(spark, "counts")
    for _ in range(2):  # a second run replaces the first one's counts
        used = jobs.process_batch(
            spark, at["table"], "test", at["snap"], collection_path=at["store"], counts_path=counted
        )
    assert used == "primary"
    leaders = {"comuna": "comuna_lider", "turno_dia": "turno_lider", "modalidad": "modalidad_lider",
               "bien_hurtado": "bien_lider"}
    assert tuples(used.leaders) == tuples(modes(stored, leaders))
    assert files.read_snapshot(spark, at["snap"]).first().total_eventos == stored.count()
    assert files.read_collection(spark, at["store"]).columns.count("rango_edad") == 1

    served = jobs.serve(spark, at["store"], at["csv"])
    kpis = served["kpis"].first()
    assert (kpis.total_hurtos, kpis.fuente) == (stored.count(), "store")
    from_snapshot = jobs.serve(spark, at["store"], at["csv"], snapshot_path=at["snap"])
    for name in facets.COUNT_VIEWS:
        assert tuples(from_snapshot[name]) == tuples(served[name]), name
    from_counts = jobs.serve(spark, at["store"], at["csv"], counts_paths=[counted])
    assert set(from_counts) == set(served)
    for name in set(served) - {"mapa"}:
        assert sorted(map(str, tuples(from_counts[name]))) == sorted(map(str, tuples(served[name]))), name
    from_csv = jobs.load_served(spark, "/tmp/no-such-store", at["csv"])
    assert {r.source for r in from_csv.select("source").distinct().collect()} == {"csv"}

    sent = [json.loads(r.value) for r in jobs.messages_of(spark, at["csv"], "test").collect()]
    assert len(sent) == stored.count()
    assert set(sent[0]) == {
        *CLEAN.fieldNames(), "timestamp_ingesta", "hora_hecho", "event_id", "fuente",
    }
    assert len({m["event_id"] for m in sent}) == len(sent)


def test_publishing_needs_the_kafka_package(spark, table):
    messages = table([(b"{}",)], "value binary")
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        sinks.publish(messages, "localhost:9", "t")


def test_scratch_is_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert path.startswith(base) if base else Path(path).parent.exists()
    assert scratch_path(spark, "x") != path


def test_every_raw_column_is_text():
    assert {f.dataType.simpleString() for f in RAW} == {"string"}


def test_non_ascii_text_survives(spark, rows):
    assert rows.where(F.col("bien_hurtado") == "Sin dato mercancías").count() > 0


def test_top_lists_are_cut_before_their_shuffle(spark, rows):
    plan = snapshot.sections(rows)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_a_failed_write_leaves_the_clean_table(spark, table):
    path = scratch_path(spark, "clean")
    row = "anio int, mes int, comuna string, fecha_dt timestamp_ntz"
    at = dt.datetime(2019, 3, 5)
    sinks.write_clean_table(table([(2019, 3, "a", at)], row), path)
    reader = files.read_collection(spark, path)
    again = table([(2019, 3, "b", at), (2019, 4, "c", at)], row)
    broken = again.withColumn("comuna", F.when(F.col("mes") == 4, F.raise_error(F.lit("gone"))).otherwise("b"))
    with pytest.raises(Exception, match="gone"):
        sinks.write_clean_table(broken, path)
    assert [r.comuna for r in files.read_collection(spark, path).collect()] == ["a"]
    sinks.write_clean_table(again, path)
    assert sorted(r.comuna for r in files.read_collection(spark, path).collect()) == ["b", "c"]
    assert [r.comuna for r in reader.collect()] == ["a"]


def test_replaced_tables_keep_two_versions(spark):
    path = scratch_path(spark, "table")
    for n in range(5):
        sinks.overwrite_table(spark.range(n), path)
    assert len(list(Path(path).glob("commit_part=*"))) == 2
    sinks.overwrite_table(spark.range(0), path)
    assert files.read_collection(spark, path).columns == ["id"]


def test_a_small_box_reads_few_files(spark):
    path = scratch_path(spark, "by-place")
    box = Box(0.0, 100.0, 0.0, 100.0)
    rows = spark.range(20_000).selectExpr(
        "id", "CAST(crc32(CAST(id AS STRING)) % 1000 AS DOUBLE) / 10 AS lat",
        "CAST(crc32(CAST(-id AS STRING)) % 1000 AS DOUBLE) / 10 AS lon",
    )
    odd = spark.createDataFrame([(-1, None, 5.0), (-2, 5.0, None), (-3, -9.0, 500.0)], rows.schema)
    sinks.write_by_place(rows.unionByName(odd), path, box, files=64)
    stored = files.read_collection(spark, path)
    same(rows.unionByName(odd), stored)
    touched = 0
    parts = list(Path(path).rglob("*.parquet"))
    for file in parts:
        group = pq.ParquetFile(file).metadata.row_group(0)
        held = {group.column(i).path_in_schema: group.column(i).statistics for i in range(group.num_columns)}
        touched += all(held[c].has_min_max and held[c].min <= 30 and held[c].max >= 25 for c in ("lat", "lon"))
    assert len(parts) >= 60 and touched <= 4
    near = stored.where("lat BETWEEN 25 AND 30 AND lon BETWEEN 25 AND 30")
    assert "PushedFilters: [IsNotNull(lat)" in near._jdf.queryExecution().toString()


def test_a_store_that_hangs_falls_back_in_time(spark):
    def never(batches):
        time.sleep(120)
        yield from batches

    hangs = ("store", lambda: spark.range(4).mapInArrow(never, "id long"))
    begin = time.monotonic()
    found = fallback.load_first(spark, [hangs, ("csv", lambda: spark.range(2))], spark.range(0).schema, seconds=2)
    assert [r.source for r in found.collect()] == ["csv"] * 2 and time.monotonic() - begin < 60
    with pytest.raises(ZeroDivisionError):
        fallback.within(spark, 60, lambda: 1 / 0)
    assert fallback.within(spark, 60, lambda: spark.range(3).count()) == 3
    wrote = []
    used = sinks.write_with_fallback(
        spark.range(1), lambda d: wrote.append("primary"), lambda d: wrote.append("fallback"),
        probe=lambda: time.sleep(30), seconds=0.5,
    )
    assert used == "fallback" and wrote == ["fallback"] and isinstance(used.cause, TimeoutError)


def test_a_cancelled_probe_leaves_no_cores_busy(spark):
    """The next probe's time is not spent waiting for the tasks of the one before."""

    def never(batches):
        time.sleep(120)
        yield from batches

    assert spark.range(3).mapInArrow(lambda batches: batches, "id long").count() == 3
    hangs = spark.range(0, 64, 1, 16).mapInArrow(never, "id long")
    with pytest.raises(TimeoutError):
        fallback.within(spark, 2, hangs.count)
    assert fallback.within(spark, 1.5, spark.range(3).count) == 3
