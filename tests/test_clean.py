from __future__ import annotations

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from incidentia.operators import clean as cleaning
from incidentia.operators.quality import dq_of_copies, dq_report
from incidentia.schemas import CLEAN, RAW
from incidentia.session import written

GOOD = dict(
    fecha_hecho="05/03/2019 07:05", codigo_comuna="10", nombre_barrio="Prado",
    latitud="625000000", longitud="-7560000000", modalidad="Sin dato", arma_medio="Perro",
    conducta_especial="Sin dato", medio_transporte="A pie", bien="Sin dato joyas",
    categoria_bien="x", grupo_bien="NA", lugar="Sin dato", sexo="Mujer", edad="34",
    estado_civil="Sin dato",
)


@pytest.fixture
def raw(table):
    def build(*changes):
        return table([tuple((GOOD | c)[n] for n in RAW.fieldNames()) for c in changes], RAW)

    return build


def test_one_row(raw):
    row = cleaning.clean(raw({})).first()
    assert row.asDict() | {"fecha_dt": str(row.fecha_dt)} == {
        "fecha_hecho": "05/03/2019 07:05", "fecha_dt": "2019-03-05 07:05:00", "anio": 2019,
        "mes": 3, "hora": 7, "dia_semana": "Tuesday", "turno_dia": "Mañana",
        "comuna": "La Candelaria", "barrio": "Prado", "codigo_comuna": 10,
        "modalidad": "No especificado", "tipo_conducta": "No especificado", "arma": "Perro",
        "transporte_victima": "A pie", "bien_hurtado": "Sin dato joyas", "categoria_bien": "x",
        "grupo_bien": None, "lugar": "Sin dato", "sexo": "Mujer", "edad": 34.0,
        "estado_civil": "No especificado", "lat": 6.25, "lon": -75.6, "zona_riesgo": "ALTO",
    }


def test_columns_types_and_order(raw):
    found = cleaning.clean(raw({}))
    assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in CLEAN]


def test_rows_without_time_are_dropped(raw):
    rows = raw({}, {"fecha_hecho": "bad"}, {"fecha_hecho": None})
    assert cleaning.clean(rows).count() == 1


def test_area_codes(raw):
    rows = raw(*[{"codigo_comuna": c} for c in ("10", "99", None, "x", "90")])
    found = cleaning.with_area(rows).select("codigo_comuna", "comuna")
    assert sorted(tuples(found), key=str) == sorted(
        [(10, "La Candelaria"), (99, "Desconocida"), (None, "Desconocida"),
         (None, "Desconocida"), (90, "Santa Elena")], key=str,
    )


def test_own_area_table(raw, table):
    areas = table([(1, "Norte")], "code int, name string")
    rows = raw({"codigo_comuna": "1"}, {"codigo_comuna": "10"})
    found = cleaning.with_area(rows, areas, "Otra").select("comuna")
    assert sorted(tuples(found)) == [("Norte",), ("Otra",)]


def test_duplicates_with_and_without_nulls(raw):
    rows = raw({}, {}, {"sexo": None}, {"sexo": None}, {"sexo": "Hombre"})
    assert cleaning.clean(rows).count() == 3


def test_sentinel_and_its_replacement_are_duplicates(raw):
    rows = raw({"modalidad": "Sin dato"}, {"modalidad": "No especificado"})
    assert cleaning.clean(rows).count() == 1


def test_unknown_raw_columns_count_for_duplicates_and_are_dropped(raw):
    rows = raw({}).withColumn("extra", F.explode(F.array(F.lit("a"), F.lit("b"))))
    found = cleaning.clean(rows)
    assert found.count() == 2 and "extra" not in found.columns


def test_absent_columns_are_skipped(raw):
    found = cleaning.clean(raw({}).drop("sexo", "grupo_bien", "edad"))
    assert found.columns == [c for c in CLEAN.fieldNames() if c not in ("sexo", "grupo_bien", "edad")]


def test_zones_before_or_after_dropping_duplicates(raw):
    copies = [{"codigo_comuna": "1"}] * 5
    others = [{"codigo_comuna": "2", "edad": str(a)} for a in (20, 30, 40)]
    rows = raw(*copies, *others)

    def zones(**options):
        found = cleaning.clean(rows, **options).select("comuna", "zona_riesgo").distinct()
        return dict(tuples(found))

    assert zones() == {"Popular": "ALTO", "Santa Cruz": "BAJO"}
    assert zones(dedupe_first=True) == {"Popular": "BAJO", "Santa Cruz": "ALTO"}


def test_dq_report(raw):
    rows = raw(
        {}, {},
        {"latitud": "609000000"},
        {"longitud": None},
        {"latitud": None},
        {"latitud": "abc"},
        {"fecha_hecho": "bad"}, {"fecha_hecho": "bad"},
    )
    assert dq_report(rows).first().asDict() == {
        "rows_in": 8, "bad_dates": 2, "bad_coords": 2, "duplicates": 1, "rows_out": 5,
    }
    assert cleaning.clean(rows).count() == 5


def test_dq_report_of_no_rows(raw):
    assert set(dq_report(raw({}).limit(0)).first()) == {0}


def test_cleaning_twice_changes_nothing(raw):
    once = cleaning.normalise_sentinels(cleaning.normalise_missing(raw({}, {"edad": "NA"})))
    again = cleaning.normalise_sentinels(cleaning.normalise_missing(once))
    assert sorted(tuples(once), key=str) == sorted(tuples(again), key=str)


def test_zones_counters_and_rows_read_the_stored_copies_only(raw, tmp_path):
    path = str(tmp_path / "raw")
    raw({}, {}, {"fecha_hecho": "bad"}).write.parquet(path)
    source = raw({}).sparkSession.read.parquet(path)
    counted = written(cleaning.copies(source), "copies")
    rows, counters = cleaning.clean_copies(counted), dq_of_copies(counted)
    for result in (rows, counters):
        assert not [f for f in result.inputFiles() if str(tmp_path) in f]
    assert rows.count() == 1
    assert tuples(counters) == [(3, 1, 0, 1, 1)]
