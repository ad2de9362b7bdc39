from __future__ import annotations

import datetime as dt

import pandas as pd
import pytest
from conftest import column
from pyspark.sql import functions as F

from incidentia.functions import dates, geo, values
from incidentia.functions.geo import Box

def c():
    return F.col("c")


def texts(table, rows):
    return table([(r,) for r in rows], "c string")


def test_times_with_one_or_two_digits(table):
    rows = ["05/03/2019 07:05", "5/3/2019 7:05", "5/03/2019 7:05", "05/03/2019 7:5"]
    found = column(texts(table, rows), dates.parse_event_time(c()))
    assert found == [dt.datetime(2019, 3, 5, 7, 5)] * 4


@pytest.mark.parametrize(
    "text", ["2019-03-05 07:05", "", None, "31/02/2019 10:00", "05/03/2019 07:05:00", "bad"]
)
def test_unreadable_times_are_null(table, text):
    assert column(texts(table, [text]), dates.parse_event_time(c())) == [None]


def test_shift_edges(table):
    hours = [5, 6, 11, 12, 17, 18, 21, 22, 0, None]
    found = column(table([(h,) for h in hours], "c int"), dates.shift_of(c()))
    assert found == [
        "Madrugada", "Mañana", "Mañana", "Tarde", "Tarde", "Noche", "Noche",
        "Madrugada", "Madrugada", None,
    ]


def test_time_parts(table):
    row = table([(dt.datetime(2024, 1, 1, 13, 5),)], "c timestamp_ntz")
    parts = row.withColumns(dates.time_parts(c())).first()
    assert (parts.anio, parts.mes, parts.hora, parts.dia_semana) == (2024, 1, 13, "Monday")


def test_hour_from_text(table):
    rows = ["2019-03-05T07:05", "05/03/2019 07:05", "x", "", None, "sin fecha", "a 25:00"]
    assert column(texts(table, rows), dates.hour_from_text(c())) == [7, 7, None, None, None, None, None]
    rows = ["a  7:05", "a 23:59", "a 99:00", "a -3:00", "a 0:00"]
    assert column(texts(table, rows), dates.hour_from_text(c())) == [7, 23, None, None, 0]


def test_times_as_pandas_reads_them(table):
    rows = [
        "05/03/2019 07:05", "05/03/2019  07:05", "5/3/2019\t7:5", " 5/3/2019 7:05", " 15/3/2019 7:05",
        "005/3/2019 07:05", "05/03/2019 007:05", "05/03/2019 24:00", "31/02/2019 01:00", "05/03/19 07:05",
        "05/03/2019 07:05 ", "\u000105/03/2019 07:05", "5/3/2019 99:10", "29/02/2020 0:0", "05/03/2019 07:60", "",
    ]
    read = pd.to_datetime(pd.Series(rows), format="%d/%m/%Y %H:%M", errors="coerce")
    want = [None if pd.isna(t) else t.to_pydatetime() for t in read]
    assert column(texts(table, rows), dates.parse_event_time(c())) == want


def test_numbers(table):
    rows = ["625000000", "abc", "", " 7 ", "6,25", "1d", "2.5f", "NaN", None, "-7560000000"]
    found = column(texts(table, rows), values.to_number(c()))
    assert found == [625000000.0, None, None, 7.0, None, None, None, None, None, -7560000000.0]


def test_codes(table):
    rows = ["10", "10.0", "10.5", "x", None, "99999999999"]
    assert column(texts(table, rows), values.to_code(c())) == [10, 10, None, None, None, None]


def test_missing_tokens(table):
    rows = ["NA", "None", "NULL", "nan", "", "n/a", "Sin dato", None]
    found = column(texts(table, rows), values.missing_to_null(c()))
    assert found == [None] * 6 + ["Sin dato", None]


def test_sentinel_is_replaced_only_as_a_whole(table):
    rows = ["Sin dato", "Sin dato joyas", None]
    found = column(texts(table, rows), values.without_sentinel(c()))
    assert found == ["No especificado", "Sin dato joyas", None]


def test_age_band_edges(table):
    ages = [0, -1, 1, 17, 17.5, 18, 25, 65, 66, 120, 121, None]
    found = column(table([(a if a is None else float(a),) for a in ages], "c double"), values.age_band(c()))
    assert found == [
        None, None, "<18", "<18", "18-25", "18-25", "18-25", "51-65", "65+", "65+", None, None,
    ]


def test_box_edges_and_nulls(table):
    pairs = [(6.10, -75.75), (6.45, -75.45), (6.09, -75.6), (6.25, None), (None, -75.6), (None, None)]
    rows = table(pairs, "lat double, lon double")
    lat, lon = geo.repaired_pair(F.col("lat"), F.col("lon"), geo.CITY_BOX)
    found = [tuple(r) for r in rows.select(lat, lon).collect()]
    assert found == pairs[:2] + [(None, None)] * 4


def test_scaled_coordinate(table):
    found = column(texts(table, ["625000000", "-7560000000", "abc"]), geo.scaled(c()))
    assert found == [6.25, -75.6, None]


def test_grid_cells_below_zero(table):
    rows = table([(-0.5,), (0.5,), (1.0,)], "c double")
    assert column(rows, geo.grid_cell(c(), 1.0)) == [-1, 0, 1]


def test_box_is_two_sided(table):
    rows = table([(5.0, 5.0), (5.0, 50.0)], "lat double, lon double")
    assert column(rows, Box(0, 10, 0, 10).holds(F.col("lat"), F.col("lon"))) == [True, False]


def test_risk_captions(table):
    found = column(texts(table, ["ALTO", "MEDIO", "BAJO", "otro", None]), values.risk_caption(c()))
    assert found == ["🔴 ALTO", "🟠 MEDIO", "🟢 BAJO", None, None]
