from __future__ import annotations

import golden
from conftest import tuples
from pyspark.sql import functions as F

from incidentia.functions.dates import shift_of
from incidentia.operators import counts, trend
from incidentia.operators.risk import risk_rows, risk_table, risk_zones


def replay(spark, pairs, name):
    """As many rows per value as its count says."""
    listed = spark.createDataFrame(pairs, f"{name} string, n int")
    return listed.select(name, F.explode(F.sequence(F.lit(1), "n"))).select(name)


def test_golden_orders(spark):
    for pairs in (golden.MODALITIES, golden.WEAPONS, [a[:2] for a in golden.AREAS]):
        assert tuples(counts.count_by(replay(spark, pairs, "c"), "c")) == pairs


def test_golden_shifts_from_hours(spark):
    rows = replay(spark, [(str(h), n) for h, n in enumerate(golden.HOURS)], "c")
    hours = rows.select(F.col("c").cast("int").alias("hora"))
    assert tuples(counts.count_by_in_key_order(hours, "hora")) == list(enumerate(golden.HOURS))
    shifts = hours.select(shift_of(F.col("hora")).alias("turno"))
    assert tuples(counts.count_by(shifts, "turno")) == golden.SHIFTS


def test_golden_risk_zones(spark):
    listed = spark.createDataFrame([a[:2] for a in golden.AREAS], "comuna string, total long")
    zones = risk_zones(listed, "comuna")
    assert {r[0] for r in zones.select("p75").collect()} == {518.75}
    assert {r[0] for r in zones.select("p50").collect()} == {144.0}
    assert sorted(tuples(zones.select("comuna", "total", "zona_riesgo"))) == sorted(golden.AREAS)


def test_golden_risk_rows_and_table(spark):
    zoned = risk_rows(replay(spark, [a[:2] for a in golden.AREAS], "comuna"), "comuna")
    assert zoned.count() == golden.TOTAL
    captions = {"ALTO": "🔴 ALTO", "MEDIO": "🟠 MEDIO", "BAJO": "🟢 BAJO"}
    assert tuples(risk_table(zoned)) == [(a, captions[z], n) for a, n, z in golden.AREAS]


def test_equal_counts_go_by_key_and_nulls_are_left_out(table):
    rows = table([(v,) for v in ("b", "a", "a", "b", None, None, None)], "c string")
    assert tuples(counts.count_by(rows, "c")) == [("a", 2), ("b", 2)]
    assert tuples(counts.count_by(rows, "c", top=1, key_as="k", total_as="n")) == [("a", 2)]


def test_age_bands_show_empty_bands(table):
    rows = table([(1.0,), (20.0,), (20.0,), (None,), (0.0,), (121.0,)], "edad double")
    assert tuples(counts.age_bands(rows)) == [
        ("18-25", 2), ("<18", 1), ("26-35", 0), ("36-50", 0), ("51-65", 0), ("65+", 0),
    ]


def test_multi_dim_counts_equal_single_counts(table):
    rows = table(
        [("x", 1, None), ("x", 2, "p"), ("y", 1, "p"), (None, None, "q")], "a string, b int, c string"
    )
    found = counts.multi_dim_counts(rows, ["a", "b", "c"], with_all=True)
    expected = [(None, None, 4)]
    for key in ("a", "b", "c"):
        expected += [(key, str(v), n) for v, n in tuples(counts.count_by(rows, key))]
    assert sorted(tuples(found), key=str) == sorted(expected, key=str)


def test_multi_dim_pairs_drop_null_members(table):
    rows = table([("x", "p"), ("x", "p"), ("x", None), (None, "p")], "a string, b string")
    found = counts.multi_dim_counts(rows, ["a"], pairs=(("a", "b"),))
    assert sorted(tuples(found), key=str) == sorted(
        [("a", "x", None, 3), ("a+b", "x", "p", 2)], key=str
    )


def test_modes_break_ties_by_value_and_survive_no_rows(table):
    rows = table([("b", "n"), ("a", None), ("a", "n"), ("b", "m")], "x string, y string")
    assert counts.modes(rows, {"x": "mx", "y": "my"}).first().asDict() == {
        "total": 4, "mx": "a", "my": "n",
    }
    assert counts.modes(rows.limit(0), {"x": "mx"}).first().asDict() == {"total": 0, "mx": None}


def test_count_tables_sum_to_non_null_rows(spark):
    rows = spark.range(1000).selectExpr("CASE WHEN id % 7 > 0 THEN id % 5 END AS k")
    listed = counts.count_by(rows, "k")
    assert listed.agg(F.sum("total")).first()[0] == rows.where("k IS NOT NULL").count()


def test_summary(table):
    rows = table([("a", None, 1), ("b", "p", 3), ("a", "p", 2)], "comuna string, barrio string, t int")
    found = counts.summary(rows, "t").first().asDict()
    assert found == {
        "total": 3, "desde": 1, "hasta": 3, "comuna_distintos": 2, "barrio_distintos": 1,
    }


def test_trend_and_cube(table):
    rows = table(
        [("2019-01-01 00:00:00",)] * 2 + [("2020-06-01 00:00:00",)] * 3, "t string"
    ).select(F.col("t").cast("timestamp_ntz").alias("fecha_dt"))
    assert tuples(trend.annual_trend(rows)) == [(2019, 2, None, None), (2020, 3, 2, 50.0)]

    cells = table([("x", "p", 3), ("y", "p", 1)], "a string, b string, total long")
    cube = {(r.a, r.b): (r.total, r.share) for r in trend.concentration_cube(cells, ["a", "b"]).collect()}
    assert cube == {
        ("x", "p"): (3, 0.75), ("y", "p"): (1, 0.25), ("x", None): (3, 0.75),
        ("y", None): (1, 0.25), (None, "p"): (4, 1.0), (None, None): (4, 1.0),
    }


def test_geo_grid_leaves_out_missing_points(table):
    rows = table([(1.2, 3.4), (1.9, 3.1), (None, 3.0)], "lat double, lon double")
    assert tuples(trend.geo_grid(rows, 1.0)) == [(1, 3, 2)]
