"""Lookups agree on every path, also when one key holds a third of the rows."""

from __future__ import annotations

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from incidentia.operators import joins
from incidentia.operators.facets import apply_selections
from incidentia.session import scratch_path
from incidentia.sources.stream import file_stream
from incidentia.streaming.jobs import append_stream, finish


@pytest.fixture
def skewed(spark):
    """30,000 rows: a third of key 7, a tenth without key, the rest spread."""
    return spark.range(30_000, numPartitions=12).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 10 = 1 THEN NULL ELSE 8 + id % 4992 END AS k",
        "id AS v",
    )


@pytest.fixture
def dimension(spark):
    """Names for the even keys and for 7."""
    return spark.range(5000).where("id % 2 = 0 OR id = 7").selectExpr(
        "id AS k", "concat('n', id) AS name"
    )


def same(left, right):
    assert left.columns == right.columns
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_spread_join_equals_plain_join(skewed, dimension):
    plain = skewed.join(dimension, "k", "left").select("k", "v", "name")
    same(joins.spread_join(skewed, dimension, "k", slice_rows=1000).select("k", "v", "name"), plain)


def test_lookup_beyond_the_bound_equals_broadcast(skewed, dimension):
    small = joins.lookup(skewed, dimension, "k")
    large = joins.lookup(skewed, dimension, "k", limit_bytes=0)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "_slice" in plan(large) and "_slice" not in plan(small)
    same(small.select("k", "v", "name"), large.select("k", "v", "name"))


def test_hot_keys_are_found(skewed):
    assert tuples(joins.hot_keys(skewed, "k", 3_000)) == [(7, 4)]


def test_hot_key_is_spread_over_many_tasks(spark, skewed, dimension):
    """As on large data: the join is neither broadcast nor are its tasks merged."""
    large = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    usual = {name: spark.conf.get(name) for name in large}
    for name, value in large.items():
        spark.conf.set(name, value)
    try:
        joined = joins.spread_join(skewed, dimension, "k", slice_rows=1_000).where("k = 7")
        per_task = joined.groupBy(F.spark_partition_id()).count().select("count")
        rows = [r[0] for r in per_task.collect()]
    finally:
        for name, value in usual.items():
            spark.conf.set(name, value)
    assert sum(rows) == 10_000
    assert len(rows) >= 4 and max(rows) <= 5_000


def test_measured_bytes_counts_text(table):
    short = joins.measured_bytes(table([("a",)], "c string"))
    long = joins.measured_bytes(table([("a" * 1000,)], "c string"))
    assert long - short == 999


def test_counts_by_lookup_equals_join_then_count(skewed, dimension):
    found = joins.counts_by_lookup(skewed, dimension, "k", ["name"], default={"name": "none"})
    expected = (
        skewed.join(dimension, "k", "left").fillna({"name": "none"})
        .groupBy("name").agg(F.count("*").alias("total"))
    )
    same(found, expected)


def test_selection_equals_semi_join(skewed, dimension):
    expected = skewed.join(dimension, "k", "left_semi").select("k", "v")
    same(apply_selections(skewed, {"k": dimension}).select("k", "v"), expected)
    same(joins.keep_selected(skewed, dimension, "k", limit_bytes=0), expected)


def test_selection_with_repeats_and_nulls_adds_no_rows(skewed, table):
    chosen = table([(7,), (7,), (None,)], "k long")
    assert joins.keep_selected(skewed, chosen, "k").count() == 10_000


def test_stream_lookup_beyond_the_bound(spark, skewed, dimension):
    source, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    skewed.write.parquet(source)
    stream = file_stream(spark, source, skewed.schema, files_per_trigger=4)
    joined = joins.lookup(stream, dimension, "k", limit_bytes=0)
    finish(append_stream(joined, out, scratch_path(spark, "cp"), replay=True), 300)
    same(spark.read.parquet(out), skewed.join(dimension, "k", "left").select("k", "v", "name"))
