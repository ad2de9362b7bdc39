"""Every registered query against its SQL, and the plans of the main ones."""

from __future__ import annotations

import re

import oracle
import pytest

import __spark_entry__ as entry_point
from incidentia.plans.oracles import ORACLES
from incidentia.plans.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["comuna", "total_hurtos"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, connection, name):
    assert oracle.compare(QUERIES[name](spark, SMALL), connection, ORACLES[name]) == ""


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_top_k_is_not_a_full_sort(spark):
    for name in ("top_goods", "top_places", "top_neighbourhoods", "top_areas_12", "top_transport"):
        found = plan(QUERIES[name](spark, SMALL))
        assert "TakeOrderedAndProject" in found and "rangepartitioning" not in found, name


def test_scans_read_only_the_columns_needed(spark):
    found = plan(QUERIES["by_category"](spark, SMALL))
    assert re.search(r"ReadSchema: struct<event_type:string>", found)
    assert "IsNotNull(event_type)" in found
    found = plan(QUERIES["by_area"](spark, SMALL))
    assert "ReadSchema: struct<user_id:bigint>" in found


def test_counts_combine_before_the_shuffle(spark):
    for name in ("by_category", "by_sex", "dedupe", "multi_dim_counts", "by_area"):
        found = plan(QUERIES[name](spark, SMALL))
        assert found.count("HashAggregate") >= 2 and "SortAggregate" not in found, name


def test_several_counts_share_one_scan(spark):
    assert plan(QUERIES["multi_dim_counts"](spark, SMALL)).count("FileScan") == 1
    assert plan(QUERIES["dq_report"](spark, SMALL)).count("FileScan") == 2


def test_no_python_in_any_plan_and_no_pairwise_join(spark):
    for name in sorted(QUERIES):
        if not name.startswith("stream"):
            found = plan(QUERIES[name](spark, SMALL))
            for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
                assert word not in found, (name, word)


def test_the_stream_starts_before_the_batch_job(spark, monkeypatch):
    """Neither waits for the other; both are done when their tables are served."""
    from incidentia.plans import queries

    order, ingest, stream = [], queries._ingested, queries.jobs.stream_etl
    monkeypatch.setattr(queries, "_ingested", lambda *a: order.append("batch") or ingest(*a))
    monkeypatch.setattr(queries.jobs, "stream_etl", lambda *a, **k: order.append("stream") or stream(*a, **k))
    queries._batch_and_stream(spark, SMALL)
    assert order == ["stream", "batch"] and not spark.streams.active


def test_a_lookup_that_counts_keys_does_not_read_the_property(spark, monkeypatch):
    """The JSON property is read once per event, above the join."""
    from incidentia.plans import standins

    seen, real = [], standins.lookup
    monkeypatch.setattr(standins, "lookup", lambda rows, *a: seen.append(plan(rows.groupBy("user_id").count())) or real(rows, *a))
    standins.raw_incidents(spark, SMALL)
    assert len(seen) == 1 and "Generate" not in seen[0] and "props" not in seen[0]
