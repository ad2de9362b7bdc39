"""Queries of the corpus operators: (spark, data folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentia.llm import (
    decontamination,
    hard_negatives,
    lexical,
    licenses,
    line_dedup,
    main_text,
    neighbours,
    packing,
    pitman_yor,
    quality,
    simhash,
    token_shards,
    tokens,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_line_dedup(spark, sf_dir):
    return line_dedup.removed_spans(table(spark, sf_dir, "documents"))


@query
def op8_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", simhash.fingerprint_text("fp").alias("fingerprint"), "component_id"
    )


@query
def op9_decontamination(spark, sf_dir):
    benchmark = table(spark, sf_dir, "benchmark")
    return decontamination.overlaps(table(spark, sf_dir, "documents"), benchmark)


@query
def op4_packing(spark, sf_dir):
    packed = packing.pack(table(spark, sf_dir, "documents"), tokens.tokenizer_path())
    return packed.drop("ids")


def quality_ranking(documents: DataFrame, labels: DataFrame) -> quality.Ranking:
    """Fit on the labels outside the held-out quarter."""
    number = F.crc32(F.col("doc_id").cast("string")) % 4
    return quality.train(documents, labels.where(number != 2))


@query
def op7_quality(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    ranking = quality_ranking(documents, table(spark, sf_dir, "labels"))
    found = quality.scored(documents.select("doc_id", "text"), ranking)
    return found.select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= quality.CUT).cast("int").alias("predicted"),
    )


@query
def op2_neighbours(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op6_token_shards(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return token_shards.materialise(documents, tokens.tokenizer_path())


@query
def op5_warc(spark, sf_dir):
    # The pages carry no time: their number stands in for the second of the capture.
    captured = F.timestamp_seconds(1_700_000_000 + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**8)))
    found = warc.captures(table(spark, sf_dir, "pages"), captured)
    return found.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key"
    )


def file_path(doc_id: Column, source: Column) -> Column:
    """A place for each document: source/thousands/hundreds/number.txt. Numbers
    that end in 00 are the license files of their directory, those that end in
    000 of the one above."""
    top = F.concat_ws("/", F.coalesce(source, F.lit("none")), F.floor(doc_id / 1000).cast("string"))
    low = F.concat_ws("/", top, F.floor(doc_id / 100).cast("string"))
    return (
        F.when(doc_id % 1000 == 0, F.concat(top, F.lit("/LICENSE")))
        .when(doc_id % 100 == 0, F.concat(low, F.lit("/LICENSE")))
        .otherwise(F.concat(low, F.lit("/"), doc_id.cast("string"), F.lit(".txt")))
    )


@query
def op10_licenses(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    path = file_path(F.col("doc_id"), F.col("source"))
    found = licenses.scan(documents.select("doc_id", "text", path.alias("path")))
    return found.select("doc_id", "path", "license", "similarity", "origin", "license_path")


@query
def op3_pitman_yor(spark, sf_dir):
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return pitman_yor.score(table(spark, sf_dir, "documents"), held_out)


@query
def op11_hard_negatives(spark, sf_dir):
    # Every seventh row gets a wrong label, as the contract of this query has it.
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    anchors = F.col("vec_id") % 100 == 0
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), anchors, label=moved)


@query
def op12_lexical_search(spark, sf_dir):
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_main_text(spark, sf_dir):
    return main_text.extract(table(spark, sf_dir, "pages"))
