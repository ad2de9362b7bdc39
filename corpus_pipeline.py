"""Training-data pipeline over the table ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the
last return the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from incidentia.llm import decontamination, line_dedup, packing, quality, simhash, tokens
from incidentia.llm.queries import quality_ranking, table
from incidentia.session import written


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking does not reject."""
    return quality.keep_good(docs, quality_ranking(docs, table(spark, sf_dir, "labels")))


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the chunks of lines that an earlier one has."""
    return line_dedup.remove_repeated(docs, length="n_chars")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates."""
    return simhash.keep_one(docs, shingle=simhash.SHINGLE, distance=simhash.DISTANCE)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    return decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    return packing.pack(docs, tokens.tokenizer_path()).drop("ids")


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", without_repeated_passages),
    ("SimHash near-dedup", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("best-fit packing", packed),
]

# The ranking is fitted and the ids come from a tokenizer: no SQL says that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = written(docs, name.replace(" ", "-"))
    return docs
