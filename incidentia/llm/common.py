"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentia.session import scratch_path

# Stands for a missing document id where ids are compared: it comes last.
NO_ID = 2**63 - 1
# Rows of one key that a task joins at most; more are dealt to more tasks.
SLICE_ROWS = 200_000
# Rows of whole texts that a scan decodes and a Python worker gets at a time.
TEXT_ROWS = {
    "spark.sql.parquet.columnarReaderBatchSize": 256,
    "spark.sql.execution.arrow.maxRecordsPerBatch": 1_000,
}


def id_or_last(name: str) -> Column:
    return F.coalesce(F.col(name).cast("bigint"), F.lit(NO_ID))


def null_if_last(column: Column) -> Column:
    return F.when(column != NO_ID, column)


def fresh(columns: Iterable[str], base: str) -> str:
    """A column name that ``columns`` does not hold yet."""
    taken = {c.lower() for c in columns}
    name = base
    while name.lower() in taken:
        name = f"_{name}"
    return name


def drop_written(df: DataFrame, only: Sequence[str] | None = None) -> None:
    """Remove the files of a table made by ``written`` that nothing reads any more;
    with ``only`` those in folders of these names."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if only is not None and folder.rpartition("/")[2] not in only:
            continue
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Remove shuffle files that no plan refers to any more. Spark does so when
    the driver's garbage is collected; this is the time for it. Before that go
    plans that only a cycle of Python objects holds, and the last job, which Spark
    keeps until it runs another one."""
    gc.collect()
    spark.range(1).count()
    spark._jvm.System.gc()


@contextmanager
def few_texts(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside hold few whole texts at a time (``TEXT_ROWS``): by default
    a task decodes 4,096 rows and sends 10,000, which for texts of some KB takes the
    better part of an executor's memory. Smaller limits that are set already stay."""
    usual = {name: spark.conf.get(name) for name in TEXT_ROWS}
    try:
        for name, most in TEXT_ROWS.items():
            # No limit is written as zero or below.
            if not 0 < int(usual[name]) <= most:
                spark.conf.set(name, str(most))
        yield
    finally:
        for name, value in usual.items():
            spark.conf.set(name, value)


def written_tight(df: DataFrame, name: str) -> DataFrame:
    """``written`` for tables of whole texts: the files are compressed harder."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_rows(
    df: DataFrame, function: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str
) -> DataFrame:
    """Rows that ``function`` makes of each batch; nothing is kept between batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from function(batch)

    return df.mapInArrow(run, schema)


def spread_join(
    rows: DataFrame,
    table: DataFrame,
    key: list[str],
    by: Column,
    *,
    count: str = "n",
    most: int = SLICE_ROWS,
    how: str = "inner",
) -> DataFrame:
    """Shuffle join of ``rows`` with ``table``, which has one row per key and in
    ``count`` (which the result leaves out) the number of rows with that key.

    A key with more than ``most`` rows is dealt over several tasks by the hash
    ``by``, which must depend on the row's content only. The broadcast list
    holds these keys alone: at most (all rows / ``most``) of them.
    """
    names = [*rows.columns, *table.columns]
    at, many, slice_ = (fresh(names, n) for n in ("by", "slices", "slice"))
    slices = F.ceil(F.col(count) / F.lit(most)).cast("int")
    hot = table.where(F.col(count) > most).select(*key, slices.alias(many))
    dealt = (
        rows.withColumn(at, by)
        .join(F.broadcast(hot), key, "left")
        .withColumn(slice_, F.coalesce(F.pmod(at, many).cast("int"), F.lit(0)))
        .drop(at, many)
    )
    last = F.greatest(slices, F.lit(1)) - 1
    copied = table.withColumn(slice_, F.explode(F.sequence(F.lit(0), last))).drop(count)
    return dealt.join(copied, [*key, slice_], how).drop(slice_)
