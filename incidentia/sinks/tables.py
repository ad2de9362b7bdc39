"""Tables, documents and messages written by the jobs."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentia.functions.geo import CITY_BOX, Box, place_curve
from incidentia.sinks.commits import CommittedTable
from incidentia.sinks.folders import folder
from incidentia.sources.fallback import within

# Versions of a replaced table that stay for readers.
KEPT_VERSIONS = 2


def write_delimited(rows: DataFrame, path: str, *, sep: str = ",") -> None:
    """Header and UTF-8; Spark creates the folder. Cells keep their outer blanks."""
    rows.write.mode("overwrite").options(
        header=True,
        sep=sep,
        encoding="UTF-8",
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)


def overwrite_table(rows: DataFrame, path: str, *, fmt: str = "parquet", **options) -> None:
    """Replace the whole collection. Parquet is replaced in one step: readers
    find the old rows until the new ones are all there, also after a failure."""
    if fmt == "parquet" and not options:
        _replace(rows, path)
    else:
        rows.write.format(fmt).options(**options).mode("overwrite").save(path)


def _replace(rows: DataFrame, path: str, *partition_by: str) -> None:
    table = CommittedTable(rows.sparkSession, path)
    table.overwrite(rows, partition_by=partition_by)
    table.remove_old(KEPT_VERSIONS)


def write_clean_table(rows: DataFrame, path: str) -> None:
    """Replace the clean table, laid out for filters on year, month, area and time.

    Rows are gathered by month with a rebalance, which lets adaptive
    execution split a month that holds most of the rows and merge small ones,
    so neither one huge task nor many tiny files come out. Sorting within
    each file narrows its area and time statistics.
    """
    gathered = rows.hint("rebalance", F.col("anio"), F.col("mes"))
    _replace(gathered.sortWithinPartitions("anio", "mes", "comuna", "fecha_dt"), path, "anio", "mes")


def write_by_place(rows: DataFrame, path: str, box: Box = CITY_BOX, files: int | None = None) -> None:
    """Replace a table laid out for filters on the pair of coordinates.

    A curve through the box visits neighbouring places one after another. Each
    file gets a stretch of it, so its coordinate statistics are narrow in both
    directions, and a small box reads few files. A place with very many
    events shares its value of the curve; the row's hash splits it.
    """
    curve, content = "_curve", "_content"
    placed = rows.withColumn(curve, place_curve(F.col("lat"), F.col("lon"), box)).withColumn(
        content, F.xxhash64(*rows.columns)
    )
    ranged = placed.repartitionByRange(*([] if files is None else [files]), curve, content)
    _replace(ranged.sortWithinPartitions(curve).drop(curve, content), path)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions below ``path``, the newest last."""
    place, system = folder(spark, path)
    if not system.exists(place):
        return []
    names = [s.getPath().getName() for s in system.listStatus(place) if s.isDirectory()]
    numbers = sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))
    done = lambda n: system.exists(folder(spark, f"{path}/version={n}/_SUCCESS")[0])
    return [n for n in numbers if done(n)]


def newest_version(spark: SparkSession, path: str) -> int | None:
    found = versions(spark, path)
    return found[-1] if found else None


def write_version(
    rows: DataFrame, path: str, *, fmt: str = "parquet", number: int | None = None, keep: int = 2
) -> int:
    """Write a new version beside the others; readers go on with the last
    complete one until it is there. The ``keep`` newest versions stay."""
    spark = rows.sparkSession
    there = versions(spark, path)
    number = (there[-1] + 1 if there else 0) if number is None else number
    rows.write.format(fmt).mode("overwrite").save(f"{path}/version={number}")
    for old in versions(spark, path)[:-keep]:
        place, system = folder(spark, f"{path}/version={old}")
        system.delete(place, True)
    return number


def write_document(document: DataFrame, path: str) -> None:
    """Write a document as JSON rows, as the newest version."""
    write_version(document, path, fmt="json")


class Outcome(str):
    """Which writer was used, and why not the first one."""

    cause: Exception | None = None


def write_with_fallback(
    rows: DataFrame,
    primary: Callable[[DataFrame], None],
    fallback: Callable[[DataFrame], None],
    probe: Callable[[], None] | None = None,
    seconds: float | None = None,
) -> Outcome:
    """Use ``primary``; whatever error it raises, ``fallback``. Says which one wrote.

    ``probe`` says beforehand, by an error, if the store cannot be reached; it
    has failed if it takes longer than ``seconds``. The write itself has no limit.
    """
    try:
        if probe is not None:
            within(rows.sparkSession, seconds, probe)
        primary(rows)
        return Outcome("primary")
    except Exception as error:
        logging.getLogger(__name__).warning("the store failed, the fallback is used: %s", error)
        fallback(rows)
        used = Outcome("fallback")
        used.cause = error
        return used


def publish(messages: DataFrame, servers: str, topic: str) -> None:
    """Send ``value`` rows to a topic: no key, all replicas, three retries."""
    (
        messages.select("value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.retries", "3")
        .option("topic", topic)
        .save()
    )
