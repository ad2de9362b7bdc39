"""The area dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from incidentia.schemas import AREAS


def area_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(AREAS, "code int, name string")
