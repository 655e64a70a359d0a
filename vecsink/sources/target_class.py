"""Declared target class: a name and typed properties in a JSON file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SHAPE = "class string, description string, properties array<struct<name: string, dataType: array<string>, description: string>>"


def flatten_class(document: DataFrame) -> DataFrame:
    """`(class, property, data_type)`, one row per declared property."""
    return document.select("class", F.explode("properties").alias("p")).select(
        "class", F.col("p.name").alias("property"), F.col("p.dataType")[0].alias("data_type")
    )


def load_class(spark: SparkSession, path: str) -> DataFrame:
    return flatten_class(spark.read.schema(_SHAPE).json(path, multiLine=True))


def parse_class(documents: DataFrame, column: str = "value") -> DataFrame:
    """The same from a column of JSON texts."""
    return flatten_class(documents.select(F.from_json(column, _SHAPE).alias("d")).select("d.*"))
