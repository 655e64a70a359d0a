"""Checks of what is produced against what is declared and stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecsink.functions.avro import UnsupportedTypeError
from vecsink.functions.convert import check_field, check_vector

# The data type a target class declares for each Spark type.
DECLARED_AS = {
    "string": "string",
    "boolean": "boolean",
    "int": "int",
    "bigint": "int",
    "double": "number",
    "date": "date",
    "timestamp": "date",
    "array<string>": "string[]",
    "array<int>": "int[]",
    "array<double>": "number[]",
}


def _column_counts(df: DataFrame, described: list[tuple]) -> DataFrame:
    """One row per column: its description and its number of non-null values.

    All columns are counted in one pass, then the single row of counts is turned.
    `described` holds `(column, text, text, text)` per column.
    """
    counts = df.agg(*[F.count(F.col(f"`{name}`")).alias(f"c{i}") for i, (name, *_) in enumerate(described)])
    rows = [
        F.struct(*[F.lit(part).cast("string").alias(f"t{j}") for j, part in enumerate(line)], F.col(f"c{i}").alias("n"))
        for i, line in enumerate(described)
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def type_census(df: DataFrame, table: str, vector: str | None = None) -> DataFrame:
    """Which columns of a table an object can hold, and how many values they have."""
    described = []
    for field in df.schema.fields:
        verdict, advice = "accepted", None
        try:
            check_vector(field) if field.name == vector else check_field(field.name, field.dataType)
        except UnsupportedTypeError as refused:
            verdict = "rejected"
            advice = str(refused).partition("cast it to ")[2] or None
        described.append((field.name, field.dataType.simpleString(), verdict, advice))
    return _column_counts(df, described).select(
        F.lit(table).alias("table_name"),
        F.col("t0").alias("column_name"),
        F.col("t1").alias("spark_type"),
        F.col("t2").alias("verdict"),
        F.col("t3").alias("cast_to"),
        F.col("n").alias("present_values"),
    )


def class_conformance(rows: DataFrame, declared: DataFrame) -> DataFrame:
    """Produced columns against declared properties, with counts of values."""
    described = [(f.name, DECLARED_AS.get(f.dataType.simpleString()), None, None) for f in rows.schema.fields]
    produced = _column_counts(rows, described).select(
        F.col("t0").alias("property"), F.col("t1").alias("produced_type"), F.col("n").alias("produced_values")
    )
    wanted = declared.select("property", F.col("data_type").alias("declared_type"))
    status = (
        F.when(F.col("declared_type").isNull(), "undeclared")
        .when(F.col("produced_type").isNull(), "not_produced")
        .when(F.col("declared_type") != F.col("produced_type"), "type_mismatch")
        .otherwise("ok")
    )
    return produced.join(wanted, "property", "full").select(
        "property",
        "declared_type",
        "produced_type",
        F.coalesce("produced_values", F.lit(0)).alias("produced_values"),
        status.alias("status"),
    )


def reconcile(source: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows read against objects stored; each side is one aggregate."""
    zero = F.lit(0).cast("bigint")
    left = source.agg(F.count(F.lit(1)).alias("source_rows")).withColumn("stored_objects", zero)
    right = stored.agg(F.count(F.lit(1)).alias("stored_objects")).select(zero.alias("source_rows"), "stored_objects")
    both = left.unionByName(right).agg(
        F.sum("source_rows").alias("source_rows"), F.sum("stored_objects").alias("stored_objects")
    )
    return both.withColumn("matches", F.col("source_rows") == F.col("stored_objects"))


def sample_objects(objects: DataFrame, count: int = 3) -> DataFrame:
    """A few objects to look at, the first by id."""
    return objects.orderBy("id").limit(count)

