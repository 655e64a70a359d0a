"""Schema registry as a small table `(schema_id int, schema_json string)`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecsink.functions.avro import Field, SchemaConflictError, UnsupportedTypeError, record_fields


class UnknownSchemaError(LookupError):
    """A schema id that the registry does not hold."""


def response_schema(response: Column) -> Column:
    """Schema text of a registry response; raises unless `schema` is a string."""
    document = F.try_parse_json(response)
    kind = F.schema_of_variant(F.try_variant_get(document, "$.schema", "variant"))
    text = F.try_variant_get(document, "$.schema", "string")
    return F.when(kind == "STRING", text).otherwise(
        F.raise_error(F.lit("registry response has no schema text")).cast("string")
    )


def registry_from_responses(responses: DataFrame) -> DataFrame:
    """`(schema_id, response)` rows to a registry table."""
    return responses.select(
        F.col("schema_id").cast("int").alias("schema_id"), response_schema(F.col("response")).alias("schema_json")
    )


def load_registry(spark: SparkSession, location: str) -> DataFrame:
    """Read a registry from a table, a parquet folder or response files.

    A table or folder has `schema_id` and `schema_json` or `response` columns.
    Response files are given as a glob such as `<folder>/*.json`; each is named
    `<schema id>.json` and holds one response.
    """
    if "://" in location and location.split("://")[0] in ("http", "https"):
        raise ValueError("land the registry as a table or as response files; it is not read over HTTP")
    if location.endswith(".json"):
        files = spark.read.text(location, wholetext=True)
        name = F.regexp_extract(F.col("_metadata.file_name"), r"^(-?\d+)\.json$", 1)
        return registry_from_responses(files.select(name.alias("schema_id"), F.col("value").alias("response")))
    source = spark.read.parquet(location) if "/" in location else spark.table(location)
    if "response" in source.columns:
        return registry_from_responses(source)
    return source.select(F.col("schema_id").cast("int").alias("schema_id"), "schema_json")


def prune_registry(registry: DataFrame, framed: DataFrame) -> DataFrame:
    """The part of a registry that the records use; only their headers are read."""
    used = framed.select("schema_id").where("schema_id IS NOT NULL").distinct()
    return registry.join(used, "schema_id", "left_semi")


def one_per_id(registry: DataFrame) -> DataFrame:
    """One row per schema id; raises where an id has two texts."""
    texts = registry.groupBy("schema_id").agg(F.min("schema_json").alias("schema_json"), F.max("schema_json").alias("_other"))
    message = F.concat(F.lit("schema id "), F.col("schema_id").cast("string"), F.lit(" has two different schemas"))
    text = F.when(F.col("schema_json").eqNullSafe(F.col("_other")), F.col("schema_json")).otherwise(F.raise_error(message).cast("string"))
    return texts.select("schema_id", text.alias("schema_json"))


def registry_schemas(registry: DataFrame, set_aside: bool = False) -> dict[int, tuple[Field, ...] | None]:
    """Parsed fields per schema id, on the driver, which fixes the output columns.

    Prune the registry to the ids in use first: only their texts come here. A schema with
    types that are not read, or that is no Avro, raises, or with `set_aside` is kept as
    None, so that only records that use it are rejects.
    """
    texts: dict[int, str] = {}
    for row in registry.select("schema_id", "schema_json").distinct().toLocalIterator():
        if texts.setdefault(row["schema_id"], row["schema_json"]) != row["schema_json"]:
            raise SchemaConflictError(f"schema id {row['schema_id']} has two different schemas")
    schemas: dict[int, tuple[Field, ...] | None] = {}
    for schema_id, text in texts.items():
        try:
            schemas[schema_id] = record_fields(text)
        except (UnsupportedTypeError, SchemaConflictError):
            if not set_aside:
                raise
            schemas[schema_id] = None
    return schemas


def schema_by_id(registry: DataFrame, schema_id: int) -> str:
    """Schema text of one id; raises if the registry lacks it."""
    row = registry.where(F.col("schema_id") == schema_id).select("schema_json").first()
    if row is None:
        raise UnknownSchemaError(f"schema id {schema_id} is not in the registry")
    return row["schema_json"]


def with_schema_text(framed: DataFrame, registry: DataFrame) -> DataFrame:
    """Records with their schema text; a record without a match keeps a null.

    Spark measures the registry's side itself, and splits hot schema ids at run time.
    """
    return framed.join(one_per_id(registry), "schema_id", "left")
