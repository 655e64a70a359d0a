"""Schemas looked up by id where records are decoded, as a registry client does.

A task asks for an id the first time a record has it and keeps the parsed answer; a schema id never changes its
schema. An id that is not there is asked for again with the next batch, so a schema that is registered
while a stream runs is found without a restart. Nothing of a registry passes the driver.
"""

from __future__ import annotations

import json
import posixpath

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from vecsink.functions.avro import Field, SchemaConflictError, UnsupportedTypeError, record_fields
from vecsink.sources.registry import load_registry, one_per_id
from vecsink.sources.scratch import full_path

#: Parsed schemas of this worker process, by folder and id; None for a schema that is not read.
_known: dict[tuple[str, int], tuple[Field, ...] | None] = {}


def land_schemas(registry: DataFrame, folder: str) -> None:
    """Registry rows as a folder for look-ups, one small folder per schema id. Ids that are there already are written anew."""
    one = one_per_id(registry.where("schema_id is not null")).repartition("schema_id")
    writer = one.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("schema_id").parquet(folder)


def lookup_folder(spark: SparkSession, location: str, spare: str) -> str:
    """Where tasks look up the schemas of a registry.

    Response files and folders of land_schemas() are used as they are, so what is added there is found. Any other
    registry is landed in the spare folder first; later ids are found once they are landed there too.
    """
    if location.endswith(".json"):
        return full_path(spark, posixpath.dirname(location))
    if "/" in location and any("/schema_id=" in name for name in spark.read.parquet(location).inputFiles()):
        return full_path(spark, location)
    land_schemas(load_registry(spark, location), spare)
    return full_path(spark, spare)


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """A shared folder as tasks see it; a path without a scheme is refused, since each machine would read its own disk."""
    if "://" not in folder and not folder.startswith("file:"):
        raise ValueError(f"{folder!r} names no file system; qualify it first")
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


class SchemaFolder:
    """Schemas in a folder that land_schemas() wrote, or one of registry responses named `<schema id>.json`."""

    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")

    def fields(self, schema_id: int) -> tuple[Field, ...] | None:
        """Fields of a schema, None for one that is not read; KeyError for an id that is not there."""
        key = (self.folder, schema_id)
        if key not in _known:
            _known[key] = parsed(self._text(schema_id))
        return _known[key]

    def _text(self, schema_id: int) -> str:
        files, where = file_system(self.folder)
        response = posixpath.join(where, f"{schema_id}.json")
        landed = posixpath.join(where, f"schema_id={schema_id}")
        answer, folder = files.get_file_info([response, landed])
        if answer.type == fs.FileType.File:
            with files.open_input_stream(response) as opened:
                return json.loads(opened.read())["schema"]
        if folder.type == fs.FileType.Directory:
            found = files.get_file_info(fs.FileSelector(landed))
            for file in found:
                if file.is_file and file.extension == "parquet":
                    texts = pq.read_table(file.path, columns=["schema_json"], filesystem=files, partitioning=None).column(0)
                    if len(texts):
                        return texts[0].as_py()
        raise KeyError(schema_id)


class SchemaTexts:
    """Schemas given as parsed fields by id."""

    def __init__(self, schemas):
        self.schemas = dict(schemas)

    def fields(self, schema_id: int) -> tuple[Field, ...] | None:
        return self.schemas[schema_id]


def parsed(text: str | None) -> tuple[Field, ...] | None:
    try:
        fields = record_fields(text) if text is not None else None
    except (UnsupportedTypeError, SchemaConflictError):
        return None
    return fields if fields is None or len({f.name for f in fields}) == len(fields) else None


def lookup_of(ids: pa.Array, source) -> dict[int, tuple[Field, ...] | None]:
    """Schemas of the ids of a batch that are known."""
    out = {}
    for schema_id in ids.unique().drop_null().to_pylist():
        try:
            out[schema_id] = source.fields(schema_id)
        except KeyError:
            continue
    return out

