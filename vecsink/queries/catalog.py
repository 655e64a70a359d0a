"""Every query with the SQL that gives the same rows on the same tables.

Queries read whole tables. Their final columns are plain values, so results can
be compared by value; binary and nested columns are taken apart first.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecsink import fixtures
from vecsink.functions import convert
from vecsink.functions.convert import convert_column
from vecsink.operators import batching, checks, compare_ranges, decode, delivery, envelope, numbering, objects, offsets, rounds, variant_decode
from vecsink.plans.object_plan import ObjectPlan, plan_objects
from vecsink.plans.options import SinkOptions
from vecsink.plans.variant_plan import plan_variant_objects
from vecsink.sinks.writers import write_kafka
from vecsink.sources import collection, kafka, registry, schema_lookup, snapshots, target_class
from vecsink.sources.scratch import scratch_folder
from vecsink.streaming.runner import run_native_stream, run_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

CLASS = "Event"
BATCH_SIZE = 200
RETRIES = 2
STREAM_BATCHES = 4


def query(sql: str):
    """Register a query under its function name, with its SQL."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = sql
        return function

    return add


# --------------------------------------------------------------------------
# Parts shared by the SQL texts.

# Events as records: position, schema and the columns each schema has.
K = """WITH k AS (
  SELECT *, CAST(user_id % 4 AS INTEGER) AS part,
    row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS off,
    CASE WHEN event_id % 3 = 0 THEN 100001 ELSE 100002 END AS sid,
    date_trunc('millisecond', ts) AS ms
  FROM events)
"""


def _sql_rfc3339(column: str) -> str:
    return rf"regexp_replace(strftime({column}, '%Y-%m-%dT%H:%M:%S.%f'), '\.?0+$', '') || 'Z'"


_SQL_DIGEST = "sha1('events:' || part || ':' || off)"
SQL_ID = (
    f"substr({_SQL_DIGEST}, 1, 8) || '-' || substr({_SQL_DIGEST}, 9, 4) || '-5' || substr({_SQL_DIGEST}, 14, 3)"
    f" || '-8' || substr({_SQL_DIGEST}, 18, 3) || '-' || substr({_SQL_DIGEST}, 21, 12)"
)

SQL_OBJECT = f"""'{CLASS}' AS class, {SQL_ID} AS id, event_id, user_id, event_type, value,
  CASE WHEN sid = 100002 THEN props END AS props,
  CASE WHEN sid = 100002 THEN event_type = 'error' END AS is_error,
  CAST(user_id AS VARCHAR) AS _kafka_key, 'events' AS _kafka_topic, part AS _kafka_partition,
  CAST(off AS BIGINT) AS _kafka_offset, {_sql_rfc3339("ms")} AS _kafka_timestamp,
  0 AS "_kafka_timestampType", sid AS "_kafka_schemaId" """

# Remainders of event_id % 50 below this are damaged records.
SQL_DAMAGED = "event_id % 50 < 4"


def _sql_varint_bytes(value: str) -> str:
    limits = " ".join(f"WHEN {value} < {64 << (7 * n)} THEN {n + 1}" for n in range(8))
    return f"(CASE {limits} END)"


def _sql_text_bytes(text: str) -> str:
    size = f"octet_length(encode({text}))"
    return f"({_sql_varint_bytes(size)} + {size})"


SQL_BODY_BYTES = (
    f"{_sql_varint_bytes('event_id')} + {_sql_varint_bytes('user_id')} + {_sql_text_bytes('event_type')} + 8"
    f" + CASE WHEN sid = 100002 THEN {_sql_text_bytes('props')} + 1 ELSE 0 END"
)


# --------------------------------------------------------------------------
# Parts shared by the queries.


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.parse_envelope(fixtures.kafka_events(spark, sf_dir))


def _plan(frame: DataFrame, **options: object) -> ObjectPlan:
    return plan_objects(frame, fixtures.SCHEMAS, SinkOptions.parse({"className": CLASS, **options}))


def _flat(frame: DataFrame) -> DataFrame:
    return frame.select("class", "id", "properties.*")


def _read_sent(spark: SparkSession, path: str, shape: DataFrame) -> DataFrame:
    """Stored wire objects with their JSON properties typed again."""
    stored = collection.read_collection(spark, path, CLASS)
    typed = F.from_json("properties", shape.schema["properties"].dataType.simpleString())
    return _flat(stored.withColumn("properties", typed))


def _landed(spark: SparkSession, sf_dir: str, folder: str, damaged: bool = False) -> DataFrame:
    """Records landed as files, as a stream of a few micro-batches at any size."""
    source = fixtures.damaged_events if damaged else fixtures.kafka_events
    source(spark, sf_dir).write.partitionBy("partition").parquet(folder)
    files = len(spark.read.parquet(folder).inputFiles())
    return kafka.stream_kafka_files(spark, folder, math.ceil(files / STREAM_BATCHES))


# --------------------------------------------------------------------------
# Sources and the record envelope.


@query(
    f"""{K} SELECT 'events' AS topic, part AS "partition", CAST(off AS BIGINT) AS "offset",
  epoch_us(ts) AS timestamp_micros, 0 AS timestamp_type, octet_length(encode(CAST(user_id AS VARCHAR))) AS key_bytes,
  CAST(5 + {SQL_BODY_BYTES} AS INTEGER) AS value_bytes FROM k"""
)
def kafka_scan(spark, sf_dir):
    records = kafka.check_kafka_schema(fixtures.kafka_events(spark, sf_dir))
    return records.select(
        "topic",
        "partition",
        "offset",
        F.unix_micros("timestamp").alias("timestamp_micros"),
        F.col("timestampType").alias("timestamp_type"),
        F.octet_length("key").alias("key_bytes"),
        F.octet_length("value").alias("value_bytes"),
    )


@query(f"""{K} SELECT part AS "partition", CAST(off AS BIGINT) AS "offset", CAST(user_id AS VARCHAR) AS key_text FROM k""")
def key_decode(spark, sf_dir):
    return _parsed(spark, sf_dir).select("partition", "offset", "key_text")


@query(
    f"""{K} SELECT part AS "partition", CAST(off AS BIGINT) AS "offset", sid AS schema_id,
  CAST({SQL_BODY_BYTES} AS INTEGER) AS payload_bytes FROM k"""
)
def wire_schema_id(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        "partition", "offset", "schema_id", F.octet_length("payload").alias("payload_bytes")
    )


@query(f"""{K} SELECT part AS "partition", CAST(off AS BIGINT) AS "offset", epoch_us(ms) AS event_micros FROM k""")
def ts_millis(spark, sf_dir):
    return _parsed(spark, sf_dir).select("partition", "offset", F.unix_micros("event_time").alias("event_micros"))


@query(f"{K} SELECT DISTINCT sid AS schema_id FROM k")
def distinct_schema_ids(spark, sf_dir):
    return envelope.distinct_schema_ids(_parsed(spark, sf_dir))


@query(
    f"""{K} SELECT sid AS schema_id, count(*) AS messages, CAST(min(off) AS BIGINT) AS min_offset,
  CAST(max(off) AS BIGINT) AS max_offset FROM k GROUP BY sid"""
)
def schema_group_stats(spark, sf_dir):
    return envelope.schema_statistics(_parsed(spark, sf_dir))


@query(
    f"""{K} SELECT CASE WHEN event_id % 50 = 3 THEN 999999 ELSE sid END AS schema_id,
  CASE WHEN event_id % 50 = 3 THEN NULL WHEN sid = 100001 THEN 4 ELSE 6 END AS field_count, count(*) AS messages
FROM k WHERE event_id % 50 NOT IN (0, 1, 2) GROUP BY ALL"""
)
def registry_lookup(spark, sf_dir):
    parsed = envelope.parse_envelope(fixtures.damaged_events(spark, sf_dir)).where("reject_reason IS NULL")
    known = registry.registry_from_responses(fixtures.registry(spark))
    # Counted per id first: the join then sees one row per schema.
    counted = parsed.groupBy("schema_id").agg(F.count(F.lit(1)).alias("messages"))
    fields = F.json_array_length(F.get_json_object("schema_json", "$.fields"))
    return registry.with_schema_text(counted, known).select("schema_id", fields.alias("field_count"), "messages")


# --------------------------------------------------------------------------
# Decoding.


@query(
    f"""{K} SELECT part AS "partition", CAST(off AS BIGINT) AS "offset", event_id, user_id, event_type, value
FROM k WHERE sid = 100001"""
)
def avro_decode_single(spark, sf_dir):
    schema = {fixtures.V1: fixtures.SCHEMAS[fixtures.V1]}
    chosen = envelope.of_schema(_parsed(spark, sf_dir), fixtures.V1)
    return decode.accepted(decode.decode_values(chosen, schema)).select("partition", "offset", "record.*")


@query(
    f"""{K} SELECT part AS "partition", CAST(off AS BIGINT) AS "offset", sid AS schema_id, event_id, user_id,
  event_type, value, CASE WHEN sid = 100002 THEN props END AS props,
  CASE WHEN sid = 100002 THEN event_type = 'error' END AS is_error FROM k"""
)
def avro_decode_multi(spark, sf_dir):
    decoded = decode.decode_values(_parsed(spark, sf_dir), fixtures.SCHEMAS)
    return decode.accepted(decoded).select("partition", "offset", "schema_id", "record.*")


@query(
    f"""{K} SELECT event_id, CASE WHEN sid = 100002 THEN event_type = 'error' END AS is_error, sid AS "_kafka_schemaId" FROM k"""
)
def avro_decode_fields(spark, sf_dir):
    plan = plan_objects(
        fixtures.kafka_events(spark, sf_dir),
        fixtures.SCHEMAS,
        SinkOptions.parse({"className": CLASS}),
        fields=["event_id", "is_error"],
    )
    return plan.rows().select("event_id", "is_error", "_kafka_schemaId")


@query(
    f"""{K} SELECT event_id, CAST(user_id AS VARCHAR) AS _kafka_key, 'events' AS _kafka_topic, part AS _kafka_partition,
  CAST(off AS BIGINT) AS _kafka_offset, epoch_us(ms) AS _kafka_timestamp, 0 AS "_kafka_timestampType",
  sid AS "_kafka_schemaId" FROM k"""
)
def enrich_metadata(spark, sf_dir):
    rows = _plan(fixtures.kafka_events(spark, sf_dir)).rows()
    return rows.select(
        "event_id",
        "_kafka_key",
        "_kafka_topic",
        "_kafka_partition",
        "_kafka_offset",
        F.unix_micros("_kafka_timestamp").alias("_kafka_timestamp"),
        "_kafka_timestampType",
        "_kafka_schemaId",
    )


@query(
    f"""{K} SELECT part AS "partition", CAST(off AS BIGINT) AS "offset",
  CASE event_id % 50 WHEN 0 THEN 'null_value' WHEN 1 THEN 'short_value' WHEN 2 THEN 'bad_magic'
    ELSE 'unknown_schema' END AS reject_reason,
  CASE event_id % 50 WHEN 2 THEN sid WHEN 3 THEN 999999 END AS schema_id
FROM k WHERE {SQL_DAMAGED}"""
)
def rejects(spark, sf_dir):
    plan = _plan(fixtures.damaged_events(spark, sf_dir))
    return plan.rejects().select("partition", "offset", "reject_reason", "schema_id")


@query(f"{K} SELECT {SQL_OBJECT} FROM k WHERE NOT ({SQL_DAMAGED})")
def accepted_objects(spark, sf_dir):
    return _flat(_plan(fixtures.damaged_events(spark, sf_dir)).objects())


# --------------------------------------------------------------------------
# Type rules and scalar conversions.

# (table, column, type in Spark, verdict, advice), whole tables.
_CENSUS = [
    ("events", "event_id", "bigint", "accepted", None),
    ("events", "ts", "timestamp_ntz", "rejected", None),
    ("events", "user_id", "bigint", "accepted", None),
    ("events", "event_type", "string", "accepted", None),
    ("events", "value", "double", "accepted", None),
    ("events", "props", "string", "accepted", None),
    ("customer", "c_custkey", "bigint", "accepted", None),
    ("customer", "c_name", "string", "accepted", None),
    ("customer", "c_nationkey", "int", "accepted", None),
    ("customer", "c_acctbal", "double", "accepted", None),
    ("customer", "c_mktsegment", "string", "accepted", None),
    ("embeddings", "vec_id", "bigint", "accepted", None),
    ("embeddings", "embedding", "array<float>", "rejected", "array<double>"),
    ("embeddings", "label", "int", "accepted", None),
]


def _sql_census() -> str:
    def text(value):
        return "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"

    lines = [
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{kind}' AS spark_type, '{verdict}' AS verdict,"
        f" {text(advice)} AS cast_to, count({column}) AS present_values FROM {table}"
        for table, column, kind, verdict, advice in _CENSUS
    ]
    return "\nUNION ALL ".join(lines)


@query(_sql_census())
def type_matrix(spark, sf_dir):
    tables = [
        checks.type_census(spark.read.parquet(f"{sf_dir}/{name}.parquet"), name)
        for name in ("events", "customer", "embeddings")
    ]
    return tables[0].unionByName(tables[1]).unionByName(tables[2])


@query(
    """SELECT l_orderkey AS row_key, l_linenumber AS row_line, coalesce(nullif(l_returnflag, 'R'), '') AS text_value,
  coalesce(nullif(l_linestatus = 'O', true), false) AS flag_value, coalesce(nullif(l_linenumber, 1), 0) AS int_value,
  nullif(l_suppkey, 1) AS long_value, coalesce(nullif(l_discount, 0.05), 0.0) AS double_value FROM lineitem"""
)
def null_defaults(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    holed = lines.select(
        F.col("l_orderkey").alias("row_key"),
        F.col("l_linenumber").alias("row_line"),
        F.nullif("l_returnflag", F.lit("R")).alias("text_value"),
        F.nullif(F.col("l_linestatus") == "O", F.lit(True)).alias("flag_value"),
        F.nullif("l_linenumber", F.lit(1)).alias("int_value"),
        F.nullif("l_suppkey", F.lit(1).cast("bigint")).alias("long_value"),
        F.nullif("l_discount", F.lit(0.05)).alias("double_value"),
    )
    return holed.select(*[convert_column(f).alias(f.name) for f in holed.schema.fields])


@query(
    """WITH a AS (SELECT p_partkey,
    CASE WHEN p_size % 5 <> 0 THEN list_transform(string_split(p_name, ' '), lambda x: nullif(x, 'red')) END AS words,
    CASE WHEN p_size % 5 <> 1 THEN [p_retailprice, CAST(p_size AS DOUBLE)] END AS numbers,
    CASE WHEN p_size % 5 <> 2 THEN [p_size, p_size * 2] END AS counts FROM part)
SELECT p_partkey,
  array_to_string(list_transform(coalesce(words, CAST([] AS VARCHAR[])), lambda x: coalesce(x, '')), '|') AS words,
  CAST(coalesce(len(numbers), 0) AS INTEGER) AS numbers_size, list_extract(numbers, 1) AS first_number,
  CAST(coalesce(len(counts), 0) AS INTEGER) AS counts_size, list_extract(counts, 2) AS last_count FROM a"""
)
def array_defaults(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    size = F.col("p_size")
    holed = part.select(
        "p_partkey",
        F.when(size % 5 != 0, F.transform(F.split("p_name", " "), lambda x: F.nullif(x, F.lit("red")))).alias("words"),
        F.when(size % 5 != 1, F.array("p_retailprice", size.cast("double"))).alias("numbers"),
        F.when(size % 5 != 2, F.array(size, size * 2)).alias("counts"),
    )
    held = holed.select(*[convert_column(f).alias(f.name) for f in holed.schema.fields])
    return held.select(
        "p_partkey",
        F.array_join("words", "|").alias("words"),
        F.size("numbers").alias("numbers_size"),
        F.get("numbers", F.lit(0)).alias("first_number"),
        F.size("counts").alias("counts_size"),
        F.get("counts", F.lit(1)).alias("last_count"),
    )


@query(f"SELECT event_id, {_sql_rfc3339('ts')} AS written FROM events")
def rfc3339_timestamp(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select("event_id", convert.rfc3339_timestamp(fixtures.instant(F.col("ts"))).alias("written"))


@query("SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%dT00:00:00Z') AS written FROM lineitem")
def rfc3339_date(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lines.select("l_orderkey", "l_linenumber", convert.rfc3339_date(F.col("l_shipdate").cast("date")).alias("written"))


# --------------------------------------------------------------------------
# Objects.


@query(f"{K} SELECT {SQL_OBJECT} FROM k")
def build_objects(spark, sf_dir):
    return _flat(_plan(fixtures.kafka_events(spark, sf_dir)).objects())


@query(
    f"""{K} SELECT '{CLASS}' AS class, CAST(event_id AS VARCHAR) AS id, user_id, value, CAST(off AS BIGINT) AS _kafka_offset
FROM k"""
)
def objects_by_id_column(spark, sf_dir):
    built = _plan(fixtures.kafka_events(spark, sf_dir), ID="EVENT_ID").objects()
    return built.select("class", "id", "properties.user_id", "properties.value", "properties._kafka_offset")


@query(f"""{K} SELECT part AS "partition", CAST(off AS BIGINT) AS "offset", {SQL_ID} AS id FROM k""")
def object_ids(spark, sf_dir):
    built = _plan(fixtures.kafka_events(spark, sf_dir)).objects()
    return built.select(
        F.col("properties._kafka_partition").alias("partition"), F.col("properties._kafka_offset").alias("offset"), "id"
    )


@query(
    """SELECT 'Vector' AS class, CAST(vec_id AS VARCHAR) AS id, label, CAST(len(embedding) AS INTEGER) AS dimensions,
  CAST(embedding[1] AS DOUBLE) AS first_value, CAST(embedding[len(embedding)] AS DOUBLE) AS last_value FROM embeddings"""
)
def vector_split(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    built = objects.to_objects(vectors, "Vector", id_column="vec_id", vector_column="embedding")
    return built.select(
        "class",
        "id",
        "properties.label",
        F.size("vector").alias("dimensions"),
        F.get("vector", F.lit(0)).cast("double").alias("first_value"),
        F.element_at("vector", -1).cast("double").alias("last_value"),
    )


@query(
    f"""SELECT c_custkey, json_extract_string(j, '$.c_name') AS name,
  CAST(json_extract(j, '$.c_acctbal') AS DOUBLE) AS balance, CAST(json_extract(j, '$.c_nationkey') AS INTEGER) AS nation
FROM (SELECT c_custkey, to_json({{'c_name': c_name, 'c_acctbal': c_acctbal, 'c_nationkey': c_nationkey}}) AS j FROM customer)"""
)
def wire_json(spark, sf_dir):
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    sent = objects.to_wire(objects.to_objects(customers, "Customer", id_column="c_custkey"))
    return sent.select(
        F.col("id").cast("bigint").alias("c_custkey"),
        F.get_json_object("properties", "$.c_name").alias("name"),
        F.get_json_object("properties", "$.c_acctbal").cast("double").alias("balance"),
        F.get_json_object("properties", "$.c_nationkey").cast("int").alias("nation"),
    )


# --------------------------------------------------------------------------
# Batches.


@query(
    f"""{K} SELECT part AS "partition", CAST(floor(off / {BATCH_SIZE}) AS BIGINT) AS batch_no, count(*) AS batch_rows,
  CAST(min(off) AS BIGINT) AS min_offset, CAST(max(off) AS BIGINT) AS max_offset FROM k GROUP BY 1, 2"""
)
def assign_batches(spark, sf_dir):
    batches = batching.assign_batches(fixtures.kafka_events(spark, sf_dir), BATCH_SIZE)
    return batches.groupBy("partition", "batch_no").agg(
        F.count(F.lit(1)).alias("batch_rows"),
        F.min("offset").alias("min_offset"),
        F.max("offset").alias("max_offset"),
    )


@query(
    f"""{K}, r AS (SELECT *, CAST(floor(off / {BATCH_SIZE}) AS BIGINT) AS batch_no, row_number() OVER (
    PARTITION BY part, floor(off / {BATCH_SIZE}), user_id ORDER BY off DESC) AS rn FROM k)
SELECT part AS "partition", batch_no, CAST(user_id AS VARCHAR) AS id, CAST(off AS BIGINT) AS "offset", event_id
FROM r WHERE rn = 1"""
)
def keep_last(spark, sf_dir):
    batches = batching.assign_batches(fixtures.kafka_events(spark, sf_dir), BATCH_SIZE)
    named = _plan(batches).rows(keep=["batch_no"]).withColumn("id", F.col("user_id").cast("string"))
    keys = ["_kafka_topic", "_kafka_partition", "batch_no", "id"]
    last = batching.keep_last(named, keys, [F.col("_kafka_offset")])
    return last.select(
        F.col("_kafka_partition").alias("partition"),
        "batch_no",
        "id",
        F.col("_kafka_offset").alias("offset"),
        "event_id",
    )


# --------------------------------------------------------------------------
# Delivery.


def flaky_transport(batch: pa.RecordBatch, attempt: int) -> pa.Array:
    """Refuses an object on its first `event_id % 4` attempts."""
    matched = pc.extract_regex(batch.column("properties"), r'"event_id":(?P<n>\d+)')
    numbers = pc.struct_field(matched, "n").cast(pa.int64())
    refusals = pc.subtract(numbers, pc.multiply(pc.divide(numbers, 4), 4))
    refused = pc.greater_equal(refusals, attempt)
    return pc.if_else(refused, pa.scalar(f"refused at attempt {attempt}"), pa.scalar(None, pa.string()))


def _outcomes(frame: DataFrame) -> DataFrame:
    how = delivery.Delivery(batch_size=BATCH_SIZE, retries=RETRIES, backoff=0)
    return delivery.deliver(frame, flaky_transport, how)


@query(
    f"""{K} SELECT {SQL_ID} AS id, CAST(least(event_id % 4 + 1, {RETRIES + 1}) AS INTEGER) AS attempt,
  CASE WHEN event_id % 4 <= {RETRIES} THEN 'sent' ELSE 'failed' END AS status,
  CASE WHEN event_id % 4 > {RETRIES} THEN 'refused at attempt {RETRIES + 1}' END AS error FROM k"""
)
def write_outcomes(spark, sf_dir):
    return _outcomes(_plan(fixtures.kafka_events(spark, sf_dir)).objects())


@query(
    f"""{K} SELECT status, attempt, count(*) AS objects FROM (SELECT
  CASE WHEN event_id % 4 <= {RETRIES} THEN 'sent' ELSE 'failed' END AS status,
  CAST(least(event_id % 4 + 1, {RETRIES + 1}) AS INTEGER) AS attempt FROM k) GROUP BY ALL"""
)
def outcome_split(spark, sf_dir):
    outcomes = _outcomes(_plan(fixtures.kafka_events(spark, sf_dir)).objects())
    return outcomes.groupBy("status", "attempt").agg(F.count(F.lit(1)).alias("objects"))


@query(f"{K} SELECT {SQL_ID} AS id, event_id FROM k WHERE event_id % 4 > {RETRIES}")
def retry_remaining(spark, sf_dir):
    built = _plan(fixtures.kafka_events(spark, sf_dir)).objects()
    # Outcomes are written once: reading them again must not send again.
    folder = scratch_folder(spark, "outcomes")
    _outcomes(built).write.parquet(folder)
    left = delivery.remaining(built, spark.read.parquet(folder))
    return left.select("id", "properties.event_id")


# --------------------------------------------------------------------------
# Sinks and read-back.


@query(f"{K} SELECT {SQL_OBJECT} FROM k")
def batch_sink(spark, sf_dir):
    path = scratch_folder(spark, "sent")
    records = fixtures.kafka_events(spark, sf_dir)
    options = {"className": CLASS, "batchsize": BATCH_SIZE, "path": path}
    write_kafka(records, options, fixtures.SCHEMAS, transport=delivery.accept_all)
    return _read_sent(spark, path, _plan(records).objects())


@query(f"{K} SELECT {SQL_OBJECT} FROM k")
def batch_collection(spark, sf_dir):
    path = scratch_folder(spark, "collection")
    write_kafka(fixtures.kafka_events(spark, sf_dir), {"className": CLASS, "path": path}, fixtures.SCHEMAS)
    return _flat(collection.read_collection(spark, path, CLASS))


@query(
    f"""{K}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY off DESC) AS rn FROM k)
SELECT '{CLASS}' AS class, CAST(user_id AS VARCHAR) AS id, event_id, CAST(off AS BIGINT) AS _kafka_offset FROM r WHERE rn = 1"""
)
def collection_upsert(spark, sf_dir):
    path = scratch_folder(spark, "upsert")
    options = {"className": CLASS, "path": path, "id": "user_id"}
    write_kafka(fixtures.kafka_events(spark, sf_dir), options, fixtures.SCHEMAS)
    stored = collection.read_collection(spark, path, CLASS)
    return stored.select("class", "id", "properties.event_id", "properties._kafka_offset")


@query(f"{K} SELECT '{CLASS}' AS class, count(*) AS objects FROM k")
def object_counts(spark, sf_dir):
    path = scratch_folder(spark, "counts")
    write_kafka(fixtures.kafka_events(spark, sf_dir), {"className": CLASS, "path": path}, fixtures.SCHEMAS)
    return collection.object_counts(spark, path)


@query(
    f"""{K} SELECT CAST(count(*) AS BIGINT) AS source_rows, CAST(count(*) AS BIGINT) AS stored_objects, true AS matches FROM k"""
)
def reconcile(spark, sf_dir):
    path = scratch_folder(spark, "reconcile")
    records = fixtures.kafka_events(spark, sf_dir)
    write_kafka(records, {"className": CLASS, "path": path}, fixtures.SCHEMAS)
    return checks.reconcile(records, collection.stored_ids(spark, path, CLASS))


@query(
    f"""{K}, n AS (SELECT count(*) AS every, count(*) FILTER (sid = 100002) AS second FROM k)
SELECT v.* FROM n, LATERAL (VALUES
  ('_kafka_key', 'string', 'string', every, 'ok'), ('_kafka_topic', 'string', 'string', every, 'ok'),
  ('_kafka_partition', 'int', 'int', every, 'ok'), ('_kafka_offset', 'int', 'int', every, 'ok'),
  ('_kafka_timestamp', 'date', 'date', every, 'ok'), ('_kafka_timestampType', 'int', 'int', every, 'ok'),
  ('_kafka_schema_id', 'string', NULL, 0, 'not_produced'), ('_kafka_schemaId', NULL, 'int', every, 'undeclared'),
  ('event_id', 'int', 'int', every, 'ok'), ('user_id', 'int', 'int', every, 'ok'),
  ('event_type', 'string', 'string', every, 'ok'), ('value', 'number', 'number', every, 'ok'),
  ('props', 'string', 'string', second, 'ok'), ('is_error', NULL, 'boolean', second, 'undeclared')
) v(property, declared_type, produced_type, produced_values, status)"""
)
def class_conformance(spark, sf_dir):
    rows = _plan(fixtures.kafka_events(spark, sf_dir)).rows()
    return checks.class_conformance(rows, target_class.parse_class(fixtures.target_class(spark)))


@query(f"{K} SELECT {SQL_OBJECT} FROM k ORDER BY id LIMIT 3")
def sample(spark, sf_dir):
    return _flat(checks.sample_objects(_plan(fixtures.kafka_events(spark, sf_dir)).objects()))


# --------------------------------------------------------------------------
# Streams.


@query(f"{K} SELECT {SQL_OBJECT} FROM k")
def stream_foreach_batch(spark, sf_dir):
    folder = scratch_folder(spark, "stream")
    stream = _landed(spark, sf_dir, f"{folder}/landed")
    options = {"className": CLASS, "path": f"{folder}/collection", "run": "events-load"}
    run_stream(stream, options, f"{folder}/checkpoint", fixtures.SCHEMAS).finish()
    return _flat(collection.read_collection(spark, f"{folder}/collection", CLASS))


@query(f"{K} SELECT {SQL_OBJECT} FROM k")
def stream_native_sink(spark, sf_dir):
    folder = scratch_folder(spark, "native")
    stream = _landed(spark, sf_dir, f"{folder}/landed")
    options = {"className": CLASS, "path": f"{folder}/collection", "run": "events-native", "batchSize": BATCH_SIZE}
    run_native_stream(stream, options, f"{folder}/checkpoint", fixtures.SCHEMAS).awaitTermination()
    shape = _plan(fixtures.kafka_events(spark, sf_dir)).objects()
    return _read_sent(spark, f"{folder}/collection", shape)


@query(
    f"""SELECT CAST(count(*) AS BIGINT) AS seen_rows, count(*) FILTER ({SQL_DAMAGED}) AS rejected_rows,
  count(*) FILTER ({SQL_DAMAGED}) AS stored_rejects, count(*) FILTER (NOT ({SQL_DAMAGED})) AS stored_objects FROM events"""
)
def stream_totals(spark, sf_dir):
    folder = scratch_folder(spark, "totals")
    stream = _landed(spark, sf_dir, f"{folder}/landed", damaged=True)
    options = {
        "className": CLASS,
        "path": f"{folder}/collection",
        "keepRejects": True,
        "run": "events-totals",
    }
    totals = run_stream(stream, options, f"{folder}/checkpoint", fixtures.SCHEMAS).finish()
    stored = collection.batch_totals(spark, f"{folder}/collection", CLASS, "events-totals")
    kept = collection.read_rejects(spark, f"{folder}/collection", CLASS).agg(F.count(F.lit(1)).alias("n"))

    def tagged(frame: DataFrame, value: Column, name: str) -> DataFrame:
        return frame.select(F.lit(name).alias("measure"), value.alias("amount"))

    both = tagged(kept, F.col("n"), "rejects").unionByName(tagged(stored, F.col("rows"), "objects"))
    return both.agg(
        F.lit(totals.rows).cast("bigint").alias("seen_rows"),
        F.lit(totals.rejected).cast("bigint").alias("rejected_rows"),
        F.coalesce(F.sum(F.when(F.col("measure") == "rejects", F.col("amount"))), F.lit(0)).alias("stored_rejects"),
        F.coalesce(F.sum(F.when(F.col("measure") == "objects", F.col("amount"))), F.lit(0)).alias("stored_objects"),
    )


# --------------------------------------------------------------------------
# Registries, clashing types, stored forms.


def _registry_folder(spark: SparkSession) -> str:
    folder = scratch_folder(spark, "registry")
    fixtures.wide_registry(spark).write.parquet(folder)
    return folder


@query(f"{K} SELECT {SQL_OBJECT} FROM k")
def registry_decode(spark, sf_dir):
    """Registry responses to stored objects, with thousands of other schemas in the registry."""
    path = scratch_folder(spark, "looked-up")
    options = {"className": CLASS, "path": path, "registry": _registry_folder(spark)}
    write_kafka(fixtures.kafka_events(spark, sf_dir), options)
    return _flat(collection.read_collection(spark, path, CLASS))


@query(
    f"""{K} SELECT {SQL_ID} AS id, event_id, CASE WHEN sid = 100002 THEN props ELSE CAST(user_id AS VARCHAR) END AS props,
  CASE WHEN sid = 100002 THEN 'text' ELSE 'number' END AS kind FROM k"""
)
def decode_conflicting(spark, sf_dir):
    """One field as text in one schema and as a number in another, under its one name."""
    schemas = {fixtures.V2: fixtures.SCHEMAS[fixtures.V2], fixtures.V4: fixtures.MORE_SCHEMAS[fixtures.V4]}
    plan = plan_objects(fixtures.clashing_events(spark, sf_dir).drop("event_id"), schemas, SinkOptions.parse({"className": CLASS}))
    sent = objects.to_wire(plan.objects())
    kind = F.schema_of_variant(F.try_variant_get(F.parse_json("properties"), "$.props", "variant"))
    return sent.select(
        "id",
        F.get_json_object("properties", "$.event_id").cast("long").alias("event_id"),
        F.get_json_object("properties", "$.props").alias("props"),
        F.when(kind == "STRING", "text").otherwise("number").alias("kind"),
    )


@query(
    """SELECT event_id, CAST(event_id % 1000 AS INTEGER) AS small, CAST(CAST(value / 2 AS FLOAT) AS DOUBLE) AS half, event_type AS blob,
  CASE WHEN event_id % 2 = 0 THEN event_type END AS maybe_text, CASE WHEN event_id % 3 = 0 THEN event_id END AS maybe_number FROM events"""
)
def avro_decode_types(spark, sf_dir):
    parsed = envelope.parse_envelope(fixtures.typed_events(spark, sf_dir).drop("event_id"))
    decoded = decode.accepted(decode.decode_values(parsed, fixtures.MORE_SCHEMAS)).select("record.*")
    return decoded.select("event_id", "small", F.col("half").cast("double").alias("half"), F.decode("blob", "UTF-8").alias("blob"), "maybe_text", "maybe_number")


@query(
    f"""{K} SELECT part AS "partition", CAST(off AS BIGINT) AS "offset",
  CASE event_id % 50 WHEN 0 THEN 'null_value' WHEN 1 THEN 'short_value' WHEN 2 THEN 'bad_magic' WHEN 3 THEN 'unknown_schema'
    WHEN 4 THEN 'unsupported_schema' WHEN 5 THEN 'bad_payload' ELSE 'null_id' END AS reject_reason
FROM k WHERE event_id % 50 < 7"""
)
def rejects_all(spark, sf_dir):
    """Every reason for which a record is set aside."""
    schemas = {**fixtures.SCHEMAS, fixtures.UNREADABLE: None}
    plan = plan_objects(fixtures.all_damages(spark, sf_dir), schemas, SinkOptions.parse({"className": CLASS}))
    return plan.rejects().select("partition", "offset", "reject_reason")


@query(
    f"""{K}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY part DESC, off DESC) AS rn FROM k)
SELECT '{CLASS}' AS class, CAST(user_id AS VARCHAR) AS id, event_id, CAST(off AS BIGINT) AS "offset" FROM r WHERE rn = 1"""
)
def sent_upsert(spark, sf_dir):
    """The last of the sent objects of each id."""
    path = scratch_folder(spark, "sent-upsert")
    options = {"className": CLASS, "path": path, "id": "user_id", "batchSize": BATCH_SIZE}
    write_kafka(fixtures.kafka_events(spark, sf_dir), options, fixtures.SCHEMAS, transport=delivery.accept_all)
    stored = collection.read_collection(spark, path, CLASS)
    return stored.select("class", "id", F.get_json_object("properties", "$.event_id").cast("long").alias("event_id"), "offset")


@query(f"{K} SELECT {SQL_OBJECT} FROM k")
def two_classes(spark, sf_dir):
    """A class is read by itself, beside one whose `props` is a number."""
    path = scratch_folder(spark, "classes")
    write_kafka(fixtures.kafka_events(spark, sf_dir), {"className": CLASS, "path": path}, fixtures.SCHEMAS)
    other = {fixtures.V4: fixtures.MORE_SCHEMAS[fixtures.V4]}
    records = fixtures.clashing_events(spark, sf_dir).where("event_id % 3 = 0").drop("event_id")
    write_kafka(records, {"className": "Other", "path": path}, other)
    return _flat(collection.read_collection(spark, path, CLASS))


def refuse_all(batch: pa.RecordBatch, attempt: int) -> pa.Array:
    return pa.array(["refused"] * batch.num_rows, pa.string())


@query(f"{K} SELECT {SQL_OBJECT} FROM k")
def failed_replay(spark, sf_dir):
    """What a batch has stored is still there after the batch was sent again and refused."""
    path = scratch_folder(spark, "replayed")
    records = fixtures.kafka_events(spark, sf_dir)
    options = {"className": CLASS, "path": path, "run": "again", "retries": 0, "batchSize": BATCH_SIZE}
    write_kafka(records, options, fixtures.SCHEMAS, transport=delivery.accept_all, batch_id=1)
    try:
        write_kafka(records, options, fixtures.SCHEMAS, transport=refuse_all, batch_id=1)
    except Exception as refused:
        if "could not be sent" not in str(refused):
            raise
    else:
        raise AssertionError("the second run was not refused")
    return _read_sent(spark, path, _plan(records).objects())


@query(f"{K} SELECT {SQL_OBJECT} FROM k")
def stream_new_schema(spark, sf_dir):
    """One running native stream that meets a schema id registered after its start."""
    folder = scratch_folder(spark, "new-schema")
    records, landed, schemas = fixtures.kafka_events(spark, sf_dir), f"{folder}/landed", f"{folder}/schemas"
    own = envelope.parse_envelope(records).withColumn("late", F.col("schema_id") == fixtures.V2)
    known = registry.registry_from_responses(fixtures.registry(spark))
    options = {"className": CLASS, "path": f"{folder}/collection", "run": "events-lookup", "registry": schemas, "batchSize": BATCH_SIZE}
    run = None
    for late, schema_id in ((False, fixtures.V1), (True, fixtures.V2)):
        schema_lookup.land_schemas(known.where(F.col("schema_id") == schema_id), schemas)
        own.where(F.col("late") == late).select(*records.columns).write.mode("append").parquet(landed)
        if run is None:
            run = run_native_stream(kafka.stream_kafka_files(spark, landed, 1_000), options, f"{folder}/checkpoint", trigger_seconds=0.5)
        run.processAllAvailable()
    run.stop()
    return _read_sent(spark, f"{folder}/collection", _plan(records).objects())


# --------------------------------------------------------------------------
# Records that keep their own types.

_SQL_MIXED = f"""CASE event_id % 4 WHEN 0 THEN CAST(user_id % 1000 AS VARCHAR) WHEN 1 THEN CAST(event_id + {fixtures.LARGE} AS VARCHAR)
    WHEN 3 THEN event_type END"""


@query(
    f"""{K} SELECT part AS "partition", CAST(off AS BIGINT) AS "offset", CAST(200001 + event_id % 4 AS INTEGER) AS schema_id, event_id,
  ['BIGINT', 'BIGINT', 'DOUBLE', 'STRING'][event_id % 4 + 1] AS kind, {_SQL_MIXED} AS exact,
  CASE WHEN event_id % 4 = 2 THEN value END AS fraction, event_type AS named, CASE WHEN event_id % 3 = 0 THEN event_id END AS sold FROM k"""
)
def decode_variant(spark, sf_dir):
    """Records of four schemas in one column; one field is an int, a long beyond 2**53, a double or a string."""
    parsed = envelope.parse_envelope(fixtures.mixed_events(spark, sf_dir))
    records = decode.accepted(variant_decode.decode_variants(parsed, schema_lookup.SchemaTexts(fixtures.MIXED_SCHEMAS)))

    def value(name: str, kind: str) -> Column:
        return F.variant_get("record", f"$.{name}", kind)

    kind = F.schema_of_variant(value("mixed", "variant"))
    return records.select(
        "partition",
        "offset",
        "schema_id",
        value("event_id", "bigint").alias("event_id"),
        kind.alias("kind"),
        F.when(kind != "DOUBLE", value("mixed", "string")).alias("exact"),
        F.when(kind == "DOUBLE", value("mixed", "double")).alias("fraction"),
        value("sold__as_is", "string").alias("named"),
        value("sold", "bigint").alias("sold"),
    )


def _mixed_properties(sent: DataFrame) -> DataFrame:
    """Sent objects of the mixed records, taken apart."""

    def raw(name: str) -> Column:
        return F.get_json_object("properties", f"$.{name}")

    kind = F.schema_of_variant(F.try_variant_get(F.parse_json("properties"), "$.mixed", "variant"))
    # A double is written with a point, which a decimal holds as it is.
    fraction = ~kind.isin("STRING", "BIGINT")
    return sent.select(
        "class",
        "id",
        raw("event_id").cast("bigint").alias("event_id"),
        F.when(~fraction, raw("mixed")).alias("exact"),
        F.when(fraction, raw("mixed").cast("double")).alias("fraction"),
        raw("sold__as_is").alias("named"),
        raw("sold").cast("bigint").alias("sold"),
        raw("_kafka_schemaId").cast("int").alias("_kafka_schemaId"),
        raw("_kafka_timestamp").alias("_kafka_timestamp"),
        F.json_array_length(F.to_json(F.json_object_keys("properties"))).alias("names"),
    )


_SQL_MIXED_OBJECT = f"""{K} SELECT '{CLASS}' AS class, {SQL_ID} AS id, event_id, {_SQL_MIXED} AS exact,
  CASE WHEN event_id % 4 = 2 THEN value END AS fraction, event_type AS named, CASE WHEN event_id % 3 = 0 THEN event_id END AS sold,
  CAST(200001 + event_id % 4 AS INTEGER) AS "_kafka_schemaId", {_sql_rfc3339("ms")} AS _kafka_timestamp,
  CASE WHEN event_id % 3 = 0 THEN 11 ELSE 10 END AS names FROM k"""


@query(_SQL_MIXED_OBJECT)
def variant_objects(spark, sf_dir):
    """Sent objects of the mixed records: every value as its own schema has it, every field under its own name."""
    source = schema_lookup.SchemaTexts(fixtures.MIXED_SCHEMAS)
    plan = plan_variant_objects(fixtures.mixed_events(spark, sf_dir), source, SinkOptions.parse({"className": CLASS}))
    return _mixed_properties(plan.objects())


@query(_SQL_MIXED_OBJECT)
def decode_clashing_numbers(spark, sf_dir):
    """The same objects from one table with a column for each type of a field."""
    return _mixed_properties(objects.to_wire(plan_objects(fixtures.mixed_events(spark, sf_dir), fixtures.MIXED_SCHEMAS, SinkOptions.parse({"className": CLASS})).objects()))


# --------------------------------------------------------------------------
# Numbering by a sparse order, and offsets that are missing.

# Ids made of a time and a counter; four of five events belong to one source.
SQL_SPARSE = "((epoch_us(ts) // 1000) * 4194304 + event_id % 4194304)"


@query(
    f"""WITH s AS (SELECT event_id, CASE WHEN user_id % 5 = 0 THEN 'other' ELSE 'main' END AS source,
    {SQL_SPARSE} AS snowflake FROM events),
  p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY snowflake) - 1 AS pos FROM s)
SELECT event_id, source, snowflake, CAST(pos AS BIGINT) AS position, CAST(floor(pos / {BATCH_SIZE}) AS BIGINT) AS batch_no FROM p"""
)
def assign_sparse_batches(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    millis = F.call_function("div", F.unix_micros(fixtures.instant(F.col("ts"))), F.lit(1000))
    named = events.select(
        "event_id",
        F.when(F.col("user_id") % 5 == 0, "other").otherwise("main").alias("source"),
        (millis * 4194304 + F.col("event_id") % 4194304).alias("snowflake"),
    )
    placed = numbering.with_sparse_position(named, ["source"], "snowflake", "position")
    return placed.withColumn("batch_no", F.call_function("div", "position", F.lit(BATCH_SIZE)))


# Offsets that are taken out: a tenth, some in rows and some alone.
SQL_LOST = "(off % 100 BETWEEN 40 AND 46 OR off % 33 = 0)"


@query(
    f"""{K}, lost AS (SELECT part, off, off - row_number() OVER (PARTITION BY part ORDER BY off) AS island FROM k WHERE {SQL_LOST})
SELECT 'events' AS topic, part AS "partition", CAST(min(off) AS BIGINT) AS first_offset, CAST(max(off) AS BIGINT) AS last_offset,
  count(*) AS missing FROM lost GROUP BY part, island"""
)
def offset_gaps(spark, sf_dir):
    records = fixtures.kafka_events(spark, sf_dir)
    lost = (F.col("offset") % 100).between(40, 46) | (F.col("offset") % 33 == 0)
    whole = records.groupBy("topic", "partition").agg(F.min("offset").alias("start"), (F.max("offset") + 1).alias("end"))
    return offsets.offset_gaps(records.where(~lost), whole)


@query(
    f"""{K}, t AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS half FROM events),
  f AS (SELECT part, min(off) AS start FROM k, t WHERE ts >= half GROUP BY part)
SELECT k.part AS "partition", CAST(k.off AS BIGINT) AS "offset", epoch_us(k.ts) AS timestamp_micros
FROM k JOIN f ON k.part = f.part AND k.off >= f.start"""
)
def start_by_timestamp(spark, sf_dir):
    records = fixtures.kafka_events(spark, sf_dir)
    ends = records.agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b"))
    half = ends.select((F.col("a") + (F.col("b") - F.col("a")) / 2).alias("half")).scalar()
    later = offsets.start_at(records, half)
    return later.select("partition", "offset", F.unix_micros("timestamp").alias("timestamp_micros"))


# --------------------------------------------------------------------------
# What a damaged collection lacks, by range of offsets.

SQL_FAULT = """CASE WHEN off % 211 BETWEEN 30 AND 37 THEN 'missing' WHEN off % 97 = 5 THEN 'doubled'
  WHEN off % 89 BETWEEN 7 AND 8 THEN 'changed' END"""


@query(
    f"""{K}, f AS (SELECT part, off, {SQL_FAULT} AS fault FROM k),
  i AS (SELECT *, off - row_number() OVER (PARTITION BY part, fault ORDER BY off) AS island FROM f WHERE fault IS NOT NULL)
SELECT 'events' AS topic, part AS "partition", fault, CAST(min(off) AS BIGINT) AS first_offset,
  CAST(max(off) AS BIGINT) AS last_offset FROM i GROUP BY part, fault, island"""
)
def reconcile_ranges(spark, sf_dir):
    path = scratch_folder(spark, "ranges")
    records = fixtures.kafka_events(spark, sf_dir)
    write_kafka(records, {"className": CLASS, "path": path}, fixtures.SCHEMAS)
    place = {"topic": "_kafka_topic", "partition": "_kafka_partition", "offset": "_kafka_offset"}
    values = ["event_id", "user_id", "event_type", "value", "props"]

    def placed(rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(column).alias(name) for name, column in place.items()], *values)

    stored = placed(_flat(collection.read_collection(spark, path, CLASS)))
    at = F.col("offset")
    missing, doubled = (at % 211).between(30, 37), at % 97 == 5
    changed = F.when((at % 89).between(7, 8) & ~doubled, F.concat("event_type", F.lit("!"))).otherwise(F.col("event_type"))
    damaged = stored.where(~missing).withColumn("event_type", changed)
    damaged = damaged.unionByName(damaged.where(doubled))
    return compare_ranges.differing_ranges(placed(_plan(records).rows()), damaged, values)


# --------------------------------------------------------------------------
# A collection that is compacted between batches.


@query(
    f"""{K}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY off % 3 DESC, off DESC) AS rn FROM k)
SELECT '{CLASS}' AS class, CAST(user_id AS VARCHAR) AS id, event_id, event_type, CAST(off AS BIGINT) AS _kafka_offset FROM r WHERE rn = 1"""
)
def compacted_collection(spark, sf_dir):
    path = scratch_folder(spark, "compacted")
    records = fixtures.kafka_events(spark, sf_dir)
    for turn in range(3):
        options = {"className": CLASS, "path": path, "id": "user_id", "run": f"turn_{turn}"}
        write_kafka(records.where(F.col("offset") % 3 == turn), options, fixtures.SCHEMAS, batch_id=turn)
        if turn < 2:
            snapshots.compact(spark, path, CLASS)
    read = snapshots.read_compacted(spark, path, CLASS)
    return read.select("class", "id", "properties.event_id", "properties.event_type", "properties._kafka_offset")


# --------------------------------------------------------------------------
# Retries in rounds. Seconds at which the rounds run; two of them have nothing that is due.

ROUNDS_AT = (0, 1, 2, 4, 6)


@query(
    f"""{K} SELECT {SQL_ID} AS id, CASE event_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 4 END AS round,
  CAST(least(event_id % 4 + 1, {RETRIES + 1}) AS INTEGER) AS attempt,
  CASE WHEN event_id % 4 <= {RETRIES} THEN 'sent' ELSE 'failed' END AS status,
  CASE WHEN event_id % 4 > {RETRIES} THEN 'refused at attempt {RETRIES + 1}' END AS error FROM k"""
)
def retry_rounds(spark, sf_dir):
    folder = scratch_folder(spark, "rounds")
    how = delivery.Delivery(batch_size=BATCH_SIZE, retries=RETRIES, backoff=2.0)
    start = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
    built = _plan(fixtures.kafka_events(spark, sf_dir)).objects()
    for number, seconds in enumerate(ROUNDS_AT):
        now = start + dt.timedelta(seconds=seconds)
        rounds.run_round(spark, folder, number, flaky_transport, how, now, None if number else built)
    return rounds.read_rounds(spark, folder, len(ROUNDS_AT) - 1).select("id", "round", "attempt", "status", "error")
