"""Record tables and streams in Kafka shape."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The columns of every Kafka-shaped frame, in order.
KAFKA_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("timestampType", T.IntegerType(), True),
    ]
)


class KafkaShapeError(ValueError):
    """A frame that does not have the Kafka columns."""


def check_kafka_schema(df: DataFrame) -> DataFrame:
    """Return the seven Kafka columns in order, or raise before any row moves."""
    given = {f.name.lower(): f.dataType for f in df.schema.fields}
    faults = []
    for field in KAFKA_SCHEMA.fields:
        have = given.get(field.name.lower())
        if have is None:
            faults.append(f"{field.name} is missing")
        elif have != field.dataType:
            faults.append(f"{field.name} is {have.simpleString()}, not {field.dataType.simpleString()}")
    if faults:
        raise KafkaShapeError("not a Kafka-shaped frame: " + "; ".join(faults))
    return df.select(*[field.name for field in KAFKA_SCHEMA.fields])


def kafka_options(
    servers: str,
    topic: str,
    username: str | None = None,
    password: str | None = None,
    starting: str = "latest",
    fail_on_data_loss: bool = False,
    min_partitions: int | None = None,
    max_offsets: int | None = None,
) -> dict[str, str]:
    """Options for Spark's own Kafka source, with SASL_SSL when a user is given.

    `min_partitions` cuts large topic partitions into several tasks, so that one
    partition with much of the data is no single task. `max_offsets` bounds a
    micro-batch.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if username is not None:
        login = "org.apache.kafka.common.security.plain.PlainLoginModule"
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.ssl.endpoint.identification.algorithm": "https",
            "kafka.sasl.jaas.config": f"{login} required username='{username}' password='{password}';",
        }
    return options


def read_kafka_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """A live topic; needs Spark's Kafka package on the class path."""
    return check_kafka_schema(spark.readStream.format("kafka").options(**options).load())


def read_kafka_topic(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """A topic as a bounded table; `latest` as a start is not allowed by Spark here."""
    return check_kafka_schema(spark.read.format("kafka").options(**{**options, "startingOffsets": "earliest"}).load())


def read_kafka_files(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    """Landed records; `avro` needs Spark's Avro package on the class path."""
    return check_kafka_schema(spark.read.format(file_format).load(path))


def stream_kafka_files(
    spark: SparkSession, path: str, max_files: int | None = None, file_format: str = "parquet"
) -> DataFrame:
    """Landed records as a stream, `max_files` new files per micro-batch."""
    reader = spark.readStream.format(file_format).schema(KAFKA_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return check_kafka_schema(reader.load(path))
