"""Event sources: stream scans and payload decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from eventwarden.schemas import CUSTOMER_EVENT, avro_schema

CORRUPT = "_corrupt_record"
ENVELOPE = ["kafka_key", "kafka_timestamp", "kafka_offset", "kafka_partition"]

# Default options of the event stream.
KAFKA_DEFAULTS = {"startingOffsets": "latest", "failOnDataLoss": "false"}


def kafka_stream(spark: SparkSession, brokers: str, topic: str,
                 options: dict[str, str] | None = None) -> DataFrame:
    """The raw topic; needs the Kafka connector package on the session."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", brokers).option("subscribe", topic)
            .options(**{**KAFKA_DEFAULTS, **(options or {})}).load())


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json",
                options: dict[str, str] | None = None) -> DataFrame:
    """A growing folder of files as a stream."""
    return spark.readStream.format(fmt).schema(schema).options(**(options or {})).load(path)


def curated_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Batch scan of the curated Parquet table; the schema is declared, not inferred."""
    return spark.read.schema(schema).parquet(path)


def decode(raw: DataFrame, codec: str = "json", schema: T.StructType = CUSTOMER_EVENT,
           keep: list[str] | None = None) -> DataFrame:
    """Envelope plus payload fields, one column each.

    A payload that does not parse, or has a field of the wrong type, keeps its
    text in ``_corrupt_record``; the fields that could be read are filled.
    """
    return _flatten(raw, _payload(codec, schema), keep)


def decode_split(raw: DataFrame, schema: T.StructType = CUSTOMER_EVENT,
                 keep: list[str] | None = None, codec: str = "json") -> tuple[DataFrame, DataFrame]:
    """(readable, corrupt): undecodable records go to a side output.

    Each side is picked inside the expression that parses the payload; a filter
    on the parsed column would be pushed down and parse every payload twice.
    A binary record that cannot be read has no fields at all: its side output
    carries the bytes in base 64.
    """
    if codec == "avro":
        record, body = _payload(codec, schema), F.col("value")
        good = F.filter(F.array(record), lambda d: d.isNotNull())
        lost = F.filter(F.array(F.struct(record.isNull().alias("unread"), F.base64(body).alias(CORRUPT))),
                        lambda d: d["unread"] & d[CORRUPT].isNotNull())
        return _flatten(raw, F.explode(good), keep), _flatten(raw, F.explode(lost), keep).drop("unread")
    parsed = F.array(_payload(codec, schema))
    good = F.filter(parsed, lambda d: d[CORRUPT].isNull())
    bad = F.filter(parsed, lambda d: d[CORRUPT].isNotNull())
    return (_flatten(raw, F.explode(good), keep).drop(CORRUPT), _flatten(raw, F.explode(bad), keep))


def _flatten(raw: DataFrame, payload: Column, keep: list[str] | None) -> DataFrame:
    envelope = [
        F.col("key").cast("string").alias("kafka_key"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("offset").alias("kafka_offset"),
        F.col("partition").alias("kafka_partition"),
    ]
    return (raw.select(*(keep or []), *envelope, payload.alias("data"))
            .select(*(keep or []), *ENVELOPE, "data.*"))


def _payload(codec: str, schema: T.StructType) -> Column:
    if codec == "json":
        # Declared non-null fields still decode to null: absence is a finding of
        # the null checks, not a parse error.
        fields = [T.StructField(f.name, f.dataType, True) for f in schema.fields]
        target = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
        return F.from_json(F.col("value").cast("string"), target,
                           {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    if codec == "avro":
        from pyspark.sql.avro.functions import from_avro  # needs the spark-avro package
        return from_avro(F.col("value"), avro_schema(schema), {"mode": "PERMISSIVE"})
    raise ValueError(f"unknown codec: {codec}")
