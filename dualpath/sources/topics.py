"""Events to and from topics: routing, keys, wire encodings, Kafka and file transports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dualpath.functions.events import from_millis, pitch_uid, to_millis
from dualpath.schemas import ENTITIES, TOPICS, avro_schema, wire_schema

# A framed Avro value starts with a marker byte and a four-byte schema id.
AVRO_FRAME_BYTES = 5

_ISO = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}


def topic_key(entity: str) -> Column:
    if entity == "correction":
        return F.col("original_pitch_uid")
    if entity == "game_state":
        return F.concat_ws(":", F.col("game_pk").cast("string"), "event_type")
    if entity == "alert":
        return F.col("alert_uid")
    return pitch_uid()


def _wire_columns(entity: str) -> list[Column]:
    return [
        (to_millis(F.col(f.name)) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)).alias(f.name)
        for f in ENTITIES[entity]
    ]


def to_wire(df: DataFrame, entity: str) -> DataFrame:
    """The entity's columns in order, timestamps as epoch milliseconds."""
    return df.select(*_wire_columns(entity))


def from_wire(df: DataFrame, entity: str) -> DataFrame:
    return df.withColumns(
        {f.name: from_millis(F.col(f.name)) for f in ENTITIES[entity] if isinstance(f.dataType, T.TimestampType)}
    )


def wire_value(entity: str, encoding: str = "json") -> Column:
    """json: epoch milliseconds; json_iso: ISO timestamps; avro: needs the Avro package."""
    if encoding == "json":
        return F.to_json(F.struct(*_wire_columns(entity)), {"ignoreNullFields": "false"})
    if encoding == "json_iso":
        return F.to_json(F.struct(*[f.name for f in ENTITIES[entity]]), _ISO)
    if encoding == "avro":
        from pyspark.sql.avro.functions import to_avro

        return to_avro(F.struct(*_wire_columns(entity)), avro_schema(entity))
    raise ValueError(f"encoding must be json, json_iso or avro, got {encoding!r}")


def route(df: DataFrame, entity: str, encoding: str = "json") -> DataFrame:
    """(topic, key, value) rows ready for a Kafka sink or topic files."""
    return df.select(
        F.lit(TOPICS[entity]).alias("topic"),
        topic_key(entity).alias("key"),
        wire_value(entity, encoding).alias("value"),
    )


def route_all(streams: dict[str, DataFrame], encoding: str = "json") -> DataFrame:
    return reduce(DataFrame.unionByName, [route(df, name, encoding) for name, df in streams.items()])


def decode(df: DataFrame, entity: str, encoding: str = "json") -> DataFrame:
    """Typed entity rows from the value column; other columns of the source stay."""
    if encoding == "avro":
        from pyspark.sql.avro.functions import from_avro

        body = F.expr(f"substring(value, {AVRO_FRAME_BYTES + 1})")
        parsed = from_avro(body, avro_schema(entity))
        return df.withColumn("_v", parsed).select(*[c for c in df.columns if c != "value"], "_v.*")
    parsed = F.from_json(F.col("value").cast("string"), wire_schema(ENTITIES[entity]))
    rows = df.withColumn("_v", parsed).select(*[c for c in df.columns if c != "value"], "_v.*")
    return from_wire(rows, entity)


def write_topics(routed: DataFrame, path: str) -> None:
    """Topic files, one folder per topic."""
    routed.write.mode("append").partitionBy("topic").parquet(path)


def write_kafka(routed: DataFrame, servers: str) -> None:
    """Needs the Kafka package on the classpath."""
    (
        routed.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.enable.idempotence", "true")
        .option("kafka.compression.type", "zstd")
        .save()
    )


def read_kafka(spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None) -> DataFrame:
    """Streaming scan from the earliest offset with the source position. Needs the Kafka package."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(
        "value", F.col("partition").alias("kafka_partition"), F.col("offset").alias("source_offset")
    )
