"""Event messages and dead letters in the shape a topic takes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade import schemas as S
from palisade.functions.dates import moment
from palisade.functions.text import iso_instant

JSON_WITH_NULLS = {"ignoreNullFields": "false"}


def payload_columns(events: DataFrame, sent_at=None) -> list[Column]:
    """The payload fields in order. A missing ingestion time becomes the time of sending."""
    special = {
        "event_timestamp": iso_instant(F.col("event_timestamp")),
        "ingestion_timestamp": iso_instant(F.coalesce(F.col("ingestion_timestamp"), moment(sent_at))),
        "kafka_source": F.lit(S.MESSAGE_SOURCE),
        "schema_version": F.lit(S.MESSAGE_SCHEMA_VERSION),
    }
    names = T.StructType.fromDDL(S.MESSAGE_PAYLOAD).names
    return [special.get(name, F.col(name)).alias(name) for name in names]


def message_headers(environment: str) -> Column:
    values = {
        "schema_version": S.MESSAGE_SCHEMA_VERSION,
        "environment": environment,
        "source": S.MESSAGE_SOURCE,
        "content_type": S.MESSAGE_CONTENT_TYPE,
    }
    pairs = [F.struct(F.lit(k).alias("key"), F.encode(F.lit(v), "UTF-8").alias("value")) for k, v in values.items()]
    return F.array(*pairs)


def to_messages(
    events: DataFrame, environment: str, partition_key: Column | None = None, sent_at=None, carry: list[str] = ()
) -> DataFrame:
    """Key, JSON value and headers per event. The key is ``partition_key`` if it has text, else the device.

    ``carry`` names columns to keep beside them.
    """
    override = F.lit(None).cast("string") if partition_key is None else F.nullif(partition_key, F.lit(""))
    key = F.coalesce(override, F.nullif(F.col("device_id"), F.lit("")))
    return events.select(
        F.encode(key, "UTF-8").alias("key"),
        F.encode(F.to_json(F.struct(*payload_columns(events, sent_at)), JSON_WITH_NULLS), "UTF-8").alias("value"),
        message_headers(environment).alias("headers"),
        *carry,
    )


def dead_letters(failed: DataFrame, topic: str, failed_at=None) -> DataFrame:
    """One message per failed one: its text, the error, the time and the topic it came from. What isn't text is kept as
    ``original_base64``."""
    parts = [
        F.col("text").alias("original_event"),
        F.col("parse_error").alias("error"),
        iso_instant(moment(failed_at)).alias("failed_at"),
        F.lit(topic).alias("topic"),
    ]
    letter = F.to_json(F.struct(*parts), JSON_WITH_NULLS)
    with_bytes = F.to_json(F.struct(*parts, F.regexp_replace(F.base64("raw"), r"\s", "").alias("original_base64")), JSON_WITH_NULLS)
    return failed.select(F.encode(F.when(F.col("raw").isNull(), letter).otherwise(with_bytes), "UTF-8").alias("value"))


def send_to_topic(messages: DataFrame, topic: str, options: dict[str, str]) -> None:
    """Publish a batch. Retries and idempotence are the connector's; ``options`` names brokers and security."""
    messages.write.format("kafka").options(**options).option("topic", topic).save()
