"""Messages of the event topic, parsed into bronze rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade import schemas as S

BROKEN = "_broken"
PARSE_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
UNREADABLE = "UNREADABLE_JSON"
EMPTY = "EMPTY_MESSAGE"
NOT_TEXT = "INVALID_UTF8"
NOT_AN_OBJECT = "NOT_AN_OBJECT"
SEVERAL = "SEVERAL_VALUES"


def topic_stream(spark: SparkSession, topic: str, options: dict[str, str]) -> DataFrame:
    """The live topic, with headers. Needs the Kafka connector on the cluster."""
    reader = spark.readStream.format("kafka").options(**options).option("subscribe", topic)
    return reader.option("includeHeaders", "true").load()


def parse_messages(messages: DataFrame) -> DataFrame:
    """Bronze columns plus ``text``, ``raw`` (the bytes of what isn't UTF-8) and ``parse_error``; a readable message has no
    error. Any bytes are taken: nothing in a message can stop the batch."""
    value = F.col("value").cast("string")
    valid = F.is_valid_utf8(value)
    parsed = messages.withColumn("text", F.when(valid, value)).withColumn("raw", F.when(~valid, F.col("value")))
    parsed = parsed.withColumn("event", F.from_json("text", f"{S.MESSAGE_PAYLOAD}, {BROKEN} STRING", PARSE_OPTIONS))
    # The parser stops behind the first value. What follows it breaks one of the two frames.
    framed = F.json_array_length(F.concat(F.lit("["), "text", F.lit("]"))) == 1
    named = F.json_object_keys(F.concat(F.lit('{"x":'), "text", F.lit("}"))).isNotNull()
    error = (
        F.when(F.col("raw").isNotNull(), NOT_TEXT)
        .when(F.col("text").isNull() | F.col("text").rlike(r"^\s*$"), EMPTY)
        .when(~F.col("text").rlike(r"^\s*\{"), NOT_AN_OBJECT)
        .when(F.col("event").isNull() | F.col(f"event.{BROKEN}").isNotNull(), UNREADABLE)
        .when(~F.coalesce(framed & named, F.lit(False)), SEVERAL)
    )
    carried = {
        "event_timestamp": F.col("event.event_timestamp").try_cast("timestamp"),
        "ingestion_timestamp": F.coalesce(F.col("event.ingestion_timestamp").try_cast("timestamp"), F.col("timestamp")),
        "kafka_partition": F.col("partition"),
        "kafka_offset": F.col("offset"),
    }
    names = T.StructType.fromDDL(S.BRONZE).names
    columns = [carried.get(name, F.col(f"event.{name}")).alias(name) for name in names]
    # A filter on what a generator puts out stays above it. Pushed below, it would have the text made and parsed anew wherever it names them.
    return parsed.select(F.inline(F.array(F.struct(*columns, "text", "raw", error.alias("parse_error")))))


def readable(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("parse_error").isNull()).drop("text", "raw", "parse_error")


def unreadable(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("parse_error").isNotNull())


def batch_stats(parsed: DataFrame) -> DataFrame:
    """Messages of this batch: total, readable and failed."""
    return parsed.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("parse_error").isNull()).alias("success"),
        F.count_if(F.col("parse_error").isNotNull()).alias("failures"),
    )
