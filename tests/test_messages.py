from __future__ import annotations

import base64
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palisade import schemas as S
from palisade.session import settle
from palisade.sinks.messages import dead_letters, to_messages
from verification.derived import topic_from_bronze
from palisade.sources.messages import batch_stats, parse_messages, readable, unreadable


@pytest.fixture(scope="module")
def broken(spark):
    values = ['{"event_id": "e1", "file_size_bytes": 5}', "{broken", "", None, '{"file_size_bytes": "many"}', "[]", "7", "null"]
    rows = [(None, value.encode() if value is not None else None, None, 1, number, None) for number, value in enumerate(values)]
    return spark.createDataFrame(rows, S.MESSAGE)


def test_message_shape(bronze):
    message = to_messages(bronze.where("event_id = lpad('1', 32, '0')"), "stg").first()
    payload = json.loads(bytes(message.value))
    assert list(payload) == T.StructType.fromDDL(S.MESSAGE_PAYLOAD).names
    assert bytes(message.key).decode() == payload["device_id"]
    assert payload["kafka_source"] == "ENDPOINT_AGENT" and payload["schema_version"] == "1.0"
    assert payload["event_timestamp"].endswith("+00:00")
    assert [(header.key, bytes(header.value)) for header in message.headers] == [
        ("schema_version", b"1.0"), ("environment", b"stg"), ("source", b"ENDPOINT_AGENT"), ("content_type", b"application/json"),
    ]


def test_key_override(bronze):
    by_customer = to_messages(bronze, "dev", F.col("customer_id"))
    assert by_customer.where("NOT startswith(decode(key, 'UTF-8'), 'CUST-')").count() == 0
    assert by_customer.count() == bronze.count()
    emptied = to_messages(bronze, "dev", F.lit(""))
    assert emptied.where("startswith(decode(key, 'UTF-8'), 'DEV-')").count() == bronze.where("device_id IS NOT NULL").count()


def test_missing_ingestion_time_is_the_time_of_sending(bronze):
    late = bronze.withColumn("ingestion_timestamp", F.lit(None).cast("timestamp"))
    payload = json.loads(bytes(to_messages(late, "dev", sent_at="2024-05-05 01:02:03").first().value))
    assert payload["ingestion_timestamp"] == "2024-05-05T01:02:03.000000+00:00"


def test_round_trip(bronze):
    names = T.StructType.fromDDL(S.BRONZE).names
    back = readable(parse_messages(settle(topic_from_bronze(bronze, "dev"), "topic")))
    wanted = bronze.where("kafka_offset % 13 <> 0").select(*names)
    assert back.columns == names
    assert back.exceptAll(wanted).count() == 0 and back.count() == wanted.count()


def test_errors(broken):
    errors = {row.kafka_offset: row.parse_error for row in parse_messages(broken).collect()}
    assert errors[0] is None and errors[2] == errors[3] == "EMPTY_MESSAGE"
    assert {errors[number] for number in (1, 4)} == {"UNREADABLE_JSON"} and {errors[number] for number in (5, 6, 7)} == {"NOT_AN_OBJECT"}
    stats = batch_stats(parse_messages(broken)).first()
    assert stats.total == 8 and stats.success + stats.failures == 8


def test_dead_letters(broken):
    letters = dead_letters(unreadable(parse_messages(broken)), "raw", "2024-05-05 00:00:00").collect()
    first = json.loads(bytes(letters[0].value))
    assert list(first) == ["original_event", "error", "failed_at", "topic"]
    assert first == {
        "original_event": "{broken", "error": "UNREADABLE_JSON", "failed_at": "2024-05-05T00:00:00.000000+00:00", "topic": "raw",
    }


@pytest.mark.parametrize(
    "value, error",
    [
        (b'{"event_id": "a"} \n', None), (b'\xff{"event_id": "a"}', "INVALID_UTF8"), (b'{"event_id": "\xc3"}', "INVALID_UTF8"), (b"\n\t", "EMPTY_MESSAGE"),
        (b'{"event_id": "a"} {"event_id": "b"}', "SEVERAL_VALUES"), (b'{"event_id": "a"}]', "SEVERAL_VALUES"), (b'{"event_id": "a"}}', "SEVERAL_VALUES"),
        (b'{"event_id": "a"},{}', "SEVERAL_VALUES"), (b'[{"event_id": "a"}]', "NOT_AN_OBJECT"), (b'"text"', "NOT_AN_OBJECT"), (b'{"event_id": ', "UNREADABLE_JSON"),
    ],
)
def test_any_bytes_are_a_message_or_a_letter(spark, value, error):
    parsed = parse_messages(spark.createDataFrame([(None, value, None, 1, 1, None)], S.MESSAGE))
    assert parsed.first().parse_error == error
    letters = [json.loads(bytes(row.value)) for row in dead_letters(unreadable(parsed), "raw").collect()]
    assert [letter["error"] for letter in letters] == [error] * (error is not None)
    if error == "INVALID_UTF8":
        assert base64.b64decode(letters[0]["original_base64"]) == value


def test_a_filter_on_the_error_does_not_parse_the_messages_anew(bronze):
    kept = unreadable(parse_messages(topic_from_bronze(bronze, "dev")))
    shown = kept._jdf.queryExecution().optimizedPlan().toString()
    assert shown.count("from_json(") == 1 and shown.count("StructsToJson") == 1
