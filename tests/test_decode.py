import json

import pytest
from pyspark.sql import functions as F

from riskloom.operators.decode import cast_fields, decode_messages, malformed, well_formed
from riskloom.sources.messages import (
    ENVELOPE, FileTransport, KafkaTransport, count_by_topic, encode_rows, next_offsets, route_by_target, topic_audit,
)
from riskloom.sources.tables import read_csv


def envelope(spark, values):
    rows = [(i, None if v is None else v.encode()) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "offset long, value binary")


BAD = ["not json", "[1]", '{"age": "3"', "", "   ", None]


def test_bad_messages_are_flagged_and_set_apart(spark):
    decoded = decode_messages(envelope(spark, BAD), ["age", "name"], integers=["age"], keep=["offset"])
    rows = decoded.collect()
    assert len(rows) == len(BAD)
    assert all(r["malformed"] and r["age"] is None and r["name"] is None for r in rows)
    assert {r["malformed_text"] for r in malformed(decoded, ["offset"]).collect()} == set(BAD)
    assert well_formed(decoded).isEmpty()


GOOD = [
    ('{"age": "1.0", "rate": "2.5", "name": "x"}', (1, 2.5, "x")),
    ('{"age": 20.0, "rate": 13.428571428571429, "name": 7}', (20, 13.428571428571429, "7")),
    ('{"AGE": "3"}', (None, None, None)),
    ('{"age": NaN, "rate": NaN, "name": NaN}', (None, None, None)),
    ('{"age": "Portugal", "rate": "", "name": " "}', (None, None, None)),
    ('{"age": "1e1", "rate": "1e1", "name": " y "}', (None, 10.0, " y ")),
    ('{"age": "99999999999", "rate": null, "name": null}', (None, None, None)),
    ("{}", (None, None, None)),
]


def test_good_messages(spark):
    texts, expected = zip(*GOOD)
    decoded = decode_messages(envelope(spark, texts), ["age", "rate", "name"], ["age"], ["rate"], keep=["offset"])
    rows = sorted(well_formed(decoded).collect())
    assert [tuple(r)[1:] for r in rows] == list(expected)


def test_decoded_schema_is_typed_and_pruned(spark):
    decoded = decode_messages(envelope(spark, ["{}"]), ["a b", "c", "d"], ["a b"], ["c"])
    assert dict(decoded.dtypes) == {"a b": "int", "c": "double", "d": "string", "malformed": "boolean", "malformed_text": "string"}


def test_cast_fields(spark):
    df = spark.createDataFrame([("1.0", "x", "NaN")], "`a (b)` string, c string, d string")
    assert cast_fields(df, ["a (b)"], ["d"]).head() == (1, "x", None)


def test_encode_decode_roundtrip_through_files(spark, tmp_path):
    rows = spark.createDataFrame([("1", None, "Graduate"), ("2", "b", " "), ("3", "c", None)], "id string, `my name` string, Target string")
    routed = route_by_target(rows, "Target", "with", "without")
    assert {tuple(r) for r in count_by_topic(routed).collect()} == {("with", 1), ("without", 2)}
    transport = FileTransport(str(tmp_path / "topics"))
    transport.write(encode_rows(routed, F.col("topic"), ["id", "my name", "Target"], key="id", partitions=2))
    back = transport.read(spark, ["without"])
    assert [f.simpleString() for f in back.schema] == [f.simpleString() for f in spark.createDataFrame([], ENVELOPE).schema]
    values = {json.loads(bytes(r["value"]))["id"]: json.loads(bytes(r["value"])) for r in back.collect()}
    assert values == {"2": {"id": "2", "my name": "b", "Target": " "}, "3": {"id": "3", "my name": "c", "Target": None}}
    assert {bytes(r["key"]).decode() for r in back.collect()} == {"2", "3"}


def test_empty_table_stays_empty(spark, tmp_path):
    rows = spark.createDataFrame([], "id string, Target string")
    transport = FileTransport(str(tmp_path / "none"))
    transport.write(encode_rows(rows, "t"))
    assert encode_rows(rows, "t").isEmpty()
    decoded = decode_messages(envelope(spark, []), ["a"], ["a"])
    assert decoded.isEmpty() and well_formed(decoded).isEmpty()


def test_audit_gives_the_next_offsets(spark):
    rows = [("a", 0, 5), ("a", 0, 9), ("a", 1, 2), ("b", 0, 0)]
    audit = topic_audit(spark.createDataFrame(rows, "topic string, partition int, offset long"))
    assert json.loads(next_offsets(audit)) == {"a": {"0": 10, "1": 3}, "b": {"0": 1}}


def test_kafka_options():
    kafka = KafkaTransport("h:9092", {"kafka.security.protocol": "SSL"}, min_partitions=64)
    assert kafka.read_options(["a", "b"]) == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "a,b", "startingOffsets": "earliest",
        "kafka.security.protocol": "SSL", "minPartitions": "64"}
    assert kafka.read_options(["a"], '{"a":{"0":3}}')["startingOffsets"] == '{"a":{"0":3}}'


def test_csv_with_crlf_lines(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_bytes(b"Student ID,GDP,Target\r\n1,1.74,\r\n2,0.79,Graduate\r\n")
    typed = read_csv(spark, str(path), "`Student ID` string, GDP double, Target string")
    assert [tuple(r) for r in typed.collect()] == [("1", 1.74, None), ("2", 0.79, "Graduate")]
    assert read_csv(spark, str(path)).dtypes == [("Student ID", "string"), ("GDP", "string"), ("Target", "string")]
    assert dict(read_csv(spark, str(path), infer=True).dtypes)["GDP"] == "double"
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(path), "other string, GDP double, Target string").collect()
