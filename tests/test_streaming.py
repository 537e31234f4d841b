import pytest
from pyspark.sql import functions as F

from riskloom.operators.decode import decode_messages, decode_records, well_formed
from riskloom.plans import jobs, pipeline
from riskloom.plans.students import STUDENT_SPEC, TOPIC_BASE, TOPIC_LABELLED, TOPIC_UNLABELLED
from riskloom.sources.messages import FileTransport, encode_rows
from riskloom.streaming import flows
from tests.students import FIELDS, frame, students


def publish(spark, transport, records, topic):
    transport.write(encode_rows(frame(spark, records), topic))


def run(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def files(stream, out, checkpoint):
    return stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)


def decode_batch(df):
    return well_formed(decode_messages(df, FIELDS, STUDENT_SPEC.integer_fields, STUDENT_SPEC.double_fields))


@pytest.fixture(scope="module")
def model(spark):
    sent = encode_rows(frame(spark, students(400)), TOPIC_BASE)
    return pipeline.train(pipeline.clean(decode_batch(sent), STUDENT_SPEC), STUDENT_SPEC)


def test_scoring_stream_is_once_only_and_equals_batch(spark, model, tmp_path):
    transport = FileTransport(str(tmp_path / "in"))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    publish(spark, transport, students(30, labelled=False), TOPIC_UNLABELLED)
    FileTransport.write(transport, spark.createDataFrame([(bytearray(b"{oops"), TOPIC_UNLABELLED)], "value binary, topic string"))

    def start():
        records, bad = decode_records(transport.read_stream(spark, [TOPIC_UNLABELLED]), STUDENT_SPEC)
        run(files(bad, str(tmp_path / "bad"), str(tmp_path / "bad-checkpoint")))
        run(files(flows.score_stream(records, model), out, checkpoint))

    start()
    start()
    publish(spark, transport, students(20, labelled=False, first=100), TOPIC_UNLABELLED)
    start()
    scored = spark.read.parquet(out)
    assert scored.count() == 50 and scored.select("Student_ID").distinct().count() == 50
    batch = pipeline.score(pipeline.clean(decode_batch(transport.read(spark, [TOPIC_UNLABELLED])), STUDENT_SPEC), model)
    assert scored.exceptAll(batch).isEmpty() and batch.exceptAll(scored).isEmpty()
    assert [r[0] for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == ["{oops"]


def test_routing_stream(spark, tmp_path):
    inbox, outbox = str(tmp_path / "inbox"), FileTransport(str(tmp_path / "topics"))
    records = students(6)
    for r, word in zip(records, ["Graduate", None, " ", "Dropout", "", "Enrolled"]):
        r["Target"] = word
    frame(spark, records).write.parquet(inbox)
    stream = spark.readStream.schema(frame(spark, []).schema).parquet(inbox)
    routed = flows.route_stream(stream, F.col("Target"), TOPIC_LABELLED, TOPIC_UNLABELLED)
    run(outbox.write_stream(routed, str(tmp_path / "checkpoint")))
    ids = {topic: {r["Student ID"] for r in decode_messages(outbox.read(spark, [topic]), FIELDS).collect()}
           for topic in (TOPIC_LABELLED, TOPIC_UNLABELLED)}
    assert ids == {TOPIC_LABELLED: {"10000000", "10000003", "10000005"}, TOPIC_UNLABELLED: {"10000001", "10000002", "10000004"}}


def test_retrain_stream_gates_and_survives_replay(spark, tmp_path):
    root, checkpoint = str(tmp_path / "models"), str(tmp_path / "checkpoint")
    transport = FileTransport(str(tmp_path / "in"))
    base = decode_batch(encode_rows(frame(spark, students(300)), TOPIC_BASE)).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))

    def start():
        records, _ = decode_records(transport.read_stream(spark, [TOPIC_LABELLED]), STUDENT_SPEC, keep=["timestamp"])
        return run(flows.retrain_writer(records, STUDENT_SPEC, root, base, "timestamp", checkpoint, min_new=10))

    def versions():
        return [(r["version"], r["n_labelled"]) for r in jobs.registry(spark, root).orderBy("version").collect()]

    publish(spark, transport, students(5, first=900), TOPIC_LABELLED)
    start()
    assert versions() == []  # five rows wait for more
    publish(spark, transport, students(40, first=1000), TOPIC_LABELLED)
    publish(spark, transport, students(10, labelled=False, first=1100), TOPIC_LABELLED)
    start()
    assert versions() == [(1, 345)]
    start()
    assert versions() == [(1, 345)]  # nothing new
    publish(spark, transport, students(20, first=2000), TOPIC_LABELLED)
    start()
    assert versions() == [(1, 345), (2, 365)]
    loaded = jobs.load_latest(spark, root)
    assert pipeline.score(pipeline.clean(base, STUDENT_SPEC), loaded).count() == 300


def test_latest_score_stream_equals_batch(spark, tables, tmp_path):
    events = spark.read.parquet(f"{tables}/events.parquet")
    events.repartition(6).write.parquet(str(tmp_path / "events"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "events"))
    latest = flows.latest_score_stream(stream, "user_id", ["ts", "event_id"], "value")
    for mode in ("complete", "update"):
        name = f"latest_{mode}"
        run(latest.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", str(tmp_path / mode)))
        rows = {r["user_id"]: r["value"] for r in spark.table(name).collect()}
        batch = {r["user_id"]: r["value"] for r in flows.latest_per_key(events, "user_id", ["ts", "event_id"], "value").collect()}
        assert set(rows) == set(batch)
        if mode == "complete":
            assert rows == batch
