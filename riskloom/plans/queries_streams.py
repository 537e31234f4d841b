"""Queries that run a stream over a table's files until all are read, then return the sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators.decode import decode_messages
from riskloom.plans import jobs, pipeline
from riskloom.plans.catalog import query
from riskloom.plans.queries_models import _RATE_SCORES, MARK, RATE_SPEC, rate_model, rounded
from riskloom.session import fresh_path
from riskloom.sources.messages import FileTransport, json_value
from riskloom.sources.tables import read_table
from riskloom.streaming import flows


def table_stream(spark, sf, name):
    """The table as a file stream. The glob matches a single file as well as a folder."""
    schema = read_table(spark, sf, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}.parque[t]")


def run_to_files(stream, spark, name):
    path = fresh_path(spark, name)
    (stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


@query("stream_decode", """
SELECT event_id, user_id % 7 = 0 AS malformed, CASE WHEN user_id % 7 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
       CASE WHEN user_id % 7 <> 0 THEN event_type END AS event_type FROM events""")
def stream_decode(spark, sf):
    events = table_stream(spark, sf, "events")
    value = F.when(F.col("user_id") % 7 == 0, F.lit("{broken").cast("binary")).otherwise(
        json_value(events, ["user_id", "event_type"]))
    decoded = decode_messages(events.select("event_id", value.alias("value")), ["user_id", "event_type"],
                              integers=["user_id"], keep=["event_id"])
    typed = decoded.drop("malformed_text").withColumn("user_id", F.col("user_id").cast("string"))
    return run_to_files(typed, spark, "decode")


@query("stream_score", _RATE_SCORES)
def stream_score(spark, sf):
    _, model = rate_model(spark, sf)
    return rounded(run_to_files(flows.score_stream(table_stream(spark, sf, "orders"), model), spark, "score"))


@query("stream_route", """
SELECT CASE WHEN o_orderstatus = 'P' THEN 'without_target' ELSE 'with_target' END AS topic, count(*) AS n,
       CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1""")
def stream_route(spark, sf):
    orders = table_stream(spark, sf, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("target"))
    routed = flows.route_stream(orders, F.col("target"), "with_target", "without_target")
    path = fresh_path(spark, "route")
    transport = FileTransport(f"{path}/topics")
    transport.write_stream(routed, f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    sent = transport.read(spark, ["with_target", "without_target"])
    key = F.get_json_object(F.col("value").cast("string"), "$.o_orderkey").cast("long")
    return sent.groupBy("topic").agg(F.count("*").alias("n"), F.sum(key).alias("keys"))


@query("stream_latest_per_key", "SELECT user_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id")
def stream_latest_per_key(spark, sf):
    latest = flows.latest_score_stream(table_stream(spark, sf, "events"), "user_id", ["ts", "event_id"], "value")
    path = fresh_path(spark, "latest")

    def replace(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{path}/out")

    (latest.writeStream.outputMode("complete").option("checkpointLocation", f"{path}/checkpoint")
     .foreachBatch(replace).trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(latest.schema).parquet(f"{path}/out")


def _retrain_by_stream(spark, sf):
    shaped = ["o_orderkey", "o_orderpriority", "o_orderstatus", "day"]
    status, day = F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"), F.to_date("o_orderdate").alias("day")
    base = read_table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", status, day).filter(F.col("day") < MARK)
    arriving = table_stream(spark, sf, "orders").select("o_orderkey", "o_orderpriority", status, day).filter(F.col("day") >= MARK)
    root = fresh_path(spark, "stream-versions")
    writer = flows.retrain_writer(arriving.select(*shaped), RATE_SPEC, root, base, "day", f"{root}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return root


@query("stream_retrain_gate", """
SELECT count(*) AS n_labelled, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS high_water FROM orders WHERE o_orderstatus <> 'P'""")
def stream_retrain_gate(spark, sf):
    """The newest version knows every labelled order, however many batches there were."""
    versions = jobs.registry(spark, _retrain_by_stream(spark, sf))
    return versions.agg(F.max_by("n_labelled", "version").alias("n_labelled"), F.max_by("high_water", "version").alias("high_water"))


@query("stream_retrained_scores", _RATE_SCORES)
def stream_retrained_scores(spark, sf):
    model = jobs.load_latest(spark, _retrain_by_stream(spark, sf))
    return rounded(pipeline.score(pipeline.clean(read_table(spark, sf, "orders"), RATE_SPEC), model))
