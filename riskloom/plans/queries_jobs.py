"""Queries over message offsets, the training ledger, the current model, and the jobs that tie them together."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from riskloom.operators.decode import decode_records
from riskloom.plans import categories, jobs, pipeline
from riskloom.plans.catalog import query
from riskloom.plans.queries_models import _RATE_SCORES, _RATES, MARK, RATE_SPEC, rounded
from riskloom.session import fresh_path
from riskloom.sources import messages
from riskloom.sources.scores import read_scores
from riskloom.sources.tables import read_table
from riskloom.spec import FeatureSpec
from riskloom.streaming import flows

# --- offsets

#: Four partitions of events; some offsets are lost and some come twice, one partition loses both its ends.
_PLACED_SQL = """SELECT 'events' AS topic, CAST(event_id % 4 AS INTEGER) AS partition, event_id // 4 AS "offset", event_id FROM events"""
_KEPT = """NOT (("offset" % 97 BETWEEN 5 AND 9) OR "offset" % 31 = 0 OR (partition = 1 AND ("offset" < 20 OR "offset" > 400)))"""
_TWICE = """("offset" % 50 IN (11, 12, 13) OR "offset" % 128 IN (127, 0))"""


def _placed(spark, sf):
    events = read_table(spark, sf, "events")
    return events.select(F.lit("events").alias("topic"), (F.col("event_id") % 4).cast("int").alias("partition"),
                         F.floor(F.col("event_id") / 4).alias("offset"), "event_id")


def _damaged(spark, sf):
    kept = _placed(spark, sf).filter(_KEPT.replace('"', "`"))
    return kept.unionByName(kept.filter(_TWICE.replace('"', "`")))


@query("offset_faults", f"""
WITH placed AS ({_PLACED_SQL}),
    present AS (SELECT DISTINCT topic, partition, "offset" AS o FROM placed WHERE {_KEPT}),
    edges AS (SELECT topic, partition, o FROM present UNION ALL
              SELECT topic, partition, min("offset") - 1 FROM placed GROUP BY 1, 2 UNION ALL SELECT topic, partition, max("offset") + 1 FROM placed GROUP BY 1, 2),
    holes AS (SELECT topic, partition, lag(o) OVER (PARTITION BY topic, partition ORDER BY o) + 1 AS first_offset, o - 1 AS last_offset FROM edges),
    twice AS (SELECT topic, partition, "offset" AS o, "offset" - row_number() OVER (PARTITION BY topic, partition ORDER BY "offset") AS run
              FROM placed WHERE {_KEPT} AND {_TWICE})
SELECT topic, partition, 'missing' AS fault, first_offset, last_offset FROM holes WHERE first_offset <= last_offset
UNION ALL SELECT topic, partition, 'repeated', min(o), max(o) FROM twice GROUP BY topic, partition, run""")
def offset_faults(spark, sf):
    """Slices of 128 offsets, so that the tables' partitions have several."""
    whole = messages.topic_audit(_placed(spark, sf))
    return messages.offset_faults(_damaged(spark, sf), whole, slice_size=128)


@query("offset_ranges", f"""
WITH placed AS ({_PLACED_SQL}),
    runs AS (SELECT *, "offset" - row_number() OVER (PARTITION BY topic, partition ORDER BY "offset") AS run FROM placed WHERE {_KEPT})
SELECT topic, partition, min("offset") AS first_offset, max("offset") AS last_offset FROM runs GROUP BY topic, partition, run""")
def offset_ranges(spark, sf):
    return messages.offset_ranges(_damaged(spark, sf), slice_size=128)


@query("lost_messages_read", f"""SELECT event_id, topic, partition, "offset" FROM ({_PLACED_SQL}) WHERE NOT ({_KEPT})""")
def lost_messages_read(spark, sf):
    """What a damaged copy of a topic lacks, read from the intact one by exact ranges."""
    placed = _placed(spark, sf)
    intact = messages.FileTransport(fresh_path(spark, "topic"))
    intact.write(placed.withColumn("value", F.col("event_id").cast("string").cast("binary")))
    lost = messages.offset_faults(_damaged(spark, sf), messages.topic_audit(placed), slice_size=128).filter("fault = 'missing'")
    found = messages.read_ranges(intact, spark, lost, slice_size=128)
    return found.select(F.col("value").cast("string").cast("long").alias("event_id"), "topic", "partition", "offset")


# --- the ledger and the registry

def _orders(spark, sf):
    return read_table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"), F.to_date("o_orderdate").alias("day"))


_DAY = "CAST(o_orderdate AS DATE)"


@query("ledger_versions", f"""
WITH o AS (SELECT *, {_DAY} AS day FROM orders WHERE o_orderstatus <> 'P'),
    new AS (SELECT * FROM o WHERE day >= DATE '{MARK}')
SELECT 1 AS version, 0 AS n_new, count(*) FILTER (day < DATE '{MARK}') AS n_labelled, count(*) FILTER (day < DATE '{MARK}') AS n_trained FROM o
UNION ALL SELECT 2, count(*) FILTER (day >= DATE '{MARK}' AND o_orderkey % 3 <> 0 AND day < DATE '1998-06-01'),
    count(*) FILTER (day < DATE '{MARK}' OR (o_orderkey % 3 <> 0 AND day < DATE '1998-06-01')),
    count(*) FILTER (day < DATE '{MARK}' OR (o_orderkey % 3 <> 0 AND day < DATE '1998-06-01')) FROM o
UNION ALL SELECT 3, count(*) FILTER (day >= DATE '{MARK}' AND (o_orderkey % 3 = 0 OR day >= DATE '1998-06-01')), count(*), count(*) FROM o""")
def ledger_versions(spark, sf):
    """Orders that come late, days at or before the last version's mark, train all the same; those sent again do not."""
    orders = _orders(spark, sf)
    base, new = orders.filter(F.col("day") < MARK), orders.filter(F.col("day") >= MARK)
    early = new.filter((F.col("o_orderkey") % 3 != 0) & (F.col("day") < "1998-06-01"))
    root = fresh_path(spark, "versions")
    jobs.train_initial(base, RATE_SPEC, root)
    for arrived in (early, early.unionByName(early), new.unionByName(early), new):
        jobs.retrain_if_new(base, arrived, RATE_SPEC, root, order="day")
    return jobs.registry(spark, root).select("version", "n_new", "n_labelled", "n_trained")


_SPLIT = "('0x' || left(md5(CAST(o_orderkey AS VARCHAR)), 8))::BIGINT % 100 < 80"


@query("registry_metrics", f"""
WITH parts AS (SELECT *, {_SPLIT} AS train FROM orders WHERE o_orderstatus <> 'P'),
    rates AS (SELECT o_orderpriority, avg(CAST(o_orderstatus = 'F' AS INTEGER)) AS s FROM parts WHERE train GROUP BY 1),
    judged AS (SELECT CAST(o_orderstatus = 'F' AS INTEGER) AS y, s FROM parts JOIN rates USING (o_orderpriority) WHERE NOT train),
    r AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS rk FROM judged),
    t AS (SELECT sum(rk) FILTER (y = 1) AS ranks, CAST(sum(y) AS DOUBLE) AS n1, CAST(sum(1 - y) AS DOUBLE) AS n0 FROM r),
    whole AS (SELECT o_orderpriority, avg(CAST(o_orderstatus = 'F' AS INTEGER)) AS p, count(*) AS n FROM parts GROUP BY 1)
SELECT 1 AS version, (SELECT count(*) FROM parts) AS n_trained, 'converged' AS fit,
    (SELECT round(sum(-n * (p * ln(p) + (1 - p) * ln(1 - p))) / sum(n), 8) FROM whole) AS objective,
    (SELECT round(avg(CAST((s > 0.5) = (y = 1) AS INTEGER)), 8) FROM judged) AS accuracy,
    round((ranks - n1 * (n1 + 1) / 2) / (n1 * n0), 8) AS auc FROM t""")
def registry_metrics(spark, sf):
    """How a version's fit ended, its objective, and the measures of its twin on the keys held out."""
    root = fresh_path(spark, "versions")
    jobs.train_initial(_orders(spark, sf), RATE_SPEC, root, evaluate=True)
    return jobs.registry(spark, root).select(
        "version", "n_trained", "fit", F.round("objective", 8).alias("objective"), F.round("accuracy", 8).alias("accuracy"), F.round("auc", 8).alias("auc"))


# --- categories and weights

@query("category_dictionary", """
WITH c AS (SELECT DISTINCT o_custkey AS code FROM orders), w AS (SELECT DISTINCT o_orderpriority AS word FROM orders)
SELECT 'o_custkey' AS category, CAST(code AS VARCHAR) AS value, row_number() OVER (ORDER BY code) AS slot FROM c
UNION ALL SELECT 'o_orderpriority', word, row_number() OVER (ORDER BY word) - 1 FROM w""")
def category_dictionary(spark, sf):
    orders = read_table(spark, sf, "orders")
    rows = orders.select(categories.code_value("o_custkey"), categories.word_value("o_orderpriority"))
    names = F.array(F.lit("o_custkey"), F.lit("o_orderpriority"))
    return categories.dictionary(rows, ["o_custkey"], ["o_orderpriority"]).select(
        F.get(names, F.col("feature")).alias("category"), F.coalesce("word", F.col("code").cast("string")).alias("value"), "slot")


@query("sparse_code_rates", """
SELECT l_partkey, count(*) AS n, true AS close, (SELECT count(DISTINCT l_partkey) + 1 FROM lineitem) AS slots FROM lineitem GROUP BY 1""")
def sparse_code_rates(spark, sf):
    """A category of as many values as parts, its codes spread over all 31 bits: it takes a slot per value, and the fitted
    probability of each is its rate of the positive label."""
    spec = FeatureSpec(keys=("l_orderkey", "l_linenumber"), target="half", label_order=("low", "high"), positive_label="high",
                       categorical=("code",), tolerance=1e-10)
    half = F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 2 == 0, "low").otherwise("high")
    lines = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.pmod(F.col("l_partkey") * 1_000_003, F.lit(2 ** 31 - 1)).cast("int").alias("code"), half.alias("half"))
    model = pipeline.train(lines, spec)
    scored = pipeline.score(lines, model, ["l_partkey", "half"])
    rates = scored.groupBy("l_partkey").agg(F.count("*").alias("n"), F.avg((F.col("half") == "high").cast("int")).alias("rate"),
                                            F.min("p_positive").alias("low"), F.max("p_positive").alias("high"))
    return rates.select("l_partkey", "n", ((F.abs(F.col("low") - F.col("rate")) < 0.02) & (F.abs(F.col("high") - F.col("rate")) < 0.02)).alias("close"),
                        F.lit(model.regression.numFeatures).cast("long").alias("slots"))


@query("train_contrasts", _RATES + """, odds AS (SELECT o_orderpriority, ln(p / (1 - p)) AS o FROM rates)
SELECT 'o_orderpriority' AS category, o_orderpriority AS value, round(o - (SELECT arg_min(o, o_orderpriority) FROM odds), 4) + 0.0 AS contrast FROM odds""")
def train_contrasts(spark, sf):
    model = pipeline.train(pipeline.clean(read_table(spark, sf, "orders"), RATE_SPEC), RATE_SPEC)
    return pipeline.contrasts(model).withColumn("contrast", F.round("contrast", 4) + 0.0)


# --- jobs

#: Records as they come in files and messages: the priority's digit is an integer field.
UPLOAD_SPEC = replace(RATE_SPEC, text_categorical=(), categorical=("priority",), integer_fields=("priority",))
_UPLOAD_SCHEMA = "o_orderkey bigint, priority int, o_orderstatus string"


def _records(spark, sf):
    return read_table(spark, sf, "orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"), F.to_date("o_orderdate").alias("day"))


@query("csv_upload", f"""
WITH o AS (SELECT *, {_DAY} AS day FROM orders),
    good AS (SELECT * FROM o WHERE day >= DATE '{MARK}' AND o_orderkey % 11 <> 0)
SELECT turn, count(*) FILTER (o_orderstatus <> 'P') AS n_labelled, count(*) FILTER (o_orderstatus = 'P') AS n_unlabelled,
    (SELECT count(*) FROM o WHERE day >= DATE '{MARK}' AND o_orderkey % 11 = 0) AS n_malformed, 2 AS version
FROM good, (VALUES (1), (2)) AS turns(turn) GROUP BY turn""")
def csv_upload(spark, sf):
    """A file with some cells that are no numbers, uploaded twice: it trains one version."""
    records, folder = _records(spark, sf), fresh_path(spark, "upload")
    base = records.filter(F.col("day") < MARK).drop("day")
    spoilt = F.when(F.col("o_orderkey") % 11 == 0, "high").otherwise(F.col("priority").cast("string"))
    records.filter(F.col("day") >= MARK).select("o_orderkey", spoilt.alias("priority"), "o_orderstatus").write.option("header", True).csv(f"{folder}/csv")
    transport, root = messages.FileTransport(f"{folder}/topics"), f"{folder}/models"
    jobs.train_initial(base, UPLOAD_SPEC, root)
    done = [jobs.upload(spark, f"{folder}/csv", _UPLOAD_SCHEMA, UPLOAD_SPEC, transport, "labelled", "unlabelled", base, root)
            .withColumn("turn", F.lit(turn)) for turn in (1, 2)]
    return done[0].unionByName(done[1])


@query("decode_with_identity", f"""
SELECT kind, CASE WHEN kind = 'identity' THEN CAST(o_orderkey AS VARCHAR) END AS o_orderkey, CAST(left(o_orderpriority, 1) AS INTEGER) AS priority,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus FROM orders, (VALUES ('base'), ('identity')) AS kinds(kind)""")
def decode_with_identity(spark, sf):
    """The same messages by the schema with identity and by that of base records, which lacks it."""
    sent = messages.encode_rows(_records(spark, sf).drop("day"), "records")
    whole, _ = decode_records(sent, UPLOAD_SPEC)
    base, _ = decode_records(sent, UPLOAD_SPEC, with_keys=False)
    return whole.select(F.lit("identity").alias("kind"), F.col("o_orderkey").cast("string").alias("o_orderkey"), "priority", "o_orderstatus").unionByName(
        base.withColumn("kind", F.lit("base")), allowMissingColumns=True)


@query("scored_and_published", _RATES + f"""
SELECT o_orderkey, round(1 - p, 5) AS risk, 1 AS model_version, 1 AS n_messages, 1 AS n_stored
FROM orders JOIN rates USING (o_orderpriority) WHERE o_orderstatus = 'P'""")
def scored_and_published(spark, sf):
    """Waiting orders in two lots, the second with the first in it: each is scored, sent and stored once."""
    orders, folder = _orders(spark, sf), fresh_path(spark, "publish")
    transport, root, path = messages.FileTransport(f"{folder}/topics"), f"{folder}/models", f"{folder}/scores"
    jobs.train_initial(orders, RATE_SPEC, root)

    def shape(scores):
        return scores.select("o_orderkey", F.col("p_negative").alias("risk"))

    for lot in (orders.limit(0), orders.filter(F.col("o_orderkey") % 3 == 0), orders):
        jobs.score_and_publish(lot, root, path, transport, "scores", "o_orderkey", shape)
    value = F.from_json(F.col("value").cast("string"), "o_orderkey bigint, risk double, model_version int")
    sent = transport.read(spark, ["scores"]).select(value.alias("v")).select("v.*").groupBy("o_orderkey", "risk", "model_version").agg(F.count("*").alias("n_messages"))
    stored = read_scores(spark, path).groupBy("o_orderkey").agg(F.count("*").alias("n_stored"))
    return sent.join(stored, "o_orderkey").withColumn("risk", F.round("risk", 5))


# --- streams

@query("stream_score_current", f"""
WITH o AS (SELECT *, {_DAY} AS day FROM orders),
    older AS (SELECT o_orderpriority, avg(CAST(o_orderstatus = 'F' AS INTEGER)) AS p FROM o WHERE o_orderstatus <> 'P' AND day < DATE '{MARK}' GROUP BY 1),
    whole AS (SELECT o_orderpriority, avg(CAST(o_orderstatus = 'F' AS INTEGER)) AS p FROM o WHERE o_orderstatus <> 'P' GROUP BY 1)
SELECT o_orderkey, round(p, 5) AS p_positive, 1 AS model_version FROM o JOIN older USING (o_orderpriority) WHERE day < DATE '{MARK}'
UNION ALL SELECT o_orderkey, round(p, 5), 2 FROM o JOIN whole USING (o_orderpriority) WHERE day >= DATE '{MARK}'""")
def stream_score_current(spark, sf):
    """One stream, running on while a new version is trained: what comes afterwards is scored by it."""
    orders, folder = _orders(spark, sf), fresh_path(spark, "current")
    base, new = orders.filter(F.col("day") < MARK), orders.filter(F.col("day") >= MARK)
    root = f"{folder}/models"
    jobs.train_initial(base, RATE_SPEC, root)
    base.write.mode("append").parquet(f"{folder}/in")
    arriving = spark.readStream.schema(orders.schema).parquet(f"{folder}/in")
    stream = flows.score_current_writer(arriving, root, f"{folder}/out", f"{folder}/checkpoint").start()
    try:
        stream.processAllAvailable()
        jobs.retrain_if_new(base, new, RATE_SPEC, root, order="day")
        new.write.mode("append").parquet(f"{folder}/in")
        stream.processAllAvailable()
    finally:
        stream.stop()
    return spark.read.parquet(f"{folder}/out").select("o_orderkey", F.round("p_positive", 5).alias("p_positive"), "model_version")


_DELAY_DAYS = 30


@query("stream_score_once", f"""
WITH o AS (SELECT o_orderkey, {_DAY} AS day FROM orders),
    first AS (SELECT * FROM o WHERE day < DATE '{MARK}' AND o_orderkey % 7 <> 3),
    mark AS (SELECT max(day) - INTERVAL {_DELAY_DAYS} DAY AS w FROM first)
SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT o_orderkey FROM first) OR day > w THEN 'scored' ELSE 'late' END AS state, 1 AS n FROM o, mark""")
def stream_score_once(spark, sf):
    """Orders in two waves. The second holds much of the first again, what the first withheld, and what is newer."""
    orders, folder = _orders(spark, sf), fresh_path(spark, "once")
    orders = orders.withColumn("sent", F.col("day").cast("timestamp"))
    old, held = F.col("day") < MARK, F.col("o_orderkey") % 7 == 3
    model = pipeline.train(pipeline.clean(orders.drop("sent"), RATE_SPEC), RATE_SPEC)
    for wave in (orders.filter(old & ~held), orders.filter(~old | held | (F.col("o_orderkey") % 2 == 0))):
        wave.write.mode("append").parquet(f"{folder}/in")
        arriving = spark.readStream.schema(orders.schema).parquet(f"{folder}/in")
        once = flows.score_stream(flows.once(arriving, ["o_orderkey"], "sent", f"{_DELAY_DAYS} days"), model)
        (once.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint")
         .trigger(availableNow=True).start().awaitTermination())
    scored = spark.read.schema(once.schema).parquet(f"{folder}/out")
    late = flows.unanswered(spark.read.parquet(f"{folder}/in"), scored, ["o_orderkey"])
    counts = scored.groupBy("o_orderkey").agg(F.count("*").alias("n")).withColumn("state", F.lit("scored"))
    return counts.unionByName(late.select("o_orderkey", F.lit(1).cast("long").alias("n"), F.lit("late").alias("state")))


@query("stream_retrain_rebuilt", """
SELECT 1 AS version, count(*) AS n_new, count(*) AS n_trained FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 2 = 0
UNION ALL SELECT 2, count(*) FILTER (o_orderkey % 2 <> 0), count(*) FROM orders WHERE o_orderstatus <> 'P'""")
def stream_retrain_rebuilt(spark, sf):
    """A retraining stream that loses its checkpoint after the first version, and reads all messages again
    with the later ones: every order trains once."""
    orders, folder = _orders(spark, sf), fresh_path(spark, "rebuilt")
    base, root = orders.limit(0), f"{folder}/models"
    even = F.col("o_orderkey") % 2 == 0
    for turn, wave in enumerate((orders.filter(even), orders.filter(~even).unionByName(orders.filter(even)))):
        wave.write.mode("append").parquet(f"{folder}/in")
        arriving = spark.readStream.schema(orders.schema).parquet(f"{folder}/in")
        for _ in range(2):  # the second start finds nothing to do
            flows.retrain_writer(arriving, RATE_SPEC, root, base, "day", f"{folder}/checkpoint-{turn}").trigger(
                availableNow=True).start().awaitTermination()
    return jobs.registry(spark, root).select("version", "n_new", "n_trained")
