"""Offsets, the ledger, fit reports, the current model in a stream, and messages answered once."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from riskloom.plans import jobs, ledger, pipeline
from riskloom.sources import messages
from riskloom.spec import FeatureSpec
from riskloom.streaming import flows

SPEC = FeatureSpec(keys=("id",), target="y", label_order=("no", "yes", "other"), positive_label="yes", dropped_labels=("other",),
                   categorical=("c",), contradictions=("c = 3 AND y = 'yes' AND id > 5000",))
ROWS = "id long, c int, y string, at timestamp"


def records(spark, first, n, target=None):
    y = F.when(F.pmod(F.hash("id"), F.lit(10)) + F.col("id") % 4 > 5, "yes").otherwise("no") if target is None else F.lit(target)
    return spark.range(first, first + n).select("id", (F.col("id") % 4).cast("int").alias("c"), y.alias("y"),
                                                F.timestamp_seconds(F.col("id")).alias("at"))


# --- offsets

def plain_faults(places, expected):
    out = []
    for where in sorted(set(expected) | {(t, p) for t, p, _ in places}):
        found = [o for t, p, o in places if (t, p) == where]
        low, high = expected.get(where, (min(found), max(found)) if found else (0, -1))
        runs = {"missing": [o for o in range(min([low, *found]), max([high, *found]) + 1) if o not in found],
                "repeated": sorted({o for o in found if found.count(o) > 1})}
        for fault, offsets in runs.items():
            for o in offsets:
                if out and out[-1][:3] == (*where, fault) and out[-1][4] == o - 1:
                    out[-1] = (*out[-1][:4], o)
                else:
                    out.append((*where, fault, o, o))
    return sorted(out)


@pytest.mark.parametrize(("slice_size", "seed"), [(1, 1), (4, 2), (7, 3), (1 << 20, 4)])
def test_offset_faults(spark, slice_size, seed):
    rng = random.Random(seed)
    places = [(t, p, o) for t in "ab" for p in range(2) for o in range(10, 60) if rng.random() < 0.8 for _ in range(rng.choice((1, 1, 1, 2, 3)))]
    places += [("c", 0, o) for o in range(30)]  # one run over many slices
    df = spark.createDataFrame([*places, ("a", None, 3), ("a", 0, None)], "topic string, partition int, offset long").repartition(3)
    expected = {("a", 0): (8, 61), ("b", 1): (10, 59), ("c", 0): (0, 29), ("gone", 5): (3, 4)}
    table = spark.createDataFrame([(*k, *v) for k, v in expected.items()], messages.RANGES)
    assert sorted(map(tuple, messages.offset_faults(df, table, slice_size).collect())) == plain_faults(places, expected)
    assert sorted(map(tuple, messages.offset_faults(df, None, slice_size).collect())) == plain_faults(places, {})
    held = {(t, p, o) for t, p, o in places}
    ranges = messages.offset_ranges(df, slice_size)
    assert {(r[0], r[1], o) for r in ranges.collect() for o in range(r[2], r[3] + 1)} == held
    assert ranges.filter("topic = 'c'").count() == 1
    wanted = spark.createDataFrame([("a", 0, 12, 20), ("a", 0, 25, 25), ("c", 0, 0, 28)], messages.RANGES)
    got = sorted((r["topic"], r["partition"], r["offset"]) for r in messages.within_ranges(df, wanted, slice_size).collect())
    assert got == sorted(x for x in places if x[:2] == ("a", 0) and (12 <= x[2] <= 20 or x[2] == 25) or x[0] == "c" and x[2] <= 28)


def test_offsets_of_nothing(spark):
    empty = spark.createDataFrame([], messages.ENVELOPE)
    assert messages.offset_faults(empty).isEmpty() and messages.offset_ranges(empty).isEmpty()
    assert messages.read_ranges(messages.FileTransport("nowhere"), spark, spark.createDataFrame([], messages.RANGES)).isEmpty()


def test_kafka_reads_exact_stretches():
    options = messages.KafkaTransport("b:1", {"x": "y"}, min_partitions=9).between_options([("t", 1, 5, 8), ("t", 0, 2, 2), ("s", 3, 0, 7)])
    assert options == {"kafka.bootstrap.servers": "b:1", "x": "y", "minPartitions": "9", "assign": '{"s": [3], "t": [0, 1]}',
                       "startingOffsets": '{"s": {"3": 0}, "t": {"0": 2, "1": 5}}', "endingOffsets": '{"s": {"3": 8}, "t": {"0": 3, "1": 9}}'}


# --- the ledger

def test_entries(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, ""), (2, "a")], "id long, y string")
    assert ledger.with_entries(df).count() == 4
    assert ledger.with_entries(df, ["id"]).count() == 2
    hashes = [df.select(ledger.entry(order)).distinct().count() for order in (["id", "y"], ["y", "id"])]
    assert hashes == [4, 4] and df.select(ledger.entry(["id", "y"])).exceptAll(df.select(ledger.entry(["y", "id"]))).isEmpty()


def test_only_registered_versions_count(spark, tmp_path):
    root = str(tmp_path)
    rows = ledger.with_entries(records(spark, 0, 10))
    assert ledger.committed(spark, root, jobs.registry(spark, root)).isEmpty()
    ledger.commit(rows.filter("id < 4"), root, 1)
    registered = spark.createDataFrame([(1,)], "version int")
    assert ledger.committed(spark, root, registered.limit(0)).isEmpty()  # the job died before it registered
    ledger.commit(rows.filter("id < 6"), root, 1)
    assert sorted(r["id"] for r in ledger.untrained(rows, ledger.committed(spark, root, registered)).collect()) == [6, 7, 8, 9]


def test_every_row_trains_once(spark, tmp_path):
    root, base = str(tmp_path), records(spark, 0, 200)
    jobs.train_initial(base, SPEC, root)
    new = records(spark, 1000, 40)
    assert jobs.retrain_if_new(base, new, SPEC, root, "at") is not None
    assert jobs.retrain_if_new(base, new.unionByName(new), SPEC, root, "at") is None  # sent again
    late = records(spark, 500, 5)  # earlier than the mark
    at_mark = new.filter("id = 1039").withColumn("id", F.lit(7).cast("long"))
    assert jobs.retrain_if_new(base, new.unionByName(late).unionByName(at_mark), SPEC, root, "at") is not None
    useless = records(spark, 2000, 5, "other").unionByName(records(spark, 2100, 5, "misspelt")).unionByName(records(spark, 2200, 5, " "))
    useless = useless.unionByName(records(spark, 6000, 40, "yes").filter("c = 3"))  # contradictions
    assert jobs.retrain_if_new(base, new.unionByName(useless), SPEC, root, "at") is None
    corrected = new.filter("id = 1000").withColumn("y", F.lit("no")).unionByName(new.filter("id = 1001").withColumn("c", F.lit(0)))
    assert jobs.retrain_if_new(base, corrected.unionByName(useless), SPEC, root, "at", min_new=1) is not None
    rows = [(r["version"], r["n_new"], r["n_labelled"], r["n_trained"], r["fit"]) for r in jobs.registry(spark, root).orderBy("version").collect()]
    assert rows[:3] == [(1, 0, 200, 200, "converged"), (2, 40, 240, 240, "converged"), (3, 6, 246, 246, "converged")]
    assert rows[3][0] == 4 and rows[3][1] in (1, 2) and rows[3][2] == 202 + 5 + 10 and rows[3][3] == 202


def test_fit_reports():
    spec = replace(SPEC, tolerance=1e-6, max_iter=4)
    judged = [pipeline.FitReport.of(9, h, spec).status for h in ([0.7], [0.7, 0.5, 0.4999999], [0.7, 0.6, 0.5], [0.7, 0.6, 0.55, 0.52, 0.51])]
    assert judged == ["converged", "converged", "stalled", "iteration limit"]


def test_unsound_fit_is_refused(spark, tmp_path):
    hasty = replace(SPEC, max_iter=1)
    with pytest.raises(ArithmeticError, match="iteration limit after 1 steps"):
        jobs.train_version(records(spark, 0, 200), hasty, str(tmp_path), 1, "x", None, 200, refuse_unsound=True)
    assert jobs.registry(spark, str(tmp_path)).isEmpty()
    jobs.train_version(records(spark, 0, 200), hasty, str(tmp_path), 1, "x", None, 200)
    assert jobs.latest_version(spark, str(tmp_path))["fit"] == "iteration limit"


def test_evaluation_is_registered(spark, tmp_path):
    jobs.train_initial(records(spark, 0, 400), SPEC, str(tmp_path), evaluate=True)
    row = jobs.latest_version(spark, str(tmp_path))
    assert 0.5 < row["accuracy"] < 1.0 and 0.5 < row["auc"] < 1.0


# --- streams

def test_scoring_stream_fails_without_a_model_and_resumes(spark, tmp_path):
    root, out, checkpoint = (str(tmp_path / n) for n in ("models", "out", "checkpoint"))
    records(spark, 0, 50).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(ROWS).parquet(str(tmp_path / "in"))

    def run():
        query = flows.score_current_writer(stream, root, out, checkpoint, ["id"]).trigger(availableNow=True).start()
        query.awaitTermination()

    with pytest.raises(Exception, match="no model version"):
        run()
    jobs.train_initial(records(spark, 0, 200), SPEC, root)
    run()
    records(spark, 100, 30).write.mode("append").parquet(str(tmp_path / "in"))
    jobs.retrain_if_new(records(spark, 0, 200), records(spark, 300, 9), SPEC, root, "at")
    run()
    scored = spark.read.parquet(out)
    assert sorted((r["model_version"], r["n"]) for r in scored.groupBy("model_version").agg(F.count("*").alias("n")).collect()) == [(1, 50), (2, 30)]
    model = jobs.load_latest(spark, root)
    want = {r["id"]: r["p_positive"] for r in pipeline.score(records(spark, 100, 30), model).collect()}
    assert {r["id"]: r["p_positive"] for r in scored.filter("model_version = 2").collect()} == want


def test_resent_messages_are_answered_once_and_late_ones_named(spark, tmp_path):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")

    def send(ids):
        ids = list(ids)
        spark.createDataFrame([(i,) for i in ids], "id long").selectExpr("id", "timestamp_seconds(id + 100000) as at").coalesce(1).write.mode("append").parquet(inbox)
        stream = flows.once(spark.readStream.schema("id long, at timestamp").parquet(inbox), ["id"], "at", "100 seconds")
        (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c"))
         .trigger(availableNow=True).start().awaitTermination())

    send([*range(0, 1000, 2), 500, 998])
    send([*range(0, 1000, 4), 897, 899, 951, 1500])  # sent again, too late, in time, new
    send([951, 1399, 1401])
    answered = spark.read.parquet(out)
    assert sorted(r["id"] for r in answered.collect()) == [*sorted([*range(0, 1000, 2), 899, 951]), 1401, 1500]
    late = flows.unanswered(spark.read.parquet(inbox), answered, ["id"])
    assert sorted(r["id"] for r in late.collect()) == [897, 1399]
