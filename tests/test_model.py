import math
from dataclasses import replace

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.operators.quality import null_audit
from riskloom.plans import jobs, pipeline
from riskloom.plans.students import (
    FORM_LISTS, IDENTITY_FIELDS, SCORE_FIELDS, STUDENT_SPEC, TOPIC_BASE, TOPIC_LABELLED, TOPIC_SCORES, TOPIC_UNLABELLED, dataset_records, form_to_records, risk_scores,
)
from riskloom.operators.decode import decode_messages, decode_records, well_formed
from riskloom.sources import scores
from riskloom.sources.messages import FileTransport, encode_rows, route_by_target
from riskloom.spec import FeatureSpec
from tests.students import FIELDS, frame, students

SMALL = FeatureSpec(
    keys=("id",), target="y", label_order=("no", "yes"), positive_label="yes",
    categorical=("c",), text_categorical=("t",), numeric=("x", "flat"), tolerance=1e-9)


def decoded(spark, records):
    """Records as messages and back, the way they arrive."""
    sent = encode_rows(frame(spark, records), TOPIC_BASE)
    return well_formed(decode_messages(sent, FIELDS, STUDENT_SPEC.integer_fields, STUDENT_SPEC.double_fields))


@pytest.fixture(scope="module")
def base(spark):
    return decoded(spark, students(600)).cache()


@pytest.fixture(scope="module")
def model(base):
    return pipeline.train(pipeline.clean(base, STUDENT_SPEC), STUDENT_SPEC)


def test_spec_roundtrip_and_checks():
    assert FeatureSpec.from_json(STUDENT_SPEC.to_json()) == STUDENT_SPEC
    assert STUDENT_SPEC.negative_label == "Dropout"
    with pytest.raises(ValueError, match="positive label"):
        replace(SMALL, positive_label="maybe")
    with pytest.raises(ValueError, match="two labels"):
        replace(SMALL, label_order=("no", "yes", "other"))


def test_cleaned_columns(base):
    cleaned = pipeline.clean(base, STUDENT_SPEC)
    assert set(cleaned.columns) == {"Student_ID", "First_Name", "Last_Name", "Target"} | set(STUDENT_SPEC.features)
    assert sum(null_audit(cleaned, STUDENT_SPEC.features).head()) == 0


def test_only_sound_labelled_rows_train(spark):
    records = students(8)
    for r, word in zip(records, ["Graduate", "Dropout", "Enrolled", None, "", "  ", "Unknown", "Graduate"]):
        r["Target"] = word
    for term in ("1st", "2nd"):
        records[7][f"Curricular units {term} sem (approved)"] = "0"
    kept = pipeline.labelled_rows(pipeline.clean(decoded(spark, records), STUDENT_SPEC), STUDENT_SPEC)
    assert sorted((r["Student_ID"], r["label"]) for r in kept.collect()) == [("10000000", 1.0), ("10000001", 0.0)]


def test_scores_keep_keys_and_orientation(spark, base, model):
    cleaned = pipeline.clean(base, STUDENT_SPEC)
    rows = pipeline.score(cleaned, model).collect()
    assert len(rows) == 600 and len({r["Student_ID"] for r in rows}) == 600
    assert all(r["p_positive"] + r["p_negative"] == pytest.approx(1.0) for r in rows)
    by_id = {r["Student_ID"]: r for r in rows}
    truth = {r["Student_ID"]: r["label"] for r in pipeline.labelled_rows(cleaned, STUDENT_SPEC).collect()}
    graduates = [by_id[k]["p_positive"] for k, y in truth.items() if y == 1.0]
    dropouts = [by_id[k]["p_positive"] for k, y in truth.items() if y == 0.0]
    assert sum(graduates) / len(graduates) > sum(dropouts) / len(dropouts) + 0.2
    assert sum(by_id[k]["p_positive"] for k in truth) / len(truth) == pytest.approx(sum(truth.values()) / len(truth), abs=1e-3)
    risk = risk_scores(pipeline.score(cleaned, model))
    assert tuple(risk.columns) == SCORE_FIELDS
    first = risk.filter("student_id = '10000003'").head()
    assert first["dropout_probability"] == by_id["10000003"]["p_negative"] and first["first_name"] == "First3"


def test_equal_features_keep_their_own_keys(spark, model):
    twins = students(1) * 2
    twins[1] = twins[1] | {"Student ID": "other"}
    rows = pipeline.score(pipeline.clean(decoded(spark, twins), STUDENT_SPEC), model).collect()
    assert {r["Student_ID"] for r in rows} == {"10000000", "other"} and rows[0]["p_positive"] == rows[1]["p_positive"]


def test_odd_rows_do_not_stop_a_batch(spark, model):
    records = students(5, seed=11)
    records[0]["Course"] = "77"
    records[1]["Course"] = None
    records[2]["Course"] = "-4"
    records[3]["Age at enrollment"] = "Portugal"
    records[4]["GDP"] = "NaN"
    cleaned = pipeline.clean(decoded(spark, records), STUDENT_SPEC)
    scored = {r["Student_ID"] for r in pipeline.score(cleaned, model).collect()}
    assert scored == {"10000000", "10000001", "10000002", "10000004"}
    left = pipeline.unscorable(cleaned, STUDENT_SPEC).collect()
    assert [(r["Student_ID"], r["faults"]) for r in left] == [("10000003", ["Age"])]
    assert pipeline.score(cleaned.limit(0), model).isEmpty()


def test_save_and_load_give_equal_scores(spark, base, model, tmp_path):
    model.save(str(tmp_path / "m"))
    again = pipeline.RiskModel.load(spark, str(tmp_path / "m"))
    assert again.spec == STUDENT_SPEC
    cleaned = pipeline.clean(base, STUDENT_SPEC)
    assert pipeline.score(cleaned, again).exceptAll(pipeline.score(cleaned, model)).isEmpty()


def small(spark, n=400):
    return spark.range(n).select(
        F.col("id"), (F.col("id") % 4).cast("int").alias("c"), F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit(None)), (F.col("id") % 3 + 1).cast("int")).alias("t"),
        (F.hash("id") % 100 / 10.0).alias("x"), F.lit(3.0).alias("flat"),
        F.when(F.pmod(F.hash("id", F.lit(9)), F.lit(10)) + F.col("id") % 4 > 5, "yes").otherwise("no").alias("y"))


def probabilities(spark, df, spec):
    model = pipeline.train(df, spec)
    return model, {r["id"]: r["p_positive"] for r in pipeline.score(df, model).collect()}


def test_both_standardisations_agree(spark):
    df = small(spark)
    sparse, p = probabilities(spark, df, SMALL)
    dense, q = probabilities(spark, df, replace(SMALL, standardise="all"))
    assert max(abs(p[k] - q[k]) for k in p) < 1e-3
    names = pipeline.feature_names(sparse)
    assert names == ["c=(unknown)", "c=0", "c=1", "c=2", "c=3", "t=(unknown)", "t=a", "t=b", "t=(unseen)", "x", "flat"]
    assert pipeline.coefficients(sparse, spark).count() == len(names) + 1
    slotted = pipeline.slotted_rows(pipeline.model_columns(df, SMALL, ["id"]), SMALL, dense.table, [5, 4])
    rows = dense.fitted.transform(slotted).select(vector_to_array("features").alias("f"))
    moments = rows.select(F.posexplode("f")).groupBy("pos").agg(F.avg("col").alias("m"), F.stddev_samp("col").alias("d")).collect()
    assert all(abs(r["m"]) < 1e-9 for r in moments)
    assert all(r["d"] == pytest.approx(1.0) or r["d"] == 0.0 for r in moments) and len(moments) == len(names)


@pytest.mark.parametrize("spec", [SMALL, replace(SMALL, standardise="all"), replace(SMALL, bad_numeric="impute"),
                                  replace(SMALL, numeric=()), replace(SMALL, categorical=(), text_categorical=())])
def test_sums_and_stages_score_alike(spark, spec):
    df = small(spark)
    model = pipeline.train(df, spec)
    odd = [(900, 3, "zz", 2.0, 3.0), (901, 99, "a", 5.0, 3.0), (902, None, None, 1.0, 3.5), (903, -2, "b", None, 3.0)]
    rows = df.drop("y").unionByName(spark.createDataFrame(odd, "id long, c int, t string, x double, flat double"))
    by_sums = {r["id"]: r for r in pipeline.score(rows, model).collect()}
    by_stages = {r["id"]: r for r in pipeline.score_by_stages(rows, model).collect()}
    assert by_sums.keys() == by_stages.keys() and len(by_stages) >= 403
    for k, r in by_stages.items():
        assert by_sums[k]["p_positive"] == pytest.approx(r["p_positive"], abs=1e-12)
        assert by_sums[k]["prediction"] == r["prediction"]


def test_imputation_scores_every_row(spark):
    holes = small(spark).withColumn("x", F.when(F.col("id") % 5 == 0, F.lit(None)).when(F.col("id") % 7 == 0, float("nan")).otherwise(F.col("x")))
    _, p = probabilities(spark, holes, replace(SMALL, bad_numeric="impute"))
    assert len(p) == 400
    _, q = probabilities(spark, holes, SMALL)
    assert len(q) == 400 - 80 - 46


def test_training_needs_both_classes(spark):
    with pytest.raises(ValueError, match="'yes'"):
        pipeline.train(small(spark).filter("y = 'no'"), SMALL)
    with pytest.raises(ValueError, match="no usable training row"):
        pipeline.train(small(spark).limit(0), SMALL)


def test_codes_far_apart_take_a_slot_each(spark):
    df = small(spark)
    far = F.when(F.col("c") > 0, 2 ** 31 - 5 + F.col("c")).otherwise(F.col("c")).cast("int")
    model, p = probabilities(spark, df.withColumn("c", far), SMALL)
    _, q = probabilities(spark, df, SMALL)
    assert p == pytest.approx(q, abs=1e-6)
    assert pipeline.feature_names(model)[:5] == ["c=(unknown)", "c=0", "c=2147483644", "c=2147483645", "c=2147483646"]


def test_more_categories_than_an_expression_takes(spark, tmp_path):
    """A text category with 7,000 values: the rate of each is what the model says of it."""
    df = spark.range(42_000).select("id", F.concat(F.lit("v"), (F.col("id") % 7000).cast("string")).alias("t"),
                                    F.when((F.col("id") / 7000).cast("int") < F.col("id") % 5 + 1, "yes").otherwise("no").alias("y"))
    spec = FeatureSpec(keys=("id",), target="y", label_order=("no", "yes"), positive_label="yes", text_categorical=("t",), tolerance=1e-9)
    model = pipeline.train(df, spec)
    model.save(str(tmp_path / "wide"))
    again = pipeline.RiskModel.load(spark, str(tmp_path / "wide"))
    off = pipeline.score(df, again).select(F.max(F.abs(F.col("p_positive") - (F.col("id") % 5 + 1) / 6))).head()[0]
    assert off < 1e-3 and model.regression.numFeatures == 7001
    unseen = spark.createDataFrame([(1, "never")], "id long, t string")
    assert pipeline.score(unseen, again).head()["p_positive"] == pytest.approx(pipeline.score_by_stages(unseen, again).head()["p_positive"])


def test_contrasts(spark):
    model = pipeline.train(small(spark), replace(SMALL, numeric=(), categorical=()))
    rates = {r["t"]: r["p"] for r in small(spark).groupBy(F.coalesce("t", F.lit("(unknown)")).alias("t")).agg(F.avg((F.col("y") == "yes").cast("int")).alias("p")).collect()}
    odds = {t: math.log(p / (1 - p)) for t, p in rates.items()}
    got = {(r["category"], r["value"]): r["contrast"] for r in pipeline.contrasts(model).collect()}
    assert got == {("t", t): pytest.approx(o - odds["(unknown)"], abs=1e-4) for t, o in odds.items()}


def test_evaluate(spark):
    df = small(spark)
    per_label, area = pipeline.evaluate(df, pipeline.train(df, SMALL))
    assert {r["label"] for r in per_label.collect()} == {0.0, 1.0} and 0.6 < area.head()[0] < 1.0


# --- jobs

def test_versions_gate_and_registry(spark, tmp_path):
    root = str(tmp_path / "models")
    df = small(spark).withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 10).cast("int")))
    base, new = df.filter("id < 200"), df.filter("id >= 200")
    assert jobs.latest_version(spark, root) is None
    with pytest.raises(LookupError):
        jobs.load_latest(spark, root)
    jobs.train_initial(base, SMALL, root)
    unlabelled = new.withColumn("y", F.when(F.col("id") % 2 == 0, " "))
    assert jobs.retrain_if_new(base, unlabelled, SMALL, root, "day") is None
    assert jobs.retrain_if_new(base, new, SMALL, root, "day", min_new=201) is None
    assert jobs.retrain_if_new(base, new, SMALL, root, "day") is not None
    assert jobs.retrain_if_new(base, new, SMALL, root, "day") is None
    later = new.withColumn("day", F.lit("2024-03-01").cast("date")).limit(3)
    assert jobs.retrain_if_new(base, new.unionByName(later), SMALL, root, "day") is not None
    rows = jobs.registry(spark, root).orderBy("version").collect()
    assert [(r["version"], r["n_labelled"], r["high_water"]) for r in rows] == [
        (1, 200, None), (2, 400, "2024-02-09"), (3, 403, "2024-03-01")]
    again = jobs.load_latest(spark, root)
    assert again.spec == SMALL and rows[-1]["path"].endswith("version=3")


def test_train_version_twice_is_one_version(spark, tmp_path):
    for _ in range(2):
        jobs.train_version(small(spark), SMALL, str(tmp_path), 5, "x", None, 400)
    assert jobs.registry(spark, str(tmp_path)).count() == 1


def test_score_new_leaves_out_labelled_and_done(spark):
    df = small(spark)
    model = pipeline.train(df, SMALL)
    waiting = df.withColumn("y", F.when(F.col("id") < 10, F.col("y")))
    done = spark.createDataFrame([(20,), (20,), (21,)], "key long")
    ids = {r["id"] for r in jobs.score_new(waiting, model, done, "id").collect()}
    assert ids == set(range(10, 400)) - {20, 21}
    assert jobs.score_new(waiting, model, None, "id").count() == 390


# --- scores

def test_publish_store_and_look_up(spark, base, model, tmp_path):
    risk = risk_scores(pipeline.score(pipeline.clean(base, STUDENT_SPEC), model))
    transport = FileTransport(str(tmp_path / "topics"))
    transport.write(scores.score_messages(risk, {c: c for c in risk.columns}, TOPIC_SCORES, key="student_id"))
    back = decode_messages(transport.read(spark, [TOPIC_SCORES]), SCORE_FIELDS, doubles=["dropout_probability"])
    assert well_formed(back).exceptAll(risk).isEmpty() and back.count() == 600
    path = str(tmp_path / "scores")
    for version in (1, 2):
        scores.write_scores(risk.withColumn("version", F.lit(version)), path, "student_id", buckets=4)
    found = scores.lookup(scores.read_scores(spark, path), "student_id", "  10000042 ")
    assert sorted((r["student_id"], r["version"]) for r in found.collect()) == [("10000042", 1), ("10000042", 2)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(key_bucket" in plan and "PushedFilters: [IsNotNull(student_id), EqualTo(student_id,10000042)]" in plan
    assert scores.latest_per_key(scores.read_scores(spark, path), "student_id", ["version"], "version").filter("version <> 2").isEmpty()
    assert scores.first_per_key(scores.read_scores(spark, path), "student_id", ["version"], "version").filter("version <> 1").isEmpty()
    assert scores.lookup(scores.read_scores(spark, path), "student_id", "nobody").isEmpty()


def test_key_text_equality_on_numbers(spark):
    df = spark.createDataFrame([(7, "a"), (70, "b")], "id long, v string")
    assert [r["v"] for r in scores.lookup(df, "id", " 7 ").collect()] == ["a"]
    assert scores.lookup(df, "id", "07").isEmpty() and scores.lookup(df, "id", "x").isEmpty()


def test_form_answers_become_records(spark):
    answers = {f: r for f, r in students(1)[0].items()}
    answers |= {c: labels[-1] for c, labels in FORM_LISTS.items()} | {"Displaced": "Yes", "Student ID": " 5 ", "Debtor": None, "Gender": "?"}
    row = form_to_records(frame(spark, [answers])).head()
    assert row["Course"] == "17" and row["Mother's occupation"] == "45" and row["Displaced"] == "1"
    assert row["Debtor"] == "0" and row["Gender"] == "0" and row["Student ID"] == "5"
    assert row["Nacionality"] == "Portugal" and row["International"] == "0"
    assert len(FORM_LISTS) == 13 and IDENTITY_FIELDS[0] in row.asDict()


def test_form_answers_take_the_codes_of_the_dataset(spark):
    one = students(1)[0] | {c: labels[-1] for c, labels in FORM_LISTS.items()} | {"Displaced": "Yes", "Student ID": " 5 "}
    rows = [one, one | {"Debtor": "Yes", "Gender": " Female", "Course": None, "Displaced": "No", "Student ID": "6"},
            one | {"Gender": "?", "Debtor": "2", "Student ID": "7"}]
    sound, unknown = dataset_records(frame(spark, rows))
    got = {r["Student ID"]: r for r in sound.collect()}
    assert set(got) == {"5", "6"} and sound.columns == FIELDS
    assert [got["5"][c] for c in ("Debtor", "Gender", "Course", "Displaced", "Daytime/evening attendance")] == ["0", "1", "17", "1", "1"]
    assert [got["6"][c] for c in ("Debtor", "Gender", "Course", "Displaced")] == ["1", "0", None, "0"]
    assert sorted(map(tuple, unknown.collect())) == [("7", "Debtor", "2"), ("7", "Gender", "?")]


def test_whole_lifecycle(spark, tmp_path):
    """Publish, train, upload, retrain, score what is new, publish scores, look one up."""
    transport, root = FileTransport(str(tmp_path / "topics")), str(tmp_path / "models")
    no_identity = [f for f in FIELDS if f not in IDENTITY_FIELDS]
    transport.write(encode_rows(frame(spark, students(300)), TOPIC_BASE, no_identity))
    base, _ = decode_records(transport.read(spark, [TOPIC_BASE]), STUDENT_SPEC, with_keys=False)
    assert base.columns == no_identity
    jobs.train_initial(base, STUDENT_SPEC, root, keep_in_memory=True)

    upload = students(30, seed=3, first=500) + students(20, seed=4, labelled=False, first=600)
    routed = route_by_target(frame(spark, upload), "Target", TOPIC_LABELLED, TOPIC_UNLABELLED)
    transport.write(encode_rows(routed, F.col("topic"), FIELDS))
    labelled, bad = decode_records(transport.read(spark, [TOPIC_LABELLED]), STUDENT_SPEC, keep=["timestamp"])
    assert labelled.count() == 30 and bad.isEmpty()
    assert jobs.retrain_if_new(base, labelled, STUDENT_SPEC, root, "timestamp", keep_in_memory=True) is not None
    assert jobs.latest_version(spark, root)["n_labelled"] == 330

    waiting, _ = decode_records(transport.read(spark, [TOPIC_UNLABELLED]), STUDENT_SPEC)
    model, path = jobs.load_latest(spark, root), str(tmp_path / "scores")
    first = risk_scores(jobs.score_new(waiting, model, None, "Student_ID"))
    scores.write_scores(first, path, "student_id")
    transport.write(scores.score_messages(first, {c: c for c in SCORE_FIELDS}, TOPIC_SCORES, "student_id"))
    assert transport.read(spark, [TOPIC_SCORES]).count() == 20
    again = jobs.score_new(waiting, model, scores.read_scores(spark, path), "Student_ID", "student_id")
    assert again.isEmpty()
    found = scores.lookup(scores.read_scores(spark, path), "student_id", " 10000605").head()
    assert found["first_name"] == "First605" and 0.0 < found["dropout_probability"] < 1.0


def test_lookup_finds_a_key_whatever_the_number_of_folders(spark, tmp_path):
    path = str(tmp_path / "scores")
    for n in (8, 5):
        scores.write_scores(spark.range(200).selectExpr("cast(id % 50 as string) as who", f"{n} as n"), path, "who", buckets=n)
    found = scores.lookup(scores.read_scores(spark, path), "who", " 7 ")
    assert sorted(r["n"] for r in found.collect()) == [5] * 4 + [8] * 4


def test_padded_target_is_a_contradiction_all_the_same(spark):
    from riskloom.plans.pipeline import clean, labelled_rows

    rows = spark.createDataFrame([(" Graduate", 0), ("Graduate", 0), (" Graduate ", 2)], "Target string, avg_approved int")
    spec = FeatureSpec(keys=(), target="Target", label_order=("Dropout", "Graduate"), positive_label="Graduate",
                       contradictions=("avg_approved = 0 AND Target = 'Graduate'",))
    assert [r["avg_approved"] for r in labelled_rows(clean(rows, spec), spec).collect()] == [2]


def test_equal_rows_are_fitted_as_one(spark, monkeypatch):
    """Of rows that have only categories, the regression sees each once with its number, and no list of slots."""
    from pyspark.ml.classification import LogisticRegression
    seen, fit = [], LogisticRegression.fit
    monkeypatch.setattr(LogisticRegression, "fit", lambda self, rows, *a: (seen.append(rows), fit(self, rows, *a))[1])
    df = spark.sql("select id, cast(if(id % 7 = 0, null, id % 5) as int) as code, if(id % 3 = 0 or id % 4 = 0, 'yes', 'no') as y from range(2100)")
    spec = FeatureSpec(keys=("id",), target="y", label_order=("no", "yes"), positive_label="yes", categorical=("code",), tolerance=1e-10)
    model = pipeline.train(df, spec)
    assert model.report.rows == 2100 and seen[0].count() == 12
    assert seen[0].schema["features"].metadata == {"ml_attr": {"num_attrs": 6}}
    rates = pipeline.score(df, model, ["code", "y"]).groupBy("code").agg(
        F.avg((F.col("y") == "yes").cast("int")).alias("rate"), F.min("p_positive").alias("low"), F.max("p_positive").alias("high")).collect()
    assert len(rates) == 6
    for r in rates:
        assert r["low"] == r["high"] == pytest.approx(r["rate"], abs=1e-6)
    by_stages = {r["id"]: r["p_positive"] for r in pipeline.score_by_stages(df, model).collect()}
    assert all(r["p_positive"] == pytest.approx(by_stages[r["id"]]) for r in pipeline.score(df, model).collect())


def test_weights_of_many_slots_stay_in_a_table(spark, monkeypatch, tmp_path):
    """A model of more slots than the driver should hold has the same fit, contrasts and scores as one of fewer; no regression of Spark ML is asked for it."""
    from pyspark.ml.classification import LogisticRegression
    df = spark.sql("""select id, cast(if(id % 7 = 0, null, id % 40) as int) as code, concat('w', id % 11) as word,
        if(pmod(hash(id), 100) < 10 + 2 * (id % 40) + (id % 11), 'yes', 'no') as y from range(6000)""")
    spec = FeatureSpec(keys=("id",), target="y", label_order=("no", "yes"), positive_label="yes", categorical=("code",), text_categorical=("word",), tolerance=1e-12)
    other = spark.sql("select -1 as id, 12345 as code, 'unheard' as word, 'no' as y")
    narrow = pipeline.train(df, spec)
    monkeypatch.setattr(pipeline, "WIDE_SLOTS", 10)
    monkeypatch.setattr(LogisticRegression, "fit", None)
    model = pipeline.train(df, spec)
    assert model.regression.numFeatures == narrow.regression.numFeatures and model.report.rows == 6000 and model.report.status == "converged"
    assert model.report.objective == pytest.approx(narrow.report.objective, abs=1e-9)
    model.save(str(tmp_path))
    loaded = pipeline.RiskModel.load(spark, str(tmp_path))
    want = {r["id"]: r["p_positive"] for r in pipeline.score(df, narrow).collect()}
    for one in (model, loaded):
        got = {r["id"]: r["p_positive"] for r in pipeline.score(df, one).collect()}
        assert len(got) == 6000 and all(got[i] == pytest.approx(p, abs=1e-4) for i, p in want.items())
    unseen = pipeline.score(other, model).first()["p_positive"]
    assert unseen == pytest.approx(1 / (1 + math.exp(-model.regression.intercept)))
    contrasts = [{(r["category"], r["value"]): r["contrast"] for r in pipeline.contrasts(m).collect()} for m in (narrow, model)]
    assert contrasts[0].keys() == contrasts[1].keys() and all(contrasts[1][k] == pytest.approx(v, abs=1e-3) for k, v in contrasts[0].items())
    named = [{r["feature"]: r["position"] for r in pipeline.coefficients(m, spark).collect()} for m in (narrow, model)]
    assert named[0] == named[1]


def test_a_wide_fit_takes_slots_of_one_class(spark, monkeypatch):
    monkeypatch.setattr(pipeline, "WIDE_SLOTS", 1)
    df = spark.sql("select id, cast(id % 20 as int) as code, if(id % 20 = 3 or (id % 20 != 4 and id % 60 < 20), 'yes', 'no') as y from range(1200)")
    spec = FeatureSpec(keys=("id",), target="y", label_order=("no", "yes"), positive_label="yes", categorical=("code",), tolerance=1e-10)
    model = pipeline.train(df, spec)
    rates = {r["code"]: r["p"] for r in pipeline.score(df, model, ["code"]).groupBy("code").agg(F.avg("p_positive").alias("p")).collect()}
    assert rates.pop(3) > 0.9999 and rates.pop(4) < 0.0001 and all(p == pytest.approx(1 / 3, abs=1e-6) for p in rates.values())
