import math
import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import ChiSquareTest, Correlation
from pyspark.sql import functions as F

from riskloom.functions.chi_square import chi_square_tail
from riskloom.functions.values import category_slot
from riskloom.operators import dictionary, features, metrics, quality, screen, shape
from riskloom.operators.ranking import running_totals
from riskloom.session import SHUFFLES_GO, materialise


# --- shape

def test_names(spark):
    df = spark.createDataFrame([(1, 2)], "`Units 1st sem (grade)` int, `day/evening` int")
    assert shape.normalise_names(df).columns == ["Units_1st_sem_grade", "day/evening"]
    with pytest.raises(ValueError, match="'a b' and 'a_b'"):
        shape.normalise_names(spark.createDataFrame([(1, 2)], "`a b` int, a_b int"))


def test_drops(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b_x int, c int")
    assert shape.drop_columns(df, ["a", "zz"]).columns == ["b_x", "c"]
    with pytest.raises(ValueError, match="zz"):
        shape.drop_columns(df, ["a", "zz"], must_exist=True)
    assert shape.drop_by_pattern(df, ["_x"], ["c"]).columns == ["a"]


def test_contradictions_keep_unknown_rows(spark):
    rows = [(1, 0.0, 0.0, "G"), (2, 0.0, None, "G"), (3, 0.0, 0.0, "D"), (4, 2.0, 1.0, "G"), (5, 0.0, 0.0, None)]
    df = shape.add_pair_means(spark.createDataFrame(rows, "id int, a double, b double, t string"), {"m": ("a", "b")})
    rules = ["m = 0 AND t = 'G'"]
    assert [r["id"] for r in shape.contradictory_rows(df, rules).collect()] == [1]
    assert sorted(r["id"] for r in shape.without_contradictions(df, rules).collect()) == [2, 3, 4, 5]
    assert shape.contradictory_rows(shape.without_contradictions(df, rules), rules).isEmpty()


def test_union_counts_and_class_drop(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "i int, t string")
    b = spark.createDataFrame([("y", 2), (None, 3)], "t string, i int")
    both = shape.append_by_name(a, b)
    assert both.count() == 4 and both.columns == ["i", "t"]
    assert sorted(r["i"] for r in shape.drop_classes(both, "t", ["x"]).collect()) == [2, 3]


# --- quality and dictionaries

def test_audits(spark):
    df = spark.createDataFrame([(1, None, 2.0), (None, "a", float("nan")), (-3, None, None)], "a int, `b c` string, d double")
    assert quality.null_audit(df).head() == (1, 2, 1)
    assert {tuple(r) for r in quality.null_audit_long(df).collect()} == {("a", 1), ("b c", 2), ("d", 1)}
    assert quality.category_report(df, ["a"]).head() == ("a", 1, 1)
    found = {tuple(r["faults"]) for r in quality.quarantined(df, ["a", "d"]).collect()}
    assert found == {("a", "d"), ("d",)}


def test_empty_tables(spark):
    df = spark.createDataFrame([], "a int, t string, v double")
    assert quality.null_audit(df).head() == (0, 0, 0)
    assert quality.class_distribution(df, "t").isEmpty()
    assert quality.labelled_exists(df, "t").head()[0] is False
    assert quality.column_moments(df, ["v"]).head() == ("v", None, None)
    assert metrics.roc_auc(df.withColumn("label", F.lit(1.0)), "v").head()[0] is None
    assert screen.chi_square_screen(df, ["a"], "t", ["x", "y"]).isEmpty()
    assert all(r["rho"] is None for r in screen.spearman_matrix(df, ["a", "v"]).collect())


def test_dictionary(spark):
    codes = dictionary.code_dictionary(spark, {"k": ("one", "two"), "m": ("x",)})
    assert {tuple(r) for r in codes.collect()} == {("k", 1, "one"), ("k", 2, "two"), ("m", 1, "x")}
    df = spark.createDataFrame([(1, 1), (2, 9), (None, 9), (1, 2)], "k int, m int")
    labelled = dictionary.attach_label(df, codes, "k", "k", "name").collect()
    assert sorted((r["k"] or 0, r["name"] or "") for r in labelled) == [(0, ""), (1, "one"), (1, "one"), (2, "two")]
    unknown = {tuple(r) for r in dictionary.unknown_codes(df, codes, {"k": "k", "m": "m"}).collect()}
    assert unknown == {("k", None, 1), ("m", 9, 2), ("m", 2, 1)}
    coded = dictionary.encode_labels(spark.createDataFrame([("two",), ("?",), (None,)], "k string"), {"k": ("one", "two")})
    assert [r["k"] for r in coded.collect()] == [2, 0, 0]


# --- ranking and screening

def skewed(spark, n=3000, seed=3):
    """A third of the rows share one value of every column."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        x = 5.0 if hot else rng.gauss(0, 3)
        rows.append((x, -2.0 if hot else float(round(x + rng.gauss(0, 2))), float(rng.randint(0, 4)), 1.0, rng.random()))
    return spark.createDataFrame(rows, "x double, y double, z double, flat double, u double").repartition(5)


def test_running_totals_equal_brute_force(spark):
    rng = random.Random(1)
    rows = [(g, float(v), rng.randint(1, 9)) for g in "ab" for v in rng.sample(range(1000), 120)]
    found = running_totals(spark.createDataFrame(rows, "g string, v double, n long"), "g", "v", ["n"], ranges=7).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r["n_before"] == sum(n for g, v, n in rows if g == r["g"] and v < r["v"])


@pytest.mark.parametrize("hot_shares", [20, 1, 10 ** 9])
def test_spearman_equals_the_ml_matrix(spark, monkeypatch, hot_shares):
    monkeypatch.setattr(screen, "HOT_SHARES", hot_shares)
    df, columns = skewed(spark), ["x", "y", "z", "u"]
    found = {(r[0], r[1]): r[2] for r in screen.spearman_matrix(df, columns).collect()}
    vectors = VectorAssembler(inputCols=columns, outputCol="v").transform(df)
    expected = Correlation.corr(vectors, "v", "spearman").head()[0].toArray()
    assert len(found) == 16
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            assert found[a, b] == pytest.approx(expected[i, j], abs=1e-12)


def test_spearman_of_a_constant_and_of_unusable_rows(spark):
    df = spark.createDataFrame([(1.0, 1.0, 7.0), (2.0, 3.0, 7.0), (3.0, 2.0, 7.0), (None, 9.0, 7.0), (4.0, float("nan"), 7.0)], "a double, b double, k double")
    found = {(r[0], r[1]): r[2] for r in screen.spearman_matrix(df, ["a", "b", "k"]).collect()}
    assert found["a", "b"] == pytest.approx(0.5) and found["a", "a"] == 1.0
    assert found["a", "k"] is None and found["k", "k"] is None


def test_chi_square_equals_the_ml_test(spark):
    rng = random.Random(5)
    rows = [(rng.randint(0, 3), rng.randint(0, 9), rng.randint(0, 1), float(rng.randint(0, 2))) for _ in range(2000)]
    df = spark.createDataFrame([(a + int(y), b, c, y) for a, b, c, y in rows], "a int, b int, c int, y double")
    columns = ["a", "b", "c"]
    expected = ChiSquareTest.test(VectorAssembler(inputCols=columns, outputCol="v").transform(df), "v", "y", True).collect()
    stats = {r["variable"]: r for r in screen.chi_square_stat(df, columns, "y").collect()}
    screened = {r["variable"]: r["p_value"] for r in screen.chi_square_screen(df, columns, "y").collect()}
    for e in expected:
        name = columns[e["featureIndex"]]
        assert stats[name]["statistic"] == pytest.approx(e["statistic"], rel=1e-9)
        assert stats[name]["dof"] == e["degreesOfFreedom"]
        assert screened[name] == pytest.approx(round(e["pValue"], 5), abs=1.1e-5)
    kept = screen.keep_screened(df, screen.screen_by_chi_square(df, columns, "y", 0.01))
    assert "a" in kept.columns and "y" in kept.columns


def test_chi_square_of_many_labels(spark):
    """Far more labels than a class has, most cells empty, against all cells in full."""
    rng = random.Random(9)
    rows = [(rng.randint(0, 40), rng.choice(["a", "b", None]), rng.randint(0, 1499) if rng.random() < 0.9 else 7, None) for _ in range(4000)]
    df = spark.createDataFrame(rows, "f int, g string, y int, none int")
    found = {r["variable"]: (r["statistic"], r["dof"]) for r in screen.chi_square_stat(df, ["f", "g", "none"], "y").collect()}
    assert set(found) == {"f", "g"}
    for k, name in enumerate("fg"):
        used = [(r[k], r[2]) for r in rows if r[k] is not None]
        n, cells, left, right = len(used), Counter(used), Counter(a for a, _ in used), Counter(b for _, b in used)
        want = math.fsum((cells[a, b] - left[a] * right[b] / n) ** 2 / (left[a] * right[b] / n) for a in left for b in right)
        assert found[name][0] == pytest.approx(want, rel=1e-11) and found[name][1] == (len(left) - 1) * (len(right) - 1)
    only = screen.chi_square_stat(df, ["f"], "y", [7, 8]).head()
    assert only["dof"] == 40 or only["dof"] < 40 and only["statistic"] > 0
    assert screen.chi_square_stat(df.limit(0), ["f"], "y").isEmpty()
    cells = {(r["category"], r["label"]): r["n"] for r in screen.contingency_cells(df, ["f"], "y").collect()}
    assert cells == {(str(a), b): m for (a, b), m in Counter((r[0], r[2]) for r in rows).items()}


def test_contingency_keeps_types_apart(spark):
    rows = [(1, 2**60, 0.5, "x"), (1, 2**60 + 1, 0.5, "x"), (0, 2**60, -0.0, None), (0, None, 0.0, "y"), (None, 1, 9.0, "z")]
    df = spark.createDataFrame(rows, "y int, big long, real double, word string")
    cells = {(r["variable"], r["category"]): (r["n_0"], r["n_1"]) for r in screen.contingency(df, ["big", "real", "word"], "y").collect()}
    assert cells == {("big", str(2**60)): (1, 1), ("big", str(2**60 + 1)): (0, 1), ("real", "0.5"): (0, 2), ("real", "0.0"): (2, 0),
                     ("word", "x"): (0, 2), ("word", "y"): (1, 0)}


def poisson_tail(x, dof):
    """Even degrees of freedom: the tail is a finite Poisson sum."""
    return sum(math.exp(-x / 2 + i * math.log(x / 2) - math.lgamma(i + 1)) for i in range(dof // 2))


def test_chi_square_tail(spark):
    cases = [(x, d) for d in (2, 4, 10, 200, 5000) for x in (0.5, 3.0, 50.0, 250.0, 5100.0, 1e9)]
    df = spark.createDataFrame(cases, "x double, d long")
    for r in df.withColumn("p", chi_square_tail(F.col("x"), F.col("d"))).collect():
        expected = 0.0 if r["x"] > 1e8 else poisson_tail(r["x"], r["d"])
        assert r["p"] == pytest.approx(expected, abs=1e-10)
    odd = spark.createDataFrame([(3.841458820694124, 1), (7.814727903251179, 3), (0.0, 3), (1.0, 0)], "x double, d long")
    got = [r[0] for r in odd.select(chi_square_tail(F.col("x"), F.col("d"))).collect()]
    assert got == pytest.approx([0.05, 0.05, 1.0, 1.0], abs=1e-12)


def test_correlation_screen_is_greedy(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(1500):
        a = rng.gauss(0, 1)
        rows.append((a, a + rng.gauss(0, 0.2), rng.gauss(0, 1), a + rng.gauss(0, 0.1)))
    df = spark.createDataFrame(rows, "a double, b double, noise double, target double")
    got = {r["variable"]: r for r in screen.screen_by_correlation(df, ["b", "noise", "a"], "target").collect()}
    assert got["a"]["keep"] and not got["b"]["keep"] and got["b"]["redundant_with"] == "a"
    assert not got["noise"]["keep"] and got["noise"]["redundant_with"] is None


# --- metrics

def test_auc_and_metrics_equal_the_ml_evaluators(spark):
    rng = random.Random(8)
    rows = []
    for i in range(2500):
        y = float(rng.random() < 0.4)
        s = 0.5 if i % 3 == 0 else round(min(0.999, max(0.001, rng.gauss(0.4 + 0.2 * y, 0.2))), 2)
        rows.append((s, y, float(s > 0.5)))
    df = spark.createDataFrame(rows, "score double, label double, prediction double").repartition(4)
    area = metrics.roc_auc(df, "score").head()[0]
    assert area == pytest.approx(BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df), abs=1e-12)
    pos, neg = [s for s, y, _ in rows if y], [s for s, y, _ in rows if not y]
    pos, neg = np.array(pos)[:, None], np.array(neg)[None, :]
    assert area == pytest.approx(float(((pos > neg) + 0.5 * (pos == neg)).mean()), abs=1e-12)
    for r in metrics.classification_metrics(df).collect():
        for ours, theirs in (("precision", "precisionByLabel"), ("recall", "recallByLabel"), ("f1", "fMeasureByLabel"), ("accuracy", "accuracy")):
            expected = MulticlassClassificationEvaluator(metricName=theirs, metricLabel=r["label"]).evaluate(df)
            assert r[ours] == pytest.approx(expected, abs=1e-12)


# --- features

def test_slots_and_widths(spark):
    df = spark.createDataFrame([(0, 2), (3, None), (1, -4)], "a int, b int").select(
        "a", "b", category_slot(F.col("a")).alias("a_slot"), category_slot(F.col("b")).alias("b_slot"))
    fit = OneHotEncoder(inputCols=["a_slot", "b_slot"], outputCols=["a_vec", "b_vec"], handleInvalid="keep").fit(df)
    assert fit.categorySizes == [5, 4]
    slots = {(r["a"], r["feature"], r["slot"]) for r in features.active_slots(df, ["a"], {"a_vec": "a_slot", "b_vec": "b_slot"}, fit.categorySizes).collect()}
    assert slots == {(0, "a_vec", 1), (0, "b_vec", 3), (3, "a_vec", 4), (3, "b_vec", 0), (1, "a_vec", 2), (1, "b_vec", 0)}
    vectors = {(r["a"], f, int(r[f].indices[0])) for r in fit.transform(df).collect() for f in ("a_vec", "b_vec")}
    assert slots == vectors
    unseen = spark.createDataFrame([(9.0, 0.0)], "a_slot double, b_slot double")
    assert sum(vec[0] for vec in [fit.transform(unseen).select(F.aggregate(vector_to_array("a_vec"), F.lit(0.0), lambda s, v: s + v)).head()]) == 0
    shown = features.active_slots(unseen, [], {"a_vec": "a_slot", "b_vec": "b_slot"}, fit.categorySizes)
    assert [tuple(r) for r in shown.collect()] == [("b_vec", 0)]
    both = VectorAssembler(inputCols=["a_vec", "b_vec"], outputCol="f").transform(fit.transform(df))
    assert features.feature_width(both, "f") == 9


def test_standard_scores_equal_the_scaler(spark):
    df = spark.createDataFrame([(1.0, 4.0), (2.0, 4.0), (6.0, 4.0)], "a double, flat double")
    moments = {r["variable"]: (r["mean"], r["deviation"]) for r in quality.column_moments(df, ["a", "flat"]).collect()}
    ours = [tuple(r) for r in features.standardise(df, ["a", "flat"], moments).collect()]
    vectors = VectorAssembler(inputCols=["a", "flat"], outputCol="v").transform(df)
    scaled = StandardScaler(inputCol="v", outputCol="s", withMean=True, withStd=True).fit(vectors).transform(vectors)
    theirs = [tuple(r["s"]) for r in scaled.collect()]
    assert np.allclose(ours, theirs) and all(o[1] == 0.0 for o in ours)


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(5000).withColumn("k", F.col("id") * 7)
    parts = [{r["id"] for r in features.train_test(df.repartition(n), ["id", "k"])[0].collect()} for n in (1, 6)]
    assert parts[0] == parts[1] and 0.77 < len(parts[0]) / 5000 < 0.83
    train, test = features.train_test(df, ["id"])
    assert train.count() + test.count() == 5000 and train.join(test, "id").isEmpty()


def test_chi_square_tail_of_many_degrees(spark):
    rows = [(2.0e9, 2_000_000_000), (100_500.0, 100_001), (99_500.0, 100_001), (100_500.0, 100_000)]
    got = [r["p"] for r in spark.createDataFrame(rows, "x double, dof long").select(chi_square_tail(F.col("x"), F.col("dof")).alias("p")).collect()]
    assert got[0] == pytest.approx(0.5, abs=1e-4)
    assert got[1] == pytest.approx(got[3], abs=2e-3) and 0.1 < got[1] < 0.2 and 0.85 < got[2] < 0.9


def test_csv_quarantine(spark, tmp_path):
    from riskloom.sources.tables import read_csv_checked

    (tmp_path / "a.csv").write_text("id,x\n1,2.5\ntwo,3\n4,\n5,x\n")
    good, bad = read_csv_checked(spark, str(tmp_path / "a.csv"), "id int, x double")
    assert sorted(map(tuple, good.collect())) == [(1, 2.5), (4, None)]
    assert sorted(r["malformed_text"] for r in bad.collect()) == ["5,x", "two,3"]


# --- scratch tables

def test_shuffles_go_with_the_write_that_needed_them(spark):
    """A written table leaves no shuffle files behind, and the session's settings as they were."""
    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}

    before, setting = files(), spark.conf.get(SHUFFLES_GO)
    rows = spark.range(1000).select(F.pmod("id", F.lit(10)).alias("k"))
    out = materialise(rows.groupBy("k").agg(F.count("*").alias("n")), "counts")
    for _ in range(50):
        if not (left := files() - before):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(SHUFFLES_GO) == setting
    assert {r["n"] for r in out.collect()} == {100}
