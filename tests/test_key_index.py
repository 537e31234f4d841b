"""Key lookups in score tables: which folders and row groups they read."""

import pytest
from pyspark.sql import functions as F

from riskloom.sources import scores

KEYS = 200_000


def _rows_read(df):
    """Rows that the one scan of ``df`` took out of Parquet, before Spark filters them."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """Every second number as a key, in one folder of several row groups."""
    path = str(tmp_path_factory.mktemp("scores") / "t")
    rows = spark.range(KEYS).select((F.col("id") * 2).cast("string").alias("who"), F.col("id").alias("v"))
    scores.write_scores(rows.repartition(2), path, "who", buckets=1, row_group_bytes=1 << 20)
    return path


def test_an_absent_key_reads_no_row(spark, table):
    absent = [scores.lookup(scores.read_scores(spark, table), "who", str(k)) for k in range(100_001, 100_041, 2)]
    assert all(not df.collect() for df in absent)
    assert sum(_rows_read(df) > 0 for df in absent) <= 2  # a Bloom filter may err, at a rate of 0.01


def test_the_index_is_what_refuses_an_absent_key(spark, table, tmp_path):
    plain = str(tmp_path / "plain")
    scores.read_scores(spark, table).drop("key_bucket", "key_buckets").coalesce(1).sortWithinPartitions("who").write.parquet(plain)
    assert _rows_read(scores.lookup(spark.read.parquet(plain), "who", "100001")) > 0


def test_a_present_key_reads_little(spark, table):
    df = scores.lookup(scores.read_scores(spark, table), "who", " 100002 ")
    assert [r["v"] for r in df.collect()] == [50_001]
    assert 0 < _rows_read(df) < KEYS / 4


def test_a_few_keys_at_once(spark, table, tmp_path):
    found = scores.lookup_list(scores.read_scores(spark, table), "who", ["4", "5", " 100002", "nobody", "4"])
    assert sorted(r["v"] for r in found.collect()) == [2, 50_001]
    assert scores.lookup_list(scores.read_scores(spark, table), "who", []).isEmpty()
    path = str(tmp_path / "many")
    rows = spark.range(1000).select(F.col("id").cast("string").alias("who"), "id")
    for buckets in (3, 8):
        scores.write_scores(rows, path, "who", buckets=buckets)
    wanted = ["1", "17", "999", "1000"]
    got = scores.lookup_list(scores.read_scores(spark, path), "who", wanted)
    assert sorted(r["id"] for r in got.collect()) == [1, 1, 17, 17, 999, 999]


def test_a_few_keys_of_another_type(spark):
    df = spark.createDataFrame([(7, "a"), (8, "b"), (None, "c"), (9, "d")], "id int, v string")
    assert [r["v"] for r in scores.lookup_list(df, "id", ["7", "08", "9 ", "x"]).collect()] == ["a", "d"]


def test_hot_null_and_repeated_keys(spark, tmp_path):
    """A hot key keeps all its rows; a null key is found by none."""
    path = str(tmp_path / "hot")
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("who"), "id")
    scores.write_scores(rows, path, "who", buckets=4)
    table = scores.read_scores(spark, path)
    assert table.count() == 3000
    assert scores.lookup(table, "who", "hot").count() == 1000
    assert scores.lookup(table, "who", "").isEmpty()
