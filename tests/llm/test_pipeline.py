"""The pipeline's stages, and the registration of the queries."""

import duckdb
import pytest
from cases import SCHEMA, documents, frame
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
import corpus_pipeline
import public_tokenizers
from riskloom.llm.queries import ORACLES, QUERIES


def test_registration():
    assert [n.split("_")[0] for n in QUERIES] == [*(f"op{n}" for n in range(1, 14)), "pipeline"]
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_sql(spark, tables, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{tables}/{table}.parquet'")
    got, want = QUERIES[name](spark, tables).toPandas(), con.sql(ORACLES[name]).df()
    assert set(got.columns) == set(want.columns)
    plain = [sorted(map(str, f[sorted(f.columns)].astype(object).itertuples(index=False, name=None))) for f in (got, want)]
    assert plain[0] == plain[1]


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, tables).collect(), SCHEMA)
        assert docs.columns == list(corpus_pipeline.COLUMNS), name
        counts.append(docs.count())
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[3] == counts[2]
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    good = labels.where("quality = 1").join(corpus_pipeline.keep_good(spark, spark.read.parquet(f"{tables}/documents.parquet"), tables), "doc_id")
    assert good.count() >= 0.95 * labels.where("quality = 1").count()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in corpus_pipeline.tokenise(spark, docs, tables).collect():
        assert r["ids"] == library.encode(r["text"], add_special_tokens=False).ids and r["n_tokens"] == len(r["ids"])


def test_stages_take_odd_rows(spark, tables):
    rows = [*documents(), (None, "no id", None, None, None)]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame(spark, rows), tables).collect()
        assert out, name
        assert stage(spark, frame(spark, []), tables).collect() == [], name


def test_repeated_and_null_ids(spark, tables):
    """Rows that share an id, or have none, are rows of their own in the mix; of repeated rows of a group one stays."""
    words = [" ".join(f"d{i}w{j}" for j in range(12)) for i in range(4)]
    rows = [(7, words[0], "en", "a", 1)] * 5 + [(None, words[1], "en", "a", 1)] * 6 + [(8, words[2], "en", "a", 1), (8, words[3], "en", "a", 1)]
    mixed = corpus_pipeline.mix_sources(spark, frame(spark, rows), tables).collect()
    assert sorted(r["text"] for r in mixed) == sorted(r[1] for r in rows)
    near = words[0] + " more"
    rows += [(9, words[0], "en", "a", 1), (7, near, "en", "a", 1), (7, words[3], "en", "a", 1), (8, words[0], "en", "a", 1), (5, "", "en", "a", 0), (5, "", "en", "a", 0)]
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.keep_one_of_near_copies(spark, frame(spark, rows), tables).collect()]
    assert sum(i == 7 and t in (words[0], near) for i, t in kept) == 1
    rest = [(i, t) for i, t in kept if t not in (words[0], near)]
    assert sorted(rest, key=str) == sorted([(None, words[1])] * 6 + [(8, words[2]), (7, words[3]), (5, ""), (5, "")], key=str)
