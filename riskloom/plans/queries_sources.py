"""Queries over the readers, writers, message decoding and score tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions.casts import lenient_double, lenient_int
from riskloom.functions.values import percent_text
from riskloom.operators.decode import decode_messages
from riskloom.operators.quality import row_count
from riskloom.operators.shape import preview
from riskloom.plans import jobs
from riskloom.plans.catalog import query
from riskloom.session import fresh_path
from riskloom.sources import messages, scores
from riskloom.sources.tables import read_csv, read_table


def _customer_csv(spark, sf):
    path = fresh_path(spark, "customer-csv")
    read_table(spark, sf, "customer").write.option("header", True).csv(path)
    return path


@query("csv_typed_scan", "SELECT * FROM customer")
def csv_typed_scan(spark, sf):
    schema = read_table(spark, sf, "customer").schema
    return read_csv(spark, _customer_csv(spark, sf), schema)


@query("csv_string_scan", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
FROM customer""")
def csv_string_scan(spark, sf):
    return read_csv(spark, _customer_csv(spark, sf))


@query("csv_inferred_scan", "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_inferred_scan(spark, sf):
    return read_csv(spark, _customer_csv(spark, sf), infer=True).withColumn("c_custkey", F.col("c_custkey").cast("int"))


@query("envelope_batch_read", """
SELECT event_type AS topic, CAST(user_id AS VARCHAR) AS key,
       CAST(to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type}) AS VARCHAR) AS value
FROM events WHERE event_type IN ('click', 'error')""")
def envelope_batch_read(spark, sf):
    events = read_table(spark, sf, "events")
    transport = messages.FileTransport(fresh_path(spark, "envelope"))
    transport.write(messages.encode_rows(events, F.col("event_type"), ["event_id", "user_id", "event_type"], key="user_id"))
    read = transport.read(spark, ["click", "error"])
    return read.select("topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


@query("json_encode_rows", """
SELECT c_custkey, CAST(to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_nationkey': nullif(c_nationkey, 0),
       'c_mktsegment': c_mktsegment}) AS VARCHAR) AS value
FROM customer""")
def json_encode_rows(spark, sf):
    customer = read_table(spark, sf, "customer").withColumn("c_nationkey", F.nullif("c_nationkey", F.lit(0)))
    fields = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    return customer.select("c_custkey", messages.json_value(customer, fields).cast("string").alias("value"))


@query("score_messages", """
SELECT 'predicted' AS topic, l_orderkey || '-' || l_linenumber AS key,
       CAST(to_json({'student_id': l_orderkey || '-' || l_linenumber, 'first_name': l_returnflag,
                     'last_name': l_linestatus, 'dropout_probability': l_discount}) AS VARCHAR) AS value
FROM lineitem""")
def score_messages(spark, sf):
    lines = read_table(spark, sf, "lineitem").withColumn("id", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    fields = {"student_id": "id", "first_name": "l_returnflag", "last_name": "l_linestatus", "dropout_probability": "l_discount"}
    sent = scores.score_messages(lines, fields, "predicted", key="id")
    return sent.select("topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def _documents_with_target(spark, sf):
    """Quality 1 is a label, quality 0 a blank one, no label row a null."""
    documents = read_table(spark, sf, "documents").select("doc_id")
    labels = read_table(spark, sf, "labels")
    target = F.when(F.col("quality") == 1, "1").when(F.col("quality") == 0, "  ").alias("target")
    return documents.join(labels, "doc_id", "left").select("doc_id", target)


@query("route_by_target", """
SELECT d.doc_id, CASE WHEN l.quality = 1 THEN 'with_target' ELSE 'without_target' END AS topic
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def route_by_target(spark, sf):
    routed = messages.route_by_target(_documents_with_target(spark, sf), "target", "with_target", "without_target")
    return routed.select("doc_id", "topic")


@query("route_counts", """
SELECT CASE WHEN l.quality = 1 THEN 'with_target' ELSE 'without_target' END AS topic, count(*) AS n
FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1""")
def route_counts(spark, sf):
    return messages.count_by_topic(
        messages.route_by_target(_documents_with_target(spark, sf), "target", "with_target", "without_target"))


@query("topic_audit", """
SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS partition, count(*) AS n,
       min(event_id) AS first_offset, max(event_id) AS last_offset
FROM events GROUP BY 1, 2""")
def topic_audit(spark, sf):
    envelope = read_table(spark, sf, "events").select(
        F.col("event_type").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset"))
    return messages.topic_audit(envelope)


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def rows_in_table(spark, sf):
    return row_count(read_table(spark, sf, "lineitem"))


@query("preview", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 20")
def first_rows(spark, sf):
    return preview(read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), ["o_orderkey"], 20)


_MESSAGE_TEXT_SQL = """CASE event_id % 100 WHEN 0 THEN left(props, length(props) - 1) WHEN 10 THEN '  ' WHEN 20 THEN '[1]'
    WHEN 30 THEN NULL WHEN 40 THEN '{"other": 1}' WHEN 50 THEN '{"K": 1}' ELSE props END"""


@query("json_decode", f"""
WITH m AS (SELECT event_id, {_MESSAGE_TEXT_SQL} AS text FROM events),
     j AS (SELECT event_id, text, CASE WHEN text IS NOT NULL AND trim(text) <> '' AND json_valid(text)
                  THEN json_type(text) = 'OBJECT' ELSE false END AS good FROM m)
SELECT event_id, CAST(CASE WHEN good THEN TRY_CAST(json_extract_string(text, '$.k') AS INTEGER) END AS VARCHAR) AS k,
       CASE WHEN good THEN json_extract_string(text, '$.other') END AS other,
       NOT good AS malformed, CASE WHEN NOT good THEN text END AS malformed_text
FROM j""")
def json_decode(spark, sf):
    props, turn = F.col("props"), F.col("event_id") % 100
    text = (F.when(turn == 0, F.expr("left(props, length(props) - 1)")).when(turn == 10, "  ").when(turn == 20, "[1]")
            .when(turn == 30, F.lit(None)).when(turn == 40, '{"other": 1}').when(turn == 50, '{"K": 1}').otherwise(props))
    envelope = read_table(spark, sf, "events").select("event_id", text.cast("binary").alias("value"))
    decoded = decode_messages(envelope, ["k", "other"], integers=["k"], keep=["event_id"])
    return decoded.withColumn("k", F.col("k").cast("string"))


_TEXT_FORMS_SQL = """CASE c_custkey % 14 WHEN 0 THEN '' WHEN 1 THEN 'Portugal' WHEN 2 THEN '1e1' WHEN 3 THEN '99999999999'
    WHEN 4 THEN c_custkey || '.0' WHEN 5 THEN ' ' || c_custkey || ' ' WHEN 6 THEN '-' || c_custkey || '.7'
    WHEN 7 THEN '+' || c_custkey WHEN 8 THEN 'NaN' WHEN 9 THEN '.5' WHEN 10 THEN '"NaN"' WHEN 11 THEN '5.'
    WHEN 12 THEN '   ' ELSE CAST(c_custkey AS VARCHAR) END"""


def _text_forms(spark, sf):
    text = F.expr(_TEXT_FORMS_SQL.replace("VARCHAR", "STRING"))
    return read_table(spark, sf, "customer").select("c_custkey", text.alias("text"))


@query("lenient_cast_int", rf"""
WITH t AS (SELECT c_custkey, {_TEXT_FORMS_SQL} AS text FROM customer)
SELECT c_custkey, CAST(CASE WHEN regexp_matches(text, '^\s*[+-]?(\d+(\.\d*)?|\.\d*)\s*$')
    THEN CASE WHEN regexp_extract(text, '^\s*([+-]?\d+)', 1) = '' THEN 0
              ELSE TRY_CAST(regexp_extract(text, '^\s*([+-]?\d+)', 1) AS INTEGER) END END AS VARCHAR) AS whole
FROM t""")
def lenient_cast_int(spark, sf):
    return _text_forms(spark, sf).select("c_custkey", lenient_int(F.col("text")).cast("string").alias("whole"))


@query("lenient_cast_double", f"""
WITH t AS (SELECT c_custkey, {_TEXT_FORMS_SQL} AS text FROM customer)
SELECT c_custkey, CASE WHEN NOT isnan(TRY_CAST(trim(text) AS DOUBLE)) THEN TRY_CAST(trim(text) AS DOUBLE) END AS number
FROM t""")
def lenient_cast_double(spark, sf):
    return _text_forms(spark, sf).select("c_custkey", lenient_double(F.col("text")).alias("number"))


@query("percent_text", """
SELECT l_orderkey, l_linenumber, printf('%.2f%%', l_discount * 100) AS discount FROM lineitem""")
def discount_percent(spark, sf):
    return read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", percent_text(F.col("l_discount")).alias("discount"))


@query("score_lookup", "SELECT event_id, user_id, value FROM events WHERE CAST(user_id AS VARCHAR) = '42'")
def score_lookup(spark, sf):
    return scores.lookup(read_table(spark, sf, "events").select("event_id", "user_id", "value"), "user_id", " 42 ")


@query("score_table_lookup", "SELECT event_id, CAST(user_id AS VARCHAR) AS student, value AS risk FROM events WHERE user_id = 42")
def score_table_lookup(spark, sf):
    path = fresh_path(spark, "scores")
    table = read_table(spark, sf, "events").select(
        "event_id", F.col("user_id").cast("string").alias("student"), F.col("value").alias("risk"))
    scores.write_scores(table, path, "student", buckets=8)
    return scores.lookup(scores.read_scores(spark, path), "student", "42 ").select("event_id", "student", "risk")


@query("lookup_any_bucket_count", """
SELECT event_id, CAST(user_id AS VARCHAR) AS student, n FROM events, (VALUES (3), (8)) AS folders(n) WHERE user_id = 42""")
def lookup_any_bucket_count(spark, sf):
    """One table written with two numbers of folders, read without naming either."""
    path = fresh_path(spark, "scores")
    table = read_table(spark, sf, "events").select("event_id", F.col("user_id").cast("string").alias("student"))
    for n in (3, 8):
        scores.write_scores(table.withColumn("n", F.lit(n)), path, "student", buckets=n)
    return scores.lookup(scores.read_scores(spark, path), "student", "42").select("event_id", "student", "n")


@query("indexed_key_lookup", """
SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS part FROM lineitem WHERE l_partkey IN (7, 19, 40)""")
def indexed_key_lookup(spark, sf):
    """A few keys, absent ones among them, of a table whose row groups are indexed by key."""
    path = fresh_path(spark, "scores")
    table = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part"))
    scores.write_scores(table, path, "part", buckets=4)
    found = scores.lookup_list(scores.read_scores(spark, path), "part", ["7", " 19", "40", "-1", "7x"])
    return found.select("l_orderkey", "l_linenumber", "part")


@query("published_and_checked", "SELECT 'suppliers' AS topic, count(*) AS n_rows, count(*) AS n_messages FROM supplier")
def published_and_checked(spark, sf):
    return jobs.publish_and_check(read_table(spark, sf, "supplier"), messages.FileTransport(fresh_path(spark, "topic")), "suppliers", partitions=4)


@query("score_lookup_many", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def score_lookup_many(spark, sf):
    wanted = read_table(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    table = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return scores.lookup_many(table, wanted, "o_custkey", "c_custkey")


@query("score_key_join", """
SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer JOIN orders ON c_custkey = o_custkey""")
def score_key_join(spark, sf):
    identities = read_table(spark, sf, "customer").select("c_custkey", "c_name")
    scored = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return scores.attach_scores(identities, scored, "c_custkey", "o_custkey")


@query("latest_per_key", """
SELECT user_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id""")
def latest_score(spark, sf):
    return scores.latest_per_key(read_table(spark, sf, "events"), "user_id", ["ts", "event_id"], "value")


@query("first_score_per_key", """
SELECT user_id, arg_min(value, (ts, event_id)) AS value FROM events GROUP BY user_id""")
def first_score(spark, sf):
    return scores.first_per_key(read_table(spark, sf, "events"), "user_id", ["ts", "event_id"], "value")


@query("unscored_rows", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def unscored_rows(spark, sf):
    documents = read_table(spark, sf, "documents").select("doc_id", "lang")
    return scores.unscored(documents, read_table(spark, sf, "labels"), "doc_id", "doc_id")
