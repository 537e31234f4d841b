"""Queries over shaping, audits, dictionaries, screening and metrics."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskloom.functions.labels import binary_label, is_labelled, label_index, recode
from riskloom.functions.values import category_slot, pair_mean, vector_element
from riskloom.operators import dictionary, features, metrics, quality, screen, shape
from riskloom.plans.catalog import query
from riskloom.sources.tables import read_table

STATUS_ORDER = ("F", "O", "P")


def _status_index(spark, sf):
    orders = read_table(spark, sf, "orders")
    return orders.withColumn("status_index", label_index(F.col("o_orderstatus"), STATUS_ORDER))


@query("class_distribution", """
SELECT CASE o_orderstatus WHEN 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label, count(*) AS n
FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1""")
def class_distribution(spark, sf):
    kept = _status_index(spark, sf).filter(F.col("status_index") != 2.0)
    return quality.class_distribution(kept.withColumn("label", recode(F.col("status_index"), 0.0)), "label")


@query("class_distribution_stages", """
SELECT 'before' AS stage, CASE o_orderstatus WHEN 'F' THEN 0.0::DOUBLE WHEN 'O' THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS label,
       count(*) AS n FROM orders GROUP BY 2
UNION ALL
SELECT 'after', CASE o_orderstatus WHEN 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END, count(*)
FROM orders WHERE o_orderstatus <> 'P' GROUP BY 2""")
def class_distribution_stages(spark, sf):
    before = _status_index(spark, sf).withColumnRenamed("status_index", "label")
    after = before.filter(F.col("label") != 2.0).withColumn("label", recode(F.col("label"), 0.0))
    return quality.class_distribution_stages({"before": before, "after": after}, "label")


@query("label_index", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 0.0::DOUBLE WHEN 'F' THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS status_index
FROM orders""")
def label_index_keep(spark, sf):
    index = label_index(F.col("o_orderstatus"), ("O", "F"), unknown="keep")
    return read_table(spark, sf, "orders").select("o_orderkey", index.alias("status_index"))


@query("binary_label", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1.0::DOUBLE WHEN 'O' THEN 0.0::DOUBLE END AS label FROM orders""")
def status_label(spark, sf):
    return read_table(spark, sf, "orders").select("o_orderkey", binary_label(F.col("o_orderstatus"), "F", "O").alias("label"))


@query("rename_columns", """
SELECT c_custkey AS customer, c_name AS "customer's name", c_nationkey, c_acctbal AS balance, c_mktsegment FROM customer""")
def rename_columns(spark, sf):
    return shape.rename_columns(read_table(spark, sf, "customer"),
                                {"c_custkey": "customer", "c_name": "customer's name", "c_acctbal": "balance"})


@query("normalise_names", """
SELECT c_custkey AS customer_key, c_name AS full_name, c_nationkey AS nation_code, c_acctbal AS account_balance_usd,
       c_mktsegment AS "day/evening_segment" FROM customer""")
def normalise_names(spark, sf):
    raw = read_table(spark, sf, "customer").toDF(
        "customer key", "full name", "nation (code)", "account balance (usd)", "day/evening segment")
    return shape.normalise_names(raw)


@query("drop_columns", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def drop_columns(spark, sf):
    return shape.drop_columns(read_table(spark, sf, "orders"), ["o_orderstatus", "o_orderdate", "not_there"])


@query("drop_by_pattern", "SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_returnflag, l_linestatus FROM lineitem")
def drop_by_pattern(spark, sf):
    return shape.drop_by_pattern(read_table(spark, sf, "lineitem"), ["partkey", "suppkey", "price", "date"], ["l_tax"])


@query("project_columns", "SELECT p_partkey, p_brand, p_size FROM part")
def project_columns(spark, sf):
    return read_table(spark, sf, "part").select("p_partkey", "p_brand", "p_size")


@query("pair_average", """
SELECT l_orderkey, l_linenumber, round((l_discount + nullif(l_tax, 0)) / 2, 6) AS avg_rate,
       round((l_quantity + l_extendedprice) / 2, 6) AS avg_size FROM lineitem""")
def pair_average(spark, sf):
    lines = read_table(spark, sf, "lineitem").withColumn("l_tax", F.nullif("l_tax", F.lit(0.0)))
    means = shape.add_pair_means(lines, {"avg_rate": ("l_discount", "l_tax"), "avg_size": ("l_quantity", "l_extendedprice")})
    return means.select("l_orderkey", "l_linenumber", F.round("avg_rate", 6).alias("avg_rate"), F.round("avg_size", 6).alias("avg_size"))


@query("score_element", "SELECT vec_id, CAST(embedding[2] AS DOUBLE) AS second FROM embeddings")
def score_element(spark, sf):
    vectors = read_table(spark, sf, "embeddings").withColumn("v", array_to_vector(F.col("embedding").cast("array<double>")))
    return vectors.select("vec_id", vector_element(F.col("v"), 1).alias("second"))


_PRICED_SQL = "SELECT *, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice END AS price FROM orders"
_RULES = ["o_orderstatus = 'F' AND price < 50000"]


def _priced(spark, sf):
    return read_table(spark, sf, "orders").withColumn("price", F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_totalprice")))


@query("contradiction_rows", f"""
SELECT o_orderkey, price FROM ({_PRICED_SQL}) WHERE o_orderstatus = 'F' AND price < 50000""")
def contradiction_rows(spark, sf):
    return shape.contradictory_rows(_priced(spark, sf), _RULES).select("o_orderkey", "price")


@query("contradiction_removed", f"""
SELECT o_orderkey, price FROM ({_PRICED_SQL}) WHERE NOT coalesce(o_orderstatus = 'F' AND price < 50000, false)""")
def contradiction_removed(spark, sf):
    return shape.without_contradictions(_priced(spark, sf), _RULES).select("o_orderkey", "price")


@query("drop_class", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'")
def drop_class(spark, sf):
    return shape.drop_classes(read_table(spark, sf, "orders"), "o_orderstatus", ["P"]).select("o_orderkey", "o_orderstatus")


def _blank_status(spark, sf):
    status = F.when(F.col("o_orderstatus") == "P", " ").when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderstatus"))
    return read_table(spark, sf, "orders").select("o_orderkey", status.alias("status"))


@query("labelled_rows", """
SELECT o_orderkey, o_orderstatus AS status FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'""")
def labelled_rows(spark, sf):
    return _blank_status(spark, sf).filter(is_labelled(F.col("status")))


@query("labelled_exists", """
SELECT count(*) > 0 AS any_labelled FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'""")
def labelled_exists(spark, sf):
    return quality.labelled_exists(_blank_status(spark, sf), "status")


def _holes(spark, sf):
    return read_table(spark, sf, "lineitem").select(
        "l_orderkey", F.nullif("l_linenumber", F.lit(1)).alias("l_linenumber"), F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.nullif("l_returnflag", F.lit("N")).alias("l_returnflag"))


@query("null_audit", """
SELECT CAST(0 AS BIGINT) AS l_orderkey, count(*) FILTER (l_linenumber = 1) AS l_linenumber,
       count(*) FILTER (l_discount = 0) AS l_discount, count(*) FILTER (l_returnflag = 'N') AS l_returnflag FROM lineitem""")
def null_audit(spark, sf):
    return quality.null_audit(_holes(spark, sf))


@query("null_audit_long", """
SELECT 'l_orderkey' AS variable, CAST(0 AS BIGINT) AS n_null
UNION ALL SELECT 'l_linenumber', count(*) FROM lineitem WHERE l_linenumber = 1
UNION ALL SELECT 'l_discount', count(*) FROM lineitem WHERE l_discount = 0
UNION ALL SELECT 'l_returnflag', count(*) FROM lineitem WHERE l_returnflag = 'N'""")
def null_audit_long(spark, sf):
    return quality.null_audit_long(_holes(spark, sf))


@query("column_moments", """
SELECT 'l_quantity' AS variable, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS deviation FROM lineitem
UNION ALL SELECT 'l_discount', round(avg(l_discount), 6), round(stddev_samp(l_discount), 6) FROM lineitem
UNION ALL SELECT 'l_tax', round(avg(l_tax), 6), round(stddev_samp(l_tax), 6) FROM lineitem""")
def column_moments(spark, sf):
    moments = quality.column_moments(read_table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"])
    return moments.select("variable", F.round("mean", 6).alias("mean"), F.round("deviation", 6).alias("deviation"))


@query("category_sizes", """
SELECT CAST(max(l_linenumber) + 1 AS BIGINT) AS l_linenumber, CAST(max(l_suppkey) + 1 AS BIGINT) AS l_suppkey FROM lineitem""")
def category_sizes(spark, sf):
    return quality.category_sizes(read_table(spark, sf, "lineitem"), ["l_linenumber", "l_suppkey"])


@query("category_report", """
SELECT 'p_size' AS variable, count(*) FILTER (p_size = 7) AS n_null, count(*) FILTER (p_size < 5) AS n_negative FROM part""")
def category_report(spark, sf):
    shifted = read_table(spark, sf, "part").select((F.nullif("p_size", F.lit(7)) - 5).alias("p_size"))
    return quality.category_report(shifted, ["p_size"])


@query("quarantined_rows", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_tax = 0 AND l_discount = 0 THEN 'l_discount,l_tax'
       WHEN l_tax = 0 THEN 'l_tax' ELSE 'l_discount' END AS faults
FROM lineitem WHERE l_tax = 0 OR l_discount = 0""")
def quarantined_rows(spark, sf):
    """A zero discount stands for a null, a zero tax for a NaN."""
    lines = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.when(F.col("l_tax") == 0, float("nan")).otherwise(F.col("l_tax")).alias("l_tax"))
    found = quality.quarantined(lines, ["l_discount", "l_tax"])
    return found.select("l_orderkey", "l_linenumber", F.array_join("faults", ",").alias("faults"))


_PRIORITIES = {"priority": ("URGENT", "HIGH", "MEDIUM", "NOT SPECIFIED")}


def _priority_codes(spark, sf):
    return read_table(spark, sf, "orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("priority_code"))


@query("code_dictionary_join", """
SELECT o_orderkey, CAST(left(o_orderpriority, 1) AS INTEGER) AS priority_code,
       CASE left(o_orderpriority, 1) WHEN '1' THEN 'URGENT' WHEN '2' THEN 'HIGH' WHEN '3' THEN 'MEDIUM'
            WHEN '4' THEN 'NOT SPECIFIED' END AS priority FROM orders""")
def code_dictionary_join(spark, sf):
    codes = dictionary.code_dictionary(spark, _PRIORITIES)
    return dictionary.attach_label(_priority_codes(spark, sf), codes, "priority", "priority_code", "priority")


@query("nation_dictionary_join", """
SELECT c_custkey, c_nationkey, n_name AS nation FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey <> 1""")
def nation_dictionary_join(spark, sf):
    nations = read_table(spark, sf, "nation").filter(F.col("n_regionkey") != 1).select(
        F.lit("nation").alias("attribute"), F.col("n_nationkey").alias("code"), F.col("n_name").alias("label"))
    return dictionary.attach_label(
        read_table(spark, sf, "customer").select("c_custkey", "c_nationkey"), nations, "nation", "c_nationkey", "nation")


@query("unknown_codes", """
SELECT 'priority' AS attribute, CAST(left(o_orderpriority, 1) AS BIGINT) AS code, count(*) AS n
FROM orders WHERE left(o_orderpriority, 1) = '5' GROUP BY 2""")
def unknown_codes(spark, sf):
    codes = dictionary.code_dictionary(spark, _PRIORITIES)
    return dictionary.unknown_codes(_priority_codes(spark, sf), codes, {"priority": "priority_code"})


@query("encode_labels", """
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 WHEN 'HOUSEHOLD' THEN 3 ELSE 0 END AS c_mktsegment
FROM customer""")
def encode_labels(spark, sf):
    people = read_table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return dictionary.encode_labels(people, {"c_mktsegment": ("BUILDING", "MACHINERY", "HOUSEHOLD")})


def _chi_square_sql(features_: list[str], alpha: float = 0.05) -> str:
    """Pearson's statistic from the contingency table, zero cells included; p-values by the
    finite sum that holds for an even number of degrees of freedom."""
    parts = []
    for f in features_:
        parts.append(f"""SELECT '{f}' AS variable, (SELECT sum((coalesce(o.n, 0) - r.n * c.n / t.n) ** 2 / (r.n * c.n / t.n))
        FROM (SELECT {f} AS v, count(*)::DOUBLE AS n FROM lineitem GROUP BY 1) r
        CROSS JOIN (SELECT l_linestatus AS y, count(*)::DOUBLE AS n FROM lineitem GROUP BY 1) c
        CROSS JOIN (SELECT count(*)::DOUBLE AS n FROM lineitem) t
        LEFT JOIN (SELECT {f} AS v, l_linestatus AS y, count(*)::DOUBLE AS n FROM lineitem GROUP BY 1, 2) o
               ON o.v = r.v AND o.y = c.y) AS statistic,
        (SELECT (count(DISTINCT {f}) - 1) * (count(DISTINCT l_linestatus) - 1) FROM lineitem) AS dof""")
    return f"""WITH tested AS ({' UNION ALL '.join(parts)}),
    judged AS (SELECT variable, statistic, dof, round(exp(-statistic / 2) * list_sum(list_transform(range(CAST(dof // 2 AS BIGINT)),
        lambda i: (statistic / 2) ** i / gamma(i + 1))), 5) AS p_value FROM tested)"""


_TESTED = ["l_returnflag", "l_linenumber", "l_discount", "l_tax"]


@query("chi_square_stat", _chi_square_sql(_TESTED) + " SELECT variable, round(statistic, 5) AS statistic, dof FROM judged")
def chi_square_stat(spark, sf):
    tested = screen.chi_square_stat(read_table(spark, sf, "lineitem"), _TESTED, "l_linestatus", ["F", "O"])
    return tested.select("variable", F.round("statistic", 5).alias("statistic"), "dof")


@query("chi_square_screen", _chi_square_sql(_TESTED) + " SELECT variable, round(statistic, 5) AS statistic, dof, p_value FROM judged")
def chi_square_screen(spark, sf):
    tested = screen.chi_square_screen(read_table(spark, sf, "lineitem"), _TESTED, "l_linestatus")
    return tested.withColumn("statistic", F.round("statistic", 5))


@query("feature_screen_chi2", _chi_square_sql(_TESTED) + " SELECT variable, p_value, p_value < 0.5 AS keep FROM judged")
def feature_screen_chi2(spark, sf):
    return screen.screen_by_chi_square(read_table(spark, sf, "lineitem"), _TESTED, "l_linestatus", alpha=0.5)


_RANKED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _spearman_sql(columns: list[str], source: str) -> str:
    ranks = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in columns)
    cells = " UNION ALL ".join(f"SELECT '{x}' AS feature_x, '{y}' AS feature_y, corr({x}, {y}) AS rho FROM ranked"
                               for x in columns for y in columns)
    return f"WITH RECURSIVE ranked AS (SELECT {ranks} FROM ({source})), matrix AS ({cells})"


@query("spearman_matrix", _spearman_sql(_RANKED, "SELECT * FROM lineitem")
       + " SELECT feature_x, feature_y, round(rho, 8) AS rho FROM matrix")
def spearman_matrix(spark, sf):
    return screen.spearman_matrix(read_table(spark, sf, "lineitem"), _RANKED).withColumn("rho", F.round("rho", 8))


@query("feature_screen_corr", _spearman_sql([*_RANKED, "big"], "SELECT *, CAST(l_quantity > 25 AS INTEGER) AS big FROM lineitem") + """
, placed AS (SELECT feature_x AS variable, rho, row_number() OVER (ORDER BY abs(rho) DESC, feature_x) AS k
             FROM matrix WHERE feature_y = 'big' AND feature_x <> 'big'),
walk AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS VARCHAR[]) AS kept, CAST(NULL AS VARCHAR) AS rival
         UNION ALL
         SELECT p.k, CASE WHEN abs(p.rho) >= 0.05 AND len(list_filter(w.kept, lambda v: list_contains(rv.rivals, v))) = 0
                          THEN list_append(w.kept, p.variable) ELSE w.kept END,
                list_filter(w.kept, lambda v: list_contains(rv.rivals, v))[1]
         FROM walk w JOIN placed p ON p.k = w.k + 1
         JOIN (SELECT feature_x, coalesce(list(feature_y) FILTER (abs(rho) > 0.7 AND feature_x <> feature_y AND feature_y <> 'big'), []) AS rivals
               FROM matrix GROUP BY 1) rv ON rv.feature_x = p.variable)
SELECT p.variable, round(p.rho, 8) AS r_target, w.rival AS redundant_with, list_contains(w.kept, p.variable) AS keep
FROM placed p JOIN walk w USING (k)""")
def feature_screen_corr(spark, sf):
    lines = read_table(spark, sf, "lineitem").withColumn("big", (F.col("l_quantity") > 25).cast("int"))
    return screen.screen_by_correlation(lines, _RANKED, "big").withColumn("r_target", F.round("r_target", 8))


def _judged(spark, sf):
    return read_table(spark, sf, "lineitem").select(
        "l_extendedprice", (F.col("l_quantity") > 25).cast("double").alias("label"),
        (F.col("l_extendedprice") > 30000).cast("double").alias("prediction"))


@query("classification_metrics", " UNION ALL ".join(f"""
SELECT {v}::DOUBLE AS label, round(avg(CAST(y = p AS INTEGER)), 8) AS accuracy,
       round(count(*) FILTER (y = {v} AND p = {v}) / count(*) FILTER (p = {v}), 8) AS precision,
       round(count(*) FILTER (y = {v} AND p = {v}) / count(*) FILTER (y = {v}), 8) AS recall,
       round(2 * count(*) FILTER (y = {v} AND p = {v}) / (count(*) FILTER (p = {v}) + count(*) FILTER (y = {v})), 8) AS f1,
       count(*) FILTER (y = {v}) AS support
FROM (SELECT CAST(l_quantity > 25 AS INTEGER) AS y, CAST(l_extendedprice > 30000 AS INTEGER) AS p FROM lineitem)""" for v in (0, 1)))
def classification_metrics(spark, sf):
    found = metrics.classification_metrics(_judged(spark, sf))
    return found.withColumns({c: F.round(c, 8) for c in ("accuracy", "precision", "recall", "f1")})


@query("roc_auc", """
WITH r AS (SELECT l_quantity > 25 AS y, rank() OVER (ORDER BY l_extendedprice)
                  + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS rk FROM lineitem),
     s AS (SELECT sum(rk) FILTER (y) AS ranks, CAST(count(*) FILTER (y) AS DOUBLE) AS n1,
                  CAST(count(*) FILTER (NOT y) AS DOUBLE) AS n0 FROM r)
SELECT round((ranks - n1 * (n1 + 1) / 2) / (n1 * n0), 8) AS auc FROM s""")
def roc_auc(spark, sf):
    return metrics.roc_auc(_judged(spark, sf), "l_extendedprice").withColumn("auc", F.round("auc", 8))


def _slots(spark, sf):
    return read_table(spark, sf, "lineitem").withColumns({
        "number_slot": category_slot(F.nullif("l_linenumber", F.lit(3))),
        "supplier_slot": category_slot(F.col("l_suppkey"))})


def _encoder(slots):
    return OneHotEncoder(inputCols=["number_slot", "supplier_slot"], outputCols=["number_vec", "supplier_vec"], handleInvalid="keep").fit(slots)


@query("one_hot", """
SELECT l_orderkey, l_linenumber, 'number_vec' AS feature, CASE WHEN l_linenumber = 3 THEN 0 ELSE l_linenumber + 1 END AS slot FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'supplier_vec', l_suppkey + 1 FROM lineitem""")
def one_hot(spark, sf):
    slots = _slots(spark, sf)
    blocks = {"number_vec": "number_slot", "supplier_vec": "supplier_slot"}
    return features.active_slots(slots, ["l_orderkey", "l_linenumber"], blocks, _encoder(slots).categorySizes)


def _assembled(spark, sf):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return VectorAssembler(inputCols=columns, outputCol="features").transform(read_table(spark, sf, "lineitem"))


@query("assemble_features", " UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, {i} AS position, {c} AS value FROM lineitem" for i, c in enumerate(_RANKED)))
def assemble_features(spark, sf):
    arrays = features.vector_as_array(_assembled(spark, sf), "features", "numbers")
    return arrays.select("l_orderkey", "l_linenumber", F.posexplode("numbers").alias("position", "value"))


@query("feature_width", "SELECT CAST(max(l_suppkey) + 2 + max(l_linenumber) + 2 + 4 AS BIGINT) AS width FROM lineitem")
def feature_width(spark, sf):
    columns = ["number_vec", "supplier_vec", *_RANKED]
    slots = _slots(spark, sf)
    encoded = VectorAssembler(inputCols=columns, outputCol="features").transform(_encoder(slots).transform(slots))
    return spark.createDataFrame([(features.feature_width(encoded, "features"),)], "width bigint")


@query("standardise", """
SELECT l_orderkey, l_linenumber, round((l_quantity - avg(l_quantity) OVER ()) / stddev_samp(l_quantity) OVER (), 6) AS l_quantity,
       round((l_discount - avg(l_discount) OVER ()) / stddev_samp(l_discount) OVER (), 6) AS l_discount, 0.0::DOUBLE AS one FROM lineitem""")
def standardise(spark, sf):
    columns = ["l_quantity", "l_discount", "one"]
    lines = read_table(spark, sf, "lineitem").withColumn("one", F.lit(1.0))
    moments = {r["variable"]: (r["mean"], r["deviation"]) for r in quality.column_moments(lines, columns).collect()}
    scaled = features.standardise(lines, columns, moments)
    return scaled.select("l_orderkey", "l_linenumber", F.round("l_quantity", 6).alias("l_quantity"),
                         F.round("l_discount", 6).alias("l_discount"), "one")


@query("hash_split", """
SELECT l_orderkey, l_linenumber, CASE WHEN ('0x' || left(md5(l_orderkey || '|' || l_linenumber), 8))::BIGINT % 100 < 80
       THEN 'train' ELSE 'test' END AS part FROM lineitem""")
def hash_split(spark, sf):
    marked = features.hash_split(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    return marked.select("l_orderkey", "l_linenumber", "part")


@query("pair_mean_by_order", """
SELECT l_orderkey, round((max(l_quantity) FILTER (l_linenumber = 1) + max(l_quantity) FILTER (l_linenumber = 2)) / 2, 6) AS avg_quantity
FROM lineitem GROUP BY 1""")
def pair_mean_by_order(spark, sf):
    """Two periods of one record side by side: null when an order lacks line 1 or 2."""
    def line(n: int):
        return F.max(F.when(F.col("l_linenumber") == n, F.col("l_quantity"))).alias(f"line_{n}")

    wide = read_table(spark, sf, "lineitem").groupBy("l_orderkey").agg(line(1), line(2))
    return wide.select("l_orderkey", F.round(pair_mean("line_1", "line_2"), 6).alias("avg_quantity"))
