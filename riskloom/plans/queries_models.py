"""Queries over training, scoring, evaluation and the versioned jobs.

Two facts give SQL something to say about a fitted model. An unregularised logistic
regression on the slots of one category predicts each category's own rate. And with any
features, the fitted probabilities sum to the observed labels within every slot and against
every number (the fit's own optimum condition).
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from riskloom.operators.features import train_test
from riskloom.operators.metrics import roc_auc
from riskloom.operators.screen import chi_square_stat, contingency_cells
from riskloom.plans import jobs, pipeline
from riskloom.plans.catalog import query
from riskloom.session import fresh_path
from riskloom.sources.tables import read_table
from riskloom.spec import FeatureSpec

LINE_SPEC = FeatureSpec(
    keys=("l_orderkey", "l_linenumber"),
    target="l_linestatus",
    label_order=("F", "O"),
    positive_label="O",
    categorical=("l_linenumber",),
    text_categorical=("l_returnflag",),
    numeric=("l_quantity", "l_extendedprice", "avg_rate"),
    pairs={"avg_rate": ("l_discount", "l_tax")},
    drops=("l_discount", "l_tax"),
)
RATE_SPEC = FeatureSpec(
    keys=("o_orderkey",),
    target="o_orderstatus",
    label_order=("F", "O", "P"),
    positive_label="F",
    dropped_labels=("P",),
    text_categorical=("o_orderpriority",),
    tolerance=1e-9,
)
_RATES = """WITH rates AS (SELECT o_orderpriority, avg(CAST(o_orderstatus = 'F' AS INTEGER)) AS p
    FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1)"""
_RATE_SCORES = _RATES + """
SELECT o_orderkey, round(p, 5) AS p_positive, round(1 - p, 5) AS p_negative, CASE WHEN p > 0.5 THEN 'F' ELSE 'O' END AS prediction
FROM orders JOIN rates USING (o_orderpriority)"""
MARK = "1998-01-01"


def rounded(scored, places: int = 5):
    return scored.withColumns({c: F.round(c, places) for c in ("p_positive", "p_negative")})


def line_model(spark, sf, spec=LINE_SPEC):
    lines = pipeline.clean(read_table(spark, sf, "lineitem"), spec)
    return lines, pipeline.train(lines, spec)


def rate_model(spark, sf):
    orders = pipeline.clean(read_table(spark, sf, "orders"), RATE_SPEC)
    return orders, pipeline.train(orders, RATE_SPEC)


@query("train_coefficients")
def train_coefficients(spark, sf):
    _, model = line_model(spark, sf)
    return pipeline.coefficients(model, spark)


@query("train_log_odds", _RATES + """
SELECT 'o_orderpriority=' || o_orderpriority AS feature, round(ln(p / (1 - p)), 4) AS log_odds FROM rates""")
def train_log_odds(spark, sf):
    """Intercept plus weight of each category, which is that category's own log odds."""
    _, model = rate_model(spark, sf)
    weights = pipeline.coefficients(model, spark).filter((F.col("position") >= 0) & ~F.col("feature").endswith("(unseen)"))
    return weights.select("feature", F.round(F.col("coefficient") + float(model.regression.intercept), 4).alias("log_odds"))


@query("scored_lines")
def scored_lines(spark, sf):
    lines, model = line_model(spark, sf)
    return pipeline.score(lines, model)


@query("scored_with_keys", _RATE_SCORES)
def scored_with_keys(spark, sf):
    orders, model = rate_model(spark, sf)
    return rounded(pipeline.score(orders, model))


@query("model_save_load", _RATE_SCORES)
def model_save_load(spark, sf):
    orders, model = rate_model(spark, sf)
    path = fresh_path(spark, "model")
    model.save(path)
    return rounded(pipeline.score(orders, pipeline.RiskModel.load(spark, path)))


@query("model_balance", """
WITH lines AS (SELECT l_returnflag, l_linenumber, CAST(l_linestatus = 'O' AS INTEGER) AS y, l_quantity, (l_discount + l_tax) / 2 AS rate FROM lineitem)
SELECT l_returnflag, NULL::VARCHAR AS l_linenumber, round(avg(y), 4) AS rate, NULL::DOUBLE AS mean_quantity, NULL::DOUBLE AS mean_rate
FROM lines GROUP BY 1
UNION ALL SELECT NULL, CAST(l_linenumber AS VARCHAR), round(avg(y), 4), NULL, NULL FROM lines GROUP BY 2
UNION ALL SELECT NULL, NULL, round(avg(y), 4), round(avg(y * l_quantity), 3), round(avg(y * rate), 5) FROM lines""")
def model_balance(spark, sf):
    """Mean fitted probability per slot, and its mean product with the numbers."""
    lines, model = line_model(spark, sf, replace(LINE_SPEC, tolerance=1e-9))
    scored = pipeline.score(lines, model, ["l_returnflag", "l_linenumber", "l_quantity", "avg_rate"])
    p = F.col("p_positive")
    sets = scored.groupingSets([["l_returnflag"], ["l_linenumber"], []], "l_returnflag", "l_linenumber").agg(
        F.avg(p).alias("rate"), F.avg(p * F.col("l_quantity")).alias("pq"), F.avg(p * F.col("avg_rate")).alias("pr"),
        F.grouping_id().alias("gid"))
    whole = F.col("gid") == 3
    return sets.select(
        "l_returnflag", F.col("l_linenumber").cast("string").alias("l_linenumber"), F.round("rate", 4).alias("rate"),
        F.when(whole, F.round("pq", 3)).alias("mean_quantity"), F.when(whole, F.round("pr", 5)).alias("mean_rate"))


_HELD_OUT = """WITH parts AS (SELECT *, ('0x' || left(md5(CAST(o_orderkey AS VARCHAR)), 8))::BIGINT % 100 < 80 AS train FROM orders
        WHERE o_orderstatus <> 'P'),
    rates AS (SELECT o_orderpriority, avg(CAST(o_orderstatus = 'F' AS INTEGER)) AS s FROM parts WHERE train GROUP BY 1),
    judged AS (SELECT CAST(o_orderstatus = 'F' AS INTEGER) AS y, CAST(s > 0.5 AS INTEGER) AS p, s
               FROM parts JOIN rates USING (o_orderpriority) WHERE NOT train)"""


def _held_out(spark, sf):
    orders = pipeline.clean(read_table(spark, sf, "orders"), RATE_SPEC)
    fit, rest = train_test(orders, ["o_orderkey"])
    return rest, pipeline.train(fit, RATE_SPEC)


@query("holdout_metrics", _HELD_OUT + " UNION ALL ".join(f"""
SELECT {v}::DOUBLE AS label, round(avg(CAST(y = p AS INTEGER)), 8) AS accuracy,
       round(coalesce(count(*) FILTER (y = {v} AND p = {v}) / nullif(count(*) FILTER (p = {v}), 0), 0), 8) AS precision,
       round(count(*) FILTER (y = {v} AND p = {v}) / count(*) FILTER (y = {v}), 8) AS recall,
       round(2 * count(*) FILTER (y = {v} AND p = {v}) / (count(*) FILTER (p = {v}) + count(*) FILTER (y = {v})), 8) AS f1,
       count(*) FILTER (y = {v}) AS support FROM judged""" for v in (0, 1)))
def holdout_metrics(spark, sf):
    found = pipeline.evaluate_labels(*_held_out(spark, sf))
    return found.withColumns({c: F.round(c, 8) for c in ("accuracy", "precision", "recall", "f1")})


@query("holdout_auc", _HELD_OUT + """,
    r AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS rk FROM judged),
    t AS (SELECT sum(rk) FILTER (y = 1) AS ranks, CAST(sum(y) AS DOUBLE) AS n1, CAST(sum(1 - y) AS DOUBLE) AS n0 FROM r)
SELECT round((ranks - n1 * (n1 + 1) / 2) / (n1 * n0), 8) AS auc FROM t""")
def holdout_auc(spark, sf):
    area = pipeline.evaluate_ranking(*_held_out(spark, sf))
    return area.withColumn("auc", F.round("auc", 8))


@query("chi_square_wide", """
WITH r AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1),
    c AS (SELECT l_linestatus AS s, count(*) AS n FROM lineitem GROUP BY 1),
    o AS (SELECT l_orderkey AS k, l_linestatus AS s, count(*) AS n FROM lineitem GROUP BY 1, 2),
    cells AS (SELECT r.k, c.s, coalesce(o.n, 0) AS n, r.n * c.n / (SELECT count(*) FROM lineitem)::DOUBLE AS e
              FROM r CROSS JOIN c LEFT JOIN o ON o.k = r.k AND o.s = c.s)
SELECT 'l_orderkey' AS variable, round(sum((n - e) * (n - e) / e), 3) AS statistic,
       CAST((count(DISTINCT k) - 1) * (count(DISTINCT s) - 1) AS BIGINT) AS dof FROM cells""")
def chi_square_of_a_wide_column(spark, sf):
    """A column with about as many categories as orders."""
    found = chi_square_stat(read_table(spark, sf, "lineitem"), ["l_orderkey"], "l_linestatus")
    return found.select("variable", F.round("statistic", 3).alias("statistic"), "dof")


@query("chi_square_many_labels", """
WITH l AS (SELECT l_linenumber AS k, l_partkey AS s FROM lineitem),
    r AS (SELECT k, count(*) AS n FROM l GROUP BY 1), c AS (SELECT s, count(*) AS n FROM l GROUP BY 1), o AS (SELECT k, s, count(*) AS n FROM l GROUP BY 1, 2),
    cells AS (SELECT r.k, c.s, coalesce(o.n, 0) AS n, r.n * c.n / (SELECT count(*) FROM l)::DOUBLE AS e
              FROM r CROSS JOIN c LEFT JOIN o ON o.k = r.k AND o.s = c.s)
SELECT 'l_linenumber' AS variable, round(sum((n - e) * (n - e) / e), 4) AS statistic,
       CAST((count(DISTINCT k) - 1) * (count(DISTINCT s) - 1) AS BIGINT) AS dof FROM cells""")
def chi_square_many_labels(spark, sf):
    """A target of as many labels as there are parts sold."""
    found = chi_square_stat(read_table(spark, sf, "lineitem"), ["l_linenumber"], "l_partkey")
    return found.withColumn("statistic", F.round("statistic", 4))


@query("contingency_cells", """
SELECT 'l_tax' AS variable, CAST(l_tax AS VARCHAR) AS category, l_suppkey AS label, count(*) AS n FROM lineitem GROUP BY 2, 3""")
def contingency_of_suppliers(spark, sf):
    return contingency_cells(read_table(spark, sf, "lineitem"), ["l_tax"], "l_suppkey")


@query("foreign_targets", "SELECT o_orderstatus AS target, count(*) AS n FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1")
def unknown_order_targets(spark, sf):
    spec = replace(RATE_SPEC, label_order=("F", "O"), dropped_labels=())
    return pipeline.foreign_targets(pipeline.clean(read_table(spark, sf, "orders"), spec), spec)


@query("padded_contradictions", """
SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag <> 'N' AND NOT (l_returnflag = 'A' AND l_discount = 0)""")
def padded_contradictions(spark, sf):
    """Targets with blanks around them: a contradictory row goes all the same."""
    spec = FeatureSpec(keys=("l_orderkey", "l_linenumber"), target="l_returnflag", label_order=("A", "N", "R"), positive_label="A",
                       dropped_labels=("N",), contradictions=("l_discount = 0 AND l_returnflag = 'A'",))
    lines = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_discount", F.concat(F.lit("  "), "l_returnflag", F.lit(" ")).alias("l_returnflag"))
    return pipeline.labelled_rows(pipeline.clean(lines, spec), spec).select("l_orderkey", "l_linenumber", "l_returnflag")


def _dated_orders(spark, sf):
    """Orders with status P as the rows that wait for a label."""
    return read_table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        F.to_date("o_orderdate").alias("day"))


def _base_and_new(spark, sf):
    orders = _dated_orders(spark, sf)
    return orders.filter(F.col("day") < MARK), orders.filter(F.col("day") >= MARK)


@query("retrain_gate", f"""
SELECT count(*) AS n_new, count(*) > 0 AS retrain, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS next_mark
FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '{MARK}' AND o_orderstatus <> 'P'""")
def retrain_gate(spark, sf):
    return jobs.retrain_gate(_dated_orders(spark, sf), "o_orderstatus", "day", MARK)


@query("union_labelled", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'")
def union_labelled(spark, sf):
    base, new = _base_and_new(spark, sf)
    both = jobs.append_by_name(base, new.select("day", "o_orderstatus", "o_orderkey", "o_orderpriority"))
    return both.filter(F.col("o_orderstatus").isNotNull()).select("o_orderkey", "o_orderstatus")


@query("retrained_scores", _RATE_SCORES)
def retrained_scores(spark, sf):
    """Version 1 from the older orders, version 2 once the newer ones are in."""
    base, new = _base_and_new(spark, sf)
    root = fresh_path(spark, "versions")
    jobs.train_initial(base, RATE_SPEC, root)
    jobs.retrain_if_new(base, new, RATE_SPEC, root, order="day")
    model = jobs.load_latest(spark, root)
    return rounded(pipeline.score(pipeline.clean(read_table(spark, sf, "orders"), RATE_SPEC), model))


@query("model_registry", f"""
SELECT 1 AS version, 'initial' AS source, NULL::VARCHAR AS high_water, count(*) AS n_labelled
FROM orders WHERE o_orderstatus <> 'P' AND CAST(o_orderdate AS DATE) < DATE '{MARK}'
UNION ALL
SELECT 2, 'retrain', (SELECT CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) FROM orders WHERE o_orderstatus <> 'P'), count(*)
FROM orders WHERE o_orderstatus <> 'P'""")
def model_registry(spark, sf):
    """The same two trainings, and a third call that finds nothing new."""
    base, new = _base_and_new(spark, sf)
    root = fresh_path(spark, "versions")
    jobs.train_initial(base, RATE_SPEC, root)
    jobs.retrain_if_new(base, new, RATE_SPEC, root, order="day")
    jobs.retrain_if_new(base, new, RATE_SPEC, root, order="day")
    return jobs.registry(spark, root).select("version", "source", "high_water", "n_labelled")


@query("scored_new_rows", _RATES + """
SELECT o_orderkey, round(p, 5) AS p_positive, round(1 - p, 5) AS p_negative, CASE WHEN p > 0.5 THEN 'F' ELSE 'O' END AS prediction
FROM orders JOIN rates USING (o_orderpriority)
WHERE o_orderstatus = 'P' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def scored_new_rows(spark, sf):
    """Unlabelled orders; an order with lines counts as scored already."""
    _, model = rate_model(spark, sf)
    done = read_table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key"))
    return rounded(jobs.score_new(_dated_orders(spark, sf), model, done, "o_orderkey"))


def binary_embeddings(spark, sf):
    """The ten-class table as a two-class one, each vector position a number, and its spec. The
    vectors are taken at the length of the longest; a shorter one lacks numbers and is left out."""
    table = read_table(spark, sf, "embeddings")
    width = table.agg(F.max(F.size("embedding"))).head()[0] or 0
    numbers = [F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(width)]
    spec = FeatureSpec(keys=("vec_id",), target="half", label_order=("low", "high"), positive_label="high",
                       numeric=tuple(f"e{i}" for i in range(width)))
    return table.select("vec_id", F.when(F.col("label") < 5, "low").otherwise("high").alias("half"), *numbers), spec


@query("scored_embeddings")
def scored_embeddings(spark, sf):
    table, spec = binary_embeddings(spark, sf)
    return pipeline.score(table, pipeline.train(table, spec))


@query("embedding_auc")
def embedding_auc(spark, sf):
    table, spec = binary_embeddings(spark, sf)
    scored = pipeline.score(table, pipeline.train(table, spec), ["half"])
    return roc_auc(scored.withColumn("label", (F.col("half") == "high").cast("double")), "p_positive")
