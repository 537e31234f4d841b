import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom.functions.casts import lenient_double, lenient_int, missing_to_null, usable_number, usable_numbers
from riskloom.functions.labels import binary_label, is_labelled, label_index
from riskloom.functions.values import category_slot, percent_text

WHOLE = [
    ("", None), ("Portugal", None), ("1e1", None), ("99999999999", None), ("1.0", 1), ("20.0", 20), (" 7 ", 7),
    ("-3.7", -3), ("+4", 4), ("NaN", None), (".5", 0), ("5.", 5), ("-", None), ("1 2", None), (None, None), ("2147483648", None),
]


def one_column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").coalesce(1)


def applied(df, column):
    return [r[0] for r in df.select(column.alias("out"), "i").orderBy("i").collect()]


def test_lenient_int_table(spark):
    texts, expected = zip(*WHOLE)
    assert applied(one_column(spark, texts), lenient_int(F.col("v"))) == list(expected)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="0123456789+-. e\t", max_size=12), min_size=1, max_size=60))
def test_lenient_casts_equal_the_non_ansi_cast(spark, texts):
    df = one_column(spark, texts)
    whole, number = applied(df, lenient_int(F.col("v"))), applied(df, lenient_double(F.col("v")))
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert whole == applied(df, F.col("v").cast("int"))
        assert number == applied(df, F.col("v").cast("double"))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_missing_marks_and_numbers(spark):
    df = one_column(spark, ["", "  ", "NaN", '"NaN"', " x ", None])
    assert applied(df, missing_to_null(F.col("v"))) == [None, None, None, None, " x ", None]
    numbers = one_column(spark, [1.5, -0.0, float("nan"), float("inf"), float("-inf"), None, 1e308], "double")
    assert applied(numbers, usable_number(F.col("v"))) == [True, True, False, False, False, False, True]
    assert applied(numbers, usable_numbers([F.col("v"), F.lit(1.0)]))[:3] == [True, True, False]
    assert applied(numbers, usable_numbers([])) == [True] * 7


def test_labels(spark):
    df = one_column(spark, ["Dropout", "Enrolled", "Graduate", None, "", "  ", "Other", " Graduate "])
    order = ("Dropout", "Enrolled", "Graduate")
    assert applied(df, is_labelled(F.col("v"))) == [True, True, True, False, False, False, True, True]
    assert applied(df, binary_label(F.col("v"), "Graduate", "Dropout")) == [0.0, None, 1.0, None, None, None, None, 1.0]
    assert applied(df, label_index(F.col("v"), order))[:7] == [0.0, 1.0, 2.0, None, None, None, None]
    assert applied(df, label_index(F.col("v"), order, "keep"))[:7] == [0.0, 1.0, 2.0, 3.0, 3.0, 3.0, 3.0]
    with pytest.raises(Exception, match="unknown label"):
        applied(df, label_index(F.col("v"), order, "error"))


def test_fixed_order_index_equals_the_ml_stage(spark):
    from pyspark.ml.feature import StringIndexerModel

    df = one_column(spark, ["O", "F", "P", None, "F"])
    stage = StringIndexerModel.from_labels(["F", "O"], inputCol="v", outputCol="out").setHandleInvalid("keep")
    assert applied(stage.transform(df), F.col("out")) == applied(df, label_index(F.col("v"), ("F", "O"), "keep"))


def test_slots_and_percent(spark):
    assert applied(one_column(spark, [0, 3, -1, None], "int"), category_slot(F.col("v"))) == [1.0, 4.0, 0.0, 0.0]
    assert applied(one_column(spark, [0.12345, 1.0], "double"), percent_text(F.col("v")))[1] == "100.00%"
