"""CSV and Parquet input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, infer: bool = False
) -> DataFrame:
    """CSV with a header line. Without a schema every column is a string; ``infer`` costs
    one more pass over the files and is off unless asked for."""
    reader = spark.read.option("header", True)
    if schema is not None:
        # the header is checked against the schema by name, so a reordered file is refused
        return reader.schema(schema).option("enforceSchema", False).csv(path)
    return reader.option("inferSchema", infer).csv(path)


BAD_ROW = "_bad_row"


def read_csv_checked(spark: SparkSession, path: str, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """The rows of a CSV whose cells all fit the schema, and the quarantine: the text of every
    other row, in ``malformed_text``."""
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = (spark.read.option("header", True).option("enforceSchema", True).option("columnNameOfCorruptRecord", BAD_ROW)
            .schema(StructType([*wanted.fields, StructField(BAD_ROW, StringType())])).csv(path))
    bad = rows.filter(F.col(BAD_ROW).isNotNull()).select(F.col(BAD_ROW).alias("malformed_text"), *wanted.fieldNames())
    return rows.filter(F.col(BAD_ROW).isNull()).drop(BAD_ROW), bad


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
