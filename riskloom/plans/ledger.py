"""The ledger: which labelled rows the registered versions were trained on.

A row's entry is a hash of its identity columns, by default its key together with its content, so
a message sent again is the same entry wherever and whenever it arrives, and a corrected record is
a new one. Neither arrival order, nor time marks, nor the batch ids of a checkpoint play a part.

A version's entries are a folder of their own, written before the version is registered. A job that
dies in between leaves a folder that no registered version has, which does not count and is
overwritten by the next run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import materialise

ENTRY = "ledger_entry"
_STORED = f"{ENTRY} binary, version int"


def entry(columns: Sequence[str]) -> Column:
    """128-bit hash of the named columns' text; a null is told apart from every text, and the order
    in which the columns are named does not matter."""
    fields = [F.col(f"`{c}`").cast("string").alias(c) for c in sorted(columns)]
    return F.unhex(F.md5(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})))


def with_entries(records: DataFrame, identity: Sequence[str] | None = None) -> DataFrame:
    """One row per entry: rows equal in ``identity`` (default: in every column) are one row."""
    return records.withColumn(ENTRY, entry(identity or records.columns)).dropDuplicates([ENTRY])


def commit(entries: DataFrame, root: str, version: int) -> None:
    """Store the entries of a version. Doing it again replaces the same folder."""
    entries.select(ENTRY).write.mode("overwrite").parquet(f"{root}/ledger/version={version}")


def committed(spark: SparkSession, root: str, registered: DataFrame) -> DataFrame:
    """``(entry, version)`` of the versions in ``registered``, a row per version; empty before the first."""
    try:
        stored = spark.read.schema(_STORED).parquet(f"{root}/ledger")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], _STORED)
    return stored.join(registered.select("version"), "version", "left_semi").select(ENTRY, "version")


def untrained(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """The rows (of ``with_entries``) that no version of the ledger has.

    The entries asked for are written first, so that Spark knows their number: while they are few
    they are broadcast to the ledger's files, which are read without a shuffle, and only what is
    found there goes against the rows.
    """
    asked = materialise(rows.select(ENTRY), "ledger-asked")
    found = ledger.select(ENTRY).join(asked, ENTRY, "left_semi").distinct()
    return rows.join(found, ENTRY, "left_anti")
