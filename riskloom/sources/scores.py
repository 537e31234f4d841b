"""Scores: as messages, as a table, and looked up by key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.casts import strip
from riskloom.session import materialise

#: Folders of a table of ``write_scores``, if the writer names no other number; each row's folder
#: names the number it was placed by, so that readers need not know it.
KEY_BUCKETS = 64
#: Bytes of a row group: small enough that a lookup which must read one reads little.
ROW_GROUP_BYTES = 32 << 20


def score_messages(scores: DataFrame, fields: dict[str, str], topic: str, key: str | None = None) -> DataFrame:
    """Scores as messages; ``fields`` maps JSON field to column."""
    payload = F.struct(*[F.col(f"`{column}`").alias(name) for name, column in fields.items()])
    value = F.to_json(payload, {"ignoreNullFields": "false"}).cast("binary")
    keyed = F.col(f"`{key}`").cast("string").cast("binary") if key else F.lit(None).cast("binary")
    return scores.select(keyed.alias("key"), value.alias("value"), F.lit(topic).alias("topic"))


def _bucket(key: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), buckets).cast("int")


def key_index(key: str, row_group_bytes: int = ROW_GROUP_BYTES) -> dict[str, str]:
    """Parquet options that make row groups refuse keys they do not hold. A group with few
    distinct keys refuses by its dictionary, any other by a Bloom filter that Parquet sizes
    to the keys it meets; neither needs their number beforehand."""
    return {
        f"parquet.bloom.filter.enabled#{key}": "true",
        "parquet.bloom.filter.adaptive.enabled": "true",
        "parquet.block.size": str(row_group_bytes),
    }


def write_scores(scores: DataFrame, path: str, key: str, buckets: int = KEY_BUCKETS,
                 row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Append to the scores table, laid out so that one key lives in one folder, sorted and
    indexed by key. The rebalance hint lets Spark split a folder that a hot key makes too large
    for one task."""
    placed = scores.withColumn("key_buckets", F.lit(buckets)).withColumn("key_bucket", _bucket(F.col(key), F.lit(buckets)))
    (placed.hint("rebalance", "key_bucket").sortWithinPartitions("key_bucket", key)
     .write.mode("append").options(**key_index(key, row_group_bytes))
     .partitionBy("key_buckets", "key_bucket").parquet(path))


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def key_equals(df: DataFrame, key: str, wanted: str) -> Column:
    """Text equality with the trimmed key. For a non-text column the first comparison is in
    its own type, which Parquet can prune by; the second keeps '07' apart from 7."""
    text = F.col(key).cast("string") == strip(F.lit(wanted))
    kind = df.schema[key].dataType
    if kind.typeName() == "string":
        return F.col(key) == strip(F.lit(wanted))
    return (F.col(key) == strip(F.lit(wanted)).try_cast(kind)) & text


def lookup(scores: DataFrame, key: str, wanted: str) -> DataFrame:
    """Every score of one key; on a table of ``write_scores`` only one folder is read, or one for
    each number of folders that it was written with, and of it only row groups that may hold
    the key."""
    return lookup_list(scores, key, [wanted])


def lookup_list(scores: DataFrame, key: str, wanted: Sequence[str]) -> DataFrame:
    """Every score of a few keys named one by one, read like ``lookup``. Keys that are many, or
    rows of a table, belong in ``lookup_many``."""
    if not wanted:
        return scores.filter(F.lit(False))
    found = scores.filter(reduce(or_, [key_equals(scores, key, one) for one in wanted]))
    if "key_bucket" in scores.columns:
        places = [F.col("key_bucket") == _bucket(strip(F.lit(one)), F.col("key_buckets")) for one in wanted]
        found = found.filter(reduce(or_, places))
    return found


def _distinct_keys(table: DataFrame, column: str, name: str) -> DataFrame:
    """The distinct keys as a written table. Spark then knows its size, and broadcasts it
    only when small; a join that shuffles reads it straight from its own exchange, which is
    what lets Spark split a hot key on the other side."""
    return materialise(table.select(F.col(column).alias(name)).distinct(), "keys")


def lookup_many(scores: DataFrame, keys: DataFrame, key: str, wanted: str) -> DataFrame:
    """Every score whose ``key`` occurs in column ``wanted`` of ``keys``."""
    return scores.join(_distinct_keys(keys, wanted, key), key, "left_semi")


def _order(columns: Sequence[str]) -> Column:
    """One column is compared as it is, which lets Spark aggregate by hash; several as a
    struct, for which it sorts within each task."""
    return F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)


def latest_per_key(scores: DataFrame, key: str, order: Sequence[str], value: str) -> DataFrame:
    """The newest score per key. ``order`` should end in a unique column, so that there is
    one answer; only one candidate per key and task reaches the shuffle."""
    return scores.groupBy(key).agg(F.max_by(value, _order(order)).alias(value))


def first_per_key(scores: DataFrame, key: str, order: Sequence[str], value: str) -> DataFrame:
    return scores.groupBy(key).agg(F.min_by(value, _order(order)).alias(value))


def attach_scores(identities: DataFrame, scores: DataFrame, key: str, score_key: str) -> DataFrame:
    """Identities with their scores when the two arrive apart, matched by key. A key that many
    rows share is split by the adaptive skew join."""
    return identities.join(scores, F.col(key) == F.col(score_key)).drop(score_key)


def unscored(rows: DataFrame, scores: DataFrame, key: str, score_key: str) -> DataFrame:
    """The rows whose key has no score yet."""
    return rows.join(_distinct_keys(scores, score_key, key), key, "left_anti")
