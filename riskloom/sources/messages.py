"""Messages: the envelope schema, transports, encoding, routing, audit.

A transport is Kafka or a folder of Parquet files with the same columns; everything above
it is the same for both.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from riskloom.functions.labels import is_labelled

ENVELOPE_COLUMNS = ("key", "value", "topic", "partition", "offset", "timestamp", "timestampType")
ENVELOPE = ("key binary, value binary, topic string, partition int, offset bigint, "
            "timestamp timestamp, timestampType int")


@dataclass(frozen=True)
class KafkaTransport:
    """Needs the Kafka connector of the running Spark version on the class path."""

    servers: str
    options: Mapping[str, str] = field(default_factory=dict)
    starting_offsets: str = "earliest"
    min_partitions: int | None = None

    def read_options(self, topics: Sequence[str], starting_offsets: str | None = None) -> dict[str, str]:
        options = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": ",".join(topics),
            "startingOffsets": starting_offsets or self.starting_offsets,
        } | dict(self.options)
        if self.min_partitions:
            options["minPartitions"] = str(self.min_partitions)
        return options

    def read(self, spark: SparkSession, topics: Sequence[str], starting_offsets: str | None = None) -> DataFrame:
        return spark.read.format("kafka").options(**self.read_options(topics, starting_offsets)).load()

    def between_options(self, stretches: Sequence[tuple[str, int, int, int]]) -> dict[str, str]:
        """For a read of ``(topic, partition, first offset, last offset)``, both ends included."""
        start: dict[str, dict[str, int]] = {}
        end: dict[str, dict[str, int]] = {}
        for topic, partition, first, last in stretches:
            start.setdefault(topic, {})[str(partition)] = first
            end.setdefault(topic, {})[str(partition)] = last + 1
        options = {k: v for k, v in self.read_options([]).items() if k not in ("subscribe", "startingOffsets")}
        wanted = json.dumps({t: sorted(map(int, ps)) for t, ps in start.items()}, sort_keys=True)
        return options | {"assign": wanted, "startingOffsets": json.dumps(start, sort_keys=True), "endingOffsets": json.dumps(end, sort_keys=True)}

    def read_between(self, spark: SparkSession, stretches: Sequence[tuple[str, int, int, int]]) -> DataFrame:
        if not stretches:
            return spark.createDataFrame([], ENVELOPE)
        return spark.read.format("kafka").options(**self.between_options(stretches)).load()

    def read_stream(self, spark: SparkSession, topics: Sequence[str]) -> DataFrame:
        return spark.readStream.format("kafka").options(**self.read_options(topics)).load()

    def write(self, messages: DataFrame) -> None:
        messages.write.format("kafka").option("kafka.bootstrap.servers", self.servers).options(**self.options).save()

    def write_stream(self, messages: DataFrame, checkpoint: str) -> DataStreamWriter:
        return (messages.writeStream.format("kafka").option("kafka.bootstrap.servers", self.servers)
                .options(**self.options).option("checkpointLocation", checkpoint))


@dataclass(frozen=True)
class FileTransport:
    """Envelope columns as Parquet files, one folder per topic. Offsets count within one
    write; the timestamp tells one write from the next."""

    folder: str

    def read(self, spark: SparkSession, topics: Sequence[str]) -> DataFrame:
        stored = spark.read.schema(ENVELOPE).parquet(self.folder)
        return stored.filter(F.col("topic").isin(*topics)).select(*ENVELOPE_COLUMNS)

    def read_between(self, spark: SparkSession, stretches: Sequence[tuple[str, int, int, int]]) -> DataFrame:
        """Messages of ``(topic, partition, first offset, last offset)``, both ends included."""
        if not stretches:
            return spark.createDataFrame([], ENVELOPE)
        parts = [(F.col("topic") == t) & (F.col("partition") == p) & F.col("offset").between(a, b) for t, p, a, b in stretches]
        return self.read(spark, sorted({t for t, *_ in stretches})).filter(reduce(lambda x, y: x | y, parts))

    def read_stream(self, spark: SparkSession, topics: Sequence[str], **options: str) -> DataFrame:
        stream = spark.readStream.schema(ENVELOPE).options(**options).parquet(self.folder)
        return stream.filter(F.col("topic").isin(*topics)).select(*ENVELOPE_COLUMNS)

    @staticmethod
    def envelope(messages: DataFrame) -> DataFrame:
        """Fill the envelope columns a producer does not set."""
        defaults = {
            "key": F.lit(None).cast("binary"),
            "partition": F.lit(0),
            "offset": F.monotonically_increasing_id(),
            "timestamp": F.current_timestamp(),
            "timestampType": F.lit(0),
        }
        filled = messages.withColumns({n: c for n, c in defaults.items() if n not in messages.columns})
        return filled.select(*ENVELOPE_COLUMNS)

    def write(self, messages: DataFrame) -> None:
        self.envelope(messages).write.mode("append").partitionBy("topic").parquet(self.folder)

    def write_stream(self, messages: DataFrame, checkpoint: str) -> DataStreamWriter:
        columns = [c for c in ("key", "value", "topic", "timestamp") if c in messages.columns]
        return (messages.select(*columns).writeStream.format("parquet").partitionBy("topic")
                .option("path", self.folder).option("checkpointLocation", checkpoint))


def json_value(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """The row as UTF-8 JSON; a null field is written as null, not left out."""
    fields = [F.col(f"`{c}`") for c in columns or df.columns]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).cast("binary")


def encode_rows(
    df: DataFrame, topic: str | Column, columns: Sequence[str] | None = None,
    key: str | None = None, partitions: int | None = None,
) -> DataFrame:
    """Table rows as messages for a transport's ``write``. The executors do the sending;
    ``partitions`` sets how many of them send at once."""
    topic = F.lit(topic) if isinstance(topic, str) else topic
    keyed = F.col(f"`{key}`").cast("string").cast("binary") if key else F.lit(None).cast("binary")
    messages = df.select(keyed.alias("key"), json_value(df, columns).alias("value"), topic.alias("topic"))
    return messages.repartition(partitions) if partitions else messages


def target_topic(target: Column, labelled: str, unlabelled: str) -> Column:
    return F.when(is_labelled(target), labelled).otherwise(unlabelled)


def route_by_target(df: DataFrame, target: str, labelled: str, unlabelled: str) -> DataFrame:
    """Rows with the name of the topic they belong to, by whether the target is filled in."""
    return df.withColumn("topic", target_topic(F.col(f"`{target}`"), labelled, unlabelled))


def count_by_topic(routed: DataFrame) -> DataFrame:
    return routed.groupBy("topic").agg(F.count("*").alias("n"))


def topic_audit(envelope: DataFrame) -> DataFrame:
    return envelope.groupBy("topic", "partition").agg(
        F.count("*").alias("n"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))


#: Offsets of a slice: what one task at most sees of a topic partition when offsets are looked through in order.
SLICE = 1 << 20
_PLACE = ("topic", "partition")
RANGES = "topic string, partition int, first_offset bigint, last_offset bigint"


def _islands(numbers: DataFrame, slice_size: int) -> DataFrame:
    """``(topic, partition, first_offset, last_offset)``: the runs without a hole of distinct (topic, partition, offset).

    Runs are found slice by slice, so no task needs a whole topic partition, of which one may hold most
    messages. Only the runs that reach an end of their slice, two per slice at most, are put together across slices.
    """
    cut = numbers.withColumn("_slice", F.floor(F.col("offset") / slice_size))
    inside = Window.partitionBy(*_PLACE, "_slice").orderBy("offset")
    pieces = (cut.withColumn("_run", F.col("offset") - F.row_number().over(inside)).groupBy(*_PLACE, "_slice", "_run")
              .agg(F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset")))
    touches = (F.col("first_offset") == F.col("_slice") * slice_size) | (F.col("last_offset") == (F.col("_slice") + 1) * slice_size - 1)
    along = Window.partitionBy(*_PLACE).orderBy("first_offset")
    edges = pieces.filter(touches).withColumn(
        "_new", F.coalesce(F.lag("last_offset").over(along) + 1 != F.col("first_offset"), F.lit(True)).cast("int"))
    joined = edges.withColumn("_group", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0))).groupBy(*_PLACE, "_group").agg(
        F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"))
    wanted = [*_PLACE, "first_offset", "last_offset"]
    return pieces.filter(~touches).select(*wanted).unionByName(joined.select(*wanted))


def offset_ranges(envelope: DataFrame, slice_size: int = SLICE) -> DataFrame:
    """The runs of offsets without a hole that a batch of messages holds, per topic partition."""
    return _islands(_offset_counts(envelope), slice_size)


def _offset_counts(envelope: DataFrame) -> DataFrame:
    placed = envelope.filter(F.col("partition").isNotNull() & F.col("offset").isNotNull())
    return placed.groupBy(*_PLACE, "offset").agg(F.count("*").alias("n"))


def offset_faults(envelope: DataFrame, expected: DataFrame | None = None, slice_size: int = SLICE) -> DataFrame:
    """``(topic, partition, fault, first_offset, last_offset)``: the ranges of offsets that are ``missing`` between, and
    those that are ``repeated`` among, the messages of each topic partition.

    ``expected`` (topic, partition, first_offset, last_offset), one row per topic partition, says what should be there: then
    missing ranges before the first message, behind the last one, and of partitions without any message are found as
    well. Messages without partition or offset are left out.
    """
    counts = _offset_counts(envelope)
    cut = counts.withColumn("_slice", F.floor(F.col("offset") / slice_size))
    inside = Window.partitionBy(*_PLACE, "_slice").orderBy("offset")
    holes = cut.select(*_PLACE, F.lag("offset").over(inside).alias("_before"), F.col("offset").alias("_after"))
    # From slice to slice: the last offset of one and the first of the next one that has any.
    ends = cut.groupBy(*_PLACE, "_slice").agg(F.min("offset").alias("_first"), F.max("offset").alias("_last"))
    if expected is not None:
        # What should be there ends in two offsets that count as present, just outside.
        outer = expected.select(*_PLACE, F.inline(F.array(*[
            F.struct(F.floor(edge / slice_size).alias("_slice"), edge.alias("_first"), edge.alias("_last"))
            for edge in (F.col("first_offset") - 1, F.col("last_offset") + 1)])))
        ends = ends.unionByName(outer)
    along = Window.partitionBy(*_PLACE).orderBy("_first", "_last")
    between = ends.select(*_PLACE, F.lag("_last").over(along).alias("_before"), F.col("_first").alias("_after"))
    missing = holes.unionByName(between).filter(F.col("_after") > F.col("_before") + 1).select(
        *_PLACE, F.lit("missing").alias("fault"), (F.col("_before") + 1).alias("first_offset"), (F.col("_after") - 1).alias("last_offset"))
    repeated = _islands(counts.filter(F.col("n") > 1).drop("n"), slice_size)
    return missing.unionByName(repeated.select(*_PLACE, F.lit("repeated").alias("fault"), "first_offset", "last_offset"))


def within_ranges(envelope: DataFrame, ranges: DataFrame, slice_size: int = SLICE) -> DataFrame:
    """The messages whose offset is in one of ``ranges`` (topic, partition, first_offset, last_offset), each once for
    ranges that do not overlap. Ranges are cut at slices, so that messages find theirs by an equal slice."""
    low, high = F.floor(F.col("first_offset") / slice_size), F.floor(F.col("last_offset") / slice_size)
    cut = ranges.select(F.col("topic").alias("_topic"), F.col("partition").alias("_partition"), "first_offset", "last_offset",
                        F.explode(F.sequence(low, high)).alias("_slice"))
    same = ((F.col("topic") == F.col("_topic")) & (F.col("partition") == F.col("_partition"))
            & (F.floor(F.col("offset") / slice_size) == F.col("_slice")) & F.col("offset").between(F.col("first_offset"), F.col("last_offset")))
    return envelope.join(cut, same, "left_semi")


def read_ranges(transport, spark: SparkSession, ranges: DataFrame, slice_size: int = SLICE) -> DataFrame:
    """The messages of exactly these ranges of offsets. The transport is asked for the least stretch of each
    topic partition that holds its ranges, which Kafka reads by position and files prune by."""
    stretch = ranges.groupBy(*_PLACE).agg(F.min("first_offset").alias("first"), F.max("last_offset").alias("last")).collect()  # one per topic partition
    return within_ranges(transport.read_between(spark, [(r["topic"], r["partition"], r["first"], r["last"]) for r in stretch]), ranges, slice_size)


def next_offsets(audit: DataFrame) -> str:
    """The audit as Kafka's ``startingOffsets`` text: read on from behind the last message.
    An audit has one row per topic partition."""
    offsets: dict[str, dict[str, int]] = {}
    for row in audit.select("topic", "partition", "last_offset").collect():
        if row["partition"] is None or row["last_offset"] is None:
            raise ValueError(f"the messages of {row['topic']} carry no partitions and offsets to read on from")
        offsets.setdefault(row["topic"], {})[str(row["partition"])] = row["last_offset"] + 1
    return json.dumps(offsets, sort_keys=True)
