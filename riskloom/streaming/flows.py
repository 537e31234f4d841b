"""Continuous routing, scoring and retraining. Decoding is ``operators.decode``, as in batch.

Each flow takes a streaming DataFrame and returns one, or a writer to start; checkpoints
make every message count once across restarts.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import BinaryType, StructField, StructType

from riskloom.plans import ledger
from riskloom.plans.jobs import CurrentModel, registry, retrain_from
from riskloom.plans.pipeline import RiskModel, clean, known_targets, score, training_rows
from riskloom.session import materialise
from riskloom.sources.messages import encode_rows, target_topic
from riskloom.sources.scores import latest_per_key
from riskloom.spec import FeatureSpec


def score_stream(records: DataFrame, model: RiskModel, keep: Sequence[str] | None = None) -> DataFrame:
    return score(clean(records, model.spec), model, keep)


def route_stream(records: DataFrame, target: Column, labelled: str, unlabelled: str,
                 columns: Sequence[str] | None = None) -> DataFrame:
    """Records as messages addressed to one of two topics by whether the target is there."""
    return encode_rows(records, target_topic(target, labelled, unlabelled), columns)


def latest_score_stream(scores: DataFrame, key: str, order: Sequence[str], value: str) -> DataFrame:
    """Newest score per key; run it in update or complete mode. The state is one row per key."""
    return latest_per_key(scores, key, order, value)


def once(records: DataFrame, identity: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Each message once: of messages equal in ``identity`` the first that comes, as long as they are no more than
    ``delay`` apart in ``event_time``. A message older than the newest one of earlier batches by more than ``delay`` is
    too late and left out; ``unanswered`` names it afterwards. The state is a row per identity of the last ``delay``."""
    return records.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(identity))


def unanswered(received: DataFrame, answered: DataFrame, identity: Sequence[str]) -> DataFrame:
    """The messages, each once, that got no answer: of a stream that ran ``once`` over all of ``received``, those that came too late."""
    return received.dropDuplicates(list(identity)).join(answered.select(*identity).distinct(), list(identity), "left_anti")


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The identity of the stream that owns a checkpoint: the same after a restart, another one
    once the checkpoint was made anew."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").head()[0])["id"]


def score_current_writer(
    records: DataFrame, root: str, out: str, checkpoint: str, keep: Sequence[str] | None = None,
) -> DataStreamWriter:
    """Score every micro-batch with the model that is newest when the batch runs.

    The registry is looked up once per batch, and a model is loaded once per version. Scores go to ``out``
    with the version that made them in ``model_version``, in a folder per stream and batch. A batch that is run again replaces its own folder, so a
    message is scored once, by one version. Without any version the stream fails and the batch waits in its checkpoint.
    """
    current = CurrentModel(root)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version, model = current.get(spark)
        scored = score(clean(batch, model.spec), model, keep).withColumn("model_version", F.lit(version))
        scored.write.mode("overwrite").parquet(f"{out}/run={run_of(spark, checkpoint)}/batch={batch_id}")

    return records.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)


def retrain_writer(
    records: DataFrame, spec: FeatureSpec, root: str, base: DataFrame, order: str, checkpoint: str, min_new: int = 1,
    identity: Sequence[str] | None = None, evaluate: bool = False,
) -> DataStreamWriter:
    """Retrain whenever at least ``min_new`` labelled rows came in that no version was trained on.

    A batch first stores its labelled rows, in a folder per stream and batch, then trains on the base and
    everything stored by any stream, then commits the new rows to the ledger with the version. ``identity`` names
    the columns that make a row what it is (default: all but ``order``, so that a message sent again later is the same row). A batch
    that is run again replaces its own folder and finds its rows in the ledger; a stream whose checkpoint was made anew stores all
    messages once more under its own name, and finds them there too.
    """
    known = list(identity or [c for c in records.columns if c != order])
    stored_schema = StructType([*records.schema.fields, StructField(ledger.ENTRY, BinaryType())])
    store = f"{root}/labelled"

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = run_of(spark, checkpoint)
        path = f"{store}/run={run}/batch={batch_id}"
        ledger.with_entries(known_targets(batch, spec), known).write.mode("overwrite").parquet(path)
        trains = training_rows(spark.read.schema(stored_schema).parquet(path), spec)
        if ledger.untrained(trains, ledger.committed(spark, root, registry(spark, root))).isEmpty():
            return  # what waited before this batch goes on waiting
        stored = spark.read.schema(stored_schema).parquet(store).dropDuplicates([ledger.ENTRY])
        retrain_from(base, materialise(stored, "labelled"), spec, root, f"{run}/{batch_id}", order, min_new, evaluate=evaluate)

    return records.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
