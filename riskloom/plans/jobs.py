"""Train, retrain when new labelled rows came in, score what has no score yet.

Every model version is a folder; a registry row, written after it, is what makes the version
count. A job that dies between the two leaves an unregistered folder, which the next run
overwrites.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskloom.functions.casts import strip
from riskloom.functions.labels import is_labelled
from riskloom.operators.decode import decode_messages, well_formed
from riskloom.operators.features import train_test
from riskloom.operators.shape import append_by_name
from riskloom.plans import ledger
from riskloom.plans.pipeline import (
    RiskModel,
    clean,
    evaluate_labels,
    evaluate_ranking,
    key_names,
    known_targets,
    score,
    target_name,
    train,
    training_rows,
    unlabelled_rows,
)
from riskloom.session import materialise
from riskloom.sources.messages import count_by_topic, encode_rows, route_by_target
from riskloom.sources.scores import read_scores, score_messages, unscored, write_scores
from riskloom.sources.tables import read_csv_checked
from riskloom.spec import FeatureSpec

REGISTRY = ("version int, path string, high_water string, n_labelled bigint, source string, created timestamp, "
            "n_new bigint, n_trained bigint, iterations int, objective double, fit string, accuracy double, auc double")


def registry(spark: SparkSession, root: str) -> DataFrame:
    """One row per model version; empty before the first."""
    try:
        return spark.read.schema(REGISTRY).json(f"{root}/registry/*")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], REGISTRY)


def latest_version(spark: SparkSession, root: str):
    """The newest registry row, or None. The registry has one small row per training."""
    return registry(spark, root).orderBy(F.desc("version")).first()


def load_latest(spark: SparkSession, root: str) -> RiskModel:
    row = latest_version(spark, root)
    if row is None:
        raise LookupError(f"no model version under {root}")
    return RiskModel.load(spark, row["path"])


def high_water(df: DataFrame, target: str, order: str) -> tuple[str | None, int]:
    """Greatest value of ``order`` among the labelled rows, as text, and their count."""
    row = df.filter(is_labelled(F.col(f"`{target}`"))).agg(
        F.max(order).cast("string").alias("mark"), F.count("*").alias("n")).head()
    return row["mark"], row["n"]


def newer_than(df: DataFrame, order: str, mark: str | None) -> DataFrame:
    """Rows beyond the mark; all rows when there is none. The mark is compared in the
    column's own type."""
    if mark is None:
        return df
    return df.filter(F.col(order) > F.lit(mark).cast(df.schema[order].dataType))


def retrain_gate(new: DataFrame, target: str, order: str, mark: str | None, classes: Sequence[str] | None = None) -> DataFrame:
    """One row: labelled rows beyond the mark, whether to retrain, and the next mark. With
    ``classes`` only rows of these count, not those that no training would use."""
    value = F.col(f"`{target}`")
    counts = is_labelled(value) if classes is None else strip(value.cast("string")).isin(*classes)
    fresh = newer_than(new, order, mark).filter(counts)
    return fresh.agg(
        F.count("*").alias("n_new"),
        (F.count("*") > 0).alias("retrain"),
        F.coalesce(F.max(order).cast("string"), F.lit(mark)).alias("next_mark"))


class CurrentModel:
    """The newest registered model under ``root``, loaded when its version first shows up."""

    def __init__(self, root: str):
        self.root = root
        self._loaded: tuple[int, RiskModel] | None = None

    def get(self, spark: SparkSession) -> tuple[int, RiskModel]:
        """Its version and the model; the registry is looked up at every call."""
        row = latest_version(spark, self.root)
        if row is None:
            raise LookupError(f"no model version under {self.root}")
        if self._loaded is None or self._loaded[0] != row["version"]:
            self._loaded = row["version"], RiskModel.load(spark, row["path"])
        return self._loaded


def train_version(
    records: DataFrame, spec: FeatureSpec, root: str, version: int, source: str,
    mark: str | None, n_labelled: int, keep_in_memory: bool = False,
    entries: DataFrame | None = None, evaluate: bool = False, refuse_unsound: bool = False,
) -> RiskModel:
    """Fit, save, write the ledger's ``entries``, then register. Running it again with the same version replaces the same
    folders and registry row.

    The registry row says how the fit ended. ``evaluate`` also fits a twin on the rows of four fifths of the keys, by hash,
    and registers its accuracy and ROC area on the rest. ``refuse_unsound`` fails the job, before anything is
    registered, if the fit did not converge.
    """
    spark = records.sparkSession
    cleaned = clean(records, spec)
    model = train(cleaned, spec, keep_in_memory)
    fit = model.report
    if refuse_unsound and fit.status != "converged":
        raise ArithmeticError(f"version {version} did not converge: {fit.status} after {fit.iterations} steps")
    accuracy = auc = None
    if evaluate:
        keys = [k for k in key_names(spec) if k in cleaned.columns]
        part, rest = train_test(cleaned, keys or cleaned.columns)  # without keys, equal rows stay together
        twin = train(part, spec, keep_in_memory)
        accuracy = evaluate_labels(rest, twin).head()["accuracy"]
        auc = evaluate_ranking(rest, twin).head()["auc"]
    path = f"{root}/models/version={version}"
    model.save(path)
    if entries is not None:
        ledger.commit(entries, root, version)
    n_new = 0 if entries is None else entries.count()
    row = (version, path, mark, n_labelled, source, datetime.now(timezone.utc).replace(tzinfo=None),
           n_new, fit.rows, fit.iterations, fit.objective, fit.status, accuracy, auc)
    (spark.createDataFrame([row], REGISTRY).coalesce(1)
     .write.mode("overwrite").json(f"{root}/registry/v{version:08d}"))
    return model


def train_initial(
    records: DataFrame, spec: FeatureSpec, root: str, keep_in_memory: bool = False, evaluate: bool = False,
) -> RiskModel:
    """Version 1 from the base set. Its ledger is empty: every labelled row that comes later is new to it."""
    n = known_targets(records, spec).count()
    return train_version(records, spec, root, 1, "initial", None, n, keep_in_memory, evaluate=evaluate)


def retrain_from(
    base: DataFrame, rows: DataFrame, spec: FeatureSpec, root: str, source: str, order: str | None,
    min_new: int = 1, keep_in_memory: bool = False, evaluate: bool = False,
) -> RiskModel | None:
    """Train the next version on ``base`` and ``rows`` (of ``ledger.with_entries``, with known targets) when at least ``min_new`` rows
    that train are in no registered version's ledger; otherwise do nothing.

    Whether a row is new is a matter of the ledger alone: late rows, rows at the last mark, rows sent again
    and rows read again by a rebuilt stream each train once. The mark is kept for the record.
    """
    spark = base.sparkSession
    last = latest_version(spark, root)
    trains = training_rows(rows, spec)
    fresh = materialise(ledger.untrained(trains, ledger.committed(spark, root, registry(spark, root))).select(ledger.ENTRY), "ledger-fresh")
    if fresh.count() < min_new:
        return None
    both = append_by_name(base, rows.select(*[F.col(f"`{c}`") for c in base.columns]))
    n = known_targets(both, spec).count()
    mark = rows.agg(F.max(order).cast("string")).head()[0] if order else None
    return train_version(both, spec, root, (last["version"] if last else 0) + 1, source, mark, n, keep_in_memory, fresh, evaluate)


def retrain_if_new(
    base: DataFrame, new: DataFrame, spec: FeatureSpec, root: str, order: str | None,
    min_new: int = 1, keep_in_memory: bool = False, identity: Sequence[str] | None = None, evaluate: bool = False,
) -> RiskModel | None:
    """``retrain_from`` all rows of ``new`` that have a known target. ``identity`` names the columns that tell
    one row from another (default: all)."""
    rows = materialise(ledger.with_entries(known_targets(new, spec), identity), "ledger-rows")
    return retrain_from(base, rows, spec, root, "retrain", order, min_new, keep_in_memory, evaluate)


def publish_and_check(records: DataFrame, transport, topic: str, key: str | None = None, partitions: int | None = None) -> DataFrame:
    """Send a table's rows as messages and compare: one row ``(topic, n_rows, n_messages)``.

    Messages that the topic had before do not count. A difference fails the job.
    """
    spark = records.sparkSession

    def messages() -> int:
        try:
            return transport.read(spark, [topic]).count()
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return 0

    before, rows = messages(), records.count()
    transport.write(encode_rows(records, topic, key=key, partitions=partitions))
    sent = messages() - before
    if sent != rows:
        raise RuntimeError(f"{rows} rows were to be published to {topic}, {sent} messages are there")
    return spark.createDataFrame([(topic, rows, sent)], "topic string, n_rows bigint, n_messages bigint")


def score_new(records: DataFrame, model: RiskModel, done: DataFrame | None, key: str, done_key: str = "key") -> DataFrame:
    """Scores of the unlabelled rows that have none yet."""
    rows = clean(records, model.spec)
    if target_name(model.spec) in rows.columns:
        rows = unlabelled_rows(rows, model.spec)
    if done is not None:
        rows = unscored(rows, done, key, done_key)
    return score(rows, model)


def upload(
    spark: SparkSession, path: str, schema: StructType | str, spec: FeatureSpec, transport, labelled: str, unlabelled: str,
    base: DataFrame, root: str, min_new: int = 1, partitions: int | None = None,
) -> DataFrame:
    """A CSV of records, as far as the next model version: one row ``(n_labelled, n_unlabelled, n_malformed, version)``.

    Rows go to one of two topics by whether their target is filled in; rows whose cells do not fit ``schema`` are
    counted and not sent. Then all labelled messages of the topic, whoever sent them, are decoded and go through
    ``retrain_if_new``, so a file uploaded twice trains once. ``version`` is the newest version afterwards, null if there is none.
    """
    rows, bad = read_csv_checked(spark, path, schema)
    n_bad = materialise(bad, "malformed").count()
    routed = materialise(route_by_target(rows, spec.target, labelled, unlabelled), "upload")
    transport.write(encode_rows(routed, F.col("topic"), rows.columns, partitions=partitions))
    sent = {r["topic"]: r["n"] for r in count_by_topic(routed).collect()}  # two topics
    if sent.get(labelled):
        decoded = decode_messages(transport.read(spark, [labelled]), rows.columns, spec.integer_fields, spec.double_fields)
        typed = well_formed(decoded).select(*[F.col(f"`{c}`").cast(base.schema[c].dataType) for c in base.columns])
        retrain_if_new(base, typed, spec, root, None, min_new)
    last = latest_version(spark, root)
    return spark.createDataFrame(
        [(sent.get(labelled, 0), sent.get(unlabelled, 0), n_bad, last["version"] if last else None)],
        "n_labelled bigint, n_unlabelled bigint, n_malformed bigint, version int")


def score_and_publish(
    records: DataFrame, root: str, path: str, transport, topic: str, key: str, shape: Callable[[DataFrame], DataFrame] = lambda scores: scores,
) -> DataFrame:
    """Score the unlabelled records whose ``key`` has no score yet, with the newest version; send the scores to ``topic`` and append them
    to the score table at ``path``. One row ``(version, n_scored)``.

    ``shape`` brings the scores into the form in which they are sent and stored; it must keep ``key``. Messages are sent before the table is written: a job
    that dies in between sends its scores again, and none is lost.
    """
    spark = records.sparkSession
    version, model = CurrentModel(root).get(spark)
    try:
        done = read_scores(spark, path)
    except AnalysisException as missing:
        if not any(reason in str(missing) for reason in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")):
            raise
        done = None  # no table, or one that no score has been written to
    fresh = shape(score_new(records, model, done, key, key)).withColumn("model_version", F.lit(version))
    fresh = materialise(fresh, "scores-to-send")
    transport.write(score_messages(fresh, {c: c for c in fresh.columns}, topic, key))
    write_scores(fresh, path, key)
    return spark.createDataFrame([(version, fresh.count())], "version int, n_scored bigint")
