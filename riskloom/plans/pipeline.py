"""From typed records to a fitted, saved and applied scoring pipeline.

Row-wise preparation is a chain of DataFrame expressions driven by the ``FeatureSpec``;
everything with fitted state is one Spark ML ``PipelineModel``. Keys ride along from record
to score.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace
from functools import reduce

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import (
    Imputer,
    ImputerModel,
    OneHotEncoder,
    OneHotEncoderModel,
    StandardScaler,
    StandardScalerModel,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.casts import strip, usable_number, usable_numbers
from riskloom.functions.labels import binary_label, is_labelled
from riskloom.functions.values import vector_element
from riskloom.operators.metrics import classification_metrics, roc_auc
from riskloom.operators.quality import quarantined
from riskloom.operators.shape import (
    add_pair_means,
    drop_by_pattern,
    normalise_names,
    normalised_name,
    rename_columns,
    without_contradictions,
)
from riskloom.plans import categories, wide
from riskloom.plans.categories import UNKNOWN_TEXT
from riskloom.plans.categories import slot_name as _slot
from riskloom.session import materialise
from riskloom.spec import FeatureSpec

FEATURES = "features"
LABEL = "label"
#: How many training rows a row stands for, where equal rows are fitted as one.
WEIGHT = "weight"
#: With more slots than this, a model of categories only is fitted by ``wide``, its weights in a table only. Spark ML's fit holds some two
#: dozen vectors of them on the driver, 2 MB each here.
WIDE_SLOTS = 1 << 18


def clean(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Rename, normalise names, trim the target, derive pair means and drop what the model does
    not use."""
    named = normalise_names(rename_columns(df, spec.renames))
    target = target_name(spec)
    if target in named.columns and named.schema[target].dataType.typeName() == "string":
        named = named.withColumn(target, strip(F.col(f"`{target}`")))
    return drop_by_pattern(add_pair_means(named, spec.pairs), spec.drop_patterns, spec.drops)


def key_names(spec: FeatureSpec) -> list[str]:
    return [normalised_name(spec.renames.get(k, k)) for k in spec.keys]


def target_name(spec: FeatureSpec) -> str:
    return normalised_name(spec.renames.get(spec.target, spec.target))


def labelled_rows(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Rows fit for training: a known class that is not dropped and no contradiction. The
    label is 1.0 for the positive class; unlabelled rows never take part."""
    sound = without_contradictions(df, spec.contradictions)
    target = F.col(target_name(spec)).cast("string")
    label = binary_label(target, spec.positive_label, spec.negative_label)
    if spec.foreign_target == "error":
        known = strip(target).isin(*spec.label_order) | ~is_labelled(target)
        label = F.when(known, label).otherwise(F.raise_error(F.concat(F.lit("unknown target: "), target)).cast("double"))
    return sound.withColumn(LABEL, label).filter(F.col(LABEL).isNotNull())


def training_rows(records: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The raw records, all columns as they are, that training would use."""
    kept = records.withColumn("_raw", F.struct("*"))
    return labelled_rows(clean(kept, spec), spec).select("_raw.*")


def known_targets(records: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The raw records whose target, without blanks around it, is a label of the spec."""
    return records.filter(F.coalesce(strip(F.col(f"`{spec.target}`").cast("string")).isin(*spec.label_order), F.lit(False)))


def unlabelled_rows(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    return df.filter(~is_labelled(F.col(target_name(spec))))


def _vector(c: str) -> str:
    return f"{c}_vec"


def model_columns(df: DataFrame, spec: FeatureSpec, keep: Sequence[str]) -> DataFrame:
    """The columns that a model reads: values of the categories, and numbers. Rows
    with a number the model cannot take are left out, or get a null there to be imputed."""
    numbers = [F.col(f"`{c}`").cast("double") for c in spec.numeric]
    if spec.bad_numeric == "impute":
        numbers = [F.when(usable_number(n), n) for n in numbers]
    else:
        df = df.filter(usable_numbers(numbers))
    values = [*map(categories.code_value, spec.categorical), *map(categories.word_value, spec.text_categorical)]
    named = [n.alias(name) for n, name in zip(numbers, _num(spec))]
    return df.select(*[F.col(f"`{c}`") for c in keep], *values, *named)


def _num(spec: FeatureSpec) -> list[str]:
    return [f"{c}_num" for c in spec.numeric]


def stages(spec: FeatureSpec) -> list:
    """Unfitted stages, over slots and numbers: encode, assemble, standardise, regress.

    ``standardise='numbers'`` centres and scales the numbers and leaves the one-hot block as
    sparse zeros and ones. ``'all'`` centres and scales both, which makes every vector dense.
    The unregularised fit has the same optimum either way: it scales its input itself, and
    the intercept takes up any shift.
    """
    plan: list = []
    slotted = [*spec.categorical, *spec.text_categorical]
    blocks = [_vector(c) for c in slotted]
    if slotted:
        plan.append(OneHotEncoder(inputCols=[_slot(c) for c in slotted], outputCols=blocks, handleInvalid="keep"))
    if spec.numeric and spec.bad_numeric == "impute":
        plan.append(Imputer(inputCols=_num(spec), outputCols=_num(spec), strategy="mean"))
    if spec.standardise == "all":
        plan.append(VectorAssembler(inputCols=[*blocks, *_num(spec)], outputCol="raw_features"))
        plan.append(StandardScaler(inputCol="raw_features", outputCol=FEATURES, withStd=True, withMean=True))
    else:
        if spec.numeric:
            plan.append(VectorAssembler(inputCols=_num(spec), outputCol="raw_numbers"))
            plan.append(StandardScaler(inputCol="raw_numbers", outputCol="numbers", withStd=True, withMean=True))
        plan.append(VectorAssembler(inputCols=[*blocks, *(["numbers"] if spec.numeric else [])], outputCol=FEATURES))
    plan.append(LogisticRegression(
        featuresCol=FEATURES, labelCol=LABEL, maxIter=spec.max_iter, tol=spec.tolerance,
        aggregationDepth=spec.aggregation_depth, **({"weightCol": WEIGHT} if weighted(spec) else {})))
    return plan


def weighted(spec: FeatureSpec) -> bool:
    """Whether equal training rows are fitted as one that has their number as its weight: where there are only categories, of
    which rows agree often. The imputer and the scaler know no weights."""
    return not spec.numeric and spec.standardise != "all"


def counted(rows: DataFrame, spec: FeatureSpec) -> int:
    """The number of training rows, after a look that both classes occur."""
    weight = F.col(WEIGHT).cast("long") if weighted(spec) else F.lit(1).cast("long")
    found = rows.agg(*[F.coalesce(F.sum(F.when(F.col(LABEL) == label, weight)), F.lit(0)).alias(name)
                       for name, label in (("n_positive", 1.0), ("n_negative", 0.0))]).head()
    for label, n in ((spec.positive_label, found["n_positive"]), (spec.negative_label, found["n_negative"])):
        if n == 0:
            raise ValueError(f"no usable training row has label {label!r}")
    return found["n_positive"] + found["n_negative"]


def slotted_rows(rows: DataFrame, spec: FeatureSpec, table: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """``model_columns`` with the categories' slots in place of their values. How many slots there are is noted on
    each slot column, so that the encoder need not look."""
    encoded = categories.encode(rows, table, spec.categorical, spec.text_categorical, sizes)
    noted = {_slot(c): {"ml_attr": {"type": "nominal", "num_vals": n}} for c, n in zip([*spec.categorical, *spec.text_categorical], sizes)}
    return encoded.select(*[F.col(f"`{c}`").alias(c, metadata=noted[c]) if c in noted else F.col(f"`{c}`") for c in encoded.columns])


@dataclass(frozen=True)
class FitReport:
    """How a fit went: rows it used, steps of the optimiser, the objective it ended at, and its
    judgement of the steps: ``converged``, ``iteration limit``, or ``stalled``, where the last step
    still gained much and yet none followed."""

    rows: int
    iterations: int
    objective: float
    status: str

    @classmethod
    def of(cls, rows: int, history: Sequence[float], spec: FeatureSpec) -> FitReport:
        steps = len(history) - 1
        gain = abs(history[-2] - history[-1]) / max(abs(history[-1]), 1e-300) if steps > 0 else 0.0
        if gain <= max(10 * spec.tolerance, 1e-7):
            status = "converged"
        else:
            status = "iteration limit" if steps >= spec.max_iter else "stalled"
        return cls(rows, steps, float(history[-1]), status)


@dataclass(frozen=True)
class TableRegression:
    """The regression of a model whose weights are in its table only: what is beside them."""

    intercept: float
    #: Slots of each category.
    sizes: list[int]
    #: Each category's weight of the unknown slot, 0 for words; a value not seen in training weighs nothing.
    unknown: list[float]

    @property
    def numFeatures(self) -> int:  # noqa: N802 - as Spark ML's models have it
        return sum(self.sizes)


@dataclass(frozen=True)
class RiskModel:
    spec: FeatureSpec
    #: Without stages where ``wide`` is set.
    fitted: PipelineModel
    #: The categories' values with their slots and weights (``categories.SCHEMA``).
    table: DataFrame
    #: Of a model that was just fitted; a loaded one has its report in the registry.
    report: FitReport | None = None
    wide: TableRegression | None = None

    def stage(self, kind: type):
        """The fitted stage of a kind, or None; the plan has at most one of each."""
        return next((s for s in self.fitted.stages if isinstance(s, kind)), None)

    @property
    def regression(self) -> LogisticRegressionModel | TableRegression:
        return self.wide or self.fitted.stages[-1]

    def save(self, path: str) -> None:
        self.fitted.write().overwrite().save(f"{path}/stages")
        self.table.write.mode("overwrite").parquet(f"{path}/categories")
        spark = SparkSession.active()
        lines = [self.spec.to_json(), *([json.dumps(asdict(self.wide))] if self.wide else [])]
        spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/spec")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> RiskModel:
        spec, *more = spark.read.text(f"{path}/spec", wholetext=True).head()["value"].strip().split("\n")
        table = spark.read.schema(categories.SCHEMA).parquet(f"{path}/categories")
        return cls(FeatureSpec.from_json(spec), PipelineModel.load(f"{path}/stages"), table, wide=TableRegression(**json.loads(more[0])) if more else None)


def train(cleaned: DataFrame, spec: FeatureSpec, keep_in_memory: bool = False) -> RiskModel:
    """Fit on the labelled rows of a cleaned table.

    The fit reads its input a few times: row counts, category values, moments, and the
    regression's own read. The pruned columns are held for that, in memory and on disk,
    whatever their number, and dealt out anew, so that few file splits do not leave cores idle.
    ``keep_in_memory`` holds them before that as well, for messages that must be parsed. Where a
    model has only categories, equal rows are counted first, and the fit reads one of each with
    its number as its weight: it has the same optimum, and its steps do not grow with the rows.

    What the driver holds is a few dozen numbers per category value and number, as the regression itself keeps them there. A model of only
    categories with more than ``WIDE_SLOTS`` slots is fitted by ``wide`` instead, to the same optimum; the driver then holds sums.
    """
    rows = model_columns(labelled_rows(cleaned, spec), spec, [LABEL])
    if weighted(spec):
        rows = rows.groupBy(*rows.columns).agg(F.count("*").cast("double").alias(WEIGHT))
    held = [rows.persist(StorageLevel.MEMORY_AND_DISK)] if keep_in_memory or weighted(spec) else []
    try:
        n = counted(rows, spec)
        fitted_rows = rows.count() if weighted(spec) else n
        table = categories.dictionary(rows, spec.categorical, spec.text_categorical) if spec.categorical or spec.text_categorical else None
        sizes = categories.slot_counts(table, spec.categorical, spec.text_categorical) if table else []
        if weighted(spec) and sum(sizes) > WIDE_SLOTS:
            return _fit_wide(rows, spec, table, sizes, n)
        rows = slotted_rows(rows, spec, table, sizes).repartition(_even_parts(rows, fitted_rows)).persist(StorageLevel.MEMORY_AND_DISK)
        held.append(rows)
        fitted = _fit_weighted(rows, spec) if weighted(spec) else Pipeline(stages=stages(spec)).fit(rows)
    finally:
        for one in held:
            one.unpersist()
    report = FitReport.of(n, fitted.stages[-1].summary.objectiveHistory, spec)
    spark = cleaned.sparkSession
    model = RiskModel(spec, fitted, spark.createDataFrame([], categories.SCHEMA), report)
    return replace(model, table=categories.with_weights(table, linear_form(model).blocks)) if table else model


def _fit_weighted(rows: DataFrame, spec: FeatureSpec) -> PipelineModel:
    """The stages fitted one after the other, the regression on vectors in the shared folder. The assembler notes an
    attribute per slot on them, and all later stages' tasks would carry these; only their number stays."""
    *prepare, regression = stages(spec)
    prepared = Pipeline(stages=prepare).fit(rows)
    sizes = [n for s in prepared.stages if isinstance(s, OneHotEncoderModel) for n in s.categorySizes]
    vectors = F.col(FEATURES).alias(FEATURES, metadata={"ml_attr": {"num_attrs": int(sum(sizes))}})
    ready = materialise(prepared.transform(rows).select(LABEL, WEIGHT, vectors), "training-rows")
    return PipelineModel([*prepared.stages, regression.fit(ready)])


def _fit_wide(rows: DataFrame, spec: FeatureSpec, table: DataFrame, sizes: Sequence[int], n: int) -> RiskModel:
    """The model of categories only whose weights never are on the driver."""
    slots = [_slot(c) for c in [*spec.categorical, *spec.text_categorical]]
    encoded = categories.encode(rows, table, spec.categorical, spec.text_categorical, sizes)
    intercept, weights, history = wide.fit(encoded, slots, LABEL, WEIGHT, spec.max_iter, spec.tolerance)
    first = {r["feature"]: r["weight"] for r in weights.where(f"slot = 0 and feature < {len(spec.categorical)}").collect()}  # one per category
    given = materialise(table.join(weights, ["feature", "slot"]).select("feature", "code", "word", "slot", "weight"), "category-weights")
    beside = TableRegression(intercept, list(sizes), [first.get(i, 0.0) for i in range(len(sizes))])
    return RiskModel(spec, PipelineModel([]), given, FitReport.of(n, history, spec), beside)


#: Rows of a part of the training set, where there are enough for every core.
PART_ROWS = 250_000


def _even_parts(rows: DataFrame, n: int) -> int:
    """One part per core and at least one for each PART_ROWS rows, but none of fewer than a
    thousand."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return max(1, min(cores, n // 1000), -(-n // PART_ROWS))


def score(cleaned: DataFrame, model: RiskModel, keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` columns, ``p_positive``, ``p_negative`` and ``prediction`` (the likelier
    label). Rows the model cannot take are left to ``unscorable``.

    A category's value looks up its weight in the model's table, by a join per category; numbers are weighed by one
    expression. No vectors are built, and the number of slots does not matter.
    """
    spec, form = model.spec, linear_form(model)
    keep = list(keep if keep is not None else key_names(spec))
    rows, terms = categories.weigh(model_columns(cleaned, spec, keep), model.table, spec.categorical, spec.text_categorical, form.blocks)
    for name, weight, mean in zip(_num(spec), form.numbers, form.means):
        number = F.col(f"`{name}`")
        terms.append(F.lit(weight) * (number if mean is None else F.coalesce(number, F.lit(mean))))
    margin = reduce(lambda a, b: a + b, terms, F.lit(form.intercept))
    return _as_scores(rows.withColumn("p_positive", 1.0 / (1.0 + F.exp(-margin))), spec, keep)


def score_by_stages(cleaned: DataFrame, model: RiskModel, keep: Sequence[str] | None = None) -> DataFrame:
    """The same through the fitted stages, vectors and all; a model without stages is scored by its table."""
    spec = model.spec
    if model.wide:
        return score(cleaned, model, keep)
    keep = list(keep if keep is not None else key_names(spec))
    encoder = model.stage(OneHotEncoderModel)
    rows = slotted_rows(model_columns(cleaned, spec, keep), spec, model.table, list(encoder.categorySizes) if encoder else [])
    return _as_scores(model.fitted.transform(rows).withColumn("p_positive", vector_element(F.col("probability"), 1)), spec, keep)


def _as_scores(scored: DataFrame, spec: FeatureSpec, keep: Sequence[str]) -> DataFrame:
    likelier = F.when(F.col("p_positive") > 0.5, spec.positive_label).otherwise(spec.negative_label)
    return scored.select(
        *[F.col(f"`{c}`") for c in keep], "p_positive", (1.0 - F.col("p_positive")).alias("p_negative"), likelier.alias("prediction"))


@dataclass(frozen=True)
class LinearForm:
    """A fitted model as sums: the intercept, each category's weights by slot, each number's weight and what
    stands in for it where it is missing (None: nothing does). Standard scores are folded in. Of a model with its weights in
    a table only, the blocks have the ends: the unknown slot's weight, and 0 for the unseen."""

    intercept: float
    blocks: list[list[float]]
    numbers: list[float]
    means: list[float | None]


def linear_form(model: RiskModel) -> LinearForm:
    spec, fit = model.spec, model.regression
    if model.wide:
        return LinearForm(fit.intercept, [[w, 0.0] for w in fit.unknown], [], [])
    weights, intercept = np.array(fit.coefficients.toArray()), float(fit.intercept)
    scaler = model.stage(StandardScalerModel)
    if scaler is not None:
        scaled = weights if spec.standardise == "all" else weights[len(weights) - len(spec.numeric):]
        spread = scaler.std.toArray()
        scaled /= np.where(spread == 0.0, np.inf, spread)  # a constant feature scales to 0
        intercept -= float(scaled @ scaler.mean.toArray())
    encoder, imputer = model.stage(OneHotEncoderModel), model.stage(ImputerModel)
    sizes = list(encoder.categorySizes) if encoder else []
    ends = np.cumsum(sizes, dtype=int).tolist()
    blocks = [weights[end - size:end].tolist() for end, size in zip(ends, sizes)]
    means = imputer.surrogateDF.head().asDict() if imputer else {}
    return LinearForm(intercept, blocks, weights[sum(sizes):].tolist(), [means.get(name) for name in _num(spec)])


def unscorable(cleaned: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The rows ``score`` leaves out, with the columns at fault."""
    if spec.bad_numeric == "impute":
        return cleaned.withColumn("faults", F.lit(None).cast("array<string>")).filter(F.lit(False))
    return quarantined(cleaned, spec.numeric)


def judged(cleaned: DataFrame, model: RiskModel) -> DataFrame:
    """The labelled rows' labels, predictions as labels, and probabilities."""
    return score(labelled_rows(cleaned, model.spec), model, [LABEL]).withColumn(
        "prediction", F.when(F.col("prediction") == model.spec.positive_label, 1.0).otherwise(0.0))


def evaluate_labels(cleaned: DataFrame, model: RiskModel) -> DataFrame:
    """Per-label metrics over the labelled rows; no ranking is run for them."""
    return classification_metrics(judged(cleaned, model))


def evaluate_ranking(cleaned: DataFrame, model: RiskModel) -> DataFrame:
    """The exact area under the ROC curve over the labelled rows."""
    return roc_auc(judged(cleaned, model), "p_positive")


def evaluate(cleaned: DataFrame, model: RiskModel) -> tuple[DataFrame, DataFrame]:
    """``evaluate_labels`` and ``evaluate_ranking``."""
    return evaluate_labels(cleaned, model), evaluate_ranking(cleaned, model)


def foreign_targets(cleaned: DataFrame, spec: FeatureSpec) -> DataFrame:
    """``(target, n)``: targets that are filled in but no label of the spec. They never train; a
    misspelt class shows up here."""
    target = F.col(f"`{target_name(spec)}`").cast("string")
    return cleaned.select(strip(target).alias("target")).filter(
        is_labelled(F.col("target")) & ~F.col("target").isin(*spec.label_order)).groupBy("target").agg(F.count("*").alias("n"))


def coefficients(model: RiskModel, spark: SparkSession) -> DataFrame:
    """``(position, feature, coefficient)``; the intercept has position -1. One row per
    feature slot, all held by the fitted model already, or by its table."""
    fit = model.regression
    if model.wide:
        spec, ends = model.spec, np.cumsum(fit.sizes).tolist()
        slotted = [*spec.categorical, *spec.text_categorical]
        codes = len(spec.categorical)
        rest = [(end - fit.sizes[i] if i < codes else end - 1, f"{c}={UNKNOWN_TEXT if i < codes else '(unseen)'}", fit.unknown[i])
                for i, (c, end) in enumerate(zip(slotted, ends))]
        start = F.array(*[F.lit(end - size) for end, size in zip(ends, fit.sizes)])
        value = F.coalesce(F.col("word"), F.col("code").cast("string"))
        known = model.table.select((F.get(start, F.col("feature")) + F.col("slot")).cast("int").alias("position"), F.concat(
            F.get(F.array(*[F.lit(f"{c}=") for c in slotted]), F.col("feature")), value).alias("feature"), F.col("weight").alias("coefficient"))
        return known.unionByName(spark.createDataFrame([(-1, "(intercept)", fit.intercept), *rest], "position int, feature string, coefficient double"))
    names = feature_names(model)
    rows = [(-1, "(intercept)", float(fit.intercept))]
    rows += [(i, names[i], float(v)) for i, v in enumerate(fit.coefficients.toArray())]
    return spark.createDataFrame(rows, "position int, feature string, coefficient double")


def feature_names(model: RiskModel) -> list[str]:
    """Names of the vector positions, in the order the stages assemble them."""
    spec, encoder = model.spec, model.stage(OneHotEncoderModel)
    names = []
    # As many values as the model has weights.
    known = {(r["feature"], r["slot"]): r["code"] if r["word"] is None else r["word"] for r in model.table.collect()}
    for i, (c, size) in enumerate(zip([*spec.categorical, *spec.text_categorical], encoder.categorySizes if encoder else [])):
        other = UNKNOWN_TEXT if i < len(spec.categorical) else "(unseen)"
        names += [f"{c}={known.get((i, slot), other)}" for slot in range(size)]
    return names + list(spec.numeric)


def contrasts(model: RiskModel) -> DataFrame:
    """``(category, value, contrast)``: the weight of every category value less that of the category's first value.

    The weights of a category are settled only up to a shift that the intercept takes up; their differences are what the
    data determine.
    """
    names = F.array(*[F.lit(c) for c in [*model.spec.categorical, *model.spec.text_categorical]])
    first = model.table.groupBy("feature").agg(F.min_by("weight", "slot").alias("first"))
    return model.table.join(first, "feature").select(
        F.get(names, F.col("feature")).alias("category"), F.coalesce(F.col("word"), F.col("code").cast("string")).alias("value"),
        (F.col("weight") - F.col("first")).alias("contrast"))
