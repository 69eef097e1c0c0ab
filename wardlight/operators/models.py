"""Classifiers, class weights and the fitted scoring pipeline."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlight.functions.clinical import quoted
from wardlight.operators.encode import Preprocessor, infer_column_groups
from wardlight.operators.features import EncounterFeatures, SchemaAligner
from wardlight.session import Scratch

# Spark's own limit; stands for "no limit".
DEEPEST = 30
# Identifies a learning row, whatever partition it comes in.
ROW_KEY = "row_key"
# Tasks over which the rows of a tree fit are dealt: some for a few thousand rows, then
# as many as ``rows_per_task`` asks for, up to a limit.
FEW_TASKS, FEW_ROWS, MAX_TASKS = 8, 2_000, 200_000
# Weights of tree fits are multiples of this, so that their sums are exact in any order.
WEIGHT_STEP = 2.0 ** -20


def balanced_weights(counts: dict[int, int]) -> dict[int, float]:
    """Weights n / (classes * n_class) from the rows of each class."""
    total = sum(counts.values())
    return {int(k): total / (len(counts) * n) for k, n in counts.items()}


def class_weights(df: DataFrame, label: str = "label") -> dict[int, float]:
    """Balanced weights of a table."""
    rows = df.groupBy(label).agg(F.count("*").alias("n")).collect()
    return balanced_weights({r[label]: r["n"] for r in rows})


def weight_column(weights: dict[int, float], label: str = "label") -> Column:
    chain = F
    for value, weight in weights.items():
        chain = chain.when(F.col(label) == value, F.lit(float(weight)))
    return chain.otherwise(F.lit(1.0))


def logistic_regression(
    weight_total: float, C: float = 1.0, max_iter: int = 1000, tol: float = 1e-4
) -> LogisticRegression:
    """L2 logistic regression whose ``C`` multiplies the summed weighted loss.

    Spark averages the loss, so the same optimum needs 1 / (C * total weight).
    """
    return LogisticRegression(
        regParam=1.0 / (C * weight_total), elasticNetParam=0.0, standardization=False,
        maxIter=max_iter, tol=tol, weightCol="weight",
    )


def random_forest(
    weight_total: float = 1.0, n_estimators: int = 400, max_depth: int | None = None,
    min_samples_leaf: int = 1, max_features: str | float = "sqrt", seed: int = 42,
) -> RandomForestClassifier:
    return RandomForestClassifier(
        numTrees=n_estimators, maxDepth=DEEPEST if max_depth is None else max_depth,
        minInstancesPerNode=min_samples_leaf, featureSubsetStrategy=str(max_features),
        weightCol="weight", seed=seed, maxMemoryInMB=1024,
    )


def boosted_trees(
    weight_total: float = 1.0, n_estimators: int = 400, max_depth: int = 5,
    learning_rate: float = 0.05, subsample: float = 0.8, max_features: str | float = 0.8,
    seed: int = 42,
) -> GBTClassifier:
    return GBTClassifier(
        maxIter=n_estimators, maxDepth=max_depth, stepSize=learning_rate,
        subsamplingRate=subsample, featureSubsetStrategy=str(max_features),
        weightCol="weight", seed=seed,
    )


# Fixed value: weight of a positive row for the boosted trees.
BOOSTED_POSITIVE_WEIGHT = 8.0


@dataclass(frozen=True)
class ModelSpec:
    """A named classifier family; register new ones in ``MODELS``.

    ``positive_weight`` stands in for the balanced weights; a parameter of that name
    replaces it. Fits of a family that draws rows at random (``dealt``) see them in
    partitions and an order that follow from the rows alone.
    """

    name: str
    build: Callable[..., Estimator]
    defaults: dict = field(default_factory=dict)
    positive_weight: float | None = None
    dealt: bool = False
    # Rows worth a task of their own; fewer tasks make small iterative fits quick.
    rows_per_task: int = 12_000

    def weights(
        self, counts: dict[int, int], class_weight: str | None, positive: float | None = None
    ) -> dict[int, float]:
        if class_weight is None:
            return {0: 1.0, 1: 1.0}
        if class_weight != "balanced":
            raise ValueError(f"class_weight: {class_weight!r}")
        positive = positive or self.positive_weight
        return {0: 1.0, 1: float(positive)} if positive else balanced_weights(counts)


class LearningRows:
    """Encoded rows (label, features, row_key) and what all fits on them share.

    One pass counts the classes and, where a ``weight`` column is named, sums it.
    """

    def __init__(self, table: DataFrame, weight: str | None = None) -> None:
        if ROW_KEY not in table.columns:
            table = table.withColumn(ROW_KEY, F.xxhash64(*map(quoted, table.columns)))
        self.table, self.weight = table, weight
        mass = F.sum(weight) if weight else F.count("*")
        rows = table.groupBy("label").agg(
            F.count("*").alias("n"), mass.cast("double").alias("mass")).collect()
        self.counts = {int(r["label"]): r["n"] for r in rows}
        self.mass = {int(r["label"]): r["mass"] for r in rows}
        self.n = sum(self.counts.values())
        self._dealt: dict[int, DataFrame] = {}

    def weighted(
        self, spec: ModelSpec, class_weight: str | None, positive: float | None = None
    ) -> tuple[DataFrame, float]:
        """The rows with their ``weight``, laid out for the family, and the total weight."""
        if self.weight:
            column, total = F.col(self.weight), sum(self.mass.values())
        else:
            weights = spec.weights(self.counts, class_weight, positive)
            column = weight_column(weights)
            total = sum(weights.get(k, 1.0) * n for k, n in self.counts.items())
        if spec.dealt:
            column = F.round(column / WEIGHT_STEP) * WEIGHT_STEP
            return self._deal(spec.rows_per_task).withColumn("weight", column), total
        few = max(1, -(-self.n // spec.rows_per_task))
        return self.table.withColumn("weight", column).coalesce(few), total

    def _deal(self, rows_per_task: int) -> DataFrame:
        """The rows in partitions that are a function of the rows alone."""
        few = min(FEW_TASKS, -(-self.n // FEW_ROWS))
        tasks = min(MAX_TASKS, max(1, few, -(-self.n // rows_per_task)))
        if tasks not in self._dealt:
            dealt = self.table.repartition(tasks, ROW_KEY).sortWithinPartitions(ROW_KEY)
            self._dealt[tasks] = dealt.persist()
        return self._dealt[tasks]

    def release(self) -> None:
        for table in self._dealt.values():
            table.unpersist()
        self._dealt.clear()


MODELS: dict[str, ModelSpec] = {
    "LogReg": ModelSpec("LogReg", logistic_regression, rows_per_task=50_000),
    "RandomForest": ModelSpec("RandomForest", random_forest, dealt=True),
    "BoostedTrees": ModelSpec(
        "BoostedTrees", boosted_trees, positive_weight=BOOSTED_POSITIVE_WEIGHT, dealt=True
    ),
}

NOT_FEATURES = ("encounter_id", "patient_nbr", "label", "group", "fold", "split", "weight")


def feature_columns(
    df: DataFrame, exclude: Sequence[str] = (), skip: Sequence[str] = NOT_FEATURES
) -> dict[str, list[str]]:
    """Numeric and categorical model inputs of a table with derived features.

    ``exclude`` leaves columns (and what is derived from them) out of training
    while they stay in the table for the audit.
    """
    derived = {f"{c}_cat" for c in exclude}
    return infer_column_groups(df.schema, skip={*skip, *exclude, *derived})


def fit_encoder(
    featured: DataFrame, exclude: Sequence[str] = (), min_frequency: int = 10
) -> PipelineModel:
    columns = feature_columns(featured, exclude)
    return Preprocessor(
        numericCols=columns["numeric"], categoricalCols=columns["categorical"],
        minFrequency=min_frequency,
    ).fit(featured)


def learning_rows(encoder: PipelineModel, featured: DataFrame) -> DataFrame:
    """label, features and the key of each row."""
    key = F.xxhash64(*map(quoted, featured.columns))
    return encoder.transform(featured.withColumn(ROW_KEY, key)).select(
        ROW_KEY, "label", "features")


def fit_classifier(
    encoded: DataFrame | LearningRows, spec: ModelSpec, params: dict | None = None,
    class_weight: str | None = "balanced", weight: str | None = None, seed: int = 42,
):
    """Fit one classifier on (features, label), by class or given row weights."""
    options = {**spec.defaults, **(params or {})}
    positive = options.pop("positive_weight", None)
    if spec.name != "LogReg":
        options.setdefault("seed", seed)
    rows = encoded if isinstance(encoded, LearningRows) else LearningRows(encoded, weight)
    try:
        weighted, total = rows.weighted(spec, class_weight, positive)
        return spec.build(total, **options).fit(weighted)
    finally:
        if rows is not encoded:
            rows.release()


def logistic_certificate(
    model, encoded: DataFrame | LearningRows, C: float = 1.0,
    class_weight: str | None = "balanced", tolerance: float = 1e-3,
) -> DataFrame:
    """How far a logistic fit is from its optimum, by one distributed aggregate.

    The gradient of |w|^2 / 2 + C * (sum of weighted log losses) at the fitted
    coefficients is summed over all rows, the negative and the positive residuals
    apart. It is measured against the size the loss part has with all residuals of one
    sign. As the penalty is strongly convex, ``gradient_norm`` also bounds the distance of the
    coefficients to the optimum for this intercept. One row: n_rows, objective, gradient_norm,
    relative_gradient, optimal.
    """
    rows = encoded if isinstance(encoded, LearningRows) else LearningRows(encoded)
    weighted, _ = rows.weighted(MODELS["LogReg"], class_weight)
    y = F.col("label").cast("double")
    scored = model.transform(weighted).withColumn("score", positive_score())
    residual = F.col("weight") * (F.col("score") - y)
    chance = F.when(y == 1, F.col("score")).otherwise(1 - F.col("score"))
    loss = -F.log(F.greatest(chance, F.lit(1e-300)))
    over, under = F.greatest(residual, F.lit(0.0)), F.greatest(-residual, F.lit(0.0))
    features = F.col("features")
    found = scored.agg(
        F.count("*").alias("n"), Summarizer.sum(features, over).alias("over"),
        Summarizer.sum(features, under).alias("under"), F.sum(residual).alias("intercept"),
        F.sum(F.col("weight") * loss).alias("loss"),
        Summarizer.sum(features, F.abs(residual)).alias("size"),
    ).first()
    w = model.coefficients.toArray()
    gradient = w + C * (found["over"].toArray() - found["under"].toArray())
    norm = float((gradient @ gradient + (C * found["intercept"]) ** 2) ** 0.5)
    sizes = found["size"].toArray()
    size = float((w @ w) ** 0.5 + C * (sizes @ sizes) ** 0.5)
    objective = float(w @ w / 2 + C * found["loss"])
    return weighted.sparkSession.createDataFrame(
        [(found["n"], objective, norm, norm / size, norm <= tolerance * size)],
        "n_rows long, objective double, gradient_norm double, relative_gradient double, "
        "optimal boolean",
    )


def input_schema(df: DataFrame, skip: Sequence[str] = NOT_FEATURES) -> T.StructType:
    """The columns a scoring record should bring."""
    return T.StructType([f for f in df.schema.fields if f.name not in skip])


def scoring_pipeline(
    schema: T.StructType, features: EncounterFeatures, encoder: PipelineModel, classifier
) -> PipelineModel:
    """Alignment, features, encoders and classifier as one saved unit."""
    return PipelineModel([
        SchemaAligner.of(schema), features, *encoder.stages, classifier
    ])


def fit_pipeline(
    train: DataFrame, model: str = "LogReg", params: dict | None = None,
    features: EncounterFeatures | None = None, exclude: Sequence[str] = (),
    class_weight: str | None = "balanced", min_frequency: int = 10, seed: int = 42,
) -> PipelineModel:
    """Fit the whole pipeline for one model on a table with a ``label``."""
    return fit_pipelines(
        train, [(model, params, class_weight)], features, exclude, min_frequency, seed)[0]


def fit_pipelines(
    train: DataFrame, points: Sequence[tuple[str, dict | None, str | None]],
    features: EncounterFeatures | None = None, exclude: Sequence[str] = (),
    min_frequency: int = 10, seed: int = 42,
) -> list[PipelineModel]:
    """A pipeline per (model, parameters, class weight); rows are encoded once for all."""
    features = features or EncounterFeatures()
    featured = features.transform(train).persist()
    try:
        encoder = fit_encoder(featured, exclude, min_frequency)
        # Iterative fits start from a short lineage: every task of every
        # iteration would otherwise carry the encoders' lookup tables.
        with Scratch(train.sparkSession, "fit") as scratch:
            rows = LearningRows(scratch.store(learning_rows(encoder, featured)))
            try:
                classifiers = [
                    fit_classifier(rows, MODELS[model], params, class_weight, seed=seed)
                    for model, params, class_weight in points
                ]
            finally:
                rows.release()
    finally:
        featured.unpersist()
    schema = input_schema(train)
    return [scoring_pipeline(schema, features, encoder, c) for c in classifiers]


def positive_score(probability: str = "probability") -> Column:
    return vector_to_array(F.col(probability))[1]
