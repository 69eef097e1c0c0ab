"""Scoring of records, batch or stream, with a fitted pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlight.config import NULL_TOKENS
from wardlight.functions.clinical import predicted
from wardlight.operators.features import SchemaAligner
from wardlight.operators.models import positive_score
from wardlight.sources.encounters import align_to_schema, normalize_nulls

IDS = ("encounter_id", "patient_nbr", "label", "fold", "split", "race", "age", "gender")


def expected_schema(model: PipelineModel) -> T.StructType:
    """The input columns the model was trained on."""
    for stage in model.stages:
        if isinstance(stage, SchemaAligner):
            return stage.expected()
    raise ValueError("the pipeline has no SchemaAligner stage")


def predict_risk(
    model: PipelineModel, records: DataFrame, threshold: float = 0.5,
    keep: Sequence[str] = IDS, tokens: Sequence[str] = NULL_TOKENS,
) -> DataFrame:
    """Add nothing but ``score`` and ``y_pred`` to the kept columns.

    Absent input columns are NULL (and imputed), other columns are ignored,
    and missing-value spellings mean the same as in training. Narrow: no
    shuffle, and the same on a streaming table.
    """
    schema = expected_schema(model)
    kept = [c for c in keep if c in records.columns]
    # A kept column that is a model input is normalised like the others.
    carried = [c for c in kept if c not in schema.names]
    aligned = align_to_schema(normalize_nulls(records, tokens, keep=carried), schema, kept)
    scored = model.transform(aligned).withColumn("score", positive_score())
    return scored.select(
        *kept, "score", predicted(F.col("score"), threshold).alias("y_pred")
    )
