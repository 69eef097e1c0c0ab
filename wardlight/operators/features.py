"""Stateless ML stages: schema alignment and derived clinical features."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlight.config import MEDICATIONS
from wardlight.functions import clinical
from wardlight.functions.icd9 import DIABETES, icd9_category


def _param(name: str, doc: str, converter) -> Param:
    return Param(Params._dummy(), name, doc, converter)


class SchemaAligner(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Give a scoring table the columns and types the model was trained on.

    Absent columns become NULL; other columns (ids, times) pass through.
    """

    schemaJson = _param("schemaJson", "schema of the training columns", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, schemaJson: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    @classmethod
    def of(cls, schema: T.StructType) -> "SchemaAligner":
        bare = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
        return cls(schemaJson=bare.json())

    def expected(self) -> T.StructType:
        import json

        return T.StructType.fromJson(json.loads(self.getOrDefault(self.schemaJson)))

    def _transform(self, df: DataFrame) -> DataFrame:
        wanted = {}
        for field in self.expected().fields:
            if field.name not in df.columns:
                wanted[field.name] = F.lit(None).cast(field.dataType)
            elif df.schema[field.name].dataType != field.dataType:
                wanted[field.name] = clinical.quoted(field.name).cast(field.dataType)
        return df.withColumns(wanted) if wanted else df


class EncounterFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Add the derived features whose source columns are present.

    n_med_prescribed, n_med_changed; prior_healthcare_use; diag_N_cat;
    has_circulatory_comorb, has_respiratory_comorb, has_diabetes_diag (from
    the second and third diagnosis); A1C_measured, glu_measured; change_flag,
    diabetesMed_flag. One projection, no Python rows, no state.
    """

    medications = _param("medications", "medication columns", TypeConverters.toListString)
    nullMed = _param("nullMed", "what an unknown medication counts as", TypeConverters.toString)
    priorWeights = _param(
        "priorWeights", "weights of outpatient, emergency and inpatient visits",
        TypeConverters.toListFloat,
    )
    changeValue = _param("changeValue", "value of change that means yes", TypeConverters.toString)
    dropOriginals = _param(
        "dropOriginals", "drop the medication columns", TypeConverters.toBoolean
    )

    @keyword_only
    def __init__(
        self, *, medications: list[str] = list(MEDICATIONS), nullMed: str = "prescribed",
        priorWeights: list[float] = [1.0, 2.0, 3.0], changeValue: str = "Ch",
        dropOriginals: bool = False,
    ):
        super().__init__()
        self._setDefault(
            medications=list(MEDICATIONS), nullMed="prescribed", priorWeights=[1.0, 2.0, 3.0],
            changeValue="Ch", dropOriginals=False,
        )
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        have = set(df.columns)
        new = {}
        meds = [m for m in self.getOrDefault(self.medications) if m in have]
        if meds:
            new["n_med_prescribed"] = clinical.medications_prescribed(
                meds, self.getOrDefault(self.nullMed)
            )
            new["n_med_changed"] = clinical.medications_changed(meds)

        earlier = ("number_outpatient", "number_emergency", "number_inpatient")
        if have.issuperset(earlier):
            weights = dict(zip(earlier, self.getOrDefault(self.priorWeights)))
            new["prior_healthcare_use"] = clinical.prior_use(weights)

        diagnoses = [c for c in ("diag_1", "diag_2", "diag_3") if c in have]
        categories = {f"{c}_cat": icd9_category(F.col(c)) for c in diagnoses}

        for source, flag in (("A1Cresult", "A1C_measured"), ("max_glu_serum", "glu_measured")):
            if source in have:
                new[flag] = clinical.lab_measured(F.col(source))
        yes = {
            "change": ("change_flag", self.getOrDefault(self.changeValue)),
            "diabetesMed": ("diabetesMed_flag", "Yes"),
        }
        for source, (flag, value) in yes.items():
            if source in have:
                new[flag] = clinical.equals_flag(F.col(source), value)

        out = df.withColumns(categories | new) if categories or new else df
        secondary = [F.col(f"{c}_cat") for c in diagnoses if c != "diag_1"]
        if secondary:
            out = out.withColumns({
                "has_circulatory_comorb": clinical.any_equals(secondary, "Circulatory"),
                "has_respiratory_comorb": clinical.any_equals(secondary, "Respiratory"),
                "has_diabetes_diag": clinical.any_equals(secondary, DIABETES),
            })
        if self.getOrDefault(self.dropOriginals):
            out = out.drop(*meds)
        return out
