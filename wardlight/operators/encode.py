"""Fitted encoders: median imputation with scaling, and floored one-hot.

Every estimator learns from aggregates of the training rows only. What is
collected is one row per column (numeric) or one per category (checked).
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlight.config import CODE_COLUMNS
from wardlight.functions.clinical import quoted
from wardlight.operators.prefix import ROWS_PER_RANGE, add_ranges, running_totals
from wardlight.session import Scratch, scratch_path

INFREQUENT = "infrequent_sklearn"  # fixed value: name of the pooled column
UNKNOWN = "Unknown"
# Distinct values up to which the built-in exact median may keep its buffer.
MEDIAN_VALUES = 100_000
# Categories, common and rare, that a fitted encoder holds itself; with more, the rare
# ones go to a table that is saved with the model and joined.
INLINE_CATEGORIES = 20_000
# Common categories of all columns: each is an entry of the feature vector.
MAX_COMMON = 1_000_000


def infer_column_groups(
    schema: T.StructType, forced: Sequence[str] = CODE_COLUMNS, skip: Sequence[str] = ()
) -> dict[str, list[str]]:
    """Split columns into numeric and categorical by type.

    Text and the forced code columns are categorical; numbers and booleans
    are numeric; other types (dates, vectors) are in neither.
    """
    groups: dict[str, list[str]] = {"numeric": [], "categorical": []}
    for field in schema.fields:
        if field.name in skip:
            continue
        if field.name in forced or isinstance(field.dataType, T.StringType):
            groups["categorical"].append(field.name)
        elif isinstance(field.dataType, (T.NumericType, T.BooleanType)):
            groups["numeric"].append(field.name)
    return groups


def _number(column: str):
    return F.expr(f"cast(`{column}` as double)")


def exact_medians(
    df: DataFrame, columns: Sequence[str], rows_per_range: int = ROWS_PER_RANGE
) -> dict[str, float | None]:
    """Exact medians (midpoint of the middle two) with no big buffer.

    Values are counted per (column, value) with map-side combine, ranked by
    running totals, and only the middle values are kept.
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias("name"), _number(c).alias("value")) for c in columns
    ])
    long = df.select(F.inline(pairs)).where("value IS NOT NULL AND NOT isnan(value)")
    long = add_ranges(long, "value", rows_per_range)
    keys = [c for c in long.columns]
    counted = long.groupBy(*keys).agg(F.count("*").alias("n"))
    ranked = running_totals(counted, ["value"], {"upto": "n"}, ["name"], {"rows": "n"})
    low, high = F.floor((F.col("rows") + 1) / 2), F.floor(F.col("rows") / 2) + 1
    reaches = lambda place: (F.col("upto") >= place) & (F.col("upto") - F.col("n") < place)
    middle = ranked.groupBy("name").agg(
        ((F.max(F.when(reaches(low), F.col("value")))
          + F.max(F.when(reaches(high), F.col("value")))) / 2).alias("median")
    )
    found = {r["name"]: r["median"] for r in middle.collect()}
    return {c: found.get(c) for c in columns}


def _integral_statistics(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple]:
    """(known rows, mean, variance, median) of whole-number columns.

    One pass over the data counts (column, value) with map-side combine; sums
    over that table are exact decimals.
    """
    exact = T.DecimalType(38, 0)
    pairs = F.array(*[
        F.struct(F.lit(c).alias("name"), quoted(c).cast("long").alias("value"))
        for c in columns
    ])
    counted = df.select(F.inline(pairs)).where("value IS NOT NULL").groupBy("name", "value")
    counted = counted.agg(F.count("*").alias("n")).persist()
    try:
        weighted = F.col("n").cast(exact) * F.col("value")
        rows = counted.groupBy("name").agg(
            F.sum("n").alias("n"), F.sum(weighted.cast(exact)).alias("total"),
            F.sum((weighted * F.col("value")).cast(exact)).alias("squares"),
            F.count("*").alias("distinct"),
        ).collect()
        few = [r["name"] for r in rows if r["distinct"] <= MEDIAN_VALUES]
        many = [r["name"] for r in rows if r["distinct"] > MEDIAN_VALUES]
        # The buffer holds the distinct values of one column: checked above.
        medians = {
            r["name"]: r["median"] for r in counted.where(F.col("name").isin(few))
            .groupBy("name").agg(F.expr("percentile(value, 0.5, n)").alias("median")).collect()
        }
    finally:
        counted.unpersist()
    if many:
        medians.update(exact_medians(df, many))
    found = {}
    for r in rows:
        n, total, squares = r["n"], int(r["total"]), int(r["squares"])
        variance = (n * squares - total * total) / (n * n)
        found[r["name"]] = (n, total / n, variance, medians[r["name"]])
    return found


def _fractional_statistics(
    df: DataFrame, columns: Sequence[str], approximate: bool
) -> dict[str, tuple]:
    """(known rows, mean, variance, median) of other numeric columns.

    One pass for the moments and one for the medians. ``approximate`` takes them
    from a sketch, at any size; else they are exact, by the built-in median where
    distinct values are few and by ranked values elsewhere.
    """
    known = {c: F.nanvl(_number(c), F.lit(None).cast("double")) for c in columns}
    row = df.agg(*[a for i, c in enumerate(columns) for a in (
        F.count(known[c]).alias(f"n{i}"), F.avg(known[c]).alias(f"m{i}"),
        F.var_pop(known[c]).alias(f"v{i}"), F.approx_count_distinct(known[c]).alias(f"d{i}"),
    )]).first()
    few = [
        c for i, c in enumerate(columns) if not approximate and row[f"d{i}"] <= MEDIAN_VALUES
    ]
    many = [c for c in columns if c not in few]
    medians: dict[str, float | None] = {}
    if few:
        medians.update(zip(few, df.agg(*[F.median(known[c]) for c in few]).first()))
    if many and approximate:
        sketch = df.agg(*[F.percentile_approx(known[c], 0.5, 100_000) for c in many]).first()
        medians.update(zip(many, sketch))
    elif many:
        medians.update(exact_medians(df, many))
    return {
        c: (row[f"n{i}"], row[f"m{i}"], row[f"v{i}"], medians[c])
        for i, c in enumerate(columns) if row[f"n{i}"]
    }


def numeric_statistics(
    df: DataFrame, columns: Sequence[str], approximate: bool = False
) -> dict[str, dict]:
    """Per column: median, and mean and population deviation after imputation.

    A column without any known value is left out: there is nothing to impute.
    """
    whole_types = (T.IntegralType, T.BooleanType)
    integral = [c for c in columns if isinstance(df.schema[c].dataType, whole_types)]
    other = [c for c in columns if c not in integral]
    found = {}
    if integral:
        found |= _integral_statistics(df, integral)
    if other:
        found |= _fractional_statistics(df, other, approximate)
    rows = df.count()
    stats = {}
    for c in (c for c in columns if c in found):
        known, mean, variance, median = found[c]
        absent = rows - known
        # Spread of the known part plus that between known part and median.
        spread = (known * variance + known * absent / rows * (mean - median) ** 2) / rows
        stats[c] = {
            "median": float(median), "mean": (known * mean + absent * median) / rows,
            "std": spread ** 0.5,
        }
    return stats


class MedianScaler(
    Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable
):
    """Learn medians, means and population deviations of numeric columns."""

    scale = Param(Params._dummy(), "scale", "standardise", TypeConverters.toBoolean)
    approximate = Param(
        Params._dummy(), "approximate", "sketch medians of wide columns",
        TypeConverters.toBoolean,
    )

    @keyword_only
    def __init__(
        self, *, inputCols: list[str] | None = None, scale: bool = True,
        approximate: bool = False,
    ):
        super().__init__()
        self._setDefault(scale=True, approximate=False)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "MedianScalerModel":
        stats = numeric_statistics(
            df, self.getInputCols(), self.getOrDefault(self.approximate)
        )
        scale = self.getOrDefault(self.scale)
        kept = list(stats)
        return MedianScalerModel(
            inputCols=kept, outputCols=[f"scaled__{c}" for c in kept],
            medians=[stats[c]["median"] for c in kept],
            means=[stats[c]["mean"] if scale else 0.0 for c in kept],
            # a constant column is only centred
            deviations=[(stats[c]["std"] or 1.0) if scale else 1.0 for c in kept],
        )


class MedianScalerModel(
    Model, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable
):
    medians = Param(Params._dummy(), "medians", "per column", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "per column", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "per column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(
        self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None,
        medians: list[float] | None = None, means: list[float] | None = None,
        deviations: list[float] | None = None,
    ):
        super().__init__()
        self._set(**self._input_kwargs)

    def statistics(self) -> list[tuple[str, float, float, float]]:
        return list(zip(
            self.getInputCols(), self.getOrDefault(self.medians),
            self.getOrDefault(self.means), self.getOrDefault(self.deviations),
        ))

    def _transform(self, df: DataFrame) -> DataFrame:
        scaled = {}
        for (name, median, mean, deviation), out in zip(self.statistics(), self.getOutputCols()):
            value = F.coalesce(F.nanvl(_number(name), F.lit(None).cast("double")), F.lit(median))
            scaled[out] = (value - F.lit(mean)) / F.lit(deviation)
        return df.withColumns(scaled) if scaled else df


def _category(column: str):
    return F.expr(f"coalesce(cast(`{column}` as string), '{UNKNOWN}')")


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per (column, category) of all columns, in one shuffle."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), _category(c).alias("category"))
        for c in columns
    ])
    return df.select(F.inline(pairs)).groupBy("column_name", "category").agg(
        F.count("*").alias("n")
    )


def _utf16(text: str) -> bytes:
    return text.encode("utf-16-be")  # the order in which the JVM compares strings


class CategoryFloor(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Learn the categories of each column and which are below the floor.

    Categories with fewer than ``minFrequency`` rows share one pooled column.
    ``unseen`` says what a value not met in training becomes: ``zeros`` (no
    column set) or ``infrequent`` (the pooled column; rare values then need
    not be remembered).

    Fits to an indexer (hash lookup in the JVM) followed by the pooling stage. With
    more than ``inlineCategories`` values only the common ones are in the indexer: the
    rare ones are written as a table, which ``CategoryRare`` joins.
    """

    minFrequency = Param(Params._dummy(), "minFrequency", "row floor", TypeConverters.toInt)
    unseen = Param(Params._dummy(), "unseen", "zeros or infrequent", TypeConverters.toString)
    inlineCategories = Param(
        Params._dummy(), "inlineCategories", "categories kept in the model itself",
        TypeConverters.toInt,
    )

    @keyword_only
    def __init__(
        self, *, inputCols: list[str] | None = None, minFrequency: int = 10,
        unseen: str = "zeros", inlineCategories: int = INLINE_CATEGORIES,
    ):
        super().__init__()
        self._setDefault(minFrequency=10, unseen="zeros", inlineCategories=INLINE_CATEGORIES)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> PipelineModel:
        floor, unseen = self.getOrDefault(self.minFrequency), self.getOrDefault(self.unseen)
        if unseen not in ("zeros", "infrequent"):
            raise ValueError(f"unseen: {unseen!r}")
        names = self.getInputCols()
        counts = category_counts(df, names)
        stored: dict[str, str] = {}
        if unseen == "infrequent":
            # one row per column stands for all its rare values
            rare = F.col("n") < floor
            counts = counts.groupBy(
                "column_name", F.when(rare, None).otherwise(F.col("category")).alias("category")
            ).agg(F.sum("n").alias("n"), F.max(rare).alias("rare"))
            rows = _collect_common(counts)
        else:
            counts = counts.withColumn("rare", F.col("n") < floor)
            inline = self.getOrDefault(self.inlineCategories)
            rows = counts.limit(inline + 1).collect()
            if len(rows) > inline:
                with Scratch(df.sparkSession, "categories") as scratch:
                    counts = scratch.store(counts)
                    rows = _collect_common(counts.where("NOT rare"))
                    stored = _store_rare(counts.where("rare"), names)
        common: dict[str, list[str]] = {c: [] for c in names}
        listed: dict[str, list[str]] = {c: [] for c in names}
        pooled = {c: unseen == "infrequent" or c in stored for c in names}
        for r in rows:
            column = r["column_name"]
            pooled[column] = pooled[column] or r["rare"]
            if not r["rare"]:
                common[column].append(r["category"])
            elif r["category"] is not None:
                listed[column].append(r["category"])
        for c in names:
            common[c].sort(key=_utf16)

        # The indexer orders by frequency, then name: with common values
        # listed twice and rare ones once, the common ones come first.
        entries = {c: common[c] * 2 + listed[c] for c in names}
        height = max(map(len, entries.values()), default=0)
        padded = [entries[c] + [None] * (height - len(entries[c])) for c in names]
        texts = [f"text__{c}" for c in names]
        schema = T.StructType([T.StructField(t, T.StringType()) for t in texts])
        vocabulary = df.sparkSession.createDataFrame(list(zip(*padded)), schema)
        indexer = StringIndexer(
            inputCols=texts, outputCols=[f"index__{c}" for c in names],
            stringOrderType="frequencyDesc", handleInvalid="keep",
        ).fit(vocabulary)
        layout = {
            c: {"common": common[c], "n_rare": len(listed[c]), "pooled": pooled[c],
                "stored": c in stored}
            for c in names
        }
        joined = [CategoryRare(
            inputCols=list(stored), folders=list(stored.values()),
            commons=[len(common[c]) for c in stored],
        )] if stored else []
        return PipelineModel([
            CategoryText(inputCols=names), indexer, *joined,
            CategoryPool(inputCols=names, layoutJson=json.dumps(layout), unseen=unseen),
        ])


def _collect_common(counts: DataFrame) -> list:
    """The categories that become entries of the feature vector."""
    rows = counts.limit(MAX_COMMON + 1).collect()
    if len(rows) > MAX_COMMON:
        raise ValueError(
            f"the feature vector would have more than {MAX_COMMON} entries: raise minFrequency "
            "or leave out id-like columns"
        )
    return rows


def _store_rare(rare: DataFrame, names: Sequence[str]) -> dict[str, str]:
    """Write the rare categories of each column; the folder per column that has some."""
    path = scratch_path(rare.sparkSession, "rare")
    place = F.array_position(F.lit(list(names)), F.col("column_name"))
    rare.select(place.alias("place"), "category").hint("rebalance", "place").write.partitionBy(
        "place").parquet(path)
    found = {r["column_name"] for r in rare.select("column_name").distinct().collect()}
    return {c: f"{path}/place={i}" for i, c in enumerate(names, 1) if c in found}


class _RareWriter(DefaultParamsWriter):
    """Saves the folders of rare categories with the stage."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        for i, table in enumerate(self.instance.tables(self.sparkSession)):
            table.write.parquet(f"{path}/rare/{i}")


class _RareReader(DefaultParamsReader):
    def load(self, path: str) -> "CategoryRare":
        stage = super().load(path)
        return stage._set(folders=[f"{path}/rare/{i}" for i in range(len(stage.getInputCols()))])


class CategoryRare(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """One bit per column: whether the value was seen in training, but rarely.

    Each column's rare values are a stored table, joined by value: Spark broadcasts it
    where its files are small, else both sides are shuffled. A common value needs no
    lookup; its rows are dealt out by hash instead of meeting in one task.
    """

    folders = Param(Params._dummy(), "folders", "per column", TypeConverters.toListString)
    commons = Param(Params._dummy(), "commons", "common values", TypeConverters.toListInt)

    @keyword_only
    def __init__(
        self, *, inputCols: list[str] | None = None, folders: list[str] | None = None,
        commons: list[int] | None = None,
    ):
        super().__init__()
        self._set(**self._input_kwargs)

    def tables(self, spark) -> list[DataFrame]:
        return [
            spark.read.schema("category string").parquet(folder)
            for folder in self.getOrDefault(self.folders)
        ]

    def write(self) -> _RareWriter:
        return _RareWriter(self)

    @classmethod
    def read(cls) -> _RareReader:
        return _RareReader(cls)

    def _transform(self, df: DataFrame) -> DataFrame:
        columns, commons = self.getInputCols(), self.getOrDefault(self.commons)
        spread = F.xxhash64(*[quoted(f"text__{c}") for c in columns]).cast("string")
        for c, n_common, table in zip(columns, commons, self.tables(df.sparkSession)):
            looked_up = quoted(f"index__{c}") >= n_common
            key = F.when(looked_up, quoted(f"text__{c}")).otherwise(spread)
            known = table.select(
                F.col("category").alias("rare__key"), F.lit(True).alias(f"rare__{c}"))
            df = df.join(known, key == F.col("rare__key"), "left").drop("rare__key")
        return df


class CategoryText(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Category columns as text, missing ones as ``Unknown``."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f"text__{c}": _category(c) for c in self.getInputCols()})


class CategoryPool(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Indices to codes with metadata: common values, pooled, then unseen."""

    layoutJson = Param(Params._dummy(), "layoutJson", "learnt layout", TypeConverters.toString)
    unseen = Param(Params._dummy(), "unseen", "zeros or infrequent", TypeConverters.toString)

    @keyword_only
    def __init__(
        self, *, inputCols: list[str] | None = None, layoutJson: str | None = None,
        unseen: str = "zeros",
    ):
        super().__init__()
        self._setDefault(unseen="zeros")
        self._set(**self._input_kwargs)

    def layout(self) -> dict[str, dict]:
        return json.loads(self.getOrDefault(self.layoutJson))

    def codeCols(self) -> list[str]:
        return [f"code__{c}" for c in self.getInputCols()]

    def _transform(self, df: DataFrame) -> DataFrame:
        pool_unseen = self.getOrDefault(self.unseen) == "infrequent"
        codes = []
        for c, mine in self.layout().items():
            index, n_common = quoted(f"index__{c}"), len(mine["common"])
            vals = mine["common"] + ([INFREQUENT] if mine["pooled"] else []) + ["__unseen"]
            code = F.when(index < n_common, index)
            if mine["n_rare"]:
                code = code.when(index < n_common + mine["n_rare"], float(n_common))
            if mine["stored"]:
                code = code.when(quoted(f"rare__{c}"), float(n_common))
            code = code.otherwise(float(n_common if pool_unseen else len(vals) - 1))
            meta = {"ml_attr": {"type": "nominal", "name": c, "vals": vals}}
            codes.append(code.alias(f"code__{c}", metadata=meta))
        helpers = {f"{kind}__{c}" for c in self.getInputCols() for kind in ("text", "index", "rare")}
        return df.select(*[quoted(c) for c in df.columns if c not in helpers], *codes)


class Preprocessor(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Numeric and categorical branch into one sparse ``features`` vector."""

    numericCols = Param(Params._dummy(), "numericCols", "", TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "", TypeConverters.toListString)
    minFrequency = Param(Params._dummy(), "minFrequency", "", TypeConverters.toInt)
    scale = Param(Params._dummy(), "scale", "", TypeConverters.toBoolean)
    unseen = Param(Params._dummy(), "unseen", "", TypeConverters.toString)
    inlineCategories = Param(Params._dummy(), "inlineCategories", "", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self, *, numericCols: list[str] = [], categoricalCols: list[str] = [],
        minFrequency: int = 10, scale: bool = True, unseen: str = "zeros",
        inlineCategories: int = INLINE_CATEGORIES,
    ):
        super().__init__()
        self._setDefault(
            numericCols=[], categoricalCols=[], minFrequency=10, scale=True, unseen="zeros",
            inlineCategories=INLINE_CATEGORIES,
        )
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> PipelineModel:
        numeric = self.getOrDefault(self.numericCols)
        categorical = self.getOrDefault(self.categoricalCols)
        stages, inputs = [], []
        if numeric:
            scaler = MedianScaler(inputCols=numeric, scale=self.getOrDefault(self.scale)).fit(df)
            stages.append(scaler)
            inputs += scaler.getOutputCols()
        if categorical:
            floor = CategoryFloor(
                inputCols=categorical, minFrequency=self.getOrDefault(self.minFrequency),
                unseen=self.getOrDefault(self.unseen),
                inlineCategories=self.getOrDefault(self.inlineCategories),
            ).fit(df)
            coded = floor.transform(df)
            # Sizes come from the metadata, so this fit reads no rows. The
            # last category is the unseen one: dropping it gives all zeros.
            onehot = OneHotEncoder(
                inputCols=floor.stages[-1].codeCols(), outputCols=[f"hot__{c}" for c in categorical],
                dropLast=True,
            ).fit(coded)
            stages += [*floor.stages, onehot]
            inputs += onehot.getOutputCols()
        if not inputs:
            raise ValueError("no column to encode")
        stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
        return PipelineModel(stages)


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names of the vector's entries, in order, from its metadata."""
    attributes = df.schema[column].metadata["ml_attr"]["attrs"]
    found = sorted(
        (a["idx"], a["name"]) for kind in attributes.values() for a in kind
    )
    names = []
    for _, name in found:
        for prefix in ("scaled__", "hot__"):
            if name.startswith(prefix):
                name = name[len(prefix):]
        names.append(name)
    return names


__all__ = [
    "CategoryFloor", "CategoryPool", "CategoryRare", "CategoryText", "MedianScaler", "MedianScalerModel",
    "Preprocessor", "category_counts", "exact_medians", "feature_names",
    "infer_column_groups", "numeric_statistics",
]
