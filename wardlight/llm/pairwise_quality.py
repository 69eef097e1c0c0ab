"""Quality scores learned from preference pairs by the Bradley-Terry model.

Labelled texts give pairs (good, bad). The chance that the good one is preferred
is the logistic function of the difference of their strengths, a strength being a
weighted sum of a text's figures; the weights minimise the logistic loss on the
figure differences. A cut among the quantiles of the training strengths is the
reference: a text's score is its chance to beat it, shifted so that the cut itself
scores ``CUT_SCORE``.

The weights are fitted on at most ``MAX_LABELLED`` labelled rows, the first by hash,
and the cut is chosen on all labelled rows; every text is scored in its row by built-in
functions. Very long texts are one row's work; an empty table gives an empty one.

Defined cases: a NULL text scores as an empty one; without both labels there is
no pair and every text scores the mean label (0.5 without any); of several labels
of one id the lowest counts; rows are scored one by one. Labels, language, source
and id are no inputs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlight.llm.common import quoted, smallest, stored, words

MAX_LABELLED = 20_000
PAIRS_PER_TEXT = 3
REGULARISATION = 1e-3
QUANTILES = 1_000
CUT_SCORE = 0.7
FIGURES = (
    "log_words", "short", "word_length", "length_spread", "distinct_share", "repeat_share",
    "symbol_share", "symbols_seen", "upper_share", "digit_share", "mark_share", "line_words",
    "dup_line_share",
)


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def with_figures(docs: DataFrame, carry: tuple[str, ...], text: str = "text") -> DataFrame:
    """The carried columns as ``row`` and the figures of the text."""
    body = F.coalesce(F.col(text), F.lit(""))
    gone = lambda pattern: (
        F.char_length("body") - F.char_length(F.regexp_replace("body", pattern, ""))
    )
    share = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    n, chars, lines = F.col("n"), F.greatest(F.col("chars"), F.lit(1)), F.col("lines")
    return (
        docs.select(F.struct(*map(quoted, carry)).alias("row"), body.alias("body"), words(body).alias("words"))
        .select("row", "body", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
                F.aggregate("words", F.struct(F.lit(0).alias("sum"), F.lit(0.0).alias("square")),
                            lambda a, w: F.struct(
                                (a["sum"] + F.char_length(w)).alias("sum"),
                                (a["square"] + F.char_length(w) * F.char_length(w))
                                .alias("square"))).alias("lengths"),
                F.filter(F.split("body", "\n", -1), lambda x: x.rlike(r"[^ \t-\r]"))
                .alias("lines"))
        .select("row", "lines", F.size("hashes").alias("n"), F.char_length("body").alias("chars"),
                "lengths", F.size(F.array_distinct("hashes")).alias("distinct"),
                F.aggregate("hashes", F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("w")),
                            lambda a, h: F.struct(
                                (a["n"] + (a["w"] == h).cast("int")).alias("n"), h.alias("w"))
                            )["n"].alias("repeats"),
                gone("[#*$%&|<>]").alias("symbols"), gone("[A-Z]").alias("upper"),
                gone("[0-9]").alias("digits"), gone("[.,;:!?]").alias("marks"))
        .select("row", F.inline(F.array(F.struct(
            F.log1p(n).alias("log_words"), (n < 20).cast("double").alias("short"),
            F.least(share(F.col("lengths.sum"), n), F.lit(30.0)).alias("word_length"),
            F.sqrt(F.greatest(F.lit(0.0), share(F.col("lengths.square"), n) - F.pow(
                share(F.col("lengths.sum"), n), F.lit(2.0)))).alias("length_spread"),
            share(F.col("distinct"), n).alias("distinct_share"),
            share(F.col("repeats"), n).alias("repeat_share"),
            (F.col("symbols") / chars).alias("symbol_share"),
            F.least(F.col("symbols") / chars * 20, F.lit(1.0)).alias("symbols_seen"),
            (F.col("upper") / chars).alias("upper_share"),
            (F.col("digits") / chars).alias("digit_share"),
            (F.col("marks") / chars).alias("mark_share"),
            F.log1p(share(n, F.size(lines))).alias("line_words"),
            share(F.size(lines) - F.size(F.array_distinct(lines)), F.size(lines))
            .alias("dup_line_share"),
        ))))
    )


@dataclass(frozen=True)
class QualityModel:
    """Strength = sum of weight * figure; ``cut`` scores CUT_SCORE."""

    weights: tuple[float, ...]
    cut: float
    constant: float | None = None

    def strength(self) -> Column:
        total = F.lit(0.0)
        for name, weight in zip(FIGURES, self.weights):
            total = total + F.lit(weight) * F.col(name)
        return total

    def score(self) -> Column:
        if self.constant is not None:
            return F.lit(self.constant)
        shift = math.log(CUT_SCORE / (1 - CUT_SCORE)) - self.cut
        return 1 / (1 + F.exp(-(self.strength() + F.lit(shift))))


def preference_pairs(sample: DataFrame, pairs_per_text: int = PAIRS_PER_TEXT) -> DataFrame:
    """(good, bad) rows: each text of the larger class meets some of the smaller.

    The sample is bounded, so its ranks are dealt by plain windows.
    """
    ranked = sample.withColumn(
        "rank", F.row_number().over(W.partitionBy("good").orderBy("order", *FIGURES)) - 1
    )
    sizes = {r["good"]: r["count"] for r in ranked.groupBy("good").count().collect()}
    if len(sizes) < 2:
        return None
    large = sizes[True] >= sizes[False]
    few = min(sizes.values())
    side = lambda flag, name: ranked.where(F.col("good") == flag).select(
        F.struct(*FIGURES).alias(name), F.col("rank").alias(f"{name}_rank"))
    many_name, few_name = ("winner", "loser") if large else ("loser", "winner")
    many = side(large, many_name).withColumn("shift", F.explode(F.sequence(
        F.lit(0), F.lit(min(pairs_per_text, few) - 1))))
    step = max(1, few // max(1, pairs_per_text))
    meets = (F.col(f"{many_name}_rank") + F.col("shift") * step) % few
    return many.withColumn("meets", meets).join(
        side(not large, few_name), F.col("meets") == F.col(f"{few_name}_rank")
    ).select("winner", "loser", (F.col(f"{many_name}_rank") % 2 == 0).alias("straight"))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> QualityModel:
    """Fit on labelled rows of ``labels`` (doc_id, quality); the caller keeps a holdout out."""
    rows = stored(with_figures(docs, ("doc_id",)), "quality-figures")
    return fit_figures(rows, labels, max_labelled)


def fit_figures(
    rows: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED
) -> QualityModel:
    """Fit on rows of ``with_figures`` that carry doc_id, stored: they are read twice.

    The weights are fitted on ``max_labelled`` labelled rows; the cut is the one of their
    quantiles that separates all labelled rows best.
    """
    known = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").alias("of")).agg((F.min("quality") > 0).alias("good"))
    )
    labelled = stored(
        rows.join(known, F.col("row.doc_id") == F.col("of")).select("of", "good", *FIGURES),
        "quality-labelled")
    order = F.xxhash64("of", *FIGURES)
    sample = stored(
        smallest(labelled, order, max_labelled, labelled.count()).withColumn("order", order),
        "quality-sample")
    pairs = preference_pairs(sample)
    if pairs is None:
        mean = labelled.agg(F.avg(F.col("good").cast("double"))).first()[0]
        return QualityModel((0.0,) * len(FIGURES), 0.0, 0.5 if mean is None else mean)
    sign = F.when(F.col("straight"), 1.0).otherwise(-1.0)
    differences = pairs.select(
        F.col("straight").cast("double").alias("label"),
        *[(sign * (F.col(f"winner.{f}") - F.col(f"loser.{f}"))).alias(f) for f in FIGURES],
    )
    vectors = stored(
        VectorAssembler(inputCols=list(FIGURES), outputCol="features")
        .transform(differences).select("label", "features"),
        "quality-pairs",
    )
    fitted = LogisticRegression(
        fitIntercept=False, regParam=REGULARISATION, maxIter=100
    ).fit(vectors)
    model = QualityModel(tuple(float(w) for w in fitted.coefficients), 0.0)
    strength = model.strength().alias("strength")
    return QualityModel(model.weights, quantile_cut(
        sample.select(strength), labelled.select("good", strength)))


def quantile_cut(sample: DataFrame, labelled: DataFrame, quantiles: int = QUANTILES) -> float:
    """The strength quantile of the sample with the least balanced error on all labels.

    What is collected is a count per label and stretch between two quantiles.
    """
    shares = F.array(*[F.lit(i / quantiles) for i in range(1, quantiles)])
    cuts = sorted(set(sample.select(F.percentile("strength", shares)).first()[0]))
    dealt = Bucketizer(
        splits=[-math.inf, *cuts, math.inf], inputCol="strength", outputCol="stretch"
    ).transform(labelled)
    counts = {True: [0] * (len(cuts) + 1), False: [0] * (len(cuts) + 1)}
    for row in dealt.groupBy("good", "stretch").agg(F.count("*").alias("n")).collect():
        counts[row["good"]][int(row["stretch"])] += row["n"]
    n_good, n_bad = sum(counts[True]), sum(counts[False])
    best, lost, passed = None, 0, n_bad
    for k, cut in enumerate(cuts):
        lost, passed = lost + counts[True][k], passed - counts[False][k]
        error = lost / n_good + passed / n_bad
        if best is None or error < best[0]:
            best = (error, cut)
    return float(best[1])


def score(docs: DataFrame, model: QualityModel, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns as ``row``, and ``score`` and ``predicted``."""
    return score_figures(with_figures(docs, carry), model)


def score_figures(rows: DataFrame, model: QualityModel) -> DataFrame:
    """Score rows of ``with_figures``."""
    scored = rows.select("row", model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUT_SCORE).cast("int"))
