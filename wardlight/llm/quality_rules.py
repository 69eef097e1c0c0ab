"""Quality rules whose cutoffs bound the share of clean documents they reject.

Every rule compares one figure of a text with a cutoff. For each stratum and
rule, cutoffs are tried from the loosest to the tightest on labelled holdout
documents. A cutoff is certified while the exact binomial test shows, at the
corrected level, that it rejects at most its share of clean documents. All
expressions are built-in functions; a text's counts are made inside its row.

Defined cases: a NULL or empty text has no words and fails the base rule; NULL
strata form a stratum of their own; a stratum with too few labels to certify a
rule does not use it; rows are judged one by one, so repeated rows and ids stay.
Labels: rows without doc_id or quality are ignored, and of several labels of one
id the lowest counts. Only the named columns are read.
A text of any length is counted in its row; an empty table of documents gives an empty
one, without labels only the base rule holds.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wardlight.llm.common import stored, words

# Figure -> cutoffs from the loosest to the tightest; a text above one is rejected.
RULES: dict[str, tuple[float, ...]] = {
    "symbol_share": (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.075, 0.05, 0.03),
    "repeat_share": (0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1),
    "dup_line_share": (0.9, 0.75, 0.6, 0.5, 0.4, 0.3, 0.2),
    "word_length": (60.0, 40.0, 30.0, 20.0, 16.0, 13.0, 11.0),
}
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Share of clean documents all rules together may reject in a stratum, and the
# chance that this is not so in any stratum.
MAX_FALSE_REJECTION = 0.02
ERROR_LEVEL = 0.05
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(placed: str) -> Column:
    """Words inside three-word windows that the text holds more than once.

    The column has the windows' hashes and positions in order; equal neighbours
    repeat. It must be a column, for an expression would run again per element.
    """
    repeated = F.transform(
        F.filter(placed, lambda p, k: (
            F.coalesce(p["g"] == F.get(placed, k - 1)["g"], F.lit(False))
            | F.coalesce(p["g"] == F.get(placed, k + 1)["g"], F.lit(False))
        )),
        lambda p: p["i"],
    )
    return F.aggregate(
        F.sort_array(repeated),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, i: F.struct(
            (a["n"] + i + 3 - F.greatest(i, a["end"])).alias("n"), (i + 3).alias("end")
        ),
        lambda a: a["n"],
    )


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per input row: ``row`` (the whole row) and the counts of its text."""
    body = F.coalesce(F.col("body"), F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"[^ \t-\r]"))
    some_windows = F.transform(
        F.sequence(F.lit(2), F.size("hashes") - 1),
        lambda i: F.xxhash64(*[F.get("hashes", i - k) for k in (2, 1, 0)]),
    )
    no_windows = F.array().cast("array<bigint>")
    # Only a text with a repeated window has its windows sorted with their places.
    placed = F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform(
            "windows", lambda g, i: F.struct(g.alias("g"), i.alias("i"))
        )),
    ).otherwise(F.array().cast("array<struct<g:bigint,i:int>>"))
    return (
        docs.select(F.struct("*").alias("row"), F.col(text).alias("body"))
        .select("row", "body", words(F.col("body")).alias("words"))
        .select("row", "body", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
                F.aggregate("words", F.lit(0).cast("long"),
                            lambda n, w: n + F.char_length(w)).alias("word_chars"))
        .select("row", "body", "hashes", "word_chars",
                F.when(F.size("hashes") >= 3, some_windows).otherwise(no_windows)
                .alias("windows"),
                lines.alias("lines"))
        .select("row", "body", "hashes", "word_chars", "lines", placed.alias("placed"))
        # A filter on a count must not move below it: each step it passed would be
        # copied into the condition. It cannot pass a generator.
        .select("row", F.inline(F.array(F.struct(
            F.size("hashes").cast("long").alias("n_words"),
            "word_chars",
            (F.char_length(body) - F.char_length(F.regexp_replace(body, "[#*$%&|<>]", "")))
            .cast("long").alias("n_symbols"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")
            .alias("n_dup_lines"),
            _repeat_words("placed").cast("long").alias("n_repeat_words"),
            F.size("lines").cast("long").alias("n_lines"),
        ))))
    )


def add_figures(counted: DataFrame) -> DataFrame:
    """Add ``base_failed`` and the figures the rules compare (0 where undefined)."""
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return counted.withColumns({
        "base_failed": (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        "symbol_share": share("n_symbols", "word_chars"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "word_length": share("word_chars", "n_words"),
    })


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for x >= 1, by Stirling's series at x + 8."""
    y = x + 8
    series = (
        (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi)
        + 1 / (12 * y) - 1 / (360 * F.pow(y, F.lit(3))) + 1 / (1260 * F.pow(y, F.lit(5)))
    )
    steps = x
    for k in range(1, 8):
        steps = steps * (x + k)
    return series - F.log(steps)


def binomial_tail(k: Column, n: Column, share: float) -> Column:
    """P(Bin(n, share) <= k), summed down from its largest term; 1 if k > n * share."""
    down = F.when(k > 0, F.sequence(k, F.lit(1).cast("long"), F.lit(-1).cast("long")))
    down = F.coalesce(down, F.array().cast("array<bigint>"))
    series = F.aggregate(
        down, F.struct(F.lit(1.0).alias("sum"), F.lit(1.0).alias("term")),
        lambda a, i: F.struct(
            (a["sum"] + a["term"] * i / (n - i + 1) * ((1 - share) / share)).alias("sum"),
            (a["term"] * i / (n - i + 1) * ((1 - share) / share)).alias("term"),
        ),
        lambda a: a["sum"],
    )
    largest = (
        log_gamma(n + 1.0) - log_gamma(k + 1.0) - log_gamma(n - k + 1.0)
        + k * math.log(share) + (n - k) * math.log1p(-share)
    )
    return F.when(k <= n * share, F.exp(largest) * series).otherwise(1.0)


def fit_thresholds(
    docs: DataFrame,
    labels: DataFrame,
    strata: str = "lang",
    rules: Mapping[str, Sequence[float]] = RULES,
    max_false_rejection: float = MAX_FALSE_REJECTION,
    error_level: float = ERROR_LEVEL,
) -> DataFrame:
    """Certified cutoffs: one row per stratum with ``cutoffs``, a map of rule to cutoff.

    The share of false rejections is split evenly over the rules. Within a rule
    the cutoffs are a fixed sequence, which needs no correction; over rules and
    strata the error level is divided (Bonferroni). Of the certified cutoffs the
    loosest with the largest surplus of rejected junk over rejected clean
    documents is taken. All labelled documents count.
    """
    known = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id").agg((F.min("quality") > 0).alias("clean"))
    )
    # Counted before the join, so that it moves figures and no texts.
    counted = text_counts(docs.select("doc_id", "text", strata).where("doc_id IS NOT NULL"))
    figures = (
        add_figures(counted).where("NOT base_failed")
        .select(F.col("row.doc_id").alias("doc_id"), F.col(f"row.{strata}").alias("stratum"),
                *rules)
        .join(known, "doc_id")
    )
    tries = F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(step).alias("step"),
                 F.lit(float(cut)).alias("cutoff"), (F.col(rule) > float(cut)).alias("out"))
        for rule, cuts in rules.items() for step, cut in enumerate(cuts)
    ]))
    clean = F.col("clean")
    cells = stored(
        figures.select("stratum", "clean", tries.alias("try"))
        .groupBy("stratum", "try.rule", "try.step", "try.cutoff").agg(
            F.count(F.when(clean, 1)).alias("n"),
            F.count(F.when(clean & F.col("try.out"), 1)).alias("k"),
            F.count(F.when(~clean & F.col("try.out"), 1)).alias("junk"),
        ),
        "rule-cells",
    )
    n_strata = cells.select(F.count_distinct(F.struct("stratum"))).first()[0]
    level = error_level / max(1, len(rules) * n_strata)
    passed = binomial_tail(F.col("k"), F.col("n"), max_false_rejection / len(rules)) <= level
    looser = W.partitionBy("stratum", "rule").orderBy("step")
    certified = (
        cells.withColumn("passed", passed)
        .withColumn("certified", F.min("passed").over(looser))
        .where("certified AND junk > k")
    )
    best = certified.groupBy("stratum", "rule").agg(
        F.max(F.struct(F.expr("junk - k AS gain"), F.expr("-step AS step"), "cutoff"))
        ["cutoff"].alias("cutoff")
    )
    return stored(
        best.groupBy("stratum").agg(
            F.map_from_entries(F.sort_array(F.collect_list(F.struct("rule", "cutoff"))))
            .alias("cutoffs")
        ),
        "rule-cutoffs",
    )


def judge(
    docs: DataFrame, thresholds: DataFrame, strata: str = "lang",
    rules: Mapping[str, Sequence[float]] = RULES,
) -> DataFrame:
    """Per input row: ``row``, the counts, ``base_failed``, ``failed_rules`` and ``kept``."""
    figures = add_figures(text_counts(docs))
    cut = F.when(F.col("cutoffs").isNotNull(), F.col("cutoffs")).otherwise(
        F.create_map().cast("map<string,double>")
    )
    failed = F.filter(
        F.array(*[
            F.when(F.col(rule) > F.try_element_at(cut, F.lit(rule)), F.lit(rule))
            for rule in rules
        ]),
        lambda r: r.isNotNull(),
    )
    return (
        figures.join(thresholds, F.col(f"row.{strata}").eqNullSafe(F.col("stratum")), "left")
        .withColumn("failed_rules", failed)
        .select("row", *COUNTS, "base_failed", "failed_rules",
                (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"))
    )


def keep_good(docs: DataFrame, labels: DataFrame, strata: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass, with their columns."""
    thresholds = fit_thresholds(docs, labels, strata)
    return judge(docs, thresholds, strata).where("kept").select("row.*")
