"""Classifiers, rules, mixing, URL rules, leaks and the defined cases."""

import math
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wardlight.llm import (
    decontaminate, licences, line_dedup, mixing, near_dedup, pairwise_quality, quality_rules,
    substring_dedup, suffix_dedup, url_filter,
)


def prose(rng, n):
    return " ".join("".join(rng.choices("aeioubcdst", k=rng.randrange(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def labelled(spark, make_docs):
    """Clean prose and junk (symbols, repeated words), all labelled."""
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        text = prose(rng, rng.randrange(60, 120))
        if i % 6 == 0:
            text = " ".join(w + "###" for w in text.split())
        rows.append((i, text))
        labels.append((i, int(i % 6 != 0)))
    return make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int")


def test_binomial_tail(spark):
    cases = [(0, 100, 0.05), (3, 200, 0.02), (40, 5000, 0.01), (0, 1, 0.5), (9, 100, 0.05)]
    for k, n, share in cases:
        got = spark.range(1).select(quality_rules.binomial_tail(
            F.lit(k).cast("long"), F.lit(n).cast("long"), share)).first()[0]
        want = sum(math.comb(n, i) * share**i * (1 - share) ** (n - i) for i in range(k + 1))
        assert got == pytest.approx(want if k <= n * share else 1.0, rel=1e-9)


def test_rules_certify_and_keep_clean(labelled):
    docs, labels = labelled
    thresholds = quality_rules.fit_thresholds(docs, labels, max_false_rejection=0.1)
    assert "symbol_share" in thresholds.first()["cutoffs"]
    kept = {r["doc_id"] for r in quality_rules.judge(docs, thresholds).where("kept")
            .select("row.doc_id").collect()}
    assert kept == {i for i in range(600) if i % 6}


def test_few_labels_certify_nothing(labelled):
    docs, labels = labelled
    assert quality_rules.fit_thresholds(docs, labels.limit(30)).count() == 0


def test_every_label_counts(spark):
    """1,035 clean labels of 25,300 certify a cutoff of "es"; their share of 20,000 would not."""
    i = F.col("id")
    body = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda w: F.concat(
        F.lit("word"), w.cast("string"))), " ")
    table = spark.range(25_300).select(
        i.alias("doc_id"), (i % 22 == 0).alias("es"), (i % 220 == 22).alias("junk"))
    docs = table.select("doc_id", F.when(F.col("es"), "es").otherwise("en").alias("lang"), F.when(
        F.col("junk"), F.regexp_replace(body, "word", "#####")).otherwise(body).alias("text"))
    labels = table.select("doc_id", (~F.col("junk")).cast("int").alias("quality"))
    found = {r["stratum"]: r["cutoffs"] for r in
             quality_rules.fit_thresholds(docs, labels).collect()}
    assert "symbol_share" in found["es"]


def test_pairwise_scores_rank_the_holdout(labelled):
    docs, labels = labelled
    held = pairwise_quality.held_out(F.col("doc_id"))
    model = pairwise_quality.fit(docs, labels.where(~held))
    scored = pairwise_quality.score(docs, model).select("row.doc_id", "score", "predicted")
    rows = scored.join(labels, "doc_id").where(held).collect()
    good = [r["score"] for r in rows if r["quality"]]
    bad = [r["score"] for r in rows if not r["quality"]]
    assert min(good) > max(bad) and all(0 <= s <= 1 for s in good + bad)
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.97 * len(rows)


def test_one_label_gives_a_constant(labelled):
    docs, labels = labelled
    model = pairwise_quality.fit(docs, labels.where("quality = 1"))
    assert {r["score"] for r in pairwise_quality.score(docs, model).collect()} == {1.0}


def test_the_cut_is_chosen_on_all_labels(spark):
    """Against trying every quantile of the sample on every labelled row."""
    rng = random.Random(6)
    rows = [(g, rng.gauss(1.0 if g else 0.0, 0.7)) for g in rng.choices([True, False], [3, 1], k=900)]
    labelled = spark.createDataFrame(rows, "good boolean, strength double").repartition(3)
    sample = spark.createDataFrame(rows[:90], "good boolean, strength double")
    values = sorted(s for _, s in rows[:90])
    place = [i / 50 * (len(values) - 1) for i in range(1, 50)]
    cuts = [values[int(p)] + (p - int(p)) * (values[min(int(p) + 1, 89)] - values[int(p)]) for p in place]
    good, bad = [s for g, s in rows if g], [s for g, s in rows if not g]
    errors = [sum(s < c for s in good) / len(good) + sum(s >= c for s in bad) / len(bad) for c in cuts]
    got = pairwise_quality.quantile_cut(sample, labelled, 50)
    assert got == pytest.approx(cuts[errors.index(min(errors))])


def test_pairs_are_of_both_labels(spark):
    """Every text of the larger class meets some of the smaller, half of them turned round."""
    zeros = {f: 0.0 for f in pairwise_quality.FIGURES[1:]}
    sample = spark.createDataFrame(
        [{"good": i % 4 != 0, "order": i, "log_words": float(i), **zeros} for i in range(40)])
    pairs = pairwise_quality.preference_pairs(sample).collect()
    assert len(pairs) == 30 * pairwise_quality.PAIRS_PER_TEXT
    assert all(p["winner"]["log_words"] % 4 != 0 and p["loser"]["log_words"] % 4 == 0 for p in pairs)
    assert {p["winner"]["log_words"] for p in pairs} == {float(i) for i in range(40) if i % 4}
    assert sum(p["straight"] for p in pairs) == len(pairs) / 2


def test_water_fill_by_hand(spark):
    rows = [("a", 100, 3), ("b", 10, 1), ("c", 300, 2), ("d", 0, 3)]
    table = spark.createDataFrame(rows, "source string, source_size long, weight long")
    got = {r["source"]: r["target"] for r in mixing.water_fill(table).collect()}
    assert got["d"] == 0 and got["a"] == 200 and got["b"] == 20
    assert got["c"] == pytest.approx(615 - 220)


def test_mix_comes_near_its_targets(make_docs):
    rng = random.Random(1)
    docs = make_docs([
        (i, prose(rng, rng.randrange(1, 60)), "en", rng.choice(["a", "b", "c", "d", None]), 0)
        for i in range(900)
    ])
    first, again = (
        sorted(map(str, mixing.mix(docs).collect())) for _ in range(2))
    assert first == again
    sums = mixing.mix(docs, carry=("source",)).groupBy("row.source").agg(
        F.first("target").alias("target"), F.sum("taken").alias("taken"), F.max(F.col("taken") - 2 * F.col("size")).alias("over"))
    for row in sums.collect():
        assert abs(row["taken"] - row["target"]) <= 60 and row["over"] <= 0


def test_mixture_repeats_rows(make_docs):
    docs = make_docs([(i, "some words here", "en", f"s{i % 2}", 15) for i in range(40)])
    mixed = mixing.mixture(docs)
    assert mixed.columns == docs.columns and mixed.count() == 60


def fits(host, path, rule):
    _, rule_host, rule_path = rule
    return (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path)


def test_url_rules_equal_brute_force(spark):
    rng = random.Random(6)
    label = lambda: rng.choice(["a", "b", "com", "net", "x"])
    host = lambda: ".".join(label() for _ in range(rng.randrange(1, 5)))
    path = lambda: rng.choice(["", "/", "/p", "/p/", "/p/q", "/q?z", "/pq#t", "/é"])
    rules = {(host(), path().split("?")[0].split("#")[0]) for _ in range(60)}
    rules = [(rng.choice(["allow", "block"]), *r) for r in sorted(rules)]
    urls = [(i, f"http://{host().upper() if i % 9 == 0 else host()}{path()}") for i in range(700)]
    urls += [(700, None), (701, "no scheme"), (702, "://"), (703, "x://a.com?u=/p"), (1, urls[1][1])]
    table = spark.createDataFrame(urls, "page_id long, url string")
    got = url_filter.match_rules(table, url_filter.rule_table(spark, rules), ranges=7).collect()
    assert len(got) == len(urls)
    by_id = {r["page_id"]: r for r in got}
    for page_id, url in urls:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        want_host, tail = rest[:cut].lower(), rest[cut:]
        want_path = tail.split("?")[0].split("#")[0]
        best = max((r for r in rules if fits(want_host, want_path, r)), default=None,
                   key=lambda r: (len(r[1] + r[2]), len(r[1])))
        row = by_id[page_id]
        assert (row["host"], row["path"]) == (want_host, want_path)
        assert row["rule"] == (best and best[1] + best[2])
        assert row["verdict"] == (best[0] if best else "allow")


def test_no_rules_leave_the_default(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    row = url_filter.match_rules(pages, url_filter.rule_table(spark, []), ranges=2).first()
    assert (row["rule"], row["verdict"]) == (None, "allow")


def test_odd_urls(spark):
    """Empty pages, columns of the operator's own names, and a very long url."""
    rules = url_filter.rule_table(spark, [("block", "net", "/es/"), ("allow", "com", "/")])
    long_path = "/es/" + "a" * 200_000
    pages = spark.createDataFrame(
        [(1, "http://A.net" + long_path), (2, None), (2, None), (None, "x://b.com/")],
        "page_id long, url string",
    ).withColumns({c: F.lit("x") for c in ("host", "path", "rule", "key", "row", "a.b", "verdict")})
    got = {(r["page_id"], r["rule"], r["verdict"], len(r["path"])) for r in
           url_filter.match_rules(pages, rules).collect()}
    assert got == {(1, "net/es/", "block", len(long_path)), (2, None, "allow", 0),
                   (None, "com/", "allow", 1)}
    assert url_filter.match_rules(pages, rules).count() == 4
    assert url_filter.match_rules(pages.limit(0), rules).count() == 0


def test_leaks_in_blocks_and_their_places(spark, make_docs):
    rng = random.Random(2)
    item = prose(rng, 25)
    bench = spark.createDataFrame(
        [(1, item), (2, "Short Item"), (3, None), (4, "... !"), (None, "nameless item words")],
        "item_id long, text string")
    inside = " ".join(item.split()[4:18])
    docs = make_docs([
        (1, f"Ä prefix, {inside.upper()}! and more"), (2, "a (short--item) here"), (3, None),
        (4, " ".join(item.split()[:9])), (5, "the nameless item, words"), (6, "clean")])
    for limit in (decontaminate.MAX_BLOCK_BYTES, 100):
        scanned = decontaminate.with_spans(
            decontaminate.find_overlaps(docs, bench, max_block_bytes=limit))
        got = {r["row"]["doc_id"]: r for r in scanned.collect()}
        assert [got[i]["found"]["items"] for i in range(1, 7)] == [["1"], ["2"], [], [], [""], []]
        text = got[1]["text"]
        assert [text[s["start"]:s["end"]] for s in got[1]["spans"]] == [inside.upper()]
    digest = {r["doc_id"]: r for r in decontaminate.digest(
        decontaminate.find_overlaps(docs, bench)).collect()}
    assert (digest[1]["n_hit"], digest[2]["n_hit"], digest[6]["contaminated"]) == (14, 2, False)


def test_licences_found_and_held_out_families(make_docs):
    rng = random.Random(3)
    rows = [(i, "\n".join(prose(rng, 30) for _ in range(4))) for i in range(150)]
    notices = {
        "mit": "Released under the MIT License.", "gpl":
        "This work is licensed under the GNU General Public License, version 3.",
        "apache-2.0": "licensed under the apache license version 2.0",
        "proprietary": "All rights reserved.",
    }
    for k, (family, notice) in enumerate(notices.items()):
        rows.append((1000 + k, f"{rows[k][1]}\n{notice}"))
    docs = make_docs(rows)
    got = {r["doc_id"]: r["licences"] for r in licences.scan(docs).collect()}
    assert len(got) == len(rows)
    for k, family in enumerate(notices):
        assert got[1000 + k] == [family]
    assert all(got[i] == [] for i in range(150))


def test_licences_learn_from_every_paragraph(spark, make_docs):
    rows = [(i, "\n".join(f"plain line {i} {k}" for k in range(9))) for i in range(1000)]
    rows.append((1000, "all rights reserved"))
    found = licences.training_rows(make_docs(rows)).where(F.col("family") == licences.NONE)
    assert found.count() == 9000


def test_licences_cut_and_hash_a_text_once(make_docs):
    docs = make_docs([(1, "a plain line\nall rights reserved")])
    plan = licences.with_features(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"[^\p{L}\p{N}.-]") == 1
    assert plan.index("posexplode") < plan.index("xxhash64(doc_id")


def test_licences_learn_in_parts_of_bounded_size(make_docs, monkeypatch):
    """However large the table, a task of the regression reads a part of it only."""
    found, plain = [], licences.LogisticRegression.fit

    def fit(self, rows):
        found.extend(rows.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect())
        return plain(self.copy({self.maxIter: 1}), rows)

    monkeypatch.setattr(licences.LogisticRegression, "fit", fit)
    monkeypatch.setattr(licences, "PART_BYTES", 20_000, raising=False)
    docs = make_docs([
        (i, "\n".join(f"line {i * 40 + j} has words {j * i % 977} and {i % 31}" for j in range(40)))
        for i in range(100)]).coalesce(1)
    key = "spark.sql.files.maxPartitionBytes"
    before = docs.sparkSession.conf.get(key)
    licences.fit(docs)
    others = [n for n in found[:-1] if n]
    assert sum(others) > 3_000 and max(others) < 1_500 and len(others) > 3
    assert docs.sparkSession.conf.get(key) == before


def test_licences_of_equal_rows_and_null_ids(make_docs):
    rng = random.Random(5)
    rows = [(i, prose(rng, 30)) for i in range(150)]
    notice = f"{prose(rng, 30)}\n\nAll rights reserved.\nAll rights reserved."
    rows += [(None, notice)] * 3 + [(7, notice)] * 2
    got = [(r["doc_id"], r["n_found"], r["licences"])
           for r in licences.scan(make_docs(rows)).collect()]
    assert len(got) == len(rows)
    assert sorted(n for _, n, _ in got) == [0] * 150 + [2] * 5
    assert sum(i is None and names == ["proprietary"] for i, _, names in got) == 3


def test_least_confidence_is_exact(spark):
    table = spark.range(5000).select(
        (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000).alias("confidence"))
    values = sorted((r["confidence"] for r in table.collect()), reverse=True)
    for share in (0.001, 0.03, 0.2):
        assert licences.least_confidence(table, share) == values[int(5000 * share)]
    assert licences.least_confidence(table, 0.9) == 0.5
    assert licences.least_confidence(table.limit(0), 0.1) == 0.5


OPERATORS = {
    "licences": lambda d, b, lab: licences.scan(d),
    "pairwise": lambda d, b, lab: pairwise_quality.score(d, pairwise_quality.fit(d, lab)),
    "mixing": lambda d, b, lab: mixing.mix(d),
    "suffix": lambda d, b, lab: suffix_dedup.remove_repeats(d),
    "leaks": lambda d, b, lab: decontaminate.find_overlaps(d, b),
    "near": lambda d, b, lab: near_dedup.near_classes(d),
    "rules": lambda d, b, lab: quality_rules.judge(d, quality_rules.fit_thresholds(d, lab)),
    "lines": lambda d, b, lab: line_dedup.find_recurring(d),
    "substring": lambda d, b, lab: substring_dedup.remove_repeats(d),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows_and_empty_tables(spark, odd_docs, name):
    """Every operator returns a row per row; NULLs, equal rows and clashing names included."""
    bench = spark.createDataFrame([(1, "no id at all"), (None, None)], "item_id long, text string")
    labels = spark.createDataFrame(
        [(1, 0), (4, 1), (4, 1), (5, None), (None, 1)], "doc_id long, quality int")
    assert OPERATORS[name](odd_docs, bench, labels).count() == 11
    assert OPERATORS[name](odd_docs.limit(0), bench, labels).count() == 0
    assert OPERATORS[name](odd_docs, bench.limit(0), labels.limit(0)).count() == 11


def test_later_copies_go_and_first_stay(odd_docs):
    removed = {r["doc_id"]: r["n_removed"] for r in substring_dedup.remove_repeats(odd_docs).collect()}
    assert removed[4] == 0 and removed[5] == 60_000 and removed[6] == 0


def test_pipeline_stages_on_odd_rows(spark, odd_docs, folder, tmp_path):
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.columns == odd_docs.columns, name
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert stage(spark, odd_docs.limit(0), folder).count() == 0, name
    assert {r["doc_id"] for r in docs.collect()} <= {4}
    assert corpus_pipeline.STAGES[-1][1](spark, odd_docs, folder).columns == odd_docs.columns
    near = near_dedup.drop_near_copies(odd_docs).collect()
    assert sorted(r["doc_id"] for r in near if r["doc_id"] and r["text"] and r["text"].strip()) == [
        4, 6, 7, 7]


def test_pipeline_run(spark, folder):
    """Every stage works on what the one before kept, checked by plain counting."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.6 * sizes[0]
    final = corpus_pipeline.run(spark, folder)
    n_words = F.size(F.split(F.trim("text"), r"\s+"))
    left, mixed = (t.agg(F.sum(n_words)).first()[0] for t in (docs, final))
    assert abs(mixed / left - mixing.BUDGET_SHARE) < 0.15
