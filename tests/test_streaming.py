import pytest
from pyspark.sql import functions as F

from wardlight.operators import models
from wardlight.operators.score import predict_risk
from wardlight.plans import training
from wardlight.session import materialize
from wardlight.streaming import monitor, scoring


def stream(spark, table, path, files=3):
    """The table as a file stream, one file per batch, in time order."""
    rows = table.orderBy("ts").collect()
    step = -(-len(rows) // files)
    for i in range(files):
        part = spark.createDataFrame(rows[i * step:(i + 1) * step], table.schema)
        part.coalesce(1).write.mode("append").parquet(f"{path}/part={i}")
    return (
        spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1)
        .option("latestFirst", False).parquet(f"{path}/*")
    )


@pytest.fixture
def scored(spark):
    return spark.range(400).select(
        F.col("id").alias("encounter_id"),
        F.timestamp_seconds(F.lit(1_600_000_000) + F.col("id") * 40_000).alias("ts"),
        (F.pmod(F.xxhash64("id"), F.lit(100)) / 100).alias("score"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2)).cast("int").alias("label"),
        F.pmod(F.xxhash64("id", F.lit(2)), F.lit(2)).cast("int").alias("y_pred"),
        F.when(F.col("id") % 3 == 0, "A").when(F.col("id") % 3 == 1, "B").alias("g"),
    )


def shown(df):
    return sorted(
        str([round(v, 9) if isinstance(v, float) else v for v in row]) for row in df.collect()
    )


def closed(df, scored):
    mark = scored.agg(F.max("ts")).first()[0]
    return df.where(F.col("window_end") <= F.lit(mark) - F.expr("INTERVAL 1 DAY"))


def test_windows_equal_batch(spark, scored, tmp_path):
    live = monitor.monitoring_windows(stream(spark, scored, tmp_path / "in"), watched=["g"])
    running = (
        live.writeStream.outputMode("append").format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    running.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    want = closed(monitor.monitoring_windows(scored, watched=["g"]), scored)
    assert want.count() > 3
    # sums of fractions differ in the last digit with the order of the rows
    assert shown(got) == shown(want)


def test_gaps_equal_batch(spark, scored, tmp_path):
    live = monitor.group_counts(stream(spark, scored, tmp_path / "in"), ["g"])
    monitor.start_gap_log(
        live, str(tmp_path / "gaps"), str(tmp_path / "state")
    ).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "gaps")).drop("batch")
    batch = monitor.window_gaps(monitor.group_counts(scored, ["g"]))
    ends = monitor.monitoring_windows(scored).select("window_start", "window_end")
    want = closed(batch.join(ends, "window_start"), scored).select(*got.columns)
    assert got.count() > 3 and shown(got) == shown(want)


def test_late_rows_are_dropped(spark, scored, tmp_path):
    late = scored.where("encounter_id = 0").withColumn("encounter_id", F.lit(9_999).cast("long"))
    path = tmp_path / "in"
    scored.coalesce(1).write.parquet(f"{path}/part=0")
    live = lambda: monitor.monitoring_windows(
        spark.readStream.schema(scored.schema).parquet(f"{path}/*")
    )

    def run():
        (
            live().writeStream.outputMode("append").format("parquet")
            .option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "state"))
            .trigger(availableNow=True).start().awaitTermination()
        )
        return spark.read.parquet(str(tmp_path / "out")).agg(F.sum("n")).first()[0]

    before = run()
    late.coalesce(1).write.parquet(f"{path}/part=1")
    assert run() == before


def test_stream_scores_equal_batch_and_resent_records_count_once(spark, folder, tmp_path):
    from wardlight.plans import encounter_view as view

    table = view.encounters(spark, folder)
    train = materialize(training.prepare_data(table.drop("admitted", "charge")))
    model = models.fit_pipeline(train.drop("split"))
    records = table.withColumn("discharged", F.col("admitted").cast("timestamp"))
    records.unionByName(records).write.parquet(str(tmp_path / "in"))
    live = spark.readStream.schema(records.schema).parquet(str(tmp_path / "in"))
    scored = scoring.score_stream(model, live).withColumn("score_date", F.lit("all"))
    scoring.start_prediction_log(
        scored, str(tmp_path / "log"), str(tmp_path / "state")
    ).awaitTermination()
    got = scoring.read_prediction_log(spark, str(tmp_path / "log"))
    want = predict_risk(model, records).select("encounter_id", F.col("score").alias("s2"))
    both = got.join(want, "encounter_id")
    assert got.count() == want.count() == both.count()
    assert both.where("score <> s2").count() == 0


def test_a_quiet_day_is_one_file_of_a_batch(spark, tmp_path):
    """Every task holds rows of every day; the session's own settings stay as they are."""
    rows = spark.range(200, numPartitions=4).selectExpr(
        "id AS encounter_id", "date_add(DATE '2024-01-01', cast(id % 5 AS int)) AS score_date")
    rows.write.parquet(str(tmp_path / "in"))
    log, before = tmp_path / "log", spark.conf.get("spark.sql.adaptive.enabled")
    live = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    live = live.dropDuplicates(["encounter_id"])  # streams with state run without adaptive plans
    scoring.start_prediction_log(live, str(log), str(tmp_path / "state")).awaitTermination()
    assert len(list(log.glob("batch=0/score_date=*/*.parquet"))) == 5
    assert scoring.read_prediction_log(spark, str(log)).distinct().count() == 200
    assert spark.conf.get("spark.sql.adaptive.enabled") == before


def test_a_replayed_batch_is_logged_once(spark, scored, tmp_path):
    """The log of a stream whose last batch runs twice, and its files per day."""
    import shutil

    dated = scored.withColumn("score_date", F.to_date("ts"))
    log, state = tmp_path / "log", tmp_path / "state"
    live = lambda: stream(spark, dated, tmp_path / "in")
    scoring.start_prediction_log(live(), str(log), str(state)).awaitTermination()
    before = shown(scoring.read_prediction_log(spark, str(log)).select(*dated.columns))
    assert before == shown(dated)
    last = max(int(p.name) for p in (state / "commits").iterdir() if p.name.isdigit())
    for p in (state / "commits").iterdir():  # as if the driver died before the commit
        if str(last) in p.name:
            p.unlink()
    again = (
        spark.readStream.schema(dated.schema).option("maxFilesPerTrigger", 1)
        .parquet(f"{tmp_path / 'in'}/*")
    )
    scoring.start_prediction_log(again, str(log), str(state)).awaitTermination()
    assert shown(scoring.read_prediction_log(spark, str(log)).select(*dated.columns)) == before
    days = dated.select("score_date").distinct().count()
    assert len(list(log.glob("batch=*/score_date=*/*.parquet"))) <= days + last + 1
    shutil.rmtree(log)


def exact_ks(old, new):
    points = sorted({*old, *new})
    share = lambda side, x: sum(v <= x for v in side) / len(side)
    return max(abs(share(old, x) - share(new, x)) for x in points)


@pytest.mark.parametrize("size", [4_000, 64])
def test_drift_of_windows(spark, scored, tmp_path, size):
    """Streamed sketches against exact distances, within the stated bound."""
    table = scored.withColumns({
        "value": F.when(F.col("encounter_id") % 17 != 0, F.col("score") + F.col("encounter_id") / 900),
        "kind": (F.col("label") + F.col("y_pred")).cast("int")})
    reference = table.where("encounter_id < 150")
    sketches = monitor.reference_sketches(reference, ["value", "kind"], size).collect()
    live = monitor.drift_windows(
        stream(spark, table, tmp_path / "in"), ["value", "kind"], window="60 days", size=size)
    monitor.start_drift_log(
        live, sketches, str(tmp_path / "drift"), str(tmp_path / "state"), size=size
    ).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "drift")).collect()
    rows = table.collect()
    assert len(got) >= 4
    alerts = set()
    for r in got:
        c, start = r["column_name"], r["window_start"]
        inside = [x[c] for x in rows if x[c] is not None
                  and 0 <= (x["ts"] - start).total_seconds() < 60 * 86400]
        old = [x[c] for x in rows if x[c] is not None and x["encounter_id"] < 150]
        want = exact_ks(old, inside)
        assert r["n"] == len(inside)
        assert abs(r["ks"] - want) <= r["bound"] + 1e-9
        if r["sure"]:
            assert r["alert"] == (want > 0.15)
        alerts.add((r["alert"], r["sure"]))
    assert (1, True) in alerts
    if size == 4_000:
        assert all(r["bound"] == 0 for r in got)
    with pytest.raises(ValueError):
        monitor.window_drift(spark.createDataFrame(got), [])
