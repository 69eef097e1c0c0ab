"""First, last and later encounters by packed order keys."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from wardlight.operators import profile

ROWS = "patient_nbr long, at timestamp, encounter_id long, label int"


@pytest.fixture(scope="module")
def visits(spark):
    rng = random.Random(9)
    start = dt.datetime(1965, 1, 1)
    rows = []
    for i in range(400):
        at = None if rng.random() < 0.05 else start + dt.timedelta(hours=rng.randrange(0, 900_000))
        patient = None if rng.random() < 0.1 else (7 if rng.random() < 0.3 else rng.randrange(60))
        rows.append((patient, at, rng.choice([-1, 1]) * (i + 1), rng.choice([0, 1, None])))
    return spark.createDataFrame(rows, ROWS), rows


def place(row):
    """NULL times first, then by time and id."""
    return (row[1] is not None, row[1] or dt.datetime.min, row[2])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("order", [("at", "encounter_id"), ("encounter_id",)])
@pytest.mark.parametrize("which", ["first", "last"])
def test_edges_equal_sorting(visits, order, which):
    table, rows = visits
    by = place if len(order) == 2 else (lambda r: r[2])
    chosen = {}
    for row in sorted(rows, key=by, reverse=which == "last"):
        if row[0] is not None:
            chosen.setdefault(row[0], row)
    want = [*chosen.values(), *(r for r in rows if r[0] is None)]
    found = profile.edge_encounters(table, which, order=order)
    assert found.columns == table.columns
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, want))
    assert "SortAggregate" not in plan(found)
    # other types of order give the same by whole rows
    text = table.withColumn("text", F.format_string("%s %06d", F.coalesce(
        F.date_format("at", "yyyy-MM-dd HH:mm:ss"), F.lit("0")), F.col("encounter_id") + 1000))
    if len(order) == 2:
        plain = profile.edge_encounters(text, which, order=("text",)).drop("text")
        assert sorted(map(str, plain.collect())) == sorted(map(str, found.collect()))


def test_first_versus_later(visits):
    table, rows = visits
    found = profile.first_versus_later(table, order=("at", "encounter_id"))
    first = {}
    for row in sorted(rows, key=place):
        first.setdefault(row[0] if row[0] is not None else ("alone", row[2]), row)
    n_pos = sum(r[3] or 0 for r in first.values())
    got = {r["visit"]: r for r in found.collect()}
    assert (got["first"]["n_rows"], got["first"]["n_pos"]) == (len(first), n_pos)
    assert got["later"]["n_rows"] == len(rows) - len(first)
    assert "SortAggregate" not in plan(found)


def test_readmission_plan_and_ids(spark):
    rows = [(1, dt.datetime(2020, 1, 1, 8), -5), (1, dt.datetime(2020, 1, 1, 9), 3),
            (1, dt.datetime(2020, 1, 20), 9), (2, dt.datetime(2020, 1, 1), 4), (None, None, 6),
            (1, dt.datetime(2020, 4, 1), 2**62), (2, dt.datetime(2020, 1, 1), -2**62)]
    table = spark.createDataFrame(rows, "patient_nbr long, admitted timestamp, encounter_id long")
    found = profile.derive_readmission(table)
    got = {r["encounter_id"]: r["readmitted"] for r in found.collect()}
    assert got == {-5: "<30", 3: "<30", 9: ">30", 2**62: "NO", 4: "NO", -2**62: "<30", 6: "NO"}
    assert "SortAggregate" not in plan(found)


def test_widest_keys_fit(spark):
    ends = [(1, dt.datetime(9999, 12, 30, 23, 59, 59, 999999), 2**63 - 1, 1),
            (1, dt.datetime(2, 1, 1), -2**63, 0)]
    table = spark.createDataFrame(ends, ROWS)
    assert profile.edge_encounters(table, "last", order=("at", "encounter_id")).first()["label"] == 1
    assert profile.edge_encounters(table, "first", order=("at", "encounter_id")).first()["label"] == 0
    rates = {r["visit"]: r["n_pos"] for r in profile.first_versus_later(
        table, order=("at", "encounter_id")).collect()}
    assert rates == {"first": 0, "later": 1}
