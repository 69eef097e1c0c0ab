"""Who owns stored tables, and when they go."""

from pathlib import Path

import pytest

from wardlight.session import Scratch, clear_scratch, materialize, shared_dir


def files(spark):
    folder = Path(shared_dir(spark).removeprefix("file:")) / "wardlight"
    return [p for p in folder.rglob("*.parquet")] if folder.exists() else []


def test_scratch_removes_its_tables(spark):
    other = materialize(spark.range(3))
    before = len(files(spark))
    with Scratch(spark, "owner") as scratch:
        first, second = scratch.store(spark.range(5), "a.b"), scratch.store(spark.range(7))
        assert (first.count(), second.count()) == (5, 7) and len(files(spark)) > before
        scratch.drop(first)
        assert second.count() == 7
        with pytest.raises(Exception):
            first.count()
    assert len(files(spark)) == before and other.count() == 3


def test_scratch_goes_with_an_error(spark):
    before = len(files(spark))
    with pytest.raises(KeyError), Scratch(spark, "broken") as scratch:
        scratch.store(spark.range(5))
        raise KeyError
    assert len(files(spark)) == before


def test_clear_scratch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("wardlight.session.shared_dir", lambda _: f"file:{tmp_path}")
    materialize(spark.range(3))
    assert list(tmp_path.rglob("*.parquet"))
    clear_scratch(spark)
    assert not list(tmp_path.rglob("*.parquet"))
    clear_scratch(spark)
