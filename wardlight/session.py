"""Session settings, the shared scratch folder and size-checked joins."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextvars import ContextVar
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even if that costs one more exchange further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # HotSpot never compiles a method of more bytes: a wide projection made one method would
    # be interpreted for every row. Above this Spark cuts it into many.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the operators rely on."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wardlight")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        # Recording a Python call site per expression is slow on wide tables.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read, named by ``spark.checkpoint.dir``.

    Only a one-process session (``local[...]``, as in tests) may leave it unset;
    it then gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="wardlight-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/wardlight/{app}/{name}-{uuid.uuid4().hex}"


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Scratch:
    """Stored tables with one owner, who removes them when their last reader is done.

    ``with Scratch(spark, "tuning") as scratch`` removes all at the end; ``drop`` removes
    some earlier. A table that is returned to a caller must be stored elsewhere.
    Lookups that ``lookup_join`` stores inside the ``with`` belong to it, too.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.folder = scratch_path(spark, name)
        self._paths: list[tuple[DataFrame, str]] = []

    def path(self, name: str) -> str:
        """A new path in the folder."""
        return f"{self.folder}/{name}-{uuid.uuid4().hex}"

    def store(self, df: DataFrame, name: str = "table") -> DataFrame:
        """Write a table as Parquet and read it back; cuts the lineage."""
        path = self.path(name)
        table = _write(df, path)
        self._paths.append((table, path))
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables of ``store`` that nothing reads any more."""
        for table in tables:
            for held in [x for x in self._paths if x[0] is table]:
                _delete(self.spark, held[1])
                self._paths.remove(held)

    def remove(self, path: str) -> None:
        """Remove what was written to a path of ``path``."""
        _delete(self.spark, path)

    def close(self) -> None:
        _delete(self.spark, self.folder)
        self._paths.clear()

    def __enter__(self) -> Scratch:
        self._outer = _ACTIVE.set(self)
        return self

    def __exit__(self, *_: object) -> None:
        _ACTIVE.reset(self._outer)
        self.close()


_ACTIVE: ContextVar[Scratch | None] = ContextVar("scratch", default=None)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage: write the table to the shared folder as Parquet and read it.

    Readers prune columns, push filters and know the size. It stays until
    ``clear_scratch``; tables that can go earlier belong to a ``Scratch``.
    """
    return _write(df, scratch_path(df.sparkSession, "table"))


def clear_scratch(spark: SparkSession) -> None:
    """Remove all that this application stored; for the end of a job."""
    _delete(spark, f"{shared_dir(spark)}/wardlight/{spark.sparkContext.applicationId}")


def lookup_join(facts: DataFrame, lookup: DataFrame, on: list[str]) -> DataFrame:
    """Left join to a table with one row per key; a NULL key meets the NULL key.

    The lookup is stored, so its bytes are known: below
    ``spark.sql.autoBroadcastJoinThreshold`` Spark broadcasts it, otherwise both
    sides are shuffled and AQE splits the hot keys.
    """
    renamed = {c: f"__of_{c}" for c in on}
    owner = _ACTIVE.get()
    stored = owner.store(lookup, "lookup") if owner else materialize(lookup)
    lookup = stored.withColumnsRenamed(renamed)
    same = reduce(and_, [facts[c].eqNullSafe(lookup[k]) for c, k in renamed.items()])
    return facts.join(lookup, same, "left").drop(*renamed.values())
