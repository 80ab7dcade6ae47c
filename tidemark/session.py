"""Session defaults and the shared scratch area."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}

#: Tables of each open or finished scope, and the scopes that are open.
_WRITTEN: dict[tuple[str, str], list[str]] = {}
_OPEN: list[tuple[str, str]] = []


def build(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings every plan here assumes (UTC, AQE)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Where it is
    unset, a temporary folder is made, which ends with the process; only on a
    single machine, as executors elsewhere would not see it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        folder = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _OWN[app] = "file://" + folder
    return _OWN[app]


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared scratch folder and read it back:
    cuts lineage in a way that survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/tidemark-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for scope in _OPEN[-1:]:
        _WRITTEN[scope].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["_scratch_path"] = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def discard(*tables: DataFrame) -> None:
    """Delete what ``materialize`` wrote for ``tables``. Only for tables that no
    frame still to be run reads."""
    for t in tables:
        path = t.__dict__.pop("_scratch_path", None)
        if path:
            _delete(t.sparkSession, path)


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[None]:
    """Tables written inside belong to ``name``. Those that the last scope of
    this name wrote are deleted first: frames made there must have been run."""
    scope = (spark.sparkContext.applicationId, name)
    for path in _WRITTEN.pop(scope, []):
        _delete(spark, path)
    _WRITTEN[scope] = []
    _OPEN.append(scope)
    try:
        yield
    finally:
        _OPEN.remove(scope)
