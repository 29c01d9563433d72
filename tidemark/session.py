"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Instants are compared and shown in UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    # Joins are planned from runtime sizes; a hot key is split across tasks even
    # where that costs one more exchange.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # One task per bucket also where a merge reads its target in place, so that rewriting a
    # snapshot does not multiply its files.
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    A machine-local folder is only ever chosen when Spark itself is local.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    own = getattr(_SCOPE, "folders", None)
    (_made(spark)[0] if own is None else own).append(path)
    return path


#: Folders and databases made for intermediate results, by the application that made them.
_MADE: dict[str, tuple[list[str], list[str]]] = {}


#: Folders of the thread's open :func:`scratch_scope`.
_SCOPE = threading.local()


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what this thread has written to the scratch folder meanwhile, and nothing else."""
    outer, _SCOPE.folders = getattr(_SCOPE, "folders", None), []
    try:
        yield
    finally:
        folders, _SCOPE.folders = _SCOPE.folders, outer
        _remove(spark, folders)


def _remove(spark: SparkSession, folders: list[str]) -> None:
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    while folders:
        path = hadoop.Path(folders.pop())
        path.getFileSystem(conf).delete(path, True)


def _made(spark: SparkSession) -> tuple[list[str], list[str]]:
    return _MADE.setdefault(spark.sparkContext.applicationId, ([], []))


def scratch_database(spark: SparkSession, name: str) -> str:
    """Note a database that :func:`clean_scratch` is to drop."""
    _made(spark)[1].append(name)
    return name


def clean_scratch(spark: SparkSession) -> None:
    """Remove all intermediate folders and databases; results that read them must have been used."""
    folders, databases = _made(spark)
    while databases:
        spark.sql(f"DROP DATABASE IF EXISTS `{databases.pop()}` CASCADE")
    _remove(spark, folders)


def write_once(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_result(spark: SparkSession, build: Callable[[], DataFrame], purpose: str) -> DataFrame:
    """:func:`write_once` for what ``build`` makes; the scratch folders that it wrote on the way are removed."""
    path = scratch_dir(spark, purpose)
    with scratch_scope(spark):
        df = build()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def collect_catalog(df: DataFrame, max_rows: int = 50_000) -> list:
    """Rows of a small catalog; refuses (never truncates) one too large for a driver-side list."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"catalog holds more than {max_rows} rows; it cannot become table columns")
    return rows
