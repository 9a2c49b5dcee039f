"""Session defaults that hold from a laptop to a large cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T

# Adaptive execution sizes the reduce side, splits skewed join partitions and
# picks broadcast joins from measured sizes. UTC keeps dates comparable.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.ansi.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "tidemark", **conf: str) -> SparkSession:
    """Create or reuse a session; settings already present on a cluster win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for stream state and staged tables, under ``spark.checkpoint.dir``.

    A single-machine session without that setting gets a temporary folder. On a
    cluster each executor has a disk of its own, so there the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write an intermediate result once, with the writer's ``options``, and read it back for several consumers."""
    path = work_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table as it is stored; no folder yet is an empty table."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def discard(*tables: DataFrame) -> None:
    """Delete the folders of ``staged`` tables that nothing reads any more."""
    for table in tables:
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()[:1]}:
            path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
