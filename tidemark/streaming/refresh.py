"""Recurring refresh as a stream: new entry files -> actions -> versioned snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.operators import registry
from tidemark.operators.latest import assign_versions
from tidemark.session import stored

ENTRY_SCHEMA = schemas.BENCHMARKS
#: Folders that the registry is spread over by a hash of its source.
BUCKETS = 64
ORDER = ("inserted_at", "source_id", "value")


def read_entries(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    return spark.readStream.schema(ENTRY_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(path)


def bucket_of(source_id: str = "source_id") -> Column:
    return F.pmod(F.xxhash64(source_id), F.lit(BUCKETS)).cast("int")


def stored_versions(spark: SparkSession, path: str, buckets: Sequence[int]) -> DataFrame:
    """Registry rows of the given buckets; other buckets' folders are not read. No folder yet is an empty registry."""
    schema = T.StructType([*schemas.BENCHMARKS.fields, T.StructField("batch_id", T.LongType()), T.StructField("bucket", T.IntegerType())])
    return stored(spark, path, schema).where(F.col("bucket").isin(*buckets))


def decide(entries: DataFrame, held: DataFrame, batch_id: int) -> DataFrame:
    """Actions of one micro-batch against the stored registry, without what an earlier try of the batch stored."""
    known = held.where(F.col("batch_id") != batch_id)
    return registry.refresh_actions(entries.drop("version", "superseded_by"), known, ORDER, F.date_trunc("hour", "inserted_at"))


def versions(actions: DataFrame, held: DataFrame, batch_id: int) -> DataFrame:
    """The accepted entries of a batch as registry rows."""
    accepted = actions.where(F.col("action").isin("add", "supersede"))
    return assign_versions(accepted, ORDER, F.to_date("inserted_at"), prior=held.where(F.col("batch_id") != batch_id))


def refresh_stream(spark: SparkSession, source: str, registry_path: str, actions_path: str, checkpoint: str, max_files: int = 1000) -> StreamingQuery:
    """Apply the conflict policy as files arrive.

    The registry is stored by batch and by a hash of ``source_id``: a batch reads the buckets of its own
    sources only, by partition pruning, whatever the size of the registry. Actions are written first and
    versions derived from what was written, so a batch is read once and nothing is held in memory.

    Arrival order is batch first, then ``inserted_at`` inside a batch: files of one
    trigger are one batch, so a limit on files per trigger is part of the order.
    Each batch overwrites only its own ``batch_id`` folder, so a batch that
    is replayed after a failure leaves one copy. Readers take the highest
    version per source as live, which needs no rewrite of earlier rows.
    """
    def run(entries: DataFrame, batch_id: int) -> None:
        session = entries.sparkSession
        buckets = [r.bucket for r in entries.select(bucket_of().alias("bucket")).distinct().collect()]  # BUCKETS numbers at most
        known = stored_versions(session, registry_path, buckets)
        decided = decide(entries, known, batch_id)
        decided.write.mode("overwrite").parquet(f"{actions_path}/batch_id={batch_id}")
        actions = session.read.schema(decided.schema).parquet(f"{actions_path}/batch_id={batch_id}")
        rows = versions(actions, known, batch_id).select(*schemas.BENCHMARKS.fieldNames(), bucket_of().alias("bucket"))
        rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{registry_path}/batch_id={batch_id}")

    return (
        read_entries(spark, source, max_files).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
