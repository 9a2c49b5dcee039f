"""Listing capture as a stream: each publication URL is emitted once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import text as X
from tidemark.operators.listings import anchors

PAGE_SCHEMA = "page_id long, url string, html string"


def read_pages(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    return spark.readStream.schema(PAGE_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(path)


def new_links(pages: DataFrame, seen_for: str | None = None) -> DataFrame:
    """Links not seen before in the stream, joined to the address of their page; mail and script links are none.

    The URL state is kept for ever by default, as a link must be captured once.
    ``seen_for`` bounds it by arrival time instead, where re-capture is fine.
    """
    links = anchors(pages.select(F.col("url").alias("page_url"), "html")).where((F.col("href") != "") & (F.col("title") != "")).select(
        X.absolute_url(F.col("page_url"), F.col("href")).alias("url"), "title").where("url IS NOT NULL")
    if seen_for is None:
        return links.dropDuplicates(["url"])
    return links.withColumn("seen_at", F.current_timestamp()).withWatermark("seen_at", seen_for).dropDuplicatesWithinWatermark(["url"])


def publication_stream(spark: SparkSession, source: str, sink: str, checkpoint: str) -> StreamingQuery:
    return (
        new_links(read_pages(spark, source)).writeStream.format("parquet").option("path", sink)
        .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    )
