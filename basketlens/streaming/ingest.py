"""Incremental ingest: files that arrive in a folder become object rows once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketlens.plans.catalog import Catalog
from basketlens.sources.objects import Tags, objects_of_texts


def stream_objects(
    spark: SparkSession, path: str, catalog: Catalog, dialect: str, max_files_per_trigger: int = 1000
) -> DataFrame:
    """Streaming rows of `read_objects` for the files of a folder, each seen once.

    Cutting is stateless, so there is no state store and nothing to expire.
    """
    texts = (
        spark.readStream.format("text").schema("value string").option("wholetext", True)
        .option("maxFilesPerTrigger", max_files_per_trigger).load(path)
        .select(F.col("_metadata.file_path").alias("file"), F.lit(0).cast("long").alias("block"), "value"))
    return objects_of_texts(texts, Tags(catalog.model, dialect))


def ingest(
    spark: SparkSession, path: str, output: str, checkpoint: str, catalog: Catalog, dialect: str,
) -> StreamingQuery:
    """Append new files' objects to a Parquet table partitioned by class, then stop.

    Run again after new files have arrived: the checkpoint knows what was read.
    """
    rows = stream_objects(spark, path, catalog, dialect)
    return (
        rows.writeStream.format("parquet").partitionBy("class_fqn").option("path", output)
        .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
