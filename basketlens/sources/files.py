"""Digests of input files, to see what a job has left alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(file, length, md5): one row per file, told by its content.

    A file is one value here, so it must be smaller than 2 GB; the reader refuses larger ones.
    """
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "length", F.md5("content").alias("md5"))
