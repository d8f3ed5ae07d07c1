"""Columns and helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketlens.sources.session import cut_lineage

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(name: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(f"`{name}`"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, _UPPER, _LOWER)


def words_of(text: Column) -> Column:
    """Array of the words of a text."""
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def small_batches(spark: SparkSession, most: int = 8 << 20) -> None:
    """Hand texts to Python in Arrow batches of about ``most`` bytes (or one row).

    A setting of the session; it changes no result.  Spark's own bound of 64 MB a batch is held several times over by a task: as
    Arrow vectors in the executor, and in Python as the batch at work and the next one.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_struct(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """All columns of a row in one struct, so that working columns cannot clash with them."""
    return F.struct(*(F.col(f"`{c}`") for c in (df.columns if columns is None else columns)))


def unpacked(df: DataFrame, columns: Iterable[str], results: dict[str, Column]) -> DataFrame:
    """The columns kept in ``row``, then the results; a result replaces a column of the same name."""
    taken = {name.lower() for name in results}
    kept = [F.col(f"row.`{c}`").alias(c) for c in columns if c.lower() not in taken]
    return df.select(*kept, *(value.alias(name) for name, value in results.items()))


def numbered(df: DataFrame, group: str | None, order: list[Column], label: str) -> DataFrame:
    """Add ``rank``: the place of each row (from 0) within its group in the given order.

    ``order`` must start with the group.  Rows are range-partitioned over the
    whole order, so a group with most of the rows spreads over many tasks; what
    is summed up in order is one row for each partition and group.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The position is fixed by writing it: a rerun of the sort could cut the partitions elsewhere.
    placed = cut_lineage(ranged.withColumn("_pos", F.monotonically_increasing_id()), label)
    placed = placed.withColumn("_part", F.shiftright("_pos", 33))
    key = [F.col(group).alias("_group")] if group else [F.lit(0).alias("_group")]
    runs = placed.groupBy("_part", *key).agg(F.min("_pos").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("_part").alias("_run_part"), "_group", "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    same = F.col("_part") == F.col("_run_part")
    if group:
        same = same & F.col(group).eqNullSafe(F.col("_group"))
    joined = placed.join(runs, same)
    return joined.withColumn("rank", F.col("_before") + F.col("_pos") - F.col("_first")).drop(
        "_pos", "_part", "_run_part", "_group", "_first", "_before")
