"""Exact deduplication by content sort, in DataFrame operations only.

Texts are range-partitioned by sampled splitters, sorted, and equal neighbours
are found by comparing whole texts (the window operator compares each sorted
row's key with the one before it).  The splitters are cut from a short prefix
and a fingerprint, so that the sample which the driver sees stays small
however long texts are; the sort key ends with the whole text.

A text whose copies would fill more than a quarter of a mean partition is
spread over several ranges.  The number of such texts is at most four per
partition, as each has more than a quarter of a partition's rows; their totals
come from a partial aggregation, in which each task sends one row per text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import partitions, row_struct, unpacked
from basketlens.sources.session import cut_lineage

PREFIX = 32
RESULTS = ("keep_id", "group_size", "kept", "text_sha256")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    normalise: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Every row with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Rows are equal when their normalised texts are (default: unchanged text; a
    null text is empty).  The row with the smallest or the largest id stays;
    a null id loses to any other, and of rows with the same id one stays.  Columns of
    ``docs`` with the name of a result are replaced.  An empty table gives an
    empty result.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    spark = docs.sparkSession
    pick = F.max if keep == "largest" else F.min

    def content() -> Column:
        plain = F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit(""))
        return normalise(plain) if normalise else plain

    keyed = docs.select(row_struct(docs).alias("row")).withColumn("print", F.xxhash64(content()))
    n = partitions(spark)
    limit = max(1, docs.count() // (4 * n))
    hot = cut_lineage(
        keyed.groupBy("print").count().filter(F.col("count") > limit)
        .select("print", F.ceil(F.col("count") / limit).alias("pieces")), "dedup-hot")
    totals = cut_lineage(
        keyed.join(F.broadcast(hot), "print").groupBy("print", content().alias("content"))
        .agg(pick(f"row.`{id_col}`").alias("hot_keep"), F.count("*").alias("hot_size"))
        .select(F.col("print").alias("hot_print"), F.sha2("content", 256).alias("hot_sha"), "hot_keep", "hot_size"),
        "dedup-totals")

    salt = F.when(F.col("pieces").isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(F.col(f"row.`{id_col}`")), F.col("pieces"))).cast("long")
    ranged = (
        keyed.join(F.broadcast(hot), "print", "left")
        .select("row", "print", F.substring(content(), 1, PREFIX).alias("prefix"), salt.alias("salt"),
                F.col("pieces").isNotNull().alias("is_hot"))
        .repartitionByRange("prefix", "print", "salt"))
    same = Window.partitionBy("prefix", "print", "salt", content())
    order = F.col(f"row.`{id_col}`")
    first = same.orderBy(order.desc_nulls_last() if keep == "largest" else order.asc_nulls_last())
    found = ranged.select(
        "row", "print", "is_hot", F.sha2(content(), 256).alias("sha"),
        F.first(order).over(first).alias("near_keep"), F.count("*").over(same).alias("near_size"),
        F.row_number().over(first).alias("place"))
    found = found.join(
        F.broadcast(totals),
        F.col("is_hot") & (F.col("print") == F.col("hot_print")) & (F.col("sha") == F.col("hot_sha")), "left")
    keep_id = F.when(F.col("is_hot"), F.col("hot_keep")).otherwise(F.col("near_keep"))
    return unpacked(found, docs.columns, {
        "keep_id": keep_id,
        "group_size": F.when(F.col("is_hot"), F.col("hot_size")).otherwise(F.col("near_size")),
        "kept": order.eqNullSafe(keep_id) & (F.col("place") == 1),
        "text_sha256": F.col("sha"),
    })
