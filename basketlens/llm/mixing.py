"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

Each document of a source has the same number of expected copies, target over
size.  The running sum of expected copies over the source's documents starts
at one offset per source, and a document is taken once for each integer that
its part of the sum passes.  Documents are ordered by size, so that every
stretch of sizes is sampled at the same rate and the words taken come close to
the target, then by a hash of their id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import n_words, numbered, row_struct, unpacked
from basketlens.sources.session import cut_lineage

RESULTS = ("size", "source_size", "target", "copies", "taken")


def _hash(value: Column) -> Column:
    """60 bits of a digest as a whole number."""
    return F.conv(F.substring(F.md5(value), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], limit: float) -> DataFrame:
    """Add ``target`` to one row per source (``source``, ``source_size``).

    Weights repeat over the sources in code point order, null last.  Targets
    share the total by weight; one that passes ``limit`` times its source's size
    stops there, and what is left over is shared again by weight until none does.
    """
    ranked = numbered(sizes, None, [F.col("source").asc_nulls_last()], "mix-sources")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    table = cut_lineage(ranked.select("source", "source_size", weight.alias("weight")), "mix-weights")
    bound = F.col("source_size") * float(limit)
    share = 0.0
    stopped_before = -1
    while True:
        over = bound < F.col("weight") * share
        stopped, taken, open_weight, total = table.agg(
            F.count_if(over), F.coalesce(F.sum(F.when(over, bound)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)),
            F.coalesce(F.sum("source_size"), F.lit(0))).first()
        if stopped == stopped_before or not open_weight:
            break
        share, stopped_before = (total - taken) / open_weight, stopped
    return table.select("source", "source_size", F.least(bound, F.col("weight") * share).alias("target"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    limit: float = 3.0,
    seed: str = "mix",
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """Every row with ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` (copies times size).

    ``carry`` names the columns of ``docs`` to return (default: all); one with
    the name of a result is replaced.  A null text has size 0, a null source is
    a source of its own, a source without words has target 0, and repeated rows
    are sampled each for itself.  The same input gives the same mix.  An empty
    table gives an empty result.
    """
    columns = list(docs.columns if carry is None else carry)
    sized = docs.select(
        row_struct(docs, columns).alias("row"), F.col(f"`{source_col}`").alias("source"),
        n_words(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("size"),
        _hash(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))).alias("print"),
        F.col(f"`{id_col}`").alias("id"))
    order = [F.col("source").asc_nulls_last(), F.col("size").desc(), F.col("print"), F.col("id")]
    ranked = numbered(sized, "source", order, "mix-rows")
    targets = source_targets(
        ranked.groupBy("source").agg(F.sum("size").alias("source_size")), weights, limit)

    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = _hash(F.concat(F.lit(f"{seed}/"), F.coalesce(F.col("source"), F.lit("")))) / float(1 << 60)
    targets = targets.select(
        F.col("source").alias("target_source"), "source_size", "target", F.floor(rate).alias("whole"),
        (rate - F.floor(rate)).alias("part"), offset.alias("offset"))
    crossed = (F.floor(F.col("offset") + F.col("part") * (F.col("rank") + 1))
               - F.floor(F.col("offset") + F.col("part") * F.col("rank")))
    copies = F.col("whole") + crossed
    mixed = ranked.join(targets, F.col("source").eqNullSafe(F.col("target_source")))
    return unpacked(mixed, columns, {
        "size": F.col("size"), "source_size": F.col("source_size"), "target": F.col("target"),
        "copies": copies, "taken": copies * F.col("size")})


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row as often as it is taken, with the columns of ``docs``."""
    columns = docs.columns
    whole = docs.select(row_struct(docs).alias("whole_row"), *(
        F.col(f"`{options.get(k, d)}`") for k, d in (
            ("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source"))))
    counted = mix(whole, carry=["whole_row"], **options)
    repeated = counted.withColumn("turn", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(*(F.col(f"whole_row.`{c}`").alias(c) for c in columns))
