"""Values at a path inside the objects of a class, as lexical text."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.errors import TransferError
from basketlens.operators import nodes
from basketlens.plans.catalog import Catalog, ClassInfo, Model
from basketlens.sources.objects import read_objects
from basketlens.sources.parse import MAX_NESTING, Parser, union_fields

_STEP = re.compile(r"^([A-Za-z_]\w*)(?:\[(\*|[1-9][0-9]*)\])?$")

SCHEMA = "bid string, tid string, class_name string, occurrence int, value string"


@dataclass(frozen=True)
class Step:
    name: str
    index: int | None = None
    every: bool = False


def parse_path(expression: str) -> list[Step]:
    """``A.B[2].C[*]``; an index counts from one, no index means the first value."""
    if not expression:
        raise TransferError("path_expression must not be empty")
    steps = []
    for text in expression.split("."):
        match = _STEP.match(text)
        if match is None:
            raise TransferError(f"invalid path_expression '{expression}'")
        index = match.group(2)
        steps.append(Step(match.group(1), int(index) if index and index != "*" else None, index == "*"))
    return steps


def _select(values: Column, step: Step) -> Column:
    return values if step.every else F.slice(values, step.index or 1, 1)


def _below(values: Column, step: Step) -> Column:
    found = F.transform(values, lambda e: _select(e[step.name], step))
    return F.flatten(F.filter(found, lambda f: f.isNotNull()))


def can_match(model: Model, info: ClassInfo, steps: list[Step]) -> bool:
    """Whether objects of the class can have values at the path, which must be primitive."""
    prop = info.property(steps[0].name)
    for step in steps[1:]:
        members = model.concrete_structures(prop.target_class_fqn) if prop is not None and prop.value_kind == "Structure" else []
        prop = union_fields(members).get(step.name)
    if prop is not None and not prop.is_scalar:
        raise TransferError(f"path target is not primitive: {'.'.join(s.name for s in steps)}")
    return prop is not None


def path_values(parser: Parser, steps: list[Step]) -> Column:
    """``array<string>`` of the matches; the path is no deeper than the reader's schema."""
    values = _select(parser.values(steps[0].name), steps[0])
    for step in steps[1:]:
        values = _below(values, step)
    return values


def read_values(
    spark: SparkSession, path: str, class_name: str, expression: str, catalog: Catalog,
    tid: str | None = None, bid: str | None = None, dialect: str | None = None,
) -> DataFrame:
    """(bid, tid, class_name, occurrence, value): one row per match, in transfer order.

    Objects without TID are skipped, and an object without a match gives no row.
    """
    steps = parse_path(expression)
    if not path:
        raise TransferError("path must not be empty")
    info = catalog.model.require_class(class_name)
    objects = read_objects(spark, path, catalog.model, dialect).filter(
        (F.col("class_fqn") == class_name) & F.col("tid").isNotNull())
    if tid is not None:
        objects = objects.filter(F.col("tid") == tid)
    if bid is not None:
        objects = objects.filter(F.col("bid") == bid)
    if not can_match(catalog.model, info, steps):
        return spark.createDataFrame([], SCHEMA)
    if len(steps) > MAX_NESTING + 1:
        found = nodes.values_at(nodes.node_rows(objects, catalog, [class_name]), steps)
        return found.select("bid", "tid", F.lit(class_name).alias("class_name"), "occurrence", "value")
    parser = Parser(catalog.model, info, dialect, [steps[0].name])
    values = path_values(parser, steps)
    rows = parser.parse(objects).select("bid", "tid", F.posexplode(values).alias("at", "value"))
    return rows.select(
        "bid", "tid", F.lit(class_name).alias("class_name"), (F.col("at") + 1).cast("int").alias("occurrence"), "value")
