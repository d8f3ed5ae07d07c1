"""Lexical values to typed columns: exact rules, NULL where the text does not fit.

Each function takes the text of one value and returns the typed value, or NULL
if the text is not valid.  `typed` turns such a NULL into an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketlens.plans.catalog import PropertyInfo

INTEGER = r"^-?[0-9]+\z"
DOUBLE = r"^-?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
TIME = r"^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](\.[0-9]+)?\z"
DATETIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](\.[0-9]+)?\z"


def boolean(text: Column) -> Column:
    return F.when(text == "true", True).when(text == "false", False)


def integer(text: Column) -> Column:
    """64-bit, the whole text, no spaces and no plus sign."""
    return F.when(text.rlike(INTEGER), text.try_cast("bigint"))


def double(text: Column) -> Column:
    return F.when(text.rlike(DOUBLE), text.try_cast("double"))


def date(text: Column) -> Column:
    return F.when(text.rlike(DATE), text.try_cast("date"))


def time(text: Column) -> Column:
    return F.when(text.rlike(TIME), text)


def datetime(text: Column) -> Column:
    return F.when(text.rlike(DATETIME), text.try_cast("timestamp_ntz"))


def decimal(text: Column, type_name: str = "") -> Column:
    precision = type_name if type_name.lower().startswith("decimal(") else "decimal(38,10)"
    return F.when(text.rlike(DOUBLE), text.try_cast(precision))


def parsed(prop: PropertyInfo, text: Column, temporal: bool = False) -> Column:
    """Typed value, NULL if the text does not fit the kind.

    Dates, times and decimals stay text unless ``temporal`` is set.
    """
    kind = prop.value_kind
    if kind == "Boolean":
        return boolean(text)
    if kind == "Integer":
        return integer(text)
    if kind == "Double":
        return double(text)
    if temporal and kind == "Date":
        return date(text)
    if temporal and kind == "Time":
        return time(text)
    if temporal and kind == "DateTime":
        return datetime(text)
    if temporal and kind == "Decimal":
        return decimal(text, prop.type_name or "")
    return text


def context(prop: PropertyInfo | None, class_fqn: str) -> Column:
    """Where an error happened: file, TID, BID, class, property."""
    parts = [F.lit("transfer read failed: "), F.col("file")]
    parts += [F.coalesce(F.concat(F.lit(" TID="), F.col("tid")), F.lit(""))]
    parts += [F.coalesce(F.concat(F.lit(" BID="), F.col("bid")), F.lit("")), F.lit(f" class={class_fqn}")]
    if prop is not None:
        parts.append(F.lit(f" property={prop.name}"))
    return F.concat(*parts)


def single(prop: PropertyInfo, values: Column, class_fqn: str) -> Column:
    """The only value, NULL if there is none, an error if there are several."""
    several = F.raise_error(
        F.concat(context(prop, class_fqn), F.lit(" expected one value but found "), F.size(values).cast("string"))
    )
    return F.when(F.size(values) > 1, several).otherwise(F.get(values, F.lit(0)))


def typed(prop: PropertyInfo, values: Column, class_fqn: str, temporal: bool = False) -> Column:
    text = single(prop, values, class_fqn)
    value = parsed(prop, text, temporal)
    kind = prop.value_kind
    if kind in ("String", "Enumeration") or (kind in ("Date", "Time", "DateTime", "Decimal") and not temporal):
        return value
    invalid = F.raise_error(
        F.concat(context(prop, class_fqn), F.lit(f" invalid {kind.lower()} lexical value '"), text, F.lit("'"))
    )
    return F.when(text.isNull() | value.isNotNull(), value).otherwise(invalid)
