"""The model catalog: four tables, and a small driver-side view of one model.

The tables stay DataFrames for the catalog queries.  Building the schema of a
class needs its few rows on the driver before a plan exists, so `Catalog.model`
collects the rows once, behind a check of their number.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.errors import TransferError

MODELS_SCHEMA = "name string, version string, issuer string, language string, ili_version string, seq int"
CLASSES_SCHEMA = (
    "model_name string, topic_name string, class_name string, class_fqn string, kind string, "
    "is_abstract boolean, base_class_fqn string, seq int"
)
PROPERTIES_SCHEMA = (
    "owner_fqn string, property_name string, kind string, value_kind string, type_name string, "
    "is_mandatory boolean, card_min bigint, card_max bigint, is_transient boolean, is_embedded boolean, "
    "target_class_fqn string, min_value double, max_value double, max_len int, "
    "enum_values array<string>, seq int"
)
GEOMETRY_SCHEMA = (
    "owner_fqn string, property_name string, geometry_kind string, coordinate_domain_fqn string, "
    "dimension int, max_overlap_lexical string, line_forms array<string>, "
    "has_custom_line_forms boolean, has_line_attributes boolean"
)
CRS_SCHEMA = "coordinate_domain_fqn string, crs_auth_name string, crs_code string"

TABLE_SCHEMAS = {
    "models": MODELS_SCHEMA,
    "classes": CLASSES_SCHEMA,
    "properties": PROPERTIES_SCHEMA,
    "geometry": GEOMETRY_SCHEMA,
}

# A model is written by people; beyond this many property rows the input is
# not a catalog, and planning from it on the driver is refused.
MAX_PLANNING_ROWS = 200_000

SCALAR_KINDS = ("String", "Boolean", "Integer", "Double", "Date", "Time", "DateTime", "Decimal", "Enumeration")


@dataclass(frozen=True)
class GeometryInfo:
    kind: str
    domain: str | None
    dimension: int
    max_overlap: float | None
    line_forms: tuple[str, ...]
    has_custom_line_forms: bool
    has_line_attributes: bool


@dataclass(frozen=True)
class PropertyInfo:
    name: str
    owner_fqn: str
    kind: str
    value_kind: str
    type_name: str
    is_mandatory: bool
    card_min: int
    card_max: int | None
    is_transient: bool
    is_embedded: bool
    target_class_fqn: str | None
    min_value: float | None
    max_value: float | None
    max_len: int | None
    enum_values: tuple[str, ...]
    geometry: GeometryInfo | None

    @property
    def single(self) -> bool:
        return self.card_max == 1

    @property
    def is_scalar(self) -> bool:
        return self.value_kind in SCALAR_KINDS

    @property
    def is_column(self) -> bool:
        """Whether the property gets a typed column of its own."""
        if not self.single:
            return False
        if self.geometry is not None:
            return True
        return self.is_scalar or self.value_kind == "Reference"


@dataclass(frozen=True)
class ClassInfo:
    model: str
    topic: str
    name: str
    fqn: str
    kind: str
    is_abstract: bool
    base_fqn: str | None
    properties: tuple[PropertyInfo, ...] = field(default=())

    def property(self, name: str) -> PropertyInfo | None:
        return next((p for p in self.properties if p.name == name), None)


class Model:
    """Driver-side view of the catalog: classes by name, with transfer order."""

    def __init__(self, classes: Sequence[ClassInfo]):
        self.classes = {c.fqn: c for c in classes}

    def require_class(self, fqn: str) -> ClassInfo:
        if not fqn:
            raise TransferError("class_name must not be empty")
        if fqn.count(".") < 2:
            raise TransferError(f"class_name must be fully qualified as Model.Topic.Class: {fqn}")
        if fqn not in self.classes:
            raise TransferError(f"class_name is not a model class: {fqn}")
        return self.classes[fqn]

    def find(self, fqn: str | None) -> ClassInfo | None:
        return self.classes.get(fqn) if fqn else None

    def transferred(self) -> list[ClassInfo]:
        """Classes whose objects can stand in a basket."""
        return [c for c in self.classes.values() if c.kind != "STRUCTURE" and not c.is_abstract and c.topic]

    def concrete_structures(self, fqn: str) -> list[ClassInfo]:
        """The structure itself and all its extensions that can hold values."""
        return [c for c in self.classes.values() if not c.is_abstract and fqn in self.ancestors(c.fqn)]

    def ancestors(self, fqn: str) -> list[str]:
        chain: list[str] = []
        current: str | None = fqn
        while current and current not in chain:
            chain.append(current)
            info = self.classes.get(current)
            current = info.base_fqn if info else None
        return chain


def _few(df: DataFrame) -> list:
    rows = df.limit(MAX_PLANNING_ROWS + 1).collect()
    if len(rows) > MAX_PLANNING_ROWS:
        raise TransferError(f"catalog table has more than {MAX_PLANNING_ROWS} rows; it cannot be planned from")
    return rows


class Catalog:
    def __init__(
        self,
        models: DataFrame,
        classes: DataFrame,
        properties: DataFrame,
        geometry: DataFrame,
        crs_map: str | None = None,
        builtin_models: Sequence[str] = (),
    ):
        self.models = models
        self.classes = classes
        self.properties = properties
        self.geometry = geometry
        self.crs_map = crs_map
        self.builtin_models = tuple(builtin_models)
        self.known_ancestors: DataFrame | None = None

    @property
    def spark(self) -> SparkSession:
        return self.classes.sparkSession

    @classmethod
    def from_rows(cls, spark, models=(), classes=(), properties=(), geometry=(), **kwargs) -> "Catalog":
        """A catalog written down in Python, e.g. for a test."""
        return cls(
            spark.createDataFrame(list(models), MODELS_SCHEMA),
            spark.createDataFrame(list(classes), CLASSES_SCHEMA),
            spark.createDataFrame(list(properties), PROPERTIES_SCHEMA),
            spark.createDataFrame(list(geometry), GEOMETRY_SCHEMA),
            **kwargs,
        )

    @classmethod
    def load(cls, spark: SparkSession, sources: Sequence[str], fmt: str = "parquet", **kwargs) -> "Catalog":
        """Read catalog folders; each source holds one subfolder per table.

        Sources listed twice count once, and equal rows of several sources are
        merged.  A missing source is an error.
        """
        paths = sorted({str(s).rstrip("/") for s in sources if s})
        if not paths or any(s is None for s in sources):
            raise TransferError("model sources must be a non-empty list without NULL")
        remote = [p for p in paths if p.startswith(("http://", "https://"))]
        if remote:
            raise TransferError(f"remote model sources are not supported: {remote[0]}")
        tables = {
            name: spark.read.format(fmt).schema(schema).load([f"{p}/{name}" for p in paths]).dropDuplicates()
            for name, schema in TABLE_SCHEMAS.items()
        }
        return cls(**tables, **kwargs)

    def save(self, path: str, fmt: str = "parquet") -> None:
        for name in TABLE_SCHEMAS:
            getattr(self, name).write.format(fmt).mode("errorifexists").save(f"{path}/{name}")

    @cached_property
    def model(self) -> Model:
        """Planning view: the same order as `introspect.transfer_order`, for few rows."""
        heads = _few(self.classes.orderBy("seq"))
        shapes = {
            (r.owner_fqn, r.property_name): GeometryInfo(
                r.geometry_kind, r.coordinate_domain_fqn, r.dimension or 2,
                float(r.max_overlap_lexical) if r.max_overlap_lexical else None,
                tuple(r.line_forms or ()), bool(r.has_custom_line_forms), bool(r.has_line_attributes))
            for r in _few(self.geometry)
        }
        owned: dict[str, list[PropertyInfo]] = {}
        for r in _few(self.properties.orderBy("owner_fqn", "seq")):
            owned.setdefault(r.owner_fqn, []).append(PropertyInfo(
                r.property_name, r.owner_fqn, r.kind, r.value_kind, r.type_name, bool(r.is_mandatory),
                r.card_min or 0, r.card_max, bool(r.is_transient), bool(r.is_embedded), r.target_class_fqn,
                r.min_value, r.max_value, r.max_len, tuple(r.enum_values or ()),
                shapes.get((r.owner_fqn, r.property_name))))
        bare = Model([
            ClassInfo(h.model_name, h.topic_name or "", h.class_name, h.class_fqn, h.kind, bool(h.is_abstract),
                      h.base_class_fqn) for h in heads
        ])

        def ordered(info: ClassInfo) -> tuple[PropertyInfo, ...]:
            found: dict[str, PropertyInfo] = {}
            for owner in reversed(bare.ancestors(info.fqn)):
                kind = bare.classes[owner].kind if owner in bare.classes else "CLASS"
                own = owned.get(owner, [])
                for p in sorted(own, key=lambda p: (p.kind == "ROLE") != (kind == "ASSOCIATION")):
                    found[p.name] = p
            return tuple(found.values())

        return Model([replace(c, properties=ordered(c)) for c in bare.classes.values()])

    def visible_classes(self) -> DataFrame:
        if not self.builtin_models:
            return self.classes
        return self.classes.filter(~F.col("model_name").isin(*self.builtin_models))
