"""Geometry expressions over the nested form ``parts``.

``parts`` is ``array<array<array<struct<x,y,z>>>>``: geometry parts, each with
its rings (or one line), each with its points.  A point has one part with one
line of one point.  Everything is a Column expression except the packing of WKB
bytes, for which Spark has no built-in.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from basketlens.functions.rings import why_invalid
from basketlens.functions.typing import DOUBLE

DEFAULT_ARC_TOLERANCE = 0.1

# SQL geometry type and WKB code per model geometry kind.
SQL_TYPES = {
    "COORD": "POINT",
    "MULTICOORD": "MULTIPOINT",
    "POLYLINE": "LINESTRING",
    "DIRECTED_POLYLINE": "LINESTRING",
    "MULTIPOLYLINE": "MULTILINESTRING",
    "DIRECTED_MULTIPOLYLINE": "MULTILINESTRING",
    "SURFACE": "POLYGON",
    "AREA": "POLYGON",
    "MULTISURFACE": "MULTIPOLYGON",
    "MULTIAREA": "MULTIPOLYGON",
}
WKB_CODES = {
    "POINT": 1, "LINESTRING": 2, "POLYGON": 3, "MULTIPOINT": 4, "MULTILINESTRING": 5, "MULTIPOLYGON": 6,
}

_ROOTS = {
    "POINT": "COORD",
    "MULTIPOINT": "MULTICOORD",
    "LINESTRING": "POLYLINE",
    "MULTILINESTRING": "MULTIPOLYLINE",
    "POLYGON": "SURFACE|MULTISURFACE|AREA|MULTIAREA",
    "MULTIPOLYGON": "SURFACE|MULTISURFACE|AREA|MULTIAREA",
}
_KNOWN = "COORD|ARC|C1|C2|C3|A1|A2|R|MULTICOORD|POLYLINE|MULTIPOLYLINE|SURFACE|MULTISURFACE|AREA|MULTIAREA" \
         "|BOUNDARY|EXTERIOR|INTERIOR"
_POINT = "struct<x:double,y:double,z:double>"
PARTS = f"array<array<array<{_POINT}>>>"
DECODED = f"struct<parts:{PARTS},error:string>"


def _elements(text: Column, names: str) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"(?is)<(?:{names})(?:\s[^<>]*)?>.*?</(?:{names})\s*>"), F.lit(0))


def _ordinate(text: Column, name: str) -> Column:
    lexical = F.regexp_extract(text, rf"(?is)<{name}>\s*([^<]*?)\s*</{name}>", 1)
    return F.when(lexical.rlike(DOUBLE), lexical.try_cast("double"))


def _point(x: Column, y: Column, z: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"), z.alias("z"))


def _segments(line: Column) -> Column:
    return F.transform(
        _elements(line, "COORD|ARC"),
        lambda s: F.struct(
            _point(_ordinate(s, "C1"), _ordinate(s, "C2"), _ordinate(s, "C3")).alias("end"),
            F.upper(F.substring(s, 2, 3)).eqNullSafe("ARC").alias("arc"),
            _ordinate(s, "A1").alias("ax"), _ordinate(s, "A2").alias("ay"),
        ),
    )


def stroke_arc(start: Column, ax: Column, ay: Column, end: Column, tolerance: float) -> Column:
    """Points after ``start`` along the arc through (ax, ay) to ``end``.

    Between two points the arc lies at most ``tolerance`` off the chord.  Three
    points on one line give the straight connection over the middle one.
    """
    bx, by, cx, cy = ax - start["x"], ay - start["y"], end["x"] - start["x"], end["y"] - start["y"]
    d = F.lit(2.0) * (bx * cy - by * cx)
    b2, c2 = bx * bx + by * by, cx * cx + cy * cy
    circle = F.struct(((cy * b2 - by * c2) / d).alias("ux"), ((bx * c2 - cx * b2) / d).alias("uy"), d.alias("d"))

    def along(c: Column) -> Column:
        radius = F.sqrt(c["ux"] * c["ux"] + c["uy"] * c["uy"])
        first = F.atan2(-c["uy"], -c["ux"])
        turn = F.atan2(cy - c["uy"], cx - c["ux"]) - first
        # The sign of d tells the side of the middle point, hence the direction.
        sweep = F.when(c["d"] > 0, F.when(turn <= 0, turn + 2 * np.pi).otherwise(turn)).otherwise(
            F.when(turn >= 0, turn - 2 * np.pi).otherwise(turn))
        half_step = F.acos(F.greatest(F.lit(0.0), 1 - F.lit(tolerance) / radius))
        steps = F.greatest(F.lit(1), F.ceil(F.abs(sweep) / (2 * half_step))).cast("int")
        inner = F.when(steps > 1, F.transform(
            F.sequence(F.lit(1), steps - 1),
            lambda k: _point(
                start["x"] + c["ux"] + radius * F.cos(first + sweep * k / steps),
                start["y"] + c["uy"] + radius * F.sin(first + sweep * k / steps),
                start["z"] + (end["z"] - start["z"]) * k / steps,
            ),
        )).otherwise(F.array().cast(f"array<{_POINT}>"))
        return F.concat(inner, F.array(end))

    straight = F.array(_point(ax, ay, (start["z"] + end["z"]) / 2), end)
    # The one-element array binds the centre, which is used many times.
    return F.when(F.abs(d) < 1e-12, straight).otherwise(
        F.flatten(F.transform(F.array(circle), along)))


def _line_points(line: Column, tolerance: float | None) -> Column:
    """Points of a line; without a tolerance only the ends of its segments."""
    if tolerance is None:
        return F.transform(_segments(line), lambda s: s["end"])

    def bound(segments: Column) -> Column:
        straight = F.transform(segments, lambda s: s["end"])
        stroked = F.flatten(F.transform(
            segments,
            lambda s, i: F.when(
                s["arc"] & (i > 0),
                stroke_arc(F.get(segments, i - 1)["end"], s["ax"], s["ay"], s["end"], tolerance),
            ).otherwise(F.array(s["end"])),
        ))
        return F.when(F.exists(segments, lambda s: s["arc"]), stroked).otherwise(straight)

    return F.get(F.transform(F.array(_segments(line)), bound), F.lit(0))


def _ring_points(ring: Column, tolerance: float) -> Column:
    """Points of a ring; joints between several polylines of one ring occur once."""
    points = _line_points(ring, tolerance)
    joined = F.get(F.transform(F.array(points), lambda ps: F.filter(
        ps, lambda p, i: (i == 0) | ~p.eqNullSafe(F.get(ps, i - 1)))), F.lit(0))
    return F.when(F.size(_elements(ring, "POLYLINE")) > 1, joined).otherwise(points)


def decode(
    raw: Column, kind: str, dimension: int = 2, tolerance: float | None = DEFAULT_ARC_TOLERANCE
) -> Column:
    """``struct<parts, error>`` of the inner XML of a geometry value.

    ``tolerance`` None leaves arcs as straight lines, which is enough to check.
    """
    sql_type = SQL_TYPES[kind]
    text = F.regexp_replace(raw, r"<(/?)[\w.-]+:", "<$1")

    def rings(surface: Column) -> Column:
        return F.transform(
            _elements(surface, "BOUNDARY|EXTERIOR|INTERIOR"), lambda r: _ring_points(r, tolerance))

    def build(t: Column) -> Column:
        if sql_type in ("POINT", "MULTIPOINT"):
            return F.transform(_elements(t, "COORD"), lambda c: F.array(_line_points(c, None)))
        if sql_type in ("LINESTRING", "MULTILINESTRING"):
            return F.transform(_elements(t, "POLYLINE"), lambda p: F.array(_line_points(p, tolerance)))
        return F.transform(_elements(t, "SURFACE|AREA"), rings)

    def checked(t: Column) -> Column:
        return F.get(F.transform(
            F.array(build(t)),
            lambda parts: F.struct(parts.alias("parts"), _diagnostic(t, parts, kind, dimension).alias("error")),
        ), F.lit(0))

    result = F.get(F.transform(F.array(text), checked), F.lit(0))
    bound = F.get(F.transform(F.array(result), lambda g: F.struct(
        F.when(g["error"].isNull(), g["parts"]).alias("parts"), g["error"].alias("error"))), F.lit(0))
    return F.when(raw.isNotNull(), bound)


def _diagnostic(text: Column, parts: Column, kind: str, dimension: int) -> Column:
    """First structural fault of a geometry, NULL if there is none."""
    sql_type = SQL_TYPES[kind]
    root = F.upper(F.regexp_extract(text, r"^\s*<([\w.-]+)", 1))
    unsupported = F.upper(F.regexp_extract(text, rf"(?i)<(?!/|(?:{_KNOWN})[\s>/])([\w.-]+)", 1))
    bad_arc = F.exists(
        _elements(text, "ARC"), lambda a: _ordinate(a, "A1").isNull() | _ordinate(a, "A2").isNull())
    bad_point = any_point(parts, lambda p: p["x"].isNull() | p["y"].isNull() | (
        p["z"].isNull() if dimension == 3 else F.lit(False)))
    fault = (
        F.when(root == "", "geometry value is not an object")
        .when(F.instr(F.upper(text), "<LINEATTR") > 0, "line attributes are not supported")
        .when(F.instr(F.upper(text), "<CLIPPED") > 0, "clipped geometry is not supported")
        .when(unsupported != "", F.concat(F.lit("unsupported geometry element "), unsupported))
        .when(~root.rlike(f"^(?:{_ROOTS[sql_type]})$"), F.concat(F.lit(f"expected {kind} but found "), root))
        .when(F.size(parts) == 0, f"{kind} has no coordinates")
    )
    if not sql_type.startswith("MULTI"):
        fault = fault.when(F.size(parts) > 1, f"{kind} has more than one part")
    if sql_type in ("POINT", "MULTIPOINT"):
        fault = fault.when(any_line(parts, lambda l: F.size(l) == 0), f"{kind} has no coordinates")
    fault = fault.when(bad_arc, "ARC requires a numeric intermediate point").when(
        bad_point, f"{kind} has a missing or non-numeric ordinate")
    if "LINESTRING" in sql_type:
        fault = fault.when(any_line(parts, lambda l: F.size(l) < 2), "POLYLINE requires at least two coordinates")
    if "POLYGON" in sql_type:
        fault = (
            fault.when(F.exists(parts, lambda rings: F.size(rings) == 0), f"{kind} has no boundary")
            .when(any_line(parts, lambda l: F.size(l) < 4), "ring requires at least four coordinates")
            .when(any_line(parts, lambda l: ~ring_closed(l)), "ring is not closed")
        )
    return fault


def any_line(parts: Column, test) -> Column:
    return F.exists(parts, lambda rings: F.exists(rings, test))


def any_point(parts: Column, test) -> Column:
    return any_line(parts, lambda line: F.exists(line, test))


def ring_closed(line: Column) -> Column:
    first, last = F.get(line, F.lit(0)), F.element_at(line, -1)
    return (first["x"] == last["x"]) & (first["y"] == last["y"])


# ------------------------------------------------------------------- measures

def points(parts: Column) -> Column:
    """All points as one array, in order."""
    return F.flatten(F.flatten(parts))


def num_points(parts: Column) -> Column:
    return F.size(points(parts))


def num_geometries(parts: Column) -> Column:
    return F.size(parts)


def num_interior_rings(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0), lambda n, rings: n + F.size(rings) - 1)


def has_z(parts: Column) -> Column:
    return any_point(parts, lambda p: p["z"].isNotNull())


def x(parts: Column) -> Column:
    return F.get(points(parts), F.lit(0))["x"]


def y(parts: Column) -> Column:
    return F.get(points(parts), F.lit(0))["y"]


def z(parts: Column) -> Column:
    return F.get(points(parts), F.lit(0))["z"]


def bounds(parts: Column) -> Column:
    """``struct<min_x, min_y, max_x, max_y>``."""
    ps = points(parts)
    xs, ys = F.transform(ps, lambda p: p["x"]), F.transform(ps, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("min_x"), F.array_min(ys).alias("min_y"),
        F.array_max(xs).alias("max_x"), F.array_max(ys).alias("max_y"))


def _edges(line: Column) -> Column:
    """``array<struct<a, b>>``: consecutive points of a line."""
    return F.arrays_zip(
        F.slice(line, F.lit(1), F.size(line) - 1).alias("a"), F.slice(line, F.lit(2), F.size(line) - 1).alias("b"))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def line_length(line: Column) -> Column:
    return _sum(F.transform(_edges(line), lambda e: F.hypot(e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"])))


def length(parts: Column) -> Column:
    return _sum(F.transform(F.flatten(parts), line_length))


def ring_area(line: Column) -> Column:
    """Shoelace area, taken relative to the first point to keep digits."""
    origin = F.get(line, F.lit(0))
    twice = _sum(F.transform(_edges(line), lambda e: (
        (e["a"]["x"] - origin["x"]) * (e["b"]["y"] - origin["y"])
        - (e["b"]["x"] - origin["x"]) * (e["a"]["y"] - origin["y"]))))
    return F.abs(twice) / 2


def area(parts: Column) -> Column:
    """Outer ring less the inner rings, over all parts."""
    return _sum(F.transform(parts, lambda rings: _sum(
        F.transform(rings, lambda r, i: F.when(i == 0, ring_area(r)).otherwise(-ring_area(r))))))


def distance_to_point(parts: Column, px: Column, py: Column, polygonal: bool = False) -> Column:
    """Distance of a geometry to a point; inside a polygon it is 0."""
    def to_edge(e: Column) -> Column:
        dx, dy = e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]
        len2 = dx * dx + dy * dy
        t = F.when(len2 == 0, 0.0).otherwise(
            F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - e["a"]["x"]) * dx + (py - e["a"]["y"]) * dy) / len2)))
        return F.hypot(e["a"]["x"] + t * dx - px, e["a"]["y"] + t * dy - py)

    def to_line(line: Column) -> Column:
        only = F.get(line, F.lit(0))
        return F.when(F.size(line) == 1, F.hypot(only["x"] - px, only["y"] - py)).otherwise(
            F.array_min(F.transform(_edges(line), to_edge)))

    nearest = F.array_min(F.transform(F.flatten(parts), to_line))
    return F.when(contains_point(parts, px, py), 0.0).otherwise(nearest) if polygonal else nearest


def contains_point(parts: Column, px: Column, py: Column) -> Column:
    """Even-odd test over all rings of a part."""
    def crossings(line: Column) -> Column:
        return F.size(F.filter(_edges(line), lambda e: (
            ((e["a"]["y"] > py) != (e["b"]["y"] > py))
            & (px < (e["b"]["x"] - e["a"]["x"]) * (py - e["a"]["y"]) / (e["b"]["y"] - e["a"]["y"]) + e["a"]["x"]))))

    return F.exists(parts, lambda rings: F.aggregate(
        rings, F.lit(0), lambda n, r: n + crossings(r)) % 2 == 1)


def is_valid(parts: Column, kind: str) -> Column:
    """Rings closed with four points and without self-contact, inner rings inside the outer one and apart, parts apart.

    `rings.why_invalid` names the rule.  Not checked: whether the interior is connected.
    """
    if "POLYGON" not in SQL_TYPES[kind]:
        return F.when(parts.isNotNull(), True)
    return F.when(parts.isNotNull(), why_invalid(parts).isNull())


# ---------------------------------------------------------------- text, binary

def _number(value: Column) -> Column:
    """Shortest plain decimal text of a double."""
    text = value.cast("string")
    plain = F.regexp_replace(value.cast("decimal(38,15)").cast("string"), r"\.?0+$", "")
    return F.when(text.contains("E"), F.when(value.cast("decimal(38,15)").isNull() | (plain == "0"), text)
                  .otherwise(plain)).otherwise(F.regexp_replace(text, r"\.0$", ""))


def as_text(parts: Column, kind: str) -> Column:
    """Well-known text, with Z where a third ordinate is present."""
    sql_type = SQL_TYPES[kind]

    def point(p: Column) -> Column:
        return F.concat_ws(" ", _number(p["x"]), _number(p["y"]), _number(p["z"]))

    def listed(items: Column, each) -> Column:
        return F.concat(F.lit("("), F.array_join(F.transform(items, each), ", "), F.lit(")"))

    def line(l: Column) -> Column:
        return listed(l, point)

    first = F.get(parts, F.lit(0))
    body = {
        "POINT": lambda: line(F.get(first, F.lit(0))),
        "LINESTRING": lambda: line(F.get(first, F.lit(0))),
        "POLYGON": lambda: listed(first, line),
        "MULTIPOINT": lambda: listed(F.flatten(parts), lambda l: point(F.get(l, F.lit(0)))),
        "MULTILINESTRING": lambda: listed(F.flatten(parts), line),
        "MULTIPOLYGON": lambda: listed(parts, lambda rings: listed(rings, line)),
    }[sql_type]()
    tag = F.when(has_z(parts), f"{sql_type} Z ").otherwise(f"{sql_type} ")
    return F.when(parts.isNotNull(), F.concat(tag, body))


def as_wkb(parts: Column, kind: str) -> Column:
    """Little-endian ISO WKB."""
    return _wkb_packer(SQL_TYPES[kind])(parts)


def _wkb_packer(sql_type: str):
    code = WKB_CODES[sql_type]

    @F.arrow_udf("binary")
    def pack(parts: pa.Array) -> pa.Array:
        part_at = parts.offsets.to_numpy()
        rings = parts.values
        ring_at = rings.offsets.to_numpy()
        lines = rings.values
        line_at = lines.offsets.to_numpy()
        ordinates = lines.values.flatten()
        xyz = np.column_stack([o.to_numpy(zero_copy_only=False).astype("<f8") for o in ordinates])
        valid = parts.is_valid().to_numpy(zero_copy_only=False)

        def header(kind_code: int, z: bool) -> bytes:
            return struct.pack("<BI", 1, kind_code + (1000 if z else 0))

        def coords(i: int, z: bool) -> bytes:
            return np.ascontiguousarray(xyz[line_at[i]:line_at[i + 1], : 3 if z else 2]).tobytes()

        def counted(i: int, z: bool) -> bytes:
            return struct.pack("<I", line_at[i + 1] - line_at[i]) + coords(i, z)

        def polygon(p: int, z: bool) -> bytes:
            first, last = ring_at[p], ring_at[p + 1]
            return header(3, z) + struct.pack("<I", last - first) + b"".join(counted(i, z) for i in range(first, last))

        out = []
        for g in range(len(parts)):
            if not valid[g]:
                out.append(None)
                continue
            p0, p1 = part_at[g], part_at[g + 1]
            l0, l1 = ring_at[p0], ring_at[p1]
            z = bool(l1 > l0 and line_at[l1] > line_at[l0] and not np.isnan(xyz[line_at[l0], 2]))
            if code == 1:
                out.append(header(1, z) + coords(l0, z))
            elif code == 2:
                out.append(header(2, z) + counted(l0, z))
            elif code == 3:
                out.append(polygon(p0, z))
            else:
                body = {
                    4: lambda: [header(1, z) + coords(i, z) for i in range(l0, l1)],
                    5: lambda: [header(2, z) + counted(i, z) for i in range(l0, l1)],
                    6: lambda: [polygon(p, z) for p in range(p0, p1)],
                }[code]()
                out.append(header(code, z) + struct.pack("<I", len(body)) + b"".join(body))
        return pa.array(out, pa.binary())

    return pack
