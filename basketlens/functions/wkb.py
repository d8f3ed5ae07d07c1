"""Binary geometries read back into nested parts (parts, rings or points, points with x, y, z)."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from basketlens.errors import TransferError

PARTS = "array<array<array<struct<x:double,y:double,z:double>>>>"
_Line = np.ndarray


class _Cursor:
    """A place in the bytes of one geometry."""

    def __init__(self, data: bytes):
        self.data, self.at, self.order = data, 0, "<"

    def number(self) -> int:
        value, = struct.unpack_from(f"{self.order}I", self.data, self.at)
        self.at += 4
        return value

    def head(self) -> tuple[int, int]:
        """Kind and ordinates a point."""
        if self.data[self.at] > 1:
            raise TransferError(f"not a binary geometry: byte order {self.data[self.at]}")
        self.order = "<" if self.data[self.at] else ">"
        self.at += 1
        code = self.number()
        kind, z = code & 0x0FFFFFFF, bool(code & 0x80000000)
        return kind % 1000, 3 if z or kind // 1000 == 1 else 2

    def points(self, count: int, size: int) -> _Line:
        line = np.frombuffer(self.data, f"{self.order}f8", count * size, self.at).reshape(count, size).astype(float)
        self.at += 8 * count * size
        return np.column_stack([line, np.full(count, np.nan)]) if size == 2 else line

    def geometry(self) -> list[list[_Line]]:
        kind, size = self.head()
        if kind == 1:
            return [[self.points(1, size)]]
        if kind == 2:
            return [[self.points(self.number(), size)]]
        if kind == 3:
            return [[self.points(self.number(), size) for _ in range(self.number())]]
        if kind in (4, 5, 6):
            return [part for _ in range(self.number()) for part in self.geometry()]
        raise TransferError(f"unknown kind of binary geometry: {kind}")


def from_wkb(value: Column) -> Column:
    """Nested parts of a binary geometry in either byte order, with or without third ordinates; NULL stays NULL."""
    @F.arrow_udf(PARTS)
    def read(column: pa.Array) -> pa.Array:
        found = []
        for data in column.to_pylist():
            if data is None:
                found.append(None)
                continue
            cursor = _Cursor(data)
            found.append(cursor.geometry())
            if cursor.at != len(data):
                raise TransferError("binary geometry has bytes behind its end")
        rings = [ring for parts in found for ring in parts or []]
        lines = [line for ring in rings for line in ring]
        xyz = np.concatenate(lines) if lines else np.zeros((0, 3))
        ordinates = [pa.array(xyz[:, k], mask=np.isnan(xyz[:, k]) if k == 2 else None) for k in range(3)]
        points = pa.StructArray.from_arrays(ordinates, names=["x", "y", "z"])

        def nested(sizes: list[int], values: pa.Array, nulls: list[bool] | None = None) -> pa.Array:
            offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            mask = pa.array(nulls) if nulls is not None else None
            return pa.ListArray.from_arrays(pa.array(offsets), values, mask=mask)

        inner = nested([len(ring) for ring in rings], nested([len(line) for line in lines], points))
        return nested([len(parts or []) for parts in found], inner, [parts is None for parts in found])

    return read(value)
