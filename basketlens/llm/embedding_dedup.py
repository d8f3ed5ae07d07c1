"""Vectors that point nearly the same way: learnt binary codes, Hamming tables, cosines of what meets there.

**Codes.**  Iterative quantisation on a sample: principal axes, then a rotation that alternates between the nearest binary
codes and the rotation that fits them best; each bit is cut at its median, so that codes are balanced.  Several
rotations from other starts lengthen the code.

**Tables.**  The code is cut into tables of ``width`` bits; two vectors meet where a whole piece agrees.  The width follows
from the number of rows, the number of tables from pairs made at the wanted cosine: tables are added until
``target`` of these pairs meet.  Of vectors that meet, those within the radius of such pairs (over the whole code) are compared
by the cosine of the original vectors in double precision.  A pair counts in the first table that it shares.

**Hot groups.**  Dense spots of the sample are pivots.  Vectors within half the angle of a pivot (its core) are linked with each
other for certain, by the triangle inequality, so a core is counted and not compared, however large it is.
A core meets only vectors within one and a half times the angle of its pivot.  Any other cell of more than
``BLOCK`` vectors is cut into blocks that meet pairwise in separate tasks.  No pairs are written, only counts and one link per vector.

Vectors of another length than the commonest share one cell per length, which is compared whole.  A null or empty vector, a zero
vector, and one with null or non-finite components link with nothing.  Rows are vectors: equal rows and rows with one id link with each
other; the least id of a component names it, nulls apart.  An empty table gives an empty result.  Other columns stay, one
named like a result is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import row_struct, unpacked
from basketlens.llm.components import components
from basketlens.sources.session import cut_lineage

RESULTS = ("n_links", "component_id", "kept")
#: Vectors that the rotations and pivots are learnt from (by hash of the row), and pairs that set tables and radius.
SAMPLE, PAIRS = 8192, 2048
#: Vectors of a bucket, on average; bits of a code at least; tables at most (a narrower one is taken beyond).
BUCKET, BITS, TABLES = 256, 128, 64
#: Sample vectors within half the angle that make a pivot.
DENSE = 8
#: Vectors of a block of a large cell.
BLOCK = 1024
#: Cells of more than a block that are broadcast at most; more are joined.
CELLS = 1 << 16
_EDGE = 1e-7


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, in double precision; no row is zero."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


# ---------------------------------------------------------------- learning

def rotation(spread: np.ndarray, rng: np.random.Generator, rounds: int = 30) -> np.ndarray:
    """A rotation that brings rows near the corners of a cube."""
    turn, _ = np.linalg.qr(rng.standard_normal((spread.shape[1], spread.shape[1])))
    for _ in range(rounds):
        corners = np.where(spread @ turn >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(corners.T @ spread)
        turn = right.T @ left.T
    return turn


class Coder(NamedTuple):
    """Bits are ``vectors @ axes >= cuts``; table ``t`` is the bits from ``t * width`` on."""

    dims: int
    axes: np.ndarray
    cuts: np.ndarray
    width: int
    tables: int
    radius: int
    pivots: np.ndarray
    core_cosine: float
    halo_cosine: float

    def bits(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.axes >= self.cuts


def pivots_of(sample: np.ndarray, core_cosine: float) -> np.ndarray:
    """Mean directions of dense spots; each has ``DENSE`` vectors of its own within the angle."""
    small = sample.astype(np.float32)
    crowd = np.concatenate([(small[first:first + 1024] @ small.T >= core_cosine).sum(axis=1) for first in range(0, len(small), 1024)])
    free = np.ones(len(sample), dtype=bool)
    found = []
    for i in np.argsort(-crowd, kind="stable")[:int((crowd >= DENSE).sum())]:
        if not free[i]:
            continue
        own = free & (sample @ sample[i] >= core_cosine)
        if own.sum() >= DENSE:
            centre = sample[own].mean(axis=0)
            centre /= np.linalg.norm(centre)
            covered = sample @ centre >= core_cosine
            if (covered & free).sum() >= DENSE:
                found.append(centre)
                free &= ~covered
    return np.array(found).reshape(len(found), sample.shape[1])


def _made_pairs(sample: np.ndarray, cosine: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Sample vectors and partners at the wanted cosine, half of them towards other sample vectors, half anywhere."""
    x = sample[rng.integers(0, len(sample), PAIRS)]
    away = rng.standard_normal(x.shape)
    away[::2] = sample[rng.integers(0, len(sample), len(away[::2]))] + 1e-3 * away[::2]
    away -= (away * x).sum(axis=1, keepdims=True) * x
    length = np.linalg.norm(away, axis=1, keepdims=True)
    away = np.divide(away, length, out=np.zeros_like(away), where=length > 1e-12)
    return x, cosine * x + math.sqrt(1 - cosine * cosine) * away


def fit(sample: np.ndarray, rows: int, cosine: float, target: float) -> Coder:
    """Codes and tables for ``rows`` vectors like those of the sample (unit vectors)."""
    rng = np.random.default_rng(11)
    angle = math.acos(cosine)
    core, halo = math.cos(angle / 2 - _EDGE), math.cos(min(math.pi, 1.5 * angle + _EDGE))
    mean = sample.mean(axis=0)
    values, axes = np.linalg.eigh(np.cov((sample - mean).T, bias=True).reshape(sample.shape[1], -1))
    keep = [i for i in np.argsort(-values)[:BITS] if values[i] > 1e-9 * max(values.max(), 1e-12)]
    axes = axes[:, keep]
    spread = (sample - mean) @ axes
    parts: list[np.ndarray] = []
    left, right = _made_pairs(sample, cosine, rng)

    def differ(n_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Axes, cuts and which of the first bits differ in each made pair; rotations are learnt as they are needed."""
        while sum(p.shape[1] for p in parts) < n_bits:
            parts.append(axes @ rotation(spread, rng))
        all_axes = np.hstack(parts)[:, :n_bits]
        cuts = np.median(sample @ all_axes, axis=0)
        return all_axes, cuts, (left @ all_axes >= cuts) != (right @ all_axes >= cuts)

    width = max(0, math.ceil(math.log2(max(rows, 1) / BUCKET))) if keep else 0
    while True:
        tables = 1
        while width and tables < TABLES:
            _, _, flips = differ(tables * width)
            if (~flips.reshape(PAIRS, tables, width).any(axis=2)).any(axis=1).mean() >= target:
                break
            tables += 1
        else:
            if width:
                width -= 1
                continue
        break
    if not keep:
        none = np.zeros((sample.shape[1], 0))
        return Coder(sample.shape[1], none, np.zeros(0), 0, 1, 0, pivots_of(sample, core), core, halo)
    all_axes, cuts, flips = differ(max(BITS, tables * width))
    count = flips.sum(axis=1)
    radius = math.ceil(count.mean() + 6 * count.std()) + 1
    return Coder(sample.shape[1], all_axes, cuts, width, tables, radius, pivots_of(sample, core), core, halo)


# ---------------------------------------------------------------- inside a task

def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values end to end and the lengths of a list column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat, np.diff(column.offsets.to_numpy())


def _code_batch(batch: pa.RecordBatch, coder: Coder) -> pa.RecordBatch:
    """``rid, core, code, keys, halos`` of vectors; ``keys`` name the cells of each table."""
    flat, lengths = _vectors(batch.column(1))
    n = len(lengths)
    starts = np.concatenate(([0], np.cumsum(lengths)))
    usual = np.flatnonzero(lengths == coder.dims)
    cores = np.full(n, -1, dtype=np.int32)
    codes: list[bytes] = [b""] * n
    keys: list[np.ndarray | list[int]] = [[-int(length)] for length in lengths]
    halos: list[list[int]] = [[] for _ in range(n)]
    if len(usual):
        vectors = unit(flat[(starts[usual][:, None] + np.arange(coder.dims)).ravel()].reshape(-1, coder.dims))
        bits = coder.bits(vectors)
        packed = np.packbits(bits, axis=1)
        pieces = bits[:, :coder.tables * coder.width].reshape(len(usual), coder.tables, coder.width)
        value = pieces @ (1 << np.arange(coder.width, dtype=np.int64)) + (np.arange(coder.tables, dtype=np.int64) << 40)
        for i, row, own in zip(usual, packed, value, strict=True):
            codes[i], keys[i] = row.tobytes(), own
        if len(coder.pivots):
            near = vectors @ coder.pivots.T
            best = near.argmax(axis=1)
            inside = near[np.arange(len(usual)), best] >= coder.core_cosine
            cores[usual[inside]] = best[inside]
            for at, pivot in zip(*np.nonzero(near >= coder.halo_cosine), strict=True):
                own = cores[usual[at]]
                # Two cores meet in the cells of the first.
                if own < 0 or pivot < own:
                    halos[usual[at]].append(int(pivot))
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(cores), pa.array(codes, type=pa.binary()),
         pa.array(keys, type=pa.list_(pa.int64())), pa.array(halos, type=pa.list_(pa.int32()))],
        names=["rid", "core", "code", "keys", "halos"])


def _cells(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole cells and where each cell begins (and the end); rows come sorted by ``names``."""
    held: list[pa.RecordBatch] = []

    def bounds(table: pa.Table) -> np.ndarray:
        new = np.zeros(len(table), dtype=bool)
        new[:1] = True
        for name in names:
            value = table.column(name).to_numpy()
            new[1:] |= value[1:] != value[:-1]
        return np.append(np.flatnonzero(new), len(table))

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        last = [batch.column(n)[-1] for n in names]
        if len(held) > 1 and all(held[0].column(n)[0] == v for n, v in zip(names, last, strict=True)):
            continue  # still inside one cell
        table = pa.Table.from_batches(held)
        at = bounds(table)
        if len(at) > 2:
            yield table.slice(0, at[-2]), at[:-1]
        held = table.slice(at[-2]).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, bounds(table)


def _matrix(codes: pa.ChunkedArray, size: int) -> np.ndarray:
    """Codes of one length as rows of bytes, padded to words."""
    data = np.frombuffer(b"".join(codes.to_pylist()), dtype=np.uint8).reshape(len(codes), size)
    return np.pad(data, ((0, 0), (0, -size % 8)))


def _first_shared(differ: np.ndarray, table: int, coder: Coder) -> np.ndarray:
    """Of pairs that agree in a table (rows: bytes of the codes' difference): whether they agree in no earlier one."""
    if not table:
        return np.ones(len(differ), dtype=bool)
    bits = np.unpackbits(differ, axis=1, count=table * coder.width)
    return bits.reshape(len(differ), table, coder.width).any(axis=2).all(axis=1)


def _meet(side: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which pairs are compared: 0 meets 0, and 1 meets 2."""
    return (side[x] == 0) | (side[x] != side[y])


def _near_in_cells(table: pa.Table, at: np.ndarray, coder: Coder) -> np.ndarray:
    """The rows that have a partner within the radius in their cell, in the first table that both share."""
    n = len(table)
    side, key = table.column("side").to_numpy(), table.column("key").to_numpy()
    use = np.zeros(n, dtype=bool)
    sizes = np.diff(at)
    plain = key >= 0  # others have no code: all of a cell are compared
    use[~plain] = np.repeat(sizes > 1, sizes)[~plain]
    rows = np.flatnonzero(plain)
    if not len(rows) or not coder.axes.shape[1]:
        use[plain] = np.repeat(sizes > 1, sizes)[plain]
        return use
    width = (coder.axes.shape[1] + 7) // 8
    codes = np.zeros((n, -(-width // 8) * 8), dtype=np.uint8)
    codes[rows] = _matrix(table.column("code").filter(pa.array(plain)), width)
    words = codes.view(np.uint64)

    def take(x: np.ndarray, y: np.ndarray) -> None:
        """Pairs of rows of one cell."""
        meet = _meet(side, x, y)
        x, y = x[meet], y[meet]
        for first in range(0, len(x), 1 << 17):
            a, b = x[first:first + (1 << 17)], y[first:first + (1 << 17)]
            near = np.bitwise_count(words[a] ^ words[b]).sum(axis=1, dtype=np.int64) <= coder.radius
            a, b = a[near], b[near]
            for number in np.unique(key[a] >> 40):
                own = key[a] >> 40 == number
                i, j = a[own], b[own]
                fresh = _first_shared(codes[i] ^ codes[j], int(number), coder)
                use[i[fresh]] = use[j[fresh]] = True

    cell = np.repeat(np.arange(len(sizes)), sizes)
    small = np.repeat(sizes <= 64, sizes) & plain
    for step in range(1, 64):
        x = np.flatnonzero(small[:-step] & (cell[:-step] == cell[step:])) if n > step else rows[:0]
        if not len(x):
            break
        take(x, x + step)
    for c in np.flatnonzero(sizes > 64):
        if plain[at[c]]:
            own = np.arange(at[c], at[c + 1])
            left, right = own[side[own] != 2], own[side[own] != 1]
            for first in range(0, len(left), 128):
                x, y = np.meshgrid(left[first:first + 128], right, indexing="ij")
                ahead = (x < y) | (side[x] != 0)
                take(x[ahead], y[ahead])
    return use


def _link_cells(table: pa.Table, at: np.ndarray, coder: Coder, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each cell: rows with a link, a row each is connected with, and its number of links there."""
    rid, side, key = (table.column(n).to_numpy() for n in ("rid", "side", "key"))
    flat, lengths = _vectors(table.column("embedding"))
    starts = np.concatenate(([0], np.cumsum(lengths)))
    codes = table.column("code")
    for first, end in zip(at[:-1], at[1:], strict=True):
        if end - first < 2:
            continue
        vectors = unit(flat[starts[first]:starts[end]].reshape(end - first, -1))
        ids, sides = rid[first:end], side[first:end]
        left, right = np.flatnonzero(sides != 2), np.flatnonzero(sides != 1)
        if not len(left) or not len(right):
            continue
        i, j = np.nonzero(vectors[left] @ vectors[right].T >= cosine)
        i, j = left[i], right[j]
        ahead = (i < j) | (sides[i] != 0)
        i, j = i[ahead], j[ahead]
        number = int(key[first] >> 40)
        if number > 0 and len(i):
            packed = _matrix(codes.slice(first, end - first), len(codes[first].as_py()))
            fresh = np.concatenate([_first_shared(packed[i[k:k + (1 << 17)]] ^ packed[j[k:k + (1 << 17)]], number, coder)
                                    for k in range(0, len(i), 1 << 17)])
            i, j = i[fresh], j[fresh]
        if not len(i):
            continue
        links = np.bincount(i, minlength=len(ids)) + np.bincount(j, minlength=len(ids))
        root = ids.copy()
        while True:  # the least row number spreads over links
            before = root.copy()
            np.minimum.at(root, i, before[j])
            np.minimum.at(root, j, before[i])
            if (root == before).all():
                break
        some = np.flatnonzero(links)
        yield ids[some], root[some], links[some]


# ---------------------------------------------------------------- Spark

def _learn(vectors: DataFrame, cosine: float, target: float) -> Coder | None:
    """The coder of the commonest length (the shorter one of equals); None without a vector."""
    lengths = vectors.filter("dims IS NOT NULL").groupBy("dims").count().orderBy(F.col("count").desc(), "dims").limit(1).collect()
    if not lengths:
        return None
    dims, rows = lengths[0]
    drawn = (vectors.filter(F.col("dims") == dims).select("rid", "embedding").orderBy(F.xxhash64("rid"), "rid").limit(SAMPLE))
    table = drawn.toArrow()
    return fit(unit(_vectors(table.column("embedding"))[0].reshape(-1, dims)), rows, cosine, target)


def _entries(codes: DataFrame) -> DataFrame:
    """``key, cell, x, y, side, rid, code``: a row per vector and meeting."""
    # A core that is in nobody's halo has nothing to compare; pivots are at most a sample's number over DENSE.
    visited = codes.select(F.explode("halos").alias("visited")).distinct()
    alone = codes.filter("core < 0").select("rid", "code", "keys", F.lit(-1).alias("cell"), F.lit(0).alias("side"))
    hosts = codes.join(F.broadcast(visited), F.col("core") == F.col("visited")).select(
        "rid", "code", "keys", F.col("core").alias("cell"), F.lit(1).alias("side"))
    own = alone.union(hosts).select("rid", "code", F.explode("keys").alias("key"), "cell", "side")
    guests = codes.filter(F.size("halos") > 0).select(
        "rid", "code", F.explode("keys").alias("key"), "halos").select(
        "rid", "code", "key", F.explode("halos").alias("cell"), F.lit(2).alias("side"))
    entries = own.union(guests)
    crowd = cut_lineage(
        entries.groupBy("key", "cell").agg(F.sum((F.col("side") != 2).cast("int")).alias("left"),
                                           F.sum((F.col("side") != 1).cast("int")).alias("right"))
        .filter(f"left > {BLOCK} OR right > {BLOCK}")
        .select(F.col("key").alias("of"), F.col("cell").alias("of_cell"),
                F.ceil(F.col("left") / BLOCK).cast("int").alias("rows"), F.ceil(F.col("right") / BLOCK).cast("int").alias("columns")),
        "embedding-cells")
    if crowd.count() <= CELLS:
        crowd = F.broadcast(crowd)
    wide = entries.join(crowd, (F.col("key") == F.col("of")) & (F.col("cell") == F.col("of_cell")), "left")
    rows, columns = F.greatest("rows", F.lit(1)), F.greatest("columns", F.lit(1))
    slot = F.pmod(F.xxhash64("rid"), F.when(F.col("side") == 2, columns).otherwise(rows)).cast("int")

    def meeting(x, y, side):
        return F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"), side.cast("int").alias("side"))

    # Block b of a cell without core meets itself and, once, every other block.
    among = F.transform(F.sequence(F.lit(0), rows - 1), lambda z: meeting(
        F.least(z, slot), F.greatest(z, slot), F.when(z < slot, 2).when(z == slot, 0).otherwise(1)))
    placed = (F.when(F.col("side") == 0, among)
              .when(F.col("side") == 1, F.transform(F.sequence(F.lit(0), columns - 1), lambda z: meeting(slot, z, F.lit(1))))
              .otherwise(F.transform(F.sequence(F.lit(0), rows - 1), lambda z: meeting(z, slot, F.lit(2)))))
    return wide.select("key", "cell", F.explode(placed).alias("at"), "rid", "code").select(
        "key", "cell", "at.x", "at.y", "at.side", "rid", "code")


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = 0.95,
    target: float = 0.98,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """Every row with ``n_links``, ``component_id`` and ``kept`` (whether the row's id names its component).

    ``target`` is the share of pairs at exactly ``cosine`` that the tables must bring together; closer pairs meet more often.
    ``carry`` names the columns to return (default: all).
    """
    if not 0.5 <= cosine < 1:
        raise ValueError("cosine lies between 0.5 and 1")
    spark = vectors.sparkSession
    columns = list(vectors.columns if carry is None else carry)
    value = F.col("embedding")
    odd = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(value, lambda x: x != 0)
    # The row number is fixed by writing it.
    table = vectors.select(row_struct(vectors, columns).alias("row"), F.col(f"`{id_col}`").alias("id"),
                           F.col(f"`{vector_col}`").alias("embedding"))
    kept = [c for c in columns if c != vector_col]
    table = cut_lineage(table.select(
        F.monotonically_increasing_id().alias("rid"), "id", "embedding",
        F.struct(*(F.col(f"row.`{c}`") for c in kept)).alias("row") if kept else F.lit(None).cast("int").alias("row"),
        F.when(some & ~odd, F.size("embedding")).alias("dims")), "embedding-rows")
    coder = _learn(table, cosine, target)
    if coder is None:
        links = spark.createDataFrame([], "rid long, links long, component long")
    else:
        links = _linked(table.filter("dims IS NOT NULL").select("rid", "embedding"), coder, cosine)
    joined = table.join(links, "rid", "left")
    least = joined.filter("component IS NOT NULL").groupBy("component").agg(F.min("id").alias("least"))
    joined = joined.join(least, "component", "left")
    component = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("least"))
    whole = joined.withColumn("row", F.struct(*(
        F.col("embedding").alias(c) if c == vector_col else F.col(f"row.`{c}`").alias(c) for c in columns))) if columns else joined
    return unpacked(whole, columns, {
        "n_links": F.coalesce("links", F.lit(0)).cast("long"),
        "component_id": component,
        "kept": F.col("id").eqNullSafe(component),
    })


def _linked(vectors: DataFrame, coder: Coder, cosine: float) -> DataFrame:
    """``rid, links, component`` of the vectors that link; ``component`` is a row number."""
    shared = vectors.sparkSession.sparkContext.broadcast(coder)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                yield _code_batch(batch.slice(first, 4096), shared.value)

    codes = cut_lineage(
        vectors.mapInArrow(code, "rid long, core int, code binary, keys array<long>, halos array<int>"), "embedding-codes")
    place = ["key", "cell", "x", "y"]

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in _cells(batches, place):
            yield from table.filter(pa.array(_near_in_cells(table, at, shared.value))).to_batches()

    entries = _entries(codes)
    met = entries.repartition(*place).sortWithinPartitions(*place).mapInArrow(near, entries.schema)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in _cells(batches, place):
            for ids, roots, links in _link_cells(table, at, shared.value, cosine):
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(roots), pa.array(links)], names=["rid", "root", "links"])

    wide = cut_lineage(met, "embedding-met").join(vectors, "rid").select(*place, "side", "rid", "code", "embedding")
    found = wide.repartition(*place).sortWithinPartitions(*place).mapInArrow(link, "rid long, root long, links long")
    # All of a core link with each other.
    members = codes.filter("core >= 0").select("rid", "core")
    cores = members.groupBy("core").agg(F.min("rid").alias("root"), (F.count("*") - 1).alias("links"))
    found = cut_lineage(
        found.union(members.join(F.broadcast(cores), "core").filter("links > 0").select("rid", "root", "links")), "embedding-links")
    reach = components(found.select(F.col("rid").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("rid").agg(F.sum("links").alias("links"))
    return counts.join(reach.select(F.col("id").alias("rid"), "component"), "rid", "left").select(
        "rid", "links", F.coalesce("component", "rid").alias("component"))
