"""Documents whose word shingles overlap: parity-sketch join, then exact comparison.

**Sketch.**  A text's shingles toggle bits of a long sparse sketch that is cut
into chunks; a chunk's bits are stored as one 64-bit parity hash (the XOR of
its shingles' hashes).  A shingle that only one of two texts has changes one
chunk, so the number of differing chunks is a lower bound of the symmetric
difference.  At a similarity of at least t, sizes differ by at most 1/t and the symmetric
difference is at most (1 - t) / (1 + t) of both sizes together; that is the bound D.

**Pigeonhole.**  Two texts within D share S + 1 chunks among the first D + S + 1
of each, in any order that both use; S grows with the size band.  Chunks are ordered with common ones
last, so that a passage of many texts brings no pairs.  The number of chunks is fixed within a
size band; a text near a band's lower end also signs in the band below.  A text with no
more filled chunks than D + S signs in a bucket for such texts.  Texts that share fewer buckets of a
band with all others together leave them, so that a passage of few texts brings no pairs either.

**Comparison.**  No pairs are written.  Each text joins the largest bucket it
is in (its hub) and visits the hubs after its own with whose texts it shares S + 1 buckets.  The texts of
a hub are cut into blocks by size class and hash, and pairs of
blocks meet in separate tasks, so a hub with most of the texts is spread over many tasks and every
possible pair is compared once.  A meeting first compares dense bit sketches, whose Hamming distance is a
lower bound of the symmetric difference too; texts that are within D of another there meet again with
their whole sets, which returns per text its links and one spanning link.

Copies (equal word sequences) are one text throughout, known by a 64-bit digest of their words; for n different texts the odds that
two digests agree are n * n / 2^65.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.common import row_struct, text_of, unpacked
from basketlens.llm.components import components
from basketlens.llm.text_arrays import LOWER, Chunk, chunks, mix64, shingle_set, words
from basketlens.sources.session import cut_lineage

RESULTS = ("n_shingles", "component_id", "n_links", "kept")
#: Sizes of a band lie within this factor.
BAND = 4
#: A chunk hash seen so often among a few megabytes of texts is reported; the commonest go last in the order.
REPORT, ORDERED = 3, 1 << 17
#: Shingles of a block of texts that are compared together.
BLOCK = 1 << 17
#: Bits that texts are looked up in before they are read again; more texts only mean that more are read in vain.
MARKS = 1 << 24
#: The last bits of a bucket are its band; the rest of a bucket for texts with few chunks.
BAND_BITS = 5
FEW = 0xFFFF0000


def band_of(n: int) -> int:
    """Band 0 holds sizes 1 to 3, band 1 sizes 4 to 15, and so on."""
    return (n.bit_length() - 1) // 2


def spare(band: int, percent: int) -> int:
    """S of a band: chunks signed beyond D + 1.  Small texts, and a low similarity, leave too few chunks for that."""
    return 1 << band if band >= 2 and percent >= 75 else 0


def chunk_hashes(shingles: np.ndarray, band: int) -> np.ndarray:
    """Parity hash of each filled chunk, with its place and band mixed in."""
    count = max(8, BAND ** (band + 1))
    place = (shingles >> np.uint64(20)) % np.uint64(count)
    order = np.argsort(place, kind="stable")
    place, value = place[order], mix64(shingles[order] ^ np.uint64(0x5851F42D4C957F2D))
    starts = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    parity = np.bitwise_xor.reduceat(value, starts)
    place = place[starts]
    filled = parity != 0
    mixed = mix64(parity[filled] + mix64(place[filled] * np.uint64(64) + np.uint64(band + 1)))
    return mixed >> np.uint64(BAND_BITS) << np.uint64(BAND_BITS) | np.uint64(band)


def bit_sketch(shingles: np.ndarray) -> bytes:
    """Parity of the shingles at each of a number of places that is a power of two, at least twice their number."""
    size = 2 * BAND ** (band_of(len(shingles)) + 1)
    parity = np.bincount(((shingles >> np.uint64(24)) % np.uint64(size)).astype(np.int64), minlength=size) & 1
    return np.packbits(parity.astype(np.uint8)).tobytes()


def sketches(shingles: np.ndarray, percent: int) -> list[tuple[int, int, np.ndarray]]:
    """Band, bound and chunks of each band that a text signs in."""
    n = len(shingles)
    if not n:
        return []
    own = band_of(n)
    # (1 - t) / (1 + t) of n and the largest partner n / t.
    out = [(own, (100 - percent) * n // percent, chunk_hashes(shingles, own))]
    if own and percent * n < 100 * BAND ** own:  # a partner in the band below is possible
        out.append((own - 1, (100 - percent) * 2 * n // (100 + percent), chunk_hashes(shingles, own - 1)))
    return out


def _signatures(shingles: np.ndarray, percent: int, common: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The buckets of a text."""
    out = []
    for band, bound, found in sketches(shingles, percent):
        order = np.zeros(len(found), dtype=np.int64)
        if len(common):
            at = np.minimum(np.searchsorted(common, found), len(common) - 1)
            order = np.where(common[at] == found, weight[at], 0)
        found = found[np.lexsort((found, order))]
        found = found[np.append(True, found[1:] != found[:-1])[:len(found)]]
        most = bound + spare(band, percent)
        out.append(found[:most + 1])
        if len(found) <= most:
            out.append(np.array([FEW << BAND_BITS | band], dtype=np.uint64))
    return np.concatenate(out) if out else shingles[:0]


def _digest(chunk: Chunk, i: int) -> int:
    """64 bits of a digest of the word sequence."""
    data = LOWER[chunk.data[chunk.offsets[i]:chunk.offsets[i + 1]]].tobytes()
    return int.from_bytes(hashlib.blake2b(b" ".join(data.split()), digest_size=8).digest(), "little", signed=True)


def _survey(docs: DataFrame, percent: int, width: int) -> DataFrame:
    """A row ``row_key, id, cls, n`` per row of ``docs``, and rows ``chunk, times`` of chunk hashes that come often.

    Both come from one pass; the other columns of a row are null.
    """
    names = ["row_key", "id", "cls", "n", "chunk", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[np.ndarray] = []
            weight = 0
            for chunk in chunks(batch.column(2)):
                found = words(chunk, LOWER)
                classes, sizes = [], []
                for i in range(len(chunk)):
                    shingles = shingle_set(found.hashes[found.of(i)], width)
                    classes.append(_digest(chunk, i))
                    sizes.append(len(shingles))
                    held += [hashes for _, _, hashes in sketches(shingles, percent)[:1]]
                none = pa.nulls(len(chunk), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(chunk.first, len(chunk)) for k in (0, 1)]
                    + [pa.array(classes, type=pa.int64()), pa.array(sizes, type=pa.int64()), none, none], names=names)
                weight += len(chunk.data)
                if held and (weight >= 4 << 20 or chunk.first + len(chunk) == batch.num_rows):
                    value, count = np.unique(np.concatenate(held), return_counts=True)
                    often = count >= REPORT
                    none = pa.nulls(int(often.sum()), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [none] * 4 + [pa.array(value[often].view(np.int64)), pa.array(count[often].astype(np.int64))],
                        names=names)
                    held, weight = [], 0

    return docs.select("row_key", "id", "text").mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _common_chunks(survey: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The commonest chunk hashes and their counts, at most ``ORDERED`` of them.

    They only set the order in which chunks are signed; any order finds every pair.
    """
    rows = (survey.filter("chunk is not null").groupBy("chunk").agg(F.sum("times").alias("times"))
            .orderBy(F.col("times").desc(), "chunk").limit(ORDERED).toPandas())
    chunk = rows["chunk"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(chunk)
    return chunk[order], rows["times"].to_numpy(dtype=np.int64)[order]


def _sign(docs: DataFrame, common: tuple[np.ndarray, np.ndarray], percent: int, width: int) -> DataFrame:
    """``cls, buckets`` of every text; copies within a batch sign once."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[int] = set()
            for chunk in chunks(batch.column(0)):
                found = words(chunk, LOWER)
                classes, buckets = [], []
                for i in range(len(chunk)):
                    cls = _digest(chunk, i)
                    if cls not in seen:
                        seen.add(cls)
                        classes.append(cls)
                        shingles = shingle_set(found.hashes[found.of(i)], width)
                        buckets.append(_signatures(shingles, percent, *shared.value).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(classes, type=pa.int64()), pa.array(buckets, type=pa.list_(pa.int64()))],
                    names=["cls", "buckets"])

    return docs.select("text").mapInArrow(run, "cls long, buckets array<long>")


def _band() -> Column:
    return F.col("bucket").bitwiseAND((1 << BAND_BITS) - 1).alias("band")


def _enough(shared: Column, percent: int) -> Column:
    """Whether a text shares enough buckets of ``band``; ``few`` tells whether one is that for texts with few chunks."""
    needed = [F.lit(spare(b, percent) + 1) for b in range(1 << BAND_BITS)]
    return F.col("few") | (shared >= F.get(F.array(*needed), F.col("band").cast("int")))


def _few() -> Column:
    return F.max(F.shiftright("bucket", BAND_BITS) == FEW).alias("few")


def _candidates(entries: DataFrame, percent: int) -> DataFrame:
    """``cls, hub, buckets`` of the texts that share enough buckets of a band; ``entries`` has each ``bucket, cls`` once.

    What the first round removes leaves other buckets too small, which the second round finds.
    """
    for last in (False, True):
        met = entries.withColumn("size", F.count("*").over(Window.partitionBy("bucket"))).filter("size > 1")
        sides = (
            met.repartition("cls").groupBy("cls", _band())
            .agg(F.max(F.struct("size", "bucket")).alias("top"), _few(), F.collect_list("bucket").alias("buckets"))
            .filter(_enough(F.size("buckets"), percent)))
        if not last:
            entries = cut_lineage(sides.select("cls", "buckets"), "jaccard-met").select("cls", F.explode("buckets").alias("bucket"))
    return sides.groupBy("cls").agg(
        F.max("top").alias("top"), F.flatten(F.collect_list("buckets")).alias("buckets")
    ).select("cls", F.col("top.bucket").alias("hub"), "buckets")


def _marks(classes: DataFrame) -> np.ndarray:
    """A bit for each class, at its digest's place of ``MARKS``."""
    place = F.col("cls").bitwiseAND(MARKS - 1)
    rows = (classes.select(F.shiftright(place, 5).alias("at"), F.expr("shiftleft(1L, cast(cls & 31 as int))").alias("bit"))
            .groupBy("at").agg(F.bit_or("bit").alias("bits")).toPandas())
    out = np.zeros(MARKS // 32, dtype=np.int64)
    out[rows["at"].to_numpy(dtype=np.int64)] = rows["bits"].to_numpy(dtype=np.int64)
    return out


def _described(docs: DataFrame, classes: DataFrame, width: int, describe, kind: pa.DataType, sql_kind: str) -> DataFrame:
    """``cls, n, value`` once for each of the given classes, where ``describe`` makes the value of a shingle set."""
    shared = docs.sparkSession.sparkContext.broadcast(_marks(classes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = shared.value
        for batch in batches:
            seen: set[int] = set()
            for chunk in chunks(batch.column(0)):
                rows = []
                for i in range(len(chunk)):
                    cls = _digest(chunk, i)
                    place = cls & (MARKS - 1)
                    if marks[place >> 5] >> (place & 31) & 1 and cls not in seen:
                        seen.add(cls)
                        rows.append((i, cls))
                if rows:
                    found = words(chunk, LOWER)
                    sets = [shingle_set(found.hashes[found.of(i)], width) for i, _ in rows]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([cls for _, cls in rows], type=pa.int64()), pa.array([len(s) for s in sets], type=pa.int64()),
                         pa.array([describe(s) for s in sets], type=kind)], names=["cls", "n", "value"])

    made = docs.select("text").mapInArrow(run, f"cls long, n long, value {sql_kind}")
    return made.join(classes, "cls", "left_semi").groupBy("cls").agg(F.first("n").alias("n"), F.first("value").alias("value"))


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    side = table.column("side").to_numpy()
    return side, np.flatnonzero(side != 2), np.flatnonzero(side != 1)  # 0: on both sides, 1: left, 2: right


def _within_sketches(table: pa.Table, percent: int) -> pa.Table:
    """One pair of blocks: the texts whose bit sketch is within the bound of another's."""
    side, left, right = _sides(table)
    if not len(left) or not len(right):
        return table.select(["meeting", "cls", "side"]).slice(0, 0)
    packed = [np.frombuffer(v.as_py(), dtype=np.uint8) for v in table.column("value")]
    size = min(len(p) for p in packed)
    # A sketch of more places is folded onto the fewest.
    bits = np.stack([np.unpackbits(np.bitwise_xor.reduce(p.reshape(-1, size), axis=0)) for p in packed]).astype(np.float32)
    ones, n = bits.sum(axis=1), table.column("n").to_numpy()
    apart = ones[left][:, None] + ones[right][None, :] - 2 * (bits[left] @ bits[right].T)
    near = apart * (100 + percent) <= (100 - percent) * (n[left][:, None] + n[right][None, :])
    if side[0] == 0:
        np.fill_diagonal(near, False)
    use = np.zeros(len(side), dtype=bool)
    use[left] |= near.any(axis=1)
    use[right] |= near.any(axis=0)
    return table.select(["meeting", "cls", "side"]).filter(pa.array(use))


def _common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of each left with each right set."""
    lv, lr = np.concatenate(left), np.repeat(np.arange(len(left)), [len(x) for x in left])
    rv, rr = np.concatenate(right), np.repeat(np.arange(len(right)), [len(x) for x in right])
    shared = np.intersect1d(lv, rv)
    keep_l, keep_r = np.isin(lv, shared), np.isin(rv, shared)
    lc, rc = np.searchsorted(shared, lv[keep_l]), np.searchsorted(shared, rv[keep_r])
    lr, rr = lr[keep_l], rr[keep_r]
    counts = np.zeros((len(left), len(right)), dtype=np.float32)
    step = 4096
    lo, ro = np.argsort(lc, kind="stable"), np.argsort(rc, kind="stable")
    lc, lr, rc, rr = lc[lo], lr[lo], rc[ro], rr[ro]
    for first in range(0, len(shared), step):
        size = min(step, len(shared) - first)
        a, b = np.searchsorted(lc, [first, first + size])
        c, d = np.searchsorted(rc, [first, first + size])
        x = np.zeros((len(left), size), dtype=np.float32)
        y = np.zeros((len(right), size), dtype=np.float32)
        x[lr[a:b], lc[a:b] - first] = 1
        y[rr[c:d], rc[c:d] - first] = 1
        counts += x @ y.T
    return counts


def _compare(table: pa.Table, percent: int) -> pa.Table:
    """One pair of blocks: for each text a smaller one it hangs on, and the number of documents it links with."""
    ids, weights = table.column("cls").to_numpy(), table.column("weight").to_numpy()
    side, left, right = _sides(table)
    none = pa.table({"id": ids[:0], "root": ids[:0], "links": weights[:0]})
    if not len(left) or not len(right):
        return none
    sets = [np.asarray(s.values) for s in table.column("value")]
    both = _common_counts([sets[i] for i in left], [sets[i] for i in right]).astype(np.int64)
    n = np.array([len(s) for s in sets])
    linked = 100 * both >= percent * (n[left][:, None] + n[right][None, :] - both)
    li, ri = np.nonzero(linked)
    li, ri = left[li], right[ri]
    if side[0] == 0:  # one block with itself
        differ = ids[li] < ids[ri]
        li, ri = li[differ], ri[differ]
    if not len(li):
        return none
    links = np.bincount(li, weights[ri], len(ids)) + np.bincount(ri, weights[li], len(ids))
    root = ids.copy()
    while True:  # the least id spreads over links
        before = root.copy()
        np.minimum.at(root, li, before[ri])
        np.minimum.at(root, ri, before[li])
        if (root == before).all():
            break
    use = np.flatnonzero(links > 0)
    return pa.table({"id": ids[use], "root": root[use], "links": links[use].astype(np.int64)})


def link_table(docs: DataFrame, percent: int = 80, width: int = 5) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with their class of equal word sequences, the classes, and what links between them.

    ``docs`` has ``row_key``, ``id`` and ``text``.  Returns ``row_key, cls`` of each row, ``cls, rep, weight, n``
    per class (``rep`` its smallest id), and rows ``id, root, links``: a class, a class that it
    is connected with, and the documents of other classes that it links with.
    """
    if not 50 <= percent < 100:
        raise ValueError("percent lies between 50 and 99")
    survey = cut_lineage(_survey(docs, percent, width), "jaccard-survey")
    rows = survey.filter("cls is not null").select("row_key", "id", "cls", "n")
    classes = cut_lineage(
        rows.groupBy("cls").agg(F.min("id").alias("rep"), F.count("*").alias("weight"), F.first("n").alias("n")),
        "jaccard-classes")
    # One shuffle by bucket serves both what removes copies and what counts.
    entries = _sign(docs, _common_chunks(survey), percent, width).select("cls", F.explode("buckets").alias("bucket"))
    entries = entries.repartition("bucket").groupBy("bucket", "cls").agg(F.lit(1).alias("one"))
    hubs = cut_lineage(_candidates(entries.select("bucket", "cls"), percent), "jaccard-hubs")
    return rows.select("row_key", "cls"), classes, _links(docs, hubs, classes, percent, width)


def _links(docs: DataFrame, hubs: DataFrame, classes: DataFrame, percent: int, width: int) -> DataFrame:
    # A text visits the hubs after its own whose members share enough of its buckets; most buckets know one hub only.
    at = hubs.select("cls", "hub", F.explode("buckets").alias("bucket"))
    mixed = at.groupBy("bucket").agg(F.min("hub").alias("low"), F.max("hub").alias("high")).filter("low < high").select("bucket")
    at = cut_lineage(at.join(mixed, "bucket"), "jaccard-mixed")
    here = at.select("bucket", F.col("hub").alias("there")).distinct()
    visits = (
        at.join(here, "bucket").filter(F.col("there") > F.col("hub"))
        .groupBy("cls", F.col("there").alias("target"), _band()).agg(F.count("*").alias("shared"), _few())
        .filter(_enough(F.col("shared"), percent)).select("cls", "target").distinct())
    # Size classes: linked sizes are in one class or in neighbours.
    level = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)) + F.lit(1e-9)).cast("int")
    people = cut_lineage(
        hubs.select("cls", "hub").join(classes.select("cls", "n"), "cls").select("cls", "hub", "n", level.alias("level")),
        "jaccard-people")
    cells = cut_lineage(
        people.groupBy("hub", "level").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"), F.count("*").alias("crowd")),
        "jaccard-cells")
    # Guests of a cell: its hub's members one level below, and visitors one level around.
    guests = people.select("cls", "n", "hub", (F.col("level") + 1).alias("level"))
    visitors = visits.join(people.drop("hub"), "cls").select(
        "cls", "n", F.col("target").alias("hub"),
        F.explode(F.array(F.col("level") - 1, F.col("level"), F.col("level") + 1)).alias("level"))
    guests = cut_lineage(guests.union(visitors).join(cells, ["hub", "level"]), "jaccard-guests")
    parties = guests.groupBy("hub", "level").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("parties"))
    slot = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    members = people.join(cells, ["hub", "level"]).select("cls", "hub", "level", "blocks", "crowd", slot.alias("block"))

    def meeting(kind: str, x, y, side):
        return [F.concat_ws("/", "hub", "level", F.lit(kind), x, y).alias("meeting"), side.cast("int").alias("side")]

    # Members of one cell: block b meets itself and every later block.
    several = members.filter("crowd > 1")
    x, y = F.col("x"), F.col("block")
    own = several.withColumn("x", F.explode(F.sequence(F.lit(0), y))).select(
        "cls", *meeting("own", x, y, F.when(x == y, 0).otherwise(2)))
    later = several.filter("block < blocks - 1").withColumn("x", F.explode(F.sequence(y + 1, F.col("blocks") - 1))).select(
        "cls", *meeting("own", y, x, F.lit(1)))
    party = F.pmod(F.xxhash64("cls"), F.col("parties")).cast("int")
    come = guests.join(parties, ["hub", "level"]).withColumn(
        "x", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("cls", *meeting("guest", party, x, F.lit(1)))
    stay = members.join(parties, ["hub", "level"]).withColumn(
        "x", F.explode(F.sequence(F.lit(0), F.col("parties") - 1))).select("cls", *meeting("guest", x, y, F.lit(2)))
    meetings = own.union(later).union(come).union(stay)

    dense = _described(docs, people.select("cls").distinct(), width, bit_sketch, pa.binary(), "binary")
    near = cut_lineage(
        meetings.join(dense, "cls").groupBy("meeting")
        .applyInArrow(lambda t: _within_sketches(t, percent), "meeting string, cls long, side int"), "jaccard-near")
    whole = _described(docs, near.select("cls").distinct(), width, lambda s: s.view(np.int64), pa.list_(pa.int64()), "array<long>")
    wide = near.join(whole.join(classes.select("cls", "weight"), "cls").select("cls", "weight", "value"), "cls")
    return wide.groupBy("meeting").applyInArrow(lambda t: _compare(t, percent), "id long, root long, links long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 80,
    width: int = 5,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """Every row with ``n_shingles``, ``component_id``, ``n_links`` and ``kept``.

    ``component_id`` is the smallest id that links lead to, the row's own
    included; ``n_links`` counts the rows linked with it, copies too.  A null text, an empty one and one without words
    links with nothing and is kept.  Rows with equal words link, also those without id.  In each
    component the row with the smallest id is ``kept``; of different texts with that id, the one with the smallest digest
    (rows equal in id and words stay together).  ``carry`` names the columns to return (default:
    all); one named like a result is replaced.  An empty table gives an empty result.
    """
    columns = list(docs.columns if carry is None else carry)
    key = F.xxhash64(F.col(f"`{id_col}`"), text_of(text_col))
    plain = docs.select(key.alias("row_key"), F.col(f"`{id_col}`").cast("long").alias("id"), text_of(text_col).alias("text"))
    rows, classes, found = link_table(plain, percent, width)
    found = cut_lineage(found, "jaccard-links")
    reach = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    n_links = found.groupBy(F.col("id").alias("cls")).agg(F.sum("links").alias("links"))
    table = cut_lineage(
        classes.join(reach.withColumnRenamed("id", "cls"), "cls", "left").join(n_links, "cls", "left")
        .withColumn("component", F.coalesce("component", "cls")), "jaccard-table")
    keeper = table.groupBy("component").agg(
        F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", F.col("cls").alias("best"))).alias("keeper"))
    table = table.join(keeper, "component").select(
        "cls", F.col("n").alias("size"), "keeper.rep", "keeper.best",
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"))
    # What a row gets depends on its id and text alone; equal rows share an entry.
    entry = rows.dropDuplicates(["row_key"]).join(table, "cls")
    own = docs.select(row_struct(docs, columns).alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"), key.alias("own_key"))
    joined = own.join(entry, F.col("own_key") == F.col("row_key"))
    alone = F.col("size") == 0
    return unpacked(joined, columns, {
        "n_shingles": F.col("size"),
        "component_id": F.when(alone, F.col("id")).otherwise(F.col("rep")),
        "n_links": F.when(alone, F.lit(0)).otherwise(F.col("links")),
        "kept": alone | (F.col("id").eqNullSafe(F.col("rep")) & (F.col("cls") == F.col("best"))),
    })
