"""Conversations brought back to a legal order of turns at the least cost.

**Lattice.**  A node is a number of turns read and a state (nothing said, a system turn said, the user or the assistant
spoke last).  Arcs are edits: ``D`` deletes a turn (3; a must for blank and repeated turns), ``K`` keeps it (0) and
``R`` gives it the role that may follow (2), both 1 more for a truncated turn, and ``I`` inserts an empty turn (2).  Roles
are known by their first letter; a whole conversation reads ``(s?(ua)+)?``.

**Auction.**  Nodes bid: a path starts at a node and is extended along its cheapest arc (cost plus the price of the arc's
end) while the node's price equals that bid; otherwise the price rises to the bid and the path is contracted.  Origins are taken
from the last turn backwards, so a path ends at the first node whose price has converged.  Converged prices are distances; arcs
whose cost is the difference of their prices are tight, and the least letters over tight arcs are the audit.

**Scale.**  Turns are numbered over range partitions.  A conversation is cut into blocks of ``block`` turns that are solved
in separate tasks: a block's costs between its four entry and exit states first, then the exit prices of all blocks (one small
row per block), then each block's edits for each entry state, then the choice of entry states.  Only the digest of a
repaired conversation is taken in one task, turn after turn as they stream by, since a hash is sequential.

Null ids make one conversation; a null turn number comes first; a null role or text counts as one space.  Turns with equal
numbers are ordered by role and text (bytes), so rows that are equal in all are interchangeable.  An empty table gives empty
results.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import numbered
from basketlens.sources.session import cut_lineage

#: Turns of a block.
BLOCK = 128
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a kept turn, by first letter of its role and state before.
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: The state after a turn that is given its role, and that role.
GIVEN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)

Arcs = list[list[tuple[str, int, int]]]


# ---------------------------------------------------------------- the lattice and its prices

def lattice(turns: Sequence[tuple[str, int]], exits: Sequence[int | None], closing: bool) -> Arcs:
    """Arcs ``(letter, cost, end)`` of each node, by letter; node ``4 * turns read + state``, the last node is the sink.

    ``turns`` are first letters and faults.  ``exits`` are costs from the states after the last turn to the sink; a
    ``closing`` block may also insert there (others leave that to the block behind).
    """
    n = len(turns)
    arcs: Arcs = [[] for _ in range(4 * n + 5)]
    for i in range(n + 1):
        for state in range(4):
            out = arcs[4 * i + state]
            if i < n:
                letter, fault = turns[i]
                below = 4 * (i + 1)
                out.append(("D", 3, below + state))
                out.append(("I", 2, 4 * i + GIVEN[state]))
                if fault in (SOUND, TRUNCATED):
                    more = int(fault == TRUNCATED)
                    to = KEPT.get(letter, {}).get(state)
                    if to is not None:
                        out.append(("K", more, below + to))
                    out.append(("R", 2 + more, below + GIVEN[state]))
            else:
                if closing:
                    out.append(("I", 2, 4 * n + GIVEN[state]))
                if exits[state] is not None:
                    out.append(("", exits[state], 4 * n + 4))
    return arcs


def prices(arcs: Arcs) -> list[int | None]:
    """Distance of every node from the sink (None: no way), by auctions from all nodes, the last turn's first."""
    sink = len(arcs) - 1
    ends: list[list[int]] = [[] for _ in arcs]
    for node, out in enumerate(arcs):
        for _, _, end in out:
            ends[end].append(node)
    alive, todo = {sink}, [sink]
    while todo:
        for node in ends[todo.pop()]:
            if node not in alive:
                alive.add(node)
                todo.append(node)
    price: list[int | None] = [0 if node in alive else None for node in range(len(arcs))]
    settled = [False] * len(arcs)
    settled[sink] = True
    for origin in range(sink - 1, -1, -1):
        if price[origin] is None:
            continue
        path = [origin]
        while not settled[path[-1]]:
            node = path[-1]
            bid, end = min((cost + price[to], to) for _, cost, to in arcs[node] if price[to] is not None)
            if price[node] < bid:
                price[node] = bid
                if len(path) > 1:
                    path.pop()
            else:
                path.append(end)
        for node in path:  # prices along a path that ends at a settled node are distances
            settled[node] = True
    return price


def audit(arcs: Arcs, price: Sequence[int | None], state: int) -> tuple[str, int]:
    """The least letters over tight arcs from an entry state, and the exit state."""
    sink, node, letters = len(arcs) - 1, state, []
    while True:
        letter, end = next((letter, end) for letter, cost, end in arcs[node]
                           if price[end] is not None and price[node] == cost + price[end])
        if end == sink:
            return "".join(letters), node % 4
        letters.append(letter)
        node = end


def costs(turns: Sequence[tuple[str, int]]) -> list[int | None]:
    """Costs between entry and exit states of a block that is not the last: ``[4 * entry + exit]``."""
    out: list[int | None] = [None] * 16
    for leave in range(4):
        found = prices(lattice(turns, [0 if state == leave else None for state in range(4)], False))
        for enter in range(4):
            out[4 * enter + leave] = found[enter]
    return out


def solve(turns: Sequence[tuple[str, int]], exits: Sequence[int | None] | None) -> list[tuple[int, str, int]]:
    """Cost to the end of the conversation, letters and exit state, for each entry state of a block.

    ``exits`` are the prices behind the block, None for the last one.
    """
    arcs = lattice(turns, [0, None, None, 0] if exits is None else exits, exits is None)
    price = prices(arcs)
    return [(price[state], *audit(arcs, price, state)) for state in range(4)]


def replay(state: int, letters: str, turns: Sequence[tuple[str, str]]) -> Iterator[tuple[str, str | None, str | None]]:
    """Each edit with the role and text that it leaves (None for a deleted turn)."""
    ahead = iter(turns)
    for letter in letters:
        if letter == "I":
            state = GIVEN[state]
            yield "I", ROLE[state], ""
            continue
        role, text = next(ahead)
        if letter == "D":
            yield "D", None, None
        elif letter == "K":
            state = KEPT[role[0]][state]
            yield "K", role, text
        else:
            state = GIVEN[state]
            yield "R", ROLE[state], text


# ---------------------------------------------------------------- Spark

def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, role, text`` with planted faults, chosen by the hash of ``conv:turn``.

    Of 20 remainders 0 drops a row, 1 empties its text, 2 takes the stops ``.!?`` out of it, 3 repeats it and 4 makes it the user's.
    """
    def or_space(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(or_space(conv), F.lit(":"), or_space(turn))) % 20
    said = (F.when(F.col("fate") == 1, F.lit("")).when(F.col("fate") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")))
    return (
        rows.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), or_space(role).alias("role"),
                    or_space(text).alias("text"), fate.alias("fate"))
        .filter("fate <> 0")
        .withColumn("copy", F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select("conv", "turn", F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                said.alias("text")))


def lines(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """``conv, rank, turn, role, text, fault, block, last``: turns in order, each with its first fault and its block."""
    plain = turns.select("conv", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    ranked = numbered(plain, "conv", order, "repair-rank").withColumn(
        "print", F.unhex(F.sha2(F.concat("role", F.lit("\x00"), "text"), 256)))
    first = ranked.groupBy(F.col("conv").alias("of"), F.col("print").alias("of_print")).agg(F.min("rank").alias("first"))
    sizes = ranked.groupBy(F.col("conv").alias("whose")).agg(F.max("rank").alias("last_rank"))
    seen = ranked.join(first, F.col("conv").eqNullSafe(F.col("of")) & (F.col("print") == F.col("of_print")))
    placed = seen.join(sizes, F.col("conv").eqNullSafe(F.col("whose")))
    # The last character that is not white space.
    tail = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = (F.when(tail == "", BLANK).when(F.col("first") < F.col("rank"), DUPLICATE)
             .when(~tail.isin(".", "!", "?"), TRUNCATED).otherwise(SOUND))
    return cut_lineage(placed.select(
        "conv", "rank", "turn", "role", "text", fault.cast("int").alias("fault"),
        F.floor(F.col("rank") / block).cast("long").alias("block"),
        (F.floor(F.col("rank") / block) == F.floor(F.col("last_rank") / block)).alias("last")), "repair-lines")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _tables(rows: Iterator[tuple], schema: pa.Schema, most: int = 1024, most_text: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded size."""
    held, weight = [], 0

    def made() -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    for row in rows:
        held.append(row)
        weight += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= most or weight >= most_text:
            yield made()
            held, weight = [], 0
    if held:
        yield made()


def _sorted_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Rows of equal keys in one partition, in order; partitions hold many keys, so that Python starts once for all of them."""
    return df.repartition(*keys).sortWithinPartitions(*keys, *order)


def _mapped(df: DataFrame, make, fields: str, conv_type: str, conv_arrow: pa.DataType, schema: list[tuple[str, pa.DataType]]) -> DataFrame:
    """``make`` turns an iterator of rows into one of result rows; the first column is the conversation."""
    arrow = pa.schema([("conv", conv_arrow), *schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _tables(make(_rows(batches)), arrow)

    return df.mapInArrow(run, f"conv {conv_type}, {fields}")


class Repair:
    """What the lattices of all conversations give: edits, and a line of figures for each conversation.

    ``turns`` has ``conv, turn, role, text``.  Intermediate tables are written to the shared folder.
    """

    def __init__(self, turns: DataFrame, block: int = BLOCK):
        from pyspark.sql.pandas.types import to_arrow_type

        if block < 1:
            raise ValueError("a block has a turn at least")
        kind = turns.schema["conv"].dataType
        self._kind = (kind.simpleString(), to_arrow_type(kind))
        self.lines = lines(turns, block)
        self.blocks = cut_lineage(self._blocks(), "repair-blocks")
        self.chosen = cut_lineage(self._chosen(), "repair-chosen")

    def _narrow(self) -> DataFrame:
        return self.lines.select(
            "conv", "block", "rank", "last", F.substring("role", 1, 1).alias("letter"), "fault", F.col("turn").cast("long").alias("turn"))

    def _blocks(self) -> DataFrame:
        """A row per block: counts, borders, and its costs; for the last block of a conversation its edits."""
        def make(rows):
            for (conv, block), group in groupby(rows, key=lambda r: r[:2]):
                group = list(group)
                last = group[0][3]
                letters, faults, numbers = [r[4] for r in group], [r[5] for r in group], [r[6] for r in group]
                turns = list(zip(letters, faults, strict=True))
                known = [t for t in numbers if t is not None]
                illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(letters, letters[1:], strict=False))
                ways = solve(turns, None) if last else None
                yield (conv, block, last, faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED), illegal,
                       letters[0], letters[-1], known[0] if known else None, known[-1] if known else None, len(set(known)),
                       None if last else costs(turns),
                       [w[0] for w in ways] if ways else None, [w[1] for w in ways] if ways else None)

        longs = ["blank", "duplicate", "truncated", "illegal"]
        return _mapped(
            _sorted_by(self._narrow(), ["conv", "block"], ["rank"]), make,
            "block long, last boolean, " + ", ".join(f"{n} long" for n in longs)
            + ", head string, tail string, low long, high long, numbers long, "
            "costs array<int>, vector array<int>, audits array<string>", *self._kind,
            [("block", pa.int64()), ("last", pa.bool_()), *((n, pa.int64()) for n in longs), ("head", pa.string()),
             ("tail", pa.string()), ("low", pa.int64()), ("high", pa.int64()), ("numbers", pa.int64()),
             ("costs", pa.list_(pa.int32())), ("vector", pa.list_(pa.int32())), ("audits", pa.list_(pa.string()))])

    def _chosen(self) -> DataFrame:
        """``conv, block, entry, place, letters, cost``: the edits of each block, the place of the first, the cost from there on."""
        single = self.blocks.filter("block = 0 AND last").select(
            "conv", "block", F.lit(START).alias("entry"), F.lit(0).cast("long").alias("place"),
            F.col("audits")[START].alias("letters"), F.col("vector")[START].cast("long").alias("cost"))
        long = self.blocks.filter("NOT (block = 0 AND last)")

        def backwards(rows):
            for conv, group in groupby(rows, key=lambda r: r[0]):
                behind = None
                for _, block, table, vector in group:
                    if vector is None:
                        yield conv, block, behind
                        vector = [min(table[4 * i + j] + behind[j] for j in range(4) if table[4 * i + j] is not None)
                                  for i in range(4)]
                    behind = vector

        exits = _mapped(
            _sorted_by(long.select("conv", "block", "costs", "vector"), ["conv"], [F.col("block").desc()]), backwards,
            "block long, exits array<int>", *self._kind, [("block", pa.int64()), ("exits", pa.list_(pa.int32()))])
        exits = exits.select(F.col("conv").alias("of"), F.col("block").alias("of_block"), "exits")
        inner = self._narrow().join(exits, F.col("conv").eqNullSafe(F.col("of")) & (F.col("block") == F.col("of_block")))

        def inside(rows):
            for (conv, block), group in groupby(rows, key=lambda r: r[:2]):
                group = list(group)
                ways = solve([(r[3], r[4]) for r in group], group[0][5])
                yield conv, block, [w[0] for w in ways], [w[1] for w in ways], [w[2] for w in ways]

        ways = _mapped(
            _sorted_by(inner.select("conv", "block", "rank", "letter", "fault", "exits"), ["conv", "block"], ["rank"]), inside,
            "block long, vector array<int>, audits array<string>, leaves array<int>", *self._kind,
            [("block", pa.int64()), ("vector", pa.list_(pa.int32())), ("audits", pa.list_(pa.string())),
             ("leaves", pa.list_(pa.int32()))])
        ways = ways.union(long.filter("last").select("conv", "block", "vector", "audits", F.lit(None).cast("array<int>")))

        def forwards(rows):
            for conv, group in groupby(rows, key=lambda r: r[0]):
                state, place = START, 0
                for _, block, vector, audits, leaves in group:
                    yield conv, block, state, place, audits[state], vector[state]
                    place += len(audits[state])
                    state = leaves[state] if leaves else state

        return single.union(_mapped(
            _sorted_by(ways, ["conv"], ["block"]), forwards,
            "block long, entry int, place long, letters string, cost long", *self._kind,
            [("block", pa.int64()), ("entry", pa.int32()), ("place", pa.int64()), ("letters", pa.string()), ("cost", pa.int64())]))

    def edits(self) -> DataFrame:
        """``conv, place, edit, role, text``: every edit in order; role and text are what it leaves (null for a deletion)."""
        picked = self.chosen.select(F.col("conv").alias("of"), F.col("block").alias("of_block"), "entry", "place", "letters")
        joined = self.lines.join(
            picked, F.col("conv").eqNullSafe(F.col("of")) & (F.col("block") == F.col("of_block")))
        wide = joined.select("conv", "block", "rank", "role", F.when(F.col("fault").isin(SOUND, TRUNCATED), F.col("text")).alias("text"),
                             "entry", "place", "letters")

        def make(rows):
            for (conv, _), group in groupby(rows, key=lambda r: r[:2]):
                group = list(group)
                _, _, _, _, _, entry, place, letters = group[0]
                for at, edit in enumerate(replay(entry, letters, [(r[3], r[4]) for r in group])):
                    yield conv, place + at, *edit

        return _mapped(
            _sorted_by(wide, ["conv", "block"], ["rank"]), make, "place long, edit string, role string, text string", *self._kind,
            [("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def figures(self) -> DataFrame:
        """A row per conversation: ``conv, gaps, blank, duplicate, truncated, illegal, cost``."""
        after = self.blocks.filter("block > 0").select(
            F.col("conv").alias("of"), (F.col("block") - 1).alias("of_block"), F.col("head").alias("next_head"), F.col("low").alias("next_low"))
        before = self.blocks.filter("NOT last").select("conv", "block", "tail", "high")
        borders = before.join(after, F.col("conv").eqNullSafe(F.col("of")) & (F.col("block") == F.col("of_block"))).select(
            "conv", (~F.concat("tail", "next_head").isin("su", "ua", "au")).cast("long").alias("illegal"),
            # A number that goes on behind a border was counted on both sides.
            F.when(F.col("high") == F.col("next_low"), F.lit(-1)).otherwise(0).cast("long").alias("numbers"))
        none = F.lit(0).cast("long")
        counted = self.blocks.select("conv", "blank", "duplicate", "truncated", "illegal", "numbers", "low", "high").union(
            borders.select("conv", none, none, none, "illegal", "numbers", F.lit(None).cast("long"), F.lit(None).cast("long")))
        sums = counted.groupBy("conv").agg(
            F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("numbers"), none).alias("gaps"),
            *(F.sum(n).alias(n) for n in ("blank", "duplicate", "truncated", "illegal")))
        price = self.chosen.filter("block = 0").select(F.col("conv").alias("of"), "cost")
        return sums.join(price, F.col("conv").eqNullSafe(F.col("of"))).drop("of")


def digests(edits: DataFrame) -> DataFrame:
    """``conv, audit, repaired_sha256`` of the edits: their letters, and the hash of the ``role:text`` lines that are left."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = edits.schema["conv"].dataType

    def make(rows):
        for conv, group in groupby(rows, key=lambda r: r[0]):
            letters, hashed, first = [], hashlib.sha256(), True
            for _, _, edit, role, text in group:
                letters.append(edit)
                if role is not None:
                    hashed.update((f"{role}:{text}" if first else f"\n{role}:{text}").encode())
                    first = False
            yield conv, "".join(letters), hashed.hexdigest()

    return _mapped(
        _sorted_by(edits.select("conv", "place", "edit", "role", "text"), ["conv"], ["place"]), make,
        "audit string, repaired_sha256 string", kind.simpleString(), to_arrow_type(kind),
        [("audit", pa.string()), ("repaired_sha256", pa.string())])
