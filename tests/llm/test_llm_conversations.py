"""Conversation repair against a plain dynamic programme."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from basketlens.llm import conversation_repair as cr

LAST = re.compile(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z")


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 1:
            text = ""
        elif fate == 2:
            text = re.sub("[.!?]", "", text)
        elif fate == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return out


def plain_repair(turns):
    """Figures of one conversation: cheapest way to each state, least letters first, turn by turn."""
    turns = sorted(turns, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    seen, faults = set(), []
    for _, _, role, text in turns:
        tail = LAST.search(text)
        faults.append("b" if not tail else "d" if (role, text) in seen else "" if tail[1] in ".!?" else "t")
        seen.add((role, text))
    given = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    def inserted(ways):
        for _ in range(4):
            for state, (cost, letters, text) in list(ways.items()):
                to = given[state]
                new = (cost + 2, letters + "I", (*text, f"{name[to]}:"))
                ways[to] = min(ways.get(to, new), new)
        return ways

    ways = inserted({"": (0, "", ())})
    for (_, _, role, text), fault in zip(turns, faults, strict=True):
        after = {}

        def offer(state, way, after=after):
            after[state] = min(after.get(state, way), way)

        for state, (cost, letters, said) in ways.items():
            offer(state, (cost + 3, letters + "D", said))
            if fault in ("", "t"):
                more = int(fault == "t")
                first = role[:1]
                if (state, first) in (("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")):
                    offer(first, (cost + more, letters + "K", (*said, f"{role}:{text}")))
                offer(given[state], (cost + 2 + more, letters + "R", (*said, f"{name[given[state]]}:{text}")))
        ways = inserted(after)
    cost, letters, said = min(ways[s] for s in ("", "a") if s in ways)
    numbers = [t[1] for t in turns if t[1] is not None]
    firsts = [t[2][:1] for t in turns]
    return (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            faults.count("b"), faults.count("d"), faults.count("t"),
            sum(x + y not in ("su", "ua", "au") for x, y in zip(firsts, firsts[1:], strict=False)),
            cost, letters, hashlib.sha256("\n".join(said).encode()).hexdigest())


def conversations(seed=3, n=60):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(n), None]:
        size = 400 if conv == 7 else rng.choice([0, 1, 2, 5, 9, 17])
        for turn in range(size):
            role = rng.choice(["system"] * (turn == 0) + ["user", "assistant"] * 4 + ["tool", "", None, "User", "übung"])
            text = rng.choice(["Yes.", "No!", "Why?\n", "so", " ", "", None, "漢字 🙂", "long " * 900, f"n{turn}."])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 2, None]), role, text))
    return rows + rows[:5]  # repeated rows


SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repaired(turns, block):
    repair = cr.Repair(turns, block)
    digests = cr.digests(repair.edits()).withColumnRenamed("conv", "of")
    joined = repair.figures().join(digests, F.col("conv").eqNullSafe(F.col("of")))
    return {r.conv: tuple(r[n] for n in NAMES) for r in joined.collect()}


@pytest.mark.parametrize("block", [cr.BLOCK, 5, 1])
def test_repair_matches_the_plain_programme(spark, block):
    rows = conversations()
    want = defaultdict(list)
    for row in plain_damage(rows):
        want[row[0]].append(row)
    turns = spark.createDataFrame(rows, SCHEMA).withColumn("rank", F.lit(1)).repartition(5)
    assert repaired(cr.damage(turns), block) == {conv: plain_repair(turns) for conv, turns in want.items()}


def test_undamaged_turns_that_no_hash_picked(spark):
    rows = [("a", 1, "user", "Hi."), ("a", 2, "assistant", "Hello."), ("b", 1, "assistant", "Hello."),
            ("c", 1, "system", "Be good."), (None, None, None, None)]
    turns = spark.createDataFrame(rows, "conv string, turn long, role string, text string")
    edits = defaultdict(str)
    for r in cr.Repair(turns).edits().orderBy("conv", "place").collect():
        edits[r.conv] += r.edit
    assert dict(edits) == {"a": "KK", "b": "IK", "c": "D", None: "D"}


def test_no_turns(spark):
    turns = cr.damage(spark.createDataFrame([], SCHEMA))
    assert repaired(turns, 4) == {}


def test_prices_of_a_long_block_are_distances():
    rng = random.Random(1)
    turns = [(rng.choice("suat"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(300)]
    arcs = cr.lattice(turns, [0, None, None, 0], True)
    price = cr.prices(arcs)
    # Bellman's equations hold, and only the sink has no arc.
    for node, out in enumerate(arcs[:-1]):
        assert price[node] == min(cost + price[end] for _, cost, end in out)
