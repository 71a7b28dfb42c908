"""Repair of conversations against a plain version, with blocks of many sizes, and over none."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import pairwise

import numpy as np
import pytest

from skytally.llm import queries, turn_repair

SOLID = re.compile(r"[^\x20\x09-\x0D]")
NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
DUE = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def damaged(rows):
    """Turns of each conversation after the damage, in order."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        text, role = [" " if x is None else x for x in (text, role)]
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        how = zlib.crc32(key.encode()) % 20
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        out[conv] += [(turn, "user" if how == 4 else role, text)] * (0 if how == 0 else 2 if how == 3 else 1)
    return {conv: sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())) for conv, own in out.items()}


def best_edits(turns, gone, cut):
    """Cost, audit and remaining turns: the least over all edits of what is left, state by state."""
    end = {"": (0, "", []), "s": (6, "II", [("user", ""), ("assistant", "")]), "u": (3, "I", [("assistant", "")]), "a": (0, "", [])}
    for (_, role, text), must, more in zip(turns[::-1], gone[::-1], cut[::-1], strict=True):
        here = {}
        for state in end:
            options = [(4 + end[state][0], "D" + end[state][1], end[state][2])]
            if not must:
                to = NEXT[state].get(role[:1])
                if to:
                    options.append((3 * more + end[to][0], "K" + end[to][1], [(role, text), *end[to][2]]))
                to = DUE[state]
                options.append((3 + 3 * more + end[to][0], "R" + end[to][1], [(NAMES[to], text), *end[to][2]]))
            here[state] = min(options)
        for _ in range(3):
            for state in here:
                to = DUE[state]
                here[state] = min(here[state], (3 + here[to][0], "I" + here[to][1], [(NAMES[to], ""), *here[to][2]]))
        end = here
    return end[""]


def plain(rows):
    found, after = {}, damaged(rows)
    empty = hashlib.sha256(b"").hexdigest()
    for conv in {r[0] for r in rows}:
        turns = after.get(conv, [])
        faults, seen = [], set()
        for _, role, text in turns:
            solid = SOLID.findall(text)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated")
            seen.add((role, text))
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairwise(turns))
        cost, audit, left = best_edits(turns, [f in ("blank", "duplicate") for f in faults], [f == "truncated" for f in faults])
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest() if turns else empty
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        found[conv] = (conv, gaps, *counts, illegal, cost, audit, sha)
    return sorted(found.values(), key=repr)


def made_up():
    pick = random.Random(11)
    rows = []
    for conv in range(60):
        for turn in range(pick.choice([1, 2, 3, 5, 9, 30])):
            role = pick.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "u", "Agent"])
            text = pick.choice(["Yes.", "No?", "well", "", None, " \t\n ", "a.\x0b", "done!", "é.", "end ", f"t{pick.randrange(9)}."])
            rows.append((conv, pick.choice([turn, turn, turn, None, turn - 7]), role, text))
    rows += [(None, i, "user", "x.") for i in range(5)] + [(None, None, None, None)] * 3
    rows += [(100, i, pick.choice(["user", "assistant"]), f"text {i}.") for i in range(400)]
    rows += [(101, 5, "user", "same.")] * 40 + [(102, i, "assistant", "x" * 5000 + ".") for i in range(4)]
    rows += [(conv, 0, "user", "a.") for conv in range(200, 260)]  # some lose all their turns
    return rows


SCHEMA = "block string, conv_id long, turn long, role string, text string, at int, pos int"


@pytest.fixture(scope="module")
def rows():
    return made_up()


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame([("b", *r, 1, 2) for r in rows], SCHEMA).repartition(5)


def repaired(frame):
    done = turn_repair.with_all(frame, turn_repair.repair(turn_repair.damage(frame)))
    return sorted((tuple(r) for r in done.collect()), key=repr)


@pytest.mark.parametrize("bits", [10, 2, 1])
def test_repair(frame, rows, monkeypatch, bits):
    """Small blocks put long conversations through several levels of the scans."""
    monkeypatch.setattr(turn_repair, "BITS", bits)
    monkeypatch.setattr(turn_repair, "TOGETHER", 400_000 if bits > 2 else 50)
    found, wanted = repaired(frame), plain(rows)
    assert [r[0] for r in found] == [r[0] for r in wanted]
    assert found == wanted
    assert any(r[7] == "" for r in found) and {"D", "I", "K", "R"} <= set("".join(r[7] for r in found))


def test_least_arcs_read_the_least_string():
    """Ranks by doubled lengths choose, node by node, the arc of the least string, here on trees of random letters."""
    pick = random.Random(3)
    for _ in range(50):
        n = pick.randrange(1, 60)
        source, letter, target = [], [], []
        for node in range(n):
            for x in pick.sample([1, 2, 3, 4], pick.randrange(3)):
                if node + 1 < n:
                    source.append(node), letter.append(x), target.append(pick.randrange(node + 1, n))
        best = turn_repair.least_arcs(*[np.array(x, dtype=np.int64) for x in (source, letter, target)], n)
        least = [()] * n
        for node in range(n)[::-1]:
            ways = [(x, *least[t]) for s, x, t in zip(source, letter, target, strict=True) if s == node]
            least[node] = min(ways, default=())
            assert (best[node] < 0) == (not ways)
            if ways:
                assert (letter[best[node]], *least[target[best[node]]]) == least[node]


def test_no_conversations(frame):
    assert repaired(frame.where("false")) == []


def test_ids_of_other_types(spark):
    frame = spark.createDataFrame([("a", 1, "user", "x."), ("a", 2, "assistant", "y."), ("ü", 2**62, "user", "z."), ("ü", -(2**62) - 2**61, "user", "z.")], "conv_id string, turn long, role string, text string")
    found = turn_repair.repair(frame)
    rows = {r["conv_id"]: (r["gaps"], r["audit"]) for r in found.conversations.collect()}
    assert rows["a"] == (0, "KK") and rows["ü"][0] is None or rows["ü"][0] > 2**61
    assert sorted(tuple(r)[3:] for r in found.turns.where("conv_id = 'a'").collect()) == [("assistant", "y."), ("user", "x.")]


def test_query(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    wanted = plain([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
    found = queries.op13_turn_repair(spark, sf_dir)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == wanted
