"""Repair of conversations: faults of their turns, and the cheapest edits that put the roles in order.

The roles of a repaired conversation read ``(s?(ua)+)?`` by their initials. A turn is kept (cost 0), given the role that
is due (Rerole, 3) or deleted (4; blank and repeated turns have to be), an empty turn of the role that is due is inserted
(3), and a truncated turn that stays costs 3 more. The audit lists the edits by their initials; of the cheapest ones the
least in ASCII is taken.

Turns are put in order over all partitions and cut into blocks of at most 1024, so that a conversation of any length is
spread over tasks. Two scans over the blocks of a conversation, by trees of blocks, hand every block what it needs of the
others: the least cost of all that follows, for each state of the order, and the state it begins in. In a block, the
costs to the end tell the arcs of cheapest edits. These arcs are ranked by the audit letters that follow, 1, 2, 4, ... of
them (prefix doubling): the rank of twice the length is that of a pair, the arc's own and that of the least arc at the
end of its pointer, and pointers double along. The least arc of every node gives the path, read off by doubled pointers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.session import stage

#: Turns of a block, and blocks that meet in one step of a scan: 2 to this power.
BITS = 10
#: Places of a block's turns and paths that are looked at together.
TOGETHER = 400_000
SPACE = " \t\n\x0b\x0c\r"
#: Of the longest text part that decides the order of turns with the same number and role.
HEAD = 64

# States: nothing yet, after the system's turn, after the user's, after the assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a turn of the role that is due leads to.
DUE = np.array([USER, USER, ASSISTANT, USER])
ROLES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = "sua"  # numbers of initials; others are 3
#: Where a kept turn of an initial leads to, by state; -1: it cannot stay.
KEPT = np.array([[SYSTEM, -1, -1, -1], [USER, USER, -1, USER], [-1, -1, ASSISTANT, -1], [-1, -1, -1, -1]])
LEGAL = np.zeros((4, 4), dtype=bool)
LEGAL[[0, 1, 2], [1, 2, 1]] = True
INSERT, REROLE, DELETE, CUT = 3, 3, 4, 3
FAR = 1 << 40
#: Cost of inserted turns from the end of a conversation on, by state.
CLOSING = np.array([0, 2 * INSERT, INSERT, 0])
LETTERS = np.frombuffer(b"\0DIKR", dtype=np.uint8)
_D, _I, _K, _R = 1, 2, 3, 4

# A turn's code: number of its initial, plus 4 if it is truncated, plus 8 if it has to go.
_CODES = np.arange(16)
_MORE = np.where(_CODES & 4, CUT, 0)
_STAYS = (_CODES & 8) == 0
KEEP_TO = np.where(_STAYS[:, None], KEPT[_CODES & 3], -1)
KEEP_COST = np.where(KEEP_TO >= 0, _MORE[:, None], FAR)
REROLE_COST = np.where(_STAYS, REROLE + _MORE, FAR)


def _min_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(axis=-2), FAR)


def _closure() -> np.ndarray:
    """Cost of inserted turns from state to state."""
    cost = np.full((4, 4), FAR)
    for state in range(4):
        cost[state, state], cost[state, DUE[state]] = 0, INSERT
    return _min_plus(cost, cost)


def _turn_costs() -> np.ndarray:
    """By code: least cost from state to state over inserted turns and the turn itself."""
    out = np.full((16, 4, 4), FAR)
    for code in range(16):
        for state in range(4):
            out[code, state, state] = DELETE
            for to, cost in ((KEEP_TO[code, state], KEEP_COST[code, state]), (DUE[state], REROLE_COST[code])):
                if to >= 0:
                    out[code, state, to] = min(out[code, state, to], cost)
    return _min_plus(_closure(), out)


TURN_COSTS = _turn_costs()

# Turns in order ---------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` of conversations with planted faults, by a checksum of id and turn modulo 20.

    0 drops the turn, 1 empties its text, 2 takes its sentence marks, 3 repeats it, 4 gives it to the user. NULL role and
    text read as one space; so do NULL id and turn in the checksum.
    """
    blank = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    role, text = [F.coalesce(F.col(c).cast("string"), blank) for c in ("role", "text")]
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), (F.crc32(key) % 20).alias("how"))
    how = F.col("how")
    text = F.when(how == 1, "").when(how == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(how == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    changed = rows.where(how != 0).select("conv_id", "turn", F.when(how == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy"))
    return changed.drop("copy")


def in_order(turns: DataFrame) -> DataFrame:
    """Turns with a number ``at`` that rises with conversation and turn (NULL first), written to the shared folder.

    Turns of the same number go by role, then by the first characters of the text, then by its hash; equal rows are
    told apart by where they were read. Ranges of this order are dealt out, so no conversation has to fit a task.
    """
    rows = turns.withColumns({"head": F.substring("text", 1, HEAD), "h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text"), "read": F.monotonically_increasing_id()})
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), *[F.col(c) for c in ("role", "head", "h1", "h2", "read")]]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(placed.drop("head", "read").withColumn("at", F.monotonically_increasing_id()), "turns")


def _fault_rows(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``at``, ``turn``, ``initial`` (number) and the first of the faults blank, duplicate, truncated."""
    bare = F.rtrim("text", F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    light = turns.select("conv_id", "at", "turn", "role", "h1", "h2", number.alias("initial"), (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    first = light.groupBy("conv_id", "role", "h1", "h2").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated")
    return stage(light.join(first, "at", "left").select("conv_id", "at", "turn", "initial", fault.alias("fault")), "faults")


# Blocks -----------------------------------------------------------------------------


def _ragged(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Bounds of the lists of a column and their items."""
    bounds = column.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    return bounds - bounds[0], column.flatten()


def _block_costs(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each block the least cost from state to state."""
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = bounds[:-1][order], sizes[order]
    costs = np.where(np.eye(4, dtype=bool), 0, FAR)[None].repeat(len(sizes), axis=0)
    for i in range(sizes[0] if len(sizes) else 0):
        k = np.searchsorted(-sizes, -i, side="left")
        costs[:k] = _min_plus(costs[:k], TURN_COSTS[codes[starts[:k] + i]])
    out = np.empty_like(costs)
    out[order] = costs
    return out


def _costs_to_end(codes: np.ndarray, bounds: np.ndarray, given: np.ndarray) -> np.ndarray:
    """Least cost from every place of every block, by state, to the end. A block of n turns has n + 1 places."""
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    ends = (bounds[1:] + np.arange(len(sizes)))[order]
    last_turns, sizes = bounds[1:][order], sizes[order]
    cost = np.full((bounds[-1] + len(sizes), 4), FAR)
    cost[ends] = given[order]
    for back in range(1, (sizes[0] if len(sizes) else 0) + 1):
        k = np.searchsorted(-sizes, -back, side="right")
        after, code = cost[ends[:k] - back + 1], codes[last_turns[:k] - back]
        here = after + DELETE
        kept = np.take_along_axis(after, np.maximum(KEEP_TO[code], 0), axis=1) + KEEP_COST[code]
        here = np.minimum(np.minimum(here, kept), after[:, DUE] + REROLE_COST[code][:, None])
        here = np.minimum(here, here[:, DUE] + INSERT)
        cost[ends[:k] - back] = np.minimum(here, here[:, DUE] + INSERT)
    return cost


def _arcs(codes: np.ndarray, bounds: np.ndarray, cost: np.ndarray, closes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Arcs of cheapest edits, by node (place and state): node, letter, next node, cost. ``closes``: the block is its conversation's last."""
    sizes = np.diff(bounds)
    block = np.repeat(np.arange(len(sizes)), sizes)
    places = np.arange(bounds[-1]) + block  # of turns
    ends = bounds[1:] + np.arange(len(sizes))
    state = np.arange(4)
    node = lambda place, to: place[:, None] * 4 + to
    here, after = cost[places], cost[places + 1]
    found = []

    def add(letter: int, place: np.ndarray, to_place: np.ndarray, to: np.ndarray, price: np.ndarray) -> None:
        price = np.broadcast_to(price, (len(place), 4))
        best = (cost[place] == price + np.take_along_axis(cost[to_place], np.maximum(to, 0), axis=1)) & (price < FAR) & (to >= 0)
        found.append((node(place, state)[best], np.full(best.sum(), letter), node(to_place, to)[best], price[best]))

    due = np.broadcast_to(DUE, here.shape)
    add(_D, places, places + 1, np.broadcast_to(state, here.shape), np.int64(DELETE))
    add(_K, places, places + 1, KEEP_TO[codes], KEEP_COST[codes])
    add(_R, places, places + 1, due, REROLE_COST[codes][:, None])
    open_places = np.concatenate([places, ends[closes]])
    add(_I, open_places, open_places, np.broadcast_to(DUE, (len(open_places), 4)), np.int64(INSERT))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def least_arcs(source: np.ndarray, letter: np.ndarray, target: np.ndarray, nodes: int) -> np.ndarray:
    """For every node the arc from which the least string of letters can be read; -1 where no arc leaves.

    Arcs are ranked by the next 1, 2, 4, ... letters until all pointers have come to an end. Arcs of a node bear
    different letters, so there is one least arc at the end of a pointer. No path comes back to a node.
    """
    order = np.argsort(source, kind="stable")
    rank, end = letter[order].astype(np.int64), target[order]
    firsts = np.flatnonzero(np.diff(source[order], prepend=-1))
    owner = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, len(order))))
    while True:
        best = np.full(nodes, -1)
        if len(order):
            least = np.flatnonzero(rank == np.minimum.reduceat(rank, firsts)[owner])
            best[source[order][least[::-1]]] = least[::-1]  # the first of equals stays
        further = best[end] if len(order) else np.zeros(0, dtype=np.int64)
        if (further < 0).all():
            return np.where(best < 0, -1, order[best] if len(order) else -1)
        follows = np.where(further < 0, 0, rank[further])
        end = np.where(further < 0, end, end[further])
        _, rank = np.unique(rank * (rank.max() + 1) + follows, return_inverse=True)
        rank = rank.reshape(-1) + 1


def _walk(step: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Nodes from the entries on, a row for each; the last node of a path is repeated."""
    path, jump = entries[:, None], step
    while not (jump[path[:, -1]] == path[:, -1]).all():
        path = np.hstack([path, jump[path]])
        jump = jump[jump]
    return path


def _together(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Blocks in parts: of like sizes, with a bounded number of places when all are as long as the longest."""
    order, i = np.argsort(sizes, kind="stable"), 0
    while i < len(order):
        j = i + 1
        while j < len(order) and (j - i + 1) * (sizes[order[j]] + 4) <= TOGETHER:
            j += 1
        yield order[i:j]
        i = j


def _parts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of a column of blocks (lists of ``at`` and ``code``), part by part: numbers of the blocks, codes, places in order, bounds."""
    bounds, items = _ragged(column)
    at, code = [items.field(i).to_numpy(zero_copy_only=False) for i in range(2)]
    for chosen in _together(np.diff(bounds)):
        sizes = np.diff(bounds)[chosen]
        own = np.concatenate([[0], np.cumsum(sizes)])
        places = np.arange(own[-1]) - np.repeat(own[:-1] - bounds[:-1][chosen], sizes)
        yield chosen, code[places].astype(np.int64), at[places], own


@dataclass
class _Paths:
    """Cheapest edits of the blocks of a part, from one entry state each."""

    nodes: np.ndarray  # of the paths
    arcs: np.ndarray  # that leave them; -1 at the end
    letter: np.ndarray
    target: np.ndarray
    price: np.ndarray


def _paths(codes: np.ndarray, bounds: np.ndarray, given: np.ndarray, closes: np.ndarray, entries: list[np.ndarray]) -> list[_Paths]:
    cost = _costs_to_end(codes, bounds, given)
    source, letter, target, price = _arcs(codes, bounds, cost, closes)
    best = least_arcs(source, letter, target, cost.size)
    step = np.where(best < 0, np.arange(cost.size), target[best] if len(target) else 0)
    heads = (bounds[:-1] + np.arange(len(bounds) - 1)) * 4
    found = []
    for entry in entries:
        nodes = _walk(step, heads + entry)
        found.append(_Paths(nodes, best[nodes], letter, target, price))
    return found


# Scans over the blocks of a conversation ----------------------------------------------


def _scan(level: DataFrame, fold: Callable, spread: Callable) -> DataFrame:
    """``conv_id``, ``block``, ``given`` for blocks with a ``value`` each: what the other blocks of the conversation hand over.

    ``fold`` makes one value of the values of neighbours in order; ``spread(values, given)`` tells what each of them is
    given when all together are given something (None for all of a conversation). At most 2 to the power of
    :data:`BITS` blocks meet in a step; conversations of more blocks take further levels.
    """
    key, fan = level.schema["conv_id"], 1 << BITS
    total = level.groupBy(F.col("conv_id").alias("c")).agg(F.count("*").alias("n"))
    sized = level.join(total, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    group = F.when(F.col("n") <= fan, F.lit(0).cast("long")).otherwise(F.shiftright("block", BITS))
    runs = sized.withColumn("group", group).groupBy("conv_id", "group").agg(F.sort_array(F.collect_list(F.struct("block", "value"))).alias("own"), F.max("n").alias("n"))
    runs = stage(runs, "runs")
    large = runs.where(F.col("n") > fan)
    if large.isEmpty():
        handed = runs.withColumn("given", F.lit(None).cast("array<bigint>"))
    else:

        def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = [fold([np.array(x["value"]) for x in own]).tolist() for own in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(values, pa.list_(pa.int64()))], ["conv_id", "block", "value"])

        schema = T.StructType([key, T.StructField("block", T.LongType()), T.StructField("value", T.ArrayType(T.LongType()))])
        above = _scan(large.select("conv_id", "group", "own").mapInArrow(folded, schema), fold, spread)
        above = above.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), "given")
        handed = runs.join(above, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("group") == F.col("b")), "left")

    def spread_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, blocks, given = [], [], []
            for i, (own, handed_down) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                owners += [i] * len(own)
                blocks += [x["block"] for x in own]
                given += [x.tolist() for x in spread([np.array(x["value"]) for x in own], None if handed_down is None else np.array(handed_down))]
            conv = batch.column(0).take(pa.array(owners, pa.int64()))
            yield pa.RecordBatch.from_arrays([conv, pa.array(blocks, pa.int64()), pa.array(given, pa.list_(pa.int64()))], ["conv_id", "block", "given"])

    schema = T.StructType([key, T.StructField("block", T.LongType()), T.StructField("given", T.ArrayType(T.LongType()))])
    return stage(handed.select("conv_id", "own", "given").mapInArrow(spread_out, schema), "scan")


def _fold_costs(values: list[np.ndarray]) -> np.ndarray:
    total = values[0].reshape(4, 4)
    for value in values[1:]:
        total = _min_plus(total, value.reshape(4, 4))
    return total.reshape(-1)


def _spread_costs(values: list[np.ndarray], given: np.ndarray | None) -> list[np.ndarray]:
    """From the right: cost of all that follows a block, by state, and whether nothing does."""
    after, out = np.append(CLOSING, 1) if given is None else given, []
    for value in reversed(values):
        out.append(after)
        after = np.append(np.minimum((value.reshape(4, 4) + after[None, :4]).min(axis=1), FAR), 0)
    return out[::-1]


def _fold_states(values: list[np.ndarray]) -> np.ndarray:
    """State at the end for each state at the start, and the last initial."""
    total = np.arange(4)
    for value in values:
        total = value[:4][total]
    return np.append(total, values[-1][4])


def _spread_states(values: list[np.ndarray], given: np.ndarray | None) -> list[np.ndarray]:
    """From the left: the state before a block, and the initial before it (-1: none)."""
    state, initial = (START, -1) if given is None else given
    out = []
    for value in values:
        out.append(np.array([state, initial]))
        state, initial = value[state], value[4]
    return out


def _over_blocks(blocks: DataFrame, columns: list[str], field: T.StructField, work: Callable) -> DataFrame:
    """``conv_id``, ``block`` and an array of longs made of each block by ``work``, which gets parts of blocks at a time."""
    schema = T.StructType([blocks.schema["conv_id"], T.StructField("block", T.LongType()), field])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            more = [np.array(batch.column(3 + i).to_pylist()) for i in range(len(columns))]
            out: list = [None] * batch.num_rows
            for chosen, codes, _, bounds in _parts(batch.column(2)):
                for i, value in zip(chosen, work(codes, bounds, *[x[chosen] for x in more]), strict=True):
                    out[i] = value.tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int64()))], schema.names)

    return blocks.select("conv_id", "block", "own", *columns).mapInArrow(run, schema)


def _exits(codes: np.ndarray, bounds: np.ndarray, after: np.ndarray) -> Iterator[np.ndarray]:
    ways = [np.full(len(bounds) - 1, state) for state in range(4)]
    paths = _paths(codes, bounds, after[:, :4], after[:, 4] == 1, ways)
    return iter(np.column_stack([*[p.nodes[:, -1] & 3 for p in paths], codes[bounds[1:] - 1] & 3]))


def _with_neighbours(blocks: DataFrame) -> DataFrame:
    """Blocks with ``after`` (cost of what follows by state, then 1 if nothing does) and ``before`` (state, last initial)."""
    value = T.StructField("value", T.ArrayType(T.LongType()))
    total = blocks.groupBy(F.col("conv_id").alias("c")).agg(F.count("*").alias("n"))
    sized = blocks.join(total, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    longs = lambda *x: F.array(*[F.lit(int(v)).cast("long") for v in x])
    single = sized.where("n = 1").drop("n").withColumns({"after": longs(*CLOSING, 1), "before": longs(START, -1)})
    several = sized.where("n > 1").drop("n")
    if several.isEmpty():
        return single
    both = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))
    named = lambda scanned, name: scanned.select(F.col("conv_id").alias("c"), F.col("block").alias("b"), F.col("given").alias(name))
    costs = _over_blocks(several, [], value, lambda codes, bounds: iter(_block_costs(codes, bounds).reshape(-1, 16)))
    after = named(_scan(stage(costs, "costs"), _fold_costs, _spread_costs), "after")
    several = stage(several.join(after, both).drop("c", "b"), "blocks")
    states = stage(_over_blocks(several, ["after"], value, _exits), "states")
    before = named(_scan(states, _fold_states, _spread_states), "before")
    return single.unionByName(several.join(before, both).drop("c", "b"))


def _edited(blocks: DataFrame) -> DataFrame:
    """Per block: ``audit``, ``cost``, ``illegal`` (pairs of neighbours) and ``edits``, the turns that remain.

    An edit has the place ``at`` of its turn (NULL: inserted) and the role given to it (NULL: its own).
    """
    schema = T.StructType([blocks.schema["conv_id"], T.StructField("block", T.LongType())])
    schema = schema.add("audit", T.StringType()).add("cost", T.LongType()).add("illegal", T.LongType())
    schema = schema.add("edits", T.ArrayType(T.StructType().add("at", T.LongType()).add("role", T.StringType())))
    named = np.array([ROLES.get(s) for s in range(4)], dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            after = np.array(batch.column(3).to_pylist()).reshape(-1, 5)
            before = np.array(batch.column(4).to_pylist()).reshape(-1, 2)
            for chosen, codes, at, bounds in _parts(batch.column(2)):
                (found,) = _paths(codes, bounds, after[chosen, :4], after[chosen, 4] == 1, [before[chosen, 0]])
                real = found.arcs >= 0
                letter = np.where(real, found.letter[found.arcs], 0)
                cost = np.where(real, found.price[found.arcs], 0).sum(axis=1)
                audit = [LETTERS[row[:n]].tobytes().decode() for row, n in zip(letter, real.sum(axis=1), strict=True)]
                initials = codes & 3
                pairs = np.append(~LEGAL[initials[:-1], initials[1:]], False)
                pairs[bounds[1:] - 1] = False  # the next one belongs to another block
                illegal = np.add.reduceat(pairs.astype(np.int64), bounds[:-1])
                earlier = before[chosen, 1]
                illegal += (earlier >= 0) & ~LEGAL[np.maximum(earlier, 0), initials[bounds[:-1]]]
                stays = real & (letter != _D)
                rows, _ = np.nonzero(stays)
                turn = (found.nodes[stays] >> 2) - rows  # of this part, by place
                inserted, own_role = letter[stays] == _I, letter[stays] == _K
                places = pa.array(at[np.minimum(turn, len(at) - 1)], pa.int64(), mask=inserted)
                roles = pa.array(np.where(own_role, None, named[found.target[found.arcs[stays]] & 3]), pa.string())
                lists = np.concatenate([[0], np.cumsum(stays.sum(axis=1))]).astype(np.int32)
                edits = pa.ListArray.from_arrays(lists, pa.StructArray.from_arrays([places, roles], ["at", "role"]))
                own = pa.array(chosen)
                columns = [batch.column(0).take(own), batch.column(1).take(own), pa.array(audit, pa.string()), pa.array(cost, pa.int64()), pa.array(illegal, pa.int64()), edits]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return blocks.select("conv_id", "block", "own", "after", "before").mapInArrow(run, schema)


# The operator -----------------------------------------------------------------------


@dataclass
class Repaired:
    """``conversations``: a row for each with its faults, cost and audit. ``turns``: ``conv_id``, ``block``, ``pos`` (in
    order of block and position), ``role``, ``text``."""

    conversations: DataFrame
    turns: DataFrame


def repair(turns: DataFrame) -> Repaired:
    """Faults and cheapest repair of conversations given as ``conv_id``, ``turn`` (long), ``role``, ``text``.

    Role and text must not be NULL. A NULL conversation id is a conversation of its own, a NULL turn comes first. A turn
    is blank (white space only), else duplicate (role and text seen before), else truncated (no ``.``, ``!`` or ``?`` at its end).
    ``gaps`` are numbers missing between the least and the largest turn, NULL where that exceeds a long. Only
    conversations with turns have rows; an empty table has none. An audit is one string, however long the conversation.
    """
    turns = in_order(turns)
    faults = _fault_rows(turns)
    one = lambda name: F.count(F.when(F.col("fault") == name, 1)).alias(name)
    wide = lambda c: c.cast("decimal(20,0)")
    distinct = F.count_distinct("turn")
    gaps = F.coalesce((wide(F.max("turn")) - wide(F.min("turn")) + 1 - wide(distinct)).try_cast("long"), F.when(distinct == 0, 0))
    counted = faults.groupBy("conv_id").agg(gaps.alias("gaps"), one("blank"), one("duplicate"), one("truncated"))
    gone = F.coalesce(F.col("fault").isin("blank", "duplicate"), F.lit(False))
    code = F.col("initial") + F.when(gone, 8).otherwise(0) + F.when(F.col("fault") == "truncated", 4).otherwise(0)
    own = F.sort_array(F.collect_list(F.struct("at", code.alias("code")))).alias("own")
    blocks = stage(faults.groupBy("conv_id", F.shiftright("at", BITS).alias("block")).agg(own), "blocks")
    edited = stage(_edited(_with_neighbours(blocks)), "edits")
    audits = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), "")
    costs = edited.groupBy(F.col("conv_id").alias("c")).agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), audits.alias("audit"))
    conversations = counted.join(costs, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    left = edited.select("conv_id", "block", F.posexplode("edits").alias("pos", "edit")).select("conv_id", "block", "pos", F.col("edit.at").alias("at"), F.col("edit.role").alias("given"))
    texts = turns.select("at", "role", "text")
    role = F.coalesce("given", "role").alias("role")
    kept = left.join(texts, "at").select("conv_id", "block", "pos", role, "text")
    inserted = left.where("at IS NULL").select("conv_id", "block", "pos", F.col("given").alias("role"), F.lit("").alias("text"))
    return Repaired(conversations, kept.unionByName(inserted))


def digest(turns: DataFrame) -> DataFrame:
    """``conv_id`` and SHA-256 of the lines ``role:text`` of each conversation, joined by newlines.

    The hash of a text is sequential by its nature: a conversation's lines pass through one task, one batch at a time.
    """
    schema = T.StructType([turns.schema["conv_id"], T.StructField("sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, none = None, None, True
        for batch in batches:
            ids, lines = batch.column(0), batch.column(1).cast(pa.binary()).to_pylist()
            done_ids, done = [], []
            for conv, line in zip(ids.to_pylist(), lines, strict=True):
                if none or conv != current:
                    if not none:
                        done_ids.append(current)
                        done.append(state.hexdigest())
                    current, state, none = conv, hashlib.sha256(line), False
                else:
                    state.update(b"\n" + line)
            yield pa.RecordBatch.from_arrays([pa.array(done_ids, ids.type), pa.array(done, pa.string())], schema.names)
            last = ids.type
        if not none:
            yield pa.RecordBatch.from_arrays([pa.array([current], last), pa.array([state.hexdigest()], pa.string())], schema.names)

    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "block", "pos")
    return dealt.select("conv_id", F.concat("role", F.lit(":"), "text").alias("line")).mapInArrow(run, schema)


def with_all(conversations: DataFrame, repaired: Repaired) -> DataFrame:
    """One row for every conversation id, with ``repaired_sha256``. Those without turns left have zeros and empty texts."""
    every = conversations.select("conv_id").distinct()
    found = repaired.conversations.withColumnRenamed("conv_id", "c")
    hashed = digest(repaired.turns).withColumnRenamed("conv_id", "d")
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left").join(hashed, F.col("conv_id").eqNullSafe(F.col("d")), "left")
    zero = lambda name: F.when(F.col("audit").isNull(), 0).otherwise(F.col(name)).cast("long").alias(name)
    numbers = [zero(name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing: Column = F.sha2(F.lit(""), 256)
    return joined.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", nothing).alias("repaired_sha256"))
