"""SentencePiece encoding and decoding over a relational lattice.

Texts are cut into units at word starts, which no piece crosses, and these into parts at the other borders that no piece
can cross. A task sends its distinct parts through the lattice: their distinct substrings that can be pieces (all their
letters in fours lie in pieces) are exploded and joined with the piece table, and the pieces found are put
together by part: the edges of its lattice. A fold over the edges chooses the path. The vocabulary is one of byte-pair
encoding, whose path isn't the one of the best sum of scores: it comes from merging, again and again, the two neighbours
whose union is the best piece. So the fold, a higher-order aggregate with the open borders as its state, takes the edges
from the best to the worst and closes the border inside each that joins two neighbours. Where a piece can appear only
after a worse or equal one, it starts again after each merge. (Parts of more than 61 characters don't fit the state's
bits; the same rule folds them with a heap.) Behind the parts follow the texts that ask for them, as lists of numbers, so
a text is put together in the task that read it and nothing is shuffled.
"""

from __future__ import annotations

import heapq
import itertools
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.llm.rows import binary

SPACE = "▁"
UNIT = re.compile(f"{SPACE}+[^{SPACE}]*")
#: Characters whose borders fit the bits of the state.
LONGEST = 61
#: Ids of <0x00> and the following bytes: fixed by vocabularies with byte fallback.
BYTE_0 = 3
#: Units a task remembers the parts of.
REMEMBERED = 200_000
#: Texts that are cut, and put together, at once.
SLICE = 128
#: Bits of the numbers of letters in twos, threes and fours. Two with one number cost a substring more, nothing else.
BITS = 20


def units(text: str) -> list[str]:
    """Runs of spaces with the word that follows; the text begins with one more space. No text, no unit."""
    return UNIT.findall(SPACE + text.replace(" ", SPACE)) if text else []


def piece_table(spark: SparkSession, model: str) -> tuple[DataFrame, list[str]]:
    """Normal pieces (``piece``, ``id``, ``score``), and the piece of each id. The table is as large as the vocabulary."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
    rows = [
        (p, i, float(processor.get_score(i)))
        for i, p in enumerate(pieces)
        if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i) or processor.is_unused(i))
    ]
    # From Arrow: rows of Python would go through a worker on every executor, which stays there.
    kinds = (pa.string(), pa.int32(), pa.float64())
    columns = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return spark.createDataFrame(pa.table(columns, names=["piece", "id", "score"])), pieces


class Numbers(dict):
    """Numbers keys from 0 in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def _grams(codes: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the ``n`` letters from each place on."""
    out = np.zeros(max(0, len(codes) - n + 1), dtype=np.uint64)
    for i in range(n):
        out = (out + codes[i : i + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out >> np.uint64(64 - BITS)


@dataclass
class Vocabulary:
    """What tasks have to know of the pieces; as large as the vocabulary."""

    pairs: np.ndarray  # by number: letters in twos that are pieces
    triples: np.ndarray  # letters in threes that lie in a piece,
    first: np.ndarray  # begin one,
    last: np.ndarray  # end one
    fours: np.ndarray  # letters in fours that lie in a piece
    longest: int
    characters: dict[str, int]
    late: set[str]  # pieces that can appear only after a worse or equal one

    @classmethod
    def of(cls, scores: dict[str, float], ids: dict[str, int], longest: int) -> Vocabulary:
        def known(texts: list[str], n: int) -> np.ndarray:
            found = np.zeros(1 << BITS, dtype=bool)
            if texts:
                found[_grams(_codes("".join(texts)), n)[::n]] = True
            return found

        long = [p for p in scores if len(p) > 2]
        late = set()
        for piece in scores:
            at = [scores[p] for p in _merges(piece, scores)]
            if any(score <= at[-1] for score in at[:-1]):
                late.add(piece)
        return cls(
            known([p for p in scores if len(p) == 2], 2),
            known([p[i : i + 3] for p in long for i in range(len(p) - 2)], 3),
            known([p[:3] for p in long], 3),
            known([p[-3:] for p in long], 3),
            known([p[i : i + 4] for p in long for i in range(len(p) - 3)], 4),
            longest,
            {p: ids[p] for p in scores if len(p) == 1},
            late,
        )

    def cut(self, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the parts of units, one after the other, begin; where substrings that can be pieces do, and their lengths."""
        n = len(codes)
        ends = np.cumsum(sizes)
        left = np.repeat(ends, sizes) - np.arange(n)  # letters left in the unit
        numbers = np.pad(_grams(codes, 2), (0, min(n, 1)))
        pair = self.pairs[numbers] & (left >= 2)
        numbers = np.pad(_grams(codes, 3), (0, min(n, 2)))
        inside = left >= 3
        triple = self.triples[numbers] & inside
        crossed = pair | triple  # whether a piece can cross the border behind a letter
        crossed[1:] |= triple[:-1]
        begins = np.flatnonzero(np.r_[True, ~crossed[:-1]]) if n else np.zeros(0, dtype=np.int64)
        four = self.fours[np.pad(_grams(codes, 4), (0, min(n, 3)))] & (left >= 4)
        stop = np.where(four, n, np.arange(n))
        stop = np.minimum.accumulate(stop[::-1])[::-1]  # the next place from which no four letters go on
        most = np.where(self.first[numbers] & triple, np.minimum(stop - np.arange(n) + 3, self.longest), 2)
        at = np.repeat(np.arange(n), most - 2)
        length = np.arange(len(at)) - np.repeat(np.cumsum(most - 2) - (most - 2), most - 2) + 3
        ending = self.last[numbers[at + length - 3]]
        two = np.flatnonzero(pair)
        return begins, np.r_[two, at[ending]], np.r_[np.full(len(two), 2), length[ending]]


def _merges(text: str, scores: dict[str, float]) -> list[str]:
    """The pieces that merging makes of a text, in that order."""
    symbols, made = list(text), []
    while True:
        joined = [a + b for a, b in itertools.pairwise(symbols)]
        known = [i for i, x in enumerate(joined) if x in scores]
        if not known:
            return made
        i = max(known, key=lambda i: (scores[joined[i]], -i))
        made.append(joined[i])
        symbols[i : i + 2] = [joined[i]]


class Substrings:
    """Numbers substrings, told apart by 64 bits, in the order in which they come."""

    def __init__(self) -> None:
        self.forget(0)

    def forget(self, floor: int) -> None:
        self.floor = self.next = floor
        self.hashes, self.numbers = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)

    def of(self, codes: np.ndarray, at: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each substring; which of them are new, by number."""
        hashes = length.astype(np.uint64)
        for i in range(int(length.max(initial=0))):
            some = np.flatnonzero(length > i)
            mixed = (hashes[some] + codes[at[some] + i]) * np.uint64(0x9E3779B97F4A7C15)
            hashes[some] = mixed ^ (mixed >> np.uint64(29))
        found, index, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, found)
        old = np.zeros(len(found), dtype=bool)
        inner = np.flatnonzero(place < len(self.hashes))
        old[inner] = self.hashes[place[inner]] == found[inner]
        numbers = np.zeros(len(found), dtype=np.int64)
        numbers[old] = self.numbers[place[old]]
        fresh = np.flatnonzero(~old)
        numbers[fresh] = self.next + np.arange(len(fresh))
        self.next += len(fresh)
        self.hashes = np.insert(self.hashes, place[fresh], found[fresh])
        self.numbers = np.insert(self.numbers, place[fresh], numbers[fresh])
        return numbers[inverse], index[fresh]


def _pack(*arrays: np.ndarray) -> bytes:
    data = np.concatenate([[len(x) for x in arrays], *arrays]).astype(np.int32).tobytes()
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int) -> list[np.ndarray]:
    plain = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    values = np.frombuffer(plain, dtype=np.int32).astype(np.int64)
    return np.split(values[n:], np.cumsum(values[:n])[:-1])


def _listed(rows: DataFrame, split: Callable[[str], list[str]], vocabulary: object) -> DataFrame:
    """Of each slice of texts new substrings (``new``, numbered from ``base`` on), new parts, and the rows asking for parts.

    The last column of ``rows`` is the text; the others stay. ``data`` has all that only Python reads.
    """
    kept = rows.columns[:-1]
    schema = T.StructType().add("kind", "integer").add("base", "long").add("new", T.ArrayType(T.StringType())).add("data", "binary")
    schema = T.StructType([*schema.fields, *[T.StructField(f.name, f.dataType) for f in rows.schema.fields[:-1]]])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(**vocabulary.value)
        words, parts, substrings = Numbers(), Numbers(), Substrings()
        of, sizes_of = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)  # numbers of the parts of each unit
        for whole in batches:
            for i in range(0, whole.num_rows, SLICE):
                batch = whole.slice(i, SLICE)
                if len(words) > REMEMBERED:
                    words, parts = Numbers(), Numbers()
                    of, sizes_of = of[:0], sizes_of[:0]
                    substrings.forget(substrings.next)
                n_words, n_parts = len(words), len(parts)
                asked = []
                for text in binary(batch.column(len(kept))):
                    found = split(text.decode("utf-8"))
                    asked.append(np.fromiter(map(words.__getitem__, found), dtype=np.int64, count=len(found)))
                new = list(itertools.islice(words, n_words, None))
                if new:
                    joined = "".join(new)
                    codes = _codes(joined)
                    sizes = np.fromiter(map(len, new), dtype=np.int64, count=len(new))
                    begins, at, length = known.cut(codes, sizes)
                    ends = np.r_[begins[1:], len(joined)]
                    pieces = [joined[a:b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                    numbers = np.fromiter(map(parts.__getitem__, pieces), dtype=np.int64, count=len(pieces))
                    of = np.r_[of, numbers]
                    unit = np.searchsorted(np.cumsum(sizes), begins, side="right")
                    sizes_of = np.r_[sizes_of, np.bincount(unit, minlength=len(new))]
                    # A new part is taken where it is met first: there its number is larger than all before.
                    fresh = np.flatnonzero(numbers > np.maximum.accumulate(np.r_[n_parts - 1, numbers])[:-1])
                    place = np.full(len(pieces), -1)
                    place[fresh] = np.arange(len(fresh))
                    owner = np.repeat(np.arange(len(begins)), ends - begins)[at]
                    mine = place[owner] >= 0
                    at, length, owner = at[mine], length[mine], owner[mine]
                    base = substrings.next
                    numbers, first = substrings.of(codes, at, length)
                    texts = [joined[a:b] for a, b in zip(at[first].tolist(), (at + length)[first].tolist(), strict=True)]
                    letters = _gathered(codes, begins[fresh], (ends - begins)[fresh])
                    since = substrings.next - substrings.floor
                    data = [[n_parts, *divmod(substrings.floor, 1 << 30), since], (ends - begins)[fresh], letters]
                    start = (np.cumsum(data[1]) - data[1])[place[owner]]
                    data = _pack(*data, np.diff(start + at - begins[owner], prepend=0), numbers - substrings.floor)
                    columns = [pa.array([0, 1], pa.int32()), pa.array([base, 0]), pa.array([texts, [None]], pa.list_(pa.string()))]
                    columns += [pa.array([b"", data]), *(pa.nulls(2, batch.column(c).type) for c in range(len(kept)))]
                    yield pa.RecordBatch.from_arrays(columns, names)
                begin = np.cumsum(sizes_of) - sizes_of
                n = batch.num_rows
                columns = [pa.array([2] * n, pa.int32()), pa.array([0] * n), pa.array([[None]] * n, pa.list_(pa.string()))]
                columns.append(pa.array([_gathered(of, begin[x], sizes_of[x]).astype(np.int32).tobytes() for x in asked], pa.binary()))
                yield pa.RecordBatch.from_arrays([*columns, *batch.columns[: len(kept)]], names)

    return rows.mapInArrow(run, schema)


def _gathered(values: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` one after the other."""
    ends = np.cumsum(sizes)
    total = ends[-1] if len(ends) else 0
    return values[np.arange(total) + np.repeat(begins - ends + sizes, sizes)]


def lattices(listed: DataFrame, table: DataFrame, place: object) -> DataFrame:
    """The parts (``number``) with their ``edges``, best first (borders at the ends, inside), and the rows of :func:`_listed`.

    Explode and the join with the broadcast table keep rows in order, so what is found comes before the parts it is for.
    """
    rest = [f.name for f in listed.schema.fields[4:]]
    exploded = listed.select("kind", "base", "data", *[f"`{c}`" for c in rest], F.posexplode("new").alias("pos", "piece"))
    found = exploded.join(F.broadcast(table), "piece", "left").where((F.col("kind") > 0) | F.col("id").isNotNull())
    found = found.select("kind", (F.col("base") + F.col("pos")).alias("n"), F.col("id").alias("found"), "data", *[f"`{c}`" for c in rest])
    schema = T.StructType().add("number", "integer").add("n", "integer").add("late", "boolean")
    schema = schema.add("edges", T.ArrayType(T.StructType().add("ends", "long").add("inside", "long")))
    schema = schema.add("body", "binary").add("path", "binary")
    schema = T.StructType([*schema.fields, *[T.StructField(f.name, f.dataType) for f in listed.schema.fields[4:]]])
    names = schema.names

    def edges(offsets: np.ndarray, ends: np.ndarray, inside: np.ndarray) -> pa.Array:
        borders = pa.StructArray.from_arrays([pa.array(ends), pa.array(inside)], ["ends", "inside"])
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), borders)

    def put_together(data: list[np.ndarray], known: np.ndarray, kinds: list[pa.DataType]) -> pa.RecordBatch:
        (begin, *_), sizes, letters, s, substring = data
        ids, s = known[substring], np.cumsum(s)
        length, ranks = place.value[:, np.maximum(ids, 0)]
        order = np.flatnonzero(ids >= 0)
        owner = np.repeat(np.arange(len(sizes)), sizes)[s]
        s = s - (np.cumsum(sizes) - sizes)[owner]
        order = order[np.lexsort((s[order], np.abs(ranks[order]), owner[order]))]
        owner, s, e, ids, late = owner[order], s[order], (s + length)[order], ids[order], ranks[order] < 0
        n = len(sizes)
        counts = np.bincount(owner, minlength=n)
        offsets = np.r_[0, np.cumsum(counts)]
        # Places and ids of the edges of each part; the text as code points.
        path = np.stack([s, e, ids], axis=1).reshape(-1)
        bodies, paths = _cells(letters, sizes), _cells(path, counts * 3)
        one, fits = np.int64(1), e <= 62
        a, b = np.where(fits, s, 0), np.where(fits, e, 0)
        number = pa.array(np.arange(begin, begin + n).astype(np.int32))
        columns = [number, pa.array(sizes.astype(np.int32)), pa.array(np.bincount(owner[late], minlength=n) > 0)]
        columns += [edges(offsets, (one << a) | (one << b), (one << b) - (one << (a + 1))), bodies, paths]
        return pa.RecordBatch.from_arrays([*columns, *(pa.nulls(n, kind) for kind in kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, floor = np.zeros(0, dtype=np.int64), 0
        for batch in batches:
            kind = batch.column(0).to_numpy()
            number, found = batch.column(1).to_numpy(), batch.column(2).fill_null(-1).to_numpy()
            kinds = [c.type for c in batch.columns[4:]]
            change = np.flatnonzero(np.diff(kind, prepend=-1) | (kind == 1))
            for a, b in itertools.pairwise([*change.tolist(), len(kind)]):
                if kind[a] == 0:
                    top = number[b - 1] + 1 - floor
                    if top > len(known):
                        known = np.r_[known, np.full(max(top - len(known), len(known)), -1)]
                    known[number[a:b] - floor] = found[a:b]
                elif kind[a] == 1:
                    data = _unpack(batch.column(3)[a].as_py(), 5)
                    _, high, low, since = data[0].tolist()
                    low += high << 30
                    if low > floor:
                        known, floor = known[low - floor :], low
                    if since > len(known):
                        known = np.r_[known, np.full(max(since - len(known), len(known)), -1)]
                    yield put_together(data, known, kinds)
                else:
                    n = b - a
                    none = np.zeros(0, dtype=np.int64)
                    columns = [pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.bool_())]
                    columns += [edges(np.zeros(n + 1), none, none), batch.column(3).slice(a, n), _cells(none, np.zeros(n, dtype=np.int64))]
                    yield pa.RecordBatch.from_arrays([*columns, *(c.slice(a, n) for c in batch.columns[4:])], names)

    return found.mapInArrow(run, schema)


def _cells(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Lists of numbers as binary, which costs Spark less to write."""
    offsets = np.r_[0, np.cumsum(sizes) * 4].astype(np.int32)
    data = np.ascontiguousarray(values, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _numbers(cells: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all lists, and where each list begins and the last ends."""
    _, offsets, data = cells.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int32)[cells.offset : cells.offset + len(cells) + 1]
    values = np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]].view(np.int32) if data else np.zeros(0, dtype=np.int32)
    return values.astype(np.int64), (bounds - bounds[0]) // 4


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), i)


def fold(found: DataFrame) -> DataFrame:
    """Adds ``open``: the borders that stay open in each lattice of up to :data:`LONGEST` (``n``) characters."""

    def joins(borders: Column, x: Column) -> Column:
        return (borders.bitwiseAND(x["ends"]) == x["ends"]) & (F.bit_count(borders.bitwiseAND(x["inside"])) == 1)

    def close(borders: Column, x: Column) -> Column:
        return F.when(joins(borders, x), borders.bitwiseAND(F.bitwise_not(x["inside"]))).otherwise(borders)

    def best(borders: Column, _: Column) -> Column:
        first = F.get(F.filter("edges", lambda x: joins(borders, x)), F.lit(0))
        return F.coalesce(borders.bitwiseAND(F.bitwise_not(first["inside"])), borders)

    n = F.col("n")
    start = _bit(n + 1) - 1
    again = F.aggregate(F.sequence(F.lit(1), n), start, best)
    once = F.aggregate("edges", start, close)
    return found.withColumn("open", F.when(n <= LONGEST, F.when(F.col("late"), again).otherwise(once))).drop("late", "edges")


def merge(n: int, edges: list[tuple[int, int, float | None, list[int]]]) -> list[int]:
    """The ids of one part of any length, from its edges (``s``, ``e``: borders; score; ids)."""
    at = {(s, e): (score, ids) for s, e, score, ids in edges}
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    queue: list[tuple[float, int, int, int]] = []

    def offer(left: int) -> None:
        middle = after[left]
        if middle < n and (left, after[middle]) in at:
            heapq.heappush(queue, (-at[left, after[middle]][0], left, middle, after[middle]))

    for i in range(n):
        offer(i)
    alive = [True] * n
    while queue:
        _, left, middle, end = heapq.heappop(queue)
        if alive[left] and middle < n and alive[middle] and after[left] == middle and after[middle] == end:
            after[left], alive[middle] = end, False
            if end < n:
                before[end] = left
            offer(left)
            if before[left] >= 0:
                offer(before[left])
    out: list[int] = []
    i = 0
    while i < n:
        out += at[i, after[i]][1]
        i = after[i]
    return out


def _paths(parts: pa.Array, opened: pa.Array, paths: pa.Array, characters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of parts one after the other, and how many each has. A character without a piece has its bytes' ids."""
    codes, bounds = _numbers(parts)
    sizes = np.diff(bounds).astype(np.int64)
    edges, at = _numbers(paths)
    counts = np.diff(at) // 3
    s, e, piece = edges.reshape(-1, 3).T
    long = opened.is_null().to_numpy(zero_copy_only=False)
    borders = opened.fill_null(0).to_numpy()
    owner = np.repeat(np.arange(len(parts)), counts)
    one, state = np.int64(1), borders[owner]
    a, b = np.minimum(s, 62), np.minimum(e, 62)
    on = (state >> a) & (state >> b) & one
    on = (on == 1) & (state & ((one << b) - (one << np.minimum(a + 1, 62))) == 0)
    whose = np.repeat(np.arange(len(parts)), sizes)
    i = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    state = borders[whose]
    single = (state >> np.minimum(i, 62)) & (state >> np.minimum(i + 1, 62)) & one == 1
    known = characters[codes]
    plain = np.flatnonzero(single & (known >= 0))
    # Owner, place and id of all that is on a path; bytes of a character have places behind each other.
    rows = [(owner[on], s[on] * 8, piece[on]), (whose[plain], i[plain] * 8, known[plain])]
    odd = np.flatnonzero(single & (known < 0))
    data = [(int(k), j, x + BYTE_0) for k in odd for j, x in enumerate(chr(codes[k]).encode())]
    if data:
        k, j, x = (np.array(c) for c in zip(*data, strict=True))
        rows.append((whose[k], i[k] * 8 + j, x))
    begin = np.cumsum(counts) - counts
    for k in np.flatnonzero(long).tolist():
        edges = slice(begin[k], begin[k] + counts[k])
        ordered = zip(s[edges].tolist(), e[edges].tolist(), itertools.count(0, -1), ([x] for x in piece[edges].tolist()))
        text = codes[bounds[k] : bounds[k + 1]].tolist()
        alone = [[characters[c]] if characters[c] >= 0 else [x + BYTE_0 for x in chr(c).encode()] for c in text]
        path = merge(len(text), [*((m, m + 1, None, x) for m, x in enumerate(alone)), *ordered])
        rows.append((np.full(len(path), k), np.arange(len(path)), np.array(path)))
    owner, place, out = (np.concatenate(c) for c in zip(*rows, strict=True))
    return out[np.lexsort((place, owner))].astype(np.int32), np.bincount(owner, minlength=len(parts))


def _encoded(rows: DataFrame, split: Callable[[str], list[str]], table: DataFrame, longest: int) -> DataFrame:
    """``rows`` with ``ids`` in place of their last column, the text."""
    spark = rows.sparkSession
    pieces = table.collect()
    known = Vocabulary.of({p["piece"]: p["score"] for p in pieces}, {p["piece"]: p["id"] for p in pieces}, longest)
    vocabulary = spark.sparkContext.broadcast(vars(known))
    rank = {score: i for i, score in enumerate(sorted({p["score"] for p in pieces}, reverse=True), 1)}
    # Of each id its length and its place among the scores: 1 is the best; negative: late.
    place = np.zeros((2, 1 + max(p["id"] for p in pieces)), dtype=np.int64)
    for p in pieces:
        place[:, p["id"]] = len(p["piece"]), -rank[p["score"]] if p["piece"] in known.late else rank[p["score"]]
    found = lattices(_listed(rows, split, vocabulary), table.select("piece", "id"), spark.sparkContext.broadcast(place))
    kept = rows.schema.fields[:-1]
    folded = fold(found).select("number", "body", "open", "path", *[f"`{f.name}`" for f in kept])
    schema = T.StructType([*kept, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        characters = np.full(0x110000, -1, dtype=np.int32)
        for character, number in vocabulary.value["characters"].items():
            characters[ord(character)] = number
        ids, sizes = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        begins = sizes
        for whole in batches:
            number = whole.column(0).fill_null(-1).to_numpy()
            change = np.flatnonzero(np.diff(np.minimum(number, 0), prepend=-2) | (number == 0))
            for a, b in itertools.pairwise([*change.tolist(), len(number)]):
                for at in range(a, b, SLICE if number[a] < 0 else b):
                    batch = whole.slice(at, min(SLICE, b - at) if number[a] < 0 else b - at)
                    if number[a] >= 0:
                        new, more = _paths(*(batch.column(i) for i in (1, 2, 3)), characters)
                        if number[a] == 0:
                            ids, sizes = ids[:0], sizes[:0]
                        assert number[a] == len(sizes), "parts are not in the order in which they were numbered"
                        ids, sizes = np.r_[ids, new], np.r_[sizes, more]
                        begins = np.cumsum(sizes) - sizes
                        continue
                    asked, bounds = _numbers(batch.column(1))
                    ends = np.r_[0, np.cumsum(sizes[asked])]
                    found = _gathered(ids, begins[asked], sizes[asked])
                    got = pa.ListArray.from_arrays(pa.array(ends[bounds].astype(np.int32)), pa.array(found))
                    yield pa.RecordBatch.from_arrays([*batch.columns[4:], got], names)

    return folded.mapInArrow(run, schema)


def encode_units(words: DataFrame, table: DataFrame, longest: int) -> DataFrame:
    """``unit`` and ``ids`` of single units."""
    return _encoded(words.select("unit", F.col("unit").alias("text")), lambda unit: [unit], table, longest)


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, ``row_hash`` and ``ids``, the piece ids that ``sentencepiece`` gives.

    For vocabularies of byte-pair encoding with byte fallback that leave texts as they are but for the space put before
    them. A NULL or empty text has no ids. Repeated rows and rows with a NULL id are encoded alike; an empty table gives
    an empty table.
    """
    table, pieces = piece_table(docs.sparkSession, model)
    longest = max(len(p) for p in pieces[BYTE_0 + 256 :])
    row = F.xxhash64(id_col, text_col).alias("row_hash")
    return _encoded(docs.select(F.col(id_col).cast("long").alias(id_col), row, F.col(text_col)), units, table, longest)


def decode(rows: DataFrame, model: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with ``text``, decoded from the ids (NULL: NULL). Runs of byte pieces become characters again.

    A column named ``text`` is replaced. Bytes that are no UTF-8 become replacement characters, one for each.
    """
    _, pieces = piece_table(rows.sparkSession, model)
    names = [c for c in rows.columns if c.lower() != "text"]
    at = names.index(ids_col)
    tokens = [bytes([i - BYTE_0]) if 0 <= i - BYTE_0 < 256 else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
    tokens = rows.sparkSession.sparkContext.broadcast(tokens)  # as large as the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = np.array(tokens.value, dtype=object)
        for whole in batches:
            for i in range(0, whole.num_rows, SLICE):
                batch = whole.slice(i, SLICE)
                texts = []
                for ids in batch.column(at):
                    data = b"".join(piece[ids.values.to_numpy()].tolist()) if ids.is_valid else None
                    texts.append(data and data.removeprefix(b" ").decode("utf-8", "replace") if data != b"" else "")
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, "text"])

    ordered = rows.select(*names)
    return ordered.mapInArrow(run, T.StructType([*ordered.schema.fields]).add("text", "string"))
