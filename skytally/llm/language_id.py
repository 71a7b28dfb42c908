"""Languages of texts and of the spans inside them.

Training counts runs of one to three letters by language over all labelled documents, into a table of fixed size. A word
scores in a language by the logarithms of its runs' shares. The script of its letters narrows the languages to those
that were seen to use the script, and Viterbi over the words of a text, with a penalty for a change of language, labels
spans. The language of the text is that of most of its letters.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.session import stage

UNKNOWN = "und"
#: Runs of letters are told apart by so many bits; the table has 2 to this power entries for each length and language.
BITS = 15
LENGTHS = (1, 2, 3)
#: Added to every count of a run.
SMOOTHING = 0.5
#: Natural logarithm of what a change of language between two words costs.
PENALTY = 12.0
#: Score of a word in a language that does not use its script.
OUT_OF_REACH = -1e4
#: Share of the letters of a language that have to be in a script for its words to be candidates.
SCRIPT_SHARE = 0.002
#: Letters of a word at most; a longer run of letters is several words.
LONGEST = 64
#: Characters that are worked on together, and texts. A longer text is a part of its own.
TOGETHER, TEXTS = 8_000_000, 4_000
#: Numbers of scores that are looked up together.
LOOKED_UP = 4_000_000
#: First and last code points of scripts. Letters elsewhere count as one further script.
SCRIPTS = {
    "Latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "Greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "Cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "Armenian": [(0x530, 0x58F)],
    "Hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "Arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "Devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "Bengali": [(0x980, 0x9FF)],
    "Tamil": [(0xB80, 0xBFF)],
    "Telugu": [(0xC00, 0xC7F)],
    "Thai": [(0xE00, 0xE7F)],
    "Georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)],
    "Hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xA960, 0xA97F), (0xAC00, 0xD7FF)],
    "Ethiopic": [(0x1200, 0x139F), (0x2D80, 0x2DDF)],
    "Kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)],
    "Han": [(0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
N_SCRIPTS = len(SCRIPTS) + 1
_tables: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """By code point: 0 for no letter, else 1 plus the number of its script. Marks that combine count as letters."""
    if "kinds" not in _tables:
        kinds = np.zeros(0x110000, dtype=np.uint8)
        kind = unicodedata.category
        for point in range(0x41, 0x323B0):
            if kind(chr(point))[0] in "LM":
                kinds[point] = N_SCRIPTS
        for number, ranges in enumerate(SCRIPTS.values(), start=1):
            for low, high in ranges:
                part = kinds[low : high + 1]
                part[part > 0] = number
        _tables["kinds"] = kinds
    return _tables["kinds"]


@dataclass
class _Words:
    """Words (runs of letters, in pieces of at most :data:`LONGEST`) of several texts, the texts one after the other."""

    points: np.ndarray  # lower-cased code points of all texts, a space after each
    kinds: np.ndarray  # of the points, by ``_letters``
    starts: np.ndarray  # of the words, in points
    ends: np.ndarray
    text: np.ndarray  # number of the word's text


def _words(texts: list[str]) -> _Words:
    lowered = [x.lower() for x in texts]
    joined = " ".join([*lowered, ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds = _letters()[points]
    edges = np.diff((kinds > 0).view(np.int8), prepend=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    pieces = -(-(ends - starts) // LONGEST)
    if len(pieces) and pieces.max() > 1:
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts, ends = np.repeat(starts, pieces) + nth * LONGEST, np.repeat(ends, pieces)
        ends = np.minimum(ends, starts + LONGEST)
    bounds = np.cumsum([len(x) + 1 for x in lowered])
    return _Words(points, kinds, starts, ends, np.searchsorted(bounds, starts, side="right"))


def _runs(points: np.ndarray, solid: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: places of the last characters of the runs, and the runs' numbers in the table.

    Runs of two and three reach one place beyond the word, which tells its beginning and end. A word of n letters has
    n, n + 1 and n runs of the three lengths. No run reaches before the first place.
    """
    own = np.where(solid, points, np.uint32(0))
    before = np.concatenate([np.zeros(min(1, len(own)), dtype=np.uint32), own[:-1]])
    second = np.concatenate([np.zeros(min(1, len(own)), dtype=np.uint32), before[:-1]])
    left = before > 0
    for length in LENGTHS:
        value = own + np.uint32(length)
        if length > 1:
            value = value * np.uint32(0x9E3779B1) + before
        if length > 2:
            value = value * np.uint32(0x85EBCA77) + second
        places = np.flatnonzero([solid, solid | left, left][length - 1])
        value = value[places]
        value = (value ^ (value >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        yield places, ((value ^ (value >> np.uint32(12))) * np.uint32(0x297A2D39)) >> np.uint32(32 - BITS)


def _parts(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Neighbours that are worked on together."""
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if i > first and (held + size > TOGETHER or i - first >= TEXTS):
            yield first, i
            first, held = i, 0
        held += size
    if first < len(sizes):
        yield first, len(sizes)


# Training ------------------------------------------------------------------------------


def quarter(doc_id: Column) -> Column:
    """One of four parts by the checksum of the id as text; training does not see part 2. NULL without an id."""
    return F.crc32(doc_id.cast("string")) % 4


@dataclass
class Model:
    """``shares``: per length of runs an array of entry x language with logarithms of shares. ``scripts``: script x language, whether the language uses the script."""

    languages: list[str]
    shares: list[np.ndarray]
    scripts: np.ndarray


def count_runs(labelled: DataFrame) -> DataFrame:
    """``lang``, ``kind``, ``entry``, ``n`` over all rows of ``lang`` and ``text``.

    Kinds 1 to 3 are lengths of runs, kind 0 counts letters by script. Tasks add up what they read before it is
    exchanged: a row for each entry that occurs, of at most 2 to the power of :data:`BITS` for each kind and language.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                total = totals.setdefault(lang, np.zeros((1 + len(LENGTHS), 1 << BITS), dtype=np.int64))
                for first, last in _parts(np.array([len(x) for x in texts])):
                    words = _words(texts[first:last])
                    for kind, (_, entries) in enumerate(_runs(words.points, words.kinds > 0), start=1):
                        total[kind] += np.bincount(entries, minlength=1 << BITS)
                    total[0, :N_SCRIPTS] += np.bincount(words.kinds, minlength=N_SCRIPTS + 1)[1:]
        for lang, total in totals.items():
            kinds, entries = np.nonzero(total)
            columns = [pa.array([lang] * len(kinds), pa.string()), pa.array(kinds.astype(np.int32)), pa.array(entries.astype(np.int32)), pa.array(total[kinds, entries])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "kind", "entry", "n"])

    counted = labelled.select("lang", "text").mapInArrow(run, "lang string, kind int, entry int, n long")
    return counted.groupBy("lang", "kind", "entry").agg(F.sum("n").alias("n"))


def train(docs: DataFrame) -> Model:
    """Model of all documents with an id outside part 2, a text and a language.

    What comes to the driver is the table of counts: its size goes with the number of languages, not of documents. A
    language whose texts have no letter is not learned; without labelled texts there is none.
    """
    labelled = docs.where((quarter(F.col("doc_id")) != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = stage(count_runs(labelled), "runs-of-letters")
    table = counts.toArrow()
    langs = np.array(table.column("lang").to_pylist(), dtype=object)
    languages, lang = np.unique(langs, return_inverse=True) if len(langs) else ([], langs.astype(np.int64))
    kind, entry, n = [table.column(c).to_numpy() for c in ("kind", "entry", "n")]
    shares = []
    for length in range(1, len(LENGTHS) + 1):
        held = np.zeros((1 << BITS, len(languages)))
        some = kind == length
        held[entry[some], lang[some]] = n[some]
        held += SMOOTHING
        shares.append(np.log(held / held.sum(axis=0)).astype(np.float32))
    letters = np.zeros((N_SCRIPTS, len(languages)))
    some = kind == 0
    letters[entry[some], lang[some]] = n[some]
    scripts = letters > SCRIPT_SHARE * letters.sum(axis=0)
    return Model(list(languages), shares, scripts)


# Labels ---------------------------------------------------------------------------------


def word_scores(model: Model, words: _Words) -> np.ndarray:
    """Word x language: mean logarithm of the shares over the lengths of runs, added up over the word.

    Languages that do not use the script of most of the word's letters are out of reach; where none uses it, all score 0.
    """
    n, k = len(words.starts), len(model.languages)
    scores, script = np.zeros((n, k)), np.zeros(n, dtype=np.int64)
    first = 0
    while first < n:  # so many words that their runs' scores fit the bound
        last = max(first + 1, int(np.searchsorted(words.ends, words.starts[first] + LOOKED_UP // max(k, 1), side="right")))
        low, high = words.starts[first], words.ends[last - 1]
        cut = slice(max(low - 2, 0), high + 1)
        points, kinds = words.points[cut], words.kinds[cut]
        owner = np.zeros(len(points), dtype=np.int64)
        owner[words.starts[first:last] - cut.start] = 1
        owner = np.cumsum(owner) - 1  # -1 before the first word
        for (ends, entries), shares in zip(_runs(points, kinds > 0), model.shares, strict=True):
            # The place after the last word is a letter where a long run goes on: it is the next word's.
            inside = (owner[ends] >= 0) & ((ends < high - cut.start) | (kinds[-1] == 0))
            entries, begins = entries[inside], np.flatnonzero(np.diff(owner[ends[inside]], prepend=-1))
            scores[first:last] += np.add.reduceat(shares[entries], begins, axis=0, dtype=np.float64)
        letters = (kinds > 0) & (owner >= 0) & (np.arange(cut.start, cut.stop) < high)
        held = np.bincount(owner[letters] * N_SCRIPTS + kinds[letters] - 1, minlength=(last - first) * N_SCRIPTS)
        script[first:last] = held.reshape(-1, N_SCRIPTS).argmax(axis=1)
        first = last
    candidates = model.scripts[script]
    scores = np.where(candidates, scores / len(LENGTHS), OUT_OF_REACH)
    scores[~candidates.any(axis=1)] = 0
    return scores


def settled(scores: np.ndarray, text: np.ndarray, n_texts: int, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """Best single language of each text, and whether no change of language can pay, so that Viterbi need not be run.

    That is so if no stretch of words gains a penalty, taking each word in its best other language: a stretch with other
    labels costs a change at least, unless it is the whole text in one language, which is no better than the best.
    """
    k = scores.shape[1]
    totals = np.stack([np.bincount(text, weights=scores[:, i], minlength=n_texts) for i in range(k)], axis=1)
    best = totals.argmax(axis=1)
    if not len(scores) or k == 1:
        return best, np.ones(n_texts, dtype=bool)
    own = best[text][:, None]
    ours = np.take_along_axis(scores, own, axis=1)[:, 0]
    others = scores.copy()
    np.put_along_axis(others, own, -np.inf, axis=1)
    gain = np.clip(others.max(axis=1) - ours, -4 * penalty, 2 * penalty)  # from below: only makes stretches better
    sums = np.cumsum(gain)
    apart = 4 * penalty * (len(scores) + 1) * text  # sinks with every text, so that a minimum stays within one
    lowest = np.minimum.accumulate(sums - gain - apart) + apart
    firsts = np.flatnonzero(np.diff(text, prepend=-1))
    fine = np.ones(n_texts, dtype=bool)
    fine[text[firsts]] = np.maximum.reduceat(sums - lowest, firsts) < 0.9 * penalty
    return best, fine


def viterbi(scores: np.ndarray, sizes: np.ndarray, penalty: float) -> np.ndarray:
    """Language of every word: the labels of each text with the largest sum of scores less ``penalty`` for each change.

    ``sizes``: words of each text, whose scores lie one after the other. All texts go forward together, a word at a
    time. Staying goes before changing, and the first language before others, where sums are equal.
    """
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    sizes = sizes[order]
    longest = int(sizes[0]) if len(sizes) else 0
    came = np.zeros(scores.shape, dtype=np.int16)
    own = np.arange(scores.shape[1], dtype=np.int16)
    best = np.zeros((0, scores.shape[1]))
    counts = np.searchsorted(-sizes, -np.arange(longest), side="left") if longest else []
    sums = scores[starts[sizes > 0]] if longest else best
    for i in range(1, longest):
        k = counts[i]
        top = sums[:k].argmax(axis=1)
        most = sums[np.arange(k), top] - penalty
        stay = sums[:k] >= most[:, None]
        came[starts[:k] + i] = np.where(stay, own, top[:, None])
        sums[:k] = np.maximum(sums[:k], most[:, None]) + scores[starts[:k] + i]
    label = np.zeros(len(scores), dtype=np.int64)
    if longest:
        state = sums.argmax(axis=1)
        for i in range(longest - 1, -1, -1):
            k = counts[i]
            at = starts[:k] + i
            label[at] = state[:k]
            state[:k] = came[at, state[:k]]
    return label


def _labelled(model: Model, texts: list[str]) -> tuple[_Words, np.ndarray]:
    words = _words(texts)
    scores = word_scores(model, words)
    best, fine = settled(scores, words.text, len(texts), PENALTY)
    label, rest = best[words.text], ~fine[words.text]
    sizes = np.bincount(words.text[rest], minlength=len(texts))
    label[rest] = viterbi(scores[rest], sizes, PENALTY)
    return words, label


def _languages(model: Model, texts: list[str]) -> tuple[list[str], list[float]]:
    """Language and share of the letters in spans of it, of each text."""
    if not model.languages:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    words, label = _labelled(model, texts)
    n = len(model.languages)
    letters = np.bincount(words.text * n + label, weights=words.ends - words.starts, minlength=len(texts) * n).reshape(-1, n)
    most, total = letters.argmax(axis=1), letters.sum(axis=1)
    share = letters.max(axis=1) / np.maximum(total, 1)
    return [model.languages[i] if any_ else UNKNOWN for i, any_ in zip(most, total > 0, strict=True)], share.tolist()


def _spans(model: Model, texts: list[str]) -> list[list[dict]]:
    """Spans of each text: first and last-but-one word, and language."""
    out: list[list[dict]] = [[] for _ in texts]
    if not model.languages:
        return out
    words, label = _labelled(model, texts)
    new = np.flatnonzero((np.diff(label, prepend=-1) != 0) | (np.diff(words.text, prepend=-1) != 0))
    first = np.searchsorted(words.text, words.text)  # number of the first word of the same text
    for begin, end in zip(new, np.append(new[1:], len(label)), strict=True):
        out[words.text[begin]].append({"from": int(begin - first[begin]), "to": int(end - first[begin]), "lang": model.languages[label[begin]]})
    return out


def _map_texts(docs: DataFrame, text_col: str, schema: T.StructType, made) -> DataFrame:
    """``docs`` with columns made of the texts, some texts at a time. NULL is an empty text."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x or "" for x in batch.column(at).to_pylist()]
            for first, last in _parts(np.array([len(x) for x in texts])):
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([*part.columns, *made(texts[first:last])], schema.names)

    return docs.mapInArrow(run, schema)


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the share of the text's letters that lie in spans of the language.

    ``und`` with score 0 where the text is NULL or has no letter, and where no language was learned. Equal numbers of
    letters: the first language by name. Only the text tells: other columns are passed through, those named
    ``lang_pred`` and ``score`` replaced. A whole text is looked at, however long.
    """
    rest = docs.select(*[c for c in docs.columns if c.lower() not in ("lang_pred", "score")])
    schema = T.StructType([*rest.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def made(texts: list[str]) -> list[pa.Array]:
        langs, shares = _languages(model, texts)
        return [pa.array(langs, pa.string()), pa.array(shares, pa.float64())]

    return _map_texts(rest, text_col, schema, made)


def spans(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``spans``: neighbouring words of one language, as ``from`` and ``to`` (not included) in numbers of words.

    Words are runs of letters. A text without one has no span, nor has any where no language was learned.
    """
    rest = docs.select(*[c for c in docs.columns if c.lower() != "spans"])
    kind = T.ArrayType(T.StructType().add("from", T.IntegerType()).add("to", T.IntegerType()).add("lang", T.StringType()))
    schema = T.StructType([*rest.schema.fields, T.StructField("spans", kind)])
    arrow = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32()), ("lang", pa.string())]))
    return _map_texts(rest, text_col, schema, lambda texts: [pa.array(_spans(model, texts), arrow)])
