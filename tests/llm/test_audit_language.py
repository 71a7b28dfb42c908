"""The audit of filters and the languages of texts against plain versions, over rows with every difficulty, and over none."""

import random
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from material import docs, frame, none  # noqa: F401
from pyspark.sql import functions as F

from skytally.llm import filter_audit, language_id, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")

# Filters -----------------------------------------------------------------------------


def fails(text):
    words = WORD.findall(text)
    out = "A" * (len(words) < 50) + "B" * (100 * len(set(words)) < 65 * len(words))
    out += "C" * (100 * len(re.findall("[A-Z]", text)) > 5 * len(text))
    return out + "D" * bool(re.search(r"[#$%&*|]", text))


def audited(rows, good, toxic):
    """rows: id, text, source. A row per part, order and step, document by document."""
    kinds = []
    for doc_id, text, part in rows:
        text = text or ""
        copy = doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, _ in rows)
        kinds.append((part or "", fails(text) + "E" * copy, doc_id in good, doc_id in toxic))
    out = {}
    for part in {k[0] for k in kinds}:
        own = [k for k in kinds if k[0] == part]
        removed_by = Counter()
        for order in permutations("ABCDE"):
            left = list(own)
            for step, name in enumerate(order, start=1):
                gone = [k for k in left if name in k[1]]
                left = [k for k in left if name not in k[1]]
                removed_by[name] += len(gone)
                redundant = sum(name in k[1] for k in own) - len(gone)
                only = sum(k[1] == name for k in own)
                out[part, "".join(order), step] = [len(left), len(gone), redundant, only, sum(k[2] for k in gone), sum(k[3] for k in gone)]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(removed_by[order[step - 1]])
    return sorted((*k, *v) for k, v in out.items())


def test_audit(spark, docs):
    pick = random.Random(2)
    shout = " ".join(f"W{i}X{i}" for i in range(60))
    rows = [(i, t, pick.choice(["s", "t", "", None])) for i, t in docs]
    rows += [(900 + i, shout + x, "s") for i, x in enumerate(["", "#", "#", "", " a a a " * 40])] + [(None, shout, "s"), (901, shout + "#", "s")]
    labels = [(i, pick.choice([0, 1, None]), pick.choice([0, 1, None])) for i, _, _ in rows if pick.random() < 0.5] + [(900, 1, 0), (900, 0, 1), (None, 1, 1)]
    frame = spark.createDataFrame([(r[1], r[0], r[2], 3, "x") for r in rows], "text string, doc_id long, source string, mask int, part string").repartition(4)
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = filter_audit.audit_documents(frame, labelled)
    assert found.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    marked = [{i for i, *v in labels if i is not None and v[k] == 1} for k in range(2)]
    got = sorted(tuple(r) for r in found.collect())
    assert got == audited(rows, *marked)
    assert len(got) == 3 * 600 and all(any(r[k] for r in got) for k in range(3, 10))
    assert found.where("false").union(filter_audit.audit_documents(frame.where("false"), labelled)).count() == 0


def test_fields_do_not_overflow():
    """Counts beyond those of any table stay in their fields."""
    many = 1 << 55
    kinds = [(mask, bool(mask & 1), bool(mask & 2)) for mask in range(8)]
    total = sum(many * filter_audit.packed("XYZ", *kind) for kind in kinds)
    outcomes, removals = filter_audit.unpacked("XYZ", total)
    once = [filter_audit.unpacked("XYZ", filter_audit.packed("XYZ", *kind)) for kind in kinds]
    assert (outcomes == many * sum(o for o, _ in once)).all() and (removals == many * sum(r for _, r in once)).all()
    assert removals.max() < 1 << 62


# Languages ---------------------------------------------------------------------------


def path_by_hand(scores, penalty):
    """Largest sum over all labels of the words, tried one by one."""
    best = [(x, (i,)) for i, x in enumerate(scores[0])]
    for row in scores[1:]:
        best = [max((s - penalty * (p[-1] != i) + x, (*p, i)) for s, p in best) for i, x in enumerate(row)]
    return max(best)


def value_of(labels, scores, penalty):
    return sum(scores[i][x] for i, x in enumerate(labels)) - penalty * (np.diff(labels) != 0).sum()


def test_viterbi_and_settled_texts():
    random_ = np.random.default_rng(4)
    sizes = np.array([0, 1, 7, 3, 0, 12, 1, 40, 25])
    text = np.repeat(np.arange(len(sizes)), sizes)
    seen = Counter()
    for spread in (0.5, 2.0, 8.0):
        scores = random_.normal(scale=spread, size=(sizes.sum(), 3)) + np.array([0, 1, 2]) * (text % 4 == 3)[:, None]
        labels = language_id.viterbi(scores, sizes, 3.0)
        best, fine = language_id.settled(scores, text, len(sizes), 3.0)
        for i in np.flatnonzero(sizes):
            own = scores[text == i]
            most = path_by_hand(own, 3.0)[0]
            assert value_of(labels[text == i], own, 3.0) == pytest.approx(most)
            seen[bool(fine[i])] += 1
            if fine[i]:
                assert value_of(np.full(sizes[i], best[i]), own, 3.0) == pytest.approx(most)
    assert seen[True] > 3 and seen[False] > 3


@pytest.fixture(scope="module")
def model(spark):
    latin = ["the thing and the other thing shall be", "und der andere das eine nicht zu sein"]
    rows = [(i, latin[i % 2] + f" {i}", ["en", "de"][i % 2]) for i in range(40)]
    rows += [(100 + i, "это другой язык и его слова", "ru") for i in range(20)]
    rows += [(200, None, "en"), (201, "the", None), (None, "xxxx yyyy", "zz"), (202, "123 ...", "digits")]
    held = [(i, "qqqq", "hidden") for i in range(5000) if zlib.crc32(str(i).encode()) % 4 == 2][:30]
    return language_id.train(spark.createDataFrame(rows + held, "doc_id long, text string, lang string"))


def test_training(model):
    """What is held out or has no id is not learned; a language without letters has no row."""
    assert model.languages == ["de", "en", "ru"]
    latin, cyrillic = [list(language_id.SCRIPTS).index(x) for x in ("Latin", "Cyrillic")]
    assert model.scripts[latin].tolist() == [True, True, False] and model.scripts[cyrillic].tolist() == [False, False, True]
    assert all(np.exp(x).sum(axis=0) == pytest.approx(1, abs=1e-3) for x in model.shares)


def test_prediction(spark, model):
    mixed = "the thing and the other thing shall be " * 3 + "это другой язык и его слова " * 9
    rows = [(1, "The other THING", 5), (2, None, 5), (3, "", 5), (4, "12 - ...", 5), (5, "nicht zu sein", 5), (6, mixed, 5)]
    rows += [(7, "слова", 5), (8, "日本語", 5), (9, "the other thing and " * 40_000, 5), (10, "x" * 300_000, 5), (6, mixed, 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score int").repartition(2)
    found = {r["doc_id"]: r for r in language_id.predict(frame, model).collect()}
    assert {i: r["lang_pred"] for i, r in found.items() if i != 10} == {1: "en", 2: "und", 3: "und", 4: "und", 5: "de", 6: "ru", 7: "ru", 8: "de", 9: "en"}
    assert found[1]["score"] == 1 and found[2]["score"] == 0 == found[4]["score"]
    letters = [len(re.findall(r"\w", x)) for x in ("the thing and the other thing shall be " * 3, "это другой язык и его слова " * 9)]
    assert found[6]["score"] == pytest.approx(letters[1] / sum(letters))
    cut = language_id.spans(frame.where("doc_id in (2, 6)"), model)
    assert cut.columns == [*frame.columns, "spans"]
    got = {r["doc_id"]: [tuple(x) for x in r["spans"]] for r in cut.collect()}
    assert got == {2: [], 6: [(0, 24, "en"), (24, 78, "ru")]}


def test_nothing_learned(spark, frame, none):
    empty = language_id.train(none)
    assert empty.languages == []
    found = language_id.predict(frame, empty)
    assert {(r["lang_pred"], r["score"]) for r in found.collect()} == {("und", 0.0)}
    assert found.count() == frame.count() and language_id.predict(none, empty).count() == 0


def test_slices_do_not_matter(model, monkeypatch):
    """Scores of words do not depend on what is worked on together."""
    texts = ["the thing, und der andere", "", "q" * 500 + " das", "a", "слова the"] * 3
    whole = language_id._words(texts)
    scores = language_id.word_scores(model, whole)
    for size in (3, 30, 300):
        monkeypatch.setattr(language_id, "LOOKED_UP", size)
        assert language_id.word_scores(model, whole) == pytest.approx(scores)
    alone = [language_id.word_scores(model, language_id._words([x])) for x in texts if x]
    assert np.concatenate(alone) == pytest.approx(scores)
    runs = [len(places) for places, _ in language_id._runs(whole.points, whole.kinds > 0)]
    letters, words = int((whole.kinds > 0).sum()), 3 * (5 + 2 + 1 + 2)
    assert runs == [letters, letters + words, letters]


def test_query_on_held_out_documents(spark, sf_dir):
    found = queries.op12_language_id(spark, sf_dir)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    langs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = found.join(langs, "doc_id").collect()
    assert len(rows) == langs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    unseen = [r["lang"] == r["lang_pred"] for r in rows if r["held_out"]]
    assert len(unseen) > 30 and np.mean(unseen) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
