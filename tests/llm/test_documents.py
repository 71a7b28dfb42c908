"""Operators on documents against plain versions, over rows with every difficulty, and over none."""

import random
from collections import Counter

import brute
import numpy as np
import pytest
from material import docs, frame, none  # noqa: F401
from pyspark.sql import functions as F

from skytally.llm import debruijn, line_dedup, minhash, passages, quality, sharding, suffix_dedup, words
from skytally.llm.quality import BASE


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("hot", [1000, 4])
def test_lines(frame, docs, monkeypatch, hot):
    monkeypatch.setattr(line_dedup, "HOT_DOCS", hot)
    found = line_dedup.dedup_lines(frame)
    assert found.columns == [*frame.columns, "n_lines", "n_dropped"]
    got = ordered(found.select("doc_id", "n_lines", "n_dropped", "text").collect())
    assert got == ordered(brute.lines(docs))
    assert sum(r[2] for r in got) > 10 and {r.edge for r in found.collect()} == {"e"}


def test_minimal_perfect_hash():
    values = np.unique(np.random.default_rng(1).integers(0, 1 << 62, 5000, dtype=np.uint64))
    sizes, bits = line_dedup.build_hash(values)
    assert sorted(line_dedup.slots(values, sizes, bits)) == list(range(len(values)))
    assert line_dedup.build_hash(values[:0]) == ([], pytest.approx(np.zeros(0)))


@pytest.mark.parametrize("operator", [suffix_dedup, debruijn])
def test_passages(frame, docs, operator):
    found = operator.dedup_passages(frame)
    assert found.columns == [*[c for c in frame.columns if c != "n_words"], "n_words", "n_removed"]
    words = F.regexp_replace(F.btrim("text", F.lit(quality.SPACE)), quality.SPACES, " ")
    got = ordered(found.select("doc_id", "n_words", "n_removed", words).collect())
    assert got == ordered(brute.passages(docs))
    assert sum(r[2] > 0 for r in got) > 15


@pytest.mark.parametrize("held, meet, near", [(50_000, 64, 6), (3, 1, 1), (10_000, 2, 2)])
def test_passages_by_suffixes_whatever_meets(frame, docs, monkeypatch, held, meet, near):
    """What tasks remember, and which suffixes meet, changes how a passage is found, not whether."""
    for name, value in (("HELD", held), ("MEET", meet), ("NEAR", near), ("NEAR_SORTED", near)):
        monkeypatch.setattr(suffix_dedup, name, value)
    got = ordered(suffix_dedup.dedup_passages(frame).select("doc_id", "n_words", "n_removed").collect())
    assert got == ordered(r[:3] for r in brute.passages(docs))


def test_windows_with_other_holders_than_the_neighbours(spark):
    """Matches that go far to one side only: the smallest holder of a window is not that of the longest match."""
    pick = random.Random(6)
    base = [f"w{i}" for i in range(400)]
    own = lambda n: ["".join(pick.choice("xyz") for _ in range(12)) for _ in range(n)]
    docs = [(i, " ".join(own(pick.randrange(5)) + base[a : a + pick.randrange(50, 120)] + own(pick.randrange(5)))) for i, a in enumerate(pick.sample(range(300), 120))]
    pick.shuffle(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    for _ in range(2):
        got = ordered(suffix_dedup.dedup_passages(frame).select("doc_id", "n_words", "n_removed", "text").collect())
        assert got == ordered(brute.passages(docs))
        frame = frame.coalesce(1)
    assert sum(0 < r[2] < r[1] for r in got) > 50


def test_neighbours_take_most_of_a_common_passage(spark):
    """A passage that all documents hold leaves each task once, and little is left to the comparison of windows."""
    passage = " ".join(f"p{i}" for i in range(300))
    frame = spark.createDataFrame([(i, f"a{i} b{i} {passage} c{i}") for i in range(400)], "doc_id long, text string").repartition(4)
    known = passages.with_hashes(frame, "doc_id", "text").withColumnRenamed("text", "__text")
    found = suffix_dedup.suffixes(passages.candidates(known, passages.text_classes(known)))
    tasks = found.rdd.getNumPartitions()
    windows = 251 * 400
    left = sum(len(r.edges) // 8 for r in found.where("key IS NOT NULL").collect())
    # Of each task those of documents that come before all smaller ones: about the logarithm of their number.
    assert left < windows * 0.25 and tasks >= 1
    rest = suffix_dedup.neighbours(found).where("edge IS NOT NULL").count()
    assert 251 <= rest < left


@pytest.mark.parametrize("operator", [suffix_dedup, debruijn])
def test_untouched_texts_keep_their_white_space(spark, operator):
    frame = spark.createDataFrame([(1, "a  b\n\tc "), (2, None)], "doc_id long, text string")
    assert ordered(operator.dedup_passages(frame).collect()) == [(1, "a  b\n\tc ", 3, 0), (2, "", 0, 0)]


@pytest.mark.parametrize("block", [256, 3])
def test_near_duplicates(frame, docs, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "STAR", block)
    found = minhash.near_duplicates(frame)
    got = ordered(found.select("doc_id", "n_shingles", "component_id", "kept").collect())
    assert got == ordered(brute.near(docs))
    assert Counter(r[2] for r in got).most_common(1)[0][1] > 10


def test_bands_follow_the_similarity():
    assert minhash.plan(85) == 24
    for percent in (50, 80, 85, 95, 100):
        assert (1 - (percent / 100) ** minhash.ROWS) ** minhash.plan(percent) <= minhash.MISS


def test_one_document_of_a_group_stays(frame, docs):
    left = minhash.keep_first(frame)
    assert left.columns == frame.columns
    kept = [d for d, *_, keep in brute.near(docs) if keep]
    assert sorted(map(brute.order, (r.doc_id for r in left.collect()))) == sorted(map(brute.order, kept))


def test_permutations_are_circular_shifts():
    """Coordinates estimate the similarity, and a coordinate is that of another set shifted by one."""
    pick = np.random.default_rng(2)
    a = pick.integers(0, 1 << 63, 400, dtype=np.uint64)
    b = np.concatenate([a[:300], pick.integers(0, 1 << 63, 100, dtype=np.uint64)])
    same = (minhash.signature(a, 2000) == minhash.signature(b, 2000)).mean()
    assert abs(same - 300 / 500) < 0.06


def test_quality_statistics(frame, docs):
    judged = quality.judge(frame)
    got = ordered(judged.select("doc_id", *BASE, "base_failed").collect())
    assert got == ordered((i, *brute.statistics(t)) for i, t in docs)
    assert judged.where("base_failed AND kept").count() == 0 and judged.where("kept").count() > 40
    left = quality.keep_good(frame)
    assert left.columns == frame.columns and left.count() == judged.where("kept").count()


def test_outliers_go_and_clean_documents_stay(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/../sf0.01/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.judge(docs).join(labels, "doc_id").where("NOT base_failed")
    shares = {r.quality: r.k for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert shares[1] == 1.0 and shares[0] < 0.1


def test_languages_are_not_judged_by_each_other(spark):
    pick = random.Random(8)
    text = lambda least, most: " ".join("".join(pick.choice("abcdefgh") for _ in range(pick.randint(least, most))) for _ in range(50))
    rows = [(i, text(3, 9), "da", f"s{i % 3}") for i in range(60)]
    rows += [(100 + i, text(1, 2), "zh", "s0") for i in range(2)] + [(102, text(1, 2), None, "s0")]
    # A source of four rows, and one row of another kind, in a language of many.
    rows += [(200 + i, text(3, 9), "en", "big") for i in range(200)] + [(400 + i, text(3, 9), "en", "small") for i in range(4)]
    rows += [(404, text(1, 1), "en", "small"), (405, text(3, 9), "en", "single"), (406, text(1, 1), "en", "big")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality.judge(frame).collect()}
    assert {i for i, k in kept.items() if not k} == {404, 406}


def groups_of_vectors(spark, groups):
    rows = [(*map(float, v), g, i) for g, x in enumerate(groups) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, ", ".join(f"{p} double" for p in quality.PARTS) + ", g int, spread long")
    cell = F.struct(F.col("g").cast("string").alias("l"), F.lit("b").alias("s"))
    return table.withColumn("cell", cell).repartition(5)


def test_estimates_are_those_of_least_determinant(spark):
    """Every start is followed to its end, and the least determinant stands: as by numpy, for groups of many shapes."""
    pick = np.random.default_rng(3)
    groups = [pick.normal(0, 0.2, (n, 4)) @ pick.normal(0, 1, (4, 4)) for n in (400, 60, 5, 1, 2000)]
    groups[0][:80] += 5
    groups[4][:500] = 1 + 0.01 * groups[4][:500]  # a dense group that some starts take for the whole
    groups += [np.zeros((30, 4)), np.vstack([np.zeros((50, 4)), [[0, 0, 0, 0.29]]])]
    table = groups_of_vectors(spark, groups)
    ends = {(int(r.cell.l), r.start): r for r in quality.concentrated(table, 3).collect()}
    found = {(r.g, r.spread): r.d2 for r in quality.robust_outliers(table).collect()}
    for g, x in enumerate(groups):
        centre, cov, _, wanted = brute.least_determinant(x, quality)
        for least, number, _, _, steps in wanted:
            assert ends[g, number]["log_det"] == pytest.approx(least, rel=1e-6) and ends[g, number]["steps"] == steps
        floor = np.diag(np.array(list(quality.PARTS.values())) ** 2)
        d2 = brute.distances(x, centre, cov + floor)
        assert [found[g, i] for i in range(len(x))] == pytest.approx(d2.tolist(), rel=1e-5, abs=1e-9)
    assert not any(r.open for r in ends.values()) and max(r.steps for r in ends.values()) > 3
    assert len({round(ends[4, s]["log_det"], 6) for s in range(3)}) > 1  # starts end apart, so more than one is needed
    assert all(found[0, i] > quality.CUT for i in range(80))


def test_each_part_can_reject_alone(spark):
    far = {"length": 0.4, "symbols": 0.3, "lines": 0.6, "repeats": 0.29}
    quiet = np.random.default_rng(5).normal(0, 0.01, (3000, 4)) * [1, 0, 0, 0]
    for place, part in enumerate(quality.PARTS):
        odd = np.zeros((1, 4))
        odd[0, place] = far[part]
        d2 = {r.spread: r.d2 for r in quality.robust_outliers(groups_of_vectors(spark, [np.vstack([quiet, odd])])).collect()}
        assert d2[3000] > quality.CUT and max(d2[i] for i in range(3000)) < quality.CUT


@pytest.mark.parametrize("partitions", ["3"])
def test_verdicts_are_those_of_a_plain_version(spark, sf_dir, partitions):
    docs = spark.read.parquet(f"{sf_dir}/../sf0.01/documents.parquet")
    wanted = brute.verdicts([tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()], quality)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        judged = quality.judge(docs.repartition(int(partitions))).where("NOT base_failed").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(judged) == len(wanted) > 800
    assert [wanted[r.doc_id][0] for r in judged] == pytest.approx([r.d2 for r in judged], rel=1e-4, abs=1e-6)
    assert {r.doc_id for r in judged if not r.kept} == {i for i, (_, kept) in wanted.items() if not kept}
    assert 3 < sum(not r.kept for r in judged) < 100


@pytest.mark.parametrize("n_shards", [1, 7, 40])
def test_shards(frame, docs, n_shards):
    found = sharding.shard_by_bytes(frame, "doc_id", sharding.text_size(F.col("text")), n_shards)
    rows = found.collect()
    assert len(rows) == len(docs) and found.columns == [*frame.columns, "size", "shard", "slot"]
    total = sum(r.size for r in rows)
    assert total == sum(len((t or "").encode()) + 16 for _, t in docs)
    place, at = 0, Counter()
    for r in sorted(rows, key=lambda r: (r.shard, r.slot)):
        assert r.slot == at[r.shard] and r.shard == (2 * place + r.size) * n_shards // (2 * total)
        at[r.shard] += 1
        place += r.size
    ids = [-(1 << 63) if r.doc_id is None else r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert ids == sorted(ids)


def test_empty_tables(none):
    assert line_dedup.dedup_lines(none).collect() == []
    assert suffix_dedup.dedup_passages(none).collect() == debruijn.dedup_passages(none).collect() == []
    assert minhash.near_duplicates(none).collect() == minhash.keep_first(none).collect() == []
    assert quality.judge(none).collect() == quality.keep_good(none).collect() == []
    assert sharding.shard_by_bytes(none, "doc_id", F.lit(1), 3).collect() == []


def test_rows_without_ids(spark):
    """No line is lost altogether, and one row of a group of near copies stays."""
    line, words = "a line that all of these rows hold", " ".join(f"w{i}" for i in range(300))
    frame = spark.createDataFrame([(None, f"{line}\nown text {i}") for i in range(4)], "doc_id long, text string")
    kept = [r.text.split("\n") for r in line_dedup.dedup_lines(frame).collect()]
    assert sum(line in x for x in kept) == 1 and all(any(y.startswith("own") for y in x) for x in kept)
    with_id = frame.unionByName(spark.createDataFrame([(-5, line)], frame.schema))
    found = {r.doc_id: r.text for r in line_dedup.dedup_lines(with_id).collect() if line in r.text}
    assert found == {-5: line}
    near = spark.createDataFrame([(None, f"{words} {i}") for i in range(5)] + [(None, "other text " * 30)], frame.schema)
    assert sorted(r.text[:5] for r in minhash.keep_first(near).collect()) == ["other", "w0 w1"]
    same = spark.createDataFrame([(None, words), (None, words), (7, words + " x"), (7, words + " y")], frame.schema)
    assert [r.doc_id for r in minhash.keep_first(same).collect()] == [7]


def test_copies_of_a_text_beside_rows_without_ids(spark):
    words = " ".join(f"w{i}" for i in range(80))
    frame = spark.createDataFrame([(i, words) for i in (5, 3, 9, 3)] + [(None, words), (None, words)], "doc_id long, text string")
    for operator in (suffix_dedup, debruijn):
        found = [(r.doc_id, r.n_removed) for r in operator.dedup_passages(frame).collect()]
        assert ordered(found) == ordered([(3, 0), (3, 0), (5, 80), (9, 80), (None, 80), (None, 80)])


def test_words_of_several_texts_are_numbered_together():
    """As one text at a time: equal words are equal, whatever is around them, and windows never lie in two texts."""
    rng = np.random.default_rng(5)
    some = ["a", "ab", "ba", "é", "\x1c", "　", "x" * 300_000, "x" * 299_999 + "y"]
    texts = [b"", b" \t\x0b ", b"a", b"\na  ab\x0cba\r"]
    texts += [" ".join(rng.choice(some[:6], n)).encode() for n in (49, 50, 51, 400)] + [" ".join(some * 3).encode()]
    numbers, starts = words.word_hashes(texts)
    every = [w for text in texts for w in text.split()]
    assert np.diff(starts).tolist() == [len(text.split()) for text in texts]
    assert len(set(zip(every, numbers.tolist(), strict=True))) == len(set(every)) == len(set(numbers.tolist()))
    place, anchor, prefixes, of = passages.anchors_of(numbers, starts)
    for i, text in enumerate(texts):
        alone, _ = words.word_hashes([text])
        expected, own = passages.anchors(alone)
        mine = of[place] == i
        assert (place[mine] - starts[i]).tolist() == list(range(len(expected)))
        assert (anchor[mine] - starts[i]).tolist() == expected.tolist()
        assert (prefixes[anchor[mine]] == own[expected]).all()
