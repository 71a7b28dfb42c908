"""Packing, sharding law, pieces, pages, embeddings and the whole pipeline against plain versions."""

import random
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from material import docs, frame, none  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from skytally.llm import components, embed_dedup, html_labels, html_text, packing, piece_lattice
from skytally.llm.queries import queries, tokenizer_file

BYTES, PIECES = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def strange(n, seed=3):
    pick = random.Random(seed)
    parts = [" ", "  ", "\n", "\t", "a", "th", "e", "'s", "日", "é", "😀", "x", "1", "ab", "-", "́", "   ", "\x1c", "\x85", "　", "<|endoftext|>"]
    return ["".join(pick.choice(parts) for _ in range(pick.randint(0, 60))) for _ in range(n)]


# Packing ---------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(BYTES)
    found.encode_special_tokens = True
    return found


def test_ids_are_those_of_the_library(tokenizer):
    encode = packing.encoder(packing.byte_ranks(BYTES))
    for text in [*strange(3000), *(t for _, t in brute_texts())]:
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_added_tokens_have_the_ids_of_the_unmodified_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    texts = ["<|endoftext|>", "a <|endoftext|> b", "<|endoftext|><|endoftext|>x", "<|endoftext|", *strange(300, 9)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.doc_tokens, r.ids_crc32) for r in packing.pack(frame, BYTES, window=4096).where("start = 0").collect()}
    for i, text in enumerate(texts):
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        assert got[i] == (len(ids), zlib.crc32(np.array(ids, dtype="<u4")))


def brute_texts():
    from material import made_up

    return [(i, t) for i, t in made_up() if t]


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        packing.byte_ranks(tokenizer_file("word_bpe_49k.json"))


@pytest.mark.parametrize("group", [1 << 20, 3000])
def test_packing(frame, docs, tokenizer, monkeypatch, group):
    monkeypatch.setattr(packing, "GROUP_TOKENS", group)
    window = 256
    rows = packing.pack(frame, BYTES, window=window).collect()
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    for members in sequences.values():
        members.sort(key=lambda r: r.offset)
        assert [r.offset for r in members] == [sum(m.length for m in members[:i]) for i in range(len(members))]
        assert sum(r.length for r in members) <= window
    lengths = sum(r.length for r in rows)
    assert len(sequences) * window < 1.1 * lengths + window * (1 + lengths // group)
    ids = {}
    for doc_id, text in docs:
        whole = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        ids.setdefault(doc_id, []).append(whole)
    for doc_id, wholes in ids.items():
        own = Counter((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows if r.doc_id == doc_id)
        # Each row of an id is cut without gaps; pieces of equal rows are equal.
        wanted = Counter()
        for whole in wholes:
            starts = sorted({s for s, _, _, n in own if n == len(whole)})
            for a, b in zip(starts, [*starts[1:], len(whole)]):
                wanted[a, b - a, zlib.crc32(whole[a:b].tobytes()), len(whole)] += 1
        assert own == wanted


def test_differencing():
    # Two windows: 8 7 6 5 4 by hand: 8-7=1, 6-5=1, 4-1=3, 3-1=2.
    windows = packing.differencing([8, 7, 6, 5, 4], 2)
    sums = [sum(s for s, w in zip([8, 7, 6, 5, 4], windows) if w == k) for k in (0, 1)]
    assert abs(sums[0] - sums[1]) == 2
    pick = random.Random(1)
    for _ in range(30):
        sizes = [pick.randint(1, 60) for _ in range(pick.randint(0, 60))]
        windows = packing.pack_group(sizes, 64)
        assert all(x <= 64 for x in np.bincount(windows, weights=sizes, minlength=1)) and len(windows) == len(sizes)


# Pieces ----------------------------------------------------------------------


def test_pieces_are_those_of_the_library(spark, frame, docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = [*strange(400, 4), "x" * 500, "abcde" * 100, " " * 70 + "a", "http://a.b/" + "q1w2" * 40]
    more = spark.createDataFrame(list(enumerate(texts, 10_000)), "doc_id long, text string")
    both = frame.select("doc_id", "text").union(more)
    back = piece_lattice.decode(piece_lattice.encode(both, PIECES), PIECES)
    got = ordered(back.select("doc_id", "ids", "text").collect())
    wanted = [(i, library.encode(t or ""), t or "") for i, t in [*docs, *enumerate(texts, 10_000)]]
    assert got == ordered(wanted)


def test_both_folds_agree(spark, monkeypatch):
    words = spark.createDataFrame([("▁" + w,) for w in {"therewith", "a", "ababab", "日本x", "x" * 20, "unlikely"}], "unit string")
    table, pieces = piece_lattice.piece_table(spark, PIECES)
    one = ordered(piece_lattice.encode_units(words, table, 16).collect())
    monkeypatch.setattr(piece_lattice, "LONGEST", 0)
    assert one == ordered(piece_lattice.encode_units(words, table, 16).collect())


def test_pieces_of_tasks_that_forget(spark, monkeypatch):
    import sentencepiece

    monkeypatch.setattr(piece_lattice, "REMEMBERED", 40)
    monkeypatch.setattr(piece_lattice, "SLICE", 3)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = [*strange(200, 9), *(" " * n + "a" for n in range(40)), "therewith unlikely " * 30, "日本語の文章です。" * 40, "", "▁▁a ▁b"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    encoded = piece_lattice.encode(table.union(table), PIECES)
    wanted = [(i, library.encode(t)) for i, t in enumerate(texts)]
    assert ordered(encoded.select("doc_id", "ids").collect()) == ordered(wanted * 2)


def test_pieces_shuffle_nothing(spark, frame):
    plan = piece_lattice.encode(frame, PIECES)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


# Pages -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def tree(spark):
    return html_text.fit(spark, html_labels.labelled())


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style></head><body class="has-sidebar">
<div id="cookie-notice"><p>We use cookies on this site for many good reasons of our own.</p></div>
<header><h1>The site</h1></header><nav><ul><li><a href="/">Home</a><li><a href="/n">News</a></ul></nav>
{article}
<aside><p>Something else that is long enough to look like text of an article.</p></aside>
<div class="comments"><article class="comment"><p>A reader's long comment on what was said above in the text.</p></article></div>
<form><p>Write to us with this form about whatever you like to say.</p><textarea>x</textarea></form>
<footer>&copy; The site</footer><script>var t = "</p><p>no</p>";</script></body></html>"""


@pytest.mark.parametrize(
    "article, text",
    [
        ("<article><h1>Head &amp; tail</h1><p>One <b>bold</b>\n\t word.<p>Two<br>lines &lt;b&gt; &eacute;&#233;&nbsp;x</article>",
         "Head & tail\nOne bold word.\nTwo lines <b> éé x"),
        ("<main><p>Short.</p><p class='lead'>With <span class='hl'>a mark</span> and <a href='/x'>a link</a>.</p></main>",
         "Short.\nWith a mark and a link."),
        ('<div class="post-content"><p>First</p><div class="ad">Buy this</div><p>Last</p></div>', "First\nLast"),
        ("<article><p>a < b and c > d</p><!-- <p>no</p> --><ul><li>x<li>y</ul></article>", "a < b and c > d\nx\ny"),
    ],
)
def test_main_text(tree, article, text):
    assert html_text.main_text(PAGE.format(article=article), tree) == text


@pytest.mark.parametrize(
    "article, text",
    [
        ("<article><header class='entry-header'><h1>Head of it</h1></header><p>One word and more.</p></article>", "Head of it\nOne word and more."),
        ("<article><header class='header'><h1>Head of it</h1></header><p>One word and more.</p></article>", "Head of it\nOne word and more."),
        ("<div class='post'><div class='article-header'><h1>Head</h1></div><p>One word and more.</p></div>", "Head\nOne word and more."),
        ("<div class='post category-search tag-social'><p>One word and more.</p></div>", "One word and more."),
        ("<article class='category-newsletter tag-ad'><p>One word and more.</p></article>", "One word and more."),
        ("<article><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding='application/x-tex'>x=2</annotation></math> holds.</p></article>", "So x=2 holds."),
        ("<article><p>One word and more.</p></article><ul class='category-menu'><li>This is a list of what else there is.</li></ul>", "One word and more."),
        ("<article><p>One word and more.</p><div class='entry-content search-form'><p>What are you looking for here?</p></div></article>", "One word and more."),
    ],
)
def test_headers_topics_and_formulas_of_articles_stay(tree, article, text):
    assert html_text.main_text(PAGE.format(article=article), tree) == text


WORD = "One word and more."


@pytest.mark.parametrize(
    "article, text",
    [
        ("<section id='related-work'><h2>Related work</h2><p>{w}</p></section>", "Related work\n{w}"),
        ("<section id='legal-status'><p>{w}</p></section>", "{w}"),
        ("<h2 id='discussion'>Discussion</h2><p>{w}</p>", "Discussion\n{w}"),
        ("<p class='social-history'>{w}</p>", "{w}"),
        ("<p>{w}</p><aside class='pullquote'>A quote of it all.</aside><p>{w}</p>", "{w}\nA quote of it all.\n{w}"),
        ("<p>The <span class='form'>infinitive</span> of it.</p>", "The infinitive of it."),
        ("<div class='legal-history'><p>{w}</p></div>", "{w}"),
        ("<p id='notice'>{w}</p>", "{w}"),
        ("<section class='discussion'><p>{w}</p></section>", "{w}"),
        ("<div id='search-for-meaning'><p>{w}</p></div>", "{w}"),
        ("<figure class='advertising-poster-1920'><figcaption>{w}</figcaption></figure>", "{w}"),
        ("<p>See the <b class='tags'>tags</b> and <em class='menu'>menu</em> of it.</p>", "See the tags and menu of it."),
        ("<ul class='form-of-government'><li>{w}</li></ul>", "{w}"),
    ],
)
@pytest.mark.parametrize("around", ["<article><p>Begin of it.</p>{x}</article>", "<main><h1>Begin of it.</h1>{x}</main>", "<div class='post-content'><p>Begin of it.</p>{x}</div>"])
def test_words_in_names_do_not_take_parts_of_articles(tree, around, article, text):
    page = PAGE.format(article=around.replace("{x}", article.replace("{w}", WORD)))
    assert html_text.main_text(page, tree) == "Begin of it.\n" + text.replace("{w}", WORD)


COMMENT = "I have read all of this and I do not agree with a single word of what the author says here."


@pytest.mark.parametrize(
    "inside, after",
    [
        ("<section id='comments'><p>{c}</p></section>", ""),
        ("<div class='comment-list'><p>{c}</p></div>", ""),
        ("<div id='disqus_thread'><p>{c}</p></div>", ""),
        ("<p class='ad'>{c}</p>", ""),
        ("<div class='related-posts'><p>{c}</p></div>", ""),
        ("<div class='share'>{c}</div>", ""),
        ("<div class='notice'><p>{c}</p></div>", ""),
        ("<ul class='social-links'><li>{c}</li></ul>", ""),
        ("<aside><p>{c}</p></aside>", ""),
        ("", "<div id='thread'><p>{c}</p><p>{c}</p></div>"),
        ("", "<div><div><p>{c}</p></div><div><p>{c}</p></div></div>"),
        ("", "<div class='notices'><p>{c}</p></div>"),
        ("", "<section class='discussion'><p>{c}</p></section>"),
    ],
)
@pytest.mark.parametrize("around", ["<article><p>Begin of it.</p>{x}</article>", "<div class='post'><p>Begin of it.</p>{x}</div>"])
def test_widgets_and_comments_still_go(tree, around, inside, after):
    page = PAGE.format(article=(around.replace("{x}", inside) + after).replace("{c}", COMMENT))
    assert html_text.main_text(page, tree) == "Begin of it."


def test_labelled_blocks_are_learnt_and_others_too(tree):
    known = [(x, y) for page, labels in html_labels.labelled() for x, y in zip(html_text.features(html_text.blocks(page)), labels)]
    assert all(html_text.decide(tree, x) == bool(y) for x, y in known)


def test_tree_weighs_neighbours(tree):
    """Words and link density of the blocks around decide where names of elements say nothing."""
    used, open_ = set(), [tree]
    while open_:
        node = open_.pop()
        if isinstance(node, tuple):
            used.add(html_text.FEATURES[node[0]])
            open_ += node[2:]
    assert {"words", "link_density", "words_after", "link_density_before", "link_density_after", "outside", "inside"} <= used
    assert len(html_labels.PAGES) >= 60
    links = " ".join(f"<a href='/{i}'>Link {i}</a>" for i in range(20))
    text = "A long enough sentence that says what this page without any named element is about."
    page = f"<div>{links}</div><div>Menu of the day</div><div>{text}</div><div>Then this.</div><div>{text} {text}</div><div>Ask us</div><div>{links}</div>"
    assert html_text.main_text(page, tree) == f"{text}\nThen this.\n{text} {text}"


@pytest.mark.parametrize("page", ["", "<", "<p", "<p>", "</p></div></nav>", "<script>x", "<!--", "&", "<a href='", "<p " + "x" * 10_000, "<div>" * 5000])
def test_broken_pages_give_a_text(tree, page):
    assert isinstance(html_text.main_text(page, tree), str)


def test_pages(spark, tree):
    long = "<article>" + "<p>many words in here</p>" * 20_000 + "</article>"
    rows = [(1, None, None, 5), (2, "u", "", 5), (2, "u", "", 5), (3, "u", long, None), (None, "u", "<article><p>é</p></article>", 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    got = html_text.extract(pages, tree).select("page_id", "text", "n_chars").collect()
    assert ordered(got) == ordered([(1, "", 0), (2, "", 0), (2, "", 0), (3, "\n".join(["many words in here"] * 20_000), 379_999), (None, "é", 1)])
    assert html_text.extract(pages.where("false"), tree).collect() == []


# Embeddings ------------------------------------------------------------------


@pytest.mark.parametrize("block", [1024, 5])
def test_links(spark, monkeypatch, block):
    monkeypatch.setattr(embed_dedup, "BLOCK", block)
    pick = np.random.default_rng(4)
    rows = [(i, pick.normal(size=16).tolist(), i % 3) for i in range(80)]
    centre = pick.normal(size=16)
    rows += [(100 + i, (centre + pick.normal(size=16) * 0.12).tolist(), 1) for i in range(40)]
    rows += [(200 + i, (centre * (1 + i % 2)).tolist(), 1 if i < 5 else None) for i in range(8)]
    rows += [(300, None, 1), (301, [0.0] * 16, 1), (302, [float("nan")] * 16, 1), (303, [None] * 16, 1), (304, [], 1)]
    rows += [(305, [float("inf")] + [1.0] * 15, 1), (306, centre[:8].tolist(), 1), (None, centre.tolist(), 1), (200, centre.tolist(), 1)]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, label int, n_links int")

    def link(i, j):
        (_, a, p), (_, b, q) = rows[i], rows[j]
        if p is None or p != q or not a or not b or len(a) != len(b) or None in a or None in b:
            return False
        a, b = np.array(a), np.array(b)
        if not (np.isfinite(a).all() and np.isfinite(b).all() and a.any() and b.any()):
            return False
        return a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98

    n = len(rows)
    links = [sum(link(i, j) for j in range(n) if j != i) for i in range(n)]
    root = brute.groups(n, link)
    ids = [brute.order(r[0]) for r in rows]
    least = [min(ids[j] for j in range(n) if root[j] == root[i]) for i in range(n)]
    real = lambda x: None if x == brute.order(None) else x
    wanted = [(real(ids[i]), links[i], real(least[i]), ids[i] == least[i]) for i in range(n)]
    assert max(links) > 10
    assert ordered(embed_dedup.link_vectors(frame).collect()) == ordered(wanted)
    assert embed_dedup.link_vectors(frame.where("false")).collect() == []


def test_plan_of_tables():
    for n in (10, 10_000, 10**10):
        bits, tables = embed_dedup.plan(n, 0.98)
        assert (1 - (1 - np.arccos(0.98) / np.pi) ** bits) ** tables <= embed_dedup.MISS


def test_components(spark):
    pick = random.Random(6)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(200)] + [(5000, 5000), (-3, 1005)]
    edges += [(pick.randint(2000, 2100), pick.randint(2000, 2100)) for _ in range(80)]
    pick.shuffle(edges)
    found = components.components(spark.createDataFrame(edges, "a long, b long"))
    nodes = sorted({x for e in edges for x in e})
    root = {x: x for x in nodes}
    for _ in nodes:
        before = dict(root)
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
        if before == root:
            break
    assert {r.node: r.component for r in found.collect()} == root
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


# Queries and the pipeline ----------------------------------------------------


def test_every_operator_has_its_query():
    assert sorted(int(name[2:].split("_")[0]) for name in queries()) == list(range(1, 11))


def test_pipeline(spark, frame, none, docs, tmp_path):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    source = frame.withColumn("n_chars", F.length("text").cast("long")).select(*columns)
    source.write.parquet(f"{tmp_path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "line dedup", "near dedup", "suffix-array dedup", "packing"]

    def texts(table):
        assert table.columns == columns
        rows = table.collect()
        assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)
        return [(r.doc_id, r.text) for r in rows]

    good = stages["quality rules"](spark, source, "")
    left = texts(good)
    assert 0 < len(left) < len(docs)
    lines = stages["line dedup"](spark, good, "")
    left = [(i, t) for i, _, _, t in brute.lines(left)]
    assert ordered(texts(lines)) == ordered(left)
    single = stages["near dedup"](spark, lines, "")
    left = [d for d, (*_, kept) in zip(left, brute.near(left, 80), strict=True) if kept]
    assert ordered(texts(single)) == ordered(left)
    unique = stages["suffix-array dedup"](spark, single, "")
    after = [(i, [w.decode() for w in brute.words(t)]) for i, t in texts(unique)]
    assert ordered(after) == ordered((i, t.split()) for i, _, _, t in brute.passages(left))
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert packed.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert {r.doc_id for r in packed.collect()} == {i for i, _ in left}
    for function in stages.values():
        assert function(spark, none.withColumn("n_chars", F.lit(1).cast("long")).select(*columns), "").collect() == []


@pytest.mark.parametrize("kind, labels", [("string", ["a", "b", ""]), ("double", [1.2, 1.7, -3.0]), ("boolean", [True, False, True])])
def test_labels_of_any_type(spark, kind, labels):
    """Labels are compared as they are, and only equal ones link."""
    rows = [(i, [1.0, 0.01 * i, 2.0], label) for i, label in enumerate(labels * 2)] + [(9, [1.0, 0.0, 2.0], None)]
    found = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.link_vectors(spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {kind}")).collect()}
    alike = {i: [j for j, _, label in rows if j != i and label == own and own is not None] for i, _, own in rows}
    assert found == {i: (len(js), min([i, *js])) for i, js in alike.items()}


def test_vectors_of_any_scale(spark):
    """Squares of components beyond the range of doubles do not part or link vectors."""
    base = np.array([3.0, -1.0, 2.0, 0.5])
    rows = [(i, [float(x) for x in base * scale], 1) for i, scale in enumerate([1e200, 1.0, 1e-200, 7e300, 1e-310])]
    rows += [(10, [1e200, 1e200, -1e200, 0.0], 1), (11, [float(x) for x in -base], 1)]
    found = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert found == {**{i: (4, 0) for i in range(5)}, 10: (0, 10), 11: (0, 11)}
