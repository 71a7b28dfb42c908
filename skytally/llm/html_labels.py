"""The labelled table for :mod:`skytally.llm.html_text`: short pages in pieces, each with the label of its blocks.

1: part of the article, 0: not. Written by hand for this purpose: 26 pages one by one, 42 in seven layouts.
"""

from __future__ import annotations

LONG = "The river had risen through the night and by the morning the lower fields were under water as far as the old mill."
MORE = "Nobody in the village could remember a spring like it, and the oldest of them had seen more than eighty."
NOTE = "We measured the level twice a day for three weeks, always at the same post."
MENU = '<ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/about">About us</a></li></ul>'

Piece = tuple[str, list[int]]

PAGES: list[list[Piece]] = [
    [
        ("<html><head><title>Flood</title></head><body><nav>" + MENU + "</nav>", [0, 0, 0]),
        ('<div class="ad">Boots for every weather.</div>', [0]),
        (f"<article><h1>The flood</h1><p>{LONG}</p><p>So.</p><p>{MORE}</p></article>", [1, 1, 1, 1]),
        ("<footer>&copy; 2020 The Paper</footer></body></html>", [0]),
    ],
    [
        (f"<header><h1>The Paper</h1><p>All that is new</p></header><nav>{MENU}</nav>", [0, 0, 0, 0, 0]),
        (f"<main><h2>After the flood</h2><p>{MORE}</p><p>{NOTE}</p><p>It fell.</p>", [1, 1, 1, 1]),
        (f'<aside><h3>Read on</h3><p>{LONG}</p></aside></main>', [0, 0]),
        (f'<div class="sidebar"><p>{NOTE}</p><a href="/x">More of this</a></div>', [0, 0]),
        ("<p>Printed in town.</p>", [0]),
    ],
    [
        (f'<div id="cookie-notice"><p>{NOTE}</p><button>Accept</button></div>', [0, 0]),
        ('<div class="promo"><p>Subscribe now and save.</p></div>', [0]),
        (f'<div class="post-content"><p>{LONG}</p><ul><li>One post</li><li>Two posts</li></ul><p>{MORE}</p></div>', [1, 1, 1, 1]),
        (f'<div class="comments"><p>{NOTE}</p><p>Thanks!</p></div>', [0, 0]),
        ('<form><label>Mail</label><input name="m"><p>We never pass it on to anybody else.</p></form>', [0, 0]),
    ],
    [
        (MENU, [0, 0, 0]),
        (f"<h1>A spring of water</h1><p>{LONG}</p><p>{MORE}</p><p>{NOTE}</p>", [1, 1, 1, 1]),
        ('<p><a href="/1">Yesterday</a></p><p><a href="/2">The day before</a></p><p>Imprint</p>', [0, 0, 0]),
    ],
    [
        ('<div><a href="/">Home</a> <a href="/b">Blog</a></div>', [0]),
        (f"<div>{LONG}</div><div>{NOTE}</div><div>{MORE}</div>", [1, 1, 1]),
        ('<div><a href="/c">Contact</a> | <a href="/d">Data</a></div><div>All rights reserved</div>', [0, 0]),
    ],
    [
        ('<div><a href="/">Start</a></div><div><a href="/s">Shop</a></div>', [0, 0]),
        (f'<h2>What the post said</h2><p>{NOTE} See <a href="/m">the method</a> and its limits.</p><p>{MORE}</p>', [1, 1, 1]),
        (f"<p>{LONG}</p>", [1]),
        ('<div><a href="/y">Older</a></div><div>Made by hand</div>', [0, 0]),
    ],
    [
        (f"<nav>{MENU}</nav><div class='banner'><p>{LONG}</p></div>", [0, 0, 0, 0]),
        (f"<article><p>{NOTE}</p><p>Yes.</p><p>No.</p><blockquote>{MORE}</blockquote>", [1, 1, 1, 1]),
        ('<p>All of it is in <a href="/r">the full report of the council</a>.</p>', [1]),
        (f'<section class="comments"><h3>Comments</h3><p>{LONG}</p></section></article>', [0, 0]),
        ("<div>Weather: rain</div><div>Exchange: shut</div>", [0, 0]),
    ],
    [
        (f'<div role="banner">The Paper</div><div role="navigation"><p>{NOTE}</p></div>', [0, 0]),
        (f'<article><h1>Low water</h1><p>Short.</p><p><a href="/a">Its source</a></p><p>{MORE}</p></article>', [1, 1, 1, 1]),
        (f'<div class="related"><p>{LONG}</p><p><a href="/k">Next story</a></p></div>', [0, 0]),
        (f"<div>{NOTE}</div>", [0]),
    ],
    [
        (f"<p>{NOTE}</p><main><p>{LONG}</p><p>Rain.</p></main><p>{MORE}</p>", [0, 1, 1, 0]),
        ('<div><a href="/t">Top</a></div>', [0]),
    ],
    [(f"<article><p>Rain.</p><p>{LONG}</p><p>More rain.</p></article>", [1, 1, 1])],
    [(f"<main><h1>Low water</h1><p>{NOTE}</p><p>Ends.</p></main>", [1, 1, 1])],
    [("<article><p>Two words</p><p>Three more words</p></article>", [1, 1])],
    [("<article><p>One</p></article>", [1])],
    [(f'<div class="entry-content"><p>{MORE}</p><p>{LONG}</p><p><a href="/z">Our earlier report</a></p></div>', [1, 1, 1])],
    [
        ('<article><p><a href="/q">A letter</a> came.</p><p>It was wet.</p><p><a href="/w">It said</a></p></article>', [1, 1, 1]),
        ("<p>Wet paper</p>", [0]),
    ],
    [("<p>Printed here</p>", [0]), (f"<article><p>{NOTE}</p></article>", [1])],
    [(f'<p><a href="/u">Up</a></p><article><p>Dry.</p><p>{NOTE}</p><p>Dry again.</p></article>', [0, 1, 1, 1])],
    [(f"<p>{LONG}</p><p>{NOTE}</p><p>{MORE}</p><p>That was all of it in the end.</p>", [1, 1, 1, 1])],
    [(f"<h1>Rain</h1><p>{LONG}</p><p>{NOTE}</p>", [1, 1, 1]), ('<p><a href="/v">Views</a></p>', [0])],
    [(f"<h1>Hail and wind</h1><p>{MORE}</p>", [1, 1])],
    [(f"<nav>{MENU}</nav><p>{MORE}</p><p>{LONG}</p><p>It went on raining for days.</p>", [0, 0, 0, 1, 1, 1])],
    [(f"<p>{LONG}</p>", [1])],
    [("<p>A short page.</p>", [1])],
    [("<div>Closed until Monday.</div>", [1])],
    [
        (f'<article class="post category-legal"><header class="entry-header"><h1>Low water</h1></header><p>{MORE}</p>', [1, 1]),
        ("<p>It fell by <math><mi>x</mi><mo>=</mo><mn>2</mn></math> feet.</p></article>", [1]),
        (f'<ul class="category-menu"><li>{NOTE}</li></ul>', [0]),
    ],
    [(f"<p>{MORE}</p><p>{NOTE}</p>", [1, 1]), ("<footer>Imprint and contact</footer>", [0])],
]


# Further pages of seven layouts, each with sentences of its own.
WHO = (
    "The harbour master", "An old teacher", "My neighbour", "The smallest of the goats", "A young engineer", "The choir", "Her brother", "The second crew",
    "A letter from the council", "The night train", "Our baker", "The last keeper of the light",
)
DID = (
    "kept a record of every storm that came in from the west", "would not say where the money had gone", "had planted pears along the whole of the wall",
    "took the long road over the hill because the bridge was shut", "found three coins and a button under the floor", "spoke for an hour without looking at the paper",
    "measured the well again and wrote the figure on the door", "arrived two days late and with half of the cargo", "had learnt the song from a sailor in the north",
    "repaired the clock with a spoon and some wire",
)
WHEN = (
    "in the year the river froze", "while the others were still asleep", "before the market opened", "as people do who have waited for too long",
    "although nobody had asked for it", "on the first warm evening of April", "for reasons that were never made clear",
)
SHORT = (
    "It held.", "So it went on.", "Nobody came that day or the next.", "They laughed.", "That was all they had to say.", "It rained again in the night.",
    "Not quite as she had planned.",
)
NOTES = ("Printed in town", "All rights reserved by the printers", "Imprint", "Set by hand since the first issue", "Number 12 of this year", "Last changed on a Monday")
LINKS = ("Home", "News", "Sport", "Letters", "Archive", "Contact", "Weather", "Shop", "Jobs", "Travel", "Food", "Music", "Maps")


def _sentence(n: int) -> str:
    return f"{WHO[n % len(WHO)]} {DID[n % len(DID)]} {WHEN[n % len(WHEN)]}."


def _links(n: int, count: int) -> str:
    return " ".join(f'<a href="/{n}/{i}">{LINKS[(n + i) % len(LINKS)]}</a>' for i in range(count))


def _made(layout: int, n: int) -> list[Piece]:
    """The ``n``-th page of a layout. In pages without hints a short block belongs to the text if text follows and it is a heading or text precedes it."""
    one, two, three, four = (_sentence(4 * n + i) for i in range(4))
    brief, other = SHORT[n % 7], SHORT[(n + 3) % 7]
    many = _links(n, 14 + 7 * (n % 6))
    menu, foot = (f"<div>{many}</div>", [0]), (f"<div>{_links(n + 5, 14 + 7 * ((n + 2) % 6))}</div><div>{NOTES[n % 6]}</div>", [0, 0])
    side = (f'<div class="{("sidebar", "ad", "comments", "cookie-notice", "related")[n % 5]}"><p>{four} {one}</p><p>{other}</p></div>', [0, 0])
    if layout == 0:  # text with a short paragraph in the middle
        return [menu, (f"<h1>{WHO[n % 12]}</h1><p>{one}</p><p>{brief}</p><p>{two} {three}</p>", [1, 1, 1, 1]), side, foot]
    if layout == 1:  # links between and after paragraphs
        return [menu, (f"<p>{one}</p><div>{many}</div><p>{two}</p>", [1, 0, 1]), (f"<p>{brief}</p><div>{many}</div>", [0, 0]), side, foot]
    if layout == 2:  # a short line behind a list of links is no text
        return [side, menu, (f"<div>{brief}</div>", [0]), (f"<div>{one}</div><div>{two}</div><div>{other}</div><div>{three}</div>", [1, 1, 1, 1]), foot]
    if layout == 3:  # what readers write lies outside of the article, without a name
        return [menu, (f"<article><h2>{WHO[n % 12]}</h2><p>{one}</p><p>{brief}</p></article>", [1, 1, 1]), (f"<div><div>{two}</div><div>{three} {four}</div></div>", [0, 0])]
    if layout == 4:  # lists of short things, and notices
        box = f'<div class="sidebar"><p>{four}</p></div>'
        return [menu, (f"<main><p>{one}</p><ul><li>Flour</li><li>Salt</li></ul><p>{two}</p></main>", [1, 1, 1, 1]), (box, [0]), ("<div>Rain today</div><div>Wind from the west</div>", [0, 0])]
    if layout == 5:  # headings inside the text, credits behind it
        return [(f"<h1>{WHO[n % 12]}</h1><p>{one}</p><h2>{WHO[(n + 4) % 12]}</h2><p>{two}</p>", [1, 1, 1, 1]), (f"<p>{NOTES[n % 6]}</p><p>{NOTES[(n + 1) % 6]}</p>", [0, 0]), foot]
    return [(f"<div class='post-content'><p>{one}</p><p>{brief}</p></div>", [1, 1]), (f"<h3>More</h3><div>{_links(n, 6)}</div>", [0, 0]), (f"<footer>{two}</footer>", [0])]


PAGES += [_made(layout, n) for layout in range(7) for n in range(7 * layout, 7 * layout + 6)]


def labelled() -> list[tuple[str, list[int]]]:
    return [("".join(h for h, _ in page), [label for _, own in page for label in own]) for page in PAGES]
