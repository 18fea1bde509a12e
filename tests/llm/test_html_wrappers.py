from __future__ import annotations

import functools
import html
import random
import re
import tracemalloc

import pytest

from starload.llm import html_wrappers
from starload.llm.html_wrappers import (
    TEXT,
    extract_main_text,
    fold_repeats,
    infer_wrappers,
    main_text,
    mark_article,
    merge,
    parse,
    to_wrapper,
)
from tests.conftest import SF_DIR
from tests.llm.conftest import by_id

PAGE = "page_id BIGINT, url STRING, html STRING"


def wrapper_of(*pages):
    return functools.reduce(merge, [to_wrapper(parse(p)) for p in pages])


def shape(part):
    """A wrapper as a regular expression."""
    inner = "".join(map(shape, part.children))
    name = "#" if part.signature == TEXT and part.fixed is None else "$" if part.signature == TEXT else part.signature
    if part.is_group:
        name = ""
        inner = f"({inner})"
    elif inner:
        inner = f"[{inner}]"
    return name + inner + ("+" if part.repeated else "") + ("?" if part.optional else "")


@pytest.mark.parametrize(
    ("pages", "wanted"),
    [
        (["<div>a</div>", "<div>b</div>"], "[div[#]]"),
        (["<div>a</div>", "<div>a</div>"], "[div[$]]"),
        (["<ul><li>a<li>b</ul>", "<ul><li>c</ul>"], "[ul[li[#]+]]"),
        (["<h1>t</h1><p>a", "<h1>t</h1><hr><div>x</div><p>a"], "[h1[$]div[$]?p[$]]"),
        (["<dl><dt>a<dd>b<dt>c<dd>d</dl>"], "[dl[(dt[#]dd[#])+]]"),
        (["<dl><dt>a<dd>b<dt>c<dd>d</dl>", "<dl><dt>a<dd>b</dl>"], "[dl[(dt[#]dd[#])+]]"),
        (["<div class='x-1'>a</div>", "<div class='x-2'>a</div>"], "[div.x[$]]"),
    ],
)
def test_mismatches_become_slots_options_and_repeats(pages, wanted):
    assert shape(wrapper_of(*pages)) == wanted
    assert shape(wrapper_of(*reversed(pages))) == wanted


def test_a_wrapper_takes_pages_it_knows_without_change():
    pages = ["<ul><li>a<li>b</ul><p>x", "<p>y<div>z</div>", "<ul><li>q</ul><div>z</div>"]
    whole = wrapper_of(*pages)
    for page in pages:
        assert shape(merge(wrapper_of(*pages), to_wrapper(parse(page)))) == shape(whole)
    assert fold_repeats([]) == []


SITE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head>
<body><header>Site</header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- x --><div class="ad">Buy</div>
{}<aside>More</aside><div id="comments"><div class="comment"><p>First!</p></div></div>
<form><input value="a>b"><button>Go</button></form><footer>&copy; me</footer></body></html>"""


@pytest.mark.parametrize("around", ["<article>{}</article>", "<main>{}</main>", "<div class='text'>{}</div>"])
def test_only_the_article_is_taken(around):
    bodies = [
        f"<h1>Title {i}</h1><p>Some <b>bo</b>ld&nbsp;&amp; &#233;\n text {i}.<br>Line<p>Next <a href=x>link</a> of {i}</p>"
        "<ul><li>one<li>two</ul><table><tr><td>c<td>d<tr><td>e</table>" + "<p>More words here.</p>" * i
        for i in range(4)
    ]
    pages = [SITE.format(around.format(b)) for b in bodies]
    wrapper = mark_article(wrapper_of(*pages))
    for i, page in enumerate(pages):
        wanted = f"Title {i} Some bold & é text {i}. Line Next link of {i} one two c d e" + " More words here." * i
        assert main_text(page, wrapper) == wanted


def test_broken_pages():
    wrapper = mark_article(wrapper_of("<article><p>a</article>"))
    assert main_text("<article><p>cut &amp", wrapper) == "cut &"
    assert main_text("<article>a<b>c<p>d</b></p></p>e</div></article>x", wrapper) == "ac d e"
    assert main_text("<article>a<!-- never ends", wrapper) == "a"
    assert main_text("<article>a<script>x</article>", wrapper) == "a"
    assert main_text("<article title='never ends>a</article>", wrapper) == ""
    assert main_text("<article>1 < 2 <3 </article>", wrapper) == "1 < 2 <3"
    assert main_text("just text", wrapper) == "just text"
    assert main_text("", wrapper) == main_text(None, wrapper) == ""


def test_long_pages_take_no_longer_than_their_length():
    wrapper = mark_article(wrapper_of("<article><p>a</article>"))
    assert main_text("<article>" + "<p>x" * 30_000, wrapper).count("x") == 30_000
    main_text('<a "' * 100_000, wrapper)
    main_text("<" * 100_000, wrapper)
    main_text("<div>" * 400 + "x", wrapper)


def test_without_a_named_article_no_free_text_is_lost():
    page = (
        "<body><div class='top'><ul><li><a href='/'>Home</a></ul></div><div class='page'><h1><a href='/{i}'>Title {i}</a></h1>"
        "<div class='lead'><p>Lead {i}</p></div><div class='story'>{story}</div>{more}</div><p>All rights reserved</p></body>"
    )
    story = "<p>Story {i} goes on and on.</p>" * 9
    more = "<div class='appendix'><p>Only this page has it.</p></div>"
    pages = [page.format(i=i, story=story.format(i=i), more=more * (i == 2)) for i in range(4)]
    wrapper = mark_article(wrapper_of(*pages))
    for i, one in enumerate(pages):
        wanted = f"Title {i} Lead {i}" + f" Story {i} goes on and on." * 9 + " Only this page has it." * (i == 2)
        assert main_text(one, wrapper) == wanted
    # Where no text differs, nothing is known to be the frame.
    pages = ["<div><p>same</p></div>", "<div><p>same</p></div><section><p>more</p></section>"]
    assert main_text(pages[1], mark_article(wrapper_of(*pages))) == "same more"


def test_words_need_to_be_whole():
    body = (
        "<body class='has-sidebar'><main class='with-sidebar'><h1 id='notice'>Title {i}</h1>"
        "<h2 id='related-work'>Work</h2><section id='social-history'>History {i}</section>"
        "<div class='notice-period'>Period {i}</div><section id='notice'>Closed on Monday {i}</section>"
        "<math><mi>x</mi><mo>=</mo><mn>{i}</mn></math><div class='newsletter'>Sign up</div>"
        "<div class='related'><ul><li><a href='/{i}'>Other {i}</a></ul></div><div class='ad'>Buy {i}</div></main></body>"
    )
    text = "Title {i} Work History {i} Period {i} x = {i}"
    for plain in (body, body.replace("main", "div")):
        for numbers in (range(4), [7], [7, 7]):
            pages = [plain.format(i=i) for i in numbers]
            wrapper = mark_article(wrapper_of(*pages))
            assert [main_text(p, wrapper) for p in pages] == [text.format(i=i) for i in numbers]


DROPPED = """comment user-comments commentlist reader-comments comments_area sidebar widget related related-posts promo
notice site-notice newsletter sponsored cookie-bar cookie-consent footer page-header site-footer main-nav share-buttons""".split()


@pytest.mark.parametrize("around", ["<article>{}</article>", "<main>{}</main>", "<div class='story'>{}</div>"])
@pytest.mark.parametrize("where", ["before", "after", "inside"])
@pytest.mark.parametrize("attribute", ["class='x {}-2'", "id={}", "role='{}'"])
def test_named_parts_go_though_their_text_varies(around, where, attribute):
    """Six pages a host, each with another text in the part: none of it stays, and nothing of the
    article goes."""
    for word in DROPPED:
        pages, wanted = [], []
        for i in range(6):
            part = f"<div {attribute.format(word)}><p>Other words {i} of {word}</p></div>"
            story = f"<h1>Title {i}</h1><p>Story {i}</p>{part if where == 'inside' else ''}<p>Goes on {i}</p>"
            whole = around.format(story)
            ends = {"before": (part, ""), "after": ("", part), "inside": ("", "")}[where]
            pages.append(f"<body><div class='page'>{ends[0]}{whole}{ends[1]}</div></body>")
            wanted.append(f"Title {i} Story {i} Goes on {i}")
        wrapper = mark_article(wrapper_of(*pages))
        assert [main_text(p, wrapper) for p in pages] == wanted, word


@pytest.mark.parametrize("words", ["related-work", "notice-period", "social-history", "commentary", "footer-of-the-world", "has-sidebar", "headers"])
def test_other_words_stay(words):
    pages = [f"<article><p>a {i}</p><div class='{words}'>kept {i}</div></article>" for i in range(6)]
    wrapper = mark_article(wrapper_of(*pages))
    assert [main_text(p, wrapper) for p in pages] == [f"a {i} kept {i}" for i in range(6)]


@pytest.mark.parametrize(
    "others",
    [
        "<div class='list'>{many}</div>", "<section><div>{many}</div></section>", "<div class='comments'>{many}</div>",
        "{many}", "<div class='c'>{one}</div>", "{called}",
    ],
)
def test_of_several_articles_the_main_one_is_taken(others):
    pages, wanted = [], []
    for i in range(6):
        one = f"<article><p>A reader says {i} at some length, longer than the story.</p></article>"
        called = f"<article class='comment'><h3>Me {i}</h3><p>says</p></article>"
        rest = others.format(many=one * (1 + i % 3), one=one, called=called * (i % 3))
        pages.append(f"<main><article><h1>Title {i}</h1><p>Story {i}</p></article>{rest}</main>")
        wanted.append(f"Title {i} Story {i}")
    wrapper = mark_article(wrapper_of(*pages))
    assert [main_text(p, wrapper) for p in pages] == wanted


def test_a_page_of_several_articles_keeps_them():
    pages = [
        "<main>" + "".join(f"<article><h2>Part {i} {n}</h2><p>Text {i} {n}</p></article>" for n in range(1 + i % 3)) + "</main>"
        for i in range(6)
    ]
    wrapper = mark_article(wrapper_of(*pages))
    for i, page in enumerate(pages):
        assert main_text(page, wrapper) == " ".join(f"Part {i} {n} Text {i} {n}" for n in range(1 + i % 3))


KINDS = [f"<div class='{a}{b}'>{{}}</div>" for a in "abcdef" for b in "ghij"] + ["<p>{}</p>", "<h2>{}</h2>", "<ul><li>{}</ul>"]


def mixed(seed, blocks):
    draw = random.Random(seed)
    texts = [f"t{seed}x{n}" for n in range(blocks)]
    body = "".join(draw.choice(KINDS).format(t) for t in texts)
    return f"<body><nav>n</nav><article><h1>T</h1>{body}</article><div class='comments'>{body}</div></body>", "T " + " ".join(texts)


def test_a_wrapper_stops_growing():
    def parts(first, last):
        wrapper = wrapper_of(*(mixed(seed, 40)[0] for seed in range(first, last)))
        return wrapper, len(wrapper.to_list())

    some, n = parts(0, 100)
    more, many = parts(0, 600)
    assert many <= 2 * n and many < 500
    mark_article(more)
    for seed in (3, 599):
        page, text = mixed(seed, 40)
        assert main_text(page, more) == text
    halves = merge(wrapper_of(*(mixed(s, 40)[0] for s in range(50))), wrapper_of(*(mixed(s, 40)[0] for s in range(50, 100))))
    assert len(halves.to_list()) <= 2 * n


def test_long_mixed_pages_need_little(spark):
    pages = [mixed(seed, 25_000) for seed in (1, 2)]
    assert min(len(p) for p, _ in pages) > 900_000
    tracemalloc.start()
    wrapper = mark_article(wrapper_of(*(p for p, _ in pages)))
    texts = [main_text(p, wrapper) for p, _ in pages]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert texts == [t for _, t in pages]
    assert most < 300 << 20


@pytest.mark.parametrize(("table", "longest"), [(10**9, True), (0, False)])
def test_alignments_are_common_subsequences(monkeypatch, table, longest):
    monkeypatch.setattr(html_wrappers, "_TABLE", table)
    draw = random.Random(4)
    for _ in range(200):
        a, b = (draw.choices("abcde", k=draw.randint(0, 25)) for _ in range(2))
        found = html_wrappers._common(a, b)
        assert all(a[i] == b[j] for i, j in found)
        assert all(x < u and y < v for (x, y), (u, v) in zip(found, found[1:], strict=False))
        if longest:
            best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
            for i in range(len(a)):
                for j in range(len(b)):
                    best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
            assert len(found) == best[-1][-1]


def test_wrappers_are_folded_in_rounds(spark, monkeypatch):
    """More tasks than a round folds; the session sends the module to its workers by name, so
    the number is changed on the driver only, where rounds are planned."""
    monkeypatch.setattr(html_wrappers, "_FOLDED", 2)
    rows = [(i, f"http://a.example/{i}", f"<nav>n</nav><article><p>text {i}</p></article>") for i in range(40)]
    found = infer_wrappers(spark.createDataFrame(rows, PAGE).repartition(9))
    assert found.count() == 1
    assert extract_main_text(spark.createDataFrame(rows, PAGE).repartition(9)).filter("text != concat('text ', page_id)").count() == 0


def test_pages_may_nest_to_any_depth(spark):
    deep = "<div>" * 100_000
    rows = [
        (1, "http://a.example/1", f"{deep}<p>one</p>"), (2, "http://a.example/2", f"{deep}<p>two</p>"),
        (3, "http://b.example/", "<p><table>" + deep + "alone"), (4, "http://c.example/", "<p>flat</p>"),
    ]
    found = by_id(extract_main_text(spark.createDataFrame(rows, PAGE)), "page_id")
    assert {i: r["text"] for i, r in found.items()} == {1: "one", 2: "two", 3: "alone", 4: "flat"}


def test_rows_of_every_kind(spark):
    page = "<article><p>text</p></article>"
    rows = [
        (1, "http://a.example/x", page), (2, "HTTP://u@A.EXAMPLE:80/y", page), (3, None, page),
        (4, "no url", page), (5, "http://a.example/", None), (6, "http://a.example/", ""), (None, "http://b.example", page),
        (1, "http://a.example/x", page),
    ]
    table = spark.createDataFrame([(*r, "?", "?") for r in rows], f"{PAGE}, text STRING, wrapper STRING")
    wanted = sorted((str(i), str(u), "text" if h else "") for i, u, h in rows)
    for limit in (64 << 20, 0):
        found = extract_main_text(table, max_broadcast_bytes=limit)
        assert sorted((str(r["page_id"]), str(r["url"]), r["text"]) for r in found.collect()) == wanted
        assert all(r["n_chars"] == len(r["text"]) for r in found.collect())
    assert {r["host"] for r in infer_wrappers(table).collect()} == {"a.example", "b.example", ""}
    assert extract_main_text(table.limit(0)).count() == 0


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    found = by_id(extract_main_text(pages), "page_id")
    for row in pages.collect():
        article = re.search(r"<article>(.*)</article>", row["html"], re.S).group(1)
        text = re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", article))
        assert found[row["page_id"]]["text"] == " ".join(html.unescape(text).split())
