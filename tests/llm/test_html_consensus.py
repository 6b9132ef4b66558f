import pytest

from quorum.llm.html_consensus import blocks, extract, main_text, scores

SCHEMA = "page_id long, url string, html string"


def page(body, extra=""):
    return (f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
            f"<nav><ul><li><a href='/a'>Home</a></li></ul></nav><!-- <p>no</p> --><div class=\"ad\">Buy now</div>{body}"
            f"{extra}<footer>&copy; 2020</footer></body></html>")


@pytest.mark.parametrize("markup,text", [
    ("<article><h1>Head &amp; tail</h1><p><b>One <i>two</i>\n three<br><p>Four</p></article>", "Head & tail\nOne two three\nFour"),
    ("<article><p>A<!-- c -->B &am &ampC &#233;&nbsp;x</p><script>if(a<b)</script><p>next</article>", "AB &am &C é x\nnext"),
    ("<main><header><h1>Title</h1><span>by me</span></header><p>Body</p><aside>side</aside><form>f<input></form></main>", "Title\nBody"),
    ("<article><p>Text<div class='comments'><p>reader says</p></div><p>more</article>", "Text\nmore"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table></article>", "one\ntwo\na\nb\nc"),
    ("<article><p hidden>no</p><p style='display: none'>no</p><p title='a>b'>yes</p></article>", "yes"),
    ("<div class='post-12 content'><p>Long text of the post, with words.</p><p>And more of it.</p></div><div class='sidebar'>x</div>",
     "Long text of the post, with words.\nAnd more of it."),
    ("<article>loose<p>in</p>tail</article>", "loose\nin\ntail"), ("", ""), ("<article></article>", ""),
    ("<article><p>a < b and c<d</p></article>", "a < b and c"),
    ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"), ("<article><p>unclosed <b>bold", "unclosed bold © 2020"),
])
def test_single_pages(markup, text):
    whole = page(markup)
    if "unclosed" in markup:
        whole, text = "<body>" + markup, "unclosed bold"
    assert main_text(whole, [])[1] == text


def test_plain_and_odd_pages():
    assert main_text("just text &lt;3", [])[1] == "just text <3"
    assert main_text(None, []) == ("", "") == main_text("", ["x"])
    for odd in ("<", "<<<>>>", "</p></div>", "<p", "<a href=\"unclosed>x</a><p>y</p>", "<!--", "<script>never closed", "<p>\0é</p>",
                "<svg><path d='<p>'/></svg>t", "<" * 20_000, "<a '" * 20_000, "<div>" * 3000 + "deep" + "</div>" * 3000):
        main_text(odd, [])
    assert main_text("<p>" + "word " * 400_000 + "</p>", [])[1].count("word") == 400_000


def test_host_consensus_overrides_a_page(spark):
    good = "<div class='story-{}'><p>{}</p></div>"
    teaser = "<div class='teaser'><p>{}</p></div>"
    rows = [(i, f"http://h.example.org/{i}", page(good.format(i, "article text " * 30) + teaser.format("short"))) for i in range(12)]
    rows.append((50, "http://h.example.org/x", page(good.format(50, "little") + teaser.format("very long teaser " * 40))))
    rows.append((51, "http://other.example.org/x", page(good.format(51, "little") + teaser.format("very long teaser " * 40))))
    rows += [(60, None, page("<article><p>no url</p></article>")), (None, "nohost", None), (61, "", ""),
             (62, "HTTP://H.example.org:80/?a", page(good.format(1, "same host")))]
    df = spark.createDataFrame(rows + rows[:1], SCHEMA).selectExpr("*", "1 as host", "2 as winners", "'z' as text")
    got = {}
    for r in extract(df).collect():
        got.setdefault(r.page_id, []).append(r.text)
    assert got[50] == ["little"] and got[51] == [("very long teaser " * 40).strip()]
    assert got[60] == ["no url"] and got[None] == [""] == got[61] and got[62] == ["same host"] and len(got[0]) == 2
    assert extract(spark.createDataFrame([], SCHEMA)).collect() == []


def test_generalised_paths():
    a, b = (scores(f"<body><div class='b{i} a-{i}x'><p>some text</p></div>") for i in (1, 22))
    assert a.keys() == b.keys()
    assert [t for _, t, _, _ in blocks("<p>a<p>b</p>c")] == ["a", "b", "c"]


def test_given_pages(spark):
    """Against a plain reading of this layout: what stands between the article tags."""
    import html
    import re
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in extract(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", " ", inner))
        want = [" ".join(html.unescape(p).split()) for p in parts]
        assert got[r.page_id] == "\n".join(w for w in want if w)


LONG = "long text of the article, " * 30


@pytest.mark.parametrize("markup,text", [
    (f"<article><h1>Head</h1><p>intro</p><section><p>{LONG}</p></section></article>", f"Head\nintro\n{LONG.strip()}"),
    (f"<main><h1>Head</h1><div class='x'><div class='body'><p>{LONG}</p></div></div><div class='end'><p>End</p></div></main>",
     f"Head\n{LONG.strip()}\nEnd"),
    (f"<article><p>intro</p><table><caption>Cap</caption><tr><th>h</th><td>{LONG}</td></tr></table><p>end</p></article>",
     f"intro\nCap\nh\n{LONG.strip()}\nend"),
    (f"<div class='post'><p>intro</p><blockquote><p>{LONG}</p></blockquote><p>end</p></div>", f"intro\n{LONG.strip()}\nend"),
    (f"<main><h1>Head</h1><article><p>{LONG}</p></article></main>", f"Head\n{LONG.strip()}"),
])
def test_nested_containers_keep_the_whole_article(markup, text):
    assert main_text(page(markup), [])[1] == text


@pytest.mark.parametrize("name", ["content has-sidebar", "entry no-comments", "post with-header", "search-result", "print", "nav-open"])
@pytest.mark.parametrize("inner", ["{}", "<article>{}</article>", "<main>{}</main>"])
def test_a_wrapper_named_like_noise_keeps_its_article(name, inner):
    markup = f"<div class='{name}'>" + inner.format(f"<p>{LONG}</p><p>more</p>") + "</div>"
    assert main_text(page(markup), [])[1] == f"{LONG.strip()}\nmore"


@pytest.mark.parametrize("name", ["site-footer", "sidebar", "post-comments", "comments-list", "related", "share", "main-menu", "ad"])
def test_parts_named_as_noise_still_go(name):
    part = f"<div class='{name}'><p>not the article</p></div>"
    assert main_text(page(f"<article><p>{LONG}</p>{part}<p>end</p></article>"), [])[1] == f"{LONG.strip()}\nend"
    assert main_text(page(f"<div class='x'><p>{LONG}</p>{part}</div>", part), [])[1] == LONG.strip()


@pytest.mark.parametrize("side", ["sidebar", "notice", "sideBar", "related-posts", "banner", "search-box"])
@pytest.mark.parametrize("size", [1, 20])
def test_a_named_part_never_wins_over_unnamed_text(side, size):
    part = f"<div class='{side}'><p>{'words beside the article ' * size}</p></div>"
    for around in ("<div class='wrap'>{}</div>", "<article>{}</article>", "<section>{}</section>"):
        assert main_text(page(around.format("<p>A short article.</p>"), part), [])[1] == "A short article."


def test_linked_articles_keep_their_text():
    links = "<p><a href='/x'>" + "a linked sentence " * 20 + "</a></p>"
    plain = " ".join(("a linked sentence " * 20).split())
    assert main_text(page(f"<article><p>Introduction.</p>{links}</article>"), [])[1] == "Introduction.\n" + plain
    assert main_text(page(f"<article>{links}</article>"), [])[1] == plain
    # A list of links without a name is no article as long as there is one.
    assert main_text(page("<div class='x'><p>Article.</p></div>", f"<div class='y'>{links}</div>"), [])[1] == "Article."


@pytest.mark.parametrize("name", ["commentSection", "topnav", "mainMenu", "userComments", "pageFooter", "subnav"])
def test_camel_case_and_joined_names(name):
    part = f"<div class='{name}'><p>{'not the article ' * 20}</p></div>"
    assert main_text(page("<div class='x'><p>Article.</p></div>", part), [])[1] == "Article."


@pytest.mark.parametrize("name", ["lead-menu", "side-effects", "print-media", "header-image", "notice-period"])
def test_names_of_prose_inside_an_article(name):
    kept = f"<article><p>One.</p><p class='{name}'>Two.</p><h2 class='{name}'>Three</h2></article>"
    assert main_text(page(kept), [])[1] == "One.\nTwo.\nThree"
    linked = f"<article><p>One.</p><p class='{name}'><a href='/'>elsewhere</a></p><p class='advert'>Buy.</p></article>"
    assert main_text(page(linked), [])[1] == "One."


LAYOUTS = {
    "nested": "<div class='page'><div class='col'><div class='text'>{}</div></div></div>",
    "section": "<section class='s'><section class='t'>{}</section></section>",
    "table": "<table><tr><td><ul><li><a href='/1'>One</a></li></ul></td><td><div class='c'>{}</div></td></tr></table>",
    "article": "<main><article>{}</article></main>",
    "plain": "{}",
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_layouts_against_a_plain_reading(spark, layout):
    """Pages of one host and layout, long and short, with parts of many kinds around: the text
    is what was put into the layout's hole."""
    import random
    rng = random.Random(layout)
    rows, want = [], {}
    for i in range(24):
        inner = []
        for _ in range(rng.choice((1, 2, 8))):
            words = " ".join(rng.choice(("alpha", "beta", "gamma", "caf&eacute;", "<b>delta</b>", "x &lt; y"))
                             for _ in range(rng.choice((3, 12, 60))))
            inner.append((rng.choice(("p", "h2", "p", "blockquote")), words))
        if all(tag == "h2" for tag, _ in inner):
            inner.append(("p", "last words"))
        want[i] = "\n".join(" ".join(w.replace("<b>", "").replace("</b>", "").replace("&eacute;", "é").replace("&lt;", "<").split())
                            for _, w in inner)
        parts = [f"<div class='{c}'>{'<p>other words on this page</p>' * rng.choice((1, 9))}</div>"
                 for c in ("sidebar", "commentSection", "ad", "cookie-notice", "share") if rng.random() < 0.6]
        body = LAYOUTS[layout].format("".join(f"<{t}>{w}</{t}>" for t, w in inner))
        rows.append((i, f"https://{layout}.example.org/{i}", page(body, "".join(parts))))
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == want
