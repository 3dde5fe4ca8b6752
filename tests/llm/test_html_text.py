import math
import time

import pytest

from spillway.llm.html_text import Tree, article_node, densities, extract, main_text

ARTICLE = "<article><h1>A title</h1><p>First   paragraph\nof &amp; about <b>things</b>.<p>Second, with <a href='/x'>a link</a> in it.</article>"
TEXT = "A title\nFirst paragraph of & about things.\nSecond, with a link in it."


@pytest.mark.parametrize("page", [
    ARTICLE,
    f"<html><head><title>T</title><style>p{{}}</style><script>var a='<p>no</p>';</script></head><body><nav><ul><li><a href=/>Home</a></ul></nav>{ARTICLE}<footer>&copy; x</footer></body></html>",
    f"<body><header><h2>Site</h2></header><div class='cookie-notice'>We use cookies on this long, long notice.</div>{ARTICLE}<aside>More</aside>",
    f"<body><div id=sidebar><p>Many words in a sidebar, more words than the article has, many words in a sidebar.</p><p>And again.</p></div>{ARTICLE}",
    f"<body>{ARTICLE}<section class='comments'><article class='comment'><p>A reader says a lot of things about this article here.</p></article></section>",
    f"<body><form><label>Name</label><input><button>Send</button></form>{ARTICLE}<div class='adBox ad'>Buy this now, it is very cheap today</div>",
    f"<body class='has-sidebar'><main>{ARTICLE}</main><div role=dialog>Subscribe to the letter</div>",
    f"<!-- a comment <p> --><body>{ARTICLE}<div class='newsletter'><p>Sign up</p></div>",
])
def test_article_without_furniture(page):
    assert main_text(page) == TEXT


def test_without_article_element_the_densest_subtree_wins():
    body = "".join(f"<p>Sentence number {i} of the text, which goes on for a while and has no links at all.</p>" for i in range(6))
    links = "".join(f"<div><a href='/{i}'>link {i}</a></div>" for i in range(40))
    page = f"<body><div>{links}</div><div class='wrap'><h1>Head</h1><div class='content'>{body}</div></div><div>{links}</div></body>"
    lines = main_text(page).split("\n")
    assert lines[0] == "Head" and len(lines) == 7 and "link" not in lines


def test_blocks_and_broken_markup():
    assert main_text("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table>tail<div>x<p>y") == "one\ntwo\na\nb\ntail\nx\ny"
    assert main_text("<article><p>one</b> two</p></div> three") == "one two\nthree"
    assert main_text("<article><p>a<br>b&nbsp;c &#233;&#x1F600;") == "a b c é\U0001f600"
    assert main_text("plain text only") == "plain text only"
    assert main_text("") == main_text("<html></html>") == main_text("<nav>x</nav>") == ""


def test_deep_nesting():
    assert main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"


def test_cases(spark):
    rows = [(1, "u", ARTICLE), (1, "u", ARTICLE), (2, None, None), (None, "v", ""), (3, "w", ARTICLE * 400)]
    pages = spark.createDataFrame([(*r, 5, 6) for r in rows], "page_id long, url string, html string, text int, part int")
    got = {(r["page_id"], r["url"]): r["text"] for r in extract(pages).collect()}
    assert extract(pages).count() == 5
    assert got[(1, "u")] == TEXT and got[(2, None)] == "" and got[(None, "v")] == ""
    assert extract(pages.limit(0)).count() == 0


def section(k):
    body = "".join(f"<p>{f'Words of section {k} in paragraph {i}. ' * 12}</p>" for i in range(6))
    return f"<div><h2>Section {k}</h2>{body}</div>"


@pytest.mark.parametrize("page", [
    "<body><div id=links>{links}</div><div><h1>Title</h1>{sections}</div></body>",
    "<body><div id=links>{links}</div><div><h1>Title</h1>{rows}</div></body>",
    "<body><h1>Title</h1>{sections}</body>",
])
def test_sections_without_article_element_stay_together(page):
    links = "".join(f"<div><a href='/{i}'>link {i}</a></div>" for i in range(40))
    sections = [section(k) for k in (1, 2, 3)]
    rows = "".join(f"<div class=row>{s}</div>" for s in sections)
    lines = main_text(page.format(links=links, sections="".join(sections), rows=rows)).split("\n")
    assert [x for x in lines if len(x) < 20] == ["Title", "Section 1", "Section 2", "Section 3"] and len(lines) == 22


@pytest.mark.parametrize("wrapper", [
    "<div class='content-with-sidebar'>{}</div>",
    "<div class='layout-no-sidebar'>{}</div>",
    "<div id='postWithoutComments'>{}</div>",
    "<div class='page-widget'>{}</div>",
    "<form id=page>{}</form>",
    "<div class='page-widget'><main>{}</main></div><div class=cards><article>A short teaser.</article></div>",
])
def test_a_wrapper_named_like_furniture_keeps_its_article(wrapper):
    assert main_text(f"<body>{wrapper.format(ARTICLE)}") == TEXT


def test_furniture_with_articles_of_its_own_goes_where_the_page_has_another():
    more = "".join(f"<article><h2>Teaser {i}</h2><p>{'More words than the article itself has. ' * 9}</p></article>" for i in range(3))
    for name in ("related", "reader-comments", "post-with-comments comments"):
        assert main_text(f"<body>{ARTICLE}<div class='{name}'>{more}</div>") == TEXT


@pytest.mark.parametrize("name", ["share-prices", "related-work", "social-impact", "notice-period", "ad-spending", "cookie-recipe",
                                  "comment-on-methods", "share", "notice"])
def test_anchors_made_from_headings_drop_nothing(name):
    page = (f"<body><article><h1>T</h1><p>First words.</p><section id='{name}'><h2 id='{name}'>Head</h2><p id='{name}'>Body</p></section>"
            f"<section class='part {name if '-' in name else ''}'><p>More</p></section></article></body>")
    assert main_text(page) == "T\nFirst words.\nHead\nBody\nMore"


@pytest.mark.parametrize("element", ["<div class='ad'>x</div>", "<div id='comments'>x</div>", "<section id='comments'>x</section>",
                                     "<div class='share-buttons'>x</div>", "<div id='comment-list'>x</div>", "<p class='ad'>x</p>",
                                     "<ul class='related-posts'><li>x</ul>", "<div class='ad-slot-3'>x</div>", "<section class='cookie-notice'>x</section>"])
def test_whole_names_are_furniture_inside_an_article(element):
    assert main_text(f"<article><h1>T</h1><p>First words.</p>{element}<p>Last words.</p></article>") == "T\nFirst words.\nLast words."


def test_the_larger_of_two_articles():
    long = "<article><p>Sentence one of the text, which goes on. Sentence two of the text.</p><p>And three.</p></article>"
    assert main_text(f"<main><article><p>Short.</p></article>{long}</main>").startswith("Sentence one")


@pytest.mark.parametrize("page", [
    "<b>" * 100_000 + "</i>" * 100_000, "<i><div>" + "<b>" * 100_000 + "</i>" * 100_000, "<b>" * 50_000 + "<p>x" * 50_000, "<" * 1_000_000,
    "<!-- >" * 150_000, "</" * 500_000, "<![CDATA[>" * 100_000, "<![unknown[ x>" * 70_000, "<script>" + "</" * 400_000 + ">", "<a x='>" * 100_000])
def test_long_broken_markup_is_read_in_proportion(page):
    begin = time.monotonic()
    main_text(page)
    assert time.monotonic() - begin < 20


def plain_densities(tree):
    """The definition, node by node: every count is taken anew over all descendants."""
    kids = [[] for _ in tree.tags]
    for i, up in enumerate(tree.parents):
        if up >= 0 and not tree.off[i]:
            kids[up].append(i)
    own = [sum(len("".join(t.split())) for n, t in tree.parts if n == i and t and not tree.off[i]) for i in range(len(tree.tags))]

    def below(i):
        return [i] + [d for k in kids[i] for d in below(k)]

    def linked(i):
        return i >= 0 and (tree.tags[i] == "a" or linked(tree.parents[i]))

    every = below(0)
    chars = {i: sum(own[d] for d in below(i)) for i in every}
    link = {i: sum(own[d] for d in below(i) if linked(d)) for i in every}
    density = {}
    for i in every:
        tags, link_tags = len(below(i)) - 1, sum(tree.tags[d] == "a" for d in below(i)[1:])
        c, t, lc, lt = chars[i], max(tags, 1), max(link[i], 1), max(link_tags, 1)
        base = math.log(c * lc / max(c - link[i], 1) + link[0] * c / max(chars[0], 1) + math.e)
        density[i] = c / t * max(0.0, math.log(c / lc * t / lt)) / math.log(base) if c else 0.0
    return density, {i: sum(density[k] for k in kids[i]) for i in every}


def test_densities_by_definition_on_given_pages(spark):
    pages = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]
    for html in pages:
        tree = Tree()
        tree.read(html or "")
        density, sums = densities(tree)
        want, want_sums = plain_densities(tree)
        assert density == pytest.approx([want.get(i, 0.0) for i in range(len(density))])
        live = [i for i in want]
        best = max(live, key=lambda i: (want_sums[i], -i))
        path, i = [], best
        while i >= 0 and (not path or tree.tags[path[-1]] != "body"):
            path.append(i)
            i = tree.parents[i]
        threshold = min(want[i] for i in path)
        chosen = max((i for i in live if want[i] >= threshold), key=lambda i: (want_sums[i], -i))
        inside = chosen
        while inside >= 0 and tree.tags[inside] != "article":
            inside = tree.parents[inside]
        assert article_node(tree) == inside
