"""Main text of pages: names of elements, template text, containers, pages of several templates."""

from __future__ import annotations

import pytest

from dimflow.llm import wrappers

TEXT = "<h1>Title</h1><p>Some words of the text.</p><p>And some more of them.</p>"
LINES = "Title\nSome words of the text.\nAnd some more of them."


def own_text(page):
    return wrappers.main_text(page, wrappers.choose({p: tuple(n) for p, n in wrappers.skeleton(page)[1].items()}))


@pytest.mark.parametrize("page", [
    "<body class='no-sidebar'><div>{}</div>", "<body class='has-sidebar nav-open'><div>{}</div>",
    "<html class=menu><body class='sidebar'><div>{}</div>", "<body><div class='content-with-sidebar'>{}</div>",
    "<body><article class='has-comments'>{}</article>", "<body><main class='widget'>{}</main>",
    "<body><div id='social-studies'>{}</div>", "<body><div class='banner'>{}</div><p>end</p>",
    "<body><form id=page>{}</form>"])
def test_theme_names_keep_the_text(page):
    assert own_text(page.format(TEXT)).startswith(LINES)


@pytest.mark.parametrize("name", ["sidebar", "cookie-banner", "top-menu", "x site-footer", "related_posts", "ad1"])
def test_names_of_boilerplate(name):
    assert own_text(f"<body><div class='{name}'><p>Not this.</p></div>{TEXT}</body>") == LINES


def test_many_comments_beside_an_article():
    assert own_text(f"<body><article>{TEXT}</article><div id=comments><p>{'reply ' * 50}</p></div>") == LINES


def test_title_and_lead_outside_the_body():
    page = f"<body><div class=post><h1>Title</h1><p class=lead>The lead.</p><div class=body><p>{'word ' * 200}</p>" \
           "<p>end</p></div></div><ul class=c9><li><a href=/>Home</a></ul></body>"
    assert own_text(page).split("\n") == ["Title", "The lead.", ("word " * 200).strip(), "end"]


def test_names_after_a_long_class_list():
    long = "flex flex-col items-start justify-between rounded-lg shadow-md transition-colors"
    page = f"<body><div class='{long} cookie-banner'>Not this.</div>{TEXT}<div class='{long}' id='comments'>Nor this." \
           "</div></body>"
    assert own_text(page) == LINES
    assert wrappers._label("div", f"class='{long} one'") != wrappers._label("div", f"class='{long} two'")


def host_pages(spark, pages):
    return spark.createDataFrame([(i, "http://h.example/x", page) for i, page in enumerate(pages)],
                                 "page_id long, url string, html string")


def texts(spark, pages):
    return {r["id"]: r["text"] for r in wrappers.extract(host_pages(spark, pages)).collect()}


def test_slots_of_equal_labels():
    """The same label before and after another one is two slots; rounds of a group share theirs."""
    tree, _ = wrappers.skeleton("<div>a</div><p>b</p><div>c</div><dl><dt>a<dd>b<dt>c<dd>d</dl>")
    found = wrappers.read_slots(wrappers.outline("<p>1</p><div>2</div><dl><dt>3<dd>4<dt>5<dd>6</dl>"),
                                wrappers.Slots(tree))
    assert {k: v[0] for k, v in found.items()} == {"/p": 1, "/div@2": 1, "/dl/dt": 2, "/dl/dd": 2}


def test_template_text_in_unlisted_elements(spark):
    """Menu, notice and advert in elements whose names say nothing, the same on every page, are no main text."""
    page = ("<body><div class=c7><p>Buy our lovely hats and coats</p></div><div class=c8><a href=/>Home</a> "
            "<a href=/n>News</a></div><div class=c1><h1>Title {0}</h1><p>Words of page {0} that are its own, {0} of "
            "{0}, and so on.</p></div><div class=c9>All rights reserved by us</div></body>")
    pages = [page.format(i) for i in range(5)]
    expected = "Title {0}\nWords of page {0} that are its own, {0} of {0}, and so on."
    assert texts(spark, pages) == {i: expected.format(i) for i in range(5)}


def test_copies_of_a_page_are_not_template_text(spark):
    page = "<body><div class=c1><p>One text, often.</p></div><div class=c2><p>{}</p></div></body>"
    assert set(texts(spark, [page.format("end")] * 6).values()) == {"One text, often.\nend"}
    found = texts(spark, [page.format(f"end{i}") for i in range(4)])  # near copies
    assert found == {i: f"One text, often.\nend{i}" for i in range(4)}


def test_pages_of_a_rarer_template(spark):
    common = "<body><div class=intro></div><article class=content><p>Text {0} of the page {0}, its own.</p></article>"
    rare = "<body><div class=intro><p>Text {0} in the other place.</p><p>More {0}.</p></div><article class=content>{1}" \
           "</article>"
    pages = [common.format(i) for i in range(19)] + [rare.format(19, ""), rare.format(20, "<p>Teaser</p>")]
    found = texts(spark, pages)
    assert found[0] == "Text 0 of the page 0, its own."
    assert found[19] == "Text 19 in the other place.\nMore 19."
    assert found[20] == "Text 20 in the other place.\nMore 20.\nTeaser"
    assert wrappers.main_text(rare.format(21, "<p>x</p>"), "/body/article.content").startswith("Text 21")


@pytest.mark.parametrize("depth", [100, 600, 5000])
def test_deep_pages(spark, depth):
    """Deep nesting, on one page among others or on all: no crash, every word, blocks stay blocks."""
    deep = "<body><main>" + "<div>" * depth + "<p>One</p>two" + "</div>three<div>" * 2 + "</div>" * depth + "</main></body>"
    plain = f"<body><main>{TEXT}</main></body>"
    found = texts(spark, [deep, plain, deep.replace("One", "Uno"), plain.replace("Title", "Name")])
    assert found[0] == "One\ntwo\nthree\nthree" and found[2] == "Uno\ntwo\nthree\nthree"
    assert found[1] == LINES


@pytest.mark.parametrize("pages", [2, 3, 10, 100])
@pytest.mark.parametrize("body", ["<body><article>{}</article></body>", "<body><div class=c1><main>{}</main></div></body>",
                                  "<body><div class=c2><div class=c3>{}</div></div></body>"])
def test_shared_headings_and_bylines_stay(spark, pages, body):
    """What all articles of a host have in common is theirs; the menu and footer around them still go."""
    article = "<h2>Summary</h2><p>By the editors</p><p>{0} words of page {0} only.</p><h2>Method</h2><p>More of {0}.</p>"
    around = body.replace("<body>", "<body><nav><a href=/>Home</a></nav>").replace(
        "</body>", "<footer>All rights reserved</footer></body>")
    found = texts(spark, [around.format(article.format(f"p{i}")) for i in range(pages)])
    assert found == {i: f"Summary\nBy the editors\np{i} words of page p{i} only.\nMethod\nMore of p{i}."
                     for i in range(pages)}
