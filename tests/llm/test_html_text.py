import time

import pytest

from daybook.llm.html_text import main_blocks, main_text

TEXT = "A first paragraph, with commas, that is long enough to be scored as part of the article."
MORE = "A second one follows, again long enough, to make the container the best of the page."

PAGES = [
    ("", []),
    ("<p></p>", []),
    ("no markup &lt;at all&gt;", ["no markup <at all>"]),
    (f"<nav><a href=x>Home</a></nav><article><h1>Head</h1><p>{TEXT}<p>{MORE}<br>end</article><footer>f</footer>",
     ["Head", TEXT, f"{MORE} end"]),
    (f"<div id=menu><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div><div class=content><p>{TEXT}</p><p>ok</p>"
     f"<div class='ad-box ads'>buy</div><form><p>sign up</p></form></div><div class=comments><p>{MORE}</p></div>",
     [TEXT, "ok"]),
    (f"<main><section><p>{TEXT}</p></section><section><p>{MORE}</p></section></main><aside>{TEXT}</aside>", [TEXT, MORE]),
    (f"<article><script>var a='<p>no</p>'</script><style>p{{}}</style><!-- <p>no</p> --><p>{TEXT}</article>", [TEXT]),
    (f"<article><p title='a > b'>{TEXT}</p><p>5 < 6 &amp; 7&nbsp;&gt;  3</p>", [TEXT, "5 < 6 & 7 > 3"]),
    (f"<article><p>{TEXT}</p><p><a href=x>a linked line</a></p><div class='cookie-notice'>accept</div></article>",
     [TEXT, "a linked line"]),
    (f"<ARTICLE><P>{TEXT}</P><TABLE><TR><TD>a<TD>b</TABLE></ARTICLE>", [TEXT, "a", "b"]),
    (f"<article><p>{TEXT}</p></article><div style='display: none'><p>{MORE}</p></div>", [TEXT]),
    (f"<article><p>{TEXT}</p><script>never closed <p>{MORE}", [TEXT]),
]


@pytest.mark.parametrize("page,blocks", PAGES)
def test_pages(page, blocks):
    assert main_blocks(page) == blocks


def test_long_and_hostile_pages():
    assert main_blocks("<article>" + f"<p>{TEXT}</p>" * 3000 + "</article>") == [TEXT] * 3000
    for page in ("<" * 20_000, "<div>" * 3000, "</p>" * 3000, "<a '" * 3000, "<p" + " x='" * 3000, "<!--" * 5000):
        main_blocks(page)


def test_rows(spark):
    rows = [(1, "u", PAGES[3][0]), (1, "u", PAGES[3][0]), (2, None, None), (None, "u", ""), (3, "u", "<p>x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as n")
    found = sorted(map(tuple, main_text(pages).collect()), key=str)
    head = "\n\n".join(PAGES[3][1])
    assert found == sorted([(1, "u", head), (1, "u", head), (2, None, ""), (None, "u", ""), (3, "u", "x")], key=str)
    assert main_text(pages.where("false")).count() == 0


WRAPPERS = [
    "<div class='layout has-sidebar'>", "<div class=page-with-header>", "<div class='no-comments'>",
    "<section class=related-work>", "<form id=aspnetForm method=post>", "<div id=sidebar-wrapper>",
    "<form><div class='widget'>",
]


@pytest.mark.parametrize("wrapper", WRAPPERS)
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_wrapped_article(wrapper, tag):
    page = (
        f"<body><p>A line</p>{wrapper}<div class=sidebar><p>side, menu</p></div><{tag}><p>{TEXT}</p>"
        f"<p>{MORE}</p><form>sign up</form></{tag}><div class=comments><p>{MORE} {MORE} {TEXT} {TEXT}</p></div>"
    )
    assert [b for b in main_blocks(page) if b != "A line"] == [TEXT, MORE]


def test_marked_parts_longer_than_the_article_stay_out():
    long = f"<p>{MORE} {TEXT} {MORE}</p>"
    for mark in ("comments", "cookie-notice", "sidebar", "comments-area"):
        for tag in ("article", "div"):
            page = f"<body><div class=content><p>{TEXT}</p></div><div class='{mark}'><{tag}>{long}</{tag}></div>"
            if mark != "sidebar" or tag == "div":
                assert main_blocks(page) == [TEXT]
    assert main_blocks(f"<form hidden><article>{long}</article></form><p>{TEXT}</p>") == [TEXT]
    assert main_blocks("<body><form><p>Sign in</p><label>Name</label></form>") == []


def test_short_sections_beside_a_long_one():
    short = "A closing paragraph, of three hundred characters at most, with its own commas, and no more. " * 3
    short, links = short.strip(), "<div><a href=1>a linked line of the menu</a> and <a href=2>another of them</a></div>"
    for tag in ("section", "div"):
        long = f"<{tag}>" + f"<p>{TEXT}</p>" * 10 + f"</{tag}>"
        parts = f"<{tag}><p>{MORE}</p></{tag}>{long}{links}<h4>End</h4><{tag}><p>{short}</p></{tag}>"
        wanted = [MORE, *[TEXT] * 10, "End", short]
        assert main_blocks(f"<body><div id=page>{parts}</div>") == wanted
        assert main_blocks(f"<body>{parts}") == wanted
        apart = parts.replace(long, f"<div><div>{long}</div></div>")
        assert main_blocks(f"<body><div id=page>{apart}</div>") == wanted


def test_linked_parts_of_the_article_stay():
    lists = (
        "<ul><li><a href=1>Reference one</a><li><a href=2>Reference two</a></ul>",
        "<ol><li>a point<ul><li><a href=1>Reference one</a><li><a href=2>Reference two</a></ul></ol>",
        "<table><tr><td><a href=1>Reference one</a><td><a href=2>Reference two</a></table>",
        "<div><a href=1>Reference one</a></div><div><a href=2>Reference two</a></div>",
    )
    menu = "<ul><li><a href=x>Home</a><li><a href=y>About us</a></ul>"
    for part in lists:
        point = ["a point"] * ("a point" in part)
        wanted = [TEXT, *point, "Reference one", "Reference two", MORE]
        inside = f"<p>{TEXT}</p>{part}<p>{MORE}</p><ul class=menu><li><a href=z>Next</a></ul>"
        for page in (f"<article>{inside}</article>", f"{menu}<div class=content>{inside}</div>", f"<body>{menu}{inside}"):
            assert main_blocks(page) == wanted


def test_missing_end_tags_and_formulas():
    for tag in ("select", "svg", "template", "noscript", "iframe"):
        assert main_blocks(f"<article><p>{TEXT}</p><{tag}><p>{MORE}</p></article>") == [TEXT, MORE]
        closed = f"<article><{tag}>no</{tag}><p>{TEXT}</p><{tag}><p>{MORE}</p></article>"
        assert main_blocks(closed) == [TEXT, MORE]
    assert main_blocks(f"<article><select><option>no<p>{TEXT}</p></article>") == [TEXT]
    formula = "<math><semantics><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></semantics></math>"
    assert main_blocks(f"<article><p>{TEXT} {formula} holds</p>") == [f"{TEXT} x=2 holds"]
    assert main_blocks(f"<article><p>{TEXT}</p><math><mi>y</mi><p>{MORE}</p>") == [TEXT, "y", MORE]
    for tag in ("script", "style", "textarea", "title"):
        assert main_blocks(f"<article><p>{TEXT}</p><{tag}>no <p>{MORE}") == [TEXT]
    main_blocks("<svg>" * 20_000 + f"<p>{TEXT}")


@pytest.mark.parametrize("page", ["<div>word ", "<ul><li>a ", "<div>", "<span>", "<div><a href=x>b "])
def test_deep_pages_take_time_in_proportion(page):
    start = time.perf_counter()
    main_blocks(page * 20_000 + f"<p>{TEXT}")
    main_blocks(page * 20_000 + "</p>" * 20_000)
    assert time.perf_counter() - start < 20
    assert main_blocks("<div>" * 100_000 + f"<p>{TEXT}</p>") == [TEXT]


def test_parts_beside_the_article():
    """A headline or a section that is not inside the article element belongs to it."""
    for tag in ("article", "main"):
        article = f"<{tag}><p>{TEXT}</p><p>{MORE}</p></{tag}>"
        links = "<div><a href=1>a linked line of the menu</a> and <a href=2>another of them</a></div>"
        assert main_blocks(f"<div><h1>Headline</h1>{article}{links}</div>") == ["Headline", TEXT, MORE]
        page = f"<body><div>{article}<section><h2>Later</h2><p>{MORE} And so on.</p></section>{links}</div>"
        assert main_blocks(page) == [TEXT, MORE, "Later", f"{MORE} And so on."]


def test_unnamed_reader_comments():
    """Known by their structure, whatever the class says."""
    one = "<{0}><b>Ann</b> <time>2 days ago</time><p>{1}</p><{2}>Reply</{2}></{0}>"
    for kind in ("discussion", "feedback", "x1"):
        for tag, reply in (("div", "button"), ("li", "p"), ("article", "div")):
            said = "".join(one.format(tag, f"{MORE} {n} {TEXT}", reply) for n in range(3))
            page = f"<div class=post><p>{TEXT}</p><p>{MORE}</p></div><div class={kind}><h3>3 voices</h3>{said}</div>"
            assert main_blocks(page) == [TEXT, MORE], (kind, tag)
    # An article about replies, and a single line, are no comments.
    page = f"<article><p>{TEXT}</p><p>Reply</p><p>{MORE}</p><p>Reply</p></article>"
    assert main_blocks(page) == [TEXT, "Reply", MORE, "Reply"]
