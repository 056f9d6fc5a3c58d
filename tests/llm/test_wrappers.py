"""HTML wrappers: alignment, odd markup, every page against its article's tags, odd rows."""

import html
import re

import pytest

from slotmill.llm import wrappers as w

SF = "/root/testdata/sf0.01"


def article(page):
    inner = re.search("<article>(.*)</article>", page, re.S)[1]
    parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", p.replace("<br>", " "))).split()) for p in re.split("</?(?:p|h1)>", inner)]
    return "\n\n".join(p for p in parts if p)


def test_all_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = w.op9_html_extraction(spark, SF).collect()
    assert len(found) == len(pages)
    for r in found:
        assert r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def text(page):
    return w.main_text(page, None)


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""), ("", ""), ("plain  text", "plain text"), ("a < b & c &lt;d&gt; &#233;&eacute;&amp", "a < b & c <d> éé&"),
        ("<p>one<p>two<li>three", "one\n\ntwo\n\nthree"),
        ("<div>a <b>bold</b> <a href='x>y'>c</a> text</div>", "a bold c text"),
        ("<nav>menu</nav><header>h</header><p>body</p><aside>s</aside><form>f</form><footer>f</footer>", "body"),
        ("<article><h1>T</h1><p>x<script>var a='<p>no</p>';</script>y</p><div class='share-box'>s</div><section id=comments><p>c</p></section></article>", "T\n\nxy"),
        ("<main><article><p>long enough text</p></article><div class='cookieNotice'>ok?</div></main><p>after</p>", "long enough text"),
        ("<style>p{}</style><!-- <p>no</p> --><p>yes</p><!-- open", "yes"),
        ("<div class='ad slot-1'>buy</div><p class='notice'>n</p><p>text\n\t more</p>", "text more"),
        ("<article><p>unclosed <b>bold<br><p>next</article><p>out", "unclosed bold\n\nnext"),
        ("<p>" + "<b>" * 3000 + "deep", "deep"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\n\nb\n\nc"),
        ('<div role="main"><p>m</p></div><p>x</p>', "m"),
        ("<p>x</p><script>never closed <p>y</p>", "x"),
    ],
)
def test_markup(page, want):
    assert text(page) == want


def stream(*paths):
    return [w.Item((p,), chars=5, fixed=f"{p}{n}") for n, p in enumerate(paths)]


def test_repeats_and_optional_groups():
    page = "<ul><li>a</li><li>b</li><li>c</li></ul><h2>t</h2><p>x</p><h2>u</h2><p>y</p><p>z</p>"
    items = w.items_of(w.blocks(page))
    assert [(i.paths, i.repeated) for i in items] == [(("ul/li",), True), (("h2", "p"), True), (("p",), False)]
    whole = w.aligned(w.aligned(stream("a", "b", "d"), stream("a", "c", "d")), stream("a", "b", "c", "d"))
    assert [i.paths[0] for i in whole if not i.optional] == ["a", "d"]
    assert [i.paths[0] for i in whole].count("c") == 1 and [i.paths[0] for i in whole].count("b") == 1
    assert all(i.pages == 3 for i in whole if not i.optional)
    assert w.aligned([], stream("a"))[0].optional


def test_fixed_text_and_menus_go_where_a_host_has_no_article(spark):
    page = "<div><a href=1>Home</a> <a href=2>News</a></div><p>Story {0} is told here at length.</p><div>Copyright of the site</div>"
    rows = [(i, "http://h.example/x", page.format("one two three four five six".split()[i])) for i in range(6)]
    rows += [(9, "https://user@H.example:80/y", page.format("nine")), (10, "http://other.example/", "<p>Copyright of the site</p>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for spread in (1, 5):
        got = {r.page_id: r.main_text for r in w.extracted(frame, spread=spread).collect()}
        assert got[9] == "Story nine is told here at length." and got[10] == "Copyright of the site"
        assert got[0] == "Story one is told here at length."


def test_odd_rows(spark):
    rows = [(1, None, None), (2, None, "<p>a</p>"), (2, None, "<p>a</p>"), (3, "", ""), (4, "not a url", "<article>" + "<p>x y</p>" * 30_000), (None, "http://e/", "z")]
    frame = spark.createDataFrame([(*r, "q", 1) for r in rows], "page_id long, url string, html string, Main_Text string, _host int")
    out = w.extracted(frame)
    assert sorted(out.columns) == ["_host", "html", "main_text", "page_id", "url"]
    got = sorted((str(r.page_id), r.main_text[:4]) for r in out.collect())
    assert got == [("1", ""), ("2", "a"), ("2", "a"), ("3", ""), ("4", "x y\n"), ("None", "z")]
    assert w.extracted(frame.filter("false")).collect() == []


def host_of_pages(page, n=6):
    """Pages of one host with its article: ``page`` filled with words of each page's own."""
    return [(i, f"http://h.example/{i}", page.format(*(f"{w}{'abcdef'[i % 6]}{i}" for w in ("first", "second", "third", "fourth")))) for i in range(n)]


def test_the_wrapper_decides_within_an_article(spark):
    page = (
        "<article><h1>{0}</h1><p>{1} is told.</p><div class='teaserline'>Read more of our stories</div><ul class='tools'><li>Print</li><li>Save</li></ul>"
        "<div class='alert'><p>{2} is in danger.</p></div><div class='share'>Share this page</div>"
        "<div class='related'><a href=1>{3}</a></div><div class='comments'><p>{3} I like it</p></div></article>"
    )
    rows = host_of_pages(page)
    copies = [(20 + i, f"http://copy.example/{i}", "<article><h1>Same</h1><p>Same text.</p></article>") for i in range(5)]
    frame = spark.createDataFrame(rows + copies, "page_id long, url string, html string")
    for spread in (1, 5):
        got = {r.page_id: r.main_text for r in w.extracted(frame, spread=spread).collect()}
        for i in range(6):
            c = f"{'abcdef'[i]}{i}"
            assert got[i] == f"first{c}\n\nsecond{c} is told.\n\nthird{c} is in danger."
        assert {got[20 + i] for i in range(5)} == {"Same\n\nSame text."}


@pytest.mark.parametrize(
    "page, want",
    [
        ("<div><datalist><option value='x'></datalist></div><article><p>whole</p></article>", "whole"),
        ("<div><svg width='1'/></div><article><p>whole</p><math/></article>", "whole"),
        ("<svg-icon name='a'></svg-icon><article><button-group>a</button-group><p>b</p><template-part></template-part><p>c</p></article>", "a\n\nb\n\nc"),
        ("<div><button>Open<div>x</div></div><p>body</p>", "body"),
        ("<option>a<option>b<article><p>whole</p></article>", "whole"),
        ("<button>Open<article><p>whole</p></article>", "whole"),
        ("<p>a <button>x</button> b <select><option>1<option>2</select> c <svg><svg></svg><p>d</p></svg> e</p>", "a b c e"),
        ("<p>a</p><template><article><p>no</p></article></template><p>b</p>", "a\n\nb"),
        ("<p>a</p><svg><title/><path/></svg><p>b</p>", "a\n\nb"),
        ("<ul><li><object>x</li><li>b</li></ul>", "b"),
    ],
)
def test_skipped_elements_end(page, want):
    assert text(page) == want


def texts_of(spark, pages, spread=5):
    rows = [(i, f"http://h.example/{i}", page) for i, page in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.main_text for r in w.extracted(frame, spread=spread).collect()}


@pytest.mark.parametrize("quoting", [2, 3, 5, 8])
def test_a_quote_that_some_articles_share_is_kept(spark, quoting):
    quote = "<blockquote>Nothing is built on stone, all is built on sand.</blockquote>"
    pages = [f"<article><h1>Title {i}</h1><p>Story {i} begins.</p>{quote if i < quoting else ''}<p>It ends {i}.</p></article>" for i in range(10)]
    for i, text in texts_of(spark, pages).items():
        assert ("built on sand" in text) == (i < quoting) and text.startswith(f"Title {i}\n\nStory {i} begins.") and text.endswith(f"It ends {i}.")


@pytest.mark.parametrize("count", [2, 5, 12])
def test_a_headline_that_all_articles_share_is_kept(spark, count):
    pages = [f"<article><h1>Weekly briefing</h1><p>News of week {i}.</p><div class='end'>Read on in our app</div></article>" for i in range(count)]
    for i, text in texts_of(spark, pages).items():
        line = "\n\nRead on in our app" if count < w.FIXED_PAGES else ""  # a template line, once there are pages enough to tell
        assert text == f"Weekly briefing\n\nNews of week {i}.{line}"


def test_text_that_half_of_the_pages_share_is_a_template_outside_articles(spark):
    pages = [f"<div>Home of news</div><p>Story {i} is told here.</p>" + ("<p>A line of some.</p>" if i < 4 else "") for i in range(10)]
    for i, text in texts_of(spark, pages).items():
        assert text == f"Story {i} is told here." + ("\n\nA line of some." if i < 4 else "")
