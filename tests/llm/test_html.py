from funnelspark.llm import html_text
from funnelspark.llm.html_tree import match_trees, parse

from .helpers import SF_SMALL

SCHEMA = "page_id long, url string, html string"


def page(i, body, extra=""):
    return (f"<html><head><title>t{i}</title><script>var a = '<p>no</p>';</script></head><body class='has-sidebar'>"
            f"<div id=top><a href=/>Home</a> Site name</div><div class='ad'>buy {i}</div>"
            f"<div><div><h2>Title {i}</h2>{body}<p>Share this story</p></div></div>"
            f"<div class=comments><p>reader {i} says</p></div>{extra}"
            f"<div>All rights reserved</div></body></html>")


def test_wrapper_finds_the_slot_that_varies(spark):
    pages = [(i, "http://A.example/x", page(i, f"<p>First {i} text<p>second&nbsp;&amp;  {i * 7}"))
             for i in range(12)]
    got = {r.page_id: r for r in html_text.extract(spark.createDataFrame(pages, SCHEMA)).collect()}
    assert got[3].text == "Title 3 First 3 text second & 21"
    assert all(r.text == f"Title {i} First {i} text second & {i * 7}" for i, r in got.items())
    assert got[3].n_chars == len(got[3].text)


def test_pages_without_the_template_paragraph_keep_their_own():
    def body(i, share):
        return (f"<div>Site</div><div><div>{share}<p>First of {i}</p><p>Second of {i}</p></div></div>"
                "<div>All rights reserved</div>")
    pages = [body(i, "" if i >= 37 else "<p>Share this story</p>") for i in range(40)]
    pages[36] = body(36, "<p>Share this story<b> of 36</b></p>")
    got = html_text.main_texts(pages)
    want = [f"First of {i} Second of {i}" for i in range(40)]
    want[36] = "Share this story of 36 " + want[36]
    assert got == want


def test_template_blocks_with_inline_children_are_left_out():
    def body(i, name="here"):
        return (f"<div>Site</div><div><div><p>Sign up for our <i>list</i> <a>{name}</a></p><p>First of {i}</p>"
                f"<div><p>By <b>the desk</b></p><p>Call us</p></div><p>Seen <b>{i}</b></p></div></div>"
                "<div>All rights reserved</div>")
    pages = [body(i) for i in range(20)] + [body(20, "for 20")]
    got = html_text.main_texts(pages)
    assert got[:20] == [f"First of {i} Seen {i}" for i in range(20)]
    assert got[20] == "Sign up for our list for 20 First of 20 Seen 20"


def test_marked_articles(spark):
    text = ("<!doctype html><nav>menu</nav><article><h1>Head</h1><p><b>Bold<br>next<p>two <i>i</i>n"
            "<aside>side</aside><form>f</form><div class='cookie-notice'>c</div><ul><li>x<li>y</ul></article>"
            "<footer>f</footer>")
    rows = [(1, "http://h/1", text), (2, None, None), (3, "http://h/2", ""), (4, "nohost", "just text"),
            (None, "http://z/", "<p>a<script>x</script>b &lt;c&gt;"), (5, "http://h/3", "<nav>only menu</nav>"),
            (1, "http://h/1", text)]
    got = [tuple(r) for r in html_text.extract(spark.createDataFrame(
        [(*r, "x") for r in rows], SCHEMA + ", host string")).collect()]
    key = lambda r: tuple(str(x) for x in r)
    head = "Head Bold next two in x y"
    want = [(1, "http://h/1", head, len(head)), (2, None, "", 0), (3, "http://h/2", "", 0),
            (4, "nohost", "just text", 9), (None, "http://z/", "ab <c>", 6), (5, "http://h/3", "", 0),
            (1, "http://h/1", head, len(head))]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert html_text.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_names_of_article_sections_are_no_marks():
    text = ("<article><h2 id='social-impact'>Social</h2><section id='related-work'><p>Related</p></section>"
            "<h2 id='reply-of-the-court'>Reply</h2><h3 id=share>Share</h3><p class='no-sidebar'>Aside</p>"
            "<div class='box shareBar'>s</div><div id='cookie-box'>c</div><div class='post-comments-area'>r</div>"
            "<div class='ad-3'>a</div><div class='related'>t</div><div id='newsletter-signup'>n</div></article>")
    assert html_text.main_texts([text]) == ["Social Related Reply Share Aside"]
    pages = [f"<div>Site</div><div class='has-sidebar'><div id=hidden-costs><p id='notice-{i}-of-death'>Hidden {i}</p>"
             f"<div class=ads>buy {i}</div></div></div><div>All rights</div>" for i in range(12)]
    assert html_text.main_texts(pages) == [f"Hidden {i}" for i in range(12)]


def test_copies_and_large_hosts_in_slices(spark):
    same = page(1, "<p>the same article on every page</p>")
    pages = [(i, "http://copies.example/", same) for i in range(1000)]
    got = html_text.extract(spark.createDataFrame(pages, SCHEMA)).collect()
    assert len(got) == 1000 and all("the same article" in r.text for r in got)


def test_query_gives_the_article_of_every_page(spark):
    import html
    import re

    from funnelspark.llm import queries
    want = {}
    for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect():
        part = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        part = re.sub("<[^>]*>", "", re.sub("</?(?:p|h1|br)>", " ", part))
        want[r.page_id] = " ".join(html.unescape(part).split())
    got = queries.QUERIES["op4_html_text"](spark, SF_SMALL).collect()
    assert {r.page_id: r.text for r in got} == want


def brute_weight(a, b):
    """Simple tree matching by its definition."""
    if a.tag != b.tag:
        return 0
    x, y = a.children(), b.children()
    m = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(1, len(x) + 1):
        for j in range(1, len(y) + 1):
            m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + brute_weight(x[i - 1], y[j - 1]))
    return 1 + m[-1][-1]


def test_matching_is_maximal_and_keeps_order():
    import random
    rng = random.Random(5)

    def tree(depth):
        tag = rng.choice(["div", "span", "b"])
        return f"<{tag}>" + "".join(tree(depth - 1) for _ in range(rng.randint(0, 3) if depth else 0)) + f"</{tag}>"
    for _ in range(200):
        a, b = parse(tree(3)), parse(tree(3))
        assert len(match_trees(a, b)) == brute_weight(a, b)


def test_long_child_lists_are_matched_by_the_definition():
    import random
    rng = random.Random(7)

    def blocks(n):
        return "".join(rng.choice(["<p>a<b>b</b></p>", "<p><i>c</i><b>d</b></p>", "<div><p>e</p></div>", "<hr>",
                                   "<ul><li>f<li>g<b>h</b></ul>"]) for _ in range(n))
    a = blocks(230)
    for b in (blocks(260), "<ul><li>new</ul>" + a, a + "<div><b>x</b></div>"):
        x, y = parse(f"<div><b>s</b>{a}</div>"), parse(f"<div>{b}</div>")
        assert len(match_trees(x, y)) == brute_weight(x, y)


def test_template_behind_a_shift_of_a_long_page():
    def body(i):
        new = f"<ul><li>News <b>{i}</b></ul>" if i % 2 else ""
        rows = "".join(f"<p>Text <b>{i}</b> of {k}</p>" for k in range(230))
        return f"<div>Site</div><div><div>{new}{rows}<div><p>Call <b>us</b></p></div></div></div><div>All rights</div>"
    for i, got in enumerate(html_text.main_texts([body(i) for i in range(12)])):
        assert "Call" not in got and got.endswith(f"Text {i} of 229") and got.count("Text") == 230


def test_tolerant_parsing():
    deep = "<div>" * 5000 + "deep" + "</div>" * 10
    assert html_text.text_of(parse(deep)) == "deep"
    assert html_text.text_of(parse("a < b <p title='x>y'>c</q>d <!-- no --> e <!-- open")) == "a < b cd e"
    assert html_text.text_of(parse("<table><tr><td>1<td>2<tr><td>3</table>4")) == "1 2 3 4"
