"""Wrapper induction: parsing, alignment, and extracted texts against the pages' known articles."""

import re

import pytest
from labelloom.llm import html_extract as H

SF = "/root/testdata/sf0.01"


def plain_matching(left, right):
    """Largest number of order-keeping pairs of equal kinds, by trying all."""
    if not left or not right:
        return 0
    best = max(plain_matching(left[1:], right), plain_matching(left, right[1:]))
    if left[0][H.KIND] == right[0][H.KIND]:
        best = max(best, 1 + plain_matching(left[1:], right[1:]))
    return best


def leaf(kind):
    return [(kind, "", ""), 1, 0, 0, "h", []]


@pytest.mark.parametrize("left, right", [("abc", "abc"), ("abcab", "bca"), ("aab", "baa"), ("", "ab"), ("abab", "baba")])
def test_matching_is_the_largest(left, right):
    a, b = list(map(leaf, left)), list(map(leaf, right))
    pairs = H.matching(a, b)
    assert len(pairs) == plain_matching(a, b) and pairs == sorted(pairs)
    assert all(a[i][H.KIND] == b[j][H.KIND] for i, j in pairs)


def own_text(page):
    """The article of a page of the test tables, whose markup is known: no element but b, p, h1, br inside."""
    import html
    body = re.search(r"<article>(.*)</article>", page, re.S)[1]
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", body)).split())


def test_pages_of_the_tables(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = {r["page_id"]: r for r in H.main_text(pages).collect()}
    rows = pages.collect()
    assert len(found) == len(rows)
    for r in rows:
        got = found[r["page_id"]]
        assert got["text"] == own_text(r["html"]) and got["n_chars"] == len(got["text"]) and got["url"] == r["url"]


def page(body, top="Home News"):
    return f"<html><head><title>t</title><style>p{{}}</style></head><body><div id='top'><p>{top}</p></div>{body}</body></html>"


def test_template_nodes_go_without_a_marked_article(spark):
    body = "<div class=x><div class='text'><p>Story {0} &amp; more<p>Second   {0}</div><div class='line'>Same everywhere</div></div>"
    rows = [(i, f"http://host/{i}", page(body.format(f"no{i}"))) for i in range(6)]
    rows += [(90, None, None), (91, "http://host/x", ""), (92, "http://alone/", "<p>lonely <b>page</b>"), (0, "http://host/0", rows[0][2])]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'c' as host", "'w' as wrapper", "1 as text")
    found = H.main_text(table).collect()
    texts = {r["page_id"]: r["text"] for r in found}
    assert len(found) == len(rows) and texts[3] == "Story no3 & more Second no3"
    assert texts[90] == "" and texts[91] == "" and texts[92] == "lonely page"
    assert H.main_text(table.limit(0)).count() == 0


def test_constant_boxes_in_a_marked_article_go(spark):
    """Neutral names; an inline word of a running text, a rare node of copies and a host of copies stay."""
    body = ("<article><h1>Same title</h1><p>Story {0} <b>Note</b> on {0}<br>{0}</p><div class='k'>Join <b>our</b> list<p>Now</p></div>"
            "<p>Second {0}</p><span class='z'>By us</span>{1}</article>")
    quote = "<blockquote>Quoted once</blockquote>"
    rows = [(i, f"http://host/{i}", page(body.format(f"no{i}", ""))) for i in range(6)]
    rows += [(i, "http://host/copy", page(body.format("copy", quote))) for i in range(6, 16)]
    rows += [(i, f"http://copies/{i}", page(body.format("all", quote))) for i in range(20, 25)]
    found = {r["page_id"]: r["text"] for r in H.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert found[3] == "Same title Story no3 Note on no3 no3 Second no3"
    assert found[9] == "Same title Story copy Note on copy copy Second copy Quoted once"
    assert found[21] == "Same title Story all Note on all all Join our list Now Second all By us Quoted once"


def test_matching_weighs_all_levels():
    def node(kind, *children):
        return [(kind, "", ""), 1, 0, 0, "h", list(children), ["t"]]
    deep = node("a", node("b", node("c"), node("d"), node("e")))
    flat = node("a", node("b"))
    assert H.matching([flat, node("x"), deep], [deep]) == [(2, 0)] and H.matching([deep, node("x"), flat], [deep]) == [(0, 0)]


@pytest.mark.parametrize("markup, text", [
    ("<article><header><h1>T</h1></header><p>a<br>b</p><aside>x</aside><ul><li>1<li>2</ul></article>", "T a b 1 2"),
    ("<main><article>one</article><div class='comments'>no</div></main><footer>f</footer>", "one"),
    ("<article>A<div class='cookie-notice'>no</div><form>no</form><script>var a='</p>'</script>B</article>", "A B"),
    ("<article><p>x &lt;b&gt; &#233;&nbsp;y</p><!-- no --><p hidden>no</p></article>", "x <b> é y"),
    ("<article>in<b>li</b>ne<section id=comments>no</section></article><article>two</article>", "inline two"),
    ("<nav>n</nav><p>only <a href=x>body</a> text", "only body text"),
    ("<article><table><tr><td>c1<td>c2<tr><td>c3</table><pre> k  v </pre></article>", "c1 c2 c3 k v"),
    ("<![CDATA[a<b]]> tail </p></div> end", "a<b tail end"),
])
def test_kinds_and_markup(markup, text):
    assert H.extract(markup, H.layout(H.parse(markup))) == text


def test_merging_in_any_order_gives_the_same_template():
    made = [H.layout(H.parse(page(f"<div class=a><p>{i}</p></div><p>Same</p>"))) for i in range(8)]
    one = made[0]
    for w in made[1:]:
        one = H.merge(one, w)
    halves = [H.merge(H.merge(made[a], made[a + 1]), H.merge(made[a + 2], made[a + 3])) for a in (0, 4)]
    two = H.read(H.written(H.merge(*halves)))
    assert one == two and one[H.PAGES] == 8
