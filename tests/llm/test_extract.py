import html as html_lib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tabmine.llm import extract
from tabmine.llm.extract import extract_pages, main_text, match, parse, skeleton

SCHEMA = "page_id bigint, url string, html string"


def text_of(source):
    return main_text(parse(source), set())


@pytest.mark.parametrize(("source", "want"), [
    ("", ""),
    ("<p>a<p>b", "a\n\nb"),
    ("plain &amp; simple &lt;b&gt; &#233;", "plain & simple <b> é"),
    ("<nav>menu</nav><article><h1>T</h1><p>one <b>two</b>\n three<br>four</p></article><footer>f</footer>", "T\n\none two three four"),
    ("<body><header>site</header><article><header><h1>T</h1></header>x</article></body>", "T\n\nx"),
    ("<article>a<aside>b</aside>c<form>d</form>e</article>", "a\n\nc\n\ne"),
    ("<article><p>x</p></article><section class='comments'><article class='comment'>y</article></section>", "x"),
    ("<article><p>x</p><div class='comments'><p>y</p></div><div class=\"notice\">n</div></article>", "x"),
    ("<div class='sidebar'>s</div><div class='headline'>h</div><div class=ad>a</div>", "h"),
    ("<script>if (a<b) '</p>'</script><style>p{}</style><p>x</p>", "x"),
    ("<SCRIPT>no</SCRIPT><P>Yes</P>", "Yes"),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a\n\nb\n\nc\n\nd"),
    ("<main><p>m</p></main><p>out</p>", "m"),
    ("<!-- <article>no</article> --><article>yes</article>", "yes"),
    ("<article><p hidden>no</p><p style='display: none'>no</p><p>yes</p></article>", "yes"),
    ("<article>a < b and c > d", "a < b and c > d"),
    ("<article><p>a  b</p></article>", "a b"),
])
def test_main_text(source, want):
    assert text_of(source) == want


def brute(a, b):
    """Size of a simple tree matching, straight from its definition."""
    def build(flat):
        it = iter(flat)

        def node():
            tag, _, n = next(it)
            return tag, [node() for _ in range(n)]
        return node()

    def score(x, y):
        if x[0] != y[0]:
            return 0
        m = [[0] * (len(y[1]) + 1) for _ in range(len(x[1]) + 1)]
        for i, p in enumerate(x[1], 1):
            for j, q in enumerate(y[1], 1):
                m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + score(p, q))
        return m[-1][-1] + 1
    return score(build(a), build(b))


def test_tree_matching_is_largest():
    rng = random.Random(6)

    def random_tree(depth):
        if not depth:
            return "<i>t</i>"
        tag = rng.choice(["div", "section", "b"])
        return f"<{tag}>" + "".join(random_tree(depth - 1) for _ in range(rng.randrange(4))) + f"</{tag}>"

    for _ in range(150):
        a, b = (skeleton(parse(random_tree(4))) for _ in range(2))
        pairs = match(a, b)
        assert len(pairs) == brute(a, b) and len({x for x, _ in pairs}) == len({y for _, y in pairs}) == len(pairs)
        assert all(a[x][0] == b[y][0] for x, y in pairs)


def page(i, rng, paragraphs):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return (f"<html><body><div><span>Our site</span><span>Welcome back</span></div><div>{body}"
            f"<p>Sign up for our letter</p></div><div>All rights reserved</div></body></html>")


def test_constant_nodes_are_template(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for i in range(60):
        paragraphs = [f"story {i} part {k} {rng.random()}" for k in range(rng.randrange(1, 6))]
        rows.append((i, f"http://Host.example/{i}", page(i, rng, paragraphs)))
        want[i] = "\n\n".join(paragraphs)
    rows.append((100, "http://single.example/", "<div>All rights reserved</div><p>x</p>"))
    want[100] = "All rights reserved\n\nx"
    got = extract_pages(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_edges(spark):
    rows = [(1, None, None), (1, None, None), (None, "x", "<p>a"), (2, "http://h", "<div>" * 3000 + "deep"), (3, "http://h", "<p>" + "w " * 200_000),
            (4, "http://h", "<a" * 2000), (5, "http://h", "\"'<<>>&#xD800;&#0;&bogus;")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS host", "2 AS text", "3 AS _html")
    got = {(r.page_id, r.url): r.text for r in extract_pages(df).collect()}
    assert got[1, None] == "" and got[None, "x"] == "a" and got[2, "http://h"] == "deep" and len(got[3, "http://h"]) == 399_999
    assert extract_pages(df).count() == 7 and extract_pages(df.limit(0)).collect() == []


def test_whole_table(spark):
    """The generated pages hold one article each; its text is found by plain means."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in extract_pages(pages).collect()}
    for r in pages.select("page_id", F.col("html")).collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html_lib.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"<p>|</p>|</h1>", article)]
        assert got[r.page_id] == "\n\n".join(b for b in blocks if b)


def test_copies_count_as_one_page(spark):
    rng = random.Random(9)
    rows, want = [], {}
    for i in range(8):
        paragraphs = [f"story {i} part {k} {rng.random()}" for k in range(3)]
        rows.append((i, "http://h/", page(i, rng, paragraphs)))
        want[i] = "\n\n".join(paragraphs)
    for i in range(100, 400):                                   # the aligned page again, some under its own id
        rows.append((i if i % 3 else 0, "http://h/", rows[0][2]))
        want[i if i % 3 else 0] = want[0]
    got = extract_pages(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert len(got) == len(rows) and all(r.text == want[r.page_id] for r in got)


@pytest.mark.parametrize("source", ["<a" * 100_000, "<a " * 100_000 + ">", "<a \"" * 50_001 + ">", "<a '<b \"" * 40_000 + ">'", "<!x" * 100_000,
                                    "<!--" * 100_000, "<p " + "x" * 300_000 + ">t", "<p " + "x " * 100_000 + ">t", "<![CDATA[" * 50_000])
def test_time_is_linear_on_hostile_pages(source):
    t = time.time()
    root = parse(source)
    main_text(root, set())
    skeleton(root)
    assert time.time() - t < 5


def test_many_unclosed_tags_are_read_like_few():
    """The table of ends and the pattern agree: the same page with the switch early and late."""
    rng = random.Random(5)
    for _ in range(300):
        source = "".join(rng.choice(["<a", "<b c='d'>", "t>", "</b>", "<p x=\"y", "\"", "'", " ", "<!doctype x>", "<!x", "<br/>", "<!-- c -->", "w"])
                         for _ in range(rng.randrange(40)))
        seen = []
        for limit in (-1, 10**9):
            extract.FAILED_TAGS = limit
            seen.append(repr([scan for scan in _tags(source)]))
        extract.FAILED_TAGS = 16
        assert seen[0] == seen[1], source


def _tags(source):
    scanner, at = extract.Scanner(source), 0
    while (found := scanner.after(at)) is not None:
        yield found
        at = found[1]


def test_alignment_is_remembered_without_change():
    rng = random.Random(1)

    def page():
        return "<body><div>menu</div><article>" + "".join(f"<p>{rng.choice('abc')}</p>" for _ in range(rng.randrange(1, 6))) + "</article><i>end</i></body>"

    pages = [skeleton(parse(page())) for _ in range(200)]
    aligner = extract.Aligner(pages[0], most=20)
    assert all(aligner.match(p) == extract.match(pages[0], p) for p in pages)


LONG = "A long text of the article stands here and goes on. " * 6


@pytest.mark.parametrize("page", [
    f"<article class='h-entry related-story'><p>{LONG}</p></article>", f"<article class='post-with-comments'><p>{LONG}</p></article>",
    f"<article id='correlated'><p>{LONG}</p></article>", f"<main class='promoted'><p>{LONG}</p></main>",
    f"<article><div class='article-body social'><p>{LONG}</p></div></article>"])
def test_names_do_not_hide_the_article(page):
    assert main_text(parse(page), set()) == LONG.strip()


def test_parts_of_names():
    page = (f"<article><h2 class='section-header'>Head</h2><p>{LONG}</p><p class='share-price'>Price</p><div class='adContainer'>buy</div>"
            "<div class='share'>tell</div><section class='comments'><article class='comment'>me too</article></section></article>")
    assert main_text(parse(page), set()) == f"Head\n\n{LONG.strip()}\n\nPrice"
