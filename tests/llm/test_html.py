import html
import re
import time

import pytest

from dockflow.llm import html_text as HT

from ..conftest import SF_CHECK


@pytest.fixture(scope="module")
def tree():
    return HT.trained()


L, M = HT._LONG, HT._MORE


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF_CHECK}/pages.parquet")
    got = {r["page_id"]: r for r in HT.extract(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", "", p.replace("<br>", " "))).split()) for p in re.split(r"</?(?:p|h1)>", article)]
        want = " ".join(p for p in parts if p)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want) and got[r["page_id"]]["url"] == r["url"]


@pytest.mark.parametrize(("page", "want"), [
    ("", ""), (None, ""), ("<script>x</script><style>p{}</style>", ""), ("<div class='comments'><p>" + L + "</p></div>", ""),
    (f"<article><p>{L}<p>a &amp; b &lt;i&gt; &copy;&nbsp;x<p>\n\t  c  \n d </article><footer>{M}</footer>", f"{L} a & b <i> © x c d"),
    (f"<ul class=menu><li><a href=1>A</a><li><a href=2>B</a></ul><main><h1>T</h1><p>Yes.<script>if (a<b) x='</p>'</script><p>{M}</main><aside>{L}</aside>", f"T Yes. {M}"),
    (f"<article><p>in<b>li</b>ne <a href=x>link</a>.</p><!-- <p>no</p> --><p>{L}", f"inline link. {L}"),
    (f"<body><header><h1>Site name here</h1></header><article><header><h1>Story</h1></header><p>{L}</p><form><input><p>{M}</p></form></article></body>", f"Story {L}"),
    (f"<article><p>{L}</p><div class='ad-slot'>Buy now</div><p>To.</p><section id='comments'><p>{M}</p></section></article>", f"{L} To."),
    (f"<article><p>1 < 2 and 3 > 2</p><p title=\"a>b\">{L}</p></article", f"1 < 2 and 3 > 2 {L}"),
])
def test_cases(tree, page, want):
    assert HT.main_text(page, tree) == want


@pytest.mark.parametrize("head", [
    '<body class="has-sidebar"><div>', '<html class="no-sidebar hidden"><body class="widget modal">', '<main class="no-sidebar">', '<div class="overflow-hidden">',
    '<div title="The hidden valley">', '<div data-hidden="false">', '<div data-id="share" data-role=nav>', "<div title='a class=ad id=menu'>",
    '<form id="aspnetForm">', '<div class="search widget">', '<header class="hidden">', '<div data-class=comments>'])
def test_containers_do_not_hide_the_article(tree, head):
    assert HT.main_text(f"{head}<article class='post tags'><h1>T</h1><p>{L}<p>{M}</article>", tree) == f"T {L} {M}"


@pytest.mark.parametrize("head", [
    '<div class="comments"><article class="comment">', "<div class=related-posts><article>", "<aside><article>", "<div hidden><article>", "<article hidden>",
    '<div style="display : none"><main>', '<div CLASS = "x cookie-notice">', "<div id=site-footer>", '<div class="post__comments">', "<nav><article>"])
def test_boilerplate_stays_out(tree, head):
    assert HT.main_text(f"<article><p>{L}</p></article>{head}<p>{M}</p>", tree) == L


def test_blocks_without_named_containers(tree):
    page = f"<p><a href=1>Home</a></p><p>{L}</p><p>Then nothing.</p><p>{M}</p><p><a href=2>Next page</a></p>"
    assert HT.main_text(page, tree) == f"{L} Then nothing. {M}"


def test_end_of_raw_elements_behind_letters_that_grow(tree):
    i = "\u0130" * 40
    page = f"<title>{i}</title><article><p>{i} {L}</p><SCRIPT>if (a</scripts) x</Script ><p>To.</p><style>p</STYLE><p>{M}</p></article>"
    assert HT.main_text(page, tree) == f"{i} {L} To. {M}"


@pytest.mark.parametrize(("inner", "want"), [
    ("Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be.", "Let x=2 be."),
    ("<math><semantics><mi>y</mi><annotation encoding=tex>\\\\y</annotation></semantics></math> here", "y here"),
    ("See <object data=a.svg><param name=x>the map</object> now.", "See the map now."), ("Press <button type=button>OK</button> twice.", "Press OK twice."),
    ("Pie <svg><title>t</title><text>no</text></svg> chart", "Pie chart"), ("a <svg><path d=x> lost", "a"), ("a <select><option>no<option>no", "a"),
    ("a <math><mi>x", "a x"), ("a <button>b", "a b"), ("a <object data=x>c", "a c"), ("a <noscript>no", "a"), ("a <svg/> b", "a b")])
def test_inline_elements_and_unclosed_ones(tree, inner, want):
    assert HT.main_text(f"<article><p>{inner}</p><p>{L}</p><h2>Next</h2><p>{M}</article><nav><svg></svg></nav>", tree) == f"{want} {L} Next {M}"


def test_tree_separates_the_labelled_table(tree):
    right = total = 0
    for page in HT.LABELLED_PAGES:
        bs = HT.blocks(page)
        right += sum((p >= 0.5) == b.label for p, b in zip(tree.predict(HT.features(bs)), bs, strict=True))
        total += len(bs)
    assert right >= 0.93 * total and total > 60


@pytest.mark.parametrize("page", [
    lambda n: "<div>a " * n,
    lambda n: "<b>" * n + "x</i> " * n,
    lambda n: "<p><div>" + "<b>" * n + "<h1>y</h1>" * n,
    lambda n: "<li><ul>" + "<i>" * n + "<li>z</li>" * n,
    lambda n: "<a href=x>" + "<span>w " * n + "</span>" * n])
def test_time_grows_with_the_page_not_with_its_depth(page):
    def seconds(n):
        best = 9e9
        for _ in range(3):
            t = time.process_time()
            HT.blocks(page(n))
            best = min(best, time.process_time() - t)
        return best
    assert seconds(24_000) < 9 * seconds(6_000) + 0.05  # four times the page; a walk over the open elements takes 16 times as long


def test_edges(spark, tree):
    big = "<article>" + "".join(f"<p>Paragraph {i} of a very long page.</p>" for i in range(20_000)) + "</article>"
    rows = [(1, "u", None), (1, "u", f"<p>{L}</p>"), (None, None, f"<p>{L}</p>"), (2, "u", big), (3, "u", "<" * 500 + "p>" * 500), (4, "u", "<a title='x" * 300)]
    got = HT.extract(spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, text string")).collect()
    assert sorted(((r["page_id"], r["n_chars"]) for r in got), key=repr)[:3] and len(got) == len(rows)
    assert {r["text"] for r in got if r["page_id"] is None} == {L} and {r["text"] for r in got if r["page_id"] == 1} == {"", L}
    assert next(r["text"] for r in got if r["page_id"] == 2).count("Paragraph") == 20_000
    assert HT.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
