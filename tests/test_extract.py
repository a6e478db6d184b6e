"""Page parsing and extraction on written pages."""

import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pressroom.operators import dom, extract, quality
from pressroom.plans.jobs import crawl_articles
from pressroom.sources.config import LEGACY_SELECTORS, builtin_rules, builtin_sources, rules_table

LONG = "This sentence is repeated until the paragraph is long enough to count as content. "

NEWS = f"""<!doctype html><html><head><meta property="article:published_time" content=" 2024-05-17T21:45:10+07:00 ">
<meta property="og:image" content="https://img.example/t.jpg"><link rel="alternate canonical" href="https://vnexpress.net/x.html"></head>
<body><h1 class="title-detail big">Tiêu&nbsp;đề   chính</h1><span class="author_mail">An  Nguyen</span>
<div class="fck_detail"><p>First <b>bold</b> part.</p><p> </p><p>Second part.</p>
<div class="list-news-related"><p>Related one</p></div><p>{LONG * 3}</p></div></body></html>"""


@pytest.fixture(scope="module")
def parse(spark):
    def run(html, selectors=None, rule_set="vnexpress", **options):
        rules = rules_table(spark, {rule_set: selectors}) if selectors is not None else builtin_rules(spark)
        pages = spark.createDataFrame([(html, rule_set)], "html string, rule_set string")
        return extract.extract_articles(pages, rules, **options).first()

    return run


def test_configured_source(parse):
    a = parse(NEWS)
    assert (a.title, a.author, a.published_at) == ("Tiêu đề chính", "An Nguyen", "2024-05-17T21:45:10+07:00")
    assert a.thumbnail_url == "https://img.example/t.jpg" and a.canonical_url == "https://vnexpress.net/x.html"
    assert a.content.split("\n\n")[:2] == ["First bold part.", "Second part."] and "Related" not in a.content
    assert a.paragraph_count == 3 and a.quality_flags == []


def test_missing_fields_are_flagged(parse):
    a = parse('<h1 class="title-detail">T</h1><div class="fck_detail"><p>Short.</p></div>')
    assert a.author is None and a.content == "Short."
    assert a.quality_flags == ["missing_author", "missing_published_at", "short_content"]


def test_page_without_body(parse):
    a = parse("<html><head><title>One moment</title></head><body><p>Please wait while we look.</p></body></html>")
    # any text of the page counts; that it is no article is what the flags and the validation say
    assert a.content == "Please wait while we look." and a.quality_flags == ["missing_title", "missing_author", "missing_published_at", "short_content"]


@pytest.mark.parametrize("n, flagged", [(149, True), (150, False)])
def test_short_content_limit(parse, n, flagged):
    assert ("short_content" in parse(f"<article><p>{'x' * n}</p></article>").quality_flags) == flagged


def jsonld(*documents):
    return "<html><head>" + "".join(
        f'<script type="application/ld+json">{d if isinstance(d, str) else json.dumps(d)}</script>' for d in documents) + "</head><body></body></html>"


ITEM = {"@type": "NewsArticle", "headline": "H", "datePublished": "2024-01-01", "image": {"url": "i.jpg"}, "author": {"name": "A"}}


JSONLD_CASES = [
    ([ITEM], "H", "A", "i.jpg"),
    ([[{"@type": "WebPage", "headline": "no"}, ITEM]], "H", "A", "i.jpg"),
    ([{"@graph": [ITEM], "headline": "no"}], "H", "A", "i.jpg"),
    (["{broken", ITEM], "H", "A", "i.jpg"),
    ([{**ITEM, "@type": ["NewsArticle"]}], None, None, None),
    ([{**ITEM, "author": [{"name": "B"}, {"name": "C"}], "image": ["a.jpg", "b.jpg"]}], "H", "B", "a.jpg"),
    ([{**ITEM, "author": ["D"], "image": [{"url": "x"}]}], "H", "D", None),
    ([{"@type": "Article", "author": "E"}, ITEM], "H", "E", "i.jpg"),
    ([{**ITEM, "headline": 5, "author": ""}], None, None, "i.jpg"),
    ([{**ITEM, "@type": "ReportageReport"}], "H", "A", "i.jpg"),
    (["17"], None, None, None),
]


def test_jsonld_shapes(spark):
    pages = spark.createDataFrame([(i, jsonld(*c[0])) for i, c in enumerate(JSONLD_CASES)], "i int, html string").withColumn("rule_set", F.lit("vnexpress"))
    got = extract.extract_articles(pages, builtin_rules(spark)).orderBy("i").collect()
    assert [(r.title, r.author, r.thumbnail_url) for r in got] == [c[1:] for c in JSONLD_CASES]


def test_selector_beats_jsonld_and_jsonld_survives_stripping(parse):
    a = parse(jsonld(ITEM).replace("<body>", "<body><h1>Page</h1>"))
    assert (a.title, a.author) == ("Page", "A")


def test_attribute_of_first_match_only(parse):
    html = '<img class="t"><img class="t" src="b.jpg"><a href="u@v" title="x">y</a>'
    assert parse(html, {"thumbnail_url": ["img.t@src"]}).thumbnail_url is None
    assert parse(html, {"thumbnail_url": ["img.t@src", "a@href"]}).thumbnail_url == "u@v"


SELECTORS = {
    "div.a.b p": "two", "#m": "one two", "[data-x]": "three", "[data-x='1']": "three", '[data-x="2"]': None, "section span": "deep",
    "SECTION SPAN": "deep", "div p": "one", "p.none": None, "section div span": None, "i[data-x=1]": "three", "*": "one two three deep",
}


def test_selector_grammar(spark):
    html = ('<html><div id="m"><p>one</p><div class="b x a"><p>two</p></div></div><i data-x="1">three</i>'
            '<section><p><span>deep</span></p></section></html>')
    rules = rules_table(spark, {f"r{i}": {"title": [s]} for i, s in enumerate(SELECTORS)})
    pages = spark.createDataFrame([(i, f"r{i}", html) for i in range(len(SELECTORS))], "i int, rule_set string, html string")
    got = extract.extract_articles(pages, rules).orderBy("i").collect()
    assert {s: r.title for s, r in zip(SELECTORS, got)} == SELECTORS


def test_most_paragraphs_win_and_first_wins_ties(parse):
    html = '<div class="a"><p>1</p><p></p></div><div class="b"><p>3</p></div><div class="c"><p>5</p><p>6</p></div>'
    assert parse(html, {"content_paragraphs": [".b p", ".a p", ".c p"]}).content == "1"
    assert parse(html, {"content_paragraphs": [".b p", ".c p", ".a p"]}).content == "5\n\n6"


def test_stripping_happens_after_titles_and_before_content_and_canonical(parse):
    html = '<div class="ad"><h1>In ad</h1><link rel="canonical" href="c"><article><p>gone</p></article></div><article><p>kept <i class="ad">not</i> this</p></article>'
    a = parse(html, {"title": ["h1"], "content_paragraphs": ["article p"], "strip": [".ad"]})
    assert (a.title, a.content, a.canonical_url) == ("In ad", "kept this", None)


def test_main_text_takes_the_dense_container(parse):
    html = (f'<body><nav><a href="/">Home</a> <a href="/x">{LONG}</a></nav><div id="side"><ul><li><a href="/1">One</a></li></ul></div>'
            f'<div id="main"><div>{LONG * 2}</div><div>Second {LONG}</div></div><footer>{LONG * 5}</footer></body>')
    a = parse(html, {"content_paragraphs": ["p"]})
    assert a.content == " ".join([(LONG * 2).strip(), ("Second " + LONG).strip()]) and "\n" not in a.content
    assert a.paragraph_count == 0


def test_legacy_rules(parse):
    html = '<head><title>From title</title></head><time datetime="2024">Monday</time><div class="content_detail"><script>x</script><p>a</p></div>'
    a = parse(html, LEGACY_SELECTORS, use_jsonld=False, use_main_text=False)
    assert (a.title, a.published_at, a.content) == ("From title", "Monday", "a")


def test_html_without_end_tags(spark):
    html = '<p>a<p>b<b>c<p>d<ul><li>1<li>2</ul><table><tr><td>x<td>y<tr><td>z</table><script>var s = "</p><p>";</script><br>&amp;e'
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    nodes = [r.asDict() for r in dom.page_nodes(pages).orderBy("node_id").collect()]
    count = lambda tag: sum(n["tag"] == tag for n in nodes)
    assert (count("p"), count("li"), count("tr"), count("td"), count("b")) == (3, 2, 2, 3, 1)
    by_text = {n["text"]: n for n in nodes if n["text"]}
    tag_of = {n["node_id"]: n["tag"] for n in nodes}
    assert tag_of[by_text["d"]["parent_id"]] == "p" and by_text['var s = "</p><p>";']["tag"] == dom.CODE
    assert by_text["&e"]["parent_id"] is None
    assert all(n["node_id"] <= n["last_id"] for n in nodes)


def test_blank_pages_pass_through(spark):
    pages = spark.createDataFrame([(1, None), (2, ""), (3, " \n")], "page_id int, html string").withColumn("rule_set", F.lit("vnexpress"))
    out = extract.extract_articles(pages, builtin_rules(spark)).collect()
    assert sorted(r.page_id for r in out) == [1, 2, 3] and all(r.content is None for r in out)


def test_crawl_statuses(spark):
    pages = spark.createDataFrame(
        [("https://vnexpress.net/1.html", NEWS, 404, None, None), ("https://e.vnexpress.net/2.html", " ", 200, None, None),
         ("https://a.org/3", "<p>x</p>", 200, None, None), ("https://a.org/4", None, None, "timeout", "slow"),
         ("https://a.org/5", None, None, "blocked", "no"), ("https://a.org/6", None, None, "dns", "?")],
        "url string, html string, http_status int, error_kind string, error string")
    rows = {r.url.removesuffix(".html")[-1]: r for r in crawl_articles(pages, builtin_sources(spark), builtin_rules(spark)).collect()}
    assert {k: r.status for k, r in rows.items()} == {
        "1": "SUCCESS", "2": "EMPTY_HTML", "3": "CONTENT_NOT_FOUND", "4": "TIMEOUT", "5": "BLOCKED", "6": "UNKNOWN_ERROR"}
    assert (rows["1"].source_name, rows["1"].rule_set, rows["1"].source_id, rows["1"].error_message) == ("vnexpress", "vnexpress", 1, None)
    assert rows["2"].error_message == quality.EMPTY_HTML_ERROR and rows["2"].rule_set == "vnexpress"
    assert rows["3"].error_message == quality.NO_CONTENT_ERROR
    assert rows["4"].error_message == "slow" and (rows["3"].source_name, rows["3"].source_id) == ("a", 999)


def test_result_does_not_depend_on_partitioning(spark):
    pages = spark.createDataFrame([(i, NEWS.replace("Second", f"Second {i}")) for i in range(20)], "page_id int, html string").withColumn(
        "rule_set", F.concat(F.lit("vnexpress"), F.substring("html", 1, 0)))
    one = extract.extract_articles(pages.coalesce(1), builtin_rules(spark)).orderBy("page_id").collect()
    many = extract.extract_articles(pages.repartition(8), builtin_rules(spark)).orderBy("page_id").collect()
    assert one == many


def texts_and_tags(spark, html):
    nodes = dom.page_nodes(spark.createDataFrame([(1, html)], "page_id int, html string")).orderBy("node_id").collect()
    return [(n.tag, n.text, dict(n.attrs)) for n in nodes]


def test_markup_corner_cases(spark):
    html = ('<title>a <b> &amp; c</title>a &lt b < c<IMG SRC="x>y" data-n=1 data-n=2 Alt=\'q"q\'/><!-- <p> --><a href=u/v?w=1&amp;z>k</a>'
            "<i title=it's>e</i><?php x ?></none><textarea><p>&lt;</textarea><script>a < b && '</p>'</script><p hid")
    assert texts_and_tags(spark, html) == [
        ("title", None, {}), ("#text", "a <b> & c", {}), ("#text", "a < b < c", {}), ("img", None, {"src": "x>y", "data-n": "1", "alt": 'q"q'}),
        ("a", None, {"href": "u/v?w=1&z"}), ("#text", "k", {}), ("i", None, {"title": "it's"}), ("#text", "e", {}),
        ("textarea", None, {}), ("#text", "<p><", {}), ("script", None, {}), ("#code", "a < b && '</p>'", {})]


@pytest.mark.parametrize("piece, times", [('<a x="', 20000), ("<", 50000), ("<!--", 20000), ("<div>", 20000), ("<p><b>", 10000), ("<script>", 5000), ("<a b='", 20000)])
def test_hostile_pages_take_linear_time(piece, times):
    import time

    import pyarrow as pa

    start = time.perf_counter()
    dom._tokenize(pa.array([piece * times]))
    assert time.perf_counter() - start < 3


def test_custom_parser(spark):
    def parser(batches):
        for batch in batches:
            yield batch.assign(title=batch["html"].str.upper(), author=None, published_at=None, content=batch["html"], thumbnail_url=None,
                               canonical_url=None, quality_flags=[["custom"]] * len(batch))[
                ["url", "title", "author", "published_at", "content", "thumbnail_url", "canonical_url", "quality_flags"]]

    pages = spark.createDataFrame([("u1", "a"), ("u2", "b")], "url string, html string")
    got = extract.custom_articles(pages, parser).orderBy("url").collect()
    assert [(r.url, r.title, r.quality_flags) for r in got] == [("u1", "A", ["custom"]), ("u2", "B", ["custom"])]


def test_pages_are_taken_apart_a_piece_at_a_time(spark):
    page = "<html><body>" + "<p class=x>some text</p>" * 200 + "</body></html>"
    pages = [None, "", page, "<p>" + "y" * (2 * dom.PIECE), page, None, *[page] * 80, ""]
    pieces = list(dom._tokenized(iter([pa.array(pages), pa.array([], pa.string()), pa.array([page])])))
    assert sum(map(len, pieces)) == len(pages) + 1
    nodes = [len(p.field("nodes").flatten()) for p in pieces]
    assert len(nodes) > 3 and max(nodes) <= dom.PIECE // 10
    assert pa.concat_arrays(pieces[:-1]).to_pylist() == dom._tokenize(pa.array(pages)).to_pylist()
    # what goes to a task's Python at once is bounded in bytes, and rows still get their own page
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(name)
    found = spark.createDataFrame(list(enumerate(pages)), "i int, html string").repartition(2).select("i", dom.parse_page("html").alias("page"))
    assert int(spark.conf.get(name)) <= 4 << 20
    counted = {r.i: r.n for r in found.where("page is not null").select("i", F.size("page.nodes").alias("n")).collect()}
    assert counted == {i: len(dom._tokenize(pa.array([p]))[0].as_py()["nodes"]) for i, p in enumerate(pages) if p is not None}
