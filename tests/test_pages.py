"""Cards and posting pages, with everything that may be missing."""

import time

import pytest
from pyspark.sql import functions as F

from wagegrid import fixed_values
from wagegrid.functions import markup, page_parser
from wagegrid.operators import pages

CARD = (
    '<section data-tn-component="organicJob"><p>no fields here</p></section>'
    '<div data-tn-component="organicJob"><nobr>$48,250 a year</nobr>'
    '<ul><li><span class="summary">Keeps books</span><li><span class="company">Hill &amp; Co</span></ul>'
    '<a data-tn-element="jobTitle" id="k__77">Book keeper</a><a id="k__88">more</a></div>'
)
FULL = """
<div class="row result last"><a id="sja123" class="jobtitle">Data Scientist</a>
<span class="company">Acme</span><span class="location">New York,
 NY 10001</span><span class="no-wrap"> $80,000 a year </span>
<span class="summary">Models</span></div>
"""
POSTING = """<html><head><meta id="indeed-share-url" content="https://x/viewjob?a=1&jk=abc">
<meta itemprop="ratingValue" content="3.5"/><meta itemprop="ratingCount" content="12"/></head><body>
<div class="jobsearch-JobInfoHeader-title-container"><h3> Analyst </h3></div>
<a class="jobsearch-CompanyAvatar-companyLink" href="/c">Acme</a>
<div class="jobsearch-jobDescriptionText"><div>We &lt;3 data<br><ul><li>One<li>Two</ul></div>
<!-- note --><script>var a = "</div>";</script></div><p>after</p></body></html>"""


@pytest.fixture
def captured(spark):
    rows = [(1, f"<html><body>{CARD}{FULL}</body></html>"), (2, "<p>no card</p>"), (3, None)]
    return spark.createDataFrame(rows, "page_id long, html string")


def test_cards(captured):
    cards = pages.card_fields(pages.explode_cards(captured)).orderBy("card_no").collect()
    assert [r.page_id for r in cards] == [1, 1]
    first, second = cards
    assert first.title == "Book keeper"
    assert first.company == "Hill & Co"
    assert first.location is None
    assert first.salary == "$48,250 a year"
    assert first.synopsis == "Keeps books"
    assert first.job_id == "77"
    assert second.title == "Data Scientist"
    assert second.location == "New York, NY 10001"
    assert second.salary == "$80,000 a year"
    assert second.job_id == "123"


def test_search_rows(spark, captured):
    grid = captured.withColumns(
        {"search_title": F.lit("data+scientist"), "search_location": F.lit("Austin")}
    )
    rows = pages.search_rows(grid, F.lit("2024-01-01 10:11:12").cast("timestamp")).collect()
    assert len(rows) == 2
    assert {str(r.search_datetime) for r in rows} == {"2024-01-01 10:11:00"}
    none = pages.search_rows(grid.limit(0), F.current_timestamp())
    assert none.count() == 0 and none.columns == rows[0].__fields__


def test_posting(spark):
    rows = [(1, POSTING), (2, "<html><body><p>gone</p></body></html>"), (3, "")]
    details = pages.detail_fields(spark.createDataFrame(rows, "page_id long, html string"))
    found = {r.page_id: r for r in details.collect()}
    one = found[1]
    assert (one.job_id, one.desc_title, one.desc_company) == ("abc", "Analyst", "Acme")
    assert (one.company_rating, one.company_rating_count) == (3.5, 12)
    assert one.job_desc.startswith('<div class="jobsearch-jobDescriptionText"><div>We &lt;3 data')
    assert one.job_desc.endswith("</div>") and "after" not in one.job_desc
    assert "<li>One" in one.job_desc and "<!-- note -->" in one.job_desc
    two = found[2]
    assert (two.job_id, two.desc_title, two.company_rating, two.company_rating_count) == (
        None, None, 0.0, 0,
    )
    assert {r.page_id for r in pages.rejects(details).collect()} == {2, 3}


def test_fields_are_read_once_per_page(captured):
    plan = pages.card_fields(pages.explode_cards(captured))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert physical.count("ArrowEvalPython [") == 1


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p>a</p><!-- <b>no</b> --><script>x < 1</script>b &amp;&eacute;&#39;", "ab &é'"),
        ('<a title="x > y">in</a> 1 < 2', "in 1 < 2"),
        ("<!DOCTYPE html><style>p{}</style>  ", ""),
        ("&lt;b&gt;", "<b>"),
        (None, None),
    ],
)
def test_strip_tags(spark, html, text):
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(markup.strip_tags("html")).first()[0] == text


def test_list_items(spark):
    html = "<ul><li>One <b>x</b></li><LI class='a'>Two<li>Three</ul>rest<p>P1<p>P2</p><pre>no</pre>"
    df = spark.createDataFrame([(1, html), (2, "none"), (3, None)], "page_id long, html string")
    li = pages.list_items(df, "li").orderBy("item_no").collect()
    assert [(r.item_no, r.item) for r in li] == [(0, "One x"), (1, "Two"), (2, "Three")]
    assert [r.item for r in pages.list_items(df, "p").orderBy("item_no").collect()] == ["P1", "P2"]


def test_links(spark):
    df = spark.createDataFrame([("https://h.org/v?jk=12&x=1",), ("no url",)], "u string")
    got = df.select(
        markup.url_host("u"), markup.url_parameter("u", "jk"), markup.after_last_equals("u"),
        markup.posting_url(F.lit("12")),
    ).collect()
    assert tuple(got[0]) == ("h.org", "12", "1", "https://www.indeed.com/viewjob?jk=12")
    assert got[1][2] == "no url"


def test_native_first_matches(spark):
    df = spark.createDataFrame([('<a id="x">l</a><nobr>$5</nobr><a href="/q">m</a>',)], "h string")
    row = df.select(
        markup.first_element("h", "nobr"), markup.first_attribute("h", "a", "href"),
        markup.first_element("h", "em"), markup.first_attribute("h", "a", "title"),
    ).first()
    assert tuple(row) == ("$5", "/q", None, None)


def test_awkward_markup_is_read_in_time(spark):
    odd = ['<a href="x>t</a>' + "<p>short</p>" * 20_000, "<a" + ' x="y"' * 20_000 + ">t</a>", '<p title="a>b">c</p>']
    df = spark.createDataFrame(list(enumerate(odd)), "page_id int, html string")
    texts = [r[0] for r in df.orderBy("page_id").select(markup.strip_tags("html")).collect()]
    assert texts == ["t" + "short" * 20_000, "t", "c"]
    assert df.select(markup.list_items("html", "p").alias("v")).where("page_id = 0").first().v[0] == "short"


@pytest.mark.parametrize("page", ["<b>" * 20_000 + "</i>" * 20_000, '<div class="result"><a id="abc1">x</a>' * 5_000])
def test_unclosed_elements_are_read_in_time(page):
    walk = page_parser._Walk([("div", "class", "result")], {"link": ("a", None, None, "text"), "none": ("h6", None, None, "text")})
    began = time.perf_counter()
    walk.feed(page)
    found = walk.finish()
    assert time.perf_counter() - began < 10
    assert [r["link"] for r in found] == ["x"] * page.count("result")


def test_open_cards_are_read_once():
    """Cards that are never closed: time and output grow with the page, not with its square."""
    page = '<div class="result"><span class="summary">word <b>' * 20_000
    began = time.time()
    walk = page_parser._Walk(fixed_values.CARD, fixed_values.CARD_FIELDS)
    walk.feed(page)
    found = walk.finish()
    assert time.time() - began < 20 and len(found) == 20_000
    assert sum(len(v or "") for r in found for v in r.values()) <= len(page)
    assert {r["summary"] for r in found} == {"word "}


def test_fields_belong_to_the_innermost_card():
    page = (
        '<div class="result"><span class="company">Outer</span><div class="result"><span class="company">Inner</span>'
        '<span class="location">Here</span></div><span class="location">There</span></div><span class="location">Nowhere</span>'
    )
    walk = page_parser._Walk(fixed_values.CARD, {"company": ("span", "class", "company", "text"), "place": ("span", "class", "location", "text")})
    walk.feed(page)
    assert walk.finish() == [{"company": "Outer", "place": "There"}, {"company": "Inner", "place": "Here"}]
