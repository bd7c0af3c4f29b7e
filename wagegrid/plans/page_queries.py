"""Extraction from captured pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from wagegrid import fixed_values
from wagegrid.functions import markup, salary
from wagegrid.operators import pages
from wagegrid.plans import standins
from wagegrid.plans.registry import query, table, texts


def _decoded(sql: str) -> str:
    """SQL for the entities that occur in the page table; the ampersand comes last.

    These names are also entities without their semicolon, as at the cut end of a title.
    """
    for name, sign in (
        ("copy", "©"), ("middot", "·"), ("nbsp", " "), ("lt", "<"), ("gt", ">"),
        ("quot", '"'), ("amp", "&"),
    ):
        sql = f"regexp_replace({sql}, '&{name};?', '{sign}', 'g')"
    return sql


def _untagged(sql: str) -> str:
    return f"regexp_replace({sql}, '(?s)</?[a-zA-Z!?][^>]*>', '', 'g')"


def _trimmed(sql: str) -> str:
    return rf"regexp_replace({sql}, '^\s+|\s+$', '', 'g')"


_SEEN = (
    "regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), "
    r"'(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>', '', 'g')"
)


@query(
    "explode_cards",
    f"""
SELECT page_id, CAST(card_no AS INTEGER) AS card_no, {_decoded('link_text')} AS link_text,
       {_decoded('link_target')} AS link_target, CAST(NULL AS VARCHAR) AS company
FROM (SELECT page_id, unnest(range(len(a))) AS card_no, unnest(a) AS link_text, unnest(b) AS link_target
      FROM (SELECT page_id,
              regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS a,
              regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS b
            FROM pages))""",
)
def explode_cards(spark, folder):
    return pages.explode_cards(
        texts(spark, folder, "pages", "page_id", "html"),
        cards=[("li", None, None)],
        fields={
            "link_text": ("a", None, None, "text"),
            "link_target": ("a", None, None, "href"),
            "company": ("span", "class", "company", "text"),
        },
    )


_PAGE_AS_CARD = {
    **fixed_values.CARD_FIELDS,
    "title_link": ("h1", None, None, "text"),
    "company_name": ("title", None, None, "text"),
    "place": ("div", "class", "ad", "text"),
    "summary": ("footer", None, None, "text"),
    "salary_nobr": ("b", None, None, "text"),
    "link_id": ("a", None, None, "href"),
}


def _page_cards(spark, folder):
    return pages.card_fields(
        pages.explode_cards(
            texts(spark, folder, "pages", "page_id", "html"), cards=[("html", None, None)], fields=_PAGE_AS_CARD
        )
    )


def _inner(pattern: str) -> str:
    inner = _trimmed(_decoded(_untagged(f"regexp_extract(html, '{pattern}', 1)")))
    return f"nullif({inner}, '')"


_SALARY = _inner("(?s)<b>(.*?)</article>")
_ID = """nullif(substr(regexp_extract(html, '<a href="([^"]*)"', 1), 4), '')"""


@query(
    "card_fields",
    f"""
SELECT page_id, 0 AS card_no, {_inner('(?s)<h1>(.*?)</h1>')} AS title,
       nullif(replace({_decoded(_untagged("regexp_extract(html, '(?s)<div class=.ad.>(.*?)</div>', 1)"))},
                      chr(10), ''), '') AS location,
       {_inner('(?s)<title>(.*?)</title>')} AS company, {_SALARY} AS salary,
       {_inner('(?s)<footer>(.*?)</footer>')} AS synopsis, {_decoded(_ID)} AS job_id
FROM pages""",
)
def card_fields(spark, folder):
    return _page_cards(spark, folder)


@query(
    "search_rows",
    f"""
SELECT page_id, '2024-01-01 10:11:00' AS searched, {_inner('(?s)<h1>(.*?)</h1>')} AS title,
       nullif(replace({_decoded(_untagged("regexp_extract(html, '(?s)<div class=.ad.>(.*?)</div>', 1)"))},
                      chr(10), ''), '') AS location,
       {_inner('(?s)<title>(.*?)</title>')} AS company, {_decoded(_ID)} AS job_id
FROM pages""",
)
def search_rows(spark, folder):
    rows = pages.search_rows(
        texts(spark, folder, "pages", "page_id", "html"),
        F.lit("2024-01-01 10:11:12").cast("timestamp"), keep=("page_id",),
        cards=[("html", None, None)], fields=_PAGE_AS_CARD,
    )
    stamp = F.date_format("search_datetime", "yyyy-MM-dd HH:mm:ss")
    return rows.withColumn("searched", stamp).drop("search_datetime")


@query("rejects", "SELECT page_id FROM pages WHERE NOT contains(html, 'indeed-share-url')")
def rejects(spark, folder):
    details = pages.detail_fields(texts(spark, folder, "pages", "page_id", "html"))
    return pages.rejects(details).select("page_id")


@query("card_salary", f"SELECT page_id, {_SALARY} AS salary FROM pages")
def card_salary(spark, folder):
    raw = pages.explode_cards(
        texts(spark, folder, "pages", "page_id", "html"), cards=[("html", None, None)],
        fields={
            "salary_span": fixed_values.CARD_FIELDS["salary_span"],
            "salary_nobr": ("b", None, None, "text"),
        },
    )
    return raw.select("page_id", pages.card_salary("salary_span", "salary_nobr").alias("salary"))


@query("card_job_id", f"SELECT page_id, {_ID} AS job_id FROM pages")
def card_job_id(spark, folder):
    link = markup.first_attribute("html", "a", "href")
    return texts(spark, folder, "pages", "page_id", "html").select(
        "page_id", markup.job_id_of_link(link).alias("job_id")
    )


@query(
    "detail_fields",
    f"""
SELECT page_id,
       list_last(string_split({_decoded("regexp_extract(html, '<a href=.([^" + '"' + "]*)', 1)")}, '=')) AS job_id,
       {_inner('(?s)<h1>(.*?)</h1>')} AS desc_title,
       regexp_extract(html, '(?s)<div class=.ad.>.*?</div>') AS job_desc,
       {_inner('(?s)<footer>(.*?)</footer>')} AS desc_company,
       CAST(0 AS DOUBLE) AS company_rating, 0 AS company_rating_count
FROM pages""",
)
def detail_fields(spark, folder):
    return pages.detail_fields(
        texts(spark, folder, "pages", "page_id", "html"),
        fields={
            "share_url": ("a", None, None, "href"),
            "title": ("h1", None, None, "text"),
            "job_desc": ("div", "class", "ad", "html"),
            "company": ("footer", None, None, "text"),
            "rating": ("meta", "charset", None, "charset"),
        },
    )


@query("strip_tags", f"SELECT page_id, {_trimmed(_decoded(_untagged(_SEEN)))} AS text FROM pages")
def strip_tags(spark, folder):
    return texts(spark, folder, "pages", "page_id", "html").select(
        "page_id", markup.strip_tags("html").alias("text")
    )


def _items(tag: str, ends: str) -> str:
    item = _trimmed(_untagged(f"regexp_replace(item, '(?is)</(?:{ends}).*', '')"))
    return f"""
SELECT page_id, '{tag}' AS tag, CAST(item_no AS INTEGER) AS item_no, {item} AS item
FROM (SELECT page_id, unnest(range(len(a) - 1)) AS item_no, unnest(a[2:]) AS item
      FROM (SELECT page_id, regexp_split_to_array({_SEEN}, '(?i)<{tag}(?:\\s[^>]*)?>') AS a FROM pages))"""


@query(
    "list_items",
    _items("li", "li|ul|ol|menu|nav|article|section|main|body")
    + " UNION ALL "
    + _items("p", "p|li|ul|ol|td|th|div|article|section|main|body"),
)
def list_items(spark, folder):
    captured = texts(spark, folder, "pages", "page_id", "html")
    both = [
        pages.list_items(captured, tag).withColumn("tag", F.lit(tag)) for tag in ("li", "p")
    ]
    return both[0].unionByName(both[1])


@query(
    "url_parts",
    r"""
SELECT page_id, regexp_extract(url, '^https?://([^/?#:]*)', 1) AS host,
       nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page,
       list_last(string_split(url, '=')) AS last_part,
       'https://www.indeed.com/viewjob?jk=' || page_id AS posting_url
FROM pages""",
)
def url_parts(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", markup.url_host("url").alias("host"),
        markup.url_parameter("url", "page").alias("page"),
        markup.after_last_equals("url").alias("last_part"),
        markup.posting_url(F.col("page_id").cast("string")).alias("posting_url"),
    )


@query(
    "find_money",
    rf"""
SELECT job_id,
       array_to_string(regexp_extract_all("Salary", '\$\s*([0-9][0-9,]*(?:\.[0-9]+)?)', 1), '|') AS amounts,
       array_to_string(regexp_extract_all("Salary", '\$\s*[0-9][0-9,]*\.[0-9]{{2}}\b'), '|')
         AS with_cents
FROM {standins.LISTINGS}""",
)
def find_money(spark, folder):
    return standins.listings(spark, folder).select(
        "job_id",
        F.array_join(salary.find_money("Salary"), "|").alias("amounts"),
        F.array_join(salary.find_money("Salary", with_cents=True), "|").alias("with_cents"),
    )
