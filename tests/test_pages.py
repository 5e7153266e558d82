import json
import time

from pyspark.sql import functions as F

from hirelens.functions.page_reader import read_payload
from hirelens import fixed_values as V
from hirelens.operators import pages as P
from hirelens.operators import silver as S

CRITERIA = (V.CRITERIA_ITEM, V.CRITERIA_KEY, V.CRITERIA_VALUE)
PAGE = """<html><head><link rel="canonical" href="https://www.linkedin.com/jobs/view/77">
<meta property="lnkd:url" content="https://www.linkedin.com/jobs/view/x-77">
<meta property="og:title" content="T &amp; U"><meta name="titleId" content="25">
</head><body>
<code id="decoratedJobPostingId" style="display: none"><!--"4430018168"--></code>
<h1 class="top-card-layout__title font topcard__title"> Data
  Analyst <b>II</b></h1><h1 class="top-card-layout__title topcard__title">second</h1>
<a class="topcard__org-name-link" href="/c">Acme<br>Corp</a>
<span class="topcard__flavor">no</span><span class="topcard__flavor topcard__flavor--bullet">Rabat</span>
<span class="posted-time-ago__text">2 days ago</span>
<div class="show-more-less-html__markup"><p>Use <b>SQL</b></p><div>inner</div><br/>end</div>
<ul><li class="description__job-criteria-item"><h3 class="description__job-criteria-subheader">
 Seniority level</h3><span class="description__job-criteria-text"> Entry </span></li>
<li class="description__job-criteria-item"><h3 class="description__job-criteria-subheader">Job-function
</h3><span class="description__job-criteria-text">IT</span></li>
<li class="description__job-criteria-item"><h3 class="description__job-criteria-subheader">Empty</h3>
</li></ul></body></html>"""


def test_page_payload():
    got = read_payload(PAGE, V.PAGE_SELECTORS, CRITERIA)
    assert got == {
        "job_id": "4430018168",
        "title": "Data Analyst II",
        "company": "Acme Corp",
        "location": "Rabat",
        "posted_time_text": "2 days ago",
        "applicants_text": None,
        "description_html": '<div class="show-more-less-html__markup"><p>Use <b>SQL</b></p>'
                            "<div>inner</div><br/>end</div>",
        "description_text": "Use SQL inner end",
        "criteria": {"seniority_level": "Entry", "job_function": "IT"},
        "canonical_url": "https://www.linkedin.com/jobs/view/77",
        "linkedin_url": "https://www.linkedin.com/jobs/view/x-77",
        "og_title": "T & U",
        "og_description": None,
        "title_id": "25",
        "company_id": None,
        "html_size": len(PAGE),
    }
    assert read_payload("<p>unclosed <h1", V.PAGE_SELECTORS, CRITERIA)["title"] is None


def test_implied_end_tags():
    item, key, value = (f'class="description__job-criteria-{c}"' for c in
                        ("item", "subheader", "text"))
    html = (
        f"<ul><li {item}><h3 {key}>A</h3><span {value}>x</span>"
        f"<li {item}><h3 {key}>B</h3><b><span {value}>y</span><ul><li>inner<li>list</ul>"
        f"<li {item}><h3 {key}>C</h3><span {value}>z</span></ul>"
        "<table><tr><td>1<td><h1 class='top-card-layout__title topcard__title'>T<tr><td>2</table>"
    )
    got = read_payload(html, V.PAGE_SELECTORS, CRITERIA)
    assert got["criteria"] == {"a": "x", "b": "y", "c": "z"}
    assert got["title"] == "T"


def test_unclosed_tags_take_linear_time():
    def seconds(html):
        started = time.perf_counter()
        read_payload(html, V.PAGE_SELECTORS, CRITERIA)
        return time.perf_counter() - started

    for part in ("<p>x</q>", "<b>x</q>", "<p><b>x</i>", "<li><div><p>"):
        few, many = part * 2_000, part * 20_000
        assert seconds(many) < 40 * max(seconds(few), 0.005)


def test_pages_become_records_and_postings(spark):
    pages = spark.createDataFrame(
        [(1, "https://a/?currentJobId=5", "<p>x</p>"), (2, "https://b", PAGE)],
        "page_id int, url string, html string",
    )
    records = P.page_records(P.page_payloads(pages, ["page_id", "url"]))
    got = {r.source_url: json.loads(r.raw_payload) for r in records.collect()}
    assert set(got) == {
        "https://www.linkedin.com/jobs/view/5/", "https://www.linkedin.com/jobs/view/x-77"
    }
    checked = S.split_by_completeness(records)
    missing = {r.source_url: r.missing_fields for r in checked.collect()}
    assert missing["https://www.linkedin.com/jobs/view/x-77"] == []
    assert missing["https://www.linkedin.com/jobs/view/5/"] == V.REQUIRED_PAYLOAD_FIELDS
    kept = S.split_by_completeness(records, keep_partial=True)
    assert kept.filter("is_saved").count() == 2 and checked.filter("is_saved").count() == 1
    errors = spark.createDataFrame([("https://c", "timeout")], "url string, error string")
    failures = S.collection_failures(checked, errors)
    assert sorted(r.status for r in failures.collect()) == ["failed", "partial_success"]

    bronze = records.withColumns(
        {"raw_job_id": F.lit(1), "pipeline_run_id": F.lit(1), "source_job_id": F.lit("9")}
    )
    plain = S.silver_candidates(bronze).filter("job_title is not null").first()
    assert plain.seniority_level is None  # nested in criteria
    nested = S.silver_candidates(bronze, criteria_fallback=True)
    assert nested.filter("job_title is not null").first().seniority_level == "Entry"


def test_links_prefer_cards_and_keep_first_seen_order(spark):
    cards = (
        '<a href="/jobs/view/9">no card</a>'
        '<a class="x base-card__full-link" href="https://m.site/jobs/view/a-b-12?trk=1&amp;z=2">1</a>'
        "<a class='base-card__full-link' href='/jobs/view/7/'>2</a>"
        '<!-- <a class="base-card__full-link" href="/jobs/view/1"> -->'
        '<a class="base-card__full-link" href="/jobs/view/12">again</a>'
    )
    fallback = '<a href="/about">x</a><a id=q href=/jobs/view/33>y</a>'
    frame = spark.createDataFrame(
        [(1, cards), (2, fallback), (3, "nothing")], "page_id int, html string"
    )
    got = P.page_links(frame, ["page_id"]).orderBy("page_id", "position").collect()
    assert [(r.page_id, r.position, r.job_id) for r in got] == [
        (1, 0, "12"), (1, 1, "7"), (2, 0, "33")
    ]
    assert got[0].job_url == "https://www.linkedin.com/jobs/view/12/"


def crawl(pages, max_urls, max_no_new):
    """The crawl loop: known/new per visited page, then the stop rules."""
    seen, out, run = [], [], 0
    for number, urls in enumerate(pages):
        if len(seen) >= max_urls:
            break
        new = [u for u in urls if u not in seen]
        out.append((number, len(set(urls)) - len(new), len(new)))
        seen += new
        run = 0 if new else run + 1
        if run >= max_no_new:
            break
    return out


def test_novelty_follows_the_crawl(spark):
    pages = [["a", "b"], ["b"], ["c", "a"], ["a"], [], ["d"], ["e"]]
    grid = spark.createDataFrame([("s", n) for n in range(len(pages))], "search string, page int")
    links = spark.createDataFrame(
        [("s", n, p, u) for n, urls in enumerate(pages) for p, u in enumerate(urls)],
        "search string, page int, position int, url string",
    )
    for max_urls, max_no_new in [(100, 2), (100, 1), (3, 5), (100, 9)]:
        rows = P.page_novelty(grid, links, 50, max_urls, max_no_new).orderBy("page").collect()
        visited = [(r.page, r.known_urls, r.new_urls) for r in rows if r.is_visited]
        assert visited == crawl(pages, max_urls, max_no_new)
    first = P.first_urls(links, 3).orderBy("discovery_rank").collect()
    assert [r.url for r in first] == ["a", "b", "c"]
    summary = P.search_summary(links.select("search", "url").distinct()).collect()
    assert {(r.scope, r.url_references) for r in summary} == {("search", 5), ("total", 5)}


def test_restricted_pages(column):
    assert column(["<p>Join LinkedIn now</p>", "ok"], P.is_restricted) == [True, False]


def test_links_behind_quotes_and_entities(spark):
    from hirelens.operators import pages as P

    html = (
        '<a title="x > y" class="base-card__full-link" href="/jobs/view/77/">a</a>'
        '<a class="base-card__full-link" href="&#47;jobs&#x2F;view/78/">b</a>'
        '<a class="base-card__full-link" href="/jobs/view/79/?a=1&amp;b=2">c</a>'
    )
    frame = spark.createDataFrame([(1, html)], "page_id int, html string")
    found = P.page_links(frame, ["page_id"]).orderBy("position").collect()
    assert [str(r.job_id) for r in found] == ["77", "78", "79"]
