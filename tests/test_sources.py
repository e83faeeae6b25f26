"""Page parsing, cards, detail pages and the registry."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from gleanery.sources import cards, details, dom, feeds, registry, sites
from gleanery.sources.postings import accepted, merge_detail


def pages(spark, source, *html, **extra):
    rows = [(source, i + 1, h) for i, h in enumerate(html)]
    df = spark.createDataFrame(rows, "source string, page int, html string")
    return df.withColumns({c: F.lit(extra.get(c)).cast("string") for c in ("site", "company", "site_url")})


def rows_of(spark, source, *html, **extra):
    landed = registry.Landed(pages=pages(spark, source, *html, **extra))
    return accepted(registry.extract(landed, [source])).orderBy("page", "pos").collect()


def test_parser_repairs_markup(spark):
    html = "<ul><li>a<li>b<ul><li>in</ul></ul><p>x<b>y<p>z<script>var t='</p>';</script><td>q"
    nodes = spark.createDataFrame([(html,), (None,), ("",)], "h string").select(
        dom.parse_nodes("h").alias("n")).collect()
    tags = [(n.tag, n.text) for n in nodes[0].n]
    assert tags[:6] == [("ul", None), ("li", None), ("#text", "a"), ("li", None), ("#text", "b"), ("ul", None)]
    assert ("#raw", "var t='</p>';") in tags
    first_p = next(n for n in nodes[0].n if n.tag == "p")
    assert nodes[0].n[first_p.stop].text == "y"
    assert nodes[1].n is None and nodes[2].n == []


def test_blocks_outside_boilerplate(spark):
    html = ("<nav><p>menu entry of more than twenty</p></nav><main><h1>Job description</h1><p>This is a long enough text.</p>"
            "<ul><li>a<ul><li>b</li></ul></li></ul><h2>Requirements</h2><p>short</p><ol><li>need</li></ol>"
            "<h2>Benefits</h2><p>a paragraph that belongs nowhere</p><ul><li>perk</li></ul></main><p>outside of the main part here</p>")
    out = details.page_sections(pages(spark, "x", html), [
        ("desc", "description"), ("req", "requirement"), ("offer", "benefit")], ["page"]).first()
    assert out.description == "This is a long enough text.\nab\nb\nperk"
    assert out.requirements == "need"


def test_detail_pages(spark):
    brighter = ('<main><a href="/companies/acme">Acme</a><p>KSh 50,000 - 80,000 per month</p><span>Based in <b>Nairobi</b></span>'
                '<p>Full time</p><h2>Job summary</h2><p>Something long enough to keep here</p></main>')
    summit = '<div><p>Company: Big Co</p><p>part-time work</p><h3>Role</h3><p>Something long enough to keep here</p></div>'
    df = spark.createDataFrame([("u1", brighter), ("u2", summit)], "url string, html string")
    a = details.detail_fields(df.where("url = 'u1'"), "brightermonday").first()
    assert (a.company, a.salary_min, a.salary_max, a.salary_currency, a.job_type, a.location) == (
        "Acme", 50000.0, 80000.0, "KES", "full-time", "Based inNairobi")
    assert a.description == "KSh 50,000 - 80,000 per month\nSomething long enough to keep here"
    b = details.detail_fields(df.where("url = 'u2'"), "summitrecruitment").first()
    assert (b.company, b.job_type, b.description) == ("Big Co", "part-time", "Something long enough to keep here")


def test_detail_over_listing(spark):
    listing = spark.createDataFrame([("u1", "c", None), ("u2", "d", "x"), (None, "e", "y")],
                                    "url string, company string, description string")
    detail = spark.createDataFrame([("u1", "", "long"), ("u1", "", "long"), ("u3", "z", "q")],
                                   "url string, company string, description string")
    got = {tuple(r) for r in merge_detail(listing, detail).collect()}
    assert got == {("u1", "c", "long"), ("u2", "d", "x"), (None, "e", "y")}


def test_fallback_cards_and_bad_salary(spark):
    got = rows_of(spark, "indeed",
                  '<table><td id="resultsCol1"><h2 class="jobTitle">T</h2><a href="x/y">l</a></td></table>',
                  '<div class="result"><h2 class="title">A</h2><div class="salary">, or so</div></div>'
                  '<div class="result"><h2 class="title">B</h2></div>', "<p>none</p>")
    assert [(r.title, r.url) for r in got] == [("T", None), ("B", None)]


def test_structured_data_first(spark):
    ld = '<script type="application/ld+json">{"@type":"ItemList","itemListElement":[{"name":"N","url":"http://f/1/"}]}</script>'
    got = rows_of(spark, "fuzu", ld + '<div class="job-card"><h2>no</h2></div>',
                  '<div class="job-card"><h2>yes</h2><a href="/j/2">x</a></div>', '<a href="/kenya/jobs/3">link</a>')
    assert [(r.title, r.external_id) for r in got] == [("N", "1"), ("yes", "2"), ("link", "3")]
    state = '<script id="__NEXT_DATA__">{"props":{"pageProps":{"results":[{"title":"S","slug":"s1"}]}}}</script>'
    got = rows_of(spark, "workatastartup", state, '<a href="/jobs/7">Card</a>')
    assert [(r.title, r.external_id) for r in got] == [("S", "s1"), ("Card", "7")]
    posting = '<script type="application/ld+json">[{"@type":"JobPosting","title":"W","url":"http://w/9"}]</script>'
    got = rows_of(spark, "wellfound", posting, '<div class="job-listing"><a href="/jobs/8">Dev</a></div>' + posting)
    assert sorted((r.title, r.external_id) for r in got) == [("Dev", "8"), ("W", "9")]


def test_site_cap(spark):
    card = '<article class="vacancy"><h2>Job {}</h2><a href="/vacancies/{}">x</a></article>'
    html = "".join(card.format(i, i) for i in range(70))
    site = next(s for s in sites.EMPLOYERS if s.name == "amref")
    landed = registry.Landed(pages=pages(spark, "company_careers", html, site="amref", company="A", site_url=site.base))
    got = accepted(registry.extract(landed, ["company_careers"])).collect()
    assert len(got) == 70 and {r.source for r in got} == {"amref"}
    capped = cards.card_postings(landed.pages, replace(site, per_site=50)).collect()
    assert sorted(r.pos for r in capped if r.reject is None) == list(range(50))
    assert {r.reject for r in capped if r.pos >= 50} == {"beyond the cap of the site"}


def test_registry(spark):
    assert len(registry.REGISTRY) == 29
    with pytest.raises(ValueError, match="unknown source"):
        registry.chosen(["nowhere"])


def test_malformed_and_typed_payloads(spark):
    body = '[{"meta":1},{"id":7,"position":"Dev","tags":"x","date":"2024-01-01T00:00:00"},5,{"id":8}]'
    df = spark.createDataFrame([("remoteok", 1, body), ("remoteok", 2, "{oops")], "source string, page int, body string")
    out = feeds.feed_postings(df, feeds.FEEDS["remoteok"]).collect()
    good = [r for r in out if r.reject is None]
    assert [(r.external_id, r.tags, r.posted_date) for r in good] == [("7", "x", None)]
    assert sorted(r.reject for r in out if r.reject) == ["malformed body", "no title", "no title"]


def test_source_search(spark):
    body = '[{"m":1},{"id":1,"position":"Dev","tags":["go"]},{"id":2,"position":"Cook","tags":["DEVops"]},{"id":3,"position":"Cook"}]'
    df = spark.createDataFrame([("remoteok", 1, body)], "source string, page int, body string")
    out = registry.extract(registry.Landed(payloads=df), ["remoteok"], search="dev")
    assert sorted(r.external_id for r in accepted(out).collect()) == ["1", "2"]


BROKEN = ["<![foo[ b ]]>", None]


def test_unreadable_pages_are_quarantined(spark):
    good = '<div class="base-card"><h3>Dev</h3><a href="/view/9">x</a></div>'
    assert dom._nodes_of("<![foo[ b ]]>")[0]["tag"] == dom.BROKEN
    landed = registry.Landed(pages=pages(spark, "linkedin", good, *BROKEN, "<!-- never closed"))
    rows = registry.extract(landed, ["linkedin"]).collect()
    assert sorted((r.page, r.reject) for r in rows if r.reject) == [(2, "unparseable page"), (3, "unparseable page")]
    assert [r.title for r in rows if r.reject is None] == ["Dev"]


def test_title_of_the_first_link_only(spark):
    other = '<a href="https://else.test/1">Cached</a>'
    card = '<div class="g">{}<a href="https://r.test/1"><h3>Dev</h3></a></div>'
    html = card.format("") + card.format(other)
    got = rows_of(spark, "google_search", html, site="indeed.com")
    assert [(r.title, r.url) for r in got] == [("Dev", "https://r.test/1")]


def test_own_link_of_a_label(spark):
    card = ('<div class="job-list"><h4>{}</h4><a href="/jobs/b/view">Share</a>'
            '<span class="company"><a>Acme</a>| verified</span><span class="office-location">Kisumu</span></div>')
    html = card.format('<a href="/jobs/a/view">Dev</a>') + card.format("No link here")
    got = rows_of(spark, "myjobsinkenya", html)
    assert [(r.title, r.company, r.location) for r in got] == [("Dev", "Acme", "Kisumu")]
