"""Urls, ids, salaries, dates and prose rules."""

from pyspark.sql import functions as F

from checks.fixtures import table, view, with_views
from checks.registry import query
from gleanery import vocab
from gleanery.functions import dates, prose, salary, urls
from gleanery.functions import text as tx
from gleanery.sources import cards, details, dom
from gleanery.sources.postings import cap_per_group, dedup_first, merge_detail, query_filter
from gleanery.sources.sites import SEARCH_SITES

J = with_views("jobs")
CHARS = "replace(replace(replace(replace({c}, '&quot;', '\"'), '&copy;', chr(169)), '&middot;', chr(183)), '&amp;', '&')"


def pages(spark, sf):
    return table(spark, sf, "pages")


def docs(spark, sf):
    return table(spark, sf, "documents")


def _nodes(c):
    """DuckDB: stripped text nodes of a fragment."""
    return (f"list_filter(list_transform(string_split_regex({c}, '(?is)<script.*?</script>|<style.*?</style>"
            f"|<!--.*?-->|<[^>]+>'), lambda s: trim({CHARS.format(c='s')}, chr(32) || chr(10) || chr(9) || chr(13))), "
            f"lambda s: s <> '')")


# --- urls and ids --------------------------------------------------------


@query("absolutize_url", """WITH links AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href
  FROM pages UNION ALL SELECT page_id, url FROM pages UNION ALL SELECT page_id, '' FROM pages)
SELECT DISTINCT page_id, href,
  CASE WHEN href = '' THEN NULL WHEN starts_with(href, 'http') THEN href ELSE 'https://e.test' || href END AS url,
  CASE WHEN href = '' THEN NULL WHEN starts_with(href, '/') THEN 'https://e.test' || href
       WHEN starts_with(href, 'http') THEN href END AS rooted FROM links""")
def absolutize_url(spark, sf):
    p = pages(spark, sf)
    links = p.select("page_id", F.explode(F.regexp_extract_all(
        "html", F.lit('href="([^"]*)"'), F.lit(1))).alias("href"))
    links = links.union(p.select("page_id", "url")).union(p.select("page_id", F.lit(""))).distinct()
    href = F.col("href")
    return links.select("page_id", "href", urls.absolutize(href, "https://e.test").alias("url"),
                        urls.absolutize(href, "https://e.test", root_only=True).alias("rooted"))


@query("id_last_segment", """SELECT page_id, string_split(regexp_replace(url, '/+$', ''), '/')[-1] AS external_id
FROM pages""")
def id_last_segment(spark, sf):
    return pages(spark, sf).select("page_id", urls.last_segment(F.col("url")).alias("external_id"))


@query("id_regex", """SELECT page_id, nullif(regexp_extract(url, '/([a-z]{2})/', 1), '') AS external_id FROM pages""")
def id_regex(spark, sf):
    return pages(spark, sf).select("page_id", urls.captured(F.col("url"), "/([a-z]{2})/").alias("external_id"))


@query("id_slug_or_title", f"""{J} SELECT id,
  coalesce(nullif(regexp_extract(trim(url), '/([^/]+)/?$', 1), ''), title) AS slug,
  coalesce(nullif(regexp_extract(trim(url), '/(\\d+)', 1), ''), title) AS digits FROM jobs""")
def id_slug_or_title(spark, sf):
    url, title = F.trim("url"), F.col("title")
    return view(spark, sf, "jobs").select(
        "id", urls.slug_or_title(url, title).alias("slug"),
        urls.slug_or_title(url, title, r"/(\d+)").alias("digits"))


@query("id_attr", """SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN 'jk' || p_partkey
  WHEN p_partkey % 3 = 1 THEN 'c' || p_partkey ELSE NULL END AS external_id FROM part""")
def id_attr(spark, sf):
    html = F.expr("""concat('<div class="result"', CASE p_partkey % 3
      WHEN 0 THEN concat(' data-jk="jk', p_partkey, '" id="c"') WHEN 1 THEN concat(' data-jk="" id="c', p_partkey, '"')
      ELSE '' END, '>', p_name, '</div>')""")
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("page"), html.alias("html"))
    found = cards.split_cards(p, [dom.Sel(("div",), "result")], ["page"])
    rule = cards.attribute("data-jk", "id")
    return found.select(F.col("page").alias("id"),
                        rule(None, None, None, F.col("card"), None).alias("external_id"))


@query("id_composite", f"""{J} SELECT id, 'bamboohr_' || company || '_' || id AS external_id FROM jobs""")
def id_composite(spark, sf):
    return view(spark, sf, "jobs").select(
        "id", urls.composite("bamboohr", F.col("company"), F.col("id")).alias("external_id"))


_SITES = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(SEARCH_SITES))


@query("derive_source", f"""SELECT p_partkey AS id, 'google_' || string_split(
  CASE p_partkey % {len(SEARCH_SITES)} {_SITES} END, '.')[1] AS source FROM part""")
def derive_source(spark, sf):
    site = F.expr(f"CASE p_partkey % {len(SEARCH_SITES)} {_SITES} END")
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), urls.source_from_site(site).alias("source"))


# --- salary --------------------------------------------------------------

_PAY = """CASE o_orderkey % 7
  WHEN 0 THEN 'KSh ' || CAST(floor(o_totalprice) AS BIGINT) || ' - ' || CAST(floor(o_totalprice * 2) AS BIGINT)
  WHEN 1 THEN '$' || CAST(floor(o_totalprice / 1000) AS BIGINT) || 'k'
  WHEN 2 THEN 'from 1,2' || (o_orderkey % 100) || ' eur'
  WHEN 3 THEN 'negotiable' WHEN 4 THEN ',' WHEN 5 THEN '£1,200 – £1,5' || (o_orderkey % 90) || ' per 2 days' END"""
_NUMS = f"regexp_extract_all(replace({_PAY}, ',', ''), '[0-9]+')"


def pay(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.expr(_PAY).alias("pay"))


@query("salary_numbers", f"""SELECT o_orderkey AS id, CAST({_NUMS}[1] AS DOUBLE) AS salary_min,
  CAST(coalesce({_NUMS}[2], {_NUMS}[1]) AS DOUBLE) AS salary_max FROM orders""")
def salary_numbers(spark, sf):
    low, high = salary.bounds(F.col("pay"), "both")
    return pay(spark, sf).select("id", low.alias("salary_min"), high.alias("salary_max"))


@query("salary_modes", f"""SELECT o_orderkey AS id, CAST({_NUMS}[1] AS DOUBLE) AS single_min,
  CAST({_NUMS}[2] AS DOUBLE) AS single_max,
  CASE WHEN len({_NUMS}) >= 2 THEN CAST({_NUMS}[1] AS DOUBLE) END AS pair_min,
  CAST({_NUMS}[2] AS DOUBLE) AS pair_max,
  coalesce(o_orderkey % 7 = 4, FALSE) AS unreadable FROM orders""")
def salary_modes(spark, sf):
    c = F.col("pay")
    (a, b), (p, q) = salary.bounds(c, "min_only"), salary.bounds(c, "pair_only")
    return pay(spark, sf).select("id", a.alias("single_min"), b.alias("single_max"),
                                 p.alias("pair_min"), q.alias("pair_max"),
                                 salary.unreadable(c, "min_only").alias("unreadable"))


@query("salary_currency_detect", """SELECT o_orderkey AS id,
  CASE WHEN o_orderkey % 7 = 1 THEN 'USD' ELSE 'KES' END AS board,
  CASE o_orderkey % 7 WHEN 2 THEN 'EUR' WHEN 5 THEN 'GBP' ELSE 'USD' END AS remote FROM orders""")
def salary_currency_detect(spark, sf):
    c = F.col("pay")
    return pay(spark, sf).select(
        "id", salary.currency(c, [(["$"], "USD")], "KES").alias("board"),
        salary.currency(c, [(["£", "GBP"], "GBP"), (["€", "EUR"], "EUR")], "USD").alias("remote"))


@query("salary_range", f"""WITH r AS (SELECT o_orderkey AS id,
  replace(regexp_extract({_PAY}, '([0-9,]+)\\s*[-–]\\s*£?([0-9,]+)', 1), ',', '') AS a,
  replace(regexp_extract({_PAY}, '([0-9,]+)\\s*[-–]\\s*£?([0-9,]+)', 2), ',', '') AS b FROM orders)
SELECT id, try_cast(a AS DOUBLE) AS salary_min, try_cast(b AS DOUBLE) AS salary_max FROM r""")
def salary_range(spark, sf):
    low, high = salary.range_bounds(F.replace(F.col("pay"), F.lit("£"), F.lit("")))
    return pay(spark, sf).select("id", low.alias("salary_min"), high.alias("salary_max"))


# --- dates ---------------------------------------------------------------

_SHAPES = ["d MMMM yyyy", "MMMM d, yyyy", "dd/MM/yyyy", "yyyy-MM-dd", "d MMM yyyy", "dd-MM-yyyy"]


@query("parse_deadline", """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 6 THEN NULL
  ELSE date_trunc('day', o_orderdate) END AS deadline,
  CASE WHEN o_orderkey % 7 >= 5 THEN NULL ELSE date_trunc('day', o_orderdate) END AS strict FROM orders""")
def parse_deadline(spark, sf):
    label = F.element_at(F.array(*[F.lit(x) for x in ("Deadline: ", "Closing  Date ", "EXPIRES: ", "")]),
                         (F.col("o_orderkey") % 4 + 1).cast("int"))
    shape = F.lit("31 Foo 2024")
    for i, s in enumerate(_SHAPES):
        shape = F.when(F.col("o_orderkey") % 7 == i, F.date_format("o_orderdate", s)).otherwise(shape)
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.concat(label, F.lower(shape)).alias("text"))
    return rows.select("id", dates.parse_deadline(F.col("text")).alias("deadline"),
                       dates.parse_deadline(F.col("text"), vocab.DEADLINE_FORMATS_5).alias("strict"))


@query("parse_posted", """SELECT event_id AS id, date_trunc('second', ts) AS seconds,
  date_trunc('day', ts) AS day, CASE WHEN event_id % 3 = 0 THEN ts WHEN event_id % 3 = 1 THEN ts - INTERVAL 3 HOUR
    ELSE date_trunc('second', ts) END AS instant,
  CASE WHEN event_id % 2 = 0 THEN date_trunc('second', ts) END AS epoch FROM events""")
def parse_posted(spark, sf):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    full = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    offset = F.expr("CASE event_id % 3 WHEN 0 THEN 'Z' WHEN 1 THEN '+03:00' ELSE '' END")
    iso = F.when(F.col("event_id") % 3 == 2, text).otherwise(F.concat(full, offset))
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp")).cast("string")
    epoch = F.when(F.col("event_id") % 2 == 0, seconds).otherwise(text)
    return table(spark, sf, "events").select(
        F.col("event_id").alias("id"), dates.iso_seconds(full).alias("seconds"),
        dates.iso_day(full).alias("day"), dates.iso_instant(iso).alias("instant"),
        dates.epoch_seconds(epoch).alias("epoch"))


@query("parse_ordinal_deadline", """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 <> 4
  THEN date_trunc('day', o_orderdate) END AS deadline FROM orders""")
def parse_ordinal_deadline(spark, sf):
    day = F.dayofmonth("o_orderdate")
    suffix = F.expr("element_at(array('st', 'nd', 'rd', 'th', ''), CAST(o_orderkey % 5 + 1 AS INT))")
    label = F.expr("element_at(array('Deadline: ', 'Application Deadline ', 'deadline:', 'DEADLINE ', 'Until '), "
                   "CAST(o_orderkey % 5 + 1 AS INT))")
    text = F.concat(F.lit("Great role.\n"), label, day.cast("string"), suffix, F.lit(" "),
                    F.date_format("o_orderdate", "MMMM yyyy"), F.lit(" at noon"))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), dates.ordinal_deadline(text).alias("deadline"))


@query("parse_labelled_date", """SELECT o_orderkey AS id, date_trunc('day', o_orderdate) AS closing,
  CASE WHEN o_orderkey % 3 <> 0 THEN date_trunc('day', o_orderdate) - INTERVAL 20 YEAR END AS advertised FROM orders""")
def parse_labelled_date(spark, sf):
    early = F.col("o_orderdate") - F.expr("INTERVAL '20' YEAR")
    text = F.concat(
        F.lit("<p>Closing Date: "), F.date_format("o_orderdate", "M/d/yy"), F.lit("</p>"),
        F.when(F.col("o_orderkey") % 3 != 0, F.concat(
            F.lit("Advertised Date:"), F.date_format(early, "MM/dd/yy"))).otherwise("Advertised Date: 1/5/1999"))
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), text.alias("text"))
    return rows.select("id", dates.labelled_date(F.col("text"), "Closing Date:").alias("closing"),
                       dates.labelled_date(F.col("text"), "Advertised Date:").alias("advertised"))


# --- prose ---------------------------------------------------------------

_PROSE = """CASE o_orderkey % 8
  WHEN 0 THEN 'Location: Westlands, Nairobi Kenya. Full-time role' WHEN 1 THEN 'Based in Kampala Uganda, contract'
  WHEN 2 THEN 'Office in Kisumu, Kenya (part-time)' WHEN 3 THEN 'Lagos or Nairobi, Nigeria; internship'
  WHEN 4 THEN 'Dar es Salaam; remote' WHEN 5 THEN 'lagos; Not remote, FULL TIME' WHEN 6 THEN 'Somewhere' END"""


def said(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.expr(_PROSE).alias("text"))


@query("extract_location", """SELECT o_orderkey AS id, CASE o_orderkey % 8 WHEN 0 THEN 'Westlands, Nairobi Kenya'
  WHEN 1 THEN 'Kampala Uganda' WHEN 2 THEN 'Kisumu, Kenya' WHEN 3 THEN 'Nairobi, Nigeria' WHEN 4 THEN 'Dar es Salaam'
  WHEN 5 THEN '' WHEN 6 THEN '' END AS location FROM orders""")
def extract_location(spark, sf):
    return said(spark, sf).select("id", prose.extract_location(F.col("text")).alias("location"))


@query("extract_job_type", """SELECT o_orderkey AS id, CASE o_orderkey % 8 WHEN 0 THEN 'Full-Time' WHEN 1 THEN 'Contract'
  WHEN 2 THEN 'Part-Time' WHEN 3 THEN 'Internship' WHEN 5 THEN 'Full-Time' ELSE '' END AS ladder,
  CASE o_orderkey % 8 WHEN 0 THEN 'full-time' WHEN 1 THEN 'contract' WHEN 2 THEN 'part-time' WHEN 3 THEN 'internship'
  WHEN 5 THEN 'full-time' END AS pattern FROM orders""")
def extract_job_type(spark, sf):
    return said(spark, sf).select("id", prose.prose_job_type(F.col("text")).alias("ladder"),
                                  prose.pattern_job_type(F.col("text")).alias("pattern"))


@query("remote_flag", f"""{J} SELECT id, contains(lower(coalesce(location, '')), 'remote')
    OR contains(lower(title), 'remote') AS by_name,
  contains(lower(coalesce(description, '')), 'home') AS by_text,
  id % 5 IN (0, 1, 3) OR coalesce(location IN ('Remote'), FALSE) AS by_flag, id % 3 = 1 AS by_code,
  CASE WHEN id % 3 = 2 THEN location || ' (Hybrid)' ELSE location END AS place FROM jobs""")
def remote_flag(spark, sf):
    flag = F.expr("element_at(array('true', 'yes', '0', '1', 'no'), CAST(id % 5 + 1 AS INT))")
    code = (F.col("id") % 3).cast("string")
    text = F.replace(F.col("description"), F.lit("home"), F.lit("remote"))
    return view(spark, sf, "jobs").select(
        "id", prose.remote_in_title_or_place(F.col("title"), F.col("location")).alias("by_name"),
        prose.remote_in_text(text).alias("by_text"),
        prose.remote_truthy(flag, F.col("location")).alias("by_flag"),
        prose.remote_code(code).alias("by_code"),
        prose.hybrid_location(F.col("location"), code).alias("place"))


@query("split_title", """SELECT p_partkey AS id, p_name || ' at sea' AS job, p_brand AS company,
  p_type AS role, CASE WHEN p_partkey % 2 = 0 THEN p_brand || ', Kenya' ELSE 'Kisumu KENYA' END AS place FROM part""")
def split_title(spark, sf):
    named = F.concat("p_name", F.lit(" at sea at  "), "p_brand")
    placed = F.concat("p_type", F.lit(" - "), F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand"))
                      .otherwise("Kisumu KENYA"))
    rows = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), named.alias("n"), placed.alias("p"))
    job, company = prose.split_last(F.col("n"), " at ")
    role, place = prose.split_last(F.col("p"), " - ")
    return rows.select("id", job.alias("job"), company.alias("company"), role.alias("role"),
                       prose.place_with_country(place).alias("place"))


@query("labelled_field", """SELECT p_partkey AS id, p_name AS company FROM part""")
def labelled_field(spark, sf):
    text = F.concat(F.lit("Role\nCOMPANY : "), "p_name", F.lit("\nmore <b>x</b>"))
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), prose.labelled_field(text, "company").alias("company"))


_WORDS = ["ingly", "ement", "heit"]
_HIT = "(" + " OR ".join(f"contains(lower(x), '{w}')" for w in _WORDS) + ")"
_LINES = "list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, chr(32) || chr(9) || chr(13))), lambda x: x <> '')"


@query("section_latched", f"""WITH l AS (SELECT doc_id, {_LINES} AS lines FROM documents),
p AS (SELECT *, list_position(list_transform(lines, lambda x: {_HIT}), TRUE) AS hit FROM l)
SELECT doc_id, coalesce(array_to_string(CASE WHEN hit > 0 THEN lines[1:hit - 1] ELSE lines END, chr(10)), '') AS description,
  coalesce(array_to_string(CASE WHEN hit > 0 THEN lines[hit:] ELSE [] END, chr(10)), '') AS requirements FROM p""")
def section_latched(spark, sf):
    rows = docs(spark, sf).select("doc_id", prose.lines(F.col("text")).alias("lines"))
    desc, req = prose.split_latched(F.col("lines"), _WORDS)
    return rows.select("doc_id", desc.alias("description"), req.alias("requirements"))


@query("drop_lines", f"""SELECT doc_id, coalesce(array_to_string(list_filter({_LINES}, lambda x: NOT {_HIT}), chr(10)), '') AS text
FROM documents""")
def drop_lines(spark, sf):
    kept = prose.drop_lines(prose.lines(F.col("text")), _WORDS)
    return docs(spark, sf).select("doc_id", F.array_join(kept, "\n").alias("text"))


@query("truncate_text", """SELECT doc_id, left(text, 1000) AS short, left(text, 5000) AS long FROM documents""")
def truncate_text(spark, sf):
    c = F.col("text")
    return docs(spark, sf).select("doc_id", tx.truncate(c, 1000).alias("short"), tx.truncate(c, 5000).alias("long"))


@query("length_gate", f"""{J} SELECT id FROM jobs WHERE length(title) >= 5 AND length(description) >= 30""")
def length_gate(spark, sf):
    return view(spark, sf, "jobs").where((F.length("title") >= 5) & (F.length("description") >= 30)).select("id")


# --- pages ---------------------------------------------------------------


@query("html_to_lines", f"""SELECT page_id, array_to_string({_nodes('html')}, chr(10)) AS text FROM pages""")
def html_to_lines(spark, sf):
    return pages(spark, sf).select("page_id", prose.html_to_text(F.col("html")).alias("text"))


@query("strip_boilerplate", """SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
  '(?is)<script\\b[^>]*>.*?</script\\s*>', '', 'g'), '(?is)<style\\b[^>]*>.*?</style\\s*>', '', 'g'),
  '(?is)<nav\\b[^>]*>.*?</nav\\s*>', '', 'g'), '(?is)<footer\\b[^>]*>.*?</footer\\s*>', '', 'g') AS html FROM pages""")
def strip_boilerplate(spark, sf):
    return pages(spark, sf).select("page_id", prose.strip_boilerplate(F.col("html")).alias("html"))


@query("page_cards", f"""WITH c AS (SELECT page_id, regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1) AS cards FROM pages)
SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, array_to_string({_nodes('cards[i]')}, '') AS text
FROM c, unnest(range(1, len(cards) + 1)) AS t(i)""")
def page_cards(spark, sf):
    found = cards.split_cards(pages(spark, sf), [dom.Sel(("li",), "job-card"), dom.Sel(("li",))], ["page_id"])
    return found.select("page_id", "pos", F.expr(dom.text_of("nodes", "card")).alias("text"))


@query("first_text", f"""SELECT page_id,
  array_to_string({_nodes("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")}, '') AS title,
  'Kenya' AS location FROM pages""")
def first_text(spark, sf):
    parsed = pages(spark, sf).select("page_id", dom.parse_nodes("html").alias("nodes"))
    found = parsed.withColumns({
        "t": F.expr(dom.first("nodes", [dom.Sel(("h3",)), dom.Sel(("h1",)), dom.Sel(("title",))])),
        "p": F.expr(dom.first("nodes", [dom.Sel((), "location")]))})
    return found.select(
        "page_id", F.expr(dom.text_of("nodes", "t")).alias("title"),
        F.coalesce(F.expr(dom.text_of("nodes", "p")), F.lit("Kenya")).alias("location"))


_HEADINGS = [("desc", "a"), ("req", "requirement"), ("offer", "benefit")]
_EXTRA = ("<h2>Job Requirements</h2><ul><li>first {k}</li><li><b>se</b>cond</li></ul><p>a paragraph of more than twenty</p>"
          "<p>too short</p><h3>Benefits</h3><ol><li>offered {k}</li></ol><p>a dropped paragraph below the benefits</p>")


def _headed(spark, sf):
    """Pages with lists above, sections of requirements and benefits below their own text."""
    k = F.col("page_id").cast("string")
    extra = F.replace(F.lit(_EXTRA), F.lit("{k}"), k)
    html = F.replace(F.replace(F.col("html"), F.lit("</article>"), F.concat(extra, F.lit("</article>"))),
                     F.lit("</h1>"), F.concat(F.lit("</h1><ul><li>top "), k, F.lit("</li></ul>")))
    return pages(spark, sf).select("page_id", html.alias("html"))


@query("section_by_heading", f"""WITH a AS (SELECT page_id, regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS body FROM pages),
b AS (SELECT page_id, array_to_string({_nodes("regexp_extract(body, '(?s)<h1>(.*?)</h1>', 1)")}, '') AS head,
  list_filter(list_transform(string_split(body, '<p>')[2:], lambda p: array_to_string({_nodes('p')}, '')), lambda t: length(t) > 20) AS paras FROM a)
SELECT page_id, left(array_to_string(list_concat(['top ' || page_id], CASE WHEN contains(lower(head), 'a') OR head = '' THEN paras ELSE [] END,
    ['offered ' || page_id]), chr(10)), 5000) AS description,
  array_to_string(['first ' || page_id, 'second', 'a paragraph of more than twenty'], chr(10)) AS requirements FROM b""")
def section_by_heading(spark, sf):
    return details.page_sections(_headed(spark, sf), _HEADINGS, ["page_id"], (5000, 3000))


@query("section_by_heading_whole", f"""WITH p AS (SELECT page_id, regexp_replace(html, '&amp;?', '&amp;', 'g') AS html FROM pages),
a AS (SELECT page_id, regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS body FROM p),
b AS (SELECT page_id, array_to_string({_nodes("regexp_extract(body, '(?s)<h1>(.*?)</h1>', 1)")}, '') AS head,
  list_filter(list_transform(string_split(body, '<p>')[2:], lambda p: array_to_string({_nodes('p')}, '')), lambda t: length(t) > 20) AS paras FROM a)
SELECT page_id, array_to_string(list_concat(['top ' || page_id], CASE WHEN contains(lower(head), 'a') OR head = '' THEN paras ELSE [] END,
    ['offered ' || page_id]), chr(10)) AS description,
  array_to_string(['first ' || page_id, 'second', 'a paragraph of more than twenty'], chr(10)) AS requirements FROM b""")
def section_by_heading_whole(spark, sf):
    return details.page_sections(_headed(spark, sf), _HEADINGS, ["page_id"])


_ARTICLE = "regexp_extract(html, '(?s)</h1>(.*?)</article>', 1)"


@query("section_between", f"""SELECT page_id,
  array_to_string(list_filter(list_transform(string_split(array_to_string({_nodes(_ARTICLE)}, chr(10)), chr(10)),
    lambda s: trim(s)), lambda s: s <> ''), chr(10)) AS found,
  '' AS missing FROM pages""")
def section_between(spark, sf):
    html = F.col("html")
    return pages(spark, sf).select("page_id", prose.between(html, "</h1", "</article>").alias("found"),
                                   prose.between(html, "Key Duties:", "</article>").alias("missing"))


@query("apply_link", """SELECT p_partkey AS id, 'https://ext.test/' || p_partkey || '?a=1&b=2' AS apply_url FROM part
WHERE p_partkey % 4 <> 0""")
def apply_link(spark, sf):
    html = F.expr("""concat('<p><a href="https://own.test/x">Apply here</a> <a href="/apply">apply</a> ',
      CASE WHEN p_partkey % 4 <> 0 THEN concat('<A class=b HREF="https://ext.test/', p_partkey,
        '?a=1&amp;b=2"><b>Read</b> more &amp; apply</A>') ELSE '<a href="https://ext.test/0">home</a>' END,
      ' <a href="https://ext.test/last">Apply</a>')""")
    html = F.when(F.col("p_partkey") % 4 == 0, F.replace(html, F.lit("last\">Apply"), F.lit("last\">Other"))).otherwise(html)
    rows = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), prose.apply_link(html, "own.test").alias("apply_url"))
    return rows.where("apply_url IS NOT NULL")


# --- row rules -----------------------------------------------------------


@query("dedup_first", f"""{with_views('obs')} SELECT external_id, event_id, title FROM (
  SELECT *, row_number() OVER (PARTITION BY external_id ORDER BY ts, event_id) AS r FROM obs) WHERE r = 1""")
def dedup_first_query(spark, sf):
    rows = view(spark, sf, "obs").select("external_id", "event_id", "title", "ts")
    return dedup_first(rows, ["external_id"], ["ts", "event_id"]).drop("ts")


@query("source_query_filter", f"""{J} SELECT id, title FROM jobs
  WHERE contains(lower(title), 'data') OR contains(lower(coalesce(tags, '')), 'data')""")
def source_query_filter(spark, sf):
    return query_filter(view(spark, sf, "jobs"), "DATA", ("title", "tags")).select("id", "title")


@query("join_tags", """SELECT o_custkey AS id, coalesce(string_agg(tag, ',' ORDER BY k) FILTER (tag <> ''), '') AS tags FROM (
  SELECT o_custkey, o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 3 = 1 THEN 't' || o_orderkey END AS tag
  FROM orders) GROUP BY o_custkey""")
def join_tags(spark, sf):
    tag = F.expr("CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN concat('t', o_orderkey) END")
    listed = (table(spark, sf, "orders").select("o_custkey", "o_orderkey", tag.alias("tag"))
              .groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "tag"))).alias("l")))
    return listed.select(F.col("o_custkey").alias("id"), prose.join_tags(F.col("l.tag")).alias("tags"))


@query("listing_detail_merge", f"""{J}, listing AS (SELECT id, trim(url) AS url, title, company, salary_min FROM jobs),
detail AS (SELECT 'https://e.test/jobs/' || p_partkey || '/' AS url,
  CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE '' END AS company, p_retailprice AS salary_min FROM part)
SELECT l.id, l.url, l.title, coalesce(nullif(d.company, ''), l.company) AS company,
  coalesce(d.salary_min, l.salary_min) AS salary_min FROM listing l LEFT JOIN detail d ON l.url = d.url""")
def listing_detail_merge(spark, sf):
    listing = view(spark, sf, "jobs").select("id", F.trim("url").alias("url"), "title", "company", "salary_min")
    detail = table(spark, sf, "part").selectExpr(
        "concat('https://e.test/jobs/', p_partkey, '/') AS url",
        "CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE '' END AS company", "p_retailprice AS salary_min")
    return merge_detail(listing, detail)


@query("cap_per_group", f"""{J} SELECT source, id FROM (SELECT source, id,
  row_number() OVER (PARTITION BY source ORDER BY id) AS r FROM jobs) WHERE r <= 50""")
def cap_per_group_query(spark, sf):
    return cap_per_group(view(spark, sf, "jobs").select("source", "id"), "source", 50, ["id"])
