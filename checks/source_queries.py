"""Extraction from landed payloads and pages, checked against the rows the
payloads were assembled from."""

from datetime import datetime

from pyspark.sql import functions as F

from checks import landed
from checks.fixtures import with_views, view
from checks.registry import query
from gleanery import schema, vocab
from gleanery.plans import jobs as plans
from gleanery.sources import cards, details, feeds, registry, sites, tabular
from gleanery.sources.postings import accepted, merge_detail, quarantine

K = "p_partkey"
TS = f"(TIMESTAMP '2024-01-01 10:00:00' + to_days(CAST({K} % 28 AS INTEGER)))"
GOOD = f"(CAST(floor({K} / 20) AS BIGINT) + 1) % 50 <> 8"
OUT = ["source", "external_id", "title", "company", "location", "description", "salary_min", "salary_max",
       "salary_currency", "job_type", "remote", "url", "apply_url", "tags", "requirements", "posted_date",
       "application_deadline"]
_TYPES = {"salary_min": "DOUBLE", "salary_max": "DOUBLE", "remote": "BOOLEAN", "posted_date": "TIMESTAMP",
          "application_deadline": "TIMESTAMP"}


def expected(values: dict, where: str = "TRUE") -> str:
    """SELECT over part with the posting columns; absent ones are NULL."""
    unknown = set(values) - set(OUT)
    assert not unknown, unknown
    values = {"remote": "FALSE", **values}
    values.setdefault("apply_url", values.get("url", "NULL"))
    cols = ", ".join(f"CAST({values.get(c, 'NULL')} AS {_TYPES.get(c, 'VARCHAR')}) AS {c}" for c in OUT)
    return f"SELECT {cols} FROM part WHERE {where}"


def posted(rows):
    return accepted(rows).select(*OUT)


# --- feeds ---------------------------------------------------------------

_ADZUNA = expected({
    "source": "'adzuna'", "external_id": K, "title": "p_name", "company": "p_brand",
    "location": f"CASE WHEN {K} % 3 <> 0 THEN 'Nairobi' END", "description": "p_type",
    "salary_min": "p_retailprice", "salary_max": "p_retailprice * 2", "url": f"'https://a.test/' || {K}",
    "tags": f"CASE WHEN {K} % 4 = 0 THEN '' ELSE 'it-jobs,remote' END",
    "posted_date": f"CASE WHEN {K} % 2 = 0 THEN {TS} ELSE {TS} - INTERVAL 3 HOUR END"},
    f"{GOOD} AND {K} % 10 <> 0")
_AIJOBS = expected({
    "source": "'aijobs'", "external_id": f"'a' || {K}", "title": "p_name", "company": "p_brand",
    "location": f"CASE {K} % 4 WHEN 1 THEN 'Anywhere on earth' WHEN 2 THEN 'Berlin' ELSE 'Remote' END",
    "description": "p_type", "salary_min": f"CASE WHEN {K} % 3 <> 0 THEN 1000 END", "salary_max": "p_retailprice",
    "salary_currency": "'USD'", "job_type": f"CASE WHEN {K} % 6 <> 0 THEN 'full-time' END",
    "remote": f"{K} % 5 IN (0, 1, 3) OR {K} % 4 <> 2",
    "url": f"CASE WHEN {K} % 4 = 0 THEN 'https://b.test/apply/' || {K} ELSE 'https://b.test/' || {K} END",
    "tags": f"CASE WHEN {K} % 2 = 0 THEN 'sql,go' ELSE 'sql only' END",
    "posted_date": f"CASE WHEN {K} % 2 = 0 THEN {TS} ELSE date_trunc('day', {TS}) END"}, GOOD)
_REMOTEOK = expected({
    "source": "'remoteok'", "external_id": f"CASE WHEN {K} % 5 = 0 THEN 's-' || {K} ELSE CAST({K} AS VARCHAR) END",
    "title": f"CASE WHEN {K} % 3 = 0 THEN 'T ' || p_name ELSE p_name END", "company": "p_brand",
    "location": "'Remote'", "description": "p_type", "salary_min": f"CASE WHEN {K} % 2 = 0 THEN 50000 ELSE 60 END",
    "salary_max": f"CASE WHEN {K} % 2 = 0 THEN 70000 ELSE 60 END", "salary_currency": "'USD'", "job_type": "'remote'",
    "remote": "TRUE",
    "url": f"CASE WHEN {K} % 4 = 0 THEN 'https://remoteok.com/l/s-' || {K} ELSE 'https://c.test/' || {K} END",
    "tags": "'dev,' || p_type", "posted_date": f"TIMESTAMP '2023-11-14 22:13:20' + to_seconds({K})"}, GOOD)
_REMOTIVE = expected({
    "source": "'remotive'", "external_id": K, "title": "p_name", "company": "p_brand",
    "location": f"CASE WHEN {K} % 2 = 0 THEN 'Worldwide' ELSE 'Africa' END", "description": "p_type",
    "salary_min": f"CASE {K} % 4 WHEN 0 THEN 10 WHEN 1 THEN 30 WHEN 3 THEN 40 END",
    "salary_max": f"CASE {K} % 4 WHEN 0 THEN 20 WHEN 1 THEN 30 WHEN 3 THEN 40 END",
    "salary_currency": f"CASE {K} % 4 WHEN 0 THEN 'GBP' WHEN 1 THEN 'EUR' ELSE 'USD' END",
    "job_type": f"CASE WHEN {K} % 3 = 0 THEN 'full-time' ELSE 'part-time' END", "remote": "TRUE",
    "url": f"'https://d.test/' || {K}", "tags": "'x,y'", "posted_date": TS}, GOOD)
_GREENHOUSE = expected({
    "source": "'givedirectly'", "external_id": K, "title": "p_name", "company": "'GiveDirectly'",
    "location": f"CASE WHEN {K} % 3 = 0 THEN 'Remote' ELSE 'Kisumu' END", "url": f"'https://g.test/' || {K}",
    "tags": "p_type || ',Ops'", "posted_date": TS}, GOOD)
_FEEDS = {"adzuna": _ADZUNA, "aijobs": _AIJOBS, "remoteok": _REMOTEOK, "remotive": _REMOTIVE, "greenhouse": _GREENHOUSE}


@query("api_postings", " UNION ALL ".join(_FEEDS.values()))
def api_postings(spark, sf):
    bodies, out = landed.payloads(spark, sf, tuple(_FEEDS)), None
    for name in _FEEDS:
        rows = posted(feeds.feed_postings(bodies, feeds.FEEDS[name]))
        out = rows if out is None else out.unionByName(rows)
    return out


_OPENED = expected({
    "source": "'openedcareer'", "external_id": f"'openedcareer_' || {K}", "title": "p_name || ' & co'",
    "company": "p_brand", "location": "'Nairobi, Kenya'",
    "description": "'We build ' || p_name || ' machines in Nairobi, Kenya on every single day of the year.'",
    "requirements": "concat_ws(chr(10), 'Requirements', p_type || ' & care', 'Deadline: 5th March 2025', "
                    "'Full-time, not remote', 'Apply', 'Apply now')",
    "job_type": "'Full-Time'", "url": f"'https://o.test/' || {K}", "apply_url": f"'https://x.test/' || {K}",
    "posted_date": TS, "application_deadline": "TIMESTAMP '2025-03-05'"},
    f"{GOOD} AND {K} % 5 <> 0 AND {K} % 7 <> 0")


@query("wordpress_postings", _OPENED)
def wordpress_postings(spark, sf):
    return posted(feeds.wordpress_postings(landed.payloads(spark, sf, ("openedcareer",))))


_BAMBOO = expected({
    "source": "'bamboohr'", "external_id": f"'bamboohr_delta-forty_' || {K}", "title": "p_name",
    "company": f"CASE WHEN {K} % 3 = 0 THEN 'Delta-Forty' ELSE p_brand END",
    "location": f"CASE WHEN {K} % 4 = 0 THEN '' ELSE CASE WHEN {K} % 2 = 0 THEN 'Nakuru' ELSE 'Nakuru, Rift' END"
                f" || CASE WHEN {K} % 3 = 2 THEN ' (Hybrid)' ELSE '' END END",
    "description": "'Make ' || p_name || ' parts with great care every day'",
    "requirements": "'What we need' || chr(10) || p_type", "job_type": "'Full-Time'", "remote": f"{K} % 3 = 1",
    "url": f"'https://delta-forty.bamboohr.com/careers/' || {K}", "posted_date": "TIMESTAMP '2024-02-03'"},
    f"{GOOD} AND {K} % 9 <> 0")


@query("ats_postings", _BAMBOO)
def ats_postings(spark, sf):
    return posted(feeds.ats_postings(landed.payloads(spark, sf, ("bamboohr",)), landed.detail_payloads(spark, sf)))


# --- JSON in pages -------------------------------------------------------

_LD = {
    "source": "'amref'", "title": "p_name", "external_id": f"CASE WHEN {K} % 5 = 0 THEN 'vacancies' ELSE CAST({K} AS VARCHAR) END",
    "company": f"CASE WHEN {K} % 4 = 0 THEN 'Amref Health Africa' ELSE p_brand END",
    "location": f"CASE WHEN {K} % 3 = 0 THEN 'Remote' WHEN {K} % 2 = 0 THEN 'KE' ELSE 'Mombasa' END",
    "url": f"CASE WHEN {K} % 5 = 0 THEN 'https://amref.org/vacancies/' ELSE 'https://l.test/' || {K} || '/' END",
    "description": "p_type", "posted_date": f"TIMESTAMP '2024-02-01' + to_days(CAST({K} % 9 AS INTEGER))"}


@query("jsonld_postings", expected(_LD, f"{K} % 6 <> 5") + " UNION ALL " + expected(_LD, f"{K} % 6 <> 5 AND {K} % 7 = 0"))
def jsonld_postings(spark, sf):
    return posted(feeds.ld_postings(landed.ld_pages(spark, sf)))


@query("jsonld_itemlist", expected({
    "source": "'fuzu'", "external_id": K, "title": "p_name", "location": "'Kenya'",
    "url": f"'https://f.test/j/' || {K} || '/'"}, f"{K} % 5 <> 0"))
def jsonld_itemlist(spark, sf):
    return posted(feeds.ld_itemlist(landed.itemlist_pages(spark, sf)))


@query("nextdata_postings", expected({
    "source": "'workatastartup'", "external_id": f"CASE WHEN {K} % 4 = 0 THEN 'z' || {K} ELSE CAST({K} AS VARCHAR) END",
    "title": f"CASE WHEN {K} % 3 = 0 THEN 'J ' || p_name ELSE p_name END", "company": "p_brand",
    "location": f"CASE WHEN {K} % 2 = 0 THEN 'Remote' ELSE 'Kampala' END", "remote": f"{K} % 2 = 0",
    "url": f"CASE WHEN {K} % 5 = 0 THEN 'https://w.test/jobs/z' || {K} ELSE 'https://z.test/' || {K} END"}))
def nextdata_postings(spark, sf):
    return posted(feeds.page_state_postings(landed.state_pages(spark, sf), "https://w.test"))


# --- tables --------------------------------------------------------------

_VALID = f"{K} % 5 <> 0 AND {K} % 4 <> 0"


@query("table_rows", f"""SELECT CAST(floor({K} / 20) + 1 AS INTEGER) AS page, CAST({K} % 20 + 1 AS INTEGER) AS pos,
  'R' || CAST(floor({K} / 2) AS BIGINT) AS ref, p_name || ' - ' || p_brand AS title, 'G' || p_size AS grade FROM part WHERE {_VALID}""")
def table_rows(spark, sf):
    return tabular.vacancy_rows(landed.vacancy_pages(spark, sf)).select("page", "pos", "ref", "title", "grade")


@query("table_to_list", f"""SELECT 'R' || {K} AS ref, '[Must] ' || p_type || chr(10) || 'Care' AS requirements
FROM part""")
def table_to_list(spark, sf):
    from gleanery.sources import dom
    rows = landed.vacancy_details(spark, sf).select("ref", dom.parse_nodes("html").alias("nodes"))
    return tabular.with_requirements(rows).select("ref", "requirements")


@query("institute_postings", f"""WITH first AS (SELECT CAST(floor({K} / 2) AS BIGINT) AS ref, arg_min(p_name, {K}) AS name,
  arg_min(p_brand, {K}) AS brand FROM part WHERE {_VALID} GROUP BY 1)
SELECT 'kemri' AS source, 'kemri_R' || ref AS external_id, name AS title, brand || ', Kenya' AS location,
  'Run the ' || p_name || ' machine with care every day' AS description, '[Must] ' || p_type || chr(10) || 'Care' AS requirements,
  'Contract' AS job_type, TIMESTAMP '2024-01-05' AS posted_date,
  TIMESTAMP '2024-02-01' + to_days(CAST({K} % 9 AS INTEGER)) AS application_deadline
FROM first JOIN part ON {K} = ref""")
def institute_postings(spark, sf):
    rows = tabular.institute_postings(landed.vacancy_pages(spark, sf), landed.vacancy_details(spark, sf), "https://v.test")
    return accepted(rows).select("source", "external_id", "title", "location", "description", "requirements",
                                 "job_type", "posted_date", "application_deadline")


@query("quarantine_tables", f"""SELECT CAST(floor({K} / 20) + 1 AS INTEGER) AS page, 'unparseable page' AS reject FROM part
WHERE floor({K} / 20) % 3 = 1 GROUP BY 1""")
def quarantine_tables(spark, sf):
    """List pages of tables, a third of them missing or malformed: each is reported, through the registry."""
    pages = landed.vacancy_pages(spark, sf)
    k = (F.col("page") - 1) % 3
    html = F.when((k == 1) & (F.col("page") % 2 == 0), F.concat(F.lit("<![foo[ b ]]>"), "html")).when(k != 1, F.col("html"))
    source = registry.Landed(pages=pages.withColumn("html", html), detail_pages=landed.vacancy_details(spark, sf).withColumn(
        "url", F.lit(None).cast("string")))
    return quarantine(registry.extract(source, ["kemri"])).where("reject = 'unparseable page'").select("page", "reject")


@query("undated_postings", f"""SELECT 'kemri_R' || CAST(floor({K} / 2) AS BIGINT) AS external_id,
  CASE WHEN floor({K} / 2) % 2 = 0 THEN TIMESTAMP '2024-01-05' ELSE TIMESTAMP '2024-02-01' END AS posted_date
FROM part WHERE {_VALID} AND floor({K} / 2) IN (SELECT {K} FROM part) GROUP BY 1, 2
UNION ALL SELECT 'openedcareer_' || {K}, CASE WHEN {K} % 28 < 9 THEN TIMESTAMP '2024-02-01' WHEN {K} % 28 >= 19 THEN {TS} END
FROM part WHERE {GOOD} AND {K} % 5 <> 0 AND {K} % 7 <> 0""")
def undated_postings(spark, sf):
    """Posting dates that are missing or unreadable, through a run: one source fills both, one the unreadable only."""
    own = landed.vacancy_details(spark, sf).withColumn("url", F.lit(None).cast("string"))
    odd = F.regexp_extract("ref", "([0-9]+)", 1).cast("long") % 2 == 1
    own = own.withColumn("html", F.when(odd, F.replace("html", F.lit("Advertised Date: 1/5/24"))).otherwise(F.col("html")))
    # Dates of the first nine days cannot be read, those of the next ten are not there.
    unreadable = F.regexp_replace("body", '"date_gmt":"2024-01-0', '"date_gmt":"soon-0')
    posts = landed.payloads(spark, sf, ("openedcareer",)).withColumn(
        "body", F.regexp_replace(unreadable, '"date_gmt":"2024-01-1', '"other":"2024-01-1'))
    source = registry.Landed(pages=landed.vacancy_pages(spark, sf), detail_pages=own, payloads=posts)
    empty = spark.createDataFrame([], schema.JOBS)
    run = plans.ingest(spark, source, empty, datetime(2024, 2, 1), sources=["kemri", "openedcareer"])
    return run.jobs.select("external_id", "posted_date")


# --- cards ---------------------------------------------------------------

_D = f"(1 + {K} % 9)"
_MARCH = f"TIMESTAMP '2024-03-01' + to_days(CAST({K} % 9 AS INTEGER))"


def _place(default):
    return f"CASE WHEN {K} % 3 = 0 THEN {default} ELSE 'Nairobi' END"


def _site(base, path, ext, default="'Kenya'", **more):
    return {"title": "p_name", "company": "p_brand", "location": _place(default),
            "url": f"'{base}{path.replace('{k}', chr(39) + ' || ' + K + ' || ' + chr(39))}'",
            "external_id": ext, **more}


_CARD_ROWS = {
    "linkedin": _site("https://www.linkedin.com", "/jobs/view/{k}-dev?x=1", f"{K} || '-dev'", "NULL", posted_date=_MARCH),
    "myjobsinkenya": _site("https://www.myjobsinkenya.com", "/jobs/{k}/view", K, job_type="'Contract'"),
    "brightermonday": _site("https://www.brightermonday.co.ke", "/listings/{k}?p=1", K, company="NULL", job_type="'Full Time'"),
    "indeed": _site("https://www.indeed.com", "/rc/{k}", f"'jk' || {K}", "NULL", salary_currency="'KES'",
                    salary_min=f"1000 + 100 * {_D}", salary_max=f"2000 + 100 * {_D}", description=f"'Snippet' || {K}"),
    "glassdoor": _site("https://www.glassdoor.com", "/g/{k}", f"'g' || {K}", "NULL"),
    "fuzu": _site("https://www.fuzu.com", "/kenya/jobs/x-{k}/", f"'x-' || {K}"),
    "google_search": _site("https://r.test", "/{k}", "NULL", company="NULL", location="'Kenya'", source="'google_indeed'",
                           description=f"'Found ' || {K}"),
    "jobwebkenya": _site("https://www.jobwebkenya.com", "/job/{k}/x", K, description=f"'Sum ' || {K}", application_deadline=_MARCH),
    "corporatestaffing": _site("https://www.corporatestaffing.co.ke", "/j/s{k}/", f"'s' || {K}", application_deadline=_MARCH,
                               job_type="'contract'"),
    "kenyajob": _site("https://k.test", "/s{k}", f"'s' || {K}", application_deadline=_MARCH),
    "summitrecruitment": _site("https://www.summitrecruitment-search.com", "/s{k}", f"'s' || {K}"),
    "myjobmag": _site("https://www.myjobmag.co.ke", "/job/m{k}", f"'m' || {K}", application_deadline=_MARCH, job_type="'Internship'"),
    "jobsinkenya": _site("https://www.jobsinkenya.co.ke", "/jk{k}/", f"'jk' || {K}", job_type="'Temp'"),
    "pigiame": _site("https://www.pigiame.co.ke", "/advert/p{k}", f"'p' || {K}", company="NULL", description=f"'Snip ' || {K}",
                     salary_min=f"1000 + 100 * {_D}", salary_max=f"1000 + 100 * {_D}", salary_currency="'KES'"),
    "careerpointkenya": _site("https://www.careerpointkenya.co.ke", "/c{k}", f"'c' || {K}", company="'CareerPoint Kenya'",
                              job_type="'Contract'"),
    "advanceafrica": _site("https://www.advance-africa.com", "/v{k}.html", f"'v' || {K} || '.html'"),
    "talent": _site("https://www.talent.com", "/job/{k}", f"'t' || {K}", "NULL", description=f"'Desc ' || {K}",
                    salary_min=f"1000 + 100 * {_D}", salary_max=f"2000 + 100 * {_D}", salary_currency="'USD'"),
    "weworkremotely": _site("https://weworkremotely.com", "/remote-jobs/w{k}", f"'w' || {K}", "'Remote'", job_type="'remote'", remote="TRUE"),
    "wellfound": _site("https://wellfound.com", "/jobs/f{k}", f"'f' || {K}", "'Remote'", job_type="'full-time'", remote="TRUE"),
    "indeed_uk": _site("https://www.indeed.co.uk", "/viewjob/{k}", f"'u' || {K}", "NULL", salary_currency="'GBP'",
                       salary_min=f"1000 + 100 * {_D}", salary_max=f"2000 + 100 * {_D}"),
    "workatastartup": _site("https://www.workatastartup.com", "/jobs/y{k}", f"'y' || {K}", "'Remote'"),
}
_CARD_SQL = {n: expected({"source": f"'{n}'", **v}) for n, v in _CARD_ROWS.items()}


@query("card_postings", " UNION ALL ".join(_CARD_SQL.values()))
def card_postings(spark, sf):
    """All card sites through the registry, as one union."""
    names = list(_CARD_ROWS)
    return posted(registry.extract(registry.Landed(pages=landed.card_pages(spark, sf)), names))


@query("skip_headers", _CARD_SQL["weworkremotely"])
def skip_headers(spark, sf):
    pages = landed.card_pages(spark, sf, ("weworkremotely",))
    site = next(s for s in sites.SITES if s.name == "weworkremotely")
    return posted(cards.card_postings(pages, site))


def _employer_sql(name, company, url):
    base = url.rsplit("/", 1)[0]
    return expected({
        "source": f"'{name}'", "external_id": f"'e' || {K}", "title": "p_name", "company": f"'{company}'",
        "location": _place("NULL"), "job_type": "'Contract'",
        "url": f"'{base}/vacancies/jobs/job/careers/requisition/jobdetail/remote-/e' || {K}"})


@query("employer_postings", " UNION ALL ".join(
    _employer_sql(n, c, u) for n, (c, u) in sites.EMPLOYER_URLS.items()) + " UNION ALL " + _GREENHOUSE)
def employer_postings(spark, sf):
    source = registry.Landed(pages=landed.employer_pages(spark, sf, sites.EMPLOYER_URLS),
                             payloads=landed.payloads(spark, sf, ("greenhouse",)))
    return posted(registry.extract(source, ["company_careers"]))


@query("detail_fields", f"""SELECT 'https://b.test/' || {K} AS url, p_brand AS company, 'in Mombasa' AS location,
  'part-time' AS job_type, CAST(p_size * 1000 AS DOUBLE) AS salary_min, CAST(p_size * 2000 AS DOUBLE) AS salary_max,
  'KES' AS salary_currency, concat_ws(chr(10), 'KSh ' || (p_size * 1000) || ' - ' || (p_size * 2000) || ' gross for each month',
    'Look after the ' || p_name || ' every single day') AS description,
  p_type || chr(10) || 'Care' AS requirements FROM part""")
def detail_fields(spark, sf):
    return details.detail_fields(landed.posting_pages(spark, sf), "brightermonday")


@query("detail_newest_capture", f"""SELECT 'brightermonday' AS source, 'https://b.test/' || {K} AS url,
  CASE WHEN {K} % 4 = 0 THEN 'Listed' ELSE p_brand || CASE {K} % 4 WHEN 1 THEN ' A' WHEN 2 THEN ' Z' ELSE ' M' END END AS company FROM part""")
def detail_newest_capture(spark, sf):
    """Detail pages captured up to three times, rows in no order: the newest counts, whatever it says."""
    page = landed.posting_pages(spark, sf).withColumn("k", F.regexp_extract("url", "([0-9]+)$", 1).cast("long"))
    made = page.select("*", F.explode(F.expr("""CASE k % 4 WHEN 0 THEN array()
      WHEN 1 THEN array(named_struct('t', 1, 'c', ' Z'), named_struct('t', 3, 'c', ' A'), named_struct('t', 2, 'c', ' M'))
      WHEN 2 THEN array(named_struct('t', 3, 'c', ' Z'), named_struct('t', 2, 'c', ' A'))
      ELSE array(named_struct('t', CAST(NULL AS INT), 'c', ' Z'), named_struct('t', 1, 'c', ' M')) END""")).alias("v"))
    captured = made.select("url", F.regexp_replace("html", "(<a href=\"/companies/x\">[^<]*)", F.concat(
        F.lit("$1"), F.col("v.c"))).alias("html"), F.date_add(F.lit("2024-01-01"), F.col("v.t")).cast("timestamp_ntz").alias("captured_at"))
    listing = page.select(F.lit("brightermonday").alias("source"), "url", F.lit("Listed").alias("company"))
    shuffled = captured.orderBy(F.xxhash64("url", "html"))
    return merge_detail(listing, details.detail_fields(shuffled, "brightermonday"))


# --- whole runs ----------------------------------------------------------


def some_landed(spark, sf):
    return registry.Landed(
        pages=landed.card_pages(spark, sf, ("linkedin", "indeed", "kenyajob")),
        payloads=landed.payloads(spark, sf, ("adzuna", "remotive")))


@query("union_sources", "SELECT source, external_id, title, url FROM (" + " UNION ALL ".join(
    [_CARD_SQL["linkedin"], _CARD_SQL["indeed"], _ADZUNA, _REMOTIVE]) + ")")
def union_sources(spark, sf):
    rows = registry.extract(some_landed(spark, sf), ["linkedin", "indeed", "adzuna", "remotive"])
    return accepted(rows).select("source", "external_id", "title", "url")


_PLANNED = [(s, n) for s, _, _, n in vocab.DAILY_PLAN]


@query("source_plan_limit", "WITH plan(source, max_pages) AS (VALUES " + ", ".join(
    f"('{s}', {n})" for s, n in _PLANNED) + """), landed AS (
  SELECT s.source, CAST(floor(p_partkey / 20) + 1 AS INTEGER) AS page FROM part,
    (SELECT unnest(['linkedin', 'indeed', 'kenyajob']) AS source) s)
SELECT DISTINCT source, page FROM landed JOIN plan USING (source) WHERE page <= max_pages""")
def source_plan_limit(spark, sf):
    plan = registry.plan_table(spark, vocab.DAILY_PLAN)
    return some_landed(spark, sf).limited(plan).pages.select("source", "page")


@query("planned_search", f"""SELECT DISTINCT 'page' AS kind, 'linkedin' AS source, CAST(floor({K} / 20) + 1 AS INTEGER) AS page FROM part
WHERE CAST(floor({K} / 20) + 1 AS INTEGER) <= 2 AND CAST(floor({K} / 20) AS INTEGER) % 2 = 0
UNION ALL SELECT 'run', 'aijobs', CAST(count(*) AS INTEGER) FROM part WHERE {GOOD} AND contains(lower(p_name), 'green')""")
def planned_search(spark, sf):
    """A plan's words: pages fetched for another search do not count, feeds search their own rows."""
    pages = landed.card_pages(spark, sf, ("linkedin",)).withColumns({
        "search_query": F.when(F.col("page") % 2 == 1, "developer").otherwise("software developer"),
        "location": F.lit("Kenya")})
    kept = registry.Landed(pages=pages).limited(registry.plan_table(spark, vocab.QUICK_PLAN)).pages
    feed = registry.Landed(payloads=landed.payloads(spark, sf, ("aijobs",)))
    found = accepted(registry.extract(feed, ["aijobs"], {"aijobs": "green", "remoteok": "steel"}))
    return kept.select(F.lit("page").alias("kind"), "source", "page").distinct().unionByName(
        found.agg(F.count("*").cast("int").alias("page")).select(F.lit("run").alias("kind"), F.lit("aijobs").alias("source"), "page"))


_BAD = f"count(DISTINCT floor({K} / 20)) FILTER (NOT ({GOOD}))"


@query("quarantine", f"""SELECT * FROM (
SELECT 'adzuna' AS run, 'malformed body' AS reject, {_BAD} AS count FROM part
UNION ALL SELECT 'adzuna', 'no title', count(*) FROM part WHERE {GOOD} AND {K} % 10 = 0
UNION ALL SELECT 'openedcareer', 'malformed body', {_BAD} FROM part
UNION ALL SELECT 'openedcareer', 'no direct apply link', count(*) FROM part WHERE {GOOD} AND {K} % 5 = 0
UNION ALL SELECT 'openedcareer', 'short description', count(*) FROM part WHERE {GOOD} AND {K} % 5 <> 0 AND {K} % 7 = 0
UNION ALL SELECT 'bamboohr', 'malformed body', {_BAD} FROM part
UNION ALL SELECT 'bamboohr', 'short description', count(*) FROM part WHERE {GOOD} AND {K} % 9 = 0) WHERE count > 0""")
def quarantine_query(spark, sf):
    names = ("adzuna", "openedcareer", "bamboohr")
    source = registry.Landed(payloads=landed.payloads(spark, sf, names), detail_payloads=landed.detail_payloads(spark, sf))
    rows = quarantine(registry.extract(source, list(names)))
    return rows.groupBy("run", "reject").agg(F.count("*").alias("count"))


@query("overlong_rows", f"""{with_views('jobs')} SELECT id, CASE WHEN id % 50 = 0 THEN 'overlong title'
  WHEN id % 70 = 0 THEN 'overlong url' END AS reject FROM jobs""")
def overlong_rows(spark, sf):
    from gleanery.sources.postings import check_widths
    rows = view(spark, sf, "jobs").withColumns({
        "title": F.when(F.col("id") % 50 == 0, F.repeat(F.lit("x"), 501)).otherwise(F.col("title")),
        "url": F.when(F.col("id") % 70 == 0, F.repeat(F.lit("u"), 1001)).otherwise(F.col("url")),
        "reject": F.lit(None).cast("string")})
    return check_widths(rows).select("id", "reject")
