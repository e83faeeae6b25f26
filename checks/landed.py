"""Landed payloads and pages assembled from rows of `part`.

k is p_partkey; twenty items make one JSON body, and every fiftieth body is cut
short so that it cannot be parsed.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.fixtures import table

PER_PAGE = 20
STAMP = "concat('2024-01-', lpad(CAST(1 + p_partkey % 28 AS STRING), 2, '0'), 'T10:00:00')"

# JSON of one item, per feed.
_ITEMS = {
    "adzuna": f"""to_json(named_struct('id', p_partkey, 'title', IF(p_partkey % 10 = 0, '', p_name),
      'company', named_struct('display_name', p_brand), 'location', named_struct('display_name', IF(p_partkey % 3 = 0, NULL, 'Nairobi')),
      'description', p_type, 'salary_min', p_retailprice, 'salary_max', p_retailprice * 2,
      'redirect_url', concat('https://a.test/', p_partkey), 'created', concat({STAMP}, IF(p_partkey % 2 = 0, 'Z', '+03:00')),
      'category', named_struct('tag', IF(p_partkey % 4 = 0, NULL, 'it-jobs  remote'))))""",
    "aijobs": f"""concat('{{"remote": ', element_at(array('true', '"yes"', '0', '1', 'null'), CAST(p_partkey % 5 + 1 AS INT)),
      ', "job_skills": ', IF(p_partkey % 2 = 0, '["sql","go"]', '"sql only"'), ', "salary_from": "', IF(p_partkey % 3 = 0, 'n/a', '1000'), '", ',
      substr(to_json(named_struct('id', concat('a', p_partkey), 'job_title', p_name, 'company_name', p_brand,
      'url', IF(p_partkey % 4 = 0, '', concat('https://b.test/', p_partkey)), 'apply_url', concat('https://b.test/apply/', p_partkey),
      'job_location', element_at(array('Remote', 'Anywhere on earth', 'Berlin', ''), CAST(p_partkey % 4 + 1 AS INT)),
      'job_description', p_type, 'salary_to', p_retailprice, 'published', IF(p_partkey % 2 = 0, {STAMP}, left({STAMP}, 10)),
      'job_type', IF(p_partkey % 6 = 0, NULL, 'Full_Time'))), 2))""",
    "remoteok": f"""to_json(named_struct('id', IF(p_partkey % 5 = 0, NULL, p_partkey), 'slug', concat('s-', p_partkey),
      'position', IF(p_partkey % 3 = 0, '', p_name), 'title', concat('T ', p_name), 'company', p_brand,
      'url', IF(p_partkey % 4 = 0, NULL, concat('https://c.test/', p_partkey)), 'tags', array('dev', p_type),
      'description', p_type, 'epoch', 1700000000 + p_partkey, 'salary', IF(p_partkey % 2 = 0, '$50,000 - 70,000', '60k')))""",
    "remotive": f"""to_json(named_struct('id', p_partkey, 'title', p_name, 'company_name', p_brand, 'url', concat('https://d.test/', p_partkey),
      'candidate_required_location', IF(p_partkey % 2 = 0, '', 'Africa'), 'description', p_type, 'tags', array('x', 'y'),
      'job_type', IF(p_partkey % 3 = 0, NULL, 'part_time'), 'salary', element_at(array('£10 - £20', '30 eur', '', '40 USD'), CAST(p_partkey % 4 + 1 AS INT)),
      'publication_date', concat({STAMP}, '.123')))""",
    "greenhouse": f"""to_json(named_struct('id', p_partkey, 'title', p_name, 'absolute_url', concat('https://g.test/', p_partkey),
      'location', IF(p_partkey % 3 = 0, NULL, named_struct('name', 'Kisumu')),
      'departments', array(named_struct('name', p_type), named_struct('name', ''), named_struct('name', 'Ops')),
      'updated_at', concat({STAMP}, '-04:00')))""",
    "openedcareer": f"""to_json(named_struct('id', p_partkey, 'date_gmt', {STAMP}, 'link', concat('https://o.test/', p_partkey),
      'title', named_struct('rendered', concat(p_name, ' &amp; co at ', p_brand)),
      'content', named_struct('rendered', concat('<p>Skip to content</p><p>We build ', p_name,
        IF(p_partkey % 7 = 0, '', ' machines in Nairobi, Kenya on every single day of the year.'), '</p><h3>Requirements</h3><ul><li>', p_type,
        ' &amp; care</li><li>Deadline: 5th March 2025</li></ul><p>Full-time, not remote</p><a href="https://openedcareer.com/x">Apply</a>',
        IF(p_partkey % 5 = 0, '', concat('<a href="https://x.test/', p_partkey, '">Apply now</a>'))))))""",
    "bamboohr": """to_json(named_struct('id', p_partkey, 'jobOpeningName', concat(' ', p_name), 'departmentLabel', IF(p_partkey % 3 = 0, NULL, p_brand),
      'employmentStatusLabel', 'Full-Time', 'location', named_struct('city', IF(p_partkey % 4 = 0, NULL, 'Nakuru'), 'state', IF(p_partkey % 2 = 0, '', 'Rift')),
      'locationType', p_partkey % 3))""",
}
_WRAP = {
    "adzuna": ('{"results":[', "]}"), "aijobs": ("[", "]"), "remoteok": ('[{"legal":"metadata"},', "]"),
    "remotive": ('{"jobs":[', "]}"), "greenhouse": ('{"jobs":[', "]}"), "openedcareer": ("[", "]"),
    "bamboohr": ('{"result":[', "]}"),
}


def part(spark, sf) -> DataFrame:
    return table(spark, sf, "part")


def payloads(spark, sf, names=tuple(_ITEMS)) -> DataFrame:
    """payloads(source, page, body, site, company), pages counted from 1."""
    out = None
    for name in names:
        head, tail = _WRAP[name]
        rows = part(spark, sf).select(
            (F.floor(F.col("p_partkey") / PER_PAGE) + 1).cast("int").alias("page"),
            F.col("p_partkey").alias("k"), F.expr(_ITEMS[name]).alias("j"))
        # A page holds twenty items, so the list per group is bounded.
        joined = rows.groupBy("page").agg(F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("k", "j"))), lambda s: s["j"]), ",").alias("b"))
        body = F.concat(F.lit(head), "b", F.lit(tail))
        body = F.when(F.col("page") % 50 == 8, F.left(body, F.length(body) - 5)).otherwise(body)
        site = {"greenhouse": "givedirectly", "bamboohr": "delta-forty"}.get(name)
        rows = joined.select(F.lit(name).alias("source"), "page", body.alias("body"),
                             F.lit(site).cast("string").alias("site"),
                             F.lit("GiveDirectly" if name == "greenhouse" else None).cast("string").alias("company"))
        out = rows if out is None else out.unionByName(rows)
    return out


def detail_payloads(spark, sf) -> DataFrame:
    body = F.expr("""to_json(named_struct('result', named_struct('jobOpening', named_struct(
      'description', IF(p_partkey % 9 = 0, '', concat('<p>Make ', p_name, ' parts with great care every day</p><p>What we need</p><p>', p_type, '</p>')),
      'datePosted', '2024-02-03'))))""")
    return part(spark, sf).select(
        F.lit("delta-forty").alias("site"), F.col("p_partkey").cast("string").alias("item_id"), body.alias("body"))


# --- card pages ----------------------------------------------------------

# One card per site; {k}, {name}, {brand} come from the row. The element of the
# place is left out in every third card.
_CARDS = {
    "linkedin": '<div class="base-card x"><a href="/jobs/view/{k}-dev?x=1"><h3> {name} </h3></a><h4>{brand}</h4>{place}<time datetime="2024-03-0{d}">now</time></div>',
    "myjobsinkenya": '<div class="job-list"><h4><a href="/jobs/{k}/view">{name}</a></h4><span class="company"><a>{brand}</a></span>{place}<span class="job-type-x"><a>Contract</a></span></div>',
    "brightermonday": '<div data-cy="listing-cards-components"><a data-cy="listing-title-link" href="/listings/{k}?p=1"><p class="text-blue-700">{name}</p></a><span class="rounded bg-brand"> Full Time</span>{place}</div>',
    "indeed": '<div class="job_seen_beacon" data-jk="jk{k}"><h2 class="jobTitle"><a href="/rc/{k}">{name}</a></h2><span class="companyName">{brand}</span>{place}<div class="salary-x">KSh 1,{d}00 - 2,{d}00</div><div class="job-snippet">Snippet <b>{k}</b></div></div>',
    "glassdoor": '<li class="react-job-listing" data-id="" data-job-id="g{k}"><a class="jobTitle" href="/g/{k}">{name}</a><div class="employer">{brand}</div>{place}<span class="salary">1,{d}00 only</span></li>',
    "fuzu": '<div class="job-card"><h3>{name}</h3><a href="/kenya/jobs/x-{k}/">go</a><span class="company">{brand}</span>{place}</div>',
    "google_search": '<div class="g"><a href="https://r.test/{k}"><h3>{name}</h3></a><div class="snippet">Found {k}</div></div>',
    "jobwebkenya": '<article class="job-listing"><h2 class="title"><a href="/job/{k}/x">{name}</a></h2><i class="employer">{brand}</i>{place}<i class="expires">Expires: 0{d}/03/2024</i><i class="summary">Sum {k}</i></article>',
    "corporatestaffing": '<div class="job_listing"><h2 class="entry"><a href="/j/s{k}/">{name}</a></h2><i class="company">{brand}</i>{place}<i class="date">Date: 0{d} March 2024</i><i class="type">Contract</i></div>',
    "kenyajob": '<article><h3 class="heading"><a href="https://k.test/s{k}">{name}</a></h3><i class="company">{brand}</i>{place}<i class="closing">closing date 2024-03-0{d}</i></article>',
    "summitrecruitment": '<li class="vacancy"><a class="title" href="/s{k}">{name}</a><i class="company">{brand}</i>{place}</li>',
    "myjobmag": '<li class="job-list-li"><h2 class="job-name"><a href="/job/m{k}">{name}</a></h2><i class="recruiter">{brand}</i>{place}<i class="jobtype">Internship</i><i class="deadline">Deadline: 0{d} Mar 2024</i></li>',
    "jobsinkenya": '<div class="job-post"><a class="job-name" href="/jk{k}/">{name}</a><i class="org">{brand}</i>{place}<i class="employment">Temp</i></div>',
    "pigiame": '<article class="listing"><h3>{name}</h3><a href="/advert/p{k}">see</a><i class="price">KSh 1,{d}00</i>{place}<i class="snippet">Snip {k}</i></article>',
    "careerpointkenya": '<article><h2 class="title"><a href="/c{k}">{name}</a></h2>{place}<i class="contract">Contract</i></article>',
    "advanceafrica": '<li class="vacancy"><h4 class="title"><a href="/v{k}.html">{name}</a></h4><i class="employer">{brand}</i>{place}</li>',
    "talent": '<div class="card" data-job-id="t{k}"><h2 class="title">{name}</h2><a href="/job/{k}">x</a><i class="company">{brand}</i>{place}<i class="wage">$1,{d}00 - $2,{d}00</i><i class="desc">Desc {k}</i></div>',
    "weworkremotely": '<li><a href="/remote-jobs/w{k}"><span class="title">{name}</span></a><span class="company">{brand}</span>{place}</li>',
    "wellfound": '<div data-test="StartupResult"><h2 class="role">{name}</h2><a href="/jobs/f{k}">x</a><i class="startup">{brand}</i>{place}</div>',
    "indeed_uk": '<div class="job_seen_beacon"><h2 class="title">{name}</h2><a href="/viewjob/{k}" data-jk="u{k}">x</a><i class="company">{brand}</i>{place}<i class="salary">£1,{d}00 - £2,{d}00</i></div>',
    "workatastartup": '<div class="job-card"><h2>{name}</h2><a href="/jobs/y{k}">x</a><i class="company">{brand}</i>{place}</div>',
}
_EMPLOYER_CARD = '<article class="vacancy job-card job-listing"><h2><a href="/vacancies/jobs/job/careers/requisition/jobdetail/remote-/e{k}">{name}</a></h2>{place}<i class="contract">Contract</i></article>'
_PLACES = {"linkedin": '<span class="location">Nairobi</span>', "glassdoor": '<span class="loc">Nairobi</span>',
           "myjobsinkenya": '<span class="office-location">Nairobi</span>', "fuzu": '<span class="location">Nairobi</span>',
           "brightermonday": '<span class="rounded bg-brand">Nairobi</span>', "indeed": '<div class="location">Nairobi</div>'}
_OPEN = {"weworkremotely": ('<ul class="jobs"><li class="flag">Header</li>', "</ul>")}


def _fill(template: str, place: str):
    out = F.lit(template)
    place_col = F.when(F.col("p_partkey") % 3 == 0, F.lit("")).otherwise(F.lit(place))
    for mark, value in (("{place}", place_col), ("{k}", F.col("p_partkey").cast("string")),
                        ("{name}", F.col("p_name")), ("{brand}", F.col("p_brand")),
                        ("{d}", (1 + F.col("p_partkey") % 9).cast("string"))):
        out = F.replace(out, F.lit(mark), value)
    return out


def _landed_pages(spark, sf, source, template, place, site, company, site_url, wrap=("", "")):
    cards = part(spark, sf).select((F.floor(F.col("p_partkey") / PER_PAGE) + 1).cast("int").alias("page"),
                                   F.col("p_partkey").alias("k"), _fill(template, place).alias("h"))
    joined = cards.groupBy("page").agg(F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("k", "h"))), lambda s: s["h"]), "\n").alias("b"))
    html = F.concat(F.lit("<html><body><header><h1>Jobs</h1></header>" + wrap[0]), "b",
                    F.lit(wrap[1] + "<footer>about</footer></body></html>"))
    return joined.select(F.lit(source).alias("source"), "page", html.alias("html"), F.lit(site).alias("site"),
                         F.lit(company).alias("company"), F.lit(site_url).alias("site_url"))


def card_pages(spark, sf, names=tuple(_CARDS)) -> DataFrame:
    out = None
    for name in names:
        site = "indeed.com" if name == "google_search" else None
        rows = _landed_pages(spark, sf, name, _CARDS[name], _PLACES.get(name, '<i class="location">Nairobi</i>'),
                             site, None, None, _OPEN.get(name, ("", "")))
        rows = rows.withColumns({c: F.col(c).cast("string") for c in ("site", "company", "site_url")})
        out = rows if out is None else out.unionByName(rows)
    return out


def employer_pages(spark, sf, employers: dict) -> DataFrame:
    out = None
    for name, (company, url) in employers.items():
        rows = _landed_pages(spark, sf, "company_careers", _EMPLOYER_CARD, '<i class="city">Nairobi</i>', name, company, url)
        out = rows if out is None else out.unionByName(rows)
    return out


# --- structured data in pages ---------------------------------------------


def ld_pages(spark, sf) -> DataFrame:
    """A page per row: one JobPosting (alone, in a list, or beside bad JSON)."""
    posting = """to_json(named_struct('@type', IF(p_partkey % 6 = 5, 'Event', 'JobPosting'), 'title', p_name,
      'hiringOrganization', IF(p_partkey % 4 = 0, NULL, named_struct('name', p_brand)),
      'jobLocation', IF(p_partkey % 3 = 0, NULL, named_struct('address', named_struct(
        'addressLocality', IF(p_partkey % 2 = 0, '', 'Mombasa'), 'addressCountry', 'KE'))),
      'url', IF(p_partkey % 5 = 0, NULL, concat('https://l.test/', p_partkey, '/')), 'description', p_type,
      'datePosted', concat('2024-02-0', 1 + p_partkey % 9, 'T08:00:00Z')))"""
    script = f"""concat('<script type="application/ld+json">', IF(p_partkey % 7 = 0, concat('[', {posting}, ',', {posting}, ']'), {posting}),
      '</script>', IF(p_partkey % 11 = 0, '<script type="application/ld+json">{{broken</script>', ''))""".replace("{{", "{")
    return part(spark, sf).select(
        F.col("p_partkey").alias("page"), F.lit("amref").alias("source"), F.lit("Amref Health Africa").alias("company"),
        F.lit("https://amref.org/vacancies/").alias("site_url"),
        F.concat(F.lit("<html><head>"), F.expr(script), F.lit("</head><body>x</body></html>")).alias("html"))


def itemlist_pages(spark, sf) -> DataFrame:
    item = """to_json(named_struct('name', IF(p_partkey % 5 = 0, '', p_name), 'url', concat('https://f.test/j/', p_partkey, '/')))"""
    rows = part(spark, sf).select((F.floor(F.col("p_partkey") / PER_PAGE) + 1).cast("int").alias("page"),
                                  F.col("p_partkey").alias("k"), F.expr(item).alias("j"))
    joined = rows.groupBy("page").agg(F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("k", "j"))), lambda s: s["j"]), ",").alias("b"))
    return joined.select("page", F.lit("fuzu").alias("source"), F.concat(
        F.lit("<html><script type='application/ld+json'>{\"@type\":\"ItemList\",\"itemListElement\":["), "b",
        F.lit("]}</script></html>")).alias("html"))


def state_pages(spark, sf) -> DataFrame:
    item = """to_json(named_struct('id', IF(p_partkey % 4 = 0, NULL, p_partkey), 'slug', concat('z', p_partkey),
      'title', IF(p_partkey % 3 = 0, NULL, p_name), 'job_title', concat('J ', p_name), 'company', named_struct('name', p_brand),
      'location', IF(p_partkey % 2 = 0, NULL, 'Kampala'), 'url', IF(p_partkey % 5 = 0, NULL, concat('https://z.test/', p_partkey)),
      'remote', p_partkey % 2 = 0))"""
    rows = part(spark, sf).select((F.floor(F.col("p_partkey") / PER_PAGE) + 1).cast("int").alias("page"),
                                  F.col("p_partkey").alias("k"), F.expr(item).alias("j"))
    joined = rows.groupBy("page").agg(F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("k", "j"))), lambda s: s["j"]), ",").alias("b"))
    props = F.when(F.col("page") % 2 == 0, F.concat(F.lit('"jobs":['), "b", F.lit("]"))).otherwise(
        F.concat(F.lit('"jobs":[],"results":['), "b", F.lit("]")))
    return joined.select("page", F.lit("workatastartup").alias("source"), F.concat(
        F.lit('<html><script id="__NEXT_DATA__" type="application/json">{"props":{"pageProps":{'), props,
        F.lit("}}}</script></html>")).alias("html"))


def posting_pages(spark, sf) -> DataFrame:
    """A detail page per row, for the sources that have them."""
    html = F.expr("""concat('<nav><p>Kenya and a long menu entry over there</p></nav><main><a href="/companies/x">', p_brand,
      '</a><p>KSh ', CAST(p_size * 1000 AS STRING), ' - ', CAST(p_size * 2000 AS STRING), ' gross for each month</p><span>in Mombasa</span>',
      '<p>Part time</p><h2>Job summary</h2><p>Look after the ', p_name, ' every single day</p><h2>Requirements</h2><ul><li>',
      p_type, '</li><li>Care</li></ul><h3>Benefits</h3><p>nothing of this paragraph is kept</p></main>')""")
    return part(spark, sf).select(F.lit("brightermonday").alias("source"),
                                  F.concat(F.lit("https://b.test/"), F.col("p_partkey")).alias("url"), html.alias("html"))


# --- tables --------------------------------------------------------------


def vacancy_pages(spark, sf) -> DataFrame:
    row = """concat('<tr><td> R', CAST(floor(p_partkey / 2) AS BIGINT), ' </td><td>', p_name, ' - ', p_brand, '</td><td>Contract</td><td>1</td><td>x</td><td>G',
      p_size, '</td>', IF(p_partkey % 5 = 0, '', concat('<td>', IF(p_partkey % 4 = 0, 'Closed', 'ACTIVE'), '</td>')), '</tr>')"""
    rows = part(spark, sf).select((F.floor(F.col("p_partkey") / PER_PAGE) + 1).cast("int").alias("page"),
                                  F.col("p_partkey").alias("k"), F.expr(row).alias("r"))
    joined = rows.groupBy("page").agg(F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("k", "r"))), lambda s: s["r"]), "").alias("b"))
    return joined.select("page", F.lit("kemri").alias("source"), F.concat(
        F.lit("<table><thead><tr><th>Ref</th><th>Title</th></tr></thead><tbody>"), "b",
        F.lit("</tbody></table>")).alias("html"))


def vacancy_details(spark, sf) -> DataFrame:
    html = F.expr("""concat('<h3>x</h3><h4>Key Responsibilities:</h4><p>Run the ', p_name, ' machine with care every day</p>',
      '<h4>Vacancy Requirements:</h4><table><tr><th>#</th><th>Need</th><th>P</th></tr><tr><td>1</td><td>', p_type,
      '</td><td>Must</td></tr><tr><td>2</td><td>Care</td><td></td></tr><tr><td>3</td><td></td><td>x</td></tr></table>',
      '<p>Advertised Date: 1/5/24</p><p>Closing Date: 2/', 1 + p_partkey % 9, '/24</p>')""")
    return part(spark, sf).select(
        F.lit("kemri").alias("source"), F.concat(F.lit("R"), F.col("p_partkey")).alias("ref"), html.alias("html"))
