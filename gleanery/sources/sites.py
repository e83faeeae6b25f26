"""Card sites: selectors, defaults and id rules.

Fixed values: the tag names, class patterns, base urls and defaults follow the
markup of the sites and must stay as they are.
"""

from pyspark.sql import functions as F

from gleanery import vocab
from gleanery.functions.prose import remote_in_title_or_place
from gleanery.functions.text import blank_to_null
from gleanery.functions.urls import captured, last_segment, slug_or_title, source_from_site
from gleanery.sources.cards import OF_CARD, OF_TITLE, CardSite, attribute
from gleanery.sources.dom import Sel, attr, word

HEADS = ("h2", "h3", "h4")
ANY_LINK = Sel(("a",), attrs=(("href", ""),))


def cls(pattern: str, *tags: str) -> Sel:
    return Sel(tags, pattern)


def exact(pattern: str, *tags: str) -> Sel:
    """Case-sensitive class pattern."""
    return Sel(tags, pattern, ignore_case=False)


def by_class(*names: str) -> tuple:
    return tuple(Sel((), word(n), ignore_case=False) for n in names)


def href(pattern: str, *, ignore_case: bool = False) -> Sel:
    return Sel(("a",), attrs=(("href", pattern),), ignore_case=ignore_case)


def id_last_segment(url, href, title, card, link):
    return last_segment(url)


def id_href_segment(url, href, title, card, link):
    return last_segment(href)


def id_slug(url, href, title, card, link):
    return slug_or_title(url, title)


def id_digits(url, href, title, card, link):
    return slug_or_title(url, title, r"/(\d+)")


def id_pattern(pattern):
    return lambda url, href, title, card, link: captured(url, pattern)


def id_job_key(url, href, title, card, link):
    return F.coalesce(blank_to_null(attr(card, "data-jk")), blank_to_null(attr(link, "data-jk")),
                      last_segment(href))


def id_job_id(url, href, title, card, link):
    return F.coalesce(blank_to_null(attr(card, "data-job-id")), last_segment(href))


def _own_link(element):
    """The link inside an element, else the element."""
    return [Sel(("a",), within=element), element]


_JOB_DIV = cls("job|listing|vacancy", "div")
_JOBS_KES = ([(["$"], "USD")], "KES")
_JOBS_GBP = ([(["$"], "USD")], "GBP")
_KES_ONLY = ([], "KES")

SITES = [
    CardSite(
        "linkedin", "https://www.linkedin.com",
        cards=[exact("base-card|job-search-card", "div"), exact("result-card", "li")],
        title=[Sel(("h3",)), exact("title|job-title", "span")], link=[ANY_LINK],
        company=[Sel(("h4",)), exact("company|subtitle", "a")],
        location=[exact("location|job-search-card__location", "span")],
        posted=([Sel(("time",))], "datetime"), remote=remote_in_title_or_place,
        external_id=id_pattern(r"/view/([^/?]+)")),
    CardSite(
        "myjobsinkenya", "https://www.myjobsinkenya.com",
        cards=[exact(word("job-list"), "div")],
        title=[Sel(("a",), attrs=(("href", ""),), within=Sel(("h4",))), ANY_LINK],
        title_in=[Sel(("h4",))],
        company=_own_link(exact(word("company"), "span")),
        location=_own_link(exact(word("office-location"), "span")),
        job_type=_own_link(exact("job-type", "span")),
        defaults={"location": "Kenya"}, external_id=id_pattern(r"/jobs/([^/]+)/view")),
    CardSite(
        "brightermonday", "https://www.brightermonday.co.ke",
        cards=[Sel((), attrs=(("data-cy", "^listing-cards-components$"),), ignore_case=False),
               Sel(("div",), attrs=(("aria-labelledby", "job"),), ignore_case=False)],
        title=[Sel(("a",), attrs=(("data-cy", "^listing-title-link$"),), ignore_case=False),
               href("/listings/")],
        company=[exact("text-blue-700", "p")], company_outside_title=True,
        chips=[exact("rounded.*bg-brand|bg-brand.*rounded", "span"), exact("rounded", "span")],
        external_id=id_pattern(r"/listings/([^/?]+)")),
    CardSite(
        "indeed", "https://www.indeed.com",
        cards=[exact("job_seen_beacon|cardOutline|result", "div"),
               Sel(("td",), attrs=(("id", "resultsCol"),), ignore_case=False)],
        title=[exact("jobTitle|title", "h2"), exact("title|jcs-JobTitle", "a")],
        link=[ANY_LINK], link_mode="root",
        company=[exact("company|companyName", "span")],
        location=[exact("companyLocation|location", "div")],
        description=[exact("job-snippet|summary", "div")],
        salary=[exact("salary|estimated-salary", "div")], salary_mode="min_only",
        salary_rules=_KES_ONLY, strict_salary=True, external_id=attribute("data-jk", "id")),
    CardSite(
        "glassdoor", "https://www.glassdoor.com",
        cards=[exact("react-job-listing|jl", "li"), exact("jobCard", "div")],
        title=[exact("jobTitle|job-title", "a")], link=[ANY_LINK],
        company=[exact("employer|companyName", "div")], location=[exact("loc|location", "span")],
        salary=[exact("salary|compensation", "span")], salary_mode="pair_only", strict_salary=True,
        external_id=attribute("data-id", "data-job-id")),
    CardSite(
        "fuzu", "https://www.fuzu.com",
        cards=[exact("job-card|job-listing", "div"), href("/kenya/jobs/")],
        title=[Sel(("h2",)), Sel(("h3",)), exact("title", "span")], card_text_title=True,
        link=[OF_CARD, ANY_LINK], company=[exact("company|employer", "span")],
        location=[exact("location", "span")], defaults={"location": "Kenya"},
        external_id=id_last_segment),
    CardSite(
        "google_search", "",
        cards=[exact(word("g"), "div"), exact("tF2Cxc|g", "div")],
        title=[Sel(("h3",), within=ANY_LINK)], link=[ANY_LINK], link_mode="http", need_link=True,
        title_in_link=True,
        description=[exact("VwiC3b|snippet", "div")], constants={"location": "Kenya", "source": lambda: source_from_site(F.col("site"))}),
    CardSite(
        "jobwebkenya", "https://www.jobwebkenya.com",
        cards=[(Sel(("article",), word("job-listing")), *by_class("job-item", "listing-item"),
                exact("job", "div")), _JOB_DIV],
        title=[cls("title|heading", *HEADS, "a"), Sel(("a",))], min_title=3,
        company=[cls("company|employer|org")], location=[cls("location|place|city")],
        deadline=[cls("deadline|closing|expir")], description=[cls("desc|summary|excerpt")],
        defaults={"location": "Kenya"}, external_id=id_digits),
    CardSite(
        "corporatestaffing", "https://www.corporatestaffing.co.ke",
        cards=[(Sel(("div",), word("job_listing")), *by_class("job-item", "type-job_listing"),
                Sel(("article",), word("post"))), _JOB_DIV],
        title=[cls("title|heading|entry", "h2", "h3", "a"), Sel(("a",))], min_title=3,
        company=[cls("company|employer")], location=[cls("location|place")],
        deadline=[cls("deadline|closing|date")], deadline_label=vocab.DEADLINE_LABEL_WITH_DATE,
        job_type=[cls("type|employment")], lower_type=True, description=[cls("desc|summary|content")],
        defaults={"location": "Kenya"}, external_id=id_slug),
    CardSite(
        "kenyajob", "https://www.kenyajob.com",
        cards=[(*by_class("job-listing", "job-item", "vacancy-item"), Sel(("article",))), _JOB_DIV],
        title=[cls("title|heading", *HEADS, "a"), Sel(("a",))], min_title=3,
        company=[cls("company|employer")], location=[cls("location|place")],
        deadline=[cls("deadline|closing|expir")], deadline_formats=vocab.DEADLINE_FORMATS_5,
        description=[cls("desc|summary|excerpt")],
        defaults={"location": "Kenya"}, external_id=id_slug),
    CardSite(
        "summitrecruitment", "https://www.summitrecruitment-search.com",
        cards=[(*by_class("job-listing", "job-item", "vacancy", "job_listing"), Sel(("article",))),
               _JOB_DIV],
        title=[cls("title|heading", *HEADS, "a"), Sel(("a",))], min_title=3,
        company=[cls("company|employer")], location=[cls("location|place")],
        deadline=[cls("deadline|closing")], deadline_formats=vocab.DEADLINE_FORMATS_5,
        defaults={"location": "Kenya"}, external_id=id_slug),
    CardSite(
        "myjobmag", "https://www.myjobmag.co.ke",
        cards=[(Sel(("article",), word("job-list")), Sel(("li",), word("job-list-li")),
                Sel(("div",), word("job-item"))),
               cls("job", "article"), Sel(("li",), attrs=(("data-job-id", ""),))],
        title=[cls("title|job-name", *HEADS), cls("title", "a"), Sel(("a",))], min_title=3,
        link=[OF_TITLE, href("/job/")],
        company=[cls("company|employer|recruiter")], location=[cls("location|city")],
        job_type=[cls("job.?type|employment.?type")], deadline=[cls("deadline|closing|expir")],
        deadline_label=vocab.DEADLINE_LABEL_SHORT, deadline_formats=vocab.DEADLINE_FORMATS_4,
        defaults={"location": "Kenya"}, external_id=id_last_segment),
    CardSite(
        "jobsinkenya", "https://www.jobsinkenya.co.ke",
        cards=[(*by_class("job-listing", "job-post"), Sel(("article",), word("job"))),
               cls("job.?(listing|post|card|item)", "article", "div")],
        title=[cls("title|heading|job.name", *HEADS, "a"), Sel(("a",))], min_title=3,
        company=[cls("company|employer|org")], location=[cls("location|city")],
        job_type=[cls("type|employment")], defaults={"location": "Kenya"},
        external_id=id_last_segment),
    CardSite(
        "pigiame", "https://www.pigiame.co.ke",
        cards=[cls("listing|ad", "article"), cls("listing.?item|ad.?card", "div"),
               (Sel(("li",), within=Sel((), word("advert-list"))),
                Sel(("li",), within=Sel((), word("listings"))))],
        title=[Sel(HEADS), cls("title", "a")], min_title=3,
        link=[href("/jobs?/|/advert/"), Sel(("a",))],
        location=[cls("location|area|city")], description=[cls("desc|snippet|summary")],
        salary=[cls("price|salary")], salary_rules=_KES_ONLY,
        defaults={"location": "Kenya"}, external_id=id_last_segment),
    CardSite(
        "careerpointkenya", "https://www.careerpointkenya.co.ke",
        cards=[(*by_class("job-listing", "job"), Sel(("article",))),
               cls("job.?(listing|card|item|post)", "div", "article")],
        title=[cls("title|heading", *HEADS), Sel(("a",))], min_title=3, link=[OF_TITLE, Sel(("a",))],
        company=[cls("company|employer|client")], location=[cls("location|city")],
        job_type=[cls("type|contract|employment")],
        defaults={"location": "Kenya", "company": "CareerPoint Kenya"}, external_id=id_last_segment),
    CardSite(
        "advanceafrica", "https://www.advance-africa.com",
        cards=[cls("job|vacancy|listing", "div", "li", "article"),
               href("jobs-in-kenya|/job/|/vacancy/")],
        title=[cls("title|job", *HEADS, "a"), Sel(("a",))], card_text_title=True, min_title=3,
        link=[OF_CARD, OF_TITLE], company=[cls("company|employer|org")],
        location=[cls("location|city")], defaults={"location": "Kenya"}, external_id=id_last_segment),
    CardSite(
        "talent", "https://www.talent.com",
        cards=[cls(r"\bcard\b", "div"), Sel(("div",), attrs=(("data-job-id", ""),)),
               Sel((), word("js-job-item"), within=Sel((), word("js-job-list")))],
        title=[cls("title|job.?title"), Sel(("h2", "h3"))], min_title=3,
        link=[href(r"/jobs?/|/position/|/search\?"), Sel(("a",))],
        company=[cls("company|employer")], location=[cls("location|city")],
        salary=[cls("salary|pay|wage")], salary_rules=_JOBS_KES,
        job_type=[cls("type|contract|employment")], description=[cls("desc|snippet|summary")],
        external_id=id_job_id),
    CardSite(
        "weworkremotely", "https://weworkremotely.com",
        cards=[Sel(("li",), within=Sel(("ul",), word("jobs"))), cls("feature|listing", "li")],
        skip=[exact(word("flag"), "li"), exact(word("flag"), "a")],
        title=[cls("title"), Sel(("h2", "h3", "span")), href("/remote-jobs/")], min_title=3,
        link=[href("/remote-jobs/")], need_link=True,
        company=[cls("company")], location=[cls("region|location")],
        defaults={"location": "Remote"}, constants={"job_type": "remote", "remote": True},
        external_id=id_href_segment),
    CardSite(
        "wellfound", "https://wellfound.com",
        cards=[Sel(("div",), attrs=(("data-test", "StartupResult|JobResult"),)),
               cls("job-listing|styles_jobList", "div")],
        title=[cls("title|role", "h2", "h3", "span"), Sel(("a",))], min_title=3,
        link=[href("/jobs/|/l/")], company=[cls("company|startup")],
        location=[cls("location|remote")], defaults={"location": "Remote"},
        constants={"job_type": "full-time", "remote": True}, external_id=id_href_segment),
    CardSite(
        "indeed_uk", "https://www.indeed.co.uk",
        cards=[exact("job_seen_beacon|jobsearch-SerpJobCard|result", "div"),
               Sel(("a",), attrs=(("data-jk", ""),))],
        title=[cls("title|jobTitle", "h2", "h3"), Sel(("span",), attrs=(("title", ""),))], min_title=3,
        link=[href("/rc/clk|/viewjob|/pagead"), ANY_LINK],
        company=[cls("company|companyName")], location=[cls("location|companyLocation")],
        salary=[cls("salary|estimated|pay")], salary_mode="pair_only", salary_rules=_JOBS_GBP,
        external_id=id_job_key),
    CardSite(
        "workatastartup", "https://www.workatastartup.com",
        cards=[cls("job.?card|company.?job|listing", "div"), href("/jobs/")],
        title=[Sel((*HEADS, "a"))], card_text_title=True, min_title=3, link=[OF_CARD, ANY_LINK],
        company=[cls("company")], location=[cls("location|city")],
        defaults={"location": "Remote"}, external_id=id_href_segment),
]

# Pages a search source looks through.
SEARCH_SITES = [
    "linkedin.com/jobs", "brightermonday.co.ke", "indeed.com", "glassdoor.com",
    "kariuki.co.ke", "jobwebkenya.com", "corporatestaffing.co.ke",
    "summitrecruitment-search.com", "kenyajob.com",
]

# Employer sites: name, company, url, cards, title tags, link pattern.
_TALEO = [(Sel(("tr",), word("job")), *by_class("job-listing", "listSingleContainer"))]
_TALEO_TITLE = [(Sel(("a",)), Sel(("span",), word("jobTitle")))]
_EMPLOYERS = [
    ("safaricom", "Safaricom PLC", "https://www.safaricom.co.ke/about/careers",
     [(*by_class("job-listing", "vacancy-card", "career-item"),
       Sel(("li",), within=Sel((), word("vacancies"))))],
     [Sel((*HEADS, "a"))], "/careers/|/vacancies/|/job/"),
    ("equity_bank", "Equity Bank", "https://equitybank.taleo.net/careersection/ext/joblist.ftl",
     _TALEO, _TALEO_TITLE, "/jobdetail|/requisition/"),
    ("kcb_bank", "KCB Bank", "https://kcb.taleo.net/careersection/ext/joblist.ftl",
     _TALEO, _TALEO_TITLE, "/jobdetail|/requisition/"),
    ("un_careers", "United Nations",
     "https://careers.un.org/lbw/home.aspx?viewtype=SJ&vacancy=All&lang=en-US",
     [(Sel(("tr",), within=Sel(("table",), word("view"))), *by_class("vacancy-row"),
       Sel(("tr",), within=Sel(("tbody",))))],
     [Sel(("a", "td"))], "/lbw/jobdetail|viewtype="),
    ("who_careers", "World Health Organization",
     "https://careers.who.int/careersection/ex/joblist.ftl",
     _TALEO, _TALEO_TITLE, "/jobdetail|/req"),
    ("givedirectly", "GiveDirectly", "https://boards.greenhouse.io/givedirectly",
     [(*by_class("job-listing", "job-card"), Sel(("article",)))], [Sel((*HEADS, "a"))],
     "/jobs?/|/careers?/|/vacancies?/"),
    ("amref", "Amref Health Africa", "https://amref.org/vacancies/",
     [(*by_class("vacancy", "job-posting"), Sel(("article",)))], [Sel((*HEADS, "a"))],
     "/vacancies?/|/jobs?/"),
    ("savethechildren", "Save the Children",
     "https://hcri.fa.em2.oraclecloud.com/hcmUI/CandidateExperience/en/sites/CX_1/requisitions",
     [(*by_class("job-card", "requisition"), Sel((), attrs=(("role", "^listitem$"),)))],
     [Sel(("h2", "h3", "a"))], "/requisition|/job/"),
    ("worldvision", "World Vision", "https://careers.wvi.org/jobs",
     [by_class("job-listing", "views-row", "job-teaser")], [Sel(("h2", "h3", "a"))],
     "/jobs/|/careers/"),
    ("turing", "Turing", "https://www.turing.com/jobs",
     [(*by_class("job-card", "job-listing"), Sel((), attrs=(("data-testid", "^job-card$"),)))],
     [Sel((*HEADS, "a"))], "/jobs/|/remote-"),
    ("builtin", "BuiltIn", "https://builtin.com/jobs/remote",
     [(*by_class("job-card", "job-item"), Sel((), attrs=(("data-id", ""),)))],
     [Sel(("h2", "h3", "a"))], "/job/|/company/.*?/jobs/"),
]
GREENHOUSE_SITES = ["givedirectly"]
EMPLOYER_URLS = {name: (company, url) for name, company, url, *_ in _EMPLOYERS}

EMPLOYERS = [
    CardSite(
        name, url, cards=[*cards, cls("job|vacancy|career|position", "div", "li", "article")],
        title=title, min_title=3, link=[href(pattern, ignore_case=True), ANY_LINK],
        link_mode="slash", location=[cls("location|city|country")],
        job_type=[cls("type|contract|employment")], constants={"company": company},
        external_id=id_href_segment)
    for name, company, url, cards, title, pattern in _EMPLOYERS
]
