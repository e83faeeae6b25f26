"""JSON sources: landed payloads (source, page, body) to raw postings."""

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery import vocab
from gleanery.functions import dates, prose, salary
from gleanery.functions.text import (blank_to_null, present, strip, title_case,
                                     unescape_html)
from gleanery.functions.urls import composite, first_present, last_segment
from gleanery.sources.postings import latest_capture, shape


class Item:
    """Typed access to one JSON value; a wrong type or path gives NULL."""

    def __init__(self, value: Column):
        self.value = value

    def text(self, path: str) -> Column:
        return F.try_variant_get(self.value, f"$.{path}", "string")

    def number(self, path: str) -> Column:
        return self.text(path).try_cast("double")

    def texts(self, path: str) -> Column:
        return F.try_variant_get(self.value, f"$.{path}", "array<string>")

    def items(self, path: str) -> Column:
        return F.try_variant_get(self.value, f"$.{path}" if path else "$", "array<variant>")

    def is_object(self, path: str) -> Column:
        found = F.schema_of_variant(F.try_variant_get(self.value, f"$.{path}", "variant"))
        return F.coalesce(found.startswith("OBJECT"), F.lit(False))


@dataclass(frozen=True)
class Feed:
    """A JSON source: where its items are and how fields map to columns."""

    name: str
    path: str
    columns: Callable[[Item], dict[str, Column]]
    checks: Callable[[Item], list] = lambda item: []
    skip_first: bool = False
    search_columns: tuple[str, ...] = ("title",)
    extra: tuple[str, ...] = ()


def explode_items(landed: DataFrame, path: str, keep=("page",)) -> DataFrame:
    """One row per list element; an unreadable body gives one row without item."""
    doc = landed.select(*keep, F.try_parse_json("body").alias("doc"))
    listed = doc.select(*keep, F.col("doc").isNull().alias("bad"),
                        F.posexplode_outer(Item(F.col("doc")).items(path)).alias("pos", "item"))
    return listed.where("bad OR item IS NOT NULL")


def feed_postings(landed: DataFrame, feed: Feed) -> DataFrame:
    mine = landed.where(F.col("source") == feed.name)
    rows = explode_items(mine, feed.path, ("page", *feed.extra))
    if feed.skip_first:
        rows = rows.where("bad OR pos > 0")
    item = Item(F.col("item"))
    columns = {"source": F.lit(feed.name), **feed.columns(item)}
    return shape(rows, columns, [("malformed body", F.col("bad")), *feed.checks(item)])


def _tags_or_text(item: Item, path: str) -> Column:
    return F.coalesce(F.array_join(item.texts(path), ","), item.text(path), F.lit(""))


def _adzuna(i: Item) -> dict[str, Column]:
    url = i.text("redirect_url")
    return {
        "title": i.text("title"), "company": i.text("company.display_name"),
        "location": i.text("location.display_name"), "description": i.text("description"),
        "salary_min": i.number("salary_min"), "salary_max": i.number("salary_max"),
        "url": url, "apply_url": url, "external_id": i.text("id"),
        "posted_date": dates.iso_instant(i.text("created")),
        "tags": prose.spaced_tags(F.coalesce(i.text("category.tag"), F.lit(""))),
    }


def _aijobs(i: Item) -> dict[str, Column]:
    url = first_present(i.text("url"), i.text("apply_url"))
    place = F.coalesce(blank_to_null(i.text("job_location")), F.lit("Remote"))
    published = first_present(i.text("published"), i.text("created_at"))
    kind = F.replace(F.lower(blank_to_null(i.text("job_type"))), F.lit("_"), F.lit("-"))
    whole_day = F.when(F.length(published) == 10, dates.iso_day(published))
    return {
        "title": i.text("job_title"), "company": i.text("company_name"), "location": place,
        "description": F.coalesce(i.text("job_description"), F.lit("")),
        "salary_min": i.number("salary_from"), "salary_max": i.number("salary_to"),
        "salary_currency": F.coalesce(blank_to_null(i.text("salary_currency")), F.lit("USD")),
        "job_type": kind, "remote": prose.remote_truthy(i.text("remote"), place),
        "url": url, "apply_url": url, "tags": _tags_or_text(i, "job_skills"),
        "posted_date": F.coalesce(dates.iso_seconds(published), whole_day),
        "external_id": i.text("id"),
    }


def _remoteok(i: Item) -> dict[str, Column]:
    slug = i.text("slug")
    url = F.coalesce(blank_to_null(i.text("url")),
                     F.concat(F.lit("https://remoteok.com/l/"), F.coalesce(slug, F.lit(""))))
    low, high = salary.bounds(i.text("salary"), "both")
    return {
        "title": first_present(i.text("position"), i.text("title")),
        "company": i.text("company"), "location": F.lit("Remote"),
        "description": F.coalesce(i.text("description"), F.lit("")),
        "salary_min": low, "salary_max": high, "salary_currency": F.lit("USD"),
        "job_type": F.lit("remote"), "remote": F.lit(True), "url": url,
        "apply_url": F.coalesce(blank_to_null(i.text("apply_url")), url),
        "tags": _tags_or_text(i, "tags"),
        "posted_date": dates.epoch_seconds(first_present(i.text("date"), i.text("epoch"))),
        "external_id": first_present(i.text("id"), slug),
    }


def _remotive(i: Item) -> dict[str, Column]:
    pay, url = i.text("salary"), i.text("url")
    low, high = salary.bounds(pay, "both")
    return {
        "title": i.text("title"), "company": i.text("company_name"),
        "location": F.coalesce(blank_to_null(i.text("candidate_required_location")), F.lit("Worldwide")),
        "description": F.coalesce(i.text("description"), F.lit("")),
        "salary_min": low, "salary_max": high,
        "salary_currency": salary.currency(pay, [(["£", "GBP"], "GBP"), (["€", "EUR"], "EUR")], "USD"),
        "job_type": F.replace(F.coalesce(blank_to_null(i.text("job_type")), F.lit("full_time")),
                              F.lit("_"), F.lit("-")),
        "remote": F.lit(True), "url": url, "apply_url": url,
        "tags": F.coalesce(F.array_join(i.texts("tags"), ","), F.lit("")),
        "posted_date": dates.iso_seconds(i.text("publication_date")),
        "external_id": i.text("id"),
    }


def _greenhouse(i: Item) -> dict[str, Column]:
    names = F.transform(i.items("departments"), lambda d: F.try_variant_get(d, "$.name", "string"))
    url = i.text("absolute_url")
    return {
        "source": F.col("site"), "company": F.col("company"), "title": i.text("title"),
        "location": F.when(i.is_object("location"), F.coalesce(i.text("location.name"), F.lit("")))
        .otherwise("Remote"),
        "url": url, "apply_url": url, "external_id": i.text("id"),
        "tags": F.coalesce(prose.join_tags(names), F.lit("")),
        "posted_date": dates.iso_seconds(first_present(i.text("updated_at"), i.text("created_at"))),
    }


def _wordpress(i: Item) -> dict[str, Column]:
    title = strip(unescape_html(i.text("title.rendered")))
    job, company = prose.split_last(title, " at ")
    body = i.text("content.rendered")
    text = F.col("_text")
    kept = prose.drop_lines(prose.lines(text))
    description, requirements = prose.split_latched(kept, vocab.REQUIREMENT_WORDS_POST)
    return {
        "title": job, "company": company, "location": prose.extract_location(text),
        "description": description, "requirements": requirements,
        "job_type": prose.prose_job_type(text), "remote": prose.remote_in_text(text),
        "url": i.text("link"), "apply_url": prose.apply_link(body, "openedcareer"),
        "external_id": composite("openedcareer", first_present(i.text("id"), i.text("slug"))),
        "posted_date": dates.iso_instant(i.text("date_gmt")),
        "application_deadline": dates.ordinal_deadline(text),
    }


FEEDS = {
    "adzuna": Feed("adzuna", "results", _adzuna),
    "aijobs": Feed("aijobs", "", _aijobs),
    "remoteok": Feed("remoteok", "", _remoteok, skip_first=True, search_columns=("title", "tags")),
    "remotive": Feed("remotive", "jobs", _remotive),
    "greenhouse": Feed("greenhouse", "jobs", _greenhouse, extra=("site", "company")),
}


def wordpress_postings(landed: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Posts with an outside apply link and a description of 50 characters. A
    posting date that is there but cannot be read is `as_of`; a missing one stays missing."""
    rows = explode_items(landed.where(F.col("source") == "openedcareer"), "")
    item = Item(F.col("item"))
    rows = rows.withColumn("_text", prose.html_to_text(item.text("content.rendered")))
    cols = {"source": F.lit("openedcareer"), **_wordpress(item)}
    cols["posted_date"] = F.coalesce(cols["posted_date"], F.when(
        present(item.text("date_gmt")), F.lit(as_of).cast("timestamp_ntz")))
    full = F.length(strip(unescape_html(item.text("title.rendered"))))
    return shape(rows, cols, [
        ("malformed body", F.col("bad")),
        ("short title", F.coalesce(full, F.lit(0)) < 5),
        ("no direct apply link", ~present(cols["apply_url"])),
        ("short description", ~F.coalesce(F.length(cols["description"]) >= 50, F.lit(False))),
    ])


def ats_postings(listing: DataFrame, details: DataFrame) -> DataFrame:
    """Applicant-tracking lists (site = company slug) joined with their details
    (site, item_id, body) on (site, item id)."""
    rows = explode_items(listing.where(F.col("source") == "bamboohr"), "result", ("page", "site"))
    i = Item(F.col("item"))
    rows = rows.withColumn("item_id", i.text("id"))
    d = (latest_capture(details, ["site", "item_id"], ["body"])
         .withColumn("opening", F.try_variant_get(F.try_parse_json("body"), "$.result.jobOpening", "variant"))
         .select("site", "item_id",
                 F.try_variant_get("opening", "$.description", "string").alias("_html"),
                 F.try_variant_get("opening", "$.datePosted", "string").alias("_posted")))
    rows = rows.join(d, ["site", "item_id"], "left")
    rows = rows.withColumn("_lines", prose.lines(prose.html_to_text(F.col("_html"))))
    description, requirements = prose.split_latched(F.col("_lines"), vocab.REQUIREMENT_WORDS_ATS)
    city, state = i.text("location.city"), i.text("location.state")
    place = F.when(present(city), F.regexp_replace(
        F.concat_ws(", ", city, F.coalesce(state, F.lit(""))), "^[, ]+|[, ]+$", "")
    ).otherwise(F.coalesce(state, F.lit("")))
    code = i.text("locationType")
    url = F.concat(F.lit("https://"), "site", F.lit(".bamboohr.com/careers/"), "item_id")
    columns = {
        "source": F.lit("bamboohr"), "title": strip(i.text("jobOpeningName")),
        "company": F.coalesce(blank_to_null(strip(i.text("departmentLabel"))), title_case(F.col("site"))),
        "location": prose.hybrid_location(place, code),
        "description": description, "requirements": requirements,
        "job_type": F.coalesce(i.text("employmentStatusLabel"), F.lit("")),
        "remote": prose.remote_code(code), "url": url, "apply_url": url,
        "external_id": composite("bamboohr", F.col("site"), F.col("item_id")),
        "posted_date": F.when(F.length("_posted") == 10, dates.iso_day(F.col("_posted"))),
    }
    return shape(rows, columns, [
        ("malformed body", F.col("bad")),
        ("no id", ~present(F.col("item_id"))),
        ("short description", ~F.coalesce(F.length(description) >= 30, F.lit(False))),
    ])


# --- JSON inside pages ---------------------------------------------------

_LD_JSON = r"""(?is)<script\b[^>]*type\s*=\s*["']?application/ld\+json["']?[^>]*>(.*?)</script\s*>"""
_PAGE_STATE = r"""(?is)<script\b[^>]*id\s*=\s*["']?__NEXT_DATA__["']?[^>]*>(.*?)</script\s*>"""


def ld_array(html: Column) -> Column:
    """Every JSON-LD object of a page, lists flattened; bad JSON is skipped."""
    bodies = F.regexp_extract_all(html, F.lit(_LD_JSON), F.lit(1))

    def objects(body: Column) -> Column:
        doc = F.try_parse_json(body)
        return F.coalesce(Item(doc).items(""), F.array(doc))

    return F.filter(F.flatten(F.transform(bodies, objects)), lambda o: o.isNotNull())


def _is(obj: Column, kind: str) -> Column:
    return F.coalesce(Item(obj).text("@type") == kind, F.lit(False))


def has_postings(html: Column) -> Column:
    return F.exists(ld_array(html), lambda o: _is(o, "JobPosting") & present(Item(o).text("title")))


def has_items(html: Column) -> Column:
    def complete(e: Column) -> Column:
        return present(Item(e).text("name")) & present(Item(e).text("url"))

    return F.exists(ld_array(html), lambda o: _is(o, "ItemList") & F.coalesce(
        F.exists(Item(o).items("itemListElement"), complete), F.lit(False)))


def ld_objects(pages: DataFrame, keep: list[str], kind: str) -> DataFrame:
    found = F.filter(ld_array(F.col("html")), lambda o: _is(o, kind))
    return pages.select(*keep, F.posexplode(found).alias("pos", "item"))


def ld_postings(pages: DataFrame, *, remote: bool = False) -> DataFrame:
    """JobPosting objects. `pages` carries source, company (the default) and
    site_url (the last fallback for the link); both may be NULL."""
    rows = ld_objects(pages, ["page", "source", "company", "site_url"], "JobPosting")
    i = Item(F.col("item"))
    org = F.when(i.is_object("hiringOrganization"), blank_to_null(i.text("hiringOrganization.name")))
    place = F.when(i.is_object("jobLocation"), first_present(
        i.text("jobLocation.address.addressLocality"), i.text("jobLocation.address.addressCountry")))
    url = first_present(i.text("url"), i.text("sameAs"), F.col("site_url"))
    return shape(rows, {
        "source": F.col("source"), "title": i.text("title"),
        "company": F.coalesce(org, F.col("company")),
        "location": F.coalesce(place, F.lit("Remote")),
        "description": F.coalesce(i.text("description"), F.lit("")),
        "remote": F.lit(remote), "url": url, "apply_url": url,
        "posted_date": dates.iso_day(i.text("datePosted")),
        "external_id": last_segment(url),
    })


def ld_itemlist(pages: DataFrame, location: str = "Kenya") -> DataFrame:
    """(name, url) elements of ItemList objects; both are required."""
    lists = ld_objects(pages, ["page", "source"], "ItemList")
    lists = lists.select("page", "source", F.col("pos").cast("bigint").alias("_outer"), F.posexplode(
        Item(F.col("item")).items("itemListElement")).alias("_n", "item"))
    lists = lists.withColumn("pos", F.col("_outer") * (1 << 32) + F.col("_n"))
    i = Item(F.col("item"))
    url = i.text("url")
    return shape(lists, {
        "source": F.col("source"), "title": i.text("name"), "location": F.lit(location),
        "url": url, "apply_url": url, "external_id": last_segment(url),
    }, [("no url", ~present(url))])


def page_state(html: Column) -> Column:
    """Items of the embedded page state: its jobs, or else its results."""
    d = Item(F.try_parse_json(F.regexp_extract(html, _PAGE_STATE, 1)))
    jobs, results = d.items("props.pageProps.jobs"), d.items("props.pageProps.results")
    return F.when(F.size(jobs) > 0, jobs).otherwise(results)


def has_page_state(html: Column) -> Column:
    titled = F.exists(page_state(html), lambda o: present(
        first_present(Item(o).text("title"), Item(o).text("job_title"))))
    return F.coalesce(titled, F.lit(False))


def page_state_postings(pages: DataFrame, base: str) -> DataFrame:
    rows = pages.select("page", "source", F.posexplode(page_state(F.col("html"))).alias("pos", "item"))
    i = Item(F.col("item"))
    slug = blank_to_null(i.text("slug"))
    url = F.coalesce(blank_to_null(i.text("url")), F.concat(F.lit(f"{base}/jobs/"), slug))
    return shape(rows, {
        "source": F.col("source"), "title": first_present(i.text("title"), i.text("job_title")),
        "company": first_present(i.text("company_name"), i.text("company.name")),
        "location": F.coalesce(blank_to_null(i.text("location")), F.lit("Remote")),
        "remote": F.coalesce(i.text("remote").try_cast("boolean"), F.lit(False)),
        "url": url, "apply_url": url, "external_id": first_present(i.text("id"), slug),
    })
