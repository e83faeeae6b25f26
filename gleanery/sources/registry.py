"""The registered sources and the multi-source extraction."""

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.sources import cards, details, feeds, sites, tabular
from gleanery.sources.postings import (check_widths, merge_detail, query_filter,
                                       union_all)

PAGE_COLUMNS = ["source", "page", "html", "site", "company", "site_url"]


@dataclass(frozen=True)
class Landed:
    """What crawlers have written; any part may be missing.

    pages(source, page, html, site, company, site_url), payloads(source, page,
    body, site, company), detail_pages(source, url, ref, html) and
    detail_payloads(site, item_id, body). Partitioned by source, each branch of
    the union reads only its own files.
    """

    pages: DataFrame | None = None
    payloads: DataFrame | None = None
    detail_pages: DataFrame | None = None
    detail_payloads: DataFrame | None = None
    #: When the run takes place; where a source's rules fill a posting date, it is filled with this.
    as_of: datetime | None = None

    def limited(self, plan: DataFrame) -> "Landed":
        """Only the planned sources and their first max_pages pages."""
        def cut(df):
            return None if df is None else limit_pages(df, plan)
        return replace(self, pages=cut(self.pages), payloads=cut(self.payloads))


@dataclass(frozen=True)
class Source:
    name: str
    needs: tuple[str, ...]
    extract: Callable[[Landed], DataFrame]
    search_columns: tuple[str, ...] = ()   # columns of the source-side search


def plan_table(spark: SparkSession, plan: list[tuple]) -> DataFrame:
    return spark.createDataFrame(plan, "source string, search_query string, location string, max_pages int")


def limit_pages(landed: DataFrame, plan: DataFrame) -> DataFrame:
    """Pages within the budget of their source. Pages that carry the search word and
    place they were fetched for count only for a plan that asks for those; a
    missing one and an empty one are the same. The plan is a local table of one
    row per source, which the planner broadcasts by its known size."""
    asked = [c for c in ("search_query", "location") if c in landed.columns]
    budget = plan.select("source", "max_pages", *[F.coalesce(c, F.lit("")).alias(f"_{c}") for c in asked])
    kept = landed.join(budget, "source").where(F.col("page") <= F.col("max_pages"))
    for c in asked:
        kept = kept.where(F.coalesce(F.col(c), F.lit("")) == F.col(f"_{c}"))
    return kept.select(*landed.columns)


def _pages_of(landed: Landed, name: str) -> DataFrame:
    return landed.pages.where(F.col("source") == name)


def _cards(site: cards.CardSite) -> Callable[[Landed], DataFrame]:
    return lambda landed: cards.card_postings(_pages_of(landed, site.name), site)


def _with_detail(site: cards.CardSite) -> Callable[[Landed], DataFrame]:
    def run(landed):
        listing = cards.card_postings(_pages_of(landed, site.name), site)
        if landed.detail_pages is None:
            return listing
        mine = landed.detail_pages.where(F.col("source") == site.name)
        return merge_detail(listing, details.detail_fields(mine, site.name))
    return run


def _either(pages: DataFrame, has: Column, structured, plain) -> DataFrame:
    """Structured data where a page has it, its cards elsewhere."""
    return structured(pages.where(has)).unionByName(plain(pages.where(~has)))


def _fuzu(site):
    def run(landed):
        return _either(_pages_of(landed, "fuzu"), feeds.has_items(F.col("html")),
                       feeds.ld_itemlist, lambda p: cards.card_postings(p, site))
    return run


def _wellfound(site):
    def run(landed):
        pages = _pages_of(landed, "wellfound")
        bare = cards.without_cards(pages, site.cards)
        return cards.card_postings(pages, site).unionByName(feeds.ld_postings(bare, remote=True))
    return run


def _page_state(site):
    def run(landed):
        return _either(_pages_of(landed, site.name), feeds.has_page_state(F.col("html")),
                       lambda p: feeds.page_state_postings(p, site.base),
                       lambda p: cards.card_postings(p, site))
    return run


def _employers(landed: Landed) -> DataFrame:
    """Every employer site is a source tag of its own: JSON-LD where present,
    cards elsewhere, and the board payloads."""
    parts = []
    if landed.pages is not None:
        pages = _pages_of(landed, "company_careers")
        has = feeds.has_postings(F.col("html"))
        tagged = pages.withColumn("source", F.col("site"))
        parts.append(feeds.ld_postings(tagged.where(has)))
        parts += [cards.card_postings(pages.where(~has & (F.col("site") == s.name)), s)
                  for s in sites.EMPLOYERS]
    if landed.payloads is not None:
        parts.append(feeds.feed_postings(landed.payloads, feeds.FEEDS["greenhouse"]))
    return union_all(parts)


def _feed(name: str) -> Source:
    feed = feeds.FEEDS[name]
    search = {"remoteok": ("title", "tags"), "aijobs": ("title",)}.get(name, ())
    return Source(name, ("payloads",), lambda landed: feeds.feed_postings(landed.payloads, feed), search)


def _build() -> dict[str, Source]:
    by_name = {s.name: s for s in sites.SITES}
    special = {
        "fuzu": _fuzu, "wellfound": _wellfound, "workatastartup": _page_state,
        "brightermonday": _with_detail, "summitrecruitment": _with_detail,
    }
    out = {n: Source(n, ("pages",), special.get(n, _cards)(s)) for n, s in by_name.items()}
    for n in ("adzuna", "remoteok", "remotive", "aijobs"):
        out[n] = _feed(n)
    out["company_careers"] = Source("company_careers", (), _employers)
    out["bamboohr"] = Source("bamboohr", ("payloads", "detail_payloads"), lambda x: feeds.ats_postings(
        x.payloads, x.detail_payloads))
    out["openedcareer"] = Source("openedcareer", ("payloads",),
                                 lambda x: feeds.wordpress_postings(x.payloads, x.as_of))
    out["kemri"] = Source("kemri", ("pages", "detail_pages"), lambda x: tabular.institute_postings(
        _pages_of(x, "kemri"), x.detail_pages.where(F.col("source") == "kemri"),
        "https://erecruitment.kemri.go.ke:7070", x.as_of))
    return out


REGISTRY = _build()


def chosen(names: list[str] | None = None) -> list[Source]:
    if names is None:
        return list(REGISTRY.values())
    unknown = [n for n in names if n not in REGISTRY]
    if unknown:
        raise ValueError(f"unknown source: {unknown[0]}; available: {sorted(REGISTRY)}")
    return [REGISTRY[n] for n in names]


def extract(landed: Landed, names: list[str] | None = None,
            search: str | dict[str, str] | None = None) -> DataFrame:
    """Raw postings of all or the named sources as one union, with `reject`.
    Sources whose input was not landed are left out. `search` is one word for
    all sources that search their rows themselves, or a word per source."""
    parts = []
    for s in chosen(names):
        if any(getattr(landed, n) is None for n in s.needs):
            continue
        rows = s.extract(landed).withColumn("run", F.lit(s.name))
        word = search.get(s.name) if isinstance(search, dict) else search
        if word and s.search_columns:
            rows = query_filter(rows, word, s.search_columns)
        parts.append(rows)
    return check_widths(union_all(parts))
