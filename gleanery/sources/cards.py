"""Listing pages of repeated cards to raw postings, driven by a CardSite.

`pages` is a landed table (source, page, html) plus, for sources that crawl many
sites, (site, company, site_url).
"""

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery import vocab
from gleanery.functions import dates, salary
from gleanery.functions.text import blank_to_null, present
from gleanery.functions.urls import absolutize
from gleanery.sources import dom
from gleanery.sources.postings import shape

OF_TITLE = "of title"  # the title element itself if a link, else the link in it
OF_CARD = "of card"    # the card itself, where cards are links


@dataclass(frozen=True)
class CardSite:
    name: str
    base: str
    cards: list                        # fallback steps
    title: list                        # fallback steps inside a card
    link: list = field(default_factory=lambda: [OF_TITLE])
    company: list = field(default_factory=list)
    location: list = field(default_factory=list)
    job_type: list = field(default_factory=list)
    description: list = field(default_factory=list)
    deadline: list = field(default_factory=list)
    salary: list = field(default_factory=list)
    chips: list = field(default_factory=list)   # steps; labels of type and place
    external_id: Callable | None = None     # (url, href, title, card, link) -> Column
    defaults: dict = field(default_factory=dict)
    constants: dict = field(default_factory=dict)   # values or functions giving a Column
    min_title: int = 1
    link_mode: str = "prefix"               # prefix | root | slash | http
    salary_mode: str = "both"
    salary_rules: tuple = ()                # (rules, default); empty: no currency
    strict_salary: bool = False             # reject cards with comma-only numbers
    deadline_label: str = vocab.DEADLINE_LABEL
    deadline_formats: list = field(default_factory=lambda: vocab.DEADLINE_FORMATS)
    description_width: int | None = None
    remote: Callable | None = None          # (title, location) -> Column
    posted: tuple = ()                      # (steps, attribute)
    skip: list = field(default_factory=list)
    card_text_title: bool = False           # link cards: their text is the title
    need_link: bool = False
    company_outside_title: bool = False
    lower_type: bool = False
    title_in_link: bool = False             # reject cards whose title is outside the link
    title_in: list = field(default_factory=list)    # steps; where present, the title must be inside
    per_site: int | None = None             # cards beyond it are rejected, not lost


def split_cards(pages: DataFrame, steps: list, keep: list[str]) -> DataFrame:
    """One row per card: its element and the nodes inside it. The first step
    that finds any element on the page decides; a page without cards gives no
    rows, a page that is missing or unreadable one row whose card says so."""
    parsed = pages.select(*keep, dom.parse_nodes("html").alias("nodes"))
    broken = (f"named_struct('i', 0, 'stop', 0, 'tag', '{dom.BROKEN}', 'attrs', "
              "CAST(NULL AS MAP<STRING,STRING>), 'text', CAST(NULL AS STRING))")
    parsed = parsed.withColumn("found", F.expr(
        f"CASE WHEN {dom.unreadable('nodes')} THEN array({broken}) ELSE {dom.found('nodes', steps)} END"))
    packed = F.expr("posexplode(transform(found, _c -> struct(_c AS card, "
                    "slice(nodes, _c.i + 2, _c.stop - _c.i) AS nodes))) AS (pos, c)")
    return parsed.select(*keep, packed).select(*keep, "pos", "c.card", "c.nodes")


def without_cards(pages: DataFrame, steps: list) -> DataFrame:
    """Pages on which no step finds a card."""
    parsed = pages.withColumn("_nodes", dom.parse_nodes("html"))
    return parsed.where(F.expr(dom.found("_nodes", steps)).isNull()).drop("_nodes")


def _element(steps: list) -> Column:
    options = []
    for s in steps:
        if s == OF_TITLE:
            options.append(dom.link_in("nodes", "_title_el"))
        elif s == OF_CARD:
            options.append("CASE WHEN card.tag = 'a' THEN card END")
        else:
            options.append(dom.first("nodes", [s]))
    return F.expr(f"coalesce({', '.join(options)})")


def card_postings(pages: DataFrame, site: CardSite) -> DataFrame:
    keep = ["page", *[c for c in ("site", "company", "site_url") if c in pages.columns]]
    cards = split_cards(pages, site.cards, keep)
    if site.skip:
        own = " OR ".join(s.test("card", "nodes") for s in site.skip)
        cards = cards.where(f"coalesce(NOT ({own}), TRUE) AND {dom.first('nodes', site.skip)} IS NULL")
    # Elements, then their texts, each in a projection of its own.
    title_el = _element([*([OF_CARD] if site.card_text_title else []), *site.title])
    step = cards.withColumn("_title_el", title_el)
    step = step.withColumns({
        "_link_el": _element(site.link),
        **{f"_{f}_el": _element(getattr(site, f))
           for f in ("company", "location", "job_type", "description", "deadline", "salary")
           if getattr(site, f)},
        **({"_posted_el": _element(site.posted[0])} if site.posted else {}),
    })

    def text(name: str) -> Column:
        # A link card is not among its own inner nodes, but its range covers them.
        return F.expr(dom.text_of("nodes", f"_{name}_el"))

    step = step.withColumns({
        "_title": text("title"), "_href": dom.attr(F.col("_link_el"), "href"),
        **{f"_{f}": text(f) for f in ("company", "location", "job_type", "description",
                                      "deadline", "salary") if getattr(site, f)},
        **({"_chips": F.expr(f"transform({dom.found('nodes', site.chips)}, "
                             f"_e -> {dom.text_of('nodes', '_e')})")} if site.chips else {}),
    })
    title, href = F.col("_title"), F.col("_href")
    base = F.regexp_replace("site_url", "/[^/]*$", "") if site.link_mode == "slash" else site.base
    url = absolutize(href, base, root_only=site.link_mode == "root", slash=site.link_mode == "slash")
    if site.link_mode == "http":
        url = F.when(href.startswith("http"), href)

    def value(name: str) -> Column:
        found = F.col(f"_{name}") if getattr(site, name) else F.lit(None).cast("string")
        default = site.defaults.get(name)
        return found if default is None else F.coalesce(found, F.lit(default))

    columns = {
        "source": F.lit(site.name), "title": title, "company": value("company"),
        "location": value("location"), "job_type": value("job_type"),
        "description": value("description"), "url": url, "apply_url": url,
    }
    if site.lower_type:
        columns["job_type"] = F.lower(columns["job_type"])
    if site.description_width:
        columns["description"] = F.left(columns["description"], F.lit(site.description_width))
    if site.deadline:
        columns["application_deadline"] = dates.parse_deadline(
            F.col("_deadline"), site.deadline_formats, site.deadline_label)
    checks = [("unparseable page", F.col("card.tag") == dom.BROKEN),
              ("short title", F.length(title) < site.min_title)]
    if site.salary:
        pay = F.col("_salary")
        columns["salary_min"], columns["salary_max"] = salary.bounds(pay, site.salary_mode)
        if site.salary_rules:
            columns["salary_currency"] = salary.currency(pay, *site.salary_rules)
        if site.strict_salary:
            checks.append(("bad salary", salary.unreadable(pay, site.salary_mode)))
    if site.posted:
        columns["posted_date"] = dates.iso_instant(dom.attr(F.col("_posted_el"), site.posted[1]))
    if site.external_id:
        columns["external_id"] = site.external_id(url, href, title, F.col("card"), F.col("_link_el"))
    if site.remote:
        columns["remote"] = site.remote(title, columns["location"])
    if site.title_in_link:
        inside_link = ((F.col("_title_el.i") > F.col("_link_el.i"))
                       & (F.col("_title_el.i") <= F.col("_link_el.stop")))
        checks.append(("no title", ~F.coalesce(inside_link, F.lit(False))))
    if site.title_in:
        # A card that has this element takes its title from inside it or not at all.
        holder = F.expr(dom.first("nodes", site.title_in))
        outside = ((F.col("_title_el.i") <= holder["i"]) | (F.col("_title_el.i") > holder["stop"]))
        checks.append(("no title", F.coalesce(holder.isNotNull() & outside, F.lit(False))))
    if site.need_link:
        checks.append(("no link", ~present(url)))
    if site.company_outside_title:
        inside = ((F.col("_company_el.i") > F.col("_title_el.i"))
                  & (F.col("_company_el.i") <= F.col("_title_el.stop")))
        columns["company"] = F.when(~inside, columns["company"])
    if site.chips:
        columns["job_type"], columns["location"] = chip_type_and_place(F.col("_chips"))
    columns.update({k: v() if callable(v) else F.lit(v) for k, v in site.constants.items()})
    if site.per_site:
        rank = F.row_number().over(Window.partitionBy("page").orderBy("pos"))
        step = step.withColumn("_rank", rank)
        checks.append(("beyond the cap of the site", F.col("_rank") > site.per_site))
    return shape(step, columns, checks)


def chip_type_and_place(chips: Column, types=None, default: str = "Kenya") -> tuple[Column, Column]:
    """Short label texts: the last one naming a job type is the type, the last
    other one the place."""
    known = vocab.CHIP_JOB_TYPES if types is None else types
    kinds = F.filter(chips, lambda t: F.lower(t).isin(*known))
    places = F.filter(chips, lambda t: ~F.lower(t).isin(*known) & (t != ""))
    last = F.lit(-1)
    return (F.try_element_at(kinds, last),
            F.coalesce(F.try_element_at(places, last), F.lit(default)))


def attribute(*names: str) -> Callable:
    """Id rule: first non-empty attribute of the card."""
    return lambda url, href, title, card, link: F.coalesce(
        *[blank_to_null(dom.attr(card, n)) for n in names])
