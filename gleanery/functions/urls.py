"""Urls and external ids."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.text import blank_to_null


def absolutize(href: Column, base: str | Column, *, root_only: bool = False,
               slash: bool = False) -> Column:
    """Keep absolute links, prefix the base to others; empty gives NULL.

    `root_only` accepts relative links only if they start with '/'; `slash` puts
    exactly one '/' between base and link.
    """
    base = F.lit(base) if isinstance(base, str) else base
    joined = (F.concat(base, F.lit("/"), F.regexp_replace(href, "^/+", "")) if slash
              else F.concat(base, href))
    ladder = (F.when(F.coalesce(href, F.lit("")) == "", F.lit(None).cast("string"))
              .when(href.startswith("http"), href))
    if root_only:
        return ladder.when(href.startswith("/"), joined)
    return ladder.otherwise(joined)


def last_segment(url: Column) -> Column:
    """Last path segment after removing trailing slashes; a query stays on it."""
    return F.when(url != "", F.substring_index(F.regexp_replace(url, "/+$", ""), "/", -1))


def captured(c: Column, pattern: str, group: int = 1) -> Column:
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def slug_or_title(url: Column, title: Column, pattern: str = r"/([^/]+)/?$") -> Column:
    """Slug of the link, else the title."""
    return F.coalesce(captured(url, pattern), title)


def first_present(*cols: Column) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in cols])


def composite(prefix: str, *parts: Column) -> Column:
    """prefix_part_part; NULL as soon as one part is missing."""
    return F.concat(F.lit(prefix), *[x for p in parts for x in (F.lit("_"), p.cast("string"))])


def source_from_site(site: Column) -> Column:
    return F.concat(F.lit("google_"), F.substring_index(site, ".", 1))
