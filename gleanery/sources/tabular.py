"""Tables inside pages: vacancy lists and requirement tables."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions import dates, prose
from gleanery.functions.text import blank_to_null, present
from gleanery.functions.urls import composite
from gleanery.sources import dom
from gleanery.sources.postings import dedup_first, latest_capture, shape

CELLS = ["ref", "title", "emp_type", "positions", "deadline", "grade", "status"]

# Markers and labels of the vacancy pages.
INSTITUTE = "Kenya Medical Research Institute (KEMRI)"
DUTIES = "Key Responsibilities:"
DUTIES_ELSE = "Job Tite/Designation"
REQUIREMENTS = "Vacancy Requirements:"
ADVERTISED = "Advertised Date:"
CLOSING = "Closing Date:"


def vacancy_rows(pages: DataFrame) -> DataFrame:
    """Rows of the first table of each page after its header: at least seven
    cells, a reference, and status active. A page that is missing or unreadable
    gives one row that is `broken`."""
    parsed = pages.select("page", dom.parse_nodes("html").alias("nodes")).withColumn(
        "broken", F.expr(dom.unreadable("nodes")))
    cells = F.when(F.col("broken"), F.array(F.array().cast("array<string>"))).otherwise(
        F.expr(dom.table_cells("nodes", "table")))
    rows = parsed.withColumn("table", F.expr(dom.first("nodes", [dom.Sel(("table",))]))).select(
        "page", "broken", F.posexplode(cells).alias("pos", "cells"))
    full = rows.where(F.col("broken") | (F.col("pos") > 0) & (F.size("cells") >= len(CELLS)))
    named = full.select("page", "pos", "broken", *[F.get("cells", F.lit(k)).alias(c) for k, c in enumerate(CELLS)])
    return named.where(F.col("broken") | (F.col("ref") != "") & (F.lower("status") == "active"))


def with_requirements(rows: DataFrame) -> DataFrame:
    """Adds `requirements` from `nodes`: the table after the first heading that
    names requirements, as lines with an optional [priority] in front."""
    titled = (f"exists(nodes, _t -> _t.tag = '{dom.TEXT}' AND _t.i > _h.i AND _t.i <= _h.stop "
              "AND contains(_t.text, 'Requirements'))")
    rows = rows.withColumn("_heading", F.expr(f"get(filter(nodes, _h -> _h.tag = 'h4' AND {titled}), 0)"))
    rows = rows.withColumn("_table", F.expr(
        "get(filter(nodes, _n -> _n.tag = 'table' AND _n.i > _heading.i), 0)"))
    cells = F.expr(dom.table_cells("nodes", "_table"))

    def line(c: Column) -> Column:
        need, priority = F.get(c, F.lit(1)), F.get(c, F.lit(2))
        mark = F.when(present(priority), F.concat(F.lit("["), priority, F.lit("] "))).otherwise("")
        return F.when(need != "", F.concat(mark, need))

    lines = F.transform(F.slice(cells, F.lit(2), F.lit(1 << 30)), line)
    return rows.withColumn("requirements", F.coalesce(F.array_join(lines, "\n"), F.lit("")))


def institute_postings(lists: DataFrame, details: DataFrame, base: str,
                       as_of: datetime | None = None) -> DataFrame:
    """Vacancy rows joined with their detail pages (ref, html); the first row of
    a reference with a long enough title counts, or the first one if none has.
    A missing posting date is `as_of`."""
    listed = vacancy_rows(lists).withColumn("_bad", F.length("title") < 5)
    # Broken pages have no reference; each is a row of its own.
    listed = listed.withColumn("_own", F.when(F.col("broken"), F.col("page")))
    rows = dedup_first(listed, ["ref", "_own"], ["_bad", "page", "pos", "title"]).drop("_bad", "_own")
    # Pages are much larger than their source is estimated, so they are never broadcast; listed ones are parsed.
    d = latest_capture(details, ["ref"], ["html"]).hint("merge")
    rows = with_requirements(rows.join(d, "ref", "left").withColumn("nodes", dom.parse_nodes("html")))
    job, place = prose.split_last(F.col("title"), " - ")
    html = F.col("html")
    rows = rows.withColumn("_duties", F.coalesce(
        blank_to_null(prose.between(html, DUTIES, REQUIREMENTS)),
        prose.between(html, DUTIES_ELSE, REQUIREMENTS)))
    url = F.concat(F.lit(f"{base}/Home/SingleJobView/"), "ref")
    return shape(rows, {
        "source": F.lit("kemri"), "title": job, "company": F.lit(INSTITUTE),
        "location": prose.place_with_country(place), "description": F.col("_duties"),
        "requirements": F.col("requirements"), "job_type": F.col("emp_type"),
        "url": url, "apply_url": url, "external_id": composite("kemri", F.col("ref")),
        "posted_date": F.coalesce(dates.labelled_date(html, ADVERTISED), F.lit(as_of).cast("timestamp_ntz")),
        "application_deadline": dates.labelled_date(html, CLOSING),
    }, [
        ("unparseable page", F.col("broken")),
        ("no detail page", html.isNull()),
        ("short title", F.length("title") < 5),
        ("short description", ~F.coalesce(F.length("_duties") >= 30, F.lit(False))),
    ])
