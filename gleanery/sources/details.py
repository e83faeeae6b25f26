"""Detail pages: sections, company, salary, type and place of one posting."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery import vocab
from gleanery.functions import prose, salary
from gleanery.functions.text import strip
from gleanery.sources import dom
from gleanery.sources.dom import Sel, word

COMPANY = {
    "brightermonday": [Sel((), attrs=(("data-cy", "^company-name$"),)),
                       Sel(("a",), attrs=(("href", "/companies/"),)), Sel(("p",), "blue")],
    "summitrecruitment": [Sel((), word("company-name")), Sel((), word("employer-name")),
                          Sel((), "company"), Sel((), "employer")],
}
COMPANY_WIDTH, PLACE_WIDTH = 150, 100


def page_sections(pages: DataFrame, headings: list[tuple[str, str]], key: list[str],
                  width: tuple[int | None, int | None] = (None, None)) -> DataFrame:
    """(key..., description, requirements) by the headings of each page, whole or cut to a width."""
    blocks = pages.select(*key, dom.parse_blocks("html").alias("blocks"))
    described, required = prose.split_by_heading(F.col("blocks"), headings, width=width)
    return blocks.select(*key, described.alias("description"), required.alias("requirements"))


def _short(c: Column, width: int) -> Column:
    return F.when((c != "") & (F.length(c) < width), c)


def detail_fields(pages: DataFrame, style: str) -> DataFrame:
    """Per page: url, description, requirements, company, location, job type, salary,
    and when it was captured if the pages say so."""
    place = ["url", *[c for c in ("captured_at",) if c in pages.columns]]
    rows = pages.select(*place, dom.parse_content("html").alias("nodes"),
                        dom.parse_blocks("html").alias("blocks"))
    described, required = prose.split_by_heading(F.col("blocks"), vocab.SECTION_HEADINGS[style])
    names = {f"company{k}": s for k, s in enumerate(COMPANY[style])}
    # Elements first, then what encloses them, then their texts.
    rows = rows.withColumns({k: F.expr(v) for k, v in {
        "kind": dom.text_node("nodes", rf"(?i)\b(?:{vocab.JOB_TYPE_PROSE_PATTERN})\b"),
        "pay": dom.text_node("nodes", "(?i)KSh|KES|salary"),
        "named": dom.text_node("nodes", f"(?i){vocab.PLACE_PROSE_PATTERN}"),
        "label": dom.text_node("nodes", r"(?i)company\s*:"),
        **{k: dom.first("nodes", [s]) for k, s in names.items()},
    }.items()})
    rows = rows.withColumns({
        "place_el": F.expr(dom.around("nodes", "named", ("span", "p", "div"))),
        "label_el": F.expr(dom.around("nodes", "label", ("td", "div", "li", "p"))),
    })
    rows = rows.withColumns({
        "place": F.expr(dom.text_of("nodes", "place_el")),
        "label_text": F.expr(dom.text_of("nodes", "label_el")),
        **{f"{k}_text": F.expr(dom.text_of("nodes", k)) for k in names},
    })
    company = F.coalesce(*[_short(F.col(f"{k}_text"), COMPANY_WIDTH) for k in names])
    columns = {"description": described, "requirements": required,
               "job_type": prose.pattern_job_type(strip(F.col("kind.text")))}
    if style == "brightermonday":
        low, high = salary.range_bounds(F.col("pay.text"))
        columns.update({
            "salary_min": low, "salary_max": high,
            "salary_currency": F.when(low.isNotNull(), F.lit("KES")),
            "location": _short(F.col("place"), PLACE_WIDTH)})
    else:
        labelled = strip(F.regexp_replace("label_text", r"(?i)company\s*:\s*", ""))
        company = F.coalesce(company, _short(labelled, COMPANY_WIDTH))
    columns["company"] = company
    return rows.select(*place, *[v.alias(k) for k, v in columns.items()])
