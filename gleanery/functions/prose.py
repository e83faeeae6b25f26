"""Sections, places, types and labels inside longer texts.

Everything works on the array of lines inside the row, so no text is exploded
and nothing is shuffled.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery import vocab
from gleanery.functions.text import (WS, blank_to_null, contains_any, present, strip,
                                     truncate, unescape_html)

_MARK = "\x01"
_NO_TEXT = (r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
            r"|<!doctype[^>]*>|</?[a-z][^>]*>")


def html_lines(c: Column) -> Column:
    """Text nodes of an HTML fragment, each stripped, empty ones left out."""
    marked = unescape_html(F.regexp_replace(c, _NO_TEXT, _MARK))
    nodes = F.transform(F.split(marked, _MARK), strip)
    return F.filter(nodes, lambda s: s != "")


def html_to_text(c: Column) -> Column:
    """HTML fragment to text with a newline between text nodes."""
    return F.coalesce(F.array_join(html_lines(c), "\n"), F.lit(""))


def lines(c: Column) -> Column:
    """Stripped, non-empty lines."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "\n"), strip), lambda s: s != "")


def drop_lines(rows: Column, phrases: list[str] | None = None) -> Column:
    words = vocab.NAVIGATION_PHRASES if phrases is None else phrases
    return F.filter(rows, lambda ln: ~contains_any(F.lower(ln), words))


def split_latched(rows: Column, words: list[str]) -> tuple[Column, Column]:
    """(description, requirements): the first line with a requirement word and
    all lines after it are requirements."""
    hits = F.transform(rows, lambda ln: contains_any(F.lower(ln), words))
    at = F.array_position(hits, F.lit(True)).cast("int")
    before = F.when(at > 0, F.slice(rows, F.lit(1), at - 1)).otherwise(rows)
    after = F.when(at > 0, F.slice(rows, at, F.size(rows)))
    return F.array_join(before, "\n"), F.coalesce(F.array_join(after, "\n"), F.lit(""))


def split_by_heading(blocks: Column, headings: list[tuple[str, str]],
                     described: tuple[str, ...] = ("desc",),
                     width: tuple[int | None, int | None] = (None, None),
                     ) -> tuple[Column, Column]:
    """(description, requirements) of an ordered block array.

    A block is struct(tag, text, items). Headings set the current section; list
    items go to requirements under 'req' and to the description otherwise;
    paragraphs over 20 characters go to requirements under 'req', to the
    description under `described` or before any heading, and nowhere else.
    """
    blank = F.struct(
        F.lit("").alias("section"),
        F.array().cast("array<string>").alias("desc"),
        F.array().cast("array<string>").alias("req"))

    def section_of(text: Column) -> Column:
        low, ladder = F.lower(text), None
        for name, pattern in headings:
            ladder = (F.when(low.rlike(pattern), name) if ladder is None
                      else ladder.when(low.rlike(pattern), name))
        return ladder.otherwise("other")

    def step(acc: Column, b: Column) -> Column:
        heading = b["tag"].isin("h1", "h2", "h3", "h4")
        parts = F.when(b["tag"].isin("ul", "ol"), b["items"]).when(
            ~heading & (F.length(b["text"]) > 20), F.array(b["text"])
        ).otherwise(F.array().cast("array<string>"))
        in_req = acc["section"] == "req"
        in_desc = ~in_req & (b["tag"].isin("ul", "ol") | acc["section"].isin("", *described))
        return F.struct(
            F.when(heading, section_of(b["text"])).otherwise(acc["section"]).alias("section"),
            F.when(in_desc, F.concat(acc["desc"], parts)).otherwise(acc["desc"]).alias("desc"),
            F.when(in_req, F.concat(acc["req"], parts)).otherwise(acc["req"]).alias("req"))

    folded = F.aggregate(F.filter(blocks, lambda b: b["text"] != ""), blank, step)
    texts = [blank_to_null(F.array_join(folded[part], "\n")) for part in ("desc", "req")]
    desc, req = (t if w is None else truncate(t, w) for t, w in zip(texts, width))
    return desc, req


def strip_boilerplate(html: Column, tags: list[str] | None = None) -> Column:
    """Remove the given elements with everything inside them."""
    names = "|".join(vocab.BOILERPLATE_TAGS if tags is None else tags)
    return F.regexp_replace(html, rf"(?is)<({names})\b[^>]*>.*?</\1\s*>", "")


def between(html: Column, start: str, end: str, reach: int | None = None, tag_gap: int = 20) -> Column:
    """Text between two markers: '' without the first; without the second all
    that follows, or `reach` characters of it. A closing '>' within `tag_gap` characters of the
    first marker is skipped."""
    begin = F.locate(start, html)
    after = begin + F.lit(len(start))
    gap = F.locate(">", F.substring(html, after, F.lit(tag_gap)))
    body = F.when(gap > 0, after + gap).otherwise(after)
    stop = F.locate(end, html)
    span = F.when(stop > 0, F.greatest(stop - body, F.lit(0))).otherwise(F.length(html) if reach is None else F.lit(reach))
    cut = html_to_text(F.substring(html, body, span))
    tidy = F.array_join(lines(cut), "\n")
    return F.when(begin > 0, tidy).when(html.isNotNull(), F.lit(""))


_ANCHOR = r'(?is)<a\b([^>]*)>(.*?)</a\s*>'


def apply_link(html: Column, own: str, words=("apply", "read more")) -> Column:
    """Target of the first link whose text holds one of the words and which
    leads, absolutely, to another site."""
    attrs = F.regexp_extract_all(html, F.lit(_ANCHOR), F.lit(1))
    texts = F.regexp_extract_all(html, F.lit(_ANCHOR), F.lit(2))
    href = r"""(?is)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    targets = F.transform(attrs, lambda a: F.concat(
        F.regexp_extract(a, href, 1), F.regexp_extract(a, href, 2), F.regexp_extract(a, href, 3)))

    def fits(link: Column) -> Column:
        label = F.lower(F.regexp_replace(link["text"], "<[^>]+>", ""))
        return (contains_any(label, list(words)) & ~link["href"].contains(own)
                & link["href"].startswith("http"))

    links = F.zip_with(targets, texts, lambda h, t: F.struct(h.alias("href"), t.alias("text")))
    return F.replace(F.get(F.filter(links, fits), F.lit(0))["href"], F.lit("&amp;"), F.lit("&"))


def extract_location(text: Column, labels: list[str] | None = None, countries: list[str] | None = None,
                     cities: list[str] | None = None, city_countries: list[str] | None = None) -> Column:
    """A labelled place ending in a known country, else the first known city in
    list order with its country if named anywhere, else ''."""
    labels = "|".join(map(_literal, vocab.LOCATION_LABELS if labels is None else labels))
    countries = "|".join(map(_literal, vocab.LOCATION_COUNTRIES if countries is None else countries))
    pattern = rf"(?i)(?:{labels})[:\s]*([A-Za-z\s,\-]+(?:{countries}))"
    labelled = F.when(text.rlike(pattern), strip(F.regexp_extract(text, pattern, 1)))
    named = vocab.CITY_COUNTRIES if city_countries is None else city_countries
    city = F.coalesce(*[F.when(text.contains(c), c) for c in (vocab.CITIES if cities is None else cities)],
                      F.lit(None).cast("string"))
    country = F.coalesce(*[F.when(text.contains(c), ", " + c) for c in named], F.lit(""))
    return F.coalesce(labelled, F.concat(city, country), F.when(text.isNotNull(), F.lit("")))


def _literal(word: str) -> str:
    """A word as a pattern that matches it alone."""
    return f"\\Q{word}\\E"


def prose_job_type(text: Column, ladder: list[tuple[str, list[str]]] | None = None) -> Column:
    """Job type named in a text, by an ordered substring ladder; '' if none."""
    low = F.lower(text)
    steps = [F.when(contains_any(low, words), value) for value, words in ladder or vocab.PROSE_JOB_TYPES]
    return F.coalesce(*steps, F.lit(""))


def pattern_job_type(text: Column) -> Column:
    """First job type pattern in a text, lowered, blank to hyphen."""
    pattern = f"(?i){vocab.JOB_TYPE_PROSE_PATTERN}"
    hit = F.lower(F.regexp_extract(text, pattern, 0))
    return F.replace(blank_to_null(hit), F.lit(" "), F.lit("-"))


def split_last(c: Column, separator: str) -> tuple[Column, Column]:
    """(before, after) the last separator, both stripped; '' after if absent."""
    has = c.contains(separator)
    n = len(separator)
    before = F.regexp_extract(c, rf"(?s)^(.*)\Q{separator}\E", 1)
    after = F.substring(c, F.length(before) + F.lit(n + 1), F.length(c))
    return (F.when(has, strip(before)).otherwise(c),
            F.when(has, strip(after)).otherwise(F.lit("")))


def place_with_country(place: Column, country: str = "Kenya") -> Column:
    bare = present(place) & ~F.lower(place).contains(country.lower())
    return F.when(bare, F.concat(place, F.lit(f", {country}"))).otherwise(place)


def labelled_field(text: Column, label: str, width: int = 150) -> Column:
    """'Label: value' up to the end of the line, label removed."""
    value = strip(F.regexp_extract(text, rf"(?i){label}\s*:\s*([^\n<]+)", 1))
    return F.when((value != "") & (F.length(value) < width), value)


def join_tags(tags: Column) -> Column:
    """Array to comma text without missing or empty entries."""
    return F.array_join(F.filter(tags, lambda t: present(t)), ",")


def spaced_tags(c: Column) -> Column:
    return F.array_join(F.filter(F.split(c, f"{WS}+"), lambda t: t != ""), ",")


# --- remote flags --------------------------------------------------------


def remote_in_title_or_place(title: Column, location: Column) -> Column:
    return (F.lower(F.coalesce(location, F.lit(""))).contains("remote")
            | F.lower(F.coalesce(title, F.lit(""))).contains("remote"))


def remote_in_text(text: Column) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    return low.contains("remote") & ~low.contains("not remote")


def remote_truthy(flag: Column, location: Column) -> Column:
    """Flag text out of true/1/yes, or a location that says so."""
    low = F.lower(location)
    return (F.coalesce(flag.isin("true", "1", "yes"), F.lit(False))
            | F.coalesce((low == "remote") | low.contains("anywhere"), F.lit(False)))


def remote_code(code: Column) -> Column:
    return F.coalesce(code == "1", F.lit(False))


def hybrid_location(location: Column, code: Column) -> Column:
    return F.when(present(location) & (code == "2"),
                  F.concat(location, F.lit(" (Hybrid)"))).otherwise(location)
