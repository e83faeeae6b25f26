"""Dates written in many ways. Unparseable text gives NULL, never an error."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery import vocab
from gleanery.functions.text import WS, strip

# strptime notation -> (shape the text must have, Spark pattern). The shape is
# needed because Spark accepts more digits than strptime does.
_DAY, _YEAR, _NAME = r"\d{1,2}", r"\d{4}", r"\p{L}+"
_FORMATS = {
    "%d %B %Y": (f"{_DAY} {_NAME} {_YEAR}", "d MMMM yyyy"),
    "%B %d, %Y": (f"{_NAME} {_DAY}, {_YEAR}", "MMMM d, yyyy"),
    "%d/%m/%Y": (f"{_DAY}/{_DAY}/{_YEAR}", "d/M/yyyy"),
    "%Y-%m-%d": (f"{_YEAR}-{_DAY}-{_DAY}", "yyyy-M-d"),
    "%d %b %Y": (f"{_DAY} {_NAME} {_YEAR}", "d MMM yyyy"),
    "%d-%m-%Y": (f"{_DAY}-{_DAY}-{_YEAR}", "d-M-yyyy"),
    "%m/%d/%y": (f"{_DAY}/{_DAY}/\\d{{2}}", "M/d/yy"),
}
_PIVOT = 2069  # two-digit years from 69 on belong to the 1900s
_ISO = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?(?:Z|[+-]\d{2}:\d{2})?)?$"
_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _parse(c: Column, fmt: str) -> Column:
    shape, pattern = _FORMATS[fmt]
    day = F.try_to_date(F.when(c.rlike(f"^{shape}$"), c), pattern)
    if "%y" in fmt:
        day = F.when(F.year(day) >= _PIVOT, F.add_months(day, -1200)).otherwise(day)
    return day.cast("timestamp_ntz")


def parse_date(c: Column, formats: list[str]) -> Column:
    """The first format that fits, in list order."""
    tidy = F.regexp_replace(c, f"{WS}+", " ")
    return F.coalesce(*[_parse(tidy, f) for f in formats])


def parse_deadline(c: Column, formats: list[str] | None = None,
                   label: str = vocab.DEADLINE_LABEL, ignore_case: bool = True) -> Column:
    """Remove the label wherever it stands, strip, then try the formats."""
    flag = "(?i)" if ignore_case else ""
    bare = strip(F.regexp_replace(c, flag + label, ""))
    return parse_date(bare, formats or vocab.DEADLINE_FORMATS)


def iso_seconds(c: Column) -> Column:
    """First 19 characters as yyyy-MM-ddTHH:mm:ss."""
    head = F.left(c, F.lit(19))
    return F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$"), head).try_cast("timestamp_ntz")


def iso_day(c: Column) -> Column:
    """First 10 characters as yyyy-MM-dd."""
    return parse_date(F.left(c, F.lit(10)), ["%Y-%m-%d"])


def iso_instant(c: Column) -> Column:
    """ISO text, moved to UTC where it carries an offset."""
    text = F.when(c.rlike(_ISO), c)
    zoned = c.rlike(r"(?:Z|[+-]\d{2}:\d{2})$")
    micros = F.unix_micros(F.when(zoned, text).try_cast("timestamp"))
    utc = F.expr(_EPOCH) + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (micros / F.lit(1_000_000)).cast("decimal(18,6)"))
    return F.when(zoned, utc).otherwise(text.try_cast("timestamp_ntz"))


def epoch_seconds(c: Column) -> Column:
    """Whole seconds since 1970; anything else, ISO text included, is NULL."""
    seconds = F.when(c.rlike(r"^\s*[+-]?\d{1,11}\s*$"), F.trim(c)).try_cast("bigint")
    return F.expr(_EPOCH) + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def ordinal_deadline(text: Column) -> Column:
    """'Deadline: 5th March 2025' in running text."""
    found = F.regexp_extract(
        text, rf"(?i)(?:Deadline|Application Deadline)[:\s]*(\d{{1,2}}(?:st|nd|rd|th)?\s+\w+\s+\d{{4}})", 1)
    return parse_date(F.regexp_replace(found, r"(\d+)(?:st|nd|rd|th)", "$1"), ["%d %B %Y"])


def labelled_date(text: Column, label: str) -> Column:
    """'<label> 1/5/99', month first, two-digit year."""
    return parse_date(F.regexp_extract(text, rf"{label}\s*([\d/]+)", 1), ["%m/%d/%y"])
