"""Cleaning rules on edge values, against a plain restatement of the rules."""

import html
import re

import pytest
from pyspark.sql import functions as F

from gleanery import vocab
from gleanery.functions import dates, prose, salary, urls
from gleanery.functions import text as tx
from gleanery.operators import clean

EDGES = [None, "", "  ", "\t", "\xa0", "\x1c", "&lt;b&gt;x&lt;/b&gt;", "a&amp;lt;b", "R&D &copy; &eacute &#8364;5",
         "&nbsp; a \x1c b ", "<p>one</p><p>two</p>", "a < b > c", "x&ampy", "&&lt;", "plain", "<br>", "a&b;c"]


def column(spark, values, fn, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    out = rows.select("i", fn(F.col("v")).alias("r")).collect()
    return [r.r for r in sorted(out, key=lambda r: r.i)]


def expected_clean(s):
    if not s:
        return None
    s = re.sub(r"<[^>]+>", " ", html.unescape(s))
    return re.sub(r"\s+", " ", s).strip() or None


def test_clean_text(spark):
    assert column(spark, EDGES, tx.clean_text) == [expected_clean(s) for s in EDGES]


def test_strip_is_unicode(spark):
    values = ["\xa0 a b　", "\x1f\tq", None, "", " "]
    assert column(spark, values, tx.strip) == [v if v is None else v.strip() for v in values]


JOB_TYPES = [None, "", " ", "Full Time", "PART-TIME ", "International", "temp", "Contract or part time", " Odd "]


def test_job_type_ladder(spark):
    def rule(s):
        if not s:
            return None
        low = s.lower().strip()
        return next((v for k, v in vocab.JOB_TYPES if k in low), low)
    assert column(spark, JOB_TYPES, tx.normalize_job_type) == [rule(s) for s in JOB_TYPES]


def test_whole_word_option(spark):
    got = column(spark, ["International", "intern", "an Intern!"],
                 lambda c: tx.normalize_job_type(c, whole_word=True))
    assert got == ["international", "internship", "internship"]
    tags = column(spark, ["javascript email", "java, ai"], lambda c: tx.extract_tags(c, whole_word=True))
    assert tags == ["javascript", "java,ai"]


def test_levels_are_ordered(spark):
    values = ["Associate Director", "Sr. Lead", "VP", "Graduate head", "Unspecified", None, ""]
    assert column(spark, values, tx.normalize_experience_level) == [
        "mid", "senior", "executive", "entry", "unspecified", None, None]


def test_remote_phrase_may_span_fields(spark):
    df = spark.createDataFrame([("Work from", "home office", None, "", None)],
                               "title string, location string, description string, job_type string, remote boolean")
    hay = tx.remote_haystack(*[F.col(c) for c in ("title", "location", "description", "job_type")])
    assert df.select(tx.detect_remote(F.col("remote"), hay).alias("r")).first().r is True


def test_currency_ignores_zero(spark):
    rows = [(0.0, 0.0, None, "Nairobi"), (0.0, 5.0, "", "Nairobi"), (5.0, None, None, "Oslo"),
            (5.0, None, "EUR", "Oslo"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "a double, b double, c string, l string")
    got = [r.x for r in df.select(tx.default_currency(
        F.col("c"), F.col("a"), F.col("b"), F.col("l")).alias("x")).collect()]
    assert got == [None, "KES", "USD", "EUR", None]


def test_long_keyword_lists_agree_with_short_ones(spark):
    words = [f"w{i}" for i in range(100)] + ["java"]
    assert column(spark, ["w7 java w99x", "none"], lambda c: tx.extract_tags(c, words)) == ["w7,w9,w99,java", None]


def test_title_case_equals_python(spark):
    values = ["data-science it's 3d aß", "ßa ÉCOLE", "o'neil_x y2k", "日本a"]
    assert column(spark, values, tx.title_case) == [v.title() for v in values]


def test_like_pattern(spark):
    assert tx.like_pattern(r"%a\b\%c\\%") == r"%ab\%c\\%"
    got = column(spark, ["50%_x", "50axx"], lambda c: c.ilike("%" + tx.escape_like("%_") + "%"))
    assert got == [True, False]


def test_clean_chain_keeps_columns_and_drops_untitled(spark):
    rows = [("<i> </i>", None), ("A &amp; B", "intern remote")]
    df = spark.createDataFrame(rows, "title string, description string")
    for c in ("company", "location", "job_type", "experience_level", "salary_currency", "url", "apply_url", "tags"):
        df = df.withColumn(c, F.lit(None).cast("string"))
    df = df.withColumns({"salary_min": F.lit(None).cast("double"), "salary_max": F.lit(None).cast("double"),
                         "remote": F.lit(None).cast("boolean")})
    out = clean.clean_jobs(df)
    assert out.columns == df.columns
    (row,) = out.collect()
    assert (row.title, row.remote, row.tags) == ("A & B", True, None)


@pytest.mark.parametrize("text,want", [
    ("Deadline: 5 March 2024", "2024-03-05"), ("closing  date : march 5, 2024", "2024-03-05"),
    ("05/01/2024", "2024-01-05"), ("5 january 2024", "2024-01-05"), ("garbage", None), ("31/02/2024", None),
    ("005/01/2024", None), ("5 Sep 2024", "2024-09-05"), ("5 Sept 2024", None), ("2024-1-5", "2024-01-05")])
def test_deadlines(spark, text, want):
    (got,) = column(spark, [text], lambda c: dates.parse_deadline(c).cast("date").cast("string"))
    assert got == want


def test_two_digit_years(spark):
    got = column(spark, ["1/5/99", "1/5/69", "1/5/68", "1/5/00", "1/5/1999"],
                 lambda c: F.year(dates.parse_date(c, ["%m/%d/%y"])))
    assert got == [1999, 1969, 2068, 2000, None]


def test_instants_do_not_depend_on_the_session_zone(spark):
    values = ["2024-01-05T10:00:00Z", "2024-01-05T10:00:00+03:00", "2024-01-05", "2024", "1700000000", None]
    want = ["2024-01-05 10:00:00", "2024-01-05 07:00:00", "2024-01-05 00:00:00", None, None, None]
    for zone in ("UTC", "Africa/Nairobi"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert column(spark, values, lambda c: dates.iso_instant(c).cast("string")) == want
            assert column(spark, ["1700000000", "x", "2024-01-01T00:00:00"],
                          lambda c: dates.epoch_seconds(c).cast("string")) == ["2023-11-14 22:13:20", None, None]
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_salary_texts(spark):
    values = ["KSh 50,000 - 80,000", "$50k", ",", "1.5m", None, "negotiable"]
    low = column(spark, values, lambda c: salary.bounds(c, "both")[0])
    high = column(spark, values, lambda c: salary.bounds(c, "both")[1])
    assert low == [50000.0, 50.0, None, 1.0, None, None]
    assert high == [80000.0, 50.0, None, 5.0, None, None]
    assert column(spark, values, lambda c: salary.unreadable(c, "min_only")) == [
        False, False, True, False, False, False]
    with pytest.raises(ValueError):
        salary.bounds(F.lit("1"), "other")


def test_urls(spark):
    assert column(spark, ["", None, "/a", "http://x/y"], lambda c: urls.absolutize(c, "https://b")) == [
        None, None, "https://b/a", "http://x/y"]
    assert column(spark, ["a", "/a"], lambda c: urls.absolutize(c, "https://b", root_only=True)) == [None, "https://b/a"]
    assert column(spark, ["https://b/c/d//", "https://b/c?x=1", ""], urls.last_segment) == ["d", "c?x=1", None]


def test_between(spark):
    text = "<h4>Duties:</h4><p>a</p> <p>b</p><h4>Next:</h4>"
    assert column(spark, [text], lambda c: prose.between(c, "Duties:", "Next:")) == ["a\nb"]
    assert column(spark, [text], lambda c: prose.between(c, "Missing:", "Next:")) == [""]
    open_end = ["S:" + "x" * 6000]
    assert column(spark, open_end, lambda c: F.length(prose.between(c, "S:", "none"))) == [6000]
    assert column(spark, open_end, lambda c: F.length(prose.between(c, "S:", "none", reach=5000))) == [5000]


def test_latched_split(spark):
    rows = spark.createDataFrame([("Intro\n\n Requirements \nx\ny",), ("only intro",), (None,)], "t string")
    lines = rows.select(prose.lines(F.col("t")).alias("l"))
    d, r = prose.split_latched(F.col("l"), vocab.REQUIREMENT_WORDS_ATS)
    assert [tuple(x) for x in lines.select(d, r).collect()] == [
        ("Intro", "Requirements\nx\ny"), ("only intro", ""), ("", "")]
