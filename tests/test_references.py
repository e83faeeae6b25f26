"""Character references without Python workers, against the standard library."""

import html
import random
from html.entities import html5

from pyspark.sql import functions as F

from checks.fixtures import view
from gleanery.functions.text import unescape_html
from gleanery.operators.clean import clean_jobs


def same(spark, texts):
    texts = list(dict.fromkeys(texts))
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", unescape_html(F.col("t")).alias("t"))
    wrong = [(texts[r.i], r.t, html.unescape(texts[r.i])) for r in df.collect() if r.t != html.unescape(texts[r.i])]
    assert not wrong, wrong[:5]


def test_all_names(spark):
    same(spark, [f"a&{n}b" for n in html5] + [f"&{n}" for n in html5] + [f"x &{n.rstrip(';')} y" for n in html5])


def test_numbers(spark):
    numbers = [*range(0, 0x120), 0x26F, 0x20AC, 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDCF, 0xFDD0, 0xFDEF, 0xFDF0, 0xFFFD,
               0xFFFE, 0xFFFF, 0x10000, 0x1F600, 0x1FFFE, 0x10FFFD, 0x10FFFF, 0x110000, 9_999_999, 10**12, 10**30]
    same(spark, [f"a&#{n};b" for n in numbers] + [f"a&#{n} b" for n in numbers]
         + [f"a&#x{n:x};b" for n in numbers] + [f"&#X{n:X}z" for n in numbers] + ["&#000065;", "&#x00041;", "&#;", "&#x;", "&#xg", "&#"])


def test_random_texts(spark):
    rng = random.Random(3)
    bits = ["&", "#", "x", ";", "amp", "lt", "notin", "not", "copy", "frac12", "é", "\U0001f600", " ", "\n", "<", "1", "ff",
            "nbsp", "CounterClockwiseContourIntegral", "a" * 40, "&&", "&amp;", "&eacute", "&notit;", "&ampamp;"]
    same(spark, ["".join(rng.choice(bits) for _ in range(rng.randint(1, 12))) for _ in range(3000)] + ["", "&", "&amp;lt;"])


def test_null(spark):
    df = spark.createDataFrame([(None,)], "t string").select(unescape_html(F.col("t")).alias("t"))
    assert df.first().t is None


def test_no_python_in_the_chain(spark, sf):
    plan = clean_jobs(view(spark, sf, "jobs"))._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan
