"""Interest matching against brute force."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gleanery.operators import match

WORDS = ["data", "sql", "ai", "python", "lead", "é", "c++", "ops", "engineer", "x_y", "50%"]
KEYWORDS = ["data", "at", "a", "sql lead", "d_ta", "ENG".lower(), "%", "zzz", "ops%ai", "c++", "é", "n e", "x\\y"]


@pytest.fixture(scope="module")
def jobs(spark):
    rng = random.Random(5)
    def text():
        return rng.choice([None, "", " ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 7)))])
    rows = [(i, text(), text(), rng.random() < 0.8,
             rng.choice([None, datetime(2024, 1, 1) + timedelta(days=rng.randrange(30))])) for i in range(120)]
    return rows, spark.createDataFrame(
        rows, "id long, title string, description string, is_active boolean, scraped_at timestamp_ntz")


def like(keyword, text):
    if text is None:
        return False
    keyword = keyword.replace("\\", "")
    body = "".join("." if c == "_" else ".*" if c == "%" else re.escape(c) for c in keyword)
    return re.search(body, text.lower(), re.S) is not None


@pytest.mark.parametrize("options", [{"listed": 0}, {"listed": 0, "per_pass": 2}, {}])
def test_hits_equal_brute_force(spark, jobs, options):
    rows, df = jobs
    kws = spark.createDataFrame([(k,) for k in KEYWORDS + KEYWORDS], "keyword string")
    got = match.keyword_hits(df, kws, columns=["id"], **options).collect()
    want = {(k.replace("\\", ""), r[0]) for k in KEYWORDS for r in rows
            if r[3] and (like(k, r[1]) or like(k, r[2]))}
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == want


def test_literal_keywords(spark, jobs):
    rows, df = jobs
    kws = spark.createDataFrame([("x_y",), ("50%",), ("d_ta",)], "keyword string")
    for listed in (0, 100):
        got = {tuple(r) for r in match.keyword_hits(df, kws, columns=["id"], wildcards=False, listed=listed).collect()}
        want = {(k, r[0]) for k in ("x_y", "50%", "d_ta") for r in rows
                if r[3] and (k in (r[1] or "") or k in (r[2] or ""))}
        assert got == want


def test_top_matches_equal_brute_force(spark, jobs):
    rows, df = jobs
    interests = ["data, sql", "ai", "zzz", None, "", "python lead ops", "d_ta"]
    users = spark.createDataFrame([(i, s) for i, s in enumerate(interests)], "id long, job_interests string")
    order = sorted([r for r in rows if r[3]], key=lambda r: (r[4] is not None, -(r[4] or datetime.min).timestamp()
                                                             if r[4] else 0, r[0]))
    want = {}
    for i, s in enumerate(interests):
        words = [w for w in (s or "").replace(",", " ").split() if len(w) > 2] or ([s.strip()] if s else [])
        found = [r[0] for r in order if any(like(w, r[1]) or like(w, r[2]) for w in words)][:5]
        want[i] = found or [r[0] for r in order][:5]
    got = {}
    for r in sorted(match.user_recommendations(df, users).collect(), key=lambda r: (r.user_id, r.rank)):
        got.setdefault(r.user_id, []).append(r.job_id)
    assert got == want


def test_tokens(spark):
    df = spark.createDataFrame([("Python, SQL  ai",), (" AI ",), ("a b",), ("",), (None,)], "s string")
    got = [r.t for r in df.select(match.interest_tokens(F.col("s")).alias("t")).collect()]
    assert got == [["python", "sql"], ["ai"], ["a b"], None, None]


@pytest.mark.parametrize("slices", [(), (0.1,), (0.02, 0.3)])
def test_slices_do_not_change_the_best(spark, jobs, slices):
    _, df = jobs
    kws = spark.createDataFrame([(k,) for k in KEYWORDS], "keyword string")
    def best(s):
        return sorted(tuple(r) for r in match.top_hits(
            df, kws, columns=["id", "scraped_at"], slices=s).select("keyword", "id").collect())
    assert best(slices) == best(()) != []


def test_old_jobs_are_matched_for_rare_keywords_only(spark):
    """Of 1,000 jobs a common word fills its five places from the newest tenth."""
    df = spark.range(1000).select(
        "id", F.when(F.col("id") == 3, "rare").otherwise("common").alias("title"), F.lit(None).cast("string").alias("description"),
        F.lit(True).alias("is_active"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("scraped_at"))
    kws = spark.createDataFrame([("common",), ("rare",)], "keyword string")
    seen = []
    real = match.keyword_hits
    match.keyword_hits = lambda j, k, **o: seen.append((j.count(), sorted(r.keyword for r in k.collect()))) or real(j, k, **o)
    try:
        got = match.top_hits(df, kws, columns=["id", "scraped_at"], slices=(0.1,)).collect()
    finally:
        match.keyword_hits = real
    assert sorted(r.id for r in got if r.keyword == "common") == [995, 996, 997, 998, 999]
    assert [r.id for r in got if r.keyword == "rare"] == [3]
    assert [k for _, k in seen] == [["common", "rare"], ["rare"]] and seen[0][0] <= 101 and sum(n for n, _ in seen) == 1000


def test_keywords_are_looked_up_by_their_rarest_piece(spark):
    texts = ["the data of the team"] * 50 + ["the zebra of the team"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, _t string").withColumn(
        "_d", F.lit(None).cast("string"))
    words = match._words_of(match._identified(df))
    kws = spark.createDataFrame([("the zebra",), ("team",), ("a%of",), ("none the",)], "keyword string")
    found = {(r.keyword, r.word) for r in match.word_keywords(words, kws, True).collect()}
    # "the" and "of" are in every text, "zebra" in one; no text holds "none", so nothing is looked up.
    assert {w for k, w in found if k == "the zebra"} == {"zebra"}
    assert {w for k, w in found if k == "team"} == {"team"}
    assert not [w for k, w in found if k == "none the"]
    candidates = words.join(match.word_keywords(words, kws, True), "word").where("keyword = 'the zebra'")
    assert candidates.count() == 1


def test_hot_keys_are_dealt_out(spark):
    rows = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    one = spark.createDataFrame([("hot", 1), ("1", 2), ("none", 3)], "k string, v int")
    for how, n in (("inner", 2001), ("left", 6000)):
        got = match.join_hot(rows, one, "k", how)
        assert got.count() == n and got.where("v IS NOT NULL").count() == 2001
    dealt = match.join_hot(rows, one, "k")
    assert "_salt" in dealt._jdf.queryExecution().optimizedPlan().toString()
