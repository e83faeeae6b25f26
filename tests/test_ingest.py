"""Whole ingest runs: the log, ties and plans."""

from datetime import datetime

from pyspark.sql import functions as F

from checks.match_queries import both
from checks.run_queries import stored_jobs
from gleanery import schema, vocab
from gleanery.operators import match
from gleanery.plans import jobs
from gleanery.sources.registry import Landed
from gleanery.sources import tables

NOW = datetime(2024, 2, 1)
CARD = '<div class="base-card"><h3>{}</h3><a href="/view/{}">x</a></div>'
PAGE = "source string, page int, html string, site string, company string, site_url string"


def landed(spark, *rows):
    return Landed(pages=spark.createDataFrame([(*r, None, None, None)[:6] for r in rows], PAGE))


def empty_jobs(spark):
    return spark.createDataFrame([], schema.JOBS)


def test_log_names_the_registered_sources(spark):
    result = '<div class="g"><a href="https://r.test/1"><h3>Dev</h3></a></div>'
    pages = spark.createDataFrame([
        ("google_search", 1, result, "linkedin.com", None, None), ("google_search", 2, result, "indeed.com", None, None),
        ("linkedin", 1, "<p>no card</p>", None, None, None), ("glassdoor", 1, "<![foo[ b ]]>", None, None, None)], PAGE)
    run = jobs.ingest(spark, Landed(pages=pages), empty_jobs(spark), NOW,
                      sources=["google_search", "linkedin", "glassdoor", "adzuna"])
    log = {r.source: (r.status, r.jobs_found, r.jobs_new, r.error_message) for r in run.log.collect()}
    assert log == {"google_search": ("success", 2, 2, None), "linkedin": ("empty", 0, 0, None),
                   "glassdoor": ("failed", 0, 0, "1 unparseable pages"), "adzuna": ("empty", 0, 0, None)}


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    rows = [("linkedin", 1, CARD.format(t, 9)) for t in ("Beta", "Alpha", "Gamma")]
    titles = set()
    for order in (rows, rows[::-1], [rows[1], rows[2], rows[0]]):
        for parts in (1, 3):
            run = jobs.ingest(spark, Landed(pages=landed(spark, *order).pages.repartition(parts)),
                              empty_jobs(spark), NOW, sources=["linkedin"])
            titles |= {r.title for r in run.jobs.collect()}
    assert len(titles) == 1


def test_only_a_plan_limits_pages(spark):
    rows = [("linkedin", n, CARD.format(f"Job {n}", n)) for n in range(1, 9)]
    every = jobs.full_refresh(spark, landed(spark, *rows), empty_jobs(spark), NOW)
    assert every.jobs.count() == 8
    planned = jobs.full_refresh(spark, landed(spark, *rows), empty_jobs(spark), NOW, plan=vocab.DAILY_PLAN)
    assert planned.jobs.count() == 3
    assert jobs.quick_refresh(spark, landed(spark, *rows), empty_jobs(spark), NOW).jobs.count() == 2


def test_alerts_cover_the_requested_users(spark, sf):
    postings, users = both(spark, sf)
    ids = users.select("id").where("id % 3 = 0")
    payload, stamped = jobs.alerts(postings, users, ids, NOW, site="https://jobs.test")
    want = match.alert_payload(postings, users, site="https://jobs.test").where("user_id % 3 = 0")
    assert sorted(map(str, payload.collect())) == sorted(map(str, want.collect()))
    mailed = {r.id for r in stamped.where(F.col("last_emailed_at") == F.lit(NOW)).collect()}
    assert mailed == {r.id for r in ids.collect()}


def test_stored_rows_keep_their_first_title(spark, sf):
    stored = tables.evolve(stored_jobs(spark, sf), schema.JOBS)
    run = jobs.ingest(spark, landed(spark, ("linkedin", 1, CARD.format("Dev", 1))), stored, NOW, sources=["linkedin"])
    assert run.jobs.count() == stored.count() + 1
