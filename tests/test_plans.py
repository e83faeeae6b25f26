"""Shapes of the physical plans."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks.fixtures import JOBS_AS_OF, view
from gleanery import schema
from gleanery.functions import text as tx
from gleanery.operators import catalog, match, merge
from gleanery.session import work_dir
from gleanery.sources import tables


@pytest.fixture(scope="module")
def stored(spark, sf):
    path = work_dir(spark)
    rows = tables.evolve(view(spark, sf, "jobs"), schema.JOBS).select(*schema.JOBS.fieldNames())
    tables.write_snapshot(rows, path)
    return tables.read_table(spark, "jobs", path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_page_is_one_top_k(stored):
    p = plan(catalog.page(catalog.visible(stored, JOBS_AS_OF).select("id", "title", "scraped_at"), 3, 20))
    assert "TakeOrderedAndProject" in p and "Exchange" not in p


def test_filters_reach_the_files(stored):
    p = plan(catalog.narrow(catalog.by_id(stored, 7), source="indeed", remote=False).select("id", "title"))
    assert "EqualTo(id,7)" in p and "EqualTo(remote," in p
    assert "PartitionFilters: [isnotnull(source" in p
    assert "description" not in p


def test_category_rules_stay_in_the_jvm(stored):
    p = plan(stored.select(tx.normalize_job_type(F.col("job_type")), tx.extract_tags(F.lower("description")),
                           tx.normalize_experience_level(F.col("experience_level"))))
    assert "Python" not in p and "ArrowEval" not in p


def test_merge_has_one_exchange_per_side(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keyed, _ = merge.split_keyed(stored)
        p = plan(merge.merge_collapsed(keyed, merge.collapse_batch(keyed, ["scraped_at", "id"])))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert p.count("Exchange hashpartitioning") == 2


def test_top_k_is_cut_before_the_shuffle(spark, stored, sf):
    kws = spark.createDataFrame([("data",), ("sql",)], "keyword string")
    hits = match.keyword_hits(stored, kws, columns=["id", "scraped_at"], listed=0)
    assert "WindowGroupLimit" in plan(match.top_per_keyword(hits))


def test_recommendations_have_no_cross_join(spark, sf, stored):
    p = plan(match.user_recommendations(stored, view(spark, sf, "users")))
    assert "CartesianProduct" not in p and "NestedLoop" not in p


def test_arguments_are_checked(stored):
    with pytest.raises(ValueError):
        catalog.sort_keys("salary_min")
    with pytest.raises(ValueError):
        catalog.page(stored, 0)
    with pytest.raises(LookupError):
        catalog.require_one(catalog.by_id(stored, -1))


def test_pages_partition_the_sorted_set(stored):
    base = catalog.visible(stored, JOBS_AS_OF).select("id", "scraped_at")
    whole = [r.id for r in catalog.sort_jobs(base).collect()]
    pages, last = [], None
    for n in range(1, 4):
        page = catalog.page(base, n, 7).collect()
        if last is not None:
            after = catalog.page_after(base, last.scraped_at, last.id, 7).collect()
            assert [r.id for r in after] == [r.id for r in page]
        pages += [r.id for r in page]
        last = page[-1] if page else last
    assert pages == whole[:21]


def test_nulls_order_like_the_stored_database(spark):
    df = spark.createDataFrame([(1, None), (2, datetime(2024, 1, 1)), (3, datetime(2024, 1, 2))],
                               "id long, scraped_at timestamp_ntz")
    assert [r.id for r in catalog.sort_jobs(df, order="desc").collect()] == [1, 3, 2]
    assert [r.id for r in catalog.sort_jobs(df, order="asc").collect()] == [2, 3, 1]
