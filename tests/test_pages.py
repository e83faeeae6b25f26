"""Pages by rank equal slices of the whole order, at any depth and over any ranges."""

import pytest
from pyspark.sql import functions as F

from gleanery.operators import catalog


@pytest.mark.parametrize("sort_by,order", [("scraped_at", "desc"), ("scraped_at", "asc"), ("title", "asc")])
def test_every_page(spark, sort_by, order):
    """Ties, missing values, and one value that a third of the rows share."""
    day = F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 50)
    jobs = spark.range(1, 318).select("id", F.concat(F.lit("t"), F.col("id") % 13).alias("title"),
                                      F.date_add(F.lit("2024-01-01"), day.cast("int")).cast("timestamp_ntz").alias("scraped_at"))
    want = [r.id for r in catalog.sort_jobs(jobs, sort_by, order).collect()]
    ranked = catalog.Ranked(jobs.repartition(5), sort_by, order, rows_per_file=40)
    assert ranked.total == len(want)
    for number in (1, 2, 7, 16):
        got = sorted((r["rank"], r.id) for r in ranked.page(number).collect())
        first = (number - 1) * 20
        assert got == [(first + i + 1, x) for i, x in enumerate(want[first:first + 20])]
    assert ranked.page(17).collect() == []
    assert [r.id for r in ranked.page(1, 1000).orderBy("rank").collect()] == want


def test_only_the_page_is_read(spark):
    ranked = catalog.Ranked(spark.range(1000).select("id", F.lit(None).cast("timestamp_ntz").alias("scraped_at")))
    plan = ranked.page(50)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(place" in plan


def test_empty(spark):
    ranked = catalog.Ranked(spark.createDataFrame([], "id bigint, scraped_at timestamp_ntz"))
    assert ranked.total == 0 and ranked.page(1).collect() == []
    with pytest.raises(ValueError):
        ranked.page(0)
