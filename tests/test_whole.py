"""Registered queries that cover the whole of what their operator is for."""

from pyspark.sql import functions as F

import __spark_entry__ as entry


def test_sections_are_not_cut(spark):
    rows = entry.queries()["section_by_heading_whole"](spark, "/root/testdata/sf0.01")
    ends = rows.where(F.length("description") > 5000).select(
        F.col("description").endswith(F.concat(F.lit("\noffered "), F.col("page_id"))).alias("e")).collect()
    assert ends and all(r.e for r in ends)


def test_every_row_is_ranked(spark, sf):
    ranks = entry.queries()["sort_jobs_all"](spark, sf).groupBy("ordering").agg(
        F.count("*").alias("n"), F.count_distinct("rank").alias("d"), F.max("rank").alias("last")).collect()
    assert len(ranks) > 1 and all(r.n == r.d == r["last"] > 100 for r in ranks)


def test_every_source_comes_back(spark, sf):
    rows = entry.queries()["snapshot_roundtrip_all"](spark, sf)
    assert rows.select("source").distinct().count() > 1
