"""Counts and dashboard queries. Every groupBy aggregates partially map-side."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.operators.catalog import newest
from gleanery.operators.lifecycle import at, days_before


def job_counts(jobs: DataFrame) -> DataFrame:
    return jobs.agg(F.count("*").alias("total_jobs"),
                    F.count_if("is_active").alias("active_jobs"))


def source_counts(jobs: DataFrame, active_only: bool = False) -> DataFrame:
    rows = jobs.where("is_active") if active_only else jobs
    return rows.groupBy("source").agg(F.count("*").alias("count"))


def stats(jobs: DataFrame, logs: DataFrame, recent: int = 20) -> dict[str, DataFrame]:
    """Totals, per-source counts and the newest log rows."""
    return {
        "totals": job_counts(jobs),
        "sources": source_counts(jobs),
        "recent": newest(logs, recent, "started_at").select(
            "id", "source", "status", "jobs_found", "started_at"),
    }


def run_totals(runs: DataFrame, column: str = "jobs_found") -> DataFrame:
    return runs.agg(F.coalesce(F.sum(column), F.lit(0)).cast("bigint").alias("total_found"))


def recent_logs(logs: DataFrame, as_of: datetime, hours: int = 1) -> DataFrame:
    since = at(as_of) - F.make_dt_interval(F.lit(0), F.lit(hours))
    return logs.where(F.col("started_at") >= since)


def recent_run_summary(logs: DataFrame, as_of: datetime, hours: int = 1) -> DataFrame:
    return recent_logs(logs, as_of, hours).agg(
        F.coalesce(F.sum("jobs_found"), F.lit(0)).cast("bigint").alias("total_found"),
        F.coalesce(F.sum("jobs_new"), F.lit(0)).cast("bigint").alias("total_new"),
        F.count("*").alias("logs"),
    )


def active_total(jobs: DataFrame) -> DataFrame:
    return jobs.where("is_active").agg(F.count("*").alias("total"))


def active_by_source(jobs: DataFrame) -> DataFrame:
    return source_counts(jobs, active_only=True).orderBy(F.col("count").desc(), "source")


def scraped_today(jobs: DataFrame, as_of: datetime) -> DataFrame:
    """Since midnight, and on the day itself; stamps in the future differ."""
    day = F.to_date(at(as_of))
    return jobs.agg(
        F.count_if(F.col("scraped_at") >= day.cast("timestamp_ntz")).alias("since_midnight"),
        F.count_if(F.to_date("scraped_at") == day).alias("on_day"),
    )


def daily_by_source(jobs: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    return (
        jobs.where(F.col("scraped_at") >= days_before(as_of, days))
        .groupBy(F.date_trunc("day", "scraped_at").cast("timestamp_ntz").alias("time"), "source")
        .agg(F.count("*").alias("count"))
    )


def monitor_logs(logs: DataFrame, n: int = 20) -> DataFrame:
    return newest(logs, n, "started_at").select(
        "id", "source", "status", "jobs_found", "jobs_new", "jobs_updated",
        "started_at", "finished_at", "error_message")


def top_locations(jobs: DataFrame, n: int = 10) -> DataFrame:
    """Grouped by the stored value: a missing location and the literal
    'Unknown' stay two groups under one label."""
    counted = jobs.where("is_active").groupBy("location").agg(F.count("*").alias("count"))
    ranked = counted.orderBy(F.col("count").desc(), F.col("location").asc_nulls_last()).limit(n)
    return ranked.select(F.coalesce("location", F.lit("Unknown")).alias("location"), "count")


def remote_split(jobs: DataFrame) -> DataFrame:
    """A missing flag is a group of its own, labelled like False."""
    counted = jobs.where("is_active").groupBy("remote").agg(F.count("*").alias("count"))
    label = F.when(F.col("remote"), "Remote").otherwise("On-site")
    return counted.select(label.alias("type"), "count")


def recent_jobs(jobs: DataFrame, n: int = 100) -> DataFrame:
    return newest(
        jobs.select("id", "title", "company", "location", "source", "posted_date",
                    "scraped_at", "is_active"), n)
