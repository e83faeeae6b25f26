"""Stored tables: reading, snapshots by source, logs and schema changes."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery import schema, vocab
from gleanery.functions.dates import iso_instant
from gleanery.operators.lifecycle import at

SCHEMAS = {"jobs": schema.JOBS, "scrape_logs": schema.SCRAPE_LOGS, "users": schema.USERS}


def read_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """A stored table with its fixed schema; filters and columns are pushed into
    the files. Missing columns of older files read as NULL."""
    if name not in SCHEMAS:
        raise ValueError(f"unknown table: {name}")
    return spark.read.format(fmt).schema(SCHEMAS[name]).options(**options).load(path)


def read_jdbc(spark: SparkSession, name: str, url: str, *, lower: int, upper: int,
              partitions: int, **options) -> DataFrame:
    """The same table in a database, read in id ranges in parallel."""
    return (spark.read.format("jdbc").option("url", url).option("dbtable", name)
            .option("partitionColumn", "id").option("lowerBound", lower)
            .option("upperBound", upper).option("numPartitions", partitions)
            .options(**options).load())


def evolve(df: DataFrame, target: T.StructType) -> DataFrame:
    """Add the columns of `target` a table does not have yet, as NULL."""
    missing = [f for f in target.fields if f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else df


def write_snapshot(jobs: DataFrame, path: str, max_records: int = 5_000_000) -> None:
    """Write a new snapshot directory, partitioned by source and ordered by the
    stamp inside files so that range filters skip row groups. The rebalance lets
    adaptive execution split large sources and join small ones by their size;
    never write to a path the plan reads."""
    (jobs.hint("rebalance", F.col("source"))
     .sortWithinPartitions("source", "scraped_at")
     .write.mode("errorifexists").option("maxRecordsPerFile", max_records)
     .partitionBy("source").parquet(path))


def write_touched(jobs: DataFrame, path: str, touched: DataFrame) -> None:
    """Rewrite only the source partitions a batch touched. `jobs` must come from
    another location than `path`."""
    kept = jobs.join(touched.select("source").distinct(), "source", "left_semi")
    (kept.hint("rebalance", F.col("source")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("source").parquet(path))


def run_log(runs: DataFrame, started_at: datetime, finished_at: datetime) -> DataFrame:
    """Log rows from run counts (source, jobs_found, jobs_new, jobs_updated,
    error): success, empty, or failed with the error cut to its stored width."""
    failed = F.col("error").isNotNull()
    status = (F.when(failed, "failed").when(F.coalesce("jobs_found", F.lit(0)) == 0, "empty")
              .otherwise("success"))

    def count(c: str):
        return F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c)

    return runs.select(
        F.xxhash64("source", at(started_at)).alias("id"), "source", status.alias("status"),
        count("jobs_found"), count("jobs_new"), count("jobs_updated"),
        F.left("error", F.lit(vocab.ERROR_WIDTH)).alias("error_message"),
        at(started_at).alias("started_at"), at(finished_at).alias("finished_at"))


def open_log(runs: DataFrame, started_at: datetime) -> DataFrame:
    """Log rows of runs that have begun."""
    return runs.select(
        F.xxhash64("source", at(started_at)).alias("id"), "source", F.lit("running").alias("status"),
        *[F.lit(0).alias(c) for c in ("jobs_found", "jobs_new", "jobs_updated")],
        F.lit(None).cast("string").alias("error_message"), at(started_at).alias("started_at"),
        F.lit(None).cast("timestamp_ntz").alias("finished_at"))


def latest_runs(log: DataFrame) -> DataFrame:
    """One row per run of an appended log: its closing row, or the row it was opened with.

    A run that was closed twice, as after a failure between writing and noting it,
    counts with its later end.
    """
    closed = F.struct(F.col("finished_at").isNotNull().alias("c"), F.col("finished_at").alias("t"))
    row = F.struct(*[c for c in log.columns if c not in ("source", "started_at")])
    return log.groupBy("source", "started_at").agg(F.max_by(row, closed).alias("r")).select(*[
        F.col(c) if c in ("source", "started_at") else F.col(f"r.{c}").alias(c) for c in log.columns])


def run_totals(log: DataFrame) -> DataFrame:
    """Totals per start time of the runs as of their last rows: sources by status, and jobs."""
    by_status = [F.count_if(F.col("status") == s).alias(s) for s in ("success", "empty", "failed", "running")]
    return log.groupBy("started_at").agg(
        F.count("*").alias("sources"), *by_status,
        *[F.sum(c).alias(c) for c in ("jobs_found", "jobs_new", "jobs_updated")],
        F.max("finished_at").alias("finished_at"))


def manual_postings(requests: DataFrame, as_of: datetime) -> DataFrame:
    """Manually entered postings: source manual, link equal to the apply link,
    unreadable deadline NULL, posted and stamped now."""
    given = {"title", "company", "location", "description", "job_type",
             "experience_level", "remote", "apply_url", "tags"}
    values = {
        "source": F.lit("manual"), "url": F.col("apply_url"),
        "application_deadline": iso_instant(F.col("application_deadline")),
        "posted_date": at(as_of), "scraped_at": at(as_of), "is_active": F.lit(True),
        **{c: F.col(c) for c in given},
        "id": F.xxhash64(F.lit("manual"), *sorted(requests.columns), at(as_of)),
    }
    return requests.select(*[
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.JOBS.fields])
