"""The scheduled jobs as Spark plans: ingest, refresh and alerts."""

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gleanery import schema, vocab
from gleanery.functions.text import blank_to_null
from gleanery.operators import clean, lifecycle, match, merge
from gleanery.session import work_dir
from gleanery.sources import registry, tables
from gleanery.sources.postings import UNREADABLE, accepted, quarantine
from gleanery.sources.snapshots import Table, retried

#: Pages of several lists may share a number, so the row's content decides last.
ORDER = ["page", "pos", "content"]


@dataclass(frozen=True)
class Ingested:
    jobs: DataFrame
    log: DataFrame
    quarantine: DataFrame


def stored_shape(rows: DataFrame, as_of: datetime) -> DataFrame:
    """Cleaned rows as they are stored: stamped, active, with an id. Keyed rows
    hash their key; the others also hash the place they came from, so equal
    postings without an id stay apart."""
    key = blank_to_null(F.col("external_id"))
    ident = F.when(key.isNotNull(), F.xxhash64("source", "external_id")).otherwise(
        F.xxhash64("source", "title", "url", "page", "pos", lifecycle.at(as_of)))
    return rows.withColumns({
        "id": ident, "scraped_at": lifecycle.at(as_of), "is_active": F.lit(True)})


def observed(raw: DataFrame, sources: list[str] | None) -> tuple[DataFrame, Observation]:
    """raw, whose rows are counted by source and by kind of reject while they are written."""
    seen, counts = Observation(), []
    for s in registry.chosen(sources):
        mine = F.col("run") == s.name
        counts.append(F.count_if(mine & F.col("reject").isNull()).alias(f"{s.name} jobs_found"))
        counts += [F.count_if(mine & (F.col("reject") == reason)).alias(f"{s.name} {name}")
                   for reason, name in UNREADABLE.items()]
    return raw.observe(seen, *counts), seen


def source_runs(spark: SparkSession, seen: dict[str, int], counts: DataFrame,
                sources: list[str] | None) -> DataFrame:
    """One row per registered source of a run, whatever tags its rows carry and also
    if it found nothing; a source has failed if all it was given was unreadable."""
    rows = []
    for s in registry.chosen(sources):
        found = seen[f"{s.name} jobs_found"]
        broken = ", ".join(f"{seen[f'{s.name} {name}']} {name}" for name in UNREADABLE.values() if seen[f"{s.name} {name}"])
        rows.append((s.name, found, broken if broken and not found else None))
    runs = spark.createDataFrame(rows, "source string, jobs_found bigint, error string")
    return runs.join(counts, F.col("source") == F.col("run"), "left").drop("run")


def ingest(spark: SparkSession, landed: registry.Landed, target: DataFrame, as_of: datetime, *,
           sources: list[str] | None = None, search: str | dict[str, str] | None = None,
           staging: str | None = None, newest_wins: bool = False) -> Ingested:
    """Extract, clean, merge and log one run.

    The extracted rows are written once to a staging folder all executors share:
    pages are parsed a single time for the merge, the counts and the quarantine,
    and a lost executor costs a re-read instead of a re-parse. They are counted
    while they are written.
    """
    staging = staging or work_dir(spark)
    raw, seen = observed(registry.extract(replace(landed, as_of=as_of), sources, search), sources)
    raw.write.mode("overwrite").parquet(f"{staging}/raw")
    raw = spark.read.parquet(f"{staging}/raw")
    good = accepted(raw)
    batch = stored_shape(clean.clean_jobs(good), as_of)
    batch = batch.withColumn("content", F.to_json(F.struct(*sorted(c for c in batch.columns if c != "content"))))
    batch.write.mode("overwrite").parquet(f"{staging}/clean")
    batch = spark.read.parquet(f"{staging}/clean")
    runs = source_runs(spark, seen.get, merge.merge_counts(target, batch, "actual", by="run"), sources)
    target = tables.evolve(target, schema.JOBS).select(*schema.JOBS.fieldNames())
    merged = merge.merge_upsert(target, batch, ORDER, newest_wins=newest_wins)
    return Ingested(merged, tables.run_log(runs, as_of, as_of), quarantine(raw))


def full_refresh(spark: SparkSession, landed: registry.Landed, target: DataFrame, as_of: datetime, *,
                 plan: list[tuple] | None = None, staging: str | None = None,
                 search: str | None = None) -> Ingested:
    """All sources and all landed pages in one union, then expiry; with a plan, its
    sources only, their first pages, and the search word and place it has for them."""
    names = None if plan is None else [row[0] for row in plan]
    if plan is not None:
        landed = landed.limited(registry.plan_table(spark, plan))
        search = search or {row[0]: row[1] for row in plan if row[1]}
    run = ingest(spark, landed, target, as_of, sources=names, staging=staging, search=search)
    expired = lifecycle.expire_all(run.jobs, as_of).drop("expired")
    return Ingested(expired, run.log, run.quarantine)


def refresh_stored(spark: SparkSession, landed: registry.Landed, jobs: Table, log: Table,
                   clock: Callable[[], datetime], **options) -> Ingested:
    """A full refresh of stored tables, logged from its start to its end.

    Every source is logged as running before anything is read. The new table takes
    the place of the old one in one step, and only if it was written to the end;
    then the runs are closed with the time of their end, as failed with the error if
    there was one. Rows of a run are appended, never changed: `tables.latest_runs`
    reads the log.
    """
    plan = options.get("plan")
    names = None if plan is None else [row[0] for row in plan]
    started = clock()
    runs = spark.createDataFrame([(s.name,) for s in registry.chosen(names)], "source string")
    retried(lambda: log.append(tables.open_log(runs, started)))
    try:
        run = full_refresh(spark, landed, jobs.read(), started, **options)
        retried(lambda: jobs.switch(run.jobs, partition="source", order="scraped_at"))
    except Exception as failure:
        nothing = [F.lit(None).cast("bigint").alias(c) for c in ("jobs_found", "jobs_new", "jobs_updated")]
        failed = runs.select("source", *nothing, F.lit(f"{type(failure).__name__}: {failure}").alias("error"))
        retried(lambda: log.append(tables.run_log(failed, started, clock())))
        raise
    closed = run.log.withColumn("finished_at", lifecycle.at(clock()))
    retried(lambda: log.append(closed))
    return Ingested(jobs.read(), closed, run.quarantine)


def quick_refresh(spark: SparkSession, landed: registry.Landed, target: DataFrame, as_of: datetime,
                  staging: str | None = None) -> Ingested:
    return full_refresh(spark, landed, target, as_of, plan=vocab.QUICK_PLAN, staging=staging)


def alerts(jobs: DataFrame, users: DataFrame, ids: DataFrame, as_of: datetime, *,
           site: str) -> tuple[DataFrame, DataFrame]:
    """(payloads, users with the time of the mail) for the requested users."""
    chosen = users.join(ids.select("id").distinct(), "id", "left_semi")
    return (match.alert_payload(jobs, chosen, site=site),
            match.mark_emailed(users, chosen.select("id"), as_of))
