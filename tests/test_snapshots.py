"""Versioned tables, streams into them and the life of the run log."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks import landed as made
from checks.fixtures import view
from gleanery import schema
from gleanery.operators import merge
from gleanery.plans import jobs as plans
from gleanery.session import work_dir
from gleanery.sources import tables
from gleanery.sources.registry import Landed
from gleanery.sources.snapshots import Conflict, Table, Version
from gleanery.streaming import incremental as inc

ORDER = ["ts", "event_id"]
STORED = ["id", "source", "external_id"] + [c for c in schema.LAST_WINS + schema.FIRST_WINS if c != "id"]
START = datetime(2024, 2, 1)


def rows_of(df, columns=STORED):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.fixture
def stored(spark, sf):
    """The events before the cut as a table whose rows have expired, and three later batches."""
    rows = view(spark, sf, "obs")
    keyed, loose = merge.split_keyed(rows.where("ts < TIMESTAMP '2024-01-10'"))
    first = (merge.collapse_batch(keyed, ORDER).select(*STORED).unionByName(loose.select(*STORED))
             .withColumn("is_active", F.lit(False)))
    table = Table(spark, work_dir(spark))
    table.switch(first, partition="source", order="scraped_at")
    late = rows.where("ts >= TIMESTAMP '2024-01-10'")
    return table, first, [late.where(F.col("event_id") % 3 == i) for i in range(3)], rows


def test_stream_into_a_stored_table(spark, stored):
    """Batches that come in any order of time, one of them twice, equal merges one after the other."""
    table, want, batches, rows = stored
    before = table.read()
    old = rows_of(before)
    path, checkpoint = work_dir(spark), work_dir(spark)
    for i, batch in enumerate(batches):
        batch.coalesce(1).write.mode("append").parquet(path)
        source = inc.file_stream(spark, path, rows.schema, files_per_trigger=1)
        inc.upsert_stored(source, table, checkpoint, ORDER).awaitTermination()
        want = merge.merge_upsert(want, batch, ORDER)
        assert table.version().batches == {"stream": i}
        assert rows_of(table.read()) == rows_of(want)
    number = table.version().number
    assert table.upsert(batches[2], ORDER, "stream", 2).number == number  # replayed
    assert rows_of(before) == old  # a reader opened before the batches
    table.compact("source")
    assert not table.version().states and rows_of(table.read()) == rows_of(want)
    assert table.version().batches == {"stream": 2}


def test_compaction_within_a_stream(spark, stored):
    table, want, batches, rows = stored
    path = work_dir(spark)
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(path)
    source = inc.file_stream(spark, path, rows.schema, files_per_trigger=1)
    query = inc.upsert_stored(source, table, work_dir(spark), ORDER, compact_after=2, partition="source")
    query.awaitTermination()
    assert query.lastProgress["batchId"] == 2 and len(table.version().states) == 1
    for batch in batches:
        want = merge.merge_upsert(want, batch, ORDER)
    assert rows_of(table.read()) == rows_of(want)


def test_batches_that_lack_columns(spark, stored):
    table, want, batches, _ = stored
    thin = batches[0].drop("tags", "requirements", "description")
    table.upsert(thin, ORDER, "s", 0)
    full = merge.merge_upsert(want, tables.evolve(thin, want.schema), ORDER)
    assert rows_of(table.read()) == rows_of(full)


def test_versions_are_taken_once(spark):
    table = Table(spark, work_dir(spark))
    table.switch(spark.range(3))
    last = table.version()
    table.append(spark.range(3, 5))
    with pytest.raises(Conflict):
        table.commit(Version(last.number + 1, last.schema, base=last.base))
    assert sorted(r.id for r in table.read().collect()) == [0, 1, 2, 3, 4]
    assert sorted(r.id for r in table.read(0).collect()) == [0, 1, 2]


def test_a_writer_that_dies_leaves_the_table(spark):
    table = Table(spark, work_dir(spark))
    table.switch(spark.range(3))
    broken = spark.range(10).select(F.raise_error(F.lit("lost")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="lost"):
        table.switch(broken)
    assert table.versions() == [0] and table.read().count() == 3
    # A manifest that was never finished is no version.
    fs = table._files()
    fs.create(table._path("versions/.000000000001-x"), False).close()
    assert table.version().number == 0


def test_a_table_may_be_replaced_by_itself(spark):
    table = Table(spark, work_dir(spark))
    table.switch(spark.range(5))
    table.switch(table.read().where("id > 1"))
    assert sorted(r.id for r in table.read().collect()) == [2, 3, 4]


def test_vacuum(spark):
    table = Table(spark, work_dir(spark))
    for n in range(4):
        table.switch(spark.range(n + 1))
    assert table.vacuum(keep=2) == []  # all files are young
    assert len(table.vacuum(keep=2, min_age=-60)) == 2
    assert table.versions() == [2, 3] and table.read(2).count() == 3 and table.read().count() == 4


def clock():
    times = iter(START + timedelta(minutes=i) for i in range(100))
    return lambda: next(times)


def test_life_of_a_run(spark, sf):
    jobs, log = Table(spark, work_dir(spark)), Table(spark, work_dir(spark))
    empty = spark.createDataFrame([], schema.JOBS)
    jobs.switch(empty)
    landed = Landed(payloads=made.payloads(spark, sf, ("adzuna", "remotive")))
    tick = clock()
    plans.refresh_stored(spark, landed, jobs, log, tick, plan=[("adzuna", None, None, 99), ("remotive", None, None, 99)])
    found = {r.source: r for r in tables.latest_runs(log.read()).collect()}
    assert {s: r.status for s, r in found.items()} == {"adzuna": "success", "remotive": "success"}
    assert all(r.started_at == START and r.finished_at == START + timedelta(minutes=1) for r in found.values())
    assert {r.status for r in log.read(0).collect()} == {"running"}
    assert jobs.read().count() == sum(r.jobs_found for r in found.values()) > 0

    # A run that fails leaves the jobs and closes its rows with the error.
    broken = Landed(payloads=landed.payloads.withColumn("body", F.raise_error(F.lit("store is gone")).cast("string")))
    count = jobs.read().count()
    with pytest.raises(Exception, match="store is gone"):
        plans.refresh_stored(spark, broken, jobs, log, tick, plan=[("adzuna", None, None, 99)])
    last = tables.latest_runs(log.read()).orderBy(F.desc("started_at")).first()
    assert last.status == "failed" and "store is gone" in last.error_message and last.finished_at > last.started_at
    assert jobs.read().count() == count
    totals = tables.run_totals(tables.latest_runs(log.read())).orderBy("started_at").collect()
    assert [(t.sources, t.success, t.failed, t.running) for t in totals] == [(2, 2, 0, 0), (1, 0, 1, 0)]


def test_unreadable_payloads_fail_a_source(spark):
    payloads = spark.createDataFrame(
        [("adzuna", 1, "{"), ("remotive", 1, "<html>"), ("remoteok", 1, "[]")],
        "source string, page int, body string")
    pages = spark.createDataFrame([("indeed", 1, None)], "source string, page int, html string")
    run = plans.ingest(spark, Landed(pages=pages, payloads=payloads), spark.createDataFrame([], schema.JOBS), START,
                       sources=["adzuna", "remotive", "remoteok", "indeed"])
    got = {r.source: (r.status, r.error_message) for r in run.log.collect()}
    assert got == {"adzuna": ("failed", "1 malformed bodies"), "remotive": ("failed", "1 malformed bodies"),
                   "remoteok": ("empty", None), "indeed": ("failed", "1 unparseable pages")}
