"""Whole jobs, table writes and streams."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from checks import fixtures, merge_queries
from checks.fixtures import JOBS_AS_OF, table, view, with_views
from checks.registry import query
from checks.source_queries import _ADZUNA, _CARD_SQL, _REMOTIVE, some_landed
from gleanery import schema, vocab
from gleanery.functions import text as tx
from gleanery.plans import jobs as plans
from gleanery.session import work_dir
from gleanery.sources import registry, tables
from gleanery.sources.registry import Landed
from gleanery.sources.postings import union_all
from gleanery.sources.snapshots import Table
from gleanery.streaming import incremental as inc

NOW = datetime(2024, 2, 1)
NOW_SQL = "TIMESTAMP '2024-02-01'"
NAMES = ["linkedin", "indeed", "adzuna", "remotive"]
_FOUND = "found AS (" + " UNION ALL ".join([_CARD_SQL["linkedin"], _CARD_SQL["indeed"], _ADZUNA, _REMOTIVE]) + ")"


def stored_jobs(spark, sf):
    """Jobs of the same sources, some with keys the run will find again."""
    k = F.col("p_partkey")
    key = F.when(k % 2 == 0, k.cast("string")).otherwise(F.concat(F.lit("gone-"), k))
    return table(spark, sf, "part").select(
        k.alias("id"), F.lit("Old title").alias("title"), F.lit("remotive").alias("source"),
        F.when(k % 6 != 0, key).alias("external_id"), F.lit("volunteer").alias("job_type"),
        F.lit(False).alias("is_active"), F.lit(datetime(2023, 1, 1)).cast("timestamp_ntz").alias("scraped_at"),
        F.lit(False).alias("remote"))


_STORED = """stored AS (SELECT p_partkey AS id, 'Old title' AS title, 'remotive' AS source,
  CASE WHEN p_partkey % 6 <> 0 THEN CASE WHEN p_partkey % 2 = 0 THEN '' ELSE 'gone-' END || p_partkey END AS external_id,
  'volunteer' AS job_type, FALSE AS is_active, TIMESTAMP '2023-01-01' AS scraped_at FROM part)"""
_MERGED = f"""WITH {_FOUND}, {_STORED}
SELECT coalesce(s.source, f.source) AS source, coalesce(s.external_id, f.external_id) AS external_id,
  coalesce(f.title, s.title) AS title, CASE WHEN s.id IS NOT NULL THEN s.job_type ELSE f.job_type END AS job_type,
  f.source IS NOT NULL AS is_active, CASE WHEN f.source IS NOT NULL THEN {NOW_SQL} ELSE s.scraped_at END AS scraped_at
FROM stored s FULL JOIN found f ON s.source = f.source AND s.external_id = f.external_id"""
_SHOWN = ["source", "external_id", "title", "job_type", "is_active", "scraped_at"]


def run_ingest(spark, sf):
    return plans.ingest(spark, some_landed(spark, sf), stored_jobs(spark, sf), NOW, sources=NAMES)


@query("ingest_job", _MERGED)
def ingest_job(spark, sf):
    return run_ingest(spark, sf).jobs.select(*_SHOWN)


@query("run_log", f"""WITH {_FOUND}, {_STORED}
SELECT f.source, 'success' AS status, CAST(count(*) AS INTEGER) AS jobs_found,
  CAST(count(*) FILTER (s.id IS NULL) AS INTEGER) AS jobs_new, CAST(count(s.id) AS INTEGER) AS jobs_updated,
  CAST(NULL AS VARCHAR) AS error_message, {NOW_SQL} AS started_at, {NOW_SQL} AS finished_at
FROM found f LEFT JOIN stored s ON s.source = f.source AND s.external_id = f.external_id GROUP BY f.source""")
def run_log(spark, sf):
    return run_ingest(spark, sf).log.drop("id")


@query("run_log_all_sources", f"""WITH {_FOUND}, {_STORED},
found_too AS (SELECT source, external_id FROM found UNION ALL SELECT source, external_id FROM ({_CARD_SQL['kenyajob']})),
logged AS (SELECT f.source, count(*) AS jobs_found, count(*) FILTER (s.id IS NULL) AS jobs_new, count(s.id) AS jobs_updated
  FROM found_too f LEFT JOIN stored s ON s.source = f.source AND s.external_id = f.external_id GROUP BY f.source)
SELECT r.source, CASE WHEN l.source IS NULL THEN 'empty' ELSE 'success' END AS status,
  CAST(coalesce(jobs_found, 0) AS INTEGER) AS jobs_found, CAST(coalesce(jobs_new, 0) AS INTEGER) AS jobs_new,
  CAST(coalesce(jobs_updated, 0) AS INTEGER) AS jobs_updated
FROM (SELECT unnest([{', '.join(f"'{n}'" for n in sorted(registry.REGISTRY))}]) AS source) r LEFT JOIN logged l USING (source)""")
def run_log_all_sources(spark, sf):
    """A run over all registered sources: every one is logged, also without a posting."""
    run = plans.ingest(spark, some_landed(spark, sf), stored_jobs(spark, sf), NOW)
    return run.log.select("source", "status", "jobs_found", "jobs_new", "jobs_updated")


@query("refresh_all_sources", f"""WITH {_FOUND}, {_STORED},
kept AS (SELECT source, external_id, title, application_deadline FROM found UNION ALL
  SELECT source, external_id, title, application_deadline FROM ({_CARD_SQL['kenyajob']}))
SELECT coalesce(f.source, s.source) AS source, coalesce(f.external_id, s.external_id) AS external_id,
  coalesce(f.title, s.title) AS title,
  f.source IS NOT NULL AND NOT coalesce(application_deadline < TIMESTAMP '2024-03-05', FALSE) AS is_active
FROM kept f FULL JOIN stored s ON s.source = f.source AND s.external_id = f.external_id""")
def refresh_all_sources(spark, sf):
    """Without a plan every source and every landed page counts."""
    run = plans.full_refresh(spark, some_landed(spark, sf), stored_jobs(spark, sf), datetime(2024, 3, 5))
    return run.jobs.select("source", "external_id", "title", "is_active")


@query("quarantine_pages", """SELECT CAST(page_id AS INTEGER) AS page,
  CASE WHEN page_id % 50 = 7 THEN 'missing' ELSE 'malformed' END AS kind, 'unparseable page' AS reject
FROM pages WHERE page_id % 50 IN (0, 7)""")
def quarantine_pages(spark, sf):
    """Real pages, of which some are missing or malformed: the rest of the run goes on."""
    k = F.col("page_id") % 50
    html = F.when(k == 0, F.concat(F.lit("<![foo[ b ]]>"), "html")).when(k != 7, F.col("html"))
    landed = Landed(pages=table(spark, sf, "pages").select(
        F.lit("indeed").alias("source"), F.col("page_id").cast("int").alias("page"), html.alias("html")))
    run = plans.ingest(spark, landed, stored_jobs(spark, sf), NOW, sources=["indeed"])
    return run.quarantine.where("reject = 'unparseable page'").select(
        "page", F.when(F.col("page") % 50 == 7, "missing").otherwise("malformed").alias("kind"), "reject")


@query("run_log_failures", """SELECT event_type AS source,
  CASE WHEN count(*) FILTER (event_id % 100 = 0) > 20 THEN 'failed' ELSE 'success' END AS status,
  CAST(count(*) AS INTEGER) AS jobs_found, CASE WHEN count(*) FILTER (event_id % 100 = 0) > 20
    THEN left(repeat('bad page ', 500), 2000) END AS error_message FROM events GROUP BY event_type""")
def run_log_failures(spark, sf):
    runs = table(spark, sf, "events").groupBy(F.col("event_type").alias("source")).agg(
        F.count("*").alias("jobs_found"),
        F.when(F.count_if(F.col("event_id") % 100 == 0) > 20, F.repeat(F.lit("bad page "), 500)).alias("error"),
        F.lit(None).cast("bigint").alias("jobs_new"), F.lit(None).cast("bigint").alias("jobs_updated"))
    return tables.run_log(runs, NOW, NOW).select("source", "status", "jobs_found", "error_message")




@query("quick_refresh", f"""WITH {_FOUND}, {_STORED},
kept AS (SELECT * FROM found WHERE source IN ('linkedin', 'indeed')
  AND CAST(coalesce(regexp_extract(external_id, '([0-9]+)', 1), '') AS BIGINT) < 40)
SELECT source, external_id, title, TRUE AS is_active FROM kept
UNION ALL SELECT source, external_id, title, FALSE FROM stored""")
def quick_refresh(spark, sf):
    run = plans.quick_refresh(spark, some_landed(spark, sf), stored_jobs(spark, sf), NOW)
    return run.jobs.select("source", "external_id", "title", "is_active")


@query("full_refresh", f"""WITH {_FOUND}, {_STORED},
pages AS (SELECT * FROM (VALUES ('linkedin', 3), ('indeed', 3), ('adzuna', 3), ('kenyajob', 5)) AS t(source, n)),
all_found AS (SELECT * FROM found UNION ALL {_CARD_SQL['kenyajob']}),
kept AS (SELECT f.* FROM all_found f JOIN pages p USING (source)
  WHERE CAST(regexp_extract(external_id, '([0-9]+)', 1) AS BIGINT) < 20 * n)
SELECT source, external_id, title, NOT coalesce(application_deadline < TIMESTAMP '2024-03-05', FALSE) AS is_active FROM kept
UNION ALL SELECT source, external_id, title, FALSE FROM stored""")
def full_refresh(spark, sf):
    run = plans.full_refresh(
        spark, some_landed(spark, sf), stored_jobs(spark, sf), datetime(2024, 3, 5), plan=vocab.DAILY_PLAN)
    return run.jobs.select("source", "external_id", "title", "is_active")


@query("run_log_open", """SELECT DISTINCT event_type AS source, 'running' AS status, 0 AS jobs_found,
  TIMESTAMP '2024-02-01' AS started_at, CAST(NULL AS TIMESTAMP) AS finished_at FROM events""")
def run_log_open(spark, sf):
    runs = table(spark, sf, "events").select(F.col("event_type").alias("source")).distinct()
    return tables.open_log(runs, NOW).select("source", "status", "jobs_found", "started_at", "finished_at")


@query("touched_partitions", f"""{with_views('jobs')} SELECT id, source, CASE WHEN source IN ('indeed', 'kemri')
  THEN 'new' ELSE 'old' END AS title FROM jobs""")
def touched_partitions(spark, sf):
    """A snapshot of which a batch rewrites two source partitions only."""
    path = work_dir(spark)
    rows = view(spark, sf, "jobs").select("id", "source")
    tables.write_snapshot(rows.withColumns({"title": F.lit("old"), "scraped_at": F.lit(None).cast("timestamp_ntz")}), path)
    touched = rows.where("source IN ('indeed', 'kemri')").select("source")
    fresh = rows.withColumns({"title": F.lit("new"), "scraped_at": F.lit(None).cast("timestamp_ntz")})
    tables.write_touched(fresh, path, touched)
    return tables.read_table(spark, "jobs", path).select("id", "source", "title")


# --- tables --------------------------------------------------------------


@query("manual_append", f"""{with_views('jobs')} SELECT title, 'manual' AS source, apply_url AS url, apply_url,
  CASE WHEN id % 3 = 0 THEN CAST(posted_date AS TIMESTAMP) END AS application_deadline,
  TIMESTAMP '2001-08-01' AS posted_date, TIMESTAMP '2001-08-01' AS scraped_at, TRUE AS is_active FROM jobs""")
def manual_append(spark, sf):
    deadline = F.when(F.col("id") % 3 == 0, F.date_format("posted_date", "yyyy-MM-dd'T'HH:mm:ss")
                      ).when(F.col("id") % 3 == 1, "next week")
    asked = view(spark, sf, "jobs").select(
        "title", "company", "location", "description", "job_type", "experience_level", "remote",
        "apply_url", "tags", deadline.alias("application_deadline"))
    return tables.manual_postings(asked, JOBS_AS_OF).select(
        "title", "source", "url", "apply_url", "application_deadline", "posted_date", "scraped_at", "is_active")


@query("schema_evolve", f"""{with_views('jobs')} SELECT id, title, NULL::VARCHAR AS requirements,
  NULL::TIMESTAMP AS application_deadline FROM jobs WHERE id % 2 = 0
UNION ALL SELECT id, title, requirements, application_deadline FROM jobs WHERE id % 2 = 1""")
def schema_evolve(spark, sf):
    rows = view(spark, sf, "jobs")
    old = rows.where("id % 2 = 0").select("id", "title")
    new = rows.where("id % 2 = 1").select("id", "title", "requirements", "application_deadline")
    return tables.evolve(union_all([old, new]), schema.JOBS).select(
        "id", "title", "requirements", "application_deadline")


@query("snapshot_roundtrip", f"""{with_views('jobs')} SELECT id, title, source, scraped_at FROM jobs
WHERE source = 'indeed'""")
def snapshot_roundtrip(spark, sf):
    path = work_dir(spark)
    rows = tables.evolve(view(spark, sf, "jobs"), schema.JOBS).select(*schema.JOBS.fieldNames())
    tables.write_snapshot(rows, path)
    stored = tables.read_table(spark, "jobs", path)
    return stored.where("source = 'indeed'").select("id", "title", "source", "scraped_at")


@query("snapshot_roundtrip_all", f"""{with_views('jobs')} SELECT id, title, source, scraped_at FROM jobs""")
def snapshot_roundtrip_all(spark, sf):
    path = work_dir(spark)
    rows = tables.evolve(view(spark, sf, "jobs"), schema.JOBS).select(*schema.JOBS.fieldNames())
    tables.write_snapshot(rows, path)
    return tables.read_table(spark, "jobs", path).select("id", "title", "source", "scraped_at")


@query("clean_documents", """SELECT doc_id, nullif(trim(regexp_replace(regexp_replace(replace(replace(replace(text,
  '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '<[^>]+>', ' ', 'g'),
  '[\\s\\x{0b}\\x{a0}\\x{85}\\x{2028}\\x{2029}]+', ' ', 'g')), '') AS text FROM documents""")
def clean_documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.clean_text(F.col("text")).alias("text"))


# --- streams -------------------------------------------------------------

O = with_views("obs")
STORED = ["source", "external_id", "id", "title", "salary_min", "salary_max", "salary_currency", "job_type",
          "remote", "url", "location", "description", "posted_date", "scraped_at"]
_L = ("title", "salary_min", "salary_max", "url", "location", "description", "scraped_at")
_POS = "struct_pack(ts := ts, e := event_id)"


def obs_stream(spark, sf):
    """The observation view over a stream of the events file."""
    fields = table(spark, sf, "events").schema
    events = inc.file_stream(spark, sf, fields, "events.parquet")
    events.createOrReplaceTempView("gleanery_event_stream")
    return spark.sql(fixtures.spark_sql("obs").replace("FROM events", "FROM gleanery_event_stream"))


@query("stream_upsert", f"""{O} SELECT {', '.join(
    'source' if c == 'source' else 'external_id' if c == 'external_id'
    else f"{'arg_max' if c in _L else 'arg_min'}(struct_pack(v := {c}), {_POS}).v AS {c}" for c in STORED)}
FROM obs WHERE external_id IS NOT NULL GROUP BY source, external_id
UNION ALL SELECT {', '.join(STORED)} FROM obs WHERE external_id IS NULL""")
def stream_upsert(spark, sf):
    out = work_dir(spark)
    q = inc.upsert_stream(obs_stream(spark, sf), out, f"{out}/checkpoint", ["ts", "event_id"])
    q.awaitTermination()
    return inc.current_rows(spark, out, STORED)


@query("stream_upsert_stored", f"{O} {merge_queries._MERGED}")
def stream_upsert_stored(spark, sf):
    """Three micro-batches, one of them replayed, merged into a stored table."""
    target, late = merge_queries.halves(spark, sf)
    stored = Table(spark, work_dir(spark))
    stored.switch(target, partition="source", order="scraped_at")
    landed, checkpoint = work_dir(spark), work_dir(spark)
    days = [f"ts < {merge_queries.CUT} + INTERVAL 4 DAYS",
            f"ts >= {merge_queries.CUT} + INTERVAL 4 DAYS AND ts < {merge_queries.CUT} + INTERVAL 8 DAYS",
            f"ts >= {merge_queries.CUT} + INTERVAL 8 DAYS"]
    for number, when in enumerate(days):
        batch = late.where(when)
        batch.coalesce(1).write.mode("append").parquet(landed)
        stream = inc.file_stream(spark, landed, late.schema)
        inc.upsert_stored(stream, stored, checkpoint, merge_queries.ORDER).awaitTermination()
        stored.upsert(batch, merge_queries.ORDER, "stream", number)
    return stored.read().select(*merge_queries.STORED)


@query("snapshot_switch", f"""{with_views('jobs')} SELECT 'before' AS reader, id, source, title FROM jobs
UNION ALL SELECT 'after', id, source, upper(title) FROM jobs WHERE id % 2 = 0
UNION ALL SELECT 'appended', id, source, title FROM jobs WHERE id % 3 = 0
UNION ALL SELECT 'appended', id, source, upper(title) FROM jobs WHERE id % 2 = 0""")
def snapshot_switch(spark, sf):
    """Readers of three versions of a table, all read after the last of them was made."""
    rows = view(spark, sf, "jobs").select("id", "source", "title")
    stored = Table(spark, work_dir(spark))
    stored.switch(rows, partition="source")
    before = stored.read()
    stored.switch(before.where("id % 2 = 0").withColumn("title", F.upper("title")), partition="source")
    after = stored.read()
    stored.append(rows.where("id % 3 = 0"))
    readers = {"before": before, "after": after, "appended": stored.read()}
    return union_all([df.select(F.lit(name).alias("reader"), "id", "source", "title") for name, df in readers.items()])


@query("run_log_closed", """SELECT event_type AS source, TIMESTAMP '2024-02-01' AS started_at,
  CASE WHEN count(*) % 2 = 0 THEN 'success' ELSE 'running' END AS status,
  CAST(CASE WHEN count(*) % 2 = 0 THEN count(*) ELSE 0 END AS INTEGER) AS jobs_found,
  CASE WHEN count(*) % 2 = 0 THEN TIMESTAMP '2024-02-01 00:07:00' END AS finished_at FROM events GROUP BY event_type""")
def run_log_closed(spark, sf):
    """An appended log: every run is opened, some are closed, one of them twice."""
    runs = table(spark, sf, "events").groupBy(F.col("event_type").alias("source")).agg(
        F.count("*").alias("jobs_found"), *[F.lit(None).cast("bigint").alias(c) for c in ("jobs_new", "jobs_updated")],
        F.lit(None).cast("string").alias("error"))
    log, ended = Table(spark, work_dir(spark)), runs.where("jobs_found % 2 = 0")
    log.append(tables.open_log(runs, NOW))
    for minutes in (3, 7):
        log.append(tables.run_log(ended, NOW, NOW + timedelta(minutes=minutes)))
    return tables.latest_runs(log.read()).select("source", "started_at", "status", "jobs_found", "finished_at")


@query("run_log_failed_inputs", f"""SELECT 'adzuna' AS source, 'failed' AS status, 0 AS jobs_found,
  count(DISTINCT floor(p_partkey / 20)) || ' malformed bodies' AS error_message FROM part
UNION ALL SELECT 'remotive', 'success', CAST(count(*) AS INTEGER), NULL FROM ({_REMOTIVE})
UNION ALL SELECT 'indeed', 'failed', 0, count(*) || ' unparseable pages' FROM pages""")
def run_log_failed_inputs(spark, sf):
    """Sources all of whose bodies or pages are unreadable have failed; one without bad input has not."""
    found = some_landed(spark, sf)
    bodies = found.payloads.withColumn("body", F.when(F.col("source") == "adzuna", F.left("body", F.lit(9))).otherwise(F.col("body")))
    pages = table(spark, sf, "pages").select(
        F.lit("indeed").alias("source"), F.col("page_id").cast("int").alias("page"), F.lit(None).cast("string").alias("html"))
    run = plans.ingest(spark, Landed(pages=pages, payloads=bodies), stored_jobs(spark, sf), NOW,
                       sources=["adzuna", "remotive", "indeed"])
    return run.log.select("source", "status", "jobs_found", "error_message")


@query("run_log_totals", """SELECT TIMESTAMP '2024-02-01' AS started_at, count(*) AS sources,
  count(*) FILTER (n % 2 = 0) AS success, count(*) FILTER (n % 2 = 1) AS failed,
  CAST(sum(CASE WHEN n % 2 = 0 THEN n ELSE 0 END) AS BIGINT) AS jobs_found
FROM (SELECT event_type, count(*) AS n FROM events GROUP BY event_type)""")
def run_log_totals(spark, sf):
    """Totals of a run over all sources."""
    n = F.count("*")
    runs = table(spark, sf, "events").groupBy(F.col("event_type").alias("source")).agg(
        F.when(n % 2 == 0, n).alias("jobs_found"), F.when(n % 2 == 1, "lost").alias("error"),
        *[F.lit(None).cast("bigint").alias(c) for c in ("jobs_new", "jobs_updated")])
    return tables.run_totals(tables.run_log(runs, NOW, NOW)).select(
        "started_at", "sources", "success", "failed", "jobs_found")


@query("stream_daily", f"""{O} SELECT date_trunc('day', ts) AS time, source, count(*) AS count FROM obs GROUP BY 1, 2""")
def stream_daily(spark, sf):
    out = work_dir(spark)
    rows = inc.daily_counts(inc.zoned(obs_stream(spark, sf), "ts"))
    q = inc.write_complete(rows, out, f"{out}-checkpoint")
    q.awaitTermination()
    return inc.latest_complete(spark, out, q).withColumn("time", F.col("time").cast("timestamp_ntz"))


@query("stream_dedup", f"{O} SELECT DISTINCT source, external_id FROM obs")
def stream_dedup(spark, sf):
    out = work_dir(spark)
    rows = inc.first_seen(inc.zoned(obs_stream(spark, sf), "ts"), ["source", "external_id"])
    q = inc.write_append(rows.select("source", "external_id"), out, f"{out}-checkpoint")
    q.awaitTermination()
    return spark.read.parquet(out)
