"""Scans, browsing, lifecycle, cleaning and monitoring over the job view."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.fixtures import EVENTS_AS_OF, JOBS_AS_OF, table, view, with_views
from checks.registry import query
from gleanery import vocab
from gleanery.functions import text as tx
from gleanery.operators import catalog, clean, lifecycle, monitor
from gleanery.session import work_dir

J = with_views("jobs")
L = with_views("scrape_logs")
U = with_views("users")
AS_OF = "TIMESTAMP '2001-08-01 00:00:00'"
LOG_AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"


def jobs(spark, sf):
    return view(spark, sf, "jobs")


def logs(spark, sf):
    return view(spark, sf, "scrape_logs")


def users(spark, sf):
    return view(spark, sf, "users")


def _sql_text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --- scans ---------------------------------------------------------------

_JOB_COLUMNS = """id, external_id, title, company, location, description, job_type,
  experience_level, salary_min, salary_max, salary_currency, remote, source, url,
  posted_date, scraped_at, application_deadline, is_active"""


@query("scan_jobs", f"{J} SELECT {_JOB_COLUMNS} FROM jobs")
def scan_jobs(spark, sf):
    return jobs(spark, sf).select(*[c.strip() for c in _JOB_COLUMNS.split(",")])


@query("scan_logs", f"{L} SELECT * FROM scrape_logs")
def scan_logs(spark, sf):
    return logs(spark, sf)


@query("scan_users", f"{U} SELECT id, email, name, source, job_interests, subscribed_at FROM users")
def scan_users(spark, sf):
    return users(spark, sf).drop("last_emailed_at")


# --- cleaning ------------------------------------------------------------

_UNESCAPED = ("replace(replace(replace(replace({c}, '&lt;', '<'), '&gt;', '>'), "
              "'&quot;', '\"'), '&amp;', '&')")


def clean_sql(c: str) -> str:
    text = _UNESCAPED.format(c=c)
    return (f"nullif(trim(regexp_replace(regexp_replace({text}, '<[^>]+>', ' ', 'g'), "
            f"'[\\s\\x{{0b}}\\x{{a0}}]+', ' ', 'g')), '')")


def contains_any_sql(c: str, words) -> str:
    return "(" + " OR ".join(f"contains({c}, {_sql_text(w)})" for w in words) + ")"


def job_type_sql(c: str) -> str:
    arms = " ".join(f"WHEN contains(lower({c}), {_sql_text(w)}) THEN {_sql_text(v)}"
                    for w, v in vocab.JOB_TYPES)
    return f"CASE WHEN coalesce({c}, '') = '' THEN NULL {arms} ELSE trim(lower({c})) END"


def level_sql(c: str) -> str:
    arms = " ".join(f"WHEN {contains_any_sql(f'lower({c})', ws)} THEN {_sql_text(v)}"
                    for v, ws in vocab.EXPERIENCE_LEVELS)
    return f"CASE WHEN coalesce({c}, '') = '' THEN NULL {arms} ELSE trim(lower({c})) END"


def remote_sql(title, location, description, job_type, flag="remote") -> str:
    hay = "lower(concat_ws(' ', " + ", ".join(
        f"nullif({c}, '')" for c in (title, location, description, job_type)) + "))"
    return f"(coalesce({flag}, FALSE) OR {contains_any_sql(hay, vocab.REMOTE_PHRASES)})"


def currency_sql(location: str) -> str:
    place = f"lower(coalesce({location}, ''))"
    return (f"CASE WHEN (coalesce(salary_min, 0) <> 0 OR coalesce(salary_max, 0) <> 0) "
            f"AND coalesce(salary_currency, '') = '' THEN "
            f"CASE WHEN {contains_any_sql(place, vocab.KES_PLACES)} THEN 'KES' ELSE 'USD' END "
            f"ELSE salary_currency END")


def tags_sql(c: str, words=None) -> str:
    hits = ", ".join(f"CASE WHEN contains(lower({c}), {_sql_text(k)}) THEN {_sql_text(k)} END"
                     for k in words or vocab.TAG_KEYWORDS)
    return f"nullif(concat_ws(',', {hits}), '')"


CLEAN_SQL = f"""cleaned_text AS (
  SELECT * REPLACE ({clean_sql('title')} AS title, {clean_sql('company')} AS company,
    {clean_sql('location')} AS location, {clean_sql('description')} AS description,
    {job_type_sql('job_type')} AS job_type, {level_sql('experience_level')} AS experience_level)
  FROM jobs),
cleaned AS (
  SELECT * REPLACE ({remote_sql('title', 'location', 'description', 'job_type')} AS remote,
    {currency_sql('location')} AS salary_currency,
    CASE WHEN coalesce(tags, '') = '' AND description IS NOT NULL
         THEN {tags_sql('description')} ELSE tags END AS tags,
    trim(url) AS url, trim(apply_url) AS apply_url)
  FROM cleaned_text WHERE title IS NOT NULL)"""


@query("clean_text", f"""
SELECT page_id, {clean_sql('html')} AS text FROM pages""".replace(
    "replace(replace(replace(replace(html,", "replace(replace(replace(replace("
    "replace(replace(replace(html, '&copy;', chr(169)), '&middot;', chr(183)), '&nbsp;', chr(160)),"))
def clean_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.clean_text(F.col("html")).alias("text"))


@query("norm_job_type", f"{J} SELECT id, {job_type_sql('job_type')} AS job_type FROM jobs")
def norm_job_type(spark, sf):
    return jobs(spark, sf).select("id", tx.normalize_job_type(F.col("job_type")).alias("job_type"))


@query("norm_level", f"{J} SELECT id, {level_sql('experience_level')} AS level FROM jobs")
def norm_level(spark, sf):
    return jobs(spark, sf).select(
        "id", tx.normalize_experience_level(F.col("experience_level")).alias("level"))


@query("detect_remote", f"""{J} SELECT id,
  {remote_sql('title', 'location', 'description', 'job_type')} AS remote FROM jobs""")
def detect_remote(spark, sf):
    hay = tx.remote_haystack(*[F.col(c) for c in ("title", "location", "description", "job_type")])
    return (jobs(spark, sf).withColumn("hay", hay)
            .select("id", tx.detect_remote(F.col("remote"), F.col("hay")).alias("remote")))


@query("default_currency", f"{J} SELECT id, {currency_sql('location')} AS salary_currency FROM jobs")
def default_currency(spark, sf):
    return jobs(spark, sf).select("id", tx.default_currency(
        F.col("salary_currency"), F.col("salary_min"), F.col("salary_max"),
        F.col("location")).alias("salary_currency"))


@query("extract_tags", f"SELECT doc_id, {tags_sql('text')} AS tags FROM documents")
def extract_tags(spark, sf):
    lowered = table(spark, sf, "documents").select("doc_id", F.lower("text").alias("low"))
    return lowered.select("doc_id", tx.extract_tags(F.col("low")).alias("tags"))


@query("drop_untitled", f"""{J}, blanked AS (
  SELECT id, CASE WHEN id % 5 = 0 THEN '<p> &lt;br&gt; </p>' ELSE title END AS title FROM jobs)
SELECT id, {clean_sql('title')} AS title FROM blanked WHERE {clean_sql('title')} IS NOT NULL""")
def drop_untitled(spark, sf):
    blank = F.when(F.col("id") % 5 == 0, "<p> &lt;br&gt; </p>").otherwise(F.col("title"))
    return clean.drop_untitled(jobs(spark, sf).select("id", blank.alias("title")))


@query("clean_counts", f"""{J}, blanked AS (
  SELECT CASE WHEN id % 5 = 0 THEN '<p> &lt;br&gt; </p>' ELSE title END AS title FROM jobs)
SELECT count(*) AS raw, count({clean_sql('title')}) AS cleaned FROM blanked""")
def clean_counts(spark, sf):
    blank = F.when(F.col("id") % 5 == 0, "<p> &lt;br&gt; </p>").otherwise(F.col("title"))
    return clean.clean_counts(jobs(spark, sf).select(blank.alias("title")))


@query("trim_url", f"{J} SELECT id, trim(url) AS url, trim(apply_url) AS apply_url FROM jobs")
def trim_url(spark, sf):
    return jobs(spark, sf).select("id", tx.strip(F.col("url")).alias("url"),
                                  tx.strip(F.col("apply_url")).alias("apply_url"))


@query("clean_chain", f"{J}, {CLEAN_SQL} SELECT * FROM cleaned")
def clean_chain(spark, sf):
    return clean.clean_jobs(jobs(spark, sf))


# --- lifecycle -----------------------------------------------------------

_DEADLINE = f"coalesce(is_active AND application_deadline < {AS_OF}, FALSE)"
_STALE = f"coalesce(is_active AND scraped_at < {AS_OF} - INTERVAL 30 DAY, FALSE)"


@query("expire_deadline", f"{J} SELECT id, is_active AND NOT {_DEADLINE} AS is_active FROM jobs")
def expire_deadline(spark, sf):
    return lifecycle.expire_deadline(jobs(spark, sf), JOBS_AS_OF).select("id", "is_active")


@query("expire_stale", f"{J} SELECT id, is_active AND NOT {_STALE} AS is_active FROM jobs")
def expire_stale(spark, sf):
    return lifecycle.expire_stale(jobs(spark, sf), JOBS_AS_OF).select("id", "is_active")


@query("expire_all", f"""{J} SELECT id, is_active AND NOT {_DEADLINE} AND NOT {_STALE} AS is_active,
  CASE WHEN {_DEADLINE} THEN 'deadline' WHEN {_STALE} THEN 'stale' END AS expired FROM jobs""")
def expire_all(spark, sf):
    return lifecycle.expire_all(jobs(spark, sf), JOBS_AS_OF).select("id", "is_active", "expired")


@query("expire_counts", f"""{J} SELECT count(*) FILTER ({_DEADLINE}) AS deadline_expired,
  count(*) FILTER ({_STALE} AND NOT {_DEADLINE}) AS stale FROM jobs""")
def expire_counts(spark, sf):
    return lifecycle.expiry_counts(jobs(spark, sf), JOBS_AS_OF)


_PATTERNS = " OR ".join(f"title ILIKE {_sql_text(p)}" for p in vocab.JUNK_TITLE_PATTERNS)
_JUNK = {
    "description": "(description IS NULL OR description = '' OR length(description) <= 30)",
    "pattern": f"({_PATTERNS})",
    "short_title": "(length(title) <= 5)",
    "generic": "(title ILIKE '% Jobs' AND (company IS NULL OR company = ''))",
    "source": "(source ILIKE 'google_%')",
}


@query("junk_flags", f"""{J}, flagged AS (SELECT id, concat_ws(',', {', '.join(
    f"CASE WHEN {c} THEN '{n}' END" for n, c in _JUNK.items())}) AS junk_reasons
  FROM jobs WHERE is_active) SELECT * FROM flagged WHERE junk_reasons <> ''""")
def junk_flags(spark, sf):
    return lifecycle.junk_flags(jobs(spark, sf)).select("id", "junk_reasons")


@query("junk_cleanup", f"""{J} SELECT id, is_active AND NOT ({' OR '.join(_JUNK.values())})
  AS is_active FROM jobs""")
def junk_cleanup(spark, sf):
    return lifecycle.junk_cleanup(jobs(spark, sf)).select("id", "is_active")


@query("junk_count", f"""{J} SELECT count(*) AS deactivated FROM jobs
  WHERE is_active AND ({' OR '.join(_JUNK.values())})""")
def junk_count(spark, sf):
    return lifecycle.junk_count(jobs(spark, sf))


# --- browse --------------------------------------------------------------

VISIBLE = f"""visible AS (SELECT * FROM jobs WHERE is_active
  AND (application_deadline IS NULL OR application_deadline >= {AS_OF})
  AND description IS NOT NULL AND description <> '' AND length(description) > 30
  AND length(title) > 5 AND NOT ({_PATTERNS}) AND NOT (source ILIKE 'google_%'))"""


def shown(spark, sf):
    return catalog.visible(jobs(spark, sf), JOBS_AS_OF)


@query("visible_jobs", f"{J}, {VISIBLE} SELECT id, title, source FROM visible")
def visible_jobs(spark, sf):
    return shown(spark, sf).select("id", "title", "source")


@query("search_jobs", f"""{J}, {VISIBLE} SELECT id, title, company FROM visible
  WHERE title ILIKE '%d_ta%' OR company ILIKE '%d_ta%' OR description ILIKE '%d_ta%' OR tags ILIKE '%d_ta%'""")
def search_jobs(spark, sf):
    return catalog.search(shown(spark, sf), "d_ta").select("id", "title", "company")


@query("search_escaped", f"""{J}, {VISIBLE} SELECT id FROM visible
  WHERE contains(lower(concat_ws(chr(1), title, company, description, tags)), 'home with')
     OR contains(lower(concat_ws(chr(1), title, company, description, tags)), '100%')""")
def search_escaped(spark, sf):
    base = shown(spark, sf)
    both = [catalog.search(base, q, escape=True).select("id") for q in ("home with", "100%")]
    return both[0].union(both[1]).distinct()


@query("filter_jobs", f"""{J}, {VISIBLE} SELECT id, source, location, job_type, remote FROM visible
  WHERE source = 'indeed' AND location ILIKE '%kenya%' AND job_type = 'Full Time' AND remote = FALSE""")
def filter_jobs(spark, sf):
    return catalog.narrow(shown(spark, sf), source="indeed", location="kenya",
                          job_type="Full Time", remote=False).select(
        "id", "source", "location", "job_type", "remote")


_ORDERS = [(c, o) for c in catalog.SORT_COLUMNS for o in ("asc", "desc")]


def _order_sql(c: str, o: str) -> str:
    return f"{c} {'DESC NULLS FIRST' if o == 'desc' else 'ASC NULLS LAST'}, id"


@query("sort_jobs", f"{J}, {VISIBLE} " + " UNION ALL ".join(
    f"""SELECT '{c} {o}' AS ordering, id, rank FROM (
      SELECT id, row_number() OVER (ORDER BY {_order_sql(c, o)}) AS rank FROM visible) WHERE rank <= 100"""
    for c, o in _ORDERS))
def sort_jobs(spark, sf):
    base, parts = shown(spark, sf), []
    for c, o in _ORDERS:
        top = catalog.page(base, 1, 100, c, o)
        ids = top.agg(F.collect_list(F.struct(c, "id")).alias("rows"))
        ranked = ids.select(F.posexplode(F.col("rows.id")).alias("pos", "id"))
        parts.append(ranked.select(F.lit(f"{c} {o}").alias("ordering"), "id",
                                   (F.col("pos") + 1).cast("bigint").alias("rank")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("sort_jobs_all", f"{J}, {VISIBLE} " + " UNION ALL ".join(
    f"SELECT '{c} {o}' AS ordering, id, row_number() OVER (ORDER BY {_order_sql(c, o)}) AS rank FROM visible"
    for c, o in _ORDERS))
def sort_jobs_all(spark, sf):
    base, path = shown(spark, sf), work_dir(spark)
    for c, o in _ORDERS:
        # The place grows with the order: partitions first, then rows in them.
        catalog.sort_jobs(base, c, o).select(
            F.lit(f"{c} {o}").alias("ordering"), "id", F.monotonically_increasing_id().alias("place")
        ).write.mode("append").parquet(path)
    placed = spark.read.parquet(path).withColumn("part", F.shiftright("place", 33))
    parts = placed.groupBy("ordering", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("ordering").orderBy("part")
    starts = parts.withColumn("start", F.sum("n").over(before) - F.col("n"))
    inside = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(starts, ["ordering", "part"]).select(
        "ordering", "id", (F.col("start") + inside + 1).alias("rank"))


@query("browse_page", f"""{J}, {VISIBLE} SELECT id, title, company, location, source, scraped_at
  FROM visible ORDER BY scraped_at DESC NULLS FIRST, id LIMIT 20 OFFSET 40""")
def browse_page(spark, sf):
    cols = shown(spark, sf).select("id", "title", "company", "location", "source", "scraped_at")
    return catalog.page(cols, 3, 20)


@query("browse_deep_page", f"""{J}, {VISIBLE}, ranked AS (SELECT id, title, scraped_at, 
  row_number() OVER (ORDER BY scraped_at DESC NULLS FIRST, id) AS rank, count(*) OVER () AS n FROM visible)
SELECT id, title, scraped_at, rank FROM ranked WHERE rank > ((n - 1) // 20) * 20 OR (rank > (n // 40) * 20 AND rank <= (n // 40) * 20 + 20)""")
def browse_deep_page(spark, sf):
    """The last page and one from the middle, read by their place in a written order."""
    ranked = catalog.Ranked(shown(spark, sf).select("id", "title", "scraped_at"))
    last, middle = (ranked.total - 1) // 20 + 1, ranked.total // 40 + 1
    return ranked.page(last).unionByName(ranked.page(middle)).distinct()


@query("browse_total", f"""{J}, {VISIBLE} SELECT count(*) AS total,
  greatest(CAST(ceil(count(*) / 20.0) AS BIGINT), 1) AS pages FROM visible""")
def browse_total(spark, sf):
    return catalog.page_totals(shown(spark, sf), 20)


@query("browse_keyset", f"""{J}, {VISIBLE} SELECT id, title, scraped_at FROM visible
  WHERE scraped_at < TIMESTAMP '2000-06-01' OR (scraped_at = TIMESTAMP '2000-06-01' AND id > 500)
  ORDER BY scraped_at DESC NULLS FIRST, id LIMIT 20""")
def browse_keyset(spark, sf):
    cols = shown(spark, sf).select("id", "title", "scraped_at")
    return catalog.page_after(cols, "2000-06-01 00:00:00", 500, 20)


@query("job_by_id", f"{J} SELECT {_JOB_COLUMNS} FROM jobs WHERE id = 77")
def job_by_id(spark, sf):
    return catalog.by_id(scan_jobs(spark, sf), 77)


@query("newest_jobs", f"""{J} SELECT id, title, scraped_at FROM jobs WHERE is_active
  ORDER BY scraped_at DESC NULLS FIRST, id LIMIT 5""")
def newest_jobs(spark, sf):
    return catalog.newest(jobs(spark, sf).where("is_active").select("id", "title", "scraped_at"), 5)


@query("newest_logs", f"""{L} SELECT * FROM scrape_logs
  ORDER BY started_at DESC NULLS FIRST, id LIMIT 200""")
def newest_logs(spark, sf):
    return catalog.newest(logs(spark, sf), 200, "started_at")


def _iso_sql(c: str) -> str:
    return (f"strftime({c}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond({c}) % 1000000 = 0 "
            f"THEN '' ELSE '.' || lpad(CAST(microsecond({c}) % 1000000 AS VARCHAR), 6, '0') END")


@query("log_projection", f"""{L} SELECT id, source, status, jobs_found, jobs_new, jobs_updated,
  error_message, {_iso_sql('started_at')} AS started_at, {_iso_sql('finished_at')} AS finished_at
  FROM scrape_logs""")
def log_projection(spark, sf):
    return catalog.log_projection(logs(spark, sf))


@query("count_users", f"{U} SELECT count(*) AS total FROM users WHERE source = 'cv_upload'")
def count_users(spark, sf):
    return catalog.count_users(users(spark, sf), "cv_upload")


@query("list_users", f"""{U} SELECT id, email, name, source, job_interests, subscribed_at FROM users
  WHERE source = 'cv_upload'""")
def list_users(spark, sf):
    return catalog.list_users(users(spark, sf), "cv_upload").drop("last_emailed_at")


@query("users_by_ids", f"""{U} SELECT id, email FROM users
  WHERE id IN (SELECT user_id FROM events WHERE event_type = 'signup')""")
def users_by_ids(spark, sf):
    ids = table(spark, sf, "events").where("event_type = 'signup'").selectExpr("user_id AS id")
    return catalog.rows_by_ids(users(spark, sf).select("id", "email"), ids)


# --- counts and monitoring -------------------------------------------------


@query("job_counts", f"""{J} SELECT count(*) AS total_jobs,
  count(*) FILTER (is_active) AS active_jobs FROM jobs""")
def job_counts(spark, sf):
    return monitor.job_counts(jobs(spark, sf))


@query("source_counts", f"{J} SELECT source, count(*) AS count FROM jobs GROUP BY source")
def source_counts(spark, sf):
    return monitor.source_counts(jobs(spark, sf))


@query("active_source_counts",
       f"{J} SELECT source, count(*) AS count FROM jobs WHERE is_active GROUP BY source")
def active_source_counts(spark, sf):
    return monitor.source_counts(jobs(spark, sf), active_only=True)


@query("stats", f"""{with_views('jobs', 'scrape_logs')}
SELECT 'total' AS section, NULL AS name, count(*) AS value FROM jobs
UNION ALL SELECT 'active', NULL, count(*) FROM jobs WHERE is_active
UNION ALL SELECT 'source', source, count(*) FROM jobs GROUP BY source
UNION ALL SELECT 'recent', source || ' ' || status || ' ' || id, jobs_found FROM (
  SELECT * FROM scrape_logs ORDER BY started_at DESC NULLS FIRST, id LIMIT 20)""")
def stats(spark, sf):
    parts = monitor.stats(jobs(spark, sf), logs(spark, sf))
    totals = parts["totals"].select(F.explode(F.array(
        F.struct(F.lit("total").alias("section"), F.col("total_jobs").alias("value")),
        F.struct(F.lit("active").alias("section"), F.col("active_jobs").alias("value")))).alias("t"))
    return (
        totals.selectExpr("t.section", "CAST(NULL AS STRING) AS name", "t.value")
        .unionByName(parts["sources"].selectExpr("'source' AS section", "source AS name", "count AS value"))
        .unionByName(parts["recent"].selectExpr(
            "'recent' AS section", "source || ' ' || status || ' ' || id AS name",
            "CAST(jobs_found AS BIGINT) AS value"))
    )


@query("run_totals", f"{L} SELECT CAST(coalesce(sum(jobs_new), 0) AS BIGINT) AS total_found FROM scrape_logs")
def run_totals(spark, sf):
    return monitor.run_totals(logs(spark, sf), "jobs_new")


@query("recent_run_summary", f"""{L} SELECT CAST(coalesce(sum(jobs_found), 0) AS BIGINT) AS total_found,
  CAST(coalesce(sum(jobs_new), 0) AS BIGINT) AS total_new, count(*) AS logs FROM scrape_logs
  WHERE started_at >= TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 1 HOUR""")
def recent_run_summary(spark, sf):
    return monitor.recent_run_summary(
        logs(spark, sf), EVENTS_AS_OF.replace(day=20, hour=12))


@query("recent_run_lines", f"""{L} SELECT source, status, jobs_found, jobs_new FROM scrape_logs
  WHERE started_at >= TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 1 HOUR""")
def recent_run_lines(spark, sf):
    return monitor.recent_logs(logs(spark, sf), EVENTS_AS_OF.replace(day=20, hour=12)).select(
        "source", "status", "jobs_found", "jobs_new")


@query("mon_active", f"{J} SELECT count(*) AS total FROM jobs WHERE is_active = TRUE")
def mon_active(spark, sf):
    return monitor.active_total(jobs(spark, sf))


@query("mon_by_source", f"""{J} SELECT source, count(*) AS count FROM jobs WHERE is_active
  GROUP BY source ORDER BY count DESC""")
def mon_by_source(spark, sf):
    return monitor.active_by_source(jobs(spark, sf))


@query("mon_today", f"""{J} SELECT count(*) FILTER (scraped_at >= TIMESTAMP '2000-05-05') AS since_midnight,
  count(*) FILTER (CAST(scraped_at AS DATE) = DATE '2000-05-05') AS on_day FROM jobs""")
def mon_today(spark, sf):
    return monitor.scraped_today(jobs(spark, sf), JOBS_AS_OF.replace(year=2000, month=5, day=5, hour=9))


@query("mon_daily", f"""{J} SELECT date_trunc('day', scraped_at) AS time, source, count(*) AS count
  FROM jobs WHERE scraped_at >= {AS_OF} - INTERVAL 30 DAY GROUP BY 1, 2""")
def mon_daily(spark, sf):
    return monitor.daily_by_source(jobs(spark, sf), JOBS_AS_OF)


@query("mon_logs", f"""{L} SELECT id, source, status, jobs_found, jobs_new, jobs_updated, started_at,
  finished_at, error_message FROM scrape_logs ORDER BY started_at DESC NULLS FIRST, id LIMIT 20""")
def mon_logs(spark, sf):
    return monitor.monitor_logs(logs(spark, sf))


@query("mon_locations", f"""{with_views('jobs')}, placed AS (
  SELECT * REPLACE (CASE WHEN id % 17 = 0 THEN 'Unknown' ELSE location END AS location) FROM jobs),
counted AS (SELECT location, count(*) AS count FROM placed WHERE is_active GROUP BY location)
SELECT coalesce(location, 'Unknown') AS location, count FROM counted
ORDER BY count DESC, counted.location ASC NULLS LAST LIMIT 10""")
def mon_locations(spark, sf):
    placed = F.when(F.col("id") % 17 == 0, "Unknown").otherwise(F.col("location"))
    return monitor.top_locations(jobs(spark, sf).withColumn("location", placed))


@query("mon_remote", f"""{J} SELECT CASE WHEN remote THEN 'Remote' ELSE 'On-site' END AS type,
  count FROM (SELECT remote, count(*) AS count FROM jobs WHERE is_active GROUP BY remote)""")
def mon_remote(spark, sf):
    return monitor.remote_split(jobs(spark, sf))


@query("mon_recent_jobs", f"""{J} SELECT id, title, company, location, source, posted_date, scraped_at,
  is_active FROM jobs ORDER BY scraped_at DESC NULLS FIRST, id LIMIT 100""")
def mon_recent_jobs(spark, sf):
    return monitor.recent_jobs(jobs(spark, sf))
