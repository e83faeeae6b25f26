"""Keyed merge, merge by url and the subscriber fold over event views."""

from datetime import datetime

from pyspark.sql import functions as F

from checks.fixtures import view, with_views
from checks.registry import query
from gleanery import schema
from gleanery.operators import merge

O = with_views("obs")
CUT = "TIMESTAMP '2024-01-16 00:00:00'"
ORDER = ["ts", "event_id"]
NOW = datetime(2024, 1, 31)

STORED = ["id", "source", "external_id"] + [
    c for c in schema.LAST_WINS + schema.FIRST_WINS if c != "id"]
_LAST = [c for c in schema.LAST_WINS if c != "is_active"]
_KEYED = "external_id IS NOT NULL"


def obs(spark, sf):
    return view(spark, sf, "obs")


def halves(spark, sf):
    """The stored table (first half folded, then all expired) and a batch."""
    rows = obs(spark, sf)
    early, late = rows.where(f"ts < {CUT}"), rows.where(f"ts >= {CUT}")
    keyed, loose = merge.split_keyed(early)
    target = (merge.collapse_batch(keyed, ORDER).select(*STORED)
              .unionByName(loose.select(*STORED)).withColumn("is_active", F.lit(False)))
    return target, late


def _last(c):
    return f"arg_max(struct_pack(v := {c}), struct_pack(ts := ts, e := event_id)).v AS {c}"


def _first(c):
    return f"arg_min(struct_pack(v := {c}), struct_pack(ts := ts, e := event_id)).v AS {c}"


def _fold(rows, active):
    return (f"SELECT source, external_id, {', '.join(_last(c) for c in _LAST)}, "
            f"{', '.join(_first(c) for c in schema.FIRST_WINS)}, {active} AS is_active "
            f"FROM {rows} WHERE {_KEYED} GROUP BY source, external_id")


_COLS = ", ".join(STORED)


@query("collapse_batch", f"{O} SELECT {_COLS} FROM ({_fold('obs', 'TRUE')})")
def collapse_batch(spark, sf):
    keyed, _ = merge.split_keyed(obs(spark, sf))
    return merge.collapse_batch(keyed, ORDER).select(*STORED)


_MERGED = f"""SELECT {_COLS} FROM ({_fold('obs', f'bool_or(ts >= {CUT})')})
UNION ALL SELECT {', '.join(c if c != 'is_active' else f'ts >= {CUT}' for c in STORED)}
FROM obs WHERE external_id IS NULL"""


@query("merge_upsert", f"{O} {_MERGED}")
def merge_upsert(spark, sf):
    target, batch = halves(spark, sf)
    return merge.merge_upsert(target, batch, ORDER)


@query("merge_upsert_small_batch", f"{O} {_MERGED}")
def merge_upsert_small_batch(spark, sf):
    target, batch = halves(spark, sf)
    keyed, _ = merge.split_keyed(batch)
    return merge.merge_upsert(target, batch, ORDER,
                              small_batch=merge.is_small(keyed))


@query("merge_newest_wins", f"""{O}, early AS (SELECT * FROM obs WHERE ts < {CUT}),
  late AS (SELECT * FROM obs WHERE ts >= {CUT}),
  stored AS ({_fold('late', 'FALSE')}), incoming AS ({_fold('early', 'TRUE')}),
  merged AS (SELECT coalesce(s.source, i.source) AS source,
    coalesce(s.external_id, i.external_id) AS external_id,
    {', '.join(f"CASE WHEN s.source IS NULL THEN i.{c} ELSE s.{c} END AS {c}"
               for c in _LAST + schema.FIRST_WINS)},
    s.source IS NULL AS is_active
  FROM stored s FULL JOIN incoming i ON s.source = i.source AND s.external_id = i.external_id)
SELECT {_COLS} FROM merged
UNION ALL SELECT {', '.join(c if c != 'is_active' else f'ts < {CUT}' for c in STORED)}
FROM obs WHERE external_id IS NULL""")
def merge_newest_wins(spark, sf):
    """The stored table is newer than the batch, so only unknown keys change."""
    rows = obs(spark, sf)
    early, late = rows.where(f"ts < {CUT}"), rows.where(f"ts >= {CUT}")
    keyed, loose = merge.split_keyed(late)
    target = (merge.collapse_batch(keyed, ORDER).select(*STORED)
              .unionByName(loose.select(*STORED)).withColumn("is_active", F.lit(False)))
    return merge.merge_upsert(target, early, ORDER, newest_wins=True)


@query("append_unkeyed", f"""{O} SELECT id, source, external_id, title FROM obs WHERE ts < {CUT}
UNION ALL SELECT id, source, external_id, title FROM obs WHERE ts >= {CUT} AND external_id IS NULL""")
def append_unkeyed(spark, sf):
    rows = obs(spark, sf).select("id", "source", "external_id", "title", "ts")
    return merge.append_unkeyed(rows.where(f"ts < {CUT}"), rows.where(f"ts >= {CUT}")).drop("ts")


@query("merge_counts", f"""{O}, keys AS (SELECT source, external_id, count(*) FILTER (ts >= {CUT}) AS n,
  count(*) FILTER (ts < {CUT}) AS old FROM obs WHERE {_KEYED} GROUP BY 1, 2),
a AS (SELECT source, sum(CASE WHEN old = 0 AND n > 0 THEN 1 ELSE 0 END) AS fresh, sum(n) AS n
  FROM keys GROUP BY 1),
b AS (SELECT source, count(*) AS loose FROM obs WHERE ts >= {CUT} AND external_id IS NULL GROUP BY 1)
SELECT 'actual' AS mode, a.source, CAST(fresh + coalesce(loose, 0) AS BIGINT) AS jobs_new,
  CAST(n - fresh AS BIGINT) AS jobs_updated FROM a LEFT JOIN b USING (source)
UNION ALL SELECT 'reference', a.source, CAST(coalesce(loose, 0) AS BIGINT), CAST(n AS BIGINT)
FROM a LEFT JOIN b USING (source)""")
def merge_counts(spark, sf):
    target, batch = halves(spark, sf)
    parts = [merge.merge_counts(target, batch, m).withColumn("mode", F.lit(m))
             for m in ("actual", "reference")]
    return parts[0].unionByName(parts[1])


# --- by url --------------------------------------------------------------

_URL_CTE = f"""{O}, stored AS (SELECT url, arg_min(title, id) AS title, min(id) AS id FROM obs
  WHERE ts < {CUT} GROUP BY url),
steps AS (SELECT o.url, o.source, o.title, o.ts, o.event_id, s.id AS stored_id, s.title AS stored_title,
    lag(o.title) OVER w AS prev, row_number() OVER w AS rn
  FROM obs o LEFT JOIN stored s ON o.url IS NOT DISTINCT FROM s.url WHERE o.ts >= {CUT}
  WINDOW w AS (PARTITION BY o.url ORDER BY o.ts, o.event_id)),
outcomes AS (SELECT *, CASE WHEN rn = 1 AND stored_id IS NULL THEN 'new'
    WHEN title IS DISTINCT FROM (CASE WHEN rn = 1 THEN stored_title ELSE prev END) THEN 'updated'
    ELSE 'skipped' END AS outcome FROM steps)"""


@query("merge_details", f"""{_URL_CTE} SELECT source,
  count(*) FILTER (outcome = 'new') AS new, count(*) FILTER (outcome = 'updated') AS updated,
  count(*) FILTER (outcome = 'skipped') AS skipped, count(*) AS total FROM outcomes GROUP BY source""")
def merge_details(spark, sf):
    rows = obs(spark, sf)
    return merge.merge_details(rows.where(f"ts < {CUT}"), rows.where(f"ts >= {CUT}"), ORDER)


@query("merge_by_url", f"""{_URL_CTE},
final AS (SELECT url, arg_max(title, struct_pack(ts := ts, e := event_id)) AS title,
  bool_or(outcome = 'updated') AS touched, any_value(stored_id) AS stored_id,
  min(event_id) FILTER (rn = 1) AS first_event FROM outcomes GROUP BY url)
SELECT o.id, o.url, o.source, o.location,
  CASE WHEN f.touched THEN f.title ELSE o.title END AS title,
  CASE WHEN f.touched THEN TIMESTAMP '2024-01-31' ELSE o.scraped_at END AS scraped_at
FROM obs o LEFT JOIN final f ON f.stored_id = o.id WHERE o.ts < {CUT}
UNION ALL SELECT o.id, o.url, o.source, o.location, f.title, TIMESTAMP '2024-01-31'
FROM final f JOIN obs o ON o.event_id = f.first_event WHERE f.stored_id IS NULL""")
def merge_by_url(spark, sf):
    rows = obs(spark, sf)
    target = rows.where(f"ts < {CUT}").select(
        "id", "url", "source", "location", "title", "company", "scraped_at", "is_active")
    out = merge.merge_by_url(target, rows.where(f"ts >= {CUT}"), ORDER, NOW)
    return out.select("id", "url", "source", "location", "title", "scraped_at")


_URL_SPLIT = f"{O}, stored AS (SELECT DISTINCT url FROM obs WHERE ts < TIMESTAMP '2024-01-03' AND url <> '')"


@query("known_urls", f"""{_URL_SPLIT} SELECT id, url FROM obs
WHERE ts >= TIMESTAMP '2024-01-03' AND url IN (SELECT url FROM stored)""")
def known_urls(spark, sf):
    rows = obs(spark, sf).select("id", "url", "ts")
    return merge.known_urls(rows.where("ts >= TIMESTAMP '2024-01-03'"),
                            rows.where("ts < TIMESTAMP '2024-01-03'")).drop("ts")


@query("unseen_urls", f"""{_URL_SPLIT} SELECT id, url FROM obs
WHERE ts >= TIMESTAMP '2024-01-03' AND (url IS NULL OR url NOT IN (SELECT url FROM stored))""")
def unseen_urls(spark, sf):
    rows = obs(spark, sf).select("id", "url", "ts")
    return merge.unseen_urls(rows.where("ts >= TIMESTAMP '2024-01-03'"),
                             rows.where("ts < TIMESTAMP '2024-01-03'")).drop("ts")


# --- subscribers ---------------------------------------------------------

_POS = "struct_pack(ts := ts, e := event_id)"
_FOLD = f"""SELECT email,
  coalesce(arg_max(name, {_POS}) FILTER (name <> ''), arg_min(struct_pack(v := name), {_POS}).v) AS name,
  CASE WHEN bool_or(source = 'cv_upload') THEN 'cv_upload' ELSE arg_min(source, {_POS}) END AS source,
  coalesce(arg_max(job_interests, {_POS}) FILTER (job_interests <> ''),
           arg_min(struct_pack(v := job_interests), {_POS}).v) AS job_interests,
  arg_min(ts, {_POS}) AS subscribed_at FROM user_events GROUP BY email"""


@query("user_fold", f"{with_views('user_events')} {_FOLD}")
def user_fold(spark, sf):
    return merge.user_fold(view(spark, sf, "user_events"), ORDER)


@query("user_upsert", f"""{with_views('users', 'user_events')}, folded AS ({_FOLD}),
stored AS (SELECT * REPLACE ('u' || id || '@example.test' AS email) FROM users)
SELECT s.id, coalesce(s.email, f.email) AS email, coalesce(nullif(f.name, ''), s.name, f.name) AS name,
  CASE WHEN f.source = 'cv_upload' THEN 'cv_upload' ELSE coalesce(s.source, f.source) END AS source,
  coalesce(nullif(f.job_interests, ''), s.job_interests, f.job_interests) AS job_interests,
  CASE WHEN s.id IS NOT NULL THEN s.subscribed_at ELSE f.subscribed_at END AS subscribed_at
FROM stored s FULL JOIN folded f ON s.email = f.email""")
def user_upsert(spark, sf):
    users = view(spark, sf, "users").withColumn("email", F.expr("'u' || id || '@example.test'"))
    return merge.upsert_users(users, view(spark, sf, "user_events"), ORDER).drop("last_emailed_at")
