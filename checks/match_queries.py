"""Interest matching over the job and user views."""

from pyspark.sql import functions as F

from checks.fixtures import JOBS_AS_OF, table, view, with_views
from checks.registry import query
from gleanery.functions import text as tx
from gleanery.operators import match

JU = with_views("jobs", "users")

_TOKENS = """tokens AS (SELECT id AS user_id, job_interests, unnest(CASE
    WHEN len(list_filter(string_split_regex(replace(job_interests, ',', ' '), '\\s+'), lambda w: length(w) > 2)) > 0
    THEN list_filter(string_split_regex(lower(replace(job_interests, ',', ' ')), '\\s+'), lambda w: length(w) > 2)
    ELSE [lower(trim(job_interests))] END) AS keyword
  FROM users WHERE job_interests <> '')"""
_HITS = """hits AS (SELECT k.keyword, j.id, j.scraped_at FROM (SELECT DISTINCT keyword FROM tokens) k
  JOIN jobs j ON j.is_active AND (j.title ILIKE '%' || k.keyword || '%' OR j.description ILIKE '%' || k.keyword || '%'))"""
_TOP = """pairs AS (SELECT DISTINCT t.user_id, h.id, h.scraped_at FROM tokens t JOIN hits h USING (keyword)),
top AS (SELECT user_id, id AS job_id, rank FROM (SELECT *, CAST(row_number() OVER (
    PARTITION BY user_id ORDER BY scraped_at DESC NULLS FIRST, id) AS INTEGER) AS rank FROM pairs) WHERE rank <= 5)"""
_LATEST = """latest AS (SELECT id AS job_id, CAST(row_number() OVER (ORDER BY scraped_at DESC NULLS FIRST, id) AS INTEGER) AS rank
  FROM (SELECT * FROM jobs WHERE is_active ORDER BY scraped_at DESC NULLS FIRST, id LIMIT 5)),
recommended AS (SELECT user_id, job_id, rank, TRUE AS matched FROM top
  UNION ALL SELECT u.id, l.job_id, l.rank, FALSE FROM users u, latest l WHERE u.id NOT IN (SELECT user_id FROM top))"""


def both(spark, sf):
    return view(spark, sf, "jobs"), view(spark, sf, "users")


@query("interest_tokens", f"{with_views('users')}, {_TOKENS} SELECT DISTINCT user_id, keyword FROM tokens")
def interest_tokens(spark, sf):
    users = view(spark, sf, "users")
    return users.select(F.col("id").alias("user_id"), F.explode(
        match.interest_tokens(F.col("job_interests"))).alias("keyword"))


@query("keyword_hits", f"{JU}, {_TOKENS}, {_HITS} SELECT keyword, id FROM hits")
def keyword_hits(spark, sf):
    jobs, users = both(spark, sf)
    words = users.select(F.explode(match.interest_tokens(F.col("job_interests"))).alias("keyword"))
    return match.keyword_hits(jobs, words, columns=["id"])


_DOC_HITS = """WITH words AS (SELECT DISTINCT lower(p_name) AS keyword FROM part
  UNION SELECT unnest(string_split(lower(p_name), ' ')) FROM part
  UNION SELECT unnest(['ai', 'th_re', 'é', 'tion%the', '%']))
SELECT keyword, doc_id FROM words JOIN documents ON lower(text) LIKE '%' || keyword || '%'"""


def document_words(spark, sf):
    part = table(spark, sf, "part").select(F.lower("p_name").alias("name"))
    words = (part.selectExpr("name AS keyword")
             .union(part.select(F.explode(F.split("name", " "))))
             .union(part.select(F.explode(F.array(*[
                 F.lit(w) for w in ("ai", "th_re", "é", "tion%the", "%")])))))
    docs = table(spark, sf, "documents").select(
        "doc_id", F.lit(None).cast("string").alias("title"), F.col("text").alias("description"),
        F.lit(True).alias("is_active"))
    return docs, words


@query("document_keyword_hits", _DOC_HITS)
def document_keyword_hits(spark, sf):
    """The gram join over whole documents, with wildcard and short keywords."""
    docs, words = document_words(spark, sf)
    return match.keyword_hits(docs, words, columns=["doc_id"], listed=0)


@query("document_listed_hits", _DOC_HITS)
def document_listed_hits(spark, sf):
    return match.keyword_hits(*document_words(spark, sf), columns=["doc_id"])


_MANY = """people AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'engineer, data' ELSE
  lower(replace(p.p_name, ' ', ', ')) || ', k' || (o_orderkey % 10000) END AS job_interests
  FROM orders JOIN part p ON p.p_partkey = o_orderkey % (SELECT max(p_partkey) FROM part) + 1)"""
_SKEWED = _TOKENS.replace("FROM users", "FROM people")


@query("user_recommendations_skewed", f"""{with_views('jobs')}, {_MANY}, {_SKEWED}, {_HITS}, {_TOP}
SELECT user_id, rank, job_id FROM top""")
def user_recommendations_skewed(spark, sf):
    """One interest held by a third of all users, thousands of keywords, the newest jobs first."""
    orders, part = table(spark, sf, "orders"), table(spark, sf, "part")
    last = part.agg(F.max("p_partkey").alias("n")).scalar()
    words = F.concat(F.lower(F.replace("p_name", F.lit(" "), F.lit(", "))), F.lit(", k"),
                     (F.col("o_orderkey") % 10000).cast("string"))
    users = orders.withColumn("p_partkey", F.col("o_orderkey") % last + 1).join(part, "p_partkey").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderkey") % 3 == 0, "engineer, data").otherwise(words).alias("job_interests"))
    return match.user_top_matches(view(spark, sf, "jobs"), users, slices=(0.05,))


@query("user_top_matches", f"{JU}, {_TOKENS}, {_HITS}, {_TOP} SELECT user_id, rank, job_id FROM top")
def user_top_matches(spark, sf):
    return match.user_top_matches(*both(spark, sf))


@query("user_recommendations", f"""{JU}, {_TOKENS}, {_HITS}, {_TOP}, {_LATEST}
SELECT user_id, rank, job_id, j.title FROM recommended r JOIN jobs j ON j.id = r.job_id""")
def user_recommendations(spark, sf):
    return match.user_recommendations(*both(spark, sf), columns=["title"])


def _title_sql(c):
    return (f"list_aggregate(list_transform(regexp_extract_all({c}, '\\p{{L}}+|\\P{{L}}+'), "
            f"lambda r: CASE WHEN r[1] = 'ß' THEN 'Ss' ELSE upper(r[1]) END || lower(r[2:])), "
            f"'string_agg', '')")


@query("alert_payload", f"""{JU}, {_TOKENS}, {_HITS}, {_TOP}, {_LATEST},
cards AS (SELECT r.user_id, string_agg(concat_ws('|', r.rank, j.title,
    coalesce(nullif(j.company, ''), '—'), coalesce(nullif(j.location, ''), 'Remote'),
    CASE WHEN coalesce(u.job_interests, '') <> '' THEN '' ELSE coalesce(j.job_type, '') END,
    'https://jobs.test/jobs/' || j.id), ';' ORDER BY r.rank) AS cards
  FROM recommended r JOIN jobs j ON j.id = r.job_id JOIN users u ON u.id = r.user_id GROUP BY 1)
SELECT u.id AS user_id, u.email,
  CASE WHEN coalesce(u.job_interests, '') <> '' THEN 'targeted' ELSE 'welcome' END AS template,
  CASE WHEN u.name IS NOT NULL THEN 'Hello ' || u.name || ','
       WHEN coalesce(u.job_interests, '') <> '' THEN 'Hello there,' ELSE 'Hello,' END AS greeting,
  CASE WHEN coalesce(u.job_interests, '') <> '' THEN {_title_sql('u.job_interests')} END AS interest_label,
  CASE WHEN coalesce(u.job_interests, '') <> '' THEN 'Jobs for ' || {_title_sql('u.job_interests')} || ' professionals'
       ELSE 'Your Daily Job Alerts' END AS subject, c.cards
FROM users u JOIN cards c ON c.user_id = u.id""")
def alert_payload(spark, sf):
    rows = match.alert_payload(*both(spark, sf), site="https://jobs.test")
    line = lambda c: F.concat_ws("|", c["rank"].cast("string"), c["title"], c["company"],
                                 c["location"], c["badge"], c["link"])
    return rows.withColumn("cards", F.array_join(F.transform("cards", line), ";"))


@query("title_case", f"SELECT doc_id, {_title_sql('text')} AS label FROM documents")
def title_case(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.title_case(F.col("text")).alias("label"))


@query("mark_emailed", f"""{with_views('users')} SELECT id,
  CASE WHEN id IN (SELECT user_id FROM events) THEN TIMESTAMP '2001-08-01' END AS last_emailed_at FROM users""")
def mark_emailed(spark, sf):
    ids = table(spark, sf, "events").selectExpr("user_id AS id")
    out = match.mark_emailed(view(spark, sf, "users"), ids, JOBS_AS_OF)
    return out.select("id", "last_emailed_at")
