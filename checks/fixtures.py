"""Views with the library's table shapes, derived from the test tables.

The rules are shared by Spark and DuckDB: each view is one SELECT whose few
dialect differences are filled in by name.
"""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

JOBS_AS_OF = datetime(2001, 8, 1)
EVENTS_AS_OF = datetime(2024, 1, 31)

_SPARK = {
    "days": "make_dt_interval(CAST({} AS INT))",
    "mins": "make_dt_interval(0, 0, {})",
    "json_k": "get_json_object(props, '$.k')",
    "ts": "TIMESTAMP_NTZ",
}
_DUCK = {
    "days": "to_days(CAST({} AS INTEGER))",
    "mins": "to_minutes({})",
    "json_k": "json_extract_string(props, '$.k')",
    "ts": "TIMESTAMP",
}


def _case(index: str, values: list[str]) -> str:
    arms = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE {index} {arms} END"


def _jobs(d: dict) -> str:
    title = _case("CAST(floor(o_orderkey / 64) AS BIGINT) % 10", [
        "'Senior Data Engineer'", "'Junior Accountant'", "'Jobs in Kenya today'",
        "'Sales Jobs'", "'Cook'", "'Click here to apply'", "'Remote Python Developer'",
        "'Head of Marketing'", "'Finance Intern'", "'Truck Driver at Acme Ltd'"])
    company = "CASE o_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'Customer ' || o_custkey END"
    location = _case("o_custkey % 6", [
        "'Nairobi, Kenya'", "'Mombasa, Kenya'", "'Remote'", "'Worldwide'", "'Lagos, Nigeria'", "NULL"])
    description = _case("CAST(floor(o_orderkey / 8) AS BIGINT) % 8", [
        "NULL", "''", "'short text'",
        "'Build data pipelines with python and sql every day'",
        "'You may work from home with flexible hours'",
        "'Monthly accounting &amp; excel reporting for clients'",
        "'<b>sales</b> lead for the regional field team'",
        "'General duties as assigned by the supervisor'"])
    job_type = _case("o_orderkey % 9", [
        "'Full Time'", "'PART-TIME '", "'contract/freelance'", "'Internship'", "'temp'",
        "' International'", "'Volunteer'", "NULL", "''"])
    level = _case("o_orderkey % 7", [
        "'Entry level'", "'Associate Director'", "'Sr. Lead'", "'VP'", "'Unspecified'", "NULL", "''"])
    source = _case("o_orderkey % 8", [
        "'linkedin'", "'brightermonday'", "'indeed'", "'google_linkedin'", "'remotive'",
        "'remoteok'", "'kemri'", "'manual'"])
    overdue = d["days"].format("o_orderkey % 2000")
    return f"""
SELECT o_orderkey AS id,
  CASE o_orderkey % 11 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'x' || o_orderkey END AS external_id,
  {title} AS title, {company} AS company, {location} AS location,
  {description} AS description, {job_type} AS job_type, {level} AS experience_level,
  CASE o_orderkey % 3 WHEN 1 THEN o_totalprice WHEN 2 THEN CAST(0 AS DOUBLE) END AS salary_min,
  CASE o_orderkey % 3 WHEN 1 THEN o_totalprice * 2 WHEN 2 THEN CAST(0 AS DOUBLE) END AS salary_max,
  CASE o_orderkey % 5 WHEN 0 THEN 'EUR' WHEN 1 THEN '' END AS salary_currency,
  CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN TRUE ELSE FALSE END AS remote,
  {source} AS source,
  CASE WHEN o_orderkey % 13 <> 0 THEN ' https://e.test/jobs/' || (o_orderkey % 5000) || '/' END AS url,
  CASE WHEN o_orderkey % 13 <> 0 THEN 'https://e.test/apply/' || (o_orderkey % 5000) || '  ' END AS apply_url,
  CASE o_orderkey % 6 WHEN 0 THEN 'legacy,tag' WHEN 1 THEN '' END AS tags,
  CASE WHEN o_orderkey % 2 = 0 THEN 'degree' END AS requirements,
  o_orderdate AS posted_date,
  CASE WHEN o_orderkey % 29 <> 0 THEN o_orderdate END AS scraped_at,
  CASE WHEN CAST(floor(o_orderkey / 3) AS BIGINT) % 4 <> 0 THEN o_orderdate + {overdue} END AS application_deadline,
  o_orderstatus <> 'F' AS is_active
FROM orders"""


def _obs(d: dict) -> str:
    title = f"'T' || {d['json_k']}"
    return f"""
SELECT event_id, event_id AS id, event_type AS source,
  CASE WHEN user_id % 25 <> 0 THEN 'u' || user_id END AS external_id,
  {title} AS title, CAST(NULL AS VARCHAR(100)) AS company,
  CASE WHEN event_id % 3 = 0 THEN 'Kenya' ELSE 'Remote' END AS location,
  'Observed ' || event_id AS description, CAST(NULL AS VARCHAR(100)) AS requirements,
  value AS salary_min, value * 2 AS salary_max,
  CASE WHEN event_id % 2 = 0 THEN 'KES' ELSE 'USD' END AS salary_currency,
  CASE event_id % 3 WHEN 0 THEN 'full-time' WHEN 1 THEN 'contract' END AS job_type,
  CAST(NULL AS VARCHAR(100)) AS experience_level, event_id % 4 = 0 AS remote,
  CASE WHEN event_id % 10 <> 0 THEN 'https://e.test/' || event_type || '/' || user_id END AS url,
  CAST(NULL AS VARCHAR(100)) AS apply_url, CAST(NULL AS VARCHAR(100)) AS tags,
  CAST(NULL AS {d['ts']}) AS application_deadline,
  ts AS posted_date, ts AS scraped_at, TRUE AS is_active, ts
FROM events"""


def _logs(d: dict) -> str:
    return f"""
SELECT event_id AS id, event_type AS source,
  CASE event_id % 5 WHEN 0 THEN 'failed' WHEN 1 THEN 'empty' ELSE 'success' END AS status,
  CAST(floor(value) AS INT) AS jobs_found,
  CASE WHEN event_id % 7 <> 0 THEN CAST(floor(value / 2) AS INT) END AS jobs_new,
  CAST(floor(value / 3) AS INT) AS jobs_updated,
  CASE WHEN event_id % 5 = 0 THEN 'error ' || event_id END AS error_message,
  ts AS started_at, ts + {d['mins'].format(5)} AS finished_at
FROM events"""


def _users(d: dict) -> str:
    interests = _case("c_custkey % 8", [
        "'python, sql'", "'accounting'", "'sales marketing'", "'ai'", "'zzz-none'",
        "'data_engineer'", "NULL", "''"])
    return f"""
SELECT c_custkey AS id, 'c' || c_custkey || '@example.test' AS email,
  CASE WHEN c_custkey % 4 <> 0 THEN 'Customer ' || c_custkey END AS name,
  CASE WHEN c_custkey % 3 = 0 THEN 'cv_upload' ELSE 'subscribe' END AS source,
  {interests} AS job_interests,
  CAST('2001-01-01 00:00:00' AS {d['ts']}) + {d['days'].format('c_custkey % 200')} AS subscribed_at,
  CAST(NULL AS {d['ts']}) AS last_emailed_at
FROM customer"""


def _user_events(d: dict) -> str:
    return """
SELECT event_id, 'u' || user_id || '@example.test' AS email,
  CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN '' ELSE 'N' || (event_id % 50) END AS name,
  CASE WHEN event_type = 'signup' THEN 'cv_upload' ELSE 'subscribe' END AS source,
  CASE WHEN event_id % 2 <> 0 THEN 'i' || (event_id % 7) END AS job_interests, ts
FROM events"""


_VIEWS = {"jobs": (_jobs, "orders"), "obs": (_obs, "events"), "scrape_logs": (_logs, "events"),
          "users": (_users, "customer"), "user_events": (_user_events, "events")}

SQL = {name: build(_DUCK) for name, (build, _) in _VIEWS.items()}


def with_views(*names: str) -> str:
    """A DuckDB WITH clause defining the named views."""
    return "WITH " + ", ".join(f"{n} AS ({SQL[n]})" for n in names)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spark_sql(name: str) -> str:
    return _VIEWS[name][0](_SPARK)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    base = _VIEWS[name][1]
    text = spark_sql(name).replace(f"FROM {base}", "FROM {base}")
    return spark.sql(text, base=table(spark, sf_dir, base))
