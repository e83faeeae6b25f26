"""Table schemas and the per-column merge policy.

Stored date-times carry no zone, so they are TIMESTAMP_NTZ throughout; only
streaming watermarks need a zoned timestamp and cast locally.
"""

from pyspark.sql import types as T


def _struct(ddl: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in ddl])


_S, _D, _B, _I, _L, _TS = (
    T.StringType(), T.DoubleType(), T.BooleanType(),
    T.IntegerType(), T.LongType(), T.TimestampNTZType(),
)

RAW_POSTING = _struct([
    ("title", _S), ("source", _S), ("company", _S), ("location", _S),
    ("description", _S), ("salary_min", _D), ("salary_max", _D),
    ("salary_currency", _S), ("job_type", _S), ("experience_level", _S),
    ("remote", _B), ("url", _S), ("apply_url", _S), ("tags", _S),
    ("requirements", _S), ("posted_date", _TS), ("application_deadline", _TS),
    ("external_id", _S),
])

JOBS = T.StructType(
    [T.StructField("id", _L)] + RAW_POSTING.fields
    + [T.StructField("scraped_at", _TS), T.StructField("is_active", _B)]
)

SCRAPE_LOGS = _struct([
    ("id", _L), ("source", _S), ("status", _S), ("jobs_found", _I),
    ("jobs_new", _I), ("jobs_updated", _I), ("error_message", _S),
    ("started_at", _TS), ("finished_at", _TS),
])

USERS = _struct([
    ("id", _L), ("email", _S), ("name", _S), ("source", _S),
    ("job_interests", _S), ("subscribed_at", _TS), ("last_emailed_at", _TS),
])

# Keyed merge: columns a later observation overwrites, and columns the first
# observation of a key decides for good.
MERGE_KEY = ["source", "external_id"]
LAST_WINS = [
    "title", "company", "location", "description", "requirements",
    "salary_min", "salary_max", "url", "apply_url", "tags",
    "application_deadline", "scraped_at", "is_active",
]
FIRST_WINS = [
    "id", "salary_currency", "job_type", "experience_level", "remote",
    "posted_date",
]

# Widths of the stored text columns; longer values go to quarantine.
TEXT_LIMITS = {
    "external_id": 255, "title": 500, "company": 300, "location": 300,
    "salary_currency": 10, "job_type": 50, "experience_level": 50,
    "url": 1000, "apply_url": 1000, "source": 100,
}
