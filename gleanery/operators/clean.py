"""The cleaning chain: raw postings in, normalised postings out. No shuffle."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions import text as tx


def drop_untitled(df: DataFrame) -> DataFrame:
    """Clean the title and keep rows that still have one."""
    return df.withColumn("title", tx.clean_text(F.col("title"))).where("title IS NOT NULL")


def clean_jobs(df: DataFrame, *, remote_phrases=None, tag_keywords=None,
               whole_word: bool = False) -> DataFrame:
    """Text, drop, job type, level, remote, currency, tags, urls - in that order.

    Remote detection reads the normalised job type. Intermediate columns get
    their own projection so the lowered texts are computed once per row.
    """
    others = [c for c in df.columns if c not in ("title", "company", "location", "description")]
    step = _with_title(df.select(
        *others,
        *[tx.clean_text(F.col(c)).alias(c) for c in ("title", "company", "location", "description")],
    ))
    step = step.withColumns({
        "job_type": tx.normalize_job_type(F.col("job_type"), whole_word=whole_word),
        "experience_level": tx.normalize_experience_level(
            F.col("experience_level"), whole_word=whole_word),
    })
    step = step.withColumns({
        "_hay": tx.remote_haystack(*[F.col(c) for c in ("title", "location", "description", "job_type")]),
        "_desc": F.lower("description"),
    })
    step = step.withColumns({
        "remote": tx.detect_remote(F.col("remote"), F.col("_hay"), remote_phrases, whole_word),
        "salary_currency": tx.default_currency(
            F.col("salary_currency"), F.col("salary_min"), F.col("salary_max"), F.col("location")),
        "tags": _tags(F.col("tags"), F.col("_desc"), tag_keywords, whole_word),
        "url": tx.strip(F.col("url")),
        "apply_url": tx.strip(F.col("apply_url")),
    })
    return step.select(*df.columns)


def _with_title(rows: DataFrame) -> DataFrame:
    """Rows that have a title. As an explode, because a filter would be pushed
    below the projection and clean every title a second time."""
    kept = F.filter(F.array("title"), lambda t: t.isNotNull())
    return rows.withColumn("title", F.explode(kept))


def _tags(tags: Column, lowered: Column, keywords, whole_word: bool) -> Column:
    fill = ~tx.present(tags) & lowered.isNotNull()
    return F.when(fill, tx.extract_tags(lowered, keywords, whole_word)).otherwise(tags)


def clean_counts(raw: DataFrame) -> DataFrame:
    """Raw and cleaned row counts in one pass."""
    kept = tx.clean_text(F.col("title")).isNotNull()
    return raw.agg(F.count("*").alias("raw"), F.count_if(kept).alias("cleaned"))
