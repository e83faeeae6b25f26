"""Lifecycle rules. Each one is a single conditional projection over the table."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery import vocab
from gleanery.functions.text import any_of, like_pattern, present


def at(as_of: datetime) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


def days_before(as_of: datetime, days: int) -> Column:
    return at(as_of) - F.make_dt_interval(F.lit(days))


def _holds(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def deadline_passed(as_of: datetime) -> Column:
    return _holds(F.col("is_active") & (F.col("application_deadline") < at(as_of)))


def unseen_since(as_of: datetime, days: int = vocab.STALE_DAYS) -> Column:
    """Rows never stamped stay active."""
    return _holds(F.col("is_active") & (F.col("scraped_at") < days_before(as_of, days)))


def _deactivate(jobs: DataFrame, cond: Column) -> DataFrame:
    return jobs.withColumn("is_active", F.col("is_active") & ~cond)


def expire_deadline(jobs: DataFrame, as_of: datetime) -> DataFrame:
    return _deactivate(jobs, deadline_passed(as_of))


def expire_stale(jobs: DataFrame, as_of: datetime, days: int = vocab.STALE_DAYS) -> DataFrame:
    return _deactivate(jobs, unseen_since(as_of, days))


def expiry_reason(as_of: datetime, days: int = vocab.STALE_DAYS) -> Column:
    """Deadline is tested first: a row hit by both rules counts once, as deadline."""
    return (F.when(deadline_passed(as_of), "deadline")
            .when(unseen_since(as_of, days), "stale"))


def expire_all(jobs: DataFrame, as_of: datetime, days: int = vocab.STALE_DAYS) -> DataFrame:
    """Both rules at once; `expired` names the rule that hit, or is NULL."""
    marked = jobs.withColumn("expired", expiry_reason(as_of, days))
    return marked.withColumn("is_active", F.col("is_active") & F.col("expired").isNull())


def expiry_counts(jobs: DataFrame, as_of: datetime, days: int = vocab.STALE_DAYS) -> DataFrame:
    reason = expiry_reason(as_of, days)
    return jobs.agg(F.count_if(reason == "deadline").alias("deadline_expired"),
                    F.count_if(reason == "stale").alias("stale"))


def title_is_junk(patterns: list[str] | None = None) -> Column:
    listed = vocab.JUNK_TITLE_PATTERNS if patterns is None else patterns
    distinct = {p.lower(): p for p in listed}.values()
    return any_of([_holds(F.col("title").ilike(like_pattern(p))) for p in distinct])


def source_is_junk() -> Column:
    return _holds(F.col("source").ilike(vocab.JUNK_SOURCE_PATTERN))


def junk_rules(patterns: list[str] | None = None) -> dict[str, Column]:
    return {
        "description": ~_holds(F.length("description") > vocab.MIN_DESCRIPTION),
        "pattern": title_is_junk(patterns),
        "short_title": _holds(F.length("title") <= vocab.MIN_TITLE),
        "generic": (_holds(F.col("title").ilike(vocab.GENERIC_TITLE_PATTERN))
                    & ~present(F.col("company"))),
        "source": source_is_junk(),
    }


def junk_flags(jobs: DataFrame, patterns: list[str] | None = None) -> DataFrame:
    """Active rows hit by a junk rule, with the comma-joined rule names."""
    names = [F.when(cond, F.lit(name)) for name, cond in junk_rules(patterns).items()]
    return (jobs.where("is_active").withColumn("junk_reasons", F.concat_ws(",", *names))
            .where("junk_reasons <> ''"))


def junk_cleanup(jobs: DataFrame, patterns: list[str] | None = None) -> DataFrame:
    """Deactivate junk rows in one pass over the table."""
    return _deactivate(jobs, any_of(list(junk_rules(patterns).values())))


def junk_count(jobs: DataFrame, patterns: list[str] | None = None) -> DataFrame:
    hit = any_of(list(junk_rules(patterns).values()))
    return jobs.where("is_active").agg(F.count_if(hit).alias("deactivated"))
