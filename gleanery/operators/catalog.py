"""Browse, search, sort, page and look up postings and users."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery import vocab
from gleanery.functions.text import any_of, escape_like, like_pattern
from gleanery.operators.lifecycle import at, source_is_junk, title_is_junk
from gleanery.session import work_dir

SORT_COLUMNS = ("scraped_at", "posted_date", "title", "company")
MAX_PAGE = 1000


def visible(jobs: DataFrame, as_of: datetime, patterns: list[str] | None = None) -> DataFrame:
    deadline = F.col("application_deadline")
    return jobs.where(
        F.col("is_active")
        & (deadline.isNull() | (deadline >= at(as_of)))
        & (F.length("description") > vocab.MIN_DESCRIPTION)
        & (F.length("title") > vocab.MIN_TITLE)
        & ~title_is_junk(patterns)
        & ~source_is_junk()
    )


def _infix(q: str, escape: bool) -> str:
    return like_pattern(f"%{escape_like(q) if escape else q}%")


def search(jobs: DataFrame, q: str, *, escape: bool = False,
           columns=("title", "company", "description", "tags")) -> DataFrame:
    """Rows containing `q` in any of the columns; `%` and `_` in `q` are
    wildcards unless `escape` is set."""
    return jobs.where(any_of([F.col(c).ilike(_infix(q, escape)) for c in columns]))


def narrow(jobs: DataFrame, *, source: str | None = None, location: str | None = None,
           job_type: str | None = None, remote: bool | None = None,
           escape: bool = False) -> DataFrame:
    """Optional filters; the equalities reach the parquet scan."""
    if source:
        jobs = jobs.where(F.col("source") == source)
    if location:
        jobs = jobs.where(F.col("location").ilike(_infix(location, escape)))
    if job_type:
        jobs = jobs.where(F.col("job_type") == job_type)
    if remote is not None:
        jobs = jobs.where(F.col("remote") == F.lit(remote))
    return jobs


def sort_keys(sort_by: str = "scraped_at", order: str = "desc", tiebreak: str = "id") -> list[Column]:
    """Ascending puts NULLs last and descending puts them first; the id makes
    the order total, so pages never overlap."""
    if sort_by not in SORT_COLUMNS:
        raise ValueError(f"unknown sort column: {sort_by}")
    if order not in ("asc", "desc"):
        raise ValueError(f"unknown sort order: {order}")
    first = F.col(sort_by).desc_nulls_first() if order == "desc" else F.col(sort_by).asc_nulls_last()
    return [first, F.col(tiebreak).asc()]


def sort_jobs(jobs: DataFrame, sort_by: str = "scraped_at", order: str = "desc") -> DataFrame:
    return jobs.orderBy(*sort_keys(sort_by, order))


def page(jobs: DataFrame, number: int = 1, per_page: int = 20,
         sort_by: str = "scraped_at", order: str = "desc") -> DataFrame:
    """One page as a distributed top-k; see `page_after` and `Ranked` for deep paging."""
    if number < 1 or not 1 <= per_page <= MAX_PAGE:
        raise ValueError("page starts at 1 and per_page lies between 1 and 1000")
    return sort_jobs(jobs, sort_by, order).offset((number - 1) * per_page).limit(per_page)


class Ranked:
    """A written order of rows in which any page is read by its place.

    The ids are sorted once over ranges of the order, so no task sees more than its
    range; the rank of a row is its place in its range plus the rows of the ranges
    before, one number per range. A page is a range of ranks: only the files, and in
    them the row groups, that hold it are read, however deep it lies. Rows are looked
    up by the ids of the page, of which there are `MAX_PAGE` at most.
    """

    def __init__(self, jobs: DataFrame, sort_by: str = "scraped_at", order: str = "desc", rows_per_file: int = 1_000_000):
        spark, path = jobs.sparkSession, work_dir(jobs.sparkSession)
        keys = sort_keys(sort_by, order)
        local = jobs.select("id", sort_by).repartitionByRange(*keys).sortWithinPartitions(*keys).select(
            "id", F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place"))
        local.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
        self._ids = spark.read.schema("id bigint, part int, place bigint").parquet(path)
        self._jobs, self._begins, total = jobs, {}, 0
        for part, n in sorted(self._ids.groupBy("part").agg(F.count("*")).collect()):  # one row per range
            self._begins[part] = (total, n)
            total += n
        self.total = total

    def page(self, number: int = 1, per_page: int = 20) -> DataFrame:
        """The rows of a page with their `rank`, from 1; none beyond the last page."""
        if number < 1 or not 1 <= per_page <= MAX_PAGE:
            raise ValueError("page starts at 1 and per_page lies between 1 and 1000")
        first = (number - 1) * per_page
        wanted, rank = F.lit(False), F.lit(None).cast("bigint")
        for part, (begin, n) in self._begins.items():
            if begin < first + per_page and first < begin + n:
                here = (F.col("part") == part) & F.col("place").between(
                    max(first - begin, 0), min(first + per_page - begin, n) - 1)
                wanted = wanted | here
                rank = F.when(F.col("part") == part, F.col("place") + begin + 1).otherwise(rank)
        found = self._ids.where(wanted).select(F.col("id").alias("_id"), rank.alias("rank"))
        return self._jobs.join(F.broadcast(found), F.col("id") == F.col("_id")).drop("_id")


def page_after(jobs: DataFrame, last_value, last_id: int, per_page: int = 20,
               sort_by: str = "scraped_at", order: str = "desc") -> DataFrame:
    """The page following the row (last_value, last_id): cost does not grow
    with the page number."""
    keys = sort_keys(sort_by, order)
    col, beyond_id = F.col(sort_by), F.col("id") > last_id
    if last_value is None:
        after = col.isNull() & beyond_id
        if order == "desc":
            after = after | col.isNotNull()
    else:
        mark = F.lit(last_value).cast(jobs.schema[sort_by].dataType)
        after = (col < mark) if order == "desc" else ((col > mark) | col.isNull())
        after = after | ((col == mark) & beyond_id)
    return jobs.where(after).orderBy(*keys).limit(per_page)


def page_totals(jobs: DataFrame, per_page: int = 20) -> DataFrame:
    """Row total and page count; an empty result still has one page."""
    total = F.count("*")
    return jobs.agg(
        total.alias("total"),
        F.greatest(F.ceil(total / F.lit(per_page)), F.lit(1)).cast("bigint").alias("pages"),
    )


def by_id(jobs: DataFrame, job_id: int) -> DataFrame:
    return jobs.where(F.col("id") == job_id)


def require_one(found: DataFrame) -> DataFrame:
    """Raise if a point lookup found nothing (reads at most one row)."""
    if found.limit(1).count() == 0:
        raise LookupError("not found")
    return found


def newest(df: DataFrame, n: int, by: str = "scraped_at") -> DataFrame:
    return df.orderBy(F.col(by).desc_nulls_first(), F.col("id")).limit(n)


def iso(c: Column) -> Column:
    """ISO text; the fraction appears only when it is not zero."""
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(c, "SSSSSS")
    return F.when(frac == "000000", whole).otherwise(F.concat(whole, F.lit("."), frac))


def log_projection(logs: DataFrame) -> DataFrame:
    return logs.select(
        "id", "source", "status", "jobs_found", "jobs_new", "jobs_updated", "error_message",
        iso(F.col("started_at")).alias("started_at"),
        iso(F.col("finished_at")).alias("finished_at"),
    )


def list_users(users: DataFrame, source: str | None = None) -> DataFrame:
    chosen = users.where(F.col("source") == source) if source else users
    return chosen.orderBy(F.col("subscribed_at").desc_nulls_first(), F.col("id"))


def count_users(users: DataFrame, source: str | None = None) -> DataFrame:
    """The number of users that `list_users` lists."""
    return (users.where(F.col("source") == source) if source else users).agg(F.count("*").alias("total"))


def rows_by_ids(df: DataFrame, ids: DataFrame, column: str = "id") -> DataFrame:
    """Membership as a semi join: the planner broadcasts a small id list by its
    statistics and shuffles a large one."""
    return df.join(ids.select(column).distinct(), column, "left_semi")
