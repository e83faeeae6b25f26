"""Shaping extracted fields into raw postings, and isolating bad rows.

Extraction output has the raw posting columns, the place a row came from
(`page`, `pos`) and `reject`: NULL for a usable row, else the reason it is left
out. A bad card or body therefore never stops a run.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery import schema
from gleanery.functions.text import blank_to_null, present

PLACE = ["page", "pos"]
#: Reasons that stand for a whole page or body, not for one posting of it.
UNREADABLE = {"unparseable page": "unparseable pages", "malformed body": "malformed bodies"}
COLUMNS = schema.RAW_POSTING.fieldNames()


def first_reason(checks: list[tuple[str, Column]]) -> Column:
    """Name of the first failed check; a check that is NULL has not failed."""
    out = F.lit(None).cast("string")
    for name, failed in reversed(checks):
        out = F.when(failed, F.lit(name)).otherwise(out)
    return out


def shape(rows: DataFrame, columns: dict[str, Column],
          checks: list[tuple[str, Column]] = ()) -> DataFrame:
    """Project to the raw posting columns; absent ones are NULL, `remote` False."""
    unknown = set(columns) - set(COLUMNS)
    if unknown:
        raise ValueError(f"not posting columns: {sorted(unknown)}")
    typed = []
    for f in schema.RAW_POSTING.fields:
        default = F.lit(False) if f.name == "remote" else F.lit(None)
        value = columns.get(f.name, default)
        if f.name == "external_id":
            value = blank_to_null(value.cast("string"))
        typed.append(value.cast(f.dataType).alias(f.name))
    checks = list(checks) + [("no title", ~present(columns["title"]))]
    return rows.select(*typed, *PLACE, first_reason(checks).alias("reject"))


def overlong() -> list[tuple[str, Column]]:
    """Texts wider than their stored column."""
    return [(f"overlong {c}", F.length(c) > n) for c, n in schema.TEXT_LIMITS.items()]


def check_widths(rows: DataFrame) -> DataFrame:
    return rows.withColumn("reject", F.coalesce("reject", first_reason(overlong())))


def accepted(rows: DataFrame) -> DataFrame:
    """Usable rows. As an explode, because a filter would be pushed below the extraction
    and do it a second time, with its elements sought anew inside every lambda."""
    usable = F.explode(F.filter(F.array("reject"), lambda r: r.isNull())).alias("_usable")
    return rows.select("*", usable).drop("reject", "_usable")


def quarantine(rows: DataFrame) -> DataFrame:
    return rows.where("reject IS NOT NULL")


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Union of per-source frames; missing columns become NULL."""
    if not parts:
        raise ValueError("no sources selected")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def query_filter(rows: DataFrame, q: str | None, columns=("title",)) -> DataFrame:
    """Source-side search: `q` in any of the columns, missing ones as ''."""
    if not q:
        return rows
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.contains(F.lower(F.coalesce(F.col(c), F.lit(""))), F.lit(q.lower()))
    return rows.where(hit)


def dedup_first(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """First row per key in the given order; a missing key is one value.

    An aggregate, not a window: it combines before the shuffle, so a key shared
    by a third of the rows is no hot task.
    """
    kept = F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("r")
    return rows.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)]).agg(kept).select("r.*")


def cap_per_group(rows: DataFrame, group: str, n: int, order: list[str]) -> DataFrame:
    """First n rows per group. The rank filter runs inside every task first, so
    a large group sends at most n rows per task."""
    w = Window.partitionBy(group).orderBy(*order)
    return rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def latest_capture(rows: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """One row per key of rows landed several times: the newest by `captured_at` if
    they have that column, unstamped ones first; among equal stamps the largest content.

    An aggregate that combines before the shuffle; captures may come in any order.
    """
    row = F.struct(*columns)
    stamp = F.col("captured_at") if "captured_at" in rows.columns else F.lit(None).cast("timestamp_ntz")
    best = F.max_by(row, F.struct(stamp.isNotNull().alias("s"), stamp.alias("t"), row.alias("r"))).alias("_c")
    return rows.groupBy(*key).agg(best).select(*key, "_c.*")


def merge_detail(listing: DataFrame, detail: DataFrame, key: str = "url") -> DataFrame:
    """Detail fields over listing fields, where they are not empty. A missing
    detail page is fine; of several captures the newest counts. Rows without a
    key skip the join."""
    fields = [c for c in detail.columns if c in listing.columns and c != key]
    one = latest_capture(detail.where(present(F.col(key))), [key], fields).select(key, F.struct(*fields).alias("d"))
    keyed = listing.where(present(F.col(key))).join(one, key, "left")

    def pick(c: str) -> Column:
        found = F.col(f"d.{c}")
        if dict(listing.dtypes)[c] == "string":
            found = blank_to_null(found)
        return F.coalesce(found, F.col(c)).alias(c)

    merged = keyed.select(*[pick(c) if c in fields else F.col(c) for c in listing.columns])
    return merged.unionByName(listing.where(~present(F.col(key))))
