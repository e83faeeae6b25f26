"""Keyed merge of posting batches, merge by url, and the subscriber fold.

A batch is always pre-aggregated per key before it is joined, so a key repeated
in a third of the rows reaches the join as one row. Rows without a key never
enter a shuffle on the key.
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery import schema
from gleanery.functions.text import blank_to_null, present
from gleanery.operators.lifecycle import at

KEY = schema.MERGE_KEY


def _ord(order: list[str]) -> Column:
    return F.struct(*order)


def split_keyed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that can be merged by key, and rows that are always inserted."""
    keyed = present(F.col("external_id")) & present(F.col("source"))
    unkeyed = rows.where(~keyed).withColumn("external_id", blank_to_null(F.col("external_id")))
    return rows.where(keyed), unkeyed


def key_states(rows: DataFrame, order: list[str],
               last: list[str], first: list[str]) -> DataFrame:
    """One row per key: the last and the first observation, each with its
    position. States of disjoint batches combine with `fold_states`."""
    o = _ord(order)
    return rows.groupBy(*KEY).agg(
        F.max_by(F.struct(o.alias("_at"), *last), o).alias("last"),
        F.min_by(F.struct(o.alias("_at"), *first), o).alias("first"),
        F.count("*").alias("observations"),
    )


def fold_states(states: DataFrame) -> DataFrame:
    return states.groupBy(*KEY).agg(
        F.max_by("last", F.col("last._at")).alias("last"),
        F.min_by("first", F.col("first._at")).alias("first"),
        F.sum("observations").alias("observations"),
    )


def expand_states(states: DataFrame) -> DataFrame:
    """The rows the states stand for, as if applied to an empty table."""
    last = [f for f in states.schema["last"].dataType.names if f != "_at"]
    first = [f for f in states.schema["first"].dataType.names if f != "_at"]
    return states.select(
        *KEY, *[F.col(f"last.{c}").alias(c) for c in last],
        *[F.col(f"first.{c}").alias(c) for c in first])


def collapse_batch(rows: DataFrame, order: list[str], columns: list[str] | None = None) -> DataFrame:
    """Duplicates of a key inside one batch: overwritten columns from the last
    row, all others from the first. `columns` defaults to the stored ones."""
    last, first = policy([c for c in rows.columns if c in schema.LAST_WINS + schema.FIRST_WINS]
                         if columns is None else columns)
    return expand_states(key_states(rows, order, last, first))


def policy(columns: list[str]) -> tuple[list[str], list[str]]:
    """(last wins, first wins) among the columns."""
    last = [c for c in columns if c in schema.LAST_WINS]
    return last, [c for c in columns if c not in last and c not in KEY]


def _merged_columns(target: DataFrame, takes: Column, known: Column) -> list[Column]:
    """Column policy over the joined sides `t` and `b`."""
    out = []
    for c in target.columns:
        if c in KEY:
            out.append(F.coalesce(f"t.{c}", f"b.{c}").alias(c))
        elif c == "is_active":
            out.append(F.when(takes, F.lit(True)).otherwise(F.col(f"t.{c}")).alias(c))
        elif c in schema.LAST_WINS:
            out.append(F.when(takes, F.col(f"b.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(known, F.col(f"t.{c}")).otherwise(F.col(f"b.{c}")).alias(c))
    return out


def merge_collapsed(target: DataFrame, batch: DataFrame, *, newest_wins: bool = False,
                    small_batch: bool = False) -> DataFrame:
    """Merge a batch with one row per key into a table with one row per key.

    The general form is one full outer join on the key: a single exchange per
    side, and the batch's is the one its aggregation already made. With
    `small_batch` (the caller has checked its size, see `is_small`) the target is
    not shuffled at all: its rows meet a broadcast batch in a left join, and new
    keys are the batch minus the keys found by a broadcast semi join.
    """
    t = target.withColumn("_known", F.lit(True)).alias("t")
    b = batch.withColumn("_seen", F.lit(True)).alias("b")
    on = [F.col(f"t.{k}") == F.col(f"b.{k}") for k in KEY]
    known = F.coalesce(F.col("t._known"), F.lit(False))
    takes = F.coalesce(F.col("b._seen"), F.lit(False))
    if newest_wins:
        older = F.coalesce(F.col("b.scraped_at") < F.col("t.scraped_at"), F.lit(False))
        takes = takes & ~older
    if not small_batch:
        return t.join(b, on, "full_outer").select(*_merged_columns(target, takes, known))
    updated = t.join(F.broadcast(b), on, "left").select(*_merged_columns(target, takes, known))
    found = target.select(*KEY).join(F.broadcast(batch.select(*KEY)), KEY, "left_semi")
    fresh = batch.join(found, KEY, "left_anti")
    if "is_active" in target.columns:
        fresh = fresh.withColumn("is_active", F.lit(True))
    return updated.unionByName(fresh.select(*target.columns))


def is_small(df: DataFrame, rows: int = 50_000, size: int = 64 << 20) -> bool:
    """Whether a frame may be broadcast, by rows and by bytes of their text;
    looks at rows + 1 of its rows at most."""
    bytes_ = F.sum(F.octet_length(F.to_json(F.struct(*df.columns))))
    seen = df.limit(rows + 1).agg(F.count("*").alias("n"), F.coalesce(bytes_, F.lit(0)).alias("b")).first()
    return seen.n <= rows and seen.b <= size


def merge_upsert(target: DataFrame, batch: DataFrame, order: list[str], *,
                 newest_wins: bool = False, small_batch: bool = False) -> DataFrame:
    """Upsert on (source, external_id). An expired posting seen again becomes
    active; rows without an id are appended and bypass the join on both sides."""
    rows, loose = split_keyed(batch)
    stored, stored_loose = split_keyed(target)
    ranked = ["scraped_at"] + order if newest_wins else order
    merged = merge_collapsed(stored, collapse_batch(rows, ranked, target.columns),
                             newest_wins=newest_wins, small_batch=small_batch)
    return (merged
            .unionByName(stored_loose.select(*target.columns))
            .unionByName(loose.withColumn("is_active", F.lit(True)).select(*target.columns)))


def append_unkeyed(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Insert the rows without an id; no shuffle."""
    _, loose = split_keyed(batch)
    return target.unionByName(loose.select(*target.columns))


def merge_counts(target: DataFrame, batch: DataFrame, mode: str = "actual",
                 by: str = "source") -> DataFrame:
    """New and updated rows per source, or per other column `by` of the batch.

    `actual` calls the first row of an unknown key new and every other keyed row
    updated. `reference` counts every keyed row as updated, so only rows without
    an id are new.
    """
    if mode not in ("actual", "reference"):
        raise ValueError(f"unknown mode: {mode}")
    rows, loose = split_keyed(batch.select(*KEY, *({by} - set(KEY))))
    loose_n = loose.groupBy(by).agg(
        F.count("*").alias("jobs_new"), F.lit(0).cast("bigint").alias("jobs_updated"))
    # A key that several groups found is new in the first of them by name.
    per_key = rows.groupBy(*KEY).agg(F.count("*").alias("n")) if by in KEY else rows.groupBy(*KEY, by).agg(
        F.count("*").alias("n"))
    if mode == "reference":
        keyed_n = per_key.groupBy(by).agg(
            F.lit(0).cast("bigint").alias("jobs_new"), F.sum("n").alias("jobs_updated"))
    else:
        stored, _ = split_keyed(target.select(*KEY))
        known = per_key.join(stored.withColumn("_known", F.lit(1)), KEY, "left")
        fresh = F.when(F.col("_known").isNull(), 1).otherwise(0)
        if by not in KEY:
            first = F.row_number().over(Window.partitionBy(*KEY).orderBy(by)) == 1
            known = known.withColumn("_known", F.when(~first, 1).otherwise(F.col("_known")))
        keyed_n = known.groupBy(by).agg(
            F.sum(fresh).alias("jobs_new"), F.sum(F.col("n") - fresh).alias("jobs_updated"))
    return (loose_n.unionByName(keyed_n).groupBy(by)
            .agg(F.sum("jobs_new").alias("jobs_new"), F.sum("jobs_updated").alias("jobs_updated")))


# --- merge by url --------------------------------------------------------


def _pair(title="title", company="company") -> Column:
    return F.struct(F.col(title).alias("title"), F.col(company).alias("company"))


def _url_runs(batch: DataFrame, order: list[str]) -> DataFrame:
    """Rows with the previous (title, company) of the same url inside a chunk.

    Rows are range-partitioned by (url, order), so a url holding a third of the
    batch is cut into many chunks instead of filling one window task.
    """
    narrow = batch.select("url", "source", "title", "company", _ord(order).alias("ord"))
    chunked = (narrow.repartitionByRange("url", "ord")
               .withColumn("chunk", F.spark_partition_id()))
    w = Window.partitionBy("chunk", "url").orderBy("ord")
    return chunked.withColumn("prev", F.lag(_pair()).over(w))


def _first_stored(target: DataFrame) -> DataFrame:
    """The stored row a url refers to: the one with the lowest id."""
    return target.groupBy("url").agg(
        F.min_by(F.struct("id", "title", "company"), "id").alias("stored"))


def _url_changes(target: DataFrame, batch: DataFrame, order: list[str]) -> DataFrame:
    """Counts of new, updated and skipped rows per (url, source)."""
    runs = _url_runs(batch, order)
    inner_changed = ~F.col("prev").eqNullSafe(_pair())
    pieces = runs.groupBy("chunk", "url", "source").agg(
        F.count_if(F.col("prev").isNotNull() & inner_changed).alias("updated"),
        F.count_if(F.col("prev").isNotNull() & ~inner_changed).alias("skipped"),
        F.min_by(F.struct("source", _pair().alias("pair")), "ord").alias("head"),
        F.max_by(_pair(), "ord").alias("tail"),
        F.min("ord").alias("lo"), F.max("ord").alias("hi"),
    )
    inner = pieces.select("url", "source", F.lit(0).cast("bigint").alias("new"), "updated", "skipped")
    chunks = pieces.groupBy("chunk", "url").agg(
        F.min_by("head", "lo").alias("head"), F.max_by("tail", "hi").alias("tail"),
        F.min("lo").alias("lo"))
    seen = chunks.withColumn("before", F.lag("tail").over(Window.partitionBy("url").orderBy("lo")))
    s = seen.alias("s").join(_first_stored(target).alias("f"),
                             F.col("s.url").eqNullSafe(F.col("f.url")), "left")
    before = F.coalesce(F.col("s.before"),
                        F.when(F.col("f.stored").isNotNull(), _pair("f.stored.title", "f.stored.company")))
    outcome = (F.when(before.isNull(), "new")
               .when(~before.eqNullSafe(F.col("s.head.pair")), "updated").otherwise("skipped"))
    heads = s.select(F.col("s.url").alias("url"), F.col("s.head.source").alias("source"),
                     outcome.alias("outcome"))
    heads = heads.select("url", "source", *[
        F.when(F.col("outcome") == o, 1).otherwise(0).cast("bigint").alias(o)
        for o in ("new", "updated", "skipped")])
    return inner.unionByName(heads).groupBy("url", "source").agg(
        *[F.sum(o).alias(o) for o in ("new", "updated", "skipped")])


def merge_details(target: DataFrame, batch: DataFrame, order: list[str]) -> DataFrame:
    """New, updated, skipped and total rows per source of a merge by url."""
    changes = _url_changes(target, batch, order).groupBy("source").agg(
        *[F.sum(o).alias(o) for o in ("new", "updated", "skipped")])
    return changes.withColumn("total", F.col("new") + F.col("updated") + F.col("skipped"))


def merge_by_url(target: DataFrame, batch: DataFrame, order: list[str],
                 as_of: datetime) -> DataFrame:
    """Known url with another title or company: update those and the stamp;
    unchanged: leave; unknown: insert the first row of the url. A missing url
    matches a stored missing url."""
    cols = [c for c in target.columns if c not in ("scraped_at", "is_active")]
    o = _ord(order)
    folded = batch.groupBy("url").agg(
        F.min_by(F.struct(*[c for c in cols if c != "url"]), o).alias("first"),
        F.max_by(_pair(), o).alias("final"))
    changed = _url_changes(target, batch, order).groupBy("url").agg(F.sum("updated").alias("updated"))
    f, c, s = folded.alias("f"), changed.alias("c"), _first_stored(target).alias("s")
    state = (f.join(c, F.col("f.url").eqNullSafe(F.col("c.url")))
             .join(s, F.col("f.url").eqNullSafe(F.col("s.url")), "left")
             .select(F.col("f.url").alias("url"), "first", "final", "updated",
                     F.col("stored.id").alias("stored_id")))
    touched = state.where("stored_id IS NOT NULL AND updated > 0").select(
        F.col("stored_id").alias("id"), "final")
    kept = target.join(touched, "id", "left").select(*[
        F.when(F.col("final").isNotNull(), F.col(f"final.{n}")).otherwise(F.col(n)).alias(n)
        if n in ("title", "company")
        else F.when(F.col("final").isNotNull(), at(as_of)).otherwise(F.col(n)).alias(n)
        if n == "scraped_at" else F.col(n)
        for n in target.columns])
    fresh = state.where("stored_id IS NULL").select(*[
        F.col("url") if n == "url"
        else F.col(f"final.{n}").alias(n) if n in ("title", "company")
        else at(as_of).alias(n) if n == "scraped_at"
        else F.lit(True).alias(n) if n == "is_active"
        else F.col(f"first.{n}").alias(n)
        for n in target.columns])
    return kept.unionByName(fresh)


def known_urls(batch: DataFrame, target: DataFrame) -> DataFrame:
    """Batch rows whose url is stored; an empty url never is."""
    return _with_url(batch).join(_stored_urls(target), "url", "left_semi").select(*batch.columns)


def unseen_urls(batch: DataFrame, target: DataFrame) -> DataFrame:
    """The other rows. Rows without a url skip the join, where they would all
    hash to one task."""
    unseen = _with_url(batch).join(_stored_urls(target), "url", "left_anti")
    return unseen.select(*batch.columns).unionByName(batch.where(~present(F.col("url"))))


def _with_url(rows: DataFrame) -> DataFrame:
    return rows.where(present(F.col("url")))


def _stored_urls(target: DataFrame) -> DataFrame:
    return _with_url(target.select("url")).distinct()


# --- subscribers ---------------------------------------------------------


def user_fold(events: DataFrame, order: list[str]) -> DataFrame:
    """Subscription events folded per email: latest non-empty name and
    interests, source promoted to cv_upload once seen, first subscription time."""
    o = _ord(order)

    def latest(c: str) -> Column:
        filled = present(F.col(c))
        return F.coalesce(F.max_by(F.when(filled, F.col(c)), F.when(filled, o)),
                          F.min_by(F.struct(c), o)[c])

    return events.groupBy("email").agg(
        latest("name").alias("name"),
        F.when(F.bool_or(F.col("source") == "cv_upload"), "cv_upload")
        .otherwise(F.min_by("source", o)).alias("source"),
        latest("job_interests").alias("job_interests"),
        F.min_by("ts", o).alias("subscribed_at"),
    )


def upsert_users(users: DataFrame, events: DataFrame, order: list[str]) -> DataFrame:
    """Fold new events into the stored users; one exchange per side."""
    u = users.withColumn("_known", F.lit(True)).alias("u")
    e = user_fold(events, order).alias("e")

    def newer(c: str) -> Column:
        return F.coalesce(blank_to_null(F.col(f"e.{c}")), F.col(f"u.{c}"), F.col(f"e.{c}")).alias(c)

    promoted = F.when(F.col("e.source") == "cv_upload", "cv_upload").otherwise(
        F.coalesce("u.source", "e.source"))
    known = F.col("u._known").isNotNull()
    columns = {
        "email": F.coalesce("u.email", "e.email"),
        "name": newer("name"), "source": promoted, "job_interests": newer("job_interests"),
        "subscribed_at": F.when(known, F.col("u.subscribed_at")).otherwise(F.col("e.subscribed_at")),
        "id": F.when(known, F.col("u.id")).otherwise(F.xxhash64("e.email")),
    }
    joined = u.join(e, F.col("u.email") == F.col("e.email"), "full_outer")
    return joined.select(*[columns.get(c, F.col(f"u.{c}")).alias(c) for c in users.columns])
