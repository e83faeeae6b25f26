"""Properties of the merges and the fold."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from gleanery.operators import lifecycle, merge

T0 = datetime(2024, 1, 1)
SCHEMA = ("id long, source string, external_id string, title string, company string, url string, "
          "job_type string, scraped_at timestamp_ntz, is_active boolean, ord long")


def postings(spark, n, seed, start=0):
    rng = random.Random(seed)
    rows = [(start + i, rng.choice("ab"), rng.choice([None, "", "1", "2", "3", "4"]), f"t{rng.randrange(3)}",
             rng.choice([None, "c1", "c2"]), rng.choice([None, "u1", "u1", "u2", f"u{rng.randrange(9)}"]),
             rng.choice([None, "full-time", "contract"]), T0 + timedelta(hours=start + i), True, start + i)
            for i in range(n)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def contents(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_merge_is_idempotent_for_keyed_rows(spark):
    _, batch = postings(spark, 60, 1)
    keyed, _ = merge.split_keyed(batch)
    empty = batch.where("false")
    once = merge.merge_upsert(empty, keyed, ["ord"])
    twice = merge.merge_upsert(once, keyed, ["ord"])
    assert contents(once) == contents(twice)


def test_split_batches_equal_one(spark):
    _, a = postings(spark, 50, 2)
    _, b = postings(spark, 50, 3, start=50)
    empty = a.where("false")
    stepwise = merge.merge_upsert(merge.merge_upsert(empty, a, ["ord"]), b, ["ord"])
    whole = merge.merge_upsert(empty, a.unionByName(b), ["ord"])
    drop = lambda d: d.withColumn("ord", F.lit(0))
    assert contents(drop(stepwise)) == contents(drop(whole))


def test_small_batch_form_agrees(spark):
    _, a = postings(spark, 40, 4)
    _, b = postings(spark, 40, 5, start=40)
    target = merge.merge_upsert(a.where("false"), a, ["ord"]).withColumn("is_active", F.lit(False))
    full = merge.merge_upsert(target, b, ["ord"])
    small = merge.merge_upsert(target, b, ["ord"], small_batch=merge.is_small(b))
    assert contents(full.drop("ord")) == contents(small.drop("ord"))


def test_is_small_bounds_rows_and_bytes(spark):
    df = spark.range(100).withColumn("t", F.repeat(F.lit("x"), 1000))
    assert merge.is_small(df)
    assert not merge.is_small(df, rows=99)
    assert not merge.is_small(df, size=50_000)


def test_states_fold_in_any_grouping(spark):
    _, rows = postings(spark, 80, 6)
    keyed, _ = merge.split_keyed(rows)
    last, first = ["title", "url"], ["id", "job_type"]
    whole = merge.expand_states(merge.key_states(keyed, ["ord"], last, first))
    parts = [merge.key_states(keyed.where(F.col("ord") % 3 == i), ["ord"], last, first) for i in range(3)]
    folded = merge.fold_states(parts[0].union(parts[1]).union(parts[2]))
    assert contents(whole) == contents(merge.expand_states(folded).select(*whole.columns))


def sequential_by_url(stored, batch):
    """Row by row, as a single writer would."""
    state, counts = {}, {"new": 0, "updated": 0, "skipped": 0}
    for r in sorted(stored, key=lambda r: r[0], reverse=True):
        state[r[5]] = (r[3], r[4])
    for r in batch:
        pair = (r[3], r[4])
        if r[5] not in state:
            counts["new"] += 1
        elif state[r[5]] != pair:
            counts["updated"] += 1
        else:
            counts["skipped"] += 1
        state[r[5]] = pair
    return state, counts


def test_merge_by_url_with_a_hot_url(spark):
    rows_a, a = postings(spark, 30, 7)
    rows_b, b = postings(spark, 400, 8, start=30)
    state, counts = sequential_by_url(rows_a, rows_b)
    got = merge.merge_details(a, b.repartition(4), ["ord"]).agg(
        *[F.sum(c).alias(c) for c in ("new", "updated", "skipped")]).first().asDict()
    assert got == counts
    merged = merge.merge_by_url(a, b, ["ord"], datetime(2025, 1, 1)).collect()
    assert len(merged) == len(rows_a) + counts["new"]
    first = {}
    for r in sorted(merged, key=lambda r: r.id, reverse=True):
        first[r.url] = (r.title, r.company)
    assert first == state


def test_known_and_unseen_partition_the_batch(spark):
    _, a = postings(spark, 20, 9)
    _, b = postings(spark, 60, 10)
    known, unseen = merge.known_urls(b, a), merge.unseen_urls(b, a)
    assert contents(known.unionByName(unseen)) == contents(b)
    assert unseen.where("url IS NULL").count() == b.where("url IS NULL").count()


def test_user_fold_sequence(spark):
    rows = [("e", "", "subscribe", None, T0, 1), ("e", "Ann", "cv_upload", "sql", T0, 2),
            ("e", "", "subscribe", "", T0, 3), ("f", None, "subscribe", "", T0, 4)]
    df = spark.createDataFrame(rows, "email string, name string, source string, job_interests string, "
                                     "ts timestamp_ntz, ord long")
    got = {r.email: (r.name, r.source, r.job_interests) for r in merge.user_fold(df, ["ord"]).collect()}
    assert got == {"e": ("Ann", "cv_upload", "sql"), "f": (None, "subscribe", "")}


def test_expiry_is_monotone(spark):
    _, rows = postings(spark, 50, 11)
    rows = rows.withColumn("application_deadline", F.col("scraped_at") + F.expr("INTERVAL '3' DAY"))
    early = {r.id for r in lifecycle.expire_all(rows, T0 + timedelta(days=4)).where("NOT is_active").collect()}
    late = {r.id for r in lifecycle.expire_all(rows, T0 + timedelta(days=40)).where("NOT is_active").collect()}
    assert early <= late and len(late) == 50
