"""Streams over several files equal the batch result."""

from pyspark.sql import functions as F

from checks.fixtures import view
from gleanery.operators import merge
from gleanery.session import work_dir
from gleanery.streaming import incremental as inc

COLUMNS = ["source", "external_id", "id", "title", "scraped_at", "job_type"]
ORDER = ["ts", "event_id"]


def landed(spark, sf, files=4):
    path = work_dir(spark)
    rows = view(spark, sf, "obs")
    for i in range(files):
        rows.where(F.col("event_id") % files == i).coalesce(1).write.mode("append").parquet(path)
    return path, rows


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upsert_over_micro_batches(spark, sf):
    path, rows = landed(spark, sf)
    out = work_dir(spark)
    source = inc.file_stream(spark, path, rows.schema, files_per_trigger=1)
    q = inc.upsert_stream(source, out, f"{out}/checkpoint", ORDER)
    q.awaitTermination()
    assert q.lastProgress["batchId"] >= 3
    want = merge.merge_upsert(rows.where("false"), rows, ORDER).select(*COLUMNS)
    assert rows_of(inc.current_rows(spark, out, COLUMNS)) == rows_of(want)
    # A second run finds nothing new; compaction keeps the contents.
    inc.upsert_stream(source, out, f"{out}/checkpoint", ORDER).awaitTermination()
    assert rows_of(inc.current_rows(spark, out, COLUMNS)) == rows_of(want)
    small = work_dir(spark)
    inc.compact_states(spark, out, small)
    assert rows_of(inc.current_rows(spark, small, COLUMNS)) == rows_of(want)


def test_daily_counts(spark, sf):
    path, rows = landed(spark, sf)
    out = work_dir(spark)
    stream = inc.daily_counts(inc.zoned(inc.file_stream(spark, path, rows.schema, files_per_trigger=2), "ts"))
    q = inc.write_complete(stream, out, f"{out}-checkpoint")
    q.awaitTermination()
    got = inc.latest_complete(spark, out, q).agg(F.sum("count"), F.count("*")).first()
    days = rows.select(F.to_date("ts"), "source").distinct().count()
    assert tuple(got) == (rows.count(), days)
