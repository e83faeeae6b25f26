"""Interest matching: which active postings to recommend to which subscriber.

A keyword matches a posting whose title or description contains it. Keywords and
postings meet in the vocabulary, the distinct words of all texts, so that each word is
compared once, however many texts hold it:

* A keyword is cut at white space and wildcards into pieces. A piece lies within one
  word of a matching text; next to white space it begins or ends that word.
* Each piece is anchored on its rarest gram of three characters (or on the whole of a
  shorter one), counted over the vocabulary. An equi-join on the gram and a test of the
  word give the words that a piece occurs in.
* A keyword of several pieces is looked up by the piece whose words are in the fewest
  texts, and its candidates are verified. A keyword of one piece needs no more.

There is one way for few and for many keywords, and nothing is compared with everything.
Top-k is taken per keyword before any user is touched.
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.functions.text import WS, present, strip, title_case
from gleanery.operators.catalog import newest
from gleanery.operators.lifecycle import at
from gleanery.session import work_dir

GRAM = 3
TOP = 5
#: A key is hot if it holds more than this part of all rows, so there are fewer hot keys than that.
HOT_SHARE = 1000
SALTS = 32


def interest_tokens(c: Column) -> Column:
    """Words longer than two characters, lowered, split at commas and white
    space; if none is left, the whole text, stripped and lowered."""
    words = F.split(F.replace(c, F.lit(","), F.lit(" ")), f"{WS}+")
    long_words = F.transform(F.filter(words, lambda w: F.length(w) > 2), F.lower)
    return F.when(present(c), F.when(F.size(long_words) > 0, F.array_distinct(long_words))
                  .otherwise(F.array(F.lower(strip(c)))))


def _pieces(keyword: Column, wildcards: bool) -> Column:
    """The literal pieces of a keyword: their text, whether white space is before and
    behind them, and whether the piece is the whole keyword. Without any, one empty piece."""
    outside = ("%_" if wildcards else "") + WS[1:-1]
    pattern = F.lit(f"({WS}?)([^{outside}]+)(?=({WS}?))")
    parts = [F.regexp_extract_all(keyword, pattern, F.lit(i)) for i in (1, 2, 3)]
    found = F.transform(F.arrays_zip(*[x.alias(n) for x, n in zip(parts, ("a", "p", "z"), strict=True)]), lambda x: F.struct(
        x["p"].alias("piece"), (x["a"] != "").alias("begins"), (x["z"] != "").alias("ends"),
        (x["p"] == keyword).alias("whole")))
    none = F.array(F.struct(F.lit("").alias("piece"), F.lit(False).alias("begins"),
                            F.lit(False).alias("ends"), F.lit(False).alias("whole")))
    return F.when(F.size(found) > 0, found).otherwise(none)


def _grams(word: Column) -> Column:
    """The distinct grams of one to `GRAM` characters of a word; the empty word has the empty gram."""
    # Near the end of a word the longer ones are cut to shorter ones, which are grams too.
    grams = F.flatten(F.transform(F.sequence(F.lit(1), F.char_length(word)), lambda i: F.array(
        *[F.substring(word, i, F.lit(n)) for n in range(1, GRAM + 1)])))
    return F.when(word == "", F.array(F.lit(""))).otherwise(F.array_distinct(grams))


def _matches(text: Column, keyword: Column, wildcards: bool) -> Column:
    plain = F.contains(text, keyword)
    if wildcards:
        plain = F.when(keyword.rlike("[%_]"), F.like(text, F.concat(F.lit("%"), keyword, F.lit("%")))
                       ).otherwise(plain)
    return F.coalesce(plain, F.lit(False))


def _identified(texts: DataFrame) -> DataFrame:
    """Texts with 128 bits of their content; rows equal in all columns share them."""
    return texts.withColumns({"_h1": F.xxhash64(*texts.columns), "_h2": F.xxhash64(F.lit(1), *texts.columns)})


def _words_of(texts: DataFrame) -> DataFrame:
    """(_h1, _h2, word) of the distinct words of every text, the empty one included."""
    words = F.split(F.concat_ws(" ", "_t", "_d"), f"{WS}+")
    return texts.select("_h1", "_h2", F.explode(F.array_distinct(F.concat(F.array(F.lit("")), words))).alias("word"))


def word_keywords(words: DataFrame, keywords: DataFrame, wildcards: bool) -> DataFrame:
    """(word, keyword, whole): under which words of the texts to look up each keyword."""
    vocabulary = words.groupBy("word").agg(F.count("*").alias("texts"))
    grams = vocabulary.withColumn("gram", F.explode(_grams(F.col("word"))))
    pieces = keywords.select("keyword", F.posexplode(_pieces(F.col("keyword"), wildcards)).alias("no", "p")).select(
        "keyword", "no", "p.*")
    own = F.when(F.length("piece") <= GRAM, F.array("piece")).otherwise(F.filter(
        _grams(F.col("piece")), lambda g: F.length(g) == GRAM))
    each = pieces.withColumn("gram", F.explode(F.array_distinct(own)))
    common = grams.groupBy("gram").agg(F.count("*").alias("n"))
    rarest = each.join(common, "gram", "left").groupBy("keyword", "no", "piece", "begins", "ends", "whole").agg(
        F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram"))
    found = rarest.join(grams, "gram").where(
        F.contains("word", "piece") & (~F.col("begins") | F.startswith("word", "piece"))
        & (~F.col("ends") | F.endswith("word", "piece")))
    # A piece that no word holds rules its keyword out: it has no texts at all.
    cost = pieces.select("keyword", "no").join(
        found.groupBy("keyword", "no").agg(F.sum("texts").alias("texts")), ["keyword", "no"], "left")
    best = cost.groupBy("keyword").agg(F.min_by("no", F.struct(F.coalesce("texts", F.lit(0)), "no")).alias("no"))
    return found.join(best, ["keyword", "no"]).select("word", "keyword", "whole")


def keyword_hits(jobs: DataFrame, keywords: DataFrame, *, columns: list[str],
                 wildcards: bool = True, listed: int | None = None,
                 per_pass: int | None = None) -> DataFrame:
    """(keyword, columns...) for every active job matching a distinct keyword.

    `%` and `_` inside keywords are wildcards unless `wildcards` is off. `listed` and
    `per_pass` chose between earlier ways of matching and have no effect.
    """
    word = F.replace(F.col("keyword"), F.lit("\\"), F.lit("")) if wildcards else F.col("keyword")
    known = keywords.select(word.alias("keyword")).where("keyword IS NOT NULL").distinct()
    texts = _identified(jobs.where("is_active").select(
        *columns, F.lower("title").alias("_t"), F.lower("description").alias("_d")))
    words = _words_of(texts)
    found = words.join(word_keywords(words, known, wildcards), "word").select(
        "_h1", "_h2", "keyword", "whole").distinct()
    sure = texts.drop("_t", "_d").join(found.where("whole"), ["_h1", "_h2"])
    tested = texts.join(found.where("NOT whole"), ["_h1", "_h2"]).where(
        _matches(F.col("_t"), F.col("keyword"), wildcards) | _matches(F.col("_d"), F.col("keyword"), wildcards))
    return sure.select("keyword", *columns).unionByName(tested.select("keyword", *columns))


def _newest_first() -> list[Column]:
    return [F.col("scraped_at").desc_nulls_first(), F.col("id").asc()]


def top_per_keyword(hits: DataFrame, n: int = TOP) -> DataFrame:
    """The n newest jobs per keyword. The rank filter is applied inside every
    task before the shuffle, so a keyword matching a third of all jobs sends n
    rows per task."""
    w = Window.partitionBy("keyword").orderBy(*_newest_first())
    return hits.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def top_hits(jobs: DataFrame, keywords: DataFrame, *, n: int = TOP, columns: list[str],
             wildcards: bool = True, slices: tuple[float, ...] = ()) -> DataFrame:
    """The n newest hits per keyword; columns hold id and scraped_at.

    With `slices`, growing shares of the jobs such as (0.01, 0.1), the newest part is
    matched first, jobs without a stamp included, and older parts only for the
    keywords that are still short of n hits. What a slice finds is written, so a
    common keyword never meets the old jobs. The last slice holds all the rest.
    """
    if not slices:
        return top_per_keyword(keyword_hits(jobs, keywords, columns=columns, wildcards=wildcards), n)
    stamp = F.unix_micros(F.col("scraped_at").cast("timestamp"))
    bounds = jobs.where("is_active").agg(F.percentile_approx(
        stamp, [1 - share for share in slices], 100_000).alias("b")).first().b or []
    spark, above, out, left = jobs.sparkSession, None, None, keywords.select("keyword").distinct()
    for bound in [*bounds, None]:
        part = F.lit(True) if above is None else (stamp < above)
        if bound is not None:
            part = part & (stamp >= bound)
        if above is None:
            part = part | F.col("scraped_at").isNull()
        path = work_dir(spark)
        top_per_keyword(keyword_hits(jobs.where(part), left, columns=columns, wildcards=wildcards), n).write.parquet(path)
        hits = spark.read.parquet(path)
        out, above = hits if out is None else out.unionByName(hits), bound
        full = out.groupBy("keyword").agg(F.count("*").alias("n")).where(F.col("n") >= n)
        left = left.join(full, "keyword", "left_anti")
    return top_per_keyword(out, n)


def join_hot(rows: DataFrame, one: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """rows joined with `one`, which has one row per key, where a few keys may hold most rows.

    Keys with more than 1/`HOT_SHARE` of all rows are fewer than that, so their list is
    broadcast: their rows are dealt over `SALTS` tasks, and only their row of `one`
    is repeated. Rows without a key match nothing.
    """
    counts = rows.groupBy(key).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("t")).scalar()
    hot = F.broadcast(counts.where(F.col("_n") * HOT_SHARE > total).select(
        F.col(key), F.lit(True).alias("_hot")))
    spread = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int")
    salted = rows.join(hot, key, "left").withColumn("_salt", F.when(F.col("_hot"), spread).otherwise(0)).drop("_hot")
    copies = one.join(hot, key, "left").withColumn("_salt", F.explode(F.when(
        F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))).drop("_hot")
    return salted.join(copies, [key, "_salt"], how).drop("_salt")


def top_per_interest(jobs: DataFrame, users: DataFrame, *, n: int = TOP, columns: list[str],
                     wildcards: bool = True, slices: tuple[float, ...] = ()) -> DataFrame:
    """(job_interests, matches): the n newest matching jobs as an ordered array.

    Users sharing an interest text share one row. A user's n newest matches lie
    within the union of the n newest per keyword, because the order is the same.
    """
    interests = (users.where(present(F.col("job_interests"))).select("job_interests").distinct()
                 .withColumn("keyword", F.explode(interest_tokens(F.col("job_interests")))))
    if wildcards:
        interests = interests.withColumn("keyword", F.replace(F.col("keyword"), F.lit("\\"), F.lit("")))
    best = top_hits(jobs, interests, n=n, columns=columns, wildcards=wildcards, slices=slices)
    ordered = F.array_sort(F.collect_list(F.struct(*columns)))
    one = best.groupBy("keyword").agg(ordered.alias("best"))  # n rows at most
    pairs = join_hot(interests, one, "keyword").select("job_interests", "keyword", F.explode("best").alias("b")).select(
        "job_interests", "keyword", "b.*").drop("keyword").dropDuplicates(["job_interests", "id"])
    w = Window.partitionBy("job_interests").orderBy(*_newest_first())
    ranked = pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    return ranked.groupBy("job_interests").agg(
        F.array_sort(F.collect_list(F.struct("rank", *columns))).alias("matches"))


def _job_columns(columns: list[str]) -> list[str]:
    return list(dict.fromkeys(["id", "scraped_at", *columns]))


def user_matches(jobs: DataFrame, users: DataFrame, *, n: int = TOP, columns: list[str] = (),
                 wildcards: bool = True, slices: tuple[float, ...] = ()) -> DataFrame:
    """Users with the array of their matches, NULL where nothing matched."""
    best = top_per_interest(jobs, users, n=n, columns=_job_columns(columns), wildcards=wildcards, slices=slices)
    asking = present(F.col("job_interests"))
    matched = join_hot(users.where(asking), best, "job_interests", "left").select(*users.columns, "matches")
    silent = users.where(~asking).withColumn("matches", F.lit(None).cast(best.schema["matches"].dataType))
    return matched.unionByName(silent)


def user_top_matches(jobs: DataFrame, users: DataFrame, *, n: int = TOP, columns: list[str] = (),
                     wildcards: bool = True, slices: tuple[float, ...] = ()) -> DataFrame:
    """One row per (user, match): user_id, rank, job_id and the job columns."""
    found = user_matches(jobs, users, n=n, columns=columns, wildcards=wildcards, slices=slices)
    return _unnest(found.where("matches IS NOT NULL"), columns)


def _unnest(rows: DataFrame, columns) -> DataFrame:
    return rows.select(F.col("id").alias("user_id"), F.explode("matches").alias("m")).select(
        "user_id", "m.rank", F.col("m.id").alias("job_id"),
        *[F.col(f"m.{c}").alias(c) for c in columns])


def with_fallback(jobs: DataFrame, users: DataFrame, *, n: int = TOP, columns: list[str] = (),
                  wildcards: bool = True, slices: tuple[float, ...] = ()) -> DataFrame:
    """Users with their matches, or with the n newest active jobs if none.

    The fallback is a scalar subquery of n rows, not a join. `matched` tells the
    two apart.
    """
    cols = _job_columns(columns)
    latest = newest(jobs.where("is_active").select(*cols), n)
    w = Window.orderBy(*_newest_first())  # over the n rows of the limit
    as_array = latest.withColumn("rank", F.row_number().over(w)).agg(
        F.array_sort(F.collect_list(F.struct("rank", *cols))).alias("latest"))
    found = user_matches(jobs, users, n=n, columns=columns, wildcards=wildcards, slices=slices)
    return found.select(
        *users.columns, F.col("matches").isNotNull().alias("matched"),
        F.coalesce("matches", as_array.scalar()).alias("matches"))


def user_recommendations(jobs: DataFrame, users: DataFrame, *, n: int = TOP,
                         columns: list[str] = (), wildcards: bool = True,
                         slices: tuple[float, ...] = ()) -> DataFrame:
    rows = with_fallback(jobs, users, n=n, columns=columns, wildcards=wildcards, slices=slices)
    return _unnest(rows, columns)


def alert_payload(jobs: DataFrame, users: DataFrame, *, site: str, n: int = TOP,
                  wildcards: bool = True) -> DataFrame:
    """One row per user: template, greeting, label, subject and the job cards."""
    rows = with_fallback(jobs, users, n=n, wildcards=wildcards,
                         columns=["title", "company", "location", "job_type"])
    targeted = present(F.col("job_interests"))
    label = F.when(targeted, title_case(F.col("job_interests")))
    named = present(F.col("name"))
    greeting = (F.when(named, F.concat(F.lit("Hello "), "name", F.lit(",")))
                .when(targeted, F.lit("Hello there,")).otherwise(F.lit("Hello,")))
    subject = F.when(targeted, F.concat(F.lit("Jobs for "), label, F.lit(" professionals"))
                     ).otherwise(F.lit("Your Daily Job Alerts"))
    cards = F.transform("matches", lambda m: F.struct(
        m["rank"].alias("rank"), m["title"].alias("title"),
        F.when(present(m["company"]), m["company"]).otherwise("—").alias("company"),
        F.when(present(m["location"]), m["location"]).otherwise("Remote").alias("location"),
        F.when(targeted, F.lit("")).otherwise(F.coalesce(m["job_type"], F.lit(""))).alias("badge"),
        F.concat(F.lit(site.rstrip("/") + "/jobs/"), m["id"].cast("string")).alias("link")))
    return rows.select(
        F.col("id").alias("user_id"), "email",
        F.when(targeted, "targeted").otherwise("welcome").alias("template"),
        greeting.alias("greeting"), label.alias("interest_label"),
        subject.alias("subject"), cards.alias("cards"))


def mark_emailed(users: DataFrame, targeted_ids: DataFrame, as_of: datetime) -> DataFrame:
    """Stamp the targeted users; the id list is de-duplicated before the join."""
    ids = targeted_ids.select("id").distinct().withColumn("_hit", F.lit(True))
    stamped = F.when(F.col("_hit"), at(as_of)).otherwise(F.col("last_emailed_at"))
    return (users.join(ids, "id", "left").withColumn("last_emailed_at", stamped)
            .select(*users.columns))
