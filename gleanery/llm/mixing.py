"""Mixing sources to target word counts by entropy balancing.

Every document starts at rate 1. The rates nearest to that in relative entropy
whose words add up to the target of each source are exp(lambda * size / mean
size), cut at `MOST` copies: one dual variable per source, found by safeguarded
Newton iterations. Each iteration is one aggregation over the table of document
counts by (source, size), which is all that the dual depends on.

Rates become copies through a fixed offset u in (0, 1) that a document's id
hashes to: floor(rate + u). The words so taken are a step function of lambda.
Sections of lambda are narrowed, round by round and each by one aggregation, to
the single step at the target, and lambda ends on its nearer side. Where that
step is a long document, the words it leaves are made up by a lambda of their
own for the documents no longer than the gap, and so on; at last one document
per source changes by one copy.

The loops end by tests on the state, which is written and read again, so that
the driver keeps no plan or broadcast of the iterations before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.common import word_count, written

MOST = 3
#: Share of a source's target by which its rates may miss it.
TOLERANCE = 1e-9
#: Parts of the interval that lambda is known to lie in, looked at in one iteration.
GRID = 16
#: Sections that the rounded words are counted in, per round.
SECTIONS = 4096
#: Share of the target that is left to the change of one document.
CLOSE = 1e-3
#: Parts that the rows of one source are joined in.
SALTS = 64
#: Texts meet the solution by broadcast up to this many sources, else as salted rows.
BROADCAST_SOURCES = 10_000


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size and target from rows (source, z).

    Sources in code point order, null last, weigh 1, 2, 3, 1, 2, 3 and so on and
    share all words; a target stops at MOST times its source's words, and the
    others take the excess by weight: the targets are min(cap, level * weight).
    """
    total = sizes.groupBy("source").agg(F.sum("z").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = total.withColumn("w", (F.row_number().over(by_name) - 1) % 3 + 1).withColumn(
        "cap", F.lit(MOST) * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("w"), "w", "source")
    above = order.rowsBetween(0, Window.unboundedFollowing)
    below = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(below), F.lit(0))) / F.sum(
        "w").over(above)
    at = ranked.withColumn("level", level).withColumn("capped", F.col("cap") <= F.col("level") * F.col("w"))
    # In this order all sources up to the first open one are capped, and none after it.
    open_level = F.first(F.when(~F.col("capped"), F.col("level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return at.select("source", "source_size", F.coalesce(
        F.least("cap", open_level * F.col("w")), "cap").cast("double").alias("target"))


def _meet(rows: DataFrame, state: DataFrame, key: str = "doc_id") -> DataFrame:
    """rows with the columns of their source's state.

    Salted by `key`, so that a source's rows meet in many tasks. The sides merge:
    how many sources there are is not bounded, and a broadcast per iteration
    would stay in the driver's memory.
    """
    salted = state.withColumnRenamed("source", "state_source").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = rows.withColumn("own_salt", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int"))
    same = F.col("source").eqNullSafe(F.col("state_source")) & (F.col("own_salt") == F.col("salt"))
    return own.join(salted.hint("merge"), same).drop("state_source", "salt", "own_salt")


def _rate() -> Column:
    return F.least(F.lit(float(MOST)), F.exp(F.col("lam") * F.col("z") / F.col("mean")))


def solve(sizes: DataFrame, wanted: DataFrame) -> DataFrame:
    """source, source_size, target, mean, full and lam of the dual optimum; full where every rate is MOST.

    lo and hi enclose lambda from the start: the words taken are at most
    source_size * exp(lam * least / mean) for lam < 0 and at least that with the
    mean size of a word's document. An iteration looks at GRID + 1 points of the
    interval and the Newton point, so that the interval shrinks by GRID at least.
    """
    counts = written(sizes.where("z > 0").groupBy("source", "z").agg(F.count("*").alias("k")))
    words = F.col("k").cast("double") * F.col("z")
    shapes = counts.groupBy(F.col("source").alias("s")).agg(
        (F.sum(words) / F.sum("k")).alias("mean"), F.min("z").alias("least"),
        (F.sum(words * F.col("z")) / F.sum(words)).alias("heavy"))
    ratio, scale = F.log(F.col("target") / F.col("source_size")), F.col("mean") / F.col("least")
    full = (F.col("source_size") == 0) | (F.col("target") >= MOST * F.col("source_size") * (1 - 1e-12))
    state = wanted.join(shapes, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "source_size", "target", F.coalesce("mean", F.lit(1.0)).alias("mean"), full.alias("full"),
        F.when(ratio < 0, ratio * scale).otherwise(0.0).alias("lo"),
        F.when(ratio < 0, ratio * F.col("mean") / F.col("heavy")).otherwise(
            F.log(F.lit(float(MOST))) * scale).alias("hi"),
        F.coalesce(ratio, F.lit(0.0)).alias("lam"), full.alias("settled"))
    state = written(state)
    points = F.concat(F.transform(F.sequence(F.lit(0), F.lit(GRID)), lambda j: F.col("lo") + (
        F.col("hi") - F.col("lo")) * j / GRID), F.array("lam"))
    while not state.where("NOT settled").isEmpty():
        # The histogram has at most one row per source and size; its own key salts it.
        met = _meet(counts, state.where("NOT settled"), "z").select(
            "source", "z", "k", "mean", "target", F.posexplode(points).alias("j", "lam"))
        gap = F.sum(F.col("k") * F.col("z") * _rate()) - F.max("target")
        sums = met.groupBy("source", "j").agg(
            F.max("lam").alias("at"), gap.alias("gap"),
            F.sum(F.when(_rate() < MOST, F.col("k") * F.col("z") * F.col("z") / F.col("mean") * _rate()
                         ).otherwise(0.0)).alias("slope"))
        found = sums.groupBy(F.col("source").alias("s")).agg(
            F.max(F.when(F.col("gap") < 0, F.col("at"))).alias("low"),
            F.min(F.when(F.col("gap") >= 0, F.col("at"))).alias("high"),
            F.min(F.struct(F.abs("gap").alias("off"), "at", "gap", "slope")).alias("best"))
        step = state.join(found, F.col("source").eqNullSafe(F.col("s")), "left").withColumns({
            "lo": F.coalesce("low", "lo"), "hi": F.coalesce("high", "hi"),
            "newton": F.when(F.col("best.slope") > 0, F.col("best.at") - F.col("best.gap") / F.col("best.slope"))})
        near = F.col("settled") | (F.col("best.off") <= TOLERANCE * F.col("target")) | (
            F.col("hi") - F.col("lo") <= 1e-15 * F.greatest(F.abs("lo"), F.abs("hi")))
        state = written(step.select(
            "source", "source_size", "target", "mean", "full", "lo", "hi",
            F.when(F.col("settled"), F.col("lam")).when(near, F.col("best.at")).when(
                (F.col("newton") > F.col("lo")) & (F.col("newton") < F.col("hi")), F.col("newton")).otherwise(
                (F.col("lo") + F.col("hi")) / 2).alias("lam"), near.alias("settled")))
    return state.drop("lo", "hi", "settled")


def _offset(doc_id: Column) -> Column:
    return (F.shiftrightunsigned(F.xxhash64(F.lit(29), doc_id), 12).cast("double") + 0.5) / F.lit(2.0**52)


def _copies(lam: Column, mean: Column, full: Column, size: Column, doc_id: Column) -> Column:
    rate = F.least(F.lit(float(MOST)), F.exp(lam * size / mean))
    return F.when(size == 0, 1).when(full, MOST).otherwise(
        F.least(F.floor(rate + _offset(doc_id)), F.lit(MOST))).cast("int")


def _lam(size: Column) -> Column:
    """lambda for documents of a size: that of the last level that holds for it."""
    return F.element_at(F.filter("lams", lambda level: size <= level["upto"]), -1)["lam"]


def _nearest(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """source s, cut, run and short: the lambda where the copies' words come nearest to a goal, and these words.

    goals has source, mean, lam (where to look first), upto and goal; documents of
    more than upto words do not count. Each round counts the steps of the section
    that crosses the goal in SECTIONS new ones, until it is one step. short: the
    words of all copies do not reach the goal. Sources without a document to
    count are left out.
    """
    steps = F.array(*[F.log(k - _offset(F.col("doc_id"))) * F.col("mean") / F.col("z")
                      for k in range(1, MOST + 1)])
    none = F.lit(None).cast("double")
    at = written(goals.select(
        "source", "mean", "upto", "goal", (F.col("lam") - 1).alias("lo"), (F.col("lam") + 1).alias("hi"),
        F.lit(0).cast("long").alias("base"), none.alias("prev"), none.alias("next"), none.alias("cut"),
        F.lit(0).cast("long").alias("run"), F.lit(False).alias("short"), F.lit(False).alias("done")))
    first = True
    while not at.where("NOT done").isEmpty():
        events = _meet(sizes.where("z > 0"), at.where("NOT done")).where("z <= upto").select(
            "source", "mean", "upto", "goal", "lo", "hi", "base", "prev", "next", "z", F.explode(steps).alias("t"))
        if not first:
            events = events.where("t BETWEEN lo AND hi")
        # The first round has all steps before lo in section -1, and all from hi on in section SECTIONS.
        part = F.floor((F.col("t") - F.col("lo")) / (F.col("hi") - F.col("lo")) * SECTIONS)
        same = [F.max(c).alias(c) for c in ("mean", "upto", "goal", "base", "prev", "next")]
        parts = events.groupBy("source", F.greatest(F.least(part, F.lit(SECTIONS)), F.lit(-1)).alias("b")).agg(
            F.sum("z").alias("words"), F.min("t").alias("lo"), F.max("t").alias("hi"), *same)
        order = Window.partitionBy("source").orderBy("b")
        runs = parts.withColumns({
            "run": F.col("base") + F.sum("words").over(order),
            "prev": F.coalesce(F.lag("hi").over(order), "prev"),
            "next": F.coalesce(F.lead("lo").over(order), "next")})
        short = F.col("run") < F.col("goal")
        crossing = runs.groupBy("source").agg(F.min(F.struct(
            short.alias("short"), F.when(short, -F.col("b")).otherwise(F.col("b")).alias("k"), "run", "words", "mean",
            "upto", "goal", "lo", "hi", "prev", "next")).alias("x")).select("source", "x.*")
        low = F.col("run") - F.col("words")
        after = F.col("short") | (F.col("run") - F.col("goal") <= F.col("goal") - low)
        below, above = (F.col("prev") + F.col("lo")) / 2, (F.col("hi") + F.col("next")) / 2
        crossed = crossing.select(
            "source", "mean", "upto", "goal", "lo", "hi", low.alias("base"), "prev", "next",
            F.when(after, F.coalesce(above, F.col("hi") + 1)).otherwise(
                F.coalesce(below, F.col("lo") - 1)).alias("cut"),
            F.when(after | (F.col("lo") < F.col("hi")), F.col("run")).otherwise(low).alias("run"),
            "short", (F.col("short") | (F.col("lo") == F.col("hi"))).alias("done"))
        at, first = written(at.where("done").unionByName(crossed)), False
    return at.select(F.col("source").alias("s"), "cut", "run", "short")


def round_rates(sizes: DataFrame, state: DataFrame) -> DataFrame:
    """The state with lams, lambda by size, where the copies' words come nearest to the target, and the gap left.

    The second level and later ones hold for documents no longer than the gap
    that the one before left, and each leaves less.
    """
    none = F.lit(None).cast("double")
    every = F.lit((1 << 63) - 1)
    at = written(state.withColumns({
        "lams": F.array(F.struct(every.alias("upto"), "lam")), "gap": none, "open": ~F.col("full"),
        "upto": every, "goal": F.col("target")}))
    first = True
    while not at.where("open").isEmpty():
        found = _nearest(sizes, at.where("open").select("source", "mean", "lam", "upto", "goal"))
        step = at.join(found, F.col("source").eqNullSafe(F.col("s")), "left")
        hit = F.col("open") & F.col("cut").isNotNull()
        gap = F.when(hit, F.col("goal") - F.col("run")).otherwise(F.col("gap"))
        level = F.array(F.struct("upto", F.col("cut").alias("lam")))
        lams = F.when(hit, level if first else F.concat("lams", level)).otherwise(F.col("lams"))
        more = hit & ~F.col("short") & (F.abs(gap) > F.greatest(CLOSE * F.col("target"), F.lit(1.0))) & (
            F.col("gap").isNull() | (F.abs(gap) < F.abs("gap")))
        at = written(step.select(
            "source", "source_size", "target", "mean", "full", F.coalesce("cut", "lam").alias("lam"),
            lams.alias("lams"), gap.alias("gap"), more.alias("open"),
            F.floor(F.abs(gap)).cast("long").alias("upto")))
        now = _copies(_lam(F.col("z")), F.col("mean"), F.col("full"), F.col("z"), F.col("doc_id"))
        small = _meet(sizes.where("z > 0"), at.where("open")).where("z <= upto").groupBy(
            F.col("source").alias("s")).agg(F.sum(now * F.col("z")).alias("words"))
        at, first = at.join(small, F.col("source").eqNullSafe(F.col("s")), "left").withColumns({
            "open": F.col("open") & F.col("words").isNotNull(),
            "goal": F.col("words") + F.col("gap")}).drop("s", "words"), False
        at = written(at)
    return at.drop("open", "upto", "goal")


def close_gaps(sizes: DataFrame, state: DataFrame) -> DataFrame:
    """The state with the document of each source that, by one copy more or less, comes nearest to closing its gap."""
    left = F.abs(F.abs("gap") - F.col("z"))
    copies = _copies(_lam(F.col("z")), F.col("mean"), F.col("full"), F.col("z"), F.col("doc_id"))
    best = _meet(sizes.where("z > 0"), state).where(
        (left < F.abs("gap")) & F.col("doc_id").isNotNull()
        & F.when(F.col("gap") > 0, copies < MOST).otherwise(copies > 0)
    ).groupBy(F.col("source").alias("s")).agg(F.min(F.struct(
        left.alias("left"), F.xxhash64("doc_id").alias("h"), F.col("doc_id").alias("id"))).alias("best"))
    return written(state.join(best, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "source_size", "target", "mean", "full", "lams",
        F.col("best.id").alias("changed"), F.when(F.col("gap") > 0, 1).otherwise(-1).alias("change")))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, row (all columns of docs), size, source_size, target, rate, copies and taken.

    docs has doc_id (integer), text and source; a null source is a source, a null
    or blank text has size 0, rate 1 and one copy. Rows that repeat a doc_id in
    one source take equal copies. taken = copies * size; copies are 0 to MOST.
    Equal input gives equal output; an empty table gives an empty one.
    """
    sizes = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("z")))
    wanted = written(targets(sizes))
    state = close_gaps(sizes, round_rates(sizes, solve(sizes, wanted)))
    rows = docs.select("doc_id", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       word_count(F.col("text")).alias("size"))
    rate = F.when(F.col("size") == 0, 1.0).when(F.col("full"), float(MOST)).otherwise(
        F.least(F.lit(float(MOST)), F.exp(_lam(F.col("size")) * F.col("size") / F.col("mean"))))
    change = F.when((F.col("changed") == F.col("doc_id")) & (F.col("size") > 0), F.col("change")).otherwise(0)
    copies = _copies(_lam(F.col("size")), F.col("mean"), F.col("full"), F.col("size"), F.col("doc_id"))
    if wanted.count() <= BROADCAST_SOURCES:
        named = F.broadcast(state.withColumnRenamed("source", "state_source"))
        met = rows.join(named, F.col("source").eqNullSafe(F.col("state_source")))
    else:
        met = _meet(rows, state)
    return met.select(
        "doc_id", "row", "size", "source_size", "target", rate.alias("rate"),
        F.greatest(F.lit(0), F.least(F.lit(MOST), copies + F.coalesce(change, F.lit(0)))).alias("copies")
    ).withColumn(
        "taken", F.col("copies").cast("long") * F.col("size"))


def repeated(docs: DataFrame) -> DataFrame:
    """docs with every row as often as its copies say; columns as in docs."""
    return mix(docs).where("copies > 0").select(
        "row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")
