"""Line dedup by an exact set-similarity join.

The words of a line form a set. A line goes if an earlier line, by (doc_id, line
number), has a set of Jaccard similarity `threshold` (0.8) or more; lines without
a word stay. Steps, all in DataFrame operations:

1. How often each word occurs is counted over all texts in `SKETCH` hash
   buckets, a table of fixed size. Words are ordered by the logarithm of their
   bucket's count, where that is equal by falling length, as longer words are
   rarer, then by hash: any one order is right, rare words first is fast.
2. Lines of equal sets become one, at their first place. The shuffle carries a
   128-bit key of the set, its size and its prefix: the size - ceil(0.8 size) + 2
   rarest words, of which similar sets must share two.
3. Sets that differ in a few words form groups whose pairs grow with the square
   of the group. So each set is first compared with the earliest set that has
   its size and two of its `LEADERS` rarest words; if they are similar it goes,
   and needs no other partner.
4. The sets left over probe each other by their prefix words, and those that are left
   then probe the earlier ones that went in step 3. A pair needs
   sizes within the threshold (length filter), enough words left from a shared
   one on (positional filter) and a second shared word. A bitmap of 256 bits per
   set bounds how many words one set has that the other lacks: each bit that
   only one of them has stands for one such word at least.
5. The whole sets of the pairs are fetched from their lines, and Jaccard is verified.

Words are identified by their length and 52 bits of hash, in step 5 by 64 bits of hash, sets by 128 bits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm import bits
from gleanery.llm.common import SPACES, written

THRESHOLD = 0.8
SKETCH = 1 << 17
LEADERS = 4
#: Longs of a set's bitmap. In one alone the bits of five words often fall on bits that are set.
MAPS = 4
#: Bits of a word's number that hold its hash, the upper ones; the lowest six hold its length.
HASH_BITS = 52
#: Bits of a word's rank above its hash that hold its length; six above hold how frequent it is.
LENGTH_BITS = 6
#: Bits of the packed entry that hold the position; the size lies above.
POS_BITS = 31


def _spaced(text: Column) -> Column:
    """text with a space for every other white space but line ends; words are then split at one character, without a pattern."""
    other = SPACES.replace(" ", "").replace("\n", "")
    has = [F.contains(text, F.lit(c)) for c in other]
    return F.when(reduce(Column.__or__, has), F.translate(text, other, " " * len(other))).otherwise(text)


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, n (line number from 0) and line of every line of every text, only spaces between words."""
    return docs.select("doc_id", F.posexplode(
        F.split(_spaced(F.coalesce("text", F.lit(""))), "\n", -1)).alias("n", "line"))


def _slot(number: Column) -> Column:
    """A word's bucket of the sketch."""
    return F.shiftrightunsigned(number, 65 - SKETCH.bit_length()).cast("int")


def rarity(docs: DataFrame) -> DataFrame:
    """One row with `sketch`: by bucket the bit length of its word count, where a rank has it."""
    counts = _lines(docs).select(F.explode(F.split("line", " ")).alias("w")).where("w <> ''").groupBy(
        _slot(F.xxhash64("w")).alias("slot")).agg(F.count("*").alias("k"))
    every = docs.sparkSession.range(SKETCH).select(F.col("id").cast("int").alias("slot"))
    level = F.shiftleft(F.least(F.coalesce(F.length(F.bin("k")), F.lit(0)), F.lit(31)).cast("long"), HASH_BITS + LENGTH_BITS)
    dense = every.join(counts, "slot", "left").agg(F.array_sort(F.collect_list(F.struct(
        "slot", level.alias("v")))).alias("s"))
    return written(dense.select(F.col("s.v").alias("sketch")))


def _set(line: Column, number) -> Column:
    """The distinct numbers of a line's words, in any order."""
    return F.array_remove(F.array_distinct(F.transform(F.split(line, " "), number)), number(F.lit("")))


def _number(w: Column) -> Column:
    """A word's hash, and below it its length, longer ones first."""
    short = F.bitwise_not(F.char_length(w)).bitwiseAND(F.lit(63))
    return F.xxhash64(w).bitwiseAND(F.lit(-1 << 64 - HASH_BITS).cast("long")).bitwiseOR(short.cast("long"))


def _ranks(numbers: Column, sketch: Column) -> Column:
    """The words of a set as sorted numbers, rare words first."""
    return F.sort_array(F.transform(numbers, lambda x: F.get(sketch, _slot(x)).bitwiseOR(
        F.shiftleft(x, HASH_BITS)).bitwiseOR(F.shiftrightunsigned(x, 64 - HASH_BITS))))


def _bitmap(words: DataFrame) -> DataFrame:
    """words with `bitmap`, `MAPS` longs in which each of `numbers` sets one bit.

    Each long has the words of one range of numbers, so each word is looked at once.
    """
    step = (1 << 64) // MAPS
    ends = [F.lit(k * step - (1 << 63)).cast("long") for k in range(1, MAPS)]
    cut = words.withColumn("cut", F.sort_array(F.concat("numbers", F.array(*ends))))
    cut = cut.withColumns({f"end{k}": F.array_position("cut", end).cast("int") for k, end in enumerate(ends, 1)})

    def map_of(k: int) -> Column:
        start = F.col(f"end{k}") if k else F.lit(0)
        end = F.col(f"end{k + 1}") if k + 1 < MAPS else F.size("cut") + 1
        return F.aggregate(F.slice("cut", start + 1, end - start - 1), F.lit(0).cast("long"), lambda map_, x: map_.bitwiseOR(
            F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(x, 56).cast("int")))).alias(f"m{k}")

    return cut.withColumn("bitmap", F.struct(*[map_of(k) for k in range(MAPS)]))


def _only(one: str, other: str) -> Column:
    """How many bits only the first map has: as many words at least are in that set alone."""
    counts = [F.bit_count(F.col(one)[f"m{k}"].bitwiseAND(F.bitwise_not(F.col(other)[f"m{k}"]))) for k in range(MAPS)]
    return sum(counts[1:], counts[0])


def first_lines(docs: DataFrame, sketch: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n, size, prefix and bitmap of the first line of each set of words."""
    # Lambdas are interpreted: they have few steps, and but the first run over distinct words.
    # Blank lines go by their text: a filter on sets would be pushed down and number each line's words twice.
    lines = _lines(docs).where("trim(line) <> ''").select("doc_id", "n", _set(F.col("line"), _number).alias("numbers"))
    # The sketch is a column, as it would be long as a literal of every plan.
    ranked = _bitmap(lines).withColumn("sketch", sketch.scalar()).select(
        "doc_id", "n", _ranks(F.col("numbers"), F.col("sketch")).alias("ranks"), "bitmap")
    prefix = (F.size("ranks") - F.ceil(F.size("ranks") * threshold - 1e-9) + 2).cast("int")
    keyed = ranked.select(
        F.xxhash64("ranks").alias("k1"), F.xxhash64(F.lit(1), "ranks").alias("k2"),
        F.struct("doc_id", "n").alias("at"), F.size("ranks").alias("size"),
        F.slice("ranks", 1, prefix).alias("prefix"), "bitmap")
    return keyed.groupBy("k1", "k2").agg(
        F.min("at").alias("at"), *[F.first(c).alias(c) for c in ("size", "prefix", "bitmap")]
    ).select("at.*", "size", "prefix", "bitmap")


def _similar(pairs: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """Distinct places (doc_id, n) of the later line b of the pairs (a, b) that are similar, written."""
    pairs = written(pairs)
    places = pairs.select("a.*").unionByName(pairs.select("b.*")).distinct()
    flags, known = bits.marked(places, F.struct("doc_id", "n")), bits.marked(places, F.col("doc_id"))
    lines = _lines(docs.where(bits.test(known, F.col("doc_id")))).where(bits.test(flags, F.struct("doc_id", "n")))
    # Repeated rows of a doc_id have the same lines; of other rows with one doc_id each line counts.
    # Written, as both sides of the pairs read them.
    sets = written(lines.join(
        places.toDF("id", "no"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("n") == F.col("no")),
        "left_semi").select(F.struct("doc_id", "n").alias("p"), _set(F.col("line"), lambda w: F.xxhash64(w)).alias("s")))
    shared = F.size(F.array_intersect("x", "y"))
    both = (
        pairs.join(sets.toDF("pa", "x"), F.col("a").eqNullSafe(F.col("pa")))
        .join(sets.toDF("pb", "y"), F.col("b").eqNullSafe(F.col("pb")))
    )
    return written(both.where(
        shared >= threshold * (F.size("x") + F.size("y") - shared) - 1e-9).select("b.*").distinct())


def _at(places: DataFrame) -> DataFrame:
    return places.select(F.col("doc_id").alias("gd"), F.col("n").alias("gn"))


def _among(firsts: DataFrame, places: DataFrame, how: str) -> DataFrame:
    return firsts.join(_at(places), F.col("doc_id").eqNullSafe(F.col("gd")) & (F.col("n") == F.col("gn")), how)


def _entries(firsts: DataFrame) -> DataFrame:
    """One row per prefix word of each set: its place, bitmap, size and the word's position."""
    return firsts.select(
        F.struct("doc_id", "n").alias("at"), "bitmap", "size", F.posexplode("prefix").alias("pos", "word")
    ).select("word", "at", "bitmap", F.shiftleft(F.col("size").cast("long"), POS_BITS).bitwiseOR(
        F.col("pos").cast("long")).alias("m"))


def candidates(earlier: DataFrame, later: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of a set of one and one of the other by their entries, a the earlier, that the prefix, length, positional and bitmap filters let through."""
    left, right = earlier.toDF("word", "a", "bits_a", "ma"), later.toDF("word", "b", "bits_b", "mb")
    mask = F.lit((1 << POS_BITS) - 1).cast("long")
    sa, sb = F.shiftright("ma", POS_BITS), F.shiftright("mb", POS_BITS)
    pa, pb = F.col("ma").bitwiseAND(mask), F.col("mb").bitwiseAND(mask)
    needed = F.ceil(threshold / (1 + threshold) * (sa + sb) - 1e-9)
    rest = F.least(sa - pa, sb - pb)
    met = left.join(right, "word").where(
        (F.col("a") < F.col("b"))
        & (F.least(sa, sb) >= threshold * F.greatest(sa, sb) - 1e-9)
        # The first shared word has `needed` words left, itself included, the second one less.
        & (rest >= needed - 1)
        & (_only("bits_a", "bits_b") <= sa - needed) & (_only("bits_b", "bits_a") <= sb - needed)
    ).select("a", "b", (rest - needed).alias("spare"))
    # The shared words that met, with all that are left after the last of them, must be enough.
    return met.groupBy("a", "b").agg(
        F.count("*").alias("shared"), F.max("spare").alias("most"), F.min("spare").alias("least")).where(
        (F.col("most") >= 0) & (F.col("shared") >= 2) & (F.col("shared") - 1 + F.col("least") >= 0)).select("a", "b")


def near_repeats(docs: DataFrame, firsts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Places (doc_id, n) among firsts that are similar to an earlier line."""
    place = F.struct("doc_id", "n").alias("at")
    group = Window.partitionBy("two").orderBy("at")
    twos = F.array(*[
        F.when(F.size("prefix") > j, F.xxhash64("size", F.get("prefix", F.lit(i)), F.get("prefix", F.lit(j))))
        for j in range(LEADERS) for i in range(j)])
    # A smaller set has no similar one but its equals, which are one set already.
    firsts = firsts.where(F.col("size") + 1 <= (F.col("size") * (1 / threshold) + 1e-9))
    led = firsts.select(place, F.explode(twos).alias("two")).where("two is not null")
    pairs = led.withColumn("a", F.first("at").over(group)).where("a < at").select(
        "a", F.col("at").alias("b")).distinct()
    gone = _similar(pairs, docs, threshold)

    # Sets that are left meet each other first. Only those that are still left then look
    # through the sets that have gone, so a group that resembles its leaders is not paired with itself.
    left = _among(firsts, gone, "left_anti")
    entries = _entries(left)
    more = _similar(candidates(entries, entries, threshold), docs, threshold)
    ahead, still = _entries(_among(firsts, gone, "left_semi")), _entries(_among(left, more, "left_anti"))
    # Few have gone: only their words are dealt out of the others.
    known = bits.marked(ahead, F.col("word"))
    last = _similar(candidates(ahead, still.where(bits.test(known, F.col("word"))), threshold), docs, threshold)
    return gone.unionByName(more).unionByName(last)


def kept_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Places (doc_id, n) of the lines that stay, of all lines with a word."""
    # Of hashes and bitmaps the default codec makes nothing smaller.
    firsts = written(first_lines(docs, rarity(docs), threshold), compression="zstd")
    gone = near_repeats(docs, firsts, threshold)
    return firsts.select("doc_id", "n").join(
        gone.select(F.col("doc_id").alias("gd"), F.col("n").alias("gn")),
        F.col("doc_id").eqNullSafe(F.col("gd")) & (F.col("n") == F.col("gn")), "left_anti")


def dedup_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs with the repeated lines taken out of `text`; every document stays.

    A null text stays null, and a text all of whose lines go becomes empty.
    Null ids come first in the order. Rows that repeat a doc_id are one document:
    equal rows keep equal texts; a line that only one of several rows with the
    same id has at its place is judged at that place. Other columns pass through.
    """
    if not 0.5 < threshold <= 1:
        raise ValueError("the threshold must be above 0.5: similar sets must share two words")
    kept = kept_lines(docs.select("doc_id", "text"), threshold)
    # One character per line up to the last kept one: 1 if it stays.
    marks = F.array_join(F.flatten(F.transform(
        F.array(F.sort_array(F.collect_set("n"))),
        lambda s: F.transform(s, lambda n, i: F.concat(
            F.repeat(F.lit("0"), n - F.when(i > 0, F.get(s, i - 1)).otherwise(F.lit(-1)) - 1),
            F.lit("1"))))), "")
    stay = written(kept.groupBy("doc_id").agg(marks.cast("binary").alias("stay"), F.count("*").alias("n_kept")).select(
        F.col("doc_id").alias("kept_id"), "stay", "n_kept"))
    # Documents that lose no line need no shuffle; their ids are not in the bit table.
    total = _lines(docs).where("trim(line) <> ''").groupBy("doc_id").agg(
        F.count("*").alias("total"))
    touched = total.join(
        stay.select("kept_id", "n_kept"), F.col("doc_id").eqNullSafe(F.col("kept_id")), "left").where(
        F.coalesce("n_kept", F.lit(0)) != F.col("total"))
    loses = bits.test(bits.marked(touched, F.col("doc_id")), F.col("row.doc_id"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    joined = rows.where(loses).join(stay.drop("n_kept"), F.col("row.doc_id").eqNullSafe(F.col("kept_id")), "left")
    lines = F.filter(
        F.split("row.text", "\n", -1),
        lambda line, i: (F.btrim(line, F.lit(SPACES)) == "") | (
            F.substring(F.coalesce("stay", F.lit(b"")), i + 1, F.lit(1)) == F.lit(b"1")))
    text = F.array_join(lines, "\n")
    return joined.select(*[
        (text if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns]).unionByName(
        rows.where(~loses).select("row.*"))
