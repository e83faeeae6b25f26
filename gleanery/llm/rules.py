"""Quality rules as a short-circuit cascade.

Each rule is a condition that a good text meets. On a sample of documents every
rule's cost (run time) and selectivity (share of documents that it rejects) are
estimated; the cascade applies rules in falling order of rejection per cost and
evaluates none after the first that fails. The order only saves time: a document
is kept if it meets all rules.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import SPACES, checkpointed, words

SYMBOLS = "#*$%&|<>"
WINDOW = 3
#: Rows of the sample that costs and selectivities are estimated on.
SAMPLE_ROWS = 1000


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")


def _covered(starts: Column) -> Column:
    """Words that windows with these sorted starts cover."""
    return F.coalesce(F.aggregate(
        starts, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda s, p: F.struct((p + WINDOW).alias("end"),
                              (s["n"] + p + WINDOW - F.greatest(s["end"], p)).alias("n")),
        lambda s: s["n"]), F.lit(0))


def repeat_words(ws: Column) -> Column:
    """Words in windows of three words that the text holds twice or more, the first included.

    Windows are told apart by 64-bit hashes; equal ones are neighbours once sorted.
    """
    def marked(s: Column) -> Column:
        return F.filter(F.transform(s, lambda x, j: F.when(
            (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]), x["p"])),
            lambda p: p.isNotNull())

    def counted(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, p: F.struct(h.alias("h"), p.alias("p")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(
            _covered(F.sort_array(_bind(F.sort_array(pairs), marked))))

    def windows(h: Column) -> Column:
        return F.transform(F.slice(h, 1, F.size(h) - WINDOW + 1), lambda x, i: F.xxhash64(
            x, F.get(h, i + 1), F.get(h, i + 2)))

    hashed = F.transform(ws, lambda w: F.xxhash64(w))
    return F.when(F.size(ws) < WINDOW, 0).otherwise(
        _bind(hashed, lambda h: _bind(windows(h), counted)))


def _without(text: Column, chars: str) -> Column:
    return F.char_length(F.translate(text, chars, ""))


def base(docs: DataFrame) -> DataFrame:
    """doc_id, text, ws (words), lines (with a word) and the base counts of every text."""
    known = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", "text", words(F.col("text")).alias("ws"), _lines(F.col("text")).alias("lines"))
    counted = known.select(
        "*", F.size("ws").cast("long").alias("n_words"),
        _without(F.col("text"), SPACES).cast("long").alias("word_chars"),
        (F.char_length("text") - _without(F.col("text"), SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("ws")).cast("long").alias("n_repeat_words"))
    return counted.withColumn("base_failed", (F.col("n_words") < 50) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


#: Conditions over the columns of base(); written without division, so that no count can be a divisor.
RULES: dict[str, Callable[[], Column]] = {
    "word_length": lambda: F.col("word_chars").between(2 * F.col("n_words"), 15 * F.col("n_words")),
    "symbols": lambda: 10 * F.col("n_symbols") <= F.col("n_words"),
    "repeated_lines": lambda: 10 * F.col("n_dup_lines") <= 3 * F.size("lines"),
    "shouting": lambda: 2 * (F.col("word_chars") - F.char_length(
        F.regexp_replace(F.translate("text", SPACES, ""), r"\p{Lu}", ""))) <= F.col("word_chars"),
    "exclaiming": lambda: 5 * (F.char_length("text") - _without(F.col("text"), "!")) <= F.col("n_words"),
    "distinct_words": lambda: 20 * F.size(F.array_distinct("ws")) >= F.least(
        F.col("n_words"), F.lit(20_000)),
    "words_with_letters": lambda: 10 * F.size(F.filter("ws", lambda w: w.rlike(r"\p{L}"))) >= 7 * F.col(
        "n_words"),
    "bullets": lambda: 10 * F.size(F.filter("lines", lambda x: x.rlike(r"^\s*[-*•]"))) <= 9 * F.size(
        "lines"),
    "cut_lines": lambda: 10 * F.size(F.filter("lines", lambda x: x.rlike(r"(\.\.\.|…)\s*$"))
                                     ) <= 3 * F.size("lines"),
}


def ranked(docs: DataFrame, rules=None, rows: int = SAMPLE_ROWS) -> list[tuple[str, float, float]]:
    """(rule, seconds, share rejected) in falling order of rejection per cost.

    The sample holds the rows of the smallest hashes of ids: at most `rows`.
    """
    rules = RULES if rules is None else rules
    total = docs.count()
    if not total:
        return [(name, 0.0, 0.0) for name in rules]
    share = F.lit(min(1.0, 2 * rows / total) * 2.0**52)
    near = F.shiftrightunsigned(F.xxhash64(F.lit(3), "doc_id"), 12).cast("double") <= share
    some = checkpointed(base(docs.select("doc_id", "text").where(near).limit(rows)).where(~F.col("base_failed")))
    n, found = some.count(), []

    def timed(check: Column) -> tuple[float, int]:
        start = time.perf_counter()
        rejected = some.agg(F.sum((~check).cast("int"))).first()[0] or 0
        return time.perf_counter() - start, rejected

    idle = min(timed(F.col("n_words") > 0)[0] for _ in range(2))
    for name, rule in rules.items():
        seconds = min(timed(rule())[0] for _ in range(2))
        found.append((name, max(seconds - idle, 1e-4), timed(rule())[1] / max(n, 1)))
    return sorted(found, key=lambda f: (-f[2] / f[1], f[1], f[0]))


def judge(docs: DataFrame, rules=None, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The base counts, base_failed and kept of every row of docs (doc_id, text).

    A null or blank text has no words and fails; repeated rows get equal
    verdicts; other columns are not read; an empty table gives an empty one.
    """
    rules = RULES if rules is None else rules
    verdict = F.when(F.col("base_failed"), False)
    for name, _, _ in ranked(docs, rules, rows):
        verdict = verdict.when(~rules[name](), False)
    return base(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        verdict.otherwise(True).alias("kept"))
