"""Salary numbers and currencies in free text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

MODES = ("both", "min_only", "pair_only")


def numbers(c: Column) -> Column:
    """Digit runs after removing thousands commas."""
    runs = F.regexp_extract_all(F.replace(c, F.lit(","), F.lit("")), F.lit(r"\d+"), F.lit(0))
    return F.transform(F.coalesce(runs, F.array().cast("array<string>")),
                       lambda s: s.try_cast("double"))


def bounds(c: Column, mode: str = "both") -> tuple[Column, Column]:
    """(min, max): two numbers give a range; a single one gives both bounds,
    only the lower one, or nothing."""
    if mode not in MODES:
        raise ValueError(f"unknown salary mode: {mode}")
    n = numbers(c)
    first, second = F.get(n, F.lit(0)), F.get(n, F.lit(1))
    pair = F.size(n) >= 2
    low = first if mode != "pair_only" else F.when(pair, first)
    high = F.when(pair, second)
    if mode == "both":
        high = F.coalesce(high, first)
    return low, high


def unreadable(c: Column, mode: str) -> Column:
    """True where one of the leading digit-or-comma groups that would be read
    is commas only: such a card is rejected, not guessed at."""
    groups = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("[0-9,]+"), F.lit(0))
    need = F.lit(1) if mode == "min_only" else F.lit(2)
    lead = F.slice(groups, 1, 2)
    return (F.size(groups) >= need) & F.exists(lead, lambda g: ~g.rlike("[0-9]"))


def currency(c: Column, rules: list[tuple[list[str], str]], default: str) -> Column:
    """First rule whose marks occur in the text (letters in any case)."""
    up = F.upper(F.coalesce(c, F.lit("")))
    ladder = None
    for marks, code in rules:
        cond = F.lit(False)
        for m in marks:
            cond = cond | up.contains(m.upper())
        ladder = F.when(cond, code) if ladder is None else ladder.when(cond, code)
    return F.lit(default) if ladder is None else ladder.otherwise(default)


def range_bounds(c: Column) -> tuple[Column, Column]:
    """'a - b' or 'a – b'."""
    pattern = r"([0-9,]+)\s*[-–]\s*([0-9,]+)"

    def side(i: int) -> Column:
        digits = F.replace(F.regexp_extract(c, pattern, i), F.lit(","), F.lit(""))
        return digits.try_cast("double")

    low, high = side(1), side(2)
    complete = low.isNotNull() & high.isNotNull()
    return F.when(complete, low), F.when(complete, high)
