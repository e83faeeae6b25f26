"""Conversation structure repair: the cheapest edits to a legal order of roles, by blocks.

Roles by their first letters have to read `(s?(ua)+)?`. A row may be kept (0), given the
role user or assistant (1) or deleted (2, the only choice for blank rows and for
repeats of an earlier role and text); a user or assistant with empty text may be
inserted anywhere (5); a truncated row that stays adds 5. Of the cheapest sequences of
edits, written D, I, K, R in order, the least one in ASCII order is taken.

Four-Russians: a row is one of nine symbols, and what is left to pay from the four
states of the language (start, after s, u, a) is a vector of four costs, whose
differences are bounded as an insertion leads from each state to the next. So there
are few vectors once the least cost is taken out. For each of them and every block of
`BLOCK` symbols a table holds the vector before the block, the cost taken out, and
where a trace that enters the block in some state leaves it. Costs are carried from the
end of a conversation to its start one block at a time; the trace then goes from the
start, expanding each block backward into the vectors of its rows, so that in every
state the least letter among the cheapest edits is known.

Rows are sorted once by (conversation, turn) over ranges, written, and numbered. A
conversation that spans several ranges is handled piece by piece: each piece gives its
map of vectors and states for all vectors, the maps (not the rows) of one conversation
meet, and each piece is then traced by itself. Repeats are found by an aggregation on
digests, neighbours by a join on row numbers, so no conversation has to fit a task.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import SPACES, written

#: Symbols of a block.
BLOCK = 3
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: State after the letters s, u, a and any other one; None where the language forbids it.
_STEP = {START: (AFTER_S, AFTER_U, None, None), AFTER_S: (None, AFTER_U, None, None),
         AFTER_U: (None, None, AFTER_A, None), AFTER_A: (None, AFTER_U, None, None)}
#: The state after the one letter, u or a, that can be inserted, and that letter.
_NEXT = {START: AFTER_U, AFTER_S: AFTER_U, AFTER_U: AFTER_A, AFTER_A: AFTER_U}
_LETTER = {START: "u", AFTER_S: "u", AFTER_U: "a", AFTER_A: "u"}
#: Rows of letter s, u, a, other; the same truncated; rows that have to go.
SYMBOLS = 9
_GO = 8


def _closed(costs: list[int]) -> tuple[int, ...]:
    """Costs to pay from each state, insertions before the next row included."""
    for _ in range(4):
        costs = [min(c, INSERT + costs[_NEXT[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


_FAR = 1 << 20
_END = _closed([0, _FAR, _FAR, 0])


def _edits(symbol: int, state: int):
    """The edits of a row in ASCII order: letter, cost, state after it, letter of the row's new role."""
    yield "D", DELETE, state, ""
    if symbol != _GO:
        role, more = symbol % 4, TRUNCATED if symbol >= 4 else 0
        if _STEP[state][role] is not None:
            yield "K", KEEP + more, _STEP[state][role], "sua"[role]
        yield "R", REROLE + more, _NEXT[state], _LETTER[state]


class Tables:
    """Vectors, single steps and steps of a block."""

    def __init__(self):
        known, todo, steps = {_END: 0}, [_END], []
        for vector in todo:  # grows while it is read
            row = []
            for symbol in range(SYMBOLS):
                costs = _closed([min(c + vector[t] for _, c, t, _ in _edits(symbol, q)) for q in range(4)])
                least = min(costs)
                costs = tuple(c - least for c in costs)
                if costs not in known:
                    known[costs] = len(known)
                    todo.append(costs)
                row.append((known[costs], least))
            steps.append(row)
        self.vectors = todo
        self.step = np.array([[s[0] for s in row] for row in steps])
        self.paid = np.array([[s[1] for s in row] for row in steps])
        #: [vector behind the row][symbol][state before it] -> edits, letters, state after it
        self.choice = [[[self._choose(v, x, q) for q in range(4)] for x in range(SYMBOLS)] for v in range(len(todo))]
        n, size = len(todo), SYMBOLS ** BLOCK
        self.block_step = np.empty((n, size), np.int64)
        self.block_paid = np.empty((n, size), np.int64)
        self.block_exit = np.empty((n, size, 4), np.int64)
        for code, block in enumerate(product(range(SYMBOLS), repeat=BLOCK)):
            for v in range(n):
                behind, paid = self._expand(v, block)
                self.block_step[v, code], self.block_paid[v, code] = behind[0], paid
                for q in range(4):
                    state = q
                    for i, x in enumerate(block):
                        state = self.choice[behind[i + 1]][x][state][2]
                    self.block_exit[v, code, q] = state

    def _expand(self, vector: int, block) -> tuple[list[int], int]:
        """The vectors before each row of a block and behind it, and the cost taken out."""
        out, paid = [vector], 0
        for x in reversed(block):
            paid += int(self.paid[vector, x])
            vector = int(self.step[vector, x])
            out.append(vector)
        return out[::-1], paid

    def _choose(self, behind: int, symbol: int, state: int) -> tuple[str, str, int]:
        before, paid = self.vectors[self.step[behind, symbol]], int(self.paid[behind, symbol])
        edits = letters = ""
        while True:
            options = list(_edits(symbol, state))
            best = [o for o in options if o[1] + self.vectors[behind][o[2]] == before[state] + paid]
            if best and best[0][0] == "D" or INSERT + before[_NEXT[state]] != before[state]:
                return edits + best[0][0], letters + (best[0][3] or "-"), best[0][2]
            edits, letters, state = edits + "I", letters + _LETTER[state], _NEXT[state]

    def blocks(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first symbols, fewer than a block, and the codes of the blocks after them."""
        head = len(symbols) % BLOCK
        weights = SYMBOLS ** np.arange(BLOCK - 1, -1, -1)
        return symbols[:head], symbols[head:].reshape(-1, BLOCK).astype(np.int64) @ weights

    def summary(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every vector behind the symbols: the one before them, the cost taken out, and the exits by state."""
        head, codes = self.blocks(symbols)
        vector = np.arange(len(self.vectors))
        paid, exits = np.zeros(len(vector), np.int64), np.tile(np.arange(4), (len(vector), 1))
        for code in codes[::-1]:
            exits = np.take_along_axis(exits, self.block_exit[vector, code], 1)
            paid += self.block_paid[vector, code]
            vector = self.block_step[vector, code]
        for x in head[::-1]:
            one = np.array([[c[2] for c in self.choice[v][x]] for v in vector])
            exits = np.take_along_axis(exits, one, 1)
            paid += self.paid[vector, x]
            vector = self.step[vector, x]
        return vector, paid, exits

    def trace(self, symbols: np.ndarray, behind: int, state: int) -> tuple[list[tuple[str, str]], int]:
        """The edits and new letters of every row from a state, and the state reached."""
        head, codes = self.blocks(symbols)
        bounds = [behind]
        for code in codes[::-1]:
            bounds.append(int(self.block_step[bounds[-1], code]))
        bounds.reverse()  # of the start of each block, and the end
        out = []
        parts = [(head, bounds[0])] + [(symbols[len(head) + i * BLOCK:][:BLOCK], bounds[i + 1]) for i in range(len(codes))]
        for part, vector in parts:
            vectors, _ = self._expand(vector, part)
            for i, x in enumerate(part):
                edits, letters, state = self.choice[vectors[i + 1]][x][state]
                out.append((edits, letters))
        return out, state

    @staticmethod
    def closing(state: int) -> tuple[str, str]:
        """The insertions that end a conversation in this state."""
        letters = ""
        while state not in (START, AFTER_A):
            letters, state = letters + _LETTER[state], _NEXT[state]
        return "I" * len(letters), letters


@lru_cache(1)
def tables() -> Tables:
    return Tables()


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and rep of the rows after damage by crc32(`conv_id:turn`) % 20; nulls in text form are one space."""
    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    text, role = spaced("text"), spaced("role")
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(kind == 0, F.array().cast("array<int>")).when(kind == 3, F.array(F.lit(0), F.lit(1)))
                  .otherwise(F.array(F.lit(0)))).alias("rep"))


def faults(rows: DataFrame) -> DataFrame:
    """rows (conv_id, turn, role, text) in order, with `at` (their number), fault and the initial of the role.

    A conversation is ordered by turn, nulls first; rows of one turn by role and text.
    fault: blank, duplicate, truncated or null. The table is written.
    """
    start = F.substring("text", 1, 64)  # as long texts would burden the sampling of ranges
    sorted_ = rows.repartitionByRange("conv_id", "turn", "role", start).sortWithinPartitions(
        "conv_id", "turn", "role", "text")
    table = written(sorted_.withColumn("local", F.monotonically_increasing_id()))
    part = F.shiftright("local", 33)
    sizes = sorted(table.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())  # a row per partition
    before, base = 0, []
    for number, n in sizes:
        base.append((number, before - (number << 33)))
        before += n
    bases = rows.sparkSession.createDataFrame(base, "part long, base long")
    table = table.withColumn("part", part).join(F.broadcast(bases), "part").withColumn(
        "at", F.col("local") + F.col("base")).drop("local", "base")
    blank = F.btrim("text", F.lit(SPACES)) == ""
    digest = F.md5(F.concat_ws("\0", F.col("conv_id").isNull().cast("string"), F.col("conv_id").cast("string"),
                               F.char_length("role").cast("string"), "role", "text").cast("binary"))
    first = table.where(~blank).groupBy(digest.alias("digest")).agg(F.min("at").alias("first"))
    end = F.right(F.rtrim(F.col("text"), F.lit(SPACES)), F.lit(1))
    narrow = table.select("conv_id", "part", "at", "turn", F.substring("role", 1, 1).alias("initial"),
                          blank.alias("blank"), (~end.isin(".", "!", "?")).alias("cut"), digest.alias("digest"))
    coded = narrow.join(first, "digest", "left").withColumn(
        "fault", F.when(F.col("blank"), "blank").when(F.col("first") < F.col("at"), "duplicate").when(F.col("cut"), "truncated"))
    return table.join(written(coded.select("at", "initial", "fault")), "at")


def _symbol() -> Column:
    letter = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(
        F.col("initial") == "a", 2).otherwise(3)
    return F.when(F.col("fault").isin("blank", "duplicate"), _GO).when(
        F.col("fault") == "truncated", letter + 4).otherwise(letter)


def _numbers(table: pa.Table) -> pa.Table:
    return table.sort_by("at")


def _summary(table: pa.Table) -> pa.Table:
    vectors, paid, exits = tables().summary(_numbers(table).column("symbol").to_numpy())
    return pa.table({
        "conv_id": table.column("conv_id").slice(0, 1), "part": table.column("part").slice(0, 1),
        "vectors": pa.array([vectors], pa.list_(pa.int64())), "exits": pa.array([exits.ravel()], pa.list_(pa.int64()))})


def _entries(table: pa.Table) -> pa.Table:
    """The vector behind each piece of a conversation, from the last one on, and the state before it, from the first one on."""
    table = table.sort_by("part")
    vectors, exits = table.column("vectors").to_pylist(), table.column("exits").to_pylist()
    behind, state, states = [0], START, []
    for after in reversed(vectors[1:]):
        behind.append(after[behind[-1]])
    behind.reverse()
    for vector, ways in zip(behind, exits, strict=True):
        states.append(state)
        state = ways[4 * vector + state]
    return table.select(["conv_id", "part"]).append_column("behind", pa.array(behind)).append_column(
        "state", pa.array(states, pa.int64())).append_column(
        "last", pa.array([False] * (len(behind) - 1) + [True]))


def _trace(table: pa.Table) -> pa.Table:
    table = _numbers(table)
    symbols, ids = table.column("symbol").to_numpy(), table.column("conv_id").combine_chunks()
    edits, letters = [], []
    ends = [i + 1 for i in range(len(ids) - 1) if ids[i] != ids[i + 1]] + [len(ids)]
    first = 0
    behind, state, last = (table.column(c).to_pylist() for c in ("behind", "state", "last"))
    for end in ends:
        piece = behind[first] is not None
        rows, at = tables().trace(symbols[first:end], behind[first] if piece else 0, state[first] if piece else START)
        if not piece or last[first]:
            more = tables().closing(at)
            rows[-1] = (rows[-1][0] + more[0], rows[-1][1] + more[1])
        edits += [r[0] for r in rows]
        letters += [r[1] for r in rows]
        first = end
    return pa.table({"at": table.column("at"), "edits": pa.array(edits, pa.string()), "letters": pa.array(letters, pa.string())})


def edits(marked: DataFrame) -> DataFrame:
    """at, edits (letters) and letters (the new initials, - for a deletion) of the rows of `faults`."""
    kind = marked.schema["conv_id"].dataType.simpleString()
    coded = marked.select("conv_id", "part", "at", _symbol().cast("long").alias("symbol"))
    spans = coded.groupBy("conv_id").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a < b").select(
        F.col("conv_id").alias("whole"))
    entries = (
        coded.join(spans, F.col("conv_id").eqNullSafe(F.col("whole")), "left_semi")
        .groupBy("conv_id", "part").applyInArrow(_summary, f"conv_id {kind}, part long, vectors array<long>, exits array<long>")
        .groupBy("conv_id").applyInArrow(_entries, f"conv_id {kind}, part long, behind long, state long, last boolean")
        .withColumnsRenamed({"conv_id": "whole", "part": "piece"}))
    return coded.join(
        entries, F.col("conv_id").eqNullSafe(F.col("whole")) & (F.col("part") == F.col("piece")), "left"
    ).drop("whole", "piece").groupBy("part").applyInArrow(_trace, "at long, edits string, letters string")


def edit_log(marked: DataFrame) -> DataFrame:
    """conv_id, at, step, edit, role, text: every edit in order; role and text are those after it, null for a deletion."""
    each = marked.join(edits(marked), "at").select(
        "conv_id", "at", "role", "text", "letters", F.posexplode(F.split("edits", "")).alias("step", "edit"))
    letter = F.get(F.split("letters", ""), F.col("step"))
    role = F.when(F.col("edit") == "K", F.col("role")).when(letter == "u", "user").when(letter == "a", "assistant")
    text = F.when(F.col("edit") == "I", "").when(F.col("edit") != "D", F.col("text"))
    return each.select("conv_id", "at", "step", "edit", role.alias("role"), text.alias("text"))


def report(rows: DataFrame) -> DataFrame:
    """One row per conv_id of rows (conv_id, turn, role, text): faults of the damaged rows, cost, audit and digest of the repair.

    Nulls in a role or text are one space; a null conv_id is a conversation of its own,
    null turns come first. Repeated rows are duplicates. A conversation without rows
    after damage has zeros, an empty audit and the digest of an empty string; an empty
    table gives no rows. Other columns are not read. The digest of a conversation is
    one running hash, so its repaired text passes through one task.
    """
    rows = rows.select("conv_id", "turn", "role", "text")
    marked = written(faults(damage(rows)))
    pairs = marked.select(F.col("conv_id").alias("before_id"), (F.col("at") + 1).alias("at"),
                          F.col("initial").alias("before"))
    illegal = marked.join(pairs, "at").where(
        F.col("conv_id").eqNullSafe(F.col("before_id"))
        & ~F.concat("before", "initial").isin("su", "ua", "au")).groupBy("conv_id").agg(F.count("*").alias("illegal"))
    found = marked.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
    log = edit_log(marked)
    late = marked.where("fault = 'truncated'").select("at", F.lit(TRUNCATED).alias("late"))
    cost = F.when(F.col("edit") == "I", INSERT).when(F.col("edit") == "D", DELETE).otherwise(
        F.when(F.col("edit") == "R", REROLE).otherwise(KEEP) + F.coalesce("late", F.lit(0)))
    steps = F.array_sort(F.collect_list(F.struct(
        "at", "step", "edit", F.concat("role", F.lit(":"), "text").alias("line"))))
    repaired = log.join(late, "at", "left").withColumn("cost", cost).groupBy("conv_id").agg(
        F.sum("cost").alias("cost"), steps.alias("steps")).select(
        "conv_id", "cost", F.array_join("steps.edit", "").alias("audit"),
        F.sha2(F.array_join("steps.line", "\n").cast("binary"), 256).alias("repaired_sha256"))
    out = rows.select("conv_id").distinct()
    for more in (found, illegal, repaired):
        other = more.withColumnRenamed("conv_id", "other")
        out = out.join(other, F.col("conv_id").eqNullSafe(F.col("other")), "left").drop("other")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select(
        "conv_id", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
