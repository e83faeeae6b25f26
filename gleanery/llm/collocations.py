"""Phrase collocations: contiguous phrases whose parts meet more often than by chance.

Per lang (null: `und`), A-Z in lower case: texts are cut at `[.,;:!?\\x0A-\\x0D]` into
pieces and those at spaces and tabs into words. A candidate has 2 to 5 words and
occurs at least `MIN_COUNT` times within pieces. A cut after k words scores
floor(1000 a n / (l r)): a, l, r count the phrase and its two parts, n all words. The
lowest cut counts, at equal scores the first one. A candidate goes if a phrase one
word wider occurs as often; it then lies in every occurrence of some longer phrase.

1. Texts are packed into chunks per lang, words separated by single spaces, pieces by
   line ends. A phrase that is frequent has only frequent parts, so phrases of n words
   are counted only where both parts of n - 1 words are frequent. Each chunk sorts its
   own occurrences by exact word numbers and deals its phrases, as text with a count
   each, to buckets by hash, one row per bucket. A bucket adds up its phrases exactly,
   gives each frequent one as one row, and tells every chunk which of its phrases these
   are. No chunk sees a whole vocabulary, no bucket a whole corpus.
   Words and pairs, most of which are rare, are first counted under 32 bits of hash
   within a bucket; only those that are frequent there are counted as text, exactly.
2. The frequent phrases are kept as two sorted streams, in prefix order (by first,
   second, ... word) and in suffix order (by last, last but one, ... word). In the one,
   a phrase follows its left parts and comes before what extends it to the right; in
   the other it follows its right parts and comes before what extends it to the left.
   One pass over each with a stack of at most five phrases gives all of these counts;
   a merge join of the two streams puts them together. Nothing is looked up by hash.
   Streams are dealt by ranges of two words, so a common word is no hot key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.chunks import BASE, CHUNK_BYTES, bucketed, mixed, next_chunk, ragged
from gleanery.llm.common import written

MIN_COUNT = 100
LONGEST = 5
TOP = 2000
#: Up to this length phrases are counted by hash before they are counted as text.
HASHED = 2
#: Words of the corpus for which there is one bucket of hashes.
BUCKET_WORDS = 2_000_000

_SPACE, _LINE = 32, 10
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: 0: part of a word, 1: between words, 2: between pieces.
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2

_PACKED = "chunk long, lang string, n_words long, words binary"
_HASHED = "bucket int, chunk long, names binary, counts binary"
_USUAL = "chunk long, bucket int, names binary"
_COUNTS = "bucket int, chunk long, lang string, names binary, counts binary"
_LEVEL = "chunk long, lang string, phrase string, f long, names binary"
_PARTS = "lang string, phrase string, f long, parts array<long>, wider long"


def normal(text: bytes) -> tuple[bytes, int]:
    """The words of a text that ends in a line end: a space after each, a line end after the last of a piece; and their number."""
    data = _LOWER[np.frombuffer(text, np.uint8)]
    kind = _KIND[data]
    word = kind == 0
    ends = np.flatnonzero(word[:-1] & ~word[1:]) + 1
    if not len(ends):
        return b"", 0
    breaks = np.cumsum(kind == 2, dtype=np.int32)
    starts = np.flatnonzero(word & ~np.concatenate([[False], word[:-1]]))
    last = np.append(breaks[starts[1:]] > breaks[ends[:-1] - 1], True)
    word[ends] = True
    data[ends] = np.where(last, _LINE, _SPACE)
    return data[word].tobytes(), len(ends)


def _pack(chunk_bytes: int):
    schema = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("n_words", pa.int64()), ("words", pa.binary())])

    def pack(batches):
        numbers, texts, sizes = next_chunk(), {}, {}

        def row(lang):
            words, n = normal(b"\n".join(texts.pop(lang)) + b"\n")
            sizes.pop(lang)
            return pa.RecordBatch.from_pylist(
                [{"chunk": next(numbers), "lang": lang, "n_words": n, "words": words}], schema=schema)

        held = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                texts.setdefault(lang, []).append(text)
                sizes[lang] = sizes.get(lang, 0) + len(text)
                held += len(text)
                if sizes[lang] >= chunk_bytes:
                    held -= sizes[lang]
                    yield row(lang)
                elif held >= 4 * chunk_bytes:  # many langs at a time
                    most = max(sizes, key=sizes.get)
                    held -= sizes[most]
                    yield row(most)
        for lang in list(texts):
            yield row(lang)
    return pack


class _Words:
    """The words of a chunk as numbers."""

    def __init__(self, text: bytes):
        self.data = np.frombuffer(text, np.uint8)
        self.ends = np.flatnonzero((self.data == _SPACE) | (self.data == _LINE))
        self.starts = np.concatenate([[0], self.ends[:-1] + 1])
        self.last = self.data[self.ends] == _LINE
        self.known = self._array(self.data, self.ends).dictionary_encode()
        self.ids = self.known.indices.to_numpy().astype(np.int64)
        self.size = len(self.known.dictionary)

    @staticmethod
    def _array(data: np.ndarray, ends: np.ndarray) -> pa.Array:
        """Every word with a space behind it."""
        data = data.copy()
        data[ends] = _SPACE
        offsets = np.concatenate([[0], ends + 1])
        return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])

    def numbers(self, phrases: pa.Array, n: int) -> np.ndarray:
        """The word numbers of phrases of n words that occur in the chunk."""
        text = np.frombuffer(" ".join([*phrases.to_pylist(), ""]).encode(), np.uint8)
        words = self._array(text, np.flatnonzero(text == _SPACE))
        return pc.index_in(words, value_set=self.known.dictionary).to_numpy().astype(np.int64).reshape(-1, n)

    def phrases(self, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The phrases of n words that begin at these words, a line end after each, and where each of them begins, and the end."""
        begin, length = self.starts[at], self.ends[at + n - 1] - self.starts[at] + 1
        offsets = np.concatenate([[0], np.cumsum(length)])
        data = self.data[ragged(begin, length)]
        data[offsets[1:] - 1] = _LINE
        return data, offsets


def _find(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Where each key is in the sorted known ones; -1 if it isn't."""
    if not len(known):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, at, -1)


def _phrases(words: _Words, told: pa.Table, n: int) -> tuple[np.ndarray, np.ndarray]:
    if n == 1:
        return np.unique(words.ids, return_index=True, return_counts=True)[1:]
    return occurrences(words, _told(told, n), n)


def _codes(words: _Words, lang: str, at: np.ndarray, n: int, buckets: int) -> np.ndarray:
    """The bucket and 32 bits of hash of the phrases of n words that begin at these words."""
    own = hash_array(np.array(words.known.dictionary.to_pylist() + [lang.encode()], object), categorize=False)
    code = np.full(len(at), own[-1])
    for j in range(n):
        code = mixed(code * np.uint64(BASE) + own[words.ids[at + j]])
    return ((code & np.uint64(0xFFFFFF)) * np.uint64(buckets) >> np.uint64(24) << np.uint64(32)) | (code >> np.uint64(32))


def _hashes(n: int, buckets: int):
    """Counts of a chunk's phrases of n words under their hashes, one row per bucket."""
    schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("names", pa.binary()), ("counts", pa.binary())])

    def hashes(key, chunk: pa.Table, told: pa.Table) -> pa.Table:
        number, text = chunk.column("chunk")[0].as_py(), chunk.column("words")[0].as_py()
        if not text:
            return schema.empty_table()
        words = _Words(text)
        at, counts = _phrases(words, told, n)
        codes = _codes(words, chunk.column("lang")[0].as_py(), at, n, buckets)
        order = np.argsort(codes)
        codes, counts = codes[order], counts[order]
        cuts = np.searchsorted(codes, np.arange(buckets + 1).astype(np.uint64) << np.uint64(32))
        rows = [{"bucket": int(b), "chunk": number, "names": codes[cuts[b]:cuts[b + 1]].astype("<u4").tobytes(),
                 "counts": counts[cuts[b]:cuts[b + 1]].astype("<u4").tobytes()} for b in np.flatnonzero(np.diff(cuts))]
        return pa.Table.from_pylist(rows, schema=schema)
    return hashes


def _usual(min_count: int):
    """Of one bucket: to each chunk, its hashes that count enough in all."""
    schema = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("names", pa.binary())])

    def usual(table: pa.Table) -> pa.Table:
        names = [np.frombuffer(x, "<u4") for x in table.column("names").to_pylist()]
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), "<u4").astype(np.int64)
        every = np.concatenate(names)
        order = np.argsort(every, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(every[order]) > 0]))
        known = every[order][first][np.add.reduceat(counts[order], first) >= min_count]
        bucket = table.column("bucket")[0].as_py()
        rows = [{"chunk": c, "bucket": bucket, "names": mine.tobytes()} for c, mine in (
            (c, x[_find(x, known) >= 0]) for c, x in zip(table.column("chunk").to_pylist(), names, strict=True)) if len(mine)]
        return pa.Table.from_pylist(rows, schema=schema)
    return usual


def _told(told: pa.Table, n: int) -> pa.Table:
    """The phrases of n - 1 words that a chunk was told of."""
    names = b"".join(told.filter(pc.equal(told.column("n"), n - 1)).column("names").to_pylist())
    phrases = names.decode().split("\n")[:-1]
    return pa.table({"n": np.full(len(phrases), n - 1, np.int32), "phrase": pa.array(phrases, pa.large_string())})


def _count(n: int, buckets: int):
    """Counts of the phrases of n words of a chunk, of those whose shorter parts are all among the frequent ones, one row per bucket."""
    schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("lang", pa.string()), ("names", pa.binary()), ("counts", pa.binary())])

    def count(key, chunk: pa.Table, told: pa.Table) -> pa.Table:
        number, lang = chunk.column("chunk")[0].as_py(), chunk.column("lang")[0].as_py()
        text = chunk.column("words")[0].as_py()
        if not text:
            return schema.empty_table()
        words = _Words(text)
        at, counts = _phrases(words, told, n)
        codes = _codes(words, lang, at, n, buckets)
        if n <= HASHED:
            usual = told.filter(pc.equal(told.column("n"), 0))
            known = [np.uint64(b) << np.uint64(32) | np.frombuffer(x, "<u4").astype(np.uint64) for b, x in zip(
                usual.column("bucket").to_pylist(), usual.column("names").to_pylist(), strict=True)]
            known = np.sort(np.concatenate([np.zeros(0, np.uint64), *known]))
            go = _find(codes, known) >= 0
            at, counts, codes = at[go], counts[go], codes[go]
        bucket = (codes >> np.uint64(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        data, offsets = words.phrases(at[order], n)
        counts, cuts = counts[order], np.searchsorted(bucket[order], np.arange(buckets + 1))
        rows = [{"bucket": int(b), "chunk": number, "lang": lang, "names": data[offsets[cuts[b]]:offsets[cuts[b + 1]]].tobytes(),
                 "counts": counts[cuts[b]:cuts[b + 1]].astype("<u4").tobytes()} for b in np.flatnonzero(np.diff(cuts))]
        return pa.Table.from_pylist(rows, schema=schema)
    return count


def _level(min_count: int):
    """Of one bucket: each phrase that is frequent, with its count, and to each chunk, which of its phrases these are."""
    schema = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64()), ("names", pa.binary())])

    def level(table: pa.Table) -> pa.Table:
        data = np.frombuffer(b"".join(table.column("names").to_pylist()), np.uint8)
        counts = [np.frombuffer(x, "<u4") for x in table.column("counts").to_pylist()]
        block, counts = np.repeat(np.arange(len(counts)), list(map(len, counts))), np.concatenate(counts).astype(np.int64)
        offsets = np.concatenate([[0], np.flatnonzero(data == _LINE) + 1])
        phrases = pa.Array.from_buffers(pa.large_binary(), len(counts), [
            None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()
        langs = table.column("lang").combine_chunks().dictionary_encode()
        own = phrases.indices.to_numpy().astype(np.int64) * len(langs.dictionary) + langs.indices.to_numpy()[block]
        order = np.argsort(own, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(own[order]) > 0]))
        sums = np.add.reduceat(counts[order], first)
        known, f = own[order][first][sums >= min_count], sums[sums >= min_count]
        at, which = np.divmod(known, len(langs.dictionary))
        found = pa.table({
            "chunk": pa.nulls(len(known), pa.int64()), "lang": langs.dictionary.take(pa.array(which)),
            "phrase": pa.array([x[:-1].decode() for x in phrases.dictionary.take(pa.array(at)).to_pylist()], pa.string()),
            "f": f, "names": pa.nulls(len(known), pa.binary())}, schema=schema)
        go = np.flatnonzero(_find(own, known) >= 0)
        length = np.diff(offsets)[go]
        names = data[ragged(offsets[go], length)]
        cuts = np.concatenate([[0], np.cumsum(length)])[np.searchsorted(block[go], np.arange(len(table) + 1))]
        rows = [{"chunk": c, "names": names[cuts[i]:cuts[i + 1]].tobytes()}
                for i, c in enumerate(table.column("chunk").to_pylist()) if cuts[i] < cuts[i + 1]]
        return pa.concat_tables([found, pa.Table.from_pylist(rows, schema=schema)])
    return level


def occurrences(words: _Words, frequent: pa.Table, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct phrase of n words first occurs, and how often it does."""
    total, length = len(words.ids), frequent.column("n").to_numpy()

    def listed(j):
        return words.numbers(frequent.filter(pa.array(length == j)).column("phrase"), j)

    # Phrases of n - 1 words are told; their beginnings are the only shorter ones that count.
    shorter = listed(n - 1)
    usual = np.zeros(words.size, bool)
    usual[shorter[:, 0]] = True
    at = np.flatnonzero(usual[words.ids])
    node, path = words.ids[at], shorter[:, 0]
    for j in range(2, n):
        rest = at + j - 1 < total
        rest[rest] = ~words.last[at[rest] + j - 2]
        at, node = at[rest], node[rest]
        own = path * words.size + shorter[:, j - 1]
        known = np.unique(own)
        node = _find(node * words.size + words.ids[at + j - 1], known)
        at, node = at[node >= 0], node[node >= 0]
        path = _find(own, known)
    ok = np.zeros(total + 1, bool)
    ok[at] = True
    # The first and the last n - 1 words are frequent, and the last word is in the same piece.
    rest = ok[at + 1] & (at + n - 1 < total)
    rest[rest] = ~words.last[at[rest] + n - 2]
    at, node = at[rest], node[rest]
    keys = node * words.size + words.ids[at + n - 1]
    first, counts = np.unique(keys, return_index=True, return_counts=True)[1:]
    return at[first], counts


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT,
                     chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame]:
    """lang, phrase, words (a list) and f of all phrases of up to `longest` words that occur at least `min_count` times; lang and n, its words."""
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"),
                       F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    chunks = bucketed(rows.mapInArrow(_pack(chunk_bytes), _PACKED))
    by_chunk = chunks.groupBy("chunk")
    totals = chunks.groupBy("lang").agg(F.sum("n_words").alias("n"))
    buckets = min(1 << 22, 1 + (totals.agg(F.sum("n")).first()[0] or 0) // BUCKET_WORDS)
    told = chunks.sparkSession.createDataFrame([], "chunk long, n int, bucket int, names binary")
    found = None
    for n in range(1, longest + 1):
        known = told
        if n <= HASHED:
            usual = by_chunk.cogroup(told.groupBy("chunk")).applyInArrow(_hashes(n, buckets), _HASHED).groupBy(
                "bucket").applyInArrow(_usual(min_count), _USUAL)
            known = told.unionByName(written(usual).withColumn("n", F.lit(0)))
        counts = by_chunk.cogroup(known.groupBy("chunk")).applyInArrow(_count(n, buckets), _COUNTS)
        level = written(counts.groupBy("bucket").applyInArrow(_level(min_count), _LEVEL))
        phrases = level.where("chunk IS NULL").select("lang", "phrase", "f")
        found = phrases if found is None else found.unionByName(phrases)
        told = level.where("chunk IS NOT NULL").select("chunk", F.lit(n).alias("n"), F.lit(None).cast("int").alias("bucket"), "names")
        if phrases.isEmpty():
            break
    return found.withColumn("words", F.split("phrase", " ")), totals


def _stream(batches):
    """A pass over phrases in the order of their paths: each with the counts of the shorter ones on its path, and the largest of one word more."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64()),
                        ("parts", pa.list_(pa.int64())), ("wider", pa.int64())])
    open_, done = [], []

    def close():
        entry = open_.pop()
        done.append({"lang": entry[0], "phrase": entry[2], "f": entry[3], "parts": entry[4], "wider": entry[5]})

    for batch in batches:
        for row in batch.to_pylist():
            lang, path, f = row["lang"], row["path"], row["f"]
            while open_ and not (open_[-1][0] == lang and path[:len(open_[-1][1])] == open_[-1][1]):
                close()
            parts = [row["first_f"]]
            if open_:
                parent = open_[-1]
                parts = [*parent[4], parent[3]]
                parent[5] = max(parent[5], f)
            open_.append([lang, path, row["phrase"], f, parts, 0])
        yield pa.RecordBatch.from_pylist(done, schema=schema)
        done = []
    while open_:
        close()
    yield pa.RecordBatch.from_pylist(done, schema=schema)


def _in_order(phrases: DataFrame, path) -> DataFrame:
    """The stream of phrases of two words or more, sorted by path, with the counts along it."""
    one = phrases.where(F.size("words") == 1).select("lang", F.col("phrase").alias("first"), F.col("f").alias("first_f"))
    rows = phrases.where(F.size("words") > 1).withColumn("path", path).withColumn("first", F.get("path", F.lit(0)))
    return rows.join(one.hint("merge"), ["lang", "first"]).repartitionByRange(
        "lang", "first", F.get("path", F.lit(1))).sortWithinPartitions("lang", "path").select(
        "lang", "phrase", "path", "f", "first_f").mapInArrow(_stream, _PARTS)


def collocations(docs: DataFrame, top: int | None = TOP, longest: int = LONGEST, min_count: int = MIN_COUNT,
                 chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score (exact up to 38 digits of 1000 a n); per lang the first `top` by score, a (both descending) and phrase, or all if it is None.

    Null and empty texts have no words; repeated rows count each. A lang whose
    phrases are all rare, and an empty table, give no rows. Other columns are not read.
    """
    phrases, totals = frequent_phrases(docs, longest, min_count, chunk_bytes)
    return scored(written(phrases), totals, top)


def scored(phrases: DataFrame, totals: DataFrame, top: int | None) -> DataFrame:
    """The collocations among the phrases of `frequent_phrases`, by a pass over either stream."""
    left = _in_order(phrases, F.col("words"))
    right = _in_order(phrases, F.reverse("words")).select(
        "lang", "phrase", F.col("parts").alias("rights"), F.col("wider").alias("wider_left"))
    both = left.join(right.hint("merge"), ["lang", "phrase"]).where(
        (F.col("wider") < F.col("f")) & (F.col("wider_left") < F.col("f"))).join(totals, "lang")
    # The cut after k words has the k-th left part and the (size - k)-th right part.
    cut = F.expr("""array_min(transform(sequence(1, size(parts)), k -> named_struct(
        'score', (1000BD * cast(f as decimal(20,0)) * cast(n as decimal(20,0)))
            div (cast(parts[k - 1] as decimal(19,0)) * cast(rights[size(parts) - k] as decimal(19,0))),
        'k', k, 'l', parts[k - 1], 'r', rights[size(parts) - k])))""")
    cuts = both.withColumn("cut", cut).select(
        "lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = cuts.withColumn("rank", F.row_number().over(order).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
