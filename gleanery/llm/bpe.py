"""Byte-level BPE over overlapping chunks.

A text longer than `chunk` code points is cut into chunks that run `overlap`
code points into the next one. Chunks are pre-tokenised independently, as rows
spread over the cluster. The scan of a chunk starts in the middle of a
pre-token, but two scans that share one boundary share all later ones, because
the pattern never looks behind: the first boundary in the overlap that both
neighbours found is therefore a boundary of the whole text. Texts are cut there
and the pieces encoded independently. Only boundaries that follow a character
other than white space count: a run of white space is split by what follows it. A text in which some overlap holds no
common boundary (one pre-token longer than the overlap) is encoded as one piece.
"""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.common import model_bytes

CHUNK, OVERLAP = 65536, 4096
#: Boundaries this close to a chunk's end may depend on what follows it.
GUARD = 8

_ENCODINGS: dict = {}


def _encoding(ranks: bytes, pattern: str):
    import tiktoken

    key = (zlib.crc32(ranks), len(ranks), pattern)
    if key not in _ENCODINGS:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        _ENCODINGS[key] = tiktoken.Encoding(
            "own", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
    return _ENCODINGS[key]


class ByteBpe:
    """Encoder and decoder columns for one ranks file and pre-token pattern."""

    def __init__(self, spark, ranks_path: str, pattern: str, chunk: int = CHUNK,
                 overlap: int = OVERLAP):
        if not GUARD < overlap < chunk:
            raise ValueError("overlap must lie between the guard and the chunk size")
        self.chunk, self.overlap, self.pattern = chunk, overlap, pattern
        self.ranks = spark.sparkContext.broadcast(model_bytes(ranks_path))

    def coded_column(self, text: Column, decoded: bool = False) -> Column:
        """A piece's ids as little-endian unsigned 32-bit integers, and what they decode to if asked."""
        ranks, pattern = self.ranks, self.pattern

        @F.pandas_udf("ids binary, decoded binary")
        def code(texts: pd.Series) -> pd.DataFrame:
            encoding, rows = _encoding(ranks.value, pattern), []
            for text in texts:
                ids = encoding.encode_ordinary(text)
                rows.append((np.asarray(ids, "<u4").tobytes(),
                             encoding.decode_bytes(ids) if decoded else None))
            return pd.DataFrame(rows, columns=["ids", "decoded"])

        return code(text)

    def decode_column(self, ids: Column) -> Column:
        """Concatenated raw bytes of the ids."""
        ranks, pattern = self.ranks, self.pattern

        @F.pandas_udf("binary")
        def decode(rows: pd.Series) -> pd.Series:
            encoding = _encoding(ranks.value, pattern)
            return pd.Series([encoding.decode_bytes(np.frombuffer(r, "<u4").tolist())
                              for r in rows], dtype=object)

        return decode(ids)

    def _boundaries(self, text: Column, start: Column, last: Column) -> Column:
        """Boundaries that the scan of a chunk found in its two overlaps, as offsets in the text."""
        chunk, overlap = self.chunk, self.overlap
        # The encoder's \s is Unicode white space; that of Python also has U+001C to U+001F.
        pattern = self.pattern.replace(r"\s", r"\p{White_Space}").replace(
            r"\S", r"\P{White_Space}")

        @F.pandas_udf("heads array<int>, tails array<int>")
        def scan(texts: pd.Series, starts: pd.Series, lasts: pd.Series) -> pd.DataFrame:
            import regex

            matcher, heads, tails = regex.compile(pattern), [], []
            for text, start, last in zip(texts, starts, lasts):
                ends = np.fromiter((m.end() for m in matcher.finditer(text)), "i4")
                ends = np.concatenate([np.zeros(1, "i4"), ends])
                if not last:
                    ends = ends[ends <= len(text) - GUARD]
                ends = ends[[e == 0 or not text[e - 1].isspace() for e in ends.tolist()]]
                heads.append((ends[ends < overlap] + start).tolist())
                tails.append((ends[ends >= chunk] + start).tolist())
            return pd.DataFrame({"heads": heads, "tails": tails})

        return scan(text, start, last)

    def _long(self, texts: DataFrame, decoded: bool) -> DataFrame:
        """(key, coded) of each distinct long text; texts has key and text."""
        size = F.char_length("text")
        chunks = (
            texts.select("key", "text", F.explode(F.sequence(
                F.lit(0), F.floor((size - 1) / self.chunk).cast("int"))).alias("i"))
            .select("key", "i",
                    F.substring(F.col("text"), F.col("i") * self.chunk + 1,
                                F.lit(self.chunk + self.overlap)).alias("part"),
                    (F.char_length("text") <= (F.col("i") + 1) * self.chunk).alias("last"))
            # Copies of a text are encoded once; chunks of one text go to different tasks.
            .dropDuplicates(["key", "i"])
        )
        scanned = chunks.select(
            "key", "i", "last",
            self._boundaries(F.col("part"), F.col("i") * self.chunk, F.col("last")).alias("ends"))
        order = Window.partitionBy("key").orderBy("i")
        cut = F.array_min(F.array_intersect(F.lag("ends.tails").over(order), F.col("ends.heads")))
        cuts = (
            scanned.withColumn("begin", F.when(F.col("i") == 0, 0).otherwise(cut))
            .withColumn("end", F.when(F.col("last"), F.lit(2**31 - 1))
                        .otherwise(F.lead("begin").over(order)))
            .select("key", "i", "begin", "end",
                    F.min(F.col("begin").isNotNull()).over(Window.partitionBy("key")).alias("synced"))
        )
        start = F.col("i") * self.chunk
        pieces = chunks.join(cuts.where("synced"), ["key", "i"]).select(
            "key", "i",
            self.coded_column(F.substring(
                F.col("part"), F.col("begin") - start + 1, F.col("end") - F.col("begin")),
                decoded).alias("c"))

        def glued(part: str) -> Column:  # by way of hex, as Spark joins arrays of strings only
            return F.unhex(F.array_join(F.transform("p", lambda p: F.hex(p["c"][part])), ""))

        joined = pieces.groupBy("key").agg(
            F.sort_array(F.collect_list(F.struct("i", "c"))).alias("p")).select(
            "key", F.struct(glued("ids").alias("ids"), glued("decoded").alias("decoded")).alias("coded"))
        whole = (
            texts.join(cuts.where("not synced").select("key").distinct(), "key", "left_semi")
            .dropDuplicates(["key"]).select("key", self.coded_column(F.col("text"), decoded).alias("coded"))
        )
        return joined.unionByName(whole)

    def encode(self, docs: DataFrame, text: str = "text", ids: str = "ids",
               decoded: str | None = None) -> DataFrame:
        """docs with a binary column `ids`, and one of the decoded bytes if named.

        A null text counts as empty. Equal texts get equal results; an empty
        table gives an empty one. Input columns called like a result are
        replaced, all others stay.
        """
        out = [ids] + ([decoded] if decoded else [])
        keep = [c for c in docs.columns if c not in out]
        rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
                           F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
        is_long = F.char_length("text") > self.chunk
        short = rows.where(~is_long).select(
            "row", self.coded_column(F.col("text"), bool(decoded)).alias("coded"))
        long = rows.where(is_long).withColumn("key", F.unhex(F.sha2(F.col("text"), 256)))
        done = long.select("row", "key").join(
            self._long(long.select("key", "text"), bool(decoded)), "key").select("row", "coded")
        return short.unionByName(done).select("row.*", *[
            F.col("coded")[part].alias(name) for part, name in zip(("ids", "decoded"), out)])

    def decode(self, encoded: DataFrame, ids: str = "ids", out: str = "decoded") -> DataFrame:
        """encoded with a binary column of the decoded bytes; null ids give no bytes."""
        return encoded.withColumn(
            out, self.decode_column(F.coalesce(F.col(f"`{ids}`"), F.lit(b""))))


def digest(coded: DataFrame, *more: str) -> DataFrame:
    """doc_id, n_tokens and hashes of ids and decoded bytes, with more columns of coded if named."""
    return coded.select(
        "doc_id", *more, F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
