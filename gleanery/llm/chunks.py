"""Texts packed into chunks: the unit that array code works on.

A chunk is one row: the texts of some documents, joined, and where each ends. The
table is written once in the shared folder, bucketed by chunk, so that a step can
bring what it knows about a chunk to it without shuffling a text again, and a lost
executor costs a read of its chunks.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame

from gleanery.llm.common import shared_folder

#: Bytes of text after which a chunk is closed; a longer text is a chunk of its own.
CHUNK_BYTES = 8 << 20
#: Odd, so that it has an inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
#: Positions hashed at a time.
BLOCK = 1 << 17


def next_chunk():
    """Numbers that no other task gives."""
    from pyspark import TaskContext
    number = TaskContext.get().partitionId() << 32
    while True:
        yield number
        number += 1


def bucketed(df: DataFrame) -> DataFrame:
    """df as a table of the shared folder, bucketed by its column chunk.

    Spark knows buckets only of tables in its catalogue, so the table gets a name of
    its own there; the files lie in the shared folder and go with it.
    """
    spark = df.sparkSession
    name = f"chunks_{uuid.uuid4().hex}"
    df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "chunk").option(
        "path", f"{shared_folder(spark)}/{name}").option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


class Hasher:
    """64-bit hashes of all strings of one length, from sums of powers of `BASE` times a number per byte."""

    def __init__(self, seed: int = 0):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.numbers = rng.integers(0, 1 << 64, 256, dtype=np.uint64)
        n = BLOCK + 4096
        self.powers = np.full(n, BASE, np.uint64)
        self.powers[0] = 1
        np.cumprod(self.powers, out=self.powers)
        self.inverse = np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
        self.inverse[0] = 1
        np.cumprod(self.inverse, out=self.inverse)

    def at(self, data: np.ndarray, positions: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        """Hashes of data[p:p + length] for the ascending positions; lengths, one or many, are below 4096."""
        out = np.empty(len(positions), np.uint64)
        many = isinstance(length, np.ndarray)
        longest = int(length.max(initial=0)) if many else length
        sums = np.zeros(BLOCK + longest + 1, np.uint64)
        for base in range(0, len(data), BLOCK):
            a, b = np.searchsorted(positions, (base, base + BLOCK))
            if a == b:
                continue
            part = self.numbers[data[base:base + BLOCK + longest]]
            part *= self.powers[:len(part)]
            np.cumsum(part, out=sums[1:len(part) + 1])
            p = positions[a:b] - base
            h = sums[p + (length[a:b] if many else length)] - sums[p]
            h *= self.inverse[p]
            out[a:b] = mixed(h)
        return out


def mixed(h: np.ndarray) -> np.ndarray:
    """The bits of h spread over the word, in place."""
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(29)
    return h


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions starts[0], ..., starts[0] + lengths[0] - 1, starts[1], ..."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
