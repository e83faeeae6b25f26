"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits; texts are linked at `radius` (3) or fewer differing
bits. All work is on distinct fingerprints, so copies cost nothing.

1. Links at distance 1 and 2: every fingerprint names the 65 patterns of its
   ball of radius 1; two fingerprints share a pattern exactly if they differ in
   at most two bits. At most 65 fingerprints name one pattern, so a dense group
   costs no more than its size, and each is linked to the smallest of its pattern.
2. Links at distance 3: one of the two 32-bit segments differs in at most one
   bit. Probes enumerate that ball within each segment and fetch the table
   entries of the same segment; the complete distance is verified. Probes whose
   entries all belong to the probe's own component of step 1 are dropped first,
   so that a dense group is not compared with itself. Of two segments that
   differ in one bit, the one with the bit set probes.

The components over both kinds of links are exact: nothing is capped.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.common import checkpointed
from gleanery.llm.components import components

SEED = 42


def _fingerprint(data: bytes, shingle: int, digest) -> int:
    words = data.lower().split()  # bytes: A-Z only, and exactly the six space characters
    if not words:
        return 0
    text = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    hashes = np.array([digest(text[a:b], SEED) for a, b in zip(starts.tolist(), (ends - 1).tolist())],
                      dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 65536):  # 4 MB of bits at a time
        part = hashes[i:i + 65536]
        counts += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1,
                                bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """64-bit SimHash (signed long) of the word shingles of a text; 0 if it has no word."""

    @F.pandas_udf("long")
    def compute(texts: pd.Series) -> pd.Series:
        from xxhash import xxh64_intdigest

        return pd.Series([_fingerprint((t or "").encode(), shingle, xxh64_intdigest) for t in texts],
                         dtype="int64")

    return compute(text)


def _ball(value: Column, bits: int) -> Column:
    """value and every value that differs from it in one of the lowest `bits` bits."""
    flips = F.array(F.lit(0).cast("long"),
                    *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(bits)])
    return F.transform(flips, lambda m: value.bitwiseXOR(m))


def near_links(prints: DataFrame) -> DataFrame:
    """Links (u, v) that connect distinct fingerprints as all pairs within 3 bits do."""
    named = prints.select("f", F.explode(_ball(F.col("f"), 64)).alias("pattern"))
    close = (
        named.withColumn("v", F.min("f").over(Window.partitionBy("pattern")))
        .where("f <> v").select(F.col("f").alias("u"), "v").distinct()
    )
    close = checkpointed(close)
    roots = components(close)
    known = checkpointed(
        prints.join(roots, prints["f"] == roots["node"], "left")
        .select("f", F.coalesce("root", "f").alias("c")))

    high = F.shiftrightunsigned("f", 32)
    low = F.col("f").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    entries = known.select("f", "c", F.explode(F.array(
        F.struct(F.lit(0).alias("t"), high.alias("s")),
        F.struct(F.lit(1).alias("t"), low.alias("s")))).alias("e")).select("f", "c", "e.*")
    # The segment itself, and the segment with one of its set bits cleared.
    masks = F.array(*[F.lit(1 << i).cast("long") for i in range(32)])
    cleared = F.transform(
        F.filter(masks, lambda m: F.col("s").bitwiseAND(m) != 0), lambda m: F.col("s") - m)
    probes = entries.select("t", F.explode(F.concat(F.array("s"), cleared)).alias("s"),
                            F.col("f").alias("pf"), F.col("c").alias("pc"))
    stock = entries.groupBy("t", "s").agg(F.min("c").alias("first_c"), F.max("c").alias("last_c"))
    useful = probes.join(stock, ["t", "s"]).where("first_c <> pc or last_c <> pc")
    far = useful.join(entries, ["t", "s"]).where(
        (F.col("c") != F.col("pc"))
        & (F.bit_count(F.col("f").bitwiseXOR(F.col("pf"))) <= 3)
    ).select(F.col("pf").alias("u"), F.col("f").alias("v"))
    return close.unionByName(far)


def near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of docs (doc_id, text).

    Texts without a word have fingerprint zero and are linked like any other.
    component_id is the smallest doc_id reachable over links, null ids ignored
    (null if there is no other). Repeated rows get equal results; other columns
    are not read; an empty table gives an empty one.
    """
    hashed = checkpointed(docs.select("doc_id", fingerprint(F.col("text"), shingle).alias("f")))
    classes = checkpointed(hashed.groupBy("f").agg(F.min("doc_id").alias("first_id")))
    prints = classes.select("f")
    roots = components(near_links(prints))
    rooted = classes.join(roots, classes["f"] == roots["node"], "left").select(
        "f", "first_id", F.coalesce("root", "f").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(ids, "root").select("f", "component_id")
    return hashed.join(named, "f").select(
        "doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """docs with one document of each group of near-duplicates: the smallest doc_id.

    doc_id names a document: rows that repeat it with the same text become one,
    rows of one id with different texts stay or go together. Rows without a
    doc_id stay, as they cannot be told apart.
    """
    groups = near_duplicates(docs.select("doc_id", "text"), shingle)
    kept = groups.where("doc_id = component_id").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return named.unionByName(docs.where("doc_id is null"))
