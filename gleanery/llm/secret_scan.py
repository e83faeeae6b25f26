"""Secret scans with multipart credential linking.

Spans of the kinds assign, access and hex are reported wherever they match. Weak
kinds (`key`: a bare 40-character token of mixed letters and digits, `endpoint`: a service address, `user`:
an assigned account name) mean nothing alone. They are candidates, and an
interval join within their scope decides: a candidate is reported only if a
complementary part lies within `REACH` code points of it in the same text.

    key       needs an access identifier, an endpoint or a user
    endpoint  needs an access identifier, a key or an assigned secret
    user      needs an assigned secret or a key

Places are code points, ends exclusive.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.common import checkpointed

REACH = 400
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "key", "endpoint", "user")
COMPLEMENTS = {"key": ("access", "endpoint", "user"), "endpoint": ("access", "key", "assign"),
               "user": ("assign", "key")}

# Letters of the names in either case, as ASCII letters only.
_ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                     r"([A-Za-z0-9+/_.=-]+)")
# A run that is too short fails whole, and no later start in it is longer.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_KEY = re.compile(r"(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])")
_UPPER, _LOWER, _DIGIT = map(re.compile, ("[A-Z]", "[a-z]", "[0-9]"))
_ENDPOINT = re.compile(r"\b(?:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s\"'<>|]+", re.A)
_USER = re.compile(r"\b(?ai:user(?:name)?|login|account|client_?id)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9_.@-]{3,}")

_SPANS = "array<struct<kind:string,start:int,end:int>>"


def spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans and weak candidates of a text, leftmost and non-overlapping per kind.

    Substring tests that every match must pass spare most texts the slower patterns.
    """
    found, low = [], text.lower()
    sets = ":" in text or "=" in text
    if sets and any(w in low for w in ("passw", "secret", "token", "api")):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    found += [("key", *m.span()) for m in _KEY.finditer(text)
              if _UPPER.search(m[0]) and _LOWER.search(m[0]) and _DIGIT.search(m[0])]
    if "://" in text:
        found += [("endpoint", *m.span()) for m in _ENDPOINT.finditer(text)]
    if sets and any(w in low for w in ("user", "login", "account", "client")):
        found += [("user", *m.span()) for m in _USER.finditer(text)]
    return found


def _scan(text: Column) -> Column:
    @F.pandas_udf(_SPANS)
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in spans(t or "")]
                          for t in texts], dtype=object)

    return found(text)


def _linked(weak: DataFrame, reach: int) -> DataFrame:
    """The spans (key, kind, start, end) of weak kinds that have a complement within reach.

    The join of intervals needs no pairs: within a text, ordered by start, the
    largest end so far of a kind and the next start of a kind tell whether any
    interval of that kind is near.
    """
    order = Window.partitionBy("key").orderBy("start", "end", "kind")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(1, Window.unboundedFollowing)
    needed = sorted({c for cs in COMPLEMENTS.values() for c in cs})
    seen = weak.select(
        "*",
        *[F.max(F.when(F.col("kind") == c, F.col("end"))).over(before).alias(f"end_{c}") for c in needed],
        *[F.min(F.when(F.col("kind") == c, F.col("start"))).over(after).alias(f"start_{c}") for c in needed])

    def near(kind: str) -> Column:
        return (F.coalesce(F.col("start") - F.col(f"end_{kind}") <= reach, F.lit(False))
                | F.coalesce(F.col(f"start_{kind}") - F.col("end") <= reach, F.lit(False)))

    wanted = F.lit(False)
    for kind, parts in COMPLEMENTS.items():
        some = F.lit(False)
        for part in parts:
            some = some | near(part)
        wanted = wanted | ((F.col("kind") == kind) & some)
    return seen.where(wanted).select("key", "kind", "start", "end")


def _joined(found: Column) -> Column:
    place = F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("k"),
        s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_join(F.transform(F.array_sort(place), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, found (base spans and linked ones) and weak (number of candidates not linked).

    docs has doc_id and text; a null text counts as empty. Texts are told apart
    by (doc_id, hash), so repeated rows share their result and equal ids with
    different texts do not; other columns are not read; an empty table gives an
    empty one.
    """
    scanned = checkpointed(docs.select(
        "doc_id", F.struct(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("i"),
                           F.sha2(F.coalesce("text", F.lit("")), 256).alias("t")).alias("key"),
        _scan(F.col("text")).alias("spans")))
    is_weak = lambda s: ~s["kind"].isin(*BASE)
    parts = scanned.where(F.exists("spans", is_weak) & (F.size("spans") > 1)).dropDuplicates(["key"])
    linked = _linked(parts.select("key", F.inline("spans")), reach).groupBy("key").agg(
        F.collect_list(F.struct("kind", "start", "end")).alias("linked"))
    strong = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    more = F.coalesce("linked", F.array().cast(_SPANS))
    # Only texts with candidates meet the links; the others need no shuffle.
    candidates = F.exists("spans", is_weak) & (F.size("spans") > 1)
    with_links = scanned.where(candidates).join(linked, "key", "left").select(
        "doc_id", F.concat(strong, more).alias("found"),
        (F.size("spans") - F.size(strong) - F.size(more)).alias("weak"))
    plain = scanned.where(~candidates).select(
        "doc_id", strong.alias("found"), (F.size("spans") - F.size(strong)).alias("weak"))
    return with_links.unionByName(plain)


def report(docs: DataFrame) -> DataFrame:
    found = scan(docs)
    strong = F.filter("found", lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(_joined(strong).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"))
