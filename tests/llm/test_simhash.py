import random

import xxhash
from pyspark.sql import functions as F

from gleanery.llm import simhash
from gleanery.llm.components import components


def brute_print(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
             .translate({i: " " for i in (9, 10, 11, 12, 13)}).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """{print: all prints reachable} over every pair."""
    group = {p: {p} for p in prints}
    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 3 and group[a] is not group[b]:
                group[a] |= group[b]
                for x in group[b]:
                    group[x] = group[a]
    return group


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_and_groups(spark, odd):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    texts = odd.select("doc_id", "text").collect()
    prints = {r.doc_id: brute_print(r.text) for r in texts}
    groups = brute_components(set(prints.values()))
    for r in got:
        assert r.fingerprint == f"{prints[r.doc_id]:016x}"
        ids = [i for i, p in prints.items() if p in groups[prints[r.doc_id]] and i is not None]
        assert r.component_id == (min(ids) if ids else None)


def test_near_links_against_all_pairs(spark):
    rng = random.Random(3)
    prints = set()
    for _ in range(12):  # dense and loose clusters, chains, and lone prints
        centre = rng.getrandbits(64)
        prints.add(centre)
        for _ in range(rng.choice([1, 5, 40])):
            x = centre
            for b in rng.sample(range(64), rng.randint(1, 7)):
                x ^= 1 << b
            prints.add(x)
            if rng.random() < 0.5:
                centre = x
    prints |= {0, (1 << 64) - 1, 1 << 63, 7, 1 << 63 | 3}
    frame = spark.createDataFrame([(signed(p),) for p in prints], "f long")
    links = simhash.near_links(frame)
    for u, v in links.collect():
        assert ((u ^ v) & (1 << 64) - 1).bit_count() <= 3
    roots = {r.node: r.root for r in components(links).collect()}
    groups = brute_components(prints)
    for p in prints:
        assert roots.get(signed(p), signed(p)) == min(signed(x) for x in groups[p])


def test_components_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    edges = edges.unionByName(spark.createDataFrame([(1000, 1000), (2000, 2001), (2001, 2000)], "u long, v long"))
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(301)}, 2000: 2000, 2001: 2000}


def test_empty(spark, empty):
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.keep_first(empty).collect() == []


def test_keep_first(spark, odd):
    kept = simhash.keep_first(odd).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [1, 2, 6, 7]
    assert sum(r.doc_id is None for r in kept) == 1
    assert kept[0].asDict().keys() == set(odd.columns)
