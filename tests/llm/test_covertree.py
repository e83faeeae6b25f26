import pickle
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.llm import covertree


def brute(rows, k, is_query):
    got = {}
    for q, qv in rows.items():
        if not is_query(q):
            continue
        found = [(-sum(a * b for a, b in zip(qv, v)), i) for i, v in rows.items() if i != q and len(v) == len(qv)]
        got[q] = [(n + 1, i, -s) for n, (s, i) in enumerate(sorted(found)[:k])]
    return {q: f for q, f in got.items() if f}


def run(spark, rows, k=20):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    out = {}
    for r in covertree.top_k(frame, F.col("vec_id") % 5 == 0, k).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def floors(v):
    return [int(np.floor(64 * float(np.float32(x)))) for x in v]


@pytest.mark.parametrize("block", [16, 5000])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(covertree, "BLOCK", block)
    monkeypatch.setattr(covertree, "QUERY_BLOCK", block)
    monkeypatch.setattr(covertree, "LEAF", 4)
    rng = random.Random(2)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = {i: [c + rng.gauss(0, 0.05) for c in rng.choice(centres)] for i in range(300)}
    rows |= {i: [0.5] * 6 for i in range(300, 380)}  # ties
    rows |= {i: [rng.random(), 1.0] for i in range(400, 420)}  # another dimension
    rows[500] = []
    got = run(spark, [(i, v, 0) for i, v in rows.items()], 7)
    assert got == brute({i: floors(v) for i, v in rows.items()}, 7, lambda i: i % 5 == 0)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (5, None, 1), (10, [nan, 1.0], 1), (15, [inf, 1.0], 1),
            (20, [None, 1.0], 1), (None, [1.0, 1.0], 1), (1, [0.5, 0.5], 1), (2, [-0.001, 0.0], 1), (3, [3e38, 0.0], 1),
            (25, [], 1)]
    got = run(spark, rows)
    assert got[0][0][:2] == (1, 3) and got[0][0][2] == 2**63 - 1
    assert got[0][1:] == [(2, 1, 64 * 32), (3, 2, -64)]
    assert set(got) == {0}


def test_empty(spark):
    assert run(spark, []) == {}


def test_tree_covers():
    rng = np.random.default_rng(1)
    vectors = np.concatenate([rng.normal(c, 0.1, (200, 4)) for c in (0, 5, 9)])
    tree = covertree.Tree(np.arange(600)[::-1].copy(), vectors)
    assert sorted(tree.ids.tolist()) == list(range(600)) and len(tree.nodes) > 3
    for centre, radius, begin, end, kids in tree.nodes:
        away = np.sqrt(((tree.vectors[begin:end] - tree.vectors[centre]) ** 2).sum(1))
        assert away.max() <= radius + 1e-9 and begin <= centre < end
        assert not kids or [tree.nodes[k][2] for k in kids] + [end] == [begin] + [tree.nodes[k][3] for k in kids]


def test_bounds_prune(monkeypatch):
    """Far clusters are never multiplied out once a near one has filled the list."""
    rng = np.random.default_rng(3)
    data = covertree.Tree(np.arange(4000), np.concatenate([
        rng.normal(0, 0.1, (2000, 3)) + 50, rng.normal(0, 0.1, (2000, 3)) - 50]))
    queries = covertree.Tree(np.arange(10_000, 10_100), rng.normal(0, 0.1, (100, 3)) + 50)
    seen = []
    products = covertree._products
    monkeypatch.setattr(covertree, "_products", lambda q, r: seen.append(len(q) * len(r)) or products(q, r))
    list(covertree.search(queries, data, np.full(100, -np.inf), 5))
    assert sum(seen) <= 100 * 2000


def tree(spark, sf, part=None):
    rows = covertree.quantised(spark.read.parquet(f"{sf}/embeddings.parquet")).collect()
    rows = [r for r in rows if part is None or r.vec_id % part == 0]
    return covertree.Tree(np.array([r.vec_id for r in rows]), np.array([r.v for r in rows]))


def test_levels_go_on_where_one_separates_nothing(spark):
    """On the test vectors half the radius separates nothing; wider levels give leaves, and pairs are pruned."""
    sf = "/root/testdata/sf0.1"
    data, queries = tree(spark, sf), tree(spark, sf, 20)
    leaves = [n for n in data.nodes if not n[4]]
    assert len(leaves) > 1 and sum(b - a for _, _, a, b, _ in leaves) == len(data.ids)
    for centre, radius, a, b, _ in data.nodes:
        away = np.sqrt(((data.vectors[a:b] - data.vectors[centre]) ** 2).sum(1))
        assert away.max() <= radius + 1e-9
    first = {}
    for i, v, s in covertree.search(queries, data, np.full(len(queries.ids), -np.inf), 20):
        first.setdefault(i, []).append(s)
    floors_ = np.array([min(first[i]) for i in range(len(queries.ids))], "f8")
    counts = {}
    again = {}
    for i, v, s in covertree.search(queries, data, floors_, 20, counts):
        again.setdefault(i, []).append(s)
    assert again == first
    assert counts["pruned"] > 0 and counts["rows"] < len(queries.ids) * len(data.ids)


def test_far_blocks_do_not_meet(spark, monkeypatch):
    """Two clusters of opposite sign: pairs of blocks of different clusters are dropped by their roots."""
    rng = random.Random(4)
    rows = [(i, [(1 if i % 2 else -1) * (3 + rng.random() / 10), rng.random() / 10], 0) for i in range(400)]
    met = []
    real = covertree._searched
    monkeypatch.setattr(covertree, "_searched", lambda pairs, k: met.append(pairs.count()) or real(pairs, k))
    monkeypatch.setattr(covertree, "PIVOTS", 8)
    got = run(spark, rows, 7)
    assert met[0] == 8 and met[1] < 8 * 7 - 7  # at least one cell's pairs with the other cluster are gone
    assert got == brute({i: floors(v) for i, v, _ in rows}, 7, lambda i: i % 5 == 0)


def test_leaves_that_stay_are_multiplied_together(monkeypatch):
    """Where bounds drop next to nothing, a query leaf meets its data leaves in a few products, and trees stay small."""
    rng = np.random.default_rng(5)
    vectors = rng.normal(0, 1, (2200, 64))
    vectors = np.floor(64 * vectors / np.sqrt((vectors**2).sum(1))[:, None])
    data, queries = covertree.Tree(np.arange(2000), vectors[:2000]), covertree.Tree(np.arange(2000, 2200), vectors[2000:])
    scores = vectors[2000:] @ vectors[:2000].T
    floor = np.sort(scores, axis=1)[:, -20][queries.ids - 2000]
    seen, products = [], covertree._products
    monkeypatch.setattr(covertree, "_products", lambda q, r: seen.append(len(r)) or products(q, r))
    got = {}
    for i, v, s in covertree.search(queries, data, floor, 20):
        got.setdefault(int(queries.ids[i]), []).append((v, s))
    assert got == {q + 2000: [(v, int(-s)) for s, v in sorted(zip(-scores[q], range(2000)))[:20]] for q in range(200)}
    leaves = [sum(not n[4] for n in t.nodes) for t in (queries, data)]
    assert min(leaves) > 4 and len(seen) < leaves[0] * leaves[1] / 4
    again = pickle.loads(pickle.dumps(data, protocol=5))
    assert (again.vectors == data.vectors).all() and len(pickle.dumps(data, protocol=5)) < data.vectors.nbytes / 4
