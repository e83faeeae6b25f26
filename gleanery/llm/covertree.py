"""Exact top-k by inner product with dual cover-tree search.

Data and queries are dealt into cells by their nearest pivot, cells into blocks
of bounded size by a hash of the id, and a cover tree is built per block, inside
a task. A pair of trees is searched from the roots: of two nodes with centres q
and r and covering radii a and b no product exceeds

    <q, r> + a |r| + b |q| + a b

and the pair is pruned if that is below the worst k-th score of the query node's
group. Round one searches each query block in the data blocks of its own cell and
gives every query a first k-th score; round two searches the other blocks with
these as bounds, so that few rows come back. A cell that holds a third of all
rows becomes as many blocks as it needs.

Blocks of round two meet by their roots first: a pair whose bound is below the worst
k-th score of the query block is dropped before its trees are moved. In the worst case
every query block meets every data block, which is the work of an exact search.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.common import checkpointed

#: Bound of the sample of rows that are pivots; rows per data and query block.
PIVOTS, BLOCK, QUERY_BLOCK = 32, 4096, 1024
LEAF = 32
#: Parts of the second round for each core.
TASKS = 8
TOP = 20
#: Shares of a node's scale that its children may have, the first that separates its rows counts.
SCALES = (0.5, 0.7, 0.8, 0.9, 0.95)
#: Whole numbers below these are exact as doubles and as single floats.
EXACT, EXACT_SINGLE = 2.0**53, 2.0**24
#: Rows of a first product where no k-th score is known, and where one is; products held at once.
FIRST_ROWS, KNOWN_ROWS, HELD = 512, 4096, 1 << 18


class Tree:
    """A cover tree over the rows of an array, as nodes over ranges of a permutation."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.nodes: list[tuple[int, float, int, int, list[int]]] = []  # centre, radius, begin, end, children
        self.order = np.empty(len(ids), "i8")
        self.filled = 0
        everything = np.arange(len(ids))
        away = self._away(0, everything)
        self._add(0, everything, away, float(away.max(initial=0.0)))
        # Rows in tree order, so that a node is a slice; centres are renumbered with them.
        place = np.empty_like(self.order)
        place[self.order] = np.arange(len(ids))
        self.ids, self.vectors = self.ids[self.order], self.vectors[self.order]
        self.nodes = [(int(place[c]), r, a, b, kids) for c, r, a, b, kids in self.nodes]
        self._index()

    def _index(self) -> None:
        """Nodes as arrays, for bounds of many pairs at once, and the vectors as single floats."""
        self.norms = np.sqrt((self.vectors**2).sum(1))
        self.largest = float(np.abs(self.vectors).max(initial=0.0))
        self.centre, self.radius, self.begin, self.end = (
            np.array([n[i] for n in self.nodes], t) for i, t in ((0, "i8"), (1, "f8"), (2, "i8"), (3, "i8")))
        self.n_kids = np.array([len(n[4]) for n in self.nodes], "i8")
        self.kid_at = np.cumsum(self.n_kids) - self.n_kids
        self.kids = np.array([x for n in self.nodes for x in n[4]], "i8")
        self.centres = self.vectors[self.centre]
        if self.largest < EXACT_SINGLE:
            self.single = self.vectors.astype("f4")

    def __getstate__(self):
        """Ids, nodes, and the vectors in the smallest integers that hold them."""
        vectors = self.vectors
        if np.array_equal(vectors, np.floor(vectors)):
            for kind in ("i1", "i2", "i4"):
                if self.largest <= np.iinfo(kind).max:
                    vectors = vectors.astype(kind)
                    break
        return {"ids": self.ids, "vectors": vectors, "nodes": self.nodes}

    def __setstate__(self, state):
        self.ids, self.nodes = state["ids"], state["nodes"]
        self.vectors = state["vectors"].astype("f8")
        self._index()

    def _away(self, centre: int, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(((self.vectors[rows] - self.vectors[centre]) ** 2).sum(1))

    def _add(self, centre: int, rows: np.ndarray, away: np.ndarray, scale: float) -> int:
        """Add the node of rows, whose distances from the centre are known; return its number."""
        me = len(self.nodes)
        self.nodes.append((centre, float(away.max(initial=0.0)), self.filled, 0, []))
        kids = []
        groups = []
        if len(rows) > LEAF and scale > 0:
            # Where half the scale would take too many centres, as with many components, wider ones may do.
            for share in SCALES:
                groups = self._cover(centre, rows, away, scale * share)
                if groups:
                    break
        if groups:
            for c, own, d in groups:
                kids.append(self._add(c, own, d, min(scale * share, float(d.max(initial=0.0)))))
        else:
            self.order[self.filled:self.filled + len(rows)] = rows
            self.filled += len(rows)
        c, radius, begin, _, _ = self.nodes[me]
        self.nodes[me] = (c, radius, begin, self.filled, kids)
        return me

    def _cover(self, centre, rows, away, scale):
        """Centres more than scale apart that cover rows within scale, each with its rows.

        None if that takes so many centres that a node would hold few rows each, or
        only one: if no scale does, the node stays a leaf, one product of matrices.
        """
        groups = []
        near = away <= scale
        groups.append((centre, rows[near], away[near]))
        rows = rows[~near]
        most = (len(near)) // 8
        while len(rows):
            if len(groups) > most:
                return []
            c = int(rows[0])
            d = self._away(c, rows)
            near = d <= scale
            groups.append((c, rows[near], d[near]))
            rows = rows[~near]
        return groups if len(groups) > 1 else []


def _products(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Exact integer inner products of integer-valued floats; single ones are known to be small enough."""
    if q.dtype == "f4" or q.shape[1] * np.abs(q).max(initial=0) * np.abs(r).max(initial=0) < EXACT:
        return q @ r.T
    exact = q.astype(object) @ r.astype(object).T  # a component can be as large as a float
    limits = np.iinfo("i8")
    return np.array([[min(max(int(x), limits.min), limits.max) for x in row] for row in exact],
                    "i8").reshape(len(q), len(r))


def _limits(queries: Tree, data: Tree) -> np.ndarray:
    """For every pair of nodes a product that none of their rows' exceeds."""
    top = queries.centres @ data.centres.T
    top += queries.radius[:, None] * data.norms[data.centre]
    top += queries.norms[queries.centre][:, None] * data.radius
    top += queries.radius[:, None] * data.radius
    return top + 1e-9 * np.abs(top) + 1e-6


def _opened(tree: Tree, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in nodes, child) of every child of nodes."""
    n = tree.n_kids[nodes]
    at = np.repeat(np.arange(len(nodes)), n)
    return at, tree.kids[np.repeat(tree.kid_at[nodes] - (np.cumsum(n) - n), n) + np.arange(len(at))]


def _first_k(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int):
    """The k best of each row, in order, and where each k-th stands."""
    order = np.lexsort((ids, -scores, rows))
    rows, ids, scores = rows[order], ids[order], scores[order]
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
    few = rank < k
    return rows[few], ids[few], scores[few], np.flatnonzero(rank[few] == k - 1)


def best_hits(queries: Tree, data: Tree, floor: np.ndarray, k: int, counts: dict | None = None):
    """Arrays of query row, data id and score: each query's best k in data that reach its floor.

    floor: per query row a score that k others are known to reach, or -inf.
    counts: adds up pairs of nodes `visited` and `pruned`, and pairs of `rows` compared.

    The trees are descended together, level by level, and pairs of nodes below the floors are
    dropped. Each query leaf then meets the data leaves that are left, the most promising
    first and more with every step; between steps the k-th scores so far drop others.
    """
    counts = {} if counts is None else counts

    def count(what, n):
        counts[what] = counts.get(what, 0) + int(n)

    none = np.empty(0, "i8")
    if not len(queries.ids) or not len(data.ids):
        return none, none, none
    bound = floor.astype("f8").copy()
    limits = _limits(queries, data)
    ends = np.stack([queries.begin, queries.end], 1).ravel()
    worst = np.minimum.reduceat(np.append(bound, np.inf), ends)[::2]
    a, b, leaves = np.zeros(1, "i8"), np.zeros(1, "i8"), []
    while len(a):
        count("visited", len(a))
        kept = limits[a, b] >= worst[a]
        count("pruned", len(a) - kept.sum())
        a, b = a[kept], b[kept]
        q_kids, d_kids = queries.n_kids[a] > 0, data.n_kids[b] > 0
        done = ~q_kids & ~d_kids
        leaves.append((a[done], b[done]))
        split = d_kids & ((data.radius[b] >= queries.radius[a]) | ~q_kids)
        other = ~split & ~done
        at, below = _opened(data, b[split])
        q_at, q_below = _opened(queries, a[other])
        a, b = np.append(a[split][at], q_below), np.append(below, b[other][q_at])
    a, b = (np.concatenate(x) for x in zip(*leaves))
    order = np.lexsort((-limits[a, b], a))
    a, b = a[order], b[order]

    single = len(data.vectors[0]) * queries.largest * data.largest < EXACT_SINGLE and max(
        queries.largest, data.largest) < EXACT_SINGLE
    q_vectors, d_vectors = (queries.single, data.single) if single else (queries.vectors, data.vectors)
    found = [(none, none, none)]  # of leaves that are done and of the one at hand, cut to k a row now and then
    held = 0

    def cut():
        nonlocal found, held
        rows, ids, scores, last = _first_k(*(np.concatenate(x) for x in zip(*found)), k)
        bound[rows[last]] = np.maximum(bound[rows[last]], scores[last])
        found, held = [(rows, ids, scores)], 0

    def compare(first, end, begin, stop):
        nonlocal held
        step = max(1, HELD // (stop - begin))
        for x in range(first, end, step):
            y = min(end, x + step)
            scores = _products(q_vectors[x:y], d_vectors[begin:stop])
            level = bound[x:y, None].astype("f4") if single else bound[x:y, None]
            hit = np.flatnonzero(scores >= level)
            if len(hit):
                row, column = np.divmod(hit, stop - begin)
                row += x
                ids = data.ids[begin:stop][column]
                other = ids != queries.ids[row]
                found.append((row[other], ids[other], scores.ravel()[hit[other]].astype("i8")))
                held += len(hit)
                if held > HELD:
                    cut()

    cuts = np.flatnonzero(np.diff(a)) + 1
    for mine, met in zip(np.split(a, cuts), np.split(b, cuts)):
        if not len(mine):
            continue
        first, end = int(queries.begin[mine[0]]), int(queries.end[mine[0]])
        sizes = data.end[met] - data.begin[met]
        room, known = KNOWN_ROWS, bound[first:end].min() > -np.inf
        if not known:
            room = FIRST_ROWS
        while len(met):
            n = max(1, int(np.searchsorted(np.cumsum(sizes), room, "right")))
            # Leaves that follow one another in tree order are one product.
            runs = np.sort(met[:n])
            begins, stops = np.sort(data.begin[runs]), np.sort(data.end[runs])
            gap = np.flatnonzero(begins[1:] != stops[:-1])
            for begin, stop in zip(begins[np.append(0, gap + 1)].tolist(), stops[np.append(gap, len(stops) - 1)].tolist()):
                count("rows", (end - first) * (stop - begin))
                compare(first, end, begin, stop)
            met, sizes, room = met[n:], sizes[n:], room * 4
            if len(met):
                cut()
                likely = limits[mine[0], met] >= bound[first:end].min()
                count("pruned", len(met) - likely.sum())
                met, sizes = met[likely], sizes[likely]
    cut()
    return found[0]


def search(queries: Tree, data: Tree, floor: np.ndarray, k: int, counts: dict | None = None):
    """(query row, data id, score) of `best_hits`, one by one."""
    yield from zip(*(x.tolist() for x in best_hits(queries, data, floor, k, counts)))


def _floor(x):
    """floor as a double: from 2^52 on every double is whole, and a cast to long could overflow."""
    return F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)


def quantised(vectors: DataFrame, levels: float = 64.0) -> DataFrame:
    """vec_id and v = floor(levels * component), of rows whose components are all finite.

    A vec_id has one vector: the smallest of its rows'.
    """
    finite = F.forall("embedding", lambda x: F.coalesce(
        F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return vectors.where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: _floor(x.cast("double") * levels)).alias("v")
    ).groupBy("vec_id").agg(F.min("v").alias("v"))


def _celled(rows: DataFrame) -> DataFrame:
    """rows (vec_id, v) with dim and cell: the number of the nearest pivot of that dimension.

    Pivots are the PIVOTS rows of the smallest hashes, a sample of bounded size;
    they only decide which rows share a tree, not what is found.
    """
    spark = rows.sparkSession
    some = rows.orderBy(F.xxhash64(F.lit(11), "vec_id"), "vec_id").limit(PIVOTS).select("v").collect()
    pivots: dict[int, list] = {}
    for r in some:
        pivots.setdefault(len(r.v), []).append(r.v)
    shared = spark.sparkContext.broadcast({d: np.array(p, "f8").reshape(len(p), d) for d, p in pivots.items()})

    @F.pandas_udf("int")
    def cell(vectors: pd.Series) -> pd.Series:
        out = np.zeros(len(vectors), "i4")
        sizes = vectors.map(len).to_numpy()
        for d in set(sizes.tolist()) & set(shared.value):
            at = np.flatnonzero(sizes == d)
            p = shared.value[d]
            if d:
                own = np.stack(vectors.iloc[at].to_list())
                out[at] = np.argmin((p**2).sum(1) - 2 * own @ p.T, axis=1)
        return pd.Series(out)

    return rows.select("vec_id", "v", F.size("v").alias("dim"), cell("v").alias("cell"))


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """dim, cell, block and tree of blocks of about `size` rows; a large cell gives many."""
    parts = rows.groupBy("dim", "cell").agg(F.ceil(F.count("*") / size).cast("int").alias("parts"))
    dealt = rows.join(parts, ["dim", "cell"]).withColumn(
        "part", F.pmod(F.xxhash64(F.lit(23), "vec_id"), F.col("parts")).cast("int"))

    def build(key, frame: pd.DataFrame) -> pd.DataFrame:
        dim, cell, part = key
        vectors = np.stack(frame["v"].to_list()).astype("f8").reshape(len(frame), dim)
        tree = Tree(frame["vec_id"].to_numpy("i8"), vectors)
        centre, radius = tree.nodes[0][:2]
        return pd.DataFrame({"dim": [dim], "cell": [cell], "part": [part], "centre": [tree.vectors[centre].tolist()],
                             "radius": [radius], "tree": [pickle.dumps(tree, protocol=5)]})

    return dealt.groupBy("dim", "cell", "part").applyInPandas(
        build, "dim int, cell int, part int, centre array<double>, radius double, tree binary")


def _limit(q, a, r, b):
    """No product of vectors within a of q and within b of r exceeds this; rounding is allowed for."""
    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda i, j: i * j), F.lit(0.0), lambda t, z: t + z)

    top = dot(q, r) + a * F.sqrt(dot(r, r)) + b * F.sqrt(dot(q, q)) + a * b
    return top + F.abs(top) * 1e-9 + 1e-6


_HITS = "dim int, q_cell int, q_part int, query_id long, vec_id long, score long"


def _searched(pairs: DataFrame, k: int) -> DataFrame:
    """Hits of pairs (q_cell, q_part, q_tree, floors, cell, part, tree); one pair of blocks at a time.

    Pairs are searched where their join has brought them: no tree moves again.
    """
    def run(batches):
        at, data = None, None
        for batch in batches:
            columns = {name: batch.column(name) for name in batch.schema.names}
            out, n = [], 0
            for i in range(batch.num_rows):
                dim, q_cell, q_part, cell, part = (
                    columns[c][i].as_py() for c in ("dim", "q_cell", "q_part", "cell", "part"))
                if at != (dim, cell, part):
                    at, data = (dim, cell, part), pickle.loads(columns["tree"][i].as_py())
                queries = pickle.loads(columns["q_tree"][i].as_py())
                floor = np.full(len(queries.ids), -np.inf)
                if columns["floors"][i].is_valid:
                    known = columns["floors"][i].values
                    ids, least = (known.field(c).to_numpy(zero_copy_only=False) for c in ("query_id", "floor"))
                    order = np.argsort(queries.ids)
                    floor[order[np.searchsorted(queries.ids[order], ids)]] = least
                rows, ids, scores = best_hits(queries, data, floor, k)
                out.append([np.full(len(rows), x, "i4") for x in (dim, q_cell, q_part)] + [queries.ids[rows], ids, scores])
                n += len(rows)
                if n > HELD:
                    yield _hit_batch(out)
                    out, n = [], 0
            if out:
                yield _hit_batch(out)

    return pairs.select("dim", "q_cell", "q_part", "q_tree", "floors", "cell", "part", "tree").mapInArrow(run, _HITS)


def _hit_batch(pieces: list) -> pa.RecordBatch:
    columns = [np.concatenate(x) for x in zip(*pieces)]
    names = ["dim", "q_cell", "q_part", "query_id", "vec_id", "score"]
    kinds = [pa.int32()] * 3 + [pa.int64()] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def _best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query, k: int = TOP) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best other rows.

    vectors has vec_id (integer) and embedding; is_query is a condition on
    vec_id. Ties go to the smaller vec_id. Rows without a vec_id, null vectors
    and those with a null or non-finite component take no part; rows that
    repeat a vec_id are one, with the smallest of their vectors. Vectors meet those of
    their own dimension. Scores beyond a long's limits are cut to them.
    """
    rows = checkpointed(_celled(quantised(vectors)))
    data = checkpointed(_blocks(rows, BLOCK))
    queries = checkpointed(_blocks(rows.where(is_query), QUERY_BLOCK)).select(
        "dim", *[F.col(c).alias(f"q_{c}") for c in ("cell", "part", "centre", "radius", "tree")])
    none = F.lit(None).cast("array<struct<query_id:bigint,floor:bigint>>")
    own = queries.withColumns({"floors": none, "cell": F.col("q_cell")}).join(
        data.select("dim", "cell", "part", "tree"), ["dim", "cell"])
    first = checkpointed(_best(_searched(own, k), k))
    floors = first.where(F.col("rank") == k).groupBy("dim", "q_cell", "q_part").agg(
        F.collect_list(F.struct("query_id", F.col("score").alias("floor"))).alias("floors"),
        F.min("score").alias("worst"), F.count("*").alias("n_floors"))
    sizes = rows.where(is_query).groupBy("dim", F.col("cell").alias("q_cell")).count()
    # Blocks meet by their centres and radii; trees move only for pairs that these leave.
    roots = data.select("dim", "cell", "part", "centre", "radius")
    known = queries.drop("q_tree").join(floors, ["dim", "q_cell", "q_part"], "left").join(sizes, ["dim", "q_cell"])
    # A block some of whose queries have no k-th score yet is bounded by nothing; a cell has all its queries in view.
    whole = F.sum(F.coalesce("n_floors", F.lit(0))).over(Window.partitionBy("dim", "q_cell")) == F.col("count")
    worst = F.when(whole, F.col("worst")).otherwise(F.lit(float("-inf")))
    others = known.withColumn("worst", worst).join(roots, "dim").where(
        (F.col("cell") != F.col("q_cell"))
        & (_limit(F.col("q_centre"), F.col("q_radius"), F.col("centre"), F.col("radius")) >= F.col("worst"))
    ).select("dim", "q_cell", "q_part", "floors", "cell", "part")
    met = others.join(queries.select("dim", "q_cell", "q_part", "q_tree"), ["dim", "q_cell", "q_part"])
    # Many parts, as a few bytes of trees are much work.
    met = met.repartition(TASKS * rows.sparkSession.sparkContext.defaultParallelism, "dim", "cell", "part")
    second = _searched(met.join(data.select("dim", "cell", "part", "tree"), ["dim", "cell", "part"]), k)
    every = first.drop("rank").unionByName(second)
    return _best(every, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
