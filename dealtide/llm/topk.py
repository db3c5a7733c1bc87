"""Exact top-k search by inner product: a ball tree per shard, searched by branch and bound.

Vectors are dealt into shards of bounded size by their id. Each query first searches one shard, which
gives it a k-th score. That score is shared with the search of all other shards: a node whose upper
bound ``q . centre + |q| radius`` is below the score cannot hold a result and is left out.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealtide.llm.tables import prepare_python, keep

#: Rows of a shard that one task searches, rows of a leaf, queries searched together.
SHARD_ROWS, LEAF_ROWS, QUERY_ROWS = 50_000, 64, 512


class BallTree:
    """Nodes as index ranges of ``order``; the halves of a node lie around two far points of it."""

    def __init__(self, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.vectors, self.order = vectors, np.arange(len(vectors))
        self.nodes: list[tuple[int, int, int, int]] = []  # begin, end, left and right child
        self.centres: list[np.ndarray] = []
        self.radii: list[float] = []
        if len(vectors):
            self._node(0, len(vectors))
            waiting = [0]
            while waiting:
                n = waiting.pop()
                begin, end, _, _ = self.nodes[n]
                if end - begin > leaf_rows and self.radii[n] > 0:
                    middle = self._split(begin, end)
                    left, right = self._node(begin, middle), self._node(middle, end)
                    self.nodes[n] = (begin, end, left, right)
                    waiting += [left, right]
        self.centre = np.array(self.centres).reshape(len(self.nodes), -1)
        self.radius = np.array(self.radii)

    def _node(self, begin: int, end: int) -> int:
        own = self.vectors[self.order[begin:end]]
        centre = own.mean(axis=0)
        self.nodes.append((begin, end, -1, -1))
        self.centres.append(centre)
        self.radii.append(float(np.sqrt(((own - centre) ** 2).sum(axis=1).max())))
        return len(self.nodes) - 1

    def _split(self, begin: int, end: int) -> int:
        rows = self.order[begin:end]
        own = self.vectors[rows]
        one = own[((own - own[0]) ** 2).sum(axis=1).argmax()]
        other = own[((own - one) ** 2).sum(axis=1).argmax()]
        side = own @ (other - one)
        middle = (end - begin) // 2
        self.order[begin:end] = rows[np.argpartition(side, middle)]
        return begin + middle


def exact_scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products. Beyond what doubles hold exactly, with Python's integers; scores
    outside 64 bits take the nearest 64-bit value."""
    if queries.size == 0 or rows.size == 0:
        return np.zeros((len(queries), len(rows)), np.int64)
    largest = float(np.abs(queries).max()) * float(np.abs(rows).max()) * queries.shape[1]
    if largest < 2.0**53:
        return (queries @ rows.T).astype(np.int64)
    whole = [[int(x) for x in row] for row in queries], [[int(x) for x in row] for row in rows]
    limit = 2**63 - 1
    return np.array(
        [[max(-limit - 1, min(limit, sum(a * b for a, b in zip(q, r, strict=True)))) for r in whole[1]] for q in whole[0]],
        np.int64,
    ).reshape(len(queries), len(rows))


def search(
    tree: BallTree, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int
) -> Iterator[tuple[int, int, int]]:
    """(query, id, score) of the k best rows of the tree for each query, without the query's own id.

    ``floor``: a score that k rows elsewhere are known to reach; only scores at or above it matter.
    Nodes are taken in the order of their largest upper bound over the queries that still need them.
    """
    if not len(tree.nodes) or not len(queries):
        return
    norm = np.sqrt((queries**2).sum(axis=1))
    worst = floor.astype(np.float64)  # the k-th score so far
    scores: list[np.ndarray] = [np.zeros(0, np.int64)] * len(queries)
    found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(queries)

    def bound(n: int, some: np.ndarray) -> np.ndarray:
        upper = queries[some] @ tree.centre[n] + norm[some] * tree.radius[n]
        return upper + 1e-9 * (np.abs(upper) + norm[some] * (tree.radius[n] + 1.0)) + 1e-6

    everyone = np.arange(len(queries))
    first = bound(0, everyone)
    heap = [(-float(first.max()), 0, everyone, first)]
    while heap:
        _, n, some, upper = heapq.heappop(heap)
        needed = upper >= worst[some]
        some = some[needed]
        if not len(some):
            continue
        begin, end, left, right = tree.nodes[n]
        if left >= 0:
            for child in (left, right):
                own_bound = bound(child, some)
                if (own_bound >= worst[some]).any():
                    heapq.heappush(heap, (-float(own_bound.max()), child, some, own_bound))
            continue
        rows = tree.order[begin:end]
        products = exact_scores(queries[some], tree.vectors[rows])
        all_fit = (products >= worst[some][:, None]) & (ids[rows][None, :] != own[some][:, None])
        for i in np.flatnonzero(all_fit.any(axis=1)):
            q, fits = some[i], all_fit[i]
            got = np.concatenate([scores[q], products[i][fits]])
            who = np.concatenate([found[q], ids[rows][fits]])
            best = np.lexsort((who, -got))
            # Ids may repeat: the best row of each counts.
            best = best[np.sort(np.unique(who[best], return_index=True)[1])][:k]
            scores[q], found[q] = got[best], who[best]
            if len(best) == k:
                worst[q] = max(worst[q], float(scores[q][-1]))
    for q in everyone:
        for who, got in zip(found[q], scores[q], strict=True):
            yield int(q), int(who), int(got)


def quantise(vector: Column) -> Column:
    """Components as floor(256 x); NULL if the vector, or one of its components, is NULL or not
    finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    # Whole numbers as doubles: floor() to a long would fail beyond 64 bits.
    wide = F.transform(vector, lambda x: _floor(x.cast("double") * 256.0))
    return F.when(finite, wide)


def _floor(x: Column) -> Column:
    return F.when(F.abs(x) < 2.0**52, F.floor(F.when(F.abs(x) < 2.0**52, x)).cast("double")).otherwise(x)


_FOUND = "query_id bigint, vec_id bigint, score bigint"


def _search_shards(dealt: DataFrame, shards: int, k: int) -> DataFrame:
    """``dealt``: shard, is_query, id, vector, floor. In each shard the rows come first, then the
    queries, so that a task holds the rows of one shard and a block of queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict = {}
        shard, rows, asked = None, [], []

        def plant():
            by_length: dict[int, list] = {}
            for who, vector in rows:
                by_length.setdefault(len(vector), []).append((who, vector))
            rows.clear()
            for length, some in by_length.items():
                ids = np.array([who for who, _ in some], np.int64)
                trees[length] = (BallTree(np.array([v for _, v in some], np.float64).reshape(len(some), length)), ids)

        def answer():
            out: list[tuple] = []
            for length in {len(v) for _, v, _ in asked}:
                some = [a for a in asked if len(a[1]) == length]
                if length in trees:
                    tree, ids = trees[length]
                    own = np.array([a[0] for a in some], np.int64)
                    lines = np.array([a[1] for a in some], np.float64).reshape(len(some), length)
                    out += [(int(own[q]), who, got) for q, who, got in
                            search(tree, ids, lines, own, np.array([a[2] for a in some], np.float64), k)]
            asked.clear()
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"]
            )

        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            lists = columns[3]
            values = lists.flatten().to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            for i in range(batch.num_rows):
                at, is_query = columns[0][i].as_py(), columns[1][i].as_py()
                if at != shard:
                    if asked:
                        yield answer()
                    trees.clear()
                    rows.clear()
                    shard = at
                vector = np.asarray(values[offsets[i] : offsets[i + 1]], np.float64)
                if not is_query:
                    rows.append((columns[2][i].as_py(), vector))
                    continue
                if rows:
                    plant()
                floor = columns[4][i].as_py()
                asked.append((columns[2][i].as_py(), vector, -np.inf if floor is None else floor))
                if len(asked) >= QUERY_ROWS:
                    yield answer()
        if asked:
            yield answer()

    placed = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "is_query")
    return placed.mapInArrow(run, _FOUND)


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 5,
    identity: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """The k rows of highest inner product for each query: query_id, rank, vec_id, score.

    Components are floored to 1/256 and scores are whole numbers, so results are exact; ties go to
    the smaller id. ``is_query``: which rows are queries; every row but the query's own is searched.
    Rows without an id, and vectors that are NULL or hold a NULL or a component that is not finite,
    take no part. Vectors of another length than the query's cannot be compared with it. Rows that
    repeat an id are one row, which scores as the best of them; such a query asks with each of its
    vectors. An empty table, or one without queries, gives no row. Other columns are not read.
    """
    prepare_python(df.sparkSession)
    given = df.select(
        F.col(f"`{identity}`").cast("long").alias("id"),
        quantise(F.col(f"`{vector}`")).alias("vector"),
        is_query.alias("is_query"),
    ).filter("id IS NOT NULL AND vector IS NOT NULL")
    rows = keep(given)
    total = rows.count()
    shards = max(1, -(-total // shard_rows), min(rows.sparkSession.sparkContext.defaultParallelism, -(-total // 1000)))
    shard = F.pmod(F.xxhash64(F.col("id")), F.lit(shards)).cast("int")
    unknown = F.lit(None).cast("bigint")
    searched = rows.select(shard.alias("shard"), F.lit(False).alias("is_query"), "id", "vector", unknown.alias("floor"))
    queries = rows.filter("is_query")
    asked = queries.select(shard.alias("shard"), F.lit(True).alias("is_query"), "id", "vector", unknown.alias("floor"))
    # First the shard that holds the query, for a k-th score.
    near = keep(_search_shards(searched.unionByName(asked), shards, k))
    ordered = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    if shards == 1:
        found = near
    else:
        kth = (
            near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
        )
        others = F.explode(F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != shard))
        spread = queries.join(kth, queries["id"] == kth["query_id"], "left").select(
            others.alias("shard"), F.lit(True).alias("is_query"), "id", "vector", "floor"
        )
        found = near.unionByName(_search_shards(searched.unionByName(spread), shards, k))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return (
        best.withColumn("rank", F.row_number().over(ordered))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
