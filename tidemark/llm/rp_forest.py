"""Approximate nearest neighbours: a forest of random-projection trees.

Each inner node of a tree splits by the hyperplane halfway between two of its points. The trees
are grown on a bounded sample, so their size does not depend on the table; every vector is then
put into its leaf of every tree. A query goes down all trees at once: one priority queue holds the
subtrees of all of them, by the least margin with which the query is on their side, and leaves are
taken from it until they hold enough points, a number that grows as the 3/4 power of the corpus.
The vectors of these leaves are reranked by their exact distance in double precision.

Equal vectors are one point with its smallest ids, as many as a result can show, so copies cost
nothing. Leaves are dealt out in blocks of bounded size, and so are the queries of a leaf; a block
pair emits the nearest few of each query.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite components, take
no part, as queries or candidates; nor do vectors of another length than most. Rows with equal id
and vector are one. Ties go to the smaller id. With fewer candidates than asked for, all found are
returned; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import runs, stored

NEIGHBOURS = 10
TREES = 16
SAMPLE_ROWS = 16384  # points that the trees are grown on
LEAF = 48  # points of a leaf, while the sample has enough of them
LEAST_LEAF = 8  # sampled points of a leaf
LOOK, POWER = 10.0, 0.75  # a query takes leaves until they hold LOOK * points ** POWER
BLOCK, QUERY_BLOCK = 4096, 512
HELD = 400_000  # rows that a task keeps before it emits them


@dataclass
class Tree:
    """Inner nodes by number (0 is the root); a child below 0 is leaf -child - 1."""

    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray  # (nodes, 2): the side of negative margins, the other side
    leaves: int

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64) if len(self.offsets) else np.full(len(x), -1)
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            margin = np.einsum("ij,ij->i", x[inner], self.normals[node]) - self.offsets[node]
            at[inner] = self.children[node, (margin > 0).astype(int)]
        return -at - 1


def grow(points: np.ndarray, leaf: int, rng: np.random.Generator) -> Tree:
    normals, offsets, children = [], [], []
    leaves = 0

    def build(own: np.ndarray) -> int:
        nonlocal leaves
        for _ in range(5 if len(own) > leaf else 0):
            a, b = points[rng.choice(own, 2, replace=False)]
            normal = a - b
            size = np.linalg.norm(normal)
            if size == 0:
                continue
            normal = normal / size
            offset = normal @ (a + b) / 2
            side = points[own] @ normal - offset > 0
            if min(side.sum(), (~side).sum()) >= len(own) // 20 + 1:
                node = len(normals)
                normals.append(normal)
                offsets.append(offset)
                children.append([0, 0])
                children[node] = [build(own[~side]), build(own[side])]
                return node
        leaves += 1
        return -leaves

    build(np.arange(len(points)))
    return Tree(np.array(normals, np.float64).reshape(-1, points.shape[1]), np.array(offsets),
                np.array(children, np.int64).reshape(-1, 2), leaves)


def grow_forest(points: np.ndarray, corpus: int, trees: int = TREES) -> list[Tree]:
    """`corpus`: number of points of the whole table, which the leaves are sized for."""
    leaf = max(LEAST_LEAF, int(LEAF * len(points) / max(corpus, 1)))
    return [grow(points, leaf, np.random.default_rng(100 + t)) for t in range(trees)]


def leaves_for(forest: list[Tree], sizes: list[np.ndarray], query: np.ndarray,
               wanted: float) -> list[tuple[int, int]]:
    """(tree, leaf) in the order of a priority queue shared by the trees, until they hold
    `wanted` points (a point counts in every tree)."""
    margins = [t.normals @ query - t.offsets for t in forest]
    queue = [(-np.inf, k, 0 if len(t.offsets) else -1) for k, t in enumerate(forest)]
    heapify(queue)
    out: list[tuple[int, int]] = []
    held = 0.0
    while queue and held < wanted:
        priority, k, node = heappop(queue)
        if node < 0:
            out.append((k, -node - 1))
            held += sizes[k][-node - 1]
            continue
        margin = margins[k][node]
        low, high = forest[k].children[node]
        heappush(queue, (max(priority, margin), k, int(low)))
        heappush(queue, (max(priority, -margin), k, int(high)))
    return out


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & whole & F.exists(vector, lambda x: x != 0),
                      F.lit(False))


def with_ids(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the rows that take part. Vectors of floats stay so, others become doubles."""
    kind = dict(vectors.dtypes)[vector_col]
    element = "float" if kind == "array<float>" else "double"
    v = F.col(f"`{vector_col}`").cast(f"array<{element}>")
    plain = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v"))
    # -0.0 becomes 0.0
    return plain.where(usable(F.col("v"))).withColumn(
        "v", F.transform("v", lambda x: x + F.lit(0).cast(element)))


def points_of(vectors: DataFrame, id_col: str, vector_col: str, k: int) -> DataFrame:
    """(node, ids, v): distinct vectors, with their k + 1 smallest ids; node is the smallest."""
    clean = with_ids(vectors, id_col, vector_col).where(F.col("id").isNotNull())
    first = Window.partitionBy("v").orderBy("id")
    few = clean.withColumn("place", F.dense_rank().over(first)).where(F.col("place") <= k + 1)
    points = few.groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    return points.select(F.col("ids")[0].alias("node"), "ids", "v")


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def fewest(query: np.ndarray, node: np.ndarray, score: np.ndarray,
           k: int) -> tuple[np.ndarray, ...]:
    """The k nearest nodes of each query, each once."""
    order = np.lexsort((node, score, query))
    query, node, score = query[order], node[order], score[order]
    new = np.r_[True, (query[1:] != query[:-1]) | (node[1:] != node[:-1])]
    query, node, score = query[new], node[new], score[new]
    start = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
    place = np.arange(len(query)) - np.repeat(start, np.diff(np.r_[start, len(query)]))
    return query[place < k], node[place < k], score[place < k]


def _found(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in held[0]],
                                      ["query_id", "node", "score"])


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id",
            vector_col: str = "embedding", k: int = NEIGHBOURS, trees: int = TREES,
            look: float = LOOK, max_sample: int = SAMPLE_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each row with `is_query`.

    `is_query` is a condition on the id column, named `id` here. `score` is the Euclidean distance.
    """
    spark = vectors.sparkSession
    points = stored(points_of(vectors, id_col, vector_col, k), "points")
    kinds = points.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), "d").first()
    if kinds is None:
        return spark.createDataFrame([], "query_id long, `rank` int, vec_id long, score double")
    size, corpus = kinds["d"], kinds["n"]
    points = points.where(F.size("v") == size)
    # the few smallest ids do not show every query: these come from the table itself
    asked = with_ids(vectors, id_col, vector_col).where(
        is_query & (F.size("v") == size)).distinct()
    kind = dict(points.dtypes)["v"]
    sample = points.orderBy(F.xxhash64("node"), "node").limit(max_sample).select("v").collect()
    forest = grow_forest(np.array([r["v"] for r in sample]), corpus, trees)
    shared = spark.sparkContext.broadcast(forest)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"))
            for t, tree in enumerate(shared.value):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), t, np.int32)),
                     pa.array(tree.leaf_of(x).astype(np.int32)), *batch.columns],
                    ["tree", "leaf", *batch.schema.names])

    placed = stored(points.select("node", "v").mapInArrow(
        place, f"tree int, leaf int, node long, v {kind}"), "placed")
    # one row for each leaf of the forest, whose size is bounded by the sample
    sizes = [np.zeros(t.leaves) for t in forest]
    for r in placed.groupBy("tree", "leaf").agg(F.count("*").alias("n")).collect():
        sizes[r["tree"]][r["leaf"]] = r["n"]
    held = spark.sparkContext.broadcast(sizes)
    wanted = look * corpus**POWER

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q, v in zip(batch.column("id").to_pylist(), batch.column("v").to_pylist()):
                found = leaves_for(shared.value, held.value, np.array(v), wanted)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t for t, _ in found], pa.int32()),
                     pa.array([leaf for _, leaf in found], pa.int32()),
                     pa.array([q] * len(found), pa.int64()),
                     pa.array([v] * len(found), batch.column("v").type)],
                    ["tree", "leaf", "id", "v"])

    visits = stored(asked.mapInArrow(
        search, f"tree int, leaf int, id long, v {kind}"), "visits")
    blocks = placed.groupBy("tree", "leaf").agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    query_blocks = visits.groupBy("tree", "leaf").agg(
        F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("query_blocks"))
    cells = F.broadcast(query_blocks.join(blocks, ["tree", "leaf"]))  # bounded as the forest is
    own = F.pmod(F.xxhash64("id"), F.col("query_blocks").cast("long")).cast("int")
    queries = visits.join(cells, ["tree", "leaf"]).select(
        "tree", "leaf", own.alias("qb"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b"),
        F.lit(True).alias("asks"), "id", "v")
    own = F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int")
    stocked = placed.join(cells, ["tree", "leaf"]).select(
        "tree", "leaf", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)).alias("qb"),
        own.alias("b"), F.lit(False).alias("asks"), F.col("node").alias("id"), "v")
    keys = ["tree", "leaf", "qb", "b"]
    dealt = queries.unionByName(stocked).repartition(*keys).sortWithinPartitions(*keys)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0
        for cell in runs(batches, keys):
            asks = cell.column("asks").to_numpy()
            if asks.all() or not asks.any():
                continue
            ids, x = cell.column("id").to_numpy(), _matrix(cell.column("v"))
            order = np.argsort(ids[~asks])
            nodes, y = ids[~asks][order], x[~asks][order]
            q, x = ids[asks], x[asks]
            step = max(1, (1 << 21) // (len(nodes) * size))
            for a in range(0, len(q), step):
                d = np.sqrt(((x[a : a + step, None, :] - y) ** 2).sum(2))
                best = np.argsort(d, axis=1, kind="stable")[:, : k + 1]
                held.append((np.repeat(q[a : a + step], best.shape[1]), nodes[best].ravel(),
                             np.take_along_axis(d, best, 1).ravel()))
                rows += best.size
            if rows > HELD:  # a task's blocks share queries, so only the best of all are kept
                held = [fewest(*map(np.concatenate, zip(*held)), k + 1)]
                rows = len(held[0][0])
                if rows > HELD // 2:
                    yield _found(held)
                    held, rows = [], 0
        if held:
            yield _found([fewest(*map(np.concatenate, zip(*held)), k + 1)])

    found = dealt.mapInArrow(rank, "query_id long, node long, score double")
    found = found.groupBy("query_id", "node").agg(F.min("score").alias("score"))
    by_node = Window.partitionBy("query_id").orderBy("score", "node")
    found = found.withColumn("place", F.row_number().over(by_node)).where(F.col("place") <= k + 1)
    listed = found.join(points.select("node", "ids"), "node").select(
        "query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    by_id = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return listed.withColumn("rank", F.row_number().over(by_id)).where(
        F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
