"""Approximate nearest neighbours by a forest of random-projection trees.

A tree splits space at every node by a random direction, at the median of a sample.
The trees are fitted on a bounded sample (SAMPLE_ROWS rows at most, drawn by a hash of the id),
but every row is put into its leaf of every tree.  A query walks all trees at once through one
priority queue of nodes, ordered by the squared margins by which it missed them, and takes
the first leaves: LEAST_LEAVES and as many as hold about `share` of one tree's rows.  The
candidates in those leaves are ranked exactly.  Sample rows in the leaves a query takes bound its
k-th best score from below, so a block of rows hands on only what can be among the k best.

Nearness is the largest inner product.  Trees are built for Euclidean nearness, so rows get
one more coordinate, sqrt(M^2 - |x|^2) with M the largest norm, and queries 0 there:
then both orders agree.

`share` is the trade of recall for work.  Directions of the given vectors carry no
structure, so a large share is needed for a recall of 0.9; clustered vectors need far less.
More rows make deeper trees, up to what the sample can split; leaves beyond that are cut into
blocks of rows, so identical vectors, which no tree can part, never meet in one task.

Vectors that are null, empty, of another length than most, zero, or hold null or non-finite
components take no part, neither as rows nor as queries.  Rows without an id take no part.  An id is one
candidate and one query, however many rows it has: its score is the best of any two of their vectors,
and none of its own rows is its neighbour.  Ties go to the smaller id.  Empty tables give no rows.
Columns other than the id and the vector are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapfold.llm.staging import staged

TREES = 8
LEAF_ROWS = 256
SAMPLE_ROWS = 16_384
SHARE = 0.75
LEAST_LEAVES = 16
BLOCK = 4096


@dataclass(frozen=True)
class Forest:
    """directions[tree]: one row per inner node in heap order; cuts likewise; scale: M."""

    depth: int
    directions: np.ndarray  # trees x (2 ** depth - 1) x dimensions + 1
    cuts: np.ndarray
    scale: float

    @property
    def trees(self) -> int:
        return len(self.cuts)

    def lift(self, rows: np.ndarray) -> np.ndarray:
        missing = np.sqrt(np.maximum(0.0, self.scale**2 - (rows * rows).sum(axis=1)))
        return np.column_stack([rows, missing])

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        """rows x trees: the leaf of each row."""
        lifted = self.lift(rows)
        out = np.empty((len(rows), self.trees), dtype=np.int64)
        for t in range(self.trees):
            node = np.zeros(len(rows), dtype=np.int64)
            for _ in range(self.depth):
                side = np.einsum("nd,nd->n", lifted, self.directions[t][node]) > self.cuts[t][node]
                node = 2 * node + 1 + side
            out[:, t] = node - (2**self.depth - 1)
        return out

    def search(self, queries: np.ndarray, leaves: int) -> Iterator[list[tuple[int, int]]]:
        """For each query the (tree, leaf) pairs that it reaches first."""
        lifted = np.column_stack([queries, np.zeros(len(queries))])
        inner = 2**self.depth - 1
        margins = np.einsum("qd,tnd->qtn", lifted, self.directions, optimize=True) - self.cuts
        for own in margins:
            signed = own.tolist()
            queue = [(0.0, t, 0) for t in range(self.trees)]
            found: list[tuple[int, int]] = []
            while queue and len(found) < leaves:
                missed, t, node = heapq.heappop(queue)
                while node < inner:
                    margin = signed[t][node]
                    near = 2 * node + 1 + (margin > 0)
                    far = 4 * node + 3 - near
                    heapq.heappush(queue, (missed + margin * margin, t, far))
                    node = near
                found.append((t, node - inner))
            yield found


@dataclass(frozen=True)
class Sample:
    """The rows that the forest was fitted on, and their leaves in every tree."""

    ids: np.ndarray
    rows: np.ndarray
    leaves: np.ndarray


def grow(sample: np.ndarray, rows: int, trees: int, leaf_rows: int, scale: float, seed: int = 11) -> Forest:
    """A forest for a table of so many rows, fitted on the sample."""
    per_leaf = max(leaf_rows * len(sample) / max(rows, 1), 4)
    depth = max(0, int(np.ceil(np.log2(max(1.0, len(sample) / per_leaf)))))
    rng = np.random.default_rng(seed)
    width = sample.shape[1] + 1
    directions = rng.normal(size=(trees, 2**depth - 1, width))
    directions /= np.maximum(np.linalg.norm(directions, axis=2, keepdims=True), 1e-12)
    forest = Forest(depth, directions, np.zeros((trees, 2**depth - 1)), scale)
    lifted = forest.lift(sample)
    for t in range(trees):
        node = np.zeros(len(sample), dtype=np.int64)
        for _ in range(depth):
            at = np.einsum("nd,nd->n", lifted, directions[t][node])
            order = np.lexsort((at, node))
            names, first, count = np.unique(node[order], return_index=True, return_counts=True)
            forest.cuts[t][names] = at[order][first + (count - 1) // 2]
            node = 2 * node + 1 + (at > forest.cuts[t][node])
    return forest


def usable(vector: Column, length: int) -> Column:
    finite = F.forall(
        vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))
    )
    return (F.size(vector) == length) & finite & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def lower_bounds(ids: np.ndarray, queries: np.ndarray, found: list[list[tuple[int, int]]], sample: Sample, k: int) -> np.ndarray:
    """Of each query a score that k other ids in its leaves reach, or -inf."""
    scores = queries @ sample.rows.T
    scores[ids[:, None] == sample.ids[None, :]] = -np.inf
    out = np.full(len(ids), -np.inf)
    trees = np.arange(sample.leaves.shape[1])
    taken = np.zeros((len(trees), int(sample.leaves.max(initial=0)) + 1), dtype=bool)
    names, number = np.unique(sample.ids, return_inverse=True)
    for i, own in enumerate(found):
        taken[:] = False
        for t, leaf in own:
            if leaf < taken.shape[1]:
                taken[t, leaf] = True
        seen = taken[trees, sample.leaves].any(axis=1)
        held = scores[i, seen]
        if len(names) < len(sample.ids):  # the best score of each id
            best = np.full(len(names), -np.inf)
            np.maximum.at(best, number[seen], held)
            held = best[best > -np.inf]
        if len(held) >= k:
            out[i] = np.partition(held, -k)[-k]
    return out


def _best(queries: tuple[np.ndarray, np.ndarray, np.ndarray], rows: tuple[np.ndarray, np.ndarray], k: int):
    """The k nearest ids of each query that reach its bound: query ids, row ids, scores."""
    query_ids, q, least = queries
    by_id = np.argsort(rows[0], kind="stable")
    row_ids, r = rows[0][by_id], rows[1][by_id]
    starts = np.flatnonzero(np.append(True, row_ids[1:] != row_ids[:-1]))
    for at in range(0, len(q), 512):
        ids, part = query_ids[at : at + 512], q[at : at + 512]
        rough = part @ r.T
        rough[ids[:, None] == row_ids[None, :]] = -np.inf
        if len(starts) > k:
            best = rough if len(starts) == len(row_ids) else np.maximum.reduceat(rough, starts, axis=1)
            bound = np.partition(best, -k, axis=1)[:, -k]
        else:
            bound = np.full(len(part), -np.inf)
        bound = np.maximum(bound, least[at : at + 512])
        # What rounding might lift into the first k comes along; the order is by exact sums.
        slack = np.where(np.isfinite(bound), 1e-9 * (1 + np.abs(bound)), 0.0)
        a, b = np.nonzero((rough >= (bound - slack)[:, None]) & (rough > -np.inf))
        score = np.zeros(len(a))
        for d in range(part.shape[1]):
            score += part[a, d] * r[b, d]
        order = np.lexsort((row_ids[b], -score, a))
        a, b, score = a[order], b[order], score[order]
        if len(starts) < len(row_ids):  # of an id the best row
            once = np.sort(np.unique(a * len(r) + np.searchsorted(row_ids, row_ids[b]), return_index=True)[1])
            a, b, score = a[once], b[once], score[once]
        rank = np.arange(len(a)) - np.searchsorted(a, a)
        keep = rank < k
        yield ids[a[keep]], row_ids[b[keep]], score[keep]


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding",
            trees: int = TREES, leaf_rows: int = LEAF_ROWS, share: float = SHARE, sample_rows: int = SAMPLE_ROWS,
            block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for every query row its k nearest rows found.

    `is_query` is a condition on the id column.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[vector_column].dataType.simpleString()
    if kind != "array<float>":
        kind = "array<double>"
    given = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast(kind).alias("vector")
    ).where("id IS NOT NULL")
    empty = "query_id long, rank int, vec_id long, score double"
    usual = given.groupBy(F.size("vector").alias("n")).count().where("n > 0").orderBy(F.desc("count"), "n").first()
    if usual is None:
        return spark.createDataFrame([], empty)
    # Rows that repeat another in id and vector change nothing; as one row they make no large block.
    good = staged(given.where(usable(F.col("vector"), usual["n"])).dropDuplicates(["id", "vector"]), "vectors")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    query_condition = is_query.alias("is_query")
    named = good.withColumnRenamed("id", id_column).select("*", query_condition).withColumnRenamed(id_column, "id")
    facts = named.agg(
        F.count("*").alias("rows"), F.count_if("is_query").alias("queries"), F.max(norm).alias("scale")
    ).first()
    if not facts["rows"] or not facts["queries"]:
        return spark.createDataFrame([], empty)
    drawn = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.lit(int(0.95 * sample_rows / facts["rows"] * (1 << 30)))
    chosen = good.where(drawn | F.lit(facts["rows"] <= sample_rows)).orderBy("id", "vector").limit(sample_rows).collect()
    drawn_rows = np.array([r.vector for r in chosen])
    forest = grow(drawn_rows, facts["rows"], trees, leaf_rows, facts["scale"])
    sample = Sample(np.array([r.id for r in chosen]), drawn_rows, forest.leaves(drawn_rows))
    # At most trees * sample_rows / 4 directions, and the sample.
    shared = spark.sparkContext.broadcast((forest, sample))
    leaves = LEAST_LEAVES + round(share * 2**forest.depth)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value[0].leaves(_matrix(batch.column("vector")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("vector"),
                 pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), found.shape[1]).cast(pa.list_(pa.int64()))],
                names=["id", "vector", "leaf"],
            )

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids, queries = part.column("id").to_numpy(), _matrix(part.column("vector"))
                found = list(shared.value[0].search(queries, leaves))
                least = lower_bounds(ids, queries, found, shared.value[1], k)
                pairs = pa.array(
                    [[{"tree": t, "leaf": x} for t, x in own] for own in found],
                    pa.list_(pa.struct([("tree", pa.int64()), ("leaf", pa.int64())])),
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("vector"), pa.array(least), pairs],
                    names=["id", "vector", "least", "visits"],
                )

    # Every row in its leaf of every tree; large leaves are cut into blocks of rows.
    placed = staged(
        good.mapInArrow(place, f"id long, vector {kind}, leaf array<long>"), "placed"
    ).select("id", "vector", F.posexplode("leaf").alias("tree", "leaf"))
    # One row per leaf, at most trees * sample_rows.
    sizes = placed.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / F.lit(block)).alias("blocks"))
    sizes = F.broadcast(sizes)
    query_blocks = int(np.ceil(facts["queries"] / block))
    rows = (
        placed.join(sizes, ["tree", "leaf"])
        .withColumn("row_block", F.pmod(F.xxhash64("id", "vector"), F.col("blocks")))
        .withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
        .select("tree", "leaf", "row_block", "query_block", "id", "vector")
    )
    asked = named.where("is_query").select("id", "vector").mapInArrow(
        visit, f"id long, vector {kind}, least double, visits array<struct<tree: long, leaf: long>>"
    )
    asked = (
        asked.select("id", "vector", "least", F.explode("visits").alias("visit"))
        .select("id", "vector", "least", F.col("visit.tree").cast("int").alias("tree"), F.col("visit.leaf").alias("leaf"))
        .join(sizes, ["tree", "leaf"])
        .withColumn("row_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("query_block", F.pmod(F.xxhash64("id", "vector"), F.lit(query_blocks)).cast("int"))
        .select("tree", "leaf", "row_block", "query_block", "id", "vector", "least")
    )
    key = ["tree", "leaf", "row_block", "query_block"]

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]]
        if left.num_rows and right.num_rows:
            q, r = ((t["id"].to_numpy(), _matrix(t["vector"].combine_chunks())) for t in (left, right))
            q = (*q, left["least"].to_numpy())
            for found in _best(q, r, k):
                for column, values in zip(out, found, strict=True):
                    column.append(values)
        return pa.table([np.concatenate(c) for c in out], names=["query_id", "vec_id", "score"])

    scored = asked.groupBy(*key).cogroup(rows.groupBy(*key)).applyInArrow(
        rank, "query_id long, vec_id long, score double"
    )
    first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        scored.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(first))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
