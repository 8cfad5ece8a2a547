"""Nearest neighbours by a hierarchical k-means tree, best bin first (operator 9).

The tree is fitted in numpy on a bounded sample of unit vectors. Every vector is then put into
its leaf by Spark. A query walks the tree with a priority queue: the best open branch is followed
first, and leaves are visited until the calibrated number is reached. Queries and vectors meet by
leaf, in blocks of bounded size, and the exact cosine decides.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ebbflow.session import settled

SAMPLE = 20_000  # vectors that the tree is fitted on, about
BRANCHES = 8
LEAF = 64  # sample vectors below which a node is not split
CALIBRATION = 200  # sample queries of the calibration
TARGET = 0.97  # share of true neighbours that must lie in visited leaves
BLOCK = 4096  # vectors or queries of a leaf that meet in one task


@dataclass
class Tree:
    """Nodes by number: an inner node has child numbers and centres, a leaf has none."""

    children: list[list[int]] = field(default_factory=list)
    centres: list[np.ndarray | None] = field(default_factory=list)
    visits: int = 1

    @classmethod
    def fit(cls, vectors: np.ndarray, seed: int = 11) -> "Tree":
        tree, draw = cls(), np.random.default_rng(seed)
        tree._grow(vectors, draw)
        return tree

    def _grow(self, vectors, draw) -> int:
        me = len(self.children)
        self.children.append([])
        self.centres.append(None)
        if len(vectors) <= LEAF:
            return me
        centres = vectors[draw.choice(len(vectors), min(BRANCHES, len(vectors)), replace=False)]
        for _ in range(8):
            owner = (vectors @ centres.T).argmax(axis=1)
            sums = np.stack([vectors[owner == k].sum(axis=0) for k in range(len(centres))])
            norms = np.linalg.norm(sums, axis=1, keepdims=True)
            centres = np.where(norms > 0, sums / np.maximum(norms, 1e-30), centres)
        owner = (vectors @ centres.T).argmax(axis=1)
        parts = [vectors[owner == k] for k in range(len(centres))]
        if max(map(len, parts)) == len(vectors):  # nothing to tell apart
            return me
        full = [k for k in range(len(centres)) if len(parts[k])]
        self.centres[me] = centres[full]
        self.children[me] = [self._grow(parts[k], draw) for k in full]
        return me

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        found = np.zeros(len(vectors), dtype=np.int64)
        open_ = [(0, np.arange(len(vectors)))]
        while open_:
            node, rows = open_.pop()
            if not self.children[node]:
                found[rows] = node
                continue
            best = (vectors[rows] @ self.centres[node].T).argmax(axis=1)
            open_ += [(c, rows[best == k]) for k, c in enumerate(self.children[node]) if (best == k).any()]
        return found

    def leaves(
        self, query: np.ndarray, visits: int, sizes: dict[int, int] | None = None, least: int = 0
    ) -> list[int]:
        """The first `visits` leaves, the best branch first, and more until `least` vectors are in
        them by the `sizes` of the leaves, if so many there are."""
        queue, found, held = [(0.0, 0)], [], 0
        while queue and (len(found) < visits or held < least):
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                found.append(node)
                held += sizes.get(node, 0) if sizes else 0
                continue
            for child, near in zip(self.children[node], self.centres[node] @ query):
                heapq.heappush(queue, (-float(near), child))
        return found

    def calibrate(self, vectors: np.ndarray, k: int, target: float = TARGET, seed: int = 12) -> None:
        """Widen the leaf visits until `target` of the sample's true neighbours are met.

        In the whole table neighbours lie nearer than in the sample, so this errs on the wide side.
        """
        total = sum(not c for c in self.children)
        self.visits = total
        if len(vectors) < 2:
            return
        leaf = self.leaf_of(vectors)
        asked = np.random.default_rng(seed).permutation(len(vectors))[:CALIBRATION]
        near = vectors[asked] @ vectors.T
        near[np.arange(len(asked)), asked] = -np.inf
        needed = []
        for row, q in enumerate(asked):
            place = {x: i for i, x in enumerate(self.leaves(vectors[q], total))}
            top = np.argpartition(-near[row], min(k, len(vectors) - 1) - 1)[:k]
            needed += [place[leaf[t]] + 1 for t in top if np.isfinite(near[row, t])]
        self.visits = int(np.quantile(needed, target, method="higher")) if needed else total


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id and vector of the rows that take part."""
    v = F.col(vector_column)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col(id_column).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & fine
        & F.exists("v", lambda x: x != 0)
    )


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(m: np.ndarray) -> np.ndarray:
    top = np.abs(m).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    m = m / top
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, summed in one order whatever the block: equal vectors give equal values."""
    a, b = np.ascontiguousarray(a), np.ascontiguousarray(b)
    with np.errstate(over="ignore", under="ignore", invalid="ignore", divide="ignore"):
        value = (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
    odd = ~np.isfinite(value)
    if odd.any():
        value[odd] = (_unit(a[odd]) * _unit(b[odd])).sum(axis=1)
    return value


RESULT = "query_row long, query_id long, vec_id long, score double"


def nearest(
    vectors: DataFrame,
    queries,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    sample: int = SAMPLE,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found of each query row.

    queries: a condition on the column `id` that says which rows ask. Nearness is the largest
    cosine in double precision, ties go to the smaller id. Rows with a null id and vectors that
    are null, empty, zero, of another length than most, or hold null or non-finite numbers take
    no part. Only the query's own row is no candidate: another row of its id is one, and each of
    several rows of an asking id gives k rows of its own. An empty table gives no rows. The tree is
    fitted on about `sample` vectors by the hash of the id; every vector is indexed. Leaves are
    visited until they hold k + 1 vectors at least, or all. Crowded leaves are cut into blocks,
    vectors and queries alike, so no task holds a whole leaf.
    """
    rows = usable(vectors, id_column, vector_column)
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"))
    most = sizes.orderBy(F.desc("n"), "d").first()
    spark = vectors.sparkSession
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("v") == most["d"])
    unit = 1 << 30
    share = int(unit * min(1.0, sample / most["n"]))
    picked = rows.where(F.pmod(F.xxhash64("id"), F.lit(unit)) < share).limit(2 * sample).toArrow().sort_by("id")
    fitted = _matrix(picked.column("v"))
    fitted = _unit(fitted) if len(fitted) else np.zeros((0, most["d"]))
    tree = Tree.fit(fitted)
    tree.calibrate(fitted, k)

    schema = f"leaf long, row long, id long, v {rows.schema['v'].dataType.simpleString()}"

    def placed(df, leaves):
        """A row for each leaf of each row, by `leaves`: (row number in the batch, leaf) of a matrix."""

        def work(batches):
            for batch in batches:
                m = _unit(_matrix(batch.column(2))) if batch.num_rows else np.zeros((0, 1))
                at, leaf = leaves(m)
                taken = [batch.column(c).take(pa.array(at)) for c in range(3)]
                yield pa.record_batch([pa.array(leaf), *taken], names=["leaf", "row", "id", "v"])

        return settled(df.select("row", "id", "v").mapInArrow(work, schema))

    # the number of a row is stored with it, so it stays the same however often it is read
    base = placed(
        rows.withColumn("row", F.monotonically_increasing_id()), lambda m: (np.arange(len(m)), tree.leaf_of(m))
    )
    held = dict(base.groupBy("leaf").count().collect())  # as many as the tree has leaves
    visits = max(2, tree.visits)

    def visited(m):
        found = [tree.leaves(q, visits, held, k + 1) for q in m]
        leaf = np.array([x for f in found for x in f], dtype=np.int64)
        return np.repeat(np.arange(len(m)), [len(f) for f in found]), leaf

    asked = placed(base.where(queries), visited)

    # One row for each leaf, as many as the tree has: how many blocks either side is cut into.
    def blocks(df, name):
        return df.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))

    cut = F.broadcast(blocks(base, "b").join(blocks(asked, "q"), "leaf"))

    def dealt(df, own, other):
        mine = F.pmod(F.xxhash64("row"), F.col(own)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        out = df.join(cut, "leaf").select("leaf", "row", "id", "v", mine.alias(own), every.alias(other))
        return out.groupBy("leaf", "b", "q")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        ask, have = _matrix(right.column("v")), _matrix(left.column("v"))
        out_r, out_q, out_v, out_s = [], [], [], []
        if len(ask) and len(have):
            ids, keys = left.column("id").to_numpy(), right.column("id").to_numpy()
            own, asks = left.column("row").to_numpy(), right.column("row").to_numpy()
            units = _unit(have)
            for at in range(0, len(ask), 256):
                rough = _unit(ask[at : at + 256]) @ units.T
                rough[asks[at : at + 256, None] == own[None]] = -np.inf
                for i, values in enumerate(rough):
                    n = min(k, len(values))
                    least = np.partition(values, len(values) - n)[len(values) - n] - 1e-9
                    chosen = np.flatnonzero((values >= least) & np.isfinite(values))
                    exact = cosine(np.repeat(ask[at + i][None], len(chosen), axis=0), have[chosen])
                    order = np.lexsort((ids[chosen], -exact))[:k]
                    out_r.append(np.full(len(order), asks[at + i]))
                    out_q.append(np.full(len(order), keys[at + i]))
                    out_v.append(ids[chosen][order])
                    out_s.append(exact[order])
        kinds = ((out_r, np.int64), (out_q, np.int64), (out_v, np.int64), (out_s, np.float64))
        columns = [np.concatenate(c) if c else np.zeros(0, t) for c, t in kinds]
        return pa.table(dict(zip(["query_row", "query_id", "vec_id", "score"], columns)))

    found = dealt(base, "b", "q").cogroup(dealt(asked, "q", "b")).applyInArrow(meet, RESULT)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
