"""Approximate nearest neighbours from a forest of hash-prefix trees."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import persisted, shared_dir
from .vectors import matrices, query_blocks, usable

TREES = 16
BITS = 48  #: length of a hash string
FIRST = 0.03  #: entries that a first search gathers over all trees, as a share of the rows
RECALL = 0.92  #: chance that the second search is to meet a neighbour as far as the k-th found first; nearer ones are met more often
SHARD = 1 << 12  #: rows of one forest, at most
SHARD_BYTES = 4 << 20  #: size of its vectors, at most
SEED = 11

INDEX = "dim int, rows int, ids array<long>, at array<int>, x binary, mean binary, codes binary, order binary"
FOUND = "query_id long, vec_id long, score double, cosine double, gathered long"


class Forest:
    """Sorted arrays of hash strings over some rows, one array a tree.

    Bit j of a string tells the side of the j-th random hyperplane through the rows'
    mean.  Rows with the same vector are one entry that keeps the ``ids_kept`` smallest
    ids, which are all that any result can need.
    """

    def __init__(self, ids: np.ndarray, x: np.ndarray, ids_kept: int, trees: int = TREES, bits: int = BITS) -> None:
        x = np.ascontiguousarray(x) + 0.0  # -0.0 becomes 0.0
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        _, first, inverse = np.unique(x.view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel(), return_index=True, return_inverse=True)
        self.x, self.count = x[first], len(ids)
        by = np.argsort(inverse, kind="stable")
        counts = np.bincount(inverse, minlength=len(first))
        nth = np.arange(len(ids)) - np.repeat(np.cumsum(counts) - counts, counts)
        kept = by[nth < ids_kept]
        self.ids, self.at = ids[kept], np.concatenate(([0], np.cumsum(np.minimum(counts, ids_kept)))).astype(np.int32)
        self.bits, self.planes = bits, planes(trees, x.shape[1], bits)
        with np.errstate(over="ignore", invalid="ignore"):
            self.mean = self.x.mean(axis=0)
        codes = np.stack([self.hashes(self.x, t) for t in range(trees)])
        self.rows = np.argsort(codes, axis=1, kind="stable").astype(np.int32)
        self.codes = np.take_along_axis(codes, self.rows, axis=1)

    def stored(self) -> dict:
        """The forest as a row of the index."""
        return {"dim": self.x.shape[1], "rows": self.count, "ids": self.ids, "at": self.at, "x": self.x.tobytes(), "mean": self.mean.tobytes(), "codes": self.codes.tobytes(), "order": self.rows.tobytes()}

    @classmethod
    def of(cls, row: dict, trees: int = TREES, bits: int = BITS) -> Forest:
        """The forest of a row of the index."""
        self = cls.__new__(cls)
        self.ids, self.at, self.count = np.asarray(row["ids"], np.int64), np.asarray(row["at"], np.int64), row["rows"]
        self.x, self.mean = np.frombuffer(row["x"]).reshape(-1, row["dim"]), np.frombuffer(row["mean"])
        self.codes, self.rows = np.frombuffer(row["codes"], np.int64).reshape(trees, -1), np.frombuffer(row["order"], np.int32).reshape(trees, -1)
        self.bits, self.planes = bits, planes(trees, row["dim"], bits)
        return self

    def hashes(self, x: np.ndarray, tree: int) -> np.ndarray:
        """The hash string of every row, its first bit the highest."""
        side = (x - self.mean) @ self.planes[tree] > 0
        return (side @ (1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64))).astype(np.int64)

    def ranges(self, q: np.ndarray, wanted: float, level: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """For each query and tree, the range of entries that share the prefix at which the ascent ends.

        Every tree is descended to its longest match; then all ascend together, a bit at
        a time, until their ranges hold ``wanted`` entries or are whole.  Counts only grow
        on the way up, so the level is found by bisection.  With ``level`` it is given.
        """
        codes = np.stack([self.hashes(q, t) for t in range(len(self.codes))])

        def at(level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            shift = self.bits - level
            low = codes >> shift << shift
            high = low + (np.int64(1) << shift)
            return (
                np.stack([np.searchsorted(c, a) for c, a in zip(self.codes, low, strict=True)]),
                np.stack([np.searchsorted(c, a) for c, a in zip(self.codes, high, strict=True)]),
            )

        if level is not None:
            return at(level)
        good, bad = np.zeros(len(q), np.int64), np.full(len(q), self.bits + 1)
        while (bad - good > 1).any():
            level = (good + bad) // 2
            a, b = at(level)
            enough = (b - a).sum(axis=0) >= wanted
            good, bad = np.where(enough, level, good), np.where(enough, bad, level)
        return at(good)

    def search(self, qids: np.ndarray, q: np.ndarray, k: int, wanted: float = 0, level: np.ndarray | None = None) -> Iterator[tuple]:
        """(query, ids, distances, cosines, entries gathered) of the ``k`` nearest entries found for each query, ties by id.

        The cosine is that of the angle at the rows' mean, which hash strings tell of.
        """
        low, high = self.ranges(q, wanted, level)
        for i, qid in enumerate(qids):
            found = np.unique(np.concatenate([r[a:b] for r, a, b in zip(self.rows, low[:, i], high[:, i], strict=True)]))
            gathered = len(found)
            if not gathered:
                continue
            d = distances(self.x[found], q[i])
            if len(d) > k + 1:  # one more, as an entry may hold nothing but the query
                near = d <= np.partition(d, k)[k]
                found, d = found[near], d[near]
            cosine = cosines(self.x[found] - self.mean, q[i] - self.mean)
            sizes = self.at[found + 1] - self.at[found]
            ids = self.ids[np.repeat(self.at[found] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
            d, cosine = np.repeat(d, sizes), np.repeat(cosine, sizes)
            other = ids != qid
            ids, d, cosine = ids[other], d[other], cosine[other]
            best = np.lexsort((ids, d))[:k]
            yield int(qid), ids[best], d[best], cosine[best], gathered


def planes(trees: int, dim: int, bits: int) -> np.ndarray:
    return np.random.default_rng(SEED).normal(size=(trees, dim, bits))


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision; squares that would overflow are scaled first."""
    with np.errstate(over="ignore", invalid="ignore"):
        d = np.sqrt(((x - q) ** 2).sum(axis=1))
        far = ~np.isfinite(d)
        if far.any():
            y = x[far] / 4 - q / 4
            top = np.abs(y).max(axis=1, keepdims=True)
            d[far] = np.sqrt(((y / top) ** 2).sum(axis=1)) * top[:, 0] * 4
    return d


def cosines(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    with np.errstate(all="ignore"):
        return np.nan_to_num(np.clip(x @ q / (np.linalg.norm(x, axis=1) * np.linalg.norm(q)), -1, 1), nan=1.0)


def levels(cosine: np.ndarray, recall: float, trees: int = TREES, bits: int = BITS) -> np.ndarray:
    """The longest prefix that a neighbour at this angle shares in one of the trees with chance ``recall``.

    A random hyperplane parts two vectors at angle a with chance a / pi, so a prefix of n
    bits is shared in one of t trees with chance 1 - (1 - (1 - a / pi)^n)^t.
    """
    same = 1 - np.arccos(np.clip(cosine, -1, 1)) / math.pi
    share = 1 - (1 - recall) ** (1 / trees)
    with np.errstate(divide="ignore"):
        return np.floor(np.minimum(np.log(share) / np.log(np.clip(same, 1e-9, 1 - 1e-12)), bits)).astype(np.int64)


def build(rows: DataFrame, k: int, shard: int, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The index: a :class:`Forest` over every ``shard`` rows or ``shard_bytes`` of a scan task, one row each.

    A row goes out before the next is made, so a task holds one forest and one batch.
    """

    def run(batches):
        held: dict[int, list] = {}
        schema = pa.schema([("dim", pa.int32()), ("rows", pa.int32()), ("ids", pa.list_(pa.int64())), ("at", pa.list_(pa.int32())), *((c, pa.binary()) for c in ("x", "mean", "codes", "order"))])

        def flush(d: int) -> pa.RecordBatch:
            ids, x = (np.concatenate(c) for c in zip(*held.pop(d), strict=True))
            return pa.RecordBatch.from_pylist([Forest(ids, x, k + 1).stored()], schema)

        for batch in batches:
            for d, (ids, x) in matrices(batch).items():
                size = max(1, min(shard, shard_bytes // (8 * d)))
                a = 0
                while a < len(ids):
                    own = held.setdefault(d, [])
                    b = min(len(ids), a + size - sum(len(i) for i, _ in own))
                    own.append((ids[a:b], x[a:b]))
                    a = b
                    if sum(len(i) for i, _ in own) >= size:
                        yield flush(d)
        for d in list(held):
            yield flush(d)

    return rows.mapInArrow(run, INDEX)


def _gather(index: DataFrame, sent, k: int, first: float | None) -> DataFrame:
    """``FOUND`` of each shard: its ``k`` best for every query, at a ``first`` share of entries or else at the query's level."""

    def run(batches):
        queries = sent.value
        for batch in batches:
            for row in range(batch.num_rows):
                shard = {c: batch.column(c)[row] for c in batch.schema.names}
                d = shard["dim"].as_py()
                if d not in queries:
                    continue
                fields = {c: np.asarray(v.values) if c in ("ids", "at") else v.as_py() for c, v in shard.items()}
                forest, (qids, q, level) = Forest.of(fields), queries[d]
                found = list(forest.search(qids, q, k, wanted=max(2 * k, (first or 0) * forest.count), level=None if first else level))
                n = [len(i) for _, i, *_ in found]
                if sum(n):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat([q for q, *_ in found], n), pa.int64()),
                            *(pa.array(np.concatenate([f[c] for f in found]), t) for c, t in ((1, pa.int64()), (2, pa.float64()), (3, pa.float64()))),
                            pa.array(np.repeat([f[4] for f in found], n), pa.int64()),
                        ],
                        ["query_id", "vec_id", "score", "cosine", "gathered"],
                    )

    return index.mapInArrow(run, FOUND)


def nearest(
    candidates: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    first: float = FIRST,
    recall: float = RECALL,
    shard: int = SHARD,
) -> DataFrame:
    """The ``k`` nearest of ``candidates`` found for every query, by Euclidean distance.

    1. Each scan task cuts its rows into shards of bounded size and builds a
       :class:`Forest` over each, once: every row is indexed, and forests are written.
    2. Queries go to all shards in blocks of bounded size.  A first search descends and
       ascends until it has gathered a ``first`` share of a shard's entries; the k-th
       nearest of all shards bounds how far away the true neighbours are.
    3. From the angle at that bound follows the prefix length at which a neighbour as far
       is met with chance ``recall``: all trees of all shards ascend to it, once for the
       whole table, and their entries are ranked.  Where neighbours are close, that is a
       small part of the rows; on random directions it is most of them.

    Distances are computed on the original vectors in double precision.

    Rows without an id, or with a null, empty, zero or non-finite vector, take no part.
    A query's own id is never its result.  Vectors of another length than the query's
    aren't compared.  Repeated candidate rows are separate results as long as they are
    among the k + 1 smallest ids of their vector; repeated queries ask once.  Ties go to
    the smaller id.  Fewer candidates than ``k``: all that were found; empty input:
    empty result.

    Returns query_id long, rank int, vec_id long, score double.
    """
    spark = candidates.sparkSession
    index = persisted(build(usable(candidates, id_col, vec_col, nonzero=True), k, shard))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    folder, blocks = shared_dir(spark), 0
    schema = "query_id long, rank int, vec_id long, score double"
    for block in query_blocks(usable(queries, id_col, vec_col, nonzero=True)):
        sent = spark.sparkContext.broadcast({d: (ids, q, None) for d, (ids, q) in block.items()})
        ranked = _gather(index, sent, k, first).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        bound = ranked.groupBy("query_id").agg(F.min("cosine").alias("cosine"), F.max("rank").alias("n"))
        found = {r["query_id"]: r["cosine"] if r["n"] == k else -1.0 for r in bound.collect()}  # a row for each query of the block
        sent.destroy()
        sent = spark.sparkContext.broadcast({d: (ids, q, levels(np.array([found.get(int(i), -1.0) for i in ids]), recall)) for d, (ids, q) in block.items()})
        ranked = _gather(index, sent, k, None).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ranked.select("query_id", "rank", "vec_id", "score").write.parquet(f"{folder}/part={blocks}")
        blocks += 1
        sent.destroy()
    return spark.read.schema(schema).parquet(f"{folder}/part=*") if blocks else spark.createDataFrame([], schema)
