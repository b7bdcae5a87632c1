"""Exact top-k search by distributed histogram selection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import shared_dir
from .vectors import matrices, query_blocks, usable

BIN_BITS = 12  #: a round splits each open interval into 4096 bins
SCORES = 1 << 22  #: scores computed at once in a task
WIDE = 1 << 16  #: of those, scores in unbounded integers
NONE = np.iinfo(np.int64).min  #: no score
LARGEST = np.iinfo(np.int64).max  #: scores beyond it count as it, those below its negative as that


def quantised(x: np.ndarray) -> np.ndarray:
    """floor(256 * x), kept as whole-number doubles."""
    with np.errstate(over="ignore"):
        return np.floor(256.0 * x)


def _whole(x: np.ndarray) -> np.ndarray:
    """floor(256 * x) as Python's unbounded integers."""
    exact = np.vectorize(lambda v: int(v) * 256 if abs(v) >= 2.0**52 else int(np.floor(256.0 * v)), otypes=[object])
    return exact(x) if x.size else x.astype(object)


def _wide(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """:func:`_products` of rows with large components: in int64 where none can overflow, else in unbounded integers."""
    a, b = quantised(q), quantised(c)
    top_q, top_c = np.abs(a).max(axis=1, initial=0), np.abs(b).max(axis=1, initial=0)
    with np.errstate(over="ignore"):
        fits = q.shape[1] * top_q[:, None] * top_c[None, :] < 2.0**62
    x, y = (np.where(np.abs(m) < 2.0**62, m, 0).astype(np.int64) for m in (a, b))
    s = x @ y.T
    rows, cols = np.flatnonzero(~fits.all(axis=1)), np.flatnonzero(~fits.all(axis=0))
    if len(rows) and len(cols):
        u, v = _whole(q[rows]), _whole(c[cols])
        step = max(1, WIDE // len(cols))
        for i in range(0, len(rows), step):
            part = np.ix_(rows[i : i + step], cols)
            exact = np.clip(u[i : i + step] @ v.T, -LARGEST, LARGEST).astype(np.int64)
            s[part] = np.where(fits[part], s[part], exact)
    return s


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of all rows of q and c after quantising, as int64; those beyond it are clipped.

    Doubles do for rows between which every partial sum is a whole double: all but a few.
    """
    a, b = quantised(q), quantised(c)
    limit = np.sqrt(2.0**53 / max(1, q.shape[1]))
    x, y = np.abs(a).max(axis=1, initial=0) < limit, np.abs(b).max(axis=1, initial=0) < limit
    if x.all() and y.all():
        return (a @ b.T).astype(np.int64)
    s = np.zeros((len(q), len(c)), np.int64)
    s[np.ix_(x, y)] = (a[x] @ b[y].T).astype(np.int64)
    s[~x] = _wide(q[~x], c)
    s[np.ix_(x, ~y)] = _wide(q[x], c[~y])
    return s


def _scores(batches, queries) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, candidate ids, score matrix) of each block of candidates; a query's own rows score ``NONE``."""
    for batch in batches:
        for d, (ids, x) in matrices(batch).items():
            if d not in queries:
                continue
            qids, q = queries[d]
            rows = max(64, SCORES // len(q))
            for at in range(0, len(ids), rows):
                cid = ids[at : at + rows]
                s = _products(q, x[at : at + rows])
                s[qids[:, None] == cid[None, :]] = NONE
                yield d, cid, s


def _kth(s: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, or the smallest possible value."""
    return np.partition(s, -k, axis=1)[:, -k] if s.shape[1] >= k else np.full(len(s), NONE)


def exact_top_k(candidates: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The ``k`` highest integer inner products of every query, ties to the smaller id.

    Both inputs hold ``id_col`` (whole numbers) and ``vec_col`` (arrays).  Components
    become floor(256 * x).  Queries go in blocks of bounded size; for each block:

    1. every candidate is scored in its own scan task, and each task returns counts
       of score bins, only from the bin of its own k-th score upwards (the global
       k-th can't lie below it);
    2. Spark adds the counts, and the bin holding each query's k-th score becomes the
       next round's interval, until a bin is one score wide;
    3. candidates at or above the k-th score are kept, of those equal to it at most the
       ``k`` smallest ids of a task, ranked by (score desc, id), and written.

    Nothing is shuffled but counts and survivors; no score list is stored.  Blocks share
    one folder of results, so the plan doesn't grow with their number.

    Nulls: rows without an id or with a null, empty or non-finite vector take no part.
    A query's own id is never its result.  Vectors of another length than the query's
    aren't compared.  Repeated candidate rows are separate results, repeated queries ask
    once.  Fewer candidates than ``k``: all of them.  Empty input: empty result.  Scores are
    exact for every finite component; one beyond the range of a long counts, and comes out,
    as the largest or smallest long of the symmetric range, so such scores are ties.

    Returns query_id long, rank int, vec_id long, score long.
    """
    spark = candidates.sparkSession
    rows = usable(candidates, id_col, vec_col)
    norm2 = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + F.pow(F.lit(256.0) * F.abs(x) + 1, F.lit(2.0)))
    longest = float(np.sqrt(rows.agg(F.max(norm2)).first()[0] or 0.0))
    folder = shared_dir(spark)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    blocks = 0
    for block in query_blocks(usable(queries, id_col, vec_col)):
        found, sent = _search_block(rows, block, longest, k)
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ranked.select("query_id", "rank", "vec_id", "score").write.parquet(f"{folder}/part={blocks}")
        blocks += 1
        for s in sent:
            s.destroy()
    schema = "query_id long, rank int, vec_id long, score long"
    return spark.read.schema(schema).parquet(f"{folder}/part=*") if blocks else spark.createDataFrame([], schema)


def _search_block(rows: DataFrame, queries: dict, longest: float, k: int) -> tuple[DataFrame, list]:
    """The survivors of one block of queries, and the broadcasts that they need."""
    context = rows.sparkSession.sparkContext
    sent = context.broadcast(queries)
    at = {int(q): (d, i) for d, (ids, _) in queries.items() for i, q in enumerate(ids)}

    def reach(q: np.ndarray) -> np.ndarray:
        """|q . c| <= |q| |c|, with room for rounding, so each query's scores lie between this and its negative."""
        with np.errstate(over="ignore", invalid="ignore"):
            most = np.ceil(np.sqrt(((256.0 * np.abs(q) + 1) ** 2).sum(axis=1)) * longest * (1 + 1e-6)) + 1
        return np.array([int(m) if m < 2.0**62 else LARGEST for m in most], dtype=np.int64)

    bound = {d: reach(q) for d, (_, q) in queries.items()}
    lo = {d: -b for d, b in bound.items()}
    bits = max((2 * int(b.max())).bit_length() for b in bound.values())
    hi = {d: b.copy() for d, b in bound.items()}
    need = {d: np.full(len(b), k) for d, b in bound.items()}
    used = [sent]
    while bits > 0:
        bits = max(0, bits - BIN_BITS)
        state = context.broadcast(({d: x.copy() for d, x in lo.items()}, {d: x.copy() for d, x in hi.items()}, bits))

        def count(batches, sent=sent, state=state):
            queries, (lo, hi, shift) = sent.value, state.value
            for d, _, s in _scores(batches, queries):
                s[(s > hi[d][:, None]) | (s < lo[d][:, None])] = NONE
                # Distances from lo span up to 2^64, so they are unsigned.
                down, up = np.uint64(min(shift, 63)), (np.maximum(_kth(s, k), lo[d]) - lo[d]).view(np.uint64)
                least = (up >> down << down).view(np.int64) + lo[d]
                r, c = np.nonzero(s >= least[:, None])
                bins = ((s[r, c] - lo[d][r]).view(np.uint64) >> down).view(np.int64)
                found, counts = np.unique(np.stack([r, bins]), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(queries[d][0][found[0]]), pa.array(found[1]), pa.array(counts)], ["query_id", "bin", "n"])

        histogram = rows.mapInArrow(count, "query_id long, bin long, n long").groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("query_id").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
        wanted = {q: int(need[d][i]) for q, (d, i) in at.items()}
        cumulated = histogram.withColumn("upto", F.sum("n").over(down))
        picked = cumulated.join(_needs(rows, wanted), "query_id").where("upto >= need and upto - n < need")
        seen = set()
        for q, b, upto, n in picked.select("query_id", "bin", "upto", "n").collect():  # one row a query of the block
            d, i = at[q]
            first = int(lo[d][i]) + (b << bits)
            lo[d][i], hi[d][i] = first, min(int(hi[d][i]), first + (1 << bits) - 1)
            need[d][i] -= upto - n
            seen.add(q)
        for q in at.keys() - seen:  # fewer than k candidates: all are results
            d, i = at[q]
            need[d][i] = LARGEST >> 1
        state.destroy()
    least = context.broadcast({d: np.where(need[d] > k, NONE + 1, lo[d]) for d in lo})
    used.append(least)

    def keep(batches):
        queries, least_of = sent.value, least.value
        for d, cid, s in _scores(batches, queries):
            t = least_of[d][:, None]
            order = np.argsort(cid, kind="stable")
            same = (s == t)[:, order]
            first = np.zeros_like(same)
            first[:, order] = same & (np.cumsum(same, axis=1) <= k)
            r, c = np.nonzero((s > t) | first)
            yield pa.RecordBatch.from_arrays([pa.array(queries[d][0][r]), pa.array(cid[c]), pa.array(s[r, c])], ["query_id", "vec_id", "score"])

    return rows.mapInArrow(keep, "query_id long, vec_id long, score long"), used


def _needs(rows: DataFrame, wanted: dict[int, int]) -> DataFrame:
    """How many results each query of the block still lacks; at most a block of rows."""
    table = pa.table({"query_id": pa.array(list(wanted), pa.int64()), "need": pa.array(list(wanted.values()), pa.int64())})
    return F.broadcast(rows.sparkSession.createDataFrame(table))
