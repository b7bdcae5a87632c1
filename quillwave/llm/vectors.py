"""What the two vector searches share: usable vectors and bounded query blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUERY_BYTES = 8 << 20  #: size of the queries sent to the executors at once, whatever their number
QUERY_BLOCK = 16384  #: queries of a block, at most


def usable(vectors: DataFrame, id_col: str, vec_col: str, nonzero: bool = False) -> DataFrame:
    """(vec_id, embedding) of rows that take part.

    Rows with a null id or vector, an empty vector, or a null or non-finite
    component don't; with ``nonzero`` nor do zero vectors.  Other columns are
    dropped, so their names can't clash.
    """
    v = F.col("embedding")

    def bad(x: Column) -> Column:
        y = x.cast("double")
        return x.isNull() | F.isnan(y) | (F.abs(y) == float("inf"))

    out = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("embedding"))
    out = out.where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, bad))
    if nonzero:
        out = out.where(F.exists(v, lambda x: x != 0))
    return out.withColumn("embedding", v.cast("array<double>"))


def query_blocks(queries: DataFrame, block: int | None = None) -> Iterator[dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Blocks of about ``block`` queries (else of ``QUERY_BYTES``) as {length: (ids, matrix)}.

    A repeated id asks once, with its smallest vector.  Blocks are cut by a hash
    of the id, so the driver never holds more than one of them.
    """
    queries = queries.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    count, longest = queries.agg(F.count("*"), F.max(F.size("embedding"))).first()
    if not count:
        return
    blocks = -(-count // (block or max(1, min(QUERY_BLOCK, QUERY_BYTES // (8 * longest)))))
    for b in range(blocks):
        table = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).toArrow()
        if table.num_rows:
            yield matrices(table)


def matrices(batch: pa.Table | pa.RecordBatch) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows of (vec_id, embedding) by vector length: ids and a float64 matrix."""
    column = batch.column("embedding")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ids = batch.column("vec_id").to_numpy(zero_copy_only=False) if isinstance(batch, pa.RecordBatch) else batch.column("vec_id").to_numpy()
    if not len(ids):
        return {}
    lengths = np.asarray(column.value_lengths())
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    flat = np.asarray(column.flatten())
    return {
        int(d): (ids[rows], flat[starts[rows][:, None] + np.arange(d)])
        for d in np.unique(lengths)
        for rows in [np.flatnonzero(lengths == d)]
    }
