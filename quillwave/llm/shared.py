"""Tables written to the folder that the driver and all executors share, and keys of documents."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

CHECKPOINT_DIR = "spark.checkpoint.dir"
SHARED_DIR = "quillwave.shared.dir"  #: setting that names the folder where the other one is absent

SCRATCH = "quillwave.scratch.dir"

LOWEST = -(1 << 63)  #: stands for a null doc_id, so that it comes before all others


def shared_root(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, else ``quillwave.shared.dir``.

    With neither, a local session (one machine, so any folder is shared) gets a folder of
    its own below the system's temporary one; on a cluster that is an error.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.conf.get(SHARED_DIR, None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"set {CHECKPOINT_DIR}, or {SHARED_DIR} in the session, to a folder that the driver and all executors share")
    root = f"file://{tempfile.gettempdir()}/quillwave-{os.getpid()}-{spark.sparkContext.applicationId}"
    spark.conf.set(SHARED_DIR, root)
    return root


def shared_dir(spark: SparkSession) -> str:
    """A new path below the shared folder, or below that of the enclosing :func:`scratch`."""
    return f"{spark.conf.get(SCRATCH, None) or shared_root(spark)}/quillwave-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written inside go when it ends, so what is to stay must be written to a path made before."""
    path, outer = shared_dir(spark), spark.conf.get(SCRATCH, None)
    spark.conf.set(SCRATCH, path)
    try:
        yield
    finally:
        if outer:
            spark.conf.set(SCRATCH, outer)
        else:
            spark.conf.unset(SCRATCH)
        dropped(spark, path)


def persisted(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` written once as Parquet in the shared folder (at ``path``, if given) and read back.

    Cuts the lineage without depending on any executor: a lost executor costs
    only its running tasks.  The reread table has no known partitioning, so a
    join on it gets exchanges on both sides, which adaptive execution can split
    when a key is hot.
    """
    spark = df.sparkSession
    path = path or shared_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, *paths: str) -> None:
    """Deletes written tables that nothing will read again, in whatever store they are."""
    context = spark.sparkContext
    for p in paths:
        path = context._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def without(docs: DataFrame, names: list[str] | tuple[str, ...]) -> DataFrame:
    """``docs`` without columns of these names, in any case, as Spark's names have none."""
    return docs.select(*[quoted(c) for c in docs.columns if c.lower() not in names])


def text_key(docs: DataFrame) -> tuple[Column, Column, bool]:
    """Two longs that tell rows with one doc_id apart by their text (a 128-bit digest, or zeros where no id repeats), and whether ids repeat.

    Ids that are all different tell documents apart themselves; one count of the ids
    decides, and results are the same either way.
    """
    ids = docs.groupBy(F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("d")).count()
    if not ids.where("count > 1").head(1):
        return F.lit(0).cast("long"), F.lit(0).cast("long"), False
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)

    def part(a: int) -> Column:
        return F.conv(F.substring(digest, a, 15), 16, 10).cast("long")

    # 60 bits each, and one more to keep a null text apart from an empty one
    return part(1), part(16) * 2 + F.col("text").isNull().cast("long"), True


def numbered(df: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """``df``, written, with its numbers from 0 in ``order``, which many tasks sort in ranges of it.

    Each range's rows are counted, and the ranges' offsets (a row for each partition) are
    broadcast.  Rows alike in ``order`` are numbered in any order.
    """
    held = persisted(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_at", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    counts = held.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return held.withColumn("_part", part).join(F.broadcast(starts), "_part").withColumn(name, (F.col("_start") + inside).cast("long")).drop("_part", "_start", "_at")


def numbered_within(df: DataFrame, group: list[str], order: list[Column], name: str = "place") -> DataFrame:
    """``df``, written, with its numbers from 0 within each ``group`` in ``order``; a group of any size is sorted by many tasks.

    All rows are sorted in ranges of (group, order).  A task numbers the runs of its range;
    a group that began in an earlier range gets an offset, and as only one group can
    reach over a partition's edge, there is at most one offset a partition to broadcast.
    The columns in ``group`` must not be null.
    """
    sorting = [F.col(g).asc() for g in group] + order
    schema = StructType([*df.schema.fields, StructField("_part", LongType()), StructField("_inside", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count = None, 0
        for batch in batches:
            keys = [batch.column(g) for g in group]
            n = batch.num_rows
            if not n:
                continue
            new = np.zeros(n, bool)
            for k in keys:
                new[1:] |= ~np.asarray(pc.equal(k.slice(1), k.slice(0, n - 1)))
            first = [k[0].as_py() for k in keys]
            if first != last:
                new[0], count = True, 0
            at = np.arange(n)
            start = np.maximum.accumulate(np.where(new, at, 0))
            inside = at - start + np.where(start == 0, 0 if new[0] else count, 0)
            last, count = [k[n - 1].as_py() for k in keys], int(inside[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(inside)], [*batch.schema.names, "_inside"])

    laid = df.repartitionByRange(*sorting).sortWithinPartitions(*sorting).withColumn("_part", F.spark_partition_id().cast("long"))
    held = persisted(laid.mapInArrow(run, schema))
    counts = held.groupBy(*group, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    starts = counts.withColumn("_start", F.sum("_n").over(before)).where("_start is not null").drop("_n")
    joined = held.join(F.broadcast(starts), [*group, "_part"], "left")
    return joined.select(*[quoted(c) for c in df.columns], (F.coalesce("_start", F.lit(0)) + F.col("_inside")).cast("long").alias(name))
