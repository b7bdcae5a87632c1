"""Sharding on a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import persisted, quoted, without

CELLS = 1 << 13  #: hash cells around the ring; every virtual node stands at the start of one
PART_ROWS = 1 << 12  #: rows of one cell that are ranked together, on average
PARTS = 1 << 14  #: parts of one cell, at most
VNODES = 32  #: virtual nodes of a shard


def ring(shards: int, vnodes: int = VNODES, cells: int = CELLS) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise.

    Places come from the shard's and node's numbers alone, so another shard adds its
    own nodes and moves nobody else's.  A node whose cell is taken moves clockwise to
    the next free cell.
    """
    taken: dict[int, int] = {}
    for node in range(vnodes):
        for shard in range(shards):
            cell = int.from_bytes(hashlib.sha256(f"{shard}/{node}".encode()).digest()[:8], "big") % cells
            while cell in taken:
                cell = (cell + 1) % cells
            taken[cell] = shard
    return sorted(taken.items())


def fill(counts: list[int], nodes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int, int, int]]:
    """Where the rows of each arc go: (arc, first rank, end rank, shard, first slot).

    ``counts``: the rows before each virtual node.  A shard's capacity is a share of
    the rows that differs from another's by one at most, so in the end all are full.
    Arc by arc, rows fill the node's shard; those that overflow continue clockwise to
    the next node whose shard has room.  At most arcs x shards intervals come out,
    whatever the number of rows.
    """
    total = sum(counts)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    plan = []
    # Every arc first offers its rows to its own shard; only what is left moves on.
    rest = []
    for arc, (n, (_, shard)) in enumerate(zip(counts, nodes, strict=True)):
        take = min(n, room[shard] - used[shard])
        if take:
            plan.append((arc, 0, take, shard, used[shard]))
            used[shard] += take
        rest.append(take)
    for arc, n in enumerate(counts):
        at, step = rest[arc], 0
        while at < n:
            step += 1
            shard = nodes[(arc + step) % len(nodes)][1]
            take = min(n - at, room[shard] - used[shard])
            if take:
                plan.append((arc, at, at + take, shard, used[shard]))
                used[shard] += take
                at += take
    return plan


def bounded_ring(docs: DataFrame, shards: int, key: Column, id_cols: list[str], vnodes: int = VNODES, cells: int = CELLS) -> DataFrame:
    """``docs`` with ``shard`` int and ``slot`` long (gapless from 0 in each shard).

    A row's place on the ring is the hash of ``key``; the law is ``rows``: the shards'
    counts differ by one at most.  Rows are ranked inside parts of their hash cell, dealt
    by a hash of the row and, for rows equal throughout, of where they are read, so a cell
    that a hot key fills is ranked by many tasks; parts are summed to cells, cells to
    arcs, and the flow of overflowing arcs is planned on one count an arc.  The tables
    joined back are bounded by the number of cells, of parts and of arcs x shards.

    Only rows beyond a full shard's capacity leave the place their hash gives, so a
    further shard moves about its own share of the rows and the overflow.

    Rows of one part are ordered by ``id_cols``; a null key has a place like any other.
    Repeated rows get a slot each, any of them any of theirs.  Columns of ``docs`` named
    shard or slot are replaced.  Empty input gives an empty result.
    """
    spark = docs.sparkSession
    nodes = ring(shards, vnodes, cells)
    docs = without(docs, ("shard", "slot"))
    rows = docs.select(F.struct(*[quoted(c).alias(c) for c in docs.columns]).alias("row"), F.pmod(F.xxhash64(key), F.lit(cells)).cast("int").alias("cell"))
    sizes = {r["cell"]: r["count"] for r in rows.groupBy("cell").count().collect()}  # at most `cells` rows
    parts = spark.createDataFrame([(c, max(1, min(PARTS, n // PART_ROWS))) for c, n in sizes.items()], "cell int, parts int")
    # The salt is drawn once, in a written table, as the rows' places are counted and ranked after it.
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), F.monotonically_increasing_id()), F.col("parts")).cast("int")
    placed = persisted(rows.join(F.broadcast(parts), "cell").withColumn("part", F.when(F.col("parts") > 1, spread).otherwise(0)).drop("parts"))

    counts = placed.groupBy("cell", "part").count()
    before = Window.partitionBy("cell").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # at most `PARTS` rows
    starts = counts.select("cell", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))

    arc_rows, base, arc_of = [0] * len(nodes), [0] * cells, [0] * cells
    # An arc ends at its node: walk the cells clockwise from the one after the last node.
    arc, ends = 0, [cell for cell, _ in nodes]
    for step in range(cells):
        cell = (ends[-1] + 1 + step) % cells
        base[cell], arc_of[cell] = arc_rows[arc], arc
        arc_rows[arc] += sizes.get(cell, 0)
        if cell == ends[arc] and arc + 1 < len(nodes):
            arc += 1

    cell_table = spark.createDataFrame([(c, arc_of[c], base[c]) for c in range(cells)], "cell int, arc int, base long")
    plan = spark.createDataFrame(fill(arc_rows, nodes, shards), "arc int, from long, to long, shard int, first long")
    order = Window.partitionBy("cell", "part").orderBy(*[F.col("row").getField(c).asc_nulls_first() for c in id_cols])
    ranked = placed.withColumn("n", F.row_number().over(order) - 1).join(starts, ["cell", "part"]).join(F.broadcast(cell_table), "cell")
    ranked = ranked.withColumn("rank", F.col("base") + F.col("start") + F.col("n")).select("row", "arc", "rank")
    at = F.broadcast(plan.withColumnRenamed("arc", "to_arc"))
    joined = ranked.join(at, (F.col("arc") == F.col("to_arc")) & (F.col("rank") >= F.col("from")) & (F.col("rank") < F.col("to")))
    return joined.select(*[F.col("row").getField(c).alias(c) for c in docs.columns], F.col("shard"), (F.col("first") + F.col("rank") - F.col("from")).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Every document's shard under the law ``rows``.

    Returns doc_id long, size long (UTF-8 bytes of the text plus 1), text_crc32 long,
    law string, shard int, slot long, grown_shard int (null: the law isn't ``key``).

    A null text counts as empty.  A row's place on the ring comes from doc_id and the
    text's hash together, so neither one hot text nor one repeated (or null) doc_id
    puts all its rows into one cell; rows equal in both share one, and are ranked in
    parts.  Columns beyond doc_id and text are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    out = bounded_ring(rows, shards, F.struct("doc_id", "text_crc32"), ["doc_id", "text_crc32", "size"])
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
