"""Silences in sampled energy, and recordings split and trimmed at them."""

from __future__ import annotations

import math
import warnings
from bisect import bisect_left, insort
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import col
from ..sinks.written import written

BLOCK_FRAMES = 60_000  #: frames of a recording that one task looks through at a time, at least
BLOCK_REACHES = 256  #: a block of silences is so many times as long as a cut's influence reaches
BIN_MS = 30_000  #: least width of the bins in which edges of segments meet silences


def auto_threshold(frames: DataFrame, full_scale: float = 32768.0, below: float = 16.0) -> DataFrame:
    """(file, threshold): each file's loudness in dB of full scale, less ``below``; null for a silent file.

    ``frames``: (file, ms, ss double, n long) with the sum of squares and number of samples.
    """
    rms = F.sqrt(F.sum("ss") / F.sum("n"))
    return frames.groupBy("file").agg(F.when(rms > 0, 20 * F.log10(rms / full_scale) - below).alias("threshold"))


def silences(frames: DataFrame, threshold: Column | str, min_len: int = 500, step: int = 1, block: int = BLOCK_FRAMES) -> DataFrame:
    """(file, s, e): maximal stretches in which every window of ``min_len`` frames is no louder than ``threshold``.

    ``frames``: (file, ms long from 0 without gaps, ss double, n long); the threshold is
    a mean square, a column of ``frames`` or a literal.  Windows start every ``step``
    frames and the last possible one is always tried.

    A recording is looked through in blocks of ``block`` frames, each with the ``min_len``
    frames behind it, so its length decides the number of tasks and not their size.  Sums
    are differences of a block's running sum, so the cost doesn't depend on the window's
    length; they are decimals of six places, so that loud recordings lose nothing.
    Stretches that reach over blocks' edges are stitched by one row a block.
    """
    reach = max(min_len, step)  # windows that overlap or touch are one silence
    block = max(block, 2 * reach)
    own = F.floor(F.col("ms") / block)
    blocks = F.array_distinct(F.array(own, F.greatest(F.floor((F.col("ms") - min_len) / block), F.lit(0))))
    held = frames.select("file", "ms", F.col("ss").cast("decimal(28,6)").alias("ss"), "n", col(threshold).alias("limit"), F.explode(blocks).alias("blk"))
    order = Window.partitionBy("file", "blk").orderBy("ms")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = held.withColumns({"cs": F.sum("ss").over(upto), "cn": F.sum("n").over(upto)})
    ends = sums.withColumns({"es": F.lead("cs", min_len - 1).over(order), "en": F.lead("cn", min_len - 1).over(order), "more": F.lead("ms", min_len).over(order)})
    quiet = ends.where((own == F.col("blk")) & F.col("es").isNotNull() & ((F.col("ms") % step == 0) | F.col("more").isNull()))
    quiet = quiet.where((F.col("es") - F.col("cs") + F.col("ss")).cast("double") <= F.col("limit") * (F.col("en") - F.col("cn") + F.col("n")))
    gap = F.col("ms") - F.lag("ms").over(order)
    marked = quiet.withColumn("new", F.when(gap.isNull() | (gap > reach), 1).otherwise(0))
    island = marked.withColumn("island", F.sum("new").over(upto)).groupBy("file", "blk", "island").agg(F.min("ms").alias("s"), F.max("ms").alias("last"))
    return _stitched(island, reach).select("file", "s", (F.col("last") + min_len).alias("e"))


def _stitched(islands: DataFrame, reach: int) -> DataFrame:
    """(file, s, last): islands (file, blk, island from 1, s, last) joined where a block's first begins within ``reach`` of the last one of the block before.

    A block that is one island passes it on, so each block gets the number of the block in
    which its last island began; that is all that has to be read in the order of a file's blocks.
    """
    edges = islands.groupBy("file", "blk").agg(F.min("s").alias("first"), F.max("last").alias("end"), F.count("*").alias("islands"))
    order = Window.partitionBy("file").orderBy("blk")  # a row a block
    near = (F.lag("blk").over(order) == F.col("blk") - 1) & (F.col("first") - F.lag("end").over(order) <= reach)
    linked = edges.withColumn("linked", F.coalesce(near, F.lit(False)))
    began = F.max(F.when(~F.col("linked") | (F.col("islands") > 1), F.col("blk"))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    known = linked.withColumn("began", began)
    known = known.select("file", "blk", "islands", F.when(F.col("linked"), F.lag("began").over(order)).alias("before"))
    met = islands.join(known, ["file", "blk"])
    passed = (F.col("island") == 1) & F.col("before").isNotNull()
    # An island is named by its block and number, the block's last one by 0, as later blocks know it.
    number = F.when(passed | (F.col("island") == F.col("islands")), 0).otherwise(F.col("island"))
    named = met.select("file", F.when(passed, F.col("before")).otherwise(F.col("blk")).alias("blk"), number.alias("island"), "s", "last")
    return named.groupBy("file", "blk", "island").agg(F.min("s").alias("s"), F.max("last").alias("last")).drop("blk", "island")


def _decided(min_len: int, max_len: int) -> Callable[[pa.Table], pa.Table]:
    """Takes the silences of a block and those near its edges, and decides those of the block that it can."""

    def fits(cuts: list[int], s: int, e: int, mid: int) -> bool:
        i = bisect_left(cuts, mid)
        a, b = cuts[i - 1], cuts[i]
        return b - a > max_len and mid - a >= min_len and b - mid >= min_len and s >= a and e <= b

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("s", "e", "mid", "taken", "own")), strict=True), key=lambda r: (r[0] - r[1], r[0]))
        file, total = table.column("file")[0].as_py(), table.column("total")[0].as_py()
        known, possible, out = [0, total], [0, total], []
        for s, e, mid, taken, own in rows:
            if taken is None and own:
                # More cuts only make segments shorter: what doesn't fit among those that are sure never will.
                if fits(possible, s, e, mid):
                    taken = True
                elif not fits(known, s, e, mid):
                    continue
            if taken:
                insort(known, mid)
            insort(possible, mid)
            if own:
                out.append((file, total, s, e, mid, taken))
        kinds = [("file", pa.string()), ("total", pa.int64()), ("s", pa.int64()), ("e", pa.int64()), ("mid", pa.int64()), ("taken", pa.bool_())]
        return pa.table([pa.array([r[i] for r in out], t) for i, (_, t) in enumerate(kinds)], schema=pa.schema(kinds))

    return run


def split(files: DataFrame, silences: DataFrame, min_len: int = 3000, max_len: int = 15000, block: int | None = None) -> DataFrame:
    """(file, idx, raw_start, raw_end): each file cut until no segment is longer than ``max_len``, where that is possible.

    A segment that is too long is cut in the middle of its longest silence (the earliest
    of equals) that leaves ``min_len`` on both sides; without one it stays.

    ``files``: (file, total long); silences are disjoint.  Taking silences once, longest first, gives
    the same cuts as the recursion, and whether one is taken depends only on the longer ones whose
    middles are within reach, ``max_len`` or ``min_len``: a cut farther away leaves room enough on
    its side.  So a recording is decided in blocks of time, each with the silences within
    reach of its edges.  What depends on a silence of another block that isn't decided yet waits
    for the next round; the longest one that waits never has to, so rounds end, mostly after two or three.
    """
    if min_len < 1:
        raise ValueError("min_len is at least 1")
    if 2 * min_len > max_len:
        warnings.warn(f"segments between {max_len} and {2 * min_len} ms can't be cut without one under {min_len} ms", stacklevel=2)
    reach = max(min_len, max_len)
    size = max(block or BLOCK_REACHES * reach, 2 * reach)
    mid = F.floor((F.col("s") + F.col("e")) / 2).cast("long")
    timed = silences.select("file", F.col("s").cast("long").alias("s"), F.col("e").cast("long").alias("e")).join(files.select("file", F.col("total").cast("long").alias("total")), "file")
    usable = timed.withColumn("mid", mid).where((F.col("s") >= 0) & (F.col("e") <= F.col("total")) & (F.col("mid") >= min_len) & (F.col("total") - F.col("mid") >= min_len))
    state = usable.select("file", "total", "s", "e", "mid", F.lit(None).cast("boolean").alias("taken"))
    own = F.floor(F.col("mid") / size)
    while True:
        blocks = F.array_distinct(F.array(*[F.floor((F.col("mid") + d) / size) for d in (-reach, 0, reach)]))
        near = state.withColumn("blk", F.explode(blocks)).withColumn("own", own == F.col("blk"))
        state = written(near.groupBy("file", "blk").applyInArrow(_decided(min_len, max_len), "file string, total long, s long, e long, mid long, taken boolean"))
        if not state.where("taken is null").head(1):
            break
    cuts = files.select("file", F.col("total").cast("long").alias("total"), F.lit(0).cast("long").alias("at")).unionByName(state.select("file", "total", F.col("mid").alias("at")))
    cuts = cuts.withColumn("blk", F.floor(F.col("at") / size))
    counts = cuts.groupBy("file", "blk").agg(F.count("*").alias("c"), F.min("at").alias("first"))
    order, inside = Window.partitionBy("file").orderBy("blk"), Window.partitionBy("file", "blk").orderBy("at")  # a row a block; a block's cuts
    before = F.coalesce(F.sum("c").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("file", "blk", before.alias("before"), F.lead("first").over(order).alias("next_first"))
    placed = cuts.withColumns({"i": F.row_number().over(inside), "next": F.lead("at").over(inside)}).join(starts, ["file", "blk"])
    return placed.select("file", (F.col("before") + F.col("i")).cast("long").alias("idx"), F.col("at").alias("raw_start"), F.coalesce("next", "next_first", "total").alias("raw_end"))


def edge_pairs(segments: DataFrame, silences: DataFrame, width: int | None = None) -> DataFrame:
    """(file, idx, raw_start, raw_end, at_start, s, e): each edge of a segment with the silence that it lies in, if any.

    A start lies in a silence from its first to before its last millisecond, an end from
    after the first to the last.  Both sides meet in bins of ``width`` ms of a file: an edge is in
    one bin, a silence in all that it touches, so they are compared with their neighbours
    alone and each pair is found once.  Bins are ``BIN_MS`` wide or, if that is more, as wide as
    silences are long on average, so these are in two bins on average at most.
    """
    width = width or max(BIN_MS, math.ceil(silences.agg(F.avg(F.col("e") - F.col("s"))).first()[0] or 0))
    edge = F.explode(F.array(*[F.struct(F.lit(start).alias("at_start"), p.cast("long").alias("p")) for start, p in ((True, F.col("raw_start")), (False, F.col("raw_end") - 1))]))
    points = segments.select("file", "idx", "raw_start", "raw_end", edge.alias("x")).select("file", "idx", "raw_start", "raw_end", "x.*").withColumn("bin", F.floor(F.col("p") / width))
    bins = F.explode(F.sequence(F.floor(F.col("s") / width), F.floor((F.col("e") - 1) / width)))
    spread = silences.where("e > s").select("file", "s", "e", bins.alias("bin"))
    return points.join(spread, ["file", "bin"]).where((F.col("s") <= F.col("p")) & (F.col("p") < F.col("e"))).drop("bin", "p")


def trim(segments: DataFrame, silences: DataFrame, files: DataFrame, keep: int = 300, width: int | None = None) -> DataFrame:
    """``segments`` with export_start and export_end, so that ``keep`` ms of silence stay at either edge.

    A segment that begins or ends inside a silence that reaches no farther than its other
    edge is shortened if more than ``keep`` of it lie in the segment.  Silences are
    disjoint, so each edge meets one at most (:func:`edge_pairs`).
    """
    met = edge_pairs(segments, silences, width)
    lead = F.min(F.when(F.col("at_start") & (F.col("e") <= F.col("raw_end")), F.col("e")))
    tail = F.max(F.when(~F.col("at_start") & (F.col("s") >= F.col("raw_start")), F.col("s")))
    found = met.groupBy("file", "idx").agg(lead.alias("lead"), tail.alias("tail"))
    edges = segments.select("file", "idx", "raw_start", "raw_end").join(files, "file").join(found, ["file", "idx"], "left")
    a = F.when(F.col("lead") - F.col("raw_start") > keep, F.col("lead") - keep).otherwise(F.col("raw_start"))
    b = F.when(F.col("raw_end") - F.col("tail") > keep, F.col("tail") + keep).otherwise(F.col("raw_end"))
    out = edges.withColumn("export_start", F.greatest(a, F.lit(0)))
    return out.select("file", "idx", "raw_start", "raw_end", "export_start", F.greatest("export_start", F.least(b, F.col("total"))).alias("export_end"))


def edge_silence(chunks: DataFrame, threshold: Column | str, size: int = 10) -> DataFrame:
    """(file, lead, tail, length) in ms from (file, chunk from 0, level): what is quieter than ``threshold`` at either end.

    A file that is silent throughout has its whole length on both ends.
    """
    loud = F.col("level") >= col(threshold)
    g = chunks.groupBy("file").agg(
        F.min(F.when(loud, F.col("chunk"))).alias("a"), F.max(F.when(loud, F.col("chunk"))).alias("b"), (F.max("chunk") + 1).alias("n")
    )
    return g.select(
        "file",
        (F.coalesce("a", "n") * size).cast("long").alias("lead"),
        (F.coalesce(F.col("n") - 1 - F.col("b"), F.col("n")) * size).cast("long").alias("tail"),
        (F.col("n") * size).cast("long").alias("length"),
    )


def jittered(target: int, jitter: int, key: Column) -> Column:
    """``target`` moved by up to ``jitter`` either way, drawn from a hash of ``key``; never negative."""
    if jitter <= 0:
        return F.lit(max(0, target)).cast("long")
    u = F.conv(F.substring(F.md5(key.cast("string")), 1, 12), 16, 10).cast("double") / float(1 << 48)
    return F.greatest(F.lit(0), F.rint(F.lit(target) + (2 * u - 1) * jitter)).cast("long")


def adjust_edges(edges: DataFrame, action: str, target: int = 480, jitter: int = 20) -> DataFrame:
    """``edges`` with pad_lead, pad_tail, cut_lead and cut_tail in ms.

    ``pad`` fills each end up to its target, ``remove`` cuts it down to it, ``none``
    leaves both; head and tail draw their jitter apart.
    """
    if action not in ("none", "pad", "remove"):
        raise ValueError(f"unknown action {action!r}")
    out = edges
    for end in ("lead", "tail"):
        t = jittered(target, jitter, F.concat_ws("/", "file", F.lit(end)))
        zero = F.lit(0).cast("long")
        out = out.withColumns(
            {
                f"pad_{end}": F.greatest(zero, t - F.col(end)) if action == "pad" else zero,
                f"cut_{end}": F.greatest(zero, F.col(end) - t) if action == "remove" else zero,
            }
        )
    return out
