"""Clean file names without collisions."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import basename, parent, stem, suffix
from ..functions.text import clean_name
from ..sinks.written import written

PLAN = "folder string, old string, new string, target string, status string"


def cleaned(files: DataFrame) -> DataFrame:
    """(path, folder, old, target): the name each listed file should have; its ending is kept as it is."""
    return files.select("path", parent("path").alias("folder"), basename("path").alias("old"), F.concat(clean_name(stem("path")), suffix("path")).alias("target"))


COUNTER = r"^(?s)(.+)_([1-9][0-9]{0,17})$"  #: a stem that a counter may have made
RANGE = 1 << 16  #: places, counters or ranks of a target that one task orders at a time


def _ranks(rows: DataFrame, by: str, name: str) -> DataFrame:
    """``rows`` with their rank from 1 among those of a folder and target by a number, ordered in ranges of it."""
    group = ["folder", "target"]
    celled = rows.withColumn("_cell", F.floor(F.col(by) / RANGE))
    before = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = celled.groupBy(*group, "_cell").count().select(*group, "_cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    inner = Window.partitionBy(*group, "_cell").orderBy(by)
    placed = celled.withColumn("_place", F.row_number().over(inner)).join(starts, [*group, "_cell"])
    return placed.withColumn(name, (F.col("_place") + F.col("_start")).cast("long")).drop("_cell", "_start", "_place")


def _slots(asked: DataFrame, names: DataFrame) -> DataFrame:
    """``asked`` (folder, old, target, pos) with slot: 0 for the target's own name, n for its counter n, in the order of pos.

    Targets that no other target can reach: of their names only those taken from the start
    are in the way, so the r-th file gets the r-th free slot, r - 1 and as many more as
    there are taken slots with fewer than r free ones below.  Free ones are counted at the taken slots
    and looked up by rank, both in ranges, so a target that a whole folder shares is worked on by many tasks.
    """
    group = ["folder", "target"]
    wanted = asked.select(*group).distinct()
    counted = F.regexp_extract(stem("old"), COUNTER, 2)
    base = F.concat(F.regexp_extract(stem("old"), COUNTER, 1), suffix("old"))
    own = names.select("folder", F.col("old").alias("target"), F.lit(0).cast("long").alias("c"))
    taken = own.unionByName(names.where(counted != "").select("folder", base.alias("target"), counted.cast("long").alias("c"))).join(wanted, group)
    below = _ranks(written(taken), "c", "i").withColumn("x", F.col("c") - F.col("i") + 1).groupBy(*group, "x").agg(F.max("i").alias("i"))
    ranked = _ranks(asked, "pos", "r").withColumn("x", F.col("r") - 1)
    none = F.lit(None)
    both = ranked.select(*group, "x", F.lit(None).cast("long").alias("i"), "old", "pos").unionByName(below.select(*group, "x", "i", none.cast("string").alias("old"), none.cast("long").alias("pos")))
    both = both.withColumn("_range", F.floor(F.col("x") / RANGE))
    inner = Window.partitionBy(*group, "_range").orderBy("x", F.col("i").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    carried = both.groupBy(*group, "_range").agg(F.max("i").alias("_i")).select(*group, "_range", F.max("_i").over(before).alias("_before"))
    met = both.withColumn("_here", F.max("i").over(inner)).where("old is not null").join(carried, [*group, "_range"])
    return met.select(*group, "old", "pos", (F.col("x") + F.coalesce("_here", "_before", F.lit(0))).alias("slot"))


def rename_plan(requests: DataFrame, listing: DataFrame) -> DataFrame:
    """(folder, old, new, target, status) for the files asked for, in the order of ``pos``.

    ``requests``: (path, pos); a path asked for twice counts once.  ``listing``: (path)
    of all files there.  A target that is taken gets _1, _2, ... before its ending, the first that
    is free when its turn comes.  status: `renamed` or `unchanged`.  Rows without a path are ignored.

    A renamed file gives up a name that is not clean, and new names are clean, so what is
    free to a target depends on the files there and on its own requests (:func:`_slots`), unless another
    target is one of its counters' names (`a` and `a_1`).  Such targets alone depend on
    each other's order, and are worked through in runs of names of one stem.  (The one clean-up
    that gives names which aren't clean, `_` with its counters, keeps those that `__1` and the like give up.)
    """
    requests, listing = requests.where("path is not null"), listing.where("path is not null")
    first = requests.groupBy("path").agg(F.min(F.col("pos").cast("long")).alias("pos"))
    # Names are taken apart once; what follows reads narrow tables.
    asked = written(cleaned(first).join(first, "path").select("folder", "old", "target", "pos"))
    names = cleaned(listing).select("folder", "old").unionByName(asked.select("folder", "old")).distinct()
    changing = asked.where("target <> old")
    wanted = changing.select("folder", "target").distinct()
    base = F.concat(F.regexp_extract(stem("target"), COUNTER, 1), suffix("target"))
    nested = wanted.where(stem("target").rlike(COUNTER)).select("folder", "target", base.alias("base"))
    nested = nested.join(wanted.select("folder", F.col("target").alias("base")), ["folder", "base"])
    tangled = written(nested.select("folder", "target").unionByName(nested.select("folder", F.col("base").alias("target"))).distinct())
    any_tangled = bool(tangled.head(1))

    slots = _slots(changing.join(tangled, ["folder", "target"], "left_anti") if any_tangled else changing, names)
    numbered = F.concat(stem("target"), F.lit("_"), F.col("slot").cast("string"), suffix("target"))
    plain = slots.select("folder", "old", F.when(F.col("slot") == 0, F.col("target")).otherwise(numbered).alias("new"), "target", F.lit("renamed").alias("status"))
    same = asked.where("target = old").select("folder", "old", F.col("old").alias("new"), "target", F.lit("unchanged").alias("status"))
    plan = plain.unionByName(same)
    return plan.unionByName(_in_turn(changing.join(tangled, ["folder", "target"], "left_semi"), names)) if any_tangled else plan


def _in_turn(asked: DataFrame, names: DataFrame) -> DataFrame:
    """The plan of requests that depend on each other, in sorted runs of the names in their reach: those of one stem up to a counter."""
    there = names.select("folder", "old", F.lit(None).cast("string").alias("target"), F.lit(None).cast("long").alias("pos"))
    root = F.regexp_replace(clean_name(stem(F.coalesce("target", "old"))), r"(_\d+)*$", "")
    root = F.when(root == "", "_").otherwise(root)
    reached = asked.select("folder", root.alias("root")).distinct()
    both = there.withColumn("root", root).join(reached, ["folder", "root"], "left_semi").unionByName(asked.withColumn("root", root))
    # Runs are sorted rows, read in one pass; names without a request come first.
    return both.repartition("folder", "root").sortWithinPartitions("folder", "root", F.col("pos").asc_nulls_first()).mapInArrow(_plans, PLAN)


def _parts(name: str) -> tuple[str, str]:
    """Stem and ending, as the column functions part them."""
    found = re.fullmatch(r"(.+)(\.[^.]+)", name, re.S)
    return found.groups() if found else (name, "")


def _plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The plan of each run of rows with one folder and root, names without a request first, then requests in order."""
    key, taken, asked = None, set(), []

    def flush() -> Iterator[tuple]:
        untried: dict[tuple[str, str], int] = {}  # the first counter of a target that was never tried
        freed: dict[tuple[str, str], list[int]] = {}  # counters below it whose names were given up

        def numbered(target: str) -> str:
            base = _parts(target)
            free = freed.get(base, [])
            while free:
                name = f"{base[0]}_{heapq.heappop(free)}{base[1]}"
                if name not in taken:
                    return name
            n = untried.get(base, 1)
            while f"{base[0]}_{n}{base[1]}" in taken:
                n += 1
            untried[base] = n + 1
            return f"{base[0]}_{n}{base[1]}"

        for folder, old, target in asked:
            new = target
            if target != old:
                new = numbered(target) if target in taken else target
                taken.discard(old)
                taken.add(new)
                counted = re.fullmatch(r"(.+)_([1-9][0-9]*)", _parts(old)[0], re.S)
                if counted:
                    base, n = (counted[1], _parts(old)[1]), int(counted[2])
                    if n < untried.get(base, 1):
                        heapq.heappush(freed.setdefault(base, []), n)
            yield folder, old, new, target, "unchanged" if target == old else "renamed"

    def emitted(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(5)], ["folder", "old", "new", "target", "status"])

    for batch in batches:
        out: list[tuple] = []
        for folder, old, target, root in zip(*(batch.column(c).to_pylist() for c in ("folder", "old", "target", "root")), strict=True):
            if (folder, root) != key:
                out += flush()
                key, taken, asked = (folder, root), set(), []
            taken.add(old)
            if target is not None:
                asked.append((folder, old, target))
        yield emitted(out)
    yield emitted(list(flush()))


def rename_counts(plan: DataFrame) -> DataFrame:
    """(status, n)."""
    return plan.groupBy("status").agg(F.count("*").alias("n"))
