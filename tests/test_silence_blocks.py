"""Recordings in blocks and bins against walks through the whole of them."""

import random

import pytest
from pyspark.sql import functions as F

from quillwave.operators import silence


def walked(frames, limit, min_len, step):
    """Silences of one recording's (ss, n), window by window."""
    total, starts = len(frames), []
    for a in range(total - min_len + 1):
        if a % step == 0 or a == total - min_len:
            part = frames[a : a + min_len]
            if sum(x for x, _ in part) <= limit * sum(n for _, n in part):
                starts.append(a)
    out = []
    for a in starts:
        if out and a - out[-1][1] <= max(min_len, step):
            out[-1][1] = a
        else:
            out.append([a, a])
    return [(a, b + min_len) for a, b in out]


@pytest.mark.parametrize("min_len,step,block", [(4, 1, 8), (5, 3, 10), (3, 7, 14), (1, 1, 5), (4, 1, 60_000)])
def test_silences_over_blocks(spark, min_len, step, block):
    rnd = random.Random(min_len * 100 + step)
    files = {f"f{i}": [] for i in range(25)}
    for f in files:
        while len(files[f]) < rnd.choice([0, 1, 3, 30, 120, 200]):
            files[f] += [(rnd.choice([0.0, 1.0, 9.0]) if rnd.random() < 0.1 else level, 1) for level in [rnd.choice([0.0, 9.0])] for _ in range(rnd.randrange(1, 60))]
    rows = [(f, i, float(x), n) for f, v in files.items() for i, (x, n) in enumerate(v)]
    df = spark.createDataFrame(rows, "file string, ms long, ss double, n long").repartition(5)
    got = {f: [] for f in files}
    for r in silence.silences(df, F.lit(1.5), min_len, step, block).collect():
        got[r["file"]].append((r["s"], r["e"]))
    for f, v in files.items():
        assert sorted(got[f]) == walked(v, 1.5, min_len, step), f
    assert silence.silences(df.limit(0), F.lit(1.0), min_len, step, block).count() == 0


def folded(total, sil, low, high):
    """Segments of one recording, silences taken once, longest first."""
    parts = {0: total}
    for s, e in sorted(sil, key=lambda x: (x[0] - x[1], x[0])):
        m = (s + e) // 2
        a = max(p for p in parts if p <= m)
        b = parts[a]
        if b - a > high and s >= a and e <= b and m - a >= low and b - m >= low:
            parts[a], parts[m] = m, b
    return sorted(parts.items())


@pytest.mark.parametrize("kind", ["random", "falling", "rising", "equal"])
def test_split_over_blocks(spark, kind):
    """Blocks as small as they may be; falling and rising lengths are chains through all of them."""
    rnd = random.Random(7)
    files, sil = {}, {}
    for i in range(12):
        at, own = 0, []
        for k in range(rnd.choice([0, 1, 5, 60])):
            n = {"random": rnd.randrange(1, 12), "falling": 70 - k, "rising": 10 + k, "equal": 5}[kind]
            at += rnd.randrange(0, 15)
            own.append((at, at + n))
            at += n
        files[f"f{i}"], sil[f"f{i}"] = at + rnd.randrange(1, 30), own
    f = spark.createDataFrame(list(files.items()), "file string, total long")
    s = spark.createDataFrame([(k, *x) for k, v in sil.items() for x in v], "file string, s long, e long").repartition(3)
    got = {k: [] for k in files}
    for r in silence.split(f, s, 7, 40, block=80).orderBy("file", "idx").collect():
        got[r["file"]].append((r["raw_start"], r["raw_end"]))
        assert r["idx"] == len(got[r["file"]])
    for k, total in files.items():
        assert got[k] == folded(total, sil[k], 7, 40), k


def test_long_recording(spark):
    """100,000 silences of one recording over many blocks, equal to the fold, and candidate pairs for trimming linear in them."""
    rnd = random.Random(11)
    at, sil = 0, []
    for _ in range(100_000):
        at += rnd.randrange(200, 4000)
        n = rnd.randrange(500, 3000)
        sil.append((at, at + n))
        at += n
    f = spark.createDataFrame([("long", at + 500)], "file string, total long")
    s = spark.createDataFrame([("long", *x) for x in sil], "file string, s long, e long")
    segments = silence.split(f, s).cache()
    got = [(r["raw_start"], r["raw_end"]) for r in segments.orderBy("idx").collect()]

    cuts, want = [0, at + 500], set()  # the fold with a sorted list
    from bisect import bisect_left, insort

    for x, y in sorted(sil, key=lambda x: (x[0] - x[1], x[0])):
        m = (x + y) // 2
        i = bisect_left(cuts, m)
        a, b = cuts[i - 1], cuts[i]
        if b - a > 15000 and m - a >= 3000 and b - m >= 3000:
            insort(cuts, m)
    want = list(zip(cuts, cuts[1:]))
    assert got == want
    spread = s.select(F.explode(F.sequence(F.floor(F.col("s") / silence.BIN_MS), F.floor((F.col("e") - 1) / silence.BIN_MS)))).count()
    assert spread < 1.2 * len(sil)
    assert silence.edge_pairs(segments, s).count() <= 2 * len(want)
    trimmed = silence.trim(segments, s, f, 300)
    assert trimmed.count() == len(want)
    assert trimmed.where("export_start < raw_start or export_end > raw_end or export_end - export_start < 1").count() == 0
