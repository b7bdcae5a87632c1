"""Both vector searches against brute force."""

import math
import random

import numpy as np
import pytest

from quillwave.llm import hash_forest, topk_search
from quillwave.llm.hash_forest import nearest
from quillwave.llm.topk_search import exact_top_k

SCHEMA = "vec_id long, embedding array<float>, score string, query_id string"  # clashing extra columns


def vectors(n=400, d=8, seed=0):
    rnd = random.Random(seed)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(d)], "x", "y") for i in range(n)]
    hot = rows[7][1]
    rows += [(10_000 + i, hot, None, None) for i in range(150)]  # a third of copies
    rows += [(20000, None, "", ""), (20050, [], "", ""), (20100, [1.0, None] * (d // 2), "", ""), (20150, [math.nan] * d, "", ""), (20200, [math.inf] * d, "", "")]
    rows += [(20250, [0.0] * d, "", ""), (20300, [1.0, 2.0], "", ""), (None, [1.0] * d, "", ""), (21000, [1e6] * d, "", "")]
    return rows


def usable(rows, d=8):
    return [(i, np.array(v, np.float32).astype(float)) for i, v, *_ in rows if i is not None and v and len(v) == d and all(x is not None and math.isfinite(x) for x in v)]


@pytest.mark.parametrize("k,block", [(5, 2048), (3, 4), (1000, 2048)])
def test_exact_top_k(spark, monkeypatch, k, block):
    monkeypatch.setattr(topk_search, "query_blocks", lambda q, b=block, f=topk_search.query_blocks: f(q, b))
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {}
    for r in exact_top_k(df, df.where("vec_id % 50 = 0"), k).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    whole = {i: np.floor(256 * v).astype(np.int64) for i, v in usable(rows)}
    for q in (i for i in whole if i % 50 == 0):
        best = sorted((-int(whole[q] @ whole[c]), c) for c in whole if c != q)[:k]
        assert sorted(got.pop(q)) == [(n + 1, -s, c) for n, (s, c) in enumerate(best)]
    assert set(got) <= {20300}


def test_exact_top_k_few(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (50, [3.0, 4.0])], "vec_id long, embedding array<float>")
    assert {(r["query_id"], r["vec_id"]) for r in exact_top_k(df, df, 5).collect()} == {(0, 50), (50, 0)}
    assert exact_top_k(df.limit(0), df, 5).count() == 0 and exact_top_k(df, df.limit(0), 5).count() == 0
    twice = exact_top_k(df.union(df), df.where("vec_id = 0"), 5).collect()
    assert [(r["rank"], r["vec_id"]) for r in sorted(twice, key=lambda r: r["rank"])] == [(1, 50), (2, 50)]


def test_exact_top_k_of_large_components(spark):
    """Every finite float and double, against Python's integers; scores beyond a long count as the end of its range."""
    rnd = random.Random(9)
    rows = [(i, [rnd.gauss(0, 1) * rnd.choice([1.0, 1.0, 2e7, 1e8, 1e20, 3e38]) for _ in range(6)]) for i in range(300)]
    rows += [(1000, [1e300, 0.0, 0.0, 0.0, 0.0, 1.7e308]), (1050, [1.7e308] * 6), (1100, [1e20, -1e20, 5.0, 0.0, 0.0, 0.0]), (1101, [1.0, 1.0, 3.0, 0.0, 0.0, 0.0]), (1150, [0.0] * 6)]
    whole = {i: [int(v) * 256 if abs(v) > 2**60 else math.floor(256 * v) for v in x] for i, x in rows}
    top = 2**63 - 1
    for limit in (1e9, math.inf):  # without and with scores beyond a long
        some = [r for r in rows if max(map(abs, r[1])) < limit]
        df = spark.createDataFrame(some, "vec_id long, embedding array<double>").repartition(3)
        got = {}
        for r in exact_top_k(df, df.where("vec_id % 50 = 0"), 7).collect():
            got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
        for q in (i for i, _ in some if i % 50 == 0):
            score = {c: max(-top, min(top, sum(x * y for x, y in zip(whole[q], whole[c])))) for c, _ in some if c != q}
            assert sorted(got.pop(q)) == [(n + 1, s, c) for n, (s, c) in enumerate(sorted(((s, c) for c, s in score.items()), key=lambda x: (-x[0], x[1]))[:7])]
        assert not got


def clustered(n=6000, d=16, seed=1):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(60, d))
    x = centres[rnd.integers(0, 60, n)] + 0.15 * rnd.normal(size=(n, d))
    return [(i, [float(v) for v in row], "x", "y") for i, row in enumerate(x)]


@pytest.mark.parametrize("rows", [vectors(3000), clustered()], ids=["directions", "clusters"])
def test_nearest(spark, rows):
    """Recall of the shipped parameters against brute force, and exact scores."""
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    d = len(rows[0][1])
    got = {}
    for r in nearest(df, df.where("vec_id % 100 = 0"), 10).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    have = {i: v for i, v in usable(rows, d) if v.any()}
    hit = total = 0
    for q in (i for i in have if i % 100 == 0):
        best = sorted((float(np.sqrt(((have[q] - have[c]) ** 2).sum())), c) for c in have if c != q)[:10]
        mine = sorted(got.pop(q))
        assert [n for n, _, _ in mine] == list(range(1, 11))
        assert all(s == pytest.approx(float(np.sqrt(((have[q] - have[c]) ** 2).sum()))) for _, s, c in mine)
        assert [(s, c) for _, s, c in mine] == sorted((s, c) for _, s, c in mine)
        hit += len({c for _, c in best} & {c for _, _, c in mine})
        total += 10
    assert hit / total >= 0.9 and not got


def test_forest_prunes_clusters():
    """With the shipped parameters a small share of clustered rows is scored, and a stored forest answers alike."""
    rows = [(i, np.array(v)) for i, v, *_ in clustered(8000)]
    ids, x = np.array([i for i, _ in rows]), np.stack([v for _, v in rows])
    forests = [hash_forest.Forest(ids[a : a + 4096], x[a : a + 4096], 11) for a in range(0, len(ids), 4096)]
    forests = [hash_forest.Forest.of(f.stored()) for f in forests]
    q = ids % 100 == 0
    first = {}
    scored = 0
    for f in forests:
        for i, _, d, c, n in f.search(ids[q], x[q], 10, wanted=max(20, hash_forest.FIRST * f.count)):
            first.setdefault(i, []).extend(zip(d, c))
            scored += n
    cosine = np.array([min(c for _, c in sorted(first[i])[:10]) for i in ids[q]])
    for f in forests:
        scored += sum(n for *_, n in f.search(ids[q], x[q], 10, level=hash_forest.levels(cosine, hash_forest.RECALL)))
    assert scored < 0.25 * q.sum() * len(ids)


def test_nearest_extremes(spark):
    """Components near the largest double, and a copy of the query."""
    rows = [(0, [1e308, -1e308]), (100, [1e308, -1e308]), (7, [-1e308, 1e308]), (8, [1e-300, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in nearest(df, df.where("vec_id % 100 = 0"), 10).collect())
    assert out[0] == (0, 1, 100) and out[3] == (100, 1, 0)


def test_nearest_few(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (100, [1.0, 0.0]), (5, [1.0, 0.0])], "vec_id long, embedding array<float>")
    out = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in nearest(df, df.where("vec_id % 100 = 0"), 10).collect())
    assert out == [(0, 1, 5, 0.0), (0, 2, 100, 0.0), (100, 1, 0, 0.0), (100, 2, 5, 0.0)]
    assert nearest(df.limit(0), df, 3).count() == 0
