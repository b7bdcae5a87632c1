"""The pipeline's stages, each on what the one before kept."""

import random
import re
from collections import Counter

import corpus_pipeline
from quillwave.llm import shared
from quillwave.llm.shared import persisted


def test_stages(spark, docs, rows):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_duplicates", "substring_dedup", "packing"]
    now, ids = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        now = persisted(stage(spark, now, ""))
        if name != "packing":
            assert now.columns == docs.columns
            ids[name] = [r["doc_id"] for r in now.select("doc_id").collect()]
    assert set(ids["line_dedup"]) == set(ids["language_id"]) == {i for i, t in rows if t and any(c.isalpha() for c in t)}
    assert set(ids["near_duplicates"]) < set(ids["line_dedup"]) and ids["substring_dedup"] and set(ids["substring_dedup"]) == set(ids["near_duplicates"])
    assert {r["doc_id"] for r in now.collect()} == set(ids["substring_dedup"])
    assert len([i for i in ids["near_duplicates"] if 73 * 3 <= (i or 0) <= 133 * 3]) < 60  # the near copies


def test_foreign_columns(spark, docs):
    """Columns that bear names of the operators' own come through with their values and types."""
    odd = docs.withColumnRenamed("h", "score").withColumnRenamed("rest", "rejected").withColumnRenamed("n", "_letters").withColumnRenamed("d", "a.b")
    odd = odd.withColumnRenamed("shard", "row").withColumnRenamed("length", "n_dropped")
    kinds, now = odd.dtypes, odd
    want = {repr(tuple(r)) for r in odd.drop("text").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = persisted(stage(spark, now, ""))
        assert now.dtypes == kinds, name
        left = [repr(tuple(r)) for r in now.drop("text").collect()]
        assert left and set(left) <= want, name


def brute_copies(rows):
    """The rows that stay: one of each component, the smallest id first."""
    sets = [frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if (w := re.sub("[A-Z]", lambda m: m[0].lower(), t).split()) else frozenset() for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    best = {}
    for k, (i, _) in enumerate(rows):
        best[find(k)] = min(best.get(find(k), (i, k)), (i, k))
    return sorted(rows[k] for _, k in best.values())


def brute_passages(rows):
    """(id, kept words) of ascending rows without the windows of 20 words that came before."""
    seen, out = set(), []
    for i, t in rows:
        w = t.split()
        gone = [False] * len(w)
        for s in range(len(w) - 19):
            if tuple(w[s : s + 20]) in seen:
                gone[s : s + 20] = [True] * 20
            seen.add(tuple(w[s : s + 20]))
        out.append((i, [x for x, y in zip(w, gone) if not y]))
    return out


def test_against_brute_force(spark):
    """200 documents through the stages, each checked on what the one before kept."""
    rnd = random.Random(12)
    lexicon = ["".join(rnd.choice("abcdefghijklmno") for _ in range(rnd.randrange(2, 9))) for _ in range(2000)]
    prose = lambda n: " ".join(rnd.choice(lexicon) for _ in range(n))
    base, passage = [prose(rnd.choice([15, 60, 150])) for _ in range(120)], prose(40)
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(200 + i, f"{base[i]} {prose(1)}") for i in range(30)] + [(300 + i, base[i]) for i in range(20)] + [(300, base[0]), (None, "12 34"), (401, None)]
    rows += [(500 + i, f"{prose(20)}\nShare this page with {prose(1)}\n{passage if i % 2 else prose(9)} {prose(20)}") for i in range(27)]
    docs = spark.createDataFrame([(i, t, "xx") for i, t in rows], "doc_id long, text string, lang string").repartition(4)
    stages = dict(corpus_pipeline.STAGES)
    got = lambda df: sorted((r["doc_id"], r["text"]) for r in df.collect())

    now = persisted(stages["language_id"](spark, docs, ""))
    kept = got(now)
    assert set(kept) <= {(i, t) for i, t in rows if t and any(c.isalpha() for c in t)} and len(kept) >= 195
    now = persisted(stages["line_dedup"](spark, now, ""))
    assert got(now) == sorted((i, "\n".join(x for x in t.split("\n") if not x.startswith("Share this page"))) for i, t in kept)
    kept = got(now)
    now = persisted(stages["near_duplicates"](spark, now, ""))
    assert got(now) == brute_copies(kept)
    kept = got(now)
    now = persisted(stages["substring_dedup"](spark, now, ""))
    assert [(i, t.split()) for i, t in got(now)] == brute_passages(kept)
    pieces = stages["packing"](spark, now, "").collect()
    assert Counter(r["doc_id"] for r in pieces) == Counter(i for i, _ in kept) and all(r["offset"] + r["length"] <= 4096 for r in pieces)


def test_run(spark, monkeypatch, tmp_path):
    """The whole run equals its stages, and leaves its results alone behind."""
    monkeypatch.setattr(shared, "CHECKPOINT_DIR", "quillwave.no.such.setting")
    spark.conf.set(shared.SHARED_DIR, f"file://{tmp_path}")
    try:
        out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
        assert out.count() > 100 and out.columns[0] == "doc_id" and len(list(tmp_path.iterdir())) == len(corpus_pipeline.STAGES)
    finally:
        spark.conf.unset(shared.SHARED_DIR)


def test_empty(spark, docs):
    now = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        now = persisted(stage(spark, now, ""))
    assert now.count() == 0
