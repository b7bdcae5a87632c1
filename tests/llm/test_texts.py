"""Text operators against brute force, exact round trips or held-out accuracy."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillwave.llm import language_id, line_templates, ngram_join, packing, sharding, stream_bpe, substring_dedup
from quillwave.llm.components import components
from quillwave.llm.vocabularies import vocabulary

DATA = "/root/testdata/sf0.01"
BLANK = re.compile("[\x20\x09-\x0d]+")


def words(text):
    return [w for w in BLANK.split(text or "") if w]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_bpe_round_trip(docs, rows):
    path = vocabulary("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    want = Counter()
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want[(i, len(ids), sha(",".join(map(str, ids))), sha(tok.decode(ids, skip_special_tokens=False)))] += 1
    assert Counter(map(tuple, stream_bpe.round_trip(docs, path).collect())) == want
    assert stream_bpe.round_trip(docs.limit(0), path).count() == 0


def test_bpe_stream_pieces(monkeypatch):
    monkeypatch.setattr(stream_bpe, "BLOCK", 64)
    m = stream_bpe.Merges(vocabulary("byte_bpe_50k.json"))
    tok = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    rnd = random.Random(1)
    for alphabet in ("ab", " \n", "a' s", "é漢 ", "!?", "1 a", " <|endoftext|>", "z"):
        for n in (0, 1, 63, 64, 65, 400, 1500):
            text = "".join(rnd.choice(alphabet) for _ in range(n))
            ids = [i for run in stream_bpe.Encoder(m).encode(text) for i in run]
            assert ids == tok.encode(text, add_special_tokens=False).ids
            assert "".join(stream_bpe.decode([ids], m)) == tok.decode(ids, skip_special_tokens=False)


def test_language_id(spark, docs):
    rnd = random.Random(2)
    kinds = {"xx": "aeioul", "yy": "krtzsch", "zz": "éàùçm"}
    rows = [(i, " ".join("".join(rnd.choice(kinds[k]) for _ in range(6)) for _ in range(40)), k if i % 7 else None) for i, k in enumerate(rnd.choice(list(kinds)) for _ in range(600))]
    truth = {i: next(k for k, a in kinds.items() if set(t.replace(" ", "")) <= set(a)) for i, t, _ in rows}
    df = spark.createDataFrame([*rows, (9001, None, "xx"), (9002, "12 !", "yy"), (None, "aeiou", None)], "doc_id long, text string, lang string")
    out = language_id.language_id(df).collect()
    held = [r for r in out if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 100 and np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.98
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"] if r["doc_id"] is not None else "").encode()) % 3 == 1) for r in out)
    assert {r["doc_id"]: (r["lang_pred"], r["score"], r["rejected"]) for r in out if r["doc_id"] in (9001, 9002)} == {9001: ("und", 0.0, True), 9002: ("und", 0.0, True)}
    assert all(0 <= r["score"] <= 1 for r in out)
    again = language_id.language_id(docs)  # odd rows, clashing columns
    assert again.count() == docs.count() and set(docs.columns) < set(again.columns)
    for left in ("h", "rest"):  # the odd columns keep their values
        assert Counter(map(tuple, again.select("doc_id", "text", left).collect())) == Counter(map(tuple, docs.select("doc_id", "text", left).collect()))
    unlabelled = language_id.language_id(df.withColumn("lang", F.lit(None).cast("string")))
    assert unlabelled.where("lang_pred <> 'und'").count() == 0
    assert language_id.language_id(df.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
def test_language_id_on_the_table(spark):
    """Held-out accuracy on the real table: documents that training never saw."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = language_id.language_id(docs).where("held_out and lang is not null and lang_pred <> 'und'").select("lang", "lang_pred", "rejected").collect()
    assert len(out) > 200 and np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.97
    assert np.mean([r["rejected"] for r in out]) < 0.03


def test_language_sample(spark, monkeypatch):
    """Long texts are drawn like short ones, repeated rows once, and rare languages give way beyond the bound."""
    monkeypatch.setattr(language_id, "SAMPLE_PER_LANGUAGE", 30)
    rows = [(i, f"kurz {i}", "kk") for i in range(500)] + [(None, "wieder", "kk")] * 400 + [(2000 + i, f"{i} " + "lang " * 40_000, "ll") for i in range(12)]
    rows += [(3000 + i, f"mm {i}", "mm") for i in range(9)] + [(4000, "selten", "zz"), (5000, "", "kk"), (5001, None, "kk"), (5002, "x", None)]
    sample = language_id.training_sample(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5), 3).collect()
    fit = {k: sum(zlib.crc32(str(i if i is not None else "").encode()) % 3 != 1 for i in {r[0] for r in rows if r[2] == k and r[1]}) for k in ("ll", "mm")}
    assert Counter(r["lang"] for r in sample) == {"kk": 30, **fit}
    assert all(sum(r["n"]) > 400_000 for r in sample if r["lang"] == "ll") and len({r["h"] for r in sample}) == len(sample)


def test_packing(docs, rows):
    path, size = vocabulary("word_bpe_49k.json"), 256
    tok = Tokenizer.from_file(path)
    want = Counter()
    for i, t in rows:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for k, a in enumerate(range(0, len(ids), size)):
            want[(i, k, a, len(ids[a : a + size]), zlib.crc32(ids[a : a + size].tobytes()))] += 1
    out = packing.pack(docs, path, size).toPandas()
    assert Counter((r.doc_id if r.doc_id == r.doc_id else None, r.piece, r.start, r.length, r.ids_crc32) for r in out.itertuples()) == want
    for _, s in out.sort_values("offset").groupby("sequence_id"):
        assert list(s.offset) == [0, *np.cumsum(s.length)[:-1]] and s.length.sum() <= size
        assert (3 * s.length > size).sum() <= 2
    assert out.sequence_id.nunique() <= 1.02 * np.ceil(out.length.sum() / size) + 1
    assert packing.pack(docs.limit(0), path, size).count() == 0


def test_packing_of_one_repeated_row(spark, monkeypatch):
    """Equal pieces are ranked in several cells, and still placed without gaps."""
    monkeypatch.setattr(packing, "CELL_ROWS", 16)
    out = packing.pack(spark.createDataFrame([(None, "")] * 500 + [(7, "a b c")], "doc_id long, text string"), vocabulary("word_bpe_49k.json"), 16).toPandas()
    assert len(out) == 501 and (out.length == 1).sum() == 500
    for _, s in out.sort_values("offset").groupby("sequence_id"):
        assert list(s.offset) == [0, *np.cumsum(s.length)[:-1]] and s.length.sum() <= 16
    assert out.sequence_id.nunique() == -(-int(out.length.sum()) // 16)


def test_packing_of_other_vocabularies(docs, rows):
    """A vocabulary whose ids depend on blanks gets whole texts."""
    path = vocabulary("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    assert not packing.loaded(path).by_words and packing.loaded(vocabulary("word_bpe_49k.json")).by_words
    some = docs.where("length(text) < 500 or text is null")
    out = some.select("doc_id", "text")
    want = Counter()
    for i, t in out.collect():
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for a in range(0, len(ids), 64):
            want[i, a, zlib.crc32(ids[a : a + 64].tobytes())] += 1
    assert Counter((r["doc_id"], r["start"], r["ids_crc32"]) for r in packing.pack(some, path, 64).collect()) == want


@pytest.mark.parametrize("seed", range(6))
def test_packing_plan(seed):
    rnd = random.Random(seed)
    size = rnd.choice([10, 97, 512])
    counts = Counter(rnd.randrange(1, size + 1) if rnd.random() < 0.8 else size // 3 for _ in range(rnd.choice([1, 50, 3000])))
    seen, bins = Counter(), defaultdict(list)
    for n, a, b, first, each, offset in packing.plan(dict(counts), size):
        for r in range(a, b):
            seen[n, r] += 1
            bins[first + (r - a) // each].append((offset + (r - a) % each * n, n))
    assert set(seen.values()) == {1} and Counter(n for n, _ in seen) == counts
    for items in bins.values():
        at = 0
        for o, n in sorted(items):
            assert o == at
            at += n
        assert at <= size
    # First fit decreasing never needs fewer by more than a few.
    gaps = []
    for n in sorted(counts.elements(), reverse=True):
        k = next((i for i, g in enumerate(gaps) if g >= n), None)
        if k is None:
            gaps.append(size - n)
        else:
            gaps[k] -= n
    assert len(bins) <= len(gaps) * 1.03 + 1


def test_substring_dedup(docs, rows):
    order = sorted({(i if i is not None else -(1 << 63), t) for i, t in rows if t is not None})
    seen, gone = {}, {}
    for i, t in order:
        w = words(t)
        gone[i, t] = [False] * len(w)
        for s in range(len(w) - 19):
            k = tuple(w[s : s + 20])
            if k in seen:
                gone[i, t][s : s + 20] = [True] * 20
            seen.setdefault(k, (i, s))
    want = Counter()
    for i, t in rows:
        w, g = words(t), gone.get((i if i is not None else -(1 << 63), t), [])
        want[(i, len(w), sum(g), None if t is None else " ".join(x for x, y in zip(w, g) if not y))] += 1
    out = substring_dedup.substring_dedup(docs, one_space=True)
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in out.collect()) == want
    assert set(out.columns) == set(docs.columns) | {"n_removed"}
    soft = substring_dedup.substring_dedup(docs).collect()
    clean = {t for _, t in rows}
    assert all(r["text"] in clean for r in soft if r["n_removed"] == 0)
    assert Counter((r["doc_id"], " ".join(words(r["text"]))) for r in soft) == Counter((r["doc_id"], r["text"] or "") for r in out.collect())
    assert substring_dedup.substring_dedup(docs.limit(0)).count() == 0


def test_ngram_join(docs, rows):
    def grams(t):
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()

    low = -(1 << 63)
    items = [(low if i is None else i, grams(t)) for i, t in rows]
    parent = {i: i for i, _ in items}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(items):
        for j, y in items[:a]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                u, v = find(i), find(j)
                parent[max(u, v)] = min(u, v)
    show = lambda i: None if i == low else i
    want = Counter((show(i), len(x), show(find(i))) for i, x in items)
    out = ngram_join.ngram_join(docs)
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out.collect()) == want
    distinct = {x for _, x in items if x}
    degree = {x: sum(1 for y in distinct if y != x and 100 * len(x & y) >= 80 * len(x | y)) for x in distinct}
    of = dict(items)
    assert all(r["n_links"] == degree.get(of[r["doc_id"]], 0) for r in out.collect() if r["doc_id"] is not None)
    assert ngram_join.ngram_join(docs.limit(0)).count() == 0


@pytest.mark.parametrize("percent", [50, 80, 100])
def test_ngram_join_blocks(spark, monkeypatch, percent):
    """A cluster over many blocks and size bands, with an id that many rows share and one without."""
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    rnd = random.Random(6)
    base = [f"w{k}" for k in range(300)]
    rows = [(k + 1, " ".join(base[a : a + n])) for k, (a, n) in enumerate((rnd.randrange(60), rnd.choice([6, 7, 9, 20, 24, 60, 75, 90, 240])) for _ in range(90))]
    rows += [(i, " ".join(base[k : k + 200])) for i in (500, None) for k in range(0, 40, 5)]
    low = -(1 << 63)
    items = [(low if i is None else i, frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))) for i, w in ((i, t.split()) for i, t in rows)]
    parent = {i: i for i, _ in items}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(items):
        for j, y in items[:a]:
            if 100 * len(x & y) >= percent * len(x | y):
                u, v = find(i), find(j)
                parent[max(u, v)] = min(u, v)
    show = lambda i: None if i == low else i
    out = ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), percent=percent).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out) == Counter((show(i), len(x), show(find(i))) for i, x in items)


def test_linked_blocks(monkeypatch):
    monkeypatch.setattr(ngram_join, "INNER", 16)
    rnd = np.random.default_rng(0)
    base = rnd.choice(10_000, 60, replace=False)
    sets = [np.unique(np.concatenate([base[rnd.random(60) > p], rnd.choice(10_000, 4)])) for p in rnd.random(40) * 0.3]
    want = np.array([[100 * len(set(a) & set(b)) >= 80 * len(set(a) | set(b)) for b in sets] for a in sets])
    own = rnd.random(40) < 0.5
    assert (ngram_join.linked(sets, np.ones(40, bool), 80) == np.triu(want, 1)).all()
    assert (ngram_join.linked(sets, own, 80) == (want & own[:, None] & ~own[None, :])).all()


def test_components(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(1000 + k, 1001 + k) for k in range(40)] + [(5000, 6000 + k) for k in range(200)] + [(None, 1), (7, 7)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None:
            u, v = find(a), find(b)
            parent[max(u, v)] = min(u, v)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_line_dedup(spark, docs, rows):
    out = line_templates.line_dedup(docs, spare_copies=True)
    got = out.collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    assert sum(r["n_dropped"] for r in got) == 30 and all("was printed" not in (r["text"] or "") for r in got)
    same = {t for _, t in rows}
    assert all(r["text"] in same for r in got if not r["n_dropped"])
    assert all(r["n_lines"] == (0 if t is None else t.count("\n") + 1) for r in got if not r["n_dropped"] for t in [r["text"]])
    assert set(out.columns) == set(docs.columns) | {"n_lines", "n_dropped"}
    assert line_templates.line_dedup(docs.limit(0)).count() == 0


def test_line_dedup_of_any_share_and_length(spark):
    """Recurring lines go from every document, short ones and those that make up most of it, too."""
    pages = [(i, f"Share\nab cd\na b c d\nmostly the same text here\n\nunique{i} {'x' * (i % 3)}") for i in range(20)]
    other = [(100 + i, f"Share it\n{'y ' * i}") for i in range(9)]  # one document too few
    out = {r["doc_id"]: r for r in line_templates.line_dedup(spark.createDataFrame(pages + other, "doc_id long, text string").repartition(3)).collect()}
    assert all(out[i]["text"] == t.split("\n", 4)[4] and out[i]["n_dropped"] == 4 for i, t in pages if "3" not in t)
    assert all(out[i]["text"] == t for i, t in other)


def test_very_long_texts(spark, rows):
    """A text of three million characters in one line, in many lines, and as one word."""
    rnd = random.Random(3)
    long = " ".join(f"v{rnd.randrange(10**6)}" for _ in range(400_000))
    texts = [long, long.replace(" ", "\n"), "q" * 3_000_000, long + " end"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    out = {r["doc_id"]: r for r in line_templates.line_dedup(df).collect()}
    assert all(out[i]["text"] == t for i, t in enumerate(texts) if i != 1) and out[1]["n_lines"] == 400_000
    out = {r["doc_id"]: r for r in substring_dedup.substring_dedup(df).collect()}
    assert [out[i]["n_removed"] for i in range(4)] == [0, 400_000, 0, 400_000]
    out = {r["doc_id"]: r["component_id"] for r in ngram_join.ngram_join(df).collect()}
    assert out == {0: 0, 1: 0, 2: 2, 3: 0}
    known = language_id.language_id(df.withColumn("lang", F.lit("xx"))).collect()
    assert {r["lang_pred"] for r in known} == {"xx"}


def simulated(cells, shards, vnodes=32, size=1 << 13):
    """Row by row: (cell, shard) counts of a ring whose full shards pass rows on clockwise."""
    nodes = {}
    for n in range(vnodes):
        for k in range(shards):
            at = int(hashlib.sha256(f"{k}/{n}".encode()).hexdigest()[:16], 16) % size
            while at in nodes:
                at = (at + 1) % size
            nodes[at] = k
    ends = sorted(nodes)
    room = {k: len(cells) // shards + (k < len(cells) % shards) for k in range(shards)}
    arc = {c: next((i for i, e in enumerate(ends) if e >= c), 0) for c in set(cells)}
    last = ends[-1]
    out, late = Counter(), []
    for c in sorted(cells, key=lambda c: (arc[c], (c - last - 1) % size)):  # clockwise from behind the last node
        k = nodes[ends[arc[c]]]
        if room[k]:
            room[k] -= 1
            out[c, k] += 1
        else:
            late.append(c)
    for c in late:
        i = arc[c]
        while not room[nodes[ends[i]]]:
            i = (i + 1) % len(ends)
        room[nodes[ends[i]]] -= 1
        out[c, nodes[ends[i]]] += 1
    return out


@pytest.mark.parametrize("shards", [8, 3])
def test_ring(spark, monkeypatch, shards):
    """Against a ring walked row by row, with a third of all rows alike and more than a part holds."""
    monkeypatch.setattr(sharding, "PART_ROWS", 50)
    rows = [(None, "", "clash", 1)] * 700 + [(i, f"t{i % 90}", "clash", 1) for i in range(1300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string, `a.b` int").repartition(5)
    key = F.struct("doc_id", "text")
    out = sharding.bounded_ring(docs, shards, key, ["doc_id", "text"])
    assert out.columns == ["doc_id", "text", "a.b", "shard", "slot"]
    got = out.withColumn("cell", F.pmod(F.xxhash64(key), F.lit(1 << 13))).select("cell", "shard", "slot").collect()
    assert Counter((r["cell"], r["shard"]) for r in got) == simulated([r["cell"] for r in got], shards)
    for k in range(shards):
        slots = sorted(r["slot"] for r in got if r["shard"] == k)
        assert slots == list(range(len(slots)))


def test_sharding(spark, docs, rows):
    out = sharding.shard_documents(docs).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    by = defaultdict(list)
    for r in out:
        by[r["shard"]].append(r["slot"])
    assert set(by) == set(range(8)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert {(r["law"], r["grown_shard"]) for r in out} == {("rows", None)}
    assert sharding.shard_documents(docs.limit(0)).count() == 0
    many = spark.range(6000).selectExpr("id doc_id", "cast(id as string) text")
    one, two = ({r["doc_id"]: r["shard"] for r in sharding.shard_documents(many, k).collect()} for k in (8, 9))
    assert sum(one[i] != two[i] for i in one) < 0.45 * len(one)


