"""Conversation repair, importance resampling and mixing against plain Python versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quillwave.llm import conversation_repair as cr
from quillwave.llm import importance, mixing, shared


@pytest.fixture
def many_partitions(spark):
    """Ranges stay apart, as on large tables."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def least_edits(rows):
    """(cost, audit, repaired turns) by a table over turns and states, strings and all; rows: (role, text, fault)."""
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    best = {"": (0, "", ())}

    def put(to, state, value):
        if state not in to or value < to[state]:
            to[state] = value

    def inserted(now):
        for _ in range(3):
            for s, (c, a, left) in list(now.items()):
                put(now, follow[s], (c + 3, a + "I", (*left, f"{names[follow[s]]}:")))
        return now

    for role, text, fault in rows:
        to = {}
        for s, (c, a, left) in inserted(best).items():
            put(to, s, (c + 4, a + "D", left))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault == "truncated" else 0
            put(to, follow[s], (c + 3 + more, a + "R", (*left, f"{names[follow[s]]}:{text}")))
            r = role[:1]
            if (s, r) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                put(to, r, (c + more, a + "K", (*left, f"{role}:{text}")))
        best = to
    best = inserted(best)
    return min(best[s] for s in ("", "a") if s in best)


def repaired(rows):
    """What the query returns for rows (turn, role, text) of one conversation, nulls being a space."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    key = lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).hexdigest())
    rows, seen, faults = sorted(rows, key=key), set(), []
    for _, r, x in rows:
        blank = not re.search("[^ \t-\r]", x)
        faults.append("blank" if blank else "duplicate" if (r, x) in seen else None if re.search(r"[.!?][ \t-\r]*\Z", x) else "truncated")
        seen.add((r, x))
    cost, audit, left = least_edits([(r, x, f) for (_, r, x), f in zip(rows, faults)])
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return gaps, *(faults.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest()


@pytest.mark.parametrize("block", [256, 3])
def test_conversations(spark, monkeypatch, many_partitions, block):
    """Every kind of turn, blocks of all sizes; with blocks of three, long conversations go through many of them."""
    monkeypatch.setattr(cr, "BLOCK", block)
    rnd = random.Random(block)
    roles, texts = ["user", "assistant", "system", "user", "assistant", "tool", "Sam", "", None], ["Yes.", "no", "", " \t", "What?", "　", None, "Go! ", "long " * 3000 + "."]
    talks = {i: [(None if rnd.random() < 0.05 else j + rnd.randrange(2), rnd.choice(roles), f"{rnd.choice(texts)}" if rnd.random() < 0.2 else rnd.choice(texts[:1] + [f"t{j}.", f"t{j}"])) for j in range(rnd.choice([1, 2, 3, 5, 9, 40]))] for i in range(120)}
    talks[None] = [(0, "user", "Hi."), (1, "assistant", None)]
    talks[5] += talks[5]
    talks[7] = [(None, "user", "a.")] * 70 + [(None, "assistant", "b.")] * 30
    rows = [(k, *r, "extra", 1) for k, v in talks.items() for r in v]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, k string, place int").repartition(5)
    got = {r[0]: tuple(r)[1:] for r in cr.conversation_repair(df).collect()}
    assert got.keys() == talks.keys()
    for k, v in talks.items():
        assert got[k] == repaired(v), (k, v)


def test_damage_and_edges(spark):
    rows = [(i, j, ["user", "assistant"][j % 2], f"Text {i}, {j}. Yes!") for i in range(60) for j in range(2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    left = defaultdict(list)
    for i, j, r, t in rows:
        z = zlib.crc32(f"{i}:{j}".encode()) % 20
        if z:
            t = "" if z == 1 else re.sub("[.!?]", "", t) if z == 2 else t
            left[i] += [(j, "user" if z == 4 else r, t)] * (2 if z == 3 else 1)
    got = {r[0]: tuple(r)[1:] for r in cr.conversation_repair(df, cr.damaged(df)).collect()}
    assert got == {i: repaired(left[i]) for i in range(60)}
    gone = cr.conversation_repair(df.limit(3), cr.damaged(df).limit(0)).first()
    assert gone["cost"] == 0 and gone["audit"] == "" and gone["repaired_sha256"] == hashlib.sha256().hexdigest()
    assert cr.conversation_repair(df.limit(0)).count() == 0
    turns = cr.repaired_turns(cr.damaged(df))
    assert {r["edit"] for r in turns.select("edit").distinct().collect()} <= {"Keep", "Rerole", "Delete", "Insert"}


def test_layers_of_long_conversations():
    """The least cost over random turns, all at once and block by block."""
    rnd = random.Random(2)
    for _ in range(200):
        turns = "".join(rnd.choice("suaSUAxXd") for _ in range(rnd.randrange(0, 30)))
        rows = [({"x": "tool", "d": "user"}.get(t.lower(), t.lower()), "t", "blank" if t == "d" else "truncated" if t.isupper() else None) for t in turns]
        cost, audit, _ = least_edits(rows)
        pieces = "".join(cr.whole(turns))
        if turns:
            assert pieces.translate(str.maketrans("ijrq", "IIRR")) == audit
        cut = rnd.randrange(0, len(turns) + 1)
        a, b = cr.transfer(turns[:cut]), cr.transfer(turns[cut:])
        base = sum(4 if t in "dX" else 3 if t in "xSUA" else 0 for t in turns)
        assert base + min(a[q] + b[4 * q + e] for q in range(4) for e in (0, 3)) == cost


def test_numbers_within_groups(spark, many_partitions):
    df = spark.range(3000).selectExpr("IF(id % 3 < 2, 0, id % 50) g", "IF(id % 7 = 0, NULL, id % 11) a", "id", "'x' place").repartition(7)
    rows = shared.numbered_within(df, ["g"], [F.col("a").asc_nulls_first(), F.col("id").desc()], "n").collect()
    want = Counter()
    for r in sorted(rows, key=lambda r: (r["g"], r["a"] is not None, r["a"] or 0, -r["id"])):
        assert r["n"] == want[r["g"]]
        want[r["g"]] += 1
    flat = shared.numbered(df, [F.col("id").desc()], "n").collect()
    assert all(r["n"] == 2999 - r["id"] for r in flat) and len(flat) == 3000
    assert shared.numbered_within(df.limit(0), ["g"], [F.col("a").asc()], "n").count() == shared.numbered(df.limit(0), [F.col("a").asc()], "n").count() == 0


def resampled(docs, target, percent, longest, least, buckets=10_000):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def runs(text):
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(low))
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    each = [(d, *runs(t)) for d, t in docs]
    s, t = Counter(b for _, _, f in each for b in f), Counter(b for x in target for b in runs(x)[1])
    all_s, all_t = s.total(), t.total()
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in s}
    rows = []
    for d, n, f in each:
        w = sum(gain[b] for b in f)
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((d, n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((i for i, r in enumerate(rows) if r[1] >= least), key=lambda i: (-rows[i][4], rows[i][0] is None, rows[i][0] or 0))
    ranks = {i: k + 1 for k, i in enumerate(order[: percent * len(order) // 100])}
    return Counter((d, f, w, x, ranks.get(i)) for i, (d, _, f, w, x) in enumerate(rows))


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling(spark, docs, rows, many_partitions, longest):
    target = ["w1 w2 W3 w3 w3 É", None, "", "w7 w8-w9 w10 漢字"]
    got = importance.importance_resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), percent=40, longest=longest, least_words=5)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    assert Counter(tuple(r) for r in got.collect()) == resampled(rows, target, 40, longest, 5)
    assert importance.importance_resample(docs.limit(0), docs.select("text")).count() == 0
    assert importance.importance_resample(docs.limit(3), docs.select("text").limit(0)).where("rank is not null").count() == 0


def mixed(rows, percent, weights, most):
    """(source -> target), (source, size -> copies in all) by bisection on each source's tilt."""
    sizes = defaultdict(Counter)
    for s, n in rows:
        sizes[s][n] += 1
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    words = {s: sum(n * c for n, c in sizes[s].items()) for s in order}
    share = percent / 100 * sum(words.values())
    target, open_ = {}, set(order)
    while True:
        rate = (share - sum(target.values())) / (sum(weight[s] for s in open_) or 1)
        full = {s for s in open_ if most * words[s] <= rate * weight[s]}
        target |= {s: float(most * words[s]) for s in full}
        open_ -= full
        if not full:
            break
    target |= {s: rate * weight[s] for s in open_}
    copies = {}
    for s in order:
        if not words[s]:
            continue
        scale = sum(n * n * c for n, c in sizes[s].items()) / words[s]
        f = lambda x: {n: min(most, math.exp(min(700, x * n / scale))) for n in sizes[s] if n}  # noqa: B023, E731
        low, high = -1e4, 1e4
        for _ in range(200):
            x = (low + high) / 2
            if sum(r * n * sizes[s][n] for n, r in f(x).items()) < target[s]:
                low = x
            else:
                high = x
        rates = f(high) if target[s] < most * words[s] * (1 - 1e-12) else {n: most for n in sizes[s] if n}
        over = 0.0
        for n in sorted(rates, reverse=True):
            want = sizes[s][n] * rates[n] + over / n
            copies[s, n] = min(max(round(want), 0), most * sizes[s][n])
            over = (want - copies[s, n]) * n
    return target, copies


def test_mixing(spark, many_partitions):
    rnd = random.Random(6)
    rows = []
    for s, n, low in (("b", 300, 1), ("a", 40, 50), (None, 120, 1), ("é", 60, 5), ("Z", 10, 0), ("hot", 900, 7), ("none", 4, None), ("", 30, 3)):
        for _ in range(n):
            size = 0 if low is None else 7 if s == "hot" and rnd.random() < 0.8 else rnd.randrange(low, low + 40)
            rows.append((s, size))
    docs = [(i if i % 50 else None, "  ".join(["w"] * n) + "\n" if n else rnd.choice([None, "", " \t"]), s, 1, "x") for i, (s, n) in enumerate(rows)]
    docs += [docs[5]] * 6
    rows += [rows[5]] * 6
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, size int, target string").repartition(6)
    out = mixing.mix(df, 150).collect()
    assert Counter((r["doc_id"], r["size"]) for r in out) == Counter((d[0], n) for d, (_, n) in zip(docs, rows))
    target, copies = mixed(rows, 150, (3, 1, 2), 2)
    where = {d[0]: d[2] for d in docs if d[0] is not None}
    total = Counter(s for s, _ in rows)
    assert sum(target.values()) == pytest.approx(1.5 * sum(n for _, n in rows)) and total
    taken, sums = Counter(), Counter()
    for r in out:
        assert r["taken"] == r["size"] * r["copies"] <= 2 * r["size"]
        if r["doc_id"] is not None:
            assert r["target"] == pytest.approx(target[where[r["doc_id"]]])
            assert r["source_size"] == sum(n for s, n in rows if s == where[r["doc_id"]])
        sums[round(r["target"], 6)] += r["taken"]
        taken[round(r["target"], 6), r["size"]] += r["copies"]
    key = {s: next(k for k in sums if abs(k - t) < 1e-4) for s, t in target.items() if t}
    assert len(set(key.values())) == len(key)
    for s, t in target.items():
        if t:
            assert abs(sums[key[s]] - t) <= max(n for x, n in rows if x == s) / 2 + 1
    for (s, n), c in copies.items():
        assert taken[key[s], n] == c, (s, n)
    again = mixing.mix(df.repartition(3), 150).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, out))
    assert mixing.mix(df.limit(0)).count() == 0


def test_mixing_one_document(spark):
    df = spark.createDataFrame([(1, "a b c", "s")], "doc_id long, text string, source string")
    assert [tuple(r) for r in mixing.mix(df).collect()] in ([(1, 3, 3, 4.5, 3, 1)], [(1, 3, 3, 4.5, 6, 2)])
    empty = spark.createDataFrame([(1, None, None), (2, "", "s")], "doc_id long, text string, source string")
    assert {tuple(r) for r in mixing.mix(empty).collect()} == {(1, 0, 0, 0.0, 0, 0), (2, 0, 0, 0.0, 0, 0)}


def test_reads_of_archives(spark, tmp_path):
    """Reads are as many as the spans, not as the records."""
    from quillwave.llm import warc_zip

    pages = spark.range(3000).selectExpr("id page_id", "concat('http://x/', id) url", "repeat(sha2(string(id), 512), 20) html").repartition(3)
    packages = warc_zip.archive_pages(pages, f"file://{tmp_path}")
    spans = warc_zip.index_spans(packages).collect()
    size = sum(n for s in spans for n in s["lengths"])
    assert sum(len(s["lengths"]) for s in spans) == 3000 and len(spans) <= size / warc_zip.SPAN + packages.count()
    assert warc_zip.read_packages(packages).where("record_type = 'response'").count() == 3000
    assert list(warc_zip._spans([(10, 5), (0, 10), (20, 1)])) == [(0, [10, 5]), (20, [1])]


def test_repeated_rows_of_one_id(spark):
    """Thousands of rows equal in id and text are one document to each deduplication, and one node of the join."""
    from quillwave.llm import line_templates, ngram_join, substring_dedup

    rnd = random.Random(1)
    prose = [" ".join(f"v{rnd.randrange(9000)}" for _ in range(120)) for _ in range(14)]
    lines = [(i, f"{prose[i]}\nthis page was printed for {'abcdefghijkl'[i] * 5}") for i in range(12)]
    docs = spark.createDataFrame(lines + [lines[0]] * 24, "doc_id long, text string")
    assert {(r["doc_id"], r["n_dropped"]) for r in line_templates.line_dedup(docs.withColumn("N_Lines", F.lit(1))).collect()} == {(i, 1) for i in range(12)}

    held = " ".join(prose[12].split()[:60])
    many = spark.createDataFrame([(1, prose[12])] + [(None, prose[13])] * 5000 + [(2, f"{held} end of it")] * 3000 + [(None, prose[11])], "doc_id long, text string").repartition(4)
    cuts = substring_dedup.substring_dedup(many.withColumn("N_Words", F.lit(1)))
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"]) for r in cuts.collect())
    assert got == {(1, 120, 0): 1, (None, 120, 0): 5001, (2, 63, 60): 3000}
    key = substring_dedup.new_key()
    single = substring_dedup.keyed(many)[0].select("d", "t", "u", "text").dropDuplicates(["d", "t", "u"])
    assert substring_dedup.seeds(single, 20, 4, key).count() < 500
    assert max(len(r["cuts"]) for r in substring_dedup.repeats(single, 20, 4).collect()) < 60

    near = prose[13].split()
    near[5] = "changed"
    more = many.unionByName(spark.createDataFrame([(7, " ".join(near)), (8, prose[11]), (9, "lone words here and there"), (None, None)], "doc_id long, text string"))
    out = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_join(more).collect()}
    assert out == {(1, 116, 1), (2, 59, 2), (None, 116, None), (7, 116, None), (8, 116, None), (9, 1, 9), (None, 0, None)}


def test_block_pairs_do_not_grow_with_copies(spark, monkeypatch):
    from quillwave.llm import ngram_join

    sizes = []
    products = ngram_join.products
    monkeypatch.setattr(ngram_join, "products", lambda blocks, percent: sizes.append(blocks.count()) or products(blocks, percent))
    rnd = random.Random(3)
    words = [f"v{rnd.randrange(9000)}" for _ in range(150)]
    texts = [" ".join([*words[:k], f"x{k}", *words[k:]]) for k in range(0, 150, 30)]
    for copies in (1, 300):
        df = spark.createDataFrame([(None, t) for t in texts for _ in range(copies)] + [(4, texts[0])], "doc_id long, text string")
        assert {r["component_id"] for r in ngram_join.ngram_join(df).collect()} == {None}
    assert sizes[0] == sizes[1]


def test_many_labels(spark):
    """450 labels are all learned, and scores are what plain sums over a text's subwords give."""
    from quillwave.llm import language_id as li

    rnd = random.Random(9)
    letters = [chr(0x4E00 + i) for i in range(450)]
    rows = [(i * 450 + k, " ".join(letters[k] * rnd.randrange(2, 5) + letters[k] for _ in range(30)), f"l{k}") for i in range(24) for k in range(450)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4).withColumn("Score", F.lit("x"))
    model = li.trained(df)
    assert len(model.languages) == 450
    out = li.language_id(df, model)
    assert out.columns == ["doc_id", "text", "lang", "held_out", "lang_pred", "score", "rejected"]
    right = out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.95 and out.select("lang_pred").distinct().count() == 450
    assert len(li.trained(df, 7).languages) == 7

    def score(text):
        fold = [b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in text.encode()]
        found = []
        for e in range(len(fold)):
            h = 0
            for n in range(1, 5):
                if e - n + 1 < 0:
                    break
                h = (h * 0x01000193 ^ (fold[e - n + 1] + (n << 8))) % 2**32
                if n in li.SIZES:
                    found.append((h * 0x9E3779B1 % 2**32) >> 17)
        z = [(sum(float(model.logits[b][c]) for b in found) / len(found) + float(model.bias[c])) / model.temperature for c in range(450)]
        e = [math.exp(x - max(z)) for x in z]
        return max(e) / sum(e)

    for r in out.orderBy("doc_id").limit(3).collect():
        assert r["score"] == pytest.approx(score(r["text"]), abs=1e-5)
