"""Operators against independent Python versions, on small fixtures written here."""

import io
import math
import random
import re
import struct
import tracemalloc
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillwave.operators import cues, manifest, naming, newlines, silence, transcribe
from quillwave.sinks import files as file_sinks
from quillwave.sinks import texts
from quillwave.sources import audio, listing, subtitles
from quillwave.streaming.manifests import manifest_stream


def test_clips(spark):
    rows = [("f", 1, 0, 10, "(a"), ("f", 2, 20, 31, "*b"), ("f", 3, 40, 50, "c"), ("g", 7, 5, 9, "x")]
    df = spark.createDataFrame(rows, "file string, cue_no long, start long, end long, text string")
    out = [tuple(r) for r in cues.clips(df, F.lit(100)).orderBy("file", "clip").collect()]
    assert out == [("f", 1, 0, 15, "(a"), ("f", 2, 35, 75, "c"), ("g", 1, 5, 54, "x")]
    assert cues.clips(df.limit(0), F.lit(1)).count() == 0
    line = cues.metadata_lines(cues.clips(df, F.lit(100)).withColumn("file", F.lit("a b")).limit(1), keep_folder=True).first()["line"]
    assert line.startswith("a b/a_b_1.wav|")


def recursion(sil, total, low, high):
    done, todo = [], [(0, total)]
    while todo:
        a, b = todo.pop()
        mids = sorted(((s - e, s, (s + e) // 2) for s, e in sil if s >= a and e <= b))
        cut = next((m for _, _, m in mids if m - a >= low and b - m >= low), None) if b - a > high else None
        if cut is None:
            done.append((a, b))
        else:
            todo += [(a, cut), (cut, b)]
    return sorted(done)


def test_split_and_trim(spark):
    rnd = random.Random(5)
    files, sil = {}, {}
    for i in range(150):
        total = rnd.randrange(1, 400)
        cuts = sorted(rnd.sample(range(total + 1), min(total + 1, 2 * rnd.randrange(0, 12))))
        files[f"f{i}"] = total
        sil[f"f{i}"] = list(zip(cuts[::2], cuts[1::2]))
    f = spark.createDataFrame(list(files.items()), "file string, total long")
    s = spark.createDataFrame([(k, a, b) for k, v in sil.items() for a, b in v], "file string, s long, e long")
    segments = silence.split(f, s, 7, 40)
    got = {}
    for r in silence.trim(segments, s, f, 3).collect():
        got.setdefault(r["file"], []).append((r["raw_start"], r["raw_end"], r["export_start"], r["export_end"]))
    for k, total in files.items():
        parts = sorted(got[k])
        assert [p[:2] for p in parts] == recursion(sil[k], total, 7, 40)
        for a, b, x, y in parts:
            lead = [e for u, e in sil[k] if u <= a < e <= b]
            tail = [u for u, e in sil[k] if a <= u < b <= e]
            want_x = lead[0] - 3 if lead and lead[0] - a > 3 else a
            want_y = tail[0] + 3 if tail and b - tail[0] > 3 else b
            assert (x, y) == (max(0, want_x), max(max(0, want_x), min(total, want_y)))
    with pytest.raises(ValueError):
        silence.split(f, s, 0, 40)


def tone(parts, rate=8000, width=2):
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(width)
        f.setframerate(rate)
        for ms, level in parts:
            f.writeframes(b"".join(struct.pack("<h", int(level * math.sin(i / 3))) for i in range(rate * ms // 1000)))
    return out.getvalue()


def test_audio(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(tone([(1000, 9000), (1000, 0), (1000, 9000)]))
    (tmp_path / "b.wav").write_bytes(b"broken")
    files = audio.read_wavs(spark, str(tmp_path))
    frames = audio.energy(files)
    assert frames.where("error is not null").count() == 1
    good = frames.where("error is null")
    assert [tuple(r)[1:] for r in silence.silences(good, F.lit(0.0), 500).collect()] == [(1000, 2000)]
    assert audio.durations(frames).first()["total"] == 3000
    spans = good.select("file").distinct().selectExpr("file", "1L idx", "500L start", "1500L end", "20L pad_lead", "0L pad_tail")
    clip = audio.cut_clips(files, spans).first()["content"]
    assert len(audio.samples(clip)[0]) == 8 * 1020
    said = transcribe.transcribe(audio.cut_clips(files, spans), "none").first()
    assert said["text"] == f"{len(clip)} bytes" and said["error"] is None
    level = silence.auto_threshold(good).first()["threshold"]
    assert -40 < level < -20
    assert listing.with_extensions(listing.listing(spark, str(tmp_path)), ["WAV"]).count() == 2


def test_edges(spark):
    rows = [("a", 0, 1.0), ("a", 1, 9.0), ("a", 2, 1.0), ("a", 3, 1.0), ("q", 0, 0.0), ("q", 1, 0.0)]
    edges = silence.edge_silence(spark.createDataFrame(rows, "file string, chunk long, level double"), F.lit(5.0))
    assert {tuple(r) for r in edges.collect()} == {("a", 10, 20, 40), ("q", 20, 20, 20)}
    a = silence.adjust_edges(edges, "pad", 15, 0).where("file = 'a'").first()
    assert (a["pad_lead"], a["pad_tail"], a["cut_lead"], a["cut_tail"]) == (5, 0, 0, 0)
    r = silence.adjust_edges(edges, "remove", 15, 0).where("file = 'a'").first()
    assert (r["cut_lead"], r["cut_tail"]) == (0, 5)
    drawn = [x[0] for x in spark.range(300).select(silence.jittered(100, 20, F.col("id"))).collect()]
    assert min(drawn) >= 80 and max(drawn) <= 120 and len(set(drawn)) > 20


def test_manifest(spark):
    lines = ["", "one", "a.wav|t", "b|t|", "c|t|n|more", " d | x　", "|t", "zz|t"]
    df = spark.createDataFrame(list(enumerate(lines)), "line_no long, value string")
    files = spark.createDataFrame([(f"wavs/{x}.wav",) for x in "abcd"], "path string")
    rows = manifest.resolve(manifest.parse(df), files).orderBy("line_no").collect()
    assert [r["status"] for r in rows] == ["empty", "malformed", "ok", "ok", "ok", "ok", "missing", "missing"]
    assert [r["normalized"] for r in rows[2:6]] == ["t", "", "n", "x"]
    assert [r["audio"] for r in rows[2:6]] == [f"wavs/{x}.wav" for x in "abcd"]


@pytest.mark.parametrize("ratio", [0.0, 0.4, 0.5, 1.0])
def test_references(spark, ratio):
    sizes = {"a": 1, "b": 2, "c": 5, "d": 25}
    rows = [(i, f"{d}/{n}.wav", "t") for i, (d, n) in enumerate((d, n) for d, k in sizes.items() for n in range(k))]
    out = manifest.references(spark.createDataFrame(rows, "line_no long, audio string, normalized string"), ratio, seed=3).collect()
    for d, k in sizes.items():
        mine = [r for r in out if r["dir"] == d]
        refs = [r for r in mine if r["ref_audio"]]
        assert len(mine) == k and len(refs) == min(k, round(k * ratio))
        assert all(r["ref_audio"].startswith(f"{d}/") and (k == 1 or r["ref_audio"] != r["audio"]) for r in refs)
    with pytest.raises(ValueError):
        manifest.references(spark.createDataFrame(rows, "line_no long, audio string, normalized string"), 1.5)


def test_references_of_two_manifests(spark):
    """Equal line numbers of two manifests draw apart; without the manifest in the key they are an error."""
    rows = [(m, i, f"wavs/{m}{i}.wav", "t" * i) for m in "ab" for i in range(500)]
    df = spark.createDataFrame(rows, "manifest string, line_no long, audio string, normalized string")
    out = manifest.references(df, 0.4, seed=1, key=("manifest", "line_no")).collect()
    picked = {m: {r["line_no"] for r in out if r["manifest"] == m and r["ref_audio"]} for m in "ab"}
    assert len(out) == 1000 and sum(map(len, picked.values())) == 400 and 40 < len(picked["a"] & picked["b"]) < 120
    assert sorted(r["pos"] for r in out) == list(range(1000)) and all(r["ref_audio"] != r["audio"] for r in out)
    assert [r["pos"] for r in out if r["manifest"] == "b" and r["line_no"] == 3] == [503]
    with pytest.raises(ValueError, match="share a line_no"):
        manifest.references(df, 0.4)
    assert manifest.references(df.limit(0), 0.4).count() == 0
    places = [r["place"] for r in manifest.places(df, 4, ("manifest", "line_no")).collect()]
    assert sorted(places) == list(range(1, 1001)) and manifest._digits(10**9) == 4


def test_rename_plan(spark):
    names = ["a b.txt", "a  b.txt", "a_b.txt", "a_b_1.txt", "'.txt", " c.txt", "c.txt", "d.txt"]
    df = spark.createDataFrame([(f"x/{n}", i) for i, n in enumerate(names + ["a b.txt"])], "path string, pos long")
    plan = {r["old"]: r["new"] for r in naming.rename_plan(df, df.select("path").distinct()).collect()}
    taken, want = set(names), {}
    targets = {"a b.txt": "a_b.txt", "a  b.txt": "a_b.txt", "'.txt": "_.txt", " c.txt": "c.txt"}
    for n in names:
        t = targets.get(n, n)
        new, k = t, 0
        while new != n and new in taken:
            k += 1
            new = t.replace(".txt", f"_{k}.txt")
        taken -= {n}
        taken |= {new}
        want[n] = new
    assert plan == want


def walked(names):
    """The plan of renaming files one after the other."""
    taken, out = set(names), {}
    for n in names:
        base, ending = (n[:-4], n[-4:])
        clean = re.sub("[ ']+", "_", base).strip("_") or "_"
        new, k = clean + ending, 0
        while new != n and new in taken:
            k += 1
            new = f"{clean}_{k}{ending}"
        taken -= {n}
        taken |= {new}
        out[n] = new
    return out


def test_rename_plan_of_many(spark):
    """Crowded names, counters freed and taken again, against a walk through the folder; 20,000 names of one stem stay quick."""
    rnd = random.Random(3)
    names = list(dict.fromkeys("".join(rnd.choice("ab '_1") for _ in range(rnd.randrange(1, 6))) + ".txt" for _ in range(900)))
    names = [n for n in names if n[:-4].strip("_ '") and not n.startswith("_")]
    names += ["a_2.txt", "a 7.txt", "a_7_1.txt", "b_1_1.txt"]
    names = list(dict.fromkeys(names))
    df = spark.createDataFrame([(f"x/{n}", i) for i, n in enumerate(names)] + [(None, 1)], "path string, pos long")
    plan = {r["old"]: r["new"] for r in naming.rename_plan(df, df.select("path").distinct()).collect()}
    assert plan == walked(names)
    # Targets that are counters of others in another folder of names without the digits' stems.
    few = ["a b.txt", "a  b.txt", "a_b 1.txt", "a_b_2.txt", " a_b_1.txt", "a.b", "' a.b'", "x y.", " x y.", "' '.txt", "__2.txt", "'.txt"]
    df = spark.createDataFrame([(f"z/{n}", i) for i, n in enumerate(few)], "path string, pos long")
    plan = {r["old"]: r["new"] for r in naming.rename_plan(df, df.select("path").distinct()).collect()}
    assert plan == {
        "a b.txt": "a_b.txt", "a  b.txt": "a_b_1.txt", "a_b 1.txt": "a_b_1_1.txt", "a_b_2.txt": "a_b_2.txt", " a_b_1.txt": "a_b_1_2.txt", "a.b": "a.b", "' a.b'": "a.b'",
        "x y.": "x_y.", " x y.": "x_y._1", "' '.txt": "_.txt", "__2.txt": "2.txt", "'.txt": "__1.txt",
    }


@pytest.mark.parametrize("size", [None, 64])
def test_rename_plan_of_one_name(spark, monkeypatch, size):
    """100,000 names of one folder that all clean to the same, with counters taken here and there, in ranges that many tasks order."""
    monkeypatch.setattr(naming, "RANGE", size or naming.RANGE)
    n = 4000 if size else 100_000
    crowd = spark.range(n).selectExpr("concat('y/', translate(lpad(bin(id), 17, '0'), '01', ' \\''), '.txt') path", "id * 7 pos")
    kept = [f"__{k}.txt" for k in [1, 2, 3, 7, 500, 501, 502, 3999, 4001, 90_000, 10**12]] + ["__04.txt", "__0.txt", "_.txt"]
    there = crowd.select("path").unionByName(spark.createDataFrame([(f"y/{k}",) for k in kept], "path string"))
    plan = naming.rename_plan(crowd, there).cache()
    out = {r["pos"]: r["new"] for r in plan.join(crowd.selectExpr("substring(path, 3) old", "pos"), "old").collect()}
    free = (f"__{k}.txt" for k in range(1, n + 20) if f"__{k}.txt" not in kept)
    assert [out[7 * i] for i in range(n)] == [next(free) for _ in range(n)]
    counts = {r["status"]: r["n"] for r in naming.rename_counts(plan).collect()}
    assert counts == {"renamed": n}


def test_renames_carried_out(spark, tmp_path):
    (tmp_path / "d").mkdir()
    names = ["a b.txt", "a_b.txt", "a_b_1.txt", "c.txt"]
    for n in names:
        (tmp_path / "d" / n).write_text(n)
    df = spark.createDataFrame([(f"d/{n}", i) for i, n in enumerate(names)], "path string, pos long")
    plan = naming.rename_plan(df, df.select("path"))
    want = {r["new"]: r["old"] for r in plan.collect()}
    assert file_sinks.apply_renames(plan, f"file://{tmp_path}") == {"renamed": 1, "unchanged": 3}
    assert {p.name: p.read_text() for p in (tmp_path / "d").iterdir()} == want
    assert file_sinks.apply_renames(plan.withColumn("old", F.lit("gone.txt")).withColumn("new", F.lit("new.txt")).where("status = 'renamed'"), str(tmp_path)) == {"missing": 1, "unchanged": 0}


def test_newlines_of_differing_texts(spark):
    """Expectations made by hand."""
    cases = [
        ("The cat sat on the mat.", "The cat\nsat on the\nmat.", False, "The cat \nsat on the \nmat."),
        ("one two three four five six", "one two\nthree 4 five\nsix", False, "one two \nthree four five \nsix"),
        ("He said (quietly) no more.", "He said\n(quietly)\nno more.", False, "He said \n(quietly) \nno more."),
        ("unbroken", "unbro\nken", True, "unbro\n&ken"),
        ("unbroken", "unbro\nken", False, "unbro\nken"),
        ("end — begin", "end —\nbegin", True, "end — \nbegin"),
        ("same text", "same text", True, "same text"),
        ("only here", "", False, "only here"),
        ("", "only\nthere\n", False, "\n"),
        ("A b\nc", "A b c", False, "A b c"),
    ]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, original string, transcribed string, mark boolean, want string")
    for mark in (False, True):
        out = newlines.carry_breaks(df.where(F.col("mark") == mark), mark).orderBy("i").collect()
        assert [(r["i"], r["text"]) for r in out] == [(r["i"], r["want"]) for r in out]
    nothing = spark.createDataFrame([(None, "a"), ("a", None)], "original string, transcribed string")
    assert [r["text"] for r in newlines.carry_breaks(nothing).collect()] == [None, None]


def test_edit_script():
    rnd = random.Random(4)
    for _ in range(400):
        a, b = ("".join(rnd.choice("abc \n") for _ in range(rnd.randrange(0, 40))) for _ in range(2))
        edits = [(0, x) if k == "equal" else (9, (x, y)) for k, x, y in newlines._edits(a, b)]
        assert "".join(x if o == 0 else x[0] for o, x in edits) == a and "".join(x if o == 0 else x[1] for o, x in edits) == b
        script = newlines.coarse([(0, x) if o == 0 else e for o, x in edits for e in ([(0, x)] if o == 0 else [(-1, x[0]), (1, x[1])]) if e[1]])
        assert "".join(t for o, t in script if o <= 0) == a and "".join(t for o, t in script if o >= 0) == b
    assert newlines.coarse([(-1, "abcdef"), (0, "x"), (1, "uvwxyz")]) == [(-1, "abcdefx"), (1, "xuvwxyz")]
    assert newlines.coarse([(-1, "a"), (0, "kept"), (1, "b")]) == [(-1, "a"), (0, "kept"), (1, "b")]
    long = " ".join(f"w{i}" for i in range(60_000))
    assert newlines._edits(long.split(" "), long.replace("w500 ", "").split(" "))[1] == ("replace", ["w500"], [])


def test_shortest_edits():
    """Against the longest common subsequence; with a small bound, still edits that turn one into the other."""
    rnd = random.Random(9)
    for _ in range(300):
        a, b = ("".join(rnd.choice("abc") for _ in range(rnd.randrange(0, 25))) for _ in range(2))
        lengths = [0] * (len(b) + 1)
        for x in a:
            row = [0]
            for n, y in enumerate(b):
                row.append(lengths[n] + 1 if x == y else max(lengths[n + 1], row[n]))
            lengths = row
        for cost in (256, 1, 3):
            i = k = same = 0
            for p, q, u, v in [*newlines._myers(a, b, 0, len(a), 0, len(b), cost), (len(a), len(a), len(b), len(b))]:
                assert a[i:p] == b[k:u]
                i, k, same = q, v, same + p - i
            assert cost < 256 or same == lengths[-1]


def test_diff_memory():
    """Texts of few words, none of them unique, within set memory."""
    rnd = random.Random(2)
    a = [rnd.choice("pqrst") for _ in range(40_000)]
    b = [x for x in a if rnd.random() > 0.02]
    tracemalloc.start()
    hunks = newlines._myers(a, b, 0, len(a), 0, len(b))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4_000_000 and sum(q - p for p, q, _, _ in hunks) < 2 * (len(a) - len(b))


def test_spread_newlines(spark):
    """A book in pieces gives what the whole gives, copies and nulls included; of few words, where several edits are shortest, the same words."""
    rnd = random.Random(3)

    def made(vocabulary):
        words = [f"w{rnd.randrange(vocabulary)}" for _ in range(6000)]
        return " ".join(words), "".join(w + ("\n" if i % 9 == 8 else " ") for i, w in enumerate(words) if i % 50)

    book, few = made(1500), made(7)
    assert len(newlines.parted(*book, 500)) > 5 and all("".join(x) == y for x, y in zip(zip(*newlines.parted(*book, 500)), book))
    assert newlines.parted("a a a " * 400, "a a b " * 300, 500) == [("a a a " * 400, "a a b " * 300)]
    rows = [(1, *book), (2, *book), (3, None, "a"), (4, "a", None), (5, "", ""), (6, "one two", "one\ntwo"), (7, *book), (8, *few)]
    df = spark.createDataFrame(rows, "id int, original string, transcribed string")
    spread = {r["id"]: r["text"] for r in newlines.carry_breaks(df, spread=True, words=500).collect()}
    plain = {r["id"]: r["text"] for r in newlines.carry_breaks(df).collect()}
    assert [spread.pop(8).split(), plain.pop(8).split()] == [few[0].split()] * 2
    assert spread == plain and len(spread) == 7 and spread[3] is None and spread[6] == "one \ntwo"
    assert newlines.carry_breaks(df.where("id > 9"), spread=True).collect() == []


def test_batches_and_seams(spark, tmp_path, monkeypatch):
    sizes = []

    def load(model, how):
        def recognise(clips, language):
            sizes.append([len(c) for c in clips])
            if b"bad" in clips:
                raise ValueError("bad clip")
            return [f"{language} {how.beams} {c.decode()}" for c in clips]

        return recognise

    monkeypatch.setitem(transcribe.BACKENDS, "here", load)
    heard = transcribe._heard(load("m", transcribe.Recognition()), [b"ccc", b"a", b"bad", b"bbbb", b""], "en", 2)
    assert heard == [("en 1 ccc", None), ("en 1 a", None), (None, "bad clip"), ("en 1 bbbb", None), ("en 1 ", None)]
    assert [s for s in sizes if len(s) > 1] == [[3, 3], [0, 1]]
    with pytest.raises(ValueError):
        transcribe.transcribe(spark.createDataFrame([], "file string, idx long, content binary"), "m", how=transcribe.Recognition(batch=0))
    with pytest.raises(ValueError):
        transcribe.windows(spark.createDataFrame([], "file string, total long"), 10, 10)
    (tmp_path / "unknown").mkdir()
    with pytest.warns(UserWarning, match="neither"):
        assert transcribe.backend_of(str(tmp_path / "unknown")) == "transformers"

    assert transcribe.seam("a b c d e f", "d e f g h i", 0.3) == (9, 4)
    assert transcribe.seam("one two", "three four", 0.5) == (7, 0) and transcribe.seam("", "a", 0.5) == (0, 0)
    parts = [("f", 0, "We saw the quick bro"), ("f", 1, "saw The quick brown fox jump"), ("f", 2, "brown fox jumps over"), ("g", 0, None), ("g", 1, "x"), ("g", 1, "x"), ("z", 0, "今天天气"), ("z", 1, "天气很好"), ("e", 0, "")]
    out = transcribe.stitched(spark.createDataFrame(parts, "file string, idx long, text string"), 10, 5)
    assert {r["file"]: r["text"] for r in out.collect()} == {"f": "We saw the quick brown fox jumps over", "g": "x", "z": "今天天气很好", "e": ""}


def test_recordings_in_windows(spark, tmp_path):
    """Each sample is read out: a recording in windows must read as the whole does."""
    rnd = np.random.default_rng(5)
    long, short = rnd.integers(-3000, 3000, 4321), rnd.integers(-9, 9, 30)
    (tmp_path / "long.wav").write_bytes(audio._packed(long[:, None], 2, 1, 1000))
    (tmp_path / "short.wav").write_bytes(audio._packed(short[:, None], 2, 1, 1000))
    (tmp_path / "broken.wav").write_bytes(b"RIFF")
    heads = audio.wav_heads(audio.list_wavs(spark, str(tmp_path)))
    out = {r["file"].rsplit("/", 1)[1]: r for r in transcribe.transcribe_recordings(heads, "m", "levels", window=300, overlap=50).collect()}
    assert {n: r["text"] for n, r in out.items()} == {"long.wav": " ".join(map(str, long)), "short.wav": " ".join(map(str, short))}
    assert {r["failed"] for r in out.values()} == {0}
    spans = transcribe.windows(spark.createDataFrame([("f", 0), ("g", 300), ("h", 301), ("i", None)], "file string, total long"), 300, 50).collect()
    assert sorted((s["file"], s["start"], s["end"]) for s in spans if s["file"] != "i") == [("f", 0, 0), ("g", 0, 300), ("h", 0, 300), ("h", 250, 301)]


def test_globs(spark, tmp_path, monkeypatch):
    for n in ("a/x.wav", "a/b/y.wav", "a/b/c/z.wav", "a/b/c/n.txt", "x1.wav"):
        (tmp_path / n).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / n).write_text("1")
    names = lambda df: [r["path"].rsplit("/", 1)[1] for r in df.orderBy("pos").collect()]
    assert names(listing.expand(spark, [f"{tmp_path}/x*.wav", f"{tmp_path}/a/**/*.wav", f"{tmp_path}/x1.wav"])) == ["x1.wav", "z.wav", "y.wav", "x.wav"]
    assert names(listing.expand(spark, [f"{tmp_path}/x?.wav", f"{tmp_path}/x1.wav"], distinct=False)) == ["x1.wav", "x1.wav"]
    with pytest.warns(UserWarning, match="no file matches"):
        assert names(listing.expand(spark, [f"{tmp_path}/no*.wav", f"{tmp_path}/**/none"])) == []
    assert [r["path"] for r in listing.expand(spark, [f"{tmp_path}/no*.wav", "b.wav", "b.wav"], literal=True).orderBy("pos").collect()] == [f"{tmp_path}/no*.wav", "b.wav"]
    assert listing.expand(spark, []).count() == 0
    (tmp_path / "many").mkdir()
    for i in range(300):
        (tmp_path / f"many/{i:03}.txt").write_text("1")
    asked = [f"{tmp_path}/many/{i:05}.txt" for i in range(5000)] + [f"{tmp_path}/many/{i:03}.txt" for i in range(299, -1, -1)] + [f"file://{tmp_path}/many/29?.txt", f"{tmp_path}/a/b/*.wav", f"{tmp_path}/*/b/**/n.txt"]
    with pytest.warns(UserWarning, match="and 4990 more"):
        assert names(listing.expand(spark, asked)) == [f"{i:03}.txt" for i in range(299, -1, -1)] + ["y.wav", "n.txt"]
    monkeypatch.setattr(listing, "_opens", lambda path: False)  # a store that only Spark reads
    assert names(listing.expand(spark, [f"file:{tmp_path}/many/29?.txt", f"file:{tmp_path}/x1.wav", f"file:{tmp_path}/**/y.wav"])) == [*(f"29{i}.txt" for i in range(10)), "x1.wav", "y.wav"]
    one = spark.createDataFrame([("/d/x.wav",), ("/d/e/x.wav",), ("/d/x.txt",), (None,)], "path string")
    assert {tuple(r) for r in listing.matched(one, ["/d/*", "/**/x.wav"]).collect()} == {("/d/x.wav", 0), ("/d/x.txt", 0), ("/d/e/x.wav", 1)}


def test_globs_folders_as_files(spark, tmp_path, monkeypatch):
    """A folder with a wanted ending is one path, by tasks and by Spark's reader; only spelled out is it entered."""
    for n in ("d/b.set/p0.set", "d/b.set/k=1/p1.set", "d/a.set", "d/c/e.set/p2", "d/sets/f.txt", "d/g.set/_hidden"):
        (tmp_path / n).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / n).write_text("1")
    names = lambda asked: [r["path"].split("/d/")[1] for r in listing.expand(spark, [f"file:{tmp_path}/d/{p}" for p in asked], as_files=(".set",)).orderBy("pos").collect()]
    for seen in (["g.set"], []):  # a reader knows of no folder without files that it reads
        assert names(["b*", "**/*.set", "b.set"]) == ["b.set", "a.set", "c/e.set", *seen]
        assert names(["c/e.set", "b.set/*", "**/*"]) == ["c/e.set", "b.set/p0.set", "a.set", "b.set", *seen, "sets/f.txt"]
        assert names(["b.set/**/*.set"]) == ["b.set/k=1/p1.set", "b.set/p0.set"]
        monkeypatch.setattr(listing, "_opens", lambda path: False)


def test_backends(spark, tmp_path):
    for n, kind in (("ct2/model.bin", "faster-whisper"), ("hf/config.json", "transformers"), ("odd/readme", "transformers")):
        (tmp_path / n).parent.mkdir()
        (tmp_path / n).write_text("")
        assert transcribe.backend_of(str((tmp_path / n).parent)) == kind
    assert transcribe.backend_of("base") == transcribe.backend_of(str(tmp_path / "hf/config.json")) == "openai-whisper"
    lists = spark.createDataFrame([("m", ["model.bin"]), ("m", ["config.json"]), ("m", None)], "model string, names array<string>").select(transcribe.detect_backend("model", "names")).collect()
    assert {r[0] for r in lists} == {"faster-whisper", "transformers", "openai-whisper"} <= set(transcribe.BACKENDS)
    with pytest.raises(ValueError):
        transcribe.transcribe(spark.createDataFrame([], "file string, idx long, content binary"), "m", "other")
    parts = spark.createDataFrame([("f", 2, "b "), ("f", 1, "a"), ("g", 1, None)], "file string, idx long, text string")
    assert {tuple(r) for r in transcribe.joined_text(parts).collect()} == {("f", "a b"), ("g", "")}


def test_exports(spark, tmp_path):
    """24-bit clips under their names, texts under theirs, metadata lines added to what is there."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.wav").write_bytes(tone([(100, 9000)]))
    wavs = audio.read_wavs(spark, str(tmp_path / "in"))
    spans = wavs.selectExpr("file", "1L idx", "0L start", "50L end", "0L pad_lead", "0L pad_tail")
    clip = audio.cut_clips(wavs, spans, bits=24)
    x, params = audio.samples(clip.first()["content"])
    assert params.sampwidth == 3 and (x[:, 0] == audio.samples((tmp_path / "in/a.wav").read_bytes())[0][:400, 0] << 8).all()
    names = texts.clip_names(spans.withColumnRenamed("start", "export_start"), prefix=F.lit("a"))
    assert file_sinks.write_files(file_sinks.named_clips(clip, names), str(tmp_path / "out"))[0] == 1
    assert audio.samples((tmp_path / "out/a_001.wav").read_bytes())[1].sampwidth == 3
    rows = spark.createDataFrame([("/t/x.txt", "a\nb"), ("y.md", "é"), ("z", None)], "path string, text string").withColumn("name", file_sinks.newline_name("path"))
    assert file_sinks.write_files(rows, f"file://{tmp_path}/n", content="text") == (2, 5)
    assert {p.name: p.read_text(encoding="utf-8") for p in (tmp_path / "n").iterdir()} == {"x_newline.txt": "a\nb", "y_newline.md": "é"}
    lines = spark.createDataFrame([("a|b",)], "line string")
    for n in (1, 2):
        texts.append_metadata(lines, str(tmp_path / "meta"))
        assert spark.read.text(str(tmp_path / "meta")).count() == n


def test_ass_without_format(spark):
    ass = "[Events]\nDialogue: 0,0:00:01.00,0:00:02.00,Default,,0,0,0,,Hi, you\nDialogue: 0,0:00:01.00\n[broken\nDialogue: 0,0:00:03.00,0:00:04.00,Default,,0,0,0,,no"
    rows = subtitles.ass_cues(spark.createDataFrame([("f", ass)], "file string, value string")).collect()
    assert [tuple(r) for r in rows] == [("f", 1, 1000, 2000, "Hi, you")]


def test_loud_recordings(spark):
    """Running sums far beyond 2^53 still find a silence of nothing but zeros."""
    frames = spark.range(400).selectExpr("'f' file", "id ms", "IF(id BETWEEN 200 AND 299, 0.0D, 4.0e15D + 3) ss", "48L n")
    assert [tuple(r) for r in silence.silences(frames, F.lit(0.0), 50).collect()] == [("f", 200, 300)]


def test_manifests_together(spark):
    """Rows of two manifests with the same line numbers keep their own audio."""
    rows = spark.createDataFrame([("m1", 0, "a|t"), ("m2", 0, "b|t"), ("m2", 1, "c.wav|t")], "file string, line_no long, value string")
    parsed = rows.select("file").distinct()
    there = spark.createDataFrame([(f"wavs/{x}.wav",) for x in "abc"] + [(None,)], "path string")
    for f in ("m1", "m2"):
        one = manifest.parse(rows.where(F.col("file") == f)).withColumn("file", F.lit(f))
        parsed = one if f == "m1" else parsed.unionByName(one)
    assert {(r["file"], r["line_no"], r["audio"]) for r in manifest.resolve(parsed, there).collect()} == {("m1", 0, "wavs/a.wav"), ("m2", 0, "wavs/b.wav"), ("m2", 1, "wavs/c.wav")}
    shuffled = manifest.ordered(parsed, True, 5).collect()
    assert len(shuffled) == 3 and shuffled == manifest.ordered(parsed, True, 5).collect()


def test_names_against_a_listing(spark):
    """The ending is tried first, then the bare name; paths that only look alike don't count."""
    there = ["wavs/a.wav", "wavs/a.wav.wav", "wavs/b", "wavs/b.wav", "wavs/.wav", "wavs/", "wavs/d/e.wav", "wav/c.wav", "xwavs/c.wav", "wavs/f.WAV", "wavs/ü😀.wav", "wavs/b", None]
    asked = ["a", "a.wav", "a.wav.wav", "b", "", ".wav", "d/e", "d/e.wav", "e", "c", "f", "f.WAV", "ü😀", "ü😀.wav", None, "a", "%", "_"]
    rows = [(i, n, "ok" if i % 7 else "empty", {"k": i}, "old") for i, n in enumerate(asked * 3)]
    df = spark.createDataFrame(rows, "line_no long, name string, status string, more map<string,int>, Audio string")
    out = manifest.resolve(df, spark.createDataFrame([(p,) for p in there], "path string"))
    assert out.columns == ["line_no", "name", "status", "more", "audio"]

    def found(name, status):
        tries = [f"wavs/{name}.wav", f"wavs/{name}"] if name and status == "ok" else []
        audio = next((t for t in tries if t in there), None)
        return audio, "missing" if status == "ok" and audio is None else status

    assert sorted((r["line_no"], r["audio"], r["status"]) for r in out.collect()) == [(i, *found(n, s)) for i, n, s, _, _ in rows]
    assert manifest.resolve(df, spark.createDataFrame([], "path string")).where("audio is not null").count() == 0
    assert manifest.resolve(df.limit(0), spark.createDataFrame([("wavs/a",)], "path string")).count() == 0


def test_lines_without_a_name_are_spread(spark):
    """Rows that ask for no file don't meet in one task where the join is shuffled."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        lines = spark.range(4000).selectExpr("id line_no", "IF(id % 4 = 0, concat('n', id, '|t'), '') value")
        out = manifest.resolve(manifest.parse(lines), spark.range(4000).selectExpr("concat('wavs/n', id, '.wav') path"))
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 4000 and max(sizes) < 2 * 4000 / len(sizes) and len(sizes) > 1


def test_spread_pairs_with_nulls_and_copies(spark):
    """Null pairs keep their rows, copies of one pair all get its text, other columns stay."""
    rows = [(i, "a b c", "a\nb c", "x") for i in range(50)] + [(50, None, "a", "x"), (51, "a", None, None), (52, None, None, "x"), (52, None, None, "x"), (53, "", "", "x")]
    out = newlines.carry_breaks(spark.createDataFrame(rows, "id long, original string, transcribed string, Text string"), spread=True)
    assert out.columns == ["id", "original", "transcribed", "text"]
    want = newlines.carry_breaks(spark.createDataFrame([r[:3] for r in rows], "id long, original string, transcribed string"))
    assert sorted(out.collect(), key=str) == sorted(want.collect(), key=str) and out.count() == len(rows)


def test_newlines(spark):
    pairs = [("Hello there my friend.", "Hello there\nmy friend."), ("a b", "a b\n"), ("x", "\nx"), ("", "")]
    out = [r["text"] for r in newlines.carry_breaks(spark.createDataFrame(pairs, "original string, transcribed string").coalesce(1)).collect()]
    assert [x.replace(" \n", "\n").replace("\n ", "\n") for x in out] == ["Hello there\nmy friend.", "a b\n", "\nx", ""]


def test_subtitles(spark, tmp_path):
    (tmp_path / "a.srt").write_text("﻿1\r\n00:00:01,000 --> 00:00:02,500\r\nHi\r\nyou\r\n\r\n2\r\n00:00:03,000 --> 00:00:04,000\r\nB\r\n", encoding="utf-8")
    (tmp_path / "b.ass").write_text(
        "[Events]\nFormat: Layer, Text, Start, End\nDialogue: 0,x,0:00:01.00,0:00:02.00\nFormat: Layer, Start, End, Text\n"
        "Dialogue: 0,0:00:05.00,0:00:06.00,late\nDialogue: 0,0:00:01.50,0:00:02.00,{\\an8}a, b\\Nc\nComment: 0,0:00:01.00,0:00:02.00,no\nDialogue: 0,short\n[Fonts]\nDialogue: 0,0:00:01.00,0:00:02.00,no\n",
        encoding="utf-8",
    )
    rows = subtitles.read_cues(spark, [str(tmp_path / "a.srt"), str(tmp_path / "b.ass")]).orderBy("file", "cue_no").collect()
    assert [tuple(r)[1:] for r in rows] == [(1, 1000, 2500, "Hi\nyou"), (2, 3000, 4000, "B"), (1, 1500, 2000, "a, b c"), (2, 5000, 6000, "late")]
    with pytest.raises(ValueError):
        subtitles.read_cues(spark, ["x.vtt"])


def test_sinks(spark, tmp_path):
    seg = spark.createDataFrame([("f", 1, 0, 1500, ""), ("f", 2, 1500, 2000, "t")], "file string, idx long, export_start long, export_end long, text string")
    want = "1\n00:00:00,000 --> 00:00:01,500\n[Segment 1]\n\n2\n00:00:01,500 --> 00:00:02,000\nt\n"
    assert texts.srt_files(seg).first()["content"] == want
    assert [r["name"] for r in texts.clip_names(seg).orderBy("idx").collect()] == ["f_001.wav", "f_002.wav"]
    rows = spark.createDataFrame([("a/1.wav", 'q"é', None), ("a/2.wav", "n", "a/1.wav")], "audio string, normalized string, ref_audio string")
    texts.write_json_lines(rows.coalesce(1), str(tmp_path / "j"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "j")).collect()) == [
        '{"audio": "a/1.wav", "text": "q\\"é"}', '{"audio": "a/2.wav", "text": "n", "ref_audio": "a/1.wav"}'
    ]


def test_stream(spark, tmp_path):
    spark.createDataFrame([(1, "a|b"), (2, "c")], "line_no long, value string").write.parquet(str(tmp_path / "in"))
    q = manifest_stream(spark, str(tmp_path / "in")).writeStream.format("memory").queryName("manifests").start()
    q.processAllAvailable()
    q.stop()
    assert {r["status"] for r in spark.table("manifests").collect()} == {"ok", "malformed"}
