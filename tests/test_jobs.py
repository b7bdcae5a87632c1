"""Whole jobs over recordings made here, against what the parts must give."""

import io
import wave

import numpy as np
import pytest

from quillwave.operators import jobs
from quillwave.sources import audio

RATE = 1000


def recording(parts, width=2):
    """A WAV file of (ms, level) parts."""
    x = np.concatenate([np.full(ms, level, np.int64) * np.where(np.arange(ms) % 2, 1, -1) for ms, level in parts])
    return audio._packed(x[:, None], width, 1, RATE)


def length(path):
    with wave.open(io.BytesIO(path.read_bytes())) as f:
        return f.getnframes() * 1000 // f.getframerate(), f.getsampwidth()


TALK = [(4000, 9000), (800, 0), (4000, 9000), (600, 0), (9000, 9000), (1200, 0), (5000, 9000)]


def test_split_recordings(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/talk.wav").write_bytes(recording(TALK))
    (tmp_path / "in/loud one.wav").write_bytes(recording([(7000, 500)]))
    (tmp_path / "in/quiet.wav").write_bytes(recording([(5000, 0)]))
    (tmp_path / "in/broken.wav").write_bytes(b"RIFF????")
    listed = audio.list_wavs(spark, str(tmp_path / "in"))
    options = jobs.SplitOptions(threshold_db=-60.0, srt=True, model="none", backend="stub")
    rows = jobs.split_recordings(listed, f"file://{tmp_path}/out", options).collect()
    by = lambda n: sorted((r["idx"], r["raw_start"], r["raw_end"], r["export_start"], r["export_end"], r["name"]) for r in rows if r["file"].endswith(n) and r["idx"])
    # Cut in the middle of the longest pause, 18,400-19,600, then of the longest that is left, 4,000-4,800; the rest is short enough.
    assert by("talk.wav") == [
        (1, 0, 4400, 0, 4300, "talk_001.wav"),
        (2, 4400, 19_000, 4500, 18_700, "talk_002.wav"),
        (3, 19_000, 24_600, 19_300, 24_600, "talk_003.wav"),
    ]
    assert by("loud one.wav") == [(1, 0, 7000, 0, 7000, "loud one_001.wav")]
    # Silent throughout: its start lies in a silence of which 300 ms stay, and so does its end.
    assert [r[:3] for r in by("quiet.wav")] == [(1, 0, 5000)]
    assert [r["error"] is not None for r in rows if r["file"].endswith("broken.wav")] == [True]
    out = tmp_path / "out"
    assert {str(p.relative_to(out)) for p in out.rglob("*") if p.is_file() and not p.name.endswith(".crc")} == {
        "talk_segments/talk_001.wav", "talk_segments/talk_002.wav", "talk_segments/talk_003.wav", "talk_segments/talk.srt",
        "loud one_segments/loud one_001.wav", "loud one_segments/loud one.srt", "quiet_segments/quiet_001.wav", "quiet_segments/quiet.srt",
    }
    assert length(out / "talk_segments/talk_002.wav") == (14_200, 2)
    srt = (out / "talk_segments/talk.srt").read_text()
    assert srt.startswith("1\n00:00:00,000 --> 00:00:04,300\n") and "bytes" in srt and srt.count("-->") == 3

    seen = jobs.split_recordings(listed, None, jobs.SplitOptions(max_segment=30_000)).where("error is null")
    assert seen.count() == 3 and {r["text"] for r in seen.collect()} == {""}
    with pytest.warns(UserWarning, match="preview"):
        jobs.split_recordings(listed.where("path like '%quiet%'"), None, options)


SRT = "1\n00:00:00,500 --> 00:00:04,000\nfirst\n\n2\n00:00:05,000 --> 00:00:08,000\n(noise)\n\n3\n00:00:09,000 --> 00:00:12,000\nlast\n"


@pytest.mark.parametrize("action", ["none", "pad", "remove"])
def test_cut_by_cues(spark, tmp_path, action):
    (tmp_path / "a b.srt").write_text(SRT)
    (tmp_path / "a b.wav").write_bytes(recording([(1000, 0), (9000, 9000), (4000, 0)]))
    (tmp_path / "alone.srt").write_text(SRT)
    options = jobs.CueOptions(keep_folder=True, action=action, target=700, jitter=0)
    with pytest.warns(UserWarning, match="1 recordings"):
        rows = jobs.cut_by_cues(spark, [str(tmp_path / "a b.srt"), str(tmp_path / "alone.srt")], f"file://{tmp_path}/out", options)
    # From the first cue's start to halfway to the next one's; the remark is left out; to halfway to the end of 14 s.
    assert sorted((r["clip"], r["ms"]) for r in rows.collect()) == [(1, 4000), (2, 4500)]
    want = {"none": [4000, 4500], "pad": [4000 + 200 + 700, 4500 + 700], "remove": [4000, 4500 - 2300]}[action]
    assert [length(tmp_path / f"out/wavs/a b/a_b_{i}.wav") for i in (1, 2)] == [(n, 3) for n in want]
    lines = spark.read.text(f"{tmp_path}/out/metadata").collect()
    assert sorted(r[0] for r in lines) == ["a b/a_b_1.wav|first", "a b/a_b_2.wav|last"]
    meta = jobs.cut_by_cues(spark, [str(tmp_path / "a b.srt")], str(tmp_path / "m"), jobs.CueOptions(meta_only=True))
    assert meta.count() == 2 and not (tmp_path / "m/wavs").exists()
    assert {r[0] for r in spark.read.text(f"{tmp_path}/m/metadata").collect()} == {"a_b_1.wav|first", "a_b_2.wav|last"}
