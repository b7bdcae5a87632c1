"""WAV files read in ranges against the whole file."""

import io
import random
import struct
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillwave.operators import silence
from quillwave.sources import audio


def wav(x, rate, width, channels):
    return audio._packed(x, width, channels, rate)


def chunked(data, kind=b"RIFF", extensible=False, extra=True):
    """The same samples in a file with other chunks around them, its size given in ds64 if it is long."""
    with wave.open(io.BytesIO(data)) as f:
        p, raw = f.getparams(), f.readframes(f.getnframes())
    long = kind != b"RIFF"
    out = b"ds64" + struct.pack("<IQQQI", 28, 0, len(raw), 0, 0) if long else b""
    out += b"LIST" + struct.pack("<I", 5) + b"odd..\0" if extra else b""
    align = p.nchannels * p.sampwidth
    fmt = struct.pack("<HHIIHH", 0xFFFE if extensible else 1, p.nchannels, p.framerate, p.framerate * align, align, 8 * p.sampwidth)
    fmt += struct.pack("<HHIH", 22, 8 * p.sampwidth, 0, 1) + b"\0\0\0\0\x10\0\x80\0\0\xaa\0\x38\x9b\x71" if extensible else b""
    out += b"fmt " + struct.pack("<I", len(fmt)) + fmt + b"data" + struct.pack("<I", 0xFFFFFFFF if long else len(raw)) + raw
    return kind + struct.pack("<I", 0xFFFFFFFF if long else len(out) + 4) + b"WAVE" + out


@pytest.fixture(scope="module")
def recordings(tmp_path_factory):
    rng, folder = np.random.default_rng(3), tmp_path_factory.mktemp("wavs")
    plain = {}
    for i, (rate, width, channels, frames) in enumerate([(8000, 2, 1, 40_000), (44_100, 2, 2, 100_001), (11_025, 3, 1, 9_999), (16_000, 1, 1, 1), (22_050, 4, 2, 30_000), (700, 2, 1, 3000)]):
        x = rng.integers(-(1 << 8 * width - 1), 1 << 8 * width - 1, (frames, channels))
        plain[f"f{i}.wav"] = wav(x, rate, width, channels)
    files = dict(plain)
    files["f0.wav"] = chunked(plain["f0.wav"], b"RF64")
    files["f1.wav"] = chunked(plain["f1.wav"], extensible=True)
    for n, data in files.items():
        (folder / n).write_bytes(data)
    return folder, plain


def test_energy_over_edges(spark, recordings):
    folder, plain = recordings
    heads = audio.wav_heads(audio.list_wavs(spark, f"{folder}/f*.wav")).cache()
    assert heads.where("error is not null").count() == 0
    whole = spark.createDataFrame([(f"file:{folder}/{n}", bytearray(d)) for n, d in plain.items()], "file string, content binary")
    want = {(r["file"], r["ms"]): (r["ss"], r["n"]) for r in audio.energy(whole).collect()}
    for span in (777, 120_000):
        got = {(r["file"], r["ms"]): (r["ss"], r["n"]) for r in audio.energy_by_ranges(heads, span).collect()}
        assert got.keys() == want.keys()
        assert all(got[k][1] == want[k][1] and got[k][0] == pytest.approx(want[k][0], rel=1e-12) for k in want)
    totals = {r["file"]: r["total"] for r in audio.durations_of(heads).collect()}
    assert totals == {r["file"]: r["total"] for r in audio.durations(audio.energy(whole)).collect()}
    rnd, spans = random.Random(2), []
    for n in plain:
        for i in range(6):
            a = rnd.randrange(totals[f"file:{folder}/{n}"])
            spans.append((f"file:{folder}/{n}", i, a, min(a + rnd.randrange(3000), totals[f"file:{folder}/{n}"]), rnd.randrange(30), rnd.randrange(30)))
    spans = spark.createDataFrame(spans, "file string, idx long, start long, end long, pad_lead long, pad_tail long")
    for bits in (None, 24):
        assert {(r["file"], r["idx"]): r["content"] for r in audio.cut_ranges(heads, spans, bits).collect()} == {(r["file"], r["idx"]): r["content"] for r in audio.cut_clips(whole, spans, bits).collect()}


def test_broken_heads(spark, tmp_path):
    good = wav(np.zeros((100, 1), np.int64), 8000, 2, 1)
    cases = {"text": b"no wav file at all", "short": good[:30], "float": good.replace(b"fmt \x10\0\0\0\x01\0", b"fmt \x10\0\0\0\x03\0"), "headless": b"RIFF\0\0\0\0WAVE", "first": b"RIFF\0\0\0\0WAVEdata\x04\0\0\0....", "cut": good[:-50]}
    for n, data in cases.items():
        (tmp_path / f"{n}.wav").write_bytes(data)
    rows = {r["file"].rsplit("/", 1)[1]: r for r in audio.wav_heads(audio.list_wavs(spark, str(tmp_path))).collect()}
    assert rows["cut.wav"]["error"] is None and rows["cut.wav"]["frames"] == 75
    assert all(rows[f"{n}.wav"]["error"] for n in cases if n != "cut")
    gone = spark.createDataFrame([(f"file://{tmp_path}/gone.wav",)], "path string")
    assert audio.wav_heads(gone).first()["error"]
    assert audio.energy_by_ranges(audio.wav_heads(gone)).count() == 0


def test_long_file(spark, tmp_path):
    """An hour in ranges and blocks: the silences that were written, found by tasks that each see a part."""
    total, rng = 3600_000, np.random.default_rng(1)
    x, want, at = np.full(total, 1000, np.int64), [], 5000
    while at < total - 20_000:
        n = int(rng.integers(600, 9000))
        x[at : at + n] = 0
        if n >= 1000:
            want.append((at, at + n))
        at += n + int(rng.integers(300, 15_000))
    (tmp_path / "long.wav").write_bytes(wav(x[:, None], 1000, 2, 1))
    heads = audio.wav_heads(audio.list_wavs(spark, str(tmp_path)))
    frames = audio.energy_by_ranges(heads)
    assert audio.durations_of(heads).first()["total"] == total
    assert frames.count() == total and frames.selectExpr("ms div 120000 k").distinct().count() == 30
    assert sorted((r["s"], r["e"]) for r in silence.silences(frames, F.lit(0.0), 1000).collect()) == want
