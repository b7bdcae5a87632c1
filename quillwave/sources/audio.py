"""PCM audio as energy frames and clips."""

from __future__ import annotations

import io
import struct
import wave
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.files import store_of

SPAN_MS = 120_000  #: stretch of a recording that one row of work reads
HEAD = "file string, data_at long, frames long, rate int, channels int, width int, error string"


def read_wavs(spark: SparkSession, path: str) -> DataFrame:
    """(file, content)."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")


def samples(content: bytes) -> tuple[np.ndarray, wave._wave_params]:
    """Samples (frames x channels, as 64-bit whole numbers) of a PCM WAV file of 8 to 32 bits."""
    with wave.open(io.BytesIO(content)) as f:
        params, raw = f.getparams(), f.readframes(f.getnframes())
    return _unpacked(raw, params.sampwidth, params.nchannels), params


def _unpacked(data: bytes, width: int, channels: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    if width == 1:
        x = raw.astype(np.int64) - 128
    else:
        wide = np.zeros((len(raw) // width, 8), np.uint8)
        wide[:, 8 - width :] = raw.reshape(-1, width)
        x = wide.view("<i8").ravel() >> (64 - 8 * width)
    return x.reshape(-1, channels)


def _packed(x: np.ndarray, width: int, channels: int, rate: int) -> bytes:
    """A WAV file of the samples, which have ``width`` bytes each."""
    data = x.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width] if width > 1 else (x + 128).astype(np.uint8)
    target = io.BytesIO()
    with wave.open(target, "wb") as f:
        f.setnchannels(channels)
        f.setsampwidth(width)
        f.setframerate(rate)
        f.writeframes(data.tobytes())
    return target.getvalue()


def energy(files: DataFrame) -> DataFrame:
    """(file, ms, ss, n, error): sum of squares and number of samples of every millisecond; a file that can't be read gives its error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "ms", "ss", "n", "error"]
        for batch in batches:
            for file, content in zip(batch.column("file").to_pylist(), batch.column("content"), strict=True):
                try:
                    x, params = samples(content.as_py() or b"")
                    ms = np.arange(len(x)) * 1000 // params.framerate
                    total = int(ms[-1]) + 1 if len(x) else 0
                    ss = np.bincount(ms, (x.astype(float) ** 2).sum(axis=1), minlength=total)
                    n = np.bincount(ms, minlength=total) * params.nchannels
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([file] * total, pa.string()), pa.array(np.arange(total)), pa.array(ss), pa.array(n), pa.nulls(total, pa.string())], names
                    )
                except (wave.Error, EOFError, ValueError) as e:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([file]), pa.array([None], pa.int64()), pa.array([None], pa.float64()), pa.array([None], pa.int64()), pa.array([str(e)])], names
                    )

    return files.select("file", "content").mapInArrow(run, "file string, ms long, ss double, n long, error string")


def durations(frames: DataFrame) -> DataFrame:
    """(file, total) in ms."""
    return frames.where("error is null").groupBy("file").agg((F.max("ms") + 1).alias("total"))


def cut_clips(files: DataFrame, spans: DataFrame, bits: int | None = None) -> DataFrame:
    """(file, idx, content): a WAV file for each span (file, idx, start, end, pad_lead, pad_tail in ms) of each recording.

    ``bits``: 16, 24 or 32 for samples of that width, whatever the recording's; None keeps its own.
    """
    if bits not in (None, 16, 24, 32):
        raise ValueError("bits is 16, 24 or 32")
    listed = spans.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("idx", "start", "end", "pad_lead", "pad_tail"))).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x, params = samples(row["content"])
                width = bits // 8 if bits else params.sampwidth
                x = _widened(x, params.sampwidth, width)
                out = []
                for s in row["spans"]:
                    a, b, lead, tail = (s[k] * params.framerate // 1000 for k in ("start", "end", "pad_lead", "pad_tail"))
                    clip = np.pad(x[a:b], ((lead, tail), (0, 0)))
                    out.append((row["file"], s["idx"], _packed(clip, width, params.nchannels, params.framerate)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.binary())],
                    ["file", "idx", "content"],
                )

    return files.join(listed, "file").select("file", "content", "spans").mapInArrow(run, "file string, idx long, content binary")


def _widened(x: np.ndarray, width: int, wanted: int) -> np.ndarray:
    up = 8 * (wanted - width)
    return x << up if up >= 0 else x >> -up


def wav_head(file, size: int) -> tuple[int, int, int, int, int]:
    """(place of the samples, number of frames, frames a second, channels, bytes a sample) of an open PCM WAV file.

    Chunks are walked by their heads alone.  RF64 and BW64 files keep sizes beyond 32 bits
    in a chunk of their own.  Samples end with the file where the head promises more.
    """

    def read(at: int, n: int) -> bytes:
        file.seek(at)
        out = file.read(n)
        if len(out) < n:
            raise ValueError("the file ends in a chunk's head")
        return out

    kind, _, form = struct.unpack("<4sI4s", read(0, 12))
    if kind not in (b"RIFF", b"RF64", b"BW64") or form != b"WAVE":
        raise ValueError("no WAV file")
    at, long_size, layout = 12, None, None
    while at + 8 <= size:
        name, n = struct.unpack("<4sI", read(at, 8))
        if name == b"ds64":
            long_size = struct.unpack("<Q", read(at + 16, 8))[0]
        elif name == b"fmt ":
            code, channels, rate, _, align, bits = struct.unpack("<HHIIHH", read(at + 8, 16))
            if code == 0xFFFE and n >= 26:  # extensible: the format is the first part of a longer id
                code = struct.unpack("<H", read(at + 32, 2))[0]
            if code != 1 or bits not in (8, 16, 24, 32) or not channels or not rate or align != channels * bits // 8:
                raise ValueError(f"format {code} of {bits} bits is not PCM that can be read")
            layout = rate, channels, bits // 8
        elif name == b"data":
            if not layout:
                raise ValueError("samples come before their format")
            n = long_size if n == 0xFFFFFFFF and long_size is not None else n
            return at + 8, min(n, size - at - 8) // (layout[1] * layout[2]), *layout
        at += 8 + n + n % 2
    raise ValueError("no samples")


def wav_heads(files: DataFrame) -> DataFrame:
    """(file, data_at, frames, rate, channels, width, error) of the WAV files (path) named; a file that can't be read gives its error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path in batch.column("file").to_pylist():
                try:
                    store, place = store_of(path)
                    with store.open_input_file(place) as file:
                        rows.append((path, *wav_head(file, file.size()), None))
                except (OSError, ValueError) as e:
                    rows.append((path, *[None] * 5, str(e)))
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["file", "data_at", "frames", "rate", "channels", "width", "error"])

    return files.select(F.col("path").alias("file")).repartition("file").mapInArrow(run, HEAD)


def list_wavs(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of files, without reading them."""
    return spark.read.format("binaryFile").load(path).select("path", "length")


def durations_of(heads: DataFrame) -> DataFrame:
    """(file, total) in ms, from the heads alone."""
    return heads.where("error is null and frames > 0").select("file", (F.floor((F.col("frames") - 1) * 1000 / F.col("rate")) + 1).cast("long").alias("total"))


def _frame_of(ms: int, rate: int) -> int:
    """The first frame of a millisecond."""
    return -(-ms * rate // 1000)


def energy_by_ranges(heads: DataFrame, span_ms: int = SPAN_MS) -> DataFrame:
    """(file, ms, ss, n): what :func:`energy` gives for files that can be read, a stretch of ``span_ms`` at a time.

    Each stretch is a row of work of its own that reads its bytes alone, so a recording of
    any length is read by many tasks, and none holds more than a stretch.
    """
    timed = heads.join(durations_of(heads), "file")
    work = timed.select("file", "data_at", "frames", "rate", "channels", "width", "total", F.explode(F.sequence(F.lit(0).cast("long"), F.col("total") - 1, F.lit(span_ms).cast("long"))).alias("a"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                b = min(r["a"] + span_ms, r["total"])
                first, last = _frame_of(r["a"], r["rate"]), min(_frame_of(b, r["rate"]), r["frames"])
                x = _unpacked(_range(r["file"], r["data_at"], first, last, r["width"] * r["channels"]), r["width"], r["channels"])
                ms = np.arange(first, last) * 1000 // r["rate"] - r["a"]
                ss = np.bincount(ms, (x.astype(float) ** 2).sum(axis=1), minlength=b - r["a"])
                n = np.bincount(ms, minlength=b - r["a"]) * r["channels"]
                names = pa.DictionaryArray.from_arrays(pa.array(np.zeros(b - r["a"], np.int32)), pa.array([r["file"]])).cast(pa.string())
                yield pa.RecordBatch.from_arrays([names, pa.array(np.arange(r["a"], b)), pa.array(ss), pa.array(n)], ["file", "ms", "ss", "n"])

    return work.repartition("file", "a").mapInArrow(run, "file string, ms long, ss double, n long")


def _range(path: str, data_at: int, first: int, last: int, frame: int) -> bytes:
    store, place = store_of(path)
    with store.open_input_file(place) as file:
        file.seek(data_at + first * frame)
        out = file.read((last - first) * frame)
    if len(out) < (last - first) * frame:
        raise OSError(f"{path} became shorter")
    return out


def cut_ranges(heads: DataFrame, spans: DataFrame, bits: int | None = None) -> DataFrame:
    """(file, idx, content): as :func:`cut_clips`, each clip read by its own range of bytes, whatever its recording's length.

    Spans (file, idx, start, end, pad_lead, pad_tail in ms) end with their recording; those of
    files that can't be read give nothing.
    """
    if bits not in (None, 16, 24, 32):
        raise ValueError("bits is 16, 24 or 32")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                rate, channels = r["rate"], r["channels"]
                a, b, lead, tail = (r[k] * rate // 1000 for k in ("start", "end", "pad_lead", "pad_tail"))
                a, b = min(a, r["frames"]), min(max(a, b), r["frames"])
                width = bits // 8 if bits else r["width"]
                x = _widened(_unpacked(_range(r["file"], r["data_at"], a, b, r["width"] * channels), r["width"], channels), r["width"], width)
                content = _packed(np.pad(x, ((lead, tail), (0, 0))), width, channels, rate)
                yield pa.RecordBatch.from_arrays([pa.array([r["file"]]), pa.array([r["idx"]], pa.int64()), pa.array([content], pa.binary())], ["file", "idx", "content"])

    work = spans.select("file", "idx", "start", "end", "pad_lead", "pad_tail").join(heads.where("error is null"), "file")
    return work.repartition("file", "idx").mapInArrow(run, "file string, idx long, content binary")
