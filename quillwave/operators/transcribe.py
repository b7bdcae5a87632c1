"""Speech recognition behind an interface: any recogniser, loaded once by each task, fed in batches, long recordings in windows."""

from __future__ import annotations

import os
import re
import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sinks.written import written
from ..sources import audio


@dataclass(frozen=True)
class Recognition:
    """How a recogniser runs; what a backend has no use for, it leaves aside."""

    device: str | None = None  #: None: the library's own choice
    half: bool | None = None  #: 16-bit weights; None: on a graphics device only
    max_new_tokens: int = 445  #: of one window
    beams: int = 1
    batch: int = 16  #: clips at once
    task: str = "transcribe"


Recognise = Callable[[list[bytes], str | None], list[str]]  #: texts of WAV files, in a language or any
BACKENDS: dict[str, Callable[[str, Recognition], Recognise]] = {}  #: name -> loader of a model
WINDOW_MS, OVERLAP_MS = 30_000, 5_000  #: of windows of long recordings


def backend(name: str) -> Callable:
    """Registers a loader: a function from a model's name or path, and how it is to run, to a recogniser of several clips."""

    def add(load: Callable[[str, Recognition], Recognise]) -> Callable[[str, Recognition], Recognise]:
        BACKENDS[name] = load
        return load

    return add


@backend("stub")
def stub(model: str, how: Recognition) -> Recognise:
    """Says how many bytes it heard; for tests, and where no model is installed."""
    return lambda clips, language: [f"{len(c)} bytes" for c in clips]


@backend("levels")
def levels(model: str, how: Recognition) -> Recognise:
    """Reads out the first channel's samples; what windows and their seams can be checked with."""
    return lambda clips, language: [" ".join(map(str, audio.samples(c)[0][:, 0].tolist())) for c in clips]


@backend("openai-whisper")
def openai_whisper(model: str, how: Recognition) -> Recognise:
    import tempfile

    import whisper  # optional

    loaded = whisper.load_model(model, device=how.device)
    options = {"task": how.task} | ({} if how.half is None else {"fp16": how.half}) | ({"beam_size": how.beams} if how.beams > 1 else {})

    def one(content: bytes, language: str | None) -> str:
        with tempfile.NamedTemporaryFile(suffix=".wav") as f:  # the library reads files; it goes with the clip
            f.write(content)
            f.flush()
            return loaded.transcribe(f.name, language=language, **options)["text"].strip()

    return lambda clips, language: [one(c, language) for c in clips]


@backend("transformers")
def transformers(model: str, how: Recognition) -> Recognise:
    import torch  # optional
    from transformers import pipeline  # optional

    device = how.device or ("cuda" if torch.cuda.is_available() else "cpu")
    half = device.startswith("cuda") if how.half is None else how.half
    loaded = pipeline(
        "automatic-speech-recognition", model=model, device=device, torch_dtype=torch.float16 if half else torch.float32,
        chunk_length_s=WINDOW_MS // 1000, batch_size=how.batch,
    )
    loaded.model.generation_config.forced_decoder_ids = None  # an old field of fine-tuned models that newer versions refuse

    def recognise(clips: list[bytes], language: str | None) -> list[str]:
        said = {"task": how.task, "num_beams": how.beams, "max_new_tokens": how.max_new_tokens} | ({"language": language} if language else {})
        heard = loaded(list(clips), return_timestamps=True, generate_kwargs=said)
        return [" ".join(part["text"].strip() for part in h["chunks"]).strip() for h in heard]

    return recognise


@backend("faster-whisper")
def faster_whisper(model: str, how: Recognition) -> Recognise:
    import io

    from faster_whisper import WhisperModel  # optional

    loaded = WhisperModel(model, device=how.device or "auto", compute_type="default" if how.half is None else "float16" if how.half else "float32")

    def one(content: bytes, language: str | None) -> str:
        pieces, _ = loaded.transcribe(io.BytesIO(content), language=language, task=how.task, beam_size=how.beams, max_new_tokens=how.max_new_tokens)
        return "".join(p.text for p in pieces).strip()

    return lambda clips, language: [one(c, language) for c in clips]


def detect_backend(path: Column | str, listing_names: Column | str) -> Column:
    """The backend of a model from the names in its folder (null: not a folder, so a file or an official name)."""
    names = F.col(listing_names) if isinstance(listing_names, str) else listing_names
    return F.when(names.isNull(), "openai-whisper").when(F.array_contains(names, "model.bin"), "faster-whisper").otherwise("transformers")


def backend_of(model: str) -> str:
    """The same for a model's name or a local path, looked up where this runs.  A folder that no backend knows goes to `transformers`, with a warning."""
    if not os.path.isdir(model):
        return "openai-whisper"
    names = os.listdir(model)
    if "model.bin" in names:
        return "faster-whisper"
    if "config.json" not in names:
        warnings.warn(f"{model} holds neither model.bin nor config.json; taken for transformers", stacklevel=2)
    return "transformers"


def _heard(recognise: Recognise, clips: list[bytes], language: str | None, size: int) -> list[tuple[str | None, str | None]]:
    """(text, error) of each clip.  Clips go in batches of like length; one that fails is tried clip by clip."""
    out: list[tuple[str | None, str | None]] = [(None, None)] * len(clips)
    order = sorted(range(len(clips)), key=lambda i: len(clips[i]))
    todo = [order[i : i + size] for i in range(0, len(order), size)]
    while todo:
        part = todo.pop()
        try:
            texts = recognise([clips[i] for i in part], language)
            if len(texts) != len(part):
                raise ValueError(f"{len(texts)} texts of {len(part)} clips")
            for i, text in zip(part, texts):
                out[i] = (text, None)
        except Exception as e:  # noqa: BLE001  the clip's own failure is its result
            if len(part) == 1:
                out[part[0]] = (None, str(e))
            else:
                todo += [[i] for i in part]
    return out


def transcribe(clips: DataFrame, model: str, kind: str = "stub", language: str | None = None, how: Recognition | None = None) -> DataFrame:
    """(file, idx, text, error) from (file, idx, content): clips meet their text by key, and one bad clip fails alone.

    ``kind``: a name in ``BACKENDS``, or `auto` for the one that ``backend_of`` the model gives.
    A null content counts as an empty one.
    """
    kind, how = backend_of(model) if kind == "auto" else kind, how or Recognition()
    if kind not in BACKENDS:
        raise ValueError(f"unknown backend {kind!r}")
    if how.batch < 1:
        raise ValueError("a batch holds a clip at least")
    load = BACKENDS[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recognise = load(model, how)
        for whole in batches:
            for at in range(0, whole.num_rows, 8 * how.batch):  # so many to choose like lengths from
                batch = whole.slice(at, 8 * how.batch)
                heard = _heard(recognise, [c or b"" for c in batch.column("content").to_pylist()], language, how.batch)
                texts, errors = (pa.array(x, pa.string()) for x in zip(*heard, strict=True))
                yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("idx"), texts, errors], ["file", "idx", "text", "error"])

    return clips.select("file", F.col("idx").cast("long").alias("idx"), "content").mapInArrow(run, "file string, idx long, text string, error string")


def windows(totals: DataFrame, window: int = WINDOW_MS, overlap: int = OVERLAP_MS) -> DataFrame:
    """(file, idx, start, end, pad_lead, pad_tail) of (file, total) in ms: stretches that overlap, the last up to the end; spans of clips."""
    if not 0 <= overlap < window:
        raise ValueError("an overlap is shorter than its window")
    step = window - overlap
    last = F.ceil(F.greatest(F.col("total") - window, F.lit(0)) / step)
    start, zero = F.col("idx") * step, F.lit(0).cast("long")
    numbered = totals.select("file", "total", F.explode(F.sequence(zero, last)).alias("idx"))
    return numbered.select("file", "idx", start.alias("start"), F.least(start + window, "total").alias("end"), zero.alias("pad_lead"), zero.alias("pad_tail"))


_CLOSE = "\u3040-\u30ff\u3400-\u9fff"  #: scripts written without blanks
_TOKENS = re.compile(f"[{_CLOSE}]|[^\\s{_CLOSE}]+")
SEAM = "ends long, begins long"


def _token(x: str) -> str:
    return "".join(c for c in x if c.isalnum()).casefold() or x


def seam(before: str, after: str, share: float) -> tuple[int, int]:
    """(where the earlier text ends, where the later one begins), in characters, of two windows that share a part of their sound.

    Of all overlaps of the last tokens of one with the first of the other, up to twice what the
    share of the sound suggests and four more, that with the most tokens equal beyond those that differ counts, the
    longest of several; it is cut in its middle, as words at a window's edge are heard worst.  Where
    more differ than agree in all, both texts stay whole.
    """
    x, y = list(_TOKENS.finditer(before)), list(_TOKENS.finditer(after))
    most = min(len(x), len(y), int(2 * share * max(len(x), len(y))) + 4)
    u, v = [_token(t.group()) for t in x[len(x) - most :]], [_token(t.group()) for t in y[:most]]
    best, size = 0, 0
    for n in range(1, most + 1):
        score = 2 * sum(p == q for p, q in zip(u[most - n :], v)) - n
        if score > 0 and score >= best:
            best, size = score, n
    if not size:
        return len(before), 0
    ends = x[len(x) - size + (size + 1) // 2 - 1].end()
    return ends, y[(size + 1) // 2].start() if (size + 1) // 2 < len(y) else len(after)


def stitched(parts: DataFrame, window: int = WINDOW_MS, overlap: int = OVERLAP_MS) -> DataFrame:
    """(file, text) of the texts (file, idx, text) of a recording's windows, what two neighbours both heard told once.

    Each window is sent to the seams before and behind it, and what the seams leave of it put
    together: seams are found wherever they are in a recording, and ``parts`` is read once.  A window without
    text (null, too) has none; of several rows of one window the greatest text counts.  Text that repeats itself over a seam may
    lose a repetition.
    """
    share = overlap / window

    @F.pandas_udf(SEAM)
    def cut(before: pd.Series, after: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(None, None) if a is None or b is None else seam(a, b, share) for a, b in zip(before, after, strict=True)], columns=["ends", "begins"])

    none = lambda kind: F.lit(None).cast(kind)
    here = lambda *columns: F.struct(*[c.alias(n) for c, n in columns])
    idx, text = F.col("idx").cast("long"), F.coalesce("text", F.lit(""))
    sides = F.array(here((idx, "seam"), (text, "before"), (none("string"), "after")), here((idx - 1, "seam"), (none("string"), "before"), (text, "after")))
    seams = parts.select("file", F.inline(sides)).groupBy("file", "seam").agg(F.max("before").alias("before"), F.max("after").alias("after"))
    cuts = seams.select("file", "seam", "before", cut("before", "after").alias("cut"))
    left = here((F.col("seam"), "idx"), (F.col("before"), "text"), (F.col("cut.ends"), "ends"), (none("long"), "begins"))
    right = here((F.col("seam") + 1, "idx"), (none("string"), "text"), (none("long"), "ends"), (F.col("cut.begins"), "begins"))
    told = cuts.select("file", F.inline(F.array(left, right))).groupBy("file", "idx").agg(*[F.max(c).alias(c) for c in ("text", "ends", "begins")]).where("text is not null")
    begins, ends = F.coalesce("begins", F.lit(0)), F.coalesce("ends", F.length("text"))
    kept = F.trim(F.substring("text", begins.cast("int") + 1, F.greatest(ends - begins, F.lit(0)).cast("int")))
    own = F.transform(F.array_sort(F.collect_list(F.struct("idx", "kept"))), lambda x: x["kept"])  # a recording's own
    pieces = told.select("file", "idx", kept.alias("kept")).groupBy("file").agg(F.filter(own, lambda x: x != "").alias("own"))
    before = lambda i: F.get("own", i - 1)
    blank = lambda x, i: F.when((i == 0) | (before(i).rlike(f"[{_CLOSE}]$") & x.rlike(f"^[{_CLOSE}]")), "").otherwise(" ")
    return pieces.select("file", F.array_join(F.transform("own", lambda x, i: F.concat(blank(x, i), x)), "").alias("text"))


def transcribe_recordings(
    heads: DataFrame, model: str, kind: str = "auto", language: str | None = None, how: Recognition | None = None, window: int = WINDOW_MS, overlap: int = OVERLAP_MS
) -> DataFrame:
    """(file, text, failed): whole recordings (heads) transcribed in windows by many tasks, and the number of windows that failed.

    A failed window leaves a gap in the text.  Files that can't be read give nothing.
    """
    spans = windows(audio.durations_of(heads), window, overlap)
    parts = written(transcribe(audio.cut_ranges(heads, spans.repartition("file", "idx")), model, kind, language, how))
    failed = parts.groupBy("file").agg(F.count("error").alias("failed"))
    return stitched(parts, window, overlap).join(failed, "file")


def joined_text(parts: DataFrame, separator: str = " ") -> DataFrame:
    """(file, text): a file's recognised pieces in order, blanks at the end stripped."""
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("idx", "text"))), lambda x: F.coalesce(x["text"], F.lit("")))
    return parts.groupBy("file").agg(F.rtrim(F.array_join(pieces, separator)).alias("text"))
