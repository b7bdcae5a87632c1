"""Whole jobs over many recordings: from audio to clips, subtitles and transcripts, and from subtitles to clips and metadata."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import basename, stem, with_suffix
from ..sinks import files as file_sinks
from ..sinks import texts
from ..sinks.written import written
from ..sources import audio, subtitles
from . import cues, silence, transcribe


@dataclass
class SplitOptions:
    """How recordings are split.  Times are in ms; a threshold of None is each recording's loudness less 16 dB."""

    min_silence: int = 500
    threshold_db: float | None = None
    step: int = 1
    min_segment: int = 3000
    max_segment: int = 15_000
    keep_silence: int = 300
    prefix: str | None = None  #: of clip names; None: the recording's own name
    bits: int | None = None  #: of a clip's samples; None: as in the recording
    srt: bool = False
    model: str | None = None  #: of a recogniser; None: no transcripts
    backend: str = "auto"
    language: str | None = None
    recognition: transcribe.Recognition = field(default_factory=transcribe.Recognition)


def full_scale(width: Column) -> Column:
    """The largest amplitude of samples of so many bytes."""
    return F.pow(F.lit(2.0), 8 * width - 1)


def limits(frames: DataFrame, heads: DataFrame, threshold_db: float | None) -> DataFrame:
    """(file, limit): the mean square up to which a window is silent; 0 for a recording of silence alone."""
    scale = heads.where("error is null").select("file", full_scale(F.col("width")).alias("scale"))
    if threshold_db is None:
        levels = silence.auto_threshold(frames, full_scale=1.0).join(scale, "file")
        return levels.select("file", F.coalesce(F.pow(F.lit(10.0), F.col("threshold") / 10), F.lit(0.0)).alias("limit"))
    return scale.select("file", (F.pow(F.lit(10.0), F.lit(threshold_db / 10)) * F.col("scale") * F.col("scale")).alias("limit"))


def segments_of(heads: DataFrame, options: SplitOptions) -> DataFrame:
    """(file, idx, raw_start, raw_end, export_start, export_end, name) of the recordings whose heads can be read."""
    frames = audio.energy_by_ranges(heads)
    known = frames.join(limits(frames, heads, options.threshold_db), "file")
    found = written(silence.silences(known, "limit", options.min_silence, options.step))
    totals = written(audio.durations_of(heads))
    cut = written(silence.split(totals, found, options.min_segment, options.max_segment))
    trimmed = silence.trim(cut, found, totals, options.keep_silence)
    prefix = stem(basename("file")) if options.prefix is None else F.lit(options.prefix)
    return texts.clip_names(trimmed, prefix=prefix)


def folder_of(file: str) -> Column:
    """stem_segments: a recording's clips are there."""
    return F.concat(stem(basename(file)), F.lit("_segments"))


def split_recordings(recordings: DataFrame, out: str | None, options: SplitOptions | None = None) -> DataFrame:
    """Splits every recording (path) at its silences; returns its segments, with text and error, as a written table.

    Below ``out`` each recording gets a folder with its clips, and with ``srt`` a subtitle
    file; with a ``model`` clips are transcribed and the text goes into both.  Without
    ``out`` nothing but the segments is made, a preview.  Files appear when all of them
    are done; two that would have one name are an error.  A recording that can't be read has one row with
    its error and no segment; a clip that can't be transcribed keeps its error and an empty text.
    """
    options = options or SplitOptions()
    heads = written(audio.wav_heads(recordings))
    segments = written(segments_of(heads, options))
    if out is None and options.model:
        warnings.warn("a preview isn't transcribed", stacklevel=2)
    spoken = segments.select("file", "idx", F.lit("").alias("text"), F.lit(None).cast("string").alias("error"))
    if out is not None:
        zero = F.lit(0).cast("long")
        spans = segments.select("file", "idx", F.col("export_start").alias("start"), F.col("export_end").alias("end"), zero.alias("pad_lead"), zero.alias("pad_tail"))
        clips = audio.cut_ranges(heads, spans, options.bits)
        named = clips.join(segments.select("file", "idx", F.concat(folder_of("file"), F.lit("/"), "name").alias("name")), ["file", "idx"])
        file_sinks.write_files(named, out)
        if options.model:
            heard = transcribe.transcribe(clips, options.model, options.backend, options.language, options.recognition)
            spoken = written(heard.select("file", "idx", F.coalesce("text", F.lit("")).alias("text"), "error"))
        if options.srt:
            prefix = stem(basename("file")) if options.prefix is None else F.lit(options.prefix)
            srt = texts.srt_files(segments.join(spoken.drop("error"), ["file", "idx"]))
            file_sinks.write_files(srt.select(F.concat(folder_of("file"), F.lit("/"), prefix, F.lit(".srt")).alias("name"), "content"), out)
    done = segments.join(spoken, ["file", "idx"], "left")
    return written(done.unionByName(heads.where("error is not null").select("file", "error"), allowMissingColumns=True))


@dataclass
class CueOptions:
    """How subtitles cut their recordings.  action: none, pad or remove the silence at a clip's ends, to ``target`` ms give or take ``jitter``."""

    keep_folder: bool = False
    meta_only: bool = False
    action: str = "none"
    target: int = 480
    jitter: int = 20
    threshold_db: float = -45.0
    chunk: int = 10


def edges_of(clips: DataFrame, heads: DataFrame, options: CueOptions) -> DataFrame:
    """(file, idx, pad_lead, pad_tail, cut_lead, cut_tail) of clips (file, idx, content), each judged in chunks from its own start."""
    keyed = clips.select(F.concat("idx", F.lit("/"), "file").alias("file"), "content")
    frames = audio.energy(keyed).where("error is null").withColumn("chunk", F.floor(F.col("ms") / options.chunk))
    levels = frames.groupBy("file", "chunk").agg((F.sum("ss") / F.sum("n")).alias("ms_level"))
    part = F.split("file", "/", 2)
    levels = levels.select(part[1].alias("audio"), F.col("file"), "chunk", "ms_level").join(heads.select(F.col("file").alias("audio"), full_scale(F.col("width")).alias("scale")), "audio")
    db = F.when(F.col("ms_level") > 0, 10 * F.log10("ms_level") - 20 * F.log10("scale"))
    found = silence.edge_silence(levels.select("file", "chunk", db.alias("level")), F.lit(options.threshold_db), options.chunk)
    out = silence.adjust_edges(found, options.action, options.target, options.jitter)
    return out.select(part[1].alias("file"), part[0].cast("long").alias("idx"), "pad_lead", "pad_tail", "cut_lead", "cut_tail")


def cut_by_cues(spark: SparkSession, paths: list[str], out: str, options: CueOptions | None = None) -> DataFrame:
    """Cuts each subtitle file's recording (the same name, ending in .wav) at its cues; returns (file, clip, ms) as a written table.

    Clips, of 24 bits, go to `wavs` below ``out``, in a folder of the subtitle file's name
    with ``keep_folder``, and their lines are added to `metadata` there.  A
    subtitle file whose recording is missing or can't be read gives a warning and nothing.
    """
    options = options or CueOptions()
    found = written(subtitles.read_cues(spark, paths)).withColumn("audio", with_suffix("file", ".wav"))
    heads = written(audio.wav_heads(found.select(F.col("audio").alias("path")).distinct()))
    lost = heads.where("error is not null").count()
    if lost:
        warnings.warn(f"{lost} recordings are missing or can't be read", stacklevel=2)
    totals = audio.durations_of(heads).select(F.col("file").alias("audio"), F.col("total").alias("audio_ms"))
    clips = written(cues.clips(found.join(totals, "audio"), "audio_ms").withColumn("audio", with_suffix("file", ".wav")))
    zero = F.lit(0).cast("long")
    spans = clips.select(F.col("audio").alias("file"), F.col("clip").alias("idx"), "start", "end", zero.alias("pad_lead"), zero.alias("pad_tail"))
    name = stem(basename("file"))
    lines = cues.metadata_lines(clips.withColumn("file", name), options.keep_folder)
    if not options.meta_only:
        if options.action != "none":
            edges = edges_of(audio.cut_ranges(heads, spans), heads, options)
            spans = spans.drop("pad_lead", "pad_tail").join(edges, ["file", "idx"])
            last = F.col("end") - F.col("cut_tail")
            spans = spans.select("file", "idx", F.least(F.col("start") + F.col("cut_lead"), F.col("end")).alias("start"), last.alias("end"), "pad_lead", "pad_tail")
        names = clips.select(F.col("audio").alias("file"), F.col("clip").alias("idx"), clip_path(options.keep_folder).alias("name"))
        file_sinks.write_files(audio.cut_ranges(heads, spans, bits=24).join(names, ["file", "idx"]), f"{out.rstrip('/')}/wavs")
    texts.append_metadata(lines, f"{out.rstrip('/')}/metadata")
    return written(clips.select(F.col("file"), "clip", (F.col("end") - F.col("start")).alias("ms")))


def clip_path(keep_folder: bool) -> Column:
    """The name of a cue's clip, as its metadata line gives it."""
    own = stem(basename("file"))
    name = F.concat(F.replace(own, F.lit(" "), F.lit("_")), F.lit("_"), F.col("clip").cast("string"), F.lit(".wav"))
    return F.concat(own, F.lit("/"), name) if keep_folder else name
