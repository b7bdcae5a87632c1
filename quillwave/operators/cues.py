"""Clip intervals from subtitle cues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import col, skipped


def clips(cues: DataFrame, audio_ms: Column | str) -> DataFrame:
    """(file, clip, start, end, text) from (file, cue_no, start, end, text).

    Clips meet halfway between neighbouring cues; the first starts with its cue and the
    last ends halfway to the end of the audio.  Remarks (``skipped``) between the first
    and the last cue give no clip but still bound their neighbours.  Clips are numbered
    from 1 after that.  A file with one cue gives one clip.

    One shuffle by file; the second window has the same partitioning and order.
    """
    order = Window.partitionBy("file").orderBy("cue_no")
    begin = F.coalesce(F.expr("(lag(end) over w + start) div 2".replace("over w", "over (partition by file order by cue_no)")), F.col("start"))
    stop = F.coalesce(F.lead("start").over(order), col(audio_ms))
    placed = cues.select(
        "file",
        "cue_no",
        "text",
        begin.alias("a"),
        F.floor((F.col("end") + stop) / 2).cast("long").alias("b"),
        (F.lag("cue_no").over(order).isNull() | F.lead("cue_no").over(order).isNull()).alias("outer"),
    )
    kept = placed.where(F.col("outer") | ~skipped("text"))
    return kept.select(
        "file", F.row_number().over(order).cast("long").alias("clip"), F.col("a").alias("start"), F.col("b").alias("end"), "text"
    )


def metadata_lines(clips: DataFrame, keep_folder: bool = False, sanitize: bool = False) -> DataFrame:
    """(file, clip, line): `[file/]file_clip.wav|text`; blanks in the name become underscores, the folder keeps them.

    Line breaks and bars in a text pass through, as in the files that other tools read;
    ``sanitize`` turns them into blanks.
    """
    name = F.concat(F.replace("file", F.lit(" "), F.lit("_")), F.lit("_"), F.col("clip").cast("string"), F.lit(".wav"))
    name = F.concat(F.col("file"), F.lit("/"), name) if keep_folder else name
    text = F.translate("text", "\n\r|", "   ") if sanitize else F.col("text")
    return clips.select("file", "clip", F.concat_ws("|", name, text).alias("line"))


def total_ms(clips: DataFrame) -> DataFrame:
    """(clips, total_ms) over all files."""
    return clips.agg(F.count("*").alias("clips"), F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0)).alias("total_ms"))
