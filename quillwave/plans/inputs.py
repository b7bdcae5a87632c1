"""The test tables seen as cues, recordings, manifests and file names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as subtitle files: turns in order, shown for 60 ms a character with 400 ms between; every third is a remark."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    order = Window.partitionBy("conv_id").orderBy("turn")
    shown = (F.length("text") * 60).cast("long")
    end = F.sum(shown + 400).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - 400
    text = F.when(F.col("turn") % 3 == 1, F.concat(F.lit(" (note) "), "text")).otherwise(F.col("text"))
    return rows.select(
        F.concat(F.lit("conv "), F.col("conv_id").cast("string")).alias("file"), F.col("turn").alias("cue_no"), (end - shown).alias("start"), end.alias("end"), text.alias("text")
    )


def cue_audio(cues: DataFrame) -> DataFrame:
    """``cues`` with audio_ms, a second beyond the last cue."""
    return cues.withColumn("audio_ms", F.max("end").over(Window.partitionBy("file")) + 1000)


def recordings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(file, total) and (file, s, e): a user's month of events, and its gaps of two hours or more as silences."""
    ms = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("long")
    rows = table(spark, sf_dir, "events").select(F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("file"), ms.alias("t"))
    first = Window.partitionBy("file")
    timed = rows.select("file", (F.col("t") - F.min("t").over(first)).alias("t"))
    gaps = timed.select("file", F.col("t").alias("s"), F.lead("t").over(first.orderBy("t")).alias("e")).where("e - s >= 7200000")
    return timed.groupBy("file").agg((F.max("t") + 1).alias("total")), gaps


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, ms, ss, n): a user's events in order as frames, the whole part of their value as the sum of squares."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("file"),
        (F.row_number().over(order) - 1).cast("long").alias("ms"),
        F.floor("value").cast("double").alias("ss"),
        F.lit(1).cast("long").alias("n"),
    )


def clip_name(one_folder: bool) -> Column:
    """A document's clip: in one of seven folders, or all in one, as most data sets have it."""
    folder = F.lit("clip") if one_folder else F.concat(F.lit("src"), (F.col("doc_id") % 7).cast("string"), F.lit("/clip"))
    return F.concat(folder, F.col("doc_id").cast("string"))


def manifest_lines(spark: SparkSession, sf_dir: str, one_folder: bool = False) -> DataFrame:
    """(line_no, value): documents as manifest lines of none to four fields, some empty."""
    name = clip_name(one_folder)
    name = F.when(F.col("doc_id") % 5 == 0, F.concat(name, F.lit(".wav"))).otherwise(name)
    text = F.regexp_replace("text", "[\n\r|]", " ")
    kind = F.col("doc_id") % 11
    value = (
        F.when(kind == 0, "")
        .when(kind == 1, name)
        .when(kind == 2, F.concat_ws("|", name, text, F.replace(text, F.lit("e"), F.lit("E"))))
        .when(kind == 3, F.concat_ws("|", name, text, F.lit("")))
        .when(kind == 4, F.concat_ws("|", name, text, text, F.lit("more")))
        .otherwise(F.concat_ws("|", name, F.concat(F.lit(" "), text, F.lit("\u3000"))))
    )
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("line_no"), value.alias("value"))


def audio_files(spark: SparkSession, sf_dir: str, one_folder: bool = False) -> DataFrame:
    """(path): the clips there are, those of nine documents in ten."""
    return table(spark, sf_dir, "documents").where(F.col("doc_id") % 10 != 9).select(F.concat(F.lit("wavs/"), clip_name(one_folder), F.lit(".wav")).alias("path"))


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, pos): a file for each document, named after its first line, in a folder of its source."""
    name = F.concat(F.replace(F.substring_index("text", "\n", 1), F.lit("/"), F.lit(" ")), F.lit(".txt"))
    return table(spark, sf_dir, "documents").select(F.concat_ws("/", "source", name).alias("path"), F.col("doc_id").alias("pos"))
