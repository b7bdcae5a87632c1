"""Subtitle and text files as cues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.paths import suffix
from ..functions.text import ass_text, strip
from ..functions.times import ass_ms, srt_ms

CUE = ["file", "cue_no", "start", "end", "text"]


def whole_texts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, value): each file's text, line ends as line feeds, no byte-order mark."""
    # The path comes with its blanks and other characters encoded, plus signs as they are.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    raw = spark.read.text(paths, wholetext=True).select(path.alias("file"), "value")
    return raw.withColumn("value", F.regexp_replace(F.regexp_replace("value", "\\A\ufeff", ""), "\r\n?", "\n"))


def numbered_lines(texts: DataFrame) -> DataFrame:
    """(file, line_no, value); a final line feed ends the last line."""
    lines = F.split(F.regexp_replace("value", "\n\\z", ""), "\n")
    return texts.select("file", F.posexplode(lines).alias("line_no", "value"))


def srt_cues(texts: DataFrame) -> DataFrame:
    """Cues of (file, value) in file order: blocks parted by blank lines, an index line, a time line, text lines.

    Blocks without a valid time line give no cue.
    """
    blocks = texts.select("file", F.posexplode(F.split("value", r"\n[ \t]*\n+")).alias("n", "block"))
    lines = F.filter(F.split("block", "\n"), lambda x: strip(x) != "")
    timed = blocks.withColumn("lines", lines).withColumn("at", F.array_position(F.transform("lines", lambda x: x.contains("-->")), True))
    timed = timed.where("at > 0").withColumn("times", F.split(F.element_at("lines", F.col("at").cast("int")), "-->"))
    end = F.split(F.trim(F.element_at("times", 2)), r"\s+")[0]
    rows = timed.select("file", "n", srt_ms(F.element_at("times", 1)).alias("start"), srt_ms(end).alias("end"), F.array_join(F.slice("lines", (F.col("at") + 1).cast("int"), F.size("lines")), "\n").alias("text"))
    order = Window.partitionBy("file").orderBy("n")
    return rows.where("start is not null and end is not null").withColumn("cue_no", F.row_number().over(order).cast("long")).select(*CUE)


def ass_cues(texts: DataFrame) -> DataFrame:
    """Cues of styled subtitles, by start and then file order.

    The columns of `Dialogue:` lines are those of the last `Format:` line of the events
    section before them, without one the format's usual ones; the text, as many commas as
    it holds, is cut off at its column.  Any line that begins with a bracket ends a section.
    Lines outside that section, comments, short lines and lines without valid times give
    no cue.
    """
    lines = numbered_lines(texts).withColumn("value", strip("value"))
    order = Window.partitionBy("file").orderBy("line_no")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    section = F.last_value(F.when(F.col("value").startswith("["), F.lower("value")), F.lit(True)).over(upto)
    inside = lines.withColumn("section", section).where(F.col("section") == "[events]")
    names = F.transform(F.split(F.regexp_extract("value", r"(?i)^format:(.*)$", 1), ","), lambda x: F.lower(F.trim(x)))
    formatted = inside.withColumn("names", F.last_value(F.when(F.lower("value").startswith("format:"), names), F.lit(True)).over(upto))
    spoken = formatted.where(F.lower("value").startswith("dialogue:"))
    usual = {"start": 2, "end": 3, "text": 10}  # fixed values: layer, start, end, style, name, three margins, effect, text
    place = {c: F.coalesce(F.array_position("names", c).cast("int"), F.when(F.col("names").isNull(), n)) for c, n in usual.items()}
    spoken = spoken.select("file", "line_no", *[place[c].alias(f"{c}_at") for c in place], F.regexp_extract("value", r"(?i)^dialogue:(.*)$", 1).alias("v"))
    spoken = spoken.where("start_at > 0 and end_at > 0 and text_at > 0").withColumn("f", F.split("v", ","))
    spoken = spoken.where(F.size("f") >= F.col("text_at"))
    rows = spoken.select(
        "file",
        "line_no",
        ass_ms(F.try_element_at("f", F.col("start_at"))).alias("start"),
        ass_ms(F.try_element_at("f", F.col("end_at"))).alias("end"),
        ass_text(F.array_join(F.slice("f", F.col("text_at"), F.size("f")), ",")).alias("text"),
        (F.greatest("start_at", "end_at") < F.col("text_at")).alias("before"),
    )
    by_start = Window.partitionBy("file").orderBy("start", "line_no")
    return rows.where("before and start is not null and end is not null").withColumn("cue_no", F.row_number().over(by_start).cast("long")).select(*CUE)


def read_cues(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Cues of .srt and .ass files; another ending is an error."""
    kinds = {p.rpartition(".")[2].lower() for p in paths}
    if kinds - {"srt", "ass"}:
        raise ValueError(f"unknown subtitle format: {sorted(kinds - {'srt', 'ass'})}")
    texts = whole_texts(spark, paths)
    ending = F.lower(suffix("file"))
    return srt_cues(texts.where(ending == ".srt")).unionByName(ass_cues(texts.where(ending == ".ass")))
