"""Subtitle, metadata and JSON-lines output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import label
from ..functions.times import clock
from ..operators.manifest import json_lines


def srt_blocks(segments: DataFrame) -> DataFrame:
    """(file, idx, block) from (file, idx, export_start, export_end, text)."""
    block = F.concat_ws("\n", F.col("idx").cast("string"), F.concat(clock("export_start"), F.lit(" --> "), clock("export_end")), label("text", "idx"), F.lit(""))
    return segments.select("file", "idx", block.alias("block"))


def srt_files(segments: DataFrame) -> DataFrame:
    """(file, content): one subtitle file for each recording."""
    blocks = F.array_sort(F.collect_list(F.struct("idx", "block")))  # a recording's own
    return srt_blocks(segments).groupBy("file").agg(F.array_join(F.transform(blocks, lambda x: x["block"]), "\n").alias("content"))


def preview(segments: DataFrame) -> DataFrame:
    """(file, idx, start, end, seconds): what an export would write."""
    length = (F.col("export_end") - F.col("export_start")) / 1000.0
    return segments.select("file", "idx", clock("export_start", ".").alias("start"), clock("export_end", ".").alias("end"), length.alias("seconds"))


def clip_names(segments: DataFrame, prefix: Column | str = "file", fmt: str = "wav") -> DataFrame:
    """``segments`` with ``name``: prefix_001.wav, as many digits as the file's number of clips has, three at least."""
    count = F.count("*").over(Window.partitionBy("file"))
    width = F.greatest(F.lit(3), F.length(count.cast("string")))
    number = F.lpad(F.col("idx").cast("string"), width, F.lit("0"))
    start = F.col(prefix) if isinstance(prefix, str) else prefix
    return segments.withColumn("name", F.concat(start, F.lit("_"), number, F.lit(f".{fmt}")))


def append_metadata(lines: DataFrame, folder: str) -> None:
    """Metadata lines added to those in ``folder``; a second run adds them again."""
    lines.select("line").write.mode("append").text(folder)


def write_json_lines(samples: DataFrame, folder: str) -> None:
    """JSON lines in the DataFrame's order, replacing what is there."""
    samples.select(json_lines(samples).alias("value")).write.mode("overwrite").text(folder)


def write_texts(texts: DataFrame, folder: str, content: str = "text") -> None:
    """One text for each row."""
    texts.select(content).write.mode("overwrite").text(folder)
