"""Manifest lines as a stream; an addition for live ingestion, with the batch operators' own expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.manifest import parse


def manifest_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Parsed rows of Parquet files of (line_no long, value string) as they arrive in ``folder``; stateless."""
    return parse(spark.readStream.schema("line_no long, value string").parquet(folder))
