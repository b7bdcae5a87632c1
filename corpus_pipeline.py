"""Corpus cleaning in stages, from documents to packed sequences; each stage's decisions hold for the next.

All stages keep every column of their input, whatever its name and type; only ``text``
changes, and ``n_chars`` with it where there is such a column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwave.llm.language_id import language_id
from quillwave.llm.line_templates import line_dedup
from quillwave.llm.ngram_join import ngram_join
from quillwave.llm.packing import pack
from quillwave.llm.shared import persisted, quoted, scratch, shared_dir
from quillwave.llm.substring_dedup import substring_dedup
from quillwave.llm.vocabularies import vocabulary

CAPACITY = 4096


def _sheltered(docs: DataFrame) -> DataFrame:
    """doc_id, text and lang (null, if there is none) for an operator, and all columns but the text as one, so that no name clashes."""
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    return docs.select("doc_id", "text", lang.alias("lang"), F.struct(*[quoted(c).alias(c) for c in docs.columns if c != "text"]).alias("row"))


def _opened(docs: DataFrame, out: DataFrame, changed: bool = False) -> DataFrame:
    """An operator's rows with the columns of ``docs``; with ``changed`` n_chars follows the text."""
    own = {c: F.col("row").getField(c).alias(c) for c in docs.columns} | {"text": F.col("text")}
    if changed and "n_chars" in docs.columns:
        own["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return out.select(*[own[c] for c in docs.columns])


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without a letter or that fit none go.

    A null or empty text has no letter and goes.  Rows are judged alone, so repeated rows,
    null ids and ties don't matter.  Without a labelled row nothing is known and all go.
    """
    return _opened(docs, language_id(_sheltered(docs)).where(~F.col("rejected")))


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines whose template recurs across the corpus; likely copies stay whole for the next stage.

    Every row stays: a null text null, an empty one empty, and one of which all lines recur
    empty.  A null id is an id like others; rows equal in id and text are one document.
    """
    return _opened(docs, line_dedup(_sheltered(docs), spare_copies=True), changed=True)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by their word 5-grams, directly or through others, the one with the smallest id.

    Rows are judged one by one, by their ids where each row has its own, else under numbers
    that they get in a written copy: of repeated rows one stays, rows that share an id
    (null, too, which is the lowest) are told apart, and of equal ids the row written first
    stays.  Rows without a word (null, empty) are linked with nothing and all stay.
    """
    ids = docs.groupBy(F.col("doc_id").cast("long").alias("d")).count()
    shared_ids = bool(ids.where("count > 1 or d is null").head(1))
    number = F.monotonically_increasing_id() if shared_ids else F.col("doc_id").cast("long")
    numbered = docs.select(number.alias("n"), F.struct(*[quoted(c).alias(c) for c in docs.columns]).alias("row"))
    if shared_ids:
        numbered = persisted(numbered)
    groups = ngram_join(numbered.select(F.col("n").alias("doc_id"), "row.text"), size=5, percent=80).select(F.col("doc_id").alias("n"), "component_id")
    ids = numbered.select("n", F.col("row.doc_id").cast("long").alias("d"))
    first = ids.join(groups, "n").groupBy("component_id").agg(F.min(F.struct("d", "n")).alias("first")).select("first.n")
    return numbered.join(persisted(first), "n", "left_semi").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 20 words or more that appeared before.

    Every row stays; a text that is nothing but repeats becomes empty, a null one stays
    null.  Null ids come first, rows of one id are ordered by a digest of their text, and
    rows equal in both are one document.
    """
    return _opened(docs, substring_dedup(_sheltered(docs), window=20), changed=True)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences of ``CAPACITY`` ids.

    A row gives a piece at least: a null or empty text one of the end id alone.  Repeated
    rows and null ids are packed each for itself; columns beyond doc_id and text are left out.
    """
    return pack(docs, vocabulary("word_bpe_49k.json"), CAPACITY)


STAGES = [
    ("language_id", known_language),
    ("line_dedup", without_boilerplate),
    ("near_duplicates", one_of_each),
    ("substring_dedup", without_repeats),
    ("packing", packed),
]

#: SQL can't express the trained classifier; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again, and a stage's own tables go with it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_dir(spark)
        with scratch(spark):
            docs = persisted(stage(spark, docs, sf_dir), path)
    return docs
