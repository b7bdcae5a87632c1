"""Documents drawn so that their n-grams look like those of a target corpus, in DataFrame functions only."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import numbered, persisted

BUCKETS = 10_000
SCALE = 1000  #: parts into which logarithms are cut
WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  #: what lies between words once A-Z are lower-cased


def words(text: Column | str) -> Column:
    """The words of a text, A-Z lower-cased; none for null."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), ascii_uppercase, ascii_lowercase), WORD)
    return F.filter(parts, lambda w: w != "")


def features(text: Column | str, longest: int) -> Column:
    """All runs of 1 to ``longest`` words, joined by a space, repeats and all."""
    if longest == 1:
        return words(text)

    def runs(w: Column, n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - (n - 1), F.lit(1)))
        return F.when(F.size(w) >= n, F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(w, i + (j - 1)) for j in range(n)]))).otherwise(F.array().cast("array<string>"))

    # Words are made once and named by the lambda; as an expression they would be made for each run.
    return F.flatten(F.transform(F.array(words(text)), lambda w: F.concat(w, *[runs(w, n) for n in range(2, longest + 1)])))


def bucket(feature: Column | str, buckets: int) -> Column:
    return F.pmod(F.crc32(F.col(feature).cast("binary") if isinstance(feature, str) else feature.cast("binary")), F.lit(buckets)).cast("int")


def counted(texts: DataFrame, longest: int, buckets: int) -> DataFrame:
    """(bucket, n): the features of all texts by bucket; summed in each task before they are shuffled."""
    each = texts.select(F.explode(features("text", longest)).alias("feature"))
    return each.groupBy(bucket("feature", buckets).alias("bucket")).agg(F.count("*").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """(bucket, gain) of all buckets: how much more of the target's features than of the source's are in each, add-one smoothed.

    Two tables of ``buckets`` rows at most; the gain is a logarithm, times ``SCALE`` and rounded down.
    """
    s, t = source.select("bucket", F.col("n").alias("s")), target.select("bucket", F.col("n").alias("t"))
    sums = source.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all_s")).crossJoin(target.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all_t")))  # one row each
    spread = source.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(s, "bucket", "left").join(t, "bucket", "left")
    table = spread.na.fill(0, ["s", "t"]).crossJoin(F.broadcast(sums))
    d = lambda c: F.col(c).cast("double")
    ratio = ((d("t") + 1) * (d("all_s") + buckets)) / ((d("s") + 1) * (d("all_t") + buckets))
    return table.select("bucket", F.floor(SCALE * F.log(ratio)).cast("long").alias("gain"))


def noise(key: Column, seed: int) -> Column:
    """A Gumbel draw for each key, times ``SCALE`` and rounded down; the same on any cluster."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def importance_resample(docs: DataFrame, target: DataFrame, percent: int = 10, longest: int = 1, least_words: int = 20, buckets: int = BUCKETS, seed: int = 2024) -> DataFrame:
    """doc_id, n_features, weight, score and rank, all long, of every document; rank is null for those not drawn.

    Of the documents with ``least_words`` words, ``percent`` in a hundred are drawn without
    replacement with chances in proportion to exp(weight / 1000): a document's weight is
    the sum of its features' gains, its score adds a Gumbel draw of its id, and the
    highest scores are taken, ties to the smaller id.

    Features are exploded, hashed to buckets and counted in the tasks that read them. The
    table of gains has a row for each bucket, so it is broadcast, and a document's
    weight is summed where its text is read.  Scores are sorted in ranges by many tasks.

    Nulls: a null text has no words; a null id draws as an empty one and comes behind
    others in ties.  Repeated rows are documents each for itself, told apart in ties by any
    order, as they are alike.  Extra columns are ignored.  Without documents, or with fewer
    than 100 / ``percent`` that are long enough, nothing is drawn.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    table = persisted(gains(persisted(counted(rows, longest, buckets)), persisted(counted(target.select("text"), longest, buckets)), buckets))
    single = longest == 1
    n_words = F.lit(None).cast("long") if single else F.size(words("text")).cast("long")
    # Words are counted below the explosion, not for each of its rows.
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", n_words.alias("n_words"))
    each = rows.select("row", "doc_id", "n_words", F.explode_outer(features("text", longest)).alias("feature"))
    each = each.withColumn("bucket", bucket("feature", buckets)).join(F.broadcast(table), "bucket", "left")
    sums = each.groupBy("row", "doc_id", "n_words").agg(F.count("feature").alias("n_features"), F.coalesce(F.sum("gain"), F.lit(0)).alias("weight"))
    n_words = F.col("n_features") if single else F.col("n_words")
    scored = persisted(sums.select("doc_id", "n_features", "weight", (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score"), (n_words >= least_words).alias("long_enough")))
    ranked = numbered(scored.where("long_enough"), [F.col("score").desc(), F.col("doc_id").asc_nulls_last()], "rank")
    drawn = percent * scored.where("long_enough").count() // 100
    rank = F.when(F.col("rank") < drawn, F.col("rank") + 1)
    columns = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*columns, rank.cast("long").alias("rank")).unionByName(scored.where("not long_enough").select(*columns, F.lit(None).cast("long").alias("rank")))
