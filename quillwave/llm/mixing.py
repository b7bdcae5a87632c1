"""Sources mixed to target weights: document rates by entropy balancing, rounded into copies."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import dropped, numbered, numbered_within, persisted, shared_dir

WEIGHTS = (3, 1, 2)
ROUNDS = 60  #: Newton rounds at most; each halves the interval where it doesn't do better
NEAR, LEAST = 1e-10, 1e-6  #: how far a source's expected words may be from its target: this share, or so many words
EXACT = "decimal(38,9)"  #: sums in it don't depend on their order, so that runs agree


def word_count(text: str) -> Column:
    """Maximal runs of characters other than space and U+0009-000D; none in null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...], percent: int, most: int) -> DataFrame:
    """``sources`` (none, source, words) with target double.

    Sources in the order of their names by code point, null (none) last, weigh ``weights``
    in turn and share ``percent`` of all words in a hundred.  None gets more than ``most``
    times its words; what is over is shared again among those below, until none is above.
    Each round is one sum over the sources that may still grow.
    """
    placed = numbered(sources, [F.col("none").asc(), F.col("source").asc()], "place")
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    weighed = persisted(placed.select(*sources.columns, turn.cast("double").alias("weight"), (most * F.col("words")).cast("double").alias("cap")))
    total = weighed.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    rate = 0.0
    while True:
        full = F.col("cap") <= rate * F.col("weight")
        kept, open_ = weighed.agg(F.coalesce(F.sum(F.when(full, F.col("cap").cast(EXACT))), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))).first()
        new = (percent / 100 * total - float(kept)) / open_ if open_ else rate
        if new <= rate:
            return weighed.select(*sources.columns, F.least(F.col("cap"), F.lit(rate) * F.col("weight")).alias("target"))
        rate = new


def _rate(most: int) -> Column:
    """A document's expected copies: exponentially tilted by its size, ``most`` at most; ``most`` for all where the source's target asks for it."""
    return F.when(F.col("all_of_it"), F.lit(float(most))).otherwise(F.least(F.lit(float(most)), F.exp(F.col("tilt") * F.col("z"))))


def tilts(sizes: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """(none, source, tilt, scale, all_of_it): for each source the tilt at which its documents' expected words are its target.

    The rates nearest to one copy each, in relative entropy, with the target's words and at
    most ``most`` copies of a document, are exp(tilt * z) where that is less, z being the
    size over the source's mean size by words.  The dual is convex and has a term for each
    source, so one distributed round sums the gradient and its slope of all of them, from the numbers
    of documents of each size.  A Newton step that leaves the interval known to hold the
    root is replaced by its middle.
    """
    spark = sizes.sparkSession
    key = ["none", "source"]
    state = sources.select(*key, "target", (F.col("squares") / F.col("words")).alias("scale"), (F.col("target") >= most * F.col("words") * (1 - 1e-12)).alias("all_of_it"))
    state = state.select("*", F.lit(0.0).alias("tilt"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"), F.lit(False).alias("done"))
    path, old = shared_dir(spark), None
    state = persisted(state, path)
    for _ in range(ROUNDS):
        met = sizes.join(state.where("not done and not all_of_it and target > 0"), key).withColumn("z", F.col("size") / F.col("scale"))
        words, rate = F.col("n") * F.col("size"), _rate(most)
        sums = met.groupBy(*key).agg(
            F.sum((words * rate).cast(EXACT)).cast("double").alias("found"),
            F.sum(F.when(rate < most, words * rate * F.col("z")).otherwise(0.0).cast(EXACT)).cast("double").alias("slope"),
        )
        out = state.join(sums, key, "left").withColumn("off", F.col("found") - F.col("target"))
        low = F.when(F.col("off") < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(F.col("off") > 0, F.col("tilt")).otherwise(F.col("high"))
        step = F.col("tilt") - F.col("off") / F.when(F.col("slope") > 0, F.col("slope"))
        middle = F.when(F.col("low").isNull(), 2 * F.col("high") - 1).when(F.col("high").isNull(), 2 * F.col("low") + 1).otherwise((F.col("low") + F.col("high")) / 2)
        inside = (F.col("low").isNull() | (step > F.col("low"))) & (F.col("high").isNull() | (step < F.col("high"))) & (F.abs(step - F.col("tilt")) <= 4)
        out = out.withColumn("done", F.col("done") | F.col("found").isNull() | (F.abs(F.col("off")) <= F.greatest(F.lit(LEAST), NEAR * F.col("target")))).withColumns({"low": low, "high": high})
        out = out.withColumn("tilt", F.when(F.col("done"), F.col("tilt")).when(F.coalesce(inside, F.lit(False)), step).otherwise(middle))
        old, path = path, shared_dir(spark)
        state = persisted(out.drop("found", "slope", "off"), path)
        dropped(spark, old)
        if not state.where("not done").head(1):
            break
    return state.select(*key, "tilt", "scale", "all_of_it")


def rounded(rates: DataFrame, most: int) -> DataFrame:
    """(none, source, size, base, more): each document of that size is taken ``base`` times, and ``more`` of them once more.

    ``rates``: (none, source, size, n, rate), a row for each size of a source.  From the
    largest size to the smallest, what is over or missing is carried to the next, so a
    source's words end within about half of its smallest documents.  Copies stay between none and
    ``most`` of each document.  A source's sizes are read in order and none is held; there are
    as many as different sizes, whatever the number of documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, over = None, 0.0
        for batch in batches:
            base, more = [], []
            for none, source, size, n, rate in zip(*(batch.column(c).to_pylist() for c in ("none", "source", "size", "n", "rate")), strict=True):
                if (none, source) != key:
                    key, over = (none, source), 0.0
                want = n * rate + over / size
                copies = min(max(round(want), 0), most * n)
                over = (want - copies) * size
                base.append(copies // n)
                more.append(copies % n)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("none", "source", "size")), pa.array(base, pa.int64()), pa.array(more, pa.int64())], ["none", "source", "size", "base", "more"])

    placed = rates.repartition("none", "source").sortWithinPartitions("none", "source", F.desc("size"))
    return placed.select("none", "source", "size", "n", "rate").mapInArrow(run, "none boolean, source string, size long, base long, more long")


def mix(docs: DataFrame, percent: int = 150, weights: tuple[int, ...] = WEIGHTS, most: int = 2, seed: int = 2024) -> DataFrame:
    """doc_id, size, source_size long, target double, taken and copies long of every document.

    Sources share ``percent`` of all words by ``weights`` (see :func:`targets`), none more
    than ``most`` times its own.  In each source the documents' rates are tilted towards long
    or short ones, as its target asks (:func:`tilts`), and rounded into whole copies, the
    documents of one size that are taken once more being drawn by a hash of id, text and ``seed``
    (:func:`rounded`); taken is size times copies.  Runs agree on any cluster: sums are decimal,
    draws are hashes.

    A source of a few documents is as near its target as whole copies get.  Nulls: a null
    text has no words; a null source is one of its own, the last; a null id draws like
    another.  Repeated rows are documents each for itself, which ones of equal rows are
    taken once more is all the same.  Documents without words are taken no time, and so are
    all of a source without words.  Extra columns are ignored.  An empty table gives an empty one.
    """
    source = F.col("source").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        source.isNull().alias("none"),
        F.coalesce(source, F.lit("")).alias("source"),
        word_count("text").alias("size"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("draw"),
    )
    rows, key = persisted(rows), ["none", "source"]
    sizes = persisted(rows.groupBy(*key, "size").agg(F.count("*").alias("n")))
    words = F.coalesce(F.sum(F.col("n") * F.col("size")), F.lit(0))
    squares = F.coalesce(F.sum((F.col("n") * F.col("size") * F.col("size")).cast("decimal(38,0)")), F.lit(0)).cast("double")
    sources = sizes.groupBy(*key).agg(words.alias("words"), squares.alias("squares"))
    aimed = persisted(targets(sources, weights, percent, most))
    sized = sizes.where("size > 0")
    known = tilts(sized, aimed.where("words > 0"), most)
    rates = sized.join(known, key).withColumn("z", F.col("size") / F.col("scale")).select(*key, "size", "n", _rate(most).alias("rate"))
    copies = persisted(rounded(rates, most))
    placed = numbered_within(rows.where("size > 0").select("doc_id", *key, "size", "draw"), [*key, "size"], [F.col("draw").asc(), F.col("doc_id").asc_nulls_first()])
    taken = placed.join(copies, [*key, "size"], "left").select("doc_id", *key, "size", (F.col("base") + (F.col("place") < F.col("more")).cast("long")).alias("copies"))
    none = rows.where("size = 0").select("doc_id", *key, "size", F.lit(0).cast("long").alias("copies"))
    out = taken.unionByName(none).join(aimed.select(*key, F.col("words").alias("source_size"), "target"), key, "left")
    copies_ = F.coalesce("copies", F.lit(0)).cast("long")
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * copies_).alias("taken"), copies_.alias("copies"))
