"""Language identification from averaged hashed subword embeddings."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from .bytetext import text_bytes
from .shared import quoted

SIZES = (2, 3, 4)  #: bytes of a subword
BUCKETS = 1 << 15
DIMENSIONS = 16
CHUNK = 1 << 18  #: bytes whose subwords are looked up at once
SAMPLE_PER_LANGUAGE = 800  #: training documents of a language at most
SAMPLE = 16_000  #: training documents of all languages at most
REJECT_SHARE = 0.001  #: share of the calibration documents that may be rejected
FAMILIAR_SHARE = 0.1  #: share of a language's training documents that a familiar subword is in
CALIBRATION = 100  #: calibration documents up to which no text is too unfamiliar; with more the limit rises to theirs
UNDETERMINED = "und"

# ASCII letters in lower case, other ASCII as one blank, bytes of longer characters as they are.
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], dtype=np.uint32)


def subwords(data: np.ndarray, starts: np.ndarray, a: int, b: int) -> Iterator[np.ndarray]:
    """For each size, the bucket of the subword ending at every byte of [a, b).

    ``starts`` holds the start of the text that each of those bytes belongs to.  A
    subword that would begin before it gets bucket ``BUCKETS``, which counts for nothing.
    """
    lead = min(a, max(SIZES) - 1)
    folded = _FOLD[data[a - lead : b]]
    ends = np.arange(a, b)
    h = np.zeros(b - a, dtype=np.uint32)
    for n in range(1, max(SIZES) + 1):
        reach = np.zeros(b - a, dtype=np.uint32)
        skip = max(0, n - 1 - lead)
        reach[skip:] = folded[lead + skip - n + 1 : lead + b - a - n + 1]
        h = (h * np.uint32(0x01000193)) ^ (reach + np.uint32(n << 8))
        if n in SIZES:
            x = h * np.uint32(0x9E3779B1)
            bucket = (x >> np.uint32(17)).astype(np.int32)
            bucket[ends - (n - 1) < starts] = BUCKETS
            yield bucket


@dataclass
class LanguageModel:
    """Languages, the logit that each bucket adds for each, bias, temperature and the score below which a text is rejected.

    ``familiar`` marks the buckets that are common in one of the languages; a text with a
    smaller share of them than ``least_familiar`` is in none of the languages.
    """

    languages: list[str]
    logits: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0
    familiar: np.ndarray | None = None
    least_familiar: float = 0.0

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated probabilities (texts x languages) of the texts between consecutive offsets, and their shares of familiar subwords."""
        n, c = len(offsets) - 1, len(self.languages)
        total, count = np.zeros((n, c + 1)), np.zeros(n)
        familiar = np.ones(BUCKETS) if self.familiar is None else self.familiar
        table = np.vstack([np.column_stack([self.logits, familiar]), np.zeros((1, c + 1))]).astype(np.float32)
        for a in range(int(offsets[0]), int(offsets[-1]), CHUNK):
            b = min(a + CHUNK, int(offsets[-1]))
            first, last = np.searchsorted(offsets, [a, b - 1], side="right") - 1
            docs = np.arange(first, last + 1)
            docs = docs[offsets[docs + 1] > offsets[docs]]  # empty texts own no byte
            cut = np.maximum(offsets[docs], a) - a
            starts = np.repeat(offsets[docs], np.diff(np.append(cut, b - a)))
            for bucket in subwords(data, starts, a, b):
                total[docs] += np.add.reduceat(table[bucket], cut, axis=0)
                count[docs] += np.add.reduceat(bucket < BUCKETS, cut)
        mean = total / np.maximum(count, 1)[:, None]
        return softmax((mean[:, :c] + self.bias) / self.temperature), np.where(count > 0, mean[:, c], 1.0)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


Bag = tuple[np.ndarray, np.ndarray]  #: a text's buckets and the share of its subwords in each


def bag(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text's subwords and how many are in each, in passes of ``CHUNK`` bytes."""
    counts = np.zeros(BUCKETS + 1, np.int64)
    for a in range(0, len(data), CHUNK):
        b = min(len(data), a + CHUNK)
        for bucket in subwords(data, np.zeros(b - a, np.int64), a, b):
            counts += np.bincount(bucket, minlength=BUCKETS + 1)
    ids = np.flatnonzero(counts[:BUCKETS])
    return ids.astype(np.int32), counts[ids].astype(np.int32)


def train(counted: list[tuple[np.ndarray, np.ndarray]], languages: list[str], epochs: int = 4, rate: float = 1.0, seed: int = 7) -> LanguageModel:
    """Stochastic gradient descent on all but a fifth of the texts, given as :func:`bag`; that fifth calibrates.

    A text's vector is the mean of its subwords' embeddings; a linear softmax over it
    gives the languages.  The temperature minimises the calibration texts' log loss.
    The threshold rejects ``REJECT_SHARE`` of them at most, and never a text whose best
    language has half of the probability.

    Probabilities say which of the known languages is nearest, not whether one is near.
    For that, a text's share of familiar subwords is held against the calibration texts'
    shares, of which ``REJECT_SHARE`` at most may be below the limit, too.  A few documents
    say little about the smallest share to expect, so the limit lies below theirs by a part
    that shrinks as their number grows: the whole of it up to ``CALIBRATION`` of them, then as one over their number.
    """
    known = sorted(set(languages))
    y = np.array([known.index(x) for x in languages])
    rng = np.random.default_rng(seed)
    bags: list[Bag] = [(ids, (n / max(1, n.sum())).astype(np.float32)) for ids, n in counted]
    order = rng.permutation(len(bags))
    held = order[: len(order) // 5]
    fit = order[len(order) // 5 :]
    e = rng.normal(0, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    w = np.zeros((DIMENSIONS, len(known)), np.float32)
    bias = np.zeros(len(known), np.float32)
    steps, done = epochs * len(fit), 0
    for _ in range(epochs):
        for i in rng.permutation(fit):
            ids, share = bags[i]
            step = rate * (1 - done / steps)
            done += 1
            h = share @ e[ids]
            z = h @ w + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            g = w @ p
            w -= step * np.outer(h, p)
            bias -= step * 0.1 * p
            e[ids] -= step * 8 * np.outer(share, g)
    model = LanguageModel(known, (e @ w).astype(np.float32), bias)
    if len(held):
        seen = np.zeros((BUCKETS, len(known)))
        for i in fit:
            seen[bags[i][0], y[i]] += 1
        model.familiar = (seen >= np.maximum(1, FAMILIAR_SHARE * np.bincount(y[fit], minlength=len(known)))).any(axis=1)
        shares = np.sort([bags[i][1] @ model.familiar[bags[i][0]] if len(bags[i][0]) else 1.0 for i in held])
        lowest = float(shares[int(len(shares) * REJECT_SHARE)])
        loose = lowest * min(1.0, CALIBRATION / len(shares))
        model.least_familiar = lowest - loose - 1e-5  # for the rounding of sums
    if len(held) and len(known) > 1:
        z = np.array([bags[i][1] @ model.logits[bags[i][0]] + bias for i in held])
        loss = {t: -np.log(softmax(z / t)[np.arange(len(held)), y[held]] + 1e-12).mean() for t in np.geomspace(0.05, 20, 61)}
        model.temperature = float(min(loss, key=loss.get))
        best = np.sort(softmax(z / model.temperature).max(axis=1))
        model.threshold = float(min(0.5, best[int(len(best) * REJECT_SHARE)]))
    return model


def held_out(doc_id: Column) -> Column:
    """True for the third of the documents that training never sees; a null id counts as ''."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def training_sample(docs: DataFrame, languages: int | None = None) -> DataFrame:
    """(lang, h, ids, n): the bags of the documents drawn for training, by a hash of id and text.

    A first pass estimates how many different documents each language has.  All of them, or
    the ``languages`` most frequent ones, get ``SAMPLE_PER_LANGUAGE`` documents each, or an
    equal part of ``SAMPLE`` if that is less, and one at least.  Only documents whose hash falls into the share that
    holds three times as many are shuffled and ranked, and whole texts of any length are
    made bags of, whose size is bounded.  So neither shuffle nor sample grows with the
    number of rows, repeated rows count once, and no length is left out.
    """
    labelled = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}"))
    draw = labelled.select(F.col("lang").cast("string").alias("lang"), "text", F.xxhash64(F.col("doc_id"), "text", F.lit("draw")).alias("h"))
    sizes = draw.groupBy("lang").agg(F.approx_count_distinct("h", 0.03).alias("n")).orderBy(F.desc("n"), "lang")
    sizes = (sizes if languages is None else sizes.limit(languages)).collect()  # a row for each language that the model will hold
    each = max(1, min(SAMPLE_PER_LANGUAGE, SAMPLE // max(1, len(sizes))))
    shares = [(r["lang"], int(min(1.0, 3 * each / max(1, r["n"])) * (1 << 32))) for r in sizes]
    limits = docs.sparkSession.createDataFrame(shares, "lang string, below long")
    within = draw.join(F.broadcast(limits), "lang").where(F.pmod("h", F.lit(1 << 32)) < F.col("below"))
    once = within.groupBy("lang", "h").agg(F.min("text").alias("text"))
    order = Window.partitionBy("lang").orderBy("h")
    drawn = once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= each).select("lang", "h", "text")

    def run(batches):
        for batch in batches:
            data, at = text_bytes(batch.column("text"))
            bags = [bag(data[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            columns = [pa.array([x[i] for x in bags], pa.list_(pa.int32())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("h"), *columns], ["lang", "h", "ids", "n"])

    return drawn.mapInArrow(run, "lang string, h long, ids array<int>, n array<int>")


def trained(docs: DataFrame, languages: int | None = None) -> LanguageModel:
    """A model of the languages of ``docs``, trained on the driver on the bounded :func:`training_sample`."""
    sample = training_sample(docs, languages).orderBy("lang", "h").toArrow()
    if not sample.num_rows:
        return LanguageModel([], np.zeros((0, 0)), np.zeros(0))
    ids, n = ([np.asarray(x.values) for x in sample.column(c)] for c in ("ids", "n"))
    return train(list(zip(ids, n, strict=True)), sample.column("lang").to_pylist())


def language_id(docs: DataFrame, model: LanguageModel | None = None, languages: int | None = None) -> DataFrame:
    """``docs`` with held_out boolean, lang_pred string, score double and rejected boolean.

    Without a ``model`` one is trained first, on the driver, on the bounded
    ``training_sample`` of the same table.  Every label is learned; the model has a row of
    weights for each, so ``languages`` may keep it to the most frequent ones where labels
    are many and mostly noise: texts of the others then get the nearest one that is known,
    or are rejected.  With few calibration documents the rejection is looser (see
    :func:`train`).  Every whole text is scored in its own scan task, without a shuffle.

    A null text, or one without a letter, gets `und`, score 0 and is rejected, as is
    every text if nothing was labelled.  A text in none of the learned languages keeps
    its nearest one and its score, and is rejected.  Rows are judged alone, so ties and repeated
    rows don't matter; existing columns of the new names are replaced.  An empty table
    gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model or trained(docs, languages))
    new = ["held_out", "lang_pred", "score", "rejected"]
    kept = [c for c in docs.columns if c.lower() not in new]
    marked = docs.select(
        F.struct(*[quoted(c).alias(c) for c in kept]).alias("row"), held_out(F.col("doc_id")).alias("held_out"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")
    )
    place = kept.index("text")

    def predict(batches):
        m = sent.value
        for batch in batches:
            letters = np.asarray(batch.column("letters").to_numpy(zero_copy_only=False), dtype=bool)
            lang = np.full(batch.num_rows, UNDETERMINED, dtype=object)
            score, far = np.zeros(batch.num_rows), np.zeros(batch.num_rows, bool)
            if m.languages and batch.num_rows:
                data, offsets = text_bytes(pc.struct_field(batch.column("row"), [place]))
                p, near = m.scores(data, offsets)
                far = near < m.least_familiar
                lang[letters] = np.array(m.languages, dtype=object)[p.argmax(axis=1)][letters]
                score[letters] = p.max(axis=1)[letters]
            rejected = ~letters | (lang == UNDETERMINED) | (score < m.threshold) | far
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)], ["row", *new])

    kinds = [BooleanType(), StringType(), DoubleType(), BooleanType()]
    out = marked.mapInArrow(predict, StructType([marked.schema["row"], *[StructField(c, t) for c, t in zip(new, kinds, strict=True)]]))
    return out.select(*[F.col("row").getField(c).alias(c) for c in kept], *new)
