"""Documents that share most of their word n-grams, by a blocked sparse product of document by n-gram incidence."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytetext import Words, mixed, new_key, text_bytes, words
from .components import components
from .shared import LOWEST, persisted

NGRAM, PERCENT = 5, 80
SAMPLE = 0.3  #: share of the hash range whose n-grams the first bound is computed on
BLOCK = 256  #: documents of a cluster that make a row block of the product, on average
BLOCK_GRAMS = 1 << 20  #: n-grams that a row block holds, on average; a single longer text is a block
INNER = 4096  #: n-grams of a column block
SPAN = 1 << 40  #: numbers of blocks that a band has room for
CLASS = ["k1", "k2", "n"]  #: what tells a class of equal sets: two hashes and the size


@dataclass
class Sets:
    """Sorted distinct n-gram hashes of some texts: values, and each text's first one."""

    h: np.ndarray
    at: np.ndarray
    twin: np.ndarray | None = None  #: the same n-grams' hashes under a second key

    @property
    def n(self) -> np.ndarray:
        return np.diff(self.at)


def ngram_sets(w: Words, size: int, short_ones: bool = False, second_key: int | None = None) -> Sets:
    """The set of every text; of one with fewer words than ``size`` its whole sequence, with ``short_ones``, else nothing."""
    counts = np.diff(w.at)
    short = np.flatnonzero((counts > 0) & (counts < size)) if short_ones else np.zeros(0, np.int64)

    def hashes(w: Words) -> tuple[np.ndarray, np.ndarray]:
        pos, h = w.runs(size)
        return pos, np.concatenate([h, w.spans(w.at[short], w.at[short + 1])])

    pos, h = hashes(w)
    doc = np.concatenate([w.doc[pos], short])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    twin = None if second_key is None else hashes(w.rehashed(second_key))[1][order][new]
    h, doc = h[new], doc[new]
    return Sets(h, np.searchsorted(doc, np.arange(len(counts) + 1)), twin)


def summed(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of x between consecutive places, modulo 2^64."""
    total = np.zeros(len(x) + 1, x.dtype)
    np.cumsum(x, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def slack(n: Column, percent: int) -> Column:
    """How many n-grams of a set of ``n`` may be missing in a set it links with: n - ceil(percent / 100 * n)."""
    return F.floor(n * (100 - percent) / 100).cast("long")


def digests(docs: DataFrame, size: int, key: int, with_text: bool = False) -> DataFrame:
    """(d, k1, k2, n, short): size and two hashes, under two keys, of every document's whole set; short: it has fewer words than an n-gram; the text, if asked for."""
    second = (key * 0x9E3779B97F4A7C15 + 1) % (1 << 64)

    def run(batches):
        for batch in batches:
            d = batch.column("d")
            for w in words(*text_bytes(batch.column("text")), key, lower=True):
                s = ngram_sets(w, size, short_ones=True, second_key=second)
                k1, k2 = (pa.array(summed(mixed(x), s.at).view(np.int64)) for x in (s.h, s.twin))
                short = pa.array(np.diff(w.at) < size)
                text = [batch.column("text").slice(w.first, len(s.n))] if with_text else []
                yield pa.RecordBatch.from_arrays([d.slice(w.first, len(s.n)), k1, k2, pa.array(s.n.astype(np.int64)), short, *text], ["d", "k1", "k2", "n", "short", *["text"] * with_text])

    return docs.select("d", "text").mapInArrow(run, "d long, k1 long, k2 long, n long, short boolean" + ", text string" * with_text)


def sampled(docs: DataFrame, size: int, share: float, key: int) -> DataFrame:
    """(h, d): the n-grams of every document whose hash is in the lowest ``share`` of the range."""
    limit = np.uint64(int(share * 2.0**64))

    def run(batches):
        for batch in batches:
            d = batch.column("d").to_numpy(zero_copy_only=False)
            for w in words(*text_bytes(batch.column("text")), key, lower=True):
                s = ngram_sets(w, size)
                low = s.h < limit
                doc = np.repeat(np.arange(len(s.n)), s.n)[low]
                yield pa.RecordBatch.from_arrays([pa.array(s.h[low].view(np.int64)), pa.array(d[w.first + doc])], ["h", "d"])

    return docs.select("d", "text").mapInArrow(run, "h long, d long")


def sets(docs: DataFrame, size: int, key: int) -> DataFrame:
    """(d, n, grams): every document's whole sorted set."""

    def run(batches):
        for batch in batches:
            d = batch.column("d")
            for w in words(*text_bytes(batch.column("text")), key, lower=True):
                s = ngram_sets(w, size)
                lists = pa.ListArray.from_arrays(pa.array(s.at.astype(np.int32)), pa.array(s.h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([d.slice(w.first, len(s.n)), pa.array(s.n.astype(np.int64)), lists], ["d", "n", "grams"])

    return docs.select("d", "text").mapInArrow(run, "d long, n long, grams array<long>")


def alone(incidence: DataFrame) -> DataFrame:
    """(d, own): how many n-grams of each document no other document has, in one aggregation and without a join."""
    single = incidence.groupBy("h").agg(F.min("d").alias("d"), F.max("d").alias("other")).where("d = other")
    return single.groupBy("d").agg(F.count("*").alias("own"))


def linked(grams: list[np.ndarray], rows: np.ndarray, percent: int) -> np.ndarray:
    """Which of the texts link, as a matrix; only pairs of one of ``rows`` with one outside, or within if all are.

    The product of the incidence matrix with its transpose is taken a block of n-grams
    at a time.  A pair is discarded as soon as its sizes, or its count and what is left
    of both sets, can't reach the overlap it needs; the product ends when no pair is left.
    """
    n = np.array([len(g) for g in grams])
    need = -(-percent * (n[:, None] + n[None, :]) // (100 + percent))
    open_ = (100 * np.minimum(n[:, None], n[None, :]) >= percent * np.maximum(n[:, None], n[None, :])) & (n[:, None] > 0) & (n[None, :] > 0)
    open_ &= np.triu(np.ones_like(open_), 1) if rows.all() else rows[:, None] & ~rows[None, :]
    doc = np.repeat(np.arange(len(grams)), n)
    _, column, df = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    shared = df > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    doc, column = doc[keep], number[column[keep]]
    left = np.bincount(doc, minlength=len(grams))
    order = np.argsort(column, kind="stable")
    doc, column = doc[order], column[order]
    count = np.zeros(open_.shape, np.int64)
    total = int(shared.sum())
    for a in range(0, total, INNER):
        open_ &= count + np.minimum(left[:, None], left[None, :]) >= need
        x, y = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
        if not len(x):
            break
        lo, hi = np.searchsorted(column, [a, a + INNER])
        block = np.zeros((len(grams), min(INNER, total - a)), np.float32)
        block[doc[lo:hi], column[lo:hi] - a] = 1
        count[np.ix_(x, y)] += (block[x] @ block[y].T).astype(np.int64)
        left -= np.bincount(doc[lo:hi], minlength=len(grams))
    return open_ & (count >= need)


def rooted(pairs: np.ndarray) -> np.ndarray:
    """The smallest index that each index reaches over a symmetric relation."""
    root = np.arange(len(pairs))
    while True:
        least = np.where(pairs, root[None, :], len(pairs)).min(axis=1, initial=len(pairs))
        new = np.minimum(root, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def products(blocks: DataFrame, percent: int) -> DataFrame:
    """(d, root, links) of each block pair: a spanning star of what links, and how many links each text has there.

    Rows arrive sorted by block pair and are worked on a pair at a time, so a task holds
    two blocks and no more.
    """

    def run(batches):
        key, held = None, []

        def flush():
            held.sort(key=lambda r: r[0])
            for i in range(len(held) - 1, 0, -1):  # repeated rows
                if held[i][0] == held[i - 1][0] and np.array_equal(held[i][2], held[i - 1][2]):
                    del held[i]
            if len(held) > 1:
                found = linked([r[2] for r in held], np.array([r[1] for r in held]), percent)
                found = found | found.T
                d, root = np.array([r[0] for r in held]), rooted(found)
                links = found.sum(axis=1)
                hit = np.flatnonzero(links)
                if len(hit):
                    yield pa.RecordBatch.from_arrays([pa.array(d[hit]), pa.array(d[root[hit]]), pa.array(links[hit])], ["d", "root", "links"])

        for batch in batches:
            cluster, low, high, own, d = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cluster", "low", "high", "own", "d"))
            lists = batch.column("grams")
            at = np.concatenate(([0], np.cumsum(np.asarray(lists.value_lengths()))))
            flat = np.asarray(lists.flatten())
            for i in range(batch.num_rows):
                if (cluster[i], low[i], high[i]) != key:
                    yield from flush()
                    key, held = (cluster[i], low[i], high[i]), []
                held.append((d[i], own[i] == low[i], flat[at[i] : at[i + 1]]))
        yield from flush()

    return blocks.mapInArrow(run, "d long, root long, links long")


def prefixes(grams: DataFrame, percent: int) -> DataFrame:
    """(h, d): each set's rarest n-grams that others have, as many as a link can't do without.

    In one order for all, by the number of sets and then the hash, two sets that link
    share one of the first slack + 1 n-grams of both.  N-grams of one set alone come
    first and take up the slack, so chance neighbours rarely meet.
    """
    rows = grams.select("d", "n", F.explode("grams").alias("h"))
    counts = persisted(rows.groupBy("h").agg(F.count("*").alias("c")).where("c > 1"))
    shared = rows.join(counts, "h").groupBy("d", "n").agg(F.array_sort(F.collect_list(F.struct("c", "h"))).alias("g"))  # a document's own
    room = slack(F.col("n"), percent) + 1 - (F.col("n") - F.size("g"))
    return shared.where(room > 0).select("d", F.explode(F.slice("g", F.lit(1), room.cast("int"))).alias("g")).select("g.h", "d")


def band(n: Column, percent: int) -> Column:
    """Bands of set sizes: two sets that link are in one band or in neighbouring ones."""
    width = max(math.log(100 / percent) * (1 + 1e-9), 1e-6)  # a little wider than the ratio that links allow, for rounding's sake
    return F.floor(F.log(n.cast("double")) / width)


def block_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(cluster, low, high, own, d, grams): every row once for each block pair that its own block is part of.

    ``rows``: d, n, grams, cluster, whether the cluster is whole, and its number of blocks
    in each band.  A cluster of up to ``BLOCK`` rows and ``BLOCK_GRAMS`` n-grams is one
    block.  A larger one is cut into blocks within bands, and blocks meet only where their
    sizes allow a link.  A row's place in its band comes from its id and its set, so rows
    that share an id spread out.
    """
    whole = F.col("whole")
    out = rows.withColumn("band", F.when(whole, 0).otherwise(band(F.col("n"), percent))).withColumn("blocks", F.when(whole, F.create_map(F.lit(0).cast("long"), F.lit(1).cast("long"))).otherwise(F.col("blocks")))
    out = out.withColumn("own", F.col("band") * SPAN + F.pmod(F.xxhash64("d", F.col("grams")[0]), F.col("blocks")[F.col("band")]))
    near = "filter(array(band - 1, band, band + 1), b -> map_contains_key(blocks, b))"
    out = out.withColumn("other", F.explode(F.expr(f"flatten(transform({near}, b -> transform(sequence(0L, blocks[b] - 1), i -> b * {SPAN} + i)))")))
    return out.select("cluster", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "d", "grams")


def linked_classes(rows: DataFrame, each: DataFrame, size: int, percent: int, key: int) -> DataFrame:
    """(k1, k2, n, d, n_links, component): each class of equal sets, its smallest id, its links and the smallest id it reaches.

    ``rows``: d (all different) and text; ``each``: their :func:`digests`.
    """
    classes = persisted(each.where("n > 0").groupBy(*CLASS).agg(F.min("d").alias("d"), F.first("short").alias("short")))
    # A text shorter than an n-gram links with equal ones only, and so does a set of one if more than half must be shared.
    least = 2 if percent > 50 else 1
    open_ = classes.where(~F.col("short") & (F.col("n") >= least)).select("d").distinct()
    own = alone(sampled(rows, size, SAMPLE, key))
    ruled_out = own.join(each.select("d", "n"), "d").where(F.col("own") > slack(F.col("n"), percent)).select("d")
    left = persisted(open_.join(ruled_out, "d", "left_anti"))

    grams = persisted(sets(rows.join(left, "d"), size, key).where(F.col("n") >= least))
    own = alone(grams.select("d", F.explode("grams").alias("h")))
    ruled_out = own.join(grams.select("d", "n"), "d").where(F.col("own") > slack(F.col("n"), percent)).select("d")
    grams = persisted(grams.join(ruled_out, "d", "left_anti"))

    posts = persisted(prefixes(grams, percent))
    hubs = persisted(posts.groupBy("h").agg(F.min("d").alias("hub"), F.max("d").alias("last")).where("hub < last").select("h", "hub"))
    cluster = components(posts.join(hubs, "h").where("d <> hub"), "d", "hub")
    cluster = persisted(cluster.unionByName(cluster.select(F.col("component").alias("node"), "component").distinct()))

    member = cluster.select(F.col("node").alias("d"), F.col("component").alias("cluster"))
    banded = grams.select("d", "n", band(F.col("n"), percent).alias("band")).join(member, "d").groupBy("cluster", "band").agg(F.count("*").alias("rows"), F.sum("n").alias("grams"))
    parted = F.greatest(F.ceil(F.col("rows") / BLOCK), F.ceil(F.col("grams") / BLOCK_GRAMS))
    blocks = persisted(
        banded.groupBy("cluster").agg(
            ((F.sum("rows") <= BLOCK) & (F.sum("grams") <= BLOCK_GRAMS)).alias("whole"), F.map_from_entries(F.collect_list(F.struct("band", parted))).alias("blocks")
        )
    )
    paired = block_pairs(grams.join(member.join(blocks, "cluster"), "d"), percent)
    pair = ["cluster", "low", "high"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stars = persisted(products(paired.repartition(parts, *pair).sortWithinPartitions(*pair), percent))
    links = stars.groupBy("d").agg(F.sum("links").alias("n_links"))
    reached = components(stars, "d", "root").select(F.col("node").alias("d"), "component")
    return persisted(classes.join(links, "d", "left").join(reached, "d", "left").select("k1", "k2", "n", "d", "n_links", F.coalesce("component", "d").alias("component")))


def joined_ids(each: DataFrame, known: DataFrame) -> DataFrame:
    """``known`` with classes that are texts of one id in one component, and components named by their smallest id.

    ``each``: (d, k1, k2, n) of every row; in ``known`` d and component number the classes.  An id of several
    classes is a star of edges between them, so no id's rows meet in one task.
    """
    held = persisted(each.where("n > 0").select(F.col("d").alias("id"), *CLASS).distinct().join(known.select(*CLASS, F.col("d").alias("c"), "component"), CLASS))
    hubs = persisted(held.groupBy("id").agg(F.min("c").alias("hub"), F.max("c").alias("last")).where("hub < last").select("id", "hub"))
    edges = held.join(hubs, "id").select("c", "hub").unionByName(known.select(F.col("d").alias("c"), F.col("component").alias("hub"))).where("c <> hub")
    reached = persisted(components(edges, "c", "hub").withColumnRenamed("node", "c").withColumnRenamed("component", "root"))
    rooted_ = persisted(held.join(reached, "c", "left").select("id", F.coalesce("root", "c").alias("root")))
    least = persisted(rooted_.groupBy("root").agg(F.min("id").alias("least")))
    named = known.select(*CLASS, F.col("d").alias("c"), "n_links").join(reached, "c", "left").withColumn("root", F.coalesce("root", "c"))
    return persisted(named.join(least, "root").select(*CLASS, "n_links", F.col("least").alias("component")))


def ngram_join(docs: DataFrame, size: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """Every document with its set size, its number of links and its component.

    Words are maximal runs of bytes other than space and U+0009-000D, A-Z lower-cased;
    a set holds the distinct runs of ``size`` words (the whole sequence, if shorter).
    Two sets link when 100 * intersection >= ``percent`` * union.  No link is lost:

    1. Equal sets are one class; its smallest id stands for it from here on.
    2. A bound on a hash sample of n-grams, then one on all: a document of which more
       n-grams are its own than a link may miss links with nothing.
    3. Documents that share one of their rarest n-grams are clustered.
    4. Each cluster's incidence matrix is multiplied with its transpose, in row blocks
       of about ``BLOCK`` documents of similar size and column blocks of n-grams,
       discarding block pairs and pairs that their sizes rule out.  Only a spanning star
       of the links leaves a block.
    5. Links and classes give the components.

    N-grams are compared by 64 bits of a keyed hash whose key is drawn for each run, whole
    sets by 128 bits; a set of one n-gram, or a text shorter than one, is only ever compared
    as a whole set where more than half must be shared.

    Nulls: a null text is an empty set, linked with nothing; a null doc_id counts as the
    lowest and comes out as null.  Rows that share an id are told apart by their sets and
    are in one component, but for those without a word.  Repeated rows are copies of a class.  Extra columns are ignored.  An empty table
    gives an empty result.

    Returns doc_id long, n_shingles long, n_links long (other sets it links with),
    component_id long (smallest id reached, its own included).
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("d"), "text")
    key = new_key()
    each = persisted(digests(rows, size, key))
    if each.groupBy("d").count().where("count > 1").head(1):
        # Ids that repeat don't tell rows apart, so one text of each class goes on, under a number of its own.
        texts = digests(rows, size, key, with_text=True).where("n > 0").dropDuplicates(CLASS)
        single = persisted(texts.select(F.monotonically_increasing_id().alias("d"), *CLASS, "short", "text"))
        known = joined_ids(each, linked_classes(single.select("d", "text"), single.drop("text"), size, percent, key))
    else:
        known = linked_classes(rows, each, size, percent, key).drop("d")
    out = each.join(known, CLASS, "left")

    def shown(c: Column) -> Column:
        return F.when(c != LOWEST, c)

    return out.select(
        shown(F.col("d")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        shown(F.coalesce("component", "d")).alias("component_id"),
    )
