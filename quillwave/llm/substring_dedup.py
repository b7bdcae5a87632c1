"""Removal of word passages that appeared before: winnowed anchors as seeds, extended to maximal repeats."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .bytetext import Words, new_key, text_bytes, words
from .shared import LOWEST, persisted, quoted, text_key, without

WINDOW = 20  #: words of the shortest repeat that is removed
GRAM = 4  #: words of an anchor
DOCUMENT = ["d", "t", "u"]  #: what tells a document: its id and, where ids repeat, a digest of its text
SEEDS = "h long, span long, d long, t long, u long, first int, n int"


def anchors(w: Words, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Seeds of some texts: word, anchor hash, hash of all words of its windows, first window and their number.

    Of the grams in every window of ``window`` words the one with the smallest hash (the
    last of equals) is its anchor, so equal windows have equal anchors at equal places.
    Windows next to each other mostly share one.  Words are numbered in the whole of ``w``.
    """
    pos, h = w.runs(gram)
    width = window - gram + 1
    n = len(pos) - width + 1
    if n <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    best = np.arange(len(pos))
    have = 1
    while have < width:  # the smallest of `have` grams from each on, doubled
        step = min(have, width - have)
        a, b = best[: len(best) - step], best[step:]
        best = np.where(h[b] <= h[a], b, a)
        have += step
    ok = np.flatnonzero(w.doc[pos[:n]] == w.doc[pos[width - 1 :]])
    chosen = best[ok]
    if not len(ok):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    head = np.flatnonzero(np.concatenate(([True], (chosen[1:] != chosen[:-1]))))
    first, last = pos[ok[head]], pos[ok[np.append(head[1:], len(ok)) - 1]]
    return pos[chosen[head]], h[chosen[head]], w.spans(first, last + window), first, last - first + 1


def keyed(docs: DataFrame) -> tuple[DataFrame, bool]:
    """``docs`` as d long (the id, nulls lowest), t and u long (see ``text_key``), text and a struct of the other columns; whether ids repeat."""
    t, u, repeated = text_key(docs)
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("d"),
        t.alias("t"),
        u.alias("u"),
        F.col("text"),
        F.struct(*[quoted(c).alias(c) for c in docs.columns if c != "text"]).alias("rest"),
    )
    return rows, repeated


def seeds(rows: DataFrame, window: int, gram: int, key: int) -> DataFrame:
    """Every anchor of every text."""

    def run(batches):
        for batch in batches:
            ids = [batch.column(c).to_numpy(zero_copy_only=False) for c in DOCUMENT]
            for w in words(*text_bytes(batch.column("text")), key):
                _, h, span, first, n = anchors(w, window, gram)
                doc = w.doc[first]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h.view(np.int64)),
                        pa.array(span.view(np.int64)),
                        *(pa.array(x[w.first + doc]) for x in ids),
                        pa.array((first - w.at[doc]).astype(np.int32)),
                        pa.array(n.astype(np.int32)),
                    ],
                    ["h", "span", *DOCUMENT, "first", "n"],
                )

    return rows.select(*DOCUMENT, "text").mapInArrow(run, SEEDS)


def windows(texts: DataFrame, window: int, key: int) -> DataFrame:
    """(h, w, d, t, u, s): hash w of every window that the listed seeds of a text stand for."""

    def run(batches):
        for batch in batches:
            ids = [batch.column(c).to_numpy(zero_copy_only=False) for c in DOCUMENT]
            listed = batch.column("seeds")
            at = np.concatenate(([0], np.cumsum(np.asarray(listed.value_lengths()))))
            flat = listed.flatten()
            h, first, n = (np.asarray(flat.field(c)) for c in ("h", "first", "n"))
            for w in words(*text_bytes(batch.column("text")), key):
                docs = len(w.at) - 1
                own = slice(at[w.first], at[w.first + docs])
                doc = np.repeat(np.arange(docs), np.diff(at[w.first : w.first + docs + 1]))
                size = n[own].astype(np.int64)
                doc, begin, anchor = (np.repeat(x, size) for x in (doc, first[own].astype(np.int64), h[own]))
                s = begin + np.arange(len(begin)) - np.repeat(np.cumsum(size) - size, size)
                a = s + w.at[doc]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor),
                        pa.array(w.spans(a, a + window).view(np.int64)),
                        *(pa.array(x[w.first + doc]) for x in ids),
                        pa.array(s.astype(np.int32)),
                    ],
                    ["h", "w", *DOCUMENT, "s"],
                )

    return texts.select(*DOCUMENT, "text", "seeds").mapInArrow(run, "h long, w long, d long, t long, u long, s int")


def cut(texts: DataFrame, one_space: bool) -> DataFrame:
    """(rest, text, n_words, n_removed) with the words in ``cuts`` taken out of each text."""

    def run(batches):
        for batch in batches:
            listed = batch.column("cuts")
            at = np.concatenate(([0], np.cumsum(np.asarray(listed.value_lengths().fill_null(0)))))
            flat = listed.flatten()
            first, end = (np.asarray(flat.field(c)).astype(np.int64) for c in ("a", "e"))
            null = np.asarray(batch.column("text").is_null())
            out, total, removed = [], [], []
            for w in words(*text_bytes(batch.column("text")), key=0):  # for their bounds alone
                docs = len(w.at) - 1
                own = slice(at[w.first], at[w.first + docs])
                doc = np.repeat(np.arange(docs), np.diff(at[w.first : w.first + docs + 1]))
                depth = np.zeros(len(w.hash) + 1, np.int64)
                np.add.at(depth, w.at[doc] + first[own], 1)
                np.add.at(depth, w.at[doc] + end[own], -1)
                gone = np.cumsum(depth)[:-1] > 0
                stay = np.ones(len(w.data), bool)
                edges = w.cut  # where the texts begin and end in w.data
                if one_space:
                    data = w.data.copy()
                    kept = np.flatnonzero(~gone)
                    mark = np.zeros(len(w.data) + 1, np.int8)
                    mark[w.start[kept]] += 1
                    mark[w.end[kept]] -= 1
                    stay = np.cumsum(mark)[:-1] > 0
                    between = w.end[kept[:-1]][w.doc[kept[:-1]] == w.doc[kept[1:]]]  # a blank follows each word but the last
                    stay[between] = True
                    data[between] = 0x20
                else:
                    data = w.data
                    lost = np.flatnonzero(gone)
                    stop = np.append(w.start[1:], len(w.data))
                    last = np.flatnonzero(np.append(w.doc[1:] != w.doc[:-1], True)) if len(w.doc) else np.zeros(0, np.int64)
                    stop[last] = edges[w.doc[last] + 1]
                    mark = np.zeros(len(w.data) + 1, np.int64)
                    np.add.at(mark, w.start[lost], 1)
                    np.add.at(mark, stop[lost], -1)
                    stay = np.cumsum(mark)[:-1] == 0
                size = np.concatenate(([0], np.cumsum(stay)))
                offsets = size[edges].astype(np.int64)
                buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[stay].tobytes())]
                out.append(pa.Array.from_buffers(pa.large_string(), docs, buffers))
                total.append(np.diff(w.at))
                removed.append(np.bincount(w.doc[gone], minlength=docs))
            text = pa.concat_arrays(out) if out else pa.array([], pa.large_string())
            text = pa.compute.if_else(pa.array(null), pa.scalar(None, pa.large_string()), text).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("rest"), text, *(pa.array(np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64)) for x in (total, removed))],
                ["rest", "text", "n_words", "n_removed"],
            )

    kept = StructType([texts.schema["rest"], texts.schema["text"], StructField("n_words", LongType()), StructField("n_removed", LongType())])
    return texts.select("rest", "text", "cuts").mapInArrow(run, kept)


def repeats(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """(d, t, u, cuts): for each document with repeats, the ranges [a, e) of words to take out; ``rows`` holds each document once.

    1. Seeds of all texts; those whose anchor occurs more than once go on.
    2. Seeds alike in anchor and in all words around it are extended to the full span
       at once: the first stays, every later one is a repeat.
    3. Where one anchor stands in different spans, the first seed of each span is
       extended both ways window by window, and windows that came before are repeats.

    Ranges that overlap or touch are one maximal repeat when they are cut.  Groups are
    only ever aggregated (count, first) and joined back from written tables, so a
    passage in most documents is a skewed join that adaptive execution splits, never a
    group of pairs.
    """
    key, place = new_key(), "struct(d, t, u, first)"
    found = seeds(rows, window, gram, key)
    shared = persisted(found.groupBy("h").count().where("count > 1").select("h"))
    seen = persisted(found.join(shared, "h"))
    spans = persisted(seen.groupBy("h", "span").agg(F.min(F.expr(place)).alias("m"), F.first("n").alias("n"), F.count("*").alias("c")))
    again = seen.join(spans.where("c > 1").select("h", "span", "m"), ["h", "span"]).where(f"{place} > m")
    again = again.select(*DOCUMENT, F.col("first").alias("a"), (F.col("first") + F.col("n") + (window - 1)).alias("e"))

    several = persisted(spans.groupBy("h").count().where("count > 1").select("h"))
    open_seeds = spans.join(several, "h").select(*[f"m.{c}" for c in DOCUMENT], F.struct("h", "m.first", "n").alias("seed"))
    listed = persisted(open_seeds.groupBy(*DOCUMENT).agg(F.collect_list("seed").alias("seeds")))  # a document's own
    near = rows.select(*DOCUMENT, "text").join(listed, DOCUMENT)
    opened, place = persisted(windows(near, window, key)), "struct(d, t, u, s)"
    before = persisted(opened.groupBy("h", "w").agg(F.min(F.expr(place)).alias("m"), F.max(F.expr(place)).alias("x")).where("m < x").select("h", "w", "m"))
    more = opened.join(before, ["h", "w"]).where(f"{place} > m").select(*DOCUMENT, F.col("s").alias("a"), (F.col("s") + window).alias("e"))
    return again.unionByName(more).groupBy(*DOCUMENT).agg(F.collect_list(F.struct("a", "e")).alias("cuts"))


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, one_space: bool = False) -> DataFrame:
    """``docs`` without the words of every ``window``-word run that also starts earlier.

    Words are maximal runs of bytes other than space and U+0009-000D.  Earlier means in
    a smaller doc_id, or in the same document at an earlier word; all runs are judged on
    the input.  The text keeps its separators (a removed word takes the blanks after it
    along) or, with ``one_space``, is the kept words joined by one space.  n_words long
    and n_removed long are added; columns of those names are replaced.

    Nulls: a null text stays null and has no words; a null doc_id comes before all
    others.  Rows with the same id are ordered by a digest of their text; repeated rows
    (same id and text) are one document, so neither removes the other's words.  Empty
    texts and texts under ``window`` words are kept.  An empty table gives an empty one.

    Windows are compared by 128 bits of keyed hashes (the anchor's and all words'), with a
    key drawn for each run.
    """
    docs = without(docs, ("n_words", "n_removed"))
    rows, repeated = keyed(docs)
    single = rows.select(*DOCUMENT, "text")
    # Rows can only be alike where ids repeat; each document's seeds are taken once, and its cuts hold for all of its rows.
    single = persisted(single.dropDuplicates(DOCUMENT)) if repeated else single
    marked = rows.join(repeats(single, window, gram), DOCUMENT, "left")
    out = cut(marked, one_space)
    order = [F.col("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns]
    return out.select(*order, "n_words", "n_removed")
