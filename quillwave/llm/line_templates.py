"""Removal of boilerplate lines by a fixed-depth tree of line templates, in DataFrame functions only."""

from __future__ import annotations

import secrets
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import LOWEST, persisted, quoted, text_key, without

DEPTH = 3  #: leading tokens that lead to a leaf, after the token count
MIN_DOCS = 10  #: documents in which a template recurs
FIXED_SHARE = 0.75  #: share of a template's tokens that aren't variable
COPY_PERCENT = 30  #: characters in 100 without which two texts may still be near copies at 80 % of their n-grams
NGRAM, OWN_PERCENT = 5, 20  #: words of an n-gram, and how many in 100 only a page with text of its own has to itself
FIELD = "<*>"
LEAF = ["n", "lead"]
DOCUMENT = ["d", "t", "u"]  #: what tells a document: its id and, where ids repeat, a digest of its text
LINE = ["l1", "l2"]  #: 128 bits of a line


def masked(token: Column) -> Column:
    """A token with a digit is a variable field at once."""
    return F.when(token.rlike("[0-9]"), F.lit(FIELD)).otherwise(token)


def line_key(line: Column | str, key: int) -> list[Column]:
    """Two hashes of a line, seeded by a key that is drawn for each run, so that no line can be made to collide."""
    return [F.xxhash64(F.lit(key), line), F.xxhash64(F.lit(~key), line)]


def leaves(rows: DataFrame) -> DataFrame:
    """(d, t, u, line, n, lead): each distinct line of a document and its leaf, by token count and leading tokens.

    A line of fewer than ``DEPTH`` tokens has all of them as its leaf's name.  Blank lines
    are layout and have none.
    """
    lines = rows.select(*DOCUMENT, F.explode(F.array_distinct(F.split("text", "\n"))).alias("line")).where(F.trim("line") != "")
    tokens = F.split("line", " ")
    return lines.withColumn("n", F.size(tokens)).withColumn("lead", F.array_join(F.transform(F.slice(tokens, 1, DEPTH), masked), " "))


def recurring_lines(rows: DataFrame, min_docs: int, fixed_share: float, key: int) -> DataFrame:
    """(d, t, u, gone): for each document, the keys of its lines whose template recurs in ``min_docs`` documents or more.

    ``rows`` holds each document once.

    1. Leaves with fewer lines than ``min_docs`` are done with.
    2. In a leaf, a token is fixed at its place if ``min_docs`` lines have it there, and a
       variable field otherwise; that gives each distinct line its template.  The same is
       done at 2, 4, 8, ... times that support, so a field whose values are frequent
       themselves is still a field next to tokens that all of the boilerplate's lines have,
       whatever the number of lines.
    3. Templates with enough fixed tokens and enough documents are boilerplate.

    Leaves, tokens and templates are only counted and joined back from written tables, so
    a line that most documents share is a skewed join, which adaptive execution splits.
    """
    lines = leaves(rows)
    crowded = persisted(lines.groupBy(*LEAF).count().where(F.col("count") >= min_docs).select(*LEAF))
    held = persisted(lines.join(crowded, LEAF).select(*DOCUMENT, *LEAF, "line", *[c.alias(n) for c, n in zip(line_key("line", key), LINE, strict=True)]))

    distinct = held.groupBy(*LEAF, *LINE, "line").agg(F.count("*").alias("c"))
    tokens = persisted(distinct.select(*LEAF, *LINE, "c", F.posexplode(F.split("line", " ")).alias("pos", "token")).withColumn("token", masked(F.col("token"))))
    fixed = persisted(tokens.where(F.col("token") != FIELD).groupBy(*LEAF, "pos", "token").agg(F.sum("c").alias("s")).where(F.col("s") >= min_docs))
    fixed = fixed.select(*LEAF, "pos", "token", F.length(F.bin(F.floor(F.col("s") / min_docs))).alias("up"))  # the levels at which a token is fixed
    known = tokens.join(fixed, [*LEAF, "pos", "token"], "left").select(*LEAF, *LINE, F.struct("pos", "token", F.coalesce("up", F.lit(0)).alias("up")).alias("x"))
    template = known.groupBy(*LEAF, *LINE).agg(F.array_sort(F.collect_list("x")).alias("x"))  # a line's own tokens
    # Between the levels up to which its tokens are fixed a line's template is the same.
    template = template.withColumn("level", F.explode(F.array_distinct(F.filter(F.transform("x", lambda x: x["up"]), lambda up: up > 0))))
    template = template.where(F.size(F.filter("x", lambda x: x["up"] >= F.col("level"))) >= fixed_share * F.col("n"))
    shape = F.transform("x", lambda x: F.when(x["up"] >= F.col("level"), x["token"]).otherwise(FIELD))
    template = persisted(template.select(*LEAF, *LINE, F.struct(*line_key(shape, key)).alias("template")))

    used = persisted(held.select(*LEAF, *LINE, *DOCUMENT).join(template, [*LEAF, *LINE]))
    often = persisted(used.select(*LEAF, "template", *DOCUMENT).distinct().groupBy(*LEAF, "template").count().where(F.col("count") >= min_docs).drop("count"))
    gone = used.join(often, [*LEAF, "template"])
    return gone.groupBy(*DOCUMENT).agg(F.collect_set(F.struct(*LINE)).alias("gone"))  # a document's own lines


def with_own_text(rows: DataFrame, key: int) -> DataFrame:
    """(d, t, u): the documents of ``rows`` of whose word n-grams more are in no other of them than a copy may have.

    A document that links with another at 80 % of their n-grams can't have more than a
    fifth of its own to itself, so none of these is a near copy of another one.
    """
    words = F.filter(F.split(F.translate("text", ascii_uppercase, ascii_lowercase), r"[ \t-\r]+"), lambda w: w != "")
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - NGRAM + 1, F.lit(1))), lambda i: F.xxhash64(F.lit(key), F.slice("w", i, NGRAM))))
    each = rows.dropDuplicates(DOCUMENT).select(*DOCUMENT, words.alias("w")).where(F.size("w") > 0).select(*DOCUMENT, F.explode(grams).alias("h"))
    sizes = each.groupBy(*DOCUMENT).agg(F.count("*").alias("n"))
    single = each.groupBy("h").agg(*[F.min(c).alias(c) for c in DOCUMENT], F.count("*").alias("c")).where("c = 1")
    own = single.groupBy(*DOCUMENT).agg(F.count("*").alias("own"))
    return own.join(sizes, DOCUMENT).where(100 * F.col("own") > OWN_PERCENT * F.col("n")).select(*DOCUMENT)


def line_dedup(docs: DataFrame, min_docs: int = MIN_DOCS, fixed_share: float = FIXED_SHARE, spare_copies: bool = False) -> DataFrame:
    """``docs`` without the lines whose template recurs across documents; n_lines and n_dropped long are added.

    Lines end at line feeds and tokens at single spaces; a line of any length can be
    boilerplate, only blank ones can't.  It is dropped from every document.

    ``spare_copies`` is for a pipeline whose next stage keeps one of each group of copies:
    all lines of such copies recur, so dropping them would leave nothing to keep.  A
    document that would lose more than ``COPY_PERCENT`` of its characters is then compared
    with the others of that kind, and stays whole unless it is too different from all of
    them for a copy (``with_own_text``).

    Nulls: a null text stays null and has no lines; a null doc_id is an id like others.
    Repeated rows (same id and text) are one document.  A line repeated in one document
    counts once and is dropped each time.  Columns named n_lines or n_dropped are
    replaced, all others kept.  An empty table gives an empty one.
    """
    docs, key = without(docs, ("n_lines", "n_dropped")), secrets.randbits(63)
    rest = [c for c in docs.columns if c != "text"]
    t, u, repeated = text_key(docs)
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("d"), t.alias("t"), u.alias("u"), "text", F.struct(*[quoted(c).alias(c) for c in rest]).alias("rest")
    )
    single = rows.select(*DOCUMENT, "text")
    # Rows can only be alike where ids repeat; their lines must count once.
    single = single.dropDuplicates(DOCUMENT) if repeated else single
    marked = rows.join(recurring_lines(single, min_docs, fixed_share, key), DOCUMENT, "left")
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda x: ~F.array_contains("gone", F.struct(*[c.alias(n) for c, n in zip(line_key(x, key), LINE, strict=True)])))
    out = marked.withColumns({"lines": F.size(lines), "kept": F.when(F.col("gone").isNotNull(), kept)}).withColumn("short", F.array_join("kept", "\n"))
    changed = F.col("kept").isNotNull()
    if spare_copies:
        light = 100 * (F.length("text") - F.length("short")) <= COPY_PERCENT * F.length("text")
        heavy = persisted(out.where(changed & ~light).select(*DOCUMENT, "text"))
        pages = persisted(with_own_text(heavy, key).withColumn("page", F.lit(True)))
        out = out.join(pages, DOCUMENT, "left")
        changed = changed & (light | F.col("page").isNotNull())
    return out.select(
        *[F.when(changed, F.col("short")).otherwise(F.col("text")).alias("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns],
        F.when(F.col("text").isNull(), 0).otherwise(F.col("lines")).cast("long").alias("n_lines"),
        F.when(changed, F.col("lines") - F.size("kept")).otherwise(0).cast("long").alias("n_dropped"),
    )
