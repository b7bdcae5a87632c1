"""Line breaks of a transcript carried over to its original text."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import breaks, tidy_breaks
from ..sinks.written import written

_WORDS = re.compile(r"\s|\S+")
COST = 256  #: edits that a search for the middle of two spans follows from each end before it settles for the farthest point
PIECE_WORDS = 4000  #: words and blanks of a long pair that one row of work takes, where the texts can be parted there
RUN = 12  #: words and blanks in a row that part a long pair where they occur once in each text
SCRIPT = T.ArrayType(T.StructType([T.StructField("op", T.IntegerType()), T.StructField("text", T.StringType())]))
PIECES = T.ArrayType(T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())]))
Edit = tuple[int, str]


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of pairs, which ascend in the first number, that ascends in the second, too."""
    ends: list[int] = []
    last: list[int] = []
    before = [-1] * len(pairs)
    for i, (_, y) in enumerate(pairs):
        k = bisect_left(ends, y)
        before[i] = last[k - 1] if k else -1
        ends[k : k + 1], last[k : k + 1] = [y], [i]
    out, i = [], last[-1] if last else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def _middle(a: list[str] | str, b: list[str] | str, span: tuple[int, int, int, int], cost: int) -> tuple[int, int]:
    """A point inside the span that a shortest way through it passes, found from both ends at once.

    The span differs at both of its ends.  Beyond ``cost`` edits from an end it is the point
    farthest along, which is on a short way, if not the shortest.  Memory is a number for each edit.
    """
    i, j, k, m = span
    n, p = j - i, m - k
    there, back = {0: 0}, {0: 0}  # how far along a each diagonal is reached, from the start and from the end
    for d in range(cost + 1):
        for ahead, mine, other in ((True, there, back), (False, back, there)):
            for c in range(-d, d + 1, 2) if d else (0,):
                if not -p <= c <= n:
                    continue
                right, down = mine.get(c - 1, -2) + 1, mine.get(c + 1, -1)
                x = max(right if right <= n else -1, down if down - c <= p else -1) if d else 0
                if x < 0:
                    continue
                y = x - c
                if ahead:
                    while x < n and y < p and a[i + x] == b[k + y]:
                        x, y = x + 1, y + 1
                else:
                    while x < n and y < p and a[j - 1 - x] == b[m - 1 - y]:
                        x, y = x + 1, y + 1
                mine[c] = x
                met = other.get(n - p - c)
                if d and met is not None and x + met >= n:
                    return (i + x, k + y) if ahead else (j - x, m - y)
    x, y = max(((x, x - c) for c, x in there.items()), key=sum)
    return i + x, k + y


def _myers(a: list[str] | str, b: list[str] | str, i: int, j: int, k: int, m: int, cost: int = COST) -> list[tuple[int, int, int, int]]:
    """Ranges of a[i:j] and b[k:m] that differ, by halves around middle points: memory grows with the cost alone, time with length times cost."""
    out: list[tuple[int, int, int, int]] = []
    todo = [(i, j, k, m)]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
        if i < j and k < m:
            x, y = _middle(a, b, (i, j, k, m), cost)
            todo += [(x, j, y, m), (i, x, k, y)]
        elif i < j or k < m:
            if out and out[-1][1] == i and out[-1][3] == k:
                i, k = out[-1][0], out[-1][2]
                out.pop()
            out.append((i, j, k, m))
    return out


def _hunks(a: list[str] | str, b: list[str] | str) -> list[tuple[int, int, int, int]]:
    """Ranges of a and b that differ, between ranges that are equal.

    Both are parted at what occurs once in each, in a common order; only what lies between
    two such anchors, and holds none, is compared item by item.
    """
    out: list[tuple[int, int, int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
        if i == j or k == m:
            if i < j or k < m:
                out.append((i, j, k, m))
            continue
        here, there = Counter(a[i:j]), Counter(b[k:m])
        place = {x: n for n, x in enumerate(b[k:m], k) if there[x] == 1}
        anchors = _rising([(n, place[x]) for n, x in enumerate(a[i:j], i) if here[x] == 1 and x in place])
        if anchors:
            edges = [(i - 1, k - 1), *anchors, (j, m)]
            todo += [(x + 1, u, y + 1, v) for (x, y), (u, v) in zip(edges, edges[1:])]
        else:
            out += _myers(a, b, i, j, k, m)
    return sorted(out)


def _edits(a: list[str] | str, b: list[str] | str) -> list[tuple[str, list | str, list | str]]:
    """(kind, part of a, part of b) in order; the kinds are equal and replace."""
    out, i, k = [], 0, 0
    for p, q, r, s in [*_hunks(a, b), (len(a), len(a), len(b), len(b))]:
        if i < p:
            out.append(("equal", a[i:p], b[k:r]))
        if p < q or r < s:
            out.append(("replace", a[p:q], b[r:s]))
        i, k = q, s
    return out


def coarse(script: list[Edit]) -> list[Edit]:
    """The script without equal pieces that are no longer than the edits on both sides of them: those are coincidence.

    Such a piece becomes deleted and inserted text.  Each run of edits comes out as what is
    deleted, then what is inserted.
    """
    runs: list[list[str]] = [["", "", ""]]  # deleted, inserted, the equal text after them
    for op, text in script:
        if op == 0:
            runs[-1][2] += text
        else:
            if runs[-1][2]:
                runs.append(["", "", ""])
            runs[-1][0 if op < 0 else 1] += text
    done: list[list[str]] = []
    for run in runs:
        done.append(run)
        while len(done) > 1 and done[-2][2] and (done[-2][0] or done[-2][1]):
            (gone, new, kept), (gone2, new2, rest) = done[-2:]
            if len(kept) > min(max(len(gone), len(new)), max(len(gone2), len(new2))):
                break
            done[-2:] = [[gone + kept + gone2, new + kept + new2, rest]]
    return [(op, text) for gone, new, kept in done for op, text in ((-1, gone), (1, new), (0, kept)) if text]


def _script(a: str, b: str) -> list[Edit]:
    """Words first, then characters where words differ, so that long texts stay cheap."""
    out: list[Edit] = []
    for kind, x, y in _edits(_WORDS.findall(a), _WORDS.findall(b)):
        u, v = "".join(x), "".join(y)
        if kind == "equal":
            out.append((0, u))
            continue
        for inner, p, q in _edits(u, v):
            out += [(0, p)] if inner == "equal" else [(op, t) for op, t in ((-1, p), (1, q)) if t]
    return out


def _rows(script: list[Edit]) -> list[dict]:
    return [{"op": o, "text": t} for o, t in script]


@F.pandas_udf(SCRIPT)
def edit_script(original: pd.Series, transcribed: pd.Series) -> pd.Series:
    """Character edits that turn the original into the transcript: 0 equal, -1 only in the original, 1 only in the transcript."""
    return pd.Series([None if a is None or b is None else _rows(coarse(_script(a, b))) for a, b in zip(original, transcribed, strict=True)])


@F.pandas_udf(SCRIPT)
def piece_script(original: pd.Series, transcribed: pd.Series) -> pd.Series:
    """The edits of a piece, coincidences included: a coincidence may end in the next piece."""
    return pd.Series([_rows(_script(a, b)) for a, b in zip(original, transcribed, strict=True)])


@F.pandas_udf(SCRIPT)
def whole_script(pieces: pd.Series) -> pd.Series:
    """The edits of a pair from those of all its pieces in order."""
    return pd.Series([_rows(coarse([(e["op"], e["text"]) for e in script])) for script in pieces])


def parted(a: str, b: str, words: int = PIECE_WORDS) -> list[tuple[str, str]]:
    """Both texts in as many pieces, cut at runs of words that occur once in each, in a common order, at least ``words`` apart.

    Texts without such runs stay one piece.
    """
    x, y = _WORDS.findall(a), _WORDS.findall(b)
    if len(x) <= words and len(y) <= words:
        return [(a, b)]
    here, there = ([hash(tuple(t[n : n + RUN])) for n in range(len(t) - RUN + 1)] for t in (x, y))
    once, seen = Counter(here), Counter(there)
    place = {h: n for n, h in enumerate(there) if seen[h] == 1}
    cuts = [(0, 0)]
    for u, v in _rising([(n, place[h]) for n, h in enumerate(here) if once[h] == 1 and h in place]):
        if min(u - cuts[-1][0], v - cuts[-1][1]) >= words:
            cuts.append((u, v))
    cuts.append((len(x), len(y)))
    return [("".join(x[p:q]), "".join(y[r:s])) for (p, r), (q, s) in zip(cuts, cuts[1:])]


def pieces_of(original: Column, transcribed: Column, words: int) -> Column:
    """The pieces of both texts, as an array."""

    @F.pandas_udf(PIECES)
    def run(original: pd.Series, transcribed: pd.Series) -> pd.Series:
        return pd.Series([[{"a": u, "b": v} for u, v in parted(a, b, words)] for a, b in zip(original, transcribed, strict=True)])

    return run(original, transcribed)


def spread_scripts(pairs: DataFrame, words: int = PIECE_WORDS) -> DataFrame:
    """(key, script) of pairs (key, original, transcribed), a row each, long ones compared in pieces by several tasks.

    Pairs with a null are left out.  The pieces of one pair meet again in one row, as its texts did.
    """
    whole = pairs.where("original is not null and transcribed is not null")
    rows = whole.select("key", F.posexplode(pieces_of(F.col("original"), F.col("transcribed"), words)).alias("at", "piece")).repartition("key", "at")
    done = rows.select("key", "at", piece_script("piece.a", "piece.b").alias("script"))
    order = F.array_sort(F.collect_list(F.struct("at", "script")))  # a pair's own
    joined = done.groupBy("key").agg(F.flatten(F.transform(order, lambda x: x["script"])).alias("script"))
    return joined.select("key", whole_script("script").alias("script"))


def transferred(script: Column, mark: bool = False) -> Column:
    """The original's text with the transcript's line breaks, from an edit script, as one native fold.

    Kept are equal and deleted pieces.  Of an inserted piece only its break counts: one
    at its end goes behind what there is (followed by `&` with ``mark``, unless the line
    may break there anyway); one at its start goes behind an equal piece or before a
    deleted one.  The state is the pieces so far and the last edit.
    """
    empty = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("op"), F.lit("").alias("text"))

    def step(state: Column, edit: Column) -> Column:
        out, text = state["out"], edit["text"]
        ending = F.lit("\n") if not mark else F.when(breaks(state["text"]), "\n").otherwise("\n&")
        before_last = F.concat(F.slice(out, F.lit(1), F.greatest(F.size(out) - 1, F.lit(0))), F.array(F.lit("\n")), F.slice(out, F.greatest(F.size(out), F.lit(1)), F.lit(1)))
        inserted = (
            F.when(text.endswith("\n"), F.concat(out, F.array(ending)))
            .when(text.startswith("\n") & (state["op"] == -1), before_last)
            .when(text.startswith("\n"), F.concat(out, F.array(F.lit("\n"))))
            .otherwise(out)
        )
        return F.struct(F.when(edit["op"] == 1, inserted).otherwise(F.concat(out, F.array(text))).alias("out"), edit["op"].alias("op"), text.alias("text"))

    return F.aggregate(script, empty, step, lambda s: F.array_join(s["out"], ""))


def carry_breaks(pairs: DataFrame, mark: bool = False, spread: bool = False, words: int = PIECE_WORDS) -> DataFrame:
    """``pairs`` (original, transcribed, ...) with ``text``: the original, its own breaks turned to blanks, broken as the transcript is.

    ``spread`` is for books: long pairs are cut where both texts agree, at least ``words`` words
    and blanks apart, and the pieces compared by several tasks.  Equal pairs are then compared once; of several
    shortest edits, pieces may show another than the whole does.  A null on either side gives a null text.
    """
    flat, back = F.translate(F.regexp_replace("original", "\r\n?", "\n"), "\n", " "), F.regexp_replace("transcribed", "\r\n?", "\n")
    if not spread:
        scripted = pairs.withColumn("_script", edit_script(flat, back))
        return scripted.withColumn("text", tidy_breaks(transferred(F.col("_script"), mark))).drop("_script")
    key = F.sha2(F.concat(F.length(flat).cast("string"), F.lit("/"), flat, back), 256)
    keyed = pairs.withColumn("_key", key)
    once = keyed.select(F.col("_key").alias("key"), flat.alias("original"), back.alias("transcribed")).dropDuplicates(["key"])
    # Written, so that Spark knows the size of the texts and may split the rows of a pair that many share; rows with a null need none.
    texts = written(spread_scripts(once, words).select(F.col("key").alias("_key"), tidy_breaks(transferred(F.col("script"), mark)).alias("text")))
    keyed = keyed.drop("text")
    without = keyed.where("_key is null").withColumn("text", F.lit(None).cast("string"))
    return keyed.where("_key is not null").join(texts, "_key").unionByName(without).drop("_key")
