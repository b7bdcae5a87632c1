"""Packing tokenised documents into sequences: large items matched in pairs, the rest best fit."""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytetext import chunks, text_bytes
from .shared import persisted

END_OF_DOCUMENT = 1  #: id appended to every document
CHUNK = 5 << 22  #: bytes of text whose distinct words are tokenised together; a longer text is worked on in parts
TOGETHER = 500  #: words tokenised in one string
COMMON = 1 << 17  #: frequent words of its first chunk whose ids a worker keeps, at most
CELL_ROWS = 128  #: pieces of one length that are ranked together, on average
CELLS = 1 << 16  #: cells of one length, at most; beyond that they grow

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _parts(spec: dict | None, name: str) -> list[dict]:
    """The steps of a normalizer or pre-tokenizer, in order."""
    if not spec:
        return []
    return [x for one in spec[name] for x in _parts(one, name)] if spec["type"] == "Sequence" else [spec]


def drops_blanks(spec: dict) -> bool:
    """Whether a tokenizers file certainly gives a text the ids of its blank-separated words in a row.

    Its first splitting step must throw white space away, its normalizer must change
    characters without looking over a blank, and no added token may hold one.
    """
    local = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase", "StripAccents"}
    blanks = ({"Regex": r"\s+"}, {"String": " "})
    for step in _parts(spec.get("normalizer"), "normalizers"):
        if step["type"] not in local and not (step["type"] == "Replace" and step["pattern"] in blanks and step["content"] == " "):
            return False
    if any(c.isspace() for t in spec.get("added_tokens", []) for c in t["content"]):
        return False
    steps = _parts(spec.get("pre_tokenizer"), "pretokenizers")
    if not steps:
        return False
    first = steps[0]
    if first["type"] == "Split" and first["behavior"] == "Removed" and first["invert"] and "Regex" in first["pattern"]:
        # What isn't matched goes: no alternative may match white space.
        word = regex.compile(first["pattern"]["Regex"])
        return not any(c.isspace() for m in word.finditer("a \t b1 \n\r 2 . , \x0b\x0c !? 's 'll it's  'ré -- x\u3000y\xa0z") for c in m[0])
    return first["type"] in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer")


class WordIds:
    """Ids of texts, by the tokenizer's ids of their blank-separated words where :func:`drops_blanks`, else of whole texts.

    Where the vocabulary's kind drops ASCII white space, and no token, composition or
    special string spans it, a text's ids are its words' ids in a row.  Each distinct word of
    a chunk of texts is tokenised once; only the first chunk's frequent words are kept.
    """

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(vocabulary, encoding="utf-8") as f:
            self.by_words = drops_blanks(json.load(f))
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special}
        self.mark, self.mark_id = next(iter(special.items()), ("", -1))
        self.specials = tuple(special)
        self.common: dict[str, int] = {}
        self.flat, self.first, self.size = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def texts(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of every text, in order; a null text has none."""
        if not self.by_words:
            for text in column:
                yield np.array(self.tokenizer.encode(text.as_py() or "", add_special_tokens=False).ids, dtype="<u4")
            return
        raw, offsets = text_bytes(column)
        for a, b in chunks(offsets, CHUNK):
            data = raw[offsets[a] : offsets[b]]
            data = np.where((data >= 0x09) & (data <= 0x0D), np.uint8(0x20), data)
            if len(data) <= CHUNK:
                ids, at = self._ids(data, offsets[a : b + 1] - offsets[a])
                yield from (ids[x:y] for x, y in zip(at[:-1], at[1:], strict=True))
            else:  # one long text, cut at blanks
                blanks = np.flatnonzero(data == 0x20)
                cuts = blanks[np.searchsorted(blanks, np.arange(CHUNK // 2, len(data), CHUNK // 2)).clip(max=len(blanks) - 1)] if len(blanks) else blanks
                cuts = np.unique(np.concatenate(([0], cuts, [len(data)])))
                yield np.concatenate([self._ids(data[x:y], np.array([0, y - x]))[0] for x, y in zip(cuts[:-1], cuts[1:], strict=True)])

    def _ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin."""
        buffers = [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]
        lists = pc.split_pattern(pa.Array.from_buffers(pa.string(), len(offsets) - 1, buffers), " ")
        coded = lists.flatten().dictionary_encode()
        found, word = coded.dictionary.to_pylist(), np.asarray(coded.indices)
        known = np.array([self.common.get(w, -1) for w in found], np.int64)
        new = np.flatnonzero(known < 0)
        more, first_new, size_new = self._distinct([found[i] for i in new])
        flat = np.concatenate([self.flat, more])
        first, size = np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
        old = known >= 0
        first[old], size[old] = self.first[known[old]], self.size[known[old]]
        first[new], size[new] = first_new + len(self.flat), size_new
        if not self.common:
            self._keep(found, np.bincount(word, minlength=len(found)), flat, first, size)
        ends = np.concatenate(([0], np.cumsum(size[word])))
        source = np.repeat((first[word] - ends[:-1]).astype(np.int32), size[word])
        source += np.arange(len(source), dtype=np.int32)
        return flat[source], ends[np.asarray(lists.offsets)]

    def _keep(self, found: list[str], counts: np.ndarray, flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> None:
        """Keeps the ids of the most frequent words that came more than once."""
        often = np.argsort(-counts, kind="stable")[:COMMON]
        often = often[(counts[often] > 1) & (size[often] <= 16)]
        if len(often) < 1000:  # too few texts to tell
            return
        self.common = {found[i]: n for n, i in enumerate(often)}
        self.size = size[often]
        self.first = np.cumsum(self.size) - self.size
        self.flat = flat[np.repeat(first[often] - self.first, self.size) + np.arange(self.size.sum())]

    def _distinct(self, found: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words in a row, each word's first one and their number.

        Words are tokenised many in one string with a special string between them, whose
        id parts them again; where one may itself hold a special string, one by one.
        """
        alone = not self.mark or any(s in w for s in self.specials for w in found if "<" in w or s[0] != "<")
        step = 1 if alone else TOGETHER
        out, sizes = [], []
        for i in range(0, len(found), step):
            some = found[i : i + step]
            ids = np.array(self.tokenizer.encode_batch_fast([self.mark.join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            if alone:
                out.append(ids)
                sizes.append([len(ids)])
            else:
                ends = np.append(np.flatnonzero(ids == self.mark_id), len(ids))
                sizes.append(np.diff(ends, prepend=-1) - 1)
                out.append(ids[ids != self.mark_id])
        size = np.concatenate([*sizes, np.zeros(0, np.int64)]).astype(np.int64)
        return np.concatenate([*out, np.zeros(0, "<u4")]).astype("<u4"), np.cumsum(size) - size, size


_LOADED: dict[str, WordIds] = {}


def loaded(vocabulary: str) -> WordIds:
    """The vocabulary, read once by each worker."""
    if vocabulary not in _LOADED:
        _LOADED[vocabulary] = WordIds(vocabulary)
    return _LOADED[vocabulary]


def piece_rows(docs: DataFrame, vocabulary: str, capacity: int) -> DataFrame:
    """Every document's pieces of at most ``capacity`` ids, tokenised in its own scan task, without a shuffle."""

    def run(batches):
        words = loaded(vocabulary)
        end = np.array([END_OF_DOCUMENT], dtype="<u4")
        for batch in batches:
            columns: tuple[list, ...] = ([], [], [], [], [])
            for doc, ids in zip(batch.column("doc_id").to_pylist(), words.texts(batch.column("text")), strict=True):
                ids = np.concatenate([ids, end])
                for k, a in enumerate(range(0, len(ids), capacity)):
                    piece = ids[a : a + capacity]
                    for column, value in zip(columns, (doc, k, a, len(piece), zlib.crc32(piece.tobytes())), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces of each length go: (length, first rank, end rank, first sequence, pieces a sequence, offset).

    Pieces of one length are alike, so the plan works on counts of lengths: sequences
    that hold the same lengths form a run.  Lengths above a third of the capacity pair
    greedily, the longest first with the longest that still fits beside it, two at most
    in a sequence.  Smaller lengths, longest first, go to the tightest gap that holds
    them, again and again, and to new sequences when there is none.

    A run of gap g that takes pieces of length s keeps a gap below g / 2, and a length
    splits one run at most, so the plan has at most capacity x log2(capacity) rows or
    so, whatever the number of pieces.
    """
    left = {n: c for n, c in counts.items() if c}
    rank = dict.fromkeys(left, 0)
    out: list[tuple[int, int, int, int, int, int]] = []
    runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by gap: (first sequence, sequences)
    open_gaps, sequences = 0, 0

    def put(length: int, n: int, first: int, each: int, offset: int) -> None:
        out.append((length, rank[length], rank[length] + n, first, each, offset))
        rank[length] += n
        left[length] -= n

    def add(gap: int, first: int, n: int) -> None:
        nonlocal open_gaps
        if n and gap:
            runs[gap].append((first, n))
            open_gaps |= 1 << gap

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for a in large:
        while left[a]:
            partner = next((b for b in large if b <= a and a + b <= capacity and left[b] > (b == a)), None)
            n = left[a] if partner is None else left[a] // 2 if partner == a else min(left[a], left[partner])
            put(a, n, sequences, 1, 0)
            if partner is not None:
                put(partner, n, sequences, 1, a)
            add(capacity - a - (partner or 0), sequences, n)
            sequences += n

    for s in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[s]:
            wide = open_gaps >> s
            if wide:
                gap = s + (wide & -wide).bit_length() - 1
                first, n = runs[gap].pop()
                if not runs[gap]:
                    open_gaps &= ~(1 << gap)
            else:
                gap, first, n = capacity, sequences, -(-left[s] // (capacity // s))
                sequences += n
            each = gap // s
            take = min(left[s], n * each)
            full, rest = divmod(take, each)
            put(s, take, first, each, capacity - gap)
            add(gap - each * s, first, full)
            add(gap - rest * s, first + full, 1 if rest else 0)
            add(gap, first + full + (rest > 0), n - full - (rest > 0))
    return out


def pack(docs: DataFrame, vocabulary: str, capacity: int = 4096) -> DataFrame:
    """All ``docs`` as pieces placed in sequences of at most ``capacity`` ids.

    ``vocabulary``: a tokenizers file, present on every executor.  A document is its
    text's ids (null text: none) and then ``END_OF_DOCUMENT``; only documents longer
    than ``capacity`` are cut, into full pieces and a last one.

    Tokenising writes one narrow row a piece to the shared folder.  The driver sees only
    the count of each length, at most ``capacity`` rows, and plans on those.  Pieces get
    ranks within their length in cells of about ``CELL_ROWS`` rows, ``CELLS`` of them at
    most, so a length that most documents share is still ranked by many tasks, and a
    bounded plan table turns the rank into sequence and offset.  A piece's cell comes from
    the piece and from its number in the written table, so equal pieces spread over cells, too.

    Every row is packed for itself, so repeated rows and null ids are kept; which of the
    places for its length a piece gets depends on how the table was read.  Extra columns
    are ignored.  An empty table gives an empty result.

    Returns doc_id long, piece int, start long, length long, ids_crc32 long,
    sequence_id long, offset long.
    """
    spark = docs.sparkSession
    pieces = persisted(piece_rows(docs, vocabulary, capacity).withColumn("_written", F.monotonically_increasing_id()))
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    cells = spark.createDataFrame([(n, min(CELLS, -(-c // CELL_ROWS))) for n, c in counts.items()], "length long, _cells long")
    plan_rows = spark.createDataFrame(
        plan(counts, capacity), "length long, _from long, _to long, _first long, _each long, _offset long"
    )
    row = ["doc_id", "piece", "start", "ids_crc32"]
    celled = pieces.join(F.broadcast(cells), "length").withColumn("_cell", F.pmod(F.xxhash64(*row, "_written"), "_cells")).drop("_cells", "_written")
    before = Window.partitionBy("length").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    base = celled.groupBy("length", "_cell").count().select("length", "_cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))
    order = Window.partitionBy("length", "_cell").orderBy(*row)
    ranked = celled.withColumn("_n", F.row_number().over(order) - 1).join(base, ["length", "_cell"])
    ranked = ranked.withColumn("_rank", F.col("_base") + F.col("_n")).drop("_cell", "_n", "_base")
    at = F.broadcast(plan_rows)
    placed = ranked.join(at, (ranked["length"] == at["length"]) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    step = F.col("_rank") - F.col("_from")
    return placed.select(
        "doc_id",
        "piece",
        "start",
        ranked["length"],
        "ids_crc32",
        (F.col("_first") + F.expr("(_rank - _from) div _each")).alias("sequence_id"),
        (F.col("_offset") + F.pmod(step, F.col("_each")) * ranked["length"]).alias("offset"),
    )
