"""Byte-level BPE as a bounded-lookahead streaming transducer, and its inverse."""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed: the pattern that cuts text into words for this kind of vocabulary.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

BLOCK = 1 << 16  #: characters held before words are cut off
CACHED_WORDS = 1 << 17  #: words whose ids a worker remembers, of CACHED_CHARS at most
CACHED_CHARS = 48

# A letter, digit run or blank ends for certain where another class follows.  After other
# signs only a blank ends it: an apostrophe may open a contraction.
_SAFE = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=[^\p{L}'])|(?<=\p{N})(?=[^\p{N}'])")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file.

    Bytes that print stand for themselves, the others for the characters from U+0100 on.
    """
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in prints else chr(next(spare)) for b in range(256)]


class Merges:
    """A merge list: its vocabulary, ranks, special strings and sufficient lookahead."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = {c: bytes([b]) for b, c in enumerate(byte_alphabet())}
        self.specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
        ids = {b"".join(to_byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.specials}
        listed = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        pairs = [tuple(b"".join(to_byte[c] for c in t) for t in p) for p in listed]
        self.byte_ids = [ids[bytes([b])] for b in range(256)]
        self.width = max(max(ids.values()), *self.specials.values(), 0) + 1
        self.ranks = {ids[u] * self.width + ids[v]: r for r, (u, v) in enumerate(pairs)}
        self.made = [ids[u + v] for u, v in pairs]
        self.bytes_of = [b""] * self.width
        for t, i in [*ids.items(), *((s.encode(), i) for s, i in self.specials.items())]:
            self.bytes_of[i] = t
        self.decimal = [str(i) for i in range(self.width)]
        self.lookahead = sufficient_lookahead(pairs)
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True)))) if self.specials else None
        self.words = regex.compile(WORDS)
        self.classes = [regex.compile(c) for c in (r"\p{L}+", r"\p{N}+", r"[^\s\p{L}\p{N}]+")]
        self.blank = regex.compile(r"\s+")
        self.known: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}

    def merge(self, data: bytes) -> list[int]:
        """Ids of ``data``, the merges applied by rank and then from the left."""
        return self._merge_short(data) if len(data) <= 64 else self._merge_long(data)

    def _merge_short(self, data: bytes) -> list[int]:
        part = [self.byte_ids[b] for b in data]
        get, width, none = self.ranks.get, self.width, len(self.made)
        rank = [get(a * width + b, none) for a, b in zip(part, part[1:])]
        while rank:
            least = min(rank)
            if least == none:
                break
            i = rank.index(least)
            part[i] = self.made[least]
            del part[i + 1], rank[i]
            if i < len(rank):
                rank[i] = get(part[i] * width + part[i + 1], none)
            if i:
                rank[i - 1] = get(part[i - 1] * width + part[i], none)
        return part

    def _merge_long(self, data: bytes) -> list[int]:
        n = len(data)
        part = [self.byte_ids[b] for b in data]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        get, width = self.ranks.get, self.width
        heap = [(r, i) for i in range(n - 1) if (r := get(part[i] * width + part[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if part[i] < 0 or j >= n or get(part[i] * width + part[j]) != rank:
                continue
            part[i], part[j] = self.made[rank], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := get(part[a] * width + part[b])) is not None:
                    heapq.heappush(heap, (r, a))
        return [p for p in part if p >= 0]

    def word(self, text: str) -> list[int]:
        """Ids of one word.  Two generations of ``CACHED_WORDS`` words are remembered."""
        found = self.older.get(text) or self.merge(text.encode())
        if len(text) <= CACHED_CHARS:
            if len(self.known) >= CACHED_WORDS:
                self.known, self.older = {}, self.known
            self.known[text] = found
        return found


def sufficient_lookahead(pairs: list[tuple[bytes, bytes]]) -> int:
    """Bytes after which a token can no longer change, computed from the merge list.

    Take two inputs that agree up to byte q, and let p be the end of the tokens on
    which they still agree after the merges of some ranks; at first p = q.  The next
    merge (u, v) moves p only if u is the last agreed token and v begins, in one of
    the inputs, with the token that stood after p: the one an earlier moving merge
    (u', v') left there, u' in one input and u'v' in the other, or a token built on
    them from the left.  So with reach(r) the farthest that a chain ending in merge r
    has moved p,

        reach(u, v) = |u| + max(0, reach(u', v') over earlier merges with u' or u'v'
                                   among v, v's left part, that one's left part, ...)

    and the largest reach bounds how far any unseen byte acts.  One pass over the list.
    """
    left: dict[bytes, bytes] = {}
    reach: dict[bytes, int] = {}
    most = 0
    for u, v in pairs:
        moved, x = 0, v
        while True:
            moved = max(moved, reach.get(x, 0))
            if x not in left:
                break
            x = left[x]
        here = len(u) + moved
        most = max(most, here)
        for t in (u, u + v):
            reach[t] = max(reach.get(t, 0), here)
        left[u + v] = u
    return most


class Encoder:
    """Text in pieces of any size to runs of ids, in memory that doesn't grow with the text.

    Held back are the characters after the last certain word end or, inside a word
    longer than a block, the bytes within the sufficient lookahead.
    """

    def __init__(self, merges: Merges) -> None:
        self.m = merges
        self.held = ""
        self.inside: regex.Pattern | None = None  #: class of the word that ``held`` continues

    def encode(self, text: str) -> Iterator[list[int]]:
        """Ids of a whole text, special strings included, as they become stable."""
        at = 0
        for hit in self.m.split.finditer(text) if self.m.split else ():
            yield from self._plain(text, at, hit.start())
            yield [self.m.specials[hit.group()]]
            at = hit.end()
        yield from self._plain(text, at, len(text))

    def _plain(self, text: str, a: int, b: int) -> Iterator[list[int]]:
        for i in range(a, b, BLOCK):
            yield from self.feed(text[i : min(b, i + BLOCK)])
        yield from self.finish()

    def feed(self, text: str) -> Iterator[list[int]]:
        self.held += text
        if len(self.held) < BLOCK:
            return
        for near in (256, BLOCK // 8, len(self.held)):  # mostly found close to the end
            hits = [h.start() for h in _SAFE.finditer(self.held, max(1, len(self.held) - near))]
            if hits:
                ready, self.held = self.held[: hits[-1]], self.held[hits[-1] :]
                yield from self._words(ready)
                return
        if len(self.held) >= 2 * BLOCK:
            yield from self._part()

    def finish(self) -> Iterator[list[int]]:
        ready, self.held = self.held, ""
        yield from self._words(ready)

    def _cut(self, text: str) -> list[str]:
        """The words of ``text``, the first of which may continue an earlier one."""
        head = self.inside.match(text) if self.inside else None
        self.inside = None
        return [head.group(), *self.m.words.findall(text, head.end())] if head else self.m.words.findall(text)

    def _words(self, text: str) -> Iterator[list[int]]:
        out: list[int] = []
        for w in self._cut(text):
            found = self.m.known.get(w)
            if found:
                out.extend(found)
            elif len(w) <= BLOCK:
                out.extend(self.m.word(w))
            else:
                yield out
                out = []
                yield from self._long(w)
        yield out

    def _part(self) -> Iterator[list[int]]:
        """Ids of the certain part of two blocks or more without a certain word end.

        They are at most a few short words and one that goes on: blanks, or signs of one
        class.  All but the last word are certain, and of it the tokens that no byte
        after it can change.
        """
        *whole, last = self._cut(self.held)
        for w in whole:
            yield from self._long(w)
        kind = next((c for c in self.m.classes if c.fullmatch(last, last[0] == " ")), None)
        tail = ""
        if kind is None:  # blanks, of which the last may begin the next word; or a contraction
            if not self.m.blank.fullmatch(last):
                self.held = last
                return
            last, tail = last[:-2], last[-2:]
        data, at, out, end, keep = last.encode(), 0, [], 0, 0
        for i in self.m.merge(data):
            at += len(self.m.bytes_of[i])
            if at > len(data) - self.m.lookahead:
                break
            out.append(i)
            if data[at] & 0xC0 != 0x80:  # a character begins here, so the rest is text
                keep, end = len(out), at
        yield out[:keep]
        self.held = data[end:].decode() + tail
        self.inside = kind if end else None

    def _long(self, word: str) -> Iterator[list[int]]:
        """Ids of one word of any length, a block at a time."""
        data, held, step = word.encode(), b"", 4 * BLOCK
        for i in range(0, len(data), step):
            held += data[i : i + step]
            at, out, limit = 0, [], len(held) - self.m.lookahead
            for t in self.m.merge(held):
                if at + len(self.m.bytes_of[t]) > limit:
                    break
                at += len(self.m.bytes_of[t])
                out.append(t)
            held = held[at:]
            yield out
        yield self.m.merge(held)


def decode(runs: Iterable[list[int]], merges: Merges) -> Iterator[str]:
    """Text of runs of ids: an incremental UTF-8 state machine holds at most three bytes of an unfinished character."""
    machine = codecs.getincrementaldecoder("utf-8")(errors="replace")
    bytes_of = merges.bytes_of
    for run in runs:
        yield machine.decode(b"".join([bytes_of[i] for i in run]))
    yield machine.decode(b"", final=True)


_LOADED: dict[str, Merges] = {}


def loaded(path: str) -> Merges:
    """The merge list of a file, read once by each worker."""
    if path not in _LOADED:
        _LOADED[path] = Merges(path)
    return _LOADED[path]


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Every document's token count and the digests of its ids and of its decoded text.

    ``vocabulary``: path of a byte-level BPE file, present on every executor.  Each text
    streams through encoder and decoder in its own scan task; ids go on in runs, so
    neither the list of ids nor the decoded text is held whole.  No shuffle.

    A null text counts as empty: no tokens, digests of the empty string.  Special
    strings inside a text become their special ids.  Rows are independent, so repeated
    rows and a null doc_id are kept as they are; columns other than doc_id and text are
    ignored.  An empty table gives an empty result.

    Returns doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string.
    """

    def run(batches):
        m = loaded(vocabulary)
        for batch in batches:
            rows = [_digests(t.as_py() or "", m) for t in batch.column("text")]
            n, ids, text = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(text, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def _digests(text: str, m: Merges) -> tuple[int, str, str]:
    n, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()

    def counted() -> Iterator[list[int]]:
        nonlocal n
        for run in Encoder(m).encode(text):
            if run:
                ids_hash.update((("," if n else "") + ",".join([m.decimal[i] for i in run])).encode())
                n += len(run)
                yield run

    for piece in decode(counted(), m):
        text_hash.update(piece.encode())
    return n, ids_hash.hexdigest(), text_hash.hexdigest()
