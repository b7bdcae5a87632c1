"""Conversations brought into a legal order of roles at the least cost of edits."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import numbered_within, persisted

BLOCK = 256  #: turns whose cost layers are held at once
INSERT, REROLE, DELETE, TRUNCATED = 3, 3, 4, 3  #: what an edit costs, and what a truncated turn adds that isn't deleted
NEVER = 1 << 40

# The grammar (s?(ua)+)? as an automaton: 0 begin, 1 after s, 2 after u, 3 after a; 0 and 3 accept.
ACCEPT = (0, NEVER, NEVER, 0)
FOLLOW = (2, 2, 3, 2)  #: the only state that an inserted or renamed turn can lead to
KEPT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "x": (None,) * 4}


def _before(to: tuple) -> bytes:
    """For each set of states, as bits, those that lead into it."""
    return bytes(sum(1 << p for p in range(4) if to[p] is not None and x >> to[p] & 1) for x in range(16))


BEFORE_FOLLOW = _before(FOLLOW)

#: For each kind of turn (role's initial, in upper case if truncated; d: must be deleted) what
#: keeping, deleting and renaming it cost beyond the cheapest of them, the states that keeping leads to, and from where.
TURNS = {}
for _role, _to in KEPT.items():
    for _kind, _more in ((_role, 0), (_role.upper(), TRUNCATED)):
        _costs = [_more if _role != "x" else NEVER, DELETE, REROLE + _more]
        TURNS[_kind] = (*(c - min(_costs) if c < NEVER else NEVER for c in _costs), _to, _before(_to))
TURNS["d"] = (NEVER, 0, NEVER, KEPT["x"], _before(KEPT["x"]))


def layers(turns: str, end: tuple[int, ...], want: int) -> list[bytearray]:
    """For each cost k from 0 on, the states before each turn from which the end is reached at k or less.

    ``end`` holds what is still to pay in each state after the last turn.  States are the
    bits of a number, so a layer is a row of sets, made from those of the layers that an
    edit's cost below.  A layer begins where the one before isn't full and ends where
    nothing can be reached yet.  The last one is the first that has all of ``want`` before the first turn.
    """
    n, out, last = len(turns), [], len(turns)
    while True:
        k = len(out)
        row = bytearray(out[-1]) if out else bytearray(n + 1)
        for i in range(last, -1, -1):
            x = row[i]
            if i == n:
                x |= sum(1 << q for q in range(4) if end[q] <= k)
            else:
                keep, delete, rename, _, before = TURNS[turns[i]]
                if k >= keep:
                    x |= before[(out[k - keep] if keep else row)[i + 1]]
                if k >= delete:
                    x |= (out[k - delete] if delete else row)[i + 1]
                if k >= rename:
                    x |= BEFORE_FOLLOW[(out[k - rename] if rename else row)[i + 1]]
            if k >= INSERT:
                x |= BEFORE_FOLLOW[out[k - INSERT][i]]
            row[i] = x
            if not x:
                break
        while last >= 0 and row[last] == 15:
            last -= 1
        out.append(row)
        if row[0] & want == want:
            return out


def traced(turns: str, end: tuple[int, ...], found: list[bytearray], state: int) -> tuple[list[str], int]:
    """The least of the cheapest edits from ``state`` on, those of each turn with what is inserted before it, and the state at the end.

    D, K; i and j insert a user's and an assistant's turn, r and q rename to them.  What
    is inserted behind the last turn comes with it.
    """
    k = next(k for k, row in enumerate(found) if row[0] >> state & 1)
    out, piece, i = [], "", 0
    while i < len(turns) or k != end[state]:
        if i < len(turns):
            keep, delete, rename, to, _ = TURNS[turns[i]]
            if k >= delete and found[k - delete][i + 1] >> state & 1:
                k, i = k - delete, i + 1
                out.append(piece + "D")
                piece = ""
                continue
        if k >= INSERT and found[k - INSERT][i] >> FOLLOW[state] & 1:
            k, state = k - INSERT, FOLLOW[state]
            piece += "i" if state == 2 else "j"
            continue
        if k >= keep and to[state] is not None and found[k - keep][i + 1] >> to[state] & 1:
            k, state, letter = k - keep, to[state], "K"
        else:
            k, state = k - rename, FOLLOW[state]
            letter = "r" if state == 2 else "q"
        out.append(piece + letter)
        piece, i = "", i + 1
    if piece:
        out[-1] += piece
    return out, state


@lru_cache(100_000)
def whole(turns: str) -> tuple[str, ...]:
    """The edits of a conversation of one block."""
    return tuple(traced(turns, ACCEPT, layers(turns, ACCEPT, 1), 0)[0])


def transfer(turns: str) -> list[int]:
    """What it costs at least (beyond the turns' own least costs) to get from each state to each by a block, sixteen numbers.

    The first two states are only ever left, so they are reached by deleting all turns,
    or all but one that is kept as s; the others by the layers.
    """
    out = [[NEVER] * 4 for _ in range(4)]
    costs = [TURNS[t] for t in turns]
    gone = sum(c[1] for c in costs)
    out[0][0] = out[1][1] = gone
    out[0][1] = min([gone - c[1] + c[0] for c, t in zip(costs, turns, strict=True) if t in "sS"], default=NEVER)
    for q in (2, 3):
        end = tuple(0 if p == q else NEVER for p in range(4))
        for k, row in enumerate(layers(turns, end, 15)):
            for p in range(4):
                if row[0] >> p & 1 and out[p][q] == NEVER:
                    out[p][q] = k
    return [c for row in out for c in row]


def _by_conversation(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    """(key, whether it is another conversation than the row before, the columns' values) of rows sorted by conversation."""
    key = None
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ["k", *columns]), strict=True):
            yield row[0], row[0] != key, row[1:]
            key = row[0]


def _emitted(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], f.type) for i, f in enumerate(schema)], schema=schema)
            held = []
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], f.type) for i, f in enumerate(schema)], schema=schema)


def cheapest_edits(blocks: DataFrame) -> DataFrame:
    """(k, b, pieces): the edits of each turn, from (k, b, turns, blocks), the turns of each block and the number of its conversation's blocks.

    A conversation of one block is done at once.  Of a longer one only what it costs to get
    through each block (sixteen numbers) is passed along: from the last block to the first,
    what is to pay after each of them; then each block's edits from every state it
    can be entered in; then from the first to the last, which of them it was.  Both walks
    read a conversation's blocks in order and hold one.
    """
    short = blocks.where("blocks = 1").select("k", "b", "turns")
    long = persisted(blocks.where("blocks > 1").select("k", "b", "turns"))

    def at_once(batches):
        for batch in batches:
            pieces = [list(whole(t)) for t in batch.column("turns").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("b"), pa.array(pieces, pa.list_(pa.string()))], ["k", "b", "pieces"])

    def costs(batches):
        for batch in batches:
            m = pa.array([transfer(t) for t in batch.column("turns").to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("b"), batch.column("turns"), m], ["k", "b", "turns", "m"])

    def backwards(batches):
        def rows():
            end = ACCEPT
            for k, new, (b, turns, m) in _by_conversation(batches, ["b", "turns", "m"]):
                end = ACCEPT if new else end
                yield k, b, turns, list(end)
                before = [min(m[4 * p + q] + end[q] for q in range(4)) for p in range(4)]
                least = min(before)
                end = tuple(min(c - least, NEVER) for c in before)

        yield from _emitted(rows(), pa.schema([("k", pa.string()), ("b", pa.int64()), ("turns", pa.string()), ("todo", pa.list_(pa.int64()))]))

    def all_ways(batches):
        for batch in batches:
            ways, ends = [], []
            for turns, end in zip(batch.column("turns").to_pylist(), batch.column("todo").to_pylist(), strict=True):
                found = layers(turns, tuple(end), 15)
                ways.append([])
                ends.append([])
                for state in range(4):
                    pieces, to = traced(turns, tuple(end), found, state)
                    ways[-1].append(pieces)
                    ends[-1].append(to)
            arrays = [batch.column("k"), batch.column("b"), pa.array(ways, pa.list_(pa.list_(pa.string()))), pa.array(ends, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["k", "b", "ways", "ends"])

    def forwards(batches):
        def rows():
            state = 0
            for k, new, (b, ways, ends) in _by_conversation(batches, ["b", "ways", "ends"]):
                state = 0 if new else state
                yield k, b, ways[state]
                state = ends[state]

        yield from _emitted(rows(), pa.schema([("k", pa.string()), ("b", pa.int64()), ("pieces", pa.list_(pa.string()))]), size=64)

    through = long.mapInArrow(costs, "k string, b long, turns string, m array<long>").repartition("k").sortWithinPartitions("k", F.desc("b"))
    todo = persisted(through.mapInArrow(backwards, "k string, b long, turns string, todo array<long>"))
    ways = todo.repartition("k", "b").mapInArrow(all_ways, "k string, b long, ways array<array<string>>, ends array<long>")
    taken = ways.repartition("k").sortWithinPartitions("k", "b").mapInArrow(forwards, "k string, b long, pieces array<string>")
    return short.mapInArrow(at_once, "k string, b long, pieces array<string>").unionByName(taken)


def _words(c: Column) -> Column:
    return c.rlike(r"[^ \t-\r]")


def with_faults(rows: DataFrame) -> DataFrame:
    """(k, place, turn, role, text, fault), written: each conversation's turns numbered from 0, and their first faults.

    ``rows``: k string (not null), turn, role, text (not null).  Turns are ordered by their
    number, nulls first, those alike in it by a digest of role and text, so that repeats of
    one are next to each other.  blank: without a character other than space and
    U+0009-000D; duplicate: role and text came before; truncated: the last such character
    isn't one of . ! ?
    """
    digest = F.sha2(F.concat_ws(":", F.length("role"), "role", "text").cast("binary"), 256)
    placed = numbered_within(rows.select("k", "turn", "role", "text", digest.alias("digest")), ["k"], [F.col("turn").asc_nulls_first(), F.col("digest").asc()])
    filled = placed.where(_words(F.col("text")))
    again = persisted(filled.groupBy("k", "digest").agg(F.min("place").alias("first"), F.count("*").alias("c")).where("c > 1").drop("c"))
    marked = placed.join(again, ["k", "digest"], "left")
    fault = (
        F.when(~_words(F.col("text")), "blank")
        .when(F.col("place") > F.col("first"), "duplicate")
        .when(~F.col("text").rlike(r"[.!?][ \t-\r]*\z"), "truncated")
    )
    return persisted(marked.select("k", "place", "turn", "role", "text", fault.alias("fault")))


def repaired_turns(rows: DataFrame) -> DataFrame:
    """(k, place, sub, edit, was, role, text, turn, fault): the cheapest edits of each conversation in order, with the turns they leave.

    ``rows`` as :func:`with_faults` takes them.  edit is Keep, Rerole, Delete or Insert;
    of a deleted turn role and text are null, ``was`` is a turn's role before and null for an
    inserted one.  The roles that are left read (s?(ua)+)? by their initials; of all edits
    of the least cost (insert 3, rename 3, delete 4, and 3 for each truncated turn that stays;
    blank and duplicate turns must go) those whose initials come first in ASCII are taken.
    A role with another initial, or none, can't stay as it is.
    """
    turns = with_faults(rows)
    initial = F.substring("role", 1, 1)
    kind = F.when(F.col("fault").isin("blank", "duplicate"), "d").otherwise(F.when(initial.isin("s", "u", "a"), initial).otherwise("x"))
    kind = F.when(F.col("fault") == "truncated", F.upper(kind)).otherwise(kind)
    block = F.floor(F.col("place") / BLOCK).cast("long").alias("b")
    listed = F.array_sort(F.collect_list(F.struct("place", kind.alias("kind"))))  # a block's own
    strings = turns.groupBy("k", block).agg(F.array_join(F.transform(listed, lambda x: x["kind"]), "").alias("turns"))
    count = turns.groupBy("k").agg((F.floor(F.max("place") / BLOCK) + 1).cast("long").alias("blocks"))
    edits = cheapest_edits(persisted(strings.join(count, "k")))
    each = edits.select("k", "b", F.posexplode("pieces").alias("i", "piece")).select("k", (F.col("b") * BLOCK + F.col("i")).alias("place"), "piece")
    spread = turns.join(each, ["k", "place"]).select("k", "place", "turn", "role", "text", "fault", F.posexplode(F.split("piece", "")).alias("sub", "e"))
    inserted, e = F.col("e").isin("i", "j"), F.col("e")
    return spread.select(
        "k",
        "place",
        "sub",
        F.when(inserted, "Insert").when(e == "D", "Delete").when(e == "K", "Keep").otherwise("Rerole").alias("edit"),
        F.when(~inserted, F.col("role")).alias("was"),
        F.when(e.isin("i", "r"), "user").when(e.isin("j", "q"), "assistant").when(e == "K", F.col("role")).alias("role"),
        F.when(inserted, "").when(e != "D", F.col("text")).alias("text"),
        F.when(~inserted, F.col("turn")).alias("turn"),
        F.when(~inserted, F.col("fault")).alias("fault"),
    )


SUMMARY = "k string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
LEGAL = {"su", "ua", "au"}


def summaries(turns: DataFrame) -> DataFrame:
    """A row for each conversation with its faults, cost, audit and a digest of what is left, from :func:`repaired_turns`.

    Edits are read in order and only running totals held: a digest of a whole conversation
    is taken by one task, which passes its turns through and keeps none of them.
    """

    def run(batches):
        def row(key, s):
            gaps = s["high"] - s["low"] + 1 - s["turns"] if s["turns"] else 0
            return key, gaps, s["blank"], s["duplicate"], s["truncated"], s["illegal"], s["cost"], s["audit"].decode(), s["sha"].hexdigest()

        def rows():
            key, s, last = None, None, None
            for k, new, (edit, was, role, text, turn, fault) in _by_conversation(batches, ["edit", "was", "role", "text", "turn", "fault"]):
                if new:
                    if s:
                        yield row(key, s)
                    key, last = k, None
                    s = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "turns": 0, "low": None, "high": None, "left": 0, "audit": bytearray(), "sha": hashlib.sha256()}
                s["audit"] += edit[:1].encode()
                s["cost"] += {"Keep": 0, "Rerole": REROLE, "Delete": DELETE, "Insert": INSERT}[edit] + (TRUNCATED if fault == "truncated" and edit != "Delete" else 0)
                if edit != "Insert":
                    if fault:
                        s[fault] += 1
                    if last is not None and last + was[:1] not in LEGAL:
                        s["illegal"] += 1
                    last = was[:1]
                    if turn is not None and turn != s["high"]:  # turns come in order
                        s["turns"], s["low"], s["high"] = s["turns"] + 1, turn if s["low"] is None else s["low"], turn
                if edit != "Delete":
                    s["sha"].update(("\n" * (s["left"] > 0) + role + ":").encode())
                    s["sha"].update(text.encode())
                    s["left"] += 1
            if s:
                yield row(key, s)

        names = [f.split(" ") for f in SUMMARY.split(", ")]
        yield from _emitted(rows(), pa.schema([(n, pa.string() if t == "string" else pa.int64()) for n, t in names]), size=256)

    return turns.repartition("k").sortWithinPartitions("k", "place", "sub").mapInArrow(run, SUMMARY)


def conversation_key(conv_id: Column) -> Column:
    """A string for each conversation, of its own for null."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def damaged(rows: DataFrame) -> DataFrame:
    """(k, turn, role, text) of ``rows`` (conv_id, turn, role, text; nulls are a space) with some of them spoilt.

    By the checksum of `conv_id:turn` modulo 20: 0 drops a row, 1 empties its text, 2 takes
    its . ! ? out, 3 repeats it and 4 makes it a user's.
    """
    blank = F.lit(" ")
    r = rows.select(
        conversation_key(F.col("conv_id")).alias("k"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
        (F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank)).cast("binary")) % 20).alias("z"),
    ).where("z <> 0")
    text = F.when(F.col("z") == 1, "").when(F.col("z") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("z") == 3, 2).otherwise(1)))
    return r.select("k", "turn", F.when(F.col("z") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), times.alias("copy")).drop("copy")


def conversation_repair(conversations: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost long, audit and repaired_sha256 string of every conversation.

    ``conversations``: conv_id, turn, role, text; ``rows`` (k, turn, role, text), if given,
    are what is there of them after some damage.  See :func:`repaired_turns` for the edits
    and :func:`with_faults` for the faults.  gaps: numbers between the smallest and the
    largest turn that no turn has.  illegal: neighbours whose roles' initials aren't su, ua
    or au, before the repair.  audit: the edits' initials in order.

    Nulls: a null role or text is one space, so such a role can't stay and such a text is
    blank; a null turn comes first and counts for no gap; a null conv_id is a conversation
    of its own.  Turns alike in number are ordered by a digest; repeated rows are
    duplicates.  A conversation without a row gives zeros, an empty audit and the digest of
    nothing.  Long texts pass through whole.  Extra columns are ignored; an empty table gives an empty one.
    """
    if rows is None:
        blank = F.lit(" ")
        role, text = (F.coalesce(F.col(c).cast("string"), blank).alias(c) for c in ("role", "text"))
        rows = conversations.select(conversation_key(F.col("conv_id")).alias("k"), F.col("turn").cast("long").alias("turn"), role, text)
    known = summaries(repaired_turns(rows))
    out = conversations.select("conv_id").distinct().withColumn("k", conversation_key(F.col("conv_id"))).join(known, "k", "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256().hexdigest()
    return out.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
