"""Repair of conversation structure by bidirectional Dijkstra over the edit lattice.

A node of the lattice is (turns consumed, role that came last); an edge keeps, reroles
or deletes the next turn, or inserts an empty one.  A forward and a reverse heap
search towards each other; after they meet they go on until no crossing of the same
cost can be left, so that every node of every cheapest path is settled on one side.
Nodes from which no cheapest path goes on are then struck out, and the least audit is
read off by taking the least letter at each node: a letter leads to one node only, so
no other comparison is needed.

Turns are grouped with their copies, sorted by range over (conversation, turn, role,
text) and streamed, so a long conversation spreads over many tasks.  One that ends
inside a task within ``BLOCK_ROWS`` turns is solved there.  Others become blocks: the
same search gives a block's cost from each role to each role, a pass over those 16
numbers a block gives the cheapest way on from each block's end, and with it each
block finds its least audit for every role it may be entered with.  A last pass picks
them in order, one block in memory at a time.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from newsflow.llm.common import SPACES, shuffle_width, small_batches, written

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
EXPECTED = (USER, USER, ASSISTANT, USER)  # the role that may come after each state
NAMES = {USER: "user", ASSISTANT: "assistant"}
# cheapest end after the last turn: insert what is missing up to an assistant
FINISH, SUFFIX = {START: 0, SYSTEM: 2 * INSERT, USER: INSERT, ASSISTANT: 0}, {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}

BLOCK_ROWS, BLOCK_BYTES = 2048, 4 << 20
FAR = 1 << 60
SOUND, BLANK, DUPLICATE, CUT = "", "blank", "duplicate", "truncated"


def turn_edges(initial: str, fault: str) -> list[list[tuple[str, int, int]]]:
    """For each state: (letter, next state, cost) of the edges that consume a turn, in order of letters."""
    out = []
    for state in range(4):
        edges = [("D", state, DELETE)]
        if fault not in (BLANK, DUPLICATE):
            more = TRUNCATED if fault == CUT else 0
            kept = {"s": SYSTEM if state == START else None,
                    "u": USER if EXPECTED[state] == USER else None,
                    "a": ASSISTANT if EXPECTED[state] == ASSISTANT else None}.get(initial)
            if kept is not None:
                edges.append(("K", kept, KEEP + more))
            edges.append(("R", EXPECTED[state], REROLE + more))
        out.append(edges)
    return out


_EDGES: dict[tuple[str, str], tuple] = {}


def edges_of(turn: tuple[str, str, int]) -> tuple:
    """(forward edges, reverse edges) by state of a turn (initial, fault, copies)."""
    key = (turn[0] if turn[0] in ("s", "u", "a") else "", turn[1])
    if key not in _EDGES:
        ahead = turn_edges(*key)
        back = [[(s, cost) for s in range(4) for _, to, cost in ahead[s] if to == state] for state in range(4)]
        _EDGES[key] = ahead, back
    return _EDGES[key]


def search(turns: list[tuple[str, str, int]], entry: int, exits: dict[int, int]) -> tuple[int, str, int] | None:
    """(cost, least audit, last state) of the cheapest paths over ``turns`` from state ``entry``.

    ``exits`` gives the cost of going on from each state after the last turn.  Nothing
    is inserted after the last turn.  Copies of a turn after its first are deleted.
    """
    n = len(turns)
    steps = [edges_of(t) for t in turns]
    extra = [DELETE * (t[2] - 1) for t in turns]
    ahead, back = {entry: 0}, {4 * n + s: c for s, c in exits.items()}
    heap_f, heap_r = [(0, entry)], sorted((c, v) for v, c in back.items())
    done_f: dict[int, int] = {}
    done_r: dict[int, int] = {}
    best = min((c + back[v] for v, c in ahead.items() if v in back), default=FAR)

    def forward(v):
        i, s = divmod(v, 4)
        if i < n:
            yield 4 * i + EXPECTED[s], INSERT
            for _, to, cost in steps[i][0][s]:
                yield 4 * (i + 1) + to, cost + extra[i]

    def reverse(v):
        i, s = divmod(v, 4)
        if i < n:
            for before in range(4):
                if EXPECTED[before] == s:
                    yield 4 * i + before, INSERT
        if i:
            for before, cost in steps[i - 1][1][s]:
                yield 4 * (i - 1) + before, cost + extra[i - 1]

    while heap_f and heap_r and heap_f[0][0] + heap_r[0][0] <= best:
        if heap_f[0][0] <= heap_r[0][0]:
            heap, own, other, done, moves = heap_f, ahead, back, done_f, forward
        else:
            heap, own, other, done, moves = heap_r, back, ahead, done_r, reverse
        cost, v = heapq.heappop(heap)
        if v in done:
            continue
        done[v] = cost
        for to, step in moves(v):
            reached = cost + step
            if reached < own.get(to, FAR):
                own[to] = reached
                heapq.heappush(heap, (reached, to))
                if to in other:
                    best = min(best, reached + other[to])
    if best >= FAR:
        return None

    # costs from the entry along cheapest paths, and the nodes that a cheapest path leaves
    place = {v: best - c for v, c in done_r.items()}
    good = {v for v in done_r if v not in done_f or done_f[v] + done_r[v] == best}
    place.update(done_f)
    for v in sorted((v for v in done_f if v not in good), key=lambda v: (done_f[v], v), reverse=True):
        if v >= 4 * n:
            if done_f[v] + back.get(v, FAR) == best:
                good.add(v)
        elif any(to in good and done_f[v] + step == place[to] for to, step in forward(v)):
            good.add(v)
    audit, i, state = [], 0, entry
    while i < n:
        here = place[4 * i + state]
        edges = steps[i][0][state]
        moves = [edges[0], ("I", EXPECTED[state], INSERT), *edges[1:]]
        for letter, to, cost in moves:
            consumed = letter != "I"
            v = 4 * (i + consumed) + to
            if v in good and here + cost + (extra[i] if consumed else 0) == place[v]:
                audit.append(letter)
                if consumed:
                    audit.append("D" * (turns[i][2] - 1))
                    i += 1
                state = to
                break
    return best, "".join(audit), state


def applied(turns: list[dict], audit: str, state: int) -> Iterator[tuple[str, str, str]]:
    """(letter, role, text) of the turns that an audit leaves, entered with ``state``."""
    at, left = 0, turns[0]["copies"] if turns else 0
    for letter in audit:
        if letter == "I":
            state = EXPECTED[state]
            yield letter, NAMES[state], ""
            continue
        turn, left = turns[at], left - 1
        if letter == "K":
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[turn["role"][:1]]
            yield letter, turn["role"], turn["text"]
        elif letter == "R":
            state = EXPECTED[state]
            yield letter, NAMES[state], turn["text"]
        if not left:
            at += 1
            left = turns[at]["copies"] if at < len(turns) else 0


# -------------------------------------------------------------------- Spark

def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the planted damage; a null role or text is one space."""
    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                text("role").alias("role"), text("text").alias("text"))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = rows.withColumn("kind", kind).where("kind != 0")
    rows = rows.withColumn("text", F.when(F.col("kind") == 1, "").when(
        F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    rows = rows.withColumn("role", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")))
    twice = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", "role", "text", twice.alias("copy")).drop("copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """Distinct turns (conv_id, turn, role, text, copies, fault); ``fault`` is that of the first copy.

    Copies are counted before any shuffle by their key.  The first place of a role and
    text in a conversation is an aggregate joined back on whole distinct turns, so a
    text that a long conversation repeats is no hot key.
    """
    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    turns = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        text("role").alias("role"), text("text").alias("text"))
    turns = written(turns.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
                    .withColumn("key", F.unhex(F.sha2("text", 256))), "turns")
    firsts = turns.groupBy("conv_id", "role", "key").agg(F.min(F.struct("turn")).alias("t")).select(
        F.col("conv_id").alias("c"), F.col("t.turn").alias("t"), F.col("role").alias("r"), F.col("key").alias("k"),
        F.lit(True).alias("first"))
    joined = turns.join(firsts, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t"))
                        & (F.col("role") == F.col("r")) & (F.col("key") == F.col("k")), "left")
    end = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = (F.when(end == "", BLANK).when(F.col("first").isNull(), DUPLICATE)
             .when(~F.right(end, F.lit(1)).isin(".", "!", "?"), CUT).otherwise(SOUND))
    return joined.select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"))


TURNS = "array<struct<role:string,text:string,fault:string,copies:long>>"
BLOCKS = ("conv_id long, part int, block int, complete boolean, blank long, duplicate long, truncated long, illegal long, "
          f"first string, last string, cost long, audits array<string>, leaves array<int>, between array<long>, turns {TURNS}")
LEGAL = {"su", "ua", "au"}


def block_row(conv_id, part: int, block: int, turns: list[dict], complete: bool) -> dict:
    short = [(t["role"][:1], t["fault"], t["copies"]) for t in turns]
    row = dict(conv_id=conv_id, part=part, block=block, complete=complete, blank=0, duplicate=0, truncated=0,
               first=short[0][0], last=short[-1][0], cost=None, audits=None, leaves=None, between=None, turns=turns)
    for _, fault, copies in short:
        if fault:
            row[fault] += 1
        row[BLANK if fault == BLANK else DUPLICATE] += copies - 1
    row["illegal"] = sum(a[0] + b[0] not in LEGAL for a, b in zip(short, short[1:])) + sum(c - 1 for *_, c in short)
    if complete:
        cost, audit, leaves = search(short, START, FINISH)
        row.update(cost=cost, audits=[audit], leaves=[leaves])
    else:
        found = (search(short, p, {q: 0}) for p in range(4) for q in range(4))
        row["between"] = [f[0] if f else FAR for f in found]
    return row


def arrow(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def blocks_of(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Conversations in turn order as blocks (see ``BLOCKS``); one that is ``complete`` is a block and is solved."""
    spark = rows.sparkSession
    order = ["conv_id", "turn", "role", "text"]
    ranged = with_faults(rows).repartitionByRange(shuffle_width(spark), *order).sortWithinPartitions(*order)
    ranged = ranged.withColumn("part", F.spark_partition_id())
    schema = arrow_schema(BLOCKS)

    def gather(batches):
        def chunks():
            """(conv_id, part, first of its conversation here, ends it here, turns)"""
            held, size, key, fresh = [], 0, None, True
            for b in batches:
                for t in b.to_pylist():
                    own = (t.pop("conv_id"), t.pop("part"))
                    if held and own != key:
                        yield (*key, fresh, True, held)
                        held, size, fresh = [], 0, True
                    elif held and (len(held) >= block_rows or size >= BLOCK_BYTES):
                        yield (*key, fresh, False, held)
                        held, size, fresh = [], 0, False
                    key = own
                    t.pop("turn")
                    held.append(t)
                    size += len(t["text"])
            if held:
                yield (*key, fresh, None, held)  # may go on in the next range

        block, leading, out = 0, True, []
        for conv_id, part, fresh, ends, turns in chunks():
            # the first conversation here may have begun in the range before
            out.append(block_row(conv_id, part, block, turns, bool(fresh and ends and not leading)))
            block += 1
            if ends:
                leading = False
            if len(out) >= 128:
                yield arrow(out, schema)
                out = []
        if out:
            yield arrow(out, schema)

    return written(ranged.mapInArrow(gather, BLOCKS), "blocks")


def solved(blocks: DataFrame) -> DataFrame:
    """The blocks of unfinished conversations with ``cost`` of the conversation, and ``audits`` and ``leaves`` by entry."""
    spark = blocks.sparkSession
    width = shuffle_width(spark)
    still = blocks.where(~F.col("complete"))

    def ways_on(batches):
        """Reads the blocks of a conversation from its end; keeps the way on from one block's end only."""
        rows = (r for b in batches for r in zip(*(b[c].to_pylist() for c in ("conv_id", "part", "block", "between"))))
        for conv_id, own in groupby(rows, key=lambda r: r[0]):
            on, out = [FINISH[s] for s in range(4)], []
            for _, part, block, between in own:
                out.append(dict(conv_id=conv_id, part=part, block=block, on=on))
                on = [min(FAR, *(between[4 * p + q] + on[q] for q in range(4))) for p in range(4)]
                out[-1]["cost"] = on[START]  # that of the conversation, if this is its first block
                if len(out) == 4096:
                    yield arrow(out, ways)
                    out = []
            yield arrow(out, ways)

    ways_ddl = "conv_id long, part int, block int, on array<long>, cost long"
    ways = arrow_schema(ways_ddl)
    ends = still.select("conv_id", "part", "block", "between").repartition(width, "conv_id").sortWithinPartitions(
        "conv_id", F.desc("part"), F.desc("block")).mapInArrow(ways_on, ways_ddl)
    ends = ends.select(F.col("part").alias("p"), F.col("block").alias("b"), "on", F.col("cost").alias("c"))
    both = still.join(ends, (F.col("part") == F.col("p")) & (F.col("block") == F.col("b")))  # one block each
    names = [c.split()[0] for c in BLOCKS.split(", ")]
    both = both.select(*names, "on", "c")

    def solve(batches):
        for b in batches:
            out = b.to_pylist()
            for r in out:
                short = [(t["role"][:1], t["fault"], t["copies"]) for t in r["turns"]]
                exits = {s: c for s, c in enumerate(r.pop("on")) if c < FAR}
                found = [search(short, p, exits) for p in range(4)]
                r["audits"] = [f[1] if f else None for f in found]
                r["leaves"] = [f[2] if f else None for f in found]
                r["cost"] = r.pop("c")
            yield arrow(out, schema)

    schema = arrow_schema(BLOCKS)
    return both.mapInArrow(solve, BLOCKS)


def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple[dict, str, int]]]]:
    """(conv_id, its blocks as (block, audit, state it is entered with)) of sorted solved blocks."""
    def walk(blocks):
        state = START
        for r in blocks:
            yield r, r["audits"][state], state
            state = r["leaves"][state]
        yield None, SUFFIX[state], state

    rows = (r for b in batches for r in b.to_pylist())
    for conv_id, own in groupby(rows, key=lambda r: r["conv_id"]):
        yield conv_id, walk(own)


DIGEST = ("conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
REPAIRED = "conv_id long, position long, edit string, role string, text string"


def digests(batches, schema: pa.Schema):
    out = []
    for conv_id, blocks in in_order(batches):
        row = dict(conv_id=conv_id, blank=0, duplicate=0, truncated=0, illegal=0, cost=None)
        sha, letters, before, gap = hashlib.sha256(), [], None, b""
        for r, audit, state in blocks:
            letters.append(audit)
            if r is not None:
                for name in ("blank", "duplicate", "truncated", "illegal"):
                    row[name] += r[name]
                row["illegal"] += before is not None and before + r["first"] not in LEGAL
                row["cost"], before = r["cost"] if row["cost"] is None else row["cost"], r["last"]
            for _, role, text in applied(r["turns"] if r else [], audit, state):
                sha.update(gap + f"{role}:{text}".encode())
                gap = b"\n"
        out.append(row | {"audit": "".join(letters), "repaired_sha256": sha.hexdigest()})
        if len(out) == 512:
            yield arrow(out, schema)
            out = []
    if out:
        yield arrow(out, schema)


def turn_rows(batches, schema: pa.Schema):
    out = []
    for conv_id, blocks in in_order(batches):
        position = 0
        for r, audit, state in blocks:
            for letter, role, text in applied(r["turns"] if r else [], audit, state):
                out.append(dict(conv_id=conv_id, position=position, edit=letter, role=role, text=text))
                position += 1
                if len(out) == 512:
                    yield arrow(out, schema)
                    out = []
    if out:
        yield arrow(out, schema)


def each_conversation(rows: DataFrame, fold, ddl: str, block_rows: int) -> DataFrame:
    small_batches(rows.sparkSession)
    blocks = blocks_of(rows, block_rows)
    rest = solved(blocks).repartition(shuffle_width(rows.sparkSession), "conv_id").sortWithinPartitions(
        "conv_id", "part", "block")
    schema = arrow_schema(ddl)

    def folded(batches):
        yield from fold(batches, schema)
    return blocks.where("complete").mapInArrow(folded, ddl).unionByName(rest.mapInArrow(folded, ddl))


def repaired_turns(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(conv_id, position, edit, role, text): the turns of every repaired conversation, in order."""
    return each_conversation(rows, turn_rows, REPAIRED, block_rows)


def repair_digest(rows: DataFrame, original: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row for each conv_id of ``original``: gaps, counts of faults, cost, audit and hash of the repair of ``rows``.

    Turns are taken in order of (turn, role, text), null turns first; rows without a
    conv_id are one conversation.  A null role or text is one space, which makes the
    turn blank or its role unknown.  Copies of a turn stand next to it.  A conversation
    without rows has zeros, an empty audit and the hash of nothing; an empty
    ``original`` gives no rows; columns beside conv_id, turn, role and text are not
    read.  The audit of a conversation is one string, as long as its edits.
    """
    found = each_conversation(rows, digests, DIGEST, block_rows)
    numbers = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn")).distinct()
    gaps = numbers.groupBy("conv_id").agg(F.max("turn").alias("x"), F.min("turn").alias("y"), F.count("turn").alias("n"))
    gaps = gaps.select(F.col("conv_id").alias("g"), F.coalesce(F.expr("x - y + 1 - n"), F.lit(0)).alias("gaps"))
    own = found.withColumnRenamed("conv_id", "f")
    every = original.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    out = every.join(gaps, F.col("conv_id").eqNullSafe(F.col("g")), "left").join(
        own, F.col("conv_id").eqNullSafe(F.col("f")), "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
