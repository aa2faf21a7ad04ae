"""Packing of documents into few fixed-length sequences by vector best-fit.

A document is encoded once; longer ones are cut into full pieces, the first piece
takes what is over.  Full pieces are sequences of their own and are never
shuffled.  The other pieces, as (length, checksum) records without their ids, are
dealt evenly into groups of about ``GROUP`` pieces whatever their documents, and
each group is packed by one task: pieces in falling length, each into the open
sequence that fits it best.

A sequence has three residual capacities: tokens, documents and attention cost
(the sum of squared piece lengths, what attention inside the pieces costs).  Each
piece asks for (length, 1, length ** 2).  A sequence is open to it if no capacity
is exceeded; among the open ones the least weighted norm of what would be left,
in shares of the capacities, wins (``fit="norm"``), or the largest weighted dot
product of the piece's shares and the shares left (``fit="dot"``).  Sequences with
equal residuals are alike, so the search runs over distinct residuals, and only
over those whose tokens alone do not already lose.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import byte_slices, small_batches, texts_of, written
from newsflow.llm.tokenise import encoder

GROUP = 1 << 15  # pieces of a group: a sequence left part-empty for each is a share of some 0.01 %
WEIGHTS = (1.0, 0.002, 0.002)  # tokens decide; documents and attention part what tokens leave equal or nearly so


class Bins:
    """Open sequences of one group, by residual (tokens, documents, cost)."""

    def __init__(self, caps: tuple[int, int, int], weights: tuple[float, float, float] = WEIGHTS, fit: str = "norm"):
        if fit not in ("norm", "dot"):
            raise ValueError(f"unknown fit {fit!r}")
        self.caps, self.weights, self.fit = caps, weights, fit
        self.states: dict[int, dict[tuple[int, int], list[int]]] = {}  # tokens left -> (documents, cost) left -> numbers
        self.tokens: list[int] = []  # the keys of ``states``, rising
        self.made = 0

    def score(self, left: tuple[int, int, int], item: tuple[int, int, int]) -> float:
        """Smaller is better."""
        pairs = zip(self.weights, left, item, self.caps)
        if self.fit == "norm":
            return sum(w * ((r - x) / c) ** 2 for w, r, x, c in pairs)
        return -sum(w * (r / c) * (x / c) for w, r, x, c in pairs)

    def bound(self, tokens: int, length: int) -> float:
        """No open sequence with that many tokens left scores below this."""
        if self.fit == "norm":
            return self.weights[0] * ((tokens - length) / self.caps[0]) ** 2
        return -sum(self.weights)

    def best(self, item: tuple[int, int, int]) -> tuple[int, int, int] | None:
        found, low = None, float("inf")
        length, _, cost = item
        for tokens in self.tokens[bisect_left(self.tokens, length):]:
            if self.bound(tokens, length) >= low:
                break  # bounds rise with the tokens left
            for docs, room in self.states[tokens]:
                if docs and room >= cost:
                    value = self.score((tokens, docs, room), item)
                    if value < low or value == low and (tokens, docs, room) < found:
                        found, low = (tokens, docs, room), value
        return found

    def put(self, left: tuple[int, int, int], number: int) -> None:
        tokens, docs, cost = left
        if not tokens or not docs or not cost:
            return  # nothing fits any more
        if tokens not in self.states:
            self.states[tokens] = {}
            insort(self.tokens, tokens)
        self.states[tokens].setdefault((docs, cost), []).append(number)

    def take(self, left: tuple[int, int, int]) -> int:
        tokens, rest = left[0], left[1:]
        numbers = self.states[tokens][rest]
        number = numbers.pop()
        if not numbers:
            del self.states[tokens][rest]
            if not self.states[tokens]:
                del self.states[tokens]
                self.tokens.pop(bisect_left(self.tokens, tokens))
        return number

    def place(self, length: int) -> tuple[int, int]:
        """(number of the sequence, tokens before the piece there)."""
        item = length, 1, length * length
        left = self.best(item)
        if left is None:
            left, number = self.caps, self.made
            self.made += 1
        else:
            number = self.take(left)
        self.put(tuple(r - x for r, x in zip(left, item)), number)
        return number, self.caps[0] - left[0]


def cut(total: int, length: int) -> Iterator[tuple[int, int, int]]:
    """(piece, start, size): full pieces but for the first, which takes what is over."""
    start, piece = 0, 0
    while start < total:
        size = (total - start) % length or length
        yield piece, start, size
        start, piece = start + size, piece + 1


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", sequence_id long, offset long"
KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
NAMES = [c.split()[0] for c in PLACED.split(", ")]


def pack_vectors(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 0, max_docs: int | None = None,
                 max_cost: int | None = None, weights: tuple[float, float, float] = WEIGHTS, fit: str = "norm",
                 group: int = GROUP) -> DataFrame:
    """One row per piece with its sequence and place (see ``PLACED``).

    ``max_docs`` and ``max_cost`` bound the pieces of a sequence and their summed
    squared lengths; unset, they are ``length`` and ``length ** 2``, which no
    sequence can exceed, so that they cost no sequence and only choose among fits.
    A smaller ``max_cost`` is refused: a full piece would have no place.

    A null or empty text is its end id alone; a null doc_id stays null; a repeated
    row is packed once per row; an empty table gives no pieces; columns beside
    doc_id and text are not read.
    """
    caps = (length, max_docs or length, max_cost or length * length)
    if caps[1] < 1 or caps[2] < length * length:
        raise ValueError("a full piece would fit no sequence")
    spark = docs.sparkSession
    small_batches(spark)

    def encode(batches):
        enc, end = encoder(tokenizer, True), np.array([end_id], "<u2").tobytes()
        for b in batches:
            rows = []
            for doc_id, text in zip(b["doc_id"].to_pylist(), byte_slices(b["text"])):
                ids = np.frombuffer(enc.encode(str(text, "utf-8")) + end, "<u2").astype("<u4")
                rows += [(doc_id, piece, start, size, zlib.crc32(ids[start:start + size].tobytes()))
                         for piece, start, size in cut(len(ids), length)]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), KINDS)] if rows
                                  else [pa.array([], k) for k in KINDS[:5]], names=NAMES[:5])

    pieces = written(texts_of(docs).mapInArrow(encode, PIECES), "pieces")
    full = pieces.where(F.col("length") == length).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.where(F.col("length") < length).withColumn("row", F.monotonically_increasing_id())
    groups = max(1, -(-pieces.where(F.col("length") < length).count() // group))
    dealt = rest.withColumn("pack", F.pmod(F.xxhash64("row"), F.lit(groups)))
    ordered = dealt.repartition(groups, "pack").sortWithinPartitions("pack", F.desc("length"), "row").drop("row")

    def pack(batches):
        bins, current = None, None
        for b in batches:
            numbers, offsets = [], []
            for own, size in zip(b["pack"].to_pylist(), b["length"].to_pylist()):
                if own != current:
                    bins, current = Bins(caps, weights, fit), own
                number, offset = bins.place(size)
                numbers.append((own << 32) + number)
                offsets.append(offset)
            yield pa.record_batch([*(b[c] for c in NAMES[:5]), pa.array(numbers, pa.int64()),
                                   pa.array(offsets, pa.int64())], names=NAMES)

    return ordered.mapInArrow(pack, PLACED).unionByName(full)
