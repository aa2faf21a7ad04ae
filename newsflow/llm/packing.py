"""Packing of documents into fixed-length sequences along a space-filling curve.

Each document gets a hashed vector (counts of byte pairs in 4,096 cells),
projected by fixed random signs to ``DIMS`` dimensions; the ranks of the
projections on a Hilbert curve are its key.  Key ranges part the corpus, each
range is sorted by key, and its documents are laid end to end along the curve
and cut every ``length`` ids, so neighbours share sequences and nothing is
padded.  What is left at the end of a range is cut into sequences whose lengths
are powers of two, which are not padded either.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import byte_slices, mix64, shuffle_width, small_batches, texts_of
from newsflow.llm.tokenise import encoder

DIMS, BITS, CELLS = 4, 8, 4096
TIE_BITS = 24


def projection() -> np.ndarray:
    """Fixed signs, CELLS x DIMS."""
    bits = mix64(np.arange(CELLS * DIMS, dtype=np.uint64) + np.uint64(1)) >> np.uint64(63)
    return (bits.astype(np.float64) * 2 - 1).reshape(CELLS, DIMS)


def hashed_vector(text: memoryview) -> np.ndarray:
    """Counts of hashed byte pairs at every position."""
    counts = np.zeros(CELLS)
    for start in (0, 1):
        n = (len(text) - start) // 2
        if n > 0:
            pairs = np.frombuffer(text, "<u2", n, start)
            counts += np.bincount((pairs * np.uint16(40503)) >> np.uint16(4), minlength=CELLS)
    return counts


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position along the Hilbert curve of integer points, one a row (Skilling's transform)."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(high, q - 1, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[dims - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[i] >> bit & 1)
    return key


def curve_keys(texts: pa.Array, ids: pa.Array, signs: np.ndarray) -> np.ndarray:
    """Hilbert key of each text, low bits from the id so that copies part evenly."""
    vectors = np.array([hashed_vector(t) for t in byte_slices(texts)]).reshape(-1, CELLS)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    points = np.tanh(1.5 * (vectors / np.maximum(norms, 1) @ signs))
    cells = np.minimum((points + 1) * (1 << BITS - 1), (1 << BITS) - 1)
    tie = mix64(np.array(ids.fill_null(-1)).astype(np.uint64)) >> np.uint64(64 - TIE_BITS)
    return hilbert_keys(cells) << TIE_BITS | tie.astype(np.int64)


def with_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    signs = projection()
    for b in batches:
        yield pa.record_batch([curve_keys(b["text"], b["doc_id"], signs)], names=["curve"])


def piece_rows(rows: Iterator[tuple], length: int) -> Iterator[tuple]:
    """Pieces of (bucket, doc_id, ids) rows in curve order."""
    bucket, number, filled, waiting = None, 0, 0, []

    def piece(doc_id, ids, start, size, total, at):
        part = ids[start:start + size].astype("<u4").tobytes()
        return doc_id, start, size, zlib.crc32(part), total, (bucket << 40) + number, at

    def close():
        """The unfinished sequence of a range, as sequences of power-of-two lengths."""
        nonlocal number, filled, waiting
        rest, room, at = filled, 0, 0
        for doc_id, ids, start, size, total in waiting:
            while size:
                if not room:
                    room, at = 1 << rest.bit_length() - 1, 0
                    rest -= room
                take = min(size, room)
                yield piece(doc_id, ids, start, take, total, at)
                start, size, room, at = start + take, size - take, room - take, at + take
                if not room:
                    number += 1
        waiting, filled = [], 0

    for row_bucket, doc_id, ids in rows:
        if row_bucket != bucket:
            yield from close()
            bucket, number = row_bucket, 0
        start, total = 0, len(ids)
        while start < total:
            take = min(total - start, length - filled)
            waiting.append((doc_id, ids, start, take, total))
            start, filled = start + take, filled + take
            if filled == length:
                at = 0
                for doc, own, begin, size, n in waiting:
                    yield piece(doc, own, begin, size, n, at)
                    at += size
                number, filled, waiting = number + 1, 0, []
    yield from close()


PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 1,
                   ranges: int | None = None) -> DataFrame:
    """Pieces of the packed sequences: one row per piece of a document (see ``PIECES``).

    A null text is an empty one (its end id alone is packed); a null doc_id
    stays null; a repeated row is packed once per row; an empty table gives no
    pieces.  ``sequence_id`` is the range number and the sequence's number in it.
    Columns beside doc_id and text are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    base = texts_of(docs)
    ranges = ranges or 4 * shuffle_width(spark)
    shares = [i / ranges for i in range(1, ranges)]
    found = base.mapInArrow(with_key, "curve long").agg(
        F.percentile_approx("curve", shares or [0.5], 20 * ranges).alias("b")).first()["b"]
    bounds = np.array(found if found and shares else [], dtype=np.int64)

    def encode(batches):
        import zstandard
        enc, signs, squeeze = encoder(tokenizer, True), projection(), zstandard.ZstdCompressor(level=1)
        end = np.array([end_id], "<u2").tobytes()
        for b in batches:
            keys = curve_keys(b["text"], b["doc_id"], signs)
            ids = [squeeze.compress(enc.encode(str(t, "utf-8")) + end) for t in byte_slices(b["text"])]
            yield pa.record_batch([np.searchsorted(bounds, keys, "right").astype(np.int64), keys, b["doc_id"],
                                   pa.array(ids, pa.binary())], names=["bucket", "curve", "doc_id", "ids"])

    def pack(batches):
        import zstandard
        grow = zstandard.ZstdDecompressor()
        rows = ((bucket, doc_id, np.frombuffer(grow.decompress(ids), "<u2"))
                for b in batches
                for bucket, doc_id, ids in zip(*(b[c].to_pylist() for c in ("bucket", "doc_id", "ids"))))
        pieces: list[tuple] = []

        def out():
            kinds = (pa.int64(),) * 7
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*pieces), kinds)],
                                   names=[c.split()[0] for c in PIECES.split(", ")])
        for p in piece_rows(rows, length):
            pieces.append(p)
            if len(pieces) == 4096:
                yield out()
                pieces = []
        if pieces:
            yield out()

    coded = base.mapInArrow(encode, "bucket long, curve long, doc_id long, ids binary")
    ordered = coded.repartition(ranges // 2 or 1, "bucket").sortWithinPartitions("bucket", "curve", "doc_id", "ids")
    return ordered.mapInArrow(pack, PIECES)
