"""Token ids of a corpus as canonical length-limited Huffman blocks, and their reader.

Documents are range-sorted by doc_id, encoded, and gathered into blocks of whole
documents.  Code lengths come from the counts of all ids (package-merge, at most
``MAX_BITS`` bits).  A block stands alone: a header, its documents' ids and
lengths, a bit offset for every ``STEP`` ids, and the code bits.  The reader
starts at all bit offsets of a block at once and decodes them side by side by a
table of ``2 ** MAX_BITS`` entries.  Blocks travel in a Parquet file as its only
binary column, so that Spark commits and retries them on any store; a second
small file holds the code length of each id.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsflow.llm.common import byte_slices, shuffle_width, small_batches, texts_of, written
from newsflow.llm.tokenise import encoder
from newsflow.session import ensure_checkpoint_dir

MAX_BITS, STEP, BLOCK_IDS, ID_SPACE = 18, 256, 1 << 18, 1 << 16
MAGIC = 0x4E464831  # "NFH1"
NULL_ID = -(1 << 63)


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Length of each symbol's code, 0 for a symbol that never occurs (package-merge).

    Ties go to the smaller symbol, so equal counts give equal lengths on every run.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError("more symbols than codes of that length")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    n = len(weights)
    merged, levels = np.empty(0, np.int64), []
    for _ in range(limit):
        both = np.concatenate([weights, merged])
        rank = np.argsort(both, kind="stable")
        levels.append(rank)
        both = both[rank]
        pairs = len(both) // 2
        merged = both[:2 * pairs:2] + both[1:2 * pairs:2]
    wanted = 2 * n - 2
    for rank in reversed(levels):
        picked = rank[:wanted]
        leaves = picked[picked < n]
        lengths[order[leaves]] += 1
        wanted = 2 * int((picked >= n).sum())
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, symbol)."""
    codes = np.zeros(len(lengths), np.uint64)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    spans = np.uint64(1) << (np.uint64(MAX_BITS) - lengths[order].astype(np.uint64))
    starts = np.concatenate([[np.uint64(0)], np.cumsum(spans)[:-1]]) if len(order) else spans
    codes[order] = starts >> (np.uint64(MAX_BITS) - lengths[order].astype(np.uint64))
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and length for every window of MAX_BITS bits."""
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    spans = 1 << (MAX_BITS - lengths[order].astype(np.int64))
    symbols = np.zeros(1 << MAX_BITS, np.uint16)
    sizes = np.ones(1 << MAX_BITS, np.uint8)
    total = int(spans.sum())
    symbols[:total] = np.repeat(order.astype(np.uint16), spans)
    sizes[:total] = np.repeat(lengths[order], spans)
    return symbols, sizes


def encode_block(ids: np.ndarray, doc_ids: np.ndarray, sizes: np.ndarray,
                 lengths: np.ndarray, codes: np.ndarray) -> bytes:
    """One block: header, document ids, their token counts, bit offsets, code bits."""
    widths = lengths[ids].astype(np.int64)
    ends = np.cumsum(widths)
    starts = ends - widths
    total = int(ends[-1]) if len(ids) else 0
    words = np.zeros(total // 64 + 2, np.uint64)
    if total:
        word, shift = starts >> 6, (starts & 63).astype(np.uint64)
        left = codes[ids] << (np.uint64(64) - widths.astype(np.uint64))
        firsts = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[firsts]] = np.bitwise_or.reduceat(left >> shift, firsts)
        over = np.flatnonzero((starts & 63) + widths > 64)
        words[word[over] + 1] |= left[over] << (np.uint64(64) - shift[over])
    head = np.array([MAGIC, len(doc_ids), len(ids), total], "<i8")
    return b"".join([head.tobytes(), doc_ids.astype("<i8").tobytes(), sizes.astype("<i8").tobytes(),
                     starts[::STEP].astype("<i8").tobytes(), words.astype(">u8").tobytes()])


def decode_block(block: bytes | memoryview, symbols: np.ndarray, widths: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc_ids, token counts, ids) of a block."""
    magic, n_docs, n_ids, _ = np.frombuffer(block, "<i8", 4)
    if magic != MAGIC:
        raise ValueError("not a block of token ids")
    lanes, at = -(-n_ids // STEP), 32
    doc_ids = np.frombuffer(block, "<i8", n_docs, at)
    sizes = np.frombuffer(block, "<i8", n_docs, at + 8 * n_docs)
    place = np.frombuffer(block, "<i8", lanes, at + 16 * n_docs).copy()
    words = np.frombuffer(block, ">u8", -1, at + 16 * n_docs + 8 * lanes).astype(np.uint64)
    out = np.zeros((lanes, STEP), np.uint16)
    last = 64 * (len(words) - 1) - 1
    for k in range(min(STEP, n_ids)):
        word, shift = place >> 6, (place & 63).astype(np.uint64)
        window = words[word] << shift | words[word + 1] >> np.uint64(1) >> (np.uint64(63) - shift)
        window >>= np.uint64(64 - MAX_BITS)
        out[:, k] = symbols[window]
        place = np.minimum(place + widths[window], last)
    return doc_ids, sizes, out.reshape(-1)[:n_ids]


def gathered(rows: Iterator[tuple], limit: int) -> Iterator[tuple]:
    """Blocks (doc_ids, sizes, ids) of whole documents, closed at ``limit`` ids."""
    docs, parts, held, bucket = [], [], 0, None
    number = 0
    for b, doc_id, ids in rows:
        if docs and (b != bucket or held >= limit):
            yield bucket, number, docs, parts
            docs, parts, held, number = [], [], 0, (number + 1 if b == bucket else 0)
        bucket = b
        docs.append(NULL_ID if doc_id is None else doc_id)
        parts.append(ids)
        held += len(ids) // 2
    if docs:
        yield bucket, number, docs, parts


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int = 1) -> None:
    """Write ``<path>/blocks`` and ``<path>/lengths`` for all documents in doc_id order.

    Null texts are empty documents (their end id alone); null doc_ids come first;
    repeated rows are written each; other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    base = texts_of(docs)
    ranges = 2 * shuffle_width(spark)
    shares = [i / ranges for i in range(1, ranges)] or [0.5]
    bounds = np.array(base.agg(F.percentile_approx("doc_id", shares, 20 * ranges)).first()[0] or [], np.int64)

    def encode(batches):
        enc, end = encoder(tokenizer, False), np.array([end_id], "<u2").tobytes()
        for b in batches:
            place = np.searchsorted(bounds, np.array(b["doc_id"].fill_null(NULL_ID)), "left")
            ids = [enc.encode(str(t, "utf-8")) + end for t in byte_slices(b["text"])]
            yield pa.record_batch([place.astype(np.int64), b["doc_id"], pa.array(ids, pa.binary())],
                                  names=["bucket", "doc_id", "ids"])

    def block_rows(batches):
        """Blocks, and after them one row (bucket null) with the counts of all ids of the task."""
        names = ["bucket", "number", "n_ids", "doc_ids", "sizes", "ids"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        total = np.zeros(ID_SPACE, np.int64)
        rows = (row for b in batches for row in zip(*(b[c].to_pylist() for c in ("bucket", "doc_id", "ids"))))
        for bucket, number, own, parts in gathered(rows, BLOCK_IDS):
            sizes, ids = [len(p) // 2 for p in parts], b"".join(parts)
            total += np.bincount(np.frombuffer(ids, "<u2"), minlength=ID_SPACE)
            row = bucket, number, len(ids) // 2, own, sizes, ids
            yield pa.record_batch([pa.array([x], k) for x, k in zip(row, kinds)], names=names)
        row = None, None, None, None, None, total.astype("<i8").tobytes()
        yield pa.record_batch([pa.array([x], k) for x, k in zip(row, kinds)], names=names)

    coded = base.mapInArrow(encode, "bucket long, doc_id long, ids binary")
    ordered = coded.repartition(ranges, "bucket").sortWithinPartitions("bucket", "doc_id", "ids")
    gathered_rows = written(ordered.mapInArrow(
        block_rows, "bucket long, number long, n_ids long, doc_ids array<long>, sizes array<long>, ids binary"), "ids")
    raw = gathered_rows.where("bucket is not null")

    def count(batches):
        total = np.zeros(ID_SPACE, np.int64)
        for b in batches:
            for counts in byte_slices(b["ids"]):
                total += np.frombuffer(counts, "<i8")
        seen = np.flatnonzero(total)
        yield pa.record_batch([seen.astype(np.int64), total[seen]], names=["id", "n"])

    counts = gathered_rows.where("bucket is null").select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    table = np.zeros(ID_SPACE, np.int64)  # at most 65,536 rows, whatever the corpus
    for r in counts.collect():
        table[r["id"]] = r["n"]
    lengths = code_lengths(table)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)], "id int, bits int"
                          ).coalesce(1).write.parquet(f"{path}/lengths")

    # ids before each block: sums per range (one row a range reach the driver), running sums inside a range
    before, offset = 0, []
    for r in raw.groupBy("bucket").agg(F.sum("n_ids").alias("n")).orderBy("bucket").collect():
        offset.append((r["bucket"], before))
        before += r["n"]
    running = F.sum("n_ids").over(Window.partitionBy("bucket").orderBy("number")) - F.col("n_ids")
    at = raw.select("bucket", "number", running.alias("inside")).join(
        F.broadcast(spark.createDataFrame(offset, "bucket long, base long")), "bucket")
    starts = at.select("bucket", "number", (F.col("base") + F.col("inside")).alias("first_id"))

    def squeeze_blocks(batches):
        codes = canonical_codes(lengths)
        for b in batches:
            for bucket, number, own, sizes, ids in zip(*(b[c].to_pylist() for c in
                                                         ("bucket", "number", "doc_ids", "sizes", "ids"))):
                block = encode_block(np.frombuffer(ids, "<u2"), np.array(own, np.int64), np.array(sizes, np.int64), lengths, codes)
                yield pa.record_batch([pa.array([bucket]), pa.array([number]), pa.array([block], pa.binary())],
                                      names=["bucket", "number", "block"])

    raw.drop("n_ids").mapInArrow(squeeze_blocks, "bucket long, number long, block binary") \
        .write.option("compression", "none").parquet(f"{path}/blocks")
    starts.write.parquet(f"{path}/starts")


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Rows (bucket, number, before, doc_id, n_tokens, ids_crc32, ids) decoded from the files.

    ``ids`` are little-endian uint32 bytes, null where ``with_ids`` is false;
    ``ids_crc32`` is the checksum of those bytes.
    """
    small_batches(spark)
    lengths = np.zeros(ID_SPACE, np.uint8)
    for r in spark.read.parquet(f"{path}/lengths").collect():
        lengths[r["id"]] = r["bits"]

    def decode(batches):
        symbols, widths = decode_table(lengths)
        widths = widths.astype(np.int64)
        for b in batches:
            for bucket, number, block in zip(*(b[c].to_pylist() for c in ("bucket", "number", "block"))):
                own, sizes, ids = decode_block(block, symbols, widths)
                ends = np.cumsum(sizes)
                wide = ids.astype("<u4")
                n = len(own)
                cuts = [(4 * int(e - s), 4 * int(e)) for e, s in zip(ends, sizes)]
                raw = memoryview(wide.tobytes())
                yield pa.record_batch(
                    [pa.array(np.full(n, bucket)), pa.array(np.full(n, number)), pa.array(ends - sizes),
                     pa.array(own, mask=own == NULL_ID), pa.array(sizes),
                     pa.array([zlib.crc32(raw[a:e]) for a, e in cuts], pa.int64()),
                     pa.array([raw[a:e].tobytes() if with_ids else None for a, e in cuts], pa.binary())],
                    names=["bucket", "number", "before", "doc_id", "n_tokens", "ids_crc32", "ids"])

    return spark.read.parquet(f"{path}/blocks").mapInArrow(
        decode, "bucket long, number long, before long, doc_id long, n_tokens long, ids_crc32 long, ids binary")


def token_digest(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    ids = read_token_files(spark, path, with_ids=False)
    starts = spark.read.parquet(f"{path}/starts")
    return ids.drop("ids").join(starts, ["bucket", "number"]).select(
        "doc_id", (F.col("first_id") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def scratch_path(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/newsflow-llm/tokens-{uuid.uuid4().hex}"
