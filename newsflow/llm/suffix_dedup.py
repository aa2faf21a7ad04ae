"""Removal of repeated byte strings with a run-length compressed BWT index.

Every string of ``LENGTH`` bytes has one anchor: the leftmost smallest hash of
its ``SEED``-byte strings.  Neighbouring strings share an anchor, and the bytes
they cover are its context.  Equal strings have equal anchors, so all that can
match meets under the anchor's hash:

* contexts that are equal as a whole are one; every occurrence but the first is
  removed (found within each task first, so a frequent passage leaves a task once);
* where one anchor has several contexts, their text is indexed: a run-compressed
  Burrows-Wheeler transform of the contexts in order of their first
  ``LENGTH`` bytes, with a text position sampled at each run's end.  The contexts
  are streamed through it from the right; the statistic of each position is the
  range of the transform its ``LENGTH`` bytes match and a matching position.
  Equal ranges are equal strings; all but the earliest are removed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.llm.common import byte_slices, mix64, shuffle_width, texts_of, written

LENGTH, SEED = 100, 32
WINDOWS = LENGTH - SEED + 1
CHUNK_BYTES = 1 << 20
HELD_ANCHORS = 1 << 20
GROUP_BYTES = 1 << 17
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64))
_ODD = mix64(np.arange(1000, 1010, dtype=np.uint64)) | np.uint64(1)
ROWS = "kind int, key long, ctx long, doc long, lo long, hi long"
NAMES = ["kind", "key", "ctx", "doc", "lo", "hi"]


def seed_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the SEED bytes at each position, by doubling."""
    h, width, i = _BYTE[data], 1, 0
    while width < SEED:
        h = h[:-width] * _ODD[i] + h[width:]
        h ^= h >> np.uint64(29)
        width, i = 2 * width, i + 1
    return h


def anchor_runs(data: np.ndarray, ends: np.ndarray):
    """(anchor hash, context hash, text number, first, last window start) of the runs of windows with one anchor.

    ``data`` holds texts end to end, ``ends`` their ends; windows stay inside a text and are counted from its start.
    """
    h = seed_hashes(data)
    n = len(data) - LENGTH + 1
    text = np.searchsorted(ends, np.arange(n), "right")
    inside = np.flatnonzero(np.arange(n) + LENGTH <= ends[text])
    value, place, width = h, np.arange(len(h), dtype=np.int32), 1
    while 2 * width <= WINDOWS:
        left = value[:-width] <= value[width:]
        place = np.where(left, place[:-width], place[width:])
        value = np.where(left, value[:-width], value[width:])
        width *= 2
    gap = WINDOWS - width
    a, b = (value[:n], value[gap:gap + n]) if gap else (value[:n], value[:n])
    place = np.where(a <= b, place[:n], place[gap:gap + n])[inside]
    text = text[inside]
    new = np.ones(len(inside), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    lo, hi = inside[first], inside[np.append(first[1:], len(inside)) - 1]
    # the context's hash from running sums of its bytes' powers, scaled to its own start
    power = _powers(len(data) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[data] * power[0][:len(data)])])
    ctx = mix64((sums[hi + LENGTH] - sums[lo]) * power[1][lo] + (hi - lo).astype(np.uint64))
    begin = np.concatenate([[0], ends])[text[first]]
    return mix64(h[place[first]]).view(np.int64), ctx.view(np.int64), text[first], lo - begin, hi - begin


_POWERS: list = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list:
    """Powers of an odd number and of its inverse modulo 2**64."""
    if len(_POWERS[0]) < n:
        base = 0x9E3779B97F4A7C15
        for i, b in enumerate((base, pow(base, -1, 1 << 64))):
            row = np.full(2 * n, np.uint64(b))
            row[0] = 1
            _POWERS[i] = np.cumprod(row)
    return _POWERS


def rows(kind: int, key, ctx, doc, lo, hi) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.full(len(doc), kind, np.int32)), *(pa.array(np.asarray(x, np.int64))
                                                                          for x in (key, ctx, doc, lo, hi))], names=NAMES)


def split_first(key, ctx, doc, lo, hi):
    """Rows sorted by (key, ctx, doc, lo): which are the first of their context, and which repeat it elsewhere."""
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (ctx[1:] != ctx[:-1])
    first = np.flatnonzero(new)[np.cumsum(new) - 1] if len(key) else np.empty(0, np.int64)
    again = (doc != doc[first]) | (lo != lo[first])
    return new, again


def text_groups(batch: pa.RecordBatch):
    """The texts of a batch that have a window, some ``GROUP_BYTES`` together."""
    docs, texts, size = [], [], 0
    for doc, text in zip(batch["doc"].to_pylist(), byte_slices(batch["text"])):
        if len(text) >= LENGTH:
            docs.append(doc)
            texts.append(text)
            size += len(text)
            if size >= GROUP_BYTES:
                yield docs, texts
                docs, texts, size = [], [], 0
    if docs:
        yield docs, texts


def local_anchors(batches):
    """Anchors of each text (kind 0), one per context and task; the task's other occurrences are marks (kind 1)."""
    held: list[tuple] = []
    count = 0

    def flush():
        key, ctx, lo, hi, doc = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((lo, doc, ctx, key))
        key, ctx, doc, lo, hi = (x[order] for x in (key, ctx, doc, lo, hi))
        new, again = split_first(key, ctx, doc, lo, hi)
        yield rows(0, *(x[new] for x in (key, ctx, doc, lo, hi)))
        yield rows(1, mix64(doc[again]).view(np.int64), lo[again], *(x[again] for x in (doc, lo, hi)))
    for b in batches:
        for docs, texts in text_groups(b):
            data = np.frombuffer(b"".join(texts), np.uint8)
            key, ctx, text, lo, hi = anchor_runs(data, np.cumsum([len(t) for t in texts]))
            held.append((key, ctx, lo, hi, np.array(docs, np.int64)[text]))
            count += len(key)
            if count >= HELD_ANCHORS:
                yield from flush()
                held, count = [], 0
    if held:
        yield from flush()


def meet_anchors(batches):
    """Rows by (kind, key, ctx, doc, lo): marks of repeated contexts (1) and firsts of anchors with several contexts (0)."""
    tail = None
    for b in batches:
        cols = [b[c].to_numpy() for c in NAMES]
        marks = cols[0] == 1
        if marks.any():
            yield rows(1, *(c[marks] for c in cols[1:]))
        key, ctx, doc, lo, hi = (c[~marks] for c in cols[1:])
        if not len(key):
            continue
        if tail is not None:  # firsts of the last anchor so far, then its last context once more as the pattern
            key, ctx, doc, lo, hi = (np.concatenate([t, x]) for t, x in zip(tail, (key, ctx, doc, lo, hi)))
        new, again = split_first(key, ctx, doc, lo, hi)
        if again.any():
            yield rows(1, *(x[again] for x in (key, ctx, doc, lo, hi)))
        key, ctx, doc, lo, hi = (x[new] for x in (key, ctx, doc, lo, hi))
        last = key == key[-1]
        tail = tuple(x[last] for x in (key, ctx, doc, lo, hi))
        yield from several(*(x[~last] for x in (key, ctx, doc, lo, hi)))
    if tail is not None:
        yield from several(*tail)


def several(key, ctx, doc, lo, hi):
    edge = np.flatnonzero(np.diff(key, prepend=key[:1] - 1, append=key[-1:] + 1)) if len(key) else key
    sizes = np.diff(edge)
    keep = np.repeat(sizes > 1, sizes)
    if keep.any():
        yield rows(0, *(x[keep] for x in (key, ctx, doc, lo, hi)))


class RunLengthIndex:
    """Run-compressed transform of contexts, ordered by their suffixes' first ``length`` symbols."""

    def __init__(self, contexts: list[bytes], length: int = LENGTH):
        self.length = length
        parts = []
        for c in contexts:
            parts += [np.frombuffer(c, np.uint8).astype(np.int64) + 1, np.zeros(1, np.int64)]
        text = np.concatenate(parts)
        self.text, n = text, len(text)
        wide = np.concatenate([text, np.zeros(length, np.int64)])
        rank = np.zeros(n, np.int64)
        width = min(7, length - 1)
        for k in range(width):
            rank = rank * 257 + wide[k:n + k]
        rank = np.unique(rank, return_inverse=True)[1]

        def pair(r, shift):
            after = np.zeros(n, np.int64)
            after[:n - shift] = r[shift:] + 1
            return r * (n + 2) + after
        while 2 * width < length - 1:
            rank = np.unique(pair(rank, width), return_inverse=True)[1]
            width *= 2
        shorter = pair(rank, length - 1 - width)  # order by all symbols but the last
        order = np.argsort(pair(rank, length - width))
        same = shorter[order]
        self.groups = np.flatnonzero(np.concatenate([[True], same[1:] != same[:-1]]))
        self.group_ends = np.append(self.groups[1:], n)
        before = text[order - 1]
        heads = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
        sizes, symbols = np.diff(np.append(heads, n)), before[heads]
        by = np.lexsort((heads, symbols))  # the runs of each symbol in order
        self.n, self.run_key = n, symbols[by] * (n + 1) + heads[by]
        self.run_head, self.run_size = heads[by], sizes[by]
        self.run_end_at = order[heads + sizes - 1][by]  # sampled text positions
        ahead = np.cumsum(self.run_size) - self.run_size
        first = np.searchsorted(symbols[by], np.arange(258))
        self.ahead = ahead - np.append(ahead, n)[first][symbols[by]]
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=257))])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of the symbol before row ``at``, and the last run of it that starts before."""
        run = np.searchsorted(self.run_key, symbol * (self.n + 1) + at) - 1
        there = (run >= 0) & (self.run_key[run] >= symbol * (self.n + 1))
        inside = np.minimum(at - self.run_head[run], self.run_size[run])
        return np.where(there, self.ahead[run] + inside, 0), run

    def stream(self, contexts: list[bytes]):
        """Per step from the right: (context numbers, window start, range start, range end, matching position).

        Every context must be one of those indexed, or a part of one.
        """
        sizes = np.array([len(c) for c in contexts])
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(contexts), np.uint8).astype(np.int64) + 1
        low, high = np.zeros(len(contexts), np.int64), np.full(len(contexts), self.n)
        where = np.zeros(len(contexts), np.int64)
        lanes = np.arange(len(contexts))
        for step in range(int(sizes.max(initial=0))):
            lanes = lanes[sizes[lanes] > step]
            lo, hi = low[lanes], high[lanes]
            if step >= self.length:  # drop the last symbol: the rows that share all but it
                group = np.searchsorted(self.groups, lo, "right") - 1
                lo, hi = self.groups[group], self.group_ends[group]
            symbol = data[ends[lanes] - 1 - step]
            start, _ = self.rank(symbol, lo)
            stop, run = self.rank(symbol, hi)
            inside = self.run_head[run] + self.run_size[run] >= hi  # the last row of the range goes on itself
            # otherwise the last run of the symbol in the range ends at a sampled position
            where[lanes] = np.where(inside & (hi == high[lanes]) & (step > 0), where[lanes], self.run_end_at[run]) - 1
            low[lanes], high[lanes] = self.smaller[symbol] + start, self.smaller[symbol] + stop
            if step >= self.length - 1:
                yield lanes, sizes[lanes] - 1 - step, low[lanes], high[lanes], where[lanes]


def repeated_windows(contexts: list[bytes], doc: np.ndarray, lo: np.ndarray):
    """(context, window start) of the windows that start earlier in another of the contexts."""
    index = RunLengthIndex(contexts)
    found = []
    for lanes, at, low, high, _ in index.stream(contexts):
        many = high - low > 1
        found.append((lanes[many], at[many], low[many]))
    lane, at, name = (np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 3
    order = np.lexsort((lo[lane] + at, doc[lane], name))
    lane, at, name = lane[order], at[order], name[order]
    later = np.zeros(len(name), bool)
    later[1:] = name[1:] == name[:-1]
    return lane[later], at[later]


def index_contexts(batches):
    """Marks from (key, doc, lo, context) rows by key, indexed some whole anchors at a time."""
    held, size, last = [], 0, None

    def flush():
        doc, lo = (np.array(c, np.int64) for c in zip(*[(h[0], h[1]) for h in held]))
        lane, at = repeated_windows([h[2] for h in held], doc, lo)
        order = np.lexsort((at, lane))
        lane, at = lane[order], at[order]
        new = np.ones(len(at), bool)
        new[1:] = (lane[1:] != lane[:-1]) | (at[1:] != at[:-1] + 1)
        first = np.flatnonzero(new)
        ends = np.append(first[1:] - 1, len(at) - 1) if len(at) else first
        yield pa.record_batch([pa.array(doc[lane[first]]), pa.array(lo[lane[first]] + at[first]),
                               pa.array(lo[lane[first]] + at[ends])], names=["doc", "lo", "hi"])
    for b in batches:
        for key, doc, lo, context in zip(*(b[c].to_pylist() for c in ("key", "doc", "lo", "context"))):
            if held and key != last and size >= CHUNK_BYTES:
                yield from flush()
                held, size = [], 0
            held.append((doc, lo, context))
            size, last = size + len(context), key
    if held:
        yield from flush()


def arrow_limits(spark: SparkSession) -> None:
    """Batches bounded by bytes; rows of anchors are small, texts are not."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def squeezed(docs: DataFrame) -> DataFrame:
    """(doc_id, doc, n_bytes, z): the texts compressed, for shuffles."""
    def squeeze(batches):
        import zstandard
        z = zstandard.ZstdCompressor(level=1)
        for b in batches:
            texts = list(byte_slices(b["text"]))
            yield pa.record_batch([b["doc_id"], b["doc"], pa.array([len(t) for t in texts], pa.int64()),
                                   pa.array([z.compress(t) for t in texts], pa.binary())],
                                  names=["doc_id", "doc", "n_bytes", "z"])
    return docs.mapInArrow(squeeze, "doc_id long, doc long, n_bytes long, z binary")


def repeated_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(marks, base): marks (doc, lo, hi) say that the windows starting at lo..hi repeat an earlier one."""
    spark = docs.sparkSession
    arrow_limits(spark)
    base = texts_of(docs).withColumn("doc", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")))
    found = base.select("doc", "text").mapInArrow(local_anchors, ROWS)
    met = found.repartition(2 * shuffle_width(spark), "key").sortWithinPartitions("kind", "key", "ctx", "doc", "lo")
    met = written(met.mapInArrow(meet_anchors, ROWS), "anchors")
    firsts = met.where("kind = 0").select("key", "doc", "lo", "hi")
    per_doc = firsts.groupBy("doc").agg(F.collect_list(F.struct("key", "lo", "hi")).alias("runs"))

    def cut(batches):
        import zstandard
        grow = zstandard.ZstdDecompressor()
        for b in batches:
            keys, docs_, los, parts = [], [], [], []
            for doc, z, runs in zip(*(b[c].to_pylist() for c in ("doc", "z", "runs"))):
                text = grow.decompress(z) if z else b""
                for r in runs:
                    part = text[r["lo"]:r["hi"] + LENGTH]
                    if len(part) == r["hi"] + LENGTH - r["lo"]:
                        keys.append(r["key"])
                        docs_.append(doc)
                        los.append(r["lo"])
                        parts.append(part)
            yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(docs_, pa.int64()), pa.array(los, pa.int64()),
                                   pa.array(parts, pa.binary())], names=["key", "doc", "lo", "context"])

    contexts = squeezed(base).select("doc", "z").join(per_doc, "doc").mapInArrow(
        cut, "key long, doc long, lo long, context binary")
    contexts = contexts.repartition(2 * shuffle_width(spark), "key").sortWithinPartitions("key", "doc", "lo")
    indexed = contexts.mapInArrow(index_contexts, "doc long, lo long, hi long")
    marks = written(indexed, "marks").union(met.where("kind = 1").select("doc", "lo", "hi"))
    return marks, base


def repeat_digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document.

    A byte goes when a 100-byte string over it also starts earlier (smaller
    doc_id, or earlier in the same text).  A null text is empty; a null doc_id
    comes before all others; rows that repeat a doc_id are one document, share
    its marks and do not repeat each other; an empty table gives no rows;
    columns beside doc_id and text are not read.
    """
    marks, base = repeated_spans(docs)
    # a mark reaches over less than 128 window starts, so start and reach go into one number
    per_doc = marks.groupBy("doc").agg(F.collect_list(F.col("lo") * 128 + F.col("hi") - F.col("lo")).alias("spans"))

    def digest(batches):
        import zstandard
        grow = zstandard.ZstdDecompressor()
        for b in batches:
            out = []
            marks = b["spans"]
            values, places = marks.values.to_numpy(), marks.offsets.to_numpy()
            for z, a, e in zip(b["z"].to_pylist(), places, places[1:]):
                text = grow.decompress(z) if z else b""
                if a == e:
                    out.append((0, 0, hashlib.sha256(text).hexdigest()))
                    continue
                lo = np.minimum(values[a:e] >> 7, len(text))
                hi = np.minimum((values[a:e] >> 7) + (values[a:e] & 127) + LENGTH, len(text))
                order = np.argsort(lo)
                lo, hi = lo[order], np.maximum.accumulate(hi[order])
                opens = np.flatnonzero(np.append(True, lo[1:] > hi[:-1]))
                starts, stops = lo[opens], hi[np.append(opens[1:], len(lo)) - 1]
                digest, done = hashlib.sha256(), 0
                for x, y in zip(starts.tolist(), stops.tolist()):
                    digest.update(text[done:x])
                    done = y
                digest.update(text[done:])
                out.append((int((stops - starts).sum()), int((stops > starts).sum()), digest.hexdigest()))
            removed, spans, sha = zip(*out) if out else ((), (), ())
            yield pa.record_batch([b["doc_id"], b["n_bytes"], pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                                   pa.array(sha, pa.string())],
                                  names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return squeezed(base).join(per_doc, "doc", "left").select("doc_id", "n_bytes", "z", "spans").mapInArrow(
        digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
