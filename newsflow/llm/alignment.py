"""Alignment of two tokenizers over a corpus, by external spill counting.

Side A is a byte-level BPE over a space and the text, side B a piece BPE that adds
that space itself.  Where tokens of both sides end at one byte the text is cut
into groups; an A and a B token whose bytes overlap are linked.  The count of an
id pair is the number of its links in the whole corpus.

1. Each task encodes documents into *runs* of about ``RUN_LINKS`` links.  A run
   keeps, sorted and zstd-compressed, its (pair, document, times) records, and
   its distinct pairs with their sums, radix-partitioned by the B id into spill
   chunks.  A pair occurs once a run there, however frequent it is.
2. One task a radix partition merges the spill chunks of all runs by a heap over
   their next keys, adding up each pair.  Keys are B-major, so each B id's pairs
   pass together and give its largest count.
3. The counts go back to each run's chunks, in the chunk's order, and from there
   to the run's records, which add up to the documents.  Records never leave their
   run, so no pair, frequent or not, is gathered anywhere.

Texts are encoded whole, side A by units that it parts anyway (``tokenise.py``).
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import byte_slices, mix64, shuffle_width, small_batches, texts_of, written
from newsflow.llm.tokenise import UnitEncoder, byte_letters

RUN_LINKS = 2_000_000  # links gathered in a task before they are spilled as a run
FAN_IN = 64            # streams one merge reads side by side
CHUNK = 1 << 14        # entries of a compressed frame
ID_SPACE = 1 << 16


def token_bytes_a(path: str) -> dict[int, bytes]:
    from tokenizers import Tokenizer
    back = {letter: byte for byte, letter in byte_letters().items()}
    vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=False)
    return {i: bytes(back[c] for c in token) for token, i in vocabulary.items()}


def token_bytes_b(model) -> dict[int, bytes]:
    return {i: bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i)
            else model.id_to_piece(i).replace("▁", " ").encode() for i in range(model.get_piece_size())}


class Aligner:
    """Encodes and aligns texts; one per Python worker and pair of vocabularies."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        self.side_a = UnitEncoder(path_a, True)
        self.side_a.tokenizer.encode_special_tokens = True  # their strings in a text are plain text
        self.side_b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        if self.side_b.get_piece_size() > ID_SPACE:
            raise ValueError("ids do not fit 16 bits")
        self.bytes_a, self.bytes_b = token_bytes_a(path_a), token_bytes_b(self.side_b)
        self.size_a, self.size_b = (np.array([len(t.get(i, b"")) for i in range(ID_SPACE)]) for t in (self.bytes_a, self.bytes_b))
        #: an id in decimal and the mark that follows it, by ``mark * ID_SPACE + id``
        self.words = [f"{i}{mark}" for mark in ",|;" for i in range(ID_SPACE)]

    def tokens_a(self, text: str) -> np.ndarray:
        return np.frombuffer(self.side_a.encode_after_space(text), "<u2").astype(np.int64)

    def reproduces(self, data: bytes, ids_a: np.ndarray, ids_b: np.ndarray) -> bool:
        """Whether the tokens of both sides, joined, are the text's bytes."""
        return all(b"".join(map(table.__getitem__, ids.tolist())) == data
                   for table, ids in ((self.bytes_a, ids_a), (self.bytes_b, ids_b)))

    def align(self, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[np.ndarray, int, str]:
        """(links as B id << 16 | A id, number of groups, the groups) of token lists over the same bytes.

        Between two neighbouring ends of either side lies one A and one B token, a link;
        no two such stretches have the same tokens, as one of them ends in between.
        """
        ends_a, ends_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        total = int(ends_a[-1])
        is_a, is_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        is_a[ends_a], is_b[ends_b] = True, True
        stops = np.flatnonzero(is_a | is_b)
        own_a, own_b = is_a[stops], is_b[stops]
        links = ids_b[np.cumsum(own_b) - own_b] << 16 | ids_a[np.cumsum(own_a) - own_a]
        both = own_a & own_b
        # tokens in group order, A before B: an A token follows the B tokens of the groups before its own
        group = np.cumsum(both) - both
        group_a, group_b = group[own_a], group[own_b]
        n_groups = int(both.sum())
        until_a, until_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
        sum_a, sum_b = np.cumsum(until_a), np.cumsum(until_b)
        place_a = np.arange(len(ids_a)) + (sum_b - until_b)[group_a]
        place_b = np.arange(len(ids_b)) + sum_a[group_b]
        marked = np.empty(len(ids_a) + len(ids_b), np.int64)
        marked[place_a], marked[place_b] = ids_a, ids_b
        marked[place_a[sum_a - 1]] += ID_SPACE
        marked[place_b[sum_b - 1]] += 2 * ID_SPACE
        return links, n_groups, "".join(map(self.words.__getitem__, marked.tolist()))[:-1]

    def texts(self, texts: list[str]) -> Iterator[tuple[int, int, int, np.ndarray, str]]:
        """(A tokens, B tokens, groups, links, groups hash) of each text."""
        none = 0, 0, 0, np.empty(0, np.int64), ""
        for text, ids_b in zip(texts, self.side_b.encode(texts, num_threads=1) if texts else []):
            if not text:
                yield none
                continue
            ids_a, ids_b = self.tokens_a(text), np.array(ids_b, np.int64)
            if not self.reproduces((" " + text).encode(), ids_a, ids_b):
                yield none
                continue
            links, n_groups, groups = self.align(ids_a, ids_b)
            yield len(ids_a), len(ids_b), n_groups, links, hashlib.sha256(groups.encode()).hexdigest()


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    key = (path_a, path_b)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(path_a, path_b)
    return _ALIGNERS[key]


# --------------------------------------------------------------------- runs

def packed(*columns: np.ndarray) -> bytes:
    """Columns of one length as zstd frames of at most ``CHUNK`` entries, each after its size."""
    import zstandard
    squeeze, out = zstandard.ZstdCompressor(level=1), []
    for at in range(0, len(columns[0]), CHUNK):
        frame = squeeze.compress(b"".join(np.ascontiguousarray(c[at:at + CHUNK]).tobytes() for c in columns))
        out += [len(frame).to_bytes(4, "little"), frame]
    return b"".join(out)


def frames(blob: bytes, *kinds: str) -> Iterator[list[np.ndarray]]:
    """The frames of ``packed``, one at a time."""
    import zstandard
    grow, at, width = zstandard.ZstdDecompressor(), 0, sum(np.dtype(k).itemsize for k in kinds)
    while at < len(blob):
        size = int.from_bytes(blob[at:at + 4], "little")
        raw = grow.decompress(blob[at + 4:at + 4 + size])
        at += 4 + size
        n, place, columns = len(raw) // width, 0, []
        for k in kinds:
            columns.append(np.frombuffer(raw, k, n, place))
            place += n * np.dtype(k).itemsize
        yield columns


def unpacked(blob: bytes, *kinds: str) -> list[np.ndarray]:
    parts = list(frames(blob, *kinds))
    return [np.concatenate([p[i] for p in parts]) if parts else np.empty(0, k) for i, k in enumerate(kinds)]


def radix(keys: np.ndarray, parts: int) -> np.ndarray:
    """Radix partition of each pair by its B id."""
    return (mix64(keys.astype(np.uint64) >> np.uint64(16)) % np.uint64(parts)).astype(np.int64)


DOCS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
RUN = f"run long, part int, data binary, docs array<struct<{', '.join(c.replace(' ', ':') for c in DOCS.split(', '))}>>"


def run_type() -> pa.Schema:
    doc = pa.struct([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in DOCS.split(", ")])
    return pa.schema([("run", pa.int64()), ("part", pa.int32()), ("data", pa.binary()), ("docs", pa.list_(doc))])


def spilled(run: int, docs: list[dict], links: list[np.ndarray], parts: int) -> Iterator[pa.RecordBatch]:
    """A run's rows: its records and documents (part null), then its pairs by radix partition."""
    owner = np.repeat(np.arange(len(links), dtype=np.uint64), [len(x) for x in links])
    keys = np.concatenate(links).astype(np.uint64) if links else np.empty(0, np.uint64)
    both, times = np.unique(keys << np.uint64(32) | owner, return_counts=True)  # pairs in order, documents in each
    pairs, first = np.unique(both >> np.uint64(32), return_index=True)
    sums = np.add.reduceat(times, first) if len(pairs) else np.empty(0, np.int64)
    place = np.repeat(np.arange(len(pairs)), np.diff(np.append(first, len(both))))
    records = packed(place.astype("<u4"), (both & np.uint64(0xFFFFFFFF)).astype("<u4"), times.astype("<u4"))
    rows = [(run, None, records, docs)]
    bucket = radix(pairs, parts)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(edges)):
        own = order[edges[p]:edges[p + 1]]
        rows.append((run, int(p), packed(pairs[own].astype("<u4"), sums[own].astype("<u8")), None))
    for row in rows:
        yield pa.record_batch([pa.array([x], f.type) for x, f in zip(row, run_type())], schema=run_type())


# -------------------------------------------------------------------- merge

def added(keys: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, rising, and the total of each."""
    order = np.argsort(keys, kind="stable")
    keys, sums = keys[order], sums[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(sums, first) if len(keys) else sums


def merged(streams: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """k-way merge of sorted (key, sum) streams: rising blocks of distinct keys with their totals.

    The heap holds the last key of the frame that each stream has open; up to the
    smallest of them every stream's entries are in its open frame.
    """
    sources = [frames(s, "<u4", "<u8") for s in streams]
    opened, heap = {}, []

    def advance(k):
        entry = next(sources[k], None)
        if entry is None:
            opened.pop(k, None)
            return
        opened[k] = [entry[0].astype(np.int64), entry[1].astype(np.int64)]
        heapq.heappush(heap, (int(entry[0][-1]), k))

    for k in range(len(sources)):
        advance(k)
    while heap:
        limit = heap[0][0]
        keys, sums = [], []
        for k, (own, n) in opened.items():
            cut = int(np.searchsorted(own, limit, "right"))
            if cut:
                keys.append(own[:cut])
                sums.append(n[:cut])
                opened[k] = [own[cut:], n[cut:]]
        while heap and heap[0][0] == limit:
            advance(heapq.heappop(heap)[1])
        yield added(np.concatenate(keys), np.concatenate(sums))


class Merger:
    """Streams of one radix partition, merged ``FAN_IN`` at a time so that few are open and all are counted."""

    def __init__(self, fan_in: int = FAN_IN):
        self.fan_in, self.levels = fan_in, [[]]

    def add(self, stream: bytes, level: int = 0) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(stream)
        if len(self.levels[level]) == self.fan_in:
            full, self.levels[level] = self.levels[level], []
            self.add(b"".join(packed(k.astype("<u4"), n.astype("<u8")) for k, n in merged(full)), level + 1)

    def blocks(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        return merged([s for level in self.levels for s in level])


def with_best(blocks: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of whole B ids: (keys, counts, whether the count is its B id's largest)."""
    held_k, held_n = np.empty(0, np.int64), np.empty(0, np.int64)

    def close(keys, counts):
        side = keys >> 16
        first = np.flatnonzero(np.diff(side, prepend=-1))
        top = np.maximum.reduceat(counts, first)
        return keys, counts, counts == np.repeat(top, np.diff(np.append(first, len(keys))))

    for keys, counts in blocks:
        keys, counts = np.concatenate([held_k, keys]), np.concatenate([held_n, counts])
        cut = int(np.searchsorted(keys >> 16, keys[-1] >> 16))  # the last B id may go on in the next block
        if cut:
            yield close(keys[:cut], counts[:cut])
        held_k, held_n = keys[cut:], counts[cut:]
    if len(held_k):
        yield close(held_k, held_n)


def grouped(batches: Iterator[pa.RecordBatch], key: str, names: list[str]) -> Iterator[tuple]:
    """(key, rows of that key in order, as an iterator) of sorted batches; rows are read as they come."""
    from itertools import groupby
    rows = (row for b in batches for row in zip(*(b[c].to_pylist() for c in [key, *names])))
    return groupby(rows, key=lambda r: r[0])


ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string")


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, run_links: int = RUN_LINKS,
                     parts: int | None = None) -> DataFrame:
    """One row per document (see ``ALIGNED``).

    ``n_best`` counts the links whose pair has its B id's largest corpus-wide
    count, ties included; ``count_sum`` adds the pair counts over the links.
    A text that is null, empty or not reproduced byte by byte by both sides has no
    tokens: zeros and an empty ``groups_sha256``.  Rows that repeat a doc_id are
    documents each and count each; a null doc_id stays null; an empty table gives
    no rows; columns beside doc_id and text are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    parts = parts or max(32, shuffle_width(spark))

    def encode(batches):
        own, number = aligner(path_a, path_b), 0
        base = TaskContext.get().partitionId() << 32
        rows, links, held = [], [], 0
        for b in batches:
            texts = own.texts([str(t, "utf-8") for t in byte_slices(b["text"])])
            for doc_id, (n_a, n_b, n_groups, found, groups) in zip(b["doc_id"].to_pylist(), texts):
                rows.append({"doc_id": doc_id, "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": len(found),
                             "groups_sha256": groups})
                links.append(found.astype("<u4"))
                held += len(found) + 64
                if held >= run_links:
                    yield from spilled(base + number, rows, links, parts)
                    rows, links, held, number = [], [], 0, number + 1
        if rows:
            yield from spilled(base + number, rows, links, parts)

    runs = written(texts_of(docs).mapInArrow(encode, RUN), "runs")
    spills = runs.where("part is not null").select("part", "run", "data")

    def count(batches):
        for part, rows in grouped(batches, "part", ["data"]):
            merger = Merger()
            for _, data in rows:
                merger.add(data)
            for keys, counts, best in with_best(merger.blocks()):
                blob = packed(keys.astype("<u4"), counts.astype("<u8"), best)
                yield pa.record_batch([pa.array([part], pa.int32()), pa.array([int(keys[0])], pa.int64()),
                                       pa.array([blob], pa.binary())], names=["part", "first", "data"])

    counts = written(spills.repartition(parts, "part").sortWithinPartitions("part", "run")
                     .mapInArrow(count, "part int, first long, data binary"), "counts")

    def send_back(batches):
        for part, rows in grouped(batches, "part", ["run", "data"]):
            table, ready = [], None
            for _, run, data in rows:
                if run is None:
                    table.append(unpacked(data, "<u4", "<u8", "?"))
                    continue
                if ready is None:  # counts come first; they are the distinct pairs of some B ids
                    ready = [np.concatenate([t[i] for t in table]) for i in range(3)]
                keys, _ = unpacked(data, "<u4", "<u8")
                at = np.searchsorted(ready[0], keys)
                yield pa.record_batch([pa.array([run]), pa.array([part], pa.int32()),
                                       pa.array([packed(keys, ready[1][at], ready[2][at])], pa.binary())],
                                      names=["run", "part", "data"])

    totals = counts.select("part", F.lit(None).cast("long").alias("run"), "first", "data")
    asked = spills.select("part", "run", F.lit(None).cast("long").alias("first"), "data")
    returned = totals.unionByName(asked).repartition(parts, "part").sortWithinPartitions(
        "part", F.asc_nulls_first("run"), "first").select("part", "run", "data").mapInArrow(
        send_back, "run long, part int, data binary")

    def settle(batches):
        for run, rows in grouped(batches, "run", ["part", "data", "docs"]):
            records, own, table = None, None, []
            for _, part, data, held in rows:
                if part is None:
                    records, own = unpacked(data, "<u4", "<u4", "<u4"), held
                else:
                    table.append(unpacked(data, "<u4", "<u8", "?"))
            count_sum, n_best = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
            if table:
                keys, n, best = (np.concatenate([t[i] for t in table]) for i in range(3))
                order = np.argsort(keys)
                place, doc, times = records
                times = times.astype(np.int64)
                np.add.at(count_sum, doc, times * n[order].astype(np.int64)[place])
                np.add.at(n_best, doc, times * best[order][place])
            for d, s, t in zip(own, count_sum.tolist(), n_best.tolist()):
                d["count_sum"], d["n_best"] = s, t
            names = [c.split()[0] for c in ALIGNED.split(", ")]
            kinds = [pa.string() if c.endswith("string") else pa.int64() for c in ALIGNED.split(", ")]
            for at in range(0, len(own), 4096):
                yield pa.record_batch([pa.array([d[c] for d in own[at:at + 4096]], k) for c, k in zip(names, kinds)],
                                      names=names)

    kept = runs.where("part is null").select("run", "part", "data", "docs")
    back = returned.select("run", "part", "data", F.lit(None).cast(runs.schema["docs"].dataType).alias("docs"))
    return kept.unionByName(back).repartition(shuffle_width(spark), "run").sortWithinPartitions(
        "run", F.asc_nulls_first("part")).mapInArrow(settle, ALIGNED)
