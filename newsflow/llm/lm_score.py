"""Masked pseudo-likelihood of documents under a bidirectional window network.

The vocabulary is every distinct lower-cased word of the corpus, with its count.
A word belongs to one of ``CODES`` classes by its hash, written as two digits of
base ``BASE``.  The network sees the classes of the two words on either side of
a masked word and gives the probability of its class (first digit, then second);
the word's share of its class, from the counts, completes a distribution over
the vocabulary.  A document's score is the sum over its words of the conditional
log-probability.

Words of a share of at least 1 / ``COMMON`` (so at most ``COMMON`` words) get
their counts by a broadcast, all others by a join on the word.

Training is data parallel over all documents: class counts of the whole corpus
start the biases; documents are dealt by a hash into shards of about
``SHARD_WORDS`` words, whatever the partitions of the input; each shard fits its
words once (Adagrad), and the shards' parameters, weighted by their words, are
averaged by a shuffle of parameter slots.  Only the network, of a fixed size,
reaches the driver; the vocabulary is a written table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import small_batches, texts_of, written

BASE, WIDTH, REACH = 32, 16, 2
CODES = BASE * BASE
SHAPES = {"side": (2 * REACH, CODES + 1, WIDTH), "first": (WIDTH, BASE), "first_bias": (BASE,),
          "turn": (BASE, WIDTH), "second": (WIDTH, BASE), "second_bias": (BASE, BASE)}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())
SLOT, STEP_WORDS, RATE = 1024, 8192, 0.1
SHARD_WORDS = 1 << 21
COMMON = 1 << 18
#: Logarithms are summed as whole numbers of this part, so that their order does not matter.
PART = 1 << 32


def coded(docs: DataFrame) -> DataFrame:
    """(doc_id, words, codes) of (doc_id, text): the lower-cased words and their classes, in order."""
    words = F.array_remove(F.split(F.translate(F.lower("text"), "\t\n\x0b\x0c\r", "     "), " "), "")
    return docs.select("doc_id", words.alias("words")).withColumn(
        "codes", F.transform("words", lambda w: F.pmod(F.xxhash64(w), F.lit(CODES)).cast("short")))


def code_lists(column: pa.Array) -> list[np.ndarray]:
    """The codes of each row of a list column."""
    values, ends = column.values.to_numpy(), column.offsets.to_numpy()
    return [values[a:b].astype(np.int64) for a, b in zip(ends, ends[1:])]


def unpacked(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[name] = flat[at:at + n].reshape(shape)
        at += n
    return out


def start(counts: np.ndarray) -> np.ndarray:
    """Parameters before training: fixed small numbers, biases from the counts of all codes."""
    flat = (np.random.default_rng(11).standard_normal(SIZE) * 0.1).astype(np.float32)
    net = unpacked(flat)
    table = counts.reshape(BASE, BASE).astype(float) + 0.5
    net["first_bias"][:] = np.log(table.sum(axis=1) / table.sum())
    net["second_bias"][:] = np.log(table / table.sum(axis=1, keepdims=True))
    return flat


def padded(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of several documents in one row with borders between, and the places of the words."""
    gap = np.full(REACH, CODES)
    parts = [gap]
    for d in documents:
        parts += [d, gap]
    row = np.concatenate(parts)
    return row, np.flatnonzero(row != CODES)


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(np.maximum(z - z.max(), -80))
    return z / z.sum(axis=1, keepdims=True)


def forward(net: dict[str, np.ndarray], row: np.ndarray, at: np.ndarray):
    sides = [row[at + k] for k in (*range(-REACH, 0), *range(1, REACH + 1))]
    hidden = np.tanh(sum(net["side"][i][s] for i, s in enumerate(sides)))
    one, two = np.divmod(row[at], BASE)
    p = softmax(hidden @ net["first"] + net["first_bias"])
    turned = hidden + net["turn"][one]
    q = softmax(turned @ net["second"] + net["second_bias"][one])
    return sides, hidden, turned, one, two, p, q


def log_probabilities(net: dict[str, np.ndarray], row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Conditional log-probability of the word at each place."""
    out = np.empty(len(at))
    for lo in range(0, len(at), 4 * STEP_WORDS):
        _, _, _, one, two, p, q = forward(net, row, at[lo:lo + 4 * STEP_WORDS])
        n = np.arange(len(one))
        out[lo:lo + len(one)] = np.log(p[n, one].astype(float)) + np.log(q[n, two].astype(float))
    return out


def train_step(net, past, row, at) -> None:
    """One Adagrad step on the words at ``at``; ``net`` and ``past`` change in place."""
    sides, hidden, turned, one, two, p, q = forward(net, row, at)
    n, i = len(at), np.arange(len(at))
    p[i, one] -= 1
    q[i, two] -= 1
    pick = np.zeros((n, BASE), np.float32)
    pick[i, one] = 1
    d_turned = q @ net["second"].T
    d_in = (p @ net["first"].T + d_turned) * (1 - hidden * hidden)
    grads = {"first": hidden.T @ p, "first_bias": p.sum(axis=0), "turn": pick.T @ d_turned,
             "second": turned.T @ q, "second_bias": pick.T @ q,
             "side": np.stack([np.stack([np.bincount(s, d_in[:, w], CODES + 1) for w in range(WIDTH)], axis=1)
                               for s in sides])}
    for name, g in grads.items():
        g = (g / n).astype(np.float32)
        past[name] += g * g
        net[name] -= RATE * g / np.sqrt(past[name] + 1e-6)


def code_counts(codes: DataFrame) -> np.ndarray:
    """Count of each code over all documents."""
    def count(batches):
        total = np.zeros(CODES, np.int64)
        for b in batches:
            for c in code_lists(b["codes"]):
                total += np.bincount(c, minlength=CODES)
        yield pa.record_batch([np.arange(CODES), total], names=["code", "n"])
    out = np.zeros(CODES, np.int64)
    for r in codes.select("codes").mapInArrow(count, "code long, n long").groupBy("code").agg(
            F.sum("n").alias("n")).collect():
        out[r["code"]] = r["n"]
    return out


def fit(codes: DataFrame, counts: np.ndarray | None = None) -> np.ndarray:
    """Parameters fitted to all documents of (doc_id, codes); the same however the rows are partitioned."""
    counts = code_counts(codes) if counts is None else counts
    begin = start(counts)
    shards = max(1, -(-int(counts.sum()) // SHARD_WORDS))

    def local(batches):
        shard, held, size = None, [], 0
        flat = past = net = sums = words = None

        def learn():
            row, at = padded(held)
            for lo in range(0, len(at), STEP_WORDS):
                train_step(net, sums, row, at[lo:lo + STEP_WORDS])
            return len(at)

        def fitted():
            parts = [flat[i:i + SLOT].astype("<f4").tobytes() for i in range(0, SIZE, SLOT)]
            return pa.record_batch([pa.array(range(len(parts)), pa.int64()), pa.array([words] * len(parts), pa.int64()),
                                    pa.array(parts, pa.binary())], names=["slot", "words", "part"])

        for b in batches:
            for s, document in zip(b["shard"].to_pylist(), code_lists(b["codes"])):
                if s != shard:
                    if shard is not None:
                        words += learn()
                        yield fitted()
                    shard, held, size, words = s, [], 0, 0
                    flat, past = begin.copy(), np.zeros(SIZE, np.float32)
                    net, sums = unpacked(flat), unpacked(past)
                held.append(document)
                size += len(document)
                if size >= 4 * STEP_WORDS:
                    words += learn()
                    held, size = [], 0
        if shard is not None:
            words += learn()
            yield fitted()

    def mean(batches):
        slot, total, weight = None, None, 0
        done = []
        for b in batches:
            for s, w, part in zip(*(b[c].to_pylist() for c in ("slot", "words", "part"))):
                if s != slot:
                    if slot is not None:
                        done.append((slot, total / weight))
                    slot, total, weight = s, 0.0, 0
                total, weight = total + w * np.frombuffer(part, "<f4").astype(float), weight + w
        if slot is not None:
            done.append((slot, total / weight))
        yield pa.record_batch([pa.array([d[0] for d in done], pa.int64()),
                               pa.array([d[1].astype("<f4").tobytes() for d in done], pa.binary())],
                              names=["slot", "part"])

    key = F.xxhash64("doc_id", "codes")
    dealt = codes.where(F.size("codes") > 0).select(
        F.pmod(key, F.lit(shards)).alias("shard"), key.alias("key"), "doc_id", "codes").repartition(
        shards, "shard").sortWithinPartitions("shard", "key", "doc_id", "codes")
    parts = dealt.select("shard", "codes").mapInArrow(local, "slot long, words long, part binary")
    averaged = parts.repartition("slot").sortWithinPartitions("slot", "words", "part").mapInArrow(
        mean, "slot long, part binary")
    flat = begin.copy()
    for r in averaged.collect():  # SIZE numbers, whatever the corpus
        flat[r["slot"] * SLOT:(r["slot"] + 1) * SLOT] = np.frombuffer(r["part"], "<f4")
    return flat


def word_parts(codes: DataFrame, total: int) -> DataFrame:
    """(row, part): sums of log count over the words of each row of (row, words), in one or more parts."""
    vocabulary = written(codes.select(F.explode("words").alias("word")).groupBy("word").agg(
        F.count("*").alias("n")), "vocabulary")
    log_count = F.round(F.log("n") * PART).cast("long")
    common = F.col("n") >= total / COMMON
    pairs = codes.select("row", F.explode("words").alias("word"))
    often = F.broadcast(vocabulary.where(common).select("word", log_count.alias("part")))
    parts = pairs.join(often, "word").groupBy("row").agg(F.sum("part").alias("part"))
    rare = vocabulary.where(~common).select("word", log_count.alias("part"))
    return parts.union(pairs.join(often, "word", "left_anti").join(rare, "word").select("row", "part"))


def score_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, log_prob, mean_log_prob) of every document, the model fitted to all of them.

    A null, empty or wordless text has 0 tokens, log_prob 0 and a null mean;
    repeated rows are scored (and trained on) each; an empty table gives no
    rows.  Columns beside doc_id and text are not read.
    """
    small_batches(docs.sparkSession)
    codes = written(coded(texts_of(docs)).withColumn("row", F.monotonically_increasing_id()), "codes")
    counts = code_counts(codes)
    flat = fit(codes, counts)
    log_class = np.log(np.maximum(counts, 1))

    def score(batches):
        net = unpacked(flat)
        for b in batches:
            documents = code_lists(b["codes"])
            row, at = padded(documents)
            sizes = np.array([len(d) for d in documents])
            ends = np.cumsum(sizes)
            sums = np.diff(np.concatenate([[0.0], np.cumsum(log_probabilities(net, row, at))])[
                np.concatenate([[0], ends])])
            sums -= np.diff(np.concatenate([[0.0], np.cumsum(log_class[row[at]])])[np.concatenate([[0], ends])])
            yield pa.record_batch([b["row"], b["doc_id"], pa.array(sizes, pa.int64()),
                                   pa.array(np.rint(sums * PART).astype(np.int64))],
                                  names=["row", "doc_id", "n_tokens", "part"])
    classes = codes.select("row", "doc_id", "codes").mapInArrow(score, "row long, doc_id long, n_tokens long, part long")
    words = word_parts(codes, int(counts.sum())).select(
        "row", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_tokens"), "part")
    log_prob = F.sum("part") / F.lit(float(PART))
    return classes.union(words).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), log_prob.alias("log_prob")).select(
        "doc_id", "n_tokens", "log_prob", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens"))
        .alias("mean_log_prob"))
