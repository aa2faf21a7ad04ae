"""Near-duplicate documents: a multi-index Hamming join of MinHash signatures.

A signature is ``SYMBOLS`` MinHash values of 16 bits.  Its first ``CHUNKS * 4``
values are split into chunks of four.  Two signatures that differ there in fewer
than ``2 * CHUNKS`` places agree, by pigeonhole, in at least three places of some
chunk; each chunk is therefore entered under four keys, one for each place that
may be wrong, and every pair within that distance meets under a common key.
At a Jaccard similarity of 0.85 a pair is farther apart with a chance of some
2e-8 (0.8: 1e-6).

No bucket is expanded into its pairs.  Texts with one shingle set are one class.
In a bucket each class is paired with the smallest class only; confirmed links
are joined into components.  Classes with too many shingles that no other open
class has cannot link and leave.  Each bucket still open then takes its class with
the fewest shingles of its own as reference R, and every class x of it is known by
its difference x' = x ^ R: |x ^ y| = |x' ^ y'|, so with

    W(x) = (100 + p) |x'| - (100 - p) |x|

x and y are linked exactly when x' and y' share (W(x) + W(y)) / 2 (100 + p) shingles
or more.  A family of near copies differs from R in few shingles, and what all of it
shares is no longer there.  Pairs that need nothing in common are as connected as
the star around the class of least W.  All others share, in the order of rising
frequency, one of the first shingles of both differences (prefix filter), and enough
is left behind it (position filter); only such pairs with different components are
paired.  Every link is confirmed on the full sets or follows from the sum above.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.common import byte_slices, small_batches, texts_of, written
from newsflow.llm.shingles import shingle_set, signature

SYMBOLS, CHUNKS = 128, 8
EDGES_A_TASK = 100_000


def class_id(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def sketch(batches):
    """(doc_id, text_key, n_shingles, node, signature) of each text; node is null without words."""
    for b in batches:
        counts, nodes, sigs = [], [], []
        for text in byte_slices(b["text"]):
            hashes = shingle_set(text)
            counts.append(len(hashes))
            nodes.append(class_id(hashes) if len(hashes) else None)
            sigs.append(signature(hashes, SYMBOLS).tobytes() if len(hashes) else None)
        yield pa.record_batch([b["doc_id"], b["text_key"], pa.array(counts, pa.int64()), pa.array(nodes, pa.binary()),
                               pa.array(sigs, pa.binary())], names=["doc_id", "text_key", "n_shingles", "node", "sig"])


def chunk_keys(batches):
    """Every key of each signature: chunk, the place left out, and the three other values."""
    for b in batches:
        sigs = np.array([np.frombuffer(s, "<u2", CHUNKS * 4) for s in b["sig"].to_pylist()]).reshape(-1, CHUNKS, 4)
        sigs = sigs.astype(np.int64)
        keys = np.empty((len(sigs), CHUNKS, 4), np.int64)
        for out in range(4):
            x, y, z = (sigs[:, :, i] for i in range(4) if i != out)
            keys[:, :, out] = x << 32 | y << 16 | z
        keys |= (np.arange(CHUNKS)[:, None] * 4 + np.arange(4)) << 48
        per = CHUNKS * 4
        yield pa.record_batch([pa.array(keys.reshape(-1)),
                               b["node"].take(pa.array(np.repeat(np.arange(len(sigs)), per)))], names=["key", "node"])


def distance_limit(similarity: float) -> int:
    """Places of the whole signature that a pair of that similarity differs in, six deviations and all."""
    return math.ceil(SYMBOLS * (1 - similarity) + 6 * math.sqrt(SYMBOLS * similarity * (1 - similarity)))


def close_pairs(pairs: DataFrame, classes: DataFrame, limit: int) -> DataFrame:
    """The pairs (a, b) whose signatures differ in at most ``limit`` places."""
    sig = classes.select("node", "sig")
    both = pairs.join(sig.toDF("a", "sig_a"), "a").join(sig.toDF("b", "sig_b"), "b")

    def near(batches):
        for b in batches:
            x, y = (np.array([np.frombuffer(s, "<u2") for s in b[c].to_pylist()]).reshape(-1, SYMBOLS)
                    for c in ("sig_a", "sig_b"))
            yield pa.record_batch([b["a"], b["b"]], names=["a", "b"]).filter(pa.array((x != y).sum(axis=1) <= limit))
    return both.mapInArrow(near, "a binary, b binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs with 100 * intersection >= percent * union on the full sets."""
    both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")

    def check(batches):
        for b in batches:
            linked = []
            for x, y in zip(b["set_a"].to_pylist(), b["set_b"].to_pylist()):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.record_batch([b["a"], b["b"]], names=["a", "b"]).filter(pa.array(linked, pa.bool_()))
    return both.mapInArrow(check, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for every node of an edge.

    Each round takes the smallest label among the neighbours and then the label
    of that label, so rounds grow with the logarithm of the longest path.
    """
    both = written(edges.union(edges.select("b", "a")).distinct().toDF("node", "other"), "edges")
    wide = 1 + both.count() // EDGES_A_TASK  # tasks in proportion to the edges: a small graph takes few
    labels = written(both.groupBy("node").agg(F.min("other").alias("m"))
                     .select("node", F.least("node", "m").alias("label")).coalesce(wide), "labels")
    while True:
        near = both.join(labels.toDF("other", "theirs"), "other").groupBy("node").agg(F.min("theirs").alias("theirs"))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"),
                                                F.least("label", "theirs").alias("label"))
        step = written(step.coalesce(wide), "labels")
        jump = step.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = written(step.join(jump, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("further", "label")).alias("label")).coalesce(wide), "labels")
        labels = step.select("node", "label")
        if step.where(F.col("old") != F.col("label")).isEmpty():
            return labels


def merged(labels: DataFrame, more: DataFrame) -> DataFrame:
    """(node, label) after the links ``more`` are added: only components that they join are labelled anew."""
    ends = more.select("a").union(more.select("b")).distinct().toDF("node")
    known = written(labels.unionByName(ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("label"))),
                    "labels")
    links = more.join(known.toDF("a", "x"), "a").join(known.toDF("b", "y"), "b")
    links = links.where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    top = components(links).toDF("label", "smallest")
    return written(known.join(top, "label", "left").select("node", F.coalesce("smallest", "label").alias("label")), "labels")


def open_buckets(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, node, label) of the buckets whose classes are not all in one component yet."""
    group = shared.select("key", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    some = group.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y")
    return written(group.join(some.select("key"), "key", "left_semi"), "open")


def single_shingles(sets: DataFrame, group: DataFrame) -> DataFrame:
    """(node, n, u): the size of each class's set and how many of its shingles no other class of ``group`` has.

    Two sets share at most min(n - u) shingles, which bounds their similarity without comparing them.
    """
    def spread(batches):
        for b in batches:
            for node, hashes in zip(b["node"].to_pylist(), b["hashes"].to_pylist()):
                h = np.frombuffer(hashes, "<i8")
                yield pa.record_batch([pa.array(h), pa.array([node] * len(h), pa.binary())], names=["h", "node"])

    here = sets.join(group.select("node").distinct(), "node", "left_semi")
    alone = here.mapInArrow(spread, "h long, node binary").groupBy("h").agg(
        F.count(F.lit(1)).alias("c"), F.min("node").alias("node")).where("c = 1").groupBy("node").agg(
        F.count(F.lit(1)).alias("u"))
    sizes = here.select("node", (F.length("hashes") / 8).cast("long").alias("n"))
    return written(sizes.join(alone, "node", "left").select("node", "n", F.coalesce("u", F.lit(0).cast("long")).alias("u")),
                   "single")


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, set) for the classes of the documents in ``wanted`` (doc_id)."""
    def build(batches):
        for b in batches:
            sets = [shingle_set(t) for t in byte_slices(b["text"])]
            yield pa.record_batch([pa.array([class_id(s) if len(s) else None for s in sets], pa.binary()),
                                   pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())],
                                  names=["node", "hashes"])
    own = docs.join(wanted, "doc_id", "left_semi").mapInArrow(build, "node binary, hashes binary")
    return own.where("node is not null")


def differences(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(ref, node, n, linked, diff): size of the class, whether it is linked with its reference, and what parts the two."""
    both = members.join(sets.toDF("ref", "set_ref"), "ref").join(sets.toDF("node", "set_node"), "node")

    def part(batches):
        for b in batches:
            sizes, linked, diffs = [], [], []
            for x, y in zip(b["set_ref"].to_pylist(), b["set_node"].to_pylist()):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                diff = np.setxor1d(x, y, assume_unique=True)
                sizes.append(len(y))
                linked.append((100 + percent) * len(diff) <= (100 - percent) * (len(x) + len(y)))
                diffs.append(diff.tobytes())
            yield pa.record_batch([b["ref"], b["node"], pa.array(sizes, pa.int64()), pa.array(linked, pa.bool_()),
                                   pa.array(diffs, pa.binary())], names=["ref", "node", "n", "linked", "diff"])
    return both.mapInArrow(part, "ref binary, node binary, n long, linked boolean, diff binary")


def prefix_pairs(diffs: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes of one reference in different components that can still be linked (see the module)."""
    def spread(batches):
        for b in batches:
            for ref, node, weight, diff in zip(*(b[c].to_pylist() for c in ("ref", "node", "w", "diff"))):
                h = np.frombuffer(diff, "<i8")
                n = len(h)
                yield pa.record_batch([pa.array([ref] * n, pa.binary()), pa.array([node] * n, pa.binary()), pa.array(h),
                                       pa.array([n] * n, pa.int64()), pa.array([weight] * n, pa.int64())],
                                      names=["ref", "node", "h", "size", "w"])

    named = diffs.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("ref").agg(F.min("w").alias("low"), F.min("label").alias("x"), F.max("label").alias("y"))
    least = least.where("x != y").select("ref", "low")
    features = written(diffs.join(least, "ref", "left_semi").mapInArrow(
        spread, "ref binary, node binary, h long, size long, w long"), "features")
    seen = features.groupBy("ref", "h").agg(F.count(F.lit(1)).alias("seen")).where("seen > 1")
    # a shingle of one difference alone comes first in the order and is no key
    ranked = features.join(seen, ["ref", "h"], "left").withColumn("place", F.row_number().over(
        Window.partitionBy("ref", "node").orderBy(F.asc_nulls_first("seen"), "h")) - 1)
    scale = 100 + percent
    common = [F.greatest(F.lit(1), F.ceil(c)) for c in (F.col("w") / scale, (F.col("w") + F.col("low")) / (2 * scale))]
    ranked = ranked.where("seen is not null").join(least, "ref")
    ranked = ranked.where(F.col("place") <= F.col("size") - common[1]).withColumn(
        "small", F.col("place") <= F.col("size") - common[0])
    ranked = ranked.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    ranked = written(ranked.select("ref", "h", "node", "label", "w", "small", (F.col("size") - F.col("place")).alias("left")),
                     "prefixes")
    open_keys = ranked.groupBy("ref", "h").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y")
    ranked = ranked.join(open_keys.select("ref", "h"), ["ref", "h"], "left_semi")
    small = ranked.where("small").drop("small").toDF("ref", "h", "a", "label_a", "w_a", "left_a")
    large = ranked.drop("small").toDF("ref", "h", "b", "label_b", "w_b", "left_b")
    pairs = small.join(large, ["ref", "h"]).where(
        (F.col("label_a") != F.col("label_b")) & (F.struct("w_a", "a") < F.struct(F.col("w_b").alias("w_a"), F.col("b").alias("a")))
        & (2 * scale * F.least("left_a", "left_b") >= F.col("w_a") + F.col("w_b")))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def labelled(docs: DataFrame, percent: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, node, component, first) of every row.

    ``component`` is the smallest doc_id of the class's component and ``first`` the
    smallest of its classes that carry that id; both are null without words or id.
    """
    small_batches(docs.sparkSession)
    base = texts_of(docs)
    rows = written(base.withColumn("text_key", F.md5("text")).mapInArrow(
        sketch, "doc_id long, text_key string, n_shingles long, node binary, sig binary"), "sketch")
    with_id = rows.where("node is not null and doc_id is not null")
    classes = written(with_id.groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig")), "classes")

    keys = classes.select("node", "sig").mapInArrow(chunk_keys, "key long, node binary")
    pivots = keys.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low != high")
    shared = written(keys.join(pivots.select("key", "low"), "key"), "keys")  # the keys of two classes or more
    limit = distance_limit(percent / 100)
    star = shared.where("node != low").select(F.col("low").alias("a"), F.col("node").alias("b")).distinct()
    star = written(close_pairs(star, classes, limit), "star")

    members = shared.select("node").distinct().join(classes.select("node", "rep"), "node")
    sets = shingle_sets(base, members.select(F.col("rep").alias("doc_id")).distinct())
    sets = written(sets.dropDuplicates(["node"]), "sets")
    edges = written(confirmed(star, sets, percent), "links")
    labels = components(edges)

    group = open_buckets(shared, labels)
    able = single_shingles(sets, group).where(100 * (F.col("n") - F.col("u")) >= percent * F.col("n"))
    group = open_buckets(shared.join(able.select("node"), "node", "left_semi"), labels)
    middle = group.join(able, "node").groupBy("key").agg(F.min(F.struct(F.col("u") / F.col("n"), "node")).alias("mid"))
    second = group.join(middle.select("key", F.col("mid.node").alias("ref")), "key").where("node != ref")
    diffs = differences(second.select("ref", "node").distinct(), sets, percent)
    diffs = written(diffs.withColumn("w", (100 + percent) * F.length("diff") / 8 - (100 - percent) * F.col("n"))
                    .withColumn("w", F.col("w").cast("long")), "differences")
    centre = diffs.groupBy("ref").agg(F.min(F.struct("w", "node")).alias("c")).select("ref", "c.w", "c.node").toDF("ref", "cw", "c")
    around = diffs.join(centre, "ref").where("node != c and w + cw <= 0").select(
        F.least("node", "c").alias("a"), F.greatest("node", "c").alias("b"))
    near = diffs.where("linked").select(F.least("ref", "node").alias("a"), F.greatest("ref", "node").alias("b"))
    more = written(near.union(around).distinct(), "links")
    if not more.isEmpty():
        labels = merged(labels, more)

    rest = prefix_pairs(diffs, labels, percent).join(star, ["a", "b"], "left_anti")
    more = written(confirmed(close_pairs(rest, classes, limit), sets, percent), "links")
    if not more.isEmpty():
        labels = merged(labels, more)

    named = classes.select("node", "rep").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = named.groupBy("label").agg(F.min(F.struct("rep", "node")).alias("s"))
    component = named.join(smallest, "label").select("node", F.col("s.rep").alias("component"), F.col("s.node").alias("first"))
    return rows.drop("sig").join(component, "node", "left").withColumn(
        "component", F.when(F.col("doc_id").isNotNull(), F.col("component")))


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document.

    Documents are linked when 100 * intersection >= ``percent`` * union of their
    shingle sets.  A null, empty or wordless text has an empty set and is its own
    component.  Rows that repeat a doc_id are one document per text and share the
    id; rows without a doc_id link nothing, have a null component and are kept.
    An empty table gives no rows.  Columns beside doc_id and text are not read.
    """
    out = labelled(docs, percent).withColumn("component_id", F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row of each near-duplicate component, with the columns of ``docs``.

    Decided by each row's own text: of a component the row of its smallest doc_id
    stays (of several texts of that id the smallest class), once if it is repeated.
    Rows without words or without a doc_id are linked with nothing and all stay.
    """
    rows = labelled(docs, percent)
    linked = rows.where("component is not null").groupBy("doc_id", "text_key").agg(
        F.min((F.col("doc_id") == F.col("component")) & (F.col("node") == F.col("first"))).alias("stays"),
        F.count(F.lit(1)).alias("times")).where("not stays or times > 1")
    linked = written(linked, "decisions")
    keyed = docs.withColumn("__doc_key", F.col("doc_id").cast("long")).withColumn(
        "__text_key", F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    key = ["__doc_key", "__text_key"]
    decided = linked.withColumnsRenamed({"doc_id": key[0], "text_key": key[1]})
    out = keyed.join(decided, key, "left_anti")
    if not linked.where("stays").isEmpty():  # rows that are repeated as they are
        out = out.unionByName(keyed.join(decided.where("stays"), key, "left_semi").dropDuplicates(key))
    return out.select(*docs.columns)
