"""The operators of newsflow.llm against brute force, on small tables with odd rows."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsflow.llm import (lm_score, mixing, near_dedup, packing, pii, quality, queries, secret_scan, suffix_dedup,
                          token_output, topk)
from tests.conftest import SF_SMALL, spark  # noqa: F401

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, start long, size string"
WORD = re.compile("[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):  # noqa: F811
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):  # noqa: F811
    """Null, empty, long, tied and repeated rows, with extra columns of clashing names."""
    base = " ".join(f"w{i}x" for i in range(60))
    texts = [(1, base, "en", "a"), (2, None, None, None), (3, "", "en", "b"), (4, base, "en", "a"),
             (5, " \t\n ", "en", "b"), (6, "one two", None, "b"), (7, "x" * 5000, "en", None), (8, base + " tail", "de", "a"),
             (9, "é ñ " * 3000, "fr", "c"), (6, "one two", None, "b"), (None, base + " other words here", "en", "a")]
    return spark.createDataFrame([(i, t, la, s, None, "x", 7, "y") for i, t, la, s in texts], SCHEMA)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


def rows(df):
    return [r.asDict() for r in df.collect()]


def shingles(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_empty_tables(empty, spark):  # noqa: F811
    tok = queries.tokenizer_file
    for make in (lambda: packing.pack_documents(empty, tok("byte_bpe_50k.json")), lambda: lm_score.score_documents(empty),
                 lambda: suffix_dedup.repeat_digest(empty), lambda: near_dedup.near_duplicates(empty),
                 lambda: mixing.mix_sources(empty), lambda: secret_scan.scan_secrets(empty),
                 lambda: quality.quality_verdicts(empty), lambda: pii.personal_data(empty),
                 lambda: topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"))):
        assert make().count() == 0
    path = token_output.scratch_path(spark)
    token_output.write_token_files(empty, tok("word_bpe_49k.json"), path)
    assert token_output.token_digest(spark, path).count() == 0


def test_top_k_against_all_pairs(spark):  # noqa: F811
    rng = np.random.default_rng(3)
    data = [(i, [float(x) for x in rng.normal(size=8).round(1)]) for i in range(300)]
    data += [(400, None), (420, [1.0, None] + [0.0] * 6), (440, [float("nan")] * 8), (None, [0.0] * 8), (460, [1.0, 2.0])]
    got = rows(topk.top_k(spark.createDataFrame(data, "vec_id long, embedding array<float>")))
    x = {i: np.floor(64 * np.array(v, np.float32).astype(float)).astype(int) for i, v in data[:300]}
    for q in range(0, 300, 20):
        best = sorted(((-int(x[q] @ v), i) for i, v in x.items() if i != q))[:20]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert mine == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert {r["query_id"] for r in got} == set(range(0, 300, 20))


def test_packing_round_trip(docs, odd):
    path = queries.tokenizer_file("byte_bpe_50k.json")
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    for table in (docs, odd):
        ids = [(r["doc_id"], np.array(tok.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4"))
               for r in table.select("doc_id", "text").collect()]
        pieces = rows(packing.pack_documents(table, path, length=256))
        assert sum(p["length"] for p in pieces) == sum(len(v) for _, v in ids)
        by = {}
        for p in pieces:
            by.setdefault(p["sequence_id"], []).append(p)
        for own in by.values():
            own.sort(key=lambda p: p["offset"])
            ends = np.cumsum([p["length"] for p in own])
            assert [p["offset"] for p in own] == [0, *ends[:-1]]
            assert ends[-1] <= 256 and (ends[-1] & (ends[-1] - 1)) == 0
        known = {(i, zlib.crc32(v[p["start"]:p["start"] + p["length"]].tobytes()), len(v))
                 for p in pieces for i, v in ids if i == p["doc_id"]}
        assert all((p["doc_id"], p["ids_crc32"], p["doc_tokens"]) in known for p in pieces)


def test_hilbert_curve_visits_neighbours():
    points = np.array([[i, j, k] for i in range(8) for j in range(8) for k in range(8)])
    keys = packing.hilbert_keys(points, 3)
    assert sorted(keys) == list(range(512))
    assert (np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_masked_scores_against_loop(odd):
    codes = lm_score.coded(odd.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    flat = lm_score.fit(codes)
    net = lm_score.unpacked(flat)
    for r in codes.where("size(codes) between 1 and 100").collect():
        row = [lm_score.CODES] * 2 + list(r["codes"]) + [lm_score.CODES] * 2
        total = 0.0
        for t in range(2, len(row) - 2):
            h = np.tanh(sum(net["side"][i][row[t + k]] for i, k in enumerate((-2, -1, 1, 2))))
            a, b = divmod(row[t], lm_score.BASE)
            z = h @ net["first"] + net["first_bias"]
            y = (h + net["turn"][a]) @ net["second"] + net["second_bias"][a]
            total += z[a] - np.log(np.exp(z).sum()) + y[b] - np.log(np.exp(y).sum())
        got = lm_score.log_probabilities(net, np.array(row), np.arange(2, len(row) - 2)).sum()
        assert abs(got - total) < 1e-3 * max(1, len(r["codes"]))
    out = {r["doc_id"]: r for r in lm_score.score_documents(odd).collect()}
    assert out[2]["n_tokens"] == 0 and out[2]["log_prob"] == 0 and out[2]["mean_log_prob"] is None


def brute_repeats(pairs):
    seen, out = {}, {}
    for i, text in sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - 99):
            here = (i, k)
            if seen.setdefault(data[k:k + 100], here) != here:
                gone[k:k + 100] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out[i] = (len(data), int(gone.sum()), spans,
                  hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest())
    return out


def test_repeated_bytes(docs, odd):
    for table in (docs, odd):
        expected = brute_repeats([(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()])
        for r in rows(suffix_dedup.repeat_digest(table)):
            assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == expected[r["doc_id"]], r["doc_id"]


def test_run_length_statistics():
    rng = np.random.default_rng(2)
    contexts = [bytes(rng.integers(97, 99, 40).astype(np.uint8)) for _ in range(30)]
    index = suffix_dedup.RunLengthIndex(contexts, length=6)
    for lanes, at, low, high, where in index.stream(contexts):
        for lane, a, lo, hi, w in zip(lanes, at, low, high, where):
            window = contexts[lane][a:a + 6]
            assert hi - lo == sum(c[k:k + 6] == window for c in contexts for k in range(35))


def test_near_duplicates_against_all_pairs(docs, odd):
    for table in (docs, odd):
        sets = {r["doc_id"]: shingles(r["text"]) for r in table.select("doc_id", "text").collect() if r["doc_id"] is not None}
        parent = {i: i for i in sets}

        def find(i):
            while parent[i] != i:
                i = parent[i]
            return i
        ids = sorted(i for i in sets if sets[i])
        for n, i in enumerate(ids):
            for j in ids[:n]:
                common = len(sets[i] & sets[j])
                if 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common):
                    a, b = sorted((find(i), find(j)))
                    parent[b] = a
        for r in rows(near_dedup.near_duplicates(table)):
            if r["doc_id"] is None:
                assert r["component_id"] is None and r["kept"]
            else:
                assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), find(r["doc_id"]))


def test_mix_reaches_targets(docs, odd):
    for table in (docs, odd):
        out = table.sparkSession.createDataFrame(mixing.mix_sources(table).toPandas().drop(columns="position"))
        sizes = {}
        for r in table.select("source", "text").collect():
            sizes[r["source"]] = sizes.get(r["source"], 0) + len(WORD.findall(r["text"] or ""))
        order = sorted(sizes, key=lambda s: (s is None, s or ""))
        weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
        target, free, left = {}, set(order), sum(sizes.values())
        while free:
            share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
            full = {s for s in free if share[s] > 3 * sizes[s]}
            target.update({s: 3.0 * sizes[s] for s in full} or {s: share[s] for s in free})
            left -= sum(3 * sizes[s] for s in full)
            free = free - full if full else set()
        got = out.groupBy("source_size").agg(F.sum("taken").alias("t"), F.max("target").alias("g"),
                                             F.countDistinct("target").alias("n")).collect()
        for r in got:
            if r["n"] == 1 and list(sizes.values()).count(r["source_size"]) == 1:
                s = next(s for s in sizes if sizes[s] == r["source_size"])
                assert r["g"] == pytest.approx(target[s]) and abs(r["t"] - target[s]) <= 1
        assert out.where("taken > 3 * size").count() == 0


def test_token_files_round_trip(docs, odd, spark):  # noqa: F811
    from tokenizers import Tokenizer
    path = queries.tokenizer_file("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    for table in (docs, odd):
        place = token_output.scratch_path(spark)
        token_output.write_token_files(table, path, place)
        out = sorted(rows(token_output.token_digest(spark, place)), key=lambda r: r["start"])
        ends = np.cumsum([r["n_tokens"] for r in out])
        assert [r["start"] for r in out] == [0, *ends[:-1]]
        assert [r["doc_id"] for r in out] == sorted((r["doc_id"] for r in out), key=lambda i: (i is not None, i or 0))
        known = {(r["doc_id"], zlib.crc32(np.array(tok.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4")
                                          .tobytes())) for r in table.select("doc_id", "text").collect()}
        assert {(r["doc_id"], r["ids_crc32"]) for r in out} == known


def test_code_lengths_are_limited_and_complete():
    counts = np.zeros(1000, np.int64)
    counts[:40] = 2 ** np.arange(40)
    lengths = token_output.code_lengths(counts)
    assert lengths.max() <= token_output.MAX_BITS and (0.5 ** lengths[:40].astype(float)).sum() == 1
    assert not lengths[40:].any()


def test_forest_on_held_out_findings():
    forest = secret_scan.trained_forest()
    found = secret_scan.labelled_findings(seed=99)
    x = np.array([secret_scan.features(t, a, b) for t, a, b, _ in found])
    votes = np.mean([secret_scan.tree_vote(t, x) for t in forest], axis=0) >= 0.5
    assert np.mean(votes == [s for *_, s in found]) > 0.95


def test_quality_counts(docs, odd):
    for table in (docs, odd):
        texts = {r["doc_id"]: r["text"] or "" for r in table.select("doc_id", "text").collect()}
        for r in rows(quality.quality_verdicts(table)):
            text = texts[r["doc_id"]]
            w = WORD.findall(text)
            lines = [x for x in text.split("\n") if WORD.search(x)]
            grams = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
            count = {}
            for g in grams:
                count[g] = count.get(g, 0) + 1
            covered = {k + j for k, g in enumerate(grams) if count[g] > 1 for j in range(8)}
            failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) \
                == (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
                    len(covered), failed)
            assert not (failed and r["kept"])


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = "".join(c for c in m[0] if "0" <= c <= "9")
            if (kind == "ip" and max(map(int, m[0].split("."))) > 255
                    or kind == "card" and not (12 <= len(digits) <= 19 and pii.luhn(digits))
                    or kind == "phone" and not 9 <= len(digits) <= 15):
                continue
            out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], pii.ORDER[s[0]]))


def test_personal_data(docs, odd):
    for table in (docs, odd):
        texts = {r["doc_id"]: r["text"] or "" for r in table.select("doc_id", "text").collect()}
        for r in rows(pii.personal_data(table)):
            base = brute_spans(texts[r["doc_id"]])
            assert r["base_sha256"] == hashlib.sha256(pii.joined(base).encode()).hexdigest()
            assert [r[f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in base) for k in pii.BASE]
            assert {pii.joined([s]) for s in base} <= set(r["spans"].split(","))
    rng = np.random.default_rng(4)
    for _ in range(3000):
        text = "".join(rng.choice(list("a1.@-+ 25()"), rng.integers(0, 40)))
        assert pii.base_spans(text) == brute_spans(text)


def test_random_field_finds_new_names():
    model = pii.trained()
    text = "We asked Mrs. Ingrid Larsen. She lives at 81 Harbour Avenue now.\nThonre was. Anly hend John went."
    (_, spans), = pii.all_spans([text], model)
    assert [text[a:b] for _, a, b in spans] == ["Ingrid Larsen", "81 Harbour Avenue"]


def test_pipeline_keeps_columns(spark, docs, monkeypatch):  # noqa: F811
    import corpus_pipeline
    seen = []

    def watched(name, stage):
        def call(session, frame, sf_dir):
            seen.append((name, frame.columns, frame.count()))
            return stage(session, frame, sf_dir)
        return name, call
    monkeypatch.setattr(corpus_pipeline, "STAGES", [watched(*s) for s in corpus_pipeline.STAGES])
    pieces = rows(corpus_pipeline.run(spark, SF_SMALL))
    assert pieces and all(p["offset"] + p["length"] <= 2048 for p in pieces)
    assert [n for n, *_ in seen] == ["quality_rules", "minhash_near_dedup", "personal_data", "source_mix", "curve_packing"]
    assert all(set(columns) == set(docs.columns) for _, columns, _ in seen)
    assert seen[0][2] > seen[1][2] > seen[2][2] == seen[3][2]


def test_masked_scores_tell_words_of_one_class_apart(spark):  # noqa: F811
    common = [f"word{i}" for i in range(12)]
    code = lambda words: [r[0] for r in lm_score.coded(spark.createDataFrame(
        [(0, " ".join(words))], "doc_id long, text string")).select(F.explode("codes")).collect()]
    strange = [f"zq{i}x" for i in range(40_000)]
    of_code = dict(zip(code(strange), strange))
    clean = [" ".join(np.random.default_rng(i).permutation(common)) for i in range(200)]
    twin = " ".join(of_code[c] for c in code(clean[0].split()))
    table = spark.createDataFrame([*enumerate(clean), (1000, twin)], "doc_id long, text string").cache()
    out = {r["doc_id"]: r for r in lm_score.score_documents(table).collect()}
    assert out[0]["n_tokens"] == out[1000]["n_tokens"] == 12
    assert out[0]["mean_log_prob"] - out[1000]["mean_log_prob"] > 4
    codes = lm_score.coded(table)
    counts = lm_score.code_counts(codes)
    net = lm_score.unpacked(lm_score.fit(codes))
    n = {}
    for r in codes.collect():
        for w in r["words"]:
            n[w] = n.get(w, 0) + 1
    for r in codes.where("doc_id in (0, 7, 1000)").collect():
        row, at = lm_score.padded([np.array(r["codes"])])
        want = lm_score.log_probabilities(net, row, at).sum() + sum(
            np.log(n[w] / counts[c]) for w, c in zip(r["words"], r["codes"]))
        assert abs(out[r["doc_id"]]["log_prob"] - want) < 1e-3


def test_masked_scores_do_not_follow_partitions(docs, monkeypatch):
    monkeypatch.setattr(lm_score, "SHARD_WORDS", 5000)
    monkeypatch.setattr(lm_score, "COMMON", 300)  # most words by the join
    table = docs.where("doc_id < 120")
    one, many = ({r["doc_id"]: r["log_prob"] for r in lm_score.score_documents(t).collect()}
                 for t in (table.coalesce(1), table.repartition(7)))
    assert one.keys() == many.keys()
    assert all(abs(one[i] - many[i]) < 1e-4 * max(1, abs(one[i])) for i in one)


def test_quality_rejects_planted_outliers(spark):  # noqa: F811
    rng = np.random.default_rng(8)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    word = lambda least=2, most=9: "".join(rng.choice(letters, rng.integers(least, most + 1)))
    vocabulary = [word() for _ in range(3000)]
    prose = lambda n, words=vocabulary: " ".join(rng.choice(words, n))
    clean = [prose(int(rng.integers(150, 400))) for _ in range(400)]
    planted = [prose(1000, vocabulary[:30]),                                      # few words, no window twice
               prose(300, [word(6, 13) for _ in range(3000)]),                    # words some 70 % longer
               "\n".join(f"ab cd ef\n{prose(12)}" for _ in range(30))]            # every other line the same
    table = spark.createDataFrame([(i, t, "en", "a") for i, t in enumerate(clean + planted)],
                                  "doc_id long, text string, lang string, source string")
    out = {r["doc_id"]: r for r in quality.quality_verdicts(table).collect()}
    assert abs(quality.CUTOFF - 18.467) < 1e-2
    assert not any(out[400 + i]["base_failed"] or out[400 + i]["kept"] for i in range(3))
    assert np.mean([out[i]["kept"] for i in range(400)]) > 0.98


def test_forest_sees_letter_only_and_symbol_secrets():
    cases = {"db password=correct-horse-battery is set": "correct-horse-battery",
             "password: hR!7p#xQ and more": "hR!7p#xQ",
             "token = \"qWdkRzXbTnMvLpGhJcYs\" was here": "qWdkRzXbTnMvLpGhJcYs",
             "pwd=k7Tq9ZxW of the box": "k7Tq9ZxW",
             "see -----BEGIN RSA PRIVATE KEY----- below": "-----BEGIN RSA PRIVATE KEY-----"}
    found = secret_scan.judged(list(cases), secret_scan.trained_forest())
    for (text, secret), spans in zip(cases.items(), found):
        assert secret in [text[a:b] for a, b, vote in spans if vote >= 0.5], text
    plain = "Internationally recognised organisations published comprehensive documentation yesterday afternoon."
    (spans,) = secret_scan.judged([plain], secret_scan.trained_forest())
    assert len(spans) >= 7 and not [s for s in spans if s[2] >= 0.5]
