"""Secrets in texts: candidate strings, judged by a random forest trained on labelled findings.

A candidate is a run of at least ``LEAST`` key characters with a digit in it.
The forest sees its length, transitions between character classes, alphabet,
dictionary coverage, path marks and the words before it, and takes out the
false positives (hashes, ids, paths, numbers).  The labelled findings are built
by ``labelled_findings`` from fixed kinds with drawn strings.
"""

from __future__ import annotations

import functools
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from newsflow.llm.common import byte_slices, small_batches, texts_of

LEAST, TREES, DEPTH = 8, 40, 10
_RUN = re.compile(r"[A-Za-z0-9+/_.-]{%d,}+={0,2}" % LEAST)
_BEFORE = re.compile(r"[A-Za-z]+")
# fixed values: words that announce a secret, and ones that announce something else
ASKING = {"password", "passwd", "pwd", "secret", "token", "key", "apikey", "api", "auth", "credential", "bearer",
          "access", "private"}
#: A value given to an asking word, in any characters, and the header of a private key.
_VALUE = re.compile(r"(?i:passw(?:or)?d|passphrase|pwd|secret|token|key|auth|credentials?|bearer|private)"
                    r"[\"']?[ \t]*[:=][ \t]*[\"']?([^\s\"']{%d,})" % LEAST)
_PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----")
OTHER = {"commit", "sha", "md", "checksum", "digest", "uuid", "id", "version", "file", "path", "isbn", "order",
         "invoice", "phone", "card", "number", "href", "src", "build", "revision"}
WORDS = ("the and for with this that from have not you are was file data test user name main home local lib usr src "
         "index image page report version config module value example final draft copy list item total sample").split()
FEATURES = 19
#: Votes kept in memory by a task.
SEEN = 300_000


def kind_of(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


class Kinds(dict):
    """Table for ``str.translate`` that fills itself from ``of``."""

    def __init__(self, of):
        super().__init__()
        self.of = of

    def __missing__(self, code: int) -> str:
        out = self[code] = self.of(chr(code))
        return out


_KINDS = Kinds(lambda c: str(kind_of(c)))
_SOUNDS = Kinds(lambda c: "." if not c.isalpha() else "v" if c in "aeiou" or not c.isascii() else
                "r" if c in "jkqvwxyz" else "c")
_SAME = re.compile("0+|1+|2+|3+")
_PAIR, _HARSH = re.compile("(?=[vrc][vrc])"), re.compile("(?=[rc][rc]|rv|vr)")


def setting(text: str, start: int) -> tuple[bool, bool, bool]:
    """Whether an asking word, another announcing word and = or : stand before the candidate."""
    before = text[max(0, start - 40):start]
    names = {w.lower() for w in _BEFORE.findall(before)[-3:]}
    return bool(names & ASKING), bool(names & OTHER), before.rstrip("\"' ")[-1:] in ("=", ":")


def statistics(s: str, asked: bool, other: bool, given: bool) -> list[float]:
    """The statistic vector of candidate ``s`` in its setting."""
    n = len(s)
    kinds = s.translate(_KINDS)
    counts = [s.count(c) for c in set(s)]
    entropy = -sum(c / n * math.log2(c / n) for c in counts)
    low = s.lower()
    covered = sum(len(w) * low.count(w) for w in WORDS if w in low)
    sounds = low.translate(_SOUNDS)
    return [n, (len(_SAME.findall(kinds)) - 1) / n, *(kinds.count(k) / n for k in "0123"), entropy, len(counts) / n,
            covered / n, s.count("/") + s.count("."), float(not s.strip("0123456789abcdefABCDEF")), float(asked),
            float(other), float(given), sum(not c.isalnum() and c not in "/._-+" for c in s) / n if "3" in kinds else 0.0,
            len(_HARSH.findall(sounds)) / max(1, len(_PAIR.findall(sounds))), float(s.startswith("-----BEGIN")),
            s.count("-") + s.count("_"), float(s[:1].isupper() and s[1:].islower())]


def features(text: str, start: int, end: int) -> list[float]:
    """The statistic vector of the candidate ``text[start:end]``."""
    return statistics(text[start:end], *setting(text, start))


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans of the candidates, in order and without overlap: key headers, values asked for, then runs outside these."""
    taken = [m.span() for m in _PEM.finditer(text)] if "-----BEGIN" in text else []
    if "=" in text or ":" in text:
        for m in _VALUE.finditer(text):
            end = m.start(1) + len(m[1].rstrip(".,;:!?)]}"))
            if end - m.start(1) >= LEAST and all(end <= a or b <= m.start(1) for a, b in taken):
                taken.append((m.start(1), end))
    out = list(taken)
    for m in _RUN.finditer(text):
        end = m.start() + len(m[0].rstrip("."))
        if end - m.start() >= LEAST and all(end <= a or b <= m.start() for a, b in taken):
            out.append((m.start(), end))
    return sorted(out)


def labelled_findings(per_kind: int = 40, seed: int = 5) -> list[tuple[str, int, int, bool]]:
    """(text, start, end, is_secret), ``per_kind`` of each kind, the same on every run."""
    rng = np.random.default_rng(seed)
    draw = lambda letters, n: "".join(rng.choice(list(letters), n))
    digits, hexa, low = "0123456789", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz"
    base = low.upper() + low + digits
    word = lambda: str(rng.choice(WORDS))
    spoken = lambda n: "".join(draw("bcdfghlmnprst", 1) + draw("aeiou", 1) + draw(["", "n", "r", "s", "t"], 1)
                               for _ in range(n)).ljust(LEAST, "n")
    prose = lambda: " ".join(word() for _ in range(4))
    asks = ["password=", "token = \"", "secret: ", "api_key=", "access key ", "auth token: "]
    others = ["commit ", "sha256:", "id=", "file ", "order number ", "digest: "]
    kinds = [
        (True, lambda: ("", "AKIA" + draw(low.upper() + digits, 16))),
        (True, lambda: (asks[rng.integers(6)], "ghp_" + draw(base, 36))),
        (True, lambda: (asks[rng.integers(6)], draw(hexa, int(rng.integers(16, 41))))),
        (True, lambda: (asks[rng.integers(6)], draw(base, int(rng.integers(20, 44))))),
        (True, lambda: ("", "sk_live_" + draw(base, 24))),
        (True, lambda: (asks[rng.integers(6)], draw(low.upper() + low, int(rng.integers(14, 33))))),
        (True, lambda: (asks[rng.integers(6)], draw(base + "!@#$%^&*?", int(rng.integers(8, 25))))),
        (True, lambda: (asks[rng.integers(4)], "-".join(word() for _ in range(int(rng.integers(3, 5)))))),
        (True, lambda: (asks[rng.integers(4)], draw(base, int(rng.integers(8, 14))))),
        (True, lambda: ("", draw(low.upper() + low, int(rng.integers(18, 33))))),
        (True, lambda: ("", f"-----BEGIN {['', 'RSA ', 'EC ', 'OPENSSH '][rng.integers(4)]}PRIVATE KEY-----")),
        (False, lambda: (others[rng.integers(6)], draw(hexa, 40))),
        (False, lambda: ("", spoken(3 + rng.integers(4)))),
        (False, lambda: ("", spoken(3 + rng.integers(4)).capitalize())),
        (False, lambda: ("", spoken(3 + rng.integers(4)).upper())),
        (False, lambda: ("", draw(low.upper(), 2) + spoken(3 + rng.integers(2)))),
        (False, lambda: ("", "-".join(word() for _ in range(3)))),
        (False, lambda: ("the key ", spoken(3 + rng.integers(3)))),
        (False, lambda: ("", "-".join(draw(hexa, k) for k in (8, 4, 4, 4, 12)))),
        (False, lambda: ("", "/".join([word(), word(), word() + draw(digits, 2) + ".txt"]))),
        (False, lambda: ("", draw(digits, int(rng.integers(12, 20))))),
        (False, lambda: ("", word() + word() + word() + word() + draw(digits, 2))),
        (False, lambda: ("see ", "www." + word() + word() + draw(digits, 1) + ".example.com/" + word())),
        (False, lambda: ("version ", ".".join(draw(digits, 3) for _ in range(4)))),
        (False, lambda: ("on ", f"20{draw(digits, 2)}-0{draw(digits[1:], 1)}-1{draw(digits, 1)}T10.30.00")),
        (False, lambda: ("", draw("ab", 1) * 10 + draw(digits, 4))),
    ]
    out = []
    for secret, make in kinds:
        for _ in range(per_kind):
            lead, s = make()
            text = f"{prose()} {lead}{s}"
            start = len(text) - len(s)
            out.append((text + f" {prose()}", start, start + len(s), secret))
    return out


def grow_tree(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int) -> list:
    """Nested [feature, threshold, left, right], or the share of secrets at a leaf."""
    if depth == 0 or len(set(y.tolist())) < 2 or len(y) < 4:
        return float(y.mean())
    best = (np.inf, None, None)
    for f in rng.choice(x.shape[1], 4, replace=False):
        order = np.argsort(x[:, f], kind="stable")
        v, labels = x[order, f], y[order]
        cut = np.flatnonzero(v[1:] > v[:-1])
        if not len(cut):
            continue
        ones, n = np.cumsum(labels)[cut], cut + 1
        p, q = ones / n, (labels.sum() - ones) / (len(y) - n)
        impurity = n * p * (1 - p) + (len(y) - n) * q * (1 - q)
        k = int(impurity.argmin())
        if impurity[k] < best[0]:
            best = (impurity[k], int(f), float(v[cut[k]] + v[cut[k] + 1]) / 2)
    if best[1] is None:
        return float(y.mean())
    left = x[:, best[1]] <= best[2]
    return [best[1], best[2], grow_tree(x[left], y[left], rng, depth - 1), grow_tree(x[~left], y[~left], rng, depth - 1)]


def tree_vote(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, list):
        return np.full(len(x), tree)
    left = x[:, tree[0]] <= tree[1]
    out = np.empty(len(x))
    out[left], out[~left] = tree_vote(tree[2], x[left]), tree_vote(tree[3], x[~left])
    return out


@functools.cache
def trained_forest(seed: int = 5) -> tuple:
    found = labelled_findings(seed=seed)
    x = np.array([features(t, a, b) for t, a, b, _ in found])
    y = np.array([float(s) for *_, s in found])
    rng = np.random.default_rng(seed)
    trees = []
    for _ in range(TREES):
        rows = rng.integers(0, len(y), len(y))
        trees.append(grow_tree(x[rows], y[rows], rng, DEPTH))
    return tuple(trees)


def judged(texts: list[str], forest: tuple, seen: dict | None = None) -> list[list[tuple[int, int, float]]]:
    """(start, end, share of votes) of the candidates of each text; ``seen`` holds the votes on earlier candidates."""
    seen = {} if seen is None else seen
    found = [[(a, b, (t[a:b], *setting(t, a))) for a, b in candidates(t)] for t in texts]
    new = list({key: None for spans in found for *_, key in spans if key not in seen})
    if len(seen) > SEEN:
        seen.clear()
        new = list({key: None for spans in found for *_, key in spans})
    if new:
        x = np.array([statistics(*key) for key in new])
        seen.update(zip(new, np.mean([tree_vote(t, x) for t in forest], axis=0).tolist()))
    return [[(a, b, seen[key]) for a, b, key in spans] for spans in found]


def scan_secrets(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """(doc_id, n_candidates, n_secrets, spans) of every document; spans are ``start:end`` in code points.

    A null or empty text has no candidates and an empty span list; repeated rows
    give equal rows; null doc_ids stay null; an empty table gives no rows; other
    columns are not read.
    """
    small_batches(docs.sparkSession)
    forest = trained_forest()

    def scan(batches):
        seen: dict = {}
        for b in batches:
            found = judged([str(t, "utf-8") for t in byte_slices(b["text"])], forest, seen)
            kept = [[s for s in spans if s[2] >= least] for spans in found]
            yield pa.record_batch([b["doc_id"], pa.array([len(s) for s in found], pa.int64()),
                                   pa.array([len(s) for s in kept], pa.int64()),
                                   pa.array([",".join(f"{a}:{e}" for a, e, _ in s) for s in kept], pa.string())],
                                  names=["doc_id", "n_candidates", "n_secrets", "spans"])
    return texts_of(docs).mapInArrow(scan, "doc_id long, n_candidates long, n_secrets long, spans string")
