"""Personal data: fixed patterns, and spans found by a linear-chain conditional random field.

The field labels the words of each line (O, or the first or a further word of a
person's name, a street address or an identity number).  A word is seen as one
of ``CLASSES`` shape classes; scores add up weights of the classes of the word
and its neighbours and of label pairs.  Weights are trained here from the small
labelled table below by gradient ascent on the conditional likelihood, and lines
are decoded side by side by Viterbi in numpy.
"""

from __future__ import annotations

import functools
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import byte_slices, small_batches

BASE = ("email", "ip", "card", "phone")
FOUND = ("name", "address", "id")
ORDER = {k: i for i, k in enumerate(BASE + FOUND)}
LABELS = ["O"] + [f"{p}-{k}" for k in FOUND for p in "BI"]
CACHE_WORDS = 500_000

# fixed values: words that introduce or close a span
TITLES = {"mr", "mrs", "ms", "dr", "prof", "herr", "frau", "señor", "señora", "madame", "monsieur"}
INTRODUCTIONS = {"name", "named", "dear", "signed", "sincerely", "patient", "employee", "customer", "applicant"}
STREETS = {"street", "road", "avenue", "lane", "drive", "boulevard", "square", "court"}
ID_WORDS = {"ssn", "passport", "licence", "license", "security", "taxpayer"}
LINKS = {"is", "no", "number", "of", "the", "at", "id"}

# the labelled table: a span stands in [kind words]; NAME, STREET and NUMBER are filled from the lists
FIRST = ["John", "Maria", "Wei", "Fatima", "Olga"]
LAST = ["Smith", "Garcia", "Chen", "Haddad", "Petrova"]
ROADS = ["Baker", "Elm", "Station", "Mill", "Green"]
SAMPLES = [
    "Please ask Mr. [name NAME] about the report.",
    "we met Dr. [name LAST] in the hall",
    "My name: [name NAME] and I live here.",
    "Dear [name NAME], thank you for the letter.",
    "It was signed by Mrs. [name NAME] on Monday.",
    "The patient [name NAME] was seen today.",
    "Prof. [name LAST] spoke for an hour.",
    "Sincerely, [name NAME]",
    "customer name: [name NAME]",
    "He lives at [address 12 STREET Street] near the park.",
    "Send it to [address 204 STREET Road] by Friday.",
    "the house at [address 7 Old STREET Lane] was sold",
    "Our office, [address 1500 STREET Avenue], is closed.",
    "Her SSN is [id NUMBER] as stated.",
    "passport no [id NUMBER] was lost",
    "The social security number [id NUMBER] is on file.",
    "Taxpayer id: [id NUMBER]",
    "The Street was long. And the road went on.",
    "In all 12 of them were there. Nobody came.",
    "He said the name of the place is unknown to the others.",
    "Monday and Tuesday are fine. We will see.",
    "Is the number 42 of any use? No, it is not.",
    "Thonre was is anly hend and, oftionnten. Enti a wherer.",
    "The end. Dear me, it was late. Signed and sealed.",
    "Version 3.14 of the license is free. Of course, John went.",
    "a customer asked for 15 more on the road to Paris.",
    "This is the last line. There are 200 pages in it.",
    "the security of the system was in doubt. All were told.",
    "It was. So. Then the Rest of it came. In. Out. Up.",
    "Here is Paris and the Thames, of Old, at Noon.",
    "| Name | Total | Number | One | Two of Three | the Fourth |",
    "under the Apache License, Version 2.0.",
    "No 15 of the 20 is on. Number 3 at 4 is the Last.",
]

SHAPES = ["lower", "cap", "upper", "initial", "short number", "long number", "dashed number", "mixed", "mark"]
SPECIAL = ["title", "introduction", "street", "id word", "link"]
KINDS = SHAPES + SPECIAL
CLASSES = len(KINDS) * 2 + 1  # with and without closing punctuation; the last stands beyond the line


def word_class(word: str) -> int:
    """Shape class of a word; odd if it ends in punctuation."""
    if word.isalpha() and word.islower() and word not in _NAMED:
        return 0
    core = word.strip(".,;:!?()\"'")
    closed = int(bool(core) and word[-1] in ".,;:!?")
    low = core.lower()
    if low in TITLES:
        return 2 * KINDS.index("title")
    for kind, words in (("introduction", INTRODUCTIONS), ("street", STREETS), ("id word", ID_WORDS), ("link", LINKS)):
        if low in words and (kind != "street" or core[:1].isupper()):
            return 2 * KINDS.index(kind) + closed
    if not core:
        shape = "mark"
    elif core.isdigit():
        shape = "short number" if len(core) <= 4 else "long number"
    elif re.fullmatch(r"[0-9A-Z]+(-[0-9]+)+|[A-Z]{1,2}[0-9]{6,9}", core):
        shape = "dashed number"
    elif core.islower():
        shape = "lower"
    elif len(core) == 1 and core.isupper():
        shape = "initial"
    elif core.istitle() and core.isalpha():
        shape = "cap"
    elif core.isupper():
        shape = "upper"
    else:
        shape = "mixed"
    return 2 * KINDS.index(shape) + closed


_NAMED = TITLES | INTRODUCTIONS | STREETS | ID_WORDS | LINKS


def openings() -> np.ndarray:
    """Whether a span of each label may begin at a word of a class, given the class before it.

    A name is capitalised and follows a title or an introduction; an
    address begins with a number; an identity number follows an introducing
    word.  A span ends with a word that ends in punctuation.  A line without a
    pair that may begin a span has none, whatever the weights.
    """
    of = lambda *kinds, closed=(0, 1): [2 * KINDS.index(k) + c for k in kinds for c in closed]
    ok = np.zeros((CLASSES, CLASSES, len(LABELS)), bool)
    ok[:, :, 0] = True
    ok[np.ix_(of("title", "introduction"), of("cap", "initial"), [LABELS.index("B-name")])] = True
    ok[:, of("short number", closed=(0,)), LABELS.index("B-address")] = True
    ok[np.ix_(of("introduction", "id word", "link"), of("dashed number"), [LABELS.index("B-id")])] = True
    further = [i for i, x in enumerate(LABELS) if x[0] == "I"]
    ok[np.ix_(range(0, CLASSES - 1, 2), range(CLASSES), further)] = True
    return ok


def labelled_lines() -> list[tuple[list[str], list[int]]]:
    """Words and labels of the table, every sample with every filling."""
    out = []
    for i in range(len(FIRST)):
        for sample in SAMPLES:
            fill = {"NAME": f"{FIRST[i]} {LAST[-1 - i]}", "LAST": LAST[i], "STREET": ROADS[i],
                    "NUMBER": ("078-05-1120", "AB1234567", "219-09-9999", "X7654321", "457-55-5462")[i]}
            text = re.sub("|".join(fill), lambda m: fill[m[0]], sample)
            words, labels, kind, first = [], [], None, False
            for token in text.split():
                if token.startswith("["):
                    kind, first = token[1:], True
                    continue
                words.append(token.replace("]", ""))
                labels.append(0 if kind is None else LABELS.index(f"{'B' if first else 'I'}-{kind}"))
                first = False
                if "]" in token:
                    kind = None
            out.append((words, labels))
    return out


_OPEN = openings()
_BEGIN = _OPEN[:, :, [i for i, x in enumerate(LABELS) if x[0] == "B"]].any(axis=2)


def emissions(classes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Score of every label at every word; ``classes`` is (lines, words + 2) with borders."""
    shut = np.where(_OPEN[classes[:, :-2], classes[:, 1:-1]], 0, -1e4)
    return weights[0][classes[:, :-2]] + weights[1][classes[:, 1:-1]] + weights[2][classes[:, 2:]] + shut


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


@functools.cache
def trained(rounds: int = 60, rate: float = 0.8, decay: float = 2e-3) -> tuple[np.ndarray, np.ndarray]:
    """(weights, transitions) fitted to the labelled table; the same on every worker."""
    n = len(LABELS)
    weights, moves = np.zeros((3, CLASSES, n)), np.zeros((n, n))
    for i, label in enumerate(LABELS):  # a further word follows a word of its own span only
        if label.startswith("I"):
            moves[[j for j in range(n) if LABELS[j][2:] != label[2:]], i] = -1e4
    allowed = moves == 0
    lines = [(np.array([CLASSES - 1, *map(word_class, w), CLASSES - 1]), np.array(y)) for w, y in labelled_lines()]
    for _ in range(rounds):
        dw, dm = -decay * weights, np.where(allowed, -decay * moves, 0)
        for c, y in lines:
            e = emissions(c[None], weights)[0]
            length = len(y)
            fore, back = np.zeros((length, n)), np.zeros((length, n))
            fore[0] = e[0] + np.where([x.startswith("I") for x in LABELS], -1e4, 0)
            for t in range(1, length):
                fore[t] = e[t] + log_sum(fore[t - 1][:, None] + moves, 0)
            for t in range(length - 2, -1, -1):
                back[t] = log_sum(moves + (e[t + 1] + back[t + 1])[None], 1)
            whole = log_sum(fore[-1], 0)
            gap = -np.exp(fore + back - whole)
            gap[np.arange(length), y] += 1
            for k in range(3):
                np.add.at(dw[k], c[k:k + length], gap / len(lines))
            for t in range(1, length):
                pair = np.exp(fore[t - 1][:, None] + moves + (e[t] + back[t])[None] - whole)
                dm -= np.where(allowed, pair, 0) / len(lines)
                dm[y[t - 1], y[t]] += 1 / len(lines)
        weights, moves = weights + rate * 4 * dw, moves + rate * 4 * dm
    return weights, moves


def viterbi(classes: list[np.ndarray], weights: np.ndarray, moves: np.ndarray) -> list[np.ndarray]:
    """Best labels of each line; lines of like length are decoded together."""
    out: list = [None] * len(classes)
    sizes = np.array([len(c) for c in classes])
    order = np.argsort(sizes, kind="stable")
    order = order[np.searchsorted(sizes[order], 1):]
    opening = np.where([x.startswith("I") for x in LABELS], -1e4, 0)
    at = 0
    while at < len(order):
        top = max(8, int(sizes[order[at]] * 1.25))
        to = min(at + 4096, int(np.searchsorted(sizes[order], top, "right")))
        lanes = order[at:to]
        width = int(sizes[lanes[-1]])
        c = np.full((len(lanes), width + 2), CLASSES - 1)
        for row, i in enumerate(lanes):
            c[row, 1:1 + sizes[i]] = classes[i]
        score = emissions(c[:, :3], weights)[:, 0] + opening
        steps = np.empty((width, len(lanes), len(LABELS)), np.int8)
        last = np.empty((len(lanes), len(LABELS)))
        ends = sizes[lanes]
        last[ends == 1] = score[ends == 1]
        for t in range(1, width):
            through = score[:, :, None] + moves
            best = through.argmax(axis=1)
            steps[t] = best
            score = np.take_along_axis(through, best[:, None, :], 1)[:, 0] + emissions(c[:, t:t + 3], weights)[:, 0]
            done = ends == t + 1
            last[done] = score[done]
        label = last.argmax(axis=1)
        path = np.zeros((len(lanes), width), np.int8)
        for t in range(width - 1, -1, -1):
            live = ends > t
            path[live, t] = label[live]
            if t:
                label = np.where(live, steps[t, np.arange(len(lanes)), label], label)
        for row, i in enumerate(lanes):
            out[i] = path[row, :sizes[i]]
        at = to
    return out


_AFTER_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_BEFORE_AT = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9][0-9.]*+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, each kind leftmost and without overlap, in time linear in the text."""
    out = []
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _BEFORE_AT:
            start -= 1
        m = _AFTER_AT.match(text, at) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    for run in _DOTTED.finditer(text):
        if run[0].count(".") >= 3:
            for m in _IP.finditer(run[0]):
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                    out.append(("ip", run.start() + m.start(), run.start() + m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = only_digits(m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(only_digits(m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], ORDER[s[0]]))


_SEEN: dict[str, int] = {}


def classes_of(words: list[str]) -> np.ndarray:
    try:
        return np.fromiter(map(_SEEN.__getitem__, words), np.int64, len(words))
    except KeyError:
        if len(_SEEN) > CACHE_WORDS:
            _SEEN.clear()
        for w in words:
            if w not in _SEEN:
                _SEEN[w] = word_class(w)
        return np.fromiter(map(_SEEN.__getitem__, words), np.int64, len(words))


def found_spans(texts: list[str], weights: np.ndarray, moves: np.ndarray) -> list[list[tuple[str, int, int]]]:
    """Spans of the random field in each text."""
    lines, where = [], []
    for i, text in enumerate(texts):
        seen = classes_of(text.split())
        if not len(seen) or not (_BEGIN[seen[:-1], seen[1:]].any() or _BEGIN[CLASSES - 1, seen].any()):
            continue
        start = 0
        for line in text.split("\n"):
            words = line.split()
            if words:
                c = classes_of(words)
                if _BEGIN[c[:-1], c[1:]].any() or _BEGIN[CLASSES - 1, c[0]]:
                    lines.append(c)
                    where.append((i, start, line))
            start += len(line) + 1
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    for labels, (i, start, line) in zip(viterbi(lines, weights, moves), where):
        if not labels.any():
            continue
        places = [m.span() for m in re.finditer(r"\S+", line)]
        if len(places) != len(labels):  # white space that only one of split and \S knows
            continue
        open_span = None
        for k, label in enumerate([*labels, 0]):
            if open_span and (label == 0 or LABELS[label][0] == "B"):
                kind, a, b = open_span
                trimmed = line[a:b].rstrip(".,;:!?)\"'")
                out[i].append((kind, start + a, start + a + len(trimmed)))
                open_span = None
            if label and LABELS[label][0] == "B":
                open_span = (LABELS[label][2:], *places[k])
            elif label and open_span:
                open_span = (open_span[0], open_span[1], places[k][1])
    return out


def all_spans(texts: list[str], model: tuple[np.ndarray, np.ndarray]) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text; a found span that touches a base span is left out."""
    out = []
    for text, extra in zip(texts, found_spans(texts, *model)):
        base = base_spans(text)
        free = [s for s in extra if s[1] < s[2] and all(s[2] <= b[1] or b[2] <= s[1] for b in base)]
        out.append((base, sorted(base + free, key=lambda s: (s[1], ORDER[s[0]]))))
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every document.

    Offsets are code points, end exclusive.  A null or empty text has no spans
    (the digest is of the empty string); repeated rows give equal rows; null
    doc_ids stay null; an empty table gives no rows; other columns are not read.
    """
    small_batches(docs.sparkSession)
    model = trained()  # on the driver, from the fixed table; a few thousand numbers

    def search(batches):
        for b in batches:
            found = all_spans([str(t, "utf-8") for t in byte_slices(b["text"])], model)
            counts = [[sum(s[0] == k for s in base) for base, _ in found] for k in BASE]
            yield pa.record_batch(
                [b["doc_id"], *(pa.array(c, pa.int64()) for c in counts),
                 pa.array([hashlib.sha256(joined(x).encode()).hexdigest() for x, _ in found], pa.string()),
                 pa.array([joined(y) for _, y in found], pa.string())],
                names=["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"])

    text = F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text).mapInArrow(
        search, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in angle brackets; overlapping spans as one."""
    parts, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            parts += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*parts, text[at:]])


def without_personal_data(docs: DataFrame) -> DataFrame:
    """The documents with every span redacted, in the columns of ``docs``; null texts stay null."""
    small_batches(docs.sparkSession)
    model = trained()
    place = docs.columns.index("text")
    schema = docs.schema

    def clean(batches):
        for b in batches:
            texts = [str(t, "utf-8") for t in byte_slices(b.column(place))]
            new = [redacted(t, s) for t, (_, s) in zip(texts, all_spans(texts, model))]
            mask = np.array(b.column(place).is_null())
            column = pa.array([None if m else t for t, m in zip(new, mask)], pa.string())
            yield b.set_column(place, "text", column)
    return docs.mapInArrow(clean, schema)
