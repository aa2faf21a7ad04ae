"""Language identification by character trigram profiles (SC-1, A-6).

Profiles are fitted from a labelled corpus as the ``top`` most frequent
trigrams per language (rank 1 = most frequent).  A text is classified with
the out-of-place measure of Cavnar & Trenkle (1994): for each of its own
top trigrams, the rank difference to the language profile, or ``top`` when
the trigram is missing; the language with the smallest sum wins, ties go to
the smaller code.  Because the missing-penalty is constant, argmin distance
equals argmax of ``sum(top - |rank_doc - rank_lang|)`` over *matched*
trigrams: a look-up of each trigram in the profiles and a sum for each
language met, both inside the row.  A text with no letters, or without a single matched
trigram, gets NULL (detection failed).

Trigrams are counted by NumPy in Arrow batches: a trigram is three code points
packed into one integer, whose order is that of the strings, so counting is a
sort of integers.  Case and letters are the JVM's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsflow.operators.common import small_batches, spread
from newsflow.operators.side import side_rows

TOP = 300
HELD = 1 << 22  # trigrams a task counts at once
POINT_BITS = 21  # bits of a code point; three fill a trigram's integer


def letters_of(col) -> Column:
    """Lower-case, letters only, single spaces; '' for a text without letters."""
    col = F.col(col) if isinstance(col, str) else col
    return F.trim(F.regexp_replace(F.lower(col), r"[^\p{L}]+", " "))


def normalized_text(col) -> Column:
    """Lower-case, letters only, single spaces, padded with one space each side."""
    letters = letters_of(col)
    return F.when(F.length(letters) > 0, F.concat(F.lit(" "), letters, F.lit(" ")))


def trigrams(col) -> Column:
    """Array of overlapping character trigrams of ``normalized_text`` (whole text).

    One linear regex pass: a zero-width look-ahead captures the three
    characters at every position (indexing a UTF-8 string by position would
    rescan it from the start for every trigram)."""
    s = normalized_text(col)
    return F.regexp_extract_all(s, F.lit("(?=(.{3}))"), 1)


def packed_trigrams(letters: str | None) -> np.ndarray:
    """Every trigram of ``letters_of`` a text, a space before and after it, as integers in text order."""
    if not letters:
        return np.empty(0, np.int64)
    points = np.frombuffer(f" {letters} ".encode("utf-32-le"), "<u4").astype(np.int64)
    return points[:-2] << 2 * POINT_BITS | points[1:-1] << POINT_BITS | points[2:]


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and how often each occurs."""
    codes = np.sort(codes)
    starts = np.flatnonzero(np.diff(codes, prepend=-1))
    return codes[starts], np.diff(np.append(starts, len(codes)))


def trigrams_among(wanted: set[str]):
    """A column function: the distinct trigrams of ``letters_of`` a text that are in ``wanted``, sorted."""
    names = sorted((t for t in wanted if len(t) == 3), key=str.encode)
    codes = np.array([int(packed_trigrams(t)[1]) for t in names], np.int64)

    def one(letters):
        place = np.searchsorted(codes, own := packed_trigrams(letters))
        hit = place < len(codes)
        return [names[k] for k in np.unique(place[hit][codes[place[hit]] == own[hit]])]

    @F.arrow_udf("array<string>")
    def among(letters: pa.Array) -> pa.Array:
        return pa.array([one(x) for x in letters.to_pylist()], pa.list_(pa.string()))
    return among.asNondeterministic()


def trigram_text(code: int) -> str:
    mask = (1 << POINT_BITS) - 1
    return chr(code >> 2 * POINT_BITS) + chr(code >> POINT_BITS & mask) + chr(code & mask)


def trigram_counts(corpus: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, trigram, n): how often each trigram occurs in the texts of a language, whole texts.

    ``HELD`` places are counted at once, so a row for each different trigram of them
    reaches the aggregate, not one for each place of a text.
    """
    small_batches(corpus.sparkSession)

    def partial(own):
        for name, parts in own.items():
            codes, n = counted(np.concatenate(parts))
            yield pa.record_batch([pa.array([name] * len(codes), pa.string()),
                                   pa.array(list(map(trigram_text, codes.tolist())), pa.string()), pa.array(n, pa.int64())],
                                  names=["lang", "trigram", "n"])

    def count(batches):
        own, held = {}, 0
        for b in batches:
            for name, letters in zip(b["lang"].to_pylist(), b["letters"].to_pylist()):
                codes = packed_trigrams(letters)
                own.setdefault(name, []).append(codes)
                held += len(codes)
                if held > HELD:
                    yield from partial(own)
                    own, held = {}, 0
        yield from partial(own)
    rows = spread(corpus.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), text))
    return (rows.select("lang", letters_of(text).alias("letters")).mapInArrow(count, "lang string, trigram string, n long")
            .groupBy("lang", "trigram").agg(F.sum("n").alias("n")))


def fit_language_profiles(corpus: DataFrame, text: str = "text", lang: str = "lang",
                          top: int = TOP) -> DataFrame:
    """-> (lang, trigram, rank) with rank 1..top per language.

    The trigrams are counted inside the tasks before the shuffle; the per-language
    top-k uses a window group limit, so only ``top`` rows per language and
    partition cross the second exchange.
    """
    w = Window.partitionBy("lang").orderBy(F.col("n").desc(), F.col("trigram"))
    return (trigram_counts(corpus, text, lang).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
            .select("lang", "trigram", F.col("rank").cast("int").alias("rank")))


def language_of(profiles: DataFrame, top: int = TOP):
    """A column function: the language of ``letters_of`` a text, as its place in ``language_names``."""
    rows = [r for r in side_rows(profiles.select("trigram", "lang", "rank")) if len(r["trigram"]) == 3]
    names = sorted({r["lang"] for r in rows}, key=str.encode)
    place = {name: k for k, name in enumerate(names)}
    codes = np.array([int(packed_trigrams(r["trigram"])[1]) for r in rows], np.int64)
    order = np.argsort(codes, kind="stable")
    known = codes[order]
    langs = np.array([place[r["lang"]] for r in rows], np.int64)[order]
    ranks = np.array([r["rank"] for r in rows], np.int64)[order]

    def one(letters):
        own, n = counted(packed_trigrams(letters))
        own = own[np.argsort(-n, kind="stable")[:top]]
        lo = np.searchsorted(known, own, "left")
        met = np.searchsorted(known, own, "right") - lo  # entries of each trigram, one a language
        if not met.any():
            return None
        rank = np.repeat(np.arange(1, len(own) + 1), met)
        entry = np.repeat(lo - np.cumsum(met) + met, met) + np.arange(len(rank))
        score = np.zeros(len(names), np.int64)
        np.add.at(score, langs[entry], top - np.abs(rank - ranks[entry]))
        seen = np.unique(langs[entry])
        return int(seen[score[seen].argmax()])

    @F.arrow_udf("int")
    def detect(letters: pa.Array) -> pa.Array:
        return pa.array([one(x) for x in letters.to_pylist()], pa.int32())
    # not deterministic to the optimizer: a filter by the language must not run it once more
    return detect.asNondeterministic()


def language_names(profiles: DataFrame) -> Column:
    """The languages of ``profiles`` in order, one value for the whole plan."""
    return profiles.where(F.char_length("trigram") == 3).select(F.array_sort(F.collect_set("lang"))).scalar()


def detect_language(df: DataFrame, id_col: str, text: str, profiles: DataFrame,
                    out: str = "detected_language", top: int = TOP) -> DataFrame:
    """SC-1: add ``out`` (ISO code or NULL) to every row of ``df``.

    Row by row, over the whole text: the text's own top trigrams, their ranks in the
    profiles, a sum for each language met, the best.  Nothing is exploded, joined or
    shuffled, so any plan stays one pass and keeps its partitioning; ``id_col`` need not
    be unique.  The profile table has at most languages x ``top`` rows; its size is
    checked before it goes to the tasks.
    """
    small_batches(df.sparkSession)
    return df.select(*df.columns, F.get(language_names(profiles), language_of(profiles, top)(letters_of(text))).alias(out))
