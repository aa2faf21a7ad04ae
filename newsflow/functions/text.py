"""Scalar text functions and predicates (F-2..F-10, P-5, P-6, P-9, P-11, SC-2..SC-4, SC-13, SC-14).

All of them return ``Column`` expressions built from ``pyspark.sql.functions``
so they stay inside whole-stage codegen and are pushed down where possible.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

import pandas as pd
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters a Unicode-aware TrimSpace strips (the Unicode
# White_Space property): TAB, LF, VT, FF, CR, SPACE, U+0085 NEL, U+00A0 NBSP,
# U+1680, U+2000..U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
WHITE_SPACE = ("\t\n\x0b\x0c\r \u0085\u00a0\u1680"
               + "".join(chr(c) for c in range(0x2000, 0x200B))
               + "\u2028\u2029\u202f\u205f\u3000")

# The languages the geo service understands, and the upper-case
# codes it expects for them.
GEO_LANGUAGES = {"de": "DE", "es": "ES", "en": "EN"}

RFC3339 = "yyyy-MM-dd'T'HH:mm:ssXXX"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def go_trim(col) -> Column:
    """SC-2: strip Unicode white space at both ends (plain ``trim`` only strips ' ')."""
    return F.btrim(_c(col), F.lit(WHITE_SPACE))


def null_if_empty(col) -> Column:
    """P-9: empty string -> NULL (NULL stays NULL)."""
    return F.nullif(_c(col), F.lit(""))


def effective_title(title="title", translated="translated_title") -> Column:
    """P-5: trimmed translated title when it is not NULL (even if blank), else trimmed title."""
    return go_trim(F.coalesce(_c(translated), _c(title)))


def has_text(col) -> Column:
    """F-8 / F-10: non-empty after Unicode trim (NULL -> false)."""
    return F.coalesce(F.length(go_trim(col)) > 0, F.lit(False))


def geo_text(title="title", language="language", translated="translated_title",
             translation_language="translation_language") -> Column:
    """P-6: struct(text, lang) the geo parser runs on, or NULL.

    The original title wins when its language is supported and it is not
    blank; else the translation under the same conditions.
    """
    def lang_code(c):
        expr = F.lit(None).cast("string")
        for k, v in GEO_LANGUAGES.items():
            expr = F.when(_c(c) == k, F.lit(v)).otherwise(expr)
        return expr

    orig_ok = _c(language).isin(*GEO_LANGUAGES) & has_text(title)
    trans_ok = _c(translation_language).isin(*GEO_LANGUAGES) & has_text(translated)
    return (F.when(orig_ok, F.struct(go_trim(title).alias("text"), lang_code(language).alias("lang")))
            .when(trans_ok, F.struct(go_trim(translated).alias("text"),
                                     lang_code(translation_language).alias("lang"))))


def utc_literal(ts: _dt.datetime) -> Column:
    """A timestamp literal; a datetime without zone is UTC, whatever the zone of the driver's machine."""
    return F.lit(ts if ts.tzinfo else ts.replace(tzinfo=_dt.timezone.utc))


def not_older_than(col, cutoff: _dt.datetime | None) -> Column:
    """F-2: keep unless a cut-off is set AND the date is known AND it is strictly older."""
    if cutoff is None:
        return F.lit(True)
    return ~F.coalesce(_c(col) < utc_literal(cutoff), F.lit(False))


def language_allowed(col, langs: Iterable[str]) -> Column:
    """F-3: allow-list where an empty list allows nothing."""
    langs = list(langs)
    if not langs:
        return F.lit(False)
    return F.coalesce(_c(col).isin(*langs), F.lit(False))


def code_allowed(col, codes: Iterable[str]) -> Column:
    """F-5: event root-code white-list where an empty list allows everything."""
    codes = list(codes)
    if not codes:
        return F.lit(True)
    return F.coalesce(_c(col).isin(*codes), F.lit(False))


def is_text_or_html(col) -> Column:
    """F-6 / SC-4: content type mentions text or html, case-insensitively; NULL -> false."""
    low = F.lower(_c(col))
    return F.coalesce(low.contains("text") | low.contains("html"), F.lit(False))


def rfc3339(col) -> Column:
    """P-11 / SC-14: RFC 3339 text of a timestamp; NULL -> ''."""
    return F.coalesce(F.date_format(_c(col), RFC3339), F.lit(""))


def parse_rfc3339(col) -> Column:
    """P-11 / SC-14: '' -> NULL time, else parse (bad text -> NULL)."""
    return F.try_to_timestamp(null_if_empty(col), F.lit(RFC3339))


def parse_id(col) -> Column:
    """SC-15: struct(id, error) of a numeric id written as text.

    Only unsigned decimal digits that fit a signed 64-bit id parse (no sign,
    no white space, no fraction).  Anything else keeps ``id`` NULL and puts
    the reason in ``error``, so one bad row is an isolated error instead of a
    failed job; NULL text is neither an id nor an error.
    """
    c = _c(col)
    digits = c.rlike(r"^[0-9]{1,19}\z")  # \z: Java's $ also matches before a final newline
    parsed = F.when(digits, c.try_cast("bigint"))
    err = F.when(c.isNotNull() & parsed.isNull(), F.concat(F.lit("invalid id: "), c))
    return F.struct(parsed.alias("id"), err.alias("error"))


def unescape_html(col) -> Column:
    """Character references decoded: numeric ones, and the named ones of HTML 4 (the standard library's table).

    Only references that a text holds are looked up.  A number that is no code point gives
    U+FFFD, an unknown name stays as it is.  The ampersand comes last, so its result is
    not read as the start of an other reference.
    """
    x = _c(col)
    found = F.array_distinct(F.regexp_extract_all(x, F.lit(r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z]{2,8}[0-9]{0,2});"), 1))
    names = F.create_map(*[F.lit(v) for name, point in sorted(name2codepoint.items()) if name != "amp"
                           for v in (name, chr(point))], F.lit("apos"), F.lit("'"))

    def character(ref):
        point = F.when(F.lower(F.substring(ref, 2, 1)) == "x", F.conv(F.substring(ref, 3, 8), 16, 10)) \
            .otherwise(F.substring(ref, 2, 8)).cast("long")
        valid = ((point > 0) & (point < 0xD800)) | ((point > 0xDFFF) & (point < 0x110000))
        utf32 = F.unhex(F.lpad(F.hex(F.when(valid, point).otherwise(F.lit(0xFFFD))), 8, "0"))
        return F.when(F.substring(ref, 1, 1) != "#", F.element_at(names, ref)).when(point != 38, F.decode(utf32, "UTF-32"))
    out = F.aggregate(found, x, lambda acc, ref: F.replace(
        acc, F.concat(F.lit("&"), ref, F.lit(";")), F.coalesce(character(ref), F.concat(F.lit("&"), ref, F.lit(";")))))
    return F.regexp_replace(F.when(F.size(found) > 0, out).otherwise(x), "&(amp|#0*38|#[xX]0*26);", "&")


def _meta(html, name: str) -> Column:
    """``content`` of the <meta> with this property, whichever attribute comes first; '' where there is none."""
    prop, content = rf"""property\s*=\s*["']{name}["']""", r"""content\s*=\s*["']([^"']*)["']"""
    after = F.regexp_extract(_c(html), rf"(?is)<meta\s+[^>]*{prop}[^>]*{content}", 1)
    before = F.regexp_extract(_c(html), rf"(?is)<meta\s+[^>]*{content}[^>]*{prop}", 1)
    return F.when(after != "", after).otherwise(before)


def html_title(html="html") -> Column:
    """SC-13: document title, entity-decoded and trimmed ('' when absent)."""
    raw = F.regexp_extract(_c(html), r"(?is)<title[^>]*>(.*?)</title>", 1)
    return go_trim(unescape_html(raw))


def html_top_image(html="html") -> Column:
    """SC-13: og:image content, NULL when missing or empty."""
    raw = _meta(html, "og:image")
    return null_if_empty(go_trim(unescape_html(raw)))


def html_publish_date(html="html") -> Column:
    """SC-13: article:published_time meta or the first <time datetime>, as a timestamp."""
    meta = _meta(html, "article:published_time")
    tag = F.regexp_extract(_c(html), r"""(?is)<time\s+[^>]*datetime\s*=\s*["']([^"']*)["']""", 1)
    text = F.coalesce(null_if_empty(meta), null_if_empty(tag))
    return F.coalesce(F.try_to_timestamp(text, F.lit(RFC3339)), F.try_to_timestamp(text))


def html_fields(html="html") -> Column:
    """SC-13: struct(title, top_image, publish_date) of a page."""
    return F.struct(html_title(html).alias("title"), html_top_image(html).alias("top_image"),
                    html_publish_date(html).alias("publish_date"))


# ---------------------------------------------------------------- SC-7 decode

# Charsets Spark's built-in ``decode`` accepts.
NATIVE_CHARSETS = ("UTF-8", "US-ASCII", "ISO-8859-1", "UTF-16BE", "UTF-16LE", "UTF-16", "UTF-32")
_ALIASES = {"LATIN1": "ISO-8859-1", "LATIN-1": "ISO-8859-1", "ASCII": "US-ASCII",
            "UTF8": "UTF-8", "ISO8859-1": "ISO-8859-1"}


def charset_of(content_type="content_type", body="body") -> Column:
    """Charset named by the Content-Type header, else by a <meta charset>, else UTF-8."""
    from_header = F.regexp_extract(_c(content_type), r"(?i)charset\s*=\s*[\"']?([A-Za-z0-9._:-]+)", 1)
    head = F.decode(F.substring(_c(body), 1, 1024), "ISO-8859-1")
    from_meta = F.regexp_extract(head, r"(?i)<meta[^>]+charset\s*=\s*[\"']?([A-Za-z0-9._:-]+)", 1)
    cs = F.upper(F.coalesce(null_if_empty(from_header), null_if_empty(from_meta), F.lit("UTF-8")))
    out = cs
    for k, v in _ALIASES.items():
        out = F.when(cs == k, F.lit(v)).otherwise(out)
    return out


@F.pandas_udf(T.StringType())
def _decode_other(body: pd.Series, charset: pd.Series) -> pd.Series:
    def one(b, cs):
        if b is None:
            return None
        try:
            return bytes(b).decode(cs, errors="replace")
        except LookupError:
            return bytes(b).decode("utf-8", errors="replace")
    return pd.Series([one(b, c) for b, c in zip(body, charset)], dtype=object)


# Further web charsets the JVM decodes when the session allows
# Java charsets (``spark.sql.legacy.javaCharsets``).
JAVA_WEB_CHARSETS = (
    "WINDOWS-1250", "WINDOWS-1251", "WINDOWS-1252", "WINDOWS-1253", "WINDOWS-1254", "WINDOWS-1255",
    "WINDOWS-1256", "WINDOWS-1257", "WINDOWS-1258", "ISO-8859-2", "ISO-8859-3", "ISO-8859-4", "ISO-8859-5",
    "ISO-8859-6", "ISO-8859-7", "ISO-8859-8", "ISO-8859-9", "ISO-8859-13", "ISO-8859-15", "KOI8-R", "KOI8-U",
    "SHIFT_JIS", "EUC-JP", "ISO-2022-JP", "GBK", "GB2312", "GB18030", "BIG5", "EUC-KR", "IBM866",
)


# Web rule: the labels of ASCII and Latin-1 mean windows-1252.  Its 0x80-0x9F, where defined; the rest stays as it is.
LATIN = ("US-ASCII", "ISO-8859-1", "WINDOWS-1252")
_C1 = [chr(b) for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
_C1_MEANT = [c.encode("latin-1").decode("cp1252") for c in _C1]


def _java_replaces() -> bool:
    """Whether the session's ``decode`` knows the web charsets and replaces malformed bytes instead of ending the job."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    return spark is not None and all(spark.conf.get(f"spark.sql.legacy.{k}", "false").lower() == "true"
                                     for k in ("javaCharsets", "codingErrorAction"))


def decode_charset(body="body", charset="charset") -> Column:
    """SC-7 with a known charset column; a malformed byte is replaced in every charset.

    UTF-8 and the Latin labels are decoded on the JVM in any session.  The others are
    too where the session allows Java charsets and their error replacement (unknown
    names are read as UTF-8); elsewhere they go to the Arrow-batched Python decoder,
    which sees NULL bodies for every other row."""
    cs = _c(charset)
    latin = F.translate(F.decode(_c(body), "ISO-8859-1"), "".join(_C1), "".join(_C1_MEANT))
    known = F.when(cs.isin(*LATIN), latin)
    valid = F.make_valid_utf8(_c(body).cast("string"))
    others = [c for c in (*NATIVE_CHARSETS, *JAVA_WEB_CHARSETS) if c not in LATIN and c != "UTF-8"]
    if _java_replaces():
        return known.when(cs.isin(*others), F.call_function("decode", _c(body), cs)).otherwise(valid)
    jvm = cs.isin(*LATIN, "UTF-8")
    return known.when(jvm, valid).otherwise(_decode_other(F.when(~jvm, _c(body)), cs))


def decode_body(body="body", content_type="content_type") -> Column:
    """SC-7: bytes -> text with the charset sniffed from header or body."""
    return decode_charset(body, charset_of(content_type, body))
