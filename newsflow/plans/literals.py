"""Small configuration tables shared by the queries and their oracle SQL.

They play the role of the user-managed tables (sources, templates, labels,
rules) and of model resources (lexicon, keywords, gazetteer).  Each is a
handful of rows; the data the queries process comes from the driver tables.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

T0 = _dt.datetime(2024, 1, 1)
DELETED = _dt.datetime(2024, 1, 15)

TWITTER_SOURCES = {
    "cols": "id bigint, type string, text string, enabled boolean, deleted_at timestamp",
    "rows": [
        (1, "user", "user", True, None),
        (2, "user", "assistant", True, None),
        (3, "search", "the", True, None),
        (4, "search", "UND", True, None),
        (5, "search", "la", False, None),
        (6, "list", "news", True, None),
        (7, "search", "que", True, DELETED),
        (8, "user", "system", True, None),
    ],
}

TEMPLATES = {
    "cols": "id bigint, text string, multi_class boolean, enabled boolean, deleted_at timestamp",
    "rows": [
        (1, "This text is about {}.", False, True, None),
        (2, "The tone of this text is {}.", True, True, None),
        (3, "Disabled {}.", False, False, None),
        (4, "Nothing enabled {}.", False, True, None),
        (5, "Deleted {}.", False, True, DELETED),
    ],
}

LABELS = {
    "cols": "id bigint, zero_shot_hypothesis_template_id bigint, text string, enabled boolean, deleted_at timestamp",
    "rows": [
        (1, 1, "sport", True, None),
        (2, 1, "politics", True, None),
        (3, 1, "science", True, None),
        (4, 1, "economy", True, DELETED),
        (5, 2, "positive", True, None),
        (6, 2, "negative", True, None),
        (7, 3, "anything", True, None),
        (8, 4, "muted", False, None),
        (9, 5, "gone", True, None),
        (10, 1, "entertainment", True, None),
    ],
}

RULES = {
    "cols": "id bigint, label string, question string, answer_regexp string, threshold float, "
            "enabled boolean, deleted_at timestamp",
    "rows": [
        (1, "subject", "What is the text about?", "", 0.25, True, None),
        (2, "about_the", "What is the THE?", "the", 0.5, True, None),
        (3, "french", "Que est la?", "(la|le) ", 0.3, True, None),
        (4, "german", "Was ist der und die?", "und$", 0.0, True, None),
        (5, "off", "Is this off?", "", 0.0, False, None),
        (6, "deleted", "Was it deleted?", "", 0.0, True, DELETED),
    ],
}

# Default text-classifier resource: keyword weights per (type, label).
KEYWORDS = {
    "cols": "type string, label string, keyword string, weight double",
    "rows": [
        ("topic", "sport", "the", 1.0), ("topic", "sport", "and", 0.5),
        ("topic", "culture", "la", 1.0), ("topic", "culture", "le", 1.0),
        ("topic", "culture", "der", 1.0), ("topic", "culture", "die", 0.5),
        ("tone", "neutral", "is", 1.0), ("tone", "neutral", "es", 1.0),
        ("tone", "warm", "en", 2.0), ("tone", "warm", "et", 1.0),
    ],
}

# Default translator resource: (source language, source word) -> English word.
LEXICON = {
    "cols": "lang string, source string, target string",
    "rows": [
        ("fr", "le", "the"), ("fr", "la", "the"), ("fr", "les", "the"), ("fr", "et", "and"),
        ("fr", "des", "of"), ("fr", "en", "in"), ("fr", "de", "of"), ("fr", "un", "a"),
        ("de", "der", "the"), ("de", "die", "the"), ("de", "das", "the"), ("de", "und", "and"),
        ("de", "ein", "a"), ("de", "nicht", "not"), ("de", "für", "for"),
        ("es", "el", "the"), ("es", "la", "the"), ("es", "los", "the"), ("es", "y", "and"),
        ("es", "de", "of"), ("es", "que", "that"), ("es", "en", "in"),
    ],
}

# Gazetteer for the default geo parser: place name -> ISO country code.
GAZETTEER = {
    "cols": "name string, country_code string, kind string, demonym boolean",
    "rows": [
        ("paris", "FR", "city", False), ("berlin", "DE", "city", False),
        ("madrid", "ES", "city", False), ("london", "GB", "city", False),
        ("france", "FR", "country", False), ("germany", "DE", "country", False),
        ("spain", "ES", "country", False), ("united kingdom", "GB", "country", False),
        ("bavaria", "DE", "state", False), ("texas", "US", "state", False),
        ("french", "FR", "country", True), ("german", "DE", "country", True),
        ("spanish", "ES", "country", True), ("english", "GB", "country", True),
        ("the", "GB", "city", True), ("der", "DE", "city", True), ("le", "FR", "city", True),
        ("el", "ES", "city", True), ("und", "DE", "state", False), ("la", "ES", "state", False),
        ("les", "FR", "country", False), ("en", "FR", "state", True),
    ],
}

# FIPS 10-4 -> ISO 3166-1 alpha-2 for the codes the test events use.
COUNTRY_CODES = {
    "cols": "fips string, iso string",
    "rows": [("US", "US"), ("UK", "GB"), ("GM", "DE"), ("FR", "FR"), ("SP", "ES"), ("IT", "IT")],
}

# FIPS codes given to the derived events (indexed by user_id % 8): two are not
# in COUNTRY_CODES ('XX' unknown -> error, '' empty -> NULL country).
EVENT_COUNTRIES = ["US", "UK", "GM", "FR", "SP", "IT", "XX", ""]

# Root codes per driver event type (derived GDELT events).
ROOT_CODES = {"view": "01", "click": "04", "signup": "05", "purchase": "14", "error": "19"}


def frame(spark: SparkSession, table: dict) -> DataFrame:
    return spark.createDataFrame(table["rows"], table["cols"])


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    if isinstance(v, _dt.datetime):
        return f"TIMESTAMP '{v.isoformat(sep=' ')}'"
    return "'" + str(v).replace("'", "''") + "'"


def sql_values(table: dict) -> str:
    """A DuckDB ``SELECT`` over ``VALUES`` with the declared column types."""
    cols = [c.strip().split(" ") for c in table["cols"].split(",")]
    types = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN", "float": "FLOAT",
             "double": "DOUBLE", "timestamp": "TIMESTAMP"}
    rows = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in table["rows"])
    names = ", ".join(f"c{i}" for i in range(len(cols)))
    proj = ", ".join(f"CAST(c{i} AS {types[t]}) AS {n}" for i, (n, t) in enumerate(cols))
    return f"SELECT {proj} FROM (VALUES {rows}) AS v({names})"
