"""Schema registry of the sixteen model tables (C-6).

Every table but ``pending_jobs`` starts with the common header
``id, created_at, updated_at, version``.  ``?`` columns are nullable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_L, _S, _B, _I, _F, _D, _TS = (T.LongType(), T.StringType(), T.BooleanType(),
                               T.IntegerType(), T.FloatType(), T.DoubleType(),
                               T.TimestampType())


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


HEADER = [_f("id", _L, False), _f("created_at", _TS), _f("updated_at", _TS),
          _f("version", _L, False)]

POINT = T.StructType([_f("x", _D), _f("y", _D)])
LOCATION = T.StructType([_f("countryCode", _S), _f("score", _D)])
GEO_REPLY = T.StructType([_f("results", T.StructType([_f("places", T.StructType([
    _f("focus", T.StructType([_f("cities", T.ArrayType(LOCATION)),
                              _f("countries", T.ArrayType(LOCATION)),
                              _f("states", T.ArrayType(LOCATION))]))]))]))])


def _table(*fields, header=True):
    return T.StructType((HEADER if header else []) + list(fields))


SCHEMAS: dict[str, T.StructType] = {
    "web_resources": _table(_f("url", _S, False)),
    "web_articles": _table(
        _f("web_resource_id", _L, False), _f("title", _S, False), _f("top_image", _S),
        _f("scraped_publish_date", _TS), _f("language", _S, False),
        _f("publish_date", _TS, False), _f("translated_title", _S),
        _f("translation_language", _S), _f("country_code", _S)),
    "feeds": _table(
        _f("deleted_at", _TS), _f("url", _S, False), _f("enabled", _B, False),
        _f("last_retrieved_at", _TS), _f("failures_count", _I, False), _f("last_error", _S)),
    "feed_items": _table(
        _f("feed_id", _L, False), _f("web_resource_id", _L, False), _f("title", _S),
        _f("description", _S), _f("content", _S), _f("language", _S), _f("published_at", _TS)),
    "gdelt_events": _table(
        _f("web_resource_id", _L, False), _f("global_event_id", _L, False),
        _f("date_added", _TS, False), _f("location_type", _S), _f("location_name", _S),
        _f("country_code", _S), _f("coordinates", POINT), _f("event_categories", T.ArrayType(_S))),
    "twitter_sources": _table(
        _f("deleted_at", _TS), _f("type", _S, False), _f("text", _S, False),
        _f("enabled", _B, False), _f("last_retrieved_at", _TS),
        _f("failures_count", _I, False), _f("last_error", _S)),
    "tweets": _table(
        _f("twitter_source_id", _L, False), _f("web_resource_id", _L, False),
        _f("upstream_id", _S, False), _f("text", _S), _f("published_at", _TS),
        _f("username", _S), _f("user_id", _S)),
    "pending_jobs": _table(_f("id", _S, False), _f("created_at", _TS), _f("data", _S),
                           header=False),
    "zero_shot_classes": _table(
        _f("web_article_id", _L, False), _f("zero_shot_hypothesis_label_id", _L, False),
        _f("zero_shot_hypothesis_template_id", _L, False), _f("best", _B, False),
        _f("confidence", _F, False)),
    "text_classes": _table(
        _f("web_article_id", _L, False), _f("type", _S, False), _f("label", _S, False),
        _f("confidence", _F, False)),
    "vectors": _table(
        _f("web_article_id", _L, False), _f("data", T.ArrayType(_F), False),
        _f("publish_day", T.DateType(), False)),
    "similarity_infos": _table(
        _f("web_article_id", _L, False), _f("parent_id", _L), _f("distance", _F)),
    "extracted_infos": _table(
        _f("web_article_id", _L, False), _f("info_extraction_rule_id", _L, False),
        _f("text", _S, False), _f("confidence", _F, False)),
    "zero_shot_hypothesis_templates": _table(
        _f("deleted_at", _TS), _f("enabled", _B, False), _f("text", _S, False),
        _f("multi_class", _B, False)),
    "zero_shot_hypothesis_labels": _table(
        _f("deleted_at", _TS), _f("zero_shot_hypothesis_template_id", _L, False),
        _f("enabled", _B, False), _f("text", _S, False)),
    "info_extraction_rules": _table(
        _f("deleted_at", _TS), _f("label", _S, False), _f("question", _S, False),
        _f("answer_regexp", _S, False), _f("threshold", _F, False), _f("enabled", _B, False)),
}

# Unique keys, enforced by K-1 (insert_if_absent) on every append.
UNIQUE_KEYS: dict[str, list[list[str]]] = {
    "web_resources": [["url"]],
    "web_articles": [["web_resource_id"]],
    "feeds": [["url"]],
    "feed_items": [["web_resource_id"]],
    "gdelt_events": [["web_resource_id"], ["global_event_id"]],
    "twitter_sources": [["type", "text"]],
    "tweets": [["web_resource_id"], ["upstream_id"]],
    "pending_jobs": [["id"]],
    "zero_shot_classes": [["web_article_id", "zero_shot_hypothesis_label_id"]],
    "text_classes": [["web_article_id", "type", "label"]],
    "vectors": [["web_article_id"]],
    "similarity_infos": [["web_article_id"]],
    "extracted_infos": [["web_article_id", "info_extraction_rule_id"]],
    "zero_shot_hypothesis_labels": [["zero_shot_hypothesis_template_id", "text"]],
    "info_extraction_rules": [["label"]],
}

SOFT_DELETE = {"feeds", "twitter_sources", "info_extraction_rules",
               "zero_shot_hypothesis_labels", "zero_shot_hypothesis_templates"}


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[name])


def read_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Scan a stored model table with its declared schema (S-5).

    Soft-deleted rows are hidden, as every read of those tables does.
    """
    df = spark.read.schema(SCHEMAS[name]).parquet(path)
    if name in SOFT_DELETE:
        df = df.where("deleted_at IS NULL")
    return df


def conform(df: DataFrame, name: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Cast and order ``df`` to the declared schema (and ``extra`` columns); missing columns are NULL."""
    from pyspark.sql import functions as F
    cols = []
    for field in SCHEMAS[name].fields:
        if field.name in df.columns:
            cols.append(F.col(field.name).cast(field.dataType).alias(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*cols, *extra)
