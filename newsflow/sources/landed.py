"""Readers for landed feed documents, event exports, tweets and web responses.

Live fetching over the network is not part of this library: the fetchers
land files, these readers turn them into DataFrames, batch or streaming.
All readers take an explicit schema (no inference pass over 100 TB).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.functions.text import go_trim, null_if_empty

# ------------------------------------------------------------------ S-1 feeds

_RSS_ITEM = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("content:encoded", T.StringType()),
    T.StructField("pubDate", T.StringType()),
])
_ATOM_LINK = T.StructType([T.StructField("_href", T.StringType()),
                           T.StructField("_rel", T.StringType())])
_ATOM_ENTRY = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("link", T.ArrayType(_ATOM_LINK)),
    T.StructField("summary", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("published", T.StringType()),
    T.StructField("updated", T.StringType()),
])

FEED_ITEM_COLUMNS = ["source_file", "item_seq", "link", "title", "description", "content",
                     "published_at"]


def parse_feed_date(col) -> F.Column:
    """RSS (RFC 1123, optional weekday) or Atom (RFC 3339) date; bad text -> NULL."""
    text = go_trim(col)
    no_weekday = F.regexp_replace(text, r"^[A-Za-z]{3},\s*", "")
    return F.coalesce(
        F.try_to_timestamp(no_weekday, F.lit("d MMM yyyy HH:mm:ss Z")),
        F.try_to_timestamp(no_weekday, F.lit("d MMM yyyy HH:mm:ss z")),
        F.try_to_timestamp(no_weekday, F.lit("d MMM yyyy HH:mm Z")),
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
        F.try_to_timestamp(text),
    )


def _xml(spark, path, row_tag, schema, stream):
    reader = spark.readStream if stream else spark.read
    return (reader.format("xml").option("rowTag", row_tag).option("mode", "PERMISSIVE")
            .schema(schema).load(path))


def read_feed_items(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """S-1: one row per RSS ``<item>`` or Atom ``<entry>`` of the landed feed files.

    ``source_file`` names the landed file (the feed it came from);
    ``item_seq`` is the position in document order within the file's split,
    used only to pick the first item of a repeated link.  A stream has no
    positions: there it is a hash of the item, so different items differ.
    """
    rss = _xml(spark, path, "item", _RSS_ITEM, stream).select(
        F.col("_metadata.file_path").alias("source_file"),
        go_trim("link").alias("link"),
        F.col("title"), F.col("description"), F.col("`content:encoded`").alias("content"),
        parse_feed_date(F.col("pubDate")).alias("published_at"))
    alt = F.filter(F.col("link"), lambda l: F.coalesce(l["_rel"], F.lit("alternate")) == "alternate")
    atom = _xml(spark, path, "entry", _ATOM_ENTRY, stream).select(
        F.col("_metadata.file_path").alias("source_file"),
        go_trim(F.coalesce(F.get(alt, 0)["_href"], F.get(F.col("link"), 0)["_href"])).alias("link"),
        F.col("title"), F.col("summary").alias("description"), F.col("content"),
        parse_feed_date(F.coalesce(F.col("published"), F.col("updated"))).alias("published_at"))
    out = rss.unionByName(atom)
    if not stream:
        out = out.withColumn("item_seq", F.monotonically_increasing_id())
    else:
        out = out.withColumn("item_seq", F.xxhash64("source_file", "link", "title", "description", "content", "published_at"))
    return out.select(*FEED_ITEM_COLUMNS)


# ------------------------------------------------------------- S-2 GDELT 2.0

# The 61 tab-separated columns of a GDELT 2.0 event export, in file order.
GDELT_COLUMNS = [
    "GlobalEventID", "Day", "MonthYear", "Year", "FractionDate",
    "Actor1Code", "Actor1Name", "Actor1CountryCode", "Actor1KnownGroupCode", "Actor1EthnicCode",
    "Actor1Religion1Code", "Actor1Religion2Code", "Actor1Type1Code", "Actor1Type2Code", "Actor1Type3Code",
    "Actor2Code", "Actor2Name", "Actor2CountryCode", "Actor2KnownGroupCode", "Actor2EthnicCode",
    "Actor2Religion1Code", "Actor2Religion2Code", "Actor2Type1Code", "Actor2Type2Code", "Actor2Type3Code",
    "IsRootEvent", "EventCode", "EventBaseCode", "EventRootCode", "QuadClass",
    "GoldsteinScale", "NumMentions", "NumSources", "NumArticles", "AvgTone",
    "Actor1Geo_Type", "Actor1Geo_FullName", "Actor1Geo_CountryCode", "Actor1Geo_ADM1Code", "Actor1Geo_ADM2Code",
    "Actor1Geo_Lat", "Actor1Geo_Long", "Actor1Geo_FeatureID",
    "Actor2Geo_Type", "Actor2Geo_FullName", "Actor2Geo_CountryCode", "Actor2Geo_ADM1Code", "Actor2Geo_ADM2Code",
    "Actor2Geo_Lat", "Actor2Geo_Long", "Actor2Geo_FeatureID",
    "ActionGeo_Type", "ActionGeo_FullName", "ActionGeo_CountryCode", "ActionGeo_ADM1Code", "ActionGeo_ADM2Code",
    "ActionGeo_Lat", "ActionGeo_Long", "ActionGeo_FeatureID",
    "DATEADDED", "SOURCEURL",
]
GDELT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in GDELT_COLUMNS])

# Columns the normaliser uses; everything else is pruned at the scan.
EVENT_COLUMNS = ["seq", "global_event_id", "source_url", "event_code", "event_base_code",
                 "event_root_code", "date_added", "geo_type", "geo_name", "geo_country",
                 "geo_lat", "geo_long"]


def events_from_export(raw: DataFrame, seq=None) -> DataFrame:
    """Project raw export columns to the event shape used by ``normalize_gdelt_events``."""
    return raw.select(
        (seq if seq is not None else F.col("GlobalEventID").cast("long")).alias("seq"),
        F.col("GlobalEventID").cast("long").alias("global_event_id"),
        F.coalesce(go_trim("SOURCEURL"), F.lit("")).alias("source_url"),
        F.col("EventCode").alias("event_code"), F.col("EventBaseCode").alias("event_base_code"),
        F.col("EventRootCode").alias("event_root_code"), F.col("DATEADDED").alias("date_added"),
        F.col("ActionGeo_Type").alias("geo_type"), F.col("ActionGeo_FullName").alias("geo_name"),
        F.col("ActionGeo_CountryCode").alias("geo_country"),
        F.col("ActionGeo_Lat").cast("double").alias("geo_lat"),
        F.col("ActionGeo_Long").cast("double").alias("geo_long"))


def read_gdelt_events(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """S-2: one export batch (``*.export.CSV``), batch or streaming.

    Arrival order: files carry no row number, so the global event id is the
    order key (a stated decision; see README)."""
    reader = spark.readStream if stream else spark.read
    raw = (reader.format("csv").option("sep", "\t").option("header", "false")
           .option("quote", "").option("mode", "PERMISSIVE").schema(GDELT_SCHEMA).load(path))
    return events_from_export(raw)


# ------------------------------------------------------------------ S-3 tweets

TWEET_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("text", T.StringType()),
    T.StructField("time", T.TimestampType()), T.StructField("username", T.StringType()),
    T.StructField("user_id", T.StringType()), T.StructField("permanent_url", T.StringType()),
    T.StructField("photos", T.ArrayType(T.StringType())),
    T.StructField("query", T.StringType()),
])


def read_tweets(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """S-3 (scan part): landed tweets as JSON lines."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(TWEET_SCHEMA).json(path)


# --------------------------------------------------------- S-4 web responses

WEB_RESPONSE_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()), T.StructField("status", T.IntegerType()),
    T.StructField("content_type", T.StringType()), T.StructField("body", T.BinaryType()),
    T.StructField("fetched_at", T.TimestampType()),
])


def read_web_responses(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """S-4: landed HTTP responses (parquet, one row per fetched URL)."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(WEB_RESPONSE_SCHEMA).parquet(path)


def response_text(responses: DataFrame) -> DataFrame:
    """S-4 + F-6 + F-7 + SC-7: split responses into
    ``outcome`` = 'error' (status != 200, retried), 'skip' (not text/html or
    empty body), 'ok' (decoded, trimmed ``text``; NULL unless ok)."""
    from newsflow.functions.text import charset_of, decode_charset, is_text_or_html
    staged = responses.withColumn(
        "outcome", F.when(F.col("status") != 200, F.lit("error"))
                    .when(~is_text_or_html("content_type"), F.lit("skip")).otherwise(F.lit("ok")))
    staged = staged.withColumn("_cs", F.when(F.col("outcome") == "ok", charset_of("content_type", "body")))
    staged = staged.withColumn("text", F.when(F.col("outcome") == "ok",
                                              go_trim(decode_charset("body", "_cs"))))
    empty = (F.col("outcome") == "ok") & (F.coalesce(F.length("text"), F.lit(0)) == 0)
    return (staged.withColumn("outcome", F.when(empty, F.lit("skip")).otherwise(F.col("outcome")))
            .withColumn("text", F.when(F.col("outcome") == "ok", F.col("text")))
            .drop("_cs"))
