"""Model tables derived from the driver's parquet tables.

Each derived table has a DataFrame form (used by the queries) and a DuckDB
SQL form (used by the oracle SQL); both compute the same rows.  The
mapping is documented in FIXTURES.md section 3.  Driver timestamps load as
``timestamp_ntz`` and are cast to ``timestamp`` (session time zone UTC).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.plans import literals as L

EPOCH_2024 = 1704067200      # 2024-01-01 00:00:00 UTC
EPOCH_FEB = 1706745600       # 2024-02-01 00:00:00 UTC


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def one_line(col, gap: str = " ") -> F.Column:
    """The whole text, its line breaks turned into ``gap``."""
    return F.replace(F.col(col) if isinstance(col, str) else col, F.lit("\n"), F.lit(gap))


def _day(n) -> F.Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))


# ---------------------------------------------------------------- feeds

def incoming_feed_items(spark, d) -> DataFrame:
    doc = raw(spark, d, "documents")
    return doc.select(
        F.col("doc_id").alias("item_seq"),
        F.substring("source", 4, 100).cast("long").alias("feed_id"),
        F.concat(F.lit("https://n.example/"), (F.col("doc_id") % 700).cast("string")).alias("url"),
        one_line("text").alias("title"),
        F.lit("").alias("description"), F.col("text").alias("content"),
        F.col("lang").alias("language"),
        F.when(F.col("doc_id") % 11 == 0, F.lit(None).cast("timestamp"))
         .otherwise(_day(F.col("doc_id") % 30).cast("timestamp")).alias("published_at"))


SQL_INCOMING_FEED_ITEMS = """
SELECT doc_id AS item_seq, CAST(substr(source, 4) AS BIGINT) AS feed_id,
       'https://n.example/' || CAST(doc_id % 700 AS VARCHAR) AS url,
       replace(text, chr(10), ' ') AS title, '' AS description, text AS content, lang AS language,
       CASE WHEN doc_id % 11 = 0 THEN NULL
            ELSE CAST(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS TIMESTAMP) END AS published_at
FROM documents"""


def feeds(spark, d) -> DataFrame:
    doc = raw(spark, d, "documents")
    f = doc.select(F.substring("source", 4, 100).cast("long").alias("id"), "source").distinct()
    return f.select(
        "id", F.lit(L.T0).cast("timestamp").alias("created_at"), F.lit(L.T0).cast("timestamp").alias("updated_at"),
        F.lit(0).cast("long").alias("version"), F.lit(None).cast("timestamp").alias("deleted_at"),
        F.concat(F.lit("https://feeds.example/"), F.col("source")).alias("url"),
        (F.col("id") % 7 != 0).alias("enabled"), F.lit(None).cast("timestamp").alias("last_retrieved_at"),
        F.lit(0).alias("failures_count"), F.lit(None).cast("string").alias("last_error"))


SQL_FEEDS = """
SELECT id, TIMESTAMP '2024-01-01 00:00:00' AS created_at, TIMESTAMP '2024-01-01 00:00:00' AS updated_at,
       CAST(0 AS BIGINT) AS version, CAST(NULL AS TIMESTAMP) AS deleted_at,
       'https://feeds.example/' || source AS url, id % 7 <> 0 AS enabled,
       CAST(NULL AS TIMESTAMP) AS last_retrieved_at, 0 AS failures_count, CAST(NULL AS VARCHAR) AS last_error
FROM (SELECT DISTINCT CAST(substr(source, 4) AS BIGINT) AS id, source FROM documents)"""


def fetch_attempts(spark, d) -> DataFrame:
    ev = raw(spark, d, "events")
    failed = F.col("event_type").isin("error", "click")
    return ev.select(F.col("user_id").alias("source_id"), F.col("event_id").alias("seq"),
                     F.col("ts").cast("timestamp").alias("attempted_at"), failed.alias("failed"),
                     F.when(failed, F.concat(F.lit("fetch failed: "), F.col("event_type"))).alias("error"))


SQL_FETCH_ATTEMPTS = """
SELECT user_id AS source_id, event_id AS seq, ts AS attempted_at, event_type IN ('error', 'click') AS failed,
       CASE WHEN event_type IN ('error', 'click') THEN 'fetch failed: ' || event_type END AS error
FROM events"""


# ---------------------------------------------------------------- events / resources

def _root_code(col) -> F.Column:
    out = F.lit(None).cast("string")
    for k, v in L.ROOT_CODES.items():
        out = F.when(col == k, F.lit(v)).otherwise(out)
    return out


def _sql_root_code(col: str) -> str:
    return "CASE " + " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in L.ROOT_CODES.items()) + " END"


def _sql_country(col: str) -> str:
    return "CASE " + " ".join(f"WHEN {col} = {i} THEN '{c}'" for i, c in enumerate(L.EVENT_COUNTRIES)) + " END"


def incoming_events(spark, d) -> DataFrame:
    ev = raw(spark, d, "events")
    root = _root_code(F.col("event_type"))
    country = F.lit(None).cast("string")
    for i, c in enumerate(L.EVENT_COUNTRIES):
        country = F.when(F.col("user_id") % 8 == i, F.lit(c)).otherwise(country)
    code = F.concat(root, (F.col("user_id") % 10).cast("string"))
    return ev.select(
        F.col("event_id").alias("seq"), F.col("event_id").alias("global_event_id"),
        F.concat(F.lit("https://n.example/"), ((F.col("user_id") * 7) % 900).cast("string")).alias("source_url"),
        code.alias("event_code"), code.alias("event_base_code"), root.alias("event_root_code"),
        F.when(F.col("value") < 1, F.lit("not-a-date"))
         .otherwise(F.date_format("ts", "yyyyMMddHHmmss")).alias("date_added"),
        (F.col("user_id") % 6).cast("string").alias("geo_type"),
        F.when(F.col("user_id") % 6 == 0, F.lit("")).otherwise(
            F.concat(F.lit("Place "), F.col("user_id").cast("string"))).alias("geo_name"),
        country.alias("geo_country"),
        F.when(F.col("event_type") == "view", F.lit(None).cast("double")).otherwise(F.col("value") % 90).alias("geo_lat"),
        (F.col("value") % 180).alias("geo_long"),
        F.col("ts").cast("timestamp").alias("ts"))


SQL_INCOMING_EVENTS = f"""
SELECT event_id AS seq, event_id AS global_event_id,
       'https://n.example/' || CAST((user_id * 7) % 900 AS VARCHAR) AS source_url,
       {_sql_root_code('event_type')} || CAST(user_id % 10 AS VARCHAR) AS event_code,
       {_sql_root_code('event_type')} || CAST(user_id % 10 AS VARCHAR) AS event_base_code,
       {_sql_root_code('event_type')} AS event_root_code,
       CASE WHEN value < 1 THEN 'not-a-date' ELSE strftime(ts, '%Y%m%d%H%M%S') END AS date_added,
       CAST(user_id % 6 AS VARCHAR) AS geo_type,
       CASE WHEN user_id % 6 = 0 THEN '' ELSE 'Place ' || CAST(user_id AS VARCHAR) END AS geo_name,
       {_sql_country('user_id % 8')} AS geo_country,
       CASE WHEN event_type = 'view' THEN NULL ELSE value % 90 END AS geo_lat,
       value % 180 AS geo_long, ts
FROM events"""


def stored_resources(spark, d) -> DataFrame:
    """Resources landed before 2024-01-02 (one per distinct event URL), ids by URL order."""
    ev = incoming_events(spark, d).where(F.col("ts") < F.lit("2024-01-02 00:00:00").cast("timestamp"))
    urls = ev.select(F.col("source_url").alias("url")).distinct()
    from pyspark.sql.window import Window
    return urls.select(F.dense_rank().over(Window.orderBy("url")).cast("long").alias("id"),
                       F.lit(L.T0).cast("timestamp").alias("created_at"), "url")


SQL_STORED_RESOURCES = """
SELECT CAST(dense_rank() OVER (ORDER BY url) AS BIGINT) AS id, TIMESTAMP '2024-01-01 00:00:00' AS created_at, url
FROM (SELECT DISTINCT source_url AS url FROM incoming_events WHERE ts < TIMESTAMP '2024-01-02 00:00:00')"""


def stored_gdelt_events(spark, d) -> DataFrame:
    """GDELT events already stored: those of resources whose first event was before noon of day 1."""
    ev = incoming_events(spark, d).where(F.col("ts") < F.lit("2024-01-01 12:00:00").cast("timestamp"))
    r = stored_resources(spark, d)
    return (ev.select(F.col("source_url").alias("url")).distinct().join(r, "url")
            .select(F.col("id").alias("web_resource_id")))


SQL_STORED_GDELT_EVENTS = """
SELECT r.id AS web_resource_id
FROM (SELECT DISTINCT source_url AS url FROM incoming_events WHERE ts < TIMESTAMP '2024-01-01 12:00:00') e
JOIN stored_resources r USING (url)"""


def stored_feed_items(spark, d) -> DataFrame:
    """Feed items already stored: those of labelled documents whose URL is a stored resource."""
    fi = incoming_feed_items(spark, d)
    lab = raw(spark, d, "labels").select(F.col("doc_id").alias("item_seq"))
    r = stored_resources(spark, d)
    return (fi.join(lab, "item_seq", "left_semi").select("url").distinct().join(r, "url")
            .select(F.col("id").alias("web_resource_id")))


SQL_STORED_FEED_ITEMS = """
SELECT DISTINCT r.id AS web_resource_id
FROM incoming_feed_items f JOIN stored_resources r USING (url)
WHERE f.item_seq IN (SELECT doc_id FROM labels)"""


# ---------------------------------------------------------------- tweets

def incoming_tweets(spark, d) -> DataFrame:
    cv = raw(spark, d, "conversations")
    up = (F.col("conv_id") * 100 + F.col("turn")).cast("string")
    return cv.select(
        up.alias("upstream_id"), "text",
        F.timestamp_seconds(F.lit(EPOCH_2024) + F.col("conv_id") * 3600 + F.col("turn") * 60).alias("published_at"),
        F.col("role").alias("username"), F.concat(F.lit("u-"), F.col("role")).alias("user_id"),
        F.concat(F.lit("https://t.example/"), F.col("role"), F.lit("/status/"), up).alias("permanent_url"),
        F.when(F.col("turn") % 3 == 0, F.array(F.concat(F.lit("https://img.example/"), up, F.lit(".jpg"))))
         .otherwise(F.array().cast("array<string>")).alias("photos"))


SQL_INCOMING_TWEETS = """
SELECT CAST(conv_id * 100 + turn AS VARCHAR) AS upstream_id, text,
       make_timestamp(CAST((1704067200 + conv_id * 3600 + turn * 60) AS BIGINT) * 1000000) AS published_at,
       role AS username, 'u-' || role AS user_id,
       'https://t.example/' || role || '/status/' || CAST(conv_id * 100 + turn AS VARCHAR) AS permanent_url,
       CASE WHEN turn % 3 = 0 THEN ['https://img.example/' || CAST(conv_id * 100 + turn AS VARCHAR) || '.jpg']
            ELSE CAST([] AS VARCHAR[]) END AS photos
FROM conversations"""


# ---------------------------------------------------------------- pages

def page_resources(spark, d) -> DataFrame:
    pg = raw(spark, d, "pages")
    return pg.select(F.col("page_id").alias("id"),
                     F.timestamp_seconds(F.lit(EPOCH_FEB) + F.col("page_id")).alias("created_at"), "url")


SQL_PAGE_RESOURCES = """
SELECT page_id AS id, make_timestamp(CAST(1706745600 + page_id AS BIGINT) * 1000000) AS created_at, url FROM pages"""


def page_texts(spark, d) -> DataFrame:
    """Fetched pages as (web_resource_id, text): status 200, text/html, UTF-8 body."""
    from newsflow.sources.landed import response_text
    pg = raw(spark, d, "pages")
    responses = pg.select(F.col("page_id").alias("web_resource_id"), "url", F.lit(200).alias("status"),
                          F.lit("text/html; charset=utf-8").alias("content_type"),
                          F.encode("html", "UTF-8").alias("body"))
    return response_text(responses).where("outcome = 'ok'").select("web_resource_id", "text")


# ---------------------------------------------------------------- vectors

def vectors(spark, d) -> DataFrame:
    e = raw(spark, d, "embeddings")
    return e.select(F.col("vec_id").alias("web_article_id"), F.col("embedding").alias("data"),
                    _day(F.col("vec_id") % 10).alias("publish_day"), "label")


SQL_VECTORS = """
SELECT vec_id AS web_article_id, embedding AS data,
       DATE '2024-01-01' + CAST(vec_id % 10 AS INTEGER) AS publish_day, label
FROM embeddings"""


def vector_articles(spark, d) -> DataFrame:
    """Articles of the vectors: published on the vector's day, seconds = id."""
    v = vectors(spark, d)
    return v.select(F.col("web_article_id").alias("id"),
                    F.timestamp_seconds(F.unix_seconds(F.col("publish_day").cast("timestamp"))
                                        + F.col("web_article_id") % 86400).alias("publish_date"))


# ---------------------------------------------------------------- articles

def doc_articles(spark, d) -> DataFrame:
    """web_articles of the documents: the whole text as title, and as translation of those that are not English."""
    doc = raw(spark, d, "documents")
    return doc.select(
        F.col("doc_id").alias("id"), F.col("doc_id").alias("web_resource_id"), one_line("text").alias("title"),
        F.col("lang").alias("language"),
        _day(F.col("doc_id") % 30).cast("timestamp").alias("publish_date"),
        F.when(F.col("lang") != "en", one_line("text", " / ")).alias("translated_title"),
        F.when(F.col("lang") != "en", F.lit("en")).alias("translation_language"))


SQL_DOC_ARTICLES = """
SELECT doc_id AS id, doc_id AS web_resource_id, replace(text, chr(10), ' ') AS title, lang AS language,
       CAST(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS TIMESTAMP) AS publish_date,
       CASE WHEN lang <> 'en' THEN replace(text, chr(10), ' / ') END AS translated_title,
       CASE WHEN lang <> 'en' THEN 'en' END AS translation_language
FROM documents"""


# ---------------------------------------------------------------- CTE assembly

SQL_TABLES = {
    "incoming_feed_items": SQL_INCOMING_FEED_ITEMS,
    "feeds": SQL_FEEDS,
    "fetch_attempts": SQL_FETCH_ATTEMPTS,
    "incoming_events": SQL_INCOMING_EVENTS,
    "stored_resources": SQL_STORED_RESOURCES,
    "stored_gdelt_events": SQL_STORED_GDELT_EVENTS,
    "stored_feed_items": SQL_STORED_FEED_ITEMS,
    "incoming_tweets": SQL_INCOMING_TWEETS,
    "page_resources": SQL_PAGE_RESOURCES,
    "vectors": SQL_VECTORS,
    "doc_articles": SQL_DOC_ARTICLES,
    "twitter_sources": L.sql_values(L.TWITTER_SOURCES),
    "templates": L.sql_values(L.TEMPLATES),
    "labels_t": L.sql_values(L.LABELS),
    "rules": L.sql_values(L.RULES),
    "keywords": L.sql_values(L.KEYWORDS),
    "lexicon": L.sql_values(L.LEXICON),
    "gazetteer": L.sql_values(L.GAZETTEER),
    "country_codes": L.sql_values(L.COUNTRY_CODES),
}
# dependencies between derived tables (CTEs must come after what they use)
SQL_DEPS = {
    "stored_resources": ["incoming_events"],
    "stored_gdelt_events": ["incoming_events", "stored_resources"],
    "stored_feed_items": ["incoming_feed_items", "stored_resources"],
}


def with_tables(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` clause defining the named derived tables (and their dependencies)."""
    order: list[str] = []

    def add(n):
        for dep in SQL_DEPS.get(n, []):
            add(dep)
        if n not in order:
            order.append(n)
    for n in names:
        add(n)
    parts = [f"{n} AS ({SQL_TABLES[n]})" for n in order] + [f"{n} AS ({q})" for n, q in (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""
