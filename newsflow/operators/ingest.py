"""Record normalisation and ingest joins (P-1..P-4, P-7, P-8, J-1..J-4, J-7, J-8, W-3, W-4, F-19, U-4, U-5).

Every ingest operator returns its input rows with an ``outcome`` column:

* ``new``    - the URL is unknown: a web resource and the record are created;
* ``attach`` - the resource exists without this kind of record: attach it;
* ``skip``   - filtered out or already present (idempotent replay);
* ``error``  - bad record (isolated; the batch goes on).

Callers split on ``outcome`` and hand ``new`` rows to ``assign_ids`` /
``insert_if_absent``.  All joins are equi-joins on the URL or resource id.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsflow.functions.text import (code_allowed, go_trim, has_text, html_publish_date,
                                     html_title, html_top_image, language_allowed,
                                     not_older_than, null_if_empty)
from newsflow.operators.common import bounded_broadcast, first_per_key
from newsflow.operators.lang import detect_language

# GDELT geo type numbers and their names.
GEO_TYPES = {"1": "COUNTRY", "2": "USSTATE", "3": "USCITY", "4": "WORLDCITY", "5": "WORLDSTATE"}


def _resource_lookup(resources: DataFrame) -> DataFrame:
    return resources.select(F.col("id").alias("resource_id"), F.col("url"))


# --------------------------------------------------------------------- P-1

def normalize_feed_items(items: DataFrame, resources: DataFrame, stored_items: DataFrame, *,
                         langs: list[str], cutoff: _dt.datetime | None = None,
                         profiles: DataFrame | None = None, id_col: str = "item_seq") -> DataFrame:
    """P-1 + J-1: feed items -> outcome per item.

    Order of checks: too old (F-2) -> language (given ``language`` column, or
    detected from the title with ``profiles``; failure skips) -> allow-list
    (F-3) -> URL known? (J-1).  Within a batch the first item per URL wins.
    """
    df = items
    if profiles is not None:
        df = detect_language(df, id_col, "title", profiles, out="language")
    old = ~not_older_than("published_at", cutoff)
    lang_ok = language_allowed("language", langs)
    url = go_trim("url")
    df = df.withColumn("url", url).withColumn(
        "outcome", F.when(old | F.col("language").isNull() | ~lang_ok | ~has_text("url"), F.lit("skip")))
    kept = first_per_key(df.where(F.col("outcome").isNull()), ["url"], [id_col])
    dropped = df.where(F.col("outcome").isNotNull()).unionByName(
        df.where(F.col("outcome").isNull()).join(kept.select(id_col), id_col, "left_anti")
        .withColumn("outcome", F.lit("skip")))
    res = _resource_lookup(resources)
    has_item = stored_items.select(F.col("web_resource_id").alias("resource_id"),
                                   F.lit(True).alias("_has_item")).distinct()
    j = kept.join(res, "url", "left").join(has_item, "resource_id", "left")
    j = j.withColumn("outcome", F.when(F.col("resource_id").isNull(), F.lit("new"))
                     .when(F.col("_has_item").isNull(), F.lit("attach")).otherwise(F.lit("skip"))).drop("_has_item")
    return j.unionByName(dropped, allowMissingColumns=True)


# --------------------------------------------------------------------- P-2

def normalize_gdelt_events(events: DataFrame, resources: DataFrame, stored_events: DataFrame,
                           country_codes: DataFrame, *, codes: list[str]) -> DataFrame:
    """P-2 + J-2 + J-8 + W-4 + F-5 + F-9 + F-19: events -> gdelt_events shape + outcome.

    First event per source URL in arrival order (``seq``) is kept *before*
    the root-code filter; then empty URL -> skip, disallowed root code ->
    skip; unparsable date or unknown country code -> error (isolated).
    """
    first = first_per_key(events, ["source_url"], ["seq"])
    cc = bounded_broadcast(country_codes.select(F.col("fips").alias("geo_country"), F.col("iso")))
    ev = first.join(cc, "geo_country", "left")
    date_added = F.try_to_timestamp(F.col("date_added"), F.lit("yyyyMMddHHmmss"))
    country_ok = (F.coalesce(F.col("geo_country"), F.lit("")) == "") | F.col("iso").isNotNull()
    cats = F.filter(F.array_distinct(F.array("event_code", "event_base_code", "event_root_code")),
                    lambda x: F.coalesce(F.length(x), F.lit(0)) > 0)
    geo_type = F.lit(None).cast("string")
    for k, v in GEO_TYPES.items():
        geo_type = F.when(F.col("geo_type") == k, F.lit(v)).otherwise(geo_type)
    ev = ev.select(
        "seq", "source_url", "global_event_id",
        date_added.alias("date_added"),
        null_if_empty(geo_type).alias("location_type"),
        null_if_empty("geo_name").alias("location_name"),
        null_if_empty("iso").alias("country_code"),
        F.when(F.col("geo_lat").isNotNull() & F.col("geo_long").isNotNull(),
               F.struct(F.col("geo_long").alias("x"), F.col("geo_lat").alias("y"))).alias("coordinates"),
        cats.alias("event_categories"),
        F.when(~has_text("source_url"), F.lit("skip"))
         .when(~code_allowed("event_root_code", codes), F.lit("skip"))
         .when(date_added.isNull() | ~country_ok, F.lit("error")).alias("_pre"))
    res = _resource_lookup(resources)
    has_event = stored_events.select(F.col("web_resource_id").alias("resource_id"),
                                     F.lit(True).alias("_has")).distinct()
    j = ev.join(res.withColumnRenamed("url", "source_url"), "source_url", "left") \
          .join(has_event, "resource_id", "left")
    outcome = (F.when(F.col("_pre").isNotNull(), F.col("_pre"))
               .when(F.col("resource_id").isNull(), F.lit("new"))
               .when(F.col("_has").isNull(), F.lit("attach")).otherwise(F.lit("skip")))
    return j.withColumn("outcome", outcome).drop("_pre", "_has")


# --------------------------------------------------------------------- P-3 / S-3

def _grams(text) -> Column:
    """Distinct trigrams of a lower-cased text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("(?s)(?=(.{3}))"), 1))


def rarest_grams(tweets: DataFrame, searches: DataFrame) -> DataFrame:
    """``searches`` of three characters or more with ``_gram``, the trigram of each that fewest tweets have.

    A term with a trigram that no tweet has is left out: it matches nothing.
    """
    terms = searches.select("*", F.explode(_grams("term")).alias("_gram"))
    wanted = bounded_broadcast(terms.select("_gram").distinct())
    seen = tweets.select(F.explode(_grams("text")).alias("_gram")).join(wanted, "_gram", "left_semi") \
        .groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))  # counted before the shuffle
    ranked = terms.join(seen, "_gram", "left").groupBy(*searches.columns).agg(
        F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_gram")).alias("_g"))
    return ranked.where("_g.n > 0").select(*searches.columns, F.col("_g._gram").alias("_gram"))


def tweets_of_sources(tweets: DataFrame, sources: DataFrame) -> DataFrame:
    """S-3: landed tweets per enabled live source; ``user`` sources match the
    user name exactly, ``search`` sources match a case-insensitive substring.
    A search term of three characters or more is looked up by its rarest trigram among
    those of the tweets, an equi-join, and then compared as a whole; only shorter terms
    are compared with every tweet.
    Sources of any other type yield one ``error`` row each (recorded on the
    source by ``source_health``)."""
    live = sources.where("enabled AND deleted_at IS NULL")
    src = bounded_broadcast(live.select(F.col("id").alias("twitter_source_id"), "type",
                                        F.col("text").alias("term")))
    users = tweets.join(src.where("type = 'user'"), tweets.username == F.col("term"))
    searches = live.where("type = 'search'").select(F.col("id").alias("twitter_source_id"), "type", F.col("text").alias("term"))
    found = F.lower(F.col("text")).contains(F.lower(F.col("term")))
    short = tweets.join(bounded_broadcast(searches.where(F.length(F.lower("term")) < 3)), found)
    long = (tweets.withColumn("_gram", F.explode(_grams("text")))
            .join(bounded_broadcast(rarest_grams(tweets, searches)), "_gram").where(found).drop("_gram"))
    ok = users.unionByName(short).unionByName(long).withColumn("outcome", F.lit("ok"))
    bad = (src.where("type NOT IN ('user', 'search')")
           .select("twitter_source_id", "type", "term",
                   F.concat(F.lit("unexpected source type "), F.col("type")).alias("error"),
                   F.lit("error").alias("outcome")))
    return ok.unionByName(bad, allowMissingColumns=True)


def cap_per_source(tweets: DataFrame, max_tweets: int) -> DataFrame:
    """W-3: at most ``max_tweets`` newest tweets per source (time desc, id)."""
    w = Window.partitionBy("twitter_source_id").orderBy(F.col("published_at").desc(), F.col("upstream_id"))
    return tweets.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= max_tweets).drop("_rn")


def normalize_tweets(tweets: DataFrame, resources: DataFrame, stored_tweets: DataFrame,
                     articles: DataFrame, *, langs: list[str], cutoff: _dt.datetime | None = None,
                     profiles: DataFrame | None = None) -> DataFrame:
    """P-3 + J-3: tweets (twitter_source_id, upstream_id, text, published_at,
    username, user_id, permanent_url, photos) -> outcome per tweet.

    The web resource URL is the tweet's permanent URL; title = text,
    publish and scraped date = tweet time, top image = first photo or NULL.
    ``tweet_outcome`` and ``article_outcome`` are decided independently
    (attach / new / skip); the article only counts when it is new.
    """
    df = tweets
    if profiles is not None:
        df = detect_language(df, "upstream_id", "text", profiles, out="language")
    pre = (F.when(~not_older_than("published_at", cutoff), F.lit("skip"))
           .when(F.col("language").isNull() | ~language_allowed("language", langs), F.lit("skip")))
    df = df.withColumn("_pre", pre).withColumn("url", go_trim("permanent_url")) \
           .withColumn("_newest", -F.unix_micros("published_at"))
    df = first_per_key(df, ["url"], ["_newest", "upstream_id"]).drop("_newest")
    res = _resource_lookup(resources)
    has_tweet = stored_tweets.select(F.col("web_resource_id").alias("resource_id"),
                                     F.lit(True).alias("_has_tweet")).distinct()
    has_article = articles.select(F.col("web_resource_id").alias("resource_id"),
                                  F.lit(True).alias("_has_article")).distinct()
    j = df.join(res, "url", "left").join(has_tweet, "resource_id", "left").join(has_article, "resource_id", "left")
    tweet_outcome = (F.when(F.col("_pre").isNotNull(), F.col("_pre"))
                     .when(F.col("resource_id").isNull(), F.lit("new"))
                     .when(F.col("_has_tweet").isNull(), F.lit("attach")).otherwise(F.lit("skip")))
    article_outcome = (F.when(F.col("_pre").isNotNull(), F.col("_pre"))
                       .when(F.col("resource_id").isNull(), F.lit("new"))
                       .when(F.col("_has_article").isNull(), F.lit("attach")).otherwise(F.lit("skip")))
    return (j.withColumn("tweet_outcome", tweet_outcome).withColumn("article_outcome", article_outcome)
            .withColumn("title", F.col("text"))
            .withColumn("top_image", F.get(F.col("photos"), 0))
            .withColumn("scraped_publish_date", F.col("published_at"))
            .withColumn("publish_date", F.col("published_at"))
            .drop("_pre", "_has_tweet", "_has_article"))


# --------------------------------------------------------------------- P-4

def articles_from_pages(pages: DataFrame, resources: DataFrame, articles: DataFrame,
                        feed_items: DataFrame, gdelt_events: DataFrame, *, langs: list[str],
                        profiles: DataFrame | None = None) -> DataFrame:
    """P-4 + J-4 + J-7 + P-7 + P-8 + SC-13: scraped pages -> web_articles rows.

    ``pages`` has (web_resource_id, text) where ``text`` is the decoded,
    trimmed body (``response_text``).  Resources with an article are skipped
    (F-11); empty bodies are skipped (F-8); a scraped title equal to a stored
    article title is skipped (J-7, exact, before language detection);
    language is the feed item's, else detected from the scraped title
    (failure skips); then the allow-list (F-3).  Among the batch, the first
    page per scraped title (by resource id) wins.
    """
    p = (pages.join(articles.select(F.col("web_resource_id")), "web_resource_id", "left_anti")
         .where(has_text("text"))
         .select("web_resource_id", html_title("text").alias("scraped_title"),
                 html_top_image("text").alias("top_image"),
                 html_publish_date("text").alias("scraped_publish_date")))
    p = p.join(articles.select(F.col("title").alias("scraped_title")).distinct(), "scraped_title", "left_anti")
    fi = feed_items.select(F.col("web_resource_id"), F.col("title").alias("feed_title"),
                           F.col("language").alias("feed_language"), F.col("published_at").alias("feed_published"))
    ge = gdelt_events.select("web_resource_id", F.col("date_added").alias("gdelt_date"))
    res = resources.select(F.col("id").alias("web_resource_id"), F.col("created_at").alias("resource_created"))
    p = p.join(fi, "web_resource_id", "left").join(ge, "web_resource_id", "left").join(res, "web_resource_id", "left")
    if profiles is not None:
        p = detect_language(p, "web_resource_id", "scraped_title", profiles, out="detected_language")
    else:
        p = p.withColumn("detected_language", F.lit(None).cast("string"))
    p = p.withColumn("language", F.coalesce("feed_language", "detected_language")) \
         .where(language_allowed("language", langs))
    p = first_per_key(p, ["scraped_title"], ["web_resource_id"])
    return p.select(
        "web_resource_id",
        F.when(F.coalesce(F.length("feed_title"), F.lit(0)) > 0, F.col("feed_title"))
         .otherwise(F.col("scraped_title")).alias("title"),
        "top_image", "scraped_publish_date", "language",
        F.coalesce("feed_published", "gdelt_date", "scraped_publish_date", "resource_created")
         .alias("publish_date"))


# --------------------------------------------------------------------- U-5

def union_sources(*parts: DataFrame) -> DataFrame:
    """U-5: one web-resource stream from feed, event and tweet ingest outputs."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
