"""Registered queries: one per operator family of the inventory.

Every query reads the driver tables under ``sf_dir`` (or tables Spark
derives from them) over their whole extent, and has an equivalent DuckDB
SQL text in ``ORACLE`` unless the operator is not SQL-expressible.
Computed columns carry the same names on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.plans import literals as L
from newsflow.plans import sqlbits as S
from newsflow.plans import testbed as TB
from newsflow.plans.testbed import with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

ARTICLE_LANGS = ["en", "de", "fr"]


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


_PROFILE_CACHE: dict = {}


def _profiles(spark, d):
    """Language profiles fitted once per session and corpus, then reused by every
    detection job (a model resource: fit once, broadcast to many jobs)."""
    from pyspark import StorageLevel
    from newsflow.operators.lang import fit_language_profiles
    key = (id(spark), d)
    if key not in _PROFILE_CACHE:
        _PROFILE_CACHE[key] = fit_language_profiles(TB.raw(spark, d, "documents"), "text", "lang") \
            .persist(StorageLevel.MEMORY_AND_DISK)
    return _PROFILE_CACHE[key]


# ------------------------------------------------------------------ P-4 (flagship / entry)

@register("web_articles_from_pages", with_tables("page_resources", extra=[
    ("profiles", S.profiles_cte()),
    ("scraped", f"SELECT page_id AS web_resource_id, {S.html_title(S.go_trim('html'))} AS scraped_title FROM pages "
                f"WHERE {S.has_text('html')}"),
    ("det", S.detect_cte("scraped", "web_resource_id", "scraped_title")),
    ("cand", "SELECT s.web_resource_id, s.scraped_title, d.detected AS language, r.created_at "
             "FROM scraped s LEFT JOIN det d USING (web_resource_id) JOIN page_resources r ON r.id = s.web_resource_id "
             "WHERE d.detected IN ('en', 'de', 'fr')"),
]) + """
SELECT web_resource_id, scraped_title AS title, CAST(NULL AS VARCHAR) AS top_image,
       CAST(NULL AS TIMESTAMP) AS scraped_publish_date, language, created_at AS publish_date
FROM (SELECT *, row_number() OVER (PARTITION BY scraped_title ORDER BY web_resource_id) AS rn FROM cand)
WHERE rn = 1""")
def web_articles_from_pages(spark, d):
    """S-4 -> SC-7 -> SC-13 -> F-8 -> J-7 -> SC-1/P-8 -> F-3 -> P-4/P-7: new web_articles from fetched pages."""
    from newsflow.operators.ingest import articles_from_pages
    from newsflow import schemas
    empty_articles = schemas.empty(spark, "web_articles")
    return articles_from_pages(
        TB.page_texts(spark, d), TB.page_resources(spark, d), empty_articles,
        schemas.empty(spark, "feed_items"), schemas.empty(spark, "gdelt_events"),
        langs=ARTICLE_LANGS, profiles=_profiles(spark, d))


# ------------------------------------------------------------------ scans and filters

@register("live_enabled_feeds", with_tables("feeds") + """
SELECT id, url FROM feeds WHERE enabled AND deleted_at IS NULL""")
def live_enabled_feeds(spark, d):
    """S-5 + F-1: live (not soft-deleted) enabled sources."""
    return TB.feeds(spark, d).where("enabled AND deleted_at IS NULL").select("id", "url")


@register("lookup_feed_items", with_tables("incoming_feed_items") + """
SELECT item_seq, url, title FROM incoming_feed_items WHERE item_seq IN (SELECT doc_id FROM labels)""")
def lookup_feed_items(spark, d):
    """S-6: set-at-a-time point lookup, a semi join with the batch of ids."""
    ids = TB.raw(spark, d, "labels").select(F.col("doc_id").alias("item_seq"))
    return (TB.incoming_feed_items(spark, d).join(ids, "item_seq", "left_semi")
            .select("item_seq", "url", "title"))


@register("feed_items_recent_allowed", with_tables("incoming_feed_items") + """
SELECT item_seq, language, published_at FROM incoming_feed_items
WHERE NOT coalesce(published_at < TIMESTAMP '2024-01-10 00:00:00', FALSE) AND coalesce(language IN ('en', 'de'), FALSE)""")
def feed_items_recent_allowed(spark, d):
    """F-2 (NULL date kept, strict <) + F-3 (allow-list)."""
    import datetime as dt
    from newsflow.functions.text import language_allowed, not_older_than
    fi = TB.incoming_feed_items(spark, d)
    return (fi.where(not_older_than("published_at", dt.datetime(2024, 1, 10)) & language_allowed("language", ["en", "de"]))
            .select("item_seq", "language", "published_at"))


@register("feed_items_empty_allow_list", with_tables("incoming_feed_items") + """
SELECT item_seq FROM incoming_feed_items WHERE FALSE""")
def feed_items_empty_allow_list(spark, d):
    """F-3: an empty language list allows nothing."""
    from newsflow.functions.text import language_allowed
    return TB.incoming_feed_items(spark, d).where(language_allowed("language", [])).select("item_seq")


@register("feed_item_outcomes", with_tables("incoming_feed_items", "stored_resources", "stored_feed_items", extra=[
    ("pre", """SELECT *, CASE WHEN coalesce(published_at < TIMESTAMP '2024-01-05 00:00:00', FALSE)
                    OR language IS NULL OR NOT coalesce(language IN ('en', 'fr', 'de'), FALSE)
                    OR NOT """ + S.has_text("url") + """ THEN 'skip' END AS pre FROM incoming_feed_items"""),
    ("firsts", "SELECT item_seq FROM (SELECT item_seq, row_number() OVER (PARTITION BY url ORDER BY item_seq) AS rn "
               "FROM pre WHERE pre IS NULL) WHERE rn = 1"),
]) + """
SELECT p.item_seq, p.url, r.id AS resource_id,
       CASE WHEN p.pre IS NOT NULL OR f.item_seq IS NULL THEN 'skip'
            WHEN r.id IS NULL THEN 'new'
            WHEN s.web_resource_id IS NULL THEN 'attach' ELSE 'skip' END AS outcome
FROM pre p LEFT JOIN firsts f USING (item_seq)
LEFT JOIN stored_resources r ON r.url = p.url AND p.pre IS NULL AND f.item_seq IS NOT NULL
LEFT JOIN stored_feed_items s ON s.web_resource_id = r.id""")
def feed_item_outcomes(spark, d):
    """P-1 + J-1: new / attach / skip per incoming feed item."""
    import datetime as dt
    from newsflow.operators.ingest import normalize_feed_items
    out = normalize_feed_items(TB.incoming_feed_items(spark, d), TB.stored_resources(spark, d),
                               TB.stored_feed_items(spark, d), langs=["en", "fr", "de"],
                               cutoff=dt.datetime(2024, 1, 5))
    return out.select("item_seq", "url", "resource_id", "outcome")


@register("gdelt_event_outcomes", with_tables("incoming_events", "stored_resources", "stored_gdelt_events",
                                               "country_codes", extra=[
    ("firsts", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_url ORDER BY seq) AS rn "
               "FROM incoming_events) WHERE rn = 1"),
    ("ev", """SELECT f.*, c.iso, try_strptime(f.date_added, '%Y%m%d%H%M%S') AS added
              FROM firsts f LEFT JOIN country_codes c ON c.fips = f.geo_country"""),
]) + """
SELECT e.seq, e.source_url, e.global_event_id, e.added AS date_added,
       CASE e.geo_type WHEN '1' THEN 'COUNTRY' WHEN '2' THEN 'USSTATE' WHEN '3' THEN 'USCITY'
                       WHEN '4' THEN 'WORLDCITY' WHEN '5' THEN 'WORLDSTATE' END AS location_type,
       nullif(e.geo_name, '') AS location_name, nullif(e.iso, '') AS country_code,
       CASE WHEN e.geo_lat IS NOT NULL AND e.geo_long IS NOT NULL THEN e.geo_long END AS coord_x,
       CASE WHEN e.geo_lat IS NOT NULL AND e.geo_long IS NOT NULL THEN e.geo_lat END AS coord_y,
       array_to_string(list_sort(list_filter(list_distinct([e.event_code, e.event_base_code, e.event_root_code]),
                                   lambda x: coalesce(length(x), 0) > 0)), ',') AS categories,
       r.id AS resource_id,
       CASE WHEN NOT """ + S.has_text("e.source_url") + """ THEN 'skip'
            WHEN NOT coalesce(e.event_root_code IN ('04', '14', '19'), FALSE) THEN 'skip'
            WHEN e.added IS NULL OR NOT (coalesce(e.geo_country, '') = '' OR e.iso IS NOT NULL) THEN 'error'
            WHEN r.id IS NULL THEN 'new'
            WHEN g.web_resource_id IS NULL THEN 'attach' ELSE 'skip' END AS outcome
FROM ev e LEFT JOIN stored_resources r ON r.url = e.source_url
LEFT JOIN stored_gdelt_events g ON g.web_resource_id = r.id""")
def gdelt_event_outcomes(spark, d):
    """W-4 (first per URL, before the code filter) + F-9 + F-5 + P-2 + J-8 + F-19 + J-2."""
    from newsflow.operators.ingest import normalize_gdelt_events
    out = normalize_gdelt_events(TB.incoming_events(spark, d), TB.stored_resources(spark, d),
                                 TB.stored_gdelt_events(spark, d), L.frame(spark, L.COUNTRY_CODES),
                                 codes=["04", "14", "19"])
    return out.select("seq", "source_url", "global_event_id", "date_added", "location_type", "location_name",
                      "country_code", F.col("coordinates.x").alias("coord_x"), F.col("coordinates.y").alias("coord_y"),
                      F.array_join(F.array_sort("event_categories"), ",").alias("categories"), "resource_id", "outcome")


@register("gdelt_all_codes_allowed", with_tables("incoming_events") + """
SELECT count(*) AS n FROM (SELECT DISTINCT source_url FROM incoming_events WHERE length(source_url) > 0)""")
def gdelt_all_codes_allowed(spark, d):
    """F-5: an empty root-code list allows every event (count of first events per URL)."""
    from newsflow.functions.text import code_allowed
    from newsflow.operators.common import first_per_key
    ev = first_per_key(TB.incoming_events(spark, d), ["source_url"], ["seq"])
    return ev.where(code_allowed("event_root_code", []) & (F.length("source_url") > 0)).agg(
        F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ tweets

@register("tweets_of_sources", with_tables("incoming_tweets", "twitter_sources", extra=[
    ("src", "SELECT id AS twitter_source_id, type, text AS term FROM twitter_sources WHERE enabled AND deleted_at IS NULL"),
]) + """
SELECT s.twitter_source_id, t.upstream_id, 'ok' AS outcome, CAST(NULL AS VARCHAR) AS error
FROM incoming_tweets t JOIN src s ON s.type = 'user' AND t.username = s.term
UNION ALL
SELECT s.twitter_source_id, t.upstream_id, 'ok', NULL
FROM incoming_tweets t JOIN src s ON s.type = 'search' AND contains(lower(t.text), lower(s.term))
UNION ALL
SELECT twitter_source_id, NULL, 'error', 'unexpected source type ' || type FROM src WHERE type NOT IN ('user', 'search')""")
def tweets_of_sources(spark, d):
    """S-3: user sources by exact user name, search sources by case-insensitive substring; bad type -> error row."""
    from newsflow.operators.ingest import tweets_of_sources as op
    return op(TB.incoming_tweets(spark, d), L.frame(spark, L.TWITTER_SOURCES)).select(
        "twitter_source_id", "upstream_id", "outcome", "error")


@register("tweets_capped", with_tables("incoming_tweets") + """
SELECT upstream_id, twitter_source_id FROM (
  SELECT upstream_id, CAST(CAST(upstream_id AS BIGINT) // 100 % 9 AS BIGINT) AS twitter_source_id,
         row_number() OVER (PARTITION BY CAST(upstream_id AS BIGINT) // 100 % 9
                            ORDER BY published_at DESC, upstream_id) AS rn
  FROM incoming_tweets) WHERE rn <= 3""")
def tweets_capped(spark, d):
    """W-3: at most N (here 3) newest tweets per source."""
    from newsflow.operators.ingest import cap_per_source
    t = TB.incoming_tweets(spark, d).withColumn(
        "twitter_source_id", (F.floor(F.col("upstream_id").cast("long") / 100) % 9).cast("long"))
    return cap_per_source(t, 3).select("upstream_id", "twitter_source_id")


TWEET_RES_SQL = ("SELECT CAST(dense_rank() OVER (ORDER BY permanent_url) AS BIGINT) AS id, permanent_url AS url "
                 "FROM incoming_tweets WHERE username = 'system'")


@register("tweet_outcomes", with_tables("incoming_tweets", extra=[
    ("profiles", S.profiles_cte()),
    ("det", S.detect_cte("incoming_tweets", "upstream_id", "text")),
    ("res", TWEET_RES_SQL),
    ("t", """SELECT t.*, d.detected AS language,
                    CASE WHEN d.detected IS NULL OR NOT coalesce(d.detected IN ('en', 'fr', 'de', 'es'), FALSE)
                         THEN 'skip' END AS pre
             FROM incoming_tweets t LEFT JOIN det d USING (upstream_id)"""),
]) + """
SELECT t.upstream_id, t.language, r.id AS resource_id,
       coalesce(t.pre, CASE WHEN r.id IS NULL THEN 'new' ELSE 'attach' END) AS tweet_outcome,
       coalesce(t.pre, CASE WHEN r.id IS NULL THEN 'new' ELSE 'skip' END) AS article_outcome,
       t.text AS title, t.photos[1] AS top_image, t.published_at AS publish_date
FROM t LEFT JOIN res r ON r.url = t.permanent_url""")
def tweet_outcomes(spark, d):
    """P-3 + J-3: tweet and article outcomes decided independently; language detected from the text."""
    from newsflow import schemas
    from newsflow.operators.ingest import normalize_tweets
    from pyspark.sql.window import Window
    tw = TB.incoming_tweets(spark, d)
    res = tw.where("username = 'system'").select(
        F.dense_rank().over(Window.orderBy("permanent_url")).cast("long").alias("id"),
        F.col("permanent_url").alias("url"))
    arts = res.select(F.col("id").alias("web_resource_id"))
    out = normalize_tweets(tw, res, schemas.empty(spark, "tweets"), arts,
                           langs=["en", "fr", "de", "es"], profiles=_profiles(spark, d))
    return out.select("upstream_id", "language", "resource_id", "tweet_outcome", "article_outcome",
                      "title", "top_image", "publish_date")


# ------------------------------------------------------------------ projections

@register("effective_titles", with_tables("doc_articles") + f"""
SELECT id, {S.effective_title()} AS title_eff FROM doc_articles WHERE {S.has_text(S.effective_title())}""")
def effective_titles(spark, d):
    """P-5 + SC-2 + F-10: trimmed translation if present (even blank) else title; blank leaves the chain."""
    from newsflow.functions.text import effective_title, has_text
    a = TB.doc_articles(spark, d)
    return a.select("id", effective_title().alias("title_eff")).where(has_text("title_eff"))


@register("geo_text_choice", with_tables("doc_articles") + f"""
SELECT id,
  CASE WHEN language IN ('de', 'es', 'en') AND {S.has_text('title')} THEN {S.go_trim('title')}
       WHEN translation_language IN ('de', 'es', 'en') AND {S.has_text('translated_title')} THEN {S.go_trim('translated_title')} END AS geo_text,
  CASE WHEN language IN ('de', 'es', 'en') AND {S.has_text('title')} THEN upper(language)
       WHEN translation_language IN ('de', 'es', 'en') AND {S.has_text('translated_title')} THEN upper(translation_language) END AS geo_lang
FROM doc_articles""")
def geo_text_choice(spark, d):
    """P-6: original title in a supported language, else the translation, else none."""
    from newsflow.functions.text import geo_text
    a = TB.doc_articles(spark, d).select("id", geo_text().alias("g"))
    return a.select("id", F.col("g.text").alias("geo_text"), F.col("g.lang").alias("geo_lang"))


@register("resource_relations", with_tables("incoming_feed_items", "stored_resources", "stored_feed_items",
                                             "stored_gdelt_events", extra=[
    ("fi", """SELECT s.web_resource_id, min(f.published_at) AS published_at
              FROM stored_feed_items s JOIN stored_resources r ON r.id = s.web_resource_id
              JOIN incoming_feed_items f ON f.url = r.url GROUP BY s.web_resource_id"""),
    ("ge", """SELECT g.web_resource_id, min(e.ts) AS date_added
              FROM stored_gdelt_events g JOIN stored_resources r ON r.id = g.web_resource_id
              JOIN incoming_events e ON e.source_url = r.url GROUP BY g.web_resource_id"""),
]) + """
SELECT r.id, r.url, fi.web_resource_id IS NOT NULL AS has_feed_item, ge.web_resource_id IS NOT NULL AS has_gdelt_event,
       coalesce(fi.published_at, ge.date_added, r.created_at) AS publish_date
FROM stored_resources r LEFT JOIN fi ON fi.web_resource_id = r.id LEFT JOIN ge ON ge.web_resource_id = r.id""")
def resource_relations(spark, d):
    """J-4 + P-7: resource with its feed item and GDELT event; publish date precedence."""
    r = TB.stored_resources(spark, d)
    fi = (TB.stored_feed_items(spark, d).join(r.select(F.col("id").alias("web_resource_id"), "url"), "web_resource_id")
          .join(TB.incoming_feed_items(spark, d).select("url", "published_at"), "url")
          .groupBy("web_resource_id").agg(F.min("published_at").alias("published_at")))
    ge = (TB.stored_gdelt_events(spark, d).join(r.select(F.col("id").alias("web_resource_id"), "url"), "web_resource_id")
          .join(TB.incoming_events(spark, d).select(F.col("source_url").alias("url"), "ts"), "url")
          .groupBy("web_resource_id").agg(F.min("ts").alias("date_added")))
    j = (r.join(fi.withColumn("_fi", F.lit(True)), r.id == fi.web_resource_id, "left").drop("web_resource_id")
         .join(ge.withColumn("_ge", F.lit(True)), r.id == ge.web_resource_id, "left"))
    return j.select("id", "url", F.col("_fi").isNotNull().alias("has_feed_item"),
                    F.col("_ge").isNotNull().alias("has_gdelt_event"),
                    F.coalesce("published_at", "date_added", "created_at").alias("publish_date"))


@register("api_feed_rows", with_tables("feeds", "fetch_attempts") + """
SELECT CAST(f.id AS VARCHAR) AS id, f.url, f.enabled,
       coalesce(strftime(f.created_at, '%Y-%m-%dT%H:%M:%SZ'), '') AS created_at,
       coalesce(strftime(f.deleted_at, '%Y-%m-%dT%H:%M:%SZ'), '') AS deleted_at,
       coalesce(strftime(a.last_ok, '%Y-%m-%dT%H:%M:%SZ'), '') AS last_retrieved_at
FROM feeds f LEFT JOIN (SELECT source_id, max(attempted_at) FILTER (WHERE NOT failed) AS last_ok FROM fetch_attempts GROUP BY 1) a
ON a.source_id = f.id""")
def api_feed_rows(spark, d):
    """P-11 + SC-14: API view: id as text, RFC 3339 times, NULL -> ''."""
    from newsflow.functions.text import rfc3339
    ok = (TB.fetch_attempts(spark, d).where(~F.col("failed")).groupBy("source_id")
          .agg(F.max("attempted_at").alias("last_ok")))
    f = TB.feeds(spark, d).join(ok, F.col("id") == F.col("source_id"), "left")
    return f.select(F.col("id").cast("string").alias("id"), "url", "enabled", rfc3339("created_at").alias("created_at"),
                    rfc3339("deleted_at").alias("deleted_at"), rfc3339("last_ok").alias("last_retrieved_at"))


# ------------------------------------------------------------------ model-backed stages

HYP_SQL = """SELECT t.id AS template_id, l.id AS label_id, l.text AS label, t.multi_class,
       replace(t.text, '{}', l.text) AS hypothesis,
       count(*) OVER (PARTITION BY t.id, l.text) > 1 AS dup_label
FROM templates t JOIN labels_t l ON l.zero_shot_hypothesis_template_id = t.id
WHERE t.enabled AND t.deleted_at IS NULL AND l.enabled AND l.deleted_at IS NULL"""


@register("hypotheses", with_tables("templates", "labels_t", "doc_articles", extra=[("h", HYP_SQL)]) + """
SELECT h.template_id, h.label_id, h.hypothesis, h.dup_label, count(*) AS n_articles
FROM h, (SELECT 1 FROM doc_articles) GROUP BY ALL""")
def hypotheses_q(spark, d):
    """J-6 + P-10 + J-13: enabled templates x enabled labels, '{}' rendered; times the articles they apply to."""
    from newsflow.operators.models import hypotheses
    from newsflow.operators.side import explode_side
    h = hypotheses(L.frame(spark, L.TEMPLATES), L.frame(spark, L.LABELS))
    per = explode_side(TB.doc_articles(spark, d).select("id"), h)
    return per.groupBy("template_id", "label_id", "hypothesis", "dup_label").agg(F.count(F.lit(1)).alias("n_articles"))


def _tri_set(x):
    """Distinct trigrams of a text, its characters split once."""
    return (f"(SELECT list_distinct(list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2])) "
            f"FROM (SELECT string_split(coalesce({S.norm(x)}, ''), '') AS c))")


@register("zero_shot_classes", with_tables("templates", "labels_t", "doc_articles", extra=[
    ("h", HYP_SQL),
    ("ht", f"SELECT *, {_tri_set('h.label')} AS lt FROM h WHERE NOT h.dup_label"),
    ("a", f"SELECT id, {S.effective_title()} AS title_eff FROM doc_articles WHERE {S.has_text(S.effective_title())}"),
    ("tri", f"SELECT a.id, {_tri_set('a.title_eff')} AS tt FROM a"),
    ("p", """SELECT tri.id, ht.template_id, ht.label_id, ht.multi_class,
                    CAST(len(list_intersect(tri.tt, ht.lt)) AS DOUBLE) AS logit FROM tri, ht"""),
    ("c", """SELECT *, CAST(CASE WHEN multi_class THEN 1.0 / (1.0 + exp(-logit))
                      ELSE exp(logit) / sum(exp(logit)) OVER (PARTITION BY id, template_id) END AS FLOAT) AS confidence
             FROM p"""),
]) + """
SELECT id AS web_article_id, label_id AS zero_shot_hypothesis_label_id, template_id AS zero_shot_hypothesis_template_id,
       row_number() OVER (PARTITION BY id, template_id ORDER BY confidence DESC, label_id) = 1 AS best,
       round(confidence, 4) AS confidence
FROM c""")
def zero_shot_classes(spark, d):
    """M-2 + J-10 + A-7 + W-1: default NLI scores, softmax or sigmoid, best flag."""
    from newsflow.operators.models import zero_shot_classify
    z = zero_shot_classify(TB.doc_articles(spark, d), L.frame(spark, L.TEMPLATES), L.frame(spark, L.LABELS))
    return z.withColumn("confidence", F.round("confidence", 4))


ZERO_SHOT_TEXT = S.has_text(S.effective_title())


@register("zero_shot_outcomes", with_tables("templates", "labels_t", "doc_articles", extra=[
    ("f", "SELECT unnest(['plain', 'repeated']) AS labels"),
    ("h", """SELECT f.labels, t.id AS template_id, l.id AS label_id, l.text AS label
             FROM f, templates t JOIN (SELECT *, NULL AS only_in FROM labels_t
                                       UNION ALL SELECT 11, 2, 'positive', TRUE, NULL, 'repeated') l
                                 ON l.zero_shot_hypothesis_template_id = t.id
             WHERE t.enabled AND t.deleted_at IS NULL AND l.enabled AND l.deleted_at IS NULL
               AND coalesce(l.only_in = f.labels, TRUE)"""),
    ("ts", """SELECT labels, template_id, count(*) > count(DISTINCT label) AS repeated, list(label) AS known
              FROM h GROUP BY ALL"""),
    ("a", f"SELECT id FROM doc_articles WHERE {ZERO_SHOT_TEXT}"),
    ("r", """SELECT id, 1 AS template_id,
                    CASE WHEN id % 19 = 0 THEN [] WHEN id % 17 = 0 THEN ['sport', 'weather']
                         WHEN id % 2 = 0 THEN ['science', 'sport'] ELSE ['politics'] END AS classes
             FROM a WHERE id % 23 <> 0
             UNION ALL SELECT id, 2, CASE WHEN id % 29 = 0 THEN ['Positive'] ELSE ['negative', 'positive'] END FROM a"""),
    ("c", """SELECT ts.labels, a.id, ts.template_id, r.classes,
                    CASE WHEN ts.repeated THEN 'duplicate label' WHEN r.classes IS NULL THEN 'no reply'
                         WHEN len(r.classes) = 0 THEN 'empty distribution'
                         WHEN len(list_filter(r.classes, lambda x: NOT list_contains(ts.known, x))) > 0 THEN 'unknown class' END AS error
             FROM a CROSS JOIN ts LEFT JOIN r ON r.id = a.id AND r.template_id = ts.template_id"""),
    ("e", """SELECT labels, id, arg_min(error, template_id) FILTER (WHERE error IS NOT NULL) AS error,
                    min(template_id) FILTER (WHERE error IS NOT NULL) AS error_template_id FROM c GROUP BY ALL"""),
    ("b", """SELECT c.labels, c.id, sum(len(c.classes)) AS n, min(h.label_id) AS first_best
             FROM c JOIN h ON h.labels = c.labels AND h.template_id = c.template_id AND h.label = c.classes[1] GROUP BY ALL"""),
]) + """
SELECT e.labels, e.id, CASE WHEN e.error IS NULL THEN 'classified' ELSE 'error' END AS outcome, e.error, e.error_template_id,
       CAST(CASE WHEN e.error IS NULL THEN b.n ELSE 0 END AS BIGINT) AS n_classes,
       CASE WHEN e.error IS NULL THEN b.first_best END AS first_best
FROM e LEFT JOIN b USING (labels, id)""")
def zero_shot_outcomes(spark, d):
    """M-2 + J-13: replies with unknown classes, empty and missing ones, and a template that repeats a label."""
    from newsflow.operators.models import REPLY, classes_from_replies
    arts = TB.doc_articles(spark, d)
    i = F.col("id")

    def reply(*classes):
        return F.array(*[F.struct(F.lit(c).alias("class"), F.lit(1.0 / (k + 2)).cast("float").alias("confidence"))
                         for k, c in enumerate(classes)])
    one = (F.when(i % 19 == 0, F.array().cast(REPLY)).when(i % 17 == 0, reply("sport", "weather"))
           .when(i % 2 == 0, reply("science", "sport")).otherwise(reply("politics")))
    two = F.when(i % 29 == 0, reply("Positive")).otherwise(reply("negative", "positive"))
    ids = arts.select(i.alias("web_article_id"), "id")
    replies = ids.where(i % 23 != 0).select("web_article_id", F.lit(1).cast("long").alias("template_id"), one.alias("distribution")) \
        .unionByName(ids.select("web_article_id", F.lit(2).cast("long").alias("template_id"), two.alias("distribution")))
    templates, labels = L.frame(spark, L.TEMPLATES), L.frame(spark, L.LABELS)
    again = spark.createDataFrame([(11, 2, "positive", True, None)], L.LABELS["cols"])
    parts = [classes_from_replies(arts, templates, lab, replies).withColumn("labels", F.lit(name))
             for name, lab in (("plain", labels), ("repeated", labels.unionByName(again)))]
    best = F.array_min(F.transform(F.filter("classes", lambda c: c["best"]), lambda c: c["zero_shot_hypothesis_label_id"]))
    return parts[0].unionByName(parts[1]).select(
        "labels", "id", "outcome", "error", "error_template_id", F.size("classes").cast("long").alias("n_classes"),
        best.alias("first_best"))


@register("text_classes_default", with_tables("keywords", "doc_articles", extra=[
    ("a", f"SELECT id, {S.effective_title()} AS title_eff FROM doc_articles WHERE {S.has_text(S.effective_title())}"),
    ("tk", f"SELECT DISTINCT id, unnest({S.tokens('title_eff')}) AS keyword FROM a"),
    ("hits", "SELECT id, type, label, sum(weight) AS w FROM tk JOIN keywords USING (keyword) GROUP BY ALL"),
]) + """
SELECT id AS web_article_id, type, label, round(CAST(w / sum(w) OVER (PARTITION BY id, type) AS FLOAT), 4) AS confidence
FROM hits""")
def text_classes_default(spark, d):
    """M-3: 0..n (type, label, confidence) per article from the default keyword model."""
    from newsflow.operators.models import classify_text
    classes, _ = classify_text(TB.doc_articles(spark, d), L.frame(spark, L.KEYWORDS))
    return classes.withColumn("confidence", F.round("confidence", 4))


@register("text_class_forwarding", with_tables("keywords", "doc_articles", extra=[
    ("a", f"SELECT id, {S.effective_title()} AS title_eff FROM doc_articles WHERE {S.has_text(S.effective_title())}"),
    ("tk", f"SELECT DISTINCT id, unnest({S.tokens('title_eff')}) AS keyword FROM a"),
    ("hits", "SELECT DISTINCT id FROM tk JOIN keywords USING (keyword) WHERE type = 'topic'"),
]) + """
SELECT id AS web_article_id FROM hits""")
def text_class_forwarding(spark, d):
    """M-10: continue the chain only for articles with a 'topic' class (custom should_continue)."""
    from newsflow.operators.models import classify_text
    _, fwd = classify_text(TB.doc_articles(spark, d), L.frame(spark, L.KEYWORDS),
                           should_continue=lambda cls: F.exists(F.coalesce(cls, F.array()), lambda c: c["type"] == "topic"))
    return fwd


def _sentences_sql(x):
    return f"list_filter(list_transform(regexp_split_to_array({x}, '[.!?;\\n]+'), lambda s: trim(s)), lambda s: length(s) > 0)"


def _infos_ctes(source):
    """Answers ``infos`` (id, rule_id, text, confidence) of the articles of ``source``."""
    return [
        ("ra", f"SELECT id, lower({S.effective_title()}) AS passage FROM {source} WHERE {S.has_text(S.effective_title())}"),
        ("r", "SELECT id AS rule_id, lower(question) AS question, answer_regexp AS pattern, threshold FROM rules "
              "WHERE enabled AND deleted_at IS NULL"),
        ("rs", f"SELECT ra.id, u.s, u.pos, list_distinct({S.tokens('u.s')}) AS toks "
               f"FROM ra, unnest({_sentences_sql('ra.passage')}) WITH ORDINALITY AS u(s, pos)"),
        ("rq", f"SELECT *, list_distinct({S.tokens('question')}) AS q FROM r"),
        ("sc", """SELECT rs.id, rule_id, pattern, threshold, rs.s, pos,
                         CAST(len(list_intersect(toks, q)) / greatest(len(q), 1) AS FLOAT) AS conf FROM rs, rq"""),
        ("best_infos", """SELECT id, rule_id, pattern, threshold, arg_max(s, (conf, -pos)) AS text, max(conf) AS confidence
                          FROM sc WHERE conf > 0 GROUP BY ALL"""),
        ("infos", "SELECT * FROM best_infos WHERE confidence >= threshold AND regexp_matches(text, pattern)")]


@register("extracted_infos", with_tables("rules", "doc_articles", extra=_infos_ctes("doc_articles")) + """
SELECT id AS web_article_id, rule_id AS info_extraction_rule_id, text, round(confidence, 4) AS confidence FROM infos""")
def extracted_infos(spark, d):
    """M-8 + J-9 + F-13 + F-15 + SC-3: best answer per rule, threshold (>=), unanchored regexp."""
    from newsflow.operators.models import extract_info
    x = extract_info(TB.doc_articles(spark, d), L.frame(spark, L.RULES))
    return x.withColumn("confidence", F.round("confidence", 4))


@register("translated_titles", with_tables("incoming_feed_items", "lexicon", extra=[
    ("a", f"SELECT item_seq AS id, title, language FROM incoming_feed_items"),
    ("w", f"""SELECT a.id, a.language, u.word, u.pos,
                     lower(regexp_replace(u.word, '[^\\p{{L}}\\p{{N}}]', '', 'g')) AS source
              FROM a, unnest(regexp_split_to_array({S.go_trim('a.title')}, '\\s+')) WITH ORDINALITY AS u(word, pos)
              WHERE {S.has_text('a.title')} AND a.language IN ('fr', 'de', 'es')"""),
    ("m", """SELECT w.id, string_agg(coalesce(l.target, w.word), ' ' ORDER BY w.pos) AS tt
             FROM w LEFT JOIN lexicon l ON l.lang = w.language AND l.source = w.source GROUP BY w.id"""),
]) + f"""
SELECT a.id, CASE WHEN m.id IS NOT NULL THEN {S.go_trim('m.tt')} END AS translated_title,
       CASE WHEN m.id IS NOT NULL THEN 'en' END AS translation_language,
       CASE WHEN NOT {S.has_text('a.title')} THEN 'skip'
            WHEN a.language NOT IN ('fr', 'de', 'es') THEN 'pass'
            WHEN {S.has_text('m.tt')} THEN 'translated' ELSE 'error' END AS outcome
FROM a LEFT JOIN m USING (id)""")
def translated_titles(spark, d):
    """M-1 + F-4: white-listed languages translated with the default lexicon model, others pass through."""
    from newsflow.operators.models import translate
    a = TB.incoming_feed_items(spark, d).select(
        F.col("item_seq").alias("id"), "title", "language",
        F.lit(None).cast("string").alias("translated_title"), F.lit(None).cast("string").alias("translation_language"))
    out = translate(a, ["fr", "de", "es"], "en", lexicon=L.frame(spark, L.LEXICON))
    return out.select("id", "translated_title", "translation_language", "outcome")


@register("hashed_vectors", with_tables("doc_articles", extra=[
    ("a", f"SELECT id, {S.effective_title()} AS title_eff FROM doc_articles WHERE {S.has_text(S.effective_title())}"),
    ("b", f"""SELECT id, CAST(CAST(('0x' || substr(md5(t), 1, 7)) AS BIGINT) % 16 AS INTEGER) AS idx
              FROM (SELECT id, unnest({S.tokens('title_eff')}) AS t FROM a)"""),
    ("c", "SELECT id, idx, count(*) AS n FROM b GROUP BY ALL"),
]) + """
SELECT id AS web_article_id, idx, round(CAST(n / sqrt(sum(n * n) OVER (PARTITION BY id)) AS FLOAT), 4) AS value
FROM c""")
def hashed_vectors(spark, d):
    """M-6 + SC-6: default hashed-token vectors (dim 16), L2-normalised; non-zero entries."""
    from newsflow.operators.models import vectorize
    v = vectorize(TB.doc_articles(spark, d), dim=16)
    return (v.select("web_article_id", F.posexplode_outer("data").alias("idx", "value"))
            .where(F.col("value") != 0).withColumn("value", F.round("value", 4)))


def _geo_ctes(source):
    """Countries ``p1``, or else ``p2``, (id, country_code) of the articles of ``source``."""
    return [
    ("g", f"""SELECT id, CASE WHEN language IN ('de', 'es', 'en') AND {S.has_text('title')} THEN {S.go_trim('title')}
                   WHEN translation_language IN ('de', 'es', 'en') AND {S.has_text('translated_title')}
                   THEN {S.go_trim('translated_title')} END AS txt FROM {source}"""),
    ("tk", f"SELECT g.id, u.tok, u.pos FROM g, unnest({S.tokens('g.txt')}) WITH ORDINALITY AS u(tok, pos)"),
    ("lg", """SELECT id, pos, tok AS n1,
                     tok || ' ' || lead(tok, 1) OVER (PARTITION BY id ORDER BY pos) AS n2,
                     tok || ' ' || lead(tok, 1) OVER (PARTITION BY id ORDER BY pos) || ' ' ||
                     lead(tok, 2) OVER (PARTITION BY id ORDER BY pos) AS n3 FROM tk"""),
    ("grams", "SELECT id, pos, n1 AS name FROM lg UNION ALL SELECT id, pos, n2 FROM lg WHERE n2 IS NOT NULL "
              "UNION ALL SELECT id, pos, n3 FROM lg WHERE n3 IS NOT NULL"),
    ("hits", "SELECT grams.*, z.country_code, z.kind, z.demonym FROM grams JOIN gazetteer z USING (name)"),
    ("s1", """SELECT id, kind, country_code, count(*) AS score, min(pos) AS first_pos FROM hits WHERE NOT demonym GROUP BY ALL"""),
    ("p1", """SELECT id, arg_min(country_code, (-score, CASE kind WHEN 'city' THEN 0 WHEN 'country' THEN 1 ELSE 2 END,
                                                 first_pos, country_code)) AS country_code FROM s1 GROUP BY id"""),
    ("s2", """SELECT id, kind, country_code, count(*) AS score, min(pos) AS first_pos FROM hits
              WHERE demonym AND id NOT IN (SELECT id FROM p1) GROUP BY ALL"""),
    ("p2", """SELECT id, arg_min(country_code, (-score, CASE kind WHEN 'city' THEN 0 WHEN 'country' THEN 1 ELSE 2 END,
                                                 first_pos, country_code)) AS country_code FROM s2 GROUP BY id""")]


@register("geo_parse_titles", with_tables("doc_articles", "gazetteer", extra=_geo_ctes("doc_articles")) + """
SELECT a.id, coalesce(p1.country_code, p2.country_code) AS country_code
FROM doc_articles a LEFT JOIN p1 USING (id) LEFT JOIN p2 USING (id)""")
def geo_parse_titles(spark, d):
    """M-4 + J-12 + A-5: gazetteer n-gram match, demonyms only when the first pass finds nothing."""
    from newsflow.operators.geo import geo_parse
    return geo_parse(TB.doc_articles(spark, d), L.frame(spark, L.GAZETTEER))


def _reply_spark(ev):
    codes = F.array(*[F.lit(c) for c in L.EVENT_COUNTRIES])
    c1 = F.element_at(codes, (F.col("user_id") % 8 + 1).cast("int"))
    c2 = F.element_at(codes, ((F.col("user_id") + 3) % 8 + 1).cast("int"))
    s1 = ((F.col("value") * 100).cast("int") % 97).cast("string")
    s2 = ((F.col("value") * 700).cast("int") % 97).cast("string")
    loc = lambda c, s: F.concat(F.lit('{"countryCode":"'), c, F.lit('","score":'), s, F.lit("}"))
    js = F.concat(F.lit('{"results":{"places":{"focus":{"cities":['), loc(c1, s1),
                  F.lit('],"countries":['), loc(c2, s2), F.lit(","), loc(c1, s2),
                  F.lit('],"states":['), loc(c2, s1), F.lit("]}}}}"))
    return F.when(F.col("event_type") == "error", F.lit("not json")).otherwise(js)


def _reply_sql():
    codes = "[" + ", ".join(f"'{c}'" for c in L.EVENT_COUNTRIES) + "]"
    c1 = f"{codes}[user_id % 8 + 1]"
    c2 = f"{codes}[(user_id + 3) % 8 + 1]"
    s1 = "CAST(CAST(trunc(value * 100) AS INTEGER) % 97 AS VARCHAR)"
    s2 = "CAST(CAST(trunc(value * 700) AS INTEGER) % 97 AS VARCHAR)"

    def loc(c, s):
        return f"""'{{"countryCode":"' || {c} || '","score":' || {s} || '}}'"""
    js = (f"""'{{"results":{{"places":{{"focus":{{"cities":[' || {loc(c1, s1)} || '],"countries":[' || """
          f"""{loc(c2, s2)} || ',' || {loc(c1, s2)} || '],"states":[' || {loc(c2, s1)} || ']}}}}}}}}'""")
    return f"CASE WHEN event_type = 'error' THEN 'not json' ELSE {js} END"


GEO_JSON_TYPE = ('{"results":{"places":{"focus":{"cities":[{"countryCode":"VARCHAR","score":"DOUBLE"}],'
                 '"countries":[{"countryCode":"VARCHAR","score":"DOUBLE"}],'
                 '"states":[{"countryCode":"VARCHAR","score":"DOUBLE"}]}}}}')


@register("geo_from_replies", f"""
WITH r AS (SELECT event_id, {_reply_sql()} AS reply FROM events),
p AS (SELECT event_id, CASE WHEN json_valid(reply) THEN from_json(reply, '{GEO_JSON_TYPE}') END AS j FROM r),
l AS (SELECT event_id, list_concat(coalesce(j.results.places.focus.cities, []),
                                   coalesce(j.results.places.focus.countries, []),
                                   coalesce(j.results.places.focus.states, [])) AS locs FROM p),
b AS (SELECT l.event_id, arg_max(u.x.countryCode, (u.x.score, -u.pos)) AS country_code
      FROM l, unnest(l.locs) WITH ORDINALITY AS u(x, pos) GROUP BY l.event_id)
SELECT l.event_id, len(l.locs) AS n_locations, b.country_code FROM l LEFT JOIN b USING (event_id)""")
def geo_from_replies(spark, d):
    """M-5 + SC-11 + U-2 + A-5: stored geo replies -> all locations and the best country."""
    from newsflow.operators.geo import geo_from_reply
    ev = TB.raw(spark, d, "events").select("event_id", _reply_spark(TB.raw(spark, d, "events")).alias("reply"))
    out = geo_from_reply(ev, "reply")
    return out.select("event_id", F.size("locations").alias("n_locations"), "country_code")


@register("detected_languages", with_tables("incoming_feed_items", extra=[
    ("profiles", S.profiles_cte()),
    ("det", S.detect_cte("incoming_feed_items", "item_seq", "title")),
]) + """
SELECT f.item_seq, d.detected AS detected_language FROM incoming_feed_items f LEFT JOIN det d USING (item_seq)""")
def detected_languages(spark, d):
    """SC-1 + A-6: trigram-profile language of every feed item title (NULL = failed)."""
    from newsflow.operators.common import spread
    from newsflow.operators.lang import detect_language
    fi = spread(TB.incoming_feed_items(spark, d).select("item_seq", "title"))
    return detect_language(fi, "item_seq", "title", _profiles(spark, d)).select("item_seq", "detected_language")


HEALTH_SQL = """
r AS (SELECT *, sum(CASE WHEN NOT failed THEN 1 ELSE 0 END) OVER (PARTITION BY source_id ORDER BY seq
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS g,
             row_number() OVER (PARTITION BY source_id ORDER BY seq) AS rn FROM fetch_attempts),
i AS (SELECT *, rn - min(rn) OVER (PARTITION BY source_id, g) + CASE WHEN g > 0 THEN 0 ELSE 1 END AS fails FROM r),
st AS (SELECT source_id, min(rn) AS stop FROM i WHERE fails > {max} GROUP BY 1),
k AS (SELECT i.*, st.stop FROM i LEFT JOIN st USING (source_id) WHERE st.stop IS NULL OR i.rn <= st.stop),
health AS (SELECT source_id, CAST(arg_max(fails, rn) AS INTEGER) AS failures_count,
       arg_max_null(CASE WHEN failed THEN error END, rn) AS last_error,
       max(attempted_at) FILTER (WHERE NOT failed) AS last_retrieved_at, max(stop) IS NULL AS enabled,
       count(*) AS attempts FROM k GROUP BY 1)"""


@register("source_health_feeds", with_tables("fetch_attempts") + ", " + HEALTH_SQL.format(max=5) +
          " SELECT * FROM health")
def source_health_feeds(spark, d):
    """A-3: consecutive failures, last error, last retrieval; disabled at max + 1 failures (max 5), absorbing."""
    from newsflow.operators.state import source_health
    return source_health(TB.fetch_attempts(spark, d), max_failures=5)


@register("source_health_twitter", with_tables("fetch_attempts") + ", " + HEALTH_SQL.format(max=10 ** 9) +
          " SELECT * FROM health")
def source_health_twitter(spark, d):
    """A-4: the same fold for Twitter sources, which are never disabled."""
    from newsflow.operators.state import source_health
    return source_health(TB.fetch_attempts(spark, d), max_failures=None)


@register("work_order_feeds", with_tables("feeds", "fetch_attempts") + ", " + HEALTH_SQL.format(max=5) + """,
s AS (SELECT f.id, coalesce(h.last_retrieved_at, f.last_retrieved_at) AS last_retrieved_at,
             f.enabled AND coalesce(h.enabled, TRUE) AS enabled, f.deleted_at
      FROM feeds f LEFT JOIN health h ON h.source_id = f.id)
SELECT id, last_retrieved_at, position, (position - 1) // 4 AS batch_no FROM (
  SELECT *, row_number() OVER (ORDER BY last_retrieved_at ASC NULLS FIRST, id) AS position FROM s
  WHERE enabled AND deleted_at IS NULL)""")
def work_order_feeds(spark, d):
    """O-1 + O-2 + F-1: never-retrieved first, then oldest retrieval, id; fixed batches (size 4)."""
    from newsflow.operators.state import apply_health, source_health, work_order
    feeds = apply_health(TB.feeds(spark, d), source_health(TB.fetch_attempts(spark, d), max_failures=5))
    return work_order(feeds, batch=4).select("id", "last_retrieved_at", "position", "batch_no")


@register("keyset_page_feeds", with_tables("feeds") + """
SELECT id, url FROM feeds WHERE id > 5 ORDER BY id LIMIT 10""")
def keyset_page_feeds(spark, d):
    """O-3: keyset page, ids after 5, first 10 (the limit is the feature)."""
    from newsflow.operators.manage import keyset_page
    return keyset_page(TB.feeds(spark, d), after=5, first=10).select("id", "url")


# ------------------------------------------------------------------ vectors: KNN, duplicates, retention

def _cos_sql(a, b):
    da = f"list_transform({a}, lambda x: CAST(x AS DOUBLE))"
    db = f"list_transform({b}, lambda x: CAST(x AS DOUBLE))"
    return (f"CAST(1.0 - list_dot_product({da}, {db}) / (sqrt(list_dot_product({da}, {da})) * "
            f"sqrt(list_dot_product({db}, {db}))) AS FLOAT)")


def _vec_queries(spark, d):
    v = TB.vectors(spark, d)
    return v.select(F.col("web_article_id").alias("id"), F.col("publish_day").alias("day"), "data")


@register("knn_hits", with_tables("vectors", extra=[
    ("pairs", f"""SELECT q.web_article_id AS qid, c.web_article_id AS id, {_cos_sql('q.data', 'c.data')} AS distance
                  FROM vectors q JOIN vectors c ON c.publish_day BETWEEN q.publish_day - 3 AND q.publish_day
                  AND c.web_article_id <> q.web_article_id"""),
]) + """
SELECT qid, id, round(distance, 4) AS distance, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY distance, id) AS rank FROM pairs
  WHERE distance <= CAST(0.65 AS FLOAT)) WHERE rank <= 5""")
def knn_hits(spark, d):
    """J-11 + SC-10 + SC-8 + F-14 + U-1 + O-4 + W-5: 5 nearest within 0.65 over days d-3..d (blocked, exact)."""
    from newsflow.operators.knn import knn
    q = _vec_queries(spark, d)
    hits = knn(q, q, 3, 0.65, "COSINE", k=5, block_rows=1024, exclude_self=True)
    return hits.select("qid", "id", F.round("distance", 4).alias("distance"), "rank")


@register("duplicates", with_tables("vectors", extra=[
    ("q", "SELECT * FROM vectors WHERE web_article_id NOT IN (SELECT web_article_id FROM vectors WHERE label = 0)"),
    ("pairs", f"""SELECT q.web_article_id AS qid, c.web_article_id AS id, {_cos_sql('q.data', 'c.data')} AS distance
                  FROM q JOIN vectors c ON c.publish_day BETWEEN q.publish_day - 3 AND q.publish_day
                  AND c.web_article_id < q.web_article_id"""),
    ("top", """SELECT qid, arg_min(id, (distance, id)) AS parent_id, min(distance) AS distance FROM pairs
               WHERE distance <= CAST(0.65 AS FLOAT) GROUP BY qid"""),
]) + """
SELECT q.web_article_id, t.parent_id, round(t.distance, 4) AS distance FROM q LEFT JOIN top t ON t.qid = q.web_article_id""")
def duplicates(spark, d):
    """M-7 + W-2 + F-11 + F-12: parent = nearest smaller id within 0.65 over 3 days back; else NULL."""
    from newsflow.operators.knn import detect_duplicates
    v = TB.vectors(spark, d)
    checked = v.where("label = 0").select("web_article_id")
    out = detect_duplicates(TB.vector_articles(spark, d), v, checked, 3, 0.65, block_rows=1024)
    return out.withColumn("distance", F.round("distance", 4))


@register("duplicates_oldest_parent", with_tables("vectors", extra=[
    ("pairs", f"""SELECT q.web_article_id AS qid, c.web_article_id AS id, {_cos_sql('q.data', 'c.data')} AS distance
                  FROM vectors q JOIN vectors c ON c.publish_day BETWEEN q.publish_day - 3 AND q.publish_day
                  AND c.web_article_id < q.web_article_id"""),
    ("top", """SELECT qid, min(id) AS parent_id, arg_min(distance, id) AS distance FROM pairs
               WHERE distance <= CAST(0.65 AS FLOAT) GROUP BY qid"""),
]) + """
SELECT v.web_article_id, t.parent_id, round(t.distance, 4) AS distance FROM vectors v LEFT JOIN top t ON t.qid = v.web_article_id""")
def duplicates_oldest_parent(spark, d):
    """M-9: the hook takes the oldest article within 0.65 as parent instead of the nearest."""
    from newsflow.operators.knn import detect_duplicates

    def oldest(hits):
        first = F.array_min(F.transform(hits, lambda h: F.struct(h["id"], h["distance"])))
        return F.struct(first["distance"].alias("distance"), first["id"].alias("id"))
    out = detect_duplicates(TB.vector_articles(spark, d), TB.vectors(spark, d), None, 3, 0.65, select_top_hit=oldest, block_rows=1024)
    return out.withColumn("distance", F.round("distance", 4))


@register("vector_retention", with_tables("vectors") + """
SELECT web_article_id, CAST(publish_day AS VARCHAR) AS publish_day, 'vec_' || strftime(publish_day, '%Y-%m-%d') AS day_key,
       publish_day < DATE '2024-01-03' AS expired FROM vectors""")
def vector_retention(spark, d):
    """F-16 + ST-7 + SC-9: days strictly before day(now - 6 days) expire (now 2024-01-09 12:00)."""
    import datetime as dt
    from newsflow.operators.knn import day_key, retain
    kept, gone = retain(TB.vectors(spark, d), dt.datetime(2024, 1, 9, 12), 6)
    out = kept.withColumn("expired", F.lit(False)).unionByName(gone.withColumn("expired", F.lit(True)))
    return out.select("web_article_id", F.col("publish_day").cast("string").alias("publish_day"),
                      day_key("publish_day", "vec_").alias("day_key"), "expired")


@register("day_keys", with_tables("vectors") + """
SELECT web_article_id AS id, 'idx_' || strftime(make_timestamp(CAST(epoch(CAST(publish_day AS TIMESTAMP))
       + web_article_id % 86400 AS BIGINT) * 1000000), '%Y-%m-%d') AS day_key FROM vectors""")
def day_keys(spark, d):
    """SC-9: UTC day key with prefix of each article's publish time."""
    from newsflow.operators.knn import day_key
    return TB.vector_articles(spark, d).select("id", day_key("publish_date", "idx_").alias("day_key"))


@register("stored_vectors", with_tables("vectors") + """
SELECT web_article_id, CAST(publish_day AS VARCHAR) AS publish_day, len(data) AS dim,
       round(CAST(list_sum(list_transform(data, lambda x: CAST(x AS DOUBLE))) AS FLOAT), 3) AS total FROM vectors""")
def stored_vectors(spark, d):
    """K-4 + ST-6: all vectors stored by days, replayed, and some days replaced; one row an article comes back."""
    import uuid

    from newsflow.operators.knn import read_vectors, write_vectors
    from newsflow.session import ensure_checkpoint_dir
    v = TB.vectors(spark, d)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/newsflow/vectors-{uuid.uuid4().hex}"
    write_vectors(v, path)
    write_vectors(v, path)
    write_vectors(v.where(F.dayofmonth("publish_day") <= 3), path, replace=True)
    total = F.aggregate("data", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return read_vectors(spark, path).select("web_article_id", F.col("publish_day").cast("string").alias("publish_day"),
                                            F.size("data").alias("dim"), F.round(total.cast("float"), 3).alias("total"))


@register("vector_distances", with_tables("vectors", extra=[
    ("p", "SELECT a.web_article_id AS id, list_transform(a.data, lambda x: CAST(x AS DOUBLE)) AS x, "
          "list_transform(b.data, lambda x: CAST(x AS DOUBLE)) AS y FROM vectors a JOIN vectors b "
          "ON b.web_article_id = a.web_article_id + 1"),
]) + """
SELECT id, round(CAST(1.0 - list_dot_product(x, y) / (sqrt(list_dot_product(x, x)) * sqrt(list_dot_product(y, y))) AS FLOAT), 4) AS cosine,
       round(CAST(1.0 - list_dot_product(x, y) AS FLOAT), 4) AS ip,
       round(CAST(list_sum(list_transform(list_zip(x, y), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS FLOAT), 4) AS l2
FROM p""")
def vector_distances(spark, d):
    """SC-8: COSINE, IP and squared L2 between each vector and the next id (double math, float result)."""
    from newsflow.operators.knn import distance
    v = TB.vectors(spark, d)
    a = v.select(F.col("web_article_id").alias("id"), F.col("data").alias("x"))
    b = v.select((F.col("web_article_id") - 1).alias("id"), F.col("data").alias("y"))
    j = a.join(b, "id")
    return j.select("id", *[F.round(distance("x", "y", s), 4).alias(n)
                            for s, n in (("COSINE", "cosine"), ("IP", "ip"), ("L2", "l2"))])


@register("l2_normalized", with_tables("vectors", extra=[
    ("s", "SELECT web_article_id AS id, list_transform(data, lambda x: CAST(x * (1 + web_article_id % 3) AS FLOAT)) AS v FROM vectors"),
    ("n", "SELECT id, v, sqrt(list_sum(list_transform(v, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS nrm FROM s"),
]) + """
SELECT id, round(CAST(v[1] / nrm AS FLOAT), 4) AS x1, round(CAST(v[2] / nrm AS FLOAT), 4) AS x2 FROM n""")
def l2_normalized(spark, d):
    """SC-6: L2 normalisation of scaled vectors (first two components)."""
    from newsflow.operators.knn import l2_normalize
    v = TB.vectors(spark, d).select(F.col("web_article_id").alias("id"), F.transform(
        "data", lambda x: (x * (1 + F.col("web_article_id") % 3)).cast("float")).alias("v"))
    n = v.select("id", l2_normalize("v").alias("u"))
    return n.select("id", F.round(F.get("u", 0), 4).alias("x1"), F.round(F.get("u", 1), 4).alias("x2"))


# ------------------------------------------------------------------ pending work

@register("pending_work", with_tables("doc_articles") + """
SELECT id, publish_date AS created_at FROM doc_articles WHERE id NOT IN (SELECT doc_id FROM labels)""")
def pending_work_q(spark, d):
    """ST-4: records handed to a stage without a recorded outcome (labels = outcomes)."""
    from newsflow.operators.state import pending_work
    inputs = TB.doc_articles(spark, d).select("id", F.col("publish_date").alias("created_at"))
    outcomes = TB.raw(spark, d, "labels").select(F.col("doc_id").alias("id"))
    return pending_work(inputs, outcomes)


@register("stale_pending", with_tables("doc_articles") + """
SELECT id, created_at, row_number() OVER (ORDER BY created_at, id) AS position FROM (
  SELECT id, publish_date AS created_at FROM doc_articles WHERE id NOT IN (SELECT doc_id FROM labels))
WHERE created_at < TIMESTAMP '2024-01-19 00:00:00'""")
def stale_pending_q(spark, d):
    """ST-5 + F-17 + O-5: pending older than now - leeway (now 2024-01-20, leeway 1 day), oldest first."""
    import datetime as dt
    from newsflow.operators.state import pending_work, stale_pending
    inputs = TB.doc_articles(spark, d).select("id", F.col("publish_date").alias("created_at"))
    outcomes = TB.raw(spark, d, "labels").select(F.col("doc_id").alias("id"))
    return stale_pending(pending_work(inputs, outcomes), dt.datetime(2024, 1, 20), dt.timedelta(days=1)).select(
        "id", "created_at", "position")


# ------------------------------------------------------------------ sinks

NEW_URLS_SQL = """SELECT url, item_seq FROM (
  SELECT url, item_seq, row_number() OVER (PARTITION BY url ORDER BY item_seq) AS rn FROM incoming_feed_items) f
WHERE rn = 1 AND url NOT IN (SELECT url FROM stored_resources)"""


@register("insert_if_absent_resources", with_tables("incoming_feed_items", "stored_resources") + NEW_URLS_SQL)
def insert_if_absent_resources(spark, d):
    """K-1: first row per URL in the batch, URLs already stored are skipped."""
    from newsflow.operators.sinks import insert_if_absent
    new = TB.incoming_feed_items(spark, d).select("url", "item_seq")
    return insert_if_absent(new, TB.stored_resources(spark, d), [["url"]], ["item_seq"])


@register("assign_resource_ids", with_tables("incoming_feed_items", "stored_resources", extra=[("n", NEW_URLS_SQL)]) + """
SELECT (SELECT max(id) FROM stored_resources) + row_number() OVER (ORDER BY item_seq) AS id, url FROM n""")
def assign_resource_ids(spark, d):
    """K-5: dense ids after the table's max id, in arrival order (distributed numbering)."""
    from newsflow.operators.sinks import assign_ids, insert_if_absent
    stored = TB.stored_resources(spark, d)
    new = insert_if_absent(TB.incoming_feed_items(spark, d).select("url", "item_seq"), stored, [["url"]], ["item_seq"])
    return assign_ids(new, stored, ["item_seq"]).select("id", "url")


@register("versioned_feed_updates", with_tables("feeds") + """
SELECT f.id, CASE WHEN f.enabled THEN f.url || '?v=2' ELSE f.url END AS url,
       CASE WHEN f.enabled THEN f.version + 1 ELSE f.version END AS version,
       CASE WHEN f.enabled THEN 'applied' ELSE 'stale' END AS status
FROM feeds f""")
def versioned_feed_updates(spark, d):
    """K-2: optimistic update; writers that read version 1 of a disabled feed are stale."""
    from newsflow.operators.sinks import versioned_update
    feeds = TB.feeds(spark, d)
    updates = feeds.select("id", F.when(F.col("enabled"), 0).otherwise(1).cast("long").alias("base_version"),
                           F.concat("url", F.lit("?v=2")).alias("url"))
    snapshot, applied, stale = versioned_update(feeds, updates)
    st = stale.select("id", F.lit("stale").alias("status"))
    ap = applied.select("id", F.lit("applied").alias("status"))
    return snapshot.join(ap.unionByName(st), "id", "left").select("id", "url", "version", "status")


# ------------------------------------------------------------------ management

@register("create_feeds", with_tables("feeds") + """
SELECT (SELECT max(id) FROM feeds) + row_number() OVER (ORDER BY url) AS id, url, FALSE AS enabled, 0 AS failures_count
FROM (SELECT DISTINCT 'https://feeds.example/src' || CAST(doc_id % 25 AS VARCHAR) AS url FROM documents)
WHERE url NOT IN (SELECT url FROM feeds)""")
def create_feeds(spark, d):
    """C-2 + K-1 + K-5: bulk create; existing URLs skipped, new feeds start disabled."""
    import datetime as dt
    from newsflow.operators.manage import apply_creates
    creates = TB.raw(spark, d, "documents").select(
        F.concat(F.lit("https://feeds.example/src"), (F.col("doc_id") % 25).cast("string")).alias("url"))
    _, created = apply_creates(TB.feeds(spark, d), creates, [["url"]], dt.datetime(2024, 3, 1),
                               defaults={"enabled": False, "failures_count": 0})
    return created.select("id", "url", "enabled", "failures_count")


@register("create_labels", """
WITH templates AS (SELECT row_number() OVER (ORDER BY lang) AS id FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL)),
live AS (SELECT id FROM templates WHERE id <> 2),
creates AS (SELECT CAST(doc_id % 6 + 1 AS BIGINT) AS template_id, coalesce(source, '') AS text FROM documents)
SELECT 'created' AS outcome, template_id, text, row_number() OVER (ORDER BY template_id, text) AS label_id, CAST(1 AS BIGINT) AS n
FROM (SELECT DISTINCT template_id, text FROM creates WHERE template_id IN (SELECT id FROM live))
UNION ALL
SELECT 'not found', template_id, text, NULL, count(*) FROM creates
WHERE template_id NOT IN (SELECT id FROM live) GROUP BY template_id, text""")
def create_labels(spark, d):
    """C-2: labels created under live templates; requests for a deleted or unknown template are reported."""
    import datetime as dt
    from newsflow import schemas
    from newsflow.operators.manage import apply_creates, missing_parents
    from newsflow.operators.sinks import assign_ids
    docs, fk, now = TB.raw(spark, d, "documents"), "zero_shot_hypothesis_template_id", dt.datetime(2024, 3, 1)
    templates = assign_ids(docs.select(F.col("lang").alias("text")).where("text IS NOT NULL").distinct(), 0, ["text"])
    templates = templates.withColumn("deleted_at", F.when(F.col("id") == 2, F.lit(now)))
    creates = docs.select((F.col("doc_id") % 6 + 1).cast("long").alias(fk), F.coalesce("source", F.lit("")).alias("text"))
    _, created = apply_creates(schemas.empty(spark, "zero_shot_hypothesis_labels"), creates, [[fk, "text"]], now,
                               defaults={"enabled": True}, parent=(templates, fk))
    missing = missing_parents(creates, (templates, fk)).groupBy(fk, "text").agg(F.count(F.lit(1)).alias("n"))
    columns = [F.col(fk).alias("template_id"), "text"]
    return created.select(F.lit("created").alias("outcome"), *columns, F.col("id").alias("label_id"),
                          F.lit(1).cast("long").alias("n")).unionByName(
        missing.select(F.lit("not found").alias("outcome"), *columns, F.lit(None).cast("long").alias("label_id"), "n"))


@register("update_feeds", with_tables("feeds") + """
SELECT id, url || '#u' AS url, NULL AS last_error, version + 1 AS version, id % 2 = 0 AS enabled FROM feeds""")
def update_feeds(spark, d):
    """C-3: full-row update by id; empty last_error becomes NULL; unknown ids are not found."""
    import datetime as dt
    from newsflow.operators.manage import apply_updates
    feeds = TB.feeds(spark, d)
    upd = feeds.select("id", F.concat("url", F.lit("#u")).alias("url"), F.lit("").alias("last_error"),
                       (F.col("id") % 2 == 0).alias("enabled"))
    upd = upd.unionByName(spark.range(1).select(F.lit(10 ** 6).cast("long").alias("id"), F.lit("x").alias("url"),
                                                F.lit("").alias("last_error"), F.lit(True).alias("enabled")))
    snap, _ = apply_updates(feeds, upd, dt.datetime(2024, 3, 1))
    return snap.select("id", "url", "last_error", "version", "enabled")


@register("delete_feeds", with_tables("incoming_feed_items", "feeds") + """
SELECT f.id, CASE WHEN f.id IN (SELECT i.feed_id FROM incoming_feed_items i JOIN labels l ON l.doc_id = i.item_seq
                                WHERE l.toxic = 1) THEN 'soft' ELSE 'hard' END AS kind
FROM feeds f""")
def delete_feeds(spark, d):
    """C-4 + J-14 + A-2: delete every feed; feeds with stored items are soft-deleted, others removed."""
    import datetime as dt
    from newsflow.operators.manage import apply_deletes
    feeds = TB.feeds(spark, d)
    lab = TB.raw(spark, d, "labels").where("toxic = 1").select(F.col("doc_id").alias("item_seq"))
    children = TB.incoming_feed_items(spark, d).join(lab, "item_seq", "left_semi").select("feed_id")
    _, report = apply_deletes(feeds, feeds.select("id"), [(children, "feed_id")], dt.datetime(2024, 3, 1))
    return report


@register("templates_with_labels", with_tables("templates", "labels_t", "doc_articles", extra=[
    ("h", HYP_SQL),
    ("uses", f"SELECT h.template_id, count(*) AS n_pairs FROM h, doc_articles a WHERE NOT h.dup_label "
             f"AND {S.has_text(S.effective_title('a.title', 'a.translated_title'))} GROUP BY 1"),
]) + """
SELECT t.id, t.text, coalesce(string_agg(CAST(l.id AS VARCHAR), ',' ORDER BY l.id), '') AS label_ids,
       coalesce(max(u.n_pairs), 0) AS n_pairs
FROM templates t LEFT JOIN labels_t l ON l.zero_shot_hypothesis_template_id = t.id AND l.deleted_at IS NULL
LEFT JOIN uses u ON u.template_id = t.id
WHERE t.deleted_at IS NULL GROUP BY t.id, t.text""")
def templates_with_labels(spark, d):
    """C-1 + J-5: live templates with all their live labels nested (by id), and the
    number of (article, label) pairs the zero-shot stage scores for each."""
    from newsflow.operators.manage import nest_children
    from newsflow.operators.models import hypotheses, with_title
    from newsflow.operators.side import explode_side
    t = L.frame(spark, L.TEMPLATES).where("deleted_at IS NULL")
    lab = L.frame(spark, L.LABELS).where("deleted_at IS NULL")
    nested = nest_children(t, lab, "zero_shot_hypothesis_template_id", ["id", "text"], name="labels")
    h = hypotheses(L.frame(spark, L.TEMPLATES), L.frame(spark, L.LABELS)).where("NOT dup_label")
    uses = (explode_side(with_title(TB.doc_articles(spark, d)).select("id"), h.select("template_id"))
            .groupBy("template_id").agg(F.count(F.lit(1)).alias("n_pairs")))
    out = nested.join(uses, nested.id == uses.template_id, "left")
    return out.select("id", "text", F.array_join(F.transform("labels", lambda l: l["id"].cast("string")), ",").alias("label_ids"),
                      F.coalesce("n_pairs", F.lit(0)).alias("n_pairs"))


@register("validated_rules")
def validated_rules(spark, d):
    """SC-5 + C-5: answer patterns derived from benchmark texts, checked as RE2 and rewritten for Spark.
    (Validity is decided by a regex compiler, which SQL cannot express: no oracle.)"""
    from newsflow.operators.manage import validate_rules
    b = TB.raw(spark, d, "benchmark")
    word = F.regexp_replace(F.split_part("text", F.lit(" "), F.lit(1)), r"[^\p{L}]", "")
    suffix = (F.when(F.col("item_id") % 4 == 1, F.lit("("))
              .when(F.col("item_id") % 4 == 2, F.lit("(?P<w>[[:alpha:]]+)$"))
              .when(F.col("item_id") % 4 == 3, F.lit("(?=x)")).otherwise(F.lit("")))
    rules = b.select(F.col("item_id").alias("id"), F.concat(word, suffix).alias("answer_regexp"))
    valid, invalid = validate_rules(rules)
    return valid.select("id", "answer_regexp", F.lit(None).cast("string").alias("error")).unionByName(
        invalid.select("id", "answer_regexp", "error"))


@register("same_title_counts", with_tables("doc_articles") + """
SELECT title, count(*) AS n FROM doc_articles GROUP BY title HAVING count(*) > 1""")
def same_title_counts(spark, d):
    """A-1 (+ J-7 input): articles sharing an exact title."""
    return TB.doc_articles(spark, d).groupBy("title").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@register("same_title_exclusion", with_tables("doc_articles", extra=[
    ("s", f"SELECT page_id AS web_resource_id, {S.html_title(S.go_trim('html'))} AS title FROM pages"),
]) + """
SELECT web_resource_id, title FROM (
  SELECT *, row_number() OVER (PARTITION BY title ORDER BY web_resource_id) AS rn FROM s
  WHERE title NOT IN (SELECT title FROM doc_articles)) WHERE rn = 1""")
def same_title_exclusion(spark, d):
    """J-7: scraped titles equal (exact, case-sensitive) to a stored article title are skipped; first per title."""
    from newsflow.functions.text import html_title
    from newsflow.operators.common import first_per_key
    s = TB.page_texts(spark, d).select("web_resource_id", html_title("text").alias("title"))
    s = s.join(TB.doc_articles(spark, d).select("title").distinct(), "title", "left_anti")
    return first_per_key(s, ["title"], ["web_resource_id"])


@register("feed_language_sets", with_tables("incoming_feed_items") + """
SELECT feed_id, array_to_string(list_sort(list_filter(list_distinct(list_concat(list(language), ['xx'])),
                                                    lambda x: x <> 'en')), ',') AS langs,
       list_contains(list(language), 'fr') AS has_fr
FROM incoming_feed_items GROUP BY feed_id""")
def feed_language_sets(spark, d):
    """U-3: string-set build / add / delete / membership over each feed's item languages."""
    s = TB.incoming_feed_items(spark, d).groupBy("feed_id").agg(F.collect_set("language").alias("s"))
    s = s.select("feed_id", F.array_remove(F.array_union("s", F.array(F.lit("xx"))), "en").alias("s2"),
                 F.array_contains("s", "fr").alias("has_fr"))
    return s.select("feed_id", F.array_join(F.array_sort("s2"), ",").alias("langs"), "has_fr")


@register("resource_union", with_tables("incoming_feed_items", "incoming_events", "incoming_tweets") + """
SELECT url, source FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY prio, seq) AS rn FROM (
    SELECT url, 'feed' AS source, 0 AS prio, item_seq AS seq FROM incoming_feed_items
    UNION ALL SELECT source_url, 'gdelt', 1, seq FROM incoming_events WHERE length(source_url) > 0
    UNION ALL SELECT permanent_url, 'tweet', 2, CAST(upstream_id AS BIGINT) FROM incoming_tweets)) WHERE rn = 1""")
def resource_union(spark, d):
    """U-5 + ST-8: one web-resource stream from feeds, events and tweets, deduplicated by URL."""
    from newsflow.operators.common import first_per_key
    from newsflow.operators.ingest import union_sources
    u = union_sources(
        TB.incoming_feed_items(spark, d).select("url", F.lit("feed").alias("source"), F.lit(0).alias("prio"),
                                                F.col("item_seq").alias("seq")),
        TB.incoming_events(spark, d).where(F.length("source_url") > 0).select(
            F.col("source_url").alias("url"), F.lit("gdelt").alias("source"), F.lit(1).alias("prio"), "seq"),
        TB.incoming_tweets(spark, d).select(F.col("permanent_url").alias("url"), F.lit("tweet").alias("source"),
                                            F.lit(2).alias("prio"), F.col("upstream_id").cast("long").alias("seq")))
    return first_per_key(u, ["url"], ["prio", "seq"]).select("url", "source")


@register("response_routing", f"""
WITH r AS (SELECT page_id, CASE WHEN page_id % 10 = 0 THEN 404 ELSE 200 END AS status,
                  CASE page_id % 7 WHEN 0 THEN 'application/pdf' WHEN 1 THEN NULL
                       WHEN 2 THEN 'TEXT/PLAIN; charset=ISO-8859-1' ELSE 'text/html; charset=utf-8' END AS content_type,
                  CASE WHEN page_id % 13 = 0 THEN ' ' || chr(10) || ' ' ELSE html END AS body FROM pages)
SELECT page_id, CASE WHEN status <> 200 THEN 'error'
                     WHEN NOT coalesce(contains(lower(content_type), 'text') OR contains(lower(content_type), 'html'), FALSE) THEN 'skip'
                     WHEN NOT {S.has_text('body')} THEN 'skip' ELSE 'ok' END AS outcome,
       CASE WHEN status = 200 AND coalesce(contains(lower(content_type), 'text') OR contains(lower(content_type), 'html'), FALSE)
                 AND {S.has_text('body')} THEN length({S.go_trim('body')}) END AS text_length
FROM r""")
def response_routing(spark, d):
    """S-4 + F-7 (non-200 -> error) + F-6/SC-4 (content type) + SC-7 (charset) + F-8 (empty body)."""
    from newsflow.sources.landed import response_text
    pg = TB.raw(spark, d, "pages")
    ct = (F.when(F.col("page_id") % 7 == 0, F.lit("application/pdf")).when(F.col("page_id") % 7 == 1, F.lit(None))
          .when(F.col("page_id") % 7 == 2, F.lit("TEXT/PLAIN; charset=ISO-8859-1"))
          .otherwise(F.lit("text/html; charset=utf-8")))
    body = F.when(F.col("page_id") % 13 == 0, F.lit(" \n ")).otherwise(F.col("html"))
    resp = pg.select("page_id", F.when(F.col("page_id") % 10 == 0, 404).otherwise(200).alias("status"),
                     ct.alias("content_type"), body.alias("b"))
    resp = resp.withColumn("body", F.when(F.col("content_type").contains("ISO-8859-1"), F.encode("b", "ISO-8859-1"))
                           .otherwise(F.encode("b", "UTF-8")))
    out = response_text(resp)
    return out.select("page_id", "outcome", F.length("text").alias("text_length"))


CHAIN_LANGS = ["fr", "de", "es"]
SQL_CHAIN_ARTICLES = """SELECT id, title, language, publish_date,
       CASE WHEN id % 3 = 0 THEN translated_title END AS translated_title,
       CASE WHEN id % 3 = 0 THEN translation_language END AS translation_language,
       CASE WHEN id % 13 = 0 THEN 'GB' END AS country_code FROM doc_articles"""


@register("enrichment_chain", with_tables("doc_articles", "lexicon", "keywords", "gazetteer", "rules", extra=[
    ("c0", SQL_CHAIN_ARTICLES),
    ("c1", f"""SELECT *, CASE WHEN translated_title IS NOT NULL AND translation_language IS NOT NULL THEN 'skip'
                              WHEN NOT {S.has_text('title')} THEN 'skip'
                              WHEN coalesce(language IN ('fr', 'de', 'es'), FALSE) THEN 'translated' ELSE 'pass' END AS o
               FROM c0"""),
    ("w", f"""SELECT a.id, a.language, u.word, u.pos, lower(regexp_replace(u.word, '[^\\p{{L}}\\p{{N}}]', '', 'g')) AS source
              FROM c1 a, unnest(regexp_split_to_array({S.go_trim('a.title')}, '\\s+')) WITH ORDINALITY AS u(word, pos)
              WHERE a.o = 'translated'"""),
    ("m", f"""SELECT w.id, {S.go_trim("string_agg(coalesce(l.target, w.word), ' ' ORDER BY w.pos)")} AS tt
              FROM w LEFT JOIN lexicon l ON l.lang = w.language AND l.source = w.source GROUP BY w.id"""),
    ("c2", """SELECT c1.id, title, language, publish_date, country_code,
                     CASE WHEN m.id IS NOT NULL THEN tt ELSE translated_title END AS translated_title,
                     CASE WHEN m.id IS NOT NULL THEN 'en' ELSE translation_language END AS translation_language
              FROM c1 LEFT JOIN m USING (id) WHERE o <> 'skip'"""),
    ("c3", f"""SELECT *, CASE WHEN NOT {S.has_text(S.effective_title())} THEN 'skip' ELSE 'classified' END AS o FROM c2"""),
    ("kw", f"""SELECT DISTINCT id FROM (SELECT id, unnest({S.tokens(S.effective_title())}) AS keyword FROM c3)
               JOIN keywords USING (keyword)"""),
    ("c4", """SELECT c3.* EXCLUDE (o), CASE WHEN id IN (SELECT doc_id FROM labels) THEN 'skip'
                          WHEN id IN (SELECT id FROM kw) THEN 'classified' ELSE 'none' END AS o
              FROM c3 WHERE o <> 'skip'"""),
    ("c5", "SELECT * EXCLUDE (o) FROM c4 WHERE o <> 'skip'"),
    ("c5g", "SELECT * FROM c5 WHERE country_code IS NULL"),
    *_geo_ctes("c5g"),
    ("c6", """SELECT *, CASE WHEN country_code IS NOT NULL THEN 'skip'
                             WHEN id IN (SELECT id FROM p1) OR id IN (SELECT id FROM p2) THEN 'found' ELSE 'none' END AS o
              FROM c5"""),
    ("c7", f"SELECT * EXCLUDE (o), {S.effective_title()} AS title_eff FROM c6 WHERE o <> 'skip'"),
    ("bk", f"""SELECT id, CAST(CAST(('0x' || substr(md5(t), 1, 7)) AS BIGINT) % 32 AS INTEGER) AS idx
               FROM (SELECT id, unnest({S.tokens('title_eff')}) AS t FROM c7)"""),
    ("bc", "SELECT id, idx, count(*) AS n FROM bk GROUP BY ALL"),
    ("bn", "SELECT id, sqrt(sum(n * n)) AS norm FROM bc GROUP BY id"),
    ("v", """SELECT c7.id, CAST(publish_date AS DATE) AS day,
                    list(CAST(coalesce(n / norm, 0) AS FLOAT) ORDER BY i.idx) AS data
             FROM c7 CROSS JOIN range(32) i(idx) LEFT JOIN bn ON bn.id = c7.id
             LEFT JOIN bc ON bc.id = c7.id AND bc.idx = i.idx GROUP BY ALL"""),
    ("dup", f"""SELECT DISTINCT q.id FROM v q JOIN v c ON c.id < q.id AND c.day BETWEEN q.day - 3 AND q.day
                WHERE {_cos_sql('q.data', 'c.data')} <= CAST(0.04 AS FLOAT)"""),
    ("c8", "SELECT *, CASE WHEN id IN (SELECT id FROM dup) THEN 'duplicate' ELSE 'original' END AS o FROM c7"),
    ("c9", "SELECT * EXCLUDE (o) FROM c8 WHERE o = 'original'"),
    *_infos_ctes("c9"),
    ("every", """SELECT 1 AS stage_no, 'translator' AS stage, o AS outcome FROM c1
                 UNION ALL SELECT 2, 'zero_shot_classifier', o FROM c3 UNION ALL SELECT 3, 'text_classifier', o FROM c4
                 UNION ALL SELECT 4, 'geo_parser', o FROM c6 UNION ALL SELECT 5, 'vectorizer', 'vectorized' FROM c7
                 UNION ALL SELECT 6, 'duplicate_detector', o FROM c8
                 UNION ALL SELECT 7, 'information_extractor',
                                  CASE WHEN id IN (SELECT id FROM infos) THEN 'extracted' ELSE 'none' END FROM c9"""),
]) + """
SELECT stage_no, stage, outcome, count(*) AS n FROM every GROUP BY ALL""")
def enrichment_chain(spark, d):
    """ST-2 + ST-3: all seven stages over the articles, as many as reach each, by outcome.

    Some articles come translated, classified or located already; duplicates and
    originals part at the sixth stage.
    """
    from newsflow.plans import chain as C
    a = TB.doc_articles(spark, d)
    stored = F.col("id") % 3 == 0
    a = a.select("id", "title", "language", "publish_date",
                 *[F.when(stored, F.col(c)).alias(c) for c in ("translated_title", "translation_language")],
                 F.when(F.col("id") % 13 == 0, "GB").alias("country_code"))
    done = TB.raw(spark, d, "labels").select(F.col("doc_id").alias("web_article_id"))
    run = C.run_chain(a, [
        C.translation_stage(CHAIN_LANGS, "en", lexicon=L.frame(spark, L.LEXICON)),
        C.zero_shot_stage(L.frame(spark, L.TEMPLATES), L.frame(spark, L.LABELS)),
        C.text_class_stage(L.frame(spark, L.KEYWORDS), results=done),
        C.geo_stage(L.frame(spark, L.GAZETTEER)), C.vector_stage(dim=32),
        C.duplicate_stage(timeframe_days=3, threshold=0.04), C.extraction_stage(L.frame(spark, L.RULES))])
    return run.outcomes().groupBy("stage_no", "stage", "outcome").agg(F.count(F.lit(1)).alias("n"))


@register("custom_stages", with_tables("doc_articles", extra=[
    ("g", "SELECT *, CASE WHEN language = 'en' THEN 'home' WHEN language IS NOT NULL THEN 'foreign' ELSE 'unknown' END AS o FROM doc_articles"),
    ("w", f"SELECT id, CASE WHEN len({S.tokens(S.effective_title())}) >= 50 THEN 'forward' ELSE 'stop' END AS o FROM g WHERE o = 'home'"),
]) + """
SELECT 'language_gate' AS stage, o AS outcome, count(*) AS n FROM g GROUP BY ALL
UNION ALL SELECT 'long_reads', o, count(*) FROM w GROUP BY ALL
UNION ALL SELECT 'branch', 'foreign', count(*) FROM g WHERE o = 'foreign' HAVING count(*) > 0""")
def custom_stages(spark, d):
    """M-11: two stages of a user in the chain, one parting articles by language, one forwarding long texts."""
    from newsflow.functions.text import effective_title
    from newsflow.operators.models import tokens
    from newsflow.plans import chain as C

    def language_gate(a):
        route = (F.when(F.col("language") == "en", "home").when(F.col("language").isNotNull(), "foreign").otherwise("unknown"))
        way = F.when(F.col("outcome") == "foreign", "foreign").otherwise(C.onward("home"))
        return C.StageResult("language_gate", outcomes=C.outcome(a, route, way))

    def long_reads(a):
        return C.StageResult("long_reads", forward=a.where(F.size(tokens(effective_title())) >= 50).select("id"))
    run = C.run_chain(TB.doc_articles(spark, d), [language_gate, long_reads])
    out = run.outcomes().groupBy("stage", "outcome").agg(F.count(F.lit(1)).alias("n"))
    for name, frame in run.branches.items():
        out = out.unionByName(frame.groupBy(F.lit("branch").alias("stage"), F.lit(name).alias("outcome"))
                              .agg(F.count(F.lit(1)).alias("n")))
    return out


@register("text_classes_from_labels", """
SELECT doc_id AS web_article_id, 'quality' AS type, CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END AS label,
       CAST(1.0 AS FLOAT) AS confidence FROM labels
UNION ALL
SELECT doc_id, 'toxic', CASE WHEN toxic = 1 THEN 'yes' ELSE 'no' END, CAST(1.0 AS FLOAT) FROM labels""")
def text_classes_from_labels(spark, d):
    """K-3: classes of an external classifier appended in two batches, the first replayed, and read back."""
    import uuid

    from newsflow.operators.sinks import append_results, read_results
    from newsflow.session import ensure_checkpoint_dir
    lab = TB.raw(spark, d, "labels")
    q = lab.select(F.col("doc_id").alias("web_article_id"), F.lit("quality").alias("type"),
                   F.when(F.col("quality") == 1, "good").otherwise("bad").alias("label"))
    t = lab.select(F.col("doc_id").alias("web_article_id"), F.lit("toxic").alias("type"),
                   F.when(F.col("toxic") == 1, "yes").otherwise("no").alias("label"))
    both = q.unionByName(t).withColumn("confidence", F.lit(1.0).cast("float"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/newsflow/text_classes-{uuid.uuid4().hex}"
    for epoch, rows in ((0, both.where("type = 'quality'")), (1, both), (0, both.where("type = 'quality'"))):
        append_results(rows, "text_classes", path, epoch)
    return read_results(spark, "text_classes", path).select("web_article_id", "type", "label", "confidence")


@register("twitter_sources_by_type", with_tables("twitter_sources", "incoming_tweets") + """
SELECT s.type, count(DISTINCT s.id) AS n_sources, count(t.upstream_id) AS n_tweets
FROM twitter_sources s LEFT JOIN incoming_tweets t ON s.type = 'user' AND t.username = s.text
WHERE s.deleted_at IS NULL AND s.type IN ('user', 'search') GROUP BY s.type""")
def twitter_sources_by_type(spark, d):
    """F-18: user vs query sources (live only), with the tweets of user sources."""
    s = L.frame(spark, L.TWITTER_SOURCES).where("deleted_at IS NULL AND type IN ('user', 'search')")
    t = TB.incoming_tweets(spark, d).select("username", "upstream_id")
    j = s.join(t, (s.type == "user") & (t.username == s.text), "left")
    return j.groupBy("type").agg(F.countDistinct("id").alias("n_sources"), F.count("upstream_id").alias("n_tweets"))


@register("ids_from_urls", r"""
WITH t AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]+/[^/]+/([^?#]*)', 1) AS id_text FROM pages),
p AS (SELECT page_id, id_text,
             CASE WHEN regexp_full_match(id_text, '[0-9]{1,19}') THEN TRY_CAST(id_text AS BIGINT) END AS id FROM t)
SELECT page_id, id_text, id, CASE WHEN id_text IS NOT NULL AND id IS NULL THEN 'invalid id: ' || id_text END AS error
FROM p""")
def ids_from_urls(spark, d):
    """SC-15: the numeric id in the path of every page URL; text that is not an id is an error of its row."""
    from newsflow.functions.text import parse_id
    t = TB.raw(spark, d, "pages").select(
        "page_id", F.regexp_extract("url", r"^[a-z]+://[^/]+/[^/]+/([^?#]*)", 1).alias("id_text"))
    return t.select("page_id", "id_text", parse_id("id_text").alias("p")).select("page_id", "id_text", "p.id", "p.error")
