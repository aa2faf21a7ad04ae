"""Geo tagging (M-4, M-5, J-12, A-5, U-2, SC-11).

``geo_parse`` is the Spark-only default geo parser: place names of a small
gazetteer are matched against the 1..3-token n-grams of the chosen text
(P-6); mention counts are the scores.  ``geo_from_reply`` reads a stored
geo-service reply.  Both pick the best location with A-5: highest score,
the first in list order (cities, countries, states) wins a tie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions.text import geo_text
from newsflow.operators.common import bounded_broadcast
from newsflow.schemas import GEO_REPLY

KIND_ORDER = {"city": 0, "country": 1, "state": 2}


def best_location(locations) -> Column:
    """A-5 over ``array<struct<countryCode,score>>``: strict ``>`` keeps the first of equals."""
    locs = F.col(locations) if isinstance(locations, str) else locations
    init = F.struct(F.lit(None).cast("double").alias("score"), F.lit(None).cast("string").alias("code"))
    best = F.aggregate(locs, init, lambda acc, l: F.when(
        acc["score"].isNull() | (l["score"] > acc["score"]),
        F.struct(l["score"].alias("score"), l["countryCode"].alias("code"))).otherwise(acc))
    return best["code"]


def all_locations(reply) -> Column:
    """U-2: cities ++ countries ++ states, duplicates kept (missing lists are empty)."""
    r = F.col(reply) if isinstance(reply, str) else reply
    focus = r["results"]["places"]["focus"]
    empty = F.array().cast("array<struct<countryCode:string,score:double>>")
    return F.concat(F.coalesce(focus["cities"], empty), F.coalesce(focus["countries"], empty),
                    F.coalesce(focus["states"], empty))


def geo_from_reply(df: DataFrame, json_col: str = "reply") -> DataFrame:
    """M-5 + SC-11: add ``locations`` and ``country_code`` from a JSON reply (bad JSON -> NULL)."""
    parsed = F.from_json(F.col(json_col), GEO_REPLY, {"mode": "PERMISSIVE"})
    return df.withColumn("locations", all_locations(parsed)) \
             .withColumn("country_code", best_location("locations"))


def geo_parse(articles: DataFrame, gazetteer: DataFrame, max_ngram: int = 3) -> DataFrame:
    """M-4: (id, country_code) per article; NULL when nothing is found (still forwarded).

    Pass 1 matches place names without demonyms; only articles without a
    find in pass 1 get pass 2 with demonyms.  Both come from one scan of the texts:
    a demonym's score ranks after every score without.

    A text is read as the run of ``max_ngram`` tokens that begins at each token; only
    runs whose first token begins a name are opened into their n-grams.
    """
    words = F.trim(F.regexp_replace(F.lower(geo_text()["text"]), r"[^\p{L}\p{N}]+", " "))
    run = rf"(?=([^ ]+(?: [^ ]+){{0,{max_ngram - 1}}}))[^ ]+"
    runs = articles.select("id", F.posexplode(F.regexp_extract_all(words, F.lit(run), 1)).alias("pos", "run"))
    gz = bounded_broadcast(gazetteer.select("name", "country_code", "kind", "demonym").where("demonym IS NOT NULL"))
    firsts = bounded_broadcast(gazetteer.select(F.substring_index("name", " ", 1).alias("first")).distinct())
    runs = runs.withColumn("first", F.substring_index("run", " ", 1)).join(firsts, "first", "left_semi")
    grams = runs.withColumn("t", F.split("run", " ")).select("id", "pos", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("t")), lambda n: F.array_join(F.slice("t", 1, n), " "))).alias("name"))
    hits = grams.join(gz, "name")
    kind_rank = F.lit(None).cast("int")
    for k, v in KIND_ORDER.items():
        kind_rank = F.when(F.col("kind") == k, F.lit(v)).otherwise(kind_rank)
    scores = hits.groupBy("id", "demonym", "kind", "country_code").agg(
        F.count(F.lit(1)).cast("double").alias("score"), F.min("pos").alias("first_pos"))
    found = scores.groupBy("id").agg(F.min_by("country_code", F.struct(
        F.col("demonym"), -F.col("score"), kind_rank.alias("kind_rank"), F.col("first_pos"), F.col("country_code")))
        .alias("country_code"))
    return articles.select("id").join(found, "id", "left")
