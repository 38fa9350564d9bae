"""Landed place-search and place-details answers as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake import schemas
from leadlake.constants import SEARCH_PHRASES
from leadlake.functions.text import metro_key
from leadlake.operators.ordered import keep_first

ACCEPTED = ("OK", "ZERO_RESULTS")


def search_requests(markets: DataFrame) -> DataFrame:
    """The searches to run for each market (columns metro_key, metro), in query order."""
    phrases = F.array(*[F.lit(p) for p in SEARCH_PHRASES])
    return markets.select("metro_key", "metro", F.posexplode(phrases).alias("query_ord", "phrase")).select(
        "metro_key", "metro", "query_ord", F.concat("phrase", F.lit(" in "), "metro").alias("query"))


def read_search_payloads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SEARCH_PAYLOAD).json(path)


def read_details_payloads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.DETAILS_PAYLOAD).json(path)


def search_failures(payloads: DataFrame) -> DataFrame:
    """Answers with a status other than OK or ZERO_RESULTS."""
    accepted = F.coalesce(F.col("status").isin(*ACCEPTED), F.lit(False))
    return payloads.where(~accepted).select(
        metro_key(F.col("metro")).alias("metro_key"), "query_ord", "status",
        F.coalesce("error_message", "status").alias("error"))


def failed_searches(searched: DataFrame, payloads: DataFrame) -> DataFrame:
    """Failures of the searched markets: answers that report one, and searches that nobody answered."""
    answered = payloads.select(metro_key(F.col("metro")).alias("metro_key"), "query_ord")
    silent = search_requests(searched).join(answered, ["metro_key", "query_ord"], "left_anti").select("metro_key", "query_ord")
    return search_failures(payloads).select("metro_key", "query_ord").unionByName(silent)


def search_results(payloads: DataFrame, missing_reviews_as_zero: bool = False) -> DataFrame:
    """One row per returned place, with its position. The price flow reads a missing review count as 0, the lead flow as NULL."""
    reviews = F.col("place.user_ratings_total")
    return (
        payloads.where(F.col("status").isin(*ACCEPTED))
        .select("metro", "query_ord", F.posexplode("results").alias("result_ord", "place"))
        .where(F.coalesce("place.place_id", F.lit("")) != "")
        .select(
            metro_key(F.col("metro")).alias("metro_key"), "metro", "query_ord", "result_ord", "place.place_id",
            "place.name", F.col("place.formatted_address").alias("address"), "place.rating",
            (F.coalesce(reviews, F.lit(0)) if missing_reviews_as_zero else reviews).alias("review_count"),
        )
    )


def place_details(payloads: DataFrame) -> DataFrame:
    """Phone and website per place; NULL unless the answer is OK. One row per place."""
    ok = F.col("status") == "OK"
    return keep_first(payloads.select(
        "place_id", ok.alias("_ok"),
        F.when(ok, F.col("result.formatted_phone_number")).alias("phone"),
        F.when(ok, F.col("result.website")).alias("website"),
    ), ["place_id"], [F.col("_ok").desc_nulls_last(), F.col("website"), F.col("phone")]).drop("_ok")


def dedupe_places(results: DataFrame, keys: tuple[str, ...] = ("metro_key", "place_id")) -> DataFrame:
    """One row per place: the last query that returned it wins."""
    return keep_first(results, list(keys), [F.desc("query_ord"), F.desc("result_ord")])


def new_places(results: DataFrame, stored: DataFrame) -> DataFrame:
    """Places not stored yet: the details work list."""
    return results.select("place_id").distinct().join(stored.select("place_id"), "place_id", "left_anti")


def with_contact_facts(places: DataFrame, stored: DataFrame, details: DataFrame, phone: bool = True) -> DataFrame:
    """Phone and website of each place: the stored ones for known places, the details answer for new ones."""
    columns = ["phone", "website"] if phone else ["website"]
    old = stored.select("place_id", *[F.col(c).alias(f"_old_{c}") for c in columns], F.lit(True).alias("_known"))
    fresh = details.select("place_id", *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = places.join(old, "place_id", "left").join(fresh, "place_id", "left")
    return joined.withColumns({
        c: F.when(F.col("_known"), F.col(f"_old_{c}")).otherwise(F.col(f"_new_{c}")) for c in columns
    }).drop("_known", *[f"_old_{c}" for c in columns], *[f"_new_{c}" for c in columns])
