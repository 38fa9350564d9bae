"""Crawl runs: page errors, run status, evidence pages, competitor merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.operators.merge import KEEP, OVERWRITE, merge
from leadlake.operators.publish import evidence_page_id

RUN_KEYS = ["competitor_id", "run_id"]
PAGE_KEYS = [*RUN_KEYS, "page_ord"]


def crawl_errors(captures: DataFrame) -> DataFrame:
    """One row per failed page. Needs `outcome`. Errors stay rows, so a run with many of them is not one value."""
    return captures.where(F.col("outcome") != "ok").select(
        *PAGE_KEYS, "url", F.lit("RuntimeError").alias("code"), F.col("outcome").alias("message"))


def run_status(succeeded: Column, errors: Column) -> Column:
    return F.when(succeeded == 0, "failed").when(errors == 0, "complete").otherwise("partial")


def crawl_runs(captures: DataFrame) -> DataFrame:
    """One row per run with its status and counts. Needs `outcome`."""
    ok = F.col("outcome") == "ok"
    counted = captures.groupBy(*RUN_KEYS).agg(
        F.min("captured_at").alias("started_at"), F.max("captured_at").alias("completed_at"),
        F.count(F.lit(1)).alias("pages_attempted"), F.count_if(ok).alias("pages_succeeded"),
        F.count_if(~ok).alias("error_count"))
    return counted.withColumn("status", run_status(F.col("pages_succeeded"), F.col("error_count")))


def opened_runs(captures: DataFrame) -> DataFrame:
    """One row per run as it starts: processing, without counts or an end."""
    return captures.groupBy(*RUN_KEYS).agg(F.min("captured_at").alias("started_at")).withColumn("status", F.lit("processing"))


def merge_runs(current: DataFrame, found: DataFrame) -> DataFrame:
    """Runs by competitor and run id: state and counts are those of the batch, the first start stays."""
    rules = {"started_at": KEEP, **dict.fromkeys(["status", "completed_at", "pages_attempted", "pages_succeeded", "error_count"], OVERWRITE)}
    return merge(current, found, RUN_KEYS, rules)


def abandoned_runs(stored: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """Runs still processing `hours` after their start, as failed: their job never came to its end. They count as no crawl, so they are due again."""
    late = (F.col("status") == "processing") & (F.col("started_at") < as_of.cast("timestamp") - F.make_interval(hours=F.lit(hours)))
    return stored.where(late).withColumn("status", F.lit("failed"))


def batch_totals(discovered: DataFrame, enriched: DataFrame, runs: DataFrame) -> DataFrame:
    """One row: competitors discovered, enriched, and websites crawled."""
    def tally(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("total"), "n")

    crawled = runs.where(F.col("status").isNotNull())
    return tally(discovered, "discovered").unionByName(tally(enriched, "enriched")).unionByName(tally(crawled, "crawled"))


def evidence_pages(pages: DataFrame, observations: DataFrame) -> DataFrame:
    """Page rows that brought at least one new observation, without their source text."""
    seen = observations.select(*PAGE_KEYS).distinct()
    return pages.select(
        *PAGE_KEYS, evidence_page_id(F.col("content_sha256")).alias("evidence_page_id"),
        F.col("url").alias("source_url"), "final_url", "render_mode", F.col("title"), "http_status", "content_sha256",
        F.concat_ws("/", "competitor_id", "run_id", F.concat("content_sha256", F.lit(".html"))).alias("archive_path"),
        "captured_at",
    ).join(seen, PAGE_KEYS, "left_semi")


def write_archive(pages: DataFrame, observations: DataFrame, path: str, buckets: int = 256) -> None:
    """Page sources behind observations, by competitor bucket. Rebalancing splits a bucket that one competitor fills."""
    kept = pages.join(observations.select(*PAGE_KEYS).distinct(), PAGE_KEYS, "left_semi").select(
        F.pmod(F.xxhash64("competitor_id"), F.lit(buckets)).cast("int").alias("bucket"), *PAGE_KEYS, "content_sha256", "html")
    kept.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(path)


def merge_competitors(current: DataFrame, found: DataFrame, as_of: Column) -> DataFrame:
    """Competitors by place: name, website, rating and review count are overwritten, also with NULL."""
    stamp = as_of.cast("timestamp")
    batch = found.withColumns({
        "id": F.concat(F.lit("cmp_"), F.substring(F.sha2(F.col("place_id"), 256), 1, 32)),
        "reviews_checked_at": stamp, "last_discovered_at": stamp, "updated_at": stamp})
    rules = {"id": KEEP, **dict.fromkeys(["name", "website", "rating", "review_count", "reviews_checked_at",
                                          "last_discovered_at", "updated_at"], OVERWRITE)}
    # A place found in several markets is written once per market, in market order.
    return merge(current, batch, ["place_id"], rules, ["metro_key"])


def memberships(found: DataFrame, competitors: DataFrame, as_of: Column) -> DataFrame:
    """(competitor_id, metro_key, metro, last_seen_at) for places found in a market."""
    ids = competitors.select("place_id", F.col("id").alias("competitor_id"))
    return found.select("place_id", "metro_key", "metro").join(ids, "place_id").select(
        "competitor_id", "metro_key", "metro", as_of.cast("timestamp").alias("last_seen_at"))


def merge_memberships(current: DataFrame, found: DataFrame) -> DataFrame:
    return merge(current, found, ["competitor_id", "metro_key"], {"metro": OVERWRITE, "last_seen_at": OVERWRITE},
                 ["last_seen_at", "metro"])


def enrich_competitors(competitors: DataFrame, signals: DataFrame, handle: Column, as_of: Column) -> DataFrame:
    """Booking platform, check time and handle for competitors whose page was read; a stored handle is kept.

    `signals` has one row per competitor_id; `handle` is computed from its columns.
    """
    found = signals.select(F.col("competitor_id").alias("id"), F.col("booking_platform").alias("_platform"),
                           handle.alias("_handle"), F.lit(True).alias("_read"))
    stamp = as_of.cast("timestamp")
    read = F.col("_read") & F.col("website").isNotNull()
    stored_handle = F.when(F.coalesce("ig_handle", F.lit("")) != "", F.col("ig_handle"))
    return competitors.join(found, "id", "left").withColumns({
        "booking_platform": F.when(read, F.col("_platform")).otherwise(F.col("booking_platform")),
        "website_checked_at": F.when(read, stamp).otherwise(F.col("website_checked_at")),
        "updated_at": F.when(read, stamp).otherwise(F.col("updated_at")),
        "ig_handle": F.when(read, F.coalesce(stored_handle, F.col("_handle"))).otherwise(F.col("ig_handle")),
    }).select(*competitors.columns)
