"""Incremental discovery: each newly landed search answer is merged once.

The lead flow reruns safely because finished work is skipped. Over a landing folder the same holds through a file stream: its
checkpoint remembers which files were read, and every batch writes a snapshot version of its own, so a replayed batch gives
the same version again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leadlake import schemas
from leadlake.functions.text import metro_key
from leadlake.operators.markets import market_status, merge_market_status
from leadlake.operators.ordered import keep_first
from leadlake.plans.lead_flow import discover
from leadlake.sources import places

# The newest answer to each search; a market is judged by all of its searches, whichever batch brought them.
SEARCHES = "metro_key string, metro string, query_ord int, status string, error_message string"
STATUS = "metro_key string, metro string, last_status string, last_completed_at timestamp, last_error string, updated_at timestamp"


def version_path(root: str, version: int, table: str | None = None) -> str:
    """Folder of one version: of the businesses, or of the `searches` or the market `status`."""
    return "/".join([root.rstrip("/"), *([table] if table else []), f"version={version}"])


def newest_searches(known: DataFrame, batch: DataFrame) -> DataFrame:
    """One row per search: the batch's answer, else the known one. Of two answers in a batch an accepted one wins."""
    accepted = F.coalesce(F.col("status").isin(*places.ACCEPTED), F.lit(False))
    landed = batch.select(metro_key(F.col("metro")).alias("metro_key"), "metro", "query_ord", "status", "error_message", F.lit(1).alias("_new"))
    both = landed.unionByName(known.withColumn("_new", F.lit(0)))
    order = [F.desc("_new"), accepted.desc(), F.col("status"), F.col("error_message"), F.col("metro")]
    return keep_first(both, ["metro_key", "query_ord"], order).drop("_new")


def merge_landed_places(spark: SparkSession, landing: str, root: str, checkpoint: str, details: DataFrame, as_of: Column,
                        start: DataFrame | None = None) -> StreamingQuery:
    """Merge everything that has landed since the last call, then stop. The newest version is the batch number.

    `details` holds the details answers landed so far. The first batch is merged into `start`, an empty table unless given. A
    later batch needs the version before it: when that is gone the batch fails instead of starting over from nothing. The
    searches answered so far and the status of their markets are versioned beside the businesses: a market is complete once
    all of its searches have an accepted answer, whichever batches brought them.
    """
    answers = spark.readStream.schema(schemas.SEARCH_PAYLOAD).json(landing)

    def merge_batch(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession

        def before(schema, table: str | None = None) -> DataFrame:
            return session.read.schema(schema).parquet(version_path(root, number - 1, table)) if number else session.createDataFrame([], schema)

        def keep(rows: DataFrame, table: str | None = None) -> None:
            rows.write.mode("overwrite").parquet(version_path(root, number, table))

        current = start if start is not None and not number else before(schemas.BUSINESSES)
        keep(newest_searches(before(SEARCHES, "searches"), batch), "searches")
        searches = session.read.schema(SEARCHES).parquet(version_path(root, number, "searches"))
        touched = searches.join(batch.select(metro_key(F.col("metro")).alias("metro_key")).distinct(), "metro_key", "left_semi")
        searched = touched.groupBy("metro_key").agg(F.min("metro").alias("metro"))
        merged, _ = discover(current, searched, batch, details, as_of)
        status = market_status(searched, places.failed_searches(searched, touched), as_of)
        keep(merge_market_status(before(STATUS, "status"), status).select(*[c.split()[0] for c in STATUS.split(", ")]), "status")
        keep(schemas.conform(merged, schemas.BUSINESSES))

    return answers.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
