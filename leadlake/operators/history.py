"""Current offerings, review candidates and change events, kept up to date by set-based merges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.constants import MATERIAL_COLUMNS
from leadlake.operators.merge import KEEP, OVERWRITE, merge
from leadlake.operators.ordered import with_previous
from leadlake.schemas import EVENT_DETAIL, OFFERING_COLUMNS
from leadlake.sources.buckets import BucketTable

OFFERING_KEYS = ["competitor_id", "offering_key"]
CRAWL_ORDER = ["observed_at", "run_id", "page_ord", "cand_ord"]
EVENT_ORDER = ["occurred_at", "run_id", "page_ord", "cand_ord"]


def offering_id() -> Column:
    """Stable id of an offering, computed alike for facts and events: no join is needed to link them."""
    return F.sha2(F.concat_ws("|", *OFFERING_KEYS), 256)


def merge_offerings(current: DataFrame, published: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One current fact per (competitor, offering): the last observation wins, the first publication time stays.

    `columns` names the facts that the caller reads, if not all: the merge handles rows as wholes, which hides from Spark what is read of them.
    """
    facts = [c for c in OFFERING_COLUMNS if c in OFFERING_KEYS or columns is None or c in columns]
    batch = published.withColumns({"first_published_at": F.col("observed_at"), "updated_at": F.col("observed_at")})
    rules = {c: OVERWRITE for c in facts if c not in OFFERING_KEYS}
    rules |= {"first_published_at": KEEP, "updated_at": OVERWRITE}
    if columns is not None:
        current = current.select("id", *facts, "first_published_at", "updated_at")
    return merge(current, batch, OFFERING_KEYS, rules, CRAWL_ORDER).withColumn("id", F.coalesce("id", offering_id()))


def merge_candidates(current: DataFrame, pending: DataFrame) -> DataFrame:
    """One review candidate per fingerprint: seen again, only its last-seen time and evidence page change."""
    batch = pending.withColumns({"first_seen_at": F.col("observed_at"), "review_status": F.lit("pending")})
    rules = {c: KEEP for c in OFFERING_COLUMNS if c != "source_fingerprint"}
    rules |= {"review_status": KEEP, "review_reason": KEEP, "first_seen_at": KEEP}
    rules |= {"last_seen_at": OVERWRITE, "evidence_page_id": OVERWRITE}
    return merge(current, batch, ["source_fingerprint"], rules, CRAWL_ORDER)


def change_events(current: DataFrame, published: DataFrame, slice_by: Column | None = None) -> DataFrame:
    """Added and changed events, in the order the observations were made.

    The row before an observation is the earlier observation of the same offering, or the stored fact. `slice_by` splits offerings
    along time (default: by day).
    """
    stored = current.select(*OFFERING_KEYS, *MATERIAL_COLUMNS, F.lit(0).alias("_seen"))
    rows = published.withColumn("_seen", F.lit(1)).unionByName(stored, allowMissingColumns=True)
    day = F.date_trunc("DAY", F.col("observed_at")) if slice_by is None else slice_by
    start = F.lit("0001-01-01").cast("timestamp")
    slices = F.when(F.col("_seen") == 0, start).otherwise(F.coalesce(day, start))
    rows = with_previous(rows, OFFERING_KEYS, ["_seen", *CRAWL_ORDER], MATERIAL_COLUMNS, slices, "_before")
    added = F.when(F.col("offering_type") == "offer", "competitor_offer_added").otherwise("competitor_offering_added")
    differs = ~F.col("_before").eqNullSafe(F.struct(*MATERIAL_COLUMNS))
    event = F.when(F.col("_before").isNull(), added).when(differs, "competitor_price_changed")
    return rows.where(F.col("_seen") == 1).withColumn("event_type", event).where(F.col("event_type").isNotNull()).select(
        "competitor_id", offering_id().alias("offering_id"), "event_type", F.col("observed_at").alias("occurred_at"),
        F.struct("offering_key", "display_name", "qualifier", F.col("_before.price_display").alias("old_price"),
                 F.col("price_display").alias("new_price"), "source_url").alias("detail"),
        F.concat_ws(":", "event_type", "source_fingerprint").alias("source_fingerprint"),
        "run_id", "page_ord", "cand_ord",
    )


def merge_stored_offerings(table: BucketTable, published: DataFrame, version: int) -> int:
    """`merge_offerings` onto a stored version of current facts, of which only the buckets of the batch's competitors are read and written."""
    return table.merge(published, merge_offerings, version)


def _with_details(events: DataFrame, details: Sequence[str] | None) -> DataFrame:
    """Events with only those fields of `detail`, and the one of which ids are made. Rows are merged as wholes, which hides from Spark what is read of them."""
    if details is None:
        return events
    kept = [name for name in EVENT_DETAIL.fieldNames() if name in details or name == "offering_key"]
    fields = F.struct(*[F.col(f"detail.{name}").alias(name) for name in kept])
    return events.withColumn("detail", F.when(F.col("detail").isNotNull(), fields))


def last_events(found: DataFrame, details: Sequence[str] | None = None) -> DataFrame:
    """The events of a log that a merge keeps: the last per type and fingerprint, dealt by it.

    For a log that several merges read: they need no shuffle after this one. `details` as in `merge_events`.
    """
    facts = F.struct(*EVENT_ORDER, "competitor_id", "event_type", "detail")
    last = _with_details(found, details).where(F.col("source_fingerprint").isNotNull()).groupBy("source_fingerprint").agg(F.max(facts).alias("_last"))
    return last.select("source_fingerprint", "_last.*")


def merge_events(current: DataFrame, found: DataFrame, details: Sequence[str] | None = None) -> DataFrame:
    """Events by type and fingerprint: a repeated change takes the place of the earlier one.

    `change_events` itself is the full log, in which both stay. `details` names the fields of `detail` that the caller reads, if not all.
    """
    rules = dict.fromkeys(["competitor_id", "event_type", "occurred_at", "detail"], OVERWRITE)
    # Ids are long and do not compress: they are made again from their columns instead of being shuffled.
    ids = {"offering_id": F.sha2(F.concat_ws("|", "competitor_id", "detail.offering_key"), 256)}
    return merge(_with_details(current, details), _with_details(found, details), ["source_fingerprint"], rules, EVENT_ORDER, derived=ids)
