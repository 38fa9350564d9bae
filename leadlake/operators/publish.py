"""From candidates to observations: catalog mapping, publication policy, fingerprints, first-seen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.constants import CITY_STATE, DEFAULT_SUFFIXES
from leadlake.functions.prices import fingerprint, minor_units, offering_key
from leadlake.functions.text import normalize_label, null_if_empty
from leadlake.functions.urls import booking_hosts, canonical_url, registrable_host
from leadlake.operators.ordered import keep_first
from leadlake.schemas import OFFERING_COLUMNS


def on_booking_host(url: Column, suffixes: Sequence[str] = DEFAULT_SUFFIXES) -> Column:
    return registrable_host(url, suffixes).isin(*booking_hosts())


def booking_branded(final_url: Column, business_name: Column, page_text: Column,
                    suffixes: Sequence[str] = DEFAULT_SUFFIXES) -> Column:
    """True unless the page lies on a shared booking host and does not name the business."""
    shared = on_booking_host(final_url, suffixes)
    # Page text is normalized for shared hosts only.
    named = F.contains(normalize_label(F.when(shared, page_text)), normalize_label(business_name))
    return ~shared | named


def alias_table(aliases: DataFrame) -> DataFrame:
    return aliases.groupBy(F.col("raw_name_key").alias("normalized_name")).agg(
        F.max("service_catalog_id").alias("alias_id"))


def catalog_table(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy(normalize_label(F.col("name")).alias("normalized_name")).agg(F.max("id").alias("catalog_id"))


def with_catalog(found: DataFrame, aliases: DataFrame, catalog: DataFrame) -> DataFrame:
    """service_catalog_id by alias, else by catalog name."""
    mapped = found.join(alias_table(aliases), "normalized_name", "left").join(catalog_table(catalog), "normalized_name", "left")
    return mapped.withColumn("service_catalog_id", F.coalesce(null_if_empty(F.col("alias_id")), F.col("catalog_id"))).drop(
        "alias_id", "catalog_id")


def validate(found: DataFrame) -> DataFrame:
    """Add currency by market, offering_key, source_fingerprint, publication_status and review_reason.

    Needs competitor_id, market, branded, normalized_name, service_catalog_id and the candidate columns. The first reason
    that applies keeps a candidate from being published; none is dropped.
    """
    shown = found.withColumns({
        "normalized_evidence": normalize_label(F.col("evidence_text")),
        "_shown": normalize_label(F.col("price_display")),
        "_canonical": canonical_url(F.col("source_url")),
    })
    priced = F.col("price_type") != "none"
    in_evidence = lambda text: F.contains(F.col("normalized_evidence"), text)
    no_display = (F.coalesce("price_display", F.lit("")) == "") | ~in_evidence(F.col("_shown"))
    dollar_market = F.coalesce(F.col("market").rlike(CITY_STATE), F.lit(False))
    reason = (
        F.when(~F.col("branded"), "unverified_booking_brand")
        .when(~in_evidence(F.col("normalized_name")), "name_not_in_evidence")
        .when(priced & no_display, "amount_not_in_evidence")
        .when(priced & F.col("currency").isNull() & ~dollar_market, "unknown_currency")
        .when(priced & F.col("currency").isNotNull() & (F.col("price_type") == "range") & F.col("amount_max").isNull(),
              "ambiguous_price_semantics")
        .when(priced & minor_units(F.col("amount_min")).isNull(), "amount_out_of_range")
        .when(~priced & (F.coalesce("service_catalog_id", F.lit("")) == ""), "service_mapping_needed")
    )
    reached_currency = F.col("branded") & in_evidence(F.col("normalized_name")) & priced & ~no_display
    judged = shown.withColumns({
        "review_reason": reason,
        "currency": F.when(reached_currency & F.col("currency").isNull() & dollar_market, "USD").otherwise(F.col("currency")),
        "amount_min_minor": minor_units(F.col("amount_min")),
        "amount_max_minor": minor_units(F.col("amount_max")),
        "original_amount_minor": minor_units(F.col("original_amount")),
        "offering_key": offering_key(F.col("offering_type"), F.col("normalized_name"), F.col("qualifier"),
                                     F.col("price_unit"), F.col("package_quantity")),
    })
    hashed = [F.col(c) for c in (
        "competitor_id", "_canonical", "offering_key", "price_type", "amount_min_minor", "amount_max_minor", "currency",
        "price_unit", "package_quantity", "original_amount_minor", "valid_from", "valid_through", "normalized_evidence")]
    return judged.withColumns({
        "source_fingerprint": fingerprint(*hashed),
        "publication_status": F.when(F.col("review_reason").isNull(), "published").otherwise("pending"),
    }).drop("_shown", "_canonical", "normalized_evidence")


def first_seen(observations: DataFrame) -> DataFrame:
    """First observation per fingerprint within a crawl run."""
    return keep_first(observations, ["competitor_id", "run_id", "source_fingerprint"],
                      [F.col("page_ord"), F.col("cand_ord")])


def evidence_page_id(content_sha256: Column) -> Column:
    """Stable id of a captured page, computed alike for pages and observations: no join is needed to link them."""
    return F.sha2(F.concat_ws("|", "competitor_id", "run_id", F.col("page_ord").cast("string"), content_sha256), 256)


def offering_values(observations: DataFrame) -> DataFrame:
    """The stored columns, with run order and publication state alongside."""
    return observations.withColumn("last_seen_at", F.col("observed_at")).select(
        *OFFERING_COLUMNS, "run_id", "page_ord", "cand_ord", "observed_at", "publication_status", "review_reason")


def duplicates_collapsed(found: DataFrame, kept: DataFrame, page_keys: list[str]) -> DataFrame:
    """Candidates that repeated an earlier observation, per page. Two small aggregates, no per-row window."""
    n_found = found.groupBy(*page_keys).agg(F.count(F.lit(1)).alias("candidates"))
    n_kept = kept.groupBy(*page_keys).agg(F.count(F.lit(1)).alias("_kept"))
    return n_found.join(n_kept, page_keys, "left").select(
        *page_keys, "candidates", (F.col("candidates") - F.coalesce("_kept", F.lit(0))).alias("duplicates"))
