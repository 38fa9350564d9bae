"""Lead flow as one lazy plan: businesses and captured pages in, scored businesses with opening lines out.

    captures -> page signals (map only)  \\
                                           join on place_id -> site -> booking -> social -> score -> contact -> hook
    businesses                            /

Only the small signal rows meet the business rows in a shuffle; page sources never do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake import schemas
from leadlake.functions.text import metro_key
from leadlake.operators import contact, hooks, site
from leadlake.operators.markets import is_fresh, market_status
from leadlake.operators.merge import COALESCE, KEEP, OVERWRITE, merge, reduce_batch
from leadlake.operators.score import with_score
from leadlake.operators.signals import page_signals
from leadlake.sources import places
from leadlake.sources.captures import with_page_parts
from leadlake.sources.tables import events

BUSINESS_RULES = {"name": OVERWRITE, "metro": OVERWRITE, "address": COALESCE, "phone": COALESCE, "website_url": COALESCE,
                  "rating": COALESCE, "review_count": COALESCE, "discovered_at": KEEP}
CAPTURE_FACTS = ["place_id", "https_probe_raised", "fetch_error", "http_status", "final_url"]


def merge_businesses(current: DataFrame, found: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Upsert discovered places; enrichment columns of known places are kept."""
    defaults = {"email_status": F.lit("not_attempted"), "review_status": F.lit("new")}
    return merge(current, found, ["place_id"], BUSINESS_RULES, order, defaults)


def due_metros(markets: DataFrame, discovery_runs: DataFrame, as_of: Column, force: bool = False) -> DataFrame:
    """Metros without a completed discovery in the window. `discovery_runs`: metro_key, completed_at (NULL = incomplete)."""
    fresh = discovery_runs.where(is_fresh(F.col("completed_at"), as_of) & F.lit(not force)).select("metro_key")
    return markets.join(fresh, "metro_key", "left_anti")


def discover(current: DataFrame, searched: DataFrame, search_payloads: DataFrame, details_payloads: DataFrame,
             as_of: Column) -> tuple[DataFrame, DataFrame]:
    """(businesses, market status) after a discovery batch. Later queries win; missing facts never erase stored ones."""
    order = ["metro_key", "query_ord", "result_ord"]
    found = {c: rule for c, rule in BUSINESS_RULES.items() if c not in ("phone", "website_url", "discovered_at")}
    # One row per place first: contact facts depend on the place alone, so a place in every answer is joined once.
    results = reduce_batch(places.search_results(search_payloads), ["place_id"], order, found)
    stored = current.select("place_id", "phone", F.col("website_url").alias("website"))
    complete = places.with_contact_facts(results, stored, places.place_details(details_payloads)).withColumnRenamed(
        "website", "website_url").withColumn("discovered_at", as_of.cast("timestamp"))
    status = market_status(searched, places.failed_searches(searched, search_payloads), as_of)
    return merge_businesses(current, complete), status


def captured_signals(captures: DataFrame, ignore_social_hosts: bool = False) -> DataFrame:
    """One small row per captured homepage."""
    usable = F.when(F.col("fetch_error").isNull() & ~F.coalesce(F.col("http_status") >= 400, F.lit(False)), F.col("html"))
    pages = with_page_parts(captures.withColumn("html", usable)).drop("content_sha256")
    return page_signals(pages, CAPTURE_FACTS, ignore_social_hosts).withColumnsRenamed({
        "has_online_booking": "page_booking", "booking_platform": "page_booking_platform"})


def enrich(businesses: DataFrame, captures: DataFrame, as_of: Column, finder: DataFrame | None = None,
           generated_hooks: DataFrame | None = None, ignore_social_hosts: bool = False) -> DataFrame:
    """Run every stage on the rows that still need it, rescore all rows, and return the new snapshot.

    `captures` has one row per place_id. `generated_hooks` (place_id, generated) may bring lines from a text generator.
    """
    stamp = as_of.cast("timestamp")
    signals = captured_signals(captures, ignore_social_hosts).withColumn("_captured", F.lit(True))
    rows = businesses.join(signals, "place_id", "left")
    captured = F.coalesce("_captured", F.lit(False))

    def stage(rows: DataFrame, name: str, result: Column, stamp_column: str, columns: list[str]) -> DataFrame:
        rows = rows.withColumn("_run", site.ready(name, captured)).withColumn("_new", result)
        return rows.withColumns({
            **{c: F.when(F.col("_run"), F.col(f"_new.{c}")).otherwise(F.col(c)) for c in columns},
            stamp_column: F.when(F.col("_run"), stamp).otherwise(F.col(stamp_column)),
        }).drop("_run", "_new")

    rows = stage(rows, "enrich_site", site.site_state(F.col("page_platform"), F.col("page_mobile")), "site_fetched_at",
                 ["site_fetch_status", "site_platform", "has_ssl", "is_mobile_friendly"])
    checked = site.booking_gate() & ~site.fetch_failed()
    booking = F.struct(
        F.when(checked, F.col("page_booking")).otherwise(0).alias("has_online_booking"),
        F.when(checked, F.col("page_booking_platform")).alias("booking_platform"))
    rows = stage(rows, "enrich_booking", booking, "booking_checked_at", ["has_online_booking", "booking_platform"])
    rows = stage(rows, "enrich_social", site.social_state(F.col("page_instagram"), F.col("page_facebook")),
                 "social_checked_at", ["instagram_url", "facebook_url", "social_status"])
    rows = with_score(rows).withColumn("scored_at", stamp)

    # Contact comes after scoring: the finder is asked for good leads only.
    rows = rows.withColumn("_run", site.ready("enrich_contact", captured))
    scanned = F.col("_run") & site.contact_gate() & ~site.fetch_failed()
    rows = rows.withColumns({"_form": site.contact_form(F.when(scanned, F.col("contact_href"))),
                             "_email": F.when(scanned, F.col("page_email"))})
    rows = rows.withColumns({
        "notes": F.when(site.has_text(F.col("_form")), F.concat(F.lit("Contact form found: "), F.col("_form")))
        .otherwise(F.col("notes")),
        "email": F.coalesce("_email", "email"),
        "email_status": F.when(F.col("_email").isNotNull(), "verified").otherwise(F.col("email_status")),
    })
    rows = contact.with_finder(rows, F.col("_run"), finder)

    rows = hooks.with_template_hook(rows, "_line")
    line = F.col("_line")
    if generated_hooks is not None:
        rows = rows.join(generated_hooks.select("place_id", "generated"), "place_id", "left")
        line = hooks.choose_hook(F.col("generated"), line)
    rows = rows.withColumn("_run", site.pending("hooks"))
    rows = rows.withColumns({
        "hook_text": F.when(F.col("_run"), line).otherwise(F.col("hook_text")),
        "hook_generated_at": F.when(F.col("_run"), stamp).otherwise(F.col("hook_generated_at")),
    })
    return schemas.conform(rows, schemas.BUSINESSES)


def stage_totals(before: DataFrame, after: DataFrame, captures: DataFrame) -> DataFrame:
    """Rows each stage worked on: (stage, rows). `captures` tells which rows the contact stage, which leaves no time stamp, could run on."""
    marks = {"enrich_site": "site_fetched_at", "enrich_booking": "booking_checked_at",
             "enrich_social": "social_checked_at", "hooks": "hook_generated_at"}
    old = before.select("place_id", *[F.col(c).alias(f"_{c}") for c in marks.values()])
    done = after.join(old, "place_id", "left").agg(*[
        F.count_if(F.col(c).isNotNull() & F.col(f"_{c}").isNull()).alias(s) for s, c in marks.items()],
        F.count(F.lit(1)).alias("score"))
    seen = captures.select("place_id", F.lit(True).alias("_captured"))
    contacted = before.join(seen, "place_id", "left").agg(
        F.count_if(site.ready("enrich_contact", F.coalesce("_captured", F.lit(False)))).alias("rows"))
    return done.unpivot([], [*marks, "score"], "stage", "rows").unionByName(contacted.select(F.lit("enrich_contact").alias("stage"), "rows"))


def run_events(before: DataFrame, after: DataFrame, captures: DataFrame, as_of: Column) -> DataFrame:
    """Log entries of one enrichment run: per-row outcomes and one completion line per stage.

    Pass stored snapshots: `after` is read once for the rows and once for the totals.
    """
    old = before.select("place_id", F.col("site_fetched_at").alias("_site"), F.col("hook_generated_at").alias("_hook"),
                        F.col("booking_checked_at").alias("_booking"), F.col("social_checked_at").alias("_social"),
                        F.col("notes").alias("_notes"), F.col("email").alias("_email"))
    fetches = captures.select("place_id", site.fetch_failed().alias("_failed"))
    rows = after.join(old, "place_id", "left").join(fetches, "place_id", "left")
    name, failed = F.col("name"), F.coalesce("_failed", F.lit(False))
    status = F.col("site_fetch_status")
    fetched = F.when(F.col("_site").isNull() & F.col("site_fetched_at").isNotNull(),
                     F.concat(F.lit("Site "), status, F.lit(" for "), F.col("name"), F.lit(", platform "), F.col("site_platform")))
    # A fetch that failed over its certificate is an error state without encryption; like a timeout it only warns.
    no_tls = (status == "error") & F.coalesce(F.col("has_ssl") == 0, F.lit(False))
    level = F.when((status == "timeout") | no_tls, "warn").when(status == "error", "error").otherwise("info")

    def checked(since: str, now: str, message: Column) -> Column:
        return F.when(F.col(since).isNull() & F.col(now).isNotNull(), message)

    def shown(value: str) -> Column:
        return F.coalesce(F.col(value).cast("string"), F.lit("none"))

    booking_error = site.booking_gate() & failed
    booking = checked("_booking", "booking_checked_at", F.when(~site.booking_gate(), F.concat(F.lit("Booking check skipped for "), name)).when(
        failed, F.concat(F.lit("Booking check failed for "), name)).otherwise(F.concat(
            F.lit("Booking check for "), name, F.lit(": "), shown("has_online_booking"), F.lit(", platform "), shown("booking_platform"))))
    own_site = (site.url_lower() != "") & ~site.social_hub()
    social = checked("_social", "social_checked_at", F.when(own_site, F.when(failed, F.concat(F.lit("Social check failed for "), name)).otherwise(
        F.concat(F.lit("Social check for "), name, F.lit(": "), shown("instagram_url"), F.lit(", "), shown("facebook_url")))))
    form = F.when(F.col("notes").isNotNull() & ~F.col("notes").eqNullSafe(F.col("_notes")), F.col("notes"))
    address = F.when(F.col("email").isNotNull() & ~F.col("email").eqNullSafe(F.col("_email")),
                     F.concat(F.lit("Found email for "), F.col("name"), F.lit(": "), F.col("email")))
    hook = F.when(F.col("_hook").isNull() & F.col("hook_generated_at").isNotNull(),
                  F.concat(F.lit("Generated hook: "), F.col("hook_text")))
    # One pass over the joined rows: every row carries its own short list of entries.
    entries = F.array(
        F.struct(F.lit("enrich_site").alias("stage"), level.alias("level"), fetched.alias("message")),
        F.struct(F.lit("enrich_booking").alias("stage"), F.when(booking_error, "error").otherwise("info").alias("level"), booking.alias("message")),
        F.struct(F.lit("enrich_social").alias("stage"), F.when(failed, "error").otherwise("info").alias("level"), social.alias("message")),
        F.struct(F.lit("enrich_contact").alias("stage"), F.lit("info").alias("level"), form.alias("message")),
        F.struct(F.lit("enrich_contact").alias("stage"), F.lit("info").alias("level"), address.alias("message")),
        F.struct(F.lit("hooks").alias("stage"), F.lit("info").alias("level"), hook.alias("message")),
    )
    per_row = rows.select("place_id", F.explode(F.filter(entries, lambda e: e.message.isNotNull())).alias("entry")).select(
        "place_id", "entry.*", as_of.cast("timestamp").alias("created_at"))
    totals = stage_totals(before, after, captures).select(
        F.lit(None).cast("string").alias("place_id"), "stage", F.lit("info").alias("level"),
        F.concat(F.lit("Completed stage for "), F.col("rows").cast("string"), F.lit(" businesses")).alias("message"),
        as_of.cast("timestamp").alias("created_at"))
    return per_row.unionByName(totals)


def discovery_events(searched: DataFrame, status: DataFrame, as_of: Column) -> DataFrame:
    """One entry per searched metro: completed, or why not."""
    done = F.col("last_status") == "complete"
    message = F.when(done, F.concat(F.lit("Completed discovery for metro: "), F.col("metro"))).otherwise(F.col("last_error"))
    return events(status.join(searched.select(metro_key(F.col("metro")).alias("metro_key")).distinct(), "metro_key",
                              "left_semi"), "discover", F.when(done, "info").otherwise("error"), message, as_of)
