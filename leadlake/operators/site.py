"""Stage rules of the lead flow: what each enrichment stage writes for a business, given its page signals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadlake import constants as C
from leadlake.functions.urls import lookup_domain, resolve_url

# --- fixed values: what marks a stage as still to do ---
PENDING = {
    "enrich_site": "site_fetched_at IS NULL",
    "enrich_booking": "booking_checked_at IS NULL",
    "enrich_social": "social_checked_at IS NULL",
    "enrich_contact": "email_status = 'not_attempted'",
    "hooks": "hook_generated_at IS NULL",
}


def pending(stage: str) -> Column:
    """Predicate of rows a stage still has to work on; every row for a stage without a marker."""
    return F.coalesce(F.expr(PENDING.get(stage, "true")), F.lit(False))


def url_lower() -> Column:
    return F.lower(F.coalesce("website_url", F.lit("")))


def has_text(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) != ""


def fetch_failed() -> Column:
    """The fetch raised an error or answered with an HTTP error status."""
    return F.col("fetch_error").isNotNull() | F.coalesce(F.col("http_status") >= 400, F.lit(False))


def social_hub() -> Column:
    return F.contains(url_lower(), F.lit("facebook.com")) | F.contains(url_lower(), F.lit("linktr.ee"))


def ready(stage: str, captured: Column) -> Column:
    """A stage can run once it needs no page, or the page has been captured. Other rows stay pending."""
    needs_page = {
        "enrich_site": (url_lower() != "") & ~social_hub(),
        "enrich_booking": booking_gate(),
        "enrich_social": (url_lower() != "") & ~social_hub(),
        "enrich_contact": contact_gate(),
    }.get(stage, F.lit(False))
    return pending(stage) & (~needs_page | captured)


def site_state(page_platform: Column, page_mobile: Column) -> Column:
    """Struct (site_fetch_status, site_platform, has_ssl, is_mobile_friendly); the first case that applies decides."""
    url = url_lower()
    error = F.col("fetch_error")
    secure = F.when(F.startswith(url, F.lit("http://")) & F.coalesce("https_probe_raised", F.lit(False)), 0) \
        .when(F.startswith(F.coalesce("final_url", F.lit("")), F.lit("https://")), 1).otherwise(0)

    def state(status: str, platform: Column | str, ssl, mobile) -> Column:
        as_col = lambda v, kind: v if isinstance(v, Column) else F.lit(v).cast(kind)
        return F.struct(F.lit(status).alias("site_fetch_status"), as_col(platform, "string").alias("site_platform"),
                        as_col(ssl, "int").alias("has_ssl"), as_col(mobile, "int").alias("is_mobile_friendly"))

    return (
        F.when(url == "", state("no_site", "none", 0, 0))
        .when(F.contains(url, F.lit("facebook.com")), state("no_site", "facebook", 1, 1))
        .when(F.contains(url, F.lit("linktr.ee")), state("no_site", "linktree", 1, 1))
        .when(error == "timeout", state("timeout", "unknown", None, None))
        .when(error == "tls", state("error", "unknown", 0, None))
        .when(fetch_failed(), state("error", "unknown", None, None))
        .otherwise(state("ok", page_platform, secure, page_mobile))
    )


def booking_gate() -> Column:
    """True when the page is worth a booking check: an own site that is not a social hub."""
    hub = F.coalesce(F.col("site_platform").isin("none", "facebook", "linktree"), F.lit(False))
    return (url_lower() != "") & ~hub


def social_state(page_instagram: Column, page_facebook: Column) -> Column:
    """Struct (instagram_url, facebook_url, social_status). Profiles are not visited, so a link means 'unknown'."""
    url = url_lower()
    readable = ~fetch_failed()
    none = F.lit(None).cast("string")

    def state(instagram: Column, facebook: Column, status) -> Column:
        status = status if isinstance(status, Column) else F.lit(status)
        return F.struct(instagram.alias("instagram_url"), facebook.alias("facebook_url"), status.alias("social_status"))

    linked = has_text(page_instagram) | has_text(page_facebook)
    return (
        F.when(F.contains(url, F.lit("facebook.com")), state(none, F.col("website_url"), "unknown"))
        .when(F.contains(url, F.lit("linktr.ee")) | (url == "") | ~readable, state(none, none, "none"))
        .otherwise(state(page_instagram, page_facebook, F.when(linked, "unknown").otherwise("none")))
    )


def contact_gate() -> Column:
    """True when the page is scanned for contact details."""
    url = url_lower()
    return (url != "") & ~F.startswith(url, F.lit("https://facebook.com")) & ~F.startswith(url, F.lit("https://linktr.ee"))


def contact_form(contact_href: Column) -> Column:
    """Contact page address; links that do not start with http are resolved against the website address."""
    absolute = F.startswith(F.lower(contact_href), F.lit("http"))
    return F.coalesce(F.when(absolute, contact_href),
                      resolve_url(F.when(~absolute, F.col("website_url")), F.when(~absolute, contact_href)))


def wants_email() -> Column:
    """A good lead without an address."""
    return (F.coalesce("deficiency_score", F.lit(0)) >= C.GOOD_LEAD_THRESHOLD) & ~has_text(F.col("email"))


def finder_domain() -> Column:
    """Domain to look an address up for; NULL for rows that only have a social hub or nothing."""
    domain = lookup_domain(F.col("website_url"))
    hub = F.startswith(domain, F.lit("facebook.com")) | F.startswith(domain, F.lit("linktr.ee"))
    return F.when((domain != "") & ~hub, domain)
