"""Web-presence signals of one page, as columns over the page row. No shuffle, no explode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake import constants as C
from leadlake.functions.html import span_text
from leadlake.functions.text import contains_any, mentions, null_if_empty

def platform_from(html_lower: Column, final_url: Column) -> Column:
    """Site builder: the address first, then markers in the page."""
    url = F.lower(final_url)
    chain = F.when(F.contains(url, F.lit("linktr.ee")), "linktree").when(F.contains(url, F.lit("facebook.com")), "facebook")
    for platform, markers in C.PLATFORM_MARKERS.items():
        chain = chain.when(contains_any(html_lower, markers), platform)
    return chain.otherwise("custom")


def booking_signature(text: Column) -> Column:
    """First booking platform, in list order, with a signature in the text; NULL when none."""
    chain = None
    for platform, signatures in C.BOOKING_SIGNATURES.items():
        hit = contains_any(text, signatures)
        chain = F.when(hit, platform) if chain is None else chain.when(hit, platform)
    return chain


def booking_signature_from(text: Column, signatures: list[tuple[str, str]]) -> Column:
    """Same, with the (platform, signature) pairs given as data in priority order."""
    return F.coalesce(*[F.when(F.contains(text, F.lit(signature)), platform) for platform, signature in signatures])


def mobile_friendly(viewport: Column) -> Column:
    content = F.lower(F.coalesce(viewport, F.lit("")))
    return mentions(content, ["width=device-width", "initial-scale"]).cast("int")


def first_where(items: Column, test) -> Column:
    return F.try_element_at(F.filter(items, test), F.lit(1))


def last_where(items: Column, test) -> Column:
    return F.try_element_at(F.filter(items, test), F.lit(-1))


_SOCIAL_HOSTS = ["facebook.com", "instagram.com"]


def with_booking(pages: DataFrame, ignore_social_hosts: bool = False) -> DataFrame:
    """Add has_online_booking, booking_platform, booking_rule and booking_evidence. Needs `_lower` and `parts`.

    Rules in order: a known signature anywhere in the page, a link that says or points to booking, a button that says so.
    The second rule also takes "book" inside "facebook"; `booking_evidence` shows it and `ignore_social_hosts` turns it off.
    """
    signatures = [s for found in C.BOOKING_SIGNATURES.values() for s in found]

    def link_hit(anchor: Column) -> Column:
        href = F.lower(anchor.href)
        if ignore_social_hosts:
            by_href = mentions(href, signatures) | (mentions(href, C.BOOKING_HREF_WORDS) & ~mentions(href, _SOCIAL_HOSTS))
        else:
            by_href = mentions(href, signatures + C.BOOKING_HREF_WORDS)
        return by_href | (F.size(anchor.text_words) > 0)

    # Each rule's hit is a column of its own, so that it is found once and then read several times.
    hits = pages.withColumns({
        "_page_hit": booking_signature(F.col("_lower")),
        "_link": first_where(F.col("parts.anchors"), link_hit).href,
        "_control": first_where(F.col("parts.controls"), lambda c: (F.size(c.text_words) > 0) | mentions(F.lower(c.value), C.BOOKING_TEXT_WORDS)),
    })
    page_hit, link, control = F.col("_page_hit"), F.col("_link"), F.col("_control")
    return hits.withColumns({
        "booking_rule": F.when(page_hit.isNotNull(), "signature").when(link.isNotNull(), "link").when(control.isNotNull(), "control"),
        "booking_platform": F.when(page_hit.isNotNull(), page_hit)
        .when(link.isNotNull(), F.coalesce(booking_signature(F.lower(link)), F.lit("other"))).when(control.isNotNull(), "other"),
        "booking_evidence": F.when(page_hit.isNotNull(), page_hit).when(link.isNotNull(), link)
        .when(control.isNotNull(), F.trim(F.concat(control.value, F.lit(" "), span_text(F.col("parts.pieces"), control)))),
        "has_online_booking": (page_hit.isNotNull() | link.isNotNull() | control.isNotNull()).cast("int"),
    }).drop("_page_hit", "_link", "_control")


def may_link_socially(html: Column) -> Column:
    """False for pages that can hold no link to a social host: its name is not in them, nor a reference that may hide a letter or dot of it."""
    named = contains_any(F.lower(html), ["instagram.com", "facebook.co"])
    return named | F.contains(html, F.lit("&#")) | F.contains(html, F.lit("&period"))


def with_social_links(pages: DataFrame) -> DataFrame:
    """Add page_instagram and page_facebook: the first link of each kind; share buttons do not count. Needs `parts`."""
    numbered = F.transform("parts.anchors", lambda a, i: F.struct(a.href.alias("href"), F.lower(a.href).alias("lower"), i.alias("ord")))
    hubs = pages.withColumn("_hubs", F.filter(numbered, lambda a: mentions(a.lower, ["instagram.com", "facebook.co"])))
    found = hubs.withColumn("_instagram", first_where(F.col("_hubs"), lambda a: F.contains(a.lower, F.lit("instagram.com"))))
    facebook = first_where(F.col("_hubs"), lambda a: F.contains(a.lower, F.lit("facebook.co")) & ~F.contains(a.lower, F.lit("sharer"))
                           & ~a.ord.eqNullSafe(F.col("_instagram.ord")))
    return found.withColumns({"page_instagram": F.col("_instagram.href"), "page_facebook": facebook.href}).drop("_hubs", "_instagram")


def contact_href(anchors: Column) -> Column:
    """Last link that looks like a contact page, as written."""
    return last_where(anchors, lambda a: mentions(F.lower(a.href), C.CONTACT_HREF_WORDS)).href


def page_email(anchors: Column, html: Column) -> Column:
    """Last well-formed mailto address; else the first address in the page source."""
    def address(anchor: Column) -> Column:
        return F.trim(F.split_part(F.substring(anchor.href, 8, 2_000_000_000), F.lit("?"), F.lit(1)))

    mailtos = F.transform(F.filter(anchors, lambda a: F.startswith(F.lower(a.href), F.lit("mailto:"))), address)
    linked = last_where(mailtos, lambda text: text.rlike("^" + C.EMAIL))
    # The look-behind keeps the search linear on long runs of address characters; the first match is the same.
    in_text = F.when(F.contains(html, F.lit("@")),
                     null_if_empty(F.regexp_extract(html, "(?<![a-zA-Z0-9._%+-])" + C.EMAIL, 0)))
    return F.coalesce(linked, in_text)


def instagram_handle(instagram_url: Column) -> Column:
    """Text after the first 'instagram.com/', one trailing slash run dropped, query dropped; NULL without a slash."""
    tail = F.when(F.contains(instagram_url, F.lit("instagram.com/")),
                  F.split_part(instagram_url, F.lit("instagram.com/"), F.lit(2)))
    return F.split_part(F.regexp_replace(tail, r"/+$", ""), F.lit("?"), F.lit(1))


def page_signals(pages: DataFrame, keep: list[str], ignore_social_hosts: bool = False) -> DataFrame:
    """All signals of each page. Needs html, final_url and `parts`; the page source itself is dropped here."""
    lowered = pages.withColumn("_lower", F.lower("html"))
    found = with_social_links(with_booking(lowered, ignore_social_hosts))
    anchors = F.col("parts.anchors")
    return found.select(
        *keep,
        platform_from(F.col("_lower"), F.col("final_url")).alias("page_platform"),
        mobile_friendly(F.col("parts.viewport")).alias("page_mobile"),
        "has_online_booking", "booking_platform", "booking_rule", "booking_evidence", "page_instagram", "page_facebook",
        contact_href(anchors).alias("contact_href"),
        page_email(anchors, F.col("html")).alias("page_email"),
    )
