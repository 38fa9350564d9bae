"""Captured pages: outcome rules, derived columns, sitemap entries, link rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake import constants as C
from leadlake.functions.html import page_parts, span_text
from leadlake.functions.text import mentions
from leadlake.functions.urls import path


def capture_outcome() -> Column:
    """Why a page is unusable, or 'ok'; the first rule that applies decides."""
    status = F.col("http_status")
    html_type = F.contains(F.lower(F.coalesce("content_type", F.lit(""))), F.lit("text/html"))
    return (
        F.when(~F.coalesce("robots_allowed", F.lit(True)), "robots_denied")
        .when(status >= 400, F.concat(F.lit("http_"), status.cast("string")))
        .when(~html_type, "non_html")
        .when(F.col("body_bytes") > C.MAX_BODY_BYTES, "oversized_body")
        .otherwise("ok")
    )


def with_page_parts(captures: DataFrame, html: str = "html") -> DataFrame:
    """Add `parts` (one Arrow pass) and the content hash. No shuffle: each page is read where it lies."""
    return captures.withColumns({"parts": page_parts(F.col(html)), "content_sha256": F.sha2(F.col(html), 256)})


def needs_render(has_candidates: Column) -> Column:
    """A page whose text is sparse, or an empty application shell, wants a browser."""
    shell = F.contains(F.lower("html"), F.lit('id="root"'))
    return (F.length("parts.visible_text") < C.SPARSE_TEXT_CHARS) | (shell & ~has_candidates)


def high_signal(url: Column) -> Column:
    return mentions(F.lower(path(url)), C.PRICE_LINK_WORDS)


def sitemap_links(sitemaps: DataFrame, keep: list[str], xml: str = "xml") -> DataFrame:
    """One row per <loc> entry."""
    return sitemaps.select(*keep, F.explode(F.regexp_extract_all(F.col(xml), F.lit(C.SITEMAP_LOC), F.lit(1))).alias("href"))


def anchor_links(pages: DataFrame, keep: list[str], with_text: bool = True) -> DataFrame:
    """One row per anchor with an href, in document order: its text, and the words of price links in its label. Needs `parts`.

    Texts are cut on the page row, so no link carries its page. The outer explode keeps Spark from inferring a filter on the array, which would parse
    every page a second time.
    """
    def cut(anchor: Column) -> Column:
        text = [span_text(F.col("parts.pieces"), anchor).alias("text")] if with_text else []
        return F.struct(anchor["href"].alias("href"), *text, F.array_join(anchor["label_words"], " ").alias("words"))

    exploded = pages.select(*keep, F.posexplode_outer(F.transform("parts.anchors", cut)).alias("ord", "anchor")).where("anchor IS NOT NULL")
    return exploded.select(*keep, F.col("ord").cast("long").alias("ord"), "anchor.*")
