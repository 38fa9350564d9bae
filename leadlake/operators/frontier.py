"""Which pages of a site to fetch next, in which order, and how fast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake import constants as C
from leadlake.functions.text import count_words, mentions
from leadlake.functions.urls import booking_hosts, canonical_url, netloc, registrable_host, resolve_url
from leadlake.operators.ordered import keep_first, with_position
from leadlake.sources.captures import anchor_links, sitemap_links


def _scored(links: DataFrame, root_suffixes: Sequence[str], anchors: bool) -> DataFrame:
    """Links in scope with at least one price word: (site_id, home_url, url, score)."""
    target = links.withColumn("_target", resolve_url(F.col("home_url"), F.col("href")) if anchors else F.col("href"))
    named = target.withColumn("url", canonical_url(F.col("_target")))
    hosted = named.withColumn("host", registrable_host(F.col("url"), root_suffixes))
    in_scope = F.col("host") == F.col("root")
    if anchors:
        in_scope = in_scope | F.col("host").isin(*booking_hosts())
    label = F.concat_ws(" ", "words", "url") if anchors else F.col("url")
    return hosted.where(in_scope).select(
        "site_id", "home_url", "url", count_words(F.lower(label), C.PRICE_LINK_WORDS).alias("score")).where("score > 0")


def link_scores(homepages: DataFrame, sitemaps: DataFrame | None = None,
                suffixes: Sequence[str] = C.DEFAULT_SUFFIXES) -> DataFrame:
    """Best score per (site, URL) over anchors and sitemap entries.

    `homepages`: site_id, final_url, `parts`. `sitemaps`: site_id, final_url, xml.
    """
    def rooted(df: DataFrame) -> DataFrame:
        return df.withColumns({"home_url": canonical_url(F.col("final_url")),
                               "root": registrable_host(F.col("final_url"), suffixes)})

    keep = ["site_id", "home_url", "root"]
    links = anchor_links(rooted(homepages), keep, with_text=False)
    # Links that cannot score are dropped before their address is resolved. Escapes and control characters may hide a word.
    address = F.lower(F.concat_ws(" ", "href", "home_url"))
    links = links.where((F.col("words") != "") | mentions(address, C.PRICE_LINK_WORDS) | F.col("href").rlike("[%+\\x00-\\x1f]"))
    found = _scored(links, suffixes, anchors=True)
    if sitemaps is not None:
        found = found.unionByName(_scored(sitemap_links(rooted(sitemaps), keep), suffixes, anchors=False))
    return found.groupBy("site_id", "home_url", "url").agg(F.max("score").alias("score"))


def frontier(homepages: DataFrame, sitemaps: DataFrame | None = None, suffixes: Sequence[str] = C.DEFAULT_SUFFIXES,
             limit: int = C.MAX_PAGES) -> DataFrame:
    """Homepage first, then the best-scored links, `limit` pages per site: (site_id, page_ord, url, score)."""
    links = link_scores(homepages, sitemaps, suffixes).where(F.col("url") != F.col("home_url"))
    home = homepages.select("site_id", canonical_url(F.col("final_url")).alias("url"), F.lit(C.HOMEPAGE_SCORE).alias("score"))
    ranked = keep_first(home.unionByName(links.select("site_id", "url", "score")), ["site_id"],
                        [F.desc("score"), F.col("url")], limit, rank_as="page_ord")
    return ranked.select("site_id", "page_ord", "url", "score")


def politeness_plan(urls: DataFrame, seconds: int = 1, pace: DataFrame | None = None, not_before: int = 0) -> DataFrame:
    """Earliest second at which each URL may be fetched, `seconds` apart per host.

    Order within a host is by digest, which spreads evenly; hosts are numbered slice by slice. `pace` (host, next_second) is what
    `next_pace` kept of earlier batches: a host goes on where it stood, but not before the second `not_before`. Slots are
    multiples of `seconds`, counted from the same zero in every batch.
    """
    hosted = urls.select("url", netloc(F.col("url")).alias("host"), F.md5("url").alias("_digest"))
    first = -(-not_before // seconds)
    starts = None
    if pace is not None:
        kept = pace.groupBy("host").agg(F.max("next_second").alias("next_second"))
        starts = kept.select("host", F.greatest(F.ceil(F.col("next_second") / seconds).cast("long") - first, F.lit(0)).alias("start"))
    placed = with_position(hosted, ["host"], ["_digest", "url"], F.substring("_digest", 1, 2), "_position", starts)
    return placed.select("host", "url", ((F.col("_position") + first) * seconds).alias("offset_seconds"))


def next_pace(plan: DataFrame, seconds: int = 1, pace: DataFrame | None = None) -> DataFrame:
    """State after a batch: (host, next_second), one row per host seen in it or before. Store it and pass it to the next batch."""
    ends = plan.select("host", (F.col("offset_seconds") + seconds).alias("next_second"))
    both = ends if pace is None else ends.unionByName(pace.select("host", "next_second"))
    return both.groupBy("host").agg(F.max("next_second").alias("next_second"))
