"""Price flow as one plan: captured pages in, current offerings, review candidates, events and runs out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from leadlake import schemas
from leadlake.constants import DEFAULT_SUFFIXES
from leadlake.operators import history, publish, runs
from leadlake.operators.markets import crawl_freshness, market_status, merge_market_status
from leadlake.operators.offers import candidates, dedupe_candidates, page_items
from leadlake.operators.runs import PAGE_KEYS
from leadlake.operators.signals import instagram_handle, page_signals
from leadlake.session import cut_lineage
from leadlake.sources import places, tables as stored_tables
from leadlake.sources.captures import capture_outcome, with_page_parts


@dataclass(frozen=True)
class PriceTables:
    """Stored state of the price flow."""

    offerings: DataFrame
    candidates: DataFrame
    events: DataFrame


def due_competitors(competitors: DataFrame, crawl_runs: DataFrame, as_of: Column, force: bool = False) -> DataFrame:
    """Competitors with a website and no usable run in the window."""
    fresh = crawl_freshness(crawl_runs, as_of, force).where("fresh").select(F.col("competitor_id").alias("id"))
    return competitors.where(F.coalesce("website", F.lit("")) != "").join(fresh, "id", "left_anti")


def discover(competitors: DataFrame, memberships: DataFrame, scrapes: DataFrame, searched: DataFrame,
             search_payloads: DataFrame, details_payloads: DataFrame, as_of: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(competitors, memberships, market status) after a discovery batch."""
    found = places.dedupe_places(places.search_results(search_payloads, missing_reviews_as_zero=True))
    found = places.with_contact_facts(found, competitors, places.place_details(details_payloads), phone=False)
    merged = runs.merge_competitors(competitors, found, as_of)
    joined = runs.merge_memberships(memberships, runs.memberships(found, merged, as_of))
    status = market_status(searched, places.failed_searches(searched, search_payloads), as_of)
    return merged, joined, merge_market_status(scrapes, status)


def enrich_competitors(competitors: DataFrame, homepages: DataFrame, as_of: Column) -> DataFrame:
    """Site signals of competitors. `homepages`: competitor_id, final_url, html, one row each."""
    signals = page_signals(with_page_parts(homepages), ["competitor_id"])
    return runs.enrich_competitors(competitors, signals, instagram_handle(F.col("page_instagram")), as_of)


def read_pages(captures: DataFrame) -> DataFrame:
    """Captures with outcome, and page parts for the usable ones only; oversized bodies never reach the parser."""
    judged = captures.withColumn("outcome", capture_outcome())
    return with_page_parts(judged.where(F.col("outcome") == "ok"))


def page_rows(captures: DataFrame, suffixes: Sequence[str] = DEFAULT_SUFFIXES) -> DataFrame:
    """One small row per capture, failed ones included, with all that later steps ask of a page: outcome, title, content hash, candidate items.

    The parser runs here and nowhere else. The brand check wants the text of pages on shared booking hosts; elsewhere no text is carried.
    """
    judged = captures.withColumn("outcome", capture_outcome())
    parsed = with_page_parts(judged.withColumn("_usable", F.when(F.col("outcome") == "ok", F.col("html"))), "_usable")
    return _with_items(parsed, [*PAGE_KEYS, "url", "final_url", "outcome", "http_status", "render_mode", "captured_at", "content_sha256"], suffixes)


def _with_items(pages: DataFrame, keep: list[str], suffixes: Sequence[str]) -> DataFrame:
    title_text = F.concat_ws(" ", F.coalesce("parts.title", F.lit("")), F.col("parts.visible_text"))
    slim = pages.withColumns({"title": F.col("parts.title"), "_page_text": F.when(publish.on_booking_host(F.col("final_url"), suffixes), title_text)})
    return page_items(slim, [*keep, "title", "_page_text"])


def row_candidates(paged: DataFrame, competitors: DataFrame, parity: bool = False, suffixes: Sequence[str] = DEFAULT_SUFFIXES) -> DataFrame:
    """Deduped candidates of page rows with items, with business name, market and brand check. `competitors`: id, name, market."""
    facts = competitors.select(F.col("id").alias("competitor_id"), F.col("name").alias("business_name"), "market")
    kept = [*PAGE_KEYS, "captured_at", "content_sha256"]
    named = paged.select(*kept, "source_url", "_page_text", "items").join(facts, "competitor_id", "left")
    branded = named.withColumn("branded", publish.booking_branded(
        F.col("source_url"), F.col("business_name"), F.col("_page_text"), suffixes)).drop("_page_text")
    return dedupe_candidates(candidates(branded, [*kept, "market", "branded"], parity), PAGE_KEYS)


def page_candidates(pages: DataFrame, competitors: DataFrame, parity: bool = False, suffixes: Sequence[str] = DEFAULT_SUFFIXES) -> DataFrame:
    """Deduped candidates of parsed pages (see `read_pages`)."""
    return row_candidates(_with_items(pages, [*PAGE_KEYS, "captured_at", "content_sha256"], suffixes), competitors, parity, suffixes)


def run_starts(captures: DataFrame) -> DataFrame:
    """(competitor_id, run_id, observed_at): the first capture time of each run, failed captures included."""
    return captures.groupBy("competitor_id", "run_id").agg(F.min("captured_at").alias("observed_at"))


def observations(pages: DataFrame, competitors: DataFrame, aliases: DataFrame, catalog: DataFrame,
                 parity: bool = False, starts: DataFrame | None = None, suffixes: Sequence[str] = DEFAULT_SUFFIXES) -> DataFrame:
    """Every validated observation of the crawl, first-seen per run, published or pending.

    With `starts` (see `run_starts`) all pages of a run are observed at its start, so that pages count in their order and not by when each was captured.
    """
    return row_observations(page_candidates(pages, competitors, parity, suffixes), aliases, catalog, starts)


def row_observations(found: DataFrame, aliases: DataFrame, catalog: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """Observations of candidates, see `observations`."""
    mapped = publish.with_catalog(found, aliases, catalog)
    judged = publish.validate(mapped).withColumn("evidence_page_id", publish.evidence_page_id(F.col("content_sha256")))
    if starts is None:
        judged = judged.withColumn("observed_at", F.col("captured_at"))
    else:
        judged = judged.join(starts, ["competitor_id", "run_id"])
    return publish.offering_values(publish.first_seen(judged))


def update(tables: PriceTables, found: DataFrame) -> tuple[PriceTables, DataFrame]:
    """(new tables, event log of this batch). `found` is used several times: pass a stored or persisted frame."""
    published = found.where(F.col("publication_status") == "published")
    pending = found.where(F.col("publication_status") == "pending")
    log = history.change_events(tables.offerings, published)
    return PriceTables(
        offerings=schemas.conform(history.merge_offerings(tables.offerings, published), schemas.OFFERINGS),
        candidates=schemas.conform(history.merge_candidates(tables.candidates, pending), schemas.OFFERING_CANDIDATES),
        events=schemas.conform(history.merge_events(tables.events, log), schemas.PRICE_EVENTS),
    ), log


def crawl_batch(tables: PriceTables, captures: DataFrame, competitors: DataFrame, aliases: DataFrame, catalog: DataFrame,
                parity: bool = False) -> tuple[PriceTables, DataFrame, DataFrame]:
    """(new tables, event log, observations) of one crawl batch.

    Observations feed three merges and the log, so they are checkpointed once instead of parsing the pages for each.
    """
    found = cut_lineage(observations(read_pages(captures), competitors, aliases, catalog, parity, run_starts(captures)))
    new, log = update(tables, found)
    return new, log, found


@dataclass(frozen=True)
class CrawlRun:
    """What one crawl run leaves: new tables, the change log, observations, runs in their end state, failed pages, evidence pages, and totals."""

    tables: PriceTables
    log: DataFrame
    observations: DataFrame
    runs: DataFrame
    errors: DataFrame
    evidence: DataFrame
    totals: dict[str, int]


def crawl_run(tables: PriceTables, captures: DataFrame, competitors: DataFrame, aliases: DataFrame, catalog: DataFrame, crawl_runs: DataFrame, as_of: Column,
              force: bool = False, parity: bool = False, suffixes: Sequence[str] = DEFAULT_SUFFIXES, runs_path: str | None = None, batch: str | None = None,
              archive: str | None = None) -> CrawlRun:
    """The whole crawl of the competitors that are due: with a website and without a usable run in the window (`force`: all with a website).

    Pages are parsed once, into one small row each, which is stored; observations are stored once, too. Runs, failed pages, candidates, evidence and archive all
    read these. Totals are metrics of the two jobs that store them, so they need no job of their own.

    With `runs_path` the runs of this `batch` are a slice of that folder: they stand there as processing before the first page is parsed and in their end
    state after all else. A batch that dies in between leaves them as processing, which counts as no crawl, and its rerun takes the slice's place (see
    also `abandoned_runs`). With `archive` the sources of evidence pages go there.
    """
    due = due_competitors(competitors, crawl_runs, as_of, force)
    wanted = captures.join(due.select(F.col("id").alias("competitor_id")), "competitor_id", "left_semi")

    def save(rows: DataFrame) -> None:
        if runs_path is not None:
            stored_tables.replace_slice(schemas.conform(rows, schemas.CRAWL_RUNS).withColumn("batch", F.lit(batch)), runs_path, "batch")

    save(runs.opened_runs(wanted))
    read, seen = Observation(), Observation()
    ok, published = F.col("outcome") == "ok", F.col("publication_status") == "published"
    pages = cut_lineage(page_rows(wanted, suffixes).observe(
        read, F.count(F.lit(1)).alias("pages_attempted"), F.count_if(ok).alias("pages_succeeded"), F.coalesce(F.sum(F.size("items")), F.lit(0)).alias("items")))
    found = cut_lineage(row_observations(row_candidates(pages, competitors, parity, suffixes), aliases, catalog, run_starts(pages)).observe(
        seen, F.count_if(published).alias("published"), F.count_if(~published).alias("pending")))
    new, log = update(tables, found)
    ended = runs.crawl_runs(pages)
    if archive is not None:
        hashed = wanted.withColumn("content_sha256", F.sha2("html", 256))
        runs.write_archive(hashed, found, archive)
    save(ended)
    return CrawlRun(new, log, found, ended, runs.crawl_errors(pages), runs.evidence_pages(pages.where(ok), found), {**read.get, **seen.get})
