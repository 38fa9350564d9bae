"""Both flows end to end on small fixtures, run twice."""

from datetime import datetime

from pyspark.sql import functions as F

from leadlake import schemas
from leadlake.operators import markets, queue, runs
from leadlake.plans import lead_flow, price_flow
from leadlake.sources import places, tables

SITE = "place_id string, https_probe_raised boolean, fetch_error string, http_status int, final_url string, html string"


def as_of(day=1):
    return F.lit(f"2026-03-{day:02d} 00:00:00").cast("timestamp")


def materialized(spark, df, schema):
    return spark.createDataFrame(df.collect(), schema)


def discovered(spark):
    sites = ["https://facebook.com/one", "https://linktr.ee/two", None, "https://four.example.com", "https://five.example.com", "http://six.example.com",
             "https://seven.example.com"]
    reviews = [45, 89, 12, 75, 150, 312, 60]
    rows = [(f"p{i + 1}", f"Studio {i + 1} Spa", "Austin, TX", "1 Main St", None if i == 2 else "555-0100", s, 4.5, r, datetime(2026, 3, 1))
            for i, (s, r) in enumerate(zip(sites, reviews))]
    return spark.createDataFrame(rows, "place_id string, name string, metro string, address string, phone string, website_url string, rating double, "
                                 "review_count int, discovered_at timestamp")


def test_lead_flow(spark, tmp_path):
    viewport = '<meta name="viewport" content="width=device-width">'
    captures = spark.createDataFrame([
        ("p4", False, None, 200, "https://four.example.com/", viewport + '<link href="//wixpress.com"><a href="https://instagram.com/four">i</a>'),
        ("p5", False, None, 200, "https://five.example.com/", viewport + "squarespace.com vagaro.com<a href='https://instagram.com/five'>i</a><p>hi@five.example.com</p>"),
        ("p6", True, None, 200, "http://six.example.com/", '/wp-content/<a href="/contact">c</a>'),
        ("p7", False, "timeout", None, None, None)], SITE)
    found = lead_flow.merge_businesses(schemas.empty(spark, schemas.BUSINESSES), discovered(spark))
    finder = spark.createDataFrame([("six.example.com", "desk@six.example.com", "guessed"), ("six.example.com", None, "not_found")], "domain string, email string, status string")
    first = materialized(spark, lead_flow.enrich(found, captures, as_of(2), finder), schemas.BUSINESSES)
    rows = {r.place_id: r for r in first.collect()}
    assert len(rows) == 7 and all(r.hook_text and r.scored_at and r.site_fetched_at and r.booking_checked_at for r in rows.values())
    assert {p: (r.site_platform, r.has_online_booking, r.is_mobile_friendly, r.has_ssl, r.social_status) for p, r in rows.items()} == {
        "p1": ("facebook", 0, 1, 1, "unknown"), "p2": ("linktree", 0, 1, 1, "none"), "p3": ("none", 0, 0, 0, "none"), "p4": ("wix", 0, 1, 1, "unknown"),
        "p5": ("squarespace", 1, 1, 1, "unknown"), "p6": ("wordpress", 0, 0, 0, "none"), "p7": ("unknown", 0, None, None, "none")}
    assert {p: (r.deficiency_score, r.primary_deficiency) for p, r in rows.items()} == {
        "p1": (5, "no_website"), "p2": (6, "no_website"), "p3": (9, "no_website"), "p4": (2, "no_booking"), "p5": (0, None), "p6": (8, "reviews_vs_web"),
        "p7": (3, "no_booking")}
    assert (rows["p6"].email, rows["p6"].email_status, rows["p6"].notes) == ("desk@six.example.com", "guessed", "Contact form found: http://six.example.com/contact")
    assert (rows["p5"].email, rows["p5"].email_status) == ("hi@five.example.com", "verified")
    assert (rows["p3"].email_status, rows["p1"].email_status, rows["p4"].email_status) == ("not_found", "not_found", "not_attempted")
    assert [r.place_id for r in queue.review_queue(first).collect()] == ["p3", "p6", "p2", "p1", "p7", "p4", "p5"]

    # Run again: nothing is added, stage times stay, only the score time moves; a new phone never erases a stored one.
    again = lead_flow.merge_businesses(first, discovered(spark).withColumn("phone", F.lit(None).cast("string")))
    second = {r.place_id: r for r in lead_flow.enrich(again, captures, as_of(9), finder).collect()}
    assert len(second) == 7 and second["p1"].phone == "555-0100"
    assert all(second[p].site_fetched_at == rows[p].site_fetched_at and second[p].hook_text == rows[p].hook_text for p in rows)
    assert all(second[p].scored_at == datetime(2026, 3, 9) for p in rows)

    log = lead_flow.run_events(found, first, captures, as_of(2))
    said = {(r.place_id, r.stage): r.level for r in log.where("place_id IN ('p1', 'p6', 'p7')").collect()}
    assert (said["p7", "enrich_site"], said["p7", "enrich_booking"], said["p7", "enrich_social"]) == ("warn", "error", "error")
    assert (said["p1", "enrich_booking"], said["p6", "enrich_social"]) == ("info", "info") and ("p1", "enrich_social") not in said
    assert log.where("stage = 'enrich_contact' AND place_id IS NULL").first().message == "Completed stage for 7 businesses"
    assert log.where("stage = 'hooks' AND place_id IS NOT NULL").count() == 7
    tables.append_events(log, str(tmp_path / "log"), "run 1")
    tables.append_events(log, str(tmp_path / "log"), "run 1")  # a rerun leaves one set
    tables.append_events(log.limit(1), str(tmp_path / "log"), "run 2")
    assert tables.read_events(spark, str(tmp_path / "log")).count() == log.count() + 1
    tables.write_snapshot(first, str(tmp_path / "snapshot"))
    assert tables.businesses(spark, str(tmp_path / "snapshot")).count() == 7
    assert tables.businesses(spark, str(tmp_path / "missing")).count() == 0


def test_uncaptured_sites_stay_pending(spark):
    found = lead_flow.merge_businesses(schemas.empty(spark, schemas.BUSINESSES), discovered(spark))
    rows = {r.place_id: r for r in lead_flow.enrich(found, spark.createDataFrame([], SITE), as_of(2)).collect()}
    assert rows["p4"].site_fetched_at is None and rows["p4"].has_online_booking is None and rows["p1"].site_platform == "facebook"
    assert rows["p4"].email_status == "not_attempted"


def test_discovery_from_landed_payloads(spark, tmp_path):
    landing = tmp_path / "search"
    landing.mkdir()
    (landing / "a.json").write_text(
        '{"metro":"Austin, TX","query_ord":0,"status":"OK","results":[{"place_id":"x","name":"Old name","rating":4.0,"user_ratings_total":7},{"place_id":""}]}\n'
        '{"metro":"Austin, TX","query_ord":1,"status":"OK","results":[{"place_id":"x","name":"New name"},{"place_id":"k","name":"Known"}]}\n'
        '{"metro":"Austin, TX","query_ord":2,"status":"ZERO_RESULTS","results":[]}\n'
        '{"metro":"Reno, NV","query_ord":0,"status":"REQUEST_DENIED","error_message":"no"}\n')
    payloads = places.read_search_payloads(spark, str(landing))
    details = spark.createDataFrame([("x", "OK", ("555", "https://x.example.com")), ("k", "OK", ("666", "https://wrong.example.com"))], schemas.DETAILS_PAYLOAD)
    stored = schemas.conform(spark.createDataFrame([("k", "Known before", "tel", "https://k.example.com", "approved")],
                                                   "place_id string, name string, phone string, website_url string, review_status string"), schemas.BUSINESSES)
    searched = spark.createDataFrame([("austin, tx", "Austin, TX"), ("reno, nv", "Reno, NV")], "metro_key string, metro string")
    assert places.search_requests(searched).count() == 6
    merged, status = lead_flow.discover(stored, searched, payloads, details, as_of())
    rows = {r.place_id: r for r in merged.collect()}
    assert (rows["x"].name, rows["x"].rating, rows["x"].review_count, rows["x"].phone, rows["x"].review_status) == ("New name", 4.0, 7, "555", "new")
    assert (rows["k"].phone, rows["k"].website_url, rows["k"].review_status) == ("tel", "https://k.example.com", "approved")
    assert {r.metro_key: (r.last_status, r.last_completed_at is None) for r in status.collect()} == {"austin, tx": ("complete", False), "reno, nv": ("partial", True)}
    assert [r.place_id for r in places.new_places(places.search_results(payloads), stored).collect()] == ["x"]

    competitors = schemas.conform(spark.createDataFrame([("id1", "k", "Known before", 5.0, "https://k.example.com")],
                                                        "id string, place_id string, name string, rating double, website string"), schemas.COMPETITORS)
    merged, joined, scrapes = price_flow.discover(competitors, schemas.empty(spark, schemas.COMPETITOR_MARKETS), schemas.empty(spark, schemas.MARKET_SCRAPES),
                                                  searched, payloads, details, as_of())
    rows = {r.place_id: r for r in merged.collect()}
    assert (rows["k"].id, rows["k"].rating, rows["k"].website, rows["k"].review_count) == ("id1", None, "https://k.example.com", 0)
    assert rows["x"].website == "https://x.example.com" and rows["x"].rating is None
    assert joined.count() == 2 and scrapes.count() == 2
    log = lead_flow.discovery_events(searched, status, as_of()).collect()
    assert sorted(r.level for r in log) == ["error", "info"]


PAGES = ("competitor_id string, run_id string, page_ord int, url string, final_url string, html string, robots_allowed boolean, http_status int, content_type string, "
         "body_bytes long, render_mode string, captured_at timestamp")


def captured(spark, run, day, htmls):
    rows = [("c1", run, i, f"https://glow.example.com/{i}", f"https://glow.example.com/{i}", h, True, 200, "text/html", len(h), "http", datetime(2026, 3, day))
            for i, h in enumerate(htmls)]
    rows.append(("c1", run, len(htmls), "https://glow.example.com/gone", None, None, True, 404, "text/html", 0, "http", datetime(2026, 3, day)))
    rows.append(("c2", run, 0, "https://booksy.com/glow", "https://booksy.com/glow", "<title>Shop</title><li>Wax - $5</li>", True, 200, "text/html", 9, "http", datetime(2026, 3, day)))
    return spark.createDataFrame(rows, PAGES)


def test_price_flow(spark, tmp_path):
    competitors = spark.createDataFrame([("c1", "Glow", "Austin, TX"), ("c2", "Glow", None)], "id string, name string, market string")
    aliases = spark.createDataFrame([("brow tint", "svc1")], schemas.SERVICE_ALIASES)
    catalog = spark.createDataFrame([("svc2", "Lip & Chin Wax")], schemas.SERVICE_CATALOG)
    tables_ = price_flow.PriceTables(*(schemas.empty(spark, s) for s in (schemas.OFFERINGS, schemas.OFFERING_CANDIDATES, schemas.PRICE_EVENTS)))

    def run(tables_, name, day, htmls):
        pages = price_flow.read_pages(captured(spark, name, day, htmls))
        seen = price_flow.observations(pages, competitors, aliases, catalog)
        seen = spark.createDataFrame(seen.collect(), seen.schema)
        new, log = price_flow.update(tables_, seen)
        new = price_flow.PriceTables(materialized(spark, new.offerings, schemas.OFFERINGS), materialized(spark, new.candidates, schemas.OFFERING_CANDIDATES),
                                     materialized(spark, new.events, schemas.PRICE_EVENTS))
        return new, sorted((r.event_type, r.detail.display_name, r.detail.old_price, r.detail.new_price) for r in log.collect()), pages, seen

    menu = "<title>Menu</title><ul><li>Lip &amp; Chin Wax - $20</li><li>Brow tint - price on request ($)</li><li>Peel Special - $99 until March 31, 2026</li><li>Sauna: $ later</li></ul>"
    one, log, pages, seen = run(tables_, "r1", 1, [menu, menu, "<p>nothing here</p>"])
    assert log == [("competitor_offer_added", "Peel Special", None, "$99"), ("competitor_offering_added", "Brow tint", None, None),
                   ("competitor_offering_added", "Lip & Chin Wax", None, "$20")]
    facts = {r.display_name: r for r in one.offerings.collect()}
    assert (facts["Lip & Chin Wax"].amount_min_minor, facts["Lip & Chin Wax"].service_catalog_id, facts["Brow tint"].service_catalog_id) == (2000, "svc2", "svc1")
    assert sorted((r.display_name, r.review_reason) for r in one.candidates.collect()) == [
        ("Sauna", "service_mapping_needed"), ("Sauna", "service_mapping_needed"), ("Wax", "unverified_booking_brand")]
    evidence = runs.evidence_pages(pages.withColumn("title", F.col("parts.title")), seen).collect()
    assert sorted(r.page_ord for r in evidence if r.competitor_id == "c1") == [0, 1] and evidence[0].evidence_page_id in {r.evidence_page_id for r in seen.collect()}
    runs.write_archive(pages, seen, str(tmp_path / "archive"), buckets=4)
    assert spark.read.parquet(str(tmp_path / "archive")).count() == 3

    # The same pages again change nothing; another price is one change event.
    two, log, _, _ = run(one, "r2", 2, [menu, menu])
    assert log == [] and two.offerings.count() == 3 and two.candidates.count() == 3
    three, log, _, _ = run(two, "r3", 3, [menu.replace("$20", "$25")])
    assert log == [("competitor_price_changed", "Lip & Chin Wax", "$20", "$25")]
    kept = {r.display_name: r for r in three.offerings.collect()}["Lip & Chin Wax"]
    assert (kept.amount_min_minor, kept.first_published_at, kept.updated_at) == (2500, datetime(2026, 3, 1), datetime(2026, 3, 3))
    assert three.events.count() == 4

    due = price_flow.due_competitors(spark.createDataFrame([("c1", "https://x"), ("c2", ""), ("c3", "https://y")], "id string, website string"),
                                     runs.crawl_runs(captured(spark, "r3", 3, [menu]).withColumn("outcome", F.lit("ok"))), as_of(9))
    assert [r.id for r in due.collect()] == ["c3"]


def test_unanswered_search_makes_a_market_partial(spark):
    as_of = F.lit("2024-02-05").cast("timestamp")
    searched = spark.createDataFrame([("m one", "M One"), ("m two", "M Two")], "metro_key string, metro string")
    asked = places.search_requests(searched).collect()
    answers = spark.createDataFrame(
        [(r["metro"], r["query_ord"], "OK", None) for r in asked if r["metro_key"] == "m one" or r["query_ord"] == 0],
        f"metro string, query_ord {dict(places.search_requests(searched).dtypes)['query_ord']}, status string, error_message string")
    status = markets.market_status(searched, places.failed_searches(searched, answers), as_of)
    assert {r["metro_key"]: r["last_status"] for r in status.collect()} == {"m one": "complete", "m two": "partial"}


def test_run_starts_with_its_first_capture(spark):
    captures = spark.createDataFrame([("c", "r", 0, "2024-01-01 00:05:00"), ("c", "r", 1, "2024-01-01 00:01:00")], "competitor_id string, run_id string, page_ord int, at string")
    starts = price_flow.run_starts(captures.withColumn("captured_at", F.col("at").cast("timestamp"))).collect()
    assert [str(r["observed_at"]) for r in starts] == ["2024-01-01 00:01:00"]
