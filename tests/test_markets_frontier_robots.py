"""Markets, freshness, crawl frontier, robots, capture outcome."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from leadlake.operators import frontier, markets, runs
from leadlake.operators.offers import has_candidates
from leadlake.operators.robots import robots_filter
from leadlake.sources.captures import capture_outcome, high_signal, needs_render, with_page_parts

NOW = datetime(2026, 3, 10, 12)
AS_OF = "2026-03-10 12:00:00"


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def locations(spark, rows):
    return spark.createDataFrame(rows, "tenant_id string, metro string, is_primary boolean")


def test_market_groups(spark, tmp_path):
    df = locations(spark, [("t1", "Chicago,  IL", True), ("t2", " chicago, il ", True), ("t3", "Austin, TX", True), ("t4", "Reno, NV", False),
                           ("t5", None, True)])
    got = {r.metro_key: (r.metro, r.tenants) for r in markets.market_groups(df).collect()}
    assert got == {"chicago, il": ("Chicago, IL", 2), "austin, tx": ("Austin, TX", 1)}
    assert [r.tenant_id for r in markets.tenant_markets(df).where("metro_key = 'chicago, il'").orderBy("ord").collect()] == ["t1", "t2"]
    markets.require_valid_tenants(df, str(tmp_path / "bad"))


def test_blank_metros_are_reported(spark, tmp_path):
    blank = [(f"t{i}", "  ", True) for i in range(30)]
    with pytest.raises(markets.BlankMetroError, match=f"30 tenants, listed in {tmp_path}/bad"):
        markets.require_valid_tenants(locations(spark, [*blank, ("t80", "Austin", True)]), str(tmp_path / "bad"))
    assert sorted(r.tenant_id for r in spark.read.parquet(str(tmp_path / "bad")).collect()) == sorted(t for t, _, _ in blank)
    with pytest.raises(markets.BlankMetroError, match="No primary"):
        markets.require_valid_tenants(locations(spark, [("t8", "Austin", False)]), str(tmp_path / "none"))
    named = spark.createDataFrame([(0, "Chicago,  IL"), (1, "CHICAGO, IL"), (2, "Austin, TX")], "ord int, metro string")
    markets.require_markets(named)
    assert sorted(r.metro for r in markets.explicit_markets(named).collect()) == ["Austin, TX", "Chicago, IL"]
    with pytest.raises(markets.BlankMetroError):
        markets.require_markets(spark.createDataFrame([(0, " ")], "ord int, metro string"))
    with pytest.raises(markets.BlankMetroError):
        markets.require_markets(named.limit(0))


def test_freshness_boundaries(spark):
    ages = [timedelta(days=6), timedelta(days=7), timedelta(days=7, seconds=-1), timedelta(days=13), None]
    rows = [(f"m{i}", "m", "complete", None if a is None else NOW - a, None, NOW) for i, a in enumerate(ages)]
    rows.append(("m9", "m", "partial", NOW, None, NOW))
    df = spark.createDataFrame(rows, "metro_key string, metro string, last_status string, last_completed_at timestamp, last_error string, updated_at timestamp")
    assert {r.metro_key: r.fresh for r in markets.market_freshness(df, as_of()).collect()} == {
        "m0": True, "m1": False, "m2": True, "m3": False, "m4": False, "m9": False}
    assert markets.due_markets(df.select("metro_key"), df, as_of()).count() == 4
    assert markets.due_markets(df.select("metro_key"), df, as_of(), force=True).count() == 6
    crawls = spark.createDataFrame([("a", "complete", NOW - ages[0]), ("a", "failed", NOW), ("b", "partial", NOW - ages[3]), ("c", "failed", NOW),
                                    ("d", "partial", None)], "competitor_id string, status string, completed_at timestamp")
    assert {r.competitor_id: r.fresh for r in markets.crawl_freshness(crawls, as_of()).collect()} == {"a": True, "b": False, "d": False}


def homepage(spark, html, url="https://shop.example.com/"):
    return with_page_parts(spark.createDataFrame([(1, url, html)], "site_id int, final_url string, html string"))


def test_frontier_caps_pages_and_strips_tracking(spark):
    html = "".join(f'<a href="/services/{i}?utm_source=x#top">Pricing {i}</a>' for i in range(20))
    rows = frontier.frontier(homepage(spark, html)).orderBy("page_ord").collect()
    assert len(rows) == 12 and rows[0].url == "https://shop.example.com/" and rows[0].score == 10_000
    assert all("utm_" not in r.url and "#" not in r.url for r in rows)
    assert [r.url for r in rows[1:4]] == ["https://shop.example.com/services/0", "https://shop.example.com/services/1", "https://shop.example.com/services/10"]


def test_frontier_scope_scores_and_sitemap(spark):
    html = ('<a href="about">About</a><a href="menu">Menu and prices</a><a href="https://elsewhere.example.net/pricing">Pricing</a>'
            '<a href="https://www.vagaro.com/shop">Reserve</a><a href="https://vagaro.com/book">Book</a><a href="/">Prices</a><a href="//m.example.com/offer">x</a>'
            '<a href="/pr%69ces">x</a>')
    sitemaps = spark.createDataFrame([(1, "https://shop.example.com/", "<LOC>\nhttps://shop.example.com/treatment-menu </LOC><loc>https://vagaro.com/menu</loc>"
                                       "<loc>https://shop.example.com/menu</loc>")], "site_id int, final_url string, xml string")
    got = {r.url: r.score for r in frontier.frontier(homepage(spark, html), sitemaps).collect()}
    assert got == {"https://shop.example.com/": 10_000, "https://shop.example.com/menu": 2, "https://vagaro.com/book": 1, "https://m.example.com/offer": 1,
                   "https://shop.example.com/treatment-menu": 2}


def test_politeness_plan_with_a_hot_host(spark):
    urls = [(f"https://hot.example.com/{i}",) for i in range(60)] + [(f"https://h{i}.example.com/",) for i in range(20)]
    df = spark.createDataFrame(urls, "url string")
    sliced = {r.url: (r.host, r.offset_seconds) for r in frontier.politeness_plan(df).collect()}
    assert sorted(o for h, o in sliced.values() if h.startswith("hot")) == list(range(60))
    assert all(o == 0 for h, o in sliced.values() if not h.startswith("hot"))


def test_pace_goes_on_across_batches(spark):
    def offsets(urls, seconds, pace=None, not_before=0):
        plan = frontier.politeness_plan(spark.createDataFrame([(u,) for u in urls], "url string"), seconds, pace, not_before)
        return plan, {r.url: r.offset_seconds for r in plan.collect()}

    hot = [f"https://hot.example.com/{i}" for i in range(50)]
    plan, first = offsets([*hot, "https://a.example.com/"], 2)
    pace = frontier.next_pace(plan, 2)
    assert {r.host: r.next_second for r in pace.collect()} == {"hot.example.com": 100, "a.example.com": 2}
    plan, second = offsets([f"{u}/x" for u in hot] + ["https://b.example.com/"], 2, pace)
    assert sorted([*first.values(), *second.values()]) == sorted([*range(0, 200, 2), 0, 0])
    kept = {r.host: r.next_second for r in frontier.next_pace(plan, 2, pace).collect()}
    assert kept == {"hot.example.com": 200, "a.example.com": 2, "b.example.com": 2}
    _, third = offsets(["https://hot.example.com/y", "https://a.example.com/y", "https://c.example.com/"], 3, pace, 31)
    assert third == {"https://hot.example.com/y": 102, "https://a.example.com/y": 33, "https://c.example.com/": 33}


def test_robots(spark):
    urls = spark.createDataFrame([(f"https://a.example.com/private/{i}",) for i in range(30)] + [("https://a.example.com/open",), ("https://b.example.com/x",),
                                  ("https://c.example.com/x",), ("https://d.example.com/x",)], "url string")
    rules = spark.createDataFrame([("a.example.com", "User-agent: *\nDisallow: /private/", 200), ("b.example.com", "User-agent: *\nDisallow: /", 503),
                                   ("d.example.com", "User-agent: otherbot\nDisallow: /", 200)], "host string, robots_txt string, http_status int")
    got = {r.url: r.allowed for r in robots_filter(urls, rules).collect()}
    assert len(got) == 34 and sorted(u for u, ok in got.items() if not ok) == sorted(f"https://a.example.com/private/{i}" for i in range(30))


def test_capture_outcomes_and_runs(spark):
    rows = [("a", "r", 1, "u1", None, 200, "text/html", 10), ("a", "r", 2, "u2", None, 200, "application/pdf", 10), ("b", "r", 1, "u3", True, 503, "text/html", 10),
            ("c", "r", 1, "u4", True, 200, "TEXT/HTML; charset=x", 5 * 1024 * 1024), ("c", "r", 2, "u5", False, 503, None, 1), ("d", "r", 1, "u6", True, 200, "text/html", 5 * 1024 * 1024 + 1),
            ("e", "r", 1, "u7", True, 200, "text/html", None)]
    df = spark.createDataFrame(rows, "competitor_id string, run_id string, page_ord int, url string, robots_allowed boolean, http_status int, content_type string, "
                               "body_bytes long").withColumns({"outcome": capture_outcome(), "captured_at": as_of()})
    assert [r.outcome for r in df.orderBy("url").collect()] == ["ok", "non_html", "http_503", "ok", "robots_denied", "oversized_body", "ok"]
    got = {r.competitor_id: (r.status, r.pages_attempted, r.pages_succeeded, r.error_count) for r in runs.crawl_runs(df).collect()}
    assert got == {"a": ("partial", 2, 1, 1), "b": ("failed", 1, 0, 1), "c": ("partial", 2, 1, 1), "d": ("failed", 1, 0, 1), "e": ("complete", 1, 1, 0)}
    assert runs.crawl_errors(df).where("competitor_id = 'b'").first().message == "http_503"


def test_needs_render_and_high_signal(spark):
    long = "<p>" + "care " * 60 + "</p>"
    df = spark.createDataFrame([(1, '<div ID="root"></div>'), (2, long), (3, long + '<div id="root"></div>'), (4, long + '<div id="root"><li>Wax - $5</li></div>'),
                                (5, long + '<div id="root"></div><script type="application/ld+json">{"@type":"Offer","name":"W","price":1}</script>')], "page_id int, html string")
    got = with_page_parts(df).select("page_id", needs_render(has_candidates()).alias("n")).collect()
    assert {r.page_id: r.n for r in got} == {1: True, 2: False, 3: True, 4: False, 5: False}
    urls = spark.createDataFrame([("https://offer.example.com/about",), ("https://x.example.com/Our-MENU?x",)], "u string")
    assert [r.h for r in urls.select(high_signal(F.col("u")).alias("h")).collect()] == [False, True]
