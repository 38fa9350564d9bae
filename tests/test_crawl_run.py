"""The crawl as one run: what is due, run states over a crash, one parse, totals, archive; and public-suffix rules through it."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from leadlake import schemas
from leadlake.functions import urls
from leadlake.functions.urls import SuffixRules
from leadlake.operators import runs
from leadlake.plans import price_flow
from leadlake.sources.tables import read_snapshot

PAGES = ("competitor_id string, run_id string, page_ord int, url string, final_url string, html string, robots_allowed boolean, http_status int, content_type string, "
         "body_bytes long, render_mode string, captured_at timestamp")
MENU = "<title>Menu</title><ul><li>Lip Wax - $20</li><li>Sauna: $ later</li></ul>"


def page(competitor, place, html, status=200, host=None):
    url = f"https://{host or competitor + '.example.com'}/{place}"
    return (competitor, "r1", place, url, url, html, True, status, "text/html", len(html or ""), "http", datetime(2026, 3, 1, 0, place))


@pytest.fixture(scope="module")
def inputs(spark):
    captures = spark.createDataFrame([page("c1", 0, MENU), page("c1", 1, None, 404), page("c1", 2, "<p>nothing</p>"), page("c2", 0, None, 500), page("c3", 0, MENU),
                                      page("c4", 0, MENU), page("c5", 0, MENU)], PAGES).repartition(3)
    competitors = spark.createDataFrame([("c1", "Glow", "Austin, TX", "https://x"), ("c2", "Two", "Austin, TX", "https://x"), ("c3", "Fresh", "Austin, TX", "https://x"),
                                         ("c4", "Nosite", "Austin, TX", None), ("c5", "Stuck", None, "https://x")], "id string, name string, market string, website string")
    stored = schemas.conform(spark.createDataFrame([("c3", "r0", "partial", datetime(2026, 2, 27), datetime(2026, 2, 27)), ("c5", "r0", "processing", datetime(2026, 2, 20), None),
                                                    ("c1", "r0", "failed", datetime(2026, 2, 28), datetime(2026, 2, 28))],
                                                   "competitor_id string, run_id string, status string, started_at timestamp, completed_at timestamp"), schemas.CRAWL_RUNS)
    tables = price_flow.PriceTables(*(schemas.empty(spark, s) for s in (schemas.OFFERINGS, schemas.OFFERING_CANDIDATES, schemas.PRICE_EVENTS)))
    aliases = spark.createDataFrame([], schemas.SERVICE_ALIASES)
    catalog = spark.createDataFrame([("svc", "Lip Wax")], schemas.SERVICE_CATALOG)
    return tables, captures, competitors, aliases, catalog, stored


def as_of():
    return F.lit("2026-03-01 12:00:00").cast("timestamp")


RUNS = schemas.T.StructType([*schemas.CRAWL_RUNS.fields, schemas.T.StructField("batch", schemas.T.StringType())])


def test_one_run_leaves_all_its_tables(inputs, spark, tmp_path):
    got = price_flow.crawl_run(*inputs, as_of(), runs_path=str(tmp_path / "runs"), batch="b1", archive=str(tmp_path / "archive"))
    ended = {r.competitor_id: (r.status, r.pages_attempted, r.pages_succeeded, r.error_count) for r in got.runs.collect()}
    assert ended == {"c1": ("partial", 3, 2, 1), "c2": ("failed", 1, 0, 1), "c5": ("complete", 1, 1, 0)}
    assert got.totals == {"pages_attempted": 5, "pages_succeeded": 3, "items": 4, "published": 2, "pending": 2}
    assert sorted((r.competitor_id, r.page_ord, r.message) for r in got.errors.collect()) == [("c1", 1, "http_404"), ("c2", 0, "http_500")]
    evidence = {(r.competitor_id, r.page_ord): r for r in got.evidence.collect()}
    assert set(evidence) == {("c1", 0), ("c5", 0)} and evidence["c1", 0].title == "Menu"
    assert {r.evidence_page_id for r in got.observations.collect()} == {r.evidence_page_id for r in evidence.values()}
    assert sorted(r.html for r in spark.read.parquet(str(tmp_path / "archive")).collect()) == [MENU, MENU]
    saved = read_snapshot(spark, str(tmp_path / "runs"), RUNS).collect()
    assert {(r.competitor_id, r.status, r.batch) for r in saved} == {(c, s[0], "b1") for c, s in ended.items()}
    other, log, _ = price_flow.crawl_batch(inputs[0], inputs[1].where("competitor_id IN ('c1', 'c2', 'c5')"), inputs[2], *inputs[3:5])
    assert sorted(map(str, got.log.collect())) == sorted(map(str, log.collect()))
    assert sorted(map(str, got.tables.offerings.collect())) == sorted(map(str, other.offerings.collect()))


def test_pages_are_parsed_once(inputs):
    plan = price_flow.page_rows(inputs[1])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("page_parts(") == 1


def test_a_run_that_dies_stays_processing_and_is_done_again(inputs, spark, tmp_path, monkeypatch):
    path = str(tmp_path / "runs")
    states = lambda: sorted((r.competitor_id, r.status) for r in read_snapshot(spark, path, RUNS).collect())
    with monkeypatch.context() as patched:
        patched.setattr(price_flow, "update", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            price_flow.crawl_run(*inputs, as_of(), runs_path=path, batch="b1")
    assert states() == [("c1", "processing"), ("c2", "processing"), ("c5", "processing")]
    died = schemas.conform(read_snapshot(spark, path, RUNS), schemas.CRAWL_RUNS)
    again = runs.merge_runs(inputs[5], spark.createDataFrame(died.collect(), schemas.CRAWL_RUNS))
    price_flow.crawl_run(*inputs[:5], again, as_of(), runs_path=path, batch="b1")
    assert states() == [("c1", "partial"), ("c2", "failed"), ("c5", "complete")]  # one set, in the end state
    late = runs.abandoned_runs(inputs[5], as_of()).collect()
    assert [(r.competitor_id, r.status) for r in late] == [("c5", "failed")]
    merged = runs.merge_runs(inputs[5], runs.abandoned_runs(inputs[5], as_of()))
    assert merged.count() == 3 and merged.where("competitor_id = 'c5'").first().status == "failed"


RULES = ["com", "*.ck", "!www.ck", "*.kobe.jp", "jp", "!city.kobe.jp", "co.jp", "UK", " co.uk "]
HOSTS = {"a.com": "a.com", "x.a.com": "a.com", "com": "com", "ck": "ck", "shop.ck": "shop.ck", "my.shop.ck": "my.shop.ck", "a.my.shop.ck": "my.shop.ck", "www.ck": "www.ck",
         "a.www.ck": "www.ck", "a.b.kobe.jp": "a.b.kobe.jp", "x.a.b.kobe.jp": "a.b.kobe.jp", "x.city.kobe.jp": "city.kobe.jp", "kobe.jp": "kobe.jp", "x.co.jp": "x.co.jp",
         "y.x.jp": "x.jp", "a.b.co.uk": "b.co.uk", "un.listed": "un.listed", "a.un.listed": "un.listed", "10.0.0.1": "10.0.0.1"}


def test_wildcards_and_exceptions(spark):
    hosts = spark.createDataFrame([(h,) for h in HOSTS], "host string")
    assert {r[0]: r[1] for r in hosts.select("host", SuffixRules(RULES).registrable(F.col("host"))).collect()} == HOSTS
    rules = spark.createDataFrame([(r,) for r in RULES], "suffix string")
    assert {r.host: r.registrable_host for r in urls.registrable_hosts(hosts.union(hosts), rules).collect()} == HOSTS


def test_rules_reach_the_brand_check(inputs, spark):
    """Under *.com a booking host is a suffix, so pages on it are no longer shared."""
    captures = spark.createDataFrame([page("c1", 0, MENU, host="x.booksy.com")], PAGES)
    branded = lambda rules: [r.branded for r in price_flow.page_candidates(price_flow.read_pages(captures), inputs[2], suffixes=rules).collect()]
    assert branded(["com"]) == [False, False] and branded(["com", "*.com"]) == [True, True]
