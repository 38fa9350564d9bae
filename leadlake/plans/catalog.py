"""Registered queries: each runs library operators over whole tables, most with SQL that restates the result."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake import constants as C
from leadlake import schemas
from leadlake.functions import text as T
from leadlake.functions import urls as U
from leadlake.functions.prices import minor_units, parse_rows
from leadlake.operators import contact, frontier, history, hooks, markets, offers, publish, queue, robots, runs, signals, signatures, site
from leadlake.operators.merge import update_columns
from leadlake.operators.ordered import keep_first
from leadlake.operators.score import with_score
from leadlake.plans import check_sql as Q
from leadlake.plans import lead_flow, price_flow
from leadlake.plans.inputs import load, sql_text
from leadlake.session import cut_lineage, shared_folder, spread, where_here
from leadlake.sources import captures as captured
from leadlake.sources import places
from leadlake.sources.buckets import BucketTable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}
NOW = "TIMESTAMP '2024-02-05 00:00:00'"


def query(check: str | None = None):
    """Register a query under its function name, with the SQL of its result where SQL can state it."""
    def register(build):
        QUERIES[build.__name__] = build
        if check is not None:
            CHECKS[build.__name__] = sql_text(check)
        return build

    return register


def as_of():
    return F.lit("2024-02-05 00:00:00").cast("timestamp")


def text_of(*names: str):
    return [F.col(n).cast("string").alias(n) for n in names]


def spread_load(spark: SparkSession, d: str, name: str) -> DataFrame:
    """An input whose rows are costly to work on, over enough tasks also when its table is one small file."""
    return spread(load(spark, d, name), {"captures": "page_id", "documents": "doc_id"}.get(name, "p_partkey"))


def page_facts(spark: SparkSession, d: str) -> DataFrame:
    return captured.with_page_parts(spread_load(spark, d, "captures"))


# ---------------------------------------------------------------- scoring, queue, hooks

@query(f"SELECT place_id, deficiency_score, primary_deficiency FROM {Q.scored('<<biz>>')} s")
def deficiency_score(spark, d):
    return with_score(load(spark, d, "biz")).select("place_id", "deficiency_score", "primary_deficiency")


@query(f"""SELECT place_id, name, metro, deficiency_score, primary_deficiency, review_count FROM {Q.scored('<<biz>>')} s
           WHERE review_status = 'new' ORDER BY deficiency_score DESC, review_count DESC NULLS LAST, place_id""")
def review_queue(spark, d):
    return queue.review_queue(with_score(load(spark, d, "biz"))).select(
        "place_id", "name", "metro", "deficiency_score", "primary_deficiency", "review_count")


@query(" UNION ALL ".join(f"SELECT place_id, '{stage}' AS stage FROM <<biz>> b WHERE {test}" for stage, test in site.PENDING.items()))
def pending_stage(spark, d):
    stages = F.array(*[F.when(site.pending(stage), F.lit(stage)) for stage in site.PENDING])
    return load(spark, d, "biz").select("place_id", F.explode(F.filter(stages, lambda s: s.isNotNull())).alias("stage"))


def _clip_sql(text: str, width: int) -> str:
    return f"CASE WHEN LENGTH({text}) > {width} THEN SUBSTRING({text}, 1, {width - 3}) || '...' ELSE {text} END"


@query(f"""SELECT place_id, {_clip_sql("name", 22)} AS name, {_clip_sql("metro", 12)} AS metro,
           CAST(deficiency_score AS STRING) AS score, {_clip_sql("COALESCE(primary_deficiency, 'none')", 20)} AS deficiency,
           {_clip_sql("COALESCE(phone, 'N/A')", 14)} AS phone FROM {Q.scored('<<biz>>')} s WHERE review_status = 'new'""")
def display_rows(spark, d):
    return queue.display_rows(queue.review_queue(with_score(load(spark, d, "biz"))))


@query(f"""SELECT name, metro, deficiency_score, primary_deficiency, phone, email, email_status, website_url, booking_platform,
           social_status, line AS hook_text, 'https://www.google.com/maps/place/?q=place_id:' || place_id AS google_maps_url
           FROM {Q.hooked(Q.scored('<<biz>>'))} s WHERE review_status = 'new'""")
def queue_export_rows(spark, d):
    rows = hooks.with_template_hook(with_score(load(spark, d, "biz")), "hook_text")
    return queue.export_rows(queue.review_queue(rows))


@query("SELECT place_id, 'https://www.google.com/maps/place/?q=place_id:' || place_id AS maps_url FROM <<biz>> b")
def map_urls(spark, d):
    return load(spark, d, "biz").select("place_id", U.maps_url(F.col("place_id")).alias("maps_url"))


@query(f"""SELECT place_id, line AS hook, CAST(COALESCE(primary_deficiency, '') <> 'reviews_vs_web' OR COALESCE(has_online_booking = 0, false)
           AS INT) AS grounded FROM {Q.hooked(Q.scored('<<biz>>'))} s""")
def hook_text(spark, d):
    return hooks.with_template_hook(with_score(load(spark, d, "biz")), "hook").select(
        "place_id", "hook", hooks.hook_grounded().cast("int").alias("grounded"))


@query(f"SELECT place_id, {Q.short_name('name')} AS short FROM <<biz>> b")
def name_cleanup(spark, d):
    return load(spark, d, "biz").select("place_id", hooks.short_name(F.col("name")).alias("short"))


@query(f"""SELECT place_id, CAST(TO_JSON({{'name': name, 'review_count': review_count, 'rating': rating, 'site_platform': site_platform,
           'has_online_booking': has_online_booking, 'primary_deficiency': primary_deficiency, 'social_status': social_status,
           'has_ssl': has_ssl, 'is_mobile_friendly': is_mobile_friendly}}) AS STRING) AS facts FROM {Q.scored('<<biz>>')} s""")
def hook_facts_json(spark, d):
    return with_score(load(spark, d, "biz")).select("place_id", hooks.generator_facts().alias("facts"))


@query(r"""SELECT place_id, REGEXP_REPLACE(line, '(?s)^"(.*)"$', '\1') AS hook FROM (
           SELECT place_id, CASE WHEN LENGTH(name) % 2 = 0 THEN '"' || name || '"' ELSE name || '"' END AS line FROM <<biz>> b) x""")
def quote_strip(spark, d):
    line = F.when(F.length("name") % 2 == 0, F.concat(F.lit('"'), "name", F.lit('"'))).otherwise(F.concat("name", F.lit('"')))
    return load(spark, d, "biz").select("place_id", T.strip_quotes(line).alias("hook"))


_WANTED = "deficiency_score >= 4 AND COALESCE(email, '') = ''"
_DOMAIN = Q.lookup_domain("website_url")
_LOOKUP = f"CASE WHEN {_DOMAIN} <> '' AND NOT STARTS_WITH({_DOMAIN}, 'facebook.com') AND NOT STARTS_WITH({_DOMAIN}, 'linktr.ee') THEN {_DOMAIN} END"


@query(f"""SELECT place_id, name, {_LOOKUP} AS lookup_domain, CASE WHEN {_LOOKUP} IS NULL THEN 'not_found' ELSE 'to_look_up' END AS status
           FROM {Q.scored('<<biz>>')} s WHERE {_WANTED}""")
def finder_worklist(spark, d):
    return contact.finder_worklist(with_score(load(spark, d, "biz")))


@query(f"""SELECT place_id, CASE WHEN asked AND domain_key IS NOT NULL THEN f.email ELSE s.email END AS email,
           CASE WHEN asked THEN COALESCE(f.status, 'not_found') ELSE email_status END AS email_status
           FROM (SELECT *, {_WANTED} AND email_status = 'not_attempted' AS asked, {_LOOKUP} AS domain_key FROM {Q.scored('<<biz>>')} s0) s
           LEFT JOIN <<finder>> f ON asked AND f.domain = domain_key""")
def finder_join(spark, d):
    rows = contact.with_finder(with_score(load(spark, d, "biz")), F.col("email_status") == "not_attempted", load(spark, d, "finder"))
    return rows.select("place_id", "email", "email_status")


# ---------------------------------------------------------------- page signals

@query(f"SELECT page_id, page_platform, page_mobile FROM {Q.page_facts('<<captures>>')} f")
def site_platform(spark, d):
    return signals.page_signals(page_facts(spark, d), ["page_id"]).select("page_id", "page_platform", "page_mobile")


@query(f"""SELECT page_id, CAST(page_booking_platform IS NOT NULL AS INT) AS has_online_booking,
           page_booking_platform AS booking_platform FROM {Q.page_facts('<<captures>>')} f""")
def booking_detect(spark, d):
    return signals.page_signals(page_facts(spark, d), ["page_id"]).select("page_id", "has_online_booking", "booking_platform")


@query(f"SELECT page_id, {Q.signature('LOWER(html)')} AS platform FROM <<captures>> c")
def booking_signatures(spark, d):
    pairs = [(p, s) for p, ss in C.BOOKING_SIGNATURES.items() for s in ss]
    return load(spark, d, "captures").select("page_id", F.lower("html").alias("text")).select(
        "page_id", signals.booking_signature_from(F.col("text"), pairs).alias("platform"))


@query("""SELECT p_partkey, ARG_MIN(platform, (COALESCE(priority, 0), signature, platform)) AS platform,
           ARG_MIN(signature, (COALESCE(priority, 0), signature, platform)) AS signature FROM (
           SELECT m.p_partkey, s.platform, s.signature, s.priority FROM <<menu_pages>> m LEFT JOIN <<signatures>> s
           ON CONTAINS(LOWER(m.html), s.signature)) x GROUP BY p_partkey""")
def signature_table(spark, d):
    return signatures.first_signatures(load(spark, d, "menu_pages"), ["p_partkey"], F.lower("html"), load(spark, d, "signatures"))


@query(f"SELECT page_id, page_instagram, page_facebook FROM {Q.page_facts('<<captures>>')} f")
def social_links(spark, d):
    # Only pages that may hold such a link are parsed; the others have a row without links.
    pages = spread_load(spark, d, "captures").withColumn("_read", F.when(signals.may_link_socially(F.col("html")), F.col("html")))
    return signals.with_social_links(captured.with_page_parts(pages, "_read")).select("page_id", "page_instagram", "page_facebook")


@query(f"""SELECT page_id, CASE WHEN CONTAINS(page_instagram, 'instagram.com/') THEN
           SPLIT_PART(REGEXP_REPLACE(SPLIT_PART(page_instagram, 'instagram.com/', 2), '/+$', ''), '?', 1) END AS handle
           FROM {Q.page_facts('<<captures>>')} f""")
def instagram_handles(spark, d):
    found = signals.page_signals(page_facts(spark, d), ["page_id"])
    return found.select("page_id", signals.instagram_handle(F.col("page_instagram")).alias("handle"))


@query(f"""SELECT page_id, page_email, CASE WHEN STARTS_WITH(LOWER(contact_href), 'http') THEN contact_href
           ELSE {Q.resolved("'https://shop.example.com/home'", 'contact_href')} END AS contact_form FROM {Q.page_facts('<<captures>>')} f""")
def contact_details(spark, d):
    found = signals.page_signals(page_facts(spark, d), ["page_id"]).withColumn("website_url", F.lit("https://shop.example.com/home"))
    return found.select("page_id", "page_email", site.contact_form(F.col("contact_href")).alias("contact_form"))


@query(f"SELECT doc_id, {Q.extract('text', C.EMAIL, 0)} AS email FROM <<documents>> d")
def email_first(spark, d):
    no_links = F.array().cast("array<struct<href:string,text:string,label:string>>")
    return load(spark, d, "documents").select("doc_id", signals.page_email(no_links, F.col("text")).alias("email"))


_SITE = f"""SELECT b.*, c.page_id IS NOT NULL AS captured, c.html, c.final_url, c.https_probe_raised, c.page_platform, c.page_mobile,
      c.page_booking_platform, c.page_instagram, c.page_facebook, c.contact_href, c.page_email,
      CASE WHEN c.fetch_error = 'timeout' THEN 'timeout' WHEN c.fetch_error = 'tls' THEN 'tls'
           WHEN c.fetch_error IS NOT NULL OR c.http_status >= 400 THEN 'other' END AS failure,
      LOWER(COALESCE(b.website_url, '')) AS u
    FROM <<fresh_biz>> b LEFT JOIN (SELECT c0.*, f.page_platform, f.page_mobile, f.page_booking_platform, f.page_instagram, f.page_facebook,
      f.contact_href, f.page_email FROM <<captures>> c0 JOIN {Q.page_facts('<<captures>>')} f ON f.page_id = c0.page_id) c ON c.place_id = b.place_id"""
_HUB = "(CONTAINS(u, 'facebook.com') OR CONTAINS(u, 'linktr.ee'))"
_STATE = f"""SELECT *, CASE WHEN u = '' OR {_HUB} THEN 'no_site' WHEN NOT captured THEN NULL WHEN failure = 'timeout' THEN 'timeout'
      WHEN failure IS NOT NULL THEN 'error' ELSE 'ok' END AS site_fetch_status,
    CASE WHEN u = '' THEN 'none' WHEN CONTAINS(u, 'facebook.com') THEN 'facebook' WHEN CONTAINS(u, 'linktr.ee') THEN 'linktree'
      WHEN NOT captured THEN NULL WHEN failure IS NOT NULL THEN 'unknown' ELSE page_platform END AS site_platform,
    CASE WHEN u = '' THEN 0 WHEN {_HUB} THEN 1 WHEN NOT captured THEN NULL WHEN failure = 'tls' THEN 0 WHEN failure IS NOT NULL THEN NULL
      WHEN STARTS_WITH(u, 'http://') AND https_probe_raised THEN 0 WHEN STARTS_WITH(final_url, 'https://') THEN 1 ELSE 0 END AS has_ssl,
    CASE WHEN u = '' THEN 0 WHEN {_HUB} THEN 1 WHEN captured AND failure IS NULL THEN page_mobile END AS is_mobile_friendly
    FROM ({_SITE}) s1"""
_BOOKED = f"""SELECT *, CASE WHEN NOT gate OR (captured AND failure IS NOT NULL) THEN 0 WHEN captured THEN CAST(page_booking_platform IS NOT NULL AS INT) END AS has_online_booking,
    CASE WHEN gate AND captured AND failure IS NULL THEN page_booking_platform END AS booking_platform,
    CASE WHEN CONTAINS(u, 'facebook.com') THEN website_url WHEN NOT {_HUB} AND u <> '' AND captured AND failure IS NULL THEN page_facebook END AS facebook_url,
    CASE WHEN NOT {_HUB} AND u <> '' AND captured AND failure IS NULL THEN page_instagram END AS instagram_url,
    CASE WHEN CONTAINS(u, 'facebook.com') THEN 'unknown' WHEN {_HUB} OR u = '' THEN 'none' WHEN NOT captured THEN NULL
      WHEN failure IS NULL AND (page_instagram IS NOT NULL OR page_facebook IS NOT NULL) THEN 'unknown' ELSE 'none' END AS social_status
    FROM (SELECT *, u <> '' AND COALESCE(site_platform NOT IN ('none', 'facebook', 'linktree'), true) AS gate FROM ({_STATE}) s2) s3"""


@query(f"SELECT place_id, site_fetch_status, site_platform, has_ssl, is_mobile_friendly FROM ({_STATE}) s")
def site_state(spark, d):
    done = lead_flow.enrich(schemas.conform(load(spark, d, "fresh_biz"), schemas.BUSINESSES), spread_load(spark, d, "captures"), as_of())
    return done.select("place_id", "site_fetch_status", "site_platform", "has_ssl", "is_mobile_friendly")


_SCAN = "u <> '' AND NOT STARTS_WITH(u, 'https://facebook.com') AND NOT STARTS_WITH(u, 'https://linktr.ee')"
_FLOW = f"""SELECT *, CASE WHEN scan AND captured AND failure IS NULL THEN page_email END AS scraped,
    CASE WHEN scan AND captured AND failure IS NULL THEN CASE WHEN STARTS_WITH(LOWER(contact_href), 'http') THEN contact_href
      WHEN STARTS_WITH(contact_href, '/') THEN REGEXP_EXTRACT(website_url, '^([^:/?#]+://[^/?#]+)', 1) || contact_href END END AS form
    FROM (SELECT *, {_SCAN} AS scan FROM {Q.hooked(Q.scored(f'({_BOOKED})'))} l0) l1"""
_FLOW_ASKED = f"(scan = false OR captured) AND scraped IS NULL AND deficiency_score >= 4"


@query(f"""SELECT place_id, site_fetch_status, site_platform, has_ssl, is_mobile_friendly, has_online_booking, booking_platform,
    instagram_url, facebook_url, social_status, deficiency_score, primary_deficiency, line AS hook_text,
    'Contact form found: ' || form AS notes, CASE WHEN scraped IS NOT NULL THEN scraped WHEN asked THEN f.email END AS email,
    CASE WHEN scraped IS NOT NULL THEN 'verified' WHEN asked THEN COALESCE(f.status, 'not_found') ELSE 'not_attempted' END AS email_status
    FROM (SELECT *, {_FLOW_ASKED} AS asked, {_LOOKUP} AS domain_key FROM ({_FLOW}) l2) l3 LEFT JOIN <<finder>> f ON asked AND f.domain = domain_key""")
def lead_pipeline_rows(spark, d):
    done = lead_flow.enrich(schemas.conform(load(spark, d, "fresh_biz"), schemas.BUSINESSES), spread_load(spark, d, "captures"),
                            as_of(), load(spark, d, "finder"))
    return done.select("place_id", "site_fetch_status", "site_platform", "has_ssl", "is_mobile_friendly", "has_online_booking",
                       "booking_platform", "instagram_url", "facebook_url", "social_status", "deficiency_score",
                       "primary_deficiency", "hook_text", "notes", "email", "email_status")


@query(f"""SELECT stage, CAST(n AS BIGINT) AS rows FROM (SELECT 'enrich_site' AS stage, COUNT(*) FILTER (site_fetch_status IS NOT NULL) AS n FROM ({_BOOKED}) b
    UNION ALL SELECT 'enrich_booking', COUNT(*) FILTER (has_online_booking IS NOT NULL) FROM ({_BOOKED}) b
    UNION ALL SELECT 'enrich_social', COUNT(*) FILTER (social_status IS NOT NULL) FROM ({_BOOKED}) b
    UNION ALL SELECT 'enrich_contact', COUNT(*) FILTER (scan = false OR captured) FROM ({_FLOW}) f
    UNION ALL SELECT 'hooks', COUNT(*) FROM ({_BOOKED}) b UNION ALL SELECT 'score', COUNT(*) FROM ({_BOOKED}) b) t""")
def stage_totals(spark, d):
    before = schemas.conform(load(spark, d, "fresh_biz"), schemas.BUSINESSES)
    captures = spread_load(spark, d, "captures")
    return lead_flow.stage_totals(before, lead_flow.enrich(before, captures, as_of()), captures)


_DONE = f"SELECT *, CASE WHEN scraped IS NOT NULL THEN scraped WHEN asked THEN f.email END AS final_email FROM (SELECT *, {_FLOW_ASKED} AS asked, {_LOOKUP} AS domain_key FROM ({_FLOW}) l2) l3 LEFT JOIN (SELECT domain, email AS email, status FROM <<finder>> f0) f ON asked AND f.domain = domain_key"


_OWN_PAGE = "(COALESCE(website_url, '') <> '' AND COALESCE(site_platform, '') NOT IN ('none', 'facebook', 'linktree'))"


@query(f"""SELECT place_id, 'enrich_site' AS stage, CASE WHEN site_fetch_status = 'timeout' OR (site_fetch_status = 'error' AND failure = 'tls') THEN 'warn' WHEN site_fetch_status = 'error' THEN 'error' ELSE 'info' END AS level,
      'Site ' || site_fetch_status || ' for ' || name || ', platform ' || site_platform AS message FROM ({_DONE}) a WHERE site_fetch_status IS NOT NULL
    UNION ALL SELECT place_id, 'enrich_booking', CASE WHEN {_OWN_PAGE} AND failure IS NOT NULL THEN 'error' ELSE 'info' END,
      CASE WHEN NOT {_OWN_PAGE} THEN 'Booking check skipped for ' || name WHEN failure IS NOT NULL THEN 'Booking check failed for ' || name
      ELSE 'Booking check for ' || name || ': ' || CAST(has_online_booking AS STRING) || ', platform ' || COALESCE(booking_platform, 'none') END FROM ({_DONE}) e WHERE has_online_booking IS NOT NULL
    UNION ALL SELECT place_id, 'enrich_social', CASE WHEN failure IS NOT NULL THEN 'error' ELSE 'info' END,
      CASE WHEN failure IS NOT NULL THEN 'Social check failed for ' || name
      ELSE 'Social check for ' || name || ': ' || COALESCE(instagram_url, 'none') || ', ' || COALESCE(facebook_url, 'none') END
      FROM ({_DONE}) g WHERE social_status IS NOT NULL AND COALESCE(website_url, '') <> '' AND NOT REGEXP_MATCHES(LOWER(website_url), 'facebook[.]com|linktr[.]ee')
    UNION ALL SELECT place_id, 'enrich_contact', 'info', 'Contact form found: ' || form FROM ({_DONE}) b WHERE form IS NOT NULL
    UNION ALL SELECT place_id, 'enrich_contact', 'info', 'Found email for ' || name || ': ' || final_email FROM ({_DONE}) c WHERE final_email IS NOT NULL
    UNION ALL SELECT place_id, 'hooks', 'info', 'Generated hook: ' || line FROM ({_DONE}) d
    UNION ALL SELECT NULL, stage, 'info', 'Completed stage for ' || CAST(rows AS STRING) || ' businesses' FROM ({CHECKS['stage_totals']}) t""")
def stage_events(spark, d):
    before = schemas.conform(load(spark, d, "fresh_biz"), schemas.BUSINESSES)
    captures = spread_load(spark, d, "captures")
    after = lead_flow.enrich(before, captures, as_of(), load(spark, d, "finder"))
    return lead_flow.run_events(before, after, captures, as_of()).select("place_id", "stage", "level", "message")


# ---------------------------------------------------------------- links, URLs, text

@query(f"SELECT page_id, ord, href, text FROM {Q.anchors('<<captures>>', 'page_id')} a")
def anchor_rows(spark, d):
    return captured.anchor_links(page_facts(spark, d), ["page_id"]).select("page_id", "ord", "href", "text")


def _homepages(spark, d):
    return page_facts(spark, d).select(F.col("page_id").alias("site_id"), "final_url", "parts")


_ANCHOR_URL = Q.canonical("target")
_LINKS = f"""SELECT site_id, home_url, url, MAX(score) AS score FROM (
    SELECT page_id AS site_id, {Q.canonical('final_url')} AS home_url, url, {Q.count_words("LOWER(text || ' ' || url)", C.PRICE_LINK_WORDS)} AS score
    FROM (SELECT *, {_ANCHOR_URL} AS url FROM (SELECT *, {Q.resolved('final_url', 'href')} AS target
          FROM {Q.anchors('<<captures>>', 'page_id, final_url')} a) t WHERE REGEXP_MATCHES(target, '^https?://')) x
    WHERE {Q.registrable('url')} = {Q.registrable('final_url')} OR {Q.registrable('url')} IN ({Q.BOOKING_HOSTS})
    UNION ALL
    SELECT site_id, {Q.canonical('final_url')} AS home_url, url, {Q.count_words("LOWER(url)", C.PRICE_LINK_WORDS)} AS score
    FROM (SELECT site_id, final_url, {Q.canonical('loc')} AS url FROM (SELECT site_id, final_url,
          UNNEST(REGEXP_EXTRACT_ALL(xml, {Q.quoted(C.SITEMAP_LOC)}, 1)) AS loc FROM <<sitemaps>> m) s1) s2
    WHERE {Q.registrable('url')} = {Q.registrable('final_url')}) u WHERE score > 0 GROUP BY site_id, home_url, url"""


@query(f"SELECT site_id, url, score FROM ({_LINKS}) l")
def link_scores(spark, d):
    return frontier.link_scores(_homepages(spark, d), load(spark, d, "sitemaps")).select("site_id", "url", "score")


@query(f"""SELECT site_id, page_ord, url, score FROM (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY site_id ORDER BY score DESC, url) AS INT) AS page_ord
    FROM (SELECT site_id, url, score FROM ({_LINKS}) l WHERE url <> home_url UNION ALL
          SELECT page_id, {Q.canonical('final_url')}, 10000 FROM <<captures>> c) u) r WHERE page_ord <= 12""")
def frontier_topk(spark, d):
    return frontier.frontier(_homepages(spark, d), load(spark, d, "sitemaps"))


@query(f"""SELECT host, url, CAST(ROW_NUMBER() OVER (PARTITION BY host ORDER BY MD5(url), url) - 1 AS BIGINT) AS offset_seconds
    FROM (SELECT {Q.canonical('url')} AS url, {Q.host('url')} AS host FROM <<pages>> p) u""")
def politeness_plan(spark, d):
    return frontier.politeness_plan(load(spark, d, "pages").select(U.canonical_url(F.col("url")).alias("url")))


@query(f"""SELECT batch, host, url, CAST(ROW_NUMBER() OVER (PARTITION BY host ORDER BY batch, MD5(url), url) - 1 AS BIGINT) * 2 AS offset_seconds
    FROM (SELECT batch, {Q.canonical('url')} || tail AS url, {Q.host('url')} AS host FROM (
          SELECT 1 AS batch, url, '' AS tail FROM <<pages>> a UNION ALL SELECT 2, url, '/prices' FROM <<pages>> b) p) u""")
def politeness_batches(spark, d):
    first, second = (load(spark, d, "pages").select(F.concat(U.canonical_url(F.col("url")), F.lit(tail)).alias("url")) for tail in ("", "/prices"))
    plan = frontier.politeness_plan(first, 2)
    later = frontier.politeness_plan(second, 2, frontier.next_pace(plan, 2))
    return plan.select(F.lit(1).alias("batch"), "*").unionByName(later.select(F.lit(2).alias("batch"), "*"))


@query(f"""SELECT site_id, UNNEST(REGEXP_EXTRACT_ALL(xml, {Q.quoted(C.SITEMAP_LOC)}, 1)) AS href FROM <<sitemaps>> m""")
def sitemap_links(spark, d):
    return captured.sitemap_links(load(spark, d, "sitemaps"), ["site_id"])


_SUFFIXES = "SELECT DISTINCT REGEXP_EXTRACT(url, '^[a-z]+://[^/?#]*[.]([a-z]+)', 1) AS suffix FROM <<pages>>"


@query(f"SELECT DISTINCT {Q.host('url')} AS host, {Q.registrable('url')} AS registrable_host FROM <<pages>> p")
def registrable_hosts(spark, d):
    pages = load(spark, d, "pages")
    hosts = pages.select(U.host(F.col("url")).alias("host"))
    suffixes = pages.select(F.regexp_extract("url", "^[a-z]+://[^/?#]*[.]([a-z]+)", 1).alias("suffix")).distinct()
    return U.registrable_hosts(hosts, suffixes)


_ZONE_RULES = ["test", "*.zone1.test", "!b3.zone1.test", "zone2.test", "*.b2.zone2.test"]


_ZONE_HOST = """REGEXP_EXTRACT(host, CASE WHEN CONTAINS(host, '.b3.zone1.') OR (CONTAINS(host, '.zone2.') AND NOT CONTAINS(host, '.b2.')) THEN '([^.]+[.][^.]+[.][^.]+)$'
    WHEN CONTAINS(host, '.zone1.') OR CONTAINS(host, '.b2.zone2.') THEN '(.*)' ELSE '([^.]+[.][^.]+)$' END, 1) AS registrable_host"""


@query(f"SELECT DISTINCT host, {_ZONE_HOST} FROM <<zone_hosts>> z")
def suffix_rules(spark, d):
    hosts = load(spark, d, "zone_hosts")
    rules = spark.createDataFrame([(rule,) for rule in _ZONE_RULES], "suffix string")
    return U.registrable_hosts(hosts, rules)


@query(f"SELECT page_id, {_ZONE_HOST} FROM <<zone_hosts>> z")
def suffix_rules_of_urls(spark, d):
    url = F.concat(F.lit("https://"), "host", F.lit("/menu?x=1"))
    return load(spark, d, "zone_hosts").select("page_id", U.registrable_host(url, _ZONE_RULES).alias("registrable_host"))


_ROBOTS = f"""SELECT DISTINCT {Q.host('url')} AS host FROM <<pages>> p WHERE page_id % 5 <> 0"""


@query(f"""SELECT url, CAST(NOT (listed.host IS NOT NULL AND LENGTH(u.host) % 3 = 0 AND CONTAINS(url, u.host || '/fr/')) AS INT) AS allowed
    FROM (SELECT DISTINCT {Q.canonical('url')} AS url, {Q.host('url')} AS host FROM <<pages>> p) u LEFT JOIN ({_ROBOTS}) listed ON listed.host = u.host""")
def robots_filter(spark, d):
    pages = load(spark, d, "pages")
    hosts = pages.where("page_id % 5 <> 0").select(U.netloc(F.col("url")).alias("host")).distinct()
    kind = F.length("host") % 3
    rules = hosts.select("host", F.when(kind == 0, "User-agent: *\nDisallow: /fr/\n").when(kind == 1, "User-agent: *\nDisallow: /\n")
                         .otherwise("User-agent: otherbot\nDisallow: /\n").alias("robots_txt"),
                         F.when(kind == 1, 503).otherwise(200).alias("http_status"))
    urls = pages.select(U.canonical_url(F.col("url")).alias("url"))
    return robots.robots_filter(urls, rules).select("url", F.col("allowed").cast("int").alias("allowed"))


@query(f"SELECT page_id, {Q.canonical('url')} AS url FROM <<pages>> p")
def canonical_url(spark, d):
    return load(spark, d, "pages").select("page_id", U.canonical_url(F.col("url")).alias("url"))


@query("SELECT page_id, SHA256(html) AS content_sha256 FROM <<pages>> p")
def content_hash(spark, d):
    return load(spark, d, "pages").select("page_id", F.sha2("html", 256).alias("content_sha256"))


@query(f"SELECT doc_id, {Q.normalized('text')} AS label FROM <<documents>> d")
def text_norm_native(spark, d):
    return spread_load(spark, d, "documents").select("doc_id", T.normalize_label_native(F.col("text")).alias("label"))


@query(f"SELECT doc_id, REPLACE({Q.normalized('NFC_NORMALIZE(text)')}, 'ß', 'ss') AS label FROM <<documents>> d")
def text_norm(spark, d):
    return spread_load(spark, d, "documents").select("doc_id", T.normalize_label(F.col("text")).alias("label"))


_SHOWN = "html"
for _tag in ("script", "style", "noscript", "nav", "footer"):
    _SHOWN = f"REGEXP_REPLACE({_SHOWN}, '(?is)<{_tag}[ >].*?</{_tag}>', '<>', 'g')"
_SHOWN = f"REGEXP_REPLACE(REGEXP_REPLACE({_SHOWN}, '(?s)<!--.*?-->', '<>', 'g'), '<[^>]*>', CHR(1), 'g')"


def _decoded(text: str) -> str:
    """Basic character references, also without their semicolon; decoded ampersands are not read again."""
    for name, char in (("amp", "CHR(2)"), ("lt", "'<'"), ("gt", "'>'"), ("quot", "'\"'")):
        text = f"REPLACE(REPLACE({text}, '&{name};', {char}), '&{name}', {char})"
    return f"REPLACE({text}, CHR(2), '&')"


@query(f"""SELECT page_id, TRIM({_decoded("REGEXP_EXTRACT(html, '<title>(.*?)</title>', 1)")}) AS title, ARRAY_TO_STRING(LIST_FILTER(LIST_TRANSFORM(
    STRING_SPLIT({_decoded(_SHOWN)}, CHR(1)), LAMBDA x: REGEXP_REPLACE(x, '^\\s+|\\s+$', '', 'g')), LAMBDA x: x <> ''), ' ') AS visible_text FROM <<captures>> c""")
def visible_text(spark, d):
    return page_facts(spark, d).select("page_id", "parts.title", "parts.visible_text")


@query(f"SELECT p_partkey, {Q.collapsed('row_text')} AS row_text FROM <<menu_pages>> m WHERE CONTAINS(row_text, '$')")
def price_row_texts(spark, d):
    pages = captured.with_page_parts(spread_load(spark, d, "menu_pages"))
    return pages.select("p_partkey", F.explode_outer("parts.rows").alias("row_text")).where("row_text IS NOT NULL")


# ---------------------------------------------------------------- markets and freshness

_KEY = Q.collapsed("LOWER(metro)")
_TENANTS = f"SELECT tenant_id, {_KEY} AS metro_key, {Q.collapsed('metro')} AS metro FROM <<locations>> l WHERE is_primary AND metro IS NOT NULL"


@query(f"""SELECT metro_key, MIN_BY(metro, tenant_id) AS metro, COUNT(*) AS tenants FROM ({_TENANTS}) t WHERE metro_key <> '' GROUP BY metro_key""")
def market_groups(spark, d):
    return markets.market_groups(load(spark, d, "locations"))


@query(f"SELECT metro_key, metro, tenant_id FROM ({_TENANTS}) t WHERE metro_key <> ''")
def market_tenants(spark, d):
    return markets.tenant_markets(load(spark, d, "locations")).drop("ord")


@query(f"""SELECT {_KEY} AS metro_key, MIN_BY({Q.collapsed('metro')}, tenant_id) AS metro, CAST(0 AS BIGINT) AS tenants FROM <<locations>> l
    WHERE {_KEY} <> '' GROUP BY 1""")
def explicit_markets(spark, d):
    return markets.explicit_markets(load(spark, d, "locations"), "tenant_id")


@query(f"SELECT tenant_id FROM ({_TENANTS}) t WHERE metro_key = ''")
def invalid_tenants(spark, d):
    return markets.invalid_tenants(load(spark, d, "locations"))


_FRESH = f"COALESCE(last_status = 'complete' AND last_completed_at > {NOW} - INTERVAL 7 DAY, false)"


@query(f"SELECT metro_key, CAST({_FRESH} AS INT) AS fresh FROM <<scrapes>> s")
def market_fresh(spark, d):
    return markets.market_freshness(load(spark, d, "scrapes"), as_of()).select("metro_key", F.col("fresh").cast("int").alias("fresh"))


@query(f"""SELECT g.metro_key FROM (SELECT DISTINCT metro_key FROM ({_TENANTS}) t WHERE metro_key <> '') g
    WHERE g.metro_key NOT IN (SELECT metro_key FROM <<scrapes>> s WHERE {_FRESH})""")
def due_markets(spark, d):
    return markets.due_markets(markets.market_groups(load(spark, d, "locations")), load(spark, d, "scrapes"), as_of()).select("metro_key")


@query(f"""SELECT g.metro_key, g.query_ord, g.query FROM (SELECT metro_key, query_ord, phrase || ' in ' || metro_key AS query FROM (
      SELECT metro_key, UNNEST([0, 1, 2]) AS query_ord, UNNEST(['med spa', 'day spa', 'medical spa']) AS phrase
      FROM (SELECT DISTINCT metro_key FROM ({_TENANTS}) t WHERE metro_key <> '') k) p) g WHERE g.metro_key NOT IN (SELECT metro_key FROM <<scrapes>> s WHERE last_completed_at > {NOW} - INTERVAL 7 DAY)""")
def due_searches(spark, d):
    runs_ = load(spark, d, "scrapes").select("metro_key", F.col("last_completed_at").alias("completed_at"))
    due = lead_flow.due_metros(markets.market_groups(load(spark, d, "locations")), runs_, as_of())
    return places.search_requests(due.select("metro_key", F.col("metro_key").alias("metro"))).select("metro_key", "query_ord", "query")


_MEMBERS = "SELECT 'cmp_' || CAST(l_suppkey AS STRING) AS competitor_id, 'm' || CAST(l_partkey % 97 AS STRING) AS metro_key FROM <<lineitem>> l"


@query(f"SELECT DISTINCT competitor_id FROM ({_MEMBERS}) m WHERE metro_key IN (SELECT 'm' || CAST(n_nationkey AS STRING) FROM <<nation>> n)")
def market_competitors(spark, d):
    members = load(spark, d, "lineitem").select(
        F.concat(F.lit("cmp_"), F.col("l_suppkey").cast("string")).alias("competitor_id"),
        F.concat(F.lit("m"), (F.col("l_partkey") % 97).cast("string")).alias("metro_key"))
    chosen = load(spark, d, "nation").select(F.concat(F.lit("m"), F.col("n_nationkey").cast("string")).alias("metro_key"))
    return markets.market_competitors(members, chosen)


@query("""SELECT 'id_' || place_id AS id, website_url AS website FROM <<stored_places>> o WHERE website_url IS NOT NULL
    AND place_id IN (SELECT place_id FROM <<search_places>> s)""")
def eligible_competitors(spark, d):
    stored = load(spark, d, "stored_places").select(F.concat(F.lit("id_"), "place_id").alias("id"), F.col("website_url").alias("website"))
    found = load(spark, d, "search_places").select(F.concat(F.lit("id_"), "place_id").alias("competitor_id"))
    return markets.eligible_competitors(stored, found)


@query(f"""SELECT g.level, g.message FROM (SELECT LOWER(n_name) || ', il' AS metro_key, CASE WHEN f.metro_key IS NULL THEN 'info' ELSE 'error' END AS level,
    CASE WHEN f.metro_key IS NULL THEN 'Completed discovery for metro: ' || n_name || ', IL' ELSE 'One or more place queries or writes failed.' END AS message
    FROM <<nation>> n LEFT JOIN (SELECT DISTINCT LOWER(metro) AS metro_key FROM <<search>> s WHERE status = 'OVER_QUERY_LIMIT') f
      ON f.metro_key = LOWER(n_name) || ', il') g""")
def discovery_log(spark, d):
    searched = load(spark, d, "scrapes").select("metro_key", "metro")
    status = markets.market_status(searched, places.search_failures(load(spark, d, "search")), as_of())
    return lead_flow.discovery_events(searched, status, as_of()).select("level", "message")


@query(f"""SELECT competitor_id, CAST(COALESCE(MAX(completed_at) > {NOW} - INTERVAL 7 DAY, false) AS INT) AS fresh FROM <<runs>> r
    WHERE status IN ('complete', 'partial') GROUP BY competitor_id""")
def crawl_fresh(spark, d):
    return markets.crawl_freshness(load(spark, d, "runs"), as_of()).select("competitor_id", F.col("fresh").cast("int").alias("fresh"))


@query(f"""SELECT g.metro_key, g.metro, CASE WHEN f.metro_key IS NULL THEN 'complete' ELSE 'partial' END AS last_status,
    CASE WHEN f.metro_key IS NULL THEN '2024-02-05 00:00:00' END AS last_completed_at,
    CASE WHEN f.metro_key IS NOT NULL THEN 'One or more place queries or writes failed.' END AS last_error
    FROM (SELECT LOWER(n_name) || ', il' AS metro_key, n_name || ', IL' AS metro FROM <<nation>> n) g
    LEFT JOIN (SELECT DISTINCT LOWER(metro) AS metro_key FROM <<search>> s WHERE status = 'OVER_QUERY_LIMIT') f ON f.metro_key = g.metro_key""")
def merge_market(spark, d):
    searched = load(spark, d, "scrapes").select("metro_key", "metro")
    status = markets.market_status(searched, places.search_failures(load(spark, d, "search")), as_of())
    return markets.merge_market_status(load(spark, d, "scrapes"), status).select(
        "metro_key", "metro", "last_status", F.date_format("last_completed_at", "yyyy-MM-dd HH:mm:ss").alias("last_completed_at"), "last_error")


# ---------------------------------------------------------------- places and merges

def _payloads(spark, d):
    """Search answers with nested results, two spellings of status included."""
    rows = load(spark, d, "search").join(load(spark, d, "search_places").select(
        F.col("result_ord").cast("long").alias("c_custkey"), "place_id", "name", "address", "rating", "review_count"), "c_custkey", "left")
    result = F.struct("place_id", "name", F.col("address").alias("formatted_address"), "rating", F.col("review_count").alias("user_ratings_total"))
    return rows.select("metro", "query_ord", "status", "error_message", "c_custkey",
                       F.when(F.col("status") == "OK", F.array(result)).otherwise(F.array()).alias("results"))


@query("SELECT metro_key, query_ord, place_id, name, address, rating, review_count FROM <<search_places>> s")
def search_results(spark, d):
    return places.search_results(_payloads(spark, d)).select(
        "metro_key", "query_ord", "place_id", "name", "address", "rating", "review_count")


@query("SELECT LOWER(metro) AS metro_key, query_ord, status, COALESCE(error_message, status) AS error FROM <<search>> s WHERE status = 'OVER_QUERY_LIMIT'")
def search_failures(spark, d):
    return places.search_failures(load(spark, d, "search"))


@query("""SELECT metro_key, place_id, name, rating FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY metro_key, place_id
    ORDER BY query_ord DESC, result_ord DESC) AS rn FROM <<search_places>> s) r WHERE rn = 1""")
def place_dedupe(spark, d):
    return places.dedupe_places(load(spark, d, "search_places")).select("metro_key", "place_id", "name", "rating")


@query("SELECT DISTINCT place_id FROM <<search_places>> s WHERE place_id NOT IN (SELECT place_id FROM <<stored_places>> o)")
def place_new(spark, d):
    return places.new_places(load(spark, d, "search_places"), load(spark, d, "stored_places"))


_LAST = "MAX_BY({0}, STRUCT_PACK(a := metro_key, b := query_ord, c := result_ord)) FILTER ({0} IS NOT NULL) AS {0}"
_NEW_PLACES = f"""SELECT place_id, {', '.join(_LAST.format(c) for c in ('name', 'metro', 'address', 'rating', 'review_count'))}
    FROM <<search_places>> s GROUP BY place_id"""


@query(f"""SELECT COALESCE(n.place_id, o.place_id) AS place_id, COALESCE(n.name, o.name) AS name, COALESCE(n.metro, o.metro) AS metro,
    COALESCE(n.address, o.address) AS address, COALESCE(n.rating, o.rating) AS rating, COALESCE(n.review_count, o.review_count) AS review_count,
    CASE WHEN o.place_id IS NOT NULL THEN o.phone ELSE 'tel ' || n.place_id END AS phone, o.site_platform,
    COALESCE(o.email_status, 'not_attempted') AS email_status, COALESCE(o.review_status, 'new') AS review_status
    FROM ({_NEW_PLACES}) n FULL JOIN <<stored_places>> o ON o.place_id = n.place_id""")
def merge_business(spark, d):
    details = load(spark, d, "search_places").select("place_id", F.lit("OK").alias("status"), F.struct(
        F.concat(F.lit("tel "), "place_id").alias("formatted_phone_number"), F.lit(None).cast("string").alias("website")).alias("result"))
    merged, _ = lead_flow.discover(schemas.conform(load(spark, d, "stored_places"), schemas.BUSINESSES),
                                   load(spark, d, "scrapes").select("metro_key", "metro"), _payloads(spark, d), details, as_of())
    return merged.select("place_id", "name", "metro", "address", "rating", "review_count", "phone", "site_platform",
                         "email_status", "review_status")


_LAST_QUERY = """SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY place_id ORDER BY metro_key DESC, query_ord DESC, result_ord DESC) AS rn
    FROM <<search_places>> s) r WHERE rn = 1"""


@query(f"""SELECT COALESCE(n.place_id, o.place_id) AS place_id, CASE WHEN n.place_id IS NULL THEN o.name ELSE n.name END AS name,
    CASE WHEN o.place_id IS NULL THEN 'https://new.example.com/' ELSE o.website_url END AS website,
    CASE WHEN n.place_id IS NULL THEN o.rating ELSE n.rating END AS rating,
    CASE WHEN n.place_id IS NULL THEN o.review_count ELSE COALESCE(n.review_count, 0) END AS review_count
    FROM ({_LAST_QUERY}) n FULL JOIN <<stored_places>> o ON o.place_id = n.place_id""")
def merge_competitor(spark, d):
    merged, _, _ = _price_discovery(spark, d)
    return merged.select("place_id", "name", "website", "rating", "review_count")


def _price_discovery(spark, d, seen=None):
    stored = load(spark, d, "stored_places").select(
        F.concat(F.lit("id_"), "place_id").alias("id"), "place_id", "name", F.col("website_url").alias("website"), "rating", "review_count")
    details = load(spark, d, "search_places").select("place_id", F.lit("OK").alias("status"), F.struct(
        F.lit(None).cast("string").alias("formatted_phone_number"), F.lit("https://new.example.com/").alias("website")).alias("result"))
    return price_flow.discover(
        schemas.conform(stored, schemas.COMPETITORS), schemas.empty(spark, schemas.COMPETITOR_MARKETS) if seen is None else seen, load(spark, d, "scrapes"),
        load(spark, d, "scrapes").select("metro_key", "metro"), _payloads(spark, d), details, as_of())


# Half of the memberships, and some of markets that were not searched now, are stored from before under another spelling.
_SEEN = "SELECT DISTINCT place_id, metro_key FROM <<search_places>> s WHERE SUBSTRING(MD5(place_id || metro_key), 1, 1) < '8'"
_NOW_SEEN = "SELECT DISTINCT place_id, metro_key, metro FROM <<search_places>> n"


@query(f"""SELECT place_id, metro_key, metro, '2024-02-05' AS last_seen FROM ({_NOW_SEEN}) a
    UNION ALL SELECT place_id, metro_key || ' (closed)', 'Old spelling', '2023-01-01' FROM ({_SEEN}) b""")
def merge_memberships(spark, d):
    ids = _price_discovery(spark, d)[0].select(F.col("id").alias("competitor_id"), "place_id")
    half = load(spark, d, "search_places").where(F.substring(F.md5(F.concat("place_id", "metro_key")), 1, 1) < "8").select("place_id", "metro_key").distinct()
    stored = half.withColumn("metro_key", F.explode(F.array("metro_key", F.concat("metro_key", F.lit(" (closed)"))))).join(ids, "place_id").select(
        "competitor_id", "metro_key", F.lit("Old spelling").alias("metro"), F.lit("2023-01-01").cast("timestamp").alias("last_seen_at"))
    merged, joined, _ = _price_discovery(spark, d, schemas.conform(stored, schemas.COMPETITOR_MARKETS))
    names = merged.select(F.col("id").alias("competitor_id"), "place_id")
    return joined.join(names, "competitor_id").select("place_id", "metro_key", "metro", F.date_format("last_seen_at", "yyyy-MM-dd").alias("last_seen"))


@query("""SELECT 'cmp_' || CAST(l_suppkey AS STRING) AS competitor_id FROM <<lineitem>> l
    UNION SELECT 'cmp_' || CAST(s_suppkey AS STRING) FROM <<supplier>> s""")
def discovered_union(spark, d):
    found = load(spark, d, "lineitem").select(F.concat(F.lit("cmp_"), F.col("l_suppkey").cast("string")).alias("competitor_id"))
    cached = load(spark, d, "supplier").select(F.concat(F.lit("cmp_"), F.col("s_suppkey").cast("string")).alias("competitor_id"))
    return markets.discovered_union(found, cached)


@query("""SELECT place_id, name, CASE WHEN CAST(SUBSTRING(place_id, 7) AS INT) % 2 = 0 THEN 'checked' ELSE site_platform END AS site_platform
    FROM <<stored_places>> o""")
def update_stage_columns(spark, d):
    stored = load(spark, d, "stored_places")
    found = stored.where("CAST(SUBSTRING(place_id, 7) AS INT) % 2 = 0").select("place_id", F.lit("checked").alias("site_platform"))
    return update_columns(stored, found, ["place_id"], ["site_platform"]).select("place_id", "name", "site_platform")


@query(f"""SELECT 'cmp_' || CAST(c.page_id AS STRING) AS id, page_booking_platform AS booking_platform,
    CASE WHEN c.page_id % 3 = 0 THEN 'kept' WHEN CONTAINS(page_instagram, 'instagram.com/') THEN
    SPLIT_PART(REGEXP_REPLACE(SPLIT_PART(page_instagram, 'instagram.com/', 2), '/+$', ''), '?', 1) END AS ig_handle
    FROM <<captures>> c JOIN {Q.page_facts('<<captures>>')} f ON f.page_id = c.page_id""")
def enrich_competitors(spark, d):
    pages = spread_load(spark, d, "captures")
    ids = F.concat(F.lit("cmp_"), F.col("page_id").cast("string"))
    stored = load(spark, d, "pages").select(ids.alias("id"), F.lit("https://x.example.com").alias("website"),
                                            F.when(F.col("page_id") % 3 == 0, "kept").alias("ig_handle"))
    done = price_flow.enrich_competitors(schemas.conform(stored, schemas.COMPETITORS),
                                         pages.select(ids.alias("competitor_id"), "final_url", "html"), as_of())
    return done.select("id", "booking_platform", "ig_handle")


# ---------------------------------------------------------------- captures and runs

_OUTCOME = """CASE WHEN robots_allowed = false THEN 'robots_denied' WHEN http_status >= 400 THEN 'http_' || CAST(http_status AS STRING)
    WHEN NOT CONTAINS(LOWER(content_type), 'text/html') THEN 'non_html' WHEN body_bytes > 5242880 THEN 'oversized_body' ELSE 'ok' END"""


def _judged(spark, d):
    return load(spark, d, "menu_pages").withColumn("outcome", captured.capture_outcome())


@query(f"SELECT p_partkey, {_OUTCOME} AS outcome FROM <<menu_pages>> m")
def capture_outcome(spark, d):
    return _judged(spark, d).select("p_partkey", "outcome")


@query(f"""SELECT competitor_id, run_id, COUNT(*) AS pages_attempted, COUNT(*) FILTER (o = 'ok') AS pages_succeeded,
    COUNT(*) FILTER (o <> 'ok') AS error_count, CASE WHEN COUNT(*) FILTER (o = 'ok') = 0 THEN 'failed'
    WHEN COUNT(*) FILTER (o <> 'ok') = 0 THEN 'complete' ELSE 'partial' END AS status
    FROM (SELECT *, {_OUTCOME} AS o FROM <<menu_pages>> m) x GROUP BY competitor_id, run_id""")
def crawl_rollup(spark, d):
    return runs.crawl_runs(_judged(spark, d)).drop("started_at", "completed_at")


@query(f"""SELECT competitor_id, page_ord, url, 'RuntimeError' AS code, o AS message FROM (SELECT *, {_OUTCOME} AS o FROM <<menu_pages>> m) x WHERE o <> 'ok'""")
def crawl_errors(spark, d):
    return runs.crawl_errors(_judged(spark, d)).drop("run_id")


@query(f"""SELECT p_partkey, CAST(REGEXP_MATCHES(LOWER(REGEXP_EXTRACT(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1)), '{"|".join(C.PRICE_LINK_WORDS)}') AS INT) AS high_signal
    FROM <<menu_pages>> m""")
def high_signal(spark, d):
    return load(spark, d, "menu_pages").select("p_partkey", captured.high_signal(F.col("url")).cast("int").alias("high_signal"))


_CARE = "CASE WHEN p_partkey % 3 <> 0 THEN 249 ELSE 0 END"
_ROW = f"CASE WHEN p_partkey % 5 < 3 THEN LENGTH({Q.collapsed('row_text')}) ELSE 0 END"
_OFFERS = f"(p_partkey % 5 < 3 AND CONTAINS(row_text, '$') AND REGEXP_MATCHES({Q.collapsed('row_text')}, {Q.quoted(C.OFFERING_NAME)}))"


@query(f"""SELECT p_partkey, CAST({_CARE} + {_ROW} + CASE WHEN {_CARE} > 0 AND {_ROW} > 0 THEN 1 ELSE 0 END < 200
    OR (p_partkey % 4 < 2 AND NOT {_OFFERS}) AS INT) AS needs_render FROM <<shells>> s""")
def needs_render(spark, d):
    pages = captured.with_page_parts(spread_load(spark, d, "shells"))
    return pages.select("p_partkey", captured.needs_render(offers.has_candidates()).cast("int").alias("needs_render"))


# ---------------------------------------------------------------- prices

_PRICE_COLUMNS = ("offering_type, display_name, price_type, currency, price_unit, package_quantity, price_display, evidence_text, "
                  "CAST(valid_through AS STRING) AS valid_through")


def _minor_sql(names=("amount_min", "amount_max", "original_amount")) -> str:
    return ", ".join(f"{Q.minor(n)} AS {n}_minor" for n in names)


def _price_rows(spark, d, parity):
    rows = load(spark, d, "menu").where(F.contains("row_text", F.lit("$"))).select("p_partkey", "row_text")
    return parse_rows(rows, "row_text", parity).select(
        "p_partkey", "offering_type", "display_name", "price_type", "currency", "price_unit", "package_quantity", "price_display",
        "evidence_text", *text_of("valid_through"), *[minor_units(F.col(c)).alias(f"{c}_minor") for c in ("amount_min", "amount_max", "original_amount")])


@query(f"SELECT p_partkey, {_PRICE_COLUMNS}, {_minor_sql()} FROM {Q.price_fields('<<menu>>', 'row_text')} p")
def price_rows(spark, d):
    return _price_rows(spark, d, parity=False)


@query(f"SELECT p_partkey, {_PRICE_COLUMNS}, {_minor_sql()} FROM {Q.price_fields('<<menu>>', 'row_text', parity=True)} p")
def price_rows_parity(spark, d):
    return _price_rows(spark, d, parity=True)


@query("""SELECT p_partkey, 'fixed' AS price_type, p_partkey * 100000000000000 + 25 AS amount_min_minor FROM <<part>> p""")
def large_amounts(spark, d):
    rows = load(spark, d, "part").select("p_partkey", F.concat(F.lit("Estate - $"), F.col("p_partkey").cast("string"), F.lit("000000000000.25")).alias("t"))
    return parse_rows(rows, "t").select("p_partkey", "price_type", minor_units(F.col("amount_min")).alias("amount_min_minor"))


_OK_PAGES = f"(SELECT * FROM (SELECT *, {_OUTCOME} AS o FROM <<menu_pages>> m0) m1 WHERE o = 'ok')"
_KIT = "'Kit ' || CAST(p_partkey % 7 AS STRING)"
_COST = "CAST(p_partkey % 300 AS STRING)"
_STRUCTURED = f"""SELECT p_partkey, competitor_id, run_id, page_ord, final_url, html, title, business_name, {_KIT} AS display_name, 0 AS cand_ord,
      'usd ' || {_COST} || '.5' AS price_display, CAST({_COST} || '.5' AS DECIMAL(18, 6)) AS amount_min, 'USD' AS currency FROM {_OK_PAGES} a WHERE p_partkey % 4 = 0
    UNION ALL SELECT p_partkey, competitor_id, run_id, page_ord, final_url, html, title, business_name, {_KIT}, 1, 'USD ' || {_COST},
      CAST({_COST} AS DECIMAL(18, 6)), 'USD' FROM {_OK_PAGES} b WHERE p_partkey % 4 = 0"""


@query(f"SELECT p_partkey, cand_ord, display_name, price_display, CAST(amount_min * 100 AS BIGINT) AS amount_min_minor, currency FROM ({_STRUCTURED}) s")
def jsonld_offers(spark, d):
    pages = price_flow.read_pages(spread_load(spark, d, "menu_pages"))
    found = offers.candidates(offers.page_items(pages, ["p_partkey"]), ["p_partkey"]).where("structured")
    return found.select("p_partkey", F.col("cand_ord").cast("int").alias("cand_ord"), "display_name", "price_display",
                        minor_units(F.col("amount_min")).alias("amount_min_minor"), "currency")


_REPEATS = """SELECT l_orderkey AS page, CAST(l_linenumber * 1000000 + l_partkey AS BIGINT) AS cand_ord, 'Line ' || l_returnflag AS display_name,
    CASE WHEN l_linestatus = 'O' THEN '$1' END AS price_display, l_linenumber = 1 AS structured
    FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus FROM <<lineitem>>) l"""


@query(f"""SELECT page, cand_ord, display_name, price_display FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY page, LOWER(display_name), price_display
    ORDER BY cand_ord) AS rn FROM ({_REPEATS}) r) x WHERE structured OR rn = 1""")
def candidate_dedupe(spark, d):
    lines = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus").distinct()
    found = lines.select(
        F.col("l_orderkey").alias("page"), (F.col("l_linenumber").cast("long") * 1000000 + F.col("l_partkey")).alias("cand_ord"),
        F.concat(F.lit("Line "), "l_returnflag").alias("display_name"), F.when(F.col("l_linestatus") == "O", "$1").alias("price_display"),
        (F.col("l_linenumber") == 1).alias("structured"))
    return offers.dedupe_candidates(found, ["page"]).select("page", "cand_ord", "display_name", "price_display")


_DOM = f"""SELECT p_partkey, competitor_id, run_id, page_ord, final_url, html, title, business_name, row_text, offering_type, display_name, price_type, amount_min,
    amount_max, currency, price_unit, package_quantity, original_amount, valid_through, price_display, evidence_text, 1000000000 AS cand_ord
    FROM {Q.price_fields(_OK_PAGES, 'row_text')} pf"""
_CANDIDATES = f"""SELECT p_partkey, competitor_id, run_id, page_ord, final_url, title, business_name, offering_type, display_name, price_type, amount_min, amount_max,
      currency, price_unit, package_quantity, original_amount, valid_through, price_display, evidence_text, cand_ord, row_text FROM ({_DOM}) dom
    UNION ALL SELECT s.p_partkey, s.competitor_id, s.run_id, s.page_ord, s.final_url, s.title, s.business_name, 'service', display_name, 'fixed', amount_min, NULL, currency,
      'total', NULL, NULL, NULL, price_display, display_name || ' ' || price_display, cand_ord, m.row_text FROM ({_STRUCTURED}) s JOIN <<menu>> m ON m.p_partkey = s.p_partkey"""
_ALIAS = "(SELECT raw_name_key, MAX(service_catalog_id) AS alias_id FROM <<aliases>> a GROUP BY raw_name_key)"
_CATALOG = f"(SELECT {Q.normalized('name')} AS catalog_key, MAX(id) AS catalog_id FROM <<catalog>> c GROUP BY 1)"
_VALIDATED = f"""SELECT *, CASE WHEN NOT branded THEN 'unverified_booking_brand' WHEN NOT CONTAINS(norm_evidence, norm_name) THEN 'name_not_in_evidence'
      WHEN price_type <> 'none' AND (price_display IS NULL OR NOT CONTAINS(norm_evidence, {Q.normalized('price_display')})) THEN 'amount_not_in_evidence'
      WHEN price_type <> 'none' AND currency IS NULL AND NOT dollar_market THEN 'unknown_currency'
      WHEN price_type = 'none' AND COALESCE(service_catalog_id, '') = '' THEN 'service_mapping_needed' END AS review_reason,
    offering_type || ':' || norm_name || ':base:' || COALESCE(price_unit, 'none') || ':' || CAST(COALESCE(package_quantity, 0) AS STRING) AS offering_key,
    CASE WHEN branded AND price_type <> 'none' AND currency IS NULL AND dollar_market THEN 'USD' ELSE currency END AS final_currency
    FROM (SELECT x.*, COALESCE(alias_id, catalog_id) AS service_catalog_id, COALESCE(REGEXP_MATCHES(k.market, '{C.CITY_STATE}'), false) AS dollar_market,
            NOT {Q.registrable('final_url')} IN ({Q.BOOKING_HOSTS}) OR CONTAINS({Q.normalized("title || ' ' || title || ' ' || row_text")}, {Q.normalized('business_name')}) AS branded
          FROM (SELECT *, {Q.normalized('display_name')} AS norm_name, {Q.normalized('evidence_text')} AS norm_evidence FROM ({_CANDIDATES}) c0) x
          LEFT JOIN {_ALIAS} al ON al.raw_name_key = norm_name LEFT JOIN {_CATALOG} ct ON ct.catalog_key = norm_name
          LEFT JOIN <<menu_competitors>> k ON k.id = x.competitor_id) v"""


def _observations(spark, d):
    pages = price_flow.read_pages(spread_load(spark, d, "menu_pages"))
    return price_flow.observations(pages, load(spark, d, "menu_competitors"), load(spark, d, "aliases"), load(spark, d, "catalog"))


def _candidates(spark, d):
    return price_flow.page_candidates(price_flow.read_pages(spread_load(spark, d, "menu_pages")), load(spark, d, "menu_competitors"))


@query(f"""SELECT competitor_id, page_ord, CAST(cand_ord AS BIGINT) AS cand_ord, offering_key, offering_type, display_name, service_catalog_id, price_type,
    final_currency AS currency, price_unit, package_quantity, {_minor_sql()}, CAST(valid_through AS STRING) AS valid_through, price_display, evidence_text,
    CASE WHEN review_reason IS NULL THEN 'published' ELSE 'pending' END AS publication_status, review_reason FROM ({_VALIDATED}) v""")
def publication(spark, d):
    return _observations(spark, d).select(
        "competitor_id", "page_ord", "cand_ord", "offering_key", "offering_type", "display_name", "service_catalog_id", "price_type", "currency",
        "price_unit", "package_quantity", "amount_min_minor", "amount_max_minor", "original_amount_minor", *text_of("valid_through"), "price_display",
        "evidence_text", "publication_status", "review_reason")


_MONEY_TEXT = "COALESCE(CAST({0} AS STRING), 'None')"
_FINGERPRINT = "SHA256(" + " || '|' || ".join(
    [f"competitor_id", Q.canonical("final_url"), "offering_key", "price_type"]
    + [_MONEY_TEXT.format(c) for c in (Q.minor("amount_min"), Q.minor("amount_max"), "final_currency", "price_unit", "package_quantity",
                                       Q.minor("original_amount"))]
    + ["'None'", _MONEY_TEXT.format("valid_through"), "norm_evidence"]) + ")"


@query(f"SELECT competitor_id, page_ord, CAST(cand_ord AS BIGINT) AS cand_ord, {_FINGERPRINT} AS source_fingerprint FROM ({_VALIDATED}) v")
def fingerprints(spark, d):
    return _observations(spark, d).select("competitor_id", "page_ord", "cand_ord", "source_fingerprint")


@query(f"""SELECT competitor_id, page_ord, service_catalog_id, display_name FROM ({_VALIDATED}) v""")
def catalog_map(spark, d):
    found = publish.with_catalog(_candidates(spark, d), load(spark, d, "aliases"), load(spark, d, "catalog"))
    return found.select("competitor_id", "page_ord", "service_catalog_id", "display_name")


@query(f"SELECT competitor_id, page_ord, display_name, CAST(branded AS INT) AS branded FROM ({_VALIDATED}) v")
def branded_pages(spark, d):
    return _candidates(spark, d).select("competitor_id", "page_ord", "display_name", F.col("branded").cast("int").alias("branded"))


@query("""SELECT competitor_id, source_fingerprint, page_ord, cand_ord FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY competitor_id, source_fingerprint
    ORDER BY page_ord, cand_ord) AS rn FROM <<obs>> o) r WHERE rn = 1""")
def first_seen(spark, d):
    one_run = load(spark, d, "obs").withColumn("run_id", F.lit("run"))
    return publish.first_seen(one_run).select("competitor_id", "source_fingerprint", "page_ord", "cand_ord")


@query("""SELECT page_ord, COUNT(*) AS candidates, COUNT(*) FILTER (rn > 1) AS duplicates FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY competitor_id,
    source_fingerprint ORDER BY page_ord, cand_ord) AS rn FROM <<obs>> o) r GROUP BY page_ord""")
def duplicates_collapsed(spark, d):
    found = load(spark, d, "obs").withColumn("run_id", F.lit("run"))
    return publish.duplicates_collapsed(found, publish.first_seen(found), ["page_ord"])


@query(f"""SELECT competitor_id, page_ord, final_url, title, SHA256(html) AS content_sha256,
    competitor_id || '/run_1/' || SHA256(html) || '.html' AS archive_path FROM {_OK_PAGES} p
    WHERE page_ord IN (SELECT page_ord FROM ({_VALIDATED}) v)""")
def evidence_pages(spark, d):
    pages = cut_lineage(price_flow.page_rows(spread_load(spark, d, "menu_pages")))
    found = price_flow.row_observations(price_flow.row_candidates(pages, load(spark, d, "menu_competitors")), load(spark, d, "aliases"), load(spark, d, "catalog"))
    return runs.evidence_pages(pages.where("outcome = 'ok'"), found).select(
        "competitor_id", "page_ord", "final_url", "title", "content_sha256", "archive_path")


# ---------------------------------------------------------------- the crawl as one run

_DUE = f"""(SELECT c.id FROM <<menu_sites>> c WHERE COALESCE(c.website, '') <> '' AND c.id NOT IN (SELECT competitor_id FROM <<menu_runs>> r
    WHERE status IN ('complete', 'partial') AND completed_at > {NOW} - INTERVAL 7 DAY))"""
_DUE_PAGES = f"(SELECT *, {_OUTCOME} AS o FROM <<menu_pages>> m WHERE competitor_id IN {_DUE})"


def _crawl_run(spark, d, force=False, **options) -> price_flow.CrawlRun:
    tables = price_flow.PriceTables(_stored(spark, d), *(schemas.empty(spark, s) for s in (schemas.OFFERING_CANDIDATES, schemas.PRICE_EVENTS)))
    return price_flow.crawl_run(tables, spread_load(spark, d, "menu_pages"), load(spark, d, "menu_sites"), load(spark, d, "aliases"), load(spark, d, "catalog"),
                                load(spark, d, "menu_runs"), as_of(), force, **options)


def _run_sql(pages: str) -> str:
    return f"""SELECT competitor_id, run_id, CASE WHEN COUNT(*) FILTER (o = 'ok') = 0 THEN 'failed' WHEN COUNT(*) FILTER (o <> 'ok') = 0 THEN 'complete' ELSE 'partial' END AS status,
    COUNT(*) AS pages_attempted, COUNT(*) FILTER (o = 'ok') AS pages_succeeded, COUNT(*) FILTER (o <> 'ok') AS error_count FROM {pages} p GROUP BY competitor_id, run_id"""


@query(f"""{_run_sql(_DUE_PAGES)} UNION ALL SELECT competitor_id, run_id, status, pages_attempted, pages_succeeded, error_count FROM <<menu_runs>> r""")
def price_run_rows(spark, d):
    merged = runs.merge_runs(schemas.conform(load(spark, d, "menu_runs"), schemas.CRAWL_RUNS), _crawl_run(spark, d).runs)
    return merged.select("competitor_id", "run_id", "status", "pages_attempted", "pages_succeeded", "error_count")


@query(_run_sql(f"(SELECT *, {_OUTCOME} AS o FROM <<menu_pages>> m WHERE competitor_id IN (SELECT id FROM <<menu_sites>> c WHERE website IS NOT NULL))"))
def price_run_forced(spark, d):
    return _crawl_run(spark, d, force=True).runs.drop("started_at", "completed_at")


@query(f"SELECT competitor_id, page_ord, url, 'RuntimeError' AS code, o AS message FROM {_DUE_PAGES} p WHERE o <> 'ok'")
def run_rows(spark, d):
    return _crawl_run(spark, d).errors.drop("run_id")


@query(f"""SELECT competitor_id, page_ord, final_url, title, SHA256(html) AS content_sha256, competitor_id || '/run_1/' || SHA256(html) || '.html' AS archive_path
    FROM {_DUE_PAGES} p WHERE o = 'ok' AND page_ord IN (SELECT page_ord FROM ({_VALIDATED}) v)""")
def evidence_rows(spark, d):
    return _crawl_run(spark, d).evidence.select("competitor_id", "page_ord", "final_url", "title", "content_sha256", "archive_path")


@query(f"""SELECT 'pages_attempted' AS total, COUNT(*) AS n FROM {_DUE_PAGES} a UNION ALL SELECT 'pages_succeeded', COUNT(*) FILTER (o = 'ok') FROM {_DUE_PAGES} b
    UNION ALL SELECT 'published', COUNT(*) FILTER (review_reason IS NULL) FROM ({_VALIDATED}) c WHERE competitor_id IN {_DUE}
    UNION ALL SELECT 'pending', COUNT(*) FILTER (review_reason IS NOT NULL) FROM ({_VALIDATED}) e WHERE competitor_id IN {_DUE}""")
def run_totals(spark, d):
    totals = _crawl_run(spark, d).totals
    return spark.createDataFrame([(name, n) for name, n in totals.items() if name != "items"], "total string, n long")


# ---------------------------------------------------------------- history

_ORDER = "ORDER BY observed_at, run_id, page_ord, cand_ord"
_SEQ = "STRUCT_PACK(a := observed_at, b := run_id, c := page_ord, d := cand_ord)"


def _published(spark, d):
    return load(spark, d, "obs").where("publication_status = 'published'")


def _in_first_half():
    return F.substring(F.md5("source_fingerprint"), 1, 1) < "8"


def _first_half(rows):
    """Half of the keys, as a table that was stored by an earlier batch."""
    return rows.where(_in_first_half())


def _earliest(rows):
    """Half of the keys with their first observation only, as a table that was stored by an earlier batch."""
    return keep_first(_first_half(rows), ["source_fingerprint"], [F.col(c) for c in history.CRAWL_ORDER], 1)


def _stored(spark, d):
    return schemas.conform(load(spark, d, "stored_offerings"), schemas.OFFERINGS)


@query(f"""SELECT COALESCE(n.competitor_id, o.competitor_id) AS competitor_id, COALESCE(n.offering_key, o.offering_key) AS offering_key,
    CASE WHEN n.competitor_id IS NULL THEN o.amount_min_minor ELSE n.amount_min_minor END AS amount_min_minor,
    COALESCE(n.offering_type, o.offering_type) AS offering_type, COALESCE(n.source_fingerprint, o.source_fingerprint) AS source_fingerprint,
    STRFTIME(COALESCE(o.first_published_at, n.first_at), '%Y-%m-%d') AS first_published,
    STRFTIME(COALESCE(n.last_seen_at, o.last_seen_at), '%Y-%m-%d') AS last_seen
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY competitor_id, offering_key ORDER BY observed_at DESC, run_id DESC, page_ord DESC, cand_ord DESC) AS rn,
                 MIN(observed_at) OVER (PARTITION BY competitor_id, offering_key) AS first_at FROM <<obs>> ob WHERE publication_status = 'published' QUALIFY rn = 1) n
    FULL JOIN <<stored_offerings>> o ON o.competitor_id = n.competitor_id AND o.offering_key = n.offering_key""")
def merge_offering(spark, d):
    read = ["amount_min_minor", "offering_type", "source_fingerprint", "last_seen_at"]
    merged = history.merge_offerings(_stored(spark, d), _published(spark, d), read)
    return merged.select("competitor_id", "offering_key", "amount_min_minor", "offering_type", "source_fingerprint",
                         F.date_format("first_published_at", "yyyy-MM-dd").alias("first_published"),
                         F.date_format("last_seen_at", "yyyy-MM-dd").alias("last_seen"))


_BATCH_OF = "CAST(SUBSTRING(competitor_id, 5) AS INT) % 25 = 3"


@query(f"""SELECT COALESCE(n.competitor_id, o.competitor_id) AS competitor_id, COALESCE(n.offering_key, o.offering_key) AS offering_key,
    CASE WHEN n.competitor_id IS NULL THEN o.amount_min_minor ELSE n.amount_min_minor END AS amount_min_minor,
    COALESCE(n.source_fingerprint, o.source_fingerprint) AS source_fingerprint,
    STRFTIME(COALESCE(o.first_published_at, n.first_at), '%Y-%m-%d') AS first_published
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY competitor_id, offering_key ORDER BY observed_at DESC, run_id DESC, page_ord DESC, cand_ord DESC) AS rn,
                 MIN(observed_at) OVER (PARTITION BY competitor_id, offering_key) AS first_at FROM <<obs>> ob WHERE publication_status = 'published' AND {_BATCH_OF} QUALIFY rn = 1) n
    FULL JOIN <<stored_offerings>> o ON o.competitor_id = n.competitor_id AND o.offering_key = n.offering_key""")
def merge_offering_buckets(spark, d):
    table = BucketTable(spark, f"{shared_folder(spark)}/offerings-{uuid.uuid4().hex}", schemas.OFFERINGS, ("competitor_id",), 64)
    first = table.write(_stored(spark, d))
    batch = cut_lineage(_published(spark, d).where(_BATCH_OF))
    return table.read(history.merge_stored_offerings(table, batch, first)).select(
        "competitor_id", "offering_key", "amount_min_minor", "source_fingerprint", F.date_format("first_published_at", "yyyy-MM-dd").alias("first_published"))


@query(f"""SELECT source_fingerprint, competitor_id, 'pending' AS review_status, MIN_BY(review_reason, {_SEQ}) AS review_reason,
    MIN_BY(offering_key, {_SEQ}) AS offering_key, MAX_BY(evidence_page_id, {_SEQ}) AS evidence_page_id,
    STRFTIME(MIN(observed_at), '%Y-%m-%d') AS first_seen, STRFTIME(MAX(observed_at), '%Y-%m-%d') AS last_seen
    FROM <<obs>> o WHERE publication_status = 'pending' GROUP BY source_fingerprint, competitor_id""")
def merge_candidate(spark, d):
    pending = load(spark, d, "obs").where("publication_status = 'pending'")
    before = history.merge_candidates(schemas.empty(spark, schemas.OFFERING_CANDIDATES), _earliest(pending))
    merged = history.merge_candidates(before, pending)
    return merged.select("source_fingerprint", "competitor_id", "review_status", "review_reason", "offering_key", "evidence_page_id",
                         F.date_format("first_seen_at", "yyyy-MM-dd").alias("first_seen"),
                         F.date_format("last_seen_at", "yyyy-MM-dd").alias("last_seen"))


_ROWS = """SELECT competitor_id, offering_key, offering_type, display_name, amount_min_minor, price_display, source_url, source_fingerprint, observed_at,
      run_id, page_ord, cand_ord, 1 AS seen FROM <<obs>> o WHERE publication_status = 'published'
    UNION ALL SELECT competitor_id, offering_key, offering_type, display_name, amount_min_minor, price_display, source_url, NULL, NULL, NULL, NULL, NULL, 0
      FROM <<stored_offerings>> s"""
_EVENTS = f"""SELECT *, CASE WHEN had IS NULL THEN CASE WHEN offering_type = 'offer' THEN 'competitor_offer_added' ELSE 'competitor_offering_added' END
      WHEN old_price IS DISTINCT FROM price_display OR old_type IS DISTINCT FROM offering_type OR old_amount IS DISTINCT FROM amount_min_minor
      THEN 'competitor_price_changed' END AS event_type
    FROM (SELECT *, LAG(1) OVER w AS had, LAG(price_display) OVER w AS old_price, LAG(offering_type) OVER w AS old_type, LAG(amount_min_minor) OVER w AS old_amount
          FROM ({_ROWS}) r WINDOW w AS (PARTITION BY competitor_id, offering_key ORDER BY seen, observed_at, run_id, page_ord, cand_ord)) l WHERE seen = 1"""


@query(f"""SELECT competitor_id, SHA256(competitor_id || '|' || offering_key) AS offering_id, event_type, offering_key, old_price, price_display AS new_price, run_id, page_ord, cand_ord,
    event_type || ':' || source_fingerprint AS source_fingerprint, STRFTIME(observed_at, '%Y-%m-%d') AS occurred FROM ({_EVENTS}) e WHERE event_type IS NOT NULL""")
def change_events(spark, d):
    return history.change_events(_stored(spark, d), _published(spark, d)).select(
        "competitor_id", "offering_id", "event_type", F.col("detail.offering_key").alias("offering_key"), F.col("detail.old_price").alias("old_price"),
        F.col("detail.new_price").alias("new_price"), "run_id", "page_ord", "cand_ord", "source_fingerprint",
        F.date_format("occurred_at", "yyyy-MM-dd").alias("occurred"))


@query(f"""SELECT event_type || ':' || source_fingerprint AS source_fingerprint, competitor_id, event_type,
    MAX(SHA256(competitor_id || '|' || offering_key)) AS offering_id, MAX_BY(old_price, {_SEQ}) AS old_price, STRFTIME(MAX(observed_at), '%Y-%m-%d') AS occurred
    FROM ({_EVENTS}) e WHERE event_type IS NOT NULL
    GROUP BY source_fingerprint, competitor_id, event_type""")
def merge_event(spark, d):
    log = history.change_events(_stored(spark, d), _published(spark, d))
    last = history.last_events(log, ["old_price"])  # both merges read it
    before = history.merge_events(schemas.empty(spark, schemas.PRICE_EVENTS), where_here(last, _in_first_half()), ["old_price"])
    merged = history.merge_events(before, last, ["old_price"])
    return merged.select("source_fingerprint", "competitor_id", "event_type", "offering_id", F.col("detail.old_price").alias("old_price"),
                         F.date_format("occurred_at", "yyyy-MM-dd").alias("occurred"))


@query("""SELECT 'discovered' AS total, COUNT(*) AS n FROM <<menu_competitors>> c UNION ALL
    SELECT 'enriched', COUNT(*) FROM <<captures>> p UNION ALL SELECT 'crawled', COUNT(*) FROM (SELECT DISTINCT competitor_id FROM <<menu_pages>> m) r""")
def batch_totals(spark, d):
    return runs.batch_totals(load(spark, d, "menu_competitors"), load(spark, d, "captures"), runs.crawl_runs(_judged(spark, d)))
