"""Flow inputs derived from the star-schema tables.

Each input is one SELECT in the dialect both Spark and other SQL engines read, so a result can be checked elsewhere on the
very same rows. `<<name>>` stands for a base table or another input.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
               "pages", "benchmark", "labels", "conversations"]

INPUTS: dict[str, str] = {}

# Businesses in every state of enrichment: each flag takes 0, 1 and NULL.
INPUTS["biz"] = """
SELECT 'place_' || CAST(c_custkey AS STRING) AS place_id,
       'Studio ' || CAST(c_custkey AS STRING) || CASE c_custkey % 8 WHEN 0 THEN ' Med Spa' WHEN 1 THEN ' Inc'
            WHEN 2 THEN ' Medical Spa' WHEN 3 THEN ' Spa LLC' WHEN 4 THEN ' Facials, Peels & Day Spa' WHEN 5 THEN ' Corp'
            WHEN 6 THEN '' ELSE ' Aesthetics' END AS name,
       n_name || CASE n_regionkey WHEN 0 THEN ', IL' WHEN 1 THEN ', WI' WHEN 2 THEN ', MN' WHEN 3 THEN ', TX' ELSE '' END AS metro,
       CAST(c_custkey AS STRING) || ' Main St' AS address,
       CASE WHEN c_custkey % 3 <> 0 THEN '+1-312-555-' || LPAD(CAST(c_custkey % 10000 AS STRING), 4, '0') END AS phone,
       CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'https://facebook.com/biz' || CAST(c_custkey AS STRING)
            WHEN 2 THEN 'https://linktr.ee/biz' || CAST(c_custkey AS STRING)
            WHEN 3 THEN 'http://shop' || CAST(c_custkey AS STRING) || '.example.com'
            WHEN 4 THEN 'https://www.shop' || CAST(c_custkey AS STRING) || '.example.com/home?x=1'
            ELSE 'https://shop' || CAST(c_custkey % 100 AS STRING) || '.example.org/' END AS website_url,
       CAST(c_custkey % 21 AS DOUBLE) / 10 + 3 AS rating,
       CASE WHEN c_custkey % 11 <> 0 THEN CAST(c_custkey * 37 % 400 AS INT) END AS review_count,
       TIMESTAMP '2026-01-01 00:00:00' AS discovered_at,
       CASE WHEN c_custkey % 2 = 0 THEN TIMESTAMP '2026-01-02 00:00:00' END AS site_fetched_at,
       CASE WHEN c_custkey % 2 = 0 THEN 'ok' END AS site_fetch_status,
       CASE c_custkey % 6 WHEN 0 THEN 'none' WHEN 1 THEN 'facebook' WHEN 2 THEN 'linktree' ELSE
            CASE c_custkey % 5 WHEN 0 THEN 'wix' WHEN 1 THEN 'wordpress' WHEN 2 THEN 'custom' WHEN 3 THEN 'unknown' END
       END AS site_platform,
       CASE c_custkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 END AS has_ssl,
       CASE c_custkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 1 END AS is_mobile_friendly,
       CASE WHEN c_custkey % 5 < 4 THEN TIMESTAMP '2026-01-02 00:00:00' END AS booking_checked_at,
       CASE c_custkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 1 END AS has_online_booking,
       CASE c_custkey % 5 WHEN 2 THEN 'vagaro' WHEN 3 THEN 'other' END AS booking_platform,
       CASE WHEN c_custkey % 7 < 4 THEN TIMESTAMP '2026-01-02 00:00:00' END AS social_checked_at,
       CASE c_custkey % 7 WHEN 0 THEN 'dormant' WHEN 1 THEN 'none' WHEN 2 THEN 'unknown' WHEN 3 THEN 'active' END AS social_status,
       CASE WHEN c_custkey % 4 = 1 THEN 'info' || CAST(c_custkey AS STRING) || '@example.com' END AS email,
       CASE c_custkey % 4 WHEN 1 THEN 'verified' WHEN 2 THEN 'not_found' ELSE 'not_attempted' END AS email_status,
       CASE WHEN c_custkey % 9 = 0 THEN 'old line' END AS hook_text,
       CASE WHEN c_custkey % 9 = 0 THEN TIMESTAMP '2026-01-03 00:00:00' END AS hook_generated_at,
       CASE WHEN c_custkey % 10 = 0 THEN 'approved' ELSE 'new' END AS review_status
FROM <<customer>> JOIN <<nation>> ON c_nationkey = n_nationkey
"""

# Newly discovered businesses: nothing enriched yet.
INPUTS["fresh_biz"] = """
SELECT place_id, name, metro, address, phone, website_url, rating, review_count, discovered_at,
       CAST(NULL AS STRING) AS email, 'not_attempted' AS email_status, 'new' AS review_status
FROM <<biz>>
"""

# Homepages of some businesses: the raw page plus one signal, in rotation.
INPUTS["captures"] = """
SELECT page_id, 'place_' || CAST(page_id AS STRING) AS place_id, url, url AS final_url, page_id % 4 = 1 AS https_probe_raised,
       CASE page_id % 17 WHEN 3 THEN 'timeout' WHEN 5 THEN 'tls' WHEN 7 THEN 'other' END AS fetch_error,
       CASE WHEN page_id % 13 = 6 THEN 404 ELSE 200 END AS http_status,
       html || CASE page_id % 14
         WHEN 0 THEN '<script src="https://www.vagaro.com/widget.js"></script>'
         WHEN 1 THEN '<a href="https://clients.mindbodyonline.com/x">Reserve now</a>'
         WHEN 2 THEN '<a href="/appointments">Appointments</a>'
         WHEN 3 THEN '<button type="button">Schedule online</button>'
         WHEN 4 THEN '<input type="submit" value="Book">'
         WHEN 5 THEN '<meta name="viewport" content="width=device-width, initial-scale=1"><link rel="stylesheet" href="/wp-content/a.css">'
         WHEN 6 THEN '<a href="mailto:info' || CAST(page_id AS STRING) || '@example.com?subject=hi">Mail</a><a href="/contact">Contact</a>'
         WHEN 7 THEN '<a href="https://www.instagram.com/glow' || CAST(page_id AS STRING) || '/">Photos</a><a href="https://www.facebook.com/glow">News</a>'
         WHEN 8 THEN '<a href="https://www.facebook.com/sharer?u=x">Share</a><a href="https://facebook.com/p' || CAST(page_id AS STRING) || '">News</a><p>Write to desk' || CAST(page_id AS STRING) || '@example.org today</p>'
         WHEN 9 THEN '<a href="https://instagram.com/a?via=facebook.com">A</a><a href="https://instagram.com/b">B</a><div id="ROOT"></div><div id="root"></div>'
         WHEN 10 THEN '<meta name="viewport" content="width=1024"><meta name="viewport" content="initial-scale=1"><script src="//static.wixpress.com/a.js"></script>'
         WHEN 11 THEN '<a href="/contact-form">Contact</a><a href="https://www.example.net/get-in-touch">Get in touch</a><img src="https://cdn.shopify.com/x.png">'
         WHEN 12 THEN '<a href="/services/facials?utm_source=x">Facial services and prices</a><a href="/menu">Menu</a><a href="https://squareup.com/appointments/x">Square</a>'
         ELSE '' END AS html
FROM <<pages>>
"""

# Menu rows in many shapes, one page each.
INPUTS["menu"] = """
SELECT p_partkey, 'cmp_' || CAST(p_partkey % 200 AS STRING) AS competitor_id, 'run_1' AS run_id,
       CAST(p_partkey AS INT) AS page_ord, 'Studio ' || CAST(p_partkey % 200 AS STRING) AS business_name,
       CASE WHEN p_partkey % 9 = 0 THEN 'https://www.booksy.com/studio/' || CAST(p_partkey AS STRING)
            ELSE 'https://shop' || CAST(p_partkey % 200 AS STRING) || '.example.com/menu/' || CAST(p_partkey AS STRING) END AS final_url,
       'Prices' || CASE WHEN p_partkey % 18 = 0 THEN ' of Studio ' || CAST(p_partkey % 200 AS STRING) ELSE '' END AS title,
       CASE p_partkey % 13
         WHEN 0 THEN p_name || ' - $' || price || ' per session'
         WHEN 1 THEN p_name || ' - From $' || price || ' per unit'
         WHEN 2 THEN p_name || ' - $' || price || ' - $' || more || ' per session'
         WHEN 3 THEN p_name || ': was $' || more || ', now $' || price || ' valid through August 31, 2026'
         WHEN 4 THEN p_name || ' Package: 3 sessions - $' || price || ' package'
         WHEN 5 THEN p_name || ' Membership - $' || price || '/month'
         WHEN 6 THEN p_name || ' Special - $' || price || ', valid until 2026-08-31'
         WHEN 7 THEN p_name || ' - CAD ' || price || ' ($' || price || ')'
         WHEN 8 THEN p_name || ' starting at $1,' || LPAD(CAST(p_partkey % 1000 AS STRING), 3, '0') || '.50'
         WHEN 9 THEN CAST(p_partkey AS STRING) || ' $' || price
         WHEN 10 THEN 'Anti-Aging ' || p_name || ' - $' || price
         WHEN 11 THEN p_name || ' - price on request ($)'
         ELSE p_name || ' & more - $' || price || ' until February 30, 2026' END AS row_text
FROM (SELECT p_partkey, p_name, CAST(CAST(p_retailprice AS DECIMAL(10, 2)) AS STRING) AS price,
             CAST(CAST(p_retailprice AS DECIMAL(10, 2)) + 50 AS STRING) AS more FROM <<part>>) p
"""

INPUTS["menu_pages"] = """
SELECT p_partkey, competitor_id, run_id, page_ord, business_name, final_url AS url, final_url, title, row_text,
       '<!doctype html><html><head><title>' || title || '</title></head><body><ul><li>' || REPLACE(row_text, '&', '&amp;')
         || '</li></ul>' || CASE WHEN p_partkey % 4 = 0 THEN '<script type="application/ld+json">{"@graph":[{"@type":"Product","name":"Kit '
         || CAST(p_partkey % 7 AS STRING) || '","offers":[{"@type":"Offer","price":"' || CAST(p_partkey % 300 AS STRING)
         || '.5","priceCurrency":"usd"},{"lowPrice":' || CAST(p_partkey % 300 AS STRING) || '},{"price":"ask"}]}]}</script>' ELSE '' END
         || '</body></html>' AS html,
       CASE WHEN p_partkey % 23 = 0 THEN false WHEN p_partkey % 5 = 0 THEN true END AS robots_allowed,
       CASE WHEN p_partkey % 29 = 0 THEN 503 WHEN p_partkey % 31 = 0 THEN 404 ELSE 200 END AS http_status,
       CASE WHEN p_partkey % 19 = 0 THEN 'application/pdf' WHEN p_partkey % 2 = 0 THEN 'text/html' ELSE 'Text/HTML; charset=utf-8' END AS content_type,
       CAST(CASE WHEN p_partkey % 37 = 0 THEN 5242881 ELSE 5242880 END AS BIGINT) AS body_bytes, 'http' AS render_mode,
       TIMESTAMP '2026-02-01 00:00:00' AS captured_at
FROM <<menu>>
"""

# One signature per part, as its menu page may show it; cut ones are beginnings of others, so that several match one page.
INPUTS["signatures"] = """
SELECT 'platform_' || CAST(p_partkey AS STRING) AS platform, LOWER(p_name || ' - $' || LEFT(price, LENGTH(price) - p_partkey % 4)) AS signature,
       CAST(p_partkey % 7 AS BIGINT) AS priority
FROM (SELECT p_partkey, p_name, CAST(CAST(p_retailprice AS DECIMAL(10, 2)) AS STRING) AS price FROM <<part>>) p
"""

# Pages of very little or of enough text, some of them application shells.
INPUTS["shells"] = """
SELECT p_partkey, row_text, final_url,
       '<html><body>' || CASE WHEN p_partkey % 3 <> 0 THEN '<p>' || REPEAT('care ', 50) || '</p>' ELSE '' END
         || CASE WHEN p_partkey % 4 < 2 THEN '<div ID="root"></div>' ELSE '' END
         || CASE WHEN p_partkey % 5 < 3 THEN '<ul><li>' || REPLACE(row_text, '&', '&amp;') || '</li></ul>' ELSE '' END || '</body></html>' AS html
FROM <<menu>>
"""

INPUTS["menu_competitors"] = """
SELECT DISTINCT competitor_id AS id, business_name AS name,
       CASE WHEN p_partkey % 200 % 3 = 0 THEN 'Chicago, IL' WHEN p_partkey % 200 % 3 = 1 THEN 'Chicago' END AS market
FROM <<menu>>
"""
# Sites of competitors, some without; and their runs so far: fresh, stale, failed, and never ended.
INPUTS["menu_sites"] = """
SELECT id, name, market, CASE WHEN CAST(SUBSTRING(id, 5) AS INT) % 13 <> 4 THEN 'https://shop' || SUBSTRING(id, 5) || '.example.com/' END AS website FROM <<menu_competitors>>
"""
INPUTS["menu_runs"] = """
SELECT id AS competitor_id, 'run_0' AS run_id, CASE CAST(SUBSTRING(id, 5) AS INT) % 5 WHEN 0 THEN 'complete' WHEN 1 THEN 'partial' WHEN 2 THEN 'failed' ELSE 'processing' END AS status,
       TIMESTAMP '2024-01-20 00:00:00' AS started_at,
       CASE WHEN CAST(SUBSTRING(id, 5) AS INT) % 5 < 3 THEN CASE WHEN CAST(SUBSTRING(id, 5) AS INT) % 2 = 0 THEN TIMESTAMP '2024-02-04 00:00:00' ELSE TIMESTAMP '2024-01-20 01:00:00' END END AS completed_at,
       CAST(3 AS BIGINT) AS pages_attempted, CAST(2 AS BIGINT) AS pages_succeeded, CAST(1 AS BIGINT) AS error_count
FROM <<menu_competitors>>
"""
INPUTS["aliases"] = """
SELECT 'small ring' AS raw_name_key, 'svc_a' AS service_catalog_id
UNION ALL SELECT p_name AS raw_name_key, 'svc_b' AS service_catalog_id FROM <<part>> WHERE p_partkey % 40 = 11 GROUP BY p_name
"""
INPUTS["catalog"] = """
SELECT 'cat_' || p_name AS id, UPPER(p_name) AS name FROM <<part>> WHERE p_partkey % 10 = 5 GROUP BY p_name
"""

# Priced observations over time, one competitor per supplier and one offering per part.
INPUTS["obs"] = """
SELECT 'cmp_' || CAST(l_suppkey AS STRING) AS competitor_id, 'service:part ' || CAST(l_partkey AS STRING) || ':base:total:0' AS offering_key,
       CASE WHEN l_partkey % 10 = 0 THEN 'offer' ELSE 'service' END AS offering_type, 'part ' || CAST(l_partkey AS STRING) AS display_name,
       CAST(NULL AS STRING) AS qualifier, CAST(NULL AS STRING) AS service_catalog_id, 'fixed' AS price_type,
       CAST(CAST(l_extendedprice AS DECIMAL(14, 2)) * 100 AS BIGINT) AS amount_min_minor, CAST(NULL AS BIGINT) AS amount_max_minor,
       'USD' AS currency, 'total' AS price_unit, CAST(NULL AS INT) AS package_quantity, CAST(NULL AS BIGINT) AS original_amount_minor,
       CAST(NULL AS DATE) AS valid_from, CAST(NULL AS DATE) AS valid_through,
       '$' || CAST(CAST(l_extendedprice AS DECIMAL(14, 2)) AS STRING) AS price_display,
       'https://shop' || CAST(l_suppkey AS STRING) || '.example.com/' AS source_url,
       'part ' || CAST(l_partkey AS STRING) AS evidence_text,
       MD5(CAST(l_suppkey AS STRING) || '|' || CAST(l_partkey AS STRING) || '|' || CAST(CAST(l_extendedprice AS DECIMAL(14, 2)) AS STRING)) AS source_fingerprint,
       'page_' || CAST(l_orderkey AS STRING) AS evidence_page_id, 'run_' || CAST(l_orderkey AS STRING) AS run_id,
       o_orderdate AS observed_at, o_orderdate AS last_seen_at, CAST(l_orderkey AS BIGINT) AS page_ord, CAST(l_linenumber AS BIGINT) AS cand_ord,
       CASE WHEN l_returnflag = 'R' THEN 'pending' ELSE 'published' END AS publication_status,
       CASE WHEN l_returnflag = 'R' THEN 'unknown_currency' END AS review_reason
FROM (SELECT l_suppkey, l_partkey, l_orderkey, l_linenumber, MIN(l_extendedprice) AS l_extendedprice, MIN(l_returnflag) AS l_returnflag
      FROM <<lineitem>> GROUP BY l_suppkey, l_partkey, l_orderkey, l_linenumber) l
JOIN <<orders>> ON l_orderkey = o_orderkey
"""
# Stored offerings: one per (competitor, offering), from before every observation.
INPUTS["stored_offerings"] = """
SELECT competitor_id, offering_key, 'service' AS offering_type, display_name, qualifier, service_catalog_id, price_type,
       MIN(amount_min_minor) AS amount_min_minor, amount_max_minor, currency, price_unit, package_quantity, original_amount_minor,
       valid_from, valid_through, MIN(price_display) AS price_display, source_url, evidence_text, 'stored' AS source_fingerprint,
       'page_old' AS evidence_page_id, TIMESTAMP '1990-01-01 00:00:00' AS last_seen_at,
       TIMESTAMP '1989-01-01 00:00:00' AS first_published_at, TIMESTAMP '1990-01-01 00:00:00' AS updated_at
FROM <<obs>> WHERE display_name LIKE '%7'
GROUP BY competitor_id, offering_key, display_name, qualifier, service_catalog_id, price_type, amount_max_minor, currency, price_unit,
         package_quantity, original_amount_minor, valid_from, valid_through, source_url, evidence_text
"""

INPUTS["locations"] = """
SELECT 'tenant_' || LPAD(CAST(s_suppkey AS STRING), 8, '0') AS tenant_id,
       CASE WHEN s_suppkey % 23 = 5 THEN '   ' WHEN s_suppkey % 23 = 6 THEN NULL WHEN s_suppkey % 3 = 0 THEN UPPER(n_name) || ',  IL'
            WHEN s_suppkey % 3 = 1 THEN '  ' || LOWER(n_name) || ', IL ' ELSE n_name || ', Il' END AS metro,
       s_suppkey % 8 <> 7 AS is_primary
FROM <<supplier>> JOIN <<nation>> ON s_nationkey = n_nationkey
"""

INPUTS["runs"] = """
SELECT 'cmp_' || CAST(user_id AS STRING) AS competitor_id, 'run_' || CAST(event_id AS STRING) AS run_id,
       CASE event_type WHEN 'purchase' THEN 'complete' WHEN 'signup' THEN 'partial' WHEN 'error' THEN 'failed' ELSE 'processing' END AS status,
       CASE WHEN event_id % 50 <> 0 THEN ts END AS completed_at
FROM <<events>>
"""
INPUTS["scrapes"] = """
SELECT LOWER(n_name) || ', il' AS metro_key, n_name || ', IL' AS metro, CASE n_nationkey % 4 WHEN 0 THEN 'partial' ELSE 'complete' END AS last_status,
       CASE n_nationkey % 4 WHEN 0 THEN NULL WHEN 1 THEN TIMESTAMP '2024-02-04 00:00:00' WHEN 2 THEN TIMESTAMP '2024-01-29 00:00:00'
            ELSE TIMESTAMP '2024-01-29 00:00:01' END AS last_completed_at,
       CASE n_nationkey % 4 WHEN 0 THEN 'old error' END AS last_error, TIMESTAMP '2024-02-04 00:00:00' AS updated_at
FROM <<nation>>
"""

# Search answers: two places per answer, the same place in several queries.
INPUTS["search"] = """
SELECT n_name || ', IL' AS metro, CAST(c_custkey AS INT) AS query_ord, c_custkey,
       CASE c_custkey % 40 WHEN 7 THEN 'OVER_QUERY_LIMIT' WHEN 9 THEN 'ZERO_RESULTS' ELSE 'OK' END AS status,
       CASE c_custkey % 80 WHEN 7 THEN 'quota' END AS error_message
FROM <<customer>> JOIN <<nation>> ON c_nationkey = n_nationkey
"""
INPUTS["search_places"] = """
SELECT LOWER(metro) AS metro_key, metro, query_ord, CAST(c_custkey AS INT) AS result_ord, 'place_' || CAST(c_custkey * 7 % 1000 AS STRING) AS place_id,
       'Place ' || CAST(c_custkey AS STRING) AS name, CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_custkey AS STRING) || ' Oak St' END AS address,
       CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey % 50 AS DOUBLE) / 10 END AS rating,
       CASE WHEN c_custkey % 6 <> 0 THEN CAST(c_custkey % 400 AS INT) END AS review_count
FROM <<search>> WHERE status = 'OK'
"""
INPUTS["stored_places"] = """
SELECT 'place_' || CAST(s_suppkey * 3 AS STRING) AS place_id, 'Old ' || CAST(s_suppkey AS STRING) AS name, 'NATION_0, IL' AS metro,
       'old address' AS address, CASE WHEN s_suppkey % 2 = 0 THEN 'old phone' END AS phone,
       CASE WHEN s_suppkey % 3 = 0 THEN 'https://old.example.com/' END AS website_url, 4.0 + 0 * CAST(s_suppkey AS DOUBLE) AS rating,
       CAST(s_suppkey AS INT) AS review_count, TIMESTAMP '2025-01-01 00:00:00' AS discovered_at, 'wix' AS site_platform,
       'verified' AS email_status, 'approved' AS review_status
FROM <<supplier>>
"""
INPUTS["sitemaps"] = """
SELECT page_id AS site_id, url AS final_url,
       '<urlset><url><loc> ' || url || ' </loc></url><url><LOC>https://other.example.net/pricing</LOC></url><url><loc>'
         || REGEXP_EXTRACT(url, '^([a-z]+://[^/?#]+)', 1) || '/treatments/' || CAST(page_id % 5 AS STRING) || '?fbclid=1&b=2</loc></url></urlset>' AS xml
FROM <<pages>>
"""
# Hosts below a plain suffix, below a wildcard with an exception, and below neither.
INPUTS["zone_hosts"] = """
SELECT page_id, 'a' || CAST(page_id % 5 AS STRING) || '.b' || CAST(page_id % 7 AS STRING) || '.zone' || CAST(page_id % 4 AS STRING) || '.test' AS host FROM <<pages>>
"""
INPUTS["finder"] = """
SELECT 'shop' || CAST(k AS STRING) || '.example.org' AS domain, CASE WHEN k % 3 <> 0 THEN 'found' || CAST(k AS STRING) || '@example.org' END AS email,
       CASE k % 3 WHEN 0 THEN 'not_found' WHEN 1 THEN 'guessed' ELSE 'verified' END AS status
FROM (SELECT DISTINCT c_custkey % 90 AS k FROM <<customer>>) c
"""

# Tables whose rows are dealt by the key on which an input joins them, so that the grouping by more keys before it needs no shuffle of its own.
DEALT = {"obs": {"lineitem": "l_orderkey"}}


def sql_text(text: str, names=lambda name: name) -> str:
    """Expand inputs to subqueries and base tables to names; plain SQL for another engine."""
    def expand(match: re.Match) -> str:
        name = match.group(1)
        return f"({sql_text(INPUTS[name], names)})" if name in INPUTS else names(name)

    return re.sub(r"<<(\w+)>>", expand, text)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table, or an input derived from base tables, of one data folder."""
    if name in BASE_TABLES:
        return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    spark_text = INPUTS[name]
    needed = {n: load(spark, sf_dir, n) for n in dict.fromkeys(re.findall(r"<<(\w+)>>", spark_text))}
    needed |= {n: needed[n].repartition(key) for n, key in DEALT.get(name, {}).items()}
    # Braces are the placeholder syntax of spark.sql, so literal ones are doubled.
    spark_text = spark_text.replace("{", "{{").replace("}", "}}")
    spark_text = re.sub(r"<<(\w+)>>", r"{\1}", spark_text)
    return spark.sql(spark_text, **needed)
