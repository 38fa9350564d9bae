"""Explicit schemas of the stored tables and landing payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Wide enough for any price that can be stored in hundredths, with room for digits that only decide the rounding.
AMOUNT = T.DecimalType(38, 10)


_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
          "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType()}


def _struct(spec: str, **nested: T.DataType) -> T.StructType:
    """Fields from "name type, ..." without needing a running session; `nested` adds fields of other types at the end."""
    pairs = [item.split() for item in spec.split(",")]
    fields = [T.StructField(name, _TYPES[kind]) for name, kind in pairs]
    return T.StructType(fields + [T.StructField(name, kind) for name, kind in nested.items()])


BUSINESSES = _struct("""
    place_id string, name string, metro string, address string, phone string, website_url string,
    rating double, review_count int, discovered_at timestamp,
    site_fetched_at timestamp, site_fetch_status string, site_platform string, has_ssl int, is_mobile_friendly int,
    booking_checked_at timestamp, has_online_booking int, booking_platform string,
    social_checked_at timestamp, instagram_url string, facebook_url string, social_last_post date, social_status string,
    owner_name string, email string, email_status string,
    scored_at timestamp, deficiency_score int, primary_deficiency string,
    hook_text string, hook_generated_at timestamp, review_status string, notes string
""")

EVENTS = _struct("place_id string, stage string, level string, message string, created_at timestamp")

# One fetched homepage per business (lead flow).
SITE_CAPTURES = _struct("""
    place_id string, https_probe_raised boolean, fetch_error string, http_status int, final_url string, html string
""")

# One fetched page per crawl position (price flow).
PAGE_CAPTURES = _struct("""
    competitor_id string, run_id string, page_ord int, url string, final_url string, html string,
    robots_allowed boolean, http_status int, content_type string, body_bytes bigint, render_mode string,
    captured_at timestamp
""")

COMPETITORS = _struct("""
    id string, place_id string, name string, website string, rating double, review_count int,
    reviews_checked_at timestamp, last_discovered_at timestamp, updated_at timestamp,
    booking_platform string, website_checked_at timestamp, ig_handle string
""")
COMPETITOR_MARKETS = _struct("competitor_id string, metro_key string, metro string, last_seen_at timestamp")
MARKET_SCRAPES = _struct("""
    metro_key string, metro string, last_status string, last_completed_at timestamp, last_error string,
    updated_at timestamp
""")
CRAWL_RUNS = _struct("""
    competitor_id string, run_id string, status string, started_at timestamp, completed_at timestamp,
    pages_attempted bigint, pages_succeeded bigint, error_count bigint
""")
LOCATIONS = _struct("tenant_id string, metro string, is_primary boolean")
SERVICE_CATALOG = _struct("id string, name string")
SERVICE_ALIASES = _struct("raw_name_key string, service_catalog_id string")

_OFFERING_FACTS = """
    competitor_id string, evidence_page_id string, offering_key string, offering_type string, display_name string,
    qualifier string, service_catalog_id string, price_type string, amount_min_minor bigint, amount_max_minor bigint,
    currency string, price_unit string, package_quantity int, original_amount_minor bigint, valid_from date,
    valid_through date, price_display string, source_url string, evidence_text string, source_fingerprint string,
    last_seen_at timestamp
"""
OFFERINGS = _struct("id string, " + _OFFERING_FACTS + ", first_published_at timestamp, updated_at timestamp")
OFFERING_CANDIDATES = _struct(
    _OFFERING_FACTS + ", review_status string, review_reason string, first_seen_at timestamp")
OFFERING_COLUMNS = _struct(_OFFERING_FACTS).fieldNames()

EVENT_DETAIL = _struct("""
    offering_key string, display_name string, qualifier string, old_price string, new_price string, source_url string
""")
PRICE_EVENTS = _struct("competitor_id string, offering_id string, event_type string, occurred_at timestamp, source_fingerprint string",
                       detail=EVENT_DETAIL)

SEARCH_PAYLOAD = _struct("metro string, query_ord int, status string, error_message string", results=T.ArrayType(
    _struct("place_id string, name string, formatted_address string, rating double, user_ratings_total int")))
DETAILS_PAYLOAD = _struct("place_id string, status string",
                          result=_struct("formatted_phone_number string, website string"))


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A table without rows, in a form in which Spark knows it, so that a merge into it needs no join and its result stays dealt by key."""
    columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields)
    return spark.sql(f"SELECT {columns} FROM VALUES (0) LIMIT 0")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of `schema`, in order, cast; missing ones become NULL."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])
