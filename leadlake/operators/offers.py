"""Offering candidates of captured pages: JSON-LD offers first, then visible price rows, in document order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlake.constants import OFFERING_NAME
from leadlake.functions.prices import parse_rows
from leadlake.functions.text import collapse_spaces, normalize_label, strip_space
from leadlake.schemas import AMOUNT

# Position of a candidate on its page: JSON-LD before visible rows.
_ROWS_AFTER = 1_000_000_000


_OFFER = "struct<name:string,price:string,shown_currency:string,currency:string>"
_NUMBER = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$"


def named_offers(found: Column) -> Column:
    """Offers of JSON-LD nodes that have a name and a price in digits, from their members as written.

    The node's name goes before the offer's own, a price before a lowest price. A currency that is missing is the dollar.
    """
    def filled(value: Column) -> Column:
        return F.when(value.filled, value.text)

    read = F.transform(found, lambda o: F.struct(
        strip_space(F.coalesce(filled(o.node_name), filled(o.offer_name), F.lit(""))).alias("name"),
        F.coalesce(filled(o.price), o.low_price.text).alias("price"),
        F.when(o.currency.isNull(), "USD").otherwise(F.coalesce(o.currency.text, F.lit("None"))).alias("shown_currency"),
        F.upper(F.coalesce(filled(o.currency), F.lit("USD"))).alias("currency")))
    return F.filter(read, lambda o: (o["name"] != "") & F.coalesce(o.price.rlike(_NUMBER), F.lit(False)))


def page_items(pages: DataFrame, keep: list[str]) -> DataFrame:
    """Per page, one array `items` of structured offers and price-row texts. Needs `parts` and final_url.

    Both kinds share one array, so the page is parsed once and nothing is unioned.
    """
    items = F.concat(
        F.transform(F.coalesce(named_offers(F.col("parts.offers")), F.array()), lambda o, i: F.struct(
            i.cast("long").alias("cand_ord"), o.alias("offer"), F.lit(None).cast("string").alias("row_text"))),
        F.transform(F.coalesce("parts.rows", F.array()), lambda t, i: F.struct(
            (i + _ROWS_AFTER).cast("long").alias("cand_ord"), F.lit(None).cast(_OFFER).alias("offer"), t.alias("row_text"))),
    )
    return pages.select(*keep, F.col("final_url").alias("source_url"), items.alias("items"))


def has_candidates() -> Column:
    """True when the page offers anything at all, told from the page row alone. Needs `parts`."""
    return (F.size(named_offers(F.col("parts.offers"))) > 0) | F.exists(F.coalesce("parts.rows", F.array()), lambda row: collapse_spaces(row).rlike(OFFERING_NAME))


def candidates(paged: DataFrame, keep: list[str], parity: bool = False) -> DataFrame:
    """All candidates of page items, with `cand_ord`, before dedupe."""
    # The outer explode keeps Spark from inferring a filter on the array, which would parse every page a second time.
    exploded = paged.select(*keep, "source_url", F.explode_outer("items").alias("item")).where("item IS NOT NULL").select(
        *keep, "source_url", "item.*")
    structured = F.col("offer").isNotNull()
    parsed = parse_rows(exploded, "row_text", parity, exempt=structured)
    shown = F.concat(F.col("offer.shown_currency"), F.lit(" "), F.col("offer.price"))
    amount = F.col("offer.price").try_cast(AMOUNT)
    from_offer = {
        "offering_type": F.lit("service"), "display_name": F.col("offer.name"), "price_type": F.lit("fixed"),
        "amount_min": amount, "amount_max": F.lit(None), "currency": F.col("offer.currency"),
        "price_unit": F.lit("total"), "package_quantity": F.lit(None), "original_amount": F.lit(None),
        "valid_through": F.lit(None), "price_display": shown,
        "evidence_text": F.concat(F.col("offer.name"), F.lit(" "), shown),
    }
    return parsed.withColumns({
        **{name: F.when(structured, value).otherwise(F.col(name)) for name, value in from_offer.items()},
    }).withColumn("structured", structured).drop("offer")


def dedupe_candidates(found: DataFrame, page_keys: list[str]) -> DataFrame:
    """First candidate per (normalized name, shown price) on a page; structured offers are all kept.

    A group lies within one page, so its size is bounded by the page size limit.
    """
    named = found.withColumn("normalized_name", normalize_label(F.col("display_name")))
    same = Window.partitionBy(*page_keys, "normalized_name", "price_display").orderBy("cand_ord")
    return named.withColumn("_rank", F.row_number().over(same)).where(
        F.col("structured") | (F.col("_rank") == 1)).drop("_rank")
