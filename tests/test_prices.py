"""Price grammar, JSON-LD offers, publication policy."""

import re
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from leadlake.functions.prices import minor_units, parse_rows
from leadlake.operators import offers, publish
from leadlake.sources.captures import with_page_parts


def parse(spark, texts, parity=False):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return {r.i: r for r in parse_rows(df, "t", parity).collect()}


FIELDS = ("offering_type", "display_name", "price_type", "amount_min", "amount_max", "price_unit")
ROWS = {
    "Brow tint: $18.50": ("service", "Brow tint", "fixed", Decimal("18.5"), None, "total"),
    "Scalp facial | starting at $64 /session": ("service", "Scalp facial", "from", Decimal(64), None, "session"),
    "Leg vein laser - $310 to $1,275": ("service", "Leg vein laser", "range", Decimal(310), Decimal(1275), "total"),
    "Collagen drip – $7.25/unit": ("service", "Collagen drip", "fixed", Decimal("7.25"), None, "unit"),
    "Gold membership - $2150/month": ("membership", "Gold membership", "fixed", Decimal(2150), None, "month"),
    "Bridal package - $940, 4 treatments": ("package", "Bridal package", "fixed", Decimal(940), None, "package"),
    "Autumn special - $33": ("offer", "Autumn special", "fixed", Decimal(33), None, "total"),
    "Consultation - $0": ("service", "Consultation", "fixed", Decimal(0), None, None),
    "Nail art - £15 ($21)": ("service", "Nail art", "fixed", Decimal(15), None, "total"),
    "Estate - $1234567890123.45": ("service", "Estate", "fixed", Decimal("1234567890123.45"), None, "total"),
    "Moon - $" + "9" * 40: ("service", "Moon", "fixed", None, None, "total"),
    "Tanning - call us": ("service", "Tanning", "none", None, None, None),
}


def test_menu_rows(spark):
    got = parse(spark, list(ROWS))
    assert [tuple(got[i][f] for f in FIELDS) for i in range(len(ROWS))] == list(ROWS.values())
    assert got[5].package_quantity == 4 and got[8].currency is None and got[0].currency == "USD"


def test_rows_without_a_name_are_left_out(spark):
    assert parse(spark, ["$5 off", "7 wonders $70", "€9 - $4"]) == {}


@pytest.mark.parametrize(("text", "until", "shown"), [
    ("Cupping - $58 until March 9, 2031", date(2031, 3, 9), "$58"), ("Cupping - $58 through 2031-03-09", date(2031, 3, 9), "$58"),
    ("Cupping - $58 until February 31, 2031", None, "$58"), ("Cupping: was $77.10 and is now $61 until May 4 2030", date(2030, 5, 4), "now $61")])
def test_dates_and_reductions(spark, text, until, shown):
    row = parse(spark, [text])[0]
    assert (row.valid_through, row.price_display) == (until, shown)
    if "was" in text:
        assert (row.original_amount, row.amount_min) == (Decimal("77.1"), Decimal(61))


def test_parity_switch_keeps_the_narrow_amount_rule(spark):
    assert parse(spark, ["Tint - $4381"], parity=True)[0].amount_min == Decimal(438)
    assert parse(spark, ["Tint - $4,381.75"], parity=True)[0].amount_min == Decimal("4381.75")


def test_minor_units_round_half_even(spark):
    df = spark.createDataFrame([(Decimal("0.125"),), (Decimal("0.135"),), (None,), (Decimal("0.1250000001"),), (Decimal("1" + "0" * 27),)], "a decimal(38,10)")
    assert [r.m for r in df.select(minor_units(F.col("a")).alias("m")).collect()] == [12, 14, None, 13, None]


def found(spark, html):
    df = spark.createDataFrame([(1, "https://x.example.com/p", html)], "page_id int, final_url string, html string")
    return offers.candidates(offers.page_items(with_page_parts(df), ["page_id"]), ["page_id"])


def script(payload):
    return f'<script type="application/ld+json">{payload}</script>'


@pytest.mark.parametrize(("payload", "rows"), [
    ('{"name": "Sugaring", "offers": [{"price": "44.10", "priceCurrency": "cad"}, {"lowPrice": 9.5}, {"price": 0}, "x", {"price": "1,2"}]}',
     [("Sugaring", Decimal("44.1"), "CAD", "cad 44.10"), ("Sugaring", Decimal("9.5"), "USD", "USD 9.5")]),
    ('[[{"k": {"@type": "Offer", "name": " Steam \\n", "price": 71, "priceCurrency": null}}], {"@type": "Offer", "price": 5}]',
     [("Steam", Decimal(71), "USD", "None 71")]),
    ('{"name": "", "offers": {"name": "Own", "price": 0, "lowPrice": "3e1"}}', [("Own", Decimal(30), "USD", "USD 3e1")]),
    ('{"name": "Island", "offers": {"price": "123456789012345678901234567890123456789"}}', [("Island", None, "USD", "USD 123456789012345678901234567890123456789")]),
    ('{"name": "Yacht", "offers": {"price": 1234567890123}}', [("Yacht", Decimal(1234567890123), "USD", "USD 1234567890123")]),
    ('{"name": "Odd", "offers": {"price": NaN}}', []), ("{broken", []), ('"text"', [])])
def test_structured_offers(spark, payload, rows):
    got = found(spark, script(payload)).orderBy("cand_ord").collect()
    assert [(r.display_name, r.amount_min, r.currency, r.price_display) for r in got] == rows
    assert [(r.cand_ord, r.price_type, r.price_unit) for r in got] == [(i, "fixed", "total") for i in range(len(rows))]


def test_candidates_come_in_page_order_and_repeat_once(spark):
    html = ('<ul><li>Threading: $14</li><li>Henna | $27.50</li><li>THREADING: $14</li><li>Threading: $16</li></ul>'
            + script('[{"@type":"Offer","name":"Oil","price":8},{"@type":"Offer","name":"oil","price":8}]'))
    rows = offers.dedupe_candidates(found(spark, html), ["page_id"]).orderBy("cand_ord").collect()
    assert [(r.display_name, r.price_display) for r in rows] == [
        ("Oil", "USD 8"), ("oil", "USD 8"), ("Threading", "$14"), ("Henna", "$27.50"), ("Threading", "$16")]


SCHEMA = ("competitor_id string, run_id string, page_ord int, cand_ord long, market string, branded boolean, service_catalog_id string, offering_type string, "
          "display_name string, normalized_name string, qualifier string, price_type string, amount_min decimal(38,10), amount_max decimal(38,10), "
          "currency string, price_unit string, package_quantity int, original_amount decimal(38,10), valid_from date, valid_through date, "
          "price_display string, evidence_text string, source_url string")


def candidate(place, name, shown, amount, **changes):
    """A candidate whose evidence is its name and shown price."""
    row = dict(competitor_id="k9", run_id="run_4", page_ord=3, cand_ord=place, market="Boise, ID", branded=True, offering_type="service",
               display_name=name, normalized_name=name.lower(), price_type="fixed", amount_min=amount, currency="USD", price_unit="session",
               price_display=shown, evidence_text=f"{name}: {shown} each", source_url="https://menu.example.org/list") | changes
    return tuple(row.get(part.split()[0]) for part in re.sub(r"\(.*?\)", "", SCHEMA).split(", "))


def judged(spark, rows):
    return publish.validate(spark.createDataFrame([candidate(i, *row, **changes) for i, (*row, changes) in enumerate(rows)], SCHEMA))


@pytest.mark.parametrize(("changes", "reason"), [
    ({}, None), ({"branded": False}, "unverified_booking_brand"), ({"normalized_name": "ear candle"}, "name_not_in_evidence"),
    ({"price_display": "$46"}, "amount_not_in_evidence"), ({"price_display": None}, "amount_not_in_evidence"),
    ({"currency": None}, None), ({"currency": None, "market": "Boise"}, "unknown_currency"), ({"currency": None, "market": None}, "unknown_currency"),
    ({"price_type": "range"}, "ambiguous_price_semantics"), ({"price_type": "range", "amount_max": Decimal(90)}, None),
    ({"amount_min": None}, "amount_out_of_range"), ({"amount_min": Decimal("1" + "0" * 20)}, "amount_out_of_range"),
    ({"price_type": "none", "amount_min": None, "price_display": None}, "service_mapping_needed"),
    ({"price_type": "none", "amount_min": None, "price_display": None, "service_catalog_id": "s3"}, None)])
def test_publication_reasons(spark, changes, reason):
    row = judged(spark, [("Hot stone", "$45", Decimal(45), changes)]).first()
    assert (row.review_reason, row.publication_status) == (reason, "pending" if reason else "published")
    assert row.offering_key == "service:" + row.normalized_name + ":base:session:0"
    if reason is None and changes.get("price_type") != "none":
        assert row.currency == "USD"


def test_fingerprints_and_first_seen(spark):
    """Case of the host, fragments, trailing zeros and position leave a fingerprint alone; price, name and dates do not."""
    same = [{}, {"source_url": "HTTPS://MENU.example.org/list#two"}, {"amount_min": Decimal("45.000")}, {"page_ord": 8}]
    other = [{"amount_min": Decimal("45.01")}, {"valid_through": date(2033, 7, 2)}, {"source_url": "https://menu.example.org/lists"}]
    df = judged(spark, [("Hot stone", "$45", Decimal(45), c) for c in same + other])
    prints = [r.source_fingerprint for r in df.orderBy("cand_ord").collect()]
    assert len(set(prints[:4])) == 1 and len(set(prints)) == 4
    assert sorted(r.cand_ord for r in publish.first_seen(df).collect()) == [0, 4, 5, 6]


@pytest.mark.parametrize(("url", "text", "branded"), [
    ("https://x.example.com/", "anything", True), ("https://www.booksy.com/x", "Prices of GLOW & Co today", True), ("https://booksy.com/x", "Prices", False)])
def test_brand_check(spark, url, text, branded):
    df = spark.createDataFrame([(url, "Glow and Co", text)], "u string, n string, t string")
    assert df.select(publish.booking_branded(F.col("u"), F.col("n"), F.col("t")).alias("b")).first().b is branded
