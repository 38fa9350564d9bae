"""Page parts and the detectors over them."""

import pytest
from pyspark.sql import functions as F

from leadlake.operators.signals import (booking_signature, booking_signature_from, instagram_handle, page_signals)
from leadlake.constants import BOOKING_SIGNATURES
from leadlake.sources.captures import anchor_links, with_page_parts


def pages(spark, htmls, final_url="https://spa.example.com/"):
    rows = [(i, final_url, h) for i, h in enumerate(htmls)]
    return with_page_parts(spark.createDataFrame(rows, "page_id long, final_url string, html string"))


def parts(spark, html):
    return pages(spark, [html]).select("parts.*").first()


def signals(spark, htmls, **kwargs):
    return page_signals(pages(spark, htmls, **kwargs), ["page_id"]).orderBy("page_id").collect()


def test_parts_follow_lenient_tree_rules(spark):
    got = parts(spark, '<!doctype html><title>A &amp; B</title><nav>menu</nav><div>one<br>two<!-- x -->three'
                       '<script>var a="$9";</script></div></b><p>Peel $5<p>Wax $6<template>$7</template>')
    assert got.title == "A & B"
    assert got.visible_text == "A & B one two three Peel $5 Wax $6"
    # An unclosed paragraph contains the next one, and comes first.
    assert got.rows == ["Peel $5 Wax $6", "Wax $6"]


def test_long_rows_and_rows_without_dollars_are_left_out(spark):
    long = "Facial $10 " + "x" * 500
    assert parts(spark, f"<div>{long}</div><li>Facial €10</li><li>{'y' * 494} $1234</li>").rows == ["y" * 494 + " $1234"][:0] + [
        "y" * 494 + " $1234"]


def test_nested_rows_come_parent_first(spark):
    html = '<div id="root"><main><section>Laser - $175 per session</section><section>Filler - $650</section></main></div>'
    assert parts(spark, html).rows == ["Laser - $175 per session Filler - $650", "Laser - $175 per session", "Filler - $650"]


def test_null_and_broken_markup(spark):
    df = spark.createDataFrame([(1, None), (2, "<![bad<p>x $1</p>"), (3, "")], "page_id long, html string")
    got = {r.page_id: r.parts for r in with_page_parts(df).collect()}
    assert got[1] is None and got[3].rows == [] and got[2] is not None


@pytest.mark.parametrize(("html", "expected"), [
    ('<meta name="viewport" content="width=device-width"><a href="https://www.vagaro.com/x">Reserve</a>', (1, "vagaro")),
    ('<a href="https://clients.mindbodyonline.com/x">Classes</a>', (1, "mindbody")),
    ('<p>Phone 555-0100</p><a href="/about">About</a><a href="/services">Services</a>', (0, None)),
    ('<a href="https://demo.glossgenius.com/s">Go</a>', (1, "glossgenius")),
    ('<a href="https://demo.zenoti.com/s">Go</a>', (1, "zenoti")),
    ('<a href="/services/booking">Go</a>', (1, "other")),
    ('<a href="/reserve">Book a visit</a>', (1, "other")),
    ("<button>Schedule a visit</button>", (1, "other")),
    ('<input type="submit" value="Book">', (1, "other")),
    ('<p>Ring us to book a visit.</p><a href="/about">About</a>', (0, None)),
    ('<a href="https://facebook.com/spa">Find us</a>', (1, "other")),
])
def test_booking(spark, html, expected):
    row = signals(spark, [html])[0]
    assert (row.has_online_booking, row.booking_platform) == expected


def test_booking_can_ignore_social_hosts_and_shows_its_evidence(spark):
    html = '<a href="https://facebook.com/spa">Find us</a>'
    shown = signals(spark, [html])[0]
    assert (shown.booking_rule, shown.booking_evidence) == ("link", "https://facebook.com/spa")
    strict = page_signals(pages(spark, [html]), ["page_id"], ignore_social_hosts=True).first()
    assert strict.has_online_booking == 0


def test_signature_as_data_equals_the_chain(spark):
    pairs = [(p, s) for p, ss in BOOKING_SIGNATURES.items() for s in ss]
    texts = [(f"x {s} y",) for _, s in pairs] + [("nothing",), ("setmore.com vagaro.com",)]
    df = spark.createDataFrame(texts, "t string")
    rows = df.select(booking_signature(F.col("t")).alias("a"), booking_signature_from(F.col("t"), pairs).alias("b")).collect()
    assert all(r.a == r.b for r in rows) and rows[-1].a == "vagaro" and rows[-2].a is None


def test_platform_and_viewport(spark):
    rows = signals(spark, [
        "<script src='//static.wixpress.com/a'></script>", "<link href='https://static1.squarespace.com'>",
        "<link href='/wp-content/a.css'>", "<script src='https://cdn.shopify.com'></script>", "<p>plain</p>",
        '<meta name="viewport" content="INITIAL-SCALE=1">', '<meta name="viewport"><meta name="viewport" content="initial-scale=1">',
    ])
    assert [r.page_platform for r in rows][:5] == ["wix", "squarespace", "wordpress", "shopify", "custom"]
    assert [r.page_mobile for r in rows][5:] == [1, 0]
    assert signals(spark, ["wixpress"], final_url="https://linktr.ee/a")[0].page_platform == "linktree"


def test_social_links_take_the_first_and_skip_share_buttons(spark):
    rows = signals(spark, [
        '<a href="https://facebook.com/sharer?u=1">s</a><a href="https://Facebook.com/one">f</a>'
        '<a href="https://instagram.com/a">i</a><a href="https://instagram.com/b">i</a>',
        '<a href="https://instagram.com/a?via=facebook.com">i</a>',
        '<a href="https://instagram.com/a">i</a><a href="https://instagram.com/b?via=facebook.com">i</a>',
    ])
    assert (rows[0].page_instagram, rows[0].page_facebook) == ("https://instagram.com/a", "https://Facebook.com/one")
    assert rows[1].page_facebook is None
    assert rows[2].page_facebook == "https://instagram.com/b?via=facebook.com"


def test_contact_and_email(spark):
    rows = signals(spark, [
        '<a href="/contact">c</a><a href="/reach-us">r</a>',
        '<a href="mailto:a@x.com?subject=1">m</a><a href="MAILTO: b@x.com ">m</a><p>z@x.com</p>',
        '<a href="mailto:nobody">m</a><p>first@x.com second@x.com</p>',
        "<p>none</p>",
        '<a href="mailto:contact@x.com">m</a>',
    ])
    assert rows[0].contact_href == "/reach-us"
    assert [r.page_email for r in rows[1:4]] == ["b@x.com", "first@x.com", None]
    assert rows[4].contact_href == "mailto:contact@x.com"


def test_instagram_handle(spark):
    df = spark.createDataFrame([("https://instagram.com/glow/",), ("https://instagram.com/glow/?hl=en",),
                                ("https://instagram.com",), (None,), ("https://instagram.com/glow?x=1",)], "u string")
    assert [r.h for r in df.select(instagram_handle(F.col("u")).alias("h")).collect()] == [
        "glow", "glow/", None, None, "glow"]


@pytest.mark.parametrize("n", [3, 300])
def test_links_left_open_keep_their_whole_text(spark, n):
    """Every unclosed link contains all later ones, and each has its text in full on small and large pages alike."""
    words = [f"filler text {i} " for i in range(n)]
    html = "".join(f'<a href="/x{i}">{word}' for i, word in enumerate(words)) + "<b>bo</b>ok a treatment" + '<a href="/end">nothing'
    rows = anchor_links(pages(spark, [html]), ["page_id"]).orderBy("ord").collect()
    assert [r.text for r in rows[:n]] == ["".join(words[i:]) + "book a treatmentnothing" for i in range(n)]
    assert all(r.words == "treatment" for r in rows[:n]) and (rows[n].text, rows[n].words) == ("nothing", "")
    assert signals(spark, [html])[0].booking_platform == "other"


def test_the_page_row_grows_with_the_page_only(spark):
    n = 4000
    got = parts(spark, "".join(f'<a href="/x{i}">filler text {i} ' for i in range(n)) + "book")
    assert len(got.anchors) == n and len(got.pieces) == n
    assert all(a.text_words == ["book"] and a.label_words == ["book"] for a in got.anchors)


def test_button_evidence(spark):
    got = signals(spark, ['<button value="v">Please <i>book</i> now</button>', '<input value="Schedule">', "<button>no</button>"])
    assert [r.booking_evidence for r in got] == ["v Please book now", "Schedule", None]

