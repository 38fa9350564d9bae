"""Price grammar: one menu row of text to a structured offering, in JVM expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake import constants as C
from leadlake.functions.text import collapse_spaces, extract, mentions, null_if_empty, normalize_label
from leadlake.schemas import AMOUNT


def to_amount(text: Column) -> Column:
    """The number in a price text; NULL when it has more digits than any amount, which publication sends to review."""
    return F.replace(text, F.lit(","), F.lit("")).try_cast(AMOUNT)


def minor_units(amount: Column) -> Column:
    """Hundredths as a whole number, halves to even; NULL when beyond the stored range."""
    return (F.bround(amount, 2) * 100).try_cast("long")


def money(text: Column, parity: bool = False) -> tuple[Column, Column]:
    """(digits, currency) of the first price token. Only dollar tokens name a currency.

    `parity` keeps the narrow digit rule under which "$1200" reads as 120; by default the whole number is read.
    """
    pattern = "(?i)" + C.MONEY_TOKEN + (C.MONEY_PARITY if parity else C.MONEY_WHOLE)
    token = F.upper(F.regexp_extract(text, pattern, 1))
    return extract(text, pattern, 2), F.when(token.isin("$", "USD", "US$"), F.lit("USD"))


def valid_through(text: Column) -> Column:
    """Last date after through/until/valid, long form or ISO; NULL when it is no date."""
    last = F.try_element_at(F.regexp_extract_all(text, F.lit(C.UNTIL_DATE), F.lit(1)), F.lit(-1))
    return F.coalesce(*[F.try_to_date(last, f) for f in ("MMMM d, yyyy", "MMMM d yyyy", "yyyy-MM-dd")])


def parse_rows(rows: DataFrame, text: str, parity: bool = False, exempt: Column | None = None) -> DataFrame:
    """Add the offering columns for the text column; rows without a readable name are dropped.

    `exempt` keeps rows that bring their offering from elsewhere and have no text. Staged in small selects so that each
    pattern runs once per row and later stages reuse its result.
    """
    exempt = F.lit(False) if exempt is None else exempt
    kept = [F.col(name) for name in rows.columns if name != text]
    clean = F.col("clean")
    staged = rows.select(*kept, collapse_spaces(F.col(text)).alias("clean"))
    # Price rows without a leading letter carry no name: a cheap test before the patterns.
    staged = staged.where(exempt | clean.rlike("^[A-Za-z]"))
    staged = staged.withColumns({
        "lower": F.lower(clean),
        "display_name": null_if_empty(F.regexp_replace(F.regexp_extract(clean, C.OFFERING_NAME, 1),
                                                       r"^[ \-–—|:]+|[ \-–—|:]+$", "")),
    }).where(exempt | F.col("display_name").isNotNull())
    digits, currency = money(clean, parity)
    staged = staged.withColumns({
        "first_digits": digits,
        "first_currency": currency,
        "range_min": to_amount(extract(clean, C.PRICE_RANGE, 1)),
        "range_max": to_amount(extract(clean, C.PRICE_RANGE, 2)),
        "was_text": extract(clean, C.WAS_NOW, 1),
        "now_text": extract(clean, C.WAS_NOW, 2),
        "is_range": clean.rlike(C.PRICE_RANGE),
    })
    lower, priced = F.col("lower"), F.col("first_digits").isNotNull()
    promoted = F.col("now_text").isNotNull()
    was_digits, _ = money(F.col("was_text"), parity)
    now_digits, now_currency = money(F.col("now_text"), parity)
    listed_amount = F.when(priced & F.col("is_range"), F.col("range_min")).otherwise(to_amount(F.col("first_digits")))
    return staged.select(
        *kept,
        F.when(mentions(lower, ["offer", "special", "expires", "valid through"]), "offer")
        .when(F.contains(lower, F.lit("membership")), "membership")
        .when(F.contains(lower, F.lit("package")), "package")
        .otherwise("service").alias("offering_type"),
        "display_name",
        F.lit(None).cast("string").alias("qualifier"),
        F.when(~priced, "none").when(F.col("is_range"), "range").when(lower.rlike(C.FROM_PRICE), "from")
        .otherwise("fixed").alias("price_type"),
        F.when(promoted, to_amount(now_digits)).otherwise(listed_amount).alias("amount_min"),
        F.when(priced & F.col("is_range"), F.col("range_max")).alias("amount_max"),
        F.when(promoted, now_currency).otherwise(F.col("first_currency")).alias("currency"),
        F.when(lower.rlike(r"/(?:mo|month)\b|per month"), "month")
        .when(lower.rlike("per session|/session"), "session")
        .when(lower.rlike("per unit|/unit"), "unit")
        .when(F.contains(lower, F.lit("package")), "package")
        .when(priced & F.coalesce(listed_amount != 0, ~F.col("is_range")), "total").alias("price_unit"),
        extract(lower, C.QUANTITY, 1).try_cast("int").alias("package_quantity"),
        to_amount(was_digits).alias("original_amount"),
        F.lit(None).cast("date").alias("valid_from"),
        valid_through(clean).alias("valid_through"),
        F.when(promoted, extract(clean, C.NOW_PRICE, 0)).otherwise(extract(clean, C.PRICE_TEXT, 0)).alias("price_display"),
        F.substring(clean, 1, C.MAX_ROW_CHARS).alias("evidence_text"),
    )


def offering_key(offering_type: Column, normalized_name: Column, qualifier: Column, price_unit: Column,
                 package_quantity: Column) -> Column:
    """Identity of an offering within a competitor."""
    return F.concat_ws(
        ":", offering_type, normalized_name, F.coalesce(null_if_empty(normalize_label(qualifier)), F.lit("base")),
        F.coalesce(price_unit, F.lit("none")), F.coalesce(package_quantity, F.lit(0)).cast("string"),
    )


def fingerprint(*fields: Column) -> Column:
    """SHA-256 over the fields in order; NULL is written out, since concat_ws would skip it."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(f.cast("string"), F.lit("None")) for f in fields]), 256)
