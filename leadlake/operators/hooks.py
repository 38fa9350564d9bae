"""Opening lines from templates, and the facts handed to an external text generator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake import constants as C
from leadlake.functions.text import null_if_empty, strip_quotes


def short_name(name: Column) -> Column:
    """Lower-case name without legal and trade endings; the whole name when nothing would be left."""
    lowered = F.lower(name)
    cleaned = lowered
    for suffix in C.NAME_SUFFIXES:
        # Each step names the text before it once, so the expression stays linear in the number of endings.
        cleaned = F.regexp_replace(cleaned, rf"(?s)^\s*(.*?)\s*{suffix}\z", "$1")
    return F.coalesce(null_if_empty(cleaned), lowered)


def _fill(template: str, values: dict[str, Column]) -> Column:
    """The template as a concatenation of its literal parts and the value columns."""
    parts, rest = [], template
    while rest:
        at = min((rest.find(f"{{{k}}}") for k in values if f"{{{k}}}" in rest), default=-1)
        if at < 0:
            parts.append(F.lit(rest))
            break
        if at:
            parts.append(F.lit(rest[:at]))
        parts.append(values[rest[at + 1]])
        rest = rest[at + 3:]
    return F.concat(*parts)


def template_hook(short: Column) -> Column:
    """Opening line for the primary deficiency; `short` is the column that holds the shortened name."""
    platform = F.col("site_platform")
    values = {
        "n": short,
        "r": F.coalesce("review_count", F.lit(0)).cast("string"),
        "p": F.when(F.coalesce(platform, F.lit("")).isin("", "unknown"), F.lit("on the site"))
        .otherwise(F.concat(F.lit("on "), platform)),
    }
    chosen = F.when(F.col("primary_deficiency") == "no_website",
                    F.when(platform == "facebook", "no_website/facebook").when(platform == "linktree", "no_website/linktree")
                    .otherwise("no_website")).otherwise(F.col("primary_deficiency"))
    chain = None
    for key, template in C.HOOK_TEMPLATES.items():
        if key != "default":
            text = _fill(template, values)
            chain = F.when(chosen == key, text) if chain is None else chain.when(chosen == key, text)
    return chain.otherwise(_fill(C.HOOK_TEMPLATES["default"], values))


def with_template_hook(businesses: DataFrame, alias: str) -> DataFrame:
    """Add the template line. The name is shortened once, before the choice of template."""
    return businesses.withColumn("_short", short_name(F.col("name"))).withColumn(
        alias, template_hook(F.col("_short"))).drop("_short")


def hook_grounded() -> Column:
    """False when the line claims missing booking although the row does not say so."""
    claims_booking = F.col("primary_deficiency") == "reviews_vs_web"
    return ~F.coalesce(claims_booking, F.lit(False)) | F.coalesce(F.col("has_online_booking") == 0, F.lit(False))


FACTS = ["name", "review_count", "rating", "site_platform", "has_online_booking", "primary_deficiency", "social_status",
         "has_ssl", "is_mobile_friendly"]


def generator_facts() -> Column:
    """JSON facts for a text generator; unknown facts stay as null."""
    return F.to_json(F.struct(*FACTS), {"ignoreNullFields": "false"})


def choose_hook(generated: Column, fallback: Column) -> Column:
    """The generated line without its quotes, or the template line when there is none."""
    return F.coalesce(strip_quotes(generated), fallback)
