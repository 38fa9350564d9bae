"""Deficiency score and primary deficiency. Flags are three-valued: NULL means not measured and never scores."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake import constants as C
from leadlake.functions.text import mentions


def _true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def deficiencies() -> dict[str, Column]:
    """One boolean per deficiency, from the current state of the business row."""
    platform, url = F.col("site_platform"), F.coalesce("website_url", F.lit(""))
    unknown_platform = F.coalesce(platform, F.lit("")) == ""
    hub_url = (url == "") | mentions(F.lower(url), ["linktr.ee", "facebook.com"])
    dormant = _true(F.col("social_status") == "dormant")
    found = {
        "no_website": _true(platform.isin("none", "linktree", "facebook")) | (unknown_platform & hub_url),
        "no_booking": _true(F.col("has_online_booking") == 0),
        "not_mobile": _true(F.col("is_mobile_friendly") == 0),
        "no_ssl": _true(F.col("has_ssl") == 0),
        "dormant_social": dormant,
        "no_social": _true(F.col("social_status") == "none"),
    }
    busy = F.coalesce("review_count", F.lit(0)) >= C.REVIEWS_THRESHOLD
    leaking = found["no_website"] | found["not_mobile"] | found["no_booking"]
    return {"reviews_vs_web": busy & leaking, **found}


def with_score(businesses: DataFrame, weights: Mapping[str, int] = C.WEIGHTS, bonus: int = C.REVIEWS_BONUS) -> DataFrame:
    """Set deficiency_score and primary_deficiency on every row."""
    points = {"reviews_vs_web": bonus, **weights}
    flags = deficiencies()
    flagged = businesses.withColumns({f"_{name}": flag for name, flag in flags.items()})
    score, primary = F.lit(0), None
    for name in flags:
        flag = F.col(f"_{name}")
        score = score + F.when(flag, points[name]).otherwise(0)
        primary = F.when(flag, name) if primary is None else primary.when(flag, name)
    return flagged.withColumns({"deficiency_score": score.cast("int"), "primary_deficiency": primary}).drop(
        *[f"_{name}" for name in flags])
