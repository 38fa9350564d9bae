"""Markets and freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake import constants as C
from leadlake.functions.text import metro_display, metro_key
from leadlake.operators.merge import OVERWRITE, merge


class BlankMetroError(ValueError):
    pass


def tenant_markets(locations: DataFrame, order: str = "tenant_id") -> DataFrame:
    """(metro_key, metro, tenant_id, ord) for primary locations with a readable metro.

    Tenants stay rows instead of one array per market, so a market holding a third of them is not one value in one task.
    """
    return locations.where(F.col("is_primary") & F.col("metro").isNotNull()).select(
        metro_key(F.col("metro")).alias("metro_key"), metro_display(F.col("metro")).alias("metro"),
        "tenant_id", F.col(order).alias("ord"),
    ).where(F.col("metro_key").isNotNull())


def market_groups(locations: DataFrame, order: str = "tenant_id") -> DataFrame:
    """One row per market: key, first spelling, number of tenants."""
    return tenant_markets(locations, order).groupBy("metro_key").agg(
        F.min_by("metro", "ord").alias("metro"), F.count(F.lit(1)).alias("tenants"))


def explicit_markets(metros: DataFrame, order: str = "ord") -> DataFrame:
    """Markets named by the caller (columns metro and an order): normalized, first spelling kept."""
    return metros.select(metro_key(F.col("metro")).alias("metro_key"), metro_display(F.col("metro")).alias("metro"),
                         F.col(order).alias("ord")).where(F.col("metro_key").isNotNull()).groupBy("metro_key").agg(
        F.min_by("metro", "ord").alias("metro"), F.lit(0).cast("long").alias("tenants"))


def invalid_tenants(locations: DataFrame) -> DataFrame:
    """Primary locations whose metro is present but blank."""
    return locations.where(
        F.col("is_primary") & F.col("metro").isNotNull() & metro_key(F.col("metro")).isNull()).select("tenant_id")


def require_valid_tenants(locations: DataFrame, quarantine: str) -> None:
    """Fail when a primary location has a blank metro. All such tenants are written to the folder `quarantine`, which the message
    names with their number: the list itself may be long."""
    invalid_tenants(locations).write.mode("overwrite").parquet(quarantine)
    found = locations.sparkSession.read.parquet(quarantine).count()
    if found:
        raise BlankMetroError(f"Primary locations with blank metros: {found} tenants, listed in {quarantine}")
    if market_groups(locations).isEmpty():
        raise BlankMetroError("No primary-location metros are configured.")


def require_markets(metros: DataFrame) -> None:
    """Fail on an empty list of markets or on a blank name."""
    if not metros.where(metro_key(F.col("metro")).isNull()).isEmpty():
        raise BlankMetroError("metro is blank")
    if metros.isEmpty():
        raise BlankMetroError("At least one metro is required.")


def is_fresh(completed_at: Column, as_of: Column, days: int = C.FRESH_DAYS) -> Column:
    """True when fewer than `days` whole days have passed; exactly `days` is stale; NULL is stale."""
    return F.coalesce(completed_at > as_of.cast("timestamp") - F.make_interval(days=F.lit(days)), F.lit(False))


def market_freshness(scrapes: DataFrame, as_of: Column, force: bool = False) -> DataFrame:
    """(metro_key, fresh): complete and completed within the window. `force` makes every market due."""
    fresh = (F.col("last_status") == "complete") & is_fresh(F.col("last_completed_at"), as_of)
    return scrapes.select("metro_key", (F.coalesce(fresh, F.lit(False)) & F.lit(not force)).alias("fresh"))


def latest_completed(runs: DataFrame) -> DataFrame:
    """Newest completed run per competitor, among complete and partial ones."""
    return runs.where(F.col("status").isin("complete", "partial")).groupBy("competitor_id").agg(
        F.max("completed_at").alias("completed_at"))


def crawl_freshness(runs: DataFrame, as_of: Column, force: bool = False) -> DataFrame:
    """(competitor_id, completed_at, fresh) from the newest usable run."""
    fresh = is_fresh(F.col("completed_at"), as_of) & F.lit(not force)
    return latest_completed(runs).select("competitor_id", "completed_at", fresh.alias("fresh"))


def due_markets(markets: DataFrame, scrapes: DataFrame, as_of: Column, force: bool = False) -> DataFrame:
    """Markets whose discovery must run again."""
    fresh = market_freshness(scrapes, as_of, force).where("fresh")
    return markets.join(fresh.select("metro_key"), "metro_key", "left_anti")


def market_competitors(memberships: DataFrame, markets: DataFrame) -> DataFrame:
    """Distinct competitors seen in the given markets."""
    return memberships.join(markets.select("metro_key"), "metro_key", "left_semi").select("competitor_id").distinct()


def discovered_union(found: DataFrame, cached: DataFrame) -> DataFrame:
    """Competitors found now, together with those of markets that were still fresh."""
    return found.select("competitor_id").unionByName(cached.select("competitor_id")).distinct()


def market_status(searched: DataFrame, failures: DataFrame, as_of: Column) -> DataFrame:
    """Status row per searched market: any failure makes it partial and leaves it without a completion time."""
    failed = failures.groupBy("metro_key").agg(F.count(F.lit(1)).alias("_failures"))
    bad = F.col("_failures").isNotNull()
    stamp = as_of.cast("timestamp")
    return searched.join(failed, "metro_key", "left").select(
        "metro_key", "metro", F.when(bad, "partial").otherwise("complete").alias("last_status"),
        F.when(~bad, stamp).alias("last_completed_at"),
        F.when(bad, "One or more place queries or writes failed.").alias("last_error"), stamp.alias("updated_at"))


def merge_market_status(current: DataFrame, updates: DataFrame) -> DataFrame:
    rules = dict.fromkeys(["metro", "last_status", "last_completed_at", "last_error", "updated_at"], OVERWRITE)
    return merge(current, updates, ["metro_key"], rules)


def eligible_competitors(competitors: DataFrame, ids: DataFrame) -> DataFrame:
    """Competitors of the batch (column competitor_id) that have a website."""
    wanted = ids.select(F.col("competitor_id").alias("id"))
    return competitors.where(F.col("website").isNotNull()).join(wanted, "id", "left_semi")
