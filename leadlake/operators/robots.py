"""Robots rules applied to a frontier: one streaming pass over rows sorted by host."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.functions.urls import netloc

DEFAULT_AGENT = "Mozilla/5.0"
_SALTS = 256


def robots_filter(urls: DataFrame, robots: DataFrame, agent: str = DEFAULT_AGENT) -> DataFrame:
    """(url, allowed). `robots`: host, robots_txt, http_status; a missing or failing file allows everything.

    Each host's rules are sent once per (host, salt) that has URLs and sort ahead of them, so no row carries the rules text, no
    group is held in memory, and a host with a third of all URLs is spread over many tasks.
    """
    asked = urls.select("url").distinct().select(
        "url", netloc(F.col("url")).alias("host"), F.pmod(F.xxhash64("url"), F.lit(_SALTS)).cast("int").alias("salt"))
    usable = robots.where(~F.coalesce(F.col("http_status") >= 400, F.lit(False)) & F.col("robots_txt").isNotNull())
    rules = usable.groupBy("host").agg(F.max("robots_txt").alias("robots_txt"))
    headers = asked.select("host", "salt").distinct().join(rules, "host").withColumns({
        "url": F.lit(None).cast("string"), "is_url": F.lit(0)})
    rows = headers.unionByName(asked.withColumns({"robots_txt": F.lit(None).cast("string"), "is_url": F.lit(1)}))
    ordered = rows.repartition("host", "salt").sortWithinPartitions("host", "salt", "is_url").select(
        "host", "robots_txt", "url")

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        host, parser = None, None
        for batch in batches:
            found: list[tuple[str, bool]] = []
            for row_host, text, url in zip(batch["host"], batch["robots_txt"], batch["url"]):
                if row_host != host:
                    host, parser = row_host, None
                if url is None:
                    parser = RobotFileParser()
                    parser.parse(text.splitlines())
                else:
                    found.append((url, parser is None or parser.can_fetch(agent, url)))
            yield pd.DataFrame(found, columns=["url", "allowed"])

    return ordered.mapInPandas(decide, "url string, allowed boolean")
