"""The review queue: rows to review, their order, and the two output shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.constants import EXPORT_COLUMNS
from leadlake.functions.text import clip, null_if_empty
from leadlake.functions.urls import maps_url


def review_queue(businesses: DataFrame, min_score: int | None = None) -> DataFrame:
    """Rows with review status 'new', best first. No score threshold unless one is given."""
    rows = businesses.where(F.col("review_status") == "new")
    if min_score is not None:
        rows = rows.where(F.col("deficiency_score") >= min_score)
    return rows.orderBy(F.desc("deficiency_score"), F.desc("review_count"), "place_id")


def export_rows(queue: DataFrame) -> DataFrame:
    return queue.withColumn("google_maps_url", maps_url(F.col("place_id"))).select(*EXPORT_COLUMNS)


def write_csv(queue: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header, NULL as empty. The sorted queue is range-partitioned, so part files are in queue order.

    `single_file` is for queues known to be small: it writes through one task.
    """
    rows = export_rows(queue)
    if single_file:
        rows = rows.coalesce(1)
    (rows.write.mode("errorifexists").option("header", True).option("quote", '"').option("escape", '"')
     .option("nullValue", "").option("emptyValue", "").option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def display_rows(queue: DataFrame) -> DataFrame:
    """Short texts for a table on screen."""
    def shown(name: str, width: int, missing: str):
        return clip(F.coalesce(null_if_empty(F.col(name)), F.lit(missing)), width).alias(name)

    return queue.select("place_id", shown("name", 22, ""), shown("metro", 12, ""),
                        F.coalesce("deficiency_score", F.lit(0)).cast("string").alias("score"),
                        shown("primary_deficiency", 20, "none").alias("deficiency"), shown("phone", 14, "N/A"))
