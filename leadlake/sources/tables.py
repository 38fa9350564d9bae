"""Stored snapshots and the append-only event log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from leadlake import schemas


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Table stored at `path`, or an empty one with the same columns when nothing is stored yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return schemas.empty(spark, schema)
        raise


def write_snapshot(df: DataFrame, path: str) -> None:
    """Write a new snapshot folder; an existing one is never replaced in place."""
    df.write.mode("errorifexists").parquet(path)


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int) -> None:
    """Write a snapshot as a catalog table bucketed and sorted by key: a later merge shuffles only its batch."""
    spread = df.repartition(buckets, *keys)
    spread.write.mode("errorifexists").bucketBy(buckets, *keys).sortBy(*keys).format("parquet").saveAsTable(table)


def businesses(spark: SparkSession, path: str) -> DataFrame:
    return read_snapshot(spark, path, schemas.BUSINESSES)


def events(rows: DataFrame, stage: str, level: Column | str, message: Column, as_of: Column) -> DataFrame:
    """Log entries for rows with a `place_id`; entries without a message are left out."""
    place = F.col("place_id") if "place_id" in rows.columns else F.lit(None).cast("string")
    level = F.lit(level) if isinstance(level, str) else level
    return rows.select(place.alias("place_id"), F.lit(stage).alias("stage"), level.alias("level"),
                       message.alias("message"), as_of.cast("timestamp").alias("created_at")).where("message IS NOT NULL")


def replace_slice(df: DataFrame, path: str, column: str) -> None:
    """Write the slices (values of `column`) that `df` holds and leave all others as they are, without reading any.

    A slice is replaced when the job commits, so a rerun leaves one set of rows and a job that fails leaves the old one. Slices without a row are not touched.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def append_events(log: DataFrame, path: str, run_id: str) -> None:
    """Add the log of one run; a rerun of it takes the place of its earlier entries."""
    replace_slice(schemas.conform(log, schemas.EVENTS).withColumn("run_id", F.lit(run_id)), path, "run_id")


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return read_snapshot(spark, path, T.StructType([*schemas.EVENTS.fields, T.StructField("run_id", T.StringType())]))
