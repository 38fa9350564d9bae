"""Versioned tables in key buckets: a merge reads and writes only the buckets its batch falls into.

A version is a manifest: which folder holds each bucket. A merge routes its batch to buckets by a hash of the routing columns, rewrites those and
carries the others over by name, so its cost follows the batch and not the table. Older versions stay readable, and a rerun of a batch onto the same
version gives the same rows. Choose the routing so that a batch falls into few buckets: by competitor, a crawl of some competitors touches theirs alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlake import schemas

_ENTRY = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("folder", T.StringType())])
_BUCKET = "_bucket"


class StaleVersionError(RuntimeError):
    """Another writer has already written the version that this merge would write."""


@dataclass(frozen=True)
class BucketTable:
    """A table under `root`. The manifest has at most `buckets` rows, which is what the driver holds of it."""

    spark: SparkSession
    root: str
    schema: T.StructType
    route: tuple[str, ...]
    buckets: int = 1024

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.route), F.lit(self.buckets)).cast("int")

    def _manifest(self, version: int) -> str:
        return f"{self.root.rstrip('/')}/manifest/version={version}"

    def folders(self, version: int) -> dict[int, str]:
        """Where each bucket of a version lies; version 0 is the empty table."""
        if version == 0:
            return {}
        return {r["bucket"]: r["folder"] for r in self.spark.read.schema(_ENTRY).parquet(self._manifest(version)).collect()}

    def read(self, version: int, only: Sequence[int] | None = None) -> DataFrame:
        """The rows of a version, or of some of its buckets."""
        folders = [folder for bucket, folder in sorted(self.folders(version).items()) if only is None or bucket in set(only)]
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else schemas.empty(self.spark, self.schema)

    def write(self, rows: DataFrame, version: int = 1) -> int:
        """Write a whole table as a version."""
        return self._publish(rows, {}, None, version)

    def merge(self, batch: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame], version: int) -> int:
        """Merge a batch into `version` and return the next one. `combine` takes the stored rows of the touched buckets and the batch.

        `batch` is used twice, to find its buckets and to merge: pass a stored frame. Rows with a null in a routing column have a bucket like all others.
        """
        touched = sorted(r[_BUCKET] for r in batch.select(self._bucket().alias(_BUCKET)).distinct().collect())
        return self._publish(combine(self.read(version, touched), batch), self.folders(version), touched, version + 1)

    def _publish(self, rows: DataFrame, before: dict[int, str], touched: Sequence[int] | None, version: int) -> int:
        folder = f"{self.root.rstrip('/')}/data/{uuid.uuid4().hex}"
        placed = schemas.conform(rows, self.schema).withColumn(_BUCKET, self._bucket())
        # One bucket may hold a hot key: rebalancing splits it over several tasks and files.
        placed.hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(folder)
        try:
            written = [r[_BUCKET] for r in self.spark.read.parquet(folder).select(_BUCKET).distinct().collect()]
        except Exception as error:  # a merge that leaves no row writes no bucket
            if "UNABLE_TO_INFER_SCHEMA" not in str(error):
                raise
            written = []
        stray = set(written) - set(touched) if touched is not None else set()
        if stray:
            raise ValueError(f"rows left their buckets: {sorted(stray)}")
        entries = {b: f for b, f in before.items() if touched is None or b not in set(touched)} | {b: f"{folder}/{_BUCKET}={b}" for b in written}
        try:
            self.spark.createDataFrame(sorted(entries.items()), _ENTRY).coalesce(1).write.mode("errorifexists").parquet(self._manifest(version))
        except Exception as error:
            if "PATH_ALREADY_EXISTS" in str(error):
                raise StaleVersionError(f"version {version} of {self.root} exists") from error
            raise
        return version
