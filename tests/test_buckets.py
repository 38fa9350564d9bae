"""Versioned bucket tables: equal to a plain merge, cost by the batch, reruns, writers in each other's way."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlake.operators.merge import OVERWRITE, merge
from leadlake.sources.buckets import BucketTable, StaleVersionError

SCHEMA = T.StructType([T.StructField("owner", T.LongType()), T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


def combine(current, batch):
    return merge(current, batch, ["owner", "k"], {"v": OVERWRITE})


def rows(df):
    return sorted(map(str, df.collect()))


def test_a_merge_touches_its_buckets_alone(spark, tmp_path):
    stored = spark.range(3000).select((F.col("id") % 300).alias("owner"), F.col("id").alias("k"), F.lit("old").alias("v"))
    table = BucketTable(spark, str(tmp_path / "t"), SCHEMA, ("owner",), 100)
    one = table.write(stored)
    batch = spark.createDataFrame([(7, 7, "new"), (7, 99999, "added"), (8, 8, None), (100000, 1, "owner")], SCHEMA)
    two = table.merge(batch, combine, one)
    assert rows(table.read(two)) == rows(combine(stored, batch)) and rows(table.read(one)) == rows(stored)
    before, after = table.folders(one), table.folders(two)
    moved = {b for b in after if after[b] != before.get(b)}
    assert 1 <= len(moved) <= 3 and len(before) > 90
    seen = []
    table.merge(batch, lambda current, found: (seen.extend(current.inputFiles()), combine(current, found))[1], two)
    assert {f.split("_bucket=")[1].split("/")[0] for f in seen} <= {str(b) for b in moved}


def test_a_second_writer_of_a_version_fails_and_old_versions_stay(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), SCHEMA, ("owner",), 4)
    empty = spark.createDataFrame([], SCHEMA)
    one = table.merge(spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], SCHEMA), combine, 0)
    two = table.merge(spark.createDataFrame([(1, 1, "c")], SCHEMA), combine, one)
    with pytest.raises(StaleVersionError):
        table.merge(spark.createDataFrame([(1, 1, "d")], SCHEMA), combine, one)
    assert rows(table.read(two).where("owner = 1")) == ["Row(owner=1, k=1, v='c')"] and table.read(one).where("v = 'a'").count() == 1
    three = table.merge(empty, combine, two)
    assert rows(table.read(three)) == rows(table.read(two)) and table.folders(three) == table.folders(two)
    gone = table.merge(spark.createDataFrame([(1, 1, "x")], SCHEMA), lambda current, batch: current.where("false"), three)
    assert table.read(gone).where("owner = 1").count() == 0
    with pytest.raises(ValueError):
        table.merge(spark.createDataFrame([(1, 1, "x")], SCHEMA), lambda current, batch: spark.range(50).select(F.col("id").alias("owner"), F.lit(1).alias("k"), F.lit("s").alias("v")), two)
