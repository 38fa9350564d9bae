"""Bucketed snapshots, checkpoints, incremental landing."""

from pyspark.sql import functions as F

from leadlake import schemas
from leadlake.operators.merge import OVERWRITE, merge
from leadlake.session import cut_lineage
from leadlake.sources.tables import read_snapshot, write_bucketed
from leadlake.streaming.landing import merge_landed_places, version_path


def test_merge_into_a_bucketed_snapshot_shuffles_only_the_batch(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        write_bucketed(spark.range(1000).select(F.col("id").alias("k"), F.lit("old").alias("v")), "snap_test", ["k"], 4)
        merged = merge(spark.table("snap_test"), spark.range(990, 1010).select(F.col("id").alias("k"), F.lit("new").alias("v")), ["k"], {"v": OVERWRITE})
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        assert merged.where("v = 'new'").count() == 20 and merged.count() == 1010
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS snap_test")


def test_checkpoint_keeps_rows(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    assert cut_lineage(spark.range(10)).count() == 10


def test_landed_answers_are_merged_once(spark, tmp_path):
    landing, root, checkpoint = (str(tmp_path / n) for n in ("landing", "root", "checkpoint"))
    (tmp_path / "landing").mkdir()
    details = spark.createDataFrame([], schemas.DETAILS_PAYLOAD)
    as_of = F.lit("2026-03-01 00:00:00").cast("timestamp")

    def land(name, text):
        (tmp_path / "landing" / name).write_text(text + "\n")
        merge_landed_places(spark, landing, root, checkpoint, details, as_of).awaitTermination()

    land("a.json", '{"metro":"Austin, TX","query_ord":0,"status":"OK","results":[{"place_id":"x","name":"One","rating":4.0}]}')
    land("b.json", '{"metro":"Austin, TX","query_ord":0,"status":"OK","results":[{"place_id":"x","name":"Two"},{"place_id":"y","name":"Three"}]}')
    got = {r.place_id: (r.name, r.rating) for r in read_snapshot(spark, version_path(root, 1), schemas.BUSINESSES).collect()}
    assert got == {"x": ("Two", 4.0), "y": ("Three", None)}
    assert read_snapshot(spark, version_path(root, 0), schemas.BUSINESSES).count() == 1


def test_market_status_follows_the_searches_of_all_batches(spark, tmp_path):
    landing, root, checkpoint = (str(tmp_path / n) for n in ("landing", "root", "checkpoint"))
    (tmp_path / "landing").mkdir()
    details = spark.createDataFrame([], schemas.DETAILS_PAYLOAD)

    def land(name, day, *answers):
        rows = [f'{{"metro":"{metro}","query_ord":{n},"status":"{status}","results":[]}}' for metro, n, status in answers]
        (tmp_path / "landing" / name).write_text("\n".join(rows) + "\n")
        as_of = F.lit(f"2026-03-0{day} 00:00:00").cast("timestamp")
        merge_landed_places(spark, landing, root, checkpoint, details, as_of).awaitTermination()

    def status(version):
        return {r.metro: (r.last_status, r.updated_at.day) for r in spark.read.parquet(version_path(root, version, "status")).collect()}

    land("a.json", 1, ("Austin, TX", 0, "OK"), ("Austin, TX", 1, "OK"), ("Waco, TX", 0, "OK"), ("Waco, TX", 1, "OK"), ("Waco, TX", 2, "ZERO_RESULTS"))
    assert status(0) == {"Austin, TX": ("partial", 1), "Waco, TX": ("complete", 1)}
    land("b.json", 2, ("Austin, TX", 2, "OVER_QUERY_LIMIT"))
    assert status(1) == {"Austin, TX": ("partial", 2), "Waco, TX": ("complete", 1)}
    land("c.json", 3, ("Austin, TX", 2, "OK"))
    assert status(2) == {"Austin, TX": ("complete", 3), "Waco, TX": ("complete", 1)}
    assert spark.read.parquet(version_path(root, 2, "searches")).count() == 6
