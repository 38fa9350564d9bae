"""How much the history operators shuffle, and that less of it changes no row."""

from pyspark.sql import functions as F

import __spark_entry__
from leadlake import schemas
from leadlake.operators import history
from leadlake.operators.ordered import with_previous
from leadlake.plans.inputs import load
from leadlake.session import where_here
from test_ordered_and_merge import frame, observations, skewed


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_of_short_keys_are_shuffled_once(spark):
    stored, published = schemas.empty(spark, schemas.OFFERINGS), frame(spark, observations(5, seed=1))
    assert plan_of(history.change_events(stored, published)).count("Exchange hashpartitioning") == 1


def test_previous_value_is_exact_whichever_keys_are_sliced(spark):
    rows, df = skewed(spark)
    last, expected = {}, {}
    for k, o, v in sorted(rows, key=lambda r: (r[0], r[1])):
        expected[o] = last.get(k, "none")
        last[k] = v
    for hot_rows in (0, 40, 600):
        got = with_previous(df, ["k"], ["o"], ["v"], F.floor(F.col("o") / 7), hot_rows=hot_rows)
        assert {r.o: ("none" if r.previous is None else r.previous.v) for r in got.collect()} == expected
        assert ("_slice" in plan_of(got) and plan_of(got).count("Exchange hashpartitioning") > 1) == (hot_rows < 600)


def test_a_first_batch_of_events_needs_no_join_and_shuffles_no_id(spark):
    log = history.change_events(schemas.empty(spark, schemas.OFFERINGS), frame(spark, observations(60, seed=2)))
    merged = history.merge_events(schemas.empty(spark, schemas.PRICE_EVENTS), log)
    plan = plan_of(merged)
    assert "Join" not in plan and "offering_id" not in plan[plan.index("Exchange"):]
    last = {r.source_fingerprint: r for r in sorted(log.collect(), key=lambda r: (r.occurred_at, r.run_id, r.page_ord, r.cand_ord))}
    assert {r.source_fingerprint: (r.offering_id, r.event_type, r.detail) for r in merged.collect()} == {
        k: (r.offering_id, r.event_type, r.detail) for k, r in last.items()}


def test_observations_shuffle_lines_once(spark):
    plan = plan_of(load(spark, "/root/testdata/sf0.001", "obs").hint("merge"))
    assert sum("l_orderkey" in line for line in plan.splitlines() if "Exchange" in line) == 1


def test_a_merge_of_few_facts_carries_no_others(spark):
    stored, published = schemas.empty(spark, schemas.OFFERINGS), frame(spark, observations(60, seed=4))
    read = ["competitor_id", "offering_key", "amount_min_minor", "first_published_at", "last_seen_at"]
    some = history.merge_offerings(stored, published, read).select(read)
    assert "evidence_text" not in plan_of(some)[plan_of(some).index("Exchange"):].split("Scan")[0]
    assert sorted(some.collect(), key=str) == sorted(history.merge_offerings(stored, published).select(read).collect(), key=str)


def test_previous_values_are_not_shuffled_a_second_time_as_a_struct(spark):
    log = history.change_events(schemas.empty(spark, schemas.OFFERINGS), frame(spark, observations(5, seed=1)))
    below = plan_of(log)[plan_of(log).index("Exchange"):]
    assert "_w0" not in below and "_slice" not in below


def test_the_count_of_crowded_buckets_leaves_no_shuffle_files(spark):
    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for name in (found.apply(i).getName() for i in range(found.size())) if name.startswith("shuffle_")}

    _, df = skewed(spark)
    before, setting = files(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(setting)
    with_previous(df, ["k"], ["o"], ["v"], F.col("o"), hot_rows=600)
    assert files() <= before and spark.conf.get(setting) == was


def test_two_merges_of_a_log_share_its_shuffle_and_carry_the_details_that_are_read(spark):
    log = history.change_events(schemas.empty(spark, schemas.OFFERINGS), frame(spark, observations(60, seed=5)))
    none, half = schemas.empty(spark, schemas.PRICE_EVENTS), F.substring(F.md5("source_fingerprint"), 1, 1) < "8"
    last = history.last_events(log, ["old_price"])
    merged = history.merge_events(history.merge_events(none, where_here(last, half), ["old_price"]), last, ["old_price"])
    apart = history.merge_events(history.merge_events(none, log.where(half)), log)
    read = ["source_fingerprint", "competitor_id", "event_type", "offering_id", "occurred_at", "detail.old_price", "detail.offering_key"]
    assert sorted(merged.collect(), key=str) and sorted(merged.select(read).collect(), key=str) == sorted(apart.select(read).collect(), key=str)
    plan = plan_of(merged)[:plan_of(merged).index("Initial Plan")]
    assert "ReusedExchange" in plan and plan.count("Window") == 1
    assert "source_url" not in plan[plan.index("Exchange"):].split("Scan")[0].split("LocalTableScan")[0]


def test_the_merge_event_query_computes_its_log_once(spark):
    merged = __spark_entry__.queries()["merge_event"](spark, "/root/testdata/sf0.001")
    merged.collect()
    plan = plan_of(merged)[:plan_of(merged).index("Initial Plan")]
    assert sum("Window" in line for line in plan.splitlines()) == 1
