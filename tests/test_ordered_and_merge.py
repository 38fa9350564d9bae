"""Ordered operators with hot keys, and merges, against row-by-row replays."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from leadlake import schemas
from leadlake.constants import MATERIAL_COLUMNS
from leadlake.operators import history, publish
from leadlake.operators.merge import COALESCE, FILL, KEEP, OVERWRITE, merge, update_columns
from leadlake.operators.ordered import keep_first, with_position, with_previous


def skewed(spark, n=600):
    """One key holds a third of the rows or more."""
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(40)}", i, rng.choice(["a", "b", None])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "k string, o int, v string")


def test_previous_value_is_exact_however_fine_the_slices(spark):
    rows, df = skewed(spark)
    last, expected = {}, {}
    for k, o, v in sorted(rows, key=lambda r: (r[0], r[1])):
        expected[o] = last.get(k, "none")
        last[k] = v
    for width in (1, 50, 10_000):
        got = with_previous(df, ["k"], ["o"], ["v"], F.floor(F.col("o") / width)).collect()
        assert {r.o: ("none" if r.previous is None else r.previous.v) for r in got} == expected


def test_position_is_exact_however_fine_the_slices(spark):
    rows, df = skewed(spark)
    seen, expected = {}, {}
    for k, o, _ in sorted(rows, key=lambda r: (r[0], r[1])):
        expected[o] = seen.get(k, 0)
        seen[k] = expected[o] + 1
    for width in (1, 50, 10_000):
        got = with_position(df, ["k"], ["o"], F.floor(F.col("o") / width)).collect()
        assert {r.o: r.position for r in got} == expected


def test_keep_first_is_cut_before_the_shuffle(spark):
    _, df = skewed(spark)
    first = keep_first(df, ["k"], [F.desc("o")])
    assert first.count() == df.select("k").distinct().count()
    assert first._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2


def test_catalog_lookup_keeps_every_fact(spark):
    _, df = skewed(spark)
    facts = df.select("o", F.when(F.col("o") % 3 > 0, F.col("k")).alias("normalized_name"))
    aliases = spark.createDataFrame([("hot", "s1"), ("hot", "s0"), ("k1", "")], "raw_name_key string, service_catalog_id string")
    catalog = spark.createDataFrame([("s2", "K1"), ("s3", "hot")], "id string, name string")
    got = publish.with_catalog(facts, aliases, catalog)
    assert got.count() == 600
    assert {(r.normalized_name, r.service_catalog_id) for r in got.collect() if r.service_catalog_id} == {("hot", "s1"), ("k1", "s2")}


def test_merge_rules(spark):
    old = spark.createDataFrame([("a", "o1", "o2", "o3", None, "x"), ("b", "o1", None, None, "o4", "x")],
                                "k string, w string, c string, p string, f string, other string")
    new = spark.createDataFrame([("a", None, None, "n3", "n4", 1), ("a", None, "n2", "m3", "m4", 2), ("a", None, None, "z3", None, 3),
                                 ("c", "n1", "n2", "n3", None, 1), (None, "x", "x", "x", "x", 1)],
                                "k string, w string, c string, p string, f string, o int")
    got = merge(old, new, ["k"], {"w": OVERWRITE, "c": COALESCE, "p": KEEP, "f": FILL}, ["o"], {"other": F.lit("new")})
    assert sorted(map(tuple, got.collect())) == [("a", None, "n2", "o3", "n4", "x"), ("b", "o1", None, None, "o4", "x"), ("c", "n1", "n2", "n3", None, "new")]


def test_stage_columns_only(spark):
    old = spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], "k string, x int, y int")
    got = update_columns(old, spark.createDataFrame([("a", None)], "k string, x int"), ["k"], ["x"])
    assert sorted(map(tuple, got.collect())) == [("a", None, 1), ("b", 2, 2)]


def observations(n, seed, start=0):
    """Random observations of a few offerings; one offering gets a third of them."""
    rng = random.Random(seed)
    rows = []
    for i in range(start, start + n):
        key = "hot" if rng.random() < 0.35 else f"k{rng.randrange(6)}"
        price = rng.choice([10, 10, 20, None])
        status = rng.choice(["published", "published", "pending"])
        rows.append(dict(
            competitor_id=rng.choice(["c1", "c2"]), evidence_page_id=f"e{i}", offering_key=key, offering_type="offer" if key == "k1" else "service",
            display_name=key, qualifier=None, service_catalog_id=None, price_type="fixed", amount_min_minor=price, amount_max_minor=None, currency="USD",
            price_unit="total", package_quantity=None, original_amount_minor=None, valid_from=None, valid_through=None,
            price_display=None if price is None else f"${price}", source_url="u", evidence_text="e", source_fingerprint=f"{key}:{price}",
            last_seen_at=datetime(2026, 1, 1) + timedelta(hours=5 * (i // 4)), run_id=f"r{i // 4:05d}", page_ord=i % 4 // 2, cand_ord=i % 2,
            observed_at=datetime(2026, 1, 1) + timedelta(hours=5 * (i // 4)), publication_status=status,
            review_reason=None if status == "published" else "unknown_currency"))
    return rows


def frame(spark, rows):
    kinds = {f.name: f.dataType.simpleString() for f in [*schemas.OFFERINGS, *schemas.OFFERING_CANDIDATES]}
    kinds |= {"run_id": "string", "page_ord": "int", "cand_ord": "int", "observed_at": "timestamp", "publication_status": "string"}
    return spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{name} {kinds[name]}" for name in rows[0]))


class Replay:
    """The stores, updated one observation after another."""

    def __init__(self):
        self.offerings, self.candidates, self.events, self.log = {}, {}, {}, []

    def run(self, rows):
        for row in sorted(rows, key=lambda r: (r["observed_at"], r["run_id"], r["page_ord"], r["cand_ord"])):
            if row["publication_status"] == "pending":
                stored = self.candidates.get(row["source_fingerprint"])
                if stored is None:
                    self.candidates[row["source_fingerprint"]] = {**row, "first_seen_at": row["observed_at"]}
                else:
                    stored.update(last_seen_at=row["observed_at"], evidence_page_id=row["evidence_page_id"])
                continue
            key = (row["competitor_id"], row["offering_key"])
            before = self.offerings.get(key)
            first = before["first_published_at"] if before else row["observed_at"]
            self.offerings[key] = {**row, "first_published_at": first}
            if before is None:
                kind = "competitor_offer_added" if row["offering_type"] == "offer" else "competitor_offering_added"
            elif any(before[f] != row[f] for f in MATERIAL_COLUMNS):
                kind = "competitor_price_changed"
            else:
                continue
            event = (kind, row["observed_at"], before and before["price_display"], row["price_display"])
            self.events[f"{kind}:{row['source_fingerprint']}"] = event
            self.log.append((row["competitor_id"], row["offering_key"], *event))


def test_change_events_plan(spark):
    stored, published = schemas.empty(spark, schemas.OFFERINGS), frame(spark, observations(5, seed=1))
    plan = history.change_events(stored, published)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 4 and "Broadcast" not in plan


def test_history_equals_a_replay_over_two_batches(spark):
    offerings, candidates, events = (schemas.empty(spark, s) for s in (schemas.OFFERINGS, schemas.OFFERING_CANDIDATES, schemas.PRICE_EVENTS))
    replay = Replay()
    for start, unit in ((0, "MINUTE"), (240, "DAY")):
        rows = observations(240, seed=start + 1, start=start)
        replay.run(rows)
        df = frame(spark, rows)
        published, pending = df.where("publication_status = 'published'"), df.where("publication_status = 'pending'")
        log = history.change_events(offerings, published, F.date_trunc(unit, F.col("observed_at")))
        events = schemas.conform(history.merge_events(events, log), schemas.PRICE_EVENTS)
        new_log = log.collect()
        offerings = spark.createDataFrame(schemas.conform(history.merge_offerings(offerings, published), schemas.OFFERINGS).collect(), schemas.OFFERINGS)
        candidates = spark.createDataFrame(schemas.conform(history.merge_candidates(candidates, pending), schemas.OFFERING_CANDIDATES).collect(),
                                           schemas.OFFERING_CANDIDATES)
        events = spark.createDataFrame(events.collect(), schemas.PRICE_EVENTS)
        got = sorted((r.competitor_id, r.detail.offering_key, r.event_type, r.occurred_at, str(r.detail.old_price), str(r.detail.new_price)) for r in new_log)
        assert got == sorted((a, b, c, d, str(e), str(f)) for a, b, c, d, e, f in replay.log)
        replay.log.clear()
    assert {(r.competitor_id, r.offering_key): (r.amount_min_minor, r.first_published_at, r.last_seen_at, r.evidence_page_id) for r in offerings.collect()} == {
        k: (v["amount_min_minor"], v["first_published_at"], v["observed_at"], v["evidence_page_id"]) for k, v in replay.offerings.items()}
    assert {r.source_fingerprint: (r.first_seen_at, r.last_seen_at, r.evidence_page_id, r.competitor_id) for r in candidates.collect()} == {
        k: (v["first_seen_at"], v["last_seen_at"], v["evidence_page_id"], v["competitor_id"]) for k, v in replay.candidates.items()}
    assert {r.source_fingerprint: (r.event_type, r.occurred_at, r.detail.old_price, r.detail.new_price) for r in events.collect()} == replay.events
