"""Bounds of what reaches the driver, and hits of windows that many items share."""

import hashlib

from leadlake.llm import common, decontam


def test_sample_keeps_its_bounds(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)] + [(1, "text 1")] * 1000 + [(2, f"other {i}") for i in range(1000)] + [(3, "x" * 5000), (6, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 1)] * 1000 + [(4, None)], "doc_id long, toxic int")

    def sample(rows, size):
        return [(r["text"], r["toxic"]) for r in common.labelled_sample(docs, labels, "toxic", rows, size).collect()]

    whole = sample(5000, 10**6)
    learned = {r["doc_id"] for r in labels.where(~common.held_out(labels["doc_id"])).select("doc_id").distinct().collect()}
    assert whole.count(("text 1", 1)) == (1 in learned) and len(whole) == len(set(whole))
    assert {t for t, _ in whole if t.startswith("text")} == {f"text {i}" for i in learned}
    assert len(sample(12, 10**6)) == 12 and sample(12, 10**6) == whole[:12]
    few = sample(5000, 1000)
    assert few and sum(len(t) for t, _ in few) <= 1000 and max(len(t) for t, _ in few) <= 10
    assert ("x" * 5000, 1) not in sample(5000, 10**5)


def test_a_window_of_many_items_is_not_multiplied(spark):
    passage = " ".join(f"word{i}" for i in range(14))
    items = spark.createDataFrame([(i, f"{passage} tail{i} a b c d e f g h i j") for i in range(400)] + [(400, passage), (None, passage)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"start{i} {passage} end{i}") for i in range(300)] + [(300, "none"), (None, passage)], "doc_id long, text string")
    runs, owners, _, _ = decontam.item_tables(items)
    shared = runs.where(runs["run"].startswith("word0 ")).collect()
    assert len(shared) == 1 and runs.select("run").distinct().count() == runs.count()
    rows = decontam.digest(docs, items).collect()
    digest = hashlib.sha256(",".join(sorted(str(i) for i in range(401))).encode()).hexdigest()
    assert len(rows) == 302
    for row in rows:
        assert (row["n_hit"], row["n_items"]) == ((0, 0) if row["doc_id"] == 300 else (14, 401))
        assert row["doc_id"] == 300 or row["items_sha256"] == digest
