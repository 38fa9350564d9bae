"""Signatures from a table, against a plain search."""

import pytest

from leadlake.operators.signatures import first_signatures
from pyspark.sql import functions as F

TEXTS = [(0, "see vagaro.com/x"), (1, "abcabd"), (2, ""), (3, None), (4, "ünï \U0001f600 café"), (5, "nothing here" * 500 + "blvd.com"), (6, "abcabd")]
TABLE = [("vagaro", "vagaro.com", 3), ("long", "vagaro.com/x", 1), ("ab", "ab", 9), ("abd", "abd", 9), ("copy", "abd", 2), ("face", "\U0001f600 c", 5), ("blvd", "blvd.com", None),
         ("none", None, 0)]


def expected(table):
    rows = [(9e18 if p is None else p, s, name) for name, s, p in table if s is not None]
    out = {}
    for key, text in TEXTS:
        hits = [r for r in rows if text is not None and r[1] in text]
        out[key] = (min(hits)[2], min(hits)[1]) if hits else (None, None)
    return out


def found(spark, table, **options):
    texts = spark.createDataFrame(TEXTS, "id int, text string")
    signatures = spark.createDataFrame(table, "platform string, signature string, priority int")
    result = first_signatures(texts, ["id"], F.col("text"), signatures, **options)
    return result, {r.id: (r.platform, r.signature) for r in result.collect()}


@pytest.mark.parametrize("table", [TABLE, TABLE + [("any", "", 4)], []])
def test_least_priority_wins_in_one_part_and_in_many(spark, table):
    assert found(spark, table)[1] == found(spark, table, part_bytes=4)[1] == expected(table)


def test_ten_thousand_signatures_in_one_pass(spark):
    table = [(f"p{i}", f"sign{i:05d}", i) for i in range(10_000)] + TABLE
    result, rows = found(spark, table)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert rows == expected(table) and plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan
