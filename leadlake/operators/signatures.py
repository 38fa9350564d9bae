"""Signatures kept as a table: which of them a text holds, found in one pass over the text whatever their number."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Signatures that one search may hold, in UTF-8 bytes. A larger table is searched in parts, each in tasks of its own.
PART_BYTES = 2 * 1024 * 1024
_HIT = T.StructType([T.StructField("priority", T.LongType()), T.StructField("signature", T.StringType()), T.StructField("platform", T.StringType())])
_HIT_ARROW = pa.struct([("priority", pa.int64()), ("signature", pa.string()), ("platform", pa.string())])
_LAST = 2**63 - 1


class _Search:
    """Finds the first of some signatures, given in order, that occurs in a text."""

    def __init__(self, signatures: list[str]) -> None:
        self.always = signatures.index("") if "" in signatures else None
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for place, signature in enumerate(signatures):
            if signature:
                self.automaton.add_word(signature, place)
        if len(self.automaton):
            self.automaton.make_automaton()

    def first(self, text: str | None) -> int | None:
        if text is None:
            return None
        best = self.always
        if len(self.automaton):
            for _, place in self.automaton.iter(text):
                if best is None or place < best:
                    best = place
                    if not best:
                        break
        return best


def _searching(spark: SparkSession, hits: list[dict]):
    """Arrow function from texts to their first hit; the search is built once per task from the shipped signatures."""
    shipped = spark.sparkContext.broadcast(hits)

    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shipped.value
        search = _Search([hit["signature"] for hit in known])
        for batch in batches:
            places = (search.first(text.as_py()) for text in batch)
            yield pa.array([None if place is None else known[place] for place in places], _HIT_ARROW)

    return F.arrow_udf(find, _HIT).asNondeterministic()


def first_signatures(texts: DataFrame, keys: Sequence[str], text: Column, signatures: DataFrame,
                     part_bytes: int = PART_BYTES) -> DataFrame:
    """For every row of `texts`: its keys, and platform and signature of the hit of least priority; both NULL without a hit.

    `signatures`: platform, signature, priority. Letters count as written, so pass lowered texts with lowered signatures. Equal
    priorities are decided by the signature, then by the platform; a NULL priority comes last, a NULL signature matches nothing,
    an empty one matches every text that is not NULL. `keys` tell the rows apart.

    The table's size is measured first. Up to `part_bytes` the plan is one pass without a shuffle. Beyond, the table is cut by
    hash into parts of about that size, every part is one pass, and the least hit per row is kept.
    """
    ranked = F.struct(F.coalesce(F.col("priority").cast("long"), F.lit(_LAST)).alias("priority"), F.col("platform"))
    known = signatures.where(F.col("signature").isNotNull()).groupBy("signature").agg(F.min(ranked).alias("best")).select(
        "best.priority", "signature", "best.platform")
    size = known.agg(F.sum(F.octet_length("signature").cast("long"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))

    def one_pass(part: int) -> DataFrame:
        inside = known.where(F.pmod(F.xxhash64("signature"), F.lit(parts)) == part).collect()
        hits = sorted((row.asDict() for row in inside), key=lambda hit: (hit["priority"], hit["signature"]))
        return texts.select(*keys, _searching(texts.sparkSession, hits)(text).alias("_hit"))

    found = reduce(DataFrame.unionAll, map(one_pass, range(parts)))
    if parts > 1:
        found = found.groupBy(*keys).agg(F.min("_hit").alias("_hit"))
    return found.select(*keys, "_hit.platform", "_hit.signature")
