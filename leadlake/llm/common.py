"""Column and session helpers shared by the training-text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlake.session import shared_folder  # also for the operators that store files

SPAN = "struct<start:int,end:int,hit:string>"
_BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` worked out once, however often the body names it."""
    return F.transform(F.array(value), body).getItem(0)


def free(name: str, docs: DataFrame) -> str:
    """The name, or one like it that no column of `docs` has."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def text_of(docs: DataFrame) -> Column:
    """The text column; null reads as the empty text."""
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def held_out(doc_id: Column) -> Column:
    """True for the rows no label may be learned from: crc32 of the id as text divides by five. A null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, most_bytes: int) -> DataFrame:
    """(text, label): at most `rows` labelled rows that are not held out, the first by a hash of the id, with texts of at most `most_bytes` together.

    Rows without a label are left out; rows repeated in either table count once. A text that alone takes more than a hundredth of `most_bytes` is not
    learned from, so no text can use up the bound. Texts are fetched last, for the rows chosen by small ones.
    """
    known = labels.where(F.col(label).isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", F.col(label).cast("int").alias(label)).distinct()
    first = known.orderBy(F.xxhash64("doc_id"), "doc_id", label).limit(rows)
    near = docs.select("doc_id", text_of(docs).alias("text")).join(F.broadcast(first), "doc_id").withColumns(
        {"_hash": F.xxhash64("text"), "_size": F.octet_length("text").cast("long")})
    keys = ["doc_id", label, "_hash"]
    order = [F.xxhash64("doc_id"), *map(F.col, keys)]
    small = near.where(F.col("_size") <= most_bytes // 100).select(*keys, "_size").distinct().orderBy(*order).limit(rows)
    # The running size has no partition, but at most `rows` small rows.
    so_far = F.sum("_size").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    chosen = small.withColumn("_sum", so_far).where(F.col("_sum") <= most_bytes).select(*keys)
    return near.join(F.broadcast(chosen), keys).groupBy(*keys).agg(F.first("text").alias("text")).orderBy(*order).select("text", label)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def _running(values: Column) -> Column:
    """{before: sums of the values ahead of each one, total: the sum of all}; quadratic, so for short arrays only."""
    start = F.struct(F.array().cast("array<int>").alias("before"), F.lit(0).alias("total"))
    return F.aggregate(values, start, lambda a, x: F.struct(F.array_append(a["before"], a["total"]).alias("before"), (a["total"] + x).alias("total")))


def sums_before(values: Column) -> Column:
    """For each int of an array the sum of those before it: short blocks first, then the blocks' totals, so long arrays stay cheap."""
    def blocks(v: Column) -> Column:
        first = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(v) - 1), F.lit(_BLOCK))
        return F.transform(first, lambda b: _running(F.slice(v, b + 1, F.lit(_BLOCK))))

    def joined(parts: Column) -> Column:
        offsets = _running(F.transform(parts, lambda p: p["total"]))["before"]
        return F.flatten(F.zip_with(parts, offsets, lambda p, o: F.transform(p["before"], lambda x: x + o)))

    return let(let(values, blocks), joined)


def regex_spans(text: Column, pattern: str) -> Column:
    """Matches of a pattern, leftmost and non-overlapping, as {start, end, hit} in code points, end exclusive.

    The text between matches and the matches themselves come from two built-in functions; their lengths add up to places.
    """
    def placed(p: Column) -> Column:
        steps = F.zip_with(p["gaps"], p["hits"], lambda g, h: F.char_length(g) + F.coalesce(F.char_length(h), F.lit(0)))
        return let(sums_before(steps), lambda before: F.transform(p["hits"], lambda h, i: let(
            before[i] + F.char_length(p["gaps"][i]), lambda s: F.struct(s.alias("start"), (s + F.char_length(h)).alias("end"), h.alias("hit")))))

    pieces = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))
    return let(pieces, placed)


def guarded_spans(text: Column, pattern: str, guard: Column, keep: Callable[[Column], Column] | None = None) -> Column:
    """`regex_spans` on texts that pass a cheap necessary condition, none elsewhere; `keep` judges each match."""
    spans = regex_spans(text, pattern)
    if keep is not None:
        spans = F.filter(spans, lambda s: keep(s["hit"]))
    return F.coalesce(F.when(guard, spans), F.array().cast(f"array<{SPAN}>"))


def labelled(spans: Column, kind: str, order: int, score: Column | Callable[[Column], Column]) -> Column:
    """Spans with their kind, its rank among kinds that start together, and a score."""
    value = score if callable(score) else lambda s: score
    return F.transform(spans, lambda s: F.struct(s["start"], F.lit(order).alias("rank"), s["end"], F.lit(kind).alias("kind"), value(s).alias("score")))


def written(spans: Column) -> Column:
    """kind:start:end by start and then kind, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
