"""Benchmark decontamination by winnowing: documents that share a fingerprint with an item are found first, then their hits are laid out exactly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import checkpointed, free, let, text_of

WINDOW_WORDS = 10
# Hashes of GRAM_WORDS words; of every SPAN neighbouring ones the smallest is kept. GRAM_WORDS + SPAN - 1 = WINDOW_WORDS, so any shared window
# shares a kept hash.
GRAM_WORDS = 5
SPAN = WINDOW_WORDS - GRAM_WORDS + 1
_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    """Words of digits, letters and all characters beyond ASCII; only A-Z are lower-cased."""
    lowered = lambda w: F.when(F.octet_length(w) == F.char_length(w), F.lower(w)).otherwise(F.translate(w, _UPPER, _UPPER.lower()))
    return F.transform(F.filter(F.split(text, _SEPARATORS), lambda w: w != ""), lowered)


def fingerprints(words: Column) -> Column:
    """The kept hashes of a list of words; none if it is shorter than a window."""
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - GRAM_WORDS), lambda i: F.xxhash64(*(words[i + k] for k in range(GRAM_WORDS))))
    smallest = lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - SPAN), lambda i: F.least(*(h[i + k] for k in range(SPAN))))
    return F.when(F.size(words) >= WINDOW_WORDS, F.array_distinct(let(hashes, smallest))).otherwise(F.array().cast("array<long>"))


def windows(words: Column, n: Column) -> Column:
    """All runs of n words as {at, n, run}."""
    places = F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.struct(i.alias("at"), n.alias("n"), F.array_join(F.slice(words, i + 1, n), " ").alias("run")))


def _anchor(words: Column) -> Column:
    """The longest word (the last in order among equals): one that an occurrence of a short item must hold."""
    return F.array_max(F.transform(words, lambda w: F.struct(F.char_length(w).alias("size"), w.alias("word"))))["word"]


def item_tables(items: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, bool]:
    """({run, n, owners}, {owners, item}, {mark, n}, whether short items exist): the windows to find, the items that share a set of owners, and the
    marks a document must hold to be a candidate.

    Neighbouring windows mostly have the same owners. A hit carries the digest of its set alone, so a window of many items is not multiplied by them.
    """
    cut = checkpointed(items.select("item_id", words_of(text_of(items)).alias("words")).where(F.size("words") > 0))
    n = F.least(F.lit(WINDOW_WORDS), F.size("words"))
    runs = cut.select("item_id", F.explode(windows(F.col("words"), n)).alias("w")).groupBy("w.run", "w.n").agg(
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    runs = checkpointed(runs.withColumn("owners", F.sha2(F.to_json("items"), 256)))
    owners = runs.groupBy("owners").agg(F.first("items").alias("items")).select("owners", F.explode("items").alias("item"))
    long_marks = cut.select(F.explode(fingerprints(F.col("words"))).alias("mark"), F.lit(WINDOW_WORDS).alias("n"))
    short = cut.where(F.size("words") < WINDOW_WORDS)
    short_marks = short.select(F.xxhash64(_anchor(F.col("words"))).alias("mark"), F.size("words").alias("n"))
    return runs.select("run", "n", "owners"), owners, long_marks.unionByName(short_marks).distinct(), not short.isEmpty()


def find_hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """For every row of `docs`: doc_id, n_words, n_hit, n_items, items (sorted ids as strings) and contaminated.

    Null, empty and wordless texts have no words and no hits. Rows are told apart by id and text, so repeated rows keep a result each. Items without
    words match nothing; items without an id make hits but are not counted or listed; repeated items count once by id. Without items nothing hits.
    """
    runs, owners, marks, shorts = item_tables(items)
    base = docs.select("doc_id", text_of(docs).alias("text")).withColumn("text_hash", F.xxhash64("text"))

    def scanned(words: Column) -> Column:
        kept = fingerprints(words)
        if shorts:
            kept = F.concat(kept, F.array_distinct(F.transform(words, lambda w: F.xxhash64(w))))
        return F.struct(F.size(words).cast("long").alias("n_words"), kept.alias("marks"))

    scan = checkpointed(base.select("doc_id", "text_hash", let(words_of(F.col("text")), scanned).alias("s")).select("doc_id", "text_hash", "s.n_words", "s.marks"))
    shared = scan.select("doc_id", "text_hash", F.explode("marks").alias("mark")).join(marks, "mark")
    wanted = shared.groupBy("doc_id", "text_hash").agg(F.collect_set("n").alias("sizes")).withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    same = lambda a, b: a["doc_id"].eqNullSafe(b["_id"]) & (a["text_hash"] == b["_hash"])

    near = base.join(wanted, same(base, wanted)).dropDuplicates(["_id", "_hash"])
    cut = let(words_of(F.col("text")), lambda words: F.flatten(F.transform(F.col("sizes"), lambda n: windows(words, n))))
    found = near.select("_id", "_hash", F.explode(cut).alias("w")).select("_id", "_hash", "w.at", "w.n", "w.run").join(runs, ["run", "n"])

    def covered(places: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        grow = lambda a, p: F.struct((a["n"] + F.greatest(F.lit(0), p["at"] + p["n"] - F.greatest(a["end"], p["at"]))).alias("n"), F.greatest(a["end"], p["at"] + p["n"]).alias("end"))
        return F.aggregate(places, start, grow, lambda a: a["n"]).cast("long")

    placed = checkpointed(found.groupBy("_id", "_hash").agg(covered(F.sort_array(F.collect_set(F.struct("at", "n")))).alias("n_hit"), F.collect_set("owners").alias("sets")))
    listed = placed.select("_id", "_hash", F.explode("sets").alias("owners")).join(owners, "owners").groupBy("_id", "_hash").agg(F.sort_array(F.collect_set("item")).alias("items"))
    listed = listed.withColumnsRenamed({"_id": "_of_id", "_hash": "_of_hash"})
    own = placed["_id"].eqNullSafe(listed["_of_id"]) & (placed["_hash"] == listed["_of_hash"])
    hits = placed.join(listed, own, "left").select("_id", "_hash", "n_hit", "items")
    joined = scan.join(hits, same(scan, hits), "left")
    none = F.array().cast("array<string>")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    listed = F.coalesce("items", none)
    return joined.select("doc_id", "text_hash", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"), listed.alias("items"), (n_hit > 0).alias("contaminated"))


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = find_hits(docs, items)
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `docs` with no hit. Columns stay as they are."""
    bad = find_hits(docs, items).where("contaminated").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    row_hash = free("_row_hash", docs)
    hashed = docs.withColumn(row_hash, F.xxhash64(text_of(docs)))
    kept = hashed.join(bad, hashed["doc_id"].eqNullSafe(bad["_id"]) & (hashed[row_hash] == bad["_hash"]), "left_anti")
    return kept.select(*docs.columns)
