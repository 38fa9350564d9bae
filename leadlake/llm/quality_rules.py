"""Quality rules: word, line and repeat counts, and the distance of a text's histograms from those of ordinary text in a language."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import free, let, text_of

SPACE = r"[ \t-\r]+"
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50

# Shares of character classes (of the characters in words; digits stand for data, not for prose, and are left out) and of the commonest words in ordinary text, by language.
CLASSES = ("lower", "upper", "symbol", "punct", "wide")
REFERENCES = {
    "en": ((0.954, 0.017, 0.000, 0.028, 0.000),
           {"the": 0.050, "of": 0.026, "and": 0.021, "to": 0.016, "a": 0.013, "in": 0.011, "is": 0.010, "that": 0.009, "it": 0.007, "for": 0.007, "was": 0.006, "on": 0.006}),
    "de": ((0.914, 0.015, 0.000, 0.026, 0.044),
           {"der": 0.050, "die": 0.026, "und": 0.021, "in": 0.015, "den": 0.013, "von": 0.011, "zu": 0.009, "das": 0.009, "mit": 0.007, "sich": 0.007, "des": 0.006, "auf": 0.006}),
    "fr": ((0.849, 0.013, 0.000, 0.029, 0.108),
           {"de": 0.051, "la": 0.027, "le": 0.020, "et": 0.016, "les": 0.013, "des": 0.011, "en": 0.010, "un": 0.009, "du": 0.007, "une": 0.007, "que": 0.006, "pour": 0.006}),
    "es": ((0.864, 0.014, 0.000, 0.028, 0.093),
           {"de": 0.051, "la": 0.026, "que": 0.020, "el": 0.015, "en": 0.013, "y": 0.011, "los": 0.010, "se": 0.008, "las": 0.007, "del": 0.007, "por": 0.006, "un": 0.006}),
}
# Largest distances (0 to 1) of a kept text, and the least words below which a histogram says too little to judge by.
MAX_CLASS_DISTANCE, MIN_CLASS_WORDS = 0.16, 50
MAX_WORD_DISTANCE, MIN_WORD_WORDS = 0.22, 150
_FEW = 64


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text, first occurrence included; a word counts once."""
    def covered(places: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        grow = lambda a, p: F.struct((a["n"] + p + 3 - F.greatest(a["end"], p)).alias("n"), (p + 3).alias("end"))
        return F.aggregate(places, start, grow, lambda a: a["n"])

    def few(hashes: Column, twice: Column) -> Column:
        return covered(F.filter(F.transform(hashes, lambda h, i: F.when(F.array_contains(twice, h), i)), lambda i: i.isNotNull()))

    def many(hashes: Column) -> Column:
        by_hash = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = lambda s, a, b: F.coalesce(F.get(s, a)["h"] == F.get(s, b)["h"], F.lit(False))
        places = let(by_hash, lambda s: F.filter(F.transform(s, lambda x, k: F.when(same(s, k, k - 1) | same(s, k, k + 1), x["i"])), lambda i: i.isNotNull()))
        return covered(F.sort_array(places))

    def of(hashes: Column) -> Column:
        in_order = lambda s: F.array_distinct(F.filter(s, lambda h, k: (k > 0) & (h == F.get(s, k - 1))))
        marked = let(let(F.sort_array(hashes), in_order), lambda twice: F.when(F.size(twice) <= _FEW, few(hashes, twice)).otherwise(many(hashes)))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(marked)

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))
    return F.when(F.size(words) < 4, 0).otherwise(let(windows, of))


def distance(counts: Column, shares: Column) -> Column:
    """Jensen-Shannon distance (0 to 1) of a histogram of counts from reference shares."""
    def part(p: Column, q: Column) -> Column:
        middle = (p + q) / 2
        term = lambda x: F.when(x > 0, x * F.log2(x / middle)).otherwise(0.0)
        return (term(p) + term(q)) / 2

    def of(total: Column) -> Column:
        return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(F.zip_with(counts, shares, lambda c, q: part(c / total, q)), F.lit(0.0), lambda a, x: a + x)))

    return let(F.greatest(F.lit(1.0), F.aggregate(counts, F.lit(0.0), lambda a, c: a + c)), of)


def _references() -> Column:
    """The references as one constant: lists of {classes, words, shares}, the last share being that of all other words."""
    def numbers(values) -> Column:
        return F.array(*(F.lit(float(v)) for v in values))

    return F.array(*(F.struct(numbers(classes).alias("classes"), F.array(*map(F.lit, common)).alias("words"), numbers([*common.values(), 1 - sum(common.values())]).alias("shares"))
                     for classes, common in REFERENCES.values()))


def text_counts(text: Column) -> Column:
    """One struct of all counts of a text; words are cut once."""
    outside = F.regexp_replace(text, r"[a-z \t-\r]++", "")  # what remains is short in ordinary text
    without = lambda t, chars: F.char_length(t) - F.char_length(F.regexp_replace(t, chars, ""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^ \t-\r]"))
    common = sorted({w for _, words in REFERENCES.values() for w in words})

    def of(w: Column) -> Column:
        return F.struct(
            F.size(w).alias("n_words"),
            F.aggregate(w, F.lit(0), lambda a, x: a + F.char_length(x)).alias("word_chars"),
            repeat_words(w).alias("n_repeat_words"),
            F.filter(w, lambda x: x.isin(common)).alias("common"),
            let(outside, lambda o: F.struct(without(o, SYMBOLS).alias("symbol"), without(o, "[A-Z]").alias("upper"), without(o, "[0-9]").alias("digit"), without(o, r"[^\x00-\x7F]+").alias("wide"), F.char_length(o).alias("all"))).alias("other"),
            let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found))).alias("n_dup_lines"))

    return let(words_of(text), of)


def judge(docs: DataFrame) -> DataFrame:
    """Every row of `docs` with its counts, `base_failed`, both distances and `kept`.

    Rows are judged one by one. Null, empty and blank texts have no words: all counts 0, base_failed true, kept false. The distances are
    those of the nearest reference; a text too short for a histogram is not judged by it. Input columns named like a result are replaced.
    """
    def nearest(c: Column) -> Column:
        o = c["other"]
        classes = F.array(*(x.cast("double") for x in (c["word_chars"] - o["all"], o["upper"], o["symbol"], o["all"] - o["upper"] - o["digit"] - o["symbol"] - o["wide"], o["wide"])))

        def against(r: Column) -> Column:
            own = F.transform(r["words"], lambda v: F.size(F.filter(c["common"], lambda w: w == v)).cast("double"))
            counts = let(own, lambda n: F.concat(n, F.array(c["n_words"] - F.aggregate(n, F.lit(0.0), lambda a, x: a + x))))
            return F.struct(F.when(c["n_words"] >= MIN_WORD_WORDS, distance(counts, r["shares"])).otherwise(0.0).alias("word_distance"),
                            F.when(c["n_words"] >= MIN_CLASS_WORDS, distance(classes, r["classes"])).otherwise(0.0).alias("class_distance"))

        return F.array_min(F.transform(_references(), against))

    counts_at, nearest_at = free("_c", docs), free("_d", docs)
    counted = docs.withColumn(counts_at, text_counts(text_of(docs)))
    c = F.col(counts_at)
    failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
    named = counted.withColumns({
        **{n: c[n].cast("long") for n in ("n_words", "word_chars", "n_dup_lines", "n_repeat_words")}, "n_symbols": c["other"]["symbol"].cast("long"),
        "base_failed": failed, nearest_at: F.when(~failed, let(c, nearest))})
    d = F.col(nearest_at)
    kept = F.coalesce((d["class_distance"] <= MAX_CLASS_DISTANCE) & (d["word_distance"] <= MAX_WORD_DISTANCE), F.lit(False))
    return named.withColumns({"kept": kept, "class_distance": d["class_distance"], "word_distance": d["word_distance"]}).drop(counts_at, nearest_at)


def digest(docs: DataFrame) -> DataFrame:
    return judge(docs.select("doc_id", "text")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance")
