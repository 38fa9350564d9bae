"""Language by rank-order profiles: the commonest letter n-grams of a text against those of each language, by out-of-place distance."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadlake.llm.common import free, held_out, text_of

TOP = 300
UNKNOWN = "und"
# A text further from its language than OWN_SHARE of that language's labelled rows, by HEADROOM of the way to the largest distance, is not recognised.
# Where no labelled row can be measured, MAX_REJECT_DISTANCE holds.
OWN_SHARE, HEADROOM, MAX_REJECT_DISTANCE = 0.95, 0.4, 0.97
SHARPNESS = 25.0

# A 1-, 2- or 3-gram is one number of three 21-bit code points: (a, b, c), (a, edge, b) or (none, edge, a). A word's edge is 0; a 3-gram's middle is a letter.
_BITS, _NONE = 21, 0x1FFFFF
# Different n-grams that a task counts before it hands them on.
_FLUSH_GRAMS = 1 << 20


def _letter_table() -> np.ndarray:
    """Each code point that is a letter, 0 for all others."""
    points = np.arange(0x110000, dtype=np.uint32)
    return np.where(np.char.isalpha(points.view("U1")), points, 0).astype(np.int64)


def _grams(text: str, table: np.ndarray) -> np.ndarray:
    """Codes of all 1-, 2- and 3-grams of the lower-cased text; those that hold only an edge are left out."""
    points = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    s = table[points]
    pair, triple = s[:-1] << 2 * _BITS | s[1:], s[:-2] << 2 * _BITS | s[1:-1] << _BITS | s[2:]
    return np.concatenate((triple[s[1:-1] > 0], pair[pair > 0], _NONE << 2 * _BITS | s[s > 0]))


def _ranked(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The TOP codes by count, ties by code."""
    if len(codes) > 4 * TOP:
        floor = np.partition(counts, len(counts) - TOP)[len(counts) - TOP]
        codes, counts = codes[counts >= floor], counts[counts >= floor]
    return codes[np.lexsort((codes, -counts))[:TOP]]


def learn_profiles(docs: DataFrame) -> dict[str, list[int]]:
    """TOP n-gram codes of each language, commonest first, from all rows with a language that are not held out.

    Counts add up inside a task and then by (language, n-gram), so no language's rows meet in one task. The first TOP codes a language reach the driver.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, sums, size = _letter_table(), {}, 0
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                for text in texts:
                    codes, counts = np.unique(_grams(text, table), return_counts=True)
                    sums.setdefault(lang, []).append((codes, counts))
                    size += len(codes)
                    if size > _FLUSH_GRAMS:
                        sums = {k: [_summed(v)] for k, v in sums.items()}
                        size = sum(len(v[0][0]) for v in sums.values())
                        if size > _FLUSH_GRAMS // 2:
                            yield from _frames(sums)
                            sums, size = {}, 0
        yield from _frames({k: [_summed(v)] for k, v in sums.items()})

    rows = _training(docs).select(F.col("lang").cast("string"), text_of(docs).alias("text"))
    totals = rows.mapInPandas(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    profiles: dict[str, list[int]] = {}
    for r in totals.withColumn("place", place).where(F.col("place") <= TOP).orderBy("lang", "place").collect():
        profiles.setdefault(r["lang"], []).append(r["code"])
    return profiles


def _training(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of equal codes added up."""
    codes, back = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    sums = np.zeros(len(codes), np.int64)
    np.add.at(sums, back, np.concatenate([n for _, n in parts]))
    return codes, sums


def _frames(sums: dict[str, list[tuple[np.ndarray, np.ndarray]]]) -> Iterator[pd.DataFrame]:
    for lang, [(codes, counts)] in sums.items():
        yield pd.DataFrame({"lang": lang, "code": codes, "n": counts})


def learn_limits(docs: DataFrame) -> dict[str, float]:
    """The largest `lang_distance` of a recognised text, by language, from all rows with a language that are not held out.

    The rows are split in halves by a hash of the id and each half is measured against the profiles of the other, since a profile is nearer to the rows
    it was learned from. Rows that are nearer to another language are not counted. Counts by thousandths of the distance reach the driver.
    """
    half = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(2))
    counts: dict[str, Counter] = {}
    for side in (0, 1):
        own, known = _training(docs).where(half == side), learn_profiles(docs.where(half != side))
        measured = predict(own.select(F.col("lang").cast("string"), "text"), known).where("lang = lang_pred")
        for r in measured.groupBy("lang", F.ceil(F.col("lang_distance") * 1000).alias("step")).count().collect():
            counts.setdefault(r["lang"], Counter())[r["step"]] += r["count"]
    limits = {}
    for lang, steps in counts.items():
        order = sorted(steps)
        inside = np.cumsum([steps[x] for x in order])
        own_distance = order[int(np.searchsorted(inside, OWN_SHARE * inside[-1]))] / 1000
        limits[lang] = own_distance + HEADROOM * (1 - own_distance)
    return limits


def predict(docs: DataFrame, profiles: dict[str, list[int]]) -> DataFrame:
    """Every row of `docs` with `lang_pred`, `score` (0 to 1) and `lang_distance` (share of the largest out-of-place distance).

    A text that is null or has no letter, or any text where nothing was learned, is `und` with score 0 and distance 1. Equal distances go to the
    language first in order. Rows are judged one by one, so repeated rows and ids keep their results; input columns of these names are replaced.
    """
    languages = sorted(profiles)
    schema = "struct<lang_pred:string,score:double,lang_distance:double>"

    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = _letter_table()
        known = np.unique(np.concatenate([np.array(profiles[lang], np.int64) for lang in languages] or [np.empty(0, np.int64)]))
        places = np.full((len(languages), len(known) + 1), TOP, np.int32)  # the last column is that of codes in no profile
        for row, lang in enumerate(languages):
            places[row, np.searchsorted(known, profiles[lang])] = np.arange(len(profiles[lang]))
        for texts in batches:
            out = []
            for text in texts:
                codes = _grams(text, table) if languages else np.empty(0, np.int64)
                if not len(codes):
                    out.append((UNKNOWN, 0.0, 1.0))
                    continue
                top = _ranked(*np.unique(codes, return_counts=True))
                at = np.minimum(np.searchsorted(known, top), len(known) - 1)
                place = places[:, np.where(known[at] == top, at, len(known))]
                far = np.abs(place - np.arange(len(top)))
                far[place == TOP] = TOP
                share = far.sum(axis=1) / (TOP * len(top))
                best = int(share.argmin())
                out.append((languages[best], float(1 / np.exp(-SHARPNESS * (share - share[best])).sum()), float(share[best])))
            yield pd.DataFrame(out, columns=["lang_pred", "score", "lang_distance"])

    guess = F.pandas_udf(judged, schema)
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "lang_distance")]
    at = free("_guess", docs)
    return docs.select(*names, guess(text_of(docs)).alias(at)).select(*names, f"{at}.lang_pred", f"{at}.score", f"{at}.lang_distance")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    learned = learn_profiles(docs)
    return predict(docs.select("doc_id", "text"), learned).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "lang_distance")


def accepted(docs: DataFrame) -> DataFrame:
    """The rows whose language is recognised: texts without letters, or far from every profile, go. Columns stay as they are."""
    names = docs.columns
    plain = docs.withColumnsRenamed({c: f"in_{i}" for i, c in enumerate(names)}).withColumn("text", F.col(f"in_{names.index('text')}"))
    judged = predict(plain, learn_profiles(docs))
    limits = [F.lit(x) for pair in sorted(learn_limits(docs).items()) for x in pair]
    limit = F.coalesce(F.create_map(*limits)[F.col("lang_pred")], F.lit(MAX_REJECT_DISTANCE)) if limits else F.lit(MAX_REJECT_DISTANCE)
    kept = judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("lang_distance") <= limit))
    return kept.select(*(F.col(f"in_{i}").alias(c) for i, c in enumerate(names)))
