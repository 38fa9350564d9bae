"""Quality by a sparse rule ensemble: paths of small trees over text statistics become rules, a lasso logistic fit keeps few, and they run as columns."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import free, held_out, labelled_sample, let, text_of

# Labelled rows the rules are fitted on, at most: the first by a hash of the id.
SAMPLE_ROWS = 20_000
# Bytes of their texts, at most; see `labelled_sample`.
SAMPLE_BYTES = 128 * 1024 * 1024
TREES, DEPTH, MIN_LEAF, ROWS_A_TREE, CUTS = 60, 3, 10, 0.5, 24
PENALTY, STEPS = 0.002, 800
SEED = 7

# Statistics of a text, each a rate or a logarithm so that texts of all lengths compare.
STATISTICS = ("log_words", "word_size", "symbol_rate", "upper_rate", "digit_rate", "mark_rate", "shout_rate", "pipe_rate", "distinct_rate", "repeat_line_rate", "common_rate",
              "stop_rate", "wide_rate", "words_a_line")
# Very common words of the languages at hand.
COMMON = ("the", "of", "and", "to", "in", "is", "that", "it", "for", "der", "die", "und", "den", "von", "zu", "das", "mit", "de", "la", "le", "et", "les", "des", "en", "que",
          "el", "y", "los", "se", "las")


def statistics(text: Column) -> Column:
    """One struct of STATISTICS; all but log_words are 0 for a text without words."""
    outside = F.regexp_replace(text, r"[a-z \t-\r]++", "")
    without = lambda t, chars: (F.char_length(t) - F.char_length(F.regexp_replace(t, chars, ""))).cast("double")
    lines = F.filter(F.split(text, "\n"), lambda line: line != "")

    def of(words: Column, o: Column, found: Column) -> Column:
        n = F.greatest(F.size(words), F.lit(1)).cast("double")
        chars = F.greatest(F.char_length(text), F.lit(1)).cast("double")
        n_lines = F.greatest(F.size(found), F.lit(1)).cast("double")
        values = {
            "log_words": F.log1p(F.size(words).cast("double")),
            "word_size": F.aggregate(words, F.lit(0), lambda a, w: a + F.char_length(w)) / n,
            "symbol_rate": without(o, "[#*$%&|<>]") / n,
            "upper_rate": without(o, "[A-Z]") / chars,
            "digit_rate": without(o, "[0-9]") / chars,
            "mark_rate": without(o, r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]") / n,
            "shout_rate": without(o, "!") / n,
            "pipe_rate": without(o, r"\|") / n,
            "distinct_rate": F.size(F.array_distinct(words)) / n,
            "repeat_line_rate": (F.size(found) - F.size(F.array_distinct(found))) / n_lines,
            "common_rate": F.size(F.filter(words, lambda w: w.isin(list(COMMON)))) / n,
            "stop_rate": without(o, "[.]") / n,
            "wide_rate": without(o, r"[^\x00-\x7F]+") / chars,
            "words_a_line": F.log1p(F.size(words) / n_lines),
        }
        return F.struct(*(values[k].cast("double").alias(k) for k in STATISTICS))

    words = F.filter(F.split(text, r"[ \t-\r]+"), lambda w: w != "")
    return let(F.struct(words.alias("w"), outside.alias("o"), lines.alias("l")), lambda p: of(p["w"], p["o"], p["l"]))


@dataclass(frozen=True)
class Rule:
    """A conjunction of conditions (statistic, is it above, threshold) and its weight."""

    conditions: tuple[tuple[int, bool, float], ...]
    weight: float = 0.0

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for at, above, cut in self.conditions:
            out &= (x[:, at] > cut) == above
        return out

    def column(self, stats: Column) -> Column:
        out = F.lit(True)
        for at, above, cut in self.conditions:
            value = stats[STATISTICS[at]]
            out = out & (value > cut if above else value <= cut)
        return out


def _grow(x: np.ndarray, y: np.ndarray, rows: np.ndarray, path: tuple, depth: int, chosen: np.random.Generator, out: set) -> None:
    """Add every path of a regression tree on the rows; each split looks at a random half of the statistics."""
    if path:
        out.add(path)
    if depth == 0 or len(rows) < 2 * MIN_LEAF or y[rows].std() < 1e-9:
        return
    best = (0.0, None)
    for at in sorted(chosen.choice(x.shape[1], -(-x.shape[1] // 2), replace=False)):
        values = x[rows, at]
        for cut in np.unique(np.quantile(values, np.linspace(0.02, 0.98, CUTS))):
            above = values > cut
            n = int(above.sum())
            if min(n, len(rows) - n) < MIN_LEAF:
                continue
            gain = n * (len(rows) - n) / len(rows) * (y[rows][above].mean() - y[rows][~above].mean()) ** 2
            if gain > best[0] + 1e-12:
                best = (gain, (int(at), float(cut)))
    if best[1] is None:
        return
    at, cut = best[1]
    above = x[rows, at] > cut
    for side in (True, False):
        _grow(x, y, rows[above == side], (*path, (at, side, cut)), depth - 1, chosen, out)


def tree_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """The paths of TREES boosted trees, each on a random part of the rows, as rules without weights."""
    chosen = np.random.default_rng(SEED)
    paths: set = set()
    residual = y - y.mean()
    for _ in range(TREES):
        rows = chosen.choice(len(x), max(1, int(ROWS_A_TREE * len(x))), replace=False)
        own: set = set()
        _grow(x, residual, rows, (), DEPTH, chosen, own)
        paths |= own
        leaves = [p for p in own if not any(q[: len(p)] == p and q != p for q in own)]
        for leaf in leaves:
            inside = Rule(leaf).holds(x)
            if inside.any():
                residual[inside] -= 0.1 * residual[inside].mean()
    return [Rule(p) for p in sorted(paths)]


def lasso(x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Intercept and sparse logistic weights by accelerated proximal gradient steps."""
    n, m = x.shape
    spread = x.std(axis=0) + 0.05
    z = x / spread
    rate = 4.0 / max(np.linalg.norm(z, 2) ** 2 / n + 1, 1e-9)
    w, v, b, c, t = np.zeros(m), np.zeros(m), 0.0, 0.0, 1.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(z @ v + c, -30, 30)))
        new = v - rate * (z.T @ (p - y) / n)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * PENALTY, 0)
        new_b = c - rate * (p - y).mean()
        s = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / s * (new - w), new_b + (t - 1) / s * (new_b - b)
        w, b, t = new, new_b, s
    return b, w / spread


@dataclass
class Model:
    intercept: float
    rules: list[Rule]

    def column(self, stats: Column) -> Column:
        """The score as one column expression."""
        odds = F.lit(float(self.intercept))
        for rule in self.rules:
            odds = odds + F.when(rule.column(stats), float(rule.weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Rules and weights from at most SAMPLE_ROWS labelled rows that are not held out, with SAMPLE_BYTES of text. Without such rows there are no rules and every score is 0.5."""
    sample = labelled_sample(docs, labels, "quality", SAMPLE_ROWS, SAMPLE_BYTES)
    rows = sample.select("quality", statistics(F.col("text")).alias("s")).select("quality", "s.*").toPandas()
    if not len(rows):
        return Model(0.0, [])
    x, y = rows[list(STATISTICS)].to_numpy(float), rows["quality"].to_numpy(float)
    rules = tree_rules(x, y)
    if not rules:
        rate = float(np.clip(y.mean(), 0.001, 0.999))
        return Model(float(np.log(rate / (1 - rate))), [])
    intercept, weights = lasso(np.column_stack([r.holds(x) for r in rules]).astype(float), y)
    return Model(intercept, [Rule(r.conditions, float(w)) for r, w in zip(rules, weights) if abs(w) > 1e-6])


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """Every row of `docs` with `score`, 0 to 1. Null, empty and wordless texts are scored by their statistics, which are 0. Repeated rows score alike."""
    at = free("_s", docs)
    return docs.withColumn(at, statistics(text_of(docs))).withColumn("score", model.column(F.col(at))).drop(at)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_quality(docs.select("doc_id", "text"), learn(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))
