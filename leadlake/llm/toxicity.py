"""Toxicity by weak supervision: many voters, a generative model of how far each is right, and a linear classifier trained on what it believes."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import held_out, labelled_sample, text_of

# Labelled rows that voters and models are fitted on, at most: the first by a hash of the id.
SAMPLE_ROWS = 12_000
# Bytes of their texts, at most; see `labelled_sample`.
SAMPLE_BYTES = 128 * 1024 * 1024
# Words that speak for toxicity before any label is seen.
LEXICON = ("idiot", "moron", "stupid", "loser", "pathetic", "scum", "worthless", "trash", "clown", "disgusting", "idiota", "estúpido", "imbécil", "dumm", "dummkopf",
           "trottel", "crétin", "imbécile", "débile", "hate", "kill", "shut up", "filth", "vermin")
# Words and beginnings of words become voters if seen in this many toxic sample rows and if toxic rows are this share of those that hold them.
MIN_ROWS, MIN_SHARE, MOST_VOTERS = 6, 0.95, 400
PREFIX_SIZES = (4, 5, 6, 7, 8)
# Pattern voters: shouting, address. They are the last voters.
PATTERNS = 2
EM_ROUNDS, SMOOTHING = 30, 1.0
RIDGE, NEWTON_ROUNDS = 1.0, 25

_WORD = re.compile(r"[^\W\d_]+")
_SHOUT = re.compile(r"!{2,}|\b[A-ZÀ-Þ]{4,}\b")
_ADDRESS = re.compile(r"\b(?:you|your|tu|vous|du|ihr|tú|usted)\b", re.IGNORECASE)


def terms_of(text: str) -> set[str]:
    """Words in lower case, and beginnings of words, marked by a star."""
    words = set(_WORD.findall(text.lower()))
    return words | {f"{w[:n]}*" for n in PREFIX_SIZES for w in words if len(w) >= n}


@dataclass
class Voters:
    """Lexicon voters (a word or beginning, one vote each) and pattern voters."""

    terms: list[str]

    def __post_init__(self) -> None:
        self.at = {t: i for i, t in enumerate(self.terms)}
        self.beginnings = {n: {t[:-1]: i for t, i in self.at.items() if t.endswith("*") and len(t) == n + 1} for n in PREFIX_SIZES}

    def votes(self, text: str) -> tuple[np.ndarray, list[float]]:
        """Which voters vote toxic, and how many words and how many hits there are."""
        fired = np.zeros(len(self.terms) + 2, np.int8)
        counts = Counter(_WORD.findall(text.lower()))
        hits = 0
        for word, n in counts.items():
            found = [i for i in (self.at.get(word), *(b.get(word[:size]) for size, b in self.beginnings.items() if len(word) >= size)) if i is not None]
            if found:
                fired[found] = 1
                hits += n
        fired[-2] = len(_SHOUT.findall(text)) > 3
        fired[-1] = _ADDRESS.search(text) is not None
        return fired, [float(hits), float(sum(counts.values()))]

    def features(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        fired, (hits, words) = self.votes(text)
        terms = fired[:-2].sum()
        return fired, np.array([1.0, hits > 0, hits > 1, np.log1p(hits), np.log1p(terms), 10 * np.sqrt(hits / max(words, 1.0)), fired[-2], fired[-1], np.log1p(words) / 10])


def find_voters(texts: list[str], toxic: np.ndarray) -> Voters:
    """The lexicon, and the terms of labelled training rows that mark toxic ones."""
    seen, bad = Counter(), Counter()
    for text, label in zip(texts, toxic):
        terms = terms_of(text)
        seen.update(terms)
        if label:
            bad.update(terms)
    marks = sorted((t for t, n in bad.items() if n >= MIN_ROWS and n >= MIN_SHARE * seen[t]), key=lambda t: (-bad[t], len(t), t))[:MOST_VOTERS]
    return Voters(list(dict.fromkeys([*LEXICON, *marks])))


def believed(votes: np.ndarray, prior: float, patterns: int = 0) -> np.ndarray:
    """Posterior of toxicity by a generative model of the votes, fitted by expectation and maximisation without labels.

    A voter that is silent abstains; one more voter speaks for harmless when all terms are silent. Each has a chance to speak on toxic and on other rows.
    The last `patterns` voters are no terms: what they say is weighed against the terms' silence, and rows where they alone speak begin at the prior.
    Voters that still agree once the class is known are copies of one another in part; in a row a voter's evidence is divided by one plus its
    correlations, within the classes, with the others that speak there, so a family of them counts about once.
    """
    heard = votes.any(axis=0)
    silent = ~votes[:, : votes.shape[1] - patterns].any(axis=1)
    v = np.column_stack((votes[:, heard], silent)).astype(float)
    belief = np.where(~silent, 0.9, np.where(votes.any(axis=1), prior, prior / 10))
    for _ in range(EM_ROUNDS):
        on_bad = (belief @ v + SMOOTHING * 0.1) / (belief.sum() + SMOOTHING)
        on_good = ((1 - belief) @ v + SMOOTHING * 0.01) / ((1 - belief).sum() + SMOOTHING)
        residual = v - np.outer(belief, on_bad) - np.outer(1 - belief, on_good)
        scale = np.sqrt((residual**2).mean(axis=0)) + 1e-9
        related = np.abs(residual.T @ residual / len(v)) / np.outer(scale, scale)
        np.fill_diagonal(related, 0.0)
        together = 1.0 + v @ np.where(related > 0.2, related, 0.0)
        odds = np.log(prior / (1 - prior)) + (v * np.log(on_bad / on_good) / together).sum(axis=1)
        belief = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return belief


def fit_linear(x: np.ndarray, belief: np.ndarray) -> np.ndarray:
    """Ridge logistic weights for soft labels, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(NEWTON_ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        pull = x.T @ (p - belief) + RIDGE * w
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w)), pull)
    return w


@dataclass
class Model:
    voters: Voters
    weights: np.ndarray

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.voters.features(text)[1] @ self.weights, -30, 30))))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Voters and weights from a sample of labelled rows that are not held out, at most SAMPLE_ROWS rows and SAMPLE_BYTES of text.

    Without labelled rows the lexicon alone votes and every score is that of the prior weights, 0.5 at most.
    """
    rows = labelled_sample(docs, labels, "toxic", SAMPLE_ROWS, SAMPLE_BYTES).toPandas()  # bounded in rows and bytes
    toxic = rows["toxic"].to_numpy(int)
    voters = find_voters(list(rows["text"]), toxic)
    if not len(rows):
        return Model(voters, np.zeros(9))
    fired, x = map(np.array, zip(*map(voters.features, rows["text"])))
    prior = float(np.clip(toxic.mean(), 0.01, 0.99))
    return Model(voters, fit_linear(x, believed(fired, prior, PATTERNS)))


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """Every row of `docs` with `score`, 0 to 1; null, empty and wordless texts get the score of a text without words. Repeated rows score alike."""
    voters, weights = model.voters, model.weights

    @F.pandas_udf("double")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Model(voters, weights)
        for batch in texts:
            yield pd.Series([scorer.score(t) for t in batch], dtype=float)

    return docs.withColumn("score", of(text_of(docs)))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_toxicity(docs.select("doc_id", "text"), learn(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
