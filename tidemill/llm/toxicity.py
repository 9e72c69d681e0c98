"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic examples and unlabelled text train a linear classifier in numpy. Its risk is estimated without
negative labels: pi * E_p[l(g)] + max(0, E_u[l(-g)] - pi * E_p[l(-g)]), where pi is the class prior and l the logistic
loss; where the negative part turns below zero, the step ascends it instead (the non-negative correction).

Inputs are the presence of hashed words (letters and digits, case-folded) in the whole text. Words are screened, by Spark,
by how much likelier they are in positive than in unlabelled rows; all that pass are used. Training takes the texts of at
most MAX_POSITIVE positive and MAX_UNLABELLED unlabelled ids of the training fold, those with the least hash; scoring takes
every text. Rows become the short lists of their screened words, equal ones are merged with a weight, and at most as many
different lists as ids reach the driver (those with the least hash, where ids repeat), where the fit works on the lists alone.
The prior is a parameter; unless given, it is the share of positives among the labelled training rows.

Defined cases: ids are longs in the result. Null and empty texts are scored from the bias alone. Without a positive training
row, or a word that two of them share, the score is the prior (near 0 without labels). Rows that repeat count as often as
they occur. Empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import held_out, order_hash, written

BITS = 31
MAX_POSITIVE = 4000
MAX_UNLABELLED = 12000
MIN_Z = 4.5
EPOCHS = 300
_WORD = re.compile(r"\w+")


def hashed_words(text: str | None) -> np.ndarray:
    """Sorted distinct word hashes of a whole text."""
    words = set(_WORD.findall((text or "").casefold()))
    h = xxhash.xxh3_64_intdigest
    return np.unique(np.fromiter((h(w) & ((1 << BITS) - 1) for w in words), np.int64, len(words)))


@dataclass
class Classifier:
    """Hashes of the words in use, sorted, their weights and the bias."""

    words: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        g = self.bias
        if len(self.words):
            found = hashed_words(text)
            at = np.minimum(np.searchsorted(self.words, found), len(self.words) - 1)
            g += float(self.weights[at[self.words[at] == found]].sum())
        return float(1 / (1 + np.exp(-np.clip(g, -500, 500))))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


class Rows:
    """Sets of feature numbers with weights that add up to 1, as flat lists."""

    def __init__(self, sets: list[list[int]], counts: list[int]):
        self.n = len(sets)
        self.cols = np.fromiter((c for s in sets for c in s), np.int64)
        self.row = np.repeat(np.arange(self.n), [len(s) for s in sets])
        self.share = np.array(counts, float) / max(1, sum(counts))

    def margins(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.cols], self.n) + w[-1]

    def pulled(self, by_row: np.ndarray, d: int) -> np.ndarray:
        """Weighted sums of a value over the rows that have each feature, and over all rows."""
        by_row = by_row * self.share
        return np.append(np.bincount(self.cols, by_row[self.row], d), by_row.sum())


def constant(prior: float) -> Classifier:
    return Classifier(np.empty(0, np.int64), np.empty(0), float(np.log(prior / (1 - prior))))


def fit(words: np.ndarray, positive: Rows, unlabelled: Rows, prior: float, epochs: int = EPOCHS, decay: float = 2e-4) -> Classifier:
    """Full-batch Adam on the non-negative risk."""
    d = len(words)
    w, m, v = np.zeros(d + 1), 0.0, 0.0
    for t in range(1, epochs + 1):
        gp, gu = positive.margins(w), unlabelled.margins(w)
        up = -prior * positive.pulled(1 - _sigmoid(gp), d)
        down = unlabelled.pulled(_sigmoid(gu), d) - prior * positive.pulled(_sigmoid(gp), d)
        negative = np.logaddexp(0, gu) @ unlabelled.share - prior * np.logaddexp(0, gp) @ positive.share
        grad = (up + down if negative >= 0 else -down) + decay * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        w = w - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return Classifier(words, w[:-1], float(w[-1]))


def _screened(rows: DataFrame, n_p: int, n_u: int) -> np.ndarray:
    """The words that stand out by MIN_Z errors and are twice as likely in positive rows (the same screen at every size);
    if there are none, the 16 that stand out most."""
    counts = rows.select("y", F.explode("words").alias("word")).groupBy("word").agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("u")).filter("a >= 2")
    share_p, share_u, both = F.col("a") / n_p, (F.col("u") + 0.5) / (n_u + 1), (F.col("a") + F.col("u")) / (n_p + n_u)
    z = (share_p - share_u) / F.sqrt(both * (1 - both) * (1 / n_p + 1 / n_u) + 1e-12)
    ranked = written(counts.select("word", z.alias("z"), (share_p >= 2 * share_u).alias("likely")), "words")
    found = [r.word for r in ranked.filter((F.col("z") >= MIN_Z) & F.col("likely")).select("word").collect()]
    return np.sort(np.array(found or [r.word for r in ranked.orderBy(F.desc("z"), "word").limit(16).collect()], np.int64))


def teach(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", prior: float | None = None, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED, id_col: str = "doc_id", text_col: str = "text") -> Classifier:
    """Train on the fold that isn't held out. Only a bounded sample of ids is joined with texts, and only its screened words are collected."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter(~held_out("id"))
    if prior is None:
        prior = known.select(F.avg(F.when(F.col("y").isin(0, 1), F.col("y")))).first()[0] or 0.0
    rows = docs.select(F.col(id_col).alias("id")).filter(~held_out("id"))
    draw = order_hash("id", seed="pu")
    # Two short lists of ids, at most max_positive + max_unlabelled in all: small enough to broadcast by their bound.
    sample = known.filter("y = 1").orderBy(draw, "id").limit(max_positive).select("id", F.lit(1).alias("y")).unionByName(rows.orderBy(draw, "id").limit(max_unlabelled).select("id", F.lit(0).alias("y")))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"y": pdf["y"], "words": [hashed_words(t) for t in pdf["text"]]})

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    found = written(texts.join(F.broadcast(sample.distinct()), "id").select("y", "text").mapInPandas(hashed, "y int, words array<long>"), "samples")
    n = {r.y: r["count"] for r in found.groupBy("y").count().collect()}
    if not n.get(1) or not n.get(0):
        return constant(min(max(prior, 1e-4), 0.9)) if n.get(1) or prior > 1e-4 else constant(2e-9)
    prior = min(max(prior, 1e-4), 0.9)
    words = _screened(found, n[1], n[0])
    if not len(words):  # no word occurs in two positive rows
        return constant(prior)

    def short(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"y": pdf["y"], "cols": [np.searchsorted(words, w[np.isin(w, words)]) for w in pdf["words"]]})

    lists = written(found.mapInPandas(short, "y int, cols array<long>").groupBy("y", "cols").count(), "lists")
    rows = {y: lists.filter(F.col("y") == y).orderBy(F.xxhash64("cols"), "cols").limit(most).collect() for y, most in ((1, max_positive), (0, max_unlabelled))}
    return fit(words, *(Rows([r.cols for r in rows[y]], [r["count"] for r in rows[y]]) for y in (1, 0)), float(prior))


def score(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype=float)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), run.asNondeterministic()(F.col(text_col).cast("string")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
